"""Byte-level BPE with forced boundaries.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never be
merged, so every such place is a certain cut: the fragments on both sides are encoded on
their own and their ids concatenated. Two uses follow from the table of those pairs:

* every pre-token is cut at all its forced pairs into pieces for the merge loop; a long run
  without white space costs no more than its parts;
* a text is first cut ahead of each run of white space. No pre-token reaches from another
  character into white space and the pre-tokenizer has no look-behind, so nothing is merged
  across this place either; these fragments recur, so a bounded cache holds their ids.

Decoding concatenates the bytes of the ids. Special tokens' strings in a text become their
ids, as the tokenizers library does. Texts are processed whole, in blocks of fragments.

Defined cases: null text counts as empty, an empty text has no ids and decodes to an empty
text; repeated rows and null ids give a row each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpforge.llm.common import add_column, chunks, map_arrow, with_text

#: Fixed value: the pre-tokenizer's pattern of byte-level BPE.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: the characters of Unicode's White_Space property, which is the pattern's \s.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE_SPACE = re.compile(f"[{_SPACE}] |^ ")
_STOPS = frozenset(".,;:!?")
_FRAGMENT = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: Fragments that the cache of a worker holds (about 400 bytes each), and their longest length.
CACHE, CACHED_CHARS = 100_000, 48
#: Fragments that are encoded between two updates of the digests.
BLOCK = 20_000


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryBpe:
    """Encoder and decoder for one byte-level vocabulary file (tokenizers' JSON format)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("a byte-level BPE file without normalizer or prefix space is needed")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in tok): i for tok, i in spec["model"]["vocab"].items() if tok not in special}
        order = [ranks[bytes(byte[c] for c in a + b)] for a, b in (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])]
        if order != sorted(order):
            raise ValueError("ids don't follow the order of the merges")
        self.special = special
        self.bytes_of = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.joined = np.zeros((256, 256), dtype=bool)
        for tok in ranks:
            for a, b in zip(tok, tok[1:]):
                self.joined[a, b] = True
        self._joined_pairs = {bytes(x) for x in np.argwhere(self.joined).astype(np.uint8).tolist()}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self._pretoken = regex.compile(PRETOKEN)
        self._piece = tiktoken.Encoding("own", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self._cache: dict[str, tuple[str, bytes, list[int]]] = {}

    def pieces(self, pretoken: bytes) -> list[bytes]:
        """The pieces between forced boundaries of a pre-token."""
        if len(pretoken) < 64:
            pairs = self._joined_pairs
            at = [i for i in range(1, len(pretoken)) if pretoken[i - 1 : i + 1] not in pairs]
        else:
            raw = np.frombuffer(pretoken, dtype=np.uint8)
            at = (np.flatnonzero(~self.joined[raw[:-1], raw[1:]]) + 1).tolist()
        return [pretoken[i:j] for i, j in zip([0, *at], [*at, len(pretoken)])] if at else [pretoken]

    def _pretokens(self, fragment: str) -> list[str]:
        body = fragment[1:] if fragment[:1] == " " else fragment
        if body.isalpha():  # a word: one pre-token, without the pattern
            return [fragment]
        if body[-1:] in _STOPS and body[:-1].isalpha():
            return [fragment[:-1], fragment[-1]]
        return self._pretoken.findall(fragment)

    def _fresh(self, fragment: str) -> list[int]:
        ids: list[int] = []
        for pre in self._pretokens(fragment):
            for piece in self.pieces(pre.encode()):
                ids += self._piece(piece)
        return ids

    def _entry(self, fragment: str) -> tuple[str, bytes, list[int]]:
        """(ids joined by commas, bytes that they decode to, ids) of a fragment."""
        ids = self._fresh(fragment)
        out = ",".join(map(self.text_of.__getitem__, ids)), b"".join(map(self.bytes_of.__getitem__, ids)), ids
        if len(fragment) <= CACHED_CHARS:
            if len(self._cache) >= CACHE:  # what came first is mostly frequent: that half stays
                self._cache = dict(islice(self._cache.items(), CACHE // 2))
            self._cache[fragment] = out
        return out

    def fragments(self, text: str) -> list[str]:
        """Cuts ahead of white space; the strings together are the text."""
        if not _SPACE_SPACE.search(text):  # every space stands after another kind of character
            first, *rest = text.split(" ")
            return [*([first] if first else []), *[" " + x for x in rest]]
        return _FRAGMENT.findall(text)

    def blocks(self, text: str) -> Iterator[list[tuple[str, bytes, list[int]]]]:
        """The entries of a text's fragments, in blocks; special tokens stand alone."""
        for k, part in enumerate(self._special.split(text) if self._special else [text]):
            if k % 2:
                i = self.special[part]
                yield [(self.text_of[i], self.bytes_of[i], [i])]
            elif part:
                found = self.fragments(part)
                for at in range(0, len(found), BLOCK):
                    block = found[at : at + BLOCK]
                    got = list(map(self._cache.get, block))
                    if None in got:
                        seen: dict[str, tuple[str, bytes, list[int]]] = {}
                        for j, f in enumerate(block):
                            if got[j] is None:
                                if f not in seen:
                                    seen[f] = self._entry(f)
                                got[j] = seen[f]
                    yield got

    def encode(self, text: str) -> list[int]:
        """Ids as the tokenizers library gives them without adding special tokens."""
        return [i for block in self.blocks(text) for e in block for i in e[2]]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, special tokens included; invalid bytes become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> ForcedBoundaryBpe:
    """One encoder for a worker; the vocabulary is read where the worker runs."""
    return ForcedBoundaryBpe(path)


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in chunks(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bpe.encode(t) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_arrow(with_text(docs, id_col, text_col), run, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([bpe.decode(x or ()) for x in part.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def bpe_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def one(bpe: ForcedBoundaryBpe, text: str) -> tuple[int, str, str]:
        n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
        for block in bpe.blocks(text):
            of_ids.update(("," * (n > 0) + ",".join([e[0] for e in block])).encode())
            of_text.update(b"".join([e[1] for e in block]).decode("utf-8", "replace").encode())
            n += sum([len(e[2]) for e in block])
        return n, of_ids.hexdigest(), of_text.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in chunks(batches):
            n, ids, text = zip(*(one(bpe, t) for t in b.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(text)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(with_text(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with its text replaced by ``ids`` and ``n_tokens``; rows whose ids don't decode
    to their text again are left out (there are none with a byte-level vocabulary)."""

    def make() -> Callable[[str], list[int] | None]:
        bpe = load(path)

        def one(text: str) -> list[int] | None:
            ids = bpe.encode(text)
            return ids if bpe.decode(ids) == text else None

        return one

    out = add_column(docs, text_col, "ids", "array<int>", pa.list_(pa.int32()), make).where("ids IS NOT NULL")
    return out.select(*(c for c in docs.columns if c != text_col), "ids", F.size("ids").cast("long").alias("n_tokens"))
