"""Fuzzy search for short licence notices in whole texts.

A notice of at most k errors (insertions, deletions, substitutions) that is split into k + 1
pieces keeps one piece intact (pigeonhole), so an Aho-Corasick automaton over all pieces
finds every candidate place in one pass. The regex library's bounded-error matching then
verifies the neighbourhood of each seed and gives the span and its errors. A phrase with
k = 0 is its own seed; the base phrases are notices of that kind.

Texts are compared as words: A-Z lower-cased, everything that isn't a letter, digit or
non-ASCII character taken as one space. Errors are counted in bytes of that form.

Defined cases: null text counts as empty; a text without words has no spans and score 0;
ties between spans are ordered by start, end, label; repeated rows and null ids give a row
each; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpforge.llm.common import chunks, map_arrow, with_text, words


@dataclass(frozen=True)
class Notice:
    """A phrase of lower-case words, its label, the errors allowed, and whether it is a base phrase."""

    phrase: str
    label: str
    errors: int
    base: bool = False


#: The base phrases and their labels.
BASE = (
    Notice("cc by", "cc-by", 0, True),
    Notice("general public license", "gpl", 0, True),
    Notice("all rights reserved", "reserved", 0, True),
)
#: The notices that the method adds. Errors grow with the length: about one in ten characters.
NOTICES = (
    Notice("licensed under the apache license version", "apache", 4),
    Notice("released under the mit license", "mit", 3),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 7),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
    Notice("licensed under cc by nc", "cc-by-nc", 2),
    Notice("licensed under cc by sa", "cc-by-sa", 0),
    Notice("creative commons attribution", "cc-by", 2),
    Notice("licensed under the gnu general public license", "gpl", 4),
    Notice("gnu lesser general public license", "lgpl", 2),
    Notice("gnu affero general public license", "agpl", 2),
    Notice("mozilla public license", "mpl", 2),
    Notice("free and unencumbered software released into the public domain", "unlicense", 6),
    Notice("all rights reserved", "reserved", 2),
)


class NoticeSearch:
    """The seeds of a list of notices and the verification of what they find."""

    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n.phrase, literal_spaces=True)}){{e<={n.errors}}}") for n in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(notices):
            phrase = f" {n.phrase} " if not n.errors else n.phrase
            size, more = divmod(len(phrase), n.errors + 1)
            at = 0
            for p in range(n.errors + 1):
                end = at + size + (p < more)
                seeds.setdefault(phrase[at:end], []).append((k, at))
                at = end
        self.seeds = ahocorasick.Automaton()
        for s, where in seeds.items():
            self.seeds.add_word(s, (len(s), where))
        self.seeds.make_automaton()

    def spans(self, found: list[bytes]) -> list[tuple[str, int, int, int, bool, float]]:
        """(label, first word, word after the last, errors, base, score) over a text's words."""
        text = " " + b" ".join(found).decode("latin-1") + " "
        near: dict[int, list[int]] = {}
        out = set()
        starts: list[int] = []
        for end, (length, where) in self.seeds.iter(text):
            if not starts:
                starts = [1]
                for w in found[:-1]:
                    starts.append(starts[-1] + len(w) + 1)
            for k, offset in where:
                n, at = self.notices[k], end + 1 - length - offset
                if n.errors:
                    near.setdefault(k, []).append(at)
                else:
                    out.add(self._span(starts, k, at + 1, at + 1 + len(n.phrase), 0))
        for k, places in near.items():
            n, places = self.notices[k], sorted(set(places))
            lo = hi = None
            windows = []
            for at in places:  # neighbouring seeds of one place share a window
                a, b = max(0, at - n.errors), min(len(text), at + len(n.phrase) + n.errors)
                if hi is None or a > hi:
                    if hi is not None:
                        windows.append((lo, hi))
                    lo, hi = a, b
                else:
                    hi = max(hi, b)
            windows.append((lo, hi))
            for lo, hi in windows:
                for m in self._matches(k, text, lo, hi):
                    out.add(self._span(starts, k, m.start(), m.end(), sum(m.fuzzy_counts)))
        return sorted(out, key=lambda s: (s[1], s[2], s[0], s[3], s[4]))

    def _matches(self, k: int, text: str, lo: int, hi: int) -> Iterator[regex.Match]:
        """All places of a notice in a window: the best match, then those before and after it."""
        rest = [(lo, hi)]
        while rest:
            lo, hi = rest.pop()
            if hi - lo >= len(self.notices[k].phrase) - self.notices[k].errors and (m := self.patterns[k].search(text, lo, hi)) and m.end() > m.start():
                yield m
                rest += [(lo, m.start()), (m.end(), hi)]

    def _span(self, starts: list[int], k: int, a: int, b: int, errors: int) -> tuple[str, int, int, int, bool, float]:
        first = max(0, bisect_left(starts, a + 1) - 1)
        n = self.notices[k]
        return n.label, first, max(first + 1, bisect_left(starts, b)), errors, n.base, 1.0 - errors / len(n.phrase)


@lru_cache(maxsize=4)
def _search(notices: tuple[Notice, ...]) -> NoticeSearch:
    return NoticeSearch(notices)


_SPAN = "struct<label:string,start_word:long,end_word:long,errors:int,base:boolean,score:double>"


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: tuple[Notice, ...] = BASE + NOTICES) -> DataFrame:
    """(doc_id, n_words, spans): every place of every notice, ordered by start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _search(notices)
        names = ("label", "start_word", "end_word", "errors", "base", "score")
        kind = pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("errors", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))
        for b in chunks(batches):
            counts, spans = [], []
            for t in b.column(1).to_pylist():
                found = words(t)
                counts.append(len(found))
                spans.append([dict(zip(names, s)) for s in search.spans(found)] if found else [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.int64()), pa.array(spans, kind)], ["doc_id", "n_words", "spans"])

    return map_arrow(with_text(docs, id_col, text_col), run, f"doc_id long, n_words long, spans array<{_SPAN}>")


def license_report(spans: DataFrame) -> DataFrame:
    """One row per document: counts, first and last base place, labels and score."""
    base = F.filter("spans", lambda s: s["base"])
    start = F.transform(base, lambda s: s["start_word"])
    labels = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.transform(xs, lambda s: s["label"]))), ",")
    return spans.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"),
        F.array_max(start).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )
