"""Near-duplicate passages by compact windows.

The tokens are word 5-shingles (single words would give unrelated texts the same signatures).
For each of ``HASHES`` hash functions the Cartesian tree over a text's token hashes groups its
subsequences: all subsequences of at least ``LEAST`` tokens whose minimum stands at c form one
compact window (l, c, r), so a text of n tokens has about 2n / LEAST windows instead of n^2
subsequences. A window's signature is its minimum.

1. Rows of equal word sequences are one class; one of them goes on, the others repeat whole.
2. Signatures that occur in one text only are dropped: two numbers for each signature are
   aggregated, and only windows of repeated signatures come back.
3. Within a text, windows of different hashes are joined as intervals: where subsequences of
   ``LEAST`` tokens lie in two of them, they share ``AGREE`` = 2 signatures, and the pair of
   signatures becomes the key under which texts meet. Near-duplicate passages (similarity
   0.8) share two of four signatures with probability 0.97, exact ones always, and longer
   passages hold several such subsequences.
4. In each key's group all places are compared with a leader's: a star, not all pairs. Only
   what was verified at a place is closed there; the stretches left open are a query set
   against all places that the leader met, in blocks of bounded bytes (``block_passages``).
5. Verification on the tokens themselves: a passage is reported if it holds a stretch of
   ``LEAST`` tokens or more of which both texts share a Jaccard similarity of 0.8.

Defined cases: null or empty texts and texts of fewer than 50 words have no passage; a null
doc_id takes part in nothing; rows that repeat an id count as one document (the one of the
smallest word digest); repeats inside one document alone aren't reported; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpforge.llm.common import chunks, map_arrow, only_ids, with_text
from kelpforge.llm.graph import components
from kelpforge.llm.tokens import SHINGLE, mix, shingle_hashes, word_hashes
from kelpforge.session import materialize

#: Words of the shortest passage, and its shingles.
PASSAGE_WORDS = 50
LEAST = PASSAGE_WORDS - SHINGLE + 1
HASHES, AGREE, THRESHOLD = 4, 2, 0.8
#: Bytes of tokens of one block of a group.
BLOCK_BYTES = 1 << 21


def _sliding(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """``op`` (minimum or maximum) over each run of ``width`` elements, in linear time."""
    n = len(x)
    pad = -n % width
    fill = x[-1:] if n else x
    blocks = np.concatenate([x, np.repeat(fill, pad)]).reshape(-1, width)
    front = op.accumulate(blocks, axis=1).ravel()
    back = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - width + 1], front[width - 1 : n])


def compact_windows(values: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, l, c, r) of all compact windows of at least ``least`` tokens of all texts.

    ``values``: token hashes of all texts, ``offsets``: where each text's begin. Positions
    count from the text's start, r included. Of equal minima the first stands at c.
    """
    texts = len(offsets) - 1
    n = len(values)
    doc = np.repeat(np.arange(texts), np.diff(offsets))
    x = np.zeros(n + texts + 1, dtype=np.uint64)  # a zero ends each text
    place = np.arange(n) + doc + 1
    x[place] = values | np.uint64(1)
    if len(x) < least:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty
    low = _sliding(x, least, np.minimum)
    padded = np.concatenate([np.zeros(least - 1, dtype=np.uint64), low, np.zeros(least - 1, dtype=np.uint64)])
    is_min = _sliding(padded, least, np.maximum) == x  # the minimum of some run around it
    is_min |= x == 0
    at = np.flatnonzero(is_min)
    vals = x[at].tolist()
    before, after = [0] * len(vals), [0] * len(vals)
    stack: list[int] = []
    for k, v in enumerate(vals):
        while stack and vals[stack[-1]] > v:
            after[stack.pop()] = k
        before[k] = stack[-1] if stack else k
        stack.append(k)
    keep = np.flatnonzero(x[at] != 0)
    c = at[keep]
    left = at[np.array(before, dtype=np.int64)[keep]] + 1
    right = at[np.array(after, dtype=np.int64)[keep]] - 1
    wide = right - left + 1 >= least
    c, left, right = c[wide], left[wide], right[wide]
    starts = np.arange(texts) + offsets[:-1] + 1
    text = np.searchsorted(starts, c, side="right") - 1
    return text, left - starts[text], c - starts[text], right - starts[text]


def windows(docs: DataFrame, hashes: int = HASHES, least: int = LEAST) -> DataFrame:
    """(sig, doc_id, lo, hi) of (doc_id, text): of each compact window its signature and the first
    and last start of its subsequences of ``least`` tokens (windows without one are left out);
    the number of the hash is sig mod 8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            sh, off, _ = shingle_hashes([t.encode() for t in b.column(1).to_pylist()], short=False)
            ids = np.asarray(b.column(0))
            for i in range(hashes):
                v = mix(sh, 100 + i)
                text, left, c, right = compact_windows(v, off, least)
                lo, hi = np.maximum(left, c - least + 1), np.minimum(c, right - least + 1)
                some = lo <= hi
                text, c, lo, hi = text[some], c[some], lo[some], hi[some]
                if len(text):
                    sig = (v[off[text] + c] & ~np.uint64(7) | np.uint64(i)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(ids[text]), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))], ["sig", "doc_id", "lo", "hi"])

    return map_arrow(docs.select("doc_id", "text"), run, "sig long, doc_id long, lo int, hi int")


def interval_pairs(sig: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(signature, signature, first, last) of all intervals of two hashes that meet in one text.

    Intervals of one signature that touch count as one: a text that repeats itself has many
    equal minima."""
    by = np.lexsort((lo, sig))
    sig, lo, hi = sig[by], lo[by], hi[by]
    new = np.flatnonzero(np.r_[True, (sig[1:] != sig[:-1]) | (lo[1:] > hi[:-1] + 1)])
    sig, lo, hi = sig[new], lo[new], np.maximum.reduceat(hi, new)
    sides = []
    for h in np.unique(sig & 7):
        mine = np.flatnonzero((sig & 7) == h)
        sides.append(mine[np.argsort(lo[mine], kind="stable")])  # disjoint, as each start has one minimum
    out: tuple[list, ...] = ([], [], [], [])
    for i, x in enumerate(sides):
        for y in sides[i + 1 :]:
            first = np.searchsorted(hi[y], lo[x], "left")
            n = np.searchsorted(lo[y], hi[x], "right") - first
            u = np.repeat(x, n)
            w = y[np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
            for to, part in zip(out, (sig[u], sig[w], np.maximum(lo[u], lo[w]), np.minimum(hi[u], hi[w]))):
                to.append(part)
    return tuple(np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in out)


def joined_windows(repeated: DataFrame, least: int = LEAST) -> DataFrame:
    """(key, doc_id, lo, hi): places where subsequences of ``least`` tokens lie in compact windows
    of two different hashes, joined as intervals of their starts; the tokens lo to hi."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            at = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            sig, lo, hi = (np.asarray(lists.flatten().field(c)).astype(np.int64) for c in ("sig", "lo", "hi"))
            docs, parts = np.asarray(b.column(0)), []
            for k, (i, j) in enumerate(zip(at[:-1], at[1:])):
                x, y, first, last = interval_pairs(sig[i:j], lo[i:j], hi[i:j])
                if len(x):
                    key = mix(mix(x.view(np.uint64), 7) ^ y.view(np.uint64), 8).view(np.int64)
                    parts.append((key, np.full(len(x), docs[k]), first.astype(np.int32), (last + least - 1).astype(np.int32)))
                if parts and (k == b.num_rows - 1 or sum(len(p[0]) for p in parts) > 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], ["key", "doc_id", "lo", "hi"])
                    parts = []
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], ["key", "doc_id", "lo", "hi"])

    lists = repeated.groupBy("doc_id").agg(F.collect_list(F.struct("sig", "lo", "hi")).alias("w"))
    return map_arrow(lists, run, "key long, doc_id long, lo int, hi int")


def token_seqs(docs: DataFrame) -> DataFrame:
    """(doc_id, seq): all shingles in order, as 32-bit numbers (a passage is 46 of them or more)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            sh, off, _ = shingle_hashes([t.encode() for t in b.column(1).to_pylist()], short=False)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sh[i:j].astype(np.uint32).tobytes() for i, j in zip(off[:-1], off[1:])], pa.binary())], ["doc_id", "seq"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, seq binary")


def merged_segments(segments: list[tuple[int, int, int, int]]) -> list[list[int]]:
    """Segments (a_lo, a_hi, b_lo, b_hi) joined where they overlap in both texts."""
    out: list[list[int]] = []
    for s in sorted(segments, key=lambda s: (s[2], s[0])):
        for o in reversed(out[-8:]):
            if s[2] <= o[3] and s[0] <= o[1] and o[0] <= s[1]:
                o[0], o[1], o[3] = min(o[0], s[0]), max(o[1], s[1]), max(o[3], s[3])
                break
        else:
            out.append(list(s))
    return out


def shared_passages(a: np.ndarray, b: np.ndarray, least: int, threshold: float) -> list[tuple[int, int, int, int]]:
    """(a_lo, a_hi, b_lo, b_hi), ends included, of the passages of two token sequences: stretches
    of b in which runs of ``least`` tokens are alike with a run of a, every start tested. (Where
    tokens repeat inside a text, a start is tested against the part of a that holds most of it.)"""
    need = least - spare_tokens(least, threshold) + 1
    if len(b) < least or len(a) < least:
        return []
    in_a = np.isin(b, a)
    total = np.concatenate([[0], np.cumsum(in_a)])
    full = np.flatnonzero(total[least:] - total[:-least] >= need)
    if not len(full):
        return []
    out: list[tuple[int, int, int, int]] = []
    repeats = None
    for run in np.split(full, np.flatnonzero(np.diff(full) > least) + 1):
        got = _aligned(a, b, int(run[0]), int(run[-1]) + least, threshold)
        if got:
            out.append(got)
            continue
        if repeats is None:  # of each start, the tokens after it that stand more than once in a or b
            often = np.concatenate([v[c > 1] for v, c in (np.unique(x, return_counts=True) for x in (a, b))])
            repeats = np.concatenate([[0], np.cumsum(np.isin(b, often))]) if len(often) else np.zeros(len(b) + 1, dtype=np.int64)
        plain = repeats[run + least] == repeats[run]
        if plain.any():
            out += _alike_runs(a, b, run[plain], least, threshold)
        done = -1
        for s in run[~plain].tolist():  # start by start, after a passage at its end
            if s >= done and (got := _aligned(a, b, s, s + least, threshold)):
                out.append(got)
                done = got[3] - least // 2
    return out


def _alike_runs(a: np.ndarray, b: np.ndarray, starts: np.ndarray, least: int, threshold: float) -> list[tuple[int, int, int, int]]:
    """The alike runs at starts without repeated tokens, joined where they overlap in both."""
    by = np.argsort(a, kind="stable")
    k = np.minimum(np.searchsorted(a[by], b), len(a) - 1)
    nowhere = len(a) + 10 * least
    place = np.where(a[by][k] == b, by[k], nowhere)
    out: list[list[int]] = []
    for part in np.array_split(starts, max(1, len(starts) // 4096)):
        p = np.sort(place[part[:, None] + np.arange(least)], axis=1)
        best, lo, hi = np.zeros(len(part)), np.zeros(len(part), dtype=np.int64), np.zeros(len(part), dtype=np.int64)
        for m in range(least - spare_tokens(least, threshold) + 1, least + 1):  # shared tokens
            for i in range(least - m + 1):
                span = p[:, i + m - 1] - p[:, i] + 1
                sim = np.where(p[:, i + m - 1] < nowhere, m / (least + span - m), 0.0)
                up = sim > best
                best[up], lo[up], hi[up] = sim[up], p[up, i], p[up, i + m - 1]
        for s, x, y in zip(part[best >= threshold].tolist(), lo[best >= threshold].tolist(), hi[best >= threshold].tolist()):
            if out and s <= out[-1][3] and x <= out[-1][1] and y >= out[-1][0]:
                o = out[-1]
                o[0], o[1], o[3] = min(o[0], x), max(o[1], y), s + least - 1
            else:
                out.append([x, y, s, s + least - 1])
    return [tuple(o) for o in out]


def _aligned(a: np.ndarray, b: np.ndarray, lo: int, hi: int, threshold: float) -> tuple[int, int, int, int] | None:
    part = b[lo:hi]
    hit = np.flatnonzero(np.isin(part, a))
    if not len(hit):
        return None
    lo, hi = lo + int(hit[0]), lo + int(hit[-1]) + 1
    part = np.unique(b[lo:hi])
    where = np.flatnonzero(np.isin(a, part))
    size = hi - lo
    # of the places in a, the stretch of about the same length that holds most of them
    ends = np.searchsorted(where, where + int(size / threshold) + 1)
    k = int(np.argmax(ends - np.arange(len(where))))
    a_lo, a_hi = int(where[k]), int(where[ends[k] - 1]) + 1
    other = np.unique(a[a_lo:a_hi])
    both = len(np.intersect1d(part, other, assume_unique=True))
    if both < threshold * (len(part) + len(other) - both):
        return None
    return a_lo, a_hi - 1, lo, hi - 1


def open_gaps(passages: list[tuple[int, int, int, int]], size: int, least: int, threshold: float) -> list[tuple[int, int]]:
    """What passages (a_lo, a_hi, b_lo, b_hi) leave open of ``size`` tokens of b: every stretch of
    ``least`` tokens with more tokens outside them than two alike stretches may differ in."""
    spare = spare_tokens(least, threshold)
    at, out = 0, []
    for lo, hi in [*sorted(p[2:] for p in passages), (size, size)]:
        if lo - at >= spare:
            first, last = max(0, at - least + spare), min(size, lo + least - spare) - 1
            if last - first + 1 >= least:
                out.append((first, last))
        at = max(at, hi + 1)
    return out


def segments(pairs: DataFrame) -> DataFrame:
    """(a, b, a_lo, a_hi, b_lo, b_hi): the candidate segments of pairs, joined and materialized."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows = [(a, b, *s) for a, b, seg in zip(*(x.column(i).to_pylist() for i in range(3))) for s in merged_segments([(s["a_lo"], s["a_hi"], s["b_lo"], s["b_hi"]) for s in seg])]
            cols = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "a_lo", "a_hi", "b_lo", "b_hi"])

    grouped = pairs.groupBy("a", "b").agg(F.collect_set(F.struct("a_lo", "a_hi", "b_lo", "b_hi")).alias("seg"))
    return materialize(map_arrow(grouped, merge, "a long, b long, a_lo long, a_hi long, b_lo long, b_hi long"), "segments")


def verified_passages(found: DataFrame, seqs: DataFrame, least: int = LEAST, threshold: float = THRESHOLD) -> DataFrame:
    """(linked, a, a_lo, a_hi, b, b_lo, b_hi) of segments (a, b, a_lo, a_hi, b_lo, b_hi) of the
    texts ``seqs`` (doc_id, seq), materialized: verified passages, and (not linked) the stretches of b that they leave open."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows = []
            for k in range(0, x.num_rows, 128):
                part = x.slice(k, 128)
                for a, b, a_lo, b_lo, sa, sb in zip(*(c.to_pylist() for c in part.columns)):
                    y = np.frombuffer(sb, dtype=np.uint32)
                    got = shared_passages(np.frombuffer(sa, dtype=np.uint32), y, least, threshold)
                    rows += [(True, a, b, a_lo + p[0], a_lo + p[1], b_lo + p[2], b_lo + p[3]) for p in got]
                    rows += [(False, a, b, None, None, b_lo + lo, b_lo + hi) for lo, hi in open_gaps(got, len(y), least, threshold)]
            cols = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.bool_()), *(pa.array(c, pa.int64()) for c in cols[1:])], ["linked", "a", "b", "a_lo", "a_hi", "b_lo", "b_hi"])

    for side in ("a", "b"):
        cut = F.expr(f"substring(seq, cast({side}_lo * 4 + 1 as int), cast(({side}_hi - {side}_lo + 1) * 4 as int))")
        found = found.join(seqs.withColumnRenamed("doc_id", side), side).withColumn(f"seq_{side}", cut).drop("seq")
    return materialize(map_arrow(found.select("a", "b", "a_lo", "b_lo", "seq_a", "seq_b"), check, "linked boolean, a long, b long, a_lo long, a_hi long, b_lo long, b_hi long"), "passages")


def repeated_windows(docs: DataFrame, hashes: int = HASHES, least: int = LEAST) -> DataFrame:
    """The windows whose signature occurs in two texts or more."""
    w = materialize(windows(docs, hashes, least), "windows")
    sigs = materialize(w.groupBy("sig").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("sig"), "sigs")
    return w.join(sigs.hint("merge"), "sig", "left_semi")  # grows with the corpus: joined alike at every size


class Block:
    """Stretches of texts (doc, lo, tokens) of one block, to be searched for alike ones."""

    def __init__(self, docs: list[int], lows: list[int], seqs: list[bytes], closed: list[bool], leader: int):
        self.docs, self.lows = docs, lows
        self.seqs = [np.frombuffer(x, dtype=np.uint32) for x in seqs]
        #: by document: the number of its component; that of all closed texts is the first
        self.number = {d: k for k, d in enumerate(dict.fromkeys([leader, *docs]), 0)}
        self.label = np.arange(len(self.number))
        self.label[[self.number[d] for d, c in zip(docs, closed) if c]] = 0
        self.node = np.array([self.number[d] for d in docs])
        token = np.concatenate(self.seqs)
        row = np.repeat(np.arange(len(docs)), [len(x) for x in self.seqs])
        by = np.argsort(token, kind="stable")
        self.row, self.doc_of = row[by], np.array(docs, dtype=np.int64)
        self.token, self.at = np.unique(token[by], return_index=True)
        doc = self.doc_of[self.row]
        self.least_doc, self.most_doc = np.minimum.reduceat(doc, self.at), np.maximum.reduceat(doc, self.at)
        self.at = np.r_[self.at, len(token)]

    def add(self, doc: int) -> int:
        """The number of a text that searches the block."""
        if doc not in self.number:
            self.number[doc] = len(self.label)
            self.label = np.r_[self.label, len(self.label)]
        return self.number[doc]

    def passages(self, doc: int, lo: int, x: np.ndarray, least: int, threshold: float) -> list[tuple[int, ...]]:
        """(a, a_lo, a_hi, b, b_lo, b_hi): what other texts of the block share with the stretch.

        Texts in one component stand for each other once the stretch is covered."""
        need = least - spare_tokens(least, threshold) + 1
        if len(x) < least:
            return []
        k = np.minimum(np.searchsorted(self.token, x), len(self.token) - 1)
        known = (self.token[k] == x) & ((self.least_doc[k] != doc) | (self.most_doc[k] != doc))
        total = np.concatenate([[0], np.cumsum(known)])
        possible = total[least:] - total[:-least] >= need
        if not possible.any():
            return []
        at = np.flatnonzero(known)
        n = self.at[k[at] + 1] - self.at[k[at]]
        rows = self.row[np.repeat(self.at[k[at]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        counts = np.bincount(rows, minlength=len(self.docs))
        counts[self.doc_of == doc] = 0
        me, out = self.add(doc), []

        def verify(other: int, starts: np.ndarray) -> None:
            """Compares with a row; what is covered then is taken out of the (rows of) starts."""
            for p in shared_passages(self.seqs[other], x, least, threshold):
                out.append((self.docs[other], self.lows[other] + p[0], self.lows[other] + p[1], doc, lo + p[2], lo + p[3]))
                starts[..., max(0, p[2] - least + need) : max(0, p[3] + 2 - need)] = False
                a, b = self.label[me], self.label[self.node[other]]
                self.label[self.label == max(a, b)] = min(a, b)

        # mostly the row that shares most tokens covers all that can be, and the others are linked to it
        first = int(np.argmax(counts))
        if counts[first] < need:
            return []
        verify(first, possible)
        counts[first] = 0
        found = np.flatnonzero((counts >= need) & (possible.any() | (self.label[self.node] != self.label[me])))
        if not len(found):
            return out
        # which rows hold which tokens of x, and at which starts enough of them
        number = np.full(len(self.docs), -1)
        number[found] = np.arange(len(found))
        number = number[rows]
        holds = np.zeros((len(found), len(x) + 1), dtype=np.int32)
        holds[number[number >= 0], np.repeat(at, n)[number >= 0] + 1] = 1
        np.cumsum(holds, axis=1, out=holds)
        starts = holds[:, least:] - holds[:, :-least] >= need
        order = np.argsort(-starts.sum(axis=1), kind="stable")
        found, starts = found[order], starts[order]
        left, node = starts.any(axis=1), self.node[found]
        starts &= possible
        while len(again := np.flatnonzero(left & (starts.any(axis=1) | (self.label[node] != self.label[me])))):
            left[again[0]] = False
            verify(int(found[again[0]]), starts)
        return out


def merged_stretches(rows: DataFrame, by: list[str]) -> DataFrame:
    """(``by``, lo, hi): the stretches of a text joined where they overlap."""
    lists = rows.groupBy(*by).agg(F.array_sort(F.collect_set(F.struct(F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi")))).alias("w"))
    # the last stretch closes when the next one begins beyond it
    merged = F.expr(
        """aggregate(w, cast(array() as array<struct<lo:long,hi:long>>),
        (m, x) -> if(size(m) > 0 and element_at(m, -1).hi >= x.lo,
            concat(slice(m, 1, size(m) - 1), array(named_struct('lo', element_at(m, -1).lo, 'hi', greatest(element_at(m, -1).hi, x.hi)))),
            concat(m, array(x))))"""
    )
    return lists.select(*by, F.explode(merged).alias("m")).select(*by, "m.lo", "m.hi")


def block_passages(seqs: DataFrame, pending: DataFrame, places: DataFrame, least: int, threshold: float) -> DataFrame:
    """Verified passages between the open stretches ``pending`` (leader, doc_id, lo, hi) and all
    ``places`` (leader, doc_id, lo, hi) of their leader's groups: a query set against all rows, in
    blocks of bounded bytes; every pair of blocks is one small task."""
    open_ = materialize(merged_stretches(pending, ["leader", "doc_id"]), "open")
    marked = open_.select("leader", "doc_id").distinct().withColumn("opened", F.lit(True))
    pool = merged_stretches(places, ["leader", "doc_id"]).join(materialize(marked, "opened"), ["leader", "doc_id"], "left")
    pool = materialize(pool.withColumn("closed", F.col("opened").isNull()).drop("opened"), "pool")
    size = F.sum(F.col("hi") - F.col("lo") + 1) * 4
    blocks = lambda df, n: df.groupBy("leader").agg(F.ceil(size / F.lit(BLOCK_BYTES)).cast("int").alias(n))
    info = materialize(blocks(open_, "nq").join(blocks(pool, "np"), "leader"), "blocks")
    own = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cut = F.expr("substring(seq, cast(lo * 4 + 1 as int), cast((hi - lo + 1) * 4 as int))").alias("seq")
    cols = ["leader", "q", "p", "doc_id", "lo", "closed"]

    def dealt(df: DataFrame, q: Column, p: Column) -> DataFrame:
        return df.join(info, "leader").withColumn("q", q).withColumn("p", p).select(*cols, "hi").join(seqs, "doc_id").select(*(F.col(c).alias(c) for c in cols), cut)

    query = dealt(open_.withColumn("closed", F.lit(False)), own("nq"), all_of("np"))
    rows = dealt(pool, all_of("nq"), own("np"))

    def compare(query: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        if query.num_rows and rows.num_rows:
            col = lambda t, c: t.column(c).to_pylist()
            block = Block(col(rows, "doc_id"), col(rows, "lo"), col(rows, "seq"), col(rows, "closed"), col(rows, "leader")[0])
            for doc, lo, seq in zip(col(query, "doc_id"), col(query, "lo"), col(query, "seq")):
                found += block.passages(doc, lo, np.frombuffer(seq, dtype=np.uint32), least, threshold)
        cols = list(zip(*found)) if found else [()] * 6
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["a", "a_lo", "a_hi", "b", "b_lo", "b_hi"])

    by = ["leader", "q", "p"]
    return materialize(query.groupBy(*by).cogroup(rows.groupBy(*by)).applyInArrow(compare, "a long, a_lo long, a_hi long, b long, b_lo long, b_hi long"), "passages")


def spare_tokens(least: int, threshold: float) -> int:
    """Of ``least`` tokens, how many must be looked at until one of them is surely shared."""
    return least - ceil(round(2 * threshold / (1 + threshold) * least, 6)) + 1


def passage_links(docs: DataFrame, members: DataFrame, least: int = LEAST, threshold: float = THRESHOLD) -> DataFrame:
    """Verified passages (a, a_lo, a_hi, b, b_lo, b_hi) among texts that share keys; ``members``
    (key, doc_id, lo, hi).

    Each place of a key's group is compared with the first place of the group's leader. Only
    the stretches verified there are closed; all others, and the leader's further places, are
    compared with every place of the texts that the leader met."""
    first = F.min(F.struct("doc_id", "lo", "hi"))
    lead = members.groupBy("key").agg(first.alias("s"), F.max("doc_id").alias("last")).where("s.doc_id < last")
    lead = materialize(lead.select("key", F.col("s.doc_id").alias("a"), F.col("s.lo").alias("a_lo"), F.col("s.hi").alias("a_hi")), "leaders")
    met = materialize(members.join(lead, "key").select("a", "a_lo", "a_hi", F.col("doc_id").alias("b"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi")), "met")
    found = segments(met.where("a <> b"))
    ids = materialize(found.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    seqs = materialize(token_seqs(only_ids(docs, ids)).dropDuplicates(["doc_id"]), "seqs")
    checked = verified_passages(found, seqs, least, threshold)
    links = checked.where("linked").drop("linked")
    further = materialize(met.where("a = b AND (a_lo <> b_lo OR a_hi <> b_hi)").select(F.col("a").alias("leader"), F.col("b").alias("doc_id"), F.col("b_lo").alias("lo"), F.col("b_hi").alias("hi")).distinct(), "further")
    side = lambda df, x: df.select(F.col("a").alias("leader"), F.col(x).alias("doc_id"), F.col(f"{x}_lo").alias("lo"), F.col(f"{x}_hi").alias("hi"))
    pending = materialize(side(checked.where("NOT linked"), "b").unionByName(further), "pending")
    places = side(found, "b").unionByName(side(found, "a")).unionByName(further)
    places = places.join(materialize(pending.select("leader").distinct(), "leaders"), "leader", "left_semi")
    more = block_passages(seqs, pending, places, least, threshold)
    return links.unionByName(more)


def passage_spans(links: DataFrame) -> DataFrame:
    """(doc_id, start_word, end_word): the merged passages of each text, of (doc_id, s, e).

    Starts and ends are counted by place first, so that what comes together for a text is no
    longer than the text, however many partners it has."""
    edges = links.select("doc_id", F.explode(F.array(F.struct(F.col("s").alias("at"), F.lit(1).alias("d")), F.struct(F.col("e").alias("at"), F.lit(-1).alias("d")))).alias("x"))
    counted = edges.groupBy("doc_id", "x.at").agg(F.sum("x.d").alias("d"))
    lists = counted.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "d"))).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                depth, start = 0, 0
                for x in w:
                    if not depth:
                        start = x["at"]
                    depth += x["d"]
                    if not depth and x["at"] > start:
                        out.append((doc, start, x["at"]))
            cols = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start_word", "end_word"])

    return map_arrow(lists.select("doc_id", "w"), run, "doc_id long, start_word long, end_word long")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage_words: int = PASSAGE_WORDS, threshold: float = THRESHOLD, hashes: int = HASHES) -> DataFrame:
    """One row per repeated passage of each document: doc_id, start_word, end_word (excluded),
    n_words, n_links (texts it was verified against), partner_id (the smallest of them), class_id
    and class_start (document and first word of the first passage of its class). A class is a
    connected component of the verified links; texts of equal words are one passage each."""
    least = passage_words - SHINGLE + 1
    plain = with_text(docs, id_col, text_col).where("doc_id IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            h, off = word_hashes([t.encode() for t in b.column(1).to_pylist()])
            keys = [hashlib.blake2b(h[i:j].tobytes(), digest_size=16).digest() for i, j in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(np.diff(off))], ["doc_id", "key", "n"])

    keyed = materialize(map_arrow(plain, run, "doc_id long, key binary, n long"), "keys").where(F.col("n") >= passage_words)
    groups = materialize(keyed.groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("top"), F.countDistinct("doc_id").alias("size")).where("rep < top"), "groups")
    copies = materialize(keyed.join(groups, "key").select("doc_id", "n", "rep", "top", "size").distinct(), "copies")
    others = materialize(copies.where("doc_id <> rep").select("doc_id").distinct(), "ids")
    reps = only_ids(plain, others, "left_anti")
    members = materialize(joined_windows(repeated_windows(reps, hashes, least), least), "joined")
    links = passage_links(reps, members, least, threshold)
    # a text that has copies is one passage as a whole
    whole = copies.where("doc_id = rep").select("doc_id", F.lit(0).cast("long").alias("s"), F.col("n").alias("e"), F.col("doc_id").alias("partner"))
    sides = [links.select(F.col(x).alias("doc_id"), F.col(f"{x}_lo").alias("s"), (F.col(f"{x}_hi") + SHINGLE).alias("e"), F.col(y).alias("partner"), F.col(f"{y}_lo").alias("partner_s")) for x, y in (("a", "b"), ("b", "a"))]
    ends = materialize(sides[0].unionByName(sides[1]), "ends")
    spans = materialize(passage_spans(ends.select("doc_id", "s", "e").unionByName(whole.select("doc_id", "s", "e")).distinct()), "spans")
    inside = lambda at: (F.col(at) >= F.col("start_word")) & (F.col(at) < F.col("end_word"))
    placed = materialize(ends.join(spans, "doc_id").where(inside("s")).select("doc_id", "start_word", "partner", "partner_s"), "placed")
    near = placed.select("doc_id", "start_word", "partner").distinct().groupBy("doc_id", "start_word").agg(F.min("partner").alias("partner"), F.count(F.lit(1)).alias("links"))
    other = spans.select(F.col("doc_id").alias("partner"), F.col("start_word").alias("other_start"), F.col("end_word").alias("other_end"))
    node = lambda d, s: F.xxhash64(d, s)
    edges = placed.where("doc_id < partner").join(other, "partner").where("partner_s >= other_start AND partner_s < other_end")
    labels = components(edges.select(node("doc_id", "start_word").alias("a"), node("partner", "other_start").alias("b")).distinct())
    noded = materialize(spans.withColumn("node", node("doc_id", "start_word")).join(labels.withColumnRenamed("doc_id", "node"), "node", "left").withColumn("label", F.coalesce("label", "node")).drop("node"), "noded")
    first = materialize(noded.groupBy("label").agg(F.min(F.struct("doc_id", "start_word")).alias("f")).select("label", F.col("f.doc_id").alias("class_id"), F.col("f.start_word").alias("class_start")), "classes")
    size = copies.where("doc_id = rep").select("doc_id", F.col("top"), (F.col("size") - 1).alias("more"))
    found = noded.join(first, "label").join(near, ["doc_id", "start_word"], "left").join(size, "doc_id", "left")
    found = materialize(
        found.select(
            "doc_id",
            "start_word",
            "end_word",
            (F.col("end_word") - F.col("start_word")).alias("n_words"),
            (F.coalesce("links", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_links"),
            F.coalesce(F.least("partner", "top"), "partner", "top").alias("partner_id"),
            "class_id",
            "class_start",
        ),
        "found",
    )
    same = found.select(F.col("doc_id").alias("rep"), *(c for c in found.columns if c not in ("doc_id", "partner_id")))
    again = copies.where("doc_id <> rep").select("doc_id", "rep").join(same, "rep").withColumn("partner_id", F.col("rep")).drop("rep")
    return found.unionByName(again)
