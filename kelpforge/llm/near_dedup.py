"""Near-duplicate documents by ProbMinHash signatures.

A document is the weighted set of its word 5-shingles, weight being the number of times a
shingle occurs. Each shingle's arrivals form a Poisson process whose rate is its weight; every
arrival falls on a random register, which keeps its earliest arrival's shingle (Ertl, 2020,
ProbMinHash1). Arrivals are drawn in rounds, for all texts of a chunk at once, and a shingle
stops as soon as its next arrival is later than all registers of its text (early termination).
Two registers agree with the probability Jaccard of both sets.

1. Rows of equal word sequences are one class; only one of them goes on.
2. Signatures are cut into bands; texts that share a band are candidates. In each group a
   leader (the member that shares most bands with others, so the middle of a star of copies)
   is compared with all members: a star, not all pairs. Members that aren't in the leader's
   component afterwards are a query set against all members of the leader's groups, in blocks
   of bounded bytes (``open_links``); only links that join two components are written.
3. A pair is first screened by its signatures (standard deviation of the estimate at the
   threshold: 0.037; a pair goes if it is more than 0.2 below) and then verified: the exact
   probability Jaccard of both texts must reach the threshold.
4. Classes are the connected components of the verified links.

With 24 bands of 5 registers a pair at 0.8 shares a band with probability 0.9999.

Defined cases: texts of fewer than five words have one shingle, all their words; texts without
words (null included) are never near-duplicates; a null doc_id is a class of its own without
an id; rows that repeat an id count as one document; an empty table gives an empty result;
other columns are ignored. Among equals the smallest id names the class and is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpforge.llm.common import chunks, map_arrow, only_ids, with_text
from kelpforge.llm.graph import components
from kelpforge.llm.tokens import mix, shingle_hashes, word_hashes
from kelpforge.session import materialize

BANDS, ROWS, THRESHOLD = 24, 5, 0.8
#: Bytes of signatures and shingles of one block of a group.
BLOCK_BYTES = 1 << 21


def weighted_shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, weight) of all texts, ordered by text and shingle."""
    h, off, _ = shingle_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(off))
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.r_[at, len(h)])


def prob_minhash(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (n texts by m registers) of weighted sets; zeros where a set is empty."""
    best = np.full(n * m, np.inf)
    ids = np.zeros(n * m, dtype=np.uint64)
    time = np.zeros(len(shingle))
    doc, shingle, rate = doc.astype(np.int64), shingle, weight.astype(float)
    r = 0
    while len(shingle):
        u = ((mix(shingle, 2 * r + 11) >> np.uint64(11)).astype(float) + 1) / 2.0**53
        time = time - np.log(u) / rate
        cell = doc * m + (mix(shingle, 2 * r + 12) % np.uint64(m)).astype(np.int64)
        np.minimum.at(best, cell, time)
        won = best[cell] == time
        ids[cell[won]] = shingle[won]
        last = best.reshape(n, m).max(axis=1)
        live = time < last[doc]
        doc, shingle, rate, time = doc[live], shingle[live], rate[live], time[live]
        r += 1
    return ids.reshape(n, m)


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature; equal only in the same band."""
    acc = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], len(sig), axis=0)
    parts = sig[:, : bands * rows].reshape(len(sig), bands, rows)
    for k in range(rows):
        acc = mix(acc ^ parts[:, :, k], 5)
    return acc


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """The exact probability Jaccard of two weighted sets, given as sorted distinct elements."""
    both, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = wa[ia].astype(float), wb[ib].astype(float)
    only_a, only_b = float(wa.sum()) - x.sum(), float(wb.sum()) - y.sum()
    ratios, n = np.unique(np.stack([x, y]), axis=1, return_counts=True)
    p, q = ratios
    shared = (np.maximum(p[None, :] / p[:, None], q[None, :] / q[:, None]) * n[None, :]).sum(axis=1)
    return float((n / (shared + only_a / p + only_b / q)).sum())


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, key, bands, sig) of (doc_id, text): digest of the word sequence (null without
    words), band keys, signature as 32-bit numbers."""
    m = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            texts = [t.encode() for t in b.column(1).to_pylist()]
            h, off = word_hashes(texts)
            keys = [hashlib.blake2b(h[i:j].tobytes(), digest_size=16).digest() if j > i else None for i, j in zip(off[:-1], off[1:])]
            sig = prob_minhash(*weighted_shingles(texts), len(texts), m)
            keyed = band_hashes(sig, bands, rows).view(np.int64)
            lists = pa.array([k.tolist() if key else [] for k, key in zip(keyed, keys)], pa.list_(pa.int64()))
            small = sig.astype(np.uint32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), lists, pa.array([s.tobytes() for s in small], pa.binary())], ["doc_id", "key", "bands", "sig"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, key binary, bands array<long>, sig binary")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, set, weights) of (doc_id, text): sorted 64-bit shingles, and their weights
    (null if all are 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            doc, h, w = weighted_shingles([t.encode() for t in b.column(1).to_pylist()])
            at = np.searchsorted(doc, np.arange(b.num_rows + 1))
            sets = [h[i:j].tobytes() for i, j in zip(at[:-1], at[1:])]
            weights = [None if (w[i:j] == 1).all() else w[i:j].astype(np.int32).tobytes() for i, j in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary()), pa.array(weights, pa.binary())], ["doc_id", "set", "weights"])

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, set binary, weights binary")


def _screen(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), dtype=np.uint32).reshape(b.num_rows, -1) for k in (2, 3))
            yield b.filter(pa.array((x == y).mean(axis=1) >= least)).select(["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    def parts(s: bytes, w: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        x = np.frombuffer(s, dtype=np.uint64)
        return x, np.frombuffer(w, dtype=np.int32) if w is not None else np.ones(len(x), dtype=np.int32)

    for b in batches:
        for k in range(0, b.num_rows, 128):
            c = b.slice(k, 128)
            sim = [probability_jaccard(*parts(sa, wa), *parts(sb, wb)) for sa, wa, sb, wb in zip(*(c.column(i).to_pylist() for i in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([c.column(0), c.column(1), pa.array(sim, pa.float64())], ["a", "b", "similarity"]).filter(pa.array(np.array(sim) >= threshold))


def verified(pairs: DataFrame, sigs: DataFrame, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, similarity) of the pairs (a, b) that reach the threshold, materialized."""
    side = lambda t, name, cols: t.select(F.col("doc_id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in cols))
    signed = pairs.join(side(sigs, "a", ["sig"]), "a").join(side(sigs, "b", ["sig"]), "b").select("a", "b", "sig_a", "sig_b")
    likely = materialize(map_arrow(signed, lambda it: _screen(it, threshold - 0.2), "a long, b long"), "likely")
    ids = materialize(likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    sets = materialize(shingle_sets(only_ids(docs, ids)).dropDuplicates(["doc_id"]), "sets")
    cols = ["set", "weights"]
    full = likely.join(side(sets, "a", cols), "a").join(side(sets, "b", cols), "b").select("a", "b", "set_a", "weights_a", "set_b", "weights_b")
    return materialize(map_arrow(full, lambda it: _verify(it, threshold), "a long, b long, similarity double"), "links")


def block_links(query: pa.Table, pool: pa.Table, threshold: float) -> list[tuple[int, int]]:
    """Verified links between two blocks of (doc_id, label, sig, set, weights): of all pairs that
    reach the threshold, enough to join the labels that they join."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    def card(t: pa.Table) -> tuple:
        ids, labels = t.column("doc_id").to_pylist(), t.column("label").to_pylist()
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), dtype=np.uint32).reshape(len(ids), -1)
        sets = [np.frombuffer(x, dtype=np.uint64) for x in t.column("set").to_pylist()]
        weights = [None if x is None else np.frombuffer(x, dtype=np.int32) for x in t.column("weights").to_pylist()]
        return ids, labels, sig, sets, weights

    qi, ql, qs, q_sets, q_w = card(query)
    pi, pl, ps, p_sets, p_w = card(pool)
    size = np.array([len(x) for x in p_sets], dtype=np.int64)
    plain = np.array([w is None for w in p_w])
    token = np.concatenate(p_sets) if p_sets else np.zeros(0, dtype=np.uint64)
    by = np.argsort(token, kind="stable")
    token, owner = token[by], np.repeat(np.arange(len(pi)), size)[by]
    heavy = lambda w, x: w if w is not None else np.ones(len(x), dtype=np.int32)
    out = []
    for i, x in enumerate(q_sets):
        agree = (ps == qs[i]).mean(axis=1)
        near = np.flatnonzero(agree >= threshold - 0.2)
        near = near[np.argsort(-agree[near], kind="stable")]
        exact = None
        for tried, j in enumerate(near.tolist()):
            a, b = root(ql[i]), root(pl[j])
            if a == b:
                continue
            if tried > 8 and exact is None and q_w[i] is None:  # all at once, by the places of x's shingles
                lo, hi = np.searchsorted(token, x, "left"), np.searchsorted(token, x, "right")
                n = hi - lo
                at = np.repeat(hi - np.cumsum(n), n) + np.arange(int(n.sum()))
                both = np.bincount(owner[at], minlength=len(pi))
                exact = both / (size + len(x) - both)
            if exact is not None and plain[j]:
                sim = exact[j]
            else:
                sim = probability_jaccard(x, heavy(q_w[i], x), p_sets[j], heavy(p_w[j], p_sets[j]))
            if sim >= threshold:
                parent[max(a, b)] = min(a, b)
                out.append((qi[i], pi[j]))
    return out


def open_links(docs: DataFrame, met: DataFrame, labels: DataFrame, sigs: DataFrame, threshold: float) -> DataFrame:
    """Links of the members that aren't in their leader's component; ``met`` (doc_id, leader).

    Two members of a leader's group can only be in one class unnoticed if one of them is open.
    Open members are a query set against the whole group, in blocks of bounded bytes: every pair
    of blocks is one small task, and only links that join two components come out of it."""
    of = lambda x: labels.select(F.col("doc_id").alias(x), F.col("label").alias(f"of_{x}"))
    judged = met.join(of("doc_id"), "doc_id", "left").join(of("leader"), "leader", "left")
    judged = materialize(judged.select("leader", "doc_id", F.coalesce("of_doc_id", "doc_id").alias("label"), (F.coalesce("of_doc_id", "doc_id") != F.coalesce("of_leader", "leader")).alias("open")), "judged")
    groups = judged.groupBy("leader").agg(F.count_if("open").alias("n_open"), F.count(F.lit(1)).alias("n")).where("n_open > 0 AND n > 1")
    rest = materialize(judged.join(materialize(groups, "groups").select("leader"), "leader"), "rest")
    ids = materialize(rest.select("doc_id").distinct(), "ids")
    cards = materialize(shingle_sets(only_ids(docs, ids)).dropDuplicates(["doc_id"]).join(sigs, "doc_id").withColumn("bytes", F.length("set") + F.coalesce(F.length("weights"), F.lit(0)) + F.length("sig")), "cards")
    sized = materialize(rest.join(cards.select("doc_id", "bytes"), "doc_id"), "sized")
    blocks = lambda c: F.ceil(F.sum(c) / F.lit(BLOCK_BYTES)).cast("int")
    info = materialize(sized.groupBy("leader").agg(blocks(F.when(F.col("open"), F.col("bytes"))).alias("nq"), blocks("bytes").alias("np")), "blocks")
    rows = materialize(sized.drop("bytes").join(info, "leader"), "dealt").join(cards.drop("bytes"), "doc_id")
    own = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["leader", "q", "p", "doc_id", "label", "sig", "set", "weights"]
    query = rows.where("open").withColumn("q", own("nq")).withColumn("p", all_of("np")).select(*cols)
    pool = rows.withColumn("p", own("np")).withColumn("q", all_of("nq")).select(*(F.col(c).alias(c) for c in cols))

    def compare(query: pa.Table, pool: pa.Table) -> pa.Table:
        found = block_links(query, pool, threshold) if query.num_rows and pool.num_rows else []
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    by = ["leader", "q", "p"]
    return materialize(query.groupBy(*by).cogroup(pool.groupBy(*by)).applyInArrow(compare, "a long, b long"), "links")


def near_links(docs: DataFrame, members: DataFrame, sigs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified links (a, b) among the members (band, doc_id) of band groups: enough of them for
    the components of all links. Tables that are joined by a key that a group shares are written
    before, so that a join's skewed partitions can be split."""
    sizes = materialize(members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    shared = materialize(members.join(sizes, "band"), "members")
    score = shared.groupBy("doc_id").agg(F.sum("n").alias("score"))
    pool = materialize(shared.join(score, "doc_id").select("band", "doc_id", "score"), "pool")
    # a leader is the middle of its star: the member that shares most bands with others
    first = F.max(F.struct("score", (-F.col("doc_id")).alias("id")))
    top = materialize(pool.groupBy("band").agg(first.alias("t")).select("band", (-F.col("t.id")).alias("leader")), "top")
    met = materialize(pool.join(top, "band").where("doc_id <> leader").select("doc_id", "leader").distinct(), "met")
    pairs = materialize(met.select(F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b")).distinct(), "pairs")
    links = verified(pairs, sigs, docs, threshold).select("a", "b")
    return links.unionByName(open_links(docs, met, components(links), sigs, threshold))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept."""
    plain = with_text(docs, id_col, text_col)
    sketch = materialize(sketches(plain, bands, rows), "sketches")
    ids = sketch.where("doc_id IS NOT NULL")
    keyed = ids.where("key IS NOT NULL")
    groups = materialize(keyed.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1"), "groups")
    copies = materialize(keyed.select("doc_id", "key").join(groups, "key").select("doc_id", "rep").where("doc_id <> rep").distinct(), "copies")
    reps = only_ids(keyed, materialize(copies.select("doc_id").distinct(), "ids"), "left_anti")
    reps = materialize(reps.select("doc_id", "bands", "sig").dropDuplicates(["doc_id"]), "reps")
    members = materialize(reps.select(F.explode("bands").alias("band"), "doc_id").distinct(), "bands")
    links = near_links(plain, members, reps.select("doc_id", "sig"), threshold)
    labels = components(links.unionByName(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))))
    out = materialize(ids.select("doc_id").join(labels, "doc_id", "left").select("doc_id", F.coalesce("label", "doc_id").alias("class_id")), "classes")
    sizes = materialize(out.distinct().groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size")).where("class_size > 1"), "sizes")
    done = out.join(sizes, "class_id", "left").select("doc_id", "class_id", F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), (F.col("doc_id") == F.col("class_id")).alias("kept"))
    return done.unionByName(sketch.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")))
