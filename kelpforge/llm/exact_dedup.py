"""Exact dedup of a batch against an immutable snapshot.

A snapshot never changes once written, so its digests can be put into static binary-fuse
filters (Graf and Lemire, 2022), one for each bucket of the digest space. A batch is first
grouped by its own digests (SHA-256 of the normalised text); the digests are then screened
by the snapshot's filters, bucket by bucket. Digests that no filter knows are new. Positives
join the snapshot's exact bucket rows, and the bytes of both texts are compared before they
count as one text; false positives find no partner there.

Only digests and ids are shuffled. Texts move for the positives alone (a size-checked
broadcast of their ids, or a shuffled join beyond the bound).

Defined cases: null text counts as empty and empty texts equal each other; a null doc_id never
wins against a number, and rows of a group without any id all stay; repeated rows (same id, same
text) count as members; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpforge.llm.common import BROADCAST_IDS, LOWER_TABLE, add_column, chunks, map_arrow, only_ids, with_text
from kelpforge.llm.tokens import mix
from kelpforge.session import materialize

#: Digests that one filter holds on average; a filter is then about 1.2 MB.
BUCKET_DIGESTS = 1_000_000


class BinaryFuse8:
    """A static 3-wise binary-fuse filter over distinct 64-bit keys, 8 bits a fingerprint."""

    def __init__(self, seed: int, segment: int, count: int, prints: np.ndarray):
        self.seed, self.segment, self.count, self.prints = seed, segment, count, prints

    @staticmethod
    def _shape(n: int) -> tuple[int, int]:
        """(length of a segment, a power of two; number of segments that a key can start in)."""
        length = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        return length, max(1, -(-int(n * factor) // length) - 2)

    @staticmethod
    def _places(h: np.ndarray, segment: int, count: int) -> np.ndarray:
        """The three cells of every key: one in each of three neighbouring segments."""
        first = ((h >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        base = first * np.uint64(segment)
        return np.stack([base + (h & mask), base + np.uint64(segment) + ((h >> np.uint64(18)) & mask), base + np.uint64(2 * segment) + ((h >> np.uint64(9) ^ h >> np.uint64(40)) & mask)]).astype(np.int64)

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse8:
        """From uint64 keys; peels the cells that one key alone uses, in whole rounds."""
        keys = np.unique(keys)
        segment, count = cls._shape(len(keys))
        for seed in range(100):
            if seed and seed % 10 == 0:
                count += max(1, count // 8)
            h = mix(keys, seed)
            at = cls._places(h, segment, count)
            cells = (count + 2) * segment
            degree = np.bincount(at.ravel(), minlength=cells)
            xored = np.zeros(cells, dtype=np.int64)
            index = np.arange(len(keys), dtype=np.int64)
            for row in at:
                np.bitwise_xor.at(xored, row, index)
            order: list[tuple[np.ndarray, np.ndarray]] = []
            left = len(keys)
            single = np.flatnonzero(degree == 1)
            while len(single):
                key, first = np.unique(xored[single], return_index=True)
                order.append((key, single[first]))
                left -= len(key)
                for row in at[:, key]:
                    np.subtract.at(degree, row, 1)
                    np.bitwise_xor.at(xored, row, key)
                touched = np.unique(at[:, key])
                single = touched[degree[touched] == 1]
            if left:
                continue
            prints, own = np.zeros(cells, dtype=np.uint8), cls._print(h)
            for key, cell in reversed(order):
                x = at[:, key]
                prints[cell] = own[key] ^ prints[x[0]] ^ prints[x[1]] ^ prints[x[2]] ^ prints[cell]
            return cls(seed, segment, count, prints)
        raise ValueError("no seed gives a filter; are the keys distinct?")

    def contains(self, keys: np.ndarray) -> np.ndarray:
        """For each key whether it may be in the set; never False for a member."""
        h = mix(keys, self.seed)
        at = self._places(h, self.segment, self.count)
        return self._print(h) == self.prints[at[0]] ^ self.prints[at[1]] ^ self.prints[at[2]]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest): SHA-256 of every whole text after lower-casing A-Z."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            out = [hashlib.sha256(t.encode().translate(LOWER_TABLE)).digest() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "digest"])

    return map_arrow(with_text(docs, id_col, text_col), run, "doc_id long, digest binary")


def _classes(keyed: DataFrame) -> DataFrame:
    """One row for each digest: its largest id and its number of rows."""
    return keyed.groupBy("digest").agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))


def _key64(col: pa.Array) -> np.ndarray:
    """The first eight bytes of every digest."""
    return np.frombuffer(b"".join(x[:8] for x in col.to_pylist()), dtype=">u8").astype(np.uint64)


def build_filters(classes: DataFrame, buckets: int) -> DataFrame:
    """(bucket, seed, segment, count, prints): the static filter of each bucket of a snapshot."""

    def build(pdf: pa.Table) -> pa.Table:
        f = BinaryFuse8.build(_key64(pdf.column("digest").combine_chunks()))
        return pa.table({"bucket": pdf.column("bucket")[:1], "seed": pa.array([f.seed], pa.int32()), "segment": pa.array([f.segment], pa.int32()), "count": pa.array([f.count], pa.int32()), "prints": pa.array([f.prints.tobytes()], pa.binary())})

    return classes.select(_bucket(buckets), "digest").groupBy("bucket").applyInArrow(build, "bucket int, seed int, segment int, count int, prints binary")


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket")


def screen(classes: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """The rows of ``classes`` whose digest the filter of its bucket may hold."""
    schema = "digest binary, top long, n long"

    def test(left: pa.Table, right: pa.Table) -> pa.Table:
        out = left.select(["digest", "top", "n"])
        if not right.num_rows or not left.num_rows:
            return out.slice(0, 0)
        r = right.to_pylist()[0]
        f = BinaryFuse8(r["seed"], r["segment"], r["count"], np.frombuffer(r["prints"], dtype=np.uint8))
        return out.filter(pa.array(f.contains(_key64(left.column("digest").combine_chunks()))))

    return classes.select(_bucket(buckets), "digest", "top", "n").groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(test, schema)


def dedup_against(snapshot: DataFrame, batch: DataFrame, texts: DataFrame, bucket_digests: int = BUCKET_DIGESTS) -> DataFrame:
    """Classes of equal texts over a snapshot and a batch: digest, keep_id, group_size.

    ``snapshot`` and ``batch`` are (doc_id, digest) tables, ``texts`` the documents that they
    come from. A class in both has the larger of the two largest ids and the sum of sizes.
    """
    known, new = materialize(_classes(snapshot), "known"), materialize(_classes(batch), "new")
    buckets = max(1, -(-max(known.count(), new.count()) // bucket_digests))
    filters = materialize(build_filters(known, buckets), "filters")
    positives = screen(new, filters, buckets)
    s = known.select("digest", F.col("top").alias("known_top"), F.col("n").alias("known_n"))
    pairs = materialize(positives.join(s, "digest"), "positives")
    ids = pairs.select(F.explode(F.array("top", "known_top")).alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    rows = only_ids(with_text(texts, "doc_id", "text"), materialize(ids, "ids"))
    bytes_of = map_arrow(rows, _normalised, "doc_id long, bytes binary, digest binary").dropDuplicates(["doc_id", "digest"])
    left = bytes_of.select(F.col("doc_id").alias("top"), "digest", F.col("bytes").alias("a"))
    right = bytes_of.select(F.col("doc_id").alias("known_top"), "digest", F.col("bytes").alias("b"))
    joined = pairs.join(left, ["top", "digest"], "left").join(right, ["known_top", "digest"], "left")
    # a class without any id has no text to fetch and stands on its digest alone
    same = F.coalesce(F.col("a") == F.col("b"), F.lit(True))
    matched = materialize(joined.where(same).select("digest", F.greatest("top", "known_top").alias("keep_id"), (F.col("n") + F.col("known_n")).alias("group_size")), "matched")
    alone = known.unionByName(new).join(matched.select("digest"), "digest", "left_anti")
    return matched.unionByName(alone.select("digest", F.col("top").alias("keep_id"), F.col("n").alias("group_size")))


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunks(batches):
        raw = [t.encode().translate(LOWER_TABLE) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary())], ["doc_id", "bytes", "digest"])


def exact_groups(keyed: DataFrame, texts: DataFrame, snapshot_until: int | None = None) -> DataFrame:
    """(digest, keep_id, group_size) of the classes of two rows or more, materialized; ``keyed`` is
    (doc_id, digest) of the ``texts``."""
    if snapshot_until is None:
        lo, hi = keyed.agg(F.min("doc_id"), F.max("doc_id")).first()
        snapshot_until = 0 if lo is None else (lo + hi) // 2
    old = F.coalesce(F.col("doc_id") <= F.lit(snapshot_until), F.lit(False))
    return materialize(dedup_against(keyed.where(old), keyed.where(~old), texts).where("group_size > 1"), "groups")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", snapshot_until: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Ids are taken in order of arrival: documents up to ``snapshot_until`` (default: the middle
    of the range of ids) are the immutable snapshot, later ones and those without an id the
    batch. The result is the same for every cut.
    """
    plain = with_text(docs, id_col, text_col)
    keyed = materialize(digests(plain), "digests")
    groups = exact_groups(keyed, plain, snapshot_until)
    return keyed.join(groups, "digest", "left").select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.coalesce("keep_id", "doc_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of equal texts, that of the largest id.

    Rows are judged one by one, by the digest of their own text: of rows that share the largest
    id, or of a class without any id, one row stays. Only rows of repeated texts are shuffled.
    """
    plain = with_text(docs, id_col, text_col)
    groups = exact_groups(materialize(digests(plain), "digests"), plain)
    small = groups.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    side = groups.select(F.col("digest").alias("_of"), "keep_id", F.lit(True).alias("_repeated"))
    marked = add_column(docs, text_col, "_digest", "binary", pa.binary(), lambda: lambda t: hashlib.sha256(t.encode().translate(LOWER_TABLE)).digest())
    judged = marked.join(F.broadcast(side) if small else side, F.col("_digest") == F.col("_of"), "left")
    once = judged.where("_repeated IS NULL").select(*docs.columns)
    stay = judged.where(F.col("_repeated") & F.col(id_col).cast("long").eqNullSafe(F.col("keep_id")))
    return once.unionByName(stay.dropDuplicates(["_digest"]).select(*docs.columns))
