"""Helpers shared by the operators: column hygiene, Arrow batches, size-checked joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that a worker holds as arrays at once.
CHUNK_BYTES = 1 << 19
#: A set of ids is broadcast up to this many rows (16 bytes a row), and shuffled beyond.
BROADCAST_IDS = 1_000_000


def _word_table() -> bytes:
    """Maps A-Z to a-z and every ASCII byte that isn't a letter or digit to a space."""
    out = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        out[b] = ord(c.lower()) if c.isalnum() else 32
    return bytes(out)


#: For ``bytes.translate``: the words are then what ``split()`` gives.
WORD_TABLE = _word_table()
#: For ``bytes.translate``: lower-cases A-Z only.
LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text, in UTF-8."""
    return (text or "").encode().translate(WORD_TABLE).split()


def with_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names: other columns can't clash or cost a read."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each holds about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        size = np.cumsum(np.asarray(pc.binary_length(col).fill_null(0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow``; a seam for tests and for a single place to change."""
    return df.mapInArrow(fn, schema)


def only_ids(docs: DataFrame, ids: DataFrame, how: str = "left_semi", limit: int = BROADCAST_IDS, id_col: str = "doc_id") -> DataFrame:
    """``docs`` whose id is (or with ``left_anti`` isn't) in the materialized ``ids`` (doc_id).

    The ids are counted first: up to ``limit`` rows they are broadcast, so that no text
    is shuffled; beyond it a shuffled join does the same.
    """
    small = ids.limit(limit + 1).count() <= limit
    named = ids.select(F.col("doc_id").alias("_only_id"))
    return docs.join(F.broadcast(named) if small else named.hint("merge"), docs[id_col] == F.col("_only_id"), how)


def add_column(df: DataFrame, text_col: str, name: str, kind: str, arrow: pa.DataType, make: Callable[[], Callable[[str], object]]) -> DataFrame:
    """``df`` with a column computed from each whole text (null: empty), in one pass without a join.

    ``make`` runs once in a worker and returns the function of a text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in chunks(batches, text_col):
            got = [fn(t or "") for t in b.column(b.schema.get_field_index(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, arrow)], [*b.schema.names, name])

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, `{name}` {kind}")
