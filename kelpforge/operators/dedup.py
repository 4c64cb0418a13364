"""First-wins and layered dedup."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], order: str, count: str | None = None) -> DataFrame:
    """The row of each key that comes first by ``order`` (unique), as an aggregate.

    ``min_by`` combines on the map side, so a hot key moves one row per task, where a
    ``row_number`` window would bring all its rows to one task. ``count`` names an extra
    column with the group's size.
    """
    rest = [c for c in df.columns if c not in keys]
    aggs = [F.min_by(F.struct(*rest), F.col(order)).alias("_first")]
    if count:
        aggs.append(F.count(F.lit(1)).cast("long").alias(count))
    got = df.groupBy(*keys).agg(*aggs)
    return got.select(*keys, *(F.col(f"_first.{c}").alias(c) for c in rest), *([count] if count else []))


def layered_dedup(df: DataFrame, order: str, episode: str, problem: str, code: str, mutation: str, signature: str, variant: list[str], per_signature: int = 2) -> DataFrame:
    """Rows with a ``dedup_reason`` (null: kept), layer by layer in arrival order.

    A row goes if its episode id was kept before; else if (problem, code) was; else if
    (problem, mutation set) was, where there is one; else if its failure signature was kept
    ``per_signature`` times in the problem; else if that signature was kept with the same
    ``variant``. Keys are claimed by kept rows only, so a row that one layer rejects blocks no
    later row in another. The layers depend on each other and on the order, so each problem is
    folded sequentially: only keys travel, Spark sorts them (and spills), and a task holds the
    keys that one problem has kept, never its rows. The rows are joined back by ``order`` (unique).
    """
    slim = df.select(F.col(problem).alias("_p"), F.col(order).alias("_o"), F.col(episode).alias("_e"), F.col(code).alias("_c"), F.col(mutation).alias("_m"), F.col(signature).alias("_s"), F.to_json(F.struct(*variant), {"ignoreNullFields": "false"}).alias("_v"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: object = fold  # no problem yet
        for b in batches:
            reasons = []
            for p, _, e, c, m, s, v in zip(*(col.to_pylist() for col in b.columns)):
                if p != now:
                    now, kept = p, Counter()
                claims = {"duplicate_episode": (("e", e), 1), "duplicate_code": (("c", c), 1)}
                if m is not None:
                    claims["duplicate_mutation_set"] = ("m", m), 1
                if s is not None:
                    claims |= {"signature_limit": (("s", s), per_signature), "duplicate_variant": (("v", s, v), 1)}
                why = next((reason for reason, (key, most) in claims.items() if kept[key] >= most), None)
                if why is None:
                    kept.update(key for key, _ in claims.values())
                reasons.append(why)
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(reasons, pa.string())], [order, "dedup_reason"])

    kind = df.schema[order].dataType.simpleString()
    judged = slim.repartition("_p").sortWithinPartitions("_p", "_o").mapInArrow(fold, f"`{order}` {kind}, dedup_reason string")
    return df.join(judged, order)
