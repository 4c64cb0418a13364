"""Splits and samples: hash ranks, first n, coverage, and quota-capped greedy selection."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpforge.functions.apportion import split_table
from kelpforge.functions.hashing import rank_key


def top_by(df: DataFrame, stratum: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each stratum. Spark keeps n rows of each group per task before
    the shuffle (WindowGroupLimit), so a hot stratum moves little."""
    w = Window.partitionBy(stratum).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def hash_rank_sample(df: DataFrame, stratum: str, id_col: str, salt: str, n: int) -> DataFrame:
    """``n`` rows of each stratum by the hash of salt and id: seeded, and independent of order."""
    return top_by(df, stratum, [rank_key(salt, id_col), F.col(id_col)], n)


def stratified_split(df: DataFrame, stratum: str, id_col: str, ratios: Mapping[str, float], seed: int) -> DataFrame:
    """Each row's pool; pool totals are exact and each stratum is within one of its share.

    The sizes of the strata (one row each) go to the driver, where the integer table is made;
    a row's rank inside its stratum then falls into one pool's interval.
    """
    sizes = {r[0]: r[1] for r in df.groupBy(stratum).agg(F.count(F.lit(1))).collect()}
    cells = split_table({str(k): n for k, n in sizes.items()}, ratios)
    bounds = []
    for s in sizes:
        lo = 0
        for p in ratios:
            bounds.append((s, p, lo, lo + cells[(str(s), p)]))
            lo += cells[(str(s), p)]
    kind = df.schema[stratum].dataType.simpleString()
    table = df.sparkSession.createDataFrame(bounds, f"_s {kind}, pool string, _lo long, _hi long")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(stratum).cast("string"), F.lit(":"), F.col(id_col).cast("string")), 256)
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy(key, id_col)) - 1)
    on = F.col(stratum).eqNullSafe(F.col("_s")) & (F.col("_r") >= F.col("_lo")) & (F.col("_r") < F.col("_hi"))
    return ranked.join(F.broadcast(table), on).drop("_r", "_s", "_lo", "_hi")  # one row per stratum and pool


def problem_holdout(df: DataFrame, problem: str, salt: str, share: float = 0.1) -> DataFrame:
    """``split`` (train or dev) by whole problems; the number of dev problems is rounded half
    to even."""
    keys = df.select(problem).distinct()
    n = F.bround(F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))) * share)
    ranked = keys.withColumn("_rn", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(rank_key(salt, problem), problem)))
    marked = ranked.withColumn("split", F.when(F.col("_rn") <= n, "dev").otherwise("train")).select(problem, "split")
    return df.join(marked, problem)


def coverage_pick(df: DataFrame, id_col: str, by: Sequence[str]) -> DataFrame:
    """For each column of ``by`` the first row of each of its values: a small set that shows
    every value. The reasons of a row picked more than once are joined."""
    picks = None
    for c in by:
        one = df.groupBy(c).agg(F.min(id_col).alias(id_col)).select(id_col, F.concat(F.lit(f"{c}="), F.col(c).cast("string")).alias("reason"))
        picks = one if picks is None else picks.unionByName(one)
    return picks.groupBy(id_col).agg(F.array_join(F.array_sort(F.collect_set("reason")), ";").alias("reasons"))


def constrained_sample(df: DataFrame, cell: str, id_col: str, utility: str, code: str, problem: str, quotas: Mapping[str, int], per_problem: int, pair_caps: Mapping[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(chosen rows, shortfall by cell): greedy choice under quotas and caps.

    Cells are filled in sorted order; inside a cell rows come by utility (highest first), then
    id. A row is passed over if its code was chosen before (anywhere), if its problem is at
    ``per_problem``, or if (problem, value) is at the cap of one of ``pair_caps``' columns.
    Cells without a quota take nothing.

    The choice is sequential across cells, so it runs in one grouped task, over narrow rows
    (id and keys) that are joined back by id. Spark first cuts what can't be chosen: of rows
    that agree in cell, code, problem and capped columns only the best one counts.
    """
    pair_caps = dict(pair_caps or {})
    wanted = {c: n for c, n in quotas.items() if n > 0}
    slim = df.where(F.col(cell).isin(list(wanted))).select(cell, id_col, F.coalesce(utility, F.lit(0.0)).cast("double").alias("_u"), code, problem, *(F.col(c).alias(f"_p{k}") for k, c in enumerate(pair_caps)))
    places = [f"_p{k}" for k in range(len(pair_caps))]
    best = top_by(slim.withColumn("_k", F.concat_ws("\x1f", cell, code, problem, *places)), "_k", [F.desc("_u"), F.col(id_col)], 1).drop("_k")
    cols = [cell, id_col, "_u", code, problem, *places]

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(pdf[cols].itertuples(index=False, name=None), key=lambda r: (r[0], -r[2], r[1]))
        codes: set = set()
        problems: Counter = Counter()
        pairs: Counter = Counter()
        taken: Counter = Counter()
        chosen = []
        for r in rows:
            keys = [(k, r[4], v) for k, v in zip(pair_caps, r[5:])]
            if taken[r[0]] >= wanted[r[0]] or r[3] in codes or problems[r[4]] >= per_problem or any(pairs[k] >= pair_caps[k[0]] for k in keys):
                continue
            codes.add(r[3])
            problems[r[4]] += 1
            pairs.update(keys)
            taken[r[0]] += 1
            chosen.append((r[1], r[0]))
        return pd.DataFrame(chosen, columns=[id_col, "_cell"])

    kind = df.schema[id_col].dataType.simpleString()
    ids = best.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(choose, f"{id_col} {kind}, _cell string")
    picked = df.join(ids, id_col).drop("_cell")
    want = df.sparkSession.createDataFrame(sorted(wanted.items()), "cell string, quota long")
    got = ids.groupBy("_cell").agg(F.count(F.lit(1)).alias("taken"))
    short = want.join(got, F.col("cell") == F.col("_cell"), "left").select("cell", "quota", F.coalesce("taken", F.lit(0)).alias("taken"), (F.col("quota") - F.coalesce("taken", F.lit(0))).alias("shortfall"))
    return picked, short


def capped_topk(df: DataFrame, state: str, id_col: str, score: str, problem: str, quotas: Mapping[str, int], per_problem: int) -> DataFrame:
    """By states, the rarest first (ties by name): the best scores, at most ``per_problem`` of
    one problem over all states.

    The choice is sequential, in one task over a bounded number of rows. All states together
    take Q rows at most (the quotas' sum), so at most Q / per_problem problems are ever full,
    and with ``per_problem`` rows of each kept at most Q rows of a state are passed over: beyond
    its best (quota + Q) rows none can be chosen.
    """
    slim = df.where(F.col(state).isin(list(quotas))).select(state, id_col, F.col(score).cast("double").alias("_s"), problem)
    counts = {r[0]: r[1] for r in slim.groupBy(state).agg(F.count(F.lit(1))).collect()}
    order = {s: k for k, s in enumerate(sorted(counts, key=lambda s: (counts[s], s)))}
    # beyond a problem's cap in one state no row of it can be chosen
    best = top_by(slim.withColumn("_k", F.concat_ws("\x1f", state, problem)), "_k", [F.desc("_s"), F.col(id_col)], per_problem).drop("_k")
    total = sum(quotas.values())
    best = top_by(best, state, [F.desc("_s"), F.col(id_col)], max(quotas.values(), default=0) + total)
    cols = [state, id_col, "_s", problem]

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        taken: Counter = Counter()
        problems: Counter = Counter()
        out = []
        for s, i, _, p in sorted(pdf[cols].itertuples(index=False, name=None), key=lambda r: (order[r[0]], -r[2], r[1])):
            if taken[s] < quotas[s] and problems[p] < per_problem:
                taken[s] += 1
                problems[p] += 1
                out.append((i,))
        return pd.DataFrame(out, columns=[id_col])

    kind = df.schema[id_col].dataType.simpleString()
    return df.join(best.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(choose, f"{id_col} {kind}"), id_col)
