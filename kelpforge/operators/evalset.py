"""Evaluation sets and smoke samples: how they are drawn, and what must hold of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpforge.operators.sample import hash_rank_sample, top_by


def by_text(stratum: Column | str, key: Column | str) -> list[Column]:
    """The order by stratum and then by the key as text, in which '10' comes before '9'."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return [col(stratum).asc(), col(key).cast("string").asc()]


def smoke_sample(df: DataFrame, wants: Mapping[str, int], kind: str, mode: str, order: str) -> DataFrame:
    """The first ``wants[k]`` rows of each kind, at most half of them (one at least) of one mode;
    what that leaves open is filled from the other rows in order.

    ``order`` is unique. A mode gives no more rows than its kind wants, so ranks inside (kind,
    mode) cut the table before ranks inside a kind are asked for.
    """
    want = F.create_map(*[F.lit(x) for kv in wants.items() for x in kv])[F.col(kind)]
    inside = Window.partitionBy(kind, mode).orderBy(order)
    most = max(wants.values(), default=0)
    few = df.where(F.col(kind).isin(*wants)).withColumn("_m", F.row_number().over(inside)).where(F.col("_m") <= most)
    later = F.col("_m") > F.greatest(F.lit(1), F.floor(want / 2))
    ranked = few.withColumn("_k", F.row_number().over(Window.partitionBy(kind).orderBy(later, order)))
    return ranked.where(F.col("_k") <= want).drop("_m", "_k")


def fixed_set(df: DataFrame, stratum: str, id_col: str, per: int, salt: str) -> tuple[DataFrame, DataFrame]:
    """(``per`` rows of each stratum by seeded hash rank, manifest by stratum).

    The manifest has the number of rows, the ids in numeric order, and the SHA-256 of the rows'
    JSON lines in that order; a stratum of the set holds ``per`` rows, so lists are bounded.
    """
    rows = hash_rank_sample(df, stratum, id_col, salt, per)
    line = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    held = F.sort_array(F.collect_list(F.struct(F.col(id_col).alias("k"), line.alias("line"))))
    grouped = rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("n_rows"), held.alias("held"))
    text = F.concat(F.array_join("held.line", "\n"), F.lit("\n"))
    return rows, grouped.select(stratum, "n_rows", F.col("held.k").alias("ids"), F.sha2(text, 256).alias("sha256"))


def strata_diff(a: DataFrame, b: DataFrame, stratum: str, key: str) -> DataFrame:
    """(stratum, n_left_only, n_right_only) of the strata in which two sets of keys differ."""
    side = lambda df, name: df.select(stratum, key).distinct().withColumn(name, F.lit(1))
    both = side(a, "_a").join(side(b, "_b"), [stratum, key], "full_outer")
    n = both.groupBy(stratum).agg(F.count_if(F.col("_b").isNull()).alias("n_left_only"), F.count_if(F.col("_a").isNull()).alias("n_right_only"))
    return n.where("n_left_only + n_right_only > 0")


def eval_row_reason(row: Mapping[str, Column], difficulties: Sequence[str]) -> Column:
    """All that is wrong with one row of an evaluation set, as an array of codes.

    ``row`` names the columns problem_id, difficulty, question, starter_code, io_mode, fn_name,
    inputs and outputs (arrays of JSON texts).
    """
    c = row
    no = lambda cond: ~F.coalesce(cond, F.lit(False))
    tests_ok = (F.size(c["inputs"]) > 0) & (F.size(c["inputs"]) == F.size(c["outputs"]))
    parses = lambda xs: F.forall(xs, lambda x: F.try_parse_json(x).isNotNull())
    rules = (
        ("bad_id", no(F.rlike(c["problem_id"].cast("string"), F.lit("^[0-9]+$")))),
        ("bad_difficulty", no(c["difficulty"].isin(*difficulties))),
        ("empty_question", no(F.trim(c["question"]) != "")),
        ("no_starter_code", c["starter_code"].isNull()),
        ("bad_io_mode", no(c["io_mode"].isin("stdin", "call"))),
        ("fn_name_without_call", F.coalesce(c["fn_name"].isNotNull() != (c["io_mode"] == "call"), F.lit(False))),
        ("bad_tests", no(tests_ok)),
        ("unusable_input", tests_ok & (c["io_mode"] == "call") & no(parses(c["inputs"]))),
        ("unusable_output", tests_ok & no(parses(c["outputs"]))),
    )
    return F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in rules]))


def eval_set_issues(rows: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """(subject, code) of an evaluation set: rows with faults, repeated ids, and difficulties
    whose count isn't the expected one (subject: the difficulty)."""
    found = rows.select(F.col("problem_id").cast("string").alias("subject"), F.explode(eval_row_reason({c: F.col(c) for c in rows.columns}, list(expected))).alias("code"))
    twice = rows.groupBy(F.col("problem_id").cast("string").alias("subject")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("subject", F.lit("duplicate_id").alias("code"))
    want = rows.sparkSession.createDataFrame(list(expected.items()), "subject string, want long")
    got = rows.groupBy(F.col("difficulty").alias("subject")).agg(F.count(F.lit(1)).alias("n"))
    off = want.join(got, "subject", "left").where(F.coalesce("n", F.lit(0)) != F.col("want")).select("subject", F.lit("wrong_count").alias("code"))
    return found.unionByName(twice).unionByName(off)


def first_of_strata(df: DataFrame, stratum: str, order: str, cap: int, done: Mapping[str, int] | None = None) -> DataFrame:
    """What a scan in ``order`` takes until every stratum holds ``cap`` rows, of which ``done``
    were taken before."""
    left = {k: max(0, cap - n) for k, n in (done or {}).items()}
    ranked = top_by(df, stratum, [F.col(order)], cap)
    if not left:
        return ranked
    room = F.coalesce(F.create_map(*[F.lit(x) for kv in left.items() for x in kv])[F.col(stratum)], F.lit(cap))
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(order))
    return ranked.withColumn("_r", rank).where(F.col("_r") <= room).drop("_r")
