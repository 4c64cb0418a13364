"""Grades of programs, one row per (program, case), folded in Spark."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpforge.functions.pynorm import code_hash, compiles, node_count, output_matches
from kelpforge.operators.execution.sandbox import Limits, run_candidate
from kelpforge.operators.report import failure_signature, grade_fold

_RUN = "program_id string, attempt int, case_no int, given string, status string, passed boolean, exception string, stdout string"


def run_cases(programs: DataFrame, cases: DataFrame, attempts: int = 1, partitions: int | None = None, limits: Limits = Limits()) -> DataFrame:
    """One row per (program, attempt, case): status, passed, exception, stdout.

    ``programs``: (program_id, problem_id, code); ``cases``: (problem_id, case_no, given,
    expected, mode, fn_name), given and expected as JSON or text. A row may cost seconds, so
    rows are dealt evenly over partitions before any program runs; two attempts are rows of
    their own, never merged.
    """
    jobs = programs.select("program_id", "problem_id", "code").join(cases, "problem_id").withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(attempts))))
    jobs = jobs.repartition(partitions or programs.sparkSession.sparkContext.defaultParallelism, "program_id", "attempt", "case_no")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for j in pdf.itertuples(index=False):
                got, value = run_candidate(j.code, j.given, j.mode, j.fn_name, limits)
                right = got.status == "ok" and output_matches(value, json.loads(j.expected), j.mode)
                status = got.status if got.status != "ok" else "ok" if right else "wrong_answer"
                rows.append((j.program_id, j.attempt, j.case_no, j.given, status, right, got.exception, got.stdout))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _RUN.split(", ")])

    return jobs.mapInPandas(work, _RUN)


def grades(runs: DataFrame) -> DataFrame:
    """One row per (program, attempt): counts, status and input of the first failure, signature.

    A program that doesn't compile is a runtime error without an input."""
    bad = ~F.col("passed")
    fold = grade_fold(runs, ["program_id", "attempt"], "case_no", F.col("passed"), F.col("status"), F.when(F.col("status") != "compile_error", F.col("given")))
    first = runs.groupBy("program_id", "attempt").agg(F.min_by(F.when(bad, F.col("exception")), F.when(bad, F.col("case_no"))).alias("exception"))
    both = fold.join(first, ["program_id", "attempt"])
    return both.withColumn("signature", failure_signature(F.col("status"), F.col("passed"), F.col("total"), F.col("failing_input"), F.col("exception")))


def stable_grades(programs: DataFrame, cases: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Two attempts folded: the first grade and whether the second is the same."""
    g = grades(run_cases(programs, cases, 2, limits=limits))
    return g.groupBy("program_id").agg(F.min_by(F.struct("passed", "total", "pass_rate", "status", "failing_input", "signature"), "attempt").alias("g"), (F.countDistinct("signature") == 1).alias("stable")).select("program_id", "g.*", "stable")


def grade_distinct(programs: DataFrame, cases: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Grades of programs of which many are equal: each (problem, code) runs once."""
    hashed = programs.withColumn("_h", F.sha2("code", 256))
    once = hashed.groupBy("problem_id", "_h").agg(F.min("code").alias("code")).withColumn("program_id", F.concat_ws(":", F.col("problem_id").cast("string"), "_h"))
    g = grades(run_cases(once, cases, limits=limits)).drop("attempt").withColumnRenamed("program_id", "_k")
    return hashed.withColumn("_k", F.concat_ws(":", F.col("problem_id").cast("string"), "_h")).select("program_id", "_k").join(g, "_k").drop("_k")


def select_references(solutions: DataFrame, cases: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(problem_id, index, code): of a problem's solutions that are accepted twice alike, the one
    of the smallest syntax tree, then the first. ``solutions``: (problem_id, index, code)."""
    measured = solutions.mapInPandas(_measure, "problem_id string, index int, code string, nodes int")
    programs = measured.select(F.concat_ws("#", "problem_id", F.col("index").cast("string")).alias("program_id"), "*")
    good = stable_grades(programs, cases, limits).where("status = 'accepted' AND stable")
    return programs.join(good.select("program_id"), "program_id").groupBy("problem_id").agg(F.min(F.struct("nodes", "index", "code")).alias("m")).select("problem_id", "m.index", "m.code")


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        ok = pdf[[compiles(c) for c in pdf["code"]]]
        yield ok.assign(problem_id=ok["problem_id"].astype(str), nodes=[node_count(c) for c in ok["code"]])[["problem_id", "index", "code", "nodes"]]


def with_code_hash(df: DataFrame, code: str = "code") -> DataFrame:
    """``code_hash``: equal for programs that differ in layout only."""
    return df.withColumn("code_hash", F.pandas_udf(lambda s: s.map(code_hash), "string")(F.col(code)))
