"""Aggregates: manifests, grade folds, rates, percentiles by three definitions, audits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rates that count as failing and as succeeding, and the gain that a run must bring.
LOW, HIGH, GAIN = 1 / 3, 2 / 3, 1 / 3


def manifest(df: DataFrame, dims: Sequence[str], pairs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(dimension, value, n) for each single dimension and each pair, in one pass with
    grouping sets (one expand and one aggregate, however many dimensions)."""
    sets = [(d,) for d in dims] + [tuple(p) for p in pairs]
    cols = list(dict.fromkeys(c for s in sets for c in s))
    got = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    code = {sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s): s for s in sets}
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("<null>"))
    name = reduce(lambda acc, kv: F.when(F.col("g") == kv[0], F.lit("x".join(kv[1]))).otherwise(acc), code.items(), F.lit(None))
    value = reduce(lambda acc, kv: F.when(F.col("g") == kv[0], F.concat_ws("|", *[text(c) for c in kv[1]])).otherwise(acc), code.items(), F.lit(None))
    return got.select(name.alias("dimension"), value.alias("value"), "n")


def grade_fold(cases: DataFrame, program: Sequence[str], order: str, passed: Column, status: Column, shown: Column) -> DataFrame:
    """One row per program: passed, total, pass_rate, status and input of its first failing case.

    The status is that of the first failure: a timeout stays one; runtime errors, exceeded
    output and invalid input are runtime errors; anything else is a wrong answer.
    """
    failed = ~passed
    kind = F.when(status == "timeout", "timeout").when(status.isin("runtime_error", "compile_error", "output_limit", "invalid_input"), "runtime_error").otherwise("wrong_answer")
    ok = F.count_if(passed)
    n = F.count(F.lit(1))
    return cases.groupBy(*program).agg(
        ok.alias("passed"),
        n.alias("total"),
        (ok / n).cast("double").alias("pass_rate"),
        F.coalesce(F.min_by(F.when(failed, kind), F.when(failed, F.col(order))), F.lit("accepted")).alias("status"),
        F.min_by(F.when(failed, shown), F.when(failed, F.col(order))).alias("failing_input"),
    )


def failure_signature(status: Column, passed: Column, total: Column, failing_input: Column, exception: Column) -> Column:
    """Equal for equal outcomes; a digest of the fields in alphabetical order."""
    fields = F.to_json(F.struct(exception.alias("exception_type"), failing_input.alias("failing_input"), passed.alias("passed"), status.alias("status"), total.alias("total")), {"ignoreNullFields": "false"})
    return F.concat(F.lit("sha256:"), F.sha2(fields, 256))


def midpoint_percentile(values: Column, q: float) -> Column:
    """The mean of the two order statistics around position q (n - 1); not interpolated."""
    x = F.sort_array(values)
    at = F.lit(q) * (F.size(x) - 1)
    pick = lambda i: F.get(x, i.cast("int"))
    return F.when(F.size(x) > 0, (pick(F.floor(at)) + pick(F.ceil(at))) / F.lit(2.0))


def upper_median(values: Column) -> Column:
    """Element n div 2 of the sorted values, from 0."""
    x = F.sort_array(values)
    return F.when(F.size(x) > 0, F.get(x, F.floor(F.size(x) / 2).cast("int")))


def classify_post_submit(without_run: Column, with_run: Column) -> Column:
    """The behaviour that paired success rates support after a failed submit."""
    return F.when(without_run >= HIGH, "post_submit_direct_repair").when(_run_helps(without_run, with_run), "post_submit_failure_replay").otherwise("discard")


def classify_pre_submit(without_run: Column, with_run: Column, provenance_valid: Column, executable: Column) -> Column:
    """The behaviour before any submit: a proposed input must be valid, run, and help."""
    return F.when(provenance_valid & executable & _run_helps(without_run, with_run), "pre_submit_active_validation").otherwise("discard")


def _run_helps(without_run: Column, with_run: Column) -> Column:
    return (without_run <= LOW) & (with_run >= HIGH) & (with_run - without_run >= GAIN)


def rate(cond: Column, base: Column | None = None) -> Column:
    """The share of rows (or of those with ``base``) that fulfil ``cond``; null without any."""
    base = F.lit(True) if base is None else base
    return F.try_divide(F.count_if(cond & base).cast("double"), F.count_if(base).cast("double"))


def pearson(x: str, y: str) -> Column:
    """The correlation of two columns; null where one of them doesn't vary."""
    both = lambda c: F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), F.col(c).cast("double"))
    return F.try_divide(F.covar_pop(both(x), both(y)), F.stddev_pop(both(x)) * F.stddev_pop(both(y)))


def budget_issues(totals: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """(code, value, bound) of each limit (column, bound) of a one-row table that is exceeded."""
    rows = F.array(*[F.struct(F.lit(code).alias("code"), F.col(col).cast("double").alias("value"), F.lit(float(limit)).alias("bound")) for code, (col, limit) in limits.items()])
    return totals.select(F.explode(rows).alias("r")).select("r.*").where("value > bound")
