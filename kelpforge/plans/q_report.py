"""Manifest, grade, rate, percentile and audit queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpforge.operators.report import budget_issues, classify_post_submit, failure_signature, grade_fold, manifest, midpoint_percentile, pearson, rate, upper_median
from kelpforge.plans.catalog import query
from kelpforge.session import table


@query("manifest_cube", "SELECT lang, source, count(*) AS n, CAST(grouping(lang) * 2 + grouping(source) AS BIGINT) AS level FROM documents GROUP BY CUBE (lang, source)")
def manifest_cube(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").cube("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level"))


@query(
    "manifest_grouping_sets",
    "SELECT 'lang' AS dimension, lang AS value, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source "
    "UNION ALL SELECT 'langxsource', lang || '|' || source, count(*) FROM documents GROUP BY lang, source",
)
def manifest_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    return manifest(table(spark, sf, "documents"), ["lang", "source"], [("lang", "source")])


def _grades(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    cases = li.select("l_orderkey", order.alias("o"), (F.col("l_returnflag") != "R").alias("ok"), F.when(F.col("l_quantity") > 45, "timeout").when(F.col("l_quantity") > 40, "runtime_error").otherwise("ok").alias("st"), F.col("l_shipdate").cast("string").alias("shown"))
    return grade_fold(cases, ["l_orderkey"], "o", F.col("ok"), F.col("st"), F.col("shown"))


_FOLD = (
    "SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag <> 'R') AS passed, count(*) AS total, count(*) FILTER (WHERE l_returnflag <> 'R') / count(*)::DOUBLE AS pass_rate, "
    "coalesce(arg_min(CASE WHEN l_quantity > 45 THEN 'timeout' WHEN l_quantity > 40 THEN 'runtime_error' ELSE 'wrong_answer' END, struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey, d := l_quantity, e := l_shipdate)) FILTER (WHERE l_returnflag = 'R'), 'accepted') AS status, "
    "strftime(arg_min(l_shipdate, struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey, d := l_quantity, e := l_shipdate)) FILTER (WHERE l_returnflag = 'R'), '%Y-%m-%d %H:%M:%S') AS failing_input FROM lineitem GROUP BY l_orderkey"
)


@query("grade_fold", _FOLD)
def grade_fold_query(spark: SparkSession, sf: str) -> DataFrame:
    return _grades(spark, sf)


@query(
    "outcome_signature",
    """SELECT 'sha256:' || sha256('{"exception_type":null,"failing_input":' || coalesce('"' || failing_input || '"', 'null') || ',"passed":' || passed || ',"status":"' || status || '","total":' || total || '}') AS signature, count(*) AS n """
    f"FROM ({_FOLD}) GROUP BY 1",
)
def outcome_signature(spark: SparkSession, sf: str) -> DataFrame:
    sig = failure_signature(F.col("status"), F.col("passed"), F.col("total"), F.col("failing_input"), F.lit(None).cast("string"))
    return _grades(spark, sf).groupBy(sig.alias("signature")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "paired_utility",
    "WITH k AS (SELECT event_type FROM (SELECT DISTINCT event_type FROM events) ORDER BY event_type LIMIT 2), "
    "r AS (SELECT user_id, count(*) FILTER (WHERE value > 50 AND event_type = (SELECT min(event_type) FROM k)) / nullif(count(*) FILTER (WHERE event_type = (SELECT min(event_type) FROM k)), 0)::DOUBLE AS without_run, "
    "count(*) FILTER (WHERE value > 50 AND event_type = (SELECT max(event_type) FROM k)) / nullif(count(*) FILTER (WHERE event_type = (SELECT max(event_type) FROM k)), 0)::DOUBLE AS with_run FROM events GROUP BY user_id) "
    "SELECT user_id, without_run, with_run, with_run - without_run AS utility, CASE WHEN without_run >= 2e0/3 THEN 'post_submit_direct_repair' WHEN without_run <= 1e0/3 AND with_run - without_run >= 1e0/3 AND with_run >= 2e0/3 THEN 'post_submit_failure_replay' ELSE 'discard' END AS behavior FROM r",
)
def paired_utility(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "event_type", "value")
    two = e.select("event_type").distinct().orderBy("event_type").limit(2).agg(F.min("event_type").alias("t0"), F.max("event_type").alias("t1"))
    j = e.join(F.broadcast(two), how="cross")  # one row
    r = j.groupBy("user_id").agg(rate(F.col("value") > 50, F.col("event_type") == F.col("t0")).alias("without_run"), rate(F.col("value") > 50, F.col("event_type") == F.col("t1")).alias("with_run"))
    return r.select("user_id", "without_run", "with_run", (F.col("with_run") - F.col("without_run")).alias("utility"), classify_post_submit(F.col("without_run"), F.col("with_run")).alias("behavior"))


@query(
    "audit_gate",
    "SELECT lang, count(*) AS reviewed, count(DISTINCT doc_id) AS unique_ids, avg(CASE WHEN quality = 1 THEN 1e0 ELSE 0e0 END) AS positive_rate, count(*) FILTER (WHERE toxic = 1) AS severe, "
    "count(*) >= 10 AND avg(CASE WHEN quality = 1 THEN 1e0 ELSE 0e0 END) >= 0.95 AND count(*) FILTER (WHERE toxic = 1) = 0 AS passes FROM labels JOIN documents USING (doc_id) GROUP BY lang",
)
def audit_gate(spark: SparkSession, sf: str) -> DataFrame:
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    g = j.groupBy("lang").agg(F.count(F.lit(1)).alias("reviewed"), F.countDistinct("doc_id").alias("unique_ids"), rate(F.col("quality") == 1).alias("positive_rate"), F.count_if(F.col("toxic") == 1).alias("severe"))
    return g.withColumn("passes", (F.col("reviewed") >= 10) & (F.col("positive_rate") >= 0.95) & (F.col("severe") == 0))


@query(
    "eval_summary",
    "SELECT coalesce(lang, 'all') AS difficulty, count(*) AS n, avg(quality::DOUBLE) AS pass_at_1, count(*) FILTER (WHERE quality = 0 AND toxic = 1) / nullif(count(*) FILTER (WHERE toxic = 1), 0)::DOUBLE AS repair_rate "
    "FROM labels JOIN documents USING (doc_id) GROUP BY ROLLUP (lang)",
)
def eval_summary(spark: SparkSession, sf: str) -> DataFrame:
    j = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    g = j.rollup("lang").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("quality").cast("double")).alias("pass_at_1"), rate(F.col("quality") == 0, F.col("toxic") == 1).alias("repair_rate"))
    return g.select(F.coalesce("lang", F.lit("all")).alias("difficulty"), "n", "pass_at_1", "repair_rate")


@query(
    "percentile_corr",
    "SELECT lang, quantile_cont(n_chars, 0.95) AS p95, median(n_chars) AS med, avg(n_chars::DOUBLE) AS mean_chars, corr(n_chars, quality) AS pearson FROM documents JOIN labels USING (doc_id) GROUP BY lang",
)
def percentile_corr(spark: SparkSession, sf: str) -> DataFrame:
    j = table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    return j.groupBy("lang").agg(F.percentile("n_chars", 0.95).alias("p95"), F.median("n_chars").alias("med"), F.avg(F.col("n_chars").cast("double")).alias("mean_chars"), pearson("n_chars", "quality").alias("pearson"))


@query(
    "midpoint_percentile",
    "SELECT lang, (l[CAST(floor(0.95e0 * (len(l) - 1)) AS BIGINT) + 1] + l[CAST(ceil(0.95e0 * (len(l) - 1)) AS BIGINT) + 1]) / 2e0 AS p95_mid, l[len(l) // 2 + 1] AS upper_median FROM (SELECT lang, list_sort(list(n_chars)) AS l FROM documents GROUP BY lang)",
)
def midpoint(spark: SparkSession, sf: str) -> DataFrame:
    g = table(spark, sf, "documents").groupBy("lang").agg(F.collect_list("n_chars").alias("x"))
    return g.select("lang", midpoint_percentile(F.col("x"), 0.95).alias("p95_mid"), upper_median(F.col("x")).alias("upper_median"))


@query(
    "token_agreement",
    "WITH t AS (SELECT item_id, string_split(text, ' ') AS w FROM benchmark) SELECT a.item_id AS item_a, b.item_id AS item_b, "
    "len(list_filter(range(1, least(len(a.w), len(b.w)) + 1), lambda i: a.w[i] = b.w[i])) / greatest(len(a.w), len(b.w))::DOUBLE AS agreement FROM t a JOIN t b ON b.item_id = a.item_id + 1",
)
def token_agreement(spark: SparkSession, sf: str) -> DataFrame:
    t = table(spark, sf, "benchmark").select("item_id", F.split("text", " ", -1).alias("w"))
    a, b = t.select(F.col("item_id").alias("item_a"), F.col("w").alias("wa")), t.select(F.col("item_id").alias("item_b"), F.col("w").alias("wb"))
    same = F.size(F.filter(F.zip_with("wa", "wb", lambda x, y: F.coalesce(x == y, F.lit(False))), lambda z: z))
    return a.join(b, F.col("item_b") == F.col("item_a") + 1).select("item_a", "item_b", (same / F.greatest(F.size("wa"), F.size("wb"))).alias("agreement"))


@query(
    "budget_check",
    "SELECT code, value, bound FROM (SELECT 'wall_hours' AS code, sum(value) / 3600 AS value, 72e0 AS bound FROM events UNION ALL SELECT 'reject_rate', count(*) FILTER (WHERE value < 1) / count(*)::DOUBLE, 0.95 FROM events "
    "UNION ALL SELECT 'events', count(*)::DOUBLE, 5000e0 FROM events) WHERE value > bound",
)
def budget_check(spark: SparkSession, sf: str) -> DataFrame:
    totals = table(spark, sf, "events").agg((F.sum("value") / 3600).alias("hours"), rate(F.col("value") < 1).alias("rejects"), F.count(F.lit(1)).alias("n"))
    return budget_issues(totals, {"wall_hours": ("hours", 72), "reject_rate": ("rejects", 0.95), "events": ("n", 5000)})
