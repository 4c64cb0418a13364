"""Scan, reject, contamination, split, quota and sample queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpforge.functions.apportion import largest_remainder
from kelpforge.functions.text import collapse_space, ordered_reason, style_penalty, token_estimate
from kelpforge.operators.checks import disjoint_issues, issues, multiset_contained, one_to_one_diff, pending
from kelpforge.operators.dedup import first_wins, layered_dedup
from kelpforge.operators.quality import contains_pairs
from kelpforge.operators.sample import capped_topk, constrained_sample, coverage_pick, hash_rank_sample, stratified_split, top_by
from kelpforge.plans.catalog import query
from kelpforge.session import table

#: The pools' shares, in the declared order.
POOLS = {"sft": 0.2, "rl": 0.7, "behavior_dev": 0.1}


@query(
    "normalized_dedup",
    "SELECT min(doc_id) AS doc_id, sha256(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS norm_hash, count(*) AS copies "
    "FROM documents GROUP BY sha256(trim(regexp_replace(lower(text), '\\s+', ' ', 'g')))",
)
def normalized_dedup(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.sha2(collapse_space(F.lower("text")), 256).alias("norm_hash"))
    return first_wins(d, ["norm_hash"], "doc_id", count="copies").select("doc_id", "norm_hash", "copies")


@query(
    "layered_dedup",
    "WITH RECURSIVE d AS (SELECT doc_id, source, source || '-' || substr(h, 1, 12) AS ep, h AS code, substr(h, 13, 2) AS mu, lang || ':' || substr(h, 15, 1) AS sig, substr(h, 16, 1) AS va, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn "
    "FROM (SELECT doc_id, source, lang, sha256(text) AS h FROM documents)), "
    "f AS (SELECT source, 0::BIGINT AS rn, NULL::BIGINT AS doc_id, NULL::VARCHAR AS why, []::VARCHAR[] AS kept FROM (SELECT DISTINCT source FROM d) UNION ALL "
    "SELECT source, rn, doc_id, why, CASE WHEN why IS NULL THEN list_concat(kept, ['e' || ep, 'c' || code, 'm' || mu, 's' || sig, 'v' || sig || '/' || va]) ELSE kept END FROM "
    "(SELECT d.*, f.kept, CASE WHEN list_contains(f.kept, 'e' || d.ep) THEN 'duplicate_episode' WHEN list_contains(f.kept, 'c' || d.code) THEN 'duplicate_code' WHEN list_contains(f.kept, 'm' || d.mu) THEN 'duplicate_mutation_set' "
    "WHEN len(list_filter(f.kept, lambda x: x = 's' || d.sig)) >= 2 THEN 'signature_limit' WHEN list_contains(f.kept, 'v' || d.sig || '/' || d.va) THEN 'duplicate_variant' END AS why "
    "FROM f JOIN d ON d.source IS NOT DISTINCT FROM f.source AND d.rn = f.rn + 1)) SELECT doc_id, source, why AS dedup_reason FROM f WHERE rn > 0",
)
def layered_dedup_query(spark: SparkSession, sf: str) -> DataFrame:
    """The stand-ins for episode, edits, signature and variant come from a digest of the whole text."""
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", F.sha2("text", 256).alias("code"))
    part = lambda at, n: F.substring("code", at, n)
    d = d.select("*", F.concat("source", F.lit("-"), part(1, 12)).alias("episode"), part(13, 2).alias("mutation"), F.concat("lang", F.lit(":"), part(15, 1)).alias("signature"), part(16, 1).alias("variant"))
    return layered_dedup(d, "doc_id", "episode", "source", "code", "mutation", "signature", ["variant"]).select("doc_id", "source", "dedup_reason")


@query(
    "reject_reasons",
    "SELECT reason, count(*) AS n FROM (SELECT CASE WHEN doc_id IS NULL THEN 'missing_id' WHEN trim(text) = '' THEN 'empty_text' "
    "WHEN lang NOT IN ('en', 'de', 'fr', 'es') THEN 'invalid_lang' WHEN length(text) < 100 THEN 'too_short' WHEN length(text) > 20000 THEN 'too_long' "
    "WHEN source IS NULL THEN 'missing_source' ELSE 'accepted' END AS reason FROM documents) GROUP BY reason",
)
def reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    reason = ordered_reason(
        ("missing_id", F.col("doc_id").isNull()),
        ("empty_text", F.trim("text") == ""),
        ("invalid_lang", ~F.col("lang").isin("en", "de", "fr", "es")),
        ("too_short", F.length("text") < 100),
        ("too_long", F.length("text") > 20000),
        ("missing_source", F.col("source").isNull()),
    )
    d = table(spark, sf, "documents").select(F.coalesce(reason, F.lit("accepted")).alias("reason"))
    return d.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "json_in_string",
    "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
)
def json_in_string(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", F.from_json("props", "k bigint")["k"].alias("k"))
    return e.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


@query(
    "contamination_pairs",
    "SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)",
)
def contamination_pairs(spark: SparkSession, sf: str) -> DataFrame:
    d, b = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    return contains_pairs(d.select("doc_id", "text"), b.select("item_id", "text"), "doc_id", "item_id")


@query(
    "clean_documents",
    "SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE contains(d.text, b.text))",
)
def clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    d, b = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    bad = contains_pairs(d.select("doc_id", "text"), b.select("item_id", "text"), "doc_id", "item_id")
    return d.select("doc_id", "lang", "source").join(bad.select("doc_id").distinct(), "doc_id", "left_anti")


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return stratified_split(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", POOLS, 42)


@query(
    "stratified_split",
    "WITH RECURSIVE g AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), t AS (SELECT sum(n)::BIGINT AS total FROM g), "
    "r AS (SELECT * FROM (VALUES ('sft', 0.2::DOUBLE, 0), ('rl', 0.7::DOUBLE, 1), ('behavior_dev', 0.1::DOUBLE, 2)) v(pool, share, ord)), "
    "p AS (SELECT pool, base + CASE WHEN row_number() OVER (ORDER BY base - ideal, ord) <= total - sum(base) OVER () THEN 1 ELSE 0 END AS cap FROM (SELECT pool, ord, total, total * share AS ideal, floor(total * share)::BIGINT AS base FROM r, t)), "
    "s AS (SELECT 0 AS step, lang, pool, ord, n, cap, n * share AS ideal, floor(n * share)::BIGINT AS got FROM g, r JOIN p USING (pool) UNION ALL "
    "SELECT step + 1, lang, pool, ord, n, cap, ideal, got + CASE WHEN free AND row_number() OVER (ORDER BY free DESC, ideal - got DESC, lang DESC, pool DESC) = 1 THEN 1 ELSE 0 END FROM "
    "(SELECT *, sum(got) OVER (PARTITION BY lang) < n AND sum(got) OVER (PARTITION BY pool) < cap AS free, sum(got) OVER () AS placed FROM s) WHERE placed < (SELECT total FROM t)), "
    "b AS (SELECT lang, pool, sum(got) OVER (PARTITION BY lang ORDER BY ord) - got AS lo, sum(got) OVER (PARTITION BY lang ORDER BY ord) AS hi FROM s WHERE step = (SELECT max(step) FROM s)), "
    "k AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('42:' || lang || ':' || doc_id), doc_id) - 1 AS r FROM documents) "
    "SELECT doc_id, k.lang, pool FROM k JOIN b ON k.lang = b.lang AND r >= lo AND r < hi",
)
def stratified_split_query(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).select("doc_id", "lang", "pool")


@query(
    "floor_split",
    "SELECT doc_id, lang, CASE WHEN r <= floor(n * 0.2) THEN 'sft' WHEN r <= floor(n * 0.2) + floor(n * 0.1) THEN 'behavior_dev' ELSE 'rl' END AS pool "
    "FROM (SELECT doc_id, lang, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER (PARTITION BY lang ORDER BY sha256('42:' || lang || ':' || doc_id), doc_id) AS r FROM documents)",
)
def floor_split(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    d = table(spark, sf, "documents").select("doc_id", "lang")
    n = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    key = F.sha2(F.concat(F.lit("42:"), "lang", F.lit(":"), F.col("doc_id").cast("string")), 256)
    r = d.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(key, "doc_id"))).join(n, "lang")
    sft, dev = F.floor(F.col("n") * 0.2), F.floor(F.col("n") * 0.1)
    return r.select("doc_id", "lang", F.when(F.col("r") <= sft, "sft").when(F.col("r") <= sft + dev, "behavior_dev").otherwise("rl").alias("pool"))


@query(
    "split_disjoint",
    "SELECT count(*) AS n_rows, count(DISTINCT doc_id) AS n_ids, 0::BIGINT AS n_shared FROM documents",
)
def split_disjoint(spark: SparkSession, sf: str) -> DataFrame:
    s = _split(spark, sf)
    shared = disjoint_issues(s, "doc_id", "pool").agg(F.count(F.lit(1)).alias("n_shared"))
    return s.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("doc_id").alias("n_ids")).crossJoin(shared)  # one row by one row


@query(
    "largest_remainder",
    "WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), t AS (SELECT sum(n) AS total FROM c), "
    "f AS (SELECT lang, floor(137 * n / total::DOUBLE) AS base, 137 * n / total::DOUBLE - floor(137 * n / total::DOUBLE) AS frac FROM c, t), "
    "r AS (SELECT *, row_number() OVER (ORDER BY frac DESC, lang) AS rn, 137 - sum(base) OVER () AS rest FROM f) "
    "SELECT lang, CAST(base + CASE WHEN rn <= rest THEN 1 ELSE 0 END AS BIGINT) AS quota FROM r",
)
def largest_remainder_query(spark: SparkSession, sf: str) -> DataFrame:
    sizes = {r[0]: r[1] for r in table(spark, sf, "documents").groupBy("lang").count().collect()}  # one row a language
    total, order = sum(sizes.values()), sorted(sizes)
    quota = largest_remainder(137, {k: sizes[k] / total for k in order}, order)
    return spark.createDataFrame(sorted(quota.items()), "lang string, quota long")


@query(
    "quota_shortfall",
    "WITH q AS (SELECT * FROM (VALUES ('en', 1, 400), ('de', 1, 40), ('fr', 0, 30), ('xx', 1, 5)) t(lang, quality, quota)), "
    "a AS (SELECT lang, quality, count(*) AS actual FROM documents JOIN labels USING (doc_id) GROUP BY ALL) "
    "SELECT coalesce(q.lang, a.lang) AS lang, CAST(coalesce(q.quality, a.quality) AS INTEGER) AS quality, CAST(coalesce(quota, 0) AS BIGINT) AS quota, coalesce(actual, 0) AS actual, "
    "CAST(coalesce(quota, 0) - coalesce(actual, 0) AS BIGINT) AS shortfall, quota IS NULL AS unexpected FROM q FULL OUTER JOIN a ON q.lang = a.lang AND q.quality = a.quality",
)
def quota_shortfall(spark: SparkSession, sf: str) -> DataFrame:
    quota = spark.createDataFrame([("en", 1, 400), ("de", 1, 40), ("fr", 0, 30), ("xx", 1, 5)], "lang string, quality int, quota long")
    actual = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id").groupBy("lang", "quality").agg(F.count(F.lit(1)).alias("actual"))
    both = quota.join(actual, ["lang", "quality"], "full_outer")
    q, a = F.coalesce("quota", F.lit(0)), F.coalesce("actual", F.lit(0))
    return both.select("lang", "quality", q.alias("quota"), a.alias("actual"), (q - a).alias("shortfall"), F.col("quota").isNull().alias("unexpected"))


@query(
    "hash_rank_sample",
    "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('42:' || doc_id), doc_id) AS r FROM documents) WHERE r <= 25",
)
def hash_rank_sample_query(spark: SparkSession, sf: str) -> DataFrame:
    return hash_rank_sample(table(spark, sf, "documents").select("doc_id", "lang"), "lang", "doc_id", "42", 25)


@query(
    "first_n_per_stratum",
    "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents) WHERE r <= 10",
)
def first_n_per_stratum(spark: SparkSession, sf: str) -> DataFrame:
    return top_by(table(spark, sf, "documents").select("doc_id", "lang"), "lang", [F.col("doc_id")], 10)


@query(
    "coverage_pick",
    "SELECT doc_id, string_agg(reason, ';' ORDER BY reason) AS reasons FROM (SELECT min(doc_id) AS doc_id, 'lang=' || lang AS reason FROM documents GROUP BY lang "
    "UNION ALL SELECT min(doc_id), 'source=' || source FROM documents GROUP BY source) GROUP BY doc_id",
)
def coverage_pick_query(spark: SparkSession, sf: str) -> DataFrame:
    return coverage_pick(table(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id", ["lang", "source"])


@query(
    "capped_topk",
    "WITH RECURSIVE q AS (SELECT * FROM (VALUES ('en', 30), ('de', 20), ('fr', 20), ('es', 20)) v(lang, quota)), o AS (SELECT lang, quota, row_number() OVER (ORDER BY count(*), lang) AS k FROM documents JOIN q USING (lang) GROUP BY lang, quota), "
    "x AS (SELECT doc_id, lang, source, quota, row_number() OVER (ORDER BY k, n_chars DESC, doc_id) AS rn FROM documents JOIN o USING (lang)), "
    "f AS (SELECT 0::BIGINT AS rn, NULL::BIGINT AS doc_id, NULL::VARCHAR AS lang, NULL::VARCHAR AS source, FALSE AS took, []::VARCHAR[] AS kept UNION ALL "
    "SELECT rn, doc_id, lang, source, took, CASE WHEN took THEN list_concat(kept, ['l' || lang, 's' || source]) ELSE kept END FROM "
    "(SELECT x.*, f.kept, len(list_filter(f.kept, lambda y: y = 'l' || x.lang)) < x.quota AND len(list_filter(f.kept, lambda y: y = 's' || x.source)) < 4 AS took FROM f JOIN x ON x.rn = f.rn + 1)) SELECT doc_id, lang, source FROM f WHERE took",
)
def capped_topk_query(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return capped_topk(d, "lang", "doc_id", "n_chars", "source", {"en": 30, "de": 20, "fr": 20, "es": 20}, 4).select("doc_id", "lang", "source")


@query(
    "constrained_sample",
    "WITH RECURSIVE q AS (SELECT * FROM (VALUES ('en', 50), ('de', 20), ('fr', 20), ('es', 10)) v(lang, quota)), "
    "x AS (SELECT doc_id, lang, source, quota, sha256(text) AS code, row_number() OVER (ORDER BY lang, n_chars DESC, doc_id) AS rn FROM documents JOIN q USING (lang)), "
    "f AS (SELECT 0::BIGINT AS rn, NULL::BIGINT AS doc_id, NULL::VARCHAR AS lang, NULL::VARCHAR AS source, FALSE AS took, []::VARCHAR[] AS kept UNION ALL "
    "SELECT rn, doc_id, lang, source, took, CASE WHEN took THEN list_concat(kept, ['l' || lang, 's' || source, 'c' || code, 'p' || source || '/' || lang]) ELSE kept END FROM "
    "(SELECT x.*, f.kept, len(list_filter(f.kept, lambda y: y = 'l' || x.lang)) < x.quota AND NOT list_contains(f.kept, 'c' || x.code) AND len(list_filter(f.kept, lambda y: y = 's' || x.source)) < 6 AND len(list_filter(f.kept, lambda y: y = 'p' || x.source || '/' || x.lang)) < 3 AS took FROM f JOIN x ON x.rn = f.rn + 1)) SELECT doc_id, lang, source FROM f WHERE took",
)
def constrained_sample_query(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("code"))
    picked, _ = constrained_sample(d, "lang", "doc_id", "n_chars", "code", "source", {"en": 50, "de": 20, "fr": 20, "es": 10}, 6, {"lang": 3})
    return picked.select("doc_id", "lang", "source")


@query(
    "one_to_one_diff",
    "SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'left_only' ELSE 'right_only' END AS side "
    "FROM documents d FULL OUTER JOIN labels l USING (doc_id) WHERE d.doc_id IS NULL OR l.doc_id IS NULL",
)
def one_to_one_diff_query(spark: SparkSession, sf: str) -> DataFrame:
    return one_to_one_diff(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query("semi_orders", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def semi_orders(spark: SparkSession, sf: str) -> DataFrame:
    c, o = table(spark, sf, "customer").select("c_custkey"), table(spark, sf, "orders").select("o_custkey")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi")


@query("resume_pending", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_pending(spark: SparkSession, sf: str) -> DataFrame:
    return pending(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id")


@query(
    "multiset_contained",
    "WITH a AS (SELECT lang, count(*) AS n_part FROM documents JOIN labels USING (doc_id) GROUP BY lang), b AS (SELECT lang, count(*) AS n_whole FROM documents GROUP BY lang) "
    "SELECT lang, n_part, coalesce(n_whole, 0) AS n_whole, n_part <= coalesce(n_whole, 0) AS contained FROM a LEFT JOIN b USING (lang)",
)
def multiset_contained_query(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return multiset_contained(d.join(table(spark, sf, "labels").select("doc_id"), "doc_id").select("lang"), d.select("lang"), ["lang"])


@query(
    "issue_union",
    "SELECT doc_id, 'n_chars_mismatch' AS code, 'P0' AS severity FROM documents WHERE n_chars <> length(text) "
    "UNION ALL SELECT doc_id, 'too_long', 'P1' FROM documents WHERE length(text) > 10000 "
    "UNION ALL SELECT doc_id, 'html_entity', 'P2' FROM documents WHERE contains(text, '&amp;') "
    "UNION ALL SELECT doc_id, 'no_final_stop', 'P2' FROM documents WHERE NOT ends_with(text, '.')",
)
def issue_union(spark: SparkSession, sf: str) -> DataFrame:
    return issues(
        table(spark, sf, "documents"),
        "doc_id",
        [
            ("n_chars_mismatch", "P0", F.col("n_chars") != F.length("text")),
            ("too_long", "P1", F.length("text") > 10000),
            ("html_entity", "P2", F.contains("text", F.lit("&amp;"))),
            ("no_final_stop", "P2", ~F.endswith("text", F.lit("."))),
        ],
    )


@query(
    "duplicate_ids",
    "SELECT sha256(text) AS code_hash, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("code_hash")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(
    "code_style",
    "SELECT doc_id, greatest(1, length(text) // 3)::INTEGER AS tokens, "
    "(CASE WHEN len(regexp_extract_all(text, '\\blambda\\b')) >= 3 THEN 2 ELSE 0 END + CASE WHEN length(text) < 80 THEN 1 ELSE 0 END + CASE WHEN len(string_split(text, chr(10))) < 4 THEN 1 ELSE 0 END)::INTEGER AS penalty FROM documents",
)
def code_style(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", token_estimate("text").alias("tokens"), style_penalty("text").alias("penalty"))
