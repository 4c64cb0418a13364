"""Hash, dedup and manifest queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpforge.functions.hashing import content_hash
from kelpforge.operators.dedup import first_wins
from kelpforge.plans.catalog import query
from kelpforge.session import table


@query(
    "exact_dedup",
    "SELECT min(doc_id) AS doc_id, 'sha256:' || sha256(text) AS content_hash, count(*) AS copies FROM documents GROUP BY sha256(text)",
)
def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", content_hash("text").alias("content_hash"))
    return first_wins(d, ["content_hash"], "doc_id", count="copies").select("doc_id", "content_hash", "copies")


@query(
    "exact_dedup_manifest",
    "SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE rn = 1) AS kept, count(*) FILTER (WHERE rn > 1) AS dropped FROM "
    "(SELECT source, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS rn FROM documents) GROUP BY source",
)
def exact_dedup_manifest(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "source", content_hash("text").alias("content_hash"))
    kept = first_wins(d, ["content_hash"], "doc_id").select(F.col("doc_id").alias("keep"))
    joined = d.select("doc_id", "source").join(kept, F.col("doc_id") == F.col("keep"), "left")
    return joined.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("keep").alias("kept"),
        (F.count(F.lit(1)) - F.count("keep")).alias("dropped"),
    )
