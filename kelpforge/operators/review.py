"""Manual audits, probes of model answers, and audits of labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpforge.functions.text import ordered_reason
from kelpforge.operators.report import rate

#: The fields of a review, and those of them that are booleans.
REVIEW_FIELDS = ("episode_id", "observable_evidence_supported", "reviewer", "severe_issue", "trajectory_natural")
VERDICTS = ("observable_evidence_supported", "trajectory_natural", "severe_issue")


def judged_reviews(reviews: DataFrame, episodes: DataFrame) -> DataFrame:
    """Each review with the reason why it doesn't count (null: it does).

    ``reviews``: (position, record), the record being JSON; ``episodes``: (episode_id,
    behavior). Of an episode's valid reviews the first one counts; any row after it is a
    duplicate.
    """
    v = F.try_parse_json("record")
    get = lambda name, kind: F.try_variant_get(v, f"$.{name}", kind)
    kind = lambda name: F.coalesce(F.schema_of_variant(get(name, "variant")), F.lit("VOID"))
    read = reviews.select(
        "position",
        F.startswith(F.schema_of_variant(v), F.lit("OBJECT")).alias("is_object"),
        F.when(kind("episode_id") == "STRING", get("episode_id", "string")).alias("episode_id"),
        (F.array_sort(F.json_object_keys("record")) == F.array(*map(F.lit, REVIEW_FIELDS))).alias("fields_ok"),
        ((kind("reviewer") == "STRING") & (F.trim(get("reviewer", "string")) != "")).alias("reviewer_ok"),
        *[F.when(kind(n) == "BOOLEAN", get(n, "boolean")).alias(n) for n in VERDICTS],
    )
    known = read.join(episodes.select("episode_id", "behavior"), "episode_id", "left")
    whole = F.coalesce(F.col("fields_ok") & F.col("reviewer_ok"), F.lit(False))
    for n in VERDICTS:
        whole &= F.col(n).isNotNull()
    first = F.min(F.when(whole & F.col("behavior").isNotNull(), F.col("position"))).over(Window.partitionBy("episode_id"))
    reason = ordered_reason(
        ("not_an_object", ~F.coalesce("is_object", F.lit(False))),
        ("no_episode_id", F.col("episode_id").isNull()),
        ("unknown_episode", F.col("behavior").isNull()),
        ("duplicate", F.coalesce(F.col("position") > F.col("_first"), F.lit(False))),
        ("invalid_schema", ~F.col("_whole")),
    )
    return known.withColumns({"_first": first, "_whole": whole}).select("position", "episode_id", "behavior", *VERDICTS, reason.alias("reason"))


def review_issues(reviews: DataFrame, episodes: DataFrame, least: int, per_behavior: int = 10, share: float = 0.95) -> DataFrame:
    """(subject, code, severity): reviews that don't count, severe ones (P0), too few reviews in
    all or of a behaviour (``per_behavior``, or all episodes it has), too few positive ones."""
    judged = judged_reviews(reviews, episodes)
    good = judged.where("reason IS NULL")
    row = F.concat(F.lit("row "), F.col("position").cast("string"))
    code = lambda c, s="P1": (F.lit(c).alias("code"), F.lit(s).alias("severity"))
    bad = judged.where("reason IS NOT NULL").select(row.alias("subject"), F.col("reason").alias("code"), F.lit("P1").alias("severity"))
    severe = good.where("severe_issue").select(F.col("episode_id").alias("subject"), *code("severe", "P0"))
    have = episodes.groupBy("behavior").agg(F.count(F.lit(1)).alias("available"))
    seen = good.groupBy("behavior").agg(F.count(F.lit(1)).alias("n"))
    short = have.join(seen, "behavior", "left").where(F.coalesce("n", F.lit(0)) < F.least(F.lit(per_behavior), "available")).select(F.col("behavior").alias("subject"), *code("too_few_of_behavior"))
    positive = F.col("observable_evidence_supported") & F.col("trajectory_natural") & ~F.col("severe_issue")
    total = good.agg(F.count(F.lit(1)).alias("n"), F.avg(positive.cast("int")).alias("p"))
    few = total.where(F.col("n") < least).select(F.lit("all").alias("subject"), *code("too_few_reviews"))
    low = total.where(F.col("p") < share).select(F.lit("all").alias("subject"), *code("too_few_positive"))
    return bad.unionByName(severe).unionByName(short).unionByName(few).unionByName(low)


def provenance_ok(keys: Column, allowed: Sequence[str]) -> Column:
    """Whether the fields that a proposal was made from are the allowed ones in their order."""
    return F.coalesce(keys == F.array(*map(F.lit, allowed)), F.lit(False))


def movement(target: Column, baseline: Column) -> Column:
    """How much closer to the target an answer is than what it started from; null if unread."""
    return target - baseline


def probe_summary(answers: DataFrame, by: Sequence[str], gate: tuple[float, float, int] = (0.95, 0.90, 1)) -> DataFrame:
    """Rates and means of probed answers, and whether they pass (valid share, share of the target
    tool, exact answers).

    Columns of ``answers``: valid, tool_match, exact, duplicate (booleans), target_similarity,
    candidate_similarity and baseline; an answer without code has null similarities, which
    means leave out and rates count as not moved.
    """
    moved = movement(F.col("target_similarity"), F.col("baseline"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    valid_share, tool_share, exact_least = gate
    out = answers.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[rate(yes(F.col(c))).alias(f"{c}_rate") for c in ("valid", "tool_match", "exact", "duplicate")],
        F.count_if(yes(F.col("exact"))).alias("n_exact"),
        F.avg("target_similarity").alias("mean_target_similarity"),
        F.avg(F.when(F.col("target_similarity").isNotNull(), F.col("candidate_similarity"))).alias("mean_candidate_similarity"),
        F.avg(moved).alias("mean_movement"),
        rate(yes(moved > 1e-12)).alias("moved_rate"),
    )
    return out.withColumn("passed", (F.col("valid_rate") >= valid_share) & (F.col("tool_match_rate") >= tool_share) & (F.col("n_exact") >= exact_least))


def label_faults(input_ids: Column, labels: Column, ignored: int = -100) -> Column:
    """What is wrong with the labels of one sample, as an array of codes."""
    at = F.filter(F.transform(labels, lambda x, i: F.when(x != ignored, i)), lambda i: i.isNotNull())
    first, last = F.get(at, 0), F.element_at(F.concat(F.array(F.lit(-1)), at), -1)
    same, some = F.size(input_ids) == F.size(labels), F.size(at) > 0
    rules = (
        ("length_mismatch", ~same),
        ("nothing_supervised", same & ~some),
        ("not_contiguous", same & some & (last - first + 1 != F.size(at))),
        ("not_at_end", same & some & (last != F.size(labels) - 1)),
    )
    return F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in rules]))


def label_audit(samples: DataFrame, tool: str = "tool", ignored: int = -100) -> DataFrame:
    """One row per target tool and one for all (null tool): samples, lengths (exact percentiles),
    supervised tokens, and samples with faults. Columns: input_ids, labels and the tool."""
    n = F.size(F.filter("labels", lambda x: x != ignored)).cast("long")
    whole = F.size("input_ids") == F.size("labels")
    facts = samples.select(
        F.col(tool).alias("tool"),
        F.size("input_ids").cast("long").alias("length"),
        F.when(whole & (n > 0), n).alias("supervised"),
        (F.size(label_faults(F.col("input_ids"), F.col("labels"), ignored)) > 0).alias("bad"),
    )
    at = lambda q: F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY length)")
    aggs = (
        F.count(F.lit(1)).alias("n"),
        at(0.5).alias("p50"),
        at(0.95).alias("p95"),
        F.max("length").alias("longest"),
        F.coalesce(F.sum("supervised"), F.lit(0)).alias("supervised"),
        F.avg("supervised").alias("supervised_mean"),
        F.count_if("bad").alias("n_bad"),
    )
    return facts.where("tool IS NOT NULL").groupBy("tool").agg(*aggs).unionByName(facts.agg(*aggs).withColumn("tool", F.lit(None).cast("string")))
