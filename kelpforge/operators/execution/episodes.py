"""Episodes from graded candidates: behaviours by supply, messages, and their export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpforge.functions.hashing import rank_key, stable_episode_id

#: Behaviours in order of priority with their caps (null: none).
PRIORITY = (("multiround", 250), ("pre_submit_active_validation", 0), ("post_submit_failure_replay", None), ("post_submit_direct_repair", None), ("direct_submission", None))


def assign_behaviors(supply: DataFrame, caps: Sequence[tuple[str, int | None]] = PRIORITY, seed: int = 42) -> DataFrame:
    """One row per problem: the behaviour of highest priority among those it has material for.

    ``supply``: (problem_id, behavior). A cap holds over all problems, taken in hash order of
    the seed; a problem beyond the cap falls to its next behaviour. Only capped behaviours need
    a global rank, each over its own candidates, and WindowGroupLimit keeps ``cap`` of each
    task's rows.
    """
    left, out = supply.select("problem_id", "behavior").distinct(), None
    for name, cap in caps:
        mine = left.where(F.col("behavior") == name).select("problem_id", "behavior")
        if cap is not None:
            rank = F.row_number().over(Window.partitionBy("behavior").orderBy(rank_key(str(seed), "problem_id"), "problem_id"))
            mine = mine.withColumn("_r", rank).where(F.col("_r") <= cap).drop("_r")
        out = mine if out is None else out.unionByName(mine)
        left = left.join(mine.select("problem_id"), "problem_id", "left_anti")
    return out


def _message(role: str, content: Column, trainable: bool, name: Column | None = None, code: Column | None = None, given: Column | None = None) -> Column:
    args = F.create_map(F.lit("code"), code) if code is not None else F.create_map(F.lit("input"), given) if given is not None else F.lit(None).cast("map<string,string>")
    return F.struct(
        F.lit(role).alias("role"),
        content.cast("string").alias("content"),
        (name if name is not None else F.lit(None).cast("string")).alias("tool"),
        args.alias("arguments"),
        F.lit(trainable).alias("trainable"),
    )


def feedback_json(status: Column, passed: Column, total: Column, failing_input: Column) -> Column:
    rate = F.when(total > 0, passed / total).otherwise(F.lit(0.0))
    return F.to_json(F.struct(failing_input.alias("failing_input"), rate.alias("pass_rate"), passed.alias("passed"), status.alias("status"), total.alias("total")), {"ignoreNullFields": "false"})


def build_messages(rows: DataFrame) -> DataFrame:
    """``messages`` and ``episode_id`` of rows with a behaviour and its material.

    Columns: problem_id, behavior, question, reference, total, and for repairs buggy, status,
    passed, failing_input, and where the behaviour runs code probe and observation; for
    multi-round partial with partial_status, partial_passed, partial_input. The buggy first
    submit isn't trained on; the actions that follow it are.
    """
    c = F.col
    user = _message("user", c("question"), False)
    right = [_message("assistant", F.lit(""), True, F.lit("submit"), c("reference")), _message("tool", feedback_json(F.lit("accepted"), c("total"), c("total"), F.lit(None).cast("string")), False)]
    seed = [_message("assistant", F.lit(""), False, F.lit("submit"), c("buggy")), _message("tool", feedback_json(c("status"), c("passed"), c("total"), c("failing_input")), False)]
    look = lambda given: [_message("assistant", F.lit(""), True, F.lit("run_candidate"), given=given), _message("tool", c("observation"), False)]
    half = [_message("assistant", F.lit(""), True, F.lit("submit"), c("partial")), _message("tool", feedback_json(c("partial_status"), c("partial_passed"), c("total"), c("partial_input")), False)]
    shapes = {
        "direct_submission": [user, *right],
        "post_submit_direct_repair": [user, *seed, *right],
        "post_submit_failure_replay": [user, *seed, *look(c("failing_input")), *right],
        "pre_submit_active_validation": [user, *look(c("probe")), *right],
        "multiround": [user, *seed, *look(c("failing_input")), *half, *right],
    }
    messages = F.lit(None)
    for name, parts in shapes.items():
        messages = F.when(c("behavior") == name, F.array(*parts)).otherwise(messages)
    payload = F.concat_ws("\x1f", "problem_id", "behavior", "reference", F.coalesce("buggy", F.lit("")))
    return rows.withColumn("messages", messages).withColumn("episode_id", stable_episode_id(F.col("problem_id").cast("string"), F.col("behavior"), payload))


def public_messages(episodes: DataFrame) -> DataFrame:
    """(id, messages, metadata_ref) without the training flags: what is published."""
    m = F.transform("messages", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), x["tool"].alias("tool"), x["arguments"].alias("arguments")))
    return episodes.select(F.col("episode_id").alias("id"), m.alias("messages"), F.col("episode_id").alias("metadata_ref"))


def episode_issues(episodes: DataFrame) -> DataFrame:
    """(episode_id, code): structural rules of episodes.

    They end in an accepted submit and its feedback; every call is followed by a tool message;
    only assistants are trainable, and something is; repairs start with an untrained submit.
    """
    m = F.col("messages")
    nth = lambda i: F.element_at(m, i)
    follows = F.forall(F.sequence(F.lit(1), F.size(m)), lambda i: F.coalesce(F.element_at(m, i)["role"] != "assistant", F.lit(False)) | ((i < F.size(m)) & (F.element_at(m, F.least(i + 1, F.size(m)))["role"] == "tool")))
    rules = (
        ("not_accepted", ~F.coalesce((nth(-2)["tool"] == "submit") & F.contains(nth(-1)["content"], F.lit('"status":"accepted"')), F.lit(False))),
        ("call_without_observation", ~follows),
        ("trainable_role", F.exists(m, lambda x: x["trainable"] & (x["role"] != "assistant"))),
        ("nothing_trainable", ~F.exists(m, lambda x: x["trainable"])),
        ("seed_trained", F.col("behavior").isin("post_submit_direct_repair", "post_submit_failure_replay", "multiround") & nth(2)["trainable"]),
    )
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in rules]))
    return episodes.select("episode_id", F.explode(broken).alias("code"))
