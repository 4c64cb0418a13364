"""Turn analytics: one row per turn, windows over the conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _over(conv: str, turn: str):
    return Window.partitionBy(conv).orderBy(turn)


def _before(conv: str, turn: str):
    return _over(conv, turn).rowsBetween(Window.unboundedPreceding, -1)


def running_count(cond: Column, conv: str = "conv_id", turn: str = "turn") -> Column:
    """How many earlier turns fulfil ``cond``."""
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)).over(_before(conv, turn)), F.lit(0)).cast("long")


def latest_before(cond: Column, value: Column, conv: str = "conv_id", turn: str = "turn") -> Column:
    """``value`` of the latest earlier turn that fulfils ``cond``."""
    return F.last(F.when(cond, value), ignorenulls=True).over(_before(conv, turn))


def action_state(target: Column, failures: Column, runs: Column) -> Column:
    """The state of a supervised action by its history: submits that failed and runs so far."""
    submit, run = target == "submit", target == "run_candidate"
    return (
        F.when(submit & (failures == 0), "problem_submit")
        .when(run & (failures == 1) & (runs == 0), "first_failure_run")
        .when(submit & (failures == 1) & (runs == 0), "first_failure_direct_repair")
        .when(submit & (failures == 1), "post_run_repair")
        .when(run & (failures >= 2), "second_failure_run")
        .when(submit & (failures >= 2) & (runs >= 2), "multiround_final_submit")
        .when(failures >= 2, "post_run_repair")
        .otherwise("other")
    )


#: The state of a sample by its number of turns (target included) and its tool.
STATES_BY_LENGTH = {
    (2, "submit"): "problem_submit",
    (4, "run_candidate"): "first_failure_run",
    (4, "submit"): "first_failure_direct_repair",
    (6, "submit"): "post_run_repair",
    (8, "run_candidate"): "second_failure_run",
    (10, "submit"): "multiround_final_submit",
}


def state_by_length(n_turns: Column, target: Column) -> Column:
    """The state of a supervised action by the number of its turns and its tool alone."""
    out = F.lit("other")
    for (n, tool), state in STATES_BY_LENGTH.items():
        out = F.when((n_turns == n) & (target == tool), state).otherwise(out)
    return out


def answered_call(observation: Column, call: Column, value: Column, conv: str = "conv_id", turn: str = "turn") -> Column:
    """For a turn that is an observation, ``value`` of the call right before it, which it answers;
    null for other turns and for an observation that follows no call."""
    w = _over(conv, turn)
    return F.when(observation & F.lag(call).over(w), F.lag(value).over(w))


def last_observation(conversations: Column) -> Column:
    """The text of the turn before the target (the last one) if that is an observation, else null."""
    before = F.try_element_at(conversations, F.lit(-2))
    return F.when(before["from"] == "observation", before["value"])


def native_history(messages: Column) -> Column:
    """Whether the first submit of an assistant is masked and its own tool's answer comes next.

    ``messages`` are structs of role, name (of the call or of the answering tool) and trainable;
    a submit in the last place counts for nothing."""
    numbered = F.transform(messages, lambda m, i: F.struct(m.alias("m"), F.try_element_at(messages, (i + 2).cast("int")).alias("next")))
    submits = F.filter(numbered, lambda x: (x["m"]["role"] == "assistant") & (x["m"]["name"] == "submit") & x["next"].isNotNull())
    first = F.try_element_at(submits, F.lit(1))
    masked = ~F.coalesce(first["m"]["trainable"], F.lit(False))
    return F.coalesce(masked & (first["next"]["role"] == "tool") & (first["next"]["name"] == "submit"), F.lit(False))


def transitions(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", kind: str = "role") -> DataFrame:
    """(kind, next kind, n): what follows what; the end is a null next kind."""
    nxt = turns.select(F.col(kind).alias("kind"), F.lead(kind).over(_over(conv, turn)).alias("next_kind"))
    return nxt.groupBy("kind", "next_kind").agg(F.count(F.lit(1)).alias("n"))


def prefix_samples(turns: DataFrame, target: str = "assistant", conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row for each turn of ``target``: sample_id, its position, and the cumulative history."""
    piece = F.concat_ws(":", F.col("role"), F.coalesce("text", F.lit("")))
    past = F.collect_list(piece).over(_before(conv, turn))
    rows = turns.select(conv, turn, "role", "text", past.alias("history")).where(F.col("role") == target)
    return rows.select(F.concat(F.col(conv).cast("string"), F.lit(":m"), F.col(turn).cast("string")).alias("sample_id"), F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), "history", F.col("text").alias("target"))


def role_sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, roles): the first letters of the roles in order."""
    seq = F.sort_array(F.collect_list(F.struct(turn, F.substring("role", 1, 1).alias("r"))))
    return turns.groupBy(conv).agg(F.array_join(F.transform(seq, lambda x: x["r"]), "").alias("roles"))


def sharegpt_roles_ok(conversations: Column) -> Column:
    """Whether even places are from a human or an observation and odd ones a call."""
    return F.forall(
        F.transform(conversations, lambda x, i: F.when(i % 2 == 0, x["from"].isin("human", "observation")).otherwise(x["from"] == "function_call")),
        lambda ok: ok,
    )


def merge_intervals(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Touching or overlapping intervals of a key as one: (key, island_start, island_end, n)."""
    w = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0))
    grouped = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(key, "_island").agg(F.min(start).alias("island_start"), F.max(end).alias("island_end"), F.count(F.lit(1)).alias("n")).drop("_island")
