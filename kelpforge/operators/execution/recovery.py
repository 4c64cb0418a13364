"""Which edits made a mutant, trajectories grounded in a partial repair, and what is built of them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpforge.functions.hashing import content_hash, rank_key, stable_episode_id
from kelpforge.functions.prompts import split_state
from kelpforge.functions.pynorm import code_hash, complete_code
from kelpforge.operators.execution.edits import apply_edits, single_edits
from kelpforge.operators.execution.episodes import _message
from kelpforge.operators.execution.grade import grade_distinct
from kelpforge.operators.execution.sandbox import Limits

_FOUND = "sample_id string, matches array<array<string>>, n_edits int, n_recorded int, n_tried int"


def recover_edits(mutants: DataFrame) -> DataFrame:
    """The sets of edits that turn a reference into a given mutant.

    ``mutants``: (sample_id, reference, candidate, records array<struct<rule, before, after>>,
    bugs). Only edits like a recorded one are tried, each record at most as often as it was
    recorded; equal normal forms decide. Several sets may fit, since a record doesn't tell its
    place: all are returned, by the edits' keys, and none is preferred. ``n_tried`` counts the
    sets that respect the records.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(r.sample_id, *_recover(r.reference, r.candidate, [(x["rule"], x["before"], x["after"]) for x in r.records], int(r.bugs))) for r in pdf.itertuples(index=False)], columns=[c.split()[0] for c in _FOUND.split(", ")])

    return mutants.select("sample_id", "reference", "candidate", "records", "bugs").mapInPandas(work, _FOUND)


def _recover(reference: str, candidate: str, records: list[tuple], bugs: int) -> tuple[list[list[str]], int, int, int]:
    supply, edits = Counter(records), single_edits(reference)
    like = [e for e in edits if (e.rule, e.before, e.after) in supply]
    goal, tried, found = code_hash(candidate), 0, set()
    for chosen in combinations(like, bugs):
        if Counter((e.rule, e.before, e.after) for e in chosen) - supply:
            continue
        tried += 1
        try:
            made = apply_edits(reference, list(chosen))
        except (SyntaxError, ValueError, TypeError):
            continue
        if code_hash(made) == goal:
            found.add(tuple(sorted(e.key for e in chosen)))
    return [list(k) for k in sorted(found)], len(edits), len(like), tried


def grounded_steps(repairs: DataFrame) -> DataFrame:
    """Three samples of each repair that a partial undo improves: submit the partial program, run
    what it then fails on, submit the reference.

    ``repairs``: (sample_id, state, history, partial, partial_feedback, next_input, run_feedback,
    reference), history being an array of struct<from, value>. The state of the first sample
    says whether a run came before.
    """
    c = F.col
    say = lambda who, value: F.struct(F.lit(who).alias("from"), value.alias("value"))
    call = lambda tool, name, value: say("function_call", F.to_json(F.struct(F.lit(tool).alias("name"), F.struct(value.alias(name)).alias("arguments"))))
    submit, run, final = call("submit", "code", c("partial")), call("run_candidate", "input", c("next_input")), call("submit", "code", c("reference"))
    failed, shown = say("observation", c("partial_feedback")), say("observation", c("run_feedback"))
    first = F.when(c("state") == "first_failure_direct_repair", "first_failure_direct_repair").otherwise("post_run_repair")
    steps = ((first, "submit", [submit]), (F.lit("second_failure_run"), "run_candidate", [submit, failed, run]), (F.lit("multiround_final_submit"), "submit", [submit, failed, run, shown, final]))
    made = [F.struct(state.alias("state"), F.lit(tool).alias("target_tool"), F.concat("history", F.array(*turns)).alias("conversations")) for state, tool, turns in steps]
    out = repairs.select("sample_id", F.posexplode(F.array(*made)).alias("step", "s"))
    return out.select(F.concat("sample_id", F.lit(":grounded:"), (c("step") + 1).cast("string")).alias("sample_id"), F.col("sample_id").alias("source_id"), "s.*")


def native_turns(episodes: DataFrame, dropped: Sequence[str] = ("pre_submit_active_validation",)) -> DataFrame:
    """Episodes whose state was written into the user's text, with real turns instead: the failed
    submit and its feedback become messages of their own that aren't trained on.

    ``episodes``: (episode_id, behavior, messages), without those of ``dropped`` behaviours. An
    episode without a candidate in its text stays as it is; one with a candidate but no feedback
    has the reason ``no_feedback`` and no messages.
    """
    m = F.col("messages")
    user = F.array_position(F.transform(m, lambda x: x["role"]), "user").cast("int")
    problem, candidate, feedback = split_state(F.element_at(m, user)["content"])
    said = _message("user", problem, False)
    failed = [_message("assistant", F.lit(""), False, F.lit("submit"), candidate), _message("tool", feedback, False)]
    rebuilt = F.concat(F.slice(m, 1, user - 1), F.array(said, *failed), F.slice(m, user + 1, F.size(m)))
    kept = episodes.where(~F.col("behavior").isin(*dropped))
    whole = (user == 0) | candidate.isNull()
    return kept.select("episode_id", "behavior", F.when(whole, m).when(feedback.isNotNull(), rebuilt).alias("messages"), F.when(~whole & feedback.isNull(), "no_feedback").alias("reason"))


def assemble(supply: DataFrame, needs: Mapping[str, int], direct: int, rounds: int = 1, difficulties: Sequence[str] = ("competition", "introductory", "interview"), seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(picks, shortages): a small set by need, every program used once.

    ``supply``: (program_id, difficulty, code_hash, ord, kind, behaviors); kind is reference,
    single or multi, and behaviors the array of those that a single has material for. References
    give ``direct`` rows, one of each difficulty first and then in order; singles serve the
    needs in their order by seeded hash rank; multis give ``rounds`` rows in order. A pick is a
    bounded top-n, never a sort of the supply.
    """
    once = supply.groupBy("code_hash").agg(F.min_by(F.struct(*[c for c in supply.columns if c != "code_hash"]), F.struct("kind", "ord", "program_id")).alias("r")).select("code_hash", "r.*")
    refs = once.where("kind = 'reference'")
    place = F.coalesce(F.create_map(*[F.lit(x) for kv in zip(difficulties, range(len(difficulties))) for x in kv])[F.col("difficulty")], F.lit(len(difficulties)))
    heads = refs.where(F.col("difficulty").isin(*difficulties)).groupBy("difficulty").agg(F.min(F.struct("ord", "program_id")).alias("h")).select(F.col("h.program_id").alias("program_id"), F.lit(True).alias("_head"))
    ranked = refs.join(F.broadcast(heads), "program_id", "left").orderBy(F.coalesce("_head", F.lit(False)).desc(), F.when(F.col("_head"), place), "ord", "program_id")
    parts = [ranked.limit(direct).select("program_id", F.lit("direct_submission").alias("behavior"))]
    singles, taken = once.where("kind = 'single'"), []
    for behavior, need in needs.items():
        left = reduce(lambda df, t: df.join(F.broadcast(t), "program_id", "left_anti"), taken, singles)
        pick = left.where(F.array_contains("behaviors", behavior)).orderBy(rank_key(str(seed), "program_id"), "program_id").limit(need)
        taken.append(pick.select("program_id"))
        parts.append(pick.select("program_id", F.lit(behavior).alias("behavior")))
    parts.append(once.where("kind = 'multi'").orderBy("ord", "program_id").limit(rounds).select("program_id", F.lit("multiround").alias("behavior")))
    picks = reduce(DataFrame.unionByName, parts)
    want = supply.sparkSession.createDataFrame([("direct_submission", direct), *needs.items(), ("multiround", rounds)], "behavior string, need long")
    got = picks.groupBy("behavior").agg(F.count(F.lit(1)).alias("n"))
    short = want.join(got, "behavior", "left").select("behavior", (F.col("need") - F.coalesce("n", F.lit(0))).alias("missing")).where("missing > 0")
    return picks, short


def single_shot(outputs: DataFrame, cases: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Every output (problem_id, ord, raw) of a model, graded; equal programs of a problem run
    once, and an output without a program that compiles has the status no_code."""
    read = outputs.withColumn("code", F.pandas_udf(lambda s: s.map(complete_code), "string")("raw"))
    read = read.withColumn("program_id", F.concat_ws("/s", F.col("problem_id").cast("string"), F.col("ord").cast("string")))
    g = grade_distinct(read.where("code IS NOT NULL").select("program_id", "problem_id", "code"), cases, limits).select("program_id", "passed", "total", "pass_rate", "status")
    return read.select("program_id", "problem_id", "ord").join(g, "program_id", "left").withColumns({"pass_rate": F.coalesce("pass_rate", F.lit(0.0)), "status": F.coalesce("status", F.lit("no_code"))})


def query_block(behavior: Column, given: Column, failing: Column, proposal: Column) -> Column:
    """What an episode ran and where the input came from; ``proposal`` is a struct of model,
    prompt_hash and raw_hash, or null."""
    kind = F.when(behavior == "post_submit_failure_replay", "submit_failing_case").when(behavior == "pre_submit_active_validation", "model_proposed").otherwise("none")
    proposed = kind == "model_proposed"
    return F.struct(
        kind.alias("kind"),
        F.when(kind != "none", content_hash(F.coalesce(given, F.lit("")))).alias("input_hash"),
        *[F.when(proposed, proposal[n]).alias(f"proposal_{n}") for n in ("model", "prompt_hash", "raw_hash")],
        ((kind == "submit_failing_case") & given.eqNullSafe(failing)).alias("matches_failing_input"),
    )


def outcome_episodes(outcomes: DataFrame) -> DataFrame:
    """Episodes of measured behaviours, each from its first accepted attempt.

    ``outcomes``: (problem_id, behavior, origin, code_hash, reference_hash, failing_input, given,
    proposal, direct, with_run), the last two arrays of struct<accepted, final_hash, messages>.
    A direct repair takes an attempt without a run, other behaviours one with a run. A mutant's
    episode must end in the reference's normal form: another program that passes doesn't prove
    that every edit was undone.
    """
    pool = F.when(F.col("behavior") == "post_submit_direct_repair", F.col("direct")).otherwise(F.col("with_run"))
    won = outcomes.where("behavior IS NOT NULL").withColumn("a", F.get(F.filter(pool, lambda x: x["accepted"]), 0)).where("a IS NOT NULL")
    proven = ~F.col("origin").isin("synthetic_single", "synthetic_multi") | (F.col("a.final_hash") == F.col("reference_hash"))
    tools = F.transform(F.filter("a.messages", lambda x: (x["role"] == "assistant") & x["tool"].isNotNull()), lambda x: x["tool"])
    steps = F.filter(F.transform("a.messages", lambda x, i: F.when((x["role"] == "assistant") & x["trainable"], i)), lambda i: i.isNotNull())
    return won.where(proven).select(
        stable_episode_id(F.col("problem_id").cast("string"), F.col("behavior"), F.concat_ws(":", F.col("problem_id").cast("string"), "behavior", "code_hash")).alias("episode_id"),
        "problem_id",
        "behavior",
        "origin",
        F.col("a.messages").alias("messages"),
        F.col("a.final_hash").alias("final_code_hash"),
        tools.alias("tool_sequence"),
        F.size(tools).alias("tool_call_count"),
        steps.alias("decision_steps"),
        query_block(F.col("behavior"), F.col("given"), F.col("failing_input"), F.col("proposal")).alias("execution_query"),
    )
