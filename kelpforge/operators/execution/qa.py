"""Static checks of episodes and their metadata, as issue tables; retention and report rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpforge.operators.quality import FEEDBACK_KEYS, leaks
from kelpforge.operators.checks import pending
from kelpforge.session import materialize

#: The keys of metadata, and the values that its fields may have.
REQUIRED = (
    "schema_version", "episode_id", "id", "dataset", "dataset_split", "pool",
    "difficulty", "io_mode", "question_hash", "starter_code_hash", "reference", "candidate",
    "mutation", "seed_submit", "counterfactual", "execution_query", "behavior_sequence", "decision_steps",
    "solution_origin", "final_code_hash", "final_pass_rate", "final_replay_passed", "tool_sequence", "tool_call_count",
    "model", "runtime", "quality", "created_at",
)
OPTIONAL = ("mutation_set_hash", "label_method")
ORIGINS = ("synthetic_single", "synthetic_multi", "model_natural_failure", "verified_reference", "model_natural_correct")
BEHAVIORS = ("post_submit_direct_repair", "post_submit_failure_replay", "pre_submit_active_validation", "direct_submission")
DIFFICULTIES = ("introductory", "interview", "competition")
REFERENCE_KEYS = ("code_hash", "replay_count", "solution_index", "verification_pass_rate", "verified")
QUALITY_KEYS = ("duplicate_of", "leakage_scan_passed", "loss_mask_valid", "reject_reasons", "replay_valid", "schema_valid")
OBSERVATION_KEYS = ("error", "exit_code", "status", "stderr", "stdout", "truncated")
_HASH = "^sha256:.{64}$"


def _or_false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def metadata_issues(rows: DataFrame, pool: str = "sft", dataset: str | None = None) -> DataFrame:
    """(episode_id, code) for every rule that ``metadata`` (JSON text) of an episode breaks."""
    m = F.try_parse_json("metadata")
    text = lambda path: F.try_variant_get(m, path, "string")
    num = lambda path: F.try_variant_get(m, path, "double")
    flag = lambda path: _or_false(F.try_variant_get(m, path, "boolean"))
    strings = lambda path: F.try_variant_get(m, path, "array<string>")
    given = lambda path: ~F.coalesce(F.schema_of_variant(F.try_variant_get(m, path, "variant")), F.lit("VOID")).isin("VOID")
    keys = lambda c: F.array_sort(F.coalesce(F.json_object_keys(c), F.array().cast("array<string>")))
    part = lambda path: F.to_json(F.try_variant_get(m, path, "variant"))
    lits = lambda xs: F.array(*map(F.lit, xs))
    top = keys(F.col("metadata"))
    tools, first = F.coalesce(strings("$.tool_sequence"), F.array().cast("array<string>")), F.get(strings("$.behavior_sequence"), 0)
    origin, rule = text("$.candidate.origin"), _or_false(text("$.label_method") == "rule_design")
    edits = F.coalesce(F.size(F.try_variant_get(m, "$.mutation.edits", "array<variant>")), F.lit(-1))
    bugs = num("$.mutation.bug_count")
    single = (bugs == 1) & (num("$.mutation.semantic_edit_count") == 1) & (edits == 1)
    multi = bugs.isin(2, 3, 4) & (num("$.mutation.semantic_edit_count") == bugs) & (edits == bugs) & flag("$.mutation.all_individually_harmful") & flag("$.mutation.survivor_check_passed") & ~F.coalesce(F.try_variant_get(m, "$.mutation.masked_mutation", "boolean"), F.lit(True))
    kind = text("$.execution_query.kind")
    proposed = (kind == "model_proposed") & text("$.execution_query.proposal_prompt_hash").rlike(_HASH) & text("$.execution_query.proposal_raw_hash").rlike(_HASH)
    rules: list[tuple[str, Column]] = [
        ("not_an_object", ~F.startswith(F.coalesce(F.schema_of_variant(m), F.lit("")), F.lit("OBJECT"))),
        ("missing_keys", F.size(F.array_except(lits(REQUIRED), top)) > 0),
        ("unknown_keys", F.size(F.array_except(top, lits((*REQUIRED, *OPTIONAL)))) > 0),
        ("schema_version", text("$.schema_version") == "1.0"),
        ("id", (F.trim(text("$.id")) != "") & ~F.schema_of_variant(F.try_variant_get(m, "$.id", "variant")).isin("BOOLEAN", "VOID")),
        ("dataset_split", text("$.dataset_split") == "train"),
        ("pool", text("$.pool") == pool),
        ("difficulty", text("$.difficulty").isin(*DIFFICULTIES)),
        ("io_mode", text("$.io_mode").isin("stdin", "call")),
        *((f"{k}_hash", text(f"$.{k}_hash").rlike(_HASH)) for k in ("question", "starter_code", "final_code")),
        ("reference_object", keys(part("$.reference")) == lits(REFERENCE_KEYS)),
        ("reference_verified", text("$.reference.code_hash").rlike(_HASH) & flag("$.reference.verified") & (num("$.reference.verification_pass_rate") == 1) & (num("$.reference.replay_count") >= 2)),
        ("candidate_origin", origin.isin(*ORIGINS)),
        ("candidate_hash", text("$.candidate.code_hash").rlike(_HASH)),
        ("behavior_sequence", (F.size(strings("$.behavior_sequence")) > 0) & F.forall(strings("$.behavior_sequence"), lambda b: b.isin(*BEHAVIORS))),
        ("final_pass_rate", num("$.final_pass_rate") == 1),
        ("final_replay", flag("$.final_replay_passed")),
        ("tool_sequence", F.forall(tools, lambda t: t.isin("run_candidate", "submit")) & (num("$.tool_call_count") == F.size(tools))),
        ("ends_in_submit", F.try_element_at(tools, F.lit(-1)) == "submit"),
        ("direct_submission_tools", (first != "direct_submission") | (tools == F.array(F.lit("submit")))),
        ("direct_repair_runs", (first != "post_submit_direct_repair") | ~F.array_contains(tools, "run_candidate")),
        ("direct_submission_counterfactual", (first != "direct_submission") | ~given("$.counterfactual")),
        ("counterfactual", (first == "direct_submission") | rule | given("$.counterfactual")),
        ("replay_query", (first != "post_submit_failure_replay") | ((kind == "submit_failing_case") & flag("$.execution_query.matches_submit_failing_input"))),
        ("validation_query", (first != "pre_submit_active_validation") | F.when(rule, kind.isin("model_proposed", "rule_constructed")).otherwise(proposed)),
        ("mutation_of_natural", origin.isin("synthetic_single", "synthetic_multi") | ~given("$.mutation")),
        ("single_evidence", (origin != "synthetic_single") | single),
        ("multi_evidence", (origin != "synthetic_multi") | multi),
        ("decision_steps", F.startswith(F.schema_of_variant(F.try_variant_get(m, "$.decision_steps", "variant")), F.lit("ARRAY"))),
        ("quality_object", keys(part("$.quality")) == lits(QUALITY_KEYS)),
    ]
    if dataset is not None:
        rules.append(("dataset", text("$.dataset") == dataset))
    bad = {"not_an_object", "missing_keys", "unknown_keys"}  # these state the fault, the others what must hold
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)) if name in bad else ~_or_false(c), F.lit(name)) for name, c in rules]))
    # of what isn't an object nothing else can be said
    broken = F.when(F.array_contains(broken, "not_an_object"), F.array(F.lit("not_an_object"))).otherwise(broken)
    return rows.select("episode_id", F.explode(broken).alias("code"))


def static_issues(episodes: DataFrame) -> DataFrame:
    """(episode_id, code, severity): protocol rules over ``messages`` and ``behavior``.

    Messages have role, content, tool, arguments and trainable. The checks look at neighbours
    by position inside the array, so an episode is one row and nothing is shuffled.
    """
    m = F.col("messages")
    last = F.size(m)
    at = lambda i: F.element_at(m, i)
    calls = F.filter(m, lambda x: (x["role"] == "assistant") & x["tool"].isNotNull())
    trained = F.filter(calls, lambda x: x["trainable"])
    names, trained_names = F.transform(calls, lambda x: x["tool"]), F.transform(trained, lambda x: x["tool"])
    args_ok = lambda x: F.when(x["tool"] == "submit", (F.map_keys(x["arguments"]) == F.array(F.lit("code"))) & (F.trim(x["arguments"]["code"]) != "")).when(x["tool"] == "run_candidate", F.map_keys(x["arguments"]) == F.array(F.lit("input"))).otherwise(False)
    where = F.sequence(F.lit(1), F.greatest(last, F.lit(1)))
    nxt = lambda i: at(F.least(i + 1, last))
    status = lambda x: F.get_json_object(x["content"], "$.status")
    keys = lambda x: F.array_sort(F.json_object_keys(x["content"]))
    is_submit = lambda x: _or_false((x["role"] == "assistant") & (x["tool"] == "submit"))
    answers_submit = lambda i: (i > 1) & is_submit(at(F.greatest(i - 1, F.lit(1))))
    b = F.col("behavior")
    rules: list[tuple[str, str, Column]] = [
        ("tool_contract", "P0", F.exists(calls, lambda x: ~_or_false(args_ok(x)))),
        ("submit_without_response", "P0", F.exists(where, lambda i: is_submit(at(i)) & ((i == last) | (nxt(i)["role"] != "tool")))),
        ("buggy_code_trainable", "P0", F.exists(where, lambda i: is_submit(at(i)) & at(i)["trainable"] & (i < last) & ~_or_false(status(nxt(i)) == "accepted"))),
        ("loss_mask", "P0", F.exists(m, lambda x: x["trainable"] & (x["role"] != "assistant"))),
        ("feedback_fields", "P0", F.exists(where, lambda i: (at(i)["role"] == "tool") & answers_submit(i) & ~_or_false(keys(at(i)) == F.array(*map(F.lit, FEEDBACK_KEYS))))),
        ("oracle_leakage", "P0", F.exists(m, lambda x: leaks(x["content"], x["role"]))),
        ("final_not_accepted", "P0", ~_or_false((last > 1) & is_submit(at(F.greatest(last - 1, F.lit(1)))) & (at(last)["role"] == "tool") & (status(at(last)) == "accepted"))),
        ("direct_submission_protocol", "P1", (b == "direct_submission") & ~(names == F.array(F.lit("submit")))),
        ("direct_repair_protocol", "P1", (b == "post_submit_direct_repair") & (F.array_contains(names, "run_candidate") | (trained_names != F.array(F.lit("submit"))))),
        ("run_first_protocol", "P1", b.isin("post_submit_failure_replay", "pre_submit_active_validation") & (~F.array_contains(names, "run_candidate") | ~_or_false(F.get(trained_names, 0) == "run_candidate"))),
        ("nothing_trainable", "P1", F.size(trained) == 0),
    ]
    broken = F.array_compact(F.array(*[F.when(_or_false(bad), F.struct(F.lit(c).alias("code"), F.lit(s).alias("severity"))) for c, s, bad in rules]))
    return episodes.where(F.size("messages") > 0).select("episode_id", F.explode(broken).alias("i")).select("episode_id", "i.code", "i.severity")


def supervision_issues(rows: DataFrame) -> DataFrame:
    """(episode_id, code): what a decoded supervised text may not hold, and what it must.

    Columns: episode_id, supervised (text), trained_calls, failed_codes and tool_contents
    (arrays of text)."""
    has = lambda x: F.contains(F.col("supervised"), x)
    rules = (
        ("call_missing", F.exists("trained_calls", lambda x: ~has(x))),
        ("failed_code_supervised", F.exists("failed_codes", lambda x: has(x))),
        ("tool_content_supervised", F.exists("tool_contents", lambda x: (F.length(x) >= 8) & has(x))),
    )
    broken = F.array_compact(F.array(*[F.when(_or_false(bad), F.lit(code)) for code, bad in rules]))
    return rows.select("episode_id", F.explode(broken).alias("code"))


def retention_reason(state: Column, origin: Column, bug_count: Column) -> Column:
    """Why a state-labelled sample stays in the narrowed set, else null."""
    single = origin == "synthetic_single"
    return (
        F.when(state == "problem_submit", "reference_submit")
        .when((state == "first_failure_run") & single, "single_first_failure")
        .when(state.isin("first_failure_direct_repair", "post_run_repair") & single, "single_repair")
        .when(state == "second_failure_run", "multiround_router")
        .when((state == "multiround_final_submit") & (bug_count == 2), "final_repair")
    )


def drop_until_clean(rows: DataFrame, check: Callable[[DataFrame], DataFrame], key: str = "episode_id", rounds: int = 6) -> tuple[DataFrame, int]:
    """(rows without those that ``check`` complains about, rounds): checks again after each drop,
    since a check may depend on what else is there. More than ``rounds`` is an error."""
    for n in range(rounds + 1):
        bad = materialize(check(rows).select(key).distinct(), "bad")
        if bad.limit(1).count() == 0:
            return rows, n
        rows = materialize(pending(rows, bad, key), "rest")
    raise ValueError(f"still not clean after {rounds} rounds")
