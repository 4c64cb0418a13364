"""Evaluation sets, reviews, probes and grounded trajectories."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpforge.operators import evalset, review
from kelpforge.operators.execution import recovery
from kelpforge.operators.execution.edits import apply_edits, single_edits
from kelpforge.plans.catalog import query
from kelpforge.plans.q_code import _DIV, _SUM, _values, cases
from kelpforge.session import table

_TURN = "array<struct<role:string,content:string,tool:string,arguments:map<string,string>,trainable:boolean>>"


@query(
    "smoke_sample",
    "WITH m AS (SELECT event_id, event_type, CASE WHEN value > 99.5 THEN 'high' ELSE 'low' END AS mode, CASE event_type WHEN 'click' THEN 41 ELSE 25 END AS want FROM events WHERE event_type IN ('click', 'view')), "
    "a AS (SELECT *, row_number() OVER (PARTITION BY event_type, mode ORDER BY event_id) AS r FROM m), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY r > want // 2, event_id) AS k FROM a) SELECT event_id, event_type, mode FROM k WHERE k <= want",
)
def smoke_sample_query(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "event_type", F.when(F.col("value") > 99.5, "high").otherwise("low").alias("mode"))
    return evalset.smoke_sample(e, {"click": 41, "view": 25}, "event_type", "mode", "event_id")


@query(
    "fixed_set_manifest",
    "WITH r AS (SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY sha256('42:' || doc_id), doc_id) AS r FROM documents) "
    """SELECT lang, count(*) AS n_rows, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids, sha256(string_agg('{"doc_id":' || doc_id || ',"lang":"' || lang || '","n_chars":' || n_chars || '}', chr(10) ORDER BY doc_id) || chr(10)) AS sha256 FROM r WHERE r <= 25 GROUP BY lang""",
)
def fixed_set_manifest(spark: SparkSession, sf: str) -> DataFrame:
    _, held = evalset.fixed_set(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "lang", "doc_id", 25, "42")
    return held.withColumn("ids", F.array_join(F.transform("ids", lambda x: x.cast("string")), ","))


@query(
    "strata_diff",
    "SELECT d.lang, count(*) FILTER (WHERE l.doc_id IS NULL) AS n_left_only, CAST(0 AS BIGINT) AS n_right_only FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY d.lang HAVING n_left_only > 0",
)
def strata_diff_query(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("lang", "doc_id")
    return evalset.strata_diff(d, d.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi"), "lang", "doc_id")


@query(
    "running_cap",
    "SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r FROM events) WHERE r <= CASE event_type WHEN 'click' THEN 20 WHEN 'view' THEN 0 ELSE 30 END",
)
def running_cap(spark: SparkSession, sf: str) -> DataFrame:
    return evalset.first_of_strata(table(spark, sf, "events").select("event_id", "event_type"), "event_type", "event_id", 30, {"click": 10, "view": 40})


@query(
    "eval_set_issues",
    _values(
        "subject VARCHAR, code VARCHAR",
        ("1", "duplicate_id"), ("competition", "wrong_count"), ("x2", "bad_id"), ("3", "bad_difficulty"), ("3", "bad_io_mode"), ("4", "empty_question"), ("4", "no_starter_code"),
        ("5", "fn_name_without_call"), ("6", "bad_tests"), ("7", "bad_tests"), ("8", "unusable_input"), ("9", "unusable_output"),
    ),
)
def eval_set_issues_query(spark: SparkSession, sf: str) -> DataFrame:
    """Nine rows with one or two faults each; six of the difficulty 'interview' are right."""
    good = dict(problem_id="1", difficulty="interview", question="q", starter_code="", io_mode="stdin", fn_name=None, inputs=["1"], outputs=["1"])
    faults = (
        {}, {"difficulty": "introductory"}, {"problem_id": "x2"}, {"problem_id": "3", "difficulty": "hard", "io_mode": "file"}, {"problem_id": "4", "question": " ", "starter_code": None},
        {"problem_id": "5", "fn_name": "f"}, {"problem_id": "6", "outputs": []}, {"problem_id": "7", "inputs": None}, {"problem_id": "8", "io_mode": "call", "fn_name": "f", "inputs": ["["]},
        {"problem_id": "9", "difficulty": "introductory", "outputs": ["nope"]},
    )
    rows = spark.createDataFrame([tuple((good | f).values()) for f in faults], "problem_id string, difficulty string, question string, starter_code string, io_mode string, fn_name string, inputs array<string>, outputs array<string>")
    return evalset.eval_set_issues(rows, {"introductory": 2, "interview": 7, "competition": 1})


@query(
    "review_issues",
    _values(
        "subject VARCHAR, code VARCHAR, severity VARCHAR",
        ("row 3", "duplicate", "P1"), ("row 4", "unknown_episode", "P1"), ("row 5", "invalid_schema", "P1"), ("row 6", "not_an_object", "P1"), ("row 7", "no_episode_id", "P1"),
        ("e2", "severe", "P0"), ("replay", "too_few_of_behavior", "P1"), ("all", "too_few_reviews", "P1"), ("all", "too_few_positive", "P1"),
    ),
)
def review_issues_query(spark: SparkSession, sf: str) -> DataFrame:
    """Row 1 is invalid in no way, row 2 is severe, row 3 repeats row 1, row 5 lacks a reviewer and
    so leaves its behaviour without a review."""
    full = dict(reviewer="r", observable_evidence_supported=True, trajectory_natural=True, severe_issue=False)
    lines = [{"episode_id": "e1"} | full, {"episode_id": "e2"} | full | {"severe_issue": True}, {"episode_id": "e1"} | full, {"episode_id": "e9"} | full, {"episode_id": "e3"} | full | {"reviewer": " "}, [1], full | {"episode_id": 3}]
    reviews = spark.createDataFrame([(n + 1, json.dumps(x)) for n, x in enumerate(lines)], "position int, record string")
    return review.review_issues(reviews, spark.createDataFrame([("e1", "repair"), ("e2", "repair"), ("e3", "replay")], "episode_id string, behavior string"), least=3)


_NEAR = "CASE WHEN l_discount > 0.02 THEN l_discount END"
_MOVED = "coalesce(CASE WHEN l_discount > 0.02 THEN l_discount END - l_tax > 1e-12, false)"


@query(
    "probe_summary",
    f"SELECT l_returnflag, count(*) AS n, avg((l_quantity > 2)::INT) AS valid_rate, avg((l_linestatus = 'F')::INT) AS tool_match_rate, avg((l_discount > 0.09)::INT) AS exact_rate, avg((l_tax > 0.07)::INT) AS duplicate_rate, "
    f"count(*) FILTER (WHERE l_discount > 0.09) AS n_exact, avg({_NEAR}) AS mean_target_similarity, avg(l_quantity / 50) FILTER (WHERE l_discount > 0.02) AS mean_candidate_similarity, avg({_NEAR} - l_tax) AS mean_movement, "
    f"avg({_MOVED}::INT) AS moved_rate, avg((l_quantity > 2)::INT) >= 0.95 AND avg((l_linestatus = 'F')::INT) >= 0.5 AND n_exact >= 1 AS passed FROM lineitem GROUP BY 1",
)
def probe_summary_query(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    li = table(spark, sf, "lineitem").select(
        "l_returnflag", (c("l_quantity") > 2).alias("valid"), (c("l_linestatus") == "F").alias("tool_match"), (c("l_discount") > 0.09).alias("exact"), (c("l_tax") > 0.07).alias("duplicate"),
        F.when(c("l_discount") > 0.02, c("l_discount")).alias("target_similarity"), (c("l_quantity") / 50).alias("candidate_similarity"), c("l_tax").alias("baseline"),
    )
    return review.probe_summary(li, ["l_returnflag"], (0.95, 0.5, 1))


@query(
    "label_audit",
    # lengths 4, 2, 3, 5, 3; the faults are: a gap, not at the end, nothing supervised, other lengths
    _values(
        "tool VARCHAR, n BIGINT, p50 BIGINT, p95 BIGINT, longest BIGINT, supervised BIGINT, supervised_mean DOUBLE, n_bad BIGINT",
        ("submit", 3, 3, 4, 4, 5, 5 / 3, 2),
        ("run_candidate", 1, 5, 5, 5, None, None, 1),
        (None, 5, 3, 5, 5, 5, 5 / 3, 4),
    ).replace("CAST(NULL AS BIGINT)", "CAST(0 AS BIGINT)"),
)
def label_audit_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = [("submit", [1, 2, 3, 4], [-100, -100, 3, 4]), ("submit", [1, 2], [1, -100]), ("submit", [1, 2, 3], [1, -100, 3]), ("run_candidate", [1] * 5, [-100] * 5), (None, [1, 2, 3], [1, 2])]
    return review.label_audit(spark.createDataFrame(rows, "tool string, input_ids array<int>, labels array<int>"))


@query("code_recover", _values("sample_id VARCHAR, n_matches INTEGER, n_recorded INTEGER, n_tried INTEGER, same BOOLEAN", ("one", 1, 1, 1, True), ("both", 1, 2, 1, True), ("other", 0, 1, 1, False)))
def code_recover(spark: SparkSession, sf: str) -> DataFrame:
    """A mutant of one edit, one of two, and a program that no recorded edit makes."""
    edits = single_edits(_SUM)
    a, b = (next(e for e in edits if e.rule == r and len([x for x in edits if (x.rule, x.before, x.after) == (e.rule, e.before, e.after)]) == 1) for r in ("compare_boundary", "initialization_offset"))
    record = lambda e: (e.rule, e.before, e.after)
    rows = [("one", _SUM, apply_edits(_SUM, [a]), [record(a)], 1), ("both", _SUM, apply_edits(_SUM, [a, b]), [record(a), record(b)], 2), ("other", _SUM, _DIV, [record(a)], 1)]
    found = recovery.recover_edits(spark.createDataFrame(rows, "sample_id string, reference string, candidate string, records array<struct<rule:string,before:string,after:string>>, bugs int"))
    goal = F.create_map(F.lit("one"), F.array(F.lit(a.key)), F.lit("both"), F.array(*map(F.lit, sorted([a.key, b.key]))))
    return found.select("sample_id", F.size("matches").alias("n_matches"), "n_recorded", "n_tried", F.coalesce(F.get("matches", 0) == goal[F.col("sample_id")], F.lit(False)).alias("same"))


@query(
    "code_grounded",
    _values(
        "sample_id VARCHAR, source_id VARCHAR, state VARCHAR, target_tool VARCHAR, n_turns INTEGER, last VARCHAR",
        ("a:grounded:1", "a", "first_failure_direct_repair", "submit", 2, '{"name":"submit","arguments":{"code":"half"}}'),
        ("a:grounded:2", "a", "second_failure_run", "run_candidate", 4, '{"name":"run_candidate","arguments":{"input":"7"}}'),
        ("a:grounded:3", "a", "multiround_final_submit", "submit", 6, '{"name":"submit","arguments":{"code":"whole"}}'),
    ),
)
def code_grounded(spark: SparkSession, sf: str) -> DataFrame:
    rows = [("a", "first_failure_direct_repair", [("human", "p")], "half", "{}", "7", "{}", "whole")]
    steps = recovery.grounded_steps(spark.createDataFrame(rows, "sample_id string, state string, history array<struct<from:string,value:string>>, partial string, partial_feedback string, next_input string, run_feedback string, reference string"))
    return steps.select("sample_id", "source_id", "state", "target_tool", F.size("conversations").alias("n_turns"), F.element_at("conversations", -1)["value"].alias("last"))


@query(
    "code_native_turns",
    _values(
        "episode_id VARCHAR, roles VARCHAR, first_ask VARCHAR, seed VARCHAR, reason VARCHAR",
        ("repair", "system,user,assistant,tool,assistant,tool", "P", "x = 1\n", None),
        ("direct", "system,user,assistant,tool", "P", None, None),
        ("blind", None, None, None, "no_feedback"),
    ),
)
def code_native_turns(spark: SparkSession, sf: str) -> DataFrame:
    tail = [("assistant", "", "submit", {"code": "x = 2"}, True), ("tool", "{}", None, None, False)]
    state = "P\n\nCurrent candidate:\n```python\nx = 1\n```\n\n"
    texts = {"repair": ("post_submit_direct_repair", state + 'Previous submit result:\n{"status":"wrong_answer"}'), "direct": ("direct_submission", "P"), "blind": ("post_submit_direct_repair", state + "No grader feedback is available."), "active": ("pre_submit_active_validation", state)}
    rows = [(k, b, [("system", "s", None, None, False), ("user", t, None, None, False), *tail]) for k, (b, t) in texts.items()]
    out = recovery.native_turns(spark.createDataFrame(rows, f"episode_id string, behavior string, messages {_TURN}"))
    return out.select("episode_id", F.array_join(F.transform("messages", lambda x: x["role"]), ",").alias("roles"), F.get("messages", 1)["content"].alias("first_ask"), F.when(F.size("messages") > 4, F.get("messages", 2)["arguments"]["code"]).alias("seed"), "reason")


@query(
    "code_assemble",
    # r4 repeats the code of r1; the singles' order is that of sha256('42:' || program_id)
    "WITH s(p, kind) AS (VALUES ('s1', 'b'), ('s2', 'b'), ('s3', 'd'), ('s4', 'b')), d AS (SELECT p FROM s ORDER BY sha256('42:' || p) LIMIT 2), r AS (SELECT p FROM s WHERE kind = 'b' AND p NOT IN (SELECT p FROM d) ORDER BY sha256('42:' || p) LIMIT 3) "
    "SELECT p AS program_id, 'direct_submission' AS behavior, CAST(NULL AS BIGINT) AS missing FROM (VALUES ('r1'), ('r2'), ('r3')) t(p) UNION ALL SELECT p, 'direct', NULL FROM d UNION ALL SELECT p, 'replay', NULL FROM r "
    "UNION ALL SELECT 'm1', 'multiround', NULL UNION ALL SELECT NULL, 'replay', 3 - count(*) FROM r",
)
def code_assemble(spark: SparkSession, sf: str) -> DataFrame:
    rows = [("r1", "interview", "h1", 1, "reference", []), ("r2", "interview", "h2", 2, "reference", []), ("r3", "competition", "h3", 3, "reference", []), ("r4", "introductory", "h1", 4, "reference", []), ("r5", "interview", "h5", 5, "reference", [])]
    rows += [(f"s{i}", "interview", f"g{i}", i, "single", ["direct"] if i == 3 else ["direct", "replay"]) for i in (1, 2, 3, 4)] + [("m1", "interview", "k1", 1, "multi", []), ("m2", "interview", "k2", 2, "multi", [])]
    supply = spark.createDataFrame(rows, "program_id string, difficulty string, code_hash string, ord int, kind string, behaviors array<string>")
    picks, short = recovery.assemble(supply, {"direct": 2, "replay": 3}, direct=3)
    return picks.withColumn("missing", F.lit(None).cast("long")).unionByName(short.withColumn("program_id", F.lit(None).cast("string")))


@query(
    "code_single_shot",
    _values(
        "program_id VARCHAR, problem_id VARCHAR, ord INTEGER, passed BIGINT, total BIGINT, pass_rate DOUBLE, status VARCHAR",
        ("div/s0", "div", 0, 3, 3, 1.0, "accepted"),
        ("div/s1", "div", 1, 3, 3, 1.0, "accepted"),
        ("div/s2", "div", 2, None, None, 0.0, "no_code"),
    ),
)
def code_single_shot(spark: SparkSession, sf: str) -> DataFrame:
    rows = [("div", 0, f"```python\n{_DIV}```"), ("div", 1, f"So:\n```\n{_DIV}```"), ("div", 2, "I can't.")]
    return recovery.single_shot(spark.createDataFrame(rows, "problem_id string, ord int, raw string"), cases(spark))


@query(
    "code_outcome_episodes",
    "SELECT p AS problem_id, b AS behavior, 'apps-' || p || '-' || b || '-' || substr(sha256(p || ':' || b || ':' || c), 1, 12) AS episode_id, t AS tools, k AS kind, CASE WHEN g IS NOT NULL THEN 'sha256:' || sha256(g) END AS input_hash, m AS matches_failing_input FROM "
    "(VALUES ('1', 'post_submit_direct_repair', 'c1', 'submit', 'none', NULL, false), ('2', 'post_submit_failure_replay', 'c2', 'run_candidate,submit', 'submit_failing_case', '5', true)) v(p, b, c, t, k, g, m)",
)
def code_outcome_episodes(spark: SparkSession, sf: str) -> DataFrame:
    """The third mutant's repair isn't the reference, the fourth problem has no accepted attempt
    of its kind, the fifth no behaviour."""
    say = lambda *tools: [("assistant", "", t, {}, True) for t in tools]
    plain, ran = [(False, "x", say("submit")), (True, "ref", say("submit"))], [(True, "ref", say("run_candidate", "submit"))]
    rows = [
        ("1", "post_submit_direct_repair", "synthetic_single", "c1", "ref", "5", None, None, plain, ran),
        ("2", "post_submit_failure_replay", "synthetic_multi", "c2", "ref", "5", "5", None, plain, ran),
        ("3", "post_submit_direct_repair", "synthetic_single", "c3", "other", "5", None, None, plain, ran),
        ("4", "post_submit_failure_replay", "model_natural_failure", "c4", "ref", "5", "5", None, plain, []),
        ("5", None, "synthetic_single", "c5", "ref", "5", None, None, plain, ran),
    ]
    attempt = f"array<struct<accepted:boolean,final_hash:string,messages:{_TURN}>>"
    kind = f"problem_id string, behavior string, origin string, code_hash string, reference_hash string, failing_input string, given string, proposal struct<model:string,prompt_hash:string,raw_hash:string>, direct {attempt}, with_run {attempt}"
    e = recovery.outcome_episodes(spark.createDataFrame(rows, kind))
    return e.select("problem_id", "behavior", "episode_id", F.array_join("tool_sequence", ",").alias("tools"), "execution_query.kind", "execution_query.input_hash", "execution_query.matches_failing_input")
