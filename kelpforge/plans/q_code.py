"""Program-level queries over small inline problems (the tables hold no programs)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpforge.functions.pynorm import canonical_json
from kelpforge.operators.execution import audit, episodes, grade, masks, mutants, rollout
from kelpforge.operators.execution.edits import single_edits
from kelpforge.plans.catalog import query
from kelpforge.sources.jsonl import _judge, parse_problems

_DIV = "t = int(input())\nfor _ in range(t):\n    n = int(input())\n    if n % 4 == 0:\n        print('YES')\n    else:\n        print('NO')\n"
_SUM = "def total(xs, k):\n    best = 0\n    for i in range(len(xs)):\n        if xs[i] > k and xs[i] != 7:\n            best = best + xs[i]\n    return max(best, 0)\n"
#: (problem_id, reference, mode, fn_name, [(input, expected)])
PROBLEMS = (
    ("div", _DIV, "stdin", None, [("4\n3\n4\n12\n1000000000\n", "NO\nYES\nYES\nYES\n"), ("1\n7\n", "NO\n"), ("2\n8\n6\n", "YES\nNO\n")]),
    ("sum", _SUM, "call", "total", [([[1, 2, 3], 1], 5), ([[], 4], 0), ([[7, 8], 2], 8), ([[5, 5, 5], 5], 0), ([[-3, 4], -5], 1)]),
)


def _values(columns: str, *rows: tuple) -> str:
    """SQL of a table whose rows were checked by hand; ``columns`` as name and type."""
    names, kinds = zip(*(c.split() for c in columns.split(", ")))
    say = lambda v: "NULL" if v is None else f"'{v.replace(chr(39), chr(39) * 2)}'" if isinstance(v, str) else repr(v)
    lines = ", ".join("(" + ", ".join(f"CAST({say(v)} AS {k})" for v, k in zip(r, kinds)) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {lines}) t(" + ", ".join(f'"{n}"' for n in names) + ")"


def references(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p[0], p[1]) for p in PROBLEMS], "problem_id string, code string")


def cases(spark: SparkSession) -> DataFrame:
    rows = [(p[0], n, canonical_json(i) if p[2] == "call" else i, canonical_json(o), p[2], p[3]) for p in PROBLEMS for n, (i, o) in enumerate(p[4])]
    return spark.createDataFrame(rows, "problem_id string, case_no int, given string, expected string, mode string, fn_name string")


def _programs(spark: SparkSession) -> DataFrame:
    rows = [
        ("right", "div", _DIV),
        ("third", "div", _DIV.replace("n % 4", "n % 3")),
        ("short", "div", _DIV.replace("range(t)", "range(t - 1)").replace("n % 4", "n % 3")),
        ("broken", "div", "for"),
        ("raises", "div", "raise ValueError('x')"),
        ("loops", "div", "while True: pass"),
        ("method", "sum", "class Solution:\n    def total(self, xs, k):\n        return sum(x for x in xs if x > k and x != 7)\n"),
    ]
    return spark.createDataFrame(rows, "program_id string, problem_id string, code string")


@query("code_grade")
def code_grade(spark: SparkSession, sf: str) -> DataFrame:
    return grade.grades(grade.run_cases(_programs(spark), cases(spark))).drop("attempt")


@query("code_edits")
def code_edits(spark: SparkSession, sf: str) -> DataFrame:
    rows = [(p[0], n, e.rule, e.family, e.before, e.after) for p in PROBLEMS for n, e in enumerate(single_edits(p[1]))]
    return spark.createDataFrame(rows, "problem_id string, ord int, rule string, family string, before string, after string")


@query("code_single_mutants")
def code_single_mutants(spark: SparkSession, sf: str) -> DataFrame:
    return mutants.graded_singles(references(spark), cases(spark)).select("program_id", "problem_id", "family", "status", "passed", "total", "code_hash")


@query("code_multi_mutants")
def code_multi_mutants(spark: SparkSession, sf: str) -> DataFrame:
    return mutants.graded_multis(references(spark), cases(spark)).select("program_id", "problem_id", "bug_count", "status", "passed", "total", "mutation_set")


@query(
    "code_references",
    # div/0 is no program; sum/2 takes k itself, and sum/0 has more nodes than sum/1
    _values(
        "problem_id VARCHAR, index INTEGER, code VARCHAR",
        ("div", 1, _DIV),
        ("sum", 1, _SUM),
    ),
)
def code_references(spark: SparkSession, sf: str) -> DataFrame:
    longer = _SUM.replace("max(best, 0)", "max(best, 0) + 0")
    rows = [("sum", 0, longer), ("sum", 1, _SUM), ("sum", 2, _SUM.replace("> k", ">= k")), ("div", 0, "for"), ("div", 1, _DIV)]
    return grade.select_references(spark.createDataFrame(rows, "problem_id string, index int, code string"), cases(spark))


@query(
    "code_natural",
    # n1 differs by a comment; n2 passes one of three cases, n4 none
    _values(
        "program_id VARCHAR, label VARCHAR, reason VARCHAR",
        ("div/n0", "correct", None),
        ("div/n1", "discarded", "duplicate"),
        ("div/n2", "failure", None),
        ("div/n3", "discarded", "no_code"),
        ("div/n4", "discarded", "no_pass"),
    ),
)
def code_natural(spark: SparkSession, sf: str) -> DataFrame:
    fence = "```python\n{}\n```"
    rows = [("div", 0, "Here:\n" + fence.format(_DIV)), ("div", 1, fence.format("# same\n" + _DIV)), ("div", 2, fence.format(_DIV.replace("n % 4", "n % 3"))), ("div", 3, "no program, sorry"), ("div", 4, fence.format("print(1)"))]
    return mutants.natural_candidates(spark.createDataFrame(rows, "problem_id string, ord int, raw string"), cases(spark)).select("program_id", "label", "reason")


@query(
    "code_probe",
    # a differs where an element equals k, first on a hidden input; c differs from 5 on, which is hidden
    _values(
        "program_id VARCHAR, probe VARCHAR",
        ("a", "[[2,1],1]"),
        ("b", None),
        ("c", "6\n"),
    ),
)
def code_probe(spark: SparkSession, sf: str) -> DataFrame:
    rows = [("a", _SUM.replace("> k", ">= k"), _SUM, ["[[1,2,3],1]"], "call", "total"), ("b", _SUM, _SUM, ["[]"], "call", "total"), ("c", "n = int(input())\nprint(n * 2 if n < 5 else 0)", "n = int(input())\nprint(n * 2)", ["5\n"], "stdin", None)]
    return rollout.probe_inputs(spark.createDataFrame(rows, "program_id string, code string, reference string, hidden array<string>, mode string, fn_name string"))


@query("code_episodes")
def code_episodes(spark: SparkSession, sf: str) -> DataFrame:
    return episodes.public_messages(_episodes(spark)).select("id", F.size("messages").alias("n_messages"), F.sha2(F.to_json("messages"), 256).alias("messages_sha256"))


def _episodes(spark: SparkSession) -> DataFrame:
    supply = spark.createDataFrame([("div", "post_submit_direct_repair"), ("div", "post_submit_failure_replay"), ("sum", "direct_submission"), ("sum", "pre_submit_active_validation")], "problem_id string, behavior string")
    chosen = episodes.assign_behaviors(supply)
    bad = _DIV.replace("n % 4", "n % 3")
    rows = [
        ("div", "div?", _DIV, 3, bad, "wrong_answer", 1, PROBLEMS[0][4][0][0], None, '{"status":"ok"}', None, None, None, None),
        ("sum", "sum?", _SUM, 5, None, None, None, None, None, None, None, None, None, None),
    ]
    kinds = "problem_id string, question string, reference string, total int, buggy string, status string, passed int, failing_input string, probe string, observation string, partial string, partial_status string, partial_passed int, partial_input string"
    return episodes.build_messages(chosen.join(spark.createDataFrame(rows, kinds), "problem_id"))


@query("code_episode_issues")
def code_episode_issues(spark: SparkSession, sf: str) -> DataFrame:
    e = _episodes(spark)
    cut = e.withColumn("messages", F.slice("messages", 1, F.size("messages") - 1)).withColumn("episode_id", F.concat(F.lit("cut-"), "episode_id"))
    return episodes.episode_issues(e.unionByName(cut))


def _call(name: str, **arguments: str) -> str:
    return json.dumps({"name": name, "arguments": arguments})


def scripted(messages: list[dict], seed: int) -> str:
    """A stand-in for a model: a wrong submit, a run of the failing input, then the right submit."""
    seen = [json.loads(m["content"]) for m in messages if m["role"] == "tool"]
    bad = _DIV.replace("n % 4", "n % 3")
    if not seen:
        return _call("submit", code=bad)
    if len(seen) == 1:
        return "<response>" + _call("run_candidate", input=seen[0]["failing_input"] or "") + "</response>"
    return "<tool_call>" + _call("submit", code=_DIV) + "</tool_call>"


@query(
    "code_agent_eval",
    # div: submit, wrapped run, right submit; sum: the same and two submits more, the fourth beyond the budget
    _values(
        "difficulty VARCHAR, n BIGINT, success_rate DOUBLE, first_submit_rate DOUBLE, repair_rate DOUBLE, format_rate DOUBLE, mean_actions DOUBLE",
        ("introductory", 2, 0.5, 0.0, 0.5, 0.75, 4.0),
        ("all", 2, 0.5, 0.0, 0.5, 0.75, 4.0),
    ),
)
def code_agent_eval(spark: SparkSession, sf: str) -> DataFrame:
    c = cases(spark).groupBy("problem_id", "mode", "fn_name").agg(F.sort_array(F.collect_list(F.struct("case_no", "given", "expected"))).alias("cases"))
    p = c.select(F.col("problem_id").alias("id"), F.lit("introductory").alias("difficulty"), F.lit("?").alias("question"), "cases", "mode", "fn_name")
    return rollout.summarize_agents(rollout.evaluate_agents(p, scripted)).select("difficulty", "n", "success_rate", "first_submit_rate", "repair_rate", "format_rate", "mean_actions")


@query(
    "code_replay",
    # lies claims acceptance of a wrong program, open ends with a failure, lost has no problem
    _values(
        "episode_id VARCHAR, code VARCHAR, turn INTEGER",
        ("lies", "replay_feedback_mismatch", 0),
        ("lies", "replay_not_accepted", -1),
        ("open", "replay_not_accepted", -1),
        ("lost", "replay_missing_problem", -1),
    ),
)
def code_replay(spark: SparkSession, sf: str) -> DataFrame:
    wrong = {"status": "wrong_answer", "passed": 1, "total": 3, "pass_rate": 1 / 3, "failing_input": PROBLEMS[0][4][0][0]}
    right = {"status": "accepted", "passed": 3, "total": 3, "pass_rate": 1.0, "failing_input": None}
    say = lambda code, seen: {"role": "assistant", "call": {"name": "submit", "arguments": {"code": code}}, "observation": seen}
    bad = _DIV.replace("n % 4", "n % 3")
    eps = [("good", [say(bad, wrong), say(_DIV, right)]), ("lies", [say(bad, right)]), ("open", [say(bad, wrong)])]
    e = spark.createDataFrame([(i, json.dumps(m), "div") for i, m in eps] + [("lost", "[]", "gone")], "episode_id string, messages string, problem_id string")
    c = cases(spark).groupBy("problem_id", "mode", "fn_name").agg(F.sort_array(F.collect_list(F.struct("case_no", "given", "expected"))).alias("cases"))
    return rollout.replay_issues(e.join(c, "problem_id", "left"))


@query("code_repair_pairs")
def code_repair_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = [("1", "div", _DIV.replace("n % 4", "n % 3"), _DIV), ("2", "div", _DIV, _DIV.replace("n % 4", "n % 3")), ("3", "sum", _SUM, _SUM)]
    return audit.repair_pairs(spark.createDataFrame(rows, "pair_id string, problem_id string, old string, new string"), cases(spark))


@query("code_causal_support")
def code_causal_support(spark: SparkSession, sf: str) -> DataFrame:
    edits = single_edits(_SUM)
    keys = [next(e.key for e in edits if e.rule == "compare_boundary" and e.before == "Gt"), next(e.key for e in edits if e.rule == "initialization_offset")]
    m = spark.createDataFrame([("sum/m", "sum", _SUM, keys)], "mutant_id string, problem_id string, reference string, keys array<string>")
    return audit.causal_support(m, cases(spark))


def _bytes(messages: list[dict]) -> list[int]:
    return list("".join(f"<{m['role']}>{m['content']}</>" for m in messages).encode())


@query(
    "code_token_masks",
    # bytes: 6 + 3 + 3, 11 + 3 + 3 and 11 + 4 + 3, the last supervised
    _values(
        "id VARCHAR, n_tokens INTEGER, n_supervised INTEGER, n_spans INTEGER",
        ("e1", 47, 18, 3),
    ),
)
def code_token_masks(spark: SparkSession, sf: str) -> DataFrame:
    kind = "id string, messages array<struct<role:string,content:string,trainable:boolean>>"
    e = spark.createDataFrame([("e1", [("user", "hé", False), ("assistant", "bad", False), ("assistant", "good", True)])], kind)
    rows = masks.tokenize_episodes(e, lambda: _bytes)
    return rows.select("id", F.size("input_ids").alias("n_tokens"), F.size(F.filter("labels", lambda x: x != -100)).alias("n_supervised"), F.size("spans").alias("n_spans"))


@query(
    "problem_rejects",
    # one fault a line, in the order of the lines below
    _values(
        "line_no INTEGER, id VARCHAR, reason VARCHAR",
        (1, "1", None),
        (2, "true", "missing_id"),
        (3, "1", "empty_question"),
        (4, "1", "invalid_difficulty"),
        (5, "1", "invalid_starter_code"),
        (6, "1", "invalid_url"),
        (7, "1", "invalid_solutions_json"),
        (8, "1", "invalid_input_output_json"),
        (9, "1", "invalid_solutions"),
        (10, "1", "invalid_input_output"),
        (11, "1", "invalid_tests"),
        (12, "1", "invalid_fn_name"),
        (13, None, "invalid_json"),
        (14, None, "record_not_object"),
        (15, "p7", None),
    ),
)
def problem_rejects(spark: SparkSession, sf: str) -> DataFrame:
    ok = {"id": 1, "question": "q", "solutions": '["print(1)"]', "input_output": '{"inputs":["1\\n"],"outputs":["1\\n"]}', "difficulty": "interview"}
    bad = [{**ok, "id": True}, {**ok, "question": " "}, {**ok, "difficulty": "hard"}, {**ok, "starter_code": 3}, {**ok, "url": []}, {**ok, "solutions": ["x"]}, {**ok, "input_output": "{"}, {**ok, "solutions": "[1]"}, {**ok, "input_output": "[]"}, {**ok, "input_output": '{"inputs":[1],"outputs":[]}'}, {**ok, "input_output": '{"inputs":[1],"outputs":[1],"fn_name":"a b"}'}]
    lines = [json.dumps(ok), *map(json.dumps, bad), "{bad", "[1]", json.dumps({**{k: v for k, v in ok.items() if k != "id"}, "problem_id": "p7"})]
    df = spark.createDataFrame([(n + 1, x) for n, x in enumerate(lines)], "line_no int, line string")
    return parse_problems(_judge(df)).select("line_no", "id", "reason")


def after_a_run(messages: list[dict], seed: int) -> str:
    """A stand-in for a model that repairs the program only once it has seen a run."""
    ran = any(m["role"] == "tool" and "stdout" in json.loads(m["content"]) for m in messages)
    return _call("submit", code=_DIV if ran else _DIV.replace("n % 4", "n % 3"))


@query(
    "code_paired",
    "SELECT 'div' AS id, 0e0 AS without_run, 1e0 AS with_run, 1e0 AS utility, 'post_submit_failure_replay' AS behavior",
)
def code_paired(spark: SparkSession, sf: str) -> DataFrame:
    """Three seeds of both branches: without a run the third repeat of the wrong program uses up
    the submits, with one the first submit is right."""
    c = cases(spark).where("problem_id = 'div'").groupBy("problem_id", "mode", "fn_name").agg(F.sort_array(F.collect_list(F.struct("case_no", "given", "expected"))).alias("cases"))
    p = c.select(F.col("problem_id").alias("id"), F.lit("?").alias("question"), "cases", "mode", "fn_name", F.lit(_DIV.replace("n % 4", "n % 3")).alias("candidate"))
    return rollout.paired_behavior(rollout.paired_rollouts(p, after_a_run, (11, 12, 13)))
