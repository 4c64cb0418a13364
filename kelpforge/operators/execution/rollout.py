"""State machines per row: probes, rollouts with budgets, paired evaluation, agent evaluation, replay."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpforge.functions.actions import read_call
from kelpforge.functions.pynorm import canonical_json, input_forms, inputs_equal, output_matches
from kelpforge.operators.execution.sandbox import Limits, run_candidate
from kelpforge.operators.report import classify_post_submit

#: A text generator: (messages, seed) -> text.
Generate = Callable[[list[dict], int], str]
#: Fixed value: what the seeds of two steps of a rollout differ by.
SEED_STRIDE = 1_000_003
#: Small arguments and inputs that are tried in this order as probes.
PROBES = {
    "call": tuple(canonical_json(x) for x in ([], [0], [1], [2], [0, 0], [1, 2], [2, 1], [1, 2, 3], [3, 2, 1], [5], [[1, 2, 3], 1], [[2, 1], 1], [1, [2]])),
    "stdin": (*(f"{n}\n" for n in range(9)), *(f"{a} {b}\n" for a in range(4) for b in range(4)), *(f"{n}\n" + " ".join(map(str, range(n))) + "\n" for n in range(1, 5))),
}


def grade_program(code: str, cases: list[dict], mode: str, fn_name: str | None, limits: Limits = Limits()) -> dict:
    """The public feedback of one submission: status, counts, rate, first failing input."""
    passed, first = 0, None
    for c in cases:
        got, value = run_candidate(code, c["given"], mode, fn_name, limits)
        ok = got.status == "ok" and output_matches(value, json.loads(c["expected"]), mode)
        passed += ok
        if not ok and first is None:
            first = ("timeout" if got.status == "timeout" else "wrong_answer" if got.status == "ok" else "runtime_error", c["given"])
    n = len(cases)
    return {"status": first[0] if first else "accepted", "passed": passed, "total": n, "pass_rate": passed / n if n else 0.0, "failing_input": first[1] if first else None}


def probe_inputs(programs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(program_id, probe): the first small input, none of the hidden ones, on which a program
    and its reference differ visibly. Columns: program_id, code, reference, hidden, mode, fn_name."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                hidden, found = set().union(*(input_forms(h, r.mode) for h in r.hidden)), None
                for given in PROBES[r.mode]:
                    if given in hidden:
                        continue
                    mine, v = run_candidate(r.code, given, r.mode, r.fn_name, limits)
                    if mine.status in ("invalid_input", "timeout", "output_limit"):
                        continue
                    right, w = run_candidate(r.reference, given, r.mode, r.fn_name, limits)
                    if right.status == "ok" and (mine.status, mine.stdout, repr(v)) != (right.status, right.stdout, repr(w)):
                        found = given
                        break
                rows.append((r.program_id, found))
            yield pd.DataFrame(rows, columns=["program_id", "probe"])

    return programs.select("program_id", "code", "reference", "hidden", "mode", "fn_name").mapInPandas(work, "program_id string, probe string")


def _observe(code: str, given: str, mode: str, fn_name: str | None, limits: Limits) -> dict:
    """What a run of the current candidate shows."""
    got, value = run_candidate(code, given, mode, fn_name, limits)
    shown = got.stdout if mode != "call" or value is None else json.dumps(value)
    return {"status": got.status, "stdout": shown, "error": got.exception}


def accepted(feedback: dict | None) -> bool:
    """Every case passed, and there was one."""
    return bool(feedback) and feedback["status"] == "accepted" and feedback["passed"] == feedback["total"] > 0


def rollout(problem: dict, start: list[dict], generate: Generate, seed: int, budget: tuple[int, int, int] = (6, 3, 3), limits: Limits = Limits(), allow_run: bool = True, feedback: dict | None = None, branch: bool = False) -> dict:
    """One conversation until acceptance or the end of a budget (actions, submits, runs).

    A run executes the current candidate: the latest submit, or the one that the problem starts
    with; before there is one, a run is an unavailable tool. A call beyond a budget ends the
    conversation and isn't counted. A text that was submitted before isn't graded again.

    As a ``branch`` of a paired comparison, a run must be allowed and use the input that failed
    last (``feedback`` is what the start shows), and an accepted submit is graded twice.
    """
    messages, spent = list(start), {"submit": 0, "run_candidate": 0}
    most = {"submit": budget[1], "run_candidate": budget[2]}
    full = {"submit": "submit_budget", "run_candidate": "run_budget"}
    candidate, last, turns = problem.get("candidate"), feedback, []
    graded: dict[str, dict] = {}
    ask = lambda code: grade_program(code, problem["cases"], problem["mode"], problem["fn_name"], limits)

    def end(status: str) -> dict:
        return {"status": status, "submits": spent["submit"], "runs": spent["run_candidate"], "turns": turns, "feedback": last}

    for n in range(budget[0]):
        raw = generate(messages, seed + n * SEED_STRIDE)
        turn: dict = {"raw": raw}
        turns.append(turn)
        call, form, reason = read_call(raw, lenient=not branch)
        if call is None:
            turn["parse_error"] = reason
            return end("invalid_action")
        tool = call["name"]
        if tool == "run_candidate" and candidate is None:
            turn["parse_error"] = "unavailable_tool"
            return end("invalid_action")
        turn |= {"format": form, "tool": tool}
        if tool == "run_candidate" and not allow_run:
            return end("run_not_allowed")
        if spent[tool] >= most[tool]:
            return end(full[tool])
        given = call["arguments"]["code" if tool == "submit" else "input"]
        if tool == "run_candidate":
            turn["on_failing_input"] = bool(last) and inputs_equal(given, last["failing_input"], problem["mode"])
            if branch and last and not turn["on_failing_input"]:
                return end("run_input_not_latest_failing_case")
            turn["observation"] = _observe(candidate, given, problem["mode"], problem["fn_name"], limits)
        else:
            candidate = given
            turn["duplicate"] = given in graded
            if given not in graded:
                graded[given] = ask(given)
            last = turn["observation"] = graded[given]
        spent[tool] += 1
        if tool == "submit" and accepted(last):
            return end("accepted" if not branch or accepted(ask(given)) else "accepted_replay_failed")
        messages = [*messages, {"role": "assistant", "content": raw}, {"role": "tool", "content": json.dumps(turn["observation"])}]
    return end("action_budget")


_RESULT = "id string, difficulty string, solved boolean, status string, actions int, submissions int, runs int, first_submit_success boolean, repair_eligible boolean, valid_actions int, executable_actions int, duplicate_submissions int, wall_seconds double, turn_history string"


def evaluate_agents(problems: DataFrame, generate: Generate, seed: int = 0, budget: tuple[int, int, int] = (6, 3, 3), limits: Limits = Limits()) -> DataFrame:
    """One evaluation row per problem (id, difficulty, question, cases, mode, fn_name)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                began = time.monotonic()
                r["cases"] = [dict(c) for c in r["cases"]]
                got = rollout(r, [{"role": "user", "content": r["question"]}], generate, seed, budget, limits)
                t = got["turns"]
                first = next((x["observation"]["status"] == "accepted" for x in t if x.get("tool") == "submit"), None)
                rows.append((r["id"], r["difficulty"], got["status"] == "accepted", got["status"], len(t), got["submits"], got["runs"], first, first is False, sum(x.get("format") == "strict" for x in t), sum("format" in x for x in t), sum(bool(x.get("duplicate")) for x in t), time.monotonic() - began, json.dumps(t)))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _RESULT.split(", ")])

    return problems.mapInPandas(work, _RESULT)


def summarize_agents(results: DataFrame) -> DataFrame:
    """Rates overall and by difficulty; a rate without a base is null."""
    share = lambda a, b: F.try_divide(F.sum(a).cast("double"), F.sum(b).cast("double"))
    yes = lambda c: F.when(c, 1).otherwise(0)
    g = results.rollup("difficulty").agg(
        F.count(F.lit(1)).alias("n"),
        share(yes(F.col("solved")), F.lit(1)).alias("success_rate"),
        share(yes(F.col("first_submit_success")), yes(F.col("first_submit_success").isNotNull())).alias("first_submit_rate"),
        share(yes(F.col("solved") & F.col("repair_eligible")), yes(F.col("repair_eligible"))).alias("repair_rate"),
        share(F.col("valid_actions"), F.col("actions")).alias("format_rate"),
        F.avg("actions").alias("mean_actions"),
    )
    return g.withColumn("difficulty", F.coalesce("difficulty", F.lit("all")))


def paired_rollouts(problems: DataFrame, generate: Generate, seeds: Sequence[int], budget: tuple[int, int, int] = (6, 3, 3), limits: Limits = Limits()) -> DataFrame:
    """(id, seed, branch, solved, status): what follows a failed submit, without and with a run.

    ``problems``: id, question, cases, mode, fn_name and the candidate that fails. Both branches
    of a seed start behind the graded candidate; the one with a run also shows the candidate's run
    on the input that failed, which costs an action and a run. Where there is no such input, or
    its output is too long, the branch counts as unsolved (``no_run``). Every (id, seed, branch)
    is a row of its own, so the rollouts of one problem run on many executors.
    """
    columns = ["id", "question", "cases", "mode", "fn_name", "candidate"]
    tries = problems.select(*columns, F.explode(F.array(*map(F.lit, seeds))).alias("seed")).withColumn("branch", F.explode(F.array(F.lit("without"), F.lit("with"))))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                r["cases"] = [dict(c) for c in r["cases"]]
                seen = grade_program(r["candidate"], r["cases"], r["mode"], r["fn_name"], limits)
                start = [{"role": "user", "content": r["question"]}, _said("submit", code=r["candidate"]), {"role": "tool", "content": json.dumps(seen)}]
                left = budget
                if r["branch"] == "with":
                    shown = seen["failing_input"] is not None and _observe(r["candidate"], seen["failing_input"], r["mode"], r["fn_name"], limits)
                    if not shown or shown["status"] == "output_limit":
                        rows.append((r["id"], r["seed"], r["branch"], False, "no_run"))
                        continue
                    start += [_said("run_candidate", input=seen["failing_input"]), {"role": "tool", "content": json.dumps(shown)}]
                    left = (max(0, budget[0] - 1), budget[1], max(0, budget[2] - 1))
                got = rollout(r, start, generate, r["seed"], left, limits, allow_run=r["branch"] == "with", feedback=seen, branch=True)
                rows.append((r["id"], r["seed"], r["branch"], got["status"] == "accepted", got["status"]))
            yield pd.DataFrame(rows, columns=["id", "seed", "branch", "solved", "status"])

    return tries.repartition("id", "seed", "branch").mapInPandas(work, "id string, seed int, branch string, solved boolean, status string")


def _said(tool: str, **arguments: str) -> dict:
    return {"role": "assistant", "content": json.dumps({"name": tool, "arguments": arguments})}


def paired_behavior(branches: DataFrame, k: int = 3) -> DataFrame:
    """Success rates with and without a run over equal seeds, and the behaviour they support.

    ``branches``: (id, seed, branch, solved). An id needs ``k`` distinct seeds in both branches.
    """
    g = branches.groupBy("id").agg(
        F.avg(F.when(F.col("branch") == "without", F.col("solved").cast("double"))).alias("without_run"),
        F.avg(F.when(F.col("branch") == "with", F.col("solved").cast("double"))).alias("with_run"),
        F.countDistinct(F.when(F.col("branch") == "without", F.col("seed"))).alias("n0"),
        F.countDistinct(F.when(F.col("branch") == "with", F.col("seed"))).alias("n1"),
        F.count(F.lit(1)).alias("n"),
    )
    ok = (F.col("n0") == k) & (F.col("n1") == k) & (F.col("n") == 2 * k)
    behavior = F.when(ok, classify_post_submit(F.col("without_run"), F.col("with_run"))).otherwise("invalid")
    return g.select("id", "without_run", "with_run", (F.col("with_run") - F.col("without_run")).alias("utility"), behavior.alias("behavior"))


def replay_issues(episodes: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(episode_id, code, turn): where a recorded episode differs from running it again.

    ``episodes``: (episode_id, messages as JSON, cases, mode, fn_name; null cases: the problem
    is missing). Submits are graded twice; runs are observed again.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                if r.cases is None:
                    rows.append((r.episode_id, "replay_missing_problem", -1))
                    continue
                cases, last, current = [dict(c) for c in r.cases], None, None
                for n, m in enumerate(json.loads(r.messages)):
                    if m["role"] != "assistant" or not m.get("call"):
                        continue
                    args, seen = m["call"]["arguments"], m.get("observation")
                    if m["call"]["name"] == "submit":
                        current = args["code"]
                        one, two = (grade_program(args["code"], cases, r.mode, r.fn_name, limits) for _ in range(2))
                        if one != two:
                            rows.append((r.episode_id, "replay_unstable", n))
                        if one != seen:
                            rows.append((r.episode_id, "replay_feedback_mismatch", n))
                        last = one
                    elif current is None or _observe(current, args["input"], r.mode, r.fn_name, limits) != seen:
                        rows.append((r.episode_id, "replay_observation_mismatch", n))
                if last is None or last["status"] != "accepted":
                    rows.append((r.episode_id, "replay_not_accepted", -1))
            yield pd.DataFrame(rows, columns=["episode_id", "code", "turn"])

    return episodes.select("episode_id", "messages", "cases", "mode", "fn_name").mapInPandas(work, "episode_id string, code string, turn int")
