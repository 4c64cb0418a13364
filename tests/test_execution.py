import json

import pytest

from kelpforge.operators.execution import edits, masks, mutants, sandbox
from kelpforge.plans import load

REF = "def f(xs, k):\n    best = 0\n    for i in range(len(xs)):\n        if xs[i] > k and not xs[i] == 7:\n            best = best + xs[i]\n    return ' '.join(map(str, [max(best, 0)]))\n"


def test_sandbox_statuses():
    small = sandbox.Limits(seconds=1.0, bytes=1000)
    assert sandbox.run("print(input())", "hé\n", small).stdout == "hé\n"
    assert sandbox.run("while True: pass", "", small).status == "timeout"
    assert sandbox.run("print('x' * 5000)", "", small).status == "output_limit"
    assert sandbox.run("1/0", "", small).exception == "ZeroDivisionError"
    assert sandbox.run("for", "", small).status == "compile_error"
    assert sandbox.run("print(1)", "x" * 2000, small).status == "invalid_input"
    assert sandbox.run("import socket; socket.socket()", "", small).status == "runtime_error"


def test_call_mode():
    assert sandbox.run_candidate("def f(a, b):\n    print('noise')\n    return [a, b]", "[1, 2]", "call", "f")[1] == [1, 2]
    assert sandbox.run_candidate("class Solution:\n    def f(self, a):\n        return a", "[3]", "call", "f")[1] == 3
    assert sandbox.run_candidate("x = 1", "[3]", "call", "f")[0].status == "runtime_error"
    assert sandbox.run_candidate("x = 1", "[3]", "call", "not a name")[0].status == "invalid_input"


def test_every_family_is_found():
    code = REF + "x = [0, 2]\nx[1] = 3 % 2\ny = -1 if x and x else 1\nreturn_ = sum(x)\n"
    found = {e.family for e in edits.single_edits(code)}
    assert found == set(edits.FAMILIES.values())


def test_single_edits_apply_and_differ():
    for e in edits.single_edits(REF):
        mutant = edits.apply_edits(REF, [e])
        assert mutant != REF
        assert edits.is_single_edit(REF, mutant)
    assert not edits.is_single_edit(REF, "x = 1\n")


def test_sets_are_independent_and_seeded():
    all_ = edits.single_edits(REF)
    sets = edits.compatible_sets(all_, 2, 5, 10)
    assert sets and sets == edits.compatible_sets(all_, 2, 5, 10)
    for s in sets:
        assert edits.compatible(*s) and len({e.statement for e in s}) == 2
        edits.apply_edits(REF, s)
    with pytest.raises(ValueError):
        edits.apply_edits(REF, [all_[0], all_[0]])


def test_bug_schedule_starts_with_one_of_each():
    assert mutants.bug_schedule({2: 0.6, 3: 0.3, 4: 0.1}, 8, 1)[:3] == [2, 3, 4]


def _encode(ms):
    return list("".join(f"<{m['role']}>{m['content']}" for m in ms).encode())


def test_loss_mask_and_weights():
    ms = [{"role": "user", "content": "é"}, {"role": "assistant", "content": "no", "trainable": False}, {"role": "assistant", "content": "yes", "trainable": True}]
    row = masks.loss_mask(ms, _encode)
    assert masks.supervised_text(row, lambda x: bytes(x).decode()) == "<assistant>yes"
    assert row["spans"][-1]["end"] == len(row["input_ids"]) == len(row["labels"])
    with pytest.raises(ValueError):
        masks.loss_mask(ms, lambda m: [len(m)])
    offsets, labels = [(i, i + 1) for i in range(10)], [1] * 10
    for strategy, want in (("full", 10), ("wrapper", 7), ("delta", 8)):
        assert sum(masks.token_weights(offsets, labels, (3, 6), "abc", "aXc", strategy, context=0)) == want


@pytest.mark.parametrize("name, column, want", [("code_agent_eval", "success_rate", 0.5), ("code_natural", "label", None), ("code_causal_support", "category", "single_improves")])
def test_worked_examples(spark, name, column, want):
    rows = load().QUERIES[name](spark, "").collect()
    if name == "code_natural":
        assert {r["program_id"]: (r["label"], r["reason"]) for r in rows} == {"div/n0": ("correct", None), "div/n1": ("discarded", "duplicate"), "div/n2": ("failure", None), "div/n3": ("discarded", "no_code"), "div/n4": ("discarded", "no_pass")}
    else:
        assert all(r[column] == want for r in rows)


def test_grades_of_worked_programs(spark):
    got = {r["program_id"]: (r["status"], r["passed"], r["total"]) for r in load().QUERIES["code_grade"](spark, "").collect()}
    assert got == {"right": ("accepted", 3, 3), "third": ("wrong_answer", 1, 3), "short": ("wrong_answer", 0, 3), "broken": ("runtime_error", 0, 3), "raises": ("runtime_error", 0, 3), "loops": ("timeout", 0, 3), "method": ("accepted", 5, 5)}


def test_replay_and_episode_issues(spark):
    got = {(r["episode_id"], r["code"]) for r in load().QUERIES["code_replay"](spark, "").collect()}
    assert got == {("lies", "replay_feedback_mismatch"), ("lies", "replay_not_accepted"), ("open", "replay_not_accepted"), ("lost", "replay_missing_problem")}
    codes = [r["code"] for r in load().QUERIES["code_episode_issues"](spark, "").collect()]
    assert sorted(codes) == ["call_without_observation"] * 2 + ["not_accepted"] * 2


def test_behaviors_by_priority_and_cap(spark):
    from kelpforge.operators.execution.episodes import assign_behaviors

    rows = [(f"p{i}", b) for i in range(10) for b in ("multiround", "post_submit_direct_repair", "pre_submit_active_validation")]
    got = assign_behaviors(spark.createDataFrame(rows, "problem_id string, behavior string"), (("multiround", 4), ("pre_submit_active_validation", 0), ("post_submit_direct_repair", None)))
    assert sorted(r["behavior"] for r in got.collect()) == ["multiround"] * 4 + ["post_submit_direct_repair"] * 6


def test_scripted_agent_speaks_json():
    from kelpforge.plans.q_code import scripted

    assert json.loads(scripted([], 0))["name"] == "submit"
