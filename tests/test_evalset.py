import json
import random

import pytest
from pyspark.sql import functions as F

from kelpforge.operators import evalset, review
from kelpforge.operators.execution import recovery, sandbox
from kelpforge.sources import runlog


def test_smoke_sample_is_a_scan_with_caps(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice("ab"), rnd.choice("xxxxyz")) for i in range(120)]
    want = {"a": 7, "b": 4}
    chosen = []
    for kind, n in want.items():
        mine, per = [], dict.fromkeys("xyz", 0)
        for i, k, m in rows:
            if k == kind and len(mine) < n and per[m] < max(1, n // 2):
                mine.append(i)
                per[m] += 1
        for i, k, _ in rows:
            if k == kind and len(mine) < n and i not in mine:
                mine.append(i)
        chosen += mine
    df = spark.createDataFrame(rows, "id int, kind string, mode string")
    assert sorted(r.id for r in evalset.smoke_sample(df, want, "kind", "mode", "id").collect()) == sorted(chosen)


def test_smoke_sample_of_one_mode_and_of_nothing(spark):
    df = spark.createDataFrame([(i, "a", "x") for i in range(9)], "id int, kind string, mode string")
    assert sorted(r.id for r in evalset.smoke_sample(df, {"a": 5}, "kind", "mode", "id").collect()) == [0, 1, 2, 3, 4]
    assert evalset.smoke_sample(df.limit(0), {"a": 5}, "kind", "mode", "id").count() == 0


def test_text_order(spark):
    df = spark.createDataFrame([("b", 1), ("a", 9), ("a", 10)], "s string, id int")
    assert [r.id for r in df.orderBy(*evalset.by_text("s", "id")).collect()] == [10, 9, 1]


def test_strata_diff_counts_both_sides(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), (None, 7)], "s string, k int")
    b = spark.createDataFrame([("x", 2), ("x", 3), ("x", 4), ("y", 1)], "s string, k int")
    assert {(r.s, r.n_left_only, r.n_right_only) for r in evalset.strata_diff(a, b, "s", "k").collect()} == {("x", 1, 2), (None, 1, 0)}


def test_first_valid_review_counts(spark):
    good = dict(episode_id="e", reviewer="r", observable_evidence_supported=True, trajectory_natural=True, severe_issue=False)
    lines = [json.dumps(good | {"severe_issue": "no"}), json.dumps(good | {"more": 1}), json.dumps(good), json.dumps(good | {"reviewer": ""}), "{"]
    got = review.judged_reviews(spark.createDataFrame(list(enumerate(lines)), "position int, record string"), spark.createDataFrame([("e", "b")], "episode_id string, behavior string"))
    assert [r.reason for r in got.orderBy("position").collect()] == ["invalid_schema", "invalid_schema", None, "duplicate", "not_an_object"]


def test_provenance_is_ordered(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b", "a"],), (["a"],), (None,)], "k array<string>")
    assert [r[0] for r in df.select(review.provenance_ok(F.col("k"), ["a", "b"])).collect()] == [True, False, False, False]


def test_recovery_finds_all_places_of_one_record(spark):
    code = "def f(a, b):\n    x = a < b\n    y = b < a\n    return x, y\n"
    edits = [e for e in recovery.single_edits(code) if e.rule == "compare_boundary"]
    assert len(edits) == 2
    records = [(edits[0].rule, edits[0].before, edits[0].after)]
    both = recovery.apply_edits(code, edits)
    assert recovery._recover(code, both, records, 2)[0] == []
    found, _, like, tried = recovery._recover(code, both, records * 2, 2)
    assert found == [sorted(e.key for e in edits)] and like == 2 and tried == 1
    assert recovery._recover(code, recovery.apply_edits(code, edits[1:]), records, 1)[0] == [[edits[1].key]]


def test_stage_log_sums_over_resumes(spark, tmp_path):
    log = runlog.StageLog(spark, str(tmp_path / "log"))
    log.add("grade", calls=3, seconds=1.5)
    log.add("grade", calls=4)
    log.add("export", calls=1)
    assert {(r.stage, r.metric): r.value for r in log.totals().collect()} == {("grade", "calls"): 7, ("export", "calls"): 1, ("grade", "seconds"): 1.5, (None, "calls"): 8, (None, "seconds"): 1.5}


def test_markdown_says_what_it_leaves_out(spark):
    df = spark.createDataFrame([(1, "a|b"), (2, None), (3, "c")], "n int, t string").orderBy("n")
    assert runlog.markdown("R", {"t": df}, rows=2) == "# R\n\n## t\n\n| n | t |\n| - | - |\n| 1 | a\\|b |\n| 2 |  |\n\n1 more rows\n"


def test_json_is_sorted_and_replaced(tmp_path):
    for value in ({"b": 1, "a": "é"}, {"c": 1}):
        runlog.write_json(tmp_path / "x.json", value)
        assert json.loads((tmp_path / "x.json").read_text()) == value
    assert [p.name for p in tmp_path.iterdir()] == ["x.json"]


def test_model_identity(tmp_path):
    with pytest.raises(ValueError, match="revision"):
        runlog.model_identity("name", "main")
    assert runlog.model_identity("name", "a" * 40)["revision"] == "a" * 40
    (tmp_path / "config.json").write_text("{}")
    with pytest.raises(ValueError, match="weights"):
        runlog.model_identity(str(tmp_path))
    (tmp_path / "model.safetensors").write_bytes(b"w")
    (tmp_path / "notes.md").write_text("x")
    one = runlog.model_identity(str(tmp_path))["files"]
    assert set(one) == {"config.json", "model.safetensors"}
    (tmp_path / "model.safetensors").write_bytes(b"v")
    assert runlog.model_identity(str(tmp_path))["files"] != one
    (tmp_path / "adapter_config.json").write_text('{"r": 8}')
    with pytest.raises(ValueError, match="adapter"):
        runlog.model_identity(str(tmp_path))
    (tmp_path / "adapter_model.safetensors").write_bytes(b"a")
    assert runlog.adapter_identity(str(tmp_path))["rank"] == 8


def test_isolated_runs_never_fall_back(monkeypatch):
    monkeypatch.setattr(sandbox.shutil, "which", lambda name: None)
    with pytest.raises(RuntimeError, match="bubblewrap"):
        sandbox.command("/x/main.py", "/x", sandbox.Limits(bubblewrap=True))
    monkeypatch.setattr(sandbox.shutil, "which", lambda name: "/usr/bin/bwrap")
    made = sandbox.command("/x/main.py", "/x", sandbox.Limits(bubblewrap=True))
    assert made[0] == "/usr/bin/bwrap" and "--unshare-all" in made and made[-4:] == sandbox.command("/x/main.py", "/x")
