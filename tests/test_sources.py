import json

import pytest

from kelpforge.operators.checks import IntegrityError
from kelpforge.plans import load
from kelpforge.sources import jsonl, store
from kelpforge.streaming import ingest


def test_problem_reject_reasons_in_order(spark):
    got = [r["reason"] for r in load().QUERIES["problem_rejects"](spark, "").orderBy("line_no").collect()]
    want = [None, "missing_id", "empty_question", "invalid_difficulty", "invalid_starter_code", "invalid_url", "invalid_solutions_json", "invalid_input_output_json", "invalid_solutions", "invalid_input_output", "invalid_tests", "invalid_fn_name", "invalid_json", "record_not_object", None]
    assert got == want


def test_lines_keep_their_numbers(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\n[1]\n{bad\n')
    rows = jsonl.read_lines(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r["line_no"], r["reason"]) for r in rows] == [(1, None), (3, "record_not_object"), (4, "invalid_json")]
    assert jsonl.scan_records(spark, str(tmp_path)).count() == 3
    with pytest.raises(Exception, match="(?i)malformed|failfast|record"):
        jsonl.read_strict(spark, str(tmp_path), "a int").collect()


def test_digests(spark, tmp_path):
    (tmp_path / "x").write_text("1")
    (tmp_path / "y").write_text("2")
    one = jsonl.tree_digest(jsonl.file_digests(spark, str(tmp_path))).first()[0]
    (tmp_path / "y").write_text("3")
    assert one != jsonl.tree_digest(jsonl.file_digests(spark, str(tmp_path))).first()[0]


def test_keyed_store_resumes_and_refuses(spark, tmp_path):
    s = store.KeyedStore(spark, str(tmp_path / "s"), "d1")
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, payload string")
    s.append(rows)
    s.append(rows)
    assert s.rows().count() == 2
    assert [r["key"] for r in s.todo(spark.createDataFrame([("a",), ("c",)], "key string")).collect()] == ["c"]
    with pytest.raises(IntegrityError):
        s.append(spark.createDataFrame([("a", "other")], "key string, payload string"))
    assert store.KeyedStore(spark, str(tmp_path / "s"), "d2").rows().count() == 0


def test_config_and_output_policy(spark, tmp_path):
    assert store.RunConfig.load({"seed": 1}).digest != store.RunConfig().digest
    with pytest.raises(ValueError):
        store.RunConfig.load({"sead": 1})
    df, p = spark.range(3), str(tmp_path / "t")
    store.write_table(df, p)
    with pytest.raises(Exception, match="(?i)exists"):
        store.write_table(df, p)
    with pytest.raises(ValueError):
        store.write_table(df, p, resume=True, overwrite=True)
    store.write_table(df, p, resume=True)
    assert spark.read.parquet(p).count() == 6


def test_stream_takes_only_what_is_new(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    src.mkdir()
    (src / "1.jsonl").write_text(json.dumps({"a": 1}) + "\n{bad\n")
    ingest.append_to(ingest.judged_lines(spark, str(src)), out, cp).awaitTermination()
    (src / "2.jsonl").write_text("[]\n")
    ingest.append_to(ingest.judged_lines(spark, str(src)), out, cp).awaitTermination()
    assert sorted(str(r["reason"]) for r in spark.read.parquet(out).collect()) == ["None", "invalid_json", "record_not_object"]
