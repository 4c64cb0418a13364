import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kelpforge.operators import checks, dedup, quality, report, sample, turns


def test_first_wins_and_counts(spark):
    df = spark.createDataFrame([(3, "a", "z"), (1, "a", "y"), (2, "b", "x")], "o int, k string, v string")
    got = {r["k"]: (r["o"], r["v"], r["n"]) for r in dedup.first_wins(df, ["k"], "o", "n").collect()}
    assert got == {"a": (1, "y", 2), "b": (2, "x", 1)}


@pytest.mark.parametrize("seed", range(4))
def test_layered_dedup_against_a_sequential_model(spark, seed):
    r = random.Random(seed)
    rows = [(i, f"e{r.randrange(40)}", f"p{r.randrange(3)}", f"c{r.randrange(12)}", r.choice([None, "m1", "m2", "m3", "m4"]), r.choice(["s1", "s2", "s3", "s4"]), r.choice("xy")) for i in range(80)]
    rows = [(i, f"{p}-{e}", p, c, m, s, v) for i, e, p, c, m, s, v in rows]
    df = spark.createDataFrame(rows, "o int, e string, p string, c string, m string, s string, v string")
    got = {x["o"]: x["dedup_reason"] for x in dedup.layered_dedup(df, "o", "e", "p", "c", "m", "s", ["v"]).collect()}
    eps, codes, muts, variants, sigs, want = set(), set(), set(), set(), Counter(), {}
    for i, e, p, c, m, s, v in rows:
        if e in eps:
            want[i] = "duplicate_episode"
        elif (p, c) in codes:
            want[i] = "duplicate_code"
        elif m and (p, m) in muts:
            want[i] = "duplicate_mutation_set"
        elif sigs[p, s] >= 2:
            want[i] = "signature_limit"
        elif (p, s, v) in variants:
            want[i] = "duplicate_variant"
        else:
            want[i] = None
            eps.add(e), codes.add((p, c)), muts.add((p, m)), variants.add((p, s, v))
            sigs[p, s] += 1
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_constrained_sample_against_a_sequential_model(spark, seed):
    r = random.Random(seed)
    rows = [(i, r.choice("ABC"), r.choice([None, 1.0, 2.0, 3.0]), f"c{r.randrange(30)}", f"p{r.randrange(9)}", r.choice("xy")) for i in range(120)]
    quotas = {"A": 8, "B": 5, "C": 0}
    df = spark.createDataFrame(rows, "id int, cell string, u double, code string, prob string, beh string")
    picked, short = sample.constrained_sample(df, "cell", "id", "u", "code", "prob", quotas, 3, {"beh": 2})
    codes, probs, pairs, taken, want = set(), Counter(), Counter(), Counter(), set()
    for i, cell, u, code, prob, beh in sorted(rows, key=lambda x: (x[1], -(x[2] or 0.0), x[0])):
        if quotas[cell] > taken[cell] and code not in codes and probs[prob] < 3 and pairs[prob, beh] < 2:
            codes.add(code), want.add(i)
            probs[prob] += 1
            pairs[prob, beh] += 1
            taken[cell] += 1
    assert {x["id"] for x in picked.collect()} == want
    assert {x["cell"]: x["shortfall"] for x in short.collect()} == {c: quotas[c] - taken[c] for c in "AB"}


def test_capped_topk_takes_the_rarest_state_first(spark):
    rows = [(i, "common", float(i), "p1") for i in range(5)] + [(9, "rare", 0.0, "p1"), (10, "common", -1.0, "p2")]
    df = spark.createDataFrame(rows, "id int, state string, s double, p string")
    got = {r["id"] for r in sample.capped_topk(df, "state", "id", "s", "p", {"common": 3, "rare": 1}, 2).collect()}
    assert got == {9, 4, 10}


@pytest.mark.parametrize("seed", range(2))
def test_capped_topk_against_a_sequential_model(spark, seed):
    r = random.Random(seed)
    rows = [(i, r.choice("aabbbc"), float(r.randrange(20)), f"p{int(r.random() ** 3 * 40)}") for i in range(300)]
    quotas = {"a": 7, "b": 4, "c": 9}
    df = spark.createDataFrame(rows, "id int, state string, s double, p string")
    got = {x["id"] for x in sample.capped_topk(df, "state", "id", "s", "p", quotas, 2).collect()}
    sizes, taken, probs, want = Counter(x[1] for x in rows), Counter(), Counter(), set()
    for i, state, _, p in sorted(rows, key=lambda x: (sizes[x[1]], x[1], -x[2], x[0])):
        if taken[state] < quotas[state] and probs[p] < 2:
            want.add(i)
            taken[state] += 1
            probs[p] += 1
    assert got == want


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = spark.createDataFrame([(i, "ab"[i % 3 == 0]) for i in range(200)], "id int, s string")
    one = sample.stratified_split(df, "s", "id", {"x": 0.2, "y": 0.7, "z": 0.1}, 7)
    assert Counter(r["pool"] for r in one.collect()) == {"x": 40, "y": 140, "z": 20}
    assert checks.disjoint_issues(one, "id", "pool").count() == 0
    assert checks.set_equal(one, sample.stratified_split(df.repartition(7), "s", "id", {"x": 0.2, "y": 0.7, "z": 0.1}, 7))
    held = sample.problem_holdout(df, "id", "s", 0.1)
    assert held.where("split = 'dev'").count() == 20


def test_checks(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string")
    b = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, b double")
    assert checks.strict_join(a, b, ["k"]).count() == 2
    with pytest.raises(checks.IntegrityError):
        checks.strict_join(a, b.where("k = 1"), ["k"])
    with pytest.raises(checks.IntegrityError):
        checks.strict_join(a, b.union(b), ["k"])
    ids = spark.createDataFrame([(2, 0), (1, 1)], "k int, position int")
    assert [r["k"] for r in checks.in_given_order(a, ids, "k").collect()] == [2, 1]
    with pytest.raises(checks.IntegrityError):
        checks.keep_all_or_fail(a, spark.createDataFrame([(9,)], "k int"), "k")
    assert [r["k"] for r in checks.pending(a, b.where("k = 1"), "k").collect()] == [2]


def test_feedback_rules(spark):
    ok = (list(quality.FEEDBACK_KEYS), "wrong_answer", 1, 3, 1 / 3, "i")
    rows = [ok, (["status"], *ok[1:]), (ok[0], "odd", *ok[2:]), (ok[0], "wrong_answer", 4, 3, 1.0, "i"), (ok[0], "wrong_answer", 1, 3, 0.3, "i"), (ok[0], "accepted", 1, 3, 1 / 3, None), (ok[0], "accepted", 3, 3, 1.0, "i"), (ok[0], "accepted", 3, 3, 1.0, None)]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, k array<string>, s string, p int, t int, r double, f string")
    got = df.orderBy("n").select(quality.feedback_reason(*(F.col(c) for c in ("k", "s", "p", "t", "r", "f"))).alias("why")).collect()
    assert [r["why"] for r in got] == [None, "invalid_keys", "invalid_status", "invalid_counts", "invalid_pass_rate", "accepted_mismatch", "accepted_with_input", None]


def test_loss_mask_rules(spark):
    span = "array<struct<role:string,trainable:boolean,start:int,end:int>>"
    good = ([1, 2, 3], [1, 1, 1], [-100, 2, 3], [("user", False, 0, 1), ("assistant", True, 1, 3)])
    rows = [good, ([1, 2], *good[1:]), (good[0], good[1], [-100] * 3, good[3]), (good[0], [1, 0, 1], *good[2:]), (*good[:2], [-100, 9, 3], good[3]), (*good[:3], [("user", False, 0, 9)]), (*good[:3], [("user", False, 0, 2), ("assistant", True, 2, 3)])]
    df = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], f"n int, i array<int>, a array<int>, l array<int>, s {span}")
    got = df.orderBy("n").select(quality.loss_mask_reason(F.col("i"), F.col("a"), F.col("l"), F.col("s")).alias("why")).collect()
    assert [r["why"] for r in got] == [None, "length_mismatch", "no_label", "attention_not_one", "label_differs", "span_bounds", "span_supervision"]


@pytest.mark.parametrize("chars", [1000, 10])
def test_contains_pairs_in_one_block_and_in_many(spark, monkeypatch, chars):
    monkeypatch.setattr(quality, "CONTAINS_CHARS", chars)
    d = spark.createDataFrame([(1, "the quick brown fox jumps"), (2, "nothing here"), (3, None)], "d int, text string")
    b = spark.createDataFrame([(1, "quick brown"), (2, "brown fox jumps"), (3, "absent text!"), (4, "no"), (5, ""), (6, None), (7, "no")], "b int, text string")
    got = {(r["d"], r["b"]) for r in quality.contains_pairs(d, b, "d", "b").collect()}
    assert got == {(1, 1), (1, 2), (2, 4), (2, 7)}
    assert quality.contains_pairs(d, b.where("b = 5"), "d", "b").count() == 0


def test_paired_thresholds(spark):
    df = spark.createDataFrame([(2 / 3, 0.0), (1 / 3, 2 / 3), (2 / 3, 1.0), (1 / 3, 1 / 3)], "a double, b double")
    got = [r[0] for r in df.select(report.classify_post_submit(F.col("a"), F.col("b"))).collect()]
    assert got == ["post_submit_direct_repair", "post_submit_failure_replay", "post_submit_direct_repair", "discard"]


def test_percentile_definitions(spark):
    df = spark.createDataFrame([([4, 1, 3, 2],), ([],), ([5],)], "x array<int>")
    got = df.select(report.midpoint_percentile(F.col("x"), 0.5).alias("m"), report.upper_median(F.col("x")).alias("u")).collect()
    assert [tuple(r) for r in got] == [(2.5, 3), (None, None), (5.0, 5)]


def test_turn_states(spark):
    df = spark.createDataFrame([("submit", 0, 1), ("run_candidate", 0, 0), ("run_candidate", 1, 0), ("submit", 1, 0), ("submit", 1, 2), ("run_candidate", 1, 1), ("run_candidate", 2, 1), ("submit", 2, 2), ("submit", 2, 1)], "t string, f int, r int")
    got = [r[0] for r in df.select(turns.action_state(F.col("t"), F.col("f"), F.col("r"))).collect()]
    assert got == ["problem_submit", "other", "first_failure_run", "first_failure_direct_repair", "post_run_repair", "other", "second_failure_run", "multiround_final_submit", "post_run_repair"]


def test_pearson_of_constants_is_null(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 4), ("a", 3, 7), ("b", 1, 1), ("b", 1, 2)], "g string, x int, y int")
    got = {r["g"]: r["p"] for r in df.groupBy("g").agg(report.pearson("x", "y").alias("p")).collect()}
    assert got["b"] is None and got["a"] == pytest.approx(0.99339927)
