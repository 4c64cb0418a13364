"""The operators on small tables: brute force, and the cases that each docstring defines."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kelpforge.llm import bpe, chat_format, class_lm, decontaminate, exact_dedup, graph, html_extract, license_scan, near_dedup, queries, substring_dedup, toxicity
from kelpforge.llm.common import words

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id long, text string"
#: Clashing and extra columns, nulls in every column, repeats, empty and long texts.
ODD = [
    (1, "Same text, here.", "en", 7, None),
    (2, "sAME TEXT, here.", None, 7, "x"),
    (2, "sAME TEXT, here.", None, 7, "x"),
    (None, "Same text, here.", "en", None, "y"),
    (None, None, None, None, None),
    (5, "", "de", 1, "z"),
    (6, None, "de", 1, "z"),
    (7, "word " * 40_000, "fr", 2, "a"),
    (8, "Été à Ω \U0001f600", "fr", 2, "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, digest string, n long, bands string")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def fold(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def test_exact_dedup_odd_rows(odd, empty):
    got = sorted(exact_dedup.exact_dedup(odd).collect(), key=str)
    assert len(got) == len(ODD)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert {r["keep_id"] for r in by[1]} == {2} and not by[1][0]["kept"] and by[1][0]["group_size"] == 4
    assert all(r["kept"] for r in by[2]) and by[5][0]["keep_id"] == 6 and by[6][0]["group_size"] == 3
    assert by[7][0]["text_sha256"] == hashlib.sha256(("word " * 40_000).encode()).hexdigest()
    assert all(r["keep_id"] in (2, 6) and not r["kept"] for r in by[None])
    assert exact_dedup.exact_dedup(empty).count() == 0


@pytest.mark.parametrize("cut", [None, -1, 10**6])
def test_exact_dedup_is_the_same_for_every_snapshot(docs, cut):
    groups = defaultdict(list)
    for r in rows_of("documents"):
        groups[hashlib.sha256(fold(r["text"]).encode()).hexdigest()].append(r["doc_id"])
    want = {(i, max(g), len(g), i == max(g), h) for h, g in groups.items() for i in g}
    assert {tuple(r) for r in exact_dedup.exact_dedup(docs, snapshot_until=cut).collect()} == want


def test_licence_scan_against_the_pattern(docs, odd, empty):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    got = {r["doc_id"]: r for r in license_scan.license_report(license_scan.license_spans(docs)).collect()}
    for r in rows_of("documents"):
        w = pattern.findall(fold(r["text"]))
        at = [(i, label) for p, label in phrases.items() for i in range(len(w)) if tuple(w[i : i + len(p)]) == p]
        g, starts = got[r["doc_id"]], [i for i, _ in at]
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"]) == (len(w), len(at), min(starts, default=None), max(starts, default=None))
        assert g["base_labels"] == ",".join(sorted({x for _, x in at})) and set(g["base_labels"].split(",")) <= set(g["labels"].split(",")) | {""}
        assert (g["score"] == 1.0) if at else (0 <= g["score"] <= 1)
    out = license_scan.license_report(license_scan.license_spans(odd)).collect()
    assert len(out) == len(ODD) and all(r["score"] == 0 and r["labels"] == "" for r in out)
    assert license_scan.license_spans(empty).count() == 0


def test_substring_dedup_finds_planted_passages(spark, empty):
    r = random.Random(9)
    vocab = [f"w{i}" for i in range(4000)]
    make = lambda n: [r.choice(vocab) for _ in range(n)]
    passage, line = make(60), make(20)
    near = list(passage)
    near[30] = "changed"
    rows = {i: make(200) for i in range(1, 13)}
    for i, at in ((2, 10), (5, 100), (9, 140)):
        rows[i][at : at + 60] = passage
    rows[7][50:110] = near
    for i in range(1, 13):  # a common line, too short to count by itself (9 holds it right after the passage)
        rows[i] += line
    rows[11] = make(49)
    rows[12] = list(rows[11])
    rows[20] = list(rows[3])
    plain = [(i, " ".join(w).capitalize()) for i, w in rows.items()] + [(None, " ".join(passage)), (30, None), (31, "")]
    got = defaultdict(list)
    for x in substring_dedup.substring_dedup(spark.createDataFrame(plain, DOC)).collect():
        got[x["doc_id"]].append(x)
    assert set(got) == {2, 5, 9, 7, 3, 20}
    for i, at in ((2, 10), (5, 100), (9, 140)):
        assert len(got[i]) == 1 and got[i][0]["start_word"] <= at + 3 and got[i][0]["end_word"] >= at + 57
        assert got[i][0]["n_words"] <= 84 and got[i][0]["partner_id"] in (2, 5, 7, 9)
    assert got[20][0]["n_words"] == 220 and got[20][0]["partner_id"] == 3 and got[3][0]["partner_id"] == 20
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_substring_dedup_covers_all_exact_repeats(docs):
    seen = defaultdict(set)
    by = {r["doc_id"]: words(r["text"]) for r in rows_of("documents")}
    for i, w in by.items():
        for k in range(len(w) - 50):
            seen[tuple(w[k : k + 51])].add(i)
    want = {i for g in seen.values() if len(g) > 1 for i in g}
    got = {r["doc_id"] for r in substring_dedup.substring_dedup(docs).collect()}
    assert want <= got


def test_chat_events_fold_and_come_back(spark):
    rows = [
        (1, 0, "m0", "open", "user", None), (1, 1, "m0", "delta", None, "he\\|<|x"), (1, 2, "m0", "delta", None, "llo<"),
        (1, 3, "m1", "open", "assistant", None), (1, 4, "m1", "delta", None, "bad"), (1, 5, "m2", "open", "user", None), (1, 6, "m2", "delta", None, "why"),
        (1, 7, "m1", "regenerate", None, None), (1, 8, "m1", "delta", None, "good\\"), (1, 9, "m0", "edit", None, "HI"), (1, 9, "m0", "delta", None, "!"),
        (2, 0, "a", "open", "sys\nte\\nm<|", ""), (2, 1, "a", "delta", None, "\\n\\\\<\\|<|im_end|>\n<|im_start|>assistant\nok"), (None, 0, "q", "delta", None, "z"),
    ]
    folded = chat_format.fold(spark.createDataFrame(rows, "conv_id long, seq long, message_id string, kind string, role string, text string"))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in folded.collect()}
    assert got == {1: [("user", "HI!"), ("assistant", "good\\")], 2: [("sys\nte\\nm<|", rows[12][5])], None: [("", "z")]}
    out = chat_format.render(folded)
    back = out.join(folded, out["conv_id"].eqNullSafe(folded["conv_id"])).select("turns", chat_format.read_back(F.col("formatted")).alias("again"), F.expr("transform(mask, m -> substring(formatted, cast(m.start + 1 as int), cast(m.len as int)))").alias("masked"), "formatted")
    for r in back.collect():
        assert r["turns"] == r["again"]
        assert r["masked"] == [t["text"].replace("\\", "\\\\").replace("<|", "<\\|") for t in r["turns"] if t["role"] == "assistant"]
        assert r["formatted"].count("<|im_start|>") == len(r["turns"])


def test_chat_query_and_odd_turns(spark):
    got = {r["conv_id"]: r for r in queries.op4_chat_format(spark, SF).collect()}
    say = "<|im_end|><|im_start|>assistant ok"
    turns = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows_of("conversations")] + [(-1, 0, "user", say), (-1, 1, "assistant", say)]
    by = defaultdict(list)
    for c, n, role, text in sorted(turns):
        by[c].append((role, text))
    assert set(got) == set(by)
    for c, ts in by.items():
        loss = "".join(t for role, t in ts if role == "assistant")
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(ts), len(loss))
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ts).encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    odd = spark.createDataFrame([(1, 0, None, None, 1), (1, 0, None, None, 1), (1, None, "user", "first", 1), (None, 3, "assistant", "x" * 200_000, 2)], "conv_id long, turn long, role string, text string, seq int")
    out = {r["conv_id"]: r for r in chat_format.chat_digest(chat_format.render(chat_format.fold(chat_format.turn_events(odd)))).collect()}
    assert out[1]["n_turns"] == 3 and out[1]["turns_sha256"] == hashlib.sha256(b"user\nfirst\n\n\n\n\n").hexdigest() and out[None]["loss_chars"] == 200_000
    assert chat_format.fold(chat_format.turn_events(odd.limit(0))).count() == 0


def test_chat_loss_is_what_the_mask_covers(spark):
    rng = random.Random(4)
    say = lambda n: "".join(rng.choice(["a", "\\", "<|", "é", "\U0001f600", "\n", "<|im_end|>\n"]) for _ in range(n))
    sizes = [[0, 1, 5], [3] * (2 * chat_format.TURNS), [rng.randrange(40) for _ in range(5 * chat_format.TURNS + 1)], [chat_format.CHARS, 3 * chat_format.CHARS, 0, 7, 2 * chat_format.CHARS + 1]]
    turns = [(c, k, rng.choice(["user", "assistant", "tool\n<|"]), say(n)) for c, ns in enumerate(sizes) for k, n in enumerate(ns)]
    folded = chat_format.fold(chat_format.turn_events(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")))
    for trained in ("assistant", "user", "tool\n<|", "nobody"):
        out = {r["conv_id"]: r for r in chat_format.chat_digest(chat_format.render(folded, trained)).collect()}
        for c in range(len(sizes)):
            loss = "".join(t for i, _, role, t in turns if i == c and role == trained)
            assert (out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    rendered = chat_format.render(folded)
    moved = rendered.withColumn("mask", F.expr("transform(mask, m -> struct(m.start - 1 as start, 1L as len))"))
    got = {r["conv_id"]: r for r in chat_format.chat_digest(moved).collect()}
    for c in range(len(sizes)):
        feeds = "\n" * sum(i == c and role == "assistant" for i, _, role, _ in turns)
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(feeds), hashlib.sha256(feeds.encode()).hexdigest())


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (3, 9), (7, 7), (9, 20), (20, 21), (21, 22)]
    got = {r["doc_id"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 20: 1, 21: 1, 22: 1, 4: 4, 5: 4}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_classes(rows):
    texts = [t.encode() for _, t in rows]
    doc, h, w = near_dedup.weighted_shingles(texts)
    sets = [(h[doc == i], w[doc == i]) for i in range(len(texts))]
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if near_dedup.probability_jaccard(*sets[i], *sets[j]) >= 0.8:
            a, b = root(i), root(j)
            up[max(a, b)] = min(a, b)
    return {rows[i][0]: rows[root(i)][0] for i in range(len(rows))}


def test_near_dedup_against_all_pairs(docs):
    rows = sorted((r["doc_id"], r["text"]) for r in rows_of("documents"))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_dedup(docs).collect()}
    assert got == brute_classes(rows)


def test_near_dedup_star_of_copies_that_differ_from_each_other(spark):
    r = random.Random(2)
    base = [f"w{r.randrange(10**6)}" for _ in range(300)]
    rows = []
    for i in range(40):
        w = list(base)
        if i != 25:  # the middle of the star isn't the smallest id
            for k in r.sample(range(0, 300, 10), 5):
                w[k] = f"x{i}"
        rows.append((i + 1, " ".join(w)))
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_dedup(spark.createDataFrame(rows, DOC)).collect()}
    assert got == brute_classes(rows)


def test_near_dedup_odd_rows(odd, empty):
    got = near_dedup.near_dedup(odd).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(ODD)
    assert by[1]["class_id"] == 1 and by[2]["class_id"] == 1 and not by[2]["kept"]
    assert by[5]["kept"] and by[6]["kept"] and by[7]["kept"] and by[None]["class_id"] is None
    assert near_dedup.near_dedup(empty).count() == 0


def test_toxicity_held_out_and_odd_rows(spark, odd, empty):
    r = random.Random(1)
    bad = ["zork", "blarg"]
    rows, labels = [], []
    for i in range(400):
        w = [f"n{r.randrange(60)}" for _ in range(30)] + (["women"] if i % 5 == 0 else [])
        if toxic := i % 4 == 0:
            w.insert(r.randrange(30), r.choice(bad) + r.choice(["", "s", "ing"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    model = toxicity.fit_toxicity(spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id long, toxic int"))
    scored = {x["doc_id"]: x["score"] for x in toxicity.score_toxicity(spark.createDataFrame(rows, DOC), model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all((scored[i] >= 0.3) == (i % 4 == 0) for i in held)
    assert abs(model.score("n1 women") - model.score("n1 men")) < 0.02
    assert model.score(None) == model.score("") and 0 <= model.score("zork " * 10_000) <= 1
    assert toxicity.score_toxicity(odd, model).count() == len(ODD) and toxicity.score_toxicity(empty, model).count() == 0
    kinds = "doc_id long, toxic int"
    none = toxicity.fit_toxicity(empty, spark.createDataFrame([(None, 1), (3, None)], kinds))
    assert 0 < none.score("x") < 1
    kept = toxicity.with_toxicity(odd, model)
    assert kept.columns == [*odd.columns, "toxicity"] and kept.count() == len(ODD)


def test_toxicity_never_learns_held_out_labels(spark):
    rows = [(i, f"a{i % 7} b{i % 3} " + ("vile" if i % 2 else "kind")) for i in range(300)]
    labels = [(i, i % 2) for i in range(300)]
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    d = spark.createDataFrame(rows, DOC)
    one, two = (toxicity.fit_toxicity(d, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert one.weights == two.weights and one.bias == two.bias


def test_class_lm_against_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in rows_of("documents")]
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            counts.update(class_lm.tokens(t))
    n, v = sum(counts.values()), len(counts)
    got = class_lm.score_documents(docs, class_words=100, n_classes=8, head=500).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    better = []
    for r in got:
        toks = class_lm.tokens(texts[r["doc_id"]])
        base = sum(log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(toks), sum(counts[w] > 0 for w in toks), n)
        assert r["base_score"] == pytest.approx(base) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        assert r["score"] < 0
        if r["held_out"]:
            better.append(r["score"] - r["base_score"])
    assert sum(better) > 0


def test_class_lm_head_size_changes_nothing(docs):
    a, b = ({r["doc_id"]: r["score"] for r in class_lm.score_documents(docs, class_words=100, n_classes=8, head=head).collect()} for head in (150, 50_000))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)


def test_class_lm_odd_rows(odd, empty):
    got = class_lm.score_documents(odd).collect()
    assert len(got) == len(ODD) and {r["n_tokens"] for r in got if r["doc_id"] in (5, 6)} == {1}
    assert class_lm.score_documents(empty).count() == 0


def test_html_query_and_odd_rows(spark, empty):
    got = {r["page_id"]: r for r in queries.op8_html_extract(spark, SF).collect()}
    for p in rows_of("pages"):
        art = re.search(r"<article>(.*)</article>", p["html"], re.S)[1]
        text = " ".join(html_extract.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<(/?)(p|h1|br|li|ul|div)\b[^>]*>", " ", art))).split())
        assert got[p["page_id"]]["text"] == text and got[p["page_id"]]["n_chars"] == len(text) and got[p["page_id"]]["url"] == p["url"]
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>a", None), (1, "u", "", "x"), (2, "u", "<p>" + "y " * 100_000, "x")], "page_id long, url string, html string, text string")
    out = sorted((r["text"] for r in html_extract.extract_main_text(odd).collect()), key=len)
    assert out[:3] == ["", "", "a"] and len(out[3]) == 199_999
    assert html_extract.extract_main_text(odd.limit(0)).count() == 0


def test_contamination_against_brute_force(spark, docs, odd, empty):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [(str(r["item_id"]), words(r["text"])) for r in rows_of("benchmark")]
    runs = defaultdict(set)
    for i, w in items:
        for k in range(len(w) - 9) if len(w) >= 10 else [0]:
            runs[tuple(w[k : k + 10])].add(i)
    got = {r["doc_id"]: r for r in decontaminate.contamination_report(decontaminate.contamination(docs, bench)).collect()}
    dirty = 0
    for r in rows_of("documents"):
        w, hit, ids = words(r["text"]), set(), set()
        for size in {len(x) for x in runs}:
            for k in range(len(w) - size + 1):
                if (found := runs.get(tuple(w[k : k + size]))) is not None:
                    hit |= set(range(k, k + size))
                    ids |= found
        g = got[r["doc_id"]]
        assert (g["n_words"], g["n_hit"], g["n_items"], g["contaminated"]) == (len(w), len(hit), len(ids), bool(hit))
        assert g["items_sha256"] == hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        dirty += bool(hit)
    assert dirty and decontaminate.decontaminate(docs, bench).count() == len(got) - dirty
    assert decontaminate.contamination(odd, bench).count() == len(ODD) and decontaminate.contamination(empty, bench).count() == 0
    none = decontaminate.contamination_report(decontaminate.contamination(odd, bench.limit(0)))
    assert none.where("contaminated").count() == 0


def test_contamination_in_blocks_and_short_items(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "alpha beta"), (2, "one two three four five six seven eight nine ten eleven"), (None, "gamma"), (4, None), (1, "alpha beta"), (5, " ")], "item_id long, text string")
    d = spark.createDataFrame([(1, "x ALPHA, beta gamma y"), (2, "zero one two three four five six seven eight nine ten eleven twelve"), (3, None), (4, "alpha gamma alpha")], DOC)
    want = [(1, 3, 1), (2, 11, 1), (3, 0, 0), (4, 1, 0)]
    for size in (500_000, 3):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", size)
        got = decontaminate.contamination_report(decontaminate.contamination(d, bench))
        assert sorted((r["doc_id"], r["n_hit"], r["n_items"]) for r in got.collect()) == want
    cut = decontaminate.decontaminate(d, bench, max_run=1, max_coverage=0.7)
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {1: "x  y", 3: None, 4: "alpha gamma alpha"}


def test_rows_with_null_or_repeated_ids_are_judged_by_their_own_text(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    bad, rows = "x one two three four five six seven eight nine ten", "doc_id long, text string, _n long"
    d = spark.createDataFrame([(None, bad, 1), (None, "clean", 2), (3, bad, 3), (3, "clean too", 4)], rows)
    assert {r["_n"] for r in decontaminate.decontaminate(d, bench).collect()} == {2, 4}
    assert {(r["_n"], r["text"]) for r in decontaminate.decontaminate(d, bench, max_coverage=1.0).collect()} == {(1, "x "), (2, "clean"), (3, "x "), (4, "clean too")}
    d = spark.createDataFrame([(None, "same", 1), (None, "SAME", 2), (None, "other", 3), (5, "other", 4), (5, "Other", 5), (5, "third", 6), (4, "third", 7), (None, None, 8), (None, "", 9)], rows)
    got = sorted(r["_n"] for r in exact_dedup.without_copies(d).collect())
    assert len(got) == 4 and {6} < set(got) and len({1, 2} & set(got)) == len({4, 5} & set(got)) == len({8, 9} & set(got)) == 1


def test_bpe_table_round_trip(spark, docs, odd, empty):
    enc = bpe.bpe_encode(odd, PATH)
    back = sorted((r["doc_id"] or 0, r["text"]) for r in bpe.bpe_decode(enc, PATH).collect())
    assert back == sorted((r[0] or 0, r[1] or "") for r in ODD)
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: r for r in bpe.bpe_digest(docs, PATH).collect()}
    for r in rows_of("documents"):
        ids = lib.encode(r["text"], add_special_tokens=False).ids
        g = got[r["doc_id"]]
        assert g["n_tokens"] == len(ids) and g["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.bpe_digest(empty, PATH).count() == 0
    void = bpe.bpe_digest(spark.createDataFrame([(1, None)], DOC), PATH).first()
    assert void["n_tokens"] == 0 and void["ids_sha256"] == void["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.encode_documents(odd, PATH).columns == ["doc_id", "digest", "n", "bands", "ids", "n_tokens"]


def test_numpy_seed_is_not_global():
    assert np.array_equal(*(near_dedup.prob_minhash(np.zeros(3, int), np.arange(3).astype(np.uint64), np.ones(3, int), 1, 8) for _ in range(2)))


def sketched(texts):
    """(ids, sets, weights, card table) of texts as block comparison takes them."""
    doc, h, w = near_dedup.weighted_shingles([t.encode() for t in texts])
    sig = near_dedup.prob_minhash(doc, h, w, len(texts), 120).astype(np.uint32)
    sets = [(h[doc == i], w[doc == i].astype(np.int32)) for i in range(len(texts))]
    n = len(texts)
    return sets, pa.table({
        "doc_id": list(range(n)), "label": list(range(n)), "sig": [x.tobytes() for x in sig],
        "set": [x.tobytes() for x, _ in sets], "weights": pa.array([None if (v == 1).all() else v.tobytes() for _, v in sets], pa.binary()),
    })


@pytest.mark.parametrize("seed", range(3))
def test_block_comparison_joins_what_all_pairs_join(seed):
    r = random.Random(seed)
    base = [[f"w{r.randrange(500)}" for _ in range(120)] for _ in range(3)]
    texts = []
    for i in range(90):
        w = list(base[i % 3])
        for k in range(r.randint(0, 5)):
            w[r.randrange(120)] = f"x{i}.{k}"
        texts.append(" ".join(w + w[:20] * (i % 7 == 0)))
    sets, cards = sketched(texts)
    up = list(range(90))

    def root(up, x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(90), 2):
        if near_dedup.probability_jaccard(*sets[i], *sets[j]) >= 0.8:
            a, b = root(up, i), root(up, j)
            up[max(a, b)] = min(a, b)
    got = near_dedup.block_links(cards, cards, 0.8)
    mine = list(range(90))
    for i, j in got:
        assert near_dedup.probability_jaccard(*sets[i], *sets[j]) >= 0.8
        a, b = root(mine, i), root(mine, j)
        assert a != b  # only links that join something come out
        mine[max(a, b)] = min(a, b)
    assert [root(mine, i) for i in range(90)] == [root(up, i) for i in range(90)] and 3 < len(set(map(lambda i: root(up, i), range(90)))) < 90


def test_near_dedup_finds_links_between_members_that_fail_their_leader(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 20_000)  # many blocks a group
    r = random.Random(5)
    base = [f"w{r.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in range(0, 200, 200 // (i % 12 + 1)):
            w[k] = f"v{i // 2}"
        rows.append((i + 1, " ".join(w)))
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_dedup(spark.createDataFrame(rows, DOC)).collect()}
    want = brute_classes(rows)
    assert got == want and 1 < len(set(want.values())) < 60


def test_block_comparison_loses_no_passage(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", 4000)  # many blocks a group
    r = random.Random(12)
    common = [f"c{i}" for i in range(20)]
    passage = [f"p{i}" for i in range(55)]
    rows = {}
    for i in range(30):
        w = [f"u{i}_{k}" for k in range(60)] + common + [f"v{i}_{k}" for k in range(60)]
        if i in (4, 17, 23):
            at = r.randrange(40)
            w[at:at] = passage
        rows[i] = w
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], DOC)
    places = spark.createDataFrame([(0, i, 0, 130) for i in rows], "leader long, doc_id long, lo int, hi int")
    found = substring_dedup.block_passages(substring_dedup.token_seqs(d), places.where("doc_id = 17"), places, substring_dedup.LEAST, 0.8).collect()
    assert found and {(x["a"], x["b"]) for x in found} <= {(4, 17), (23, 17)}  # closed texts are linked already
    # open ones are all linked; texts in one component stand for each other
    found = substring_dedup.block_passages(substring_dedup.token_seqs(d), places.where("doc_id IN (4, 17, 23)"), places, substring_dedup.LEAST, 0.8).collect()
    assert len({x["b"] for x in found}) == 3 and len({min(x["a"], x["b"]) for x in found} | {max(x["a"], x["b"]) for x in found}) == 3 and len(found) <= 6


def test_interval_pairs_against_all_pairs():
    r = np.random.default_rng(4)
    for _ in range(30):
        rows = []
        for h in range(4):
            cuts = np.sort(r.choice(200, 20, replace=False))
            rows += [((int(r.integers(8)) << 3) | h, int(x), int(y) - 1) for x, y in zip(cuts[:-1], cuts[1:]) if r.random() < 0.6]
        sig, lo, hi = (np.array(c, dtype=np.int64) for c in zip(*rows))
        x, y, first, last = substring_dedup.interval_pairs(sig, lo, hi)
        got = {(min(a, b), max(a, b), i) for a, b, f, t in zip(x.tolist(), y.tolist(), first.tolist(), last.tolist()) for i in range(f, t + 1)}
        want = {(min(a, c), max(a, c), i) for a, f, t in rows for c, g, u in rows if (a ^ c) & 7 for i in range(max(f, g), min(t, u) + 1)}
        assert got == want


def alike_somewhere(a, b, least, threshold):
    """Whether a run of ``least`` tokens of b is alike with a run of a, by trying all."""
    for s in range(len(b) - least + 1):
        part = set(b[s : s + least].tolist())
        for t in range(len(a)):
            other = set()
            for k in range(t, min(len(a), t + 2 * least)):
                other.add(int(a[k]))
                if len(part & other) >= threshold * len(part | other):
                    return True
    return False


@pytest.mark.parametrize("distinct", [True, False])
def test_verification_tries_every_start(distinct):
    r = np.random.default_rng(8)
    seen = Counter()
    for _ in range(150):
        a = r.permutation(40).astype(np.uint64) + np.uint64(1)
        if not distinct:  # a line of five tokens stands twice
            a[25:30] = a[3:8]
        b = np.concatenate([a[r.integers(0, 8) :], r.permutation(10) + 100]).astype(np.uint64)
        at = r.choice(len(b), int(r.integers(4, 16)), replace=False)
        b[at] = 1000 + at
        seen[bool(substring_dedup.shared_passages(a, b, 12, 0.8)), alike_somewhere(a, b, 12, 0.8)] += 1
    assert seen[True, True] > 15 and seen[False, False] > 15
    if distinct:
        assert seen[False, True] == 0 and seen[True, False] <= 2  # a longer stretch may be alike as a whole
    else:
        assert seen[False, True] <= 0.05 * seen[True, True]


@pytest.mark.parametrize("changes", [0, 1, 2])
def test_recall_of_planted_passages_in_prose(spark, docs, changes):
    r = random.Random(changes)
    vocab = sorted({w.decode() for x in rows_of("documents")[:50] for w in words(x["text"])})
    rows, alike = [], set()
    for i in range(200):  # a passage of 65 words, with some words changed in its copy
        passage = [r.choice(vocab) + ("" if r.random() < 0.7 else str(r.randrange(1000))) for _ in range(65)]
        copy = list(passage)
        for k in r.sample(range(65), changes):
            copy[k] = f"e{i}x{k}"
        same = [passage[k : k + 5] == copy[k : k + 5] for k in range(61)]
        if max(sum(same[k : k + 46]) for k in range(16)) >= 41:  # 41 of 51 shingles: 0.8
            alike.add(i)
        for side, w in enumerate((passage, copy)):
            out = [r.choice(vocab) + str(r.randrange(1000)) for _ in range(120)]
            out[40:40] = w
            rows.append((2 * i + side, " ".join(out)))
    d = spark.createDataFrame(rows, DOC)
    got = {x["doc_id"]: x["class_id"] for x in substring_dedup.substring_dedup(d).collect()}
    found = sum(got.get(2 * i) == got.get(2 * i + 1) == 2 * i for i in alike)
    print("recall", changes, found, len(alike), len(got) // 2)
    assert found >= 0.97 * len(alike) and len(alike) >= (200, 195, 40)[changes] and all(i - i % 2 == c for i, c in got.items())


def test_texts_that_repeat_themselves_stay_small(spark):
    line = " ".join(f"w{i}" for i in range(12))
    d = spark.createDataFrame([(1, " ".join([line] * 600)), (2, " ".join([line] * 500)), (3, "word " * 5000)], DOC)
    got = {r["doc_id"]: r["n_words"] for r in substring_dedup.substring_dedup(d).collect()}
    assert set(got) == {1, 2}


def test_a_link_at_one_place_closes_no_other_place(spark):
    r = random.Random(21)
    make = lambda n, x: [f"{x}{r.randrange(10**6)}" for _ in range(n)]
    hot, passage = make(80, "h"), make(60, "p")
    bad = [w if k % 9 else f"bad{k}" for k, w in enumerate(passage)]
    far = lambda i: make(150, f"x{i}q")
    rows = {i: far(i) + hot + far(i) + (bad if i == 1 else passage) + far(i) for i in (1, 2, 3)}
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in rows.items()], DOC)
    # one key stands at the hot passage, another at the passage whose leader holds a variant
    at = lambda s, n: (s - 20, s + n + 10)
    m = [(7, i, *at(150, 80)) for i in rows] + [(8, i, *at(380, 60)) for i in rows]
    links = substring_dedup.passage_links(d, spark.createDataFrame(m, "key long, doc_id long, lo int, hi int")).collect()
    pairs = {(min(x["a"], x["b"]), max(x["a"], x["b"])) for x in links if x["b_lo"] >= 340}
    assert (2, 3) in pairs and not any(1 in p for p in pairs)


def test_further_places_of_a_leader_are_found(spark):
    r = random.Random(22)
    make = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    passage = make(60)
    d = spark.createDataFrame([(1, " ".join(make(100) + passage + make(200) + passage + make(50))), (2, " ".join(make(30) + passage + make(100)))], DOC)
    got = [(x["doc_id"], x["start_word"], x["end_word"]) for x in substring_dedup.substring_dedup(d).collect()]
    assert sorted(got) == [(1, 100, 160), (1, 360, 420), (2, 30, 90)]


def test_class_lm_gives_words_beyond_the_seeds_a_class(spark):
    r = random.Random(5)
    sides = [[f"{x}{i}" for i in range(40)] for x in "ab"]
    rows = [(i, " ".join(r.choice(sides[(i + k) % 2]) for k in range(60))) for i in range(300)]
    d = spark.createDataFrame(rows, DOC)
    _, classed = class_lm.fit_classes(d, class_words=10, n_classes=2, head=20)
    got = {bytes(x["token"]).decode(): x["cls"] for x in classed.collect()}
    assert len({got[w] for w in sides[0]}) == len({got[w] for w in sides[1]}) == 1 and len(set(got.values())) == 3
    pairs = spark.createDataFrame([(1, "a1 b2 " * 20), (11, "a1 a2 " * 20)], DOC)
    score = {x["doc_id"]: x["score"] - x["base_score"] for x in class_lm.score_documents(d.unionByName(pairs.select((F.col("doc_id") + 1000).alias("doc_id"), "text")), class_words=10, n_classes=2, head=20).collect()}
    assert score[1001] > score[1011] + 5
