"""The pipeline against a plain version of its stages."""

import hashlib

import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

import corpus_pipeline
from kelpforge.llm import decontaminate
from kelpforge.llm.common import words
from kelpforge.session import materialize
from tests.llm.test_operators import SF, brute_classes, fold, rows_of


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    kept, now = [], docs
    for name, stage in corpus_pipeline.STAGES:
        now = materialize(stage(spark, now, SF), name)
        kept.append({r["doc_id"] for r in now.collect()})
        assert name == "bpe" or now.columns == docs.columns
    rows = {r["doc_id"]: r["text"] for r in rows_of("documents")}
    left = {i: rows[i] for i in kept[0]}
    last = {}
    for i in sorted(left):
        last[hashlib.sha256(fold(left[i]).encode()).digest()] = i
    assert kept[1] == set(last.values())
    classes = brute_classes(sorted((i, rows[i]) for i in kept[1]))
    assert kept[2] == {i for i, c in classes.items() if i == c}
    auto = decontaminate.ItemAutomaton([(str(r["item_id"]), words(r["text"])) for r in rows_of("benchmark")])
    assert kept[3] == kept[4] == {i for i in kept[2] if not auto.hits(words(rows[i]))[0]}
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert all(r["ids"] == lib.encode(rows[r["doc_id"]], add_special_tokens=False).ids for r in now.collect())
    assert pq.read_table(f"{SF}/documents.parquet").num_rows > len(kept[4]) > 0


def test_odd_documents_pass_every_stage(spark):
    rows = [(1, None, "en", None, None), (None, "x", None, None, 1), (2, "", "de", "s", 0), (3, "a b " * 20_000, "en", "s", 80_000), (3, "a b " * 20_000, "en", "s", 80_000)]
    now = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        now = materialize(stage(spark, now, SF), "odd")
    got = [r["doc_id"] for r in now.collect()]
    assert 2 in got and 3 in got and None in got and 1 not in got  # an empty text's larger id stays
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = materialize(stage(spark, empty, SF), "none")
    assert empty.count() == 0
