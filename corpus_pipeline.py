"""A corpus pipeline: toxicity, exact dedup, near dedup, decontamination, tokenizing.

Every stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``, in the columns
of ``documents``; the last returns the encoded documents. Between two stages the rows are
written as Parquet in the shared folder and read again, so a lost executor costs no stage
before. An empty table passes every stage; columns of any names are kept.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kelpforge.llm.bpe import encode_documents
from kelpforge.llm.common import only_ids
from kelpforge.llm.decontaminate import decontaminate
from kelpforge.llm.exact_dedup import without_copies
from kelpforge.llm.near_dedup import near_dedup
from kelpforge.llm.queries import TOXIC
from kelpforge.llm.toxicity import fit_toxicity, with_toxicity
from kelpforge.session import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic; learnt from the labels that aren't held out.

    Every row is judged by its own text; null or empty texts have the score of no features.
    """
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return with_toxicity(docs, model, "_toxicity").where(f"_toxicity < {TOXIC}").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays, that of the largest id; rows without an id count as least."""
    return without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document of the smallest id stays.

    Rows of one id are one document; a row without an id belongs to no class and stays.
    """
    rejected = near_dedup(docs).where("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return only_ids(docs, materialize(rejected, "rejected"), "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in which a window of a benchmark item occurs (coverage limit 0).

    Every row is judged by its own text; null or empty texts are clean.
    """
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str) -> DataFrame:
    """The ids of each document whose ids decode to its text again (all do), and its origin.

    A null text counts as empty and has no ids.
    """
    return encode_documents(docs, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", partial(encode, path=public_tokenizers.path("byte_bpe_50k.json"))),
]

#: The classifier and the signatures have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
