"""Rule checks on problems, feedback, messages and token rows, and text containment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpforge.functions.text import ordered_reason, strip

#: Characters of items that one automaton of a containment search holds (a node each at most).
CONTAINS_CHARS = 1 << 20
#: The JSON keys of private fields, as they look in a text that leaks them.
INTERNAL_MARKERS = ('"expected":', '"actual":', '"test_index":', '"reference_solution":', '"source_span":', '"mutation_operator":')
#: What a feedback holds, and its statuses.
FEEDBACK_KEYS = ("failing_input", "pass_rate", "passed", "status", "total")
STATUSES = ("accepted", "wrong_answer", "runtime_error", "timeout")


def contains_pairs(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str = "text") -> DataFrame:
    """(doc_id, item_id) where a document's text contains an item's text.

    Items are dealt by their hash into blocks of about ``CONTAINS_CHARS`` characters; each block
    is an Aho-Corasick automaton that reads every text once, so the work doesn't depend on the
    number of items in a block, no pair is made unless it matches, and no key can be hot. A
    set of items larger than a block takes one more pass a block. Items of equal text all match.
    Null texts hold nothing, and empty items are in no document.
    """
    few = items.where(F.length(text) > 0).select(F.col(item_id), F.col(text).alias("_item"))
    chars = few.agg(F.sum(F.length("_item"))).first()[0] or 0
    blocks = max(1, -(-chars // CONTAINS_CHARS))
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    schema = f"`{doc_id}` {kind(docs, doc_id)}, `{item_id}` {kind(items, item_id)}"
    slim, out = docs.select(doc_id, F.col(text).cast("string").alias("_text")), None
    for k in range(blocks):
        part = few.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == k).toArrow()
        found = slim.mapInArrow(_search(part.column(0).combine_chunks(), part.column(1).to_pylist(), [doc_id, item_id]), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _search(ids: pa.Array, texts: list[str], names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pass of one block of items over batches of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same: dict[str, list[int]] = {}
        for n, t in enumerate(texts):
            same.setdefault(t, []).append(n)
        automaton = ahocorasick.Automaton()
        for t, members in same.items():
            automaton.add_word(t, members)
        if same:
            automaton.make_automaton()
        for batch in batches:
            rows, found = [], []
            for r, t in enumerate(batch.column(1) if same else ()):
                hit = {members[0]: members for _, members in automaton.iter(t.as_py() or "")}
                for members in hit.values():
                    rows += [r] * len(members)
                    found += members
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), ids.take(pa.array(found, pa.int64()))], names)

    return run


def feedback_reason(keys: Column, status: Column, passed: Column, total: Column, pass_rate: Column, failing_input: Column) -> Column:
    """The first rule that a public feedback breaks, else null."""
    return ordered_reason(
        ("invalid_keys", ~(F.array_sort(keys) == F.array(*map(F.lit, FEEDBACK_KEYS)))),
        ("invalid_status", F.coalesce(~status.isin(*STATUSES), F.lit(True))),
        ("invalid_counts", F.coalesce((total < 0) | (passed < 0) | (passed > total), F.lit(True))),
        ("invalid_pass_rate", F.coalesce(F.abs(pass_rate - F.when(total > 0, passed / total).otherwise(0.0)) > 1e-12, F.lit(True))),
        ("accepted_mismatch", (status == "accepted") != ((passed == total) & (total > 0))),
        ("accepted_with_input", (status == "accepted") & failing_input.isNotNull()),
    )


def project_feedback(grade: DataFrame, keep: list[str]) -> DataFrame:
    """Only the public fields of a grade (and the key columns ``keep``)."""
    return grade.select(*keep, *FEEDBACK_KEYS)


def leaks(content: Column, role: Column, markers: tuple[str, ...] = INTERNAL_MARKERS) -> Column:
    """Whether a message that isn't a tool's shows an internal marker."""
    shown = F.exists(F.array(*map(F.lit, markers)), lambda m: F.contains(content, m))
    return (role != "tool") & F.coalesce(shown, F.lit(False))


def split_contaminated(split: Column) -> Column:
    """Whether a record names a split other than train."""
    return F.coalesce(~F.lower(strip(split)).isin("", "train"), F.lit(False))


def candidate_usable(tests: Column, solutions: Column, least: int = 1, most: int = 60, shortest: int = 10, longest: int = 20000) -> Column:
    """A record worth executing: number of tests in range and any solution of a usable length."""
    return F.size(tests).between(least, most) & F.exists(solutions, lambda s: F.length(s).between(shortest, longest))


def partial_failure(pass_rate: Column, stable: Column) -> Column:
    return (pass_rate > 0) & (pass_rate < 1) & stable


def loss_mask_reason(input_ids: Column, attention: Column, labels: Column, spans: Column) -> Column:
    """The first rule that a token row breaks, else null.

    Lengths are equal, something is supervised, attention is all ones, labels are -100 or the
    id, spans lie inside the row in order, and a span is supervised exactly if it belongs to
    the assistant and is trainable.
    """
    n = F.size(input_ids)
    pairs = F.arrays_zip(input_ids.alias("i"), labels.alias("l"))
    on = lambda s: (s["role"] == "assistant") & s["trainable"]
    part = lambda s: F.slice(labels, s["start"] + 1, s["end"] - s["start"])
    wrong = lambda s: F.when(on(s), ~F.exists(part(s), lambda x: x != -100)).otherwise(F.exists(part(s), lambda x: x != -100))
    return ordered_reason(
        ("length_mismatch", (F.size(attention) != n) | (F.size(labels) != n)),
        ("no_label", ~F.exists(labels, lambda x: x != -100)),
        ("attention_not_one", F.exists(attention, lambda x: x != 1)),
        ("label_differs", F.exists(pairs, lambda p: (p["l"] != -100) & (p["l"] != p["i"]))),
        ("span_bounds", F.exists(spans, lambda s: (s["start"] < 0) | (s["end"] < s["start"]) | (s["end"] > n))),
        ("span_supervision", F.exists(spans, lambda s: (s["end"] > s["start"]) & wrong(s))),
    )
