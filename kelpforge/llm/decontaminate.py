"""Benchmark decontamination by a generalised suffix automaton over words.

The automaton accepts every run of words of every item. A document's words are streamed
through it, so at each word the longest run that ends there and occurs in an item is known.
A run of ``window`` words or more contains a window of an item; items shorter than that are
one window as a whole and are found on the chain of suffix links. Words are hit when they lie
inside an occurrence.

The benchmark is a sealed set that is small next to the corpus, but its size is checked: the
items go to the executors in blocks of at most ``BLOCK_WORDS`` words, one pass of the stream
over each block.

Defined cases: null or empty texts have no words and no hits; items without words never
occur; items without an id hit words but aren't listed; repeated items count once; repeated
documents and null ids give a row each; an empty benchmark leaves all documents clean; other
columns are ignored (and kept by ``decontaminate``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpforge.llm.common import WORD_TABLE, chunks, map_arrow, with_text, words

WINDOW = 10
#: Words of items in one automaton (about 200 bytes each in a worker).
BLOCK_WORDS = 500_000


class ItemAutomaton:
    """The suffix automaton of a list of (item id, words)."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW):
        items = [(i, w) for i, w in items if w]
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.link, self.length = [-1], [0]
        edges: list[dict[int, int]] = [{}]
        coded = [(i, [self.vocab.setdefault(x, len(self.vocab)) for x in w]) for i, w in items]
        for _, w in coded:
            last = 0
            for c in w:
                last = self._extend(edges, last, c)
        self.size = max(1, len(self.vocab))
        self.step = {s * self.size + c: t for s, e in enumerate(edges) for c, t in e.items()}
        self.least = min((min(window, len(w)) for _, w in coded), default=window)
        #: by state: items whose window of full width has its home there; whole short items
        self.full: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for i, w in coded:
            ids = {i} if i is not None else set()
            for j, (state, n) in enumerate(self.stream(w)):
                if n >= window:
                    self.full.setdefault(self.home(state), set()).update(ids)
                elif j == len(w) - 1 and len(w) < window:
                    self.short.setdefault(state, {}).setdefault(len(w), set()).update(ids)
        self.marked = [-1] * len(self.link)  # the nearest state up the links, itself included, with a short item
        for s in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.marked[s] = s if s in self.short else self.marked[self.link[s]] if s else -1

    def _extend(self, edges: list[dict[int, int]], last: int, c: int) -> int:
        """Adds word ``c`` after state ``last``; the state of the run that ends there."""

        def clone(p: int, q: int) -> int:
            new = len(edges)
            edges.append(dict(edges[q]))
            self.length.append(self.length[p] + 1)
            self.link.append(self.link[q])
            self.link[q] = new
            while p >= 0 and edges[p].get(c) == q:
                edges[p][c] = new
                p = self.link[p]
            return new

        if (q := edges[last].get(c)) is not None:
            return q if self.length[q] == self.length[last] + 1 else clone(last, q)
        new = len(edges)
        edges.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = edges[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else clone(p, q)
        return new

    def home(self, state: int) -> int:
        """The state of the last ``window`` words of a longer run that ends in ``state``."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def stream(self, codes: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest run of items that ends at each word; -1: in no item."""
        step, size, state, n = self.step, self.size, 0, 0
        for c in codes:
            if c < 0:
                state = n = 0
            else:
                while (to := step.get(state * size + c)) is None and state:
                    state = self.link[state]
                    n = self.length[state]
                state, n = (to, n + 1) if to is not None else (0, 0)
            yield state, n

    def hits(self, found: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """([first word, word after the last, longest run] of each merged span, items that occur)."""
        get = self.vocab.get
        codes = [get(w, -1) for w in found]
        spans: list[list[int]] = []
        items: set[str] = set()
        n, at = len(codes), 0
        while at < n:
            if codes[at] < 0:
                at += 1
                continue
            try:
                end = codes.index(-1, at)
            except ValueError:
                end = n
            if end - at >= self.least:  # runs of known words below that hold no window
                self._run(codes[at:end], at, spans, items)
            at = end
        return spans, items

    def _run(self, codes: list[int], base: int, spans: list[list[int]], items: set[str]) -> None:
        w = self.window
        for j, (state, n) in enumerate(self.stream(codes)):
            width = 0
            if n >= w:
                width = w
                items |= self.full[self.home(state)]
            if self.short:
                s = self.marked[state]
                while s >= 0:
                    for m, ids in self.short[s].items():
                        if m <= n:
                            width = max(width, m)
                            items |= ids
                    s = self.marked[self.link[s]] if s else -1
            if width:
                a, b = base + j + 1 - width, base + j + 1
                while spans and spans[-1][1] >= a and spans[-1][0] >= a:
                    n = max(n, spans.pop()[2])
                if spans and spans[-1][1] >= a:
                    spans[-1][1], spans[-1][2] = max(b, spans[-1][1]), max(spans[-1][2], n)
                else:
                    spans.append([a, b, n])


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[ItemAutomaton]:
    """Automata over the items, block by block; the items are read in order of their text."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).distinct()
    block, size = [], 0
    for r in rows.toLocalIterator():
        w = words(r["t"])
        if block and size + len(w) > BLOCK_WORDS:
            yield ItemAutomaton(block, window)
            block, size = [], 0
        block.append((r["i"], w))
        size += len(w)
    yield ItemAutomaton(block, window)


_SPANS = pa.list_(pa.struct([("start_word", pa.int64()), ("end_word", pa.int64()), ("longest", pa.int64())]))
_HITS = {"_spans": "array<struct<start_word:long,end_word:long,longest:long>>", "_items": "array<string>", "_n_words": "long"}


def with_hits(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with, for each row's own text, merged hit spans with their longest runs, item ids
    and number of words, as columns ``_spans``, ``_items`` and ``_n_words``: one pass a block of items."""
    spark, names = docs.sparkSession, docs.columns
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema} | _HITS
    schema = ", ".join(f"`{n.replace('`', '``')}` {k}" for n, k in kinds.items())

    def through(automaton, batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        auto = automaton.value
        for b in chunks(batches, text_col):
            col = lambda name: b.column(b.schema.get_field_index(name)).to_pylist()  # noqa: E731, B023
            before = [([], [])] * b.num_rows if first else zip(col("_spans"), col("_items"))
            spans, items, counts = [], [], []
            for t, (s, i) in zip(col(text_col), before):
                found = words(t)
                more, ids = auto.hits(found)
                spans.append(_merged([[x["start_word"], x["end_word"], x["longest"]] for x in s], more))
                items.append(sorted(ids | set(i)))
                counts.append(len(found))
            spans = [[dict(zip(("start_word", "end_word", "longest"), x)) for x in s] for s in spans]
            kept = [b.column(b.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string())), pa.array(counts, pa.int64())], list(kinds))

    out = docs
    for k, a in enumerate(_blocks(benchmark, item_id, item_text, window)):
        shared = spark.sparkContext.broadcast(a)

        def run(batches, shared=shared, first=k == 0):
            return through(shared, batches, first)

        out = map_arrow(out, run, schema)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, spans, items): merged hit spans with their longest runs, and item ids."""
    found = with_hits(with_text(docs, id_col, text_col), benchmark, "text", item_id, item_text, window)
    return found.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def _merged(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    if not a or not b:
        return a or b
    out: list[list[int]] = []
    for x in sorted(a + b):
        if out and x[0] <= out[-1][1]:
            out[-1] = [out[-1][0], max(out[-1][1], x[1]), max(out[-1][2], x[2])]
        else:
            out.append(x)
    return out


def contamination_report(found: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end_word"] - s["start_word"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_WORD = re.compile(rb"[^ ]+")


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.translate(WORD_TABLE))]
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done : at[a][0]])
        done = at[b - 1][1]
    return b"".join([*out, raw[done:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_run: int = WINDOW - 1, max_coverage: float = 0.0, window: int = WINDOW) -> DataFrame:
    """``docs`` without documents over a limit, other columns kept.

    A row goes when the part of its words that is hit exceeds ``max_coverage``. In those that
    stay, spans with a run of more than ``max_run`` words are cut out of the text. The default
    keeps clean documents only. Each row is judged by its own text, whatever its id: rows with a
    null or repeated id are treated like any other.
    """
    found = with_hits(docs, benchmark, text_col, window=window)
    n_hit = F.aggregate("_spans", F.lit(0.0), lambda acc, s: acc + s["end_word"] - s["start_word"])
    stay = found.where((F.size("_spans") == 0) | (n_hit <= F.lit(max_coverage) * F.col("_n_words")))
    names = docs.columns
    if max_coverage <= 0:
        return stay.select(*names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text_col)
            text = []
            for t, spans in zip(b.column(at).to_pylist(), b.column(b.schema.get_field_index("_spans")).to_pylist()):
                long = [(x["start_word"], x["end_word"]) for x in spans if x["longest"] > max_run]
                text.append(without_words(t, long) if long else t)
            cols = [pa.array(text, pa.string()) if n == text_col else b.column(b.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(cols, names)

    return map_arrow(stay.select(*names, "_spans"), cut, ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema))
