"""Language-model scores from a Brown class-based bigram model.

Tokens are runs of other characters than ASCII white space, A-Z lower-cased, and one end of
text. Counts of all tokens over all training texts are a table that grows with the corpus.

* The ``class_words`` most frequent words (the seeds) get one of ``n_classes`` classes by
  exchange clustering: each word in turn moves to the class that raises the likelihood of the
  class bigrams most, until no word moves.
* Every further word of ``least_count`` occurrences gets the class that its counts of seed
  classes before and after it make most likely; these counts are a table by word. Unless given,
  the number of classes is the cube root of the number of such words (48 at least), and ten
  seeds a class (1,500 at least): both grow with the corpus. The end of a text and the words
  below ``least_count`` are classes of their own.
* log10 P(text) = sum of log10 P(class | previous class) + log10 P(word | class), with class
  pairs counted over the classes of all words. Transitions are smoothed towards the classes'
  shares; a word of the rare class has (c + 0.1) / (N_rare + 0.1 (V_rare + 1)), unseen words
  included.

Scoring needs count and class of every token of every text. The ``head`` most frequent tokens
(a bounded table) are looked up where the text is read, so frequent tokens are never shuffled;
the remaining ones, none of which holds more than 1/head of all tokens, are joined with the
table of all words by token and put back at their places of the text's class sequence.

Defined cases: null or empty texts consist of the end alone; an empty training set gives
N = V = 0 and scores of log10(1); repeated rows and null ids give a row each (a null id is
trained on); ties in counts are ordered by token; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpforge.llm.common import LOWER_TABLE, chunks, map_arrow, with_text
from kelpforge.session import materialize

#: The end of a text; no word is empty.
END = b""
_ADD = 0.1


def tokens(text: str) -> list[bytes]:
    """Words, then the end."""
    return [*text.encode().translate(LOWER_TABLE).split(), END]


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by 10."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, n) over all texts of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in chunks(batches):
            for t in b.column(1).to_pylist():
                seen.update(tokens(t))
            if len(seen) > 300_000:
                yield _counted(seen, "token", pa.binary())
                seen.clear()
        yield _counted(seen, "token", pa.binary())

    return map_arrow(docs.select("doc_id", "text"), run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _counted(seen: Counter, name: str, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), kind), pa.array(list(seen.values()), pa.int64())], [name, "n"])


def bigram_counts(docs: DataFrame, number: dict[bytes, int], rare: int, bound: int) -> DataFrame:
    """(pair, n) of neighbouring class words; ``pair`` is first * (bound + 1) + second."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {**shared.value, END: bound}.get
        seen: Counter = Counter()
        for b in chunks(batches):
            words = [END]
            for t in b.column(1).to_pylist():  # the end of one text is the start of the next
                words += tokens(t)
            x = np.fromiter(map(get, words, repeat(rare)), dtype=np.int64, count=len(words))
            pair, n = np.unique(x[:-1] * (bound + 1) + x[1:], return_counts=True)
            seen.update(dict(zip(pair.tolist(), n.tolist())))
        yield _counted(seen, "pair", pa.int64())

    return map_arrow(docs.select("doc_id", "text"), run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def exchange(bigrams: np.ndarray, n_classes: int, sweeps: int = 20) -> np.ndarray:
    """Classes of words by exchange clustering. ``bigrams``: counts of word pairs; its last two
    rows and columns (rare words, the bound) keep classes of their own, the last two."""
    size = len(bigrams)
    v = size - 2
    k = min(n_classes, max(1, v))
    cls = np.r_[np.arange(v) % k, k, k + 1].astype(np.int64)
    one = np.zeros((size, k + 2))
    one[np.arange(size), cls] = 1
    right, left = bigrams @ one, bigrams.T @ one  # of each word: by the class after and before
    n = one.T @ right
    total = bigrams.sum(axis=1)
    own = one.T @ total
    f = lambda x: x * np.log(np.maximum(x, 1e-300))
    order = np.argsort(-total[:v], kind="stable")
    for _ in range(sweeps):
        moved = 0
        for w in order:
            a, self_n = cls[w], bigrams[w, w]
            r, lft = right[w].copy(), left[w].copy()
            r[a] -= self_n
            lft[a] -= self_n
            n[a] -= r  # take the word out of its class
            n[:, a] -= lft
            n[a, a] -= self_n
            own[a] -= total[w]
            rows = (f(n[:k] + r) - f(n[:k])).sum(axis=1)
            cols = (f(n[:, :k] + lft[:, None]) - f(n[:, :k])).sum(axis=0)
            d = np.arange(k)
            diag = n[d, d]
            fix = f(diag + r[:k] + lft[:k] + self_n) - f(diag + r[:k]) - f(diag + lft[:k]) + f(diag)
            gain = rows + cols + fix - 2 * (f(own[:k] + total[w]) - f(own[:k]))
            to = int(np.argmax(gain))
            if gain[to] <= gain[a] + 1e-9:
                to = int(a)
            n[to] += r
            n[:, to] += lft
            n[to, to] += self_n
            own[to] += total[w]
            if to != a:
                cls[w] = to
                right[:, a] -= bigrams[:, w]
                right[:, to] += bigrams[:, w]
                left[:, a] -= bigrams[w]
                left[:, to] += bigrams[w]
                moved += 1
        if not moved:
            break
    return cls


@dataclass
class ClassModel:
    """What a worker needs: counts and classes of the head, log10 tables by class."""

    total: int
    distinct: int
    head: dict[bytes, int]
    classes: np.ndarray
    transition: np.ndarray
    emission: np.ndarray

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + _ADD) / (self.total + _ADD * (self.distinct + 1)))


def class_contexts(docs: DataFrame, number: dict[bytes, int], code: np.ndarray) -> DataFrame:
    """(token, f, n): of each word outside ``number``, how often it stands between which classes;
    ``f`` is the class before * number of classes + the class after. Partitioned by token."""
    shared = docs.sparkSession.sparkContext.broadcast((number, code))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds, cls = shared.value
        rare, bound, width = len(seeds), len(seeds) + 1, int(cls.max()) + 1
        get = {**seeds, END: bound}.get
        seen: Counter = Counter()  # by the token's number in ``own`` * width^2 + f
        own: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            key = np.fromiter(seen, dtype=np.int64, count=len(seen))
            token = pa.array(list(own), pa.binary()).take(pa.array(key // width**2))
            got = pa.RecordBatch.from_arrays([token, pa.array(key % width**2), pa.array(list(seen.values()), pa.int64())], ["token", "f", "n"])
            seen.clear()
            own.clear()
            return got

        for b in chunks(batches):
            words = [END]
            for t in b.column(1).to_pylist():
                words += tokens(t)
            x = np.fromiter(map(get, words, repeat(rare)), dtype=np.int64, count=len(words))
            at = np.flatnonzero(x == rare)
            f = cls[x[at - 1]] * width + cls[x[at + 1]]  # a text's end stands on either side
            number = np.fromiter((own.setdefault(words[i], len(own)) for i in at.tolist()), dtype=np.int64, count=len(at))
            seen.update((number * width**2 + f).tolist())
            if len(seen) > 300_000:
                yield flush()
        yield flush()

    return map_arrow(docs.select("doc_id", "text"), run, "token binary, f long, n long").repartition("token").groupBy("token", "f").agg(F.sum("n").alias("n"))


def further_classes(contexts: DataFrame, counts: DataFrame, transition: np.ndarray, own: np.ndarray, least_count: int) -> DataFrame:
    """(token, cls) of the words of ``contexts`` that occur ``least_count`` times: the class that
    makes the word and its neighbours' classes most likely."""
    width, k = len(transition), len(transition) - 2
    before, after, size = transition[:, :k].copy(), transition[:k].T.copy(), np.log10(np.maximum(own[:k], 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column(1)
            at = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            f, n = (np.asarray(lists.flatten().field(c)) for c in ("f", "n"))
            cls = []
            for i, j in zip(at[:-1], at[1:]):
                x, c = f[i:j], n[i:j].astype(float)
                cls.append(int(np.argmax(c @ (before[x // width] + after[x % width] - size))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cls, pa.int32())], ["token", "cls"])

    often = counts.where(F.col("n") >= least_count).select("token")
    lists = contexts.join(often, "token").groupBy("token").agg(F.collect_list(F.struct("f", "n")).alias("c"))
    return map_arrow(lists, run, "token binary, cls int")


def smoothed(n: np.ndarray) -> np.ndarray:
    """log10 P(class | previous class) from the counts of class pairs."""
    share = (n.sum(axis=0) + 1) / (n.sum() + n.shape[0])
    return np.log10((n + 5 * share) / (n.sum(axis=1, keepdims=True) + 5))


def fit_classes(docs: DataFrame, class_words: int | None = None, n_classes: int | None = None, head: int = 150_000, least_count: int = 3) -> tuple[ClassModel, DataFrame]:
    """(model without transitions, table of token, n, cls) from training rows (doc_id, text)."""
    counts = materialize(token_counts(docs), "tokens")
    n_all, v_all, v_often = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("token"), F.count(F.when(F.col("n") >= least_count, 1))).first()
    n_classes = n_classes or max(48, ceil(v_often ** (1 / 3)))
    class_words = class_words or max(1500, 10 * n_classes)
    seeds = [bytes(r["token"]) for r in counts.where(F.col("token") != F.lit(bytearray(END))).orderBy(F.desc("n"), "token").limit(min(class_words, head)).collect()]
    number = {t: i for i, t in enumerate(seeds)}
    rare, bound = len(seeds), len(seeds) + 1
    bigrams = np.zeros((bound + 1, bound + 1))
    got = bigram_counts(docs, number, rare, bound).toArrow()
    pair = np.asarray(got.column("pair"))
    bigrams[pair // (bound + 1), pair % (bound + 1)] = np.asarray(got.column("n"))
    cls = exchange(bigrams, n_classes)
    one = np.zeros((bound + 1, cls.max() + 1))
    one[np.arange(bound + 1), cls] = 1
    n = one.T @ bigrams @ one
    k = len(n) - 2
    more = further_classes(class_contexts(docs, number, cls), counts, smoothed(n), n.sum(axis=1), least_count)
    given = counts.sparkSession.createDataFrame([(bytearray(t), int(cls[i])) for t, i in number.items()] + [(bytearray(END), k + 1)], "token binary, cls int")
    classed = materialize(counts.join(more.unionByName(given), "token", "left").select("token", "n", F.coalesce("cls", F.lit(k)).cast("int").alias("cls")), "classed")
    top = classed.orderBy(F.desc("n"), "token").limit(head).collect()
    own = np.zeros(k + 2)
    own_rows = classed.groupBy("cls").agg(F.sum("n").alias("n"), F.count("token").alias("v")).collect()
    for r in own_rows:
        own[r["cls"]] = r["n"] + (_ADD * (r["v"] + 1) if r["cls"] == k else 0)
    own[k] = own[k] or _ADD
    model = ClassModel(int(n_all), int(v_all), {bytes(r["token"]): r["n"] for r in top}, np.array([r["cls"] for r in top] + [-1], dtype=np.int16), np.zeros((k + 2, k + 2)), -np.log10(np.maximum(own, _ADD)))
    return model, classed


def class_sequences(docs: DataFrame, model: ClassModel, classed: DataFrame) -> DataFrame:
    """Materialized, for each row of (doc_id, text): n_tokens, n_known, base, logs (log10 of the
    words' counts) and seq, the classes of all tokens as 16-bit numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rare, bound = len(model.transition) - 2, len(model.transition) - 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        row = TaskContext.get().partitionId() << 33
        place = {t: i for i, t in enumerate(m.head)}
        count = np.array(list(m.head.values()), dtype=float)
        base_logs = np.r_[m.base(count), 0.0]
        logs = np.r_[np.log10(count + np.where(m.classes[:-1] == rare, _ADD, 0.0)), 0.0]
        get = place.get
        for b in chunks(batches):
            out: dict[str, list] = {k: [] for k in ("row", "n_tokens", "n_known", "base", "logs", "seq", "tail")}
            for t in b.column(1).to_pylist():
                toks = tokens(t)
                at = np.fromiter(map(get, toks, repeat(-1)), dtype=np.int64, count=len(toks))  # -1: the last entry of each table
                seq = m.classes[at]
                if at[-1] < 0:  # the end isn't trained on or no part of the head
                    seq[-1] = bound
                rest: dict[bytes, list[int]] = {}
                for i in np.flatnonzero(at < 0).tolist():
                    rest.setdefault(toks[i], []).append(i)
                tail = [{"token": w, "at": n} for w, n in rest.items()]
                for k, x in zip(out, (row, len(toks), int((at >= 0).sum()), float(base_logs[at].sum()), float(logs[at].sum()), seq.tobytes(), tail)):
                    out[k].append(x)
                row += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.struct([("token", pa.binary()), ("at", pa.list_(pa.int32()))])))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, k) for x, k in zip(out.values(), kinds))], ["doc_id", *out])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = ["doc_id", "n_tokens", "n_known", "base", "logs", "seq"]
        for b in batches:
            cols = {c: b.column(i).to_pylist() for i, c in enumerate(names)}
            for r, more in enumerate(b.column(6)):
                if not more.is_valid:
                    continue
                s = more.values
                at = s.field("at")
                size = np.diff(np.asarray(at.offsets))
                n, cls = (np.repeat(np.asarray(s.field(c)), size) for c in ("n", "cls"))
                seq = np.frombuffer(cols["seq"][r], dtype=np.int16).copy()
                where = np.asarray(at.flatten())
                seq[where] = cls
                cols["seq"][r] = seq.tobytes()
                cols["n_known"][r] += int((n > 0).sum())
                cols["base"][r] += float(m.base(n).sum())
                cols["logs"][r] += float(np.log10(np.where(cls == rare, n + _ADD, np.maximum(n, 1))).sum())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(cols[c], k) for c, k in zip(names, kinds)], names)

    here = materialize(map_arrow(docs.select("doc_id", "text"), read, "doc_id long, row long, n_tokens long, n_known long, base double, logs double, seq binary, tail array<struct<token:binary,at:array<int>>>"), "scored")
    tail = here.select("row", F.explode("tail").alias("t")).select("row", "t.token", "t.at")
    # an end that the training rows don't hold stays a class of its own
    kind = F.when(F.col("token") == F.lit(bytearray(END)), bound).otherwise(F.coalesce("cls", F.lit(rare))).cast("int")
    found = tail.join(classed, "token", "left").groupBy("row").agg(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), kind.alias("cls"))).alias("more"))
    whole = here.drop("tail").join(found, "row", "left").select("doc_id", "n_tokens", "n_known", "base", "logs", "seq", "more")
    return materialize(map_arrow(whole, fill, "doc_id long, n_tokens long, n_known long, base double, logs double, seq binary"), "sequences")


def class_pairs(sequences: DataFrame, width: int) -> np.ndarray:
    """How often each class follows each other class, ends of texts included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(width * width, dtype=np.int64)
        for b in batches:
            x = np.frombuffer(b"".join(b.column(0).to_pylist()), dtype=np.int16).astype(np.int64)
            if len(x):  # a text ends with the bound, which starts the next
                n += np.bincount(np.r_[width - 1, x[:-1]] * width + x, minlength=width * width)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["pair", "n"])

    got = map_arrow(sequences.select("seq"), run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(width * width)
    n[np.asarray(got.column("pair"))] = np.asarray(got.column("n"))
    return n.reshape(width, width)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_words: int | None = None, n_classes: int | None = None, head: int = 150_000, least_count: int = 3) -> DataFrame:
    """Fits on the rows that aren't held out and scores all: doc_id, held_out and the scores."""
    plain = with_text(docs, id_col, text_col)
    model, classed = fit_classes(plain.where(~held_out()), class_words, n_classes, head, least_count)
    seqs = class_sequences(plain, model, classed)
    transition, emission = smoothed(class_pairs(seqs.where(~held_out()), len(model.transition))), model.emission

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = []
            for s in b.column(5).to_pylist():
                x = np.frombuffer(s, dtype=np.int16)
                score.append(float(transition[-1, x[0]] + transition[x[:-1], x[1:]].sum() + emission[x].sum()))
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(score, pa.float64())], ["doc_id", "n_tokens", "n_known", "base", "logs", "classes"])

    out = map_arrow(seqs, run, "doc_id long, n_tokens long, n_known long, base double, logs double, classes double")
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), (F.col("logs") + F.col("classes")).alias("score"))
