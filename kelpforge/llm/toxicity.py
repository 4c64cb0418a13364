"""A counterfactual-regularised toxicity classifier.

A linear model over the words and word beginnings that a text holds (presence, not counts).

1. Document frequencies of all features by label are counted over every labelled training
   row, as a distributed aggregate; those of a two-proportion statistic of ``min_z`` or more,
   the ``max_features`` largest, become the model's features, and identity terms always are.
2. A logistic regression is fitted on at most ``max_rows`` labelled rows (those of the least
   hash of their id, one row an id; each travels as a short list of feature numbers). In labelled texts that
   mention an identity term, the term is swapped for the others of its group, and squared
   differences of the logit between a text and its swapped copies are penalised. What a
   mention alone adds to the score is so held equal within a group, and a ridge term holds
   it near zero.
3. Every whole text is scored; the model is a bounded table of weights.

Only the text is an input of a score. Defined cases: null or empty texts score the model's
intercept; a document without label is scored alike; labels that contradict each other for
one id count as toxic; null labels are no labels; without any label of both kinds the score
is the smoothed share of toxic labels; repeated rows and null ids give a row each; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpforge.llm.common import BROADCAST_IDS, add_column, chunks, map_arrow, with_text, words

#: Identity terms in groups within which they are swapped.
IDENTITY_GROUPS = (
    "men women man woman male female".split(),
    "gay straight lesbian bisexual transgender queer heterosexual homosexual".split(),
    "muslim christian jewish hindu buddhist catholic atheist sikh".split(),
    "muslims christians jews hindus buddhists catholics atheists sikhs".split(),
    "black white asian latino hispanic african european american".split(),
    "immigrant immigrants refugee refugees native natives foreigner foreigners".split(),
    "old young elderly disabled blind deaf".split(),
)
_GROUP = {t.encode(): [x.encode() for x in g] for g in IDENTITY_GROUPS for t in g}
#: Lengths of word beginnings that are features, in bytes.
PREFIXES = (4, 5, 6)
#: Words whose features a worker remembers.
MEMO = 50_000


def features_of(word: bytes) -> list[bytes]:
    """The word, and its beginnings with a mark that no word holds."""
    return [word, *(word[:k] + b"*" for k in PREFIXES if len(word) > k)]


@dataclass
class ToxicityModel:
    """Weights by feature and an intercept."""

    weights: dict[bytes, float]
    bias: float
    _memo: dict[bytes, tuple[bytes, ...]] = field(default_factory=dict)

    def present(self, found: Iterable[bytes]) -> set[bytes]:
        """The model's features among words."""
        out: set[bytes] = set()
        memo, known = self._memo, self.weights
        for w in found:
            if (got := memo.get(w)) is None:
                got = tuple(f for f in features_of(w) if f in known)
                if len(memo) >= MEMO:
                    memo.clear()
                memo[w] = got
            if got:
                out.update(got)
        return out

    def score(self, text: str | None) -> float:
        z = self.bias + sum(sorted(self.weights[f] for f in self.present(set(words(text)))))
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "bias": self.bias, "_memo": {}}


def _counts(labelled: DataFrame) -> DataFrame:
    """(feature, toxic, clean): in how many labelled texts of each kind a feature occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            names = sorted(set(kinds[0]) | set(kinds[1]))
            got = pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), *(pa.array([kinds[k][f] for f in names], pa.int64()) for k in (1, 0))], ["feature", "toxic", "clean"])
            kinds[0].clear()
            kinds[1].clear()
            return got

        for b in chunks(batches):
            for t, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                seen = set()
                for w in set(words(t)):
                    seen.update(features_of(w))
                kinds[y].update(seen)
            if len(kinds[0]) + len(kinds[1]) > 150_000:
                yield out()
        yield out()

    return map_arrow(labelled.select("doc_id", "text", "toxic"), run, "feature binary, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _fit(rows: list[tuple[int, list[int]]], swaps: list[tuple[list[int], list[int]]], n: int, l2: float, swap_weight: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated gradient descent on the regularised log loss."""
    y = np.array([r[0] for r in rows], dtype=float)
    size = np.array([len(r[1]) for r in rows])
    idx = np.fromiter((i for r in rows for i in r[1]), dtype=np.int64, count=int(size.sum()))
    row = np.repeat(np.arange(len(rows)), size)
    s_size = np.array([len(a) + len(b) for a, b in swaps], dtype=np.int64)
    s_idx = np.fromiter((i for a, b in swaps for i in (*a, *b)), dtype=np.int64, count=int(s_size.sum()))
    s_sign = np.concatenate([np.r_[np.ones(len(a)), -np.ones(len(b))] for a, b in swaps]) if swaps else np.zeros(0)
    s_row = np.repeat(np.arange(len(swaps)), s_size)
    w, b = np.zeros(n), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    m, v, mb, vb = np.zeros(n), np.zeros(n), 0.0, 0.0
    for t in range(1, steps + 1):
        z = b + np.bincount(row, weights=w[idx], minlength=len(rows))
        r = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y) / len(y)
        g = np.bincount(idx, weights=r[row], minlength=n) + l2 * w
        if swaps:  # d/dw of the mean squared change of the logit
            d = np.bincount(s_row, weights=s_sign * w[s_idx], minlength=len(swaps))
            g += swap_weight * 2 / len(swaps) * np.bincount(s_idx, weights=s_sign * d[s_row], minlength=n)
        gb = r.sum()
        rate = 0.1 * (1 - t / (steps + 1))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, b


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4: no label of these is learnt."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_features: int = 4096, max_rows: int = 20_000, min_df: int = 4, min_z: float = 4.5, ridge: float = 0.3, swap_weight: float = 1.0) -> ToxicityModel:
    """The model, from labelled rows that aren't held out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = known.where(~held_out())
    small = known.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    labelled = with_text(docs, id_col, text_col).join(F.broadcast(known) if small else known, "doc_id")
    total = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = total.get(1, 0), total.get(0, 0)
    if not pos or not neg:
        return ToxicityModel({}, float(np.log((pos + 0.5) / (neg + 0.5))))
    p = (F.col("toxic") + F.col("clean")) / F.lit(float(pos + neg))
    z = (F.col("toxic") / F.lit(float(pos)) - F.col("clean") / F.lit(float(neg))) / F.sqrt(p * (1.0000001 - p) * (1 / pos + 1 / neg))
    top = _counts(labelled).where(F.col("toxic") + F.col("clean") >= min_df).select("feature", F.abs(z).alias("z")).where(F.col("z") >= min_z).orderBy(F.desc("z"), "feature").limit(max_features)
    names = [bytes(r["feature"]) for r in top.collect()]
    names += [f for f in sorted({x for t in _GROUP for x in features_of(t)}) if f not in set(names)]
    number = {f: i for i, f in enumerate(names)}
    pick = ToxicityModel(dict.fromkeys(names, 0.0), 0.0)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            x, gone, come = [], [], []
            for t in b.column(1).to_pylist():
                found = set(words(t))
                mine = pick.present(found)
                x.append(sorted(number[f] for f in mine))
                a, c = [], []
                for term in sorted(found & _GROUP.keys()):
                    for other in _GROUP[term]:
                        if other not in found:
                            new = pick.present((found - {term}) | {other})
                            a.append(sorted(number[f] for f in mine - new))
                            c.append(sorted(number[f] for f in new - mine))
                gone.append(a)
                come.append(c)
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, lists), pa.array(gone, pa.list_(lists)), pa.array(come, pa.list_(lists))], ["doc_id", "toxic", "x", "gone", "come"])

    ids = labelled.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) if pos + neg > max_rows else None
    sample = labelled.join(F.broadcast(ids), "doc_id", "left_semi") if ids is not None else labelled
    rows = map_arrow(sample.select("doc_id", "text", "toxic"), numbers, "doc_id long, toxic int, x array<int>, gone array<array<int>>, come array<array<int>>")
    # one row an id, so that no more than ``max_rows`` rows reach the driver
    got = [r["r"] for r in rows.groupBy("doc_id").agg(F.min(F.struct("toxic", "x", "gone", "come")).alias("r")).collect()]
    got.sort(key=lambda r: (r["toxic"], r["x"]))
    w, b = _fit([(r["toxic"], r["x"]) for r in got], [s for r in got for s in zip(r["gone"], r["come"])], len(names), ridge / len(got), swap_weight)
    return ToxicityModel({f: float(w[i]) for f, i in number.items() if w[i]}, float(b))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in chunks(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.score(t) for t in b.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    return map_arrow(with_text(docs, id_col, text_col), run, "doc_id long, score double")


def with_toxicity(docs: DataFrame, model: ToxicityModel, name: str = "toxicity", text_col: str = "text") -> DataFrame:
    """``docs`` with the score of every text as a column, without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return add_column(docs, text_col, name, "double", pa.float64(), lambda: shared.value.score)
