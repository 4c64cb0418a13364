"""Candidate programs: references, edited programs with their proofs, and model outputs."""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelpforge.functions.pynorm import code_hash, complete_code
from kelpforge.operators.dedup import first_wins
from kelpforge.operators.execution.edits import apply_edits, compatible_sets, single_edits
from kelpforge.operators.execution.grade import stable_grades
from kelpforge.operators.execution.sandbox import Limits

_EDITED = "program_id string, problem_id string, code string, ord int, bug_count int, family string, mutation_set string, role string, parent string"


def _name(problem: str, *parts: object) -> str:
    return f"{problem}/" + "-".join(map(str, parts))


def single_mutants(references: DataFrame, families: Sequence[str] | None = None) -> DataFrame:
    """Every single edit of every reference (problem_id, code), in order of its place."""
    wanted = frozenset(families) if families else None

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                for k, e in enumerate(single_edits(r.code, wanted)):
                    rows.append((_name(r.problem_id, "s", k), r.problem_id, apply_edits(r.code, [e]), k, 1, e.family, e.key, "candidate", None))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _EDITED.split(", ")])

    return references.select(F.col("problem_id").cast("string"), "code").mapInPandas(work, _EDITED)


def bug_schedule(weights: Mapping[int, float], n: int, seed: int) -> list[int]:
    """One of each number of bugs, then a weighted choice with replacement."""
    first = sorted(weights)
    return [*first, *random.Random(seed).choices(first, [weights[k] for k in first], k=max(0, n - len(first)))][:n]


def multi_mutants(references: DataFrame, weights: Mapping[int, float] = {2: 0.6, 3: 0.3, 4: 0.1}, sets: int = 6, seed: int = 42) -> DataFrame:  # noqa: B006
    """Programs with several independent edits, and what their proof needs: for each set the
    mutant (role ``candidate``), every edit alone (``alone``) and every set with one edit left
    out (``survivor``), as rows that name their candidate."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                edits = single_edits(r.code)
                own = seed + int(hashlib.sha256(r.problem_id.encode()).hexdigest()[:8], 16)
                seen = set()
                for n, k in enumerate(bug_schedule(weights, sets, own)):
                    for chosen in compatible_sets(edits, k, own + n, 1):
                        keys = tuple(e.key for e in chosen)
                        if keys in seen:
                            continue
                        seen.add(keys)
                        name, digest = _name(r.problem_id, "m", n), hashlib.sha256("|".join(keys).encode()).hexdigest()
                        family = ",".join(sorted({e.family for e in chosen}))
                        rows.append((name, r.problem_id, apply_edits(r.code, chosen), n, k, family, digest, "candidate", name))
                        for i, e in enumerate(chosen):
                            rest = chosen[:i] + chosen[i + 1 :]
                            rows.append((f"{name}/a{i}", r.problem_id, apply_edits(r.code, [e]), n, 1, e.family, e.key, "alone", name))
                            rows.append((f"{name}/r{i}", r.problem_id, apply_edits(r.code, rest), n, k - 1, "", "", "survivor", name))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _EDITED.split(", ")])

    return references.select(F.col("problem_id").cast("string"), "code").mapInPandas(work, _EDITED)


def _qualified(programs: DataFrame, graded: DataFrame, most: int) -> DataFrame:
    """Stable partial failures, one of each code, the first ``most`` of each problem."""
    hashed = F.pandas_udf(lambda s: s.map(code_hash), "string")
    good = programs.join(graded.where("stable AND pass_rate > 0 AND pass_rate < 1"), "program_id").withColumn("code_hash", hashed("code"))
    once = first_wins(good.withColumn("_o", F.struct("ord", "program_id")), ["problem_id", "code_hash"], "_o").drop("_o")
    rank = F.row_number().over(Window.partitionBy("problem_id").orderBy("ord", "program_id"))
    return once.withColumn("_r", rank).where(F.col("_r") <= most).drop("_r")


def graded_singles(references: DataFrame, cases: DataFrame, most: int = 3, limits: Limits = Limits()) -> DataFrame:
    """The first ``most`` single mutants of each problem that fail in part, the same way twice."""
    programs = single_mutants(references)
    return _qualified(programs, stable_grades(programs, cases, limits), most)


def graded_multis(references: DataFrame, cases: DataFrame, most: int = 3, limits: Limits = Limits()) -> DataFrame:
    """Multi mutants with evidence: every edit alone fails, so does every set with one left out."""
    programs = multi_mutants(references)
    graded = stable_grades(programs, cases, limits)
    proof = programs.join(graded.select("program_id", "status"), "program_id").groupBy("parent").agg(
        F.every(F.when(F.col("role") == "alone", F.col("status") != "accepted").otherwise(True)).alias("all_individually_harmful"),
        F.every(F.when(F.col("role") == "survivor", F.col("status") != "accepted").otherwise(True)).alias("survivor_check_passed"),
    )
    proven = proof.where("all_individually_harmful AND survivor_check_passed")
    return _qualified(programs.where("role = 'candidate'").join(proven, "parent"), graded, most)


def natural_candidates(outputs: DataFrame, cases: DataFrame, failures: int = 3, correct: int = 2, limits: Limits = Limits()) -> DataFrame:
    """Model outputs (problem_id, ord, raw) as programs, labelled correct, failure or discarded
    with a reason: no_code, duplicate, unstable, no_pass, or over the caps."""
    parsed = outputs.withColumn("code", F.pandas_udf(lambda s: s.map(complete_code), "string")("raw"))
    parsed = parsed.withColumn("program_id", F.concat_ws("/n", F.col("problem_id").cast("string"), F.col("ord").cast("string")))
    programs = parsed.where("code IS NOT NULL").withColumn("code_hash", F.pandas_udf(lambda s: s.map(code_hash), "string")("code"))
    once = programs.withColumn("_d", F.row_number().over(Window.partitionBy("problem_id", "code_hash").orderBy("ord")))
    graded = once.where("_d = 1").join(stable_grades(once.where("_d = 1"), cases, limits), "program_id")
    label = F.when(~F.col("stable"), "discarded").when(F.col("status") == "accepted", "correct").when(F.col("pass_rate") > 0, "failure").otherwise("discarded")
    why = F.when(~F.col("stable"), "unstable").when((F.col("status") != "accepted") & (F.col("pass_rate") == 0), "no_pass")
    labelled = graded.withColumn("label", label).withColumn("reason", why)
    rank = F.row_number().over(Window.partitionBy("problem_id", "label").orderBy("ord"))
    cap = F.when(F.col("label") == "failure", failures).when(F.col("label") == "correct", correct).otherwise(1 << 30)
    over = labelled.withColumn("_r", rank).withColumn("reason", F.when(F.col("_r") > cap, "over_cap").otherwise(F.col("reason"))).withColumn("label", F.when(F.col("_r") > cap, "discarded").otherwise(F.col("label")))
    cols = ["program_id", "problem_id", "ord", "code", "label", "reason"]
    none = lambda df, r: df.select("program_id", "problem_id", "ord", "code", F.lit("discarded").alias("label"), F.lit(r).alias("reason"))
    return over.select(*cols).unionByName(none(parsed.where("code IS NULL"), "no_code")).unionByName(none(once.where("_d > 1"), "duplicate"))
