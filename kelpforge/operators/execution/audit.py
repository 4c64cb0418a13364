"""Audits of repairs and of what supports a multi-edit failure."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpforge.functions.pynorm import changed_lines, token_edit_ratio
from kelpforge.operators.execution.edits import apply_edits, single_edits
from kelpforge.operators.execution.grade import grade_distinct, grades, run_cases
from kelpforge.operators.execution.sandbox import Limits


def repair_pairs(pairs: DataFrame, cases: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Grades on both sides of repairs (pair_id, problem_id, old, new), each program run once,
    with the size of the change."""
    old = pairs.select(F.concat_ws("|", "pair_id", F.lit("old")).alias("program_id"), "problem_id", F.col("old").alias("code"))
    new = pairs.select(F.concat_ws("|", "pair_id", F.lit("new")).alias("program_id"), "problem_id", F.col("new").alias("code"))
    g = grade_distinct(old.unionByName(new), cases, limits).select("program_id", "pass_rate", "status")
    side = lambda s: g.where(F.endswith("program_id", F.lit(f"|{s}"))).select(F.regexp_replace("program_id", rf"\|{s}$", "").alias("pair_id"), F.col("pass_rate").alias(f"{s}_rate"), F.col("status").alias(f"{s}_status"))
    lines = F.pandas_udf(lambda a, b: pd.Series([changed_lines(x, y) for x, y in zip(a, b)]), "int")
    ratio = F.pandas_udf(lambda a, b: pd.Series([token_edit_ratio(x, y) for x, y in zip(a, b)]), "double")
    both = pairs.withColumn("pair_id", F.col("pair_id").cast("string")).join(side("old"), "pair_id").join(side("new"), "pair_id")
    delta = F.col("new_rate") - F.col("old_rate")
    outcome = F.when(F.col("new_status") == "accepted", "solved").when(delta > 1e-12, "improved").when(delta < -1e-12, "regressed").otherwise("unchanged")
    return both.select("pair_id", "old_rate", "new_rate", "old_status", "new_status", delta.alias("delta"), outcome.alias("outcome"), lines("old", "new").alias("changed_lines"), ratio("old", "new").alias("edit_ratio"))


def undo_lattice(mutants: DataFrame) -> DataFrame:
    """(program_id, problem_id, parent, undone, code): every mutant with every subset of its
    edits undone. ``mutants``: (mutant_id, problem_id, reference, keys of its edits)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                by_key = {e.key: e for e in single_edits(r.reference)}
                edits = [by_key[k] for k in r.keys]
                for n in range(len(edits) + 1):
                    for undo in combinations(range(len(edits)), n):
                        left = [e for i, e in enumerate(edits) if i not in undo]
                        rows.append((f"{r.mutant_id}~{','.join(map(str, undo))}", r.problem_id, r.mutant_id, list(undo), apply_edits(r.reference, left)))
            yield pd.DataFrame(rows, columns=["program_id", "problem_id", "parent", "undone", "code"])

    return mutants.select("mutant_id", "problem_id", "reference", "keys").mapInPandas(work, "program_id string, problem_id string, parent string, undone array<int>, code string")


def causal_support(mutants: DataFrame, cases: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """For each mutant: the smallest number of undone edits that improves it and that solves it,
    the best partial undo (largest gain, then fewest edits, then first), and a category."""
    programs = undo_lattice(mutants)
    g = programs.join(grades(run_cases(programs, cases, limits=limits)).select("program_id", "pass_rate", "status"), "program_id")
    base = g.where(F.size("undone") == 0).select("parent", F.col("pass_rate").alias("base"))
    d = g.join(base, "parent").withColumn("gain", F.col("pass_rate") - F.col("base")).withColumn("k", F.size("undone"))
    full = mutants.select(F.col("mutant_id").alias("parent"), F.size("keys").alias("edits"))
    out = d.join(full, "parent").groupBy("parent").agg(
        F.first("edits").alias("edits"),
        F.min(F.when(F.col("gain") > 1e-12, F.col("k"))).alias("least_improving"),
        F.min(F.when(F.col("status") == "accepted", F.col("k"))).alias("least_solving"),
        F.min(F.when((F.col("k") > 0) & (F.col("k") < F.col("edits")), F.struct((-F.col("gain")).alias("g"), "k", "undone"))).alias("b"),
    )
    category = F.when(F.col("least_solving") < F.col("edits"), "subset_solves").when(F.col("least_improving") == 1, "single_improves").when(F.col("least_improving") < F.col("edits"), "subset_improves").otherwise("only_all")
    return out.select(F.col("parent").alias("mutant_id"), "edits", "least_improving", "least_solving", F.col("b.undone").alias("best_undo"), (-F.col("b.g")).alias("best_gain"), category.alias("category"))
