"""Scores of samples for selection, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Exception names that say clearly what went wrong.
CLEAR_ERRORS = (
    "indexerror", "valueerror", "typeerror", "runtimeerror",
    "attributeerror", "keyerror", "zerodivisionerror", "nameerror",
    "assertionerror", "recursionerror", "stoperror", "overflowerror",
    "syntaxerror", "importerror",
)
#: Statuses of a run that was cut off.
CUT_OFF = ("timeout", "output_limit", "output_limit_exceeded")
#: Characters of error output from which on a clear error isn't crisp any more.
LONG_STDERR = 2000


def observation_score(status: Column, truncated: Column, exit_code: Column, error: Column, stderr: Column) -> Column:
    """What an observation says about a run, -2 to 1; 0 where there is none (all null)."""
    text = lambda c: F.lower(F.coalesce(c, F.lit("")))
    clear = text(error).rlike("|".join(CLEAR_ERRORS)) | text(stderr).rlike("|".join(CLEAR_ERRORS))
    crisp = F.length(F.coalesce(stderr, F.lit(""))) < LONG_STDERR
    failed = (text(status) == "runtime_error") | F.coalesce(exit_code != 0, F.lit(False))
    return (
        F.when(F.coalesce(truncated, F.lit(False)), -2)
        .when(text(status) == "ok", 1)
        .when(text(status).isin(*CUT_OFF), -1)
        .when(failed & clear & crisp, 1)
        .otherwise(0)
    )


def selection_score(tool: Column, state: Column, code_tokens: Column, difficulty: Column, style: Column, observed: Column) -> Column:
    """The score by which samples of a state are ranked; ``style`` is the penalty of the code,
    ``observed`` the score of the observation before the target."""
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    first = state == "problem_submit"
    return (
        points(tool == "run_candidate", 3)
        + points(state == "second_failure_run", 2)
        + points(first, 1)
        + points(code_tokens < 500, 1)
        - points(code_tokens > 1000, 3)
        - points(difficulty == "competition", 1)
        + F.when(first, -style).otherwise(observed)
    ).cast("double")
