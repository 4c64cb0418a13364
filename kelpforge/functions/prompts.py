"""Texts of states, as columns, and their parsing back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The headings between the parts of a state's text.
CANDIDATE, FEEDBACK, NO_FEEDBACK = "Current candidate:", "Previous submit result:", "No grader feedback is available."


def problem_text(question: Column, starter: Column, io_mode: Column, fn_name: Column, note: Column) -> Column:
    """The problem as a user's message."""
    code = F.when(F.coalesce(starter, F.lit("")) == "", "(none)").otherwise(starter)
    name = F.when(fn_name.isNotNull(), F.concat(F.lit("\nFunction name: "), fn_name)).otherwise("")
    return F.concat(F.lit("Problem:\n"), question, F.lit("\n\nStarter code:\n"), code, F.lit("\n\nI/O mode: "), io_mode, name, F.lit("\nInput convention: "), F.coalesce(note, F.lit("")))


def with_candidate(problem: Column, candidate: Column, feedback: Column | None = None) -> Column:
    """The problem with a candidate, and the feedback (JSON) on it or that there is none."""
    shown = F.concat(problem, F.lit(f"\n\n{CANDIDATE}\n```python\n"), candidate, F.lit("\n```\n\n"))
    return F.concat(shown, F.lit(NO_FEEDBACK)) if feedback is None else F.concat(shown, F.lit(f"{FEEDBACK}\n"), feedback)


def split_state(text: Column) -> tuple[Column, Column, Column]:
    """(problem, candidate, feedback) of a state's text; null where a part is missing."""
    found = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    problem = F.substring_index(text, f"\n\n{CANDIDATE}", 1)
    return problem, F.concat(found(rf"(?s){CANDIDATE}\n```python\n(.*?)\n```"), F.lit("\n")), found(rf"(?s){FEEDBACK}\n(\{{.*\}})")


def append_observation(messages: Column, tool: Column, arguments: Column, observation: Column, trainable: Column) -> Column:
    """A history with a call and what it showed; ``messages`` have role, content, tool,
    arguments and trainable."""
    none = F.lit(None).cast("string")
    call = F.struct(F.lit("assistant").alias("role"), F.lit("").alias("content"), tool.alias("tool"), arguments.alias("arguments"), trainable.alias("trainable"))
    shown = F.struct(F.lit("tool").alias("role"), observation.alias("content"), none.alias("tool"), F.lit(None).cast("map<string,string>").alias("arguments"), F.lit(False).alias("trainable"))
    return F.concat(messages, F.array(call, shown))


def contradictory_feedback(status: Column, passed: Column, total: Column) -> tuple[Column, Column]:
    """(status, passed) of the opposite outcome: to probe whether feedback is read at all."""
    good = status == "accepted"
    return F.when(good, "wrong_answer").otherwise("accepted"), F.when(good, F.greatest(total - 1, F.lit(0))).otherwise(total)
