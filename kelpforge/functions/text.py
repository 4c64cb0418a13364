"""Scalar text functions as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``strip`` and ``splitlines`` know it, beyond Java's \\s and line feeds.
_SPACES = (0x0B, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_BREAKS = (0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029)
SPACE = "[\\s" + "".join(f"\\u{c:04x}" for c in _SPACES) + "]"
_LINE = "\\r\\n|[" + "".join(f"\\u{c:04x}" for c in _BREAKS) + "]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(_col(c), rf"^{SPACE}+|{SPACE}+$", "")


def collapse_space(c: Column | str) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(_col(c), rf"{SPACE}+", " "))


def stdout_lines(c: Column | str) -> Column:
    """Lines of a program's output, as compared: ends stripped, each line right-stripped."""
    lines = F.split(strip(c), _LINE, -1)
    return F.when(strip(c) == "", F.array().cast("array<string>")).otherwise(F.transform(lines, lambda x: F.regexp_replace(x, rf"{SPACE}+$", "")))


def stdin_of(lines: Column | str) -> Column:
    """An array of input lines as one string with a final line feed."""
    return F.concat(F.array_join(_col(lines), "\n"), F.lit("\n"))


def token_estimate(c: Column | str) -> Column:
    """A third of the characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(_col(c)) / 3).cast("int"))


def style_penalty(c: Column | str) -> Column:
    """2 for three lambdas or more, 1 for fewer than 80 characters, 1 for fewer than 4 lines."""
    code = _col(c)
    few = lambda cond, n: F.when(cond, n).otherwise(0)
    return few(F.regexp_count(code, F.lit(r"\blambda\b")) >= 3, 2) + few(F.length(code) < 80, 1) + few(F.size(F.split(code, "\n", -1)) < 4, 1)


def numeric_id(c: Column | str) -> Column:
    """An id as an integer's digits if it is one, else trimmed."""
    return F.coalesce(F.trim(_col(c)).try_cast("bigint").cast("string"), F.trim(_col(c)))


def scrub_paths(c: Column | str, pattern: str = r"/tmp/[^\s\"':,)]+", with_: str = "<path>") -> Column:
    """Temporary paths in messages become a constant, so that two runs compare equal."""
    return F.regexp_replace(_col(c), pattern, with_)


def fenced_code(c: Column | str) -> Column:
    """The first fenced block of a text, or the whole text, trimmed."""
    got = F.regexp_extract(_col(c), r"(?s)```[a-zA-Z0-9_+-]*\n(.*?)```", 1)
    return F.when(got != "", got).otherwise(strip(c))


def available_tokens(window: int, total: int, cap: int, prompt: Column, used: Column) -> Column:
    """What may be generated next: the least of the three budgets, never below 0."""
    return F.greatest(F.lit(0), F.least(F.lit(window) - prompt, F.lit(total) - used, F.lit(cap)))


def ordered_reason(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds, else null: order decides what is reported."""
    out = F.lit(None).cast("string")
    for name, bad in reversed(rules):
        out = F.when(bad, F.lit(name)).otherwise(out)
    return out
