"""Lists and ratios given as text on a command line."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

T = TypeVar("T")


def listed(text: str, kind: Callable[[str], T] = str) -> tuple[T, ...]:
    """The non-empty parts between commas, white space around them removed."""
    return tuple(kind(p) for p in map(str.strip, text.split(",")) if p)


def named_ratios(text: str, names: Sequence[str]) -> dict[str, float]:
    """One number for each name, in the order of the names."""
    values = listed(text, float)
    if len(values) != len(names):
        raise ValueError(f"{len(names)} numbers are needed, for {', '.join(names)}")
    return dict(zip(names, values))
