"""Named queries over the driver's tables."""

from types import ModuleType


def load() -> ModuleType:
    """The catalogue with every module of queries imported."""
    from kelpforge.plans import catalog, q_code, q_data, q_dedup, q_eval, q_report, q_turns  # noqa: F401

    return catalog
