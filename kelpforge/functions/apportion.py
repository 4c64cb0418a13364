"""Exact integer apportionment. The tables have one cell per category, so they live on the driver."""

from __future__ import annotations

from collections.abc import Hashable, Mapping, Sequence
from fractions import Fraction
from math import floor


def largest_remainder(total: int, ratios: Mapping[Hashable, float], order: Sequence[Hashable]) -> dict[Hashable, int]:
    """``total`` split by ``ratios``: whole parts, then one more by largest remainder; ties go
    to the cell that is declared first."""
    if total < 0 or abs(sum(ratios[k] for k in order) - 1) > 1e-6:
        raise ValueError("a total of 0 or more and ratios that add up to 1 are needed")
    ideal = {k: total * ratios[k] for k in order}
    out = {k: int(ideal[k]) for k in order}
    rest = sorted(range(len(order)), key=lambda i: (out[order[i]] - ideal[order[i]], i))
    for i in rest[: total - sum(out.values())]:
        out[order[i]] += 1
    return out


def contingency(rows: Mapping[Hashable, int], cols: Mapping[Hashable, int], allowed: Mapping[tuple, float]) -> dict[tuple, int]:
    """An integer table with exact margins near the ideals ``allowed[(row, col)]``.

    Units go one at a time to the open cell (its row and column not full) with the greatest
    unmet ideal; ties go to the lexicographically greatest cell. Units that leave an unmet ideal
    of 0 or more come before all others, so where the whole parts of the ideals fit the margins
    they are placed at once, and the steps that remain are at most one a cell.
    """
    total = sum(rows.values())
    if total != sum(cols.values()):
        raise ValueError("the margins differ in sum")

    def left(placed: Mapping[tuple, int]) -> tuple[dict, dict]:
        row, col = dict(rows), dict(cols)
        for (r, c), n in placed.items():
            row[r] -= n
            col[c] -= n
        return row, col

    out = {c: max(0, floor(x)) for c, x in allowed.items()}
    row_left, col_left = left(out)
    if min([*row_left.values(), *col_left.values()], default=0) < 0:
        out = dict.fromkeys(allowed, 0)
        row_left, col_left = left(out)
    for _ in range(sum(row_left.values())):
        open_ = [c for c in allowed if row_left[c[0]] > 0 and col_left[c[1]] > 0]
        if not open_:
            raise ValueError("no cell is open; the margins can't be met")
        cell = max(open_, key=lambda c: (allowed[c] - out[c], c))
        out[cell] += 1
        row_left[cell[0]] -= 1
        col_left[cell[1]] -= 1
    return out


def split_table(group_sizes: Mapping[str, int], ratios: Mapping[str, float]) -> dict[tuple[str, str], int]:
    """Strata by pools: each stratum's rows over the pools, the pools' totals exact."""
    total = sum(group_sizes.values())
    pools = largest_remainder(total, ratios, list(ratios))
    ideal = {(g, p): n * ratios[p] for g, n in group_sizes.items() for p in ratios}
    return contingency(group_sizes, pools, ideal)


def proportional_fit(rows: Mapping[Hashable, float], cols: Mapping[Hashable, float], allowed: Sequence[tuple], rounds: int = 200) -> dict[tuple, float]:
    """Shares of the allowed cells whose margins approach ``rows`` and ``cols`` (IPF)."""
    cell = {c: rows[c[0]] * cols[c[1]] for c in allowed}
    for _ in range(rounds):
        for axis, target in ((0, rows), (1, cols)):
            sums: dict[Hashable, float] = {}
            for c, x in cell.items():
                sums[c[axis]] = sums.get(c[axis], 0.0) + x
            cell = {c: x * target[c[axis]] / sums[c[axis]] if sums[c[axis]] else 0.0 for c, x in cell.items()}
    norm = sum(cell.values())
    return {c: x / norm for c, x in cell.items()} if norm else cell


def cross_quotas(total: int, rows: Mapping[Hashable, float], cols: Mapping[Hashable, float], allowed: Sequence[tuple]) -> dict[tuple, int]:
    """Integer quotas of the allowed (row, col) cells by IPF and largest remainder."""
    return largest_remainder(total, proportional_fit(rows, cols, allowed), list(allowed))


def transportation(total: int, cells: Mapping[Hashable, int], third: Mapping[str, float]) -> dict[tuple, int]:
    """A third dimension with exact margins: cell quotas kept, totals of ``third`` exact."""
    margin = largest_remainder(total, third, list(third))
    share = {k: Fraction(n, total) if total else Fraction(0) for k, n in margin.items()}
    ideal = {(c, t): float(n * share[t]) for c, n in cells.items() for t in third}
    return contingency(cells, margin, ideal)


def sampling_quotas(total: int, cells: Mapping[tuple, int], difficulty: Mapping[str, float], bug_count: Mapping[int, float], multi: str = "multi") -> dict[tuple, int]:
    """Four dimensions: (origin, behaviour, difficulty, bug count); only cells of origin
    ``multi`` are split further by bug count, with exact margins, others have bug count 0."""
    three = transportation(total, cells, difficulty)
    flat = {(*c, d): n for (c, d), n in three.items()}
    many = {c: n for c, n in flat.items() if c[0] == multi}
    out = {(*c, 0): n for c, n in flat.items() if c[0] != multi}
    if many:
        by_bugs = transportation(sum(many.values()), many, bug_count)
        out |= {(*c, b): n for (c, b), n in by_bugs.items()}
    return out
