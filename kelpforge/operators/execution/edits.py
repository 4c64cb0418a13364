"""Single and combined edits of a program's syntax tree.

An edit names a place in the tree (a path of fields and indices) and the node to put there.
Rules are small generators registered by node type; the tree is rebuilt along the path only.
"""

from __future__ import annotations

import ast
import copy
import hashlib
import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass

Path = tuple

#: What each operator and function is swapped for.
COMPARE = {ast.Lt: ast.LtE, ast.LtE: ast.Lt, ast.Gt: ast.GtE, ast.GtE: ast.Gt, ast.Eq: ast.NotEq, ast.NotEq: ast.Eq}
ARITHMETIC = {ast.Add: ast.Sub, ast.Sub: ast.Add, ast.Mult: ast.FloorDiv, ast.FloorDiv: ast.Mult, ast.Mod: ast.Add}
AGGREGATES = {"min": "max", "max": "min", "sum": "len", "len": "sum"}
#: The rules with their families.
FAMILIES = {
    "compare_boundary": "comparator",
    "binary_operator_swap": "arithmetic",
    "boolean_operator_swap": "boolean",
    "remove_condition_negation": "boolean",
    "boundary_constant_offset": "boundary_constant",
    "range_stop_offset": "range_bound",
    "reverse_loop_iterator": "loop_direction",
    "index_offset": "index_offset",
    "adjacent_update_target": "update_target",
    "aggregation_swap": "aggregation",
    "initialization_offset": "initialization",
    "return_expression_offset": "return_expression",
    "join_separator_change": "input_output_handling",
}


@dataclass(frozen=True)
class Edit:
    """One edit: rule, place, statement around it, and both sides as source text."""

    rule: str
    path: Path
    statement: Path
    before: str
    after: str
    node: ast.AST

    @property
    def family(self) -> str:
        return FAMILIES[self.rule]

    @property
    def key(self) -> str:
        return hashlib.sha256(repr((self.path, self.rule, self.after)).encode()).hexdigest()


_Rule = Callable[[ast.AST], Iterator[tuple[str, Path, ast.AST, ast.AST]]]
_RULES: list[tuple[tuple[type, ...], _Rule]] = []


def _rule(*kinds: type) -> Callable[[_Rule], _Rule]:
    def keep(fn: _Rule) -> _Rule:
        _RULES.append((kinds, fn))
        return fn

    return keep


def _shift(node: ast.expr, by: int) -> ast.expr:
    return ast.BinOp(copy.deepcopy(node), ast.Add() if by > 0 else ast.Sub(), ast.Constant(abs(by)))


def _number(node: ast.AST, kinds: tuple[type, ...]) -> bool:
    return isinstance(node, ast.Constant) and isinstance(node.value, kinds) and not isinstance(node.value, bool)


def _called(node: ast.Call) -> str | None:
    return node.func.id if isinstance(node.func, ast.Name) else None


@_rule(ast.Compare)
def _compare(n):
    for i, op in enumerate(n.ops):
        if type(op) in COMPARE:
            yield "compare_boundary", ("ops", i), op, COMPARE[type(op)]()


@_rule(ast.BinOp)
def _arithmetic(n):
    if type(n.op) in ARITHMETIC:
        yield "binary_operator_swap", ("op",), n.op, ARITHMETIC[type(n.op)]()


@_rule(ast.BoolOp)
def _boolean(n):
    yield "boolean_operator_swap", ("op",), n.op, ast.Or() if isinstance(n.op, ast.And) else ast.And()


@_rule(ast.UnaryOp)
def _negation(n):
    if isinstance(n.op, ast.Not):
        yield "remove_condition_negation", (), n, n.operand


@_rule(ast.Constant)
def _constant(n):
    if _number(n, (int,)):
        for v in {0: (1,), 1: (0,)}.get(n.value, (n.value - 1, n.value + 1)):
            yield "boundary_constant_offset", (), n, ast.Constant(v)


@_rule(ast.Call)
def _range(n):
    if _called(n) == "range" and n.args:
        stop = min(1, len(n.args) - 1)
        for by in (-1, 1):
            yield "range_stop_offset", ("args", stop), n.args[stop], _shift(n.args[stop], by)
        if len(n.args) == 1:
            back = [_shift(n.args[0], -1), ast.Constant(0), ast.Constant(-1)]
            yield "reverse_loop_iterator", (), n, ast.Call(ast.Name("range", ast.Load()), back, [])


@_rule(ast.Subscript)
def _index(n):
    for by in (-1, 1):
        yield "index_offset", ("slice",), n.slice, _shift(n.slice, by)
    if isinstance(n.ctx, ast.Store):
        yield "adjacent_update_target", (), n, ast.Subscript(n.value, _shift(n.slice, 1), ast.Store())


@_rule(ast.Call)
def _aggregate(n):
    if _called(n) in AGGREGATES:
        yield "aggregation_swap", ("func",), n.func, ast.Name(AGGREGATES[_called(n)], ast.Load())


@_rule(ast.Assign, ast.AnnAssign)
def _initial(n):
    if n.value is not None and _number(n.value, (int, float)):
        yield "initialization_offset", ("value",), n.value, ast.Constant(n.value.value + 1)


@_rule(ast.Return)
def _returned(n):
    if n.value is not None:
        yield "return_expression_offset", ("value",), n.value, _shift(n.value, 1)


@_rule(ast.Call)
def _separator(n):
    f = n.func
    if isinstance(f, ast.Attribute) and f.attr == "join" and isinstance(f.value, ast.Constant) and isinstance(f.value.value, str):
        yield "join_separator_change", ("func", "value"), f.value, ast.Constant("" if f.value.value == " " else " ")


def _places(node: ast.AST, path: Path = (), statement: Path = ()) -> Iterator[tuple[ast.AST, Path, Path]]:
    """(node, its path, path of the statement around it), parents first, in source order."""
    if isinstance(node, ast.stmt):
        statement = path
    yield node, path, statement
    for name, value in ast.iter_fields(node):
        for i, child in enumerate(value) if isinstance(value, list) else [(None, value)]:
            if isinstance(child, ast.AST):
                yield from _places(child, (*path, name) if i is None else (*path, name, i), statement)


def _source(node: ast.AST) -> str:
    if isinstance(node, (ast.operator, ast.cmpop, ast.boolop, ast.unaryop)):  # no source of its own
        return type(node).__name__
    return ast.unparse(ast.fix_missing_locations(copy.deepcopy(node)))


def single_edits(code: str, families: frozenset[str] | None = None) -> list[Edit]:
    """All single edits in order of their places; of edits of equal (place, family, after) one."""
    out, seen = [], set()
    for node, path, statement in _places(ast.parse(code)):
        for kinds, rule in _RULES:
            if isinstance(node, kinds):
                for name, rel, old, new in rule(node):
                    e = Edit(name, (*path, *rel), statement, _source(old), _source(new), new)
                    if (families is None or e.family in families) and (k := (e.path, e.family, e.after)) not in seen:
                        seen.add(k)
                        out.append(e)
    return out


def compatible(a: Edit, b: Edit) -> bool:
    """Whether two edits are independent: neither inside the other, in different statements, and
    not each other's reverse."""
    n = min(len(a.path), len(b.path))
    return a.path[:n] != b.path[:n] and a.statement != b.statement and not (a.before == b.after and a.after == b.before and a.rule == b.rule)


def _put(node, path: Path, new: ast.AST):
    """A copy of ``node`` with ``new`` at ``path``; what isn't on the path is shared."""
    if not path:
        return copy.deepcopy(new)
    head, rest = path[0], path[1:]
    if isinstance(node, list):
        return [*node[:head], _put(node[head], rest, new), *node[head + 1 :]]
    out = copy.copy(node)
    setattr(out, head, _put(getattr(node, head), rest, new))
    return out


def apply_edits(code: str, edits: list[Edit]) -> str:
    """The program with independent edits, deepest first; dependent ones are an error."""
    if any(not compatible(a, b) for i, a in enumerate(edits) for b in edits[i + 1 :]):
        raise ValueError("the edits aren't independent")
    tree: ast.AST = ast.parse(code)
    for e in sorted(edits, key=lambda e: -len(e.path)):
        tree = _put(tree, e.path, e.node)
    return ast.unparse(ast.fix_missing_locations(tree)) + "\n"


def compatible_sets(edits: list[Edit], k: int, seed: int, limit: int) -> list[list[Edit]]:
    """Up to ``limit`` sets of ``k`` pairwise independent edits, by a seeded depth-first walk."""
    order = list(range(len(edits)))
    random.Random(seed).shuffle(order)
    out: list[list[Edit]] = []

    def grow(chosen: list[int], rest: list[int]) -> None:
        if len(chosen) == k:
            out.append([edits[i] for i in sorted(chosen)])
            return
        for j, i in enumerate(rest):
            if len(out) >= limit:
                return
            grow([*chosen, i], [x for x in rest[j + 1 :] if compatible(edits[i], edits[x])])

    grow([], order)
    return out


def is_single_edit(reference: str, mutant: str) -> bool:
    """Whether some single edit of the reference gives the mutant."""
    want = ast.dump(ast.parse(mutant))
    return any(ast.dump(ast.parse(apply_edits(reference, [e]))) == want for e in single_edits(reference))
