"""SQL of small systems of equations: the same elimination, written as lists of numbers.

Each step is a table of one row that reads the step before it once.
"""

from __future__ import annotations

from collections.abc import Sequence

from orderloom.operators.regression import SMALL


def sums(features: Sequence[str], weight: str, target: str) -> str:
    """The augmented matrix of the normal equations as an aggregate."""
    terms = [*[f"({f})::DOUBLE" for f in features], "1.0::DOUBLE"]
    rows = [
        "[" + ", ".join([f"sum({weight} * {a} * {b})" for b in terms] + [f"sum({a} * {target})"]) + "]"
        for a in terms
    ]
    return "[" + ", ".join(rows) + "]"


def score(features: Sequence[str], c: str = "c") -> str:
    terms = [f"({f})::DOUBLE * {c}[{i}]" for i, f in enumerate(features, 1)]
    return " + ".join([*terms, f"{c}[{len(features) + 1}]"])


def solved(name: str, start: str, size: int, keep: str = "") -> dict[str, str]:
    """Tables ``name0`` .. that solve the matrix ``m`` of ``start``; the last has ``d``.

    ``keep`` names a column of ``start`` that is carried along.
    """
    along = f"{keep}, " if keep else ""
    diagonal = "lambda i: CASE WHEN m[i][i] > 0 THEN sqrt(m[i][i]) ELSE 1.0 END"
    steps = {
        f"{name}0": f"""SELECT {along}s, list_transform(m, lambda row, i: list_transform(row, lambda x, j: x / s[i] / COALESCE(s[j], 1.0))) AS a
 FROM (SELECT {along}m, list_transform(range(1, {size + 1}), {diagonal}) AS s FROM {start})"""
    }
    for k in range(1, size + 1):
        own = f"list_transform(a[{k}], lambda x: CASE WHEN abs(a[{k}][{k}]) < {SMALL} THEN 0.0 ELSE x / a[{k}][{k}] END)"
        steps[f"{name}{k}"] = f"""SELECT {along}s, list_transform(a, lambda row, i: CASE WHEN i = {k} THEN own ELSE list_transform(row, lambda x, j: x - row[{k}] * own[j]) END) AS a
 FROM (SELECT {along}s, a, {own} AS own FROM {name}{k - 1})"""
    steps[f"{name}d"] = f"SELECT {along}list_transform(a, lambda row, i: row[{size + 1}] / s[i]) AS d FROM {name}{size}"
    return steps


def least_squares(name: str, rows: str, features: Sequence[str], label: str) -> dict[str, str]:
    """Tables whose last, ``name`` + ``d``, has the coefficients ``d``."""
    start = f"SELECT {sums(features, '1.0', f'({label})::DOUBLE')} AS m FROM {rows} WHERE NOT held_out"
    return {f"{name}m": start} | solved(name, f"{name}m", len(features) + 1)


def logistic_regression(
    name: str, rows: str, features: Sequence[str], label: str, steps: int
) -> dict[str, str]:
    """Tables whose last, ``name`` + ``c``, has the coefficients ``c``."""
    size = len(features) + 1
    found = {f"{name}p0": f"SELECT {[0.0] * size} AS c"}
    for s in range(1, steps + 1):
        scored = f"SELECT r.*, c, 1 / (1 + exp(-({score(features)}))) AS pr FROM {rows} r, {name}p{s - 1} WHERE NOT held_out"
        matrix = sums(features, "pr * (1 - pr)", f"(({label})::DOUBLE - pr)")
        found[f"{name}m{s}"] = f"SELECT any_value(c) AS c, {matrix} AS m FROM ({scored})"
        found |= solved(f"{name}s{s}x", f"{name}m{s}", size, "c")
        found[f"{name}p{s}"] = f"SELECT list_transform(c, lambda x, i: x + d[i]) AS c FROM {name}s{s}xd"
    return found | {f"{name}c": f"SELECT c FROM {name}p{steps}"}
