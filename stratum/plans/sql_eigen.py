"""Principal axes in SQL, for oracles: any number of columns, by squaring the covariance matrix.

A symmetric matrix squared again and again, scaled to trace one, tends to the
projector on its leading eigenvector, whose column of the largest diagonal entry
is the vector with that entry positive.  Each further axis is found the same way
after the part of the axes before it has been taken off.
"""

from __future__ import annotations

from collections.abc import Sequence

#: squarings: 2^40 powers part eigenvalues that differ in the tenth digit
SQUARINGS = 40


def _at(i: int, j: int) -> str:
    return f"a{min(i, j)}_{max(i, j)}"


def _cells(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def axes_sql(name: str, source: str, columns: Sequence[str], axes: int, correlation: bool = False) -> str:
    """CTEs (for ``WITH RECURSIVE``): ``{name}_s`` with means ``m{i}`` and matrix, ``{name}_v{c}`` with ``v{i}`` and eigenvalue ``l``."""
    k = len(columns)
    stat = "corr" if correlation else "covar_samp"
    full = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    parts = [f"{name}_s AS (SELECT " + ", ".join(f"{stat}({columns[i]}, {columns[j]}) AS {_at(i, j)}" for i, j in _cells(k)) + ", "
             + ", ".join(f"avg({c}) AS m{i}" for i, c in enumerate(columns)) + f" FROM {source} WHERE {full})"]
    here = f"{name}_s"
    for c in range(1, axes + 1):
        trace = " + ".join(_at(i, i) for i in range(k))
        squares = " + ".join(f"{1 if i == j else 2} * {_at(i, j)} * {_at(i, j)}" for i, j in _cells(k))
        step = ", ".join("(" + " + ".join(f"{_at(i, m)} * {_at(m, j)}" for m in range(k)) + f") / ({squares})" for i, j in _cells(k))
        parts.append(f"{name}_q{c} AS (SELECT 0 AS it, " + ", ".join(f"{_at(i, j)} / ({trace}) AS {_at(i, j)}" for i, j in _cells(k))
                     + f" FROM {here} UNION ALL SELECT it + 1, {step} FROM {name}_q{c} WHERE it < {SQUARINGS})")
        most = "greatest(" + ", ".join(_at(i, i) for i in range(k)) + ")"
        vector = [f"CASE {' '.join(f'WHEN {_at(j, j)} = {most} THEN {_at(i, j)} / sqrt({_at(j, j)})' for j in range(k))} END AS v{i}" for i in range(k)]
        parts.append(f"{name}_u{c} AS (SELECT {', '.join(vector)} FROM {name}_q{c} WHERE it = {SQUARINGS})")
        value = " + ".join(f"{1 if i == j else 2} * v{i} * v{j} * {_at(i, j)}" for i, j in _cells(k))
        parts.append(f"{name}_v{c} AS (SELECT u.*, {value} AS l FROM {name}_u{c} u, {here})")
        parts.append(f"{name}_d{c} AS (SELECT " + ", ".join(f"{_at(i, j)} - l * v{i} * v{j} AS {_at(i, j)}" for i, j in _cells(k))
                     + f" FROM {here}, {name}_v{c})")
        here = f"{name}_d{c}"
    return ", ".join(parts)


def score_sql(name: str, columns: Sequence[str], axis: int, row: str) -> str:
    """The centred score of a row on an axis; join ``{name}_s`` and ``{name}_v{axis}``."""
    return "(" + " + ".join(f"({row}.{c} - {name}_s.m{i}) * {name}_v{axis}.v{i}" for i, c in enumerate(columns)) + ")"


def tables_sql(name: str, axes: int) -> str:
    """The CTEs that :func:`score_sql` reads, as a comma join (a row each)."""
    return ", ".join([f"{name}_s", *[f"{name}_v{c}" for c in range(1, axes + 1)]])
