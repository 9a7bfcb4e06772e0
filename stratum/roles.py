"""Column roles and views (data model of SURVEY section 1; PRJ8-PRJ10).

A panel is an immutable DataFrame plus a frozen ``Roles`` record naming the
entity, time, target, status and feature columns.  A ``View`` is what an
analyzer consumes: selected columns, pretty labels, numeric feature list and
whether values were standardized.  Building a view follows the reference
order: standardize the whole frame first, then select, then drop incomplete
rows (so z-scores of the kept rows need not have mean exactly 0).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType

from .functions.transforms import pretty_name
from .operators.scale import ScalerModel, standardize


@dataclass(frozen=True)
class Roles:
    entity: str = "country"
    time: str = "year"
    target: str | None = None
    status: str | None = None
    identifiers: tuple[str, ...] = ()
    labels: Mapping[str, str] = field(default_factory=dict)

    def feature_columns(self, df: DataFrame, include_target: bool = False, extra_exclude: Sequence[str] = (),
                        extra_include: Sequence[str] = ()) -> list[str]:
        """PRJ10: numeric columns minus identifiers, time (always, R10), status, excludes; target optional."""
        skip = {self.entity, self.time, *self.identifiers, *extra_exclude}
        if self.status:
            skip.add(self.status)
        if not include_target and self.target:
            skip.add(self.target)
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skip]
        return cols + [c for c in extra_include if c in df.columns and c not in cols]

    def label(self, column: str) -> str:
        """PRJ8: registered label or a title-cased fallback."""
        return self.labels.get(column, pretty_name(column))


@dataclass(frozen=True)
class View:
    df: DataFrame
    numeric_cols: tuple[str, ...]
    target: str | None
    is_standardized: bool
    labels: Mapping[str, str]
    scaler: ScalerModel | None = None

    @property
    def features(self) -> list[str]:
        """Numeric columns, or every column when the numeric list is empty."""
        return list(self.numeric_cols) if self.numeric_cols else list(self.df.columns)


def make_view(df: DataFrame, roles: Roles, columns: Sequence[str] | None = None, standardized: bool = False,
              include_target: bool = True, drop_missing: bool = True) -> View:
    """Build an analyzer view: optional whole-frame z-scoring, then PRJ9 selection, then FLT2."""
    feats = roles.feature_columns(df)
    scaler = None
    if standardized:
        df, scaler = standardize(df, feats)
    wanted = list(columns) if columns is not None else feats
    if include_target and roles.target and roles.target not in wanted:
        wanted.append(roles.target)
    if include_target and roles.target and roles.target not in df.columns:
        raise KeyError(f"target {roles.target!r} not in frame")
    present = [c for c in wanted if c in df.columns]  # PRJ9: silently drop absent non-target names
    sel = df.select(*present)
    if drop_missing:
        sel = sel.dropna(how="any")
    numeric = tuple(c for c in present if c != roles.target and isinstance(df.schema[c].dataType, NumericType))
    return View(sel, numeric, roles.target if include_target else None, standardized,
                {c: roles.label(c) for c in present}, scaler)
