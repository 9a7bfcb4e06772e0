"""Model registry (REG1-REG4): named fitted models, Cook-trimmed refits, stepwise
registration and comparison tables.

Entries hold k-sized numbers (coefficients, metrics, checks); the data stays a
lazy DataFrame.  ``save`` writes the registry as parquet tables.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..frames import small_frame
from .diagnostics import assumption_checks, refit_without, residual_metrics
from .evaluate import evaluate
from .ols import OLSModel, fit_ols
from .selection import SelectionPath, Selector


#: columns of the assumption table
ASSUMPTIONS = ("durbin_watson", "jarque_bera_pvalue", "normality_pvalue", "breusch_pagan_pvalue", "white_pvalue", "condition_number",
               "max_vif", "max_leverage", "max_cooks_d")


def _slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", text.lower()).strip("_")


@dataclass
class Entry:
    name: str
    rhs: list[str]
    model: OLSModel
    metrics: dict
    eval_metrics: dict[str, dict] = field(default_factory=dict)
    path: SelectionPath | None = None
    initial: Entry | None = None  # R20: the untrimmed fit of a Cook-trimmed entry
    frame: DataFrame | None = None  # the rows of the fit, lazy


class ModelRegistry:
    def __init__(self):
        self._entries: dict[str, Entry] = {}

    # --- REG1 -------------------------------------------------------------------------------------
    def __len__(self) -> int:
        return len(self._entries)

    def __iter__(self) -> Iterator[Entry]:
        return iter(self._entries.values())

    def __contains__(self, name: str) -> bool:
        return name in self._entries

    def get(self, name: str) -> Entry:
        if name not in self._entries:
            raise KeyError(f"no model named {name!r}")
        return self._entries[name]

    def remove(self, name: str) -> None:
        del self._entries[self.get(name).name]

    def add(self, entry: Entry, overwrite: bool = False) -> Entry:
        """Register an entry made elsewhere; a name that is taken is an error unless ``overwrite``."""
        if entry.name in self._entries and not overwrite:
            raise KeyError(f"a model named {entry.name!r} is registered")
        self._entries[entry.name] = entry
        return entry

    def _auto_name(self, rhs: Sequence[str]) -> str:
        base = _slug("_".join(rhs)) or "intercept"
        name, i = base, 2
        while name in self._entries:
            name, i = f"{base}_{i}", i + 1
        return name

    def fit(self, df: DataFrame, target: str, rhs: Sequence[str], name: str | None = None, refit: bool = False,
            cooks_threshold: float | str | None = None) -> Entry:
        """Fit and register; a cached name returns the stored entry unless ``refit``.

        REG2: with ``cooks_threshold`` (a bound, or ``"4/n"`` for four over the
        rows of the fit) the model is refit without rows whose Cook's distance exceeds it; the
        untrimmed fit is kept as ``entry.initial`` and as ``{name}_initial``.
        """
        name = name or (_slug("_".join(rhs)) or "intercept")
        if name in self._entries and not refit:
            return self._entries[name]
        model = fit_ols(df, target, list(rhs))
        if cooks_threshold is not None:
            bound = None if cooks_threshold == "4/n" else float(cooks_threshold)
            if bound is not None and bound <= 0:
                raise ValueError("cooks_threshold must be positive")
            initial = Entry(f"{name}_initial", list(rhs), model, {**model.metrics(), **residual_metrics(model, df)}, frame=df)
            trimmed, kept = refit_without(model, df, bound)
            entry = Entry(name, list(rhs), trimmed, {**trimmed.metrics(), **residual_metrics(trimmed, kept)},
                          initial=initial, frame=kept)
            self.add(initial, overwrite=True)
        else:
            entry = Entry(name, list(rhs), model, {**model.metrics(), **residual_metrics(model, df)}, frame=df)
        return self.add(entry, overwrite=True)

    # --- REG3 -------------------------------------------------------------------------------------
    def add_from_path(self, path: SelectionPath, name: str | None = None, frame: DataFrame | None = None) -> Entry:
        step = path.best
        name = name or self._auto_name([path.direction, path.criterion])
        return self.add(Entry(name, list(step.terms), step.model, dict(step.metrics), path=path, frame=frame), overwrite=True)

    def fit_stepwise(self, df: DataFrame, target: str, base: Sequence[str], candidates: Sequence[str],
                     direction: str = "forward", criterion: str = "aic", threshold: float = 1.0,
                     name: str | None = None) -> Entry:
        path = Selector(df, target, base, candidates).path(direction, criterion, threshold)
        return self.add_from_path(path, name, df)

    def register_best_paths(self, paths: Sequence[SelectionPath], prefix: str = "sel") -> list[Entry]:
        return [self.add_from_path(p, self._auto_name([prefix, p.direction, p.criterion])) for p in paths]

    def path_table(self, spark) -> DataFrame:
        """REG3: which path and step each registered model came from, with its metrics."""
        rows = [(e.name, e.path.direction, e.path.criterion, e.path.best.step, len(e.rhs), e.path.best.value(e.path.criterion),
                 e.metrics["aic"], e.metrics["bic"], e.metrics["adj_r2"], e.metrics["rmse"]) for e in self if e.path is not None]
        return small_frame(spark, rows, "model string, direction string, criterion string, step int, n_terms int, value double, "
                                        "aic double, bic double, adj_r2 double, rmse double")

    # --- EVA1 by label / REG4 ---------------------------------------------------------------------
    def evaluate_all(self, df: DataFrame, label: str) -> DataFrame:
        """All models on new data in one projection + one aggregate; stored per label."""
        if not self._entries:
            return df.sparkSession.createDataFrame([], "model string, n long, rmse double, mae double, r2 double")
        res = evaluate({e.name: e.model for e in self}, df)
        for r in res.collect():  # one row per model
            self._entries[r["model"]].eval_metrics[label] = r.asDict()
        return res

    def compare(self, spark, sort_by: str = "aic", ascending: bool | None = None) -> DataFrame:
        """REG4: metrics + hold-out columns per label; R19: ascending only where lower is better."""
        labels = sorted({lb for e in self for lb in e.eval_metrics})
        rows = []
        for e in self:
            m = e.metrics
            row = [e.name, " + ".join(e.rhs), m.get("n_obs"), m.get("r2"), m.get("adj_r2"), m.get("rmse"),
                   m.get("mae"), m.get("aic"), m.get("bic")]
            for lb in labels:
                em = e.eval_metrics.get(lb, {})
                row += [em.get("rmse"), em.get("r2")]
            rows.append(tuple(row))
        schema = ("model string, rhs string, n_obs double, r2 double, adj_r2 double, rmse double, mae double, "
                  "aic double, bic double")
        for lb in labels:
            schema += f", `{lb}_rmse` double, `{lb}_r2` double"
        frame = small_frame(spark, rows, schema)
        if ascending is None:
            ascending = not (sort_by in ("r2", "adj_r2") or sort_by.endswith("_r2"))
        return frame.orderBy(F.col(sort_by).asc_nulls_last() if ascending else F.col(sort_by).desc_nulls_last(),
                             "model")

    def assumptions_table(self, spark, names: Sequence[str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
        """DIA9 for the named entries (default: all), a row a model, each on the rows of its own fit.

        ``order`` are the columns that order the rows for Durbin-Watson, which is
        NULL without them; an entry that came without rows is an error.
        """
        rows = []
        for e in [self.get(n) for n in names] if names is not None else list(self):
            if e.frame is None:
                raise ValueError(f"the rows of {e.name!r} are not known")
            checks = assumption_checks(e.model, e.frame, order)
            rows.append((e.name, *[None if checks.get(c) is None or math.isnan(checks[c]) else float(checks[c]) for c in ASSUMPTIONS]))
        return small_frame(spark, rows, "model string, " + ", ".join(f"{c} double" for c in ASSUMPTIONS))

    def freeze(self, name: str, df: DataFrame, key: Sequence[str], path: str) -> DataFrame:
        """The predictions of an entry for ``df``, written once: a later refit under the name does not change them."""
        self.get(name).model.predict(df, keep=list(key)).write.mode("errorifexists").parquet(path)
        return df.sparkSession.read.parquet(path)

    def coefficients(self, spark) -> DataFrame:
        rows = [(e.name, n, float(b)) for e in self for n, b in zip(e.model.names, e.model.coef)]
        return small_frame(spark, rows, "model string, term string, coefficient double")

    def save(self, spark, path: str) -> None:
        """Persist as parquet: coefficients and metrics tables."""
        self.coefficients(spark).write.mode("overwrite").parquet(f"{path}/coefficients")
        self.compare(spark).write.mode("overwrite").parquet(f"{path}/metrics")
