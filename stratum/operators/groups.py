"""Feature groups: grouped PCA, column combination, group suggestion (GRP1-GRP8).

One GRAM pass over the union of all group columns serves every group: each
group's covariance is a sub-matrix, so adding groups adds no scans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..frames import small_frame
from .gram import Gram, gram
from .pca import PCAModel, pca_from_gram


@dataclass(frozen=True)
class FeatureGroup:
    name: str
    features: tuple[str, ...]


def _validate(groups: Sequence[FeatureGroup], threshold) -> dict[str, float]:
    if not groups:
        raise ValueError("at least one feature group is required")
    names = [g.name for g in groups]
    if len(set(names)) != len(names):
        raise ValueError("duplicate group names")
    for g in groups:
        if not g.features:
            raise ValueError(f"group {g.name!r} is empty")
    if isinstance(threshold, Mapping):
        th = {g.name: float(threshold.get(g.name, 0.8)) for g in groups}
    else:
        th = {g.name: float(threshold) for g in groups}
    for k, v in th.items():
        if not 0.0 < v <= 1.0:
            raise ValueError(f"threshold for {k!r} must be in (0, 1], got {v}")
    return th


@dataclass(frozen=True)
class GroupPCAModel:
    groups: tuple[FeatureGroup, ...]
    models: dict[str, PCAModel]  # all components per group
    n_keep: dict[str, int]

    def score_columns(self) -> dict:
        out = {}
        for g in self.groups:
            m = self.models[g.name]
            names = [f"{g.name}_PC{j + 1}" for j in range(self.n_keep[g.name])]
            all_cols = m.score_columns([f"{g.name}_PC{j + 1}" for j in range(m.n_components)])
            out.update({n: all_cols[n] for n in names})
        return out

    def transform(self, df: DataFrame, keep_other: bool = True) -> DataFrame:
        """GRP2/GRP3: one ``select``: untouched columns + retained scores of every group (SET3)."""
        used = {c for g in self.groups for c in g.features}
        missing = sorted(c for c in used if c not in df.columns)
        if missing:
            raise KeyError(f"missing columns for grouped PCA transform: {missing}")
        others = [c for c in df.columns if c not in used] if keep_other else []
        return df.select(*others, *[e.alias(n) for n, e in self.score_columns().items()])

    def variance_table(self, spark) -> DataFrame:
        """GRP4: per group and component: variance, ratio, cumulative, retained flag."""
        rows = []
        for g in self.groups:
            m = self.models[g.name]
            ratio = m.variances / m.total_variance if m.total_variance > 0 else np.zeros_like(m.variances)
            cum = np.cumsum(ratio)
            for j in range(m.n_components):
                rows.append((g.name, f"PC{j + 1}", float(m.variances[j]), float(ratio[j]), float(cum[j]),
                             j < self.n_keep[g.name]))
        return small_frame(spark, rows, "group string, PC string, variance double, explained_ratio double, "
                                        "cumulative_ratio double, retained boolean")

    def loadings(self, spark, retained_only: bool = True) -> DataFrame:
        rows = []
        for g in self.groups:
            m = self.models[g.name]
            upto = self.n_keep[g.name] if retained_only else m.n_components
            for j in range(upto):
                for i, c in enumerate(m.columns):
                    rows.append((g.name, f"PC{j + 1}", c, float(m.components[i, j])))
        return small_frame(spark, rows, "group string, PC string, feature string, loading double")

    def summary_table(self, spark) -> DataFrame:
        """GRP2: a row a group and a last one named ``all``: features, axes kept, compression, share of variance kept and on the first axis.

        Compression is features over kept axes; the shares of ``all`` are means
        over the groups.  A group without variance has share 0.
        """
        rows = []
        for g in self.groups:
            v = self.models[g.name].variances
            total = self.models[g.name].total_variance
            kept, first = (float(np.sum(v[:self.n_keep[g.name]]) / total), float(v[0] / total)) if total > 0 else (0.0, 0.0)
            rows.append((g.name, len(g.features), self.n_keep[g.name], len(g.features) / self.n_keep[g.name], kept, first))
        before, after = sum(r[1] for r in rows), sum(r[2] for r in rows)
        rows.append(("all", before, after, before / after, *[float(np.mean([r[i] for r in rows])) for i in (4, 5)]))
        return small_frame(spark, rows, "group string, n_features int, n_axes int, compression double, explained double, first_axis double")

    def summary(self) -> dict[str, float]:
        """GRP2: counts before/after, compression ratio, mean explained variance."""
        before = sum(len(g.features) for g in self.groups)
        after = sum(self.n_keep.values())
        kept = [float(np.sum(self.models[g.name].variances[: self.n_keep[g.name]]) / self.models[g.name].total_variance)
                for g in self.groups]
        pc1 = [float(self.models[g.name].variances[0] / self.models[g.name].total_variance) for g in self.groups]
        return {"n_features_before": before, "n_features_after": after, "compression_ratio": after / before,
                "mean_explained_variance": float(np.mean(kept)), "mean_pc1_ratio": float(np.mean(pc1))}


def n_components_for(ratios: np.ndarray, threshold: float) -> int:
    """Fewest leading components whose cumulative ratio reaches the threshold (R12)."""
    cum = np.cumsum(ratios)
    hit = np.nonzero(cum >= threshold - 1e-12)[0]
    return int(hit[0]) + 1 if hit.size else len(ratios)


def fit_grouped_pca(df: DataFrame, groups: Sequence[FeatureGroup], threshold: float | Mapping[str, float] = 0.8,
                    g: Gram | None = None) -> GroupPCAModel:
    """GRP1: per-group PCA from a single Gram over the union of group columns."""
    th = _validate(groups, threshold)
    cols = list(dict.fromkeys(c for grp in groups for c in grp.features))
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"group columns not in frame: {missing}")
    g = g or gram(df, cols)
    models, keep = {}, {}
    for grp in groups:
        m = pca_from_gram(g.sub(list(grp.features)))
        ratios = m.variances / m.total_variance if m.total_variance > 0 else np.ones(m.n_components)
        models[grp.name] = m
        keep[grp.name] = n_components_for(ratios, th[grp.name])
    return GroupPCAModel(tuple(groups), models, keep)


@dataclass(frozen=True)
class CombineModel:
    name: str
    columns: tuple[str, ...]
    weights: tuple[float, ...]
    explained: float  # share of variance of PC1 (0..1)

    def expression(self):
        expr = None
        for c, w in zip(self.columns, self.weights):
            term = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w))
            expr = term if expr is None else expr + term
        return expr

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace the inputs by one weighted column."""
        others = [c for c in df.columns if c not in self.columns]
        return df.select(*others, self.expression().alias(self.name))


def fit_combine(df: DataFrame, columns: Sequence[str], name: str, standardize: bool = False) -> CombineModel:
    """GRP5/GRP6: PC1 weights = squared loadings; applied to unscaled values.

    ``standardize=False`` runs PCA on the raw covariance of complete cases
    (GRP5); ``True`` fills NULL with 0 and uses the correlation matrix (GRP6).
    One column passes through with weight 1.
    """
    cols = list(columns)
    if len(cols) == 1:
        return CombineModel(name, tuple(cols), (1.0,), 1.0)
    if standardize:
        filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
        mat = gram(filled, cols).corr()
    else:
        mat = gram(df, cols).cov(ddof=1)
    vals, vecs = np.linalg.eigh(mat)
    v1 = vecs[:, int(np.argmax(vals))]
    weights = tuple(float(x * x) for x in v1)
    return CombineModel(name, tuple(cols), weights, float(vals.max() / vals.sum()))


def average_linkage_groups(corr: np.ndarray, names: Sequence[str], threshold: float = 0.7,
                           min_group_size: int = 2) -> list[list[str]]:
    """GRP7: average linkage on ``1 - |r|``; stop when the closest pair exceeds ``1 - threshold``.

    k x k work on the driver (k features); Lance-Williams update for average
    linkage.  Groups are ordered by their first feature's position.
    """
    k = len(names)
    dist = 1.0 - np.abs(np.nan_to_num(corr, nan=0.0))
    np.fill_diagonal(dist, 0.0)
    clusters = {i: [i] for i in range(k)}
    d = {(i, j): dist[i, j] for i in range(k) for j in range(i + 1, k)}
    cut = 1.0 - threshold
    while len(clusters) > 1:
        (a, b), best = min(d.items(), key=lambda kv: (kv[1], kv[0]))
        if best > cut + 1e-12:
            break
        na, nb = len(clusters[a]), len(clusters[b])
        merged = clusters[a] + clusters[b]
        del clusters[b]
        clusters[a] = merged
        d.pop((a, b))
        for c in list(clusters):
            if c == a:
                continue
            dac = d.pop((min(a, c), max(a, c)))
            dbc = d.pop((min(b, c), max(b, c)))
            d[(min(a, c), max(a, c))] = (na * dac + nb * dbc) / (na + nb)
    groups = [sorted(m) for m in clusters.values() if len(m) >= min_group_size]
    groups.sort(key=lambda m: m[0])
    return [[names[i] for i in m] for m in groups]


def suggest_groups(df: DataFrame, columns: Sequence[str], threshold: float = 0.7, min_group_size: int = 2):
    """GRP7 with summary: group, size, features, mean_abs_corr, min_abs_corr."""
    from .corr import correlation

    res = correlation(df, columns)
    groups = average_linkage_groups(res.matrix, res.columns, threshold, min_group_size)
    pos = {c: i for i, c in enumerate(res.columns)}
    rows = []
    for n, feats in enumerate(groups, start=1):
        idx = [pos[f] for f in feats]
        sub = np.abs(res.matrix[np.ix_(idx, idx)])
        off = sub[~np.eye(len(idx), dtype=bool)]
        rows.append((f"Group_{n}", n, len(feats), ",".join(feats), float(off.mean()), float(off.min())))
    frame = small_frame(df.sparkSession, rows, "group string, group_no int, size int, features string, "
                                               "mean_abs_corr double, min_abs_corr double")
    return {f"Group_{n}": feats for n, feats in enumerate(groups, start=1)}, frame.orderBy("group_no")


def supervised_pca(df: DataFrame, features: Sequence[str], target: str, screen: float = 0.25,
                   threshold: float = 1.0, alpha: float = 0.05):
    """GRP8: screen features by |corr with target| > ``screen`` (FLT9), PCA on the survivors,
    regress the target on the retained scores, keep the significant components.

    One GRAM over features + target serves every step: the scores' Gram is
    ``V' S V`` and their covariance with the target is ``V' s_xy``.
    """
    from .ols import model_from_gram
    from .terms import Term

    cols = list(features)
    g = gram(df, [*cols, target])
    r = g.corr()
    t_idx = len(cols)
    kept = [c for i, c in enumerate(cols) if abs(r[i, t_idx]) > screen]
    if not kept:
        raise ValueError("no feature passes the correlation screen")
    pca = pca_from_gram(g.sub(kept))
    ratios = pca.variances / pca.total_variance
    m = n_components_for(ratios, threshold)
    v = pca.components[:, :m]
    ix = g.index(kept)
    iy = g.index([target])[0]
    k = m + 1
    cross = np.zeros((k, k))
    cross[:m, :m] = v.T @ g.cross[np.ix_(ix, ix)] @ v
    cross[:m, m] = cross[m, :m] = v.T @ g.cross[ix, iy]
    cross[m, m] = g.cross[iy, iy]
    names = tuple([f"_t{j}" for j in range(m)] + ["_y"])
    means = np.concatenate([np.zeros(m), [g.means[iy]]])
    sg = Gram(names, g.n, means, cross, g.rows)
    terms = [Term(f"PC{j + 1}", pca.score_columns()[f"PC{j + 1}"]) for j in range(m)]
    full = model_from_gram(sg, target, terms)
    se = np.sqrt(np.clip(np.diag(full.cov_params), 0, None))
    from ..functions.tails import t_sf2

    pvals = [t_sf2(b / s, full.df_resid) if s > 0 else 1.0 for b, s in zip(full.coef[1:], se[1:])]
    sig = [j for j, p in enumerate(pvals) if p < alpha] or list(range(m))
    final = model_from_gram(sg, target, terms, sig)
    return kept, pca, final
