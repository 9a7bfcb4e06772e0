"""Every one-term move of a linear model scored at once on a swept correlation matrix.

Sweeping a column in or out of the centred cross products costs O(k^2); after
it the residual sum of squares of *every* model one term away is one vector
expression, so a selection round is a vector, not a loop of fits.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from .gram import Gram

#: share of a column's variance that the model must leave, for it to add anything
_TOLERANCE = 1e-10


class SweptModel:
    """A model (with intercept) over Gram columns ``x``; ``inside`` marks its terms."""

    def __init__(self, g: Gram, x: list[str], y: str):
        idx = g.index([*x, y])
        cross = g.cross[np.ix_(idx, idx)]
        scale = np.sqrt(np.where(np.diag(cross) > 0, np.diag(cross), 1.0))
        self.n, self.k = g.n, len(x)
        self.tss = float(cross[-1, -1])
        self.a = cross / np.outer(scale, scale)
        self.inside = np.zeros(self.k, dtype=bool)
        self.swept = np.zeros(self.k, dtype=bool)  # a collinear term can be inside without a column of its own

    def copy(self) -> SweptModel:
        other = object.__new__(SweptModel)
        other.__dict__ = {k: v.copy() if isinstance(v, np.ndarray) else v for k, v in self.__dict__.items()}
        return other

    def _pivot(self, j: int, sign: float) -> None:
        d, col = self.a[j, j], self.a[:, j].copy()
        self.a -= np.outer(col, col) / d
        self.a[:, j] = self.a[j, :] = sign * col / d
        self.a[j, j] = -1.0 / d
        self.swept[j] = not self.swept[j]

    def _settle(self) -> None:
        """Sweep in the terms that have become independent."""
        for j in np.flatnonzero(self.inside & ~self.swept):
            if self.a[j, j] > _TOLERANCE:
                self._pivot(j, 1.0)

    def toggle(self, j: int) -> None:
        """Put term ``j`` in, or take it out."""
        self.inside[j] = not self.inside[j]
        if self.swept[j]:
            self._pivot(j, -1.0)
        self._settle()

    def put(self, terms: Iterable[int]) -> SweptModel:
        for j in terms:
            self.toggle(j)
        return self

    @property
    def rss(self) -> float:
        return max(float(self.a[-1, -1]), 0.0) * self.tss

    def rss_after(self) -> np.ndarray:
        """Residual sum of squares after toggling each term alone."""
        d, c = np.diag(self.a)[:-1], self.a[:-1, -1]
        live = np.abs(d) > np.where(self.swept, 0.0, _TOLERANCE)
        out = self.a[-1, -1] - np.where(live, c * c / np.where(live, d, 1.0), 0.0)
        if (self.inside & ~self.swept).any():  # a collinear term may take the place of one that leaves
            for j in np.flatnonzero(self.swept):
                trial = self.copy()
                trial.toggle(j)
                out[j] = trial.a[-1, -1]
        return np.maximum(out, 0.0) * self.tss
