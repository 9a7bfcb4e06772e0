"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are positives; all other text, labelled or not, is
unlabelled.  A linear classifier over the words of a text and the beginnings
of its words, those whose share among positives differs from that among the
unlabelled by ``MIN_Z`` standard errors, is trained in numpy on the
class-prior-corrected risk
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with logistic loss: where
the estimate of the negatives' risk falls below zero, the step undoes the
overfit instead (the non-negative correction).  The fit uses a bounded sample
of rows (``max_positive`` and ``max_unlabelled`` ids, those of the smallest hashes,
one text each, none of more than ``MAX_TEXT_BYTES`` bytes);
the prior is the share of toxic rows among all labelled training rows.  Every
whole text is scored; ids, labels, language and source are no inputs of a score.

Defined cases: null and blank texts get the score of the classifier's bias;
without positives every score is the prior (0 without labels); a null label
says nothing; a document labelled both ways is toxic; repeated rows get equal
scores; a null id is never held out nor trained on; only the named columns are
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .store import written

MAX_POSITIVE = 4_000
MAX_UNLABELLED = 12_000
#: longer texts are scored but not learnt from
MAX_TEXT_BYTES = 1 << 16
#: hashed feature space (float32 weights: 1 MB, broadcast)
SPACE = 1 << 18
#: a feature of the fit occurs in so many sampled texts at least
MIN_TEXTS = 5
MIN_Z = 4.5
PREFIX_BYTES = (4, 5, 6)
FOLDS = 5
#: steps and decay: the best mean F1 over the four folds that labels are learnt from, each scored by a fit on the other three
STEPS = 1000
RATE = 0.05
DECAY = 5e-5
BATCH_ROWS = 2048


def held_out(key: str) -> Column:
    """Whether a document is in the fold that no label is learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each row, one row after the other, and row offsets."""
    rows = w.row_of()
    each_row, each_code = [rows], [w.hash]
    at, begin = np.arange(len(w.hash)), np.zeros(len(w.hash), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(max(PREFIX_BYTES)):
            longer = w.end[at] - w.start[at] > k + 1  # the word itself is no beginning
            at, begin = at[longer], W.mix(begin[longer] + W._VALUES[True][w.data[w.start[at[longer]] + k]])
            if k + 1 in PREFIX_BYTES:
                each_row.append(rows[at])
                each_code.append(begin + np.uint64(k + 1))
    code = (np.concatenate(each_code) % np.uint64(SPACE)).astype(np.int64)
    cell = np.unique(np.concatenate(each_row) * SPACE + code)
    return (cell % SPACE).astype(np.int32), np.searchsorted(cell, np.arange(w.rows + 1) * SPACE)


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, toxic: str, max_positive: int, max_unlabelled: int):
    """The training rows' features as Arrow columns ``positive``, ``codes``, and the class prior."""
    known = labels.where(~held_out(key) & F.col(key).isNotNull() & F.col(toxic).isNotNull()).groupBy(
        F.col(key).alias("id")).agg(F.max(toxic).alias("toxic"))
    known = written(known, "toxicity-labels")
    prior = known.agg(F.avg("toxic")).first()[0]
    if not prior:
        return None, float(prior or 0.0)
    order = F.xxhash64(F.lit(5), "id")
    positive = known.where("toxic = 1").select("id").orderBy(order, "id").limit(max_positive)
    unlabelled = docs.where(~held_out(key) & F.col(key).isNotNull()).select(F.col(key).alias("id")).distinct().orderBy(order, "id").limit(max_unlabelled)
    chosen = written(positive.withColumn("positive", F.lit(True)).unionAll(unlabelled.withColumn("positive", F.lit(False)))
                     .groupBy("id").agg(F.array_sort(F.collect_set("positive")).alias("roles")), "toxicity-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in W.slices(batch.column(2), W.FOLDED, True):
                codes, at = features(w)
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in batch.columns[:2]), W.list_column(codes, at, pa.int32())],
                                                 names=["id", "roles", "codes"])

    # the sample has max_positive + max_unlabelled rows at most: an id that repeats has one text, the least
    kind = docs.schema[key].dataType.simpleString()
    short = docs.where(F.coalesce(F.octet_length(F.col(text)), F.lit(0)) <= MAX_TEXT_BYTES)
    rows = (short.select(F.col(key).alias("d_id"), F.lower(text).alias("t")).join(F.broadcast(chosen), F.col("d_id") == F.col("id"))
            .select("id", "roles", "t").mapInArrow(run, f"id {kind}, roles array<boolean>, codes array<int>")
            .groupBy("id").agg(F.min(F.struct("codes", "roles")).alias("one"))
            .select(F.explode("one.roles").alias("positive"), "one.codes").toArrow())
    return rows, float(prior)


def fit(rows: pa.Table, prior: float, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights by feature and the bias: mini-batch Adam on the non-negative risk."""
    positive = rows["positive"].to_numpy()
    lists = rows["codes"].combine_chunks()
    order = np.lexsort((lists.value_lengths().to_numpy(), positive))  # the same fit whatever order rows came in
    flat, at = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    in_p = np.repeat(positive, lists.value_lengths().to_numpy())
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    share_p = np.bincount(flat[in_p], minlength=SPACE) / max(1, n_p)
    share_u = np.bincount(flat[~in_p], minlength=SPACE) / max(1, n_u)
    pooled = (share_p * n_p + share_u * n_u) / (n_p + n_u)
    error = np.sqrt(pooled * (1 - pooled) * (1 / max(1, n_p) + 1 / max(1, n_u)))
    known = np.flatnonzero((pooled * (n_p + n_u) >= MIN_TEXTS) & (np.abs(share_p - share_u) > MIN_Z * error))
    place = np.full(SPACE, -1, dtype=np.int64)
    place[known] = np.arange(len(known))
    own = [place[flat[at[r]:at[r + 1]]] for r in order]
    own = [np.sort(x[x >= 0]) for x in own]
    is_p = positive[order]
    p_rows, u_rows = np.flatnonzero(is_p), np.flatnonzero(~is_p)
    ranks = np.array([int(W.mix(np.array([x.sum() * 2654435761 + len(x)], dtype=np.uint64))[0] >> np.uint64(1)) for x in own])
    p_rows, u_rows = p_rows[np.argsort(ranks[p_rows], kind="stable")], u_rows[np.argsort(ranks[u_rows], kind="stable")]
    weight, bias = np.zeros(len(known)), float(np.log(prior / (1 - prior))) if prior < 1 else 0.0
    m, v, mb, vb = np.zeros(len(known)), np.zeros(len(known)), 0.0, 0.0
    rng = np.random.default_rng(7)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, steps + 1):
        p = p_rows[rng.permutation(len(p_rows))[:BATCH_ROWS // 4]]
        u = u_rows[rng.permutation(len(u_rows))[:BATCH_ROWS]]
        batch = np.concatenate([p, u])
        idx = np.concatenate([own[r] for r in batch]) if len(batch) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(batch)), [len(own[r]) for r in batch])
        z = bias + np.bincount(row, weights=weight[idx], minlength=len(batch))
        zp, zu = z[:len(p)], z[len(p):]
        soft = lambda x: np.logaddexp(0, x)
        negative = (soft(zu).mean() if len(u) else 0.0) - prior * soft(zp).mean()
        g = np.zeros(len(batch))
        if negative >= 0:
            g[:len(p)] = prior * (-sig(-zp) - sig(zp)) / len(p)
            g[len(p):] = sig(zu) / max(1, len(u))
        else:
            g[:len(p)] = prior * sig(zp) / len(p)
            g[len(p):] = -sig(zu) / max(1, len(u))
        grad = np.bincount(idx, weights=g[row], minlength=len(known)) + decay * weight
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        weight -= rate * (m / c1) / (np.sqrt(v / c2) + 1e-6)
        bias -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-6)
    out = np.zeros(SPACE, dtype=np.float32)
    out[known] = weight
    return out, float(bias)


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", toxic: str = "toxic",
          max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> DataFrame:
    """``(key, held_out, score, predicted)`` of every document."""
    rows, prior = sample(docs, labels, key, text, toxic, max_positive, max_unlabelled)
    if rows is None or not rows.num_rows or not rows["positive"].to_numpy().any():
        value = F.lit(prior)
        return docs.select(F.col(key), held_out(key).alias("held_out"), value.alias("score"), (value >= 0.5).cast("int").alias("predicted"))
    sent = docs.sparkSession.sparkContext.broadcast(fit(rows, prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, bias = sent.value
        for batch in batches:
            for lo, hi, w in W.slices(batch.column(2), W.FOLDED, True):
                codes, at = features(w)
                z = np.full(hi - lo, bias)
                full = np.flatnonzero(np.diff(at))
                if len(full):  # row by row, so that equal texts get equal sums
                    z[full] += np.add.reduceat(weight[codes].astype(np.float64), at[full])
                s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    names=["k", "held_out", "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("k"), held_out(key).alias("held_out"), F.lower(text).alias("t")).mapInArrow(
        run, f"k {kind}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("k", key)
