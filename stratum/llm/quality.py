"""Quality rules with risk-controlled thresholds.

``text_stats`` counts, over every whole text, the numbers that the rules look
at.  ``select_cutoffs`` reads a labelled holdout of good documents and picks,
per stratum and rule, the strictest cutoff of a fixed grid whose false
rejections are bounded: the exact binomial test must reject "this cutoff turns
away more than its share of ``risk`` of the good documents" (the rules share
``risk`` equally, so that all of them together stay within it) at level
``delta`` divided by the number of tests (Bonferroni over strata, rules and
cutoffs).  A stratum
without enough labelled good documents gets no cutoff, so its documents are
judged by the base rules alone.

Defined cases: a null or blank text has zero counts (and fails the base rule on
word count); a null stratum is a stratum of its own; repeated rows are judged
row by row; labels of unknown documents are ignored; a document labelled more
than once counts as good only if every label says so; an empty table gives an
empty result; only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import words as W
from .store import packed, unpacked, written

#: fixed by the contract of the base rules
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

#: a rule rejects a document whose measure is above the cutoff; measures are per thousand, capped at 1000
RULES = {
    "symbols": "least(1000L, 1000L * n_symbols div greatest(n_words, 1L))",
    "dup_lines": "least(1000L, 1000L * n_dup_lines div greatest(n_lines, 1L))",
    "repeat_words": "1000L * n_repeat_words div greatest(n_words, 1L)",
    "long_words": "least(1000L, 10L * word_chars div greatest(n_words, 1L))",
}
CUTOFFS = tuple(range(0, 1000, 20))
RISK = 0.02
DELTA = 0.05

STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _per_row(marks: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return np.diff(sums[starts])


def _duplicates(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the entries equal to an earlier one of their row, and of those with any equal in it."""
    order = np.lexsort((keys, rows))  # stable: equal entries stay in reading order
    r, k = rows[order], keys[order]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    later, any_ = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
    later[order] = same
    any_[order] = same | np.append(same[1:], False)
    return later, any_


def _line_marks(w: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and "has a word" of every ``\\n``-split line."""
    breaks = np.flatnonzero(w.data == 10)
    row_of_break = np.searchsorted(w.row_start, breaks, side="right") - 1
    start = np.concatenate([w.row_start[:-1], breaks + 1])
    row = np.concatenate([np.arange(w.rows), row_of_break])
    order = np.argsort(start + row, kind="stable")  # an empty row starts where the next one does
    start, row = start[order], row[order]
    end = np.append(start[1:], len(w.data))
    end[:-1] -= (row[1:] == row[:-1])  # the break itself is in no line
    has = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, row = start[has], end[has], row[has]
    return row, W._hash_words(w.data, start, end, W._VALUES[False]), np.ones(len(row), dtype=bool)


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text of an Arrow array."""
    out: dict[str, list[np.ndarray]] = {}
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    for _, _, w in W.slices(texts):
        rows, n = w.row_of(), w.counts()
        tri, valid = W.ngrams(w, 3)
        twice = np.zeros(len(tri), dtype=bool)
        at = np.flatnonzero(valid)
        twice[at] = _duplicates(rows[at], tri[at])[1]
        covered = twice.copy()
        covered[1:] |= twice[:-1]
        covered[2:] |= twice[:-2]
        line_row, line_hash, _ = _line_marks(w)
        later = _duplicates(line_row, line_hash)[0]
        found = {
            "n_words": n,
            "word_chars": _per_row(W.PLAIN[w.data] & ((w.data & 0xC0) != 0x80), w.row_start),
            "n_symbols": _per_row(symbol[w.data], w.row_start),
            "n_lines": np.bincount(line_row, minlength=w.rows),
            "n_dup_lines": np.bincount(line_row[later], minlength=w.rows),
            "n_repeat_words": _per_row(covered, w.first),
        }
        for k, v in found.items():
            out.setdefault(k, []).append(v.astype(np.int64))
    return {k: np.concatenate(out[k]) if k in out else np.zeros(0, np.int64) for k in STATS}


def text_stats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and the counts of every whole text, one row per input row."""
    names = [f"k{i}" for i in range(len(keep))]
    source = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text).alias("t"))
    schema = StructType([*(source.schema[n] for n in names), *(StructField(n, LongType()) for n in STATS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(batch.column(len(names)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], *map(pa.array, found.values())],
                                             names=[*names, *found])

    return source.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keep)))


def base_failed() -> F.Column:
    """The fixed base rules."""
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def most_rejections(n: int, risk: float, level: float) -> int:
    """Largest k with P(Bin(n, risk) <= k) <= level, -1 if there is none: up to k false rejections
    among n good documents, the exact binomial upper bound on their rate is at most ``risk``."""
    total, k = 0.0, 0
    while k < n * risk:
        total += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                          + k * math.log(risk) + (n - k) * math.log1p(-risk))
        if total > level:
            break
        k += 1
    return k - 1


def select_cutoffs(stats: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id",
                   good: str = "quality", risk: float = RISK, delta: float = DELTA,
                   cutoffs: tuple[int, ...] = CUTOFFS) -> DataFrame:
    """``(stratum, rule, cutoff, n_good, n_rejected)``: the chosen cutoffs.

    Every labelled good document that passes the base rules is in the holdout.
    Counting is one aggregation to (stratum, rule, value) with at most 1001
    values a rule; the choice sees these counts only.
    """
    is_good = labels.groupBy(F.col(key).alias("g_key")).agg(F.min(F.col(good)).alias("g_low")).where("g_low = 1")
    holdout = (stats.where(~base_failed()).join(is_good, F.col(key) == F.col("g_key"), "left_semi"))
    counts = (holdout.select(F.col(stratum).alias("stratum"), F.explode(F.create_map(
        *[x for r, e in RULES.items() for x in (F.lit(r), F.expr(e))])).alias("rule", "value"))
        .groupBy("stratum", "rule", "value").agg(F.count("*").alias("n")))
    grid = np.array(sorted(cutoffs))
    n_rules = len(RULES)
    tests = n_rules * len(grid) * stats.select(stratum).distinct().count()

    def choose(group: pa.Table) -> pa.Table:
        value, count = group["value"].to_numpy(), group["n"].to_numpy()
        n = int(count.sum())
        allowed = most_rejections(n, risk / n_rules, delta / tests)
        rejected = np.array([count[value > c].sum() for c in grid])
        chosen = np.flatnonzero(rejected <= allowed)[:1]
        of = group.select(["stratum", "rule"]).slice(0, len(chosen))
        for name, found in (("cutoff", grid[chosen]), ("n_good", np.full(len(chosen), n)), ("n_rejected", rejected[chosen])):
            of = of.append_column(name, pa.array(found, type=pa.int64()))
        return of

    kind = stats.schema[stratum].dataType.simpleString()
    return (counts.groupBy("stratum", "rule")
            .applyInArrow(choose, f"stratum {kind}, rule string, cutoff long, n_good long, n_rejected long"))


def verdicts(stats: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``stats`` with ``base_failed``, ``kept`` and ``rejected_by`` (the first rule above its cutoff)."""
    limits = cutoffs.groupBy(F.col("stratum").alias("limit_of")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    joined = stats.join(limits, F.col(stratum).eqNullSafe(F.col("limit_of")), "left")
    over = [F.when(F.expr(e) > F.col("limits")[r], F.lit(r)) for r, e in RULES.items()]
    return (joined.withColumn("base_failed", base_failed())
            .withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(F.coalesce(*over)))
            .withColumn("kept", F.col("rejected_by").isNull())
            .drop("limits", "limit_of"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", **options) -> DataFrame:
    """Counts, base rules and risk-controlled verdicts of every document."""
    stats = written(text_stats(docs, (key, stratum)), "quality-stats")
    cutoffs = written(select_cutoffs(stats, labels, stratum, key, **options), "quality-cutoffs")
    return verdicts(stats, cutoffs, stratum)


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, judged row by row: no join by id."""
    rows = packed(docs, id=F.col(key), of=F.col(stratum), t=F.col(text))
    cutoffs = select_cutoffs(written(text_stats(rows, ("id", "of"), "t"), "quality-stats"), labels.withColumnRenamed(key, "id"), "of", "id", **options)
    judged = verdicts(text_stats(rows, ("row", "of"), "t"), written(cutoffs, "quality-cutoffs"), "of")
    return unpacked(judged.where("kept"))
