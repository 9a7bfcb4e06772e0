"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts are sets of five-word shingles.  Documents with equal sets are folded
into one representative first, so a group of copies costs one row.  Banded
MinHash values bring representatives together; inside a group of candidates
MinHash values are compared a few at a time, and a pair is dropped as soon as
the posterior probability (uniform prior) that its similarity reaches the
threshold is below ``tolerance``.  The pairs left are verified by their exact
shingle sets, and only links and their counts leave the task: no table of
candidate pairs exists.

Large groups are cut into blocks, bounded in shingles and in rows, by a hash of
the document and each pair of blocks is one unit of work, so that no task holds
a whole group.  Candidate
groups are the LSH buckets, or the connected components of the buckets where
comparing a whole component costs no more than comparing its buckets one by
one (near copies share most of their buckets).  Either way every pair that
shares a bucket is compared, in exactly one unit.

Defined cases: null and blank texts have no shingles, link to nothing and are
classes of their own; a text of one to four words is one shingle; repeated rows
are copies of each other; a null id takes part under a hash of its text, after
all ids, and comes out null; only id and text are read, so other columns cannot clash; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .store import packed, unpacked, written

THRESHOLD = 0.8
#: 32 bands of 4 values: a pair at similarity 0.8 shares no band with probability 5e-8
BANDS, ROWS = 32, 4
STEP = 16
TOLERANCE = 1e-7
#: shingles in a block of a candidate group, about 8 bytes each in memory and shuffle
BLOCK = 200_000
#: rows in a block, for short texts: a unit's arrays of pairs have about the square of it
BLOCK_ROWS = 2_000


def least_matches(threshold: float, tolerance: float, n: int) -> int:
    """Fewest matches among ``n`` MinHash values at which P(similarity >= threshold) >= tolerance.

    Under a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper
    tail at the threshold is P(Bin(n + 1, threshold) <= m).
    """
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


def _key(key: str, text: str) -> F.Column:
    """The id; for a row without one, a hash of its text from 2^62 up, after all ids."""
    return F.coalesce(F.col(key).cast("long"), F.xxhash64(F.col(text)).bitwiseAND((1 << 62) - 1) + F.lit(1 << 62))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(id, key, d1, d2, size, bands)`` of every row: a 128-bit digest of its shingle set, and its band keys."""
    source = docs.select(F.col(key).cast("long").alias("id"), _key(key, text).alias("key"), F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in W.slices(batch.column(2)):
                hashes, at = W.shingle_sets(w)
                d1, d2 = (_row_sums(W.mix(hashes ^ np.uint64(x)), at) for x in (0x243F6A8885A308D3, 0x13198A2E03707344))
                sig = W.minhash(hashes, at, bands * rows).reshape(hi - lo, bands, rows)
                key_ = np.zeros((hi - lo, bands), dtype=np.uint64)
                with np.errstate(over="ignore"):
                    for r in range(rows):
                        key_ = W.mix(key_ + sig[:, :, r].astype(np.uint64) + np.arange(bands, dtype=np.uint64) * np.uint64(0x100000001B3))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                     pa.array(np.diff(at).astype(np.int64)),
                     W.list_column(key_.view(np.int64).ravel(), np.arange(hi - lo + 1) * bands, pa.int64())],
                    names=["id", "key", "d1", "d2", "size", "bands"])

    return source.mapInArrow(run, "id long, key long, d1 long, d2 long, size long, bands array<long>")


def _row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    with np.errstate(over="ignore"):
        return sums[at[1:]] - sums[at[:-1]]


def candidate_groups(reps: DataFrame, block: int = BLOCK, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(key, groups)``: the candidate groups, with their block counts, of every representative that has a partner.

    Buckets with the same members count once.  ``reps`` has (key, size, bands).
    """
    held = reps.select("key", "size", F.explode("bands").alias("bucket"))
    stat = (held.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("size").alias("weight"), F.min("key").alias("low"),
        F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("members")).where("n > 1"))
    kept = stat.groupBy("n", "low", "members").agg(F.min("bucket").alias("bucket"), F.first("weight").alias("weight"))
    kept = written(kept.select("bucket", "n", "weight", "low"), "jaccard-buckets")
    member = written(held.join(kept, "bucket").select("key", "size", "bucket", "n", "weight", "low"), "jaccard-members")
    label = components(member.select(F.col("key").alias("u"), F.col("low").alias("v")), "jaccard-coarse")
    # whole components where that is no more work than their buckets one by one
    cost = (kept.join(label, F.col("low") == F.col("node")).groupBy("label").agg(
        F.sum(F.col("n").cast("double") * F.col("n")).alias("by_bucket")))
    sizes = (reps.select("key", "size").join(label, F.col("key") == F.col("node")).groupBy("label").agg(
        F.count("*").alias("c_n"), F.sum("size").alias("c_weight")))
    whole = written(cost.join(sizes, "label").where("cast(c_n as double) * c_n <= by_bucket")
                    .select(F.col("label").alias("c_label"), "c_n", "c_weight"), "jaccard-whole")
    of = label.join(whole, F.col("label") == F.col("c_label"), "left").select(
        F.col("node"), F.col("c_label"), "c_n", "c_weight")
    blocks = lambda w, n: F.greatest(F.ceil(F.col(w) / F.lit(block)), F.ceil(F.col(n) / F.lit(block_rows)))
    joined = member.join(of, F.col("key") == F.col("node"))
    group = F.when(F.col("c_label").isNull(), F.struct(F.col("bucket").alias("group"), blocks("weight", "n").alias("blocks"))).otherwise(
        F.struct(F.xxhash64("c_label").alias("group"), blocks("c_weight", "c_n").alias("blocks")))
    return joined.groupBy("key").agg(F.collect_set(group).alias("groups"))  # at most one entry a band


def _compare(batch_groups: Iterator[dict], threshold: float, tolerance: float) -> Iterator[pa.RecordBatch]:
    """Links of each unit (a pair of blocks of one candidate group)."""
    for g in batch_groups:
        a, b = g["side"] == 0, g["side"] == 1
        same = g["bi"] == g["bj"]
        left = np.flatnonzero(a)
        right = left if same else np.flatnonzero(b)
        if not len(left) or not len(right):
            continue
        found = _links(g, left, right, same, threshold, tolerance)
        if found is None:
            continue
        i, j = found
        key, copies = g["key"], g["copies"]
        links = np.zeros(len(key), dtype=np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        label = key.copy()
        while True:  # smallest key reached inside this unit
            new = label.copy()
            np.minimum.at(new, i, label[j])
            np.minimum.at(new, j, label[i])
            if (new == label).all():
                break
            label = new
        at = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(label[at]), pa.array(links[at])], names=["u", "v", "links"])


def _links(g: dict, left: np.ndarray, right: np.ndarray, same: bool, threshold: float, tolerance: float):
    sig, at, shingles, size = g["sig"], g["at"], g["shingles"], np.diff(g["at"])
    k = sig.shape[1]
    # sizes bound the similarity: a pair below size ratio t cannot reach it
    ok = np.minimum.outer(size[left], size[right]) >= threshold * np.maximum.outer(size[left], size[right]) - 1e-9
    if same:
        ok &= np.triu(np.ones_like(ok), 1)
    # a pair is compared in the first group that both are in
    mine, rows = g["groups"], np.repeat(np.arange(len(size)), np.diff(g["groups_at"]))
    rows, mine = rows[mine < g["group"]], mine[mine < g["group"]]
    order = np.argsort(mine, kind="stable")
    rows, mine = rows[order], mine[order]
    edges = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1], [True]])) if len(mine) else np.zeros(1, np.int64)
    place = np.full((2, len(size)), -1)
    place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
    many = np.flatnonzero(np.diff(edges) > 1)
    for a, b in zip(edges[many].tolist(), edges[many + 1].tolist()):
        own = rows[a:b]
        ok[np.ix_(place[0, own[place[0, own] >= 0]], place[1, own[place[1, own] >= 0]])] = False
    pi, pj = np.nonzero(ok)
    pi, pj = left[pi], right[pj]
    hits = np.zeros(len(pi), dtype=np.int64)
    for lo in range(0, k, STEP):
        if not len(pi):
            return None
        for p in range(0, len(pi), 1 << 16):
            s = slice(p, p + (1 << 16))
            hits[s] += (sig[pi[s], lo:lo + STEP] == sig[pj[s], lo:lo + STEP]).sum(axis=1)
        keep = hits >= least_matches(threshold, tolerance, min(lo + STEP, k))
        pi, pj, hits = pi[keep], pj[keep], hits[keep]
    if not len(pi):
        return None
    common = _common(at, shingles, pi, pj)
    good = common >= threshold * (size[pi] + size[pj] - common) - 1e-9
    return (pi[good], pj[good]) if good.any() else None


def _common(at: np.ndarray, shingles: np.ndarray, pi: np.ndarray, pj: np.ndarray) -> np.ndarray:
    """Shingles in common of each pair, by whichever of two exact ways costs less."""
    rows = np.unique(np.concatenate([pi, pj]))
    if len(pi) < 4 * len(rows):
        return np.array([len(np.intersect1d(shingles[at[x]:at[x + 1]], shingles[at[y]:at[y + 1]], assume_unique=True))
                         for x, y in zip(pi.tolist(), pj.tolist())], dtype=np.int64)
    flat = np.concatenate([shingles[at[x]:at[x + 1]] for x in rows])
    row = np.repeat(np.arange(len(rows)), (at[rows + 1] - at[rows]))
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    row, code = row[shared], np.unique(code[shared], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    out = np.zeros((len(rows), len(rows)), dtype=np.float32)
    for lo in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
        a, b = np.searchsorted(code, [lo, lo + 4096])
        part = np.zeros((len(rows), 4096), dtype=np.float32)
        part[row[a:b], code[a:b] - lo] = 1
        out += part @ part.T
    return np.rint(out[np.searchsorted(rows, pi), np.searchsorted(rows, pj)]).astype(np.int64)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Whole units, as numpy columns, from sorted batches; a unit may span batches."""
    carried: list[pa.RecordBatch] = []

    def last_unit(b: pa.RecordBatch) -> tuple:
        return tuple(b.column(c)[b.num_rows - 1].as_py() for c in ("group", "bi", "bj"))

    def cut(table: pa.Table) -> Iterator[dict]:
        cols = [table[c].to_numpy() for c in ("group", "bi", "bj")]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        edges = np.concatenate([[0], change, [table.num_rows]])
        keys = table["key"].to_numpy()
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            fresh = np.ones(hi - lo, dtype=bool)  # a repeated row of a representative counts once
            fresh[1:] = keys[lo + 1:hi] != keys[lo:hi - 1]
            part = table.slice(lo, hi - lo)
            if not fresh.all():
                part = part.filter(pa.array(fresh))
            if part.num_rows < 2:
                continue
            part = part.combine_chunks()
            shingles, groups = (_flat(part[c]) for c in ("shingles", "groups"))
            sig = np.frombuffer(b"".join(part["sig"].to_pylist()), dtype=np.uint32).reshape(part.num_rows, -1)
            yield {"group": int(cols[0][lo]), "bi": int(cols[1][lo]), "bj": int(cols[2][lo]),
                   "side": (part["block"].to_numpy() != cols[1][lo]).astype(np.int8), "key": part["key"].to_numpy().copy(),
                   "copies": part["copies"].to_numpy(), "sig": sig, "shingles": shingles[0], "at": shingles[1],
                   "groups": groups[0], "groups_at": groups[1]}

    for batch in batches:
        if not batch.num_rows:
            continue
        if carried and last_unit(carried[-1]) != tuple(batch.column(c)[0].as_py() for c in ("group", "bi", "bj")):
            yield from cut(pa.Table.from_batches(carried))
            carried = []
        # all but the last unit of the batch is whole
        cols = [batch.column(c).to_numpy() for c in ("group", "bi", "bj")]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        if len(change):
            yield from cut(pa.Table.from_batches([*carried, batch.slice(0, int(change[-1]))]))
            carried = [batch.slice(int(change[-1]))]
        else:
            carried.append(batch)
    if carried:
        yield from cut(pa.Table.from_batches(carried))


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    arrays = [column.chunk(i) for i in range(column.num_chunks)]
    values = [a.flatten().to_numpy() for a in arrays]
    lengths = np.concatenate([a.value_lengths().to_numpy() for a in arrays])
    return np.concatenate(values), np.concatenate([[0], np.cumsum(lengths)])


def links(docs: DataFrame, reps: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
          tolerance: float = TOLERANCE, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(u, v, links)``: linked representatives with a smaller or equal one reached, and documents linked to, by unit."""
    groups = candidate_groups(reps, block, block_rows)
    payload = (docs.select(_key(key, text).alias("k"), F.col(text).alias("t"))
               .join(groups.join(reps.select("key", "copies"), "key"), F.col("k") == F.col("key"))
               .select("key", "copies", "groups", "t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in W.slices(batch.column(3)):
                hashes, at = W.shingle_sets(w)
                sig = W.minhash(hashes, at, bands * rows)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in range(3)),
                     pa.array([x.tobytes() for x in sig], type=pa.binary()), W.list_column(hashes.view(np.int64), at, pa.int64())],
                    names=["key", "copies", "groups", "sig", "shingles"])

    kind = "key long, copies long, groups array<struct<group: long, blocks: long>>, sig binary, shingles array<long>"
    sets = payload.mapInArrow(run, kind)
    each = sets.select("key", "copies", "sig", "shingles", F.transform("groups", lambda g: g["group"]).alias("groups"),
                       F.explode("groups").alias("g"))
    each = each.withColumn("group", F.col("g.group")).withColumn("block", F.pmod(F.xxhash64("key", "group"), F.col("g.blocks")))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g.blocks") - 1)))
    units = each.select("group", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block",
                        "key", "copies", "groups", "sig", "shingles")
    ordered = units.repartition("group", "bi", "bj").sortWithinPartitions("group", "bi", "bj", "key")
    return ordered.mapInArrow(lambda b: _compare(_units(b), threshold, tolerance), "u long, v long, links long")


def _classes(docs: DataFrame, key: str, text: str, **options) -> DataFrame:
    """``(id, key, class_id, copy_of, n_links)`` of every row."""
    prints = written(fingerprints(docs, key, text), "jaccard-prints")
    reps = written(prints.where("size > 0").groupBy("d1", "d2").agg(
        F.min("key").alias("key"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands")), "jaccard-reps")
    found = written(links(docs, reps, key, text, **options), "jaccard-links")
    label = components(found.select("u", "v"), "jaccard-classes")
    total = found.groupBy("u").agg(F.sum("links").alias("links"))
    info = (reps.select("d1", "d2", "copies", F.col("key").alias("copy_of"))
            .join(label, F.col("copy_of") == F.col("node"), "left").join(total, F.col("copy_of") == F.col("u"), "left")
            .select(F.col("d1").alias("e1"), F.col("d2").alias("e2"), "copy_of", F.coalesce("label", "copy_of").alias("class_id"),
                    (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    joined = prints.select("id", "key", "size", "d1", "d2").join(
        info, (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2")) & (F.col("size") > 0), "left")
    return joined.select("id", "key", F.coalesce("class_id", "key").alias("class_id"), F.coalesce("copy_of", "key").alias("copy_of"),
                         F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: ``key``, ``class_id`` (smallest id of its linked group), ``copy_of``
    (smallest id with the same shingles) and ``n_links`` (documents at or above the threshold)."""
    return _classes(docs, key, text, **options).withColumnRenamed("id", key).select(key, "class_id", "copy_of", "n_links")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class: that with the smallest id (rows without id come last; repeated rows count once)."""
    found = written(_classes(docs, key, text, **options), "jaccard-found")
    gone = found.where("class_id <> key").select(F.col("key").alias("gone_key")).distinct()
    again = written(found.groupBy(F.col("key").alias("again_key")).count().where("count > 1").select("again_key"), "jaccard-again")
    # what goes grows with the table: the join is by key at every size
    kept = packed(docs, key=_key(key, text), t=F.col(text)).join(gone.hint("merge"), F.col("key") == F.col("gone_key"), "left_anti")
    if again.isEmpty():
        return unpacked(kept)
    once = kept.join(again, F.col("key") == F.col("again_key"), "left_anti")
    return unpacked(once.unionAll(kept.join(again, F.col("key") == F.col("again_key"), "left_semi").dropDuplicates(["key", "t"])))
