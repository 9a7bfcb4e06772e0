"""Ranked lexical search: branch and bound over a tree of frequency-ordered documents.

The items are the stated query set, taken in blocks of a bounded number of
words.  A first pass over all documents keeps of each text its length and its
counts of the block's terms (its restricted vector), and with them the number
and length of all documents and each term's document frequency.  A document's
terms in order of falling frequency are its path; documents are range
partitioned by path (and row, so that copies of one text spread too), and each
task builds a prefix tree over its sorted paths.  A node is a shared beginning,
or a few small siblings; it holds for every term below it the largest count
and for all documents the smallest length norm ``m``.  A term's score grows with its count
and falls with ``m``, so these give an upper bound for an item over the whole
subtree.  Each item walks the tree depth first, best bound first, and leaves out
subtrees whose bound is below its ``k``-th best score so far; the last level
scores the documents themselves, so every score returned is exact.

Bounds and scores are 64-bit integers.  A subtree is skipped only when its bound
is below the ``k``-th score, never when equal: a tie may win by its id.  A task
holds ``CHUNK`` postings at once, whatever the size of its partition, and hands
on ``k`` rows an item and chunk; these are merged in lanes before the last merge.

Defined cases: null texts and texts without a term count as no document and are
never found; every row of either table stands for itself, so repeated ids are
ranked row by row and repeated items are reported each; equal scores go by
ascending id, rows without id last; items without a term of the corpus find
nothing; empty tables give an empty result; only id and text columns are read.
Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .store import written

TOP = 20
#: words of items in a block: their terms and weights go to every task
BLOCK_WORDS = 1_000_000
#: (document, term) pairs of a tree
CHUNK = 2_000_000
#: documents that a node of the last level holds, if their paths differ
LEAF = 128
#: bytes of a path (four a term) by which documents are dealt to tasks
DEALT_BYTES = 64
#: lanes of the first merge
LANES = 64


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norm(n: np.ndarray, n_docs: int, length: int) -> np.ndarray:
    """Length norm of documents of ``n`` terms, ``length`` being that of all documents."""
    return 100 - 25 + 25 * n * n_docs // length


def _part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


@dataclass
class Items:
    """Terms of the items of a block, by place in ``known``: those of item ``r`` are ``first[r]:first[r + 1]``, with repeats in ``times``."""

    known: np.ndarray
    term: np.ndarray
    times: np.ndarray
    first: np.ndarray


def _items(texts: pa.Array) -> Items:
    words = [(lo, w) for lo, _, w in W.slices(texts, W.FOLDED, True)]
    hashes = np.concatenate([w.hash for _, w in words]) if words else np.zeros(0, np.uint64)
    rows = np.concatenate([lo + w.row_of() for lo, w in words]) if words else np.zeros(0, np.int64)
    known, term = np.unique(hashes, return_inverse=True)
    pair, times = np.unique(rows * max(1, len(known)) + term, return_counts=True)
    rows, term = np.divmod(pair, max(1, len(known)))
    return Items(known, term, times, np.searchsorted(rows, np.arange(len(texts) + 1)))


def _vectors(known: Broadcast):
    """Rows ``(k, u, n, term, tf)``: length and restricted vector of each document with a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = known.value
        for batch in batches:
            for lo, hi, w in W.slices(batch.column(2), W.FOLDED, True):
                place = np.minimum(np.searchsorted(terms, w.hash), max(0, len(terms) - 1))
                hit = np.flatnonzero(terms[place] == w.hash) if len(terms) else np.zeros(0, np.int64)
                pair, tf = np.unique(w.row_of()[hit] * max(1, len(terms)) + place[hit], return_counts=True)
                row, term = np.divmod(pair, max(1, len(terms)))
                offsets = np.searchsorted(row, np.arange(hi - lo + 1))
                out = pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(w.counts()),
                     W.list_column(term, offsets, pa.int32()), W.list_column(tf, offsets, pa.int32())],
                    names=["k", "u", "n", "term", "tf"])
                yield out.filter(pa.array(w.counts() > 0))

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])


def _paths(rank: Broadcast, n_docs: int, length: int):
    """Rows ``(k, u, m, path, tf)``: the path is the terms' frequency ranks, big-endian, so that bytes sort as ranks do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, offsets = _flat(batch.column(3))
            tf = batch.column(4).flatten().to_numpy()
            ranks = rank.value[term]
            rows = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            order = np.lexsort((ranks, rows))
            data = pa.py_buffer(ranks[order].astype(">u4").tobytes())
            path = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((4 * offsets).astype(np.int32).tobytes()), data])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(norm(batch.column(2).to_numpy(), n_docs, length)), path,
                 W.list_column(tf[order], offsets, pa.int32())], names=["k", "u", "m", "path", "tf"])

    return run


@dataclass
class Node:
    """Entries ``(term, child, tf)`` in order of term: largest count of a term below each child.

    Children are nodes, or from ``lo`` on the documents themselves.
    """

    term: np.ndarray
    child: np.ndarray
    tf: np.ndarray
    m: np.ndarray
    children: list[int]
    lo: int

    def scores(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Upper bound (documents: score) of each child for the item with these terms."""
        lo, hi = np.searchsorted(self.term, terms, "left"), np.searchsorted(self.term, terms, "right")
        times = hi - lo
        at = np.arange(int(times.sum())) + np.repeat(lo - np.cumsum(times) + times, times)
        child = self.child[at]
        out = np.zeros(len(self.m), dtype=np.int64)
        np.add.at(out, child, np.repeat(weights, times) * _part(self.tf[at], self.m[child]))
        return out


def build_tree(starts: np.ndarray, ranks: np.ndarray, tf: np.ndarray, m: np.ndarray, leaf: int = LEAF) -> list[Node]:
    """Nodes of the prefix tree over sorted paths ``ranks[starts[d]:starts[d + 1]]``, the root first."""
    spans: list[tuple[int, int, list[int]]] = []
    todo = [(0, len(m), 0, -1)]
    while todo:
        lo, hi, depth, parent = todo.pop()
        if parent >= 0:
            spans[parent][2].append(len(spans))
        me = len(spans)
        spans.append((lo, hi, []))
        if hi - lo <= leaf:
            continue
        first, last = ranks[starts[lo]:starts[lo + 1]], ranks[starts[hi - 1]:starts[hi]]
        shared = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:shared] != last[depth:shared])
        depth = depth + int(differ[0]) if len(differ) else shared
        if depth == len(last):
            continue  # one path for all
        at = starts[lo:hi] + depth
        step = np.where(at < starts[lo + 1:hi + 1], ranks[np.minimum(at, len(ranks) - 1)], -1)
        begin, before = lo, lo
        for end in (lo + 1 + np.flatnonzero(step[1:] != step[:-1])).tolist() + [hi]:
            if end - begin > leaf and begin < before:
                todo.append((begin, before, depth, me))
                begin = before
            before = end
        todo.append((begin, hi, depth, me))
    nodes: list[Node | None] = [None] * len(spans)
    below: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
    for i in range(len(spans) - 1, -1, -1):  # children come after their parent
        lo, hi, children = spans[i]
        if children:
            parts = [below.pop(c) for c in children]
            term, most = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            sizes, norms = [len(p[0]) for p in parts], np.array([p[2] for p in parts])
        else:
            term, most = ranks[starts[lo]:starts[hi]], tf[starts[lo]:starts[hi]]
            sizes, norms = np.diff(starts[lo:hi + 1]), m[lo:hi]
        order = np.argsort(term, kind="stable")
        term, most, child = term[order], most[order], np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
        nodes[i] = Node(term, child, most, norms, children, lo)
        edges = np.flatnonzero(np.append(True, term[1:] != term[:-1])[:len(term)])
        below[i] = term[edges], np.maximum.reduceat(most, edges) if len(edges) else most, int(norms.min())
    return nodes


def branch_and_bound(nodes: list[Node], terms: np.ndarray, weights: np.ndarray, best: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and scores that can be among the ``k`` best.

    ``best``: a heap of the best scores so far, of other trees too; it is brought up to date.
    """
    docs, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    floor = best[0] if len(best) == k else 1
    stack = [(np.iinfo(np.int64).max, 0)]
    while stack:
        bound, i = stack.pop()
        if bound < floor:
            continue
        node = nodes[i]
        found = node.scores(terms, weights)
        ok = np.flatnonzero(found >= floor)
        if node.children:
            stack += [(int(found[c]), node.children[c]) for c in ok[np.argsort(found[ok])].tolist()]
            continue
        docs.append(ok + node.lo)
        scores.append(found[ok])
        for s in np.sort(found[ok])[::-1][:k].tolist():
            if len(best) < k:
                heapq.heappush(best, s)
            elif s > best[0]:
                heapq.heapreplace(best, s)
        floor = best[0] if len(best) == k else 1
    found, score = np.concatenate(docs), np.concatenate(scores)
    return found[score >= floor], score[score >= floor]


def _search(sent: Broadcast, k: int, chunk: int):
    """Rows ``(item, k, u, score)``: for each item and tree the documents that can be among the ``k`` best."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(4).flatten())
            if size >= chunk:
                yield pa.Table.from_batches(held)
                held, size = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = sent.value
        best: list[list[int]] = [[] for _ in items]
        for rows in trees(batches):
            rows = rows.combine_chunks()
            tf, starts = _flat(rows["tf"].combine_chunks())
            ranks = np.frombuffer(b"".join(rows["path"].to_pylist()), dtype=">u4").astype(np.int32)
            place = np.empty(rows.num_rows, dtype=np.int64)  # among equal scores
            place[pc.sort_indices(rows, [("k", "ascending"), ("u", "ascending")]).to_numpy()] = np.arange(rows.num_rows)
            nodes = build_tree(starts, ranks, tf.astype(np.int64), rows["m"].to_numpy())
            for number, (terms, weights) in enumerate(items):
                docs, scores = branch_and_bound(nodes, terms, weights, best[number], k)
                top = np.lexsort((place[docs], -scores))[:k]
                if len(top):
                    taken = rows.select(["k", "u"]).take(pa.array(docs[top])).combine_chunks().to_batches()[0]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top), number)), *taken.columns, pa.array(scores[top])],
                                                     names=["item", "k", "u", "score"])

    return run


def _best(rows: DataFrame, by: list, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("k"), "u")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, block: pa.Table, key: str, text: str, k: int, chunk: int) -> DataFrame | None:
    spark = docs.sparkSession
    items = _items(block["t"].combine_chunks())
    source = docs.select(F.col(key).alias("k"), F.monotonically_increasing_id().alias("u"), F.col(text).alias("t"))
    kind = source.schema["k"].dataType.simpleString()
    vectors = written(source.mapInArrow(_vectors(spark.sparkContext.broadcast(items.known)), f"k {kind}, u long, n long, term array<int>, tf array<int>"),
                      "lexical-vectors")
    n_docs, length, pairs = vectors.agg(F.count("*"), F.sum("n"), F.sum(F.size("term"))).first()
    if not pairs:
        return None
    counted = vectors.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()  # a row a term of the block
    df = np.zeros(len(items.known), dtype=np.int64)
    df[counted["term"].to_numpy()] = counted["df"].to_numpy()
    rank = np.empty(len(df), dtype=np.int32)
    rank[np.lexsort((items.known, -df))] = np.arange(len(df))
    weights = np.array([weight(n_docs, int(n)) for n in df], dtype=np.int64)
    sent = []
    for lo, hi in zip(items.first[:-1], items.first[1:]):
        term, times = items.term[lo:hi], items.times[lo:hi]
        used = df[term] > 0
        order = np.argsort(rank[term[used]])
        sent.append((rank[term[used]][order], (times * weights[term])[used][order]))
    paths = (vectors.where(F.size("term") > 0).mapInArrow(_paths(spark.sparkContext.broadcast(rank), n_docs, length),
                                                          f"k {kind}, u long, m long, path binary, tf array<int>"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pairs // chunk))
    # the first terms of a path deal it out: what the planner samples for the bounds is as short
    dealt = paths.repartitionByRange(parts, F.substring("path", 1, DEALT_BYTES), "u").sortWithinPartitions("path", "u")
    found = written(dealt.mapInArrow(_search(spark.sparkContext.broadcast(sent), k, chunk), f"item long, k {kind}, u long, score long"), "lexical-found")
    lanes = _best(found, ["item", F.pmod(F.xxhash64("u"), F.lit(LANES))], k)
    return _best(lanes.drop("rank"), ["item"], k)


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
           k: int = TOP, block_words: int = BLOCK_WORDS, chunk: int = CHUNK) -> DataFrame:
    """``(item_key, rank, key, score)``: the ``k`` best documents with a score above 0 for each row of ``items``."""
    spark = docs.sparkSession
    asked = written(items.select(F.col(item_key).alias("i"), F.col(item_text).alias("t"), F.monotonically_increasing_id().alias("q")), "lexical-items")
    total = asked.agg(F.sum(F.regexp_count("t", F.lit("[\\p{Alnum}[^\\x00-\\x7F]]+")))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    out = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).toArrow()  # about block_words words
        part = _block(docs, block, key, text, k, chunk)
        if part is not None:
            ids = spark.createDataFrame(pa.table({"item": pa.array(np.arange(block.num_rows)), "i": block["i"]}))
            part = part.join(ids, "item").select(F.col("i").alias("i"), F.col("rank").cast("int").alias("rank"), "k", "score")
            out = part if out is None else out.unionAll(part)
    if out is None:
        out = spark.createDataFrame([], f"i {asked.schema['i'].dataType.simpleString()}, rank int, k {docs.schema[key].dataType.simpleString()}, score long")
    return out.select(F.col("i").alias(item_key), "rank", F.col("k").alias(key), "score")
