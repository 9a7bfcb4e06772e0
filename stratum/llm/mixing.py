"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

Every document of a source should appear ``target / source_size`` times: a
whole number of copies plus a fraction.  Fractions are rounded in pairs: words
move at random from one document's fraction to the other's until one of them is
0 or 1, which keeps the source's words and every document's expectation.  A
cell of a few hundred documents is reduced to one that is still fractional; the
residuals of the cells form the cells of the next level, up to one residual a
source, which a coin with its own probability settles.

Long documents would leave long residuals, so documents are rounded in tiers of
size, the longest first; the words by which a tier missed its share are spread
over the fractions of the next.  What a source finally misses is about one of
its shortest documents.

Randomness is a hash of a seed and of each row's id, size and number among the
rows that share both: reruns agree.  Cells are dealt by such a hash, so a source
that holds a third of all rows is many cells, whether or not its ids differ.

Defined cases: null text has size 0; documents of size 0 are taken 0 times; a
null source is a source of its own, last in order; a source without words has
target 0; repeated rows are rounded one by one; a null id is an id of its own;
only id, text and source are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import packed, unpacked, written

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
CELL = 256
#: tiers of size, longest first: each begins at this many words
TIERS = (2048, 512, 128, 32, 1)
SEED = 20

_WORD = r"[^\x20\x09-\x0D]+"
_ELEMENT = "struct<id: bigint, size: bigint, twin: bigint, p: double>"
#: rows that one row of a table is unfolded to at once
_STEP = 1 << 14
#: lanes in which rows that share id, source and size are numbered
_LANES = 4096


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(id, source, size)`` with the number of words of every whole text."""
    return docs.select(F.col(key).cast("long").alias("id"), F.col(source).alias("source"),
                       F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MAX_COPIES) -> DataFrame:
    """``(of, number, source_size, target)``: a row a source; shares by weight of all words, at most ``most`` times a source's size.

    Sources in order of how few words a unit of weight may take fill up one
    after the other; the first that does not fill fixes the share of the rest.
    """
    by_name = Window.orderBy(F.col("of").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = (sized.groupBy(F.col("source").alias("of")).agg(F.sum("size").alias("source_size"))
            .withColumn("number", F.row_number().over(by_name))
            .withColumn("weight", F.element_at(cycle, F.pmod(F.col("number") - 1, F.lit(len(weights))).cast("int") + 1))
            .withColumn("most", F.lit(float(most)) * F.col("source_size")))
    order = Window.orderBy(F.col("most") / F.col("weight"), "number")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    rows = (rows.withColumn("total", F.sum("source_size").over(every))
            .withColumn("share", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest)))
    level = F.min(F.when(F.col("share") * F.col("weight") < F.col("most"), F.struct(F.col("most") / F.col("weight"), "number", "share"))).over(every)["share"]
    return (rows.withColumn("level", level)
            .withColumn("target", F.coalesce(F.least("most", F.col("level") * F.col("weight")), "most"))
            .select("of", "number", "source_size", "target"))


def _uniform(*cols: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *cols), 11).cast("double") / F.lit(float(1 << 53))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _clip(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def _name(e: Column) -> tuple[Column, ...]:
    """What tells an element from the others; a null id has a value of its own."""
    return F.coalesce(e["id"], F.lit(0).cast("long")), e["id"].isNull(), e["size"], e["twin"]


def numbered(held: DataFrame) -> DataFrame:
    """``held`` with ``twin``: rows that are equal in all columns are numbered from 0, by counting them and unfolding the counts."""
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(_STEP).cast("long")))
    steps = held.groupBy(*held.columns).agg(F.count("*").alias("rows")).select(*held.columns, "rows", start.alias("start"))
    last = F.least(F.col("rows"), F.col("start") + _STEP) - 1
    return steps.select(*held.columns, F.explode(F.sequence("start", last)).alias("twin"))


def _pair(state: Column, new: Column, level: int) -> Column:
    """Move words between the current fraction and the next one until one of them is 0 or 1."""
    c = state["cur"]
    moves = F.struct(
        F.least(c["size"] * (1 - c["p"]), new["size"] * new["p"]).alias("up"),
        F.least(c["size"] * c["p"], new["size"] * (1 - new["p"])).alias("down"),
        _uniform(F.lit(level), *_name(c), *_name(new)).alias("u"))

    def moved(m: Column) -> Column:
        up = m["u"] * (m["up"] + m["down"]) < m["down"]
        full, empty = m["up"] >= c["size"] * (1 - c["p"]), m["down"] >= c["size"] * c["p"]
        cp = F.when(up, F.when(full, F.lit(1.0)).otherwise(_clip(c["p"] + m["up"] / c["size"]))).otherwise(
            F.when(empty, F.lit(0.0)).otherwise(_clip(c["p"] - m["down"] / c["size"])))
        np_ = F.when(up, F.when(full, _clip(new["p"] - m["up"] / new["size"])).otherwise(F.lit(0.0))).otherwise(
            F.when(empty, _clip(new["p"] + m["down"] / new["size"])).otherwise(F.lit(1.0)))
        return F.struct(F.struct(c["id"].alias("id"), c["size"].alias("size"), c["twin"].alias("twin"), cp.alias("p")).alias("a"),
                        F.struct(new["id"].alias("id"), new["size"].alias("size"), new["twin"].alias("twin"), np_.alias("p")).alias("b"))

    def settled(x: Column) -> Column:
        done = x["a"]["p"].isin(0.0, 1.0)
        return F.struct(F.when(done, x["b"]).otherwise(x["a"]).alias("cur"),
                        F.concat(state["out"], F.array(F.when(done, x["a"]).otherwise(x["b"]))).alias("out"))

    return _let(moves, lambda m: _let(moved(m), settled))


def _reduce(elements: DataFrame, level: int) -> DataFrame:
    """One level of the tree: ``(number, cell, cur, out)`` from ``(number, cell, e)``."""
    groups = elements.groupBy("number", "cell").agg(F.collect_list(F.struct(F.xxhash64(*_name(F.col("e"))).alias("h"), "e")).alias("es"))
    es = F.transform(F.array_sort("es"), lambda x: x["e"])
    first = F.struct(F.element_at("sorted", 1).alias("cur"), F.array().cast(f"array<{_ELEMENT}>").alias("out"))
    state = F.aggregate(F.slice("sorted", F.lit(2), F.size("sorted")), first, lambda s, e: _pair(s, e, level))
    return groups.select("number", "cell", es.alias("sorted")).select("number", "cell", state.alias("s")).select("number", "cell", "s.cur", "s.out")


def _round_tier(elements: DataFrame, most: int, tier: int, cell: int) -> DataFrame:
    """``(number, id, size, p)`` with p 0 or 1 for every element of a tier; ``most``: elements of its largest source."""
    now, level, parts = elements, 0, []
    cells = -(-most // cell)
    while True:
        done = written(_reduce(now, tier * 100 + level), f"mix-{tier}-{level}")
        parts.append(done.select("number", F.inline("out")).drop("twin"))
        if cells <= 1:
            break
        now = done.select("number", F.floor(F.col("cell") / cell).alias("cell"), F.col("cur").alias("e"))
        cells, level = -(-cells // cell), level + 1
    coin = F.when(F.col("cur.p") > _uniform(F.lit(tier), F.col("number"), *_name(F.col("cur"))), F.lit(1.0)).otherwise(F.lit(0.0))
    parts.append(done.select("number", "cur.id", "cur.size", coin.alias("p")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS,
        most: float = MAX_COPIES, cell: int = CELL, tiers: Sequence[int] = TIERS) -> DataFrame:
    """``(key, size, source, source_size, target, copies, taken)``: how often the mix takes every document, a row an input row."""
    sized = written(sizes(docs, key, text, source), "mix-sizes")
    goal = written(targets(sized, weights, most).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
                   .withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole")), "mix-goals")
    tier = F.lit(len(tiers) - 1)
    for k in reversed(range(len(tiers) - 1)):
        tier = F.when(F.col("size") >= tiers[k], F.lit(k)).otherwise(tier)
    held = sized.join(goal.select("of", "number"), F.col("source").eqNullSafe(F.col("of"))).withColumn("tier", tier)
    held = written(numbered(held.select("id", "size", "number", "tier")), "mix-elements")
    shape = held.where("size > 0").groupBy("number", "tier").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    shape = written(shape, "mix-shape")
    most_of = {r["tier"]: r["n"] for r in shape.groupBy("tier").agg(F.max("n").alias("n")).collect()}  # a row a tier
    settled: list[DataFrame] = []
    for k in sorted(most_of):
        # the fraction that meets the source's words, given what longer tiers took and what shorter ones are to take
        here = shape.where(F.col("tier") == k).select("number", "n", F.col("words").alias("m"))
        after = shape.where(F.col("tier") > k).groupBy("number").agg(F.sum("words").alias("m_after"))
        plan = goal.select("number", "p", (F.col("target") - F.col("whole") * F.col("source_size")).alias("left")).join(here, "number").join(after, "number", "left")
        if settled:
            took = settled[0]
            for x in settled[1:]:
                took = took.unionAll(x)
            plan = plan.join(took.groupBy("number").agg(F.sum(F.col("size") * F.col("p")).alias("took")), "number", "left")
        else:
            plan = plan.withColumn("took", F.lit(0.0))
        need = F.col("left") - F.coalesce("took", F.lit(0.0)) - F.col("p") * F.coalesce("m_after", F.lit(0))
        plan = plan.select("number", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / cell)).alias("cells"),
                           F.when(F.col("p") > 0, _clip(need / F.col("m"))).otherwise(F.lit(0.0)).alias("q"))
        plan = written(plan, f"mix-plan-{k}")  # a row a source: its size is known before the join
        elements = held.where((F.col("tier") == k) & (F.col("size") > 0)).join(plan, "number").select(
            "number", "cells", F.struct("id", "size", "twin", F.col("q").alias("p")).alias("e"))
        elements = elements.select("number", F.pmod(F.xxhash64(F.lit(SEED), *_name(F.col("e"))), F.col("cells")).alias("cell"), "e")
        settled.append(_round_tier(elements, most_of[k], k, cell))
    out = held.where("size = 0").select("number", "id", "size", F.lit(0.0).alias("p"))
    for x in settled:
        out = out.unionAll(x)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("rounded").cast("long")).otherwise(F.lit(0)).cast("long")
    return (out.withColumnRenamed("p", "rounded").join(goal, "number")
            .select(F.col("id").alias(key), "size", F.col("of").alias(source), "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken")))


def _placed(df: DataFrame, by: Sequence[str], name: str, place: str) -> DataFrame:
    """``df`` with ``place``, the number from 1 of a row among those that share ``by``; a group is numbered in ``_LANES`` lanes."""
    held = written(df.withColumn("lane", F.pmod(F.monotonically_increasing_id(), F.lit(_LANES))), name)
    in_lane = Window.partitionBy(*by, "lane").orderBy(F.lit(0))
    lanes = held.groupBy(*by, "lane").agg(F.count("*").alias("n")).select(
        *[F.col(c).alias(f"g_{c}") for c in by], F.col("lane").alias("g_lane"),
        (F.sum("n").over(Window.partitionBy(*by).orderBy("lane")) - F.col("n")).alias("before"))  # a row a lane
    same = F.col("lane") == F.col("g_lane")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"g_{c}"))
    return held.withColumn("in_lane", F.row_number().over(in_lane)).join(lanes, same).withColumn(place, F.col("before") + F.col("in_lane")).select(*df.columns, place)


def repeat(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its copies say."""
    mixed = written(mix(docs, key, text, source, **options).select(F.col(key).alias("m_key"), F.col("size").alias("m_size"), F.col(source).alias("m_source"), "copies"), "mix-copies")
    many = mixed.groupBy("m_key").count().where("count > 1 or m_key is null").select(F.col("m_key").alias("r_key"))
    many = written(many, "mix-repeated")
    rows = packed(docs, k=F.col(key).cast("long"), t=F.col(text), s=F.col(source))
    # the outcomes grow with the table: the join is by key at every size
    single = mixed.join(many, F.col("m_key").eqNullSafe(F.col("r_key")), "left_anti").hint("merge")
    once = rows.join(single, F.col("k") == F.col("m_key"))
    # rows that share id, source and size: the n-th of them gets the n-th outcome
    size = F.coalesce(F.regexp_count("t", F.lit(_WORD)), F.lit(0)).cast("long")
    twin = _placed(rows.join(many, F.col("k").eqNullSafe(F.col("r_key")), "left_semi").withColumn("size", size), ["k", "s", "size"], "mix-twins", "place")
    outcome = _placed(mixed.join(many, F.col("m_key").eqNullSafe(F.col("r_key")), "left_semi"), ["m_key", "m_source", "m_size"], "mix-outcomes", "o_place")
    twins = twin.join(outcome, F.col("k").eqNullSafe(F.col("m_key")) & F.col("s").eqNullSafe(F.col("m_source"))
                      & (F.col("size") == F.col("m_size")) & (F.col("place") == F.col("o_place")))
    taken = once.select("row", "copies").unionAll(twins.select("row", "copies")).where("copies > 0")
    return unpacked(taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
