"""URL filters as a sort-merge range join on reversed-host keys.

A rule names a host and the beginning of a path; it fits the host and all its
subdomains.  Its key is the host's labels in reverse and its path
(``example.org/en/`` -> ``org/example?/en/``), and the keys that begin with it
are an interval in sorted order.  A host holds neither ``/`` nor ``?``, so no
label or path can be taken for another.  Every distinct host and path of the table
gives one key per host suffix (``www.example.org`` -> org, example.org,
www.example.org).  Rules and keys are sorted together by range partition; a
sweep keeps the stack of rules whose interval is open, and the top of the stack
is the longest rule for the key.

A partition begins inside intervals opened before it.  The rules that are a
prefix of its first key are found by an equality join of that key's prefixes
with the rules, so a task gets as many rules as nest there and no table of all
rules is sent around.  A host with a third of all rows spreads over partitions,
for keys are sorted by path as well.

Defined cases: a null url, or one without ``://``, has an empty host and path
and fits no rule (such rows take no part in the join); rules without a host, or with one that no
url can have, fit nothing; rules given twice count
once (a rule given both verdicts blocks); repeated rows are judged each; other
columns are not read; without rules every row has the default verdict.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import checkpointed, written

DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), "/")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``(host, path, verdict)`` rows from a short list."""
    rows = json.dumps([dict(zip(("host", "path", "verdict"), r)) for r in rules])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<host: string, path: string, verdict: string>>")))


def _keys(points: DataFrame) -> DataFrame:
    """One row per host suffix of ``(host, path)``."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(F.reverse(labels), F.lit(1), n), "/"))
    return points.where("host <> ''").withColumn("suffix", F.explode(suffixes)).select(
        F.concat("suffix", F.lit("?"), "path").alias("key"), F.lit(1).alias("kind"), "host", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))


def _sweep(opened: dict[int, list[tuple[str, str, str]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack = list(opened.get(TaskContext.get().partitionId(), ()))
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for key, kind, host, path, rule, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, rule, verdict))
                elif stack:
                    for column, value in zip(out, (host, path, stack[-1][1], stack[-1][2])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.string()) for c in out], names=["host", "path", "rule", "verdict"])

    return run


def match(points: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, path, rule, verdict)`` of every distinct ``(host, path)`` that a rule fits: the longest rule."""
    known = written(
        rules.where("host is not null and host <> '' and not host rlike '[/?#]'").select(F.translate("host", _UPPER, _LOWER).alias("host"),
                                                              F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block wins over allow
        .select(F.concat(_reversed(F.col("host")), F.lit("?"), "path").alias("key"), F.concat("host", "path").alias("rule"), "verdict"), "url-rules")
    opening = known.select("key", F.lit(0).alias("kind"), F.lit("").alias("host"), F.lit("").alias("path"), "rule", "verdict")
    order = ["key", "kind", "host", "path"]
    swept = checkpointed(_keys(points).unionAll(opening).repartitionByRange(*order).sortWithinPartitions(*order))
    first = swept.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("first"))
    prefixes = first.select("part", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("first"))),
                                                          lambda n: F.substring("first", F.lit(1), n))).alias("p"))
    opened: dict[int, list] = {}  # a row a partition and rule nested around its first key
    for r in prefixes.join(known, F.col("p") == F.col("key")).select("part", "key", "rule", "verdict").collect():
        opened.setdefault(r["part"], []).append((r["key"], r["rule"], r["verdict"]))
    for rows in opened.values():
        rows.sort(key=lambda r: len(r[0]))
    found = swept.mapInArrow(_sweep(opened), "host string, path string, rule string, verdict string")
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")
    return found.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``(key, host, path, rule, verdict)`` of every row."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("id"), host.alias("host"), path.alias("path"))
    found = written(match(rows.select("host", "path").distinct(), rules), "url-matches")
    found = found.select(F.col("host").alias("m_host"), F.col("path").alias("m_path"), "rule", "verdict")
    same = (F.col("host") == F.col("m_host")) & (F.col("path") == F.col("m_path"))
    joined = rows.where("host <> ''").join(found, same, "left").select("id", "host", "path", "rule", "verdict")
    none = F.lit(None).cast("string")
    without = rows.where("host = ''").select("id", "host", "path", none.alias("rule"), none.alias("verdict"))
    return joined.unionAll(without).select(F.col("id").alias(key), "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
