"""The queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, credentials, decontam, jaccard, lexical, licenses, mixing, periodic, quality, ring, toxicity, urlrules, warc
from .registry import query, table
from .store import written

_QUALITY_SQL = f"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
tri AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS i,
         unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS g
  FROM w WHERE len(words) >= 3),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
stats AS (
  SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM stats),
rules AS (
  SELECT doc_id, lang, base_failed,
         unnest(['symbols', 'dup_lines', 'repeat_words', 'long_words']) AS rule,
         unnest([least(1000, 1000 * n_symbols // greatest(n_words, 1)),
                 least(1000, 1000 * n_dup_lines // greatest(n_lines, 1)),
                 1000 * n_repeat_words // greatest(n_words, 1),
                 least(1000, 10 * word_chars // greatest(n_words, 1))]) AS v
  FROM judged),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
held AS (SELECT * FROM rules WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)),
tested AS (
  SELECT lang, rule, cutoff, count(*) AS n, count(*) FILTER (WHERE v > cutoff) AS k
  FROM held, (SELECT unnest(range(0, 1000, 20)) AS cutoff) GROUP BY ALL),
chosen AS (
  SELECT lang, rule, min(cutoff) AS cutoff FROM tested
  WHERE list_sum(list_transform(range(0, k + 1), lambda i: exp(
          lgamma(n + 1.0) - (CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1.0) END)
          - (CASE WHEN n = i THEN 0 ELSE lgamma(n - i + 1.0) END)
          + i * ln({quality.RISK / len(quality.RULES)}) + (n - i) * ln(1 - {quality.RISK / len(quality.RULES)}))))
        <= {quality.DELTA} / ({len(quality.RULES) * len(quality.CUTOFFS)} * (SELECT count(*) FROM (SELECT DISTINCT lang FROM documents)))
  GROUP BY ALL),
above AS (SELECT DISTINCT doc_id FROM rules r JOIN chosen c
          ON r.lang IS NOT DISTINCT FROM c.lang AND r.rule = c.rule AND r.v > c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM above) AS kept
FROM judged"""


@query("op6_quality_rules", _QUALITY_SQL)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and risk-controlled verdict of every document."""
    out = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


@query("op3_ngram_jaccard_join")
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links at similarity 0.8 of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_benchmark_decontamination")
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a full, paraphrased or edited copy of a benchmark item, with score and place."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_pivotal_mixing")
def op8_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes from every document."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


SHARDS = 16


@query("op4_consistent_hash_ring")
def op4_consistent_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards on a ring with exact row bounds: counts are at most one apart."""
    out = ring.assign(table(spark, sf_dir, "documents"), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text, learnt from four folds of the labels."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: fixed by the query's contract: host, path, verdict
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

_URL_SQL = f"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{urlrules._UPPER}', '{urlrules._LOWER}') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rh, rp, v) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
found AS (
  SELECT host, path, max_by(rh || rp, length(rh || rp)) AS rule, max_by(v, length(rh || rp)) AS v
  FROM (SELECT DISTINCT host, path FROM parts), rules
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(v, 'allow') AS verdict
FROM parts p LEFT JOIN found f ON p.host = f.host AND p.path = f.path"""


@query("op7_url_filters", _URL_SQL)
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return urlrules.judge(table(spark, sf_dir, "pages"), urlrules.rule_table(spark, URL_RULES))


_WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d, n) ELSE page_id END AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""


@query("op2_warc_index", _WARC_SQL)
def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and looked up again through the two-level index."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


#: fixed by the query's contract: conversation -1
CHAT_PROBE = "</s>[INST] ok [/INST]"


@query("op10_chat_formatting")
def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted in budgeted windows, written, and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("SELECT -1L AS conv_id, r.turn AS turn, r.role AS role, :probe AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS r(turn, role)",
                      args={"probe": CHAT_PROBE})
    return chat.digests(written(chat.format_conversations(turns.unionByName(probe)), "chat-windows"))


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place where a document holds a license notice: the best one there, with the share of the notice that it holds."""
    return licenses.scan(table(spark, sf_dir, "documents"), best=True)


def _periodic_words(doc_id: int, text: bytes) -> bytes:
    """Fixed by the contract of ``op13_periodic_runs``: the text with its words from some place on made periodic."""
    words = text.split()
    n, g = len(words), zlib.crc32(str(doc_id).encode()) // 10
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + (words[a:a + p] * (1 + (n - a) // p))[:n - a])


def _planted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.columns
        chosen = np.array([i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i in ids.to_pylist()], dtype=bool)
        chosen &= texts.is_valid().to_numpy(zero_copy_only=False)
        which = pa.array(chosen)
        made = [_periodic_words(i, t) for i, t in zip(ids.filter(which).to_pylist(), texts.filter(which).cast(pa.binary()).to_pylist())]
        yield pa.RecordBatch.from_arrays([ids, pc.replace_with_mask(texts, which, pa.array(made, pa.binary()).cast(pa.string()))],
                                         names=["doc_id", "text"])


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, and the digest of its text with each run cut to one period.

    A tenth of the ids (none without an id) have a text made periodic first.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").mapInArrow(_planted_runs, "doc_id long, text string")
    best = F.expr("""get(array_sort(runs, (l, r) -> CASE
        WHEN l.length * r.period > r.length * l.period THEN -1 WHEN l.length * r.period < r.length * l.period THEN 1
        WHEN (l.start, l.period) < (r.start, r.period) THEN -1 ELSE 1 END), 0)""")
    out = periodic.detect(docs).withColumn("best", best)
    lines = F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n")))
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                      F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                      F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                      F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


_LEXICAL_SQL = """
WITH term AS (
  SELECT doc_id, pos, unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS raw
  FROM (SELECT doc_id, text, row_number() OVER () AS pos FROM documents)),
words AS (SELECT doc_id, pos, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM term),
counts AS (SELECT doc_id, pos, t, count(*) AS tf FROM words GROUP BY doc_id, pos, t),
sizes AS (SELECT doc_id, pos, sum(tf)::BIGINT AS n FROM counts GROUP BY doc_id, pos),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM sizes),
norms AS (SELECT doc_id, pos, 75 + (25 * n * docs) // length AS m FROM sizes, whole),
freq AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
         FROM (SELECT t, count(*) AS df FROM counts GROUP BY t), whole),
asked AS (
  SELECT item_id, t, count(*) AS times
  FROM (SELECT item_id, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark)
  GROUP BY item_id, t),
scored AS (
  SELECT item_id, doc_id, pos, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN freq USING (t) JOIN counts USING (t) JOIN norms USING (doc_id, pos)
  GROUP BY item_id, doc_id, pos),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20"""


@query("op12_ranked_search", _LEXICAL_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of the whole table for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_secret_scan")
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the fixed patterns and dear values in credential contexts."""
    found = credentials.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.kind != "guess")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, credentials.KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
