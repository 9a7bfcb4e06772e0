"""WARC archives with a two-level capture index.

Pages are range-partitioned by capture key (reversed host, then path and query,
then page id) and each partition writes, in key order,

* an archive of WARC records, each a gzip member of its own,
* a capture index of compressed blocks of ``BLOCK`` entries (key, id, offset, length),
* a directory of the index: the first entry, offset and length of each block,

and returns one row, the shard's first capture and name.  Spark commits these
rows as the table of shards: files of a failed or repeated attempt have names of
their own and are in no table.

A lookup binary-searches the shards (one row a partition of the writer, the
only thing sent around), then the directory of that shard, reads the one block
by range, binary-searches it, and reads the record by range.  Lookups are sorted
the same way, so a task walks few shards and blocks.

Records with equal payloads of ``MIN_REVISIT`` bytes or more are folded: that
with the smallest id is the response, the others are revisits without payload.

Defined cases: null html is an empty payload; a null url has the empty key; a
null id sorts first and is no response to others while a group has ids; rows
that share the smallest id of a group are responses all; repeated rows are a
record each; only id, url and html are read; an empty table writes an empty
table of shards.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import uuid
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import shared_folder, written
from .urlrules import _reversed, host_and_path

BLOCK = 512
MIN_REVISIT = 100
#: lanes over which the pages of one payload are dealt when they look for its first page
LANES = 16
LEVEL = 4
_NO_ID = -(1 << 63) - 1
_DATE = "1970-01-01T00:00:00Z"  # the table has no capture times


def capture_key(url: Column) -> Column:
    """Reversed host, ``)``, then everything after the host; empty for a null url."""
    host, _ = host_and_path(url)
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.when(host == "", F.coalesce(url, F.lit(""))).otherwise(F.concat(_reversed(host), F.lit(")"), rest))


def _record(page, url, payload: bytes | None, size: int, digest: str, refers) -> bytes:
    """One WARC record; ``payload`` None makes a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if payload is not None else 'revisit'}", f"WARC-Date: {_DATE}",
            f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", "Content-Type: application/http; msgtype=response",
            f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if payload is None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(record: bytes) -> dict:
    """Fields of one record: ``type``, ``page``, ``refers``, ``digest``, ``size``, ``payload`` (None for a revisit)."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    revisit = fields["WARC-Type"] == "revisit"
    return {"type": fields["WARC-Type"], "page": number("WARC-Record-ID"), "refers": number("WARC-Refers-To"),
            "digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"), "payload": None if revisit else payload,
            "size": int(re.search(rb"Content-Length: (\d+)", http)[1])}


def write(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> str:
    """Write archives, index and table of shards to a fresh shared folder; its path."""
    spark = pages.sparkSession
    root = shared_folder(spark, "warc")
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).alias("url"), body.alias("body"),
                        F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    firsts = (rows.where(F.col("size") >= MIN_REVISIT).groupBy("digest", "size").agg(F.min("id").alias("first"), F.count("*").alias("n"))
              .where("n > 1 and first is not null").select(F.col("digest").alias("f_digest"), F.col("size").alias("f_size"), "first"))
    firsts = written(firsts, "warc-firsts").withColumn("f_lane", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))))
    lane = F.pmod(F.xxhash64("id", "url"), F.lit(LANES))  # a payload that many pages share is no single join key
    found = rows.withColumn("lane", lane.cast("int")).join(
        firsts, (F.col("digest") == F.col("f_digest")) & (F.col("size") == F.col("f_size")) & (F.col("lane") == F.col("f_lane")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("id"))
    records = found.select(capture_key(F.col("url")).alias("key"), "id", "url", F.when(~revisit, F.col("body")).alias("body"),
                           "digest", "size", F.when(revisit, F.col("first")).alias("refers"))
    ordered = records.repartitionByRange("key", "id").sortWithinPartitions("key", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(root)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        warc = cdx = first = None
        at = cdx_at = n = 0
        entries, blocks = [], []

        def close_block() -> None:
            nonlocal cdx_at
            data = gzip.compress("\n".join(json.dumps(e) for e in entries).encode(), LEVEL, mtime=0)
            cdx.write(data)
            blocks.append([*entries[0][:2], cdx_at, len(data)])
            cdx_at += len(data)
            entries.clear()

        for batch in batches:
            for key_, id_, url_, body_, digest, size, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if warc is None:
                    fs.create_dir(f"{base}/shards", recursive=True)
                    warc = fs.open_output_stream(f"{base}/shards/{name}.warc.gz", compression=None)
                    cdx = fs.open_output_stream(f"{base}/shards/{name}.cdx.gz", compression=None)
                    first = key_, id_
                payload = None if body_ is None else body_.encode("utf-8")
                data = gzip.compress(_record(id_, url_, payload, size, digest, refers), LEVEL, mtime=0)
                warc.write(data)
                entries.append([key_, id_, at, len(data)])
                at, n = at + len(data), n + 1
                if len(entries) == BLOCK:
                    close_block()
        if warc is None:
            return
        if entries:
            close_block()
        warc.close()
        cdx.close()
        with fs.open_output_stream(f"{base}/shards/{name}.dir", compression=None) as out:
            out.write("\n".join(json.dumps(b) for b in blocks).encode())
        yield pa.RecordBatch.from_arrays([pa.array([first[0]], pa.string()), pa.array([first[1]], pa.int64()), pa.array([name]), pa.array([n], pa.int64())],
                                         names=["first_key", "first_id", "name", "n"])

    ordered.mapInArrow(run, "first_key string, first_id long, name string, n long").write.parquet(f"{root}/table")
    return root


def _rank(key: str, id_) -> tuple[str, int]:
    return key, _NO_ID if id_ is None else id_


class _Reader:
    """Two-level lookups; holds one shard's directory, one index block and two open files at a time."""

    def __init__(self, root: str, shards: list[tuple[str, int | None, str]]):
        self.fs, self.base = pafs.FileSystem.from_uri(root)
        self.firsts, self.names = [_rank(k, i) for k, i, _ in shards], [n for _, _, n in shards]
        self.shard = self.block = -1

    def _open(self, shard: int) -> None:
        if shard != self.shard:
            path = f"{self.base}/shards/{self.names[shard]}"
            with self.fs.open_input_stream(f"{path}.dir", compression=None) as f:
                self.directory = [json.loads(x) for x in f.read().decode().split("\n")]
            self.block_firsts = [_rank(*d[:2]) for d in self.directory]
            self.cdx, self.warc = self.fs.open_input_file(f"{path}.cdx.gz"), self.fs.open_input_file(f"{path}.warc.gz")
            self.shard, self.block = shard, -1

    def _load(self, block: int) -> None:
        if block != self.block:
            _, _, offset, length = self.directory[block]
            self.cdx.seek(offset)
            self.entries = [json.loads(x) for x in gzip.decompress(self.cdx.read(length)).decode().split("\n")]
            self.ranks = [_rank(*e[:2]) for e in self.entries]
            self.block = block

    def find(self, key: str, id_) -> Iterator[bytes]:
        """The records of a capture, in the order written."""
        want = _rank(key, id_)
        for shard in range(max(0, bisect_left(self.firsts, want) - 1), len(self.firsts)):
            if self.firsts[shard] > want:
                return
            self._open(shard)
            for block in range(max(0, bisect_left(self.block_firsts, want) - 1), len(self.directory)):
                if self.block_firsts[block] > want:
                    break
                self._load(block)
                at = bisect_left(self.ranks, want)
                while at < len(self.ranks) and self.ranks[at] == want:
                    _, _, offset, length = self.entries[at]
                    self.warc.seek(offset)
                    yield gzip.decompress(self.warc.read(length))
                    at += 1


def lookup(captures: DataFrame, root: str, key: str = "page_id", url: str = "url", payload: bool = False) -> DataFrame:
    """Records of the asked captures (distinct id and url): ``(page_id, record_type, refers_to, payload_bytes, payload_digest[, payload])``.

    Bytes and digest of a response are those of the payload read; a revisit has those its header names.
    """
    spark = captures.sparkSession
    table = spark.read.schema("first_key string, first_id long, name string, n long").parquet(f"{root}/table")
    shards = sorted(((r["first_key"], r["first_id"], r["name"]) for r in table.collect()), key=lambda r: _rank(*r[:2]))  # a row a partition
    sent = spark.sparkContext.broadcast(shards)
    asked = captures.select(capture_key(F.col(url)).alias("key"), F.col(key).cast("long").alias("id")).distinct()
    # keys are small and records are not: a partition reads about one archive, however few bytes its keys have
    ordered = asked.repartitionByRange(max(1, len(shards)), "key", "id").sortWithinPartitions("key", "id")
    names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payload
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(root, sent.value)
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for key_, id_ in zip(*(c.to_pylist() for c in batch.columns)):
                for data in reader.find(key_, id_):
                    r = parse(data)
                    if r["payload"] is not None:
                        digest = hashlib.sha256(r["payload"]).hexdigest()
                        if digest != r["digest"] or len(r["payload"]) != r["size"]:
                            raise ValueError(f"damaged record of page {r['page']}")
                    out.append((r["page"], r["type"], r["refers"], r["size"], r["digest"], r["payload"])[:len(names)])
                    held += len(r["payload"] or b"") if payload else 0
                    if held > 1 << 24:
                        yield _batch(out, names, kinds)
                        out, held = [], 0
            yield _batch(out, names, kinds)

    return ordered.mapInArrow(run, "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"
                              + ", payload binary" * payload)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every page, look every capture up again, and resolve revisits to the response read."""
    root = write(pages, key, url, html)
    found = written(lookup(pages, root, key, url), "warc-found")
    responses = written(found.where("record_type = 'response'").groupBy(F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest"))
                        .agg(F.max("payload_bytes").alias("r_bytes")), "warc-responses")
    revisits = found.where("record_type = 'revisit'").join(
        responses, (F.col("refers_to") == F.col("r_id")) & (F.col("payload_digest") == F.col("r_digest")), "left").select(
        "page_id", F.col("r_bytes").alias("payload_bytes"), F.col("r_digest").alias("payload_digest"), "record_type", "refers_to")
    return revisits.unionAll(found.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")).withColumnRenamed("page_id", key)
