"""The pipeline against a plain version on the smallest tables, and the entry without the subpackage."""

import collections
import os
import shutil
import subprocess
import sys

from .plain import folded, words
from .test_jaccard import brute as near_classes
from .test_mixing import plain_targets
from .test_quality import brute as counts

import corpus_pipeline as P
from stratum.llm.store import written

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    items = [" ".join(folded(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = []
    for name, stage in P.STAGES:
        docs = written(stage(spark, docs, SF), name)
        assert name == "shard" or docs.columns == columns
        kept.append(docs.collect())
    quality, near, clean, mixed, shards = kept
    # too few labels here for any cutoff: the base rules alone
    stats = {i: counts(t) for i, t, *_ in rows}
    want = [r for r in rows if stats[r[0]][0] >= 50 and 100 * stats[r[0]][5] <= 50 * stats[r[0]][0]]
    assert sorted(r.doc_id for r in quality) == sorted(r[0] for r in want)
    want = sorted(want)
    label = near_classes(want)[1]
    want = [r for r, c in zip(want, label) if r[0] == c]
    assert sorted(r.doc_id for r in near) == [r[0] for r in want]
    want = [r for r in want if not any(i in " ".join(folded(r[1])) for i in items)]
    assert sorted(r.doc_id for r in clean) == [r[0] for r in want]
    size, taken = collections.Counter(), collections.Counter()
    for _, t, _, s in want:
        size[s] += len(words(t))
    for r in mixed:
        taken[r.source] += len(words(r.text))
    copies = collections.Counter(r.doc_id for r in mixed)
    assert set(copies) <= {r[0] for r in want} and max(copies.values()) <= 3
    for s, target in plain_targets(dict(size)).items():
        assert abs(taken[s] - target) <= max((len(words(r[1])) for r in want if r[3] == s))
    assert collections.Counter(r.doc_id for r in shards) == copies
    load = collections.Counter(r.shard for r in shards)
    assert max(load.values()) - min(load.get(k, 0) for k in range(P.SHARDS)) <= 1


def test_run_gives_the_last_stage(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "size", "text_crc32", "shard", "slot"] and out.count() > 50


def test_stages_take_awkward_and_empty_tables(spark, documents):
    long = "word " * 5 + " ".join(f"w{k}" for k in range(30_000))
    good = " ".join(f"g{k}" for k in range(80))
    docs = documents([(1, None, None, None), (2, "", "en", "s"), (3, long, None, "s"), (4, good, "en", None), (4, good, "en", None), (None, good, "en", "s"),
                      (None, good + " more", "fr", "t"), (5, good.upper(), "en", "s")])
    for start in (docs, docs.where("false")):
        frame = start
        for name, stage in P.STAGES:
            frame = written(stage(spark, frame, SF), name)
        assert frame.count() == (0 if start is not docs else frame.select("slot", "shard").distinct().count())


def test_entry_works_without_the_subpackage(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "*.json"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(k.startswith('op3_') for k in q) and len(q) > 100; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120, env=os.environ | {"PYTHONPATH": str(copy)})
