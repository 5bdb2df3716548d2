"""Sharding: the curve visits neighbours, shards are balanced and dense, files can be pruned."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_data import SF01
from riskmart.llm import sharding
from riskmart.llm.common import table


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_is_a_walk_through_all_cells(dims, bits):
    axes = np.meshgrid(*[np.arange(2 ** bits)] * dims)
    points = np.stack([a.ravel() for a in axes], axis=1)
    index = sharding.hilbert_index(points, bits)
    assert sorted(index) == list(range(len(points)))
    steps = np.abs(np.diff(points[np.argsort(index)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def check(docs, shards):
    rows = docs.collect()
    got = sharding.shard(docs, shards).collect()
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (repr(r["doc_id"]), len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in rows)
    per = {}
    for r in got:
        per.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    sizes = [len(per.get(i, [])) for i in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(per) <= set(range(shards))
    return got


def test_documents_and_pruning(spark):
    docs = table(spark, SF01, "documents")
    got = check(docs, 40)
    box = {}
    for r in got:
        box.setdefault(r["shard"], set()).add(r["source"])
    sources = {r["source"] for r in got}
    assert sum(map(len, box.values())) < 0.4 * len(sources) * len(box)  # a filter on source skips most shards


def test_written_shards(spark, tmp_path):
    docs = table(spark, SF01, "documents").limit(100)
    sharding.write_shards(docs, f"file://{tmp_path}/s", 5)
    back = spark.read.parquet(f"file://{tmp_path}/s")
    assert back.select(docs.columns).exceptAll(docs).count() == 0 and back.count() == 100
    assert {r["n"] for r in back.groupBy("shard").agg(F.count("slot").alias("n")).collect()} == {20}


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
@pytest.mark.parametrize("shards", [3, 40])
def test_odd_rows(request, which, shards):
    check(request.getfixturevalue(which), shards)
