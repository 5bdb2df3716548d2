"""The corpus pipeline on documents: each stage against what its operator must do, then the packed result."""

from collections import Counter

import pytest

import corpus_pipeline
from llm_data import SF001, words
from riskmart.llm import mixing, packing, quality, secret_scan
from riskmart.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = table(spark, SF001, "documents")
    out, folder = {"documents": docs}, tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        path = f"file://{folder}/{name}"
        stage(spark, docs, SF001).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def firsts_of_groups(texts, percent):
    """The smallest id of each component of texts with ``percent`` of their 5-word shingles in common, by all pairs."""
    sets, holders, shared = {}, {}, Counter()
    for i, text in texts.items():
        w = words((text or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    for i, shingles in sets.items():
        for s in shingles:
            holders.setdefault(s, []).append(i)
    for ids in holders.values():
        shared.update((a, b) for n, a in enumerate(ids) for b in ids[n + 1:])
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return [i for i in texts if parent[i] == i]


def test_stages_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "secret_scan", "mix_sources", "pack"]
    columns = stages["documents"].columns
    assert all(stages[n].columns == columns for n in ("quality_rules", "near_dedup", "secret_scan", "mix_sources"))


def test_decisions_take_effect(spark, stages):
    judged = quality.judge(stages["documents"], table(spark, SF001, "labels"))
    kept = {r["doc_id"] for r in judged.select("doc_id", "kept").collect() if r["kept"]}
    assert {r["doc_id"] for r in stages["quality_rules"].collect()} == kept
    texts = {r["doc_id"]: r["text"] for r in stages["quality_rules"].collect()}
    assert sorted(r["doc_id"] for r in stages["near_dedup"].collect()) == sorted(firsts_of_groups(texts, 80))
    before = {r["doc_id"]: r["text"] for r in stages["near_dedup"].collect()}
    spans = {r["doc_id"]: r["secrets"] for r in secret_scan.scan(stages["near_dedup"]).collect()}
    after = {r["doc_id"]: r["text"] for r in stages["secret_scan"].collect()}
    assert before.keys() == after.keys()
    assert all((after[i] == before[i]) == (not spans[i]) for i in before)
    assert not any(r["secrets"] for r in secret_scan.scan(stages["secret_scan"], secret_scan.BASE_RULES).collect())


def test_mix_and_pack_hold_what_came_in(stages):
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_per_document(mixing.mix(stages["secret_scan"])).collect()}
    mixed = stages["mix_sources"].collect()
    words = Counter()
    for r in mixed:
        words[r["doc_id"]] += len((r["text"] or "").split())
    assert sum(words.values()) == sum(taken.values())
    packed = stages["pack"].collect()
    starts = Counter(r["doc_id"] for r in packed if r["piece"] == 0)
    assert starts == Counter(r["doc_id"] for r in mixed)
    total = sum(r["length"] for r in packed)
    assert len({r["sequence_id"] for r in packed}) <= -(-total // packing.CAPACITY) + 2
