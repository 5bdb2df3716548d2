"""Mixing: targets by hand, words to the target, order of the mix, edge cases."""

import pytest
from pyspark.sql import functions as F

from llm_data import SF01, words


from riskmart.llm import mixing
from riskmart.llm.common import table


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Water filling, step by step."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    found, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > cap * sizes[s]}
        if not full:
            return found | {s: weight[s] * level for s in open_}
        for s in full:
            found[s] = cap * sizes[s]
            left -= found[s]
        open_ -= full
    return found


def test_targets_share_the_excess_again(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 1, None: 90}
    slim = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(slim).collect()}
    assert got.keys() == sizes.keys()
    assert all(abs(got[s] - t) < 1e-6 for s, t in targets(sizes).items())
    assert abs(sum(got.values()) - sum(sizes.values())) < 1e-6


def test_sources_get_their_targets_to_the_word(spark):
    docs = table(spark, SF01, "documents")
    rows = docs.collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    want = targets(sizes)
    mixed = mixing.mix(docs)
    found = mixing.taken_per_document(mixed).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(found) == len(rows)
    for source, target in want.items():
        taken = sum(r["taken"] for r in found if r["source"] == source)
        assert abs(taken - target) <= len(want)  # the cut at the budget falls on one row
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in found)
    assert sum(r["taken"] for r in found) <= sum(sizes.values())
    # at any point of the mix the sources stand near their proportions
    half = mixed.filter("words > 0 and finish <= 0.5").groupBy("source").agg(F.sum("words").alias("w")).collect()
    most = max(len(words(r["text"])) for r in rows)
    assert all(abs(r["w"] - want[r["source"]] / 2) <= most for r in half)


def test_reruns_and_partitions_agree(spark):
    docs = table(spark, SF01, "documents")
    a, b = ({(r["doc_id"], r["taken"]) for r in mixing.taken_per_document(mixing.mix(d)).collect()}
            for d in (docs, docs.repartition(7)))
    assert a == b


def test_take_cuts_only_at_the_line(spark):
    docs = table(spark, SF01, "documents")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken_per_document(mixing.mix(docs)).collect()}
    got = mixing.take(docs).collect()
    per, cut = {}, 0
    for r in got:
        per[r["doc_id"]] = per.get(r["doc_id"], 0) + len(words(r["text"]))
        whole = text[r["doc_id"]]
        cut += r["text"] != whole
        assert words(whole)[:len(words(r["text"]))] == words(r["text"])
    assert per == {i: n for i, n in taken.items() if n or i in per}
    assert cut <= len({r["source"] for r in docs.select("source").collect()}) + 1


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
def test_odd_rows(request, which):
    docs = request.getfixturevalue(which)
    got = mixing.taken_per_document(mixing.mix(docs)).collect()
    assert len(got) == docs.count()
    assert sorted(r["size"] for r in got) == sorted(len(words(r["text"])) for r in docs.collect())
    assert mixing.take(docs).columns == docs.columns
    mixing.take(docs).collect()
