"""Quality rules: measures by brute force, the n-gram ratio against numpy, separation of labelled documents."""

import math
from collections import Counter

import pytest
from llm_data import SF001, SF01, words


from riskmart.llm import quality
from riskmart.llm.common import table


def measures(text):
    text, w = text or "", words(text)
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def check(docs, labels):
    rows = quality.judge(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        got = measures(r["text"])
        assert tuple(r[m] for m in quality.MEASURES) == got
        assert r["base_failed"] == (got[0] < 10 or 100 * got[4] > 20 * got[0])
        assert not (r["base_failed"] and r["kept"])
    return rows


def outcome(docs, labels):
    """Shares rejected of those that pass the base rules: trusted ones, poor ones."""
    rows = [r for r in check(docs, labels) if not r["base_failed"]]
    good = {r["doc_id"] for r in labels.filter("quality = 1 and toxic = 0").collect()}
    bad = {r["doc_id"] for r in labels.filter("quality = 0").collect()}
    return [sum(not r["kept"] for r in rows if r["doc_id"] in ids) / max(1, sum(r["doc_id"] in ids for r in rows))
            for ids in (good, bad)], rows


@pytest.mark.parametrize("folder", [SF001, SF01])
def test_documents(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    (good, bad), rows = outcome(docs, table(spark, folder, "labels"))
    assert good <= 0.02 and bad >= 0.5  # every document is scored with a target that it is no part of
    unlabelled = [not r["kept"] for r in rows]
    assert sum(unlabelled) <= 0.12 * len(unlabelled)


@pytest.mark.parametrize("left", [0, 5, 20])
def test_languages_with_few_labels_are_kept(spark, left):
    docs = table(spark, SF01, "documents").select("doc_id", "text", "lang")
    labels = table(spark, SF01, "labels")
    ids = [r["doc_id"] for r in docs.filter("lang = 'es'").join(
        labels.filter("quality = 1 and toxic = 0"), "doc_id", "left_semi").orderBy("doc_id").collect()]
    out = ids[left:]
    rows = quality.judge(docs, labels.filter(~labels.doc_id.isin(out))).filter("lang = 'es'").collect()
    passing = [r["kept"] for r in rows if r["doc_id"] in set(out) and not r["base_failed"]]
    assert len(passing) >= 5 and sum(passing) >= 0.9 * len(passing)


def test_ratio_equals_counts_by_hand(spark):
    texts = ["a b c a b", "a b", "c c c d", "z y x", "a b q", "a a", "b"]
    langs = ["x", "x", "x", "x", None, "y", "x"]
    docs = spark.createDataFrame(list(zip(range(7), texts, langs)), "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (2, 0, 0), (4, 1, 0), (6, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    size, prior = 1 << 12, 8.0
    hashes = quality.hashed(docs.withColumnRenamed("text", "_text")).select(
        "doc_id", quality.grams(size).alias("g"), quality.half(docs.doc_id).alias("h"))
    found = {r["doc_id"]: r for r in hashes.collect()}
    for r in quality.judge(docs, labels, buckets=size, prior=prior).collect():
        i, lang = r["doc_id"], langs[r["doc_id"]]
        own = found[i]
        assert len(own["g"]) == 2 * len(texts[i].split()) - 1
        raw, good = Counter(), Counter()
        for j, other in found.items():
            if langs[j] == lang:
                raw.update(other["g"])
                if j in (0, 1, 4, 6) and other["h"] != own["h"]:
                    good.update(other["g"])
        n, m = sum(raw.values()), sum(good.values())
        want = [math.log((good[b] + prior * raw[b] / n) / (m + prior) / (raw[b] / n)) for b in own["g"]]
        assert abs(r["llr"] - sum(want) / len(want)) < 1e-5


def test_trusted_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)] + [(60, 1, 1), (61, 0, 0), (None, 1, 0), (3, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    assert quality.trusted_ids(labels, 1000).count() == 49
    assert quality.trusted_ids(labels, 7).count() == 7


def test_every_trusted_document_counts(spark):
    """As many as ever: the plan of the trusted documents has neither a limit nor a forced broadcast."""
    docs = spark.range(300).selectExpr("id as doc_id", "concat('a b c d e f g h i ', id) as text", "'x' as lang")
    labels = spark.range(300).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    plan = quality.trusted_ids(labels)._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan and "Sort" not in plan
    assert not hasattr(quality, "TRUSTED")
    known = quality.trusted_docs(docs, labels)
    assert known.count() == 300 and {r["_half"] for r in known.collect()} == {0, 1}


def test_few_texts_are_joined_with_the_ids(spark):
    """Most documents without a trusted id take no part in the join; where they do, nothing changes."""
    docs = spark.range(600).selectExpr("if(id % 50 = 7, null, id div 2) as doc_id", "concat('a b c ', id % 9) as text",
                                       "if(id % 3 = 0, null, 'x') as lang")
    labels = spark.range(300).selectExpr("id * 20 as doc_id", "1 as quality", "0 as toxic")
    rows = docs.collect()
    good = {r["doc_id"] for r in labels.collect()}
    trusted = sorted(r["text"] for r in rows if r["doc_id"] in good)
    for size in (1, quality.BITMAP):
        near, rest = quality.told_apart(docs, labels, size)
        assert sorted(r["_text"] for r in near.union(rest).collect()) == sorted(r["text"] for r in rows)
        assert sorted(r["_text"] for r in near.filter("_half is not null").collect()) == trusted
        assert not rest.filter("_half is not null").take(1)
    assert near.count() <= len(trusted) + 30
    assert quality.trusted_docs(docs, labels).count() == len(trusted)


def test_grams_in_rows_equal_those_in_arrays(spark):
    texts = ["a b c a b", "a", "", " \n", "c  c\tc d", None, "é x"]
    docs = spark.createDataFrame(list(zip(range(7), texts)), "doc_id long, t string").selectExpr(
        "doc_id", "coalesce(t, '') as _text")
    arrays = quality.hashed(docs).select("doc_id", quality.grams(64).alias("g")).collect()
    got = Counter((r["doc_id"], r["bucket"]) for r in quality.each_gram(docs, 64).collect())
    assert got == Counter((r["doc_id"], b) for r in arrays for b in r["g"])


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
@pytest.mark.parametrize("labelled", [True, False])
def test_odd_rows(request, spark, which, labelled):
    docs = request.getfixturevalue(which)
    labels = spark.createDataFrame([(100, 1, 0), (None, 1, None)] if labelled else [], "doc_id long, quality int, toxic int")
    check(docs.drop("kept"), labels)
    assert quality.keep(docs, labels).columns == docs.columns
    quality.keep(docs, labels).collect()
