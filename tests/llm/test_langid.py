"""Language ID: Kneser-Ney probabilities by hand, held-out accuracy, edge cases."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from llm_data import SF001, SF01
from riskmart.llm import langid
from riskmart.llm.common import table


def kneser_ney(texts):
    """Probability of a character after a context, straight from the definition."""
    padded = [" " * langid.PAD + t + " " for t in texts]
    counts = {langid.ORDER: defaultdict(int)}
    for t in padded:
        for i in range(langid.PAD, len(t)):
            counts[langid.ORDER][t[i - langid.PAD:i + 1]] += 1
    for k in range(langid.ORDER - 1, 0, -1):
        counts[k] = defaultdict(int)
        for g in counts[k + 1]:
            counts[k][g[1:]] += 1

    def p(g):
        if not g:
            return 1 / langid.ALPHABET
        same = {h: n for h, n in counts[len(g)].items() if h[:-1] == g[:-1]}
        if not same:
            return p(g[1:])
        total = sum(same.values())
        d = langid.DISCOUNT
        return max(same.get(g, 0) - d, 0) / total + d * len(same) / total * p(g[1:])

    return p


def scorer_of(spark, texts, asked):
    """The columns, and the array for the n-grams of the texts ``asked``."""
    rows = [(lang, t) for lang, ts in texts.items() for t in ts]
    top = langid.count_grams(spark.createDataFrame(rows, "lang string, text string"))
    langs = langid.columns_of(top)
    u, first = langid.units(asked)
    wanted = np.unique(langid.grams(u, langid.ORDER)[langid.predicted(first)]).view(np.int64)
    found = langid.vectors(langid.probabilities(top), langs, spark.createDataFrame(
        [(int(g),) for g in wanted], "gram long")).toArrow()
    assert found.num_rows == len(wanted)
    return langs, langid.Scorer(found, len(langs))


def log_probabilities(scorer, text):
    u, _ = langid.units([text])
    row = scorer.rows(langid.grams(u, langid.ORDER))
    assert (row < scorer.others).all()
    return scorer.values[row]


def test_probabilities_follow_the_definition(spark):
    texts = {"xx": ["abra cadabra", "abacus", "bar"], "yy": ["zebra", "zz top"]}
    asked = ["abra", "zebra top", "qqq", "a"]
    langs, scorer = scorer_of(spark, texts, asked + ["x"])
    for lang, ts in texts.items():
        p, col = kneser_ney(ts), langs.index(lang)
        for text in asked:
            got = log_probabilities(scorer, text)[:, col]
            padded = " " * langid.PAD + text + " "
            want = [math.log(p(padded[i - langid.PAD:i + 1])) for i in range(langid.PAD, len(padded))]
            assert np.allclose(got, want, atol=1e-4)
            sums, left, _, _ = scorer.sums([text, "x", text])
            assert len(left) == 0 and np.allclose(sums[[0, 2], col], np.sum(want), atol=1e-3)


@pytest.mark.parametrize("seed", [4, 12])
def test_many_ngrams_and_unknown_ones(spark, seed):
    rng = np.random.default_rng(seed)
    made = {"xx": ("abcdefghijklm", 40), "yy": ("aeiou\u4e00\u4e01\u4e02\u4e03xyz", 20)}
    texts = {lang: ["".join(rng.choice(list(letters), 150)) for _ in range(n)] for lang, (letters, n) in made.items()}
    text = texts["xx"][0][:30] + " " + "aeioubcdqq" + texts["yy"][0][:30]
    langs, scorer = scorer_of(spark, texts, [text])
    padded = " " * langid.PAD + text + " "
    for lang, ts in texts.items():
        p = kneser_ney(ts)
        want = [math.log(p(padded[i - langid.PAD:i + 1])) for i in range(langid.PAD, len(padded))]
        assert np.allclose(log_probabilities(scorer, text)[:, langs.index(lang)], want, atol=1e-4)


def test_leftover_ngrams_do_not_change_results(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text", "lang")
    langs, top, model = langid.learn(docs)
    whole = {r["doc_id"]: r for r in langid.predict(docs, langs, top, model).collect()}
    small = langid.predict(docs, langs, top, model, values=100 * len(langs)).collect()
    assert len(small) == len(whole)
    for r in small:
        assert r["lang_pred"] == whole[r["doc_id"]]["lang_pred"]
        for col in ("score", "cross_entropy", "trial_entropy"):
            want = whole[r["doc_id"]][col]
            assert r[col] == want or math.isclose(r[col], want, rel_tol=1e-5)


def test_language_of_remainder_three_only(spark):
    fold = {k: [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == k] for k in range(4)}
    rows = [(i, "the quick brown fox jumps over it " * 3, "en") for k in (0, 1, 3) for i in fold[k][:6]]
    rows += [(i, "zwei sch\u00f6ne gr\u00fcne b\u00e4ume stehen dort " * 3, "de") for i in fold[3][6:12]]
    rows += [(fold[2][0], "gr\u00fcne b\u00e4ume", None), (fold[2][1], "brown fox", None)]
    got = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(
        rows, "doc_id long, text string, lang string")).collect()}
    assert got[fold[2][0]]["lang_pred"] == "de" and got[fold[2][0]]["rejected"]
    assert got[fold[2][1]]["lang_pred"] == "en"


def test_held_out_accuracy_and_folds(spark):
    docs = table(spark, SF01, "documents")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = langid.identify(docs).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) < 0.1 * len(rows)


def test_foreign_text_is_rejected(spark):
    docs = table(spark, SF01, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10**9 + i, "qxzj wvkq " * 30, None) for i in range(5)], docs.schema)
    got = langid.identify(docs.union(odd)).filter(f"doc_id >= {10**9}").collect()
    assert len(got) == 5 and all(r["rejected"] for r in got)


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
def test_odd_rows(request, which):
    docs = request.getfixturevalue(which)
    texts = docs.select("doc_id", "text").collect()
    got = langid.identify(docs).collect()
    assert len(got) == len(texts)
    undecided = sorted(str(r["doc_id"]) for r in got if r["lang_pred"] == "und")
    assert undecided == sorted(str(r["doc_id"]) for r in texts if not any(c.isalpha() for c in r["text"] or ""))
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
