"""Collocations: brute force with tries that burst and spill, exact arithmetic, edge cases."""

import re
from collections import Counter

import numpy as np
import pytest

from llm_data import SF001
from riskmart.llm import collocations as C
from riskmart.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f.setdefault(lang, Counter()).update(
                    " ".join(words[i:i + size]) for i in range(len(words) - size + 1))
    return f, n


def brute(rows, least=10, top=2000):
    out = []
    f, n = counts(rows)
    for lang, own in f.items():
        found = {}
        for phrase, a in own.items():
            words = phrase.split(" ")
            if len(words) > 1 and a >= least:
                cuts = []
                for k in range(1, len(words)):
                    left, right = own[" ".join(words[:k])], own[" ".join(words[k:])]
                    cuts.append((1000000 * a * a // (left * right), k, left, right))
                found[phrase] = (a, *min(cuts))
        longer = {}
        for phrase, (a, *_) in found.items():
            words = phrase.split(" ")
            if len(words) == 3:
                for part in (" ".join(words[:2]), " ".join(words[1:])):
                    longer[part] = max(longer.get(part, 0), a)
        kept = [(-s, -a, p.encode(), p, left, right) for p, (a, s, _, left, right) in found.items()
                if 100 * longer.get(p, -1) < 50 * a]
        out += [(lang, i, p, -a, left, right, n[lang], -s)
                for i, (s, a, _, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize("memory", [{}, {"limit": 500, "burst": 20, "chunk": 300}])
def test_equals_brute_force(spark, memory):
    rng = np.random.default_rng(3)
    words = ["The", "of", "a", "New", "york", "été", "x" * 300, "no\x85break", " ", "\x1c"]
    rows = []
    for i in range(400):
        text = "".join(words[w] + [" ", "  ", "\t", ". ", ",", "\n", "\r\n"][s] for w, s in zip(
            rng.integers(0, 10, 40), rng.choice(7, 40, p=[.6, .1, .1, .05, .05, .05, .05])))
        rows.append((["en", "fr", None, "und"][i % 4], text))
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert found(C.collocations(df, **memory)) == brute(rows)
    assert found(C.collocations(df, top=7, least=30, **memory)) == brute(rows, 30, 7)


def test_documents(spark):
    docs = table(spark, SF001, "documents")
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert found(C.collocations(docs, limit=20_000, burst=500)) == brute(rows)


def test_every_ngram_is_counted_across_spills(spark):
    rows = [("en", "a b c a b c a b"), ("en", "a b"), (None, "a b")]
    df = spark.createDataFrame(rows * 5, "lang string, text string")
    got = {(r["lang"], r["phrase"]): r["f"] for r in C.count_ngrams(df, 1, limit=3, burst=1, chunk=1).collect()
           if r["words"]}
    f, _ = counts(rows * 5)
    assert got == {(lang, p): n for lang, own in f.items() for p, n in own.items()}


def test_long_text_in_parts():
    task = C.Task(4, limit=50, burst=3, vocabulary=7)
    text = " ".join(f"w{i % 11}" + ("." if i % 13 == 0 else "") for i in range(200))
    got = Counter()
    for _, _, run in [*task.add("en", text.encode()), *task.end()]:
        for gram, n in zip(*C.read_run(run)):
            got[gram.as_py().decode()] += int(n)
    assert got == counts([("en", text)])[0]["en"]


def test_products_beyond_64_bits(spark):
    big = 9_000_000_000_000_001
    rows = [("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, big + 2), ("en", "", 0, 3 * big)]
    got = C.scored(spark.createDataFrame(rows, "lang string, phrase string, words int, f long")).first()
    assert got["score"] == 1000000 * big * big // ((big + 1) * (big + 2))
    assert (got["l"], got["r"]) == (big + 1, big + 2)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    assert found(C.collocations(odd_docs)) == brute(rows)
    assert C.collocations(no_docs).collect() == []
