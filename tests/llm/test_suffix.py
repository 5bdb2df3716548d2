"""Repeated byte strings: removed bytes against brute force, for both ways of step 3."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from llm_data import SF001
from riskmart.llm import suffix
from riskmart.llm.common import table


def brute(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[s:s + length] for _, d in texts for s in range(len(d) - length + 1))
    out = []
    for i, d in texts:
        gone = np.zeros(len(d), bool)
        for s in range(len(d) - length + 1):
            if seen[d[s:s + length]] > 1:
                gone[s:s + length] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(docs, length, **options):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in suffix.remove_repeats(docs, length, **options).collect()), key=repr)
    assert got == brute(rows, length)
    return sum(r[2] for r in got)


@pytest.mark.parametrize("length,digit", [(12, 4), (20, 7), (10, 10)])
@pytest.mark.parametrize("local", [4096, 3])
def test_made_texts(spark, length, digit, local):
    rng = random.Random(length)
    base = ["".join(rng.choice("ab") for _ in range(60)) for _ in range(5)]
    rows = []
    for i in range(100):
        t = (rng.choice(base)[rng.randint(0, 20):rng.randint(30, 60)] + "".join(rng.choice("abcé") for _ in range(rng.randint(0, 20)))
             + rng.choice(base)[rng.randint(0, 30):])
        rows.append((i, "a" * rng.randint(0, 70) if rng.random() < 0.1 else t))
    rows += rows[:3] + [(500, None), (501, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert check(docs, length, digit=digit, local=local) > 0


def test_documents(spark):
    assert check(table(spark, SF001, "documents"), 400) > 0


def test_chunks_of_long_texts_agree(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    whole = suffix.anchors(data, 40, 12)
    monkeypatch.setattr(suffix, "CHUNK", 64)
    parts = suffix.anchors(data, 40, 12)
    assert all((a == b).all() for a, b in zip(whole, parts))


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
def test_odd_rows(request, which):
    check(request.getfixturevalue(which), 50, digit=20)
