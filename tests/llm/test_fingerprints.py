"""Fingerprints: a slow parser by the definition, shifted substrings, true similarity, order and edits, edge cases."""

import hashlib

import numpy as np
import pytest

from llm_data import SF001
from riskmart.llm import fingerprints as P
from riskmart.llm.common import table

ONE = (1 << 64) - 1


def mixed(x):
    for shift, by in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        x = ((x ^ (x >> shift)) * by) & ONE
    return x ^ (x >> 32)


def toss(x):
    out = [x[0] & 1]
    for left, own in zip(x, x[1:]):
        bit = ((left ^ own) & -(left ^ own)).bit_length() - 1
        out.append(2 * bit + ((own >> bit) & 1))
    return out


def level_up(names):
    runs = []
    for n in names:
        if runs and runs[-1][0] == n:
            runs[-1][1] += 1
        else:
            runs.append([n, 1])
    names = [mixed((n + r * 0x9E3779B97F4A7C15) & ONE) for n, r in runs]
    label = names
    for _ in range(4):
        label = toss(label)
    assert max(label) < 6
    begins = [i for i in range(len(names)) if i == 0 or i > 1 and label[i] > label[i - 1] and (
        i + 1 == len(names) or label[i] > label[i + 1])]
    out = []
    for s, e in zip(begins, [*begins[1:], len(names)]):
        assert e - s <= 12
        total = sum(n * pow(0x9E3779B97F4A7C15, j + 1, 1 << 64) for j, n in enumerate(names[s:e])) & ONE
        out.append(mixed((total + 0xFF51AFD7ED558CCD) & ONE))
    return out


def levels(text):
    names, out = [ord(c) for c in text], []
    while names:
        out.append(names)
        if len(names) == 1 and len(out) > P.LEVEL:
            break
        names = level_up(names)
    return out


def entries(text):
    least = P.least_level(len(text))
    return sorted({(mixed((n + (i + 1) * 0xC4CEB9FE1A85EC53) & ONE) >> 28 << 4) | min(i, 15)
                   for i, names in enumerate(levels(text)) if i >= least for n in names})


def prose(seed, n):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefghé\U0001f600"), rng.integers(1, 9))) for _ in range(400)]
    return " ".join(words[i] for i in rng.integers(0, 400, n))


def test_equals_the_definition():
    texts = ["", "a", "ab", "aaaa", "abab" * 20, "x" * 500, prose(1, 300), "a" * 70 + "b" * 70, "tab\t\n", *map(chr, range(97, 103))]
    for text, got in zip(texts, P.sketches(texts)):
        assert got.tolist() == entries(text)[:P.SKETCH]
        least, back = P.read(P.fingerprint(got, len(text)))
        assert back.tolist() == got.tolist() and (least == P.least_level(len(text)) or not text)


def test_equal_substrings_share_their_interior():
    """Whatever stands around a passage, but for its margins it gives the same phrases."""
    passage = prose(2, 400)
    inside = [set(x) for x in levels(passage)]
    for left in ("", "x", "some other words ", prose(3, 57)):
        around = [set(x) for x in levels(left + passage + prose(4, 31))]
        for i in (1, 2, 3):
            assert len(inside[i] - around[i]) <= 10


def test_likeness_estimates_similarity():
    base = prose(5, 3000)
    for share in (0.0, 0.3, 0.7, 0.95, 1.0):
        cut = int(len(base) * share)
        other = base[:cut] + prose(6, 3000)[:len(base) - cut]
        a, b = (set(entries(t)) for t in (base, other))
        x, y = P.sketches([base, other])
        assert abs(P.likeness((2, x), (2, y)) - len(a & b) / len(a | b)) < 0.2
    short = ["one two three four", "one two three five", ""]
    a, b, none = ((P.least_level(len(t)), s) for t, s in zip(short, P.sketches(short)))
    x, y = (set(entries(t)) for t in short[:2])
    assert P.likeness(a, b) == len(x & y) / len(x | y)
    assert P.likeness(none, none) == 1.0 and P.likeness(a, none) == 0.0 and P.likeness(a, a) == 1.0


def brute(rows):
    """Rows in their order, without fingerprints; rows of one doc_id and text are interchangeable."""
    rank = {}
    out = []
    for doc_id, text in rows:
        out.append((doc_id, text or ""))
    order = sorted(out, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    return order


def check(rows, got):
    order = brute(rows)
    ids = [d for d, _ in order]
    want, have = {}, {}
    for i, (doc_id, text) in enumerate(order):
        if ids.count(doc_id) > 1 or ids.count(order[(i + 1) % len(order)][0]) > 1:
            continue  # the order among rows of one doc_id is by hash
        following = order[(i + 1) % len(order)][1]
        changed = P.edited(text, following)
        a, b, c = P.sketches([text, changed, following])
        least = [P.least_level(len(t)) for t in (text, changed, following)]
        want[doc_id] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), P.fingerprint(a, len(text)),
                        P.fingerprint(b, len(changed)), P.likeness((least[0], a), (least[1], b)),
                        P.likeness((least[0], a), (least[2], c)))
    for r in got:
        have.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert sum(map(len, have.values())) == len(rows)
    assert want and all(have[d] == [w] for d, w in want.items())
    return have


@pytest.mark.parametrize("chunk", [1, 1 << 20])
def test_documents(spark, chunk):
    docs = table(spark, SF001, "documents")
    got = P.fingerprints(docs, chunk=chunk).collect()
    check([(r["doc_id"], r["text"]) for r in docs.collect()], got)
    by_text = {}
    for r, t in zip(sorted(got), sorted((r["doc_id"], r["text"]) for r in docs.collect())):
        by_text.setdefault(t[1], set()).add(r["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values())
    long = [r for r in got if r["n_chars"] > 500]
    assert np.mean([r["near_edited"] for r in long]) > np.mean([r["near_next"] for r in long]) + 0.25


def test_order_of_repeated_and_null_ids(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check(rows, P.fingerprints(odd_docs).collect())
    assert P.fingerprints(no_docs).collect() == []
    same = spark.createDataFrame([(1, f"text number {i}") for i in range(50)] + [(None, "n")] * 20 + [(-5, "m")],
                                 "doc_id long, text string").repartition(5)
    texts, got = {}, P.fingerprints(same).collect()
    for r in same.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    # one round through all rows: every text is the next one of exactly one row
    whole = sorted(hashlib.sha256((t[:len(t) - len(t) // 3]).encode()).hexdigest() for t in ("n",))
    assert len(got) == 71 and sum(r["doc_id"] is None for r in got) == 20
    assert sum(r["edited_sha256"] == whole[0] for r in got) == 20  # a third of one code point is none
    one = spark.createDataFrame([(3, "only one row here")], "doc_id long, text string")
    r = P.fingerprints(one).first()
    assert r["near_next"] == 1.0 and r["n_chars"] == 17
