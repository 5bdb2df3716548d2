"""Packing: dominance keeps the optimum, plans hold every piece, ids equal the tokenizer's."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_data import ODD_TEXTS, SF01
from riskmart.llm import packing
from riskmart.llm.common import table


def fewest(items, capacity):
    """Branch and bound."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= items[i]:
                rest = list(rooms)
                rest.remove(room)
                place(i + 1, rest + [room - items[i]])
        place(i + 1, rooms + [capacity - items[i]])

    place(0, [])
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.sampled_from([7, 20, 50]).flatmap(lambda c: st.tuples(
    st.just(c), st.lists(st.integers(1, c), min_size=1, max_size=9))))
def test_dominance_keeps_the_optimum(case):
    capacity, items = case
    h = packing.Histogram(Counter(items))
    fixed = packing.reduce_by_dominance(h, capacity)
    rest = [x for x, n in h.counts.items() for _ in range(n)]
    assert sum(n for _, n in fixed) + (fewest(rest, capacity) if rest else 0) == fewest(items, capacity)


@settings(max_examples=200, deadline=None)
@given(st.integers(3, 300).flatmap(lambda c: st.tuples(
    st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 500), max_size=40))))
def test_plans_hold_every_piece_once(case):
    capacity, counts = case
    patterns = packing.plan(counts, capacity)
    used = Counter()
    for pattern, n in patterns:
        assert sum(pattern) <= capacity and n > 0
        for x in pattern:
            used[x] += n
    assert used == Counter(counts)
    total = sum(x * n for x, n in counts.items())
    assert sum(n for _, n in patterns) <= 2 * -(-total // capacity)


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def check(docs, capacity):
    rows, t = docs.collect(), tokenizer()
    want = Counter()
    for r in rows:
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [packing.END_ID]
        for i in range(0, len(ids), capacity):
            part = np.array(ids[i:i + capacity], "<u4").tobytes()
            want[r["doc_id"], i // capacity, i, len(part) // 4, zlib.crc32(part)] += 1
    got = packing.pack(docs, capacity=capacity).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r["length"] for r in got)


def test_documents(spark):
    n, total = check(table(spark, SF01, "documents").limit(300), packing.CAPACITY)
    assert n <= -(-total // packing.CAPACITY) + 2


def test_words_equal_whole_texts():
    t = tokenizer()
    texts = [x or "" for x in ODD_TEXTS] + [
        "a|b | c", "  x y　z|  ", "İstanbul ΣΑΣ ς", "é ́a", "<|endoftext|> hi<|startoftext|>", "it's they'LL 12345",
        "a\x00b\x1c\x1dc\x85d", "'s 'T ''", "x " * 3000, "naïve​word ﬁ", ".!? ,. a.b,c"]
    rng = random.Random(1)
    texts += ["".join(rng.choice("ab| .,'é\n\t0") for _ in range(60)) for _ in range(300)]
    for text, raw in zip(texts, packing.WordTokenizer(packing.tokenizer_path())(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "WORD_MEMORY", 20)
    texts = [" ".join(f"w{(i * j) % 37}" for j in range(30)) for i in range(300)]
    t = tokenizer()
    for text, raw in zip(texts, packing.WordTokenizer(packing.tokenizer_path())(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_stems_marks_and_cut_texts_change_nothing(monkeypatch):
    t = tokenizer()
    rng = random.Random(2)
    stems = ["Du", "été", "ß", "ŉ", "İ", "x1", "12", "it's", "a'", "", "|", "<|endoftext|>", "<|ENDOFTEXT|>", "ª", "e\u0301",
             "中", "don't", "ÿ", "×", "µ"]
    ends = ["", ".", ",,", "?!", "...", ";:", ".a", "'", "-"]
    texts = [rng.choice(" \t\n").join(rng.choice(stems) + rng.choice(ends) for _ in range(40)) for _ in range(300)]
    want = [t.encode(text, add_special_tokens=False).ids for text in texts]
    for size in (packing.CHUNK, 50):  # 50: every text is cut
        monkeypatch.setattr(packing, "CHUNK", size)
        found = list(packing.WordTokenizer(packing.tokenizer_path())(texts))
        assert [np.frombuffer(raw, "<u4").tolist() for raw in found] == want


def test_a_stem_is_tokenised_once(monkeypatch):
    seen, encode = [], packing.WordTokenizer._encode
    monkeypatch.setattr(packing.WordTokenizer, "_encode", lambda self, stems: seen.extend(stems) or encode(self, stems))
    texts = ["abc abc### ABC", "abc*** abc, x### été$$$ ab'### a'###b", "<|endoftext|>### ABC### abc <|startoftext|>$ 1### _"]
    t, tokens = tokenizer(), packing.WordTokenizer(packing.tokenizer_path())
    for text in texts:
        assert np.frombuffer(next(iter(tokens([text]))), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
    assert seen.count("abc") == 1 and "abc###" not in seen and "été$$$" not in seen


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
def test_odd_rows(request, which):
    check(request.getfixturevalue(which), 64)


def test_large_ids_beside_nulls(spark):
    big = 2 ** 62 + 1
    docs = spark.createDataFrame([(big, "a b"), (None, "c")], "doc_id long, text string").coalesce(1)
    assert {r["doc_id"] for r in packing.pack(docs).collect()} == {big, None}
