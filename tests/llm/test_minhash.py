"""Near-duplicates: components against an exact join, large groups of copies, edge cases."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_data import SF01, words
from riskmart.llm import components, minhash
from riskmart.llm.common import table
from riskmart.llm.components import connected_components
from riskmart.session import checkpoint_table


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def exact(rows, percent=85):
    """(smallest reachable doc_id) of each row, by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    held = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            held[x].append(i)
    both = Counter()
    for v in held.values():
        for a in range(len(v)):
            for b in range(a):
                both[v[b], v[a]] += 1
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            up[top(a)] = top(b)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)].append(doc)
    return [(doc, len(sets[i]), min(least[top(i)], default=None)) for i, (doc, _) in enumerate(rows)]


def check(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = minhash.near_duplicates(docs).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == sorted(exact(rows), key=repr)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return got


def edited(rng, w, n):
    w = list(w)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def test_documents(spark):
    check(table(spark, SF01, "documents"))


@pytest.mark.parametrize("small", [2, 16])
def test_groups_chains_and_common_passages(spark, small, monkeypatch):
    rng = random.Random(small)
    rows, passage = [], [f"p{i}" for i in range(30)]
    for g, size in enumerate([2, 3, 60]):
        base = [f"g{g}w{rng.randrange(5000)}" for _ in range(150)]
        rows += [edited(rng, base, rng.randrange(6)) for _ in range(size)]
    chain = [f"c{i}" for i in range(120)]
    for _ in range(8):  # each text is near the one before it
        rows.append(" ".join(chain))
        chain = chain[:-4] + [f"d{rng.randrange(10**6)}" for _ in range(4)]
    rows += [" ".join([f"o{rng.randrange(10**6)}" for _ in range(60)] + passage) for _ in range(40)]
    rows += [" ".join(f"s{i}" for i in range(n)) for n in range(1, 16)]  # short texts, one word longer each
    rng.shuffle(rows)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    exacts = sorted(exact([tuple(r) for r in docs.collect()]))
    got = minhash.near_duplicates(docs, small=small).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == exacts


@pytest.mark.parametrize("shared, own", [(1, 8), (6, 8)])
def test_large_groups_of_edited_copies(spark, shared, own):
    """500 copies with up to ``shared`` of ten common edits and up to ``own`` edits of their own."""
    rng = random.Random(shared)
    base = [f"b{i}" for i in range(404)]
    common = [(rng.randrange(404), f"c{i}") for i in range(10)]
    rows = []
    for _ in range(500):
        w = list(base)
        for at, word in rng.sample(common, rng.randrange(shared + 1)):
            w[at] = word
        rows.append(edited(rng, w, rng.randrange(own + 1)))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    got = minhash.near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(exact(list(enumerate(rows))))


@pytest.mark.parametrize("salt_rows", [3, 2048])
def test_exact_join_finds_every_pair_across_components(spark, salt_rows):
    rng = random.Random(9)
    base = [rng.randrange(10**9) for _ in range(60)]
    sets = {}
    for i in range(80):
        s = set(base)
        for x in rng.sample(base, rng.randrange(8)):
            s.remove(x)
        sets[i] = s | {rng.randrange(10**9) for _ in range(rng.randrange(6))}
    rows = [(i, len(s), i % 7, i % 7 != 0) for i, s in sets.items()]
    members = spark.createDataFrame(rows, "node long, n long, component long, outside boolean")
    held = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "node long, shingles array<long>")
    got = {(r["a"], r["b"]) for r in minhash.rest_candidates(members, held, 85, salt_rows).collect()}
    want = {(a, b) for a in sets for b in sets
            if a < b and a % 7 != b % 7 and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert want and want <= got


def test_similarities_from_80_to_85_percent(spark):
    """Pairs of texts of 4 to 60 shingles with as few in common as 80 % allows, by edits in the middle and at the ends."""
    import corpus_pipeline

    rng, rows = random.Random(80), []
    for n in range(4, 61):
        for copy in range(4):
            w = [f"n{n}c{copy}w{i}" for i in range(n + 4)]
            rows.append(" ".join(w))
            drop = rng.randrange(1, n // 5 + 2) if n > 4 else 1
            if copy < 2:  # shorter by words at one end
                rows.append(" ".join(w[:len(w) - drop] if copy else w[drop:]))
            elif n >= 45 or copy == 2:  # a changed word inside, or an added word
                at = rng.randrange(len(w))
                rows.append(" ".join(w[:at] + ["x"] + w[at + 1:]))
            else:
                rows.append(" ".join(w + [f"y{n}{i}" for i in range(max(1, n // 4))]))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    want = sorted(exact(list(enumerate(rows)), 80))
    assert want != sorted(exact(list(enumerate(rows)), 85))
    got = minhash.near_duplicates(docs, percent=80).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert kept == {i for i, _, least in want if i == least}


def test_medoid_is_the_text_that_copies_come_from(spark):
    rng = random.Random(5)
    base = [rng.randrange(10**9) for _ in range(100)]
    rows = [(0, base)] + [(i, base[:i] + [rng.randrange(10**9) for _ in range(6)] + base[i + 6:]) for i in range(1, 30)]
    sets = spark.createDataFrame(rows, "node long, shingles array<long>")
    component = spark.createDataFrame([(i, 0) for i, _ in rows], "node long, component long")
    assert [r["medoid"] for r in minhash.medoids(component, sets, 16).collect()] == [0]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7000, 7001), (7001, 7000), (5, 5)]
    edges = [(a * 13 % 100003, b * 13 % 100003) for a, b in edges]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = defaultdict(set)
    for n, c in got.items():
        groups[c].add(n)
    assert sorted(map(len, groups.values())) == [2, 51, 200]
    assert all(c == min(g) for c, g in groups.items())


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
def test_odd_rows(request, which):
    docs = request.getfixturevalue(which)
    check(docs)
    kept = minhash.keep(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) or ids.count(None) > 1


def test_one_document_of_a_group_with_null_or_repeated_ids(spark):
    w = [f"w{i}" for i in range(100)]
    texts = [" ".join(w[:100 - i]) for i in range(4)]
    rows = [(None, t) for t in texts] + [(7, "x " + t.upper().replace("W", "v")) for t in texts] + [(None, ""), (8, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["doc_id"] for r in minhash.keep(docs).collect()), key=str) == [7, 8, None, None]


def test_sets_meet_by_number(spark):
    """Nodes are numbers from the start, and only wanted texts are read again, each once."""
    w = [f"w{i}" for i in range(100)]
    texts = [" ".join(w[:100 - i]) for i in range(4)] + [" ".join(f"o{j}x{i}" for i in range(20)) for j in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts + [texts[0].upper(), None])) + [(0, texts[0])], "doc_id long, text string")
    nodes = minhash.numbered(minhash.sketches(docs))
    assert nodes.count() == nodes.select("node").distinct().count() == 34
    lists = minhash.inverted_lists(nodes)
    assert {dict(lists.dtypes)[c] for c in ("run", "node", "hub")} == {"bigint"}
    assert lists.select("node").distinct().count() == 4
    assert all(r["members"] == len(r["held"]) > 1 and r["hub"] in r["held"] for r in lists.groupBy("run", "members", "hub").agg(
        F.collect_set("node").alias("held")).collect())
    wanted = nodes.join(lists.select("node").distinct(), "node", "left_semi").select("node", "key")
    got = {r["node"]: r["shingles"] for r in minhash.full_sets(docs, wanted).collect()}
    assert sorted(map(len, got.values())) == [93, 94, 95, 96]
    assert all(r["sketch"] == got[r["node"]][:48] for r in nodes.collect() if r["node"] in got)


def test_a_star_is_left_as_it_is(spark, monkeypatch):
    written = []
    monkeypatch.setattr(components, "checkpoint_table",
                        lambda df, prefix: written.append(prefix) or checkpoint_table(df, prefix))
    edges = spark.createDataFrame([(1, i) for i in range(2, 50)] + [(70, 60), (60, 70)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {i: 1 for i in range(1, 50)} | {60: 60, 70: 60}
    assert len(written) == 1
