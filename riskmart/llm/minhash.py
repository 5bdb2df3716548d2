"""Near-duplicate detection with bottom-k sketches from one hash function.

A document's set are the 64-bit hashes of its distinct five-word shingles (words with A-Z in lower case; with fewer
words, the whole sequence).  Documents with the same set are one node; nodes are numbered.  The retained values of a
node are the ``k`` smallest hashes of its set, in order.

Inverted lists are kept for runs of four retained values that follow each other.  A set of two documents with a Jaccard
similarity of 0.85 has, in the order of the hash, 85 of 100 values in both, so four in a row are in both almost surely
(the share of such pairs without any is below one in a million for k = 48, and none for sets small enough to be
retained whole); a passage that many otherwise different documents share hardly ever fills a run.  Below 85 % k is 64,
which keeps that share below one in a million down to 80 %.  Small sets have shorter runs too, see ``run_lengths``.

Lists give candidates without expanding a long list into its pairs.  First every node meets the hub of each of its
lists: the most typical member, whose runs are shared most.  The links so found make components.  In lists whose members
are still in several components, all pairs between components meet where there are at most ``small`` members; in longer
ones the members outside meet the medoid of the largest component (of a text and its copies, as a rule, the text that
the copies were made from) and one more hub.  Linked documents that both are far from a medoid differ from it in the
same places, and runs through these places make shorter lists without it.  A second round does this for what is left.
Long lists that still hold several components are then settled exactly: their members outside a list's largest component
meet all members of other components with which they share one of their rarest shingles, as any two sets that reach the
similarity do.  Candidates whose sizes allow the similarity are estimated on the bottom-k sketch of their union; those
not far below the threshold are confirmed on the full sets.  Links make the components.

Defined results: a null or blank text has the empty set: it is linked with nothing and kept; rows that repeat doc_id and
text are one document; a null doc_id is larger than any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import bitmap, id_back, id_text, in_bitmap, text_of
from riskmart.llm.components import connected_components
from riskmart.session import checkpoint_table

SHINGLE = 5
K = 48
#: Retained values for thresholds below PERCENT.
LOW_K = 64
RUN = 4
PERCENT = 85
SMALL = 16
#: Rounds of hubs and medoids before the exact join.
ROUNDS = 2
#: Members of open lists that hold a shingle, for each part into which its join is cut.
SALT_ROWS = 2048
#: Standard errors by which the estimate may fall short of the threshold before a candidate is dropped.
SLACK = 5.0
#: Hashes of words that a Python worker remembers; beyond it, it forgets all and starts again.
WORD_MEMORY = 400_000
#: Odd multipliers for the places in a shingle, then two for mixing.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                    0xA0761D6478BD642F, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * FACTORS[5]
    x = (x ^ (x >> np.uint64(29))) * FACTORS[6]
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted distinct hashes of a text's shingles."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()  # bytes: ASCII letters and the six blanks only
        known = self.known
        if len(known) > WORD_MEMORY:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h, n = np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), len(words)
        if n < SHINGLE:
            total = (h * FACTORS[:n]).sum(dtype=np.uint64, keepdims=True)[:n] + np.uint64(n)
        else:
            total = np.zeros(n - SHINGLE + 1, np.uint64)
            for j in range(SHINGLE):
                total += h[j:n - SHINGLE + 1 + j] * FACTORS[j]
        return np.unique(_mixed(total).view(np.int64))


def digest_of(shingles: np.ndarray) -> str:
    """128 bits: equal digests are taken for equal sets."""
    return xxhash.xxh3_128_hexdigest(shingles.tobytes())


def row_key() -> Column:
    """128 bits of doc_id and text: equal keys are taken for equal rows."""
    own = F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("-" * 32))
    return F.md5(F.concat(own, text_of()))


def sketches(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, key (of the row), digest (null for an empty set), n (size of the set), sketch, for each row."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for b in batches:
            sets = [shingler(t) for t in b["text"]]
            digest = [digest_of(s) if len(s) else None for s in sets]
            yield pd.DataFrame({"doc_id": b["doc_id"], "key": b["key"], "digest": digest,
                                "n": [len(s) for s in sets], "sketch": [s[:k] for s in sets]})

    made = docs.select(id_text(), row_key().alias("key"), text_of().alias("text")).mapInPandas(
        make, "doc_id string, key string, digest string, n long, sketch array<long>")
    return id_back(made, docs)


def numbered(rows: DataFrame) -> DataFrame:
    """(node, digest, key, first_id, n, sketch) of the distinct sets of ``rows``: all that follows meets by the number
    ``node``, a quarter of what 128 bits take as text.  The table is written, so that the numbers stay."""
    made = rows.filter("digest is not null").groupBy("digest").agg(
        F.min("key").alias("key"), F.min("doc_id").alias("first_id"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch"))  # of equal sets, n and sketch are equal
    return checkpoint_table(made.select(F.monotonically_increasing_id().alias("node"), "*"), "near")


def full_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes (node, key of one of its rows), from the texts; a bitmap of their keys keeps most
    other texts out of the shuffle."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for b in batches:
            yield pd.DataFrame({"node": b["node"], "shingles": [shingler(t) for t in b["text"]]})

    bits = F.broadcast(bitmap(nodes.select(F.col("key").alias("_id"))))  # of fixed size
    texts = docs.select(row_key().alias("key"), text_of().alias("text")).join(bits, in_bitmap(F.col("key")), "left_semi")
    rows = texts.dropDuplicates(["key"]).join(nodes.select("key", "node"), "key")
    return rows.select("node", "text").mapInPandas(make, "node long, shingles array<long>")


def run_lengths(n: int, percent: int) -> set[int]:
    """Lengths of the runs that a set of n shingles needs.

    Of a union of u values at least ceil(percent * u / 100) are in both sets; the others cut these into one part more
    than there are others, so the longest part has at least the mean length.  Both sets know the u that they can have.
    """
    lengths = set()
    for u in range(n, 100 * n // percent + 1):
        both = -(-percent * u // 100)
        if both < u:  # otherwise only equal sets reach it
            lengths.add(min(RUN, -(-both // (u - both + 1))))
    return lengths


def run_keys(sketch: Column, n: Column, percent: int = PERCENT, k: int = K) -> Column:
    """Hashes of the runs; sets that are not retained whole have runs of four."""

    def runs(length: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(sketch) - length), lambda i: F.xxhash64(
            *[F.get(sketch, i + j) for j in range(length)]))

    none = F.array().cast("array<long>")
    needed = {m: run_lengths(m, percent) for m in range(1, k + 1)}
    parts = []
    for length in range(1, RUN + 1):
        has = n.isin([m for m in needed if length in needed[m]])
        if length == RUN:
            has = has | (n > k)
        parts.append(F.when(has, runs(length)).otherwise(none))
    return F.concat(*parts)


def inverted_lists(nodes: DataFrame, percent: int = PERCENT, k: int = K) -> DataFrame:
    """(run, node, n, members, typical, hub) for each member of a list with two nodes or more.

    ``typical`` adds up the members of all lists that hold the node: of the copies of a text, that with the fewest
    changes of its own has most.  A list's hub is its most typical member.
    """
    keys = F.array_distinct(run_keys(F.col("sketch"), F.col("n"), percent, k))
    runs = nodes.select("node", "n", F.explode(keys).alias("run"))
    shared = runs.groupBy("run").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    rows = checkpoint_table(runs.join(shared, "run"), "near")
    rows = checkpoint_table(rows.join(rows.groupBy("node").agg(F.sum("members").alias("typical")), "node"), "near")
    hubs = rows.groupBy("run").agg(F.max(F.struct("typical", "node")).alias("hub"))
    return checkpoint_table(rows.join(hubs, "run").select(
        "run", "node", "n", "members", "typical", F.col("hub.node").alias("hub")), "near")


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b), a < b, of candidates (x, y, nx, ny) whose sizes allow the similarity."""
    fits = F.least("nx", "ny") * 100 >= percent * F.greatest("nx", "ny")
    return rows.filter(fits).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def hub_candidates(lists: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    rows = lists.filter("node <> hub").select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("hub").alias("y"))
    return _pairs(rows.distinct().join(sizes.select(F.col("node").alias("y"), F.col("n").alias("ny")), "y"), percent)


def medoids(component: DataFrame, sets: DataFrame, small: int) -> DataFrame:
    """(component, size, medoid) of the components with more than ``small`` nodes: the member that differs least from
    all members together.

    The differences to all members add up from the numbers of members that hold each shingle: one that d of m hold
    counts m - d if the member has it and d if not.  So it takes two aggregates over the members' shingles.
    """
    sizes = component.groupBy("component").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > small)
    held = sets.join(component.join(sizes, "component"), "node").select(
        "component", "size", "node", F.explode("shingles").alias("shingle"))
    holders = held.groupBy("component", "shingle").agg(F.count(F.lit(1)).alias("holders"))
    differs = held.join(holders, ["component", "shingle"]).groupBy("component", "size", "node").agg(
        F.sum(F.col("size") - 2 * F.col("holders")).alias("differs"))
    return differs.groupBy("component", "size").agg(F.min(F.struct("differs", "node")).alias("best")).select(
        "component", "size", F.col("best.node").alias("medoid"))


def open_candidates(lists: DataFrame, nodes: DataFrame, component: DataFrame, middle: DataFrame, percent: int,
                    small: int) -> DataFrame:
    """Pairs of members of different components of a list: all of them in lists of at most ``small`` members; in longer
    ones each member meets the medoid of the largest component in the list, and the most typical member outside the
    first hub's component."""
    placed = component.join(middle, "component", "left")
    rows = lists.join(placed, "node", "left").withColumn("component", F.coalesce("component", "node"))
    bounds = rows.groupBy("run").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.max(F.when(F.col("node") == F.col("hub"), F.col("component"))).alias("first"),
                                     F.max(F.struct("size", "component", "medoid")).alias("largest"))
    rows = checkpoint_table(rows.join(bounds.filter("lo <> hi").select("run", "first", "largest"), "run"), "near")
    few = rows.filter(F.col("members") <= small)
    x = few.select("run", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("component").alias("cx"))
    y = few.select("run", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("component").alias("cy"))
    met = x.join(y, "run").filter("x < y and cx <> cy").select("x", "y", "nx", "ny")
    many = rows.filter(F.col("members") > small)
    own = [F.col("node").alias("x"), F.col("n").alias("nx")]
    second = many.filter("component <> first").groupBy("run").agg(
        F.max(F.struct("typical", "node", "component")).alias("top"))
    outside = many.join(second, "run").filter("component <> top.component").select(*own, F.col("top.node").alias("y"))
    centre = rows.filter("largest.medoid is not null and component <> largest.component").select(
        *own, F.col("largest.medoid").alias("y"))
    size = nodes.select(F.col("node").alias("y"), F.col("n").alias("ny"))
    star = outside.union(centre).distinct().join(size, "y").select("x", "y", "nx", "ny")
    return _pairs(met.union(star), percent)


def open_members(lists: DataFrame, component: DataFrame, small: int) -> DataFrame:
    """(node, n, component, outside) of the members of long lists that hold several components; ``outside`` tells that
    one of these lists has more members of another component."""
    rows = lists.filter(F.col("members") > small).select("run", "node", "n").join(component, "node", "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    parts = rows.groupBy("run", "component").agg(F.count(F.lit(1)).alias("part"))
    largest = parts.groupBy("run").agg(F.count(F.lit(1)).alias("parts"),
                                       F.max(F.struct("part", "component"))["component"].alias("largest"))
    rows = rows.join(largest.filter("parts > 1"), "run")
    return rows.groupBy("node", "n", "component").agg(F.max(F.col("component") != F.col("largest")).alias("outside"))


def rest_candidates(members: DataFrame, sets: DataFrame, percent: int, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Pairs of ``members`` of different components, at least one of them outside, that can reach the similarity.

    Two sets that reach it share one of the first ``n - ceil(percent * n / 100) + 1`` shingles of each, in any order
    that is the same for all; here the rarest come first.  At their first common shingle as many must follow in both
    as the similarity needs.  A shingle that many members hold is joined in parts.
    """
    held = members.join(sets, "node").select("node", "n", "component", "outside", F.explode("shingles").alias("shingle"))
    holders = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    rows = held.join(holders, "shingle").groupBy("node", "n", "component", "outside").agg(
        F.array_sort(F.collect_list(F.struct("holders", "shingle"))).alias("shared"))
    rows = rows.withColumn("single", F.col("n") - F.size("shared"))  # shingles of no other member come before all
    first = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1 - F.col("single")
    rows = rows.withColumn("shared", F.slice("shared", F.lit(1), F.greatest(first, F.lit(0)).cast("int")))
    rows = rows.select("node", "n", "component", "outside", "single", F.posexplode("shared").alias("at", "s")).select(
        "node", "n", "component", "outside", (F.col("n") - F.col("single") - F.col("at")).alias("left"),
        F.col("s.shingle").alias("shingle"), (1 + F.floor(F.col("s.holders") / salt_rows)).alias("salts"))
    rows = checkpoint_table(rows, "near")
    x = rows.filter("outside").select(
        "shingle", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
        F.col("node").alias("x"), F.col("n").alias("nx"), F.col("component").alias("cx"), F.col("left").alias("lx"))
    y = rows.select("shingle", F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt"), F.col("node").alias("y"),
                    F.col("n").alias("ny"), F.col("component").alias("cy"), F.col("left").alias("ly"))
    enough = (100 + percent) * F.least("lx", "ly") >= percent * (F.col("nx") + F.col("ny"))
    return _pairs(x.join(y, ["shingle", "salt"]).filter((F.col("cx") != F.col("cy")) & enough), percent)


def similar_sketches(pairs: DataFrame, nodes: DataFrame, percent: int, k: int) -> DataFrame:
    """The pairs whose similarity, estimated on the k smallest values of their union, is not far below the threshold."""
    a = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    rows = pairs.join(a, "a").join(b, "b").withColumn("u", union)
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), "u"))
    j = percent / 100
    least = j - F.when(F.size("u") < k, 0.0).otherwise(SLACK * (j * (1 - j) / k) ** 0.5)
    return rows.filter(both >= least * F.size("u") - 1e-9).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union of their full sets."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    # b first, by which similar_sketches leaves the pairs dealt
    rows = pairs.join(b, "b").join(a, "a").select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb")).alias("s"))
    return rows.filter(100 * F.col("i") >= percent * (F.col("s") - F.col("i"))).select("a", "b")


def grouped(docs: DataFrame, percent: int = PERCENT, k: int | None = None, small: int = SMALL) -> DataFrame:
    """doc_id, key, n_shingles, component (null for an empty set), component_id for each row."""
    if percent < 80:
        raise ValueError("runs of retained values find similarities of 80 % or more")
    k = k or (K if percent >= PERCENT else LOW_K)
    rows = checkpoint_table(sketches(docs, k), "near")
    nodes = numbered(rows)
    lists = inverted_lists(nodes, percent, k)
    found = nodes.select("node", "key").join(lists.select("node").distinct(), "node", "left_semi")
    sets = checkpoint_table(full_sets(docs, checkpoint_table(found, "near")), "near")
    candidates = checkpoint_table(sets.select(
        "node", F.size("shingles").cast("long").alias("n"), F.slice("shingles", 1, k).alias("sketch")), "near")

    def links(pairs: DataFrame) -> DataFrame:
        return checkpoint_table(confirmed(similar_sketches(pairs, candidates, percent, k), sets, percent), "near")

    by_hub = links(hub_candidates(lists, candidates, percent))
    component = checkpoint_table(connected_components(by_hub), "near")

    def linked(more: DataFrame) -> DataFrame:
        star = component.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return checkpoint_table(connected_components(star.union(more)), "near")

    unmet = lists
    for _ in range(ROUNDS):
        middle = checkpoint_table(medoids(component, sets, small), "near")
        more = links(open_candidates(unmet, candidates, component, middle, percent, small))
        if more.isEmpty():
            break
        component = linked(more)
        unmet = lists.filter(F.col("members") > small)  # all pairs of the others have met
    members = checkpoint_table(open_members(lists, component, small), "near")
    if not members.isEmpty():
        component = linked(links(rest_candidates(members, sets, percent)))
    member = nodes.select("node", "digest", "first_id").join(component, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    smallest = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    member = member.join(smallest, "component").select("digest", "component", "component_id")
    out = rows.select("doc_id", "key", "digest", "n").join(member, "digest", "left")
    own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), "component", own.alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, k: int | None = None, small: int = SMALL) -> DataFrame:
    """doc_id, key, n_shingles, component_id, kept for each row; ``percent`` must be at least 80."""
    return grouped(docs, percent, k, small).drop("component").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id, of equal or only null ids the one
    with the smallest key; all columns stay."""
    cols = docs.columns
    rows = checkpoint_table(grouped(docs.select("doc_id", "text"), **options), "near")
    first = rows.filter("component is not null").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))["key"].alias("key"))
    found = first.select("key").union(rows.filter("component is null").select("key")).distinct()
    rows = docs.select(F.struct(*cols).alias("row"), row_key().alias("key")).join(found, "key", "left_semi")
    return rows.dropDuplicates(["key"]).select(*[F.col("row").getField(c).alias(c) for c in cols])
