"""Document fingerprints by locally consistent parsing.

A text's code points are level 0.  To make a level, runs of equal names become one name each, so that neighbours differ.
Deterministic coin tossing then gives every place a small label: the lowest bit in which its name differs from its left
neighbour's, and that bit's value; tossed four times, there are at most six labels, and neighbours still differ.  Places
whose label is larger than both neighbours' begin a phrase; a phrase's name is a hash of the names in it, and the names
are the next level, until one is left.  Where a phrase begins depends on a few names around it, so equal substrings are
parsed alike but for their margins, wherever they stand.

A fingerprint is a bottom-k sketch of the distinct names of levels ``LEVEL`` and up (of lower ones as well in short texts,
see ``least_level``): the ``SKETCH`` smallest hashes with their level, as hex.  Likeness of two fingerprints is the sketch
estimate of the Jaccard similarity of the names on the levels that both hold: exact for texts with few names.

Neighbours in the order of the documents are found without a global sort in one task: rows are cut into ranges of the
order by quantiles, each range is sorted in a task and gets a copy of the first row of the range behind it.

Defined results: a null text is empty, an empty text has an empty fingerprint, which is like itself and nothing else; the
order is doc_id descending, null last, rows with equal doc_id by a 128-bit hash of their text (so rows that are equal in
both are interchangeable); a single row is its own next document; an empty table gives no rows; texts of any length are
parsed whole; only doc_id and text are read, other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import text_of

LEVEL = 2
SKETCH = 64
#: Code points parsed at once.
CHUNK = 1 << 20
#: Ranges of the order for each shuffle partition.
RANGES = 4
#: Bits of a sketch entry: hash, and level in the low ones.
HASH_BITS, LEVEL_BITS = 36, 4
ENTRY_BYTES = (HASH_BITS + LEVEL_BITS) // 8
#: Multipliers of the hashes.
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15))
#: Place in a phrase -> multiplier (a phrase holds at most 11 names, but for a text's first one).
PLACES = np.multiply.accumulate(np.full(64, MIX[2]))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX[0]
    x = (x ^ (x >> np.uint64(29))) * MIX[1]
    return x ^ (x >> np.uint64(32))


def _toss_table() -> np.ndarray:
    """Label for a pair of different labels below 128 (own * 128 + left neighbour's)."""
    own, left = np.divmod(np.arange(1 << 14), 128)
    differ = own ^ left
    bit = np.bitwise_count((differ & -differ) - 1).astype(np.int64) % 64
    return (2 * bit + ((own >> bit) & 1)).astype(np.uint8)


TOSS = _toss_table()


def labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6 of names that differ from their neighbours; ``first`` are the places where texts begin."""
    out = np.empty(len(names), np.uint8)
    differ = names[1:] ^ names[:-1]
    bit = np.bitwise_count((differ & -differ) - np.uint64(1))
    out[1:] = 2 * bit + ((names[1:] >> (bit & 63).astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    out[first] = (names[first] & np.uint64(1)).astype(np.uint8)
    for _ in range(3):
        lower = out[first] & 1
        out[1:] = TOSS[(out[1:].astype(np.uint16) << 7) | out[:-1]]
        out[first] = lower
    return out


def parse(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level up: the phrases' names and documents."""
    new = np.empty(len(names), bool)
    new[0] = True
    np.not_equal(names[1:], names[:-1], out=new[1:])
    new[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new)
    run = np.diff(np.append(at, len(names))).astype(np.uint64)
    names, doc = mixed(names[at] + run * MIX[2]), doc[at]
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    label = labels(names, first)
    begins = np.zeros(len(names), bool)
    begins[1:] = label[1:] > label[:-1]
    begins[:-1] &= label[:-1] > label[1:]
    ends = first[1:] - 1  # the last place of a text has no right neighbour
    begins[ends] = label[ends] > label[np.maximum(ends - 1, 0)]
    second = first[:-1] + 1 if len(first) and first[-1] + 1 == len(names) else first + 1
    begins[second] = False  # so that every level has fewer names
    begins[first] = True
    at = np.flatnonzero(begins)
    place = np.arange(len(names)) - np.repeat(at, np.diff(np.append(at, len(names))))
    weighed = names * PLACES[place & 63]
    return mixed(np.add.reduceat(weighed, at) + MIX[0]), doc[at]


def least_level(chars: int) -> int:
    """Texts of few phrases are compared on lower levels as well."""
    return LEVEL if chars >= 64 else 1 if chars >= 16 else 0


def sketches(texts: list[str], k: int = SKETCH) -> list[np.ndarray]:
    """The sorted sketch entries of each text."""
    parts = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
    size = np.array([len(p) for p in parts], np.int64)
    least = np.array([least_level(n) for n in size.tolist()], np.int64)
    names = np.concatenate([*parts, np.zeros(0, np.uint32)]).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), size)
    found, level = [], 0
    while len(names):
        shown = least[doc] <= level
        held, own = doc[shown], names[shown]
        apart = np.uint64((level + 1) * int(MIX[1]) & ((1 << 64) - 1))  # equal names of two levels differ
        entry = mixed(own + apart) >> np.uint64(64 - HASH_BITS)
        found.append((held, (entry << np.uint64(LEVEL_BITS)) | np.uint64(min(level, (1 << LEVEL_BITS) - 1))))
        if level >= LEVEL:  # a text of one name is done
            n = np.bincount(doc, minlength=len(texts))
            more = n[doc] > 1
            names, doc = names[more], doc[more]
        if len(names):
            names, doc = parse(names, doc)
        level += 1
    if not found:
        return [np.zeros(0, np.uint64)] * len(texts)
    doc, entry = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((entry, doc))
    doc, entry = doc[order], entry[order]
    one = np.r_[True, (doc[1:] != doc[:-1]) | (entry[1:] != entry[:-1])] if len(doc) else np.zeros(0, bool)
    doc, entry = doc[one], entry[one]
    begin = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [entry[s:min(e, s + k)] for s, e in zip(begin[:-1].tolist(), begin[1:].tolist())]


def fingerprint(entries: np.ndarray, chars: int) -> str:
    """Least level, then the entries in hex; empty for an empty text."""
    if not chars:
        return ""
    raw = entries.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - ENTRY_BYTES:]
    return f"{least_level(chars)}:{raw.tobytes().hex()}"


def read(text: str) -> tuple[int, np.ndarray]:
    """(least level, entries) of a fingerprint."""
    if not text:
        return 0, np.zeros(0, np.uint64)
    raw = np.frombuffer(bytes.fromhex(text[2:]), np.uint8).reshape(-1, ENTRY_BYTES).astype(np.uint64)
    entries = np.zeros(len(raw), np.uint64)
    for column in raw.T:
        entries = (entries << np.uint64(8)) | column
    return int(text[0]), entries


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray], k: int = SKETCH) -> float:
    """Estimated Jaccard similarity of two texts' names, from (least level, entries) of their fingerprints."""
    least = max(a[0], b[0])
    x, y = (e if level == least else e[(e & np.uint64((1 << LEVEL_BITS) - 1)) >= least] for level, e in (a, b))
    if not len(x) or not len(y):
        return float(len(x) == len(y) and len(a[1]) == len(b[1]))
    both = np.concatenate([x, y])
    both.sort()
    again = both[1:] == both[:-1]  # entries of a sketch differ, so an equal neighbour comes from the other one
    distinct = np.r_[True, ~again]
    last = np.flatnonzero(distinct)[:k][-1]
    return float(again[:last + 1].sum() / min(k, int(distinct.sum())))


def ordered_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """(_range, _peek, doc_id, text): ``docs`` in ranges of their order; each range has as its last row (_peek 1) a copy of
    the row that follows it, and the last range a copy of the very first row."""
    text = text_of().alias("text")
    h = F.xxhash64(text_of())
    rows = docs.select("doc_id", text, F.shiftrightunsigned(h, 54).alias("_h0"), h.alias("_h1"),
                       F.xxhash64(F.lit(7), text_of()).alias("_h2"))
    # a number that rises with (doc_id, _h0), so that rows with one doc_id are spread as well
    part = F.col("_h0") / 1024.0
    key = F.coalesce(F.col("doc_id").cast("double") + part, (part - 2) * float(2 ** 64))
    rows = rows.withColumn("_key", key)
    cuts = sorted(set(rows.approxQuantile("_key", [i / ranges for i in range(1, ranges)], 0.2 / ranges)))
    if cuts:
        bucket = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="_key", outputCol="_bucket")
        rows = bucket.transform(rows).withColumn("_range", -F.col("_bucket").cast("int")).drop("_bucket", "_key")
    else:
        rows = rows.withColumn("_range", F.lit(0)).drop("_key")
    order = ["doc_id", "_h0", "_h1", "_h2"]
    # the first row of each range: a row for each range
    tops = sorted(rows.groupBy("_range").agg(F.max(F.struct(*order)).alias("top")).collect())
    if not tops:
        return rows.select("_range", F.lit(0).alias("_peek"), "doc_id", "text")
    follows = [(own["_range"], *behind["top"]) for own, behind in zip(tops, [*tops[1:], tops[0]])]
    kinds = ", ".join(f"n{i} {t}" for i, t in enumerate([rows.schema[c].dataType.simpleString() for c in order]))
    small = docs.sparkSession.createDataFrame(follows, f"_owner int, {kinds}")
    met = F.lit(True)
    for i, c in enumerate(order):
        met = met & F.col(c).eqNullSafe(F.col(f"n{i}"))
    peeks = rows.join(F.broadcast(small), met).dropDuplicates(["_owner"])
    return rows.select("_range", F.lit(0).alias("_peek"), *order, "text").union(
        peeks.select(F.col("_owner").alias("_range"), F.lit(1).alias("_peek"), *order, "text")).repartition(
        "_range").sortWithinPartitions("_range", "_peek", *[F.col(c).desc() for c in order]).select(
        "_range", "_peek", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the first as many code points of the next document."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def fingerprints(docs: DataFrame, k: int = SKETCH, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.schema["doc_id"].dataType

    def solve(doc_ids: list, texts: list[str]) -> pa.RecordBatch:
        """For all texts but the last, which is only the next of the one before it."""
        changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
        found = sketches(texts + changed, k)
        own = [(least_level(len(t)), e) for t, e in zip(texts + changed, found)]
        n = len(changed)
        new = own[len(texts):]
        columns = [
            pa.array(doc_ids), pa.array([len(t) for t in texts[:n]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
            pa.array([fingerprint(e, len(t)) for t, (_, e) in zip(texts[:n], own)]),
            pa.array([fingerprint(e, len(t)) for t, (_, e) in zip(changed, new)]),
            pa.array([likeness(a, b, k) for a, b in zip(own, new)], pa.float64()),
            pa.array([likeness(a, b, k) for a, b in zip(own[:n], own[1:])], pa.float64())]
        return pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(7)])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, where, doc_ids, texts, size = None, None, [], [], 0
        for batch in batches:
            kind = batch.column(2).type
            for here, peek, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if here != where:  # the row before was a range's last one, known by its predecessor
                    if doc_ids:
                        yield cast(solve(doc_ids, texts), kind)
                    where, doc_ids, texts, size = here, [], [], 0
                texts.append(text)
                size += len(text)
                if size >= chunk and doc_ids:
                    yield cast(solve(doc_ids, texts), kind)
                    doc_ids, texts, size = [], texts[-1:], len(text)
                if not peek:
                    doc_ids.append(doc_id)
        if doc_ids:
            yield cast(solve(doc_ids, texts), kind)

    def cast(batch: pa.RecordBatch, kind: pa.DataType) -> pa.RecordBatch:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(kind), *batch.columns[1:]], names)

    return ordered_ranges(docs, RANGES * parts).mapInArrow(
        make, f"doc_id {ids.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
