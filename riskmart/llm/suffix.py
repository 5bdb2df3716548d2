"""Removing byte strings that occur more than once: depth-limited radix sort of suffixes.

A suffix matters only through its first ``length`` bytes, so suffixes are ordered by a few digits, most significant
first, and after each pass only groups of two or more go on.  What is equal through all digits is a repeated window.

Sorting every suffix of a corpus would move several times its bytes, so the digits are aligned to the content.  Of each
window of ``length`` bytes its least ``DIGIT``-byte string (by hash) is an anchor; equal windows have their anchors at
the same place, so it is enough to compare windows around equal anchors.

1. First digit: the anchor.  Anchors that occur once are done.
2. The remaining digits, as one: all bytes that windows around the anchor can reach.  Where these occur twice, every
   window around the anchor is repeated, and the whole reach is removed.
3. The other occurrences differ from all others somewhere in reach.  In each group of equal anchors they are sorted by
   the bytes to the right and by the bytes to the left; common prefixes of neighbours in these orders give the exact
   bytes that any two have in common.  Over the others with which an occurrence shares ``length`` bytes, the longest
   reach to each side bounds the removed bytes, because all these strings hold the anchor.
   Groups of more than ``LOCAL`` different occurrences are not gathered: there every window around every anchor is a row
   of its own, and windows are counted by a distributed aggregate.

Strings are compared by 64-bit hashes in passes 1 and 2, byte by byte in 3.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; equal texts (repeated rows as well)
repeat each other; windows may overlap their other occurrence; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import id_back, id_text, text_of
from riskmart.session import checkpoint_table

LENGTH = 400
DIGIT = 128
#: Different occurrences of an anchor that one task sorts (some 600 bytes each).
LOCAL = 1 << 16
#: Bytes hashed at once in a Python worker.
CHUNK = 1 << 20
#: Base of the polynomial hash, its inverse mod 2**64, and multipliers for mixing.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
KEY = ["k1", "k2"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX[0]
    x = (x ^ (x >> np.uint64(29))) * MIX[1]
    return x ^ (x >> np.uint64(32))


#: A 64-bit value for each byte value, and powers of the base and of its inverse (grown as needed).
BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 1 << 16)
        _POWERS[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, b, np.uint64)]) for b in (BASE, INVERSE)]
    return _POWERS


class Hashes:
    """Hashes of substrings of a byte array."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTES[data] * up[:len(data)], out=self.sums[1:])

    def __call__(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[first]) * self.down[first])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """Least or greatest value of each ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        x = best(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return best(x[:len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, length: int = LENGTH, digit: int = DIGIT) -> tuple[np.ndarray, ...]:
    """Places of the anchors of a text, hash of each anchor, and hash of all that windows around it can reach."""
    reach, n = length - digit, len(data)
    out = []
    for at in range(0, n - length + 1, CHUNK):
        # windows that start in [at, at + CHUNK), with the reach of their anchors on both sides
        lo, hi = max(0, at - reach), min(n, at + CHUNK - 1 + length + reach)
        h = Hashes(data[lo:hi])
        starts = min(at + CHUNK, n - length + 1) - at
        grams = h.all(digit)[at - lo:at - lo + starts + reach]
        least = _sliding(grams, reach + 1, np.minimum)
        pad = np.zeros(reach, np.uint64)
        chosen = _sliding(np.r_[pad, least, pad], reach + 1, np.maximum) == grams
        place = np.flatnonzero(chosen) + (at - lo)
        first, end = np.maximum(place - reach, 0), np.minimum(place + length, hi - lo)
        sides = ((place - first) * (length + 1) + (end - place)).astype(np.uint64)
        out.append((place + lo, h(place, place + digit), _mixed(h(first, end) + sides)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    place, seed, around = (np.concatenate(x) for x in zip(*out))
    place, one = np.unique(place, return_index=True)
    return place, seed[one], around[one]


def _text_keys() -> list[Column]:
    return [F.xxhash64(text_of()).alias("k1"), F.xxhash64(F.lit(7), text_of()).alias("k2")]


def anchor_table(docs: DataFrame, length: int, digit: int) -> DataFrame:
    """(k1, k2, pos, seed, around) of the anchors of all texts; of equal texts in a task the first two."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple, int] = {}
        for b in batches:
            parts = []
            for k1, k2, text in zip(b["k1"], b["k2"], b["text"]):
                times = seen[k1, k2] = seen.get((k1, k2), 0) + 1
                if times > 2:
                    continue
                pos, seed, around = anchors(np.frombuffer(text.encode(), np.uint8), length, digit)
                parts.append((np.full(len(pos), k1), np.full(len(pos), k2), pos, seed.view(np.int64),
                              around.view(np.int64)))
            if parts:
                yield pd.DataFrame(dict(zip(["k1", "k2", "pos", "seed", "around"], map(np.concatenate, zip(*parts)))))

    rows = docs.select(*_text_keys(), text_of().alias("text")).filter(F.octet_length("text") >= length)
    return rows.mapInPandas(make, "k1 long, k2 long, pos long, seed long, around long")


def contexts(docs: DataFrame, wanted: DataFrame, length: int, digit: int) -> DataFrame:
    """``wanted`` (k1, k2, pos, seed, around, n) with the bytes in reach on both sides of the anchor."""
    reach = length - digit
    columns = ["pos", "seed", "around", "n"]

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k1, k2, text, places in zip(b["k1"], b["k2"], b["text"], b["places"]):
                data = text.encode()
                for p in places:
                    pos = p["pos"]
                    rows.append((k1, k2, pos, p["seed"], p["around"], p["n"], data[max(0, pos - reach):pos],
                                 data[pos + digit:pos + length]))
            yield pd.DataFrame(rows, columns=[*KEY, *columns, "left", "right"])

    texts = docs.select(*_text_keys(), text_of().alias("text")).filter(
        F.octet_length("text") >= length).dropDuplicates(KEY)
    places = wanted.groupBy(*KEY).agg(F.collect_list(F.struct(*columns)).alias("places"))  # at most a text's anchors
    return texts.join(places, KEY).mapInPandas(
        make, "k1 long, k2 long, pos long, seed long, around long, n long, left binary, right binary")


def _common(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings and the length of the prefix that each shares with the one before it in this order."""
    table = np.zeros((len(strings), width), np.uint8)
    size = np.array([len(s) for s in strings])
    for row, s in zip(table, strings):
        row[:len(s)] = np.frombuffer(s, np.uint8)
    # the length is the last digit, so that an end is not taken for a zero byte's neighbour
    order = np.lexsort([size, table.view(f"S{width}").ravel()]) if width else np.argsort(size, kind="stable")
    table, size = table[order], size[order]
    differ = table[1:] != table[:-1]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.r_[0, np.minimum(prefix, np.minimum(size[1:], size[:-1]))]


def _to_all(shared: np.ndarray, at: int) -> np.ndarray:
    """Common prefix of the string at place ``at`` of the order with every other one."""
    out = np.empty(len(shared), shared.dtype)
    out[at] = np.iinfo(shared.dtype).max
    out[at + 1:] = np.minimum.accumulate(shared[at + 1:])
    out[:at] = np.minimum.accumulate(shared[1:at + 1][::-1])[::-1]
    return out


def group_reaches(left: list[bytes], right: list[bytes], alone: np.ndarray, reach: int) -> Iterator[tuple]:
    """For the occurrences of an anchor that are ``alone``: (number, bytes removed to the left, and to the right)."""
    n = len(left)
    by_left, shared_left = _common([x[::-1] for x in left], reach)
    by_right, shared_right = _common(right, reach)
    place_left, place_right = np.argsort(by_left), np.argsort(by_right)
    in_right = place_right[by_left]  # the others in the order of the left side
    for i in np.flatnonzero(alone):
        a = _to_all(shared_left, place_left[i])
        b = _to_all(shared_right, place_right[i])[in_right]
        fits = (a + b >= reach) if n > 1 else np.zeros(1, bool)
        fits[place_left[i]] = False
        if fits.any():
            yield i, int(a[fits].max()), int(b[fits].max())


def exact_spans(rows: DataFrame, length: int, digit: int) -> DataFrame:
    """(k1, k2, first, end) of the occurrences that are alone, from their contexts, a group of equal anchors at once."""
    reach = length - digit

    def solve(group: pd.DataFrame) -> list[tuple]:
        found = group_reaches(group["left"].tolist(), group["right"].tolist(), (group["n"] == 1).to_numpy(), reach)
        k1, k2, pos = (group[c].to_numpy() for c in ("k1", "k2", "pos"))
        return [(k1[i], k2[i], pos[i] - a, pos[i] + digit + b) for i, a, b in found]

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None  # the last group of a batch may go on in the next
        for b in batches:
            if kept is not None:
                b = pd.concat([kept, b], ignore_index=True)
            seed = b["seed"].to_numpy()
            begin = np.flatnonzero(np.r_[True, seed[1:] != seed[:-1]]) if len(seed) else np.zeros(0, int)
            if not len(begin):
                continue
            out = [x for s, e in zip(begin[:-1], begin[1:]) for x in solve(b.iloc[s:e])]
            kept = b.iloc[begin[-1]:]
            yield pd.DataFrame(out, columns=[*KEY, "first", "end"])
        if kept is not None:
            yield pd.DataFrame(solve(kept), columns=[*KEY, "first", "end"])

    return rows.repartition("seed").sortWithinPartitions("seed").mapInPandas(
        make, "k1 long, k2 long, first long, end long")


def counted_spans(rows: DataFrame, length: int, digit: int) -> DataFrame:
    """The same for groups of any size: every window around every anchor is a row, equal rows are counted."""
    reach = length - digit

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k1, k2, pos, seed, left, right in zip(*(b[c] for c in (*KEY, "pos", "seed", "left", "right"))):
                back = np.arange(max(0, reach - len(right)), len(left) + 1)
                first = len(left) - back
                # bytes of the anchor itself are equal within a group
                h = Hashes(np.frombuffer(left + right, np.uint8))
                yield pd.DataFrame({"k1": k1, "k2": k2, "pos": pos, "seed": seed, "back": back,
                                    "window": h(first, first + reach).view(np.int64)})

    each = checkpoint_table(rows.mapInPandas(
        make, "k1 long, k2 long, pos long, seed long, back long, window long"), "suffix")
    same = each.groupBy("seed", "back", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return each.join(same, ["seed", "back", "window"]).groupBy(*KEY, "pos").agg(
        F.max("back").alias("most"), F.min("back").alias("fewest")).select(
        *KEY, (F.col("pos") - F.col("most")).alias("first"), (F.col("pos") + length - F.col("fewest")).alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, digit: int = DIGIT, local: int = LOCAL) -> DataFrame:
    """(k1, k2, spans): for each distinct text with repeats the (first, end) of strings to remove; they may overlap."""
    reach = length - digit
    table = checkpoint_table(anchor_table(docs, length, digit), "suffix")
    twice = table.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    table = checkpoint_table(table.join(twice, "seed"), "suffix")
    classes = checkpoint_table(table.groupBy("seed", "around").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "pos")).alias("one")), "suffix")
    whole = table.join(classes.filter("n > 1").select("seed", "around"), ["seed", "around"]).select(
        *KEY, F.greatest(F.col("pos") - reach, F.lit(0)).alias("first"), (F.col("pos") + length).alias("end"))
    groups = classes.groupBy("seed").agg(F.count(F.lit(1)).alias("different"), F.min("n").alias("least"))
    groups = groups.filter("different > 1 and least = 1")
    wanted = classes.join(groups, "seed").select("one.*", "seed", "around", "n", "different")
    wanted = checkpoint_table(wanted, "suffix")
    parts = exact_spans(contexts(docs, wanted.filter(F.col("different") <= local), length, digit), length, digit)
    large = wanted.filter(F.col("different") > local)
    if not large.isEmpty():
        parts = parts.union(counted_spans(contexts(docs, large, length, digit), length, digit))
    return whole.union(parts).distinct().groupBy(*KEY).agg(
        F.collect_list(F.struct("first", "end")).alias("spans"))  # at most two for each anchor of a text


def merged(spans, size: int) -> list[tuple[int, int]]:
    """Maximal runs of the bytes in (first, end) pairs."""
    out: list[list[int]] = []
    for first, end in sorted((s["first"], min(s["end"], size)) for s in spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [tuple(x) for x in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, digit: int = DIGIT, local: int = LOCAL,
                   keep_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, on demand, kept (the remaining bytes) of each row."""
    spans = repeated_spans(docs, length, digit, local)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text, found in zip(b["text"], b["spans"]):
                data = text.encode()
                runs = merged(found, len(data)) if found is not None else []
                at, kept = 0, []
                for first, end in runs:
                    kept.append(data[at:first])
                    at = end
                kept = b"".join([*kept, data[at:]])
                rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out if keep_bytes else out.drop(columns="kept")

    rows = docs.select(id_text(), *_text_keys(), text_of().alias("text")).join(spans, KEY, "left")
    done = rows.select("doc_id", "text", "spans").mapInPandas(
        cut, "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        + ", kept binary" * keep_bytes)
    return id_back(done, docs)
