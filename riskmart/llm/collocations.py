"""Phrase collocation mining: n-grams counted in HAT-tries whose subtrees are spilled as sorted runs.

1. Each task cuts its texts into pieces and words and numbers the words it meets.  Its trie leads over digits of the
   word numbers to hash containers of n-grams; a container of more than ``BURST`` n-grams bursts into a node one digit
   deeper.  N-grams of one to three words are counted together.
2. When the tries of a task hold ``LIMIT`` n-grams, the largest subtrees are spilled whole, down to a quarter.  A spill
   is sorted by its words and cut into one compressed run for each prefix partition (a hash of lang and the first two
   words, so that a frequent first word is spread).  At the end of the task the rest follows.
3. The runs of a prefix partition are merged: equal n-grams are added up, and those with ``least`` occurrences or more
   are kept.  Every part of such an n-gram is as frequent, so it is kept as well.
4. Candidates find the frequencies of their parts by joins on lang and phrase, scores are worked out in decimals.

Memory of a task is bounded by ``LIMIT`` and ``CHUNK``, by the longest text, and in step 3 by a partition's runs, whose
number of partitions is a multiple of spark.sql.shuffle.partitions.

Defined results: a null text is empty, a null lang is ``und`` (and one with the lang of that name); texts without words
add nothing; every row counts, repeated ones as well; words of any length are taken whole; an empty table gives no rows;
only lang and text are read, other columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import text_of
from riskmart.session import checkpoint_table

WORDS = 3
LEAST = 10
TOP = 2000
#: N-grams in a task's trie before subtrees are spilled, n-grams in a container before it bursts.
LIMIT = 1_500_000
BURST = 1 << 15
#: Bytes of text counted at once, and words that a task numbers before it starts anew.
CHUNK = 1 << 20
VOCABULARY = 1 << 20
#: Bits of a word's number in the packed n-gram; number 0 is no word.
BITS = 21
LOW = (1 << BITS) - 1
#: Bits of a word's number that choose a child in the trie.
DIGIT = 6
#: Prefix partitions for each shuffle partition, and at least.
SLOTS_EACH, SLOTS_LEAST = 4, 256
#: Byte that ends a piece (never part of UTF-8), characters that do, and blanks.
MARK = b"\xff"
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
TO_TOKENS = bytes(0xFF if c in PIECE_ENDS else 0x20 if c == 0x09 else c + 32 if 65 <= c <= 90 else c for c in range(256))
RUN_SCHEMA = "lang string, slot int, run binary"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


class Vocabulary(dict):
    """Numbers of the words that a task has met, from 1."""

    def __init__(self):
        super().__init__({MARK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def tokens(data: bytes) -> list[bytes]:
    """The words of a text in lower case, with ``MARK`` between pieces.

    Words may hold any other white space or control character, so only the blank splits.
    """
    return [t for t in data.translate(TO_TOKENS).replace(MARK, b" \xff ").split(b" ") if t]


def packed(numbers: np.ndarray, starts: int) -> np.ndarray:
    """The n-grams within pieces that start among the first ``starts`` words: word numbers side by side, 0 behind a
    shorter n-gram's end."""
    out, inside, key = [], numbers != 0, numbers.astype(np.int64)
    for n in range(1, WORDS + 1):
        out.append(key[:starts][inside[:starts]] << (BITS * (WORDS - n)))
        if n < WORDS:
            inside = inside[:-1] & (numbers[n:] != 0)
            key = (key[:-1] << BITS) | numbers[n:]
    return np.concatenate(out)


class HatTrie:
    """Counts of packed n-grams.

    A node has 2**DIGIT children; it is shallow: the digits are low bits of the first word's number, then of the second
    one's.  A child is a hash container of whole n-grams, or a node once the container has burst.  The children of the
    root are the subtrees that are spilled.
    """

    #: Where the digits of a level lie in the packed n-gram; containers at the last level do not burst.
    LEVELS = (2 * BITS, 2 * BITS + DIGIT, BITS, BITS + DIGIT)

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.root: dict[int, Counter | dict] = {}
        self.sizes: dict[int, int] = {}

    @property
    def size(self) -> int:
        return sum(self.sizes.values())

    def _digits(self, grams: np.ndarray, level: int) -> Iterator[tuple[int, np.ndarray]]:
        digit = ((grams >> self.LEVELS[level]) & ((1 << DIGIT) - 1)).astype(np.uint8)
        order = np.argsort(digit, kind="stable")
        grams, ends = grams[order], np.cumsum(np.bincount(digit, minlength=1 << DIGIT))
        for d, (s, e) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            if e > s:
                yield d, grams[s:e]

    def _count(self, node: dict, grams: np.ndarray, level: int) -> int:
        """Count below ``node``, whose children differ in the digit of ``level``; returns the number of new n-grams."""
        grown = 0
        for d, part in self._digits(grams, level):
            child = node.get(d)
            if child is None:
                child = node[d] = Counter()
            if isinstance(child, Counter):
                before = len(child)
                child.update(part.tolist())
                grown += len(child) - before
                if len(child) > self.burst and level + 1 < len(self.LEVELS):
                    node[d] = {}
                    keys = np.fromiter(child.keys(), np.int64, len(child))
                    for x, own in self._digits(keys, level + 1):
                        node[d][x] = Counter({k: child[k] for k in own.tolist()})
            else:
                grown += self._count(child, part, level + 1)
        return grown

    def add(self, grams: np.ndarray) -> None:
        """Count an array of packed n-grams."""
        for d, part in self._digits(grams, 0):
            top = {d: self.root[d]} if d in self.root else {}
            self.sizes[d] = self.sizes.get(d, 0) + self._count(top, part, 0)
            self.root[d] = top[d]

    def spill(self, down_to: int) -> tuple[np.ndarray, np.ndarray]:
        """Take the largest subtrees out until ``down_to`` n-grams are left: (packed n-grams, counts)."""
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left = self.size
        for d in sorted(self.sizes, key=self.sizes.get, reverse=True):
            if left <= down_to:
                break
            left -= self.sizes.pop(d)
            below = [self.root.pop(d)]
            while below:
                x = below.pop()
                if isinstance(x, Counter):
                    keys.append(np.fromiter(x.keys(), np.int64, len(x)))
                    counts.append(np.fromiter(x.values(), np.int64, len(x)))
                else:
                    below += x.values()
        return np.concatenate(keys), np.concatenate(counts)


class Spelling:
    """Words by number in their order, for the runs of one spill."""

    def __init__(self, words: Vocabulary):
        given = pa.array([b"", *itertools.islice(words, 1, None)], pa.large_binary())
        order = pc.sort_indices(given)  # number 0, no word, is spelled as the empty string: first
        self.rank = np.empty(len(given), np.int64)
        self.rank[order.to_numpy()] = np.arange(len(given))
        self.words = given.take(order)
        self.crc = np.fromiter(map(zlib.crc32, words), np.uint64, len(given))


def write_runs(lang: str, keys: np.ndarray, counts: np.ndarray, spelling: Spelling,
               slots: int) -> Iterator[tuple[int, bytes]]:
    """(slot, run) of a spill: its n-grams in the order of their words, cut by prefix partition.

    A run is its number of n-grams, their lengths, counts and bytes.
    """
    first, second = keys >> (2 * BITS), (keys >> BITS) & LOW
    slot = spelling.crc[first] * np.uint64(0x9E3779B1) + spelling.crc[second] * np.uint64(0x85EBCA77)
    slot = _mixed(slot + np.uint64(zlib.crc32(lang.encode()))) % np.uint64(slots)
    slot = slot.astype(np.uint16 if slots <= 1 << 16 else np.uint32)
    w1, w2, w3 = spelling.rank[first], spelling.rank[second], spelling.rank[keys & LOW]
    by = np.argsort((w1 << 2 * BITS) | (w2 << BITS) | w3)
    by = by[np.argsort(slot[by], kind="stable")]
    slot, counts = slot[by], counts[by]
    parts = [spelling.words.take(pa.array(w[by], mask=w[by] == 0)) for w in (w1, w2, w3)]
    grams = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary()), null_handling="skip")
    offsets = np.frombuffer(grams.buffers()[1], np.int64, len(grams) + 1)
    data = memoryview(grams.buffers()[2])
    begin = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
    squeeze = zstandard.ZstdCompressor(level=1)
    for s, e in zip(begin.tolist(), [*begin[1:].tolist(), len(slot)]):
        body = b"".join((np.int64(e - s).tobytes(), np.diff(offsets[s:e + 1]).astype(np.uint32).tobytes(),
                         counts[s:e].tobytes(), data[offsets[s]:offsets[e]]))
        yield int(slot[s]), squeeze.compress(body)


def read_run(run: bytes) -> tuple[pa.Array, np.ndarray]:
    """(n-grams, counts) of a run."""
    body = zstandard.ZstdDecompressor().decompress(run)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    lengths = np.frombuffer(body, np.uint32, n, 8)
    counts = np.frombuffer(body[8 + 4 * n:8 + 12 * n], np.int64)
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    grams = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets),
                                                                    pa.py_buffer(body[8 + 12 * n:])])
    return grams, counts


class Task:
    """The tries of a task, one for each lang, over one vocabulary."""

    def __init__(self, slots: int, limit: int = LIMIT, burst: int = BURST, vocabulary: int = VOCABULARY):
        self.slots, self.limit, self.burst, self.most = slots, limit, burst, vocabulary
        self.words, self.tries = Vocabulary(), {}

    def _spill(self, down_to: int) -> Iterator[tuple[str, int, bytes]]:
        total, spelling = sum(t.size for t in self.tries.values()), Spelling(self.words)
        for lang in sorted(self.tries):
            trie = self.tries[lang]
            keys, counts = trie.spill(trie.size * down_to // max(total, 1))
            if len(keys):
                for slot, run in write_runs(lang, keys, counts, spelling, self.slots):
                    yield lang, slot, run

    def add(self, lang: str, data: bytes) -> Iterator[tuple[str, int, bytes]]:
        """Count a chunk of text; yields the runs that it pushes out."""
        split = tokens(data)
        # a text of very many words is counted in parts; n-grams belong to the part that they start in
        for at in range(0, len(split), self.most):
            part = split[at:at + self.most + WORDS - 1]
            if len(self.words) + len(part) > 1 << BITS:
                yield from self.end()
            numbers = np.fromiter(map(self.words.__getitem__, part), np.int64, len(part))
            self.tries.setdefault(lang, HatTrie(self.burst)).add(packed(numbers, self.most))
            if sum(t.size for t in self.tries.values()) > self.limit:
                yield from self._spill(self.limit // 4)

    def end(self) -> Iterator[tuple[str, int, bytes]]:
        """Spill all that is left and forget the words."""
        yield from self._spill(0)
        self.words, self.tries = Vocabulary(), {}


def runs(docs: DataFrame, slots: int, limit: int = LIMIT, burst: int = BURST, chunk: int = CHUNK) -> DataFrame:
    """(lang, slot, run): the spilled runs of all tasks."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, waiting, sizes = Task(slots, limit, burst), {}, {}

        def out(rows) -> Iterator[pa.RecordBatch]:
            for lang, slot, run in rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([slot], pa.int32()), pa.array([run], pa.binary())],
                    ["lang", "slot", "run"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                waiting.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] >= chunk:
                    yield from out(task.add(lang, MARK.join(waiting.pop(lang))))
                    del sizes[lang]
        for lang in sorted(waiting):
            yield from out(task.add(lang, MARK.join(waiting[lang])))
        yield from out(task.end())

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))
    return rows.mapInArrow(make, RUN_SCHEMA)


def merged(spilled: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, f) of the n-grams with ``least`` occurrences or more; and for each lang rows of 0 words,
    whose f add up to its number of words."""

    def merge(group: pa.Table) -> pa.Table:
        parts = [read_run(r.as_py()) for r in group.column("run")]
        grams = pa.chunked_array([g for g, _ in parts])
        table = pa.table({"phrase": grams, "f": np.concatenate([n for _, n in parts])})
        table = table.group_by("phrase").aggregate([("f", "sum")])
        words = pc.add(pc.count_substring(table.column("phrase"), " "), 1)
        single = pc.sum(pc.filter(table.column("f_sum"), pc.equal(words, 1))).as_py() or 0
        keep = pc.greater_equal(table.column("f_sum"), least)
        phrase = pc.filter(table.column("phrase"), keep).cast(pa.large_string()).cast(pa.string())
        lang = group.column("lang")[0].as_py()
        out = pa.table({"lang": pa.array([lang] * len(phrase), pa.string()), "phrase": phrase,
                        "words": pc.filter(words, keep).cast(pa.int32()), "f": pc.filter(table.column("f_sum"), keep)})
        total = pa.table({"lang": pa.array([lang], pa.string()), "phrase": pa.array([""], pa.string()),
                          "words": pa.array([0], pa.int32()), "f": pa.array([single], pa.int64())})
        return pa.concat_tables([out, total])

    return spilled.groupBy("lang", "slot").applyInArrow(merge, "lang string, phrase string, words int, f long")


def count_ngrams(docs: DataFrame, least: int = LEAST, limit: int = LIMIT, burst: int = BURST,
                 chunk: int = CHUNK) -> DataFrame:
    """The frequent n-grams of ``docs`` and the words of each lang (see ``merged``), as a written table."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = max(SLOTS_LEAST, SLOTS_EACH * parts)
    return checkpoint_table(merged(runs(docs, slots, limit, burst, chunk), least), "ngrams")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of every candidate, its lowest-scoring cut (ties: the first)."""
    grams = counts.filter("words > 0")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
    cuts = grams.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), cut.alias("k"))
    cuts = cuts.withColumns({
        "left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - words)")})
    part = grams.filter(F.col("words") < WORDS).select("lang", F.col("phrase").alias("part"), "f")
    # a frequent first or last word is met by many cuts: AQE splits that side, nothing above needs rows of a key together
    cuts = cuts.join(part.withColumnsRenamed({"part": "left", "f": "l"}), ["lang", "left"])
    cuts = checkpoint_table(cuts, "ngrams")
    cuts = cuts.join(part.withColumnsRenamed({"part": "right", "f": "r"}), ["lang", "right"])
    score = F.expr("cast(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * 1000000 "
                   "div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as long)")
    cuts = checkpoint_table(cuts.withColumn("score", score), "ngrams")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("low")).select(
        "lang", "phrase", "words", "a", "low.l", "low.r", "low.score")


def independent(candidates: DataFrame, counts: DataFrame, share: int = 50) -> DataFrame:
    """Candidates without those that a longer candidate holds in ``share`` percent of their occurrences or more."""
    longer = counts.filter(F.col("words") == WORDS)
    ends = F.explode(F.array(F.substring_index("phrase", " ", WORDS - 1), F.substring_index("phrase", " ", 1 - WORDS)))
    most = longer.select("lang", "f", ends.alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    inside = most.join(counts.filter(F.col("words") == WORDS - 1).select("lang", "phrase", "f"), ["lang", "phrase"])
    inside = inside.filter(100 * F.col("most") >= share * F.col("f")).select("lang", "phrase")
    return candidates.join(inside, ["lang", "phrase"], "left_anti")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = 50, **memory) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of two and three words of each lang."""
    counts = count_ngrams(docs, least, **memory)
    n = counts.filter("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    found = independent(scored(counts), counts, share)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # the first of each of 16 parts of a lang, then the first of these
    part = F.pmod(F.xxhash64("phrase"), F.lit(16)).alias("part")
    found = found.select("*", part).withColumn("place", F.row_number().over(
        Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("place") <= top).drop("part", "place")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return found.filter(F.col("rank") <= top).join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
