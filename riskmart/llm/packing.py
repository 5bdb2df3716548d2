"""Packing documents into sequences: dominance reduction on the length histogram, then best fit.

Documents are tokenised, closed with an end id, and cut into pieces of at most ``capacity`` ids.  What a packing needs
to know is how many pieces there are of each length: at most ``capacity`` counts, whatever the number of documents.
On that histogram

1. dominance: going down the lengths, a set of pieces is fixed as a sequence for good when it holds an optimal place
   for its longest piece in some best packing: the piece alone when nothing fits beside it; with a partner that fills
   the sequence exactly; with the longest partner when no two others fit beside it; with the best pair when no three
   others fit and every other set that fits can be exchanged for parts of that pair;
2. best fit: the remaining pieces, longest first, each go to the fullest sequence that still takes them.

Both steps handle all pieces of a length at once, so the plan is a short list of patterns (lengths, number of sequences
of that kind).  Each piece then finds its place by its rank among the pieces of its length.

Defined results: a null text is empty and gives one piece, the end id; repeated rows are packed one by one; an empty
table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import bisect
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import BLANK_RUN, id_back, id_text, text_of
from riskmart.session import checkpoint_table

CAPACITY = 2048
END_ID = 0
BLANK = re.compile(BLANK_RUN)
#: Words whose ids a Python worker remembers; beyond it, it keeps those that come again before as many others.
WORD_MEMORY = 500_000
#: Characters of text whose words are looked up together.
CHUNK = 1 << 22
#: Fixed value: how the tokenizer's vocabulary marks the ids that close a word.
CLOSING = "</w>"
#: Marks that end a word, and the letters after which the tokenizer always parts them from it; behind a
#: word of these letters alone, it parts every run of ASCII punctuation.
MARKS = ".,;:!?"
LETTERS = frozenset(c for c in map(chr, range(0x100)) if c.isalpha() and (c < "\x80" or c >= "\xc0"))


def chunks(texts: list[str]) -> Iterator[list[tuple[str, bool]]]:
    """(part of a text, whether it is the last one) in lists of about CHUNK characters; texts are cut before blanks."""
    held, size = [], 0
    for text in texts:
        at = 0
        while at is not None:
            blank = BLANK.search(text, at + CHUNK) if len(text) - at > CHUNK else None
            end = blank.start() if blank else None
            held.append((text[at:end], end is None))
            size += len(held[-1][0])
            at = end
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


class WordTokenizer:
    """Ids of texts as little-endian 32-bit bytes.

    The tokenizer splits at white space before anything else, and between a letter and the marks behind it, so a text's
    ids are those of its words in turn, and a word's those of its stem and its closing marks.  The words of many texts
    are numbered at once, each distinct word is looked up once, and the ids are put together by number.  Unknown stems
    are tokenised many at a time.  In those of letters alone, each has exactly one id that closes a word; the others are
    handed over apart, which costs more, and the tokenizer tells the stem of each id.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith(CLOSING)]] = True

    def _batches(self, groups: list, inputs: list, encode, **options) -> Iterator[tuple]:
        for i in range(0, len(groups), 16):  # few at once: encodings are large
            yield from zip(groups[i:i + 16], encode(inputs[i:i + 16], add_special_tokens=False, **options))

    def _encode(self, stems: set[str]) -> dict[str, bytes]:
        plain = [w for w in stems if w and LETTERS.issuperset(w)]
        odd = list(stems.difference(plain))
        out = {}
        groups = [plain[i:i + 512] for i in range(0, len(plain), 512)]
        for group, found in self._batches(
                groups, list(map(" ".join, groups)), self.tokenizer.encode_batch_fast):  # ids only
            ids = np.array(found.ids, "<u4")
            ends = np.flatnonzero(self.closing[ids])
            if len(ends) != len(group) or ends[-1] != len(ids) - 1:
                odd += group
                continue
            raw, at = ids.tobytes(), 0
            for word, end in zip(group, (4 * ends + 4).tolist()):
                out[word] = raw[at:end]
                at = end
        groups = [odd[i:i + 512] for i in range(0, len(odd), 512)]
        for group, found in self._batches(groups, groups, self.tokenizer.encode_batch, is_pretokenized=True):
            raw, at = np.array(found.ids, "<u4").tobytes(), 0
            number = np.bincount(np.array(found.word_ids, np.int64), minlength=len(group))
            for word, end in zip(group, (4 * np.cumsum(number)).tolist()):
                out[word] = raw[at:end]
                at = end
        return out

    @staticmethod
    def _stem(word: str) -> str:
        stem = word.rstrip(string.punctuation)
        return stem if stem and LETTERS.issuperset(stem) else word

    def _learn(self, words: list[str]) -> list[bytes]:
        stems = [w.rstrip(MARKS) for w in words]
        stems = [s if s[-1:] in LETTERS else self._stem(w) for w, s in zip(words, stems)]
        # the tokenizer lower-cases; only plain words here, so that no special token is met
        lower = [s.lower() if s.isascii() and s.isalpha() else s for s in stems]
        ends = [w[len(s):] for w, s in zip(words, stems)]
        # a stem is often a word that was met before
        distinct = list({*lower, *ends})
        ids = {s: found for s, found in zip(distinct, self._met(distinct)) if found is not None}
        ids |= self._encode({s for s in distinct if s not in ids})
        return [ids[s] + ids[e] if e else ids[s] for s, e in zip(lower, ends)]

    def _met(self, words: list[str]) -> list[bytes | None]:
        found = list(map(self.known.get, words))
        before = self.before.get
        return [before(w) if ids is None else ids for w, ids in zip(words, found)] if self.before else found

    def _words(self, words: list[str]) -> list[bytes]:
        if len(self.known) > WORD_MEMORY:
            self.before, self.known = self.known, {}
        found = self._met(words)
        unknown = [w for w, ids in zip(words, found) if ids is None]
        learnt = []
        for i in range(0, len(unknown), 1 << 17):
            learnt += self._learn(unknown[i:i + (1 << 17)])
        if unknown:
            rest = iter(learnt)
            found = [next(rest) if ids is None else ids for ids in found]
        self.known.update(zip(words, found))
        return found

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        held = []
        for part in chunks(texts):
            split = pc.ascii_split_whitespace(pa.array([t for t, _ in part], pa.large_string()))
            coded = split.flatten().dictionary_encode()
            found = self._words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            size = np.fromiter(map(len, found), np.int64, len(found)) // 4
            pool = np.frombuffer(b"".join(found), "<u4")
            word = coded.indices.to_numpy()
            after = np.cumsum(size[word])
            total = int(after[-1]) if len(after) else 0
            small = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
            n = size.astype(small)[word]
            place = np.arange(total, dtype=small)
            place += np.repeat((np.cumsum(size) - size).astype(small)[word] - (after.astype(small) - n), n)
            ids = pool[place]
            bounds = np.r_[0, after][split.offsets.to_numpy()]
            for (_, last), a, b in zip(part, bounds[:-1].tolist(), bounds[1:].tolist()):
                held.append(ids[a:b].tobytes())
                if last:
                    yield b"".join(held)
                    held = []


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, on demand, ids (little-endian 32-bit)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        where = path or tokenizer_path()
        tokenizer = _TOKENIZERS.get(where) or _TOKENIZERS.setdefault(where, WordTokenizer(where))
        for batch in batches:
            rows = []
            for nth, raw in enumerate(tokenizer(batch["text"].tolist())):
                raw += END_ID.to_bytes(4, "little")
                for i in range(0, len(raw), 4 * capacity):
                    part = raw[i:i + 4 * capacity]
                    rows.append((nth, i // (4 * capacity), i // 4, len(part) // 4, zlib.crc32(part), part))
            out = pd.DataFrame(rows, columns=["nth", "piece", "start", "length", "ids_crc32", "ids"])
            out["doc_id"] = batch["doc_id"].to_numpy()[out["nth"].to_numpy(dtype="int64")] if len(out) else []
            yield out[names]

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    cut_rows = docs.select(id_text(), text_of().alias("text")).mapInPandas(
        cut, "doc_id string, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids)
    return id_back(cut_rows, docs)


class Histogram:
    """Numbers of pieces by length, with the present lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in counts.items() if n > 0}
        self.lengths = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.lengths.pop(bisect.bisect_left(self.lengths, length))

    def smallest(self, k: int, without: int) -> list[int]:
        """The k smallest lengths of single pieces, leaving out one piece of length ``without``."""
        found: list[int] = []
        for x in self.lengths:
            n = self.counts[x] - (x == without)
            found += [x] * min(n, k - len(found))
            if len(found) == k:
                break
        return found

    def largest(self, room: int, *without: int) -> int | None:
        """The largest length up to ``room``, leaving out one piece of each length in ``without``."""
        i = bisect.bisect_right(self.lengths, room) - 1
        while i >= 0 and self.counts[self.lengths[i]] <= without.count(self.lengths[i]):
            i -= 1
        return self.lengths[i] if i >= 0 else None


def dominating(h: Histogram, item: int, capacity: int) -> tuple[int, ...] | None:
    """Partners that go with a piece of length ``item`` in some best packing, if that can be shown."""
    room = capacity - item
    low = h.smallest(3, item)
    if not low or low[0] > room:
        return ()
    best = h.largest(room, item)
    if best == room or len(low) < 2 or low[0] + low[1] > room:
        return (best,)
    if len(low) == 3 and sum(low) <= room:
        return None
    # one or two partners: (best, second) must be worth any other pair that fits
    second = h.largest(room - best, item, best)
    if second is None:
        return None
    for x in reversed(h.lengths):
        if x > best or (x == item and h.counts[x] < 2):
            continue
        y = h.largest(min(x, room - x), item, x)
        if y is not None and not (y <= second or x + y <= best):
            return None
    return (best, second)


def reduce_by_dominance(h: Histogram, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets, longest pieces first; what cannot be shown stays in ``h``.  (pattern, number) of each."""
    fixed = []
    for item in sorted(h.lengths, reverse=True):
        while item in h.counts:
            partners = dominating(h, item, capacity)
            if partners is None:
                break
            pattern = (item, *partners)
            # the set is fixed as often as its pieces last; fewer pieces only make the rules that hold stronger,
            # and the partners stay the largest as long as they last
            times = min(h.counts[x] // pattern.count(x) for x in set(pattern))
            for x in pattern:
                h.take(x, times)
            fixed.append((pattern, times))
    return fixed


def best_fit(h: Histogram, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, all pieces of a length at once.  Open sequences are grouped by room and pattern."""
    rooms: list[int] = []
    groups: dict[int, list[list]] = {}  # room -> [pattern, number]

    def put(room: int, pattern: tuple, n: int) -> None:
        if n:
            if room not in groups:
                bisect.insort(rooms, room)
                groups[room] = []
            groups[room].append([pattern, n])

    for item in sorted(h.lengths, reverse=True):
        left = h.counts[item]
        while left:
            i = bisect.bisect_left(rooms, item)
            if i == len(rooms):
                per = capacity // item
                full, rest = divmod(left, per)
                put(capacity - per * item, ((item, per),), full)
                put(capacity - rest * item, ((item, rest),), int(rest > 0))
                break
            room = rooms[i]
            pattern, n = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            per = room // item
            full = min(n, left // per)
            put(room - per * item, (*pattern, (item, per)), full)
            left -= full * per
            n -= full
            if n and left:  # fewer than a whole sequence takes
                put(room - left * item, (*pattern, (item, left)), 1)
                n, left = n - 1, 0
            put(room, pattern, n)
    return [(tuple(x for x, k in p for _ in range(k)), n) for g in groups.values() for p, n in g]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order of their place) and the number of sequences of each."""
    h = Histogram(counts)
    fixed = reduce_by_dominance(h, capacity)
    return fixed + best_fit(h, capacity)


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each run of pieces: (length, first rank, end rank, first sequence, per sequence, first offset).

    The pieces of one length in a pattern are neighbours, so rank r of the run lies in sequence
    first + (r - first rank) // per, at first offset + (r - first rank) % per * length.
    """
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in patterns:
        at = 0
        for x in sorted(set(pattern), reverse=True):
            per = pattern.count(x)
            first = used.get(x, 0)
            used[x] = first + per * n
            rows.append((x, first, used[x], sequence, per, at))
            at += per * x
        sequence += n
    return rows


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: its columns (see ``pieces``), sequence_id and offset."""
    spark = docs.sparkSession
    cut = checkpoint_table(pieces(docs, path, capacity, keep_ids).withColumn(
        "_rid", F.monotonically_increasing_id()), "pack")
    cut = cut.withColumn("_part", F.shiftright("_rid", 33))
    per_part = checkpoint_table(cut.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n")), "pack")
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    rows = places(plan(counts, capacity))
    runs = spark.createDataFrame(
        rows, "length long, first long, end long, sequence long, per long, at long")
    before = per_part.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = cut.withColumn("_in", F.row_number().over(Window.partitionBy("length", "_part").orderBy("_rid")) - 1)
    ranked = ranked.join(before, ["length", "_part"]).withColumn("_rank", F.col("_before") + F.col("_in"))
    # the runs of a length in one array: a piece looks its run up by rank
    by_length = runs.groupBy("length").agg(F.array_sort(F.collect_list(
        F.struct("first", "end", "sequence", "per", "at"))).alias("_runs"))
    placed = ranked.join(F.broadcast(by_length), "length").withColumn("_run", F.element_at(F.filter(
        "_runs", lambda r: (r["first"] <= F.col("_rank")) & (F.col("_rank") < r["end"])), 1))
    step = F.col("_rank") - F.col("_run.first")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids,
        F.expr("_run.sequence + (_rank - _run.first) div _run.per").alias("sequence_id"),
        (F.col("_run.at") + step % F.col("_run.per") * F.col("length")).alias("offset"))
