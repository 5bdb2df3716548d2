"""Language identification with character language models.

For each language an interpolated Kneser-Ney model over letters (lower case; everything between letters is one blank)
is counted from the labelled documents.  Spark counts the character n-grams and joins counts, contexts and lower orders
to probabilities; the model stays a set of tables and is never collected or broadcast.

For scoring, joins with the model tables give an n-gram of the highest order the logarithms of its probability in all
languages.  The most frequent n-grams (as many as have ``VALUES`` values together, whatever the corpus) go to every task,
in an array sorted by an invertible 64-bit hash of the n-gram, one column per language, with a directory of the hash's
first bits that tells where to look.  A text's other n-grams are left over and written with its sums; chunks of texts
with a bounded number of leftovers ask for their distinct ones, the joins answer, and the chunk adds the answers up from
such an array of its own.  So nothing but the bounded array is collected or broadcast, texts are read once and never
shuffled, and a task holds one chunk.  A text with more leftovers than a chunk takes is a chunk of its own.

A document gets the language of the lowest cross-entropy per character over its whole text.  ``score`` compares the
languages, as the posterior after at most ``evidence`` characters; ``rejected`` tells that the cross-entropy is above
what all but ``reject`` of the calibration documents of that language have.

Two models stand side by side.  The trial model is counted on the remainders 0 and 1 of crc32(doc_id as text) mod 4, and
the limits are calibrated with it on 3; the final model, which predicts, is counted on 0, 1 and 3; 2 is held out.  So a
language that only remainder 3 has can be predicted; it has no limit, and its documents count as rejected.  A prediction
sees the text alone.

Defined results: a null text and one without letters are ``und`` with score 0, and so is every text where no language
could be learned; a null doc_id counts as the empty string; equal cross-entropies go to the first language by name;
repeated rows count and are predicted one by one; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import id_back, id_text, text_of
from riskmart.session import checkpoint_table

ORDER = 4
DISCOUNT = 0.75
#: Characters beyond those of the corpus share this many equal parts of the rest.
ALPHABET = 1 << 16
EVIDENCE = 32
REJECT = 0.005
#: Units (UTF-16) counted or scored at once in a Python worker.
CHUNK = 1 << 21
#: Most values (n-grams x columns) in the array that every task has, and in the answers to a chunk of several texts.
VALUES = 1 << 22
#: Most texts of a chunk.
TEXTS = 1 << 14
#: First characters of a column's name, before the language.
TRIAL, FINAL = "0", "1"
PAD = ORDER - 1


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4))


def letters(text: Column) -> Column:
    """Lower case, each run of other characters than letters one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))


def units(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-16 units of all texts, each behind PAD blanks and before one; and the place of each text's first letter."""
    raw = [(" " * PAD + t + " ").encode("utf-16-le") for t in texts]
    first = np.cumsum([0] + [len(r) // 2 for r in raw])
    return np.frombuffer(b"".join(raw), np.uint16).astype(np.uint64), first


def grams(u: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each unit from PAD on, as a 64-bit number."""
    n = len(u) - PAD
    out = np.zeros(max(n, 0), np.uint64)
    for back in range(order - 1, -1, -1):
        out = (out << np.uint64(16)) | u[PAD - back:PAD - back + len(out)]
    return out


def predicted(first: np.ndarray) -> np.ndarray:
    """Of the units from PAD on, those that are not another text's padding."""
    size = int(first[-1]) - PAD
    use = np.ones(max(size, 0), bool)
    for at in first[1:-1]:
        use[at - PAD:at] = False
    return use


def batched(texts: Iterator[str], size: int = CHUNK) -> Iterator[list[str]]:
    part, n = [], 0
    for t in texts:
        if part and n + len(t) > size:
            yield part
            part, n = [], 0
        part.append(t)
        n += len(t) + ORDER
    if part:
        yield part


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all of ``docs`` (lang, text): every n-gram of the highest order."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[str]] = {}
        size: dict[str, int] = {}

        def flush(lang: str) -> Iterator[pd.DataFrame]:
            for part in batched(held.pop(lang)):
                u, first = units(part)
                gram, n = np.unique(grams(u, ORDER)[predicted(first)], return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": gram.view(np.int64), "n": n})
            size[lang] = 0

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text)
                if size[lang] > CHUNK:
                    yield from flush(lang)
        for lang in list(held):
            yield from flush(lang)

    return (docs.mapInPandas(count, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def mixed(gram: np.ndarray) -> np.ndarray:
    """Multiplicative hash of n-grams; different n-grams have different hashes."""
    return (gram ^ (gram >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)


def probabilities(top: DataFrame) -> dict[tuple[str, int], DataFrame]:
    """(lang, gram, value): logarithms of the interpolated probability of each n-gram of order k (at key "p", k) and of
    the weight that each context of order k leaves to the lower order (at "g", k)."""
    by_order = {ORDER: top}
    for k in range(ORDER - 1, 0, -1):
        # continuation counts: in how many n-grams of the next order it is the end
        mask = F.lit((1 << 16 * k) - 1)
        by_order[k] = checkpoint_table(by_order[k + 1].groupBy(
            "lang", F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "langid")
    out, lower = {}, None
    for k in range(1, ORDER + 1):
        t = by_order[k].withColumn("ctx", F.shiftrightunsigned("gram", 16) if k > 1 else F.lit(0).cast("long"))
        ctx = t.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
        ctx = ctx.withColumn("rest", DISCOUNT * F.col("types") / F.col("total"))
        t = t.join(ctx, ["lang", "ctx"])
        if lower is None:
            t = t.withColumn("below", F.lit(1.0 / ALPHABET))
        else:
            mask = F.lit((1 << 16 * (k - 1)) - 1)
            low = lower.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("below"))
            t = t.withColumn("suffix", F.col("gram").bitwiseAND(mask)).join(low, ["lang", "suffix"])
        lower = checkpoint_table(t.select("lang", "gram", (
            F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("total") + F.col("rest") * F.col("below")).alias("p")),
            "langid")
        out["p", k] = lower.select("lang", "gram", F.log("p").alias("value"))
        out["g", k - 1] = ctx.select("lang", F.col("ctx").alias("gram"), F.log("rest").alias("value"))
    return out


def vectors(model: dict[tuple[str, int], DataFrame], langs: list[str], wanted: DataFrame) -> DataFrame:
    """(gram, v) for the distinct n-grams ``wanted`` (gram): v has the logarithm of the probability in each of ``langs``.

    From the lowest order up: the probability where the language has the n-gram, else the weight of its context (none: 1)
    and the lower order's."""

    def wide(kind: str, k: int, name: str) -> DataFrame:
        one = model[kind, k].groupBy("gram").pivot("lang", langs).agg(F.first("value"))
        one = one.toDF(name + "_gram", *[f"c{i}" for i in range(len(langs))])
        return one.select(name + "_gram", F.array(*[f"c{i}" for i in range(len(langs))]).alias(name))

    need = {ORDER: wanted}
    for k in range(ORDER - 1, 0, -1):
        mask = F.lit((1 << 16 * k) - 1)
        need[k] = checkpoint_table(need[k + 1].select(F.col("gram").bitwiseAND(mask).alias("gram")).distinct(), "langid")
    nothing = F.array_repeat(F.lit(0.0), len(langs))
    lower = None
    for k in range(1, ORDER + 1):
        t = need[k].join(wide("p", k, "own"), F.col("gram") == F.col("own_gram"), "left")
        ctx = F.shiftrightunsigned("gram", 16) if k > 1 else F.lit(0).cast("long")
        t = t.withColumn("ctx", ctx).join(wide("g", k - 1, "rest"), F.col("ctx") == F.col("rest_gram"), "left")
        if lower is None:
            t = t.withColumn("below", F.array_repeat(F.lit(-math.log(ALPHABET)), len(langs)))
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1))
            t = t.withColumn("suffix", suffix).join(
                lower.select(F.col("gram").alias("suffix"), F.col("v").alias("below")), "suffix")
        left = F.zip_with(F.coalesce("rest", nothing), "below", lambda a, b: F.coalesce(a, F.lit(0.0)) + b)
        t = t.select("gram", "own", left.alias("left"))
        lower = t.select("gram", F.coalesce(F.zip_with("own", "left", lambda a, b: F.coalesce(a, b)), "left").alias("v"))
        if k < ORDER:
            lower = checkpoint_table(lower, "langid")
    return lower.select("gram", F.col("v").cast("array<float>").alias("v"))


class Scorer:
    """Logarithms of probabilities by n-gram: an array sorted by hash, with a column per language."""

    def __init__(self, found: pa.Table, columns: int):
        hashed = mixed(found["gram"].to_numpy().view(np.uint64))
        values = found["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, columns)
        keys, row = np.unique(hashed, return_index=True)
        # the directory: where in the sorted array the hashes with these first bits begin
        bits = max(1, (4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        count = np.bincount((keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.directory = (np.cumsum(count) - count).astype(np.int32)
        # the last row is for all others; its key ends every search
        self.others = len(keys)
        self.keys = np.append(keys, np.uint64(2**64 - 1))
        self.values = np.concatenate([values[row], np.zeros((1, columns), values.dtype)])

    def rows(self, gram: np.ndarray) -> np.ndarray:
        """Where the values of each n-gram are; ``others`` for one that is not in the array."""
        wanted = mixed(gram)
        at = self.directory[(wanted >> self.shift).astype(np.int64)]
        found = self.keys[at]
        behind = np.flatnonzero(found < wanted)
        while len(behind):
            at[behind] += 1
            found[behind] = self.keys[at[behind]]
            behind = behind[found[behind] < wanted[behind]]
        at[found != wanted] = self.others
        return at

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(texts x languages) sums over the n-grams in the array; and the owner, n-gram and number of all leftovers, by
        owner.  Long texts are added up in parts."""
        columns = self.values.shape[1]
        step = max(1 << 12, CHUNK // 4 // columns)
        u, first = units(texts)
        sums = np.zeros((len(texts), columns))
        owner = np.repeat(np.arange(len(texts)), np.diff(first))[PAD:]
        use = np.flatnonzero(predicted(first))
        left_owner, left_gram = [], []
        for at in range(0, len(use), step):
            places = use[at:at + step]
            begin, end = int(places[0]), int(places[-1]) + 1
            gram = grams(u[begin:end + PAD], ORDER)[places - begin]
            who, row = owner[places], self.rows(gram)
            add_up(sums, who, self.values[row])
            left = np.flatnonzero(row == self.others)
            left_owner.append(who[left])
            left_gram.append(gram[left])
        who, gram = np.concatenate(left_owner), np.concatenate(left_gram)
        order = np.lexsort((gram, who))
        who, gram = who[order], gram[order]
        begin = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (gram[1:] != gram[:-1])][:len(who)])
        return sums, who[begin], gram[begin], np.diff(np.append(begin, len(who)))


def add_up(sums: np.ndarray, who: np.ndarray, values: np.ndarray) -> None:
    """Add to the rows ``who`` (ascending) of ``sums``."""
    if len(who):
        begin = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        sums[who[begin]] += np.add.reduceat(values, begin, axis=0, dtype=np.float64)


def columns_of(top: DataFrame) -> list[str]:
    """The names of the columns: a short list, one or two for each language."""
    return sorted((r["lang"] for r in top.select("lang").distinct().collect()), key=lambda x: x.encode())


def learn(docs: DataFrame) -> tuple[list[str], DataFrame, dict[tuple[str, int], DataFrame]]:
    """The columns, n-gram counts and tables of both models from ``docs`` (doc_id, text, lang)."""
    at = fold(F.col("doc_id"))
    rows = docs.filter("lang is not null and text is not null").filter(at != 2).select(
        F.concat(F.when(at == 3, FINAL).otherwise(TRIAL), "lang").alias("lang"),
        letters(F.col("text")).alias("text")).filter("text != ''")
    final = F.concat(F.lit(FINAL), F.expr("substring(lang, 2)"))
    both = F.when(F.col("lang").startswith(TRIAL), F.array(F.col("lang"), final)).otherwise(F.array(F.col("lang")))
    top = checkpoint_table(count_grams(rows).select(F.explode(both).alias("lang"), "gram", "n").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n")), "langid")
    langs = columns_of(top)
    return langs, top, probabilities(top) if langs else {}


def predict(docs: DataFrame, langs: list[str], top: DataFrame, model: dict[tuple[str, int], DataFrame],
            evidence: int = EVIDENCE, values: int = VALUES) -> DataFrame:
    """doc_id, lang, fold, lang_pred, score, cross_entropy (final model), trial_pred, trial_entropy (trial model) of each
    row of ``docs``."""
    columns = len(langs)
    names = np.array([x[1:] for x in langs], object)
    trials = sum(x.startswith(TRIAL) for x in langs)  # they come first
    most = max(1, values // columns)
    frequent = top.filter(F.col("lang").startswith(FINAL)).groupBy("gram").agg(F.sum("n").alias("n")).orderBy(
        F.desc("n"), "gram").limit(most).select("gram")
    shared = docs.sparkSession.sparkContext.broadcast(vectors(model, langs, frequent).toArrow())  # most rows

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value, columns)
        number, size, texts = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            at = 0
            for part in batched(iter(batch["text"].tolist()), CHUNK // 2):
                sums, who, gram, n = scorer.sums(part)
                border = np.searchsorted(who, np.arange(1, len(part)))
                left = np.split(gram.view(np.int64), border)
                numbers = np.zeros(len(part), np.int64)
                for i, own in enumerate(left):
                    if texts and (texts == TEXTS or size + len(own) > most):
                        number, size, texts = number + 1, 0, 0
                    numbers[i], size, texts = number, size + len(own), texts + 1
                yield pd.DataFrame({
                    "chunk": numbers, "units": [len(t.encode("utf-16-le")) // 2 for t in part], "sums": list(sums),
                    "gram": left, "n": np.split(n, border),
                    **{c: batch[c].iloc[at:at + len(part)].to_numpy() for c in ("doc_id", "lang", "fold")}})
                at += len(part)

    rows = docs.select(id_text(), "lang", fold(F.col("doc_id")).cast("int").alias("fold"),
                       letters(text_of()).alias("text"))
    # written, so that the numbers of the chunks stay fixed
    rows = checkpoint_table(rows.mapInPandas(
        read, "chunk long, units long, sums array<double>, gram array<long>, n array<long>, doc_id string, lang string, "
              "fold int"), "langid")
    asked = checkpoint_table(rows.select("chunk", F.explode("gram").alias("gram")).distinct(), "langid")
    answers = asked.join(vectors(model, langs, asked.select("gram").distinct()), "gram")

    def score(texts: pa.Table, found: pa.Table) -> pa.Table:
        sums = texts["sums"].combine_chunks().flatten().to_numpy().reshape(-1, columns).copy()
        gram, n = (texts[c].combine_chunks() for c in ("gram", "n"))
        who = np.repeat(np.arange(len(texts)), gram.value_lengths().to_numpy())
        if len(who):
            scorer = Scorer(found, columns)
            step = max(1 << 12, CHUNK // 4 // columns)
            gram, n = gram.flatten().to_numpy().view(np.uint64), n.flatten().to_numpy()
            for at in range(0, len(who), step):
                part = slice(at, at + step)
                add_up(sums, who[part], scorer.values[scorer.rows(gram[part])] * n[part, None])
        length = texts["units"].to_numpy()
        some = length > 0
        entropy = -sums / (length + 1)[:, None]
        final, trial = entropy[:, trials:], entropy[:, :trials]
        least = final.min(axis=1)
        weight = np.exp(-np.minimum(length, evidence)[:, None] * (final - least[:, None])).sum(axis=1)
        own = {"lang_pred": pa.array(np.where(some, names[trials:][final.argmin(axis=1)], "und"), pa.string()),
               "score": pa.array(np.where(some, 1.0 / weight, 0.0)),
               "cross_entropy": pa.array(least, pa.float64(), mask=~some),
               "trial_pred": pa.nulls(len(texts), pa.string()), "trial_entropy": pa.nulls(len(texts), pa.float64())}
        if trials:
            own["trial_pred"] = pa.array(names[trial.argmin(axis=1)], pa.string(), mask=~some)
            own["trial_entropy"] = pa.array(trial.min(axis=1), pa.float64(), mask=~some)
        return pa.table({**{c: texts[c] for c in ("doc_id", "lang", "fold")}, **own})

    scored = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, "doc_id string, lang string, fold int, lang_pred string, score double, cross_entropy double, "
               "trial_pred string, trial_entropy double")
    return id_back(scored, docs)


def identify(docs: DataFrame, evidence: int = EVIDENCE, reject: float = REJECT) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cross_entropy, rejected for each document."""
    langs, top, model = learn(docs)
    if not langs:
        return docs.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), F.lit("und").alias("lang_pred"),
                           F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"),
                           F.lit(True).alias("rejected"))
    found = checkpoint_table(predict(docs, langs, top, model, evidence), "langid")
    limits = found.filter("fold = 3 and lang = trial_pred").groupBy(F.col("trial_pred").alias("lang_pred")).agg(
        F.percentile_approx("trial_entropy", 1 - reject, F.lit(10_000)).alias("most"))  # a row per language
    return found.join(F.broadcast(limits), "lang_pred", "left").select(
        "doc_id", (F.col("fold") == 2).alias("held_out"), "lang_pred", "score", "cross_entropy",
        F.coalesce(F.col("cross_entropy") > F.col("most"), F.lit(True)).alias("rejected"))
