"""Quality rules: heuristics on words and lines, then a hashed n-gram log-likelihood ratio; DataFrame functions only.

Words and word pairs are hashed to ``buckets`` counters.  For each language two multinomials are counted over them: the
raw corpus (every document) and the trusted target (the documents labelled good and not toxic).  A document's score is
the mean, over its words and pairs, of log(target share / raw share).  The target is shrunk toward the raw share, so the
less a language has of trusted text, the nearer are its scores to 0; and a document is scored with the target of the
half of the trusted documents that it is not in.  It is kept if no rule rejects it and its score is not below the cut of
its language, which is set by how the trusted documents score.  The decision is the same in every run.  The model is two
arrays of ``buckets`` floats a language (of at most ``LANGUAGES``), whatever the size of the corpus; the raw counts cover
every document, and target and cuts every trusted one.

Few texts are shuffled to find the trusted ones: a bitmap of fixed size, made of the trusted ids' hashes, tells that most
of the others are not, and only the rest is joined with the ids.  The more trusted documents there are, the more texts go
that way; the result is the same.

Defined results: a null text has no words, so a rule rejects it; a very long text is counted and scored whole; documents
without a label or without doc_id count for the raw corpus only; several labels of a doc_id must all be good; repeated
rows are judged (and counted) one by one; a null lang and an empty one are one language, and so is everything where the
table has no column lang; in a language without trusted documents (or beyond ``LANGUAGES``) scores are 0 and only the
rules reject; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import BITMAP, BLANKS, bitmap, in_bitmap, text_of, words
from riskmart.session import checkpoint_table

BUCKETS = 1 << 14
#: N-grams by which a target's share is shrunk toward the raw share.
PRIOR = 1 << 14
#: Standard deviations of the trusted documents' scores from their mean down to the cut.
SPREAD = 3.0
#: For few trusted documents of a language: a deviation (nats per n-gram) that counts like that of FEW documents more.
MARGIN = 0.1
FEW = 5
LEAST_WORDS = 10
#: Languages at most that have a model, those with the most trusted n-grams.
LANGUAGES = 256
WINDOW = 5
#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _long(col: Column) -> Column:
    return col.cast("long")


def _pairs(h: str) -> Column:
    """Hashes of the word pairs."""
    at = F.when(F.size(h) > 1, F.sequence(F.lit(0), F.size(h) - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1)))


def _bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def hashed(rows: DataFrame) -> DataFrame:
    """Adds ``_w`` (words) and ``_h`` (their 64-bit hashes)."""
    return rows.withColumn("_w", words(F.col("_text"))).withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))


def grams(buckets: int) -> Column:
    """Buckets of all words and word pairs of ``_h``."""
    return F.transform(F.concat("_h", _pairs("_h")), lambda h: _bucket(h, buckets))


def each_gram(rows: DataFrame, buckets: int) -> DataFrame:
    """``rows`` without ``_text``, once for each of its ``grams``, with its ``bucket``."""
    own = [c for c in rows.columns if c != "_text"]
    rows = rows.withColumn("_w", words(F.col("_text")))
    # outer: otherwise the optimiser makes the words twice, first to leave out texts that have none
    rows = rows.select(*own, "_w", F.posexplode_outer("_w").alias("_at", "_word")).filter("_word is not null")
    after = F.get("_w", F.col("_at") + 1)
    rows = rows.select(*own, after.alias("_after"), F.xxhash64("_word").alias("_one"))
    two = F.when(F.col("_after").isNotNull(), F.xxhash64("_one", F.xxhash64("_after")))
    rows = rows.select(*own, F.explode(F.array("_one", two)).alias("_gram")).filter("_gram is not null")
    return rows.select(*own, _bucket(F.col("_gram"), buckets).alias("bucket"))


def trusted_ids(labels: DataFrame, most: int | None = None) -> DataFrame:
    """The ids of all trusted documents; with ``most``, which ``model`` does not use, those with the smallest hashes."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("x"))
    good = good.filter("q = 1 and x = 0 and doc_id is not null")
    if most is not None:
        good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return good.select(F.col("doc_id").alias("_id"))


def told_apart(docs: DataFrame, labels: DataFrame, size: int = BITMAP) -> tuple[DataFrame, DataFrame]:
    """(_lang, _half, _text) of all documents in two tables: ``near``, written once, holds all trusted ones, with their
    half, and those that share a bit with them; ``rest`` the others.  ``_half`` is null where a document is not trusted."""
    ids = checkpoint_table(trusted_ids(labels), "quality")
    rows = docs.select(F.col("doc_id").alias("_id"), language(docs).alias("_lang"), text_of().alias("_text"))
    bits = F.broadcast(bitmap(ids, size))  # ``size`` words, whatever the number of ids
    hit = in_bitmap(F.col("_id"), size)
    rest = rows.join(bits, ~hit, "left_semi").select("_lang", F.lit(None).cast("int").alias("_half"), "_text")
    # no broadcast: the ids grow with the labels
    near = rows.join(bits, hit, "left_semi").join(ids.withColumn("_good", F.lit(True)).hint("merge"), "_id", "left")
    near = near.select("_lang", F.when(F.col("_good"), half(F.col("_id"))).alias("_half"), "_text")
    return checkpoint_table(near, "quality"), rest


def trusted_docs(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(_lang, _half, _text) of all trusted documents."""
    return told_apart(docs, labels)[0].filter("_half is not null")


def language(docs: DataFrame) -> Column:
    """What a document is compared within: its lang, where there is such a column."""
    return F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")


def half(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("half")), F.lit(2)).cast("int")


def ratios(rows: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR, languages: int = LANGUAGES) -> DataFrame:
    """(_lang, _half, _llr): log(target share / raw share) of each bucket, for the documents of a language and half.

    ``rows`` are (_lang, _half, _text) of every document, ``_half`` null for those that are not trusted.  The target of a
    half is counted from the trusted documents of the other one, and shrunk toward the raw share by ``prior`` n-grams.
    Only for the ``languages`` languages with the most trusted n-grams.
    """
    counts = each_gram(rows, buckets).groupBy("_lang", "bucket").agg(
        F.count(F.lit(1)).alias("raw"), *[F.count_if(F.col("_half") == 1 - i).alias(f"g{i}") for i in (0, 1)])
    counts = checkpoint_table(counts, "quality")
    total = counts.groupBy("_lang").agg(*[F.sum(c).alias(f"all_{c}") for c in ("raw", "g0", "g1")])
    most = F.col("all_g0") + F.col("all_g1")
    total = total.filter(most > 0).orderBy(most.desc(), "_lang").limit(languages)
    total = total.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    # ``buckets`` rows for each language; a bucket without n-grams is never looked up
    rows = total.join(counts, ["_lang", "bucket"], "left").select("_lang", "bucket", *[F.coalesce(F.log(
        (F.col(f"g{i}") * F.col("all_raw") / F.col("raw") + prior) / (F.col(f"all_g{i}") + prior)
    ), F.lit(0.0)).cast("float").alias(f"r{i}") for i in (0, 1)])
    one = rows.groupBy("_lang").agg(F.array_sort(F.collect_list(F.struct("bucket", "r0", "r1"))).alias("of"))
    return one.select("_lang", F.posexplode(F.array(*[
        F.transform("of", lambda x: x[f"r{i}"]) for i in (0, 1)])).alias("_half", "_llr"))


def scored(rows: DataFrame, models: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``_h``, ``_p`` and ``_score``, the mean ratio of the n-grams of ``_text``; 0 where there is no model."""
    rows = hashed(rows).drop("_w").withColumn("_p", _pairs("_h"))
    # at most 2 x LANGUAGES arrays of ``buckets`` floats
    rows = rows.join(F.broadcast(models), ["_lang", "_half"], "left")

    def add(total: Column, h: Column) -> Column:
        return total + F.get("_llr", _bucket(h, buckets))

    total = F.aggregate("_p", F.aggregate("_h", F.lit(0.0), add), add)
    n = F.size("_h") + F.size("_p")
    return rows.withColumn("_score", F.when(F.col("_llr").isNotNull() & (n > 0), total / n).otherwise(0.0)).drop("_llr")


def model(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR,
          spread: float = SPREAD) -> DataFrame:
    """(_lang, _half, _llr, _cut): the ratios, and the score under which a document of that language is rejected.

    Every document is scored with a target that it is no part of, so the trusted ones show how clean documents of a
    language score: the cut lies ``spread`` standard deviations below their mean, widened for small numbers.
    """
    near, rest = told_apart(docs, labels)
    models = checkpoint_table(ratios(near.unionByName(rest), buckets, prior), "quality")
    found = scored(near.filter("_half is not null"), models, buckets).filter(F.size("_h") >= LEAST_WORDS).groupBy("_lang").agg(
        F.avg("_score").alias("mean"), F.var_pop("_score").alias("var"), F.count(F.lit(1)).alias("n"))
    wide = F.sqrt((F.col("var") * F.col("n") + MARGIN ** 2 * FEW) / (F.col("n") + FEW))
    cuts = found.select("_lang", (F.col("mean") - spread * wide).alias("_cut"))
    return checkpoint_table(models.join(F.broadcast(cuts), "_lang", "left"), "quality")


def repeated_words(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: the words inside windows of five that the text has twice or more.

    Windows are compared by 64-bit hash; texts whose windows all differ are done after one pass.  In the others the
    sorted (hash, place) pairs show the repeated windows, and their places in order show the words they cover.
    """
    n = F.size("_h")
    at = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("_g", F.transform(at, lambda i: F.xxhash64(
        F.get("_p", i), F.get("_p", i + 2), F.get("_h", i + 4))))  # WINDOW words
    rows = rows.withColumn("_s", F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    rows = rows.withColumn("_p", F.array_sort(F.transform(
        F.filter("_s", lambda e, i: F.coalesce(F.get("_s", i - 1)["g"] == e["g"], F.lit(False))
                 | F.coalesce(F.get("_s", i + 1)["g"] == e["g"], F.lit(False))),
        lambda e: e["i"])))
    reach = F.transform("_p", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", i + 1) - p, F.lit(WINDOW))))
    return rows.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")))


def judge(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR,
          spread: float = SPREAD) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr (the score), kept."""
    cols = [c for c in docs.columns if c not in (*MEASURES, "base_failed", "llr", "kept")]
    models = model(docs, labels, buckets, prior, spread)
    rows = scored(docs.select(F.struct(*cols).alias("_row"), text_of().alias("_text"), language(docs).alias("_lang"),
                              half(F.col("doc_id")).alias("_half")), models, buckets)
    text = F.col("_text")
    rows = rows.withColumn("n_words", _long(F.size("_h")))
    rows = rows.withColumn("_lines", F.filter(
        F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    rows = rows.withColumns({
        "word_chars": _long(F.length(F.translate(text, BLANKS, ""))),
        "n_symbols": _long(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))),
        "n_dup_lines": _long(F.size("_lines") - F.size(F.array_distinct("_lines"))),
    })
    rows = repeated_words(rows)
    rows = rows.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    rows = rows.withColumn("llr", F.col("_score"))
    rows = rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("llr") >= F.col("_cut"), F.lit(True)))
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in cols], *MEASURES, "base_failed", "llr", "kept")


def keep(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass, with their own columns."""
    cols = docs.columns
    own = docs.select(F.struct(*cols).alias("row"), "doc_id", "text", *[c for c in cols if c == "lang"])
    judged = judge(own, labels, **options)
    # the row number keeps the optimiser from copying the expressions behind ``kept`` into a filter below them
    return judged.withColumn("_at", F.monotonically_increasing_id()).filter("kept and _at >= 0").select(
        *[F.col("row").getField(c).alias(c) for c in cols])
