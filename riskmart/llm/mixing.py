"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled, reproducible order, repeated as often as its target needs.  A
copy of a document has a virtual finish time: the words of its source up to and including it, divided by the target of
the source.  All copies are globally range-sorted by that time and the order is cut at the total budget.  The packets
of the queues are words: where the line is reached inside a document, the words before it are taken.  So each source
gives its target to the word, and at any point of the mix the sources stand in the target proportions.

Defined results: a null text has no words; documents without words cost nothing and pass once, with 0 words taken; the
null source is a source of its own, last in order; repeated rows are documents of their own; an empty table gives an
empty mix.  Only ``doc_id``, ``text`` and ``source`` are read, whatever other columns there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import range_prefix, text_of, words
from riskmart.session import checkpoint_table

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3


def shuffle_key(doc_id: Column, seed: int) -> Column:
    """Place of a document in its source's shuffled order."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")))


def source_targets(slim: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: its size, and its target in words.

    The budget (all words) is shared by weight; no target is above ``max_repeat`` times its source's size, and what is
    left over is shared by weight again.  With the sources in the order in which they reach their cap, a level is what
    each unit of weight gets if just the earlier ones are at their cap: it rises up to the true level and falls after
    it.  One row per source passes the single-task windows.
    """
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * max_repeat)
    t = t.withColumn("full_at", F.col("cap") / F.col("weight"))
    earlier = Window.orderBy("full_at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))))
    t = t.withColumn("level", level)
    t = t.withColumn("level", F.max("level").over(everything))
    return t.select("source", "source_size",
                    F.least(F.col("weight") * F.col("level"), F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 17,
        key: Column | None = None) -> DataFrame:
    """The mix: one row per document and copy that is (or might be) taken.

    Columns: rid (row number of the document in this run), key (``key`` of its row, by default the text's checksum),
    doc_id, source, size, epoch (copy, from 0), source_size, target, finish (virtual finish time; the line is at 1), mix_start (words of the mix before it),
    words (those taken; 0 behind the line).  ``orderBy("mix_start")`` gives the training order.
    """
    slim = checkpoint_table(docs.select(
        "doc_id", "source", F.size(words(text_of())).cast("long").alias("size"),
        (F.crc32(text_of()) if key is None else key).alias("key"), shuffle_key(F.col("doc_id"), seed).alias("place")), "mix")
    slim = slim.withColumn("nosource", F.col("source").isNull())
    targets = source_targets(slim, weights, max_repeat)
    order = Window.orderBy("nosource", "source").rowsBetween(Window.unboundedPreceding, -1)
    targets = checkpoint_table(targets.withColumn("nosource", F.col("source").isNull()).withColumn(
        "source_base", F.coalesce(F.sum("source_size").over(order), F.lit(0))).drop("nosource"), "mix")
    queue = range_prefix(slim, ["nosource", "source", "place", "key", "size"], "size", row="rid")
    queue = (queue.alias("q")
             .join(targets.alias("t"), F.col("q.source").eqNullSafe(F.col("t.source")))
             .select("q.rid", "q.doc_id", "q.source", "q.size", "q.key", "q.place", "t.source_size", "t.target",
                     (F.col("q._before") - F.col("t.source_base")).alias("start")))
    quota = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("size") == 0, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil(quota / F.col("source_size")))).cast("int")
    copies = queue.withColumn("quota", quota).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
    begin = F.col("epoch") * F.col("source_size") + F.col("start")
    copies = copies.withColumn("words", F.least(F.col("size"), F.greatest(F.lit(0), F.col("quota") - begin)))
    copies = copies.withColumn("finish", F.when(F.col("target") > 0, (begin + F.col("size")) / F.col("target"))
                               .otherwise(F.lit(0.0)))
    # the words that a copy holds before the line end at the line at the latest
    copies = copies.withColumn("line", F.least(F.col("finish"), F.lit(1.0))).withColumn(
        "behind", (F.col("words") < F.col("size")) & (F.col("words") == 0))
    ordered = range_prefix(copies, ["behind", "line", "place", "rid", "epoch"], "words", "mix_start")
    budget = targets.agg(F.sum("source_size")).scalar()
    left = F.greatest(F.lit(0), budget - F.col("mix_start"))
    return ordered.withColumn("words", F.least(F.col("words"), left)).select(
        "rid", "key", "doc_id", "source", "size", "epoch", "source_size", "target", "finish", "mix_start", "words",
        "behind")


def taken_per_document(mixed: DataFrame) -> DataFrame:
    """One row per document: the words that the mix takes of it, repeats counted."""
    return mixed.groupBy("rid").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")],
        F.sum("words").alias("taken"), F.min("mix_start").alias("mix_start")).drop("rid")


def take(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a row per copy, the text of the copy at the line cut to its words.

    All columns of ``docs`` stay; ``n_chars``, where there is one, follows the text.  Rows alike in every column are
    interchangeable: one of them stands for all, and the copies find it by the row's key: 128 bits of its text and 128 of
    all columns.
    """
    cols = docs.columns
    key = F.concat_ws("-", F.md5(text_of()), F.xxhash64(*cols), F.xxhash64(F.lit(1), *cols))
    mixed = mix(docs, key=key, **options).filter(~F.col("behind")).select(
        F.col("key").alias("_key"), F.col("size").alias("_size"), F.col("words").alias("_words"))
    rows = docs.select(key.alias("_key"), F.size(words(text_of())).cast("long").alias("_size"),
                       F.struct(*cols).alias("_row")).dropDuplicates(["_key", "_size"])
    both = rows.join(mixed, ["_key", "_size"])
    whole = F.col("_words") >= F.col("_size")
    cut = F.array_join(F.slice(words(F.coalesce(F.col("_row.text"), F.lit(""))), 1, F.col("_words").cast("int")), " ")
    changed = {"text": F.when(whole, F.col("_row.text")).otherwise(cut)}
    if "n_chars" in cols:
        changed["n_chars"] = F.when(whole, F.col("_row.n_chars")).otherwise(
            F.length(cut).cast(dict(docs.dtypes)["n_chars"]))
    return both.select(*[changed.get(c, F.col("_row").getField(c)).alias(c) for c in cols])
