"""Secret scans over a trigram inverted index, in DataFrame functions only.

Every rule is a regular expression.  From its syntax tree a Boolean trigram query is derived: an OR of ANDs of trigrams
that any matching text must hold (case folded).  The index has a posting (trigram, text hash) for every trigram of some
query and every text that holds it; a rule's candidates are the texts whose postings meet all trigrams of one of its
ANDs.  Candidates are verified with the regular expression.  A rule without mandatory trigrams scans every text.

Spans are (start, end) in code points, end exclusive, leftmost and non-overlapping per rule.  ``min_length`` applies to
the match or to its ``group`` after matching, so that a short match still takes its place.

Defined results: a null text is empty and has no spans; repeated rows and equal texts each get their own spans; an empty
table gives no rows; columns other than the text pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import text_of

parser = re._parser


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    min_length: int = 0
    group: int = 0
    ignore_case: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


#: The base rules, in the order of the contract.  A maximal run of hex digits (or of an access key's
#: letters) with too few characters holds no long one, so its length can stand in the pattern.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         min_length=6, group=2, ignore_case=True),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further published token formats.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: Sets of strings beyond these sizes are not enumerated; the trigrams found up to there still count.
MOST_STRINGS, MOST_CHARS = 64, 8

Query = frozenset  # of ANDs, each a frozenset of trigrams
ANYTHING: Query = frozenset([frozenset()])


def _absorbed(query) -> Query:
    """Without the ANDs that demand more than another one."""
    query = frozenset(query)
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(a: Query, b: Query) -> Query:
    joined = _absorbed(x | y for x, y in product(a, b))
    return joined if len(joined) <= MOST_STRINGS else min(a, b, key=len)


def _of_strings(strings: set[str]) -> Query:
    return _absorbed(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def _characters(items) -> set[str] | None:
    """The characters of a class, or None if there are too many."""
    found: set[str] = set()
    for op, arg in items:
        if op is parser.LITERAL:
            found.add(chr(arg).lower())
        elif op is parser.RANGE and arg[1] - arg[0] < MOST_CHARS:
            found |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_CHARS else None


def _strings(tree) -> set[str] | None:
    """All strings that a part of the pattern matches, lower case, or None if they are not few."""
    found = {""}
    for op, arg in tree:
        if op is parser.LITERAL:
            part = {chr(arg).lower()}
        elif op is parser.IN:
            part = _characters(arg)
        elif op is parser.SUBPATTERN:
            part = _strings(arg[-1])
        elif op is parser.BRANCH:
            parts = [_strings(x) for x in arg[1]]
            part = None if None in parts else set().union(*parts)
        elif op is parser.MAX_REPEAT and arg[1] != parser.MAXREPEAT and arg[1] <= 3:
            once = _strings(arg[2])
            part = None if once is None else {
                "".join(x) for n in range(arg[0], arg[1] + 1) for x in product(once, repeat=n)}
        elif op is parser.AT:
            part = {""}
        else:
            part = None
        if part is None or len(found) * len(part) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in part}
    return found


def _query(tree) -> Query:
    """The trigram query of a part: runs of enumerable items give trigrams, the others what is inside them."""
    found, run = ANYTHING, {""}
    for item in tree:
        op, arg = item
        part = _strings([item])
        if part is not None and len(run) * len(part) <= MOST_STRINGS:
            run = {a + b for a in run for b in part}
            continue
        found, run = _both(found, _of_strings(run)), {""}
        if part is not None:
            run = part
        elif op is parser.SUBPATTERN:
            found = _both(found, _query(arg[-1]))
        elif op is parser.BRANCH:
            found = _both(found, _absorbed(a for x in arg[1] for a in _query(x)))
        elif op in (parser.MAX_REPEAT, parser.MIN_REPEAT) and arg[0] > 0:
            found = _both(found, _query(arg[2]))
    return _both(found, _of_strings(run))


def trigram_query(rule: Rule) -> list[list[str]] | None:
    """The rule's OR of ANDs of trigrams; None if some match needs no trigram."""
    query = _query(parser.parse(rule.pattern, re.IGNORECASE if rule.ignore_case else 0))
    return None if frozenset() in query else sorted(sorted(a) for a in query)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: a row (trigram, key) for each trigram and each distinct text hash that holds it."""
    low = docs.select("key", F.lower(text_of()).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("key", F.explode(held).alias("trigram")).distinct()


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame | None:
    """(key, kinds): for each text hash the rules whose trigram query its postings meet; None if no rule has one."""
    plan = [(r.kind, f"{r.kind}{i}", len(a), t) for r in rules for i, a in enumerate(trigram_query(r) or []) for t in a]
    if not plan:
        return None
    spark = docs.sparkSession
    wanted = spark.createDataFrame(plan, "kind string, part string, need int, trigram string")  # a row per rule's trigram
    index = postings(docs, sorted({p[3] for p in plan}))
    met = (index.join(F.broadcast(wanted), "trigram").groupBy("key", "kind", "part")
           .agg(F.count(F.lit(1)).alias("n"), F.first("need").alias("need")).filter("n = need"))
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _spans(rule: Rule, text: Column) -> Column:
    """Array of (start, end) of the rule's matches that are long enough."""
    pieces = F.split(text, rule.java, -1)
    hits = F.regexp_extract_all(text, F.lit(rule.java), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.java), F.lit(rule.group)) if rule.group else hits
    three = F.arrays_zip(pieces.alias("gap"), hits.alias("hit"), tested.alias("tested"))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    # the last piece has no match behind it
    walk = F.aggregate(
        F.slice(three, 1, F.size(hits)), F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.when(F.length(x["tested"]) >= rule.min_length, F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + F.length(x["gap"])).alias("start"),
                (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end")))))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: acc["out"])
    return F.when(F.rlike(text, F.lit(rule.java)), walk).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secrets``: an array of (start, kind, end) by start, then by the rules' order (``kind`` is the
    rule's number)."""
    cols = docs.columns
    rows = docs.select(F.struct(*cols).alias("row"), text_of().alias("text"), F.xxhash64(text_of()).alias("key"))
    met = candidates(docs.select("text", F.xxhash64(text_of()).alias("key")), rules)
    if met is None:
        met = docs.sparkSession.createDataFrame([], "key long, kinds array<string>")
    found = rows.join(met, "key", "left")
    each = {}
    for r in rules:
        full = trigram_query(r) is None
        is_candidate = F.lit(True) if full else F.coalesce(F.array_contains("kinds", r.kind), F.lit(False))
        each[r.kind] = F.when(is_candidate, _spans(r, F.col("text"))).otherwise(
            F.array().cast("array<struct<start:int,end:int>>"))
    found = found.select("row", *[x.alias(f"s_{k}") for k, x in each.items()])

    def numbered(i: int, kind: str) -> Column:
        return F.transform(F.col(f"s_{kind}"), lambda s: F.struct(
            s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end")))

    spans = F.array_sort(F.concat(*[numbered(i, r.kind) for i, r in enumerate(rules)]))
    return found.select(*[F.col("row").getField(c).alias(c) for c in cols if c != "secrets"], spans.alias("secrets"))


def count_of(kind: int) -> Column:
    return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")


def listed(kinds: int, rules: tuple[Rule, ...] = RULES) -> Column:
    """The spans of the first ``kinds`` rules as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(F.filter("secrets", lambda s: s["kind"] < kinds), lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span replaced by ``mark`` (overlapping spans by one); ``n_chars``, where there is one,
    follows the text."""
    cols = docs.columns
    found = scan(docs.select(F.struct(*cols).alias("row"), text_of().alias("text")), rules)
    text = F.col("text")
    kept = F.aggregate(
        F.col("secrets"), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(
                acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    found = found.withColumn("clean", F.when(F.size("secrets") > 0, kept))
    changed = {"text": F.coalesce("clean", F.col("row.text"))}
    if "n_chars" in cols:
        changed["n_chars"] = F.coalesce(F.length("clean").cast(dict(docs.dtypes)["n_chars"]), F.col("row.n_chars"))
    return found.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in cols])
