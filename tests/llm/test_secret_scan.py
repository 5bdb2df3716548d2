"""Secret scan: spans against Python's regular expressions, trigram queries against matching texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from llm_data import SF01
from riskmart.llm import secret_scan as scan
from riskmart.llm.common import table

BASE = [(0, re.compile(scan.BASE_RULES[0].pattern, re.I | re.A), 2, 6), (1, re.compile("AKIA[A-Z0-9]+"), 0, 20),
        (2, re.compile("[0-9a-f]+"), 0, 24)]


def base_spans(text):
    return sorted((m.start(), kind, m.end()) for kind, pattern, group, least in BASE
                  for m in pattern.finditer(text or "") if len(m[group]) >= least)


def made(rng):
    parts = ["password", "PassWd=", "secret: ", "token", "api_key", "apikey", "=", ":", " ", "'", '"', "abcdef", "ab", "AKIA",
             "Z9" * rng.randint(1, 12), "0af" * rng.randint(1, 12), "\U0001f600", "é", "\n", "secret=token:abcdefg", "ghp_" + "a" * 36]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))


def check(docs):
    got = scan.scan(docs)
    names = [r.kind for r in scan.RULES]
    rows = got.select("text", "secrets", scan.listed(3).alias("base")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        base = [(s["start"], s["kind"], s["end"]) for s in r["secrets"] if s["kind"] < 3]
        assert base == base_spans(r["text"])
        assert r["base"] == ",".join(f"{names[k]}:{a}:{b}" for a, k, b in base)
    return rows


def test_spans_equal_python(spark):
    rng = random.Random(3)
    check(spark.createDataFrame([(i, made(rng)) for i in range(600)], "doc_id long, text string"))


def test_spans_on_documents(spark):
    rows = check(table(spark, SF01, "documents").select("doc_id", "text"))
    assert sum(len(r["secrets"]) for r in rows) > 10


def test_trigram_queries_hold_for_all_matches():
    samples = {"assign": ["password=abcdef", "APIKEY:'x", "api_key = zzz", "passwd:q"], "access": ["AKIA" + "A" * 16],
               "github": ["ghp_" + "a" * 36], "slack": ["xoxb-" + "1" * 10], "google": ["AIza" + "b" * 35],
               "jwt": ["eyJ" + "a" * 8 + ".eyJ" + "b" * 8 + "." + "c" * 8], "pem": ["-----BEGIN RSA PRIVATE KEY-----"]}
    for rule in scan.RULES:
        query = scan.trigram_query(rule)
        assert (query is None) == (rule.kind == "hex")
        for text in samples.get(rule.kind, []):
            assert re.search(rule.pattern, text, re.I if rule.ignore_case else 0)
            assert any(all(t in text.lower() for t in a) for a in query)


def test_redaction_removes_every_span_and_nothing_else(spark):
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(made(rng) for _ in range(200))],
                                 "doc_id long, text string, n_chars long")
    spans = {r["doc_id"]: r["secrets"] for r in scan.scan(docs).collect()}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in scan.redact(docs).collect():
        hidden = {i for s in spans[r["doc_id"]] for i in range(s["start"], s["end"])}
        kept = "".join(c for i, c in enumerate(before[r["doc_id"]]) if i not in hidden)
        assert r["text"].replace("[SECRET]", "") == kept and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("which", ["odd_docs", "no_docs"])
def test_odd_rows(request, which):
    docs = request.getfixturevalue(which)
    check(docs)
    assert scan.redact(docs).columns == docs.columns
    assert scan.redact(docs).count() == docs.count()


def test_empty_digest(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    got = scan.scan(docs).select(F.sha2(scan.listed(3), 256).alias("h")).first()["h"]
    assert got == hashlib.sha256(b"").hexdigest()
