"""WARC archive: exact round trip, oracle columns, damaged archives."""

import base64
import hashlib

import pytest

from llm_data import SF01
from riskmart.llm import warc
from riskmart.llm.common import table


def expected(rows, least):
    top = {}
    for r in rows:
        h = r["html"] or ""
        if r["page_id"] is not None:
            top[h] = max(top.get(h, r["page_id"]), r["page_id"])
    out = []
    for r in rows:
        raw = (r["html"] or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        revisit = len(raw) >= least and r["page_id"] != top.get(r["html"] or "")
        out.append((r["page_id"], len(raw), digest, "revisit" if revisit else "response",
                    top.get(r["html"] or "") if revisit else None))
    return sorted(out, key=repr)


def columns(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}", t) for i, t in enumerate(["<p>é</p>", "same", "same", None, "", "x" * 70_000, "same", "\r\n\r\nWARC"])]
    return spark.createDataFrame([r + ("clash", 1) for r in rows],
                                 "page_id long, url string, html string, payload string, bytes int").repartition(3)


@pytest.mark.parametrize("least", [0, 5])
def test_index(pages, least):
    assert columns(warc.archive(pages, least)) == expected(pages.collect(), least)


def test_round_trip_and_export(spark, pages, tmp_path):
    path = f"file://{tmp_path}/a"
    warc.write_archive(pages, path)
    got = {r["page_id"]: r for r in warc.restore(spark, path).collect()}
    assert {i: bytes(r["payload"]).decode() for i, r in got.items()} == {
        r["page_id"]: r["html"] or "" for r in pages.collect()}
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len({r["html"] or "" for r in pages.collect()})
    for r in got.values():
        head, _, block = r["header"].partition("\r\n\r\n")
        size = int(head.rpartition("Content-Length: ")[2])
        body = len(r["payload"]) if r["record_type"] == "response" else 0
        assert len(block.encode()) + body == size
    warc.export_warc(spark, path, f"file://{tmp_path}/w")
    plain = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    assert plain.count(b"WARC/1.1\r\n") == len(got)
    records, at = 0, 0
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at) + 4
        at = end + int(plain[at:end].rpartition(b"Content-Length: ")[2])
        assert plain[at:at + 4] == b"\r\n\r\n"
        at, records = at + 4, records + 1
    assert records == len(got)


def test_damage_is_found(spark, pages, tmp_path):
    path = f"file://{tmp_path}/b"
    warc.write_archive(pages, path)
    bad = spark.read.parquet(f"{path}/payloads").selectExpr("sha256", "encode('other', 'UTF-8') AS payload")
    bad.write.parquet(f"file://{tmp_path}/c/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"file://{tmp_path}/c/records")
    with pytest.raises(Exception, match="digest"):
        warc.read_records(spark, f"file://{tmp_path}/c").collect()


def test_documents_and_empty(spark):
    pages = table(spark, SF01, "pages")
    assert columns(warc.archive(pages)) == expected(pages.collect(), 0)
    assert warc.archive(pages.filter("false")).count() == 0


def test_repeated_rows_have_one_response(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (1, "u", "a"), (None, None, "a"), (None, None, "b")],
                                  "page_id long, url string, html string")
    rows = warc.archive(pages).collect()
    assert sorted(r["record_type"] for r in rows) == ["response", "response", "revisit", "revisit"]
    assert {r["refers_to"] for r in rows if r["record_type"] == "revisit"} == {1}


def test_urls_cannot_pose_as_header_lines(spark, tmp_path):
    urls = ["http://a\r\nX-Page-ID: 999\r\nb", "http://a\nb", "\r\n\r\n", "http://x/\x00\x7f\t", "http://plain/%0A", "",
            "a\r\nWARC-Type: revisit\r\nWARC-Payload-Digest: sha1:AAAA\r\n"]
    rows = [(i, u, f"<p>{i % 3}</p>") for i, u in enumerate(urls)] + [(50, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = f"file://{tmp_path}/spoof"
    warc.write_archive(pages, path)
    got = {r["page_id"]: r for r in warc.read_records(spark, path).collect()}
    assert {i: r["url"] for i, r in got.items()} == {**dict(enumerate(urls)), 50: ""}
    assert sorted(got) == [*range(len(urls)), 50]
    want = {i: max(j for j in range(len(urls)) if j % 3 == i % 3) for i in range(len(urls))}
    for i, top in want.items():
        assert got[i]["record_type"] == ("response" if i == top else "revisit")
        assert got[i]["refers_to"] == (None if i == top else top)
    back = {r["page_id"]: r for r in warc.restore(spark, path).collect()}
    assert {i: bytes(r["payload"]).decode() for i, r in back.items()} == {i: h or "" for i, _, h in rows}
    for r in back.values():
        head = r["header"].split("\r\n\r\n")[0].split("\r\n")
        assert len([x for x in head if x.startswith("X-Page-ID: ")]) == 1 and not any("\n" in x for x in head)
