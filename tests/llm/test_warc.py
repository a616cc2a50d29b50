import hashlib
import struct
from pathlib import Path

from corpuskiln.llm import warc
from corpuskiln.llm.common import table


def expected(rows):
    top = {}
    for i, h in rows:
        top[h or ""] = max(i, top.get(h or "", i))
    out = {}
    for i, h in rows:
        b = (h or "").encode()
        again = len(b) >= 1000 and top[h or ""] > i
        out[i] = (len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", top[h or ""] if again else None)
    return out


def answers(df):
    return {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()}


def test_pages_round_trip(spark, sf):
    rows = [(r["page_id"], r["html"]) for r in table(spark, sf, "pages").collect()]
    assert answers(warc.op3_warc(spark, sf)) == expected(rows)


def test_revisits_nulls_and_payloads_with_line_ends(spark):
    big = "é" * 600 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, big), (2, None), (3, ""), (4, big), (5, "x" * 999), (6, "x" * 999), (7, "y" * 1000), (8, "y" * 1000), (9, big), (10, "\r\n\r\n")]
    df = spark.createDataFrame([(a, None, b, 1) for a, b in rows], "page_id long, url string, html string, payload_bytes int")
    assert answers(warc.round_trip(df)) == expected(rows)
    assert warc.round_trip(spark.createDataFrame([], df.schema)).collect() == []


def test_archive_layout(spark, sf, tmp_path):
    pages = table(spark, sf, "pages")
    files = warc.write_archives(pages, f"file://{tmp_path}/a").collect()
    assert sum(f["records"] for f in files) == pages.count()
    for f in files:
        data = Path(tmp_path, "a", f["file"]).read_bytes()
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D and size > 0 and len(data) == f["bytes"]
        assert sum(1 for _ in warc.records_of(data)) == f["records"]
    Path(tmp_path, "a", "records-999999-0000-stray.warc.zst").write_bytes(b"left by a lost task")
    listed = spark.createDataFrame(files)
    got = warc.read_archives(spark, f"file://{tmp_path}/a", listed)
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    assert {int(r["number"]): r["payload"].decode() for r in got.collect() if r["record_type"] == "response"}.items() <= html.items()
