import gzip
import json

from corpuskiln.operators import packing, relations
from corpuskiln.sources import files, framing
from pyspark.sql import functions as F


def test_web_archives(spark, tmp_path):
    def record(kind, number, body, more=""):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{number}>\r\n{more}Content-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>hei</p>"
    (tmp_path / "a").mkdir()
    with gzip.open(tmp_path / "a" / "x.warc.gz", "wb") as f:
        f.write(record("warcinfo", 0, b"x") + record("response", 1, http, "WARC-Target-URI: http://a/\r\n") + record("conversion", 2, "ä".encode(), "WARC-Refers-To: <urn:1>\r\nContent-Type: text/plain\r\n"))
    rows = sorted(map(tuple, files.web_records(spark, str(tmp_path)).select("record_id", "refers_to", "uri", "mime", "payload").collect()))
    assert rows == [("urn:1", None, "http://a/", "text/html", bytearray(b"<p>hei</p>")), ("urn:2", "urn:1", None, "text/plain", bytearray("ä".encode()))]


def test_news_items_and_html(spark, tmp_path):
    xml = '<n:newsItem xmlns:n="u" guid="g1"><contentMeta><headline>Otsikko</headline><lang>fi</lang></contentMeta><contentSet><inlineXML><html><body><h1>Väli</h1><p>Yksi <b>kaksi</b>\n kolme</p><p> </p></body></html></inlineXML></contentSet></n:newsItem>'
    (tmp_path / "n.xml").write_text(xml)
    r = files.newsml(spark, str(tmp_path)).first()
    assert (r["id"], r["paragraphs"], dict(r["meta"])) == ("g1", ["Otsikko", "Väli", "Yksi kaksi kolme"], {"headline": ["Otsikko"], "lang": ["fi"]})


def test_news_trees(spark):
    tree = {"data": [{"id": 1, "url": {"full": "u"}, "language": "fi", "content": [{"type": "text", "text": "a"}, {"type": "image", "text": "no"}, {"type": "bullet-list", "items": ["x", "y"]}, {"type": "numbered-list", "items": ["x", "y"]}, {"type": "aside", "content": [{"type": "heading", "text": "deep"}]}]}]}
    r = files.news_json(spark.createDataFrame([(json.dumps(tree),)], "value string")).first()
    assert (r["id"], r["text"], r["url"], r["language"]) == ("news:1", "a\n\n• x\n• y\n\n1. x\n2. y\n\ndeep", "u", "fi")


def test_jsonl_lines_vectors_and_sinks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "text": "ä"}\n{bad\n')
    assert files.jsonl(spark, str(tmp_path / "a.jsonl"), tolerant=True).select("id", "_corrupt_record").collect()[1]["_corrupt_record"] == "{bad"
    (tmp_path / "t.txt").write_text("one\n \n two\n")
    assert [r["text"] for r in files.text_documents(spark, str(tmp_path / "t.txt")).collect()] == ["one", " two"]
    (tmp_path / "v.bin").write_bytes(bytes(range(16)))
    assert [r["a"] for r in files.fixed_vectors(spark, str(tmp_path / "v.bin"), ["a", "b"], 2).collect()] == [[256, 770], [2312, 2826]]
    docs = spark.createDataFrame([("1", 'a\t"b"')], "id string, text string")
    assert files.tsv_lines(docs).first()["value"] == '1\t"a\\t\\"b\\""'
    files.write_jsonl(docs, str(tmp_path / "out"), sort_keys=True)
    assert files.jsonl(spark, str(tmp_path / "out")).first()["text"] == 'a\t"b"'


def test_logs_and_word_lists(spark):
    lines = spark.createDataFrame([("h: FLOPS per GPU = x: 12.3 TFLOPS",), ("noise",), (" forward: 1.5 x backward: 2.0",)], "value string")
    assert [r["flops"] for r in framing.log_rates(lines).collect()] == [12.3e12]
    assert sorted(map(tuple, framing.log_timers(lines, ["forward", "backward"]).collect())) == [("backward", 2.0), ("forward", 1.5)]
    words = framing.word_frequencies(spark.createDataFrame([("  3 a b",), ("2 a",), ("x a",), ("",)], "value string"))
    assert sorted(map(tuple, words.collect())) == [("a", 5), ("b", 3)]
    table = relations.frequency_table(spark.createDataFrame([("ja", 6), ("on", 3), ("auto", 3), ("talo", 1)], "word string, freq long"))
    assert [(r["word"], r["cum"]) for r in table.orderBy("upto").collect()] == [("ja", 6 / 13), ("on", 9 / 13), ("auto", 12 / 13), ("talo", 1.0)]
    low = relations.downsample(spark.createDataFrame([(str(n), n) for n in (49, 50, 51, 150, 250, 350)], "word string, freq long"))
    assert {r["word"]: r["freq"] for r in low.collect()} == {"51": 1, "150": 2, "250": 2, "350": 4}


def test_keyed_dedup_quotes_overlap(spark):
    rows = spark.createDataFrame([("a", 1, "[deleted]"), ("a", 2, "live"), ("b", 3, "live")], "id string, pos int, body string")
    assert [r["id"] for r in relations.keyed_dedup(rows, "id", [F.col("pos")], F.col("body") == "[deleted]").collect()] == ["b"]
    posts = spark.createDataFrame([(1, "c1", "0", "x"), (2, "c2", "c1", "y"), (3, "c3", "c9", "z"), (4, "c9", "0", "w"), (5, "c1", "c1", "v")], "pos int, id string, q string, t string")
    got = {r["pos"]: r["quoted_text"] for r in relations.quote_lookup(posts, "id", "q", "pos", "t").collect()}
    assert got == {1: None, 2: "x", 3: None, 4: None, 5: "v"}
    spans, keeps = spark.createDataFrame([(1, 0, 10), (1, 20, 30), (1, 8, 9)], "k int, start int, end int"), spark.createDataFrame([(1, 5, 8)], "k int, start int, end int")
    assert sorted((r["start"], r["end"]) for r in relations.interval_anti_join(spans, keeps, "k").collect()) == [(8, 9), (20, 30)]


def test_packing_and_split(spark):
    rows = spark.createDataFrame([(1, [1, 2, 3]), (2, [4, 5]), (3, []), (4, [6, 7, 8, 9])], "i int, ids array<int>")
    assert [r["ids"] for r in packing.pack(rows, "i", "ids", 4).orderBy("block").collect()] == [[1, 2, 3, 4], [5, 6, 7, 8]]
    assert [r["ids"] for r in packing.pack_in_batches(rows, "i", "ids", 4, 2).orderBy("batch").collect()] == [[1, 2, 3, 4], [6, 7, 8, 9]]
    forty = packing.head_split(spark.range(40), "id", 5.0)
    assert sorted(r["id"] for r in forty.where("split = 'validation'").collect()) == [0, 1]


def test_frames(spark):
    text = ['pre', '# <doc urn="u1">', "# <p>", "# text = Yksi.", "1\tYksi", "# text = Kaksi.", "# <p>", "# <p>", "# text = Kolme.", "# predicted register: news", "# </doc>", '# <doc collection="c" url="x">', "# text = Loppu."]
    lines = spark.createDataFrame([("f", i, v) for i, v in enumerate(text)], "file string, pos int, value string")
    rows = framing.parsed_corpus(lines).orderBy("id").collect()
    assert [(r["id"], r["text"], r["register"]) for r in rows] == [("corpus:c:x", "Loppu.", None), ("corpus:u1", "Yksi. Kaksi.\n\nKolme.", "news")]
    wiki = ['<doc id="1" url="u" title="T &amp; t">', "a\xa0b", "", "c   d", "</doc>"]
    lines = spark.createDataFrame([("f", i, v) for i, v in enumerate(wiki)], "file string, pos int, value string")
    assert tuple(framing.encyclopedia(lines).first()) == ("wiki:T &amp; t", "a b\n\nc  d", "u")
