"""Sources, pages and posts that the registered queries derive from the tables, here from files and by cases."""

import hashlib
import json
from xml.etree import ElementTree

import zstandard
from corpuskiln.functions import html, markdown
from corpuskiln.operators import language_model, repeats
from corpuskiln.sources import files, framing, web
from pyspark.sql import functions as F


def column(spark, texts, each):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", each("text").alias("x")).collect()
    return [r["x"] for r in sorted(rows, key=lambda r: r["i"])]


def test_zstandard_lines_of_several_frames(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "BATCH_BYTES", 20)
    lines = [f"rivi {k} ä" for k in range(50)]
    squeeze = zstandard.ZstdCompressor().compress
    (tmp_path / "a.zst").write_bytes(squeeze("\n".join(lines[:20]).encode() + b"\n") + squeeze("\n".join(lines[20:]).encode()))
    (tmp_path / "empty.zst").write_bytes(squeeze(b""))
    assert [(r["pos"], r["value"]) for r in files.zst_lines(spark, str(tmp_path)).orderBy("pos").collect()] == list(enumerate(lines))


def test_json_folders_books_and_texts(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "a.json").write_text(json.dumps({"data": [{"id": 1, "content": [{"type": "text", "text": "a"}, "bad", {"type": "bullet-list", "items": None}]}, {"id": 2, "content": 5 and []}]}))
    (tmp_path / "x" / "y" / "b.json").write_text("{broken")
    assert sorted((r["id"], r["text"]) for r in files.news_files(spark, str(tmp_path)).collect()) == [("news:1", "a\n\n"[:1]), ("news:2", "")]
    (tmp_path / "x" / "kirja.txt").write_bytes("Public domain\r\n\r\nTämä on _teksti_.\r\n".encode("latin-1"))
    r = files.book_documents(spark, str(tmp_path)).first()
    assert (r["id"], r["license"], r["text"].strip()) == ("book:kirja", None, "Public domain\n\nTämä on teksti.") or r["license"] == "Public domain"
    assert files.text_documents(spark, str(tmp_path / "x"), recursive=True).count() > 1


def test_ascii_json(spark):
    texts = ["plain", "ä € 😀 \"q\" \\ \n", ""]
    got = column(spark, texts, lambda c: files.ascii_json(F.to_json(F.struct(F.col(c).alias("text")))))
    assert [json.loads(x)["text"] for x in got] == texts and all(x.isascii() for x in got)
    assert got[1] == json.dumps({"text": texts[1]}, separators=(",", ":"))


def test_html(spark):
    pages = {
        "<title>T</title><p>a<b>b</b> &amp; c</p><script>var x='</p>'</script><div>d<br>e</div>": "T\nab & c\nd\ne", "": "", "no marks": "no marks",
        "<p>a\n b&nbsp;c &#228;&#xE4; &bogus; &#0; &lt;i&gt;": "a b c ää &bogus; &#0; <i>", "x<!-- <p>no</p> -->y<style>p{}": "xy", "<P CLASS=a>Up</P><UL><LI>1<LI>2</UL>": "Up\n1\n2",
    }
    assert column(spark, [*pages, None], html.html_text) == [*pages.values(), None]
    assert column(spark, ["<nav><a>menu</a></nav><p>text</p><footer>foot</footer>"], lambda c: html.html_text(c, "main")) == ["text"]
    assert column(spark, ["a\n\n\nb", "<p>a</p><p>b</p>"], html.html_aware_paragraphs) == [["a", "b"], ["a", "b"]]


def test_markdown(spark):
    posts = {
        "# Head #\n\nsome **bold** and *slanted* and `code`": "Head\n\nsome bold and slanted and code", "~~gone~~ &gt;!secret!&lt; x": "gone secret x",
        "[a link](http://x.y/(z)) ![pic](u) <http://a.b>": "a link pic http://a.b", "&gt; quote\n\nrest": "quote\n\nrest", "- one\n- two\n* three": "* one\n* two\n* three",
        "a_b_c 2 * 3 * 4 \\*no\\*": "a_b_c 2 * 3 * 4 *no*", "|a|b|\n|-|:-:|\n|1|2|": "a  b\n1  2", "***\n\n```\nx\n```": "x", "&amp;lt; &amp;": "&lt; &",
    }
    assert column(spark, [*posts, None], markdown.markdown_text) == [*posts.values(), None]
    df = spark.createDataFrame([("A  *title*", "body"), (None, "body"), ("", "body")], "t string, b string")
    assert [r["x"] for r in df.select(markdown.post_text("t", "b").alias("x")).collect()] == ["A title\n\nbody", "body", "body"]


def test_web_outcomes(spark):
    rows = [("1", "o1", "response", "u", "d", "text/html", 5, b"<p>hei</p>"), ("2", "o2", "conversion", "u", "d", "text/plain", 5, "ä\x00".encode()), ("3", "o3", "response", "u", "d", "text/plain", 5, b"\xff"), ("4", None, "response", None, None, "image/png", 5, b"x"), ("5", "o5", "response", "u", "d", None, 0, b""), ("6", "o6", "warcinfo", "u", "d", None, 1, b"x"), ("7", "o7", "response", "u", "d", "text/html", 1, b"<p></p>"), ("8", "o8", "response", "u", "d", "text/css", 1, b"a{}")]
    df = spark.createDataFrame(rows, "record_id string, refers_to string, record_type string, uri string, date string, mime string, length long, payload binary")
    got = web.web_outcomes(df)
    assert {r["id"][-1]: (r["outcome"], r["text"]) for r in got.collect() if r["outcome"] == "output"} == {"1": ("output", "hei"), "2": ("output", "ä"), "8": ("output", "a{}")}
    assert {r["id"][-1]: r["outcome"] for r in got.collect() if r["outcome"] != "output"} == {"3": "error", "4": "unsupported", "5": "empty-content", "6": "other-record", "7": "empty-text"}
    assert web.web_counts(got).first().asDict() == {"total": 8, "responses": 6, "conversions": 1, "empties": 2, "unsupported": 1, "errors": 1, "output": 3}
    assert web.web_documents(df, refers_to=True).where("id = 'commoncrawl:o1'").count() == 1
    assert [tuple(r)[:3] for r in web.wet_documents(df).collect()] == [("commoncrawl:o2", "ä\x00", "2")]


def test_token_lines_and_ids(spark):
    head = '<text comment_id="5" title="yö &amp; &quot;x&quot; &lt;">'
    tok = lambda w, s="_": "\t".join([w, *["_"] * 7, s, "_", "_"])
    lines = ["<!-- c -->", head, '<paragraph id="1">', '<sentence id="1">', tok("Hei", "SpaceAfter=No"), tok("&lt;3"), tok("loppu", "SpacesAfter=\\n\\n"), "</sentence>", "</paragraph>", tok("uusi"), "</text>", '<text comment_id="6">', tok("auki")]
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(lines)], "file string, pos int, value string")
    (r,) = framing.vrt_documents(df).collect()
    expected = hashlib.md5(ElementTree.tostring(ElementTree.fromstring(head + "</text>"))).hexdigest()
    assert (r["id"], r["text"], r["attributes"]) == (f"s24:{expected}", "Hei<3 loppu\n\nuusi", {"comment_id": "5", "title": 'yö & "x" <'})


def test_second_framing_and_blocks(spark):
    lines = ['# <doc urn="u1">', "# text = lost", "# </doc>", '# <doc id="a">', "# <p>", "# text = Yksi.", "# text = Kaksi.", "# <p>", "# <p>", "# text = ", "# </doc>", '# <doc x="y">', "# <p>", "# </doc>", '# <doc id="open">', "# <p>", "# text = z"]
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(lines)], "file string, pos int, value string")
    assert sorted((r["id"], r["text"]) for r in framing.plain_corpus(df).collect()) == [("ERROR", ""), ("a", "Yksi. Kaksi.\n\n")]
    assert framing.corpus_blocks(df).where("doc = 2").first()["block"] == "\n".join(lines[3:11])


def test_posts_are_counted_by_reason(spark):
    post = lambda i, f, b: json.dumps({"id": i, "subreddit": f, "body": b})
    raw = [(0, post("a", "s", "[deleted]")), (1, post("a", "s", "live")), (2, post("b", "s", "x")), (3, post("b", "other", "x")), (4, "{bad"), (5, json.dumps({"id": "c", "body": "no forum"}))]
    posts = framing.forum_posts(spark.createDataFrame(raw, "n int, value string"))
    got = framing.post_outcomes(posts, "n", "s")
    assert [r["outcome"] for r in got.orderBy("n").collect()] == ["deleted", "duplicate", "output", "other-forum", "bad", "other-forum"]
    assert [tuple(r) for r in framing.post_counts(got.withColumn("file", F.lit("f")), ["file"]).collect()] == [("f", 6, 3, 1, 1, 1)]
    assert [tuple(r) for r in framing.post_documents(got).collect()] == [("reddit:b", "x", "s")]
    assert framing.forum_posts(spark.createDataFrame(raw, "n int, value string"), subreddit="s").count() == 3


def test_numbers_before_bytes(spark):
    rows = [(b"  12 sana\n",), (b"7 \xe4\xf6",), ("3 ä b".encode(),), (b"x y",), (b"12",), (b"",)]
    got = framing.numbered_words(spark.createDataFrame(rows, "content binary")).collect()
    assert [tuple(r) for r in got] == [(12, " sana", "word"), (7, None, "undecodable"), (3, " ä b", "word"), (None, None, "bad-number"), (1, "2", "word"), (None, None, "bad-number")]


def test_back_off(spark):
    arpa = spark.createDataFrame([(1, "<s>", -99.0, -0.5), (1, "a", -1.0, -0.2), (1, "b", -1.2, -0.1), (1, "</s>", -0.8, 0.0), (1, "<unk>", -3.0, 0.0), (2, "<s> a", -0.3, -0.4), (2, "a b", -0.6, 0.0), (3, "<s> a b", -0.1, 0.0)], "order int, ngram string, log10p double, backoff double")
    lines = spark.createDataFrame([(1, 0, ["<s>", "a", "b", "</s>"]), (2, 0, ["<s>", "b", "zz", "</s>"])], "doc_id int, line int, t array<string>")
    got = {r["doc_id"]: (r["n"], round(r["log10p"], 6)) for r in language_model.backoff_scores(lines, arpa, 3).collect()}
    # p(a|<s>) + p(b|<s> a) + [backoff(a b) 0 + backoff(b)] + p(</s>); second: words by their own weight, <unk> for zz
    assert got == {1: (3, round(-0.3 - 0.1 - 0.1 - 0.8, 6)), 2: (3, round((-0.5 - 1.2) + (-0.1 - 3.0) + (-0.8), 6))}


def test_line_mode_and_latest(spark):
    rows = [(1, "same line of words here\nown line one two"), (2, "own line three four\nsame line of words here"), (3, "same line of words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in repeats.without_duplicates(df, n=3, lines=True).collect()} == {1: rows[0][1], 2: "own line three four"}
    assert {r["doc_id"]: r["text"] for r in repeats.without_duplicates(df, n=3, lines=True, latest=True).collect()} == {1: "own line one two", 2: "own line three four", 3: rows[2][1]}
