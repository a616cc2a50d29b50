"""Documents out of line-framed formats.

Lines come as rows (file, pos, value), however many tasks a file is read in. A running count of start lines
within a file numbers the documents; it is kept by ranges of lines, so that one file, too, is framed by many tasks. Each
document's lines are put in order by their position: what meets in one task is a document, never a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuskiln.functions import text as T
from corpuskiln.functions.html import resolved
from corpuskiln.functions.markdown import post_text
from corpuskiln.functions.masking import replaced
from corpuskiln.functions.text import bound
from corpuskiln.operators.joins import ranged, spread_join
from corpuskiln.storage import if_small, materialize


def read_lines(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(file, pos, value) of text files, plain or gzip; pos counts lines within a file from 0.

    Plain files are read in blocks of bytes, each in a task of its own, and a line belongs to the block that it begins
    in; a gzip file is read as one stream. Numbers come from the blocks' numbers of lines: what is held is one
    line. A line end at the end of a file begins no line. recursive: folders below the path too, else its own files only.
    """
    reader = spark.read.option("recursiveFileLookup", recursive).option("lineSep", "\n")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    lines = reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    lines = materialize(lines.withColumn("row", F.monotonically_increasing_id()), "lines")  # rows of a block are numbered as they are read
    blocks = lines.groupBy("file", "block").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = materialize(blocks.select("file", "block", (before - F.col("first")).alias("shift")), "blocks")
    return lines.join(if_small(blocks), ["file", "block"]).select("file", (F.col("row") + F.col("shift")).alias("pos"), "value")


def segments(lines: DataFrame, starts: Column) -> DataFrame:
    """lines with ``doc``, the number of start lines up to and including each in its file; lines before the first go.

    Start lines are counted within ranges of lines, and the counts of a file's earlier ranges are added: a range of a file
    is a row there.
    """
    cut = ranged(lines.withColumn("__start", F.coalesce(starts, F.lit(False)).cast("int")), [F.col("file"), F.col("pos")], "framed")
    counts = cut.groupBy("file", "__cell").agg(F.sum("__start").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = materialize(counts.select(F.col("file").alias("__file"), F.col("__cell").alias("__c"), before.alias("__before")), "starts")
    w = Window.partitionBy("__cell", "file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    both = cut.withColumn("__in", F.sum("__start").over(w)).join(if_small(counts), F.col("file").eqNullSafe(F.col("__file")) & (F.col("__cell") == F.col("__c")))
    return both.withColumn("doc", F.col("__before") + F.col("__in")).where("doc > 0").drop("__start", "__cell", "__file", "__c", "__before", "__in")


def attributes(line: Column) -> Column:
    """name="value" pairs of a line as a map, character references resolved; the last of equal names wins."""
    last = bound(attribute_pairs(line), lambda pairs: F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["name"] == p["name"])))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["name"], resolved(p["value"]))))


def attribute_pairs(line: Column) -> Column:
    """array<struct<name, value>> of a line's attributes, as they are written."""
    names = F.regexp_extract_all(line, F.lit('([A-Za-z_:][\\w:.-]*)="[^"]*"'), F.lit(1))
    values = F.regexp_extract_all(line, F.lit('[A-Za-z_:][\\w:.-]*="([^"]*)"'), F.lit(1))
    return F.zip_with(names, values, lambda n, v: F.struct(n.alias("name"), v.alias("value")))


def first_after(lines: Column, prefix: str) -> Column:
    """What follows the prefix in the first line that starts with it."""
    return F.substr(F.try_element_at(F.filter(lines, lambda x: x.startswith(prefix)), F.lit(1)), F.lit(len(prefix) + 1))


def is_sentence() -> Column:
    return F.col("value").startswith("# text = ")


def paragraph_numbers() -> Column:
    """Of a document's lines, the number of paragraph lines up to and including each."""
    w = Window.partitionBy("file", "doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(F.when(F.col("value").startswith("# <p>") | F.col("value").startswith("# <p "), 1).otherwise(0)).over(w)


def in_order(rows: Column, value: str) -> Column:
    """The values of a group's structs, nulls left out, in the structs' order."""
    return F.transform(F.array_sort(F.collect_list(rows)), lambda x: x[value])


def parsed_corpus(lines: DataFrame, collection: str = "corpus") -> DataFrame:
    """(id, text, register, lex_ppl, delex_ppl, attributes) of '# <doc', '# <p>' and '# text = ' lines.

    Sentences of a paragraph are joined by a space, paragraphs by a blank line; empty ones are left out.
    """
    marked = segments(lines, F.col("value").startswith("# <doc "))
    sentence = F.when(is_sentence(), F.struct("pos", F.substr("value", F.lit(10)).alias("s")))
    other = F.when(F.col("value").startswith("# ") & ~is_sentence(), F.struct("pos", F.col("value").alias("v")))
    pars = marked.withColumn("par", paragraph_numbers()).groupBy("file", "doc", "par").agg(in_order(sentence, "s").alias("sent"), F.array_sort(F.collect_list(other)).alias("head"))
    docs = pars.groupBy("file", "doc").agg(
        in_order(F.when(F.size("sent") > 0, F.struct("par", F.array_join("sent", " ").alias("s"))), "s").alias("pars"), F.array_sort(F.flatten(F.collect_list("head"))).alias("head")
    )
    docs = docs.withColumn("head", F.transform("head", lambda x: x["v"]))
    text = F.array_join(F.filter("pars", lambda p: p != ""), "\n\n")
    attrs = attributes(F.try_element_at("head", F.lit(1)))
    named = F.coalesce(attrs["id"], attrs["urn"], F.concat_ws(":", attrs["collection"], attrs["url"]))
    return docs.select(
        F.concat(F.lit(f"{collection}:"), named).alias("id"), text.alias("text"), first_after(F.col("head"), "# predicted register: ").alias("register"),
        first_after(F.col("head"), "# lex_lm_mean_perplexity: ").cast("double").alias("lex_ppl"), first_after(F.col("head"), "# delex_lm_mean_perplexity: ").cast("double").alias("delex_ppl"),
        attrs.alias("attributes"),
    )


def plain_corpus(lines: DataFrame) -> DataFrame:
    """(id, text, attributes) of the same lines, closed by '# </doc>' only: documents that aren't closed, or that
    have no paragraph line, don't count; ids have no prefix, and are ERROR where attributes are missing."""
    marked = segments(lines, F.col("value").startswith("# <doc "))
    end = F.min(F.when(F.col("value").startswith("# </doc>"), F.col("pos"))).over(Window.partitionBy("file", "doc"))
    inside = marked.withColumn("end", end).where("pos < end")
    starts = inside.where(F.col("value").startswith("# <p>") | F.col("value").startswith("# <p ")).select("file", "doc").distinct()
    inside = inside.join(starts, ["file", "doc"], "left_semi")
    sentence = F.when(is_sentence(), F.struct("pos", F.substr("value", F.lit(10)).alias("s")))
    pars = inside.withColumn("par", paragraph_numbers()).groupBy("file", "doc", "par").agg(F.min_by("value", "pos").alias("first"), in_order(sentence, "s").alias("sent"))
    docs = pars.groupBy("file", "doc").agg(F.min_by("first", "par").alias("head"), in_order(F.when(F.size("sent") > 0, F.struct("par", F.array_join("sent", " ").alias("s"))), "s").alias("pars"))
    text = F.array_join("pars", "\n\n")
    attrs = attributes(F.col("head"))
    both = F.when(attrs["collection"].isNotNull() & attrs["url"].isNotNull(), F.concat_ws(":", attrs["collection"], attrs["url"]))
    return docs.select(F.coalesce(attrs["id"], attrs["urn"], both, F.lit("ERROR")).alias("id"), text.alias("text"), attrs.alias("attributes"))


def corpus_blocks(lines: DataFrame) -> DataFrame:
    """(file, doc, register, lex_ppl, delex_ppl, block): documents of a parsed corpus as they are, all their lines,
    with what register_filter() looks at."""
    marked = segments(lines, F.col("value").startswith("# <doc "))
    docs = marked.groupBy("file", "doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("l"))
    return docs.select(
        "file", "doc", first_after(F.col("l"), "# predicted register: ").alias("register"), first_after(F.col("l"), "# lex_lm_mean_perplexity: ").cast("double").alias("lex_ppl"),
        first_after(F.col("l"), "# delex_lm_mean_perplexity: ").cast("double").alias("delex_ppl"), F.array_join("l", "\n").alias("block"),
    )


def start_element_id(line: Column, prefix: str = "s24") -> Column:
    """The prefix and the MD5 of a start line as a closed XML element: attributes in their order, references and
    characters beyond ASCII as XML writes them."""
    escape = lambda v: F.replace(F.replace(F.replace(F.replace(v, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    references = lambda v: replaced(v, r"[^\x00-\x7F]", lambda c: F.concat(F.lit("&#"), F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10), F.lit(";")))
    written = F.transform(attribute_pairs(line), lambda p: F.concat(F.lit(" "), p["name"], F.lit('="'), references(escape(resolved(p["value"]))), F.lit('"')))
    name = F.regexp_extract(line, "^<([A-Za-z]+)", 1)
    return F.concat(F.lit(f"{prefix}:"), F.md5(F.concat(F.lit("<"), name, F.array_join(written, ""), F.lit(" />")).cast("binary")))


def vrt_documents(lines: DataFrame, prefix: str = "s24") -> DataFrame:
    """(id, text, attributes) of <text ...> elements of one token a line: word first, white space marks ninth.

    Comment lines and the start and end lines of paragraphs and sentences are left out; a text that isn't closed,
    too. Words' &lt; &gt; &amp; are resolved, then white space is put in order.
    """
    marked = segments(lines.where(~F.col("value").startswith("<!-- ")), F.col("value").startswith("<text "))
    fields = F.split("value", "\t")
    token = F.when(~F.col("value").rlike("^</?(?:text|paragraph|sentence)[ >]"), F.struct("pos", T.unescape_markup(fields[0]).alias("word"), F.coalesce(F.get(fields, 8), F.lit("_")).alias("spaces")))
    docs = marked.groupBy("file", "doc").agg(F.min_by("value", "pos").alias("head"), F.array_sort(F.collect_list(token)).alias("t"), F.max(F.col("value").startswith("</text>")).alias("closed"))
    tokens = F.transform("t", lambda x: F.struct(x["word"], x["spaces"]))
    return docs.where("closed").select(start_element_id(F.col("head"), prefix).alias("id"), T.corpus_spaces(token_text(tokens)).alias("text"), attributes(F.col("head")).alias("attributes"))


def encyclopedia(lines: DataFrame, prefix: str = "wiki") -> DataFrame:
    """(id, text, url) of <doc id="" url="" title=""> ... </doc> frames; the id is made of the title."""
    marked = segments(lines, F.col("value").startswith("<doc "))
    body = F.when(~F.col("value").startswith("<doc ") & (F.col("value") != "</doc>"), F.struct("pos", "value"))
    docs = marked.groupBy("file", "doc").agg(F.min_by("value", "pos").alias("head"), F.array_sort(F.collect_list(body)).alias("body"))
    head = lambda k: F.regexp_extract("head", '^<doc id="(.*)" url="(.*)" title="(.*)">', k)
    text = F.array_join(F.transform("body", lambda x: x["value"]), "\n")
    return docs.select(F.concat(F.lit(f"{prefix}:"), head(3)).alias("id"), T.wiki_spaces(text).alias("text"), head(2).alias("url"))


def forum_posts(raw: DataFrame, value: str = "value", subreddit: str | None = None) -> DataFrame:
    """(id, title, body, forum, bad) of JSON lines; unreadable ones are kept with bad true, for counting. With a
    subreddit only its posts: those without one, and unreadable lines, go."""
    fields = "id string, subreddit string, title string, body string, selftext string"
    rows = raw.withColumn("j", F.from_json(value, fields + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("j").isNull() | F.col("j._corrupt").isNotNull()
    out = rows.select(F.col("j.id").alias("id"), F.col("j.title").alias("title"), F.coalesce("j.body", "j.selftext").alias("body"), F.col("j.subreddit").alias("forum"), bad.alias("bad"), *[c for c in raw.columns if c != value])
    return out.where(~F.col("bad") & (F.col("forum") == subreddit)) if subreddit else out


#: Bodies of posts that are gone.
DELETED = ["[deleted]", "[removed]"]


def post_outcomes(posts: DataFrame, order: str, subreddit: str | None = None) -> DataFrame:
    """posts with ``outcome``: bad, other-forum, duplicate, deleted or output. The first post of an id by the order
    counts, so one that is deleted hides later copies. Values of the order are all different."""
    mine = ~F.col("bad") & (F.lit(True) if subreddit is None else F.coalesce(F.col("forum") == subreddit, F.lit(False)))
    others = posts.where(~mine).withColumn("outcome", F.when(F.col("bad"), "bad").otherwise("other-forum"))
    # posts without an id are copies of one another; the first of an id is found by an aggregate, not by sorting all of them
    own = posts.where(mine).withColumn("__key", F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")))
    ids = materialize(own.groupBy("__key").agg(F.min(order).alias("__first"), F.count("*").alias("n")), "posts")
    rows = spread_join(own, ids.select("__key", "__first"), "__key", ids.select("__key", "n"), order, "left")
    outcome = F.when(F.col(order) != F.col("__first"), "duplicate").when(F.col("body").isin(*DELETED), "deleted").otherwise("output")
    return rows.withColumn("outcome", outcome).select(*posts.columns, "outcome").unionByName(others)


def post_counts(outcomes: DataFrame, by: list[str]) -> DataFrame:
    """(..., total, in_forum, duplicates, deleted, output): the counters of a conversion by file."""
    n = lambda condition, name: F.count_if(condition).alias(name)
    o = F.col("outcome")
    return outcomes.groupBy(*by).agg(F.count("*").alias("total"), n(~o.isin("bad", "other-forum"), "in_forum"), n(o == "duplicate", "duplicates"), n(o == "deleted", "deleted"), n(o == "output", "output"))


def post_documents(outcomes: DataFrame, prefix: str = "reddit") -> DataFrame:
    """(id, text, forum) of the posts that count: title and body as running text."""
    return outcomes.where("outcome = 'output'").select(F.concat(F.lit(f"{prefix}:"), "id").alias("id"), post_text("title", "body").alias("text"), "forum")


def numbered_words(lines: DataFrame, content: str = "content") -> DataFrame:
    """(number, word, outcome) of byte lines '<blanks>digits word': outcome is word, bad-number, or undecodable for
    words that aren't UTF-8. The word keeps its leading blank."""
    # bytes as characters of one byte each, so that the number can be cut off whatever follows it
    chars = F.decode(F.regexp_replace(F.decode(content, "ISO-8859-1"), "\n$", "").cast("binary"), "UTF-8")
    number, rest = F.regexp_extract(chars, "^[ \t]*([0-9]+)(?s)(.+)$", 1), F.regexp_extract(chars, "^[ \t]*([0-9]+)(?s)(.+)$", 2)
    word = F.try_validate_utf8(F.encode(rest, "ISO-8859-1").cast("string"))
    outcome = F.when(number == "", "bad-number").when(word.isNull(), "undecodable").otherwise("word")
    return lines.select(F.when(number != "", number.cast("bigint")).alias("number"), F.when(number != "", word).alias("word"), outcome.alias("outcome"))


def word_frequencies(lines: DataFrame, value: str = "value") -> DataFrame:
    """(word, freq) of 'freq word word ...' lines: every word of a line gets its number; other lines are skipped."""
    parts = F.filter(F.split(value, f"[{T.P.SPACES}]+"), lambda x: x != "")
    rows = lines.select(F.try_element_at(parts, F.lit(1)).alias("n"), F.slice(parts, 2, 1_000_000).alias("words")).where(F.col("n").rlike("^[0-9]+$"))
    return rows.select(F.col("n").cast("bigint").alias("n"), F.explode("words").alias("word")).groupBy("word").agg(F.sum("n").alias("freq"))


def token_text(tokens: Column) -> Column:
    """Words with the white space that their 'k=v|k=v' marks name: SpacesBefore, the word, then SpacesAfter,
    nothing for SpaceAfter=No, else a space. tokens: array<struct<word, spaces>>."""

    def piece(t):
        marks = F.str_to_map(t["spaces"], F.lit("\\|"), F.lit("="))
        after = F.when(marks["SpacesAfter"].isNotNull(), unescape_space(marks["SpacesAfter"])).when(marks["SpaceAfter"] == "No", "").otherwise(" ")
        return F.concat(F.coalesce(unescape_space(marks["SpacesBefore"]), F.lit("")), t["word"], after)

    return F.array_join(F.transform(tokens, piece), "")


def unescape_space(s: Column) -> Column:
    """Written-out white space; what follows something unknown is dropped."""
    known = F.regexp_extract(s, "^(?:\\\\n|\\\\t|\\\\s|[\\x{A0}\\x{2002}-\\x{200A}\\x{202F}\\x{3000}])*", 0)
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(known, "\\\\n", "\n"), "\\\\t", "\t"), "\\\\s", " ")
    return F.translate(plain, "           　", " " * 12)


def log_rates(lines: DataFrame, value: str = "value") -> DataFrame:
    """(flops) of 'FLOPS per GPU = 12.3 TFLOPS' lines, by the unit's prefix."""
    scale = F.create_map(*[F.lit(x) for k, p in enumerate("kMGTPEZY", 1) for x in (p, 1000.0**k)])
    n, p = F.regexp_extract(value, "FLOPS.*?([0-9.]+) ([kMGTPEZY])FLOPS", 1), F.regexp_extract(value, "FLOPS.*?([0-9.]+) ([kMGTPEZY])FLOPS", 2)
    return lines.where(p != "").select((n.cast("double") * scale[p]).alias("flops"))


def log_timers(lines: DataFrame, names: list[str], value: str = "value") -> DataFrame:
    """(timer, ms): every ' name: number' of every line."""
    def found(name: str) -> Column:
        return F.transform(F.regexp_extract_all(value, F.lit(rf" {name}: ([0-9.]+)"), F.lit(1)), lambda x: F.struct(F.lit(name).alias("timer"), x.cast("double").alias("ms")))

    hits = F.concat(*map(found, names))
    return lines.select(F.explode(hits).alias("h")).select("h.timer", "h.ms")
