"""Whole-file and record sources, and sinks."""

from __future__ import annotations

import io
import json
import struct
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.functions.masking import replaced
from corpuskiln.sources import archives
from corpuskiln.sources.archives import opened


def jsonl(spark: SparkSession, path, schema: str = "id string, text string", tolerant: bool = False) -> DataFrame:
    """JSON lines by an explicit schema. Strict reading fails on a bad line; tolerant reading keeps it in
    _corrupt_record, so that it counts."""
    reader = spark.read.option("mode", "PERMISSIVE" if tolerant else "FAILFAST")
    return reader.schema(schema + (", _corrupt_record string" if tolerant else "")).json(path)


def text_documents(spark: SparkSession, path, recursive: bool = False) -> DataFrame:
    """(text): every line that isn't blank, of a file or of all files below a folder."""
    from corpuskiln.functions.text import is_blank

    found = spark.read.option("recursiveFileLookup", recursive).text(path)
    return found.withColumnRenamed("value", "text").where(~is_blank("text"))


def zst_lines(spark: SparkSession, path: str, glob: str = "*.zst") -> DataFrame:
    """(file, pos, value) of text files in Zstandard frames of any window up to 2**31 bytes, decompressed as a stream."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for file in (f for batch in batches for f in batch.column("path").to_pylist()):
            with opened(file) as packed:
                raw = zstandard.ZstdDecompressor(max_window_size=2**31).stream_reader(packed, read_across_frames=True)
                lines, size, pos = [], 0, 0
                for line in io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline="\n"):
                    lines.append(line.rstrip("\n"))
                    size += len(line)
                    if size > BATCH_BYTES:
                        yield lines_batch(file, pos, lines)
                        pos, lines, size = pos + len(lines), [], 0
                if lines:
                    yield lines_batch(file, pos, lines)

    return found.mapInArrow(run, "file string, pos bigint, value string")


def lines_batch(file: str, pos: int, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([file] * len(lines)), pa.array(range(pos, pos + len(lines)), pa.int64()), pa.array(lines)], names=["file", "pos", "value"])


#: Bytes of payload that a reader holds before it hands rows on.
BATCH_BYTES = 8_000_000
RECORD = pa.schema([(c, pa.string()) for c in ("record_id", "refers_to", "record_type", "uri", "date", "mime")] + [("length", pa.int64()), ("payload", pa.binary())])


def web_records(spark: SparkSession, path: str, types: tuple[str, ...] | None = ("response", "conversion"), glob: str = "*.gz", index: DataFrame | None = None) -> DataFrame:
    """(record_id, refers_to, record_type, uri, date, mime, length, payload) of gzip or plain web archives.

    Only the given record types, all if None; ids without their angle brackets; a response's payload is what
    follows its HTTP headers; length is what the record's header says. An archive is read in ranges of bytes, in a task
    each, by archive_index(), or an index that was made before; records are handed on as they come.
    """
    found = archives.archive_index(spark, path, glob) if index is None else index

    def row(fields: dict, body: bytes) -> tuple:
        inner = None
        if fields.get("warc-type") == "response" and body.startswith(b"HTTP/"):
            head, _, body = body.partition(b"\r\n\r\n")
            inner = next((x.split(":", 1)[1].strip() for x in head.decode("latin-1").split("\r\n") if x.lower().startswith("content-type:")), None)
        bare = lambda x: x[1:-1] if x and x[0] == "<" and x[-1] == ">" else x
        mime = fields.get("warc-identified-payload-type") or inner or fields.get("content-type")
        return bare(fields.get("warc-record-id")), bare(fields.get("warc-refers-to")), fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-date"), mime, int(fields.get("content-length") or 0), body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first, end in zip(*(batch.column(c).to_pylist() for c in ("file", "first", "end")), strict=True):
                with archives.opened(file) as raw:
                    rows, size = [], 0
                    for fields, body in archives.records_between(archives.Reader(raw, first, archives.is_packed(raw)), end):
                        if types is not None and fields.get("warc-type") not in types:
                            continue
                        rows.append(row(fields, body))
                        size += len(body)
                        if size > BATCH_BYTES or len(rows) == 10_000:
                            yield records_batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield records_batch(rows)

    columns = "record_id string, refers_to string, record_type string, uri string, date string, mime string, length bigint, payload binary"
    return archives.spread_ranges(found).mapInArrow(run, columns)


def records_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORD, strict=True)], schema=RECORD)


def newsml(spark: SparkSession, path: str, headline: bool = True, glob: str = "*.xml") -> DataFrame:
    """(id, paragraphs, meta map<string, array<string>>) of news items in XML, one a file."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    return files.select(news_item(F.col("value"), headline).alias("x")).select("x.*")


def news_item(xml: Column, headline: bool = True) -> Column:
    each = lambda values: pd.DataFrame([parse_news(v, headline) for v in values], columns=["id", "paragraphs", "meta"])
    return F.pandas_udf(each, "id string, paragraphs array<string>, meta map<string, array<string>>")(xml)


def parse_news(xml: str, headline: bool) -> tuple[str | None, list[str], dict[str, list[str]]]:
    root = ElementTree.fromstring(xml)
    for e in root.iter():
        e.tag = e.tag.rpartition("}")[2]
    meta: dict[str, list[str]] = {}
    for holder in root.iter("contentMeta"):
        for e in holder:
            value = " ".join("".join(e.itertext()).split())
            if value:
                meta.setdefault(e.tag, []).append(value)
    parts = [" ".join("".join(e.itertext()).split()) for body in root.iter("body") for e in body if e.tag in ("h1", "h2", "h3", "p")]
    parts = [p for p in parts if p]
    if headline and meta.get("headline"):
        parts = meta["headline"][:1] + parts
    return root.get("guid"), parts, meta


# fixed values: content types that carry no running text
IGNORED_CONTENT = [
    "image", "image-pair", "slideshow", "gallery", "infogram", "video", "audio", "youtube-video", "facebook-video", "vimeo-video",
    "elava-arkisto-video", "livefeed", "timeline", "some-posting", "flockler", "quote", "table", "interactive-table", "tehtava-exam",
    "tehtava-assignment", "tehtava-carousel", "survey", "external-content", "links", "undefined",
]


def content_text(node: dict) -> list[str]:
    """Paragraphs of a tree of content items: texts, lists and nested documents. An item of the wrong shape is left out."""
    out = []
    for item in (x for x in node.get("content") or [] if isinstance(x, dict)):
        kind = item.get("type")
        if kind in IGNORED_CONTENT:
            continue
        if kind == "bullet-list":
            out.append("\n".join(f"• {x}" for x in item.get("items") or []))
        elif kind == "numbered-list":
            out.append("\n".join(f"{i}. {x}" for i, x in enumerate(item.get("items") or [], 1)))
        elif "text" in item:
            out.append(item["text"])
        for inner in (item, *(item.get("pages") or []), *(x for x in item.get("items") or [] if isinstance(x, dict))):
            if isinstance(inner, dict) and "content" in inner:
                out += content_text(inner)
    return [p for p in out if isinstance(p, str) and p.strip()]


def news_json(raw: DataFrame, value: str = "value", prefix: str = "news") -> DataFrame:
    """(id, text, url, language) of {"data": [document, ...]} texts; the tree of a document is recursive,
    so its rendering is an Arrow-batched function over its JSON."""
    fields = "data array<string>"
    docs = raw.select(F.explode(F.from_json(value, fields)["data"]).alias("d"))
    render = F.pandas_udf(lambda s: pd.Series(["\n\n".join(content_text(read_tree(x))) for x in s]), "string")
    return docs.select(F.concat(F.lit(f"{prefix}:"), F.get_json_object("d", "$.id")).alias("id"), render("d").alias("text"), F.get_json_object("d", "$.url.full").alias("url"), F.get_json_object("d", "$.language").alias("language"))


def read_tree(text: str | None) -> dict:
    """A document's JSON; an empty one for what is not an object."""
    try:
        tree = json.loads(text or "")
    except ValueError:
        return {}
    return tree if isinstance(tree, dict) else {}


def news_files(spark: SparkSession, path: str, prefix: str = "news", glob: str = "*.json") -> DataFrame:
    """news_json() of all JSON files below a folder."""
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    return news_json(found, "value", prefix)


def book_documents(spark: SparkSession, path: str, prefix: str = "book", glob: str = "*.txt") -> DataFrame:
    """(id, license, produced_by, text) of book files, one a file, named after it; UTF-8 or ISO-8859-1."""
    from corpuskiln.functions import news
    from corpuskiln.functions.unicode import decoded

    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "")
    rows = found.select(F.concat(F.lit(f"{prefix}:"), name).alias("id"), news.split_metadata(news.book_paragraphs(decoded("content"))).alias("m"))
    return rows.select("id", "m.license", "m.produced_by", F.translate(F.array_join("m.paragraphs", "\n\n"), "_", "").alias("text"))


def fixed_vectors(spark: SparkSession, path: str, columns: list[str], dim: int) -> DataFrame:
    """Rows of little-endian unsigned 16-bit vectors, one of dim numbers for each column."""
    width = 2 * dim * len(columns)
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                if len(data) % width:
                    raise ValueError("trailing data")
                rows = [struct.unpack_from(f"<{dim * len(columns)}H", data, at) for at in range(0, len(data), width)]
                yield pa.RecordBatch.from_arrays([pa.array([list(r[k * dim : (k + 1) * dim]) for r in rows], pa.list_(pa.int32())) for k in range(len(columns))], names=columns)

    return files.mapInArrow(run, ", ".join(f"{c} array<int>" for c in columns))


def write_jsonl(docs: DataFrame, path: str, sort_keys: bool = False, mode: str = "errorifexists") -> None:
    (docs.select(*sorted(docs.columns)) if sort_keys else docs).write.mode(mode).json(path)


def tsv_lines(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(value): id, a tab and the text as a JSON string."""
    quoted = F.regexp_extract(F.to_json(F.struct(F.col(text_col).alias("t"))), '^\\{"t":(.*)\\}$', 1)
    return docs.select(F.concat_ws("\t", id_col, quoted).alias("value"))


def readable(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(value): a dashed header with the id, then the text."""
    line = F.repeat(F.lit("-"), 10)
    return docs.select(F.concat(line, F.lit(" "), F.col(id_col), F.lit(" "), line, F.lit("\n"), F.col(text_col)).alias("value"))


def ascii_json(value: Column) -> Column:
    """JSON text with every character beyond ASCII written as \\uXXXX, by UTF-16 units."""
    units = lambda p: F.lower(F.regexp_replace(F.hex(F.encode(p, "UTF-16BE")), "(.{4})", r"\\u$1"))
    return replaced(value, r"[^\x00-\x7F]+", units)


def write_ascii_jsonl(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    docs.select(ascii_json(F.to_json(F.struct(*docs.columns))).alias("value")).write.mode(mode).text(path)
