"""Dictionary-compressed WARC archives.

A Zstandard dictionary is trained on a bounded sample of the records to be archived (the
DICT_SAMPLE payloads with the smallest hashes, DICT_CHARS characters of each). Every archive starts
with that dictionary in a skippable frame; each record is a frame of its own, so any record can be
read alone given its offset. Tasks write archives through Arrow's file systems into the shared
folder, first under a name of their own and then by a rename, so that a lost or repeated task
leaves one whole file; the files that count are those whose names the tasks returned.

Of records with equal payloads of at least REVISIT_BYTES bytes the one with the largest id is the
response and the others are revisits without a payload, which refer to it.

Defined cases: a null payload is an empty one; payloads under REVISIT_BYTES are always responses;
ids are unique and not null (rows that repeat an id and its payload are each written); a null target
is left out of the headers; of equal payloads the largest id's is the response; a very long payload is
one record and takes some five times its bytes in the task that writes or reads it; an empty table gives no
archives and an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskiln.llm.common import materialize, shared_dir, spread_join, table

REVISIT_BYTES = 1000
DICT_SAMPLE, DICT_CHARS, DICT_BYTES = 1000, 16_000, 112_640
#: Compressed bytes from which a task starts its next archive.
ARCHIVE_BYTES = 32_000_000
# fixed value: magic number of the skippable frame that holds a dictionary
DICT_MAGIC = 0x184D2A5D
VERSION = "WARC/1.1"
#: The reader takes over the lengths of full payloads by this header, which revisits carry too.
LENGTH_HEADER = "X-Payload-Length"


def train(samples: list[bytes]) -> bytes:
    """A dictionary, or an empty one where there is too little to learn from."""
    samples = [s for s in samples if len(s) >= 8]
    if len(samples) < 8:
        return b""
    size = min(DICT_BYTES, max(1024, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def record(fields: dict[str, str], payload: bytes) -> bytes:
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + f"Content-Length: {len(payload)}\r\n\r\n"
    return head.encode("utf-8") + payload + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def record_id(number) -> str:
    """A stable URN for a row's id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{number}')}>"


def sha1_label(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def file_system(where: str):
    """(file system, path) of a folder given as path or URI; Arrow names s3a s3."""
    from pyarrow import fs

    where = "s3://" + where[6:] if where.startswith("s3a://") else where
    return fs.FileSystem.from_uri(where if "://" in where or where.startswith("file:/") else "file://" + where)


class Archive:
    """One archive file being written."""

    def __init__(self, where: str, name: str, dictionary: bytes):
        self.system, root = file_system(where)
        self.system.create_dir(root, recursive=True)
        self.name, self.final = name, f"{root}/{name}"
        self.draft = f"{root}/.{uuid.uuid4().hex}.part"
        self.out = self.system.open_output_stream(self.draft, compression=None)
        self.size = self.records = 0
        if dictionary:
            self.write(struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary)
        self.squeeze = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def add(self, raw: bytes) -> None:
        self.write(self.squeeze.compress(raw))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        self.system.move(self.draft, self.final)
        return self.name, self.records, self.size


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of every record of an archive's bytes."""
    at, dictionary = 0, None
    while at < len(content):
        magic, size = struct.unpack_from("<II", content, at) if at + 8 <= len(content) else (0, 0)
        if 0x184D2A50 <= magic <= 0x184D2A5F:
            if magic == DICT_MAGIC and at == 0:
                dictionary = zstandard.ZstdCompressionDict(content[8 : 8 + size])
            at += 8 + size
            continue
        unpack, raw = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj(), []
        while not unpack.eof:
            piece = content[at : at + 32_768]
            if not piece:
                raise ValueError("archive ends inside a record")
            raw.append(unpack.decompress(piece))
            at += len(piece)
        at -= len(unpack.unused_data)
        yield parse(b"".join(raw))


def decide(pages: DataFrame, id_col: str, payload_col: str, url_col: str | None) -> DataFrame:
    """(id, url, payload, digest, refers_to): refers_to is the response's id for revisits.

    Payloads are told apart by SHA-256; SHA-1 is what the records are labelled with.
    """
    rows = pages.select(F.col(id_col).alias("id"), (F.col(url_col) if url_col else F.lit(None).cast("string")).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2(F.encode("payload", "UTF-8"), 256)))
    groups = rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("key").agg(F.max("id").alias("top"), F.min("id").alias("low"), F.count("*").alias("n")).where("low < top")
    groups = materialize(groups.select("key", "top", "n"), "equal-payloads")
    both = spread_join(rows, groups.select("key", "top"), "key", groups.select("key", "n"), "id", "left")
    return both.select("id", "url", "payload", F.sha1(F.encode("payload", "UTF-8")).alias("digest"), F.when(F.col("top") > F.col("id"), F.col("top")).alias("refers_to"))


def write_archives(pages: DataFrame, where: str, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write one record a row into archives below the folder; returns (file, records, bytes), a row a file."""
    rows = decide(pages, id_col, payload_col, url_col)
    filled = pages.where(F.length(payload_col) > 0).select(F.col(id_col).alias("i"), F.col(payload_col).alias("t"))
    ids = filled.select(F.col("i").alias("j")).orderBy(F.xxhash64("j"), "j").limit(DICT_SAMPLE)
    sample = filled.join(F.broadcast(ids), filled["i"] == ids["j"], "left_semi").select("i", F.substring("t", 1, DICT_CHARS)).limit(DICT_SAMPLE)
    samples = [record({"WARC-Type": "response", "WARC-Record-ID": record_id(r[0])}, r[1].encode("utf-8")) for r in sorted(sample.collect(), key=str)]
    shared = pages.sparkSession.sparkContext.broadcast(train(samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, archive, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for number, url, payload, digest, refers in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "refers_to")), strict=True):
                if archive is None:
                    archive = Archive(where, f"records-{part:06d}-{len(done):04d}-{uuid.uuid4().hex[:8]}.warc.zst", shared.value)
                body = payload.encode("utf-8")
                fields = {"WARC-Type": "revisit" if refers is not None else "response", "WARC-Record-ID": record_id(number), "WARC-Date": date}
                if url is not None:
                    fields["WARC-Target-URI"] = " ".join(url.split())
                fields |= {"WARC-Payload-Digest": sha1_label(digest), "X-Record-Number": str(number), LENGTH_HEADER: str(len(body))}
                if refers is not None:
                    fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": record_id(refers), "X-Refers-To-Number": str(refers)}
                archive.add(record(fields, b"" if refers is not None else body))
                if archive.size >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["file", "records", "bytes"])

    return materialize(rows.mapInArrow(run, "file string, records bigint, bytes bigint"), "archive-list")


def read_archives(spark: SparkSession, where: str, files: DataFrame | None = None) -> DataFrame:
    """(number, record_type, target, payload, payload_sha1, payload_bytes, named_sha1, named_bytes, refers_to).

    files: the (file) rows that a writer returned; what a failed task may have left is then not read.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(where)
    if files is not None:
        wanted = files.select(F.col("file").alias("__file"))
        found = found.join(wanted, F.element_at(F.split("path", "/"), -1) == F.col("__file"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for fields, payload in records_of(content.as_py()):
                    kind = fields["WARC-Type"]
                    label = fields.get("WARC-Payload-Digest", "sha1:").partition(":")[2]
                    held.append((
                        fields.get("X-Record-Number"), kind, fields.get("WARC-Target-URI"), payload, hashlib.sha1(payload).hexdigest(), len(payload),
                        base64.b32decode(label).hex(), int(fields.get(LENGTH_HEADER, len(payload))), fields.get("X-Refers-To-Number"),
                    ))
                    size += len(payload)
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), READ, strict=True)], schema=READ)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), READ, strict=True)], schema=READ)

    return found.select("content").mapInArrow(run, "number string, record_type string, target string, payload binary, payload_sha1 string, payload_bytes bigint, named_sha1 string, named_bytes bigint, refers_to string")


READ = pa.schema([
    ("number", pa.string()), ("record_type", pa.string()), ("target", pa.string()), ("payload", pa.binary()), ("payload_sha1", pa.string()),
    ("payload_bytes", pa.int64()), ("named_sha1", pa.string()), ("named_bytes", pa.int64()), ("refers_to", pa.string()),
])


def round_trip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str | None = "url") -> DataFrame:
    """Write the pages, read the archives back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    A revisit's length and digest are those read from its response's payload.
    """
    spark = pages.sparkSession
    where = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    files = write_archives(pages, where, id_col, payload_col, url_col)
    kind = dict(pages.dtypes)[id_col]
    schema = f"page_id {kind}, payload_bytes bigint, payload_digest string, record_type string, refers_to {kind}"
    if not files.limit(1).count():
        return spark.createDataFrame([], schema)
    found = read_archives(spark, where, files).drop("payload", "target", "named_bytes", "named_sha1")
    found = materialize(found.withColumn("page_id", F.col("number").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind)), "read-back")
    plain = found.where("record_type <> 'revisit'").select("page_id", "payload_bytes", F.col("payload_sha1").alias("payload_digest"), "record_type", "refers_to")
    again = found.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to")
    sources = plain.select(F.col("page_id").alias("source"), "payload_bytes", "payload_digest").dropDuplicates(["source"])
    again = again.withColumn("source", F.col("refers_to"))
    sizes = materialize(again.groupBy("source").agg(F.count("*").alias("n")), "revisits")
    sources = sources.join(sizes.select("source"), "source", "left_semi")
    again = spread_join(again, sources, "source", sizes, "page_id").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return plain.union(again)


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """The contract query: all pages."""
    return round_trip(table(spark, sf_dir, "pages"))


OP3_SQL = """
with p as (
  select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as payload_bytes from pages
), t as (
  select *, sha1(html) as payload_digest, max(page_id) over (partition by html) as top from p
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and top > page_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and top > page_id then top end as refers_to
from t
"""
