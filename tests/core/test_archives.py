"""Archives read in many ranges give what one stream gives, whatever their records hold."""

import gzip
import random
import zlib

import pytest
from corpuskiln.sources import archives, files
from pyspark.sql import functions as F


def record(number, body, kind="conversion", eol=b"\r\n\r\n"):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <r{number}>\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + eol


def stored(data):
    """A gzip member that holds the bytes as they are."""
    squeeze = zlib.compressobj(0, wbits=31)
    return squeeze.compress(data) + squeeze.flush()


def bodies(n, seed=3):
    """Bodies of all kinds: empty, noise, text, longer than several ranges, and whole archives."""
    rng = random.Random(seed)
    inner = b"".join(gzip.compress(record(f"x{k}", rng.randbytes(300))) for k in range(40))
    plain = b"\n" + b"".join(record(f"y{k}", rng.randbytes(300)) for k in range(40))
    marks = b"WARC/1.0\r\nContent-Length: 99999999999999999999999\r\n\r\n" + archives.GZIP * 300 + b"\nWARC/1.0\r\nContent-Length: -5\r\n\r\n\nWARC/\r\nContent-Length: x\r\n\r\n"
    kinds = [b"", b"text \xff\n" * 40, inner, plain, marks, archives.GZIP, bytes(5000)]
    return [kinds[k % len(kinds)] if k % 2 else rng.randbytes(rng.randrange(20_000 if k % 10 == 0 else 900)) for k in range(n)]


def shapes(parts):
    whole = b"".join(parts)
    cuts = [whole[k : k + 1777] for k in range(0, len(whole), 1777)]
    return {
        "members": b"".join(map(gzip.compress, parts)), "stored": b"".join(map(stored, parts)), "padded": b"".join(gzip.compress(p) + bytes(k % 700) for k, p in enumerate(parts)),
        "pairs": b"".join(gzip.compress(b"".join(parts[k : k + 2])) for k in range(0, len(parts), 2)), "one": gzip.compress(whole), "cut": b"".join(map(gzip.compress, cuts)), "plain": whole,
    }


@pytest.mark.parametrize("size", [2000, 10**9])
def test_ranges_give_what_one_stream_gives(spark, tmp_path, size, monkeypatch):
    monkeypatch.setattr(archives, "PIECE", 512)
    texts = bodies(40)
    want = sorted((f"{k}", t) for k, t in enumerate(texts))
    index_rows = {}
    for name, data in shapes([record(k, t) for k, t in enumerate(texts)]).items():
        (tmp_path / f"{name}.gz").write_bytes(data)
    (tmp_path / "empty.gz").write_bytes(b"")
    index = archives.archive_index(spark, str(tmp_path), range_bytes=size)
    rows = index.orderBy("file", "block").collect()
    for r in rows:
        index_rows.setdefault(r["file"].rpartition("/")[2], []).append((r["first"], r["end"]))
    assert "empty.gz" not in index_rows and len(index_rows) == 7
    for name, spans in index_rows.items():
        assert spans[0][0] == 0 and spans[-1][1] == (tmp_path / name).stat().st_size
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))  # every byte is in one range
    if size < 10**9:
        assert len(index_rows["stored.gz"]) > 10 and len(index_rows["members.gz"]) > 5 and len(index_rows["plain.gz"]) > 10
        assert len(index_rows["one.gz"]) == 1
    for name in index_rows:
        found = files.web_records(spark, str(tmp_path), index=index.where(F.col("file").endswith("/" + name)))
        got = sorted((r["record_id"][1:], bytes(r["payload"])) for r in found.select("record_id", "payload").collect())
        assert got == want, name


def test_a_task_holds_its_own_records(spark, tmp_path):
    parts = [gzip.compress(record(k, random.Random(k).randbytes(2000))) for k in range(100)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts))
    index = archives.archive_index(spark, str(tmp_path), range_bytes=8000)
    found = files.web_records(spark, str(tmp_path), index=index).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in found) == 100 and len(found) > 8 and max(r["count"] for r in found) < 30


@pytest.mark.parametrize("cut", [5, 3000])
def test_damaged_archives_fail(spark, tmp_path, cut):
    data = b"".join(gzip.compress(record(k, random.Random(k).randbytes(2000))) for k in range(10))
    (tmp_path / "a.warc.gz").write_bytes(data[:-5] if cut == 5 else data[:cut] + b"damage" + data[cut + 6 :])
    with pytest.raises(Exception, match="inside a member|Error -3"):
        archives.archive_index(spark, str(tmp_path), range_bytes=4000)


def test_no_files(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(b"")
    assert files.web_records(spark, str(tmp_path)).collect() == []
