"""Framed files in many tasks give what one task gives, and hot keys meet in no task."""

import gzip
import random

import pytest
from corpuskiln.operators import joins
from corpuskiln.sources import framing
from pyspark.sql import functions as F


@pytest.fixture
def blocks(spark, monkeypatch):
    """Files are cut into blocks of 2000 bytes, ranges hold some 100 lines."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    monkeypatch.setattr(joins, "RANGE_ROWS", 100)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def corpus(seed, n):
    """Lines of a parsed corpus, and its documents as (id, text)."""
    rng = random.Random(seed)
    lines, docs = ["# stray line", "# text = before any document"], []
    for i in range(n):
        lines.append(f'# <doc id="{seed}-{i}">')
        pars = []
        for _ in range(rng.randrange(0, 4)):
            lines.append("# <p>")
            pars.append([])
            for k in range(rng.randrange(0, 5)):
                s = f"s{i} {k} " + "ä€x"[rng.randrange(3)] * rng.randrange(1, 60)
                lines += [f"# text = {s}", "1\tword\t_", ""]
                pars[-1].append(s)
        lines.append("# </doc>")
        docs.append((f"corpus:{seed}-{i}", "\n\n".join(" ".join(p) for p in pars if p)))
    return lines, docs


@pytest.fixture
def folder(tmp_path):
    made, texts = {}, {}
    for k, n in enumerate((60, 3, 0)):
        lines, docs = corpus(k, n)
        texts[f"f{k}.txt"] = lines
        (tmp_path / f"f{k}.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
        made |= dict(docs)
    lines, docs = corpus(9, 20)
    texts["f9.gz"] = lines
    (tmp_path / "f9.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    made |= dict(docs)
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "x.txt").write_text("only\r\nthis")
    return str(tmp_path), texts, made


def test_lines_of_blocks_are_numbered_through(spark, blocks, folder):
    path, texts, _ = folder
    lines = framing.read_lines(spark, path)
    got = {}
    for r in lines.orderBy("file", "pos").collect():
        got.setdefault(r["file"].rpartition("/")[2], []).append((r["pos"], r["value"]))
    want = texts | {"x.txt": ["only\r", "this"]}
    assert got == {f: list(enumerate(x)) for f, x in want.items() if x}
    cut = spark.read.text(path + "/f0.txt")
    assert cut.rdd.getNumPartitions() > 5  # one file, many tasks
    assert {r["file"].rpartition("/")[2] for r in framing.read_lines(spark, path, "*.txt", recursive=False).collect()} == {"f0.txt", "f1.txt", "f2.txt"}


def test_documents_over_ranges_equal_those_of_one_task(spark, blocks, folder):
    path, _, made = folder
    found = framing.parsed_corpus(framing.read_lines(spark, path))
    assert {r["id"]: r["text"] for r in found.collect()} == made
    marked = framing.segments(framing.read_lines(spark, path, "f0.txt"), F.col("value").startswith("# <doc "))
    assert marked.agg(F.max("doc"), F.min("doc"), F.countDistinct("doc")).first()[:] == (60, 1, 60)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(file" not in plan  # no file meets in one task


def test_order_within_paragraphs_and_documents(spark):
    lines = ['# <doc id="a">', "# predicted register: NA", "# <p>", "# text = 1", "# text = 2", "# predicted register: IN", "# <p>", "# <p>", "# text = 3"]
    rows = [("f", i, v) for i, v in enumerate(lines)]
    random.Random(1).shuffle(rows)
    r = framing.parsed_corpus(spark.createDataFrame(rows, "file string, pos long, value string")).first()
    assert (r["text"], r["register"]) == ("1 2\n\n3", "NA")


def test_a_document_of_many_paragraphs(spark):
    """Sentences are joined by paragraph, so the work is not paragraphs times sentences."""
    n = 20_000
    lines = spark.range(2 * n + 1).selectExpr("'f' as file", "id as pos", """case when id = 0 then '# <doc id="a">' when id % 2 = 1 then '# <p>' else concat('# text = ', id) end as value""")
    for found in (framing.parsed_corpus(lines), framing.plain_corpus(lines.union(spark.createDataFrame([("f", 2 * n + 1, "# </doc>")], "file string, pos long, value string")))):
        text = found.first()["text"]
        assert text.split("\n\n") == [str(2 * i + 2) for i in range(n)]


def test_most_posts_are_others_or_of_one_id(spark):
    """Posts of other forums get their outcome without a shuffle, and a hot id is not sorted in one task."""
    rows = spark.range(30_000).selectExpr("id as n", "if(id % 3 = 0, 'same', if(id % 3 = 1, null, cast(id as string))) as id", "if(id % 5 < 2, 's', 'other') as forum", "'t' as title", "'b' as body", "id % 7 = 0 as bad")
    got = framing.post_outcomes(rows, "n", "s")
    want, seen = {}, set()
    for r in rows.orderBy("n").collect():
        o = "bad" if r["bad"] else "other-forum" if r["forum"] != "s" else "duplicate" if r["id"] in seen else "output"
        if o in ("output", "duplicate"):
            seen.add(r["id"])
        want[r["n"]] = o
    assert {r["n"]: r["outcome"] for r in got.collect()} == want
    assert got.columns == [*rows.columns, "outcome"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort [" not in plan
