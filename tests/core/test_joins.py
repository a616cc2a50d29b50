"""Running sums and carried values against plain loops, over ranges that keys cross."""

import random

from corpuskiln.operators import joins, packing, relations
from pyspark.sql import functions as F


def test_running_sum_with_outliers_nulls_and_ties(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.randrange(5), rnd.randrange(9)) for i in range(400)] + [(10**15, 1, 3), (None, 2, 4)]
    df = spark.createDataFrame(rows, "i long, f long, n long").repartition(6)
    total, expected = 0, {}
    for i, _, n in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        expected[i] = total
        total += n
    assert {r["i"]: r["offset"] for r in packing.with_offsets(df, "i", "n").collect()} == expected
    total, expected = 0, {}
    for i, f, n in sorted([r for r in rows if r[0] is not None], key=lambda r: (-r[1], -r[0])):
        expected[i] = total
        total += n
    got = joins.running_sum(df.where("i is not null"), [F.desc("f"), F.desc("i")], "n", "before")
    assert {r["i"]: r["before"] for r in got.collect()} == expected
    assert packing.with_offsets(df.limit(0), "i", "n").collect() == []


def test_the_last_value_is_carried_across_ranges(spark):
    rnd = random.Random(4)
    rows = [(k, p, rnd.choice([None, None, f"v{k}-{p}"])) for k in (None, 0, 1, 1, 1, 2) for p in rnd.sample(range(1000), 120)]
    rows = [(k, 10 * p + n, v) for n, (k, p, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k long, p long, v string").repartition(5)
    last, expected = {}, {}
    for k, p, v in sorted(rows, key=lambda r: r[1]):
        last[k] = v or last.get(k)
        expected[p] = last[k]
    assert {r["p"]: r["was"] for r in joins.carried(df, ["k"], ["p"], "v", "was").collect()} == expected


def test_inverse_distribution_of_equal_and_null_draws(spark):
    table = relations.frequency_table(spark.createDataFrame([("ja", 6), ("on", 3), ("auto", 3), ("talo", 1)], "word string, freq long"))
    draws = spark.createDataFrame([(i, u) for i, u in enumerate([0.0, 0.46, 0.47, 0.9, 1.0, None, 0.47])], "i int, u double")
    assert {r["i"]: r["word"] for r in relations.inverse_distribution(draws, table).collect()} == {0: "ja", 1: "ja", 2: "on", 3: "auto", 4: "talo", 5: None, 6: "on"}
