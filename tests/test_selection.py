"""Selection and numbering against a sort in Python."""

import random

import pytest
from pyspark.sql import functions as F

from trajspark.operators import selection as S


def in_order(key):
    return tuple((v is not None, v if v is not None else 0) for v in key)


@pytest.fixture(scope="module")
def data():
    draw = random.Random(1)
    rows = [(draw.choice(["a", "b", "é", "漢", None]), draw.choice([None, 1.0, 2.0, 3.0, draw.random()]),
             draw.randrange(50)) for _ in range(900)] + [("hot", 1.0, 7)] * 450
    draw.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "s string, x double, n int").repartition(5).cache()


@pytest.mark.parametrize("n", [1, 2, 450, 700, 800, 900, 1000, 1349, 1350])
def test_nth_key(frame, data, monkeypatch, n):
    monkeypatch.setattr(S, "SMALL", 20)
    monkeypatch.setattr(S, "DIRECT", 1)
    monkeypatch.setattr(S, "DRAWN", 24)
    keys = sorted((tuple(r) for r in data), key=in_order)
    assert tuple(S.nth_key(frame, n, ["s", "x", "n"])) == keys[n - 1]


def test_nth_key_by_the_shortcuts(frame, data):
    keys = sorted(((r[0], r[2]) for r in data), key=in_order)
    for n in (1, 90, 700):
        assert tuple(S.nth_key(frame, n, ["s", "n"])) == keys[n - 1]
    assert S.nth_key(frame, 1351, ["s"]) is None
    assert S.nth_key(frame.limit(0), 1, ["s"]) is None


def test_no_sort_of_all_keys(frame, monkeypatch):
    """What is sorted is what was drawn, and at last a small rest."""
    sorted_rows, plain = [], S._drawn

    def drawn(*a):
        out = plain(*a)
        sorted_rows.append(len(out))
        return out
    monkeypatch.setattr(S, "_drawn", drawn)
    monkeypatch.setattr(S, "SMALL", 50)
    monkeypatch.setattr(S, "DRAWN", 40)
    S.nth_key(frame, 333, ["s", "x", "n"])
    assert sorted_rows and max(sorted_rows) < 120


@pytest.mark.parametrize("size", [7, 100, 10**6])
def test_dense_numbers(frame, data, size):
    found = S.dense_numbers(frame.withColumn("m", F.create_map("n", "x")), ["s", "x", "n"], "k", size)
    rows = sorted(((r.k, (r.s, r.x, r.n)) for r in found.collect()), key=lambda r: r[0])
    assert [k for k, _ in rows] == list(range(1350))
    assert [r for _, r in rows] == sorted((tuple(r) for r in data), key=in_order)


def test_numbers_do_not_depend_on_tasks(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") * 37 % 1000).alias("k"), F.col("id").alias("payload"))
    first = S.dense_numbers(rows.repartition(3), ["k"], "n", 300)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and plan.count("Range (0, 5000") == 1
    wanted = sorted(first.collect())
    assert sorted(S.dense_numbers(rows.repartition(7), ["k"], "n", 50).collect()) == wanted
    assert [r.n for r in sorted(wanted, key=lambda r: r.n)] == list(range(5000))


def test_empty_and_one(spark):
    none = spark.createDataFrame([], "k long, v string")
    assert S.dense_numbers(none, ["k"]).count() == 0
    one = spark.createDataFrame([(None, "x")], "k long, v string")
    assert S.dense_numbers(one, ["k"]).first().conversation_id == 0
