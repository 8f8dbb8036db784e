import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import least_reachable
from trajspark.llm.components import components, merged

SCHEMA = "a long, b long"


def found(spark, links):
    out = {r.node: r.root for r in components(spark.createDataFrame(links, SCHEMA)).collect()}
    nodes = {n for link in links for n in link if n is not None}
    return {n: out.get(n, n) for n in nodes}


def test_shapes(spark):
    draw = random.Random(3)
    chain = [(k, k + 1) for k in range(40)]
    star = [(1000, 1001 + k) for k in range(60)]
    web = [(draw.randrange(2000, 2080), draw.randrange(2000, 2080)) for _ in range(60)]
    links = chain + star + web + [(-5, -(1 << 62)), (7, 7), (3, 4), (4, 3)]
    draw.shuffle(links)
    nodes = {n for link in links for n in link}
    assert found(spark, links) == least_reachable(nodes, links)


def test_nothing_and_nulls(spark):
    assert found(spark, []) == {}
    assert found(spark, [(None, 1), (2, None), (5, 5)]) == {1: 1, 2: 2, 5: 5}


def test_one_column_order(spark):
    links = spark.range(50).select(F.lit(99).cast("long").alias("a"), F.col("id").alias("b"))
    assert {r.root for r in components(links).collect()} == {0}


def test_merged_labels():
    draw = np.random.default_rng(1)
    for n in (2, 30, 200):
        i, j = draw.integers(0, n, n // 2), draw.integers(0, n, n // 2)
        wanted = least_reachable(range(n), zip(i.tolist(), j.tolist()))
        assert merged(np.arange(n), i, j).tolist() == [wanted[k] for k in range(n)]
