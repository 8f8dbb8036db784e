import math
import random

import numpy as np
import pytest

from tests.llm.helpers import SMALL, least_reachable, rows
from trajspark.llm import embeddings, queries

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ("vec_id", "n_links", "component_id", "kept")


def usable(vector, label):
    return label is not None and vector is not None and len(vector) and all(
        x is not None and math.isfinite(x) for x in vector) and any(vector)


def slow(data, threshold=0.98):
    links, count = [], [0] * len(data)
    for p, (_, a, la) in enumerate(data):
        for q in range(p):
            _, b, lb = data[q]
            if usable(a, la) and usable(b, lb) and la == lb and len(a) == len(b):
                x, y = (np.array(v, np.float32).astype(float) for v in (a, b))
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                    links.append((p, q))
                    count[p] += 1
                    count[q] += 1
    roots, out = least_reachable(range(len(data)), links), []
    for p, (i, _, _) in enumerate(data):
        ids = [data[q][0] for q in roots if roots[q] == roots[p] and data[q][0] is not None]
        least = min(ids, default=None)
        out.append((i, count[p], least, i is not None and i == least))
    return sorted(out, key=repr)


def corpus():
    draw = np.random.default_rng(6)
    data = []
    for group in range(12):
        center = draw.normal(size=16)
        for k in range(6):
            v = center + draw.normal(size=16) * draw.choice([0.0, 0.05, 0.2])
            data.append((1000 - len(data), (v * draw.choice([1, 7])).tolist(), group % 3))
    one = data[0][1]
    nan, inf = float("nan"), float("inf")
    return data + [
        (2, one, 1), (1, one, None), (3, None, 0), (4, [0.0] * 16, 0), (5, one[:8], 0),
        (6, [nan] + one[1:], 0), (7, [inf] + one[1:], 0), (8, [None] + one[1:], 0), (9, [], 0),
        (10, one, 0), (10, one, 0), (None, one, 0), (11, [-x for x in one], 0),
        (12, [1e-30] * 16, 2), (13, [1e30] * 16, 2), (14, [-0.0] * 15 + [1.0], 2),
        (15, [0.0] * 15 + [1.0], 2)]


@pytest.mark.parametrize("tile", [3, 2048])
def test_cases(spark, tile):
    data = corpus()
    frame = spark.createDataFrame(data, SCHEMA).selectExpr(
        "*", "vec_id AS node", "vec_id AS h1", "vec_id AS least", "vec_id AS ok")
    assert rows(embeddings.embedding_dedup(frame, tile=tile), *COLUMNS) == slow(data)


@pytest.mark.parametrize("tile", [5, 2048])
def test_pairs_in_doubt(spark, tile):
    """A fan whose neighbours are a hair to both sides of the threshold: the codes decide none of
    these, so every link of them comes from the second pass."""
    draw, angle = random.Random(3), math.acos(0.98)
    turns = [0.0]
    for _ in range(40):
        turns.append(turns[-1] + angle * (1 + draw.choice([-1e-3, -1e-4, 1e-4, 1e-3])))
    data = [(500 - k, [math.cos(t), math.sin(t), 0.0], k // 30) for k, t in enumerate(turns)]
    data += data[:3]
    vectors = np.array([v for _, v, _ in data[:30]])
    codes = embeddings.quantised(vectors)
    pairs = [(i, j) for a, b, sure in embeddings.by_bounds(codes, codes, 0.98, True)
             for i, j, known in zip(a, b, sure) if not known]
    assert {(k, k + 1) for k in range(29)} <= set(pairs)
    wanted = slow(data)
    assert 10 < sum(row[1] > 0 for row in wanted) < len(data)
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    assert rows(embeddings.embedding_dedup(frame, tile=tile), *COLUMNS) == wanted


def test_whole_table(spark):
    data = [(r.vec_id, r.embedding, r.label)
            for r in queries.table(spark, SMALL, "embeddings").collect()]
    assert rows(queries.op8_embedding_dedup(spark, SMALL), *COLUMNS) == slow(data)
    other = embeddings.embedding_dedup(queries.table(spark, SMALL, "embeddings"), 0.3, 64)
    assert rows(other, *COLUMNS) == slow(data, 0.3)


def test_twin_in_sql():
    """The twin on rows with links, copies and unusable vectors; the given tables have no links."""
    import duckdb
    import pyarrow as pa
    data = corpus()
    con = duckdb.connect()
    con.register("embeddings", pa.table({
        "vec_id": pa.array([d[0] for d in data], pa.int64()),
        "embedding": pa.array([d[1] for d in data], pa.list_(pa.float32())),
        "label": pa.array([d[2] for d in data], pa.int32())}))
    columns = ", ".join(COLUMNS)
    got = con.execute(f"SELECT {columns} FROM ({embeddings.ORACLE_SQL})").fetchall()
    assert sorted(got, key=repr) == slow(data) and sum(r[1] for r in got) > 50


def test_empty_table(spark):
    assert embeddings.embedding_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bounds_hold():
    draw = np.random.default_rng(2)
    for scale in (1, 1e-20, 1e15):
        x, y = draw.normal(size=(60, 24)) * scale, draw.normal(size=(60, 24))
        (a, sa, la, oa), (b, sb, lb, ob) = embeddings.quantised(x), embeddings.quantised(y)
        about = (a.astype(float) @ b.astype(float).T) * np.outer(sa, sb)
        bound = np.outer(oa, lb + ob) + np.outer(la, ob) + 1e-12
        exact = (x @ y.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1))
        assert (np.abs(about - exact) <= bound).all() and bound.max() < 0.05


def test_pairs_around_the_threshold():
    """Angles a hair to both sides of the threshold are told apart."""
    angle = math.acos(0.98)
    turns = [angle * (1 + d) for d in (-1e-3, -1e-9, 1e-9, 1e-3)]
    left = np.array([[1.0, 0.0]])
    right = np.array([[math.cos(t), math.sin(t)] for t in turns])
    assert embeddings.tile_links(left, right)[1].tolist() == [0, 1]
