import math
import zlib

import numpy as np
import pytest

from tests.llm.helpers import documents
from trajspark.llm import queries, toxicity

LARGE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    return queries.op5_toxicity(spark, LARGE).toPandas()


def test_held_out_accuracy(spark, scored):
    labels = queries.table(spark, LARGE, "labels").toPandas()
    rows = scored.merge(labels, on="doc_id")
    rows = rows[rows["held_out"]]
    hit = rows[rows["predicted"] == 1]
    assert len(rows) > 1000
    assert hit["toxic"].mean() > 0.93
    assert hit["toxic"].sum() / rows["toxic"].sum() > 0.85
    assert rows[rows["toxic"] == 1]["score"].median() > 0.9
    assert rows[rows["toxic"] == 0]["score"].median() < 0.1


def test_shape(spark, scored):
    assert len(scored) == queries.table(spark, LARGE, "documents").count()
    assert scored["score"].between(0, 1).all()
    assert (scored["predicted"] == (scored["score"] >= 0.7)).all()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1
                                   for i in scored["doc_id"]]).all()


def corpus(spark, extra=""):
    """Toxic texts hold two words with one beginning, of a language no list knows."""
    clean = [(k, f"calm{k % 7} walk{k} near the old town {k}", "s") for k in range(200)]
    toxic = [(1000 + k, f"calm{k % 5} grobix{k} walk{k} grobix{k + 1} town", "s")
             for k in range(60)]
    odd = [(5000, None, None), (5001, "", "s"), (5001, "", "s"), (None, "you idiot", "s"),
           (5002, ("word " * 10 + "grobixa grobixb ") * 5_000, "s")]
    docs = documents(spark, clean + toxic + odd, extra)
    labels = [(i, int(i >= 1000)) for i, _, _ in clean + toxic]
    return docs, labels


def test_learns_beginnings_and_ignores_held_out_labels(spark):
    docs, labels = corpus(spark, "toxic score predicted held_out known")
    schema = "doc_id long, toxic int, doc int"
    table = spark.createDataFrame([(i, t, 1) for i, t in labels]
                                  + [(1, None, 1), (None, 1, 1), (7, 0, 1)], schema)
    got = toxicity.toxicity(docs, table).toPandas()
    assert len(got) == 265
    score = got.groupby("doc_id", dropna=False)["score"].max()
    assert min(score[i] for i, t in labels if t) > 0.7 > max(score[i] for i, t in labels if not t)
    assert score[5002] > 0.7 > score[5000] == score[5001]
    flipped = spark.createDataFrame([(i, 1 - t if toxicity.is_held_out(i) else t, 1)
                                     for i, t in labels], schema)
    other = toxicity.toxicity(docs, flipped).toPandas()
    assert np.array_equal(np.sort(other["score"]), np.sort(got["score"]))
    kept = toxicity.clean(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in labels if not t} | {
        5000, 5001, *([None] if score[np.nan] < 0.7 else [])}


def test_without_labels_or_documents(spark):
    docs, labels = corpus(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, none).collect()}
    assert got[None] == 1 and got[0] == 0
    empty = documents(spark, [])
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.toxicity(empty, table).count() == 0
    assert toxicity.toxicity(empty, none).count() == 0
    clean_only = spark.createDataFrame([(i, 0) for i, t in labels if not t],
                                       "doc_id long, toxic int")
    assert toxicity.toxicity(docs, clean_only).count() == 265


def test_label_model_discounts_copies():
    """Ten copies of one voter count like one: two voters that agree outweigh them."""
    draw = np.random.default_rng(0)
    y = draw.random(4000) < 0.3
    vote = lambda hit, false: np.where(y, draw.random(4000) < hit,
                                       draw.random(4000) < false).astype(float)
    noisy = vote(0.5, 0.3)
    good = [vote(0.9, 0.05), vote(0.9, 0.05), vote(0.9, 0.05)]
    votes = np.column_stack([noisy] * 10 + good)
    start = np.where(draw.random(4000) < 0.1, ~y, y).astype(float)
    post, (hit, false) = toxicity.label_model(votes, start, 0.3)
    assert ((post > 0.5) == y).mean() > 0.97
    # One given label in ten is wrong, which the model finds out.
    assert abs(hit - start[y].mean()) < 0.02 and abs(false - start[~y].mean()) < 0.02


def slow_label_model(votes, label, prior, rounds):
    """The estimation row by row and voter by voter."""
    n, m = len(votes), len(votes[0])
    mean = [sum(v[k] for v in votes) / n for k in range(m)]
    post, hit, false = [float(x) for x in label], toxicity.TRUST, 1 - toxicity.TRUST
    more = toxicity.BELIEF
    for turn in range(rounds):
        bad, good = sum(post), n - sum(post)
        p1 = [(sum(p * v[k] for p, v in zip(post, votes)) + mean[k]) / (bad + 1) for k in range(m)]
        p0 = [(sum((1 - p) * v[k] for p, v in zip(post, votes)) + mean[k]) / (good + 1)
              for k in range(m)]
        if turn:
            hit = (sum(p * x for p, x in zip(post, label)) + more * toxicity.TRUST) / (bad + more)
            false = (sum((1 - p) * x for p, x in zip(post, label))
                     + more * (1 - toxicity.TRUST)) / (good + more)
        rest = [[v[k] - p * p1[k] - (1 - p) * p0[k] for k in range(m)]
                for p, v in zip(post, votes)]
        spread = [math.sqrt(sum(r[k] ** 2 for r in rest) / n) + 1e-6 for k in range(m)]
        weight = []
        for j in range(m):
            near = [sum(r[j] * r[k] for r in rest) / n / spread[j] / spread[k] for k in range(m)]
            weight.append(1 / (1 + sum(c for k, c in enumerate(near) if k != j and c >= 0.1)))
        post = []
        for v, x in zip(votes, label):
            odds = math.log(prior / (1 - prior))
            odds += math.log(hit / false) if x else math.log((1 - hit) / (1 - false))
            for k in range(m):
                a, b = (min(max(p[k], 1e-4), 1 - 1e-4) for p in (p1, p0))
                odds += weight[k] * (math.log(a / b) if v[k] else math.log((1 - a) / (1 - b)))
            post.append(1 / (1 + math.exp(-min(max(odds, -30), 30))))
    return post, hit, false


@pytest.mark.parametrize("seed", range(4))
def test_label_model_by_definition(seed):
    draw = np.random.default_rng(seed)
    y = draw.random(80) < 0.35
    votes = (draw.random((80, 5)) < np.where(y[:, None], 0.7, 0.2)).astype(float)
    votes[:, 4] = votes[:, 0]
    label = np.where(draw.random(80) < 0.15, ~y, y).astype(float)
    for rounds in (1, 2, 6):
        post, rates = toxicity.label_model(votes, label, 0.35, rounds)
        slow, *slow_rates = slow_label_model(votes.tolist(), label.tolist(), 0.35, rounds)
        # Estimation that stops early is within its own last step.
        assert np.allclose(post, slow, atol=1e-3) and np.allclose(rates, slow_rates, atol=1e-3)


def test_lexicons_and_patterns_vote():
    voters = toxicity.Voters([])
    said = lambda text: {toxicity.VOTERS[k] for k in voters(text)[0]}
    assert said("an Idiot!") >= {"insult", "no stem"} and "no insult" not in said("an Idiot!")
    assert "threat" in said("they will kill, it says") and "profane" in said("oh, shit happens")
    assert "contempt" in said("mere VERMIN.") and "masked" in said("an id*ot")
    assert "drawn out" in said("nooooo way") and "drawn out" not in said("1111 aaa")
    assert said("") == said("a calm walk") == {"no stem", "no insult"}


def test_logistic_regression():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(20_000, 2))
    y = (draw.random(20_000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    weights, base = toxicity.logistic(x, y, 1e-3)
    assert np.abs(np.append(weights, base) - [2, -1, 0.5]).max() < 0.1


def test_many_different_hits_take_linear_time():
    import time
    voters = toxicity.Voters([("idio", 1), ("nothing$", 2)])
    text = " ".join(f"idio{chr(97 + k % 26)}_{k}" for k in range(40_000))
    start = time.time()
    ids, hits, _ = voters(f"{text} {text} idio$ idio$")
    assert time.time() - start < 5 and hits == 80_002 and len(toxicity.VOTERS) in ids
    assert voters("idio_1 idio_1 x")[1] == 2
