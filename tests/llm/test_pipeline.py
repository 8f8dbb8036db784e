import pytest

import corpus_pipeline
from __spark_entry__ import LLM_ORACLE, LLM_QUERIES
from tests.llm.helpers import MIDDLE
from tests.llm.test_line_dedup import slow as slow_lines
from tests.llm.test_simhash import slow_components
from trajspark.llm import toxicity
from trajspark.llm.common import stored


@pytest.fixture(scope="module")
def results(spark):
    """What every stage gets and returns, each written and read again."""
    docs, out = spark.read.parquet(f"{MIDDLE}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        got = stored(stage(spark, docs, MIDDLE))
        out.append((name, docs, got))
        docs = got
    return out


def texts(frame):
    return sorted((r.doc_id, r.text) for r in frame.collect())


def test_stages(results):
    assert len(results) == 5
    columns = results[0][1].columns
    assert all(got.columns == columns for _, _, got in results[:-1])


def test_toxicity_against_its_scores(spark, results):
    _, docs, got = results[0]
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    scores = toxicity.toxicity(docs, labels)
    assert {r.doc_id for r in got.collect()} == {
        r.doc_id for r in scores.filter("predicted = 0").collect()}
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in got.collect()}
    known = {r.doc_id for r in labels.collect()}
    assert len(gone & toxic) > 0.75 * len(toxic & {r.doc_id for r in docs.collect()})
    assert len(gone & known - toxic) < 0.1 * len(gone & known)


def test_lines_against_every_earlier_line(results):
    _, docs, got = results[1]
    small = docs.filter("doc_id < 150")
    wanted = {}
    source = dict(texts(small))
    for doc_id, count, n, lost in slow_lines(list(source.items())):
        lost = {int(k) for k in lost.split(",") if k}
        if n < count or not count:
            wanted[doc_id] = "\n".join(s for k, s in enumerate(source[doc_id].split("\n"))
                                       if k not in lost)
    # The first documents of the order do not depend on later ones.
    assert {i: t for i, t in texts(got) if i < 150} == wanted
    assert all(r.n_chars == len(r.text) for r in got.collect())


def test_simhash_against_all_pairs(results):
    _, docs, got = results[2]
    wanted = {c for _, _, c in slow_components(texts(docs))}
    assert [i for i, _ in texts(got)] == sorted(wanted)
    assert set(texts(got)) <= set(texts(docs))


def test_mix_near_targets(results):
    from tests.llm.test_mixing import slow_targets
    _, docs, got = results[3]
    words = lambda t: len((t or "").encode().split())
    sizes, taken, longest = {}, {}, {}
    for frame, into in ((docs, sizes), (got, taken)):
        for r in frame.collect():
            into[r.source] = into.get(r.source, 0) + words(r.text)
            longest[r.source] = max(longest.get(r.source, 0), words(r.text))
    for source, target in slow_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= longest[source]
    assert set(texts(got)) <= set(texts(docs))


def test_ids_decode_to_the_mix(results):
    from trajspark.llm import unigram
    _, docs, got = results[4]
    assert texts(unigram.detokenized(got)) == texts(docs)


def test_run_is_the_stages(spark, results):
    got = corpus_pipeline.run(spark, MIDDLE)
    key = lambda f: sorted((r.doc_id, list(r.ids)) for r in f.collect())
    assert key(got) == key(results[-1][2])


def test_registered():
    assert LLM_QUERIES["pipeline"] is corpus_pipeline.run
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in LLM_QUERIES) == 1
    assert set(LLM_ORACLE) <= set(LLM_QUERIES)
