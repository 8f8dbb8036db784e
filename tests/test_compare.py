import json

import pytest
from pyspark.sql import functions as F

from trajspark.operators import compare as C, quality as Q, usage as U
from trajspark.plans import jobs as J
from trajspark.settings import MODELS, Model

RATES = {"cheap": Model("e", True, 1.0, 0.0), "dear": Model("e", False, 4.0, 1.0),
         "twin": Model("e", True, 1.0, 0.0)}


def summary(spark, counts, models=RATES):
    """counts: {model: (conversations, text tokens each)} in input order."""
    rows = [(m, t, 0, 2) for m, (n, t) in counts.items() for _ in range(n)]
    usage = spark.createDataFrame(rows, "model string, text_tokens long, image_tokens long, "
                                        "image_count long")
    out = U.usage_totals(usage, models, output_tokens=100)
    place = F.coalesce(*[F.when(F.col("model") == m, i) for i, m in enumerate(counts)])
    return out.withColumn("input_ord", place.cast("long"))


def test_matrices_and_tables(spark):
    results = summary(spark, {"dear": (2, 1500), "cheap": (4, 500)})
    tokens = {r.metric: (r.dear, r.cheap) for r in C.token_matrix(results).collect()}
    assert list(tokens) == [m for m, _ in C.TOKEN_METRICS]
    assert tokens["Conversations"] == (2, 4) and tokens["Total Text Tokens"] == (3000, 2000)
    assert tokens["Total Tokens"] == (3200, 2400) and tokens["Total Images"] == (4, 8)
    shown = {r.metric: r.dear for r in C.token_matrix(results, ["dear"], True).collect()}
    assert shown["Total Tokens"] == "3,200"
    averages = {r.metric: r.dear for r in C.average_matrix(results, formatted=True).collect()}
    assert averages["Avg Text Tokens"] == "1500.0" and averages["Avg Images"] == "2.0"
    price = {r.model: r for r in C.price_table(results, True).collect()}["dear"]
    assert (price.input_rate, price.total_cost, price.cost_per_conv) == (
        "$4.00/1M", "$0.01", "$0.0061")
    feature = {r.model: r for r in C.feature_table(results, True).collect()}["dear"]
    assert (feature.vision_support, feature.input_price) == ("No", "$4.00")


def test_rank_is_stable(spark):
    results = summary(spark, {"twin": (1, 500), "dear": (1, 500), "cheap": (1, 500)})
    assert [(r.rank, r.model) for r in C.cost_rank(results).collect()] == [
        (1, "twin"), (2, "cheap"), (3, "dear")]


def test_multiplier_below_one(spark):
    """Cheapest means lowest total, though the multiplier is per conversation."""
    results = summary(spark, {"cheap": (1, 8000), "twin": (100, 1000)})
    got = {r.model: r.multiplier for r in C.cost_multipliers(results).collect()}
    assert got["cheap"] == 1.0 and got["twin"] == pytest.approx(0.125)
    text = {r.model: r.multiplier for r in C.cost_multipliers(results, True).collect()}
    assert text["cheap"] == "1.00x"


def hand(spark, rows):
    return spark.createDataFrame(rows, "model string, total_conversations long, "
                                       "total_cost double, input_ord long")


@pytest.mark.parametrize("rows,want", [
    ([("a", 0, 0.0, 0), ("b", 2, 6.0, 1)], {"a": 0.0, "b": 3.0}),    # divisor becomes 1
    ([("a", 5, 0.0, 0), ("b", 2, 6.0, 1)], {"a": 0.0, "b": 0.0}),    # cheapest is free
    ([("a", 1, 2.0, 0), ("b", 0, 6.0, 1)], {"a": 1.0, "b": 0.0}),    # no conversations
    ([("a", 1, 2.0, 0)], {}),                                        # nothing to compare
])
def test_multiplier_guards(spark, rows, want):
    got = {r.model: r.multiplier for r in C.cost_multipliers(hand(spark, rows)).collect()}
    assert got == want


def test_vs_cheapest_total(spark):
    """Published totals of the corpus, to the precision they were printed with."""
    published = {"a": (14.54, 1.0), "b": (240.68, 16.55), "c": (288.41, 19.83),
                 "d": (913.85, 62.84), "e": (761.41, 52.36)}
    rows = [(m, 2596, cost, 0) for m, (cost, _) in published.items()]
    for r in C.total_multipliers(hand(spark, rows)).collect():
        assert r.vs_cheapest == pytest.approx(published[r.model][1], abs=0.011)


def test_last_result_set_wins_in_first_place(spark):
    one = summary(spark, {"cheap": (1, 1), "dear": (1, 1)})
    two = summary(spark, {"cheap": (3, 7)})
    rows = C.combine(one, two).orderBy("input_ord", "model").collect()
    assert [(r.model, r.total_conversations) for r in rows] == [("cheap", 3), ("dear", 1)]


def test_report_lines(spark):
    results = summary(spark, {"dear": (1234, 1500)})
    lines = {r.label: r.value for r in C.summary_report(results).collect()}
    assert lines["Conversations processed"] == "1,234"
    assert lines["Avg Text Tokens"] == "1500.0" and lines["Vision support"] == "No"
    assert lines["Input cost"] == "$7.40"


def test_comparison_bundle(spark):
    results = summary(spark, {"dear": (1, 5), "cheap": (1, 5)})
    tables = J.comparison(results)
    assert {k: v.count() for k, v in tables.items()} == {
        "tokens": 7, "averages": 6, "pricing": 2, "features": 2, "rank": 2, "multipliers": 2}


def test_unknown_models(spark):
    asked = spark.createDataFrame([("gpt-4o",), ("o9",), ("o9",), (None,)], "model string")
    rows = Q.unknown_models(asked, MODELS).collect()
    assert [(r.model, r.requests) for r in rows] == [("o9", 2)]
    assert "gpt-5-mini" in json.dumps(rows[0].supported)
