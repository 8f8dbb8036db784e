"""Totals by task summaries against the sum of the usage rows."""

import random

import pytest
from pyspark.sql import functions as F

from trajspark.functions.text import estimate_tokens
from trajspark.operators import summaries as Z, usage as U
from trajspark.plans import jobs as J
from trajspark.schemas import IMAGE_DIMS
from trajspark.settings import select_models

STEP = ("task_id string, pos long, index long, image string, observation string, thought string, "
        "action string, code string")
MODELS = select_models(["gpt-4o", "gpt-5-mini", "gpt-4o-mini"])


def failing(text):
    return F.when(~text.contains("bad"), estimate_tokens(text))


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(4)
    words = lambda: " ".join(draw.choice(["go", "12345", "é漢!", "a\nb"]) for _ in range(
        draw.randrange(1, 6)))
    lengths = {f"t{n}": n for n in (1, 2, 3, 4, 5, 6, 9, 14)} | {"long": 300, "lost": 4, "bad": 5}
    steps = [(t, p, p + 3 * (t == "t4"), f"{t}_{p % 7}.png" if t != "t9" else "hot.png", words(),
              words(), "bad" if (t, p) == ("bad", 3) else words(), words())
             for t, n in lengths.items() for p in range(n)]
    draw.shuffle(steps)
    heads = [(t, words(), "x" if k % 3 else None) for k, t in enumerate([*lengths, "idle"])
             if t != "lost"]
    sizes = [(f"{t}_{p}.png", draw.randrange(1, 4000), draw.randrange(1, 4000),
              draw.choice(["ok", "ok", "corrupt"])) for t in lengths for p in range(6)]
    sizes += [("hot.png", 3000, 1, "ok")]
    return (spark.createDataFrame(heads, "task_id string, instruction string, kind string"),
            spark.createDataFrame(steps, STEP).repartition(3), spark.createDataFrame(sizes, IMAGE_DIMS))


CHOICES = [dict(window=w, min_prefix=m, full_only=f, first_image=i)
           for w in (1, 2, 3, 5) for m in (0, 1, 4) for f in (False, True) for i in ("coded", "aligned")][::3]
COUNTS = ("total_conversations", "total_text_tokens", "total_image_tokens", "total_images",
          "total_cost")


def counts(totals, *by):
    return sorted((tuple(r) for r in totals.select(*by, "model", *COUNTS).collect()), key=repr)


@pytest.fixture(scope="module")
def usages(tables):
    """Usage rows of all prefixes by window and first image, once."""
    out = {}
    for w in (1, 2, 3, 5):
        for i in ("coded", "aligned"):
            rows = J.step_usage(*tables, models=MODELS, window=w, first_image=i, details=False,
                                keep=("kind",))
            out[w, i] = rows.toPandas()
    return out


@pytest.mark.parametrize("choice", CHOICES, ids=lambda c: "-".join(map(str, c.values())))
def test_totals_are_the_sum_of_usage_rows(tables, usages, choice):
    rows = usages[choice["window"], choice["first_image"]]
    rows = rows[rows.prefix_len > choice["min_prefix"]]
    if choice["full_only"]:
        rows = rows[rows.prefix_len == rows.groupby("task_id").prefix_len.transform("max")]
    wanted = rows.groupby("model").agg(
        total_conversations=("text_tokens", "size"), total_text_tokens=("text_tokens", "sum"),
        total_image_tokens=("image_tokens", "sum"), total_images=("image_count", "sum"))
    got = J.step_totals(*tables, models=MODELS, **choice).toPandas().set_index("model")
    assert got[wanted.columns].sort_index().equals(wanted.sort_index())


@pytest.mark.parametrize("choice", [{}, {"layout": "documented"}, {"level": "L3"},
                                    {"full_only": True, "min_prefix": 2}], ids=str)
def test_groups_and_counters_that_fail(tables, choice):
    failures = {"o200k_base": failing}
    usage = J.step_usage(*tables, models=MODELS, counters=failures, keep=("kind",), details=False,
                         **choice)
    wanted = counts(U.usage_totals(usage, MODELS, by=("kind",)), "kind")
    got = J.step_totals(*tables, models=MODELS, counters=failures, by=("kind",), **choice)
    assert counts(got, "kind") == wanted and len(wanted) == 6


def test_empty_tables(tables):
    heads, steps, sizes = tables
    for some in ((heads.limit(0), steps, sizes), (heads, steps.limit(0), sizes),
                 (heads.limit(0), steps.limit(0), sizes.limit(0))):
        assert J.step_totals(*some).count() == 0
    no_sizes = J.step_totals(heads, steps, sizes.limit(0)).collect()
    assert {r.total_image_tokens for r in no_sizes} == {0} and no_sizes[0].total_images > 0


def test_a_summary_per_task_and_place(spark, tables):
    """With adaptive execution off, steps are summed before they are shuffled by task, and tasks
    are joined with summaries only."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = J.step_totals(*tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = [line.lstrip(" :+-*()0123456789") for line in plan.splitlines()]
    shuffles = [k for k, line in enumerate(lines) if line.startswith("Exchange hashpartitioning(task_id")]
    below = [lines[k + 1] for k in shuffles]
    assert sum(line.startswith("HashAggregate(keys=[task_id") and "partial_max" in line
               for line in below) == 1
    assert all(line.startswith(("HashAggregate", "Project", "Filter")) for line in below)
    assert "SortAggregate" not in plan and "Window" not in plan
    assert not any("action" in line for k in shuffles for line in lines[k:k + 1])


def test_every_tile_count_has_a_class(spark):
    from trajspark.functions import images as I
    sides = [1, 2, 511, 512, 513, 767, 768, 769, 1024, 1025, 1536, 2047, 2048, 2049, 4096, 9000, 99999]
    rows = spark.createDataFrame([(f"{w}x{h}", w, h, "ok") for w in sides for h in sides], IMAGE_DIMS)
    classed = rows.withColumn("tile_tokens", I.tile_tokens()).select(
        "tile_tokens", F.expr(Z.CLASS).alias("c")).distinct().collect()
    assert all(Z.CLASSES[r.c] == ("ok", r.tile_tokens) for r in classed) and len(classed) > 5
    with pytest.raises(Exception, match="no image has so many tokens"):
        rows.selectExpr("'ok' AS status", "7L AS tile_tokens").select(F.expr(Z.CLASS)).collect()
