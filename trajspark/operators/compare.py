"""Model comparison on result summaries: one small row per model, whatever the corpus size.

Input is the flat summary of `usage_totals` / `corpus_totals` or of read result sets; `model`
is the label, `input_ord` its place in the input (added here when absent).
"""

from pyspark.sql import DataFrame, Window, functions as F

from trajspark.functions import display as D
from trajspark.settings import MODELS

# Metric labels of the two matrices, in report order.
TOKEN_METRICS = (
    ("Conversations", "total_conversations"),
    ("Total Text Tokens", "total_text_tokens"),
    ("Total Image Tokens", "total_image_tokens"),
    ("Total Input Tokens", "total_input_tokens"),
    ("Total Output Tokens", "total_output_tokens"),
    ("Total Tokens", "total_tokens"),
    ("Total Images", "total_images"),
)
AVERAGE_METRICS = (
    ("Avg Text Tokens", "avg_text_tokens"),
    ("Avg Image Tokens", "avg_image_tokens"),
    ("Avg Input Tokens", "avg_total_input_tokens"),
    ("Avg Output Tokens", "avg_output_tokens"),
    ("Avg Total Tokens", "avg_total_tokens"),
    ("Avg Images", "avg_images_per_conversation"),
)


def last_per_label(results: DataFrame, label="model", order="input_ord") -> DataFrame:
    """A repeated label keeps its last result set; an aggregate, so labels may be hot.

    The label keeps the place of its first appearance, as a dictionary would.
    """
    rest = [c for c in results.columns if c not in (label, order)]
    last = F.max_by(F.struct(*rest), F.col(order))
    return (results.groupBy(label).agg(F.min(order).alias(order), last.alias("_last"))
            .select(label, order, "_last.*"))


def combine(*results: DataFrame) -> DataFrame:
    """Union of result summaries in the given order; the last one wins per label."""
    placed = None
    for i, frame in enumerate(results):
        one = frame.drop("input_ord").withColumn("input_ord", F.lit(i).cast("long"))
        placed = one if placed is None else placed.unionByName(one)
    return last_per_label(placed)


def _matrix(results, metrics, kind, labels, shown):
    names = {c: n for n, c in metrics}
    place = {c: i for i, (_, c) in enumerate(metrics)}
    lookup = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    rank = F.create_map(*[F.lit(x) for kv in place.items() for x in kv])
    long = results.select("model", *[F.col(c).cast(kind).alias(c) for c in names]).unpivot(
        ["model"], list(names), "field", "value")
    if shown is not None:
        long = long.withColumn("value", shown(F.col("value")))
    wide = (long.groupBy(rank[F.col("field")].cast("long").alias("metric_ord"),
                         lookup[F.col("field")].alias("metric"))
            .pivot("model", labels).agg(F.first("value", ignorenulls=True)))
    return wide.orderBy("metric_ord")


def token_matrix(results: DataFrame, labels=None, formatted=False) -> DataFrame:
    """Seven token metrics by model. `labels` chooses the models (others are left out) and spares
    the job that finds them."""
    return _matrix(results, TOKEN_METRICS, "long", labels, D.counted if formatted else None)


def average_matrix(results: DataFrame, labels=None, formatted=False) -> DataFrame:
    """Six averages by model."""
    shown = (lambda x: D.decimals(x, 1)) if formatted else None
    return _matrix(results, AVERAGE_METRICS, "double", labels, shown)


def price_table(results: DataFrame, formatted=False) -> DataFrame:
    """Rates and costs, one row per model."""
    plain = {"input_rate": "input_price_per_1m", "output_rate": "output_price_per_1m",
             "input_cost": "total_input_cost", "output_cost": "total_output_cost",
             "total_cost": "total_cost", "cost_per_conv": "avg_cost_per_conversation"}
    form = {"input_rate": D.rate, "output_rate": D.rate,
            "cost_per_conv": lambda x: D.money(x, 4)}
    return results.select("model", *[
        (form.get(out, D.money)(F.col(src)) if formatted else F.col(src)).alias(out)
        for out, src in plain.items()])


def feature_table(results: DataFrame, formatted=False) -> DataFrame:
    """Encoding, vision and rates, one row per model."""
    price = D.money if formatted else (lambda x: x)
    return results.select(
        "model", "encoding", D.yes_no(F.col("supports_vision")).alias("vision_support"),
        price(F.col("input_price_per_1m")).alias("input_price"),
        price(F.col("output_price_per_1m")).alias("output_price"))


def _by_cost(results):
    if "input_ord" not in results.columns:
        # Totals come without a place; the published table gives its models theirs.
        place = F.coalesce(*[F.when(F.col("model") == m, F.lit(i))
                             for i, m in enumerate(MODELS)], F.lit(len(MODELS)))
        results = results.withColumn("input_ord", place.cast("long"))
    # One row per model, so the unpartitioned window holds the rate table at most.
    return results, Window.orderBy("total_cost", "input_ord", "model")


def cost_rank(results: DataFrame) -> DataFrame:
    """Models by total cost, cheapest first; ties keep the input order."""
    results, order = _by_cost(results)
    return results.select(
        F.row_number().over(order).cast("long").alias("rank"), "model", "total_cost",
        F.col("avg_cost_per_conversation").alias("cost_per_conv"),
        F.col("total_conversations").alias("conversations")).orderBy("rank")


def cost_multipliers(results: DataFrame, formatted=False) -> DataFrame:
    """Cost per conversation relative to the model with the lowest total cost.

    The reference model is picked by total, so a multiplier below 1 is possible. Nothing is
    returned for a single model.
    """
    results, order = _by_cost(results)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def each(cost, n, otherwise):
        return F.when(n > 0, F.try_divide(cost, n)).otherwise(F.lit(otherwise))
    cheapest = each(F.first("total_cost").over(whole),
                    F.first("total_conversations").over(whole), 1.0)
    own = each(F.col("total_cost"), F.col("total_conversations"), 0.0)
    times = F.when(cheapest > 0, F.try_divide(own, cheapest)).otherwise(F.lit(0.0))
    out = results.select(
        "model", F.first("model").over(whole).alias("cheapest_model"),
        times.alias("multiplier"), F.count(F.lit(1)).over(whole).alias("_models"),
        F.row_number().over(order).cast("long").alias("rank"))
    out = out.filter(F.col("_models") > 1).drop("_models")
    if formatted:
        out = out.withColumn("multiplier", D.times(F.col("multiplier")))
    return out.orderBy("rank")


def total_multipliers(results: DataFrame) -> DataFrame:
    """Total cost of the whole data set relative to the cheapest total."""
    lowest = F.min("total_cost").over(Window.partitionBy())
    return results.select("model", "total_cost",
                          F.try_divide(F.col("total_cost"), lowest).alias("vs_cheapest"))


def summary_report(results: DataFrame) -> DataFrame:
    """Printable lines per model: totals, averages and prices as text."""
    # Labels of the report, in its order.
    text = {"Conversations processed": D.counted(F.col("total_conversations"))}
    for label, name in (("Text tokens", "text_tokens"), ("Image tokens", "image_tokens"),
                        ("Total input tokens", "input_tokens"),
                        ("Total output tokens", "output_tokens"), ("Total tokens", "tokens"),
                        ("Total images", "images")):
        text[label] = D.counted(F.col(f"total_{name}"))
    for label, name in AVERAGE_METRICS:
        text[label] = D.decimals(F.col(name), 1)
    for label, name in (("Input cost", "total_input_cost"), ("Output cost", "total_output_cost"),
                        ("Total cost", "total_cost")):
        text[label] = D.money(F.col(name))
    text["Avg cost per conversation"] = D.money(F.col("avg_cost_per_conversation"), 4)
    text["Input rate"] = D.rate(F.col("input_price_per_1m"))
    text["Output rate"] = D.rate(F.col("output_price_per_1m"))
    text["Vision support"] = D.yes_no(F.col("supports_vision"))
    text["Image token multiplier"] = F.concat(F.col("image_token_multiplier").cast("string"),
                                              F.lit("x"))
    lines = F.array(*[F.struct(F.lit(i).alias("line"), F.lit(k).alias("label"),
                               v.alias("value")) for i, (k, v) in enumerate(text.items())])
    return results.select("model", F.inline(lines)).orderBy("model", "line")
