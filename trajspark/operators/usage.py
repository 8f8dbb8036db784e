"""Token usage and price per conversation, totals and averages, for all models in one job."""

from pyspark.sql import DataFrame, functions as F

from trajspark import schemas as S
from trajspark.functions import images as I, text as X
from trajspark.operators.measure import prefix_shares, with_dims
from trajspark.operators.models import pricing, with_config, with_models
from trajspark.operators.tokens import (nested_text_tokens, per_encoding, tokens_by_conversation,
                                        tokens_column)
from trajspark.operators.selection import nth_key
from trajspark.operators.summaries import by_class
from trajspark.sources.lineage import cut_lineage
from trajspark.settings import MIN_PREFIX_INDEX, MODELS, OUTPUT_TOKENS, WINDOW

ROW_KEYS = ("task_id", "prefix_len")


def _priced(rows, keys, output_tokens):
    """Closing columns of a usage row; the model's rates are in scope."""
    rest = ["image_details"] if "image_details" in rows.columns else []
    total_input = "text_tokens + image_tokens"
    return rows.selectExpr(
        *keys, "model", "text_tokens", "image_tokens", "image_count",
        f"{total_input} AS total_input_tokens", f"{output_tokens}L AS output_tokens",
        f"{total_input} + {output_tokens}L AS total_tokens", *rest,
        f"{pricing(total_input, output_tokens)} AS pricing")


def usage_rows(sizes: DataFrame, models=None, counters=None, keys=ROW_KEYS, details=True,
               output_tokens=OUTPUT_TOKENS) -> DataFrame:
    """Usage per conversation and model from text_tokens_<i> and an `images` array."""
    models = MODELS if models is None else models
    one = I.billed("s.tile_tokens", "s.status")
    columns = [f"aggregate(images, 0L, (n, s) -> n + {one}) AS image_tokens",
               "CAST(size(images) AS BIGINT) AS image_count"]
    if details:
        columns.append(
            f"transform(images, s -> named_struct('path', s.path, 'tokens', {one}, "
            f"'base_tokens', {I.base_from_billed(f'({one})')}, "
            f"'multiplier', image_token_multiplier)) AS image_details")
    rows = with_models(sizes, models, counters=counters).selectExpr("*", *columns)
    return _priced(rows, keys, output_tokens)


def row_sizes(rows: DataFrame, image_dims: DataFrame, models=None, counters=None,
              keys=ROW_KEYS, most_images=None) -> DataFrame:
    """Sizes of ready-made training rows (messages, images), for `usage_rows`.

    Text is counted inside the row. Without `most_images` the images are looked up one by one and
    put back together per row; a group is no larger than the image list it came from. Rows are told
    apart by a number of their own, which is stored with the counts, so that rows with equal, null
    or no keys stay rows; `keys` are carried along and must exist. With `most_images` see
    `images_in_place`, which also serves a stream.
    """
    distinct, _ = per_encoding(MODELS if models is None else models, counters)
    texts = [tokens_column(i) for i in range(len(distinct))]
    counted = rows.select(
        *keys, "images",
        *[nested_text_tokens(F.col("messages"), c).alias(n) for c, n in zip(distinct, texts)])
    if most_images is not None:
        return images_in_place(counted, image_dims, most_images)
    counted = cut_lineage(counted.withColumn("_place", F.monotonically_increasing_id()))
    exploded = with_dims(
        counted.select(*keys, "_place", *texts,
                       F.posexplode_outer("images").alias("pos", "image")),
        image_dims)
    image = F.struct("pos", F.col("image").alias("path"), "tile_tokens", "status")
    return (exploded.groupBy("_place")
            .agg(*[F.first(n).alias(n) for n in (*keys, *texts)],
                 F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), image)))
                 .alias("images")).drop("_place"))


def images_in_place(rows: DataFrame, image_dims: DataFrame, most_images) -> DataFrame:
    """Rows whose `images`, paths, become (pos, path, tile_tokens, status), one lookup per place.

    No row is taken apart, so nothing is regrouped and nothing is remembered: on a stream each
    lookup joins the stream with the table of sizes. A row with more than `most_images` images
    fails the query. Paths must be unique in the table (`measure.flat_problems`).
    """
    size = F.size("images")
    rows = rows.withColumn("images", F.when(size > most_images, F.raise_error(F.concat(
        F.lit("a row has more images than most_images: "), size.cast("string"))).cast(
        "array<string>")).otherwise(F.col("images")))
    plain, found = rows.columns, []
    for k in range(most_images):
        rows = with_dims(rows.withColumn(f"_path_{k}", F.get("images", F.lit(k))), image_dims,
                         f"_path_{k}")
        rows = rows.withColumn(f"_image_{k}", F.struct(
            F.lit(k).alias("pos"), F.col(f"_path_{k}").alias("path"), "tile_tokens", "status"))
        found.append(f"_image_{k}")
        rows = rows.select(*plain, *found)
    images = F.slice(F.array(*found), F.lit(1), F.greatest(size, F.lit(0))) if found else F.array()
    return rows.withColumn("images", F.coalesce(images, F.array())).drop(*found)


def flat_usage(messages: DataFrame, images: DataFrame, image_dims: DataFrame, keys, models=None,
               counters=None, content="content", path="path",
               output_tokens=OUTPUT_TOKENS) -> DataFrame:
    """Usage from flat tables, one row per message and one per image.

    Both sides are reduced by partial sums before they are shuffled on the conversation, so a
    conversation holding a third of all messages costs one row per task.
    """
    models = MODELS if models is None else models
    distinct, _ = per_encoding(models, counters)
    texts = tokens_by_conversation(messages, keys, content, distinct)
    # Images of a conversation differ in few tile counts: counted first, then billed per model.
    per_tile = (with_dims(images.select(*keys, F.col(path).alias("image")), image_dims)
                .groupBy(*keys, "tile_tokens", "status").agg(F.count(F.lit(1)).alias("shown")))
    tiles = (per_tile.groupBy(*keys)
             .agg(F.collect_list(F.struct("tile_tokens", "status", "shown")).alias("tiles")))
    # A conversation may have images and no message.
    names = [tokens_column(i) for i in range(len(distinct))]
    both = (texts.withColumn("_said", F.lit(True)).join(tiles, list(keys), "full")
            .withColumns({n: F.when(F.col("_said").isNull(), F.lit(0)).otherwise(F.col(n))
                          for n in names}).drop("_said"))
    rows = with_models(both, models, counters=counters).selectExpr(
        "*", f"coalesce(aggregate(tiles, 0L, (n, s) -> n + s.shown * "
        f"{I.billed('s.tile_tokens', 's.status')}), 0L) AS image_tokens",
        "coalesce(aggregate(tiles, 0L, (n, s) -> n + s.shown), 0L) AS image_count")
    return _priced(rows, keys, output_tokens)


def _summary(sums, by, models, output_tokens):
    """Totals, costs and averages from four integer sums per group and model."""
    rows = with_config(sums, models).selectExpr(
        "*", "total_text_tokens + total_image_tokens AS total_input_tokens",
        f"total_conversations * {output_tokens}L AS total_output_tokens")
    rows = rows.selectExpr(
        "*", "total_input_tokens + total_output_tokens AS total_tokens",
        f"{pricing('total_input_tokens', 'total_output_tokens')} AS cost")
    averaged = {"avg_text_tokens": "total_text_tokens", "avg_image_tokens": "total_image_tokens",
                "avg_total_input_tokens": "total_input_tokens",
                "avg_output_tokens": "total_output_tokens", "avg_total_tokens": "total_tokens",
                "avg_images_per_conversation": "total_images",
                "avg_cost_per_conversation": "cost.total_cost"}
    return rows.selectExpr(
        *by, "model", *S.CONFIG_FIELDS, "total_conversations", *S.TOKEN_TOTALS,
        *[f"cost.{t.removeprefix('total_') if t != 'total_cost' else t} AS {t}"
          for t in S.COST_TOTALS],
        *[f"try_divide(CAST({total} AS DOUBLE), total_conversations) AS {avg}"
          for avg, total in averaged.items()])


def usage_totals(usage: DataFrame, models=None, by=(), output_tokens=OUTPUT_TOKENS):
    """Totals and averages per model (and per `by`) from usage rows. Conversations that could
    not be counted are left out, also from the number of conversations. Rows of a model outside
    `models` fail the query: give the table they were priced with.

    Costs come from the integer sums in one expression, so they do not depend on row order.
    """
    models = MODELS if models is None else models
    return _summary(_sums(usage, by), by, models, output_tokens)


def _sums(usage, by):
    return usage.filter(F.col("text_tokens").isNotNull()).groupBy(*by, "model").agg(
        F.count(F.lit(1)).alias("total_conversations"),
        F.sum("text_tokens").alias("total_text_tokens"),
        F.sum("image_tokens").alias("total_image_tokens"),
        F.sum("image_count").alias("total_images"))


def corpus_totals(measures: DataFrame, image_dims: DataFrame, models=None, counters=None,
                  window=WINDOW, first_image="coded", by=(), output_tokens=OUTPUT_TOKENS,
                  min_prefix=MIN_PREFIX_INDEX, full_only=False, sizes_of=None):
    """Totals over all prefixes straight from step sizes, equal to summing the usage rows.

    One pass: shares are summed per image path before the size lookup (a hot screenshot becomes
    one row per task), then per tile count, and only those few rows are spread over the models.

    A counter that may fail (returns null) leaves out the prefixes it cannot count. The closed
    form does not know which those are, so tasks with such a step go through `sizes_of`, a
    function from their task_ids to `prefix_sizes` rows. Counters marked `never_null` spare
    that branch.
    """
    models = MODELS if models is None else models
    distinct, _ = per_encoding(models, counters)
    texts = [tokens_column(i) for i in range(len(distinct))]
    failing = [i for i, c in enumerate(distinct) if not getattr(c, "never_null", False)]
    rest = None
    if failing:
        if sizes_of is None:
            raise ValueError("a counter that may fail needs sizes_of")
        gap = F.lit(False)
        for i in failing:
            for part in ("head_first", "head_rest", "joined", "block", "target"):
                gap = gap | F.col(f"{part}_{i}").isNull()
        broken = measures.filter(gap).select("task_id").distinct()
        measures = measures.join(broken, "task_id", "left_anti")
        rest = _sums(usage_rows(sizes_of(broken), models, counters, by, False), by)

    def added_up(rows, keys):
        return rows.groupBy(*by, *keys).agg(
            F.sum("shown").alias("shown"), F.sum("rows").alias("rows"),
            *[F.sum(c).alias(c) for c in texts])

    shares = prefix_shares(measures, len(distinct), window, first_image, min_prefix, full_only)
    per_path = added_up(shares, ["image"])
    per_tile = added_up(with_dims(per_path, image_dims), ["tile_tokens", "status"])
    return _billed(per_tile, rest, models, counters, by, output_tokens)


def _billed(per_tile, rest, models, counters, by, output_tokens):
    """Totals from a handful of rows (shown, rows and texts by tile count), which are spread over
    the models, and from finished sums `rest`."""
    sums = with_models(per_tile, models, counters=counters).groupBy(*by, "model").agg(
        F.sum("rows").alias("total_conversations"),
        F.sum("text_tokens").alias("total_text_tokens"),
        F.expr(f"sum(shown * {I.billed()})").alias("total_image_tokens"),
        F.sum("shown").alias("total_images"))
    if rest is not None:
        names = [c for c in sums.columns if c.startswith("total_")]
        sums = sums.unionByName(rest).groupBy(*by, "model").agg(
            *[F.sum(c).alias(c) for c in names])
    return _summary(sums.filter("total_conversations > 0"), by, models, output_tokens)


def summary_totals(totals: DataFrame, models=None, counters=None, by=(),
                   output_tokens=OUTPUT_TOKENS, sizes_of=None):
    """Totals from one row per task (`summaries.task_totals`), equal to summing the usage rows.

    Tasks that a counter could not count go through `sizes_of`, a function from their task_ids to
    `prefix_sizes` rows. Counters marked `never_null` spare that branch.
    """
    models = MODELS if models is None else models
    distinct, _ = per_encoding(models, counters)
    rest = None
    if not all(getattr(c, "never_null", False) for c in distinct):
        if sizes_of is None:
            raise ValueError("a counter that may fail needs sizes_of")
        broken = totals.filter("gap").select("task_id")
        totals = totals.filter("not gap")
        rest = _sums(usage_rows(sizes_of(broken), models, counters, by, False), by)
    return _billed(by_class(totals, len(distinct), by), rest, models, counters, by, output_tokens)


def image_detail_rows(usage: DataFrame, keys=ROW_KEYS) -> DataFrame:
    """Flat form of image_details, one row per shown image."""
    return (usage.select(*keys, "model", F.posexplode("image_details"))
            .select(*keys, "model", (F.col("pos") + 1).cast("long").alias("img_pos"), "col.*"))


def image_costs(images: DataFrame, models=None, keys=("path",)) -> DataFrame:
    """Billed and backed-out tokens per image and model from tile_tokens and status."""
    rows = with_models(images, MODELS if models is None else models)
    return rows.selectExpr(*keys, "model", "image_token_multiplier AS multiplier",
                           f"{I.billed()} AS tokens",
                           f"{I.base_from_billed(f'({I.billed()})')} AS base_tokens")


def legacy_delta(images: DataFrame, tokens="tile_tokens") -> DataFrame:
    """Difference of the measured tokens to the former flat estimate."""
    legacy = F.lit(I.LEGACY_TOKENS).cast("long")
    return images.withColumn("legacy_tokens", legacy).withColumn("delta", F.col(tokens) - legacy)


def cost_estimates(averages: DataFrame, models=None, by=(), output_tokens=OUTPUT_TOKENS):
    """Price of one average conversation under each model of the rate table."""
    models = MODELS if models is None else models
    rows = with_models(averages.select(*by, "avg_total_input_tokens"), models)
    return rows.selectExpr(
        *by, "model", "avg_total_input_tokens AS avg_input_tokens",
        f"{output_tokens}L AS output_tokens",
        f"{pricing('avg_total_input_tokens', output_tokens)}.total_cost AS cost_per_conversation")


def first_conversations(rows: DataFrame, n, keys=ROW_KEYS) -> DataFrame:
    """First n rows in key order; None and 0 mean no limit."""
    if not check_limit(n):
        return rows
    return rows.orderBy(*keys).limit(n)


def check_limit(n):
    if n is not None and n < 0:
        raise ValueError("limit must not be negative")
    return n or None


def _literal(rows, last, order):
    return F.struct(*[F.lit(last[c]).cast(rows.schema[c].dataType).alias(c) for c in order])


def up_to(rows: DataFrame, last, order) -> DataFrame:
    """Rows that do not come after `last` in the given order; a filter, no shuffle."""
    return rows.filter(F.struct(*order) <= _literal(rows, last, order))


def first_rows(rows: DataFrame, n, keys=ROW_KEYS) -> DataFrame:
    """First n rows in key order, ties by content: a filter on the n-th key. Only rows that are
    equal to the n-th in everything are counted off one by one."""
    order = (*keys, "_content")
    rows = rows.withColumn("_content", F.xxhash64(*rows.columns))
    last = nth_key(rows, n, order)
    if last is None:
        return rows.drop("_content")
    place = F.struct(*order)
    before = rows.filter(place < _literal(rows, last, order))
    equal = rows.filter(place == _literal(rows, last, order)).limit(n - before.count())
    return before.union(equal).drop("_content")


def usage_sample(usage: DataFrame, n=3, images=2, keys=ROW_KEYS) -> DataFrame:
    """A few rows for inspection with the first images of each, shown by base name."""
    shown = F.transform(F.slice("image_details", 1, images), lambda d: F.struct(
        X.base_name(d["path"]).alias("name"), d["tokens"].alias("tokens"),
        d["base_tokens"].alias("base_tokens"), d["multiplier"].alias("multiplier")))
    return first_conversations(usage, n, keys).withColumn("image_details", shown)
