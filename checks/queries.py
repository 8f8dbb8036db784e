"""One registered query per operator; each runs over whole tables."""

from pyspark.sql import functions as F

from checks import files, views as V
from trajspark import schemas as S
from trajspark.functions import images as I
from trajspark.functions.text import estimate_tokens, model_from_file
from trajspark.operators import compare as C, expand as P, measure as M, quality as Q
from trajspark.operators import tokens as T, usage as U
from trajspark.operators.selection import dense_numbers, nth_key
from trajspark.plans import jobs as J
from trajspark.settings import MIN_SCORE, MODELS, Model, select_models
from trajspark.sinks import writers as W
from trajspark.sources import image_files, readers as R

USAGE = ("text_tokens", "image_tokens", "image_count", "total_input_tokens", "output_tokens",
         "total_tokens")
LABELS = sorted(MODELS)
TOTALS = ("total_conversations", "total_text_tokens", "total_image_tokens", "total_images",
          "total_cost")


def _flat_usage(usage, keys=U.ROW_KEYS):
    return usage.select(*keys, "model", *USAGE, "pricing.input_cost", "pricing.output_cost",
                        "pricing.total_cost")


def _flat_inputs(s, d):
    return V.tasks(s, d), V.steps(s, d), V.image_dims(s, d)


def _totals(s, d, **kw):
    return J.step_totals(*_flat_inputs(s, d), **kw)


def _images_of(windows):
    return P.image_rows(windows)


def alignment_filter(s, d):
    return Q.keep_scored(V.tasks(s, d)).select("task_id", "alignment_score")


def prefix_expand(s, d):
    return P.prefixes_of_steps(V.steps(s, d), keep=("image",))


def prefix_expand_nested(s, d):
    rows = P.prefixes(V.trajectories(s, d))
    return rows.select("task_id", "prefix_len", F.col("n_steps").cast("long").alias("n_steps"),
                       F.col("step")["image"].alias("image"))


def prefix_full_only(s, d):
    return P.prefixes_of_steps(V.steps(s, d), full_only=True)


def prefix_min_length(s, d):
    return P.prefixes_of_steps(V.steps(s, d), min_prefix=5)


def history_block(s, d):
    return P.history_blocks(V.trajectories(s, d))


def image_window(s, d):
    return _images_of(M.image_windows(V.steps(s, d), image_root="shots"))


def image_window_aligned(s, d):
    return _images_of(M.image_windows(V.steps(s, d), image_root="shots", first_image="aligned"))


def training_images(s, d):
    return _images_of(P.training_rows(V.trajectories(s, d), image_root="shots"))


def _messages(level, **kw):
    def run(s, d):
        return P.message_rows(P.training_rows(V.trajectories(s, d), level, **kw))
    return run


def quarantined_trajectories(s, d):
    """Steps with little text lose their thought; such tasks cannot be expanded at L2."""
    traj = V.trajectories(s, d)
    short = F.transform("traj", lambda t: t.withField("value", t["value"].withField(
        "thought", F.when(F.length(t["value"]["action"]) >= V.MISSING_BELOW,
                          t["value"]["thought"]))))
    _, bad = Q.split_valid(traj.withColumn("traj", short), "L2")
    return bad.select("task_id", "reason")


def missing_images_strict(s, d):
    return Q.missing_images(V.steps(s, d), V.image_dims(s, d), "image")


def message_text_tokens(s, d):
    rows = V.table(s, d, "conversations")
    return T.flat_message_tokens(rows, "text").select("conv_id", "turn", "tokens")


def conversation_text_tokens(s, d):
    rows = V.table(s, d, "conversations")
    return T.tokens_by_conversation(rows, ["conv_id"], "text").withColumnRenamed(
        T.tokens_column(0), "text_tokens")


def document_text_tokens(s, d):
    return T.flat_message_tokens(V.table(s, d, "documents"), "text").select("doc_id", "tokens")


def distinct_text_tokens(s, d):
    """The documents hold exact copies; each distinct text is counted once."""
    return T.distinct_message_tokens(V.table(s, d, "documents"), ["doc_id"], "text")


def image_tile_tokens(s, d):
    rows = V.image_dims(s, d).filter(F.col("status") == I.OK)
    return rows.select("path", "width", "height",
                       I.tile_tokens().alias("tile_tokens"))


def _step_images(s, d):
    return M.with_dims(V.steps(s, d).select("image"), V.image_dims(s, d))


def image_model_tokens(s, d):
    rows = _step_images(s, d).withColumnRenamed("image", "path")
    return U.image_costs(rows, keys=("path", "status"))


def legacy_image_delta(s, d):
    rows = _step_images(s, d).filter(F.col("status") == I.OK)
    return U.legacy_delta(rows).select(F.col("image").alias("path"), "tile_tokens",
                                       "legacy_tokens", "delta")


def conversation_usage(s, d):
    return _flat_usage(J.step_usage(*_flat_inputs(s, d), details=False))


def trajectory_usage(s, d):
    usage = J.trajectory_usage(V.trajectories(s, d), V.image_dims(s, d), details=False)
    return _flat_usage(usage)


def chunked_trajectory_usage(s, d):
    """Chunks of four steps, so that history crosses chunks, and a column that means nothing."""
    traj = V.trajectories(s, d).withColumn("n_steps", F.lit(1))
    return _flat_usage(J.trajectory_usage(traj, V.image_dims(s, d), details=False, chunk=4))


def training_row_usage(s, d):
    """The usage job on built training rows, counting every message as it stands."""
    rows = P.training_rows(V.trajectories(s, d))
    return _flat_usage(J.row_usage(rows, V.image_dims(s, d), details=False))


def placed_row_usage(s, d):
    """The same with images looked up in place, as on a stream."""
    rows = P.training_rows(V.trajectories(s, d))
    return _flat_usage(J.row_usage(rows, V.image_dims(s, d), details=False, most_images=3))


def chat_usage(s, d):
    """The usage job on the given conversations as they are, with one image per later turn."""
    images = V.steps(s, d).select(F.col("task_id").alias("conv_id"), F.col("image").alias("path"))
    usage = U.flat_usage(V.table(s, d, "conversations"), images, V.image_dims(s, d), ["conv_id"],
                         content="text")
    return _flat_usage(usage, ["conv_id"])


def image_details(s, d):
    usage = J.step_usage(*_flat_inputs(s, d))
    return U.image_detail_rows(usage)


def usage_totals_by_model(s, d):
    return _totals(s, d).drop(*[c for c in ("encoding", "supports_vision")])


def usage_totals_from_rows(s, d):
    return U.usage_totals(J.step_usage(*_flat_inputs(s, d), details=False)).drop(
        "encoding", "supports_vision")


def usage_totals_nested(s, d):
    return J.trajectory_totals(V.trajectories(s, d), V.image_dims(s, d)).drop(
        "encoding", "supports_vision")


def usage_averages_by_model(s, d):
    t = _totals(s, d)
    return t.select("model", *[c for c in t.columns if c.startswith("avg_")])


def usage_by_dataset(s, d):
    t = _totals(s, d, by=("dataset",))
    return t.select("dataset", "model", "total_conversations", "total_input_tokens",
                    "total_images", "total_cost")


def first_n_usage(s, d):
    usage = J.first_step_usage(*_flat_inputs(s, d), n=25, models=select_models(["gpt-5"]),
                               details=False)
    return _flat_usage(usage)


def usage_sample(s, d):
    usage = J.first_step_usage(*_flat_inputs(s, d), n=3, models=select_models(["gpt-4o-mini"]))
    rows = U.usage_sample(usage)
    return rows.select(*U.ROW_KEYS, "text_tokens", F.posexplode("image_details")).select(
        *U.ROW_KEYS, "text_tokens", (F.col("pos") + 1).cast("long").alias("img_pos"), "col.*")


def conversation_ids(s, d):
    keys = V.steps(s, d).select("task_id", (F.col("pos") + 1).alias("prefix_len"))
    return dense_numbers(keys, ["task_id", "prefix_len"], rows_per_range=100_000)


def nth_document(s, d):
    """The document in the middle by language, source and length, however many are equal."""
    docs = V.table(s, d, "documents").select("lang", "source", "n_chars")
    last = nth_key(docs, -(-docs.count() // 2), docs.columns)
    return docs.filter(F.struct(*docs.columns) == F.struct(
        *[F.lit(last[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]))


def document_ids(s, d):
    """Numbers in the order of all columns but the text; short ranges, so that there are some."""
    docs = V.table(s, d, "documents").select("lang", "n_chars", "doc_id")
    return dense_numbers(docs, ["lang", "n_chars", "doc_id"], "number", rows_per_range=100)


def unknown_models(s, d):
    """Every document asks for the model its source and language spell."""
    asked = V.table(s, d, "documents").select(
        F.when(F.col("lang") == "en", F.lit("gpt-4o"))
        .when(F.col("lang") == "de", F.lit("gpt-5-mini"))
        .otherwise(F.concat(F.lit("custom-"), F.col("source"))).alias("model"))
    return Q.unknown_models(asked, MODELS).select("model", "requests")


def compare_token_matrix(s, d):
    return C.token_matrix(_totals(s, d), LABELS)


def compare_average_matrix(s, d):
    return C.average_matrix(_totals(s, d), LABELS)


def compare_pricing(s, d):
    return C.price_table(_totals(s, d))


def compare_features(s, d):
    return C.feature_table(_totals(s, d))


def _placed_totals(s, d):
    place = F.coalesce(*[F.when(F.col("model") == m, i) for i, m in enumerate(MODELS)])
    return _totals(s, d).withColumn("input_ord", place.cast("long"))


def compare_rank(s, d):
    return C.cost_rank(_placed_totals(s, d))


def compare_multiplier(s, d):
    return C.cost_multipliers(_placed_totals(s, d))


def compare_vs_cheapest_total(s, d):
    return C.total_multipliers(_totals(s, d))


def last_result_wins(s, d):
    """One result set per data set and model, all under the model's label."""
    results = _totals(s, d, by=("dataset",)).withColumn(
        "input_ord", F.ascii("dataset").cast("long")).drop("dataset")
    return C.last_per_label(results).select("model", "input_ord", "total_conversations",
                                            "total_input_tokens")


def cost_estimate(s, d):
    averages = _totals(s, d, models=select_models(["gpt-4o"]))
    return U.cost_estimates(averages)


def summary_report(s, d):
    return C.summary_report(_totals(s, d)).select(
        "model", F.col("line").cast("long").alias("line"), "label", "value")


def training_set_cost(s, d):
    """Flagship: what would the quality-filtered training set cost?"""
    kept = Q.keep_scored(V.tasks(s, d))
    totals = J.step_totals(kept, V.steps(s, d), V.image_dims(s, d))
    return totals.select("model", "total_conversations", "total_text_tokens",
                         "total_image_tokens", "total_tokens", "total_cost",
                         "avg_cost_per_conversation")


def keyless_row_usage(s, d):
    """Rows as others write them: messages and images alone, many of them equal."""
    rows = P.training_rows(V.trajectories(s, d)).select("messages", "images")
    return _flat_usage(J.row_usage(rows, V.image_dims(s, d), keys=(), details=False), ())


def first_n_filtered_usage(s, d):
    usage = J.first_step_usage(*_flat_inputs(s, d), n=25, min_score=MIN_SCORE, min_prefix=1,
                               models=select_models(["gpt-5"]), details=False)
    return _flat_usage(usage)


def _failing(text):
    """An estimate that cannot count texts with a certain syllable."""
    return F.when(~text.contains(V.UNCOUNTABLE), estimate_tokens(text))


_failing.native = True
COUNTERS = {"o200k_base": _failing}       # the other encoding counts everything


def totals_with_failures(s, d):
    return _totals(s, d, counters=COUNTERS).select("model", *TOTALS)


def row_totals_with_failures(s, d):
    usage = J.trajectory_usage(V.trajectories(s, d), V.image_dims(s, d), counters=COUNTERS,
                               details=False)
    return U.usage_totals(usage).select("model", *TOTALS)


def full_only_totals(s, d):
    return _totals(s, d, full_only=True, min_prefix=3).select("model", *TOTALS)


def late_prefix_totals(s, d):
    """Nested form: prefixes of three steps and more."""
    totals = J.trajectory_totals(V.trajectories(s, d), V.image_dims(s, d), min_prefix=2)
    return totals.select("model", *TOTALS)


def documented_usage(s, d):
    return _flat_usage(J.step_usage(*_flat_inputs(s, d), layout="documented", details=False))


def documented_totals(s, d):
    return _totals(s, d, layout="documented").select("model", *TOTALS)


def other_output_tokens(s, d):
    usage = J.trajectory_usage(V.trajectories(s, d), V.image_dims(s, d), output_tokens=100,
                               full_only=True, details=False)
    return _flat_usage(usage)


BLIND = {"blind": Model("o200k_base", False, 1.0, 2.0), "gpt-5": MODELS["gpt-5"]}


def usage_without_vision(s, d):
    return _flat_usage(J.step_usage(*_flat_inputs(s, d), models=BLIND, details=False))


def combined_results(s, d):
    parts = _totals(s, d, by=("dataset",))
    sets = [parts.filter(F.col("dataset") == name).drop("dataset") for name in "cab"]
    return C.combine(*sets).select("model", "input_ord", "total_conversations", "total_tokens")


def file_labels(s, d):
    names = V.table(s, d, "documents").select("doc_id", F.concat(
        F.lit("/results/"), "source", F.when(F.col("lang") == "en", F.lit("_tokens.json"))
        .when(F.col("lang") == "de", F.lit("_tokens_accurate.json"))
        .otherwise(F.lit("_tokens_v2.json"))).alias("path"))
    return names.select("doc_id", model_from_file(F.col("path")).alias("model"))


def parsed_trajectories(s, d):
    """Trajectory lines written as JSON and parsed with the declared schema."""
    lines = V.trajectories(s, d).select(F.to_json(F.struct(
        F.col("task_id").cast("string").alias("task_id"), "instruction", "alignment_score",
        "traj")).alias("line"))
    parsed = lines.select(F.from_json("line", S.TRAJECTORY).alias("t")).select("t.*")
    return parsed.select("task_id", "alignment_score", F.posexplode("traj")).select(
        F.col("task_id").cast("long").alias("task_id"), "alignment_score",
        F.col("pos").cast("long").alias("pos"), F.col("col")["image"].alias("image"),
        F.col("col")["value"]["action"].alias("action"))


def parsed_training_rows(s, d):
    rows = P.training_rows(V.trajectories(s, d), keep=())
    lines = rows.select(F.to_json(F.struct("*")).alias("line"))
    parsed = lines.select(F.from_json("line", S.TRAINING_ROW).alias("r")).select("r.*")
    return P.message_rows(parsed.withColumn("task_id", F.col("task_id").cast("long")))


def parsed_result_sets(s, d):
    """Result documents written as JSON and parsed with the declared schema."""
    lines = W.result_documents(_totals(s, d)).select(F.to_json(F.struct("*")).alias("line"))
    parsed = lines.select(F.from_json("line", S.RESULT_SET).alias("r")).select("r.*")
    return R.flat_results(parsed).select("model", *TOTALS)


def png_header_dims(s, d):
    """Sizes read back from PNG headers spelled from the sizes."""
    def number(c):
        return F.lpad(F.hex(c), 8, "0")
    content = F.unhex(F.concat(
        F.lit("89504E470D0A1A0A0000000D49484452"), number("width"), number("height"),
        F.when(F.col("status") == I.OK, F.lit("0802000000")).otherwise(F.lit(""))))
    rows = V.image_dims(s, d).select("path", F.when(F.col("status") == I.OK, content).otherwise(
        F.substring(content, 1, 20)).alias("content"))
    return image_files.image_dims(rows).withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("width", "height")})


def image_changes(s, d):
    """A stored table of sizes against what a later look at the files finds."""
    conv, pos = F.col("task_id"), F.col("pos")
    files = V.steps(s, d).select(F.col("image").alias("path"), (conv * 31 + pos).alias("n"),
                                 F.length("action").cast("long").alias("size"))
    stored = files.filter("n % 4 > 0").select("path", F.when(F.col("n") % 9 > 0, F.col("size"))
                                              .alias("size"), F.col("n").alias("modified"))
    found = files.filter("n % 5 > 0").select(
        "path", "size", F.when(F.col("n") % 7 > 0, F.col("n")).otherwise(-1).alias("modified"))
    return image_files.dims_changes(stored, found).select("path", "change")


QUERIES = {f.__name__: f for f in (
    image_changes, nth_document, document_ids,
    training_set_cost, alignment_filter, prefix_expand, prefix_expand_nested, prefix_full_only,
    prefix_min_length, history_block, image_window, image_window_aligned, training_images,
    quarantined_trajectories, missing_images_strict, message_text_tokens,
    conversation_text_tokens, document_text_tokens, distinct_text_tokens, image_tile_tokens,
    image_model_tokens, legacy_image_delta, conversation_usage, trajectory_usage,
    chunked_trajectory_usage, training_row_usage, placed_row_usage, chat_usage, image_details, usage_totals_by_model,
    usage_totals_from_rows, usage_totals_nested, usage_averages_by_model, usage_by_dataset,
    first_n_usage, usage_sample, conversation_ids, unknown_models, compare_token_matrix,
    compare_average_matrix, compare_pricing, compare_features, compare_rank,
    compare_multiplier, compare_vs_cheapest_total, last_result_wins, cost_estimate,
    summary_report, keyless_row_usage, first_n_filtered_usage, totals_with_failures,
    row_totals_with_failures, full_only_totals, late_prefix_totals, documented_usage,
    documented_totals, other_output_tokens, usage_without_vision, combined_results, file_labels,
    parsed_trajectories, parsed_training_rows, parsed_result_sets, png_header_dims)}
QUERIES.update(training_messages_l1=_messages("L1"), training_messages_l2=_messages("L2"),
               training_messages_l3=_messages("L3"),
               training_messages_documented=_messages("L2", layout="documented"))
QUERIES.update(files.QUERIES)
