"""The three jobs, end to end, as DataFrame in, DataFrame out."""

from pyspark.sql import DataFrame, functions as F

from trajspark.operators import compare as C, expand as P, measure as M, quality as Q
from trajspark.operators import summaries as Z, usage as U
from trajspark.operators.selection import nth_key
from trajspark.operators.sequences import CHUNK
from trajspark.operators.tokens import per_encoding
from trajspark.settings import (DEFAULT_LEVEL, MIN_PREFIX_INDEX, MIN_SCORE, MODELS, OUTPUT_TOKENS,
                                WINDOW)


def _usable(trajectories, level, min_score, min_prefix, full_only, strict=False):
    """(usable, quarantine): broken lines are set aside before the score filter, which would
    drop them unseen."""
    readable, broken = Q.split_readable(trajectories, strict)
    kept = Q.keep_scored(readable, min_score) if min_score is not None else readable
    usable, bad = Q.split_valid(kept, level, strict, min_prefix, full_only)
    return usable, bad if broken is None else bad.unionByName(broken, allowMissingColumns=True)


def training_set(trajectories: DataFrame, image_dims=None, level=DEFAULT_LEVEL,
                 min_score=MIN_SCORE, strict=False, image_root=None, min_prefix=MIN_PREFIX_INDEX,
                 full_only=False, **options):
    """(training rows, quarantine): score filter, validation, expansion of every prefix.

    The quarantine also holds the lines that could not be parsed, if the reader kept them. With
    `image_dims` every image some training row shows must exist.
    """
    usable, bad = _usable(trajectories, level, min_score, min_prefix, full_only, strict)
    rows = P.training_rows(usable, level, image_root=image_root, min_prefix=min_prefix,
                           full_only=full_only, **options)
    if image_dims is not None:
        # With one image per row the coded form passes over the last screenshot of a task.
        every = not min_prefix and not full_only and (
            options.get("window", WINDOW) > 1 or options.get("layout") == "documented"
            or options.get("first_image") == "aligned")
        Q.require_images(P.step_images(usable, image_root) if every else P.image_rows(rows),
                         image_dims)
    return rows, bad


def _shown(layout, first_image):
    return "aligned" if layout == "documented" else first_image


def _emitted(sizes, lengths, min_prefix, full_only):
    rows = sizes.filter(F.col("prefix_len") > min_prefix) if min_prefix else sizes
    if full_only:
        last = lengths.withColumnRenamed("n", "prefix_len")
        rows = rows.join(last, ["task_id", "prefix_len"], "left_semi")
    return rows


def _nested_sizes(trajectories, image_dims, distinct, level, prompts, image_root, window,
                  first_image, keep, chunk, layout, min_prefix, full_only):
    inside = all(M.in_row(c) for c in distinct)
    sizes = M.prefix_sizes(
        M.measure_trajectories(trajectories, level, distinct, prompts, image_root, keep, layout,
                               chunk if inside else None),
        image_dims, len(distinct),
        None if inside else M.offsets_of_trajectories(trajectories, distinct, chunk, layout),
        None, window, _shown(layout, first_image), chunk, keep)
    lengths = trajectories.select("task_id", F.size("traj").cast("long").alias("n"))
    return _emitted(sizes, lengths, min_prefix, full_only)


def _flat_sizes(tasks, steps, image_dims, distinct, level, prompts, image_root, window,
                first_image, keep, chunk, layout, min_prefix, full_only):
    counted, heads = M.flat_parts(tasks, steps, level, distinct, prompts, image_root, keep, chunk,
                                  layout)
    sizes = M.prefix_sizes(counted, image_dims, len(distinct), None, heads, window,
                           _shown(layout, first_image), chunk, keep)
    lengths = steps.groupBy("task_id").agg((F.max("pos") + 1).cast("long").alias("n"))
    return _emitted(sizes, lengths, min_prefix, full_only)


def trajectory_usage(trajectories: DataFrame, image_dims: DataFrame, level=DEFAULT_LEVEL,
                     models=None, counters=None, prompts=None, image_root=None, window=WINDOW,
                     first_image="coded", keep=(), chunk=CHUNK, details=True, layout="coded",
                     min_prefix=MIN_PREFIX_INDEX, full_only=False, min_score=None,
                     output_tokens=OUTPUT_TOKENS) -> DataFrame:
    """Usage of every emitted prefix of nested trajectories, without building training rows.

    Trajectories that `training_set` would set aside at this level are left out here too.
    """
    distinct, _ = per_encoding(MODELS if models is None else models, counters)
    usable, _ = _usable(trajectories, level, min_score, min_prefix, full_only)
    sizes = _nested_sizes(usable, image_dims, distinct, level, prompts, image_root, window,
                          first_image, keep, chunk, layout, min_prefix, full_only)
    return U.usage_rows(sizes, models, counters, (*keep, *U.ROW_KEYS), details, output_tokens)


def step_usage(tasks: DataFrame, steps: DataFrame, image_dims: DataFrame, level=DEFAULT_LEVEL,
               models=None, counters=None, prompts=None, image_root=None, window=WINDOW,
               first_image="coded", keep=(), chunk=CHUNK, details=True, layout="coded",
               min_prefix=MIN_PREFIX_INDEX, full_only=False, min_score=None,
               output_tokens=OUTPUT_TOKENS) -> DataFrame:
    """Usage of every emitted prefix from flat task and step tables, which must be complete:
    see `measure.flat_problems`."""
    distinct, _ = per_encoding(MODELS if models is None else models, counters)
    tasks = Q.keep_scored(tasks, min_score) if min_score is not None else tasks
    sizes = _flat_sizes(tasks, steps, image_dims, distinct, level, prompts, image_root, window,
                        first_image, keep, chunk, layout, min_prefix, full_only)
    return U.usage_rows(sizes, models, counters, (*keep, *U.ROW_KEYS), details, output_tokens)


def trajectory_totals(trajectories: DataFrame, image_dims: DataFrame, level=DEFAULT_LEVEL,
                      models=None, counters=None, prompts=None, image_root=None, window=WINDOW,
                      first_image="coded", by=(), layout="coded", min_prefix=MIN_PREFIX_INDEX,
                      full_only=False, min_score=None, output_tokens=OUTPUT_TOKENS) -> DataFrame:
    """What the training set costs, per model: one pass over the trajectories."""
    distinct, _ = per_encoding(MODELS if models is None else models, counters)
    usable, _ = _usable(trajectories, level, min_score, min_prefix, full_only)
    measures = M.measure_trajectories(usable, level, distinct, prompts, image_root, by, layout)
    return U.corpus_totals(
        measures, image_dims, models, counters, window, _shown(layout, first_image), by,
        output_tokens, min_prefix, full_only, lambda ids: _nested_sizes(
            usable.join(ids, "task_id", "left_semi"), image_dims, distinct, level, prompts,
            image_root, window, first_image, by, CHUNK, layout, min_prefix, full_only))


def step_totals(tasks: DataFrame, steps: DataFrame, image_dims: DataFrame, level=DEFAULT_LEVEL,
                models=None, counters=None, prompts=None, image_root=None, window=WINDOW,
                first_image="coded", by=(), layout="coded", min_prefix=MIN_PREFIX_INDEX,
                full_only=False, min_score=None, output_tokens=OUTPUT_TOKENS) -> DataFrame:
    """The same from flat tables: steps are summed where they lie, and tasks meet one summary each."""
    distinct, _ = per_encoding(MODELS if models is None else models, counters)
    tasks = Q.keep_scored(tasks, min_score) if min_score is not None else tasks
    shares = Z.Shares(window, _shown(layout, first_image), min_prefix, full_only)
    totals = Z.summarize_steps(tasks, steps, image_dims, level, distinct, shares, prompts,
                               image_root, by, layout)
    return U.summary_totals(totals, models, counters, by, output_tokens, lambda ids: _flat_sizes(
        tasks.join(ids, "task_id", "left_semi"), steps.join(ids, "task_id", "left_semi"),
        image_dims, distinct, level, prompts, image_root, window, first_image, by, CHUNK,
        layout, min_prefix, full_only))


def row_usage(rows: DataFrame, image_dims: DataFrame, models=None, counters=None,
              keys=U.ROW_KEYS, details=True, limit=None,
              output_tokens=OUTPUT_TOKENS, most_images=None) -> DataFrame:
    """Usage of ready-made training rows, one per row and model whatever the keys hold; `limit`
    takes the first rows in key order. Lines that could not be parsed, if kept, are left out.

    `most_images`, a bound that the rows keep (training rows have `window` images at most), looks
    images up in place: no regrouping, and `rows` may be a stream (without `limit`)."""
    rows, _ = Q.split_readable(rows)
    if U.check_limit(limit):
        rows = U.first_rows(rows, limit, keys)
    return U.usage_rows(U.row_sizes(rows, image_dims, models, counters, keys, most_images), models,
                        counters, keys, details, output_tokens)


def first_step_usage(tasks: DataFrame, steps: DataFrame, image_dims: DataFrame, n,
                     min_prefix=MIN_PREFIX_INDEX, full_only=False, min_score=None,
                     **options) -> DataFrame:
    """Usage of the first n emitted prefixes in (task_id, prefix_len) order.

    The n-th key is found first, among the steps that have a task; tasks after it are not read.
    """
    tasks = Q.keep_scored(tasks, min_score) if min_score is not None else tasks
    chosen = dict(min_prefix=min_prefix, full_only=full_only, **options)
    if not U.check_limit(n):
        return step_usage(tasks, steps, image_dims, **chosen)
    keys = P.prefixes_of_steps(steps.join(tasks.select("task_id"), "task_id", "left_semi"),
                               min_prefix, full_only)
    last = nth_key(keys, n, U.ROW_KEYS)
    if last is None:
        return step_usage(tasks, steps, image_dims, **chosen)
    usage = step_usage(U.up_to(tasks, last, ["task_id"]), U.up_to(steps, last, ["task_id"]),
                       image_dims, **chosen)
    return U.up_to(usage, last, list(U.ROW_KEYS))


def comparison(results: DataFrame, labels=None, formatted=False):
    """All comparison tables as a dict of DataFrames; a repeated label keeps its last result. `labels` chooses the models of both matrices."""
    if "input_ord" in results.columns:
        results = C.last_per_label(results)
    return {"tokens": C.token_matrix(results, labels, formatted),
            "averages": C.average_matrix(results, labels, formatted),
            "pricing": C.price_table(results, formatted),
            "features": C.feature_table(results, formatted),
            "rank": C.cost_rank(results),
            "multipliers": C.cost_multipliers(results, formatted)}
