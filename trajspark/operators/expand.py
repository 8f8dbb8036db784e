"""Nested trajectories -> one chat-format training row per prefix.

The plan is narrow: scan, explode, project. Only trajectories longer than `split_over` take a
shuffle, which hands their prefixes out in ranges so that one long trajectory, whose rows grow
with the square of its length, does not end up in one task.
"""

from pyspark.sql import DataFrame, functions as F

from trajspark.functions import text as X
from trajspark.settings import (ASK, DEFAULT_LEVEL, MIN_PREFIX_INDEX, PROMPTS, WINDOW,
                                check_level)

SPLIT_OVER = None        # 256 is a good value for sources with long trajectories
FIRST_IMAGE = ("coded", "aligned")


def check_first_image(first_image):
    if first_image not in FIRST_IMAGE:
        raise ValueError(f"unknown first_image {first_image!r}, expected {FIRST_IMAGE}")
    return first_image


def _ranges(trajectories, split_over):
    """Adds `start`: a row covers the prefixes ending at array positions start..size-1."""
    if split_over is None:
        return trajectories.withColumn("start", F.lit(0))
    # A stored length lets the scan of the long branch pass over row groups without any. It only
    # chooses the branch: a task it calls short by mistake is expanded in one piece.
    size, stored = F.col("n_steps"), F.col("_stored")
    is_long = F.coalesce(stored > split_over, F.lit(False)) & (size > split_over)
    short = trajectories.filter(~is_long).withColumn("start", F.lit(0))
    long = (trajectories.filter(stored > split_over).filter(size > split_over)
            .withColumn("start", F.explode(F.sequence(F.lit(0), size - 1, F.lit(split_over))))
            .withColumn("traj", F.slice("traj", F.lit(1), F.col("start") + split_over))
            .repartition("task_id", "start"))
    return short.unionByName(long)


def _select_prefixes(rows, min_prefix, full_only):
    rows = rows.filter(F.col("prefix_len") > min_prefix)
    return rows.filter(F.col("prefix_len") == F.col("n_steps")) if full_only else rows


def prefixes(trajectories: DataFrame, min_prefix=MIN_PREFIX_INDEX, full_only=False,
             keep=()) -> DataFrame:
    """One row per prefix length with its last step. Empty and null arrays give no row."""
    rows = (trajectories
            .select("task_id", *keep, F.size("traj").alias("n_steps"), F.posexplode("traj"))
            .select("task_id", *keep, "n_steps",
                    (F.col("pos") + 1).cast("long").alias("prefix_len"),
                    F.col("col").alias("step")))
    return _select_prefixes(rows, min_prefix, full_only)


def prefixes_of_steps(steps: DataFrame, min_prefix=MIN_PREFIX_INDEX, full_only=False,
                      keep=()) -> DataFrame:
    """The same from flat steps: each step ends one prefix. A long task stays many rows."""
    rows = steps.select("task_id", *keep, (F.col("pos") + 1).cast("long").alias("prefix_len"))
    if not full_only:
        return rows.filter(F.col("prefix_len") > min_prefix)
    last = rows.groupBy("task_id", *keep).agg(F.max("prefix_len").alias("prefix_len"))
    return last.filter(F.col("prefix_len") > min_prefix)


def _with_pieces(trajectories, layout, root, min_prefix, full_only, keep, split_over):
    """Prefix rows that carry the task's turn texts and image paths, built once per task."""
    stored = F.col("n_steps") if "n_steps" in trajectories.columns else F.size("traj")
    sized = trajectories.withColumn("_stored", stored).withColumn("n_steps", F.size("traj"))
    turns = F.transform("traj", lambda s: X.action_turn(s["index"], s["value"]["action"], layout))
    paths = F.transform("traj", lambda s: X.join_root(root, s["image"]))
    todo = F.slice("traj", F.col("start") + 1, F.greatest(F.size("traj"), F.lit(1)))
    rows = (_ranges(sized, split_over)
            .select("task_id", *keep, "instruction", "n_steps", "start",
                    turns.alias("turns"), paths.alias("paths"), todo.alias("todo"))
            .select("*", F.posexplode("todo"))
            .withColumn("prefix_len", F.col("start") + F.col("pos") + 1)
            .withColumnRenamed("col", "step").drop("todo", "pos", "start"))
    return _select_prefixes(rows, min_prefix, full_only)


def _history(window):
    """Turns of all steps before the window, as one text."""
    return F.array_join(
        F.slice("turns", F.lit(1), F.greatest(F.col("prefix_len") - window, F.lit(0))),
        X.BLOCK_GAP)


def _images(window, first_image):
    """Always min(prefix_len, window) paths.

    In the coded form the first one sits one step before the window, so the screenshot of the
    window's own first step is never shown; `aligned` shows that one instead.
    """
    n = F.col("prefix_len")
    back = window + 1 if first_image == "coded" else window
    first = F.array(F.element_at("paths", F.greatest(n - back, F.lit(0)) + 1))
    rest = F.slice("paths", F.greatest(n - window, F.lit(0)) + 2,
                   F.least(n - 1, F.lit(window - 1)))
    return F.concat(first, rest)


def history_blocks(trajectories: DataFrame, window=WINDOW, layout="coded", keep=(),
                   split_over=SPLIT_OVER) -> DataFrame:
    """History text per prefix; empty text when the window covers the prefix."""
    rows = _with_pieces(trajectories, X.check_layout(layout), None, 0, False, keep, split_over)
    return rows.select("task_id", *keep, F.col("prefix_len").cast("long").alias("prefix_len"),
                       _history(window).alias("history"))


def _message(role, content):
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def _coded_messages(system, window, target):
    n = F.col("prefix_len")
    mark = _message("user", F.lit(X.IMAGE_MARK))
    with_history = n > window
    instruction = F.col("instruction")
    user = F.when(with_history, instruction).otherwise(
        F.concat(instruction, F.lit(X.IMAGE_MARK)))
    none = F.slice(F.array(mark), 1, 0)
    history = F.when(with_history,
                     F.array(_message("assistant", _history(window)), mark)).otherwise(none)
    recent = F.slice("turns", F.greatest(n - window, F.lit(0)) + 1,
                     F.least(n - 1, F.lit(window - 1)))
    recent = F.flatten(F.transform(
        recent, lambda turn: F.array(_message("assistant", turn), mark)))
    return F.concat(F.array(_message("system", system), _message("user", user)), history,
                    recent, F.array(_message("assistant", target)))


def _documented_messages(system, window, target, ask):
    n = F.col("prefix_len")
    mark = _message("user", F.lit(X.IMAGE_MARK))
    none = F.slice(F.array(mark), 1, 0)
    history = F.when(n > window,
                     F.array(_message("assistant", _history(window)))).otherwise(none)
    recent = F.slice("turns", F.greatest(n - window, F.lit(0)) + 1,
                     F.least(n - 1, F.lit(window - 1)))
    recent = F.flatten(F.transform(
        recent, lambda turn: F.array(mark, _message("assistant", turn))))
    user = X.asked(F.col("instruction"), ask)
    return F.concat(F.array(_message("system", system)), history, recent,
                    F.array(mark, _message("user", user), _message("assistant", target)))


def training_rows(trajectories: DataFrame, level=DEFAULT_LEVEL, prompts=None, image_root=None,
                  window=WINDOW, min_prefix=MIN_PREFIX_INDEX, full_only=False,
                  layout="coded", first_image="coded", keep=(), split_over=SPLIT_OVER,
                  ask=ASK) -> DataFrame:
    """Training rows: task_id, prefix_len, level, messages, images.

    `min_prefix` skips prefixes up to that length, `full_only` keeps whole trajectories only.
    The documented layout always shows the images of `aligned`. One pass over the source;
    `split_over` hands out longer trajectories in ranges, in a second pass, which a column
    `n_steps` in a parquet source keeps to the row groups that hold any.
    """
    check_level(level)
    X.check_layout(layout)
    check_first_image(first_image)
    if layout == "documented":
        first_image = "aligned"         # the documented layout knows no other
    if window < 1:
        raise ValueError("window must be at least 1")
    prompts = PROMPTS if prompts is None else prompts
    rows = _with_pieces(trajectories, layout, image_root, min_prefix, full_only, keep,
                        split_over)
    value = F.col("step")["value"]
    target = X.target_turn(level, F.col("step")["index"], value["observation"],
                           value["thought"], value["action"], value["code"], layout)
    system = F.lit(prompts[level])
    if layout == "documented":
        messages = _documented_messages(system, window, target, ask)
    else:
        messages = _coded_messages(system, window, target)
    return rows.select("task_id", *keep, F.col("prefix_len").cast("long").alias("prefix_len"),
                       F.lit(level).alias("level"), messages.alias("messages"),
                       _images(window, first_image).alias("images"))


def message_rows(rows: DataFrame, keys=("task_id", "prefix_len")) -> DataFrame:
    """Flat form of training rows, one row per message."""
    return (rows.select(*keys, F.posexplode("messages"))
            .select(*keys, (F.col("pos") + 1).cast("long").alias("msg_pos"),
                    F.col("col")["role"].alias("role"), F.col("col")["content"].alias("content")))


def step_images(trajectories: DataFrame, image_root=None) -> DataFrame:
    """Screenshots of all steps; with every prefix emitted these are all images shown."""
    images = trajectories.select(F.explode("traj.image").alias("image"))
    return images.select(X.join_root(image_root, F.col("image")).alias("path"))


def image_rows(rows: DataFrame, keys=("task_id", "prefix_len")) -> DataFrame:
    """Flat form of training rows, one row per shown image."""
    return (rows.select(*keys, F.posexplode("images"))
            .select(*keys, (F.col("pos") + 1).cast("long").alias("img_pos"),
                    F.col("col").alias("path")))
