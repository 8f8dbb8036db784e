"""Sizes of all prefixes of a task, without building their text.

A prefix's rows repeat the texts of its task: its history is all earlier turns joined by a
blank line, followed by the recent turns and the last one. Counting the built rows reads text
that grows with the square of the task's length. Here every step is counted once:

    block   tokens of the turn (heading and action)
    joined  tokens of the turn followed by the history gap
    target  tokens of the turn as the last one of a prefix

and with window k and p = prefix_len - 1

    text(p) = head + sum(joined[0 .. p-k-1]) + sum(block[p-k .. p-1]) + target[p]

because every turn starts with `#` after a line break, where no token spans the cut. That holds
for the estimate by construction (disjoint classes) and for byte-pair splitters that never join
a line break to a following `#`; the tests compare both with the built text.
"""

from pyspark.sql import DataFrame, Window, functions as F

from trajspark.functions import images as I, text as X
from trajspark.operators.expand import check_first_image
from trajspark.operators.sequences import (CHUNK, chunk_sums, chunk_window, offset_names,
                                           with_halo)
from trajspark.operators.tokens import message_tokens, tokens_column
from trajspark.settings import ASK, DEFAULT_LEVEL, PROMPTS, WINDOW, check_level


def head_counts(level, prompts, counters, layout="coded", ask=ASK):
    prompt = (PROMPTS if prompts is None else prompts)[check_level(level)]
    instruction = F.col("instruction")
    marked = F.concat(instruction, F.lit(X.IMAGE_MARK))
    if layout == "documented":
        instruction = marked = X.asked(instruction, ask)
    out = []
    for i, counter in enumerate(counters):
        system = message_tokens(F.lit(prompt), counter)
        out += [(system + message_tokens(marked, counter)).alias(f"head_first_{i}"),
                (system + message_tokens(instruction, counter)).alias(f"head_rest_{i}")]
    return out


def _at_once(counter, layout):
    """A counter may know how to count a step of the coded layout by reading its texts once."""
    return getattr(counter, "step", None) if layout == "coded" else None


def _joined_counts(index, action, counters, layout="coded"):
    turn = F.concat(X.action_turn(index, action, layout), F.lit(X.BLOCK_GAP))
    return [(_at_once(counter, layout)(None, index, None, None, action, None)[1]
             if _at_once(counter, layout) else counter(turn)).alias(f"joined_{i}")
            for i, counter in enumerate(counters)]


def _step_counts(level, index, value, counters, layout="coded"):
    """block, joined and target per counter."""
    texts = [value[c] for c in ("observation", "thought", "action", "code")]
    turn = X.action_turn(index, value["action"], layout)
    out = []
    for i, counter in enumerate(counters):
        if _at_once(counter, layout):
            block, joined, target = counter.step(level, index, *texts)
        else:
            block = counter(turn)
            joined = counter(F.concat(turn, F.lit(X.BLOCK_GAP)))
            target = counter(X.target_turn(level, index, *texts, layout))
        out += [block.alias(f"block_{i}"), joined.alias(f"joined_{i}"),
                target.alias(f"target_{i}")]
    return out


def _names(prefixes, n):
    return [f"{p}_{i}" for i in range(n) for p in prefixes]


HEADS = ("head_first", "head_rest")
STEPS = ("joined", "block", "target")


def in_row(counter):
    """Whether a counter can run inside a row's array: one of built-in expressions can."""
    return getattr(counter, "native", False)


def _history_before(counters, chunk, layout):
    """Per counter the history of a task up to each chunk, as an array of (before, gaps) that
    `chunk_sums` would give; null for a task of one chunk, whose steps are not counted for it."""
    size, out = F.size("traj"), []
    chunks = F.sequence(F.lit(0), F.floor((size - 1) / chunk).cast("int"))

    def total(numbers):
        return F.aggregate(numbers, F.lit(0).cast("long"), lambda n, x: n + F.coalesce(x, F.lit(0)))

    def once(value, body):
        return F.transform(F.array(value), body)[0]

    for k, counter in enumerate(counters):
        def counts(c, counter=counter):
            part = F.slice("traj", c * chunk + 1, F.lit(chunk))
            return F.transform(part, lambda s: _joined_counts(
                s["index"], s["value"]["action"], [counter], layout)[0])
        sums = F.transform(chunks, lambda c: once(counts(c), lambda x: F.struct(
            total(x).alias("n"),
            F.size(F.filter(x, lambda y: y.isNull())).cast("long").alias("gaps"))))
        before = once(sums, lambda parts: F.transform(chunks, lambda c: F.struct(
            total(F.slice(parts, F.lit(1), c)["n"]).alias("before"),
            total(F.slice(parts, F.lit(1), c)["gaps"]).alias("gaps"))))
        out.append(F.when(size > chunk, before).alias(f"_history_{k}"))
    return out


def measure_trajectories(trajectories: DataFrame, level, counters, prompts=None,
                         image_root=None, keep=(), layout="coded", history_by=None) -> DataFrame:
    """One row of sizes per step of nested trajectories; narrow.

    With `history_by`, a chunk length, each step also brings the history counted up to its chunk
    (`offset_names`), summed inside the task's row; the counters must allow it (`in_row`).
    """
    heads = _names(HEADS, len(counters))
    inside = range(len(counters) if history_by else 0)
    history = [f"_history_{i}" for i in inside]
    tasks = (trajectories.filter(F.size("traj") > 0)
             .select("task_id", *keep, F.size("traj").cast("long").alias("n_steps"), "traj",
                     *head_counts(level, prompts, counters, layout),
                     *(_history_before(counters, history_by, layout) if history_by else ())))
    steps = tasks.select("task_id", *keep, "n_steps", *heads, *history, F.posexplode("traj"))
    step, offsets = F.col("col"), []
    for i in inside:
        at = F.get(F.col(f"_history_{i}"), F.floor(F.col("pos") / history_by).cast("int"))
        offsets += [F.coalesce(at[kind], F.lit(0)).cast("long").alias(f"joined_{i}_{kind}")
                    for kind in ("before", "gaps")]
    return steps.select("task_id", *keep, "n_steps", *heads,
                        F.col("pos").cast("long").alias("pos"),
                        X.join_root(image_root, step["image"]).alias("image"), *offsets,
                        *_step_counts(level, step["index"], step["value"], counters, layout))


def counted_steps(steps, level, counters, image_root, layout):
    value = {c: F.col(c) for c in ("observation", "thought", "action", "code")}
    return steps.select("task_id", F.col("pos").cast("long").alias("pos"),
                        X.join_root(image_root, F.col("image")).alias("image"),
                        *_step_counts(level, F.col("index"), value, counters, layout))


def flat_parts(tasks: DataFrame, steps: DataFrame, level, counters, prompts=None,
               image_root=None, keep=(), chunk=CHUNK, layout="coded"):
    """(sizes per step, heads per task and chunk) from flat tables: tasks(task_id, instruction,
    *keep) and steps(task_id, pos, index, image, observation, thought, action, code).

    Text is counted before it meets a shuffle, so only numbers and image names travel. Heads
    come once per chunk, so the steps of one long task can meet their task in many places; they
    also bring the history counted up to the chunk. For that the actions are read and counted a
    second time.
    """
    counted = counted_steps(steps, level, counters, image_root, layout)
    joined = _joined_counts(F.col("index"), F.col("action"), counters, layout)
    chunks = chunk_sums(steps.select("task_id", "pos", *joined),
                        _names(("joined",), len(counters)), chunk)
    heads = tasks.select("task_id", *keep, *head_counts(level, prompts, counters, layout))
    return counted, heads.join(chunks, "task_id")


def flat_problems(tasks: DataFrame, steps: DataFrame, image_dims: DataFrame,
                  level=DEFAULT_LEVEL) -> DataFrame:
    """(problem, key, n) of flat tables that would be measured wrongly: positions of a task that
    are not 0, 1, 2 ... once each, repeated tasks, paths with several sizes, steps with a null
    text that their level shows, and steps of no task. An empty result means all is well."""
    key = F.col("task_id").cast("string").alias("key")
    positions = steps.groupBy("task_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"),
        F.sum("pos").alias("total"), F.sum(F.col("pos") * F.col("pos")).alias("squares"))
    # Sum and sum of squares tell a gap closed by a repeat from a dense sequence.
    last = F.col("n") - 1
    dense = ((F.col("first") == 0) & (F.col("last") == last)
             & (F.col("total") * 2 == last * F.col("n"))
             & (F.col("squares") * 6 == last * F.col("n") * (2 * last + 1)))
    uneven = positions.filter(~F.coalesce(dense, F.lit(False))).select(
        F.lit("positions").alias("problem"), key, "n")
    twice = tasks.groupBy("task_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        F.lit("repeated task").alias("problem"), key, "n")
    doubled = image_dims.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter(
        "n > 1").select(F.lit("repeated path").alias("problem"), F.col("path").alias("key"), "n")
    shown = {"L1": ("action", "code"), "L2": ("thought", "action", "code"),
             "L3": ("observation", "thought", "action", "code")}[check_level(level)]
    missing = F.lit(False)
    for name in ("index", "image", *shown):
        missing = missing | F.col(name).isNull()
    nulls = steps.filter(missing).groupBy("task_id").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("null in a step").alias("problem"), key, "n")
    lost = steps.join(tasks.select("task_id"), "task_id", "left_anti").groupBy("task_id").agg(
        F.count(F.lit(1)).alias("n")).select(F.lit("steps of no task").alias("problem"), key, "n")
    return uneven.union(twice).union(doubled).union(nulls).union(lost)


def offsets_of_trajectories(trajectories, counters, chunk=CHUNK, layout="coded"):
    """History counted up to each chunk but the first, of tasks longer than one chunk only, for
    counters that cannot run inside a row: a second pass over the source."""
    step, joined = F.col("col"), _names(("joined",), len(counters))
    rows = (trajectories.filter(F.size("traj") > chunk)
            .select("task_id", F.posexplode("traj"))
            .select("task_id", "pos",
                    *_joined_counts(step["index"], step["value"]["action"], counters, layout)))
    return chunk_sums(rows, joined, chunk).filter(F.col("chunk") > 0).select(
        "task_id", "chunk", *offset_names(joined))


def with_dims(rows: DataFrame, image_dims: DataFrame, path="image") -> DataFrame:
    """Adds tile_tokens and status (`missing` without a row) by image path.

    One lookup per step, not one per prefix that shows the step. Catalyst broadcasts the sizes
    only when their measured size allows it; otherwise AQE splits a hot path.
    """
    dims = image_dims.select(
        F.col("path").alias("_path"), F.col("status").alias("_status"),
        F.when(F.col("status") == I.OK, I.tile_tokens())
        .alias("tile_tokens"))
    return (rows.join(dims, F.col(path) == F.col("_path"), "left")
            .withColumn("status", F.coalesce("_status", F.lit(I.MISSING)))
            .drop("_path", "_status"))


def shown_images(images, window, first_image):
    """From the last window+1 images the ones a prefix shows; short prefixes show all."""
    check_first_image(first_image)
    cut = (F.slice(images, 2, window) if first_image == "aligned"
           else F.concat(F.slice(images, 1, 1), F.slice(images, 3, window)))
    return F.when(F.size(images) > window, cut).otherwise(images)


def image_windows(steps: DataFrame, window=WINDOW, first_image="coded", chunk=CHUNK,
                  image_root=None) -> DataFrame:
    """Image paths per prefix from flat steps: one shuffle on (task, chunk)."""
    rows = steps.select("task_id", F.col("pos").cast("long").alias("pos"),
                        X.join_root(image_root, F.col("image")).alias("image"))
    recent = F.collect_list("image").over(chunk_window().rowsBetween(-window, 0))
    return (with_halo(rows, window, chunk).withColumn("images", recent).filter(~F.col("halo"))
            .select("task_id", (F.col("pos") + 1).alias("prefix_len"),
                    shown_images(F.col("images"), window, first_image).alias("images")))


def prefix_sizes(measures: DataFrame, image_dims: DataFrame, n_counters=1, offsets=None,
                 heads=None, window=WINDOW, first_image="coded", chunk=CHUNK,
                 keep=()) -> DataFrame:
    """One row per prefix: text_tokens_<i> and the shown images with their tile tokens.

    Two shuffles of numbers: on the image path (none if the sizes are broadcast) and on
    (task, chunk). The second also serves the join with `heads`, the other part of flat sizes,
    or with `offsets`, the history before each chunk of nested ones whose counters cannot run
    inside a row. Without both, the measures bring that history themselves.
    """
    w = chunk_window()
    previous, before = w.rowsBetween(-window, -1), w.rowsBetween(Window.unboundedPreceding, -1)

    def over(value, frame):
        # A step that could not be counted makes every prefix that repeats it uncountable.
        gaps = F.coalesce(F.count_if(value.isNull()).over(frame), F.lit(0))
        return F.when(gaps == 0, F.coalesce(F.sum(value).over(frame), F.lit(0)))

    names = offset_names(_names(("joined",), n_counters))
    carried = names if offsets is None else []
    image = F.struct(F.col("image").alias("path"), "tile_tokens", "status")
    rows = with_halo(with_dims(measures, image_dims), window, chunk)
    if heads is not None:
        rows = rows.join(heads, ["task_id", "chunk"])
    sums = []
    for i in range(n_counters):
        joined = F.col(f"joined_{i}")
        head = F.when(F.col("pos") < window, F.col(f"head_first_{i}")).otherwise(
            F.col(f"head_rest_{i}"))
        sums.append((head + F.col(f"target_{i}") + over(F.col(f"block_{i}"), previous)
                     + over(F.when(F.col("halo"), 0).otherwise(joined), before)
                     - over(joined, previous)).alias(f"_text_{i}"))
    rows = rows.select("task_id", *keep, "chunk", "halo", "pos", *carried, *sums,
                       F.collect_list(image).over(w.rowsBetween(-window, 0)).alias("images"))
    rows = rows.filter(~F.col("halo"))
    if offsets is not None:
        rows = rows.join(offsets, ["task_id", "chunk"], "left").fillna(0, subset=names)
    return rows.select(
        "task_id", *keep, (F.col("pos") + 1).alias("prefix_len"),
        *[F.when(F.col(f"joined_{i}_gaps") == 0, F.col(f"_text_{i}") + F.col(f"joined_{i}_before"))
          .cast("long").alias(tokens_column(i)) for i in range(n_counters)],
        shown_images(F.col("images"), window, first_image).alias("images"))


def prefix_shares(measures: DataFrame, n_counters=1, window=WINDOW, first_image="coded",
                  min_prefix=0, full_only=False) -> DataFrame:
    """What each step adds to the totals over the emitted prefixes of its task, in closed form.

    A prefix is named by the position p of its last step; p runs from `min_prefix` (from the
    last position with `full_only`) to the end of the task. The step at position j is the last
    turn of prefix j, a recent turn of the next k and in the history of all later ones; the
    shares count how many of each are emitted. Narrow, so totals need no window at all.
    """
    check_first_image(first_image)
    pos, last = F.col("pos"), F.col("n_steps") - 1
    first = F.lit(min_prefix).cast("long")
    first = F.greatest(first, last) if full_only else first

    def emitted(low, high):
        return F.greatest(F.least(high, last) - F.greatest(low, first) + 1, F.lit(0))
    own = emitted(pos, pos)
    as_history, as_recent = emitted(pos + window + 1, last), emitted(pos + 1, pos + window)
    if first_image == "aligned":
        shown = emitted(pos, pos + window - 1)
    else:
        start = F.lit(window - 1)
        shown = (emitted(pos, pos + window - 2) + emitted(pos + window, pos + window)
                 + F.when(pos == 0, emitted(start, start)).otherwise(0))
    texts = []
    for i in range(n_counters):
        head = F.when(F.col("pos") < window, F.col(f"head_first_{i}")).otherwise(
            F.col(f"head_rest_{i}"))
        texts.append((own * (head + F.col(f"target_{i}")) + as_history * F.col(f"joined_{i}")
                      + as_recent * F.col(f"block_{i}")).cast("long").alias(tokens_column(i)))
    return measures.select(*[c for c in measures.columns if not c.startswith(
        ("head_", "joined_", "block_", "target_"))], *texts, shown.cast("long").alias("shown"),
        own.cast("long").alias("rows"))
