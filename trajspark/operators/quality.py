"""Filters, checks and quarantine splits."""

from operator import itemgetter

from pyspark.sql import Column, DataFrame, functions as F

from trajspark.settings import MIN_SCORE, check_level

CORRUPT_COLUMN = "_corrupt_record"


def keep_scored(trajectories: DataFrame, min_score=MIN_SCORE) -> DataFrame:
    """Alignment filter; a null score is dropped. Pushed into the scan by Catalyst."""
    return trajectories.filter(F.col("alignment_score") >= min_score)


def trajectory_problem(level, min_prefix=0, full_only=False) -> Column:
    """Why a nested trajectory cannot be expanded at this level, or null.

    Every step needs its index, image and action; only steps that end an emitted prefix need
    their code and, depending on the level, thought and observation.
    """
    check_level(level)
    needed = {"L1": ["code"], "L2": ["thought", "code"],
              "L3": ["observation", "thought", "code"]}[level]
    traj = F.col("traj")
    first = F.greatest(F.size(traj), F.lit(1)) if full_only else F.lit(min_prefix + 1)
    ends = F.slice(traj, first, F.greatest(F.size(traj), F.lit(0)))

    def has_null(steps, get):
        return F.exists(steps, lambda s: get(s).isNull())
    reason = F.when(traj.isNull(), F.lit("null traj"))
    reason = reason.when(F.size(traj) == 0, F.lit(None).cast("string"))
    reason = reason.when(F.col("instruction").isNull(), F.lit("null instruction"))
    for name in ("index", "image"):
        reason = reason.when(has_null(traj, itemgetter(name)), F.lit(f"null {name}"))
    reason = reason.when(has_null(traj, lambda s: s["value"].getField("action")),
                         F.lit("null action"))
    for name in needed:  # applied at once, so the loop variable is safe in the lambda
        reason = reason.when(has_null(ends, lambda s: s["value"].getField(name)),
                             F.lit(f"null {name}"))
    return reason


def split_valid(trajectories: DataFrame, level, strict=False, min_prefix=0, full_only=False):
    """(usable, quarantine with `reason`); strict raises on the first bad trajectory."""
    tagged = trajectories.withColumn("reason", trajectory_problem(level, min_prefix, full_only))
    bad = tagged.filter(F.col("reason").isNotNull())
    if strict:
        first = bad.select("task_id", "reason").take(1)
        if first:
            raise ValueError(f"trajectory {first[0].task_id}: {first[0].reason}")
    return tagged.filter(F.col("reason").isNull()).drop("reason"), bad


def corrupt_records(frame: DataFrame) -> DataFrame:
    """Lines the reader could not parse, kept aside instead of vanishing in a filter.

    Spark refuses to read nothing but that column, so the filter needs another one as well.
    """
    return frame.filter(F.col(CORRUPT_COLUMN).isNotNull() & _always(frame))


def _always(frame):
    other = next(c for c in frame.columns if c != CORRUPT_COLUMN)
    return F.xxhash64(other) >= F.lit(-(1 << 63))


def split_readable(frame: DataFrame, strict=False):
    """(parsed rows, unparsed lines with `reason`) of a frame whose reader kept broken lines;
    (frame, None) of any other. `strict` raises on the first broken line."""
    if CORRUPT_COLUMN not in frame.columns:
        return frame, None
    broken = corrupt_records(frame)
    if strict:
        first = broken.take(1)
        if first:
            raise ValueError(f"unreadable line: {first[0][CORRUPT_COLUMN][:200]}")
    return (frame.filter(F.col(CORRUPT_COLUMN).isNull() & _always(frame)).drop(CORRUPT_COLUMN),
            broken.withColumn("reason", F.lit("unreadable")))


def missing_images(needed: DataFrame, image_dims: DataFrame, path="path") -> DataFrame:
    """Distinct needed paths that have no file. Deduplicated before the shuffle to the join."""
    return (needed.select(F.col(path).alias("path")).distinct()
            .join(image_dims.select("path"), "path", "left_anti"))


def require_images(needed: DataFrame, image_dims: DataFrame, path="path") -> DataFrame:
    """Strict form: fail the job when a needed image does not exist."""
    first = missing_images(needed, image_dims, path).take(1)
    if first:
        raise FileNotFoundError(f"expected image does not exist: {first[0].path}")
    return needed


def unknown_models(requests: DataFrame, models, column="model") -> DataFrame:
    """Requested labels outside the rate table, with the supported ones listed.

    The rate table is a driver-side dict, so membership is a literal IN list, not a join.
    """
    asked = F.col(column)
    return (requests.filter(asked.isNotNull() & ~asked.isin(list(models)))
            .groupBy(asked.alias("model")).agg(F.count(F.lit(1)).alias("requests"))
            .withColumn("supported", F.lit(", ".join(sorted(models)))))


def split_counted(rows: DataFrame, tokens="text_tokens"):
    """(counted, failed): a row whose count is null could not be encoded and is set aside."""
    return rows.filter(F.col(tokens).isNotNull()), rows.filter(F.col(tokens).isNull())
