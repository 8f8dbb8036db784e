"""Mixing sources to target weights by balanced (cube method) sampling.

Every source gets a share of all words by its weight, at most `max_repeat` times its own size. The
share over the size is the expected number of copies of each of its documents: the whole part is
taken for certain, the fraction is an inclusion probability. A flight moves these probabilities
along the null space of two constraints, words and documents, until they are 0 or 1. Flights run
over blocks of bounded size and leave a few rows each; these fly again, and the last few of a source
are a small landing problem, solved over all its choices.
"""

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from trajspark.llm.common import broadcast_if_small, cut, free_name, numbered, stored
from trajspark.operators.sequences import dense_ids

WEIGHTS = (5, 2, 1)      # by source in code point order, repeating
MAX_REPEAT = 3
BLOCK = 4096             # rows of a flight, on average at most
LEFT = 14                # rows that a flight leaves, and so of the landing problem
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"


def source_table(rows: DataFrame, weights=WEIGHTS, max_repeat=MAX_REPEAT) -> DataFrame:
    """(source, size) -> one row per source: source, ord, n, source_size and target.

    Sources stand in code point order, null last; sources over their cap get the cap and the
    rest is shared by weight among the others until none is above.
    """
    sizes = rows.groupBy("source").agg(F.count("*").alias("n"),
                                       F.sum("size").alias("source_size"))
    placed = dense_ids(sizes, [F.col("source").asc_nulls_last()], name="ord")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("ord") % len(weights) + 1).cast("int"))
    placed = cut(placed.withColumn("weight", weight))
    cap = F.col("source_size") * max_repeat
    total, share = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    fixed, level = 0, None
    while share and level != (total - fixed) / share:
        level = (total - fixed) / share
        above = F.col("weight") * F.lit(level) > cap
        fixed, share = placed.agg(F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
                                  F.sum(F.when(~above, F.col("weight")))).first()
    target = F.least(F.col("weight") * F.lit(float(level or 0)), cap.cast("double"))
    return placed.select("source", "ord", "n", "source_size", target.alias("target"))


def flight(chance, size, seed, leave=2):
    """Moves the probabilities in `chance` until at most `leave` (2 or more) are fractional,
    keeping their sum and their sum weighted by `size` (up to rounding); `seed` draws the
    directions."""
    draw, tiny = random.Random(seed), 1e-9
    chance = [0.0 if c < tiny else 1.0 if c > 1 - tiny else float(c) for c in chance]
    size = [float(s) for s in size]
    moving, waiting = [], [k for k in reversed(range(len(chance))) if 0 < chance[k] < 1]
    while len(moving) + len(waiting) > leave:
        moving.append(waiting.pop())
        while len(moving) == 3:
            i, j, l = moving
            step = (size[l] - size[j], size[i] - size[l], size[j] - size[i])
            if step == (0.0, 0.0, 0.0):
                step = (1.0, -1.0, 0.0)
            up = down = float("inf")
            for m, s in zip(moving, step):
                if s:
                    room, back = (1 - chance[m]) / abs(s), chance[m] / abs(s)
                    up, down = min(up, room if s > 0 else back), min(down,
                                                                    back if s > 0 else room)
            by = up if draw.random() * (up + down) < down else -down
            for m, s in zip(moving, step):
                c = chance[m] + by * s
                chance[m] = 0.0 if c < tiny else 1.0 if c > 1 - tiny else c
            moving = [m for m in moving if 0 < chance[m] < 1]
    return chance


def landing(chance, size):
    """Decides what a flight left open: of all choices that miss less than one document the one
    that misses the fewest words."""
    left = [k for k, c in enumerate(chance) if 0 < c < 1]
    share, words = np.array([chance[k] for k in left]), np.array([size[k] for k in left])
    picks = np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1
    off = picks - share
    miss = np.abs(off @ words) + np.where(np.abs(off.sum(axis=1)) < 1, 0.0, np.inf)
    for k, t in zip(left, picks[miss.argmin()]):
        chance[k] = float(t)
    return chance


def _fly(land, columns=("_row", "ord", "size", "h", "chance")):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows[list(columns)].sort_values(["h", "_row"], kind="stable")
        seed = SEED + sum(int(k) * (1 << 20) ** i for i, k in enumerate(key)) + land
        size = rows["size"].to_numpy(np.float64)
        chance = flight(rows["chance"].tolist(), size, seed, LEFT)
        return rows.assign(chance=landing(chance, size) if land else chance)
    return run


def _flown(rows, block):
    """`chance` of every row becomes 0 or 1."""
    schema, done, level = rows.schema, [], 0
    while True:
        per_source = cut(rows.groupBy("ord").agg(F.count("*").alias("rows")))
        most = per_source.agg(F.max("rows")).first()[0] or 0
        if most <= block:
            break
        blocks = F.ceil(F.col("rows") / block)
        dealt = rows.join(broadcast_if_small(per_source, 64), "ord").withColumn(
            "block", F.pmod(F.xxhash64("h", F.lit(level)), blocks))
        flown = cut(dealt.groupBy("ord", "block").applyInPandas(_fly(False), schema))
        done.append(flown.filter("chance in (0, 1)"))
        rows, level = flown.filter("chance not in (0, 1)"), level + 1
    out = rows.groupBy("ord").applyInPandas(_fly(True), schema)
    for part in done:
        out = out.union(part)
    return out


def plan(rows: DataFrame, weights=WEIGHTS, max_repeat=MAX_REPEAT, block=BLOCK) -> DataFrame:
    """Rows with `_row`, `source`, `size` and `h` (what orders and draws them) plus source_size,
    target and `copies`, how often the mix takes the row."""
    sources = cut(source_table(rows, weights, max_repeat))
    ratio = F.when(F.col("source_size") > 0, F.least(
        F.col("target") / F.col("source_size"), F.lit(float(max_repeat)))).otherwise(0.0)
    placed = rows.join(broadcast_if_small(sources, 256),
                       rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    placed = cut(placed.withColumn("_ratio", ratio))
    chances = placed.select("_row", "ord", "size", "h",
                            (F.col("_ratio") - F.floor("_ratio")).alias("chance"))
    picked = _flown(chances, block).select("_row", "chance")
    return placed.join(picked, "_row").withColumn(
        "copies", (F.floor("_ratio") + F.col("chance")).cast("long")).drop("_ratio", "n")


def _sized(docs, row):
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    h = F.xxhash64("doc_id", "source", "text")
    return numbered(docs.withColumns({"size" + row: size, "h" + row: h}), row)


def mixture(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken (words taken, copies counted) per row.

    Null texts have size 0; such rows and blank ones are drawn for the document total alone. A
    null source is a source, the last one. Repeated rows are drawn one by one; which of several
    equal ones is taken does not show. A corpus without words has targets of 0 and takes
    nothing. Other columns are ignored; an empty table gives an empty result. The draw depends
    on the rows alone, so reruns agree.
    """
    rows = cut(_sized(docs.select("doc_id", "source", "text"), "_row").select(
        "_row", "doc_id", "source", F.col("size_row").alias("size"),
        F.col("h_row").alias("h")))
    return plan(rows, **options).select("doc_id", "source", "size", "source_size", "target",
                                        "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, all columns; a row taken more than once is repeated."""
    row = free_name(docs, "_row")
    full = stored(_sized(docs, row))
    rows = full.select(F.col(row).alias("_row"), "source", F.col("size" + row).alias("size"),
                       F.col("h" + row).alias("h"))
    taken = cut(plan(rows, **options).filter("copies > 0").select(
        F.col("_row").alias(row), F.col("copies").alias("copies" + row)))
    return (full.join(broadcast_if_small(taken, 64), row)
            .withColumn("copy" + row, F.explode(F.sequence(F.lit(1), F.col("copies" + row))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
