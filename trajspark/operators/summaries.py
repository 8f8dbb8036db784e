"""Task summaries: everything the totals of a task need, in one row that adds up.

What a step adds to the totals of its task depends on the task's length only for the last steps,
and for the history, which is linear in the length. So steps are summed as if their task never
ended, next to the sums that stand for the linear part. The latest step at each position modulo the
window is kept: at the end these are the last steps, and what a task of its true length does not
emit is taken back. All of it merges in any order, so a task is summed wherever its steps lie and
one row per task and place is shuffled; no step is joined with its task.

With window k, last position L, and d = L - j for step j, a prefix p repeats step j in its history
from p = j+k+1 and shows its block for k prefixes before. Cut off at L that is

    joined[j] * (L-j-k) + block[j] * k      for d >= k
    block[j] * d                            for d < k, which is (k-d) * (joined[j] - block[j]) more
"""

from pyspark.sql import DataFrame, functions as F

from trajspark.functions import images as I
from trajspark.operators.expand import check_first_image
from trajspark.operators.measure import counted_steps, head_counts, with_dims
from trajspark.operators.tokens import tokens_column

# Tiles an image can have, by the tiling rule; the two classes after them have no tile count.
TILES = sorted({a * b for a in range(I.MAX_SIDE // I.TILE_SIDE + 1)
                for b in range(-(-I.SHORT_SIDE // I.TILE_SIDE) + 1)})
CLASSES = [(I.OK, I.BASE_TOKENS + I.TILE_TOKENS * n) for n in TILES] + [
    (I.CORRUPT, None), (I.MISSING, None)]
PACKED = 16             # a kept step's position and class share a number
assert len(CLASSES) <= PACKED

# SQL text, so that one parse replaces many column calls.
_TILE_CASES = " ".join(f"WHEN {tokens} THEN {k}" for k, (status, tokens) in enumerate(CLASSES)
                       if status == I.OK)
CLASS = (f"CASE status WHEN '{I.OK}' THEN CASE tile_tokens {_TILE_CASES} ELSE raise_error("
         f"concat('no image has so many tokens: ', tile_tokens)) END "
         f"WHEN '{I.CORRUPT}' THEN {len(CLASSES) - 2} ELSE {len(CLASSES) - 1} END")


class Shares:
    """SQL text of how often a step is shown, told and repeated over the emitted prefixes of its
    task, a prefix being named by the position of its last step. With `ends` the task ends at
    `last`, without it nowhere."""

    def __init__(self, window, first_image, min_prefix, full_only):
        self.window, self.aligned = window, check_first_image(first_image) == "aligned"
        self.min_prefix, self.full_only = min_prefix, full_only
        # Of a whole trajectory the window's steps and the one before them are told apart.
        self.kept = window + 1 if full_only else window

    def from_first(self, pos, ends=False):
        """`pos`, or the first prefix that is emitted if that comes later."""
        if self.full_only and ends:
            return f"greatest({pos}, {self.min_prefix}L, last)"
        return f"greatest({pos}, {self.min_prefix}L)" if self.min_prefix else pos

    def _emitted(self, low, high, ends):
        if self.full_only and not ends:
            return "0L"                     # the one prefix is that of the last step
        high = f"least({high}, last)" if ends else high
        return f"greatest({high} - {self.from_first(low, ends)} + 1, 0L)"

    def own(self, pos):
        return self._emitted(pos, pos, False)

    def recent(self, pos):
        return self._emitted(f"({pos} + 1)", f"({pos} + {self.window}L)", False)

    def shown(self, pos, ends=False):
        def emitted(low, high):
            return self._emitted(low, high, ends)
        k, start = self.window, f"{self.window - 1}L"
        if self.aligned:
            return emitted(pos, f"({pos} + {k - 1}L)")
        return (f"({emitted(pos, f'({pos} + {k - 2}L)')} + "
                f"{emitted(f'({pos} + {k}L)', f'({pos} + {k}L)')} + "
                f"IF({pos} = 0, {emitted(start, start)}, 0L))")


def sum_steps(counted: DataFrame, n_counters, shares: Shares) -> DataFrame:
    """One summary per task of rows (task_id, pos, joined_<i>, block_<i>, target_<i>, class)."""
    counters, k = range(n_counters), shares.window
    rows = counted.selectExpr(
        "task_id", "pos", "class", f"{shares.shown('pos')} AS shown", f"{shares.own('pos')} AS own",
        *[f"joined_{i}" for i in counters], *[f"joined_{i} - block_{i} AS edge_{i}" for i in counters],
        *[f"joined_{i} * {shares.from_first(f'(pos + {k + 1}L)')} AS placed_{i}" for i in counters],
        *[f"{shares.own('pos')} * target_{i} + {shares.recent('pos')} * block_{i} AS text_{i}"
          for i in counters],
        *[f"target_{i} - joined_{i} AS end_{i}" for i in counters])
    parts = ["max(pos) AS last", "sum(own) AS rows", f"sum(IF(pos < {k}, own, 0L)) AS first_rows"]
    for i in counters:
        parts += [f"sum({c}_{i}) AS {c}_{i}" for c in ("joined", "placed", "text")]
        parts.append(f"count_if(edge_{i} IS NULL OR end_{i} IS NULL) AS gaps_{i}")
        if shares.full_only:
            parts.append(f"max_by(end_{i}, pos) AS end_{i}")
    if not shares.full_only:
        parts += [f"sum(IF(class = {c}, shown, 0L)) AS shown_{c}" for c in range(len(CLASSES))]
    for r in range(shares.kept):
        here = f"IF(pmod(pos, {shares.kept}L) = {r}, pos, NULL)"
        parts.append(f"max({here} * {PACKED}L + class) AS place_{r}")
        parts += [f"max_by(edge_{i}, {here}) AS edge_{r}_{i}" for i in counters]
    return rows.groupBy("task_id").agg(*[F.expr(p) for p in parts])


def task_totals(summaries: DataFrame, n_counters, shares: Shares, keep=()) -> DataFrame:
    """Totals of tasks from their summaries with the counts of their heads: rows, text_tokens_<i>
    and shown_<class>; `gap` says that something could not be counted."""
    k, counters, kept = shares.window, range(n_counters), range(shares.kept)
    emits = f"last >= {shares.min_prefix}L"
    n_rows, n_first = ("1L", f"IF(last < {k}, 1L, 0L)") if shares.full_only else ("rows", "first_rows")
    texts, gaps = [], []
    for i in counters:
        head = f"head_first_{i} * {n_first} + head_rest_{i} * ({n_rows} - {n_first})"
        # Distances from the end run from 0; a short task has fewer steps to take back.
        if shares.full_only:
            body = f"joined_{i} + end_{i}" + "".join(
                f" - IF(last - pos_{r} BETWEEN 1 AND {k}, edge_{r}_{i}, 0L)" for r in kept)
        else:
            body = f"text_{i} + joined_{i} * (last + 1) - placed_{i}" + "".join(
                f" + IF(last - pos_{r} < {k}, ({k} - last + pos_{r}) * edge_{r}_{i}, 0L)" for r in kept)
        texts.append(f"IF({emits}, {head} + {body}, 0L) AS {tokens_column(i)}")
        gaps.append(f"gaps_{i} > 0 OR head_first_{i} IS NULL OR head_rest_{i} IS NULL")
    placed = summaries.selectExpr("*", *[f"place_{r} DIV {PACKED} AS pos_{r}" for r in kept],
                                  *[f"place_{r} % {PACKED} AS class_{r}" for r in kept])
    back = {r: shares.shown(f"pos_{r}", True) + ("" if shares.full_only
                                                else f" - {shares.shown(f'pos_{r}')}") for r in kept}
    placed = placed.selectExpr("*", *[f"{back[r]} AS back_{r}" for r in kept])
    shown = []
    for c in range(len(CLASSES)):
        count = " + ".join(([] if shares.full_only else [f"shown_{c}"])
                           + [f"IF(class_{r} = {c}, back_{r}, 0L)" for r in kept])
        shown.append(f"IF({emits}, {count}, 0L) AS shown_{c}")
    return placed.selectExpr("task_id", *keep, " OR ".join(gaps) + " AS gap",
                             f"IF({emits}, {n_rows}, 0L) AS rows", *texts, *shown)


def summarize_steps(tasks: DataFrame, steps: DataFrame, image_dims: DataFrame, level, counters,
                    shares: Shares, prompts=None, image_root=None, keep=(),
                    layout="coded") -> DataFrame:
    """One row of totals per task of flat tables that has steps; see `task_totals`.

    Exchanges: the lookup of image sizes (none if they are broadcast; a hot screenshot is split by
    adaptive execution), one of partial summaries, one of tasks.
    """
    counted = with_dims(counted_steps(steps, level, counters, image_root, layout), image_dims)
    sums = sum_steps(counted.withColumn("class", F.expr(CLASS)), len(counters), shares)
    heads = tasks.select("task_id", *keep, *head_counts(level, prompts, counters, layout))
    return task_totals(heads.join(sums, "task_id"), len(counters), shares, keep)


def by_class(totals: DataFrame, n_counters, by=()) -> DataFrame:
    """Sums over tasks as one row per group and image class: tile_tokens, status, shown and, on
    the first class, rows and text_tokens_<i>."""
    whole = ["rows", *[tokens_column(i) for i in range(n_counters)]]
    sums = totals.groupBy(*by).agg(*[F.sum(c).alias(c) for c in (
        *whole, *[f"shown_{c}" for c in range(len(CLASSES))])])
    each = ", ".join(
        f"named_struct('tile_tokens', {'CAST(NULL AS BIGINT)' if tokens is None else f'{tokens}L'}, "
        f"'status', '{status}', 'shown', shown_{c}, "
        + ", ".join(f"'{n}', {'0L' if c else n}" for n in whole) + ")"
        for c, (status, tokens) in enumerate(CLASSES))
    return sums.select(*by, F.expr(f"inline(array({each}))"))
