"""Order statistics and numbering by key, without a sort of all rows in one place and without a
checkpoint.

Both draw a few keys as pivots and then count exactly. What is drawn only decides how fast it goes,
never the result, and the pivots are literals of the plans that follow, so a lost task finds the
same places again. Keys are columns in their natural order, ascending and nulls first.
"""

from pyspark.sql import DataFrame, Window, functions as F, types as T

SMALL = 100_000         # rows that are sorted without more ado
DIRECT = 100            # first rows that every task may hold at once
DRAWN = 4096            # keys drawn in a round, on average
ROWS_PER_RANGE = 1_000_000
MOST_RANGES = 4096


def _place(keys):
    return F.struct(*keys)


def _literal(rows, key, keys):
    return F.struct(*[F.lit(key[c]).cast(rows.schema[c].dataType).alias(c) for c in keys])


def _drawn(rows, keys, total, wanted, seed):
    """About `wanted` of the keys in order; a bounded number on the driver, whatever the input."""
    share = min(1.0, wanted / max(1, total))
    return rows.sample(False, share, seed).orderBy(*keys).collect()


def nth_key(rows: DataFrame, n, keys):
    """The values of `keys` in the n-th row in their order (from 1), or None if there are no more
    rows. Ties and nulls count row by row.

    Every round draws keys, takes three around the wanted rank as pivots and counts the rows below
    and at each; only the stretch that holds the n-th row goes on, until it is small. A round reads
    the keys and shuffles counts; a key that a third of all rows share is a pivot of its own.
    """
    keys = list(keys)
    rows = rows.select(*keys)
    if n <= DIRECT:
        first = rows.orderBy(*keys).limit(n).collect()
        return first[n - 1] if len(first) == n else None
    left, total, seed = rows, rows.count(), 1
    if total < n:
        return None
    while total > SMALL:
        drawn = _drawn(left, keys, total, DRAWN, seed)
        seed += 1
        if not drawn:
            continue
        rank = n / total * len(drawn)
        margin = 3 * (len(drawn) ** 0.5) / 2 + 1
        at = [min(len(drawn) - 1, max(0, round(r))) for r in (rank - margin, rank, rank + margin)]
        pivots = [drawn[k] for k in sorted(set(at))]
        place = _place(keys)
        marks = [_literal(rows, p, keys) for p in pivots]
        counts = left.agg(*[F.count_if(place < m) for m in marks],
                          *[F.count_if(place <= m) for m in marks]).first()
        below, upto = counts[:len(marks)], counts[len(marks):]
        for k, pivot in enumerate(pivots):
            if below[k] < n <= upto[k]:
                return pivot
        # The n-th row lies before the first pivot that has it below, after the one before that.
        after = sum(c < n for c in upto)
        if after < len(marks):
            left = left.filter(place < marks[after])
        if after:
            left = left.filter(place > marks[after - 1])
            n -= upto[after - 1]
        total = (below[after] if after < len(marks) else total) - (upto[after - 1] if after else 0)
    return left.orderBy(*keys).offset(n - 1).limit(1).first()


def _range_of(rows, keys, pivots):
    """How many pivots are not above a row's key, by bisection of the literal array."""
    if not pivots:
        return F.lit(0)
    marks, place = F.array(*[_literal(rows, p, keys) for p in pivots]), _place(keys)
    begin = F.struct(F.lit(0).alias("low"), F.lit(len(pivots)).alias("high"))

    def halved(s, _):
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        passed = F.get(marks, middle) <= place
        open_ = s["low"] < s["high"]
        return F.struct(F.when(open_ & passed, middle + 1).otherwise(s["low"]).alias("low"),
                        F.when(open_ & ~passed, middle).otherwise(s["high"]).alias("high"))
    rounds = F.sequence(F.lit(1), F.lit(len(pivots).bit_length()))
    return F.aggregate(rounds, begin, halved)["low"]


def dense_numbers(rows: DataFrame, keys, name="conversation_id",
                  rows_per_range=ROWS_PER_RANGE) -> DataFrame:
    """Adds the 0-based position in the order of `keys`, ties by the hash of all columns.

    Two passes: ranges of keys are counted first, then rows are numbered inside their range and the
    sizes of the ranges before are added. The second pass is one shuffle of the rows and a sort in
    each range. Rows that agree in all keys lie in one range, so keys should tell rows apart.
    """
    keys = list(keys)
    only = rows.select(*keys)
    total = only.count()
    ranges = min(MOST_RANGES, -(-total // rows_per_range))
    pivots = []
    if ranges > 1:
        drawn = _drawn(only, keys, total, 32 * ranges, 1)
        pivots = sorted({len(drawn) * k // ranges for k in range(1, ranges)} if drawn else ())
        pivots = [drawn[k] for k in pivots]
        pivots = [p for k, p in enumerate(pivots) if not k or p != pivots[k - 1]]
    counts = dict(only.groupBy(_range_of(rows, keys, pivots).alias("r")).count().collect())
    before = [sum(counts.get(k, 0) for k in range(r)) for r in range(len(pivots) + 1)]
    hashed = [f.name for f in rows.schema if not isinstance(f.dataType, T.MapType)]
    numbered = rows.withColumn("_range", _range_of(rows, keys, pivots))
    inside = Window.partitionBy("_range").orderBy(*keys, F.xxhash64(*[F.col(f"`{c}`") for c in hashed]))
    start = F.element_at(F.array(*[F.lit(b).cast("long") for b in before]), F.col("_range") + 1)
    return numbered.withColumn(name, start + F.row_number().over(inside) - 1).drop("_range")
