"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared in blocks: distinct fingerprints are dealt into cells by the population
counts of their four 16-bit quarters, cells into tiles of a bounded size, and two tiles meet only
if their counts differ by no more than the radius (the sum over the quarters is never above the
number of differing bits, so no link is lost). Tiles are compared with numpy's exclusive-or and
bit counts. A tile pair emits a spanning forest of its links instead of all of them.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from trajspark.llm.common import cut, free_name, numbered, stored
from trajspark.llm.components import components, merged

WORDS = 3            # words of a shingle
RADIUS = 2           # differing bits of linked fingerprints
TILE = 2048          # fingerprints of a tile, on average at most
SEED = 42


def fingerprint(text, words=WORDS):
    """64-bit SimHash of the shingles of `text` as an unsigned int; None counts as empty."""
    tokens = (text or "").encode("utf-8", "replace").lower().split()    # ASCII only, both
    if not tokens:
        return 0
    joined, n = b" ".join(tokens), max(1, len(tokens) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(words, len(tokens)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in
                           zip(starts[k:k + (1 << 16)], ends[k:k + (1 << 16)])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text="text", name="fp", words=WORDS) -> DataFrame:
    """Adds the fingerprint as a signed long; null and blank texts have fingerprint zero."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint(t.as_py(), words) for t in texts), np.uint64, len(texts))
        return pa.array(out.view(np.int64))
    return docs.withColumn(name, of(F.col(text)))


def _cell(fp):
    """One number for the population counts of the four quarters; 32 apart, so that neighbours
    of a cell never run into a foreign one."""
    parts = [F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF)))
             * F.lit(32 ** k) for k in range(4)]
    return sum(parts[1:], parts[0])


def _neighbours(radius):
    """Steps to the cells that a cell is compared with, each pair of cells once."""
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=4)
             if sum(map(abs, d)) <= radius and d >= (0, 0, 0, 0)]
    return [sum(x * 32 ** k for k, x in enumerate(d)) for d in steps]


def _forest(radius):
    """Tile pairs -> the links of a spanning forest of each."""
    def run(batches):
        for batch in batches:
            left, right = batch.column("left"), batch.column("right")
            for k in range(batch.num_rows):
                a = left[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                b = right[k].values.to_numpy(zero_copy_only=False).view(np.uint64)
                nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
                at_a, at_b, label = at[:len(a)], at[len(a):], np.arange(len(nodes))
                rows = max(1, (1 << 17) // len(b))
                for r in range(0, len(a), rows):
                    near = np.bitwise_count(a[r:r + rows, None] ^ b[None, :]) <= radius
                    i, j = np.nonzero(near)
                    label = merged(label, at_a[r + i], at_b[j])
                own = np.flatnonzero(label != np.arange(len(nodes)))
                if len(own):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes[own].view(np.int64)),
                         pa.array(nodes[label[own]].view(np.int64))], ["a", "b"])
    return run


def links(fps: DataFrame, radius=RADIUS, tile=TILE) -> DataFrame:
    """(a, b) links among distinct fingerprints `fp`, enough to join all that are reachable.

    The counts of cells are broadcast: there are at most 17^4 of them, whatever the input.
    """
    cells = fps.select("fp", _cell(F.col("fp")).alias("cell"))
    counts = cut(cells.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("tiles")))
    tiles = (cells.join(F.broadcast(counts), "cell")
             .groupBy("cell", F.pmod(F.xxhash64("fp"), "tiles").alias("tile"))
             .agg(F.collect_list("fp").alias("left")))
    tiles = cut(tiles)
    others = tiles.select(
        F.explode(F.array(*[F.lit(s) for s in _neighbours(radius)])).alias("step"),
        (F.col("cell") + F.col("step")).alias("cell"), F.col("tile").alias("other"),
        F.col("left").alias("right"))
    # The counts say which tiles a tile meets: it goes to each of them by cell and tile, so that
    # a cell of any size is spread over as many keys as it has tiles.
    last = F.when(F.col("step") == 0, F.col("other")).otherwise(F.col("tiles") - 1)
    others = others.join(F.broadcast(counts), "cell").select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("tile"), "right")
    pairs = tiles.join(others, ["cell", "tile"])
    return pairs.select("left", "right").mapInArrow(_forest(radius), "a long, b long")


def groups(rows: DataFrame, radius=RADIUS, tile=TILE) -> DataFrame:
    """(fp, doc_id) -> (fp, component_id, first), one row per distinct fingerprint: the smallest
    doc_id reachable, nulls last, and the smallest of `_row` that has it."""
    own = cut(rows.groupBy("fp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "_row")).alias("least")))
    roots = components(links(own.select("fp"), radius, tile))
    own = own.join(roots, own["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    least = own.groupBy("root").agg(F.min("least").alias("least"))
    return own.drop("least").join(least, "root").select(
        "fp", F.col("least.doc_id").alias("component_id"), F.col("least._row").alias("first"))


def simhash_components(docs: DataFrame, radius=RADIUS, words=WORDS, tile=TILE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Rows with null, blank or equal texts share a fingerprint and so a component. Repeated rows
    are returned as often as they occur. A component without any doc_id has a null component_id.
    Other columns are ignored. An empty table gives an empty result.
    """
    rows = cut(numbered(fingerprints(docs.select("doc_id", "text"), words=words).drop("text")))
    found = groups(rows, radius, tile)
    return rows.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, radius=RADIUS, words=WORDS, tile=TILE) -> DataFrame:
    """The rows of `docs`, all columns, with one row left of every component: that of its
    smallest doc_id, and one only of repeated rows."""
    fp, row = free_name(docs, "_fp"), free_name(docs, "_row")
    full = stored(numbered(fingerprints(docs, name=fp, words=words), row))
    found = groups(full.select(F.col(fp).alias("fp"), "doc_id", F.col(row).alias("_row")),
                   radius, tile)
    kept = found.select(F.col("first").alias(row)).distinct()
    return full.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
