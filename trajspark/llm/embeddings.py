"""Embedding near-duplicates by int8 tile products with error bounds.

Distinct vectors are scaled to unit length and quantised to int8 once; each keeps the exact length
of its quantisation error, which bounds how far a product of quantised vectors is from the cosine.
Within a label they are dealt into tiles of bounded size, and every two tiles meet once, as codes.
Pairs surely above the threshold are links, pairs surely below it are none. A tile pair with pairs
in doubt names the vectors concerned; only these come together again, in full precision. Both
passes emit link counts and a spanning forest of the links, never the pairs.
"""

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from trajspark.llm.common import broadcast_if_small, cut, stored, numbered
from trajspark.llm.components import components, merged

THRESHOLD = 0.98
TILE = 2048              # vectors of a tile, on average at most
EXACT_PAIRS = 1 << 16    # pairs recomputed at a time


def quantised(vectors):
    """Unit vectors as int8 rows with their scales, and the lengths of both the quantised vector
    and the error, in double precision."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    return codes, scale, np.linalg.norm(near, axis=1), np.linalg.norm(unit - near, axis=1)


def by_bounds(a, b, threshold, same=False):
    """Index pairs (i, j) that may reach the threshold, and which of them surely do, in blocks."""
    (codes_a, scale_a, long_a, off_a), (codes_b, scale_b, long_b, off_b) = a, b
    # Whole numbers up to 2^24 are exact in single precision.
    kind = np.float32 if codes_a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    turned = codes_b.astype(kind).T
    rows = max(1, (1 << 22) // max(1, len(codes_b)))
    for r in range(0, len(codes_a), rows):
        part = slice(r, r + rows)
        about = (codes_a[part].astype(kind) @ turned) * np.outer(scale_a[part], scale_b)
        # |error| <= long_a off_b + off_a long_b + off_a off_b, written alike from both sides.
        bound = (np.outer(long_a[part] + off_a[part], long_b + off_b)
                 - np.outer(long_a[part], long_b)) + 1e-12
        i, j = np.nonzero(about + bound >= threshold)
        if same:
            i, j = i[i + r < j], j[i + r < j]
        yield i + r, j, about[i, j] - bound[i, j] >= threshold + 1e-12


def reached(left, right, i, j, threshold):
    """Which of the pairs have a cosine of `threshold` or more in full precision."""
    parts = [np.zeros(0, bool)]
    for k in range(0, len(i), EXACT_PAIRS):
        p, q = left[i[k:k + EXACT_PAIRS]], right[j[k:k + EXACT_PAIRS]]
        parts.append(np.einsum("nd,nd->n", p, q) / (
            np.linalg.norm(p, axis=1) * np.linalg.norm(q, axis=1)) >= threshold)
    return np.concatenate(parts)


def tile_links(left, right, threshold=THRESHOLD, same=False, codes=None, with_sure=True):
    """Index pairs (i, j) of rows of two matrices with cosine >= threshold; with `same`, i < j.
    `codes` are their quantised forms; without `with_sure` pairs that the codes decide are left
    out."""
    found = []
    for i, j, sure in by_bounds(*(codes or (quantised(left), quantised(right))), threshold, same):
        if with_sure:
            found.append((i[sure], j[sure]))
        i, j = i[~sure], j[~sure]
        links = reached(left, right, i, j, threshold)
        found.append((i[links], j[links]))
    return tuple(np.concatenate(x) for x in zip(*found))


CODES = "code binary, scale double, length double, off double"
FOUND = "kind int, a long, b long, links long, left_tile long, right_tile long"
COUNT, FOREST, DOUBT = range(3)     # kinds of rows found; DOUBT: vector a on side `links`


def _coded(batches):
    """Adds the quantised form to rows with a column `vector`."""
    import pyarrow as pa
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy()
            code = [None] * len(sizes)
            numbers = np.zeros((3, len(sizes)))
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                flat = vectors.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False)
                codes, *rest = quantised(flat.astype(np.float64).reshape(len(own), size))
                numbers[:, own] = rest
                for k, row in zip(own, codes):
                    code[k] = row.tobytes()
            added = [pa.array(code, pa.binary()), *map(pa.array, numbers)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], [*batch.schema.names, "code", "scale", "length", "off"])


def _codes(tile):
    """The quantised form of an Arrow struct array."""
    codes = np.frombuffer(b"".join(tile.field("code").to_pylist()), np.int8)
    return (codes.reshape(len(tile), -1),
            *(tile.field(c).to_numpy() for c in ("scale", "length", "off")))


def _links(nodes, counts, i, j):
    """Links (i, j) between two lists of nodes as rows (kind, a, b, links)."""
    links = [np.bincount(i, counts[1][j], len(nodes[0])),
             np.bincount(j, counts[0][i], len(nodes[1]))]
    all_nodes, at = np.unique(np.concatenate(nodes), return_inverse=True)
    label = merged(np.arange(len(all_nodes)), at[:len(nodes[0])][i], at[len(nodes[0]):][j])
    own = np.flatnonzero(label != np.arange(len(all_nodes)))
    some = [np.flatnonzero(x) for x in links]
    return [(COUNT, a, None, n) for side in (0, 1)
            for a, n in zip(nodes[side][some[side]].tolist(),
                            links[side][some[side]].astype(np.int64).tolist())] + [
        (FOREST, a, b, 0) for a, b in zip(all_nodes[own].tolist(), all_nodes[label[own]].tolist())]


def _batch(rows):
    import pyarrow as pa
    types = [pa.int32()] + [pa.int64()] * 5
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)],
        ["kind", "a", "b", "links", "left_tile", "right_tile"])


def _by_codes(threshold):
    """Tile pairs -> rows of the links that are sure, and the vectors of the pairs in doubt."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                sides = [batch.column(c)[k].values for c in ("left", "right")]
                tiles = [batch.column(c)[k].as_py() for c in ("left_tile", "right_tile")]
                nodes = [s.field("node").to_numpy() for s in sides]
                counts = [s.field("copies").to_numpy() for s in sides]
                doubt = [np.zeros(len(n), bool) for n in nodes]
                links = []
                for i, j, sure in by_bounds(*map(_codes, sides), threshold, tiles[0] == tiles[1]):
                    links.append((i[sure], j[sure]))
                    doubt[0][i[~sure]] = True
                    doubt[1][j[~sure]] = True
                i, j = (np.concatenate(x) for x in zip(*links))
                rows = [(*r, None, None) for r in (_links(nodes, counts, i, j) if len(i) else [])]
                rows += [(DOUBT, a, None, side, *tiles) for side in (0, 1)
                         for a in nodes[side][doubt[side]].tolist()]
                if rows:
                    yield _batch(rows)
    return run


def _in_full(threshold):
    """The vectors in doubt of a tile pair -> rows of the links that the codes left open."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                met = batch.column("met")[k].values
                same = batch.column("left_tile")[k].as_py() == batch.column("right_tile")[k].as_py()
                side = met.field("side").to_numpy()
                node = met.field("node").to_numpy()
                # Within a tile a vector may be in doubt as either partner: one list for both.
                chosen = ([np.unique(node, return_index=True)[1]] * 2 if same
                          else [np.flatnonzero(side == s) for s in (0, 1)])
                sides = [met.take(c) for c in chosen]
                vectors = [s.field("vector").flatten().to_numpy(zero_copy_only=False)
                           .astype(np.float64).reshape(len(s), -1) for s in sides]
                i, j = tile_links(*vectors, threshold, same, [_codes(s) for s in sides], False)
                if len(i):
                    yield _batch([(*r, None, None) for r in _links(
                        [s.field("node").to_numpy() for s in sides],
                        [s.field("copies").to_numpy() for s in sides], i, j)])
    return run


def _usable():
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return (F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0))


def embedding_dedup(rows: DataFrame, threshold=THRESHOLD, tile=TILE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Vectors of one label (and length) link if their cosine is `threshold` or more. Null labels,
    null or zero vectors and those with null or non-finite components link with nothing. Copies
    link with each other and count one by one. A component without any vec_id has a null
    component_id, and a null vec_id is not kept. Other columns are ignored; an empty table gives
    an empty result.
    """
    full = stored(numbered(rows.select("vec_id", "embedding", "label")).withColumns({
        "ok": F.coalesce(_usable(), F.lit(False)), "h1": F.xxhash64("embedding"),
        "h2": F.xxhash64(F.lit(1), "embedding"), "size": F.size("embedding")}))
    key = ["label", "size", "h1", "h2"]
    # Copies meet once, as one node.
    nodes = full.filter("ok").groupBy(*key).agg(
        F.min("_row").alias("node"), F.min("vec_id").alias("least"),
        F.count("*").alias("copies"), F.first("embedding").alias("vector"))
    shape = StructType(nodes.schema.fields + StructType.fromDDL(CODES).fields)
    nodes = stored(nodes.mapInArrow(_coded, shape))
    labels = cut(nodes.groupBy("label", "size").agg(
        F.ceil(F.count("*") / tile).alias("tiles")))
    codes = ["node", "copies", "code", "scale", "length", "off"]
    tiles = stored(
        nodes.join(broadcast_if_small(labels, 64), ["label", "size"])
        .groupBy("label", "size", F.pmod(F.xxhash64("node"), "tiles").alias("tile"),
                 F.col("tiles"))
        .agg(F.min("node").alias("left_tile"), F.collect_list(F.struct(*codes)).alias("left")))
    partner = tiles.select("label", "size", F.col("left_tile").alias("right_tile"),
                           F.col("left").alias("right"),
                           F.explode(F.sequence(F.lit(0), "tile")).alias("tile"))
    pairs = tiles.select("label", "size", "tile", "left_tile", "left").join(
        partner, ["label", "size", "tile"])
    by_codes = cut(pairs.select("left", "right", "left_tile", "right_tile")
                   .mapInArrow(_by_codes(threshold), FOUND))
    doubt = by_codes.filter(F.col("kind") == DOUBT).select(
        "left_tile", "right_tile", F.col("links").alias("side"), F.col("a").alias("node"))
    met = doubt.join(nodes.select(*codes, "vector"), "node").groupBy(
        "left_tile", "right_tile").agg(F.collect_list(F.struct("side", *codes, "vector"))
                                       .alias("met"))
    in_full = cut(met.mapInArrow(_in_full(threshold), FOUND))
    found = by_codes.union(in_full).filter(F.col("kind") != DOUBT)
    counts = found.filter(F.col("kind") == COUNT).groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(found.filter(F.col("kind") == FOREST).select("a", "b"))
    joined = (nodes.select(*key, "node", "least", "copies")
              .join(counts, F.col("node") == F.col("a"), "left").drop("a")
              .join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left"))
    joined = cut(joined.select(*key, F.coalesce("root", "node").alias("root"), "least", (
        F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    joined = joined.join(least, "root").select(*key, "n_links", "component_id")
    linked = full.filter("ok").join(joined, key).select("vec_id", "n_links", "component_id")
    alone = full.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                         F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


ORACLE_SQL = f"""
WITH RECURSIVE
entries AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
usable AS MATERIALIZED (
  SELECT * FROM entries WHERE label IS NOT NULL AND v IS NOT NULL
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.n AS a, b.n AS b FROM usable a JOIN usable b ON a.label = b.label AND a.n <> b.n
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= {THRESHOLD}
        ELSE false END),
reach AS (
  SELECT n, vec_id AS found FROM entries
  UNION
  SELECT links.a, reach.found FROM reach JOIN links ON links.b = reach.n),
least AS (SELECT n, min(found) AS component_id FROM reach GROUP BY n),
counts AS (SELECT a AS n, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id,
  coalesce(vec_id = component_id, false) AS kept
FROM entries JOIN least USING (n) LEFT JOIN counts USING (n)
"""
