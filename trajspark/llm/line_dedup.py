"""Line dedup by a deletion-neighbourhood join: a line goes if an earlier line of the corpus has
the same words, or the same but for one word inserted, deleted or replaced.

Symbols are words, lower-cased (ASCII) and parted by blanks, and the edit bound is one word; lines
of fewer than `LEAST_WORDS` words must be equal. A line emits itself and each of its variants with
one word deleted as hashed keys. Lines within the bound share a key: the same variant at the same
place (a word replaced), or the variant of one and the whole of the other (a word more). Within a
key only the earliest line matters, so each line meets that one and not all the others; the edit
distance of these pairs is then verified on the words.

Variants are emitted for a line only if another line shares its first or its last half, which
every pair within the bound does; lines alone in both halves have no partner.

Most lines occur once and have no partner; only the others are looked up for every place they
stand at. Those that make up a large share of all places are few, so they are sent to the places;
no task meets all places of a common line.
"""

import xxhash
from pyspark.sql import DataFrame, functions as F

from trajspark.llm.common import broadcast_if_small, cut, free_name, numbered, stored
from trajspark.operators.sequences import dense_ids

LEAST_WORDS = 8
COMMON = 1024            # a line at one place in so many or more is common; so many at most are
LINES = ("_row long, no_id boolean, doc_id {}, line int, hi long, lo long, "
         "halves array<long>, n_lines long")
PRIME, BASE = (1 << 61) - 1, 0x1d8e4e27c47d124f     # of the hash of a variant
PLACE = ("no_id", "doc_id", "line", "_row")      # the order that "earliest" means


def line_words(line):
    return line.encode("utf-8", "replace").lower().split()


def _signed(unsigned):
    return unsigned - (1 << 64) if unsigned >> 63 else unsigned


def line_hash(words):
    """128 bits of a line's words."""
    digest = xxhash.xxh3_128_intdigest(b" ".join(words))
    return _signed(digest >> 64), _signed(digest & ((1 << 64) - 1))


def half_keys(words):
    """Keys of the first and last halves that a partner may share: it may be a word longer or
    shorter, so both possible lengths are used."""
    n, out = len(words), []
    for half in {n // 2, (n - 1) // 2}:
        for side, part in ((b"<", words[:half]), (b">", words[n - half:])):
            text = b"%b%d %b" % (side, half, b" ".join(part))
            out.append(_signed(xxhash.xxh64_intdigest(text, 1)))
    return out


def variant_keys(words):
    """(key, place) of the whole line, at place -1, and of each variant with one word deleted.

    A key is a polynomial in the hashes of its words, so a variant's comes from those of the
    words before and after the gap: time is linear in the line.
    """
    n = len(words)
    before, power = [0], [1]
    for word in words:
        before.append((before[-1] * BASE + xxhash.xxh64_intdigest(word, 2)) % PRIME)
        power.append(power[-1] * BASE % PRIME)
    # The words after the gap keep their powers; those before it move down by one.
    return [(before[n], -1)] + [
        ((before[n] + (before[k] - before[k + 1]) * power[n - 1 - k]) % PRIME, k)
        for k in range(n)]


def within_bound(a, b):
    """Whether two word lists differ by at most one word inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1:
        return False
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    rest_a, rest_b = a[start:], b[start:]
    if len(a) == len(b):
        return rest_a[1:] == rest_b[1:]
    return rest_a[1:] == rest_b if len(a) > len(b) else rest_a == rest_b[1:]


def _flush(names, types, rows):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _lines(batches):
    """One row per line with a word, and one per document, at line -1, with their number."""
    import pyarrow as pa
    for batch in batches:
        shape = {"_row": pa.int64(), "no_id": pa.bool_(), "doc_id": batch.column("doc_id").type,
                 "line": pa.int32(), "hi": pa.int64(), "lo": pa.int64(),
                 "halves": pa.list_(pa.int64()), "n_lines": pa.int64()}
        rows = []
        for row, doc_id, text in zip(batch.column("_row").to_pylist(),
                                     batch.column("doc_id").to_pylist(), batch.column("text")):
            count = 0
            for k, line in enumerate((text.as_py() or "").split("\n")):
                words = line_words(line)
                if words:
                    count += 1
                    rows.append((row, doc_id is None, doc_id, k, *line_hash(words), half_keys(
                        words) if len(words) >= LEAST_WORDS else None, None))
                if len(rows) >= 2_000:
                    yield _flush(list(shape), shape.values(), rows)
                    rows = []
            rows.append((row, doc_id is None, doc_id, -1, None, None, None, count))
        if rows:
            yield _flush(list(shape), shape.values(), rows)


def _texts(batches):
    """The words of the wanted lines of each document."""
    import pyarrow as pa
    for batch in batches:
        rows = []
        for text, wanted in zip(batch.column("text"), batch.column("wanted").to_pylist()):
            lines = text.as_py().split("\n")
            rows += [(c["id"], b" ".join(line_words(lines[c["line"]]))) for c in wanted]
            if len(rows) >= 1_000:
                yield _flush(["id", "norm"], [pa.int64(), pa.binary()], rows)
                rows = []
        if rows:
            yield _flush(["id", "norm"], [pa.int64(), pa.binary()], rows)


def _variants(batches):
    import pyarrow as pa
    shape = {"id": pa.int64(), "key": pa.int64(), "place": pa.int32()}
    for batch in batches:
        rows = []
        for id_, norm in zip(batch.column("id").to_pylist(), batch.column("norm").to_pylist()):
            rows += [(id_, *v) for v in variant_keys(norm.split(b" "))]
            if len(rows) >= 10_000:
                yield _flush(list(shape), shape.values(), rows)
                rows = []
        if rows:
            yield _flush(list(shape), shape.values(), rows)


def _near_lines(full, first):
    """(_row, line) of those first lines for which an earlier line is within the bound."""
    keys = first.filter("halves is not null").select(
        "at", F.xxhash64("at._row", "at.line").alias("own"), F.explode("halves").alias("key"))
    shared = keys.groupBy("key").agg(F.min("own").alias("a"), F.max("own").alias("b")).filter(
        "a != b")
    candidates = keys.join(shared, "key", "left_semi").select("at.*").distinct()
    candidates = dense_ids(candidates.withColumnRenamed("_row", "r"),
                           [c.replace("_row", "r") for c in PLACE], name="id")
    candidates = cut(candidates.withColumnRenamed("r", "_row"))      # id: the order of lines
    wanted = cut(candidates.groupBy("_row").agg(
        F.collect_list(F.struct("id", "line")).alias("wanted")))
    texts = stored(full.join(broadcast_if_small(wanted, 200, entries="wanted", entry_bytes=64),
                             "_row").select("text", "wanted")
                   .mapInArrow(_texts, "id long, norm binary"))
    variants = stored(texts.mapInArrow(_variants, "id long, key long, place int"))
    deleted, whole = variants.filter("place >= 0"), variants.filter("place = -1")
    least = deleted.groupBy("key", "place").agg(F.min("id").alias("other"),
                                                F.max("id").alias("last")).filter("other < last")
    replaced = deleted.join(least, ["key", "place"]).select("id", "other")
    longer = deleted.join(whole.select("key", F.col("id").alias("other")), "key").select(
        F.greatest("id", "other").alias("id"), F.least("id", "other").alias("other"))
    pairs = replaced.union(longer).filter("id > other").distinct()
    both = (pairs.join(texts, "id").withColumnRenamed("norm", "a")
            .join(texts.select(F.col("id").alias("other"), F.col("norm").alias("b")), "other"))
    near = both.select("id", "a", "b").mapInArrow(_verify, "id long").distinct()
    return candidates.join(near, "id", "left_semi").select("_row", "line")


def _verify(batches):
    import pyarrow as pa
    for batch in batches:
        ids = [i for i, a, b in zip(batch.column("id").to_pylist(), batch.column("a").to_pylist(),
                                    batch.column("b").to_pylist())
               if within_bound(a.split(b" "), b.split(b" "))]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], ["id"])


def line_verdicts(full: DataFrame, common=COMMON) -> DataFrame:
    """(_row, doc_id, text) -> _row, doc_id, n_lines (with a word) and `dropped`, the numbers of
    the lines that go, from 0, in order. `common`: see COMMON; it only chooses the way.

    `_row` must not change when the rows are read again: number a plain scan of files, or store.
    """
    kind = full.schema["doc_id"].dataType.simpleString()
    lines = stored(full.select("_row", "doc_id", "text").mapInArrow(_lines, LINES.format(kind)))
    places = lines.filter("line >= 0").select("_row", "line", "hi", "lo")
    first = stored(lines.filter("line >= 0").groupBy("hi", "lo").agg(
        F.min(F.struct(*PLACE)).alias("at"), F.first("halves").alias("halves"),
        F.count("*").alias("n")))
    near = cut(_near_lines(full, first)).select(
        F.col("_row").alias("r"), F.col("line").alias("l"), F.lit(True).alias("near"))
    looked_up = stored(
        first.select("hi", "lo", "n", F.col("at._row").alias("r"), F.col("at.line").alias("l"))
        .join(broadcast_if_small(near, 48), ["r", "l"], "left").filter("n > 1 or near"))
    total = first.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") * common >= F.lit(total)
    hot = F.broadcast(looked_up.filter(often))         # at most `common` rows
    found = places.join(hot, ["hi", "lo"]).union(
        places.join(hot.select("hi", "lo"), ["hi", "lo"], "left_anti")
        .join(looked_up.filter(~often), ["hi", "lo"]))
    gone = found.filter("near or not (_row = r and line = l)").groupBy("_row").agg(
        F.array_sort(F.collect_list("line")).alias("dropped"))
    return lines.filter("line = -1").select("_row", "doc_id", "n_lines").join(
        gone, "_row", "left").withColumn(
        "dropped", F.coalesce("dropped", F.array().cast("array<int>")))


def is_plain_scan(frame: DataFrame) -> bool:
    """Whether the rows come from files as they are, perhaps with columns or rows left out, so that
    a lost task numbers them the same again."""
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    nodes = [line.lstrip(" :+-") for line in plan.splitlines() if line.strip()]
    return all(n.startswith(("Project", "Filter", "Relation")) for n in nodes) and any(
        n.startswith("Relation") for n in nodes)


def line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and dropped (line numbers from 0, comma-joined) of every row.

    Lines are parted by newlines; lines without words are never dropped. "Earlier" is by doc_id,
    null last, then line number; of equal rows either may come first, and the others lose their
    lines. Null and blank texts have no lines. Other columns are ignored; an empty table gives
    an empty result. Rows that do not come from files as they are get stored with their numbers.
    """
    docs = docs.select("doc_id", "text")
    found = line_verdicts(numbered(docs) if is_plain_scan(docs) else stored(numbered(docs)))
    return found.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"),
                        F.array_join("dropped", ",").alias("dropped"))


def deduped(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, without the dropped lines. A row that loses all of its
    lines with words goes; one that had none stays. A column n_chars is kept up to date."""
    row = free_name(docs, "_row")
    full = stored(numbered(docs, row))
    found = line_verdicts(full.select(F.col(row).alias("_row"), "doc_id", "text"))
    found = cut(found.filter(F.size("dropped") > 0).select(
        F.col("_row").alias(row), F.col("dropped").alias("dropped" + row),
        (F.size("dropped") == F.col("n_lines")).alias("empty" + row)))
    lost = F.col("dropped" + row)
    kept = F.filter(F.split("text", "\n"), lambda line, k: ~F.array_contains(lost, k))
    text = F.when(lost.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = full.join(broadcast_if_small(found, 200, entries="dropped" + row, entry_bytes=16),
                    row, "left").filter(
        ~F.coalesce(F.col("empty" + row), F.lit(False))).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE_SQL = """
WITH lines AS (
  SELECT doc_id, u.line AS line, list_filter(regexp_split_to_array(translate(u.body,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
      lambda w: w <> '') AS words
  FROM (SELECT doc_id, string_split(text, chr(10)) AS bodies FROM documents),
       LATERAL (SELECT unnest(bodies) AS body, generate_subscripts(bodies, 1) - 1 AS line) u),
named AS (
  SELECT *, array_to_string(words, ' ') AS norm, doc_id * 1000000000 + line AS rank
  FROM lines WHERE len(words) > 0),
firsts AS (SELECT norm, min(rank) AS rank, any_value(words) AS words FROM named GROUP BY norm),
variants AS (
  SELECT rank, k.k AS k, array_to_string(words[:k.k] || words[k.k + 2:], ' ') AS variant
  FROM firsts, LATERAL (SELECT unnest(range(len(words))) AS k) k WHERE len(words) >= 8),
replaced AS (
  SELECT rank FROM (SELECT rank, min(rank) OVER (PARTITION BY k, variant) AS least FROM variants)
  WHERE least < rank),
longer AS (
  SELECT greatest(v.rank, f.rank) AS rank FROM variants v JOIN firsts f ON v.variant = f.norm
  WHERE len(f.words) >= 8),
near AS (SELECT rank FROM replaced UNION SELECT rank FROM longer),
gone AS (
  SELECT n.doc_id, n.line, n.rank <> f.rank OR f.rank IN (SELECT rank FROM near) AS gone
  FROM named n JOIN firsts f USING (norm)),
per_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) FILTER (gone) AS dropped
  FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
  coalesce(dropped, '') AS dropped
FROM documents d LEFT JOIN per_doc USING (doc_id)
"""
