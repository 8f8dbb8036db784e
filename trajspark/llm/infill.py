"""Fill-in-the-middle by a wavelet matrix over character classes.

A text's units (words with the blanks before them, or lines) end where one class of characters
meets another. The matrix holds the pair of classes of every character and its follower, so the
number of units that end in a stretch is a sum of ranks, and a bisection on these sums finds the
place where a given number of units ends. One matrix serves all texts of a slice of a batch, and
all their cuts are bisected together; a slice holds a bounded number of bytes, or one text.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trajspark.llm.common import SPACES, free_name

SEED, RATE, SPM = 42, 50, 80            # rate of texts that are cut and share of spm, in per cent
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE = 4 << 20                         # bytes of text that share a matrix
END, BLANK, BREAK, WORD = range(4)      # classes; END follows the last character
CLASSES = np.full(256, WORD, np.uint8)
CLASSES[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
CLASSES[0x0A] = BREAK
# Pairs of classes between which a unit ends. Blanks after the last word are a unit.
ENDS = {"word": [(WORD, BLANK), (WORD, BREAK), (WORD, END), (BLANK, END), (BREAK, END)],
        "line": [(BREAK, BLANK), (BREAK, BREAK), (BREAK, WORD), (BREAK, END), (BLANK, END),
                 (WORD, END)]}


class Bits:
    """A bit vector with ranks in constant time."""

    def __init__(self, bits):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, "<u8")
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=int)))

    def rank(self, places):
        """Ones before each place."""
        word = places >> 6
        low = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Symbols below 2^depth with the rank of any symbol at any place."""

    def __init__(self, symbols, depth=4):
        self.levels = []
        for bit in reversed(range(depth)):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), len(symbols) - np.count_nonzero(ones)))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def rank(self, symbol, places):
        """Occurrences of `symbol` before each place."""
        first = np.zeros(1, int)
        for bit, ones, zeros in self.levels:
            if symbol >> bit & 1:
                first, places = zeros + ones.rank(first), zeros + ones.rank(places)
            else:
                first, places = first - ones.rank(first), places - ones.rank(places)
        return places - first


class Units:
    """Unit ends of texts that lie one after the other in a byte array."""

    def __init__(self, data, starts, ends, unit="word"):
        kinds = CLASSES[data]
        follower = np.empty_like(kinds)
        follower[:-1] = kinds[1:]
        follower[ends[ends > starts] - 1] = END
        self.matrix = WaveletMatrix(kinds << 2 | follower)
        self.leads = Bits((data & 0xC0) != 0x80)        # first bytes of code points
        self.symbols = [a << 2 | b for a, b in ENDS[unit]]
        self.starts, self.ends = starts, ends
        self.done = self.before(starts)
        self.counts = self.before(ends) - self.done

    def before(self, places):
        return sum(self.matrix.rank(s, places) for s in self.symbols)

    def cut(self, wanted):
        """Code points of each text up to the end of its unit number `wanted`."""
        low, high = self.starts.copy(), self.ends.copy()
        while (low < high).any():
            middle = low + high >> 1
            enough = self.before(middle) - self.done >= wanted
            low, high = (np.where(enough, low, np.minimum(middle + 1, high)),
                         np.where(enough, middle, high))
        return self.leads.rank(low) - self.leads.rank(self.starts)


def _slices(ends, limit=SLICE):
    """(first, last) runs of texts of `limit` bytes at most, or of one text."""
    first = 0
    while first + 1 < len(ends):
        last = int(np.searchsorted(ends, ends[first] + limit, "right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def cuts(texts: pa.Array, h1, h2, unit="word"):
    """(units, code points before the first cut, before the second) of each text, the cuts after
    the smaller and the larger of h1 and h2 modulo the number of units and one."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    out = np.zeros((3, len(texts)), int)
    for a, b in _slices(ends):
        part = ends[a:b + 1] - ends[a]
        units = Units(data[ends[a]:ends[b]], part[:-1], part[1:], unit)
        one, two = h1[a:b] % (units.counts + 1), h2[a:b] % (units.counts + 1)
        out[:, a:b] = (units.counts, units.cut(np.minimum(one, two)),
                       units.cut(np.maximum(one, two)))
    return out


def _located(unit):
    @F.arrow_udf("struct<n: bigint, first: bigint, second: bigint>")
    def located(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        found = cuts(texts, h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False),
                     unit)
        return pa.StructArray.from_arrays([pa.array(x) for x in found], ["n", "first", "second"])
    return located


def infilled(docs: DataFrame, unit="word", seed=SEED, rate=RATE, spm=SPM) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row.

    The cuts and the form follow from the hash of seed and doc_id alone, so repeated rows come out
    alike; a null doc_id hashes as no digits. Null texts are empty; empty texts, texts that hold a
    marker and those outside the rate stay plain. Texts are never cut short. Other columns are
    ignored; an empty table gives an empty result.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"),
                                                          F.lit(""))), 256)
    number = lambda k: F.conv(F.substring("_hash", 1 + 8 * k, 8), 16, 10).cast("long")
    text = F.col("_text")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"),
                       digest.alias("_hash"))
    rows = rows.withColumn("_at", _located(unit)(text, number(0), number(1)))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    rows = rows.withColumn("form", F.when(
        (text == "") | marked | (number(2) % 100 >= rate), "plain").when(
        number(3) % 100 < spm, "spm").otherwise("psm"))
    cut = F.col("form") != "plain"
    first, second = F.col("_at.first"), F.col("_at.second")
    rows = rows.select(
        "doc_id", F.col("_at.n").alias("n"), "form", F.when(cut, first).alias("prefix_chars"),
        F.when(cut, second - first).alias("middle_chars"), "_text")
    place = lambda c: F.col(c).cast("int")
    prefix = F.substring("_text", F.lit(1), place("prefix_chars"))
    middle = F.substring("_text", place("prefix_chars") + 1, place("middle_chars"))
    suffix = F.substring("_text", place("prefix_chars") + place("middle_chars") + 1,
                         F.lit((1 << 31) - 1))
    output = F.when(F.col("form") == "psm", F.concat(
        F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)).when(
        F.col("form") == "spm", F.concat(
            F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)).otherwise(
        F.col("_text"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       output.alias("output"))


def restored(rows: DataFrame, name="text") -> DataFrame:
    """Adds the text that `output` and `form` give back; no marker can arise where parts meet,
    for each begins with the only `<` it has. Null outputs give a null text."""
    parts = free_name(rows, "_parts")
    cut = F.split(F.when(F.col("form") != "plain", F.col("output")),
                  f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    part = lambda k: F.get(F.col(parts), F.lit(k))
    text = F.when(F.col("form") == "plain", F.col("output")).when(
        F.col("form") == "psm", F.concat(part(1), part(3), part(2))).otherwise(
        F.concat(part(2), part(3), part(1)))
    return rows.withColumn(parts, cut).withColumn(name, text).drop(parts)


def infill_digests(docs: DataFrame) -> DataFrame:
    """`infilled` with hashes in place of the output and of the text rebuilt from it."""
    return restored(infilled(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"))


_WORDS = rf"{SPACES[:-1]}*[^\x20\x09-\x0D]+|{SPACES}"

ORACLE_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text,
    sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
units AS (
  SELECT doc_id, text, regexp_extract_all(text, '{_WORDS}') AS u,
    {', '.join(f"CAST('0x' || h[{8 * k + 1}:{8 * k + 8}] AS BIGINT) AS h{k + 1}" for k in range(4))}
  FROM texts),
places AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
    greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
        OR contains(text, '<M>') OR h3 % 100 >= {RATE} THEN 'plain'
      WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p,
    coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM places)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
