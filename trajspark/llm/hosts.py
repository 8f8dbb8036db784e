"""Quality rules by host: documents fail rules, hosts are judged by the shares of documents that
fail, and a rejected host takes its documents with it.

The shares are shrunk by a beta prior that is fitted to all hosts by its moments, so that a host
with few documents is close to the average of the corpus. A host goes if its shrunk share, less what
its number of documents leaves uncertain, lies in the upper tail of that prior, that is, beyond what
hosts of this corpus show, and is not small in itself. DataFrame functions only.
"""

import math

from pyspark.sql import DataFrame, functions as F

from trajspark.llm.common import SPACES, broadcast_if_small, cut, let

TAIL = 3.0               # standard deviations of the prior above its mean, where the tail begins
SURE = 1.645             # standard deviations of a host's own share that are taken off it
LEAST_SHARE = 0.2        # no host goes for a smaller share of documents failing a rule
ANYHOW = 0.5             # a host surely above this share goes wherever the tail begins
LEAST_WORDS = 10
REPEATED_PERCENT = 20    # of words in repeated 5-word windows
WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"
RULES = ("short", "repeated", "symbols", "lines", "lengths")


def _covered(places):
    """Words covered by windows that begin at the sorted places."""
    steps = F.transform(places, lambda p, k: F.coalesce(
        F.least(F.get(places, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(steps, F.lit(0), lambda a, b: a + b)


def _repeated(grams):
    """Words in windows whose hash occurs twice or more. Hashes are sorted with their places;
    repeated ones have an equal neighbour. Only texts with a repeated hash pay for the sort."""
    def of_sorted(pairs):
        same = F.transform(pairs, lambda p, k: F.when(
            F.coalesce(p["g"] == F.get(pairs, k - 1)["g"], F.lit(False))
            | F.coalesce(p["g"] == F.get(pairs, k + 1)["g"], F.lit(False)), p["k"]))
        return let(F.array_sort(F.filter(same, lambda k: k.isNotNull())), _covered)
    pairs = F.array_sort(F.transform(grams, lambda g, k: F.struct(g.alias("g"), k.alias("k"))))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(
        let(pairs, of_sorted))


def _grams(words):
    last = F.size(words) - WINDOW
    gram = lambda k: F.xxhash64(*[F.get(words, k + j) for j in range(WINDOW)])
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), gram)).otherwise(
        F.array().cast("array<bigint>"))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, source and the counts of every text, null texts counting as empty."""
    text = F.coalesce("text", F.lit(""))
    words = let(F.array_remove(F.split(text, SPACES), ""), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        let(_grams(w), _repeated).cast("long").alias("n_repeat_words")))
    lines = let(F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")),
                lambda s: F.struct(F.size(s).cast("long").alias("n_lines"),
                                   (F.size(s) - F.size(F.array_distinct(s))).cast("long")
                                   .alias("n_dup_lines")))
    return docs.select(
        "doc_id", "source", words.alias("w"), lines.alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols")).select(
        "doc_id", "source", "w.*", "l.*", "n_symbols")


def failures():
    """The rules as columns over `measures`."""
    return {
        "short": F.col("n_words") < LEAST_WORDS,
        "repeated": F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT,
        "symbols": F.col("n_symbols") * 10 > F.col("n_words"),
        "lines": F.col("n_dup_lines") * 10 > F.col("n_lines") * 3,
        "lengths": (F.col("word_chars") < F.col("n_words") * 2)
        | (F.col("word_chars") > F.col("n_words") * 15)}


def rejected_hosts(rows: DataFrame) -> DataFrame:
    """Hosts (`source`) of `measures` rows whose share for some rule is surely in the prior's tail."""
    hosts = cut(rows.groupBy("source").agg(
        F.count("*").alias("n"), *[F.count_if(rule).alias(name)
                                   for name, rule in failures().items()]))
    total = hosts.agg(F.sum("n").alias("n"), F.count("*").alias("hosts"),
                      *[F.sum(r).alias(r) for r in RULES]).first()
    if not total.n:
        return hosts.filter(F.lit(False)).select("source")
    mean = {r: total[r] / total.n for r in RULES}
    spread = hosts.agg(*[F.sum(F.col("n") * F.pow(F.col(r) / F.col("n") - mean[r], F.lit(2)))
                         .alias(r) for r in RULES]).first()
    over = F.lit(False)
    for r in RULES:
        noise = mean[r] * (1 - mean[r])
        between = spread[r] / total.n - total.hosts * noise / total.n
        prior = min(max(noise / between - 1, 1e-3), 1e6) if between > 0 else 1e6
        tail = mean[r] + TAIL * math.sqrt(noise / (prior + 1))
        limit = min(ANYHOW, max(LEAST_SHARE, tail))
        share = (F.col(r) + mean[r] * prior) / (F.col("n") + prior)
        doubt = F.sqrt(share * (1 - share) / (F.col("n") + prior + 1))
        over = over | (share - SURE * doubt > limit)
    return hosts.filter(over).select("source")


def host_quality(docs: DataFrame) -> DataFrame:
    """Counts, base_failed and kept of every row.

    A document is kept if it passes the base rules itself and its host is not rejected. Null and
    blank texts have no words and fail; a null source is a host. Repeated rows count and are
    returned each. Other columns are ignored; an empty table gives an empty result.
    """
    rows = cut(measures(docs.select("doc_id", "source", "text")))
    bad = cut(rejected_hosts(rows).withColumn("rejected", F.lit(True)))
    rules = failures()
    joined = rows.join(broadcast_if_small(bad, 256), rows["source"].eqNullSafe(bad["source"]),
                       "left").drop(bad["source"])
    failed = rules["short"] | rules["repeated"]
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("rejected").isNull()).alias("kept"))


_RATES = ", ".join(
    f"greatest(least(coalesce(m.{r} * (1 - m.{r}) / nullif(greatest(s.{r} - m.hosts * m.{r} * "
    f"(1 - m.{r}) / m.n, 0), 0) - 1, 1e6), 1e6), 1e-3) AS {r}" for r in RULES)



def _surely(r):
    """The share of a host for rule r, less its doubt, above the limit of the rule."""
    share = f"((h.{r} + m.{r} * p.{r}) / (h.n + p.{r}))"
    tail = f"m.{r} + {TAIL} * sqrt(m.{r} * (1 - m.{r}) / (p.{r} + 1))"
    limit = f"least({ANYHOW}, greatest({LEAST_SHARE}, {tail}))"
    return f"{share} - {SURE} * sqrt({share} * (1 - {share}) / (h.n + p.{r} + 1)) > {limit}"


ORACLE_SQL = f"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(text, chr(10)),
      lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS lines FROM texts),
places AS (
  SELECT doc_id, i, w[i + 1:i + 5] AS gram FROM split, LATERAL (SELECT unnest(range(len(w) - 4)) AS i)
  WHERE len(w) > 4),
twice AS (SELECT doc_id, i FROM places QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, LATERAL (SELECT unnest(range(5)) AS j)
  GROUP BY doc_id),
counts AS (
  SELECT s.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words
  FROM split s LEFT JOIN covered c USING (doc_id)),
rules AS (
  SELECT *, n_words < 10 AS short, n_repeat_words * 100 > n_words * 20 AS repeated,
    n_symbols * 10 > n_words AS symbols, n_dup_lines * 10 > n_lines * 3 AS lines,
    word_chars < n_words * 2 OR word_chars > n_words * 15 AS lengths FROM counts),
hosts AS (
  SELECT source, count(*) AS n, {', '.join(f'count(*) FILTER ({r}) AS {r}' for r in RULES)}
  FROM rules GROUP BY source),
m AS (SELECT sum(n) AS n, count(*) AS hosts, {', '.join(f'sum({r}) / sum(n) AS {r}' for r in RULES)}
  FROM hosts),
s AS (SELECT {', '.join(f'sum(h.n * pow(h.{r} / h.n - m.{r}, 2)) / any_value(m.n) AS {r}' for r in RULES)}
  FROM hosts h, m),
p AS (SELECT {_RATES} FROM m, s),
bad AS (SELECT source FROM hosts h, m, p
  WHERE {' OR '.join(map(_surely, RULES))})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  short OR repeated AS base_failed,
  NOT (short OR repeated) AND NOT EXISTS (
    SELECT 1 FROM bad b WHERE b.source IS NOT DISTINCT FROM r.source) AS kept
FROM rules r
"""
