"""Text token counting.

A counter is a function Column -> Column. `estimate_tokens` is native and the default;
`exact_counter` runs a byte-pair tokenizer over Arrow batches. `per_encoding` pairs each
encoding of a rate table with its counter, so the text is counted once per distinct counter
and not once per model.
"""

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from trajspark.functions.text import IMAGE_MARK, estimate_tokens


def per_encoding(models, counters=None):
    """([distinct counters], {encoding: position}). Without `counters` all share the estimate."""
    counters = counters or {}
    distinct, position = [], {}
    for model in models.values():
        counter = counters.get(model.encoding, estimate_tokens)
        if counter not in distinct:
            distinct.append(counter)
        position[model.encoding] = distinct.index(counter)
    return distinct, position


def tokens_column(i):
    return f"text_tokens_{i}"


def message_tokens(content, counter=estimate_tokens):
    """Tokens of one message: null or empty 0, a bare image mark 0, all else counted whole."""
    return (F.when(F.coalesce(content, F.lit("")).isin("", IMAGE_MARK), F.lit(0).cast("long"))
            .otherwise(counter(content)))


def flat_message_tokens(messages: DataFrame, content="content", counter=estimate_tokens):
    """Adds `tokens` to one row per message; narrow."""
    return messages.withColumn("tokens", message_tokens(F.col(content), counter))


def distinct_message_tokens(messages: DataFrame, keys, content="content",
                            counter=estimate_tokens):
    """keys and `tokens`, counting every distinct content once and joining the count back.

    For a costly counter over text that repeats far apart. Copies collapse before the shuffle;
    on the way back only keys and digests travel, and AQE splits a hot digest.
    """
    text = F.col(content)
    counts = messages.filter(text.isNotNull()).select(content).distinct().select(
        F.sha2(text, 256).alias("_digest"), message_tokens(text, counter).alias("_tokens"))
    joined = messages.select(*keys, F.sha2(text, 256).alias("_digest")).join(
        counts, "_digest", "left")
    return joined.select(*keys, F.when(F.col("_digest").isNull(), F.lit(0).cast("long"))
                         .otherwise(F.col("_tokens")).alias("tokens"))


def tokens_by_conversation(messages: DataFrame, keys, content="content",
                           counters=(estimate_tokens,)) -> DataFrame:
    """Sum over messages, text_tokens_<i> per counter; partial sums before the shuffle keep one
    hot conversation cheap.

    A message that cannot be encoded leaves its conversation's sum null.
    """
    names = [tokens_column(i) for i in range(len(counters))]
    counted = messages.select(*keys, *[message_tokens(F.col(content), c).alias(n)
                                       for c, n in zip(counters, names)])
    return counted.groupBy(*keys).agg(*[
        F.when(F.count_if(F.col(n).isNull()) == 0, F.sum(n)).alias(n) for n in names])


def nested_text_tokens(messages, counter=estimate_tokens):
    """Sum over an array of messages inside the row: no explode, no shuffle."""
    if hasattr(counter, "over_array"):
        return counter.over_array(F.transform(
            messages,
            lambda m: F.when(m["content"] == IMAGE_MARK, F.lit("")).otherwise(m["content"])))
    return F.coalesce(F.aggregate(
        messages, F.lit(0).cast("long"),
        lambda acc, m: acc + message_tokens(m["content"], counter)), F.lit(0).cast("long"))


@lru_cache(maxsize=4)
def _load_encoding(encoding, rank_file, pattern, special_tokens):
    """Kept for the life of a Python worker, which serves many tasks."""
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe
    if rank_file is None:
        return tiktoken.get_encoding(encoding)
    return tiktoken.Encoding(name=encoding, pat_str=pattern,
                             mergeable_ranks=load_tiktoken_bpe(rank_file),
                             special_tokens=dict(special_tokens))


def exact_counter(encoding, rank_file=None, pattern=None, special_tokens=None):
    """Exact byte-pair counter, one tokenizer per Python worker.

    Each Arrow batch counts a repeated content once; prefixes of one task lie next to each
    other, so most repeats meet in one batch and no shuffle on content is needed. Text holding
    a special token cannot be encoded and counts null. `rank_file` must be readable on every
    executor; without it the tokenizer package looks the encoding up by name.
    """
    special = tuple((special_tokens or {}).items())

    def count(tokenizer, text):
        try:
            return len(tokenizer.encode(text)) if text else 0
        except ValueError:
            return None

    @F.pandas_udf(LongType())
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = _load_encoding(encoding, rank_file, pattern, special)
        for texts in batches:
            known = {t: count(tokenizer, t) for t in texts.dropna().unique()}
            yield texts.map(known).astype("Int64").where(texts.notna(), 0)

    @F.pandas_udf(LongType())
    def summed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = _load_encoding(encoding, rank_file, pattern, special)
        for lists in batches:
            flat = lists.explode()
            known = {t: count(tokenizer, t) for t in flat.dropna().unique()}
            counts = flat.map(known).astype("Int64").where(flat.notna(), 0)
            yield counts.groupby(level=0, sort=False).agg(lambda s: s.sum(skipna=False))

    def counter(text):
        return whole(text)

    counter.over_array = summed
    return counter
