"""A training-corpus pipeline: every stage takes the documents that the stage before it kept."""

from trajspark.llm import line_dedup, mixing, simhash, toxicity, unigram
from trajspark.llm.common import stored


def toxicity_stage(spark, docs, sf_dir):
    """Documents predicted toxic go."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark, docs, sf_dir):
    """Lines that an earlier document or line has already, word for word or but for one word, go;
    so do documents of which nothing is left."""
    return line_dedup.deduped(docs)


def simhash_stage(spark, docs, sf_dir):
    """One document of each group of near copies stays, that with the smallest doc_id: three-word
    shingles, fingerprints linked at two bits or fewer."""
    return simhash.simhash_dedup(docs)


def mixing_stage(spark, docs, sf_dir):
    """Documents are drawn so that each source comes near its share of all words; one drawn more
    than once is repeated."""
    return mixing.mixed(docs)


def encoding_stage(spark, docs, sf_dir):
    """The ids of every document of the mix, and whether they decode to its text."""
    return unigram.tokenized(docs)


STAGES = [("toxicity", toxicity_stage), ("line dedup", line_stage),
          ("simhash near-dedup", simhash_stage), ("source mixing", mixing_stage),
          ("sentencepiece", encoding_stage)]
ORACLE_SQL = None       # a trained classifier and a Viterbi search are beyond SQL; see the tests


def run(spark, sf_dir):
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
