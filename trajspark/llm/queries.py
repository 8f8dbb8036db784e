"""The registered queries of this package: each applies its operator to its whole table."""

from trajspark.llm import (embeddings, hosts, infill, licenses, line_dedup, mixing, preferences,
                           secret_scan, simhash, toxicity, unigram, url_filter, whitening)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_dedup(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op2_preference_format(spark, sf_dir):
    return preferences.preference_rows(preferences.reply_pairs(
        table(spark, sf_dir, "conversations")))


def op3_source_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark, sf_dir):
    return unigram.tokenized(table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_license_scan(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark, sf_dir):
    return embeddings.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op9_host_quality(spark, sf_dir):
    return hosts.host_quality(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark, sf_dir):
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark, sf_dir):
    return infill.infill_digests(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_url_filter(spark, sf_dir):
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_dedup, op2_preference_format, op3_source_mixing, op4_sentencepiece, op5_toxicity,
    op6_license_scan, op7_line_dedup, op8_embedding_dedup, op9_host_quality, op10_secret_scan,
    op11_fill_in_middle, op12_embedding_whitening, op13_url_filter)}
ORACLE = {"op2_preference_format": preferences.ORACLE_SQL,
          "op6_license_scan": licenses.ORACLE_SQL, "op7_line_dedup": line_dedup.ORACLE_SQL,
          "op8_embedding_dedup": embeddings.ORACLE_SQL,
          "op9_host_quality": hosts.ORACLE_SQL, "op11_fill_in_middle": infill.ORACLE_SQL,
          "op13_url_filter": url_filter.ORACLE_SQL}
