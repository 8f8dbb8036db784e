"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries as Q, views as V  # noqa: E402
from trajspark.operators import expand as P  # noqa: E402
from trajspark.plans import jobs as J  # noqa: E402


def order_usage(spark, sf_dir):
    """Usage rows of every prefix of every order, all models."""
    return J.step_usage(*V.order_steps(spark, sf_dir), details=False)


def order_totals(spark, sf_dir):
    """The same corpus as totals only."""
    return J.step_totals(*V.order_steps(spark, sf_dir))


def order_training_rows(spark, sf_dir):
    """Training rows of every prefix of every order."""
    heads, steps, _ = V.order_steps(spark, sf_dir)
    return P.training_rows(V.nested(heads, steps))


QUERIES = {name: Q.QUERIES[name] for name in (
    "training_set_cost", "training_messages_l2", "document_text_tokens", "conversation_usage",
    "training_row_usage", "chat_usage", "usage_totals_by_model", "compare_multiplier")}
QUERIES.update(order_usage=order_usage, order_totals=order_totals,
               order_training_rows=order_training_rows)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC")
             # Spares the call-site lookup of every column expression while plans are built.
             .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, run in QUERIES.items():
        best = None
        for _ in range(2):
            start = time.time()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.time() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({"metric": "headline queries, best of two, summed",
                      "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()
