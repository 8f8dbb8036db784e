from pyspark.sql import functions as F

from tests.llm.helpers import documents
from trajspark.llm import common, line_dedup


def is_hinted(frame):
    return "Hint" in frame._jdf.queryExecution().logical().toString()


def test_broadcast_counts_array_entries(spark, tmp_path, monkeypatch):
    few = spark.range(3).withColumn("held", F.sequence(F.lit(1), F.lit(4)))
    many = spark.range(3).withColumn("held", F.sequence(F.lit(1), F.lit(4000)))
    assert is_hinted(common.broadcast_if_small(few, 200, 10_000, "held", 16))
    assert not is_hinted(common.broadcast_if_small(many, 200, 10_000, "held", 16))
    none = few.withColumn("held", F.lit(None).cast("array<int>"))
    assert is_hinted(common.broadcast_if_small(none, 200, 600, "held", 16))
    assert is_hinted(common.broadcast_if_small(few.limit(0), 200, 0, "held", 16))

    # One document with very many lines is one row, but not a small one.
    seen = []

    def small(frame, row_bytes, **more):
        out = common.broadcast_if_small(frame, row_bytes, 4_000, **more)
        seen.append((frame.columns[-1][:7], is_hinted(out)))
        return out
    monkeypatch.setattr(line_dedup, "broadcast_if_small", small)
    text = "\n".join(f"one two three four five six seven w{k % 150}" for k in range(300))
    documents(spark, [(1, text, "s")]).write.parquet(str(tmp_path / "d"))
    kept = line_dedup.deduped(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert [r.text.count("\n") for r in kept] == [0]
    assert ("wanted", False) in seen and seen[-1] == ("empty_r", False)
