"""One JSON array of objects as a splittable source.

An indented array has its records between lines that hold nothing but the first indentation and a
brace. A raw line break cannot stand inside a JSON string, so such a line ends a record of the
outer array and nothing else. The closing line is the separator the text reader cuts files at, in
as many tasks as it likes; what lies between two separators lacks its closing brace, the first
piece has the opening bracket before it and the last one the closing bracket behind it. Pieces are
mended and parsed as arrays, so that a piece with several records, of a file laid out otherwise,
loses none of them.
"""

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

BLANKS = " \t\r\n"


def record_end(spark: SparkSession, path):
    """The lines that end a record of the first file at `path`, or None if it is not indented.
    Reads what comes before the first brace; a byte or a few of an array of objects."""
    first = spark.read.option("lineSep", "{").text(path).limit(1).collect()
    layout = re.fullmatch(r"\[(\r?\n)([ \t]+)", first[0].value) if first else None
    return layout and f"{layout[1]}{layout[2]}}},{layout[1]}"


def read_pieces(spark: SparkSession, path, end) -> DataFrame:
    """The text between separators, `value`; splittable."""
    return spark.read.option("lineSep", end).text(path)


def mended(value):
    """A piece as an array of its own."""
    body = F.rtrim(value, F.lit(BLANKS))
    one_line = body.startswith("[") & ~body.contains("\n") & body.endswith("]")
    last = body.endswith("\n]") | one_line
    start = F.when(body.startswith("["), F.lit(2)).otherwise(F.lit(1))
    size = F.length(body) - start + F.when(last, 0).otherwise(1)
    inner = F.substring(body, start, size)
    return F.when(last, F.concat(F.lit("["), inner, F.lit("]"))).otherwise(
        F.concat(F.lit("["), inner, F.lit("}]")))


def parse_pieces(pieces: DataFrame, schema, corrupt=None) -> DataFrame:
    """Records of pieces in the declared schema (DDL text). A piece that is no JSON, or a record
    that does not fit the schema, fails the query; with a column name `corrupt` its text stays
    there, record by record as far as they can be told apart."""
    whole = mended(F.col("value"))
    if corrupt is None:
        records = F.from_json(whole, f"array<struct<{_colons(schema)}>>", {"mode": "FAILFAST"})
        return pieces.select(F.inline(records))
    parts = F.from_json(whole, "array<string>")
    texts = pieces.select(F.explode(F.coalesce(parts, F.array(F.col("value")))).alias("text"),
                          parts.isNull().alias("broken"))
    record = F.from_json(F.when(~F.col("broken"), F.col("text")), f"{schema}, {corrupt} string",
                         {"columnNameOfCorruptRecord": corrupt})
    rows = texts.select("text", "broken", record.alias("r")).select("text", "broken", "r.*")
    # A null record would come out as nulls without a trace.
    lost = F.col("broken") | F.col("text").isNull() | ~F.ltrim(F.col("text"), F.lit(BLANKS)).startswith("{")
    return rows.withColumn(corrupt, F.when(lost, F.coalesce("text", F.lit("null")))
                           .otherwise(F.col(corrupt))).drop("text", "broken")


def _colons(schema):
    from pyspark.sql.types import StructType
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in StructType.fromDDL(schema))
