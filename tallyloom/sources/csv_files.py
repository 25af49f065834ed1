"""CSV ingest that keeps unreadable lines apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, StringType, StructType

RAW_LINE = "raw_line"
READABLE = "readable"
# Fixed value: a line of nothing but control characters and blanks.
BLANK = "^[\\x00-\\x20]*$"


def ingest_csv(spark: SparkSession, path: str, schema: StructType, target: str) -> DataFrame:
    """Parse CSV lines with a declared schema into a Parquet table at ``target``.

    The text is parsed once. A line that does not fit the schema, is blank, or
    holds a number that is not finite, is kept whole in ``raw_line`` under the
    partition ``readable=false``; all others lie under ``readable=true``, so either
    kind is read without the other.
    """
    with_raw = StructType(list(schema.fields)).add(RAW_LINE, StringType())
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in with_raw.fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_LINE}
    parsed = spark.read.schema("line STRING").text(path).select(
        "line", F.from_csv("line", ddl, options).alias("row")
    )
    numbers = [f.name for f in schema.fields if isinstance(f.dataType, DoubleType | FloatType)]
    wrong = F.col("line").rlike(BLANK) | F.col("row").isNull() | F.col("row")[RAW_LINE].isNotNull()
    for name in numbers:
        value = F.col("row")[name]
        wrong |= F.coalesce(F.isnan(value) | (F.abs(value) == float("inf")), F.lit(False))
    marked = parsed.select(
        *[F.col("row")[f.name].alias(f.name) for f in schema.fields],
        F.when(wrong, F.col("line")).alias(RAW_LINE),
        (~wrong).alias(READABLE),
    )
    marked.write.mode("overwrite").partitionBy(READABLE).parquet(target)
    with_mark = StructType(list(with_raw.fields)).add(READABLE, BooleanType())
    return spark.read.schema(with_mark).parquet(target)


def good_rows(ingested: DataFrame) -> DataFrame:
    return ingested.where(READABLE).drop(READABLE, RAW_LINE)


def bad_lines(ingested: DataFrame) -> DataFrame:
    return ingested.where(~F.col(READABLE)).select(RAW_LINE)
