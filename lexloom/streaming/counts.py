"""Counting operators on streams: sums only, so a stream's counts end at those of the batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.corpus import sentence_phrases
from ..operators.tokenize import sentences, tokens


def document_stream(spark: SparkSession, path: str, schema, per_trigger: int = 100) -> DataFrame:
    """A folder of Parquet files as a stream of documents."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def _sentences(documents: DataFrame, cap: int | None) -> DataFrame:
    found = sentences(F.col("text"))
    return documents.select(F.explode(F.slice(found, 1, cap) if cap is not None else found).alias("s"))


def phrase_counts(documents: DataFrame, longest: int = 3, cap: int | None = None) -> DataFrame:
    """phrase, cnt as documents arrive; write in update or complete mode."""
    each = _sentences(documents, cap).select(tokens(F.col("s")).alias("words")).where(F.size("words") > 0)
    return each.select(F.explode(sentence_phrases(F.col("words"), longest)).alias("phrase")).groupBy("phrase").agg(F.count("*").alias("cnt"))


def word_counts(documents: DataFrame, cap: int | None = None) -> DataFrame:
    """word, cnt: sentences that hold each word in key form."""
    each = _sentences(documents, cap).select(F.explode(F.array_distinct(tokens(F.col("s"), True))).alias("word"))
    return each.where("word != ''").groupBy("word").agg(F.count("*").alias("cnt"))


def arrivals(documents: DataFrame, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Documents per window of arrival; rows later than the watermark are left out of closed windows."""
    return documents.withWatermark("added_at", late).groupBy(F.window("added_at", width)).agg(F.count("*").alias("n")).select("window.start", "n")
