"""Streams (an extension: the operators' batch forms are the ones the corpus tools ask for).

New corpus files are parsed as they land, counts are kept by window with late rows dropped after a watermark, and second
deliveries are taken out by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.sources import text as src


def watch_corpus(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """A stream of (path, text): each new file once."""
    s = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob).load(folder)
    return s.select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def watch_blocks(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """A stream of blocks: parsing stays inside a file, so the batch parser serves."""
    return src.blocks(watch_corpus(spark, folder, glob), "path")


def deliveries_once(stream: DataFrame, key: str, time: str, late: str = "7 days") -> DataFrame:
    """Each id once; a second delivery later than the watermark after the first counts anew."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """(start, by, n): rows by time window; rows later than the watermark are dropped. Works on tables too."""
    w = stream.withWatermark(time, late) if stream.isStreaming else stream
    return w.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")
