"""Article classification over arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelweave.operators.embed import Encoder
from labelweave.plans.articles import Categories, Classified, classify_articles


def read_article_stream(spark: SparkSession, path: str) -> DataFrame:
    """New files in *path*, each one article."""
    files = spark.readStream.schema("value string").option("wholetext", True).format("text").load(path)
    located = files.select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"))
    return located.select(F.xxhash64("path").alias("article_id"), "text", "path")


def classify_stream(articles: DataFrame, categories: Categories, sink: Callable[[Classified, int], None],
                    checkpoint: str, encoder: str | Encoder = "trigrams") -> StreamingQuery:
    """Classify every micro-batch with the batch plan; scoring keeps no state."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        classified = classify_articles(batch, categories, encoder)
        sink(classified, batch_id)
        classified.described.unpersist()
    return (articles.writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(handle).start())
