"""Pages as a stream: extracted, classified, first of an id only, appended; the checkpoint is the crawl log.

The watermark bounds the memory of ids: a page that comes again later than that is a document again, and the batch
reading, where the first record of an id wins, settles it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_docs
from ..operators.crawl import extract_pages

PAGES = "id long, url string, status string, html string, fetched timestamp"


def read_pages(spark: SparkSession, folder: str, files_each: int = 64) -> DataFrame:
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_each).parquet(folder)


def documents(pages: DataFrame, delay: str = "1 day") -> DataFrame:
    once = pages.withWatermark("fetched", delay).dropDuplicatesWithinWatermark(["id"])
    return extract_pages(once)


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, delay: str = "1 day", every: str | None = None) -> StreamingQuery:
    """Append documents of new pages to ``out``/docs and the outcome of every page to ``out``/log, exactly once.

    Without ``every`` all there is is taken and the query ends.
    """

    def store(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("batch", F.lit(number)).persist()
        rows.where("status = 'ok'").drop("status").write.mode("overwrite").parquet(f"{out}/docs/batch={number}")
        rows.select("id", "url", "status").write.mode("overwrite").parquet(f"{out}/log/batch={number}")
        rows.unpersist()

    stream = documents(read_pages(spark, folder), delay).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (stream.trigger(processingTime=every) if every else stream.trigger(availableNow=True)).start()


def status_counts(pages: DataFrame, window: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Pages of each status in windows of the fetching time; late ones count until the watermark has passed."""
    return documents_with_time(pages, delay).groupBy(F.window("fetched", window), "status").agg(F.count("*").alias("n"))


def documents_with_time(pages: DataFrame, delay: str) -> DataFrame:
    return pages.withWatermark("fetched", delay).select("fetched", "status")


def cleaned(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """A stream of (id, host, text) documents without the boilerplate lines of a finished batch run."""
    return clean_docs(docs, lines)
