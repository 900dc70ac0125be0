"""New files in a folder, each cleaned once, as a stream that ends when all that is there has been read."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from plumbline.plans.batch import clean_file, save_outputs
from plumbline.plans.cleaning import Options


def clean_arrivals(spark: SparkSession, inbox: str, outbox: str, state: str, options: Options = Options()) -> StreamingQuery:
    """Starts the stream. Which files are done is kept under ``state``; failures are written to ``<outbox>/failed``."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.{csv,tsv,txt,xlsx,xlsm}").load(inbox)

    def handle(batch: DataFrame, number: int) -> None:
        failures = []
        for row in batch.select("path").toLocalIterator():
            path = row.path.removeprefix("file:")
            path = "/" + path.lstrip("/")
            try:
                save_outputs(clean_file(spark, path, options), outbox)
            except Exception as e:
                failures.append((os.path.basename(path), f"{type(e).__name__}: {e}"))
        if failures:
            spark.createDataFrame(failures, "file string, reason string").write.mode("overwrite").parquet(f"{outbox}/failed/{number}")

    return files.select("path").writeStream.foreachBatch(handle).option("checkpointLocation", state).trigger(availableNow=True).start()
