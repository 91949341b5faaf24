"""The same verification over arriving files: every step is within a document, the registry is a static side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citeflow.plans.verify import verify


def document_stream(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """doc_id and text of the ``.txt`` files that arrive under ``path``."""
    files = spark.readStream.option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    return files.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "").alias("doc_id"), F.col("value").alias("text"))


def start(documents: DataFrame, registry: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Verifies each batch of arrived documents and appends it; a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        verify(batch, registry).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return documents.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
