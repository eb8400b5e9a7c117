"""Continuous checked ingestion: JSON-line files in, accepted and refused rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbar.operators import validate as v
from quillbar.plans.registry import TableSpec


def read_records(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Each line of the arriving files is one record."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder).withColumnRenamed("value", "record")


def start_ingest(records: DataFrame, spec: TableSpec, accepted: str, refused: str, checkpoint: str,
                 atomic: bool = False, trigger: dict | None = None):
    """Start the query; each micro-batch is one batch for ``atomic``. ``trigger`` as in ``DataStreamWriter.trigger``; by
    default what is there is taken in and the query ends.

    Both outputs are written to a folder named after the batch number and replaced on a retry, so a batch that is run
    again after a failure leaves no duplicates. The input is narrow and parsed twice rather than cached.
    """

    def write(batch: DataFrame, number: int) -> None:
        marked = v.mark_batches(v.validate(batch.withColumn("_batch", F.lit(number)), spec), "_batch", atomic)
        v.accepted_rows(marked).write.mode("overwrite").parquet(f"{accepted}/batch_id={number}")
        v.rejected_rows(marked).drop("_batch").write.mode("overwrite").parquet(f"{refused}/batch_id={number}")

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
