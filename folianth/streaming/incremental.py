"""Incremental conversion: a file stream whose batches skip what a receipt already attests.

Each batch is joined against the receipts written so far and only new work is done; receipts are keyed by book and hash, so a
batch that is run again after a failure adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def fresh(batch: DataFrame, receipts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a batch without a receipt; a row that comes twice in a batch counts once."""
    return batch.dropDuplicates(keys).join(receipts.select(*keys).distinct(), keys, "left_anti")


def convert_new(spark: SparkSession, source: str, schema: StructType | str, convert: Callable[[DataFrame], DataFrame], keys: list[str], out: str, receipts: str, checkpoint: str) -> StreamingQuery:
    """Convert the rows of new Parquet files under `source` that have no receipt; results go to `out`, receipts to `receipts`.

    Each batch writes into folders of its own number, so a repeated batch replaces its own output.
    """
    key_schema = ", ".join(f"{k} string" for k in keys)

    def each(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        try:
            seen = session.read.parquet(f"{receipts}/batch=*").where(F.col("batch_id") != batch_id)
        except Exception:  # the first batch finds no receipts
            seen = session.createDataFrame([], key_schema)
        todo = fresh(batch.withColumns({k: F.col(k).cast("string") for k in keys}), seen, keys)
        convert(todo).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        todo.select(*keys).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{receipts}/batch={batch_id}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
