"""Stream of fact rows into stored company documents.

Every batch is merged as one generation of the store, under the name of the stream and the batch's number. A batch that is
delivered again, after a crash or with a lost checkpoint, is known from the manifest and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cadastra.plans.documents import build_documents
from cadastra.plans.store import merge_into


def upsert_documents(
    spark: SparkSession,
    source: str,
    path: str,
    checkpoint: str,
    schema: StructType,
    stream: str = "fato",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start merging all Parquet files of fact rows that are new since the last run; the query ends by itself.

    The rows of a company should come in one batch: an establishment counts as often as the batch has it that has it most often.
    """

    def merge(batch: DataFrame, number: int) -> None:
        merge_into(path, build_documents(batch), stream, number)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
