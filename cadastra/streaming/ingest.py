"""File-source stream from raw files to a typed table.

Each input file is converted exactly once: the checkpoint remembers the files taken, and a batch is written to a folder
of its own, which a repeated batch replaces, so a crash leaves nothing half done. Files with line breaks inside quoted
fields are recognised batch by batch, file by file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cadastra.sources.bronze import located_lines, parse_lines, text_lines, whole_records
from cadastra.sources.silver import cast_schema


def ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: StructType,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start converting all files that are new since the last run; the query ends by itself."""

    def write(batch: DataFrame, number: int) -> None:
        raw = parse_lines(whole_records(located_lines(batch)), "line", schema)
        cast_schema(raw, schema).write.mode("overwrite").parquet(f"{target}/batch={number}")

    lines = text_lines(spark.readStream.option("maxFilesPerTrigger", files_per_batch), source)
    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
