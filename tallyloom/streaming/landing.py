"""Skip-if-done processing of landed raw files as an incremental file stream.

The stream's checkpoint remembers which files were taken; a run takes the new ones and ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

LINES = "value string"


def take_new_files(
    spark: SparkSession, folder: str, checkpoint: str, handle: Callable[[DataFrame], None]
) -> None:
    """Pass the lines of files that landed since the last run, with their file path, to `handle`.

    A batch is repeated whole after a failure, so `handle` has to overwrite, not append; writing
    by table and year does.
    """
    lines = spark.readStream.schema(LINES).text(folder).select("value", "_metadata.file_path")
    query = (
        lines.writeStream.foreachBatch(lambda batch, _: handle(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
