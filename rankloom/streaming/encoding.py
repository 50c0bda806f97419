"""The resumable encoding job as a stream over a growing folder of texts.

Each run takes the files that no earlier run has finished and then stops; the
checkpoint folder remembers which those are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def encode_new_files(
    spark: SparkSession,
    source: str,
    schema: str,
    encode: Callable[[DataFrame], DataFrame],
    target: str,
    progress: str,
    files_per_batch: int = 1000,
) -> int:
    """Append vectors for the new files under source to target; number of batches run.

    The file sink commits a batch as a whole, so a run that dies is resumed
    without repeated or missing rows. encode must be map-only.
    """
    texts = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )
    run = (
        encode(texts)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return len([p for p in run.recentProgress if p["numInputRows"] > 0])
