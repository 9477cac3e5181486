"""The resumable batch as a file-source stream: each run takes the files that are new and stops.

The checkpoint remembers what was read, and the sink commits a batch once, so a restarted run neither skips nor
repeats an image.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.quality import glint_parts, screened
from ..sources.manifests import rebuild


def screen_new_images(spark: SparkSession, source: str, schema: StructType | str, out: str, checkpoint: str, *, keys: list[str], nir: str, blue: str) -> None:
    """Sums up the pixels of files that arrived since the last run. An image may lie in many files and arrive in many runs: each batch
    leaves exact sums and counts of its part, and a batch that is run again replaces its own."""

    def sum_up(batch: DataFrame, batch_id: int) -> None:
        glint_parts(batch, keys, nir, blue).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(sum_up).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def screened_images(spark: SparkSession, out: str, keys: list[str], **limits: float) -> DataFrame:
    """The images that have arrived so far, screened over all their parts."""
    return screened(spark.read.parquet(out), keys, **limits)


def collect_new_metadata(spark: SparkSession, folder: str, schema: str, key: str, out: str, checkpoint: str) -> None:
    """Appends the metadata of JSON-lines files that are new; a line is a sample."""
    texts = spark.readStream.schema("value string").option("recursiveFileLookup", True).text(folder)
    good, _ = rebuild(texts.select(F.lit("").alias("path"), F.col("value").alias("json")), schema, key)
    good.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
