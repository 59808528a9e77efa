"""Running aggregates over variant files as they arrive, with exact restart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def running_extent(spark: SparkSession, folder: str, schema: StructType, key: str, position: str, p: str, state: str, out: str) -> DataFrame:
    """(key, n, first_position, last_position, least_p) over all files that have arrived in ``folder`` so far.

    Takes in the files that are new since the last call and ends; ``state`` holds the stream's
    checkpoint, so each file counts once also after a failure. The result, one row a key, is
    replaced in ``out``; a batch that is run again writes the same rows. Rows with a null key form a
    group of their own, null positions and p values that are null or NaN don't count for the extremes.
    """
    known_p = F.when(~F.isnan(p), F.col(p))
    totals = spark.readStream.schema(schema).parquet(folder).groupBy(key).agg(F.count("*").alias("n"), F.min(position).alias("first_position"), F.max(position).alias("last_position"), F.min(known_p).alias("least_p"))
    write = lambda batch, _: batch.write.mode("overwrite").parquet(out)
    totals.writeStream.outputMode("complete").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return spark.read.schema(totals.schema).parquet(out)
