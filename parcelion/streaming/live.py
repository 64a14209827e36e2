"""Key figures kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parcelion.session import path_exists


def running_counts(stream: DataFrame, by: str = "commune", amount: str = "valeur_fonciere") -> DataFrame:
    """Rows and mean amount per key so far. State holds one row per key; copies of one
    key are combined before the shuffle."""
    return stream.groupBy(by).agg(F.count(F.lit(1)).alias("nb"), F.avg(amount).alias("moyenne"))


def start_refresh(figures: DataFrame, path: str, checkpoint: str, trigger_seconds: int | None = 5) -> StreamingQuery:
    """Store the figures after every micro-batch in a folder of their own, so that a reader
    of :func:`latest` never sees a half-written table. The last two are kept."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/lot={batch_id}")
        spark = batch.sparkSession
        for number in _complete(spark, path):
            if number < batch_id - 1:
                place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/lot={number}")
                place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

    writer = (
        figures.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
    )
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def _complete(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the lots below ``path`` whose writing has ended."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(top)]
    found = [int(name.removeprefix("lot=")) for name in names if name.startswith("lot=")]
    return sorted(n for n in found if path_exists(spark, f"{path}/lot={n}/_SUCCESS"))


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete figures."""
    return spark.read.parquet(f"{path}/lot={_complete(spark, path)[-1]}")


def overview(figures: DataFrame, rows: int = 5) -> DataFrame:
    """The keys with the most rows, with the rows and mean amount over all keys."""
    by = figures.columns[0]
    mean = F.sum(F.col("nb") * F.col("moyenne")) / F.sum("nb")
    whole = figures.agg(F.sum("nb").alias("total"), mean.alias("moyenne")).first()
    top = figures.select(by, "nb").orderBy(F.desc("nb"), by).limit(rows)
    return top.withColumns({"total": F.lit(whole["total"]).cast("long"), "moyenne": F.lit(whole["moyenne"]).cast("double")})
