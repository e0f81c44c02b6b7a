"""Incremental runs with Structured Streaming: files that arrived since the last run, each processed once.

A run is a stream with trigger(availableNow): it takes what is there and ends; its checkpoint remembers what was taken,
so a run after a failure goes on where the last batch was committed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from graniteflow.operators.latest import newest_per_key
from graniteflow.sources.objects import ObjectStore


def arrivals(spark: SparkSession, folder: str, schema, per_batch: int = 1000) -> DataFrame:
    """Rows of Parquet files in a folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per window and key; rows later than ``late`` are dropped and the state of closed windows is freed."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def unique_arrivals(events: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """Rows whose key was not seen within the watermark."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def append_now(stream: DataFrame, target: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write what has arrived to a Parquet folder and end."""
    return stream.writeStream.outputMode(mode).format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def update_now(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write the rows that each batch changed, with its number, and end; ``newest_updates`` reads the last state.

    A batch that is run again writes its own folder over, so nothing counts twice; state that the watermark closes is freed.
    """

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest_updates(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The last row of every key out of what ``update_now`` wrote."""
    return newest_per_key(spark.read.parquet(target), keys, F.desc("batch")).drop("batch")


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_now(stream: DataFrame, keys: list[str], order: str, target: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Keep the newest row of every key in ``buckets`` folders by hash of the key, and end.

    A batch reads and rewrites only the buckets that it touches, as versions under its own number; the manifest of that
    number, written last, says which version of each bucket counts. So readers never see a half-written table and a batch
    that is run again writes the same. Versions that neither of the last two manifests names are deleted.
    """

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        store = ObjectStore(spark, target)
        placed = batch.withColumn("bucket", bucket_of(keys, buckets))
        before = manifest(store, number - 1)
        touched = sorted(r["bucket"] for r in placed.select("bucket").distinct().collect())  # at most ``buckets``
        rows = placed
        old = [f"{target}/v{before[b]}/bucket={b}" for b in touched if b in before]
        if old:
            rows = rows.unionByName(spark.read.parquet(*old).withColumn("bucket", bucket_of(keys, buckets)).select(*rows.columns))
        kept = newest_per_key(rows, keys, F.col(order).desc_nulls_last(), F.xxhash64(*batch.columns))
        kept.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/v{number}")
        now = before | {b: number for b in touched}
        store.put_json(f"manifests/{number}.json", {str(b): v for b, v in now.items()})
        used = {(v, b) for m in (before, now) for b, v in m.items()}
        for name in store.folders():
            if name.startswith("v") and not any(name == f"v{v}" for v, _ in used):
                store.delete_folder(name)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def manifest(store: ObjectStore, number: int) -> dict[int, int]:
    """The version of each bucket after a batch, empty before the first."""
    found = [int(n.split("/")[-1][:-5]) for n, _ in store.listing("manifests/")]
    fit = [k for k in found if k <= number]
    return {int(b): v for b, v in store.get_json(f"manifests/{max(fit)}.json").items()} if fit else {}


def upserted(spark: SparkSession, target: str) -> DataFrame:
    """The table that ``upsert_now`` keeps, as of its last manifest."""
    now = manifest(ObjectStore(spark, target), 1 << 60)
    if not now:
        raise ValueError(f"no table at {target}")
    return spark.read.parquet(*(f"{target}/v{v}/bucket={b}" for b, v in sorted(now.items())))


def to_do(rows: DataFrame, done_at: str, changed_at: str) -> DataFrame:
    """Rows that were never processed or changed since: what a batch-wise incremental run takes."""
    return rows.where(F.col(done_at).isNull() | (F.col(changed_at) > F.col(done_at)))
