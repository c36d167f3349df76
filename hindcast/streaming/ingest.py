"""Resumable capture of landed files as a stream."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.sources.lineage import _exists

#: Parts of the landed table; the directory names tell them apart, so reading one touches no other's files.
PARTS = 64
#: The state store that holds more keys than memory does, and writes changes instead of whole snapshots.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _others(spark: SparkSession, out_dir: str, own: str) -> list[str]:
    """Captures that other checkpoints have landed."""
    if not _exists(spark, out_dir):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path(out_dir)
    names = [f.getPath().getName() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    return [f"{out_dir}/{n}" for n in names if n.startswith("capture=") and not n.startswith(f"capture={own}-")]


def ingest_incremental(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: str, keys: Sequence[str], fmt: str = "parquet", *, forget: tuple[str, str] | None = None, files: int | None = None) -> None:
    """Takes up new files only and resumes after a failure.

    A row whose key and content have landed is not landed again, so a replayed file adds nothing; a correction (same
    key, other content) lands as another row.  What has landed is kept as state by key and content, in the store
    beside the stream's offsets: a batch reads its own files and the state of its own keys, never what was landed
    before, however long the history is.  A batch is written once under its number and the stream's id; if it is
    run again after a failure it replaces itself, from the same state.

    forget=(event time column, delay) lets the store drop keys that are older than the latest event time by more than the
    delay, so its size is bounded; a row that comes again later than that lands again.  Without it nothing is
    forgotten.  files bounds the files of one batch.

    Another checkpoint over the same table starts with an empty state.  For that case, and only then, a batch is
    compared with what the others have landed, in the hash parts it has rows for.
    """
    names = [x.split()[0] for x in schema.split(",")]
    reader = spark.readStream.schema(schema).format(fmt)
    stream = (reader.option("maxFilesPerTrigger", files) if files else reader).load(in_dir)
    content = F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)
    rows = stream.withColumns({"content": content, "part": F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int")})
    rows = rows.withWatermark(*forget).dropDuplicatesWithinWatermark([*keys, "content"]) if forget else rows.dropDuplicates([*keys, "content"])

    def land(batch: DataFrame, number: int) -> None:
        own = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "capture"
        others = _others(spark, out_dir, own)
        if others:
            touched = [r["part"] for r in batch.select("part").distinct().collect()]  # PARTS at most
            old = spark.read.option("basePath", out_dir).parquet(*others).where(F.col("part").isin(touched))
            batch = batch.join(old.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("content").alias("__content")),
                               reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in [*keys, "content"]]), "left_anti")
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").partitionBy("part").parquet(f"{out_dir}/capture={own}-{number}")

    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        stream = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(land).start()
        stream.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
