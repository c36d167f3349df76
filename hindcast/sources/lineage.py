"""Sources, sinks, versions and lineage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hindcast.sources.durable import durable


def read_raw(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """Landed captures with a declared schema; unreadable text rows are kept in _corrupt_record if the schema has it."""
    reader = spark.read.schema(schema).format(fmt)
    return (reader if fmt == "parquet" else reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")).load(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def land_version(df: DataFrame, path: str, version: str, run_id: str) -> None:
    """Appends a capture as a new version; a version that is there already is an error, never overwritten."""
    if _exists(df.sparkSession, f"{path}/version={version}"):
        raise ValueError(f"version {version} has landed before")
    df.withColumns({"run_id": F.lit(run_id), "captured_at": F.current_timestamp()}).write.mode("errorifexists").parquet(f"{path}/version={version}")


def write_layer(df: DataFrame, path: str, parent: str, step: str, cfg: str, reason: str | None = None) -> None:
    """A new interim or processed table that names its parent version, step, configuration and reason."""
    df.withColumns({"parent_version": F.lit(parent), "step": F.lit(step), "config": F.lit(cfg), "why": F.lit(reason).cast("string")}).write.mode("errorifexists").parquet(path)


def with_context(df: DataFrame, **ctx) -> DataFrame:
    """Stamps a struct of target, reference time, horizon, versions, run id or state on every row."""
    return df.withColumn("context", F.struct(*[F.lit(v).alias(k) for k, v in ctx.items()]))


def version_as_of(df: DataFrame, keys: Sequence[str], ver_ts: str, as_of: Column, ties: Sequence[str] = ()) -> DataFrame:
    """The latest version of each key that was known at an instant."""
    return version_latest(df.where(F.col(ver_ts) <= as_of), keys, ver_ts, ties)


def version_latest(df: DataFrame, keys: Sequence[str], ver_ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """The latest version of each key; for labels only, since it may be newer than any reference time."""
    w = Window.partitionBy(*keys).orderBy(F.desc(ver_ts), *[F.desc(c) for c in ties])
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def version_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(keys..., change, changed_columns): keys added, removed or changed from a to b."""
    left = a.select(*keys, F.struct(*cols).alias("a"))
    right = b.select(*keys, F.struct(*cols).alias("b"))
    differs = F.array_compact(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), c) for c in cols]))
    both = left.join(right, list(keys), "full").withColumn("differs", differs)
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.size("differs") > 0, "changed")
    return both.select(*keys, change.alias("change"), F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.array_join("differs", ",")).otherwise("").alias("changed_columns")).where("change is not null")


def impact_trace(changed: DataFrame, edges: DataFrame | Sequence[DataFrame], key: str = "id") -> DataFrame:
    """Everything downstream of the changed ids, at any depth.

    With edges (parent_id, child_id): (id, depth) by the fewest steps.  Each round follows only the ids that the round before has
    found first, and keeps what no round had found, so cycles end and an id is followed once; a changed id is
    downstream of itself only if a path leads back to it.  Rounds are as many as the longest shortest path.  With a
    list of layers, edges[k] from layer k to k + 1: (layer, id), ids of different layers being apart.
    """
    if not isinstance(edges, DataFrame):
        return _impact_by_layer(changed, edges, key)
    links = durable(edges.select("parent_id", "child_id").where("parent_id is not null and child_id is not null").distinct())
    front = changed.select(F.col(key).alias("parent_id")).where("parent_id is not null").distinct()
    found, depth = None, 0
    while True:
        depth += 1
        new = links.join(front, "parent_id", "left_semi").select(F.col("child_id").alias("id")).distinct()
        if found is not None:
            new = new.join(found, "id", "left_anti")
        new = durable(new.withColumn("depth", F.lit(depth).cast("long")))
        if new.isEmpty():
            return new if found is None else found
        # Each round's rows are read from where they were written; the union of many rounds is written together.
        found = new if found is None else found.unionByName(new)
        found = durable(found) if depth % 16 == 0 else found
        front = new.select(F.col("id").alias("parent_id"))


def _impact_by_layer(changed: DataFrame, edges: Sequence[DataFrame], key: str) -> DataFrame:
    found, out = changed.select(F.col(key).alias("parent_id")).distinct(), []
    for k, e in enumerate(edges):
        found = e.join(found, "parent_id", "left_semi").select(F.col("child_id").alias("parent_id")).distinct()
        out.append(found.select(F.lit(k + 1).cast("long").alias("layer"), F.col("parent_id").alias("id")))
    return reduce(DataFrame.unionByName, out)


def manifest_compare(targets: DataFrame, captures: DataFrame, key: str) -> DataFrame:
    """Planned targets against captures (key, failed, n_rows), with a state for each; targets has (key, scheduled, finished)."""
    both = targets.withColumn("__t", F.lit(True)).join(captures.withColumn("__c", F.lit(True)), key, "full")
    state = (F.when(F.col("__t").isNull(), "unscheduled").when(~F.col("finished"), "unfinished").when(F.col("__c").isNull(), "missing")
             .when(F.coalesce("failed", F.lit(False)), "access failed").when(F.col("n_rows") == 0, "empty").otherwise("captured"))
    return both.select(key, state.alias("state"))


def completeness_by_period(manifest: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Included, missing and failed targets by season and period, with subtotals (null)."""
    return manifest.rollup(*dims).agg(F.count_if(F.col("state") == "captured").alias("included"), F.count_if(F.col("state") == "missing").alias("missing"),
                                      F.count_if(F.col("state") == "access failed").alias("failed"), F.count(F.lit(1)).alias("n"))


def scrub_request(df: DataFrame, col: str, names: Sequence[str]) -> DataFrame:
    """Takes secret fields out of recorded request conditions (a JSON object), whatever the case of their names."""
    fields = F.from_json(col, T.MapType(T.StringType(), T.StringType()))
    return df.withColumn(col, F.to_json(F.map_filter(fields, lambda k, _: ~F.lower(k).isin([n.lower() for n in names]))))


def parse_payload(df: DataFrame, col: str, schema: str) -> DataFrame:
    """Typed fields of a JSON payload beside the other columns."""
    return df.withColumn("__p", F.from_json(col, schema)).select(*[c for c in df.columns if c != col], "__p.*")


def reconstruct_sample(sample_ids: DataFrame, samples: DataFrame, parents: DataFrame, splits: DataFrame) -> DataFrame:
    """Parent rows, step, cutoff, label and split of sample ids: equi joins over lineage tables."""
    return sample_ids.join(samples, "sample_id").join(parents, "sample_id").join(splits, "sample_id")
