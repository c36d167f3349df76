"""Sinks, versions, incremental capture and stored models in a folder of their own."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hindcast.operators import estimators, gates
from hindcast.sources import lineage
from hindcast.streaming.ingest import ingest_incremental


def test_versions_are_never_overwritten(spark, tmp_path):
    df = spark.range(3)
    lineage.land_version(df, f"{tmp_path}/raw", "v1", "run1")
    lineage.land_version(df.where("id > 0"), f"{tmp_path}/raw", "v2", "run2")
    with pytest.raises(ValueError):
        lineage.land_version(df, f"{tmp_path}/raw", "v1", "run3")
    assert {r["version"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/raw").groupBy("version").count().collect()} == {"v1": 3, "v2": 2}


def test_layer_names_its_parent(spark, tmp_path):
    lineage.write_layer(spark.range(1), f"{tmp_path}/interim", "v1", "dedupe", "cfg", "because")
    assert spark.read.parquet(f"{tmp_path}/interim").select("parent_version", "step", "config", "why").first() == ("v1", "dedupe", "cfg", "because")


def test_corrupt_rows_are_kept(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"a": 1}\n{"a": oops}\n')
    df = lineage.read_raw(spark, str(tmp_path / "in.json"), "a int, _corrupt_record string", "json").cache()
    assert df.where("_corrupt_record is not null").count() == 1


def test_quarantine_two_sinks(spark, tmp_path):
    ok, bad = gates.split_reasons(spark.range(10), [("big", F.col("id") < 7)])
    ok.write.parquet(f"{tmp_path}/ok")
    bad.write.parquet(f"{tmp_path}/bad")
    assert spark.read.parquet(f"{tmp_path}/ok").count() == 7
    assert {r["reason"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()} == {"big"}


def test_ingest_resumes_and_keeps_corrections(spark, tmp_path):
    def land(name, rows):
        spark.createDataFrame(rows, "k int, v string").coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def run(checkpoint="ckpt"):
        ingest_incremental(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/{checkpoint}", "k int, v string", ["k"])
        return spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out").collect()

    land("a", [(1, "x"), (1, "x"), (2, None)])
    assert len(run()) == 2
    land("b", [(1, "x"), (1, "corrected"), (3, "z")])
    assert len(run()) == 4
    assert len(run()) == 4
    land("c", [(None, "n"), (1, "again")])
    assert len(run("other")) == 6  # a new checkpoint replays all files: nothing is lost or landed twice


def _landing(spark, tmp_path, schema="k int, v string"):
    def land(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def run(checkpoint="ckpt", **options):
        ingest_incremental(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/{checkpoint}", schema, ["k"], **options)
        return spark.read.option("recursiveFileLookup", "true").schema(f"{schema}, content string, batch int").parquet(f"{tmp_path}/out").collect()

    return land, run


def test_ingest_reads_no_history(spark, tmp_path):
    """What has landed is told from the state: it need not even be there any more."""
    land, run = _landing(spark, tmp_path)
    land("a", [(k, "x") for k in range(50)])
    assert len(run()) == 50
    (tmp_path / "out").rename(tmp_path / "archive")
    land("b", [(k, "x") for k in range(40, 60)] + [(3, "corrected")])
    assert {(r["k"], r["v"]) for r in run()} == {(k, "x") for k in range(50, 60)} | {(3, "corrected")}


def test_ingest_replays_a_batch(spark, tmp_path):
    """A batch that was written but not committed is written again, once."""
    land, run = _landing(spark, tmp_path)
    land("a", [(1, "x"), (2, "y")])
    run()
    land("b", [(2, "y"), (3, "z")])
    assert len(run()) == 3
    last = max((tmp_path / "ckpt" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (tmp_path / "ckpt" / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    assert sorted((r["k"], r["v"]) for r in run()) == [(1, "x"), (2, "y"), (3, "z")]


def test_ingest_batches_share_state(spark, tmp_path):
    land, run = _landing(spark, tmp_path)
    for k in range(4):
        land(f"f{k}", [(1, "x"), (10 + k, "y")])
    assert len(run(files=1)) == 5 and len(list((tmp_path / "out").glob("capture=*"))) >= 4


def test_ingest_forgets_by_event_time(spark, tmp_path):
    land, run = _landing(spark, tmp_path, "k int, at timestamp")
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    land("a", [(1, at(0))])
    land("b", [(1, at(0)), (2, at(1))])
    assert len(run(forget=("at", "1 hour"))) == 2
    land("c", [(3, at(50))])
    assert len(run(forget=("at", "1 hour"))) == 3
    land("d", [(1, at(0)), (3, at(50))])  # too late, and repeated
    assert len(run(forget=("at", "1 hour"))) == 3


def test_impact_of_chains_diamonds_and_cycles(spark):
    edges = [(k, k + 1) for k in range(1, 11)] + [(20, 21), (20, 22), (21, 23), (22, 23), (23, 24)] + [(30, 31), (31, 32), (32, 30), (32, 32)] + [(None, 1), (1, None), (40, 41)]
    links = spark.createDataFrame(edges * 2, "parent_id long, child_id long")

    def trace(*ids):
        return {r["id"]: r["depth"] for r in lineage.impact_trace(spark.createDataFrame([(i,) for i in ids], "id long"), links).collect()}

    assert trace(1) == {k: k - 1 for k in range(2, 12)}
    assert trace(20) == {21: 1, 22: 1, 23: 2, 24: 3}
    assert trace(30) == {31: 1, 32: 2, 30: 3}
    assert trace(99) == {} == trace(None)
    assert trace(4, 40, 23) == {k: k - 4 for k in range(5, 12)} | {41: 1, 24: 1}


def test_saved_model_scores_without_refit(spark, tmp_path):
    df = spark.createDataFrame([(float(i % 5), float(i % 2), float(i % 3)) for i in range(60)], "f1 double, f2 double, runs double")
    model = estimators.fit_runs(df, ["f1", "f2"])
    model.write().save(f"{tmp_path}/model")
    again = estimators.predict_saved(df, f"{tmp_path}/model")
    assert [round(r["prediction"], 9) for r in again.collect()] == [round(r["prediction"], 9) for r in model.transform(df).collect()]
