"""Streams against their batch forms; state survives; refused batches leave the index alone."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from pricefold.streaming import changes

T0 = datetime(2025, 1, 1)
EVENTS = "url string, kind string, probed_at timestamp, status int, sha256 string, indexed boolean"


def at(i):
    return T0 + timedelta(hours=i)


def run(spark, tmp_path, batches):
    source, sink = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(str(source / f"b{i}"))
    stream = changes.detect_changes(changes.bounded_source(spark, EVENTS, f"{source}/*", 1))
    query = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return sorted((r.url, r.probed_at, r.verdict) for r in spark.read.parquet(sink).collect())


def test_change_detection(spark, tmp_path):
    first = [("a", "probe", at(1), 200, "h1", False), ("b", "probe", at(1), 200, "h1", True), ("c", "probe", at(1), 404, None, True)]
    second = [("a", "consumed", at(2), 0, "h1", False), ("b", "probe", at(2), 304, None, True), ("c", "probe", at(2), 200, "h9", True)]
    third = [("a", "probe", at(3), 200, "h2", True), ("a", "probe", at(0), 200, "old", True), ("b", "probe", at(3), 503, None, True)]
    fourth = [("a", "probe", at(4), 200, "h2", True), ("a", "consumed", at(5), 0, "h2", True), ("a", "probe", at(6), 200, "h2", True)]
    got = run(spark, tmp_path, [first, second, third, fourth])
    assert got == sorted([
        ("a", at(1), "new"), ("b", at(1), "baseline"), ("c", at(1), "dead"), ("a", at(2), "consumed"), ("b", at(2), "unchanged"), ("c", at(2), "ignored"),
        ("a", at(3), "changed"), ("a", at(0), "ignored"), ("b", at(3), "error"), ("a", at(4), "changed"), ("a", at(5), "consumed"), ("a", at(6), "same"),
    ])


def test_running_latest_equals_batch(spark, tmp_path):
    rows = [(f"u{i % 3}", "probe", at(i), 200, f"h{i}", True) for i in range(9)]
    source = tmp_path / "in"
    spark.createDataFrame(rows, EVENTS).repartition(3).write.parquet(str(source))
    stream = changes.running_latest(spark.readStream.schema(EVENTS).parquet(str(source)))
    query = stream.writeStream.format("memory").queryName("latest_probes").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    batch = changes.running_latest(spark.read.parquet(str(source)))
    assert sorted(map(tuple, spark.table("latest_probes").collect())) == sorted(map(tuple, batch.collect()))


def test_guarded_upsert(spark, tmp_path):
    folder = str(tmp_path / "index")
    upsert = changes.guarded_upsert(folder, lambda batch: batch)
    rows = lambda *x: spark.createDataFrame(list(x), "ccn string, n long")
    upsert(rows(("1", 5), ("2", 3)), 0)
    upsert(rows(("2", 4), ("3", 1)), 1)
    upsert(rows(("2", 4), ("3", 1)), 1)  # replayed
    assert changes.current_version(spark, folder) == 1
    upsert(rows(("1", 0)), 2)  # refused: would lose all prices of a facility
    assert changes.current_version(spark, folder) == 1
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/v=1").collect())) == [("1", 5), ("2", 4), ("3", 1)]


def test_batch_states(spark):
    rows = [("u", 1, 1, 200, "a"), ("u", 2, 2, 200, "b"), ("u", 3, 3, 404, None), ("u", 4, 4, 200, "c"), ("v", 1, 5, 304, None)]
    probes = spark.createDataFrame(rows, "mrf_url string, probed_at long, event_id long, http_status int, sha256 string")
    got = {r.mrf_url: r for r in changes.latest_states(probes).collect()}
    assert (got["u"].dead, got["u"].seen, got["u"].at, got["u"].n_content) == (True, "b", 3, 2)
    assert (got["v"].dead, got["v"].seen) == (False, None)
    assert changes.change_counts(probes).where(F.col("mrf_url") == "u").first().changes == 2
