"""Stateful streams: verdicts from the published index on, across restarts; waves of bounded work; incremental maintenance."""

from __future__ import annotations

from collections import deque
from datetime import datetime, timedelta
from zlib import crc32

from pyspark.sql import functions as F

from pricefold.operators import indexes, standardize
from pricefold.streaming import changes, stateful

T0 = datetime(2025, 1, 1)
EVENTS = "url string, kind string, probed_at timestamp, status int, sha256 string"


def at(i):
    return T0 + timedelta(hours=i)


def drain(spark, df, tmp_path):
    with stateful.state_in_rocksdb(spark):
        df.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination(180)
    return spark.read.parquet(str(tmp_path / "out"))


def put(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / name))


def test_detection_starts_from_the_index_and_survives_a_restart(spark, tmp_path):
    index = spark.createDataFrame([("b", None, True), ("c", "h1", True)], stateful.INDEXED)
    stream = lambda: stateful.detect_changes(changes.bounded_source(spark, EVENTS, f"{tmp_path}/in/*", 1), index)
    put(spark, tmp_path, "1", [("a", "probe", at(1), 200, "h1"), ("b", "probe", at(1), 200, "h1"), ("c", "probe", at(1), 200, "h2"), ("d", "probe", at(1), 410, None)], EVENTS)
    drain(spark, stream(), tmp_path)
    put(spark, tmp_path, "2", [("a", "consumed", at(3), None, "h1"), ("a", "consumed", at(2), None, "old"), ("c", "consumed", at(2), None, "h2"), ("d", "probe", at(4), 200, "h9")], EVENTS)
    drain(spark, stream(), tmp_path)  # another query on the same checkpoint
    put(spark, tmp_path, "3", [("a", "probe", at(5), 200, "h1"), ("a", "probe", at(0), 200, "h0"), ("a", "consumed", at(2), None, "late"), ("a", "probe", at(6), 304, None), ("b", "probe", at(5), 503, None), ("c", "probe", at(5), 200, "h3")], EVENTS)
    got = sorted((r.url, r.probed_at, r.verdict) for r in drain(spark, stream(), tmp_path).collect())
    assert got == sorted([
        ("a", at(1), "new"), ("b", at(1), "baseline"), ("c", at(1), "changed"), ("d", at(1), "dead"), ("a", at(2), "consumed"), ("a", at(3), "consumed"), ("c", at(2), "consumed"), ("d", at(4), "ignored"),
        ("a", at(5), "same"), ("a", at(0), "ignored"), ("a", at(2), "ignored"), ("a", at(6), "unchanged"), ("b", at(5), "error"), ("c", at(5), "changed"),
    ])


def test_dead_urls_are_forgotten_when_the_watermark_has_passed(spark, tmp_path):
    source = changes.bounded_source(spark, EVENTS, f"{tmp_path}/in/*", 1).withWatermark("probed_at", "1 hour")
    stream = lambda: stateful.detect_changes(source, forget_ms=5 * 3_600_000)
    for i, rows in enumerate(([("a", "probe", at(1), 404, None)], [("a", "probe", at(2), 200, "h"), ("z", "probe", at(2), 200, "h")], [("z", "probe", at(20), 200, "h")], [("z", "probe", at(21), 200, "h")], [("a", "probe", at(22), 200, "h")])):
        put(spark, tmp_path, str(i), rows, EVENTS)
        out = drain(spark, stream(), tmp_path)
    assert [r.verdict for r in out.where("url = 'a'").orderBy("probed_at").collect()] == ["dead", "ignored", "new"]


def test_waves_against_a_plain_queue(spark, tmp_path):
    batches = [[(f"u{i % 17}", i) for i in range(k * 40, k * 40 + n)] for k, n in enumerate((40, 3, 25, 9))]
    want, lanes, waves = [], {}, {}
    for rows in batches:
        fresh = {}
        for url, i in rows:
            fresh.setdefault(crc32(url.encode()) % 3, []).append((url, i))
        for lane, new in fresh.items():
            queue = lanes.setdefault(lane, deque())
            waves[lane] = waves.get(lane, 0) + 1
            late = len(queue)
            queue.extend(sorted(new, key=lambda r: r[1]))
            want += [(lane, waves[lane], k < late, *queue.popleft()) for k in range(min(4, len(queue)))]
    for k, rows in enumerate(batches):
        put(spark, tmp_path, str(k), rows, "url string, event_id long")
        out = drain(spark, stateful.bounded_waves(changes.bounded_source(spark, "url string, event_id long", f"{tmp_path}/in/*", 1), 4, 3, ["event_id"]), tmp_path)
    assert sorted(map(tuple, out.collect())) == sorted(want) and any(r[2] for r in want)


def test_incremental_maintenance_equals_a_rebuild(spark, tmp_path):
    payer = "array<struct<payer:string,rate_dollar:double>>"
    schema = f"ccn string, seq long, code string, code_type string, description string, setting string, billing_class string, gross double, cash double, min_rate double, max_rate double, history boolean, effective_date date, payers {payer}"
    rows = lambda ccn, n: [(ccn, i, f"{i % 5:05d}", "CPT", f"Item {i}", "o", "f", 10.0 + i, None, 1.0, 2.0, False, None, [("Aetna", 5.0)]) for i in range(n)]
    items = spark.createDataFrame([r for k in range(30) for r in rows(f"{k:06d}", k % 7 + 1)], schema)
    facilities = items.select("ccn", F.concat(F.lit("H"), "ccn").alias("name")).distinct()
    store, index = str(tmp_path / "items"), str(tmp_path / "index")
    changes.stored_by_bucket(items, store)
    upsert = changes.guarded_upsert(index, lambda batch: changes.recomputed(store, facilities, batch))
    ccns = [f"{k:06d}" for k in range(30)]
    for k in range(3):
        upsert(spark.createDataFrame([(c,) for c in ccns[k * 10 : k * 10 + 12]], "ccn string"), k)
    upsert(spark.createDataFrame([(c,) for c in ccns[20:32]], "ccn string"), 2)  # replayed
    slim = standardize.slim(items)
    full = indexes.facility_index(slim, standardize.compliance(slim), facilities)
    got = spark.read.parquet(f"{index}/v={changes.current_version(spark, index)}").select(*full.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))
    plan = changes.recomputed(store, facilities, spark.createDataFrame([("000001",)], "ccn string"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket#", "bucket#")
