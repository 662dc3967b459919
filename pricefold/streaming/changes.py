"""Change detection on streams of fetch results, with state for each URL, and the batch form that must agree with it.

Events have url, ccn, probed_at, status, sha256. Two hashes are kept apart: ``seen`` moves on with every observation,
``consumed`` only when a file was parsed, so a change whose processing fails is detected again. Order is (probed_at,
sha256); probes older than the last one and consumptions older than the last one are late and ignored; 404 and 410 are final.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pricefold.functions.expressions import choose
from pricefold.operators import indexes, merges, quality, standardize

STATE = "seen string, consumed string, dead boolean, at long, consumed_at long"
VERDICTS = "url string, probed_at timestamp, verdict string, sha256 string"


def _step(state: tuple, kind: str, at: int, status: int, sha256: str | None, indexed: bool) -> tuple[tuple, str]:
    seen, consumed, dead, last, used = state
    if kind == "consumed":
        return ((seen, sha256, dead, last, at), "consumed") if at >= used else (state, "ignored")
    if dead or at < last:
        return state, "ignored"
    if status in (404, 410):
        return (seen, consumed, True, at, used), "dead"
    if status == 304:
        return (seen, consumed, dead, at, used), "unchanged"
    if status != 200 or sha256 is None:
        return state, "error"
    verdict = "changed" if consumed and consumed != sha256 else "same" if consumed else "baseline" if indexed else "new"
    return (sha256, consumed, dead, at, used), verdict


def detect_changes(events: DataFrame) -> DataFrame:
    """Verdict of each event of a stream: columns url, kind (probe or consumed), probed_at, status, sha256, indexed."""

    def work(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else (None, None, False, -1, -1)
        rows = pd.concat(list(batches)).sort_values(["probed_at", "kind", "sha256"], na_position="first")
        out = []
        for r in rows.itertuples():
            sha = r.sha256 if isinstance(r.sha256, str) else None
            now, verdict = _step(now, r.kind, r.probed_at.value, -1 if r.status is None or r.status != r.status else int(r.status), sha, bool(r.indexed))
            out.append((key[0], r.probed_at, verdict, sha))
        state.update(now)
        yield pd.DataFrame(out, columns=["url", "probed_at", "verdict", "sha256"])

    return events.groupBy("url").applyInPandasWithState(work, VERDICTS, STATE, "append", GroupStateTimeout.NoTimeout)


def latest_states(probes: DataFrame) -> DataFrame:
    """The batch form for a log without consumption: (url, dead, seen, at, n_content) from aggregates alone."""
    gone = probes.groupBy("mrf_url").agg(F.min(F.when(F.col("http_status").isin(404, 410), F.struct("probed_at", "event_id"))).alias("gone"))
    df = probes.join(gone, "mrf_url").where(F.col("gone").isNull() | (F.struct("probed_at", "event_id") <= F.col("gone")))
    content = F.col("http_status") == 200
    order = F.struct("probed_at", "event_id")
    return df.groupBy("mrf_url").agg(F.bool_or(F.col("http_status").isin(404, 410)).alias("dead"), F.max_by(F.when(content, F.col("sha256")), F.when(content, order)).alias("seen"), F.max(F.when(F.col("http_status").isin(200, 304, 404, 410), F.col("probed_at"))).alias("at"), F.count_if(content).alias("n_content"))


def change_counts(probes: DataFrame) -> DataFrame:
    """For each URL: how often the content differs from the content before, by a window over its events."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("mrf_url").orderBy("probed_at", "event_id")
    df = probes.where("http_status = 200").withColumn("before", F.lag("sha256").over(w))
    return df.groupBy("mrf_url").agg(F.count("*").alias("n"), F.count_if(F.col("before").isNotNull() & (F.col("before") != F.col("sha256"))).alias("changes"))


def running_latest(events: DataFrame) -> DataFrame:
    """Latest probe of each URL as a running table (for update or complete mode)."""
    return events.groupBy("url").agg(F.max_by(F.struct("probed_at", "status", "sha256"), F.struct("probed_at", "sha256")).alias("p")).select("url", "p.*")


def bounded_source(spark, schema: str, folder: str, files: int) -> DataFrame:
    """A file stream that takes a bounded number of files a batch; the rest waits its turn."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def guarded_upsert(folder: str, rows_of: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: index rows of the batch go into the index in ``folder``, unless the regression gate refuses.

    Each version is a folder of its own, named by the batch; a replayed batch writes the same version again, and a
    refused one leaves the version before in place."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = rows_of(batch).persist()
        version = current_version(spark, folder, batch_id)
        if version is None:
            after = new
            refused = 0
        else:
            before = spark.read.parquet(f"{folder}/v={version}")
            after = merges.upserted(before, new).drop("diff")
            refused = quality.regression_gate(before, after, new).where("NOT ok").count()
        if not refused:
            after.write.mode("overwrite").parquet(f"{folder}/v={batch_id}")
        new.unpersist()

    return upsert


def stored_by_bucket(items: DataFrame, folder: str, buckets: int = 64) -> None:
    """Items in folders by the hash of their facility: a changed facility is found without reading the others' buckets."""
    items.withColumn("bucket", F.pmod(F.xxhash64("ccn"), F.lit(buckets)).cast("int")).repartition("bucket").write.partitionBy("bucket").parquet(folder)


def recomputed(items_folder: str, facilities: DataFrame, changed: DataFrame, buckets: int = 64) -> DataFrame:
    """Index rows of the changed facilities alone, from their items: de-duplication, conflicts, counts and score.

    Only the buckets of changed facilities are read (64 at most are named in the plan); within those, only their rows stay."""
    spark = changed.sparkSession
    keys = changed.select("ccn").distinct()
    touched = [r[0] for r in keys.select(F.pmod(F.xxhash64("ccn"), F.lit(buckets)).cast("int")).distinct().collect()]
    items = spark.read.parquet(items_folder).where(F.col("bucket").isin(touched)).join(keys, "ccn", "left_semi").drop("bucket")
    slim = standardize.slim(items)
    return indexes.facility_index(slim, standardize.compliance(slim), facilities.join(keys, "ccn", "left_semi"))


def latest_by_batch(folder: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function for update mode: the rows that a batch changed, in a folder of its own; a replay writes it again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return write


def read_latest(spark, folder: str, key: str) -> DataFrame:
    """The last version of each row that :func:`latest_by_batch` wrote."""
    df = spark.read.parquet(folder)
    rest = [c for c in df.columns if c not in (key, "batch")]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(key, "r.*")


def current_version(spark, folder: str, before: int | None = None) -> int | None:
    """The newest complete version below ``folder`` (older than ``before`` if given)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return None
    names = [f.getPath() for f in store.listStatus(path)]
    done = [int(p.getName()[2:]) for p in names if p.getName().startswith("v=") and store.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max((v for v in done if before is None or v < before), default=None)


def classify(probes: DataFrame) -> DataFrame:
    """Probes with the class of their answer."""
    s = F.col("http_status")
    return probes.withColumn("answer", choose([(s == 304, "unchanged"), (s.isin(404, 410), "dead"), (s == 200, "content"), (s > 0, "answered error"), (s == -1, "transport")], "other"))
