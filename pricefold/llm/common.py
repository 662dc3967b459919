"""Small helpers shared by the training-data operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The white space that separates words, as the inside of a character class: blank, and tab to carriage return.
BLANK = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table by name; the folder may be any path that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, UPPER, UPPER.lower())


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drops columns that an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or a temporary one in a single-JVM session without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = getattr(spark, "_pricefold_folder", None) or tempfile.mkdtemp(prefix="pricefold-")
        spark._pricefold_folder = base
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/pricefold/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a Parquet table in the shared folder and reads it back.

    Cuts the lineage: a lost executor costs a new read of the table, not a new run of what made it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Python tasks that are planned within get at most ``rows`` rows at once, as theirs may be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bucket_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id has bucket 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(0)).cast("int")
