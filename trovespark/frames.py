"""Small helpers that every operator shares: column choice, shared tables and size-checked broadcasts."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the columns named in `wanted`, cast to the given types.

    Columns are found by exact spelling and by position, so extra columns, repeated names and names that differ only in
    case do no harm; of a repeated name the first counts. A missing column becomes nulls of its type.
    """
    names = df.columns
    plain = df.toDF(*[f"_in{i}" for i in range(len(names))])
    kinds = dict(plain.dtypes)
    chosen = []
    for name, kind in wanted.items():
        if name in names:
            column = F.col(at := f"_in{names.index(name)}")
            chosen.append((column if kinds[at] == kind else column.cast(kind)).alias(name))
        else:
            chosen.append(F.lit(None).cast(kind).alias(name))
    return plain.select(*chosen)


def tidy() -> None:
    """Gives memory that a Python worker has freed back to the system. Workers live on after a task, side by side with
    others', and would otherwise each keep the most they ever used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, so that what is worked out from a batch stays small; tidies up at the
    end."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    tidy()


#: Spark's setting by which a finished query's shuffle files go at once, not when the driver's garbage is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a session on one machine
    takes the warehouse; a cluster's is an error, as no folder is known to be shared."""
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def materialise(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """`df` written once as Parquet into the shared folder and read back, in a folder for each value of column `by`.

    Cuts lineage: what a lost executor held is read again from the table, not computed again, so the shuffle files that
    made it go with the query that wrote it. `release` deletes the table.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Deletes tables made by `materialise`, by Hadoop's file system, wherever the shared folder lies."""
    for df in frames:
        if path := getattr(df, "_shared_path", None):
            jvm, session = df.sparkSession._jvm, df.sparkSession._jsparkSession
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(session.sessionState().newHadoopConf()).delete(place, True)
