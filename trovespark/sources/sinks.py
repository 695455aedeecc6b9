"""Sinks: runs, records, metrics and logs; writes that do nothing where a stage is done already."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from trovespark.operators.dense import check_rowids
from trovespark.operators.evidence import slim_windows
from trovespark.operators.ranking import clean_dense


def jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of JSON lines; it must be named .jsonl. Text stays as it is, null fields are left out."""
    if not path.rstrip("/").endswith(".jsonl"):
        raise ValueError(f"{path} must be .jsonl")
    df.write.mode(mode).json(path)


def run_tsv(run: DataFrame, path: str, by: tuple[str, ...] = (), mode: str = "errorifexists") -> None:
    """qid, docno, rank, score as TSV with a header, in folders by `by` (method, split)."""
    writer = run.select(*by, "qid", "docno", "rank", *(["score"] if "score" in run.columns else [])).write.mode(mode)
    (writer.partitionBy(*by) if by else writer).csv(path, sep="\t", header=True)


def dense_run(run: DataFrame, path: str, mode: str = "errorifexists") -> None:
    run_tsv(clean_dense(run), path, mode=mode)


def fused_run(run: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A fused run: its scores are of no scale and are written as missing."""
    run_tsv(run.withColumn("score", F.lit(None).cast("double")), path, mode=mode)


def metrics_csv(metrics: DataFrame, path: str, mode: str = "errorifexists") -> None:
    metrics.write.mode(mode).csv(path, header=True)


def zero_recall_txt(queries: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The queries (qid) without a hit, one a line."""
    queries.select(F.col("qid").cast("string").alias("value")).write.mode(mode).text(path)


def slim_answers(records: DataFrame) -> DataFrame:
    """Answer records without embedded windows, rejected windows and window numbers."""
    out = records.drop("doc_snippet_windows")
    return out.withColumn("contexts", slim_windows(F.col("contexts"))) if "contexts" in out.columns else out


def row_map(rows: DataFrame, path: str) -> None:
    check_rowids(rows).write.csv(path, sep="\t")


def index_meta(spark: SparkSession, path: str, **fields) -> None:
    spark.createDataFrame([fields]).write.json(path)


def done(spark: SparkSession, path: str) -> bool:
    """Whether a stage has finished writing to a path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def once(spark: SparkSession, path: str, make, log: list | None = None, seconds: list | None = None) -> DataFrame:
    """The table at a path, made and written if it isn't there; `log` gets a row for either, `seconds` how long it took."""
    begun, ready = time.monotonic(), done(spark, path)
    if not ready:
        make().write.mode("overwrite").parquet(path)
    if log is not None:
        log.append((path, "kept" if ready else "made"))
    if seconds is not None:
        seconds.append(round(time.monotonic() - begun, 3))
    return spark.read.parquet(path)


def log_lines(spark: SparkSession, log: list, seconds: list, path: str) -> None:
    """A log's rows (path, what was done, seconds) behind those that the file has already."""
    rows = [(*entry, took) for entry, took in zip(log, seconds)]
    spark.createDataFrame(rows, "path string, done string, seconds double").write.mode("append").csv(path, sep="\t", header=True)
