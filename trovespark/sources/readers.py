"""Sources: query and corpus files, runs in their several layouts, caches, metric folders.

Everything is read by Spark's readers, so any file system that Spark knows will do.
"""

from __future__ import annotations

from enum import Enum
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from trovespark.functions.ids import blank_to_null, doc_id, query_id, strip
from trovespark.functions.text import index_text
from trovespark.operators.ranking import first_of, ranked

QUERY = "query_id string, query_text string, query_type string, documents array<string>"
CORPUS = "docno string, title string, text string, keywords array<string>, mesh_terms string"
WINDOW = "qid string, docno string, window_idx int, sent_start int, window_text string, ce_score double, query_field string"
CLAIMS = "key string, qid string, context_id string, doc_id string, rank int, ce_score double, n_claims int, claims array<string>"
RUN = "qid string, docno string, rank int, score double"
# Other names of the columns of a run.
ALIASES = {"qid": ("qid", "query_id"), "docno": ("docno", "docid", "doc"), "rank": ("rank",), "score": ("score",)}


class RunSource(Enum):
    """Where first-stage runs come from."""

    BUILT = "built"
    LEXICAL = "bm25"
    DENSE = "dense"
    EXTERNAL = "external"


def need_jsonl(path: str, label: str = "file") -> str:
    if not path.rstrip("/").endswith(".jsonl"):
        raise ValueError(f"{label} must be .jsonl: {path}")
    return path


def _checked(value: Column, wrong: Column, message: str, place: Column | None = None) -> Column:
    said = F.lit(message) if place is None else F.concat(F.lit(message + " in "), place)
    return F.when(wrong, F.raise_error(said).cast("string")).otherwise(value)


def queries(spark: SparkSession, path: str, fields: tuple[str, ...] = ()) -> DataFrame:
    """Query lines as canonical records; `fields` are further text fields to keep. Lines that aren't objects, or lack an
    id or a text, are an error; blank lines are skipped."""
    schema = QUERY + "".join(f", {f} string" for f in fields) + ", questions string, _bad string"
    rows = spark.read.schema(schema).json(need_jsonl(path, "queries"), columnNameOfCorruptRecord="_bad")
    wrong = F.col("_bad").isNotNull() | F.col("questions").isNotNull()
    return canonical(rows.withColumn("query_id", _checked(F.col("query_id"), wrong, "a line that is no query", F.input_file_name())), fields)


def canonical(rows: DataFrame, fields: tuple[str, ...] = ()) -> DataFrame:
    """Trimmed ids and texts, which must not be blank; a blank type is none; documents as ids, blank ones dropped, and
    none if none is left."""
    id_, text = strip(F.coalesce("query_id", F.lit(""))), strip(F.coalesce("query_text", F.lit("")))
    ids = F.filter(F.transform("documents", doc_id), lambda x: x != "")
    return rows.select(
        _checked(id_, id_ == "", "a query without id").alias("query_id"), _checked(text, text == "", "a query without text").alias("query_text"), blank_to_null(F.col("query_type")).alias("query_type"),
        F.when(F.size(ids) > 0, ids).alias("documents"), *(f for f in fields),
    )


def topics(rows: DataFrame, field: str = "query_text", skip_empty: bool = False) -> DataFrame:
    """qid and query from a field of query records; blank ones are skipped, or else an error."""
    text = strip(F.coalesce(field, F.lit("")))
    if skip_empty:
        return rows.select(F.col("query_id").alias("qid"), text.alias("query")).where("query <> ''")
    return rows.select(F.col("query_id").alias("qid"), _checked(text, text == "", f"a query without {field}").alias("query"))


def gold(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(qid, docno) of the records' documents, and all qids: queries without gold count too."""
    found = rows.select(F.col("query_id").alias("qid"), F.explode("documents").alias("docno")).distinct()
    return found, rows.select(F.col("query_id").alias("qid")).distinct()


def indexed_queries(rows: DataFrame, index: str = "idx") -> DataFrame:
    return rows.withColumn("query_id", query_id(F.col("query_id"), F.col(index)))


def records(spark: SparkSession, path: str, schema: str, label: str = "records") -> DataFrame:
    """Unchecked lines of later stages."""
    return spark.read.schema(schema).json(need_jsonl(path, label))


def corpus(spark: SparkSession, glob: str, strict: bool = True) -> DataFrame:
    """Corpus lines with an id. Lines that don't parse are an error, or with `strict` off skipped."""
    rows = spark.read.schema(CORPUS).json(glob, mode="FAILFAST" if strict else "DROPMALFORMED")
    return rows.withColumn("docno", blank_to_null(F.col("docno"))).where("docno is not null")


def index_documents(rows: DataFrame, keywords: bool = False) -> DataFrame:
    """docno, text of the documents with text: title and text, keywords as a field if wanted."""
    out = rows.select("docno", index_text(F.col("title"), F.col("text")).alias("text"), *([F.array_join("keywords", " ").alias("keywords")] if keywords else []))
    return out.where("text <> ''")


def texts_for(run: DataFrame, rows: DataFrame) -> DataFrame:
    """One text for each document of a run; '' where the corpus has none."""
    wanted = run.select("docno").distinct()
    one = first_of(rows.join(wanted, "docno", "left_semi"), ["docno"], F.asc("title"), F.asc("text"))
    return wanted.join(one.select("docno", "title", "text"), "docno", "left").withColumn("text", F.coalesce("text", F.lit("")))


def run(rows: DataFrame, normalise: bool = True, position: str | None = None, rank_from_score: bool = True) -> DataFrame:
    """Any run as qid, docno, rank, score. Columns may have other names; a missing rank comes from the score, or from
    the place in the file (`position`); ranks that are no numbers count as 0."""
    names = {c.lower(): c for c in rows.columns}
    found = {k: next((names[a] for a in v if a in names), None) for k, v in ALIASES.items()}
    if not found["qid"] or not found["docno"]:
        raise ValueError(f"a run needs query and document columns, not {rows.columns}")
    docno = doc_id(F.col(found["docno"])) if normalise else F.col(found["docno"]).cast("string")
    score = F.col(found["score"]).try_cast("double") if found["score"] else F.lit(None).cast("double")
    rank = F.coalesce(F.col(found["rank"]).try_cast("int"), F.lit(0)) if found["rank"] else F.lit(None).cast("int")
    out = rows.select(F.col(found["qid"]).cast("string").alias("qid"), docno.alias("docno"), rank.alias("rank"), F.nanvl(score, F.lit(None).cast("double")).alias("score"), *([position] if position else []))
    if found["rank"]:
        return out.select("qid", "docno", "rank", "score")
    if found["score"] and rank_from_score:
        return ranked(out, F.desc_nulls_last("score"), F.asc("docno")).select("qid", "docno", "rank", "score")
    if not position:
        raise ValueError("a run without rank and score needs a position column")
    return ranked(out, F.asc(position)).select("qid", "docno", "rank", "score")


def in_file_order(spark: SparkSession, path: str, **options) -> DataFrame:
    """Rows of delimited files with `_at`, a number that grows with their place: files by name, then by place in the file."""
    rows = spark.read.csv(path, **options).select("*", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("id")).alias("_at"))
    return rows


def run_file(spark: SparkSession, path: str, normalise: bool = True) -> DataFrame:
    """A run from TSV with a header, or from Parquet; without ranks and scores its order is that of the files' rows."""
    if path.endswith(".parquet"):
        return run(spark.read.parquet(path), normalise)
    return run(in_file_order(spark, path, sep="\t", header=True), normalise, "_at", rank_from_score=True)


def positional_run(spark: SparkSession, path: str) -> DataFrame:
    """qid, docno and rank from the first three columns of a TSV with a header, whatever their names; rows whose rank is no
    number are skipped."""
    rows = spark.read.csv(path, sep="\t", header=True)
    plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    return plain.select(F.col("c0").alias("qid"), F.col("c1").alias("docno"), F.col("c2").try_cast("int").alias("rank")).where("rank is not null")


def matching(spark: SparkSession, glob: str) -> list[str]:
    """The paths that a pattern names, in order, on any file system that Spark knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(glob)
    found = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(place)
    return sorted(f.getPath().toString() for f in found or [])


def recall_sources(spark: SparkSession, folder: str) -> tuple[str, list[str]]:
    """Where a stage's recall comes from: its per-query tables if it has any, else its runs."""
    tables = matching(spark, f"{folder}/per_query/*.csv")
    return ("per_query", tables) if tables else ("runs", matching(spark, f"{folder}/runs/*.tsv"))


def metrics_of_folder(spark: SparkSession, folder: str, gold: DataFrame, label: str, ks: tuple[int, ...] = (50,)) -> DataFrame:
    """A row a run with its label: from the folder's metrics.csv, else worked out from its runs."""
    if matching(spark, f"{folder}/metrics.csv"):
        found = spark.read.csv(f"{folder}/metrics.csv", header=True, inferSchema=True)
        return found if "label" in found.columns else found.withColumn("label", F.lit(label))
    from trovespark.operators.evaluate import per_query, summary

    names = matching(spark, f"{folder}/runs/*.tsv")
    if not names:
        raise ValueError(f"{folder} has neither metrics nor runs")
    per = [summary(per_query(run_file(spark, name), gold, ks=ks)).withColumn("run", F.lit(name.rstrip("/").rpartition("/")[2].removesuffix(".tsv"))) for name in names]
    return reduce(DataFrame.unionByName, per).withColumn("label", F.lit(label))


def windows(spark: SparkSession, path: str) -> DataFrame:
    """Scored windows; where the start isn't written it is the window's number."""
    rows = records(spark, path, WINDOW, "windows")
    return rows.withColumn("sent_start", F.coalesce("sent_start", "window_idx")).withColumn("ce_score", F.nanvl("ce_score", F.lit(None).cast("double")))


def claim_cache(spark: SparkSession, path: str) -> DataFrame:
    """Cached claims; of repeated keys one row. Numbers that JSON hasn't (NaN) are read as none."""
    rows = spark.read.schema(CLAIMS).json(need_jsonl(path, "claim cache"), allowNonNumericNumbers=True)
    rows = rows.withColumn("ce_score", F.nanvl("ce_score", F.lit(None).cast("double")))
    return first_of(rows, ["qid", "context_id"], F.desc("key"))


def row_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("rowid bigint, docno string").csv(path, sep="\t")


def metric_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Metric tables of several folders under their labels; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn("label", F.lit(k)) for k, t in tables.items()])


def prose_of(html: Column) -> Column:
    """A page's text with its lines: scripts, styles and tags removed."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?i)</?(p|div|li|h[1-6]|br|ul|nav|footer|article)[^>]*>", "\n"), r"<[^>]*>", "")
