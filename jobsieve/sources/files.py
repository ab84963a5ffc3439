"""CSV inputs (S1-S6), answers (S8), outputs (S9-S11) and tables written between stages. Snapshots (S7) have a module of their own."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsieve.functions.text import normalize_text
from jobsieve.functions.urls import normalize_domain, normalize_url, url_host, with_scheme
from jobsieve.operators.dedupe import first_n, first_per_group, ordered_distinct
from jobsieve.operators.lists import list_keys, union_all

LIST_SCHEMA = "list_name string, company_website string, company_name string, external_url string"
ANSWER_SCHEMA = "stage string, url string, render_pass int, response_text string, answered_ord bigint"


def read_csv(spark: SparkSession, path: str) -> DataFrame | None:
    """CSV files as strings, with the place of a row among all rows of all files in ``ord``; None where there is no file.

    ``path`` is a file or a folder; files follow each other by name, whatever their number and however they are dealt over tasks."""
    try:
        raw = spark.read.csv(path, header=True, multiLine=True, escape='"', inferSchema=False)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return numbered(raw)


def numbered(raw: DataFrame) -> DataFrame:
    """Add ``ord``: rows of the files before, plus the place in the own file. For sources that are read from files.

    A task numbers the rows it reads one after another. The rows of each piece of a file are counted first, so that a
    piece knows how many come before it; what is joined is one row per piece, which Spark broadcasts while that is small."""
    columns = [F.col(f"`{c}`") for c in raw.columns]
    piece = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start")]
    rows = raw.select(*columns, *piece).withColumn("__id", F.monotonically_increasing_id())
    counts = rows.groupBy("__file", "__start").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("__file", "__start", "__first", F.coalesce(before, F.lit(0)).alias("__before"))
    return rows.join(counts, ["__file", "__start"]).select(*columns, (F.col("__before") + F.col("__id") - F.col("__first")).alias("ord"))


def _column(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def _require(df: DataFrame, name: str, path: str) -> None:
    if name not in df.columns:
        raise ValueError(f"{path} must have a header named {name}")


def read_company_list(spark: SparkSession, path: str, list_name: str) -> DataFrame:
    """S1, and S2 for the list of current jobs, which also has URLs. No file counts as an empty list."""
    raw = read_csv(spark, path)
    if raw is None:
        return spark.createDataFrame([], LIST_SCHEMA)
    url = _column(raw, "external_url") if list_name == "active" else F.lit(None).cast("string")
    return raw.select(
        F.lit(list_name).alias("list_name"),
        _column(raw, "company_website").alias("company_website"),
        _column(raw, "company_name").alias("company_name"),
        url.alias("external_url"),
    )


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    raw = read_csv(spark, path)
    if raw is None:
        return spark.createDataFrame([], "keyword string")
    _require(raw, "irrelevant_names", path)
    return raw.select(normalize_text(F.col("irrelevant_names")).alias("keyword")).filter(F.col("keyword") != "")


def read_list_keys(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``paths`` maps blacklist, customers, churned and active to their files."""
    return list_keys(union_all([read_company_list(spark, path, name) for name, path in paths.items()]))


def company_domains(raw: DataFrame, max_inputs: int | None = None) -> DataFrame:
    """S5 on a table with ``company_domain`` and ``ord``."""
    domains = raw.select(normalize_domain(F.col("company_domain")).alias("company_domain"), "ord")
    domains = ordered_distinct(domains.filter(F.col("company_domain") != ""), "company_domain", "ord")
    return first_n(domains, ["ord"], max_inputs)


def career_pages(raw: DataFrame, max_inputs: int | None = None) -> DataFrame:
    """S6 on a table with ``career_page`` and ``ord``."""
    pages = (
        raw.select(normalize_url(F.col("career_page")).alias("career_page"), "ord")
        .filter(F.col("career_page") != "")
        .withColumn("career_page", with_scheme(F.col("career_page")))
        .withColumn("company_domain", url_host(F.col("career_page")))
        .filter(F.col("company_domain") != "")
    )
    pages = first_per_group(pages, [normalize_url(F.col("career_page"))], ["ord"])
    return first_n(pages, ["ord"], max_inputs)


def read_company_domains(spark: SparkSession, path: str, max_inputs: int | None = None) -> DataFrame:
    raw = read_csv(spark, path)
    if raw is None:
        return spark.createDataFrame([], "company_domain string, ord bigint")
    _require(raw, "company_domain", path)
    return company_domains(raw, max_inputs)


def read_career_pages(spark: SparkSession, path: str, max_inputs: int | None = None) -> DataFrame:
    raw = read_csv(spark, path)
    if raw is None:
        return spark.createDataFrame([], "career_page string, ord bigint, company_domain string")
    _require(raw, "career_page", path)
    return career_pages(raw, max_inputs)


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Model answers by stage ('career' or 'job'), URL and render pass (null: asked for both). Of repeated answers the one with the greatest
    ``answered_ord`` counts."""
    return spark.read.schema(ANSWER_SCHEMA).parquet(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """S9, S10."""
    df.select(*columns).write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", nullValue="")


def write_trace(df: DataFrame, path: str) -> None:
    """JSON lines."""
    df.write.mode("overwrite").json(path)


def stage_dir(spark: SparkSession) -> str:
    """A new folder under the checkpoint folder that the session names; the warehouse, which is shared too, where it names none."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/jobsieve-{uuid.uuid4().hex}"


def materialize(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a stage as a table in the shared folder and read it back.

    This cuts the lineage, survives lost executors, lets later stages read only the columns they need and
    gives the join planner true sizes.
    """
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """The same rows dealt evenly over as many tasks as a shuffle has. For narrow rows that costly work follows on: their files are so small that
    a few tasks, or one, would read them and do all of it."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def bucketed(df: DataFrame, folder: str, name: str, key: str) -> DataFrame:
    """The same, bucketed and sorted by ``key``: joins on it alone need no exchange on this side.

    The catalog knows the table only while it is written; what is returned reads its files."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"jobsieve_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.format("parquet").option("compression", "zstd").option("path", f"{folder}/{name}")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"drop table {table}")
    return rows
