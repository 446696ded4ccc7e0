"""File sources and sinks: CSV (A1/B3), managed tables (B1/B2), landed JSON
pages (A4).

All writes go to the shared folder (``spark.checkpoint.dir`` or an explicit
path); nothing is staged on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.schemas import OBSERVATION_RECORD, STATION_RECORD
from fieldlens.session import materialize_observed


CORRUPT = "_corrupt_record"


def csv_text_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """All columns of the files' header, as text and in the header's order,
    plus the corrupt-record column.  A column of ``schema`` that the header
    lacks raises ValueError."""
    names = spark.read.option("header", True).option("recursiveFileLookup", True).csv(path).columns
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"{path}: no column {missing} in the header {names}")
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def typed(f: T.StructField) -> Column:
    """A text column as the field's type, NULL where it does not fit; a date may
    carry a time."""
    c = F.col(f.name)
    return (F.substring(c, 1, 10) if isinstance(f.dataType, T.DateType) else c).try_cast(f.dataType)


def csv_columns(raw: DataFrame, schema: T.StructType, corrupt: str | None = None) -> DataFrame:
    """Text columns picked by name and cast.  A date may carry a time
    (``2020-05-01T00:00:00``).  A field that does not fit its type is NULL;
    with ``corrupt`` a column of that name holds the row's text where the line
    is malformed or a field did not fit."""
    cols = [typed(f).alias(f.name) for f in schema]
    if not corrupt:
        return raw.select(*cols)
    misfit = F.lit(False)
    for f in schema:
        misfit = misfit | (F.col(f.name).isNotNull() & typed(f).isNull())
    line = F.coalesce(F.col(CORRUPT), F.when(misfit, F.concat_ws(
        ",", *[F.coalesce(F.col(n), F.lit("")) for n in raw.columns if n != CORRUPT])))
    return raw.select(*cols, line.alias(corrupt))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *,
             corrupt: str | None = None) -> DataFrame:
    """A1: CSV with a header row, columns picked by name and typed by
    ``schema``; other columns and another column order do no harm.

    No ``inferSchema``: inference costs an extra pass over the files and turns
    codes such as FIPS ``003`` into the number 3.  Files of one folder must
    share a header: one that differs fails (``enforceSchema`` off) instead of
    being read by position.  See :func:`csv_columns` for bad fields.
    """
    raw = (
        spark.read.schema(csv_text_schema(spark, path, schema))
        .option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
    return csv_columns(raw, schema, corrupt)


def land_csv(spark: SparkSession, path: str, schema: T.StructType, name: str, out: str, *,
             max_share: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """M1 with a quarantine: (table ``name`` of the good records, the rejects).

    A record is rejected where its line is malformed or a field does not fit its
    type; rejects keep the fields that did fit, and ``_fields`` (names of the
    others, comma-joined), ``_line`` and ``_file`` say what and where.  One pass
    writes both sides to ``out`` (a new path) and counts them on the way.  A
    share of rejects above ``max_share`` raises ValueError, and the name keeps
    pointing to what it did before.
    """
    raw = (
        spark.read.schema(csv_text_schema(spark, path, schema))
        .option("header", True).option("enforceSchema", False).option("recursiveFileLookup", True)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path).withColumn("_file", F.col("_metadata.file_name"))
    )
    text = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in raw.columns if c not in (CORRUPT, "_file")])
    misfit = [F.when(F.col(f.name).isNotNull() & typed(f).isNull(), F.lit(f.name)) for f in schema]
    bad = F.concat_ws(",", *misfit)
    sides = raw.select(
        *[typed(f).alias(f.name) for f in schema], bad.alias("_fields"), F.coalesce(F.col(CORRUPT), text).alias("_line"),
        "_file", (F.col(CORRUPT).isNotNull() | (bad != "")).alias("_rejected"))
    written, seen = materialize_observed(
        sides, [F.count("*").alias("rows"), F.count_if("_rejected").alias("rejected")], "landing", ["_rejected"], path=out)
    if seen["rejected"] > max_share * (seen["rows"] or 0):
        raise ValueError(f"{path}: {seen['rejected']} of {seen['rows']} records rejected")
    good = written.where(~F.col("_rejected")).select(*schema.names)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if seen["rows"] > seen["rejected"]:
        spark.catalog.createTable(name, path=f"{out}/_rejected=false", source="parquet",
                                  schema=T.StructType([*schema.fields, *[T.StructField(c, T.StringType())
                                                                         for c in ("_fields", "_line", "_file")]]))
        good = spark.table(name).select(*schema.names)
    return good, written.where("_rejected").drop("_rejected")


def write_csv(df: DataFrame, path: str, *, header: bool = True,
              partition_by: Sequence[str] = ()) -> str:
    """CSV export with a header and no index column (one file per task)."""
    w = df.write.mode("overwrite").option("header", header).option("dateFormat", "yyyy-MM-dd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def by_partition(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` dealt by ``cols`` for a partitioned write: a small partition is one
    file, a value that holds many rows is split over as many tasks as its size
    asks for (REBALANCE: Spark sizes them from the shuffle it has just written)."""
    return df.hint("rebalance", *[F.col(c) for c in cols])


def save_table(df: DataFrame, name: str, path: str, *,
               partition_by: Sequence[str] = ()) -> DataFrame:
    """B1/B2: overwrite a named parquet table (schema replaced on overwrite).

    ``path`` must be new: the rows are written there first and only then does
    the name point to them, so a failed write leaves the old table as it was.
    Partitioning by a column that later queries filter on (``Year``) gives
    partition pruning for free; the rows are rebalanced by it first
    (:func:`by_partition`).  Returns the table as read back.
    """
    spark = df.sparkSession
    if partition_by:
        by_partition(df, partition_by).write.partitionBy(*partition_by).parquet(path)
    else:
        df.write.parquet(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if partition_by:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def write_pages(records: DataFrame, path: str, *, page_of: str, record_cols: Sequence[str],
                tag_cols: Sequence[str] = (), folders: bool = False) -> str:
    """Land records as JSON pages ``{"results": [...]}``, one page per line.

    ``page_of`` must bound the page size (e.g. ``floor(id / 1000)``), so no
    page collects an unbounded group.  With ``folders`` the tags are not in the
    pages but name their folders (``<tag>=<value>``).
    """
    pages = records.groupBy(page_of, *tag_cols).agg(
        F.collect_list(F.struct(*record_cols)).alias("results")
    )
    w = by_partition(pages, tag_cols).write.partitionBy(*tag_cols) if folders else pages.write
    w.mode("overwrite").json(path)
    return path


def read_pages(spark: SparkSession, path: str, record: T.StructType, *,
               multiline: bool = False, extra: Sequence[T.StructField] = (),
               tag: str | None = None) -> DataFrame:
    """A4: landed JSON pages -> one row per record of ``results``.

    A page without ``results`` (an error or the end of the paging) gives no
    rows.  ``multiline`` reads one pretty-printed document per file; the
    default reads JSON Lines, which Spark splits across tasks.  ``tag`` names a
    column that comes from the page's file: the folder ``<tag>=<value>`` of its
    path (C12), which the page itself need not repeat.
    """
    schema = T.StructType([*extra, T.StructField("results", T.ArrayType(record), True)])
    keep = [f.name for f in extra]
    if tag:  # the files are listed whole: no partition discovery guesses types
        pages = spark.read.schema(schema).option("multiLine", multiline).option("recursiveFileLookup", True).json(path)
        value = F.regexp_extract(F.col("_metadata.file_path"), f"/{tag}=([^/]*)/", 1)
        for _ in ("the path is a URI", "folder names are escaped"):
            value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
        pages, keep = pages.withColumn(tag, value), [*keep, tag]
    else:
        pages = spark.read.schema(schema).option("multiLine", multiline).json(path)
    # inline() of a null or empty array yields no rows
    return pages.select(*keep, F.inline("results"))


__all__ = [
    "read_csv",
    "write_csv",
    "save_table",
    "write_pages",
    "read_pages",
    "OBSERVATION_RECORD",
    "STATION_RECORD",
]
