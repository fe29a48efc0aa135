"""CSV feeds: partitioned writer, typed batch reader, ingest metadata and
rescued fields (A1, A3, A4, A5, A8, A9).

Layout: ``<root>/<feed>/<partition column>=<yyyy-mm-dd>/part-*.csv`` with a
header row, one directory per load.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructField, StructType

from slotwise.functions.exprs import quote
from slotwise.schemas import Feed

# Fixed value that must equal the reference's: the path pattern a snapshot date
# is taken from (second group).
SNAPSHOT_PATH_PATTERN = r"(snapshot_date|load_date)=([^/]+)"
CORRUPT = "_corrupt_record"


def feed_path(root: str, feed: Feed) -> str:
    return f"{root.rstrip('/')}/{feed.name}"


#: Rows of a compressed file: it is read by one task, as it cannot be split.
PACKED_ROWS = 1_000_000


def write_feed(df: DataFrame, root: str, feed: Feed, load: str | Column, compression: str | None = None) -> str:
    """Write one load of ``feed`` under its partition directory.

    ``load`` is a date string (one directory) or a Column (one directory per
    value). Only the partitions written are replaced (dynamic overwrite), and
    every task writes its own files: no single-file funnel at scale. With
    ``compression`` (for example ``gzip``) files are packed and of at most
    ``PACKED_ROWS`` rows.
    """
    part = F.lit(load).cast(DateType()) if isinstance(load, str) else load.cast(DateType())
    path = feed_path(root, feed)
    packed = {"compression": compression, "maxRecordsPerFile": PACKED_ROWS} if compression else {}
    (
        df.withColumn(feed.partition_column, part)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(header=True, **packed)
        .partitionBy(feed.partition_column)
        .csv(path)
    )
    return path


def only_loads(df: DataFrame, feed: Feed, loads: list[str] | tuple[str, ...] | None) -> DataFrame:
    """Keep the given load dates; a filter on the partition column prunes whole
    directories at planning time (``PartitionFilters`` in the scan). None keeps
    all loads, an empty list none."""
    if loads is None:
        return df
    return df.where(F.col(feed.partition_column).isin([dt.date.fromisoformat(d) for d in loads]))


def read_feed(spark: SparkSession, root: str, feed: Feed, schema: StructType, loads=None) -> DataFrame:
    """A1: batch scan with an explicit schema; the partition column is discovered from paths.

    ``loads`` restricts an incremental run to some load dates (partition pruning).
    """
    path = feed_path(root, feed)
    raw = raw_schema(header_columns(spark, path, feed, schema))
    df = spark.read.schema(raw).options(**CSV_OPTIONS).csv(path)
    found = set(df.columns)
    typed = [
        F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in found else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return only_loads(df.select(*typed, feed.partition_column), feed, loads)


#: Headers are checked against the schema the scan was given, in every file.
CSV_OPTIONS = {"header": True, "enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def header_columns(spark: SparkSession, path: str, feed: Feed, schema: StructType) -> list[str]:
    """The columns of a feed's files in the order of their header.

    A feed's files share one header; a file with another one fails the scan
    instead of having its values put under wrong names. Before the first load
    the schema's own order is assumed.
    """
    try:
        found = spark.read.option("header", True).csv(path).columns
    except AnalysisException:
        found = []
    found = [c for c in found if c != feed.partition_column]
    return found or [f.name for f in schema.fields]


def raw_schema(columns: list[str]) -> StructType:
    """Every column as text, plus the malformed-row column."""
    return StructType([StructField(c, StringType(), True) for c in [*columns, CORRUPT]])


def rescue(raw: DataFrame, schema: StructType, partition_column: str | None = None) -> DataFrame:
    """A5: typed columns from text, by name; values that do not parse become
    NULL and are kept, as text, in ``_rescued_data`` (a JSON object, NULL when
    the row is clean), and so are columns outside the schema. A column the
    files lack is NULL. A malformed row keeps its raw line under
    ``_corrupt_record``. The JSON is built for rows that need one only.
    """
    typed, bad, unclean = [], [], []
    found = set(raw.columns)
    for f in schema.fields:
        n, t = f"`{f.name}`", f.dataType.simpleString()
        if f.name not in found:
            typed.append(f"CAST(NULL AS {t}) AS {n}")
            continue
        if isinstance(f.dataType, StringType):
            typed.append(n)
            continue
        typed.append(f"try_cast({n} AS {t}) AS {n}")
        failed = f"{n} IS NOT NULL AND try_cast({n} AS {t}) IS NULL"
        bad.append(f"{quote(f.name)}, CASE WHEN {failed} THEN {n} END")
        unclean.append(f"({failed})")
    names = {f.name for f in schema.fields} | {CORRUPT, partition_column}
    extra = [c for c in raw.columns if c not in names]
    keep = [f"`{partition_column}`"] if partition_column in found else []
    whole = [*extra, *([CORRUPT] if CORRUPT in found else [])]
    bad += [f"{quote(c)}, `{c}`" for c in whole]
    unclean += [f"`{c}` IS NOT NULL" for c in whole]
    rescued = f"CASE WHEN {' OR '.join(unclean)} THEN to_json(named_struct({', '.join(bad)})) END" if bad else "CAST(NULL AS STRING)"
    return raw.selectExpr(*typed, *keep, f"{rescued} AS _rescued_data")


def read_feed_rescued(spark: SparkSession, root: str, feed: Feed, schema: StructType, loads=None) -> DataFrame:
    """A1 + A5: PERMISSIVE text scan, then per-field safe casts."""
    path = feed_path(root, feed)
    raw = spark.read.schema(raw_schema(header_columns(spark, path, feed, schema))).options(**CSV_OPTIONS).csv(path)
    return rescue(only_loads(raw, feed, loads), schema, feed.partition_column)


def with_ingest_metadata(df: DataFrame, batch_id: str) -> DataFrame:
    """A3 + A4: ingest time, source file, batch id and the snapshot date of the file's directory."""
    cols = [
        "*",
        "current_timestamp() AS _ingest_ts",
        "_metadata.file_path AS _source_file",
        F.lit(batch_id).alias("_batch_id"),
        F.regexp_extract(F.col("_metadata.file_path"), SNAPSHOT_PATH_PATTERN, 2).alias("_source_snapshot_date"),
    ]
    if "_rescued_data" not in df.columns:
        cols.append("CAST(NULL AS STRING) AS _rescued_data")
    return df.select(*[F.expr(c) if isinstance(c, str) else c for c in cols])


def schema_of(df: DataFrame, overrides: dict[str, DataType] | None = None) -> StructType:
    """The schema a typed reader should use for data written from ``df``."""
    fields = [StructField(f.name, (overrides or {}).get(f.name, f.dataType), True) for f in df.schema.fields]
    return StructType(fields)
