"""Gold tables: existence test (S7), history scan (S2), partitioned sink (S3), catalog (S6)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FULL_LOAD = "FULL_LOAD"
INCREMENTAL = "INCREMENTAL"
LOAD_TYPES = (FULL_LOAD, INCREMENTAL)

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")

def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"invalid identifier {name!r}")
    return f"`{name}`"


def table_name(database: str | None, table: str) -> str:
    return f"{_ident(database)}.{_ident(table)}" if database else _ident(table)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds data, via the Hadoop FileSystem API (works on any store).

    Hidden and marker entries (``_SUCCESS``, ``.crc``, ``_temporary``) do not
    count: a folder holding only those is an empty table (full load, Q22).
    """
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(hpath))


def target_exists(spark: SparkSession, path: str, database: str | None = None, table: str | None = None) -> bool:
    """S7: the catalog entry (when a table name is given) and the data both exist."""
    catalog_ok = not table or table_exists(spark, database, table)
    return catalog_ok and path_exists(spark, path)


def read_gold(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """S2: the published table, partition columns discovered from the layout.

    With ``schema`` (``Grain.output_schema``) nothing is inferred from files, so
    a table without rows reads as an empty one.
    """
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def published_partitions(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """One row of ``parts`` per partition that holds files, from the directory tree.

    The binary file source lists files and reads their partition values; as no
    content is selected, no file is opened. The rows are held by the driver:
    one per published time bucket (some 44,000 for five years of hours), however
    many samples they sum up.
    """
    files = spark.read.format("binaryFile").load(path)
    schema = ", ".join(f"{p} int" for p in parts)
    if not set(parts) <= set(files.columns):
        return spark.createDataFrame([], schema)
    found = files.select(*[F.col(p).cast("int").alias(p) for p in parts]).distinct().orderBy(*parts)
    return spark.createDataFrame(found.collect(), schema)


def write_stats(
    df: DataFrame,
    path: str,
    parts: Sequence[str],
    load_type: str,
    dynamic_overwrite: bool = False,
) -> None:
    """S3: partitioned Parquet; overwrite on a full load, append on an incremental one.

    Output rows are one per time bucket, so hash-clustering them by the
    partition columns writes exactly one file per partition. The partition
    count (the session's) is given explicitly: the data is tiny and adaptive
    coalescing would otherwise hand every partition directory (thousands on a
    full load) to a single task. ``dynamic_overwrite`` replaces only the
    partitions present in ``df``.
    """
    mode = "overwrite" if (load_type == FULL_LOAD or dynamic_overwrite) else "append"
    _write(df, path, parts, mode, dynamic_overwrite)


def write_partitioned(df: DataFrame, path: str, parts: Sequence[str], dynamic: bool, order: Sequence[str], width: int | None) -> None:
    """The whole of ``path``, or with ``dynamic`` the partitions present in ``df``, replaced by ``df``.

    ``df`` has many rows a partition: ranges of ``parts`` and ``order`` cut large partitions and
    put small ones together, with about a file for each partition and each task.
    """
    ranged = df.repartitionByRange(*([width] if width else []), *parts, *[c for c in order if c not in parts])
    _save(ranged, path, parts, "overwrite", dynamic)


def _write(df: DataFrame, path: str, parts: Sequence[str], mode: str, dynamic: bool) -> None:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    _save(df.repartition(n, *parts), path, parts, mode, dynamic)


def _save(df: DataFrame, path: str, parts: Sequence[str], mode: str, dynamic: bool) -> None:
    writer = df.write.mode(mode).partitionBy(*parts)
    # Said each time: a session default of "dynamic" would leave old partitions behind a full load.
    writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static").parquet(path)


def table_exists(spark: SparkSession, database: str | None, table: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{table}" if database else table)


# Partitions named in one statement.
BATCH = 200


def add_partitions(spark: SparkSession, database: str | None, table: str, paths: Sequence[str]) -> None:
    """S6, incremental: registers the given ``key=value/...`` partitions, listing nothing."""
    name = table_name(database, table)
    for i in range(0, len(paths), BATCH):
        specs = " ".join(f"PARTITION ({', '.join(p.strip('/').split('/'))})" for p in paths[i : i + BATCH])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(f"{database}.{table}" if database else table)


def register_table(
    spark: SparkSession, path: str, database: str | None, table: str, parts: Sequence[str], schema: str
) -> str:
    """S6: external Parquet table over ``path`` whose partitions are those of the storage.

    One statement adds what the catalog lacks and drops what is gone, whichever
    run wrote or removed it: a run that died before registering is made up for
    by the next. The schema is declared, so an empty folder registers as well.
    Works with the in-memory catalog and with a Hive metastore.
    """
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_ident(database)}")
    name = table_name(database, table)
    loc = path.replace("'", "\\'")
    by = ", ".join(_ident(c) for c in parts)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet PARTITIONED BY ({by}) LOCATION '{loc}'")
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(f"{database}.{table}" if database else table)
    return name


def read_table(spark: SparkSession, database: str | None, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}" if database else table)
