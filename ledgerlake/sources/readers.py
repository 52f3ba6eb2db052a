"""Readers: every raw column arrives as text, with an explicit schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlake.session import stored
from ledgerlake.sources.tables import TableSpec

LINEAGE = ("_fonte", "_carga_ts")


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Works on any file system Spark can read, not only the driver's disk."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(system.exists(hadoop_path))


def missing_inputs(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    return [p for p in paths if not path_exists(spark, p)]


def require_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    missing = missing_inputs(spark, paths)
    if missing:
        raise FileNotFoundError("missing inputs: " + ", ".join(missing))


def _options(sep: str, encoding: str) -> dict[str, str]:
    return {"header": "true", "sep": sep, "encoding": encoding, "quote": '"', "escape": '"'}


def header_of(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8") -> list[str]:
    """Column names of a file, without a byte-order mark. Reads one line."""
    names = spark.read.options(**_options(sep, encoding)).csv(path).columns
    return [n.lstrip("﻿").strip() for n in names]


def read_text_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """All columns as text. Surplus columns of the file are dropped by position."""
    header = header_of(spark, path, sep, encoding)
    wanted = list(columns) if columns else header
    if len(header) < len(wanted):
        raise ValueError(f"{path} has {len(header)} columns, {len(wanted)} expected")
    # The schema covers the whole file, so that a wider file is not taken for a malformed one.
    surplus = [f"_surplus{i}" for i in range(len(header) - len(wanted))]
    raw = (
        spark.read.options(**_options(sep, encoding), enforceSchema="true")
        .schema(text_schema(wanted + surplus))
        .csv(path)
    )
    return raw.select(*wanted)


CORRUPT = "_registro"


def read_with_rejects(
    spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",", encoding: str = "UTF-8", header: bool = True, line_breaks: bool = False
) -> tuple[DataFrame, DataFrame]:
    """All columns as text, and apart from them every record that does not have exactly those columns, as it was written.

    Rejected records come with a reason and their number of fields. With `line_breaks` a quoted field may hold line breaks; such a
    file cannot be split, so it is read by one task. The parsed records are written once, and both tables are read from there.
    """
    schema = text_schema([*columns, CORRUPT])
    raw = spark.read.options(
        **_options(sep, encoding) | {"header": str(header).lower(), "multiLine": str(line_breaks).lower(), "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    ).schema(schema).csv(path)
    parsed = stored(raw, "parsed")
    # Separators outside quotes tell how many fields a record has.
    bare = F.regexp_replace(CORRUPT, r'"([^"]|"")*("|$)', "")
    fields = ((F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep) + 1).cast("int")
    reason = F.when(F.col("campos") < len(columns), "faltam campos").when(F.col("campos") > len(columns), "sobram campos").otherwise("registro ilegível")
    rejected = parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("registro"), fields.alias("campos")).withColumn("motivo", reason)
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rejected


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({LINEAGE[0]: F.lit(source), LINEAGE[1]: F.current_timestamp()})


def with_stamp(df: DataFrame, name: str) -> DataFrame:
    """The time a layer was written, under the layer's own column name."""
    return df.withColumn(name, F.current_timestamp())


def load_group(
    spark: SparkSession, root: str, specs: Sequence[TableSpec]
) -> tuple[dict[str, DataFrame], list[str]]:
    """The tables with lineage, and the names of those whose file is missing.

    A missing file gives an empty table when its layout is known, so that the
    rest of the build can run without it.
    """
    tables, absent = {}, []
    for spec in specs:
        path = f"{root}/{spec.file}"
        if not path_exists(spark, path):
            absent.append(spec.table)
            if spec.columns:
                empty = spark.range(0).select(*[F.lit(None).cast("string").alias(c) for c in spec.columns])
                tables[spec.table] = with_lineage(empty, spec.group)
            continue
        tables[spec.table] = with_lineage(read_text_csv(spark, path, spec.columns, spec.sep), spec.group)
    return tables, absent


def read_typed_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """CSV with declared types: no inference pass over the data."""
    return spark.read.options(**_options(sep, "UTF-8")).schema(schema).csv(path)


def read_snapshot(spark: SparkSession, folder: str, as_of: str | None = None) -> DataFrame:
    """A table as of a day: the newest dated snapshot not after it."""
    days = snapshot_days(spark, folder)
    usable = [d for d in days if as_of is None or d <= as_of]
    if not usable:
        raise FileNotFoundError(f"no snapshot of {folder} up to {as_of}")
    return spark.read.parquet(f"{folder}/snapshot={usable[-1]}")


def snapshot_days(spark: SparkSession, folder: str) -> list[str]:
    """History of a table: its snapshot days, oldest first."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(folder)
    system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(hadoop_path)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("snapshot="))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    parts = [
        df.agg(F.count("*").alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, parts)
