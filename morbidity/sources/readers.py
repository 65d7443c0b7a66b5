"""Readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from morbidity.config import DRUG_LIST_GLOB, DRUG_LIST_TAG, Config
from morbidity.sources.files import Source, parsed, read_source


def read_table(
    spark: SparkSession, path: str, cols: list[str] | None = None, schema: str | None = None
) -> DataFrame:
    """Parquet table or folder of tables (a glob is fine), only the columns asked for."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*cols) if cols else df


def _fields(schema: str) -> list[tuple[str, str]]:
    return [tuple(part.split()) for part in schema.split(", ")]


def raw_text(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Delimited text as it is: one string column for each name of the header line.

    The header is read once; each further file under ``path`` must have the same, or its read fails.
    """
    reader = spark.read.option("sep", sep).option("header", True)
    names = reader.csv(path).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return reader.schema(text).option("enforceSchema", False).csv(path)


def _parsed(name: str, kind: str, date_format: str) -> Column:
    c = F.col(f"`{name}`")
    if kind == "string":
        return c
    blank = F.trim(c) == ""
    if kind == "date":
        return F.when(~blank, F.to_date(F.try_to_timestamp(F.trim(c), F.lit(date_format))))
    return F.when(~blank, F.trim(c).try_cast(kind))


def typed(raw: DataFrame, schema: str, prefix: str = "", optional: tuple[str, ...] = (), date_format: str = "dd/MM/yyyy") -> DataFrame:
    """The columns of ``schema``, found in ``raw`` by name, in given types.

    A name may carry ``prefix`` in the file; other columns are left out; a missing one is an error unless it is optional, and then null. Text
    that does not parse becomes null: ``unparsed`` counts it.
    """
    there = {c.removeprefix(prefix): c for c in reversed(raw.columns)}
    fields = _fields(schema)
    missing = [n for n, _ in fields if n not in there and n not in optional]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} among {', '.join(raw.columns)}")
    return raw.select(
        *[(_parsed(there[n], kind, date_format) if n in there else F.lit(None).cast(kind)).alias(n) for n, kind in fields]
    )


def unparsed(raw: DataFrame, schema: str, prefix: str = "", date_format: str = "dd/MM/yyyy") -> DataFrame:
    """(column, n): filled fields of each column of ``schema`` that don't parse. One pass, one row for each column."""
    there = {c.removeprefix(prefix): c for c in reversed(raw.columns)}
    kept = [(n, kind) for n, kind in _fields(schema) if n in there]

    def bad(n: str, kind: str) -> Column:
        c = F.col(f"`{there[n]}`")
        return F.count_if(_parsed(there[n], kind, date_format).isNull() & (F.trim(c) != ""))

    counts = raw.agg(*[bad(n, kind).alias(n) for n, kind in kept])
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).alias("n")) for n, _ in kept])
    return counts.select(F.inline(pairs))


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: str,
    sep: str = "\t",
    date_format: str = "dd/MM/yyyy",
    prefix: str = "",
    optional: tuple[str, ...] = (),
) -> DataFrame:
    """Delimited text with a header line, columns taken by name (see ``typed``)."""
    return typed(raw_text(spark, path, sep), schema, prefix, optional, date_format)


def read_codelist_dir(spark: SparkSession, path: str, schema: str, optional: tuple[str, ...] = ()) -> DataFrame:
    """All CSV files directly in a folder, as one table from one scan; sub-folders are not read.

    The files may differ in the order, number and case of their columns: each is read by its own header.
    """
    return parsed(read_source(spark, f"{path}/*.csv", Source(schema, optional=optional, separators=","), folders=False))


def read_tagged_dir(
    spark: SparkSession,
    path: str,
    schema: str,
    pattern: str = DRUG_LIST_TAG,
    glob: str = DRUG_LIST_GLOB,
    sep: str = ",",
) -> DataFrame:
    """Files of a folder as one table from one scan, each row tagged (``cond``) with a part of its file's name; each file read by its own
    header. What Spark wrote as a folder of that name counts as a file."""
    return parsed(read_source(spark, f"{path}/{glob}", Source(schema, separators=sep), tag=pattern))


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns without a single value. Runs one aggregation; only its one row reaches the driver."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[f"`{c}`" for c in df.columns if counts[c]])


def strip_prefix(df: DataFrame, prefix: str = "e_") -> DataFrame:
    """Remove a leading prefix from the column names."""
    return df.withColumnsRenamed({c: c.removeprefix(prefix) for c in df.columns if c.startswith(prefix)})


def clean_disease_map(raw: DataFrame, cfg: Config) -> DataFrame:
    """The disease map: underscored names, one label corrected, and whether the condition is studied."""
    kept = raw.withColumnsRenamed({"Disease (REAL)": "list_disease_real"})
    name = F.col("list_disease_real")
    fixed = F.when(name == "Atrial fibrilation", F.lit("Atrial fibrillation")).otherwise(name)
    return kept.withColumns(
        {"Disease": F.replace("Disease", F.lit(" "), F.lit("_")), "list_disease_real": fixed}
    ).withColumn("main_cond", F.coalesce(name.isin(*cfg.conditions).cast("int"), F.lit(0)))


def read_disease_map(spark: SparkSession, path: str, cfg: Config) -> DataFrame:
    return clean_disease_map(spark.read.option("header", True).csv(path), cfg)
