"""Folders of delimited text whose files may differ in columns, order, case of names and separator, read in one scan.

The header lines are read first, one line of each file. Then all files of a separator are one scan by position: which position holds a
column is looked up by the row's file. Text that doesn't parse becomes null and is listed in ``rejected`` in the same pass.
"""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATORS = "\t|;,"
REJECTED = "array<struct<column: string, value: string>>"


@dataclass(frozen=True)
class Source:
    """What a raw table's files hold: columns by name, in any case, with or without ``prefix``. ``renamed`` maps names in the files to columns."""

    schema: str
    prefix: str = ""
    optional: tuple[str, ...] = ()
    renamed: dict[str, str] = field(default_factory=dict)
    separators: str = SEPARATORS  # of these, the one that parts a header line into most names
    date_format: str = "dd/MM/yyyy"

    def fields(self) -> list[tuple[str, str]]:
        return [tuple(part.split()) for part in self.schema.split(", ")]

    def places(self, names: list[str]) -> list[int]:
        """Where each column stands in a file of these names; -1 for an optional one that is missing."""
        known = {k.lower(): v.lower() for k, v in self.renamed.items()}
        plain = [n.strip().lower().removeprefix(self.prefix.lower()) for n in names]
        there = {known.get(n, n): i for i, n in reversed(list(enumerate(plain)))}
        optional = {n.lower() for n in self.optional}
        missing = [n for n, _ in self.fields() if n.lower() not in there and n.lower() not in optional]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} among {', '.join(names)}")
        return [there.get(n.lower(), -1) for n, _ in self.fields()]


def _paths(spark: SparkSession, pattern: str, folders: bool) -> list:
    """Files that a pattern names, and with ``folders`` those directly in folders that it names. Spark's marks and hidden files are left out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(path) or []:
        inside = system.listStatus(status.getPath()) if status.isDirectory() and folders else [status]
        found += [s.getPath() for s in inside if not s.isDirectory() and s.getPath().getName()[0] not in "._" and s.getLen() > 0]
    return sorted(found, key=lambda p: p.toString())


def _first_line(spark: SparkSession, path) -> str:
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        plain = codec.createInputStream(stream) if codec is not None else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()
    return (line or "").removeprefix("﻿")


def headers(spark: SparkSession, pattern: str, separators: str = SEPARATORS, folders: bool = True) -> list[tuple[str, str, list[str]]]:
    """(file, separator, names) of each file: the driver opens every file once and reads a line. No Spark job."""
    paths = _paths(spark, pattern, folders)
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda p: _first_line(spark, p), paths))
    out = []
    for path, line in zip(paths, lines):
        parted = [(sep, next(csv.reader([line], delimiter=sep), [])) for sep in separators]
        out.append((path.toUri().toString(), *max(parted, key=lambda x: len(x[1]))))
    return out


def _parsed(text: Column, kind: str, date_format: str) -> Column:
    if kind == "string":
        return text
    filled = F.when(F.trim(text) != "", F.trim(text))
    if kind == "date":
        return F.to_date(F.try_to_timestamp(filled, F.lit(date_format)))
    return filled.try_cast(kind)


def _plain_uri(c: Column) -> Column:
    """One slash after ``file:``, as the driver's names have it. No pattern, for every row has a path."""
    return F.when(c.startswith("file:/"), F.concat(F.lit("file:/"), F.ltrim(F.substring(c, 6, 1 << 30), F.lit("/")))).otherwise(c)


def read_source(spark: SparkSession, pattern: str, source: Source, tag: str | None = None, folders: bool = True) -> DataFrame:
    """The columns of the source's schema with ``rejected`` and ``file``; first ``cond`` where ``tag`` is a pattern: its first group in the last two
    parts of the file's path. No file gives no rows."""
    found = headers(spark, pattern, source.separators, folders)
    kinds = source.fields()
    first = "cond string, " if tag else ""
    whole = spark.createDataFrame([], f"{first}{source.schema}, rejected {REJECTED}, file string") if not found else None
    for sep in sorted({s for _, s, _ in found}):
        files = [(uri, names) for uri, s, names in found if s == sep]
        part = _scan(spark, files, sep, source, kinds, tag)
        whole = part if whole is None else whole.unionByName(part)
    return whole


def _scan(spark, files: list[tuple[str, list[str]]], sep: str, source: Source, kinds, tag: str | None) -> DataFrame:
    width = max(len(names) for _, names in files)
    places = {re.sub("^file:/+", "file:/", uri): source.places(names) for uri, names in files}
    columns = [f"c{i}" for i in range(width)]
    reader = spark.read.schema(", ".join(f"{c} string" for c in columns)).option("sep", sep).option("header", True)
    jvm = spark._jvm
    rows = reader.csv([jvm.java.net.URI(uri).getPath() if uri.startswith("file:") else jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString() for uri, _ in files])
    rows = rows.select("*", _plain_uri(F.col("_metadata.file_path")).alias("file"))
    orders = {tuple(p) for p in places.values()}
    if len(orders) == 1:
        texts = [F.col(columns[at]) if at >= 0 else F.lit(None).cast("string") for at in next(iter(orders))]
    else:
        table = spark.createDataFrame(list(places.items()), "file string, __at array<int>")
        rows = rows.join(table, "file")  # one row a file: Spark broadcasts it by its size
        texts = [F.get(F.array(*columns), F.get("__at", F.lit(k))) for k in range(len(kinds))]
    named = [F.regexp_extract(F.array_join(F.slice(F.split("file", "/"), -2, 2), "/"), tag, 1).alias("cond")] if tag else []
    names, was = [n for n, _ in kinds], [f"__text{k}" for k in range(len(kinds))]
    # a step each, so that no text is taken and none is parsed twice
    taken = rows.select(*named, *[t.alias(w) for t, w in zip(texts, was)], "file")
    read = taken.select("*", *[_parsed(F.col(w), kind, source.date_format).alias(n) for w, (n, kind) in zip(was, kinds)])
    bad = [(F.col(n).isNull() & (F.trim(w) != ""), n, w) for w, (n, kind) in zip(was, kinds) if kind != "string"]
    none = F.array().cast(REJECTED)
    rejected = none
    if bad:
        each = [F.when(is_bad, F.array(F.struct(F.lit(n).alias("column"), F.col(w).alias("value")))).otherwise(none) for is_bad, n, w in bad]
        # hardly a row has any: the others pay for the test alone
        rejected = F.when(reduce(lambda x, y: x | y, [b for b, _, _ in bad]), F.concat(*each)).otherwise(none)
    first = ["cond"] if tag else []
    return read.select(*first, *names, rejected.cast(REJECTED).alias("rejected"), "file")


def rejects(read: DataFrame) -> DataFrame:
    """(file, column, value): what did not parse."""
    return read.where(F.size("rejected") > 0).select("file", F.inline("rejected"))


def parsed(read: DataFrame) -> DataFrame:
    """The table alone."""
    return read.drop("rejected", "file")
