"""File and slice sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .slices import SliceTable

# fixed values: the characters that may separate fields, as the loader tries them.
DELIMITERS = [",", ":", ";", "|", "\t", "^", "#", "+", "%", "~", "*", "-", "_", "!", "=", "&", "$"]


def read_csv(spark: SparkSession, path: str | list[str], sep: str, schema: T.StructType) -> DataFrame:
    """Delimited text in Latin-1 with a header; rows with more fields than the schema are skipped, missing ones are NULL."""
    wide = T.StructType([*schema.fields, T.StructField("_too_many", T.StringType())])
    rows = (spark.read.schema(wide).option("sep", sep).option("header", True).option("encoding", "ISO-8859-1")
                 .option("mode", "PERMISSIVE").csv(path))
    return rows.filter(F.col("_too_many").isNull()).drop("_too_many")


def detect_delimiter(lines: DataFrame, line_col: str = "value", group: list[str] | None = None) -> DataFrame:
    """Per line the most frequent candidate (ties: the earlier in the list), then per group (or over all lines) the
    commonest (candidate, count), ties by the larger count and the earlier candidate.  Lines without any have no vote."""
    group = group or []
    c = F.col(line_col)
    counts = F.array(*[F.struct((F.length(c) - F.length(F.replace(c, F.lit(d), F.lit("")))).alias("n"), F.lit(-i).alias("place"), F.lit(d).alias("delimiter"))
                       for i, d in enumerate(DELIMITERS)])
    best = lines.select(*group, F.array_max(counts).alias("b")).filter("b.n > 0").groupBy(*group, "b.n", "b.place", "b.delimiter").agg(F.count(F.lit(1)).alias("lines"))
    return best.groupBy(*group).agg(F.max_by("delimiter", F.struct("lines", "n", "place")).alias("delimiter"))


def changed_sources(listing: DataFrame, recorded: DataFrame) -> DataFrame:
    """The files of a listing (path, modificationTime) whose time differs from the recorded one, or was never recorded."""
    r = recorded.select(F.col("path"), F.col("modificationTime").alias("_t"))
    return listing.join(r, (listing["path"] == r["path"]) & (listing["modificationTime"] == r["_t"]), "left_anti")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Positional rename to the target's names and types; text that does not convert becomes NULL."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns do not fit {len(schema.fields)}")
    return df.toDF(*schema.names).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def source_times(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modificationTime in milliseconds) of the sources directly in ``folder``, empty ones too: a folder of part files
    has its latest file's time."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def latest(status) -> int:
        own = [latest(s) for s in fs.listStatus(status.getPath())] if status.isDirectory() else []
        return max([status.getModificationTime(), *own])

    times = [(s.getPath().getName(), latest(s)) for s in fs.listStatus(at)]
    return spark.createDataFrame(times, "path string, modificationTime long")


def load_changed(spark: SparkSession, folder: str, table: SliceTable, staging: T.StructType) -> list[str]:
    """S03 with S01, S02, S04: the sources of ``folder`` -- its files, or folders of part files -- that changed since the
    table's manifest recorded them replace their slices of ``table`` (keyed by ``source``), each read by its own delimiter;
    rows and manifest are committed together.  Returns the sources loaded.  Sources that are gone keep their rows."""
    root = folder.rstrip("/").split("/")[-1]
    recorded = spark.createDataFrame([(n, t) for n, (t, state) in table.sources().items() if state == "OK"], "path string, modificationTime long")
    found = {r["path"]: r["modificationTime"] for r in changed_sources(source_times(spark, folder), recorded).collect()}  # one row a source
    if not found:
        return []
    lines = spark.read.text([f"{folder.rstrip('/')}/{n}" for n in sorted(found)])
    of_line = F.regexp_extract("_metadata.file_path", f"/{root}/([^/]+)", 1)
    by_sep: dict[str, list[str]] = {}
    for r in detect_delimiter(lines.select(of_line.alias("source"), "value"), group=["source"]).collect():
        by_sep.setdefault(r["delimiter"], []).append(r["source"])
    text = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(staging.fields))])
    parts = []
    for sep, names in sorted(by_sep.items()):
        rows = read_csv(spark, [f"{folder.rstrip('/')}/{n}" for n in sorted(names)], sep, text).select(*text.names, of_line.alias("source"))
        parts.append(conform(rows, T.StructType([*staging.fields, T.StructField("source", T.StringType())])))
    if parts:
        new = reduce(DataFrame.union, parts)
    else:  # empty files have no delimiter; their slices are cleared
        new = spark.createDataFrame([], T.StructType([*staging.fields, T.StructField("source", T.StringType())]))
    table.replace(new, [{"source": n} for n in found], sources={n: (t, "OK") for n, t in found.items()})
    return sorted(found)


def transfer(df: DataFrame, date_cols: list[str], bound_col: str, from_date: Column, fmt: str = "yyyyMMdd") -> DataFrame:
    """Date texts to dates (bad ones NULL), rows from ``from_date`` on."""
    out = df.withColumns({c: F.try_to_date(F.col(c), fmt) for c in date_cols})
    return out.filter(F.col(bound_col) >= from_date)


def delete_where(df: DataFrame, *conditions: Column) -> DataFrame:
    """The rows that fulfil none of the conditions; a condition that is NULL deletes nothing."""
    return df.filter(~reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions]))
