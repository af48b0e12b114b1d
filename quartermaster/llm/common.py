"""Helpers shared by the operators of this package: reading tables, batches, scratch tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import quartermaster
from quartermaster.session import ensure_checkpoint_dir

#: Rows of one Arrow batch: with whole texts in a row, this bounds a Python worker's memory.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, a checkpoint folder (the session's, else a private one in local mode), and this library's
    folder on the Python workers' search path, as it is on the driver's (where executors have it there, or by
    ``--py-files``)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ensure_checkpoint_dir(spark)
    home, env = str(Path(quartermaster.__file__).parent.parent), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, home])


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written to the shared folder and read from there afterwards."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to the columns of ``schema`` (a dict of lists or arrays)."""
    arrow = pa.schema([(f.name, _arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = fn(batch)
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                      for c, f in ((cols[f.name], f) for f in arrow)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    simple = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.DoubleType: pa.float64(),
              T.BooleanType: pa.bool_(), T.BinaryType: pa.binary(), T.FloatType: pa.float32()}
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    return simple[type(t)]


def schema_of(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def fold_of(doc_id) -> F.Column:
    """True for the held-out quarter: crc32 of the id's text modulo 4 is 2 (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
