"""Folders that the driver and all executors share, and tables written there."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's ``spark.checkpoint.dir``.

    A local session, whose one machine is driver and executor, gets a temporary folder where the
    setting is missing; on a cluster that is an error, as its machines could not share the folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lodestack-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there.

    Lost executors cost no more than the tasks in flight, since the written files are
    not on any executor's own disk.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], name: str) -> str:
    """``name``, lengthened until it differs from all ``columns`` whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def fields_of(struct: str, columns: list[str]) -> list:
    """The fields of a struct column as columns of their own, whatever their names."""
    return [F.col(struct).getField(c).alias(c) for c in columns]


def as_struct(columns: list[str], name: str):
    """Columns, whatever their names, as one struct column."""
    return F.struct(*(F.col(quoted(c)).alias(c) for c in columns)).alias(name)


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def integral_id(df: DataFrame, column: str, what: str) -> None:
    """Raise at once where ids are not whole numbers of at most 64 bits."""
    kind = df.schema[column].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"{what} keep ids as 64-bit integers; {column} is {kind.simpleString()}")
