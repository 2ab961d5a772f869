"""The engine's own tables: partitioned Parquet folders that jobs append to or rewrite.

A job that changes rows rewrites the table's partitions by dynamic overwrite, which stages their files and puts
them in place when the job commits; what it reads of the table itself it has read by then. Partitions that the rows do not have stay
as they are, so jobs of the two chambers may rewrite their filings at the same time. An append adds files.
Frames read before a rewrite are not to be used after it; steps that need rows twice stage them.

Spark takes the size of a file for that of its rows and so broadcasts millions of ids that compress well, which the driver's memory
cannot hold. Joins with tables that grow with the filings, and with staged rows, are therefore sort-merge joins by a hint;
a broadcast hint on the other side, for rows that stay few, takes precedence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import TABLES, empty

#: What a table is partitioned by; the others have one partition. Community rows are dealt out, so that a rewrite goes part by part.
PARTITIONS = {"filings": "chamber", "community_transactions": "cast(pmod(xxhash64(dedup_key), 4) as string)"}
#: Tables that grow with the filings: no join may hold one of them whole.
GROWING = {"filings", "transactions", "holdings", "dq_issues", "community_transactions", "transaction_provenance", "instruments", "ticker_map"}


class State:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, table: str, part: str | None = None) -> DataFrame:
        try:
            rows = self.spark.read.schema(f"{TABLES[table]}, part string").parquet(f"{self.folder}/{table}")
        except Exception as error:  # the table has not been written yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return empty(self.spark, table)
        rows = (rows if part is None else rows.filter(F.col("part") == part)).drop("part")
        return rows.hint("merge") if table in GROWING else rows

    def parts(self, table: str) -> list[str]:
        """The partitions that a table has."""
        return sorted({f.split("/part=")[1].split("/")[0] for f in self.read(table).inputFiles()})

    def _shaped(self, table: str, rows: DataFrame) -> DataFrame:
        """``rows`` with the table's columns and its partition; columns that are missing are null."""
        wanted = empty(self.spark, table).schema
        shaped = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted))
        return shaped.withColumn("part", F.expr(PARTITIONS[table]) if table in PARTITIONS else F.lit("all"))

    def replace(self, table: str, rows: DataFrame) -> DataFrame:
        """Put ``rows`` in the place of the table's; returns it as read back. The rows are computed once, by their write."""
        shaped, path = self._shaped(table, rows), f"{self.folder}/{table}"
        before = set(self.read(table).inputFiles())
        shaped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").option("compression", "zstd").parquet(path)
        if before and set(self.read(table).inputFiles()) == before:  # there were no rows: no partition was named, so nothing overwritten
            shaped.limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(path)
        return self.read(table)

    def replace_part(self, table: str, part: str, rows: DataFrame) -> None:
        """Put ``rows``, at least one, in the place of those of one partition; two versions of that partition are all that the disk holds meanwhile."""
        shaped = self._shaped(table, rows).withColumn("part", F.lit(part))
        shaped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").option("compression", "zstd").parquet(f"{self.folder}/{table}")

    def append(self, table: str, rows: DataFrame) -> DataFrame:
        """Add ``rows`` to the table's files, which stay as they are; returns the table as read back."""
        self._shaped(table, rows).write.mode("append").option("compression", "zstd").partitionBy("part").parquet(f"{self.folder}/{table}")
        return self.read(table)

    def staged(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` written once for the several steps of a job that read them; the next job's take their place."""
        path = f"{self.folder}/_staged/{name}"
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path).hint("merge")
