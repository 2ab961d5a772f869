"""Stored objects in numbers: what is spread over tasks, and what the driver must not hold."""

import os

from pyspark.sql import functions as F

from lodestack.sources import objects


def test_objects_of_one_partition_are_put_by_several_tasks(spark, tmp_path):
    target = f"file://{tmp_path}/objects"
    rows = spark.range(0, 200, 1, 1).select(F.concat(F.lit("a/"), (F.col("id") % 3).cast("string"), F.lit("/"), F.col("id").cast("string")).alias("key"), F.lit("x").alias("content"))
    done = objects.put_objects(rows, target)
    assert len({r.p for r in done.select(F.spark_partition_id().alias("p")).collect()}) > 16
    assert {(r.outcome, r.bytes) for r in done.collect()} == {("copied", 1)}
    assert objects.listing(spark, target).count() == 200


def test_a_listing_lists_folders_in_tasks_as_the_file_scan_does(spark, tmp_path):
    root = tmp_path / "objects"
    for name, text in (("top.pdf", "x"), ("a/b c/deep%20.HTML", "xy"), ("a/empty", ""), ("a/.hidden", "x"), ("_no/file", "x"), ("a/_no", "x"), ("_p=1/file", "x")):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    os.mkdir(root / "void")
    found = objects.listing(spark, f"file://{root}/")
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"file://{root}")
    assert {r.key: r.bytes for r in found.collect()} == {"top.pdf": 1, "a/b c/deep%20.HTML": 2, "_p=1/file": 1}
    assert sorted((r.bytes, int(r.modified.timestamp())) for r in found.collect()) == sorted((r.length, int(r.modificationTime.timestamp())) for r in scan.collect())
    assert not found.inputFiles()
