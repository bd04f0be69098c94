"""Queries that feed several batches take them from rows joined and cleaned once, in files of bounded size."""

import os

import pytest
from pyspark.sql import functions as F

from harness import registry
from vigiltx.sources.shared import shared_folder
from vigiltx.sources.tables import VersionedTable


@pytest.fixture
def sf(spark, tmp_path):
    lines = spark.range(400).select(
        (F.col("id") / 4).cast("long").alias("l_orderkey"), (F.col("id") * 7 % 90).alias("l_partkey"), (F.col("id") % 11).alias("l_suppkey"),
        (F.col("id") % 4).cast("int").alias("l_linenumber"), (F.col("id") * 997.0 % 90000).alias("l_extendedprice"),
        F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("l_returnflag"), F.when(F.col("id") % 2 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.date_add(F.lit("1997-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("l_shipdate"),
    )
    orders = spark.range(100).select(F.col("id").alias("o_orderkey"), (F.col("id") % 17).alias("o_custkey"), F.concat((F.col("id") % 5 + 1).cast("string"), F.lit("-X")).alias("o_orderpriority"))
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("name", ["upsert_transactions", "upsert_idempotent", "upsert_by_partition"])
def test_upserts_read_silver_that_is_written(spark, sf, monkeypatch, name):
    plans = []
    for table in (VersionedTable, registry.PartitionedTable):
        def upsert(self, source, *more, upsert=table.upsert, **named):
            plans.append(source._jdf.queryExecution().optimizedPlan().toString())
            return upsert(self, source, *more, **named)

        monkeypatch.setattr(table, "upsert", upsert)
    assert registry.QUERIES[name](spark, sf).count() > 300
    assert len(plans) >= 2 and not any("Join" in plan for plan in plans)


@pytest.mark.parametrize("name", ["bronze_append", "incremental_upsert", "incremental_regrouped"])
def test_batches_read_bronze_that_is_written(spark, sf, monkeypatch, name):
    plans = []
    append = registry.append_batch

    def appended(df, *more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        append(df, *more)

    monkeypatch.setattr(registry, "append_batch", appended)
    assert registry.QUERIES[name](spark, sf).count() > 0
    assert len(plans) >= 2 and not any("Join" in plan for plan in plans)


def test_regrouped_batches_leave_no_copy_of_bronze(spark, sf):
    shared = os.path.join(shared_folder(spark).removeprefix("file:"), "vigiltx")
    before = set(os.listdir(shared)) if os.path.exists(shared) else set()
    assert registry.QUERIES["incremental_regrouped"](spark, sf).count() > 300
    assert {n.split("-")[0] for n in set(os.listdir(shared)) - before} == {"bronze", "regrouped"}
    assert not [n for n in set(os.listdir(shared)) - before if n.startswith("bronze-rows")]


def test_streamed_files_have_as_many_parts_as_their_rows_need(spark, sf, monkeypatch):
    found = []
    stream = registry.stream_silver

    def streamed(spark, path, table, progress, files_per_batch):
        files = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"))
        found.append((files.select("file").distinct().count(), files_per_batch, files.filter("PK_Transaccion IS NOT NULL").groupBy("batch_id", "PK_Transaccion").agg(F.countDistinct("file").alias("n")).filter("n > 1").count()))
        return stream(spark, path, table, progress, files_per_batch=files_per_batch)

    monkeypatch.setattr(registry, "stream_silver", streamed)
    one = {tuple(r) for r in registry.QUERIES["stream_upsert"](spark, sf).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = {tuple(r) for r in registry.QUERIES["stream_upsert"](spark, sf).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert one == many
    (few, _, split), (files, at_once, still_split) = found
    assert few == 4 and files > 4 and at_once >= files / 2 and split == still_split == 0
