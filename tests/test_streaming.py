import math
import os
import random
from datetime import datetime, timedelta

import pytest
from builders import NOON, bronze, silver
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from vigiltx.operators.clean import clean_transactions
from vigiltx.operators.detectors import burst_sessions
from vigiltx.schema import SILVER_COLUMNS, publish
from vigiltx.sources.tables import PartitionedTable, VersionedTable, append_batch, with_lineage
from vigiltx.streaming.bursts import burst_stream
from vigiltx.streaming.upsert import load_new_batches, stream_silver


@pytest.mark.parametrize(
    "make", [VersionedTable, lambda spark, path: PartitionedTable(spark, path, "tx_date")]
)
def test_streamed_silver_equals_batch(spark, tmp_path, make):
    source, progress = tmp_path / "bronze", str(tmp_path / "progress")
    table = make(spark, str(tmp_path / "silver"))
    columns = [*SILVER_COLUMNS, "tx_ts"]
    first = bronze(spark, [{"tx_id": f"t{i}"} for i in range(5)] + [{"tx_id": "t0", "time_text": "2026-09-01 12:00:01"}])
    second = bronze(spark, [{"tx_id": "t1", "amount_usd": 9.0}, {"tx_id": "t9"}, {"tx_id": None}])
    first.coalesce(1).write.parquet(str(source / "1"))
    stream_silver(spark, str(source / "*"), table, progress, files_per_batch=1).awaitTermination()
    assert set(table.read().select(columns).collect()) == set(clean_transactions(first).collect())
    second.coalesce(1).write.parquet(str(source / "2"))
    stream_silver(spark, str(source / "*"), table, progress, files_per_batch=1).awaitTermination()
    by_batch = VersionedTable(spark, str(tmp_path / "by-batch"))
    by_batch.upsert(clean_transactions(first), "tx_id")
    by_batch.upsert(clean_transactions(second), "tx_id")
    assert set(table.read().select(columns).collect()) == set(by_batch.read().collect())


@pytest.mark.parametrize("make", [VersionedTable, lambda spark, path: PartitionedTable(spark, path, "tx_date")])
def test_the_newest_file_wins_in_any_micro_batch(spark, tmp_path, make):
    source = tmp_path / "bronze"
    files = [
        [{"tx_id": "t0", "amount_usd": 1.0}, {"tx_id": "t1", "amount_usd": 1.0}, {"tx_id": "t2", "amount_usd": 1.0}],
        [{"tx_id": "t0", "amount_usd": 2.0, "time_text": "2026-08-01 00:00:00"}, {"tx_id": "t3", "amount_usd": 2.0}],
        [{"tx_id": "t0", "amount_usd": 3.0, "time_text": "2026-10-01 00:00:00"}, {"tx_id": "t2", "amount_usd": 3.0}],
    ]
    for i, rows in enumerate(files):
        names = publish if i != 1 else lambda df: df  # published and own names together
        names(with_lineage(bronze(spark, rows), f"00{i}", "core")).coalesce(1).write.parquet(str(source / str(9 - i)))
    found = []
    for size in (1, 2, 8):
        table = make(spark, str(tmp_path / f"silver-{size}"))
        stream_silver(spark, str(source / "*"), table, str(tmp_path / f"progress-{size}"), size).awaitTermination()
        found.append({(r.tx_id, r.amount_usd, r.batch_id, r.source_system) for r in table.read().collect()})
    assert found[0] == found[1] == found[2]
    assert found[0] == {("t0", 3.0, "002", "core"), ("t1", 1.0, "000", "core"), ("t2", 3.0, "002", "core"), ("t3", 2.0, "001", "core")}
    # An older file that is loaded again changes nothing.
    stream_silver(spark, str(source / "9"), table, str(tmp_path / "again"), 8).awaitTermination()
    assert {(r.tx_id, r.amount_usd, r.batch_id, r.source_system) for r in table.read().collect()} == found[0]


def test_a_file_without_key_column_stops_the_stream(spark, tmp_path):
    bronze(spark, [{}]).drop("tx_id").coalesce(1).write.parquet(str(tmp_path / "bronze" / "1"))
    table = VersionedTable(spark, str(tmp_path / "silver"))
    with pytest.raises(StreamingQueryException, match="PK_Transaccion"):
        stream_silver(spark, str(tmp_path / "bronze" / "*"), table, str(tmp_path / "progress")).awaitTermination()
    assert not table.exists()


def test_published_batches_load(spark, tmp_path):
    path, table = str(tmp_path / "bronze"), VersionedTable(spark, str(tmp_path / "silver"))
    append_batch(publish(bronze(spark, [{"tx_id": "a"}, {"tx_id": "b"}])), path, "1", "core")
    load_new_batches(spark, path, table)
    assert {r.tx_id for r in table.read().collect()} == {"a", "b"}
    append_batch(bronze(spark, [{}]).drop("tx_id"), str(tmp_path / "keyless"), "1", "core")
    with pytest.raises(ValueError, match="PK_Transaccion"):
        load_new_batches(spark, str(tmp_path / "keyless"), VersionedTable(spark, str(tmp_path / "other")))


def test_bursts_close_at_the_watermark_and_late_rows_drop(spark, tmp_path):
    noon = datetime(2026, 9, 1, 12)
    schema = "id string, ts timestamp_ntz, value double"

    def put(name, rows):
        made = [(k, noon + timedelta(minutes=m), v) for k, m, v in rows]
        spark.createDataFrame(made, schema).coalesce(1).write.parquet(str(tmp_path / "in" / name))

    def run():
        events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        bursts = burst_stream(events, "id", "ts", "value", 600, "30 minutes")
        (
            bursts.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
        )
        return {(r.customer_id, (r.started_at - noon) // timedelta(minutes=1), r.events, r.amount)
                for r in spark.read.schema(bursts.schema).parquet(str(tmp_path / "out")).collect()}

    put("1", [("a", 0, 1.0), ("a", 9, 2.0), ("a", 25, 4.0), ("b", 120, 1.0)])
    assert run() == {("a", 0, 2, 3.0), ("a", 25, 1, 4.0)}
    put("2", [("a", 5, 100.0), ("b", 125, 1.0), ("c", 300, 1.0)])  # the first is late
    assert run() == {("a", 0, 2, 3.0), ("a", 25, 1, 4.0), ("b", 120, 2, 2.0)}


def test_streamed_bursts_equal_the_batch_detector(spark, tmp_path):
    draw = random.Random(2)
    rows = [(f"c{draw.randint(0, 3)}", "x", "c", draw.choice([0.1, 5e16, 123.45]), draw.randint(0, 9000)) for _ in range(400)]
    rows += [("hot", "x", "c", 0.01, i % 70) for i in range(3000)]
    rows += [("edge", "x", "c", 1.0, t) for t in (0, 59, 118, 178)] + [(None, "x", "c", 1.0, 5), ("odd", "x", "c", math.inf, 5)]
    tx = silver(spark, rows)
    for part in range(4):
        tx.filter(f"pmod(hash(tx_id), 4) = {part}").write.parquet(str(tmp_path / "in" / str(part)))
    # Everything is closed by a payment much later.
    silver(spark, [("late", "x", "c", 1.0, 500_000)]).write.parquet(str(tmp_path / "in" / "9"))
    events = spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", 3).parquet(str(tmp_path / "in" / "*"))
    bursts = burst_stream(events, "origin", "tx_ts", "amount_usd", 59, "1 day")
    (
        bursts.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start().awaitTermination()
    )
    got = spark.read.schema(bursts.schema).parquet(str(tmp_path / "out")).collect()
    want = {tuple(r) for r in burst_sessions(tx).collect()}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert {(r.started_at, r.events) for r in got if r.customer_id == "edge"} == {(NOON, 3), (NOON + timedelta(seconds=178), 1)}
    assert [r.events for r in got if r.customer_id == "hot"] == [3000]


def test_older_batches_are_not_opened(spark, tmp_path):
    path, table = str(tmp_path / "bronze"), VersionedTable(spark, str(tmp_path / "silver"))
    append_batch(bronze(spark, [{"tx_id": "a"}]).withColumn("branch", F.lit("x")).coalesce(1), path, "1", "core")
    load_new_batches(spark, path, table)
    for file in (tmp_path / "bronze" / "batch_id=1").glob("*.parquet"):
        at = file.stat()
        file.write_bytes(b"?" * at.st_size)  # as large and as old, so the batch counts as loaded
        os.utime(file, ns=(at.st_atime_ns, at.st_mtime_ns))
    append_batch(bronze(spark, [{"tx_id": "b"}]).withColumn("desk", F.lit(7)), path, "2", "core")
    load_new_batches(spark, path, table)
    assert {(r.tx_id, r.branch, r.desk) for r in table.read().collect()} == {("a", "x", None), ("b", None, 7)}
