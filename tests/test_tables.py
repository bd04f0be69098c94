import os
import random
import shutil
import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from builders import bronze, customers
from conftest import executed_plan
from pyspark.sql import functions as F

from vigiltx.config import ModelConfig, MonitorConfig
from vigiltx.plans.layers import refresh_gold, refresh_silver
from vigiltx.schema import ALERT_COLUMNS, CUSTOMERS, PROFILE_COLUMNS, PUBLISHED, SILVER_COLUMNS, publish
from vigiltx.sources import tables
from vigiltx.sources.shared import SHUFFLE_CLEANUP, lent, shared_folder
from vigiltx.sources.tables import (
    ConcurrentWriteError, PartitionedTable, RepeatedKeyError, VersionedTable, append_batch,
    read_batches, write_partitioned,
)
from vigiltx.streaming.upsert import load_new_batches


def pairs(spark, **values):
    return spark.createDataFrame(list(values.items()), "k string, v int")


def content(df):
    return {r.k: r.v for r in df.collect()}


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"))


def test_first_load_creates(spark, table):
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.upsert(pairs(spark, a=1), "k")
    assert table.exists() and content(table.read()) == {"a": 1}


def test_upsert_updates_inserts_and_keeps(spark, table):
    table.overwrite(pairs(spark, target=1, both=1))
    for _ in range(2):  # twice gives the same as once
        table.upsert(pairs(spark, both=2, source=2), "k")
        assert content(table.read()) == {"target": 1, "both": 2, "source": 2}


def test_repeated_source_key_is_refused(spark, table):
    table.overwrite(pairs(spark, a=1))
    twice = pairs(spark, a=2).unionByName(pairs(spark, a=3))
    with pytest.raises(RepeatedKeyError):
        table.upsert(twice, "k")
    assert content(table.read()) == {"a": 1}


def test_failed_write_leaves_the_table(spark, table):
    table.overwrite(pairs(spark, a=1))
    broken = pairs(spark, a=2).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        table.upsert(broken, "k")
    assert content(table.read()) == {"a": 1}


def test_two_writers_do_not_lose_each_others_rows(spark, table, monkeypatch):
    table.overwrite(pairs(spark, a=1))
    other, write = VersionedTable(spark, table.path), VersionedTable._write

    def slow_write(self, df):
        if self is table:
            other.upsert(pairs(spark, b=2), "k")
        return write(self, df)

    monkeypatch.setattr(VersionedTable, "_write", slow_write)
    with pytest.raises(ConcurrentWriteError):
        table.overwrite(pairs(spark, c=3))
    assert content(table.read()) == {"a": 1, "b": 2}


def test_a_commit_between_check_and_switch_is_not_lost(spark, table):
    table.overwrite(pairs(spark, a=1))
    base, other = table._live(), VersionedTable(spark, table.path)
    other.overwrite(pairs(spark, b=2))
    with pytest.raises(ConcurrentWriteError):
        table._switch(base, {"data": "nowhere"}, None)
    assert content(table.read()) == {"b": 2}


def test_of_many_writers_at_once_one_commits(spark, table):
    table.overwrite(pairs(spark, a=1))
    base = table._live()

    def commit(i):
        try:
            VersionedTable(spark, table.path)._switch(base, {"data": str(i)}, None)
        except ConcurrentWriteError:
            return None
        return i

    with ThreadPoolExecutor(8) as pool:
        won = [i for i in pool.map(commit, range(8)) if i is not None]
    assert len(won) == 1 and table._live()["data"] == str(won[0])


def test_a_column_named_version_survives(spark, tmp_path):
    parts = PartitionedTable(spark, str(tmp_path / "parts"), "day")
    for kind in ("string", "int"):
        rows = spark.createDataFrame([("a", "1", "d1")], "k string, version string, day string")
        parts.overwrite(rows.withColumn("version", F.col("version").cast(kind)))
        assert {str(r.version) for r in parts.read().collect()} == {"1"}


def test_newest_batch_wins_in_any_grouping(spark, tmp_path):
    path = str(tmp_path / "bronze")
    one, both = (VersionedTable(spark, str(tmp_path / name)) for name in ("one", "both"))
    late = {"tx_id": "1", "amount_usd": 2.0, "time_text": "2026-09-02 12:00:00"}
    for batch_id, row in (("009", {"tx_id": "1"}), ("010", late)):
        append_batch(bronze(spark, [row]), path, batch_id, "core")
        load_new_batches(spark, path, one)
    load_new_batches(spark, path, both)
    for table in (one, both):
        assert [(r.amount_usd, r.batch_id) for r in table.read().collect()] == [(2.0, "010")]


def test_a_pointer_left_empty_is_passed_over(spark, table):
    table.overwrite(pairs(spark, a=1))
    with open(f"{table.path}/_versions/0000000002", "w"):
        pass
    assert content(table.read()) == {"a": 1}
    table.upsert(pairs(spark, b=2), "k")
    assert content(table.read()) == {"a": 1, "b": 2}


def test_overwrite_replaces_the_schema(spark, table):
    table.overwrite(pairs(spark, a=1))
    table.overwrite(spark.createDataFrame([("x",)], "other string"))
    assert table.read().columns == ["other"]


def test_a_table_can_be_overwritten_from_itself(spark, table):
    table.overwrite(pairs(spark, a=1, b=2))
    table.overwrite(table.read().filter("k = 'b'"))
    assert content(table.read()) == {"b": 2}


def test_new_columns_are_added(spark, table):
    table.upsert(pairs(spark, a=1, b=1), "k")
    table.upsert(pairs(spark, b=2).withColumn("extra", F.lit("x")), "k")
    assert {tuple(r) for r in table.read().select("k", "v", "extra").collect()} == {("a", 1, None), ("b", 2, "x")}


def test_late_and_corrected_batches_are_loaded(spark, tmp_path, table):
    path = str(tmp_path / "bronze")

    def load(batch_id, **amounts):
        rows = [{"tx_id": k, "amount_usd": v} for k, v in amounts.items()]
        append_batch(bronze(spark, rows), path, batch_id, "core")
        load_new_batches(spark, path, table)
        return {(r.tx_id, r.amount_usd, r.batch_id) for r in table.read().collect()}

    load("b1", a=1.0, b=1.0)
    load("b3", b=3.0, c=3.0)
    late = load("b2", a=2.0, b=2.0)
    assert late == {("a", 2.0, "b2"), ("b", 3.0, "b3"), ("c", 3.0, "b3")}
    assert load("b3", d=4.0) == {("a", 2.0, "b2"), ("b", 2.0, "b2"), ("d", 4.0, "b3")}


def test_batches_append_and_prune(spark, tmp_path):
    path = str(tmp_path / "bronze")
    append_batch(pairs(spark, a=1), path, "b1", "core")
    append_batch(pairs(spark, b=2), path, "b2", "branch")
    append_batch(pairs(spark, b=3), path, "b2", "branch")  # a rerun replaces its own batch
    append_batch(pairs(spark, c=4).withColumn("extra", F.lit(1)), path, "b3", "core")
    everything = read_batches(spark, path)
    assert content(everything) == {"a": 1, "b": 3, "c": 4} and "extra" in everything.columns
    fresh = read_batches(spark, path, after="b1")
    assert {(r.batch_id, r.source_system) for r in fresh.collect()} == {("b2", "branch"), ("b3", "core")}
    assert "PartitionFilters: [isnotnull(batch_id" in executed_plan(fresh)


def test_only_new_batches_are_loaded(spark, tmp_path, table):
    path = str(tmp_path / "bronze")
    append_batch(bronze(spark, [{"tx_id": "1"}, {"tx_id": "2"}]), path, "b1", "core")
    load_new_batches(spark, path, table)
    assert table.mark() == "b1"
    append_batch(bronze(spark, [{"tx_id": "2", "amount_usd": 9.0}, {"tx_id": "3"}]), path, "b2", "core")
    load_new_batches(spark, path, table)
    load_new_batches(spark, path, table)  # nothing new
    got = {(r.tx_id, r.amount_usd, r.batch_id) for r in table.read().collect()}
    assert got == {("1", 1.0, "b1"), ("2", 9.0, "b2"), ("3", 1.0, "b2")} and table.mark() == "b2"


def test_partitioned_layout_prunes(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(100).select((F.col("id") % 5).alias("day"), (F.col("id") % 2).alias("channel"), "id")
    write_partitioned(rows, path, ["day", "channel"])
    some = spark.read.parquet(path).filter("day = 3 AND channel = 1")
    plan = executed_plan(some)
    assert some.count() == 10 and "PartitionFilters: [isnotnull(day" in plan


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    path = tmp_path / "hot"
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64KB")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("day"), F.rand(1).alias("x"))
        write_partitioned(rows, str(path), ["day"])
    finally:
        spark.conf.unset(size)
    assert len(list(path.glob("day=hot/*.parquet"))) > 1
    assert spark.read.parquet(str(path)).count() == 200_000


def test_partition_upsert_equals_plain_upsert(spark, tmp_path, table):
    def rows(*values):
        return spark.createDataFrame(values, "k string, v int, day string")

    before = rows(("stays", 1, "d1"), ("moves", 1, "d 1/%"), ("same", 1, "d2"), ("undated", 1, None), ("far", 1, "2026-01-01"))
    source = rows(("moves", 2, "d2"), ("same", 2, "d2"), ("new", 2, "d3"), ("undated", 2, "d1"))
    parts = PartitionedTable(spark, str(tmp_path / "parts"), "day")
    assert not parts.exists()
    parts.upsert(before, "k")
    table.overwrite(before)
    first = parts._live()["parts"]
    for _ in range(2):
        parts.upsert(source, "k")
        table.upsert(source, "k")
        got, columns = parts.read(), ["k", "v", "day"]
        assert set(got.select(columns).collect()) == set(table.read().select(columns).collect())
        assert dict(got.dtypes) == {"k": "string", "v": "int", "day": "string"}
    live = parts._live()["parts"]
    assert live["day=2026-01-01"] == first["day=2026-01-01"]  # untouched, shared
    assert live["day=d2"] != first["day=d2"]
    assert set(live) == {"day=2026-01-01", "day=d1", "day=d2", "day=d3"}  # two are empty now


def test_partitioned_table_takes_new_columns_and_prunes(spark, tmp_path):
    parts = PartitionedTable(spark, str(tmp_path / "parts"), "day")
    parts.overwrite(spark.createDataFrame([("a", 1), ("b", 2)], "k string, day int"))
    parts.upsert(spark.createDataFrame([("c", 3, "x")], "k string, day int, extra string"), "k")
    assert {tuple(r) for r in parts.read().select("k", "day", "extra").collect()} == {("a", 1, None), ("b", 2, None), ("c", 3, "x")}
    assert "PartitionFilters: [isnotnull(day" in executed_plan(parts.read().filter("day = 3"))
    with pytest.raises(RepeatedKeyError):
        parts.upsert(spark.createDataFrame([("a", 1), ("a", 2)], "k string, day int"), "k")
    parts.overwrite(parts.read().limit(0))
    assert parts.exists() and parts.read().count() == 0


def test_layers_end_to_end(spark, tmp_path):
    def at(name):
        return VersionedTable(spark, str(tmp_path / name))

    raw = bronze(
        spark,
        [{"tx_id": f"t{i}", "origin": f"c{i % 20}", "destination": "shop", "amount_usd": 10.0 + i} for i in range(200)]
        + [{"tx_id": f"big{i}", "origin": "c0", "destination": "x", "channel": "Deposito_Efectivo", "amount_usd": 2900.0} for i in range(3)],
    )
    people = customers(spark, [(f"c{i}", 2000.0) for i in range(20)])
    refresh_silver(raw, people, at("tx"), at("people"))
    refresh_silver(raw, people, at("tx"), at("people"))
    silver = at("tx").read()
    assert silver.count() == 203 and silver.columns == [PUBLISHED[c] for c in SILVER_COLUMNS]
    assert at("people").read().columns == [PUBLISHED[c] for c in CUSTOMERS.fieldNames()]
    at("tx").as_view("transacciones")
    sums = "SELECT count(*) AS n, max(Monto_USD) AS top FROM transacciones WHERE Fecha_Transaccion >= DATE '2026-08-01'"
    assert tuple(spark.sql(sums).first()) == (203, 2900.0)
    again = [VersionedTable(spark, str(tmp_path / f"published-{n}")) for n in ("tx", "people")]
    refresh_silver(publish(raw), publish(people), *again)
    assert sorted(again[0].read().collect()) == sorted(silver.collect())
    with pytest.raises(ValueError, match="PK_Cliente"):
        refresh_silver(raw, people.drop("customer_id"), *again)
    cfg = MonitorConfig(model=ModelConfig(trees=20))
    refresh_gold(at("tx"), at("people"), at("profiles"), at("alerts"), cfg)
    profiles, found = at("profiles").read(), at("alerts").read()
    assert profiles.columns == [PUBLISHED[c] for c in PROFILE_COLUMNS] and len(profiles.columns) == 32
    assert found.columns == [PUBLISHED[c] for c in ALERT_COLUMNS] and len(found.columns) == 22
    assert profiles.count() == 20
    top = profiles.orderBy(F.desc("ML_Anomaly_Score")).first()
    assert top.PK_Cliente == "c0" and top.ML_Anomaly_Score == 100.0
    alerted = {r.PK_Cliente for r in profiles.filter("AML_Risk_Score >= 40").collect()}
    assert {r.FK_Cliente_Origen for r in found.collect()} == alerted
    at("profiles").as_view("gold_perfiles_riesgo_cliente")
    (busiest,) = spark.sql(
        "SELECT PK_Cliente, Total_Movido FROM gold_perfiles_riesgo_cliente ORDER BY Total_Movido DESC LIMIT 1"
    ).collect()
    assert busiest.PK_Cliente == "c0"


def test_a_cluster_must_name_its_shared_folder(spark):
    def session(master, folder):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=context)

    assert shared_folder(session("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    assert shared_folder(session("local[2]", None))
    with pytest.raises(RuntimeError):
        shared_folder(session("yarn", None))


def test_batch_ids_stay_text(spark, tmp_path):
    path = str(tmp_path / "batches")
    for i, name in enumerate(("009", "010", "011")):
        append_batch(pairs(spark, **{f"k{i}": i}), path, name, "core")
    assert {r.batch_id for r in read_batches(spark, path).collect()} == {"009", "010", "011"}
    assert {r.batch_id for r in read_batches(spark, path, after="009").collect()} == {"010", "011"}


def test_an_empty_rerun_empties_its_batch(spark, tmp_path):
    path = str(tmp_path / "batches")
    append_batch(pairs(spark, a=1), path, "b=1", "core")
    append_batch(pairs(spark, b=2), path, "b2", "core")
    append_batch(pairs(spark, a=1).where("false"), path, "b=1", "core")
    assert [r.batch_id for r in read_batches(spark, path).collect()] == ["b2"]


def test_an_upsert_writes_the_source_once(spark, table):
    table.overwrite(pairs(spark, a=1, b=1))
    written = []
    write = VersionedTable._write
    table._write = lambda df: written.append((path := write(table, df), spark.read.parquet(path).count())) or path
    table.upsert(pairs(spark, b=2, c=2, d=2), "k")
    assert [n for _, n in written] == [3, 1]  # the batch, and of the table only what is kept
    assert content(table.read()) == {"a": 1, "b": 2, "c": 2, "d": 2}
    table.upsert(pairs(spark, d=3).withColumn("w", F.lit("x")), "k")
    assert {(r.k, r.v, r.w) for r in table.read().collect()} == {("a", 1, None), ("b", 2, None), ("c", 2, None), ("d", 3, "x")}
    table.upsert(pairs(spark, a=4).withColumn("v", F.col("v").cast("bigint")), "k")  # another type: written together
    assert content(table.read().select("k", "v")) == {"a": 4, "b": 2, "c": 2, "d": 3}
    assert dict(table.read().dtypes)["v"] == "bigint"


def test_an_upsert_shares_folders_that_no_row_goes_from(spark, table, monkeypatch):
    table.upsert(pairs(spark, a=1, b=1), "k")
    table.upsert(pairs(spark, c=1), "k")
    one, two = table._live()["data"]
    table.upsert(pairs(spark, b=2).withColumn("w", F.lit("x")), "k")
    data = table._live()["data"]
    assert two in data and one not in data and len(data) == 3
    assert {(r.k, r.v, r.w) for r in table.read().collect()} == {("a", 1, None), ("b", 2, "x"), ("c", 1, None)}
    table.upsert(pairs(spark, d=1), "k", gone=F.col("w") == "x", beaten=F.col("v") > 1)
    assert data[0] in table._live()["data"] and content(table.read().select("k", "v")) == {"a": 1, "c": 1, "d": 1}
    monkeypatch.setattr(tables, "MOST_FOLDERS", 3)
    table.upsert(pairs(spark, a=5), "k", beaten=F.col("v") < 5)
    assert len(table._live()["data"]) == 2  # what was kept of all folders, and the batch
    assert content(table.read().select("k", "v")) == {"a": 5, "c": 1, "d": 1}


def test_gone_rows_leave_a_partitioned_table(spark, tmp_path):
    parts = PartitionedTable(spark, str(tmp_path / "parts"), "v")
    parts.overwrite(pairs(spark, a=1, b=1, c=2, d=3))
    parts.upsert(pairs(spark, e=4), "k", gone=F.col("k").isin("b", "d"))
    assert content(parts.read()) == {"a": 1, "c": 2, "e": 4}


def shuffle_files(spark) -> int:
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().toList()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_writes_give_their_shuffle_files_back(spark, tmp_path, table):
    def write(df, n):
        append_batch(df, str(tmp_path / "bronze"), str(n), "core")
        table.overwrite(df)
        with lent(df, "for-now") as written:
            assert len(written.collect()) == 7

    before, files = spark.conf.get(SHUFFLE_CLEANUP), shuffle_files(spark)
    for n in range(3):
        write(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), n)
    until = time.time() + 20  # executors are told, not waited for
    while shuffle_files(spark) > files and time.time() < until:
        time.sleep(0.1)
    assert shuffle_files(spark) <= files and spark.conf.get(SHUFFLE_CLEANUP) == before


def test_a_load_leaves_no_temporary_table(spark, tmp_path, table):
    path, shared = str(tmp_path / "bronze"), os.path.join(shared_folder(spark).removeprefix("file:"), "vigiltx")
    os.makedirs(shared, exist_ok=True)
    before = set(os.listdir(shared))
    for batch_id, ids in (("2", "ab"), ("1", "bc"), ("1", "cd")):
        append_batch(bronze(spark, [{"tx_id": k} for k in ids]), path, batch_id, "core")
        load_new_batches(spark, path, table)
    table.upsert(table.read(), "tx_id", newest_by="batch_id")
    assert set(os.listdir(shared)) == before
    with pytest.raises(RuntimeError), lent(table.read(), "for-now"):
        assert set(os.listdir(shared)) != before
        raise RuntimeError
    assert set(os.listdir(shared)) == before


def test_a_late_batch_does_not_read_the_others(spark, tmp_path, table):
    path = str(tmp_path / "bronze")
    for batch_id, ids in (("1", "ab"), ("4", "bc")):
        append_batch(bronze(spark, [{"tx_id": k} for k in ids]).coalesce(1), path, batch_id, "core")
        load_new_batches(spark, path, table)
    for file in (tmp_path / "bronze").glob("*/*.parquet"):
        at = file.stat()
        file.write_bytes(b"?" * at.st_size)  # as large and as old, so the batch counts as loaded
        os.utime(file, ns=(at.st_atime_ns, at.st_mtime_ns))
    append_batch(bronze(spark, [{"tx_id": k} for k in "abd"]), path, "3", "core")
    load_new_batches(spark, path, table)
    assert {(r.tx_id, r.batch_id) for r in table.read().collect()} == {("a", "3"), ("b", "4"), ("c", "4"), ("d", "3")}


@pytest.mark.parametrize("seed", range(3))
def test_batches_late_corrected_and_gone_give_what_one_load_gives(spark, tmp_path, table, seed):
    path, draw = str(tmp_path / "bronze"), random.Random(seed)
    # Empty amounts are unusable rows, which must not hide those of older batches.
    for step in range(7):
        for batch_id in draw.sample("12345", draw.choice((1, 1, 2))):
            if draw.random() < 0.25:
                shutil.rmtree(f"{path}/batch_id={batch_id}", ignore_errors=True)
                continue
            keys = [draw.choice("abcdefgh") for _ in range(draw.randint(0, 6))]
            rows = [{"tx_id": k, "amount_usd": draw.choice((1.0, 2.0, 3.0, None))} for k in [*keys, "a", None]]
            append_batch(bronze(spark, rows), path, batch_id, f"run {step}")
        load_new_batches(spark, path, table)
        if os.path.exists(path) and os.listdir(path):
            whole = VersionedTable(spark, str(tmp_path / f"whole-{step}"))
            load_new_batches(spark, path, whole)
            rows, want = (
                sorted((r.tx_id, r.amount_usd, r.batch_id, r.source_system) for r in t.read().collect()) for t in (table, whole)
            )
            assert rows == want


def test_rows_that_no_load_put_there_are_taken_anew(spark, tmp_path, table):
    path = str(tmp_path / "bronze")
    append_batch(bronze(spark, [{"tx_id": "a"}, {"tx_id": "b"}]), path, "2", "core")
    load_new_batches(spark, path, table)
    by_hand = table.read().withColumn("amount_usd", F.lit(9.0)).withColumn("batch_id", F.lit(None).cast("string"))
    table.upsert(by_hand.unionByName(by_hand.filter("tx_id = 'a'").withColumn("tx_id", F.lit("c"))), "tx_id")
    append_batch(bronze(spark, [{"tx_id": "a", "amount_usd": 5.0}]), path, "1", "core")
    load_new_batches(spark, path, table)
    got = {(r.tx_id, r.amount_usd, r.batch_id) for r in table.read().collect()}
    assert got == {("a", 1.0, "2"), ("b", 9.0, None), ("c", 9.0, None)}
