import pytest
from builders import bronze, by_key, customers
from conftest import executed_plan
from pyspark.sql import functions as F

from vigiltx.operators import clean
from vigiltx.operators.clean import clean_customers, clean_stored, clean_transactions, repeated_keys
from vigiltx.schema import CUSTOMERS, adopt, publish


def test_unusable_rows_go(spark):
    rows = [
        {"tx_id": None},
        {"tx_id": "null", "amount_usd": None},
        {"tx_id": "zero", "amount_usd": 0.0},
        {"tx_id": "minus", "amount_usd": -1.0},
        {"tx_id": "tiny", "amount_usd": 0.004},
        {"tx_id": "cent", "amount_usd": 0.005},
    ]
    kept = clean_transactions(bronze(spark, rows)).collect()
    assert [(r.tx_id, r.amount_usd) for r in kept] == [("cent", 0.01)]


def test_one_row_per_key_whatever_the_order(spark):
    rows = [
        {"tx_id": "k", "time_text": "2026-09-01 12:00:01"},
        {"tx_id": "k", "time_text": "01/09/2026 12:00:00", "amount_usd": 5.0},
        {"tx_id": "k", "time_text": "2026-09-01 12:00:00", "amount_usd": 4.0},
        {"tx_id": "k", "time_text": "never", "amount_usd": 3.0},
    ]
    for arrangement in (rows, rows[::-1], rows[2:] + rows[:2]):
        for parts in (1, 4, 16):
            (row,) = clean_transactions(bronze(spark, arrangement).repartition(parts)).collect()
            assert (row.amount_usd, row.tx_time) == (4.0, "12:00:00")


@pytest.mark.parametrize(
    "text, date, time",
    [
        ("2026-01-05 03:04:05", "2026-01-05", "03:04:05"),
        ("05/01/2026 03:04:05", "2026-01-05", "03:04:05"),
        ("5/1/2026 3:04:05", None, None),
        ("2026-01-05", None, None),
        ("31/02/2026 00:00:00", None, None),
        (None, None, None),
    ],
)
def test_time_formats(spark, text, date, time):
    (row,) = clean_transactions(bronze(spark, [{"time_text": text}])).collect()
    assert (row.tx_date and str(row.tx_date), row.tx_time) == (date, time)


@pytest.mark.parametrize(
    "raw, clean", [(" a ", "a"), ("\ta\t", "\ta\t"), (" Exchange_Crypto ", "Exchange_Crypto")]
)
def test_channel_is_trimmed_of_spaces_only(spark, raw, clean):
    (row,) = clean_transactions(bronze(spark, [{"channel": raw, "geography": raw}])).collect()
    assert (row.channel, row.geography) == (clean, raw)


@pytest.mark.parametrize(
    "raw, clean",
    [("usd", "USD"), (" UDS ", "UDS"), ("US $", "US $"), ("soles", "SOLES"), ("rmb ", "RMB")],
)
def test_currency_spelling(spark, raw, clean):
    (row,) = clean_transactions(bronze(spark, [{"currency": raw}])).collect()
    assert row.currency == clean


def test_customers(spark):
    rows = [(None, 1, "x", 1.0), ("c", 40, " b ", 2.0), ("c", 30, " a ", 1.0)]
    cleaned = by_key(clean_customers(spark.createDataFrame(rows, CUSTOMERS)))
    assert cleaned == {"c": {"customer_id": "c", "age": 30, "occupation": "a", "monthly_income": 1.0}}


def test_extra_columns_pass_through(spark):
    raw = bronze(spark, [{}]).withColumn("batch_id", F.lit("b1"))
    assert clean_transactions(raw).columns[-1] == "batch_id"
    assert "batch_id" in clean_customers(customers(spark, [("c", 1.0)]).withColumn("batch_id", F.lit("b"))).columns


def test_hot_key_is_cut_before_the_shuffle(spark):
    rows = bronze(spark, [{}]).crossJoin(spark.range(5000)).drop("id")
    cleaned = clean_transactions(rows)
    plan = executed_plan(cleaned)
    before_shuffle = plan.split("Exchange hashpartitioning(tx_id")[1]
    assert "WindowGroupLimit" in before_shuffle
    assert cleaned.count() == 1


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_stored_rows_are_cleaned_alike_and_lone_ones_not_shuffled(spark, tmp_path, monkeypatch, words):
    monkeypatch.setattr(clean, "KEY_WORDS", words)
    rows = [{"tx_id": f"k{i % 450}", "amount_usd": i + 1.0} for i in range(500)]
    rows += [{"tx_id": None}, {"tx_id": "k449", "amount_usd": None}, {"tx_id": "void", "amount_usd": 0.0}]
    made = bronze(spark, rows).withColumn("batch_id", F.when(F.col("amount_usd") % 2 == 0, "2").otherwise("1"))
    made.repartition(5).write.parquet(str(tmp_path / "bronze"))
    stored = spark.read.parquet(str(tmp_path / "bronze"))
    bits = repeated_keys(stored).persist()
    got, want = clean_stored(stored, bits, "batch_id"), clean_transactions(stored, "batch_id")
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 450
    met = F.coalesce(F.col("_bits").bitwiseAND(clean._bit(clean._hashed())), F.lit(0).cast("long")) != 0
    marked = stored.join(bits, clean._word(clean._hashed()) == F.col("_word"), "left")
    shuffled = [r.tx_id for r in marked.filter(met).filter("amount_usd > 0").collect()]
    assert set(shuffled) >= {f"k{i}" for i in range(50)} and (len(shuffled) == 100 or words == 1)


def test_published_names_round_trip(spark):
    clean = clean_transactions(bronze(spark, [{}]))
    published = publish(clean.drop("tx_ts"))
    assert published.columns[0] == "PK_Transaccion" and "Hora_Transaccion" in published.columns
    assert adopt(published).select(*clean.columns).collect() == clean.collect()
