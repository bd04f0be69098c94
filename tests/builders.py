"""Hand-made rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from vigiltx.schema import BRONZE_TRANSACTIONS, CUSTOMERS

NOON = datetime(2026, 9, 1, 12, 0, 0)


def bronze(spark, rows):
    """Rows as dicts; anything not given gets a plain value."""
    plain = {
        "tx_id": "t", "origin": "a", "destination": "b", "time_text": "2026-09-01 12:00:00",
        "channel": "Tarjeta_Credito", "geography": "Local", "amount_original": 1.0,
        "currency": "USD", "amount_usd": 1.0,
    }
    names = BRONZE_TRANSACTIONS.fieldNames()
    return spark.createDataFrame(
        [tuple({**plain, **row}[n] for n in names) for row in rows], BRONZE_TRANSACTIONS
    )


def silver(spark, rows):
    """Rows (origin, destination, channel, amount, seconds after noon)."""
    schema = "tx_id string, origin string, destination string, channel string, amount_usd double, tx_ts timestamp"
    made = [
        (f"t{i}", origin, destination, channel, float(amount), at if at is None else NOON + timedelta(seconds=at))
        for i, (origin, destination, channel, amount, at) in enumerate(rows)
    ]
    return spark.createDataFrame(made, schema).withColumns(
        {
            "geography": F.lit("Local"),
            "amount_original": F.col("amount_usd"),
            "currency": F.lit("USD"),
            "tx_date": F.to_date("tx_ts"),
            "tx_time": F.date_format("tx_ts", "HH:mm:ss"),
        }
    )


def customers(spark, rows):
    """Rows (customer_id, monthly_income) or full tuples."""
    full = [(r[0], 30, "Profesor", r[1]) if len(r) == 2 else r for r in rows]
    return spark.createDataFrame(full, CUSTOMERS)


def by_key(df, key="customer_id"):
    return {row[key]: row.asDict() for row in df.collect()}
