"""Bronze to silver: drop unusable rows, keep one row per key, normalise text and time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vigiltx.functions.money import amount2
from vigiltx.functions.times import parse_time, time_of_day
from vigiltx.schema import CUSTOMERS, SILVER_COLUMNS

# What rounds to more than 0.00. Compared before rounding, the filter reaches the scan.
SMALLEST_AMOUNT = 0.005
# Of 64 bits each: 8 MB, and a few times that as the table that is broadcast.
KEY_WORDS = 1 << 20


def first_per_key(
    df: DataFrame, key: str, order: list[str], newest_by: str | None = None
) -> DataFrame:
    """One row per key, the largest in ``newest_by``, then the first in ``order`` (NULLs last).

    Ordering by every column makes the survivor the same on every run. Spark cuts
    each task's rows to one per key before the shuffle, so a hot key stays cheap.
    """
    newest = [F.col(newest_by).desc_nulls_last()] if newest_by else []
    w = W.partitionBy(key).orderBy(*newest, *[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_place", F.row_number().over(w)).filter("_place = 1").drop("_place")


def clean_transactions(bronze: DataFrame, newest_by: str | None = None) -> DataFrame:
    """Silver transactions, with ``tx_ts`` kept for the detectors.

    Unreadable times become NULL and the row stays. Extra columns, such as lineage,
    pass through. Of a key's rows those with the largest ``newest_by`` come first.
    """
    usable = _normalised(bronze.filter(_usable()))
    return _dated(first_per_key(usable, "tx_id", _survivor(usable), newest_by))


def repeated_keys(bronze: DataFrame) -> DataFrame:
    """A bitmap of fixed size over hashes of the keys that more than one usable row has."""
    hashes = bronze.filter(_usable()).select(_hashed().alias("_hash"))
    twice = hashes.groupBy("_hash").count().filter("count > 1")
    return twice.groupBy(_word(F.col("_hash")).alias("_word")).agg(F.bit_or(_bit(F.col("_hash"))).alias("_bits"))


def clean_stored(bronze: DataFrame, repeated: DataFrame, newest_by: str | None = None) -> DataFrame:
    """``clean_transactions`` of a stored table, which is read twice, by its ``repeated_keys``.

    Only rows whose key the bitmap takes for repeated are shuffled. With very many such
    keys it fills up, and all rows are.
    """
    hashed = _hashed()
    marked = bronze.filter(_usable()).join(F.broadcast(repeated), _word(hashed) == F.col("_word"), "left")
    met = F.coalesce(F.col("_bits").bitwiseAND(_bit(hashed)), F.lit(0).cast("long")) != 0
    lone, others = (_normalised(marked.filter(which).drop("_word", "_bits")) for which in (~met, met))
    return _dated(lone).unionByName(_dated(first_per_key(others, "tx_id", _survivor(others), newest_by)))


def _hashed() -> Column:
    """40 bits, which shuffle smaller than 64."""
    return F.xxhash64("tx_id").bitwiseAND(F.lit((1 << 40) - 1))


def _word(hashed: Column) -> Column:
    return F.shiftright(hashed, 6).bitwiseAND(F.lit(KEY_WORDS - 1).cast("long"))


def _bit(hashed: Column) -> Column:
    place = hashed.bitwiseAND(F.lit(63).cast("long")).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _usable() -> Column:
    return F.col("tx_id").isNotNull() & (F.col("amount_usd").try_cast("double") >= SMALLEST_AMOUNT)


def _normalised(usable: DataFrame) -> DataFrame:
    return (
        usable.withColumn("amount_original", amount2(F.col("amount_original")))
        .withColumn("amount_usd", amount2(F.col("amount_usd")))
        .withColumn("channel", F.trim("channel"))
        .withColumn("currency", F.upper(F.trim("currency")))
        .withColumn("tx_ts", parse_time(F.col("time_text")))
        .drop("time_text")
    )


def _extra(normalised: DataFrame) -> list[str]:
    return [c for c in normalised.columns if c not in (*SILVER_COLUMNS, "tx_ts")]


def _survivor(normalised: DataFrame) -> list[str]:
    return [
        "tx_ts", "amount_usd", "origin", "destination", "channel", "geography",
        "currency", "amount_original", *_extra(normalised),
    ]


def _dated(one_per_key: DataFrame) -> DataFrame:
    return (
        one_per_key.withColumn("tx_date", F.to_date("tx_ts"))
        .withColumn("tx_time", time_of_day(F.col("tx_ts")))
        .select(*SILVER_COLUMNS, "tx_ts", *_extra(one_per_key))
    )


def clean_customers(bronze: DataFrame) -> DataFrame:
    own = CUSTOMERS.fieldNames()
    extra = [c for c in bronze.columns if c not in own]
    usable = bronze.filter(F.col("customer_id").isNotNull())
    order = [c for c in (*own, *extra) if c != "customer_id"]
    return (
        first_per_key(usable, "customer_id", order)
        .withColumn("occupation", F.trim("occupation"))
        .select(*own, *extra)
    )
