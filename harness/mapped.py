"""The test tables seen as bronze tables (the mapping FIXTURES.md describes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigiltx.functions.money import exchanged, with_round2
from vigiltx.operators.clean import clean_customers, clean_transactions
from vigiltx.schema import BRONZE_TRANSACTIONS, CUSTOMERS

CURRENCIES = ("USD", "PEN", "EUR", "GBP", "JPY", "CNY")
ISO, SLASH = "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def bronze_transactions(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    customer = F.concat(F.lit("C"), F.col("o_custkey"))
    supplier = F.concat(F.lit("S"), F.col("l_suppkey"))
    refund = F.col("l_returnflag") == "R"
    priority = F.substring("o_orderpriority", 1, 1)
    noise = F.pmod(F.col("l_partkey"), F.lit(80))
    second = F.pmod(F.col("l_partkey") * 37 + F.col("l_suppkey") * 11, F.lit(86400)).cast("int")
    clean_currency = F.element_at(
        F.array(*map(F.lit, CURRENCIES)), (F.pmod("l_suppkey", F.lit(6)) + 1).cast("int")
    )
    usd = F.col("l_extendedprice") / 50.0
    # Copies of the row: 0 itself, 1 without key, 2 one second later.
    copies = (
        F.when(noise == 2, F.array(F.lit(0), F.lit(1)))
        .when(noise == 3, F.array(F.lit(0), F.lit(2)))
        .otherwise(F.array(F.lit(0)))
    )
    seconds = F.make_dt_interval(secs=second + F.when(F.col("copy") == 2, 1).otherwise(0))
    at = F.col("l_shipdate").cast("timestamp") + seconds
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return (
        with_round2(joined, "in_currency", exchanged(usd, clean_currency))  # below explode, so once for all copies
        .withColumn("copy", F.explode(copies))
        .select(
            F.when(F.col("copy") != 1, F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("tx_id"),
            F.when(refund, supplier).otherwise(customer).alias("origin"),
            F.when(refund, customer).otherwise(supplier).alias("destination"),
            F.when(noise == 0, F.date_format(at, SLASH)).otherwise(F.date_format(at, ISO)).alias("time_text"),
            F.when(priority == "1", " Cajero_Automatico")
            .when(priority == "2", "Exchange_Crypto ")
            .when(priority == "3", "Plataforma_Terceros")
            .otherwise("Transferencia_Bancaria")
            .alias("channel"),
            F.when(F.col("l_linestatus") == "F", "Local").otherwise("Internacional").alias("geography"),
            F.col("in_currency").alias("amount_original"),
            F.when(noise == 1, " uds ").otherwise(clean_currency).alias("currency"),
            usd.alias("amount_usd"),
        )
        .select(*BRONZE_TRANSACTIONS.fieldNames())
    )


def bronze_customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey")).alias("customer_id"),
        (F.lit(18) + F.pmod(F.col("c_custkey"), F.lit(53))).cast("bigint").alias("age"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("occupation"),
        F.col("c_acctbal").alias("monthly_income"),
    ).select(*CUSTOMERS.fieldNames())


def silver_transactions(spark: SparkSession, sf: str) -> DataFrame:
    return clean_transactions(bronze_transactions(spark, sf))


def silver_customers(spark: SparkSession, sf: str) -> DataFrame:
    return clean_customers(bronze_customers(spark, sf))
