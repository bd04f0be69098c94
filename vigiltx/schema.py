"""Table layouts.

Inside the package columns carry English names. ``publish`` and ``adopt``
translate whole tables to and from the published column names, so SQL written
against the published tables keeps working.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BRONZE_TRANSACTIONS = T.StructType(
    [
        T.StructField("tx_id", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("time_text", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("geography", T.StringType()),
        T.StructField("amount_original", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("amount_usd", T.DoubleType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("age", T.LongType()),
        T.StructField("occupation", T.StringType()),
        T.StructField("monthly_income", T.DoubleType()),
    ]
)

# Silver also keeps tx_ts, the parsed event time; it is not published.
SILVER_COLUMNS = [
    "tx_id", "origin", "destination", "channel", "geography",
    "amount_original", "currency", "amount_usd", "tx_date", "tx_time",
]

SENT_COLUMNS = [
    "sent_count", "sent_total", "sent_avg", "sent_max", "sent_std",
    "unique_receivers", "cash_count", "crypto_count", "platform_count",
]
RECEIVED_COLUMNS = [
    "received_count", "received_total", "received_avg", "received_max", "unique_senders",
]
RATIO_COLUMNS = [
    "total_moved", "out_in_ratio", "moved_income_ratio", "fan_in_index", "crypto_ratio",
]
FLAG_COLUMNS = ["flag_structuring", "flag_fan_in", "flag_crypto", "flag_kyc"]

FEATURE_COLUMNS = CUSTOMERS.fieldNames() + SENT_COLUMNS + RECEIVED_COLUMNS + RATIO_COLUMNS
PROFILE_COLUMNS = (
    FEATURE_COLUMNS
    + ["ml_score", "ml_outlier"]
    + FLAG_COLUMNS
    + ["rule_score", "risk_score", "risk_level"]
)
ALERT_COLUMNS = (
    SILVER_COLUMNS
    + ["customer_id", "risk_score", "risk_level", "ml_score", "rule_score"]
    + FLAG_COLUMNS
    + ["age", "occupation", "monthly_income"]
)

# The columns the anomaly model sees.
MODEL_COLUMNS = [
    c
    for c in SENT_COLUMNS + RECEIVED_COLUMNS + RATIO_COLUMNS
    if c not in ("received_avg", "received_max", "total_moved")
]

# The published column names.
PUBLISHED = {
    "customer_id": "PK_Cliente",
    "age": "Edad",
    "occupation": "Ocupacion_Declarada",
    "monthly_income": "Ingreso_Mensual_Aprox",
    "tx_id": "PK_Transaccion",
    "origin": "FK_Cliente_Origen",
    "destination": "FK_Cliente_Destino",
    "time_text": "FK_Tiempo",
    "channel": "FK_Canal",
    "geography": "FK_Geografia",
    "amount_original": "Monto_Original",
    "currency": "Moneda",
    "amount_usd": "Monto_USD",
    "tx_date": "Fecha_Transaccion",
    "tx_time": "Hora_Transaccion",
    "sent_count": "Total_Tx_Enviadas",
    "sent_total": "Monto_Total_Enviado_USD",
    "sent_avg": "Monto_Promedio_Enviado_USD",
    "sent_max": "Monto_Max_Enviado_USD",
    "sent_std": "Monto_Std_Enviado_USD",
    "unique_receivers": "Destinatarios_Unicos",
    "cash_count": "Tx_Canal_Efectivo_ATM",
    "crypto_count": "Tx_Canal_Crypto",
    "platform_count": "Tx_Canal_Plataformas",
    "received_count": "Total_Tx_Recibidas",
    "received_total": "Monto_Total_Recibido_USD",
    "received_avg": "Monto_Promedio_Recibido_USD",
    "received_max": "Monto_Max_Recibido_USD",
    "unique_senders": "Remitentes_Unicos",
    "total_moved": "Total_Movido",
    "out_in_ratio": "Ratio_Salida_vs_Entrada",
    "moved_income_ratio": "Ratio_Operado_vs_Ingreso_Declarado",
    "fan_in_index": "Indice_Fan_In",
    "crypto_ratio": "Ratio_Tx_Crypto",
    "ml_score": "ML_Anomaly_Score",
    "ml_outlier": "ML_Is_Outlier",
    "flag_structuring": "Flag_Structuring_Pitufeo",
    "flag_fan_in": "Flag_Fan_In_Plataforma",
    "flag_crypto": "Flag_Crypto_Mixer",
    "flag_kyc": "Flag_Desvio_KYC",
    "rule_score": "Rule_Risk_Score",
    "risk_score": "AML_Risk_Score",
    "risk_level": "Nivel_Riesgo_AML",
}


def publish(df: DataFrame) -> DataFrame:
    """Give every known column its published name; others keep theirs."""
    return df.withColumnsRenamed({k: v for k, v in PUBLISHED.items() if k in df.columns})


def adopt(df: DataFrame) -> DataFrame:
    """Inverse of ``publish``; a published silver table also regains ``tx_ts``."""
    own = df.withColumnsRenamed({v: k for k, v in PUBLISHED.items() if v in df.columns})
    if "tx_time" in own.columns and "tx_ts" not in own.columns:
        own = own.withColumn("tx_ts", event_time(F.col("tx_date"), F.col("tx_time")))
    return own


def adopt_bronze(df: DataFrame, key: str = "tx_id") -> DataFrame:
    """``adopt`` for raw tables; one without its key column is an error, not an empty load."""
    own = adopt(df)
    if key not in own.columns:
        raise ValueError(f"no column {PUBLISHED[key]} or {key} among {', '.join(df.columns)}")
    return own


def event_time(date: Column, time: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit("yyyy-MM-dd HH:mm:ss"))
