"""Figures, subjects and text lines of the compliance report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Typology:
    flag: str
    columns: tuple[str, ...]


TYPOLOGIES = {
    "fan_in": Typology("flag_fan_in", ("received_count", "sent_total", "moved_income_ratio")),
    "crypto": Typology("flag_crypto", ("sent_total", "crypto_ratio", "crypto_count")),
    "structuring": Typology("flag_structuring", ("sent_count", "sent_total")),
}

# The report's wording. %s are filled with already formatted numbers.
HEADLINE = (
    "En el último barrido de monitoreo transaccional se analizó un universo de %s operaciones "
    "financieras consolidadas, correspondientes a una cartera de %s clientes activos. Tras "
    "aplicar la matriz de riesgo y reglas heurísticas de detección en %s, el sistema ha "
    "emitido %s alertas confirmadas de alto riesgo."
)
FAN_IN_LINE = "- Concentración de Fondos (Fan-In): %s alertas."
CRYPTO_LINE = "- Ofuscación con Criptoactivos (Crypto Mixers): %s alertas."
STRUCTURING_LINE = "- Estructuración (Pitufeo/Structuring): %s alertas."
FAN_IN_SUBJECT = "- Sujeto ID: %s (Fan-In)"
CRYPTO_SUBJECT = "- Sujeto ID: %s (Crypto Mixer)"
STRUCTURING_SUBJECT = "- Sujeto ID: %s (Estructuración)"
FAN_IN_NOTE = (
    "Recibió %s transferencias, luego envió un total de USD %s con una relación de "
    "ingresos/operado de %s."
)
CRYPTO_NOTE = (
    "Canalizó USD %s a exchanges, representando el %s%% de sus transferencias de salida en "
    "%s envíos."
)
STRUCTURING_NOTE = (
    "Generó %s transacciones de salida totalizando USD %s, todas por montos menores a USD 3,000."
)


def summary(tx: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row: transactions, customers, alerts per typology and their total.

    Income deviation is not an alert of this report. The two tables' figures are
    stacked and added up, which needs no join.
    """
    counted = tx.agg(F.count("*").alias("total_tx"))
    figures = profiles.agg(
        F.count("*").alias("total_customers"),
        F.sum("flag_structuring").alias("structuring_alerts"),
        F.sum("flag_fan_in").alias("fan_in_alerts"),
        F.sum("flag_crypto").alias("crypto_alerts"),
    )
    stacked = counted.unionByName(figures, allowMissingColumns=True)
    return stacked.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in stacked.columns]
    ).withColumn(
        "total_alerts",
        F.col("structuring_alerts") + F.col("fan_in_alerts") + F.col("crypto_alerts"),
    )


def top_subjects(profiles: DataFrame) -> DataFrame:
    """The flagged customer of each typology that moved most; ties go to the lower id.

    One pass: per typology the least (-moved, id) is kept, so tasks pass on one
    candidate each. A typology nobody is flagged for has no row.
    """
    wanted = sorted({c for t in TYPOLOGIES.values() for c in t.columns})

    def best(name: str, typology: Typology) -> Column:
        rank = F.struct(
            (-F.col("total_moved")).alias("minus_moved"),
            F.col("customer_id"),
            F.lit(name).alias("typology"),
            F.col("total_moved"),
            *wanted,
        )
        return F.min(F.when(F.col(typology.flag) == 1, rank)).alias(name)

    found = profiles.agg(*[best(name, t) for name, t in TYPOLOGIES.items()])
    return (
        found.select(F.explode(F.array(*TYPOLOGIES)).alias("s"))
        .filter(F.col("s").isNotNull())
        .select("s.typology", "s.customer_id", "s.total_moved", *[f"s.{c}" for c in wanted])
    )


def top_subject(profiles: DataFrame, typology: str) -> DataFrame:
    """One typology's subject with the columns its sentence needs."""
    t = TYPOLOGIES[typology]
    return (
        profiles.filter(F.col(t.flag) == 1)
        .orderBy(F.desc("total_moved"), "customer_id")
        .limit(1)
        .select("customer_id", *t.columns)
    )


def _grouped(number: Column, decimals: int = 0) -> Column:
    return F.format_number(number, decimals)


def _plain(number: Column, pattern: str) -> Column:
    # A pattern without digit grouping; both forms round the exact value half to even.
    return F.call_function("format_number", number, F.lit(pattern))


def _lines(df: DataFrame, lines: list[tuple[str, Column, Column]]) -> DataFrame:
    rows = [
        F.struct(F.lit(section).alias("section"), place.alias("place"), text.alias("line"))
        for section, place, text in lines
    ]
    return df.select(F.explode(F.array(*rows)).alias("l")).select("l.*")


def report_lines(tx: DataFrame, profiles: DataFrame, platform: str = "Spark") -> DataFrame:
    """(section, place, line): headline, distribution, subjects. A missing subject has no line.

    ``platform`` is what the headline says the rules ran on.
    """
    def count_of(name: str) -> Column:
        return F.col(name).cast("string")

    headline = F.format_string(
        HEADLINE,
        _grouped(F.col("total_tx")),
        _grouped(F.col("total_customers")),
        F.lit(platform),
        _grouped(F.col("total_alerts")),
    )
    figures = _lines(
        summary(tx, profiles),
        [
            ("summary", F.lit(1), headline),
            ("distribution", F.lit(1), F.format_string(FAN_IN_LINE, count_of("fan_in_alerts"))),
            ("distribution", F.lit(2), F.format_string(CRYPTO_LINE, count_of("crypto_alerts"))),
            (
                "distribution",
                F.lit(3),
                F.format_string(STRUCTURING_LINE, count_of("structuring_alerts")),
            ),
        ],
    )
    who, sent = F.col("customer_id"), _grouped(F.col("sent_total"), 2)

    def by_typology(fan_in: Column, crypto: Column, structuring: Column) -> Column:
        kind = F.col("typology")
        return (
            F.when(kind == "fan_in", fan_in).when(kind == "crypto", crypto).otherwise(structuring)
        )

    title = by_typology(
        F.format_string(FAN_IN_SUBJECT, who),
        F.format_string(CRYPTO_SUBJECT, who),
        F.format_string(STRUCTURING_SUBJECT, who),
    )
    note = by_typology(
        F.format_string(
            FAN_IN_NOTE,
            _plain(F.col("received_count"), "0"),
            sent,
            _plain(F.col("moved_income_ratio"), "0.00"),
        ),
        F.format_string(
            CRYPTO_NOTE,
            sent,
            _plain(F.col("crypto_ratio") * 100, "0.0"),
            _plain(F.col("crypto_count"), "0"),
        ),
        F.format_string(STRUCTURING_NOTE, _plain(F.col("sent_count"), "0"), sent),
    )
    place = by_typology(F.lit(1), F.lit(3), F.lit(5))
    subjects = _lines(
        top_subjects(profiles), [("subjects", place, title), ("subjects", place + 1, note)]
    )
    return figures.unionByName(subjects)
