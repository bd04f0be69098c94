"""Column functions for amounts: rounding, exact sums, exact spread, conversion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigiltx.config import RATES

# From here on an amount counts as infinite: a sum of 10^9 amounts below it still fits a decimal.
INFINITE_FROM = 1e27
# Below this, cents come straight from a multiplication that is exact to the cent.
PLAIN_BELOW = float(1 << 44)
# Amounts below this add up in two bigints, the cents above and below FINE bits, which 10^12
# of them cannot overflow; larger ones, as rare as they are, in a decimal.
SMALL_BELOW = float(1 << 36)
FINE = 20
# The columns that a sum of money consists of.
PARTS = ("coarse", "fine", "wide", "odd")
# Cents are split here before they are squared, so that every product of parts fits a decimal.
SQUARED_AT = 10**14


def amount2(text_or_number: Column) -> Column:
    """An amount as a double with two decimals, half up; NULL when not a number."""
    return F.round(text_or_number.try_cast("double"), 2)


def half_even2(x: Column) -> Column:
    """Two decimals by scaling and rounding half to even."""
    return F.rint(x * 100) / 100


def _cents_of(x: Column) -> Column:
    """x, not negative, in whole cents: its exact binary value, half to even.

    x is split into two doubles whose products with 100 are exact, so that the distance
    from the half cent has the right sign, and is zero only where it is zero.
    """
    head = x * 134_217_729.0
    head = head - (head - x)
    tail = x - head
    floor = F.floor(x * 100).cast("double")
    past_half = (head * 100 - (floor + 0.5)) + tail * 100
    odd = floor - 2 * F.floor(floor / 2)
    return floor + F.when(past_half > 0, 1.0).when(past_half < 0, 0.0).otherwise(odd)


def round2(x: Column) -> Column:
    """Two decimals, by the exact binary value and half to even: 1.005 gives 1.0, 0.125 gives 0.12."""
    size = F.abs(x)
    whole = size - size % 1.0
    rounded = F.when(size < PLAIN_BELOW, _cents_of(size) / 100).when(
        size < INFINITE_FROM, whole + _cents_of(size - whole) / 100
    )
    return F.when(size < INFINITE_FROM, F.signum(x) * rounded).otherwise(x)


def cents(amount: Column) -> Column:
    """A finite amount in whole cents, as a decimal that any order of sums keeps exact."""
    whole = amount - amount % 1.0
    high = (whole / 2.0**52) - (whole / 2.0**52) % 1.0
    units = high.cast("bigint") * F.lit(1 << 52).cast("decimal(16,0)") + (
        whole - high * 2.0**52
    ).cast("bigint").cast("decimal(20,0)")
    wide = units * F.lit(100).cast("decimal(3,0)") + F.rint((amount - whole) * 100).cast("bigint")
    plain = F.rint(amount * 100).cast("bigint")
    return (
        F.when(F.abs(amount) < PLAIN_BELOW, plain.cast("decimal(38,0)"))
        .when(F.abs(amount) < INFINITE_FROM, wide.cast("decimal(38,0)"))
    )


def irregular(amount: Column) -> Column:
    """What ``cents`` leaves out: NaN, and infinities by sign. Their sum has no order either."""
    infinite = F.when(F.isnan(amount), amount).otherwise(F.signum(amount) * float("inf"))
    return F.when(~(F.abs(amount) < INFINITE_FROM), infinite)


def _small(amount: Column) -> Column:
    return F.when(F.abs(amount) < SMALL_BELOW, F.rint(amount * 100).cast("bigint"))


def money_parts(amount: Column) -> dict[str, Column]:
    """What to add up, each part for itself and in any order, for an exact sum of amounts."""
    small = _small(amount)
    return {
        "coarse": F.shiftright(small, FINE),
        "fine": small.bitwiseAND(F.lit((1 << FINE) - 1).cast("bigint")),
        "wide": F.when(F.abs(amount) >= SMALL_BELOW, cents(amount)),
        "odd": irregular(amount),
    }


def total_cents(coarse: Column, fine: Column, wide: Column) -> Column:
    """Whole cents from sums of parts; NULL when there was nothing."""
    small = coarse.cast("decimal(20,0)") * F.lit(1 << FINE).cast("decimal(7,0)") + fine
    small = small.cast("decimal(38,0)")
    return F.coalesce((small + F.coalesce(wide, F.lit(0))).cast("decimal(38,0)"), wide)


def dollars(coarse: Column, fine: Column, wide: Column, odd: Column) -> Column:
    """Dollars from sums of parts: rounded once, or the irregular amounts' sum if there are any."""
    total = total_cents(coarse, fine, wide)
    hundred = F.lit(100).cast("decimal(3,0)")
    rest = total % hundred
    whole = ((total - rest) / hundred).cast("decimal(36,0)")
    exact = F.when(F.abs(total) < 1 << 53, total.cast("double") / 100.0).otherwise(
        whole.cast("double") + rest.cast("double") / 100.0
    )
    return F.coalesce(exact + F.coalesce(odd, F.lit(0.0)), odd)


def money_sum(amount: Column) -> Column:
    """Sum of two-decimal amounts: in whole cents, so the same for any row order."""
    return dollars(*map(F.sum, money_parts(amount).values()))


def squared_parts(amount: Column) -> tuple[Column, Column, Column]:
    """The squares of cents as (high, cross, low) with square = high S^2 + 2 cross S + low and
    S = SQUARED_AT; high and cross are NULL where they are zero, as for any common amount."""
    small = _small(amount).cast("decimal(19,0)")
    large = F.when(F.abs(amount) >= SMALL_BELOW, cents(amount))
    split = F.lit(SQUARED_AT).cast("decimal(15,0)")
    rest = (large % split).cast("decimal(15,0)")
    high = F.when(F.abs(large) >= split, ((large - rest) / split).cast("decimal(17,0)"))
    low = F.coalesce((small * small).cast("decimal(38,0)"), (rest * rest).cast("decimal(38,0)"))
    return high * high, high * rest, low


def sample_std(
    n: Column, total: Column, high: Column, cross: Column, low: Column
) -> Column:
    """Sample standard deviation in dollars from exact sums of cents and ``squared_parts``.

    For any integer q and r = total - n*q the squared distances from q add up to
    squares - q*(total + r). With q near the mean nothing cancels in floating point.
    With amounts of 10^12 dollars and more, the exact sums are put together in doubles.
    """
    q = F.floor(total.cast("double") / n).cast("bigint")
    q_exact = q.cast("decimal(18,0)")
    r = (total - n.cast("decimal(19,0)") * q_exact).cast("decimal(38,0)")
    around_q = low - q_exact * (total + r).cast("decimal(38,0)")
    m2 = around_q.cast("double") - r.cast("double") * r.cast("double") / n
    exact = F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1)) / 100.0
    size = float(SQUARED_AT)
    squares = high.cast("double") + 2 * cross.cast("double") / size + low.cast("double") / size**2
    mean = total.cast("double") / size
    wide = F.sqrt(F.greatest(squares - mean * mean / n, F.lit(0.0)) / (n - 1)) * (size / 100.0)
    return F.when(n > 1, F.when(high.isNull(), exact).otherwise(wide))


def exchanged(usd: Column, currency: Column, rates: Mapping[str, float] = RATES) -> Column:
    """Dollars expressed in ``currency``, not rounded; NULL for an unknown currency."""
    table = F.create_map(*[F.lit(v) for pair in rates.items() for v in pair])
    return usd * F.try_element_at(table, currency)


def with_round2(df: DataFrame, name: str, amount: Column) -> DataFrame:
    """``df`` with ``round2`` of ``amount`` as column ``name``, step by step: each value is computed once a row, and the
    code that Spark generates stays small enough to be compiled."""
    x, size, part, floor, head = (F.col(f"_{name}_{step}") for step in ("x", "size", "part", "floor", "head"))
    steps = [
        {"x": amount},
        {"size": F.abs(x)},
        {"part": F.when(size < PLAIN_BELOW, size).otherwise(size % 1.0)},
        {"floor": F.floor(part * 100).cast("double"), "head": part * 134_217_729.0},
        {"head": head - (head - part)},
        {"past": (head * 100 - (floor + 0.5)) + (part - head) * 100},
    ]
    for step in steps:
        df = df.withColumns({f"_{name}_{step_name}": column for step_name, column in step.items()})
    past = F.col(f"_{name}_past")
    cents = floor + F.when(past > 0, 1.0).when(past < 0, 0.0).otherwise(floor - 2 * F.floor(floor / 2))
    rounded = F.when(size < PLAIN_BELOW, cents / 100).otherwise(size - part + cents / 100)
    made = df.withColumn(name, F.when(size < INFINITE_FROM, F.signum(x) * rounded).otherwise(x))
    return made.drop(*(f"_{name}_{step}" for step in ("x", "size", "part", "floor", "head", "past")))


def convert(usd: Column, currency: Column, rates: Mapping[str, float] = RATES) -> Column:
    """``exchanged``, rounded by ``round2``. That names its argument many times, and the rate is looked
    up for each: with many rows, ``with_round2`` is faster."""
    return round2(exchanged(usd, currency, rates))
