"""DuckDB SQL for every query that SQL can express, over the same test tables."""

from __future__ import annotations

from harness.registry import ALERT_FROM, NEAR_LIMIT, NEAR_LIMIT_BY, QUARTER_DAY, WEEK
from vigiltx.plans.report import (
    CRYPTO_LINE, CRYPTO_NOTE, CRYPTO_SUBJECT, FAN_IN_LINE, FAN_IN_NOTE, FAN_IN_SUBJECT, HEADLINE,
    STRUCTURING_LINE, STRUCTURING_NOTE, STRUCTURING_SUBJECT,
)
from vigiltx.schema import (
    ALERT_COLUMNS, CUSTOMERS, FEATURE_COLUMNS, FLAG_COLUMNS, MODEL_COLUMNS, PROFILE_COLUMNS,
    PUBLISHED, RECEIVED_COLUMNS, SENT_COLUMNS, SILVER_COLUMNS,
)


def half_up(x: str, places: int) -> str:
    """Half up on the shortest decimal form of a double."""
    return f"cast(round(cast(cast({x} AS varchar) AS decimal(38,17)), {places}) AS double)"


def nearest_cent(x: str) -> str:
    """Two decimals of a double's exact value, half to even, in whole numbers; for 2^-8 to 2^27."""
    scaled, unit = f"(({x}) * 1152921504606846976::DOUBLE)::HUGEINT * 100", "1152921504606846976::HUGEINT"
    up = f"{scaled} % {unit} > {unit} // 2 OR {scaled} % {unit} = {unit} // 2 AND ({scaled} // {unit}) % 2 = 1"
    return f"(({scaled} // {unit} + CASE WHEN {up} THEN 1 ELSE 0 END)::DOUBLE / 100)"


def six(x: str) -> str:
    return f"({half_up(x, 6)} + 0.0)"


def money(x: str = "amount_usd") -> str:
    return f"cast(sum(cast({x} AS decimal(18,2))) AS double)"


def columns(names: list[str], **overrides: str) -> str:
    return ", ".join(f"{overrides.get(n, n)} AS {PUBLISHED[n]}" for n in names)


BRONZE = f"""
base AS (
  SELECT *, l_partkey % 80 AS noise,
    l_shipdate + to_seconds((l_partkey * 37 + l_suppkey * 11) % 86400) AS at0,
    ['USD', 'PEN', 'EUR', 'GBP', 'JPY', 'CNY'][1 + l_suppkey % 6] AS cur,
    cast([1.00, 3.35, 0.86, 0.74, 159.35, 6.72][1 + l_suppkey % 6] AS double) AS rate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
copies AS (
  SELECT *, 0 AS copy, at0 AS happened FROM base
  UNION ALL SELECT *, 1, at0 FROM base WHERE noise = 2
  UNION ALL SELECT *, 2, at0 + to_seconds(1) FROM base WHERE noise = 3
),
bronze AS (
  SELECT
    CASE WHEN copy <> 1 THEN concat(l_orderkey, '-', l_linenumber) END AS tx_id,
    CASE WHEN l_returnflag = 'R' THEN concat('S', l_suppkey) ELSE concat('C', o_custkey) END AS origin,
    CASE WHEN l_returnflag = 'R' THEN concat('C', o_custkey) ELSE concat('S', l_suppkey) END AS destination,
    CASE WHEN noise = 0 THEN strftime(happened, '%d/%m/%Y %H:%M:%S')
         ELSE strftime(happened, '%Y-%m-%d %H:%M:%S') END AS time_text,
    CASE o_orderpriority[1] WHEN '1' THEN ' Cajero_Automatico' WHEN '2' THEN 'Exchange_Crypto '
         WHEN '3' THEN 'Plataforma_Terceros' ELSE 'Transferencia_Bancaria' END AS channel,
    CASE WHEN l_linestatus = 'F' THEN 'Local' ELSE 'Internacional' END AS geography,
    {nearest_cent("(l_extendedprice / 50.0::double) * rate")} AS amount_original,
    CASE WHEN noise = 1 THEN ' uds ' ELSE cur END AS currency,
    l_extendedprice / 50.0::double AS amount_usd,
    coalesce(
      try_strptime(CASE WHEN noise = 0 THEN strftime(happened, '%d/%m/%Y %H:%M:%S')
                        ELSE strftime(happened, '%Y-%m-%d %H:%M:%S') END, '%Y-%m-%d %H:%M:%S'),
      try_strptime(CASE WHEN noise = 0 THEN strftime(happened, '%d/%m/%Y %H:%M:%S')
                        ELSE strftime(happened, '%Y-%m-%d %H:%M:%S') END, '%d/%m/%Y %H:%M:%S')
    ) AS tx_ts
  FROM copies
)"""

USABLE = f"""{BRONZE},
usable AS (
  SELECT tx_id, origin, destination, trim(channel) AS channel, geography,
    {half_up("amount_original", 2)} AS amount_original, upper(trim(currency)) AS currency,
    {half_up("amount_usd", 2)} AS amount_usd, tx_ts
  FROM bronze WHERE tx_id IS NOT NULL AND {half_up("amount_usd", 2)} > 0
)"""

SURVIVOR = (
    "tx_ts NULLS LAST, amount_usd NULLS LAST, origin NULLS LAST, destination NULLS LAST, "
    "channel NULLS LAST, geography NULLS LAST, currency NULLS LAST, amount_original NULLS LAST"
)

SILVER = f"""{USABLE},
tx AS (
  SELECT * EXCLUDE (place), cast(cast(tx_ts AS date) AS varchar) AS tx_date,
    strftime(tx_ts, '%H:%M:%S') AS tx_time
  FROM (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY {SURVIVOR}) AS place FROM usable)
  WHERE place = 1
),
customers AS (
  SELECT customer_id, age, occupation, monthly_income FROM (
    SELECT concat('C', c_custkey) AS customer_id, 18 + c_custkey % 53 AS age,
      trim(concat(' ', c_mktsegment, ' ')) AS occupation, c_acctbal AS monthly_income,
      row_number() OVER (PARTITION BY c_custkey ORDER BY c_mktsegment, c_acctbal) AS place
    FROM customer)
  WHERE place = 1
)"""

CASH = "(?i)Efectivo|ATM|Cajero|Ventanilla"


def matches(pattern: str) -> str:
    return f"count(*) FILTER (WHERE regexp_matches(channel, '{pattern}'))"


FEATURES = f"""{SILVER},
sent AS (
  SELECT origin AS customer_id, count(tx_id) AS sent_count, {money()} AS sent_total,
    {money()} / count(tx_id) AS sent_avg, max(amount_usd) AS sent_max,
    stddev_samp(amount_usd) AS sent_std, count(DISTINCT destination) AS unique_receivers,
    {matches(CASH)} AS cash_count, {matches("(?i)Crypto|Exchange|Bridge")} AS crypto_count,
    {matches("(?i)Plataforma|Terceros")} AS platform_count
  FROM tx GROUP BY origin
),
received AS (
  SELECT destination AS customer_id, count(tx_id) AS received_count, {money()} AS received_total,
    {money()} / count(tx_id) AS received_avg, max(amount_usd) AS received_max,
    count(DISTINCT origin) AS unique_senders
  FROM tx GROUP BY destination
),
joined AS (
  SELECT customer_id, coalesce(age, 0) AS age, occupation,
    coalesce(monthly_income, 0) AS monthly_income,
    {", ".join(f"coalesce({c}, 0) AS {c}" for c in SENT_COLUMNS + RECEIVED_COLUMNS)}
  FROM customers LEFT JOIN sent USING (customer_id) LEFT JOIN received USING (customer_id)
),
features AS (
  SELECT *, sent_total + received_total AS total_moved,
    CASE WHEN received_total > 0 THEN {half_up("sent_total / received_total", 4)}
         WHEN sent_total > 0 THEN 999.0::double ELSE 0.0::double END AS out_in_ratio,
    {half_up("(sent_total + received_total) / (CASE WHEN monthly_income <= 0 THEN 1000.0::double ELSE monthly_income END * 12.0::double)", 4)}
      AS moved_income_ratio,
    CASE WHEN received_count > 0 THEN {half_up("unique_senders::double / received_count", 4)}
         ELSE 0.0::double END AS fan_in_index,
    CASE WHEN sent_count > 0 THEN {half_up("crypto_count::double / sent_count", 4)}
         ELSE 0.0::double END AS crypto_ratio
  FROM joined
)"""

FLAGGED = f"""{FEATURES},
flagged AS (
  SELECT *,
    cast(sent_count BETWEEN 3 AND 10 AND sent_max <= 3000 AND sent_total BETWEEN 8000 AND 10500
      AS bigint) AS flag_structuring,
    cast(received_count >= 4 AND fan_in_index >= 0.70::double
      AND sent_total >= 0.70::double * received_total AND sent_total < 10000 AS bigint) AS flag_fan_in,
    cast(crypto_count >= 3 AND sent_max <= 2600 AND crypto_ratio >= 0.50::double AS bigint) AS flag_crypto,
    cast(moved_income_ratio >= 3.0::double AND sent_total > 5000 AS bigint) AS flag_kyc
  FROM features
)"""


def scored(source: str, ml_share: float, rule_share: float) -> str:
    return f"""
ruled AS (
  SELECT *, round_even(least(flag_structuring * 40.0::double + flag_fan_in * 35.0::double
    + flag_crypto * 35.0::double + flag_kyc * 25.0::double, 100.0::double), 2) AS rule_score
  FROM {source}
),
blended AS (
  SELECT *, round_even({ml_share}::double * ml_score + {rule_share}::double * rule_score, 2) AS risk_score
  FROM ruled
),
profiles AS (
  SELECT *, CASE WHEN risk_score >= 70 THEN 'ALTO RIESGO - ALERTA ROS'
    WHEN risk_score >= 40 THEN 'MEDIO RIESGO - MONITOREO' ELSE 'BAJO RIESGO - NORMAL' END AS risk_level
  FROM blended
)"""


PROFILES = f"""{FLAGGED},
no_model AS (SELECT *, 0.0::double AS ml_score, 0 AS ml_outlier FROM flagged),
{scored("no_model", 0.0, 1.0)}"""

STAND_IN = f"""{FLAGGED},
raw AS (SELECT *, -(total_moved / 1000.0::double + fan_in_index) AS raw_score FROM flagged),
bounds AS (
  SELECT quantile_cont(raw_score, 0.15) AS off, min(raw_score) - quantile_cont(raw_score, 0.15) AS low,
    max(raw_score) - quantile_cont(raw_score, 0.15) AS high
  FROM raw
),
stand_in AS (
  SELECT raw.*, CASE WHEN high - low > 0
      THEN round_even((1 - ((raw_score - off) - low) / (high - low)) * 100, 2) ELSE 0.0::double END AS ml_score,
    cast(raw_score - off < 0 AS integer) AS outlier
  FROM raw CROSS JOIN bounds
)"""

# The model sees spreads as exact sums give them: squares of cents in whole numbers.
EXACT_STD = """CASE WHEN count(*) > 1 THEN sqrt(greatest(
      (sum(squared) - (sum(whole) // count(*)) * (sum(whole) + sum(whole) % count(*)))::DOUBLE
      - (sum(whole) % count(*))::DOUBLE * (sum(whole) % count(*))::DOUBLE / count(*), 0) / (count(*) - 1)) / 100 END"""
MODEL_INPUT = FLAGGED.replace("stddev_samp(amount_usd) AS sent_std", f"{EXACT_STD} AS sent_std").replace(
    "FROM tx GROUP BY origin\n",
    "FROM (SELECT *, round(amount_usd * 100)::HUGEINT AS whole, (round(amount_usd * 100)::HUGEINT) * (round(amount_usd * 100)::HUGEINT) AS squared FROM tx) GROUP BY origin\n",
)
TREES, SAMPLE, DEEPEST, MODEL_PRIME, DEPTH_UNIT = 150, 256, 8, 2147483629, 1048576


def mean_path(n: str) -> str:
    gamma = "0.57721566490153286::DOUBLE"
    return (
        f"CASE WHEN {n} <= 1 THEN 0::DOUBLE WHEN {n} = 2 THEN 1::DOUBLE "
        f"ELSE 2 * (ln(({n})::DOUBLE - 1) + {gamma}) - 2 * (({n})::DOUBLE - 1) / {n} END"
    )


def word(text: str, place: int) -> str:
    return f"('0x' || substr(md5({text}), {place}, 8))::BIGINT"


def level(k: int) -> str:
    """The nodes of depth k from their rows, and the rows of depth k + 1."""
    sides = ", ".join(f"min(x[{i + 1}])" for i in range(len(MODEL_COLUMNS)))
    name = "'42:' || tree || ':' || node"
    return f"""
nodes{k} AS MATERIALIZED (
  SELECT *, CASE WHEN feature IS NULL THEN NULL WHEN cut0 < high[feature] THEN cut0 ELSE low[feature] END AS cut FROM (
    SELECT *, low[feature] + share * (high[feature] - low[feature]) AS cut0 FROM (
      SELECT *, CASE WHEN {k} < deepest AND len(differ) > 0 THEN differ[1 + {word(name, 1)} % len(differ)] END AS feature,
        {word(name, 9)} / 4294967296::DOUBLE AS share
      FROM (
        SELECT *, list_filter(range(1, {len(MODEL_COLUMNS) + 1}), lambda i: low[i] < high[i]) AS differ FROM (
          SELECT tree, node, count(*) AS size, [{sides}] AS low, [{sides.replace("min(", "max(")}] AS high FROM rows{k} GROUP BY tree, node))
      CROSS JOIN depth_limit))),
rows{k + 1} AS MATERIALIZED (
  SELECT tree, CASE WHEN x[feature] <= cut THEN 2 * node + 1 ELSE 2 * node + 2 END AS node, x
  FROM rows{k} JOIN nodes{k} USING (tree, node) WHERE feature IS NOT NULL),"""


def finite(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan({c}::DOUBLE) THEN 0 WHEN isinf({c}::DOUBLE) THEN 999 ELSE {c}::DOUBLE END"


def step(k: int) -> str:
    return f"""
walk{k + 1} AS (
  SELECT customer_id, x, tree, CASE WHEN feature IS NULL THEN node WHEN x[feature] <= cut THEN 2 * node + 1 ELSE 2 * node + 2 END AS node
  FROM walk{k} JOIN nodes USING (tree, node)),"""


FOREST = f"""{MODEL_INPUT},
vectors AS MATERIALIZED (
  SELECT customer_id, [{", ".join(finite(c) for c in MODEL_COLUMNS)}] AS x,
    {word("customer_id", 1)} % {MODEL_PRIME} AS first, {word("customer_id", 9)} % {MODEL_PRIME} AS second
  FROM flagged),
trees AS (
  SELECT tree, 1 + {word("'42:' || tree", 1)} % {MODEL_PRIME - 1} AS a, 1 + {word("'42:' || tree", 9)} % {MODEL_PRIME - 1} AS b,
    {word("'42:' || tree", 17)} % {MODEL_PRIME - 1} AS c
  FROM (SELECT unnest(range({TREES})) AS tree)),
rows0 AS MATERIALIZED (
  SELECT tree, 0::BIGINT AS node, x FROM (
    SELECT tree, x, row_number() OVER (PARTITION BY tree
      ORDER BY ((a * first) % {MODEL_PRIME} + (b * second) % {MODEL_PRIME} + c) % {MODEL_PRIME}, customer_id) AS place
    FROM vectors CROSS JOIN trees)
  WHERE place <= {SAMPLE}),
sample AS (SELECT least({SAMPLE}, count(*)) AS n FROM vectors),
depth_limit AS (SELECT ceil(log2(greatest(n, 2)))::BIGINT AS deepest FROM sample),
{"".join(level(k) for k in range(DEEPEST + 1)).strip()}
nodes AS MATERIALIZED (
  SELECT *, CASE WHEN feature IS NULL THEN depth * {DEPTH_UNIT} + round_even(({mean_path("size")}) * {DEPTH_UNIT}, 0)::BIGINT
    ELSE depth * {DEPTH_UNIT} END AS path
  FROM ({" UNION ALL ".join(f"SELECT tree, node, {k} AS depth, size, feature, cut FROM nodes{k}" for k in range(DEEPEST + 1))}))"""

MODEL_SCORED = f"""{FOREST},
walk0 AS (SELECT customer_id, x, tree, 0::BIGINT AS node FROM vectors CROSS JOIN trees),
{"".join(step(k) for k in range(DEEPEST)).strip()}
raw AS (
  SELECT customer_id, -pow(2::DOUBLE, -(sum(path)::DOUBLE / ({TREES} * any_value({mean_path("n")}) * {DEPTH_UNIT}))) AS raw_score
  FROM walk{DEEPEST} JOIN nodes USING (tree, node) CROSS JOIN sample GROUP BY customer_id),
bounds AS (
  SELECT quantile_cont(raw_score, 0.15) AS off, min(raw_score) - quantile_cont(raw_score, 0.15) AS low,
    max(raw_score) - quantile_cont(raw_score, 0.15) AS high
  FROM raw),
modelled AS (
  SELECT flagged.*, CASE WHEN high - low > 0
      THEN round_even((1 - ((raw_score - off) - low) / (high - low)) * 100, 2) ELSE 0::DOUBLE END AS ml_score,
    raw_score - off < 0 AS ml_outlier
  FROM flagged JOIN raw USING (customer_id) CROSS JOIN bounds)"""

DASHBOARD = f"""{SILVER},
dash AS (
  SELECT tx_date AS Fecha,
    CASE WHEN amount > 9500 THEN 'KYC Deviation' WHEN amount > 9000 THEN 'Structuring (Pitufeo)'
         WHEN amount > 8000 THEN 'Crypto Mixer' WHEN amount > 6000 THEN 'Fan-In Platform'
         ELSE 'Other Rule' END AS Rule_Triggered,
    amount AS Monto_USD, tx_id AS Alert_ID, origin AS Cliente_ID,
    CASE WHEN amount > 9000 THEN 'ALTO RIESGO - ALERTA ROJA' ELSE 'MEDIO RIESGO - MONITOREO' END
      AS Nivel_Riesgo
  FROM (SELECT *, amount_usd * 5 AS amount FROM tx)
  WHERE tx_date >= '1998-01-01' AND amount > 5000
)"""

FLOWS = f"""{PROFILES},
facts AS (
  SELECT tx.tx_id, tx.tx_date, tx.amount_usd, tx.channel, customer_id, rule_score / 100.0::double AS risk_score,
    CASE WHEN flag_structuring = 1 THEN 'Pitufeo (Structuring)' WHEN flag_fan_in = 1 THEN 'Fan-In Plataforma'
         WHEN flag_crypto = 1 THEN 'Salto Crypto (KYT)' WHEN flag_kyc = 1 THEN 'Desvio KYC'
         ELSE 'Normal' END AS pattern
  FROM tx JOIN profiles ON origin = customer_id
),
classed AS (
  SELECT *, CASE WHEN pattern = 'Normal' THEN 'Flujo Legítimo' ELSE 'Alerta AML (Fraude)' END
    AS classification
  FROM facts
)"""

SILVER_ROWS = f"SELECT {columns(SILVER_COLUMNS)} FROM tx"

UPSERTED = f"""WITH {SILVER}
SELECT {columns(SILVER_COLUMNS, channel="CASE WHEN amount_usd < 500 THEN 'old' ELSE channel END")}
FROM tx"""

ROUNDED_FEATURES = {c: six(c) for c in ("sent_avg", "sent_std", "received_avg")}


def features_select(names: list[str]) -> str:
    return ", ".join(f"{ROUNDED_FEATURES[n]} AS {n}" if n in ROUNDED_FEATURES else n for n in names)


def top(flag: str, names: str) -> str:
    return f"""WITH {PROFILES}
SELECT customer_id, {names} FROM profiles WHERE {flag} = 1
ORDER BY total_moved DESC, customer_id LIMIT 1"""


TOP_COLUMNS = (
    "customer_id, total_moved, crypto_count, crypto_ratio, moved_income_ratio, received_count, "
    "sent_count, sent_total"
)

TOP_ALL = " UNION ALL ".join(
    f"(SELECT '{name}' AS typology, {TOP_COLUMNS} FROM profiles WHERE {flag} = 1 "
    "ORDER BY total_moved DESC, customer_id LIMIT 1)"
    for name, flag in (
        ("fan_in", "flag_fan_in"), ("crypto", "flag_crypto"), ("structuring", "flag_structuring"),
    )
)

SUMMARY = """
  SELECT total_tx, total_customers, structuring_alerts, fan_in_alerts, crypto_alerts,
    structuring_alerts + fan_in_alerts + crypto_alerts AS total_alerts
  FROM (SELECT count(*) AS total_tx FROM tx) CROSS JOIN (
    SELECT count(*) AS total_customers,
      coalesce(cast(sum(flag_structuring) AS bigint), 0) AS structuring_alerts,
      coalesce(cast(sum(flag_fan_in) AS bigint), 0) AS fan_in_alerts,
      coalesce(cast(sum(flag_crypto) AS bigint), 0) AS crypto_alerts
    FROM profiles)"""


def printf(template: str, *values: str) -> str:
    """The template with values put in place of each %s."""
    parts = template.replace("%%", "%").split("%s")
    pieces = [f"'{parts[0]}'"]
    for value, rest in zip(values, parts[1:]):
        pieces += [value, f"'{rest}'"]
    return f"concat({', '.join(pieces)})"


def number(form: str, value: str) -> str:
    return f"format('{{:{form}}}', {value})"


SENT_TEXT = number(",.2f", "sent_total")

REPORT_LINES = f"""WITH {PROFILES},
figures AS ({SUMMARY}),
subjects AS ({TOP_ALL})
SELECT 'summary' AS section, 1 AS place,
  {printf(HEADLINE, number(",", "total_tx"), number(",", "total_customers"), "'Spark'", number(",", "total_alerts"))} AS line
FROM figures
UNION ALL SELECT 'distribution', 1, {printf(FAN_IN_LINE, "fan_in_alerts")} FROM figures
UNION ALL SELECT 'distribution', 2, {printf(CRYPTO_LINE, "crypto_alerts")} FROM figures
UNION ALL SELECT 'distribution', 3, {printf(STRUCTURING_LINE, "structuring_alerts")} FROM figures
UNION ALL SELECT 'subjects', 1, {printf(FAN_IN_SUBJECT, "customer_id")} FROM subjects WHERE typology = 'fan_in'
UNION ALL SELECT 'subjects', 2,
  {printf(FAN_IN_NOTE, "received_count", SENT_TEXT, number(".2f", "moved_income_ratio"))}
  FROM subjects WHERE typology = 'fan_in'
UNION ALL SELECT 'subjects', 3, {printf(CRYPTO_SUBJECT, "customer_id")} FROM subjects WHERE typology = 'crypto'
UNION ALL SELECT 'subjects', 4,
  {printf(CRYPTO_NOTE, SENT_TEXT, number(".1f", "crypto_ratio * 100"), "crypto_count")}
  FROM subjects WHERE typology = 'crypto'
UNION ALL SELECT 'subjects', 5, {printf(STRUCTURING_SUBJECT, "customer_id")} FROM subjects WHERE typology = 'structuring'
UNION ALL SELECT 'subjects', 6, {printf(STRUCTURING_NOTE, "sent_count", SENT_TEXT)}
  FROM subjects WHERE typology = 'structuring'"""


def text_time(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


BURSTS = f"""WITH {SILVER},
marked AS (
  SELECT *, CASE WHEN epoch(tx_ts) - epoch(lag(tx_ts) OVER w) <= {WEEK} THEN 0 ELSE 1 END AS starts
  FROM tx WINDOW w AS (PARTITION BY origin ORDER BY tx_ts)
),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY origin ORDER BY tx_ts RANGE UNBOUNDED PRECEDING) AS session
  FROM marked
)
SELECT concat(origin, '@', cast(epoch(min(tx_ts)) AS bigint)) AS session_id, origin AS customer_id,
  {text_time("min(tx_ts)")} AS started_at, {text_time("max(tx_ts)")} AS ended_at,
  cast(epoch(max(tx_ts)) - epoch(min(tx_ts)) AS bigint) AS span_seconds,
  count(*) AS events, {money()} AS amount
FROM numbered GROUP BY origin, session HAVING count(*) >= 2"""

STREAM_BURSTS = f"""WITH
seconds AS (SELECT *, epoch(date_trunc('second', ts))::BIGINT AS second FROM events),
marked AS (
  SELECT *, CASE WHEN second - lag(second) OVER w <= {QUARTER_DAY} THEN 0 ELSE 1 END AS starts
  FROM seconds WINDOW w AS (PARTITION BY user_id ORDER BY second)
),
numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY second RANGE UNBOUNDED PRECEDING) AS session
  FROM marked
)
SELECT concat(user_id, '@', min(second)) AS session_id, user_id AS customer_id,
  strftime(to_timestamp(min(second)) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS started_at,
  strftime(to_timestamp(max(second)) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS ended_at,
  max(second) - min(second) AS span_seconds, count(*) AS events, {money("value")} AS amount
FROM numbered GROUP BY user_id, session
HAVING max(second) + {QUARTER_DAY} + 1 <= (SELECT max(second) - 3600 FROM seconds)"""

INCREMENTAL = f"""WITH {USABLE},
batched AS (
  SELECT *, CASE WHEN origin LIKE 'C%' THEN 'b1' ELSE 'b2' END AS batch_id FROM usable
),
tx AS (
  SELECT *, cast(cast(tx_ts AS date) AS varchar) AS tx_date, strftime(tx_ts, '%H:%M:%S') AS tx_time
  FROM (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY batch_id DESC, {SURVIVOR}) AS place
        FROM batched)
  WHERE place = 1
)
SELECT {columns(SILVER_COLUMNS)}, batch_id FROM tx"""

REGROUPED = f"""WITH {USABLE},
batched AS (
  SELECT *, CASE WHEN origin LIKE 'S%' THEN '011' WHEN geography = 'Local' THEN '010' ELSE '009' END AS batch_id
  FROM usable
),
tx AS (
  SELECT *, cast(cast(tx_ts AS date) AS varchar) AS tx_date, strftime(tx_ts, '%H:%M:%S') AS tx_time,
    CASE batch_id WHEN '010' THEN 'branch' ELSE 'core' END AS source_system
  FROM (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY batch_id DESC, {SURVIVOR}) AS place
        FROM batched)
  WHERE place = 1
)
SELECT {columns(SILVER_COLUMNS)}, batch_id, source_system FROM tx"""


STREAMED = f"""WITH {USABLE},
filed AS (
  SELECT *, 'f1' AS batch_id FROM usable WHERE geography = 'Local'
  UNION ALL SELECT *, 'f2' FROM usable WHERE origin LIKE 'S%'
  UNION ALL SELECT *, 'f3' FROM usable WHERE channel LIKE 'Plata%' OR channel LIKE '%Crypto%'
  UNION ALL SELECT *, 'f4' FROM usable WHERE geography <> 'Local' AND origin LIKE 'C%'
),
tx AS (
  SELECT *, cast(cast(tx_ts AS date) AS varchar) AS tx_date, strftime(tx_ts, '%H:%M:%S') AS tx_time
  FROM (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY batch_id DESC, {SURVIVOR}) AS place FROM filed)
  WHERE place = 1
)
SELECT {columns(SILVER_COLUMNS)}, batch_id, 'core' AS source_system FROM tx"""


def pass_through(found: str) -> str:
    return f"""WITH {SILVER},
inbound AS (
  SELECT destination AS customer_id, count(*) AS in_count, {money()} AS in_total, max(tx_ts) AS last_in
  FROM tx WHERE channel = 'Plataforma_Terceros' GROUP BY destination
)
SELECT customer_id, in_count, in_total, {text_time("last_in")} AS last_in_at, count(*) AS out_count,
  {money()} AS out_total
FROM tx JOIN inbound ON origin = customer_id
WHERE channel = 'Transferencia_Bancaria' AND tx_ts > last_in
GROUP BY ALL HAVING {found}"""


MOST_SENT_ON = f"{money()} >= 0.90::double * in_total"

def single_exit(amount: str) -> str:
    return f"""WITH {SILVER},
inbound AS (
  SELECT destination AS customer_id, count(*) AS in_count, {money(amount)} AS in_total
  FROM tx WHERE channel = 'Exchange_Crypto' GROUP BY destination
),
outbound AS (
  SELECT origin AS customer_id, count(*) AS out_count, {money(amount)} AS out_total,
    count(DISTINCT destination) AS exits
  FROM tx WHERE channel = 'Exchange_Crypto' GROUP BY origin
)
SELECT * FROM inbound JOIN outbound USING (customer_id) WHERE in_count >= 2 AND exits BETWEEN 1 AND 3"""

ORACLES: dict[str, str] = {
    "silver_transactions": f"WITH {SILVER} {SILVER_ROWS}",
    "silver_customers": f"WITH {SILVER} SELECT {columns(CUSTOMERS.fieldNames())} FROM customers",
    "overwrite_roundtrip": f"WITH {SILVER} {SILVER_ROWS}",
    "upsert_transactions": UPSERTED,
    "upsert_customers": f"""WITH {SILVER} SELECT {columns(
        CUSTOMERS.fieldNames(),
        occupation="CASE WHEN monthly_income < 0 THEN 'old' ELSE occupation END",
    )} FROM customers""",
    "upsert_idempotent": UPSERTED,
    "upsert_by_partition": UPSERTED,
    "sample_rows": f"WITH {SILVER} {SILVER_ROWS} ORDER BY tx_id LIMIT 5",
    "bronze_append": f"""WITH {BRONZE}
SELECT CASE WHEN origin LIKE 'C%' THEN 'b1' ELSE 'b2' END AS batch_id, 'core' AS source_system,
  count(*) AS bronze_rows, count(tx_id) AS keyed_rows
FROM bronze GROUP BY ALL""",
    "incremental_upsert": INCREMENTAL,
    "incremental_regrouped": REGROUPED,
    "pruned_scan": f"""WITH {SILVER}
SELECT tx_id, amount_usd, cast(year(tx_ts) AS integer) AS year, channel FROM tx
WHERE year(tx_ts) BETWEEN 1997 AND 1998 AND channel = 'Exchange_Crypto'""",
    "lineage_columns": f"""WITH {PROFILES}
SELECT tx_id, origin, risk_score, 'b1' AS batch_id, 'core' AS source_system
FROM tx JOIN profiles ON origin = customer_id WHERE risk_score >= {ALERT_FROM}""",
    "schema_evolution": f"""WITH {SILVER}
SELECT *, CASE WHEN age >= 30 THEN upper(occupation) END AS segment FROM customers""",
    "features_outbound": f"""WITH {FEATURES}
SELECT customer_id, {features_select(SENT_COLUMNS)} FROM sent""",
    "features_inbound": f"""WITH {FEATURES}
SELECT customer_id, {features_select(RECEIVED_COLUMNS)} FROM received""",
    "features_customer": f"WITH {FEATURES} SELECT {features_select(FEATURE_COLUMNS)} FROM features",
    "layer_counts": f"""WITH {SILVER}
SELECT 'silver_transactions' AS layer, count(*) AS rows FROM tx
UNION ALL SELECT 'silver_customers', count(*) FROM customers""",
    "feature_scaling": f"""WITH {FEATURES},
moments AS (SELECT {", ".join(
        f"avg({c}::double) AS mean_{c}, stddev_pop({c}::double) AS std_{c}" for c in MODEL_COLUMNS
    )} FROM features)
SELECT customer_id, {", ".join(
        six(f"(({c} - mean_{c}) / CASE WHEN std_{c} = 0 THEN 1 ELSE std_{c} END)") + f" AS {c}"
        for c in MODEL_COLUMNS
    )} FROM features CROSS JOIN moments""",
    "iforest_model": f"""WITH {FOREST}
SELECT tree::INTEGER AS tree, node::INTEGER AS node,
  CASE WHEN feature IS NULL THEN node ELSE 2 * node + 1 END::INTEGER AS left,
  CASE WHEN feature IS NULL THEN node ELSE 2 * node + 2 END::INTEGER AS right,
  coalesce(feature - 1, 0)::INTEGER AS feature, coalesce(cut, 'Infinity'::DOUBLE) AS threshold, size::INTEGER AS size, path
FROM nodes""",
    "anomaly_scores": f"WITH {MODEL_SCORED} SELECT customer_id, ml_score, ml_outlier FROM modelled",
    "risk_profiles": f"""WITH {MODEL_SCORED}, {scored("modelled", 0.5, 0.5)}
SELECT {columns(PROFILE_COLUMNS, **ROUNDED_FEATURES)} FROM profiles""",
    "anomaly_postprocess": f"WITH {STAND_IN} SELECT customer_id, ml_score, outlier FROM stand_in",
    "typology_flags": f"WITH {FLAGGED} SELECT customer_id, {', '.join(FLAG_COLUMNS)} FROM flagged",
    "risk_scores": f"""WITH {STAND_IN}, {scored("stand_in", 0.5, 0.5)}
SELECT customer_id, ml_score, rule_score, risk_score, risk_level FROM profiles""",
    "risk_profiles_rules": f"WITH {PROFILES} SELECT {columns(PROFILE_COLUMNS, **ROUNDED_FEATURES)} FROM profiles",
    "alerts": f"""WITH {PROFILES}
SELECT {columns(
        ALERT_COLUMNS,
        **{c: f"customers.{c}" for c in CUSTOMERS.fieldNames()},
    )}
FROM tx JOIN profiles ON tx.origin = profiles.customer_id
LEFT JOIN customers ON tx.origin = customers.customer_id
WHERE risk_score >= {ALERT_FROM}""",
    "report_summary": f"WITH {PROFILES} {SUMMARY}",
    "top_fan_in": top("flag_fan_in", "received_count, sent_total, moved_income_ratio"),
    "top_crypto": top("flag_crypto", "sent_total, crypto_ratio, crypto_count"),
    "top_structuring": top("flag_structuring", "sent_count, sent_total"),
    "top_subjects": f"WITH {PROFILES} {TOP_ALL}",
    "report_lines": REPORT_LINES,
    "dash_alerts": f"WITH {DASHBOARD} SELECT * FROM dash ORDER BY Fecha DESC, Alert_ID",
    "dashboard_sql": f"""WITH {SILVER}
SELECT tx_date AS Fecha, amount_usd AS Monto_USD, tx_id AS Alert_ID, origin AS Cliente_ID,
  CASE WHEN amount_usd > 1900 THEN 'KYC Deviation' WHEN amount_usd > 1800 THEN 'Structuring (Pitufeo)'
    WHEN amount_usd > 1600 THEN 'Crypto Mixer' WHEN amount_usd > 1200 THEN 'Fan-In Platform' ELSE 'Other Rule' END AS Rule_Triggered,
  CASE WHEN amount_usd > 1800 THEN 'ALTO RIESGO - ALERTA ROJA' ELSE 'MEDIO RIESGO - MONITOREO' END AS Nivel_Riesgo
FROM tx WHERE tx_date >= '1998-01-01' AND amount_usd > 1000""",
    "dash_date_range": f"""WITH {DASHBOARD}
SELECT Fecha, count(*) FILTER (WHERE Fecha BETWEEN '1998-03-01' AND '1998-06-30') AS in_range
FROM dash GROUP BY Fecha""",
    "dash_trend": f"WITH {DASHBOARD} SELECT Fecha, count(*) AS alerts FROM dash GROUP BY Fecha",
    "dash_by_rule": f"""WITH {DASHBOARD}
SELECT Rule_Triggered, {money("Monto_USD")} AS amount FROM dash GROUP BY Rule_Triggered""",
    "dash_counters": f"WITH {DASHBOARD} SELECT count(*) AS alerts, {money('Monto_USD')} AS amount FROM dash",
    "dash_levels": f"""WITH {DASHBOARD}
SELECT Nivel_Riesgo, count(DISTINCT Cliente_ID) AS customers FROM dash GROUP BY Nivel_Riesgo""",
    "flow_links": f"""WITH {FLOWS}
SELECT channel, pattern, {money()} AS amount,
  CASE WHEN pattern LIKE '%Normal%' THEN 'normal' WHEN pattern LIKE '%Pitufeo%' THEN 'structuring'
       ELSE 'other' END AS kind
FROM facts GROUP BY channel, pattern""",
    "flow_nodes": f"""WITH {FLOWS}
SELECT row_number() OVER (ORDER BY side, name) - 1 AS node, name FROM (
  SELECT DISTINCT 0 AS side, channel AS name FROM facts
  UNION ALL SELECT DISTINCT 1, pattern FROM facts)""",
    "risk_rollup": f"""WITH {FLOWS}
SELECT classification, pattern, channel,
  cast(grouping_id(classification, pattern, channel) AS integer) AS level, {money()} AS amount
FROM classed GROUP BY ROLLUP (classification, pattern, channel)""",
    "risk_scatter": f"""WITH {FLOWS}
SELECT tx_id, tx_date AS x, amount_usd AS y, risk_score AS z, pattern, amount_usd AS size FROM facts""",
    "fx_convert": f"""WITH {SILVER}
SELECT tx_id, currency, amount_usd, CASE currency
    WHEN 'USD' THEN {nearest_cent("amount_usd * 1.00::double")}
    WHEN 'PEN' THEN {nearest_cent("amount_usd * 3.35::double")}
    WHEN 'EUR' THEN {nearest_cent("amount_usd * 0.86::double")}
    WHEN 'GBP' THEN {nearest_cent("amount_usd * 0.74::double")}
    WHEN 'JPY' THEN {nearest_cent("amount_usd * 159.35::double")}
    WHEN 'CNY' THEN {nearest_cent("amount_usd * 6.72::double")} END AS converted
FROM tx""",
    "defect_profile": f"""WITH {BRONZE}
SELECT count(*) AS bronze_rows,
  count(*) FILTER (WHERE time_text LIKE '__/__/____%') AS slash_dates,
  count(*) FILTER (WHERE currency NOT IN ('USD', 'PEN', 'EUR', 'GBP', 'JPY', 'CNY')) AS nonstandard_currencies,
  count(*) FILTER (WHERE tx_id IS NULL) AS missing_keys,
  (SELECT cast(sum(n) AS bigint) FROM (
     SELECT count(*) AS n FROM bronze WHERE tx_id IS NOT NULL GROUP BY tx_id) WHERE n > 1) AS repeated_key_rows
FROM bronze""",
    "near_duplicates": f"""WITH {BRONZE},
seconds AS (SELECT tx_id, tx_ts, count(*) AS n FROM bronze WHERE tx_id IS NOT NULL GROUP BY tx_id, tx_ts),
stepped AS (
  SELECT *, lag(tx_ts) OVER w AS earlier, lag(n) OVER w AS earlier_n
  FROM seconds WINDOW w AS (PARTITION BY tx_id ORDER BY tx_ts)
)
SELECT tx_id, {text_time("earlier")} AS first_at, {text_time("tx_ts")} AS second_at,
  earlier_n AS first_rows, n AS second_rows
FROM stepped WHERE tx_ts - earlier = INTERVAL 1 SECOND""",
    "burst_sessions": BURSTS,
    "cash_splitting": f"""WITH {SILVER}
SELECT origin AS customer_id, cast(cast(date_trunc('month', tx_ts) AS date) AS varchar) AS period_start,
  count(*) AS deposits, {money()} AS amount, max(amount_usd) AS largest
FROM tx WHERE regexp_matches(channel, '{CASH}') GROUP BY ALL
HAVING count(*) BETWEEN 3 AND 5 AND max(amount_usd) < 10000 AND {money()} > 3000""",
    "cash_splitting_day": f"""WITH {SILVER}
SELECT origin AS customer_id, cast(cast(date_trunc('month', tx_ts) AS date) AS varchar) AS period_start,
  count(*) AS deposits, {money("amount_usd * 5")} AS amount, max(amount_usd * 5) AS largest
FROM tx WHERE regexp_matches(channel, '{CASH}') AND tx_ts IS NOT NULL GROUP BY ALL
HAVING count(*) BETWEEN 3 AND 5 AND max(amount_usd * 5) < 10000 AND {money("amount_usd * 5")} > 10000""",
    "pass_through": pass_through(MOST_SENT_ON),
    "pass_through_near_limit": pass_through(
        f"{MOST_SENT_ON} OR {money()} >= {NEAR_LIMIT - NEAR_LIMIT_BY} AND {money()} < {NEAR_LIMIT}"
    ),
    "time_profile": f"""WITH {SILVER},
counted AS (
  SELECT origin AS customer_id, count(tx_ts) AS timed_count,
    count(*) FILTER (WHERE hour(tx_ts) BETWEEN 1 AND 5) AS night_count,
    count(*) FILTER (WHERE hour(tx_ts) BETWEEN 9 AND 18) AS office_count,
    count(*) FILTER (WHERE isodow(tx_ts) >= 6) AS weekend_count
  FROM tx GROUP BY origin
)
SELECT *, {", ".join(
        six(f"{c}_count::double / timed_count") + f" AS {c}_share" for c in ("night", "office", "weekend")
    )} FROM counted""",
    "single_exit": single_exit("amount_usd"),
    "single_exit_balanced": single_exit("(round_even(amount_usd, 0)::BIGINT % 3 + 999) / 10.0::double")
    + " AND abs(out_total - in_total) <= 0.01::double * in_total",
    "stream_upsert": STREAMED,
    "stream_bursts": STREAM_BURSTS,
}
