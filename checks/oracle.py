"""The same queries as independent DuckDB SQL over the test tables."""

from __future__ import annotations

PAYMENTS = """
payments AS (
  WITH e AS (
    SELECT event_id, user_id, value, event_type,
           CAST(json_extract_string(props, '$.k') AS INT) AS k,
           1704067200 + (epoch_us(ts) - 1704067200000000) // 144000000 AS s
    FROM events),
  b AS (
    SELECT e.*, list_extract(['ES','PT','FR','IT','DE','GB','US','MX'],
           CAST(1 + CASE WHEN event_id % 5 <> 0 THEN user_id % 5 ELSE event_id % 8 END AS INT)) AS country
    FROM e),
  p AS (
    SELECT s,
      strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS event_time,
      'pay-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS payment_id,
      'grp-' || lpad(CAST(event_id // 2 AS VARCHAR), 12, '0') AS payment_group_id,
      'cust-' || lpad(CAST(user_id // 2 AS VARCHAR), 5, '0') AS customer_id,
      'card-' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS card_id,
      'merchant-' || lpad(CAST(k + 1 AS VARCHAR), 4, '0') AS merchant_id,
      'device-' || lpad(CAST(CASE WHEN event_id % 5 = 0 THEN user_id % 20 ELSE 100 + user_id // 3 END AS VARCHAR), 5, '0') AS device_id,
      '10.' || (user_id % 256) || '.' || k || '.' || (event_id % 254 + 1) AS ip,
      country, value * 10 AS amount,
      CASE country WHEN 'GB' THEN 'GBP' WHEN 'US' THEN 'USD' WHEN 'MX' THEN 'MXN' ELSE 'EUR' END AS currency,
      CASE WHEN event_type = 'error' THEN 'declined' ELSE 'approved' END AS status,
      list_extract(['5411','5732','5812','4111','4900','5999','5651','5942'], CAST(k % 8 + 1 AS INT)) AS mcc,
      CAST(1 + event_id % 2 AS INT) AS attempt_number,
      CASE WHEN event_id % 5 = 0 THEN 'suspicious' WHEN event_id % 7 = 0 THEN 'retry' ELSE 'normal' END AS scenario,
      event_id
    FROM b)
  SELECT * EXCLUDE (event_id, s), make_timestamp((s + 5) * 1000000) AS ingestion_ts FROM p
  UNION ALL
  SELECT * EXCLUDE (event_id, s), make_timestamp((s + 65) * 1000000) FROM p WHERE event_id % 50 = 0
  UNION ALL
  SELECT * EXCLUDE (event_id, s) REPLACE ('not-a-date' AS event_time, 'bad-' || payment_id AS payment_id),
         make_timestamp((s + 5) * 1000000) FROM p WHERE event_id % 97 = 0)"""

CLEAN = """
clean AS (
  SELECT * REPLACE (try_cast(replace(event_time, '+00:00', '') AS TIMESTAMP) AS event_time)
  FROM payments
  WHERE try_cast(replace(event_time, '+00:00', '') AS TIMESTAMP) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY ingestion_ts DESC) = 1)"""

SILVER = """
silver AS (
  WITH t AS (SELECT *, epoch_us(event_time) // 1000000 AS sec FROM clean),
  devices AS (
    SELECT device_id, CAST(count(DISTINCT card_id) AS INT) AS distinct_cards_per_device FROM clean GROUP BY device_id),
  f AS (
    SELECT t.*,
      CAST(count(payment_id) OVER (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 300 PRECEDING AND CURRENT ROW) AS INT) AS tx_by_card_5m,
      CAST(count(DISTINCT merchant_id) OVER (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) AS INT) AS distinct_merchants_10m,
      CAST(count(DISTINCT country) OVER (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS INT) AS distinct_countries_1h,
      round(avg(CASE WHEN status = 'declined' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW), 4) AS declined_ratio_1h
    FROM t)
  SELECT f.* EXCLUDE (sec), distinct_cards_per_device FROM f JOIN devices USING (device_id))"""

GOLD = """
rules AS (
  SELECT *,
    CASE WHEN tx_by_card_5m >= 5 THEN 1 ELSE 0 END AS r1, CASE WHEN distinct_merchants_10m >= 4 THEN 1 ELSE 0 END AS r2,
    CASE WHEN distinct_countries_1h >= 3 THEN 1 ELSE 0 END AS r3, CASE WHEN distinct_cards_per_device >= 4 THEN 1 ELSE 0 END AS r4,
    CASE WHEN declined_ratio_1h >= 0.45 THEN 1 ELSE 0 END AS r5, CASE WHEN amount >= 1200 THEN 1 ELSE 0 END AS r6
  FROM silver),
gold AS (
  SELECT * EXCLUDE (r1, r2, r3, r4, r5, r6),
    CAST(24 * r1 + 18 * r2 + 18 * r3 + 16 * r4 + 12 * r5 + 12 * r6 AS INT) AS risk_score,
    list_filter([
      CASE WHEN r1 = 1 THEN 'high_card_velocity_5m' END, CASE WHEN r2 = 1 THEN 'many_merchants_10m' END,
      CASE WHEN r3 = 1 THEN 'many_countries_1h' END, CASE WHEN r4 = 1 THEN 'device_shared_by_cards' END,
      CASE WHEN r5 = 1 THEN 'high_declined_ratio_1h' END, CASE WHEN r6 = 1 THEN 'high_amount' END], lambda x: x IS NOT NULL) AS reason_list,
    array_to_string(reason_list, '|') AS reasons,
    array_to_string(reason_list, ', ') AS reasons_text,
    r1 + r2 + r3 + r4 + r5 + r6 > 0 AS is_alert
  FROM rules),
alerts AS (SELECT * FROM gold WHERE is_alert)"""

ELT = """
rds_raw AS (
  WITH n AS (SELECT *, CAST(substr(payment_id, 5, 12) AS BIGINT) AS n FROM gold),
  c AS (
    SELECT *, CASE WHEN n % 37 = 0 THEN 'not-a-date' WHEN n % 3 = 0 THEN strftime(event_time, '%Y-%m-%dT%H:%M:%SZ')
                   ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS ts_text,
           CASE status WHEN 'approved' THEN 'OK' ELSE 'Denied' END AS ps FROM n
    UNION ALL
    SELECT *, strftime(event_time - INTERVAL 60 SECOND, '%Y-%m-%d %H:%M:%S'), 'pending' FROM n WHERE n % 50 = 0)
  SELECT '  ' || CASE WHEN n % 3 = 0 THEN replace(payment_id, 'pay-', 'rds-') ELSE payment_id END || ' ' AS payment_id,
    lower(card_id) AS card_id,
    CASE WHEN n % 41 = 0 THEN -amount - 1 ELSE amount + 1 END AS amt,
    ts_text AS "timestamp",
    CASE country WHEN 'ES' THEN ' España ' WHEN 'GB' THEN 'Reino Unido' WHEN 'US' THEN 'USA' WHEN 'MX' THEN 'México' ELSE lower(country) END AS pais,
    ps AS payment_status, tx_by_card_5m, distinct_merchants_10m, distinct_countries_1h
  FROM c),
both_sides AS (
  SELECT payment_id, card_id, amount, event_time, country, status, CAST(risk_score AS DOUBLE) AS risk_score,
         tx_by_card_5m AS tx_5m, distinct_merchants_10m AS merchants_10m, distinct_countries_1h AS countries_1h, 's3' AS source
  FROM gold
  UNION ALL
  SELECT payment_id, card_id, amt, try_cast(replace(replace("timestamp", 'T', ' '), 'Z', '') AS TIMESTAMP), pais, payment_status,
         0.0, tx_by_card_5m, distinct_merchants_10m, distinct_countries_1h, 'rds'
  FROM rds_raw),
normal AS (
  SELECT trim(payment_id) AS payment_id, upper(trim(card_id)) AS card_id, amount, event_time,
    CASE
      WHEN c IN ('es', 'espana', 'spain') THEN 'ES' WHEN c IN ('pt', 'portugal') THEN 'PT' WHEN c IN ('fr', 'france') THEN 'FR'
      WHEN c IN ('it', 'italy', 'italia') THEN 'IT' WHEN c IN ('de', 'germany', 'alemania') THEN 'DE'
      WHEN c IN ('gb', 'uk', 'united kingdom', 'reino unido') THEN 'GB' WHEN c IN ('us', 'usa', 'united states', 'estados unidos') THEN 'US'
      WHEN c IN ('mx', 'mexico') THEN 'MX' ELSE upper(trim(country)) END AS country,
    CASE WHEN st IN ('approved', 'approve', 'ok', 'success') THEN 'approved'
         WHEN st IN ('declined', 'deny', 'denied', 'rejected', 'fail', 'failed') THEN 'declined' ELSE st END AS status,
    risk_score, tx_5m, merchants_10m, countries_1h, source
  FROM (SELECT *, translate(lower(trim(country)), 'áéíóúñ', 'aeioun') AS c, lower(trim(status)) AS st FROM both_sides)),
canon AS (
  SELECT * FROM normal
  WHERE payment_id <> '' AND card_id <> '' AND amount >= 0 AND event_time IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source, payment_id ORDER BY event_time DESC) = 1),
merged AS (
  SELECT payment_id, coalesce(s.card_id, r.card_id) AS card_id, coalesce(s.amount, r.amount) AS amount,
    coalesce(s.event_time, r.event_time) AS event_time, coalesce(s.country, r.country) AS country,
    coalesce(s.status, r.status) AS status, coalesce(s.risk_score, r.risk_score) AS risk_score,
    coalesce(s.tx_5m, r.tx_5m) AS tx_5m, coalesce(s.merchants_10m, r.merchants_10m) AS merchants_10m,
    coalesce(s.countries_1h, r.countries_1h) AS countries_1h, s.source AS source_s3, r.source AS source_rds,
    CAST(coalesce(s.event_time, r.event_time) AS DATE) AS event_date
  FROM (SELECT * FROM canon WHERE source = 's3') s FULL JOIN (SELECT * FROM canon WHERE source = 'rds') r USING (payment_id)),
consolidated AS (
  SELECT * FROM merged
  WHERE risk_score >= 60 OR tx_5m >= 5 OR merchants_10m >= 4 OR countries_1h >= 3 OR country IN ('RU', 'NG', 'KP', 'IR'))"""

GRAPH = """
late AS (SELECT * FROM gold WHERE event_time >= TIMESTAMP '2024-01-01 02:00:00'),
used_on AS (SELECT DISTINCT card_id, device_id FROM gold)"""

TRAINING = """
ml AS (
  SELECT payment_id, upper(trim(card_id)) AS card_id, amount, upper(trim(country)) AS country, lower(trim(status)) AS status,
         risk_score, tx_5m, merchants_10m, countries_1h,
         CAST(CASE WHEN risk_score >= 70 OR lower(trim(status)) = 'declined' THEN 1 ELSE 0 END AS INT) AS label
  FROM consolidated),
ml_text AS (
  SELECT payment_id, label,
    'amount=' || CAST(round_even(amount * 100, 0) / 100 AS VARCHAR) || ' | card=' || card_id || ' | country=' || country ||
    ' | status=' || status || ' | risk_score=' || CAST(risk_score AS VARCHAR) || ' | tx_5m=' || tx_5m ||
    ' | merchants_10m=' || merchants_10m || ' | countries_1h=' || countries_1h AS text
  FROM ml)"""

TO_SILVER = [PAYMENTS, CLEAN, SILVER]
TO_GOLD = [*TO_SILVER, GOLD]
TO_ELT = [*TO_GOLD, ELT]
TO_GRAPH = [*TO_GOLD, GRAPH]
TO_TRAINING = [*TO_ELT, TRAINING]


def _sql(parts: list[str], select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip()


def _time(name: str = "event_time") -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S') AS {name.split('.')[-1]}"


EVENT = ("payment_id, payment_group_id, customer_id, card_id, merchant_id, device_id, ip, country, amount, currency, "
         "status, mcc, attempt_number, scenario")
SHORT_EVENT = "payment_id, customer_id, card_id, merchant_id, device_id, ip, country, amount, currency, status, mcc"
FEATURES = ("tx_by_card_5m, distinct_merchants_10m, distinct_countries_1h, distinct_cards_per_device, declined_ratio_1h")
ALERT = ("payment_id, customer_id, card_id, merchant_id, device_id, country, amount, currency, status, "
         f"{FEATURES}, risk_score, reasons, reasons_text")
CANONICAL = "payment_id, card_id, amount, country, status, risk_score, tx_5m, merchants_10m, countries_1h"
DATED = f"{CANONICAL}, {_time()}, strftime(event_date, '%Y-%m-%d') AS event_date"
GRAPH_EVENT_TIME = "strftime(event_time, '%Y-%m-%d %H:%M:%S') || '.000000 UTC' AS event_time"
PAYMENT_NODE = (f"payment_id, payment_group_id, {GRAPH_EVENT_TIME}, amount, currency, status, country, risk_score, "
                "reasons_text AS reasons, is_alert, ip")

_MERCHANTS = """
SELECT merchant_id, arg_max(country, (event_time, payment_id)) AS country, arg_max(mcc, (event_time, payment_id)) AS mcc
FROM gold GROUP BY merchant_id"""
_EDGES = """
SELECT DISTINCT 'owns_card' AS edge, customer_id AS source, card_id AS target FROM gold
UNION ALL SELECT DISTINCT 'used_on', card_id, device_id FROM gold
UNION ALL SELECT DISTINCT 'authorized', card_id, payment_id FROM gold
UNION ALL SELECT DISTINCT 'at_merchant', payment_id, merchant_id FROM gold"""


def _shared_devices(pairs: str) -> str:
    return f"""
SELECT device_id, total_cards, card_id FROM ({pairs})
JOIN (SELECT device_id, count(*) AS total_cards FROM ({pairs}) GROUP BY device_id HAVING count(*) >= 3) USING (device_id)"""


def _multi_country(source: str, least: int) -> str:
    return f"""
SELECT card_id, total_countries, country FROM (SELECT DISTINCT card_id, country FROM {source} WHERE country IS NOT NULL)
JOIN (SELECT card_id, count(DISTINCT country) AS total_countries FROM {source}
      GROUP BY card_id HAVING count(DISTINCT country) >= {least}) USING (card_id)"""


def _risky_merchants(source: str, customers: int, cards: int) -> str:
    return f"""
SELECT merchant_id, CAST(count(DISTINCT o.customer_id) AS BIGINT) AS suspicious_customers, count(DISTINCT a.card_id) AS suspicious_cards
FROM {source} a JOIN (SELECT DISTINCT customer_id, card_id FROM gold) o USING (card_id)
WHERE a.is_alert GROUP BY merchant_id
HAVING count(DISTINCT o.customer_id) >= {customers} OR count(DISTINCT a.card_id) >= {cards}"""


def _device_clusters(source: str) -> str:
    """The literal form: pairs of different cards on one device."""
    return f"""
, near AS (
  SELECT DISTINCT a.device_id, b.card_id, p.payment_id
  FROM used_on a JOIN used_on b ON a.device_id = b.device_id AND a.card_id <> b.card_id
  JOIN (SELECT card_id, payment_id FROM {source} WHERE is_alert) p ON p.card_id = b.card_id)
SELECT DISTINCT device_id, card_id, alert_payments FROM near
JOIN (SELECT device_id, count(DISTINCT payment_id) AS alert_payments FROM near GROUP BY device_id) USING (device_id)"""


def _riskiest(entity: str, top: int) -> str:
    return f"""
SELECT {entity}, avg(risk_score) AS avg_risk_score, count(*) AS alert_count FROM alerts GROUP BY {entity}
ORDER BY avg_risk_score DESC, alert_count DESC, {entity} LIMIT {top}"""


def _cards(extra: str) -> str:
    return f"""
SELECT card_id, count(*) AS total_tx, count(*) FILTER (risk_score >= 70) AS high_risk_tx, avg(risk_score) AS avg_risk_score,
       max(tx_5m) AS max_tx_5m, {extra} count(DISTINCT country) AS distinct_countries
FROM consolidated GROUP BY card_id
HAVING count(*) FILTER (risk_score >= 70) >= 2 OR max(tx_5m) >= 8 OR count(DISTINCT country) >= 2"""


_HOURS = """
SELECT strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS hour_bucket, count(*) AS total_alerts
FROM alerts GROUP BY date_trunc('hour', event_time) ORDER BY 1"""
_GEO = """
SELECT country, strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour_bucket, total_tx, high_risk_tx, declined_tx, avg_risk_score,
       max_countries_1h, distinct_cards, CAST(CASE WHEN country IN ('RU', 'NG', 'KP', 'IR') THEN 1 ELSE 0 END AS INT) AS is_suspicious_country
FROM (SELECT country, date_trunc('hour', event_time) AS hour, count(*) AS total_tx,
             count(*) FILTER (risk_score >= 70) AS high_risk_tx, count(*) FILTER (status = 'declined') AS declined_tx,
             avg(risk_score) AS avg_risk_score, max(countries_1h) AS max_countries_1h, count(DISTINCT card_id) AS distinct_cards
      FROM consolidated GROUP BY 1, 2)
WHERE high_risk_tx > 0 OR declined_tx > 0 OR max_countries_1h >= 2 OR country IN ('RU', 'NG', 'KP', 'IR')"""
_GEO_SQL = """
SELECT country, strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS hour_bucket, count(*) AS total_tx,
       count(*) FILTER (risk_score >= 70) AS high_risk_tx, avg(risk_score) AS avg_risk_score, count(DISTINCT card_id) AS distinct_cards
FROM consolidated GROUP BY country, date_trunc('hour', event_time) HAVING count(*) FILTER (risk_score >= 70) > 0"""

_LATE_CARDS = "SELECT * FROM used_on WHERE card_id IN (SELECT card_id FROM late)"

# Gold rows have neither a consolidated risk filter nor short feature names.
_GOLD_TEXT = """
SELECT payment_id,
  'amount=' || CAST(round_even(amount * 100, 0) / 100 AS VARCHAR) || ' | card=' || upper(card_id) || ' | country=' || country ||
  ' | status=' || status || ' | risk_score=' || CAST(CAST(risk_score AS DOUBLE) AS VARCHAR) || ' | tx_5m=' || tx_by_card_5m ||
  ' | merchants_10m=' || distinct_merchants_10m || ' | countries_1h=' || distinct_countries_1h AS text
FROM gold"""

_METRICS = """
, s AS (SELECT label, risk_score AS score, CASE WHEN risk_score >= 60 THEN 1 ELSE 0 END AS guess FROM ml),
c AS (
  SELECT CAST(count(*) FILTER (label = 1 AND guess = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (label = 0 AND guess = 1) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (label = 1 AND guess = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (label = 0 AND guess = 0) AS DOUBLE) AS tn
  FROM s),
ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mid_rank FROM s),
area AS (
  SELECT (sum(mid_rank) FILTER (label = 1) - p * (p + 1) / 2) / (p * n) AS auc
  FROM ranked, (SELECT tp + fn AS p, fp + tn AS n FROM c) GROUP BY p, n)
SELECT 'accuracy' AS metric, round((tp + tn) / (tp + tn + fp + fn), 9) AS value FROM c
UNION ALL SELECT 'precision', round(tp / (tp + fp), 9) FROM c
UNION ALL SELECT 'recall', round(tp / (tp + fn), 9) FROM c
UNION ALL SELECT 'f1', round(2 * tp / (2 * tp + fp + fn), 9) FROM c
UNION ALL SELECT 'roc_auc', round(CAST(auc AS DOUBLE), 9) FROM area"""

_MESSAGES = f"SELECT event_time, {EVENT} FROM payments"


def _counts(parts: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS metric, count(*) AS total FROM ({s})" for n, s in parts.items())


def _analysis_rows(transactions: str, cards: str, places: str) -> str:
    return f"""
SELECT 'high_risk_transactions' AS dataset, payment_id AS id, CAST(round(risk_score) AS BIGINT) AS total FROM consolidated WHERE {transactions}
UNION ALL SELECT 'suspicious_cards', card_id, total_tx FROM ({cards})
UNION ALL SELECT 'geo_fraud_patterns', country || ' ' || hour_bucket, total_tx FROM ({places})"""


_OTHER_CARDS = """
SELECT card_id, count(*) AS total_tx FROM consolidated GROUP BY card_id
HAVING count(*) FILTER (risk_score >= 80) >= 3 OR max(tx_5m) >= 6 OR count(DISTINCT country) >= 4"""
_OTHER_GEO = """
SELECT country, strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:%M:%S') AS hour_bucket, count(*) AS total_tx
FROM consolidated GROUP BY country, date_trunc('hour', event_time)
HAVING bool_or(risk_score >= 80) OR bool_or(status = 'declined') OR max(countries_1h) >= 3 OR country = 'MX'"""
_EARLY_OR_LATE = "(SELECT * FROM gold WHERE event_time < TIMESTAMP '2024-01-01 01:00:00' OR event_time >= TIMESTAMP '2024-01-01 02:00:00')"
_NODE_IDS = """
SELECT DISTINCT 'customers' AS label, customer_id AS id FROM gold
UNION ALL SELECT DISTINCT 'cards', card_id FROM gold
UNION ALL SELECT DISTINCT 'devices', device_id FROM gold
UNION ALL SELECT DISTINCT 'merchants', merchant_id FROM gold
UNION ALL SELECT DISTINCT 'payments', payment_id FROM gold"""

_SPLIT = """
SELECT payment_id, label,
  CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5('42' || payment_id), payment_id)
            <= round(0.2 * count(*) OVER (PARTITION BY label)) THEN 'eval' ELSE 'train' END AS split
FROM ml"""

ORACLE_SQL: dict[str, str] = {
    "bronze_parse": _sql([PAYMENTS], _MESSAGES),
    "bronze_ingest": _sql([PAYMENTS], _MESSAGES),
    "bronze_resume": _sql([PAYMENTS], _MESSAGES),
    "bronze_timed": _sql([PAYMENTS], _MESSAGES),
    "bronze_progress": _sql(
        [PAYMENTS],
        """SELECT 4::BIGINT AS batches, (count(*) + count(*) FILTER (WHERE event_time = 'not-a-date'))::BIGINT AS messages,
       count(*)::BIGINT AS stored FROM payments""",
    ),
    "bronze_by_day": _sql([PAYMENTS], _MESSAGES),
    "silver_clean": _sql([PAYMENTS, CLEAN], f"SELECT {_time()}, {EVENT}, {_time('ingestion_ts')} FROM clean"),
    "silver_features": _sql(TO_SILVER, f"SELECT {_time()}, {EVENT}, {_time('ingestion_ts')}, {FEATURES} FROM silver"),
    "silver_features_short": _sql(TO_SILVER, f"SELECT {_time()}, {SHORT_EVENT}, {FEATURES} FROM silver"),
    "gold_scored": _sql(
        TO_GOLD,
        f"SELECT {_time()}, {EVENT}, {_time('ingestion_ts')}, {FEATURES}, risk_score, reasons, reasons_text, is_alert FROM gold",
    ),
    "fraud_alerts": _sql(TO_GOLD, f"SELECT {ALERT}, {_time()} FROM alerts"),
    "fraud_alerts_mcc": _sql(TO_GOLD, f"SELECT {ALERT}, mcc, {_time()} FROM alerts"),
    "graph_payments": _sql(
        TO_GOLD,
        f"SELECT {SHORT_EVENT}, payment_group_id, scenario, {_time()}, risk_score, reasons, reasons_text, is_alert FROM gold",
    ),
    "payment_relations": _sql(
        TO_GOLD, f"SELECT {SHORT_EVENT}, {_time()}, {FEATURES}, risk_score, reasons, reasons_text, is_alert FROM gold"
    ),
    "gold_by_hour": _sql(
        TO_GOLD,
        f"""SELECT payment_id, {_time()}, risk_score, reasons_text FROM alerts
       WHERE event_time >= TIMESTAMP '2024-01-01 00:30:00' AND event_time < TIMESTAMP '2024-01-01 03:00:00'
       AND (risk_score >= 60 OR event_time < TIMESTAMP '2024-01-01 01:00:00' OR event_time >= TIMESTAMP '2024-01-01 02:00:00')""",
    ),
    "replaced_tables": _sql(TO_GOLD, "SELECT payment_id, risk_score, reasons_text FROM alerts WHERE risk_score >= 30"),
    "kpi_counts": _sql(
        TO_GOLD,
        _counts({"bronze_rows": "SELECT 1 FROM payments", "total_transactions": "SELECT 1 FROM silver",
                 "total_fraud_alerts": "SELECT 1 FROM alerts"}),
    ),
    "alerts_per_hour": _sql(TO_GOLD, _HOURS),
    "alerts_first_24_hours": _sql(TO_GOLD, _HOURS + " LIMIT 24"),
    "alerts_first_3_hours": _sql(TO_GOLD, _HOURS + " LIMIT 3"),
    "top_merchants": _sql(TO_GOLD, _riskiest("merchant_id", 20)),
    "top_merchants_10": _sql(TO_GOLD, _riskiest("merchant_id", 10)),
    "top_cards": _sql(TO_GOLD, _riskiest("card_id", 20)),
    "top_cards_10": _sql(TO_GOLD, _riskiest("card_id", 10)),
    "top_alerts": _sql(
        TO_GOLD,
        f"SELECT {ALERT}, {_time()} FROM (SELECT * FROM alerts ORDER BY risk_score DESC, payment_id LIMIT 20)",
    ),
    "recent_features": _sql(
        TO_SILVER,
        f"SELECT payment_id, card_id, {_time()}, {FEATURES} FROM (SELECT * FROM silver ORDER BY event_time DESC, payment_id LIMIT 20)",
    ),
    "jdbc_features": _sql(TO_SILVER, f"SELECT {_time()}, {SHORT_EVENT}, {FEATURES} FROM silver"),
    "canonical": _sql(TO_ELT, f"SELECT {CANONICAL}, {_time()}, source FROM canon"),
    "consolidated": _sql(TO_ELT, f"SELECT {DATED}, source_s3, source_rds FROM consolidated"),
    "consolidated_io": _sql(TO_ELT, f"SELECT {DATED}, source_s3, source_rds FROM consolidated"),
    "bounded_read": _sql(
        TO_ELT,
        f"""SELECT f.payment_id, {_time('f.event_time')}, f.risk_score FROM (
         SELECT * FROM consolidated ORDER BY event_time, payment_id LIMIT 400) f""",
    ),
    "stage_counts": _sql(
        TO_ELT,
        """
SELECT 's3_clean' AS stage, count(*) AS row_count FROM canon WHERE source = 's3'
UNION ALL SELECT 'rds_clean', count(*) FROM canon WHERE source = 'rds'
UNION ALL SELECT 'merged', count(*) FROM merged
UNION ALL SELECT 'filtered', count(*) FROM consolidated""",
    ),
    "risk_high_tx": _sql(
        TO_ELT,
        f"""SELECT {DATED}, CASE WHEN risk_score >= 70 THEN 'high_risk_score' ELSE 'declined_status' END AS risk_reason
FROM consolidated WHERE risk_score >= 70 OR status = 'declined'""",
    ),
    "risk_high_tx_sql": _sql(
        TO_ELT, f"SELECT {DATED} FROM consolidated WHERE risk_score >= 70 OR lower(status) = 'declined'"
    ),
    "risk_cards": _sql(TO_ELT, _cards("max(merchants_10m) AS max_merchants_10m,")),
    "risk_cards_sql": _sql(TO_ELT, _cards("")),
    "risk_geo": _sql(TO_ELT, _GEO),
    "risk_geo_sql": _sql(TO_ELT, _GEO_SQL),
    "analysis_io": _sql(TO_ELT, _analysis_rows("risk_score >= 70 OR status = 'declined'", _cards(""), _GEO)),
    "analysis_limits": _sql(TO_ELT, _analysis_rows("risk_score >= 80 OR status = 'declined'", _OTHER_CARDS, _OTHER_GEO)),
    "analysis_tables": _sql(TO_ELT, _analysis_rows("risk_score >= 70 OR lower(status) = 'declined'", _cards(""), _GEO_SQL)),
    "analysis_summary": """
SELECT unnest(['high_risk_transactions', 'suspicious_cards', 'geo_fraud_patterns']) AS dataset,
       unnest(['/high_risk_transactions', '/suspicious_cards', '/geo_fraud_patterns']) AS output_path""",
    "gold_export": _sql(
        TO_GOLD,
        f"""SELECT {ALERT}, {_time()}, strftime(event_time, '%Y') AS year, strftime(event_time, '%m') AS month,
       strftime(event_time, '%d') AS day FROM alerts WHERE event_time >= TIMESTAMP '2024-01-01 00:30:00'""",
    ),
    "gold_export_first": _sql(
        TO_GOLD,
        f"""SELECT f.payment_id, {_time('f.event_time')}, f.risk_score FROM (
         SELECT * FROM alerts WHERE event_time >= TIMESTAMP '2024-01-01 01:10:00' ORDER BY event_time, payment_id LIMIT 700) f""",
    ),
    "gold_export_all": _sql(
        TO_GOLD,
        f"""SELECT {ALERT}, {_time()}, strftime(event_time, '%Y') AS year, strftime(event_time, '%m') AS month,
       strftime(event_time, '%d') AS day FROM alerts""",
    ),
    "compaction": _sql(
        TO_GOLD,
        f"SELECT {_time()}, {EVENT}, {_time('ingestion_ts')}, {FEATURES}, risk_score, reasons, reasons_text, is_alert FROM gold",
    ),
    "compaction_files": "SELECT true AS fewer, true AS as_asked, true AS bounded",
    "graph_staging": _sql(
        TO_GOLD,
        f"""SELECT {SHORT_EVENT}, payment_group_id, {_time()}, risk_score, reasons_text, is_alert FROM gold
WHERE event_time >= TIMESTAMP '2024-01-01 01:00:00' AND event_time < TIMESTAMP '2024-01-01 04:00:00'""",
    ),
    "graph_nodes": _sql(TO_GOLD, _NODE_IDS),
    "graph_merchants": _sql(TO_GOLD, _MERCHANTS),
    "graph_payment_nodes": _sql(TO_GOLD, f"SELECT {PAYMENT_NODE}, 'full' AS graph_name FROM gold"),
    "graph_edges": _sql(TO_GOLD, _EDGES),
    "graph_counts": _sql(
        TO_GOLD,
        """
SELECT 'rows' AS dataset, count(*) AS total FROM gold
UNION ALL SELECT 'customers', count(DISTINCT customer_id) FROM gold
UNION ALL SELECT 'cards', count(DISTINCT card_id) FROM gold
UNION ALL SELECT 'devices', count(DISTINCT device_id) FROM gold
UNION ALL SELECT 'merchants', count(DISTINCT merchant_id) FROM gold
UNION ALL SELECT 'payments', count(DISTINCT payment_id) FROM gold""",
    ),
    "graph_csv_roundtrip": _sql(TO_GOLD, f"SELECT {PAYMENT_NODE}, 'full' AS graph_name FROM gold"),
    "graph_csv_nodes": _sql(TO_GOLD, _NODE_IDS),
    "graph_csv_edges": _sql(TO_GOLD, _EDGES),
    "graph_reload": _sql(
        TO_GOLD,
        f"""SELECT {PAYMENT_NODE},
  CASE WHEN g.event_time >= TIMESTAMP '2024-01-01 02:00:00' THEN 'late' ELSE 'early' END AS graph_name FROM {_EARLY_OR_LATE} g""",
    ),
    "graph_reload_edges": _sql(
        TO_GOLD,
        f"""
SELECT DISTINCT 'owns_card' AS edge, customer_id AS source, card_id AS target FROM gold
UNION ALL SELECT DISTINCT 'used_on', card_id, device_id FROM gold
UNION ALL SELECT DISTINCT 'authorized', card_id, payment_id FROM {_EARLY_OR_LATE}
UNION ALL SELECT DISTINCT 'at_merchant', payment_id, merchant_id FROM {_EARLY_OR_LATE}""",
    ),
    "graph_dangling_edges": _sql(
        TO_GOLD,
        f"""
SELECT * FROM ({_EDGES}) WHERE NOT (edge = 'owns_card' AND ends_with(target, '7'))
AND NOT (edge IN ('used_on', 'authorized') AND ends_with(source, '7'))""",
    ),
    "graph_upsert": _sql(
        TO_GOLD,
        f"""SELECT {PAYMENT_NODE},
  CASE WHEN gold.event_time >= TIMESTAMP '2024-01-01 02:00:00' THEN 'late' ELSE 'early' END AS graph_name FROM gold""",
    ),
    "graph_upsert_merchants": _sql(
        TO_GRAPH,
        _MERCHANTS.replace("FROM gold", "FROM late")
        + " UNION ALL SELECT * FROM ("
        + _MERCHANTS.replace(
            "FROM gold",
            "FROM gold WHERE event_time < TIMESTAMP '2024-01-01 03:00:00' AND merchant_id NOT IN (SELECT merchant_id FROM late)",
        )
        + ")",
    ),
    "graph_upsert_edges": _sql(TO_GOLD, _EDGES),
    "graph_key_violations": _sql(
        TO_GOLD,
        "SELECT DISTINCT 'cards' AS label, card_id AS id, CAST(2 AS BIGINT) AS copies FROM gold WHERE ends_with(card_id, '7')",
    ),
    "graph_shared_devices": _sql(TO_GRAPH, _shared_devices(_LATE_CARDS)),
    "graph_shared_devices_all": _sql(TO_GRAPH, _shared_devices("SELECT * FROM used_on")),
    "graph_multi_country_cards": _sql(TO_GRAPH, _multi_country("late", 4)),
    "graph_multi_country_cards_all": _sql(TO_GRAPH, _multi_country("gold", 3)),
    "graph_risky_merchants": _sql(TO_GRAPH, _risky_merchants("late", 38, 48)),
    "graph_risky_merchants_all": _sql(TO_GRAPH, _risky_merchants("gold", 2, 3)),
    "graph_device_clusters": _sql(TO_GRAPH, _device_clusters("late")),
    "graph_device_clusters_all": _sql(TO_GRAPH, _device_clusters("gold")),
    "training_set": _sql(TO_TRAINING, "SELECT text, label FROM ml_text"),
    "training_text": _sql(TO_GOLD, _GOLD_TEXT),
    "label_distribution": _sql(TO_TRAINING, "SELECT label, count(*) AS total FROM ml GROUP BY label"),
    "train_eval_split": _sql(TO_TRAINING, _SPLIT),
    "classifier_split_sizes": _sql(
        TO_TRAINING,
        f"SELECT split, count(*) AS total, count(*) FILTER (WHERE label = 1) AS positives FROM ({_SPLIT}) GROUP BY split",
    ),
    "classifier_eval_rows": _sql(TO_TRAINING, f"SELECT payment_id, label FROM ({_SPLIT}) WHERE split = 'eval'"),
    "binary_metrics": "WITH " + ",".join(TO_TRAINING) + _METRICS,
}

# the stored folders hold what the tables hold
ORACLE_SQL["graph_store_reload"] = ORACLE_SQL["graph_reload"]
ORACLE_SQL["graph_store_reload_edges"] = ORACLE_SQL["graph_reload_edges"]
