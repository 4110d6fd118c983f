"""SQL equivalents of the registered queries, over the same tables.

Each statement computes its result from the base tables alone and shares no code with
the DataFrame side beyond column names.
"""

from __future__ import annotations

_V = [f"V{i}" for i in range(1, 29)]
_VS = ", ".join(_V)
_NOW = "TIMESTAMP '2024-01-25 00:00:00'"
_DAY = 86400
_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def _time(expr: str, name: str) -> str:
    return f"{_TIME.format(expr)} AS {name}"


def _r(expr: str, places: int, name: str | None = None) -> str:
    return f"round({expr}, {places}) AS {name or expr}"


_TX = f"""
tx AS (
  SELECT printf('txn_%08d', event_id) AS transaction_id, printf('user_%05d', user_id) AS user_id,
         ts AS event_time, epoch_us(ts) // 1000000 AS event_time_unix, CAST(ts AS DATE) AS event_date,
         value AS amount, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS is_fraud,
         event_type, event_id, ts AS ingested_at,
         {", ".join(f"CAST((event_id * {2 * i + 1} + k * {i}) % 2001 - 1000 AS DOUBLE) / 250.0 AS V{i}" for i in range(1, 29))}
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)"""

_STAGED = f"""{_TX},
bronze AS (
  SELECT * FROM tx
  UNION ALL BY NAME
  SELECT * REPLACE (amount + 1 AS amount, ingested_at + INTERVAL 1 HOUR AS ingested_at)
  FROM tx WHERE event_type = 'purchase'
),
staged AS (
  SELECT * EXCLUDE (n, ingested_at) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ingested_at) AS n FROM bronze
  ) WHERE n = 1
)"""


def _framed(source: str) -> str:
    """All rolling aggregates of a table with the staged columns."""
    return f"""
framed AS (
  SELECT *,
    count(transaction_id) OVER h1 AS txn_count_1h,
    count(transaction_id) OVER h24 AS txn_count_24h,
    count(transaction_id) OVER d7 AS txn_count_7d,
    event_time_unix - lag(event_time_unix)
      OVER (PARTITION BY user_id ORDER BY event_time_unix, transaction_id) AS seconds_since_last_txn,
    sum(amount) OVER h1 AS total_amount_1h, sum(amount) OVER h24 AS total_amount_24h,
    avg(amount) OVER h24 AS avg_amount_24h, max(amount) OVER h24 AS max_amount_24h,
    min(amount) OVER h24 AS min_amount_24h, max(amount) OVER d7 AS max_amount_7d,
    stddev_samp(amount) OVER h24 AS amount_stddev_24h, stddev_samp(amount) OVER d7 AS amount_stddev_7d,
    avg(amount) OVER d7 AS avg_amount_7d
  FROM {source}
  WINDOW
    h1 AS (PARTITION BY user_id ORDER BY event_time_unix RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING),
    h24 AS (PARTITION BY user_id ORDER BY event_time_unix RANGE BETWEEN 86400 PRECEDING AND 1 PRECEDING),
    d7 AS (PARTITION BY user_id ORDER BY event_time_unix RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING)
)"""


_VS_AVG = "amount / (coalesce(avg_amount_24h, amount) + 0.01)"
_VS_MAX = "amount / (coalesce(max_amount_7d, amount) + 0.01)"
_Z = (
    "CASE WHEN coalesce(amount_stddev_7d, 0) = 0 THEN 0.0"
    " ELSE (amount - avg_amount_7d) / amount_stddev_7d END"
)
_FRAMED = f"{_STAGED},{_framed('staged')}"


def _features(framed: str) -> str:
    return f"""{framed},
features AS (
  SELECT transaction_id, user_id, event_time, event_date, amount, is_fraud,
    txn_count_1h, txn_count_24h, txn_count_7d, seconds_since_last_txn,
    coalesce(total_amount_1h, 0.0) AS total_amount_1h, coalesce(total_amount_24h, 0.0) AS total_amount_24h,
    coalesce(avg_amount_24h, amount) AS avg_amount_24h, coalesce(max_amount_24h, amount) AS max_amount_24h,
    coalesce(min_amount_24h, amount) AS min_amount_24h,
    coalesce({_VS_AVG}, 1.0) AS amount_vs_avg_24h, coalesce({_VS_MAX}, 1.0) AS amount_vs_max_7d,
    coalesce(amount_stddev_24h, 0.0) AS amount_stddev_24h, coalesce(amount_stddev_7d, 0.0) AS amount_stddev_7d,
    {_Z} AS amount_zscore_7d, {_VS}
  FROM framed
)"""


_FEATURES = _features(_FRAMED)

_KEYS = f"transaction_id, user_id, {_time('event_time', 'event_time')}"
_SPEND_OUT = ", ".join(
    [
        *[
            _r(c, 8)
            for c in (
                "total_amount_1h",
                "total_amount_24h",
                "avg_amount_24h",
                "max_amount_24h",
                "min_amount_24h",
            )
        ],
    ]
)
_FEATURES_OUT = f"""{_KEYS}, CAST(event_date AS VARCHAR) AS event_date, amount, is_fraud,
  txn_count_1h, txn_count_24h, txn_count_7d, seconds_since_last_txn, {_SPEND_OUT},
  {", ".join(_r(c, 6) for c in ("amount_vs_avg_24h", "amount_vs_max_7d", "amount_stddev_24h", "amount_stddev_7d", "amount_zscore_7d"))},
  {_VS}"""
# The inputs of the model, in their order.
_INPUTS = ", ".join(
    f"coalesce({c}::DOUBLE, 0)"
    for c in [
        *(f"txn_count_{w}" for w in ("1h", "24h", "7d")),
        "total_amount_1h", "total_amount_24h", "avg_amount_24h", "max_amount_24h", "min_amount_24h",
        "amount_vs_avg_24h", "amount_vs_max_7d", "amount_stddev_24h", "amount_stddev_7d",
        *(f"V{i}" for i in (*range(1, 13), 14, 16, 17, 18, 19, 21)),
        "amount",
    ]
)
_FEATURES_SQL = f"WITH {_FEATURES} SELECT {_FEATURES_OUT} FROM features"


def _profiles(source: str, where: str = "") -> str:
    return f"""
profiles AS (
  SELECT user_id, count(transaction_id) AS total_txn_count, max(event_time) AS last_transaction_time,
    avg(amount) AS avg_amount_all_time, max(amount) AS max_amount_all_time,
    stddev_samp(amount) AS amount_stddev_all_time, sum(amount) AS total_spend_all_time,
    avg(txn_count_1h) AS avg_velocity_1h, avg(txn_count_24h) AS avg_velocity_24h,
    avg(txn_count_7d) AS avg_velocity_7d, max(txn_count_1h) AS max_velocity_1h,
    avg(total_amount_24h) AS avg_daily_spend, avg(amount_stddev_24h) AS avg_amount_volatility,
    avg(amount_vs_avg_24h) AS avg_amount_ratio,
    {", ".join(f"avg(V{i}) AS avg_v{i}" for i in range(1, 6))}
  FROM {source} {where} GROUP BY user_id
)"""


_PROFILE_DOUBLES = [
    "avg_amount_all_time",
    "max_amount_all_time",
    "amount_stddev_all_time",
    "total_spend_all_time",
    "avg_velocity_1h",
    "avg_velocity_24h",
    "avg_velocity_7d",
    "avg_daily_spend",
    "avg_amount_volatility",
    "avg_amount_ratio",
    *[f"avg_v{i}" for i in range(1, 6)],
]


def _profiles_out(fill: bool) -> str:
    doubles = ", ".join(
        _r(f"coalesce({c}, 0.0)" if fill else c, 8, c) for c in _PROFILE_DOUBLES
    )
    last = _time("last_transaction_time", "last_transaction_time")
    return f"user_id, total_txn_count, {last}, max_velocity_1h, {doubles}"


_ALL_PROFILES = f"WITH {_FEATURES},{_profiles('features')}"
_PAST = f"{_FEATURES},{_profiles('features', f'WHERE event_time < {_NOW}')}"
# Events with missing accounts and bad labels; unreadable ones are set aside before staging.
_QUARANTINED = (
    _FEATURES.replace("bronze AS (", "arrived AS (", 1)
    .replace(
        "staged AS (",
        """bronze AS (
  SELECT * REPLACE (CASE WHEN V1 <= 3.5 THEN user_id END AS user_id,
                    CAST(CASE WHEN V2 > 3.5 THEN 2 ELSE is_fraud END AS INTEGER) AS is_fraud) FROM arrived
),
staged AS (""",
        1,
    )
    .replace("AS n FROM bronze", "AS n FROM bronze WHERE user_id IS NOT NULL", 1)
)
_FIELDS = ["total_txn_count", "last_transaction_time", "max_velocity_1h", *_PROFILE_DOUBLES]


def _entry(field: str) -> str:
    value = "epoch_us(last_transaction_time) // 1000000" if field == "last_transaction_time" else field
    return (
        f"SELECT 'user_features:' || user_id AS key, '{field}' AS field,"
        f" round(CAST(coalesce({value}, 0) AS DOUBLE), 8) AS value,"
        f" {_time(f'{_NOW} + INTERVAL 86400 SECOND', 'expires_at')} FROM profiles"
    )


_ISO = (
    "CASE WHEN epoch_us({0}) % 1000000 = 0 THEN strftime({0}, '%Y-%m-%dT%H:%M:%S')"
    " ELSE strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00'"
)


_RAW = f"""{_TX},
raw AS (
  SELECT event_id AS row_index, (epoch_us(ts0) - 1704067200000000) / 1000000.0 AS Time, {_VS},
         amount AS Amount, is_fraud AS Class, event_time
  FROM (SELECT *, event_time AS ts0 FROM tx)
),
hashed AS (SELECT *, md5(CAST(row_index AS VARCHAR) || ':' || CAST(Time AS VARCHAR)) AS h FROM raw),
worded AS (
  SELECT *, {", ".join(f"CAST('0x' || substr(h, {8 * w + 1}, 8) AS BIGINT) AS w{w}" for w in range(4))} FROM hashed
),
made AS (
  SELECT *, printf('user_%05d',
    ((((w0 % 5000) * 4294967296 + w1) % 5000 * 4294967296 + w2) % 5000 * 4294967296 + w3) % 5000) AS bucket
  FROM worded
),
evs AS (
  SELECT printf('txn_%08d', row_index) AS transaction_id, bucket AS user_id,
         {_ISO.format("event_time")} AS event_time, Time AS time_offset_seconds, Amount AS amount,
         Class AS is_fraud, {_VS}, row_index, event_time AS moment
  FROM made
),
decoded AS (
  SELECT user_id AS kafka_key, CAST(0 AS INTEGER) AS _kafka_partition, row_index AS _kafka_offset,
         'kafka:transactions' AS _source,
         {", ".join(f"CASE WHEN V1 <= 3.5 THEN {c} END AS {c}" for c in ("transaction_id", "user_id", "time_offset_seconds", "is_fraud"))},
         CASE WHEN V1 <= 3.5 THEN {_TIME.format("moment")} END AS event_time,
         CASE WHEN V1 <= 3.5 AND V2 <= 3.5 THEN amount END AS amount,
         {", ".join(f"CASE WHEN V1 <= 3.5 THEN {v} END AS {v}x" for v in _V)}
  FROM evs
)"""
_DECODED_SQL = f"WITH {_RAW} SELECT * RENAME ({', '.join(f'{v}x AS {v}' for v in _V)}) FROM decoded"

_DIRTY = f"""{_TX},
dirty AS (
  SELECT * REPLACE (
    CASE WHEN event_type <> 'signup' THEN user_id END AS user_id,
    CASE WHEN amount >= 5 THEN amount END AS amount,
    CASE WHEN event_type = 'view' THEN 2 ELSE is_fraud END AS is_fraud)
  FROM (SELECT * FROM tx UNION ALL SELECT * FROM tx WHERE event_type = 'purchase')
)"""


def _check(name: str, column: str, failing: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS \"check\", '{column}' AS \"column\","
        f" count(*) FILTER (WHERE {failing}) AS failures FROM {source}"
    )


def _unique(column: str, source: str) -> str:
    return (
        f"SELECT 'unique' AS \"check\", '{column}' AS \"column\", count(*) AS failures FROM"
        f" (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    )


_BRONZE_CHECKS = [
    *[("not_null", c, f"{c} IS NULL") for c in ("transaction_id", "user_id", "event_time", "amount", "is_fraud")],
    ("accepted_values", "is_fraud", "is_fraud NOT IN (0, 1)"),
]
_FEATURE_CHECKS = [
    *[("not_null", c, f"{c} IS NULL") for c in ("transaction_id", "user_id", "is_fraud")],
    ("accepted_values", "is_fraud", "is_fraud NOT IN (0, 1)"),
    ("expression_true", "txn_count_1h", "NOT txn_count_1h >= 0"),
    ("expression_true", "amount_stddev_24h", "NOT amount_stddev_24h >= 0"),
]
_PROFILE_CHECKS = [
    ("not_null", "user_id", "user_id IS NULL"),
    ("expression_true", "total_txn_count", "NOT total_txn_count > 0"),
]


def _checks(checks: list[tuple[str, str, str]], source: str, unique: str | None = None) -> str:
    parts = [_check(n, c, f, source) for n, c, f in checks]
    if unique:
        parts.append(_unique(unique, source))
    return " UNION ALL ".join(parts)


_CUT = "make_timestamp(min(u) + CAST(round_even((max(u) - min(u)) * 0.8::DOUBLE, 0) AS BIGINT))"
_SPLIT = f"""{_TX},
cut AS (SELECT {_CUT} AS c FROM (SELECT epoch_us(event_time) AS u FROM tx))"""


def _side(name: str, op: str) -> str:
    return (
        f"SELECT '{name}' AS split, count(*) AS rows, CAST(coalesce(sum(is_fraud), 0) AS BIGINT) AS positives,"
        f" round(avg(CAST(is_fraud AS DOUBLE)), 6) AS positive_rate"
        f" FROM tx, cut WHERE event_time {op} c"
    )


_SCORED = """
scored AS (
  SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_fraud,
         CAST((event_id * 7919 + CAST(json_extract_string(props, '$.k') AS BIGINT) * 31) % 1000 AS DOUBLE) / 1000.0
           AS probability
  FROM events
),
flags AS (SELECT is_fraud AS a, CASE WHEN probability >= 0.3 THEN 1 ELSE 0 END AS p FROM scored),
cm AS (
  SELECT count(*) FILTER (WHERE a = 1 AND p = 1) AS hit, count(*) FILTER (WHERE p = 1) AS flagged,
         count(*) FILTER (WHERE a = 1) AS wanted FROM flags
),
tm AS (
  SELECT coalesce(hit / nullif(flagged, 0)::DOUBLE, 0.0) AS precision,
         coalesce(hit / nullif(wanted, 0)::DOUBLE, 0.0) AS recall,
         coalesce(2 * hit / nullif(flagged + wanted, 0)::DOUBLE, 0.0) AS f1 FROM cm
),
points AS (
  SELECT probability AS score, count(*) FILTER (WHERE is_fraud = 1) AS pos,
         count(*) FILTER (WHERE is_fraud = 0) AS neg FROM scored GROUP BY 1
),
curve AS (
  SELECT score, pos, neg, CAST(coalesce(sum(pos) OVER w, 0) AS BIGINT) AS pos_above,
         CAST(coalesce(sum(neg) OVER w, 0) AS BIGINT) AS neg_above
  FROM points
  WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
auc AS (SELECT sum(neg * (pos_above + pos / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS v FROM curve),
ap AS (
  SELECT sum(pos * (pos_above + pos)::DOUBLE / (pos_above + pos + neg_above + neg)) / sum(pos) AS v FROM curve
)"""

_ONLINE = f"""{_PAST},
hashes AS (
  SELECT *, make_timestamp((epoch_us(last_transaction_time) // 1000000 + {3 * _DAY}) * 1000000) AS expires_at
  FROM profiles
),
requests AS (
  SELECT transaction_id, user_id, amount - 5 AS amount, {_VS} FROM tx
),
found AS (
  SELECT r.*, h.user_id IS NOT NULL AS known,
    coalesce(h.avg_velocity_1h, 0.0) AS f1, coalesce(h.avg_velocity_24h, 0.0) AS f24,
    coalesce(h.avg_velocity_7d, 0.0) AS f7, coalesce(h.avg_daily_spend, 0.0) AS spend,
    coalesce(nullif(h.avg_amount_all_time, 0), r.amount) AS usual,
    coalesce(nullif(h.max_amount_all_time, 0), r.amount) AS largest,
    coalesce(h.avg_amount_volatility, 0.0) AS vola, coalesce(h.amount_stddev_all_time, 0.0) AS sd,
    h.avg_amount_all_time AS looked_up
  FROM requests r LEFT JOIN (SELECT * FROM hashes WHERE expires_at > {_NOW}) h ON r.user_id = h.user_id
),
ruled AS (
  SELECT *, CASE WHEN amount / (usual + 0.01) > 2 THEN 0.95::DOUBLE
                 WHEN amount / (usual + 0.01) > 1 THEN 0.4123456::DOUBLE ELSE 0.05::DOUBLE END AS p
  FROM found WHERE amount > 0
)"""
_SOURCE = "CASE WHEN known THEN 'online' ELSE 'cold_start' END AS feature_source"
_DECISION = "CASE WHEN p >= 0.3 THEN 'DECLINE' ELSE 'APPROVE' END AS decision"
_MODEL_V = [f"V{i}" for i in (*range(1, 13), 14, 16, 17, 18, 19, 21)]

_MERGE = f"""{_TX},
stored AS (
  SELECT 'user_features:' || user_id AS key, max(amount) AS mx, count(*) AS seen,
         max(event_time) + INTERVAL 1 DAY AS e
  FROM tx WHERE event_time < {_NOW} GROUP BY user_id
),
alive AS (SELECT * FROM stored WHERE e > {_NOW}),
fresh AS (
  SELECT 'user_features:' || user_id AS key, max(amount) AS mx, count(*) AS n,
         {_NOW} + INTERVAL 1 DAY AS e
  FROM tx WHERE event_time >= {_NOW} - INTERVAL 12 HOUR GROUP BY user_id
),
merged AS (
  SELECT key, coalesce(f.mx, a.mx) AS mx, a.seen, f.n, coalesce(f.e, a.e) AS e
  FROM alive a FULL JOIN fresh f USING (key)
)"""


def _merged(field: str, column: str) -> str:
    return (
        f"SELECT key, '{field}' AS field, round(CAST({column} AS DOUBLE), 8) AS value,"
        f" {_time('e', 'expires_at')} FROM merged WHERE {column} IS NOT NULL"
    )


_ROLLING_OUT = f"""transaction_id, user_id, {_time("event_time", "event_time")}, event_time_unix, amount,
  txn_count_1h, txn_count_24h, txn_count_7d, seconds_since_last_txn, {_SPEND_OUT},
  {_r("max_amount_7d", 8)}, {_r("avg_amount_7d", 8)}, {_r("amount_stddev_24h", 6)}, {_r("amount_stddev_7d", 6)}"""

ORACLES: dict[str, str] = {
    "stage_dedupe": f"""WITH {_STAGED} SELECT {_KEYS}, event_time_unix,
        CAST(event_date AS VARCHAR) AS event_date, amount, is_fraud, {_VS} FROM staged""",
    "velocity": f"""WITH {_FRAMED} SELECT {_KEYS}, txn_count_1h, txn_count_24h, txn_count_7d,
        seconds_since_last_txn FROM framed""",
    "spend": f"""WITH {_FRAMED} SELECT {_KEYS}, {_SPEND_OUT}, {_r("max_amount_7d", 8)},
        {_r(_VS_AVG, 6, "amount_vs_avg_24h")}, {_r(_VS_MAX, 6, "amount_vs_max_7d")} FROM framed""",
    "volatility": f"""WITH {_FRAMED} SELECT {_KEYS}, {_r("amount_stddev_24h", 6)},
        {_r("amount_stddev_7d", 6)}, {_r(_Z, 6, "amount_zscore_7d")} FROM framed""",
    "transaction_features": _FEATURES_SQL,
    "assemble_features": _FEATURES_SQL,
    "rolling_hot_accounts": _FEATURES_SQL,
    "incremental_features": _FEATURES_SQL,
    "rolling_paned": f"WITH {_FRAMED} SELECT {_ROLLING_OUT} FROM framed",
    "rolling_ties_orders": f"""WITH source AS (
          SELECT o_orderkey AS transaction_id, o_custkey AS user_id,
                 epoch_us(o_orderdate) // 1000000 AS event_time_unix, o_totalprice AS amount FROM orders
        ),{_framed("source")}
        SELECT transaction_id, user_id, event_time_unix, txn_count_1h, txn_count_24h, txn_count_7d,
          seconds_since_last_txn, {_r("avg_amount_7d", 8)}, {_r("amount_stddev_7d", 6)} FROM framed""",
    "partitioned_features": f"""WITH {_FEATURES} SELECT transaction_id, user_id, amount, is_fraud,
        {_r("total_amount_24h", 8)} FROM features WHERE is_fraud = 1""",
    "live_features": f"""WITH {_FEATURES} SELECT transaction_id, user_id, txn_count_7d,
        seconds_since_last_txn, {_r("total_amount_24h", 8)}, {_r("amount_zscore_7d", 6)} FROM features""",
    "state_features": f"""WITH {_FEATURES} SELECT transaction_id, user_id, txn_count_7d,
        seconds_since_last_txn, {_r("total_amount_24h", 8)}, {_r("amount_zscore_7d", 6)} FROM features""",
    "state_features_late": f"""WITH {_FEATURES} SELECT transaction_id, user_id, txn_count_7d,
        seconds_since_last_txn, {_r("total_amount_24h", 8)}, {_r("amount_zscore_7d", 6)} FROM features""",
    "account_features": f"{_ALL_PROFILES} SELECT {_profiles_out(True)} FROM profiles",
    "account_features_raw": f"{_ALL_PROFILES} SELECT {_profiles_out(False)} FROM profiles",
    "account_preview": f"{_ALL_PROFILES} SELECT {_profiles_out(True)} FROM profiles ORDER BY user_id LIMIT 5",
    "raw_csv": f"WITH {_RAW} SELECT * EXCLUDE (event_time) FROM raw",
    "account_buckets": f"WITH {_RAW} SELECT row_index, bucket AS user_id FROM made",
    "to_events": f"WITH {_RAW} SELECT * EXCLUDE (row_index, moment) FROM evs",
    "decode_events": _DECODED_SQL,
    "bronze_ingest": _DECODED_SQL,
    "bronze_restart": _DECODED_SQL,
    "bronze_interval": _DECODED_SQL,
    "stream_metrics": f"""WITH {_RAW} SELECT CAST(count(transaction_id) AS BIGINT) AS sent,
        CAST(coalesce(sum(is_fraud), 0) AS BIGINT) AS positives,
        count(*) FILTER (WHERE transaction_id IS NULL) AS errors FROM decoded""",
    "ingest_metrics": f"""WITH {_RAW} SELECT count(transaction_id) AS sent,
        CAST(coalesce(sum(is_fraud), 0) AS BIGINT) AS positives,
        count(*) FILTER (WHERE transaction_id IS NULL) AS errors FROM decoded""",
    "latest_events": f"""WITH {_TX} SELECT {_KEYS}, amount, is_fraud
        FROM (SELECT * FROM tx ORDER BY event_time DESC, transaction_id LIMIT 10)""",
    "dq_report": f"WITH {_DIRTY} "
    + _checks(
        [*_BRONZE_CHECKS, ("expression_true", "amount", "NOT amount >= 40")], "dirty", "transaction_id"
    ),
    "dq_features": f"WITH {_FEATURES} " + _checks(_FEATURE_CHECKS, "features", "transaction_id"),
    "dq_failing_rows": f"""WITH {_DIRTY} SELECT transaction_id, user_id, is_fraud FROM dirty
        WHERE is_fraud NOT IN (0, 1)""",
    "dq_primary_key": f"""WITH {_DIRTY} SELECT transaction_id, count(*) AS count FROM dirty
        GROUP BY 1 HAVING count(*) > 1 OR transaction_id IS NULL""",
    "dq_freshness": f"""WITH {_TX} SELECT {_time("max(ingested_at)", "newest")},
        epoch_us({_NOW}) // 1000000 - epoch_us(max(ingested_at)) // 1000000 AS age_seconds FROM tx""",
    "time_split_point": f"WITH {_SPLIT} SELECT {_time('c', 'split_time')} FROM cut",
    "time_split_summary": f"WITH {_SPLIT} {_side('train', '<')} UNION ALL {_side('test', '>=')}",
    "confusion": f"""WITH {_SCORED} SELECT CAST(g.a AS INTEGER) AS actual, CAST(g.p AS INTEGER) AS predicted,
        (SELECT count(*) FROM flags f WHERE f.a = g.a AND f.p = g.p) AS rows
        FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(a, p)""",
    "threshold_metrics": f"""WITH {_SCORED} SELECT {_r("precision", 6)}, {_r("recall", 6)}, {_r("f1", 6)}
        FROM tm""",
    "roc_auc": f"WITH {_SCORED} SELECT {_r('v', 6, 'roc_auc')} FROM auc",
    "average_precision": f"WITH {_SCORED} SELECT {_r('v', 6, 'average_precision')} FROM ap",
    "score_curve": f"WITH {_SCORED} SELECT * FROM curve",
    "evaluate": f"""WITH {_SCORED}
        SELECT 'roc_auc' AS metric, {_r("v", 6, "value")} FROM auc
        UNION ALL SELECT 'average_precision', round(v, 6) FROM ap
        UNION ALL SELECT 'precision', round(precision, 6) FROM tm
        UNION ALL SELECT 'recall', round(recall, 6) FROM tm
        UNION ALL SELECT 'f1', round(f1, 6) FROM tm
        UNION ALL SELECT 'test_size', CAST(count(*) AS DOUBLE) FROM flags
        UNION ALL SELECT 'test_positives', CAST(sum(a) AS DOUBLE) FROM flags""",
    "online_hashes": f"{_ALL_PROFILES} " + " UNION ALL ".join(_entry(f) for f in _FIELDS),
    "online_written": f"{_ALL_PROFILES} " + " UNION ALL ".join(_entry(f) for f in _FIELDS),
    "online_merge": f"WITH {_MERGE} "
    + " UNION ALL ".join(
        [_merged("max_amount_all_time", "mx"), _merged("seen_before", "seen"), _merged("total_txn_count", "n")]
    ),
    "lookup": f"""WITH {_ONLINE} SELECT transaction_id, user_id, {_SOURCE},
        {_r("looked_up", 8, "avg_amount_all_time")} FROM found""",
    "proxy_vector": f"""WITH {_ONLINE} SELECT transaction_id,
        {_r("f1", 6, "txn_count_1h")}, {_r("f24", 6, "txn_count_24h")}, {_r("f7", 6, "txn_count_7d")},
        {_r("amount * f1", 8, "total_amount_1h")}, {_r("spend", 8, "total_amount_24h")},
        {_r("usual", 8, "avg_amount_24h")}, {_r("largest", 8, "max_amount_24h")},
        {_r("amount", 8, "min_amount_24h")}, {_r("amount / (usual + 0.01)", 6, "amount_vs_avg_24h")},
        {_r("amount / (largest + 0.01)", 6, "amount_vs_max_7d")}, {_r("vola", 6, "amount_stddev_24h")},
        {_r("sd", 6, "amount_stddev_7d")}, {", ".join(_MODEL_V)}, amount FROM found""",
    "score_rule": f"""WITH {_ONLINE} SELECT transaction_id, user_id, amount,
        {_r("p", 4, "fraud_probability")},
        CASE WHEN p >= 0.5 THEN 'HIGH' WHEN p >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
        {_DECISION}, {_SOURCE} FROM ruled""",
    "score_stream": f"""WITH {_ONLINE} SELECT transaction_id, user_id, amount,
        {_r("p", 4, "fraud_probability")},
        CASE WHEN p >= 0.5 THEN 'HIGH' WHEN p >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
        {_DECISION}, {_SOURCE} FROM ruled""",
    "audit_log": f"""WITH {_ONLINE} SELECT 'fraud_decision' AS event, transaction_id, user_id, amount,
        {_r("p", 4, "fraud_probability")}, {_DECISION}, 0.3::DOUBLE AS threshold, {_SOURCE},
        '2024-01-25T00:00:00Z' AS timestamp FROM ruled""",
    "rejected": f"WITH {_ONLINE} SELECT transaction_id, user_id, amount FROM requests WHERE NOT amount > 0",
    "smote_counts": f"""WITH {_TX}, sizes AS (
          SELECT count(*) FILTER (WHERE rare) AS few, count(*) FILTER (WHERE NOT rare) AS many
          FROM (SELECT is_fraud = 1 AND amount > 60 AS rare FROM tx))
        SELECT *, rows AS finite_rows FROM (
          SELECT CAST(0 AS INTEGER) AS is_fraud, many AS rows FROM sizes
          UNION ALL
          SELECT CAST(1 AS INTEGER), greatest(few, CAST(floor(many * 0.1::DOUBLE) AS BIGINT)) FROM sizes)""",
    "smote_rows": f"""WITH {_TX}, sizes AS (
          SELECT count(*) FILTER (WHERE rare) AS few, count(*) FILTER (WHERE NOT rare) AS many
          FROM (SELECT is_fraud = 1 AND amount > 60 AS rare FROM tx)),
        planned AS (
          SELECT few, unnest(range(greatest(0, CAST(floor(many * 0.1::DOUBLE) AS BIGINT) - few))) AS i FROM sizes),
        digests AS (
          SELECT i, few, md5('42:base:' || i) AS b, md5('42:neighbour:' || i) AS n, md5('42:gap:' || i) AS g FROM planned)
        SELECT i, CAST('0x' || b[1:15] AS BIGINT) % few AS index,
               CAST(CAST('0x' || n[1:15] AS BIGINT) % 5 + 1 AS INTEGER) AS which,
               CAST('0x' || g[1:13] AS BIGINT) / 4503599627370496.0::DOUBLE AS gap,
               true AS between_positives, true AS on_segment FROM digests""",
    "smote_neighbours": f"""WITH {_FEATURES}, positive AS (
          SELECT transaction_id, [{_INPUTS}] AS v FROM features WHERE is_fraud = 1 AND amount > 60),
        apart AS (
          SELECT a.transaction_id, sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS distance
          FROM positive a JOIN positive b ON a.transaction_id <> b.transaction_id)
        SELECT transaction_id, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance
        FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY distance) AS rank FROM apart) WHERE rank <= 5""",
    "gbt_score": f"""WITH {_SPLIT} SELECT transaction_id, CAST(is_fraud = 1 AND amount > 60 AS INTEGER) AS is_fraud,
        true AS in_range, true AS same_by_nodes FROM tx, cut WHERE event_time >= c""",
    "importances": """SELECT CAST(i + 1 AS INTEGER) AS rank, true AS ordered, true AS same_by_nodes, 1.0::DOUBLE AS total
        FROM range(31) t(i)""",
    "training_report": f"""WITH {_SPLIT}, test AS (
          SELECT CASE WHEN is_fraud = 1 AND amount > 60 THEN 1 ELSE 0 END AS rare FROM tx, cut WHERE event_time >= c)
        SELECT 'test_size' AS metric, CAST(count(*) AS DOUBLE) AS value FROM test
        UNION ALL SELECT 'test_positives', CAST(sum(rare) AS DOUBLE) FROM test
        UNION ALL SELECT 'scored_by_saved_model', CAST(count(*) AS DOUBLE) FROM test
        UNION ALL SELECT * FROM (VALUES ('outside_0_1', 0.0::DOUBLE), ('importances_sum', 1.0::DOUBLE),
                                        ('auc_above_half', 1.0::DOUBLE))""",
    "csv_first_rows": f"WITH {_RAW} SELECT * EXCLUDE (event_time) FROM raw WHERE row_index < 100",
    "topic_files": f"WITH {_RAW} SELECT user_id, transaction_id, amount, event_time, true AS stamped FROM evs",
    "schema_contract": _ALL_PROFILES
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {str(there).lower()} AS present, count(*) AS total,
            {f"count({c})" if there else "CAST(0 AS BIGINT)"} AS filled FROM profiles"""
        for c, there in (
            *((c, c != "avg_v3") for c in _PROFILE_DOUBLES),
            ("user_id", True), ("total_txn_count", True), ("last_transaction_time", True), ("max_velocity_1h", False),
        )
    ),
    "refresh_report": f"WITH {_QUARANTINED},{_profiles('features')} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", *, false AS published FROM ({sql})"
        for name, sql in (
            ("bronze", _checks(_BRONZE_CHECKS, "bronze")),
            ("transaction_features", _checks(_FEATURE_CHECKS, "features", "transaction_id")),
            ("account_features", _checks(_PROFILE_CHECKS, "profiles", "user_id")),
            ("account_contract", "SELECT 'required_columns' AS \"check\", '*' AS \"column\", CAST(0 AS BIGINT) AS failures"),
        )
    ),
    "publish_report": f"""WITH {_TX}, held AS (
          SELECT 'whole' AS what, count(DISTINCT user_id) AS accounts, count(*) AS transactions FROM tx
          UNION ALL SELECT 'part', count(DISTINCT user_id), count(*) FROM tx WHERE V1 <= 0),
        steps(place, step, done, registered_from, published_from) AS (
          VALUES (0, 'create', true, 'whole', 'whole'), (1, 'create_again', true, 'whole', 'part'), (2, 'dirty', false, 'whole', 'part'),
                 (3, 'refresh', true, 'part', 'part'), (4, 'roll_back', true, 'part', 'part'))
        SELECT CAST(place AS INTEGER) AS place, step, done, r.accounts, CAST(r.transactions AS BIGINT) AS transactions,
               p.transactions AS published_rows, true AS registered
        FROM steps JOIN held r ON r.what = registered_from JOIN held p ON p.what = published_from""",
}
