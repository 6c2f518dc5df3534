"""The SQL each query is checked against, written apart from the queries:
duplicates by ``row_number``, the as-of join by ``ASOF``, and so on."""

from __future__ import annotations

_TX_BASE = """
tx_base AS (
  SELECT event_id AS transaction_id,
         date_trunc('second', ts)::TIMESTAMP AS tx_datetime,
         user_id AS customer_id,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id % 500 END AS terminal_id,
         CASE WHEN user_id = 0 THEN value * 50
              WHEN event_id % 89 = 0 THEN -value
              WHEN event_id % 83 = 0 THEN 0.0::DOUBLE
              ELSE value END::DOUBLE AS tx_amount,
         (epoch(date_trunc('second', ts)) - 1704067200
           + CASE WHEN event_id % 103 = 0 THEN 60 ELSE 0 END)::BIGINT AS tx_time_seconds,
         floor((epoch(date_trunc('second', ts)) - 1704067200) / 86400.0)::INTEGER AS tx_time_days,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END::INTEGER AS tx_fraud,
         CASE WHEN event_type = 'error' THEN 1 + event_id % 3
              WHEN event_id % 101 = 0 THEN 2 ELSE 0 END::INTEGER AS tx_fraud_scenario
  FROM events
)"""

_TX_RAW = (
    _TX_BASE
    + """,
tx_raw AS (
  SELECT * FROM tx_base
  UNION ALL SELECT * FROM tx_base WHERE transaction_id % 50 = 0
  UNION ALL SELECT * REPLACE (tx_datetime - INTERVAL 1 HOUR AS tx_datetime, -abs(tx_amount) - 1 AS tx_amount)
            FROM tx_base WHERE transaction_id % 41 = 0
  UNION ALL SELECT * REPLACE (tx_datetime + INTERVAL 1 HOUR AS tx_datetime)
            FROM tx_base WHERE transaction_id % 43 = 0
  UNION ALL SELECT * REPLACE (abs(tx_amount) + 5 AS tx_amount)
            FROM tx_base WHERE transaction_id % 47 = 0
)"""
)

_FEATURES = """
stats AS (
  SELECT user_id AS driver_id,
         date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS event_timestamp,
         date_trunc('day', ts)::TIMESTAMP + INTERVAL 25 HOUR AS created,
         count(*) FILTER (WHERE event_type = 'purchase') / count(*)::DOUBLE AS conv_rate,
         1 - count(*) FILTER (WHERE event_type = 'error') / count(*)::DOUBLE AS acc_rate,
         count(*)::INTEGER AS avg_daily_trips
  FROM events GROUP BY ALL
),
entities AS (
  SELECT event_id AS entity_id, user_id AS driver_id, ts AS event_timestamp
  FROM events WHERE event_type = 'purchase'
)"""

_ORDER = "tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario"
_COMPLETE = " AND ".join(
    f"{c} IS NOT NULL"
    for c in (
        "transaction_id tx_datetime customer_id terminal_id tx_amount "
        "tx_time_seconds tx_time_days tx_fraud tx_fraud_scenario"
    ).split()
)


def _tx(body: str) -> str:
    return f"WITH {_TX_RAW}\n{body}"


def _steps(last: str) -> str:
    """Steps up to key dedupe, then ``s1``..``s3`` by ``last``."""
    return _tx("").rstrip() + f""",
s_na AS (SELECT * FROM tx_raw WHERE {_COMPLETE}),
s_full AS (SELECT DISTINCT * FROM s_na),
s_key AS (SELECT * FROM s_full
          QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {_ORDER}) = 1),
s_amount AS (SELECT * FROM s_key WHERE tx_amount > 0),
{last}"""


_TRIM = (
    "SELECT * FROM {src} WHERE tx_amount BETWEEN "
    "(SELECT avg(tx_amount) - 3 * stddev_samp(tx_amount) FROM {src}) AND "
    "(SELECT avg(tx_amount) + 3 * stddev_samp(tx_amount) FROM {src})"
)
_STEPS_A = _steps(
    f"s_sigma AS ({_TRIM.format(src='s_amount')}),\n"
    "s_customer AS (SELECT * FROM s_sigma WHERE customer_id > 0)\n"
)
_STEPS_B = _steps(
    "s_customer AS (SELECT * FROM s_amount WHERE customer_id > 0),\n"
    f"s_sigma AS ({_TRIM.format(src='s_customer')})\n"
)


def _report(steps: str, order: list[str]) -> str:
    tables = ["tx_raw", "s_na", "s_full", "s_key", *[f"s_{s}" for s in order]]
    names = ["input", "dropna", "dedup_full", "dedup_key", *order]
    rows = "\nUNION ALL ".join(
        f"SELECT {i}::INTEGER AS step_no, '{n}' AS step, (SELECT count(*) FROM {t}) AS rows_out, "
        f"round(1 - (SELECT count(*) FROM {t}) / (SELECT count(*) FROM tx_raw)::DOUBLE, 6) AS removed_share"
        for i, (n, t) in enumerate(zip(names, tables))
    )
    return steps + rows


def _check(name: str, predicate: str) -> str:
    return _tx(f"SELECT '{name}' AS \"check\", count(*) FILTER (WHERE {predicate}) AS rows FROM tx_raw")


_LIMITS = """,
limits AS (
  SELECT greatest(avg(tx_amount) - 3 * stddev_samp(tx_amount), 0.0) AS lower,
         avg(tx_amount) + 3 * stddev_samp(tx_amount) AS upper FROM tx_raw
)"""
_OUTSIDE = "(tx_amount > (SELECT upper FROM limits) OR tx_amount < (SELECT lower FROM limits))"
_SKEW_TOP = (
    "SELECT (epoch(tx_datetime)::BIGINT - tx_time_seconds) AS seconds_diff, count(*) AS \"count\" "
    "FROM tx_raw GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
)


def _profile() -> str:
    columns = _COMPLETE.replace(" IS NOT NULL", "").split(" AND ")
    one = [("table", "rows", "count(*)")]
    one += [("nulls", c, f"count(*) FILTER (WHERE {c} IS NULL)") for c in columns]
    one += [("nan", "tx_amount", "count(*) FILTER (WHERE isnan(tx_amount))")]
    one += [
        ("checks", name, f"count(*) FILTER (WHERE {test})")
        for name, test in {
            "negative_amount": "tx_amount < 0",
            "zero_amount": "tx_amount = 0",
            "negative_customer": "customer_id < 0",
            "zero_customer": "customer_id = 0",
            "future_dates": "tx_datetime > TIMESTAMP '2024-01-15'",
            "scenario_without_fraud": "tx_fraud = 0 AND tx_fraud_scenario <> 0",
        }.items()
    ]
    one += [
        ("tx_amount", m, f"{f}(tx_amount)")
        for m, f in {"mean": "avg", "stddev": "stddev_samp", "min": "min", "max": "max"}.items()
    ]
    one += [("tx_time_days", m, f"{m}(tx_time_days)") for m in ("min", "max")]
    one += [
        ("outliers", "lower", "(SELECT lower FROM limits)"),
        ("outliers", "upper", "(SELECT upper FROM limits)"),
        ("outliers", "outliers", f"count(*) FILTER (WHERE {_OUTSIDE})"),
        ("outliers", "share", f"count(*) FILTER (WHERE {_OUTSIDE}) / count(*)::DOUBLE"),
        ("duplicates", "surplus_rows", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM tx_raw))"),
        (
            "duplicates",
            "repeated_keys",
            "(SELECT count(*) FROM (SELECT 1 FROM tx_raw GROUP BY transaction_id HAVING count(*) > 1))",
        ),
    ]
    one += [
        ("distinct", c, f"count(DISTINCT {c})")
        for c in ("customer_id", "terminal_id", "tx_fraud", "tx_fraud_scenario")
    ]
    parts = [
        f"SELECT '{check}' AS \"check\", '{metric}' AS metric, round(({sql})::DOUBLE, 6) AS value"
        + ("" if sql.startswith("(SELECT") else " FROM tx_raw")
        for check, metric, sql in one
    ]
    parts += [
        f"SELECT '{c}', {c}::VARCHAR, count(*)::DOUBLE FROM tx_raw GROUP BY {c}"
        for c in ("tx_fraud", "tx_fraud_scenario")
    ]
    parts.append(f"SELECT 'seconds_diff', seconds_diff::VARCHAR, \"count\"::DOUBLE FROM ({_SKEW_TOP})")
    return _tx("").rstrip() + _LIMITS + "\n" + "\nUNION ALL ".join(parts)


_DAYS = """SELECT strftime(tx_datetime, '%Y-%m-%d') AS date, count(*) AS total,
       count(*) FILTER (WHERE tx_fraud = 1) AS fraud,
       round(count(*) FILTER (WHERE tx_fraud = 1) / count(*)::DOUBLE * 100, 2) AS fraud_percent
FROM {src} WHERE tx_datetime IS NOT NULL AND tx_fraud IS NOT NULL GROUP BY 1 ORDER BY 1"""

_JOINED = """,
joined AS (
  SELECT e.*, s.event_timestamp AS found_at, s.created AS s_created, s.conv_rate, s.acc_rate, s.avg_daily_trips
  FROM entities e ASOF LEFT JOIN stats s
    ON e.driver_id = s.driver_id AND e.event_timestamp >= s.event_timestamp
)"""


def _masked(stats_ttl: str, activity_ttl: str) -> str:
    ok = f"found_at >= event_timestamp - INTERVAL {stats_ttl}"
    act = f"found_at >= event_timestamp - INTERVAL {activity_ttl}"
    return f"""WITH {_FEATURES}{_JOINED},
masked AS (
  SELECT entity_id, driver_id, event_timestamp,
         CASE WHEN {ok} THEN conv_rate END AS conv,
         CASE WHEN {ok} THEN acc_rate END AS acc,
         CASE WHEN {ok} THEN avg_daily_trips END AS trips,
         CASE WHEN {act} THEN found_at END AS act_time,
         CASE WHEN {act} THEN s_created END AS act_created
  FROM joined
)
"""


_KEYS = "entity_id, driver_id, event_timestamp"
_STATS = (
    "round(conv, 6) AS driver_stats__conv_rate, round(acc, 6) AS driver_stats__acc_rate, "
    "trips AS driver_stats__avg_daily_trips"
)
_ACTIVITY = "act_time AS driver_activity__event_timestamp, act_created AS driver_activity__created"
_SCORE = (
    "round(conv * conv + acc * (SELECT avg(trips) FROM {src}) / nullif(trips, 0), 6) "
    "AS activity_score__activity_score"
)
_SNAPSHOT = """
snap AS (
  SELECT * FROM stats
  WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-15'
  QUALIFY row_number() OVER (PARTITION BY driver_id ORDER BY event_timestamp DESC) = 1
)"""
_TX_ROWS = _tx("SELECT * FROM tx_raw")
_SURPLUS = "SELECT * FROM tx_raw EXCEPT ALL SELECT DISTINCT * FROM tx_raw"
_DAY_NAMES = "SELECT DISTINCT tx_time_days FROM tx_raw ORDER BY 1"
_LINEITEM_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
)


def _feature_columns() -> str:
    columns = {
        "driver_id": "bigint",
        "event_timestamp": "timestamp_ntz",
        "created": "timestamp_ntz",
        "conv_rate": "double",
        "acc_rate": "double",
        "avg_daily_trips": "int",
    }
    return f"WITH {_FEATURES}\n" + "\nUNION ALL ".join(
        f"SELECT {i}::INTEGER AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM stats"
        for i, (c, t) in enumerate(columns.items())
    )


ORACLE: dict[str, str] = {
    "src_csv_roundtrip": _TX_ROWS,
    "src_csv_malformed": _tx(
        "SELECT w IN (3, 4) AS unreadable, count(*) AS lines, "
        "sum(CASE WHEN w <> 4 THEN customer_id END)::BIGINT AS customers, count(*) FILTER (w NOT IN (3, 4)) AS times "
        "FROM (SELECT *, CASE WHEN transaction_id % 10 = 0 THEN transaction_id // 10 % 5 ELSE -1 END AS w FROM tx_raw) GROUP BY 1"
    ),
    "src_rejects": _tx("SELECT transaction_id, transaction_id % 10 = 3 AS rejected, true AS named FROM tx_raw"),
    "src_glob_union": _TX_ROWS,
    "src_select_latest": _tx("SELECT * FROM tx_raw WHERE tx_time_days = (SELECT max(tx_time_days) FROM tx_raw)"),
    "src_select_first_n": _tx(f"SELECT * FROM tx_raw WHERE tx_time_days IN ({_DAY_NAMES} LIMIT 3)"),
    "sink_parquet_roundtrip": _TX_ROWS,
    "sink_partitioned_roundtrip": _TX_ROWS,
    "sink_versioned_roundtrip": _TX_ROWS,
    "prof_nulls": _tx(
        "SELECT "
        + ", ".join(
            f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
            for c in _COMPLETE.replace(" IS NOT NULL", "").split(" AND ")
        )
        + " FROM tx_raw"
    ),
    "prof_amount_stats": _tx(
        "SELECT round(avg(tx_amount), 6) AS mean, round(stddev_samp(tx_amount), 6) AS stddev, "
        "round(min(tx_amount), 6) AS min, round(max(tx_amount), 6) AS max FROM tx_raw"
    ),
    "prof_days_range": _tx("SELECT min(tx_time_days) AS min, max(tx_time_days) AS max FROM tx_raw"),
    "prof_distinct_exact": _tx(
        "SELECT count(DISTINCT customer_id) AS unique_customer_id, count(DISTINCT terminal_id) AS unique_terminal_id, "
        "count(DISTINCT tx_fraud) AS unique_tx_fraud, "
        "count(DISTINCT tx_fraud_scenario) AS unique_tx_fraud_scenario FROM tx_raw"
    ),
    "prof_distinct_approx": _tx(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n, true AS near FROM tx_raw"
            for c in ("customer_id", "terminal_id", "tx_fraud", "tx_fraud_scenario")
        )
    ),
    "prof_distinct_merged": _tx(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n, true AS near FROM tx_raw"
            for c in ("customer_id", "terminal_id", "tx_fraud", "tx_fraud_scenario")
        )
    ),
    "prof_fraud_dist": _tx('SELECT tx_fraud, count(*) AS "count" FROM tx_raw GROUP BY 1 ORDER BY 1'),
    "prof_scenario_dist": _tx('SELECT tx_fraud_scenario, count(*) AS "count" FROM tx_raw GROUP BY 1 ORDER BY 1'),
    "prof_outliers": _tx("").rstrip()
    + _LIMITS
    + f"""
SELECT round((SELECT lower FROM limits), 6) AS lower, round((SELECT upper FROM limits), 6) AS upper,
       count(*) FILTER (WHERE {_OUTSIDE}) AS outliers, count(*) AS rows,
       round(count(*) FILTER (WHERE {_OUTSIDE}) / count(*)::DOUBLE, 6) AS share FROM tx_raw""",
    "prof_outlier_rows": _tx("").rstrip() + _LIMITS + f"\nSELECT * FROM tx_raw WHERE {_OUTSIDE}",
    "prof_time_skew_top": _tx(_SKEW_TOP),
    "prof_bad_timestamps": _check("bad_timestamps", "transaction_id % 211 = 0"),
    "prof_all_checks": _profile(),
    "prof_text_once": _profile(),
    "prof_moments_merged": _tx(
        "SELECT round(m, 6) AS mean, round(s, 6) AS stddev, round(m - 3 * s, 6) AS lower, round(m + 3 * s, 6) AS upper "
        "FROM (SELECT avg(tx_amount) AS m, stddev_samp(tx_amount) AS s FROM tx_raw WHERE NOT isnan(tx_amount))"
    ),
    "check_dup_rows": _tx(
        "SELECT (SELECT count(*) FROM tx_raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM tx_raw)) AS surplus_rows"
    ),
    "check_dup_rows_exceptall": _tx(f"SELECT count(*) AS surplus_rows FROM ({_SURPLUS})"),
    "set_multiset_difference": _tx(_SURPLUS),
    "set_surplus_rows": _tx(
        "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY transaction_id, {_ORDER}) AS rn FROM tx_raw) WHERE rn > 1"
    ),
    "check_dup_keys": _tx(
        "SELECT count(*) AS repeated_keys FROM "
        "(SELECT transaction_id FROM tx_raw GROUP BY transaction_id HAVING count(*) > 1)"
    ),
    "check_negative_amount": _check("negative_amount", "tx_amount < 0"),
    "check_zero_amount": _check("zero_amount", "tx_amount = 0"),
    "check_negative_customer": _check("negative_customer", "customer_id < 0"),
    "check_zero_customer": _check("zero_customer", "customer_id = 0"),
    "check_future_dates": _check("future_dates", "tx_datetime > TIMESTAMP '2024-01-15'"),
    "check_fraud_consistency": _check("scenario_without_fraud", "tx_fraud = 0 AND tx_fraud_scenario <> 0"),
    "clean_dropna": _tx(f"SELECT * FROM tx_raw WHERE {_COMPLETE}"),
    "clean_dedup_full": _tx("SELECT DISTINCT * FROM tx_raw"),
    "clean_dedup_key": _tx(
        "SELECT * FROM tx_raw QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY "
        + ", ".join(f"{c} NULLS FIRST" for c in _ORDER.split(", "))
        + ") = 1"
    ),
    "clean_dedup_key_lineitem": "SELECT * FROM lineitem QUALIFY row_number() OVER "
    f"(PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINEITEM_ORDER}) = 1",
    "clean_positive": _tx("SELECT * FROM tx_raw WHERE tx_amount > 0 AND customer_id > 0"),
    "clean_sigma_merged": _tx(_TRIM.format(src="tx_raw")),
    "clean_sigma": _tx(_TRIM.format(src="tx_raw")),
    "clean_pipeline_a": _STEPS_A + "SELECT * FROM s_customer",
    "clean_pipeline_b": _STEPS_B + "SELECT * FROM s_sigma",
    "clean_report": _report(_STEPS_B, ["amount", "customer", "sigma"]),
    "clean_report_sigma_first": _report(_STEPS_A, ["amount", "sigma", "customer"]),
    "fraud_by_day": _tx(_DAYS.format(src="tx_raw")),
    "fraud_by_day_cleaned": _STEPS_B + _DAYS.format(src="s_sigma"),
    "tx_by_hour": _tx(
        "SELECT hour(tx_datetime)::INTEGER AS hour, count(*) AS \"count\" FROM tx_raw "
        "WHERE tx_datetime IS NOT NULL AND tx_fraud IS NOT NULL GROUP BY 1 ORDER BY 1"
    ),
    "feat_source_profile": _feature_columns(),
    "feat_entity_latest": f"WITH {_FEATURES}\nSELECT driver_id, max(event_timestamp) AS event_timestamp "
    "FROM stats GROUP BY 1 ORDER BY 1 LIMIT 3",
    "feat_entity_frame": f"WITH {_FEATURES}\nSELECT driver_id, max(event_timestamp) AS event_timestamp "
    "FROM stats GROUP BY 1",
    "feat_group_max": f"WITH {_FEATURES}\nSELECT driver_id, event_timestamp, created, "
    "round(conv_rate, 6) AS conv_rate, round(acc_rate, 6) AS acc_rate, avg_daily_trips, "
    "max(event_timestamp) OVER (PARTITION BY driver_id) AS latest FROM stats",
    "feat_historical": _masked("365 DAY", "30 DAY") + f"SELECT {_KEYS}, {_STATS} FROM masked",
    "feat_historical_ttl": _masked("36 HOUR", "30 DAY") + f"SELECT {_KEYS}, {_STATS} FROM masked",
    "feat_historical_sliced": _masked("36 HOUR", "30 DAY") + f"SELECT {_KEYS}, {_STATS} FROM masked",
    "feat_historical_multi": _masked("3 DAY", "36 HOUR")
    + f"SELECT {_KEYS}, {_STATS}, {_ACTIVITY}, {_SCORE.format(src='masked')} FROM masked",
    "feat_historical_two_sources": _masked("36 HOUR", "30 DAY")
    + f""", spending AS (
  SELECT o_custkey AS driver_id, o_orderdate + INTERVAL 8400 DAY AS since, count(*) AS n, sum(o_totalprice) AS worth
  FROM orders GROUP BY ALL
), spent AS (
  SELECT m.*, p.since >= m.event_timestamp - INTERVAL 60 DAY AS valid, p.n, p.worth
  FROM masked m ASOF LEFT JOIN spending p ON m.driver_id = p.driver_id AND m.event_timestamp >= p.since
)
SELECT {_KEYS}, {_STATS}, CASE WHEN valid THEN n END AS spending__n_orders,
       round(CASE WHEN valid THEN worth END, 6) AS spending__spent FROM spent""",
    "feat_activity_score": _masked("36 HOUR", "30 DAY")
    + f"SELECT {_KEYS}, {_SCORE.format(src='masked')} FROM masked",
    "feat_activity_score_batch": _masked("36 HOUR", "30 DAY")
    + f"SELECT {_KEYS}, {_SCORE.format(src='masked')} FROM masked",
    "feat_materialize": f"WITH {_FEATURES},{_SNAPSHOT}\nSELECT driver_id, round(conv_rate, 6) AS conv_rate, "
    "round(acc_rate, 6) AS acc_rate, avg_daily_trips, event_timestamp AS found_at FROM snap",
    "feat_materialize_two_ranges": f"WITH {_FEATURES},{_SNAPSHOT}\nSELECT driver_id, round(conv_rate, 6) AS conv_rate, "
    "round(acc_rate, 6) AS acc_rate, avg_daily_trips, event_timestamp AS found_at FROM snap",
    "feat_online_lookup": f"""WITH {_FEATURES},{_SNAPSHOT},
looked AS (
  SELECT e.entity_id, e.driver_id, s.conv_rate AS conv, s.acc_rate AS acc, s.avg_daily_trips AS trips,
         s.event_timestamp AS act_time, s.created AS act_created
  FROM entities e LEFT JOIN snap s ON e.driver_id = s.driver_id
)
SELECT entity_id, driver_id, {_STATS}, {_ACTIVITY}, {_SCORE.format(src='looked')} FROM looked""",
}
