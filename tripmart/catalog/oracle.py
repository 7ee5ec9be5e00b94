"""The registered queries in SQL over the driver tables, for comparison in another engine."""

from __future__ import annotations

from tripmart.plans.models import FACT_COLUMNS
from tripmart.sources.schema import TRIP_COLUMNS

RUN = "'yellow' AS service, 2026 AS source_year, 1 AS source_month"
INGESTED = "TIMESTAMP '2026-01-03 10:00:00'"
DATES = "pickup_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"
AT_ZONE = "(pickup_zone_id = 5 OR dropoff_zone_id = 5)"

TYPED = [column.name for column in TRIP_COLUMNS]
MEASURES = ["duration_minutes", "average_speed_mph", "revenue_per_mile"]
FACT = list(FACT_COLUMNS)


def names(*columns: str) -> str:
    return ", ".join(columns)


# Rules in reason order, as (name, condition); the last two only warn.
RULES = [
    ("missing_pickup_datetime", "pickup_datetime IS NULL"),
    ("missing_dropoff_datetime", "dropoff_datetime IS NULL"),
    ("pickup_after_dropoff", "pickup_datetime > dropoff_datetime"),
    ("duration_out_of_range", "duration_minutes NOT BETWEEN 0 AND 1440"),
    ("missing_trip_distance", "trip_distance IS NULL"),
    ("negative_trip_distance", "trip_distance < 0"),
    ("missing_fare_amount", "fare_amount IS NULL"),
    ("negative_fare_amount", "fare_amount < 0"),
    ("missing_total_amount", "total_amount IS NULL"),
    ("negative_total_amount", "total_amount < 0"),
    ("negative_passenger_count", "passenger_count < 0"),
    ("invalid_pickup_zone", "coalesce(pickup_zone_id NOT IN (SELECT location_id FROM zone_ref), true)"),
    ("invalid_dropoff_zone", "coalesce(dropoff_zone_id NOT IN (SELECT location_id FROM zone_ref), true)"),
    ("unreasonable_average_speed", "average_speed_mph > 100"),
    ("zero_duration_positive_distance", "duration_minutes = 0 AND trip_distance > 0"),
    ("duplicate_record", "copy_no > 1"),
]
FLAGS = names(*[f"coalesce({test}, false) AS r{i}" for i, (_, test) in enumerate(RULES)])
REASONS = names(*[f"if(r{i}, '{name}', NULL)" for i, (name, _) in enumerate(RULES)])
REJECTS = " OR ".join(f"r{i}" for i in range(14))


def _total(column: str, alias: str) -> str:
    return f"round(sum({column}), 2) AS {alias}"


def _mean(column: str, alias: str) -> str:
    return f"round(avg({column}) + 1e-9, 6) AS {alias}"


PASSENGERS = "round(coalesce(sum(passenger_count), 0), 2)::DOUBLE AS passenger_count"

# Named steps; every oracle query is a WITH list of these and a final SELECT.
STEPS = {
    "mixed": """
        SELECT l.*, o_custkey, o_orderdate,
               l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7 + l_suppkey * 3 AS h,
               (l_partkey * 7 + l_linenumber * 131 + l_orderkey) % 10000 + 250 AS cents
        FROM lineitem l JOIN orders ON o_orderkey = l_orderkey""",
    "timed": """
        SELECT *, h % 86400 AS start_s,
               CASE WHEN h % 101 = 0 THEN 0 WHEN h % 103 = 0 THEN -600 WHEN h % 107 = 0 THEN 90000
                    WHEN h % 109 = 0 THEN 60 ELSE 600 + h % 5400 END AS span_s
        FROM mixed""",
    "copied": """
        SELECT *, 0 AS copy FROM timed UNION ALL SELECT *, 1 FROM timed WHERE h % 89 = 0""",
    "trips": """
        SELECT ((l_orderkey * 8 + l_linenumber) * 2 + copy)::BIGINT AS source_row_number,
               (1 + l_linenumber % 2)::BIGINT AS vendor_id,
               if(h % 211 = 0, NULL, o_orderdate + to_seconds(start_s)) AS pickup_datetime,
               if(h % 223 = 0, NULL, o_orderdate + to_seconds(start_s + span_s)) AS dropoff_datetime,
               CASE WHEN h % 97 = 0 THEN -1 WHEN h % 13 = 0 THEN NULL ELSE l_linenumber % 6 END::DOUBLE
                   AS passenger_count,
               CASE WHEN h % 113 = 0 THEN -1 WHEN h % 127 = 0 THEN NULL WHEN h % 53 = 0 THEN 0
                    ELSE l_quantity / 4 END::DOUBLE AS trip_distance,
               if(h % 41 = 0, NULL, 1 + h % 6)::INTEGER AS rate_code_id,
               l_returnflag AS store_and_fwd_flag,
               if(h % 131 = 0, 999, 1 + l_suppkey % 25)::INTEGER AS pickup_zone_id,
               CASE WHEN h % 137 = 0 THEN 999 WHEN h % 139 = 0 THEN NULL ELSE 1 + o_custkey % 25 END::INTEGER
                   AS dropoff_zone_id,
               if(h % 43 = 0, NULL, h % 5)::INTEGER AS payment_type,
               CASE WHEN h % 151 = 0 THEN NULL WHEN h % 149 = 0 THEN -cents ELSE cents END / 100::DOUBLE
                   AS fare_amount,
               0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax,
               (h % 200) / 100::DOUBLE AS tip_amount,
               if(l_linestatus = 'F', 655, 0) / 100::DOUBLE AS tolls_amount,
               1::DOUBLE AS improvement_surcharge,
               CASE WHEN h % 163 = 0 THEN NULL WHEN h % 157 = 0 THEN -cents ELSE cents + 250 END / 100::DOUBLE
                   AS total_amount,
               0::DOUBLE AS congestion_surcharge, 0::DOUBLE AS airport_fee,
               o_orderdate
        FROM copied""",
    "zone_ref": """
        SELECT (n_nationkey + 1)::INTEGER AS location_id, r_name AS borough, n_name AS zone_name,
               if(n_nationkey + 1 IN (5, 13), 'Airports', 'Zone') AS service_zone
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "hashed": f"""
        SELECT *, md5(concat_ws(chr(31), {names(*[f"coalesce({c}::VARCHAR, '<NULL>')" for c in TYPED])}))
                      AS stable_record_hash,
               date_diff('second', pickup_datetime, dropoff_datetime) AS seconds
        FROM trips""",
    "measured": """
        SELECT *, seconds / 60.0::DOUBLE AS duration_minutes,
               if(seconds > 0, trip_distance / (seconds / 3600.0::DOUBLE), NULL) AS average_speed_mph,
               if(trip_distance > 0, total_amount / trip_distance, NULL) AS revenue_per_mile,
               row_number() OVER (PARTITION BY stable_record_hash ORDER BY source_row_number) AS copy_no
        FROM hashed""",
    "flagged": f"SELECT *, {FLAGS} FROM measured",
    "judged": f"""
        SELECT stable_record_hash || '-' || lpad(copy_no::VARCHAR, 4, '0') AS trip_id, stable_record_hash,
               source_row_number, {names(*TYPED, *MEASURES)},
               pickup_zone_id IN (5, 13) OR dropoff_zone_id IN (5, 13) AS is_airport_trip,
               CASE WHEN {REJECTS} THEN 'rejected' WHEN r14 OR r15 THEN 'warning' ELSE 'valid' END
                   AS quality_status,
               concat_ws('|', {REASONS}) AS quality_reasons,
               {RUN}, 'lineitem' AS source_file, {INGESTED} AS ingested_at
        FROM flagged""",
    "staged": "SELECT * FROM judged WHERE quality_status IN ('valid', 'warning')",
    "stg": """
        SELECT * REPLACE (coalesce(rate_code_id, 0) AS rate_code_id, coalesce(payment_type, 0) AS payment_type)
        FROM staged""",
    "fact": f"""
        SELECT {names(*FACT)}
        FROM (SELECT *, pickup_datetime::DATE AS pickup_date, hour(pickup_datetime)::INTEGER AS pickup_hour
              FROM stg)""",
    "dimz": """
        SELECT location_id AS zone_id, borough, zone_name, service_zone, location_id IN (5, 13) AS is_airport_zone
        FROM zone_ref""",
    "daily": f"""
        SELECT pickup_date, count(*) AS trip_count, {PASSENGERS}, {_total("trip_distance", "trip_distance")},
               {_total("total_amount", "total_revenue")},
               {_mean("duration_minutes", "average_duration_minutes")},
               {_mean("average_speed_mph", "average_speed_mph")},
               count_if(is_airport_trip)::BIGINT AS airport_trip_count
        FROM fact GROUP BY ALL""",
    "hourly": f"""
        SELECT pickup_date, pickup_hour, count(*) AS trip_count, {PASSENGERS},
               {_mean("duration_minutes", "average_duration_minutes")}, {_total("total_amount", "total_revenue")}
        FROM fact GROUP BY ALL""",
    "demand": f"""
        SELECT pickup_zone_id AS zone_id, count(*) AS pickup_trip_count, {PASSENGERS},
               {_total("total_amount", "total_revenue")}, {_mean("trip_distance", "average_trip_distance")}
        FROM fact GROUP BY ALL""",
    "route": f"""
        SELECT pickup_zone_id, dropoff_zone_id, count(*) AS trip_count,
               {_mean("trip_distance", "average_trip_distance")},
               {_mean("duration_minutes", "average_duration_minutes")}, {_total("total_amount", "total_revenue")}
        FROM fact GROUP BY ALL""",
    "revenue": f"""
        SELECT pickup_date, payment_type, count(*) AS trip_count, {_total("fare_amount", "fare_revenue")},
               {_total("tip_amount", "tip_revenue")}, {_total("tolls_amount", "tolls_revenue")},
               {_total("total_amount", "total_revenue")}, {_mean("revenue_per_mile", "average_revenue_per_mile")}
        FROM fact GROUP BY ALL""",
    "odd": """
        SELECT * FROM fact
        WHERE quality_status = 'warning' OR trip_distance = 0 OR duration_minutes = 0 OR average_speed_mph > 65""",
    "calendar": """
        SELECT day AS date, strftime(day, '%Y%m%d')::INTEGER AS date_key, year(day)::INTEGER AS year,
               month(day)::INTEGER AS month, monthname(day) AS month_name, day(day)::INTEGER AS day,
               dayname(day) AS day_name, isodow(day)::INTEGER AS iso_day_of_week, isodow(day) > 5 AS is_weekend
        FROM (SELECT DISTINCT pickup_date AS day FROM fact)""",
    "hours": """
        SELECT h::INTEGER AS hour, format('{:02d}:00', h) AS hour_label,
               CASE WHEN h BETWEEN 5 AND 11 THEN 'morning' WHEN h BETWEEN 12 AND 16 THEN 'afternoon'
                    WHEN h BETWEEN 17 AND 20 THEN 'evening' ELSE 'overnight' END AS day_part
        FROM range(24) AS clock(h)""",
    "payments": """
        SELECT * FROM (VALUES (0, 'Unknown'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'),
                              (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip'))
                 AS p(payment_type, payment_type_name)""",
    "rates": """
        SELECT * FROM (VALUES (0, 'Unknown'), (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'),
                              (4, 'Nassau or Westchester'), (5, 'Negotiated fare'), (6, 'Group ride'),
                              (99, 'Unknown')) AS r(rate_code_id, rate_code_name)""",
}
ORDER = list(STEPS)


def sql(final: str, last: str, extra: str = "") -> str:
    """A query whose WITH list holds all steps up to and including `last`."""
    steps = ORDER[: ORDER.index(last) + 1]
    listed = ",\n".join(f"{name} AS ({STEPS[name].strip()})" for name in steps)
    return f"WITH {listed}{extra}\n{final}"


def _usage(dimension: str, member: str, key: str) -> str:
    return sql(
        f"SELECT d.*, coalesce(n, 0)::BIGINT AS trip_count FROM {dimension} d LEFT JOIN "
        f"(SELECT {key} AS k, count(*) AS n FROM fact GROUP BY ALL) ON k = d.{member}",
        "rates",
    )


# Data checks: relation behind each model name, and the checks by test.
MODELS = {
    "yellow_trips": ("staged", "trip_id"),
    "taxi_zones": ("zone_ref", "location_id"),
    "stg_trips": ("stg", "trip_id"),
    "stg_zones": ("dimz", "zone_id"),
    "dim_zone": ("dimz", "zone_id"),
    "dim_date": ("calendar", "date"),
    "dim_hour": ("hours", "hour"),
    "dim_payment_type": ("payments", "payment_type"),
    "dim_rate_code": ("rates", "rate_code_id"),
    "fct_trips": ("fact", "trip_id"),
}
PARENTS = {
    "pickup_date": ("calendar", "date"),
    "pickup_hour": ("hours", "hour"),
    "pickup_zone_id": ("dimz", "zone_id"),
    "dropoff_zone_id": ("dimz", "zone_id"),
    "payment_type": ("payments", "payment_type"),
    "rate_code_id": ("rates", "rate_code_id"),
}


def _check(model: str, column: str, test: str, broken: str) -> str:
    relation = MODELS[model][0]
    head = f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test"
    return f"{head}, count_if({broken})::BIGINT AS violations FROM {relation}"


def _checks(parts: list[str]) -> str:
    return sql("\nUNION ALL\n".join(parts), "rates")


NOT_NULL = [(m, key) for m, (_, key) in MODELS.items()] + [("fct_trips", c) for c in list(PARENTS)[:4]]
UNIQUE = [
    f"SELECT '{m}' AS model, '{key}' AS column_name, 'unique' AS test, count(*) AS violations FROM "
    f"(SELECT {key} FROM {relation} WHERE {key} IS NOT NULL GROUP BY ALL HAVING count(*) > 1)"
    for m, (relation, key) in MODELS.items()
]
ACCEPTED = [
    _check(m, "service", "accepted_values", "service <> 'yellow'") for m in ("yellow_trips", "stg_trips", "fct_trips")
] + [
    _check(m, "quality_status", "accepted_values", "quality_status NOT IN ('valid', 'warning')")
    for m in ("stg_trips", "fct_trips")
]
RELATED = [
    _check("fct_trips", column, "relationships",
           f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})")
    for column, (parent, key) in PARENTS.items()
]

KPIS = f"""
    count(*)::BIGINT AS total_trips, round(coalesce(sum(total_amount), 0), 2) AS total_revenue,
    coalesce({_mean("fare_amount", "x").removesuffix(" AS x")}, 0) AS average_fare,
    coalesce({_mean("duration_minutes", "x").removesuffix(" AS x")}, 0) AS average_duration_minutes,
    round(coalesce(sum(trip_distance), 0), 2) AS total_distance,
    count_if(is_airport_trip)::BIGINT AS airport_trip_count,
    count_if(quality_status = 'warning')::BIGINT AS warning_trip_count"""
ZONE_LIST = """
    SELECT zone_id, borough, zone_name, service_zone, is_airport_zone,
           coalesce(pickup_trip_count, 0)::BIGINT AS pickup_trip_count,
           coalesce(passenger_count, 0)::DOUBLE AS passenger_count,
           coalesce(total_revenue, 0)::DOUBLE AS total_revenue, average_trip_distance
    FROM dimz LEFT JOIN demand USING (zone_id)"""
ENDS = "JOIN dimz p ON p.zone_id = pickup_zone_id JOIN dimz d ON d.zone_id = dropoff_zone_id"
ROUTE_LIST = f"""
    SELECT pickup_zone_id, p.zone_name AS pickup_zone_name, dropoff_zone_id, d.zone_name AS dropoff_zone_name,
           trip_count, average_trip_distance, average_duration_minutes, total_revenue
    FROM route {ENDS}"""
ODD_LIST = f"""
    SELECT trip_id, pickup_datetime, dropoff_datetime, pickup_zone_id, p.zone_name AS pickup_zone_name,
           dropoff_zone_id, d.zone_name AS dropoff_zone_name, passenger_count, trip_distance, fare_amount,
           total_amount, duration_minutes, average_speed_mph, revenue_per_mile, is_airport_trip,
           quality_status, quality_reasons
    FROM odd {ENDS}"""
# Unusual trips by distance with their number, page, and the number of the first row of equal key and ties.
PLACED = f"""
    SELECT *, (n - 1) // 25 + 1 AS page, min(n) OVER (PARTITION BY trip_distance, trip_id) AS first
    FROM (SELECT *, row_number() OVER (ORDER BY trip_distance DESC NULLS LAST, trip_id) AS n FROM ({ODD_LIST}))"""
COUNTED = {
    "fct_trips": "fact",
    "dim_zone": "dimz",
    "mart_daily_trip_metrics": "daily",
    "mart_hourly_demand": "hourly",
    "mart_zone_demand": "demand",
    "mart_route_metrics": "route",
    "mart_revenue_metrics": "revenue",
    "mart_anomalous_trips": "odd",
}
PROFILED_NULLS = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "total_amount": "total_amount",
    "passenger_count": "passenger_count",
    "PULocationID": "pickup_zone_id",
    "DOLocationID": "dropoff_zone_id",
}
PROFILE = names(
    "count(*) AS row_count",
    *[f"count_if({c} IS NULL)::BIGINT AS {raw}_nulls" for raw, c in PROFILED_NULLS.items()],
    *[f"{e}({w}_datetime) AS {w}_{e}" for w in ("pickup", "dropoff") for e in ("min", "max")],
    *[
        f"min({c}) AS {c}_min, max({c}) AS {c}_max, {_mean(c, c + '_avg')}"
        for c in ("trip_distance", "fare_amount", "total_amount")
    ],
)
SUMMARY_TOTALS = """
    count(*) AS total_rows, count_if(quality_status = 'valid')::BIGINT AS valid_rows,
    count_if(quality_status = 'warning')::BIGINT AS warning_rows,
    count_if(quality_status = 'rejected')::BIGINT AS rejected_rows"""
RULE_ROWS = """
    SELECT rule, count(*) AS row_count
    FROM (SELECT unnest(string_split(quality_reasons, '|')) AS rule FROM judged) WHERE rule <> '' GROUP BY ALL"""
BY_ORDER_MONTH = """,
monthly AS (SELECT j.* REPLACE (year(o_orderdate)::INTEGER AS source_year, month(o_orderdate)::INTEGER AS source_month)
            FROM (SELECT row_number() OVER (ORDER BY source_row_number, stable_record_hash) AS n, * FROM judged) j
            JOIN (SELECT row_number() OVER (ORDER BY source_row_number, stable_record_hash) AS n, o_orderdate
                  FROM hashed) k USING (n))"""
NEWEST = """,
newest AS (SELECT year(max(o_orderdate)) AS newest_year, month(max(o_orderdate)) AS newest_month FROM orders)"""
IN_NEWEST = "source_year = newest_year AND source_month = newest_month"
BY_QUARTER = (
    "coalesce(quarter(pickup_datetime), quarter(dropoff_datetime), 1)::INTEGER AS source_month"
)
ALL_BUT_RUN = "* EXCLUDE (service, source_year, source_month)"

# Types in which the driver tables' trips come, where they differ from the contract or are altered by the query.
DRIFT = {
    "fare_amount": ("string", "count_if(fare_amount IS NOT NULL OR source_row_number % 17 = 0)", "count_if(source_row_number % 17 = 0)"),
    "passenger_count": (
        "string",
        "count_if(passenger_count IS NOT NULL OR source_row_number % 19 = 0)",
        "count_if(source_row_number % 19 = 0)",
    ),
    "airport_fee": ("absent", "count_if(false)", "count_if(false)"),
}
CONTRACT_TYPES = {
    "vendor_id": "bigint", "pickup_datetime": "timestamp_ntz", "dropoff_datetime": "timestamp_ntz", "rate_code_id": "int",
    "store_and_fwd_flag": "string", "pickup_zone_id": "int", "dropoff_zone_id": "int", "payment_type": "int",
}
WIDER_TYPES = {name: "bigint" for name in ("rate_code_id", "pickup_zone_id", "dropoff_zone_id", "payment_type")}


def _drift(column: str) -> str:
    target = CONTRACT_TYPES.get(column, "double")
    source, held, lost = DRIFT.get(column, (WIDER_TYPES.get(column, target), f"count({column})", "0"))
    return (
        f"SELECT 'lineitem' AS source_file, '{column}' AS column_name, '{source}' AS source_type, '{target}' AS target_type, "
        f"({held})::BIGINT AS source_values, ({lost})::BIGINT AS lost_values FROM trips"
    )


def _outside(column: str, alias: str) -> str:
    return f"count_if({column} IS NOT NULL AND date_trunc('month', {column}) <> date_trunc('month', o_orderdate))::BIGINT AS {alias}"


ANOMALY_FLAGS = [
    ("zero_distance_high_fare", "trip_distance = 0 AND fare_amount >= 50"),
    ("high_fare_per_mile", "trip_distance > 0 AND fare_amount / trip_distance > 25"),
    ("airport_like_fare", "fare_amount >= 90 AND NOT coalesce(is_airport_trip, false)"),
    ("missing_location", "pickup_zone_id IS NULL OR dropoff_zone_id IS NULL"),
]
FLAGGED = names(*[f"if({test}, '{name}', NULL)" for name, test in ANOMALY_FLAGS])
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

ORACLE: dict[str, str] = {
    "table_files": " UNION ALL ".join(f"SELECT '{t}' AS table_name, 1::BIGINT AS file_count, count(*) AS row_count FROM {t}" for t in TABLES),
    "top_dropoff_zones": sql(
        "SELECT zone_id, borough, zone_name, coalesce(n, 0)::BIGINT AS dropoff_trip_count, coalesce(total, 0)::DOUBLE AS total_revenue "
        "FROM dimz LEFT JOIN (SELECT dropoff_zone_id AS zone_id, count(*) AS n, round(sum(total_amount), 2) AS total FROM fact GROUP BY ALL) "
        "USING (zone_id) ORDER BY dropoff_trip_count DESC, zone_id LIMIT 20",
        "dimz",
    ),
    "anomaly_flags": sql(
        f"FROM (SELECT trip_id, source_row_number, quality_status, concat_ws('|', {FLAGGED}) AS anomaly_flags FROM judged) "
        "WHERE anomaly_flags <> ''",
        "judged",
    ),
    "rejected_summary": sql(
        "SELECT rule, pickup_zone_id, source_file, count(*) AS rejected_rows FROM (SELECT unnest(string_split(quality_reasons, '|')) AS rule, "
        "pickup_zone_id, source_file FROM judged WHERE quality_status = 'rejected') GROUP BY ALL",
        "judged",
    ),
    "out_of_month": sql(
        "SELECT 'yellow' AS service, year(o_orderdate)::INTEGER AS source_year, month(o_orderdate)::INTEGER AS source_month, "
        f"count(*) AS trip_count, {_outside('pickup_datetime', 'pickups_outside')}, {_outside('dropoff_datetime', 'dropoffs_outside')} "
        "FROM trips GROUP BY ALL",
        "trips",
    ),
    "schema_drift": sql(" UNION ALL ".join(_drift(column) for column in TYPED), "trips"),
    "duplicate_rank_split": sql(
        "SELECT stable_record_hash, source_row_number, copy_no AS duplicate_rank FROM measured", "measured"
    ),
    "normalized_trips": sql(f"SELECT source_row_number, {names(*TYPED)} FROM trips", "trips"),
    "measured_trips": sql(f"SELECT source_row_number, {names(*TYPED, *MEASURES)} FROM measured", "measured"),
    "record_hash": sql("SELECT source_row_number, stable_record_hash FROM hashed", "hashed"),
    "duplicate_rank": sql(
        "SELECT stable_record_hash, source_row_number, copy_no AS duplicate_rank FROM measured", "measured"
    ),
    "classified_trips": sql("FROM judged", "judged"),
    "validated_trips": sql(f"SELECT {ALL_BUT_RUN} FROM judged WHERE quality_status <> 'rejected'", "judged"),
    "rejected_trips": sql(f"SELECT {ALL_BUT_RUN} FROM judged WHERE quality_status = 'rejected'", "judged"),
    "status_counts": sql(
        "SELECT s AS quality_status, count(trip_id) AS row_count FROM (VALUES ('valid'), ('warning'), ('rejected')) "
        "AS v(s) LEFT JOIN judged ON quality_status = s GROUP BY ALL",
        "judged",
    ),
    "rule_counts": sql(RULE_ROWS, "judged"),
    "validation_summary": sql(
        f"SELECT 'yellow' AS service, 2026 AS year, 1 AS month, '2026-01-03T10:00:00Z' AS validated_at, "
        f"t.*, rule, row_count AS rule_rows FROM (SELECT {SUMMARY_TOTALS} FROM judged) t, ({RULE_ROWS}) r",
        "judged",
    ),
    "raw_profile": sql(f"SELECT {PROFILE} FROM trips", "trips"),
    "bounded_sample": sql(
        f"SELECT source_row_number, {names(*TYPED)} FROM hashed "
        "ORDER BY source_row_number, stable_record_hash LIMIT 1000",
        "hashed",
    ),
    "zones_load": sql("FROM zone_ref", "zone_ref"),
    "staging_trips": sql("FROM staged", "staged"),
    "stg_trips": sql("FROM stg", "stg"),
    "stg_zones": sql("SELECT zone_id, borough, zone_name, service_zone FROM dimz", "dimz"),
    "dim_zone": sql("FROM dimz", "dimz"),
    "dim_date": sql("FROM calendar", "calendar"),
    "dim_hour": _usage("hours", "hour", "pickup_hour"),
    "dim_payment_type": _usage("payments", "payment_type", "payment_type"),
    "dim_rate_code": _usage("rates", "rate_code_id", "rate_code_id"),
    "fct_trips": sql("FROM fact", "fact"),
    "mart_daily_trip_metrics": sql("FROM daily", "daily"),
    "mart_hourly_demand": sql("FROM hourly", "hourly"),
    "mart_zone_demand": sql("FROM demand", "demand"),
    "mart_route_metrics": sql("FROM route", "route"),
    "mart_revenue_metrics": sql("FROM revenue", "revenue"),
    "mart_anomalous_trips": sql("FROM odd", "odd"),
    "dq_not_null": _checks([_check(m, c, "not_null", f"{c} IS NULL") for m, c in NOT_NULL]),
    "dq_unique": _checks(UNIQUE),
    "dq_accepted_values": _checks(ACCEPTED),
    "dq_relationships": _checks(RELATED),
    "dq_non_negative": _checks(
        [
            _check("fct_trips", c, "non_negative", f"{c} IS NULL OR {c} < 0")
            for c in ("trip_distance", "fare_amount", "total_amount")
        ]
    ),
    "dq_valid_duration": _checks(
        [_check("fct_trips", "duration_minutes", "valid_duration",
                "duration_minutes IS NULL OR duration_minutes NOT BETWEEN 0 AND 1440")]
    ),
    "dq_reasonable_speed": _checks(
        [_check("fct_trips", "average_speed_mph", "reasonable_speed", "average_speed_mph NOT BETWEEN 0 AND 100")]
    ),
    "overview": sql(f"SELECT {KPIS} FROM fact", "fact"),
    "overview_zone": sql(f"SELECT {KPIS} FROM fact WHERE {DATES} AND {AT_ZONE}", "fact"),
    "daily_metrics_page": sql("FROM daily ORDER BY total_revenue DESC, pickup_date LIMIT 15 OFFSET 5", "daily"),
    "daily_metrics_range": sql(f"FROM daily WHERE {DATES} ORDER BY pickup_date", "daily"),
    "hourly_demand_page": sql(
        "FROM hourly ORDER BY trip_count DESC, pickup_date, pickup_hour LIMIT 50 OFFSET 10", "hourly"
    ),
    "revenue_page": sql(
        f"FROM revenue WHERE {DATES} ORDER BY total_revenue DESC, pickup_date, payment_type LIMIT 40 OFFSET 3",
        "revenue",
    ),
    "revenue_labeled": sql(
        "SELECT pickup_date, payment_type, total_revenue, name AS payment_label, "
        "pickup_date::VARCHAR || ' / ' || name AS label FROM (SELECT r.*, coalesce(nullif(payment_type_name, ''), "
        "'Type ' || r.payment_type) AS name FROM revenue r LEFT JOIN payments p "
        "ON p.payment_type = r.payment_type AND p.payment_type > 0)",
        "payments",
    ),
    "zones": sql(f"{ZONE_LIST} ORDER BY total_revenue DESC, zone_id LIMIT 20 OFFSET 2", "demand"),
    "zones_labeled": sql(
        f"SELECT zone_id, zone_id || ': ' || zone_name AS label, pickup_trip_count FROM ({ZONE_LIST}) "
        "ORDER BY pickup_trip_count DESC, zone_id LIMIT 10",
        "demand",
    ),
    "zone_summary": sql(
        f"""SELECT z.*, s.* FROM dimz z, (
              SELECT count_if(pickup_zone_id = 5)::BIGINT AS pickup_trip_count,
                     count_if(dropoff_zone_id = 5)::BIGINT AS dropoff_trip_count,
                     count(*) AS related_trip_count, round(coalesce(sum(total_amount), 0), 2) AS total_revenue,
                     {_mean("trip_distance", "average_trip_distance")},
                     {_mean("duration_minutes", "average_duration_minutes")}
              FROM fact WHERE {DATES} AND {AT_ZONE}) s
            WHERE z.zone_id = 5""",
        "dimz",
    ),
    "top_routes": sql(
        f"{ROUTE_LIST} WHERE {AT_ZONE} ORDER BY trip_count DESC, pickup_zone_id, dropoff_zone_id LIMIT 30", "route"
    ),
    "top_routes_labeled": sql(
        f"SELECT pickup_zone_name || ' to ' || dropoff_zone_name AS route_label, trip_count, total_revenue "
        f"FROM ({ROUTE_LIST}) ORDER BY trip_count DESC, pickup_zone_id, dropoff_zone_id LIMIT 25 OFFSET 5",
        "route",
    ),
    "anomalies": sql(f"{ODD_LIST} ORDER BY pickup_datetime DESC NULLS LAST, trip_id LIMIT 100 OFFSET 20", "odd"),
    "anomalies_by_speed": sql(
        f"{ODD_LIST} WHERE {DATES} ORDER BY average_speed_mph ASC NULLS LAST, trip_id LIMIT 500 OFFSET 100", "odd"
    ),
    "page_totals": sql(
        " UNION ALL ".join(
            f"SELECT '{label}' AS list, count(*) AS total FROM {relation}{where}"
            for label, relation, where in (
                ("daily", "daily", f" WHERE {DATES}"),
                ("hourly", "hourly", f" WHERE {DATES}"),
                ("revenue", "revenue", f" WHERE {DATES}"),
                ("zones", "dimz", ""),
                ("routes", "route", f" WHERE {AT_ZONE}"),
                ("anomalies", "odd", f" WHERE {DATES} AND {AT_ZONE}"),
            )
        ),
        "odd",
    ),
    "anomalies_third_page": sql(f"{ODD_LIST} ORDER BY total_amount DESC NULLS LAST, trip_id LIMIT 40 OFFSET 80", "odd"),
    "anomaly_page_starts": sql(f"SELECT page, trip_distance, trip_id, n - first AS skip FROM ({PLACED}) WHERE (n - 1) % 25 = 0", "odd"),
    "anomalies_last_page": sql(f"SELECT * EXCLUDE (n, first, page) FROM ({PLACED}) WHERE page = (SELECT max(page) FROM ({PLACED}))", "odd"),
    "dashboard_daily": sql("FROM daily ORDER BY pickup_date LIMIT 20", "daily"),
    "dashboard_hourly": sql(
        "FROM hourly ORDER BY pickup_hour, pickup_date LIMIT 24", "hourly"
    ),
    "dashboard_revenue": sql("FROM revenue ORDER BY pickup_date, payment_type LIMIT 20", "revenue"),
    "dashboard_zones": sql(f"{ZONE_LIST} ORDER BY pickup_trip_count DESC, zone_id LIMIT 20", "demand"),
    "dashboard_routes": sql(f"{ROUTE_LIST} ORDER BY trip_count DESC, pickup_zone_id, dropoff_zone_id LIMIT 20", "route"),
    "dashboard_anomalies": sql(f"{ODD_LIST} ORDER BY pickup_datetime DESC NULLS LAST, trip_id LIMIT 20", "odd"),
    "daily_export": sql(f"FROM daily WHERE {DATES} ORDER BY pickup_date", "daily"),
    "metadata": sql(
        "SELECT 'yellow' AS service, if(count_if(service = 'yellow') > 0, 'available', 'empty') AS service_status, "
        "min(pickup_date) AS start_date, max(pickup_date) AS end_date, "
        + names(*[f"(SELECT count(*) FROM {r})::BIGINT AS {n}_rows" for n, r in COUNTED.items()])
        + " FROM fact",
        "odd",
    ),
    "freshness": sql("SELECT max(ingested_at) AS data_freshness FROM fact", "fact"),
    "readiness": sql(
        "SELECT (" + " + ".join(f"(SELECT count(*) FROM {r})" for r in COUNTED.values()) + ")::BIGINT AS total_rows, "
        "8::BIGINT AS relations_present, "
        "(SELECT count(*) FROM fact) > 0 AND (SELECT count(*) FROM dimz) > 0 AS analytics_ready",
        "odd",
    ),
    "latest_quality_summary": sql(
        f"SELECT 'yellow' AS service, source_year::BIGINT AS year, source_month::BIGINT AS month, "
        f"'2026-01-03T10:00:00Z' AS validated_at, {SUMMARY_TOTALS}, "
        "sum(if(quality_reasons = '', 0, 1 + length(quality_reasons) - length(replace(quality_reasons, '|', ''))))"
        "::BIGINT AS rule_hits, format('validation_{:04d}_{:02d}_yellow', source_year, source_month) AS artifact_name, "
        "true AS well_formed FROM monthly GROUP BY source_year, source_month "
        "ORDER BY source_year DESC, source_month DESC LIMIT 1",
        "judged",
        BY_ORDER_MONTH,
    ),
    "backfill_months": sql(
        "SELECT service, source_year, source_month, quality_status, count(*) AS row_count, "
        "count(DISTINCT trip_id) AS trip_ids FROM monthly GROUP BY ALL",
        "judged",
        BY_ORDER_MONTH,
    ),
    "row_ordinals": """
        SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey % 10, l_orderkey, l_linenumber) AS ordinal
        FROM lineitem""",
    "late_file_parts": sql(
        "SELECT (year(pickup_datetime) * 100 + month(pickup_datetime))::INTEGER AS period, "
        f"count(DISTINCT pickup_datetime::DATE) AS days, bool_or({IN_NEWEST}) AS rewritten "
        "FROM monthly, newest WHERE quality_status <> 'rejected' GROUP BY ALL",
        "judged",
        BY_ORDER_MONTH + NEWEST,
    ),
    "previous_snapshot": sql(
        f"SELECT pickup_datetime::DATE AS pickup_date, count(*) AS trip_count, {PASSENGERS}, {_total('total_amount', 'total_revenue')} "
        f"FROM monthly, newest WHERE quality_status <> 'rejected' AND NOT ({IN_NEWEST} AND source_row_number % 3 = 0) GROUP BY 1",
        "judged",
        BY_ORDER_MONTH + NEWEST,
    ),
    "incremental_ingest": sql(
        f"SELECT * EXCLUDE (source_row_number, source_file) REPLACE ({BY_QUARTER}) FROM staged", "staged"
    ),
}
