"""The same queries in SQL for DuckDB, over views of the sample tables."""

from __future__ import annotations

# The sample telemetry; dates and hours keep their native types here.
TELEMETRY = """
WITH t AS (
  SELECT l_shipdate AS instant,
         CAST(l_shipdate AS DATE) AS day,
         CAST(l_orderkey AS VARCHAR) AS serial_number,
         p_name AS model,
         CAST(l_suppkey AS INTEGER) AS vault_id,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS failure,
         l_extendedprice AS hours
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
)
"""

DAILY = (
    TELEMETRY
    + """, daily AS (
  SELECT strftime(day, '%d-%m-%Y') AS data, vault_id, CAST(sum(failure) AS BIGINT) AS failures_count
  FROM t GROUP BY day, vault_id HAVING sum(failure) IN (2, 3, 4)
)
"""
)

MODELS = (
    TELEMETRY
    + """, models AS (
  SELECT model, CAST(sum(failure) AS BIGINT) AS total_failures
  FROM t GROUP BY model ORDER BY total_failures DESC, model LIMIT 10
)
"""
)

VAULTS = (
    TELEMETRY
    + """, vaults AS (
  SELECT vault_id, count(*) AS total_failures, list_sort(list_distinct(list(model))) AS models
  FROM t WHERE failure = 1 GROUP BY vault_id ORDER BY total_failures DESC, vault_id LIMIT 10
)
"""
)

LATEST = (
    TELEMETRY
    + """, ever AS (
  SELECT serial_number, max(instant) AS newest, max(failure) AS ever_failed FROM t GROUP BY serial_number
), latest AS (
  SELECT t.serial_number, t.instant, t.failure, t.hours, ever.ever_failed
  FROM t JOIN ever ON t.serial_number = ever.serial_number AND t.instant = ever.newest
)
"""
)

QUARTILES = """min(hours) AS "min",
       quantile_disc(hours, 0.25) AS "25th_percentile",
       quantile_disc(hours, 0.50) AS "50th_percentile",
       quantile_disc(hours, 0.75) AS "75th_percentile",
       max(hours) AS "max",
       count(hours) AS "count\""""

COHORTS = LATEST + f""", cohorts AS (
  SELECT {QUARTILES}, CAST(ever_failed AS INTEGER) AS failure FROM latest GROUP BY ever_failed
)
"""

DAILY_CELLS = """
  SELECT 'query1:' || data || ':' || vault_id AS key, unnest(['date', 'vaultId', 'failuresCount']) AS field,
         unnest([data, CAST(vault_id AS VARCHAR), CAST(failures_count AS VARCHAR)]) AS value
  FROM daily"""

VAULT_CELLS = """
  SELECT 'query2.2:' || vault_id AS key, unnest(['vaultId', 'totalFailures', 'uniqueModels']) AS field,
         unnest([CAST(vault_id AS VARCHAR), CAST(total_failures AS VARCHAR), array_to_string(models, ', ')]) AS value
  FROM vaults"""

COHORT_KEY = "CASE failure WHEN 1 THEN 'failureStats' ELSE 'nofailureStats' END AS key"

COHORT_COLUMNS = ("min", "25th_percentile", "50th_percentile", "75th_percentile", "max", "count")

COHORT_CELLS = f"""
  SELECT {COHORT_KEY},
         unnest(['# failure', {", ".join(f"'{c}'" for c in COHORT_COLUMNS)}]) AS field,
         unnest([CAST(failure AS VARCHAR), {", ".join(f'CAST("{c}" AS VARCHAR)' for c in COHORT_COLUMNS)}]) AS value
  FROM cohorts"""

ORACLE = {
    # Reports
    "daily_vault_failures": DAILY + "SELECT data, vault_id, failures_count FROM daily",
    "top_models": MODELS + "SELECT model, total_failures FROM models",
    "top_vaults": VAULTS
    + "SELECT vault_id, total_failures, array_to_string(models, ',') AS unique_models FROM vaults",
    "hours_by_cohort": COHORTS + "SELECT * FROM cohorts",
    "hours_by_cohort_sketch": COHORTS
    + """SELECT "min", "max", "count", failure, TRUE AS "25th_percentile_within",
                TRUE AS "50th_percentile_within", TRUE AS "75th_percentile_within" FROM cohorts""",
    "hours_by_cohort_daily_sketch": COHORTS
    + """SELECT *, CAST(0 AS DOUBLE) AS "25th_percentile_rank_error", CAST(0 AS DOUBLE) AS "50th_percentile_rank_error",
                CAST(0 AS DOUBLE) AS "75th_percentile_rank_error" FROM cohorts""",
    # Sources
    "scan_parquet": "SELECT l_orderkey, l_suppkey, l_returnflag FROM lineitem",
    "ingest_extract": TELEMETRY
    + "SELECT instant AS data, serial_number, failure, hours AS s9_power_on_hours FROM t",
    "ingest_if_absent": TELEMETRY
    + """SELECT vault_id, count(*) AS observations, CAST(sum(failure) AS BIGINT) AS failures,
                TRUE AS built_first, FALSE AS built_again,
                TRUE AS built_for_renames, TRUE AS built_for_new_raw FROM t GROUP BY vault_id""",
    "ingest_by_month": TELEMETRY
    + """SELECT day AS data, count(*) AS observations, CAST(sum(failure) AS BIGINT) AS failures
         FROM t WHERE year(day) = 1996 OR (year(day) IN (1994, 1995) AND vault_id % 2 = 0) GROUP BY day""",
    # File sinks
    "csv_roundtrip": DAILY
    + "SELECT data, vault_id, failures_count, CAST(unnest([1, 2]) AS INTEGER) AS copy FROM daily",
    "csv_published_copies": DAILY
    + "SELECT data, vault_id, failures_count, CAST(unnest([1, 2]) AS INTEGER) AS copy FROM daily",
    "csv_single_file": COHORTS + "SELECT *, CAST(0 AS INTEGER) AS part FROM cohorts",
    # Keyed hashes
    "hash_rows_daily": DAILY + DAILY_CELLS,
    "hash_single": MODELS
    + "SELECT 'query2' AS key, model AS field, CAST(total_failures AS VARCHAR) AS value FROM models",
    "hash_rows_vault": VAULTS + VAULT_CELLS,
    "hash_cohort": COHORTS + COHORT_CELLS,
    "hash_upsert": MODELS
    + """SELECT 'query2' AS key, observed.model AS field,
                CAST(coalesce(models.total_failures, observed.n) AS VARCHAR) AS value
         FROM (SELECT model, count(*) AS n FROM t GROUP BY model) observed
         LEFT JOIN models ON models.model = observed.model""",
    "hash_store_batches": TELEMETRY
    + """SELECT 'query2' AS key, model AS field, CAST(arg_max(n, share) AS VARCHAR) AS value
         FROM (SELECT model, vault_id % 20 AS share, count(*) AS n FROM t WHERE failure = 1 GROUP BY model, vault_id % 20)
         GROUP BY model""",
    "hash_scan_keys": DAILY + "SELECT DISTINCT 'query1:' || data || ':' || vault_id AS key FROM daily",
    "hash_get_all": VAULTS
    + """SELECT 'query2.2:' || vault_id AS key, CAST(vault_id AS VARCHAR) AS "vaultId",
                CAST(total_failures AS VARCHAR) AS "totalFailures",
                array_to_string(models, ', ') AS "uniqueModels" FROM vaults""",
    "hash_get_fields": MODELS + "SELECT model AS field, CAST(total_failures AS VARCHAR) AS value FROM models",
    "hash_merge": COHORTS
    + f"""SELECT {COHORT_KEY}, CAST(failure AS VARCHAR) AS "# failure",
                {", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in COHORT_COLUMNS)} FROM cohorts""",
    # Projections and functions
    "pick_union_member": TELEMETRY
    + """SELECT vault_id, CAST(sum(failure) AS BIGINT) AS failures, max(serial_number) AS last_serial
         FROM t GROUP BY vault_id""",
    "parse_date": TELEMETRY + "SELECT serial_number, day, TRUE AS serial_is_no_date FROM t",
    "parse_timestamp": "SELECT CAST(user_id AS INTEGER) AS vault_id, ts AS instant FROM events",
    "format_date": TELEMETRY + "SELECT serial_number, strftime(day, '%d-%m-%Y') AS day_text FROM t",
    "cast_failure": TELEMETRY
    + "SELECT failure, TRUE AS model_is_no_number, count(*) AS observations FROM t GROUP BY failure",
    "cast_hours": TELEMETRY
    + "SELECT serial_number, hours AS s9_power_on_hours, TRUE AS date_is_no_number FROM t",
    "rename_drop": TELEMETRY + "SELECT serial_number AS serial_number_latest, hours AS s9_power_on_hours FROM t",
    "join_models_text": TELEMETRY
    + "SELECT vault_id, array_to_string(list_sort(list_distinct(list(model))), ',') AS models FROM t GROUP BY vault_id",
    # Filters
    "having_in_list": """
        SELECT strftime(CAST(ts AS DATE), '%d-%m-%Y') AS data, CAST(user_id AS INTEGER) AS vault_id,
               count(*) AS failures_count
        FROM events WHERE event_type = 'error'
        GROUP BY CAST(ts AS DATE), user_id HAVING count(*) IN (2, 3, 4)""",
    "filter_failed": TELEMETRY + "SELECT serial_number, vault_id, failure FROM t WHERE failure = 1",
    "cohort_split": TELEMETRY
    + "SELECT vault_id, count(*) AS observations, failure AS cohort FROM t GROUP BY vault_id, failure",
    # Joins
    "join_inner_using": TELEMETRY
    + """SELECT vault_id, count(*) AS total_failures,
                array_to_string(list_sort(list_distinct(list(model))), ',') AS unique_models
         FROM t WHERE failure = 1 GROUP BY vault_id""",
    "latest_rows": LATEST + "SELECT instant AS data, serial_number, failure, hours AS s9_power_on_hours FROM latest",
    "failed_flag": LATEST
    + """SELECT instant AS data, serial_number, CAST(greatest(failure, ever_failed) AS INTEGER) AS failure,
                hours AS s9_power_on_hours FROM latest""",
    "latest_rows_kept": LATEST
    + """SELECT instant AS data, serial_number, CAST(greatest(failure, ever_failed) AS INTEGER) AS failure,
                hours AS s9_power_on_hours FROM latest""",
    # Aggregates
    "totals_by_increments": TELEMETRY
    + """SELECT vault_id, model, CAST(sum(failure) AS BIGINT) AS failures, CAST(sum(failure) AS BIGINT) AS failed,
                count(*) AS observations FROM t GROUP BY vault_id, model""",
    "sum_by_day_vault": TELEMETRY
    + """SELECT day AS data, vault_id, CAST(sum(failure) AS BIGINT) AS failures_count
         FROM t GROUP BY day, vault_id""",
    "sum_by_model": TELEMETRY + "SELECT model, CAST(sum(failure) AS BIGINT) AS total_failures FROM t GROUP BY model",
    "count_by_vault": TELEMETRY
    + "SELECT vault_id, count(failure) AS total_failures FROM t WHERE failure = 1 GROUP BY vault_id",
    "models_by_vault": TELEMETRY
    + """SELECT vault_id, CAST(count(DISTINCT model) AS INTEGER) AS model_count,
                array_to_string(list_sort(list_distinct(list(model))), '|') AS unique_models
         FROM t WHERE failure = 1 GROUP BY vault_id""",
    "max_date_by_serial": TELEMETRY + "SELECT serial_number, max(instant) AS max_date FROM t GROUP BY serial_number",
    "distinct_failed": TELEMETRY + "SELECT DISTINCT serial_number FROM t WHERE failure = 1",
    "global_stats": TELEMETRY
    + 'SELECT min(hours) AS "min", max(hours) AS "max", count(hours) AS "count" FROM t',
    "percentiles_exact": TELEMETRY + f"SELECT {QUARTILES} FROM t",
    "percentiles_approx": TELEMETRY + f"SELECT {QUARTILES}, vault_id FROM t GROUP BY vault_id",
    "percentiles_by_drive": TELEMETRY + f"SELECT {QUARTILES}, serial_number FROM t GROUP BY serial_number",
    "stats_by_cohort": TELEMETRY + f"SELECT {QUARTILES}, failure FROM t GROUP BY failure",
}
