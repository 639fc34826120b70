"""Every report and operator as a named query over the sample tables.

Each query takes the session and the folder of the tables and reads whole
tables. Queries for sinks write to the shared scratch folder and return what
they read back.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewatch import operators as ops
from spindlewatch import sources, storage
from spindlewatch.functions import (
    as_double,
    as_int,
    format_day,
    joined_text,
    parse_day,
    parse_instant,
    pick_union_members,
    typed_telemetry,
)
from spindlewatch.plans import reports
from spindlewatch.sinks import hashes, write_csv
from spindlewatch.sinks.published import publish_copies, published_folder
from spindlewatch.sources.sample import load_error_events, load_telemetry
from spindlewatch.storage import kept, scratch_folder

HOURS = "s9_power_on_hours"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def telemetry(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return typed_telemetry(load_telemetry(spark, sf_dir, *columns))


def hours_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns of the hours report, with the instant parsed."""
    rows = telemetry(spark, sf_dir, "data", "serial_number", "failure", HOURS)
    return rows.withColumn("data", parse_instant("data"))


def wall_clock(instant: str) -> Column:
    """A timestamp without zone, which compares equal wherever it is read."""
    return F.col(instant).cast("timestamp_ntz")


# Reports


@query
def daily_vault_failures(spark, sf_dir):
    return reports.daily_vault_failures(telemetry(spark, sf_dir, "data", "vault_id", "failure"))


@query
def top_models(spark, sf_dir):
    return reports.top_models(telemetry(spark, sf_dir, "model", "failure"))


@query
def top_vaults(spark, sf_dir):
    return reports.top_vaults(telemetry(spark, sf_dir, "vault_id", "model", "failure"))


@query
def hours_by_cohort(spark, sf_dir):
    return reports.hours_by_cohort(telemetry(spark, sf_dir, "data", "serial_number", "failure", HOURS))


@query
def hours_by_cohort_sketch(spark, sf_dir):
    """The sketch at a resolution below the cohorts' sizes, and whether each percentile keeps its rank bound."""
    accuracy = 100
    rows = telemetry(spark, sf_dir, "data", "serial_number", "failure", HOURS)
    latest = ops.latest_rows_with_history(hours_input(spark, sf_dir)).where(f"{HOURS} is not null")
    names = {p: ops.percentile_name(p) for p in ops.QUARTILES}
    cohorts = reports.hours_by_cohort(rows, accuracy=accuracy)  # two rows
    counted = (
        latest.select("failure", HOURS)
        .join(F.broadcast(cohorts), "failure")
        .groupBy("failure", "min", "max", "count")
        .agg(
            *[F.count(F.when(F.col(HOURS) < F.col(name), 1)).alias(f"_below_{name}") for name in names.values()],
            *[F.count(F.when(F.col(HOURS) <= F.col(name), 1)).alias(f"_upto_{name}") for name in names.values()],
        )
    )
    slack = F.col("count") / accuracy + 1
    within = [
        (
            (F.col(f"_below_{name}") + 1 - slack <= F.col("count") * p) & (F.col("count") * p <= F.col(f"_upto_{name}") + slack)
        ).alias(f"{name}_within")
        for p, name in names.items()
    ]
    return counted.select("min", "max", "count", "failure", *within)


@query
def hours_by_cohort_daily_sketch(spark, sf_dir):
    """The hours report from one stored sketch per day and cohort, with the measured rank error of each percentile."""
    latest = ops.latest_rows_with_history(hours_input(spark, sf_dir))
    days = latest.select(F.col("data").cast("date").alias("day"), "failure", HOURS)
    stored = kept(ops.sketches(days, HOURS, ["day", "failure"]), "sketches")
    stats = ops.sketched_stats(ops.combined(stored, ["failure"]), ["failure"])
    return ops.measured_rank_errors(stats, days.where(f"{HOURS} is not null"), HOURS, "failure")


# Sources


@query
def scan_parquet(spark, sf_dir):
    return sources.read_parquet(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_suppkey", "l_returnflag")


@query
def ingest_extract(spark, sf_dir):
    target = scratch_folder(spark, "ingest")
    _write_raw(spark, sf_dir, f"{target}/raw")
    sources.ingest_extract(spark, f"{target}/raw", f"{target}/csv", f"{target}/parquet", "hours", {"date": "data"})
    return sources.read_parquet(spark, f"{target}/parquet")


@query
def ingest_if_absent(spark, sf_dir):
    target = scratch_folder(spark, "ingest")
    _write_raw(spark, sf_dir, f"{target}/raw")
    stages = (f"{target}/raw", f"{target}/csv", f"{target}/parquet", "rankings")

    def built(renames=None):
        return sources.ingest_extract(spark, *stages, renames, follow_changes=True)

    first, again = built(), built()
    renamed = built({"date": "data"})
    _write_raw(spark, sf_dir, f"{target}/raw")
    changed = built({"date": "data"})
    rows = sources.read_parquet(spark, f"{target}/parquet")
    return rows.groupBy("vault_id").agg(
        F.count("*").alias("observations"),
        F.sum("failure").alias("failures"),
        F.lit(all(first.values())).alias("built_first"),
        F.lit(any(again.values())).alias("built_again"),
        F.lit(all(renamed.values())).alias("built_for_renames"),
        F.lit(all(changed.values())).alias("built_for_new_raw"),
    )


@query
def ingest_by_month(spark, sf_dir):
    """A delivery of everything, then one that corrects two years: there only even vaults are left. Three years are read."""
    target = scratch_folder(spark, "ingest")
    extract = f"{target}/extract"
    _write_raw(spark, sf_dir, f"{target}/raw")
    sources.ingest_days(spark, f"{target}/raw", extract, "all", "daily", {"date": "data"}, "month")
    corrected = F.year(parse_day("date")).isin(1994, 1995) & (F.col("vault_id") % 2 == 0)
    write_csv(load_telemetry(spark, sf_dir).withColumnRenamed("data", "date").where(corrected), f"{target}/more")
    sources.ingest_days(spark, f"{target}/more", extract, "corrected", "daily", {"date": "data"}, "month")
    rows = sources.read_extract_days(spark, extract, "daily", datetime.date(1994, 1, 1), datetime.date(1996, 12, 31))
    return rows.groupBy(F.col("data").cast("date").alias("data")).agg(
        F.count("*").alias("observations"), F.sum("failure").alias("failures")
    )


def _write_raw(spark: SparkSession, sf_dir: str, uri: str) -> None:
    write_csv(load_telemetry(spark, sf_dir).withColumnRenamed("data", "date"), uri)


# File sinks


@query
def csv_roundtrip(spark, sf_dir):
    target = scratch_folder(spark, "daily")
    report = daily_vault_failures(spark, sf_dir)
    copies = (f"{target}/first", f"{target}/second")
    write_csv(report, *copies)
    read = [
        spark.read.schema(report.schema).option("header", True).csv(uri).withColumn("copy", F.lit(number))
        for number, uri in enumerate(copies, 1)
    ]
    return read[0].unionByName(read[1])


@query
def csv_published_copies(spark, sf_dir):
    """Two versions of a report in two copies, one below another scheme; readers of both go by one manifest."""
    target = scratch_folder(spark, "published")
    storage.make_folder(spark, f"{target}/mounted")
    copies = [f"{target}/here", f"{storage.mount(spark, f'{target}/mounted')}/there"]
    report = daily_vault_failures(spark, sf_dir)
    publish_copies(report.limit(0), copies)
    publish_copies(report, copies)
    read = [
        spark.read.schema(report.schema)
        .option("header", True)
        .csv(published_folder(spark, copies[0], copy))
        .withColumn("copy", F.lit(number))
        for number, copy in enumerate(copies, 1)
    ]
    return read[0].unionByName(read[1])


@query
def csv_single_file(spark, sf_dir):
    target = scratch_folder(spark, "cohorts")
    report = hours_by_cohort(spark, sf_dir)
    write_csv(report, target, single_file=True)
    read = spark.read.schema(report.schema).option("header", True).csv(target)
    part = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).cast("int")
    return read.withColumn("part", part)


# Keyed hashes


def _daily_cells(spark, sf_dir):
    return hashes.to_cells(hashes.daily_hashes(daily_vault_failures(spark, sf_dir)))


def _vault_cells(spark, sf_dir):
    ranking = reports.rank_vaults(telemetry(spark, sf_dir, "vault_id", "model", "failure"))
    return hashes.to_cells(hashes.vault_hashes(ranking))


def _cohort_cells(spark, sf_dir):
    return hashes.to_cells(hashes.cohort_hashes(hours_by_cohort(spark, sf_dir)))


@query
def hash_rows_daily(spark, sf_dir):
    return _daily_cells(spark, sf_dir)


@query
def hash_single(spark, sf_dir):
    return hashes.model_cells(top_models(spark, sf_dir))


@query
def hash_rows_vault(spark, sf_dir):
    return _vault_cells(spark, sf_dir)


@query
def hash_cohort(spark, sf_dir):
    return _cohort_cells(spark, sf_dir)


@query
def hash_upsert(spark, sf_dir):
    """First batch: how often each model was observed. Second batch: the failure ranking."""
    store = scratch_folder(spark, "cells")
    observed = ops.count_by(telemetry(spark, sf_dir, "model", "failure"), ["model"], "failure", "observations")
    hashes.append_batch(hashes.single_hash(observed, hashes.MODELS_KEY, "model", "observations"), store, 1)
    ranking = hash_single(spark, sf_dir)
    hashes.append_batch(ranking, store, 2)
    hashes.append_batch(ranking, store, 2)
    return hashes.read_store(spark, store)


def _stored(spark, *batches):
    """Cells read back from a store that took the given batches."""
    store = scratch_folder(spark, "cells")
    for number, cells in enumerate(batches, 1):
        hashes.append_batch(cells, store, number)
    return hashes.read_store(spark, store)


@query
def hash_store_batches(spark, sf_dir):
    """Twenty batches into one store that is folded as it grows: a batch has the failures of each model in its share of vaults."""
    store = scratch_folder(spark, "cells")
    failed = telemetry(spark, sf_dir, "model", "vault_id", "failure").where(F.col("failure") == 1)
    counted = failed.groupBy("model", F.pmod("vault_id", F.lit(20)).alias("share")).agg(F.count("*").alias("n"))
    counted = kept(counted, "shares")
    for share in range(20):
        batch = counted.where(F.col("share") == share)
        hashes.append_batch(hashes.single_hash(batch, hashes.MODELS_KEY, "model", "n"), store)
        hashes.fold(spark, store)
    return hashes.read_store(spark, store, hashes.MODELS_KEY)


@query
def hash_scan_keys(spark, sf_dir):
    cells = _stored(spark, _daily_cells(spark, sf_dir), _vault_cells(spark, sf_dir))
    return hashes.scan_keys(cells, "query1:*")


@query
def hash_get_all(spark, sf_dir):
    cells = _stored(spark, _vault_cells(spark, sf_dir), hash_single(spark, sf_dir))
    return hashes.get_all(cells, "query2.2:*", hashes.VAULT_FIELDS)


@query
def hash_get_fields(spark, sf_dir):
    cells = _stored(spark, hash_single(spark, sf_dir), _vault_cells(spark, sf_dir))
    return hashes.get_fields(cells, hashes.MODELS_KEY)


@query
def hash_merge(spark, sf_dir):
    cells = _stored(spark, _cohort_cells(spark, sf_dir))
    panels = [hashes.get_all(cells, key, hashes.COHORT_FIELDS) for key in hashes.COHORT_KEYS.values()]
    return hashes.merge_panels(*panels)


# Projections and functions


@query
def pick_union_member(spark, sf_dir):
    rows = telemetry(spark, sf_dir, "serial_number", "vault_id", "failure")
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("int")
    unions = rows.select(
        F.struct(no_number.alias("member0"), F.col("serial_number").alias("member1")).alias("serial_number"),
        F.struct(F.col("vault_id").alias("member0"), no_text.alias("member1")).alias("vault_id"),
        F.struct(F.col("failure").alias("member0"), no_text.alias("member1")).alias("failure"),
    )
    picked = pick_union_members(unions)
    return picked.groupBy("vault_id").agg(
        F.sum("failure").alias("failures"), F.max("serial_number").alias("last_serial")
    )


@query
def parse_date(spark, sf_dir):
    rows = load_telemetry(spark, sf_dir, "data", "serial_number")
    return rows.select(
        "serial_number",
        parse_day("data").alias("day"),
        parse_day("serial_number").isNull().alias("serial_is_no_date"),
    )


@query
def parse_timestamp(spark, sf_dir):
    rows = load_error_events(spark, sf_dir).select("vault_id", parse_instant("data").alias("instant"))
    return rows.select("vault_id", wall_clock("instant").alias("instant"))


@query
def format_date(spark, sf_dir):
    rows = load_telemetry(spark, sf_dir, "data", "serial_number")
    return rows.select("serial_number", format_day(parse_day("data")).alias("day_text"))


@query
def cast_failure(spark, sf_dir):
    raw = load_telemetry(spark, sf_dir, "failure", "model").withColumn("failure", F.col("failure").cast("string"))
    return (
        raw.select(as_int("failure").alias("failure"), as_int("model").isNull().alias("model_is_no_number"))
        .groupBy("failure", "model_is_no_number")
        .agg(F.count("*").alias("observations"))
    )


@query
def cast_hours(spark, sf_dir):
    raw = load_telemetry(spark, sf_dir, "serial_number", HOURS, "data")
    return raw.select(
        "serial_number", as_double(HOURS).alias(HOURS), as_double("data").isNull().alias("date_is_no_number")
    )


@query
def rename_drop(spark, sf_dir):
    rows = telemetry(spark, sf_dir, "serial_number", "vault_id", "failure", HOURS)
    return rows.withColumnRenamed("serial_number", "serial_number_latest").drop("failure", "vault_id")


@query
def join_models_text(spark, sf_dir):
    rows = telemetry(spark, sf_dir, "vault_id", "model")
    listed = ops.distinct_by(rows, "vault_id", "model", "models")
    return listed.select("vault_id", joined_text("models").alias("models"))


# Filters


@query
def having_in_list(spark, sf_dir):
    return reports.daily_vault_failures(load_error_events(spark, sf_dir))


@query
def filter_failed(spark, sf_dir):
    return telemetry(spark, sf_dir, "serial_number", "vault_id", "failure").where(F.col("failure") == 1)


@query
def cohort_split(spark, sf_dir):
    rows = telemetry(spark, sf_dir, "vault_id", "failure")
    failed = ops.count_by(rows.where("failure = 1"), ["vault_id"], "failure", "observations")
    others = ops.count_by(rows.where("failure = 0"), ["vault_id"], "failure", "observations")
    return failed.withColumn("cohort", F.lit(1)).unionByName(others.withColumn("cohort", F.lit(0)))


# Joins


@query
def join_inner_using(spark, sf_dir):
    failed = telemetry(spark, sf_dir, "vault_id", "model", "failure").where(F.col("failure") == 1)
    totals = ops.count_by(failed, ["vault_id"], "failure", "total_failures")
    models = ops.distinct_by(failed, "vault_id", "model", "unique_models")
    return totals.join(models, "vault_id").withColumn("unique_models", joined_text("unique_models"))


@query
def latest_rows(spark, sf_dir):
    return ops.latest_rows(hours_input(spark, sf_dir)).withColumn("data", wall_clock("data"))


@query
def latest_rows_kept(spark, sf_dir):
    """Latest rows and failure flag from a state that three deliveries were merged into, the newest one first."""
    state = scratch_folder(spark, "newest")
    rows = hours_input(spark, sf_dir).withColumn("data", wall_clock("data"))
    year = F.year("data")
    for part in (year >= 1997, year < 1995, year.between(1995, 1996)):
        ops.merge_newest(rows.where(part), state)
    return ops.read_newest(spark, state)


@query
def failed_flag(spark, sf_dir):
    history = hours_input(spark, sf_dir)
    flagged = ops.flag_ever_failed(ops.latest_rows(history), history)
    return flagged.withColumn("data", wall_clock("data"))


# Aggregates


@query
def totals_by_increments(spark, sf_dir):
    """Totals by vault and model from partial sums of months; three deliveries, one of them sent twice."""
    table = scratch_folder(spark, "totals")
    rows = telemetry(spark, sf_dir, "data", "vault_id", "model", "failure").withColumn("data", parse_instant("data"))
    year = F.year("data")
    parts = [year < 1995, year.between(1995, 1996), year >= 1997]
    for number in (0, 1, 2, 1):
        ops.add_to_totals(rows.where(parts[number]), table, f"part{number}", "month")
    return ops.read_totals(spark, table, ["vault_id", "model"])


@query
def sum_by_day_vault(spark, sf_dir):
    rows = telemetry(spark, sf_dir, "data", "vault_id", "failure").withColumn("data", parse_day("data"))
    return ops.sum_by(rows, ["data", "vault_id"], "failure", "failures_count")


@query
def sum_by_model(spark, sf_dir):
    return ops.sum_by(telemetry(spark, sf_dir, "model", "failure"), ["model"], "failure", "total_failures")


@query
def count_by_vault(spark, sf_dir):
    failed = telemetry(spark, sf_dir, "vault_id", "failure").where(F.col("failure") == 1)
    return ops.count_by(failed, ["vault_id"], "failure", "total_failures")


@query
def models_by_vault(spark, sf_dir):
    failed = telemetry(spark, sf_dir, "vault_id", "model", "failure").where(F.col("failure") == 1)
    listed = ops.distinct_by(failed, "vault_id", "model", "unique_models")
    return listed.select(
        "vault_id", F.size("unique_models").alias("model_count"), joined_text("unique_models", "|").alias("unique_models")
    )


@query
def max_date_by_serial(spark, sf_dir):
    rows = hours_input(spark, sf_dir).select("serial_number", "data")
    return ops.latest_instants(rows).withColumn("max_date", wall_clock("max_date"))


@query
def distinct_failed(spark, sf_dir):
    return ops.failed_keys(telemetry(spark, sf_dir, "serial_number", "failure"))


@query
def global_stats(spark, sf_dir):
    return ops.global_stats(telemetry(spark, sf_dir, HOURS), HOURS)


@query
def percentiles_exact(spark, sf_dir):
    return ops.distribution_stats(telemetry(spark, sf_dir, HOURS), HOURS)


@query
def percentiles_approx(spark, sf_dir):
    """Per vault: groups below the sketch's resolution, where it has to be exact."""
    return ops.distribution_stats(telemetry(spark, sf_dir, "vault_id", HOURS), HOURS, "vault_id", accuracy=10_000)


@query
def percentiles_by_drive(spark, sf_dir):
    """Exact percentiles of very many groups."""
    return ops.distribution_stats(telemetry(spark, sf_dir, "serial_number", HOURS), HOURS, "serial_number")


@query
def stats_by_cohort(spark, sf_dir):
    rows = telemetry(spark, sf_dir, "failure", HOURS)
    return ops.distribution_stats(rows, HOURS, "failure", (1, 0))
