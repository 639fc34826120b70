"""Command line: ``spark-submit`` or ``python -m spindlewatch REPORT ...``."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from spindlewatch import jobs, sources
from spindlewatch.session import build_session, size_session


def redis_client(address: str) -> Callable[[], object]:
    """A factory of Redis clients, for executors that have the ``redis`` package."""
    host, _, port = address.partition(":")

    def connect() -> object:
        try:
            from redis import Redis
        except ImportError as error:
            raise RuntimeError("writing to Redis needs the redis package on the executors") from error
        return Redis(host=host, port=int(port or 6379))

    return connect


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="spindlewatch", description="Reliability reports over drive telemetry.")
    parser.add_argument("report", choices=("daily", "rankings", "hours"))
    given = parser.add_mutually_exclusive_group(required=True)
    given.add_argument("--raw", help="raw CSV with a header; extracts are built under --work if absent")
    given.add_argument("--parquet", help="telemetry in Parquet, plain or with union structs")
    parser.add_argument("--work", help="folder of the extracts, with --raw")
    parser.add_argument("--rename", action="append", default=[], metavar="OLD=NEW", help="rename a raw column")
    parser.add_argument("--out", action="append", default=[], help="folder for CSV results; may be repeated")
    parser.add_argument("--together", action="store_true", help="publish all copies of a result as one version")
    parser.add_argument("--shared-files", action="store_true", help="file: folders of --out are one mount on all machines")
    parser.add_argument("--store", help="folder of the cell table")
    parser.add_argument("--batch", type=int, help="batch number in the cell table, to run one again; by default a new one")
    parser.add_argument("--redis", metavar="HOST:PORT", help="also set the hashes in Redis")
    parser.add_argument("--show", action="store_true", help="print the first rows of every result")
    parser.add_argument("--counts", type=int, nargs="+", default=(2, 3, 4), help="daily: wanted failure counts")
    parser.add_argument("-k", type=int, default=10, help="rankings: number of rows")
    parser.add_argument("--accuracy", type=int, help="hours: use the percentile sketch with this accuracy")
    options = parser.parse_args(arguments)
    if options.raw and not options.work:
        parser.error("--raw needs --work")
    return options


def refuse_own_disks(folders: Sequence[str], master: str) -> None:
    """On a cluster a ``file:`` folder is another disk on every machine: rows would be lost without an error."""
    local = [folder for folder in folders if folder.startswith("file:")]
    if local and not master.startswith("local"):
        raise ValueError(f"{local[0]} lies on every machine's own disk; give --shared-files if it is one mount")


def main(arguments: Sequence[str] | None = None) -> None:
    options = parse(arguments)
    spark = build_session(f"spindlewatch {options.report}")
    if not options.shared_files:
        refuse_own_disks(options.out, spark.sparkContext.master)
    source = options.parquet
    if options.raw:
        source = f"{options.work.rstrip('/')}/{options.report}.parquet"
        csv_extract = f"{options.work.rstrip('/')}/{options.report}.csv"
        size_session(spark, options.raw)
        renames = dict(pair.split("=", 1) for pair in options.rename)
        sources.ingest_extract(spark, options.raw, csv_extract, source, options.report, renames, follow_changes=True)
    size_session(spark, source)
    telemetry = sources.read_parquet(spark, source)
    outputs = jobs.Outputs(
        folders=options.out,
        store=options.store,
        batch=options.batch,
        connect=redis_client(options.redis) if options.redis else None,
        together=options.together,
        preview=(lambda df: df.show(max(20, options.k), truncate=False)) if options.show else None,
    )
    if options.report == "daily":
        jobs.run_daily(telemetry, outputs, options.counts)
    elif options.report == "rankings":
        jobs.run_rankings(telemetry, outputs, options.k)
    else:
        jobs.run_hours(telemetry, outputs, options.accuracy)


if __name__ == "__main__":
    main()
