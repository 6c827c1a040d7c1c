"""Command line for `spark-submit`: the steps of the hourly chain, each over files or the stored table.

    transform RAW CLEAN      raw readings (JSON) to clean readings, every value as text
    load CLEAN STORE         append the clean readings that are not stored yet
    ingest RAW STORE         transform and load in one step, without the files in between
    stream LANDING STORE CHECKPOINT
                             every landed file once, then stop
    export STORE FOLDER      the newest readings of a selection as CSV, or all of them

Shuffle partitions are the session's (`--conf spark.sql.shuffle.partitions=...`); `--shuffled-bytes` before the command
derives them from the size of the input.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from hazeworks.functions import to_int
from hazeworks.operators.clean import clean
from hazeworks.operators.quality import require_rows
from hazeworks.operators.series import LOG_SIZE
from hazeworks.plans.dashboard import monitoring_log
from hazeworks.plans.load import load_raw
from hazeworks.plans.partials import Partials
from hazeworks.plans.session import configure
from hazeworks.schemas import POLLUTANTS
from hazeworks.sinks.fact import FactStore
from hazeworks.sinks.files import export_csv, write_clean_text
from hazeworks.sources.files import read_clean_text, read_raw
from hazeworks.sources.landed import ingest, read_responses
from hazeworks.streaming.ingest import start_ingest, start_reply_ingest, stream_raw, stream_replies, stream_responses


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="hazeworks", description=__doc__,
                                  formatter_class=argparse.RawDescriptionHelpFormatter)
    top.add_argument("--shuffled-bytes", type=int, help="bytes that the largest shuffle moves")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *positional: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        if "store" in positional:
            sub.add_argument("--table", help="catalog name of the stored table")
        return sub

    command("transform", "raw", "clean").add_argument("--array-files", action="store_true")
    command("load", "clean", "store")
    one_step = command("ingest", "raw", "store")
    one_step.add_argument("--replies", action="store_true", help="RAW holds station replies")
    one_step.add_argument("--array-files", action="store_true")
    stream = command("stream", "landing", "store", "checkpoint")
    stream.add_argument("--replies", action="store_true", help="LANDING holds station replies")
    stream.add_argument("--quarantine", help="where rejected replies go; without it they are left out")
    stream.add_argument("--partials", help="folder of the small tables, to be kept up to date")
    stream.add_argument("--archive", help="where files go once they are read")
    export = command("export", "store", "folder")
    export.add_argument("--pollutant", choices=POLLUTANTS, default=POLLUTANTS[0])
    export.add_argument("--rows", type=int, default=LOG_SIZE, help="how many of the newest; 0 for all")
    export.add_argument("--city", action="append", dest="cities", help="displayed city; may be repeated")
    export.add_argument("--category", action="append", dest="categories", help="displayed category; may be repeated")
    return top


def run(spark: SparkSession, arguments: Sequence[str]) -> str:
    """Run one command; returns the line it reports."""
    args = parser().parse_args(arguments)
    store = None
    if "store" in args:
        store = FactStore(spark, args.store, args.table)
        store.create()
    if args.command == "transform":
        raw = read_raw(spark, args.raw, array_files=args.array_files)
        require_rows(raw.limit(1).count(), "raw readings")
        read, wrote = Observation(), Observation()
        counted = raw.observe(read, F.count("*").alias("rows"), F.count(to_int(F.col("aqi"))).alias("valid"))
        write_clean_text(clean(counted).observe(wrote, F.count("*").alias("rows")), args.clean)
        return f"read {read.get['rows']} rows, {read.get['valid']} valid, wrote {wrote.get['rows']}"
    if args.command == "load":
        result = store.append_new(read_clean_text(spark, args.clean))
    elif args.command == "ingest":
        raw = (ingest(read_responses(spark, args.raw)) if args.replies
               else read_raw(spark, args.raw, array_files=args.array_files))
        result = load_raw(raw, store)
    elif args.command == "stream":
        partials = Partials(store, args.partials) if args.partials else None
        if args.replies and args.quarantine:
            replies = stream_replies(spark, args.landing, archive=args.archive)
            query = start_reply_ingest(replies, store, args.quarantine, args.checkpoint, partials=partials)
        else:
            source = stream_responses if args.replies else stream_raw
            query = start_ingest(source(spark, args.landing, archive=args.archive), store, args.checkpoint, partials=partials)
        query.awaitTermination()
        return "read all landed files"
    else:
        chosen = monitoring_log(store.read(), args.pollutant, args.rows or None, args.cities, args.categories)
        return "wrote " + export_csv(chosen, args.folder)
    return f"inserted {result.inserted_rows} rows, skipped {result.skipped_rows} known ones"


def main() -> None:
    size = parser().parse_args(sys.argv[1:]).shuffled_bytes
    spark = configure(SparkSession.builder.appName("hazeworks"), shuffled_bytes=size).getOrCreate()
    print(run(spark, sys.argv[1:]))
    spark.stop()


if __name__ == "__main__":
    main()
