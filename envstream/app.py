"""Command line: ``spark-submit --py-files ... run.py <job> ...``.

    plan    locations of a catalogue, and the requests to make for them
    land    answers of overlapping requests -> raw documents
    replay  raw files -> messages of both topics, in order of time
    backfill  all messages that the topics hold -> joined readings
    tables  messages -> locations and two fact tables
    train   messages -> joined readings -> one forest per micro-batch
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.operators import catalogue as cat
from envstream.operators.clean import last_per_key
from envstream.operators.encode import MAX_ENTRIES, span_of
from envstream.operators.metrics import SCORE_PARTS, metrics_of_parts
from envstream.operators.parse import air_rows, weather_rows
from envstream.operators.unify import unify
from envstream.plans.landing import SPREAD, merge_answers, replay_messages
from envstream.session import build_session, streaming_session
from envstream.sinks.outputs import (
    in_stretches, raw_lines, write_csv, write_feed, write_lines, write_topic,
)
from envstream.sources import files, split_documents
from envstream.sources.kafka import Topics, backfill_topics, read_topic
from envstream.sources.tables import DatabaseStore, FolderStore
from envstream.streaming.batch_parts import BatchParts
from envstream.streaming.queries import LastInput, start_batches, stop_when_idle, unified_stream
from envstream.streaming.table_writer import TableWriter
from envstream.streaming.trainer import BatchTrainer


def _parser():
    parser = argparse.ArgumentParser(prog="envstream")
    parser.add_argument("--partitions", type=int, help="shuffle and state partitions")
    jobs = parser.add_subparsers(dest="job", required=True)

    plan = jobs.add_parser("plan")
    plan.add_argument("--catalogue", required=True)
    plan.add_argument("--names", required=True)
    plan.add_argument("--country", required=True)
    plan.add_argument("--first-day", required=True)
    plan.add_argument("--weeks", type=int, default=9)
    plan.add_argument("--zone", default="UTC")
    plan.add_argument("--out", required=True)

    replay = jobs.add_parser("replay")
    replay.add_argument("--air-file", required=True)
    replay.add_argument("--weather-file", required=True)
    replay.add_argument("--whole", action="store_true", help="a file is one document, not a line")
    replay.add_argument("--first", type=int, help="only the first times")
    replay.add_argument("--stretch", type=int, default=3600,
                        help="seconds of readings that are sent side by side; the next wait")
    replay.add_argument("--spread", type=int, default=SPREAD, help="groups of an hour's locations")
    replay.add_argument("--max-entries", type=int, default=MAX_ENTRIES, help="entries of a message")

    land = jobs.add_parser("land")
    land.add_argument("--answers", required=True, help="lines of location_name, fetch_no, list")
    land.add_argument("--kind", choices=("air", "weather"), required=True)
    land.add_argument("--out", required=True)

    backfill = jobs.add_parser("backfill")
    backfill.add_argument("--out", required=True, help="folder for the joined readings")

    tables = jobs.add_parser("tables")
    tables.add_argument("--root", help="folder of the tables")
    tables.add_argument("--jdbc-url", help="database in place of a folder")
    tables.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE")
    tables.add_argument("--ledger")
    tables.add_argument("--rejected")
    tables.add_argument("--fill-nulls", action="store_true")
    tables.add_argument("--keyed", action="store_true",
                        help="keys of locations from their names, for several writers")

    train = jobs.add_parser("train")
    train.add_argument("--models", required=True)
    train.add_argument("--metrics", required=True)
    train.add_argument("--delay", help="watermark, such as '2 hours'; default: keep all state")
    train.add_argument("--parts", type=int, default=1, help="spread hot keys over so many parts")
    train.add_argument("--scores", help="folder for the parts of scores over the whole stream")
    train.add_argument("--verbose", action="store_true")

    for job in (replay, tables, train, backfill):
        job.add_argument("--servers", help="broker addresses")
        job.add_argument("--feed", help="folder in place of a broker")
        job.add_argument("--air", default="air", help="topic")
        job.add_argument("--weather", default="weather", help="topic")
    for job in (tables, train):
        job.add_argument("--starting", default="latest")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--per-trigger", type=int, help="messages (or files) per micro-batch")
        job.add_argument("--drain", action="store_true", help="take what there is and end")
        job.add_argument("--idle", type=float, default=120.0, help="stop after so many seconds")
    return parser


def _messages(spark, args):
    if args.feed:
        spread = getattr(args, "parts", 1) > 1
        return files.read_feed(spark, args.feed, args.per_trigger, positions=spread)
    topics = Topics(
        args.servers, args.air, args.weather, args.starting, max_offsets=args.per_trigger
    )
    return read_topic(spark, topics)


def plan(spark, args):
    listed = split_documents.scan_name_line(spark, args.names)
    records = split_documents.scan_array_document(spark, args.catalogue, S.CATALOGUE_RECORD)
    rows = cat.in_country(records, args.country)
    places = cat.location_table(cat.named_in(rows, listed))
    write_csv(places, f"{args.out}/locations")
    write_csv(cat.fetch_plan(places, args.first_day, args.weeks, args.zone), f"{args.out}/requests")


def replay(spark, args):
    if args.whole:
        air = split_documents.scan_raw_air_document(spark, args.air_file)
        weather = split_documents.scan_raw_weather_document(spark, args.weather_file)
    else:
        air = files.scan_raw_air(spark, args.air_file, whole=False)
        weather = files.scan_raw_weather(spark, args.weather_file, whole=False)
    messages = replay_messages(
        air, weather, args.air, args.weather, whole=args.whole, spread=args.spread, first=args.first,
        max_entries=args.max_entries,
    )
    for part in in_stretches(messages, args.stretch):
        if args.feed:
            write_feed(part, args.feed)
        else:
            write_topic(part.selectExpr("cast(dt as string) as key", "topic", "value"),
                        args.servers)


def land(spark, args):
    """Answers of overlapping requests -> raw documents, one per line."""
    placed = args.kind == "air"
    answers = files.scan_answers(spark, args.answers, S.RAW_AIR if placed else S.RAW_WEATHER)
    readings = merge_answers(answers)
    if placed:
        last = last_per_key(answers.where("coord is not null"), ["location_name"], ["fetch_no"])
        readings = readings.join(last.select("location_name", "coord"), "location_name", "left")
    lines = raw_lines(readings, coord="coord" if placed else None, order=("dt",),
                      stretch=span_of("dt"))
    write_lines(lines, args.out)


def backfill(spark, args):
    """All messages that the topics hold -> joined readings."""
    if args.feed:
        messages = files.backfill_feed(spark, args.feed)
    else:
        messages = backfill_topics(spark, Topics(args.servers, args.air, args.weather))
    rows = unify(
        air_rows(messages.where(F.col("topic") == args.air)),
        weather_rows(messages.where(F.col("topic") == args.weather)))
    rows.write.mode("errorifexists").parquet(args.out)


def _run(spark, rows, handle, args):
    watch = LastInput()
    spark.streams.addListener(watch)
    try:
        query = start_batches(rows, handle, args.checkpoint, drain=args.drain)
        if args.drain:
            query.awaitTermination()
        else:
            stop_when_idle([query], watch, args.idle)
    finally:
        spark.streams.removeListener(watch)
    if watch.dropped:
        print(f"rows behind the watermark, by batch: {watch.dropped}", file=sys.stderr)


def _store(spark, args):
    if args.jdbc_url:
        options = dict(pair.split("=", 1) for pair in args.jdbc_option)
        return DatabaseStore(spark, args.jdbc_url, options)
    return FolderStore(spark, args.root, args.fill_nulls, args.keyed).create()


def tables(spark, args):
    store = _store(spark, args)
    writer = TableWriter(
        store, args.air, args.weather, args.checkpoint, args.ledger, args.rejected
    )
    _run(spark, _messages(spark, args), writer, args)


def train(spark, args):
    rows = unified_stream(_messages(spark, args), args.air, args.weather, args.delay, args.parts)
    trainer = BatchTrainer(args.models, args.metrics, verbose=args.verbose, scores=args.scores)
    parts = BatchParts(args.scores, SCORE_PARTS).create(spark) if args.scores else None
    _run(spark, rows, trainer, args)
    if parts:
        metrics_of_parts(parts.read(spark)).show()


def main(arguments=None):
    args = _parser().parse_args(arguments)
    if args.job not in ("plan", "land") and bool(args.servers) == bool(args.feed):
        raise SystemExit("name either --servers or --feed")
    if args.job == "tables" and bool(args.root) == bool(args.jdbc_url):
        raise SystemExit("name either --root or --jdbc-url")
    if args.job == "tables" and args.jdbc_url and args.keyed:
        raise SystemExit("--keyed is for folders")
    spark = build_session(f"envstream-{args.job}", args.partitions)
    if args.job in ("tables", "train"):
        spark = streaming_session(spark, args.partitions)
    jobs = {"plan": plan, "replay": replay, "land": land, "backfill": backfill,
            "tables": tables, "train": train}
    jobs[args.job](spark, args)
