"""Command line: ``python -m cadence {prepare,stream,windows,refresh,coverage,dashboard} ...``.

prepare   catalog CSV + history CSV -> feature store (3 tiers) + cleaned history
stream    log stream (Kafka topic or a folder of JSON-line files) -> result tables
coverage  catalog CSV + history CSV -> the coverage report (one row)
windows   log stream -> event-time windowed metrics (mood, leaderboard or engagement)
refresh   events table + catalog CSV -> the dimension tables
dashboard result tables -> every panel as a folder of JSON lines
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from cadence.session import build_session, run_folder


def _session(args):
    return build_session(args.master, app=f"cadence-{args.cmd}")


def cmd_prepare(args) -> int:
    from cadence.operators import prepare
    from cadence.sources.files import read_catalog, read_history, write_feature_store, write_history
    spark = _session(args)
    catalog = read_catalog(spark, args.catalog)
    clean = prepare.clean_catalog(catalog)
    prepare.assert_unique(clean, "id")
    tracks, artists, glob = prepare.track_features(clean), prepare.artist_features(clean), prepare.global_features(clean)
    write_feature_store(tracks, artists, glob, args.store, fmt="json" if args.json else "parquet")
    write_history(prepare.clean_history(read_history(spark, args.history)), args.history_out, fmt=args.history_format)
    print(json.dumps({"store": args.store, "history": args.history_out}))
    return 0


def cmd_coverage(args) -> int:
    from cadence.operators.coverage import coverage_report
    from cadence.sources.files import read_catalog, read_history
    spark = _session(args)
    row = coverage_report(read_history(spark, args.history), read_catalog(spark, args.catalog),
                          normalize=not args.exact).first()
    print(json.dumps(row.asDict()))
    return 0


def _sink(args):
    from cadence.sources.sinks import JdbcSink, TableSink
    if args.jdbc_url:
        return JdbcSink(args.jdbc_url, {"driver": args.jdbc_driver} if args.jdbc_driver else {})
    return TableSink(args.sink)


def _logs(spark, args):
    from cadence.sources.kafka import parse_logs, read_log_stream
    from cadence.streaming.replay import replay_stream
    if args.source == "kafka":
        raw = read_log_stream(spark, args.bootstrap, args.topic, args.starting_offsets, min_partitions=args.min_partitions)
        return parse_logs(raw, "value")
    return replay_stream(spark, args.input, files_per_trigger=args.files_per_trigger)


def _trigger(args) -> dict | None:
    if args.available_now:
        return {"availableNow": True}
    return {"processingTime": f"{args.trigger_seconds} seconds"} if args.trigger_seconds else None


def _finish(q) -> int:
    q.awaitTermination()
    if q.exception() is not None:
        print(q.exception(), file=sys.stderr)
        return 1
    return 0


def cmd_stream(args) -> int:
    from cadence.sources.files import read_catalog
    from cadence.streaming.job import WatchedStore, start_stream_job
    from cadence.streaming.progress import ProgressRecorder
    spark = _session(args)
    store = WatchedStore(spark, args.store, read_catalog(spark, args.catalog) if args.catalog else None)
    sink = _sink(args)
    checkpoint = args.checkpoint or run_folder(spark, "stream-checkpoint")
    recorder = ProgressRecorder(spark, sink).attach()
    try:
        logs = _logs(spark, args)
        if args.drop_repeats:
            from cadence.streaming.repeats import drop_repeats
            logs = drop_repeats(logs, args.drop_repeats)
        q = start_stream_job(logs, store, sink, checkpoint, trigger=_trigger(args), query_name="cadence-stream")
        failed = _finish(q)
    finally:
        recorder.close()
        store.release()
    if not failed:
        print(json.dumps({"batches": recorder.batches, "checkpoint": checkpoint}))
    return failed


def cmd_windows(args) -> int:
    from cadence.sources.files import load_feature_store
    from cadence.streaming.job import FeatureStore
    from cadence.streaming.windows import enriched_stream, quarantine_stream, start_windowed
    spark = _session(args)
    checkpoint = args.checkpoint or run_folder(spark, "windows-checkpoint")
    logs = _logs(spark, args)
    if args.versioned:
        return _versioned_windows(args, spark, logs, checkpoint)
    store = FeatureStore.prepare(*load_feature_store(spark, args.store))
    aside = quarantine_stream(logs, os.path.join(args.out, "quarantine"), os.path.join(checkpoint, "quarantine"), _trigger(args))
    q = start_windowed(enriched_stream(logs, store, args.watermark), os.path.join(args.out, args.kind),
                       os.path.join(checkpoint, args.kind), kind=args.kind, size=args.size, trigger=_trigger(args), salts=args.salts)
    failed = _finish(q) or _finish(aside)
    store.release()
    return failed


def _versioned_windows(args, spark, logs, checkpoint: str) -> int:
    """The windowed job over enriched batches: a version that ``publish`` adds reaches it without a restart."""
    from pyspark.sql import types as T

    from cadence.schemas import ENRICHED_SCHEMA
    from cadence.streaming.versions import EnrichedBatches, VersionedStore, enriched_batches, start_enriched
    from cadence.streaming.windows import EVENT_TIME, quarantine_stream, start_windowed
    handler = EnrichedBatches(VersionedStore(spark, args.store), os.path.join(args.out, "enriched"))
    schema = T.StructType([*ENRICHED_SCHEMA.fields]).add(EVENT_TIME, "timestamp")
    aside = quarantine_stream(logs, os.path.join(args.out, "quarantine"), os.path.join(checkpoint, "quarantine"), _trigger(args))
    enriching = start_enriched(logs, handler, os.path.join(checkpoint, "enriched"), _trigger(args))
    failed = _finish(enriching) if args.available_now else 0
    q = start_windowed(enriched_batches(spark, handler.root, schema, args.watermark), os.path.join(args.out, args.kind),
                       os.path.join(checkpoint, args.kind), kind=args.kind, size=args.size, trigger=_trigger(args), salts=args.salts)
    failed = failed or _finish(q) or _finish(enriching) or _finish(aside)
    handler.release()
    return failed


def cmd_publish(args) -> int:
    """Add the feature store of a catalog as a new version."""
    from cadence.operators import prepare
    from cadence.sources.files import read_catalog
    from cadence.streaming.versions import VersionedStore
    spark = _session(args)
    clean = prepare.clean_catalog(read_catalog(spark, args.catalog))
    prepare.assert_unique(clean, "id")
    version = VersionedStore(spark, args.store).publish(
        prepare.track_features(clean), prepare.artist_features(clean), prepare.global_features(clean))
    print(json.dumps({"version": version}))
    return 0


def cmd_refresh(args) -> int:
    from cadence.operators import prepare
    from cadence.plans.dashboard import as_doubles
    from cadence.plans.increments import IncrementalDimensions
    from cadence.plans.refresh import refresh_dimensions
    from cadence.sources.files import read_catalog
    spark = _session(args)
    sink = _sink(args)
    if args.incremental:
        IncrementalDimensions(sink).refresh(spark, prepare.clean_catalog(read_catalog(spark, args.catalog)))
        return 0
    events = as_doubles(sink.read(spark, "realtime_streaming_events"))
    refresh_dimensions(sink, events, prepare.clean_catalog(read_catalog(spark, args.catalog)))
    return 0


def cmd_dashboard(args) -> int:
    """Write each panel in full, from the executors, as JSON lines under ``--out``/<panel>."""
    from pyspark.sql import functions as F

    from cadence.plans.dashboard import dashboard
    spark = _session(args)
    as_of = F.lit(args.as_of).cast("timestamp_ntz") if args.as_of else None
    minutes = None if args.minutes <= 0 else args.minutes
    for name, df in dashboard(spark, _sink(args), minutes=minutes, as_of=as_of, top_n=args.top).items():
        path = os.path.join(args.out, name)
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
        print(json.dumps({"panel": name, "path": path}))
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="cadence")
    p.add_argument("--master", default=os.environ.get("CADENCE_MASTER"))
    sub = p.add_subparsers(dest="cmd", required=True)

    a = sub.add_parser("prepare", help="build the feature store and the cleaned history")
    a.add_argument("--catalog", required=True)
    a.add_argument("--history", required=True)
    a.add_argument("--store", required=True)
    a.add_argument("--history-out", required=True)
    a.add_argument("--history-format", default="parquet", choices=["parquet", "csv"])
    a.add_argument("--json", action="store_true", help="write the store as keyed JSON")

    c = sub.add_parser("coverage", help="print the coverage report")
    c.add_argument("--catalog", required=True)
    c.add_argument("--history", required=True)
    c.add_argument("--exact", action="store_true", help="match artists exactly (as the enrichment does)")

    def sink_options(q):
        q.add_argument("--sink", help="folder of the Parquet result tables")
        q.add_argument("--jdbc-url")
        q.add_argument("--jdbc-driver")

    def source_options(q):
        q.add_argument("--source", choices=["kafka", "files"], default="kafka")
        q.add_argument("--bootstrap")
        q.add_argument("--topic")
        q.add_argument("--starting-offsets", default="latest")
        q.add_argument("--min-partitions", type=int)
        q.add_argument("--input", help="folder of JSON-line files (files source)")
        q.add_argument("--files-per-trigger", type=int, default=1)
        q.add_argument("--store", required=True)
        q.add_argument("--checkpoint")
        q.add_argument("--available-now", action="store_true")
        q.add_argument("--trigger-seconds", type=int)

    s = sub.add_parser("stream", help="run the streaming job")
    source_options(s)
    s.add_argument("--catalog", help="catalog CSV to build the store from when it is absent")
    s.add_argument("--drop-repeats", metavar="TIME", help="drop messages that came before within this time, e.g. '10 minutes'")
    sink_options(s)

    u = sub.add_parser("publish", help="add a version to a versioned feature store")
    u.add_argument("--catalog", required=True)
    u.add_argument("--store", required=True)

    v = sub.add_parser("windows", help="run one windowed streaming job")
    source_options(v)
    v.add_argument("--kind", choices=["mood", "leaderboard", "engagement"], default="mood")
    v.add_argument("--size", default="1 minute")
    v.add_argument("--watermark", default="10 minutes")
    v.add_argument("--salts", type=int, default=1, help="keys that the plays of a window and track are dealt over")
    v.add_argument("--versioned", action="store_true", help="--store holds versions (see publish); each batch takes the newest")
    v.add_argument("--out", required=True, help="folder of the windowed tables")

    r = sub.add_parser("refresh", help="write the dimension tables from the events table")
    sink_options(r)
    r.add_argument("--catalog", required=True)
    r.add_argument("--incremental", action="store_true", help="read only batches committed since the last refresh (needs --sink)")

    d = sub.add_parser("dashboard", help="write every panel from the result tables")
    sink_options(d)
    d.add_argument("--out", required=True, help="folder of the panels")
    d.add_argument("--minutes", type=int, default=30, help="lookback; 0 = all rows")
    d.add_argument("--as-of", help="anchor of the lookback, yyyy-MM-dd HH:mm:ss (default: now)")
    d.add_argument("--top", type=int, default=10)

    args = p.parse_args(argv)
    if args.cmd == "refresh" and args.incremental and not args.sink:
        p.error("--incremental needs --sink")
    if args.cmd in ("stream", "refresh", "dashboard") and not (args.sink or args.jdbc_url):
        p.error(f"{args.cmd} needs --sink or --jdbc-url")
    return {"prepare": cmd_prepare, "coverage": cmd_coverage, "stream": cmd_stream, "windows": cmd_windows, "publish": cmd_publish,
            "refresh": cmd_refresh, "dashboard": cmd_dashboard}[args.cmd](args)


if __name__ == "__main__":
    sys.exit(main())
