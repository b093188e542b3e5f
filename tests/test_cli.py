"""The command line runs the three jobs end to end on small files."""

import json
import os

from cadence.__main__ import main
from cadence.plans.workload import Workload
from cadence.sources.files import load_feature_store
from cadence.sources.sinks import TableSink

from .conftest import SF_SMALL
from .helpers import write_replay_files
from .test_sources import CATALOG_CSV, HISTORY_CSV


def test_prepare_coverage_and_stream(spark, scratch, capsys):
    cp, hp = os.path.join(scratch, "catalog.csv"), os.path.join(scratch, "history.csv")
    open(cp, "w").write(CATALOG_CSV)
    open(hp, "w").write(HISTORY_CSV)
    store, hist = os.path.join(scratch, "store"), os.path.join(scratch, "hist")
    assert main(["prepare", "--catalog", cp, "--history", hp, "--store", store, "--history-out", hist]) == 0
    assert spark.read.parquet(os.path.join(store, "tracks")).count() == 2
    assert spark.read.parquet(hist).count() == 2

    capsys.readouterr()
    assert main(["coverage", "--catalog", cp, "--history", hp]) == 0
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["total_logs"] == 3 and report["track_logs"] == 2

    w = Workload(spark, SF_SMALL)
    inp, sink = os.path.join(scratch, "in"), os.path.join(scratch, "tables")
    write_replay_files(w.history, inp, 2)
    load_feature_store(spark, os.path.join(scratch, "store2"), catalog=w.catalog)
    rc = main(["stream", "--source", "files", "--input", inp, "--store", os.path.join(scratch, "store2"),
               "--sink", sink, "--checkpoint", os.path.join(scratch, "ck"), "--available-now"])
    assert rc == 0
    assert TableSink(sink).read(spark, "realtime_streaming_events").count() == w.history.count()

    capsys.readouterr()
    out = os.path.join(scratch, "panels")
    assert main(["dashboard", "--sink", sink, "--minutes", "0", "--out", out]) == 0
    told = {x["panel"]: x["path"] for x in map(json.loads, capsys.readouterr().out.strip().splitlines())}
    assert spark.read.json(told["kpi"]).first().total_events == w.history.count()
    assert spark.read.json(told["heatmap_grid"]).count() == 7 and spark.read.json(told["top_tracks"]).count() == 10
    assert TableSink(sink).read(spark, "system_metrics").count() == 2      # one report per micro-batch

    assert main(["refresh", "--sink", sink, "--catalog", cp]) == 0
    assert TableSink(sink).read(spark, "artists").count() == 2
    assert main(["windows", "--source", "files", "--input", inp, "--store", os.path.join(scratch, "store2"), "--kind", "leaderboard",
                 "--size", "1 day", "--out", os.path.join(scratch, "win"), "--checkpoint", os.path.join(scratch, "wck"), "--available-now"]) == 0
    assert spark.read.parquet(os.path.join(scratch, "win", "leaderboard")).count() > 0


def test_versioned_windows(spark, scratch, capsys):
    cp, inp, versions = (os.path.join(scratch, n) for n in ("catalog.csv", "in", "versions"))
    open(cp, "w").write(CATALOG_CSV)
    capsys.readouterr()
    for number in (0, 1):
        assert main(["publish", "--catalog", cp, "--store", versions]) == 0
        assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"version": number}
    write_replay_files(Workload(spark, SF_SMALL).history, inp, 2)
    out = os.path.join(scratch, "win")
    assert main(["windows", "--source", "files", "--input", inp, "--files-per-trigger", "5", "--store", versions, "--versioned", "--salts", "4",
                 "--size", "1 day", "--out", out, "--checkpoint", os.path.join(scratch, "ck"), "--available-now"]) == 0
    assert spark.read.parquet(os.path.join(out, "mood")).count() > 0
    assert os.listdir(os.path.join(out, "enriched", "_chosen")) and spark.read.parquet(os.path.join(out, "enriched", "batch-*")).count() > 0
