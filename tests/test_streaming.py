"""Streaming jobs on file sources: record filtering, late data, update merge."""
import datetime as dt
import os
import tempfile

import pytest

from paneltide.streaming import alert_records, window_summary
from paneltide.streaming.sources import file_stream


def _write(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_record_stream_drops_bad_json_and_keeps_processed_at(spark):
    d = tempfile.mkdtemp(prefix="pt-rec-")
    _write(f"{d}/in", "a.json", [
        "nope", "[1]", '{"country_code": ""}', '{"k": 9}',
        '{"dataset":"gdp_annual","country_code":"DE","year":2001,"value":1.5,"z_score":"x",'
        '"severity":"LOW","detected_at":"2024-01-01T00:00:00.000000"}',
        '{"dataset":"gdp_annual","country_code":"FR","year":"2002","processed_at":'
        '"2024-01-03T00:00:00.000000"}'])
    out = alert_records.run_alert_records(spark, file_stream(spark, f"{d}/in"), f"{d}/out",
                                          f"{d}/ckpt", dt.datetime(2024, 1, 2))
    rows = {r["country_code"]: r for r in out.collect()}
    assert set(rows) == {"DE", "FR"}
    assert rows["DE"]["z_score"] is None and rows["DE"]["value"] == 1.5  # mistyped kept
    assert rows["DE"]["processed_at"] == dt.datetime(2024, 1, 2)
    assert rows["FR"]["processed_at"] == dt.datetime(2024, 1, 3)
    assert rows["FR"]["year"] == 2002


def _alert(code, ts, z=2.5, sev="LOW"):
    return ('{"dataset":"d","country_code":"%s","year":2024,"value":1.0,"z_score":%s,'
            '"severity":"%s","detected_at":"%s"}' % (code, z, sev, ts))


def test_window_summary_late_data_update_merge_and_folding(spark):
    d = tempfile.mkdtemp(prefix="pt-win-")
    src, out, ckpt = f"{d}/in", f"{d}/out", f"{d}/ckpt"
    batches = [
        [_alert("DE", "2024-01-01T00:01:00.000000"), _alert("DE", "2024-01-01T00:02:00.000000", z=-3.5)],
        [_alert("DE", "2024-01-02T01:00:00.000000")],   # the watermark passes the first window
        [_alert("DE", "2024-01-01T00:03:00.000000"), _alert("DE", "2024-01-02T01:01:00.000000")]]

    def check(df):
        got = {(r["window_start"].day, r["window_start"].hour): r for r in df.collect()}
        assert len(got) == 2
        assert got[(1, 0)]["alert_count"] == 2 and got[(1, 0)]["max_abs_z"] == 3.5    # late row ignored
        assert got[(2, 1)]["alert_count"] == 2                                       # last update wins
    for i, lines in enumerate(batches):
        _write(src, f"{i}.json", lines)
        summary = window_summary.run_window_summary(spark, file_stream(spark, src), out, ckpt)
    check(summary)
    # the first day is closed: one row per window, no updates left, the second is open
    folded = window_summary.folded_table(out)
    assert window_summary._days(spark, folded) == [dt.date(2024, 1, 1)] and window_summary._days(spark, out) == [dt.date(2024, 1, 2)]
    assert spark.read.parquet(folded).count() == 1
    for _ in range(2):                                                               # folding again changes nothing
        assert window_summary.fold_closed(spark, out, dt.datetime(2024, 1, 2, 0, 30)) == []
        check(window_summary.current_summary(spark, out))


def test_a_crash_between_fold_and_drop_changes_nothing(spark, tmp_path, monkeypatch):
    src, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "c"))
    for i, day in enumerate((1, 3, 5)):
        _write(src, f"{i}.json", [_alert("DE", f"2024-01-0{day}T00:0{m}:00.000000") for m in (1, 2)])
    query = window_summary.start_window_summary(file_stream(spark, src, 1), out, ckpt, {"availableNow": True})
    query.awaitTermination()
    before = sorted(map(tuple, window_summary.current_summary(spark, out).collect()))
    drop = window_summary._drop_days

    def stop(spark, path, days):
        if days:
            raise RuntimeError("stopped")
    monkeypatch.setattr(window_summary, "_drop_days", stop)
    rows = window_summary._updates(spark, out)
    closed = rows.filter("window_day = date'2024-01-03'") if dt.date(2024, 1, 3) in window_summary._days(spark, out) else None
    if closed is not None:
        with pytest.raises(RuntimeError):
            window_summary.fold_closed(spark, out, dt.datetime(2024, 1, 4))
        assert dt.date(2024, 1, 3) in window_summary._days(spark, out)               # updates are still there, unread
        assert sorted(map(tuple, window_summary.current_summary(spark, out).collect())) == before
    monkeypatch.setattr(window_summary, "_drop_days", drop)
    window_summary.fold_closed(spark, out, dt.datetime(2024, 1, 4))
    assert dt.date(2024, 1, 3) not in window_summary._days(spark, out)
    assert sorted(map(tuple, window_summary.current_summary(spark, out).collect())) == before


def test_the_running_job_folds_closed_days(spark, tmp_path):
    """One query over four micro-batches: by its end the first days are one row per window."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(4):
        _write(src, f"{i}.json", [_alert("DE", f"2024-01-0{2 * i + 1}T00:0{m}:00.000000") for m in (1, 2, 3)])
        os.utime(f"{src}/{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    window_summary.start_window_summary(file_stream(spark, src, 1), out, str(tmp_path / "c"),
                                        {"availableNow": True}).awaitTermination()
    assert dt.date(2024, 1, 1) in window_summary._days(spark, window_summary.folded_table(out))
    assert dt.date(2024, 1, 1) not in window_summary._days(spark, out)
    assert sorted(r["alert_count"] for r in window_summary.current_summary(spark, out).collect()) == [3, 3, 3, 3]


def test_reader_options_of_each_job(spark, monkeypatch):
    from paneltide.streaming import jobs, sources
    asked = []
    monkeypatch.setattr(jobs, "kafka_stream", lambda spark, servers, topic, **more: asked.append(
        sources.kafka_options(servers, topic, **more)))
    for job in ("alert_records", "event_driven", "window_summary"):
        for more in ([], ["--from", "earliest", "--group", "own", "--per-trigger", "5"]):
            with pytest.raises(Exception):                                           # no stream to start
                jobs.start(spark, [job, "--servers", "h:1", "--topic", "t", "--sink", "s", "--checkpoint", "c", "--landed", "l", *more])
    assert [a["startingOffsets"] for a in asked] == ["earliest", "earliest", "earliest", "earliest", "latest", "earliest"]
    assert [a["kafka.group.id"] for a in asked][:3] == ["paneltide-alert_records", "own", "paneltide-event_driven"]
    assert "maxOffsetsPerTrigger" not in asked[0] and asked[1]["maxOffsetsPerTrigger"] == "5"
    for bad in (dict(servers="", topic="t"), dict(servers="h:1", topic=""), dict(servers="h:1", topic="t", starting_offsets="x")):
        with pytest.raises(ValueError):
            sources.kafka_options(**bad)
    args = jobs.parser().parse_args(["event_driven", "--files", "f", "--sink", "s", "--checkpoint", "c", "--message-topic", "m"])
    with pytest.raises(ValueError):
        jobs.message_target(args)
    args.message_servers = "h:2"
    assert jobs.message_target(args).options == {"kafka.bootstrap.servers": "h:2"}


def test_stamps_are_those_of_the_micro_batch(spark, tmp_path):
    """Without a given stamp every micro-batch has its own time."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(2):
        _write(src, f"{i}.json", [_alert("DE", f"2024-01-0{i + 1}T00:00:00.000000")])
        alert_records.run_alert_records(spark, file_stream(spark, src), out, str(tmp_path / "c"))
    stamps = sorted(r["processed_at"] for r in spark.read.parquet(out).collect())
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert stamps[0] < stamps[1] and all(dt.timedelta(0) <= now - s < dt.timedelta(minutes=10) for s in stamps)


def test_unique_records_and_their_accounts(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [[_alert("DE", "2024-01-01T00:01:00.000000")] * 3 + [_alert("FR", "2024-01-01T00:01:10.000000")],
               [_alert("DE", "2024-01-01T00:01:00.000000"), _alert("IT", "2024-01-01T00:00:50.000000"),   # within 30 s
                _alert("DE", "2024-01-01T00:02:00.000000")],
               [_alert("DE", "2024-01-01T00:01:00.000000"), _alert("ES", "2024-01-01T00:01:30.000000"),   # too late
                _alert("ES", "2024-01-01T00:01:30.001000"), "nope"]]
    accounts = []
    for i, lines in enumerate(batches):
        _write(src, f"{i}.json", lines)
        query = alert_records.start_unique_records(file_stream(spark, src), out, str(tmp_path / "c"), dt.datetime(2024, 1, 9),
                                                   {"availableNow": True})
        query.awaitTermination()
        accounts += alert_records.accounting(query)
    got = sorted((r["country_code"], r["detected_at"].minute, r["detected_at"].second) for r in spark.read.parquet(out).collect())
    assert got == [("DE", 1, 0), ("DE", 2, 0), ("ES", 1, 30), ("FR", 1, 10), ("IT", 0, 50)]
    assert [a[1:] for a in accounts] == [(4, 0, 2), (3, 0, 2), (4, 2, 1)]


def test_slices_lose_no_row(spark, tmp_path):
    from paneltide.streaming.sources import even_cuts, in_slices, slice_of
    rows = [(str(i), dt.datetime(2024, 1, 1 + i % 20) if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "value string, t timestamp_ntz").repartition(3)
    cuts, path, seen = even_cuts(df, "t", 4), str(tmp_path / "s"), []
    for i in in_slices(df, path, slice_of("t", cuts), 4):
        seen.append(spark.read.text(path).count())
    assert len(cuts) == 3 and seen[-1] == 60 and seen == sorted(seen) and seen[0] >= 12
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == sorted(r[0] for r in rows)
    assert even_cuts(df.limit(0), "t", 4) == []


def test_completion_events_drive_the_detector(spark, tmp_path):
    """The batch run publishes an event per landed table and one for all; the event-driven
    job started on that folder finds the alerts of the run."""
    import json

    from paneltide.operators.panel import union_panel
    from paneltide.operators.staging import extraction_slice
    from paneltide.params import TEST_PARAMS
    from paneltide.plans import pipeline
    from paneltide.sources import testdata
    from paneltide.sources.sinks import MessageSink
    from paneltide.streaming import event_driven
    out, counts = str(tmp_path / "out"), {}
    target = MessageSink(str(tmp_path / "events"))
    params = TEST_PARAMS.with_(z_threshold=1.5)
    pipeline.run_batch(spark, "/root/testdata/sf0.001", out, params, counts, messages=target)
    events = [json.loads(r["value"]) for r in spark.read.text(target.target).collect()]
    assert {e["dataset"]: e["record_count"] for e in events} == {
        **{n: counts[n] for n in testdata.K.DATASETS}, testdata.K.FULL_PIPELINE_EVENT: sum(counts[n] for n in testdata.K.DATASETS)}
    for e in events:
        if e["dataset"] in counts:
            table = spark.read.parquet(f"{out}/{e['dataset']}")
            assert e["record_count"] == table.count() and e["countries"] == sorted({r[0] for r in table.select("country_code").collect()})
    registry = pipeline.landed_registry(spark, out)

    def landed(names):
        return extraction_slice(union_panel({n: registry.load(n) for n in names}, testdata.PANEL_COLUMNS))
    found = event_driven.run_event_driven(spark, file_stream(spark, target.target), landed, str(tmp_path / "alerts"),
                                          str(tmp_path / "c"), params).drop("request")
    written = spark.read.parquet(f"{out}/anomaly_alerts").filter(testdata.F.col("dataset").isin(list(testdata.K.DATASETS)))
    key = lambda df: sorted(map(str, df.select("dataset", "country_code", "year", "z_score").collect()))
    assert key(written) and key(found) == sorted(2 * key(written))      # once for its table, once for all


def test_jobs_by_configuration(spark, tmp_path):
    from paneltide.streaming import jobs
    src = str(tmp_path / "in")
    _write(src, "a.json", [_alert("DE", "2024-01-01T00:01:00.000000")])
    for job in ("window_summary", "alert_records"):
        jobs.start(spark, [job, "--files", src, "--sink", f"{tmp_path}/{job}", "--checkpoint", f"{tmp_path}/{job}-c",
                           "--once", "--per-trigger", "1"]).awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/{job}").count() == 1
    for argv in (["window_summary", "--sink", "x", "--checkpoint", "y"],
                 ["event_driven", "--files", src, "--sink", "x", "--checkpoint", "y"]):
        with pytest.raises(ValueError):
            jobs.start(spark, argv)


def test_event_driven_reads_requested_tables_appends_and_publishes(spark, tmp_path):
    from paneltide.params import TEST_PARAMS
    from paneltide.sources.sinks import MessageSink
    from paneltide.streaming import event_driven
    rows = [(n, "DE", y, 100.0 if y == 2019 else 0.0) for n in ("gdp_annual", "energy_intensity") for y in range(2000, 2020)]
    panel = spark.createDataFrame(rows, "dataset string, country_code string, year int, value double")
    asked = []

    def landed(names):
        asked.append(names)
        return panel.filter(panel.dataset.isin(names))
    src, sink = str(tmp_path / "in"), str(tmp_path / "alerts")
    for i, name in enumerate(["gdp_annual", "nope", "x_full_pipeline"]):
        _write(src, f"{i}.json", ['{"dataset":"%s","record_count":1}' % name])
        out = event_driven.run_event_driven(spark, file_stream(spark, src), landed, sink, str(tmp_path / "c"),
                                            TEST_PARAMS, MessageSink(str(tmp_path / "messages")))
    assert asked == [["gdp_annual"], ["energy_intensity", "gdp_annual", "inflation_annual", "unemployment_annual"]]
    got = sorted((r["request"], r["dataset"], r["year"]) for r in out.collect())
    assert got == [("gdp_annual", "gdp_annual", 2019), ("x_full_pipeline", "energy_intensity", 2019),
                   ("x_full_pipeline", "gdp_annual", 2019)]
    assert spark.read.text(str(tmp_path / "messages")).count() == 3


def test_window_summary_keeps_malformed_rows_with_null_keys(spark):
    d = tempfile.mkdtemp(prefix="pt-bad-")
    _write(f"{d}/in", "a.json", ["nope", _alert("DE", "2024-01-01T00:01:00.000000")])
    out = window_summary.run_window_summary(spark, file_stream(spark, f"{d}/in"), f"{d}/out",
                                            f"{d}/ckpt").collect()
    keys = {(r["country_code"], r["alert_count"]) for r in out}
    assert ("DE", 1) in keys and (None, 1) in keys  # stamped with processing time
