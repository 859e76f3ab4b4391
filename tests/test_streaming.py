import datetime as dt
import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lakeops.streaming import aggregates, sinks, sources

SCHEMA = "time timestamp, action string, n int"
NOW = {"availableNow": True}


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(dict(zip(("time", "action", "n"), r))) + "\n" for r in rows))


def at(hour, minute=0):
    return f"2024-01-01T{hour:02d}:{minute:02d}:00"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def hours(df):
    return sorted((r["window_start"].hour, r["n"]) for r in df.collect())


def test_append_restarts_from_the_checkpoint(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    write(src, "1.json", [(at(1), "Open", 1)])

    def run():
        stream = sources.file_stream(spark, str(src), SCHEMA, "json", files_per_trigger=1)
        return sinks.run_available(sinks.append_files(stream, out, cp, trigger=NOW, name="appender"))

    run()
    write(src, "2.json", [(at(2), "Close", 2)])
    run()
    query = run()
    assert spark.read.parquet(out).count() == 2, "every file once, whatever the number of runs"
    assert query.isActive is False


def test_watermark_drops_only_what_is_too_late(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    session = sinks.stateful_session(spark, 2)
    files = [[(at(1), "Open", 1), (at(5), "Open", 1)], [(at(4, 30), "Open", 1), (at(1, 10), "Open", 1)], [(at(9), "Open", 1)]]
    for i, batch in enumerate(files):
        write(src, f"{i}.json", batch)
        stream = sources.file_stream(session, str(src), SCHEMA, "json")
        counts = aggregates.windowed(stream, "time", "1 hour", ["action"], watermark="2 hours")
        sinks.run_available(sinks.append_files(counts, out, cp, trigger=NOW))
    assert hours(spark.read.parquet(out)) == [(1, 1), (4, 1), (5, 1)], "01:10 came after its window had closed"


def test_complete_mode_equals_batch_and_may_sort(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    write(src, "1.json", [(at(h % 7, m), "Open", 1) for h in range(20) for m in (0, 31)])
    session = sinks.stateful_session(spark, 2)
    stream = sources.file_stream(session, str(src), SCHEMA, "json")
    counts = aggregates.windowed(stream, "time", "1 hour").orderBy("window_start")
    sinks.run_available(sinks.each_batch(counts, sinks.replace_table(out), str(tmp_path / "cp"), "complete", trigger=NOW))
    batch = aggregates.windowed(spark.read.schema(SCHEMA).json(str(src)), "time", "1 hour")
    assert rows(spark.read.parquet(out)) == rows(batch)
    with pytest.raises(AnalysisException):
        stream.orderBy("time").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp2")).start()


def test_upsert_survives_duplicate_files(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    body = sinks.upsert_table(out, ["action"], ["time", "n"])

    def run():
        stream = sources.file_stream(spark, str(src), SCHEMA, "json", files_per_trigger=1)
        sinks.run_available(sinks.each_batch(stream, body, cp, trigger=NOW))

    write(src, "1.json", [(at(1), "a", 1), (at(2), "a", 2), (at(1), "b", 1)])
    run()
    shutil.copy(src / "1.json", src / "copy.json")
    write(src, "3.json", [(at(3), "b", 9), (at(3), "c", 9)])
    # Files are taken in order of their modification time.
    for name, back in (("copy.json", 60), ("3.json", 30)):
        os.utime(src / name, (time.time() - back,) * 2)
    run()
    assert rows(spark.read.parquet(out).select("action", "n")) == [("a", 2), ("b", 9), ("c", 9)]


def test_rescued_lines(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "1.txt").write_text('{"a": 1, "b": "x"}\n{"a": "not a number"}\nbroken\n')
    stream = sources.with_rescued(sources.file_stream(spark, str(src), "value string", "text"), "a int, b string")
    sinks.run_available(sinks.append_files(stream, out, str(tmp_path / "cp"), trigger=NOW))
    got = {r["rescued"]: (r["a"], r["b"]) for r in spark.read.parquet(out).collect()}
    assert got[None] == (1, "x") and "broken" in got and len(got) == 3


def test_sliding_and_sessions_agree_with_batch(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "1.json", [(at(1), "a", 1), (at(1, 20), "a", 1), (at(3), "a", 1)])
    batch = spark.read.schema(SCHEMA).json(str(src))
    assert hours(aggregates.windowed(batch, "time", "2 hours", slide="1 hour")) == [(0, 2), (1, 2), (2, 1), (3, 1)]
    session = sinks.stateful_session(spark, 2)
    out = str(tmp_path / "out")
    stream = aggregates.sessions(sources.file_stream(session, str(src), SCHEMA, "json"), "time", "30 minutes", ["action"], "1 hour")
    sinks.run_available(sinks.each_batch(stream, sinks.replace_table(out), str(tmp_path / "cp"), "complete", trigger=NOW))
    want = [("a", dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 1, 50), 2), ("a", dt.datetime(2024, 1, 1, 3), dt.datetime(2024, 1, 1, 3, 30), 1)]
    assert [tuple(r) for r in spark.read.parquet(out).orderBy("session_start").collect()] == want


def test_query_management(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "1.json", [(at(1), "a", 1)])

    def start(name):
        stream = sources.file_stream(spark, str(src), SCHEMA, "json")
        return sinks.append_files(stream, str(tmp_path / name), str(tmp_path / f"cp-{name}"), name=name,
                                  trigger=sinks.trigger_options("processing", "1 second"))

    started = sources.start_each(["one", "two"], start)
    assert set(sinks.active_queries(spark)) == {"one", "two"}
    assert sinks.find_query(spark, "one").id == started["one"].id and sinks.find_query(spark, "none") is None
    assert sinks.wait_until_ready(started["two"], timeout_s=30)
    started["one"].processAllAvailable()
    assert sum(p["rows"] for p in sinks.progress_rows(started["one"])) == 1
    sinks.stop_all(spark)
    assert not sinks.active_queries(spark) and not sinks.wait_until_ready(started["one"])


def test_triggers():
    assert sinks.trigger_options("available") == {"availableNow": True}
    assert sinks.trigger_options("continuous", "1 second") == {"continuous": "1 second"}
    assert sinks.trigger_options("default") == {}
    for bad in (("processing", None), ("sometimes", "1 second")):
        with pytest.raises(ValueError):
            sinks.trigger_options(*bad)


def test_stateful_session_leaves_the_caller_alone(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = sinks.stateful_session(spark, 3)
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert session.range(3).select(F.sum("id")).first()[0] == 3


def test_growing_table(spark, tmp_path):
    path = str(tmp_path / "t")
    body = sources.growing_table(path, "a bigint")
    lines = lambda *rows: spark.createDataFrame([(r,) for r in rows], "value string")
    body(lines('{"a": 1}', '{"a": null}', "", "no json", "[1]"), 0)
    body(lines('{"a": 2, "b": 1.5, "c": true, "d": {"x": 1}}', '{"a": "word", "b": 2}'), 1)
    body(lines('{"a": 3, "b": "text", "d": "s"}'), 2)
    body(lines('{"a": 3, "b": "text", "d": "s"}'), 2)
    got = sorted((tuple(r) for r in sources.read_growing(spark, path, "a bigint").collect()), key=str)
    assert sources.read_growing(spark, path, "a bigint").columns == ["a", "b", "c", "d", "rescued"]
    assert sorted(got, key=str) == sorted([
        (1, None, None, None, None), (None, None, None, None, None), (None, None, None, None, ""), (None, None, None, None, "no json"), (None, None, None, None, "[1]"),
        (2, 1.5, True, '{"x":1}', None), (None, 2.0, None, None, '{"a":"word"}'), (3, None, None, "s", '{"b":"text"}'),
    ], key=str)
