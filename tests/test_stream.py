from __future__ import annotations

import io
import json
import os
import random
import re

import pytest
from conftest import KEYWORDS
from pyspark.sql import functions as F

import logtally as lt
from logtally.sources.tail import ByteRange, TailReader, complete_until, fair_shares, line_end, lines_in, local_path

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def lines(spark):
    return lt.log_lines_from_events(spark.read.parquet(EVENTS))


def as_dict(metrics):
    return {(r.metric, r.key): r["count"] for r in metrics.collect()}


def run(running, tmp_path):
    """Run over what is there, then return the newest counts."""
    updates = str(tmp_path / "updates")
    lt.start_updates(running, str(tmp_path / "state"), lt.update_table(updates), poll_ms=None).awaitTermination()
    return lt.latest(running.sparkSession, updates)


def add_file(folder, name, *raw):
    hidden = folder / f".{name}"
    hidden.write_text("".join(line + "\n" for line in raw))
    os.rename(hidden, folder / name)


ERROR = "2024-06-01 08:00:00 ERROR [t] l - TimeoutException"
INFO = "2024-06-01 09:00:00 INFO [t] l - fine"


def test_stream_equals_batch(spark, lines, tmp_path):
    folder = str(tmp_path / "logs")
    lt.write_logs(lines, folder, "line_number")
    stream = lt.parse_logs(lt.stream_logs(spark, folder, max_files_per_trigger=1))
    got = lt.add_up(run(lt.running_metrics(stream, keywords=KEYWORDS), tmp_path))
    assert as_dict(got) == as_dict(lt.all_metrics(lt.parse_logs(lines), keywords=KEYWORDS))


def test_stopped_and_started_again(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    running = lt.running_metrics(lt.parse_logs(lt.stream_logs(spark, str(folder))))
    add_file(folder, "a.log", ERROR, INFO)
    assert as_dict(run(running, tmp_path))["total", ""] == 2
    add_file(folder, "b.log", ERROR)
    counts = as_dict(run(running, tmp_path))
    assert counts["total", ""] == 3 and counts["pattern", "TimeoutException"] == 2
    assert counts["file", "a.log"] == 2 and counts["file", "b.log"] == 1


def test_polling_query_sees_new_files_and_stops(spark, tmp_path):
    folder, updates = tmp_path / "logs", str(tmp_path / "updates")
    folder.mkdir()
    add_file(folder, "a.log", ERROR)
    running = lt.running_metrics(lt.parse_logs(lt.stream_logs(spark, str(folder))))
    query = lt.start_updates(running, str(tmp_path / "state"), lt.update_table(updates), poll_ms=100)
    try:
        query.processAllAvailable()
        add_file(folder, "b.log", INFO)
        query.processAllAvailable()
    finally:
        query.stop()
    assert as_dict(lt.latest(spark, updates))["total", ""] == 2
    assert not query.isActive


def test_alerts(spark, tmp_path):
    folder, out = tmp_path / "logs", str(tmp_path / "alerts")
    folder.mkdir()
    add_file(folder, "a.log", ERROR, INFO, "all FATAL here", "x")
    entries = lt.parse_logs(lt.stream_logs(spark, str(folder)))
    lt.start_alerts(entries, str(tmp_path / "state"), out, poll_ms=None).awaitTermination()
    assert {tuple(r) for r in lt.read_alerts(spark, out).collect()} == {
        ("a.log", "ERROR", ERROR),
        ("a.log", "FATAL", "all FATAL here"),
    }


def test_stream_goes_on_from_a_batch(spark, lines_of, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    add_file(folder, "b.log", ERROR)
    batch = lt.analyze_lines(lines_of(ERROR, INFO))

    def followed(batch):
        live = lt.follow(lt.stream_logs(spark, str(folder)), str(tmp_path / "live"), batch=batch, poll_ms=None)
        live.query.awaitTermination()
        return live, as_dict(live.metrics())

    live, counts = followed(batch)
    assert counts["total", ""] == 3 and counts["level", "ERROR"] == 2 and counts["file", "b.log"] == 1
    assert counts["level", "INFO"] == 1 and counts["hour", "2024-06-01 09"] == 1  # as the batch left them
    assert live.overview().select("total", "malformed", F.hour("earliest"), F.hour("latest")).first() == (3, 0, 8, 9)
    # The batch was stored at the first start; another one does not count again.
    add_file(folder, "c.log", INFO, "x")
    _, counts = followed(lt.analyze_lines(lines_of(ERROR, ERROR, ERROR)))
    assert counts["total", ""] == 5 and counts["malformed", ""] == 1 and counts["level", "FATAL"] == 0


def tail(spark, path, tmp_path, **options):
    stream = lt.tail_logs(spark, str(path), **options)
    name = f"tail_{abs(hash(str(tmp_path)))}"
    writer = stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "state"))
    query = writer.trigger(processingTime="100 milliseconds").start()

    def seen():
        query.processAllAvailable()
        return sorted(spark.table(name).collect(), key=lambda r: r.raw)

    return query, seen


def append(path, data: bytes):
    with open(path, "ab") as out:
        out.write(data)


def test_tail_follows_appends_rotation_and_half_lines(spark, tmp_path):
    path = tmp_path / "app.log"
    path.write_bytes(b"old 1\nold 2\n")
    query, seen = tail(spark, path, tmp_path)
    try:
        assert seen() == []  # from the end on
        append(path, b"a1\r\na2 \xff\nhal")
        assert [(r.raw, r.source_file, r.byte_offset) for r in seen()] == [
            ("a1", "app.log", 12),
            ("a2 �", "app.log", 16),
        ]
        append(path, b"f\n")
        assert [r.raw for r in seen()][-1] == "half"
        path.write_bytes(b"b1\n")  # cut short
        assert [r.raw for r in seen()] == ["a1", "a2 �", "b1", "half"]
        os.rename(path, tmp_path / "app.log.1")  # rotated: another file under the name
        path.write_bytes(b"c1\nc2 is longer than before\n")
        assert [r.raw for r in seen()] == ["a1", "a2 �", "b1", "c1", "c2 is longer than before", "half"]
    finally:
        query.stop()


def test_tail_goes_on_after_a_restart(spark, tmp_path):
    path = tmp_path / "app.log"
    path.write_bytes(b"1\n2\n")
    updates = str(tmp_path / "updates")

    def once():
        stream = lt.tail_logs(spark, str(path), start="beginning", rangeBytes="2")
        running = lt.running_metrics(lt.parse_logs(stream))
        lt.start_updates(running, str(tmp_path / "state"), lt.update_table(updates), poll_ms=None).awaitTermination()
        return as_dict(lt.latest(spark, updates))["total", ""]

    assert once() == 2
    append(path, b"3\n4\n5")
    assert once() == 4


def test_tail_from_given_positions_and_a_new_file(spark, tmp_path):
    first = tmp_path / "a.log"
    first.write_bytes(b"1\n2\n3\n")
    query, seen = tail(spark, tmp_path / "*.log", tmp_path, start={str(first): 2})
    try:
        assert [r.raw for r in seen()] == ["2", "3"]
        (tmp_path / "b.log").write_bytes(b"new\n")
        assert [(r.raw, r.source_file) for r in seen()][-1] == ("new", "b.log")
    finally:
        query.stop()


def test_ranges_cover_every_line_once(tmp_path):
    """Whatever the content and the range size, the ranges together give the lines of the file."""
    rng = random.Random(3)
    path = tmp_path / "f.log"
    for _ in range(400):
        data = b"".join(rng.choice([b"a", b"bc", b"", b"\n", b"\r", b"\r\n"]) for _ in range(rng.randint(0, 30)))
        path.write_bytes(data)
        end = complete_until(str(path))
        # Finished lines only; a \r at the very end may yet become \r\n.
        ends = [m.end() for m in re.finditer(rb"\r\n|\r(?!\Z)|\n", data)]
        assert end == (ends[-1] if ends else 0), data
        expected = [m.group(1) for m in re.finditer(rb"([^\r\n]*)(\r\n|\r|\n)", data[:end])]
        reader = TailReader({"path": str(path), "rangeBytes": str(rng.randint(1, 8))})
        now = {"path": str(path), "named": str(path), "inode": 1, "generation": 0, "position": end, "mark": "", "head": "", "head_bytes": 0}
        parts = reader.partitions({}, {"1": now})
        got = [line for part in parts for _, line in lines_in(io.BytesIO(data), part)]
        assert got == expected, data


def test_ranges_from_the_middle(tmp_path):
    data = b"one\ntwo\nthree\nfour\n"
    part = ByteRange("f", 1, first=4, start=4, stop=9, end=len(data))
    assert list(lines_in(io.BytesIO(data), part)) == [(4, b"two"), (8, b"three")]
    part = ByteRange("f", 1, first=4, start=9, stop=len(data), end=len(data))
    assert list(lines_in(io.BytesIO(data), part)) == [(14, b"four")]


def test_long_lines_across_read_chunks(tmp_path, monkeypatch):
    monkeypatch.setattr("logtally.sources.tail._CHUNK", 7)
    path = tmp_path / "f.log"
    data = b"x" * 50 + b"\r\n" + b"y" * 13 + b"\r" + b"z\n" + b"unfinished" * 3
    path.write_bytes(data)
    assert complete_until(str(path)) == 68
    part = ByteRange(str(path), 1, 0, 0, 68, 68)
    assert [line for _, line in lines_in(io.BytesIO(data), part)] == [b"x" * 50, b"y" * 13, b"z"]


def test_lost_data(tmp_path):
    path = tmp_path / "f.log"
    path.write_bytes(b"1\n")
    part = ByteRange(str(path), -1, 0, 0, 2, 2)
    with pytest.raises(RuntimeError, match="replaced"):
        list(TailReader({"path": str(path)}).read(part))
    assert list(TailReader({"path": str(path), "failOnDataLoss": "false"}).read(part)) == []


class Polled:
    """A tail reader driven by hand, micro-batch by micro-batch."""

    def __init__(self, path, offset=None, **options):
        self.reader = TailReader({"path": str(path), "startingPosition": "beginning", **options})
        self.offset = offset
        if offset is None:
            self.offset = self.restored(self.reader.initialOffset())
        else:  # as Spark does at a restart
            self.reader.partitions(offset, offset)

    @staticmethod
    def restored(offset):
        return json.loads(json.dumps(offset))

    def lines(self):
        end = self.restored(self.reader.latestOffset())
        rows = [r for p in self.reader.partitions(self.offset, end) for b in self.reader.read(p) for r in b.to_pylist()]
        self.offset = end
        self.reader.commit(end)
        return [(r["source_file"], r["raw"]) for r in rows]


def test_a_rotated_file_is_read_to_its_end(tmp_path):
    path = tmp_path / "app.log"
    path.write_bytes(b"1\n2\n")
    polled = Polled(path)
    assert polled.lines() == [("app.log", "1"), ("app.log", "2")]
    append(path, b"3\n")
    os.rename(path, tmp_path / "app.log.1")
    append(tmp_path / "app.log.1", b"4\n")
    path.write_bytes(b"a\n")
    assert sorted(polled.lines()) == [("app.log", "3"), ("app.log", "4"), ("app.log", "a")]
    append(tmp_path / "app.log.1", b"5\n")
    os.rename(tmp_path / "app.log.1", tmp_path / "app.log.2")
    append(path, b"b\n")
    assert sorted(polled.lines()) == [("app.log", "5"), ("app.log", "b")]
    assert polled.lines() == []


def test_a_file_that_is_away_for_a_while_is_not_counted_again(tmp_path):
    path, away = tmp_path / "logs" / "app.log", tmp_path / "app.log"
    path.parent.mkdir()
    path.write_bytes(b"1\n2\n")
    polled = Polled(path)
    assert len(polled.lines()) == 2
    os.rename(path, away)
    assert polled.lines() == polled.lines() == []
    os.rename(away, path)
    append(path, b"3\n")
    assert polled.lines() == [("app.log", "3")]
    # Over a restart as well.
    os.rename(path, away)
    assert polled.lines() == []
    polled = Polled(path, polled.offset)
    assert polled.lines() == []
    os.rename(away, path)
    append(path, b"4\n")
    assert polled.lines() == [("app.log", "4")]
    forgetful = Polled(path, forgetAfter="0")
    assert len(forgetful.lines()) == 4
    os.rename(path, away)
    assert forgetful.lines() == []


def test_a_file_cut_short_and_grown_again_is_read_from_its_beginning(tmp_path):
    path = tmp_path / "app.log"
    path.write_bytes(b"1\n2\n")
    polled = Polled(path)
    assert len(polled.lines()) == 2
    path.write_bytes(b"a\n")
    assert polled.lines() == [("app.log", "a")]
    with open(path, "r+b") as file:  # longer than before at the next look
        file.truncate(0)
        file.write(b"x\ny\nz\n")
    assert [raw for _, raw in polled.lines()] == ["x", "y", "z"]
    append(path, b"end\n")
    assert [raw for _, raw in polled.lines()] == ["end"]


def reuse_inode(path, freed):
    """Make a file with the inode of one that was removed, or skip."""
    path.write_bytes(b"")
    if os.stat(path).st_ino != freed:
        pytest.skip("this file system does not use inodes again at once")


def test_a_file_beside_the_pattern_is_not_taken_for_one_that_was_removed(tmp_path):
    path, other = tmp_path / "app.log", tmp_path / "unrelated.txt"
    path.write_bytes(b"1\n2\n")
    polled = Polled(path)
    assert len(polled.lines()) == 2
    freed = os.stat(path).st_ino
    os.remove(path)
    reuse_inode(other, freed)
    append(other, b"not a log line\n" * 9)
    assert polled.lines() == polled.lines() == []
    polled = Polled(path, polled.offset)
    append(other, b"more\n")
    assert polled.lines() == []
    path.write_bytes(b"3\n")
    assert polled.lines() == [("app.log", "3")]


def test_a_file_of_the_pattern_with_a_used_inode_is_a_new_one(tmp_path):
    path, other = tmp_path / "a.log", tmp_path / "b.log"
    path.write_bytes(b"1\n2\n")
    polled = Polled(tmp_path / "*.log")
    assert len(polled.lines()) == 2
    freed = os.stat(path).st_ino
    os.remove(path)
    reuse_inode(other, freed)
    append(other, b"x\ny\nz\n")
    assert polled.lines() == [("b.log", "x"), ("b.log", "y"), ("b.log", "z")]
    append(other, b"end\n")
    assert polled.lines() == [("b.log", "end")]


def test_an_empty_file_that_goes_is_not_looked_for(tmp_path):
    path, other = tmp_path / "app.log", tmp_path / "unrelated.txt"
    path.write_bytes(b"")
    polled = Polled(path)
    assert polled.lines() == []
    freed = os.stat(path).st_ino
    os.remove(path)
    reuse_inode(other, freed)
    append(other, b"not a log line\n")
    assert polled.lines() == []


def test_equal_inodes_of_two_devices_are_two_files(tmp_path, monkeypatch):
    one, two = tmp_path / "one.log", tmp_path / "two.log"
    one.write_bytes(b"1\n")
    two.write_bytes(b"2\n")
    device = {os.stat(one).st_ino: 1, os.stat(two).st_ino: 2}
    monkeypatch.setattr("logtally.sources.tail.identity", lambda status: (device[status.st_ino], 77))
    monkeypatch.setattr("logtally.sources.tail._open", lambda part: open(part.path, "rb"))
    polled = Polled(tmp_path / "*.log")
    assert sorted(polled.lines()) == [("one.log", "1"), ("two.log", "2")]
    append(two, b"3\n")
    assert polled.lines() == [("two.log", "3")]


def test_a_device_with_another_number_after_a_mount(tmp_path, monkeypatch):
    path = tmp_path / "app.log"
    path.write_bytes(b"1\n2\n")
    polled = Polled(path)
    assert len(polled.lines()) == 2
    monkeypatch.setattr("logtally.sources.tail.identity", lambda status: (status.st_dev + 1, status.st_ino))
    polled = Polled(path, polled.offset)
    append(path, b"3\n")
    assert polled.lines() == [("app.log", "3")]


def test_a_range_is_not_read_from_another_file(tmp_path):
    """A task that is tried again, when its file has gone and another has its inode and is long enough."""
    path = tmp_path / "app.log"
    path.write_bytes(b"1\n2\n")
    reader = TailReader({"path": str(path), "startingPosition": "beginning"})
    (part,) = reader.partitions(reader.initialOffset(), reader.latestOffset())
    freed = os.stat(path).st_ino
    os.remove(path)
    reuse_inode(path, freed)
    append(path, b"another file by now\n")
    with pytest.raises(RuntimeError, match="replaced"):
        list(reader.read(part))


def test_generations_over_a_restart(tmp_path):
    path = tmp_path / "app.log"
    path.write_bytes(b"1\n2\n")
    polled = Polled(path)
    polled.lines()
    path.write_bytes(b"a\n")
    assert polled.lines() == [("app.log", "a")]
    polled = Polled(path, polled.offset)
    append(path, b"b\n")
    assert polled.lines() == [("app.log", "b")]


def test_a_backlog_is_read_bit_by_bit(tmp_path):
    """Every file's lines come in order, once, in micro-batches of the budget, over a restart as well."""
    rng, names = random.Random(9), [f"{k}.log" for k in range(4)]
    written = {name: [f"{name} {k} " + "x" * rng.randrange(30) for k in range(rng.randrange(1, 120))] for name in names}
    for name, lines in written.items():
        (tmp_path / name).write_bytes("".join(line + rng.choice(("\n", "\r\n", "\r")) for line in lines).encode() + b"\n")
    written = {name: [*lines, ""] if (tmp_path / name).read_bytes().endswith(b"\n\n") else lines for name, lines in written.items()}
    polled, read, batches = Polled(tmp_path / "*.log", maxBytesPerBatch="300"), {name: [] for name in names}, 0
    while got := polled.lines():
        batches += 1
        assert sum(len(raw) for _, raw in got) <= 300 + 4 * 40
        for name, raw in got:
            read[name].append(raw)
        if batches % 5 == 0:
            polled = Polled(tmp_path / "*.log", polled.offset, maxBytesPerBatch="300")
    assert batches >= 10
    assert {n: [r for r in lines if r] for n, lines in read.items()} == {n: [r for r in lines if r] for n, lines in written.items()}


def test_where_a_budget_ends(tmp_path, monkeypatch):
    monkeypatch.setattr("logtally.sources.tail._CHUNK", 3)
    path = tmp_path / "f.log"
    rng = random.Random(2)
    for _ in range(300):
        data = b"".join(rng.choice([b"a", b"bcdef", b"\n", b"\r", b"\r\n"]) for _ in range(rng.randint(1, 20))) + b"\n"
        path.write_bytes(data)
        ends = [m.end() for m in re.finditer(rb"\r\n|\r|\n", data)]
        low = rng.choice([0, *ends[:-1]])
        most = rng.randint(0, 12)
        inside = [e for e in ends if low < e <= low + most]
        beyond = [e for e in ends if e > low + most]
        assert line_end(str(path), low, len(data), most) == (inside[-1] if inside else beyond[0]), (data, low, most)
    assert fair_shares({"a": 5, "b": 100, "c": 100}, 65) == {"a": 5, "b": 30, "c": 30}


def test_only_changed_files_are_opened(tmp_path, monkeypatch):
    for k in range(5):
        (tmp_path / f"{k}.log").write_bytes(b"1\n")
    polled = Polled(tmp_path / "*.log")
    assert len(polled.lines()) == 5
    opened = []
    monkeypatch.setattr("logtally.sources.tail.complete_until", lambda path: opened.append(path) or complete_until(path))
    assert polled.lines() == [] and opened == []
    append(tmp_path / "3.log", b"2\n")
    assert polled.lines() == [("3.log", "2")] and opened == [str(tmp_path / "3.log")]


def test_a_range_is_read_under_the_new_name(tmp_path):
    path = tmp_path / "app.log"
    path.write_bytes(b"1\n2\n")
    reader = TailReader({"path": str(path), "startingPosition": "beginning"})
    (part,) = reader.partitions(reader.initialOffset(), reader.latestOffset())
    os.rename(path, tmp_path / "app.log.1")
    path.write_bytes(b"a longer other file\n")
    assert [r["raw"] for batch in reader.read(part) for r in batch.to_pylist()] == ["1", "2"]


def test_lines_before_given_positions(spark, tmp_path):
    for name in ("a.log", "b.log", "c[1].log"):
        (tmp_path / name).write_bytes(b"1\r\n2\xff\n3\nunfinished")
    ends = lt.finished_positions(str(tmp_path / "*.log"))
    assert sorted(ends.values()) == [8, 8, 8]
    rows = lt.read_until(spark, ends, rangeBytes="3").collect()
    assert sorted((r.source_file, r.raw) for r in rows) == [(n, x) for n in ("a.log", "b.log", "c[1].log") for x in ("1", "2\ufffd", "3")]
    assert lt.read_until(spark, {}).count() == 0
    assert lt.finished_positions(str(tmp_path / "c[1].log")) == {str(tmp_path / "c[1].log"): 8}


def test_time_range(spark, tmp_path):
    folder, updates = tmp_path / "logs", str(tmp_path / "updates")
    folder.mkdir()
    assert lt.latest(spark, updates, lt.TIME_RANGE_SCHEMA).collect() == []
    for k in range(7):  # over three merges
        add_file(folder, f"{k}.log", INFO, f"2024-06-01 {8 - k:02d}:00:00 ERROR [t] l - x")
    stream = lt.running_time_range(lt.parse_logs(lt.stream_logs(spark, str(folder), max_files_per_trigger=1)))
    update = lt.update_table(updates, merge_every=2)
    lt.start_updates(stream, str(tmp_path / "state"), update, poll_ms=None).awaitTermination()
    rows = lt.latest(spark, updates, lt.TIME_RANGE_SCHEMA).select(F.hour("earliest"), F.hour("latest")).collect()
    assert rows == [(2, 9)]


def test_monitor_carries_a_batch_on(spark, tmp_path):
    path = tmp_path / "app.log"
    path.write_text(f"{ERROR}\n{INFO}\nunfini")
    batch = lt.analyze_until_now(spark, str(path))
    append(path, f"shed WARN\n{INFO}\n".encode())  # between the batch and the start
    folder = str(tmp_path / "monitor")

    def counted(*raw):
        monitor = lt.monitor(spark, str(path), folder, batch=batch, poll_ms=100, merge_every=2)
        try:
            before = as_dict(monitor.metrics())
            monitor.process_available()
            append(path, "".join(line + "\n" for line in raw).encode())
            monitor.process_available()
            return before, as_dict(monitor.metrics()), monitor
        finally:
            monitor.stop()

    before, counts, _ = counted(ERROR, "x")
    assert before["total", ""] == 2 and before["level", "INFO"] == 1
    assert counts["total", ""] == 6 and counts["level", "ERROR"] == 2 and counts["malformed", ""] == 1
    assert counts["level", "INFO"] == 2 and counts["level", "WARN"] == 1
    _, counts, monitor = counted("FATAL y")
    assert counts["total", ""] == 7
    assert sorted(r.raw for r in monitor.alerts().collect()) == [ERROR, "FATAL y"]
    everything = lt.all_metrics(lt.parse_logs(lt.scan_logs(spark, [str(path)])))
    assert counts == as_dict(everything)
    expected = lt.overview(lt.parse_logs(lt.scan_logs(spark, [str(path)]))).first()
    assert monitor.overview().first().asDict() == expected.asDict()


def test_monitor_before_its_first_lines(spark, tmp_path):
    (tmp_path / "app.log").write_text("")
    monitor = lt.monitor(spark, str(tmp_path / "app.log"), str(tmp_path / "monitor"), poll_ms=100)
    try:
        assert as_dict(monitor.metrics())["total", ""] == 0
        assert monitor.overview().first().total == 0 and monitor.alerts().collect() == []
    finally:
        monitor.stop()


def test_a_monitor_reads_a_backlog_in_many_batches_and_reports(spark, tmp_path, capsys):
    path, folder = tmp_path / "app.log", str(tmp_path / "monitor")
    path.write_text("".join(f"{ERROR if k % 50 == 0 else INFO} {k}\n" for k in range(600)))
    options = lt.Options(output=str(tmp_path / "report"))
    shown = []
    monitor = lt.monitor(
        spark, str(path), folder, options, start="beginning", poll_ms=None, merge_every=4, max_batch_bytes=2000,
        on_alerts=lambda rows, number: (shown.append(number), lt.print_alerts(rows, number)),
    )
    assert len(os.listdir(tmp_path / "monitor" / "state" / "commits")) > 20 and not monitor.query.isActive
    whole = lt.analyze(spark, [str(path)])
    assert as_dict(monitor.metrics()) == as_dict(whole.metrics)
    assert len(shown) == len(set(shown)) and capsys.readouterr().out.count("ALERT app.log: 2024-06-01 08:00:00 ERROR") == 12
    last = [tuple(r) for r in monitor.stop(show=True).collect()]
    assert sorted(last) == sorted(tuple(r) for r in whole.report.collect())
    written = [r.value for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert written == capsys.readouterr().out.splitlines() and len(written) > 20


def test_very_many_alerts_are_not_all_printed(spark, capsys):
    rows = spark.range(30).selectExpr("'a.log' AS source_file", "'ERROR' AS level", "'line ' || id AS raw")
    lt.print_alerts(rows, 7, most=10)
    out = capsys.readouterr().out.splitlines()
    assert len(out) == 11 and out[-1] == "ALERT 30 in all in micro-batch 7"


def test_a_handover_that_broke_off_is_done_again(spark, tmp_path):
    path, folder = tmp_path / "app.log", str(tmp_path / "monitor")
    path.write_text(f"{ERROR}\n{INFO}\n{INFO}\n")
    batch = lt.analyze_until_now(spark, str(path))
    # Some of its files are there already when the commit breaks off.
    batch.summary.limit(2).write.parquet(f"{folder}/before/batch=0")
    monitor = lt.monitor(spark, str(path), folder, batch=batch, poll_ms=None)
    assert as_dict(monitor.metrics())["total", ""] == 3
    # A whole one is left as it is.
    lt.hand_over(spark, folder, lt.analyze_lines(spark.createDataFrame([], "raw string, source_file string")))
    assert as_dict(monitor.metrics())["total", ""] == 3
    # What is not marked as whole is not read.
    os.remove(f"{folder}/before/_whole")
    assert as_dict(monitor.metrics())["total", ""] == 0


def test_tail_paths():
    assert [local_path(p) for p in ("/a/*.log", "file:/a/b", "file:///a/b")] == ["/a/*.log", "/a/b", "/a/b"]
    with pytest.raises(ValueError, match="mounted"):
        local_path("hdfs://host/a")


def write_counts(spark, write):
    def batch(number, **counts):
        rows = [("level", k, n) for k, n in counts.items()]
        write(spark.createDataFrame(rows, "metric string, key string, count bigint"), number)

    return batch


def test_update_table_is_merged_now_and_then(spark, tmp_path):
    folder = tmp_path / "updates"
    batch = write_counts(spark, lt.update_table(str(folder), merge_every=3))
    for number in range(11):
        batch(number, INFO=number + 1, **({"WARN": 7} if number == 1 else {}))
        batch(number, INFO=number + 1, **({"WARN": 7} if number == 1 else {}))  # repeated after a failure
        expected = {("level", "INFO"): number + 1} | ({("level", "WARN"): 7} if number else {})
        assert as_dict(lt.latest(spark, str(folder))) == expected
    # What the last merge has replaced is still there; what the one before had is not.
    names = {p.name for p in folder.iterdir() if not p.name.startswith(".")}
    assert names == {"merged=6", "_merged=6", "merged=9", "_merged=9", *(f"batch={n}" for n in range(6, 11))}


def test_a_table_read_across_a_merge(spark, tmp_path):
    batch = write_counts(spark, lt.update_table(str(tmp_path / "updates"), merge_every=4))
    batch(0, INFO=1)
    batch(1, INFO=2, WARN=3)
    before = lt.latest(spark, str(tmp_path / "updates"))
    for number in range(2, 6):
        batch(number, INFO=number + 1)
    assert as_dict(before) == {("level", "INFO"): 2, ("level", "WARN"): 3}


def test_a_merge_that_broke_off_is_done_again(spark, tmp_path):
    folder = tmp_path / "updates"
    batch = write_counts(spark, lt.update_table(str(folder), merge_every=2))
    batch(0, INFO=1, WARN=5)
    batch(1, INFO=2)
    (folder / "merged=2").mkdir()
    (folder / "merged=2" / "part-0.parquet").write_bytes(b"half")
    assert as_dict(lt.latest(spark, str(folder))) == {("level", "INFO"): 2, ("level", "WARN"): 5}
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        for number in range(2, 8):
            batch(number, INFO=number + 1)
            assert as_dict(lt.latest(spark, str(folder))) == {("level", "INFO"): number + 1, ("level", "WARN"): 5}
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_a_table_without_keys_keeps_all_rows(spark, tmp_path):
    table = lt.BatchTable(str(tmp_path / "t"), "x int", merge_every=2)
    assert table.read(spark).collect() == []
    for number in range(7):
        table.write(spark.range(number, number + 2).select(F.col("id").cast("int").alias("x")), number)
    assert sorted(r.x for r in table.read(spark).collect()) == sorted([*range(7), *range(1, 8)])
    assert len(list((tmp_path / "t").glob("merged=*"))) == 3
