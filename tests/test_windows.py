from __future__ import annotations

import os

import pytest

import logtally as lt

KEEP = "hour string, count bigint"


def add_file(folder, name, *raw):
    hidden = folder / f".{name}"
    hidden.write_text("".join(line + "\n" for line in raw))
    os.rename(hidden, folder / name)


def at(*times, level="INFO"):
    return [f"2024-06-{t} {level} [t] l - m{k}" for k, t in enumerate(times)]


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "logs").mkdir()
    return tmp_path / "logs"


def start(frame, table, tmp_path, mode="append"):
    writer = frame.writeStream.outputMode(mode).foreachBatch(table.write)
    return writer.option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="0 seconds").start()


def test_hours_are_final_once_the_watermark_has_passed(spark, folder, tmp_path):
    table = lt.BatchTable(str(tmp_path / "hours"), KEEP)
    hours = lt.windowed_hours(lt.parse_logs(lt.stream_logs(spark, str(folder))), "1 hour")
    query = start(hours, table, tmp_path)
    try:
        seen = []
        for k, lines in enumerate(
            (
                at("01 08:10:00", "01 08:50:00", "01 09:05:00") + ["no time"],
                at("01 08:59:59.999", "01 10:30:00"),  # out of order, and still in time; closes 08 and not 09
                at("01 08:20:00", "01 08:30:00", "01 09:59:00"),  # two come too late
                at("01 23:00:00"),
            )
        ):
            add_file(folder, f"{k}.log", *lines)
            query.processAllAvailable()
            seen.append({r["hour"]: r["count"] for r in table.read(spark).collect()})
        assert seen[0] == {}
        assert seen[1] == {"2024-06-01 08": 3}
        assert seen[2] == seen[1]
        assert seen[3] == {"2024-06-01 08": 3, "2024-06-01 09": 2, "2024-06-01 10": 1}
        assert lt.late_rows(query) >= 1
        assert lt.state_rows(query) == 1  # the hour that is still open
    finally:
        query.stop()


def test_the_state_of_windows_is_bounded(spark, folder, tmp_path):
    table = lt.BatchTable(str(tmp_path / "hours"), KEEP)
    query = start(lt.windowed_hours(lt.parse_logs(lt.stream_logs(spark, str(folder))), "2 hours"), table, tmp_path)
    try:
        most = 0
        for day in range(1, 6):
            add_file(folder, f"{day}.log", *at(*(f"{day:02d} {hour:02d}:30:00" for hour in range(24))))
            query.processAllAvailable()
            most = max(most, lt.state_rows(query))
        assert most <= 4 and len(table.read(spark).collect()) >= 5 * 24 - 4
    finally:
        query.stop()


def test_a_line_delivered_twice_counts_once(spark, tmp_path):
    path = tmp_path / "app.log"
    path.write_text("".join(line + "\n" for line in at("01 08:00:00", "01 08:00:00", "01 08:30:00")) + "no time\n")
    one, two = (lt.tail_logs(spark, str(path), "beginning") for _ in range(2))
    lines = lt.distinct_lines(lt.parse_logs(one.unionByName(two)), delay="1 hour").select("raw")
    table = lt.BatchTable(str(tmp_path / "lines"), "raw string")
    query = start(lines, table, tmp_path)
    try:
        query.processAllAvailable()
        assert len(table.read(spark).collect()) == 3
        with open(path, "a") as file:
            file.writelines(line + "\n" for line in at("01 15:00:00", "01 15:00:01"))
        query.processAllAvailable()
        with open(path, "a") as file:
            file.writelines(line + "\n" for line in at("01 08:05:00"))  # too late
        query.processAllAvailable()
        assert len(table.read(spark).collect()) == 5
        assert lt.late_rows(query) == 2 and lt.state_rows(query) <= 2
    finally:
        query.stop()


def test_expiring_counts_add_up_and_leave_the_state(spark, folder, tmp_path):
    """Every micro-batch has names of its own; the state keeps those of the last epochs, the table all."""
    import time

    running = lt.running_metrics(lt.parse_logs(lt.stream_logs(spark, str(folder))), expire="1 second")
    kept = lt.running_metrics(lt.parse_logs(lt.stream_logs(spark, str(folder))))
    assert kept.columns == ["metric", "key", "count"]
    updates = str(tmp_path / "updates")
    query = lt.start_updates(running, str(tmp_path / "state"), lt.update_table(updates, merge_every=3), poll_ms=0)
    try:
        rows, lines = [], []
        for k in range(8):
            new = [f"2024-06-{k + 1:02d} 08:00:00 ERROR [t] l - A{k}x{n}Error" for n in range(20)]
            lines += new
            add_file(folder, f"{k}.log", *new)
            query.processAllAvailable()
            rows.append(lt.state_rows(query))
            time.sleep(1.2)
        counts = lt.add_up(lt.latest(spark, updates, lt.EPOCH_SCHEMA))
    finally:
        query.stop()
    expected = lt.all_metrics(lt.parse_logs(lt.scan_logs(spark, [str(folder)])))
    as_dict = lambda df: {(r["metric"], r["key"]): r["count"] for r in df.collect()}
    assert as_dict(counts) == as_dict(expected) and as_dict(counts)["total", ""] == len(lines)
    names = 8 * 20
    assert max(rows) < names and rows[-1] <= rows[2] + 30
