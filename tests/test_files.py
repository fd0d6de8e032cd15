from __future__ import annotations

import gzip
import shutil

import pytest
from pyspark.sql import functions as F

import logtally as lt
from logtally.sources import files
from logtally.sources.files import invalid_utf8


@pytest.fixture()
def small_splits(spark):
    """Cut files into blocks of 4 KB."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "4096" if k.endswith("maxPartitionBytes") else "512")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def numbered(path, count, width=60):
    path.write_text("".join(f"{i} {'x' * (i % width)}\n" for i in range(1, count + 1)))
    return str(path)


def test_line_ends_and_bytes(spark, tmp_path):
    path = tmp_path / "app.log"
    path.write_bytes(b"l1\nl2\r\nl3\rl4\n\n\xff bad\nlast")
    lines = lt.scan_logs(spark, [str(path)])
    rows = lines.select("source_file", invalid_utf8(F.col("raw")).alias("bad")).collect()
    assert [r.source_file for r in rows] == ["app.log"] * 7
    assert [r.bad for r in rows] == [False] * 5 + [True, False]
    assert lt.overview(lt.parse_logs(lines)).first().total == 7


def test_names_repeats_and_folders(spark, tmp_path):
    for folder in ("one", "two"):
        (tmp_path / folder).mkdir()
        numbered(tmp_path / folder / "app.log", 10)
    numbered(tmp_path / "two" / "b.log", 5)
    counts = lt.file_counts(lt.scan_logs(spark, [str(tmp_path / "one"), str(tmp_path / "two")]))
    assert {r.source_file: r["count"] for r in counts.collect()} == {"app.log": 20, "b.log": 5}
    path = str(tmp_path / "two" / "b.log")
    assert lt.scan_logs(spark, [path, path]).count() == 10
    assert lt.scan_logs(spark, [str(tmp_path / "*" / "app.log")]).count() == 20


def test_missing_files(spark, tmp_path, caplog):
    path = numbered(tmp_path / "app.log", 3)
    assert lt.scan_logs(spark, [path, str(tmp_path / "gone.log")]).count() == 3
    assert "gone.log" in caplog.text
    with pytest.raises(FileNotFoundError):
        lt.scan_logs(spark, [str(tmp_path / "gone.log")])
    for name in ("_app.log", ".app.log"):
        with pytest.raises(ValueError, match="skips"):
            lt.scan_logs(spark, [path, numbered(tmp_path / name, 3)])


def test_file_that_breaks_off(spark, tmp_path):
    whole = gzip.compress(b"".join(b"line %d\n" % i for i in range(20_000)))
    (tmp_path / "app.log.gz").write_bytes(whole[: len(whole) // 2])
    numbered(tmp_path / "b.log", 5)
    paths = [str(tmp_path / "app.log.gz"), str(tmp_path / "b.log")]
    counts = lt.file_counts(lt.scan_logs(spark, paths, skip_corrupt=True))
    found = {r.source_file: r["count"] for r in counts.collect()}
    assert found["b.log"] == 5 and 0 < found["app.log.gz"] < 20_000
    with pytest.raises(Exception, match="(?i)end of|EOF|corrupt|FAILED_READ_FILE"):
        lt.scan_logs(spark, paths).collect()


@pytest.mark.parametrize("most_broadcast", [0, files.BROADCAST_BYTES])
def test_line_numbers_across_splits(spark, tmp_path, small_splits, monkeypatch, most_broadcast):
    monkeypatch.setattr(files, "BROADCAST_BYTES", most_broadcast)
    sizes = {"large.log": 3000, "small.log": 7, "empty.log": 0}
    paths = [numbered(tmp_path / name, n) for name, n in sizes.items()]
    lines = lt.scan_numbered_logs(spark, [*paths, paths[0]])
    rows = lines.select("source_file", "line_number", F.split("raw", " ")[0].cast("bigint").alias("expected")).collect()
    assert len(rows) == 3007
    assert all(r.line_number == r.expected for r in rows)
    assert lines.rdd.getNumPartitions() > 10 or most_broadcast == 0


def test_line_numbers_of_same_names_and_compressed_files(spark, tmp_path):
    for folder in ("one", "two"):
        (tmp_path / folder).mkdir()
        numbered(tmp_path / folder / "app.log", 10)
    with gzip.open(tmp_path / "one" / "c.log.gz", "wb") as out:
        out.write(b"1\n2\n3\n")
    lines = lt.scan_numbered_logs(spark, [str(tmp_path / "one"), str(tmp_path / "two")])
    rows = lines.select("file_path", "line_number", F.split("raw", " ")[0].cast("bigint").alias("expected")).collect()
    assert len(rows) == 23 and all(r.line_number == r.expected for r in rows)


def test_overlapping_patterns_are_refused(spark, tmp_path):
    path = numbered(tmp_path / "app.log", 10)
    with pytest.raises(Exception, match="several of the paths"):
        lt.scan_numbered_logs(spark, [path, str(tmp_path / "*.log")]).collect()


@pytest.mark.parametrize(
    ("key", "value"),
    [
        ("spark.sql.files.maxPartitionBytes", "8192"),
        ("spark.sql.files.openCostInBytes", "1"),
        ("spark.sql.files.openCostInBytes", "100000000"),
        ("spark.sql.files.minPartitionNum", "1"),
        ("spark.sql.files.minPartitionNum", "50"),
    ],
)
def test_settings_that_change_between_the_scans(spark, tmp_path, key, value):
    """Numbers are right, or reading fails; they are never wrong."""
    for k in range(6):
        numbered(tmp_path / f"{k}.log", 50 + 7 * k)
    lines = lt.scan_numbered_logs(spark, [str(tmp_path)])
    lines = lines.select("line_number", F.split("raw", " ")[0].cast("bigint").alias("expected"))
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        rows = lines.collect()
    except Exception as error:
        assert "dealt out or split differently" in str(error)
    else:
        assert len(rows) == 405 and all(r.line_number == r.expected for r in rows)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@pytest.mark.parametrize("count", [0, 39, 41])
def test_files_that_change_between_the_scans(spark, tmp_path, count):
    paths = [tmp_path / f"{k}.log" for k in range(6)]
    for path in paths:
        numbered(path, 40)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")  # several files in a task
    try:
        lines = lt.scan_numbered_logs(spark, [str(tmp_path)])
        lines = lines.select("line_number", F.split("raw", " ")[0].cast("bigint").alias("expected"))
        numbered(paths[1], count)
        try:
            rows = lines.collect()
        except Exception as error:
            assert "dealt out or split differently" in str(error)
        else:
            assert all(r.line_number == r.expected for r in rows)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_names_that_look_like_numbers_or_patterns(spark, tmp_path):
    names = ["007", "20240601", "app[1].log", "a{b,c}.log", "a+b %20.log", "x*.log", "true"]
    for k, name in enumerate(names):
        numbered(tmp_path / name, k + 1)
    expected = {name: k + 1 for k, name in enumerate(names)}
    paths = [str(tmp_path / name) for name in names]
    counts = lambda lines: {r.source_file: r["count"] for r in lt.file_counts(lines).collect()}
    assert counts(lt.scan_logs(spark, paths)) == expected
    assert counts(lt.scan_numbered_logs(spark, paths)) == expected
    rows = [(str(i), name) for name, n in expected.items() for i in range(n)]
    written = str(tmp_path / "written")
    lt.write_logs(spark.createDataFrame(rows, "raw string, source_file string"), written, "raw")
    assert counts(lt.scan_logs(spark, [written])) == expected
    assert counts(lt.scan_numbered_logs(spark, [written])) == expected
    assert lt.scan_logs(spark, [f"{tmp_path}/app*.log"]).count() == 3


def test_written_parts_keep_their_order(spark, tmp_path, small_splits):
    """One file holds nearly all lines; it is written in parts and numbered through them."""
    ids = spark.range(1, 5001).withColumnRenamed("id", "n")
    name = F.when(F.col("n") % 50 == 0, F.lit("b.log")).otherwise(F.lit("a.log"))
    lines = ids.select(F.col("n").cast("string").alias("raw"), name.alias("source_file"), "n")
    folder = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lt.write_logs(lines, folder, "n")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "out" / "source_file=a.log").glob("part-*"))) > 1
    rows = lt.scan_numbered_logs(spark, [folder]).collect()
    by_file = {}
    for r in sorted(rows, key=lambda r: (r.source_file, r.line_number)):
        by_file.setdefault(r.source_file, []).append((r.line_number, int(r.raw)))
    assert by_file["a.log"] == list(enumerate((n for n in range(1, 5001) if n % 50), start=1))
    assert by_file["b.log"] == list(enumerate(range(50, 5001, 50), start=1))


def test_file_that_vanishes_is_skipped(spark, tmp_path):
    for name in ("a.log", "b.log"):
        numbered(tmp_path / name, 4)
    pattern = [str(tmp_path / "*.log")]
    strict, lines = lt.scan_logs(spark, pattern), lt.scan_logs(spark, pattern, skip_corrupt=True)
    listed = lines.inputFiles()
    shutil.move(tmp_path / "a.log", tmp_path / "a.moved")
    assert lines.count() == 4
    assert [path.rsplit("/", 1)[1] for path in lt.vanished(spark, listed)] == ["a.log"]
    with pytest.raises(Exception, match="(?i)FILE_NOT_EXIST|does not exist"):
        strict.count()


def test_analysis_goes_on_past_what_cannot_be_read(spark, tmp_path):
    whole = gzip.compress(b"".join(b"line %d\n" % i for i in range(20_000)))
    (tmp_path / "broken.log.gz").write_bytes(whole[: len(whole) // 2])
    numbered(tmp_path / "b.log", 5)
    paths = [str(tmp_path), str(tmp_path / "missing.log")]
    result = lt.analyze(spark, paths, lt.Options(skip_corrupt=True))
    files_of = {r.key: r["count"] for r in result.metrics.filter("metric = 'file'").collect()}
    assert files_of["b.log"] == 5 and 0 < files_of["broken.log.gz"] < 20_000 and result.vanished == []
    with pytest.raises(Exception, match="(?i)end of|EOF|corrupt|FAILED_READ_FILE"):
        lt.analyze(spark, paths)
