"""A source that follows growing files, like ``tail -F``.

Spark's own file stream takes each file once and never sees what is appended to it. Here the
offset has, for every file, the byte position after its last finished line, a generation, and what the
file is known by: device, inode, a digest of its first bytes and one of the bytes before the position.
A micro-batch reads what lies between two offsets, cut into ranges that tasks read in parallel.
The driver looks at file names and sizes, and opens only files that have changed since its last look.

- A renamed file keeps its inode, so its rest is read under the new name in the same folder, and its
  lines keep the name that the file had first. Inodes are used again once a file is gone, so a file of
  another name is the known one only if its bytes agree; one of which no byte was seen is not looked for.
- A file of the pattern that is shorter than before, or whose bytes have changed (cut short and grown
  again, or another file by now), is a new generation and read from its beginning.
- A task looks at the bytes again when it opens its range, so it never reads those of another file.
- A file that is missing is remembered for ``forgetAfter`` seconds and goes on where it was if it
  comes back. (One that is missing when a stopped query starts again is remembered from its first
  micro-batch on.)

The files must be reachable under the same path on the driver and on every executor.

Options: ``path`` (file or glob pattern), ``startingPosition`` (``end``, ``beginning`` or a JSON
object of byte positions per path), ``rangeBytes`` (size of a task's range), ``failOnDataLoss`` (whether a
file that is replaced before it could be read fails the query, true by default), ``forgetAfter``,
``maxBytesPerBatch`` (bytes of a micro-batch, no limit by default; a backlog is shared out among the files in
whole lines, at least one of each file that is due. Such a query is drained by ``processAllAvailable``; the
``availableNow`` trigger asks a source once, so it ends after one micro-batch). As a batch, ``until`` (a JSON object of byte positions per path) gives the lines before those positions.
"""

from __future__ import annotations

import glob
import hashlib
import json
import logging
import os
import re
import sys
import time
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

# Send the source to the Python workers by value: they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "raw string, source_file string, file_path string, byte_offset bigint"
_ARROW = pa.schema(
    [("raw", pa.string()), ("source_file", pa.string()), ("file_path", pa.string()), ("byte_offset", pa.int64())]
)
_LINE_END = re.compile(rb"\r\n|\r|\n")
_CHUNK = 1 << 20
# Bytes before a position, and at the beginning, that tell whether a file is still the one that was read up to there.
_MARK, _HEAD = 64, 256
_WEEK = 7 * 24 * 3600


@dataclass
class ByteRange(InputPartition):
    """The lines that begin in ``[start, stop)``; ``first`` and ``end`` bound the whole batch.

    ``named`` is the path under which the file was first seen; ``mark`` and ``head`` are digests of the bytes
    before ``end`` and of the first ``head_bytes``.
    """

    path: str
    inode: int
    first: int
    start: int
    stop: int
    end: int
    named: str = ""
    mark: str = ""
    head: str = ""
    head_bytes: int = 0


def local_path(path: str) -> str:
    """A path without its ``file:`` scheme; other schemes are refused."""
    scheme, rest = re.fullmatch(r"(?:([A-Za-z][\w+.-]*):(?://)?(?=/))?(.*)", path, re.DOTALL).groups()
    if scheme not in (None, "file"):
        raise ValueError(f"the tail source reads mounted files, not {path}")
    return rest


def complete_until(path: str) -> int:
    """Position after the last finished line. A final ``\\r`` may be half of a ``\\r\\n``."""
    with open(path, "rb") as file:
        position = file.seek(0, os.SEEK_END)
        after = b""
        while position > 0:
            size = min(_CHUNK, position)
            position -= size
            file.seek(position)
            chunk = file.read(size) + after
            newline = chunk.rfind(b"\n", 0, size)
            # The byte behind a \r has to be there already.
            carriage = chunk.rfind(b"\r", 0, min(size, len(chunk) - 1))
            if max(newline, carriage) >= 0:
                return position + max(newline, carriage) + 1
            after = chunk[:1]
    return 0


def _digest(file, start: int, end: int) -> str:
    file.seek(start)
    return hashlib.blake2b(file.read(end - start), digest_size=8).hexdigest()


def mark_at(path: str, position: int) -> str:
    """A digest of the bytes just before a position."""
    with open(path, "rb") as file:
        return _digest(file, max(0, position - _MARK), position)


def agrees(file, position: int, mark: str, head: str, head_bytes: int) -> bool:
    """Whether an open file begins, and goes on before the position, with the bytes of these digests."""
    if os.fstat(file.fileno()).st_size < max(position, head_bytes):
        return False
    return _digest(file, 0, head_bytes) == head and _digest(file, max(0, position - _MARK), position) == mark


def identity(status: os.stat_result) -> tuple[int, int]:
    return status.st_dev, status.st_ino


def line_end(path: str, low: int, high: int, most: int) -> int:
    """The last end of a line within ``most`` bytes of ``low``, or the first one beyond; ``high`` is one."""
    if most >= high - low:
        return high
    with open(path, "rb") as file:
        stop = low + most
        while stop > low:  # backwards, with a look at the byte behind, as a \r may be half of a \r\n
            start = max(low, stop - _CHUNK)
            file.seek(start)
            chunk = file.read(stop - start + 1)
            ends = [m.end() for m in _LINE_END.finditer(chunk) if start + m.end() <= stop and m.end() > 0]
            if ends:
                return start + ends[-1]
            stop = start
        position = low + most
        while position < high:
            file.seek(position)
            chunk = file.read(min(_CHUNK, high - position) + 1)
            found = _LINE_END.search(chunk)
            if found and position + found.end() <= high and found.end() < len(chunk):
                return position + found.end()
            position += max(1, len(chunk) - 1)
    return high


def fair_shares(wanted: Mapping[str, int], budget: int) -> dict[str, int]:
    """How much of a budget each gets: what is wanted, or as much as any other that wants more."""
    shares, left = {}, budget
    for number, key in enumerate(sorted(wanted, key=lambda k: (wanted[k], k))):
        shares[key] = min(wanted[key], left // (len(wanted) - number))
        left -= shares[key]
    return shares


def matching(pattern: str) -> list[str]:
    """The files of a pattern; a path that exists is taken literally."""
    return [pattern] if os.path.exists(pattern) else sorted(glob.glob(pattern))


def finished_positions(path: str) -> dict[str, int]:
    """Position after the last finished line of a mounted file, or of each file of a pattern."""
    found = {}
    for name in matching(local_path(path)):
        try:
            found[name] = complete_until(name)
        except FileNotFoundError:  # rotated away meanwhile
            continue
    return found


def _runs_of_lines(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Whole lines, many at a time, with the position of the first; ``end`` is the end of a line."""
    file.seek(start)
    read, held = start, []
    while read < end:
        chunk = file.read(min(_CHUNK, end - read))
        if not chunk:
            break
        read += len(chunk)
        # Behind a \r at the very end there may be a \n.
        cut = len(chunk) if read >= end else max(chunk.rfind(b"\n"), chunk.rfind(b"\r", 0, len(chunk) - 1)) + 1
        if not cut:
            held.append(chunk)
            continue
        run = b"".join([*held, chunk[:cut]])
        yield start, run
        start, held = start + len(run), [chunk[cut:]]
    if any(held):
        yield start, b"".join(held)


def _split_run(position: int, run: bytes) -> tuple[list[bytes], np.ndarray]:
    """The lines of a run and their positions."""
    if b"\r" not in run:
        lines = run.split(b"\n")
        if not lines[-1]:
            lines.pop()
        after = np.cumsum([len(line) + 1 for line in lines], dtype=np.int64)
        return lines, position + np.concatenate([[0], after[:-1]]) if lines else after
    lines, starts, done = [], [], 0
    for match in _LINE_END.finditer(run):
        lines.append(run[done : match.start()])
        starts.append(position + done)
        done = match.end()
    if done < len(run):
        lines.append(run[done:])
        starts.append(position + done)
    return lines, np.array(starts, np.int64)


def line_runs(file, part: ByteRange) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The lines that begin in the range, many at a time. A line that begins before it is its neighbour's."""
    skip = part.start > part.first
    for position, run in _runs_of_lines(file, part.start - skip, part.end):
        lines, starts = _split_run(position, run)
        if skip:
            lines, starts, skip = lines[1:], starts[1:], False
        keep = int(np.searchsorted(starts, part.stop))
        if keep:
            yield lines[:keep], starts[:keep]
        if keep < len(lines) or position >= part.stop:
            return


def lines_in(file, part: ByteRange) -> Iterator[tuple[int, bytes]]:
    """The lines that begin in the range, one by one, with their positions."""
    for lines, starts in line_runs(file, part):
        yield from zip(starts.tolist(), lines, strict=True)


def _batch(lines: list[bytes], starts: np.ndarray, named: str) -> pa.RecordBatch:
    try:
        raw = pa.array(lines, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # not all of it is UTF-8
        raw = pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())
    name = pa.array([os.path.basename(named)] * len(lines), pa.string())
    columns = [raw, name, pa.array([named] * len(lines), pa.string()), pa.array(starts)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _ranges(at: Mapping, first: int, size: int) -> list[ByteRange]:
    end, known = at["position"], (at["mark"], at["head"], at["head_bytes"])
    return [ByteRange(at["path"], at["inode"], first, k, min(k + size, end), end, at["named"], *known) for k in range(first, end, size)]


def _open(part: ByteRange):
    """The file of a range, under its path or another name in its folder; None if it is not there any more."""
    for path in [part.path, *_renamed(part.path, {part.inode})]:
        try:
            file = open(path, "rb")
        except FileNotFoundError:
            continue
        status = os.fstat(file.fileno())
        # Devices have other numbers on other machines, so they are not asked here.
        known = not part.mark or agrees(file, part.end, part.mark, part.head, part.head_bytes)
        if status.st_ino == part.inode and status.st_size >= part.end and known:
            return file
        file.close()
    return None


def _renamed(path: str, inodes: set[int]) -> list[str]:
    """Files that have these inodes now, in the folder of a path."""
    try:
        with os.scandir(os.path.dirname(path) or ".") as entries:
            return sorted(e.path for e in entries if e.inode() in inodes and e.is_file(follow_symlinks=False))
    except FileNotFoundError:
        return []


def _read(part: ByteRange, fail_on_data_loss: bool) -> Iterator[pa.RecordBatch]:
    file = _open(part)
    if file is None:
        message = f"{part.path} was replaced before bytes {part.start} to {part.stop} were read"
        if fail_on_data_loss:
            raise RuntimeError(message)
        log.warning(message)
        return
    with file:
        for lines, starts in line_runs(file, part):
            yield _batch(lines, starts, part.named or part.path)


def _recognised(path: str, at: Mapping) -> bool:
    """Whether a file is the one of a state, of which some bytes were seen."""
    with open(path, "rb") as file:
        return at["head_bytes"] > 0 and agrees(file, at["position"], at["mark"], at["head"], at["head_bytes"])


class TailReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.pattern = local_path(options["path"])
        self.starting = options.get("startingPosition", "end")
        self.range_bytes = int(options.get("rangeBytes", 64 << 20))
        self.fail_on_data_loss = options.get("failOnDataLoss", "true").lower() == "true"
        self.forget_after = float(options.get("forgetAfter", _WEEK))
        self.max_bytes = int(options["maxBytesPerBatch"]) if "maxBytesPerBatch" in options else None
        self.known: dict[str, dict] = {}  # what the last offset says of each file
        self.ends: dict[str, int] = {}  # where its last finished line ended at the last look
        self.seen: dict[str, tuple[int, ...]] = {}  # its identity, size and time of change then
        self.done: dict[str, dict] = {}  # what finished micro-batches have read up to
        self.initial: dict | None = None  # where a new query begins

    def initialOffset(self) -> dict:
        # Spark asks for the first end before the first start, and both have to fit.
        if self.initial is None:
            self.initial = self._initial()
        return self.initial

    def _initial(self) -> dict:
        self._look_at_all()
        given = None if self.starting == "end" else {} if self.starting == "beginning" else json.loads(self.starting)
        for key, at in self.known.items():
            self._advance(key, self.ends[key] if given is None else min(given.get(at["path"], 0), self.ends[key]))
        return self._offset()

    def latestOffset(self) -> dict:
        self.initialOffset()
        self._look_at_all()
        due = {key: self.ends[key] - at["position"] for key, at in self.known.items() if "gone" not in at and self.ends.get(key, 0) > at["position"]}
        shares = due if self.max_bytes is None else fair_shares(due, self.max_bytes)
        for key, share in shares.items():
            at = self.known[key]
            try:
                self._advance(key, line_end(at["path"], at["position"], self.ends[key], share))
            except FileNotFoundError:  # rotated away meanwhile
                continue
        return self._offset()

    def _offset(self) -> dict:
        return {key: dict(at) for key, at in self.known.items()}

    def _advance(self, key: str, position: int) -> None:
        at = self.known[key]
        self.known[key] = {**at, "position": position, "mark": mark_at(at["path"], position)}

    def _look_at_all(self) -> None:
        """Bring what is known of every file up to date."""
        found: dict[tuple[int, int], str] = {}
        for path in matching(self.pattern):
            try:
                found[identity(os.stat(path))] = path
            except FileNotFoundError:  # rotated away meanwhile
                continue
        own = {(at["device"], at["inode"]): key for key, at in self.known.items()}
        looked = set()
        for (device, inode), path in found.items():
            key = own.get((device, inode)) or self._mounted_anew(path, inode) or self._new_key(device, inode)
            if self._look(key, path):
                looked.add(key)
        missing = {key: at for key, at in self.known.items() if key not in looked}
        for key, at in missing.items():
            if "gone" not in at and self._look_elsewhere(key, at):
                continue
            gone = at.setdefault("gone", int(time.time()))
            if time.time() - gone > self.forget_after:
                del self.known[key]

    def _new_key(self, device: int, inode: int) -> str:
        key = f"{device}-{inode}"
        while key in self.known:
            key += "+"
        return key

    def _mounted_anew(self, path: str, inode: int) -> str | None:
        """The known file of a path whose device has another number than before."""
        for key, at in self.known.items():
            if at["path"] == path and at["inode"] == inode and _recognised(path, at):
                return key
        return None

    def _look_elsewhere(self, key: str, at: dict) -> bool:
        """Look for a file under another name in its folder."""
        for path in _renamed(at["path"], {at["inode"]}):
            try:
                if identity(os.stat(path)) == (at["device"], at["inode"]) and (self._unchanged(key, path) or _recognised(path, at)):
                    return self._look(key, path)
            except FileNotFoundError:
                continue
        return False

    def _unchanged(self, key: str, path: str) -> bool:
        status = os.stat(path)
        return self.seen.get(key) == (*identity(status), status.st_size, status.st_mtime_ns)

    def _look(self, key: str, path: str) -> bool:
        """Note the state of a file; False if it is not there."""
        at = self.known.get(key)
        try:
            if at and "gone" not in at and self._unchanged(key, path):
                self.known[key] = {**at, "path": path}
                return True
            status = os.stat(path)
            end = complete_until(path)
            with open(path, "rb") as file:
                same = bool(at) and agrees(file, at["position"], at["mark"], at["head"], at["head_bytes"])
                head_bytes = min(_HEAD, status.st_size)
                head, empty = _digest(file, 0, head_bytes), _digest(file, 0, 0)
        except FileNotFoundError:
            return False
        device, inode = identity(status)
        self.seen[key] = (device, inode, status.st_size, status.st_mtime_ns)
        now = {"path": path, "device": device, "inode": inode, "head": head, "head_bytes": head_bytes}
        if same:
            self.known[key] = {**now, **{k: at[k] for k in ("named", "generation", "position", "mark")}}
        else:  # a new generation is a new file, under its own name
            self.known[key] = {**now, "named": path, "generation": at["generation"] + 1 if at else 0, "position": 0, "mark": empty}
        self.ends[key] = max(end, self.known[key]["position"])
        return True

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        self.commit(start)
        for key, at in start.items():
            self.known.setdefault(key, dict(at))  # after a restart, when this comes first
        self.initial = self.initial or {}
        ranges = []
        for key, until in end.items():
            # A file that was missing at a restart is not in the offsets from then.
            since = start.get(key) or self.done.get(key)
            same = since and since["generation"] == until["generation"]
            first = min(since["position"], until["position"]) if same else 0
            ranges += _ranges(until, first, self.range_bytes)
        return ranges

    def commit(self, end: dict) -> None:
        self.done.update(end)

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return _read(partition, self.fail_on_data_loss)


class UntilReader(DataSourceReader):
    """The lines before given positions, as a batch."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.until = json.loads(options["until"])
        self.range_bytes = int(options.get("rangeBytes", 64 << 20))

    def partitions(self) -> list[ByteRange]:
        ranges = []
        for path, end in self.until.items():
            with open(path, "rb") as file:
                status = os.fstat(file.fileno())
                head_bytes = min(_HEAD, end)
                at = {"path": path, "named": path, "inode": status.st_ino, "position": end, "head_bytes": head_bytes}
                at |= {"head": _digest(file, 0, head_bytes), "mark": _digest(file, max(0, end - _MARK), end)}
            ranges += _ranges(at, 0, self.range_bytes)
        return ranges or [ByteRange("", 0, 0, 0, 0, 0, "")]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        return _read(partition, True) if partition.path else iter(())


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> UntilReader:
        return UntilReader(self.options)

    def streamReader(self, schema: StructType) -> TailReader:
        return TailReader(self.options)


def tail_logs(spark: SparkSession, path: str, start: str | dict[str, int] = "end", **options: str) -> DataFrame:
    """Stream the lines appended to a file, or to all files of a pattern.

    ``start`` is ``end`` (only what comes from now on), ``beginning``, or byte positions per path,
    for example those up to which a batch has read. A line is passed on once it is finished.
    """
    spark.dataSource.register(TailSource)
    starting = start if isinstance(start, str) else json.dumps(start)
    return spark.readStream.format("tail").options(path=path, startingPosition=starting, **options).load()


def read_until(spark: SparkSession, ends: Mapping[str, int], **options: str) -> DataFrame:
    """The lines of mounted files before the given positions, see :func:`finished_positions`."""
    spark.dataSource.register(TailSource)
    return spark.read.format("tail").options(until=json.dumps(dict(ends)), **options).load()
