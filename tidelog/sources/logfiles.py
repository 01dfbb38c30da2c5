"""The files of a message log: which positions they hold, and how a commit adds to them.

A published log is a folder of commits, ``commit=<first position>``. A commit's files are named
``<first position>-<rows>-<writer>-<batch>-<n>.parquet``, so the position of a row is its file's first
position plus its place in the file. Positions have no gaps: a commit starts where the one before ended.
Logs from elsewhere store positions in a column; their files' footers tell which.

A commit becomes visible by one rename of its folder, so readers see all of it or nothing. ``_next.json``
notes where the next commit starts and the last batch of every stream. It is only a note: what a commit
holds is in its own ``_commit.json``, and a note that fell behind is rolled forward from there.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, takewhile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql.pandas.types import to_arrow_schema

from tidelog.schema import ID_PREFIX, OK, PLACE_DIGITS, RAW_MESSAGE

POSITION = "spool_seq"
STAGING, NOTE, RECORD = "_staging", "_next.json", "_commit.json"
_NAME = re.compile(rf"^(\d{{{PLACE_DIGITS}}})-(\d+)-")
# Rows of a row group that the writer makes: what a bounded read decodes beyond its own rows.
GROUP_ROWS = 10_000
# Rows that a task of an unbounded batch reads, if files or row groups are not longer.
SPAN_ROWS = 100_000
# Rows decoded at once, at most and at least.
READ_ROWS, LEAST_READ_ROWS = 1 << 13, 1 << 10
# Seconds that the times of folders must have stood before a listing surely shows all that came with them.
SETTLED = 2.0


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def _read_json(fs: pafs.FileSystem, path: str) -> dict:
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def _write_json(fs: pafs.FileSystem, path: str, value: dict) -> None:
    with fs.open_output_stream(path) as f:
        f.write(json.dumps(value).encode())


@dataclass(frozen=True)
class Unit:
    """A published file, or a row group of a file that stores positions: positions low to high."""

    path: str
    group: int | None
    rows: int
    low: int
    high: int

    @property
    def dense(self) -> bool:
        return self.high - self.low + 1 == self.rows


class Log:
    """The visible files of a log; a file is looked into once."""

    def __init__(self, path: str):
        self.fs, self.root = open_folder(path)
        self._known: dict[str, list[Unit]] = {}
        self._ordered: tuple[int, list[Unit], list[int]] = (0, [], [])
        self._folders = [self.root]
        # Times of the folders, since when they stand, and when the last listing began.
        self._times: dict[str, int] | None = None
        self._since = self._listed = float("-inf")

    def refresh(self) -> list[Unit]:
        """Look for new files; returns their units."""
        times, began = self._folder_times(), time.monotonic()
        if times is None or times != self._times:
            self._times, self._since = times, began
        self._listed = began
        found = pafs.FileSelector(self.root, recursive=True, allow_not_found=True)
        new, folders = [], [self.root]
        for info in self.fs.get_file_info(found):
            inside = info.path[len(self.root.rstrip("/")) + 1:]
            if any(p.startswith((".", "_")) for p in inside.split("/")):
                continue
            if info.type == pafs.FileType.Directory:
                folders.append(info.path)
            elif info.is_file and inside.endswith(".parquet") and info.path not in self._known:
                self._known[info.path] = self._units(info.path)
                new += self._known[info.path]
        self._folders = folders
        return new

    def unchanged(self) -> bool:
        """Whether the folders' times tell that the last listing still shows all files.

        A file that comes changes its folder's time, but not within a tick of the clock behind it: a listing
        counts once it began well after these times were first seen. Local disks only; others are listed.
        """
        times = self._folder_times()
        return times is not None and times == self._times and self._listed - self._since >= SETTLED

    def _folder_times(self) -> dict[str, int] | None:
        if not isinstance(self.fs, pafs.LocalFileSystem):
            return None
        infos = self.fs.get_file_info(self._folders)
        gone = any(i.type != pafs.FileType.Directory for i in infos)
        return None if gone else {i.path: i.mtime_ns for i in infos}

    def _units(self, path: str) -> list[Unit]:
        if named := _NAME.match(path.rsplit("/", 1)[-1]):
            first, rows = int(named[1]), int(named[2])
            return [Unit(path, None, rows, first, first + rows - 1)] if rows else []
        with self.fs.open_input_file(path) as f:
            file = pq.ParquetFile(f)
            if POSITION not in file.schema_arrow.names:
                raise ValueError(f"{path} has no column {POSITION}: not a message log")
            at = file.schema_arrow.names.index(POSITION)
            out = []
            for g in range(file.num_row_groups):
                rows = file.metadata.row_group(g).num_rows
                stats = _leaf(file.metadata.row_group(g), at).statistics
                if stats is not None and stats.has_min_max:
                    low, high = stats.min, stats.max
                elif rows:
                    ends = pc.min_max(file.read_row_group(g, [POSITION]).column(0)).as_py()
                    low, high = ends["min"], ends["max"]
                if rows and low is not None:
                    out.append(Unit(path, g, rows, low, high))
            return out

    @property
    def units(self) -> list[Unit]:
        """All units by their lowest position."""
        return self._in_order()[0]

    def _in_order(self) -> tuple[list[Unit], list[int]]:
        """All units by their lowest position, and the highest position up to each; kept until new files
        are found."""
        files, units, reach = self._ordered
        if files != len(self._known):
            units = sorted((u for us in self._known.values() for u in us), key=lambda u: (u.low, u.path))
            reach = list(accumulate((u.high for u in units), max))
            self._ordered = len(self._known), units, reach
        return units, reach

    def _from(self, position: int) -> list[Unit]:
        """Units in order, without those before the first that reaches a position."""
        units, reach = self._in_order()
        return units[bisect_left(reach, position):]

    def end(self) -> int:
        """The position after all that the log holds."""
        _, reach = self._in_order()
        return reach[-1] + 1 if reach else 0

    def grows_at_its_end(self) -> bool:
        """Whether all files are a published log's, to which commits only add higher positions."""
        return bool(self._known) and all(u.group is None for u in self.units)

    def cuts(self, start: int, size: int, consumers: int) -> list[int]:
        """Where batches of ``size`` rows for so many consumers end, from ``start`` on.

        Exact for positions with gaps and for files whose positions overlap. Columns are read only
        for those, and only as many positions as the batches take and their files share.
        """
        due = size * consumers
        held = np.empty(0, np.int64)
        for unit in self._from(start):
            if unit.high < start:
                continue
            if len(held) >= due and np.partition(held, due - 1)[due - 1] < unit.low:
                break
            held = np.concatenate([held, self._positions(unit, start, due)])
        held.sort()
        if not len(held):
            return []
        ends = [int(held[min(i + size, len(held)) - 1]) + 1 for i in range(0, min(due, len(held)), size)]
        return [e for i, e in enumerate(ends) if not i or e > ends[i - 1]]

    def _positions(self, unit: Unit, start: int, due: int) -> np.ndarray:
        low = max(unit.low, start)
        if unit.dense:
            return np.arange(low, min(unit.high + 1, low + due), dtype=np.int64)
        with self.fs.open_input_file(unit.path) as f:
            column = pq.ParquetFile(f).read_row_group(unit.group, [POSITION]).column(0)
        real = column.drop_null().to_numpy()
        return real[real >= low].astype(np.int64)

    def between(self, low: int, high: int) -> list[Unit]:
        """Units with positions from ``low`` to before ``high``."""
        reaching = takewhile(lambda u: u.low < high, self._from(low))
        return [u for u in reaching if u.high >= low]


    def spans(self, low: int, high: int, consumers: int) -> list[int]:
        """Where the tasks of an unbounded batch begin: each consumer's share of the units, in parts of about
        ``SPAN_ROWS`` at most, so that more rows are more tasks and not longer ones."""
        units = self.between(low, high)
        share = -(-len(units) // consumers)
        begins, rows = [], 0
        for i, unit in enumerate(units):
            if not i % share or rows + unit.rows > SPAN_ROWS:
                begins.append(unit.low)
                rows = 0
            rows += unit.rows
        return begins


def _leaf(group: pq.RowGroupMetaData, at: int) -> pq.ColumnChunkMetaData:
    """The chunk of a top-level column of scalars; columns before it may be nested."""
    for i in range(at, group.num_columns):
        if group.column(i).path_in_schema == POSITION:
            return group.column(i)
    return group.column(at)


def read_between(
    path: str, units: list[Unit], low: int, high: int, names: list[str]
) -> Iterator[pa.RecordBatch]:
    """Messages at positions from ``low`` to before ``high``; rejects are passed over."""
    fs, _ = open_folder(path)
    schema = pa.schema([f for f in to_arrow_schema(RAW_MESSAGE) if f.name in names])
    for unit in units:
        with fs.open_input_file(unit.path) as f:
            file = pq.ParquetFile(f)
            stored = [n for n in (*names, POSITION, "status") if n in file.schema_arrow.names]
            at = unit.low
            for g in range(file.num_row_groups) if unit.group is None else [unit.group]:
                rows = file.metadata.row_group(g).num_rows
                if unit.group is None and (at >= high or at + rows <= low):
                    at += rows
                    continue
                wanted = _last_wanted(file, g, low, high) if unit.group is not None else min(rows, high - at)
                step, decoded = min(max(high - low, LEAST_READ_ROWS), READ_ROWS), 0
                # One thread, as a consumer is one task; the rows behind the last wanted are not decoded.
                for batch in file.iter_batches(
                    step, [g], list(dict.fromkeys(stored)), use_threads=False
                ) if wanted else ():
                    first = at + decoded if unit.group is None else None
                    got = _messages(batch, first, low, high, schema)
                    decoded += batch.num_rows
                    if got.num_rows:
                        yield got
                    if decoded >= wanted:
                        break
                at += rows


def _last_wanted(file: pq.ParquetFile, group: int, low: int, high: int) -> int:
    """How many rows of a row group there are up to the last with a position that is wanted."""
    place = file.read_row_group(group, [POSITION], use_threads=False).column(POSITION)
    wanted = pc.and_(pc.greater_equal(place, low), pc.less(place, high))
    inside = np.flatnonzero(pc.fill_null(wanted, False).to_numpy())
    return int(inside[-1]) + 1 if len(inside) else 0


def _messages(
    batch: pa.RecordBatch, first: int | None, low: int, high: int, schema: pa.Schema
) -> pa.RecordBatch:
    columns = dict(zip(batch.schema.names, batch.columns, strict=True))
    if first is not None:
        place = pa.array(np.arange(first, first + batch.num_rows))
        width = f"{{:0{PLACE_DIGITS}d}}"
        columns[POSITION] = place
        if "rgmid" in schema.names:
            columns["rgmid"] = pa.array(
                [ID_PREFIX + width.format(i) for i in range(first, first + batch.num_rows)])
    place = columns[POSITION]
    wanted = pc.and_(pc.greater_equal(place, low), pc.less(place, high))
    if "status" in columns:
        good = pc.fill_null(pc.equal(columns["status"], OK), True)
        wanted = pc.and_(wanted, good)
    arrays = [
        _cast(columns[f.name], f.type) if f.name in columns else pa.nulls(batch.num_rows, f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema).filter(wanted)


def _cast(array: pa.Array, kind: pa.DataType) -> pa.Array:
    return array if array.type == kind else array.cast(kind)


@dataclass(frozen=True)
class Staged:
    """A file that a task wrote aside, in a commit that may come."""

    name: str
    rows: int
    failed: int


def commit(
    path: str, staged: str, files: list[Staged], writer: str, batch: int | None,
    overwrite: bool = False,
) -> int | None:
    """Make staged files, in this order, the log's next commit; returns its first position.

    A batch of a stream that is already in the log is dropped: None. Two writers that reach for the
    same place meet at the rename, and the later one goes on to the next.
    """
    fs, root = open_folder(path)
    fs.create_dir(root, recursive=True)
    if overwrite:
        _clear(fs, root)
    rows = sum(f.rows for f in files)
    names = [f.name for f in files]
    while True:
        note = _rolled(fs, root)
        if batch is not None and note["batches"].get(writer, -1) >= batch or not rows:
            fs.delete_dir(staged)
            return None
        at = first = note["next"]
        for i, file in enumerate(files):
            name = f"{at:0{PLACE_DIGITS}d}-{file.rows}-{writer}-{batch or 0}-{i}.parquet"
            fs.move(f"{staged}/{names[i]}", f"{staged}/{name}")
            names[i], at = name, at + file.rows
        _write_json(fs, f"{staged}/{RECORD}", {
            "first": first, "rows": rows, "writer": writer, "batch": batch,
            "failed": sum(f.failed for f in files),
        })
        place = _commit_path(root, first)
        try:
            fs.move(staged, place)
        except OSError:
            if not exists(fs, f"{place}/{RECORD}"):
                raise
            continue
        _rolled(fs, root)
        return first


def _commit_path(root: str, first: int) -> str:
    return f"{root}/commit={first:0{PLACE_DIGITS}d}"


def _rolled(fs: pafs.FileSystem, root: str) -> dict:
    """The note, brought up to the last commit there is."""
    path = f"{root}/{NOTE}"
    if exists(fs, path):
        note = _read_json(fs, path)
    else:
        note = {"next": _first_commit(fs, root), "batches": {}}
    before = json.dumps(note)
    while exists(fs, record := f"{_commit_path(root, note['next'])}/{RECORD}"):
        made = _read_json(fs, record)
        note["next"] = made["first"] + made["rows"]
        if made["batch"] is not None:
            note["batches"][made["writer"]] = made["batch"]
    if json.dumps(note) != before:
        fresh = f"{path}.{uuid.uuid4().hex}"
        _write_json(fs, fresh, note)
        if not isinstance(fs, pafs.LocalFileSystem) and exists(fs, path):
            fs.delete_file(path)  # a lost note is made anew from the commits
        fs.move(fresh, path)
    return note


def _first_commit(fs: pafs.FileSystem, root: str) -> int:
    """Where the chain of commits starts: at 0, unless the log was cut off at its old end."""
    infos = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    if any(i.is_file and i.base_name.endswith(".parquet") for i in infos):
        raise ValueError(f"{root} holds messages with positions of their own: publish to another folder")
    made = [int(i.base_name[7:]) for i in infos if i.base_name.startswith("commit=")]
    return min(made, default=0)


def _clear(fs: pafs.FileSystem, root: str) -> None:
    for info in fs.get_file_info(pafs.FileSelector(root)):
        if info.base_name == NOTE or info.base_name.endswith(".parquet"):
            fs.delete_file(info.path)
        elif info.base_name.startswith("commit="):
            fs.delete_dir(info.path)
