"""A table's snapshot, then its changes, as one stream.

The offset is (phase, position). In phase ``snapshot`` the position counts row
groups of the snapshot's files, in order of file name; every row comes as an
envelope ``{"op": "r", "after": <row>}`` with a seq before any change. In phase
``changes`` it is the seq of the last change read; the changes go on after
``changesFrom``, the seq up to which the snapshot was taken. The batch that
reads the last of the snapshot ends at (changes, changesFrom): from there on
only changes are read, so the handover happens once, whatever restarts. Of the
changes a batch reads the row groups that hold some of its seqs (by the footers):
files in order of seq are read about once in all.

Spark asks for the latest offset without saying where the stream stands; the
reader notes the range of every planned batch in ``progressPath``. A batch is
planned only after Spark has logged its offsets, so after a restart Spark either
plans the noted range again or goes on from its end.

Options: ``snapshotPath`` (Parquet files, immutable), ``changesPath`` (Parquet
files of (seq, value), to which higher seqs are added), ``progressPath`` (in the
shared folder), ``changesFrom`` (default: read all changes),
``unitsPerTrigger`` (row groups), ``seqsPerTrigger``.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from rivulet.operators.configs import PRELOAD_SEQ

FORMAT = "snapshot_then_changes"
SNAPSHOT, CHANGES = "snapshot", "changes"


class Unit(InputPartition):
    """A row group of the snapshot, or the changes of a file's row groups in (low, high]."""

    def __init__(self, path: str, group: int = -1, first: int = 0, low: int = 0, high: int = 0, groups: tuple[int, ...] = ()):
        self.path, self.group, self.first, self.low, self.high, self.groups = path, group, first, low, high, groups


def _open(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _files(path: str) -> list[str]:
    """Parquet files under a folder, by name; none if it does not exist yet."""
    from pyarrow import fs

    system, root = _open(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    names = sorted(i.path for i in found if i.type == fs.FileType.File and i.path.endswith(".parquet"))
    head = path[:path.index("://") + 3] if "://" in path else ""
    return [head + n if head and not n.startswith(head) else n for n in names]


def _footer(path: str):
    import pyarrow.parquet as pq

    system, name = _open(path)
    return pq.read_metadata(name, filesystem=system)


class SnapshotThenChangesReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.snapshot, self.changes = options["snapshotPath"], options["changesPath"]
        self.progress = options["progressPath"]
        self.after = int(options.get("changesFrom", -(1 << 62) + (1 << 61)))
        self.units_a_batch = int(options.get("unitsPerTrigger", 64))
        self.seqs_a_batch = int(options.get("seqsPerTrigger", 10_000_000))
        self.footers: dict = {}
        self.at = self._noted()

    # -- where the stream stands

    def _noted(self) -> dict | None:
        system, path = _open(posixpath.join(self.progress, "planned.json"))
        try:
            with system.open_input_stream(path) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def _note(self, end: dict) -> None:
        system, root = _open(self.progress)
        system.create_dir(root, recursive=True)
        path = posixpath.join(root, "planned.json")
        with system.open_output_stream(path + ".new") as f:
            f.write(json.dumps(end).encode())
        system.move(path + ".new", path)

    def initialOffset(self) -> dict:
        return {"phase": SNAPSHOT, "position": 0}

    def latestOffset(self) -> dict:
        at = self.at or self.initialOffset()
        if at["phase"] == SNAPSHOT:
            total = len(self._groups())
            ahead = at["position"] + self.units_a_batch
            return {"phase": SNAPSHOT, "position": ahead} if ahead < total else {"phase": CHANGES, "position": self.after}
        bounds = [b for b in map(self._range, _files(self.changes)) if b and b[1] > at["position"]]
        if not bounds:
            return at
        low = min(max(a, at["position"] + 1) for a, _ in bounds)
        return {"phase": CHANGES, "position": min(max(b for _, b in bounds), low - 1 + self.seqs_a_batch)}

    def partitions(self, start: dict, end: dict) -> list[Unit]:
        if (start["phase"] == CHANGES, start["position"]) > (end["phase"] == CHANGES, end["position"]):
            raise ValueError(f"{self.progress} is behind the checkpoint: {end} follows {start}")
        self._note(end)
        self.at = end
        units: list[Unit] = []
        if start["phase"] == SNAPSHOT:
            groups = self._groups()
            units += groups[start["position"]:end["position"] if end["phase"] == SNAPSHOT else len(groups)]
        if end["phase"] == CHANGES:
            low, high = start["position"] if start["phase"] == CHANGES else self.after, end["position"]
            units += [Unit(f, low=low, high=high, groups=held) for f in _files(self.changes)
                      if (held := tuple(g for g, b in enumerate(self._ranges(f)) if b and b[1] > low and b[0] <= high))]
        return units

    def _groups(self) -> list[Unit]:
        out, first = [], 0
        for path in _files(self.snapshot):
            footer = self.footers.setdefault(path, None) or _footer(path)
            self.footers[path] = footer
            for g in range(footer.num_row_groups):
                out.append(Unit(path, group=g, first=first))
                first += footer.row_group(g).num_rows
        return out

    def _ranges(self, path: str) -> list[tuple[int, int] | None]:
        """Least and greatest seq of every row group of a file, from its footer;
        None for one without a seq."""
        if path not in self.footers:
            footer = _footer(path)
            column = footer.schema.to_arrow_schema().names.index("seq")
            stats = [footer.row_group(g).column(column).statistics for g in range(footer.num_row_groups)]
            self.footers[path] = [(s.min, s.max) if s.has_min_max else None for s in stats]
        return self.footers[path]

    def _range(self, path: str) -> tuple[int, int] | None:
        """Least and greatest seq of a file."""
        held = [b for b in self._ranges(path) if b]
        return (min(a for a, _ in held), max(b for _, b in held)) if held else None

    # -- rows, in a task

    def read(self, unit: Unit) -> Iterator[tuple]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        system, name = _open(unit.path)
        if unit.group >= 0:
            rows = pq.ParquetFile(name, filesystem=system).read_row_group(unit.group).to_pylist()
            for i, row in enumerate(rows, unit.first):
                yield PRELOAD_SEQ + i, json.dumps({"op": "r", "before": None, "after": row}, ensure_ascii=False, default=str)
            return
        held = pq.ParquetFile(name, filesystem=system)
        for batch in held.iter_batches(row_groups=list(unit.groups), columns=["seq", "value"]):
            seq = batch.column("seq")
            batch = batch.filter(pc.and_(pc.greater(seq, unit.low), pc.less_equal(seq, unit.high)))
            yield from zip(batch.column("seq").to_pylist(), batch.column("value").to_pylist())


class SnapshotThenChanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "seq long, value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return SnapshotThenChangesReader({k: self.options[k] for k in (
            "snapshotPath", "changesPath", "progressPath", "changesFrom", "unitsPerTrigger", "seqsPerTrigger") if k in self.options})


def read_snapshot_then_changes(spark: SparkSession, options: dict) -> DataFrame:
    """(seq, value) of a table's snapshot and changes, as a stream."""
    import pyspark.cloudpickle as cloudpickle

    import rivulet.sources.hybrid as own

    cloudpickle.register_pickle_by_value(own)      # executors need no copy of the package for this source
    spark.dataSource.register(SnapshotThenChanges)
    return spark.readStream.format(FORMAT).options(**options).load()
