"""Keyed tables that are merged when read.

A table is a list of immutable folders of rows, oldest first, and a manifest that names them:

    <table>/data/<unique name>/part-*.parquet
    <table>/manifest/<number>          the list as JSON, one file for each commit

An upsert writes its batch as one more folder and commits a manifest with one entry more. A reader takes the newest manifest and keeps
the latest version of every key; of equal versions the later folder wins. The reader finds the replaced rows from keys and versions
alone and leaves them out, so whole rows are not sorted. Compaction merges neighbouring folders of like size, so
there are few folders (their number grows with the logarithm of the rows) and a row is rewritten that many times at most.

A commit is one rename to the next number, which fails if another writer was faster; then the change is made anew on top of that
one's list. A job that dies before its commit leaves a folder that no manifest names: nothing is lost, nothing is seen
twice, and `clean` removes it later. A batch may carry a token; a token that is committed already is not applied again, so a
repeated micro-batch changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.operators.incremental import latest
from salesloom.sources import storage

# A folder is merged with the next younger one unless it holds more than this many times its rows.
LIKE_SIZE = 4

_RANK = "folder_rank__"


@dataclass(frozen=True)
class Folder:
    name: str
    rows: int


@dataclass(frozen=True)
class Manifest:
    """One commit: its number, the folders of the table, oldest first, and the last token of each writer."""

    number: int
    folders: tuple[Folder, ...]
    tokens: dict[str, int]

    def text(self) -> str:
        return json.dumps({"folders": [asdict(f) for f in self.folders], "tokens": self.tokens})


@dataclass(frozen=True)
class VersionedTable:
    """A keyed table at a path; `version` orders the rows of a key, within a folder too."""

    spark: SparkSession
    path: str
    key: tuple[str, ...]
    version: tuple[str, ...]

    # ---- reading ---------------------------------------------------------------------------------------------------

    def manifest(self) -> Manifest:
        numbers = [int(n) for n in storage.names(self.spark, f"{self.path}/manifest") if n.isdigit()]
        if not numbers:
            return Manifest(0, (), {})
        held = json.loads(storage.read_text(self.spark, self._commit_path(max(numbers))))
        return Manifest(max(numbers), tuple(Folder(**f) for f in held["folders"]), held["tokens"])

    def exists(self) -> bool:
        return bool(self.manifest().folders)

    def read(self) -> DataFrame:
        """The latest version of every key."""
        folders = self.manifest().folders
        if not folders:
            raise ValueError(f"nothing is committed in {self.path} yet")
        return self._merged(folders)

    def _merged(self, folders: Sequence[Folder]) -> DataFrame:
        if len(folders) == 1:  # a folder holds one row a key
            return self._rows(folders[0])
        ranked = [self._rows(f).withColumn(_RANK, F.lit(rank)) for rank, f in enumerate(folders)]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
        lost = self._superseded(ranked)
        same = reduce(lambda a, b: a & b, (rows[c].eqNullSafe(lost[f"{c}__lost"]) for c in (*self.key, _RANK)))
        return rows.join(lost, same, "left_anti").drop(_RANK)

    def _superseded(self, ranked: Sequence[DataFrame]) -> DataFrame:
        """Key and folder (with `__lost` behind their names) of the rows that a later version replaces.

        Only keys and versions are read for it. A folder holds a key once, so key and folder name a row; only keys of the younger
        folders can have replaced one, so the oldest folder, usually by far the largest, gives its rows of those keys only. Whole rows
        are not shuffled while the replaced ones are few enough for Spark to broadcast, and are never grouped.
        """
        narrow = [rows.select(*self.key, *self.version, _RANK) for rows in ranked]
        younger = reduce(DataFrame.unionByName, narrow[1:])
        renamed = {c: f"{c}__young" for c in self.key}
        keys = younger.select(*self.key).distinct().withColumnsRenamed(renamed)
        meets = reduce(lambda a, b: a & b, (narrow[0][c].eqNullSafe(keys[new]) for c, new in renamed.items()))
        rivals = narrow[0].join(keys, meets, "left_semi").unionByName(younger)
        # As many folders a key as the table has, at most.
        won = rivals.groupBy(*self.key).agg(F.max(F.struct(*self.version, _RANK)).alias("won"), F.collect_set(_RANK).alias("ranks"))
        others = F.array_remove("ranks", F.col(f"won.{_RANK}"))
        return won.select(*(F.col(c).alias(f"{c}__lost") for c in self.key), F.explode(others).alias(f"{_RANK}__lost"))

    def _rows(self, folder: Folder) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data/{folder.name}")

    # ---- writing ---------------------------------------------------------------------------------------------------

    def upsert(self, rows: DataFrame, writer: str | None = None, token: int | None = None) -> int:
        """Add a batch: its latest row of each key. Returns the rows written, 0 for a token of this writer that is not newer."""
        if writer is not None and token is not None and self.manifest().tokens.get(writer, -1) >= token:
            return 0
        folder = self._written(latest(rows, self.key, self.version))

        def add(old: Manifest) -> Manifest | None:
            if writer is not None and token is not None:
                if old.tokens.get(writer, -1) >= token:
                    return None
                return Manifest(old.number + 1, (*old.folders, folder), old.tokens | {writer: token})
            return Manifest(old.number + 1, (*old.folders, folder), old.tokens)

        return folder.rows if self._commit(add) else 0

    def compact(self, everything: bool = False) -> int:
        """Merge the youngest folders of like size (or all) into one; returns how many were merged."""
        folders = self.manifest().folders
        begin = 0 if everything else like_size(folders)
        old = folders[begin:]
        if len(old) < 2:
            return 0
        merged = self._written(self._merged(old))

        def swap(now: Manifest) -> Manifest | None:
            # Batches that came meanwhile stay behind the merged folder.
            names = [f.name for f in now.folders]
            if old[0].name not in names:
                return None
            at = names.index(old[0].name)
            if tuple(now.folders[at : at + len(old)]) != old:
                return None
            return Manifest(now.number + 1, (*now.folders[:at], merged, *now.folders[at + len(old) :]), now.tokens)

        return len(old) if self._commit(swap) else 0

    def clean(self, keep_commits: int = 1) -> list[str]:
        """Remove old manifests and the folders that none of the kept ones names.

        For a time without writers: the folder of a batch that is not committed yet looks like one that was left behind. Returns the removed folders."""
        numbers = sorted(int(n) for n in storage.names(self.spark, f"{self.path}/manifest") if n.isdigit())
        kept, gone = numbers[-keep_commits:], numbers[:-keep_commits]
        named = {f["name"] for n in kept for f in json.loads(storage.read_text(self.spark, self._commit_path(n)))["folders"]}
        for number in gone:
            storage.delete(self.spark, self._commit_path(number))
        removed = [n for n in storage.names(self.spark, f"{self.path}/data") if n not in named]
        for name in removed:
            storage.delete(self.spark, f"{self.path}/data/{name}")
        return removed

    def _written(self, rows: DataFrame) -> Folder:
        name = uuid.uuid4().hex
        seen = _Counted(rows)
        seen.frame.write.parquet(f"{self.path}/data/{name}")
        return Folder(name, seen.count())

    def _commit(self, change: Callable[[Manifest], Manifest | None]) -> bool:
        """Commit a change of the newest manifest; False if the change finds nothing left to do."""
        while True:
            fresh = change(self.manifest())
            if fresh is None:
                return False
            try:
                storage.write_once(self.spark, self._commit_path(fresh.number), fresh.text())
                return True
            except storage.AlreadyThere:
                continue

    def _commit_path(self, number: int) -> str:
        return f"{self.path}/manifest/{number:010d}"


class _Counted:
    """Rows that are counted while they are written."""

    def __init__(self, rows: DataFrame):
        from pyspark.sql import Observation

        self.seen = Observation()
        self.frame = rows.observe(self.seen, F.count(F.lit(1)).alias("rows"))

    def count(self) -> int:
        return self.seen.get["rows"]


def like_size(folders: Sequence[Folder]) -> int:
    """Where the youngest folders begin that are to be merged: an older one joins while it is not much larger than what follows."""
    begin, rows = len(folders), 0
    while begin > 0 and (begin == len(folders) or folders[begin - 1].rows <= LIKE_SIZE * rows):
        begin -= 1
        rows += folders[begin].rows
    return begin
