"""Small records beside snapshot files: which try of a run holds, and what it consists of.

A run's folder is ``<root>/tech_year=../tech_month=../tech_day=../tech_hour=../run=<label>``, and every try
of the run writes its files to ``try=<id>`` below. When the files of a try are complete, a record
``_try-<number>.json`` is renamed into place: the greatest number holds. A rename either happens or not and never
replaces a record, so a reader sees one whole try before, during and after the next one, and a try that
fails leaves no record.

The newest run is found by going down the folders, whose names sort in time order, always into the newest name first:
a listing holds at most the years, 12 months, 31 days, 24 hours or the runs of one hour, whatever the length
of the history.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession

RECORD_PREFIX, RECORD_SUFFIX = "_try-", ".json"
PARTITION_COLUMNS = ["tech_year", "tech_month", "tech_day", "tech_hour", "run"]
TRY_COLUMN = "try"


class Store:
    """The file system that holds root, through Spark's Hadoop client."""

    def __init__(self, spark: SparkSession, root: str):
        self.Path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[tuple[str, int]]:
        """(name, bytes) of what stands in a folder; empty where there is none."""
        path = self.Path(folder)
        if not self.fs.exists(path):
            return []
        return [(f.getPath().getName(), f.getLen()) for f in self.fs.listStatus(path)]

    def read(self, path: str) -> str:
        stream = self.fs.open(self.Path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_new(self, path: str, text: str, temporary: str) -> bool:
        """Writes a file that is not there yet, whole or not at all; False if it is there."""
        stream = self.fs.create(self.Path(temporary), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.exists(self.Path(path)) and self.fs.rename(self.Path(temporary), self.Path(path)):
            return True
        self.fs.delete(self.Path(temporary), False)
        return False

    def delete(self, folder: str) -> None:
        self.fs.delete(self.Path(folder), True)


def folder_of(label: str) -> str:
    """A run's folder below its root, from its label (yyyyMMddTHHmmssSSSSSS)."""
    year, month, day, hour = label[:4], label[4:6], label[6:8], label[9:11]
    values = [year, f"{year}-{month}", f"{year}-{month}-{day}", hour, label]
    return "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLUMNS, values))


def _number(name: str) -> int:
    return int(name.removeprefix(RECORD_PREFIX).removesuffix(RECORD_SUFFIX))


def records(store: Store, run_folder: str) -> list[dict]:
    """The records of a run's tries, the one that holds last."""
    found = sorted(n for n, _ in store.names(run_folder) if n.startswith(RECORD_PREFIX) and n.endswith(RECORD_SUFFIX))
    return [json.loads(store.read(f"{run_folder}/{n}")) for n in sorted(found, key=_number)]


def commit(store: Store, run_folder: str, try_id: str, content: dict) -> None:
    """Makes try_id the one that holds. Two tries that commit at once get a number each; the later one holds."""
    text = json.dumps(content | {"try": try_id})
    while True:
        numbers = [_number(n) for n, _ in store.names(run_folder) if n.startswith(RECORD_PREFIX) and n.endswith(RECORD_SUFFIX)]
        name = f"{RECORD_PREFIX}{max(numbers, default=0) + 1:06d}{RECORD_SUFFIX}"
        if store.put_new(f"{run_folder}/{name}", text, f"{run_folder}/_writing-{try_id}"):
            return


def runs_newest_first(store: Store, root: str, as_of: str | None = None) -> Iterator[tuple[str, str]]:
    """(label, folder) of a dataset's runs at or before the label as_of; folders are listed as they are come to."""
    limits = folder_of(as_of).split("/") if as_of else None

    def below(folder: str, depth: int, at_limit: bool) -> Iterator[tuple[str, str]]:
        if depth == len(PARTITION_COLUMNS):
            yield folder.rpartition("=")[2], folder
            return
        for name in sorted((n for n, _ in store.names(folder) if n.startswith(f"{PARTITION_COLUMNS[depth]}=")), reverse=True):
            if at_limit and name > limits[depth]:
                continue
            yield from below(f"{folder}/{name}", depth + 1, at_limit and name == limits[depth])

    yield from below(root.rstrip("/"), 0, limits is not None)
