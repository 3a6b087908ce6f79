"""The list of folders to read after loads have been merged, and the removal of folders no one reads.

A merge is published like a load: one small file under the next number, put there only if it is free. It names the
last load it covers and all folders that hold these loads, so a reader takes those and adds the loads since.
"""

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tallyhouse.plans.commits import CommitLog

SCHEMA = "merge_no int, upto int, folders array<string>, merged_at timestamp_ntz"


@dataclass(frozen=True)
class State:
    """Folders that hold all loads up to a number."""

    number: int = 0
    upto: int = 0
    folders: tuple[str, ...] = ()
    merged_at: datetime | None = None


class Merges:
    def __init__(self, spark: SparkSession, root: str):
        self.log = CommitLog(spark, root, SCHEMA)

    def states(self) -> list[State]:
        """What readers have seen, oldest first; before the first merge that was no folder but the loads' own."""
        rows = self.log.rows().orderBy("merge_no").collect()
        return [State(), *(State(r.merge_no, r.upto, tuple(r.folders), r.merged_at) for r in rows)]

    def last(self) -> State:
        return self.states()[-1]

    def publish(self, before: State, upto: int, folders: list[str], at: datetime) -> bool:
        """Replace the state `before`; False if another merge has done so."""
        return self.log.publish(before.number + 1, {"upto": upto, "folders": folders, "merged_at": at.isoformat()})

    def since(self, moment: datetime) -> list[State]:
        """All states that readers could have seen at the moment or later."""
        states = self.states()
        old = [i for i, s in enumerate(states) if s.merged_at is not None and s.merged_at < moment]
        return states[old[-1] if old else 0 :]


def remove_older(spark: SparkSession, path: str, keep: set[str], before: datetime) -> list[str]:
    """Delete the folders in `path` but those in `keep` and those with a file from `before` or later; returns them.

    Files tell the time, not folders: object stores know none for folders.
    """
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    limit, gone = int(before.replace(tzinfo=timezone.utc).timestamp() * 1000), []
    for folder in files.listStatus(place):
        if not folder.isDirectory() or folder.getPath().getName() in keep:
            continue
        found = files.listFiles(folder.getPath(), True)
        times = []
        while found.hasNext():
            times.append(found.next().getModificationTime())
        # Without a file the folder may be one that is about to be filled.
        if times and max(times) < limit and files.delete(folder.getPath(), True):
            gone.append(folder.getPath().toString())
    return gone
