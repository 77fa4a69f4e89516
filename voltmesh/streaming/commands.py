"""User lists kept up to date from a stream of commands."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.user_lists import as_commands, merge_filters, merge_flags
from ..schemas import schema
from ..sinks.ledger import PublishConflict
from ..sinks.tables import DeltaLog, VersionedTable
from .status import run_of

COMMAND = schema(
    "user_id BIGINT, op STRING, item STRING, ts TIMESTAMP_NTZ, event_id BIGINT, name STRING"
)
FLAG_COMMAND = schema("user_id BIGINT, op STRING, idx INT, ts TIMESTAMP_NTZ, event_id BIGINT")
# Entries of lists that commands are merged into: filters with their place among the item's adds, flags
# as the command that was last.
FILTER_ENTRY = schema("user_id BIGINT, item STRING, ts TIMESTAMP_NTZ, event_id BIGINT, nth BIGINT")
FLAG_ENTRY = schema("user_id BIGINT, idx INT, op STRING, ts TIMESTAMP_NTZ, event_id BIGINT")
COMPACT_EVERY = 60
# Parts of the published entries, by user.
PARTS = 16

Fold = Callable[[DataFrame], DataFrame]
Merge = Callable[[DataFrame, DataFrame], DataFrame]


def replayed(fold: Fold, command: T.StructType) -> Merge:
    """A fold of a whole log as a merge: an entry counts as the add that made it, so folding the entries
    together with the later commands gives the same lists as the whole log would."""

    def merge(entries: DataFrame, log: DataFrame) -> DataFrame:
        start = as_commands(entries).select(*command.names)
        return fold(start.unionByName(log.select(*command.names)))

    return merge


class ListStore:
    """Entries of one kind of list, plus the commands since they were published."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        fold: Fold | None = None,
        command: T.StructType = COMMAND,
        parts: int = PARTS,
        merge: Merge | None = None,
        entry: T.StructType | None = None,
    ):
        """Either `fold`, for lists whose entries can be replayed as adds, or `merge` and `entry`."""
        self.spark = spark
        self.command = command
        self.merge = merge or replayed(fold, command)
        entry = entry or T.StructType([command[n] for n in command.names if n != "op"])
        self.entry = entry.names
        self.entries = VersionedTable(spark, f"{root.rstrip('/')}/entries", parts, "user_id")
        self.log = DeltaLog(spark, f"{root.rstrip('/')}/log", command)
        self.entries.ensure(spark.createDataFrame([], entry))

    @classmethod
    def of_filters(cls, spark: SparkSession, root: str) -> ListStore:
        return cls(spark, root, merge=merge_filters, entry=FILTER_ENTRY)

    @classmethod
    def of_flags(cls, spark: SparkSession, root: str) -> ListStore:
        return cls(spark, root, command=FLAG_COMMAND, merge=merge_flags, entry=FLAG_ENTRY)

    def read(self) -> DataFrame:
        """Current entries of all users."""
        version, done = self.entries.last()
        return self.merge(self.entries.read(version=version), self.log.read(done))

    def add_batch(self, commands: DataFrame, batch: int, run: str = "") -> None:
        seq = self.log.add(commands, run, batch)
        if seq - self.entries.last()[1] >= COMPACT_EVERY:
            with contextlib.suppress(PublishConflict):  # another job published: the next batch compacts
                self.compact()

    def compact(self) -> None:
        """Publish the lists of the users that the log touches, keep the other parts."""
        (version, done), upto = self.entries.last(), self.log.last()
        if upto == done:
            return
        log = self.log.read(done, upto)
        touched = [r[0] for r in log.select(self.entries.part_of()).distinct().collect()]
        folded = self.merge(self.entries.read(only=touched, version=version), log)
        self.entries.publish(folded.select(*self.entry), upto, only=touched, read_from=version)
        self.log.prune(done)  # readers of the version before may still fold the rest


def run_commands(store: ListStore, commands: DataFrame, checkpoint: str) -> StreamingQuery:
    def add(rows: DataFrame, batch: int) -> None:
        store.add_batch(rows, batch, run_of(store.spark, checkpoint))

    return (
        commands.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
