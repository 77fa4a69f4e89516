"""The minute feed: a log of deltas on top of a published snapshot.

A micro-batch writes only its own delta, so its cost does not grow with the
snapshot. Readers fold the deltas since the last version into it; a compaction
publishes the result as the next version, rewriting only the parts that the deltas touch.

While the snapshot is being rebuilt (ck 0) deltas go on into the same log, but readers
of the snapshot stop at the mark the rebuild set; the deltas behind it are the buffer.
The rebuilt snapshot is published with the buffer replayed before ck is set again, so a
failure at any step leaves every delta where a reader or the next attempt finds it.
The minute job alone compacts the snapshot while ck is 1, the rebuild alone publishes it
while ck is 0.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.merges import fold_updates, latest_per_key, replay_buffer
from ..operators.regions import availability_changes, available_by_code, shifted_counts
from ..schemas import CONTROL, KEYS, STATUS, STATUS_COLUMNS
from ..sinks.ledger import PublishConflict, exists
from ..sinks.tables import ATTEMPTS, DeltaLog, VersionedTable

SNAPSHOT, BUFFER = "snapshot", "buffer"

# Deltas between compactions, of the snapshot and of the buffer; also the most entries one
# charger can have in what is folded.
COMPACT_EVERY = 60
# Bytes of delta files (six columns, compressed) that may go to every task of a merge; more are shuffled.
SMALL_LOG = 4 << 20
# Parts of the snapshot, by charger.
PARTS = 16


class StatusStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        parts: int = PARTS,
        layout: Callable[[DataFrame], DataFrame] | None = None,
        buckets: int = 0,
        small_log: int | None = None,
    ):
        """`layout` orders the rows of a snapshot before they are written, by place for example.

        With `buckets`, each part of the snapshot is cut by charger too, and logs of any size are merged
        without moving its rows; a snapshot in buckets keeps no layout.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.layout = layout or (lambda rows: rows)
        self.small_log = small_log
        self.tables = {
            SNAPSHOT: VersionedTable(spark, f"{self.root}/{SNAPSHOT}", parts, "statid", buckets, KEYS),
            BUFFER: VersionedTable(spark, f"{self.root}/{BUFFER}"),
        }
        self.log = DeltaLog(spark, f"{self.root}/log", STATUS)
        self.control_table = VersionedTable(spark, f"{self.root}/control")
        self.counts = VersionedTable(spark, f"{self.root}/available")

    def ensure_tables(self, now: float) -> None:
        """An empty buffer and the control row (1, 1, now), unless they exist."""
        self.tables[BUFFER].ensure(self.spark.createDataFrame([], STATUS))
        self.control_table.ensure(self.spark.createDataFrame([(1, 1, now)], CONTROL))

    def control(self) -> tuple[int, float]:
        return self._control()[:2]

    def _control(self) -> tuple[int, float, int]:
        """ck, time of the last run and mark, of one version."""
        version, mark = self.control_table.last()
        row = self.control_table.read(version=version).first()
        return row["ck"], row["time"], mark

    def set_control(self, ck: int | None = None, at: float | None = None, mark: int | None = None) -> None:
        """Change what is given, keep the rest, whatever other jobs change meanwhile."""
        for _ in range(ATTEMPTS):
            version, old_mark = self.control_table.last()
            old = self.control_table.read(version=version).first()
            row = (1, old["ck"] if ck is None else ck, old["time"] if at is None else at)
            rows = self.spark.createDataFrame([row], CONTROL)
            try:
                self.control_table.publish(rows, old_mark if mark is None else mark, read_from=version)
            except PublishConflict:
                continue
            return
        raise PublishConflict(f"{self.root}/control")

    def _mark(self) -> int | None:
        """Last delta that readers of the snapshot see; None while no rebuild runs."""
        ck, _, mark = self._control()
        return mark if ck == 0 else None

    def _small(self, after: int, upto: int | None) -> bool:
        """Whether the deltas may go to every task, `small_log` bytes at most."""
        return self.log.size(after, upto) <= (SMALL_LOG if self.small_log is None else self.small_log)

    def read(self, name: str = SNAPSHOT) -> DataFrame:
        table = self.tables[name]
        limit = self._mark() if name == SNAPSHOT else None
        version, done = table.last()
        log = self.log.read(done, limit)
        small = self._small(done, limit)
        parts = [] if small else table.aligned_parts(version=version)
        if parts:
            return self._fold_parts(parts, log)
        return fold_updates(table.read(version=version), log, "seq", upsert=name == BUFFER, small=small)

    def _fold_parts(self, parts: list[tuple[int, DataFrame]], log: DataFrame) -> DataFrame:
        """The log folded into aligned parts, each with its own rows of the log: only the log is shuffled."""
        own = self.tables[SNAPSHOT].part_of()
        folded = [fold_updates(rows, log.filter(own == part), "seq", upsert=False) for part, rows in parts]
        return reduce(DataFrame.unionAll, folded)

    def merge_batch(self, rows: DataFrame, batch: int, run: str = "", at: float | None = None) -> None:
        """Log the newest row of each charger and the time of the run.

        Rows without a key go to a table of their own, see `rejected`. A repeated batch of
        the same run changes nothing. The batch is read once and held while both parts are written.
        """
        if self.log.number_of(run, batch) is None:
            held = rows.persist()
            try:
                seq = self._log(held, run, batch)
            finally:
                held.unpersist()
        else:
            seq = self.log.number_of(run, batch)
        if at is not None:
            self.set_control(at=at)
        name = SNAPSHOT if self.control()[0] == 1 else BUFFER
        if seq - self.tables[name].last()[1] >= COMPACT_EVERY:
            with contextlib.suppress(PublishConflict):  # another job published: the next batch compacts
                self.compact(name)

    def _log(self, rows: DataFrame, run: str, batch: int) -> int:
        keyed = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in KEYS])
        source = F.col("source") if "source" in rows.columns else F.lit(None).cast("string")
        bad = rows.filter(~keyed).select(*STATUS.names, source.alias("source"))
        if not bad.isEmpty():
            bad.write.mode("overwrite").parquet(f"{self.root}/rejected/run={run or '-'}/batch={batch}")
        return self.log.add(latest_per_key(rows.filter(keyed)).select(*STATUS.names), run, batch)

    def rejected(self) -> DataFrame:
        """Rows of the feed that have no key, with the text they came as where the feed has it."""
        columns = T.StructType([*STATUS.fields, T.StructField("source", T.StringType())])
        if not exists(self.spark, f"{self.root}/rejected"):
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(f"{self.root}/rejected").select(*columns.names)

    def compact(self, name: str = SNAPSHOT) -> None:
        """Publish the table with the deltas folded in, and drop what no reader needs."""
        table, upto = self.tables[name], self.log.last()
        if name == SNAPSHOT and self._mark() is not None:
            return
        version, done = table.last()
        log, small = self.log.read(done, upto), self._small(done, upto)
        if name == SNAPSHOT:
            touched = [r[0] for r in log.select(table.part_of()).distinct().collect()]
            parts = table.aligned_parts(touched, version)
            if parts:
                folded = self._fold_parts(parts, log)
            else:
                rows = table.read(only=touched, version=version)
                folded = fold_updates(rows, log, "seq", upsert=False, small=small)
            kept = self.counts.last()
            rows = folded if parts else self.layout(folded)
            new = table.publish(rows, upto, only=touched, read_from=version, aligned=bool(parts))
            if kept is not None and kept[1] == version:
                # What was folded is not folded again: the touched parts are counted as they were and as they are.
                was, now = (available_by_code(table.read("addcd", "stat", only=touched, version=v)) for v in (version, new))
                changes = now.unionByName(was.withColumn("n", -F.col("n")))
                counted = shifted_counts(self.counts.read(version=kept[0]), changes)
                with contextlib.suppress(PublishConflict):
                    self.counts.publish(counted, new, read_from=kept[0])
            self.log.prune(done)  # readers of the version before may still fold the rest
        else:
            folded = fold_updates(table.read(version=version), log, "seq", upsert=True)
            table.publish(folded, upto, read_from=version)

    def available_codes(self, upto: int | None = None) -> DataFrame:
        """(addcd, n): available chargers by code, for a snapshot that has addcd.

        The counts of the published snapshot are kept beside it. What the log moves is added: only the
        parts it touches are read, and only rows that become available or cease to be count. All chargers
        are counted the first time and after a rebuild.
        """
        table = self.tables[SNAPSHOT]
        version, done = table.last()
        kept = self.counts.last()
        if kept is None or kept[1] != version:
            everyone = table.read("addcd", "stat", version=version)
            with contextlib.suppress(PublishConflict):  # another reader counted as well
                self.counts.publish(available_by_code(everyone), version, read_from=kept[0] if kept else 0)
        upto = self._mark() if upto is None else upto
        log, small = self.log.read(done, upto), self._small(done, upto)
        touched = [r[0] for r in log.select(table.part_of()).distinct().collect()]
        counts = self.counts.read()
        if not touched:
            return counts
        rows = table.read(*KEYS, "addcd", *STATUS_COLUMNS, only=touched, version=version)
        folded = fold_updates(rows.withColumn("was", F.col("stat")), log, "seq", upsert=False, small=small)
        return shifted_counts(counts, availability_changes(folded))

    def begin_rebuild(self) -> None:
        """Clear the buffer and let readers of the snapshot stop here."""
        mark = self.log.last()
        self.tables[BUFFER].publish(self.spark.createDataFrame([], STATUS), mark)
        self.set_control(ck=0, mark=mark)

    def finish_rebuild(
        self, rebuilt: DataFrame, started: float | None = None, newer_only: bool = False
    ) -> None:
        """Publish the rebuilt snapshot with the buffer replayed, then send readers to it.

        PublishConflict if someone else publishes the snapshot meanwhile; it is still being rebuilt then.
        """
        upto = self.log.last()
        snapshot, buffer = self.tables[SNAPSHOT], self.tables[BUFFER]
        done = snapshot.last()
        version, cleared = buffer.last()
        held = fold_updates(buffer.read(version=version), self.log.read(cleared, upto), "seq", upsert=True)
        final = replay_buffer(rebuilt, held, newer_only)
        snapshot.publish(self.layout(final), upto, read_from=done[0] if done else 0)
        self.set_control(ck=1, at=started)
        if done is not None:
            self.log.prune(done[1])


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint; a new checkpoint has a new one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def run_feed(
    store: StatusStore, feed: DataFrame, checkpoint: str, at: float | None = None
) -> StreamingQuery:
    """Merge all landed files and stop; the checkpoint remembers what has been read."""

    def merge(rows: DataFrame, batch: int) -> None:
        store.merge_batch(rows, batch, run_of(store.spark, checkpoint), at)

    return (
        feed.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: How long the state store remembers rows, as a first sieve before the log.
REMEMBERED = "10 minutes"


def _day(column: str = "statupddt") -> Column:
    return F.coalesce(F.date_format(column, "yyyy-MM-dd"), F.lit("none"))


def overlap_log(spark: SparkSession, path: str) -> DeltaLog:
    """Where run_without_overlap writes; its `read` gives the rows of all runs, each once."""
    return DeltaLog(spark, path, STATUS)


def run_without_overlap(feed: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of a feed that are not there yet, however late they come.

    Consecutive reads overlap, so rows come again. Spark's state store drops equal ones that come
    within minutes; it goes by the time of arrival, so no row is too late for it. The others are compared with what
    the log has for the days of the batch, by charger and time; of rows of one
    batch that agree in these the one with the highest status values is taken. The log gives each batch its
    number, so streams with other checkpoints, one after the other or at once, add to
    the same rows: who comes second compares again.
    """
    spark, keys = feed.sparkSession, [*KEYS, "statupddt"]
    log = overlap_log(spark, path)
    newest = F.max(F.struct("stat", "lasttedt", "nowtsdt")).alias("_row")

    def write(rows: DataFrame, batch: int) -> None:
        run = run_of(spark, checkpoint)
        once = rows.groupBy(*keys).agg(newest)
        once = once.select(*KEYS, "_row.stat", "statupddt", "_row.lasttedt", "_row.nowtsdt").persist()
        days = [r[0] for r in once.select(_day()).distinct().collect()]
        try:
            for _ in range(ATTEMPTS):
                upto = log.last()
                known = log.read(upto=upto, where=lambda e: bool(set(days).intersection(e["days"])))
                before = known.filter(_day().isin(days))
                same = [once[k].eqNullSafe(before[k]) for k in keys]
                with contextlib.suppress(PublishConflict):
                    log.add(once.join(before, same, "left_anti"), run, batch, expect=upto, days=days)
                    return
            raise PublishConflict(path)
        finally:
            once.unpersist()

    arrived = feed.select(*STATUS.names).withColumn("_arrived", F.current_timestamp())
    fresh = arrived.withWatermark("_arrived", REMEMBERED).dropDuplicatesWithinWatermark(STATUS.names)
    return (
        fresh.drop("_arrived")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_state(feed: DataFrame) -> DataFrame:
    """Newest status of each charger, held as streaming state; equal times take the higher stat.

    The newest of newest rows is the newest, so applied to what streams have written it gives the state
    of all of them.
    """
    newest = F.max(F.struct("statupddt", "stat", "lasttedt", "nowtsdt")).alias("_new")
    state = feed.groupBy(*KEYS).agg(newest)
    return state.select(*KEYS, *[F.col(f"_new.{c}").alias(c) for c in STATUS_COLUMNS])


def run_to_log(rows: DataFrame, log: DeltaLog, checkpoint: str, mode: str) -> StreamingQuery:
    """Write each micro-batch as a delta; a repeated one is known by its run and number."""

    def write(batch_rows: DataFrame, batch: int) -> None:
        log.add(batch_rows, run_of(log.spark, checkpoint), batch)

    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
