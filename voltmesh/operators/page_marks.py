"""Pages behind a cursor by a sparse directory of marks, so that a page does not rank all that follows.

Rows are written in stretches of SIZE numbers of a key (a station, a review), in folders by a
hash of the stretch, with a mark for each: its lowest and highest number. The directory is a
SIZE-th of the rows. A page looks up the marks next behind its cursor and reads their
stretches alone, two of each run for a page that is shorter than a stretch. Each append is a run with
marks of its own, whatever its numbers; `merge` makes one run of all. Readers go by a ledger, so they see an
append or a merge whole or not at all, and of two writers at once both are kept.

Numbers are unique within a key. A row without a number is on no page and is not written. What is
deleted goes with the next `rewrite`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import workspace
from ..sinks.ledger import Ledger, PublishConflict, remove
from .reviews import NUMBERS_PER_SLICE, PAGE, numbers_after
from .skew import join_apart, ranked

#: Numbers of a stretch.
SIZE = 512
#: Folders that the stretches of a run are dealt to.
BUCKETS = 64
#: Stretches that a scan is told by name; for more it is told the folders' join alone.
FEW = 1_000
# Attempts of a writer whom others come before.
ATTEMPTS = 10


class PageMarks:
    def __init__(self, spark: SparkSession, root: str, columns: T.StructType, keys: Sequence[str] = ("stid",)):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.names = columns.names
        kinds = [columns[k] for k in self.keys]
        long = lambda name: T.StructField(name, T.LongType())
        run, bucket = T.StructField("run", T.StringType()), T.StructField("bucket", T.IntegerType())
        self._rows = T.StructType([*columns.fields, long("stretch"), run, bucket])
        self._marks = T.StructType([*kinds, long("stretch"), long("low"), long("high"), run])
        self.ledger = Ledger(spark, f"{self.root}/ledger")

    # --- writing -----------------------------------------------------------

    def append(self, rows: DataFrame) -> None:
        """Add rows with numbers of their own."""
        run = self._write(rows)
        self._enter(lambda runs: [*runs, run])

    def rewrite(self, change: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """One run of what `change` makes of all rows; PublishConflict if others were added meanwhile."""
        number, runs = self._last()
        run = self._write(change(self._read("rows", self._rows, runs).select(*self.names)))
        self._enter(lambda _: [run], number)

    def merge(self) -> None:
        """One run of those that are there; what is appended meanwhile stays beside it."""
        runs = self.runs()
        if len(runs) > 1:
            run = self._write(self._read("rows", self._rows, runs).select(*self.names))
            self._enter(lambda now: [run, *[r for r in now if r not in runs]] if set(runs) <= set(now) else None)

    def prune(self) -> None:
        """Delete the files of runs that neither the newest entry nor the one before it names."""
        listed = [e["runs"] for _, e in sorted(self.ledger.entries().items())]
        needed = {r for runs in listed[-2:] for r in runs}
        for run in {r for runs in listed for r in runs} - needed:
            for kind in ("rows", "marks"):
                remove(self.spark, f"{self.root}/{kind}/run={run}")

    def _write(self, rows: DataFrame) -> str:
        run = f"r{uuid.uuid4().hex}"
        numbered = ranked(
            rows.select(*self.names).filter("no is not null"),
            self.keys,
            F.floor(F.col("no") / NUMBERS_PER_SLICE),
            [F.col("no").asc()],
        )
        placed = numbered.withColumn("stretch", F.floor((F.col("rank") - 1) / SIZE)).drop("rank")
        dealt = placed.withColumn("bucket", self._bucket()).repartition("bucket")
        order = ["bucket", *self.keys, "stretch", "no"]
        dealt.sortWithinPartitions(*order).write.partitionBy("bucket").parquet(f"{self.root}/rows/run={run}")
        marks = self._read("rows", self._rows, [run]).groupBy(*self.keys, "stretch").agg(
            F.min("no").cast("bigint").alias("low"), F.max("no").cast("bigint").alias("high")
        )
        marks.write.parquet(f"{self.root}/marks/run={run}")
        return run

    def _enter(self, change: Callable[[list[str]], list[str] | None], expect: int | None = None) -> None:
        for _ in range(ATTEMPTS):
            number, runs = self._last()
            after = change(runs)
            if after is None or expect not in (None, number):
                break
            try:
                self.ledger.add(number + 1, {"runs": after})
                return
            except PublishConflict:
                continue
        raise PublishConflict(self.root)

    # --- reading -----------------------------------------------------------

    def _last(self) -> tuple[int, list[str]]:
        entries = self.ledger.entries()
        number = max(entries, default=0)
        return number, entries[number]["runs"] if entries else []

    def runs(self) -> list[str]:
        return self._last()[1]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys, "stretch"), F.lit(BUCKETS)).cast("int")

    def _read(self, kind: str, columns: T.StructType, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], columns)
        reader = self.spark.read.schema(columns).option("basePath", f"{self.root}/{kind}")
        return reader.parquet(*[f"{self.root}/{kind}/run={run}" for run in runs])

    def stretches(self, cursors: DataFrame, limit: int = PAGE, newest_first: bool = True) -> DataFrame:
        """(run, bucket, keys, stretch) that hold the page behind each cursor (keys, last)."""
        runs = self.runs()
        marks = self._read("marks", self._marks, runs)
        # The next mark may lie in a stretch that the cursor is in; those behind it are full but for the last.
        edges = marks.withColumn("no", F.col("low" if newest_first else "high"))
        asked = cursors.select(*self.keys, "last").distinct()
        asked = asked.withColumn("run", F.explode(F.array(*[F.lit(r) for r in runs]).cast("array<string>")))
        near = numbers_after(
            asked, edges.select("run", *self.keys, "no"), ["run", *self.keys], newest_first, 1 - (-limit // SIZE)
        )
        reached = near.select("run", *self.keys, "no").distinct()
        found = edges.join(reached, ["run", *self.keys, "no"]).withColumn("bucket", self._bucket())
        return found.select("run", "bucket", *self.keys, "stretch")

    def candidates(self, cursors: DataFrame, limit: int = PAGE, newest_first: bool = True) -> DataFrame:
        """The rows of these stretches, each once."""
        found = self.stretches(cursors, limit, newest_first)
        path = workspace(self.spark, "stretches")
        found.write.parquet(path)
        wanted = self.spark.read.schema(found.schema).parquet(path)
        rows = self._read("rows", self._rows, self.runs())
        named = wanted.limit(FEW + 1).collect()
        if len(named) <= FEW:
            for column in ("bucket", "run", *self.keys, "stretch"):
                rows = rows.filter(F.col(column).isin(sorted({r[column] for r in named})))
        return join_apart(rows, wanted, ["run", "bucket", *self.keys, "stretch"], "left_semi").select(*self.names)

    def page(self, cursors: DataFrame, limit: int = PAGE, newest_first: bool = True) -> DataFrame:
        """The next rows behind each cursor (keys, last), with last and pos, from 1, beside their columns."""
        rows = self.candidates(cursors, limit, newest_first)
        found = numbers_after(cursors.select(*self.keys, "last").distinct(), rows, self.keys, newest_first, limit)
        return found.join(rows, [*self.keys, "no"]).select("last", "pos", *self.names)
