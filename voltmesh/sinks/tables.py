"""Published versions of a table, and a log of deltas beside it.

A version is written whole to a folder with a name of its own and then entered in
the ledger; readers take the last entry, so they never see a gap or a part of
a write. An entry is made by one atomic create, under the number behind the version that its writer
went by: of two writers that publish at once, or of one that publishes what it read
before another published, the second fails, and nothing that was published is lost.

A table may be kept in parts by a hash of its key. A version then lists the folder of
each part, and a new one writes the parts that changed and takes over the others. The files of a
part may be buckets by key as well: `aligned_parts` then reads them so that a join on the key takes the
rows where they lie, however long the other side is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .ledger import KEEP_ENTRIES, Ledger, PublishConflict, file_system, remove

# Rows per file of a chunked write.
ROWS_PER_FILE = 1_000_000
# Versions whose files stay; a reader has the time of one more to finish.
KEEP_VERSIONS = 2
# Attempts of a writer that can go by newer versions.
ATTEMPTS = 10

# The part whose folder has no rows, only the columns.
_COLUMNS = -1


class VersionedTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        parts: int = 1,
        key: str | None = None,
        buckets: int = 0,
        by: Sequence[str] = (),
    ):
        """`buckets` cuts every part by a hash of the columns `by`, in the same way; 0 for none. It is
        the number of tasks that a join with an aligned part has."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.parts = parts
        self.key = key
        self.buckets = buckets
        self.by = list(by)
        self.ledger = Ledger(spark, f"{self.root}/versions")
        self._gone: set[str] = set()

    def _version(self, number: int | None = None) -> tuple[int, dict] | None:
        """(number, entry) of a version, the newest if none is given."""
        entries = self.ledger.entries()
        if not entries:
            return None
        number = max(entries) if number is None else number
        return number, entries[number]

    def folders(self, number: int | None = None) -> dict[int, str]:
        """The folder of each part of a version, from the table's own."""
        found = self._version(number)
        return {int(p): f for p, f in found[1]["folders"].items()} if found else {}

    def last(self) -> tuple[int, int] | None:
        """(version, upto) of the newest version, None before the first."""
        found = self._version()
        return (found[0], found[1]["upto"]) if found else None

    def part_of(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def _sources(self, rows: DataFrame) -> set[str]:
        """The table's own folders that rows are read from."""
        own = f"{file_system(self.spark, self.root)[1].toUri().getPath()}/data/"
        paths = [unquote(urlparse(f).path) for f in rows.inputFiles()]
        return {p[len(own) :].split("/")[0] for p in paths if p.startswith(own)}

    def publish(
        self,
        rows: DataFrame,
        upto: int = -1,
        max_rows_per_file: int = 0,
        only: Iterable[int] | None = None,
        read_from: int | None = None,
        aligned: bool = False,
    ) -> int:
        """Write the next version and drop those before the last KEEP_VERSIONS.

        `upto` is the last log entry it holds; `only` names the parts that the rows belong to,
        the others stay as they are. `read_from` is the version that the rows follow from: if it is no
        longer the newest, nothing is published. Rows that are read from the table itself are
        held to that without it; others replace whatever is there. `aligned` says that the rows come
        from aligned parts and lie by bucket already.
        """
        before = self._version()
        newest = before[0] if before else 0
        if read_from is not None and read_from != newest:
            raise PublishConflict(f"{self.root}: version {newest} came after {read_from}")
        held = self.folders(newest) if before else {}
        stale = self._sources(rows) - {f.split("/")[1] for f in held.values()}
        if stale:
            raise PublishConflict(f"{self.root}: rows of a version before {newest}")
        folder = f"data/{uuid.uuid4().hex}{self._suffix()}"
        found = dict(held) if only is not None else {}
        for part in only or ():
            found.pop(part, None)
        if only is None:
            rows.limit(0).write.parquet(f"{self.root}/{folder}-columns")
            found[_COLUMNS] = f"{folder}-columns"
        if self.parts == 1:
            rows.write.option("maxRecordsPerFile", max_rows_per_file).parquet(f"{self.root}/{folder}")
            found[0] = folder
        else:
            cut = rows.withColumn("_part", self.part_of())
            if self.buckets and not aligned:
                cut = cut.repartition(self.buckets, *self.by)
            writer = cut.write.partitionBy("_part").option("maxRecordsPerFile", max_rows_per_file)
            if self.buckets:
                name = f"voltmesh_{uuid.uuid4().hex}"
                to = writer.bucketBy(self.buckets, *self.by).option("path", f"{self.root}/{folder}")
                to.saveAsTable(name)
                self.spark.sql(f"DROP TABLE {name}")  # the name only; the files stay
            else:
                writer.parquet(f"{self.root}/{folder}")
            files, target = file_system(self.spark, f"{self.root}/{folder}")
            names = [f.getPath().getName() for f in files.listStatus(target)]
            written = [int(n.split("=")[1]) for n in names if n.startswith("_part=")]
            found |= {part: f"{folder}/_part={part}" for part in written}
        entry = {"upto": upto, "folders": {str(p): f for p, f in sorted(found.items())}}
        try:
            self.ledger.add(newest + 1, entry)
        except PublishConflict:
            for name in (folder, f"{folder}-columns"):
                remove(self.spark, f"{self.root}/{name}")
            raise
        self.prune()
        return newest + 1

    def update(self, change: Callable[[DataFrame], DataFrame], upto: int | None = None) -> int:
        """Publish what `change` makes of the newest version, again if another writer comes first."""
        for _ in range(ATTEMPTS):
            version, before = self.last()
            rows = change(self.read(version=version))
            try:
                return self.publish(rows, before if upto is None else upto, read_from=version)
            except PublishConflict:
                continue
        raise PublishConflict(self.root)

    def read(self, *columns: str, only: Iterable[int] | None = None, version: int | None = None) -> DataFrame:
        folders = self.folders(version)
        if not folders:
            raise FileNotFoundError(f"nothing published under {self.root}")
        columns_at = folders.get(_COLUMNS) or next(iter(folders.values()))
        layout = self.spark.read.parquet(f"{self.root}/{columns_at}").schema
        wanted = None if only is None else {_COLUMNS, *only}
        taken = [f"{self.root}/{f}" for part, f in folders.items() if wanted is None or part in wanted]
        table = self.spark.read.schema(layout).parquet(*taken)
        return table.select(*columns) if columns else table

    def _suffix(self) -> str:
        """What the folders of writes in buckets end with, so that others are told apart."""
        return f"-b{self.buckets}" if self.buckets and self.parts > 1 else ""

    def aligned_parts(self, only: Iterable[int] | None = None, version: int | None = None) -> list[tuple[int, DataFrame]]:
        """The parts of a version, each laid out by its buckets; none if some were not written in them.

        Join each part with its own rows of the other side: a union of the parts would hide their layout.
        """
        folders = self.folders(version)
        wanted = None if only is None else set(only)
        taken = {p: f for p, f in folders.items() if p != _COLUMNS and (wanted is None or p in wanted)}
        suffix = self._suffix()
        if not suffix or not all(f.split("/")[1].endswith(suffix) for f in taken.values()):
            return []
        layout = self.read(version=version, only=()).schema
        quoted = lambda name: "`" + name.replace("`", "``") + "`"
        kinds = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in layout.fields)
        by = ", ".join(quoted(name) for name in self.by)
        parts = []
        for part, folder in sorted(taken.items()):
            name = f"voltmesh_{uuid.uuid4().hex}"
            place = f"{self.root}/{folder}".replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({kinds}) USING parquet CLUSTERED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
            )
            parts.append((part, self.spark.table(name)))
            self.spark.sql(f"DROP TABLE {name}")
        return parts

    def ensure(self, rows: DataFrame) -> bool:
        """Publish the rows if the table does not exist yet."""
        if self.last() is not None:
            return False
        try:
            self.publish(rows, read_from=0)
        except PublishConflict:
            return False
        return True

    def prune(self, keep: int = KEEP_VERSIONS) -> None:
        """Delete the files that only versions before the last `keep` have."""
        entries = self.ledger.entries()
        order = sorted(entries)
        needed = {f for n in order[-keep:] for f in entries[n]["folders"].values()}
        old = {f for n in order[:-keep] for f in entries[n]["folders"].values()} - needed
        used = {f.split("/")[1] for f in needed}  # a write without a part in use goes whole
        old = {f if f.split("/")[1] in used else f"data/{f.split('/')[1]}" for f in old}
        for folder in old - self._gone:
            remove(self.spark, f"{self.root}/{folder}")
        self._gone = old
        for number in order[:-KEEP_ENTRIES]:
            self.ledger.remove(number)


class DeltaLog:
    """Deltas in the order they were added, each under a number the log gives it.

    A delta is known by its run (the stream that writes it) and the batch within the
    run, so a repeated one is not added again, and a stream that begins anew goes on
    behind the deltas of the one before. Readers see a delta when it is in the ledger; its rows
    lie in a folder of their own.
    """

    def __init__(self, spark: SparkSession, root: str, columns: T.StructType):
        self.spark = spark
        self.root = root.rstrip("/")
        self.names = columns.names
        self.columns = T.StructType([*columns.fields, T.StructField("seq", T.LongType())])
        self._stored = T.StructType([*columns.fields, T.StructField("part", T.StringType())])
        self.ledger = Ledger(spark, f"{self.root}/ledger")
        self._gone: set[str] = set()

    def last(self) -> int:
        return max(self.ledger.numbers(), default=-1)

    def number_of(self, run: str, batch: int) -> int | None:
        entries = self.ledger.entries()
        return next((n for n, e in entries.items() if (e["run"], e["batch"]) == (run, batch)), None)

    def add(self, rows: DataFrame, run: str, batch: int, expect: int | None = None, **notes) -> int:
        """The number of the delta, which is written before its entry.

        With `expect`, the last number that the rows take account of, a delta that came after
        it is a PublishConflict; without, the next free number is taken. `notes` go into the entry.
        """
        known = self.number_of(run, batch)
        if known is not None:
            return known
        name = uuid.uuid4().hex
        path = f"{self.root}/deltas/part={name}"
        rows.select(*self.names).write.parquet(path)
        files, target = file_system(self.spark, path)
        notes["bytes"] = files.getContentSummary(target).getLength()
        for _ in range(ATTEMPTS):
            seq = self.last() + 1 if expect is None else expect + 1
            try:
                self.ledger.add(seq, {"run": run, "batch": batch, "part": name, **notes})
                return seq
            except PublishConflict:
                known = self.number_of(run, batch)  # the same batch, from an attempt thought lost
                if known is not None or expect is not None:
                    break
        remove(self.spark, path)
        if known is None:
            raise PublishConflict(path)
        return known

    def size(self, after: int = -1, upto: int | None = None) -> int:
        """Bytes of the files that `read` would read, from the ledger."""
        entries = self.ledger.entries().items()
        return sum(e["bytes"] for n, e in entries if n > after and (upto is None or n <= upto))

    def read(
        self, after: int = -1, upto: int | None = None, where: Callable[[dict], bool] = lambda entry: True
    ) -> DataFrame:
        """Deltas with a number over `after` (and at most `upto`), with their number as seq."""
        wanted = {
            e["part"]: n
            for n, e in self.ledger.entries().items()
            if n > after and (upto is None or n <= upto) and where(e)
        }
        if not wanted:
            return self.spark.createDataFrame([], self.columns)
        reader = self.spark.read.schema(self._stored).option("basePath", f"{self.root}/deltas")
        rows = reader.parquet(*[f"{self.root}/deltas/part={name}" for name in wanted])
        numbers = F.create_map(*[F.lit(v).cast(k) for pair in wanted.items() for v, k in zip(pair, ("string", "bigint"))])
        return rows.select(*self.names, numbers[F.col("part")].alias("seq"))

    def prune(self, upto: int) -> None:
        """Delete deltas up to a number that a published version holds.

        The last entry of a run stays in the ledger, so that its batch is known if it comes again.
        """
        entries = self.ledger.entries()
        latest = {e["run"]: n for n, e in sorted(entries.items())}
        old = {e["part"] for n, e in entries.items() if n <= upto}
        for part in old - self._gone:
            remove(self.spark, f"{self.root}/deltas/part={part}")
        self._gone = old
        for number in sorted(entries)[:-KEEP_ENTRIES]:
            if number <= upto and number != latest[entries[number]["run"]]:
                self.ledger.remove(number)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
