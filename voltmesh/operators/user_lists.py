"""Lists users keep, folded from a log of commands for all users at once.

A command is (user_id, op, item, ts, event_id) with op add, remove or removeall;
(ts, event_id) is its place in the log. Results are one row per list entry with
its place in the list; stored_lists puts together the text of asked users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.lists import dump_items
from .skew import join_apart, ranked, sliced

PAIR = ["user_id", "item"]
FLAGS = 6


def _at() -> Column:
    return F.struct("ts", "event_id")


def _when(op: str, value: Column) -> Column:
    return F.max(F.when(F.col("op") == op, value))


def _held(commands: DataFrame, attributes: tuple[str, ...] = ()) -> DataFrame:
    """(user, item, last add, boundary) of the items still in the list.

    The boundary is the user's last removeall or the item's last remove,
    whichever is later, null when there is none.
    """
    per_item = (
        commands.filter(F.col("op") != "removeall")
        .groupBy(*PAIR)
        .agg(
            _when("add", F.struct("ts", "event_id", *attributes)).alias("_add"),
            _when("remove", _at()).alias("_gone"),
        )
        .filter(F.col("_add").isNotNull())
    )
    removals = commands.filter(F.col("op") == "removeall")
    clears = removals.groupBy("user_id").agg(F.max(_at()).alias("_clear"))
    joined = join_apart(per_item, clears, ["user_id"], "left")
    limit = F.greatest("_gone", "_clear")
    last = F.struct(F.col("_add.ts").alias("ts"), F.col("_add.event_id").alias("event_id"))
    held = joined.withColumn("_limit", limit).filter(F.col("_limit").isNull() | (last > F.col("_limit")))
    return held.select(*PAIR, "_add", "_limit")


def _placed(entries: DataFrame, newest_first: bool) -> DataFrame:
    order = [F.col("ts"), F.col("event_id")]
    if newest_first:
        order = [c.desc() for c in order]
    rows = sliced(entries, ["user_id"], order)
    return ranked(rows, ["user_id"], F.col("_cut"), order, "pos").drop("_cut")


def bookmark_entries(commands: DataFrame, *attributes: str) -> DataFrame:
    """Items in the list with the add that put them there, and its attributes; a repeated
    add changes nothing."""
    held = _held(commands).select(*PAIR, "_limit")
    adds = commands.filter(F.col("op") == "add").select(*PAIR, "ts", "event_id", *attributes)
    after = F.col("_limit").isNull() | (_at() > F.col("_limit"))
    live = join_apart(adds, held, PAIR).filter(after)
    first = live.groupBy(*PAIR).agg(F.min(F.struct("ts", "event_id", *attributes)).alias("_since"))
    return first.select(
        *PAIR, *[F.col(f"_since.{c}").alias(c) for c in ("ts", "event_id", *attributes)]
    )


def bookmark_state(commands: DataFrame, *attributes: str) -> DataFrame:
    """Bookmarks, oldest first."""
    return _placed(bookmark_entries(commands, *attributes), newest_first=False)


def recent_search_entries(commands: DataFrame, *attributes: str) -> DataFrame:
    """Items in the list with their last add and its attributes."""
    held = _held(commands, attributes)
    return held.select(
        *PAIR, "_add.ts", "_add.event_id", *[F.col(f"_add.{a}").alias(a) for a in attributes]
    )


def recent_search_state(commands: DataFrame, *attributes: str) -> DataFrame:
    """Recent searches; a repeated add moves the item to the front."""
    return _placed(recent_search_entries(commands, *attributes), newest_first=True)


def filter_entries(commands: DataFrame) -> DataFrame:
    """Adds that survive: each remove drops the oldest copy of its item, if there is one."""
    return merge_filters(None, commands).select(*PAIR, "ts", "event_id")


def _numbered_adds(commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The adds, numbered within their item, and a summary of each item's commands.

    A summary is (removes left over, adds left over, adds). Of two stretches of a log that follow each
    other, the second's left-over removes take from the first's left-over adds, so summaries are put
    together in any grouping: sums run inside slices of a bounded number of rows, the slices' totals
    give the item's.
    """
    asked = commands.filter(F.col("op").isin("add", "remove"))
    log = sliced(asked, PAIR, [F.col("ts"), F.col("event_id")], "_slice").withColumns(
        {
            "_step": F.when(F.col("op") == "add", 1).otherwise(-1).cast("bigint"),
            "_one": (F.col("op") == "add").cast("bigint"),
        }
    )
    inside = (
        Window.partitionBy(*PAIR, "_slice")
        .orderBy("ts", "event_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    stepped = log.repartition(*PAIR, "_slice").withColumns(
        {"_level": F.sum("_step").over(inside), "_nth": F.sum("_one").over(inside)}
    )
    slices = stepped.groupBy(*PAIR, "_slice").agg(
        F.sum("_step").alias("_sum"), F.sum("_one").alias("_adds"), F.min("_level").alias("_low")
    )
    before = Window.partitionBy(*PAIR).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumns(
        {
            "_from": F.coalesce(F.sum("_adds").over(before), F.lit(0)),
            "_dip": F.coalesce(F.sum("_sum").over(before), F.lit(0)) + F.col("_low"),
        }
    )
    adds = stepped.filter(F.col("op") == "add").join(starts.select(*PAIR, "_slice", "_from"), [*PAIR, "_slice"])
    dip = F.least(F.lit(0), F.min("_dip"))
    summaries = starts.groupBy(*PAIR).agg(
        (-dip).alias("_removes"), (F.sum("_sum") - dip).alias("_left"), F.sum("_adds").alias("_adds")
    )
    return adds.select(*PAIR, "ts", "event_id", (F.col("_from") + F.col("_nth")).alias("nth")), summaries


def merge_filters(held: DataFrame | None, commands: DataFrame) -> DataFrame:
    """Entries (user, item, ts, event_id, nth) after later commands; nth counts an item's adds.

    An item's entries are its last adds in a row, so the first and the last number say how many it has. The survivors
    are the last ones of the entries and the new adds together; their number follows from the summary.
    """
    adds, summaries = _numbered_adds(commands)
    if held is None:
        total = F.col("_adds") - F.col("_left")
        live = join_apart(adds, summaries, PAIR).filter(F.col("nth") > total)
        return live.select(*PAIR, "ts", "event_id", "nth")
    known = held.groupBy(*PAIR).agg(F.max("nth").alias("_last"), F.count("*").alias("_held"))
    joined = join_apart(summaries, known, PAIR, "left").withColumns(
        {c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("_last", "_held")}
    )
    depth = F.col("_left") + F.greatest(F.lit(0).cast("bigint"), F.col("_held") - F.col("_removes"))
    limits = joined.select(*PAIR, "_last", (F.col("_last") + F.col("_adds") - depth).alias("_gone"))
    old = join_apart(held, limits, PAIR, "left").filter(F.col("_gone").isNull() | (F.col("nth") > F.col("_gone")))
    moved = join_apart(adds, limits, PAIR).withColumn("nth", F.col("_last") + F.col("nth"))
    new = moved.filter(F.col("nth") > F.col("_gone"))
    columns = [*PAIR, "ts", "event_id", "nth"]
    return old.select(*columns).unionByName(new.select(*columns))


def filter_state(commands: DataFrame) -> DataFrame:
    """Chosen filters in the order they were added; an item may stand there twice."""
    return _placed(filter_entries(commands), newest_first=False)


def flag_entries(commands: DataFrame) -> DataFrame:
    """The last command (op, ts, event_id) of each user and flag; entries are commands again."""
    touched = commands.filter(F.col("op").isin("add", "remove"))
    last = F.max(F.struct("ts", "event_id", "op")).alias("_last")
    found = touched.groupBy("user_id", "idx").agg(last)
    return found.select("user_id", "idx", "_last.op", "_last.ts", "_last.event_id")


def merge_flags(held: DataFrame, commands: DataFrame) -> DataFrame:
    """Entries after more commands, also if some come late."""
    return flag_entries(held.unionByName(commands.select(*held.columns)))


def flag_state(commands: DataFrame) -> DataFrame:
    """Six 0/1 flags per user as list text; `idx` is the flag a command sets or clears."""
    touched = commands.filter(F.col("op").isin("add", "remove"))
    value = F.struct("ts", "event_id", (F.col("op") == "add").cast("int").alias("v"))
    last = [F.max(F.when(F.col("idx") == i, value)).alias(f"_f{i}") for i in range(FLAGS)]
    text = F.array_join(
        F.array(*[F.coalesce(F.col(f"_f{i}.v"), F.lit(0)).cast("string") for i in range(FLAGS)]),
        ", ",
    )
    return (
        touched.groupBy("user_id")
        .agg(*last)
        .select("user_id", F.concat(F.lit("["), text, F.lit("]")).alias("flags"))
    )


def flags_or_zero(users: DataFrame, flags: DataFrame) -> DataFrame:
    """A user who never set a flag has six zeros."""
    zeros = "[" + ", ".join(["0"] * FLAGS) + "]"
    return users.join(flags, "user_id", "left").withColumn(
        "flags", F.coalesce("flags", F.lit(zeros))
    )


def entry_text(*fields: Column) -> Column:
    """One entry as it is stored: a JSON array of its fields."""
    return dump_items(F.array(*[f.cast("string") for f in fields]))


def stored_lists(placed: DataFrame, commands: DataFrame, asked: DataFrame) -> DataFrame:
    """(user_id, items): the stored text of the asked users' lists, from user_id, pos and entry.

    A user whose list was cleared has empty text, one who never gave a command no row. For
    the users of requests: a list becomes one value here, and entries are rows elsewhere.
    """
    wanted = asked.select("user_id").distinct()
    known = commands.join(wanted, "user_id", "left_semi").select("user_id").distinct()
    rows = placed.join(wanted, "user_id", "left_semi").groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "entry"))).alias("_rows")
    )
    texts = F.array_join(F.transform("_rows", lambda r: r["entry"]), ", ")
    text = F.when(F.col("_rows").isNull(), "").otherwise(F.concat(F.lit("["), texts, F.lit("]")))
    return known.join(rows, "user_id", "left").select("user_id", text.alias("items"))


def as_commands(entries: DataFrame) -> DataFrame:
    """List entries as the adds that put them there: the start for later commands."""
    return entries.withColumn("op", F.lit("add"))


def catalogue_choices(catalogue: DataFrame, chosen: DataFrame) -> DataFrame:
    """Catalogue rows each user has chosen, flag '1'; every other pair stands for '0'.

    `chosen` has the user columns and stid. The zeros are not written out: they
    would be users times catalogue.
    """
    return chosen.distinct().join(catalogue, "stid").withColumn("flag", F.lit("1"))


def catalogue_for(catalogue: DataFrame, chosen: DataFrame) -> DataFrame:
    """The whole catalogue with '1' or '0' for one caller's chosen ids (column stid)."""
    mark = chosen.select("stid").distinct().withColumn("flag", F.lit("1"))
    return catalogue.join(mark, "stid", "left").withColumn("flag", F.coalesce("flag", F.lit("0")))
