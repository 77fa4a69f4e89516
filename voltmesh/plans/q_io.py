"""Queries that read or write landed files and published tables, and the streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.fixed_values import NOTICE_BODY, NOTICE_SUBJECT
from ..functions.times import minute_number
from ..operators import merges, notices, regions, reviews, spatial, user_lists
from ..schemas import CHARGER_FEED, CHARGER_FEED_V1, KEYS, STATUS, STATUS_COLUMNS
from ..session import workspace
from ..sinks import tables as sinks
from ..sources import feeds, tables
from ..streaming import commands, status
from .bindings import Bindings
from .q_stations import MERGED, PREFIX, REPLAYED, upserted
from .q_users import FILTERS, FLAGS
from .registry import query

STATUS_ROWS = "select statid, chgerid, stat, statupddt, lasttedt, nowtsdt from "


def status_rows(b: Bindings) -> DataFrame:
    return b["fx_status"].select(*STATUS.names)


# --- sources ---------------------------------------------------------------


@query("select * exclude (addcd) from {fx_charger}")
def scan_station_xml(b):
    path = workspace(b.spark, "pages")
    feeds.write_pages(b["fx_charger"].select(*CHARGER_FEED.names), path)
    return feeds.read_pages(b.spark, path)


@query(
    """select * exclude (addcd, location, bnm, lasttsdt, lasttedt, nowtsdt),
        concat('P', cast(output as string)) as powertype from {fx_charger}"""
)
def scan_station_xml_older(b):
    """The feed as it was before, with one power column."""
    path = workspace(b.spark, "older")
    power = F.concat(F.lit("P"), F.col("output").cast("string"))
    rows = b["fx_charger"].withColumn("powertype", power)
    feeds.write_pages(rows.select(*CHARGER_FEED_V1.names), path)
    return feeds.read_pages(b.spark, path, CHARGER_FEED_V1)


@query(STATUS_ROWS + "{fx_status}")
def scan_status_xml(b):
    root = workspace(b.spark, "status")
    feeds.write_pages(status_rows(b), f"{root}/pages")
    rows = feeds.stream_pages(b.spark, f"{root}/pages")
    log = sinks.DeltaLog(b.spark, f"{root}/rows", STATUS)
    status.run_to_log(rows, log, f"{root}/checkpoint", "append").awaitTermination()
    return log.read().drop("seq")


@query("select bcode, arr, level, arrt from {fx_region} where cast(bcode as bigint) % 7 <> 0")
def scan_region_text(b):
    path = workspace(b.spark, "districts")
    b["fx_district"].write.option("sep", "\t").csv(path)
    return regions.region_rows(feeds.read_districts(b.spark, path))


@query("select o_orderkey, o_orderdate, o_totalprice from {orders}")
def scan_table(b):
    path = f"{b.folder}/orders.parquet"
    return tables.read_table(b.spark, path, "o_orderkey", "o_orderdate", "o_totalprice")


@query(
    """select 'priority=' || replace(replace(o_orderpriority, ' ', '_'), '-', '') as folder, 'parquet' as kind,
        true as has_content from {orders} group by all"""
)
def object_inventory(b):
    """Folders and kinds of the objects of a table that the query lands."""
    path = workspace(b.spark, "objects")
    plain = F.replace(F.replace("o_orderpriority", F.lit(" "), F.lit("_")), F.lit("-"), F.lit(""))
    b["orders"].withColumn("priority", plain).write.partitionBy("priority").parquet(path)
    found = tables.object_inventory(b.spark, path)
    folder, kind = F.substring_index("name", "/", 1), F.substring_index("name", ".", -1)
    return found.groupBy(folder.alias("folder"), kind.alias("kind")).agg(
        (F.min("length") > 0).alias("has_content")
    )


def _image(column: str, at: int, kind: str) -> str:
    return f"""select doc_id, cast({at} as int) as idx, '{at}.{kind}' as filename,
        from_base64({column}) as image from {{fx_image}} where dist >= {at}"""


@query(
    f"""select doc_id, idx, filename, octet_length(image) as n_bytes, md5(image) as digest from (
        {_image('first', 1, 'png')} union all {_image('second', 2, 'jpeg')}
        union all {_image('third', 3, 'gif')}) as i"""
)
def decode_attachments(b):
    images = notices.decode_attachments(b["fx_image"], "doc_id")
    size = F.octet_length("image").cast("bigint").alias("n_bytes")
    return images.select("doc_id", "idx", "filename", size, F.md5("image").alias("digest"))


_FILLED = (
    "replace(replace(replace('"
    + NOTICE_BODY.replace("%s", "\x01", 1).replace("%s", "\x02", 1).replace("%s", "\x03", 1)
    + "', '\x01', stid), '\x02', stnm), '\x03', context)"
)


@query(f"select emailto, stid, '{NOTICE_SUBJECT}' as subject, {_FILLED} as body from {{fx_report}}")
def render_notice(b):
    return notices.render_notices(b["fx_report"])


# --- sinks -----------------------------------------------------------------


@query("select * from {fx_charger}")
def replace_table(b):
    table = sinks.VersionedTable(b.spark, workspace(b.spark, "replace"))
    table.publish(spatial.by_place(b["fx_charger"]))
    return table.read()


@query("select statid, statnm, addr, lat, lng, addcd from {fx_station}")
def ctas_swap(b):
    root = workspace(b.spark, "swap")
    staging = sinks.VersionedTable(b.spark, f"{root}/staging")
    live = sinks.VersionedTable(b.spark, f"{root}/live")
    staging.publish(b["fx_station"].select("statid", "statnm", "addr", "lat", "lng", "addcd"))
    live.publish(staging.read().filter(F.col("addcd").isNotNull()))
    live.publish(staging.read())
    return live.read()


@query(
    STATUS_ROWS
    + """{fx_base} union all
    select statid, chgerid, stat, statupddt, lasttedt, nowtsdt from (
        select *, row_number() over (partition by statid, chgerid order by statupddt, event_id) as rn
        from {fx_status}) as s
    where rn = 1 and (statid, chgerid) not in (select (statid, chgerid) from {fx_base})"""
)
def insert_ignore(b):
    order = [F.col("statupddt"), F.col("event_id")]
    return merges.insert_ignore(b["fx_base"], b["fx_status"], KEYS, order)


@query("select * from {fx_review}")
def append_rows(b):
    path = workspace(b.spark, "reviews")
    for level in (reviews.REVIEW, reviews.REPLY):
        sinks.append(reviews.at_level(b["fx_review"], level), path)
    return b.spark.read.parquet(path)


@query(
    """select c.statid, c.chgerid, case when c.addcd is null then s.code else c.addcd end as addcd
    from {fx_charger} c join {fx_station} s on c.statid = s.statid"""
)
def chunked_update(b):
    """Every row of the update arrives, in files of a bounded number of rows."""
    missing = b["fx_station"].filter(F.col("addcd").isNull())
    found = missing.select("statid", F.col("code").alias("addcd"))
    chargers = b["fx_charger"].select("statid", "chgerid", "addcd")
    table = sinks.VersionedTable(b.spark, workspace(b.spark, "chunks"))
    updated = merges.keyed_update(chargers, found, ["statid"], ["addcd"])
    table.publish(updated, max_rows_per_file=sinks.ROWS_PER_FILE)
    return table.read()


@query(
    """select 1 as id, 1 as ck, floor(epoch(max(ts)) / 60) * 60 as time from {events}"""
)
def ensure_tables(b):
    """Control row seeded with the minute of the last event; asking again changes nothing."""
    newest = b["events"].agg((F.max(minute_number(F.col("ts"))) * 60).alias("t")).first()["t"]
    store = status.StatusStore(b.spark, workspace(b.spark, "control"))
    store.ensure_tables(float(newest))
    store.ensure_tables(0.0)
    return store.control_table.read()


# --- streams ---------------------------------------------------------------

WAVES = [("2024-01-04", "2024-01-08"), ("2024-01-08", "2100-01-01")]


def between(rows: DataFrame, first: str, end: str, column: str = "statupddt") -> DataFrame:
    time = F.col(column)
    return rows.filter((time >= F.lit(first).cast("timestamp_ntz")) & (time < F.lit(end).cast("timestamp_ntz")))


def _chain(first: str, second: str, last: str) -> str:
    """Merge of `second` into the result of `first`, read from there on as `last`."""
    return f"with {last} as ({first}) {second}"


@query(_chain(MERGED % ("{fx_base}", "{fx_buffer}"), MERGED % ("one", "{fx_delta}"), "one"))
def stream_merge_status(b):
    """Two waves of files through the minute feed onto a snapshot."""
    root = workspace(b.spark, "feed")
    store = status.StatusStore(b.spark, f"{root}/store")
    store.tables[status.SNAPSHOT].publish(b["fx_base"])
    store.ensure_tables(0.0)
    for number, (first, end) in enumerate(WAVES):
        feeds.write_pages(between(status_rows(b), first, end), f"{root}/pages/wave={number}")
        feed = feeds.stream_pages(b.spark, f"{root}/pages/wave=*")
        status.run_feed(store, feed, f"{root}/checkpoint").awaitTermination()
    return store.read()


@query(
    """select distinct statid, chgerid, stat, statupddt, lasttedt, nowtsdt from {fx_status}"""
)
def stream_dedup_overlap(b):
    """The second wave starts two minutes before the end of the first, and brings rows of the
    first wave's time that come late; a stream with a checkpoint of its own reads both again."""
    root = workspace(b.spark, "overlap")
    rows, cut = b["fx_status"], F.lit("2024-01-10").cast("timestamp_ntz")
    late = F.col("event_id") % 20 == 0
    again = F.col("statupddt") >= cut - F.make_dt_interval(mins=F.lit(2))
    waves = [rows.filter((F.col("statupddt") < cut) & ~late), rows.filter(again | late)]
    feed = lambda: b.spark.readStream.schema(STATUS).parquet(f"{root}/rows/wave=*")
    for number, wave in enumerate(waves):
        wave.select(*STATUS.names).write.parquet(f"{root}/rows/wave={number}")
        status.run_without_overlap(feed(), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    status.run_without_overlap(feed(), f"{root}/out", f"{root}/anew").awaitTermination()
    return status.overlap_log(b.spark, f"{root}/out").read().drop("seq")


@query(
    _chain(
        upserted("{fx_buffer}", "{fx_delta}"),
        REPLAYED % ("{fx_base}", "buffered"),
        "buffered",
    )
)
def rebuild_protocol(b):
    """Deltas that arrive during a rebuild are buffered and replayed onto the new snapshot."""
    store = status.StatusStore(b.spark, workspace(b.spark, "rebuild"))
    store.tables[status.SNAPSHOT].publish(b["fx_buffer"])
    store.ensure_tables(0.0)
    store.begin_rebuild()
    for batch, name in enumerate(["fx_buffer", "fx_delta"]):
        store.merge_batch(b[name], batch)
    store.finish_rebuild(b["fx_base"])
    return store.read()


@query(
    """select statid, chgerid, stat, statupddt, lasttedt, nowtsdt from (
        select *, row_number() over (
            partition by statid, chgerid order by statupddt desc, stat desc) as rn
        from {fx_status}) as s where rn = 1"""
)
def stream_latest_state(b):
    """Each wave through a stream with a checkpoint of its own; the newest of what they wrote."""
    root = workspace(b.spark, "latest")
    cut = "2024-01-08"
    log = sinks.DeltaLog(b.spark, f"{root}/out", STATUS)
    for number, (first, end) in enumerate([("2000-01-01", cut), (cut, "2100-01-01")]):
        between(status_rows(b), first, end).write.parquet(f"{root}/rows/wave={number}")
        feed = b.spark.readStream.schema(STATUS).parquet(f"{root}/rows/wave={number}")
        state = status.latest_state(feed).select(*STATUS.names)
        status.run_to_log(state, log, f"{root}/checkpoint{number}", "update").awaitTermination()
    return status.latest_state(log.read())


# What two minutes' feeds say of some chargers, and what all of them are afterwards.
FIRST_STAT, SECOND_STAT = "1 + (stat + chgerid) % 5", "case when stat = 2 then 3 else 2 end"
AFTER = f"""select * replace (case when output % 5 = 1 then {SECOND_STAT} else stat end as stat) from (
        select * replace (case when output % 3 = 0 then {FIRST_STAT} else stat end as stat) from {{fx_charger}}) as one"""


@query(
    f"""select r.bcode, r.arr, r.level, r.arrt, r.lat, r.lng, cast(coalesce(sum(c.n), 0) as bigint) as num
    from {{fx_region}} r left join (
        select addcd, count(*) as n from ({AFTER}) as two where stat = 2 group by addcd) c
    on starts_with(c.addcd, {PREFIX})
    group by all"""
)
def available_by_region_after(b):
    """Counts of a snapshot, moved by two waves: the first is published, the second still in the log."""
    columns = [*KEYS, "addcd", *STATUS_COLUMNS, "output"]
    store = status.StatusStore(b.spark, workspace(b.spark, "counted"))
    published = store.tables[status.SNAPSHOT].publish(b["fx_charger"].select(*columns))
    store.ensure_tables(0.0)
    store.available_codes()
    base = store.tables[status.SNAPSHOT].read(version=published)  # its files stay through one compaction
    first = base.filter("output % 3 = 0").withColumn("stat", F.expr(FIRST_STAT))
    store.merge_batch(first.select(*STATUS.names), 0)
    store.compact()
    one = base.withColumn("stat", F.when(F.col("output") % 3 == 0, F.expr(FIRST_STAT)).otherwise(F.col("stat")))
    second = one.filter("output % 5 = 1").withColumn("stat", F.expr(SECOND_STAT))
    store.merge_batch(second.select(*STATUS.names), 1)
    return regions.available_under(b["fx_region"], store.available_codes())


BOOKMARKS = """with c as (select *, row_number() over (order by ts, event_id) as s from {fx_command}),
    cleared as (select user_id, max(s) as s from c where op = 'removeall' group by user_id),
    gone as (select user_id, item, max(s) as s from c where op = 'remove' group by user_id, item)
    select c.user_id, c.item, min(c.ts) as ts, min(c.event_id) as event_id,
        arg_min(c.name, c.s) as name
    from c left join cleared x on c.user_id = x.user_id
    left join gone g on c.user_id = g.user_id and c.item = g.item
    where c.op = 'add' and c.s > coalesce(x.s, 0) and c.s > coalesce(g.s, 0)
    group by c.user_id, c.item"""


RECENT = """with c as (select *, row_number() over (order by ts, event_id) as s from {fx_command}),
    cleared as (select user_id, max(s) as s from c where op = 'removeall' group by user_id),
    gone as (select user_id, item, max(s) as s from c where op = 'remove' group by user_id, item)
    select c.user_id, c.item, max(c.ts) as ts, max(c.event_id) as event_id,
        arg_max(c.name, c.s) as name
    from c left join cleared x on c.user_id = x.user_id
    left join gone g on c.user_id = g.user_id and c.item = g.item
    where c.op = 'add' and c.s > coalesce(x.s, 0) and c.s > coalesce(g.s, 0)
    group by c.user_id, c.item"""


@query(RECENT.replace("max(c.event_id) as event_id", "arg_max(c.event_id, c.s) as event_id"))
def stream_recent_searches(b):
    """Recent searches from two waves of commands."""
    root = workspace(b.spark, "searches")
    fold = lambda log: user_lists.recent_search_entries(log, "name")
    store = commands.ListStore(b.spark, f"{root}/lists", fold)
    cut = "2024-01-15"
    for number, (first, end) in enumerate([("2000-01-01", cut), (cut, "2100-01-01")]):
        wave = between(b["fx_command"], first, end, "ts").select(*commands.COMMAND.names)
        wave.write.parquet(f"{root}/rows/wave={number}")
        feed = b.spark.readStream.schema(commands.COMMAND).parquet(f"{root}/rows/wave=*")
        commands.run_commands(store, feed, f"{root}/checkpoint").awaitTermination()
        store.compact()
    return store.read()


@query(BOOKMARKS.replace("min(c.event_id) as event_id", "arg_min(c.event_id, c.s) as event_id"))
def stream_user_state(b):
    """Bookmarks from two waves of commands, with the list published in between."""
    root = workspace(b.spark, "commands")
    fold = lambda log: user_lists.bookmark_entries(log, "name")
    store = commands.ListStore(b.spark, f"{root}/lists", fold)
    cut = "2024-01-10"
    for number, (first, end) in enumerate([("2000-01-01", cut), (cut, "2100-01-01")]):
        wave = between(b["fx_command"], first, end, "ts").select(*commands.COMMAND.names)
        wave.write.parquet(f"{root}/rows/wave={number}")
        feed = b.spark.readStream.schema(commands.COMMAND).parquet(f"{root}/rows/wave=*")
        commands.run_commands(store, feed, f"{root}/checkpoint").awaitTermination()
        if number == 0:
            store.compact()
    return store.read()


def _in_waves(b: Bindings, store: commands.ListStore, cuts: list[str], root: str) -> DataFrame:
    """The commands between the cuts one after the other, the list published after all but the last."""
    columns = store.command.names
    ends = ["2000-01-01", *cuts, "2100-01-01"]
    for number, (first, end) in enumerate(zip(ends, ends[1:])):
        wave = between(b["fx_command"], first, end, "ts").select(*columns)
        wave.write.parquet(f"{root}/rows/wave={number}")
        feed = b.spark.readStream.schema(store.command).parquet(f"{root}/rows/wave=*")
        commands.run_commands(store, feed, f"{root}/checkpoint").awaitTermination()
        if number < len(cuts):
            store.compact()
    return store.read()


@query(f"select user_id, item, ts, event_id from ({FILTERS}) as f")
def stream_filter_state(b):
    """Filter lists from three waves of commands: each is summed up and merged into the entries."""
    root = workspace(b.spark, "filters")
    store = commands.ListStore.of_filters(b.spark, f"{root}/lists")
    return _in_waves(b, store, ["2024-01-08", "2024-01-16"], root).drop("nth")


@query(FLAGS)
def stream_flag_state(b):
    """Flags from two waves of commands."""
    root = workspace(b.spark, "flags")
    store = commands.ListStore.of_flags(b.spark, f"{root}/lists")
    return user_lists.flag_state(_in_waves(b, store, ["2024-01-12"], root))
