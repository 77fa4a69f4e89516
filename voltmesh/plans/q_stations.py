"""Queries over stations, regions and companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import codes, geo, text, times
from ..functions.fixed_values import OVERLAP_BOX
from ..operators import curve, filters, merges, name_index, regions, spatial
from ..operators.skew import join_apart
from ..schemas import KEYS, STATUS_COLUMNS
from ..session import workspace
from ..sinks.tables import VersionedTable
from ..streaming import status
from .bindings import Bindings
from .registry import SQL, query

# A map section and a point on it.
BOX = (37.606001, 35.307641, 128.700499, 126.406166)
POINT = (37.571076, 126.99588)
IN_BOX = "lat <= 37.606001 and lat >= 35.307641 and lng <= 128.700499 and lng >= 126.406166"

# Epoch seconds of the run before and of this run: 2024-01-10 00:00:00 and a day and 30 s later.
LAST_RUN, THIS_RUN = 1704844800, 1704931230

STATION = ["statid", "statnm", "addr", "lat", "lng", "addcd"]


def stations(b: Bindings) -> DataFrame:
    return b["fx_station"].select(*STATION)


# --- boxes, text, detail ---------------------------------------------------


@query(f"select statid, lat, lng, stat, chgertype from {{fx_charger}} where {IN_BOX}")
def bbox_stations(b):
    return filters.stations_in_box(b["fx_charger"], *BOX)


@query(SQL["bbox_stations"])
def bbox_stations_by_curve(b):
    """The same box on a snapshot published along the curve."""
    table = VersionedTable(b.spark, workspace(b.spark, "curve"))
    table.publish(curve.by_curve(b["fx_charger"]))
    return curve.in_box(table.read(), *BOX).select("statid", "lat", "lng", "stat", "chgertype")


@query(f"select bcode, arrt, lat, lng from {{fx_region}} where {IN_BOX} and level = 3")
def bbox_regions(b):
    return filters.regions_in_box(b["fx_region"], *BOX, 3)


@query("select * from {fx_charger} where statid in (select stid from {fx_review})")
def station_detail(b):
    wanted = b["fx_review"].select(F.col("stid").alias("statid"))
    return filters.station_detail(b["fx_charger"], wanted).select(*b["fx_charger"].columns)


@query(
    """select arr, lat, lng from {fx_region}
    where arr like '%ASIA%' and arr like '%NATION%' and arr like '%HOUSE%' and arr like '%%'
    order by bcode limit 3"""
)
def search_region_terms(b):
    return filters.regions_by_terms(b["fx_region"], ["ASIA", "NATION", "HOUSE", "", ""])


@query("select statid, chgerid, statnm from {fx_charger} where statnm like '%HOUSE%7%'")
def search_station_text(b):
    found = filters.stations_by_text(b["fx_charger"], "HOUSE%7")
    return found.select("statid", "chgerid", "statnm")


@query("select statid, chgerid, addr, addcd from {fx_charger} where addcd = '0' or addcd is null")
def needs_region(b):
    return filters.without_region(b["fx_charger"]).select("statid", "chgerid", "addr", "addcd")


@query("select statid, chgerid, lat, lng from {fx_charger} where addcd is null")
def region_missing(b):
    missing = b["fx_charger"].filter(F.col("addcd").isNull())
    return missing.select("statid", "chgerid", "lat", "lng")


NEAREST = """
    select statid, statnm, addr, lat, lng,
        abs(cast(37.571076 as double) - lat) + abs(cast(126.99588 as double) - lng) as dist
    from (
        select *, row_number() over (partition by statid order by chgerid) as rn
        from {fx_charger} where statnm like '%HOUSE%'
    ) as s where rn = 1
    order by dist, statid limit 5"""


@query(NEAREST)
def nearest_station_search(b):
    return spatial.nearest_station(b["fx_charger"], "HOUSE", *POINT)


@query(NEAREST)
def nearest_station_by_index(b):
    """The stations that the name index finds, ranked by distance."""
    index = name_index.NameIndex(b.spark, workspace(b.spark, "names"))
    index.write(b["fx_charger"], "statnm")
    return spatial.nearest_station(index.rows(b["fx_charger"], "statnm", "HOUSE"), "HOUSE", *POINT)


@query(
    """select statid, chgerid, statnm from (
        select *, row_number() over (partition by statid order by chgerid) as rn
        from {fx_charger} where statnm like '%HOUSE%') as s
    where rn = 1 order by statid limit 5"""
)
def limit_n(b):
    found = filters.stations_by_text(b["fx_charger"], "HOUSE")
    return regions.representatives(found, "statnm").orderBy("statid").limit(5)


# --- status feed and merges ------------------------------------------------

CHANGED = """(a.stat <> b.stat or a.statupddt <> b.statupddt or a.lasttedt <> b.lasttedt
    or a.nowtsdt <> b.nowtsdt)"""
MERGED = f"""
    select a.statid, a.chgerid,
        case when {CHANGED} then b.stat else a.stat end as stat,
        case when {CHANGED} then b.statupddt else a.statupddt end as statupddt,
        case when {CHANGED} then b.lasttedt else a.lasttedt end as lasttedt,
        case when {CHANGED} then b.nowtsdt else a.nowtsdt end as nowtsdt
    from %s a left join %s b on a.statid = b.statid and a.chgerid = b.chgerid"""
UPSERTED = (
    MERGED
    + """
    union all
    select statid, chgerid, stat, statupddt, lasttedt, nowtsdt from %s
    where (statid, chgerid) not in (select (statid, chgerid) from %s)"""
)


def upserted(target: str, delta: str) -> str:
    return UPSERTED % (target, delta, delta, target)


@query(
    f"""select b.statid, b.chgerid, b.stat, b.statupddt, b.lasttedt, b.nowtsdt
    from {{fx_base}} a join {{fx_delta}} b on a.statid = b.statid and a.chgerid = b.chgerid
    where {CHANGED}"""
)
def changed_rows(b):
    return filters.changed_rows(b["fx_base"], b["fx_delta"], STATUS_COLUMNS)


@query(
    """select statid, chgerid, stat, statupddt from {fx_status}
    where statupddt >= timestamp '2024-01-11 00:00:30' - interval 1442 minute"""
)
def lookback_window(b):
    recent = filters.within_lookback(b["fx_status"], F.lit(THIS_RUN), F.lit(LAST_RUN))
    return recent.select("statid", "chgerid", "stat", "statupddt")


@query(
    """select event_id, cast(hour(ts) = 18 and minute(ts) < 20 as int) as rebuilding from {events}"""
)
def maintenance_window(b):
    flag = times.in_rebuild_window(F.col("ts")).cast("int").alias("rebuilding")
    return b["events"].select("event_id", flag)


@query(
    """select statid, chgerid, stat, statupddt, lasttedt, nowtsdt from (
        select *, row_number() over (
            partition by statid, chgerid order by statupddt desc, event_id desc) as rn
        from {fx_status}) as s where rn = 1"""
)
def latest_per_key(b):
    order = [F.col("statupddt").desc(), F.col("event_id").desc()]
    return merges.latest_per_key(b["fx_status"], order=order).select(*KEYS, *STATUS_COLUMNS)


@query(MERGED % ("{fx_base}", "{fx_delta}"))
def merge_status(b):
    return merges.merge_status(b["fx_base"], b["fx_delta"])


@query(SQL["merge_status"])
def merge_status_in_buckets(b):
    """A third of the delta compacted into a snapshot in buckets, the rest read with it from the log."""
    store = status.StatusStore(b.spark, workspace(b.spark, "buckets"), parts=4, buckets=8, small_log=0)
    store.tables[status.SNAPSHOT].publish(b["fx_base"])
    store.ensure_tables(0.0)
    third = F.pmod(F.xxhash64("statid"), F.lit(3)) == 0
    store.merge_batch(b["fx_delta"].filter(third), 0)
    store.compact()
    store.merge_batch(b["fx_delta"].filter(~third), 1)
    return store.read().select(*KEYS, *STATUS_COLUMNS)


@query(upserted("{fx_buffer}", "{fx_delta}"))
def buffer_upsert(b):
    return merges.upsert_status(b["fx_buffer"], b["fx_delta"])


REPLAYED = """
    select a.statid, a.chgerid,
        case when a.stat <> b.stat or a.statupddt <> b.statupddt then b.stat else a.stat end as stat,
        case when a.stat <> b.stat or a.statupddt <> b.statupddt then b.statupddt
            else a.statupddt end as statupddt,
        a.lasttedt, a.nowtsdt
    from %s a left join %s b on a.statid = b.statid and a.chgerid = b.chgerid"""


@query(REPLAYED % ("{fx_base}", "{fx_buffer}"))
def replay_buffer(b):
    return merges.replay_buffer(b["fx_base"], b["fx_buffer"])


@query(
    """select a.*, b.stat as statup, b.statupddt as statupddtup, b.lasttedt as lasttedtup,
        b.nowtsdt as nowtsdtup
    from {fx_base} a left join {fx_delta} b on a.statid = b.statid and a.chgerid = b.chgerid"""
)
def snapshot_left_join(b):
    return merges.with_delta_columns(b["fx_base"], b["fx_delta"])


LAST_ENTRY = """(select *, row_number() over (
    partition by statid, chgerid order by statupddt desc, event_id desc) as rn from {fx_status})"""


@query(
    f"""select a.statid, a.chgerid, coalesce(b.stat, a.stat) as stat, a.statupddt,
        coalesce(b.lasttedt, a.lasttedt) as lasttedt, a.nowtsdt
    from {{fx_base}} a left join {LAST_ENTRY} b
    on a.statid = b.statid and a.chgerid = b.chgerid and b.rn = 1"""
)
def keyed_update(b):
    order = [F.col("statupddt").desc(), F.col("event_id").desc()]
    return merges.keyed_update(b["fx_base"], b["fx_status"], KEYS, ["stat", "lasttedt"], order)


@query(
    """with feed as (
        select *, row_number() over (
            partition by statid, chgerid order by statupddt desc, event_id desc) as rn
        from {fx_status}
        where statupddt >= timestamp '2024-01-11 00:00:30' - interval 1442 minute)
    select a.statid, a.chgerid, coalesce(b.stat, a.stat) as stat,
        coalesce(b.statupddt, a.statupddt) as statupddt, a.lasttedt, a.nowtsdt
    from {fx_base} a left join feed b
    on a.statid = b.statid and a.chgerid = b.chgerid and b.rn = 1"""
)
def feed_update_simple(b):
    feed = filters.within_lookback(b["fx_status"], F.lit(THIS_RUN), F.lit(LAST_RUN))
    order = [F.col("statupddt").desc(), F.col("event_id").desc()]
    return merges.keyed_update(b["fx_base"], feed, KEYS, ["stat", "statupddt"], order)


# --- region codes ----------------------------------------------------------

CODED = "(select statid, code from {fx_station} where addcd is not null and addcd <> '0')"


def known_codes(b: Bindings) -> DataFrame:
    known = b["fx_station"].filter(~codes.needs_region(F.col("addcd")))
    return known.select("statid", F.col("code").alias("addcd"))


@query(
    f"""select c.statid, c.chgerid, c.lat, c.lng, s.code as addcd
    from {{fx_charger}} c left join {CODED} s on c.statid = s.statid"""
)
def enrich_region_left(b):
    chargers = b["fx_charger"].select("statid", "chgerid", "lat", "lng", "addcd")
    return merges.take_codes(chargers, known_codes(b))


@query(
    f"""select c.statid, c.chgerid, c.lat, c.lng, s.code as addcd
    from {{fx_charger}} c join {CODED} s on c.statid = s.statid"""
)
def enrich_region_inner(b):
    chargers = b["fx_charger"].select("statid", "chgerid", "lat", "lng", "addcd")
    return merges.keep_coded(chargers, known_codes(b))


BY_CODE = """(select addcd, count(*) as n from {fx_charger}
    where stat = 2 and addcd is not null group by addcd)"""
PREFIX = """case level
    when 3 then case when substr(bcode, 6) = '00000' then substr(bcode, 1, 5)
        when substr(bcode, 9) = '00' then substr(bcode, 1, 8) else bcode end
    when 2 then case when substr(bcode, 5) = '000000' then substr(bcode, 1, 4)
        when substr(bcode, 6) = '00000' then substr(bcode, 1, 5) else substr(bcode, 1, 8) end
    when 1 then substr(bcode, 1, 2) end"""


@query(
    f"""select r.bcode, r.arr, r.level, r.arrt, r.lat, r.lng,
        cast(coalesce(sum(c.n), 0) as bigint) as num
    from {{fx_region}} r left join {BY_CODE} c on starts_with(c.addcd, {PREFIX})
    group by all"""
)
def available_by_region(b):
    return regions.available_by_region(b["fx_region"], b["fx_charger"])


@query(
    f"""select r.bcode, r.arrt, r.lat, r.lng, cast(coalesce(sum(c.n), 0) as bigint) as n_available
    from (select * from {{fx_region}} where {IN_BOX} and level = 3) r
    left join {BY_CODE} c on starts_with(c.addcd, substr(r.bcode, 1, 8))
    group by all"""
)
def prefix_join_counts(b):
    in_box = filters.regions_in_box(b["fx_region"], *BOX, 3)
    return regions.available_in_box(in_box, b["fx_charger"])


@query("select statid, chgerid, statnm from {fx_charger} where statnm like '%HOUSE%07%'")
def search_station_index(b):
    """The same search through posting lists of the names."""
    index = name_index.NameIndex(b.spark, workspace(b.spark, "names"))
    index.write(b["fx_charger"], "statnm")
    return index.rows(b["fx_charger"], "statnm", "HOUSE%07").select("statid", "chgerid", "statnm")


GEOCODED = """
    select statid, coalesce(bcode, '0') as addcd from (
        select s.statid, r.bcode, row_number() over (
            partition by s.statid order by
            (s.lat - r.lat) * (s.lat - r.lat) + (s.lng - r.lng) * cos(radians(s.lat))
                * ((s.lng - r.lng) * cos(radians(s.lat))), r.bcode) as rn
        from %s s left join (select * from {fx_region} where level = 3) r on true
    ) as g where rn = 1"""


@query(GEOCODED % "{fx_station}")
def reverse_geocode(b):
    return spatial.reverse_geocode(stations(b), b["fx_region"])


PLACED = """
    select statid, lat, lng from (
        select s.statid, r.lat, r.lng, row_number() over (
            partition by s.statid order by length(r.arr) desc, r.bcode) as rn
        from {fx_station} s join {fx_region} r on s.addr = r.arr or starts_with(s.addr, r.arr || ' ')
        where s.addcd = '0' or s.addcd is null
    ) as g where rn = 1"""


@query(PLACED)
def geocode_address(b):
    return spatial.geocode_address(filters.without_region(stations(b)), b["fx_region"])


@query(
    f"""with moved as ({PLACED}),
    placed as (
        select s.statid, s.statnm, s.addr, coalesce(m.lat, s.lat) as lat,
            coalesce(m.lng, s.lng) as lng, s.addcd
        from {{fx_station}} s left join moved m on s.statid = m.statid),
    lost as (select * from placed where addcd = '0' or addcd is null),
    coded as ({GEOCODED % 'lost'})
    select p.statid, p.statnm, p.addr, p.lat, p.lng, coalesce(c.addcd, p.addcd) as addcd
    from placed p left join coded c on p.statid = c.statid"""
)
def repair_region(b):
    return spatial.repair_region(stations(b), b["fx_region"])


@query(
    """select r.bcode, r.arr, r.level, r.arrt, coalesce(p.lat, 0.0) as lat, coalesce(p.lng, 0.0) as lng
    from {fx_region} r left join {fx_place} p on r.arr = p.name"""
)
def region_coords(b):
    return regions.with_coordinates(b["fx_region"], b["fx_place"])


# --- neighbours ------------------------------------------------------------

SPOTS = """with spots as (
    select lat, lng, count(*) as n, min(statid) as first_id from {fx_point} group by lat, lng),
    pairs as (
        select a.lat, a.lng, a.n, a.first_id, b.lat as near_lat, b.lng as near_lng, b.n as n_near,
            b.first_id as near_first_id
        from spots a join spots b
        on a.lat <= b.lat + cast(0.00005 as double) and a.lat >= b.lat - cast(0.00005 as double)
            and a.lng <= b.lng + cast(0.00005 as double) and a.lng >= b.lng - cast(0.00005 as double)
        where a.lat <> b.lat or a.lng <> b.lng or a.n > 1)"""


@query(SPOTS + " select * from pairs")
def nearby_pairs(b):
    return spatial.nearby_spots(b["fx_point"], OVERLAP_BOX)


@query(
    SPOTS
    + """
    select s.statid, p.n_near from {fx_point} s join (
        select lat, lng, cast(sum(n_near - case when lat = near_lat and lng = near_lng then 1
            else 0 end) as bigint) as n_near
        from pairs group by lat, lng) p on s.lat = p.lat and s.lng = p.lng"""
)
def nearby_counts(b):
    return spatial.nearby_counts(b["fx_point"], OVERLAP_BOX)


@query("select statid, lat, lng, min(statid) over (partition by lat, lng) as spot from {fx_point}")
def spot_members(b):
    return spatial.spot_members(b["fx_point"])


@query(
    """select a.statid, b.statid as near_id, b.lat as near_lat, b.lng as near_lng
    from (select * from {fx_point} where (lat, lng) in (
        select (lat, lng) from {fx_point} group by lat, lng having count(*) > 1)) a
    join {fx_point} b on b.lat <= a.lat + cast(0.00005 as double) and b.lat >= a.lat - cast(0.00005 as double)
        and b.lng <= a.lng + cast(0.00005 as double) and b.lng >= a.lng - cast(0.00005 as double)
    where a.statid <> b.statid"""
)
def neighbours_of(b):
    """All stations around those that share their spot with another."""
    shared = b["fx_point"].groupBy("lat", "lng").agg(F.count("*").alias("n")).filter("n > 1")
    asked = join_apart(b["fx_point"], shared, ["lat", "lng"], "left_semi")
    return spatial.neighbours_of(asked, b["fx_point"], OVERLAP_BOX)


# Rounds over all stations with neighbours: 0 open, 1 stays, 2 moves.
SPREAD = """with recursive near as (
        select a.statid as a, b.statid as b, b.lat, b.lng from {fx_point} a join {fx_point} b
        on b.lat <= a.lat + cast(0.00005 as double) and b.lat >= a.lat - cast(0.00005 as double)
            and b.lng <= a.lng + cast(0.00005 as double) and b.lng >= a.lng - cast(0.00005 as double)
        where a.statid <> b.statid),
    state as (
        select 0 as round, id, 0 as s from (select distinct a as id from near) as n
        union all
        select st.round + 1, st.id, case when st.s <> 0 then st.s when bool_or(x.s = 1) then 2
            when bool_or(x.s = 0 and (md5(x.id), x.id) < (md5(st.id), st.id)) then 0 else 1 end
        from state st join near n on n.a = st.id join state x on x.id = n.b
        where (select count(*) from state where s = 0) > 0
        group by st.round, st.id, st.s),
    ranked as (
        select n.a as anchor, n.b as statid,
            row_number() over (partition by n.a order by n.b) as i, n.lat, n.lng
        from near n join state st on st.id = n.a
        where st.s = 1 and st.round = (select max(round) from state)),
    shifts(i, y, x) as (
        values (1, 1, 0), (2, -1, 0), (3, 0, 1), (4, 0, -1), (5, 1, 1), (6, -1, -1), (7, 1, -1),
            (8, -1, 1)),
    placed as (
        select r.anchor, r.i, r.lat + cast(h.y as double) * cast(0.0001 as double) as lat,
            r.lng + cast(h.x as double) * cast(0.0001 as double) as lng
        from ranked r join shifts h on r.i = h.i)
    select r.statid, p.lat, p.lng
    from (select *, row_number() over (partition by statid order by md5(anchor) desc, anchor desc) as last from ranked) r
    join placed p on p.anchor = r.anchor and p.i = least(r.i, 8)
    where r.last = 1"""


@query(SPREAD)
def spread_overlaps(b):
    return spatial.spread_overlaps(b["fx_point"], OVERLAP_BOX)


# --- companies and other aggregates ---------------------------------------


@query("select busiid, min(businm) as businm from {fx_charger} group by busiid")
def company_dim(b):
    return regions.company_dimension(b["fx_charger"])


@query(
    """select c.busiid, coalesce(n.businm, c.businm) as businm
    from {fx_company} c left join {fx_company_names} n on c.busiid = n.busiid"""
)
def override_names(b):
    return regions.override_names(b["fx_company"], b["fx_company_names"])


@query("select busiid, businm from {fx_company} order by businm, busiid")
def company_list(b):
    return regions.company_list(b["fx_company"])


@query("select distinct busiid, businm from {fx_charger}")
def distinct_companies(b):
    return b["fx_charger"].select("busiid", "businm").distinct()


@query(
    """select statid, chgerid, statnm, addr, lat, lng from (
        select *, row_number() over (partition by statid order by chgerid) as rn from {fx_charger}
    ) as s where rn = 1"""
)
def station_representative(b):
    return regions.representatives(b["fx_charger"], "statnm", "addr", "lat", "lng")


@query("select distinct statid, lat, lng from {fx_charger}")
def distinct_lookups(b):
    return b["fx_charger"].select("statid", "lat", "lng").distinct()


# --- column functions ------------------------------------------------------


@query(f"select bcode, level, {PREFIX} as prefix from {{fx_region}}")
def region_prefix(b):
    prefix = codes.region_prefix(F.col("bcode"), F.col("level"))
    return b["fx_region"].select("bcode", "level", prefix.alias("prefix"))


@query(
    """select o_orderkey,
        cast(case least(o_orderkey % 10, 7) when 0 then 1 when 1 then -1 when 2 then 0 when 3 then 0
            when 4 then 1 when 5 then -1 when 6 then 1 else -1 end as double)
            * cast(0.0001 as double) as d_lat,
        cast(case least(o_orderkey % 10, 7) when 0 then 0 when 1 then 0 when 2 then 1 when 3 then -1
            when 4 then 1 when 5 then -1 when 6 then -1 else 1 end as double)
            * cast(0.0001 as double) as d_lng
    from {orders}"""
)
def offset_by_rank(b):
    rank = F.pmod("o_orderkey", F.lit(10))
    return b["orders"].select(
        "o_orderkey",
        geo.lat_shift(rank).alias("d_lat"),
        geo.lng_shift(rank).alias("d_lng"),
    )


@query(
    """select bcode, arr,
        cast(least(length(arr) - length(replace(arr, ' ', '')) + 1, 3) as int) as level,
        split_part(arr, ' ', -1) as arrt from {fx_region}"""
)
def region_level(b):
    arr = F.col("arr")
    return b["fx_region"].select(
        "bcode", "arr", codes.region_level(arr).alias("level"), codes.last_word(arr).alias("arrt")
    )


@query("select statid, concat(cast(lng as varchar), ',', cast(lat as varchar)) as key from {fx_station}")
def coord_key(b):
    return b["fx_station"].select("statid", geo.coord_key(F.col("lat"), F.col("lng")).alias("key"))


@query(
    """select statid, abs(cast(37.571076 as double) - lat) + abs(cast(126.99588 as double) - lng) as dist
    from {fx_station}"""
)
def manhattan_distance(b):
    dist = geo.manhattan(F.lit(POINT[0]), F.lit(POINT[1]), F.col("lat"), F.col("lng"))
    return b["fx_station"].select("statid", dist.alias("dist"))


@query(
    """select event_id, cast(trunc((floor(epoch(ts)) - 1704067200) / 60) as bigint) + 2 as minutes
    from {events}"""
)
def lookback_minutes(b):
    minutes = times.lookback_minutes(times.epoch_seconds(F.col("ts")), F.lit(1704067200))
    return b["events"].select("event_id", minutes.alias("minutes"))


@query("select o_orderkey, o_orderkey // 9999 + 1 as pages from {orders}")
def page_count(b):
    return b["orders"].select("o_orderkey", times.page_count(F.col("o_orderkey")).alias("pages"))


@query(
    """select bcode, '%' || arr || '%' as contains, substr(bcode, 1, 8) || '%' as starts
    from {fx_region}"""
)
def like_pattern(b):
    return b["fx_region"].select(
        "bcode",
        text.contains_pattern(F.col("arr")).alias("contains"),
        text.prefix_pattern(F.left(F.col("bcode"), F.lit(8))).alias("starts"),
    )


@query(
    """select event_id, strftime(ts, '%H%M') as hhmm, cast(hour(ts) as int) as h,
        cast(minute(ts) as int) as m from {events}"""
)
def hhmm_parts(b):
    text_time = times.hhmm(F.col("ts"))
    return b["events"].select(
        "event_id",
        text_time.alias("hhmm"),
        times.hhmm_hour(text_time).alias("h"),
        times.hhmm_minute(text_time).alias("m"),
    )


@query("select statid, coalesce(addcd, '0') as addcd from {fx_station}")
def sentinel_code(b):
    return b["fx_station"].select("statid", codes.code_or_failed(F.col("addcd")).alias("addcd"))


@query("select page_id, replace(url, 'http://', '') as name from {pages}")
def relative_name(b):
    name = text.relative_name(F.col("url"), F.lit("http://"))
    return b["pages"].select("page_id", name.alias("name"))
