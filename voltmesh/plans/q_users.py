"""Queries over users, reviews and the lists users keep."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from ..functions import ids, lists, times
from ..functions.fixed_values import REMOVED_NICKNAME, REMOVED_TEXT
from ..operators import filters, page_marks, reviews, user_lists, users
from ..operators.skew import join_apart
from ..session import workspace
from .bindings import Bindings
from .registry import SQL, query

REVIEWS = "(select * from {fx_review} where level = '1')"
REPLIES = "(select * from {fx_review} where level = '2')"
SALT = "s1"


def callers(b: Bindings) -> DataFrame:
    """Who asks for which station's reviews: everyone who has written there."""
    return b["fx_review"].select("snsid", "appid", "stid").distinct()


# --- users -----------------------------------------------------------------

DOUBLED = """(select snsid, appid from {fx_user} union all
    select snsid, appid from {fx_user} where nickname < 'Customer#0000005')"""
ASKED = "(select distinct snsid, concat('A', cast(snsid as string)) as appid from {fx_user_in})"


@query(
    """select u.sns, u.snsid, u.nickname, u.appid from {fx_user} u
    where (u.sns, u.snsid) in (select (sns, snsid) from {fx_user_in})"""
)
def sign_in_answer(b):
    return users.signed_in(b["fx_user"], b["fx_user_in"])


@query(
    f"""with held as (select snsid, appid, count(*) as n from {DOUBLED} group by snsid, appid)
    select a.snsid, a.appid, 'one' as rule from {ASKED} a join held h
        on a.snsid = h.snsid and a.appid = h.appid where n = 1
    union all
    select a.snsid, a.appid, 'any' as rule from {ASKED} a join held h
        on a.snsid = h.snsid and a.appid = h.appid"""
)
def auth_rows(b):
    held = b["fx_user"].select("snsid", "appid", "nickname")
    again = held.filter(F.col("nickname") < "Customer#0000005")
    table = held.unionByName(again)
    asked = b["fx_user_in"].select("snsid", F.concat(F.lit("A"), F.col("snsid").cast("string")).alias("appid"))
    asked = asked.distinct()
    one = filters.authorised(asked, table).withColumn("rule", F.lit("one"))
    some = filters.authorised(asked, table, exactly_one=False).withColumn("rule", F.lit("any"))
    return one.unionByName(some)


@query(
    """select snsid, appid, item,
        cast(contains(bookmark, '"' || item || '"') as bigint) as exact,
        cast(bookmark like '%' || item || '%' as bigint) as raw
    from {fx_profile}"""
)
def user_list_contains(b):
    table = b["fx_profile"]
    asked = table.select("snsid", "appid", "item")
    return filters.list_contains(asked, table, "bookmark", 1)


@query(
    """select snsid, appid, bookmark, filter from {fx_profile}
    where snsid in (select snsid from {fx_user_in})"""
)
def user_field_select(b):
    asked = b["fx_user_in"].select(
        "snsid", F.concat(F.lit("A"), F.col("snsid").cast("string")).alias("appid")
    )
    return filters.user_field(asked, b["fx_profile"], "bookmark", "filter")


@query(
    f"""select coalesce(u.sns, i.sns) as sns, coalesce(u.snsid, i.snsid) as snsid,
        coalesce(i.email, u.email) as email, coalesce(i.name, u.name) as name,
        coalesce(u.nickname, i.name) as nickname,
        coalesce(u.appid, substr(sha256(concat_ws('|', i.sns, cast(i.snsid as varchar), '{SALT}')),
            1, 20)) as appid
    from {{fx_user}} u full join {{fx_user_in}} i on u.sns = i.sns and u.snsid = i.snsid"""
)
def upsert_users(b):
    return users.upsert_users(b["fx_user"], b["fx_user_in"], SALT)


# Even customers ask for a name of their own choice, the others for the one they have.
NICKNAMES = """(select snsid, appid,
    case when snsid % 2 = 0 then concat('Nick', cast(snsid as string)) else nickname end as nickname
    from {fx_user})"""


@query(
    f"""select u.snsid, u.appid, case when u.nickname = n.nickname then '1' else n.nickname end as answer
    from {{fx_user}} u join {NICKNAMES} n on u.snsid = n.snsid and u.appid = n.appid"""
)
def update_nickname(b):
    chosen = F.concat(F.lit("Nick"), F.col("snsid").cast("string"))
    name = F.when(F.col("snsid") % 2 == 0, chosen).otherwise(F.col("nickname"))
    asked = b["fx_user"].select("snsid", "appid", name.alias("nickname"))
    return users.nickname_answers(b["fx_user"], asked)


@query(
    """select * replace (case when snsid % 2 = 0 then concat('Nick', cast(snsid as string))
        else nickname end as nickname) from {fx_user}"""
)
def stored_nicknames(b):
    chosen = F.concat(F.lit("Nick"), F.col("snsid").cast("string"))
    asked = b["fx_user"].filter(F.col("snsid") % 2 == 0).select("snsid", "appid", chosen.alias("nickname"))
    return users.set_nicknames(b["fx_user"], asked)


# --- reviews ---------------------------------------------------------------


@query("select stid, level, count(*) as n from {fx_review} group by stid, level")
def count_where(b):
    return b["fx_review"].groupBy("stid", "level").agg(F.count("*").alias("n"))


@query(
    """select stid, level, n, nickname, review, time from (
        select *, count(*) over (partition by stid, level) as n,
            row_number() over (partition by stid, level order by time desc, no desc) as rn
        from {fx_review}) as r where rn = 1"""
)
def review_summary(b):
    return reviews.summary(b["fx_review"])


@query(
    """select stid, nickname, review, time from (
        select *, row_number() over (partition by stid order by time desc, no desc) as rn
        from {fx_review} where level = '1') as r where rn = 1"""
)
def latest_review(b):
    newest = reviews.summary(reviews.at_level(b["fx_review"], reviews.REVIEW))
    return newest.select("stid", "nickname", "review", "time")


@query(
    f"""select r.stid, r.reviewid, r.no, coalesce(c.n, 0) as n_replies from {REVIEWS} r
    left join (select stid, reviewid, count(*) as n from {REPLIES} group by stid, reviewid) c
    on r.stid = c.stid and r.reviewid = c.reviewid"""
)
def review_reply_counts(b):
    listed = reviews.at_level(b["fx_review"], reviews.REVIEW)
    counted = reviews.with_reply_counts(listed, b["fx_review"])
    return counted.select("stid", "reviewid", "no", "n_replies")


@query(
    f"""select stid, no, reviewid, nickname, review, time, cast(pos as int) as pos from (
        select *, row_number() over (partition by stid order by no desc) as pos from {REVIEWS}
    ) as r where pos <= 10"""
)
def review_page_all(b):
    page = reviews.newest_reviews(b["fx_review"])
    return page.select("stid", "no", "reviewid", "nickname", "review", "time", "pos")


@query(
    f"""with page as (
        select * from (
            select *, row_number() over (partition by stid order by no desc) as pos from {REVIEWS}
        ) as r where pos <= 10),
    replies as (select stid, reviewid, count(*) as n from {REPLIES} group by stid, reviewid),
    asked as (select distinct snsid, appid, stid from {{fx_review}})
    select a.snsid, a.appid, a.stid, p.nickname, p.reviewid, p.review, p.level, p.time, p.no,
        coalesce(c.n, 0) as n_replies,
        case when p.snsid = a.snsid and p.appid = a.appid then 1 else 0 end as my
    from asked a join page p on a.stid = p.stid
    left join replies c on p.stid = c.stid and p.reviewid = c.reviewid
    where a.snsid in (select snsid from {{fx_user}})"""
)
def review_page(b):
    allowed = filters.authorised(callers(b), b["fx_user"])
    return reviews.review_page(allowed, b["fx_review"])


@query(
    f"""select stid, last, no, cast(pos as int) as pos from (
        select c.stid, c.no as last, r.no,
            row_number() over (partition by c.stid, c.no order by r.no desc) as pos
        from (select distinct stid, no from {REPLIES}) c join {REVIEWS} r
            on r.stid = c.stid and r.no < c.no
    ) as p where pos <= 10"""
)
def keyset_page(b):
    replies = reviews.at_level(b["fx_review"], reviews.REPLY)
    cursors = replies.select("stid", F.col("no").alias("last"))
    return reviews.keyset_page(cursors, b["fx_review"])


NEXT_PAGE = f"""with asked as (
        select snsid, appid, stid, max(no) as last from {{fx_review}} group by snsid, appid, stid),
    page as (
        select a.*, r.no, r.reviewid, r.nickname, r.review, r.level, r.time, r.snsid as s, r.appid as p,
            row_number() over (partition by a.snsid, a.appid, a.stid order by r.no desc) as pos
        from asked a join {REVIEWS} r on r.stid = a.stid and r.no < a.last),
    replies as (select stid, reviewid, count(*) as n from {REPLIES} group by stid, reviewid)
    select g.snsid, g.appid, g.stid, g.last, cast(g.pos as int) as pos, g.no, g.nickname, g.reviewid,
        g.review, g.level, g.time, coalesce(c.n, 0) as n_replies,
        case when g.s = g.snsid and g.p = g.appid then 1 else 0 end as my
    from page g left join replies c on c.stid = g.stid and c.reviewid = g.reviewid where g.pos <= 10"""


@query(NEXT_PAGE)
def next_review_page(b):
    """Everyone reads on from the last they wrote at a station."""
    last = b["fx_review"].groupBy("snsid", "appid", "stid").agg(F.max("no").alias("last"))
    return reviews.next_review_page(last, b["fx_review"])


ASKED_REPLIES = "(select distinct snsid, appid, stid, reviewid from {fx_review})"


@query(
    f"""with page as (
        select *, row_number() over (partition by stid, reviewid order by no) as pos from {REPLIES})
    select a.snsid, a.appid, a.stid, a.reviewid, p.nickname, p.replyid, p.reply, p.level, p.time, p.no,
        cast(p.pos as int) as pos, case when p.snsid = a.snsid and p.appid = a.appid then 1 else 0 end as my
    from {ASKED_REPLIES} a join page p on p.stid = a.stid and p.reviewid = a.reviewid where p.pos <= 10"""
)
def first_reply_page(b):
    asked = b["fx_review"].select("snsid", "appid", "stid", "reviewid").distinct()
    return reviews.first_reply_page(asked, b["fx_review"])


@query(
    f"""with asked as (
        select snsid, appid, stid, reviewid, min(no) as last from {{fx_review}} group by all),
    page as (
        select a.*, r.no, r.replyid, r.nickname, r.reply, r.level, r.time, r.snsid as s, r.appid as p,
            row_number() over (partition by a.snsid, a.appid, a.stid, a.reviewid order by r.no) as pos
        from asked a join {REPLIES} r on r.stid = a.stid and r.reviewid = a.reviewid and r.no > a.last)
    select snsid, appid, stid, reviewid, last, cast(pos as int) as pos, no, nickname, replyid, reply,
        level, time, case when s = snsid and p = appid then 1 else 0 end as my
    from page where pos <= 10"""
)
def next_reply_page(b):
    """Everyone reads on from the first they wrote under a review."""
    keys = ["snsid", "appid", "stid", "reviewid"]
    last = b["fx_review"].groupBy(*keys).agg(F.min("no").alias("last"))
    return reviews.next_reply_page(last, b["fx_review"])


def marked(b: Bindings, level: str, keys: list[str]) -> page_marks.PageMarks:
    """Two thirds of a level's numbers written as one run, the others appended among them."""
    rows = reviews.at_level(b["fx_review"], level)
    marks = page_marks.PageMarks(b.spark, workspace(b.spark, "pages"), rows.schema, keys)
    late = F.col("no") % 3 == 0
    marks.append(rows.filter(~late))
    marks.append(rows.filter(late))
    return marks


@query(SQL["keyset_page"])
def marked_review_page(b):
    """keyset_page from the stretches that the marks name."""
    replies = reviews.at_level(b["fx_review"], reviews.REPLY)
    cursors = replies.select("stid", F.col("no").alias("last"))
    page = marked(b, reviews.REVIEW, ["stid"]).page(cursors)
    return page.select("stid", "last", "no", F.col("pos").cast("int").alias("pos"))


@query(
    f"""with asked as (select stid, reviewid, min(no) as last from {{fx_review}} group by stid, reviewid)
    select stid, reviewid, last, no, replyid, reply, cast(pos as int) as pos from (
        select a.*, r.no, r.replyid, r.reply,
            row_number() over (partition by a.stid, a.reviewid order by r.no) as pos
        from asked a join {REPLIES} r on r.stid = a.stid and r.reviewid = a.reviewid and r.no > a.last
    ) as p where pos <= 10"""
)
def marked_reply_page(b):
    """Replies behind the first entry under each review, oldest first, by marks."""
    keys = ["stid", "reviewid"]
    first = b["fx_review"].groupBy(*keys).agg(F.min("no").alias("last"))
    page = marked(b, reviews.REPLY, keys).page(first, newest_first=False)
    return page.select(*keys, "last", "no", "replyid", "reply", F.col("pos").cast("int").alias("pos"))


@query(
    f"""select stid, no, cast((n - 1) // 10 + 1 as bigint) as page, cast((n - 1) % 10 + 1 as bigint) as pos
    from (select stid, no, row_number() over (partition by stid order by no desc) as n from {REVIEWS}) as r"""
)
def review_pages(b):
    return reviews.review_pages(b["fx_review"]).select("stid", "no", "page", "pos")


@query(
    f"""select stid, reviewid, replyid, reply, no, cast(pos as int) as pos from (
        select *, row_number() over (partition by stid, reviewid order by no) as pos from {REPLIES}
    ) as r where pos <= 10"""
)
def reply_page(b):
    page = reviews.reply_page(b["fx_review"])
    return page.select("stid", "reviewid", "replyid", "reply", "no", "pos")


@query(
    """with newest as (
        select stid, snsid, appid from (
            select *, row_number() over (partition by stid order by time desc, no desc) as rn
            from {fx_review}) as r where rn = 1)
    select r.stid, r.no, r.nickname,
        case when r.snsid = n.snsid and r.appid = n.appid then 1 else 0 end as my
    from {fx_review} r join newest n on r.stid = n.stid"""
)
def mine_flag(b):
    """The last to write at a station asks which entries there are their own."""
    table = b["fx_review"]
    newest = F.max(F.struct("time", "no", "snsid", "appid")).alias("_by")
    last = table.groupBy("stid").agg(newest)
    marked = join_apart(table, last, ["stid"]).withColumn(
        "my", reviews.mine(F.col("_by.snsid"), F.col("_by.appid"))
    )
    return marked.select("stid", "no", "nickname", "my")


# The newest review of every station is edited or removed.
NEWEST = f"""(select * from (
    select *, row_number() over (partition by stid order by no desc) as rn from {REVIEWS}) as r
    where rn <= 10)"""


def newest_keys(b: Bindings) -> DataFrame:
    return reviews.newest_reviews(b["fx_review"]).select(*reviews.REVIEW_KEY)


@query(
    f"""select r.no, r.stid, r.reviewid, r.level,
        case when e.no is not null then 'edited' else r.nickname end as nickname,
        case when e.no is not null then 'edited text' else r.review end as review
    from {{fx_review}} r left join {NEWEST} e on r.no = e.no"""
)
def update_review(b):
    asked = newest_keys(b).withColumns(
        {"nickname": F.lit("edited"), "review": F.lit("edited text")}
    )
    edited = reviews.edit(b["fx_review"], asked, reviews.REVIEW_KEY, "review")
    return edited.select("no", "stid", "reviewid", "level", "nickname", "review")


@query(
    f"""select r.no, r.stid, r.reviewid, r.level,
        case when e.no is not null then '{REMOVED_NICKNAME}' else r.nickname end as nickname,
        case when e.no is not null then '{REMOVED_TEXT}' else r.review end as review
    from {{fx_review}} r left join {NEWEST} e on r.no = e.no
    where e.no is null or (r.stid, r.reviewid) in (select (stid, reviewid) from {REPLIES})"""
)
def delete_review(b):
    left = reviews.delete_reviews(b["fx_review"], newest_keys(b))
    return left.select("no", "stid", "reviewid", "level", "nickname", "review")


@query(
    f"""select r.no, r.stid, r.reviewid, r.level,
        case when e.no is not null then '{REMOVED_NICKNAME}' else r.nickname end as nickname,
        case when e.no is not null then '{REMOVED_TEXT}' else r.review end as review
    from {{fx_review}} r left join (
        select * from {NEWEST} where (snsid, appid) in (select (snsid, appid) from {{fx_user}})) e
        on r.no = e.no
    where e.no is null or (r.stid, r.reviewid) in (select (stid, reviewid) from {REPLIES})"""
)
def delete_review_checked(b):
    """Only the requests of known users are carried out."""
    allowed = filters.authorised(newest_keys(b), b["fx_user"])
    left = reviews.delete_reviews(b["fx_review"], allowed)
    return left.select("no", "stid", "reviewid", "level", "nickname", "review")


@query(
    f"""select * from {{fx_review}} where no not in (
        select no from (
            select no, row_number() over (partition by stid, reviewid order by no) as rn
            from {REPLIES}) as r where rn = 1)"""
)
def delete_reply(b):
    """The oldest reply of every review is removed."""
    first = reviews.reply_page(b["fx_review"], limit=1)
    return reviews.delete_replies(b["fx_review"], first)


@query(
    f"""select no, snsid, level, 36 as id_length, true as is_new,
        substr(sha256(concat_ws('|', level, cast(snsid as varchar), '{SALT}')), 1, 20) as appid
    from {{fx_review}}"""
)
def row_ids(b):
    """New ids, whether each is the only one of its kind, and ids that stay the same."""
    new = b["fx_review"].select("no", "snsid", "level", ids.random_id().alias("newid"))
    path = workspace(b.spark, "ids")
    new.write.parquet(path)  # random ids are made once
    made = b.spark.read.schema(new.schema).parquet(path)
    often = made.groupBy("newid").agg((F.count("*") == 1).alias("is_new"))
    return made.join(often, "newid").select(
        "no", "snsid", "level", F.length("newid").alias("id_length"), "is_new",
        ids.stable_appid(F.col("level"), F.col("snsid"), SALT).alias("appid"),
    )


@query("""select no, stid, strftime(time, '%Y-%m-%d %H:%M:%S') as time from {fx_review}""")
def now_text(b):
    return b["fx_review"].select("no", "stid", times.time_text(F.col("time")).alias("time"))


# --- lists -----------------------------------------------------------------

LOG = """c as (select *, row_number() over (order by ts, event_id) as s from {fx_command}),
    cleared as (select user_id, max(s) as s from c where op = 'removeall' group by user_id),
    gone as (select user_id, item, max(s) as s from c where op = 'remove' group by user_id, item),
    live as (
        select c.* from c left join cleared x on c.user_id = x.user_id
        left join gone g on c.user_id = g.user_id and c.item = g.item
        where c.op = 'add' and c.s > coalesce(x.s, 0) and c.s > coalesce(g.s, 0))"""


@query(
    f"""with {LOG},
    f as (select *, row_number() over (partition by user_id, item order by s) as rn from live)
    select user_id, item, ts, event_id, name, '["' || name || '", "' || item || '"]' as entry,
        row_number() over (partition by user_id order by s) as pos
    from f where rn = 1"""
)
def bookmark_state(b):
    return bookmarks(b)


def bookmarks(b: Bindings) -> DataFrame:
    entry = user_lists.entry_text(F.col("name"), F.col("item"))
    return user_lists.bookmark_state(b["fx_command"], "name").withColumn("entry", entry)


# Those who gave a command on the last day ask for their lists.
ASKING = """(select distinct user_id from {fx_command}
    where ts >= (select max(ts) from {fx_command}) - interval 1 day)"""


def asking(b: Bindings) -> DataFrame:
    newest = b["fx_command"].agg(F.max("ts")).first()[0]
    recent = F.col("ts") >= F.lit(newest - timedelta(days=1)).cast("timestamp_ntz")
    return b["fx_command"].filter(recent).select("user_id").distinct()


@query(
    f"""with {LOG},
    f as (select *, row_number() over (partition by user_id, item order by s) as rn from live)
    select a.user_id, case when count(f.item) = 0 then '' else '[' || string_agg(
        '["' || f.name || '", "' || f.item || '"]', ', ' order by f.s) || ']' end as items
    from {ASKING} a left join (select * from f where rn = 1) f on f.user_id = a.user_id
    group by a.user_id"""
)
def stored_bookmarks(b):
    return user_lists.stored_lists(bookmarks(b), b["fx_command"], asking(b))


@query(
    f"""with {LOG},
    f as (select *, row_number() over (partition by user_id, item order by s desc) as rn from live)
    select user_id, item, ts, event_id, name, place, lat, lng,
        '["' || place || '", "' || name || '", "' || item || '", "' || lat || '", "' || lng || '"]' as entry,
        row_number() over (partition by user_id order by s desc) as pos
    from f where rn = 1"""
)
def recent_search_state(b):
    fields = [F.col(c) for c in ("place", "name", "item", "lat", "lng")]
    found = user_lists.recent_search_state(b["fx_command"], "name", "place", "lat", "lng")
    return found.withColumn("entry", user_lists.entry_text(*fields))


FILTERS = """with c as (
        select *, case op when 'add' then 1 else -1 end as step,
            row_number() over (order by ts, event_id) as s
        from {fx_command} where op <> 'removeall'),
    r as (
        select *, sum(step) over (partition by user_id, item order by s) as depth,
            sum(case op when 'add' then 1 else 0 end) over (partition by user_id, item order by s) as nth
        from c),
    e as (
        select user_id, item, sum(step) - least(0, min(depth)) as kept, max(nth) as adds
        from r group by user_id, item)
    select r.user_id, r.item, r.ts, r.event_id,
        row_number() over (partition by r.user_id order by r.s) as pos
    from r join e on r.user_id = e.user_id and r.item = e.item
    where r.op = 'add' and r.nth > e.adds - e.kept"""


@query(FILTERS)
def filter_state(b):
    return user_lists.filter_state(b["fx_command"])


def _flag(i: int) -> str:
    return f"""cast(coalesce(max(case when idx = {i} and op = 'add' then 1
        when idx = {i} then 0 end), 0) as varchar)"""


FLAGS = f"""select user_id, '[' || {" || ', ' || ".join(_flag(i) for i in range(6))} || ']' as flags
    from (
        select *, row_number() over (partition by user_id, idx order by ts desc, event_id desc) as rn
        from {{fx_command}} where op <> 'removeall') as c where rn = 1
    group by user_id"""


@query(FLAGS)
def flag_array_state(b):
    return user_lists.flag_state(b["fx_command"])


@query(
    """select snsid, case bookmark when '' then '[]' else bookmark end as bookmark,
        case filter when '' then '[]' else filter end as filter,
        cast(case filter when '' then 0 else json_array_length(filter) end as int) as n_filter
    from {fx_profile}"""
)
def json_roundtrip(b):
    rows = lists.parse_list(F.col("bookmark"), lists.ROWS)
    items = lists.parse_list(F.col("filter"))
    return b["fx_profile"].select(
        "snsid",
        lists.dump_rows(rows).alias("bookmark"),
        lists.dump_items(items).alias("filter"),
        F.size(items).alias("n_filter"),
    )


@query(
    """select snsid, item,
        cast(case bookmark when '' then -1 else
            coalesce(list_position(json_extract_string(bookmark, '$[*][1]'), item), 0) - 1 end as int) as at
    from {fx_profile}"""
)
def list_index_of(b):
    saved = lists.row_ids(lists.parse_list(F.col("bookmark"), lists.ROWS), 1)
    return b["fx_profile"].select("snsid", "item", lists.index_of(saved, F.col("item")).alias("at"))


CHOSEN = """(select snsid, appid, unnest(json_extract_string(nullif(filter, ''), '$[*]')) as stid
    from {fx_profile} where filter <> '')"""


def chosen(b: Bindings) -> DataFrame:
    items = lists.parse_list(F.col("filter"))
    return b["fx_profile"].select("snsid", "appid", F.explode(items).alias("stid"))


@query(
    """select snsid, cast(i as int) as pos, json_extract_string(filter, '$[' || i || ']') as stid
    from (select snsid, filter, unnest(range(cast(json_array_length(filter) as int))) as i
        from {fx_profile} where filter <> '') as p"""
)
def explode_user_items(b):
    items = lists.parse_list(F.col("filter"))
    return b["fx_profile"].select("snsid", F.posexplode(items).alias("pos", "stid"))


def catalogue(b: Bindings) -> DataFrame:
    return b["fx_company"].select(F.col("busiid").alias("stid"), F.col("businm").alias("stnm"))


@query(
    f"""select distinct c.snsid, c.appid, c.stid, k.businm as stnm, '1' as flag
    from {CHOSEN} c join {{fx_company}} k on c.stid = k.busiid"""
)
def catalogue_flags(b):
    return user_lists.catalogue_choices(catalogue(b), chosen(b))


@query(
    f"""with caller as (
        select snsid from {CHOSEN} group by snsid order by count(*) desc, snsid desc limit 1)
    select k.busiid as stid, k.businm as stnm,
        case when k.busiid in (select stid from {CHOSEN} where snsid in (select snsid from caller))
            then '1' else '0' end as flag
    from {{fx_company}} k"""
)
def catalogue_for_caller(b):
    """The full list as the caller with the longest filter list sees it."""
    picks = chosen(b)
    busiest = (
        picks.groupBy("snsid").agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), F.col("snsid").desc()).limit(1)
    )
    return user_lists.catalogue_for(catalogue(b), picks.join(busiest, "snsid", "left_semi"))
