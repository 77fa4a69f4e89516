"""The engine's tables as views over the given tables.

Each view is one piece of SQL that Spark and DuckDB both run, so both sides of a
comparison start from the same rows. `{name}` stands for a given table or
another view; names in capitals are replaced by the engine's own word.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..schemas import schema

# The given tables that the views read.
TABLES = {
    name: schema(columns)
    for name, columns in {
        "region": "r_regionkey INT, r_name STRING",
        "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
        "customer": """c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,
            c_mktsegment STRING""",
        "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
        "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,
            o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
        "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
            l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
            l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
        "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
            value DOUBLE, props STRING""",
        "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
        "pages": "page_id BIGINT, url STRING, html STRING",
        "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    }.items()
}


def _pad(value: str, width: int) -> str:
    """Zero-padded text that keeps numbers longer than the width whole."""
    text = f"cast({value} as string)"
    return f"lpad({text}, cast(greatest({width}, length({text})) as int), '0')"


def _degrees(base: int, value: str, span: int) -> str:
    return f"{base} + cast({value} % {span} as double) / cast(10000 as double)"


def _word_prefix(words: int) -> str:
    parts = [f"split_part(addr, ' ', {i})" for i in range(1, words + 1)]
    return f"concat({", ' ', ".join(parts)})"


def _newest_status(first: str, end: str) -> str:
    return f"""
        select statid, chgerid, stat, statupddt, lasttedt, nowtsdt from (
            select *, row_number() over (
                partition by statid, chgerid order by statupddt desc, event_id desc) as rn
            from {{fx_status}}
            where statupddt >= cast('{first}' as {{NTZ}}) and statupddt < cast('{end}' as {{NTZ}})
        ) as s where rn = 1"""


_SIGNED = "{BASE64}({UNHEX}('%s') || {BYTES})"

VIEWS: dict[str, str] = {
    "fx_station": f"""
        select k, statid, statnm, addr, lat, lng, code,
            case when k % 50 = 0 then '0' when k % 50 = 1 then null else code end as addcd
        from (
            select o.o_orderkey as k,
                concat('S', {_pad('o.o_orderkey', 7)}) as statid,
                concat(c.c_mktsegment, ' ', c.c_name) as statnm,
                concat(replace(r.r_name, ' ', '_'), ' ', n.n_name, ' ', c.c_mktsegment, ' ',
                    replace(o.o_orderpriority, ' ', '_')) as addr,
                {_degrees(33, 'o.o_orderkey * 7919', 50000)} as lat,
                {_degrees(125, 'o.o_orderkey * 104729', 45000)} as lng,
                concat(cast(r.r_regionkey + 11 as string), cast(n.n_nationkey + 100 as string),
                    case c.c_mktsegment when 'AUTOMOBILE' then '110' when 'BUILDING' then '120'
                        when 'FURNITURE' then '130' when 'HOUSEHOLD' then '140' else '150' end,
                    '0', substr(o.o_orderpriority, 1, 1)) as code
            from {{orders}} o
            join {{customer}} c on o.o_custkey = c.c_custkey
            join {{nation}} n on c.c_nationkey = n.n_nationkey
            join {{region}} r on n.n_regionkey = r.r_regionkey
        ) as s""",
    "fx_region": f"""
        select bcode, arr, level, arrt,
            {_degrees(33, 'cast(bcode as bigint) * 31', 50000)} as lat,
            {_degrees(125, 'cast(bcode as bigint) * 17', 45000)} as lng
        from (
            select distinct
                case w when 1 then concat(substr(code, 1, 2), '00000000')
                    when 2 then concat(substr(code, 1, 5), '00000')
                    when 3 then concat(substr(code, 1, 8), '00') else code end as bcode,
                case w when 1 then {_word_prefix(1)} when 2 then {_word_prefix(2)}
                    when 3 then {_word_prefix(3)} else addr end as arr,
                case when w > 3 then 3 else w end as level,
                split_part(addr, ' ', w) as arrt
            from (
                select code, addr, {{EACH}} as w
                from (select distinct code, addr from {{fx_station}}) as c
            ) as words
        ) as r""",
    "fx_charger_raw": f"""
        select l_orderkey as k, concat('S', {_pad('l_orderkey', 7)}) as statid,
            l_linenumber as chgerid,
            cast(l_suppkey % 8 as int) as chgertype,
            concat('GATE ', l_linestatus) as location,
            case l_returnflag when 'A' then '24h' when 'N' then '09-18' else '' end as usetime,
            {_pad('l_suppkey', 5)} as busiid,
            concat('Co', cast(l_suppkey % 7 as string)) as bnm,
            concat('Supplier#', {_pad('l_suppkey', 9)}) as businm,
            '' as busicall,
            cast(1 + l_partkey % 5 as int) as stat,
            l_shipdate as statupddt,
            l_shipdate as lasttsdt,
            l_shipdate as lasttedt,
            case when l_linestatus = 'O' then l_shipdate end as nowtsdt,
            cast(l_quantity as int) as output,
            l_returnflag as method,
            l_linestatus as parkingfree,
            case when l_tax > 0.05 then 'late hours' else '' end as note,
            'N' as limityn, '' as limitdetail, 'N' as delyn, '' as deldetail, seq
        from (
            select l_orderkey, l_linenumber, l_suppkey, l_partkey, l_linestatus, l_returnflag,
                l_shipdate, l_quantity, l_tax,
                row_number() over (partition by l_orderkey, l_linenumber
                    order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) as seq
            from {{lineitem}}
        ) as l""",
    "fx_charger": """
        select s.statnm, c.statid, c.chgerid, c.chgertype, s.addr, c.location, s.lat, s.lng, s.addcd,
            c.usetime, c.busiid, c.bnm, c.businm, c.busicall, c.stat, c.statupddt, c.lasttsdt,
            c.lasttedt, c.nowtsdt, c.output, c.method, cast(substr(s.code, 1, 2) as int) as zcode,
            c.parkingfree, c.note, c.limityn, c.limitdetail, c.delyn, c.deldetail
        from {fx_charger_raw} c join {fx_station} s on c.k = s.k
        where c.seq = 1""",
    "fx_company": f"select {_pad('s_suppkey', 5)} as busiid, s_name as businm from {{supplier}}",
    "fx_company_names": f"""
        select {_pad('s_suppkey', 5)} as busiid, concat('OVR_', s_name) as businm
        from {{supplier}} where s_suppkey % 4 = 0""",
    "fx_status": f"""
        select concat('U', {_pad('user_id', 7)}) as statid,
            case event_type when 'click' then 1 when 'error' then 2 when 'purchase' then 3
                when 'signup' then 4 else 5 end as chgerid,
            cast(floor(value) as int) % 6 as stat,
            ts as statupddt,
            cast(concat(substr(cast(ts as string), 1, 13), ':00:00') as {{NTZ}}) as lasttedt,
            case when event_id % 7 = 0 then null else ts end as nowtsdt,
            event_id
        from {{events}}""",
    "fx_base": _newest_status("2000-01-01", "2024-01-04"),
    "fx_buffer": _newest_status("2024-01-04", "2024-01-08"),
    "fx_delta": _newest_status("2024-01-08", "2100-01-01"),
    # In every fourth conversation each turn is a review of its own, without replies.
    "fx_review": f"""
        select r.no, r.snsid, concat('A', cast(r.snsid as string)) as appid,
            concat('N', cast(r.snsid as string)) as nickname,
            concat('S', {_pad('r.conv_id % 10', 7)}) as stid,
            concat('R', cast(r.conv_id as string),
                case when r.turn > 0 and r.conv_id % 4 = 0
                    then concat('T', cast(r.turn as string)) else '' end) as reviewid,
            case when r.turn = 0 or r.conv_id % 4 = 0 then r.text end as review,
            case when r.turn > 0 and r.conv_id % 4 <> 0 then concat('P', cast(r.no as string)) end as replyid,
            case when r.turn > 0 and r.conv_id % 4 <> 0 then r.text end as reply,
            case when r.turn = 0 or r.conv_id % 4 = 0 then '1' else '2' end as level,
            e.ts as time
        from (
            select conv_id, turn, text, conv_id * 100 + turn as no,
                (conv_id * 7 + turn) % 13 as snsid, conv_id * 8 + turn as event_id
            from {{conversations}}
        ) as r join {{events}} e on r.event_id = e.event_id""",
    "fx_user": """
        select c_mktsegment as sns, c_custkey as snsid, concat(c_name, '@example.com') as email,
            c_name as name, c_name as nickname, concat('A', cast(c_custkey as string)) as appid
        from {customer}""",
    "fx_user_in": """
        select sns, snsid, concat('new-', email) as email, upper(name) as name
        from {fx_user} where snsid % 3 = 0
        union all
        select sns, snsid + 1000000, email, name from {fx_user} where snsid % 3 = 0""",
    "fx_profile": """
        select sns, snsid, appid,
            case snsid % 3 when 0 then '' when 1 then concat('[["', nickname, '", "M', a, '"]]')
                else concat('[["', nickname, '", "M', a, '"], ["', sns, '", "M', b, '"]]') end as bookmark,
            case snsid % 3 when 0 then ''
                when 1 then concat('["', lpad(a, 5, '0'), '"]')
                else concat('["', lpad(a, 5, '0'), '", "', lpad(b, 5, '0'), '", "', lpad(a, 5, '0'),
                    '"]') end as filter,
            concat('M', cast(snsid % 13 as string)) as item
        from (
            select sns, snsid, appid, nickname, cast(snsid % 23 as string) as a,
                cast(100 + snsid % 17 as string) as b
            from {fx_user}
        ) as u""",
    "fx_command": """
        select user_id, event_id, ts,
            case when event_type = 'error' then 'remove'
                when event_type = 'signup' and event_id % 5 = 0 then 'removeall' else 'add' end as op,
            concat('M', cast(k % 6 as string)) as item,
            cast(k % 6 as int) as idx,
            concat('name', cast(k as string)) as name,
            case when k % 2 = 0 then 'station' else 'region' end as place,
            concat('37.', cast(100 + k % 900 as string)) as lat,
            concat('127.', cast(100 + k % 700 as string)) as lng
        from (
            select user_id, event_id, ts, event_type,
                cast(regexp_extract(props, '[0-9]+', 0) as bigint) as k
            from {events}
        ) as e""",
    "fx_point": f"""
        select concat('S', {_pad('o_orderkey', 7)}) as statid,
            37 + cast(o_orderkey * 7919 % 211 as double) / cast(25000 as double) as lat,
            126 + cast(cast(floor(o_totalprice * 100) as bigint) % 1999 as double)
                / cast(25000 as double) as lng
        from {{orders}}""",
    "fx_report": f"""
        select doc_id, concat(lang, '@example.com') as emailto, concat('S', {_pad('doc_id', 7)}) as stid,
            source as stnm, text as context
        from {{documents}}""",
    "fx_image": f"""
        select doc_id, {_SIGNED % '89504E470D0A1A0A'} as first, {_SIGNED % 'FFD8FFDB'} as second,
            {_SIGNED % '474946383961'} as third, cast(1 + doc_id % 3 as int) as dist
        from {{documents}}""",
    "fx_district": """
        select bcode, arr, case when cast(bcode as bigint) % 7 = 0 then '폐지' else '존재' end as status
        from {fx_region}""",
    "fx_place": """
        select addr as name, lat, lng from (
            select addr, lat, lng, row_number() over (partition by addr order by statid) as rn
            from {fx_station}
        ) as s where rn = 1""",
}

_SPARK_WORDS = {
    "NTZ": "timestamp_ntz",
    "BASE64": "base64",
    "UNHEX": "unhex",
    "BYTES": "encode(text, 'utf-8')",
    "EACH": "explode(array(1, 2, 3, 4))",
}
_DUCK_WORDS = {
    "NTZ": "timestamp",
    "BASE64": "to_base64",
    "UNHEX": "unhex",
    "BYTES": "encode(text)",
    "EACH": "unnest([1, 2, 3, 4])",
}
_NAME = re.compile(r"\{(\w+)\}")


class Bindings:
    """Views of one folder of tables, made when they are first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in TABLES:
                reader = self.spark.read.schema(TABLES[name])
                self._made[name] = reader.parquet(f"{self.folder}/{name}.parquet")
            else:
                text = VIEWS[name]
                words = set(_NAME.findall(text))
                inputs = {w: self[w] for w in words if w not in _SPARK_WORDS}
                for word in words & set(_SPARK_WORDS):
                    text = text.replace(f"{{{word}}}", _SPARK_WORDS[word])
                self._made[name] = self.spark.sql(text, **inputs)
        return self._made[name]


def duck_sql(query: str) -> str:
    """A query over views as one DuckDB statement, with the views it needs in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    plain = lambda text: _NAME.sub(lambda m: _DUCK_WORDS.get(m[1], m[1]), text)
    views = ",\n".join(f"{n} as ({plain(VIEWS[n])})" for n in needed)
    body = plain(query).strip()
    if not views:
        return body
    for start in ("with recursive ", "with "):
        if body.startswith(start):
            return f"{start}{views},\n{body[len(start):]}"
    return f"with {views}\n{body}"
