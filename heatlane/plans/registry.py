"""Register of named queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 8


def query(name: str, oracle: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def rnd(c: Column | str, digits: int = DIGITS) -> Column:
    """Fixed scale, and no negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """All DOUBLE columns at a fixed scale."""
    return df.select(
        *[rnd(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def r(expr: str, digits: int = DIGITS) -> str:
    """The same for SQL text."""
    return f"(round(cast({expr} as double), {digits}) + cast(0.0 as double))"


# Fixed values, spelled out for the DuckDB side: points by entry lane and place.
RANKING_SQL = """[0, -1, -2, -3, -4, -5,
 1, 0, -1, -2, -3, -4,
 2, 1, 0, -1, -2, -3,
 3, 2, 1, 0, -1, -2,
 4, 3, 2, 1, 0, -1,
 5, 4, 3, 2, 1, 0]"""
CONDITION_SQL = """[2, -1, -2, -3, -4, -5,
 1, 1, -1, -2, -3, -4,
 2, 1, 1, -1, -2, -3,
 3, 2, 1, 0, -1, -2,
 4, 3, 2, 1, 0, -1,
 5, 4, 3, 2, 1, -1]"""

# SQL of the lenses, for the DuckDB side.
LENS = {
    "lanes": """lanes as (
  select l_orderkey as race_id, cast((l_linenumber - 1) % 6 + 1 as bigint) as lane,
         min(l_partkey) as part, min(l_suppkey) as player_id, max(l_extendedprice) as price,
         min(l_quantity) as time_tenji, max(l_discount) as discount
  from lineitem group by 1, 2)""",
    "boats": """lanes as (
  select l_orderkey as race_id, cast((l_linenumber - 1) % 6 + 1 as bigint) as lane,
         min(l_partkey) as part, min(l_suppkey) as player_id, max(l_extendedprice) as price,
         min(l_quantity) as time_tenji, max(l_discount) as discount
  from lineitem group by 1, 2),
ranked as (
  select l.*, cast(o_orderdate as date) as date, o_orderpriority as priority, o_orderstatus as status,
         cast(rank() over (partition by race_id order by price desc, lane) as bigint) as finish
  from lanes l join orders on race_id = o_orderkey),
boats as (
  select *, player_id % 24 + 1 as place, part % 60 as motor_number,
         cast(date_trunc('month', date) as date) as section,
         case when month(date) between 3 and 5 then 'spring' when month(date) between 6 and 8 then 'summer'
              when month(date) between 9 and 11 then 'autumn' else 'winter' end as season_q,
         case part % 50 when 0 then 'F' when 1 then '欠' when 2 then '＿' when 3 then ' Ｌ ' when 4 then '転'
              when 5 then '' else case when part % 50 between 6 and 12
                then translate(cast(finish as varchar), '123456', '１２３４５６')
                else cast(finish as varchar) end end as rank_raw
  from ranked)""",
    "ranks": """parsed as (
  select *, translate(replace(trim(rank_raw), '　', ''), '０１２３４５６ＦＬ', '0123456FL') as rank_code from boats),
ranks as (
  select *, case when rank_code in ('1','2','3','4','5','6') then 'finish' when rank_code = '欠' then 'dns'
     when rank_code in ('妨','エ','転','落','沈','失') then 'dsq' when rank_code = '不' then 'dnf'
     when rank_code = 'F' then 'fs' when rank_code = 'L' then 'ls' when rank_code = '＿' then 'void'
     else 'unknown' end as rank_class from parsed)""",
    "seq": """seq as (
  select event_id, ts, user_id, event_type, value, coalesce(value >= 20, false) as started,
         cast(coalesce(value >= 150, false) as bigint) as f1,
         cast(coalesce(value between 80 and 149.99, false) as bigint) as f2,
         cast(coalesce(value between 50 and 79.99, false) as bigint) as f3 from events)""",
    "months": """months as (
  select user_id, cast(ts as date) as day, count(*) as race_ct, max(value) as best,
         cast(sum(cast(value as decimal(18,2))) as double) as score from events group by 1, 2)""",
    "payouts": """payouts as (
  select o_orderkey as race_id,
    cast(floor(o_orderkey / 12) as bigint) % 24 + 1 as venue,
    cast(floor(floor(o_orderkey / 12) / 24) as bigint) as day,
    o_orderkey % 12 + 1 as race_no,
    o_custkey % 6 + 1 as r1, cast(floor(o_custkey / 6) as bigint) % 6 + 1 as r2,
    cast(floor(o_custkey / 36) as bigint) % 6 + 1 as r3,
    o_totalprice as payout, case when o_custkey % 17 <> 0 then o_custkey % 120 + 1 end as popularity,
    o_orderstatus <> 'P' as valid from orders)""",
    "snapshots": """snapshots as (
  select user_id, cast(ts as date) as day, cast(floor(max(value)) as bigint) % 4 as rate
  from events group by 1, 2)""",
    "scored": """scored as (
  select l_orderkey as race_id, l_linenumber as line, l_partkey as part, l_suppkey as supp, l_shipdate as ts,
    cast(l_returnflag = 'R' as bigint) as y, (l_discount * 100 + l_quantity) / 64 as score,
    l_quantity, l_extendedprice, l_discount, l_tax from lineitem)""",
}


def lens(*names: str) -> str:
    """``with ...`` clause of one or more lenses."""
    return "with " + ",\n".join(LENS[n] for n in names)
