"""Sinks and sources together: tables written as files or pages, and read back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatlane.functions import text as tx
from heatlane.operators import joins
from heatlane.plans import lenses, master
from heatlane.plans.lenses import table
from heatlane.plans.registry import lens, query, r, rounded
from heatlane.session import scratch_path
from heatlane.sources import files, racing


@query("parquet_round_trip", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders")
def parquet_round_trip(spark, sf):
    path = scratch_path(spark, "parquet")
    files.write_parquet(table(spark, sf, "orders"), path, ["o_orderstatus"])
    return files.read_parquet(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    """Cells with commas and quotes."""
    c = table(spark, sf, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.cast("string").alias("c_custkey"), F.concat(F.col("c_name"), F.lit(', "nr" '), key.cast("string")).alias("c_name"),
        F.col("c_nationkey").cast("string").alias("nation,key"), (key % 2 == 0).alias("even"),
    )


CSV_SQL = """select cast(c_custkey as varchar) as c_custkey, c_name || ', "nr" ' || cast(c_custkey as varchar) as c_name,
 cast(c_nationkey as varchar) as nation_key, case when c_custkey % 2 <> 0 then 'more' end as extra from customer"""


@query("csv_mixed_headers", CSV_SQL)
def csv_mixed_headers(spark, sf):
    """Two sinks with other column orders in one folder, with and without a byte order mark."""
    c, path = _customers(spark, sf), scratch_path(spark, "csv")
    files.write_csv(c.where("even").select("c_custkey", "nation,key", "c_name"), path)
    other = c.where("not even").select("c_name", F.lit("more").alias("extra"), "c_custkey", "nation,key")
    other.write.mode("append").option("header", True).option("escape", '"').csv(path)
    return files.scan_daily_csv(spark, path).select("c_custkey", "c_name", F.col("`nation,key`").alias("nation_key"), "extra")


def _as_latin(c: Column) -> Column:
    """Windows Japanese bytes, one character a byte, for a Latin-1 sink."""

    def encode(values: pd.Series) -> pd.Series:
        return values.map(lambda t: t.encode(files.JAPANESE).decode("latin-1"))

    return F.pandas_udf(encode, "string")(c)


@query("csv_lenient", """select cast(c_custkey as varchar) as c_custkey, case when c_custkey % 2 = 0 then '桐生' else 'ソ戸田表' end as place from customer""")
def csv_lenient(spark, sf):
    """UTF-8 and Windows Japanese files with other header orders."""
    c, path = _customers(spark, sf), scratch_path(spark, "lenient")
    files.write_csv(c.where("even").select("c_custkey", F.lit("桐生").alias("place")), path)
    japanese = c.where("not even").select(F.lit("ソ戸田表").alias("place"), "c_custkey")
    japanese = japanese.select(_as_latin(F.col("place")).alias("place"), "c_custkey")
    japanese.write.mode("append").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return files.scan_csv_lenient(spark, path).select("c_custkey", "place")


@query("versioned_prior", f"""select o_orderpriority as priority, {r('avg(o_totalprice)', 6)} as mean, '20240101' as built_from,
 '20241231' as built_to, cast(200 as int) as m_strength, 'v2' as version from orders group by 1""")
def versioned_prior(spark, sf):
    """The second of two builds is the latest."""
    prior = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.avg("o_totalprice").alias("mean"))
    root = scratch_path(spark, "versions")
    files.write_versioned(prior.limit(1), root, "price", "20230101", "20231231", {"m_strength": 100})
    files.write_versioned(prior, root, "price", "20240101", "20241231", {"m_strength": 200}, "v2")
    return rounded(files.read_latest(spark, root, "price"), 6)


@query("versioned_build", f"""select o_orderpriority as priority, {r('avg(o_totalprice)', 6)} as mean, '20240101' as built_from,
 '20241231' as built_to, cast(100 as int) as m_strength, 'v1' as version from orders group by 1""")
def versioned_build(spark, sf):
    """A build by its period, after it was repeated and a later one became the latest."""
    prior = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.avg("o_totalprice").alias("mean"))
    root = scratch_path(spark, "versions")
    files.write_versioned(prior.limit(1), root, "price", "20240101", "20241231", {"m_strength": 100})
    files.write_versioned(prior, root, "price", "20240101", "20241231", {"m_strength": 100})
    files.write_versioned(prior.limit(2), root, "price", "20250101", "20251231", {"m_strength": 200}, "v2")
    return rounded(files.read_build(spark, root, "price", "20240101", "20241231"), 6)


@query("duplicate_samples", """select l_partkey, count(*) as n from lineitem group by 1 having count(*) > 1 order by n desc, l_partkey limit 10""")
def duplicate_samples(spark, sf):
    """The ten worst keys of an error message."""
    return joins.duplicate_keys(table(spark, sf, "lineitem"), ["l_partkey"]).orderBy(F.col("n").desc(), "l_partkey").limit(10)


@query("conversion_report", f"""{lens('boats')}, t as (select
 try_cast(translate(replace(trim(rank_raw), '　', ''), '１２３４５６', '123456') as bigint) as rank, price from boats)
select 'rank' as "column", count(*) as n, count(*) - count(rank) as n_null from t
union all select 'weight', count(*), count(*) - count(price) filter (where price < 50000) from t""")
def conversion_report(spark, sf):
    """Rows and nulls of cast columns, with cells that don't parse."""
    b = lenses.boats(spark, sf)
    raw = b.select(F.col("rank_raw").alias("rank"), F.when(F.col("price") < 50000, F.col("price").cast("string")).otherwise("-").alias("weight"))
    return master.conversion_report(master.cast_and_clean(raw))


@query("start_mean_cells", f"""with c as (select event_id, case when event_id % 5 = 0 then '-' when event_id % 5 = 1 then '' else '0.' || lpad(cast(event_id % 37 as varchar), 2, '0') end as cell from events)
select event_id, {r("case when cell = '-' then 0.19 else try_cast(nullif(cell, '') as double) end")} as start from c""")
def start_mean_cells(spark, sf):
    e = table(spark, sf, "events").select("event_id")
    k = F.col("event_id")
    cell = F.when(k % 5 == 0, "-").when(k % 5 == 1, "").otherwise(F.concat(F.lit("0."), F.lpad((k % 37).cast("string"), 2, "0")))
    return rounded(e.select("event_id", tx.to_number(tx.start_mean(cell)).alias("start")))


RANKING_HEAD = (
    '<table><thead><tr><th rowspan="2">順位</th><th colspan="2">モーター</th><th colspan="2">ボート</th>'
    '<th rowspan="2">前検タイム</th></tr><tr><th>番号</th><th>2連対率</th><th>番号</th><th>2連対率</th></tr></thead><tbody>'
)


def ranking_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One ranking page per day and venue, of up to sixty motors, out of lineitem."""
    li = table(spark, sf, "lineitem")
    cells = li.groupBy(
        F.date_format("l_shipdate", "yyyyMMdd").alias("day"), (F.col("l_suppkey") % 24 + 1).alias("venue"), (F.col("l_partkey") % 60).alias("motor")
    ).agg(F.min("l_quantity").cast("int").alias("q"), F.min("l_discount").cast("decimal(4,2)").alias("d"))
    row = F.format_string(
        "<tr><td>%d位</td><td>No.%d</td><td>%s</td><td>%d</td><td>1%%</td><td>%s秒</td></tr>",
        F.col("q"), F.col("motor"), F.when(F.col("d") == 0, "-").otherwise(F.concat((F.col("d") * 100).cast("int").cast("string"), F.lit("%"))),
        F.col("q"), F.concat(F.lit("6."), F.lpad((F.col("q") % 100).cast("string"), 2, "0")),
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("motor", row.alias("row")))), lambda x: x["row"]), "")
    pages = cells.groupBy("day", "venue").agg(body.alias("body"))  # sixty motors at most
    name = F.concat(F.lit("rankingmotor"), F.col("day"), F.lit("_"), F.lpad(F.col("venue").cast("string"), 2, "0"))
    return pages.select(name.alias("page_id"), F.concat(F.lit(RANKING_HEAD), F.col("body"), F.lit("</tbody></table>")).alias("html"))


@query("motor_snapshot_pages", """with c as (
 select strftime(cast(l_shipdate as date), '%Y%m%d') as day, l_suppkey % 24 + 1 as venue, l_partkey % 60 as motor,
  cast(min(l_quantity) as int) as q, cast(min(l_discount) as decimal(4,2)) as d from lineitem group by 1, 2, 3)
select day || '_' || lpad(cast(venue as varchar), 2, '0') as snapshot_id, cast(venue as int) as code, cast(motor as int) as motor_number,
 cast(q as bigint) as motor_rank, round(cast('6.' || lpad(cast(q % 100 as varchar), 2, '0') as double), 6) + cast(0.0 as double) as time_zenken,
 round(case when d > 0 then cast(cast(d * 100 as int) as double) end, 6) + cast(0.0 as double) as motor_2rentai_rate from c""")
def motor_snapshot_pages(spark, sf):
    """Two-row page headers flattened and every motor read back."""
    out = racing.extract_motor_snapshot(ranking_pages(spark, sf)).drop("date")
    return rounded(out.withColumn("motor_rank", F.col("motor_rank").cast("long")), 6)
