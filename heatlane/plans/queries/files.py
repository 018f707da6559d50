"""Content store, page extraction and file listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from heatlane.plans.lenses import table
from heatlane.plans.registry import query, r, rounded
from heatlane.session import durable, scratch_path
from heatlane.sources import manifest, markup, vault

PATH = "source || '/' || lang || '_' || cast(20240101 + doc_id % 28 as varchar) || '_' || cast(doc_id as varchar) || '.bin'"
FILES = f"files as (select {PATH} as rel_path, cast(doc_id as double) as mtime, strlen(text) as size, sha256(text) as sha256, text, source, cast(20240101 + doc_id % 28 as varchar) as date_ymd from documents)"


def files_of(spark, sf):
    d = table(spark, sf, "documents")
    path = F.concat(
        "source", F.lit("/"), "lang", F.lit("_"), (F.lit(20240101) + F.col("doc_id") % 28).cast("string"), F.lit("_"),
        F.col("doc_id").cast("string"), F.lit(".bin"),
    )
    content = F.encode("text", "UTF-8")
    return d.select(
        path.alias("rel_path"), F.col("doc_id").cast("double").alias("mtime"),
        F.octet_length("text").cast("long").alias("size"), content.alias("content"),
    )


@query("vault_objects", f"with {FILES} select sha256, min(size) as size, cast(0 as int) as is_gzip, md5(min(text)) as digest from files group by 1")
def vault_objects(spark, sf):
    """With a digest of the bytes, so that they are read."""
    return vault.vault_objects(files_of(spark, sf)).withColumn("digest", F.md5("bytes")).drop("bytes")


@query("vault_objects_gzip", f"with {FILES} select sha256, min(size) as size, cast(1 as int) as is_gzip from files group by 1")
def vault_objects_gzip(spark, sf):
    return vault.vault_objects(files_of(spark, sf), compress=True).where(F.length("bytes") > 0).drop("bytes")


@query("vault_index", f"with {FILES} select rel_path, mtime, size, sha256, date_ymd from files")
def vault_index(spark, sf):
    return vault.vault_index(files_of(spark, sf), r"_([0-9]{8})_")


@query(
    "vault_select",
    f"with {FILES} select rel_path, sha256, size, text from files where rel_path like 'src1/%'",
)
def vault_select(spark, sf):
    files = files_of(spark, sf)
    out = vault.vault_select(vault.vault_index(files), vault.vault_objects(files), "src1/%")
    return out.select("rel_path", "sha256", "size", F.decode("bytes", "UTF-8").alias("text"))


@query(
    "vault_export",
    f"with {FILES} select rel_path, cast(size as bigint) as written, sha256 from files where rel_path like 'src1/%'",
)
def vault_export(spark, sf):
    """Files written out and read back from the folder."""
    files, folder = files_of(spark, sf), scratch_path(spark, "export")
    out = vault.vault_select(vault.vault_index(files), vault.vault_objects(files, compress=True), "src1/%")
    written = durable(vault.vault_export(out, folder), "written")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    found = found.select(F.substring_index("path", "/", -2).alias("rel_path"), F.sha2("content", 256).alias("sha256"))
    return written.join(found, "rel_path")


@query(
    "ingest_counts",
    f"""with {FILES}, o as (select distinct sha256 from files where source = 'src0')
select count(*) as n_files, count(distinct f.sha256) filter (where o.sha256 is null) as n_new,
 count(*) - count(distinct f.sha256) filter (where o.sha256 is null) as n_duplicate from files f left join o on f.sha256 = o.sha256""",
)
def ingest_counts(spark, sf):
    index = vault.vault_index(files_of(spark, sf))
    stored = vault.vault_folders(index, ["src0"]).select("sha256").distinct()
    return vault.ingest_counts(index, stored)


UPSERT_SQL = f"""with {FILES} select rel_path, case when source = 'src1' then mtime + 1 else mtime end as mtime, size,
 case when source = 'src1' then 'changed' else sha256 end as sha256 from files"""


@query("upsert_index", UPSERT_SQL)
def upsert_index(spark, sf):
    old = vault.vault_index(files_of(spark, sf))
    new = vault.vault_folders(old, ["src1"]).withColumn("mtime", F.col("mtime") + 1).withColumn("sha256", F.lit("changed"))
    stale = vault.vault_folders(old, ["src2"]).withColumn("mtime", F.col("mtime") - 1)
    return vault.upsert_index(old, new.unionByName(stale)).drop("date_ymd")


@query("upsert_stored", UPSERT_SQL)
def upsert_stored(spark, sf):
    """The same on a stored index of hash buckets: a first load, then two upserts."""
    root = scratch_path(spark, "index")
    old = durable(vault.vault_index(files_of(spark, sf)), "hashed")
    new = vault.vault_folders(old, ["src1"]).withColumn("mtime", F.col("mtime") + 1).withColumn("sha256", F.lit("changed"))
    stale = vault.vault_folders(old, ["src2"]).withColumn("mtime", F.col("mtime") - 1)
    for part in (old, new, stale):
        vault.store_index(part, root, buckets=16)
    return manifest.read_buckets(spark, root).drop("date_ymd")


@query(
    "vault_summary",
    f"with {FILES} select source as folder, count(*) as n_files, {r('sum(size) / cast(1048576.0 as double)')} as mb from files group by 1",
)
def vault_summary(spark, sf):
    return rounded(vault.vault_summary(vault.vault_index(files_of(spark, sf))))


@query(
    "files_by_date",
    f"with {FILES} select rel_path, date_ymd from files where date_ymd between '20240105' and '20240110'",
)
def files_by_date(spark, sf):
    out = vault.files_by_date(files_of(spark, sf), "20240105", "20240110", pattern=r"_([0-9]{8})_")
    return out.select("rel_path", "date_ymd")


@query(
    "day_coverage",
    f"""with {FILES}, d as (select cast(unnest(generate_series(date '2024-01-01', date '2024-01-31', interval 1 day)) as date) as date)
select d.date, count(rel_path) as n_files from d left join files on date_ymd = strftime(d.date, '%Y%m%d') group by 1""",
)
def day_coverage(spark, sf):
    days = vault.day_grid(spark, "2024-01-01", "2024-01-31")
    listing = vault.files_by_date(files_of(spark, sf), None, None, pattern=r"_([0-9]{8})_")
    counts = listing.groupBy(F.to_date("date_ymd", "yyyyMMdd").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "date", "left").select("date", F.coalesce("n", F.lit(0)).cast("long").alias("n_files"))


LINK = """'<a href="([^"]*)">([^<]*)</a>'"""


@query(
    "extract_links",
    f"""with l as (select page_id, unnest(regexp_extract_all(html, {LINK}, 1)) as ref, unnest(regexp_extract_all(html, {LINK}, 2)) as text,
 generate_subscripts(regexp_extract_all(html, {LINK}, 1), 1) as pos from pages)
select cast(page_id as varchar) as page_id, pos, ref, replace(trim(text), '&amp;', '&') as text from l""",
)
def extract_links(spark, sf):
    pages = table(spark, sf, "pages")
    links = markup.page_elements(pages, ["a"])
    return links.select("page_id", (F.col("seq") + 1).cast("long").alias("pos"), "ref", "text")


@query(
    "extract_text_cells",
    """with l as (select page_id, unnest(regexp_extract_all(html, '<li>(?:<[^>]*>)*([^<]*)', 1)) as text,
 generate_subscripts(regexp_extract_all(html, '<li>', 0), 1) as pos from pages)
select cast(page_id as varchar) as page_id, pos, replace(trim(text), '&amp;', '&') as text from l""",
)
def extract_text_cells(spark, sf):
    items = markup.page_elements(table(spark, sf, "pages"), ["li"])
    return items.select("page_id", (F.col("seq") + 1).cast("long").alias("pos"), "text")


# The SQL has no entity decoder, so it spells out the entities of HTML text.
TITLES = """select cast(page_id as varchar) as page_id, cast({n} as int) as seq, '{t}' as tag,
 trim(regexp_replace(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<{t}>([^<]*)</{t}>', 1), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#39;', ''''), '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) as text from pages"""


@query("page_titles", TITLES.format(n=0, t="title") + " union all " + TITLES.format(n=1, t="h1"))
def page_titles(spark, sf):
    """Titles and headings of every page."""
    return markup.page_elements(table(spark, sf, "pages"), ["title", "h1"]).select("page_id", "seq", "tag", "text")
