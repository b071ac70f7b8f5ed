"""Loading, guarding and scanning tables; URL lists and page archives."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rowloom.functions import text as text_fn
from rowloom.plans.registry import query, table
from rowloom.session import scratch_path
from rowloom.sources import tables, web


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def load_csv_table(spark, folder):
    """The customers, written as CSV and loaded from there with a declared schema."""
    source = table(spark, folder, "customer")
    path = scratch_path(spark, "customer-csv")
    source.write.option("header", True).csv(path)
    name = f"customer_{uuid.uuid4().hex}"
    tables.load_csv_table(spark, path, source.schema, name, scratch_path(spark, name))
    return spark.table(name)


@query("SELECT doc_id, text, lang, n_chars FROM documents")
def load_parquet_drop(spark, folder):
    return tables.load_parquet(spark, f"{folder}/documents.parquet", drop=("source",))


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def identifier_scan(spark, folder):
    """Orders under a table name given in parts, counted per status."""
    table(spark, folder, "orders").createOrReplaceTempView("rowloom_orders")
    return tables.scan_named(spark, "rowloom_orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT 1 AS loads, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total_chars FROM documents")
def ensure_table(spark, folder):
    """A guarded load asked for twice: it runs once."""
    name = f"documents_{uuid.uuid4().hex}"
    location = scratch_path(spark, name)
    load = lambda: tables.save_table(table(spark, folder, "documents").select("doc_id", "n_chars"), name, location)
    loads = sum(tables.ensure_tables(spark, [name], load) for _ in range(2))
    return spark.table(name).agg(
        F.lit(loads).alias("loads"), F.count("*").alias("n"), F.sum("n_chars").alias("total_chars")
    )


@query("SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 2")
def preview_limit(spark, folder):
    return tables.preview(table(spark, folder, "documents").select("doc_id", "lang", "n_chars"), 2, "doc_id")


@query(
    """SELECT page_id // 1000 AS sitemap_id,
              CAST(row_number() OVER (PARTITION BY page_id // 1000 ORDER BY page_id) - 1 AS INTEGER) AS pos, url
       FROM pages"""
)
def sitemap_urls(spark, folder):
    """Sitemap files of up to 1,000 pages each, read back into URLs."""
    escaped = F.replace(F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    entry = F.struct("page_id", F.concat(F.lit("<url><loc>"), escaped, F.lit("</loc></url>")).alias("xml"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["xml"]), "")
    sitemaps = (
        table(spark, folder, "pages")
        .groupBy(F.floor(F.col("page_id") / 1000).cast("long").alias("sitemap_id"))
        .agg(
            F.concat(
                F.lit('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'),
                body,
                F.lit("</urlset>"),
            ).alias("xml")
        )
    )
    return web.sitemap_urls(sitemaps)


@query(
    """WITH frontier AS (SELECT url FROM pages UNION ALL SELECT url || '/missing' FROM pages),
            latest AS (SELECT url, max_by(html, page_id) AS html FROM pages GROUP BY url)
       SELECT f.url, CAST(length(l.html) AS INTEGER) AS n_chars FROM frontier f LEFT JOIN latest l ON f.url = l.url"""
)
def fetch_from_archive(spark, folder):
    """Every page's URL and one that is missing, looked up in the archive."""
    pages = table(spark, folder, "pages")
    frontier = pages.select(F.explode(F.array("url", F.concat("url", F.lit("/missing")))).alias("url"))
    return web.fetch_from_archive(frontier, pages).select("url", F.length("html").alias("n_chars"))


@query("SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS v FROM pages")
def url_filename(spark, folder):
    return table(spark, folder, "pages").select("page_id", text_fn.last_path_segment(F.col("url")).alias("v"))


@query(
    """SELECT page_id, regexp_replace(url, '^https://blog\\.', 'https://mirror.example.com/blog.') AS v
       FROM pages WHERE NOT contains(url, 'page=2')"""
)
def url_rewrite(spark, folder):
    """URLs of one address family moved to a mirror; second pages left out by a part of their name."""
    pages = table(spark, folder, "pages").where(~F.contains("url", F.lit("page=2")))
    return pages.select(
        "page_id", text_fn.rewrite_prefix(F.col("url"), "https://blog.", "https://mirror.example.com/blog.").alias("v")
    )
