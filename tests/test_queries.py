"""Registered queries against their SQL counterparts, and what their plans look like."""

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries as all_queries
from catalog_queries import QUERIES
from tests.check_oracles import TABLES, compare
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def queries():
    """Those of the shop library; optional operators have tests of their own."""
    return {n: q for n, q in all_queries().items() if n in QUERIES}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    result, _ = compare(spark, con, name, SF)
    assert result.startswith("ok"), result


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and all(0 <= r.kept <= 1.5 for r in rows)


def test_names():
    assert set(oracle_sql()) <= set(all_queries()) and set(QUERIES) <= set(oracle_sql())


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


PLAIN = [n for n in queries() if not n.startswith(("stream_", "similar_topk", "crawl_job", "scrape_job", "bfs_", "walk_", "classify"))]


def test_no_cross_joins(spark):
    for name in PLAIN:
        plan = physical(queries()[name](spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from shopflow.operators import shops as S

    path = str(tmp_path / "shops")
    spark.createDataFrame([("a", "NEVER#", "NEVER#", "COUNTRY#DE", "x" * 50)], "domain string, last_crawled_end string, last_scraped_end string, shop_country string, shop_image string"
                          ).write.partitionBy("shop_country").parquet(path)
    plan = physical(S.candidates(spark.read.parquet(path), "crawl", "2026").select("domain"))
    assert "shop_image" not in plan and "PartitionFilters: [isnotnull(shop_country" in plan
    urls = str(tmp_path / "urls")
    spark.createDataFrame([("d", "u", "product", "h")], "domain string, url string, type string, hash string").write.parquet(urls)
    plan = physical(S.product_urls(spark.read.parquet(urls), "d"))
    assert "EqualTo(type,product)" in plan and "EqualTo(domain,d)" in plan and "hash" not in plan.split("ReadSchema")[1]


def test_bucketed_change_detection_needs_no_shuffle(spark):
    from shopflow.operators import pages as P
    from shopflow.sources import store

    df = spark.range(100).select(F.lit("d").alias("domain"), F.col("id").cast("string").alias("url"), F.lit("t").alias("markdown"))
    try:
        store.save_by_key(df, "t_pages", ["domain", "url"], 4)
        store.save_by_key(df.select("domain", "url", F.lit("h").alias("hash")), "t_urls", ["domain", "url"], 4)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = physical(P.with_change(spark.table("t_pages"), spark.table("t_urls")))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.sql("DROP TABLE IF EXISTS t_pages")
        spark.sql("DROP TABLE IF EXISTS t_urls")


def test_walk_does_not_shuffle_the_graph(spark):
    from shopflow.operators.crawl import links_of
    from shopflow.runtime import bucketed

    graph = spark.range(100).select(F.col("id").cast("string").alias("src_url"), (F.col("id") % 3).alias("salt"), F.lit("x").alias("dst_url"))
    frontier = spark.range(5).select(F.col("id").cast("string").alias("src_url"), (F.col("id") % 3).alias("salt"))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        with bucketed(graph, ["src_url", "salt"], "g") as stored:
            joined = links_of(frontier, stored)
            assert physical(joined).count("Exchange") == 1 and joined.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_paging_keeps_only_one_page_per_task(spark):
    assert "TakeOrderedAndProject" in physical(queries()["keyset_page"](spark, SF))


@pytest.mark.parametrize("name", ["stream_urls", "stream_registration"])
def test_streams_read_tables_of_several_files(spark, tmp_path, name):
    pages = [(i, f"http://www.shop{i % 7}.{('example.com', 'example.org')[i % 2]}/p/{i}", "<p>x</p>") for i in range(40)]
    docs = [(i, f"text {i}", ("de", "en")[i % 2], f"src{i % 3}") for i in range(120)]
    views = duckdb.connect()
    for table, rows, schema in (("pages", pages, "page_id long, url string, html string"), ("documents", docs, "doc_id long, text string, lang string, source string")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
        views.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    result, _ = compare(spark, views, name, str(tmp_path))
    assert result.startswith("ok") and int(result.split()[1]) > 0, result


@pytest.mark.parametrize("by", ["lang", "source"])
def test_stream_reads_a_table_of_partition_folders(spark, tmp_path, by):
    docs = [(i, f"text {i}", ("de", "en")[i % 2], f"src{i % 3}") for i in range(120)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.partitionBy(by).parquet(f"{tmp_path}/documents.parquet")
    views = duckdb.connect()
    views.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*/*.parquet', hive_partitioning = true)")
    result, _ = compare(spark, views, "stream_urls", str(tmp_path))
    assert result.startswith("ok") and int(result.split()[1]) > 0, result
