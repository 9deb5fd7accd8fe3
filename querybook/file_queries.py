"""Files that the jobs write and read, compared by content: inbox deliveries, backups, exports, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from querybook import adapters
from querybook import sql_parts as sql
from querybook.registry import ORACLES, query
from querybook.sink_queries import _written
from querybook.warehouse_queries import _dim, clean_tables, fact
from salesloom.functions.money import MONEY, as_doubles
from salesloom.operators import marts, products, quality
from salesloom.plans.run import Paths, materialize_inbox
from salesloom.session import shared_dir
from salesloom.sinks import files
from salesloom.sources import csv_files, inbox, pages, tables

_PLAIN_ORDERS = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS order_amount,
  CAST(o_orderdate AS DATE) AS order_date FROM orders"""


def _order_columns(spark: SparkSession, folder: str) -> DataFrame:
    return adapters.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customerId"),
        F.col("o_totalprice").cast(MONEY).cast("string").alias("total"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("createdAt"),
    )


@query(_PLAIN_ORDERS)
def inbox_large_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Four files, each one JSON array, read in byte ranges: items, texts with brackets in them and elements that are no objects."""
    root = f"{shared_dir(spark, 'inbox-arrays')}/orders"
    part = F.col("id") % 4
    order = F.struct("*", F.when(F.col("id") % 3 == 0, '}"{],').alias("note"))
    rows = _order_columns(spark, folder).select(part.alias("part"), F.lit(1).alias("place"), F.concat(F.lit(","), F.to_json(order)).alias("value"))
    ends = spark.range(4).select(F.col("id").alias("part"), F.explode(F.array(F.struct(F.lit(0).alias("place"), F.lit("[5").alias("value")),
                                                                            F.struct(F.lit(2).alias("place"), F.lit(', "x", [1]]').alias("value")))).alias("e"))
    lines = rows.unionByName(ends.select("part", "e.*"))
    lines.repartition("part").sortWithinPartitions("part", "place").select("part", "value").write.partitionBy("part").text(root)
    records = inbox.json_file_records(spark, root, "orders", split_from=0)
    return as_doubles(inbox.inbox_orders(records))


@query(_PLAIN_ORDERS)
def inbox_csv_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders delivered as CSV with alias names, found by the file choice of the inbox."""
    root = shared_dir(spark, "inbox-csv")
    files.write_csv(_order_columns(spark, folder), f"{root}/orders.csv")
    return as_doubles(inbox.inbox_orders(inbox.inbox_records(spark, root, "orders"), cut_ids=False))


@query(
    f"""WITH {sql.PLACES} SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS city, lower(c_mktsegment) AS customer_level,
  'customers' AS kind FROM places UNION ALL
SELECT o_orderkey, NULL, CAST(o_orderdate AS DATE)::VARCHAR, NULL, 'orders' FROM orders"""
)
def materialized_inbox(spark: SparkSession, folder: str) -> DataFrame:
    """What an inbox run writes as raw CSV files, read again: customers from CSV, orders from a JSON array."""
    paths = Paths(shared_dir(spark, "inbox-run"))
    people = adapters.places(spark, folder).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("defaultCity"),
        F.col("c_mktsegment").alias("level"),
    )
    files.write_csv(people, f"{paths.inbox}/customers.csv")
    # One document a file: each holds the array of a sixteenth of the orders, written order by order.
    in_part = Window.partitionBy("part").orderBy("id")
    begins, ends = F.lag(F.lit(1)).over(in_part).isNull(), F.lead(F.lit(1)).over(in_part).isNull()
    orders = _order_columns(spark, folder).withColumn("part", F.col("id") % 16).select("*", begins.alias("begins"), ends.alias("ends"))
    text = F.concat(F.when(F.col("begins"), "[").otherwise(","), F.to_json(F.struct("id", "customerId", "total", "createdAt")), F.when(F.col("ends"), "]").otherwise(""))
    orders.select("part", text.alias("value")).write.partitionBy("part").text(f"{paths.inbox}/orders.json")
    materialize_inbox(spark, paths)
    customers = csv_files.customers_csv(spark, paths.customers, multiline=True).withColumn("kind", F.lit("customers"))
    loaded = csv_files.orders_csv(spark, paths.orders, multiline=True).select(
        F.col("order_id").alias("customer_id"), F.lit(None).cast("string").alias("customer_name"), F.col("order_date").cast("string").alias("city"),
        F.lit(None).cast("string").alias("customer_level"), F.lit("orders").alias("kind"),
    )
    return customers.unionByName(loaded)


@query(
    f"""WITH {sql.WAREHOUSE} SELECT 'raw_customers' AS table_name, customer_id AS row_id, customer_name AS label, city AS place, NULL::DOUBLE AS amount FROM raw_customers
UNION ALL SELECT 'fact_orders', order_id, order_month, ship_country, CAST(net_amount AS DOUBLE) FROM fact_orders"""
)
def backup_content(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with blanks around their texts and the facts, read back from the CSV backup with the own reader."""
    paths = {p.rpartition("/")[2]: p for p in files.export_layer_backups(_written(spark, folder), shared_dir(spark, "backup"))}
    customers = csv_files.customers_csv(spark, paths["raw_customers"], multiline=True).select(
        F.lit("raw_customers").alias("table_name"), F.col("customer_id").alias("row_id"), F.col("customer_name").alias("label"),
        F.col("city").alias("place"), F.lit(None).cast("double").alias("amount"),
    )
    facts = csv_files.read_csv_text(spark, paths["fact_orders"], multiline=True).select(
        F.lit("fact_orders").alias("table_name"), F.col("order_id").cast("bigint").alias("row_id"), F.col("order_month").alias("label"),
        F.col("ship_country").alias("place"), F.col("net_amount").cast("double").alias("amount"),
    )
    return customers.unionByName(facts)


@query(
    f"""WITH {sql.WAREHOUSE}, {sql.SUMMARY} SELECT summary_key,
  row_number() OVER (ORDER BY order_month, city, customer_level, currency_code)::INTEGER AS export_rank FROM mart_sales_summary"""
)
def export_order(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every row of the sorted export: by file, byte range and line."""
    path = f"{shared_dir(spark, 'export')}/sales_summary.csv"
    files.export_summary(marts.mart_sales_summary(fact(spark, folder), _dim(spark, folder)), path)
    rows = spark.read.option("header", True).csv(path).select(
        "summary_key", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
    )
    # The summary has one row a month and group: its ranks are one small window.
    return rows.select("summary_key", F.row_number().over(Window.orderBy("file", "block", "line")).alias("export_rank"))


@query(ORACLES["quality_report"])
def quality_report_file(spark: SparkSession, folder: str) -> DataFrame:
    """The checks as read back from the JSON report."""
    path = f"{shared_dir(spark, 'quality')}/report.json"
    return files.write_quality_report(quality.quality_checks(spark, clean_tables(spark, folder)), path)


@query(
    """SELECT 'gid://shop/Product/' || p_partkey AS product_id, 'shop.example' AS store_domain, (SELECT count(*) FROM part) AS product_count,
  CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS min_price FROM part"""
)
def product_export(spark: SparkSession, folder: str) -> DataFrame:
    """The exported product nodes, read back next to the row of the export's meta file."""
    path = shared_dir(spark, "products")
    nodes = pages.product_nodes(adapters.product_pages(spark, folder))
    meta = files.export_products(nodes, path, "shop.example").select("store_domain", "product_count")
    read = spark.read.schema(nodes.schema["node"].dataType).json(f"{path}/products")
    rows = products.products(read.select(F.struct("*").alias("node"))).select("product_id", "min_price")
    return as_doubles(rows.withColumn("store_domain", F.lit("shop.example")).join(meta, "store_domain"))


@query(
    f"""WITH {sql.WAREHOUSE}, {sql.CITY} SELECT 'mart_city_sales' AS table_name, 2000 AS shown_rows, least(count(*), 2000) AS row_count,
  count(*) FILTER (WHERE false) = 0 AS allowed FROM mart_city_sales"""
)
def preview_of_table(spark: SparkSession, folder: str) -> DataFrame:
    """A preview with more rows asked for than are shown: limit, rows and cells as JSON."""
    warehouse = _written(spark, folder)
    shown = tables.preview(warehouse, "mart", "mart_city_sales", "99999")
    rows = tables.json_rows(shown).agg(F.count("*").alias("row_count"), F.bool_and(F.get_json_object("row", "$.city").isNotNull()).alias("allowed"))
    return rows.select(F.lit("mart_city_sales").alias("table_name"), F.lit(tables.row_limit("99999")).alias("shown_rows"), "row_count", "allowed")
