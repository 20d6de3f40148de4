"""Readers. Each query writes a table out in the format and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomframe import sinks, sources
from loomframe.operators.joins import without
from workload.registry import Tables, query

ORDERS_TEXT = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
PART_TEXT = "p_partkey bigint, p_name string, p_size int"


@query(ORDERS_SQL)
def src_csv_roundtrip(t: Tables):
    path = sinks.scratch_dir(t.spark, "orders-csv")
    sinks.write_csv(t.orders.select(*ORDERS_COLS), path)
    return sources.read_csv(t.spark, path, ORDERS_TEXT)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_tsv_roundtrip(t: Tables):
    path = sinks.scratch_dir(t.spark, "supplier-tsv")
    sinks.write_csv(t.supplier, path, header=False, sep="\t")
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    return sources.read_csv(t.spark, path, schema, header=False, sep="\t")


def _order_lines(t: Tables):
    return t.orders.select(F.concat_ws(",", *ORDERS_COLS[:3]).alias("value"))


ORDER_LINE = "concat_ws(',', o_orderkey, o_custkey, o_orderstatus)"


@query(f"SELECT {ORDER_LINE} AS value FROM orders")
def src_text_lines(t: Tables):
    path = sinks.scratch_dir(t.spark, "orders-lines")
    sinks.write_lines(_order_lines(t), path)
    return sources.read_lines(t.spark, path)


@query(f"SELECT {ORDER_LINE} AS value FROM orders")
def src_header_drop(t: Tables):
    path = sinks.scratch_dir(t.spark, "orders-headed")
    sinks.write_csv(t.orders.select(*ORDERS_COLS[:3]), path, header=True)
    return sources.drop_header(sources.read_lines(t.spark, path), ",".join(ORDERS_COLS[:3]))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def src_parse_record(t: Tables):
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string"
    return sources.parse_delimited(_order_lines(t), schema)


@query("SELECT p_partkey, p_name, p_size FROM part")
def src_glob(t: Tables):
    # Two folders hold the parts, a third something else; the pattern matches the two.
    path = sinks.scratch_dir(t.spark, "part-files")
    part, small = t.part.select("p_partkey", "p_name", "p_size"), F.col("p_size") <= 25
    sinks.write_csv(part.where(small), f"{path}/parts_small")
    sinks.write_csv(part.where(~small), f"{path}/parts_large")
    sinks.write_csv(t.supplier.select("s_suppkey", "s_name"), f"{path}/other")
    return sources.read_csv(t.spark, f"{path}/parts_*", PART_TEXT)


@query("SELECT p_partkey, p_name, p_size FROM part")
def src_dir(t: Tables):
    path = sinks.scratch_dir(t.spark, "part-dir")
    sinks.write_csv(t.part.select("p_partkey", "p_name", "p_size").repartition(4), path)
    return sources.read_dir(t.spark, path, PART_TEXT)


@query(
    """
    SELECT CAST(n_regionkey AS INTEGER) AS region, count(*) AS n, CAST(1 AS BIGINT) AS regions_in_file,
        CAST(n_regionkey AS VARCHAR) || '-of-the-world' AS folder
    FROM nation GROUP BY n_regionkey
    """
)
def src_filename(t: Tables):
    path = sinks.scratch_dir(t.spark, "nation-files")
    nation = t.nation.select("n_nationkey", "n_name", F.col("n_regionkey").alias("region"))
    folders = nation.select("*", F.concat(F.col("region").cast("string"), F.lit("-of-the-world")).alias("folder"))
    folders.repartition("folder").write.option("header", True).partitionBy("folder").csv(path)
    # The region is in the rows, its folder only in the path of the file.
    read = t.spark.read.schema("n_nationkey int, n_name string, region int").csv(f"{path}/*", header=True)
    named = sources.with_source_file(read).withColumn("path", F.col("_metadata.file_path"))
    folder = F.regexp_extract("path", "folder=([^/]*)/", 1)
    regions = F.count_distinct("region")
    per_file = named.groupBy("filename", folder.alias("folder")).agg(
        F.count("*").alias("n"), regions.alias("regions_in_file"), F.max("region").alias("region")
    )
    return per_file.select("region", "n", "regions_in_file", "folder")


@query(
    """
    SELECT o_orderkey % 3 > 0 AS good, count(*) AS n,
           count(*) FILTER (o_orderkey % 3 > 0) AS parsed_prices
    FROM orders GROUP BY 1
    """
)
def src_malformed(t: Tables):
    path = sinks.scratch_dir(t.spark, "orders-malformed")
    price = F.col("o_totalprice").cast("string")
    dirty = F.when(F.col("o_orderkey") % 3 == 0, "n/a").otherwise(price)
    line = F.concat_ws(",", "o_orderkey", dirty)
    sinks.write_lines(t.orders.select(line.alias("value")), path)
    read = sources.read_with_rejects(t.spark, path, "id bigint, price double", header=False)
    good, bad = sources.split_malformed(read)
    both = good.select(F.lit(True).alias("good"), "price").unionAll(
        bad.select(F.lit(False).alias("good"), "price")
    )
    return both.groupBy("good").agg(
        F.count("*").alias("n"), F.count("price").alias("parsed_prices")
    )


@query(
    """
    SELECT id FROM (SELECT unnest(range(0, (SELECT max(o_orderkey) + 1 FROM orders))) AS id)
    WHERE id NOT IN (SELECT l_orderkey FROM lineitem)
    """
)
def src_range(t: Tables):
    # Order numbers without any line: the generated sequence minus the numbers in use.
    # The bound stays in the plan: chunks of a thousand numbers up to it, each made long where it is used.
    used = t.lineitem.select(F.col("l_orderkey").alias("id"))
    last = F.col("last")
    chunks = t.orders.agg(F.max("o_orderkey").alias("last")).where(last >= 0).select(
        last, F.explode(F.sequence(F.lit(0), F.floor(last / 1000))).alias("chunk")
    )
    upper = F.least(F.col("chunk") * 1000 + 999, last)
    ids = chunks.repartition("chunk").select(F.explode(F.sequence(F.col("chunk") * 1000, upper)).alias("id"))
    return without(ids, used, "id")


@query("SELECT CAST(c_custkey AS INTEGER) AS cust, c_nationkey AS nation, c_acctbal AS balance FROM customer")
def src_no_header(t: Tables):
    path = sinks.scratch_dir(t.spark, "customer-bare")
    sinks.write_csv(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), path, header=False)
    return sources.read_csv(t.spark, path, "cust int, nation int, balance double", header=False)


@query("SELECT n_nationkey, 'Gebühr|' || n_name AS name, CAST(n_regionkey AS INTEGER) AS region FROM nation")
def src_pipe_charset(t: Tables):
    path = sinks.scratch_dir(t.spark, "nation-latin")
    # A name that holds the separator and a letter outside ASCII, in ISO-8859-1.
    named = t.nation.select("n_nationkey", F.concat(F.lit("Gebühr|"), "n_name").alias("name"), "n_regionkey")
    named.write.csv(path, sep="|", encoding="ISO-8859-1")
    schema = "n_nationkey int, name string, region int"
    return sources.read_csv(t.spark, path, schema, header=False, sep="|", encoding="ISO-8859-1")


@query("SELECT p_partkey, p_name || ' \"new\"' AS name, p_size FROM part")
def src_quoted(t: Tables):
    path = sinks.scratch_dir(t.spark, "part-quoted")
    # Names with spaces between fields separated by spaces, and quotes within the quoted.
    named = t.part.select("p_partkey", F.concat("p_name", F.lit(' "new"')).alias("name"), "p_size")
    sinks.write_csv(named, path, header=False, sep=" ")
    return sources.read_csv(t.spark, path, "p_partkey bigint, name string, p_size int", header=False, sep=" ")


@query("SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, s_acctbal FROM supplier")
def src_inferred(t: Tables):
    path = sinks.scratch_dir(t.spark, "supplier-inferred")
    sinks.write_csv(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), path)
    return sources.read_dir(t.spark, path)


@query("SELECT p_partkey, p_brand, p_size FROM part WHERE p_size > 25")
def src_table(t: Tables):
    name = f"part_{sinks.scratch_dir(t.spark, 'part').rsplit('-', 1)[-1]}"
    sinks.register_external(t.spark, name, f"{t.sf_dir}/part.parquet")
    table = t.spark.table(name).where(F.col("p_size") > 25)
    return table.select("p_partkey", "p_brand", "p_size")
