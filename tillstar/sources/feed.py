"""Invoice lines derived from the supplied order tables, with deterministic dirt.

`l_orderkey`, `l_partkey` and `o_custkey` arithmetic decides which cells are
broken, so another engine can state the same feed in SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.spread import hot_keys_of, is_small, join_unique
from tillstar.schemas import RAW

# Country of each nation key, 0 to 24.
COUNTRIES = (
    "United Kingdom", "Germany", "France", "EIRE", "Spain", "Netherlands", "Belgium", "Switzerland",
    "Portugal", "Australia", "Norway", "Italy", "Channel Islands", "Finland", "Cyprus", "Sweden",
    "Austria", "Denmark", "Japan", "Poland", "United States", "Canada", "Singapore", "Unspecified",
    "New Zealand",
)


def _at_least_one_task_per_core(scan: DataFrame) -> DataFrame:
    """A small file is one task, which all later steps would inherit; deal its rows
    out. A scan with enough partitions is left alone."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw invoice lines of one scale-factor folder."""

    def table(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def joined(rows, counted, lookup, stored, key):
        # A lookup has one row per key of its stored table, and no wider ones.
        return join_unique(rows, lookup, key, None, is_small(stored), hot=hot_keys_of(counted, key))

    customer, nation, part, orders = map(table, ("customer", "nation", "part", "orders"))
    countries = nation.select("n_nationkey")
    buyers = customer.select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    items = part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_retailprice")
    heads = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    # Numbered in the scan, so that equal lines of a hot key can be told apart when dealt out.
    lines = table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", (F.col("l_returnflag") == "R").alias("_returned"),
        F.monotonically_increasing_id().alias("_line"),
    )
    # The order heads are put together first, so that lines are joined only twice; texts of the
    # parts come last, so that no shuffle of lines carries them.
    located = joined(buyers, buyers, countries, nation, "n_nationkey")
    bought = joined(heads, heads, located, customer, "o_custkey")
    sold = joined(_at_least_one_task_per_core(lines), lines, bought, orders, "l_orderkey")
    lines = joined(sold, lines, items, part, "l_partkey")
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    returned = (F.col("_returned") & (order % 10 == 0)) | (F.col("o_custkey") % 103 == 0)
    # Some lines arrive twice: emitted here, so that the joins run once.
    twice = (order * 7 + F.col("l_linenumber")) % 53 == 0
    copies = F.array_repeat(F.lit(1), F.when(twice, 2).otherwise(1))
    type_, name = F.col("p_type"), F.col("p_name")
    return lines.select(
        F.when(returned, F.concat(F.lit("C"), order.cast("string")))
        .otherwise(order.cast("string")).alias("invoice_no"),
        F.concat(F.lit("P"), part.cast("string")).alias("stock_code"),
        F.when(part % 50 == 0, None)
        .when(part % 7 == 0, name)
        .when(order % 13 == 0, F.concat(name, F.lit(" SET OF "), type_))
        .otherwise(F.concat(type_, F.lit(" "), name)).alias("description"),
        F.when(returned, -F.col("l_quantity"))
        .when(order % 997 == 0, F.col("l_quantity") * 100)
        .otherwise(F.col("l_quantity")).cast("int").alias("quantity"),
        F.when(order % 211 == 0, "not-a-date")
        .otherwise(F.col("o_orderdate").cast("string")).alias("invoice_date"),
        F.when(order % 89 != 0, F.round("p_retailprice", 2).cast("decimal(18,4)")).alias("unit_price"),
        F.when(F.col("o_custkey") % 101 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.element_at(F.array(*map(F.lit, COUNTRIES)), F.col("n_nationkey") + 1).alias("country"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy").to(RAW)
