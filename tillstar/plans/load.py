"""Loads: processed lines added to a star schema that is there already.

Facts of a load become a new folder and number on from the last one; what is stored is not
read again. Dimensions are merged: a row keeps its creation time, and its update time moves
only if an attribute has changed. Which values a customer or product has is decided among
all lines ever loaded, from the distinct values that are kept with the date of their first
line; so lines that come late or in parts give the same dimensions as all at once.

A load has a name, and one that is there already adds nothing, so a load can be repeated
after any failure. Lines are taken as processed: cleaning is up to the load.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.operators.clean import timestamp
from tillstar.operators.columns import has
from tillstar.operators.scratch import scratch_folder
from tillstar.plans import star
from tillstar.sources import versions
from tillstar.sources.versions import Version

_TIMES = ("created_at", "updated_at")


def merge_dimension(stored: DataFrame, fresh: DataFrame, key: str, run_ts: datetime) -> DataFrame:
    """Stored rows with the attributes of the fresh ones of their key, and the fresh rows of
    new keys. `created_at` is kept; `updated_at`, if there is one, moves where a row is new or
    an attribute differs (null is equal to null). Keys are unique on both sides."""
    attributes = [c for c in stored.columns if c not in (key, *_TIMES)]
    old = stored.select(key, F.struct(*attributes).alias("_old"), *[c for c in _TIMES if has(stored, c)])
    new = fresh.select(key, F.struct(*attributes).alias("_new"))
    joined = old.join(new, key, "full")
    is_new = F.col("_old").isNull()
    changed = is_new | (F.col("_new").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new")))
    now = timestamp(run_ts)
    times = {"created_at": F.when(is_new, now).otherwise(F.col("created_at"))}
    if has(stored, "updated_at"):
        times["updated_at"] = F.when(changed, now).otherwise(F.col("updated_at"))
    values = F.coalesce("_new", "_old")
    merged = joined.select(key, *[values[a].alias(a) for a in attributes], *[t.alias(c) for c, t in times.items()])
    return merged.select(*stored.columns)


def merge_values(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Distinct attribute values of two sets of lines, each with its first date."""
    keys = [c for c in stored.columns if c != "seen"]
    return stored.unionByName(fresh).groupBy(*keys).agg(F.min("seen").alias("seen"))


def append(spark: SparkSession, processed: DataFrame, root: str, name: str, run_ts: datetime) -> Version:
    """Add processed lines to the star below `root` as the load `name`; the first makes it."""
    root = root.rstrip("/")
    before = versions.current(spark, root)
    if name in before.loads:
        return before
    absent = [c for c in star.NEEDED if not has(processed, c)]
    if absent:
        raise ValueError(f"a star schema needs the columns {', '.join(absent)}")
    with scratch_folder(spark):
        return _append(spark, processed, root, name, run_ts, before)


def _append(
    spark: SparkSession, processed: DataFrame, root: str, name: str, run_ts: datetime, before: Version
) -> Version:
    folders = {table: list(found) for table, found in before.folders.items()}
    is_first = not before.loads

    def stored(table: str) -> DataFrame:
        return versions.read(spark, root, before, table)

    def replace(table: str, df: DataFrame) -> DataFrame:
        folders[table] = [versions.add(spark, root, table, df)]
        return spark.read.schema(df.schema).parquet(f"{root}/{folders[table][0]}")

    def merged_values(table: str, fresh: DataFrame) -> DataFrame:
        return replace(table, fresh if is_first else merge_values(stored(table), fresh))

    def merged(table: str, fresh: DataFrame, key: str) -> DataFrame:
        return replace(table, fresh if is_first else merge_dimension(stored(table), fresh, key, run_ts))

    values = merged_values("customer_values", star.customer_values(processed))
    merged("dim_customer", star.customers(values, run_ts), "customer_id")
    values = merged_values("product_values", star.product_values(processed))
    merged("dim_product", star.products(values, run_ts), "product_id")
    merged("dim_date", star.dim_date(processed, run_ts), "date_id")
    names = star.country_names(processed)
    if is_first:
        countries = replace("dim_country", star.countries(names, run_ts))
    else:
        # Numbers that facts refer to stay; new names get the next ones.
        known = stored("dim_country")
        last = known.agg(F.max("country_id")).first()[0] or 0
        new = star.countries(names.join(known, "country_name", "left_anti"), run_ts, last)
        countries = replace("dim_country", known.unionByName(new))

    facts_before = sum(load["facts"] for load in before.loads.values())
    facts = star.fact_sales(processed, countries, run_ts)
    added = versions.add(
        spark, root, "fact_sales", facts.withColumn("fact_id", F.col("fact_id") + F.lit(facts_before))
    )
    folders["fact_sales"] = [*before.folders.get("fact_sales", []), added]
    count = spark.read.parquet(f"{root}/{added}").count()
    loads = {**before.loads, name: {"facts": count, "version": before.number + 1}}
    return versions.commit(spark, root, Version(before.number + 1, folders, loads))


def tables(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The star's tables at the last version, or at an earlier one."""
    root = root.rstrip("/")
    version = versions.current(spark, root, number)
    names = ("fact_sales", "dim_customer", "dim_date", "dim_product", "dim_country")
    return {name: versions.read(spark, root, version, name) for name in names}
