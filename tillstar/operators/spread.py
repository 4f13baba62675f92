"""Equi-joins that spread frequent keys over many tasks."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.columns import text_columns

# A lookup of up to this many bytes is broadcast.
MAX_BROADCAST_BYTES = 24 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame's rows in memory: 8 bytes a row and a column, and all texts."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c in text_columns(df)]
    row = F.lit(8 * (1 + len(df.columns)))
    for text in texts:
        row = row + text
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def is_small(lookup: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a lookup, measured over all its rows, may be broadcast."""
    return measured_bytes(lookup) <= max_bytes


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def fair_shares(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(counts: DataFrame, key: str) -> DataFrame:
    """Keys above one fair share of all rows, with the number of shares they fill.

    A fair share is the row total divided by the number of shuffle partitions P.
    Fewer than P keys can exceed it, which bounds this frame.
    """
    shares = fair_shares(counts)
    total = counts.agg(F.sum("n").alias("n")).scalar()
    filled = F.col("n") * shares / total
    return counts.where(F.col(key).isNotNull() & (filled > 1)).select(
        key, F.ceil(filled).cast("int").alias("_shares")
    )


# Buckets per fair share in which keys are counted first.
_BUCKETS = 8


def hot_keys_of(df: DataFrame, key: str) -> DataFrame:
    """`hot_keys` of keys that are not counted yet, without a shuffle of every key.

    Keys are counted in hashed buckets first, as few as there are fair shares, which partial
    sums make small. A key above one share makes its bucket so; only the keys of such buckets
    are counted one by one."""
    shares = fair_shares(df)
    keyed = df.select(key, F.pmod(F.xxhash64(key), F.lit(_BUCKETS * shares)).alias("_bucket"))
    buckets = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "_total", F.sum("n").over(Window.partitionBy())
    )
    full = buckets.where(F.col("n") * shares / F.col("_total") > 1).select("_bucket", "_total")
    inside = keyed.where(F.col(key).isNotNull()).join(F.broadcast(full), "_bucket")
    counts = inside.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.first("_total").alias("_total"))
    filled = F.col("n") * shares / F.col("_total")
    return counts.where(filled > 1).select(key, F.ceil(filled).cast("int").alias("_shares"))


def join_unique(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    counts: DataFrame | None,
    small: bool,
    how: str = "inner",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join many `rows` to a `lookup` with one row per key.

    A lookup known to be `small` is broadcast. Otherwise both sides are shuffled,
    and rows of a hot key are dealt out by a hash of the whole row while its
    lookup row is copied once per share; fewer than 2 P copies in all. `counts`
    holds (key, n): how often each key occurs; `hot` the hot keys, where those are
    known instead (`hot_keys_of`). Rows should differ from each other,
    as equal ones get one hash; a random number instead could change when a lost
    task is repeated.
    """
    if small:
        return rows.join(F.broadcast(lookup), key, how)
    hot = F.broadcast(hot_keys(counts, key) if hot is None else hot)
    # Rows without a key match nothing, but an outer join keeps them: deal them out, too.
    shares = F.coalesce("_shares", F.when(F.col(key).isNull(), fair_shares(rows)))
    dealt = F.pmod(F.xxhash64(*rows.columns), shares).cast("int")
    salted = (
        rows.join(hot, key, "left")
        .withColumn("_salt", F.when(shares.isNull(), 0).otherwise(dealt))
        .drop("_shares")
    )
    copies = (
        lookup.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_shares", F.lit(1)) - 1)))
        .drop("_shares")
    )
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
