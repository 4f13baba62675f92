"""Layers: one catalog database and one folder each, holding Parquet tables."""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillstar import schemas
from tillstar.operators.scratch import COMPRESSION, shuffles_released

# What to do with an existing table -> Spark save mode.
SAVE_MODES = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}

# Tables of the raw, processed and warehouse layers.
TABLES = {
    "raw": {"raw_data": schemas.RAW},
    "processed": {"processed_data": schemas.PROCESSED},
    "warehouse": {
        "dim_customer": schemas.DIM_CUSTOMER,
        "dim_date": schemas.DIM_DATE,
        "dim_product": schemas.DIM_PRODUCT,
        "dim_country": schemas.DIM_COUNTRY,
        "fact_sales": schemas.FACT_SALES,
    },
}


class Layers(NamedTuple):
    """Where a warehouse lives: its folder and its three database names."""

    root: str
    raw: str = "raw_data"
    processed: str = "processed_data"
    warehouse: str = "data_warehouse"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{getattr(self, layer)}/{table}"

    def name(self, layer: str, table: str) -> str:
        return f"{getattr(self, layer)}.{table}"


def _quoted(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _named(database: str, table: str) -> str:
    """A table name in SQL, whatever characters it has."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in (database, table))


def _plain(location: str) -> str:
    """A location without the ways to write a local one."""
    return "/" + location.removeprefix("file:").strip("/") if location.startswith(("file:", "/")) else location.rstrip("/")


def create(spark: SparkSession, layers: Layers) -> None:
    """Create the three databases where absent. Tables that a database of the same name
    has from another root are taken off the catalog; their files stay."""
    for layer in TABLES:
        database = getattr(layers, layer)
        location = f"{layers.root.rstrip('/')}/{database}"
        quoted = "`" + database.replace("`", "``") + "`"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted} LOCATION {_quoted(location)}")
        for table in spark.catalog.listTables(database):
            if table.isTemporary:
                continue
            name = _named(database, table.name)
            at = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
            if at and _plain(at.data_type) != _plain(layers.path(layer, table.name)):
                spark.sql(f"DROP TABLE {name}")


def write(
    df: DataFrame, layers: Layers, layer: str, table: str, if_exists: str = "replace"
) -> DataFrame:
    """Write a table under its contract, if it has one, and read it back. Columns of the
    contract that the frame does not have are left out."""
    contract = TABLES[layer].get(table)
    if contract is not None:
        df = df.to(StructType([f for f in contract.fields if f.name in df.columns]))
    writer = df.write.mode(SAVE_MODES[if_exists]).format("parquet")
    writer = writer.option("path", layers.path(layer, table)).option("compression", COMPRESSION)
    with shuffles_released(df.sparkSession):
        writer.saveAsTable(_named(getattr(layers, layer), table))
    return read(df.sparkSession, layers, layer, table)


def read(spark: SparkSession, layers: Layers, layer: str, table: str) -> DataFrame:
    """The table below this root, whatever the catalog calls by its name."""
    return spark.read.parquet(layers.path(layer, table))


def attach(spark: SparkSession, layers: Layers) -> None:
    """Make an already written warehouse known to this session's catalog."""
    create(spark, layers)
    for layer, tables in TABLES.items():
        for table in tables:
            path = layers.path(layer, table)
            if _exists(spark, path):
                spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {_named(getattr(layers, layer), table)} "
                    f"USING parquet LOCATION {_quoted(path)}"
                )


def _exists(spark: SparkSession, path: str) -> bool:
    """Through the cluster's own file system; a folder that cannot be read is an error."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def list_tables(spark: SparkSession, layers: Layers, layer: str) -> list[str]:
    found = spark.catalog.listTables(getattr(layers, layer))
    return sorted(t.name for t in found if not t.isTemporary)


def has_table(spark: SparkSession, layers: Layers, layer: str, table: str) -> bool:
    return spark.catalog.tableExists(layers.name(layer, table))


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """Run SQL text; tables are named database.table."""
    return spark.sql(text)
