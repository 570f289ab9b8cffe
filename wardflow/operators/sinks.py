"""Writing models: views for staging, versioned tables for everything after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Schema of each layer.
LAYER_SCHEMAS = {
    "staging": "hrrp_staging",
    "intermediate": "hrrp_marts",
    "marts": "hrrp_marts",
    "seeds": "hrrp_seeds",
}


def layer_schema(custom: str | None, default: str) -> str:
    """Schema a model goes to: the custom one as written, else the default."""
    return default if custom is None else custom.strip()


def layer_table(
    layer: str, name: str, default: str = "default", schemas: dict[str, str] | None = None
) -> str:
    """Qualified table name of a model in a layer."""
    custom = (LAYER_SCHEMAS if schemas is None else schemas).get(layer)
    return f"{layer_schema(custom, default)}.{name}"


def _make_schema(spark: SparkSession, table: str) -> None:
    schema = table.rpartition(".")[0]
    if schema:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")


def save_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temporary view; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df


def save_catalog_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Replace view ``name`` of the catalog, which other sessions see and which outlives this one.

    ``query`` may read tables and views of the catalog, no temporary ones.
    """
    _make_schema(spark, name)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def save_table(
    df: DataFrame, table: str, *, file_format: str = "parquet", path: str | None = None
) -> DataFrame:
    """Replace ``table`` by ``df`` and return a scan of what was written.

    Later stages start from that scan, so their lineage is short and a lost
    executor costs a re-read, not a recomputation of everything before.
    """
    spark = df.sparkSession
    _make_schema(spark, table)
    writer = df.write.mode("overwrite").format(file_format)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return spark.table(table)


def save_version(df: DataFrame, table: str, version: str) -> DataFrame:
    """Write ``df`` beside the data of ``table``, which stays as it is, and return a scan of it."""
    spark = df.sparkSession
    _make_schema(spark, table)
    path = _version_path(spark, table, version)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def publish_version(spark: SparkSession, table: str, version: str) -> DataFrame:
    """Point ``table`` at a written version and return it.

    Where the columns are the same only the table's location changes, in one step of the
    catalog; readers see the old rows or the new ones. The version before stays on disk
    for queries that have begun to read it; older and failed ones are deleted.
    """
    path = _version_path(spark, table, version)
    new = spark.read.parquet(path).schema
    before = None
    if spark.catalog.tableExists(table):
        same = [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in new]
        external = spark.catalog.getTable(table).tableType == "EXTERNAL"
        before = _location(spark, table) if external else None
        if same and external:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
        else:
            spark.sql(f"DROP TABLE {table}")
    if not spark.catalog.tableExists(table):
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    _drop_versions(spark, path, before)
    return spark.table(table)


def _version_path(spark: SparkSession, table: str, version: str) -> str:
    schema, _, name = table.rpartition(".")
    folder = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
    return f"{folder.rstrip('/')}/_versions/{name}/{version}"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def _drop_versions(spark: SparkSession, path: str, before: str | None) -> None:
    """Delete the versions next to ``path`` but for it, the one before and later ones."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    newest = paths(path)
    stay = {newest.getName(), before and paths(before).getName()}
    files = newest.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.listStatus(newest.getParent()):
        name = status.getPath().getName()
        if name not in stay and name < newest.getName():
            files.delete(status.getPath(), True)
