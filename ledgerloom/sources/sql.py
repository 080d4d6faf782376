"""Extraction by SQL text from catalogs and JDBC databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.cap import cap_frame
from ledgerloom.sources.files import nan_to_null

QUERY_SECONDS = 7200  # run-time cap of one extract query


def hive_catalog_conf(metastore_uri: str, s3_endpoint: str | None = None) -> dict[str, str]:
    """Session settings for Hive-metastore tables stored on an object store."""
    conf = {
        "spark.sql.catalogImplementation": "hive",
        "spark.hadoop.hive.metastore.uris": metastore_uri,
    }
    if s3_endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = s3_endpoint
        conf["spark.hadoop.fs.s3a.path.style.access"] = "true"
    return conf


def jdbc_catalog_conf(name: str, url: str, driver: str = "org.postgresql.Driver") -> dict[str, str]:
    """Session settings that make a JDBC database visible as catalog ``name``."""
    prefix = f"spark.sql.catalog.{name}"
    return {
        prefix: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        f"{prefix}.url": url,
        f"{prefix}.driver": driver,
        f"{prefix}.pushDownAggregate": "true",
        f"{prefix}.queryTimeout": str(QUERY_SECONDS),
    }


def jdbc_options(
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Reader options of one JDBC extract; a table read is split by ``partition_column``."""
    if (table is None) == (query is None):
        raise ValueError("give either table or query")
    options = {"url": url, "queryTimeout": str(QUERY_SECONDS), "fetchsize": str(fetch_size), **extra}
    if query is not None:
        if partition_column:
            # Spark splits only `dbtable` reads, and a subquery counts as one.
            options["dbtable"] = f"({query}) extract"
        else:
            options["query"] = query
    else:
        options["dbtable"] = table
    if partition_column:
        if lower is None or upper is None or not partitions:
            raise ValueError("partition_column needs lower, upper and partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def extract_jdbc(spark: SparkSession, url: str, **kwargs) -> DataFrame:
    """Read one table or query from a database; see :func:`jdbc_options`."""
    return nan_to_null(spark.read.format("jdbc").options(**jdbc_options(url, **kwargs)).load())


def extract_sql(
    spark: SparkSession,
    query: str,
    catalog: str = "spark_catalog",
    schema: str = "default",
    args: dict | None = None,
    max_seconds: float | None = QUERY_SECONDS,
) -> DataFrame:
    """Run one SQL text with unqualified names resolved in ``catalog.schema``.

    Values such as the run date go in as named parameters (``:ds``), never pasted into the text. The
    result stays distributed. An action on it that takes longer than ``max_seconds`` is ended and raises
    ``TimeoutError``; None sets no cap. NaN becomes NULL, as in the loaders.
    """
    before = (spark.catalog.currentCatalog(), spark.catalog.currentDatabase())
    try:
        spark.catalog.setCurrentCatalog(catalog)
        spark.catalog.setCurrentDatabase(schema)
        found = nan_to_null(spark.sql(query, args=args))
    finally:
        spark.catalog.setCurrentCatalog(before[0])
        spark.catalog.setCurrentDatabase(before[1])
    return found if max_seconds is None else cap_frame(found, max_seconds)


def split_source(source: str) -> tuple[str, str]:
    """``"catalog.schema"`` or ``"catalog"``, whose schema is then ``default``."""
    catalog, _, rest = source.partition(".")
    return catalog, rest.split(".")[0] or "default"


def extract_sql_multi(
    spark: SparkSession, queries: dict[str, str], args: dict | None = None, max_seconds: float | None = QUERY_SECONDS
) -> dict[str, DataFrame]:
    """One lazy frame per source. The first text that does not analyse aborts the whole extract."""
    return {
        source: extract_sql(spark, text, *split_source(source), args=args, max_seconds=max_seconds) for source, text in queries.items()
    }
