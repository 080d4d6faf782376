"""File sources: CSV, Parquet, object store paths and JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DoubleType, FloatType, LongType, StringType, StructField, StructType,
)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are NULL everywhere behind the loaders; NaN would win every sort and maximum."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    named = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}  # a name may hold dots
    return df.select(*[F.when(~F.isnan(x), x).alias(c) if c in floating else x for c, x in named.items()])


def load_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header row. Give a schema: type inference costs a second read of the data."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def object_store_path(path: str) -> str:
    """Hadoop reads ``s3://`` buckets through the ``s3a`` scheme."""
    return "s3a://" + path[len("s3://"):] if path.startswith("s3://") else path


def load_object_store(spark: SparkSession, path: str) -> DataFrame:
    """Any object store path is Parquet whatever its suffix; folders are fine."""
    return load_parquet(spark, object_store_path(path))


def load_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Load by path: object store, ``.parquet`` or ``.csv``; any other suffix is refused before a read."""
    if path.startswith(("s3://", "s3a://")):
        return load_object_store(spark, path)
    if path.endswith(".parquet"):
        return load_parquet(spark, path)
    if path.endswith(".csv"):
        return load_csv(spark, path, schema)
    raise ValueError(f"unsupported file format: {path}")


PLAIN_TYPES = {"BIGINT": LongType(), "BOOLEAN": BooleanType(), "DOUBLE": DoubleType(), "FLOAT": DoubleType()}


def _column_type(found: str) -> DataType:
    """Type of a column whose values have this variant type: numbers of several kinds are double, lists of one plain
    type stay lists, all else (text, objects, nothing but nulls, values of different types) is text."""
    if found.startswith("DECIMAL"):
        return DoubleType()
    if found.startswith("ARRAY<"):
        inside = _column_type(found[len("ARRAY<"):-1])
        return StringType() if isinstance(inside, ArrayType) else ArrayType(inside)
    return PLAIN_TYPES.get(found, StringType())


def discover_keys(spark: SparkSession, path: str) -> StructType:
    """The union of the keys of all JSON-lines records, sorted, with types that hold every value.

    One aggregation per key over the records; only the keys and their types reach the driver. A record that is no JSON
    object raises.
    """
    text = spark.read.text(path).where(F.trim("value") != "")
    record = F.parse_json("value")
    kind = F.schema_of_variant(record)
    checked = F.when(kind.startswith("OBJECT"), record).otherwise(
        F.raise_error(F.concat(F.lit("a record is no object but "), kind)).cast("variant")
    )
    pairs = text.select(checked.alias("record")).lateralJoin(spark.tvf.variant_explode(F.col("record").outer()))
    types = pairs.groupBy("key").agg(F.schema_of_variant_agg("value").alias("type")).orderBy("key").collect()
    return StructType([StructField(r["key"], _column_type(r["type"]), True) for r in types])


def records_to_frame(
    spark: SparkSession, path: str, schema: StructType | str | None = None, unknown_keys: str = "drop"
) -> DataFrame:
    """JSON-lines records: a missing key is NULL.

    Without a schema the columns are the keys of all records, see :func:`discover_keys`, at the price of a second read.
    Under a schema an unknown key is dropped; with ``unknown_keys="fail"`` a record that carries a key outside the schema raises at run time. A record that
    is no JSON, or holds a value of another type, raises either way.
    """
    if unknown_keys not in ("drop", "fail"):
        raise ValueError(f"unknown_keys must be 'drop' or 'fail', not {unknown_keys!r}")
    if schema is None:
        schema, unknown_keys = discover_keys(spark, path), "drop"
        if not schema.fields:
            raise ValueError(f"no keys in the records of {path}")
    frame = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if unknown_keys == "drop":
        return nan_to_null(frame)
    known = F.array(*[F.lit(name) for name in frame.columns])
    text = spark.read.text(path).where(F.trim("value") != "")
    strange = F.array_except(F.json_object_keys("value"), known)
    checked = text.select(
        F.from_json("value", frame.schema, {"mode": "FAILFAST"}).alias("record"),
        F.when(
            F.size(strange) > 0, F.raise_error(F.concat(F.lit("unknown keys: "), F.array_join(strange, ", ")))
        ).alias("refused"),
    ).where(F.col("refused").isNull())
    return nan_to_null(checked.select("record.*"))
