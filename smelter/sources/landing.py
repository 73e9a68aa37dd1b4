"""Landing files in csv, avro, json or parquet, with where and when they came from."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from smelter.constants import LANDING_FORMATS
from smelter.operators.shape import with_constants


# Column that holds a record as it came where it could not be read
UNREADABLE = "_unreadable_record"


def _with_unreadable(schema: StructType | str) -> StructType:
    typed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return StructType([*typed.fields, StructField(UNREADABLE, StringType())])


def read_landing(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: StructType | str | None = None,
    unreadable: bool = False,
) -> DataFrame:
    """Scan ``path``. CSV files have a header. Without a ``schema`` the types of csv
    and json are inferred, which reads the files one more time. With ``unreadable`` a record of csv
    or json that doesn't fit its schema has its text in ``UNREADABLE``, which is else NULL."""
    if fmt not in LANDING_FORMATS:
        raise ValueError(f"format {fmt!r} is none of {LANDING_FORMATS}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    if unreadable:
        if fmt not in ("csv", "json") or schema is None:
            raise ValueError("unreadable records are told in csv and json with a schema")
        schema = _with_unreadable(schema)
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", UNREADABLE)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if fmt == "avro" and "avro" in str(error).lower() and "PATH_NOT_FOUND" not in str(error):
            raise RuntimeError("avro files need the spark-avro package on the class path") from error
        raise


def new_files(
    spark: SparkSession, path: str, fmt: str, schema: StructType | str, most: int | None = None
) -> DataFrame:
    """A stream of the files of ``path``, at most ``most`` of them in a batch."""
    if fmt not in LANDING_FORMATS:
        raise ValueError(f"format {fmt!r} is none of {LANDING_FORMATS}")
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if most is not None:
        reader = reader.option("maxFilesPerTrigger", most)
    return reader.load(path)


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Add path, name and modification time of each row's file; ``df`` is a plain scan."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_name").alias("_source_file_name"),
        F.col("_metadata.file_modification_time").alias("_source_file_modified_at"),
    )


def with_lineage(
    df: DataFrame,
    source_name: str,
    source_system: str,
    fmt: str,
    batch_id: str,
    at: Column | None = None,
) -> DataFrame:
    stamped = df.withColumn("_ingested_at", F.current_timestamp() if at is None else at)
    return with_constants(
        stamped,
        {
            "_source_name": source_name,
            "_source_system": source_system,
            "_source_format": fmt,
            "_batch_id": batch_id,
        },
    )


def require_rows(df: DataFrame, where: str) -> DataFrame:
    """``df`` itself, or an error if it has no row; reads no further than the first one."""
    if df.isEmpty():
        raise ValueError(f"no rows in {where}")
    return df
