"""CSV and document files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header line.

    With a declared schema the file is read once and the header is checked
    against the column names.  Without one Spark infers the types, at the price
    of another pass over the file and of surprises: ``007`` becomes a number and
    ``T1`` a time of day.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


REJECTED = "_rejected_line"


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same with a declared schema; a line with a bad cell or of the wrong length has its text in ``REJECTED``."""
    wider = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", REJECTED).schema(wider).csv(path)


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order, so that a preview is repeatable."""
    return df.orderBy(*order).limit(n)


def doc_inventory(spark: SparkSession, folder: str, extension: str = "pdf") -> DataFrame:
    """Files below ``folder`` with the extension in any case, by name.

    Only the file listing is read: the content column is never selected.
    """
    any_case = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in extension)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*.{any_case}")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(
            F.element_at(F.split("path", "/"), -1).alias("file_name"),
            "path",
            F.col("length").alias("bytes"),
            "modificationTime",
        )
        .orderBy("file_name", "path")
    )


def dealt_out(scan: DataFrame, least_bytes: int = 4 << 20) -> DataFrame:
    """A scan that fewer tasks read than there are cores, dealt out to all cores before costly work on each row.

    A file of one row group is read by one task.  Tables of many files, and small ones, stay as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < least_bytes or scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores)
