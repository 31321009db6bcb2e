"""CSV scan of the order-line file and the table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from haulmetrics.schema import CSV_COLUMNS


def csv_schema(spark: SparkSession, path: str, encoding: str, delimiter: str) -> T.StructType:
    """Declared types in the file's own column order; undeclared columns stay text."""
    declared = {header: t for header, _, t in CSV_COLUMNS}
    header = (spark.read.option("header", True).option("encoding", encoding)
              .option("sep", delimiter).csv(path).columns)
    return T.StructType([T.StructField(h, declared.get(h, T.StringType())) for h in header])


BAD_RECORD = "bad_record"


def read_order_lines(spark: SparkSession, path: str, timestamp_format: str = "M/d/yyyy H:mm",
                     encoding: str = "ISO-8859-1", delimiter: str = ",",
                     rename: bool = True, bad_cells: str = "fail", **options) -> DataFrame:
    """Scan with declared types; a missing file is an error, extra options win.

    The header line fixes the column order, so only its first line is read up front; the
    scan itself infers nothing. A cell that its type can't hold stops the scan, or with
    ``bad_cells="report"`` becomes null while ``bad_record`` has the whole line.
    """
    if bad_cells not in ("fail", "report"):
        raise ValueError(f"unknown treatment of bad cells: {bad_cells}")
    schema = csv_schema(spark, path, encoding, delimiter)
    if bad_cells == "report":
        schema = schema.add(BAD_RECORD, T.StringType())
    reader = (spark.read.schema(schema).option("mode", "FAILFAST" if bad_cells == "fail" else "PERMISSIVE")
              .option("columnNameOfCorruptRecord", BAD_RECORD)
              .option("header", True).option("encoding", encoding).option("sep", delimiter)
              .option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format)
              .options(**options))
    df = reader.csv(path)
    if not rename:
        return df
    names = {header: name for header, name, _ in CSV_COLUMNS}
    return df.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns])


def write_table(df: DataFrame, path: str, file_format: str = "parquet",
                partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Store a processed frame or a result table (``csv`` writes a header)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)
