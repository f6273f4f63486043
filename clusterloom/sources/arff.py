"""ARFF text files as a Spark source.

The header (a few lines) is read first, in one scan; the body goes through the CSV reader of Spark, so one
or many files of any size are split and parsed on executors.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ATTRIBUTE = r"(?i)^\s*@attribute\s+('[^']*'|\"[^\"]*\"|\S+)\s+(.+?)\s*$"  # fixed pattern of a header line
NUMERIC = ("numeric", "real", "integer")  # fixed values: declared numeric types


def read_attributes(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """[(name, 'double' | 'string')] in the order of the first file by name; lines behind its ``@data`` declare nothing. One scan."""
    place = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), place.alias("at"))
    marked = lines.where(F.col("value").rlike(r"(?i)^\s*@(attribute\s|data\s*$)"))
    is_data = F.col("value").rlike(r"(?i)^\s*@data")
    head = marked.groupBy("file").agg(F.min(F.when(is_data, F.col("at"))).alias("data"), F.collect_list(F.when(~is_data, F.struct("at", "value"))).alias("declared")).orderBy("file").first()
    if head is None:
        return []
    out = []
    for at, value in sorted(head["declared"]):
        if head["data"] is None or at < head["data"]:
            m = re.match(ATTRIBUTE, value)
            out.append((m[1].strip("'\""), "double" if m[2].lower() in NUMERIC else "string"))
    return out


def read_arff(spark: SparkSession, path: str, id_col: str | None = "id") -> DataFrame:
    """One row per data line; ``id`` is unique and grows with the lines of a file, in no fixed order of files."""
    attrs = read_attributes(spark, path)
    if not attrs:
        raise ValueError(f"no @attribute line in {path}")
    # text first: a marker such as ? must survive until types are decided
    ddl = ", ".join(f"`{n}` string" for n, _ in attrs)
    body = spark.read.text(path).withColumn("_row", F.monotonically_increasing_id())
    body = body.where(~F.col("value").rlike(r"(?i)^\s*(@(relation|attribute)\s|@data\s*$|%|$)"))
    opts = {"quote": "'", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}
    rows = body.select("_row", F.from_csv("value", ddl, opts).alias("r")).select("_row", "r.*")
    typed = rows.withColumns({n: F.col(f"`{n}`").try_cast("double") for n, t in attrs if t == "double"})
    named = typed.withColumnRenamed("_row", id_col) if id_col else typed.drop("_row")
    return named


def write_arff_body(df: DataFrame, path: str, relation: str = "table") -> None:
    """Write ``df`` as headed text parts that :func:`read_arff` reads back (one header file, many bodies)."""
    head = [f"@relation {relation}"]
    for f in df.schema.fields:
        head.append(f"@attribute {f.name} {'numeric' if f.dataType.simpleString() in ('double', 'int', 'bigint', 'float') else 'string'}")
    spark = df.sparkSession
    spark.createDataFrame([("\n".join([*head, "@data"]),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/a_header")
    fields = [F.coalesce(F.col(f.name).cast("string"), F.lit("?")) for f in df.schema.fields]
    df.select(F.concat_ws(",", *fields).alias("value")).write.mode("overwrite").text(f"{path}/b_body")
