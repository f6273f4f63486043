"""Result tables: scan many result files, compile them, append finished runs, split on write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

_TYPES = {"string": StringType(), "int": IntegerType(), "double": DoubleType()}


def schema(fields: str) -> StructType:
    """'name type, ...' as a schema, without needing a session."""
    return StructType([StructField(n, _TYPES[t]) for n, t in (f.split() for f in fields.split(","))])


# fixed values: the superset of all result columns
RESULT_SCHEMA = schema(
    "session string, dataset string, preprocessing string, algorithm string, n_clusters int, n_components int, "
    "metric string, linkage string, kernel string, init_params string, param_m double, param_alpha double, "
    "reg_covar double, gamma double, run_id int, n_features_orig int, n_features_reduced int, inertia double, bic double, "
    "avg_log_likelihood double, runtime double, runtime_sec double, ari double, purity double, "
    "davies_bouldin double, f_measure double, error string"
)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def scan_results(spark: SparkSession, roots: list[str], pattern: str = "*_final_results_compiled.csv") -> DataFrame | None:
    """All result CSV files below the existing roots whose name matches, as one typed table.

    The header is the first line of a file that is not blank, wherever else ``dataset`` may stand; files whose header lacks that column are no
    result files. Files with different headers are read per header and united by column name.
    """
    present = [r for r in roots if _exists(spark, r)]
    if not present:
        return None
    opts = {"recursiveFileLookup": "true", "pathGlobFilter": pattern}
    lines = spark.read.options(**opts).text(present).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    # lines are numbered as they are read, so the least number in the block at byte 0 is the first line
    first = lines.where("start = 0 AND trim(value) <> ''").groupBy("file").agg(F.min_by("value", "at").alias("value"))
    heads = first.where(F.col("value").rlike(r'(^|,)\s*"?dataset"?\s*(,|$)')).groupBy("value").agg(F.collect_set("file").alias("files")).collect()
    frames = [spark.read.csv(r["files"], header=True) for r in sorted(heads, key=lambda r: r["value"])]
    return conform(unite(frames)) if frames else None


def unite(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def conform(df: DataFrame) -> DataFrame:
    """Cast to the superset schema; unreadable numbers become null, absent columns are added."""
    have = set(df.columns)

    def typed(f):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if f.dataType.simpleString() == "int":
            return F.col(f.name).try_cast("double").cast("int").alias(f.name)  # '10.0' is 10
        return F.col(f.name).try_cast(f.dataType).alias(f.name)

    return df.select(*[typed(f) for f in RESULT_SCHEMA.fields])


def write_results(df: DataFrame, path: str, split_by: str | None = None, fmt: str = "csv", mode: str = "append") -> bool:
    """Append results, one folder per value of ``split_by`` if given; nothing is written for an empty table."""
    if df.isEmpty():
        return False
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    (w.partitionBy(split_by) if split_by else w).format(fmt).save(path)
    return True


def read_results(spark: SparkSession, path: str, fmt: str = "parquet", newest_by: str | None = None) -> DataFrame:
    """The results table, or only its newest run when ``newest_by`` names a run column."""
    df = spark.read.option("header", True).format(fmt).load(path)
    if newest_by:
        top = df.agg(F.max(newest_by)).first()[0]
        df = df.where(F.col(newest_by) == F.lit(top))
    return df
