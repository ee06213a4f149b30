"""Sources and sinks: resources, delimited and fixed-width text, seeds, load logs, exports by type."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def snapshot_as_changes(df: DataFrame, lsn: int, run_id: str) -> DataFrame:
    """A table as rows of a change log: operation S, one position, no commit time."""
    return df.select("*", F.lit("S").alias("_op"), F.lit(lsn).cast("long").alias("_lsn"), F.lit(0).alias("_seq"), F.lit(None).cast("timestamp").alias("_commit_ts"), F.current_timestamp().alias("_loaded_at"), F.lit(run_id).alias("_run_id"))


def read_resources(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """One JSON document per line, whole; its type comes from the file's name."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^([A-Za-z]+)", 1)
    return spark.read.text(path).filter("trim(value) <> ''").select(F.parse_json("value").alias("resource"), name.alias("resource_type"), F.col("_metadata.file_name").alias("_source_file"), F.current_timestamp().alias("_loaded_at"), F.lit(run_id).alias("_run_id"))


def landing_table(resource_type: Column) -> Column:
    """The table that resources of a type land in: the type's name in lower case, its words apart (`ExplanationOfBenefit`: `explanation_of_benefit`)."""
    return F.lower(F.regexp_replace(resource_type, "(?<!^)(?=[A-Z])", "_"))


def land_resources(resources: DataFrame, folder: str) -> DataFrame:
    """Writes resources read from files to one table a type under a folder; resource_table, rows of each."""
    named = resources.withColumn("resource_table", landing_table(F.col("resource_type"))).withColumn("resource", F.to_json("resource"))
    named.write.partitionBy("resource_table").mode("overwrite").parquet(folder)
    return resources.sparkSession.read.parquet(folder).groupBy("resource_table").agg(F.count(F.lit(1)).alias("rows"))


def read_delimited(spark: SparkSession, path: str, sep: str = "|", encoding: str = "UTF-8", quote: str = "") -> DataFrame:
    """Every column as text; the header names them."""
    return spark.read.csv(path, sep=sep, header=True, inferSchema=False, encoding=encoding, quote=quote)


def read_fixed_width(spark: SparkSession, path: str, layout: Sequence[tuple[str, int, int, str]], encoding: str = "ISO-8859-1") -> DataFrame:
    """layout: (name, first character from 1, length, type)."""
    lines = spark.read.csv(path, sep="\u0001", encoding=encoding, quote="", schema="line string", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return lines.select(*(F.nullif(F.trim(F.substring("line", start, length)), F.lit("")).try_cast(kind).alias(name) for name, start, length, kind in layout))


def read_seed(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


_LOG = "run_id string, source string, target string, row_count long, started_at timestamp, finished_at timestamp, seconds double, status string"


def logged_load(df: DataFrame, write: Callable[[DataFrame], None], source: str, target: str, run_id: str, log_path: str | None = None) -> DataFrame:
    """Runs a write and returns its log row; the rows are counted in the same pass. A failure is raised on after its row, with
    status `failure`, has been appended to the log table at `log_path`, where that is given; so is a success's row."""
    from pyspark.sql import Observation

    seen, started = Observation(), datetime.now(timezone.utc)

    def row(rows: int | None, status: str) -> DataFrame:
        done = datetime.now(timezone.utc)
        made = df.sparkSession.createDataFrame([(run_id, source, target, rows, started, done, (done - started).total_seconds(), status)], _LOG)
        if log_path is not None:
            made.coalesce(1).write.mode("append").parquet(log_path)
        return made

    try:
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    except Exception:
        row(None, "failure")
        raise
    return row(seen.get["rows"], "success")


def record_release(spark: SparkSession, log_path: str, system: str, version: str, url: str, digest: str, published: str) -> None:
    """Appends a release of a code system to the manifest table."""
    rows = spark.createDataFrame([(system, version, url, digest, published)], "system string, version string, url string, digest string, published string")
    rows.withColumn("published", F.col("published").cast("date")).withColumn("recorded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(log_path)


def record_observation(df: DataFrame, log_path: str) -> None:
    """Appends observations, with the time they were made, to a table."""
    df.withColumn("observed_at", F.current_timestamp()).write.mode("append").parquet(log_path)


def materialize(df: DataFrame, name: str, mode: str, path: str | None = None, merge: Callable[[DataFrame | None, DataFrame], DataFrame] | None = None) -> DataFrame:
    """A result by name, as a `view` over its plan, a `table` written anew at `path`, or `incremental`: merged into the last version at `path`.

    Each version is a folder of its own, so a reader of the last one is not disturbed and a failed write leaves it in place."""
    spark = df.sparkSession
    if mode != "view":
        if path is None:
            raise ValueError("a path is needed")
        before = sorted(_versions(spark, path))
        if mode == "incremental":
            if merge is None:
                raise ValueError("an incremental result needs a merge")
            df = merge(spark.read.parquet(f"{path}/v{before[-1]:08d}") if before else None, df)
        version = before[-1] + 1 if before else 0
        df.write.mode("overwrite").parquet(f"{path}/v{version:08d}")
        df = spark.read.parquet(f"{path}/v{version:08d}")
    df.createOrReplaceTempView(name)
    return df


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions at a path that were written to their end."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [f.getPath() for f in system.listStatus(folder)]
    return [int(p.getName()[1:]) for p in names if p.getName().startswith("v") and system.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def write_ndjson_by_type(df: DataFrame, path: str) -> DataFrame:
    """Writes (id, resource_type, resource text) as one folder of JSON lines per type, and a manifest (resource_type, rows) beside
    them; returns the manifest. Rows are counted from what was written, so the input is worked out once."""
    df.select("resource_type", "resource").write.partitionBy("resource_type").text(f"{path}/resources")
    written = df.sparkSession.read.schema("value string, resource_type string").text(f"{path}/resources")
    written.groupBy("resource_type").agg(F.count(F.lit(1)).alias("rows")).coalesce(1).write.json(f"{path}/manifest")
    return df.sparkSession.read.schema("resource_type string, rows long").json(f"{path}/manifest")


def collect_runs(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """(runs, metrics) of snapshot files (an object or a list each; without `multi_line`, an object a line); of files with the same run the later path wins."""
    schema = "run_key string, run_at timestamp, metrics array<struct<area:string,metric:string,dimension:string,value:double>>"
    # A file belongs to the last of the given paths that it is, or lies below; all are read at once.
    plain = [p.split("://", 1)[-1].removeprefix("file:").rstrip("/") for p in paths]
    file = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^[a-z0-9]+:/+", "/")
    belongs = lambda p: file.endswith(p) | file.contains(F.concat(p, F.lit("/")))
    at = F.array_max(F.transform(F.array(*map(F.lit, plain)), lambda p, k: F.when(belongs(p), k)))
    every = spark.read.schema(schema).json(list(paths), multiLine=multi_line).withColumn("__at", at)
    last = every.groupBy("run_key").agg(F.max_by(F.struct("run_at", "metrics"), F.struct("__at", "run_at")).alias("r")).select("run_key", "r.*")
    return last.select("run_key", "run_at"), last.select("run_key", F.inline("metrics"))
