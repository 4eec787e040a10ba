"""Written tables: partitioned by run and deployment, Parquet or CSV, replaced per deployment by a commit.

A run writes beside what is there, under ``run=<id>`` in every table's folder, and lists its deployments in the run index. One small
file, the commit, makes it count: readers take each deployment's rows from the last committed run that lists it, so the earlier output
is readable until that moment and a run that stops before it changes nothing. `vacuum` removes what no reader takes any more.

A table's run folder also holds its schema, so that a table without rows stays a typed table and ids are never retyped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abyssal.operators.asof import small_enough_to_broadcast
from abyssal.schemas import KEY

OUTPUT_TABLES = (
    "status", "rga", "scalup", "valve", "system_health", "par", "par_daily", "hobo_oxygen", "cycle_windows",
    "scan_windows", "rga_scans", "chamber_cycles", "fluxes", "metabolism", "pi_fit", "deployment", "processing",
)
FORMATS = ("parquet", "csv")
SCHEMA_FILE = "_schema.json"
INDEX, COMMITS = "run_index", "run_commits"
# Microseconds survive CSV only with an explicit pattern.
CSV_OPTIONS = {"header": True, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def _path(out: str, name: str, fmt: str) -> str:
    return f"{out.rstrip('/')}/{name}.{fmt}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def durations_to_seconds(df: DataFrame) -> DataFrame:
    """Day-time intervals as seconds: neither CSV nor Parquet carries them across engines."""
    out = df
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DayTimeIntervalType):
            epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
            out = out.withColumn(field.name, F.unix_micros(epoch + F.col(field.name)) / F.lit(1e6))
    return out


def _children(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _file_system(spark, folder)
    return [str(s.getPath().toString()) for s in fs.listStatus(p)] if fs.exists(p) else []


def _run_path(out: str, name: str, fmt: str, run: str) -> str:
    return f"{_path(out, name, fmt)}/run={run}"


def new_run() -> str:
    return uuid.uuid4().hex


def commits(spark: SparkSession, out: str) -> list[tuple[int, str, str]]:
    """(number, run, first format) of every committed run, oldest first; one entry per run, not per deployment."""
    found = []
    for path in _children(spark, f"{out}/{COMMITS}"):
        text = _read_text(spark, path)
        if text:  # a commit that is just being written does not count yet
            found.append((int(path.rsplit("/", 1)[1]), *json.loads(text)))
    return sorted(found)


def commit(spark: SparkSession, out: str, run: str, deployments: DataFrame, fmt: str = "parquet") -> int:
    """Make a finished run the current output of its deployments (column deployment_id), by creating one file.

    The number after the last commit's is taken by whoever creates its file first; another run that loses takes the next one.
    """
    deployments.select(F.col(KEY).cast("string").alias(KEY)).distinct().write.mode("overwrite").parquet(f"{out}/{INDEX}/run={run}")
    last = [n for n, *_ in commits(spark, out)]
    number = 1 + (last[-1] if last else 0)
    while not _create_text(spark, f"{out}/{COMMITS}/{number:012d}", json.dumps([run, "csv" if fmt == "csv" else "parquet"])):
        number += 1
    return number


def current_runs(spark: SparkSession, out: str) -> DataFrame:
    """(deployment_id, run, fmt): the last committed run of every deployment."""
    done = spark.createDataFrame(commits(spark, out), "number BIGINT, run STRING, fmt STRING")
    listed = spark.read.schema(f"{KEY} STRING, run STRING").parquet(f"{out}/{INDEX}")
    last = listed.join(F.broadcast(done), "run").groupBy(KEY).agg(F.max_by(F.struct("run", "fmt"), "number").alias("c"))
    return last.select(KEY, "c.run", "c.fmt")


def vacuum(spark: SparkSession, out: str, names: Iterable[str] = OUTPUT_TABLES) -> list[str]:
    """Delete the partitions of committed runs that a later commit replaced. Runs that are not committed stay: they may be writing."""
    if not commits(spark, out):
        return []
    kept = current_runs(spark, out).select(KEY, "run")
    ours = spark.createDataFrame([(r,) for _, r, _ in commits(spark, out)], "run STRING")
    listed = spark.read.schema(f"{KEY} STRING, run STRING").parquet(f"{out}/{INDEX}").join(F.broadcast(ours), "run")
    removed = []
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for r in listed.join(kept, [KEY, "run"], "left_anti").toLocalIterator():
        for name in names:
            for fmt in FORMATS:
                fs, p = _file_system(spark, f"{_run_path(out, name, fmt, r['run'])}/{KEY}={escape(r[KEY])}")
                if fs.exists(p):
                    fs.delete(p, True)
                    removed.append(str(p.toString()))
    return removed


def _create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if it is there already."""
    fs, p = _file_system(spark, path)
    fs.mkdirs(p.getParent())
    try:
        stream = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def _write_schema(df: DataFrame, folder: str) -> None:
    fs, p = _file_system(df.sparkSession, f"{folder}/{SCHEMA_FILE}")
    fs.delete(p, False)
    _create_text(df.sparkSession, f"{folder}/{SCHEMA_FILE}", df.schema.json())


def _read_schema(spark: SparkSession, folder: str) -> T.StructType | None:
    text = _read_text(spark, f"{folder}/{SCHEMA_FILE}")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def write_table(df: DataFrame, out: str, name: str, fmt: str = "parquet", run: str | None = None) -> None:
    """Write as Parquet, CSV or `both`, into the run's part of the table; it counts once the run is committed.

    Rows are gathered by deployment, and a large deployment is split again by size, so the number of files follows the data and
    not tasks times deployments. Without a run it is a plain table that nothing else is written beside.
    """
    flat = durations_to_seconds(df)
    dealt = flat.hint("rebalance", KEY)
    for f in FORMATS if fmt == "both" else (fmt,):
        folder = _path(out, name, f) if run is None else _run_path(out, name, f, run)
        writer = dealt.write.mode("overwrite").partitionBy(KEY)
        (writer.options(**CSV_OPTIONS) if f == "csv" else writer).format(f).save(folder)
        _write_schema(flat, folder)


def write_tables(tables: dict[str, DataFrame], out: str, fmt: str = "parquet", run: str | None = None) -> None:
    for name, df in tables.items():
        write_table(df, out, name, fmt, run)


def _load_format(spark: SparkSession, folder: str, fmt: str, schema: T.StructType | None, partitions: Iterable[str] = ()) -> DataFrame:
    """A table's folder with its partition columns; columns are read by the schema given or written beside the data."""
    reader = spark.read.options(**CSV_OPTIONS) if fmt == "csv" else spark.read
    schema = schema or _read_schema(spark, folder)
    if schema is None:  # written elsewhere: types from the data, but never for the id
        inferring = reader.option("inferSchema", True).option("inferTimestampNTZ", True) if fmt == "csv" else reader
        schema = inferring.format(fmt).load(folder).schema
    columns = [T.StructField(KEY, T.StringType()) if f.name == KEY else f for f in schema.fields]
    columns += [T.StructField(p, T.StringType()) for p in partitions if p not in schema.names]
    return reader.schema(T.StructType(columns)).format(fmt).load(folder).select([f.name for f in columns])


def load_run(spark: SparkSession, out: str, name: str, fmt: str, run: str, schema: T.StructType | None = None) -> DataFrame:
    """What one run wrote of a table, committed or not."""
    f = "csv" if fmt == "csv" else "parquet"
    return _load_format(spark, _run_path(out, name, f, run), f, schema)


def load_table(spark: SparkSession, out: str, name: str, schema: str | T.StructType | None = None) -> DataFrame | None:
    """The written table, of every deployment the last committed run in that run's first format; None where no run wrote it.

    The run index is a table that joins on the partition columns, so it prunes partitions whatever the number of deployments.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    done = commits(spark, out)
    if not done:  # a plain table, Parquet before CSV
        found = [f for f in FORMATS if exists(spark, _path(out, name, f))]
        return _load_format(spark, _path(out, name, found[0]), found[0], schema) if found else None
    index = current_runs(spark, out)
    if small_enough_to_broadcast(spark.read.schema(f"{KEY} STRING, run STRING").parquet(f"{out}/{INDEX}")):
        index = F.broadcast(index)
    parts = []
    for fmt in FORMATS:
        runs = [run for _, run, f in reversed(done) if f == fmt and exists(spark, _run_path(out, name, fmt, run))]
        if runs:
            known = schema or _read_schema(spark, _run_path(out, name, fmt, runs[0]))
            rows = _load_format(spark, _path(out, name, fmt), fmt, known, ["run"])
            parts.append(rows.join(index.where(F.col("fmt") == fmt).drop("fmt"), [KEY, "run"]).select([c for c in rows.columns if c != "run"]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def load_all(spark: SparkSession, out: str, names: Iterable[str] = OUTPUT_TABLES) -> dict[str, DataFrame]:
    loaded = {n: load_table(spark, out, n) for n in names}
    return {n: df for n, df in loaded.items() if df is not None}


def with_elapsed_seconds(df: DataFrame) -> DataFrame:
    """`elapsed_s` as DOUBLE whatever the table was written as."""
    return df.withColumn("elapsed_s", F.col("elapsed_s").cast("double")) if "elapsed_s" in df.columns else df


def run_summary(tables: dict[str, DataFrame], cycle_statistics: DataFrame) -> DataFrame:
    """Row counts per table and cycle statistics of every deployment, long."""
    counts = None
    for name, df in tables.items():
        part = df.groupBy(KEY).agg(F.count(F.lit(1)).alias("value")).select(KEY, F.lit(f"n_{name}").alias("measure"), "value")
        counts = part if counts is None else counts.unionByName(part)
    stats = cycle_statistics.unpivot([KEY], ["total_cycles", "dropped_too_short"], "measure", "value")
    return counts.unionByName(stats)
