"""Session helpers: building a session, scratch tables, input spreading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tables at or below this many rows and bytes may be broadcast or held as a
# literal. Every caller checks the size with `fits` and has a shuffle route with
# equal results beyond it.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def build_session(app: str = "pagemill", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the jobs rely on (UTC, AQE, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir` as the
    cluster names it. Only a local master, whose tasks share the driver's disk,
    may do without: a folder is then made once per application."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="pagemill-")
    return _LOCAL_ROOTS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


# Spark removes the shuffle files of a write when it ends; else they stay until the
# driver's garbage collection finds their plan.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, name: str, partition_by: list[str] | None = None, lean: bool = False) -> DataFrame:
    """Write `df` once to the shared scratch folder and read it back. Cuts the
    lineage, survives executor loss, and fixes values (partition ids, samples)
    that must not change when a stage is recomputed. `lean` is for tables as large as
    the input: packed closer, and the shuffle files behind them go at once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if lean:
        before = spark.conf.get(FREE_SHUFFLES, None)
        spark.conf.set(FREE_SHUFFLES, "true")
        try:
            writer.option("compression", "zstd").parquet(path)
        finally:
            spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    else:
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove the files of a settled table that nothing will read again."""
    jvm, context = table.sparkSession._jvm, table.sparkSession.sparkContext
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def row_bytes(df: DataFrame) -> Column:
    """Approximate bytes of a row: text by its length, arrays by their JSON."""
    total = F.lit(16)
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind in ("array", "struct", "map"):
            total = total + F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0))
        else:
            total = total + 8
    return total


def fits(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """True when `df` has at most `limit` rows of `most_bytes` bytes in all. A plain
    parallel sum; callers pass written tables."""
    size = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return size["n"] <= limit and size["bytes"] <= most_bytes


def numbered(df: DataFrame, name: str, lean: bool = False) -> DataFrame:
    """`df` with `_row`, a number of its own for every row. Written, so that the
    numbers stay and what the rows hold is worked out once."""
    return settle(df.withColumn("_row", F.monotonically_increasing_id()), name, lean=lean)


def frequent_part(rows: DataFrame, side: DataFrame, key: str, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of `side`, unique by `key`, with the keys that are commonest in `rows`:
    as many quarter powers of two of their counts as `limit` and `most_bytes` allow. Written."""
    power = F.floor(F.log2("_n") * 4).cast("int")
    counted = settle(side.join(rows.groupBy(key).agg(F.count("*").alias("_n")), key).withColumn("_power", power), "key-counts")
    found = counted.groupBy("_power").agg(F.count("*").alias("n"), F.sum(row_bytes(side)).alias("bytes"))
    least, n, size = 4 * 64, 0, 0
    for r in found.orderBy(F.desc("_power")).collect():  # at most 4 * 64 rows
        n, size = n + r["n"], size + r["bytes"]
        if n > limit or size > most_bytes:
            break
        least = r["_power"]
    return counted.where(F.col("_power") >= least).select(*side.columns)


def frequent_join(rows: DataFrame, side: DataFrame, key: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Inner join with a written table that is unique by `key`: in the tasks while it
    fits, else its commonest keys there and only rows of other keys by a shuffle. No
    frequent key is left to make one task long."""
    if fits(side, limit):
        return rows.join(F.broadcast(side), key)
    common = frequent_part(rows, side, key, limit)
    rare = rows.join(F.broadcast(common.select(key)), key, "left_anti")
    return rows.join(F.broadcast(common), key).unionByName(rare.join(side, key))


def content_key(name: str) -> Column:
    """16 bytes that stand for the value of a column. What depends on one column
    only is worked out once per value and joined back by this key, so rows need no
    unique id and repeated rows agree."""
    return F.unhex(F.md5(F.to_json(F.struct(F.col(name).alias("v"))).cast("binary")))


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy row work at least one task per core. Inputs of as many files
    as cores pass through without a shuffle. Files are only listed: nothing runs
    while the plan is made."""
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)
