"""Session defaults and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "vereda") -> SparkSession:
    """A session for laptops, tests and benchmarks. Clusters bring their own."""
    partitions = 8 if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # no Python call-site capture per column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is made only for a local master with the setting
    absent; on a cluster a missing setting is an error, because executors on
    other machines could not read what one of them wrote.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="vereda-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark).rstrip('/')}/vereda/{app}/{label}-{uuid.uuid4().hex}"


def discard(*tables: DataFrame | None) -> None:
    """Remove stored steps that nothing reads any more; tables from elsewhere stay."""
    for df in tables:
        if df is None:
            continue
        spark = df.sparkSession
        ours = f"/vereda/{spark.sparkContext.applicationId}/"
        for folder in {f[: f.rindex("/")] for f in df.inputFiles() if ours in f}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str = "step", row_group: int | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back. Row groups of at
    most ``row_group`` bytes (or one larger row) let later scans split a step that few
    tasks wrote, and hold few large rows at once.

    The result has no lineage, survives the loss of any executor, is computed
    once however often it is used, and carries its real size, so the planner
    broadcasts it only when it is below ``autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # Parquet looks at the size after 100 rows at first, which may be gigabytes
    groups = {} if row_group is None else {"parquet.block.size": row_group, "parquet.page.size.row.check.min": 1}
    df.write.options(**groups).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
