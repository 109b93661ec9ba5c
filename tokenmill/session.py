"""Session helpers: a local session for tests/bench and lineage cutting.

On a cluster the session is created by the platform; the library only reads
its settings.  ``spark.checkpoint.dir`` must name a shared folder there; a
machine-local temporary folder is created only for ``local[...]`` masters.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tokenmill") -> SparkSession:
    """Session used by tests and the benchmark (``local[N]``, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TOKENMILL_DRIVER_MEM", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, taking it from the session.

    ``spark.checkpoint.dir`` wins.  Only a local master may fall back to a
    fresh folder under the system temp dir (tests, benchmark).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so iterative jobs can cut lineage")
    path = tempfile.mkdtemp(prefix="tokenmill-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder, code shipping and two runtime SQL settings; called
    by every registered query.

    Iterative jobs persist intermediate tables.  By default Spark keeps a
    cached plan's shuffle partition count (``spark.sql.shuffle.partitions``)
    instead of letting adaptive execution size it from the data, so every
    later round would run that many tasks however small the table is.
    """
    ensure_checkpoint_dir(spark)
    ship_code(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
    return spark


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one.

    The data is persisted first: an eager checkpoint runs one job to count
    and another to write, and without the cache the second recomputes.
    """
    ensure_checkpoint_dir(df.sparkSession)
    kept = df.persist()
    out = kept.checkpoint(eager=True)
    kept.unpersist()
    return out


_SHIPPED: set[int] = set()


def ship_code(spark: SparkSession) -> None:
    """Make ``tokenmill`` importable in local Python workers.

    On a cluster the package is shipped with ``--py-files``; for local
    masters whose workers may start outside the repo, add a zip once.
    """
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED or not sc.master.startswith("local"):
        return
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="tokenmill-code-")
    zpath = shutil.make_archive(os.path.join(out, "tokenmill"), "zip",
                                os.path.dirname(pkg), "tokenmill")
    sc.addPyFile(zpath)
    _SHIPPED.add(key)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Cuts lineage like a checkpoint, and later passes that need few columns
    read only those (columnar, pruned), unlike a row-serialized checkpoint.
    """
    import uuid
    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
