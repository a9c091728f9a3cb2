"""Session helpers: one place for the settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library expects; anything the cluster already set wins.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """The active session, or a new one; settings that are already there stay.

    A given ``master`` is for local runs and tests: it brings the static
    defaults and, unless told, 8 shuffle partitions. Without one, master and
    partitions are those of the cluster.
    """
    spark = SparkSession.getActiveSession()
    if spark is None:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master).config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
            for k, v in DEFAULTS.items():
                builder = builder.config(k, v)
        elif shuffle_partitions:
            builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        for k, v in (extra or {}).items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    own = spark.conf.getAll
    for k, v in DEFAULTS.items():
        if k.startswith("spark.sql.") and k not in own:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


#: HotSpot leaves methods of more bytes uncompiled, and they run many times slower.
METHOD_BYTES = 8000


def keep_methods_compiled(spark: SparkSession) -> None:
    """Stages whose generated code is one method too long for HotSpot to compile run as projections in
    small methods instead (Spark's own switch, whose default is far above). Set by the session: that stays."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if name not in spark.conf.getAll:
        spark.conf.set(name, METHOD_BYTES)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; it is read
    from the session. Only a bare local/test session gets a fresh temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for staged outputs."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-scratch/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> bool:
    """Delete the staged outputs under the checkpoint folder, of this and earlier applications. Not for use while results
    that read them are still wanted: intermediate tables and the files of registered queries stay until then."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/tessera-scratch")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_PROPAGATED = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel",
               "spark.scheduler.pool")


def run_concurrently(spark: SparkSession, fns: dict, max_workers: int = 4) -> dict:
    """Run independent Spark actions from a small thread pool; returns name -> result.

    Local properties (job group, description, scheduler pool) are per thread;
    they are copied from the caller so the concurrent jobs stay grouped
    with the work that started them.
    """
    from concurrent.futures import ThreadPoolExecutor

    sc = spark.sparkContext
    props = {k: sc.getLocalProperty(k) for k in _PROPAGATED}

    def call(fn):
        for k, v in props.items():
            if v is not None:
                sc.setLocalProperty(k, v)
        return fn()

    if not fns:
        return {}
    with ThreadPoolExecutor(max(1, min(max_workers, len(fns)))) as pool:
        futures = {name: pool.submit(call, fn) for name, fn in fns.items()}
        return {name: f.result() for name, f in futures.items()}
