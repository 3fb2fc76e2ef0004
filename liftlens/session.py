"""Session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS / object store).  Only where it is unset in a run on one machine do we
create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# Only for a run on one machine: small shuffles would otherwise collapse into one task.
LOCAL_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB"}


def build_session(cpus: int | None = None, master: str | None = None,
                  shuffle_partitions: int | None = None, app: str = "liftlens",
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the settings the library relies on.

    Master and shuffle partitions belong to the deployment: they are set only if
    asked for.  ``cpus`` asks for a run on this machine, ``local[cpus]`` with two
    shuffle partitions a core; ``master`` names any other.
    """
    builder = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if cpus:
        master = master or f"local[{cpus}]"
        conf.update(LOCAL_CONF)
        conf["spark.driver.memory"] = os.environ.get("LIFTLENS_DRIVER_MEM", "8g")
        shuffle_partitions = shuffle_partitions or 2 * cpus
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # runtime-settable options also applied to a pre-existing session
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, conf[k])
    return spark


_LOCAL_ROOT: dict[str, str] = {}


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, below ``spark.checkpoint.dir``.

    Reads the setting from the session.  Where it is unset in a local run, one
    folder is made for the application and stays its root; on a cluster an unset
    setting is an error, never a machine-local folder.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        app = sc.applicationId
        if app not in _LOCAL_ROOT:
            _LOCAL_ROOT[app] = sc.getCheckpointDir() or tempfile.mkdtemp(prefix="liftlens-")
        root = _LOCAL_ROOT[app]
    return os.path.join(root, *parts) if parts else root


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect client."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder (never reused, never cleared)."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str = "stage"):
    """Compute ``df`` once, write it below the shared folder, continue from the copy.

    Used for intermediates read by several branches (scored cells feeding
    three estimators, the session mart feeding the data tests): the lineage is
    cut, so branches and retries after a lost executor start from the written
    table instead of recomputing from the raw events.  A written Parquet table
    costs one pass; ``checkpoint()`` would compute the lineage twice.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, f"mat-{name}")
    df.write.parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``liftlens`` importable in Python workers (``--py-files`` at runtime).

    Pandas UDFs (logit fits, grouped draws) refer to functions of this package;
    executors started from another working directory would not find it.  The
    zip goes below the shared folder when that is a local path, otherwise to a
    driver-side file that Spark's file server hands to every executor.
    """
    import zipfile
    sc = _context(spark)
    app = sc.applicationId if sc is not None else f"connect-{spark.conf.get('spark.app.name', '')}-{id(spark)}"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = shared_dir(spark)
    base = root if "://" not in root or root.startswith("file:") else tempfile.mkdtemp(prefix="liftlens-py-")
    base = base.replace("file:", "", 1) if base.startswith("file:") else base
    os.makedirs(base, exist_ok=True)
    out = os.path.join(base, f"liftlens-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(out, "w") as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    if sc is not None:
        sc.addPyFile(out)
    else:                                   # Spark Connect: ship as a session artifact
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)
