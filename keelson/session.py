"""Session construction and the shared scratch folder.

Intermediate tables (stream outputs, token indexes, staged files) are written
under the folder the cluster names in ``spark.checkpoint.dir``. Only when that
setting is absent (tests, a laptop) do we pick a local folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "keelson", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and Arrow on.

    ``shuffle_partitions`` is the starting point for AQE, which coalesces
    small shuffles at run time; on a cluster size it to total cores x 2-3.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Settings a session handed to us (e.g. by the driver) must carry."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``keelson`` importable in Python workers (pandas handlers are
    pickled by reference).

    In local mode the package is zipped once per SparkContext and added with
    ``addPyFile``. On a cluster it ships with the job instead
    (``spark-submit --py-files keelson.zip`` or an installed package), so no
    machine-local folder is involved."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or not sc.master.startswith("local"):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="keelson-pkg-"), "keelson.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``. Only a
    local master may go without: there a temporary folder is set."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="keelson-ck-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the checkpoint root for one run."""
    root = checkpoint_root(spark)
    return os.path.join(root.rstrip("/"), "keelson", f"{name}-{uuid.uuid4().hex[:12]}")
