"""Session helpers: the shared scratch folder and a local session for tests.

Everything a job writes for itself (stream checkpoints, recorded start
markers, cut-lineage tables) goes below the folder the cluster names in
``spark.checkpoint.dir``.  A library never invents a machine-local folder;
only a local-mode session with the setting unset gets a temporary one.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def spark_context(spark: SparkSession):
    """The session's SparkContext, or None for a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect raises its own not-supported error
        return None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    When both are unset and the master is local (tests, a laptop), a
    temporary folder is created and recorded in the session; on a cluster
    an unset value is an error, because a machine-local folder would not
    survive the loss of the machine.
    """
    root = spark.conf.get(_CKPT_KEY, None)
    sc = spark_context(spark)
    if sc is None:  # Spark Connect: the server's setting applies
        if not root:
            raise RuntimeError(f"{_CKPT_KEY} is not set on the Spark Connect server")
        return root.rstrip("/")
    sc_dir = sc.getCheckpointDir()
    if root and not sc_dir:
        # set as a runtime conf only: DataFrame.checkpoint() needs it on the context too
        sc.setCheckpointDir(root)
    root = root or sc_dir
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{_CKPT_KEY} is not set; point it at a shared folder (HDFS, S3, ...) "
            "so checkpoints and written tables survive executor loss"
        )
    root = tempfile.mkdtemp(prefix="lineflow-ckpt-")
    spark.conf.set(_CKPT_KEY, root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the scratch root, unique per call, removed when the driver's JVM ends.

    Streaming checkpoints must never be shared by accident: a second run on
    an old checkpoint silently resumes and returns stale rows.
    """
    folder = f"{scratch_root(spark)}/lineflow/{label}-{uuid.uuid4().hex}"
    if spark_context(spark) is not None:
        make_folder(spark, folder)
        path, fs = _hadoop(spark, folder)
        fs.deleteOnExit(path)
    return folder


def _hadoop(spark: SparkSession, folder: str):
    """A folder's Hadoop path and file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, folder: str) -> None:
    path, fs = _hadoop(spark, folder)
    fs.mkdirs(path)


def move_folder(spark: SparkSession, old: str, new: str) -> None:
    """Rename a folder; the files in it keep their modification times."""
    path, fs = _hadoop(spark, old)
    target = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    if not fs.rename(path, target):
        raise OSError(f"could not rename {old} to {new}")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder that this library wrote, with what is in it."""
    path, fs = _hadoop(spark, folder)
    fs.delete(path, True)


def folder_name(name: str) -> str:
    """A name as a folder's; two names never share one."""
    safe = "".join(ch if ch.isalnum() or ch in "-_." else "_" for ch in name)
    if safe != name:
        safe += "-" + hashlib.sha256(name.encode()).hexdigest()[:12]
    return safe


def query_checkpoint(spark: SparkSession, name: str) -> str:
    """The checkpoint of the named query: the same folder every time it starts.

    Starting a flow again under its name therefore resumes from its last
    committed position (the default start policy), and replacing it
    (stop, wait, start) continues on the same checkpoint.
    """
    return f"{scratch_root(spark)}/lineflow/queries/{folder_name(name)}"


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "lineflow") -> SparkSession:
    """A local session configured the way the tests and the bench use it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # remove checkpoint files of garbage-collected block tables (set it on clusters too)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


_SHIPPED: set[str] = set()
_ZIP: list[str] = []


def _package_zip() -> str:
    """A zip of this package, built once per process, for ``addPyFile`` in local sessions."""
    if not _ZIP:
        import os
        import zipfile

        pkg = os.path.dirname(os.path.abspath(__file__))
        base = os.path.dirname(pkg)
        path = os.path.join(tempfile.mkdtemp(prefix="lineflow-pkg-"), "lineflow.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for root, _dirs, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(root, f)
                        z.write(full, os.path.relpath(full, base))
        _ZIP.append(path)
    return _ZIP[0]


def ship_package(spark: SparkSession) -> None:
    """Make ``lineflow`` importable in the Python workers of a local session.

    Python steps, commands and table functions run code of this package on
    executors.  On a cluster the package ships the standard way
    (``spark-submit --py-files lineflow.zip``), so nothing happens here.  A
    local session whose workers may start in another folder (a notebook,
    a harness importing the package by path) gets it once per application
    with ``addPyFile``.
    """
    sc = spark_context(spark)
    if sc is None:  # Spark Connect: the client uploads the package as an artifact
        key = f"connect-{id(spark)}"
        if key not in _SHIPPED:
            _SHIPPED.add(key)
            spark.addArtifacts(_package_zip(), pyfile=True)
        return
    app = sc.applicationId
    if app in _SHIPPED or not sc.master.startswith("local"):
        return
    _SHIPPED.add(app)
    sc.addPyFile(_package_zip())
