"""Session helpers.

Library code never creates a session on its own; callers pass one in.  These
helpers exist for tests, ``bench.py`` and command-line use.
"""

from __future__ import annotations

import atexit
import hashlib
import io
import os
import re
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession


# Settings for a large cluster (100 TB of source files), to pass to the
# builder or spark-submit.  ``spark.checkpoint.dir`` must name a shared folder.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # shuffles carry narrow rows (keys, features); AQE merges small partitions
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # lexing is CPU-bound: smaller splits give more, shorter tasks
    "spark.sql.files.maxPartitionBytes": "64m",
    # file bodies reach 2 MB: fewer rows per columnar batch bound its memory
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    # the planner broadcasts only sides it has sized below this
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pkgsift") -> SparkSession:
    """A local session configured like the cluster profile, scaled down.

    The checkpoint folder is left to ``spark.checkpoint.dir``; a scratch
    folder is made only when that is unset (tests, local runs)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is left alone; when it
    is unset there, this raises.  Only in local mode (tests) is a fresh
    scratch folder created for an unset setting.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", "")
    if not current:
        if not sc.master.startswith("local"):
            # executors on other machines could not read a driver-local folder
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="pkgsift-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)  # made here, so removed here
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def bound_arrow_batches(spark: SparkSession, records: int = 1000, size: int = 64 << 20) -> None:
    """Keep Arrow batches of whole files small, unless the session asks for smaller ones."""
    for key, own in (("spark.sql.execution.arrow.maxRecordsPerBatch", records), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        held = re.fullmatch(r"(\d+)b?", spark.conf.get(key))
        if held and int(held.group(1)) > own:
            spark.conf.set(key, str(own))


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    The zip is written to the shared folder, so an executor that starts later
    finds it too.
    """
    import pyarrow.fs

    sc = spark.sparkContext
    if getattr(sc, "_pkgsift_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(here)):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.writestr(zipfile.ZipInfo(os.path.relpath(full, os.path.dirname(here))), open(full, "rb").read())
    uri = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pkgsift-{hashlib.sha256(data.getvalue()).hexdigest()[:16]}.zip"
    if "://" not in uri and not uri.startswith("file:"):
        fs, path = pyarrow.fs.LocalFileSystem(), uri
    elif uri.startswith("file:"):
        fs, path = pyarrow.fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    else:
        fs, path = pyarrow.fs.FileSystem.from_uri(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(path) as f:
        f.write(data.getvalue())
    sc.addPyFile(uri)
    sc._pkgsift_shipped = True
