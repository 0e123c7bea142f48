"""Session defaults and the shared work folder."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from twinsync.sources.files import open_path

# What the operators count on.  AQE splits hot join partitions, coalesces small ones and turns
# joins into broadcasts by measured size.  UTC keeps text and wall-clock times in step.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str, cpus: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; on a cluster, bring your own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {**RECOMMENDED, "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the one the cluster shares.

    The shared folder is the session's ``spark.checkpoint.dir``.  Only a local session may go without.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="twinsync-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever the session was started; once per session.

    The package goes to the shared folder as a ZIP file, from which the executors take it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root, packed = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    path = f"{work_folder(spark, 'code')}/twinsync.zip"
    system, inner = open_path(path)
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    with system.open_output_stream(inner) as stream:
        stream.write(packed.getvalue())
    context.addPyFile(path)
    _shipped.add(context.applicationId)
