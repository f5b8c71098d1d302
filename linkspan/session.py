"""Sessions, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def session(app: str = "linkspan", **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC. ``conf`` overrides."""
    base = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    builder = SparkSession.builder.appName(app)
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Sends the package to the executors' Python, once for each application: their folder and path may be others."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        root = Path(__file__).resolve().parent
        path = os.path.join(tempfile.mkdtemp(prefix="linkspan-ship-"), "linkspan_package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, Path(root.name) / file.relative_to(root))
        spark.sparkContext.addPyFile(path)
    return spark


def settle(df: DataFrame) -> DataFrame:
    """``df`` computed once, with its lineage cut, in the folder that the cluster names in spark.checkpoint.dir."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="linkspan-"))
    return df.checkpoint()


def settle_pressed(df: DataFrame) -> DataFrame:
    """``settle`` for long texts: checkpoints are written as they are, so batches of rows are compressed before."""

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_pydict({"pressed": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
        pa.default_memory_pool().release_unused()

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0):
                yield from pa.ipc.open_stream(row.as_buffer())
        pa.default_memory_pool().release_unused()

    return settle(df.mapInArrow(press, "pressed binary")).mapInArrow(opened, df.schema)
