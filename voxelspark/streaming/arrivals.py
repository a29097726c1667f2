"""Frames that arrive as files: corrected, deskewed and projected as they come, whole stacks at once or plane by plane."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import arrays
from ..operators.deskew import Geometry, deskew_lines, lines, max_lines, voxels_of
from ..operators.pixel import camera_correct

VOXELS = "t int, p int, c int, z int, y int, x int, v int"


def voxel_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Voxels of Parquet files (t, p, c, z, y, x, v) as they arrive in a folder."""
    return spark.readStream.schema(VOXELS).parquet(folder)


def start(stream: DataFrame, sink: str, checkpoint: str, offset: float, gain: float, geometry: Geometry | None = None, flat: DataFrame | None = None) -> StreamingQuery:
    """Process what is there and stop: one Parquet table of maximum projections (t, p, c, y, x, v) for each micro-batch.

    A batch is corrected, deskewed where a geometry is given, and projected by itself, so no state is kept, however long the
    stream runs; a batch that runs again replaces its table. With a geometry all planes of a stack (t, p, c) must arrive in
    one file, as a deskewed row reads two of them. ``projections`` puts the batches together.
    """

    def save(batch: DataFrame, number: int) -> None:
        corrected = camera_correct(batch, offset, gain, flat)
        if geometry is None:
            flat_image = corrected.groupBy("t", "p", "c", "y", "x").agg(F.max("v").alias("v"))
        else:
            flat_image = voxels_of(max_lines(deskew_lines(lines(corrected, geometry.columns), geometry)))
        flat_image.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()


def projections(spark: SparkSession, sink: str) -> DataFrame:
    """The maximum over all batches that have been written: planes of one stack may have come in several."""
    return spark.read.parquet(sink).groupBy("t", "p", "c", "y", "x").agg(F.max("v").alias("v"))


# ---------------------------------------------------------------------------------------------- stacks from planes


STACKS = "t int, p int, c int, complete boolean, missing int, origin array<int>, shape array<int>, dtype string, data binary"
_STATE = "planes binary"


def assemble_stacks(stream: DataFrame, planes: int, height: int, width: int, wait: str | None = "10 minutes") -> DataFrame:
    """Stacks (t, p, c, complete, missing, origin, shape, dtype, data), each one block (see ``operators.arrays``), from planes that
    arrive in any files and any order: stream(t, p, c, z, data binary), where data is a plane of height x width unsigned
    16-bit numbers, little-endian.

    A stack leaves once all its planes have come, or ``wait`` (processing time, None: never) after its last one, with zeros for
    those that are missing; its state is then dropped. What is kept of a stack are its planes, compressed. A plane that comes twice
    counts once, the last one; planes out of range, of another size or null are left out. A plane that comes after its stack has
    left begins a new one.
    """
    milliseconds = int(pd.Timedelta(wait).total_seconds() * 1000) if wait else 0

    def build(key: tuple, seen: dict[int, bytes]) -> pd.DataFrame:
        image = np.zeros((planes, height, width), "<u2")
        for z, data in seen.items():
            image[z] = np.frombuffer(zlib.decompress(data), "<u2").reshape(height, width)
        t, p, c = (int(k) for k in key)
        return pd.DataFrame({"t": [t], "p": [p], "c": [c], "complete": [len(seen) == planes], "missing": [planes - len(seen)], "origin": [[t, p, c, 0, 0, 0]], "shape": [[1, 1, 1, planes, height, width]], "dtype": ["<u2"], "data": [image.tobytes()]})

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen: dict[int, bytes] = pickle.loads(state.get[0]) if state.exists else {}
        if state.hasTimedOut:
            state.remove()
            yield build(key, seen)
            return
        for rows in batches:
            for z, data in zip(rows.z, rows.data):
                if len(data) == 2 * height * width:
                    seen[int(z)] = zlib.compress(bytes(data), 1)
        if len(seen) == planes:
            if state.exists:
                state.remove()
            yield build(key, seen)
        elif seen:
            state.update((pickle.dumps(seen),))
            if wait:
                state.setTimeoutDuration(milliseconds)

    whole = stream.where(f"t is not null and p is not null and c is not null and data is not null and z >= 0 and z < {planes}").select("t", "p", "c", "z", "data")
    return whole.groupBy("t", "p", "c").applyInPandasWithState(update, STACKS, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout if wait else GroupStateTimeout.NoTimeout)


PLANES = "t int, p int, c int, z int, data binary"


def start_stacks(stream: DataFrame, sink: str, checkpoint: str, offset: float, gain: float, geometry: Geometry, flat: np.ndarray | None = None, wait: str = "10 minutes", every: str | None = None) -> StreamingQuery:
    """Deskew and project stacks as they become whole: stream(t, p, c, z, data), see ``assemble_stacks``. One Parquet table of blocks
    of maximum projections for each micro-batch, which a batch that runs again replaces. Without ``every`` it processes
    what is there and stops, and stacks that lack planes stay in the state for the next run, however long: a query that waits
    for time to pass never stops by itself."""
    stacks = assemble_stacks(stream, geometry.planes, geometry.rows, geometry.columns, wait if every else None)

    def save(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # a batch's stacks, read for their extent and their pixels
        high = batch.agg(*[F.max(a).alias(a) for a in "tpc"]).first()
        if high["t"] is not None:
            shape = (high["t"] + 1, high["p"] + 1, high["c"] + 1, geometry.planes, geometry.rows, geometry.columns)
            whole = arrays.deskew(arrays.correct(batch, offset, gain, flat), shape, geometry)
            arrays.project(whole, (*shape[:3], *geometry.out, geometry.columns)).write.mode("overwrite").parquet(f"{sink}/batch={number}")
        batch.unpersist()

    writer = stacks.writeStream.option("checkpointLocation", checkpoint).outputMode("append").foreachBatch(save)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
