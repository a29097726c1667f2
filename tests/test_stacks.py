"""Stacks that are put together from planes as these arrive."""

import numpy as np
from pyspark.sql import functions as F

from tests.test_blocks import scene
from tests.test_images import brute_deskew
from voxelspark.operators import deskew
from voxelspark.streaming import arrivals

G = deskew.Geometry(5, 9, 6)


def land(spark, folder, rows):
    spark.createDataFrame(rows, arrivals.PLANES).coalesce(1).write.mode("append").parquet(folder)


def test_planes_spread_over_files_give_the_batch_result(spark, tmp_path):
    folder, sink, log = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/log"
    stacks = {(t, p): scene((5, 9, 6), 10 * t + p).astype("<u2") for t in range(2) for p in range(2)}
    planes = [(t, p, 0, z, s[z].tobytes()) for (t, p), s in stacks.items() for z in range(5)]
    order = np.random.default_rng(1).permutation(len(planes)).tolist()
    last = next(k for k in order if planes[k][:2] == (1, 1))
    order.remove(last)
    go = lambda: arrivals.start_stacks(spark.readStream.schema(arrivals.PLANES).parquet(folder), sink, log, 100.0, 0.24, G).awaitTermination()
    land(spark, folder, [planes[k] for k in order[:9]] + [planes[order[0]], (0, 0, 0, 7, b"x"), (None, 0, 0, 1, b""), (0, 0, 0, 1, b"short"), (0, 0, 0, None, None)])
    go()
    land(spark, folder, [planes[k] for k in order[9:]])
    go()

    def found():
        out = {}
        for r in spark.read.parquet(sink).collect():
            t, p, _, _, y, x = r["origin"]
            out.setdefault((t, p), np.zeros((G.out[1], 6)))[y : y + r["shape"][4], x : x + r["shape"][5]] = np.frombuffer(r["data"], r["dtype"]).reshape(r["shape"][4:])
        return out

    have = found()
    assert set(have) == {(0, 0), (0, 1), (1, 0)}  # (1, 1) still lacks a plane
    land(spark, folder, [planes[last]])
    go()
    have = found()
    assert set(have) == set(stacks)
    for key, stack in stacks.items():
        assert (have[key] == brute_deskew(np.floor(np.clip((stack - 100.0) * 0.24, 0, 65535)), G).max(0)).all()


def test_a_stack_that_waits_too_long_leaves_with_zeros(spark, tmp_path):
    folder = f"{tmp_path}/in"
    stack = scene((5, 9, 6), 3).astype("<u2")
    land(spark, folder, [(0, 0, 0, z, stack[z].tobytes()) for z in (0, 3)])
    rows = arrivals.assemble_stacks(spark.readStream.schema(arrivals.PLANES).parquet(folder), 5, 9, 6, "2 seconds")
    query = rows.writeStream.format("memory").queryName("late").option("checkpointLocation", f"{tmp_path}/log").outputMode("append").trigger(processingTime="1 second").start()
    for _ in range(60):
        query.awaitTermination(1)
        if spark.table("late").count():
            break
    query.stop()
    r = spark.table("late").where(F.col("missing") == 3).first()
    image = np.frombuffer(r["data"], r["dtype"]).reshape(5, 9, 6)
    assert not r["complete"] and (image[[0, 3]] == stack[[0, 3]]).all() and not image[[1, 2, 4]].any()
