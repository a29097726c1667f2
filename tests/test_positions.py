"""Positions from edge tables of any size, edges that are kept, and stacks from TIFF."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_blocks import scene
from tests.test_images import brute_deskew, frame, image
from voxelspark.operators import adjust, arrays, deskew, registration
from voxelspark.plans import commands
from voxelspark.sources import tiff, zarr


def graph(seed, n, t, bad=0):
    """Edges of a grid of n tiles with noise, some of them far off, and one tile that hangs on nothing."""
    rng = np.random.default_rng(seed)
    true = rng.normal(0, 5, (n, 3))
    side = int(n**0.5)
    pairs = [(i, j) for i in range(n - 1) for j in (i + 1, i + side) if j < n - 1]
    out = []
    for k, (i, j) in enumerate(pairs):
        shift = true[j] - true[i] + rng.normal(0, 0.1, 3) + (40.0 if k < bad else 0.0)
        out.append((t, i, j, *map(float, shift), float(rng.uniform(0.5, 1))))
    return out


def test_conjugate_gradients_on_tables(spark, method="TWO_ROUND_ITERATIVE", bad=1):
    rows = graph(1, 10, 0, bad) + graph(2, 5, 1)
    edges = spark.createDataFrame(rows, "t int, i int, j int, dz double, dy double, dx double, score double")
    tiles = spark.createDataFrame([(0, p) for p in range(10)] + [(1, p) for p in range(5)] + [(2, 5)], "t int, p int")
    want = {(r["t"], r["p"]): (r["dz"], r["dy"], r["dx"]) for r in registration.solve_offsets(edges, tiles, method).collect()}
    got = {(r["t"], r["p"]): (r["dz"], r["dy"], r["dx"]) for r in adjust.solve_offsets(edges, tiles, method).collect()}
    assert set(got) == set(want) and len(got) == 16 and got[(2, 5)] == (0, 0, 0)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-6)
    with pytest.raises(ValueError):
        adjust.solve_offsets(edges, tiles, "other")


def test_edges_are_registered_once(spark, tmp_path):
    store = f"{tmp_path}/edges.parquet"
    whole = scene((3, 30, 60), 5)
    tiles = spark.createDataFrame([(0, p, 0.0, 0.0, p * 15.0) for p in range(3)], "t int, p int, stage_z double, stage_y double, stage_x double")
    parts = [whole[:, :, 15 * p : 15 * p + 24] for p in range(3)]
    shape = {"z": 3, "y": 30, "x": 24}

    def run(stacks):
        blocks = arrays.of_voxels(frame(spark, stacks[0], 0))
        for p, s in enumerate(stacks[1:], 1):
            blocks = blocks.unionByName(arrays.of_voxels(frame(spark, s, p)))
        own = tiles.where(F.col("p") < len(stacks))
        found = registration.stored_edges(blocks, registration.overlap_pairs(own, 1.0, shape), store, (1, 1, 1), 3).collect()
        return {(r["i"], r["j"]): (r["dz"], r["dy"], r["dx"], round(r["score"], 6)) for r in found}, spark.read.parquet(store).count()

    first, n = run(parts[:2])
    assert n == 1 and first[(0, 1)][:3] == (0, 0, 0) and first[(0, 1)][3] > 0.99
    again, n = run(parts[:2])
    assert n == 1 and again == first
    more, n = run(parts)  # a new tile: its edge alone
    assert n == 2 and set(more) == {(0, 1), (1, 2)} and more[(0, 1)] == first[(0, 1)]
    changed, n = run([parts[0], parts[1], np.roll(parts[2], 1, 1)])
    assert n == 3 and changed[(0, 1)] == first[(0, 1)] and changed[(1, 2)][1] == -1


def test_process_of_a_tiff_stack(spark, tmp_path):
    stack = np.stack([scene((5, 9, 6), 7), scene((5, 9, 6), 8)], 1)[None].astype(np.uint16)  # t z c y x
    settings = {"isStageScanning": False, "channels": [{"config_": "525 em"}, {"config_": "680 em"}]}
    tilt = 60.0
    summary = {"z-step_um": 0.4 * np.tan(np.deg2rad(tilt)), "PixelSize_um": 0.115, "StageScanAnglePathA": tilt, "Position_X": "3.5 µm", "Position_Y": "-2 µm", "SPIMAcqSettings": json.dumps(settings)}
    path = f"{tmp_path}/run.ome.tif"
    tiff.write(path, stack[0].reshape(10, 9, 6), "ZYX", metadata={"pvcam-Port": "2 - Speed", "pvcam-Offset": "100", "Summary": summary})
    data = open(path, "rb").read()
    data = data.replace(b'SizeZ="10" SizeC="1" SizeT="1"', b'SizeZ="5"  SizeC="2" SizeT="1"')
    open(path, "wb").write(data)
    acq = commands.acquisition_of_tiff(path)
    assert acq.channels == ["525nm", "680nm"] and acq.theta == 30.0 and acq.step == pytest.approx(0.4) and acq.gain == 0.85
    out = commands.process(spark, path, max_projection=False)
    assert out["deskewed"] == f"{tmp_path}/run_deskewed.zarr"
    for c in range(2):
        corrected = np.floor(np.clip((stack[0, :, c] - 100.0) * 0.85, 0, 65535))
        want = brute_deskew(corrected, deskew.Geometry(5, 9, 6, acq.theta, acq.step, acq.pixel))
        assert (image(zarr.read(spark, out["deskewed"]).where(F.col("c") == c), want.shape) == want).all() and want.any()
