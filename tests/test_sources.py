"""The Zarr data source, TIFF files that many tasks read, and point-spread functions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_images import frame, image
from voxelspark.operators import arrays, deconvolve
from voxelspark.sources import datasource, tiff, zarr


@pytest.fixture
def store(spark, tmp_path):
    datasource.register(spark)
    stack = np.random.default_rng(1).integers(0, 500, (6, 10, 8))
    path = f"{tmp_path}/a.zarr"
    zarr.write(frame(spark, stack), path, zarr.sharded((1, 1, 1, 6, 10, 8), (1, 1, 1, 2, 10, 8), (1, 1, 1, 1, 5, 4), "uint16"))
    return path, stack


def test_source_reads_what_the_reader_reads(spark, store):
    path, stack = store
    rows = spark.read.format("zarr").load(path)
    assert (image(rows, stack.shape) == stack).all() and rows.count() == stack.size
    part = rows.where("z >= 2 and z < 5 and y = 7 and x in (1, 6) and v > 100")
    want = {(z, 7, x): stack[z, 7, x] for z in range(2, 5) for x in (1, 6) if stack[z, 7, x] > 100}
    assert {(r["z"], r["y"], r["x"]): r["v"] for r in part.collect()} == want and want
    assert rows.where("z > 3 and z < 2").count() == 0


def test_filters_prune_files_and_inner_chunks(spark, store):
    """Without the files that a filter rules out a read that it does not touch still works, and one without it fails."""
    import os

    path, stack = store
    reader = datasource.Zarr({"path": path, "taskbytes": "1"}).reader(None)
    assert len(reader.partitions()) == 3
    left = list(reader.pushFilters([datasource.GreaterThanOrEqual(("z",), 4), datasource.LessThan(("y",), 5), datasource.EqualTo(("v",), 3)]))
    assert [p.places for p in reader.partitions()] == [[(0, 0, 0, 2, 0, 0)]] and len(left) == 1
    sizes = {b.num_rows for p in reader.partitions() for b in reader.read(p)}
    assert sizes == {20} and sum(b.num_rows for b in reader.read(reader.partitions()[0])) == 2 * 5 * 8
    for k in (0, 1):
        file = f"{path}/c/0/0/0/{k}/0/0"
        data = bytearray(open(file, "rb").read())
        data[-8] ^= 1
        open(file, "wb").write(data)
    assert os.path.exists(file) and spark.read.format("zarr").load(path).where("z >= 4").count() == 160
    with pytest.raises(Exception, match="damaged"):
        spark.read.format("zarr").load(path).count()


@pytest.mark.parametrize("shard", [None, "1,1,1,4,8,8"])
def test_source_writes_rows_in_any_order(spark, store, tmp_path, shard):
    path, stack = store
    out = f"{tmp_path}/b.zarr"
    rows = spark.read.format("zarr").load(path).where("z < 5").orderBy(F.rand(1)).repartition(4)
    writer = rows.write.format("zarr").mode("append").option("shape", "1,1,1,5,10,8").option("chunk", "1,1,1,2,4,4")
    (writer.option("shard", shard) if shard else writer).save(out)
    assert (image(zarr.read(spark, out), (5, 10, 8)) == stack[:5]).all()
    import os

    assert not [n for n in os.listdir(out) if n.startswith("_parts")]


def test_pages_of_one_file_go_to_many_tasks(spark, tmp_path):
    stack = np.random.default_rng(3).integers(0, 60000, (1000, 4, 5)).astype(np.uint16)
    for compress in (False, True):
        path = f"{tmp_path}/{compress}.ome.tif"
        tiff.write(path, stack, "ZYX", compress)
        index = tiff.page_index(spark, path, "zyx")
        assert index.count() == 1000 and index.agg(F.sum(F.expr("counts[0]"))).first()[0] < 60_000 and index.where("at[3] = 999").count() == 1
        blocks = tiff.read_blocks(spark, path, "zyx", task_bytes=8192)
        tasks = blocks.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        assert len(tasks) >= 8 and max(r["count"] for r in tasks) < 300
        assert (image(arrays.voxels(blocks, (1, 1, 1, 1000, 4, 5)), stack.shape) == stack).all()
    with open(path, "rb") as f:
        data = f.read()
    fetched = []
    list(tiff.directory(lambda at, n: fetched.append(n) or data[at : at + n]))
    assert sum(fetched) < len(data)


def width(profile, step):
    """Full width at half maximum, by linear interpolation."""
    half, top = profile.max() / 2, int(profile.argmax())
    right = next(i for i in range(top, len(profile)) if profile[i] < half)
    left = next(i for i in range(top, -1, -1) if profile[i] < half)
    cross = lambda a, b: a + (profile[a] - half) / (profile[a] - profile[b]) * (b - a)
    return (cross(right - 1, right) - cross(left + 1, left)) * step


@pytest.mark.parametrize("na,index", [(1.35, 1.4), (1.05, 1.33), (0.5, 1.0)])
def test_vectorial_widths_and_energy(na, index):
    wavelength, fine = 0.52, 0.01
    lateral, axial = deconvolve.resolution(wavelength, na, index)
    r = np.arange(0, 1.5, fine)
    across = deconvolve.vectorial_intensity(r, np.zeros(1), wavelength, na, index)[0]
    assert width(np.concatenate([across[:0:-1], across]), fine) == pytest.approx(lateral, rel=0.2)
    z = np.arange(-4, 4, 0.02)
    along = deconvolve.vectorial_intensity(np.zeros(1), z, wavelength, na, index)[:, 0]
    assert width(along, 0.02) == pytest.approx(axial, rel=0.45)
    wide = np.arange(0, 40, 0.02)
    energy = (deconvolve.vectorial_intensity(wide, np.array([0.0, 0.4, 0.9]), wavelength, na, index) * wide).sum(1)
    assert energy == pytest.approx(energy[0], rel=0.02)


def test_bessel_values():
    x = np.linspace(0, 60, 500)
    series = lambda n, v: sum((-1) ** m / (math.factorial(m) * math.factorial(m + n)) * (v / 2) ** (2 * m + n) for m in range(60))
    for n in range(3):
        assert deconvolve.bessel(n, x[:100]) == pytest.approx([series(n, v) for v in x[:100]], abs=1e-9)
    assert (deconvolve.bessel(0, x) ** 2 + 2 * sum(deconvolve.bessel(n, x) ** 2 for n in range(1, 100))) == pytest.approx(1)


def test_skewed_sampling_is_the_model_at_slanted_places():
    pixel, step, theta = 0.115, 0.4, 30.0
    psf = deconvolve.skewed_psf(0.52, 1.35, 1.4, pixel, step, theta, (9, 15, 11))
    assert psf.sum() == pytest.approx(1) and psf.argmax() == np.ravel_multi_index((4, 7, 5), psf.shape) and (psf >= 0).all()
    plain = np.zeros(psf.shape)
    for n, h, w in np.ndindex(psf.shape):
        depth, along, across = (h - 7) * pixel * 0.5, (n - 4) * step + (h - 7) * pixel * math.cos(math.radians(30)), (w - 5) * pixel
        plain[n, h, w] = deconvolve.vectorial_intensity(np.array([math.hypot(along, across)]), np.array([depth]), 0.52, 1.35, 1.4)[0, 0]
    assert psf == pytest.approx(deconvolve.apodise(plain / plain.sum()), abs=2e-4)
