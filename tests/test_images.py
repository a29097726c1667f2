"""Operators against the definitions, on tiny images."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelspark.functions import metadata as M
from voxelspark.operators import arrays, deconvolve, deskew, fusion, pixel, reduce, registration, stencil
from voxelspark.sources import codecs, tiff, zarr

AXES = ["t", "p", "c", "z", "y", "x"]


def frame(spark, stack, p=0):
    grid = np.indices(stack.shape).reshape(3, -1)
    return spark.createDataFrame([(0, p, 0, *map(int, i), int(v)) for i, v in zip(grid.T, stack.ravel())], "t int, p int, c int, z int, y int, x int, v int")


def image(df, shape, dtype=float):
    out = np.zeros(shape, dtype)
    for r in df.collect():
        out[r["z"], r["y"], r["x"]] = r["v"]
    return out


STACK = np.random.default_rng(0).integers(90, 2000, (5, 9, 6))


def brute_deskew(stack, g):
    nz, ny = g.out
    out = np.zeros((nz, ny, g.columns))
    for z in range(nz * g.factor):
        part = np.zeros((ny, g.columns))
        for y in range(ny):
            vp = y - z / g.tan
            pb = math.floor(vp / g.step)
            if not (0 <= pb and pb + 1 < g.planes):
                continue
            ahead = vp - pb * g.step
            vb, va = z / g.sin + ahead * g.cos, z / g.sin - (g.step - ahead) * g.cos
            jb, ja = math.floor(vb), math.floor(va)
            if min(ja, jb) < 0 or max(ja, jb) + 1 >= g.rows:
                continue
            part[y] = (((stack[pb + 1, ja + 1] * (va - ja) + stack[pb + 1, ja] * (1 - va + ja)) + stack[pb, jb + 1] * (vb - jb)) + stack[pb, jb] * (1 - vb + jb)) / g.step
        out[z // g.factor] += np.clip(part, 0, 65534)
    return np.floor(np.minimum(out, 65534) / g.factor)


def test_deskew(spark):
    g = deskew.Geometry(5, 9, 6)
    got = image(deskew.deskew(frame(spark, STACK), g), (*g.out, 6))
    assert (got == brute_deskew(STACK, g)).all() and got.any()


def test_shape_of_the_fixture():
    assert deskew.Geometry(5, 25, 64).shape()[:3] == (13, 40, 64)


def test_correction_and_crops(spark):
    got = image(pixel.camera_correct(frame(spark, STACK), 100.0, 0.24), STACK.shape)
    assert (got == np.floor(np.clip((STACK - 100.0) * 0.24, 0, 65535))).all()
    assert pixel.crop(frame(spark, STACK), "z", 1, 4).agg(F.max("z")).first()[0] == 2
    twice = pixel.flip(pixel.flip(frame(spark, STACK), "z", 5), "z", 5)
    assert (image(twice, STACK.shape) == STACK).all()


def test_block_means_truncate_between_axes(spark):
    got = image(reduce.downsample(frame(spark, STACK), 2, {"y": 9, "x": 6}), (5, 4, 3))
    y = STACK[:, :8].reshape(5, 4, 2, 6).mean(2) // 1
    assert (got == y.reshape(5, 4, 3, 2).mean(3) // 1).all()


def test_pyramid_sizes_and_translations(spark):
    one = reduce.pyramid(frame(spark, STACK), [2, 4]).groupBy("level").agg(F.max("y").alias("y")).collect()
    assert {r["level"]: r["y"] for r in one} == {1: 4, 2: 2}
    assert [r["shift_x"] for r in M.pyramid_transforms({"x": 1.0}, {"x": 0.0}, [2, 4, 8])] == [0, 0.5, 1.5, 3.5]


def test_profiles():
    assert fusion.feather_profile(6, 2) == [0, 0.5, 1, 1, 0.5, 0]
    assert fusion.feather_profile(5, 9) == [0, 0.5, 1, 0.5, 0]
    assert fusion.feather_profile(2, 1) == [1, 1]
    assert fusion.cosine_mask(4, 2) == pytest.approx([0, 1, 1, 0])
    assert [deconvolve.smooth_size(n) for n in (1, 5, 7, 13, 17, 25)] == [1, 6, 8, 16, 18, 27]


def test_weighted_fusion_keeps_a_constant(spark):
    stack = np.full((3, 6, 8), 500)
    both = frame(spark, stack).unionByName(frame(spark, stack, 1))
    tiles = spark.createDataFrame([(0, 0, 0.0, 0.0, 0.0), (0, 1, 0.0, 0.0, 0.5)], "t int, p int, stage_z double, stage_y double, stage_x double")
    got = fusion.fuse_3d(both, tiles, 0.1, stack.shape, (0, 2, 2)).where("y between 1 and 4 and x between 1 and 11").select("v").distinct().collect()
    assert [r["v"] for r in got] == [500]


def test_box_filter_clamps(spark):
    got = stencil.box_filter(frame(spark, np.array([[[0, 3, 6]]])), 1, {"x": 3}).orderBy("x").collect()
    assert [r["v"] for r in got] == [1, 3, 5]


def test_ssim_of_equal_images(spark):
    same = frame(spark, STACK).select("z", "y", "x", F.col("v").alias("a"), F.col("v").alias("b"))
    assert stencil.ssim(same, 1, {"z": 5, "y": 9, "x": 6}).first()["ssim"] == pytest.approx(1)


def test_registration_finds_planted_shifts():
    base = np.random.default_rng(1).random((1, 40, 48))
    assert registration.phase_shift(base, np.roll(base, (0, 3, -5), (0, 1, 2)), 1).tolist() == [0, -3, 5]
    links = np.array([(0, 1, 1, 2, 3, 1), (1, 2, 0, 1, 0, 1), (0, 2, 1, 3, 3, 1), (0, 2, 40, 3, 3, 0.01)], float)
    found = registration.optimize(links, 3, "TWO_ROUND_ITERATIVE", 0.5, 1.5)
    assert found == pytest.approx(np.array([[0, 0, 0], [1, 2, 3], [1, 3, 3]]))


def test_metadata_helpers(spark):
    assert M.find_key({"a": [{"mode": None}, {"b": {"mode": "stage"}}]}, "mode") == "stage"
    rows = spark.createDataFrame([(1, "B"), (2, "A"), (3, "B"), (4, ""), (5, "C")], "n int, ch string")
    assert [r["ch"] for r in M.ordered_distinct(rows, "ch", "n").orderBy("place").collect()] == ["B", "A", "C"]


@pytest.mark.parametrize("inner", [None, (1, 1, 1, 1, 3, 2)])
@pytest.mark.parametrize("codec", ["", "zstd", "blosc"])
def test_zarr_round_trip(spark, tmp_path, inner, codec):
    path = f"{tmp_path}/a.zarr"
    stack = STACK * (np.arange(9) > 2)[None, :, None]  # chunks without a voxel that is not 0 are not stored
    chunk = (1, 1, 1, 2, 6, 4) if inner else (1, 1, 1, 2, 4, 4)
    zarr.write(frame(spark, stack), path, zarr.Layout((1, 1, 1, 5, 9, 6), chunk, "<u2", codec, 0, inner=inner))
    if codec == "":
        return  # a store without a compressor is described as zstd by ``create``; only its files are written
    assert (image(zarr.read(spark, path), stack.shape) == stack).all()
    assert zarr.read(spark, path, dense=True).count() == stack.size
    part = zarr.read(spark, path, where={"y": (2, 5)}, dense=True)
    assert part.count() == 5 * 3 * 6 and (image(part, stack.shape)[:, 2:5] == stack[:, 2:5]).all()
    assert zarr.read(spark, path, where={"z": (4, 4)}).count() == 0


def test_layouts_of_stores(spark, tmp_path):
    own = zarr.acquisition_layout((2, 3, 2, 5, 9, 6))
    assert own.inner == (1, 1, 1, 1, 2, 1) and own.chunk == (1, 1, 1, 5, 10, 6)
    assert zarr.fused_2d_layout((2, 1, 3, 1, 900, 900)).chunk == (1, 1, 3, 1, 4096, 4096)
    assert zarr.fused_3d_layout((2, 3, 9, 900, 900)).chunk == (1, 1, 4, 2048, 2048)
    path = f"{tmp_path}/deskewed.zarr"
    zarr.write(frame(spark, STACK, 1), path, own)
    assert zarr.layout(path) == own
    assert (image(zarr.read(spark, path), STACK.shape) == STACK).all()
    M.merge_attributes(path, {"a": np.array([1, 2])})
    assert M.merge_attributes(path, {"b": 1}) == zarr.read_attributes(path) == {"a": [1, 2], "b": 1}


def test_blosc_buffers():
    rng = np.random.default_rng(0)
    for data in (b"", rng.integers(0, 50, 4000).astype("<u2").tobytes(), rng.integers(0, 65536, 999).astype("<u2").tobytes(), bytes(10_000)):
        assert codecs.blosc_decode(codecs.blosc_encode(data, 2)) == data
    # blocks that are split by byte, byte shuffle, and a shorter last block, put together by hand
    import struct
    import zlib as z

    data = rng.integers(0, 300, 700).astype("<u2").tobytes()
    blocks = [data[:1024], data[1024:]]
    planes = [np.frombuffer(b, np.uint8).reshape(-1, 2).T for b in blocks]
    first = b"".join(struct.pack("<i", len(c)) + c for c in (z.compress(p.tobytes()) for p in planes[0]))
    whole = z.compress(np.ascontiguousarray(planes[1]).tobytes())
    second = struct.pack("<i", len(whole)) + whole
    body = struct.pack("<2I", 24, 24 + len(first)) + first + second
    assert codecs.blosc_decode(struct.pack("<BBBBIII", 2, 1, 3 << 5 | 1, 2, len(data), 1024, 16 + len(body)) + body) == data
    assert codecs.crc32c(b"123456789") == 0xE3069283


def test_fill_values_are_read(spark, tmp_path):
    import json

    (tmp_path / "b.zarr").mkdir()
    meta = {"zarr_format": 2, "shape": [2, 3], "chunks": [2, 2], "dtype": "<u2", "compressor": {"id": "blosc"}, "fill_value": 7, "order": "C", "filters": None}
    (tmp_path / "b.zarr/.zarray").write_text(json.dumps(meta))
    (tmp_path / "b.zarr/0.0").write_bytes(codecs.blosc_encode(np.arange(4, dtype="<u2").tobytes(), 2))
    got = {(r["y"], r["x"]): r["v"] for r in zarr.read(spark, str(tmp_path / "b.zarr"), "yx").collect()}
    assert got == {(0, 0): 0, (0, 1): 1, (1, 0): 2, (1, 1): 3, (0, 2): 7, (1, 2): 7}


def test_damaged_shards_are_refused(spark, tmp_path):
    path = f"{tmp_path}/a.zarr"
    m = zarr.sharded((1, 1, 1, 5, 9, 6), (1, 1, 1, 5, 9, 6), (1, 1, 1, 1, 9, 6), "uint16")
    zarr.write(frame(spark, STACK), path, m)
    file = tmp_path / "a.zarr/c/0/0/0/0/0/0"
    data = bytearray(file.read_bytes())
    data[-10] ^= 1
    file.write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        zarr.read(spark, path).count()


def acquisition(spark, path, mode="mirror", n_p=2):
    """A small acquisition of two tiles that overlap, in one file a chunk."""
    rng = np.random.default_rng(2)
    scene = rng.integers(200, 2000, (5, 9, 10))
    parts = [frame(spark, scene[:, :, 4 * p : 4 * p + 6], p) for p in range(n_p)]
    both = parts[0].unionByName(parts[1])
    attributes = {"mode": mode, "image_mirror_step_um": 0.4, "scan_axis_step_um": 0.4, "excess_scan_positions": 1, "pixel_size_um": 0.115, "angle_deg": 30.0, "offset": 100.0, "e_to_ADU": 0.24}
    attributes["frame_metadatas"] = [{"mda_event": {"index": {"t": 0, "p": p}, "metadata": {"Stage": {"x_pos": 0.0, "y_pos": 0.46 * p, "z_pos": 0.0}, "DAQ": {"current_channel": "488nm"}}}} for p in range(n_p)]
    zarr.write(both, path, zarr.Layout((1, n_p, 1, 5, 9, 6), (1, 1, 1, 5, 9, 6), "<u2", "zstd", 0), attributes=attributes)
    return scene


def test_process_and_fuse(spark, tmp_path):
    from voxelspark.plans import commands

    path = f"{tmp_path}/run.zarr"
    scene = acquisition(spark, path)
    acq = commands.acquisition(path)
    assert acq.channels == ["488nm"] and acq.positions == {0: (0.0, 0.0, 0.0), 1: (0.0, 0.0, 0.46)}
    out = commands.process(spark, path)
    corrected = np.floor(np.clip((scene - 100.0) * 0.24, 0, 65535))
    g = deskew.Geometry(5, 9, 6)
    for p in range(2):
        want = brute_deskew(corrected[:, :, 4 * p : 4 * p + 6], g)
        got = image(zarr.read(spark, out["deskewed"]).where(F.col("p") == p), want.shape)
        assert (got == want).all()
        flat = image(zarr.read(spark, out["projection"]).where(F.col("p") == p), (1, *want.shape[1:]))
        assert (flat[0] == want.max(0)).all()
    fused = commands.fuse(spark, out["projection"], register=False)
    assert zarr.layout(fused).shape[4:] == (32, 16) and zarr.read(spark, fused).agg(F.max("x")).first()[0] <= 15
    whole = commands.fuse(spark, path, register=False, factors=(2,))
    axes, paths = zarr.levels(whole)
    assert (axes, paths) == ("tczyx", ["scale0/image", "scale1/image"])
    base, half = (zarr.open_level(spark, whole, n) for n in (0, 1))
    strided = base.where("z % 2 = 0 and y % 2 = 0 and x % 2 = 0 and v <> 0").count()
    assert strided == half.where("v <> 0").count() > 0
    with pytest.raises(ValueError):
        zarr.open_level(spark, whole, dataset="other")
    with pytest.raises(ValueError):
        commands.acquisition(whole)


def test_process_flips_and_crops_stage_scans(spark, tmp_path):
    from voxelspark.plans import commands

    path = f"{tmp_path}/run.zarr"
    scene = acquisition(spark, path, "stage")
    out = commands.process(spark, path, max_projection=False, crop_after_deskew=False)
    corrected = np.floor(np.clip((scene - 100.0) * 0.24, 0, 65535))[::-1][1:, :, :6]
    want = brute_deskew(corrected, deskew.Geometry(4, 9, 6))
    assert (image(zarr.read(spark, out["deskewed"]).where("p = 0"), want.shape) == want).all()


def test_arrivals_are_deskewed_and_projected(spark, tmp_path):
    from voxelspark.streaming import arrivals

    folder, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    g = deskew.Geometry(5, 9, 6)
    for p in range(2):
        frame(spark, STACK + p, p).coalesce(1).write.mode("append").parquet(folder)
        for _ in range(2):  # nothing new the second time
            arrivals.start(arrivals.voxel_stream(spark, folder), sink, f"{tmp_path}/log", 100.0, 0.24, g).awaitTermination()
    rows = arrivals.projections(spark, sink)
    for p in range(2):
        want = brute_deskew(np.floor(np.clip((STACK + p - 100.0) * 0.24, 0, 65535)), g).max(0)
        got = image(rows.where(F.col("p") == p).withColumn("z", F.lit(0)), (1, *want.shape))
        assert (got[0] == want).all()


def sparse(spark, share=0.5, shape=(7, 20, 6)):
    rng = np.random.default_rng(5)
    return rng.integers(100, 2000, shape) * (rng.random(shape) < share)


@pytest.mark.parametrize("block", [2, 32])
def test_sparse_stacks_give_what_dense_ones_give(spark, block):
    stack = sparse(spark)
    dense = frame(spark, stack)
    g = deskew.Geometry(7, 20, 6)
    for rows in (dense, dense.where("v <> 0")):
        assert (image(deskew.deskew(rows, g, block=block), (*g.out, 6)) == brute_deskew(stack, g)).all()
    reverse = image(deskew.deskew(dense.where("v <> 0"), g, reverse=True), (*g.out, 6))
    assert (reverse == brute_deskew(stack, g)[::-1]).all()


def test_stencils_of_sparse_stacks(spark):
    stack = sparse(spark, 0.4, (4, 11, 13))
    rows, small = frame(spark, stack).where("v <> 0"), {"z": 2, "y": 4, "x": 5}
    sizes = dict(zip("zyx", stack.shape))
    wide = np.pad(stack, 1, "edge").astype(float)
    windows = np.lib.stride_tricks.sliding_window_view(wide, (3, 3, 3))
    assert image(stencil.box_filter(rows, 1, sizes, small), stack.shape) == pytest.approx(windows.mean((-1, -2, -3)))
    flat = np.lib.stride_tricks.sliding_window_view(np.pad(stack, [(0, 0), (1, 1), (1, 1)], "edge"), (3, 3), (1, 2))
    assert (image(stencil.median_3x3(rows, 11, 13, small), stack.shape) == np.median(flat, (-1, -2))).all()
    noise = spark.createDataFrame([(2, 3, 400.0), (10, 12, 500.0), (0, 0, 10.0)], "y int, x int, noise double")
    want = stack.copy()
    for y, x in ((2, 3), (10, 12)):
        want[:, y, x] = np.median(flat, (-1, -2))[:, y, x]
    assert (image(stencil.replace_hot_pixels(rows, noise, 11, 13, block=small), stack.shape) == want).all()
    open_ = np.pad(stack.astype(float), [(0, 0), (3, 3), (3, 3)], constant_values=np.inf)
    under = np.min([open_[:, 3 + dy : 14 + dy, 3 + dx : 16 + dx] + h for dy, dx, h in stencil.ball(3)], 0)
    assert image(stencil.rolling_ball(rows, 3, 11, 13, small), stack.shape) == pytest.approx(under)
    other = np.roll(stack, 1, 2)
    pairs = frame(spark, stack).withColumnRenamed("v", "a").join(frame(spark, other).withColumnRenamed("v", "b"), AXES)
    one, many = (stencil.ssim(pairs, 1, sizes, block=b).first()["ssim"] for b in (None, small))
    assert one == pytest.approx(many) == registration.window_ssim(stack, other, 3)


def test_blocks_of_a_fused_image(spark, monkeypatch):
    """Tiles that lie over several blocks, one of them without some rows."""
    monkeypatch.setattr(fusion, "FUSED", 4)
    rng = np.random.default_rng(6)
    tiles = spark.createDataFrame([(0, 0, 0.0, 0.0, 0.0), (0, 1, 0.0, 0.35, 0.55), (0, 2, 0.0, 0.95, 0.25)], "t int, p int, stage_z double, stage_y double, stage_x double")
    images = rng.integers(1, 900, (3, 1, 9, 7))
    images[1, 0, [0, 4, 8]] = 0
    offsets = [(0, 0), (3, 5), (9, 2)]
    rows = deskew.lines(frame(spark, images[0]).unionByName(frame(spark, images[1], 1).where("y not in (0, 4, 8)")).unionByName(frame(spark, images[2], 2)), 7).drop("z")
    w = np.outer(fusion.cosine_mask(9), fusion.cosine_mask(7))
    for mode in ("fold", "weighted_mean"):
        fold, total, weight = (np.zeros((20, 16)) for _ in range(3))
        for (y, x), im in zip(offsets, images[:, 0]):
            part = np.s_[y : y + 9, x : x + 7]
            fold[part] = np.floor(np.clip((fold[part] + im * w) / (1 + w), 0, 65535))
            total[part] += im * w
            weight[part] += w
        want = fold if mode == "fold" else np.floor(np.divide(total, weight, out=np.zeros_like(total), where=weight > 0) + 1e-9)
        got = np.zeros((20, 16))
        for r in fusion.fuse_2d(rows, tiles, 0.1, 9, 7, mode).collect():
            got[r["y"], r["x"]] = r["v"]
        assert (got == want).all()


def test_weights_are_not_cut(spark):
    """Pixels of a small weight keep their value."""
    stack = np.full((1, 3, 40), 500)
    tiles = spark.createDataFrame([(0, 0, 0.0, 0.0, 0.0)], "t int, p int, stage_z double, stage_y double, stage_x double")
    got = fusion.fuse_3d(frame(spark, stack), tiles, 0.1, stack.shape, (0, 0, 4000)).where("x between 1 and 38").select("v").distinct().collect()
    assert [r["v"] for r in got] == [500]


def test_offsets_are_the_least_squares(spark):
    rng = np.random.default_rng(7)
    links = np.array([(i, j, *rng.normal(size=3), rng.random() + 0.1) for i in range(12) for j in range(i + 1, 12) if rng.random() < 0.4 and (i < 8) == (j < 8)])
    rows = np.zeros((len(links) + 1, 12))
    want = np.zeros((len(links) + 1, 3))
    for k, (i, j, *d, s) in enumerate(links):
        rows[k, int(i)], rows[k, int(j)] = -np.sqrt(s), np.sqrt(s)
        want[k] = np.sqrt(s) * np.array(d)
    rows[-1, 0] = 1
    assert registration.least_squares(links, 12) == pytest.approx(np.linalg.lstsq(rows, want, rcond=None)[0], abs=1e-8)


@pytest.mark.parametrize("shift", [(0, 0, 0), (0, 6, -9), (0, -15, 3), (0, 2, 30)])
def test_large_shifts_are_unwrapped(shift):
    scene = np.random.default_rng(8).random((1, 120, 160))
    fixed = scene[:, 40:80, 50:98]
    moving = scene[:, 40 + shift[1] : 80 + shift[1], 50 + shift[2] : 98 + shift[2]]
    assert registration.phase_shift(fixed, moving) == pytest.approx(np.array(shift), abs=0.35)


def test_positions_are_refined(spark):
    """Tiles whose true places are off from where the stage says: found through reduced patches."""
    scene = np.random.default_rng(9).random((6, 60, 110)).repeat(2, 1).repeat(2, 2) * 1000
    parts = [scene[:, :80, :100], scene[:, 6:86, 74:174]]
    both = frame(spark, parts[0]).unionByName(frame(spark, parts[1], 1))
    tiles = spark.createDataFrame([(0, 0, 0.0, 0.0, 0.0), (0, 1, 0.0, 0.0, 70.0)], "t int, p int, stage_z double, stage_y double, stage_x double")
    got = {r["p"]: (r["stage_y"], r["stage_x"]) for r in registration.refine_positions(arrays.of_voxels(both), tiles, 1.0, {"z": 6, "y": 80, "x": 100}, (1, 2, 2), 5, 0.0).collect()}
    assert got[1][0] - got[0][0] == pytest.approx(6, abs=1) and got[1][1] - got[0][1] == pytest.approx(74, abs=1)


def test_deconvolution_sharpens_and_pads_by_reflection(spark):
    psf = deconvolve.gaussian_psf(0.5, 1.35, 1.4, (0.4, 0.115, 0.115), (3, 7, 7))
    scene = np.zeros((5, 20, 22))
    scene[2, 8, 9] = scene[2, 8, 15] = 60_000
    blurred = np.random.default_rng(1).poisson(np.maximum(deconvolve.convolve(scene, deconvolve.otf(psf, scene.shape)), 0) + 5)
    out = deconvolve.rlgc(blurred, psf, start=float(np.median(blurred)))
    assert out.max() > 2 * blurred.max() and out.shape == scene.shape
    rows = deconvolve.deconvolve(frame(spark, blurred), psf, scene.shape)
    assert image(rows, scene.shape) == pytest.approx(out)
    wide = np.random.default_rng(2).poisson(50, (40, 8, 8))
    parts = image(deconvolve.deconvolve(frame(spark, wide), psf, wide.shape, slab=16, overlap=4), wide.shape)
    assert parts.mean() == pytest.approx(2 * wide.mean(), rel=0.3) and (parts > 0).all()
    assert [deconvolve.slab_planes(n) for n in (256, 257, 512, 513)] == [512, 256, 256, 128]
    with pytest.raises(RuntimeError):
        deconvolve.rlgc(blurred, psf, rounds=1)


def test_illumination_reads_the_middle_positions(spark, tmp_path):
    stack = np.random.default_rng(3).integers(200, 2000, (6, 4, 5))
    rows = frame(spark, stack, 0)
    for p in range(1, 24):
        rows = rows.unionByName(frame(spark, stack[:, :1, :1], p))
    chosen = deconvolve.sample_planes(rows, 24, 6, batches=5)
    got = chosen.select("p", "z", "batch").distinct().collect()
    spots = {r["p"] for r in got}
    assert len(spots) == 15 and min(spots) >= 2 and max(spots) < 22
    assert all(sorted(r["batch"] for r in got if r["p"] == p) == list(range(5)) for p in spots)
    few = deconvolve.batch_means(frame(spark, stack), 100.0, 0.24, 6, batches=3).groupBy("batch").count().collect()
    assert {(r["batch"], r["count"]) for r in few} == {(0, 20), (1, 20), (2, 20)}
    made = []
    make = lambda: made.append(1) or spark.createDataFrame([(0, 0, 0, 1.0)], "c int, y int, x int, ff double")
    for _ in range(2):
        assert deconvolve.cached_flat_field(spark, f"{tmp_path}/flat", make).count() == 1
    assert len(made) == 1


def test_instrument_metadata_of_tiff(spark, tmp_path):
    path = f"{tmp_path}/a.tif"
    tiff.write(path, STACK.astype(np.uint16), "ZYX", metadata={"pvcam-Offset": "100", "pvcam-Port": "2 - Speed"})
    with open(path, "rb") as f:
        data = f.read()
    assert tiff.camera(tiff.instrument(data)) == (100.0, 0.85)
    with pytest.raises(ValueError):
        tiff.camera({"pvcam-Offset": 1, "pvcam-Port": "none"})
    names = tiff.write_planes(frame(spark, STACK, 3), f"{tmp_path}/planes", "yx", {"y": 9, "x": 6})
    assert sorted(r["name"] for r in names.collect())[1] == "t0000_p0003_c0000_z0001.tif"
    assert (image(tiff.read(spark, f"{tmp_path}/planes/t0000_p0003_c0000_z0001.tif", "yx"), (1, 9, 6)) == STACK[1]).all()
    with pytest.raises(ValueError):
        tiff.frame_array(frame(spark, STACK), ("z", "y", "x"), limit=10)


def test_tiles_are_read_by_number(spark):
    rows = frame(spark, STACK, 2)
    assert pixel.read_tile(rows, 2, 4, z=(0, 2)).count() == 2 * 9 * 6
    with pytest.raises(ValueError):
        pixel.read_tile(rows, -1, 4)
    with pytest.raises(IndexError):
        pixel.read_tile(rows, 4, 4)
    with pytest.raises(ValueError):
        pixel.normalise_axes(rows, "zcy")
    with pytest.raises(ValueError):
        M.skewed_coords(F.lit(1), F.lit(1), 30.0, 0.1, 0.4, "other")


def test_metadata_rules(spark):
    tiles = spark.createDataFrame([(0, 0.0), (1, 0.00005), (2, 5.0), (3, 10.0)], "p int, at double")
    assert tuple(M.grid_overlap(tiles, "at", 60, 0.1).first()) == (3, 1.0)
    assert spark.range(1).select(M.plain_number(F.lit("0.4 \u00b5m"))).first()[0] == 0.4
    with pytest.raises(Exception, match="unknown camera port"):
        spark.range(1).select(M.required_gain(F.lit("none"))).collect()


def test_zarr_version_2(spark, tmp_path):
    import json

    (tmp_path / "b.zarr").mkdir()
    meta = {"zarr_format": 2, "shape": [2, 3], "chunks": [2, 3], "dtype": "<u2", "compressor": None, "fill_value": 0, "order": "C", "filters": None}
    (tmp_path / "b.zarr/.zarray").write_text(json.dumps(meta))
    (tmp_path / "b.zarr/0.0").write_bytes(np.arange(6, dtype="<u2").tobytes())
    got = zarr.read(spark, str(tmp_path / "b.zarr"), "yx")
    assert sorted(r["v"] for r in got.collect()) == list(range(6))


def test_tiff_round_trip(spark, tmp_path):
    stack = STACK.astype(np.uint16)
    for compress in (False, True):
        path = str(tmp_path / f"{compress}.tif")
        tiff.write(path, stack, "ZYX", compress)
        assert (image(tiff.read(spark, path, "zyx"), STACK.shape) == STACK).all()


def test_deconvolution_keeps_zeros():
    psf = deconvolve.gaussian_psf(0.5, 1.35, 1.4, (0.4, 0.115, 0.115), (3, 5, 5))
    assert deconvolve.rlgc(np.zeros((4, 8, 8)), psf).shape == (4, 8, 8)


def test_entry_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_multiscale_documents_read_back(spark):
    import json

    new = M.multiscale_json("n", list("tcyx"), {"y": 0.5, "x": 0.25}, {"y": 1.0, "x": 2.0}, [2, 4], ["a"])
    old = M.multiscale_json_v04([{"name": a} for a in "tcyx"], 0.5, (1.0, 2.0), [], 3)
    turned = {"multiscales": [{"axes": [{"name": "x"}], "datasets": [{"path": "p", "coordinateTransformations": [{"type": "translation", "translation": [3.0]}, {"type": "scale", "scale": [2.0]}]}, {"path": "bare"}]}]}
    read = lambda *docs: [tuple(r) for r in M.multiscale_levels(spark.createDataFrame([(d if d is None else json.dumps(d),) for d in docs], "json string")).collect()]
    assert set(read(new)) >= {(0, "scale0/image", "y", 0.5, 1.0), (2, "scale2/image", "y", 2.0, 1.75), (2, "scale2/image", "x", 1.0, 2.375), (1, "scale1/image", "t", 1.0, 0.0)}
    assert set(read(old)) >= {(2, "2", "y", 2.0, 1.75), (2, "2", "x", 2.0, 2.75)}
    assert set(read(turned)) == {(0, "p", "x", 2.0, 6.0), (1, "bare", "x", 1.0, 0.0)}
    assert read(None, {}) == []


def test_scan_geometry_and_skewed_size(spark):
    row = spark.range(1).select(*M.scan_geometry(F.lit(45.0), F.lit(2.0)), *M.skewed_size(F.lit(1.0), F.lit(10.0), F.lit(1.0), math.pi / 6, 0.125, 0.5)).first()
    assert row[0] == 45 and row[1] == pytest.approx(2)
    rows, columns = math.ceil(8 / math.sin(math.pi / 6)), 8
    planes = int(math.ceil(0.5 * (rows + 1) * 0.125 * math.cos(math.pi / 6) + 10) / 0.5)
    assert list(row[2:]) == [n + (n % 2 == 0) for n in (planes, rows, columns)]


def test_tile_queries_read_every_tile_and_plane(spark, tmp_path):
    from voxelspark.plans.queries import QUERIES

    rng = np.random.default_rng(4)
    rows = [(i, rng.uniform(-1, 1, 64).tolist()) for i in range(3 * 125)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    stack = np.floor((np.array([e for _, e in rows], np.float32).astype(float) + 1) * 1000).reshape(3, 5, 25, 64) + 100
    got = np.full(stack.shape, np.nan)
    for r in QUERIES["hist_match"](spark, str(tmp_path)).collect():
        got[r["p"], r["z"], r["y"], r["x"]] = r["v"]
    for p in range(3):
        for z in range(5):
            assert got[p, z] == pytest.approx(registration.match_histogram(stack[(p + 1) % 3, z].ravel(), stack[p, z].ravel()).reshape(25, 64))
    shifts = {(r["p"], r["z"]): (r["dy"], r["dx"]) for r in QUERIES["phase_corr"](spark, str(tmp_path)).collect()}
    assert shifts == {(p, z): (-p, -2 * p) for p in range(3) for z in range(5)}


def test_overlaps_of_sparse_tiles(spark):
    """A voxel that only one tile has meets a 0, in whole patches and in reduced ones."""
    rng = np.random.default_rng(11)
    stacks = [rng.integers(1, 90, (4, 9, 12)) * (rng.random((4, 9, 12)) < 0.5) for _ in range(2)]
    rows = frame(spark, stacks[0]).unionByName(frame(spark, stacks[1], 1)).where("v <> 0")
    tiles = spark.createDataFrame([(0, 0, 0.0, 0.0, 0.0), (0, 1, 1.0, 2.0, 5.0)], "t int, p int, stage_z double, stage_y double, stage_x double")
    pairs = registration.overlap_pairs(tiles, 1.0, {"z": 4, "y": 9, "x": 12})
    a, b = stacks[0][1:, 2:, 5:], stacks[1][:3, :7, :7]
    got = {(r["z"], r["y"], r["x"]): (r["a"], r["b"]) for r in registration.overlap_patches(rows, pairs).collect()}
    assert got == {i: (int(a[i]), int(b[i])) for i in np.ndindex(a.shape) if a[i] or b[i]}
    small = registration.reduced_patches(rows, pairs, (3, 5, 9)).collect()
    assert {(r["f_z"], r["f_y"], r["f_x"]) for r in small} == {(3, 5, 7)}
    means = {(r["z"], r["y"], r["x"]): (r["a"], r["b"]) for r in small}
    for k, at in ((0, np.s_[:, :5]), (1, np.s_[:, 5:])):
        assert means[0, k, 0] == pytest.approx((a[at].sum() / 105, b[at].sum() / 105))


@pytest.mark.parametrize("dy,dx", [(1.25, -2.5), (-0.5, 0.0), (2.0, 3.75)])
def test_shifts_of_sparse_planes(spark, dy, dx):
    stack = np.random.default_rng(6).integers(1, 900, (2, 11, 13)) * (np.random.default_rng(7).random((2, 11, 13)) < 0.5)
    rows = frame(spark, stack).where("v <> 0")
    want = np.stack([registration.linear_shift(plane.astype(float), np.array([dy, dx])) for plane in stack])
    for block in (None, {"y": 4, "x": 5}):
        found = stencil.shift_linear(rows, dy, dx, 11, 13, block)
        assert image(found, stack.shape) == pytest.approx(want) and found.count() < stack.size
