"""Block columns against the same operators on voxels and against plain loops."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_images import STACK, brute_deskew, frame, image
from voxelspark.operators import arrays, deconvolve, deskew, fusion, reduce
from voxelspark.plans import commands
from voxelspark.sources import zarr


def scene(shape, seed=3, density=1.0):
    rng = np.random.default_rng(seed)
    return rng.integers(100, 3000, shape) * (rng.random(shape) < density)


def blocks_of(spark, stack, p=0, edges=(1, 1, 1, 2, 4, 3)):
    return arrays.of_voxels(frame(spark, stack, p), edges)


def cube(blocks, shape):
    out = np.zeros(shape)
    for r in blocks.collect():
        o = r["origin"][3:]
        a = np.frombuffer(r["data"], r["dtype"]).reshape(r["shape"])[0, 0, 0]
        out[tuple(slice(x, x + n) for x, n in zip(o, a.shape))] = a
    return out


def test_blocks_come_back_as_voxels(spark):
    stack = scene((5, 9, 7), density=0.3)
    assert (image(arrays.voxels(blocks_of(spark, stack), (1, 1, 1, 5, 9, 7)), stack.shape) == stack).all()


def test_halo_pieces_meet(spark):
    stack = scene((5, 9, 7))
    meets = [*(arrays.grid(1, 1) for _ in range(3)), arrays.grid(2, 5, 1, 1), arrays.grid(4, 9, 2, 2), arrays.grid(7, 7)]
    seen = {}

    def kernel(at, pieces):
        lo = [max(0, 2 * at[3] - 1), max(0, 4 * at[4] - 2)]
        hi = [min(5, 2 * at[3] + 3), min(9, 4 * at[4] + 6)]
        whole = arrays.assemble(pieces, (0, 0, 0, *lo, 0), (1, 1, 1, *hi, 7))
        yield (0, 0, 0, *lo, 0), whole

    for r in arrays.regroup(blocks_of(spark, stack), meets, kernel).collect():
        z, y = r["origin"][3:5]
        a = np.frombuffer(r["data"], r["dtype"]).reshape(r["shape"])[0, 0, 0]
        assert (a == stack[z : z + a.shape[0], y : y + a.shape[1]]).all()
        seen[(z, y)] = a.shape
    assert len(seen) == 9 and seen[(1, 2)] == (4, 7, 7)


@pytest.mark.parametrize("across,wide,reverse", [(512, 128, False), (3, 2, True)])
def test_deskew_of_blocks(spark, across, wide, reverse):
    g = deskew.Geometry(5, 9, 6)
    want = brute_deskew(STACK, g)
    got = cube(arrays.deskew(blocks_of(spark, STACK), (1, 1, 1, 5, 9, 6), g, reverse, across, wide), want.shape)
    assert (got == (want[::-1] if reverse else want)).all() and got.any()


def test_projection_pyramid_and_crop_of_blocks(spark):
    stack = scene((5, 9, 7), density=0.5)
    blocks, shape = blocks_of(spark, stack), (1, 1, 1, 5, 9, 7)
    assert (cube(arrays.project(blocks, shape, "z", (4, 4)), (1, 9, 7))[0] == stack.max(0)).all()
    assert (cube(arrays.stride(blocks, {"z": 2, "y": 3, "x": 2}), (3, 3, 4)) == stack[::2, ::3, ::2]).all()
    wide = np.pad(stack, [(0, 1), (0, 0), (0, 1)])
    mean = np.floor(wide.reshape(3, 2, 3, 3, 4, 2).mean((1, 3, 5)))
    assert (cube(arrays.block_mean(blocks, shape, {"z": 2, "y": 3, "x": 2}, (1, 1, 1, 1, 2, 3)), mean.shape) == mean).all()
    assert (cube(arrays.flip(arrays.crop(blocks, "y", 2, 8), "y", 6), (5, 6, 7)) == stack[:, 2:8][:, ::-1]).all()


def test_store_round_trip_of_blocks(spark, tmp_path):
    stack = scene((5, 9, 7), density=0.4)
    for n, m in enumerate((zarr.sharded((1, 1, 1, 5, 9, 7), (1, 1, 1, 4, 8, 7), (1, 1, 1, 2, 4, 7), "uint16"), zarr.Layout((1, 1, 1, 5, 9, 7), (1, 1, 1, 2, 4, 5), "<u2", "zstd", 0))):
        path = f"{tmp_path}/{n}.zarr"
        arrays.write(blocks_of(spark, stack), path, m)
        found, shape = arrays.read(spark, path, where={"y": (1, 8)})
        want = stack.copy()
        want[:, [0, 8]] = 0
        assert shape == (1, 1, 1, 5, 9, 7) and (cube(found, stack.shape) == want).all()
        assert (image(zarr.read(spark, path), stack.shape) == stack).all()


def brute_fuse(stacks, offsets, blend, size):
    profiles = [np.array(fusion.feather_profile(n, b)) for n, b in zip(stacks[0].shape, blend)]
    w = profiles[0][:, None, None] * profiles[1][None, :, None] * profiles[2]
    value, weight = np.zeros(size), np.zeros(size)
    for s, o in zip(stacks, offsets):
        here = tuple(slice(a, a + n) for a, n in zip(o, s.shape))
        value[here] += s * w
        weight[here] += w
    return np.floor(np.divide(value, weight, out=np.zeros(size), where=weight > 0) + 1e-9)


def test_fusion_by_shards_with_sizes_by_axis(spark):
    """Tiles apart in z, y and x whose voxels are not cubes; sparse tiles weigh where they have no voxel."""
    stacks = [scene((6, 9, 7), s, 0.4 if s else 1.0) for s in range(4)]
    voxel = {"z": 0.25, "y": 0.125, "x": 0.5}
    offsets = [(0, 0, 0), (3, 2, 1), (0, 5, 4), (4, 0, 5)]
    rows = [(0, p, 2 + o[0] * 0.25, 1 + o[1] * 0.125, 5 + o[2] * 0.5) for p, o in enumerate(offsets)]
    tiles = spark.createDataFrame(rows, "t int, p int, stage_z double, stage_y double, stage_x double")
    both = frame(spark, stacks[0], 0)
    for p in (1, 2, 3):
        both = both.unionByName(frame(spark, stacks[p], p).where("v <> 0"))
    want = brute_fuse(stacks, offsets, (2, 3, 2), (10, 14, 12))
    size = fusion.extent(tiles, voxel, dict(zip("zyx", (6, 9, 7))), {"z": 1, "y": 1, "x": 1}, up=True).first()
    assert [size[f"size_{a}"] for a in "zyx"] == [10, 14, 12]
    assert (image(fusion.fuse_3d(both, tiles, voxel, (6, 9, 7), (2, 3, 2)), want.shape) == want).all()
    profiles = [np.array(fusion.feather_profile(n, b)) for n, b in zip((6, 9, 7), (2, 3, 2))]
    small = arrays.fused_blocks(arrays.of_voxels(both, (1, 1, 1, 4, 3, 5)), tiles, voxel, (6, 9, 7), profiles, edges=(3, 4, 5))
    assert (cube(small, (12, 16, 15))[:10, :14, :12] == want).all()


def test_folded_fusion_of_blocks(spark):
    planes = [scene((1, 9, 7), s) for s in range(3)]
    rows = [(0, p, 0.0, float(p * 4), float(p * 3)) for p in range(3)]
    tiles = spark.createDataFrame(rows, "t int, p int, stage_z double, stage_y double, stage_x double")
    both = frame(spark, planes[0]).unionByName(frame(spark, planes[1], 1)).unionByName(frame(spark, planes[2], 2))
    want = fusion.fuse_2d(deskew.lines(both, 7).drop("z"), tiles, 1.0, 9, 7).withColumn("z", F.lit(0))
    got = arrays.fused_blocks(arrays.of_voxels(both), tiles, 1.0, (1, 9, 7), [np.ones(1), np.array(fusion.cosine_mask(9)), np.array(fusion.cosine_mask(7))], "fold", False, (1, 5, 4))
    assert (cube(got, (1, 20, 16))[:, :17, :13] == image(want, (1, 17, 13))).all()


def plain_rlgc(image, psf, safe, start, seed=42):
    """The published loop, step by step, on an image that needs no padding."""
    rng, h = np.random.default_rng(seed), deconvolve.otf(psf, image.shape)
    blur = lambda x, k: np.fft.irfftn(np.fft.rfftn(x) * k, image.shape, range(3))

    def kl(p, q):
        p, q = (p + 1e-4) / (p + 1e-4).sum(), (q + 1e-4) / (q + 1e-4).sum()
        return (p * (np.log(p) - np.log(q))).sum()

    recon = previous = np.full(image.shape, start)
    k1 = k2 = np.inf
    for n in range(1000):
        one = rng.binomial(image, 0.5)
        two = image - one
        hu = np.maximum(blur(recon, h), 0)
        a, b = kl(hu, one), kl(hu, two)
        rise = (a > k1 or b > k2) if safe else (a > k1 and b > k2)
        if rise or a < 1e-4 or b < 1e-4:
            return previous, n, "revert"
        k1, k2, previous = a, b, recon
        r1, r2 = (blur(s / (0.5 * (hu + 1e-12)), h.conj()) for s in (one, two))
        consensus = blur((r1 - 1) * (r2 - 1), h * h.conj())
        recon = np.maximum(0, np.where(consensus < 0, recon, recon * (r1 + r2)))
        delta = ((recon - previous) / recon.max()).max()
        if (consensus >= 0).mean() < 0.1 or delta < 0.01 or delta < 5 / image.max():
            return recon, n, "stop"


@pytest.mark.parametrize("safe", [True, False])
def test_deconvolution_against_the_loop(safe):
    psf = deconvolve.gaussian_psf(0.5, 1.35, 1.4, (0.2, 0.115, 0.115), (5, 5, 5))
    ends = set()
    for seed in range(4):
        truth = np.zeros((8, 16, 12))
        rng = np.random.default_rng(seed)
        for z, y, x in zip(*(rng.integers(1, n - 1, 6) for n in truth.shape)):
            truth[z, y, x] = rng.integers(200, 9000)
        blurred = np.fft.irfftn(np.fft.rfftn(truth) * deconvolve.otf(psf, truth.shape), truth.shape, range(3))
        image_ = rng.poisson(np.maximum(blurred, 0) + (2 if seed % 2 else 30))
        want, n, end = plain_rlgc(image_, psf, safe, float(np.median(image_)) + 1)
        got = deconvolve.rlgc(image_, psf, safe, start=float(np.median(image_)) + 1)
        assert n > 0 and np.allclose(got, want, rtol=1e-6, atol=1e-6)
        ends.add(end)
    assert "revert" in ends


@pytest.mark.parametrize("slab", [None, 4])
def test_deconvolution_of_blocks(spark, slab):
    stack = scene((10, 9, 8))
    psf = deconvolve.gaussian_psf(0.5, 1.35, 1.4, (0.2, 0.115, 0.115), (3, 3, 3))
    want = image(deconvolve.deconvolve(frame(spark, stack), psf, stack.shape, slab, 2), stack.shape)
    got = cube(arrays.deconvolve(blocks_of(spark, stack), (1, 1, 1, *stack.shape), {0: psf}, slab, 2), stack.shape)
    assert np.allclose(got, want)


def acquisition(spark, path, n_t=1, n_c=1, positions=((0.0, 0.0), (0.0, 0.46)), mode="mirror"):
    """Two time points or more, channels 488nm and 640nm, and tiles at (z, y) stage positions."""
    stacks, rows = {}, None
    for t in range(n_t):
        for p in range(len(positions)):
            for c in range(n_c):
                stacks[t, p, c] = scene((5, 9, 6), 100 * t + 10 * p + c)
                own = frame(spark, stacks[t, p, c], p).withColumns({"t": F.lit(t), "c": F.lit(c)})
                rows = own if rows is None else rows.unionByName(own)
    attributes = {"mode": mode, "image_mirror_step_um": 0.4, "scan_axis_step_um": 0.4, "excess_scan_positions": 1, "pixel_size_um": 0.115, "angle_deg": 30.0, "offset": 100.0, "e_to_ADU": 0.24}
    event = lambda p, c, z, y: {"mda_event": {"index": {"t": 0, "p": p}, "metadata": {"Stage": {"x_pos": 0.0, "y_pos": y, "z_pos": z}, "DAQ": {"current_channel": ["488nm", "640nm"][c]}}}}
    attributes["frame_metadatas"] = [event(p, c, *at) for p, at in enumerate(positions) for c in range(n_c)]
    zarr.write(rows, path, zarr.Layout((n_t, len(positions), n_c, 5, 9, 6), (1, 1, 1, 2, 9, 4), "<u2", "zstd", 0), attributes=attributes)
    return stacks


def corrected(stack, flat=1.0):
    return np.floor(np.clip((stack - 100.0) * 0.24 / flat, 0, 65535))


def test_fuse_of_tiles_apart_in_z(spark, tmp_path):
    """Planes are 0.23 um apart (factor 2 of 0.115), so 0.46 um in z are two planes and the whole has two more; the stage counts z downwards."""
    path = f"{tmp_path}/run.zarr"
    stacks = acquisition(spark, path, positions=((0.0, 0.0), (0.46, 0.0)))
    out = commands.process(spark, path, max_projection=False)
    g = deskew.Geometry(5, 9, 6)
    parts = [np.pad(brute_deskew(corrected(stacks[0, p, 0]), g), [(0, 0), (0, -g.out[1] % 4), (0, 2)]) for p in range(2)]
    n = parts[0].shape
    fused = commands.fuse(spark, path, register=False, factors=())
    assert fused.endswith("_fused.zarr") and out["deskewed"].endswith("_deskewed.zarr")
    size = zarr.layout(f"{fused}/scale0/image").shape[2:]
    assert size[0] == -(-(n[0] + 2) // n[0]) * n[0]
    want = brute_fuse(parts, [(2, 0, 0), (0, 0, 0)], (10, 600, 600), (n[0] + 2, *n[1:]))
    got = image(zarr.read(spark, f"{fused}/scale0/image", "tczyx"), size)
    assert (got[: n[0] + 2, : n[1], : n[2]] == want).all() and not got[n[0] + 2 :].any() and want.any()
    scales = json.loads((tmp_path / fused.split("/")[-1] / "zarr.json").read_text())["attributes"]["ome"]["multiscales"][0]["datasets"][0]["coordinateTransformations"]
    assert [0.23, 0.115, 0.115] == pytest.approx(next(s["scale"] for s in scales if s["type"] == "scale")[-3:])


def test_ranges_are_counted_from_zero(spark, tmp_path):
    path = f"{tmp_path}/run.zarr"
    stacks = acquisition(spark, path, n_t=3, positions=((0.0, 0.0), (0.0, 0.46), (0.0, 0.92)))
    out = commands.process(spark, path, times=(1, 3), positions=(2, 3), max_projection=False)
    shape = zarr.layout(out["deskewed"]).shape
    assert shape[:3] == (2, 1, 1)
    want = brute_deskew(corrected(stacks[2, 2, 0]), deskew.Geometry(5, 9, 6))
    assert (image(zarr.read(spark, out["deskewed"]).where("t = 1"), want.shape) == want).all()
    tiles = commands.stored_tiles(spark, out["deskewed"]).collect()
    assert {(r["t"], r["p"]) for r in tiles} == {(0, 0), (1, 0)} and {abs(r["stage_x"]) for r in tiles} == {0.92}


def test_flat_field_is_estimated_kept_and_used(spark, tmp_path):
    path = f"{tmp_path}/run.zarr"
    stacks = acquisition(spark, path, n_c=2)
    out = commands.process(spark, path, flat_field=True, max_projection=False)
    kept = spark.read.parquet(f"{tmp_path}/run_flatfield.parquet")
    flat = commands.flat_array(kept, 2, 9, 6)
    assert kept.count() == 2 * 9 * 6 and flat.std() > 0 and flat[0].mean() == pytest.approx(1)
    want = brute_deskew(corrected(stacks[0, 1, 1], flat[1]), deskew.Geometry(5, 9, 6))
    assert (image(zarr.read(spark, out["deskewed"]).where("p = 1 and c = 1"), want.shape) == want).all()
    other = kept.withColumn("ff", F.lit(2.0))
    other.write.mode("overwrite").parquet(f"{tmp_path}/other.parquet")
    given = commands.process(spark, path, flat=spark.read.parquet(f"{tmp_path}/other.parquet"), max_projection=False)
    want = brute_deskew(corrected(stacks[0, 0, 0], 2.0), deskew.Geometry(5, 9, 6))
    assert (image(zarr.read(spark, given["deskewed"]).where("p = 0 and c = 0"), want.shape) == want).all()


def test_each_channel_has_its_psf(spark, tmp_path, monkeypatch):
    path, seen = f"{tmp_path}/run.zarr", []
    acquisition(spark, path, n_c=2)
    made = deconvolve.skewed_psf
    monkeypatch.setattr(deconvolve, "skewed_psf", lambda wavelength, *a: seen.append(wavelength) or made(wavelength, *a))
    real = arrays.deconvolve
    monkeypatch.setattr(arrays, "deconvolve", lambda blocks, shape, psfs, **k: seen.append({c: float((p**2).sum()) for c, p in psfs.items()}) or real(blocks, shape, psfs, **k))
    out = commands.process(spark, path, deconvolve=True, max_projection=False)
    assert seen[:2] == [0.488, 0.64] and seen[2][0] > seen[2][1]
    assert zarr.read(spark, out["deskewed"]).groupBy("c").agg(F.sum("v").alias("s")).where("s > 0").count() == 2


def test_no_voxel_rows_between_stores(spark, tmp_path, monkeypatch):
    """``process`` and ``fuse`` never make rows of voxels."""
    path = f"{tmp_path}/run.zarr"
    acquisition(spark, path)

    def refuse(*_):
        raise AssertionError("voxel rows")

    monkeypatch.setattr(zarr, "voxels", refuse)
    out = commands.process(spark, path, deconvolve=True)
    commands.fuse(spark, out["projection"], register=False)
    commands.fuse(spark, out["deskewed"], factors=(2,))


def test_modes_of_levels(spark, tmp_path):
    stack = scene((4, 9, 7))
    for mode in ("stride", "block_mean"):
        arrays.write_levels(blocks_of(spark, stack), f"{tmp_path}/{mode}", (1, 1, 4, 9, 7), {}, [2, 4], mode, level_of=lambda s: zarr.sharded(s, (1, 1, 2, 4, 4), (1, 1, 1, 2, 2), "uint16"))
        got = image(zarr.read(spark, f"{tmp_path}/{mode}/scale2/image", "tczyx"), (1, 3, 2))
        voxels = frame(spark, stack)
        sizes = dict.fromkeys("zyx", 2)
        for _ in range(2):
            voxels = reduce.stride(voxels, sizes) if mode == "stride" else reduce.block_reduce(voxels, sizes, truncate=True)
        assert (got == image(voxels, got.shape)).all() and math.prod(got.shape) == 6
