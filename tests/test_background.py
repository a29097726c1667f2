"""The rolling ball at large radii and the fitted illumination, against brute force and planted fields."""

import numpy as np
import pytest

from voxelspark.operators import illumination, stencil

from .test_images import frame, image


def plain(stack, radius):
    wide = np.pad(stack.astype(float), [(0, 0), (radius, radius), (radius, radius)], constant_values=np.inf)
    rows, columns = stack.shape[1:]
    return np.min([wide[:, radius + dy : radius + dy + rows, radius + dx : radius + dx + columns] + h for dy, dx, h in stencil.ball(radius)], 0)


@pytest.mark.parametrize("radius", [1, 2, 3, 7, 25, 100])
def test_squares_of_the_ball_give_what_all_places_give(radius):
    random = np.random.default_rng(radius)
    y, x = np.indices((45, 60))
    images = [random.integers(0, 4000, (45, 60)), random.integers(100, 104, (45, 60)), np.full((45, 60), 7), 3 * y + 2 * x, np.where(random.random((45, 60)) < 0.01, 0, 5000)]
    for stack in images:
        wide = np.pad(stack.astype(float), radius, constant_values=np.inf)
        assert (stencil.under_ball(wide, radius) == plain(stack[None], radius)[0]).all()


def test_rolling_ball_of_radius_25_over_blocks(spark):
    stack = np.random.default_rng(5).integers(90, 300, (2, 40, 33))
    got = image(stencil.rolling_ball(frame(spark, stack), 25, 40, 33, {"y": 16, "x": 12}), stack.shape)
    assert got == pytest.approx(plain(stack, 25), abs=1e-9)


def shaded(n, h, w, seed):
    random = np.random.default_rng(seed)
    y, x = np.linspace(-1, 1, h)[:, None], np.linspace(-1, 1, w)
    field = 1.2 - 0.4 * (y - 0.2) ** 2 - 0.25 * x**2 + 0.1 * x * y
    field /= field.mean()
    images = random.uniform(400, 900, n)[:, None, None] * field
    bright = random.random((n, h, w)) < 0.04
    return field, images + bright * random.uniform(200, 3000, (n, h, w)) + random.normal(0, 3, (n, h, w))


def test_a_planted_field_is_found_below_bright_spots():
    field, images = shaded(50, 40, 56, 1)
    terms = illumination.fit(images)
    found = illumination.cosines(40, 40) @ terms @ illumination.cosines(56, 56).T
    assert np.abs(found / found.mean() / field - 1).max() < 0.01
    assert np.abs(images.mean(0) / images.mean() / field - 1).max() > 0.05  # a mean is not enough


def test_images_without_light_or_shading_have_the_field_1():
    one = illumination.fit(np.zeros((3, 4, 5)))
    assert illumination.cosines(4, 4) @ one @ illumination.cosines(5, 5).T == pytest.approx(np.ones((4, 5)))
    even = illumination.fit(np.full((1, 4, 5), 9.0))
    assert illumination.cosines(4, 4) @ even @ illumination.cosines(5, 5).T == pytest.approx(np.ones((4, 5)))


def test_fitted_flat_field_of_a_stack(spark):
    field, images = shaded(50, 30, 41, 2)
    rows = frame(spark, np.round(images[:25] / 0.24).astype(int)).unionByName(frame(spark, np.round(images[25:] / 0.24).astype(int), 1))
    got = flat(illumination.fitted_flat_field(rows, 0.0, 0.24, (25, 30, 41), 2), 30, 41)
    assert got.mean() == pytest.approx(1) and np.abs(got / field - 1).max() < 0.015


def test_fitted_flat_field_from_cells(spark):
    """Cells of 2 x 3 pixels, the last ones partial: a field whose slope ends at the borders is kept."""
    y, x = (np.arange(31) + 0.5) / 31, (np.arange(41) + 0.5) / 41
    field = 1 + 0.25 * np.cos(np.pi * y)[:, None] - 0.1 * np.cos(2 * np.pi * x)
    images = np.random.default_rng(4).uniform(4000, 9000, 6)[:, None, None] * field / field.mean()
    got = flat(illumination.fitted_flat_field(frame(spark, np.round(images).astype(int)), 0.0, 1.0, (6, 31, 41), 1, cells=16), 31, 41)
    assert np.abs(got / (field / field.mean()) - 1).max() < 0.02


def flat(df, height, width):
    return df.toPandas().sort_values(["y", "x"]).ff.to_numpy().reshape(height, width)


def test_fitted_flat_field_of_an_empty_table(spark):
    none = frame(spark, np.ones((2, 3, 4), int)).where("p = 9")
    assert illumination.fitted_flat_field(none, 0.0, 1.0, (2, 3, 4), 1).count() == 0
