"""Block detection and plume numerics against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators import detect, plume
from emberline.schema import BLOCK, Thresholds


def plain_labels(mask, diagonal):
    labels, n = np.zeros(mask.shape, int), 0
    for y, x in zip(*np.nonzero(mask)):
        if labels[y, x]:
            continue
        n += 1
        stack = [(y, x)]
        labels[y, x] = n
        while stack:
            a, b = stack.pop()
            for da in (-1, 0, 1):
                for db in (-1, 0, 1):
                    if (da or db) and (diagonal or not (da and db)):
                        p, q = a + da, b + db
                        if 0 <= p < mask.shape[0] and 0 <= q < mask.shape[1] and mask[p, q] and not labels[p, q]:
                            labels[p, q] = n
                            stack.append((p, q))
    return labels


@pytest.mark.parametrize("diagonal", [False, True])
def test_components(diagonal):
    rng = np.random.default_rng(5)
    for share in (0.0, 0.2, 0.5, 0.7, 1.0):
        mask = rng.random((17, 23)) < share
        assert (detect.components(mask, diagonal) == plain_labels(mask, diagonal)).all()


def block(spark, b12, b11=None, scl=None, size=24, offset=0, br=0):
    b11 = b12 if b11 is None else b11
    row = (br, 0, "2024-01-01", "39RWN", "s", 32639, 500000.0, 2800000.0, 20.0, 20.0, 0, offset, size, size, 60.0, 100.0, -1000.0, 10000.0, b12.ravel().tolist(), b11.ravel().tolist(), [1000] * size * size, scl)
    return spark.createDataFrame([row], BLOCK)


def test_one_flare(spark):
    b12 = np.full((24, 24), 2000)
    b12[10, 10], b12[10, 11], b12[11, 10] = 9000, 7000, 6000
    r = detect.detect_blocks(block(spark, b12)).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.peak_img_row, r.peak_img_col, r.pixels, r.saturated) == (10, 10, 2, 0)
    assert r.max_b12 == pytest.approx(0.8) and r.avg_b12 == pytest.approx(1.9 / 3)
    assert r.glint_angle == 30 and r.glint_score == pytest.approx(35 / 40)
    assert detect.detect_blocks(block(spark, b12, scl=[9] * 576)).count() == 0
    assert detect.detect_blocks(block(spark, np.full((24, 24), 2000))).count() == 0
    assert detect.detect_blocks(block(spark, b12, br=1)).count() == 0, "its peak lies in another block"


def test_size_gates():
    t, shape = Thresholds(), (40, 40)

    def found(n, value):
        b12 = np.full(shape, 2000)
        b12.ravel()[: 40 * 10][np.arange(n)] = value
        b12[0, 0] = value + 3000
        return detect.flares(b12, b12, np.full(shape, 1000), shape, -1000.0, 10000.0, t)

    assert len(found(20, 6000)) == 1 and len(found(85, 6000)) == 0
    assert len(found(35, 6000)) == 1 and len(found(35, 5500 - 2000)) == 0


def test_shift():
    rng = np.random.default_rng(3)
    image = rng.random((40, 40))
    for _ in range(3):
        image = (image + np.roll(image, 1, 0) + np.roll(image, 1, 1)) / 3
    moved = np.roll(np.roll(image, -2, 1), 1, 0)
    tx, ty = plume.shift_between(image[4:36, 4:36], moved[4:36, 4:36])
    assert abs(tx - 2) < 0.3 and abs(ty + 1) < 0.3
    still = np.stack([image] * 4)
    ok = np.ones(image.shape, bool)
    assert plume.distance(still, ok, still, ok) == pytest.approx(0, abs=1e-6)
    assert plume.shift_between(np.zeros((20, 20)), np.zeros((20, 20))) == (0.0, 0.0)


def plain_scores(fixed, moving):
    """Correlations window by window."""
    height, width = fixed.shape
    crop = min(height, width, int(np.floor(min(height, width) * plume.CENTRAL + 0.5)))
    ys, xs = ([n // 2 for n in (height - crop, width - crop)])
    out = np.full((11, 11), -np.inf)
    for dy in range(-5, 6):
        for dx in range(-5, 6):
            at = [(y, x) for y in range(ys, height - ys) for x in range(xs, width - xs) if 0 <= y - dy < height and 0 <= x - dx < width]
            a, b = np.array([fixed[p] for p in at]), np.array([moving[y - dy, x - dx] for y, x in at])
            if len(at) > 1 and np.ptp(a) > 0 and np.ptp(b) > 0:
                out[dy + 5, dx + 5] = np.corrcoef(a, b)[0, 1]
    return out


@pytest.mark.parametrize("shape", [(24, 24), (8, 8), (12, 31), (31, 12), (5, 5), (3, 7), (2, 2), (1, 1)])
def test_shift_scores_by_windows(shape):
    """One transform gives each shift's correlation, also in images smaller than the largest shift, with large values and flat parts."""
    rng = np.random.default_rng(shape[0])
    for fixed in (rng.random(shape), rng.random(shape) * 50 + 9000, np.where(np.arange(shape[1]) < 3, 7.0, rng.random(shape))):
        moving = rng.random(shape)
        want, got = plain_scores(fixed, moving), plume.shift_scores(fixed, moving)
        assert (np.isfinite(want) == np.isfinite(got)).all()
        assert got[np.isfinite(got)] == pytest.approx(want[np.isfinite(want)], abs=1e-7)


def test_shift_of_odd_images():
    image = np.arange(400.0).reshape(20, 20)
    for odd in (np.full((20, 20), 3.7), np.where(image == 5, np.nan, image)):
        assert plume.shift_between(odd, image) == plume.shift_between(image, odd) == (0.0, 0.0)
    assert plume.shift_between(np.zeros((0, 0)), np.zeros((0, 0))) == (0.0, 0.0)


def test_network_input():
    target = np.arange(24, dtype=float).reshape(6, 2, 2) + 1
    valid = np.array([[True, True], [False, True]])
    x = plume.network_input(target, target, valid, (8.0, -4.0))
    assert x.shape == (16, 2, 2) and (x[13] == 1).all() and (x[14] == -0.5).all() and x[15].ravel().tolist() == [0, 0, 1, 0] and (x[0] == 1).all()


def test_spline_reproduces_cubics():
    x = np.array([0.0, 1, 2.5, 3, 5, 8])
    f = lambda v: 2 * v**3 - v**2 + 4 * v - 7
    at = np.array([-0.5, 0.3, 2.7, 4.9, 8.4])
    assert plume.cubic(x, f(x), at) == pytest.approx(f(at)) and plume.cubic(x[::-1], f(x[::-1]), at) == pytest.approx(f(at))
    with pytest.raises(ValueError):
        plume.cubic(x[:3], x[:3], 1.0)


def table():
    amf, columns = [2.0, 2.2, 2.5, 3.0, 4.0], [1300.0, 1800.0, 2500.0, 4000.0, 8000.0]
    trans = lambda k: [[float(np.exp(-k * a * c / 1e4)) for c in columns] for a in amf]
    one = {"transmittance_b12": trans(0.5), "transmittance_b11": trans(0.1), "transmittance_b12_bg": [float(np.exp(-0.5 * a * 0.18)) for a in amf], "transmittance_b11_bg": [float(np.exp(-0.1 * a * 0.18)) for a in amf]}
    return {"amf_arr": amf, "mr_ch4_arr": [columns] * 5, "background_concentration": 1800.0, "S2B": one}


def plain_retrieval(target, background, valid, plume_cells, geometry, table):
    """Ratios and methane of a scene in numpy alone."""

    def ratios(image, keep):
        with np.errstate(all="ignore"):
            r = image[5] / image[4]
        ok = (image[4] != 0) & np.isfinite(r)
        r = np.where(ok, np.clip(r, 0, 10), 0.0)
        return r / (r[keep & ok].mean() if (keep & ok).any() else 1.0)

    off = valid.copy()
    off[plume_cells] = False
    a, b = ratios(target, off), ratios(background, np.ones(len(valid), bool))
    ratio = np.where((a != 0) & (b != 0), np.clip(np.divide(a, b, out=np.ones_like(a), where=b != 0), 0, 10), 1.0)
    base, *_ = plume.methane_curve(*geometry, table)
    amf = min(sum(1 / np.cos(np.radians(v)) for v in geometry[1:]), table["amf_arr"][-1])
    own = table[geometry[0]]
    trans = [plume.cubic(table["amf_arr"], np.array(own["transmittance_b12"])[:, k], amf) / plume.cubic(table["amf_arr"], np.array(own["transmittance_b11"])[:, k], amf) for k in range(5)]
    got = plume.cubic(trans, table["mr_ch4_arr"][0], np.clip(ratio, 0.3, 1.08) * base) - table["background_concentration"]
    return np.where(ratio == 1.0, 0.0, got)[plume_cells]


def test_retrievals_by_hand(spark):
    """Expressions and numpy agree to 1e-9: zeros, infinities, invalid pixels, several plumes, none, everything plume, unknown angles."""
    rng = np.random.default_rng(7)
    rows, want = [], {}
    for i in range(9):
        n = 40
        target, background = rng.random((6, n)) * 100 + 900, rng.random((6, n)) * 100 + 900
        target[4, :4], background[4, 2:5], target[5, 6] = 0.0, 0.0, np.inf
        target[5, 8:10] = 0.0
        valid = rng.random(n) < 0.7
        parts = [(0, list(range(3, 12))), (1, [20, 22, 39])] if i < 6 else [(0, list(range(n)))] if i == 6 else []
        geometry = ("S2B", 10.0 + 9 * (i % 4), float(i % 3)) if i != 5 else ("S2B", None, 1.0)
        rows.append((i, target.ravel().tolist(), background.ravel().tolist(), valid.tolist(), *geometry, parts))
        for k, cells in parts:
            want[i, k] = None if i == 5 else plain_retrieval(target, background, valid, [c for c in cells], geometry, table()) if len(parts) == 1 else (target, background, valid, parts, geometry)
    for (i, k), v in list(want.items()):
        if isinstance(v, tuple):
            target, background, valid, parts, geometry = v
            every = [c for _, cells in parts for c in cells]
            want[i, k] = np.array([x for c, x in zip(every, plain_retrieval(target, background, valid, every, geometry, table())) if c in parts[k][1]])
    schema = "id long, target array<double>, aligned array<double>, valid array<boolean>, satellite string, sun_zenith double, view_zenith double, parts array<struct<component:int,cells:array<int>>>"
    frame = spark.createDataFrame(rows, schema).withColumn("base", F.lit(1)).withColumn("ppb", F.lit("clash"))
    got = {(r.id, r.component): r.ppb for r in plume.retrievals(frame, table()).collect()}
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert (got[key] is None) == (values is None)
        assert values is None or got[key] == pytest.approx(values, rel=1e-9, abs=1e-6)
    assert plume.retrievals(frame.where("false"), table()).count() == 0


def test_enhancement(spark):
    """Methane of a known column comes back; ratios of 1, none and such that aren't numbers give 0."""
    amf = 1 / np.cos(np.radians(35.2)) + 1 / np.cos(np.radians(4.7))
    more = 1500.0
    ratios = [float(np.exp(-0.4 * amf * more / 1e4)), 1.0, float("nan"), float("inf"), None]
    curve = plume.methane_curves(spark.createDataFrame([("S2B", 35.2, 4.7), ("S2B", float("nan"), 1.0), (None, 1.0, 1.0)], "satellite string, sun_zenith double, view_zenith double"), table())
    one = curve.crossJoin(spark.createDataFrame([(i, r) for i, r in enumerate(ratios)], "i int, r double"))
    got = [r.e for r in one.select("i", plume.enhancement(F.col("r"), F.col("base"), F.col("starts"), F.col("factors"), table()).alias("e")).orderBy("i").collect()]
    assert got[0] == pytest.approx(more, rel=0.03) and got[1:] == [0, 0, 0, 0]
    with pytest.raises(ValueError):
        plume.methane_curve("S9", 1, 1, table())


def test_flux_golden(spark):
    ppb = [521963.06, 224366.35, 70150.52, 10095.28, -2552.10, -3406.45]
    df = spark.createDataFrame([(ppb,)], "p array<double>").select(plume.flux(plume.summed_enhancement(F.col("p")), F.size("p"), F.lit(3.2)).alias("q"))
    q = df.first().q
    assert q.rate == pytest.approx(35381.29, abs=0.01) and q.sigma == pytest.approx(12406.8, rel=0.01)
    none = df.select(plume.flux(F.lit(0.0), F.lit(0), F.lit(3.2)).alias("q")).first().q
    assert (none.rate, none.sigma) == (0, 0)


@pytest.mark.parametrize("least", [1, 2, 5, 30])
def test_levels_by_labelling(least):
    """The max-tree's level answers each cutoff as labels of the cells above it do; also among ties and in narrow rasters."""
    rng = np.random.default_rng(least)
    for shape in ((9, 11), (1, 30), (30, 1), (1, 1)):
        for values in (rng.random(shape), rng.integers(0, 4, shape) / 4, np.zeros(shape)):
            level = plume.level_of(values, least)
            for cutoff in (*np.unique(values), -1.0, 0.37, 2.0):
                largest = np.bincount(plain_labels(values > cutoff, True).ravel())[1:].max(initial=0)
                assert (level is not None and cutoff < level) == (largest >= least)


def test_table_function(spark):
    """detect_block in SQL finds what the operator finds, with thresholds by name; rows without pixels give none."""
    from emberline.functions import tables

    tables.register(spark)
    b12 = np.full((24, 24), 2000)
    b12[10, 10], b12[10, 11], b12[11, 10] = 9000, 7000, 6000
    one = block(spark, b12)
    call = "SELECT f.* FROM {b} AS b, LATERAL detect_block(b12, b11, b8a, scl, width, height, radiometric_offset, quantification%s) AS f"
    r = spark.sql(call % "", b=one).collect()
    assert len(r) == 1 and (r[0].row, r[0].col, r[0].pixels) == (10, 10, 2) and r[0].max_b12 == pytest.approx(0.8)
    assert spark.sql(call % ", map('peak_b12_min', 0.85D)", b=one).count() == 0
    for odd in ({"scl": F.array_repeat(F.lit(9), 576)}, {"width": F.lit(0)}, {"b12": F.lit(None).cast("array<int>")}):
        assert spark.sql(call % "", b=one.withColumns(odd)).count() == 0
    with pytest.raises(Exception, match="unknown thresholds"):
        spark.sql(call % ", map('nothing', 1D)", b=one).collect()


def test_plume_pipeline(spark):
    n = 32
    rng = np.random.default_rng(1)
    base = rng.random((6, n, n)) * 100 + 1000
    prob = np.zeros((n, n))
    prob[5:16, 5:16], prob[20:30, 20:30] = 0.9, 0.8
    rows = [(i, n, n, base.ravel().tolist(), None if i == 2 else base.ravel().tolist(), [True] * n * n, [3.0, 4.0], "S2B", 35.2, 4.7, 10.0 if i == 1 else 90.0, prob.ravel().tolist()) for i in range(3)]
    schema = "id long, width int, height int, target array<double>, background array<double>, valid array<boolean>, wind array<double>, satellite string, sun_zenith double, view_zenith double, clear_percent double, prob array<double>"
    got = {r.id: r for r in plume.detect_plumes(spark.createDataFrame(rows, schema), table()).collect()}
    assert [got[i].status for i in range(3)] == ["ok", "cloudy", "no_background"] and got[1].plumes is None
    assert [p.pixels for p in got[0].plumes] == [121] and got[0].plumes[0].row == pytest.approx(10) and got[0].plumes[0].max_probability == pytest.approx(0.9)
    scored = plume.scene_scores(spark.createDataFrame([(0, 10, 10, [0.73] * 20 + [0.0] * 80)], "id long, width int, height int, prob array<double>"), 20).first()
    assert abs(scored.score - 0.73) < 0.002
    netted = plume.detect_plumes(spark.createDataFrame(rows[:1], schema), table(), network=lambda x: np.where(x[0] > -1, 0.6, 0.0)).first()
    assert [p.pixels for p in netted.plumes] == [n * n]


def test_aligned_keeps_columns(spark):
    """Aligned pairs keep their columns without a join by id: two rows of one id keep each their own; more rows than are taken at a time."""
    rng = np.random.default_rng(3)
    rows = [(i // 2, i, 6, 6, (rng.random(6 * 36) * 100).tolist(), (rng.random(6 * 36) * 100).tolist()) for i in range(plume.TOGETHER * 2 + 3)]
    pairs = spark.createDataFrame(rows, "id long, own int, width int, height int, target array<double>, background array<double>").coalesce(1)
    got = {r.own: r for r in plume.aligned(pairs, (2, 1, 0), keep=True).collect()}
    assert len(got) == len(rows)
    for i, own, _, _, target, background in rows:
        moved, (tx, ty) = plume.align(np.reshape(target, (6, 6, 6)), np.reshape(background, (6, 6, 6)), (2, 1, 0))
        assert (got[own].id, got[own].target, got[own].tx, got[own].ty) == (i, target, tx, ty) and np.allclose(got[own].aligned, moved.ravel())
