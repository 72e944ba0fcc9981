"""Operators on small inputs with known results, and kernels against brute force."""

import itertools
import zipfile

import numpy as np
import pandas as pd
import pytest

from stackrill.functions import scalar as fs
from stackrill.operators import crop, detect, pixels, planes, relational, tracks
from stackrill.operators import kernels as k
from stackrill.plans import models, pipelines
from stackrill.sources import bundle, files, tiff


def flood(mask, diagonal=False):
    out, n = np.zeros(mask.shape, int), 0
    for y, x in np.argwhere(mask):
        if out[y, x]:
            continue
        n += 1
        todo = [(y, x)]
        out[y, x] = n
        while todo:
            a, b = todo.pop()
            for dy, dx in itertools.product((-1, 0, 1), repeat=2):
                if (dy or dx) and (diagonal or not (dy and dx)):
                    p, q = a + dy, b + dx
                    if 0 <= p < mask.shape[0] and 0 <= q < mask.shape[1] and mask[p, q] and not out[p, q]:
                        out[p, q] = n
                        todo.append((p, q))
    return out, n


@pytest.mark.parametrize("diagonal", [False, True])
def test_label_is_flood_fill(diagonal):
    rng = np.random.default_rng(1)
    for density in (0.2, 0.5, 0.6, 0.8):
        mask = rng.random((23, 31)) < density
        got, n = k.label(mask, diagonal)
        want, m = flood(mask, diagonal)
        assert n == m and (got == want).all()
    assert k.label(np.zeros((4, 4)))[1] == 0


def test_assign_is_optimal():
    rng = np.random.default_rng(2)
    for n, m in ((1, 1), (3, 3), (4, 6), (6, 4), (5, 5)):
        for _ in range(10):
            c = rng.integers(0, 20, (n, m)).astype(float)
            pairs = tracks.assign(c)
            assert len(pairs) == min(n, m) == len({i for i, _ in pairs}) == len({j for _, j in pairs})
            small, big = (c, range(m)) if n <= m else (c.T, range(n))
            best = min(sum(small[i, j] for i, j in enumerate(p)) for p in itertools.permutations(big, min(n, m)))
            assert sum(c[i, j] for i, j in pairs) == best
    assert tracks.assign(np.zeros((0, 3))) == []


def cells():
    rng = np.random.default_rng(42)
    rows = []
    for f in range(3):
        for i in range(5):
            rows.append((f, i + 1, 100.0 * (i + 1) + rng.normal(0, 2), 100.0 * (i + 1) + rng.normal(0, 2), "piPOS" if i == 1 and f == 1 else "piNEG", i))
    return pd.DataFrame(rows, columns=["frame", "label", "centroid_0", "centroid_1", "pi_class", "cell"])


def test_tracks_and_lock_in(spark):
    df = spark.createDataFrame(cells()).selectExpr("'a' AS movie", "cast(frame AS int) frame", "cast(label AS int) label", "centroid_0", "centroid_1", "pi_class", "cell")
    got = relational.lock_in(tracks.track_objects(df, tracks.GapTracker(25.0))).toPandas()
    assert (got.groupby("cell").trackid.nunique() == 1).all() and got.trackid.nunique() == 5
    by = got.sort_values("frame").groupby("cell").pi_class.agg(list)
    assert by[1] == ["piNEG", "piPOS", "piPOS"] and all(set(v) == {"piNEG"} for c, v in by.items() if c != 1)
    again = tracks.track_objects(df.repartition(3), tracks.GapTracker(25.0)).toPandas()
    key = ["frame", "label"]
    assert got.sort_values(key).trackid.tolist() == again.sort_values(key).trackid.tolist()


def test_stitch():
    df = pd.DataFrame([(0, 10, 10, 1), (2, 11, 10.5, 2), (2, 10.8, 10.2, 3)], columns=["frame", "centroid_0", "centroid_1", "trackid"])
    got = tracks.stitch(df, 8)
    assert (got.trackid == 1).sum() == 2 and not got.duplicated(["trackid", "frame"]).any()
    far = pd.DataFrame([(0, 10.0, 10.0, 50.0), (2, 10.5, 10.0, 50.0), (20, 10.0, 10.5, 50.0)], columns=["frame", "centroid_0", "centroid_1", "area"])
    assert tracks.DivisionTracker(reid_max_gap=1, stitch_max_distance=8).track(far).trackid.nunique() == 1


def test_division_and_reidentification():
    df = pd.DataFrame([(0, 50.0, 50.0, 100.0), (1, 50.0, 50.0, 100.0), (2, 52.0, 50.0, 50.0), (2, 45.0, 50.0, 48.0)], columns=["frame", "centroid_0", "centroid_1", "area"])
    got = tracks.DivisionTracker(stitch_max_distance=0).track(df)
    child = got[got.parent_track_id >= 0]
    assert len(child) == 1 and child.parent_track_id.iloc[0] == 0 and got.trackid.nunique() == 2
    gone = pd.DataFrame([(0, 9.0, 9.0, 50.0), (0, 90.0, 90.0, 20.0)] + [(f, 90.0, 90.0, 20.0) for f in range(1, 10)] + [(10, 9.0, 9.5, 50.0), (10, 90.0, 90.0, 20.0)], columns=["frame", "centroid_0", "centroid_1", "area"])
    got = tracks.DivisionTracker(gap=2, stitch_max_distance=0).track(gone)
    assert got.trackid.tolist()[0] == got.trackid.tolist()[-2]


def test_tracker_registry(spark):
    t = tracks.make_tracker()
    assert (t.max_distance, t.gap) == (25.0, 2)
    t = tracks.make_tracker(version="v5", overrides={"max_distance": 12.0})
    assert (t.max_distance, t.gap) == (12.0, 5)
    with pytest.raises(ValueError):
        tracks.make_tracker(version="v9")
    with pytest.raises(ValueError):
        tracks.track_objects(spark.createDataFrame([("a", 1)], "movie string, frame int"))
    empty = spark.createDataFrame([], "movie string, frame int, label int, centroid_0 double, centroid_1 double")
    assert tracks.track_objects(empty).count() == 0


def test_kernels():
    flat = np.full((50, 50), 100.0)
    flat[20:30, 20:30] = 200
    for method in ("divide", "subtract"):
        out = k.clear_background(flat, 11, "pixel", method)
        assert out.shape == flat.shape and (out >= 0).all()
    for bad in ({"method": "x"}, {"unit": "y"}):
        with pytest.raises(ValueError):
            k.clear_background(flat, 11, **bad)
    with pytest.raises(ValueError):
        k.clear_background(flat[None], 11)
    assert k.to_uint8(np.array([[0, 0.5], [0.75, 1]]) * 200).tolist() == [[0, 127], [191, 255]]
    with pytest.raises(ValueError):
        k.to_uint8(np.ones((3, 3)))
    z = k.equalise_z(np.arange(256.0).reshape(16, 16))
    assert abs(z.mean()) < 1e-5 and abs(z.std() - 1) < 1e-5
    img = np.full((100, 100), 100.0)
    assert k.fix_dark_border(img, 0.5)[1] is False
    img[:10], img[:, -10:] = 10, 10
    fixed, found = k.fix_dark_border(img, 0.5)
    assert found and abs(fixed[0, 0] - 100) < 1
    noise = np.random.default_rng(42).random((64, 64))
    assert k.sobel(noise, 2).mean() != k.sobel(noise).mean()
    y, x = np.nonzero(np.hypot(*np.mgrid[-10:11, -10:11]) <= 8)
    assert 0.9 < len(y) / k.convex_area(y, x) <= 1.0
    bar = np.zeros((9, 30), bool)
    bar[3:6, 2:28] = True
    assert k.rod_shape(bar) in (0.0, 1.0) or k.rod_shape(bar) >= 0
    assert k.tile_positions(10, 4, 0.33) == [0, 2, 4, 6] and k.tile_positions(3, 4, 0.5) == [0]
    assert k.fit_roi(np.ones((32, 48)), 64).shape == k.fit_roi(np.ones((128, 96)), 64).shape == (64, 64)
    back, (off, by) = k.scale_image(noise, "combined")
    assert np.allclose(back * by + off, noise)
    t = noise[20:30, 30:45]
    s = k.match_template(noise, t)
    assert np.unravel_index(s.argmax(), s.shape) == (20, 30) and abs(s.max() - 1) < 1e-6


def test_nms_and_stitching():
    boxes = np.array([[0, 0, 10, 10], [1, 1, 11, 11], [50, 50, 60, 60]], float)
    assert detect.nms(boxes, np.array([0.9, 0.8, 0.7]), 0.4) == [0, 2]
    assert detect.nms(boxes, np.array([0.9, 0.8, 0.7]), 0.4, classes=np.array([0, 1, 0])) == [0, 1, 2]
    assert detect.nms(boxes[:0], np.array([]), 0.4) == []
    square = np.ones((40, 40), bool)
    merge = lambda a, b, least: detect.merge_clumps(np.array([[a[1], a[0], a[1] + 40, a[0] + 40], [b[1], b[0], b[1] + 40, b[0] + 40]], float), np.array([0.9, 0.7]), [square, square], np.array([a, b]), least)
    one = merge((0, 0), (0, 20), 5)
    assert len(one) == 1 and one[0][0].tolist() == [0, 0, 60, 40] and one[0][1] == pytest.approx(0.8)
    assert len(merge((0, 0), (100, 100), 5)) == 2 and len(merge((0, 0), (0, 39), 100)) == 2
    cell, clump = np.ones((20, 20), bool), np.ones((30, 30), bool)
    labels, source = detect.stitch_masks((64, 64), [cell, clump], [(10, 10), (5, 5)], [0, 1])
    assert len(source) == 1 and (labels[10:30, 10:30] > 0).all()
    labels, source = detect.stitch_masks((64, 64), [np.ones((50, 50), bool), np.ones((10, 10), bool)], [(0, 0), (5, 5)], [0, 1], 0.9)
    assert (labels == 1).sum() > 2000
    s = detect.Settings()
    assert (s.tile, s.overlap, s.score, s.nms_iou, s.clump_overlap, s.priority_fraction, s.temporal_buffer, s.batch, s.mask_threshold) == (256, 0.33, 0.4, 0.4, 250, 0.5, 8, 128, 0.5)


def plane_rows(spark, arrays, movie="a", channel=0):
    from stackrill.schema import PLANE

    return spark.createDataFrame([(movie, t, 0, channel, *a.shape, str(a.dtype), a.tobytes()) for t, a in enumerate(arrays)], PLANE)


def test_measure_blobs(spark):
    frames = []
    for f in range(3):
        img = np.ones((64, 64), np.float32)
        img[20 + 10 * f : 30 + 10 * f, 20 + 10 * f : 30 + 10 * f] = 10 * (f + 1)
        frames.append(img)
    stack = plane_rows(spark, frames)
    labels = planes.label_planes(stack, 5.0, 20)
    rows = planes.measure_planes(stack, labels, 0).orderBy("frame").toPandas()
    assert rows.mean_intensity.tolist() == [10, 20, 30] and rows.centroid_0.tolist() == [24.5, 34.5, 44.5]
    assert rows.area.tolist() == [100] * 3 and rows.background.tolist() == [1, 1, 1]
    assert relational.lead_columns(spark.createDataFrame([(1, 2, 3, 4, 5)], "area int, channel int, frame int, label int, slice int")).columns == ["label", "frame", "slice", "channel", "area"]
    none = planes.label_planes(plane_rows(spark, [np.full((8, 8), 0.5, np.float32)]), 0.5, 1)
    assert planes.to_pixels(none).where("value > 0").count() == 0


def test_plane_and_pixel_measures_agree(spark):
    img = np.random.default_rng(8).random((40, 50)).astype(np.float32)
    stack = plane_rows(spark, [img])
    labels = planes.label_planes(stack, 0.4, 3)
    a = planes.measure_planes(stack, labels, 0).toPandas().set_index("label").sort_index()
    marks = planes.to_pixels(labels).select("movie", "frame", "y", "x", fs.F.col("value").cast("int").alias("label"))
    b = pixels.region_measures(planes.to_pixels(stack).join(marks, ["movie", "frame", "y", "x"])).toPandas().set_index("label").sort_index()
    assert len(a) == len(b) > 5
    for c in k.REGION:
        assert np.allclose(a[c], b[c], rtol=1e-6, atol=1e-9), c


def test_segmenter_pipeline(spark):
    class Squares:
        """A detector that finds bright squares of a tile; its masks are of whole tiles."""

        def detect(self, tile):
            parts, n = k.label(tile > 0.5)
            out = []
            for i in range(1, n + 1):
                y, x = np.nonzero(parts == i)
                out.append((0, 0.9, float(x.min()), float(y.min()), float(x.max() + 1), float(y.max() + 1), (parts == i).astype(np.float32)))
            return out

    frames = []
    for f in range(2):
        img = np.full((60, 60), 10, np.float32)
        img[5:15, 5 + f : 15 + f] = img[40:50, 30:40] = 100
        frames.append(img)
    s = pipelines.Settings(align=False, detector=lambda: Squares(), state_channel=None, tile=64, state=lambda df: models.state_by_threshold(df, "mean_intensity", 1.0))
    out = pipelines.get_pipeline("segmenter")[0](plane_rows(spark, frames), s)
    rows = out.objects.toPandas()
    assert len(rows) == 4 and set(rows.object_class) == {"single-cell"} and rows.trackid.nunique() == 2 and (rows.area >= 80).all()
    points = pipelines.get_pipeline("out_of_focus")[0](plane_rows(spark, frames), s).objects.toPandas()
    assert len(points) == 2 and set(points.source) == {"standard"}


def test_ellipse_axes(spark):
    y, x = np.mgrid[-40:41, -40:41]
    inside = (x / 30) ** 2 + (y / 12) ** 2 <= 1
    df = spark.createDataFrame([("a", 0, int(b), int(a), 1.0, 1) for b, a in np.argwhere(inside)], "movie string, frame int, y int, x int, value double, label int")
    r = pixels.region_measures(df).head()
    assert abs(r.major_axis_length - 60) < 1 and abs(r.minor_axis_length - 24) < 1 and abs(abs(r.orientation) - np.pi / 2) < 1e-6


def greedy_boxes(boxes, scores, most, classes):
    rank = scores + 1e-7 * detect.box_area(boxes) / max(detect.box_area(boxes).max(), 1e-12)
    kept = []
    for i in np.argsort(-rank, kind="stable"):
        over = detect.iou(boxes[i], boxes[kept]) > most if kept else np.zeros(0, bool)
        if not (over & (classes[kept] == classes[i])).any():
            kept.append(int(i))
    return kept


@pytest.mark.parametrize("most", [-1.0, 0.0, 0.1, 0.4, 0.95, 1.0])
def test_nms_equals_brute_force(most):
    r = np.random.default_rng(3)
    for span, spread in ((30.0, 0.0), (300.0, 1.0), (1e7, 3.0)):
        at = r.random((400, 2)) * span - span / 2
        boxes = np.floor(np.concatenate((at, at + np.exp(r.normal(2, spread, (400, 2)))), axis=1))
        boxes[5:10, 2] = boxes[5:10, 0]  # no area
        boxes[390:] = boxes[:10]
        scores, classes = np.round(r.random(400), 1), r.integers(0, 3, 400)
        assert detect.nms(boxes, scores, most, classes=classes) == greedy_boxes(boxes, scores, most, classes)
        assert detect.nms(boxes, scores, most) == greedy_boxes(boxes, scores, most, np.zeros(400))
        classes = np.where(r.random(400) < 0.1, np.nan, classes)  # boxes of no known class compete with none
        assert detect.nms(boxes, scores, most, classes=classes) == greedy_boxes(boxes, scores, most, classes)


def test_nms_compares_near_boxes_only(monkeypatch):
    n, looked, area = 20_000, [], detect.box_area
    monkeypatch.setattr(detect, "box_area", lambda b: looked.append(len(b)) or area(b))
    at = np.random.default_rng(4).random((n, 2)) * 4000
    kept = detect.nms(np.concatenate((at, at + 30), axis=1), np.random.default_rng(5).random(n), 0.4)
    assert n / 4 < len(kept) < n and sum(looked) < 50 * n


def test_nms_per_class_compares_near_boxes_only(monkeypatch):
    n, looked, area = 20_000, [], detect.box_area
    monkeypatch.setattr(detect, "box_area", lambda b: looked.append(len(b)) or area(b))
    r = np.random.default_rng(6)
    at, classes = r.random((n, 2)) * 4000, r.integers(0, 3, n)
    kept = detect.nms(np.concatenate((at, at + 30), axis=1), r.random(n), 0.4, classes=classes)
    assert n / 2 < len(kept) < n and sum(looked) < 50 * n


def test_nms_looks_closely_at_few_boxes_of_a_dense_frame(monkeypatch):
    n, looked, area = 20_000, [], detect.box_area
    monkeypatch.setattr(detect, "box_area", lambda b: looked.append(len(b)) or area(b))
    r = np.random.default_rng(7)
    at, classes = r.random((n, 2)) * 464, r.integers(0, 3, n)  # as dense as frames of lineitem 60 times sf0.1
    boxes, scores = np.concatenate((at, at + 8 + 40 * r.random((n, 2))), axis=1), np.round(r.random(n), 1)
    kept = detect.nms(boxes, scores, 0.4, classes=classes)
    assert n / 4 < len(kept) < n / 2 and sum(looked) < 50 * n


def test_suppress_gathers_frames_by_one_number(spark, monkeypatch):
    rows = [(m, f, 0.0, 0.0, 9.0, 9.0, 0, s, "n") for m in ("a", "b", None) for f in (0.0, -0.0, float("nan"), None, 2.0) for s in (0.5, 0.25)]
    df = spark.createDataFrame(rows, "movie string, frame double, x1 double, y1 double, x2 double, y2 double, class_id int, score double, note string")
    out = detect.suppress(df, per_class=True)
    assert out.schema == df.schema and out.count() == 12 and out.where("score = 0.5").count() == 12  # 0.0 and -0.0 are one frame
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort [_sr_frame" in plan and "FlatMapGroups" not in plan
    monkeypatch.setattr(detect.F, "xxhash64", lambda *_: detect.F.lit(1).cast("long"))  # all frames in one run
    assert sorted(map(str, detect.suppress(df, per_class=True).collect())) == sorted(map(str, out.collect()))


def test_suppress_orders_ties_by_all_columns(spark):
    rows = [("a", 0, 0.0, 0.0, 9.0, 9.0, c, 0.5, note) for c, note in ((1, "y"), (0, "z"), (0, "x"))]
    df = spark.createDataFrame(rows, "movie string, frame int, x1 double, y1 double, x2 double, y2 double, class_id int, score double, note string")
    assert [(r.class_id, r.note) for r in detect.suppress(df).collect()] == [(0, "x")]
    assert [r.class_id for r in detect.suppress(df.drop("note"), per_class=True).orderBy("class_id").collect()] == [0, 1]


def test_equal_axes_have_one_orientation(spark):
    at = [(4, 1), (5, 1), (5, 3), (6, 1), (6, 3), (7, 0), (7, 1), (7, 2), (7, 3)]  # equal moments, which differ in the last digit as doubles
    img = np.zeros((8, 8), np.float32)
    img[tuple(zip(*at))] = 1
    for far in (0, 3000):
        one = k.region_table(np.pad(img, far).astype(int), np.pad(img, far))
        assert abs(one["orientation"][0] + np.pi / 4) < 1e-12 and one["major_axis_length"] == one["minor_axis_length"]
        df = spark.createDataFrame([("a", 0, y + far, x + far, 1.0, 1) for y, x in at], "movie string, frame int, y int, x int, value double, label int")
        r = pixels.region_measures(df, ("movie", "frame")).head()
        assert abs(r.orientation + np.pi / 4) < 1e-12 and r.major_axis_length == r.minor_axis_length


def test_series(spark):
    s = spark.createDataFrame([("a", i, v) for i, v in enumerate([None, 1.0, None, 3.0, None])], "movie string, frame int, v double")
    assert [r.v for r in pixels.interpolate(s, "v").orderBy("frame").collect()] == [1, 1, 2, 3, 3]
    none = spark.createDataFrame([("a", i, None) for i in range(3)], "movie string, frame int, v double")
    assert [r.v for r in pixels.interpolate(none, "v").collect()] == [0, 0, 0]
    m = spark.createDataFrame([("a", i, v) for i, v in enumerate([0.0, 0.0, 50.0, 0.0, 0.0])], "movie string, frame int, v double")
    assert [r.v for r in pixels.moving_median(m, "v", 3).orderBy("frame").collect()] == [0] * 5
    assert [r.v for r in pixels.moving_median(m, "v", 1).orderBy("frame").collect()] == [0, 0, 50, 0, 0]
    ref = spark.createDataFrame([("a", 1000.0, 1400.0), ("a", 1500.0, 1400.0)], "movie string, x double, y double")
    found = spark.createDataFrame([("a", 1, 1010.0, 1406.0), ("a", 1, 1510.0, 1406.0), ("a", 1, 5000.0, 1400.0)], "movie string, frame int, x double, y double")
    assert relational.frame_drift(relational.nearest_reference(found, ref, 300.0)).collect()[0][2:] == (10.0, 6.0)


def test_nearest_reference_makes_no_pairs(spark):
    r = np.random.default_rng(9)
    ref = [(m, float(x), float(y)) for m in "ab" for x, y in r.integers(-60, 60, (12, 2)) * 10] + [("a", None, 1.0), ("c", 0.0, 0.0)]
    found = [(m, f, float(x), float(y)) for m in "abd" for f in (1, 2) for x, y in r.integers(-130, 130, (80, 2)) * 5] + [("a", 1, None, 0.0)]
    for most in (0.0, 40.0, 300.0, 1e6):
        got = relational.nearest_reference(spark.createDataFrame(found, "movie string, frame int, x double, y double"), spark.createDataFrame(ref, "movie string, x double, y double"), most)
        want = []
        for m, f, x, y in found:
            near = min(((abs(x - rx), rx, ry) for rm, rx, ry in ref if rm == m and rx is not None), default=None) if x is not None else None
            if near and near[0] <= most and abs(y - near[2]) <= most:
                want.append((m, f, x, y, x - near[1], y - near[2]))
        assert sorted(map(tuple, got.collect())) == sorted(want)
        joins = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
        assert joins and all(" AND " in line for line in joins)  # none by movie alone


def test_scalars(spark):
    row = spark.range(1).select(*(fs.round_to_odd(fs.F.lit(v)).alias(f"r{i}") for i, v in enumerate((4.0, 4.9, 3.0, 3.5)))).head()
    assert list(row) == [5, 5, 3, 4]
    row = spark.range(1).select(*(fs.strip_extension(fs.F.lit(n)).alias(n.replace(".", "_")) for n in ("a.nd2", "b.ome.p.tiff", "c.tif", "d.ome.tiff"))).head()
    assert list(row) == ["a", "b", "c.tif", "d"]
    assert fs.bit_depth("uint16") == 16
    with pytest.raises(KeyError):
        fs.bit_depth("complex64")


def test_scales_raise_and_flat(spark):
    p = spark.createDataFrame([("a", 0, 0, 0, 5.0), ("a", 0, 0, 1, 5.0)], "movie string, frame int, y int, x int, value double")
    assert {r.scaled for r in pixels.convert_scale(p).collect()} == {0}
    with pytest.raises(ValueError):
        pixels.convert_scale(p, mode="nope")
    with pytest.raises(Exception, match="zero variance"):
        pixels.to_uint8(p).collect()


def test_tiff_round_trip(spark, tmp_path):
    rng = np.random.default_rng(3)
    pages = [rng.integers(0, 60000, (7, 9)).astype(np.uint16) for _ in range(4)]
    (tmp_path / "one.tiff").write_bytes(tiff.write_pages(pages))
    (tmp_path / "bad.tiff").write_bytes(b"nope")
    got = tiff.read_planes(spark, str(tmp_path), channels=2).toPandas()
    assert got.error.notna().sum() == 1
    ok = got[got.error.isna()].sort_values(["frame", "channel"])
    assert [np.frombuffer(p, np.uint16).tolist() for p in ok.pixels] == [p.ravel().tolist() for p in pages]
    assert set(ok.movie) == {"one"} and ok.pixel_size.tolist() == [1.0] * 4
    back = tiff.tiff_files(tiff.read_planes(spark, str(tmp_path), channels=2).where("error IS NULL").drop("pixel_size", "error")).head().tiff
    assert all((a == b).all() for a, b in zip(tiff.read_pages(bytes(back))[0], pages))
    assert len(tiff.stack_index("TCXY", (2, 3, 4, 5))) == 6
    with pytest.raises(ValueError):
        tiff.stack_index("XYZ", (1, 2, 3))
    a = tiff.planes_from_array(spark, "m", np.arange(24, dtype=np.uint8).reshape(2, 3, 4), "TYX").orderBy("frame").head()
    assert (a.height, a.width) == (3, 4)


def test_files(spark, tmp_path):
    for n in ("a.tiff", "b.nd2", "c.txt"):
        (tmp_path / n).write_text("x")
    assert {r.stem for r in files.find_files(spark, str(tmp_path)).collect()} == {"a", "b"}
    assert {r.stem for r in files.find_files(spark, str(tmp_path), worklist=["/x/a.tiff", "/x/z.tiff"]).collect()} == {"a"}
    for n in ("a_summary.csv", "a_fl.csv", "b_fl.csv"):
        (tmp_path / n).write_text("frame,area\n1,2.5\n")
    left = relational.unfinished(files.find_files(spark, str(tmp_path)), files.outputs(spark, str(tmp_path)))
    assert [r.stem for r in left.collect()] == ["b"]
    assert files.read_csvs(spark, str(tmp_path), pattern="_fl").count() == 2 and files.read_csvs(spark, str(tmp_path), pattern="none") is None
    assert [len(b) for b in relational.split_worklists(spark, str(tmp_path), 2, extension=".csv")] == [2, 1]


def test_bundles(tmp_path):
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("../outside.txt", "x")
    with pytest.raises(ValueError, match="Unsafe path"):
        bundle.safe_extract(str(tmp_path / "bad.zip"), str(tmp_path / "out"))
    assert not (tmp_path / "outside.txt").exists()
    (tmp_path / "m.pkl").write_bytes(b"1")
    (tmp_path / "info.yml").write_text("pi_classification:\n  model_path: m.pkl\n")
    out = bundle.write_bundle(str(tmp_path / "info.yml"), str(tmp_path / "b.zip"))
    got = bundle.read_bundle(out, str(tmp_path / "x"), ["pi_classification"])
    assert got.pi_classification.model_path.endswith("models/pi_classification.pkl")
    with pytest.raises(ValueError):
        bundle.read_bundle(out, str(tmp_path / "y"), ["bf_focus"])
    assert bundle.update_config({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}


def test_pipelines(spark):
    rng = np.random.default_rng(5)
    frames = []
    for f in range(3):
        img = (100 + rng.random((48, 48))).astype(np.float32)
        img[10 + f : 20 + f, 10:20] = 400
        img[30:40, 28:38] = 300
        frames.append(img)
    stack = plane_rows(spark, frames).unionByName(plane_rows(spark, frames, channel=1))
    s = pipelines.Settings(align=False, state=lambda df: models.state_by_threshold(df, "rel_mean_intensity", 1.5))
    run, needed = pipelines.get_pipeline("Focus_Restoration")
    out = run(stack, s)
    rows = out.objects.toPandas()
    assert len(rows) >= 6 and {"trackid", "pi_class", "rel_mean_intensity"} <= set(rows.columns)
    assert out.summary.count() == 3
    with pytest.raises(ValueError):
        pipelines.get_pipeline("nope")
    assert len(pipelines.list_pipelines()) == 6


def test_target_line(spark):
    rng = np.random.default_rng(6)
    mark = rng.random((20, 24)).astype(np.float32) * 255
    frames = []
    for f in range(6):
        img = np.full((200, 260), 50, np.float32) + rng.random((200, 260)).astype(np.float32)
        if f != 3:
            for x in (60, 160):
                img[90 + 2 * f : 110 + 2 * f, x + f : x + f + 24] = mark
        frames.append(img)
    stack = plane_rows(spark, frames)
    cal = crop.Calibration(top=-60, bottom=60, window=1)
    got = crop.crop_to_target_line(stack, mark, 200, 260, cal=cal, least=0.8).orderBy("frame").toPandas()
    assert got.height.nunique() == got.width.nunique() == 1
    rows = [int(np.frombuffer(p, np.float32).reshape(h, w).mean(axis=1).argmax()) for p, h, w in zip(got.pixels, got.height, got.width)]
    assert len(set(rows[:3] + rows[4:])) == 1  # the marker stays on its row while it drifts; frame 3 is blank
    with pytest.raises(crop.NoBlockDetected):
        crop.crop_to_target_line(plane_rows(spark, [np.zeros((100, 100), np.float32)]), mark, 100, 100)


def test_stream_tracks(spark, tmp_path):
    from stackrill.streaming import frames as st

    df = cells().assign(movie="a")[["movie", "frame", "label", "centroid_0", "centroid_1"]]
    for f in range(3):
        spark.createDataFrame(df[df.frame == f]).selectExpr("movie", "cast(frame AS int) frame", "cast(label AS int) label", "centroid_0", "centroid_1").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = st.track_stream(stream).writeStream.format("memory").queryName("tracked").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    got = spark.sql("SELECT * FROM tracked").toPandas()
    assert len(got) == 15 and (got.groupby("label").trackid.nunique() == 1).all()


def _tiff(img, compression=1, tile=None, predictor=1, big=False, order="<", description=None, resolution=None, unit=None):
    """A file of one page, by a writer of its own."""
    import struct
    import zlib

    pack = {1: bytes, 8: zlib.compress, 5: _lzw}[compression]
    h, w = img.shape
    blocks = [(y, x) for y in range(0, h, tile or 5) for x in range(0, w, tile or w)]
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HHHQ" if big else order + "HI", *((43, 8, 0, 0) if big else (42, 0))))
    places, sizes = [], []
    for y, x in blocks:
        part = img[y : y + (tile or 5), x : x + (tile or w)]
        if tile:
            part = np.pad(part, ((0, tile - part.shape[0]), (0, tile - part.shape[1])))
        if predictor == 2:
            part = np.diff(part, axis=1, prepend=part[:, :1] * 0)
        raw = pack(part.astype(img.dtype.newbyteorder(order)).tobytes())
        places.append(len(out))
        sizes.append(len(raw))
        out += raw
    kind = {"u": 1, "i": 2, "f": 3}[img.dtype.kind]
    tags = [(256, 4, [w]), (257, 4, [h]), (258, 3, [8 * img.dtype.itemsize]), (259, 3, [compression]), (277, 3, [1]), (317, 3, [predictor]), (339, 3, [kind])]
    tags += [(322, 4, [tile]), (323, 4, [tile]), (324, 4, places), (325, 4, sizes)] if tile else [(273, 4, places), (278, 4, [5]), (279, 4, sizes)]
    if description:
        tags.append((270, 2, description.encode() + b"\0"))
    if resolution:
        tags += [(282, 5, list(resolution)), (296, 3, [unit or 1])]
    word, inline = ("Q", 8) if big else ("I", 4)
    entries = b""
    for tag, kind, values in sorted(tags):
        raw = values if isinstance(values, bytes) else struct.pack(order + {3: "H", 4: "I", 5: "I"}[kind] * len(values), *values)
        count = len(values) // 2 if kind == 5 else len(values)
        if len(raw) > inline:
            at = len(out)
            out += raw
            raw = struct.pack(order + word, at)
        entries += struct.pack(order + "HH" + word, tag, kind, count) + raw.ljust(inline, b"\0")
    struct.pack_into(order + word, out, 8 if big else 4, len(out))
    return bytes(out) + struct.pack(order + ("Q" if big else "H"), len(tags)) + entries + struct.pack(order + word, 0)


def _lzw(data):
    """Codes of the longest known beginnings, most significant bit first."""
    bits, table, word = [], {bytes([i]): i for i in range(256)}, b""
    put = lambda code, width: bits.extend(code >> b & 1 for b in range(width - 1, -1, -1))
    size = lambda n: 12 if n >= 2048 else 11 if n >= 1024 else 10 if n >= 512 else 9
    put(256, 9)
    n = 258
    for byte in data:
        if word + bytes([byte]) in table:
            word += bytes([byte])
            continue
        put(table[word], size(n))
        table[word + bytes([byte])] = n
        n += 1
        word = bytes([byte])
        if n == 4094:
            put(table[word], 12)
            put(256, 12)
            table, word, n = {bytes([i]): i for i in range(256)}, b"", 258
    if word:
        put(table[word], size(n))
        n += 1
    put(257, size(n))
    bits += [0] * (-len(bits) % 8)
    return bytes(int("".join(map(str, bits[i : i + 8])), 2) for i in range(0, len(bits), 8))


@pytest.mark.parametrize("options", [{}, {"compression": 8}, {"compression": 5}, {"tile": 16}, {"tile": 16, "compression": 8, "predictor": 2}, {"big": True}, {"order": ">"}, {"compression": 5, "tile": 32, "big": True}])
def test_tiff_layouts(options):
    rng = np.random.default_rng(3)
    for img in (rng.integers(0, 60000, (37, 53)).astype(np.uint16), np.tile(np.arange(50, dtype=np.uint8), (90, 2))):
        (got,), size = tiff.read_pages(_tiff(img, **options))
        assert got.dtype == img.dtype and (got == img).all() and size == tiff.PIXEL_SIZE
    noise = rng.normal(size=(20, 30)).astype(np.float32)
    assert (tiff.read_pages(_tiff(noise, **(options | {"predictor": 1})))[0][0] == noise).all()


def test_tiff_metadata():
    img = np.zeros((6, 6), np.uint8)
    assert tiff.read_pages(_tiff(img, resolution=(20000, 1), unit=3))[1] == 0.5
    assert tiff.read_pages(_tiff(img, resolution=(4, 1), description="ImageJ=1.5\nunit=micron\n"))[1] == 0.25
    assert tiff.read_pages(_tiff(img, description='<OME><Pixels PhysicalSizeX="0.11"/></OME>'))[1] == 0.11
    assert tiff.read_pages(_tiff(img), tiff.FOCUS_PIXEL_SIZE)[1] == 0.65
    assert tiff._axes(b"ImageJ=1.5\nchannels=2\nframes=3\n", 6) == (2, 1, "CZT") and tiff._axes(b"ImageJ=1.5\nframes=4\n", 6) is None
    assert tiff._axes(b'<OME><Pixels DimensionOrder="XYZTC" SizeC="2" SizeZ="1" SizeT="3"/></OME>', 6) == (2, 1, "ZTC")
    with pytest.raises(ValueError):
        tiff.read_pages(b"II" + bytes(20))


def test_saved_tiffs_and_decoders(spark, tmp_path):
    rng = np.random.default_rng(5)
    stacks = {m: rng.integers(0, 900, (4, 2, 9, 7)).astype(np.uint16) for m in ("a", "b")}
    rows = [tiff.planes_from_array(spark, m, s, "TCYX") for m, s in stacks.items()]
    done = tiff.save_tiffs(rows[0].unionByName(rows[1]).repartition(5), f"{tmp_path}/out", "_labels.tiff").collect()
    assert sorted((r.movie, r.pages) for r in done) == [("a", 8), ("b", 8)]
    back = tiff.read_planes(spark, f"{tmp_path}/out", channels=2).toPandas()
    for m, s in stacks.items():
        own = back[back.movie == f"{m}_labels"]
        assert len(own) == 8 and all((np.frombuffer(r.pixels, r.dtype).reshape(9, 7) == s[r.frame, r.channel]).all() for r in own.itertuples())
    (tmp_path / "x.nd2").write_bytes(b"\1\2\3\4")
    tiff.DECODERS[".nd2"] = lambda data: ([((0, 0, 0), np.frombuffer(data, np.uint8).reshape(2, 2))], 0.3)
    try:
        one = tiff.read_planes(spark, str(tmp_path), glob="*.nd2").collect()
    finally:
        del tiff.DECODERS[".nd2"]
    assert [(r.movie, r.pixel_size, r.error) for r in one] == [("x", 0.3, None)]


def test_user_measures(spark):
    rng = np.random.default_rng(2)
    img, mask = rng.random((1, 20, 20)).astype(np.float32), np.zeros((1, 20, 20), np.int32)
    mask[0, 2:6, 3:9], mask[0, 10:12, 1:4] = 1, 2
    stack, labels = tiff.planes_from_array(spark, "m", img, "TYX"), tiff.planes_from_array(spark, "m", mask, "TYX")
    rows = planes.measure_planes(stack, labels, 0, extra={"top": lambda m, v: v[m].max(), "pixels": lambda m, v: m.sum()}).toPandas()
    assert rows.pixels.tolist() == [24, 6] and np.allclose(rows.top, rows.max_intensity)


def test_windows_models_and_trackers(spark):
    rng = np.random.default_rng(8)
    for shape in ((30, 30), (70, 45), (10, 90), (3, 3)):
        img = rng.random(shape).astype(np.float32)
        assert np.allclose(models.predict_windows(img, lambda p: 2 * p, 32, 0.5), 2 * img, atol=1e-5)
    for bad in (lambda p: p[:3], lambda p: p * np.nan, lambda p: 1 / 0):
        with pytest.raises(ValueError):
            models.checked(type("M", (), {"predict": staticmethod(bad)})())
    img = rng.random((2, 40, 50)).astype(np.float32)
    stack = tiff.planes_from_array(spark, "m", img, "TYX")
    twice = type("Twice", (), {"predict": lambda self, p: p})
    got = models.predict_planes(stack, twice, 16, normalise=True).orderBy("frame").toPandas()
    assert all(np.allclose(np.frombuffer(p, np.float32).reshape(40, 50), i, atol=1e-5) for p, i in zip(got["pixels"], img))
    assert models.to_rgb(img[0]).shape == (40, 50, 3)

    class Many:
        def detect_many(self, tiles):
            assert len(tiles) <= 3
            return [[(0, 0.9, 1.0, 1.0, 4.0, 4.0, np.ones((16, 16), np.float32))] for _ in tiles]

    found = models.detect_tiles(planes.tiles(stack, 16), Many, 16, batch=3, buffer=1)
    assert found.count() == planes.tiles(stack, 16).count()
    with pytest.raises(ValueError):
        tracks.make_tracker("btrack", overrides={"motion_model": {}}, load=lambda c: None)
    with pytest.raises(ValueError):
        tracks.make_tracker("btrack")
    stub = tracks.make_tracker("btrack", overrides={"motion_model": {}, "hypothesis_model": {}}, load=lambda c: lambda rows: [(i % 2, -1) for i in range(len(rows))])
    objects = spark.createDataFrame([("m", f, n, float(n), 0.0, 5.0) for f in range(3) for n in (1, 2)], "movie string, frame int, label int, centroid_0 double, centroid_1 double, area double")
    assert {(r.label, r.trackid) for r in tracks.track_objects(objects, stub).collect()} == {(1, 0), (2, 1)}


def test_alignment_to_the_frame_before(spark):
    rng = np.random.default_rng(6)
    base = rng.random((32, 32))
    stack = np.stack([np.roll(base, (2 * f, -f), (0, 1)) for f in range(4)]).astype(np.float32)
    for reference in ("first", "previous"):
        got = planes.align_shifts(tiff.planes_from_array(spark, "m", stack, "TYX"), reference=reference).orderBy("frame").collect()
        assert [(r.dy, r.dx) for r in got] == [(-2 * f, f) for f in range(4)]


def test_flat_field_is_the_blurred_mean(spark):
    rng = np.random.default_rng(7)
    stack = rng.random((6, 2, 12, 12)).astype(np.float32) + 1
    got = planes.flat_field(tiff.planes_from_array(spark, "m", stack, "TCYX").repartition(4), 5).toPandas()
    assert len(got) == 12
    for r in got.itertuples():
        field = k.gaussian_blur(stack[:, r.channel].astype(float).mean(axis=0), 5)
        assert np.allclose(np.frombuffer(r.pixels, np.float32).reshape(12, 12), stack[r.frame, r.channel] / (field / field.mean()), rtol=1e-4)


def test_assignment_and_shapes_against_brute_force(spark):
    rng = np.random.default_rng(12)
    for _ in range(10):  # two frames: the tracker's links have the least sum of distances within the bound
        a, b = rng.random((4, 2)) * 40, rng.random((4, 2)) * 40
        rows = pd.DataFrame([(0, i + 1, *p) for i, p in enumerate(a)] + [(1, i + 1, *p) for i, p in enumerate(b)], columns=["frame", "label", "centroid_0", "centroid_1"]).assign(movie="m", area=1.0)
        got = tracks.GapTracker(1e6, 1).track(rows)
        ids = got["trackid"].to_numpy()
        d = np.hypot(*(a[:, None] - b[None]).transpose(2, 0, 1))
        best = min(itertools.permutations(range(4)), key=lambda p: sum(d[i, p[i]] for i in range(4)))
        assert [int(np.flatnonzero(ids[4:] == ids[i])[0]) for i in range(4)] == list(best)
    parts = np.zeros((1, 40, 40), np.int32)
    parts[0, 2:12, 2:7], parts[0, 20:30, 20:30] = 1, 2
    parts[0, 24:30, 24:30] = 0
    rows = planes.shape_measures(tiff.planes_from_array(spark, "m", parts, "TYX")).toPandas().set_index("label")
    assert rows.loc[1, "solidity"] == 1.0 and 0.6 < rows.loc[2, "solidity"] < 0.9


def test_crop_to_walls(spark):
    search = crop.WallSearch(above=(20, 90), below=(20, 90), beside=(30, 140), smooth=3, reach=12, inset=(4, 4, 3), block=15, fixed=(50, 40))
    rng = np.random.default_rng(9)
    img = 200 + rng.normal(0, 1, (200, 300))
    img[38:42], img[160:164] = 60, 60
    img[:, 48:52], img[:, 248:252] = 40, 40
    mark = rng.random((12, 12)) * 100
    img[95:107, 145:157] = mark
    y0, y1, x0, x1 = crop.wall_box(img, [(101.0, 151.0)], search, sides=True)
    assert (abs(y0 - 44) <= 2, abs(y1 - 158) <= 2, abs(x0 - 53) <= 2, abs(x1 - 247) <= 2) == (True,) * 4
    plain = np.full((200, 300), 200.0)
    assert crop.wall_box(plain, [(101.0, 151.0)], search) == (51, 141, 0, 300)
    stack = tiff.planes_from_array(spark, "m", np.stack([img, img]).astype(np.float32), "TYX")
    got = crop.crop_to_walls(stack, mark, 200, 300, search=search, sides=True, least=0.9).collect()
    assert [(r.height, r.width) for r in got] == [(y1 - y0, x1 - x0)] * 2
    with pytest.raises(crop.NoBlockDetected):
        crop.crop_to_walls(tiff.planes_from_array(spark, "m", plain[None].astype(np.float32), "TYX"), mark, 200, 300, search=search, least=0.9)


def test_low_rank_field(spark):
    """Uneven light times scenes of different brightness with sparse objects: the light is found."""
    rng = np.random.default_rng(13)
    y, x = np.mgrid[-1:1:64j, -1:1:64j]
    light = 1.2 - 0.4 * (y * y + x * x)
    light /= light.mean()
    stack = np.empty((20, 64, 64))
    for i in range(20):
        scene = np.full((64, 64), rng.uniform(50, 200))
        for _ in range(12):
            a, b = rng.integers(0, 56, 2)
            scene[a : a + 6, b : b + 6] += rng.uniform(100, 400)
        stack[i] = scene * light + rng.normal(0, 1, (64, 64))
    field = k.low_rank_field(stack)
    assert np.abs(field - light).max() < 0.06 and np.abs(field - light).mean() < 0.01
    assert np.abs(stack.mean(axis=0) / stack.mean() - light).mean() > 2 * np.abs(field - light).mean()
    got = planes.flat_field(tiff.planes_from_array(spark, "m", stack.astype(np.float32), "TYX"), 0.1, "low_rank").orderBy("frame").toPandas()
    flat = np.frombuffer(got["pixels"][0], np.float32).reshape(64, 64)
    assert np.allclose(flat, stack[0] / field, rtol=1e-3)
