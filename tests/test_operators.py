"""DataFrame operators on small inputs with known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbiscope.config import Config
from orbiscope.functions import exprs
from orbiscope.operators import detections, pixels, rasters, tracking, windows

BOXES = "frame int, cls string, score double, x0 double, y0 double, x1 double, y1 double, id int"
TIES = ["x0", "y0", "x1", "y1", "id"]


def spans(spark, n, size, stride):
    df = windows.plan(spark.createDataFrame([("s", n)], "sequence_id string, n int"), size, stride)
    return [(r.start, r.end) for r in df.orderBy("window_index").collect()]


@pytest.mark.parametrize(
    "n, size, stride, want",
    [
        (60, 24, 12, [(0, 24), (12, 36), (24, 48), (36, 60)]),
        (25, 24, 12, [(0, 24), (1, 25)]),
        (5, 24, 12, [(0, 5)]),
        (0, 24, 12, []),
        (4, 3, 1, [(0, 3), (1, 4)]),
    ],
)
def test_windows(spark, n, size, stride, want):
    assert spans(spark, n, size, stride) == want


def test_window_settings(spark):
    for size, stride in ((24, 24), (1, 1), (4, 0)):
        with pytest.raises(ValueError):
            windows.check_settings(size, stride)


def test_windows_skip_missing_frames(spark):
    frames = spark.createDataFrame([("s", i, i != 1) for i in range(5)], "sequence_id string, csv_row_number int, file_exists boolean")
    got = [tuple(r.frame_indices) for r in windows.plan_for_frames(frames, 3, 1).orderBy("window_index").collect()]
    assert got == [(0, 2, 3), (2, 3, 4)]


def test_reconciliation(spark):
    plan = windows.plan(spark.createDataFrame([("s", 5)], "sequence_id string, n int"), 4, 2)
    chosen = {r.position: r.window_index for r in windows.reconcile(plan).collect()}
    assert [f"w{chosen[p]}f{p + 10}" for p in range(5)] == ["w0f10", "w0f11", "w0f12", "w1f13", "w1f14"]
    predictions = windows.members(plan).where("position <> 4").select("sequence_id", "window_index", "position", F.lit(1).alias("v"))
    missing = windows.take_predictions(windows.reconcile(plan), predictions).where("missing").collect()
    assert [r.position for r in missing] == [4]


@pytest.mark.parametrize("k", [0, 1, 2, 3, 8])
def test_sampled_positions(spark, k):
    df = spark.range(0, 40).select("id", windows.sampled_positions(F.col("id"), k).alias("p"))
    for n, got in df.collect():
        if k == 0:
            want = []
        elif n <= k:
            want = list(range(n))
        else:
            want = np.rint(np.linspace(0, n - 1, k)).astype(int).tolist()
        assert got == want, (n, k)


def test_suppression_keeps_small_boxes_of_other_classes(spark):
    rows = [
        (0, "person", 0.95, 0.0, 0.0, 10.0, 10.0, 0),
        (0, "person", 0.70, 1.0, 1.0, 10.5, 10.5, 1),
        (0, "bicycle", 0.98, 2.0, 2.0, 3.0, 3.0, 2),
    ]
    kept = detections.suppress(spark.createDataFrame(rows, BOXES), ["frame"], "cls", 0.7, TIES).orderBy("rank").collect()
    assert [(r.cls, r.rank) for r in kept] == [("bicycle", 1), ("person", 2)]


def test_suppression_counts(spark):
    rows = [
        (0, "person", 0.93, 1.0, 1.0, 6.0, 6.0, 0),
        (0, "person", 0.65, 1.2, 1.2, 6.1, 6.1, 1),
        (0, "bicycle", 0.99, 2.0, 2.0, 3.0, 3.0, 2),
        (0, "car", 0.74, 7.0, 1.0, 11.0, 5.0, 3),
    ]
    raw = spark.createDataFrame(rows, BOXES)
    kept = detections.suppress(raw, ["frame"], "cls", 0.7, TIES)
    assert detections.counts(raw, kept, ["frame"]).collect() == [(0, 4, 3)]


def test_overlap_at_the_threshold_stays(spark):
    rows = [(0, "a", 0.9, 0.0, 0.0, 2.0, 1.0, 0), (0, "a", 0.8, 1.0, 0.0, 3.0, 1.0, 1)]  # overlap exactly 1/3
    boxes = spark.createDataFrame(rows, BOXES)
    assert detections.suppress(boxes, ["frame"], "cls", 1 / 3, TIES).count() == 2
    assert detections.suppress(boxes, ["frame"], "cls", 0.33, TIES).count() == 1


def test_suppression_without_boxes(spark):
    assert detections.suppress(spark.createDataFrame([], BOXES), ["frame"], "cls", 0.5, TIES).count() == 0


def test_pack_and_unpack(spark):
    rng = np.random.default_rng(3)
    rows = [("s", i, 5, 6, (rng.random(30) < 0.4).astype(np.uint8).tobytes()) for i in range(8)]
    df = spark.createDataFrame(rows, "sequence_id string, frame_idx int, height int, width int, mask binary")
    px = rasters.unpack(df, list(pixels.KEYS))
    back = {r.frame_idx: np.frombuffer(r.mask, np.uint8) for r in rasters.pack(px, list(pixels.KEYS), 5, 6).collect()}
    for _, i, _, _, mask in rows:
        on = np.frombuffer(mask, np.uint8) > 0
        assert (back[i] > 0).tolist() == on.tolist() if on.any() else i not in back


def test_temporal_consistency_ignores_other_shapes(spark):
    full, none = b"\xff" * 4, b"\x00" * 4
    rows = [("s", 0, 2, 2, full), ("s", 1, 2, 2, none), ("s", 2, 2, 2, full), ("s", 3, 2, 2, none), ("s", 4, 1, 4, full), ("t", 0, 2, 2, none)]
    df = spark.createDataFrame(rows, "sequence_id string, frame_idx int, height int, width int, mask binary")
    got = {(r.sequence_id, r.frame_idx): r.mask for r in rasters.temporal_consistency(df).collect()}
    assert got["s", 1] == full and got["s", 3] == none and got["t", 0] == none


def test_pixel_and_packed_forms_agree(spark):
    rng = np.random.default_rng(5)
    rows = [("s", i, 6, 7, np.where(rng.random(42) < 0.5, 255, 0).astype(np.uint8).tobytes()) for i in range(12)]
    df = spark.createDataFrame(rows, "sequence_id string, frame_idx int, height int, width int, mask binary")
    keys = list(pixels.KEYS)
    px = rasters.unpack(df, keys)

    def rows_of(d):
        return sorted(tuple(r) for r in d.select(*keys, "y", "x").collect())

    for radius in (1, 2, 3):
        assert rows_of(rasters.unpack(rasters.dilate(df, radius), keys)) == rows_of(pixels.dilate(px, radius, 6, 7))
        assert rows_of(rasters.unpack(rasters.dilate(df, radius, True), keys)) == rows_of(pixels.dilate(px, radius, 6, 7, True))
        assert rows_of(rasters.unpack(rasters.erode(df, radius), keys)) == rows_of(pixels.erode(px, radius, 6, 7))
    for wrap in (False, True):
        assert rows_of(rasters.unpack(rasters.majority_smooth(df, 2, wrap), keys)) == rows_of(pixels.majority_smooth(px, 6, 7, wrap, 2))
    assert rows_of(rasters.unpack(rasters.top_run(df, 0.4), keys)) == rows_of(pixels.top_run(px, 6, 0.4))


def test_labels_and_paths(spark):
    df = spark.createDataFrame([("pick-up  Truck_x",)], "t string")
    row = df.select(exprs.detection_label(F.col("t")).alias("a"), exprs.class_label(F.col("t")).alias("b")).first()
    assert (row.a, row.b) == ("pick up truck x", "pick-up truck x")
    cases = [
        ("a/b.jpg", "/d/GS1/fixed/b.jpg"),
        (" /x/fixed/c.jpg ", "/x/fixed/c.jpg"),
        ("/x/raw/c.jpg", "/d/GS1/fixed/c.jpg"),
        ("fixed/../fixed/./d.jpg", "/d/GS1/fixed/d.jpg"),
        ("~/fixed/e.jpg", "/home/u/fixed/e.jpg"),
        ("/x/prefixed/c.jpg", "/d/GS1/fixed/c.jpg"),
    ]
    got = spark.createDataFrame(cases, "raw string, want string").select(
        exprs.resolve_frame_path(F.lit("/d/GS1"), F.col("raw"), "/home/u").alias("got"), "want"
    )
    assert all(r.got == r.want for r in got.collect())
    stems = [("a.b.jpg", "a.b"), (".x", ".x"), ("GS-frame-000012.jpg", "GS-frame-000012"), ("n", "n")]
    for r in spark.createDataFrame(stems, "n string, w string").select(exprs.file_stem(F.col("n")).alias("g"), "w").collect():
        assert r.g == r.w
    numbers = spark.createDataFrame([("x-frame-000012",), ("x-frame-",), ("frame-1b",)], "s string").select(exprs.frame_number(F.col("s")).alias("n"))
    assert [r.n for r in numbers.collect()] == [12, None, None]


def prompt(frame, idx, box, cls="car", face="front", source="grounding_box", score=0.9):
    return ("s", frame, face, idx, cls, source, *map(float, box), score)


PROMPTS = (
    "sequence_id string, frame_idx int, face string, prompt_idx int, class_text string, source string, x0 double, y0 double,"
    " x1 double, y1 double, score double"
)


def test_memory_attaches_and_carries(spark):
    rows = [
        prompt(0, 0, (0, 0, 10, 10)),
        prompt(0, 1, (0, 0, 4, 4), "roof", "front"),
        prompt(1, 0, (1, 1, 11, 11)),
        prompt(2, 0, (50, 50, 60, 60)),
        prompt(9, 0, (50, 50, 60, 60)),
    ]
    got = tracking.attach_priors(spark.createDataFrame(rows, PROMPTS), Config()).collect()
    by = {(r.frame_idx, r.class_text): (r.source, r.used_temporal_prior) for r in got}
    assert by[0, "car"] == ("grounding_box", False)
    assert by[1, "car"] == ("grounding_box", True)
    assert by[2, "car"] == ("grounding_box", False)  # moved too far
    assert by[9, "car"] == ("grounding_box", False)  # seen too long ago
    assert by[1, "roof"] == ("temporal_prior", True) and by[2, "roof"] == ("temporal_prior", True)
    assert (9, "roof") not in by


def test_tracks(spark):
    rows = [
        prompt(0, 0, (0, 0, 10, 10)),
        prompt(0, 1, (20, 0, 30, 10)),
        prompt(1, 0, (21, 0, 31, 10)),
        prompt(1, 1, (0, 0, 10, 10), "bus"),
        prompt(2, 0, (22, 0, 32, 10)),
        prompt(2, 1, (22, 0, 32, 10)),
        prompt(5, 0, (22, 0, 32, 10)),
    ]
    got = {(r.frame_idx, r.prompt_idx): (r.track_id, r.reused) for r in tracking.assign_tracks(spark.createDataFrame(rows, PROMPTS), Config()).collect()}
    assert got[0, 0] == (1, False) and got[0, 1] == (2, False)
    assert got[1, 0] == (2, True) and got[1, 1] == (3, False)
    assert got[2, 0] == (2, True) and got[2, 1] == (4, False)
    assert got[5, 0] == (5, False)


def test_roof_on_the_lower_face_needs_any_overlap():
    tracker = tracking.Tracker(Config())
    a = dict(face="down", class_text="roof", source="s", x0=0.0, y0=0.0, x1=10.0, y1=10.0)
    tracker.assign([a], 0)
    assert tracker.assign([a | {"x0": 9.0, "y0": 9.0, "x1": 30.0, "y1": 30.0}], 1)[0][2]
    assert not tracker.assign([a | {"x0": 40.0, "x1": 50.0}], 1)[0][2]


def test_propagation_rules():
    tracker = tracking.Tracker(Config(sam2_temporal_max_gap=1))
    p = dict(face="front", class_text="car", source="s", x0=0.0, y0=0.0, x1=1.0, y1=1.0)
    tracker.assign([p], 0)
    assert tracker.accepts(1, 1, False) and not tracker.accepts(1, 2, False) and tracker.accepts(1, 2, True)


def test_union_of_packed_masks(spark):
    from orbiscope.plans.stages import union_masks

    rng = np.random.default_rng(2)
    masks = [np.where(rng.random(9 * 15) < 0.3, 255, 0).astype(np.uint8) for _ in range(4)]
    rows = [("s", i // 2, 9, 15, m.tobytes()) for i, m in enumerate(masks)]
    df = spark.createDataFrame(rows, "sequence_id string, frame_idx int, height int, width int, mask binary")
    got = {r.frame_idx: r.made for r in union_masks(df, ["sequence_id", "frame_idx"], "made").collect()}
    assert all(got[i] == np.maximum(masks[2 * i], masks[2 * i + 1]).tobytes() for i in (0, 1))


def test_fusion_sky_excludes_everything(spark):
    from orbiscope.plans.stages import fuse_masks, fusion_roll_up

    full, none = b"\xff" * 64, b"\x00" * 64
    rows = [("s", 0, 8, 8, full, none, full), ("s", 1, 8, 8, full, none, none), ("s", 2, 8, 8, None, none, full)]
    df = spark.createDataFrame(rows, "sequence_id string, frame_idx int, height int, width int, dynamic binary, roof binary, sky binary")
    fused = fuse_masks(df, Config())
    got = {r.frame_idx: (r.inpaint_area_px, r.mask_fusion_status) for r in fused.collect()}
    assert got == {0: (0, "fused"), 1: (64, "fused"), 2: (None, "failed")}
    assert fusion_roll_up(fused).collect() == [("s", "failed_mask_fusion", "1 frame(s) failed mask fusion")]


# --- sequence refiner ------------------------------------------------------------------------------------------------

def _sequence(spark, frames, asked, n=12):
    """Faces of ``frames`` frames (front and down), and prompts (frame, face, class, source, box, score)."""
    faces = spark.createDataFrame(
        [("s", i, f, n, bytearray([i]) * (n * n * 3)) for i in range(frames) for f in ("front", "down")],
        "sequence_id string, frame_idx int, face string, face_total int, face_rgb binary",
    )
    rows = [
        ("s", i, f, 0, k, f"{f}:{c}:{k}", c, source, *map(float, box), score, None) for k, (i, f, c, source, box, score) in enumerate(asked)
    ]
    prompts = spark.createDataFrame(
        rows,
        "sequence_id string, frame_idx int, face string, kind int, place int, prompt_id string, class_text string, source string,"
        " x0 double, y0 double, x1 double, y1 double, score double, prior_mask binary",
    )
    return faces, prompts


def test_sequence_refiner_follows_tracks(spark):
    from orbiscope.config import Config
    from orbiscope.plans import backends, vision

    asked = [
        (0, "front", "car", "grounding_box", (1, 1, 7, 7), 0.9),
        (1, "front", "car", "grounding_box", (2, 1, 8, 7), 0.8),  # overlaps: the same track
        (1, "front", "bus", "grounding_box", (1, 1, 3, 3), 0.7),  # an area of 4: too small for a mask
        (4, "front", "car", "grounding_box", (1, 1, 7, 7), 0.6),  # after the gap: a new track
        (0, "down", "roof", "roof_down_prior", (2, 2, 10, 10), 1.0),
    ]
    faces, prompts = _sequence(spark, 5, asked)
    got = vision.refine_sequences(faces, prompts, backends.BoxSequenceRefiner, Config(sam2_temporal_max_gap=1))
    rows = {(r.frame_idx, r.face): r for r in got.collect()}
    assert len(rows) == 10 and all(r.status == "refined" and not r.warnings for r in rows.values())

    def shown(frame, face="front"):
        r = rows[frame, face]
        return [(m.class_text, m.source, m.prompt_id, m.used_temporal_prior, (m.x0, m.y0, m.x1, m.y1), round(m.score, 1)) for m in r.masks]

    assert shown(0) == [("car", "grounding_box", "front:car:0", False, (1, 1, 7, 7), 0.9)]
    assert shown(1) == [("car", "grounding_box", "front:car:1", True, (2, 1, 8, 7), 0.8)]
    assert shown(2) == [("car", "temporal_prior", "front:temporal:car:1:2", True, (2, 1, 8, 7), 0.8)]
    assert shown(3) == []
    assert shown(4) == [("car", "grounding_box", "front:car:3", False, (1, 1, 7, 7), 0.6)]
    assert [len(rows[i, "down"].masks) for i in range(5)] == [1, 1, 0, 0, 0]
    assert [rows[i, "front"].prior_count for i in range(5)] == [0, 1, 1, 0, 0]
    status = {r.frame_idx: r for r in vision.refine_status(got).collect()}
    assert [status[i].sam2_mask_count for i in range(5)] == [2, 2, 1, 0, 1]
    off = vision.refine_sequences(faces, prompts, backends.BoxSequenceRefiner, Config(sam2_temporal_propagation=False))
    assert sum(len(r.masks) for r in off.collect()) == 4


class _Breaking:
    """Fails for one class of prompts in one frame."""

    model_id = "test/breaking"

    def __init__(self, class_text, frame):
        self.class_text, self.at = class_text, frame

    def open_sequence(self, face, config):
        from orbiscope.plans import backends

        inner, outer = backends.BoxSequenceRefiner().open_sequence(face, config), self

        class Session:
            seen = False

            def frame(self, frame, rgb, prompts):
                self.seen = self.seen or any(p["class_text"] == outer.class_text for _, p, _ in prompts)
                if frame == outer.at and self.seen:
                    raise RuntimeError("no memory left")
                return inner.frame(frame, rgb, prompts)

        return Session()


def test_a_failing_group_of_a_sequence(spark):
    from orbiscope.config import Config
    from orbiscope.plans import vision

    asked = [(i, "front", c, "semantic_region", (1, 1, 9, 9), 1.0) for i in range(3) for c in ("car", "sky")]
    faces, prompts = _sequence(spark, 3, asked)
    optional = vision.refine_sequences(faces, prompts, lambda: _Breaking("sky", 1), Config())
    rows = optional.collect()
    assert {r.status for r in rows} == {"refined"}
    assert {m.class_text for r in rows for m in r.masks} == {"car"}, "masks of earlier frames go too"
    text = "sky SAM 2 video refinement failed; sky mask will use semantic fallback: no memory left"
    assert {r.sam2_refine_error for r in vision.refine_status(optional).collect()} == {text}
    required = vision.refine_sequences(faces, prompts, lambda: _Breaking("car", 2), Config())
    status = vision.refine_status(required).collect()
    assert {(r.sam2_refine_status, r.sam2_refine_error, r.sam2_mask_count) for r in status} == {("failed", "no memory left", 0)}


def test_devices_and_plugins():
    from orbiscope.config import Config
    from orbiscope.plans import backends

    assert backends.resolve_device("cuda:1") == "cuda:1" and backends.resolve_device("auto") == "cpu"
    assert backends.resolve_device("auto", lambda d: d in ("mps", "cpu")) == "mps"
    model = backends.plugin("orbiscope.plans.backends:is_out_of_memory", Config(), "auto")
    with pytest.raises(TypeError):  # called with the settings and the device
        model()
    with pytest.raises(ValueError):
        backends.plugin("nothing", Config(), "auto")


def test_unpack_and_unions_of_large_masks(spark):
    import time

    from orbiscope.operators import rasters
    from orbiscope.plans import stages

    rng = np.random.default_rng(4)
    masks = [np.where(rng.random((1664, 1664)) < 0.01, 255, 0).astype(np.uint8) for _ in range(4)]
    rows = [(i // 2, 1664, 1664, m.tobytes()) for i, m in enumerate(masks)] + [(0, 1664, 1664, None), (7, 0, 0, b"")]
    df = spark.createDataFrame(rows, "k int, height int, width int, mask binary")
    began = time.perf_counter()
    assert rasters.unpack(df, ["k"]).count() == sum(int((m > 0).sum()) for m in masks)
    united = {r.k: r.u for r in stages.union_masks(df, ["k"], "u").collect()}
    assert time.perf_counter() - began < 60
    assert united[0] == np.maximum(masks[0], masks[1]).tobytes() and united[1] == np.maximum(masks[2], masks[3]).tobytes()


def test_arrays_written_by_other_tools(spark):
    import io

    from orbiscope.sources import images

    buffer = io.BytesIO()
    np.savez(buffer, boxes_xyxy=np.arange(8, dtype=np.float32).reshape(2, 4), class_text=np.array(["car", "été"]), other=np.zeros(3))
    files = spark.createDataFrame([("a.npz", bytearray(buffer.getvalue()))], "path string, content binary")
    got = {r.name: r for r in images.read_arrays(files, ["boxes_xyxy", "class_text", "absent"]).collect()}
    assert set(got) == {"boxes_xyxy", "class_text"}
    boxes = np.frombuffer(got["boxes_xyxy"].data, got["boxes_xyxy"].dtype).reshape(got["boxes_xyxy"].shape)
    assert np.array_equal(boxes, np.arange(8).reshape(2, 4)) and got["class_text"].data.decode().split("\n") == ["car", "été"]


def test_semantic_scores_reach_their_table(spark):
    from orbiscope.plans import backends, vision

    class Scorer:
        model_id = "test/scorer"

        def parse_face(self, face, rgb):
            scores = np.stack([rgb[..., 0] / 255, 1 - rgb[..., 0] / 255])
            return backends.SemanticPrediction(labels=scores.argmax(0).astype(np.int32), scores=scores)

    raster = np.array([[0, 255], [200, 20]], np.uint8)
    faces = spark.createDataFrame(
        [("s", 0, "front", 0, 2, bytearray(np.repeat(raster[..., None], 3, 2).tobytes()))],
        "sequence_id string, frame_idx int, face string, face_ord int, face_total int, face_rgb binary",
    )
    row = vision.parse_semantic(faces, Scorer, {"sky": 0, "car": 1, "bus": None}).first()
    scores = np.frombuffer(row.scores, "<f2").reshape(2, 2, 2)
    assert row.has_logits and np.allclose(scores[0], raster / 255, atol=1e-3)
    masks = {t.class_name: np.frombuffer(t.mask, np.uint8).reshape(2, 2) for t in row.targets}
    assert set(masks) == {"sky", "car"} and np.array_equal(masks["sky"] > 0, [[False, True], [True, False]])
