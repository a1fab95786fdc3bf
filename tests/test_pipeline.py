"""All nine stages over a small dataset on disk, the command line, and the streams."""

import csv
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbiscope import cli, schema
from orbiscope.config import Config
from orbiscope.functions import png
from orbiscope.operators import tracking
from orbiscope.plans import backends
from orbiscope.plans.runner import Run
from orbiscope.streaming import state

H, W = 16, 32


def frame_image(i):
    y, x = np.mgrid[:H, :W]
    rgb = np.stack([40 + i + 0 * x, 4 * x, 8 * y], -1).astype(np.uint8)
    rgb[:5] = 240  # sky
    rgb[8:11, 14:18] = 100
    return rgb


def write_sequence(root, name, n=4, missing=(), corrupt=(), drop=None, order=None):
    folder = root / name
    (folder / "fixed").mkdir(parents=True)
    fields = ["", *schema.REQUIRED_FIELDS]
    if drop:
        fields.remove(drop)
    with (folder / "gps-fixed.csv").open("w", newline="") as f:
        out = csv.writer(f)
        out.writerow(fields)
        for row, i in enumerate(order or range(n)):
            stem = f"{name}-frame-{i:06d}"
            cells = dict(zip(schema.REQUIRED_FIELDS, [f"elsewhere/{stem}.png", str(i / 2), "39.0", "-84.0", "185.0", "1.0", "1.0", 'a "b", c'], strict=True))
            out.writerow([str(row + 7), *[cells[c] for c in fields[1:]]])
            if i not in missing:
                data = b"not an image" if i in corrupt else png.encode(frame_image(i))
                (folder / "fixed" / f"{stem}.png").write_bytes(data)


@pytest.fixture(scope="module")
def dataset(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    write_sequence(root, "GS000001", 4, order=[0, 2, 1, 3])
    write_sequence(root, "GS000002", 5, missing=(1,))
    write_sequence(root, "GS000003", 2)
    write_sequence(root, "GS000004", 4, drop="alt")
    (root / "GS000005").mkdir()
    (root / "other").mkdir()
    return root


@pytest.fixture(scope="module")
def config(dataset, tmp_path_factory):
    return Config(
        dataset_root=str(dataset),
        output_root=str(tmp_path_factory.mktemp("out")),
        cube_face_size=8,
        cube_overlap_px=2,
        sam2_min_mask_area_px=1,
        dyn_min_component_area_px=1,
        roof_min_component_area_px=1,
        dyn_dilate_px=0,
        roof_dilate_px=0,
        inpaint_window_size=3,
        inpaint_window_stride=1,
        propainter_chunk_size=2,
        propainter_face_feather_px=2,
        single_frame_min_mask_area_px=1,
        qa_sample_count=2,
        qa_diagnostic_panel_width_px=32,
    )


def rows_of(config, name):
    with open(f"{config.output_root}/{name}/manifests/frames.csv", newline="") as f:
        return list(csv.DictReader(f))


def summary_of(config, name):
    with open(f"{config.output_root}/{name}/manifests/sequence_summary.json") as f:
        return json.load(f)


READY = ["GS000001", "GS000002"]


@pytest.fixture(scope="module")
def indexed(spark, config):
    return Run(spark, config).run("index")


def test_index(indexed, config):
    sequences, _ = indexed
    status = {r.sequence_id: (r.status, r.failure_reason) for r in sequences.collect()}
    assert {k: v[0] for k, v in status.items()} == {
        "GS000001": "ready",
        "GS000002": "ready",
        "GS000003": "failed_insufficient_valid_frames",
        "GS000004": "failed_invalid_manifest",
        "GS000005": "failed_missing_manifest",
    }
    assert status["GS000003"][1] == "Only 2 valid frames remain after validation; minimum is 3"
    assert status["GS000004"][1] == "Missing required columns: alt" and status["GS000005"][1] == "Missing gps-fixed.csv"
    rows = rows_of(config, "GS000002")
    assert list(rows[0]) == list(schema.FRAMES)
    assert [r["valid_order_index"] for r in rows] == ["0", "", "1", "2", "3"]
    assert [r["file_exists"] for r in rows] == ["1", "0", "1", "1", "1"]
    assert rows[1]["skip_reason"] == "Referenced fixed frame is missing" and rows[0]["date"] == 'a "b", c'
    assert [r["frame_number"] for r in rows_of(config, "GS000001")] == ["0", "2", "1", "3"]
    assert rows[0]["source_index"] == "7" and rows[0]["qa_status"] == "pending"
    assert rows[0]["resolved_fixed_path"].endswith("/GS000002/fixed/GS000002-frame-000000.png")
    assert rows_of(config, "GS000005") == []
    summary = summary_of(config, "GS000002")
    assert summary["missing_frames"] == ["GS000002-frame-000001.png"] and summary["first_valid_frame"] == "GS000002-frame-000000.png"
    assert os.path.isdir(f"{config.output_root}/GS000005/qa/contact_sheets")


def test_sequence_subset(spark, config):
    sequences, frames = Run(spark, config, ["GS000002", "GS9"]).index()
    assert [r.sequence_id for r in sequences.collect()] == ["GS000002"] and frames.count() == 5


def test_normalize_isolates_bad_files(spark, tmp_path):
    write_sequence(tmp_path / "d", "GS000009", 4, corrupt=(2,))
    config = Config(dataset_root=str(tmp_path / "d"), output_root=str(tmp_path / "o"))
    sequences, frames = Run(spark, config).run("normalize-erp")
    got = [(r.erp_normalization_status, r.erp_width, r.erp_height) for r in frames.orderBy("frame_idx").collect()]
    assert [g[0] for g in got] == ["normalized", "normalized", "failed", "normalized"] and got[0][1:] == (W, H)
    assert sequences.first().status == "failed_erp_normalization"
    assert sequences.first().failure_reason == "1 frame(s) failed ERP normalization"
    import hashlib

    digest = hashlib.sha256((tmp_path / "d/GS000009/fixed/GS000009-frame-000000.png").read_bytes()).hexdigest()
    assert rows_of(config, "GS000009")[0]["erp_file_sha256"] == digest


class CountingVideo:
    model_id = "test/video"

    def inpaint_clip(self, face, frames, masks, config):
        return [np.full_like(f, 7) for f in frames]


class OutOfMemoryVideo(CountingVideo):
    def inpaint_clip(self, face, frames, masks, config):
        raise RuntimeError("CUDA out of memory")


class NineImage:
    model_id = "test/image"

    def inpaint_image(self, face, image, mask, config):
        return np.full_like(image, 9)


@pytest.fixture(scope="module")
def staged(spark, config, indexed):
    """All stages up to fusion, in order."""
    made = {}
    for stage in ("project-cubemap", "parse-semantic", "detect-dynamic", "refine-masks", "fuse-masks"):
        sequences, frames = Run(spark, config).run(stage)
        made[stage] = ({r.sequence_id: r.status for r in sequences.collect()}, {n: rows_of(config, n) for n in READY})
    return made


def test_projection(staged):
    status, rows = staged["project-cubemap"]
    assert status["GS000001"] == status["GS000002"] == "ready"
    assert {r["cubemap_projection_status"] for r in rows["GS000001"]} == {"projected"}
    assert [r["cubemap_projection_status"] for r in rows["GS000002"]][1] == "skipped_missing_source"
    assert rows["GS000001"][0]["cubemap_total_face_size"] == "12"


def test_semantic(staged):
    status, rows = staged["parse-semantic"]
    assert status["GS000001"] == "ready" and status["GS000002"] == "failed_semantic_parsing"  # a missing frame has no faces
    assert {r["semantic_parse_status"] for r in rows["GS000001"]} == {"parsed"}
    assert {r["semantic_has_confidence"] for r in rows["GS000001"]} == {"1"}


def test_detection(staged):
    _, rows = staged["detect-dynamic"]
    assert {r["grounding_detect_status"] for r in rows["GS000001"]} == {"detected"}
    assert all(int(r["grounding_box_count"]) > 0 for r in rows["GS000001"])


def test_refinement(staged, config):
    _, rows = staged["refine-masks"]
    first = rows["GS000001"]
    assert {r["sam2_refine_status"] for r in first} == {"refined"}
    assert all(int(r["sam2_mask_count"]) > 0 for r in first)
    assert int(first[1]["sam2_temporal_prior_count"]) > 0 and first[0]["sam2_temporal_prior_count"] == "0"
    assert {r["roof_mask_status"] for r in first} <= {"generated", "fallback"} and {r["sky_mask_status"] for r in first} == {"generated"}
    assert all(int(r["roof_mask_area_px"]) > 0 for r in first)
    with open(first[0]["sky_mask_path"], "rb") as f:
        assert png.decode(f.read()).shape == (H, W)


def test_fusion(staged):
    _, rows = staged["fuse-masks"]
    for r in rows["GS000001"]:
        assert r["mask_fusion_status"] == "fused"
        masks = {}
        for m in ("dynamic", "roof", "sky", "inpaint"):
            with open(r[f"{m}_mask_path"], "rb") as f:
                masks[m] = png.decode(f.read()) > 0
            assert int(r[f"{m}_mask_area_px"]) == masks[m].sum()
        assert (masks["inpaint"] == ((masks["dynamic"] | masks["roof"]) & ~masks["sky"])).all()
    assert rows["GS000002"][1]["mask_fusion_status"] == "failed"


def test_inpainting_changes_masked_pixels_only(spark, config, staged):
    sequences, _ = Run(spark, config, ["GS000001"]).run("inpaint-sequence", video=CountingVideo)
    assert sequences.first().status == "ready"
    for r in rows_of(config, "GS000001"):
        assert r["propainter_status"] == "inpainted" and r["propainter_window_count"] == "2" and r["lama_status"] == "pending"
        image = frame_image(int(r["frame_number"]))
        with open(r["rgb_output_path"], "rb") as f:
            final = png.decode(f.read())
        with open(r["rgba_output_path"], "rb") as f:
            rgba = png.decode(f.read())
        with open(r["inpaint_mask_path"], "rb") as f:
            mask = png.decode(f.read()) > 0
        with open(r["sky_mask_path"], "rb") as f:
            sky = png.decode(f.read())
        assert (final[~mask] == image[~mask]).all() and mask.any() and (final[mask] != image[mask]).any()
        assert (rgba[..., 3] == np.where(sky == 255, 0, 255)).all()
        face = f"{r['cubemap_cache_dir']}/propainter/front/{r['frame_stem']}"
        for suffix, shape in ((".with_overlap.png", (12, 12, 3)), (".png", (8, 8, 3)), (".mask.png", (12, 12))):
            with open(face + suffix, "rb") as f:
                assert png.decode(f.read()).shape == shape
    with open(f"{config.output_root}/GS000001/propainter/metadata.json") as f:
        plan = json.load(f)
    assert plan["model_id"] == "test/video" and [w["frame_indices"] for w in plan["windows"]] == [[0, 1, 2], [1, 2, 3]]
    assert [c["frame_indices"] for c in plan["chunks"]] == [[0, 1], [2], [1, 2], [3]]


def test_out_of_memory_falls_back(spark, config, staged):
    Run(spark, config, ["GS000001"]).run("inpaint-sequence", video=OutOfMemoryVideo, image=NineImage)
    for r in rows_of(config, "GS000001"):
        assert (r["propainter_status"], r["lama_status"]) == ("fallback_lama", "inpainted")
        assert r["single_frame_fallback_reason"] == "propainter_oom_all_retry_levels"
    sequences, _ = Run(spark, config, ["GS000001"]).run("inpaint-sequence", video=OutOfMemoryVideo)
    assert sequences.first().status == "failed_propainter_inpainting"


def test_forced_fallback(spark, config, staged):
    from dataclasses import replace

    forced = replace(config, force_single_frame_fallback=True)
    Run(spark, forced, ["GS000001"]).run("inpaint-sequence", video=CountingVideo, image=NineImage)
    assert {r["single_frame_fallback_reason"] for r in rows_of(config, "GS000001")} == {"force_single_frame_fallback"}


def test_quality(spark, config, staged):
    Run(spark, config, ["GS000001"]).run("inpaint-sequence", video=CountingVideo)
    sequences, frames = Run(spark, config).run("qa")
    status = {r.sequence_id: r.status for r in sequences.collect()}
    assert status["GS000001"] == "ready" and status["GS000002"] == "failed_qa"
    with open(f"{config.output_root}/GS000001/qa/metrics/frame_metrics.csv", newline="") as f:
        metrics = list(csv.DictReader(f))
    assert list(metrics[0]) == list(schema.METRIC_FIELDS) and [m["qa_status"] for m in metrics] == ["measured"] * 4
    for m, r in zip(metrics, rows_of(config, "GS000001"), strict=True):
        with open(r["sky_mask_path"], "rb") as f:
            assert m["sky_ratio"] == f"{(png.decode(f.read()) > 0).mean():.8f}"
    with open(f"{config.output_root}/GS000001/qa/metrics/sequence_metrics.json") as f:
        found = json.load(f)
    assert found["frames_processed"] == 4 and set(found["failure_counts_by_stage"]) == set(["erp_normalization", "cubemap_projection", "semantic_parse", "grounding_detect", "sam2_refine", "mask_fusion", "propainter", "lama", "qa"])
    assert len(os.listdir(f"{config.output_root}/GS000001/qa/overlays")) == 2
    assert rows_of(config, "GS000002")[1]["qa_status"] == "skipped"


def test_dry_run_writes_nothing(spark, dataset, tmp_path, capsys):
    out = tmp_path / "dry"
    code = cli.main(["index", "--dataset-root", str(dataset), "--output-root", str(out), "--dry-run"], spark)
    printed = json.loads(capsys.readouterr().out)
    assert code == 1 and printed["sequence_count"] == 5 and printed["ready_sequences"] == 2 and not out.exists()
    code = cli.main(["normalize-erp", "--dataset-root", str(dataset), "--output-root", str(out), "--dry-run", "--sequence", "GS000001", "--skip-checksum"], spark)
    printed = json.loads(capsys.readouterr().out)
    assert code == 0 and printed["normalized_frames"] == 4 and printed["compute_checksums"] is False


def test_inpainting_needs_a_command(capsys):
    assert cli.main(["inpaint-sequence", "--dataset-root", "/x", "--output-root", "/y"]) == 2
    assert "--propainter-command" in json.loads(capsys.readouterr().out)["error"]
    assert cli.main(["inpaint-sequence", "--dataset-root", "/x", "--output-root", "/y", "--propainter-command", "p", "--force-single-frame-fallback"]) == 2


def test_every_option_reaches_a_setting():
    from orbiscope import config as settings

    parser, defaults = cli.build_parser(), Config()
    for stage in settings.STAGES:
        taken = settings.options(stage)
        given = [stage]
        for s in taken:
            other = {str: "other", int: "17", float: "0.125"}.get(type(s.default), "q")
            given += [f"--{s.spelled}"] if s.flag else [f"--{s.spelled}", other]
        config = cli.config_of(parser.parse_args(given))
        plain = cli.config_of(parser.parse_args([stage]))
        for s in taken:
            if s.name.endswith("_root"):
                continue
            assert getattr(plain, s.name) == getattr(defaults, s.name) == s.default
            want = not s.default if s.flag else ("q",) if s.repeated else {str: "other", int: 17, float: 0.125}[type(s.default)]
            assert getattr(config, s.name) == want
    assert (defaults.cube_face_size, defaults.sam2_temporal_max_gap, defaults.grounding_nms_iou_threshold) == (1536, 1, 0.7)
    import pickle

    assert pickle.loads(pickle.dumps(defaults)) == defaults


def test_retry_ladder():
    assert backends.chunk_sizes(8) == [8, 4, 2, 1] and backends.chunk_sizes(0) == [1]
    calls = []

    class Flaky:
        model_id = "x"

        def inpaint_clip(self, face, frames, masks, config):
            calls.append(len(frames))
            if len(frames) > 1:
                raise RuntimeError("out of memory")
            return frames

    frames = [np.zeros((2, 2, 3), np.uint8)] * 3
    assert len(backends.inpaint_with_retries(Flaky(), "front", frames, frames, Config(propainter_chunk_size=4))) == 3
    assert calls == [3, 2, 1, 1, 1]
    with pytest.raises(ValueError, match="other"):

        class Broken(Flaky):
            def inpaint_clip(self, *a):
                raise ValueError("other")

        backends.inpaint_with_retries(Broken(), "front", frames, frames, Config())


def test_command_adapters(tmp_path):
    script = tmp_path / "copy.py"
    script.write_text("import shutil,sys,os\nfor n in os.listdir(sys.argv[1]): shutil.copy(os.path.join(sys.argv[1], n), sys.argv[2])\n")
    frames = [frame_image(i) for i in range(2)]
    masks = [np.zeros((H, W), np.uint8)] * 2
    video = backends.CommandVideo(f"python {script} {{frames_dir}} {{output_dir}}")
    assert all((a == b).all() for a, b in zip(video.inpaint_clip("front", frames, masks, Config()), frames, strict=True))
    image = backends.CommandImage("cp {image_path} {output_path}")
    assert (image.inpaint_image("front", frames[0], masks[0], Config()) == frames[0]).all()
    with pytest.raises(RuntimeError, match="exit code"):
        backends.CommandImage("false {image_path}").inpaint_image("front", frames[0], masks[0], Config())
    with pytest.raises(ValueError):
        backends.CommandVideo("")


def test_streams_agree_with_the_batch_fold(spark, tmp_path):
    rng = np.random.default_rng(0)
    kind = (
        "sequence_id string, frame_idx int, face string, prompt_idx int, class_text string, source string, x0 double, y0 double,"
        " x1 double, y1 double, score double"
    )
    rows = []
    for s in ("a", "b"):
        for f in range(12):
            for p in range(3):
                x, y = (float(v) for v in rng.integers(0, 6, 2))
                rows.append((s, f, "front", p, ["car", "sky"][p % 2], "grounding_box", x, y, x + 8, y + 8, 0.5))
    df = spark.createDataFrame(rows, kind)
    for i in range(3):  # frames arrive in order, four per micro-batch
        df.where(f"frame_idx DIV 4 = {i}").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        os.utime(tmp_path / "in")
    config = Config(sam2_temporal_max_gap=2)

    def run(stream, name):
        source = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
        q = stream(source, config).writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        return sorted(tuple(r) for r in spark.table(name).collect())

    assert run(state.stream_tracks, "tracks") == sorted(tuple(r) for r in tracking.assign_tracks(df, config).collect())
    assert run(state.stream_priors, "priors") == sorted(tuple(r) for r in tracking.attach_priors(df, config).collect())


def test_event_time_counts(spark, tmp_path):
    rows = spark.range(0, 20).select(
        F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.lit("s").alias("sequence_id"), (F.col("id") % 4 != 0).alias("file_exists")
    )
    rows.write.parquet(str(tmp_path / "e"))
    source = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    q = state.stream_status(source).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert spark.table("counts").agg(F.sum("valid_frames"), F.sum("skipped_frames")).first() == (15, 5)
