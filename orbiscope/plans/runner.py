"""Running stages over a folder of sequences: reading, gating, writing, summaries.

Stages hand on relations, which are kept as Parquet below
``<output_root>/_tables``; the files of the published layout (PNG, CSV, JSON) are
written beside them.  Each run indexes afresh and starts from pending statuses.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbiscope import sinks
from orbiscope.config import Config
from orbiscope.functions import kernels
from orbiscope.operators import geometry, quality, windows
from orbiscope.plans import backends, stages, vision
from orbiscope.schema import FRAMES, PENDING, REQUIRED_FIELDS
from orbiscope.sources import images, manifests

KEY = ["sequence_id", "frame_idx"]
# The status that a sequence takes when a stage fails on some of its frames, and what failed.
FAILURES = {
    "normalize-erp": ("erp_normalization_status", "failed_erp_normalization", "ERP normalization"),
    "project-cubemap": ("cubemap_projection_status", "failed_cubemap_projection", "cubemap projection"),
    "parse-semantic": ("semantic_parse_status", "failed_semantic_parsing", "semantic parsing"),
    "detect-dynamic": ("grounding_detect_status", "failed_grounding_detection", "Grounding DINO detection"),
    "refine-masks": ("sam2_refine_status", "failed_sam2_refinement", "SAM 2 refinement"),
    "fuse-masks": ("mask_fusion_status", "failed_mask_fusion", "mask fusion"),
    "inpaint-sequence": ("propainter_status", "failed_propainter_inpainting", "ProPainter inpainting"),
    "qa": ("qa_status", "failed_qa", "QA measurement"),
}


def default_of(name: str) -> Column:
    kind = FRAMES[name]
    if name in PENDING:
        return F.lit("pending")
    if kind == "string":
        return F.lit("" if not name.endswith(("_dir", "_path")) else None).cast("string")
    return F.lit(False) if kind == "boolean" else F.lit(None).cast(kind)


def complete(frames: DataFrame) -> DataFrame:
    """All manifest columns in order, with defaults for those that no stage has set."""
    have = set(frames.columns)
    cells = [F.coalesce(F.col(n).cast(k), default_of(n)).alias(n) if n in have else default_of(n).alias(n) for n, k in FRAMES.items()]
    return frames.select(*cells)


class Run:
    """One run of a stage over a dataset."""

    def __init__(self, spark: SparkSession, config: Config, sequences: Iterable[str] | None = None):
        self.spark, self.config, self.only = spark, config, list(sequences or [])
        self._held: list[DataFrame] = []

    def hold(self, df: DataFrame) -> DataFrame:
        """Keep a relation that a stage uses more than once, until ``release``."""
        self._held.append(df.persist())
        return df

    def release(self) -> None:
        """Let go of what the stages have kept; their results are computed again if they are used after that."""
        while self._held:
            self._held.pop().unpersist()

    # --- tables between runs ---

    def _table(self, name: str) -> str:
        return f"{self.config.output_root}/_tables/{name}"

    def save(self, name: str, df: DataFrame) -> None:
        """Keep a relation, one folder per sequence; a run replaces the sequences that it worked on."""
        if not self.config.dry_run:
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sequence_id").parquet(self._table(name))

    def load(self, name: str) -> DataFrame | None:
        if not manifests.list_paths(self.spark, f"{self._table(name)}/*"):
            return None
        df = self.spark.read.parquet(self._table(name))
        df = df.withColumn("sequence_id", F.col("sequence_id").cast("string"))
        return stages.subset(df, self.only)

    # --- index ---

    def index(self) -> tuple[DataFrame, DataFrame]:
        """(sequences with status, frames with all manifest columns and frame_idx)."""
        listed, rows = manifests.read_manifests(self.spark, self.config, self.only)
        frames = stages.index_frames(rows, manifests.existing_frames(self.spark, self.config), self.config)
        frames = complete(frames).withColumn("frame_idx", F.col("csv_row_number"))
        counted = stages.sequence_status(frames, self.config.min_valid_frames).withColumnRenamed("total_csv_rows", "_rows")
        missing = F.col("missing_fields")
        too_few = f"Only 0 valid frames remain after validation; minimum is {self.config.min_valid_frames}"
        status = (
            F.when(missing.isNull(), "failed_missing_manifest")
            .when(F.size(missing) > 0, "failed_invalid_manifest")
            .otherwise(F.coalesce("status", F.lit("failed_insufficient_valid_frames" if self.config.min_valid_frames > 0 else "ready")))
        )
        reason = (
            F.when(missing.isNull(), f"Missing {self.config.manifest_filename}")
            .when(F.size(missing) > 0, F.concat(F.lit("Missing required columns: "), F.array_join("missing_fields", ", ")))
            .when(F.col("status").isNull() & F.lit(self.config.min_valid_frames > 0), too_few)
            .otherwise(F.col("failure_reason"))
        )
        sequences = listed.join(counted, "sequence_id", "left").select(
            "sequence_id",
            F.concat_ws("/", F.lit(self.config.dataset_root), "sequence_id").alias("sequence_dir"),
            F.concat_ws("/", F.lit(self.config.dataset_root), "sequence_id", F.lit(self.config.manifest_filename)).alias("csv_path"),
            F.concat_ws("/", F.lit(self.config.output_root), "sequence_id").alias("output_dir"),
            status.alias("status"),
            reason.alias("failure_reason"),
            F.coalesce("_rows", "total_csv_rows").cast("long").alias("total_csv_rows"),
            F.coalesce("valid_frames", F.lit(0)).alias("valid_frames"),
            F.coalesce("skipped_frames", "total_csv_rows").cast("long").alias("skipped_frames"),
        )
        return sequences, frames

    def ready(self, sequences: DataFrame, frames: DataFrame) -> DataFrame:
        return frames.join(sequences.where("status = 'ready'").select("sequence_id"), "sequence_id", "left_semi")

    def merge(self, frames: DataFrame, result: DataFrame, columns: list[str]) -> DataFrame:
        """``frames`` with ``columns`` taken from ``result`` where it has the frame."""
        kept = result.select(*KEY, *[F.col(c).alias(f"_{c}") for c in columns])
        joined = frames.join(kept, KEY, "left")
        return joined.select(*[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in frames.columns])

    def finish(self, stage: str, sequences: DataFrame, frames: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Roll the stage's failures up and write manifests and summaries, unless this is a dry run."""
        if stage in FAILURES:
            rolled = quality.roll_up(self.ready(sequences, frames), *FAILURES[stage]).where("status <> 'ready'")
            rolled = rolled.select("sequence_id", F.col("status").alias("_s"), F.col("failure_reason").alias("_r"))
            sequences = sequences.join(rolled, "sequence_id", "left")
            sequences = sequences.withColumn("status", F.coalesce("_s", "status")).withColumn("failure_reason", F.coalesce("_r", "failure_reason"))
            sequences = sequences.drop("_s", "_r")
        if not self.config.dry_run:
            sinks.write_files(sinks.manifest_files(frames, self.config.output_root))
            sinks.write_files(sinks.empty_manifest_files(sequences.where("valid_frames + skipped_frames = 0 OR status = 'failed_invalid_manifest'"), self.config.output_root))
            sinks.write_files(sinks.summary_files(self.summaries(sequences, frames), self.config.output_root))
        return sequences, frames

    def summaries(self, sequences: DataFrame, frames: DataFrame) -> DataFrame:
        """One row per sequence with its counts and name lists."""
        c = F.col

        def named(condition: Column) -> Column:
            return quality.names_where(condition)

        shown = manifests.list_paths(self.spark, f"{self.config.output_root}/{self.config.sequence_glob}/qa/overlays/*")
        overlays = self.spark.createDataFrame([(p,) for p, _ in shown], "overlay_output_path string").withColumn("_shown", F.lit(True))
        marked = frames.join(overlays, "overlay_output_path", "left")
        failed = {
            "normalization_failed_frames": "erp_normalization_status",
            "projection_failed_frames": "cubemap_projection_status",
            "fusion_failed_frames": "mask_fusion_status",
            "propainter_failed_frames": "propainter_status",
            "lama_failed_frames": "lama_status",
            "semantic_failed_frames": "semantic_parse_status",
            "grounding_failed_frames": "grounding_detect_status",
            "sam2_failed_frames": "sam2_refine_status",
            "qa_failed_frames": "qa_status",
        }
        counted = {
            "normalized_frames": c("erp_normalization_status") == "normalized",
            "projected_frames": c("cubemap_projection_status") == "projected",
            "roof_mask_frames": c("roof_mask_status").isin("generated", "fallback", "fused"),
            "sky_mask_frames": c("sky_mask_status").isin("generated", "fused"),
            "dynamic_mask_frames": c("dynamic_mask_status") == "fused",
            "inpaint_mask_frames": c("inpaint_mask_status") == "fused",
            "propainter_frames": c("propainter_status") == "inpainted",
            "lama_frames": c("lama_status") == "inpainted",
            "parsed_frames": c("semantic_parse_status") == "parsed",
            "detected_frames": c("grounding_detect_status") == "detected",
            "refined_frames": c("sam2_refine_status") == "refined",
            "qa_measured_frames": c("qa_status") == "measured",
        }
        lists = {
            "missing_frames": ~c("file_exists"),
            "roof_fallback_frames": c("roof_mask_status") == "fallback",
            "roof_disagreement_frames": c("roof_mask_temporal_disagreement"),
            "sky_empty_frames": c("sky_mask_status") == "empty",
            "single_frame_fallback_frames": c("single_frame_fallback_reason") != "",
            "qa_overlay_frames": F.coalesce("_shown", F.lit(False)),
        } | {n: c(s) == "failed" for n, s in failed.items()}
        grouped = marked.groupBy("sequence_id").agg(
            *[F.count_if(x).alias(n) for n, x in counted.items()],
            *[named(x).alias(n) for n, x in lists.items()],
            *quality.first_and_last(c("file_exists")),
        )
        out = sequences.join(grouped, "sequence_id", "left")
        for n in counted:
            out = out.withColumn(n, F.coalesce(n, F.lit(0)))
        for n in lists:
            out = out.withColumn(n, F.coalesce(n, F.array().cast("array<string>")))
        return out.withColumn("required_csv_fields", F.array(*[F.lit(f) for f in REQUIRED_FIELDS]))

    # --- rasters ---

    def normalized(self, frames: DataFrame) -> DataFrame:
        """Existing frames with rgb, height, width and the columns of the normalization stage."""
        folders = [p for p, d in manifests.list_paths(self.spark, f"{self.config.dataset_root}/{self.config.sequence_glob}/fixed") if d]
        if not folders:
            empty = "path string, rgb binary, height int, width int, channels int, source_mode string, sha256 string, decode_error string"
            read = self.spark.createDataFrame([], empty)
        else:
            read = images.read_images(self.spark, folders, self.config.compute_checksums)
        drop = ["erp_normalization_status", "erp_normalization_error"]
        done = stages.normalize(frames.drop(*drop), read)
        ok = F.col("erp_normalization_status") == "normalized"
        return done.withColumns(
            {
                "erp_width": F.col("width"),
                "erp_height": F.col("height"),
                "erp_channels": F.col("channels"),
                "erp_dtype": F.when(ok, "uint8").otherwise(""),
                "erp_source_mode": F.when(ok, F.col("source_mode")).otherwise(""),
                "erp_file_sha256": F.when(ok, F.coalesce("sha256", F.lit(""))).otherwise(""),
                "erp_horizontal_wrap_mode": F.when(ok, "circular").otherwise(""),
            }
        )

    NORMAL_COLUMNS = [
        "erp_width", "erp_height", "erp_channels", "erp_dtype", "erp_source_mode", "erp_file_sha256", "erp_horizontal_wrap_mode",
        "erp_normalization_status", "erp_normalization_error",
    ]

    def geometry_columns(self, frames: DataFrame) -> DataFrame:
        c = self.config
        ok = F.col("cubemap_projection_status") == "projected"
        return frames.withColumns(
            {
                "cubemap_face_size": F.when(ok, F.lit(c.cube_face_size)),
                "cubemap_overlap_px": F.when(ok, F.lit(c.cube_overlap_px)),
                "cubemap_total_face_size": F.when(ok, F.lit(c.cube_face_size + 2 * c.cube_overlap_px)),
                "cubemap_face_cache_format": F.when(ok, "parquet").otherwise(""),
                "cubemap_faces_cached": ok & F.lit(c.cache_cubemap_faces and not c.dry_run),
                "cubemap_metadata_path": F.when(ok, F.lit(self._table("faces"))),
            }
        )

    PROJECTED_COLUMNS = [
        *NORMAL_COLUMNS, "cubemap_face_size", "cubemap_overlap_px", "cubemap_total_face_size", "cubemap_face_cache_format",
        "cubemap_faces_cached", "cubemap_metadata_path", "cubemap_projection_status", "cubemap_projection_error",
    ]

    def projected(self, frames: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(frames with normalization and projection columns, faces).

        Faces come from the cache where it has all six of a frame, with the
        geometry that it was made with; others are made from the image.
        """
        normal = self.normalized(frames.drop("cubemap_projection_status", "cubemap_projection_error"))
        status = self.geometry_columns(stages.projection_status(normal))
        made = stages.project(normal, self.config).select(*KEY, "face_ord", "face", "face_total", "face_rgb")
        cached = self.load("faces")
        if cached is not None:
            kept = cached.groupBy(*KEY).agg(F.count("*").alias("n")).where(f"n = {len(kernels.FACES)}").select(*KEY)
            made = made.join(kept, KEY, "left_anti").unionByName(cached.join(kept, KEY, "left_semi").select(*made.columns))
        return status, made

    # --- stages ---

    def run(self, stage: str, **models: Callable) -> tuple[DataFrame, DataFrame]:
        """Run a stage by its command name; ``models`` are factories of the models it needs."""
        sequences, frames = self.index()
        if not self.config.dry_run:
            self.make_folders(sequences)
        work = self.ready(sequences, frames)
        if stage == "index":
            return self.finish(stage, sequences, frames)
        result, columns = getattr(self, "_" + stage.replace("-", "_"))(work, **models)
        return self.finish(stage, sequences, self.merge(frames, result, columns))

    def make_folders(self, sequences: DataFrame) -> None:
        root = self.config.output_root

        def make(rows):
            for row in rows:
                where, base = sinks.open_folder(f"{root}/{row.sequence_id}")
                for f in sinks.OUTPUT_FOLDERS:
                    where.create_dir(f"{base}/{f}", recursive=True)

        sequences.select("sequence_id").foreachPartition(make)

    def _normalize_erp(self, work: DataFrame):
        return self.normalized(work), self.NORMAL_COLUMNS

    def _project_cubemap(self, work: DataFrame):
        status, faces = self.projected(work)
        if self.config.cache_cubemap_faces:
            self.save("faces", faces)
        return status, self.PROJECTED_COLUMNS

    def _without_faces(self, status: DataFrame, status_col: str, error_col: str) -> DataFrame:
        """Frames that could not be projected fail in a stage that needs their faces."""
        lost = F.col("cubemap_projection_status") != "projected"
        return status.withColumn(status_col, F.when(lost, "failed").otherwise(F.col(status_col))).withColumn(
            error_col, F.when(lost, F.col("cubemap_projection_error")).otherwise(F.col(error_col))
        )

    def _parse_semantic(self, work: DataFrame, parser=backends.BandParser):
        status, faces = self.projected(work)
        model = parser()
        targets = vision.resolve_target_ids(model.id2label)
        parsed = vision.parse_semantic(faces, parser, targets)
        self.save("semantic_masks", vision.semantic_masks(parsed))
        wide = parsed.select(
            *KEY, "face", "face_total", "labels", *(["confidence"] if self.config.semantic_save_confidence else []),
            *(["scores"] if self.config.semantic_save_logits else []), "segments",
        )
        self.save("semantic_faces", wide)
        of_frame = vision.semantic_status(parsed)
        new = ["semantic_parse_status", "semantic_parse_error", "semantic_has_panoptic", "semantic_has_confidence", "semantic_has_logits"]
        joined = status.drop(*new).join(of_frame, KEY, "left")
        joined = self._without_faces(joined, "semantic_parse_status", "semantic_parse_error")
        joined = joined.withColumn("semantic_model_id", F.lit(model.model_id)).withColumn("semantic_output_dir", F.lit(self._table("semantic_faces")))
        return joined, [*self.PROJECTED_COLUMNS, *new, "semantic_model_id", "semantic_output_dir"]

    def _detect_dynamic(self, work: DataFrame, detector=backends.BoxDetector):
        status, faces = self.projected(work)
        kept, of_face = vision.detect(faces, detector, self.config)
        self.save("detections", kept)
        self.save("detection_counts", of_face.select(*KEY, "face", "raw_count", "kept_count"))
        failed = F.col("grounding_detect_status") == "failed"
        of_frame = of_face.groupBy(*KEY).agg(
            F.sum("kept_count").cast("int").alias("grounding_box_count"),
            F.when(F.bool_or(failed), "failed").otherwise("detected").alias("grounding_detect_status"),
            F.coalesce(F.min_by("grounding_detect_error", F.when(failed, F.col("face_ord"))), F.lit("")).alias("grounding_detect_error"),
        )
        new = ["grounding_box_count", "grounding_detect_status", "grounding_detect_error"]
        joined = self._without_faces(status.drop(*new).join(of_frame, KEY, "left"), "grounding_detect_status", "grounding_detect_error")
        joined = joined.withColumn("grounding_model_id", F.lit(detector().model_id)).withColumn("grounding_output_dir", F.lit(self._table("detections")))
        return joined, [*self.PROJECTED_COLUMNS, *new, "grounding_model_id", "grounding_output_dir"]

    def _or_empty(self, name: str, schema: str) -> DataFrame:
        found = self.load(name)
        return self.spark.createDataFrame([], schema) if found is None else found

    SEMANTIC = "sequence_id string, frame_idx int, face string, height int, width int, class_idx int, class_id int, class_name string, mask binary"
    BOXES = "sequence_id string, frame_idx int, face string, det_idx int, x0 double, y0 double, x1 double, y1 double, score double, text string, text_normalized string"
    REFINED = (
        "sequence_id string, frame_idx int, face string, height int, width int, class_text string, source string, mask binary"
    )

    def _refine_masks(self, work: DataFrame, refiner=backends.BoxRefiner):
        c = self.config
        status, faces = self.projected(work)
        semantic = self._or_empty("semantic_masks", self.SEMANTIC)
        asked = vision.prompts(faces, self._or_empty("detections", self.BOXES), semantic, c)
        if hasattr(refiner(), "open_sequence"):
            refined = self.hold(vision.refine_sequences(faces, asked, refiner, c, self.hold))
        else:
            refined = self.hold(vision.refine(faces, asked, refiner, c))
        self.save("masks", vision.refined_masks(refined))
        sized = status.where("cubemap_projection_status = 'projected'")
        new = ["sam2_mask_count", "sam2_temporal_prior_count", "sam2_refine_status", "sam2_refine_error"]
        joined = self._without_faces(status.drop(*new).join(vision.refine_status(refined), KEY, "left"), "sam2_refine_status", "sam2_refine_error")
        joined = joined.withColumn("sam2_model_id", F.lit(refiner().model_id)).withColumn("sam2_output_dir", F.lit(self._table("masks")))
        columns = [*self.PROJECTED_COLUMNS, *new, "sam2_model_id", "sam2_output_dir"]
        roof_columns = [f"roof_mask_{n}" for n in ("status", "source", "area_px", "temporal_disagreement", "error")]
        if c.sam2_refine_roof:
            roof = vision.roof_masks(refined, sized, c)
            joined = joined.drop(*roof_columns).join(roof.select(*KEY, *roof_columns, "roof"), KEY, "left")
            lost = F.col("roof_mask_status").isNull()
            joined = joined.withColumn("roof_mask_error", F.when(lost, "Missing down-face cubemap projection").otherwise(F.col("roof_mask_error")))
            joined = joined.withColumn("roof_mask_status", F.when(lost, "failed").otherwise(F.col("roof_mask_status")))
        else:
            joined = joined.withColumn("roof_mask_status", F.lit("skipped")).withColumn("roof", F.lit(None).cast("binary"))
        sky_columns = [f"sky_mask_{n}" for n in ("status", "source", "area_px", "error")]
        sky = vision.sky_masks(refined, semantic, sized, c)
        joined = joined.drop(*sky_columns).join(sky.select(*KEY, *sky_columns, "sky"), KEY, "left")
        joined = joined.withColumn("sky_mask_status", F.coalesce("sky_mask_status", F.lit("empty")))
        joined = joined.withColumn("sky_mask_error", F.coalesce("sky_mask_error", F.lit("No usable Mask2Former sky prediction")))
        if not c.dry_run:
            shaped = joined.withColumn("height", F.col("erp_height")).withColumn("width", F.col("erp_width")).persist()
            for kind in ("roof", "sky"):
                sinks.write_files(sinks.mask_files(shaped, f"{kind}_mask_path", kind))
                there = shaped.where(F.col(kind).isNotNull())
                sidecar = F.struct(
                    "frame_name",
                    F.col(f"{kind}_mask_source").alias("source"),
                    F.col(f"{kind}_mask_error").alias("error"),
                    F.array("erp_height", "erp_width").alias("erp_shape"),
                    F.col(f"{kind}_mask_area_px").alias("area_px"),
                )
                path = F.regexp_replace(f"{kind}_mask_path", r"\.png$", ".json")
                sinks.write_files(sinks.json_files(there, path, sidecar))
            shaped.unpersist()
        return joined.drop("roof", "sky"), [*columns, *roof_columns, *sky_columns]

    def _with_masks(self, frames: DataFrame, kinds: Iterable[str]) -> DataFrame:
        """``frames`` with masks read from their PNG paths, null where a file is missing or has another shape."""
        out = frames
        for kind in kinds:
            folder = f"{self.config.output_root}/{self.config.sequence_glob}/masks/{kind}"
            files = [p for p, d in manifests.list_paths(self.spark, f"{folder}/*.png") if not d]
            if not files:
                out = out.withColumn(kind, F.lit(None).cast("binary"))
                continue
            read = images.read_masks(self.spark, [f"{folder}/*.png"]).select(
                F.col("path").alias(f"{kind}_mask_path"), F.col("mask").alias(kind), F.col("height").alias("_h"), F.col("width").alias("_w")
            )
            out = out.join(read, f"{kind}_mask_path", "left")
            out = out.withColumn(kind, images.matching_mask(F.col(kind), F.col("_h"), F.col("_w"), F.col("erp_height"), F.col("erp_width")))
            out = out.drop("_h", "_w")
        return out

    def _fuse_masks(self, work: DataFrame):
        c = self.config
        status, _ = self.projected(work)
        good = status.where("cubemap_projection_status = 'projected'").drop("rgb", "height", "width")
        dynamic = vision.dynamic_masks(self._or_empty("semantic_masks", self.SEMANTIC), self._or_empty("masks", self.REFINED), good, c)
        read = self._with_masks(good, ("roof", "sky")).join(dynamic.select(*KEY, "dynamic"), KEY)
        zero = F.unhex(F.repeat(F.lit("00"), F.col("erp_height") * F.col("erp_width")))
        warned = F.array_compact(
            F.array(*[F.when(F.col(k).isNull(), F.lit(f"missing {k}_refined mask")) for k in ("roof", "sky")])
        )
        raw = read.withColumn("_warnings", F.array_join(warned, "; "))
        for k in ("roof", "sky"):
            raw = raw.withColumn(k, F.coalesce(k, zero))
        raw = raw.withColumn("height", F.col("erp_height")).withColumn("width", F.col("erp_width")).drop(
            *[f"{m}_mask_area_px" for m in ("dynamic", "roof", "sky", "inpaint")], "mask_fusion_status", "mask_fusion_error"
        )
        fused = self.hold(stages.fuse_masks(raw, c))
        if not c.dry_run:
            for m in ("dynamic", "roof", "sky", "inpaint"):
                sinks.write_files(sinks.mask_files(fused, f"{m}_mask_path", m))
                path = F.regexp_replace(f"{m}_mask_path", r"\.png$", ".json")
                sinks.write_files(
                    sinks.json_files(fused, path, F.struct("frame_name", F.lit(FUSED_SOURCES[m]).alias("source"), F.col(f"{m}_area_px").alias("area_px"), F.col("_warnings").alias("warnings")))
                )
            sinks.write_files(sinks.union_debug_files(fused))
        done = fused.select(
            *KEY,
            *[F.lit("fused").alias(f"{m}_mask_status") for m in ("dynamic", "roof", "sky", "inpaint")],
            *[F.col(f"{m}_area_px").cast("int").alias(f"{m}_mask_area_px") for m in ("dynamic", "roof", "sky", "inpaint")],
            F.lit("parser_dynamic_or_grounding_sam2").alias("dynamic_mask_source"),
            F.lit(FUSED_SOURCES["roof"]).alias("roof_mask_source"),
            F.lit(FUSED_SOURCES["sky"]).alias("sky_mask_source"),
            F.col("_warnings").alias("dynamic_mask_error"),
            *[F.when(F.contains("_warnings", F.lit(f"missing {k}_refined")), F.col("_warnings")).otherwise("").alias(f"{k}_mask_error") for k in ("roof", "sky")],
            F.col("mask_fusion_status"),
            F.col("_warnings").alias("mask_fusion_error"),
        )
        new = [n for n in done.columns if n not in KEY]
        joined = status.drop(*new).join(done, KEY, "left")
        error = F.col("cubemap_projection_error")
        for s, e in (("mask_fusion_status", "mask_fusion_error"), ("dynamic_mask_status", "dynamic_mask_error")):
            joined = joined.withColumn(e, F.when(F.col(s).isNull(), error).otherwise(F.col(e))).withColumn(s, F.coalesce(s, F.lit("failed")))
        joined = joined.withColumn("inpaint_mask_error", F.when(F.col("inpaint_mask_status").isNull(), error).otherwise(""))
        joined = joined.withColumn("inpaint_mask_status", F.coalesce("inpaint_mask_status", F.lit("failed")))
        return joined, [*self.PROJECTED_COLUMNS, *new, "inpaint_mask_error"]

    def _inpaint_sequence(self, work: DataFrame, video=None, image=None):
        c = self.config
        video, image = video or backends.video_factory(c), image or backends.image_factory(c)
        normal = self.normalized(work.where("file_exists"))
        masked = self._with_masks(normal, ("dynamic", "roof", "sky", "inpaint"))
        loaded = masked.where("rgb IS NOT NULL AND dynamic IS NOT NULL AND roof IS NOT NULL AND sky IS NOT NULL AND inpaint IS NOT NULL")
        new = ["propainter_status", "propainter_error", "propainter_window_count", "lama_status", "lama_error", "single_frame_fallback_reason"]
        columns = ["height", "width", "rgb", "inpaint", "sky", "rgb_output_path", "rgba_output_path", "cubemap_cache_dir", "frame_stem"]
        startup = "" if video is not None else "propainter_startup_failure"
        done = self.hold(vision.inpaint(loaded.select(*KEY, *columns), c, video, image, startup))
        if not c.dry_run:
            sinks.write_files(sinks.final_files(done))
            self._write_inpainting(done, loaded, video, image)
        lost = F.when(F.col("rgb").isNull(), F.coalesce("erp_normalization_error", F.lit("cannot read file"))).otherwise("missing or mismatched final ERP mask")
        joined = masked.drop(*new).withColumn("_lost", lost).join(done.select(*KEY, *new), KEY, "left")
        joined = joined.withColumn("propainter_error", F.coalesce("propainter_error", "_lost")).withColumn(
            "propainter_status", F.coalesce("propainter_status", F.lit("failed"))
        )
        used = F.col("propainter_status") == "fallback_lama"
        folder = F.col("cubemap_cache_dir")
        joined = joined.withColumn("propainter_model_id", F.lit(video().model_id if video else c.propainter_model_id))
        joined = joined.withColumn("lama_model_id", F.when(F.col("lama_status") != "pending", F.lit(image().model_id if image else c.lama_model_id)).otherwise(""))
        joined = joined.withColumn("propainter_output_dir", F.when(F.col("propainter_status") == "inpainted", F.concat(folder, F.lit("/propainter"))))
        joined = joined.withColumn("lama_output_dir", F.when(used, F.concat(folder, F.lit("/lama_fallback"))))
        return joined.drop("_lost"), [*self.NORMAL_COLUMNS, *new, "propainter_model_id", "lama_model_id", "propainter_output_dir", "lama_output_dir"]

    def _write_inpainting(self, done: DataFrame, loaded: DataFrame, video, image) -> None:
        """Inpainted faces, and each sequence's windows and chunks."""
        c = self.config
        total = c.cube_face_size + 2 * c.cube_overlap_px
        each = done.withColumn("f", F.explode("final_faces")).select(
            *KEY, "height", "width", F.col("inpaint").alias("mask"), "cubemap_cache_dir", "frame_stem", "propainter_status",
            F.col("f.face").alias("face"), F.col("f.final_face").alias("final_face"), F.lit(total).alias("face_total"),
        )
        faces = geometry.mask_to_face(each, c.cube_face_size, c.cube_overlap_px)
        for status, folder in (("inpainted", "propainter"), ("fallback_lama", "lama_fallback")):
            sinks.write_files(sinks.face_files(faces.where(F.col("propainter_status") == status), folder, c.cube_overlap_px))
        planned = windows.plan_for_frames(loaded.withColumn("csv_row_number", F.col("frame_idx")), c.inpaint_window_size, c.inpaint_window_stride)
        chunk = windows.chunks(planned, c.propainter_chunk_size)
        place = chunk.join(planned.select("sequence_id", "window_index", "start", "frame_indices"), ["sequence_id", "window_index"])
        frame = F.get("frame_indices", F.col("position") - F.col("start"))
        chunks = place.groupBy("sequence_id", "window_index", "chunk_index").agg(F.array_sort(F.collect_list(frame)).alias("frame_indices"))
        listed = planned.groupBy("sequence_id").agg(
            F.array_sort(F.collect_list(F.struct("window_index", "start", "end", "frame_indices"))).alias("windows")
        )
        cut = chunks.groupBy("sequence_id").agg(
            F.array_sort(F.collect_list(F.struct("window_index", "chunk_index", "frame_indices"))).alias("chunks")
        )
        reason = done.groupBy("sequence_id").agg(F.max("single_frame_fallback_reason").alias("fallback_reason"))
        used_image = F.col("fallback_reason") != ""
        model = F.when(used_image, F.lit(image().model_id if image else c.lama_model_id)).otherwise(video().model_id if video else c.propainter_model_id)
        payload = F.struct(
            model.alias("model_id"),
            "fallback_reason",
            F.array(*[F.lit(f) for f in kernels.FACES]).alias("face_order"),
            F.lit(c.inpaint_window_size).alias("window_size"),
            F.lit(c.inpaint_window_stride).alias("window_stride"),
            F.lit(c.propainter_chunk_size).alias("chunk_size"),
            F.lit(c.propainter_face_feather_px).alias("face_feather_px"),
            "windows",
            "chunks",
        )
        folder = F.when(used_image, "lama_fallback").otherwise("propainter")
        path = F.concat(F.lit(f"{c.output_root}/"), "sequence_id", F.lit("/"), folder, F.lit("/metadata.json"))
        sinks.write_files(sinks.json_files(listed.join(cut, "sequence_id").join(reason, "sequence_id"), path, payload))

    def _qa(self, work: DataFrame):
        c = self.config
        out = work
        kinds = {"final_rgb": ("rgb", "rgb_output_path", 3), "final_rgba": ("rgba", "rgba_output_path", 4)} | {
            m: (f"masks/{m}", f"{m}_mask_path", 1) for m in ("dynamic", "roof", "sky", "inpaint")
        }
        for name, (folder, path, channels) in kinds.items():
            pattern = f"{c.output_root}/{c.sequence_glob}/{folder}/*.png"
            if manifests.list_paths(self.spark, pattern):
                files = self.spark.read.format("binaryFile").load(pattern).select(images.plain_path(F.col("path")).alias("path"), "content")
                read = images.read_png(files, channels).select(
                    F.col("path").alias(path), F.col("raster").alias(name), F.col("height").alias(f"{name}_height"), F.col("width").alias(f"{name}_width")
                )
                out = out.join(read, path, "left")
            else:
                none = F.lit(None)
                out = out.withColumns({name: none.cast("binary"), f"{name}_height": none.cast("int"), f"{name}_width": none.cast("int")})
        source = self.normalized(work).select(
            *KEY, F.col("rgb").alias("original"), F.col("height").alias("original_height"), F.col("width").alias("original_width")
        )
        out = out.join(source, KEY, "left")
        found = manifests.list_paths(self.spark, f"{c.output_root}/{c.sequence_glob}/cubemap/*/*")
        listing = []
        if found:
            names = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.png")
            listing = names.load([p for p, d in found if d] or [found[0][0]]).select(images.plain_path(F.col("path")).alias("path"))
        for name, sub in (("has_lama", "lama_fallback"), ("has_propainter", "propainter")):
            out = out.withColumn("_folder", F.concat("cubemap_cache_dir", F.lit(f"/{sub}")))
            out = images.has_artifacts(out, listing, "_folder", name) if found else out.withColumn(name, F.lit(False))
            out = out.drop("_folder")
        measured = self.hold(stages.measure_frames(out))
        columns = [n for n in FRAMES if n.startswith("qa_")] + [
            "erp_width", "erp_height", "erp_channels", "propainter_output_dir", "lama_output_dir", "lama_status", "propainter_status",
        ]
        if not c.dry_run:
            sinks.write_files(sinks.metric_files(measured, c.output_root))
            metrics = quality.sequence_metrics(measured).withColumn("generated_at_utc", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))
            path = F.concat(F.lit(f"{c.output_root}/"), "sequence_id", F.lit("/qa/metrics/sequence_metrics.json"))
            sinks.write_files(sinks.json_files(metrics, path, F.struct(*metrics.columns)))
            there = windows.valid_positions(measured, "frame_idx")
            count = there.groupBy("sequence_id").agg(F.count("*").alias("n"))
            sampled = count.select("sequence_id", F.explode(windows.sampled_positions(F.col("n"), c.qa_sample_count)).alias("position"))
            shown = there.join(sampled, ["sequence_id", "position"], "left_semi").where("qa_status = 'measured'")
            shown = shown.withColumn("height", F.col("final_rgb_height")).withColumn("width", F.col("final_rgb_width"))
            sinks.write_files(sinks.panel_files(shown, c.qa_diagnostic_panel_width_px))
        return measured, columns


# What the fused masks were made from.
FUSED_SOURCES = {
    "dynamic": "temporal_consistency(dilate(DYN_COARSE OR DYN_OVD))",
    "roof": "temporal_consistency(roof_refined)",
    "sky": "seam_smooth(sky_refined)",
    "inpaint": "(DYN OR ROOF) AND NOT SKY",
}
# Frame counts that a command reports, by the status they count.
TOTALS = {
    "normalize-erp": {"normalized_frames": ("erp_normalization_status", "normalized")},
    "project-cubemap": {"projected_frames": ("cubemap_projection_status", "projected")},
    "parse-semantic": {"parsed_frames": ("semantic_parse_status", "parsed")},
    "detect-dynamic": {"detected_frames": ("grounding_detect_status", "detected")},
    "refine-masks": {"refined_frames": ("sam2_refine_status", "refined")},
    "fuse-masks": {"fused_frames": ("mask_fusion_status", "fused")},
    "inpaint-sequence": {"inpainted_frames": ("propainter_status", "inpainted"), "lama_frames": ("lama_status", "inpainted")},
    "qa": {"measured_frames": ("qa_status", "measured")},
}


def report(run: Run, stage: str, sequences: DataFrame, frames: DataFrame) -> dict:
    """What a command prints: settings, totals over all sequences, and each sequence's summary."""
    import json

    failed = {"failed_frames": (FAILURES[stage][0], "failed")} if stage in FAILURES else {}
    totals = quality.status_counts(TOTALS.get(stage, {}) | failed)
    sums = frames.agg(*totals).first().asDict() if totals else {}
    texts = run.summaries(sequences, frames).orderBy("sequence_id").select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j"))
    listed = [json.loads(r.j) for r in texts.toLocalIterator()]  # one row per sequence
    ready = sum(s["status"] == "ready" for s in listed)
    settings = {k: v for k, v in asdict(run.config).items() if k in ("dataset_root", "output_root", "dry_run", "compute_checksums")}
    return settings | {"sequence_count": len(listed), "ready_sequences": ready, "failed_sequences": len(listed) - ready, "sequences": listed} | sums
