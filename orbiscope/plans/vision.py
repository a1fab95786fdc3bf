"""Stages that run models: semantic parsing, detection, refinement and inpainting.

Each is map-side over faces, or an ordered fold per sequence and face; a model's
error becomes a status and an error text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbiscope.config import DYNAMIC_CLASSES, SKY_BLOCKERS, SKY_FACES, TARGET_ALIASES, Config
from orbiscope.functions import exprs, kernels
from orbiscope.operators import detections, geometry, rasters, windows
from orbiscope.operators.tracking import MaskMemory, Tracker, box_of, ordered_fold
from orbiscope.plans import backends

FRAME = ["sequence_id", "frame_idx"]
FACE = [*FRAME, "face"]


def _once(factory: Callable):
    """The model of this Python worker, built on first use."""
    made: list = []

    def get():
        if not made:
            made.append(factory())
        return made[0]

    return get


# --- semantic --------------------------------------------------------------------------------------------------------


def parse_semantic(faces: DataFrame, factory: Callable[[], backends.SemanticParser], target_ids: dict[str, int | None]) -> DataFrame:
    """One row per face: label map, confidence, flags, and one mask per resolved target class."""
    wanted = [(i, n, c) for i, (n, c) in enumerate((n, c) for n, c in target_ids.items() if c is not None)]
    get = _once(factory)

    def one(face, data, total):
        try:
            p = get().parse_face(face, np.frombuffer(data, np.uint8).reshape(total, total, 3))
            masks = [
                {"class_idx": i, "class_id": c, "class_name": n, "mask": kernels.as_mask(p.labels == c).tobytes()} for i, n, c in wanted
            ]
            segments = [{"id": int(s["id"]), "label_id": int(s["label_id"]), "score": float(s.get("score", 0))} for s in p.segments]
            flags = (p.panoptic is not None, p.confidence is not None, p.scores is not None)
            confidence = None if p.confidence is None else p.confidence.astype("<f4").tobytes()
            scores = None if p.scores is None else p.scores.astype("<f2").tobytes()
            return p.labels.astype("<i4").tobytes(), confidence, scores, masks, segments, *flags, "parsed", ""
        except Exception as error:  # noqa: BLE001
            return None, None, None, [], [], False, False, False, "failed", str(error)

    outputs = (
        "labels binary, confidence binary, scores binary, targets array<struct<class_idx:int,class_id:int,class_name:string,mask:binary>>,"
        " segments array<struct<id:int,label_id:int,score:double>>, has_panoptic boolean, has_confidence boolean,"
        " has_logits boolean, semantic_parse_status string, semantic_parse_error string"
    )
    return rasters.with_kernel(faces, one, ["face", "face_rgb", "face_total"], outputs).drop("face_rgb")


def resolve_target_ids(id2label: dict[int, str]) -> dict[str, int | None]:
    """The class id of every target: the first alias that the model has."""
    import re

    known = {re.sub("[^a-z0-9]+", " ", name.lower()).strip(): i for i, name in sorted(id2label.items())}
    return {t: next((known[a] for a in aliases if a in known), None) for t, aliases in TARGET_ALIASES.items()}


def semantic_masks(parsed: DataFrame) -> DataFrame:
    """One row per face and target class."""
    size = F.col("face_total")
    each = parsed.select(*FACE, size.alias("height"), size.alias("width"), F.explode("targets").alias("t"))
    return each.select(*FACE, "height", "width", "t.*")


def semantic_status(parsed: DataFrame) -> DataFrame:
    """Per frame: failed where any face failed, with the first face's error; flags from any face."""
    failed = F.col("semantic_parse_status") == "failed"
    return parsed.groupBy(*FRAME).agg(
        F.when(F.bool_or(failed), "failed").otherwise("parsed").alias("semantic_parse_status"),
        F.coalesce(F.min_by("semantic_parse_error", F.when(failed, F.col("face_ord"))), F.lit("")).alias("semantic_parse_error"),
        *[F.bool_or(c).alias(f"semantic_{c}") for c in ("has_panoptic", "has_confidence", "has_logits")],
    )


# --- detection -------------------------------------------------------------------------------------------------------


def detect(faces: DataFrame, factory: Callable[[], backends.Detector], config: Config) -> tuple[DataFrame, DataFrame]:
    """(boxes kept, status per face with raw and kept counts).

    The model only proposes; threshold and suppression are plan operators.
    """
    get = _once(factory)

    def one(face, data, total):
        try:
            found = get().detect_face(face, np.frombuffer(data, np.uint8).reshape(total, total, 3))
            boxes = [dict(zip(("x0", "y0", "x1", "y1"), map(float, b), strict=True), score=float(s), text=t) for b, s, t in found]
            return boxes, "detected", ""
        except Exception as error:  # noqa: BLE001
            return [], "failed", str(error)

    box = "x0:double,y0:double,x1:double,y1:double,score:double,text:string"
    outputs = f"boxes array<struct<{box}>>, grounding_detect_status string, grounding_detect_error string"
    made = rasters.with_kernel(faces, one, ["face", "face_rgb", "face_total"], outputs).drop("face_rgb")
    flat = made.select(*FACE, F.posexplode("boxes").alias("raw_idx", "b")).select(*FACE, "raw_idx", "b.*")
    labelled = detections.above(flat, config.grounding_box_threshold).withColumn("text_normalized", exprs.detection_label(F.col("text")))
    ties = ["raw_idx", "x0", "y0", "x1", "y1", "text"]
    kept = detections.suppress(labelled, FACE, "text_normalized", config.grounding_nms_iou_threshold, ties)
    kept = kept.withColumn("det_idx", (F.col("rank") - 1).cast("int")).drop("rank", "raw_idx")
    counted = kept.groupBy(*FACE).agg(F.count("*").alias("kept_count"))
    status = made.select(*FACE, "face_ord", F.size("boxes").alias("raw_count"), "grounding_detect_status", "grounding_detect_error")
    return kept, status.join(counted, FACE, "left").withColumn("kept_count", F.coalesce("kept_count", F.lit(0)))


# --- refinement ------------------------------------------------------------------------------------------------------


def prompts(faces: DataFrame, kept: DataFrame, semantic: DataFrame, config: Config) -> DataFrame:
    """Prompts of every face in order: detections, semantic regions, then the roof on the lower face."""
    size = faces.select(*FACE, F.col("face_total").alias("size"))
    parts = []
    if config.sam2_refine_grounding:
        box = exprs.clip_box(*[F.col(c).cast("double") for c in detections.BOX], F.col("size"), F.col("size"))
        label = exprs.class_label(F.col("text"))
        found = kept.join(size, FACE).withColumn("b", box)
        parts.append(
            found.select(
                *FACE,
                F.lit(0).alias("kind"),
                F.col("det_idx").alias("place"),
                F.concat_ws(":", "face", F.lit("grounding"), "det_idx", label).alias("prompt_id"),
                label.alias("class_text"),
                F.lit("grounding_box").alias("source"),
                "b.*",
                F.col("score").cast("double").alias("score"),
                F.lit(None).cast("binary").alias("prior_mask"),
            )
        )
    if config.sam2_refine_semantic:
        wanted = [c for c in config.sam2_semantic_prompt_classes]

        def region(mask, height, width):
            m = rasters.view(mask, height, width)
            box = kernels.bounding_box(m)
            return (int(np.count_nonzero(m)), *([None] * 4 if box is None else map(float, box)))

        label = exprs.class_label(F.col("class_name"))
        measured = rasters.with_kernel(
            semantic.where(label.isin(wanted)), region, ["mask", "height", "width"], "area long, x0 double, y0 double, x1 double, y1 double"
        )
        parts.append(
            measured.where(F.col("area") >= max(1, config.sam2_min_mask_area_px)).select(
                *FACE,
                F.lit(1).alias("kind"),
                F.col("class_idx").alias("place"),
                F.concat_ws(":", "face", F.lit("semantic"), "class_idx", label).alias("prompt_id"),
                label.alias("class_text"),
                F.lit("semantic_region").alias("source"),
                *detections.BOX,
                F.lit(1.0).alias("score"),
                F.lit(None).cast("binary").alias("prior_mask"),
            )
        )
    if config.sam2_refine_roof:
        wide = kernels.roof_fraction(config.sam2_roof_box_fraction, config.sam2_roof_prior_margin_fraction, True)
        core = kernels.roof_fraction(config.sam2_roof_box_fraction, config.sam2_roof_prior_margin_fraction, False)

        def prior(n):
            return (kernels.roof_ellipse(n, n, core).tobytes(),)

        half = F.col("size") * wide * 0.5
        low, high = F.greatest(F.lit(0.0), F.col("size") * 0.5 - half), F.least(F.col("size").cast("double"), F.col("size") * 0.5 + half)
        down = rasters.with_kernel(size.where(F.col("face") == "down"), prior, ["size"], "prior_mask binary")
        parts.append(
            down.select(
                *FACE,
                F.lit(2).alias("kind"),
                F.lit(0).alias("place"),
                F.lit("down:roof:nadir").alias("prompt_id"),
                F.lit("roof").alias("class_text"),
                F.lit("roof_down_prior").alias("source"),
                low.alias("x0"),
                low.alias("y0"),
                high.alias("x1"),
                high.alias("y1"),
                F.lit(1.0).alias("score"),
                "prior_mask",
            )
        )
    out = parts[0] if parts else None
    for p in parts[1:]:
        out = out.unionByName(p)
    if out is None:
        raise ValueError("at least one kind of prompt must be enabled")
    return out


REFINED = (
    "sequence_id string, frame_idx int, face string, face_total int, prior_count int, warnings array<string>, status string, error string,"
    " masks array<struct<mask_idx:int,class_text:string,source:string,prompt_id:string,x0:double,y0:double,x1:double,y1:double,"
    "score:double,prompt_x0:double,prompt_y0:double,prompt_x1:double,prompt_y1:double,prompt_score:double,"
    "used_temporal_prior:boolean,area:long,mask:binary>>"
)


def refine(faces: DataFrame, asked: DataFrame, factory: Callable[[], backends.Refiner], config: Config) -> DataFrame:
    """One row per face with its refined masks, folding the temporal memory over each sequence's faces.

    A failing sky or roof group is a warning; a failing required group fails the
    face, whose masks then do not enter the memory.
    """
    fields = ["kind", "place", "prompt_id", "class_text", "source", *detections.BOX, "score", "prior_mask"]
    grouped = asked.groupBy(*FACE).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("prompts"))
    rows = faces.select(*FACE, "face_total", "face_rgb").join(grouped, FACE, "left")
    get = _once(factory)

    def make():
        memory = MaskMemory(config)

        def step(frame_rows: list[dict]) -> list[dict]:
            r = frame_rows[0]
            face, n, frame = r["face"], r["face_total"], r["frame_idx"]
            rgb = np.frombuffer(r["face_rgb"], np.uint8).reshape(n, n, 3)
            own = [dict(p, face=face) for p in r["prompts"] or []]
            asked_, priors = memory.attach(own, frame, face)
            groups: dict[str, list[dict]] = {g: [] for g in GROUPS}
            for p in asked_:
                groups[prompt_group(p, face)].append(p)
            found, warnings, status, error = [], [], "refined", ""
            for kind, of_kind in groups.items():
                if not of_kind:
                    continue
                try:
                    made = get().refine_face(face, rgb, of_kind)
                except Exception as e:  # noqa: BLE001
                    if kind == "required":
                        status, error = "failed", str(e)
                        break
                    warnings.append(group_warning(kind, "", e))
                    continue
                for p, m in zip(of_kind, made, strict=True):
                    if m is None:
                        continue
                    mask = kernels.as_mask(m[0] > 0)
                    box, area = kernels.bounding_box(mask), int(np.count_nonzero(mask))
                    if box is None or area < config.sam2_min_mask_area_px:
                        continue
                    found.append(
                        {
                            "face": face, "class_text": p["class_text"], "source": p["source"], "prompt_id": p.get("prompt_id") or "",
                            **dict(zip(detections.BOX, map(float, box), strict=True)), "score": float(m[1]),
                            **{f"prompt_{c}": float(p[c]) for c in detections.BOX}, "prompt_score": float(p["score"]),
                            "used_temporal_prior": bool(p["used_temporal_prior"]), "area": area, "mask": mask.tobytes(),
                        }
                    )
            if status == "refined":
                memory.update(found, frame)
            base = {"sequence_id": r["sequence_id"], "frame_idx": frame, "face": face, "face_total": n}
            masks = [{k: v for k, v in m.items() if k != "face"} | {"mask_idx": i} for i, m in enumerate(found)]
            return [base | {"prior_count": priors, "warnings": warnings, "status": status, "error": error, "masks": masks}]

        return step

    return ordered_fold(rows, ["sequence_id", "face"], ["frame_idx"], "frame_idx", make, REFINED)


GROUPS = ("required", "sky", "roof")


def prompt_group(prompt: dict, face: str) -> str:
    """Sky prompts and the lower face's roof prompts may fail on their own; all others are required."""
    if prompt["class_text"] == "roof" and face == "down":
        return "roof"
    return "sky" if prompt["class_text"] == "sky" else "required"


def group_warning(group: str, what: str, error: object) -> str:
    kind = "semantic " if group == "sky" else ""
    return f"{group} SAM 2 {what}refinement failed; {group} mask will use {kind}fallback: {error}"


def refine_sequences(
    faces: DataFrame,
    asked: DataFrame,
    factory: Callable[[], backends.SequenceRefiner],
    config: Config,
    hold: Callable[[DataFrame], DataFrame] = DataFrame.persist,
) -> DataFrame:
    """One row per face with its refined masks from a model that follows tracks over a sequence's frames.

    Each face and prompt group has its own session and tracks, folded over the
    frames in order.  A group that fails has no masks in any frame of that face:
    for sky and roof that is a warning on all frames of the sequence, otherwise
    it fails all frames of the sequence.  The fold's result is looked at twice,
    so ``hold`` keeps it.
    """
    fields = ["kind", "place", "prompt_id", "class_text", "source", *detections.BOX, "score", "prior_mask"]
    grouped = asked.groupBy(*FACE).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("prompts"))
    rows = faces.select(*FACE, "face_total", "face_rgb").join(grouped, FACE, "left")
    get = _once(factory)

    def make():
        followers: dict[str, TrackedGroup] = {}
        failed: dict[str, str] = {}

        def step(frame_rows: list[dict]) -> list[dict]:
            r = frame_rows[0]
            face, n, frame = r["face"], r["face_total"], r["frame_idx"]
            rgb = np.frombuffer(r["face_rgb"], np.uint8).reshape(n, n, 3)
            own = [dict(p, face=face) for p in r["prompts"] or []]
            found: list[dict] = []
            for group in GROUPS:
                of_group = [p for p in own if prompt_group(p, face) == group]
                if group in failed or not (of_group or group in followers):
                    continue
                try:
                    if group not in followers:
                        followers[group] = TrackedGroup(get().open_sequence(face, config), config)
                    found += [m | {"group": group} for m in followers[group].frame(frame, face, rgb, of_group)]
                except Exception as e:  # noqa: BLE001
                    failed[group] = str(e)
            base = {"sequence_id": r["sequence_id"], "frame_idx": frame, "face": face, "face_total": n}
            return [base | {"masks": found, "failed": [{"group": g, "error": e} for g, e in failed.items()]}]

        return step

    mask = (
        "class_text:string,source:string,prompt_id:string,x0:double,y0:double,x1:double,y1:double,score:double,prompt_x0:double,"
        "prompt_y0:double,prompt_x1:double,prompt_y1:double,prompt_score:double,used_temporal_prior:boolean,area:long,mask:binary"
    )
    schema = (
        f"sequence_id string, frame_idx int, face string, face_total int, masks array<struct<group:string,{mask}>>,"
        " failed array<struct<group:string,error:string>>"
    )
    made = ordered_fold(rows, ["sequence_id", "face"], ["frame_idx"], "frame_idx", make, schema)
    return _settle_groups(hold(made), mask)


def _settle_groups(made: DataFrame, mask: str) -> DataFrame:
    """What a group's failure in any frame means for all frames of its sequence."""
    at = F.array_position(F.array(*[F.lit(f) for f in kernels.FACES]), F.col("face"))
    errors = (
        made.select("sequence_id", "face", at.alias("at"), F.explode("failed").alias("f"))
        .select("sequence_id", "face", "at", "f.group", "f.error")
        .distinct()
    )
    place = F.array_position(F.array(*[F.lit(g) for g in GROUPS]), F.col("group"))
    required = F.col("group") == "required"
    told = F.create_map(*[F.lit(x) for g in GROUPS for x in (g, group_warning(g, "video ", ""))])
    video = F.concat(told[F.col("group")], "error")
    of_sequence = errors.groupBy("sequence_id").agg(
        F.min_by(F.col("error"), F.when(required, F.col("at"))).alias("fatal"),
        F.array_sort(F.collect_list(F.when(~required, F.struct("at", place.alias("place"), video.alias("text"))))).alias("warned"),
    )
    of_face = errors.groupBy("sequence_id", "face").agg(F.collect_set("group").alias("lost"))
    # a failure is one row per sequence, face and group; masks stay where they are unless the join must shuffle
    settled = made.drop("failed").join(of_sequence, "sequence_id", "left").join(of_face, ["sequence_id", "face"], "left")
    fails = F.col("fatal").isNotNull()
    kept = F.filter("masks", lambda m: ~F.coalesce(F.array_contains("lost", m["group"]), F.lit(False)))
    names = [x.split(":")[0] for x in mask.split(",")]
    numbered = F.transform(kept, lambda m, i: F.struct(i.alias("mask_idx"), *[m[x].alias(x) for x in names]))
    out = settled.withColumn("masks", F.when(fails, F.array().cast(f"array<struct<mask_idx:int,{mask}>>")).otherwise(numbered))
    return out.select(
        *FACE,
        "face_total",
        F.size(F.filter("masks", lambda m: m["used_temporal_prior"])).alias("prior_count"),
        # one row of a frame carries the sequence's warnings, so that they are listed once
        F.when((F.col("face") == kernels.FACES[0]) & ~fails & F.col("warned").isNotNull(), F.transform("warned", lambda w: w["text"]))
        .otherwise(F.array().cast("array<string>"))
        .alias("warnings"),
        F.when(fails, "failed").otherwise("refined").alias("status"),
        F.coalesce("fatal", F.lit("")).alias("error"),
        "masks",
    )


class TrackedGroup:
    """The tracks of one face and prompt group, and the model's session for them."""

    def __init__(self, session: backends.SequenceSession, config: Config):
        self.session, self.config, self.tracker, self.asked = session, config, Tracker(config), False

    def frame(self, frame: int, face: str, rgb: np.ndarray, prompts: list[dict]) -> list[dict]:
        """The group's masks in one frame: prompted tracks, and others that were prompted a short while ago."""
        tracker = self.tracker
        tracker.forget(frame)
        assigned = tracker.assign(prompts, frame)
        self.asked = self.asked or bool(assigned)
        if not self.asked:
            return []
        now = {track: reused for _, track, reused in assigned}
        points = [(track, p, kernels.box_center(box_of(p))) for p, track, _ in assigned]
        out = []
        for track, raw, score in self.session.frame(frame, rgb, points):
            known = tracker.tracks.get(track)
            if known is None or not tracker.accepts(track, frame, track in now):
                continue
            mask = kernels.as_mask(np.asarray(raw) > 0)
            box = kernels.bounding_box(mask)
            if box is None:
                continue
            tracker.observe(track, map(float, box), frame)
            area = int(np.count_nonzero(mask))
            if area < self.config.sam2_min_mask_area_px:
                continue
            p = known.prompt
            name = (p.get("prompt_id") or "") if track in now else f"{face}:temporal:{known.class_text}:{track}:{frame}"
            out.append(
                {
                    "class_text": known.class_text, "source": known.source if track in now else "temporal_prior", "prompt_id": name,
                    **dict(zip(detections.BOX, map(float, box), strict=True)), "score": float(p["score"] if score is None else score),
                    **{f"prompt_{c}": float(p[c]) for c in detections.BOX}, "prompt_score": float(p["score"]),
                    "used_temporal_prior": now.get(track, True), "area": area, "mask": mask.tobytes(),
                }
            )
        return out


def refine_status(refined: DataFrame) -> DataFrame:
    """Per frame: mask and prior counts, status, and errors or warnings."""
    order = F.array_position(F.array(*[F.lit(f) for f in kernels.FACES]), F.col("face"))
    failed = F.col("status") == "failed"
    return refined.groupBy(*FRAME).agg(
        F.sum(F.size("masks")).cast("int").alias("sam2_mask_count"),
        F.sum("prior_count").cast("int").alias("sam2_temporal_prior_count"),
        F.when(F.bool_or(failed), "failed").otherwise("refined").alias("sam2_refine_status"),
        F.coalesce(
            F.min_by("error", F.when(failed, order)),
            F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), "warnings"))), lambda s: s["warnings"])), "; "),
        ).alias("sam2_refine_error"),
    )


def refined_masks(refined: DataFrame) -> DataFrame:
    """One row per refined mask."""
    each = refined.select(*FACE, F.col("face_total").alias("height"), F.col("face_total").alias("width"), F.explode("masks").alias("m"))
    return each.select(*FACE, "height", "width", "m.*")


def _or_all(masks, total):
    out = np.zeros(total * total, np.uint8)
    for m in masks or []:
        a = np.frombuffer(m, np.uint8)
        if a.size == out.size:
            np.maximum(out, kernels.as_mask(a > 0), out=out)
    return out.reshape(total, total)


def roof_masks(refined: DataFrame, frames: DataFrame, config: Config) -> DataFrame:
    """Roof mask of every frame on the panorama: own evidence, neighbours' vote and prior, by the decision table.

    ``frames`` has erp_height and erp_width.
    """
    fraction, margin = config.sam2_roof_box_fraction, config.sam2_roof_prior_margin_fraction
    own = F.transform(F.filter("masks", lambda m: exprs.class_label(m["class_text"]) == "roof"), lambda m: m["mask"])
    down = refined.where(F.col("face") == "down").select(*FRAME, "face_total", own.alias("own"))

    def candidate(masks, total):
        m = _or_all(masks, total)
        if not masks or np.count_nonzero(m) < config.sam2_min_mask_area_px:
            return (None,)
        return (kernels.regularise_roof(m, fraction, margin).tobytes(),)

    made = rasters.with_kernel(down, candidate, ["own", "face_total"], "candidate binary").drop("own")
    sized = made.withColumn("height", F.col("face_total")).withColumn("width", F.col("face_total"))
    decided = rasters.roof_decisions(
        sized, max(0, config.sam2_roof_temporal_window), fraction, margin, config.sam2_roof_temporal_disagreement_iou_threshold
    )
    placed = decided.join(frames.select(*FRAME, "erp_height", "erp_width"), FRAME)

    def project(mask, total, height, width):
        m = kernels.face_mask_to_panorama(
            np.frombuffer(mask, np.uint8).reshape(total, total), "down", width, height, config.cube_face_size, config.cube_overlap_px
        )
        return m.tobytes(), int(np.count_nonzero(m))

    inputs = ["roof_mask", "face_total", "erp_height", "erp_width"]
    return rasters.with_kernel(placed, project, inputs, "roof binary, roof_mask_area_px long").drop("candidate", "roof_mask", "height", "width")


def sky_masks(refined: DataFrame, semantic: DataFrame, frames: DataFrame, config: Config) -> DataFrame:
    """Sky mask of every frame on the panorama, from the five upper faces."""
    label = exprs.class_label(F.col("class_name"))
    of_face = semantic.where(F.col("face").isin(*SKY_FACES)).groupBy(*FACE).agg(
        F.collect_list(F.when(label == "sky", F.col("mask"))).alias("sky"),
        F.collect_list(F.when(label.isin(*SKY_BLOCKERS), F.col("mask"))).alias("blockers"),
    )
    own = F.transform(F.filter("masks", lambda m: exprs.class_label(m["class_text"]) == "sky"), lambda m: m["mask"])
    faces = refined.where(F.col("face").isin(*SKY_FACES)).select(*FACE, "face_total", own.alias("own"))
    joined = faces.join(of_face, FACE, "left").join(frames.select(*FRAME, "erp_height", "erp_width"), FRAME)

    def face_sky(face, total, own_, sky, blockers, height, width):
        if not sky:
            return None, None
        refined_ = _or_all(own_, total)
        has = bool(own_) and bool(refined_.any())
        m = kernels.combine_sky(_or_all(sky, total), refined_ if has else None, config.sky_mask_sam2_boundary_margin_px)
        m = kernels.regularise_sky(
            face, m, _or_all(blockers, total), config.sky_mask_obstacle_dilation_px, config.sky_mask_top_seed_fraction
        )
        if np.count_nonzero(m) < config.sam2_min_mask_area_px:
            return None, None
        projected = kernels.face_mask_to_panorama(m, face, width, height, config.cube_face_size, config.cube_overlap_px)
        return projected.tobytes(), f"{face}:{'semantic_sam2_boundary' if has else 'semantic_mask2former'}"

    inputs = ["face", "face_total", "own", "sky", "blockers", "erp_height", "erp_width"]
    made = rasters.with_kernel(joined, face_sky, inputs, "part binary, part_source string")
    order = F.array_position(F.array(*[F.lit(f) for f in SKY_FACES]), F.col("face"))
    grouped = made.groupBy(*FRAME, "erp_height", "erp_width").agg(
        F.array_sort(F.collect_list(F.when(F.col("part").isNotNull(), F.struct(order.alias("o"), "part", "part_source")))).alias("parts")
    )

    def finish(parts, height, width):
        out = np.zeros((height, width), np.uint8)
        for p in parts:
            out = np.maximum(out, rasters.view(p["part"], height, width))
        if parts:
            out = kernels.majority_smooth(out, config.sky_mask_erp_smoothing_iterations, wrap_x=True)
        area = int(np.count_nonzero(out))
        source = ";".join(p["part_source"] for p in parts) or "no_sky_source"
        return out.tobytes(), area, source, "generated" if area else "empty", "" if parts else "No usable Mask2Former sky prediction"

    outputs = "sky binary, sky_mask_area_px long, sky_mask_source string, sky_mask_status string, sky_mask_error string"
    return rasters.with_kernel(grouped, finish, ["parts", "erp_height", "erp_width"], outputs).drop("parts")


def dynamic_masks(semantic: DataFrame, refined: DataFrame, frames: DataFrame, config: Config) -> DataFrame:
    """Dynamic mask of every frame on the panorama: semantic classes and refined detections, both by class."""
    own = semantic.where(exprs.class_label(F.col("class_name")).isin(*DYNAMIC_CLASSES)).select(*FACE, "mask")
    seen = refined.where(
        exprs.class_label(F.col("class_text")).isin(*DYNAMIC_CLASSES) & F.col("source").isin("grounding_box", "temporal_prior")
    ).select(*FACE, "mask")
    # united before the shuffle as far as a batch goes, so that a frame gathers few masks
    of_face = own.unionByName(seen).withColumn("bytes", F.length("mask"))
    parts = rasters.fold_masks(of_face, [*FACE, "bytes"], "mask").groupBy(*FRAME).agg(F.collect_list(F.struct("face", "mask")).alias("parts"))
    joined = frames.select(*FRAME, "erp_height", "erp_width").join(parts, FRAME, "left")

    def one(parts_, height, width):
        out = np.zeros((height, width), np.uint8)
        total = config.cube_face_size + 2 * config.cube_overlap_px
        by_face: dict[str, list] = {}
        for p in parts_ or []:
            by_face.setdefault(p["face"], []).append(p["mask"])
        for face, masks in by_face.items():
            m = _or_all(masks, total)
            out = np.maximum(out, kernels.face_mask_to_panorama(m, face, width, height, config.cube_face_size, config.cube_overlap_px))
        return (out.tobytes(),)

    return rasters.with_kernel(joined, one, ["parts", "erp_height", "erp_width"], "dynamic binary").drop("parts")


# --- inpainting ------------------------------------------------------------------------------------------------------


def inpaint(
    frames: DataFrame,
    config: Config,
    video: Callable[[], backends.VideoInpainter] | None,
    image: Callable[[], backends.ImageInpainter] | None,
    startup_reason: str = "",
) -> DataFrame:
    """Frames with final_rgb and their statuses.

    ``frames`` has one row per loaded frame: sequence_id, frame_idx, height,
    width, rgb, inpaint, sky.  Windows run over the loaded frames; the decision
    for the image model is per sequence, and a sequence whose video model fails
    goes there as a whole.
    """
    total = config.cube_face_size + 2 * config.cube_overlap_px
    order = Window.partitionBy("sequence_id").orderBy("frame_idx")
    placed = frames.withColumn("position", F.row_number().over(order) - 1)
    counts = placed.groupBy("sequence_id").agg(F.count("*").alias("n"), F.max(_area(F.col("inpaint"))).alias("largest"))
    plan = windows.plan(counts, config.inpaint_window_size, config.inpaint_window_stride)
    longest = plan.groupBy("sequence_id").agg(F.max(F.col("end") - F.col("start")).alias("longest"), F.count("*").cast("int").alias("window_count"))
    start = startup_reason or ("" if video is not None else "propainter_model_load_failure")
    reason = exprs.fallback_reason(
        F.lit(startup_reason), F.lit(config.force_single_frame_fallback), F.col("longest"), F.col("largest"),
        config.propainter_min_window_frames, config.single_frame_min_mask_area_px,
    )
    decided = counts.join(longest, "sequence_id").withColumn("reason", reason)
    if video is None and not startup_reason:
        decided = decided.withColumn("reason", F.when(F.col("reason") == "", start).otherwise(F.col("reason")))
    sized = decided.select("sequence_id", "reason", "window_count")

    faces = geometry.project_faces(placed, config.cube_face_size, config.cube_overlap_px)
    faces = geometry.mask_to_face(faces.withColumn("mask", F.col("inpaint")), config.cube_face_size, config.cube_overlap_px).select(
        "sequence_id", "frame_idx", "position", "face", "face_rgb", "face_mask"
    )
    clips = _video_faces(faces, plan, sized.where("reason = ''").select("sequence_id"), config, video, total) if video is not None else None
    status = sized
    if clips is not None:
        failed = clips.where("error IS NOT NULL").groupBy("sequence_id").agg(F.min("error").alias("video_error"), F.bool_or("oom").alias("oom"))
        status = sized.join(failed, "sequence_id", "left")
        after = F.when(F.col("oom"), "propainter_oom_all_retry_levels").otherwise(
            F.concat(F.lit("propainter_inference_failed: "), F.col("video_error"))
        )
        status = status.withColumn("reason", F.when(F.col("video_error").isNotNull() & F.lit(image is not None), after).otherwise(F.col("reason")))
    else:
        status = status.withColumn("video_error", F.lit(None).cast("string")).withColumn("oom", F.lit(False))

    parts = []
    if clips is not None:
        good = clips.where("error IS NULL").join(status.where("reason = '' AND video_error IS NULL").select("sequence_id"), "sequence_id", "left_semi")
        parts.append(good.select(*FACE, "final_face", F.lit(None).cast("string").alias("image_error")))
    if image is not None:
        single = faces.join(status.where("reason <> ''").select("sequence_id"), "sequence_id", "left_semi")
        parts.append(_image_faces(single, config, image, total))
    empty = faces.limit(0).select(*FACE, F.col("face_rgb").alias("final_face"), F.lit(None).cast("string").alias("image_error"))
    done = empty
    for p in parts:
        done = done.unionByName(p)
    gathered = done.groupBy(*FRAME).agg(
        F.collect_list(F.when(F.col("final_face").isNotNull(), F.struct("face", "final_face"))).alias("faces"),
        F.min("image_error").alias("image_error"),
    )
    joined = placed.join(gathered, FRAME, "left").join(status, "sequence_id", "left")

    def assemble(faces_, rgb, mask, height, width):
        if faces_ is None or len(faces_) < len(kernels.FACES):
            return (None,)
        original = np.frombuffer(rgb, np.uint8).reshape(height, width, 3)
        made = {f["face"]: np.frombuffer(f["final_face"], np.uint8).reshape(total, total, 3) for f in faces_}
        splat = kernels.splat_faces(made, original, config.cube_face_size, config.cube_overlap_px, config.propainter_face_feather_px)
        return (kernels.composite(original, splat, rasters.view(mask, height, width)).tobytes(),)

    made = rasters.with_kernel(joined, assemble, ["faces", "rgb", "inpaint", "height", "width"], "final_rgb binary")
    used_image, ok = F.col("reason") != "", F.col("final_rgb").isNotNull()
    missing = F.concat(F.lit("LaMa fallback unavailable: "), F.col("reason"))
    return (
        made.withColumn(
            "propainter_status", F.when(~ok, "failed").when(used_image, "fallback_lama").otherwise("inpainted")
        )
        .withColumn(
            "propainter_error",
            F.when(used_image & F.lit(image is None), missing)
            .when(F.col("video_error").isNotNull(), F.col("video_error"))
            .when(~ok & used_image, F.col("reason"))
            .otherwise(""),
        )
        .withColumn("lama_status", F.when(used_image & F.lit(image is not None), F.when(ok, "inpainted").otherwise("failed")).otherwise("pending"))
        .withColumn("lama_error", F.coalesce("image_error", F.lit("")))
        .withColumn("single_frame_fallback_reason", F.col("reason"))
        .withColumn("propainter_window_count", F.col("window_count"))
        .withColumnRenamed("faces", "final_faces")
        .drop("image_error", "reason", "video_error", "oom", "window_count")
    )


def _area(mask):
    """Foreground pixels of a packed mask of 0 and 255."""
    text = F.hex(mask)
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit("F"), F.lit("")))) / 2


def _video_faces(faces: DataFrame, plan: DataFrame, only: DataFrame, config: Config, factory, total: int) -> DataFrame:
    """Reconciled faces of the video model: one group of work per sequence, face and window.

    Chunks that reconciliation would not use still run, because the model needs
    their context; only the chosen frames leave the group.
    """
    chosen = windows.reconcile(plan).withColumn("chosen", F.lit(True))
    members = windows.members(plan).join(only, "sequence_id", "left_semi").join(chosen, ["sequence_id", "window_index", "position"], "left")
    work = faces.join(members.select("sequence_id", "window_index", "position", "chosen"), ["sequence_id", "position"])
    get = _once(factory)

    def clip(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("position")
        rgbs = [np.frombuffer(x, np.uint8).reshape(total, total, 3) for x in pdf["face_rgb"]]
        masks = [np.frombuffer(x, np.uint8).reshape(total, total) for x in pdf["face_mask"]]
        error, oom, made = None, False, rgbs
        try:
            made = backends.inpaint_with_retries(get(), pdf["face"].iloc[0], rgbs, masks, config)
        except Exception as e:  # noqa: BLE001
            error, oom = str(e), isinstance(e, backends.OutOfMemory)
        faces_ = [None if error else kernels.composite(a, b, m).tobytes() for a, b, m in zip(rgbs, made, masks, strict=True)]
        out = pdf[["sequence_id", "frame_idx", "face"]].assign(final_face=faces_, error=error, oom=oom)
        return out[(pdf["chosen"] == True).to_numpy()]  # noqa: E712

    kind = faces.schema["sequence_id"].dataType.simpleString()
    schema = f"sequence_id {kind}, frame_idx int, face string, final_face binary, error string, oom boolean"
    return work.groupBy("sequence_id", "face", "window_index").applyInPandas(clip, schema)


def _image_faces(faces: DataFrame, config: Config, factory, total: int) -> DataFrame:
    get = _once(factory)

    def one(face, rgb, mask):
        original = np.frombuffer(rgb, np.uint8).reshape(total, total, 3)
        m = np.frombuffer(mask, np.uint8).reshape(total, total)
        try:
            return kernels.composite(original, get().inpaint_image(face, original, m, config), m).tobytes(), None
        except Exception as e:  # noqa: BLE001
            return None, str(e)

    return rasters.with_kernel(faces, one, ["face", "face_rgb", "face_mask"], "final_face binary, image_error string").select(
        *FACE, "final_face", "image_error"
    )
