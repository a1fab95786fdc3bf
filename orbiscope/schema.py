"""Schemas of the frame pipeline's relations."""

from __future__ import annotations

# The manifest's columns in order, with their types; a question mark allows null.
FRAME_COLUMNS = """
sequence_id string; csv_row_number int; source_index string; csv_path string; source_path string; resolved_fixed_path string;
frame_name string; frame_stem string; frame_number int?; ts string; lat string; lon string; alt string; speed string;
speed3d string; date string; file_exists boolean; processing_status string; skip_reason string; valid_order_index int?;
rgb_output_path string; rgba_output_path string; dynamic_mask_path string; roof_mask_path string; sky_mask_path string;
inpaint_mask_path string; union_debug_path string; overlay_output_path string; cubemap_cache_dir string; erp_width int?;
erp_height int?; erp_channels int?; erp_dtype string; erp_source_mode string; erp_file_sha256 string;
erp_horizontal_wrap_mode string; erp_normalization_status string; erp_normalization_error string; cubemap_face_size int?;
cubemap_overlap_px int?; cubemap_total_face_size int?; cubemap_face_cache_format string; cubemap_faces_cached boolean;
cubemap_metadata_path string?; cubemap_projection_status string; cubemap_projection_error string; roof_mask_status string;
roof_mask_source string; roof_mask_area_px int?; roof_mask_temporal_disagreement boolean; roof_mask_error string;
sky_mask_status string; sky_mask_source string; sky_mask_area_px int?; sky_mask_error string; dynamic_mask_status string;
dynamic_mask_source string; dynamic_mask_area_px int?; dynamic_mask_error string; inpaint_mask_status string;
inpaint_mask_area_px int?; inpaint_mask_error string; mask_fusion_status string; mask_fusion_error string;
propainter_model_id string; propainter_output_dir string?; propainter_window_count int?; propainter_chunk_count int?;
propainter_status string; propainter_error string; lama_model_id string; lama_output_dir string?; lama_status string;
lama_error string; single_frame_fallback_reason string; semantic_model_id string; semantic_output_dir string?;
semantic_has_panoptic boolean; semantic_has_confidence boolean; semantic_has_logits boolean; semantic_parse_status string;
semantic_parse_error string; grounding_model_id string; grounding_output_dir string?; grounding_box_count int?;
grounding_detect_status string; grounding_detect_error string; sam2_model_id string; sam2_output_dir string?;
sam2_mask_count int?; sam2_temporal_prior_count int?; sam2_refine_status string; sam2_refine_error string;
qa_sky_ratio double?; qa_dynamic_ratio double?; qa_roof_ratio double?; qa_inpaint_ratio double?;
qa_mask_components_dynamic int?; qa_mask_components_roof int?; qa_seam_delta_rgb double?; qa_seam_delta_alpha double?;
qa_used_propainter boolean; qa_used_lama_fallback boolean; qa_processing_time_sec double?; qa_status string; qa_error string
"""
FRAMES: dict[str, str] = {n: k.rstrip("?") for n, k in (c.split() for c in FRAME_COLUMNS.replace("\n", " ").split(";"))}
NULLABLE = {n for n, k in (c.split() for c in FRAME_COLUMNS.replace("\n", " ").split(";")) if k.endswith("?")}
# The columns that a source manifest must have, and those of the quality table.
REQUIRED_FIELDS = ("path", "ts", "lat", "lon", "alt", "speed", "speed3d", "date")
METRIC_FIELDS = (
    "sequence_id", "frame_name", "frame_stem", "valid_order_index", "qa_status", "qa_error", "sky_ratio", "dynamic_ratio",
    "roof_ratio", "inpaint_ratio", "mask_components_dynamic", "mask_components_roof", "seam_delta_rgb", "seam_delta_alpha",
    "used_propainter", "used_lama_fallback", "processing_time_sec", "overlay_output_path",
)
#: Columns whose value is "pending" until a stage sets them.
PENDING = tuple(n for n in FRAMES if n.endswith("_status") and n != "processing_status")

DETECTIONS = (
    "sequence_id string, frame_idx int, face string, det_idx int, x0 float, y0 float, x1 float, y1 float, score float,"
    " text string, text_normalized string"
)
SEMANTIC_MASKS = (
    "sequence_id string, frame_idx int, face string, class_idx int, class_id int, class_name string, height int, width int,"
    " mask binary"
)
MASKS = (
    "sequence_id string, frame_idx int, face string, mask_idx int, class_text string, source string, prompt_id string,"
    " x0 float, y0 float, x1 float, y1 float, score float, prompt_x0 float, prompt_y0 float, prompt_x1 float,"
    " prompt_y1 float, prompt_score float, used_temporal_prior boolean, height int, width int, mask binary"
)
