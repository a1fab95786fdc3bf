"""The registered queries and the SQL that checks them.

Every query runs an operator of this library over the test tables, read as the
frame pipeline's relations (``orbiscope.plans.bridges``); the SQL states the same
result independently.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbiscope import config
from orbiscope.functions import exprs, kernels
from orbiscope.operators import detections, geometry, pixels, quality, rasters, tracking, windows
from orbiscope.plans import bridges

FLAGSHIP = "fuse_inpaint"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

SIDE = bridges.SIDE
KEYS = ["sequence_id", "frame_idx"]
#: Thresholds on the embeddings that stand for the dynamic, roof and sky masks.
DYNAMIC, ROOF, SKY = 0.1, 0.15, -0.12
WINDOW, STRIDE, CHUNK = 24, 12, 8


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


FRAMES = """fr AS (
  SELECT 'GS' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS sequence_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS csv_row_number,
         event_id AS frame_number, event_type <> 'error' AS file_exists, event_type, value FROM events)"""
CELLS = """cell AS (
  SELECT sequence_id, frame_idx, CAST(i // 8 AS INTEGER) AS y, CAST(i % 8 AS INTEGER) AS x, v
  FROM (SELECT label AS sequence_id, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INTEGER) AS frame_idx,
               unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)),
frames AS (SELECT DISTINCT sequence_id, frame_idx FROM cell)"""


def px_sql(name: str, low: float, reverse: bool = False) -> str:
    return f"{name} AS (SELECT sequence_id, frame_idx, y, x FROM cell WHERE v {'<' if reverse else '>'} CAST({low} AS DOUBLE))"


def _px(spark, sf_dir, low=DYNAMIC, reverse=False):
    return bridges.pixels(spark, sf_dir, low, reverse)


def _masks(spark, sf_dir, low=DYNAMIC, reverse=False):
    return bridges.masks(spark, sf_dir, low, "mask", reverse)


# --- index -----------------------------------------------------------------------------------------------------------


@query(
    f"""WITH {FRAMES}
SELECT sequence_id, csv_row_number, frame_number, file_exists,
       CASE WHEN file_exists THEN 'ready' ELSE 'missing_source' END AS processing_status,
       CASE WHEN file_exists THEN '' ELSE 'Referenced fixed frame is missing' END AS skip_reason,
       CASE WHEN file_exists THEN CAST(sum(CAST(file_exists AS INTEGER)) OVER (PARTITION BY sequence_id ORDER BY csv_row_number) - 1 AS INTEGER) END
         AS valid_order_index FROM fr"""
)
def index_frames(spark, sf_dir):
    there = F.col("file_exists")
    return bridges.frames(spark, sf_dir).select(
        "sequence_id",
        "csv_row_number",
        "frame_number",
        "file_exists",
        F.when(there, "ready").otherwise("missing_source").alias("processing_status"),
        F.when(there, "").otherwise("Referenced fixed frame is missing").alias("skip_reason"),
        windows.valid_order_index().alias("valid_order_index"),
    )


MIN_VALID = 55


@query(
    f"""WITH {FRAMES}
SELECT sequence_id, count(*) AS total_csv_rows, count(*) FILTER (file_exists) AS valid_frames,
       count(*) FILTER (NOT file_exists) AS skipped_frames,
       CASE WHEN count(*) FILTER (file_exists) < {MIN_VALID} THEN 'failed_insufficient_valid_frames' ELSE 'ready' END AS status,
       CASE WHEN count(*) FILTER (file_exists) < {MIN_VALID} THEN 'Only ' || count(*) FILTER (file_exists) ||
         ' valid frames remain after validation; minimum is {MIN_VALID}' END AS failure_reason
FROM fr GROUP BY 1"""
)
def index_sequences(spark, sf_dir):
    from orbiscope.plans.stages import sequence_status

    return sequence_status(bridges.frames(spark, sf_dir), MIN_VALID)


@query(
    f"""WITH {FRAMES}, n AS (SELECT *, 'f' || frame_number AS frame_name FROM fr)
SELECT sequence_id, coalesce(string_agg(frame_name, ',' ORDER BY csv_row_number) FILTER (NOT file_exists), '') AS missing_frames,
       arg_min(frame_name, csv_row_number) FILTER (file_exists) AS first_valid_frame,
       arg_max(frame_name, csv_row_number) FILTER (file_exists) AS last_valid_frame
FROM n GROUP BY 1"""
)
def summary_lists(spark, sf_dir):
    named = bridges.frames(spark, sf_dir).withColumn("frame_name", F.concat(F.lit("f"), "frame_number"))
    there = F.col("file_exists")
    return named.groupBy("sequence_id").agg(
        F.array_join(quality.names_where(~there), ",").alias("missing_frames"), *quality.first_and_last(there)
    )


@query(f"WITH {FRAMES} SELECT sequence_id, count(*) AS n FROM fr WHERE sequence_id IN ('GS000001', 'GS000007', 'GS000012') GROUP BY 1")
def sequence_subset(spark, sf_dir):
    from orbiscope.plans.stages import subset

    return subset(bridges.frames(spark, sf_dir), ["GS000001", "GS000007", "GS000012", "GS999999"]).groupBy("sequence_id").agg(F.count("*").alias("n"))


# --- paths and labels ------------------------------------------------------------------------------------------------

NAMED_PAGES = """p AS (SELECT page_id, '/data/GS' || (page_id % 10) AS dir, 'GS-frame-' || lpad(CAST(page_id AS VARCHAR), 6, '0') || '.jpg' AS name FROM pages)"""


def _named_pages(spark, sf_dir):
    name = F.concat(F.lit("GS-frame-"), F.lpad(F.col("page_id").cast("string"), 6, "0"), F.lit(".jpg"))
    return bridges.table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("/data/GS"), F.col("page_id") % 10).alias("dir"), name.alias("name")
    )


@query(
    f"""WITH {NAMED_PAGES}
SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/cam/fixed/' || name WHEN 1 THEN dir || '/fixed/' || name
       WHEN 2 THEN dir || '/fixed/' || name ELSE dir || '/fixed/sub/' || name END AS path, name AS file_name,
       replace(name, '.jpg', '') AS stem, CAST(page_id AS INTEGER) AS number FROM p"""
)
def resolve_paths(spark, sf_dir):
    pages = _named_pages(spark, sf_dir)
    raw = (
        F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("  /cam//x/../fixed/"), "name", F.lit(" ")))
        .when(F.col("page_id") % 4 == 1, F.concat(F.lit("raw/"), "name"))
        .when(F.col("page_id") % 4 == 2, F.concat(F.lit("/elsewhere/"), "name"))
        .otherwise(F.concat(F.lit("./fixed/sub/"), "name"))
    )
    found = pages.select("page_id", exprs.resolve_frame_path(F.col("dir"), raw).alias("path"))
    named = found.select("page_id", "path", exprs.file_name(F.col("path")).alias("file_name"))
    stem = exprs.file_stem(F.col("file_name"))
    return named.select("page_id", "path", "file_name", stem.alias("stem"), exprs.frame_number(stem).alias("number"))


@query(
    """SELECT page_id, try_cast(nullif(regexp_extract(url, 'frame-(\\d+)$', 1), '') AS INTEGER) AS from_url,
       try_cast(nullif(regexp_extract('x-frame-' || (page_id * 7) || CASE WHEN page_id % 3 = 0 THEN 'b' ELSE '' END, 'frame-(\\d+)$', 1), '') AS INTEGER) AS number
       FROM pages"""
)
def frame_numbers(spark, sf_dir):
    tail = F.when(F.col("page_id") % 3 == 0, "b").otherwise("")
    return bridges.table(spark, sf_dir, "pages").select(
        "page_id",
        exprs.frame_number(F.col("url")).alias("from_url"),
        exprs.frame_number(F.concat(F.lit("x-frame-"), F.col("page_id") * 7, tail)).alias("number"),
    )


@query(
    """SELECT doc_id, sha256(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS digest,
       CAST(length(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) AS INTEGER) AS n FROM documents"""
)
def normalize_labels_a(spark, sf_dir):
    label = exprs.detection_label(F.col("text"))
    return bridges.table(spark, sf_dir, "documents").select("doc_id", F.sha2(label, 256).alias("digest"), F.length(label).alias("n"))


@query(
    """SELECT doc_id, sha256(trim(regexp_replace(replace(lower(text), '_', ' '), '\\s+', ' ', 'g'))) AS digest,
       CAST(length(trim(regexp_replace(replace(lower(text), '_', ' '), '\\s+', ' ', 'g'))) AS INTEGER) AS n FROM documents"""
)
def normalize_labels_b(spark, sf_dir):
    label = exprs.class_label(F.col("text"))
    return bridges.table(spark, sf_dir, "documents").select("doc_id", F.sha2(label, 256).alias("digest"), F.length(label).alias("n"))


@query("SELECT page_id, sha256(html) AS digest FROM pages")
def content_sha256(spark, sf_dir):
    return bridges.table(spark, sf_dir, "pages").select("page_id", F.sha2(F.col("html"), 256).alias("digest"))


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS flag, printf('%.8f', value) AS number,
       coalesce(CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END, '') AS text FROM events"""
)
def manifest_text(spark, sf_dir):
    return bridges.table(spark, sf_dir, "events").select(
        "event_id",
        exprs.manifest_text(F.col("event_type") == "error", "boolean").alias("flag"),
        exprs.manifest_text(F.col("value"), "double").alias("number"),
        exprs.manifest_text(F.when(F.col("event_type") != "view", F.col("user_id")), "long").alias("text"),
    )


@query(
    """SELECT doc_id, contains(lower(text), 'out of memory') OR contains(lower(text), 'oom') OR contains(lower(text), 'cuda memory') AS oom
       FROM documents"""
)
def out_of_memory_texts(spark, sf_dir):
    return bridges.table(spark, sf_dir, "documents").select("doc_id", exprs.is_out_of_memory(F.col("text")).alias("oom"))


LABELS = ((0, "Road"), (1, "Sky"), (2, "pedestrian"), (3, "Bike"), (4, "person"), (5, "on-rails"), (6, "terrain_vegetation"), (7, "car"), (8, "rail"))


@query(
    "WITH l(class_id, name) AS (VALUES "
    + ", ".join(f"({i}, '{n}')" for i, n in LABELS)
    + "), a(target, place, alias) AS (VALUES "
    + ", ".join(f"('{t}', {i}, '{a}')" for t, names in config.TARGET_ALIASES.items() for i, a in enumerate(names))
    + """), n AS (SELECT trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS alias, max(class_id) AS class_id FROM l GROUP BY 1)
SELECT target, CAST(arg_min(class_id, place) FILTER (class_id IS NOT NULL) AS INTEGER) AS class_id FROM a LEFT JOIN n USING (alias) GROUP BY target"""
)
def resolve_target_classes(spark, sf_dir):
    labels = spark.createDataFrame(list(LABELS), "class_id int, name string")
    return detections.resolve_targets(labels, config.TARGET_ALIASES)


GRAY = "greatest(0, least(255, CAST(floor(CAST(v AS DOUBLE) * 128 + 128) AS INTEGER)))"


@query(
    f"""WITH {CELLS}
SELECT sequence_id, frame_idx, CAST({GRAY} // 32 AS INTEGER) AS class_id, count(*) AS area FROM cell GROUP BY ALL"""
)
def target_mask_areas(spark, sf_dir):
    """A face labelled by eighths of the gray scale, and the masks of all eight labels."""
    from orbiscope.plans import vision

    faces = _gray_rasters(spark, sf_dir, "face_rgb", 3).withColumn("face", F.lit("front")).withColumn("face_total", F.lit(SIDE))
    parsed = vision.parse_semantic(faces, _EighthsParser, {str(i): i for i in range(8)})
    measured = rasters.measures(vision.semantic_masks(parsed))
    return measured.where("area > 0").select(*KEYS, "class_id", "area")


class _EighthsParser:
    model_id = "catalog/eighths"

    def parse_face(self, face, rgb):
        from orbiscope.plans.backends import SemanticPrediction

        return SemanticPrediction(labels=rgb[..., 0].astype(np.int32) // 32)


def _gray_rasters(spark, sf_dir, name, channels):
    """Gray values as packed rasters of one or more equal channels."""
    cells = bridges.values(spark, sf_dir).groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("y", "x", "v"))).alias("cells"))
    packed = cells.select(*KEYS, F.transform("cells", lambda c: c["v"].cast("int")).alias("grays"))
    return rasters.with_kernel(packed, lambda v: (np.repeat(np.array(v, np.uint8), channels).tobytes(),), ["grays"], f"{name} binary").drop("grays")


# --- windows ---------------------------------------------------------------------------------------------------------

PLAN = f"""{FRAMES}, cnt AS (SELECT sequence_id, CAST(count(*) AS INTEGER) AS n FROM fr WHERE file_exists GROUP BY 1),
win AS (SELECT sequence_id, CAST(i AS INTEGER) AS window_index, CAST(greatest(least(i * {STRIDE}, n - {WINDOW}), 0) AS INTEGER) AS start, n
        FROM (SELECT *, unnest(generate_series(0, CAST(greatest(ceil((n - {WINDOW}) / {STRIDE}.0), 0) AS INTEGER))) AS i FROM cnt)),
plan AS (SELECT sequence_id, window_index, start, least(start + {WINDOW}, n) AS "end" FROM win)"""


def _plan(spark, sf_dir):
    counts = bridges.frames(spark, sf_dir).where("file_exists").groupBy("sequence_id").agg(F.count("*").alias("n"))
    return windows.plan(counts, WINDOW, STRIDE)


@query(f'WITH {PLAN} SELECT sequence_id, window_index, start, "end" FROM plan')
def inpaint_windows(spark, sf_dir):
    return _plan(spark, sf_dir)


@query(
    f"""WITH {PLAN}, pos AS (SELECT sequence_id, csv_row_number, row_number() OVER (PARTITION BY sequence_id ORDER BY csv_row_number) - 1 AS p FROM fr WHERE file_exists)
SELECT sequence_id, window_index, string_agg(CAST(csv_row_number AS VARCHAR), ',' ORDER BY csv_row_number) AS frame_indices
FROM plan JOIN pos USING (sequence_id) WHERE p >= start AND p < "end" GROUP BY 1, 2"""
)
def window_frames(spark, sf_dir):
    planned = windows.plan_for_frames(bridges.frames(spark, sf_dir), WINDOW, STRIDE)
    return planned.select("sequence_id", "window_index", F.array_join(F.transform("frame_indices", lambda x: x.cast("string")), ",").alias("frame_indices"))


@query(
    f"""WITH {PLAN}, m AS (SELECT *, unnest(generate_series(start, "end" - 1)) AS position FROM plan)
SELECT sequence_id, window_index, CAST((position - start) // {CHUNK} AS INTEGER) AS chunk_index, CAST(min(position) AS INTEGER) AS first,
       count(*) AS n FROM m GROUP BY 1, 2, 3"""
)
def window_chunks(spark, sf_dir):
    return windows.chunks(_plan(spark, sf_dir), CHUNK).groupBy("sequence_id", "window_index", "chunk_index").agg(
        F.min("position").alias("first"), F.count("*").alias("n")
    )


RECONCILED = f"""{PLAN}, m AS (SELECT *, unnest(generate_series(start, "end" - 1)) AS position FROM plan),
rec AS (SELECT sequence_id, CAST(position AS INTEGER) AS position, window_index FROM (
  SELECT *, row_number() OVER (PARTITION BY sequence_id, position ORDER BY abs(position - (start + "end" - 1) / 2.0), start, window_index) AS r FROM m) WHERE r = 1)"""


@query(f"WITH {RECONCILED} SELECT * FROM rec")
def reconcile_plan(spark, sf_dir):
    return windows.reconcile(_plan(spark, sf_dir))


@query(
    f"""WITH {RECONCILED}, pred AS (SELECT sequence_id, window_index, CAST(position AS INTEGER) AS position, window_index * 1000 + position AS v FROM m WHERE position % 7 <> 3)
SELECT r.sequence_id, r.window_index, r.position, CAST(v AS BIGINT) AS v, v IS NULL AS missing
FROM rec r LEFT JOIN pred p ON r.sequence_id = p.sequence_id AND r.window_index = p.window_index AND r.position = p.position"""
)
def reconcile_predictions(spark, sf_dir):
    plan = _plan(spark, sf_dir)
    predictions = windows.members(plan).where("position % 7 <> 3").select(
        "sequence_id", "window_index", "position", (F.col("window_index") * 1000 + F.col("position")).cast("long").alias("v")
    )
    return windows.take_predictions(windows.reconcile(plan), predictions)


@query(
    f"""WITH {FRAMES}, c AS (SELECT sequence_id, count(*) AS n FROM fr WHERE file_exists GROUP BY 1),
s AS (SELECT sequence_id, unnest(CASE WHEN n <= 8 THEN generate_series(0, n - 1)
      ELSE list_transform(generate_series(0, 7), lambda i: CAST(round_even(i * ((n - 1) / 7.0), 0) AS BIGINT)) END) AS position FROM c)
SELECT sequence_id, CAST(position AS INTEGER) AS position FROM s"""
)
def qa_sample(spark, sf_dir):
    counted = bridges.frames(spark, sf_dir).where("file_exists").groupBy("sequence_id").agg(F.count("*").alias("n"))
    return counted.select("sequence_id", F.explode(windows.sampled_positions(F.col("n"), 8)).alias("position"))


# --- detections ------------------------------------------------------------------------------------------------------

BOXES = """det AS (SELECT l_orderkey AS frame, CAST(l_linenumber % 6 AS INTEGER) AS face, l_returnflag || l_linestatus AS cls,
  CAST(l_partkey % 50 AS DOUBLE) AS x0, CAST(l_suppkey % 40 AS DOUBLE) AS y0, l_partkey % 50 + l_quantity AS x1,
  l_suppkey % 40 + l_quantity AS y1, round((l_extendedprice % 1000) / 1000, 6) AS score, l_partkey AS part, l_suppkey AS supp,
  l_linenumber AS line FROM lineitem)"""
THRESHOLD, OVERLAP = 0.25, 0.3
TIES = ["x0", "y0", "x1", "y1", "part", "supp", "line"]
IOU_SQL = """CASE WHEN {u} > 0 THEN {i} / {u} ELSE 0 END"""


def iou_sql(a: str, b: str) -> str:
    both = (
        f"greatest(least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0), 0) * greatest(least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0), 0)"
    )
    area = "greatest({t}.x1 - {t}.x0, 0) * greatest({t}.y1 - {t}.y0, 0)"
    return IOU_SQL.format(i=f"({both})", u=f"({area.format(t=a)} + {area.format(t=b)} - {both})")


NMS = f"""{BOXES}, kept AS (
  SELECT frame, unnest(list_reduce(
    list({{'score': score, 'cls': cls, 'face': face, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1, 'part': part, 'supp': supp, 'line': line}}
         ORDER BY score DESC, x0, y0, x1, y1, part, supp, line),
    lambda acc, b: CASE WHEN len(list_filter(acc, lambda k: {iou_sql("k", "b")} > {OVERLAP})) > 0 THEN acc ELSE list_append(acc, b) END,
    [])) AS b
  FROM det WHERE score >= {THRESHOLD} GROUP BY frame, cls)"""


def _kept(spark, sf_dir):
    found = detections.above(bridges.detections(spark, sf_dir), THRESHOLD)
    return detections.suppress(found, ["frame"], "cls", OVERLAP, TIES)


@query(f"WITH {BOXES} SELECT cls, count(*) AS n, round(sum(score), 4) AS total FROM det WHERE score >= {THRESHOLD} GROUP BY 1")
def detections_threshold(spark, sf_dir):
    found = detections.above(bridges.detections(spark, sf_dir), THRESHOLD)
    return found.groupBy("cls").agg(F.count("*").alias("n"), F.round(F.sum("score"), 4).alias("total"))


@query(
    f"""WITH {NMS} SELECT frame, b.cls AS cls, b.score AS score, b.x0 AS x0, b.y0 AS y0, b.x1 AS x1, b.y1 AS y1,
       CAST(row_number() OVER (PARTITION BY frame ORDER BY b.score DESC, b.cls, b.x0, b.y0, b.x1, b.y1, b.part, b.supp, b.line) AS INTEGER) AS rank FROM kept"""
)
def nms_kept(spark, sf_dir):
    return _kept(spark, sf_dir).select("frame", "cls", "score", "x0", "y0", "x1", "y1", "rank")


@query(
    f"""WITH {NMS}, k AS (SELECT frame, count(*) AS kept_count FROM kept GROUP BY 1)
SELECT frame, count(*) AS raw_count, coalesce(any_value(kept_count), 0) AS kept_count FROM det LEFT JOIN k USING (frame) GROUP BY 1"""
)
def nms_counts(spark, sf_dir):
    return detections.counts(bridges.detections(spark, sf_dir), _kept(spark, sf_dir), ["frame"])


@query(
    f"""WITH {BOXES}, i AS (SELECT *, part * 1000000 + supp * 100 + line AS id FROM det)
SELECT a.frame AS frame, a.cls AS cls, a.id AS id_a, b.id AS id_b, round({iou_sql("a", "b")}, 6) AS iou
FROM i a JOIN i b ON a.frame = b.frame AND a.cls = b.cls AND a.id < b.id WHERE {iou_sql("a", "b")} > {OVERLAP}"""
)
def box_iou_pairs(spark, sf_dir):
    keyed = bridges.detections(spark, sf_dir).withColumn("id", F.col("part") * 1000000 + F.col("supp") * 100 + F.col("line"))
    return detections.overlaps(keyed, ["frame"], "cls", "id", OVERLAP).withColumn("iou", F.round("iou", 6))


@query(
    f"""WITH {BOXES}, c AS (SELECT frame, part, supp, line, x0, y0, least(x0, 60) AS a, least(x1 - 45, 60) AS c, least(y0, 48) AS b, least(y1 - 45, 48) AS d FROM det),
s AS (SELECT *, greatest(a, 0) AS a0, greatest(c, 0) AS c0, greatest(b, 0) AS b0, greatest(d, 0) AS d0 FROM c)
SELECT frame, part, supp, line, a0 AS cx0, b0 AS cy0, CASE WHEN c0 <= a0 THEN least(60, a0 + 1) ELSE c0 END AS cx1,
       CASE WHEN d0 <= b0 THEN least(48, b0 + 1) ELSE d0 END AS cy1 FROM s"""
)
def clip_boxes(spark, sf_dir):
    box = exprs.clip_box(F.col("x0"), F.col("y0"), F.col("x1") - 45, F.col("y1") - 45, F.lit(60), F.lit(48))
    found = bridges.detections(spark, sf_dir).withColumn("b", box)
    return found.select("frame", "part", "supp", "line", *[F.col(f"b.{c}").alias(f"c{c}") for c in ("x0", "y0", "x1", "y1")])


@query(f"WITH {BOXES} SELECT frame, part, supp, line, (x1 - x0) * (y1 - y0) AS area, (x0 + x1) / 2 AS cx, (y0 + y1) / 2 AS cy FROM det")
def box_measures(spark, sf_dir):
    box = [F.col(c) for c in detections.BOX]
    center = exprs.box_center(*box)
    return bridges.detections(spark, sf_dir).select(
        "frame", "part", "supp", "line", exprs.box_area(*box).alias("area"), center["x"].alias("cx"), center["y"].alias("cy")
    )


# --- masks -----------------------------------------------------------------------------------------------------------

DYN_SQL, ROOF_SQL, SKY_SQL = px_sql("dyn", DYNAMIC), px_sql("roof", ROOF), px_sql("sky", SKY, True)
PIXELS = "sequence_id, frame_idx, y, x"


@query(f"WITH {CELLS}, {DYN_SQL}, {SKY_SQL} SELECT * FROM dyn UNION SELECT * FROM sky")
def mask_union(spark, sf_dir):
    return pixels.union(_px(spark, sf_dir), _px(spark, sf_dir, SKY, True))


@query(f"WITH {CELLS}, {DYN_SQL}, {px_sql('low', 0.0)} SELECT * FROM low INTERSECT SELECT * FROM dyn")
def mask_intersect(spark, sf_dir):
    return pixels.intersect(_px(spark, sf_dir, 0.0), _px(spark, sf_dir))


@query(f"WITH {CELLS}, {px_sql('low', 0.0)}, {DYN_SQL} SELECT * FROM low EXCEPT SELECT * FROM dyn")
def mask_difference(spark, sf_dir):
    return pixels.subtract(_px(spark, sf_dir, 0.0), _px(spark, sf_dir))


@query(
    f"""WITH {CELLS} SELECT sequence_id, frame_idx, CASE WHEN count(*) FILTER (v > 0 OR v > {DYNAMIC}) > 0
  THEN round(count(*) FILTER (v > 0 AND v > {DYNAMIC}) / count(*) FILTER (v > 0 OR v > {DYNAMIC}), 9) ELSE 1 END AS iou FROM cell GROUP BY 1, 2"""
)
def mask_iou(spark, sf_dir):
    frames = bridges.masks(spark, sf_dir).select(*KEYS)
    return pixels.mask_iou(_px(spark, sf_dir, 0.0), _px(spark, sf_dir), frames).withColumn("iou", F.round("iou", 9))


@query(
    f"""WITH {CELLS}, {DYN_SQL} SELECT sequence_id, frame_idx, count(*) AS area, count(*) / 64.0 AS ratio, min(x) AS x0, min(y) AS y0,
       max(x) + 1 AS x1, max(y) + 1 AS y1, round(avg(x), 9) AS cx, round(avg(y), 9) AS cy FROM dyn GROUP BY 1, 2"""
)
def mask_measures(spark, sf_dir):
    found = pixels.measure(_px(spark, sf_dir), SIDE, SIDE)
    return found.withColumn("cx", F.round("cx", 9)).withColumn("cy", F.round("cy", 9)).withColumn("ratio", F.col("ratio").cast("double"))


def step_sql(source: str, target: str, wrap: bool) -> str:
    x = "(x + dx + 8) % 8" if wrap else "x + dx"
    keep = "y + dy BETWEEN 0 AND 7" + ("" if wrap else " AND x + dx BETWEEN 0 AND 7")
    return f"""{target} AS (SELECT DISTINCT sequence_id, frame_idx, CAST(y + dy AS INTEGER) AS y, CAST({x} AS INTEGER) AS x FROM {source},
      (VALUES (0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)) o(dy, dx) WHERE {keep})"""


DILATED = f"WITH {CELLS}, {DYN_SQL}, {step_sql('dyn', 'd1', False)}, {step_sql('d1', 'd2', False)} SELECT {PIXELS} FROM d2"
DILATED_WRAP = f"WITH {CELLS}, {DYN_SQL}, {step_sql('dyn', 'd1', True)}, {step_sql('d1', 'd2', True)} SELECT {PIXELS} FROM d2"


@query(DILATED)
def dilate(spark, sf_dir):
    return rasters.unpack(rasters.dilate(_masks(spark, sf_dir), 2), KEYS)


@query(DILATED)
def dilate_px(spark, sf_dir):
    return pixels.dilate(_px(spark, sf_dir), 2, SIDE, SIDE)


@query(DILATED_WRAP)
def dilate_wrap(spark, sf_dir):
    return rasters.unpack(rasters.dilate(_masks(spark, sf_dir), 2, wrap_x=True), KEYS)


@query(DILATED_WRAP)
def dilate_wrap_px(spark, sf_dir):
    return pixels.dilate(_px(spark, sf_dir), 2, SIDE, SIDE, wrap_x=True)


ERODE_LOW = -0.15


def erode_sql(source: str, target: str) -> str:
    return f"""{target} AS (SELECT {PIXELS} FROM {source} p WHERE x BETWEEN 1 AND 6 AND 5 = (SELECT count(*) FROM
      (VALUES (0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)) o(dy, dx), {source} q WHERE q.sequence_id = p.sequence_id AND q.frame_idx = p.frame_idx
      AND q.y = least(7, greatest(0, p.y + dy)) AND q.x = p.x + dx))"""


ERODED = f"WITH {CELLS}, {px_sql('e0', ERODE_LOW)}, {erode_sql('e0', 'e1')}, {erode_sql('e1', 'e2')} SELECT * FROM e2"


@query(ERODED)
def erode(spark, sf_dir):
    return rasters.unpack(rasters.erode(_masks(spark, sf_dir, ERODE_LOW), 2), KEYS)


@query(ERODED)
def erode_px(spark, sf_dir):
    return pixels.erode(_px(spark, sf_dir, ERODE_LOW), 2, SIDE, SIDE)


def smooth_sql(source: str, target: str, wrap: bool) -> str:
    x = "(p.x + dx + 8) % 8" if wrap else "p.x + dx"
    return f"""{target} AS (SELECT p.* FROM {source} p, range(-1, 2) a(dy), range(-1, 2) b(dx), {source} q WHERE q.sequence_id = p.sequence_id
      AND q.frame_idx = p.frame_idx AND q.y = least(7, greatest(0, p.y + dy)) AND q.x = {x} GROUP BY ALL HAVING count(*) >= 2)"""


SMOOTHED = f"WITH {CELLS}, {DYN_SQL}, {smooth_sql('dyn', 's1', True)} SELECT * FROM s1"
SMOOTHED_NOWRAP = f"WITH {CELLS}, {DYN_SQL}, {smooth_sql('dyn', 's1', False)}, {smooth_sql('s1', 's2', False)} SELECT * FROM s2"


@query(SMOOTHED)
def smooth_seam(spark, sf_dir):
    return rasters.unpack(rasters.majority_smooth(_masks(spark, sf_dir), 1, wrap_x=True), KEYS)


@query(SMOOTHED)
def smooth_seam_px(spark, sf_dir):
    return pixels.majority_smooth(_px(spark, sf_dir), SIDE, SIDE, wrap_x=True)


@query(SMOOTHED_NOWRAP)
def smooth_nowrap(spark, sf_dir):
    return rasters.unpack(rasters.majority_smooth(_masks(spark, sf_dir), 2, wrap_x=False), KEYS)


@query(SMOOTHED_NOWRAP)
def smooth_nowrap_px(spark, sf_dir):
    return pixels.majority_smooth(_px(spark, sf_dir), SIDE, SIDE, wrap_x=False, iterations=2)


SEED = 0.3
TOP_RUN = f"""WITH {CELLS}, {px_sql('low', 0.0)}, r AS (SELECT *, min(y) OVER (PARTITION BY sequence_id, frame_idx, x) AS f,
  row_number() OVER (PARTITION BY sequence_id, frame_idx, x ORDER BY y) - 1 AS k FROM low) SELECT {PIXELS} FROM r WHERE f < 3 AND y - f = k"""


@query(TOP_RUN)
def top_run(spark, sf_dir):
    return rasters.unpack(rasters.top_run(_masks(spark, sf_dir, 0.0), SEED), KEYS)


@query(TOP_RUN)
def top_run_px(spark, sf_dir):
    return pixels.top_run(_px(spark, sf_dir, 0.0), SIDE, SEED)


FILLED = f"""WITH RECURSIVE {CELLS}, {px_sql('low', -0.05)},
bg AS (SELECT {PIXELS} FROM cell EXCEPT SELECT * FROM low),
reach AS (SELECT * FROM bg WHERE y IN (0, 7) OR x IN (0, 7)
  UNION SELECT b.* FROM reach r JOIN bg b ON b.sequence_id = r.sequence_id AND b.frame_idx = r.frame_idx AND abs(b.y - r.y) + abs(b.x - r.x) = 1)
SELECT {PIXELS} FROM cell EXCEPT SELECT * FROM reach"""


@query(FILLED)
def fill_holes(spark, sf_dir):
    return rasters.unpack(rasters.fill_holes(_masks(spark, sf_dir, -0.05)), KEYS)


def parts_sql(source: str, near: str) -> str:
    return f"""walk(sequence_id, frame_idx, y, x, root) AS (SELECT sequence_id, frame_idx, y, x, y * 8 + x FROM {source}
  UNION SELECT q.sequence_id, q.frame_idx, q.y, q.x, w.root FROM walk w JOIN {source} q
    ON q.sequence_id = w.sequence_id AND q.frame_idx = w.frame_idx AND {near}),
part AS (SELECT sequence_id, frame_idx, y, x, min(root) AS root FROM walk GROUP BY ALL)"""


FOUR, EIGHT = "abs(q.y - w.y) + abs(q.x - w.x) = 1", "greatest(abs(q.y - w.y), abs(q.x - w.x)) = 1"


@query(
    f"""WITH RECURSIVE {CELLS}, {DYN_SQL}, {parts_sql('dyn', FOUR)}
SELECT {PIXELS} FROM (SELECT *, count(*) OVER (PARTITION BY sequence_id, frame_idx, root) AS n FROM part) WHERE n >= 3"""
)
def drop_small(spark, sf_dir):
    return rasters.unpack(rasters.drop_small(_masks(spark, sf_dir), 3), KEYS)


@query(
    f"""WITH RECURSIVE {CELLS}, {DYN_SQL}, {parts_sql('dyn', EIGHT)}, c AS (SELECT sequence_id, frame_idx, count(*) AS area,
  count(DISTINCT root) AS components FROM part GROUP BY 1, 2)
SELECT sequence_id, frame_idx, coalesce(area, 0) AS area, coalesce(area, 0) / 64.0 AS ratio, CAST(coalesce(components, 0) AS INTEGER) AS components
FROM frames LEFT JOIN c USING (sequence_id, frame_idx)"""
)
def components_8(spark, sf_dir):
    return rasters.measures(_masks(spark, sf_dir)).select(*KEYS, "area", "ratio", "components")


TEMPORAL = f"""WITH {CELLS}, {DYN_SQL} SELECT * FROM dyn UNION SELECT a.sequence_id, a.frame_idx + 1, a.y, a.x FROM dyn a JOIN dyn b
  ON a.sequence_id = b.sequence_id AND a.frame_idx + 2 = b.frame_idx AND a.y = b.y AND a.x = b.x"""


@query(TEMPORAL)
def temporal_consistency(spark, sf_dir):
    return rasters.unpack(rasters.temporal_consistency(_masks(spark, sf_dir)), KEYS)


@query(TEMPORAL)
def temporal_consistency_px(spark, sf_dir):
    return pixels.temporal_consistency(_px(spark, sf_dir))


VOTES = f"""{CELLS}, {px_sql('cand', ROOF)}, has AS (SELECT DISTINCT sequence_id, frame_idx FROM cand),
steps(s) AS (VALUES (-2), (-1), (1), (2)),
voters AS (SELECT sequence_id, frame_idx + s AS frame_idx, count(*) AS voters FROM has, steps GROUP BY 1, 2),
votes AS (SELECT sequence_id, frame_idx + s AS frame_idx, y, x, count(*) AS votes FROM cand, steps GROUP BY 1, 2, 3, 4),
vote AS (SELECT {PIXELS} FROM votes JOIN voters USING (sequence_id, frame_idx) SEMI JOIN frames USING (sequence_id, frame_idx)
         WHERE votes >= greatest(1, (voters + 1) // 2))"""


def _candidates(spark, sf_dir):
    """Every frame, with whether its roof mask has any foreground."""
    return bridges.masks(spark, sf_dir, ROOF).select(*KEYS, F.contains(F.hex("mask"), F.lit("FF")).alias("has_candidate"))


@query(f"WITH {VOTES} SELECT * FROM vote")
def roof_vote(spark, sf_dir):
    return pixels.neighbour_vote(_px(spark, sf_dir, ROOF), _candidates(spark, sf_dir), 2)


CORE_F, WIDE_F = 0.55, 0.70


def ellipse_sql(f: float) -> str:
    return f"power((x - 3.5) / {max(1.0, 8 * f / 2)}, 2) + power((y - 3.5) / {max(1.0, 8 * f / 2)}, 2) <= 1"


@query(
    f"""WITH {CELLS}, {px_sql('cand', ROOF)}, core AS (SELECT {PIXELS} FROM cell WHERE {ellipse_sql(CORE_F)})
SELECT * FROM (SELECT * FROM cand UNION SELECT * FROM core) WHERE {ellipse_sql(WIDE_F)}"""
)
def roof_prior(spark, sf_dir):
    frames = bridges.masks(spark, sf_dir).select(*KEYS)
    return pixels.regularise_roof(_px(spark, sf_dir, ROOF), frames, SIDE, SIDE, CORE_F, WIDE_F - CORE_F)


@query(
    f"""WITH {VOTES}, core AS (SELECT {PIXELS} FROM cell WHERE {ellipse_sql(CORE_F)}),
own AS (SELECT * FROM (SELECT * FROM cand UNION SELECT c.* FROM core c SEMI JOIN has USING (sequence_id, frame_idx)) WHERE {ellipse_sql(WIDE_F)}),
voted AS (SELECT DISTINCT sequence_id, frame_idx FROM voters SEMI JOIN frames USING (sequence_id, frame_idx)),
agreed AS (SELECT * FROM (SELECT * FROM vote UNION SELECT c.* FROM core c SEMI JOIN voted USING (sequence_id, frame_idx)) WHERE {ellipse_sql(WIDE_F)}),
iou AS (SELECT sequence_id, frame_idx, count(*) FILTER (o AND a) / count(*) AS iou FROM (
  SELECT sequence_id, frame_idx, y, x, bool_or(k = 'o') AS o, bool_or(k = 'a') AS a FROM (SELECT *, 'o' AS k FROM own UNION ALL SELECT *, 'a' AS k FROM agreed) GROUP BY 1, 2, 3, 4) GROUP BY 1, 2),
size AS (SELECT sequence_id, frame_idx, count(*) AS n FROM (SELECT * FROM own UNION SELECT * FROM agreed) GROUP BY 1, 2),
one AS (SELECT sequence_id, frame_idx, count(*) AS n FROM own GROUP BY 1, 2),
two AS (SELECT sequence_id, frame_idx, count(*) AS n FROM agreed GROUP BY 1, 2),
s AS (SELECT f.*, h.sequence_id IS NOT NULL AS c, v.sequence_id IS NOT NULL AS t, iou, size.n AS both_n, one.n AS own_n, two.n AS vote_n FROM frames f
  LEFT JOIN has h USING (sequence_id, frame_idx) LEFT JOIN voted v USING (sequence_id, frame_idx) LEFT JOIN iou USING (sequence_id, frame_idx)
  LEFT JOIN size USING (sequence_id, frame_idx) LEFT JOIN one USING (sequence_id, frame_idx) LEFT JOIN two USING (sequence_id, frame_idx))
SELECT sequence_id, frame_idx,
  CASE WHEN NOT c AND t THEN 'temporal_median_fallback' WHEN NOT c THEN 'coarse_prior_fallback' WHEN NOT t THEN 'sam2_current'
       WHEN iou < 0.7 THEN 'sam2_current_temporal_disagreement' ELSE 'sam2_current_temporal_regularized' END AS source,
  CASE WHEN c THEN 'generated' ELSE 'fallback' END AS status,
  CASE WHEN NOT c AND t THEN vote_n WHEN NOT c THEN (SELECT count(*) FROM range(8) a(y), range(8) b(x) WHERE {ellipse_sql(WIDE_F)})
       WHEN NOT t OR iou < 0.7 THEN own_n ELSE both_n END AS area FROM s"""
)
def roof_decision(spark, sf_dir):
    df = bridges.masks(spark, sf_dir, ROOF).withColumn("candidate", F.when(F.contains(F.hex("mask"), F.lit("FF")), F.col("mask"))).drop("mask")
    decided = rasters.roof_decisions(df, 2, CORE_F, WIDE_F - CORE_F, 0.7)
    area = (F.char_length(F.hex("roof_mask")) - F.char_length(F.replace(F.hex("roof_mask"), F.lit("F"), F.lit("")))) / 2
    return decided.select(*KEYS, F.col("roof_mask_source").alias("source"), F.col("roof_mask_status").alias("status"), area.cast("long").alias("area"))


MARGIN_SQL = f"""{px_sql('sem', -0.15)}, {px_sql('ref', 0.0)}, {erode_sql('sem', 'core')}, {step_sql('sem', 'wide', False)}"""


@query(f"WITH {CELLS}, {MARGIN_SQL} SELECT * FROM core UNION (SELECT * FROM ref INTERSECT SELECT {PIXELS} FROM wide)")
def sky_combine(spark, sf_dir):
    from orbiscope.functions import kernels

    both = bridges.masks(spark, sf_dir, -0.15, "semantic").join(bridges.masks(spark, sf_dir, 0.0, "refined"), [*KEYS, "height", "width"])
    made = rasters.combine(both, ["semantic", "refined"], lambda s, r: kernels.combine_sky(s, r, 1), "mask")
    return rasters.unpack(made, KEYS)


@query(
    f"""WITH {CELLS}, {px_sql('cand', -0.15)}, {px_sql('block', 0.2)}, {step_sql('block', 'wide', False)},
open AS (SELECT * FROM cand EXCEPT SELECT {PIXELS} FROM wide),
run AS (SELECT {PIXELS} FROM (SELECT *, min(y) OVER (PARTITION BY sequence_id, frame_idx, x) AS f,
  row_number() OVER (PARTITION BY sequence_id, frame_idx, x ORDER BY y) - 1 AS k FROM open) WHERE f < 3 AND y - f = k),
{smooth_sql('run', 's1', False)} SELECT * FROM s1"""
)
def sky_regularise(spark, sf_dir):
    from orbiscope.functions import kernels

    both = bridges.masks(spark, sf_dir, -0.15, "sky").join(bridges.masks(spark, sf_dir, 0.2, "block"), [*KEYS, "height", "width"])
    made = rasters.combine(both, ["sky", "block"], lambda s, b: kernels.regularise_sky("front", s, b, 1, SEED), "mask")
    return rasters.unpack(made, KEYS)


def clean_sql(name: str, source: str, min_area: int) -> str:
    """Fill holes, drop small parts, dilate by one step; the last relation is ``name``."""
    return f"""
{name}_bg AS (SELECT {PIXELS} FROM cell EXCEPT SELECT * FROM {source}),
{name}_reach AS (SELECT * FROM {name}_bg WHERE y IN (0, 7) OR x IN (0, 7)
  UNION SELECT b.* FROM {name}_reach r JOIN {name}_bg b ON b.sequence_id = r.sequence_id AND b.frame_idx = r.frame_idx AND abs(b.y - r.y) + abs(b.x - r.x) = 1),
{name}_full AS (SELECT {PIXELS} FROM cell EXCEPT SELECT * FROM {name}_reach),
{name}_walk(sequence_id, frame_idx, y, x, root) AS (SELECT sequence_id, frame_idx, y, x, y * 8 + x FROM {name}_full
  UNION SELECT q.sequence_id, q.frame_idx, q.y, q.x, w.root FROM {name}_walk w JOIN {name}_full q
    ON q.sequence_id = w.sequence_id AND q.frame_idx = w.frame_idx AND {FOUR}),
{name}_part AS (SELECT sequence_id, frame_idx, y, x, min(root) AS root FROM {name}_walk GROUP BY ALL),
{name}_kept AS (SELECT {PIXELS} FROM (SELECT *, count(*) OVER (PARTITION BY sequence_id, frame_idx, root) AS n FROM {name}_part) WHERE n >= {min_area}),
{step_sql(f'{name}_kept', f'{name}_wide', False)},
{name} AS (SELECT * FROM {name}_wide UNION SELECT a.sequence_id, a.frame_idx + 1, a.y, a.x FROM {name}_wide a JOIN {name}_wide b
  ON a.sequence_id = b.sequence_id AND a.frame_idx + 2 = b.frame_idx AND a.y = b.y AND a.x = b.x)"""


@query(
    f"""WITH RECURSIVE {CELLS}, {DYN_SQL}, {ROOF_SQL}, {SKY_SQL},{clean_sql('dynamic', 'dyn', 3)},{clean_sql('roofs', 'roof', 2)},
{smooth_sql('sky', 'skies', True)},
inpaint AS (SELECT * FROM (SELECT * FROM dynamic UNION SELECT * FROM roofs) EXCEPT SELECT * FROM skies)
SELECT sequence_id, frame_idx, coalesce(d.n, 0) AS dynamic_area, coalesce(r.n, 0) AS roof_area, coalesce(s.n, 0) AS sky_area, coalesce(i.n, 0) AS inpaint_area
FROM frames LEFT JOIN (SELECT sequence_id, frame_idx, count(*) AS n FROM dynamic GROUP BY 1, 2) d USING (sequence_id, frame_idx)
LEFT JOIN (SELECT sequence_id, frame_idx, count(*) AS n FROM roofs GROUP BY 1, 2) r USING (sequence_id, frame_idx)
LEFT JOIN (SELECT sequence_id, frame_idx, count(*) AS n FROM skies GROUP BY 1, 2) s USING (sequence_id, frame_idx)
LEFT JOIN (SELECT sequence_id, frame_idx, count(*) AS n FROM inpaint GROUP BY 1, 2) i USING (sequence_id, frame_idx)"""
)
def fuse_inpaint(spark, sf_dir):
    from orbiscope.plans.stages import fuse_masks

    table = (
        bridges.masks(spark, sf_dir, DYNAMIC, "dynamic")
        .join(bridges.masks(spark, sf_dir, ROOF, "roof"), [*KEYS, "height", "width"])
        .join(bridges.masks(spark, sf_dir, SKY, "sky", True), [*KEYS, "height", "width"])
    )
    settings = config.Config(dyn_min_component_area_px=3, roof_min_component_area_px=2, dyn_dilate_px=1, roof_dilate_px=1)
    fused = fuse_masks(table, settings)
    return fused.select(*KEYS, *[F.col(f"{m}_area_px").alias(f"{m}_area") for m in ("dynamic", "roof", "sky", "inpaint")])


# --- geometry --------------------------------------------------------------------------------------------------------


@query(
    f"""WITH {CELLS}, {DYN_SQL} SELECT sequence_id, frame_idx, y, CAST(x + 3 + 8 * t AS INTEGER) AS x FROM dyn, range(-2, 4) r(t) WHERE x + 3 + 8 * t BETWEEN 0 AND 15"""
)
def wrap_pad(spark, sf_dir):
    return pixels.wrap_pad(_px(spark, sf_dir), SIDE, 3, 5)


@query(
    f"""WITH {CELLS}, {DYN_SQL} SELECT sequence_id, frame_idx, y, CAST(i AS INTEGER) AS x FROM dyn, range(0, 11) r(i) WHERE (i + 6) % 8 = x"""
)
def wrap_crop(spark, sf_dir):
    return pixels.wrap_crop(_px(spark, sf_dir), SIDE, 6, 11)


#: A panorama of 19 x 8 whose faces are 8 x 8 rasters: face size 6, guard band 1.  With these sizes no pixel centre
#: of one lies halfway between two of the other by symmetry, where rounding would depend on a coordinate's last bit.
PANO_W, PANO_H, FACE, GUARD = 19, 8, 6, 1
AXES = {
    "front": ("u", "-v", "1"),
    "right": ("1", "-v", "-u"),
    "back": ("-u", "-v", "-1"),
    "left": ("-1", "-v", "u"),
    "up": ("u", "1", "v"),
    "down": ("u", "-1", "-v"),
}
LOOKUP = (
    f"""g AS (SELECT fy, fx, ((fx + 0.5 - {GUARD}) / {FACE}) * 2 - 1 AS u, ((fy + 0.5 - {GUARD}) / {FACE}) * 2 - 1 AS v
  FROM range(0, {FACE + 2 * GUARD}) a(fy), range(0, {FACE + 2 * GUARD}) b(fx)),
dir AS ("""
    + " UNION ALL ".join(
        f"SELECT {i} AS face_ord, '{f}' AS face, fy, fx, CAST({x} AS DOUBLE) AS dx, CAST({y} AS DOUBLE) AS dy, CAST({z} AS DOUBLE) AS dz FROM g"
        for i, (f, (x, y, z)) in enumerate(AXES.items())
    )
    + f"""),
spot AS (SELECT face_ord, face, fy, fx, (atan2(dx, dz) / (2 * pi()) + 0.5) * {PANO_W} - 0.5 AS px,
  (0.5 - asin(dy / sqrt(dx * dx + dy * dy + dz * dz)) / pi()) * {PANO_H} - 0.5 AS py FROM dir),
lut AS (SELECT CAST(face_ord AS INTEGER) AS face_ord, face, CAST(fy AS INTEGER) AS fy, CAST(fx AS INTEGER) AS fx,
  CAST(least({PANO_H - 1}, greatest(0, round_even(round(py, 4), 0))) AS INTEGER) AS ey,
  CAST((CAST(round_even(round(px, 4), 0) AS INTEGER) + {PANO_W}) % {PANO_W} AS INTEGER) AS ex,
  fy BETWEEN {GUARD} AND {GUARD + FACE - 1} AND fx BETWEEN {GUARD} AND {GUARD + FACE - 1} AS "inner" FROM spot)"""
)
#: The face pixel nearest to every panorama pixel.
PANORAMA_LOOKUP = f"""ang AS (SELECT ey, ex, ((ex + 0.5) / {PANO_W} - 0.5) * 2 * pi() AS lon, (0.5 - (ey + 0.5) / {PANO_H}) * pi() AS lat
  FROM range(0, {PANO_H}) a(ey), range(0, {PANO_W}) b(ex)),
vec AS (SELECT ey, ex, cos(lat) * sin(lon) AS x, sin(lat) AS y, cos(lat) * cos(lon) AS z FROM ang),
dom AS (SELECT *, CASE WHEN abs(x) >= abs(y) AND abs(x) >= abs(z) THEN CASE WHEN x > 0 THEN 'right' ELSE 'left' END
  WHEN abs(y) >= abs(z) THEN CASE WHEN y > 0 THEN 'up' ELSE 'down' END WHEN z > 0 THEN 'front' ELSE 'back' END AS face FROM vec),
uv AS (SELECT ey, ex, face,
  CASE face WHEN 'front' THEN x / z WHEN 'right' THEN -z / x WHEN 'back' THEN x / z WHEN 'left' THEN -z / x WHEN 'up' THEN x / y ELSE x / -y END AS u,
  CASE face WHEN 'front' THEN -y / z WHEN 'right' THEN -y / x WHEN 'back' THEN y / z WHEN 'left' THEN y / x WHEN 'up' THEN z / y ELSE -z / -y END AS v
  FROM dom),
plut AS (SELECT CAST(ey AS INTEGER) AS ey, CAST(ex AS INTEGER) AS ex, face,
  CAST(least({FACE + 2 * GUARD - 1}, greatest(0, round_even((u + 1) / 2 * {FACE} + {GUARD} - 0.5, 0))) AS INTEGER) AS fx,
  CAST(least({FACE + 2 * GUARD - 1}, greatest(0, round_even((v + 1) / 2 * {FACE} + {GUARD} - 0.5, 0))) AS INTEGER) AS fy FROM uv)"""
#: Three neighbouring frames side by side as a panorama, cut at its width.
PANORAMA_PX = f"""pano AS (SELECT sequence_id, CAST(frame_idx // 3 AS INTEGER) AS frame_idx, y, CAST(x + {SIDE} * (frame_idx % 3) AS INTEGER) AS x
  FROM dyn WHERE x + {SIDE} * (frame_idx % 3) < {PANO_W})"""
FACE_TO_PANORAMA = f"""WITH {CELLS}, {DYN_SQL}, {PANORAMA_LOOKUP}
SELECT sequence_id, frame_idx, face, ey AS y, ex AS x FROM dyn JOIN plut ON plut.fy = dyn.y AND plut.fx = dyn.x WHERE face IN ('front', 'up')"""


def _lookup(spark):
    return geometry.face_pixels(spark, PANO_W, PANO_H, FACE, GUARD)


@query(f"WITH {LOOKUP} SELECT * FROM lut")
def face_lookup(spark, sf_dir):
    return _lookup(spark)


@query(f"WITH {PANORAMA_LOOKUP} SELECT * FROM plut")
def panorama_lookup(spark, sf_dir):
    return geometry.panorama_pixels(spark, PANO_W, PANO_H, FACE, GUARD).drop("face_ord")


@query(FACE_TO_PANORAMA)
def face_mask_to_panorama(spark, sf_dir):
    """Each frame's 8 x 8 mask as its front and upper face."""
    face = F.explode(F.array(F.lit("front"), F.lit("up"))).alias("face")
    masks = _masks(spark, sf_dir).select(*KEYS, "mask", face, F.lit(PANO_H).alias("erp_height"), F.lit(PANO_W).alias("erp_width"))
    made = geometry.mask_to_panorama(masks, FACE, GUARD)
    shown = made.select(*KEYS, "face", F.lit(PANO_H).alias("height"), F.lit(PANO_W).alias("width"), F.col("erp_mask").alias("mask"))
    return rasters.unpack(shown, [*KEYS, "face"])


@query(FACE_TO_PANORAMA)
def face_mask_to_panorama_px(spark, sf_dir):
    """The same through the lookup relation."""
    face = F.explode(F.array(F.lit("front"), F.lit("up"))).alias("face")
    lookup = geometry.panorama_pixels(spark, PANO_W, PANO_H, FACE, GUARD)
    px = _px(spark, sf_dir).select(*KEYS, "y", "x", face)
    keyed = px.withColumn("shown", F.col("face"))
    return geometry.face_masks_to_panorama(keyed, lookup, [*KEYS, "shown"], PANO_W * PANO_H).withColumnRenamed("shown", "face")


def _panorama_px(spark, sf_dir):
    """Three neighbouring frames side by side as a panorama, cut at its width."""
    px = _px(spark, sf_dir)
    return px.select(
        "sequence_id",
        F.floor(F.col("frame_idx") / 3).cast("int").alias("frame_idx"),
        "y",
        (F.col("x") + SIDE * (F.col("frame_idx") % 3)).cast("int").alias("x"),
    ).where(F.col("x") < PANO_W)


PANORAMA_TO_FACES = f"""WITH {CELLS}, {DYN_SQL}, {PANORAMA_PX}, {LOOKUP},
shown AS (SELECT sequence_id, frame_idx, face, fy AS y, fx AS x FROM pano JOIN lut ON lut.ey = pano.y AND lut.ex = pano.x)"""


@query(f"{PANORAMA_TO_FACES} SELECT * FROM shown")
def panorama_mask_to_faces(spark, sf_dir):
    rows = len(AXES) * (FACE + 2 * GUARD) ** 2
    return geometry.panorama_mask_to_faces(_panorama_px(spark, sf_dir), _lookup(spark), KEYS, rows)


@query(f"{PANORAMA_TO_FACES} SELECT * FROM shown")
def panorama_mask_to_faces_packed(spark, sf_dir):
    """The same on packed rasters."""
    face = F.explode(F.array(*[F.lit(f) for f in AXES])).alias("face")
    masks = rasters.pack(_panorama_px(spark, sf_dir), KEYS, PANO_H, PANO_W).select("*", face)
    total = FACE + 2 * GUARD
    made = geometry.mask_to_face(masks, FACE, GUARD).drop("mask")
    shown = made.withColumn("width", F.lit(total)).withColumnRenamed("face_mask", "mask")
    return rasters.unpack(shown, [*KEYS, "face"])


@query(
    f"""{PANORAMA_TO_FACES}, {PANORAMA_LOOKUP}
SELECT sequence_id, frame_idx, ey AS y, ex AS x FROM shown JOIN plut ON plut.face = shown.face AND plut.fy = shown.y AND plut.fx = shown.x"""
)
def cubemap_round_trip(spark, sf_dir):
    """Panorama masks on the six faces and back."""
    rows = len(AXES) * (FACE + 2 * GUARD) ** 2
    lookup = geometry.panorama_pixels(spark, PANO_W, PANO_H, FACE, GUARD)
    faces = geometry.panorama_mask_to_faces(_panorama_px(spark, sf_dir), _lookup(spark), KEYS, rows)
    return geometry.face_masks_to_panorama(faces, lookup, KEYS, PANO_W * PANO_H)


SAMPLES = 9  # per axis: x from -1.5 in steps of 1.25 around the seam, y from -0.75 in steps of 1.125


@query(
    f"""WITH {CELLS}, g AS (SELECT sequence_id, frame_idx, y, x, {GRAY} AS gray FROM cell),
s AS (SELECT j, i, i * 1.25 - 1.5 AS raw_x, least(7, greatest(0, j * 1.125 - 0.75)) AS sy FROM range(0, {SAMPLES}) a(j), range(0, {SAMPLES}) b(i)),
t AS (SELECT j, i, raw_x - 8 * floor(raw_x / 8) AS sx, sy FROM s),
c AS (SELECT j, i, CAST(floor(sx) AS INTEGER) AS x0, CAST(floor(sx) + 1 AS INTEGER) % 8 AS x1, sx - floor(sx) AS fx,
  CAST(floor(sy) AS INTEGER) AS y0, least(7, CAST(floor(sy) + 1 AS INTEGER)) AS y1, sy - floor(sy) AS fy FROM t)
SELECT a.sequence_id, a.frame_idx, CAST(j AS INTEGER) AS y, CAST(i AS INTEGER) AS x, CAST(round_even(
  (a.gray * (1 - fx) + b.gray * fx) * (1 - fy) + (d.gray * (1 - fx) + e.gray * fx) * fy, 0) AS INTEGER) AS v
FROM c JOIN g a ON a.y = y0 AND a.x = x0 JOIN g b ON b.y = y0 AND b.x = x1 AND b.sequence_id = a.sequence_id AND b.frame_idx = a.frame_idx
JOIN g d ON d.y = y1 AND d.x = x0 AND d.sequence_id = a.sequence_id AND d.frame_idx = a.frame_idx
JOIN g e ON e.y = y1 AND e.x = x1 AND e.sequence_id = a.sequence_id AND e.frame_idx = a.frame_idx"""
)
def bilinear_samples(spark, sf_dir):
    """Gray values between pixels, columns wrapping and rows clamped."""
    j, i = np.mgrid[:SAMPLES, :SAMPLES]

    def one(gray):
        raster = rasters.view(gray, SIDE, SIDE)
        return (kernels.sample_bilinear(raster, i * 1.25 - 1.5, j * 1.125 - 0.75, wrap_x=True).ravel().tolist(),)

    made = rasters.with_kernel(_gray_rasters(spark, sf_dir, "gray", 1), one, ["gray"], "sampled array<int>").select(*KEYS, F.posexplode("sampled").alias("at", "v"))
    return made.select(*KEYS, F.floor(F.col("at") / SAMPLES).cast("int").alias("y"), (F.col("at") % SAMPLES).alias("x"), "v")


@query(
    f"""WITH {CELLS}, tone AS (SELECT sequence_id, CAST(frame_idx // 6 AS INTEGER) AS frame_idx, CAST(frame_idx % 6 AS INTEGER) AS face_ord, y, x,
  {GRAY} AS gray FROM cell), {LOOKUP}
SELECT sequence_id, frame_idx, ey AS y, ex AS x, CAST(round_even(avg(gray), 0) AS INTEGER) AS v
FROM tone JOIN lut ON lut.face_ord = tone.face_ord AND lut.fy = tone.y AND lut.fx = tone.x GROUP BY ALL"""
)
def feather_splat(spark, sf_dir):
    """Six consecutive frames' gray values as the six faces of one panorama."""
    rows = len(AXES) * (FACE + 2 * GUARD) ** 2
    faces = F.array(*[F.lit(f) for f in AXES])
    values = bridges.values(spark, sf_dir).select(
        "sequence_id",
        F.floor(F.col("frame_idx") / 6).cast("int").alias("frame_idx"),
        F.get(faces, F.col("frame_idx") % 6).alias("face"),
        "y",
        F.col("x").cast("int").alias("x"),
        "v",
    )
    return geometry.splat(values, _lookup(spark), KEYS, FACE, GUARD, 1, rows)


# --- semantic scores -------------------------------------------------------------------------------------------------

#: An embedding read as a segmenter's output: logits of 4 queries for 4 classes and none, then their masks of 3 x 3.
QUERIES_N, CLASSES_N, LOGIT_SIDE, SCORED_SIDE = 4, 4, 3, 6


@query(
    f"""WITH e AS (SELECT vec_id, embedding AS v FROM embeddings),
raw AS (SELECT vec_id, q, c, 8 * CAST(v[q * {CLASSES_N + 1} + c + 1] AS DOUBLE) AS logit FROM e, range(0, {QUERIES_N}) a(q), range(0, {CLASSES_N + 1}) b(c)),
prob AS (SELECT vec_id, q, c, exp(logit) / sum(exp(logit)) OVER (PARTITION BY vec_id, q) AS p FROM raw),
mask AS (SELECT vec_id, q, y, x, 1 / (1 + exp(-8 * CAST(v[{QUERIES_N * (CLASSES_N + 1)} + q * 9 + y * 3 + x + 1] AS DOUBLE))) AS m
  FROM e, range(0, {QUERIES_N}) a(q), range(0, 3) b(y), range(0, 3) d(x)),
small AS (SELECT prob.vec_id, c, y, x, sum(p * m) AS s FROM prob JOIN mask ON mask.vec_id = prob.vec_id AND mask.q = prob.q
  WHERE c < {CLASSES_N} GROUP BY ALL),
ax AS (SELECT i, greatest(0, (i + 0.5) / 2 - 0.5) AS c FROM range(0, {SCORED_SIDE}) a(i)),
tap AS (SELECT i, CAST(floor(c) AS INTEGER) AS k, 1 - (c - floor(c)) AS w FROM ax
  UNION ALL SELECT i, least(2, CAST(floor(c) AS INTEGER) + 1), c - floor(c) FROM ax),
big AS (SELECT vec_id, c, r.i AS y, l.i AS x, sum(s * r.w * l.w) AS s FROM small JOIN tap r ON r.k = small.y JOIN tap l ON l.k = small.x GROUP BY ALL),
best AS (SELECT vec_id, y, x, arg_max(c, s) AS label, max(s) AS top FROM big GROUP BY ALL)
SELECT vec_id, string_agg(CAST(label AS VARCHAR), '' ORDER BY y, x) AS labels, round(avg(top), 5) AS confidence FROM best GROUP BY vec_id"""
)
def semantic_scores(spark, sf_dir):
    """Labels and mean confidence of scores that query logits give at twice their resolution."""

    def one(values):
        v = 8 * np.array(values, np.float64)
        split = QUERIES_N * (CLASSES_N + 1)
        masks = v[split : split + QUERIES_N * LOGIT_SIDE**2].reshape(QUERIES_N, LOGIT_SIDE, LOGIT_SIDE)
        scores = kernels.semantic_scores(v[:split].reshape(QUERIES_N, -1), masks, (SCORED_SIDE, SCORED_SIDE))
        labels, confidence = kernels.labels_and_confidence(scores)
        return "".join(map(str, labels.ravel())), float(np.round(confidence.mean(dtype=np.float64), 5))

    rows = bridges.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rasters.with_kernel(rows, one, ["embedding"], "labels string, confidence double").drop("embedding")


# --- quality ---------------------------------------------------------------------------------------------------------

QA = f"""{FRAMES}, q AS (SELECT *, CASE WHEN NOT file_exists THEN 'skipped' WHEN event_type = 'signup' THEN 'failed' ELSE 'measured' END AS qa_status FROM fr),
m AS (SELECT *, CASE WHEN qa_status = 'measured' THEN value END AS v FROM q)"""


def _measured(spark, sf_dir):
    status = (
        F.when(~F.col("file_exists"), "skipped").when(F.col("event_type") == "signup", "failed").otherwise("measured")
    )
    frames = bridges.frames(spark, sf_dir).withColumn("qa_status", status)
    for i, c in enumerate(("qa_sky_ratio", "qa_dynamic_ratio", "qa_roof_ratio", "qa_inpaint_ratio", "qa_seam_delta_rgb", "qa_seam_delta_alpha")):
        frames = frames.withColumn(c, F.col("value") * (i + 1))
    for c in quality.STAGE_STATUSES.values():
        if c != "qa_status":
            frames = frames.withColumn(c, F.when(F.col("event_type") == "purchase", "failed").otherwise("pending"))
    return frames.withColumn("qa_used_lama_fallback", F.col("event_type") == "click")


@query(
    f"""WITH {QA} SELECT sequence_id, count(*) FILTER (qa_status = 'measured') AS frames_processed, count(*) FILTER (qa_status = 'skipped') AS frames_skipped,
  count(*) FILTER (event_type = 'click') AS frames_with_fallback, round(median(v), 6) AS sky, round(median(v * 2), 6) AS dynamic,
  round(median(v * 3), 6) AS roof, round(median(v * 4), 6) AS inpaint FROM m GROUP BY 1"""
)
def qa_medians(spark, sf_dir):
    found = quality.sequence_metrics(_measured(spark, sf_dir))
    ratios = [F.round(F.col(f"median_mask_ratios.{k}"), 6).alias(k) for k in ("sky", "dynamic", "roof", "inpaint")]
    return found.select("sequence_id", "frames_processed", "frames_skipped", "frames_with_fallback", *ratios)


@query(
    f"""WITH {QA} SELECT sequence_id, round(quantile_cont(v * 5, 0.5), 6) AS p50, round(quantile_cont(v * 5, 0.9), 6) AS p90,
  round(quantile_cont(v * 5, 0.95), 6) AS p95, round(quantile_cont(v * 5, 0.99), 6) AS p99, round(max(v * 5), 6) AS "max" FROM m GROUP BY 1"""
)
def qa_percentiles(spark, sf_dir):
    found = quality.sequence_metrics(_measured(spark, sf_dir))
    return found.select("sequence_id", *[F.round(F.col(f"percentile_seam_errors.rgb.{p}"), 6).alias(p) for p in ("p50", "p90", "p95", "p99", "max")])


@query(
    f"WITH {QA} SELECT sequence_id, "
    + ", ".join(f"count(*) FILTER (event_type = 'purchase') AS {k}" for k in quality.STAGE_STATUSES if k != "qa")
    + ", count(*) FILTER (qa_status = 'failed') AS qa FROM m GROUP BY 1"
)
def stage_failures(spark, sf_dir):
    found = quality.sequence_metrics(_measured(spark, sf_dir))
    return found.select("sequence_id", "failure_counts_by_stage.*")


@query(
    f"""WITH {QA} SELECT sequence_id, CASE WHEN count(*) FILTER (qa_status = 'failed') > 0 THEN 'failed_qa' ELSE 'ready' END AS status,
  CASE WHEN count(*) FILTER (qa_status = 'failed') > 0 THEN count(*) FILTER (qa_status = 'failed') || ' frame(s) failed QA measurement' END AS failure_reason
FROM m GROUP BY 1"""
)
def stage_roll_up(spark, sf_dir):
    return quality.roll_up(_measured(spark, sf_dir), "qa_status", "failed_qa", "QA measurement")


@query(
    f"""WITH {QA} SELECT coalesce(sequence_id, 'all') AS sequence_id, count(*) AS frames, count(*) FILTER (qa_status = 'measured') AS measured,
  count(*) FILTER (qa_status = 'failed') AS failed, round(sum(v), 4) AS total FROM m GROUP BY GROUPING SETS ((sequence_id), ())"""
)
def cli_totals(spark, sf_dir):
    frames = _measured(spark, sf_dir)
    status = F.col("qa_status")
    return (
        frames.rollup("sequence_id")
        .agg(
            F.count("*").alias("frames"),
            *quality.status_counts({n: ("qa_status", n) for n in ("measured", "failed")}),
            F.round(F.sum(F.when(status == "measured", F.col("value"))), 4).alias("total"),
        )
        .withColumn("sequence_id", F.coalesce("sequence_id", F.lit("all")))
    )


@query(
    f"""WITH {CELLS}, g AS (SELECT sequence_id, frame_idx, y, max({GRAY}) FILTER (x = 0) AS l, max({GRAY}) FILTER (x = 7) AS r FROM cell GROUP BY 1, 2, 3)
SELECT sequence_id, frame_idx, round(avg(abs(l - r)), 6) AS seam_delta FROM g GROUP BY 1, 2"""
)
def seam_delta(spark, sf_dir):
    return quality.seam_delta(bridges.values(spark, sf_dir), KEYS, SIDE).withColumn("seam_delta", F.round("seam_delta", 6))


@query(
    f"""WITH RECURSIVE {CELLS}, {DYN_SQL}, {parts_sql('dyn', EIGHT)}, c AS (SELECT sequence_id, frame_idx, count(*) AS area, count(DISTINCT root) AS components FROM part GROUP BY 1, 2),
g AS (SELECT sequence_id, frame_idx, y, max({GRAY}) FILTER (x = 0) AS l, max({GRAY}) FILTER (x = 7) AS r FROM cell GROUP BY 1, 2, 3),
s AS (SELECT sequence_id, frame_idx, avg(abs(l - r)) AS seam FROM g GROUP BY 1, 2)
SELECT sequence_id, frame_idx, printf('%.8f', coalesce(area, 0) / 64.0) AS dynamic_ratio, CAST(coalesce(components, 0) AS INTEGER) AS mask_components_dynamic,
  printf('%.8f', seam) AS seam_delta_rgb FROM s LEFT JOIN c USING (sequence_id, frame_idx)"""
)
def qa_frame_metrics(spark, sf_dir):
    measured = rasters.measures(_masks(spark, sf_dir)).select(*KEYS, "ratio", "components")
    seams = quality.seam_delta(bridges.values(spark, sf_dir), KEYS, SIDE)
    return measured.join(seams, KEYS).select(
        *KEYS,
        exprs.manifest_text(F.col("ratio"), "double").alias("dynamic_ratio"),
        F.col("components").alias("mask_components_dynamic"),
        exprs.manifest_text(F.col("seam_delta"), "double").alias("seam_delta_rgb"),
    )


@query(
    f"""WITH {CELLS}, g AS (SELECT sequence_id, frame_idx, y, x, v, {GRAY} AS gray FROM cell)
SELECT sequence_id, frame_idx, sum(CASE WHEN v > {DYNAMIC} THEN 255 - gray ELSE gray END) AS total, count(*) FILTER (v < {SKY}) AS clear FROM g GROUP BY 1, 2"""
)
def masked_composite(spark, sf_dir):
    """The inverted gray value where the dynamic mask is set; fully transparent where the sky mask is."""
    rgb = _gray_rasters(spark, sf_dir, "rgb", 3)
    marked = _masks(spark, sf_dir).select(*KEYS, "mask")
    sky = _masks(spark, sf_dir, SKY, True).select(*KEYS, F.col("mask").alias("sky"))

    def one(rgb_, mask, sky_):
        original = np.frombuffer(rgb_, np.uint8).reshape(SIDE, SIDE, 3)
        made = kernels.composite(original, 255 - original, rasters.view(mask, SIDE, SIDE))
        return int(made[..., 0].sum(dtype=np.int64)), int(np.count_nonzero(kernels.sky_alpha(rasters.view(sky_, SIDE, SIDE)) == 0))

    joined = rgb.join(marked, KEYS).join(sky, KEYS)
    return rasters.with_kernel(joined, one, ["rgb", "mask", "sky"], "total long, clear long").select(*KEYS, "total", "clear")


@query(
    f"""WITH {PLAN}, s AS (SELECT sequence_id, max("end" - start) AS longest FROM plan GROUP BY 1),
a AS (SELECT sequence_id, CAST(max(value) AS INTEGER) AS largest FROM fr WHERE file_exists GROUP BY 1)
SELECT sequence_id, CASE WHEN sequence_id LIKE '%7' THEN 'force_single_frame_fallback'
  WHEN longest < 24 THEN 'window_length_below_minimum_viable_size(max=' || longest || ', min=24)'
  WHEN largest < 40 THEN 'mask_area_too_small(max=' || largest || ', threshold=40)' ELSE '' END AS reason FROM s JOIN a USING (sequence_id)"""
)
def fallback_reasons(spark, sf_dir):
    longest = _plan(spark, sf_dir).groupBy("sequence_id").agg(F.max(F.col("end") - F.col("start")).alias("longest"))
    largest = (
        bridges.frames(spark, sf_dir).where("file_exists").groupBy("sequence_id").agg(F.rint(F.max("value")).cast("int").alias("largest"))
    )
    reason = exprs.fallback_reason(F.lit(""), F.col("sequence_id").like("%7"), F.col("longest"), F.col("largest"), 24, 40)
    return longest.join(largest, "sequence_id").select("sequence_id", reason.alias("reason"))


# --- state over frames -----------------------------------------------------------------------------------------------


def _prompts(spark, sf_dir):
    """Prompts from line items: one sequence per part brand group, one frame per order."""
    boxes = bridges.detections(spark, sf_dir)
    return boxes.select(
        (F.col("part") % 16).cast("string").alias("sequence_id"),
        F.col("frame").cast("int").alias("frame_idx"),
        F.when(F.col("face") == 5, "down").otherwise("front").alias("face"),
        F.row_number().over(_prompt_order()).alias("prompt_idx"),
        F.when(F.col("cls") == "AF", "roof").when(F.col("cls") == "NO", "sky").otherwise(F.col("cls")).alias("class_text"),
        F.lit("grounding_box").alias("source"),
        "x0",
        "y0",
        "x1",
        "y1",
        "score",
    )


def _prompt_order():
    from pyspark.sql import Window

    return Window.partitionBy(F.col("part") % 16, "frame", F.col("face") == 5).orderBy(F.col("score").desc(), "cls", *TIES)


MAX_GAP = 3
#: The prompts; a segment ends where no later prompt is within the gap, so nothing is carried over its end.
PROMPTS = f"""{BOXES}, ask AS (
  SELECT CAST(part % 16 AS VARCHAR) AS sequence_id, CAST(frame AS INTEGER) AS frame_idx, CASE WHEN face = 5 THEN 'down' ELSE 'front' END AS face,
         CAST(row_number() OVER (PARTITION BY part % 16, frame, face = 5 ORDER BY score DESC, cls, x0, y0, x1, y1, part, supp, line) AS INTEGER) AS prompt_idx,
         CASE cls WHEN 'AF' THEN 'roof' WHEN 'NO' THEN 'sky' ELSE cls END AS cls, x0, y0, x1, y1, score FROM det),
far AS (SELECT *, coalesce(frame_idx - lag(frame_idx) OVER (PARTITION BY sequence_id, face ORDER BY frame_idx, prompt_idx) > {MAX_GAP}, false) AS far FROM ask),
seg AS (SELECT *, sum(CAST(far AS INTEGER)) OVER (PARTITION BY sequence_id, face ORDER BY frame_idx, prompt_idx ROWS UNBOUNDED PRECEDING) AS seg FROM far)"""


def stable_sql(p: str, prior: str) -> str:
    """Whether prompt ``p`` continues ``prior``: a roof below always does, others by overlap and ratio of areas."""
    area = "(greatest({t}.x1 - {t}.x0, 0) * greatest({t}.y1 - {t}.y0, 0))"
    ratio = f"{area.format(t=p)} / greatest(1.0, {area.format(t=prior)})"
    return f"({p}.face = 'down' AND {p}.cls = 'roof' OR {iou_sql(p, prior)} >= 0.45 AND {ratio} BETWEEN 0.5 AND 2.0)"


#: A fold over a face's frames.  State: the last prompt of each class and source, and all rows so far.
MEMORY = f"""WITH {PROMPTS},
f AS (SELECT sequence_id, face, seg, frame_idx, list({{'cls': cls, 'src': 'grounding_box', 'face': face, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1, 'score': score}}
  ORDER BY prompt_idx) AS asked FROM seg GROUP BY ALL),
folded AS (SELECT sequence_id, face, seg, list_reduce(list({{'frame': frame_idx, 'asked': asked}} ORDER BY frame_idx), lambda s, p:
  list_transform([list_concat(
      list_transform(p.asked, lambda q: {{'frame': p.frame, 'cls': q.cls, 'src': q.src, 'x0': q.x0, 'y0': q.y0, 'x1': q.x1, 'y1': q.y1, 'score': q.score,
        'used': len(list_filter(s.last, lambda l: l.cls = q.cls AND l.src = q.src AND p.frame - l.frame <= {MAX_GAP} AND {stable_sql('q', 'l')})) > 0}}),
      list_transform(list_filter(s.last, lambda l: l.cls IN ('roof', 'sky') AND p.frame - l.frame <= {MAX_GAP}
          AND NOT (l.src = 'grounding_box' AND len(list_filter(p.asked, lambda q: q.cls = l.cls)) > 0)),
        lambda l: {{'frame': p.frame, 'cls': l.cls, 'src': 'temporal_prior', 'x0': l.x0, 'y0': l.y0, 'x1': l.x1, 'y1': l.y1, 'score': l.score, 'used': true}}))],
    lambda rows: {{
      'last': list_concat(
        list_transform(s.last, lambda l: coalesce(list_filter(rows, lambda r: r.cls = l.cls AND r.src = l.src)[-1], l)),
        list_filter(rows, lambda r, i: len(list_filter(s.last, lambda l: l.cls = r.cls AND l.src = r.src)) = 0
          AND len(list_filter(rows[i + 1:], lambda later: later.cls = r.cls AND later.src = r.src)) = 0)),
      'rows': list_concat(s.rows, rows)}})[1],
  {{'last': CAST([] AS STRUCT(frame INTEGER, cls VARCHAR, src VARCHAR, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, score DOUBLE, used BOOLEAN)[]),
    'rows': CAST([] AS STRUCT(frame INTEGER, cls VARCHAR, src VARCHAR, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, score DOUBLE, used BOOLEAN)[])}}) AS s
  FROM f GROUP BY ALL)
SELECT sequence_id, r.frame AS frame_idx, face, r.cls AS class_text, r.src AS source, r.x0 AS x0, r.y0 AS y0, r.x1 AS x1, r.y1 AS y1, r.score AS score,
       r.used AS used_temporal_prior FROM (SELECT sequence_id, face, unnest(s.rows) AS r FROM folded)"""


@query(MEMORY)
def temporal_memory(spark, sf_dir):
    return tracking.attach_priors(_prompts(spark, sf_dir), config.Config(sam2_temporal_max_gap=MAX_GAP))


#: A fold over a face's prompts.  A track has the box and frame that it is matched by, and (n...) those that hold from
#: the next frame on.
TRACKS = f"""WITH {PROMPTS},
folded AS (SELECT sequence_id, face, seg, list_reduce(
  list({{'frame': frame_idx, 'prompt': prompt_idx, 'face': face, 'cls': cls, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}} ORDER BY frame_idx, prompt_idx),
  lambda s, p: list_transform([CASE WHEN p.frame = s.frame THEN s.tracks ELSE list_filter(
      list_transform(s.tracks, lambda t: {{'id': t.id, 'cls': t.cls, 'x0': t.nx0, 'y0': t.ny0, 'x1': t.nx1, 'y1': t.ny1, 'seen': t.nseen,
        'nx0': t.nx0, 'ny0': t.ny0, 'nx1': t.nx1, 'ny1': t.ny1, 'nseen': t.nseen, 'used': false}}), lambda t: p.frame - t.seen <= {MAX_GAP}) END],
    lambda live: list_transform([list_sort(list_transform(
        list_filter(live, lambda t: NOT t.used AND t.cls = p.cls AND {iou_sql('p', 't')} > 0),
        lambda t: {{'worse': -({iou_sql('p', 't')}), 'id': t.id, 'ok': {stable_sql('p', 't')}}}))[1]],
      lambda b: {{
        'frame': p.frame,
        'next': CASE WHEN coalesce(b.ok, false) THEN s.next ELSE s.next + 1 END,
        'tracks': CASE WHEN coalesce(b.ok, false) THEN list_transform(live, lambda t: CASE WHEN t.id <> b.id THEN t ELSE
            {{'id': t.id, 'cls': t.cls, 'x0': t.x0, 'y0': t.y0, 'x1': t.x1, 'y1': t.y1, 'seen': t.seen,
              'nx0': p.x0, 'ny0': p.y0, 'nx1': p.x1, 'ny1': p.y1, 'nseen': p.frame, 'used': true}} END)
          ELSE list_append(live, {{'id': s.next, 'cls': p.cls, 'x0': p.x0, 'y0': p.y0, 'x1': p.x1, 'y1': p.y1, 'seen': p.frame,
              'nx0': p.x0, 'ny0': p.y0, 'nx1': p.x1, 'ny1': p.y1, 'nseen': p.frame, 'used': false}}) END,
        'rows': list_append(s.rows, {{'frame': p.frame, 'prompt': p.prompt, 'cls': p.cls,
          'track': CASE WHEN coalesce(b.ok, false) THEN b.id ELSE s.next END, 'reused': coalesce(b.ok, false)}})}})[1])[1],
  {{'frame': -1, 'next': 1, 'tracks': CAST([] AS STRUCT(id INTEGER, cls VARCHAR, x0 DOUBLE, y0 DOUBLE, x1 DOUBLE, y1 DOUBLE, seen INTEGER,
      nx0 DOUBLE, ny0 DOUBLE, nx1 DOUBLE, ny1 DOUBLE, nseen INTEGER, used BOOLEAN)[]),
    'rows': CAST([] AS STRUCT(frame INTEGER, prompt INTEGER, cls VARCHAR, track INTEGER, reused BOOLEAN)[])}}) AS s
  FROM seg GROUP BY sequence_id, face, seg),
placed AS (SELECT sequence_id, face, s.rows AS rows,
  coalesce(sum(s.next - 1) OVER (PARTITION BY sequence_id, face ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM folded)
SELECT sequence_id, r.frame AS frame_idx, face, r.prompt AS prompt_idx, r.cls AS class_text, 'grounding_box' AS source,
       CAST(r.track + before AS INTEGER) AS track_id, r.reused AS reused FROM (SELECT sequence_id, face, before, unnest(rows) AS r FROM placed)"""


@query(TRACKS)
def track_assign(spark, sf_dir):
    return tracking.assign_tracks(_prompts(spark, sf_dir), config.Config(sam2_temporal_max_gap=MAX_GAP))
