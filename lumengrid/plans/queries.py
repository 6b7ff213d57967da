"""Every operator as a query on the star schema's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import media, stats
from ..model import PROFILES, REFERENCE, cameras
from ..operators import calibration, export_qa, provenance, roi, segments, signals, sync
from ..sources import exports, files, tolerant
from ..streaming import robust, watch
from . import preflight
from .proxies import oracle, proxy

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name; @name@ in the SQL is a proxy."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            from .proxies import PROXIES

            text = sql
            for name in sorted(PROXIES, key=len, reverse=True):
                text = text.replace(f"@{name}@", oracle(name))
            ORACLE[f.__name__] = text
        return f

    return keep


GRID = "(SELECT concat('CAM_', substr('ABCDE', CAST(floor(i / 5) AS INT) + 1, 1), CAST(i % 5 + 1 AS VARCHAR)) AS camera_id, CAST(i AS INT) AS view_index FROM range(25) g(i))"
GRID_CAMERA = "concat('CAM_', substr('ABCDE', CAST(floor({0} / 5) AS INT) + 1, 1), CAST({0} % 5 + 1 AS VARCHAR))"
SCORED = """(SELECT *, abs(offset_ms) AS abs_offset_ms, abs(offset_ms - scene_median) / greatest(scene_mad * CAST(1.4826 AS DOUBLE), CAST(1e-6 AS DOUBLE)) AS scene_z, abs(offset_ms - camera_median) / greatest(camera_mad * CAST(1.4826 AS DOUBLE), CAST(1e-6 AS DOUBLE)) AS camera_z
 FROM (SELECT *, median(abs(offset_ms - scene_median)) OVER (PARTITION BY scene) AS scene_mad, median(abs(offset_ms - camera_median)) OVER (PARTITION BY camera_id) AS camera_mad
 FROM (SELECT scene, camera_id, view_index, offset_ms, median(offset_ms) OVER (PARTITION BY scene) AS scene_median, median(offset_ms) OVER (PARTITION BY camera_id) AS camera_median FROM @manifest@ m) a) b)"""
FLAGS = "concat_ws(';', CASE WHEN scene_z >= 6 THEN 'scene_outlier' END, CASE WHEN camera_z >= 6 THEN 'camera_unstable_outlier' END, CASE WHEN abs_offset_ms >= 600 THEN 'abs_fail' WHEN abs_offset_ms >= 300 THEN 'abs_warn' END)"

# ---- synchronisation


@query(f"""SELECT scene, camera_id, offset_ms, scene_median, scene_z, camera_median, camera_z, {FLAGS} AS flags FROM {SCORED} s WHERE {FLAGS} <> ''
 ORDER BY CASE WHEN abs_offset_ms >= 600 THEN 0 ELSE 1 END, abs_offset_ms DESC, scene, view_index""")
def sync_flagged(spark, d):
    return sync.flagged(proxy(spark, d, "manifest")).select("scene", "camera_id", "offset_ms", "scene_median", "scene_z", "camera_median", "camera_z", F.array_join("flags", ";").alias("flags"))


@query(f"SELECT scene, camera_id, scene_mad, camera_mad, scene_z, camera_z, {FLAGS} AS flags FROM {SCORED} s")
def sync_scores(spark, d):
    return sync.scored(proxy(spark, d, "manifest")).select("scene", "camera_id", "scene_mad", "camera_mad", "scene_z", "camera_z", F.array_join("flags", ";").alias("flags"))


@query(f"""WITH m AS (SELECT scene, camera_id, TRY_CAST(offset_text AS DOUBLE) AS offset_ms FROM @raw_manifest@ r)
SELECT * FROM (SELECT s.scene, g.camera_id, CASE WHEN m.scene IS NULL THEN 'missing_camera_offset' WHEN m.offset_ms IS NULL THEN 'invalid_offset_ms' WHEN g.camera_id = 'CAM_C3' AND abs(m.offset_ms) > 1e-6 THEN 'reference_offset_not_zero' END AS reason
FROM (SELECT DISTINCT scene FROM m) s CROSS JOIN {GRID} g LEFT JOIN m ON m.scene = s.scene AND m.camera_id = g.camera_id) WHERE reason IS NOT NULL""")
def sync_missing(spark, d):
    return sync.missing(_raw_offsets(spark, d))


def _raw_offsets(spark, d):
    return proxy(spark, d, "raw_manifest").withColumn("offset_ms", F.col("offset_text").try_cast("double"))


@query("""WITH m AS (SELECT scene, camera_id, TRY_CAST(offset_text AS DOUBLE) AS offset_ms FROM @raw_manifest@ r)
SELECT s.scene, r.offset_ms FROM (SELECT DISTINCT scene FROM m) s LEFT JOIN (SELECT * FROM m WHERE camera_id = 'CAM_C3') r USING (scene) WHERE r.offset_ms IS NULL OR r.offset_ms <> 0""")
def sync_reference_violations(spark, d):
    return sync.reference_violations(_raw_offsets(spark, d))


@query("""SELECT camera_id, count(*) AS n, any_value(m) AS median_ms, min(offset_ms) AS min_ms, max(offset_ms) AS max_ms, max(offset_ms) - min(offset_ms) AS range_ms, median(abs(offset_ms - m)) AS mad_ms
FROM (SELECT *, median(offset_ms) OVER (PARTITION BY camera_id) AS m FROM @manifest@ x) GROUP BY camera_id""")
def sync_camera_stats(spark, d):
    return sync.camera_stats(proxy(spark, d, "manifest"))


@query("""SELECT camera_id, range_ms FROM (SELECT camera_id, max(offset_ms) - min(offset_ms) AS range_ms FROM @manifest@ x GROUP BY camera_id) ORDER BY range_ms DESC, camera_id LIMIT 10""")
def sync_widest_cameras(spark, d):
    return sync.camera_stats(proxy(spark, d, "manifest")).select("camera_id", "range_ms").orderBy(F.desc("range_ms"), "camera_id").limit(10)


@query("SELECT scene, camera_id, offset_ms, abs(offset_ms) AS abs_offset_ms FROM @manifest@ m ORDER BY abs(offset_ms) DESC, scene, camera_id LIMIT 40")
def sync_top_offsets(spark, d):
    return sync.top_offsets(proxy(spark, d, "manifest").select("scene", "camera_id", "offset_ms"))


@query("""WITH m AS (SELECT scene, camera_id, TRY_CAST(offset_text AS DOUBLE) AS offset_ms FROM @raw_manifest@ r), g AS (SELECT *, median(offset_ms) OVER (PARTITION BY camera_id) AS cm FROM m WHERE offset_ms IS NOT NULL),
z AS (SELECT scene, camera_id, offset_ms, abs(offset_ms - cm) / greatest(median(abs(offset_ms - cm)) OVER (PARTITION BY camera_id) * CAST(1.4826 AS DOUBLE), CAST(1e-6 AS DOUBLE)) AS z FROM g),
b AS (SELECT scene, camera_id FROM z WHERE abs(offset_ms) >= 300 OR z >= 6 UNION SELECT scene, camera_id FROM m WHERE offset_ms IS NULL)
SELECT scene, string_agg(camera_id, ',' ORDER BY camera_id) AS cameras FROM b GROUP BY scene""")
def sync_review_map(spark, d):
    return sync.review_map(_raw_offsets(spark, d)).select("scene", F.array_join("cameras", ",").alias("cameras"))


@query("SELECT scene, count(DISTINCT camera_id) AS n_cameras FROM @manifest@ m GROUP BY scene HAVING count(DISTINCT camera_id) = 25")
def sync_complete_scenes(spark, d):
    return sync.complete_scenes(proxy(spark, d, "manifest"))


@query("""SELECT scene, camera_id, CASE WHEN missing THEN 'missing' WHEN audio_failed THEN 'audio_failed' WHEN manual THEN 'manual' WHEN review THEN 'review' WHEN aligned THEN 'aligned' ELSE 'unaligned' END AS status FROM @state@ s""")
def sync_camera_status(spark, d):
    return sync.camera_status(proxy(spark, d, "state")).select("scene", "camera_id", "status")


@query("""WITH k AS (SELECT DISTINCT p_brand AS key FROM part UNION SELECT DISTINCT lower(p_brand) FROM part WHERE p_partkey % 3 = 0), n AS (SELECT DISTINCT upper(p_brand) AS name FROM part UNION SELECT DISTINCT p_type FROM part)
SELECT n.name, coalesce(e.key, l.key, n.name) AS key FROM n LEFT JOIN k e ON e.key = n.name LEFT JOIN (SELECT lower(key) AS low, min(key) AS key FROM k GROUP BY 1) l ON l.low = lower(n.name)""")
def sync_manifest_keys(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet")
    keys = part.select(F.col("p_brand").alias("key")).union(part.where("p_partkey % 3 = 0").select(F.lower("p_brand"))).distinct()
    names = part.select(F.upper("p_brand").alias("name")).union(part.select("p_type")).distinct()
    return sync.manifest_keys(names, keys)


@query("""WITH p AS (SELECT scene, camera_id, CAST(60000 + offset_ms * 48 AS BIGINT) AS peak FROM @manifest@ m)
SELECT p.scene, p.camera_id, CASE WHEN p.camera_id = 'CAM_C3' THEN 0 ELSE p.peak - r.peak END / CAST(48000 AS DOUBLE) * 1000 AS offset_ms, CAST(round_even(CASE WHEN p.camera_id = 'CAM_C3' THEN 0 ELSE p.peak - r.peak END / CAST(48000 AS DOUBLE) * CAST(59.94 AS DOUBLE), 0) AS BIGINT) AS frame_shift
FROM p JOIN p r ON r.scene = p.scene AND r.camera_id = 'CAM_C3'""")
def sync_offsets_from_peaks(spark, d):
    peaks = proxy(spark, d, "manifest").select("scene", "camera_id", F.rint(F.lit(60000) + F.col("offset_ms") * 48).cast("long").alias("peak"))
    return sync.offsets_from_peaks(peaks)


@query("SELECT scene, camera_id, CAST(round_even((CAST(1.25 AS DOUBLE) + offset_ms / 1000) * 48000, 0) AS BIGINT) AS peak FROM @manifest@ m")
def sync_saved_peaks(spark, d):
    return proxy(spark, d, "manifest").select("scene", "camera_id", media.saved_peak(F.lit(1.25), F.col("offset_ms"), 48_000).alias("peak"))


# ---- clips and segments

T0 = "(clap + offset_ms / 1000 + CAST(1.5 AS DOUBLE))"


@query(f"""SELECT video, camera_id, frame, frame * (1 / CAST(59.94 AS DOUBLE)) AS cut, (frame * (1 / CAST(59.94 AS DOUBLE)) - {T0}) * 1000 AS phase_error_ms
FROM (SELECT *, CAST(round_even({T0} * CAST(59.94 AS DOUBLE), 0) AS BIGINT) AS frame FROM @clips@ c)""")
def clip_starts(spark, d):
    return sync.clip_starts(proxy(spark, d, "clips")).select("video", "camera_id", "frame", "cut", "phase_error_ms")


@query(f"""WITH c AS (SELECT video, duration - CAST(round_even({T0} * CAST(59.94 AS DOUBLE), 0) AS BIGINT) * (1 / CAST(59.94 AS DOUBLE)) AS rest FROM @clips@ c WHERE duration > 0)
SELECT video, min(rest) - CAST(0.1 AS DOUBLE) AS common_duration FROM c WHERE rest > 0 GROUP BY video HAVING min(rest) - CAST(0.1 AS DOUBLE) >= 1""")
def clip_common_durations(spark, d):
    return sync.common_durations(sync.clip_starts(proxy(spark, d, "clips")).withColumn("start", F.col("cut")))


SEGMENTS = """(SELECT scene, 0 AS segment_index, 1 AS segment_count, CAST(0 AS DOUBLE) AS "start", CAST(30000 AS DOUBLE) AS "end" FROM @days@ d WHERE n % 4 = 1
 UNION ALL SELECT scene, 0, 2, 100.5, 40000 FROM @days@ d WHERE n % 4 = 2 UNION ALL SELECT scene, 1, 2, 50000, 60000 FROM @days@ d WHERE n % 4 = 2 UNION ALL SELECT scene, 0, 1, 0, 86400 FROM @days@ d WHERE n % 4 = 3)"""


def _segments(spark, d):
    n = F.col("n") % 4
    value = F.when(n == 0, '"del"').when(n == 1, "[0, 30000]").when(n == 2, "[[100.5, 40000], [50000, 60000]]").otherwise(" [[0,86400]]")
    return segments.parse_segments(proxy(spark, d, "days").select("scene", value.alias("value")))


@query(f"SELECT scene, segment_index, segment_count, \"start\", \"end\" FROM {SEGMENTS} s")
def segment_scan(spark, d):
    return _segments(spark, d)


@query(f"""SELECT scene, segment_index, CASE WHEN segment_count > 1 THEN scene || '_seg' || lpad(CAST(segment_index + 1 AS VARCHAR), 2, '0') ELSE scene END AS export_scene FROM {SEGMENTS} s JOIN (SELECT DISTINCT scene FROM @manifest@ m) m USING (scene)""")
def segment_scenes(spark, d):
    return segments.scene_segments(proxy(spark, d, "manifest").select("scene").distinct(), _segments(spark, d)).select("scene", "segment_index", "export_scene")


@query(f"""SELECT s.scene, s.segment_index, g.camera_id, 'view_' || lpad(CAST(g.view_index AS VARCHAR), 2, '0') AS view_id, m.offset_ms AS phase_offset_ms, CASE WHEN m.offset_ms IS NULL THEN 'missing_phase_offset' ELSE 'ok' END AS phase_status FROM {SEGMENTS} s CROSS JOIN {GRID} g LEFT JOIN @manifest@ m ON m.scene = s.scene AND m.camera_id = g.camera_id""")
def export_tasks(spark, d):
    tasks = segments.export_tasks(_segments(spark, d))
    return segments.with_phases(tasks, proxy(spark, d, "manifest"), strict=False).select("scene", "segment_index", "camera_id", "view_id", "phase_offset_ms", "phase_status")


@query(f"""SELECT s.scene, s.segment_index, g.camera_id FROM {SEGMENTS} s CROSS JOIN {GRID} g WHERE NOT EXISTS (SELECT 1 FROM @manifest@ m WHERE m.scene = s.scene AND m.camera_id = g.camera_id AND m.offset_ms > -400)""")
def export_tasks_without_video(spark, d):
    return segments.unmatched_tasks(segments.export_tasks(_segments(spark, d)), proxy(spark, d, "manifest").where("offset_ms > -400")).select("scene", "segment_index", "camera_id")


@query(f"""SELECT f.scene, s.segment_index, f.camera_id, f.frame_index, row_number() OVER (PARTITION BY f.scene, s.segment_index, f.camera_id ORDER BY f.t, f.frame_index) AS out_frame FROM @frames@ f JOIN {SEGMENTS} s ON s.scene = f.scene AND f.t BETWEEN s."start" AND s."end" """)
def frames_in_segments(spark, d):
    return segments.frames_in_segments(proxy(spark, d, "frames"), _segments(spark, d)).select("scene", "segment_index", "camera_id", "frame_index", "out_frame")


# ---- regions


@query("SELECT max(x) AS x, max(y) AS y, min(x + w) - max(x) AS width, min(y + h) - max(y) AS height FROM @rects@ r")
def roi_intersection(spark, d):
    return roi.intersection(proxy(spark, d, "rects"))


CROP = """(SELECT *, least(w // 16, h // 9) AS s FROM @rects@ r)"""


@query(f"""SELECT *, crop_x >= x AND crop_y >= y AND crop_x + crop_w <= x + w AND crop_y + crop_h <= y + h AS crop_inside, crop_w * 9 = crop_h * 16 AS crop_exact, crop_x >= 30 AND crop_y >= 12 AND crop_x + crop_w <= 1030 AND crop_y + crop_h <= 572 AS in_region, w * 9 = h * 16 AS rect_exact
 FROM (SELECT key, x, y, w, h, x + (w - s * 16) // 2 AS crop_x, y + (h - s * 9) // 2 AS crop_y, s * 16 AS crop_w, s * 9 AS crop_h FROM {CROP} c) z""")
def roi_crops(spark, d):
    rects = proxy(spark, d, "rects").select("key", "x", "y", "w", "h", media.rect(F.col("x"), F.col("y"), F.col("w"), F.col("h")).alias("rect"))
    out = roi.crops(rects).withColumns({"in_region": media.inside(F.col("crop"), media.rect(F.lit(30), F.lit(12), F.lit(1000), F.lit(560))), "rect_exact": media.is_16_9(F.col("rect"))})
    return out.select("key", "x", "y", "w", "h", F.col("crop.x").alias("crop_x"), F.col("crop.y").alias("crop_y"), F.col("crop.width").alias("crop_w"), F.col("crop.height").alias("crop_h"), "crop_inside", "crop_exact", "in_region", "rect_exact")


@query(f"""SELECT key, CASE WHEN x >= 20 AND y >= 10 THEN x - 20 END AS rel_x, CASE WHEN x >= 20 AND y >= 10 THEN y - 10 END AS rel_y FROM @rects@ r""")
def roi_relative_crops(spark, d):
    r = proxy(spark, d, "rects").withColumn("rel", media.relative_crop(media.rect(F.col("x"), F.col("y"), F.col("w"), F.col("h")), media.rect(F.lit(20), F.lit(10), F.lit(900), F.lit(500))))
    return r.select("key", F.col("rel.x").alias("rel_x"), F.col("rel.y").alias("rel_y"))


def _maps(spark, rects):
    """A map of 48 x 32 pixels for each rectangle."""
    own = rects.select("camera_id", "key", F.explode(F.sequence(F.lit(0), F.lit(48 * 32 - 1))).alias("i"))
    s = own.select("camera_id", "key", F.expr("cast(i div 48 as int)").alias("y"), F.expr("cast(i % 48 as int)").alias("x"))
    return s.select("camera_id", "key", "y", "x", (F.col("x") + F.col("key") % 5 * 0.75 - 1.5).alias("map_x"), (F.col("y") + F.col("key") % 7 * 0.5 - 1.5).alias("map_y"))


@query("""SELECT CASE WHEN count(*) = 0 OR count_if(black_ratio > 0.01) > 0 THEN 'fail' WHEN count_if(black_ratio <= 0.01 AND near_ratio > 0.03) > 0 THEN 'warning' ELSE 'pass' END AS status, count_if(black_ratio > CAST(0.01 AS DOUBLE)) AS n_fail, count_if(black_ratio <= CAST(0.01 AS DOUBLE) AND near_ratio > CAST(0.03 AS DOUBLE)) AS n_warning FROM @border@ b""")
def roi_verdict(spark, d):
    return roi.verdict(proxy(spark, d, "border"))


@query("SELECT scene, camera_id, frame_index, black_ratio, near_ratio FROM @border@ b ORDER BY black_ratio DESC, near_ratio DESC, scene, camera_id, frame_index LIMIT 10")
def roi_worst_samples(spark, d):
    return export_qa.worst_of_batch(proxy(spark, d, "border").select("scene", "camera_id", "frame_index", "black_ratio", "near_ratio"), 10)


# ---- sampling and scalar expressions


@query("""SELECT n, k, array_to_string(list_sort(list_distinct(CASE WHEN n <= 0 OR k <= 0 THEN [] WHEN k = 1 THEN [0] ELSE list_transform(range(k), lambda i: CAST(round_even(CASE WHEN i = k - 1 THEN CAST(n - 1 AS DOUBLE) ELSE i * (CAST(n - 1 AS DOUBLE) / (k - 1)) END, 0) AS INT)) END)), ',') AS frames
FROM (SELECT DISTINCT CAST(p_partkey % 130 AS INT) AS n FROM part) CROSS JOIN (VALUES (0), (1), (3), (9)) t(k)""")
def sample_even(spark, d):
    n = spark.read.parquet(f"{d}/part.parquet").select((F.col("p_partkey") % 130).cast("int").alias("n")).distinct()
    k = F.explode(F.array(F.lit(0), F.lit(1), F.lit(3), F.lit(9))).alias("k")
    return n.select("n", k).select("n", "k", F.array_join(media.even_samples(F.col("n"), F.col("k")), ",").alias("frames"))


@query("""SELECT n, array_to_string(CASE WHEN 5 > n - 1 THEN [] ELSE range(5, n, 59) END[1:8], ',') AS frames FROM (SELECT DISTINCT CAST(p_partkey % 700 AS INT) AS n FROM part)""")
def sample_strided(spark, d):
    n = spark.read.parquet(f"{d}/part.parquet").select((F.col("p_partkey") % 700).cast("int").alias("n")).distinct()
    return n.select("n", F.array_join(media.strided_samples(F.col("n"), F.lit(0.1), F.lit(1.0), F.lit(59.94), F.lit(8)), ",").alias("frames"))


@query(f"""SELECT scene, segment_index, position, CASE position WHEN 'start' THEN "start" WHEN 'middle' THEN "start" + ("end" - "start") * CAST(0.5 AS DOUBLE) ELSE greatest("start", "end" - least(CAST(0.05 AS DOUBLE), ("end" - "start") * CAST(0.01 AS DOUBLE))) END AS t FROM {SEGMENTS} s CROSS JOIN (VALUES ('start'), ('middle'), ('end')) p(position)""")
def sample_positions(spark, d):
    p = F.explode(F.array(F.lit("start"), F.lit("middle"), F.lit("end"))).alias("position")
    return _segments(spark, d).select("scene", "segment_index", "start", "end", p).select("scene", "segment_index", "position", media.position_time(F.col("start"), F.col("end"), F.col("position")).alias("t"))


@query("""SELECT v, CAST(least(greatest(round_even(v / CAST(257 AS DOUBLE), 0), 0), 255) AS INT) AS as_8_bit, CAST(v % 256 * 257 AS INT) AS as_16_bit FROM (SELECT DISTINCT CAST(l_partkey * 7 % 65536 AS INT) AS v FROM lineitem)""")
def bit_depth(spark, d):
    v = spark.read.parquet(f"{d}/lineitem.parquet").select((F.col("l_partkey") * 7 % 65536).cast("int").alias("v")).distinct()
    return v.select("v", media.to_8_bit(F.col("v")).alias("as_8_bit"), media.to_16_bit(F.col("v") % 256).alias("as_16_bit"))


@query(f"SELECT s_suppkey, g.camera_id, view_index, 'view_' || lpad(CAST(view_index AS VARCHAR), 2, '0') AS view_id, substr(g.camera_id, 5, 1) AS \"row\", CAST(substr(g.camera_id, 6, 1) AS INT) AS col FROM supplier JOIN {GRID} g ON g.view_index = s_suppkey % 25")
def camera_grid(spark, d):
    """The camera of each supplier, by its place in the grid."""
    own = spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", media.camera_of((F.col("s_suppkey") % 25).cast("int")).alias("camera_id"))
    return own.join(F.broadcast(cameras(spark)), "camera_id").select("s_suppkey", "camera_id", media.view_index(F.col("camera_id")).alias("view_index"), media.view_id(F.col("camera_id")).alias("view_id"), "row", "col")


@query("SELECT p_name, regexp_replace(p_name || '.' || p_size || '.MP4', '(.)\\.[^.]*$', '\\1') AS scene FROM part")
def scene_ids(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select("p_name", media.scene_id(F.concat("p_name", F.lit("."), "p_size", F.lit(".MP4"))).alias("scene"))


@query("""SELECT s_suppkey, s_suppkey % 3 = 0 AS enabled, CASE WHEN s_suppkey % 3 = 0 THEN 'lut' END AS policy_name, CASE WHEN s_suppkey % 3 = 0 THEN 'log' END AS source_color_space, CASE WHEN s_suppkey % 3 = 0 THEN 'rec709' END AS target_color_space,
 CASE WHEN s_suppkey % 3 = 0 THEN s_name END AS lut_file, CASE WHEN s_suppkey % 3 = 0 THEN '/luts/' || s_name END AS lut_path, CASE WHEN s_suppkey % 3 = 0 THEN sha256(s_name) END AS lut_checksum, CASE WHEN s_suppkey % 3 = 0 THEN substr(sha256(s_name), 1, 16) END AS lut_asset_version FROM supplier""")
def colour_metadata(spark, d):
    checksum = F.sha2("s_name", 256)
    c = media.colour_standardisation(F.col("s_suppkey") % 3 == 0, F.lit("lut"), F.lit("log"), F.lit("rec709"), F.col("s_name"), F.concat(F.lit("/luts/"), "s_name"), checksum, F.substring(checksum, 1, 16))
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", c.alias("c")).select("s_suppkey", "c.*")


# ---- export checks


@query("""WITH v AS (SELECT *, CASE WHEN NOT dir_exists THEN 'missing_view_dir' WHEN NOT has_view_metadata THEN 'missing_view_metadata' WHEN frame_files <= 0 THEN 'empty_view' ELSE 'ok' END AS state FROM @inventory@ i),
s AS (SELECT scene, coalesce(string_agg(CASE WHEN state = 'missing_view_dir' THEN camera_id END, ',' ORDER BY camera_id), '') AS missing_view_dirs, coalesce(string_agg(CASE WHEN in_progress AND dir_exists THEN camera_id END, ',' ORDER BY camera_id), '') AS in_progress_markers,
 coalesce(string_agg(CASE WHEN state = 'missing_view_metadata' THEN camera_id END, ',' ORDER BY camera_id), '') AS missing_view_metadata, coalesce(string_agg(CASE WHEN state = 'empty_view' THEN camera_id END, ',' ORDER BY camera_id), '') AS empty_views,
 count(DISTINCT CASE WHEN state = 'ok' THEN width * 10000 + height END) <= 1 AS resolution_consistent, count(DISTINCT CASE WHEN state = 'ok' THEN frame_files END) <= 1 AS frame_count_consistent FROM v GROUP BY scene)
SELECT *, CAST(missing_view_dirs <> '' AS INT) + CAST(in_progress_markers <> '' AS INT) + CAST(missing_view_metadata <> '' AS INT) + CAST(empty_views <> '' AS INT) + CAST(NOT resolution_consistent AS INT) + CAST(NOT frame_count_consistent AS INT) AS n_errors FROM s""")
def export_structure(spark, d):
    return export_qa.structure(proxy(spark, d, "inventory"))


STATES = f"""(SELECT scene, count(*) FILTER (d) AS n_views, CASE WHEN bool_or(has_metadata) AND bool_and(d AND NOT p AND h AND n > 0) AND count(DISTINCT n) = 1 THEN 'complete' WHEN bool_or(has_metadata) OR bool_or(p OR h OR n > 0) THEN 'partial' ELSE 'empty' END AS state
 FROM (SELECT s.scene, coalesce(dir_exists, false) AS d, coalesce(in_progress, false) AS p, coalesce(has_view_metadata, false) AS h, coalesce(frame_files, 0) AS n FROM (SELECT DISTINCT scene FROM @exports@ a) s CROSS JOIN {GRID} g LEFT JOIN @exports@ e ON e.scene = s.scene AND e.camera_id = g.camera_id) v JOIN @exported_scenes@ m USING (scene) GROUP BY scene)"""


@query(f"SELECT scene, n_views, state FROM {STATES} s")
def export_completion(spark, d):
    return export_qa.completion(proxy(spark, d, "exports"), proxy(spark, d, "exported_scenes"))


@query(f"SELECT scene, camera_id, state AS export_state FROM @exports@ e JOIN {STATES} s USING (scene) WHERE state <> 'complete'")
def export_resume(spark, d):
    i = proxy(spark, d, "exports")
    return segments.keep_incomplete(i.select("scene", "camera_id"), i, proxy(spark, d, "exported_scenes"))


BORDER_PIXELS = "(SELECT CAST(l_orderkey % 60 AS INT) AS scene, CASE l_linenumber % 4 WHEN 0 THEN 'top' WHEN 1 THEN 'bottom' WHEN 2 THEN 'left' ELSE 'right' END AS edge, CAST(l_quantity % 12 AS INT) AS b, CAST(l_partkey % 10 AS INT) AS g, CAST(l_suppkey % 11 AS INT) AS r FROM lineitem)"


def _border_pixels(spark, d):
    edge = F.element_at(F.array(*map(F.lit, ("top", "bottom", "left", "right"))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    return spark.read.parquet(f"{d}/lineitem.parquet").select((F.col("l_orderkey") % 60).cast("int").alias("scene"), edge.alias("edge"), (F.col("l_quantity") % 12).cast("int").alias("b"), (F.col("l_partkey") % 10).cast("int").alias("g"), (F.col("l_suppkey") % 11).cast("int").alias("r"))


EDGES = f"(SELECT scene, edge, count_if(b <= 2 AND g <= 2 AND r <= 2) / CAST(count(*) AS DOUBLE) AS black_ratio, count_if(b <= 8 AND g <= 8 AND r <= 8) / CAST(count(*) AS DOUBLE) AS near_ratio FROM {BORDER_PIXELS} p GROUP BY scene, edge)"


@query(f"SELECT scene, edge, black_ratio, near_ratio FROM {EDGES} e")
def border_edge_ratios(spark, d):
    return export_qa.edge_ratios(_border_pixels(spark, d))


def _four(c: str) -> str:
    return "(" + " + ".join(f"max(CASE WHEN edge = '{e}' THEN {c} END)" for e in ("top", "bottom", "left", "right")) + ") / 4"


@query(f"SELECT scene, {_four('black_ratio')} AS black_ratio, {_four('near_ratio')} AS near_ratio FROM {EDGES} e GROUP BY scene")
def border_overall_ratios(spark, d):
    return export_qa.overall_ratios(export_qa.edge_ratios(_border_pixels(spark, d)), ["scene"])


LINES = "(SELECT CAST(l_orderkey % 50 AS INT) AS scene, CAST(l_suppkey % 4 AS INT) AS edge, CAST(l_partkey % 8 AS INT) AS line, count_if(l_quantity > 9) / CAST(count(*) AS DOUBLE) AS ratio FROM lineitem GROUP BY 1, 2, 3)"


@query(f"""WITH l AS (SELECT *, ratio >= CAST(0.8 AS DOUBLE) AS f FROM {LINES} l), g AS (SELECT *, row_number() OVER (PARTITION BY scene, edge ORDER BY line) - row_number() OVER (PARTITION BY scene, edge, f ORDER BY line) AS i FROM l),
r AS (SELECT scene, edge, count(*) AS n FROM g WHERE f GROUP BY scene, edge, i) SELECT l.scene, l.edge, max(ratio) AS max_line_ratio, count_if(f) AS full_lines, coalesce((SELECT max(n) FROM r WHERE r.scene = l.scene AND r.edge = l.edge), 0) AS longest_run FROM l GROUP BY l.scene, l.edge""")
def border_strips(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet").groupBy((F.col("l_orderkey") % 50).cast("int").alias("scene"), (F.col("l_suppkey") % 4).cast("int").alias("edge"), (F.col("l_partkey") % 8).cast("int").alias("line"))
    return export_qa.strip_stats(rows.agg((F.count_if(F.col("l_quantity") > 9) / F.count(F.lit(1))).alias("ratio")), ["scene", "edge"])


@query("""WITH e AS (SELECT user_id, event_type = 'error' AS f, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type = 'error' ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT user_id, f, count(*) AS n FROM e GROUP BY user_id, f, i) SELECT user_id, coalesce(max(CASE WHEN f THEN n END), 0) AS longest FROM r GROUP BY user_id""")
def longest_runs(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select("user_id", "ts", "event_id", (F.col("event_type") == "error").alias("f"))
    return stats.longest_run_rows(e, ["user_id"], ["ts", "event_id"], "f", "longest")


REASONS = """(SELECT scene, camera_id, frame_index, CASE WHEN black_run >= 3 THEN 'black_border' WHEN near_run >= 3 THEN 'near_black_border' WHEN near_ratio > 0.03 THEN 'near_black_ratio' END AS reason FROM @border@ b WHERE black_run >= 3 OR near_run >= 3 OR near_ratio > CAST(0.03 AS DOUBLE)
 UNION ALL SELECT scene, camera_id, frame_index, 'black_edge:' || (CASE frame_index % 2 WHEN 0 THEN 'top' ELSE 'left' END) FROM @border@ b WHERE black_run >= 3)"""


def _reasons(spark, d):
    b = proxy(spark, d, "border")
    edges = b.withColumn("edge", F.when(F.col("frame_index") % 2 == 0, "top").otherwise("left"))
    return export_qa.border_reasons(b, edges, ["scene", "camera_id", "frame_index"])


@query(f"SELECT scene, camera_id, frame_index, reason FROM {REASONS} r")
def border_reasons(spark, d):
    return _reasons(spark, d)


@query(f"""WITH r AS (SELECT * FROM {REASONS}), n AS (SELECT scene, camera_id, count(*) AS n FROM r GROUP BY 1, 2), k AS (SELECT scene, camera_id, coalesce(sum(n) OVER (PARTITION BY scene ORDER BY camera_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n)
SELECT r.scene, r.camera_id, r.frame_index, r.reason FROM r JOIN k USING (scene, camera_id) WHERE before < 20""")
def border_reasons_capped(spark, d):
    return export_qa.capped_reasons(_reasons(spark, d))


PLAN3, PLAN9 = "(0, 6, 11)", "(0, 1, 3, 4, 6, 7, 8, 10, 11)"


WORST = """(SELECT *, row_number() OVER (PARTITION BY scene ORDER BY black_run >= 3 DESC, near_run >= 3 DESC, black_ratio DESC, near_ratio DESC, camera_id, frame_index) AS rank FROM @border@ b)"""


@query(f"SELECT scene, camera_id, frame_index, rank FROM {WORST} w WHERE rank <= 10")
def border_worst(spark, d):
    return export_qa.worst_samples(proxy(spark, d, "border")).select("scene", "camera_id", "frame_index", "rank")


@query(f"SELECT scene, camera_id, frame_index, black_ratio, near_ratio FROM {WORST} w WHERE rank <= 10 ORDER BY black_ratio DESC, near_ratio DESC, scene, camera_id, frame_index LIMIT 20")
def border_worst_of_batch(spark, d):
    return export_qa.worst_of_batch(export_qa.worst_samples(proxy(spark, d, "border"))).select("scene", "camera_id", "frame_index", "black_ratio", "near_ratio")


ORDERED = ["CAM_C2", "CAM_C4", "CAM_B3", "CAM_D3", "CAM_A1", "CAM_E5"]


@query(f"""WITH f AS (SELECT scene, camera_id, frame_index, value, row_number() OVER (PARTITION BY scene, camera_id ORDER BY frame_index) AS place FROM @frames@ f) SELECT a.scene, a.camera_id, a.place, a.value, r.value AS ref_value FROM f a JOIN f r ON r.scene = a.scene AND r.place = a.place AND r.camera_id = 'CAM_C3' WHERE a.camera_id IN {tuple(ORDERED)}""")
def reference_frames(spark, d):
    return export_qa.with_reference_frames(proxy(spark, d, "frames"), "value")


@query("""SELECT camera_id, frame_index, count(residual) AS n, CASE WHEN count(residual) >= 10 THEN round(avg(residual), 6) END AS mean, CASE WHEN count(residual) >= 10 THEN round(quantile_cont(residual, 0.95), 6) END AS p95, CASE WHEN count(residual) >= 10 THEN max(residual) END AS max FROM @residuals@ r GROUP BY camera_id, frame_index""")
def residual_stats(spark, d):
    return export_qa.residual_stats(proxy(spark, d, "residuals"), ["camera_id", "frame_index"]).withColumns({c: F.round(c, 6) for c in ("mean", "p95")})


@query(f"""SELECT scene, camera_id, frame_index, mean, rank FROM (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY list_position({ORDERED}, camera_id), frame_index) AS rank FROM (SELECT scene, camera_id, frame_index, near_ratio * 300 AS mean FROM @border@ b) WHERE mean > 8 AND camera_id IN {tuple(ORDERED)}) WHERE rank <= 20""")
def epipolar_warnings(spark, d):
    m = proxy(spark, d, "border").select("scene", "camera_id", "frame_index", (F.col("near_ratio") * 300).alias("mean"))
    return export_qa.epipolar_warnings(m).select("scene", "camera_id", "frame_index", "mean", "rank")


# ---- calibration


@query(f"""WITH s AS (SELECT camera_id, frame_index FROM @detections@ x WHERE detected) SELECT a.camera_id, count(*) AS n_common, min(a.frame_index) AS first_frame, max(a.frame_index) AS last_frame FROM s a JOIN s r ON r.camera_id = '{REFERENCE}' AND r.frame_index = a.frame_index WHERE a.camera_id <> '{REFERENCE}' GROUP BY a.camera_id HAVING count(*) >= 5""")
def calibration_common_frames(spark, d):
    return calibration.common_frames(proxy(spark, d, "detections"))


@query(f"""SELECT g.camera_id, coalesce(n_sampled, 0) AS n_sampled, coalesce(n_detected, 0) AS n_detected, coalesce(rate, 0) AS rate, min_cx, max_cx, min_cy, max_cy, min_area, max_area, min_score, max_score FROM {GRID} g LEFT JOIN (SELECT camera_id, count(*) AS n_sampled, count_if(detected) AS n_detected, count_if(detected) / CAST(count(*) AS DOUBLE) AS rate,
 min(cx) FILTER (detected) AS min_cx, max(cx) FILTER (detected) AS max_cx, min(cy) FILTER (detected) AS min_cy, max(cy) FILTER (detected) AS max_cy, min(area) FILTER (detected) AS min_area, max(area) FILTER (detected) AS max_area, min(score) FILTER (detected) AS min_score, max(score) FILTER (detected) AS max_score FROM @detections@ x GROUP BY camera_id) s USING (camera_id)""")
def calibration_detections(spark, d):
    return calibration.detection_summary(proxy(spark, d, "detections"), cameras(spark))


CORNER = "(SELECT camera_id, frame_index, round(avg(sqrt(dx * dx + dy * dy)), 9) AS mean_error, max(sqrt(dx * dx + dy * dy)) AS max_error FROM (SELECT camera_id, CAST(frame_index % 40 AS INT) AS frame_index, cx / 20 AS dx, cy / 50 AS dy FROM @detections@ x) GROUP BY camera_id, frame_index)"


def _frame_errors(spark, d):
    c = proxy(spark, d, "detections").select("camera_id", (F.col("frame_index") % 40).cast("int").alias("frame_index"), (F.col("cx") / 20).alias("dx"), (F.col("cy") / 50).alias("dy"))
    return calibration.corner_errors(c).withColumn("mean_error", F.round("mean_error", 9))


@query(f"SELECT camera_id, count(*) AS n, round(avg(mean_error), 6) AS mean, round(median(mean_error), 6) AS median, round(quantile_cont(mean_error, 0.95), 6) AS p95, max(mean_error) AS max, CASE WHEN count(*) < 4 THEN 'insufficient_points' ELSE 'ok' END AS status FROM {CORNER} c GROUP BY camera_id")
def calibration_mono(spark, d):
    return calibration.mono_summary(_frame_errors(spark, d)).withColumns({c: F.round(c, 6) for c in ("mean", "median", "p95")}).select("camera_id", "n", "mean", "median", "p95", "max", "status")


@query(f"SELECT camera_id, frame_index, mean_error, max_error, rank FROM (SELECT *, row_number() OVER (PARTITION BY camera_id ORDER BY mean_error DESC, frame_index) AS rank FROM {CORNER} c) WHERE rank <= 5")
def calibration_worst_frames(spark, d):
    return calibration.worst_frames(_frame_errors(spark, d)).select("camera_id", "frame_index", "mean_error", "max_error", "rank")


@query("SELECT mode, camera_id, count(residual) AS n, median(residual) AS median, round(quantile_cont(residual, 0.95), 6) AS p95, max(residual) AS max FROM @residuals@ r GROUP BY GROUPING SETS ((mode, camera_id), (mode))")
def calibration_residuals(spark, d):
    return calibration.residual_summary(proxy(spark, d, "residuals")).withColumn("p95", F.round("p95", 6))


@query("""SELECT CASE WHEN a IS NULL OR b IS NULL THEN 'unknown' WHEN a <= b * 0.8 THEN 'direct' WHEN b <= a * 0.8 THEN 'inverse' ELSE 'no_change_recommended' END AS rotation_mode FROM (SELECT quantile_cont(CASE WHEN mode = 'direct' THEN residual END, 0.95) AS a, quantile_cont(CASE WHEN mode = 'inverse' THEN residual END, 0.95) AS b FROM @residuals@ r)""")
def calibration_rotation(spark, d):
    return calibration.recommend(calibration.residual_summary(proxy(spark, d, "residuals"))).select("rotation_mode")


@query("SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n, list_min(embedding) AS min, list_max(embedding) AS max, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm FROM embeddings")
def calibration_distortion(spark, d):
    return calibration.distortion(spark.read.parquet(f"{d}/embeddings.parquet").select(F.col("vec_id").alias("camera_id"), F.col("embedding").alias("d"))).select(F.col("camera_id").alias("vec_id"), "n", "min", "max", F.round("norm", 6).alias("norm"))


@query("SELECT p_partkey, CAST(i AS INT) AS corner, CAST(i % c * p_size AS DOUBLE) AS x, CAST(i // c * p_size AS DOUBLE) AS y, CAST(0 AS DOUBLE) AS z FROM (SELECT p_partkey, p_size, 3 + p_partkey % 4 AS c, 2 + p_partkey % 3 AS r FROM part), LATERAL (SELECT unnest(range(c * r)) AS i)")
def calibration_board(spark, d):
    """The points of a board for each part: its columns, rows and square size vary."""
    boards = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", (3 + F.col("p_partkey") % 4).cast("int").alias("columns"), (2 + F.col("p_partkey") % 3).cast("int").alias("rows"), F.col("p_size").cast("double").alias("square_mm"))
    return calibration.boards_points(boards, ["p_partkey"])


#: Where a turned board's place (r, c) comes from, for the eight orientations: unmirrored ones turned 0 to 3 times, then mirrored ones.
TURNED = ["r * 8 + c", "c * 8 + 7 - r", "(7 - r) * 8 + 7 - c", "(7 - c) * 8 + r", "r * 8 + 7 - c", "c * 8 + r", "(7 - r) * 8 + c", "(7 - c) * 8 + 7 - r"]


@query("SELECT vec_id, turn, round(sum(embedding[k + 1] * CAST(j + 1 AS DOUBLE)), 5) AS weighted, max(embedding[k + 1]) FILTER (j = 0) AS first, max(embedding[k + 1]) FILTER (j = 8) AS second_row FROM embeddings, (" + " UNION ALL ".join(f"SELECT {t} AS turn, j, {e} AS k FROM (SELECT j, j // 8 AS r, j % 8 AS c FROM range(64) g(j))" for t, e in enumerate(TURNED)) + ") t GROUP BY vec_id, turn")
def calibration_orientations(spark, d):
    e = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", F.posexplode(calibration.orientations(F.col("embedding"), 8)).alias("turn", "o"))
    weighted = F.aggregate(F.transform("o", lambda x, j: x.cast("double") * (j + 1)), F.lit(0.0), lambda s, x: s + x)
    return e.select("vec_id", "turn", F.round(weighted, 5).alias("weighted"), F.col("o")[0].alias("first"), F.col("o")[8].alias("second_row"))


# corners from vectors: 4 x 4 boards, some unread, some without a board
BOARDS = """(SELECT vec_id, 'CAM_' || substr('ABCDE', CAST(vec_id % 25 // 5 AS INT) + 1, 1) || CAST(vec_id % 5 + 1 AS VARCHAR) AS camera_id, CASE WHEN vec_id % 29 = 0 THEN NULL WHEN vec_id % 31 = 0 THEN CAST([] AS DOUBLE[]) ELSE list_transform(embedding[1:32], lambda x: CAST(x AS DOUBLE)) END AS c FROM embeddings)"""


def _along(name: str, a: str, b: str) -> str:
    return f"list_sum(list_transform(range(4), lambda i: c[{b}] - c[{a}])) AS {name}"


@query(f"""WITH b AS (SELECT *, {_along("ax", "i * 8 + 1", "i * 8 + 7")}, {_along("ay", "i * 8 + 2", "i * 8 + 8")}, {_along("dx", "i * 2 + 1", "24 + i * 2 + 1")}, {_along("dy", "i * 2 + 2", "24 + i * 2 + 2")} FROM {BOARDS} z),
 u AS (SELECT *, ax / sqrt(ax * ax + ay * ay) AS x0, ay / sqrt(ax * ax + ay * ay) AS x1, dx / sqrt(dx * dx + dy * dy) AS y0, dy / sqrt(dx * dx + dy * dy) AS y1 FROM b),
 r AS (SELECT x0 AS r0, x1 AS r1, y0 AS q0, y1 AS q1 FROM u WHERE camera_id = '{REFERENCE}' AND len(c) > 0 ORDER BY vec_id LIMIT 1),
 m AS (SELECT *, x0 * r0 + x1 * r1 AS xx, x0 * q0 + x1 * q1 AS xy, y0 * r0 + y1 * r1 AS yx, y0 * q0 + y1 * q1 AS yy FROM u, r)
SELECT camera_id, vec_id AS frame_index, coalesce(len(c), 0) > 0 AS detected, CASE WHEN c IS NULL THEN 'read_failed' WHEN len(c) = 0 THEN 'checkerboard_not_found' END AS reason,
 CASE WHEN len(c) > 0 THEN round(list_avg(list_transform(range(16), lambda i: c[2 * i + 1])), 6) END AS cx, CASE WHEN len(c) > 0 THEN round(list_avg(list_transform(range(16), lambda i: c[2 * i + 2])), 6) END AS cy,
 CASE WHEN len(c) > 0 THEN round((list_max(list_transform(range(16), lambda i: c[2 * i + 1])) - list_min(list_transform(range(16), lambda i: c[2 * i + 1]))) * (list_max(list_transform(range(16), lambda i: c[2 * i + 2])) - list_min(list_transform(range(16), lambda i: c[2 * i + 2]))), 6) END AS area,
 CASE WHEN len(c) > 0 THEN round(greatest(xx + yy, -xx - yy, yy - xx, xx - yy, yx - xy, xy - yx, yx + xy, -yx - xy), 5) END AS score FROM m""")
def calibration_described(spark, d):
    c = F.when(F.col("vec_id") % 29 == 0, F.lit(None)).when(F.col("vec_id") % 31 == 0, F.array().cast("array<double>")).otherwise(F.transform(F.slice("embedding", 1, 32), lambda x: x.cast("double")))
    board = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.array((i % 4).cast("double"), F.floor(i / 4).cast("double"))))
    camera = media.camera_of((F.col("vec_id") % 25).cast("int"))
    found = spark.read.parquet(f"{d}/embeddings.parquet").select(camera.alias("camera_id"), F.col("vec_id").alias("frame_index"), board.alias("board"), c.alias("corners"))
    return calibration.described(found).withColumns({"cx": F.round("cx", 6), "cy": F.round("cy", 6), "area": F.round("area", 6), "score": F.round("score", 5)})


K, R, P = [[1000.0, 0, 320.0], [0, 1010.0, 240.0], [0, 0, 1]], [[1.0, 0.0, 0.01], [0.0, 1.0, -0.02], [-0.01, 0.02, 1.0]], [[900.0, 0, 300.0], [0, 900.0, 200.0], [0, 0, 1]]


@query("""SELECT key, 900.0::DOUBLE * (a / c) + 300.0::DOUBLE AS u2, 900.0::DOUBLE * (b / c) + 200.0::DOUBLE AS v2 FROM (SELECT key, 1.0::DOUBLE * px + 0.0::DOUBLE * py + 0.01::DOUBLE AS a, 0.0::DOUBLE * px + 1.0::DOUBLE * py + (-0.02)::DOUBLE AS b, (-0.01)::DOUBLE * px + 0.02::DOUBLE * py + 1.0::DOUBLE AS c
FROM (SELECT key, (w - 320.0::DOUBLE) / 1000.0::DOUBLE AS px, (h - 240.0::DOUBLE) / 1010.0::DOUBLE AS py FROM @rects@ r))""")
def rectify_points(spark, d):
    u, v = calibration.rectify_point(F.col("w"), F.col("h"), K, R, P)
    return proxy(spark, d, "rects").select("key", u.alias("u2"), v.alias("v2"))


@query("""SELECT l_orderkey, l_linenumber, CAST(1000.0::DOUBLE * (i / w) + 320.0::DOUBLE AS FLOAT) AS map_x, CAST(1010.0::DOUBLE * (j / w) + 240.0::DOUBLE AS FLOAT) AS map_y FROM (SELECT l_orderkey, l_linenumber, 1.0::DOUBLE * a + 0.0::DOUBLE * b + (-0.01)::DOUBLE AS i, 0.0::DOUBLE * a + 1.0::DOUBLE * b + 0.02::DOUBLE AS j, 0.01::DOUBLE * a + (-0.02)::DOUBLE * b + 1.0::DOUBLE AS w
FROM (SELECT l_orderkey, l_linenumber, (l_partkey % 640 - 300.0::DOUBLE) / 900.0::DOUBLE AS a, (l_suppkey % 480 - 200.0::DOUBLE) / 900.0::DOUBLE AS b FROM lineitem))""")
def rectify_map(spark, d):
    """The source pixel of an output pixel for each line item."""
    rows = spark.read.parquet(f"{d}/lineitem.parquet").selectExpr("l_orderkey", "l_linenumber", "cast(l_partkey % 640 as int) as x", "cast(l_suppkey % 480 as int) as y")
    mx, my = calibration.rectify_map(F.col("x"), F.col("y"), K, R, P)
    return rows.select("l_orderkey", "l_linenumber", mx.alias("map_x"), my.alias("map_y"))


@query("""SELECT key, 1000.0::DOUBLE * s AS fx, (320.0::DOUBLE - x) * s AS cx, s AS scale FROM (SELECT key, x, least(3840.0::DOUBLE / w, 2160.0::DOUBLE / h) AS s FROM @rects@ r)""")
def virtual_matrices(spark, d):
    m = calibration.virtual_matrix(F.lit(1000.0), F.lit(1010.0), F.lit(320.0), F.lit(240.0), media.rect(F.col("x"), F.col("y"), F.col("w"), F.col("h")), 3840, 2160)
    return proxy(spark, d, "rects").select("key", m.alias("m")).select("key", "m.fx", "m.cx", "m.scale")


# ---- signals


@query("SELECT vec_id, list_position(list_transform(embedding, lambda x: abs(x)), list_max(list_transform(embedding, lambda x: abs(x)))) - 1 AS peak FROM embeddings")
def signal_peaks(spark, d):
    return spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", stats.first_peak(F.col("embedding")).cast("int").alias("peak"))


@query("""WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), c AS (SELECT vec_id, k, list_sum(list_transform(range(16), lambda i: e[21 + i] * e[k + i + 1])) AS v FROM s, range(49) g(k))
SELECT vec_id, CAST(arg_max(k, v) AS INT) AS lag FROM c GROUP BY vec_id""")
def signal_lags(spark, d):
    return signals.template_lags(spark.read.parquet(f"{d}/embeddings.parquet"), 20, 16)


# ---- sets


@query("""SELECT scene, count(*) FILTER (side = 1) AS only_manifest, count(*) FILTER (side = 2) AS only_grid FROM (SELECT coalesce(m.scene, s.scene) AS scene, CASE WHEN g.camera_id IS NULL THEN 1 WHEN m.camera_id IS NULL THEN 2 END AS side
FROM (SELECT DISTINCT scene FROM @manifest@ a) s CROSS JOIN """ + GRID + """ g FULL JOIN @manifest@ m ON m.scene = s.scene AND m.camera_id = g.camera_id) GROUP BY scene""")
def camera_set_difference(spark, d):
    m = proxy(spark, d, "manifest").select("scene", "camera_id")
    e = sync.expected(m).select("scene", "camera_id")
    both = m.exceptAll(e).withColumn("side", F.lit(1)).unionByName(e.exceptAll(m).withColumn("side", F.lit(2)))
    return m.select("scene").distinct().join(both, "scene", "left").groupBy("scene").agg(F.count_if(F.col("side") == 1).alias("only_manifest"), F.count_if(F.col("side") == 2).alias("only_grid"))


@query("SELECT frame_index FROM @detections@ x WHERE detected AND camera_id = 'CAM_C3' INTERSECT SELECT frame_index FROM @detections@ x WHERE detected AND camera_id = 'CAM_C2'")
def frame_set_intersection(spark, d):
    seen = proxy(spark, d, "detections").where("detected")
    return seen.where("camera_id = 'CAM_C3'").select("frame_index").intersect(seen.where("camera_id = 'CAM_C2'").select("frame_index"))


# ---- provenance, metadata and checks


@query("""SELECT s_suppkey, substr(sha256('{"a":"' || s_name || '","b":' || CAST(s_nationkey AS VARCHAR) || '}'), 1, 16) AS signature FROM supplier""")
def asset_signatures(spark, d):
    text = F.format_string('{"a":"%s","b":%d}', "s_name", "s_nationkey")
    return spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", provenance.text_signature(text).alias("signature"))


def _exported(spark, d):
    tasks = segments.export_tasks(segments.scene_segments(proxy(spark, d, "manifest").select("scene").distinct(), _segments(spark, d)))
    rows = segments.with_phases(tasks, proxy(spark, d, "manifest"), strict=False)
    rows = rows.withColumns({"map_file": F.concat("camera_id", F.lit("_rect_map.npz")), "frame_count": F.lit(60), "width": F.lit(1920), "height": F.lit(1080), "time_key": F.lit("b")})
    return provenance.view_metadata(rows, PROFILES["benchmark"], "b", {"rectification_asset_version": "r1", "roi_asset_version": "r2", "crop_policy_version": "c1"})


EXPORTED = f"(SELECT CASE WHEN segment_count > 1 THEN s.scene || '_seg' || lpad(CAST(segment_index + 1 AS VARCHAR), 2, '0') ELSE s.scene END AS export_scene, s.*, g.camera_id, g.view_index, m.offset_ms FROM {SEGMENTS} s JOIN (SELECT DISTINCT scene FROM @manifest@ x) y ON y.scene = s.scene CROSS JOIN {GRID} g LEFT JOIN @manifest@ m ON m.scene = s.scene AND m.camera_id = g.camera_id)"


@query(f"""SELECT export_scene, camera_id, 'view_' || lpad(CAST(view_index AS VARCHAR), 2, '0') AS view_id, scene || '.mp4' AS source_clip, camera_id || '_rect_map.npz' AS rectification_map_file, offset_ms AS phase_offset_ms, 97 AS jpeg_quality, "start" AS start_time, scene AS source_scene_id FROM {EXPORTED} e""")
def metadata_views(spark, d):
    return _exported(spark, d).select("export_scene", "camera_id", "view_id", "source_clip", "rectification_map_file", "phase_offset_ms", "jpeg_quality", F.col("segment.start_time").alias("start_time"), F.col("segment.source_scene_id").alias("source_scene_id"))


@query(f"""SELECT export_scene, count(*) AS n_views, min(offset_ms) AS least_phase, max(CASE WHEN camera_id = 'CAM_C3' THEN offset_ms END) AS reference_phase,
 CASE WHEN max(CASE WHEN camera_id = 'CAM_C3' THEN offset_ms END) IS NULL THEN 'missing_reference_phase' WHEN max(CASE WHEN camera_id = 'CAM_C3' THEN offset_ms END) <> 0 THEN 'reference_phase_not_zero' WHEN count(offset_ms) < count(*) THEN 'missing_phase_offset' ELSE 'ok' END AS phase_status
 FROM (SELECT export_scene, camera_id, CASE WHEN camera_id = 'CAM_C3' AND export_scene LIKE '%7' THEN 2.5 ELSE offset_ms END AS offset_ms FROM {EXPORTED} e) x GROUP BY export_scene""")
def metadata_sequences(spark, d):
    moved = F.when((F.col("camera_id") == REFERENCE) & F.col("export_scene").endswith("7"), 2.5).otherwise(F.col("phase_offset_ms"))
    s = provenance.sequence_metadata(_exported(spark, d).withColumn("phase_offset_ms", moved), PROFILES["benchmark"], "b", 59.94, strict=False)
    values = F.map_values("phase_offset_ms")
    return s.select("export_scene", F.size(values).cast("long").alias("n_views"), F.array_min(values).alias("least_phase"), F.try_element_at("phase_offset_ms", F.lit(REFERENCE)).alias("reference_phase"), "phase_status")


@query("""WITH m AS (SELECT scene, camera_id, TRY_CAST(offset_text AS DOUBLE) AS offset_ms FROM @raw_manifest@ r)
SELECT 'error' AS level, 'sync manifest: check scene ' || scene AS message FROM m GROUP BY scene HAVING count(offset_ms) < 25 OR bool_or(camera_id = 'CAM_C3' AND offset_ms <> 0)""")
def preflight_manifest(spark, d):
    return preflight.manifest_errors(_raw_offsets(spark, d))


@query("""WITH r AS (SELECT CAST(user_id % 25 AS VARCHAR) AS key, round(value * 4) AS v FROM events WHERE value IS NOT NULL), m AS (SELECT key, median(v) AS median, count(*) AS n, min(v) AS least, max(v) AS most FROM r GROUP BY key)
SELECT key, n, m.median, median(abs(v - m.median)) AS mad, least, most FROM r JOIN m USING (key) GROUP BY key, n, m.median, least, most""")
def offsets_incremental(spark, d):
    """Events as a stream in several micro-batches; the figures of each camera after the last one."""
    rows = spark.read.parquet(f"{d}/events.parquet").select((F.col("user_id") % 25).alias("camera"), F.round(F.col("value") * 4).alias("offset_ms"))
    root = files.folder(spark, "offsets")
    rows.repartition(3, F.hash("camera", "offset_ms")).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query_ = robust.keep_figures(stream, "camera", f"{root}/table", f"{root}/check")
    query_.awaitTermination()
    return robust.latest(spark, f"{root}/table")


@query("SELECT scene || '.mp4' AS video, camera_id, TRY_CAST(offset_text AS DOUBLE) AS offset_ms, CASE WHEN TRY_CAST(offset_text AS DOUBLE) IS NULL THEN 'not double' END AS reason FROM @raw_manifest@ r")
def manifest_scan(spark, d):
    """A JSON document for each scene, whose offsets are scanned with a fault for each that is no number."""
    entry = F.struct("camera_id", F.struct(F.col("offset_text").alias("offset_ms")).alias("o"))
    docs = proxy(spark, d, "raw_manifest").groupBy("scene").agg(F.map_from_entries(F.collect_list(entry)).alias("offsets"))
    text = F.to_json(F.map_from_arrays(F.array(F.concat("scene", F.lit(".mp4"))), F.array(F.struct(F.lit(1.5).alias("master_clap_time"), "offsets"))))
    root = files.folder(spark, "manifests")
    docs.select(F.col("scene").alias("part"), text.alias("value")).write.partitionBy("part").text(root)
    rows, faults = tolerant.manifest(spark, f"{root}/*/*.txt")
    told = F.concat(F.lit('$["'), F.col("video"), F.lit('"]["offsets"]["'), F.col("camera_id"), F.lit('"]["offset_ms"]'))
    return rows.withColumn("path", told).join(faults.select("path", "reason"), "path", "left").select("video", "camera_id", "offset_ms", "reason")


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    rates = watch.event_rates(spark.read.parquet(f"{d}/events.parquet"))
    return rates.select(F.col("window.start").alias("hour"), "event_type", "n")


# ---- queries whose faulty cases are put into a proxy's values


def _pixels(spark, d):
    return _maps(spark, proxy(spark, d, "rects"))


PIXELS = """(SELECT camera_id, CAST(i // 48 AS INT) AS y, CAST(i % 48 AS INT) AS x, i % 48 + key % 5 * CAST(0.75 AS DOUBLE) - CAST(1.5 AS DOUBLE) AS map_x, i // 48 + key % 7 * CAST(0.5 AS DOUBLE) - CAST(1.5 AS DOUBLE) AS map_y FROM @rects@ r, range(1536) g(i))"""
MASK = f"(SELECT y, x, bool_and(map_x BETWEEN 2 AND 45 AND map_y BETWEEN 2 AND 29) AS ok FROM {PIXELS} p GROUP BY y, x)"


@query(f"SELECT y, x, ok FROM {MASK} m")
def roi_common_mask(spark, d):
    return roi.common_mask(_pixels(spark, d), 48, 32, 2)


@query(f"SELECT min(x) AS x, min(y) AS y, max(x) + 1 - min(x) AS width, max(y) + 1 - min(y) AS height FROM {MASK} m WHERE ok")
def roi_bounding_box(spark, d):
    return roi.bounding_box(roi.common_words(roi.words(_pixels(spark, d), 48, 32, 2)))


@query(f"""SELECT camera_id, edge, min(least(map_x, map_y, 47 - map_x, 31 - map_y)) AS min_margin FROM {PIXELS} p JOIN (VALUES ('top'), ('bottom'), ('left'), ('right')) e(edge) ON
 (x BETWEEN 8 AND 39 AND ((edge = 'top' AND y = 6) OR (edge = 'bottom' AND y = 23))) OR (y BETWEEN 6 AND 23 AND ((edge = 'left' AND x = 8) OR (edge = 'right' AND x = 39))) GROUP BY ROLLUP (camera_id, edge)""")
def roi_crop_margins(spark, d):
    return roi.margins(_pixels(spark, d), {"x": 8, "y": 6, "width": 32, "height": 18}, 48, 32)


@query(f"""WITH m AS MATERIALIZED (SELECT * FROM {MASK}), t AS (SELECT a.x AS x0, b.x AS x1, y FROM (SELECT DISTINCT x FROM m) a JOIN (SELECT DISTINCT x FROM m) b ON a.x <= b.x CROSS JOIN (SELECT DISTINCT y FROM m) c),
 f AS (SELECT t.x0, t.x1, t.y FROM t JOIN m ON m.y = t.y AND m.x BETWEEN t.x0 AND t.x1 GROUP BY ALL HAVING bool_and(ok)),
 g AS (SELECT x0, x1, y - row_number() OVER (PARTITION BY x0, x1 ORDER BY y) AS i, y FROM f) SELECT x0 AS x, CAST(min(y) AS INT) AS y, x1 - x0 + 1 AS width, CAST(count(*) AS INT) AS height FROM g GROUP BY x0, x1, i ORDER BY (x1 - x0 + 1) * count(*) DESC, max(y), x1, count(*) DESC LIMIT 1""")
def roi_largest_rectangle(spark, d):
    return roi.largest_rectangle(roi.common_words(roi.words(_pixels(spark, d), 48, 32, 2)))


@query(f"SELECT camera_id FROM {PIXELS} p GROUP BY camera_id HAVING NOT bool_or(map_x + CAST(substr(camera_id, 6, 1) AS INT) % 3 * 60 BETWEEN 2 AND 45 AND map_y BETWEEN 2 AND 29)")
def roi_blind_cameras(spark, d):
    shifted = _pixels(spark, d).withColumn("map_x", F.col("map_x") + F.substring("camera_id", 6, 1).cast("int") % 3 * 60)
    each = roi.words(shifted.withColumn("camera_id", F.concat_ws("/", "camera_id", "key")), 48, 32, 2)  # a camera may have several maps here
    return roi.blind_cameras(each.withColumn("camera_id", F.substring_index("camera_id", "/", 1)))


# two cameras see nothing, the rest of their row little
SEEN = "detected AND cx >= CASE WHEN camera_id IN ('CAM_B1', 'CAM_B2') THEN 1000 WHEN camera_id LIKE 'CAM_B%' THEN 90 ELSE 0 END"


@query(f"""WITH s AS (SELECT camera_id, count(*) AS n, count_if({SEEN}) AS k FROM @detections@ x GROUP BY camera_id), e AS (SELECT camera_id, quantile_cont(mean_error, 0.95) AS p95, max(mean_error) AS m FROM {CORNER} c GROUP BY camera_id),
 r AS (SELECT quantile_cont(CASE WHEN mode = 'direct' THEN residual / 2 END, 0.95) AS a, quantile_cont(CASE WHEN mode = 'inverse' THEN residual END, 0.95) AS b FROM @residuals@ q)
SELECT 'fail' AS level, camera_id, 'detected_frames_less_than_5' AS reason FROM s WHERE k < 5 UNION ALL SELECT 'warning', camera_id, 'detection_rate_below_30_percent' FROM s WHERE k >= 5 AND k / CAST(n AS DOUBLE) < 0.3
UNION ALL SELECT 'warning', camera_id, 'mono_reprojection_p95_gt_2px' FROM e WHERE p95 > 2 UNION ALL SELECT 'warning', camera_id, 'stereo_error_gt_2px' FROM e WHERE m > 2
UNION ALL SELECT 'warning', NULL, 'rotation_direction_significant_difference' FROM r WHERE a <= b * 0.8 OR b <= a * 0.8""")
def calibration_risks(spark, d):
    det = calibration.detection_summary(proxy(spark, d, "detections").withColumn("detected", F.expr(SEEN)))
    mono = calibration.mono_summary(_frame_errors(spark, d))
    residuals = proxy(spark, d, "residuals").withColumn("residual", F.when(F.col("mode") == "direct", F.col("residual") / 2).otherwise(F.col("residual")))
    return calibration.risks(det, mono, mono.select("camera_id", F.col("max").alias("stereo_error")), calibration.recommend(calibration.residual_summary(residuals)))


# a third of the scenes has no near-black border, a third a slight one
SHADE = "near_ratio * (scene % 3) / CAST(2 AS DOUBLE)"
SHADED = f"(SELECT scene, camera_id, frame_index, black_ratio, {SHADE} AS near_ratio, black_run, near_run FROM @border@ q)"
CLASSES = f"""(SELECT s.scene, CASE WHEN s.scene % 13 = 0 THEN 'fail' WHEN bool_or(black_run >= 3) THEN 'fail' WHEN bool_or(near_run >= 3 OR near_ratio > CAST(0.03 AS DOUBLE)) OR s.scene % 7 = 0 THEN 'warning' ELSE 'pass' END AS status
 FROM (SELECT scene FROM @inventory@ i UNION SELECT scene FROM @border@ k) s LEFT JOIN {SHADED} b ON b.scene = s.scene GROUP BY s.scene)"""


def _shaded(spark, d):
    return proxy(spark, d, "border").withColumn("near_ratio", F.expr(SHADE))


def _classes(spark, d):
    """All scenes, of which some have no samples."""
    samples = _shaded(spark, d)
    scenes = proxy(spark, d, "inventory").select("scene").union(samples.select("scene")).distinct().withColumn("n_errors", (F.col("scene") % 13 == 0).cast("int"))
    return export_qa.classify(scenes, samples, scenes.where("scene % 7 = 0"))


@query(f"SELECT scene, status FROM {CLASSES} c")
def scene_status(spark, d):
    return _classes(spark, d)


@query(f"SELECT s.status, count(c.scene) AS n_scenes FROM (VALUES ('pass'), ('warning'), ('fail')) s(status) LEFT JOIN {CLASSES} c ON c.status = s.status GROUP BY s.status")
def scene_status_counts(spark, d):
    return export_qa.status_counts(_classes(spark, d))


@query(f"""WITH b AS (SELECT * FROM {SHADED}), odd AS (SELECT DISTINCT scene FROM b WHERE frame_index IN {PLAN3} AND (black_run >= 3 OR near_run >= 3 OR near_ratio > CAST(0.03 AS DOUBLE)))
SELECT scene, camera_id, frame_index, scene IN (SELECT scene FROM odd) AS upgraded FROM b WHERE CASE WHEN scene IN (SELECT scene FROM odd) THEN frame_index IN {PLAN9} ELSE frame_index IN {PLAN3} END""")
def adaptive_samples(spark, d):
    b = _shaded(spark, d)
    views = b.select("scene", "camera_id").distinct().withColumn("frame_files", F.lit(12))
    return export_qa.adaptive(b, export_qa.sampling_plan(views, 3), export_qa.sampling_plan(views, 9)).select("scene", "camera_id", "frame_index", "upgraded")


@query(f"""WITH b AS (SELECT * FROM {SHADED}), odd AS (SELECT DISTINCT scene FROM b WHERE frame_index IN {PLAN3} AND (black_run >= 3 OR near_run >= 3 OR near_ratio > CAST(0.03 AS DOUBLE)))
SELECT scene, scene IN (SELECT scene FROM odd) AS upgraded, count(*) AS n_samples, count_if(frame_index IN {PLAN3}) AS n_first FROM b WHERE CASE WHEN scene IN (SELECT scene FROM odd) THEN frame_index IN {PLAN9} ELSE frame_index IN {PLAN3} END GROUP BY scene""")
def adaptive_reads(spark, d):
    """The samples of two phases, where only the frames of a plan are read; how many, and how many of them the first phase read."""
    b = _shaded(spark, d)
    views = b.select("scene", "camera_id").distinct().withColumn("frame_files", F.lit(12))
    keys = ["scene", "camera_id", "frame_index"]
    taken, _ = export_qa.adaptive_in_phases(lambda plan: b.join(plan.select(*keys), keys, "left_semi"), views, files.written)
    early = export_qa.sampling_plan(views, 3).select(*keys, F.lit(True).alias("_early"))
    return taken.join(early, keys, "left").groupBy("scene", "upgraded").agg(F.count(F.lit(1)).alias("n_samples"), F.count("_early").alias("n_first"))


@query("SELECT CAST(p_partkey % 50 AS INT) AS part, sha256(string_agg(p_partkey || ':' || p_name || chr(10), '' ORDER BY p_partkey)) AS checksum, CAST(sum(strlen(p_partkey || ':' || p_name || chr(10))) AS BIGINT) AS length FROM part GROUP BY ALL")
def streamed_checksums(spark, d):
    """Parts as files of lines, and the checksums of these, streamed by tasks."""
    rows = spark.read.parquet(f"{d}/part.parquet").select((F.col("p_partkey") % 50).cast("int").alias("part"), "p_partkey", F.concat_ws(":", F.col("p_partkey").cast("string"), "p_name").alias("line"))
    root = files.folder(spark, "parts")
    rows.repartition("part").sortWithinPartitions("part", "p_partkey").select("part", "line").write.partitionBy("part").text(root)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root).select("path")
    told = provenance.file_checksums(listed.repartition(spark.sparkContext.defaultParallelism))
    return told.select(F.regexp_extract("path", r"/part=(\d+)/", 1).cast("int").alias("part"), "checksum", "length")


FILES = "(SELECT CAST(s_suppkey // 100 AS VARCHAR) AS scene, CAST(s_suppkey % 25 AS INT) AS v, CAST(s_suppkey % 100 // 25 AS INT) AS f, CAST(floor(abs(s_acctbal)) AS INT) % 200 + 20 AS b FROM supplier)"


@query(f"""SELECT scene, {GRID_CAMERA.format('v')} AS camera_id, CAST(n - 1 AS INT) AS frame_index, b AS blue, b // 2 AS green, CAST(count_all AS INT) AS frame_files FROM
 (SELECT *, row_number() OVER (PARTITION BY scene, v ORDER BY f) AS n, count(*) OVER (PARTITION BY scene, v) AS count_all FROM {FILES} x) WHERE n IN (1, count_all)""")
def exported_files(spark, d):
    """A frame for each supplier goes through the sink of two phases to files; these are listed by tasks, and of each view the first and the last one are opened."""
    rows = spark.read.parquet(f"{d}/supplier.parquet").selectExpr("cast(s_suppkey div 100 as string) as scene", "s_suppkey", "cast(floor(abs(s_acctbal)) as int) % 200 + 20 as b")
    pixel = F.unhex(F.format_string("%02x%02x%02x", "b", F.expr("b div 2"), F.lit(7)))
    made = rows.select("scene", F.format_string("view_%02d", (F.col("s_suppkey") % 25).cast("int")).alias("view_id"), F.expr("cast(s_suppkey % 100 div 25 + 1 as int)").alias("number"), F.lit(3).alias("h"), F.lit(4).alias("w"), F.expr("cast(null as binary)").alias("data"), pixel.alias("_p"))
    made = made.withColumn("data", F.concat(*[F.col("_p")] * 12)).drop("_p")
    root = files.folder(spark, "exported")
    exports.publish(root, "q", exports.write_frames(made, root, "q")).count()
    listed = files.written(exports.listing(spark, root), "listing")
    views = exports.inventory(listed).where("frame_files > 0").select("scene", "camera_id", "frame_files")
    keys = ["scene", "camera_id", "frame_index"]
    plan = export_qa.sampling_plan(views, 2).join(exports.frame_names(listed), keys)
    got = exports.opened(spark, root, plan).where("reason is null").join(views, ["scene", "camera_id"])
    at = lambda i: F.conv(F.hex(F.substring("data", i, 1)), 16, 10).cast("int")
    return got.select(*keys, at(1).alias("blue"), at(2).alias("green"), "frame_files")


NAMED = "CASE WHEN key % 9 = 0 THEN 'CAM_X1' WHEN camera_id IN ('CAM_B4', 'CAM_C2') THEN 'CAM_X2' ELSE camera_id END"


@query(f"""WITH c AS (SELECT DISTINCT {NAMED} AS camera_id FROM @rects@ r)
SELECT 'error' AS level, 'calibration: missing ' || camera_id AS message FROM (SELECT camera_id FROM {GRID} g EXCEPT SELECT camera_id FROM c) UNION ALL SELECT 'error', 'calibration: unknown ' || camera_id FROM (SELECT camera_id FROM c EXCEPT SELECT camera_id FROM {GRID} g)""")
def preflight_camera_sets(spark, d):
    return preflight.set_errors(proxy(spark, d, "rects").select(F.expr(NAMED).alias("camera_id")), "calibration")
