"""Deterministic stand-ins for capture data, derived from the star schema's tables. The text is valid in Spark SQL and in DuckDB; {name} is a table."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_CAMERA = "concat('CAM_', substr('ABCDE', CAST(floor({0} / 5) AS INT) + 1, 1), CAST({0} % 5 + 1 AS STRING))"


def _cam(expr: str) -> str:
    return _CAMERA.replace("{0}", expr)


PROXIES = {
    # the first event of each day and camera; the reference camera has offset 0
    "manifest": f"""SELECT scene, {_cam('view_index')} AS camera_id, view_index, CASE WHEN view_index = 12 THEN CAST(0 AS DOUBLE) ELSE v * CAST(10 AS DOUBLE) - CAST(500 AS DOUBLE) END AS offset_ms
        FROM (SELECT CAST(CAST(ts AS DATE) AS STRING) AS scene, CAST(user_id % 25 AS INT) AS view_index, min_by(value, event_id) AS v FROM {{events}} GROUP BY CAST(CAST(ts AS DATE) AS STRING), CAST(user_id % 25 AS INT)) t""",
    # offsets as text, a few of them no numbers
    "raw_manifest": f"""SELECT scene, {_cam('view_index')} AS camera_id, CASE WHEN first_id % 29 = 0 THEN 'n/a' WHEN view_index = 12 THEN CASE WHEN first_id % 3 = 0 THEN '5' ELSE '0' END ELSE CAST(first_id % 1400 - 700 AS STRING) END AS offset_text
        FROM (SELECT CAST(CAST(ts AS DATE) AS STRING) AS scene, CAST(user_id % 25 AS INT) AS view_index, min(event_id) AS first_id FROM {{events}} GROUP BY CAST(CAST(ts AS DATE) AS STRING), CAST(user_id % 25 AS INT)) t""",
    "clips": f"""SELECT video, {_cam('view_index')} AS camera_id, view_index, duration, CAST((view_index - 12) * 10 AS DOUBLE) AS offset_ms, CAST(1.25 AS DOUBLE) AS clap
        FROM (SELECT CAST(l_orderkey % 40 AS INT) AS video, CAST(l_suppkey % 25 AS INT) AS view_index, max(l_extendedprice) / CAST(1000 AS DOUBLE) AS duration FROM {{lineitem}} GROUP BY CAST(l_orderkey % 40 AS INT), CAST(l_suppkey % 25 AS INT)) t""",
    "days": "SELECT DISTINCT CAST(CAST(ts AS DATE) AS STRING) AS scene, CAST(day(ts) AS INT) AS n FROM {events}",
    "frames": f"""SELECT CAST(CAST(ts AS DATE) AS STRING) AS scene, {_cam('CAST(user_id % 25 AS INT)')} AS camera_id, event_id AS frame_index, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DOUBLE) AS t, value FROM {{events}}""",
    "rects": f"""SELECT {_cam('CAST(s_suppkey % 25 AS INT)')} AS camera_id, s_suppkey AS key, CAST(s_suppkey * 7 % 50 AS INT) AS x, CAST(s_suppkey * 13 % 40 AS INT) AS y, CAST(900 + s_suppkey * 11 % 200 AS INT) AS w, CAST(500 + s_suppkey * 17 % 100 AS INT) AS h FROM {{supplier}}""",
    "border": f"""SELECT scene, {_cam('view_index')} AS camera_id, frame_index, black_ratio, near_ratio, black_run, near_run
        FROM (SELECT CAST(l_orderkey % 30 AS INT) AS scene, CAST(l_suppkey % 25 AS INT) AS view_index, CAST(l_partkey % 12 AS INT) AS frame_index, max(l_discount) / CAST(8 AS DOUBLE) AS black_ratio, max(l_tax) / CAST(2 AS DOUBLE) AS near_ratio,
                     CAST(max(CASE WHEN l_quantity >= 50 AND l_orderkey % 30 < 8 AND l_linenumber = 7 THEN 4 ELSE 1 END) AS INT) AS black_run, CAST(max(CASE WHEN l_quantity >= 49 AND l_orderkey % 30 < 16 AND l_linenumber = 6 THEN 5 ELSE 2 END) AS INT) AS near_run
              FROM {{lineitem}} GROUP BY CAST(l_orderkey % 30 AS INT), CAST(l_suppkey % 25 AS INT), CAST(l_partkey % 12 AS INT)) t""",
    "inventory": f"""SELECT scene, {_cam('view_index')} AS camera_id, view_index, m % 53 <> 0 AS dir_exists, m % 59 = 0 AS in_progress, m % 61 <> 0 AS has_view_metadata, CAST(CASE WHEN m % 67 = 0 THEN 0 WHEN scene % 5 = 0 THEN 60 + m % 2 ELSE 60 END AS INT) AS frame_files, CAST(CASE WHEN m % 83 = 0 THEN 1280 ELSE 1920 END AS INT) AS width, CAST(CASE WHEN m % 83 = 0 THEN 720 ELSE 1080 END AS INT) AS height
        FROM (SELECT CAST(o_orderkey % 40 AS INT) AS scene, CAST(o_custkey % 25 AS INT) AS view_index, min(o_orderkey) AS m FROM {{orders}} GROUP BY CAST(o_orderkey % 40 AS INT), CAST(o_custkey % 25 AS INT)) t""",
    "detections": f"""SELECT {_cam('view_index')} AS camera_id, frame_index, value >= CAST(40 AS DOUBLE) AS detected, value AS cx, value * CAST(2 AS DOUBLE) AS cy, value * value AS area, value / CAST(100 AS DOUBLE) AS score
        FROM (SELECT CAST(user_id % 25 AS INT) AS view_index, CAST(event_id % 200 AS INT) AS frame_index, min_by(value, event_id) AS value FROM {{events}} GROUP BY CAST(user_id % 25 AS INT), CAST(event_id % 200 AS INT)) t""",
    "residuals": f"""SELECT {_cam('CAST(user_id % 25 AS INT)')} AS camera_id, CASE WHEN event_id % 2 = 0 THEN 'direct' ELSE 'inverse' END AS mode, value AS residual, CAST(event_id % 40 AS INT) AS frame_index FROM {{events}}""",
    "state": f"""SELECT scene, camera_id, view_index, offset_ms IS NULL AS missing, view_index % 7 = 3 AS audio_failed, abs(offset_ms) > CAST(480 AS DOUBLE) AS manual, abs(offset_ms) >= CAST(400 AS DOUBLE) AS review, offset_ms > CAST(0 AS DOUBLE) AS aligned FROM (MANIFEST) m""",
}
# exported scenes: those of the inventory, one with three good views only, one complete, and one complete but for the scene's metadata
PROXIES["exports"] = f"""SELECT scene, camera_id, dir_exists, in_progress, has_view_metadata, frame_files FROM ({PROXIES['inventory']}) i
    UNION ALL SELECT s.scene, {_cam('v.view_index')} AS camera_id, true, false, true, 60 FROM (SELECT DISTINCT CAST(o_custkey % 25 AS INT) AS view_index FROM {{orders}}) v CROSS JOIN (SELECT DISTINCT CAST(100 + o_orderkey % 3 AS INT) AS scene FROM {{orders}}) s WHERE s.scene <> 100 OR v.view_index < 3"""
PROXIES["exported_scenes"] = f"SELECT DISTINCT scene, scene % 6 <> 1 AND scene <> 102 AS has_metadata FROM ({PROXIES['exports']}) e"
PROXIES["state"] = PROXIES["state"].replace("MANIFEST", PROXIES["manifest"])


def tables_of(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def proxy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = PROXIES[name]
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables_of(sql)})


def oracle(name: str) -> str:
    """The same text for DuckDB, as a subquery."""
    return "(" + re.sub(r"\{(\w+)\}", r"\1", PROXIES[name]) + ")"
