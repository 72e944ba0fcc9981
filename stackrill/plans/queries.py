"""Registered queries: the operators over the driver's tables, and the same in DuckDB SQL.

The tables stand in for image data: ``events`` for measured objects (movie, track, frame, class,
area), ``embeddings`` for 8×8 planes, ``lineitem`` for detected boxes, ``orders`` and ``part`` for
files. Doubles are rounded to 6 places on both sides, as sums run in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as fs
from ..operators import crop, detect, pixels, planes, relational, tracks
from . import models

#: Hours from 1970 to the first event. Fixed value.
_HOUR0 = 473352
DIGITS = 6


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def measurements(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as measured objects."""
    e = _read(spark, sf, "events").selectExpr(
        "event_id", "concat('m', user_id % 8) AS movie", "cast(user_id AS int) AS trackid", f"cast(unix_micros(cast(ts AS timestamp)) div 3600000000 AS int) - {_HOUR0} AS frame",
        "cast((event_id * 37) % 2048 AS double) / 2 AS centroid_0", "cast((event_id * 91) % 2048 AS double) / 2 AS centroid_1", "value AS area", "event_type AS object_class",
        "CASE WHEN value > 100 THEN 'piPOS' ELSE 'piNEG' END AS pi_class",
    )
    return e.selectExpr("*", "row_number() OVER (PARTITION BY movie, frame ORDER BY event_id) AS label")


_M = f"""m AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY movie, frame ORDER BY event_id) AS INTEGER) AS label FROM (
    SELECT event_id, 'm' || (user_id % 8) AS movie, CAST(user_id AS INTEGER) AS trackid, CAST(floor(epoch(ts) / 3600) AS INTEGER) - {_HOUR0} AS frame,
           CAST((event_id * 37) % 2048 AS DOUBLE) / 2 AS centroid_0, CAST((event_id * 91) % 2048 AS DOUBLE) / 2 AS centroid_1, value AS area, event_type AS object_class,
           CASE WHEN value > 100 THEN 'piPOS' ELSE 'piNEG' END AS pi_class
    FROM events))"""


def pixel_table(spark: SparkSession, sf: str) -> DataFrame:
    """``embeddings`` as pixels of 8×8 planes in four movies."""
    e = _read(spark, sf, "embeddings").selectExpr("concat('m', vec_id % 4) AS movie", "cast(vec_id div 4 AS int) AS frame", "posexplode(embedding) AS (i, v)")
    return e.selectExpr("movie", "frame", "i div 8 AS y0", "i % 8 AS x0", "cast(v AS double) AS value").selectExpr("movie", "frame", "cast(y0 AS int) AS y", "cast(x0 AS int) AS x", "value")


_P = """p AS (
  SELECT 'm' || (vec_id % 4) AS movie, CAST(vec_id // 4 AS INTEGER) AS frame, CAST(i // 8 AS INTEGER) AS y, CAST(i % 8 AS INTEGER) AS x, CAST(embedding[i + 1] AS DOUBLE) AS value
  FROM (SELECT vec_id, embedding, unnest(range(64)) AS i FROM embeddings))"""


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return planes.labelled_pixels(plane_table(spark, sf), 0.05)


#: Components of each plane by reachability, numbered by their first pixel.
_L = f"""{_P}, o AS (SELECT movie, frame, y, x, value, y * 8 + x AS i FROM p WHERE value > 0.05),
reach AS (
  SELECT movie, frame, i AS a, i AS b FROM o
  UNION SELECT r.movie, r.frame, r.a, o.i FROM reach r JOIN o ON r.movie = o.movie AND r.frame = o.frame
    AND ((o.i = r.b + 8) OR (o.i = r.b - 8) OR (o.i = r.b + 1 AND r.b % 8 < 7) OR (o.i = r.b - 1 AND r.b % 8 > 0))
), l AS (
  SELECT o.movie, o.frame, o.y, o.x, o.value, CAST(dense_rank() OVER (PARTITION BY o.movie, o.frame ORDER BY f.first) AS INTEGER) AS label
  FROM o JOIN (SELECT movie, frame, a, min(b) AS first FROM reach GROUP BY ALL) f ON f.movie = o.movie AND f.frame = o.frame AND f.a = o.i)"""


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """``lineitem`` as boxes of whole numbers."""
    return _read(spark, sf, "lineitem").selectExpr(
        "concat('m', l_orderkey % 4) AS movie", "cast(l_orderkey % 97 AS int) AS frame", "l_orderkey * 10 + l_linenumber AS box", "cast((l_partkey * 7) % 1000 AS double) AS x1", "cast((l_suppkey * 13) % 1000 AS double) AS y1",
        "cast((l_partkey * 7) % 1000 + 4 + l_quantity AS double) AS x2", "cast((l_suppkey * 13) % 1000 + 4 + l_linenumber * 5 AS double) AS y2", "cast(l_linenumber % 3 AS int) AS class_id", "l_discount * 10 AS score",
    )


_B = """b AS (
  SELECT 'm' || (l_orderkey % 4) AS movie, CAST(l_orderkey % 97 AS INTEGER) AS frame, l_orderkey * 10 + l_linenumber AS box, CAST((l_partkey * 7) % 1000 AS DOUBLE) AS x1, CAST((l_suppkey * 13) % 1000 AS DOUBLE) AS y1,
         CAST((l_partkey * 7) % 1000 + 4 + l_quantity AS DOUBLE) AS x2, CAST((l_suppkey * 13) % 1000 + 4 + l_linenumber * 5 AS DOUBLE) AS y2, CAST(l_linenumber % 3 AS INTEGER) AS class_id, l_discount * 10 AS score
  FROM lineitem)"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, DIGITS).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes))


def _r(*columns: str) -> str:
    return ", ".join(f"round({c}, {DIGITS}) AS {c.rpartition('.')[2]}" for c in columns)


_ALL: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        _ALL[name] = (lambda spark, sf: _rounded(f(spark, sf)), sql)
        return f

    return add


@_query("roi_measure", f"""WITH RECURSIVE {_L},
a AS (SELECT movie, frame, label, count(*)::DOUBLE AS area, avg(y) AS centroid_0, avg(x) AS centroid_1, max(value) AS max_intensity, min(value) AS min_intensity, avg(value) AS mean_intensity,
        var_pop(y) AS c, var_pop(x) AS a, -covar_pop(y, x) AS b, min(y) AS bbox_y0, min(x) AS bbox_x0, max(y) + 1 AS bbox_y1, max(x) + 1 AS bbox_x1, stddev_pop(value) AS roi_std_dev,
        CASE WHEN count(DISTINCT value) < 10 THEN 0 ELSE skewness(value) END AS roi_skewness FROM l GROUP BY ALL),
e AS (SELECT *, 4 * sqrt(greatest((a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b), 0)) AS major_axis_length, 4 * sqrt(greatest((a + c) / 2 - sqrt(((a - c) / 2) ** 2 + b * b), 0)) AS minor_axis_length FROM a)
SELECT movie, frame, label, bbox_y0, bbox_x0, bbox_y1, bbox_x1, {_r('area', 'centroid_0', 'centroid_1', 'max_intensity', 'min_intensity', 'mean_intensity', 'roi_std_dev', 'roi_skewness')},
       round(major_axis_length, 4) AS major_axis_length, round(minor_axis_length, 4) AS minor_axis_length,
       coalesce(nullif(round(CASE WHEN abs(a - c) < 1e-9 THEN CASE WHEN b < -1e-9 THEN pi() / 4 ELSE -pi() / 4 END ELSE atan2(CASE WHEN abs(b) < 1e-9 THEN 0 ELSE -2 * b END, c - a) / 2 END, 4) + 0.0, -1.5708), 1.5708) AS orientation FROM e""")
def _roi_measure(spark, sf):
    rows = planes.measure_components(plane_table(spark, sf), 0.05).drop("slice", "channel")
    rows = rows.withColumns({c: F.round(c, 4) + F.lit(0.0) for c in ("major_axis_length", "minor_axis_length", "orientation")})
    return rows.replace({-1.5708: 1.5708}, subset=["orientation"])  # one line, two names


@_query("summary_by", f"SELECT event_type, {_r('mean', 'max', 'min', 'std', 'q95', 'q05')}, n FROM (SELECT event_type, avg(value) AS mean, max(value) AS max, min(value) AS min, stddev_samp(value) AS std, quantile_cont(value, 0.95) AS q95, quantile_cont(value, 0.05) AS q05, count(value) AS n FROM events GROUP BY 1)")
def _summary_by(spark, sf):
    return relational.summary_by(_read(spark, sf, "events"), "event_type", "value")


@_query("pi_summary", f"""WITH {_M} SELECT movie, frame, object_class, count(label) AS total_count, count(*) FILTER (pi_class = 'piNEG') AS pi_class_neg, count(*) FILTER (pi_class = 'piPOS') AS pi_class_pos,
 round(coalesce(sum(area) FILTER (pi_class = 'piNEG'), 0), 6) AS area_pineg, round(coalesce(sum(area) FILTER (pi_class = 'piPOS'), 0), 6) AS area_pipos, round(coalesce(sum(area), 0), 6) AS area_total FROM m GROUP BY 1, 2, 3""")
def _pi_summary(spark, sf):
    return relational.pi_summary(measurements(spark, sf), ("movie", "frame", "object_class"))


@_query("detection_summary", f"WITH {_M} SELECT object_class, n, round(q[1], 6) AS q05, round(q[2], 6) AS q25, round(q[3], 6) AS q50, round(q[4], 6) AS q75, round(q[5], 6) AS q95, round(n / (SELECT count(DISTINCT frame) FROM m), 6) AS per_frame FROM (SELECT object_class, count(*) AS n, quantile_cont(area, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q FROM m GROUP BY 1)")
def _detection_summary(spark, sf):
    return relational.detection_summary(measurements(spark, sf), "object_class", "area")


@_query("objects_per_frame", f"WITH {_M} SELECT frame, count(*) AS n FROM m GROUP BY 1")
def _objects_per_frame(spark, sf):
    return relational.objects_per_frame(measurements(spark, sf))


@_query("distinct_instances", f"WITH RECURSIVE {_L} SELECT movie, frame, count(DISTINCT label) AS instances FROM l GROUP BY 1, 2")
def _distinct_instances(spark, sf):
    return relational.distinct_instances(labelled(spark, sf), ("movie", "frame"))


@_query("class_join", f"""WITH {_M}, d AS (SELECT movie, frame, label, object_class, area / 500 AS detection_score FROM m WHERE event_id % 3 > 0)
SELECT m.movie, m.frame, m.label, round(m.area, 6) AS area, coalesce(d.object_class, 'unknown') AS object_class, round(coalesce(d.detection_score, 0), 6) AS detection_score FROM m LEFT JOIN d USING (movie, frame, label)""")
def _class_join(spark, sf):
    m = measurements(spark, sf)
    found = m.where("event_id % 3 > 0").select("movie", "frame", "label", "object_class", (F.col("area") / 500).alias("detection_score"))
    return relational.join_classes(m.select("movie", "frame", "label", "area"), found)


@_query("rel_intensity", f"""WITH {_M}, g AS (SELECT movie, frame, quantile_cont(area, 0.1) AS background FROM m GROUP BY 1, 2)
SELECT m.movie, m.frame, label, round(area, 6) AS mean_intensity, round(background, 6) AS background, round(area / nullif(background, 0), 4) AS rel_mean_intensity FROM m LEFT JOIN g USING (movie, frame)""")
def _rel_intensity(spark, sf):
    m = measurements(spark, sf)
    ground = m.groupBy("movie", "frame").agg(F.percentile("area", F.lit(0.1)).alias("background"))
    rows = m.select("movie", "frame", "label", F.col("area").alias("mean_intensity"))
    rows = relational.relative_intensity(relational.join_per_frame(rows, ground), ("mean_intensity",))
    return rows.withColumn("rel_mean_intensity", F.round("rel_mean_intensity", 4))


@_query("second_channel", f"""WITH {_M} SELECT a.movie, a.frame, a.label, round(b.area, 6) AS mean_intensity_gfp, round(b.area / 2, 6) AS gfp_background FROM m a LEFT JOIN (SELECT * FROM m WHERE event_id % 2 = 0) b USING (movie, frame, label)""")
def _second_channel(spark, sf):
    m = measurements(spark, sf)
    other = m.where("event_id % 2 = 0").select("movie", "frame", "label", F.col("area").alias("mean_intensity"), (F.col("area") / 2).alias("background"))
    return relational.join_second_channel(m.select("movie", "frame", "label"), other)


@_query("track_join", f"WITH {_M} SELECT a.movie, a.frame, a.label, coalesce(b.trackid, -1) AS trackid FROM m a LEFT JOIN (SELECT * FROM m WHERE event_id % 5 > 0) b USING (movie, frame, label)")
def _track_join(spark, sf):
    m = measurements(spark, sf)
    return relational.join_tracks(m.select("movie", "frame", "label"), m.where("event_id % 5 > 0"))


@_query("pipos_lockin", f"""WITH {_M}, f AS (SELECT *, min(frame) FILTER (pi_class = 'piPOS') OVER (PARTITION BY movie, trackid) AS first FROM m)
SELECT event_id, movie, trackid, frame, CASE WHEN trackid <> -1 AND frame > first THEN 'piPOS' ELSE pi_class END AS pi_class FROM f""")
def _pipos_lockin(spark, sf):
    return relational.lock_in(measurements(spark, sf)).select("event_id", "movie", "trackid", "frame", "pi_class")


@_query("lockin_stats", f"""WITH {_M}, f AS (SELECT *, min(frame) FILTER (pi_class = 'piPOS') OVER (PARTITION BY movie, trackid) AS first FROM m),
g AS (SELECT *, CASE WHEN trackid <> -1 AND frame > first THEN 'piPOS' ELSE pi_class END AS now FROM f)
SELECT count(*) FILTER (pi_class = 'piPOS') AS before, count(*) FILTER (now = 'piPOS') AS after, count(*) FILTER (now <> pi_class) AS overridden, count(DISTINCT (movie, trackid)) FILTER (now <> pi_class) AS tracks FROM g""")
def _lockin_stats(spark, sf):
    return relational.lock_in_stats(measurements(spark, sf))


@_query("label_offsets", f"WITH {_M}, n AS (SELECT movie, frame, count(*) AS n FROM m GROUP BY 1, 2) SELECT movie, frame, n, CAST(coalesce(sum(n) OVER (PARTITION BY movie ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS \"offset\" FROM n")
def _label_offsets(spark, sf):
    return relational.label_offsets(measurements(spark, sf).groupBy("movie", "frame").agg(F.count(F.lit(1)).alias("n")))


@_query("global_labels", f"WITH {_M}, n AS (SELECT movie, frame, count(*) AS n FROM m GROUP BY 1, 2), o AS (SELECT movie, frame, CAST(coalesce(sum(n) OVER (PARTITION BY movie ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS o FROM n) SELECT event_id, movie, frame, label + o AS label FROM m JOIN o USING (movie, frame)")
def _global_labels(spark, sf):
    m = measurements(spark, sf).select("event_id", "movie", "frame", "label")
    offsets = relational.label_offsets(m.groupBy("movie", "frame").agg(F.count(F.lit(1)).alias("n")))
    return relational.offset_labels(m, offsets).select("event_id", "movie", "frame", "label")


@_query("time_metadata", f"""WITH {_M}, t AS (SELECT movie, frame, CAST(min(event_id) * 250 AS BIGINT) AS lag FROM m GROUP BY 1, 2),
w AS (SELECT *, max(CASE WHEN frame = 0 THEN lag END) OVER (PARTITION BY movie) AS zero, first_value(lag) OVER (PARTITION BY movie ORDER BY frame) AS base FROM t)
SELECT movie, frame, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_milliseconds(lag - base), '%Y-%m-%d %H:%M:%S') AS date_time, round((lag - zero) / 3600000, 6) AS timestep, round(lag / 1000, 6) AS abslag_in_s FROM w""")
def _time_metadata(spark, sf):
    t = measurements(spark, sf).groupBy("movie", "frame").agg((F.min("event_id") * 250).alias("lag_ms"))
    return relational.time_table(t, F.lit("2024-01-01 00:00:00").cast("timestamp"))


@_query("track_extents", f"""WITH {_M}, d AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY movie, trackid, frame ORDER BY label) = 1)
SELECT movie, trackid, min(frame) AS first_frame, max(frame) AS last_frame, round(arg_min(centroid_0, frame), 6) AS first_y, round(arg_min(centroid_1, frame), 6) AS first_x, round(arg_max(centroid_0, frame), 6) AS last_y, round(arg_max(centroid_1, frame), 6) AS last_x, count(DISTINCT frame) AS n_frames FROM d GROUP BY 1, 2""")
def _track_extents(spark, sf):
    return relational.track_extents(_one_per_frame(spark, sf)).withColumn("n_frames", F.size("frames").cast("long")).drop("frames")


def _one_per_frame(spark: SparkSession, sf: str) -> DataFrame:
    """One object of each track in a frame, as trackers give."""
    m = measurements(spark, sf)
    return m.groupBy("movie", "trackid", "frame").agg(F.min_by(F.struct("centroid_0", "centroid_1"), "label").alias("c")).select("movie", "trackid", "frame", "c.*")


@_query("track_stats", f"""WITH {_M}, d AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY movie, trackid, frame ORDER BY label) = 1),
n AS (SELECT movie, trackid, count(DISTINCT frame) AS n FROM d GROUP BY 1, 2), k AS (SELECT sqrt((centroid_0 - lag(centroid_0) OVER w) ** 2 + (centroid_1 - lag(centroid_1) OVER w) ** 2) AS s FROM d WINDOW w AS (PARTITION BY movie, trackid ORDER BY frame))
SELECT (SELECT count(*) FROM n) AS tracks, (SELECT count(*) FROM n WHERE n = (SELECT count(DISTINCT frame) FROM d)) AS full_length, (SELECT count(*) FROM n WHERE n = 1) AS single_frame, (SELECT round(quantile_cont(n, 0.5), 6) FROM n) AS median_length,
 round(avg(s), 6) AS mean_link, round(quantile_cont(s, 0.95), 6) AS p95_link, round(max(s), 6) AS max_link FROM k WHERE s IS NOT NULL""")
def _track_stats(spark, sf):
    return relational.track_stats(_one_per_frame(spark, sf))


@_query("stitch_candidates", f"""WITH {_M}, d AS (SELECT *, trackid * 1000 + frame // 24 AS piece FROM m QUALIFY row_number() OVER (PARTITION BY movie, trackid, frame ORDER BY label) = 1),
e AS (SELECT movie, piece, min(frame) AS f, max(frame) AS l, arg_min(centroid_0, frame) AS fy, arg_min(centroid_1, frame) AS fx, arg_max(centroid_0, frame) AS ly, arg_max(centroid_1, frame) AS lx FROM d GROUP BY 1, 2)
SELECT a.movie, a.piece AS a, b.piece AS b, round(sqrt((b.fy - a.ly) ** 2 + (b.fx - a.lx) ** 2), 6) AS distance FROM e a JOIN e b ON a.movie = b.movie AND a.l < b.f AND a.piece <> b.piece AND sqrt((b.fy - a.ly) ** 2 + (b.fx - a.lx) ** 2) <= 40""")
def _stitch_candidates(spark, sf):
    rows = _one_per_frame(spark, sf).withColumn("trackid", (F.col("trackid") * 1000 + F.floor(F.col("frame") / 24)).cast("int"))
    return relational.stitch_candidates(relational.track_extents(rows), 40.0)


@_query("clump_pairs", f"""WITH {_B} SELECT p.movie, p.frame, p.box AS a, q.box AS b, round((least(p.x2, q.x2) - greatest(p.x1, q.x1)) * (least(p.y2, q.y2) - greatest(p.y1, q.y1)), 6) AS overlap
FROM b p JOIN b q ON p.movie = q.movie AND p.frame = q.frame AND p.box < q.box AND least(p.x2, q.x2) > greatest(p.x1, q.x1) AND least(p.y2, q.y2) > greatest(p.y1, q.y1) WHERE (least(p.x2, q.x2) - greatest(p.x1, q.x1)) * (least(p.y2, q.y2) - greatest(p.y1, q.y1)) >= 50""")
def _clump_pairs(spark, sf):
    return relational.overlapping_boxes(boxes(spark, sf), 50.0, 64.0)


@_query("box_centres_union", f"""WITH {_B} SELECT movie, frame, round((x1 + x2) / 2, 6) AS x, round((y1 + y2) / 2, 6) AS y, CASE class_id WHEN 0 THEN 'single-cell' WHEN 1 THEN 'clump' ELSE 'class_' || class_id END AS object_class, 'standard' AS source FROM b WHERE score >= 0.5
UNION ALL SELECT movie, frame, round((x1 + x2) / 2, 6), round((y1 + y2) / 2, 6), 'oof_' || class_id, 'oof' FROM b WHERE score >= 0.8""")
def _box_centres_union(spark, sf):
    b = boxes(spark, sf)
    return relational.box_centres(b, {0: "single-cell", 1: "clump"}, "standard", 0.5, "class_").unionByName(relational.box_centres(b, None, "oof", 0.8))


@_query("nearest_drift", f"""WITH {_B}, r AS (SELECT movie, x1 AS rx, min(y1) AS ry FROM b WHERE frame = 0 GROUP BY 1, 2), f AS (SELECT DISTINCT movie, frame, x1 AS x, y1 AS y FROM b WHERE frame > 0),
n AS (SELECT movie, frame, x, y, arg_min(rx, (abs(x - rx), rx)) AS rx, arg_min(ry, (abs(x - rx), rx)) AS ry FROM f JOIN r USING (movie) GROUP BY 1, 2, 3, 4)
SELECT movie, frame, round(quantile_cont(x - rx, 0.5), 6) AS dx, round(quantile_cont(y - ry, 0.5), 6) AS dy FROM n WHERE abs(x - rx) <= 300 AND abs(y - ry) <= 300 GROUP BY 1, 2""")
def _nearest_drift(spark, sf):
    b = boxes(spark, sf)
    ref = b.where("frame = 0").groupBy("movie", F.col("x1").alias("x")).agg(F.min("y1").alias("y"))
    found = b.where("frame > 0").select("movie", "frame", F.col("x1").alias("x"), F.col("y1").alias("y")).distinct()
    return relational.frame_drift(relational.nearest_reference(found, ref, 300.0))


@_query("confusion_matrix", "SELECT quality, round(count(*) FILTER (toxic = 0) / count(*) FILTER (toxic IN (0, 1)), 6) AS p_0, round(count(*) FILTER (toxic = 1) / count(*) FILTER (toxic IN (0, 1)), 6) AS p_1 FROM labels GROUP BY 1")
def _confusion_matrix(spark, sf):
    return relational.confusion_matrix(_read(spark, sf, "labels"), "quality", "toxic", (0, 1))


@_query("grouped_histogram", "WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events) SELECT event_type, CAST(least(29, floor((value - lo) / ((hi - lo) / 30))) AS INTEGER) AS bin, count(*) AS n FROM events, e WHERE value IS NOT NULL GROUP BY 1, 2")
def _grouped_histogram(spark, sf):
    return relational.grouped_histogram(_read(spark, sf, "events"), "event_type", "value")


@_query("cluster_binder", "SELECT p_partkey, p_brand, CASE WHEN p_size IN (1, 2, 3, 4, 5) THEN 'small' WHEN p_size IN (5, 6, 7, 8, 9, 10) THEN 'medium' END AS cluster FROM part")
def _cluster_binder(spark, sf):
    groups = spark.createDataFrame([(k, v, i) for i, (k, vs) in enumerate({"small": range(1, 6), "medium": range(5, 11)}.items()) for v in vs], "key string, value int, position int")
    return relational.bind_clusters(_read(spark, sf, "part"), groups, "p_size").select("p_partkey", "p_brand", "cluster")


@_query("resume_antijoin", "WITH f AS (SELECT o_orderkey, 'img' || o_orderkey AS stem FROM orders), d AS (SELECT 'img' || l_orderkey AS stem, CASE WHEN l_linenumber % 2 = 0 THEN '_fl.csv' ELSE '_summary.csv' END AS ending FROM lineitem) SELECT o_orderkey, stem FROM f WHERE stem NOT IN (SELECT stem FROM d GROUP BY 1 HAVING count(DISTINCT ending) = 2)")
def _resume_antijoin(spark, sf):
    files = _read(spark, sf, "orders").selectExpr("o_orderkey", "concat('img', o_orderkey) AS stem")
    done = _read(spark, sf, "lineitem").selectExpr("concat('img', l_orderkey) AS stem", "CASE WHEN l_linenumber % 2 = 0 THEN '_fl.csv' ELSE '_summary.csv' END AS ending")
    return relational.unfinished(files, done).select("o_orderkey", "stem")


@_query("split_blocks", "SELECT s_suppkey, s_name, CAST(floor((row_number() OVER (ORDER BY s_name, s_suppkey) - 1) / ceil((SELECT count(*) FROM supplier) / 7)) AS INTEGER) AS block FROM supplier")
def _split_blocks(spark, sf):
    return relational.split_blocks(_read(spark, sf, "supplier").select("s_suppkey", "s_name"), 7, "s_name")


@_query("binary_mask", f"WITH {_P} SELECT movie, frame, y, x, value > 0.05 AS on FROM p".replace(" AS on ", ' AS "on" '))
def _binary_mask(spark, sf):
    return pixels.threshold(pixel_table(spark, sf), 0.05).drop("value")


@_query("connected_components", f"WITH RECURSIVE {_L} SELECT movie, frame, y, x, label FROM l")
def _connected_components(spark, sf):
    return labelled(spark, sf).drop("value")


@_query("size_filter_relabel", f"WITH RECURSIVE {_L}, k AS (SELECT movie, frame, label, dense_rank() OVER (PARTITION BY movie, frame ORDER BY label) AS n FROM (SELECT movie, frame, label FROM l GROUP BY ALL HAVING count(*) >= 3)) SELECT movie, frame, y, x, CAST(n AS INTEGER) AS label FROM l JOIN k USING (movie, frame, label)")
def _size_filter_relabel(spark, sf):
    return pixels.size_filter(labelled(spark, sf), 3, ("movie", "frame")).select("movie", "frame", "y", "x", "label")


@_query("value_map_mask", f"WITH RECURSIVE {_L} SELECT movie, frame, y, x, CASE WHEN label % 2 = 1 THEN label * 10 ELSE 0 END AS code FROM l")
def _value_map_mask(spark, sf):
    l = labelled(spark, sf)
    codes = l.where("label % 2 = 1").select("movie", "frame", "label", (F.col("label") * 10).alias("code")).distinct()
    return pixels.map_values(l, codes).select("movie", "frame", "y", "x", "code")


@_query("background_q10", f"WITH {_P} SELECT movie, frame, round(quantile_cont(value, 0.1) FILTER (value <= 0.05), 6) AS background FROM p GROUP BY 1, 2")
def _background_q10(spark, sf):
    rows = pixel_table(spark, sf).withColumn("label", (F.col("value") > 0.05).cast("int"))
    return pixels.background_quantile(rows)


@_query("pixel_stats", f"WITH {_P} SELECT movie, frame, round(avg(value), 6) AS mean FROM p GROUP BY 1, 2")
def _pixel_stats(spark, sf):
    return pixels.plane_means(pixel_table(spark, sf))


@_query("min_projection_crop", f"WITH {_P}, n AS (SELECT movie, y, x, min(value) AS v FROM p GROUP BY ALL), z AS (SELECT * FROM n WHERE v > -0.42) SELECT movie, min(y) AS y0, max(y) + 1 AS y1, min(x) AS x0, max(x) + 1 AS x1 FROM z GROUP BY 1")
def _min_projection_crop(spark, sf):
    low = pixels.min_projection(pixel_table(spark, sf))
    return pixels.crop_box(low.withColumn("value", F.when(F.col("value") > -0.42, F.col("value")).otherwise(0.0)))


@_query("max_projection", f"WITH {_P} SELECT movie, y, x, round(max(value), 6) AS value FROM p GROUP BY ALL")
def _max_projection(spark, sf):
    return pixels.max_projection(pixel_table(spark, sf), ("movie",))


for _mode, _by in (("global", "movie"), ("frame", "movie, frame")):

    @_query(f"convert_scale_{_mode}", f"WITH {_P}, e AS (SELECT *, min(value) OVER w AS lo, max(value) OVER w AS hi FROM p WINDOW w AS (PARTITION BY {_by})) SELECT movie, frame, y, x, CAST(floor(coalesce((value - lo) / nullif(hi - lo, 0), 0) * 255) AS INTEGER) AS scaled FROM e")
    def _convert_scale(spark, sf, mode=_mode):
        return pixels.convert_scale(pixel_table(spark, sf), "uint8", mode).drop("value")


@_query("convert_scale_channel", f"WITH {_P}, e AS (SELECT *, min(value) OVER w AS lo, max(value) OVER w AS hi FROM (SELECT *, frame % 2 AS channel FROM p) WINDOW w AS (PARTITION BY movie, channel)) SELECT movie, channel, frame, y, x, CAST(floor(coalesce((value - lo) / nullif(hi - lo, 0), 0) * 65535) AS INTEGER) AS scaled FROM e")
def _convert_scale_channel(spark, sf):
    return pixels.convert_scale(pixel_table(spark, sf).withColumn("channel", F.col("frame") % 2), "uint16", "channel").drop("value")


@_query("zscore_plane", f"WITH {_P} SELECT movie, frame, y, x, round((value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0), 6) AS z FROM p WINDOW w AS (PARTITION BY movie, frame)")
def _zscore_plane(spark, sf):
    return pixels.zscore(pixel_table(spark, sf)).drop("value")


@_query("laplacian", f"WITH {_P} SELECT movie, frame, y, x, round(value, 6) AS value FROM (SELECT movie, frame, y, x, lag(value, 1) OVER r + lead(value, 1) OVER r + lag(value, 1) OVER c + lead(value, 1) OVER c - 4 * value AS value FROM p WINDOW r AS (PARTITION BY movie, frame, y ORDER BY x), c AS (PARTITION BY movie, frame, x ORDER BY y)) WHERE value IS NOT NULL")
def _laplacian(spark, sf):
    return pixels.laplacian(pixel_table(spark, sf))


@_query("variance_filter", f"WITH {_P} SELECT a.movie, a.frame, a.y, a.x, round(avg(b.value * b.value) - avg(b.value) ** 2, 6) AS value FROM p a JOIN p b ON a.movie = b.movie AND a.frame = b.frame AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY ALL HAVING count(*) = 9")
def _variance_filter(spark, sf):
    return pixels.variance_filter(pixel_table(spark, sf))


_SERIES = f"{_M}, s AS (SELECT movie, frame, avg(area) AS v FROM m GROUP BY 1, 2)"


def _series(spark, sf):
    return measurements(spark, sf).groupBy("movie", "frame").agg(F.avg("area").alias("v"))


@_query("moving_median", f"WITH {_SERIES} SELECT movie, frame, round(quantile_cont(v, 0.5) OVER (PARTITION BY movie ORDER BY frame ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS v FROM s")
def _moving_median(spark, sf):
    return pixels.moving_median(_series(spark, sf), "v", 7)


@_query("box_smooth", f"WITH {_SERIES} SELECT movie, frame, round(sum(v) OVER (PARTITION BY movie ORDER BY frame ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING) / 31, 6) AS v FROM s")
def _box_smooth(spark, sf):
    return pixels.box_smooth(_series(spark, sf), "v", 31, ("movie",), "frame")


@_query("interp_nan", f"""WITH {_SERIES}, g AS (SELECT movie, frame, CASE WHEN frame % 3 > 0 THEN v END AS v FROM s),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER b AS a, last_value(CASE WHEN v IS NOT NULL THEN frame END IGNORE NULLS) OVER b AS ta, first_value(v IGNORE NULLS) OVER n AS z, first_value(CASE WHEN v IS NOT NULL THEN frame END IGNORE NULLS) OVER n AS tz FROM g
 WINDOW b AS (PARTITION BY movie ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY movie ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT movie, frame, round(coalesce(v, a + (z - a) * ((frame - ta) / nullif(tz - ta, 0)), a, z, 0), 6) AS v FROM f""")
def _interp_nan(spark, sf):
    return pixels.interpolate(_series(spark, sf).withColumn("v", F.when(F.col("frame") % 3 > 0, F.col("v"))), "v")


@_query("local_dips", f"""WITH {_SERIES}, d AS (SELECT movie, frame, v, lag(v) OVER w AS b, lead(v) OVER w AS a, max(v) OVER (PARTITION BY movie ORDER BY frame ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS l, max(v) OVER (PARTITION BY movie ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS r FROM s WINDOW w AS (PARTITION BY movie ORDER BY frame))
SELECT movie, frame, round(v, 6) AS v, round(least(l, r) - v, 6) AS depth FROM d WHERE v <= b AND v < a AND least(l, r) - v >= 20""")
def _local_dips(spark, sf):
    return pixels.local_dips(_series(spark, sf), "v", 10, 20.0, ("movie",), "frame")


@_query("roi_skew_std", "SELECT event_type, round(skewness(value), 6) AS roi_skewness, round(stddev_pop(value), 6) AS roi_std_dev FROM events GROUP BY 1")
def _roi_skew_std(spark, sf):
    return _read(spark, sf, "events").groupBy("event_type").agg(pixels.skewness(F.col("value")).alias("roi_skewness"), F.stddev_pop("value").alias("roi_std_dev"))


@_query("quartiles", f"WITH RECURSIVE {_L} SELECT movie, frame, label, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75 FROM l GROUP BY 1, 2, 3")
def _quartiles(spark, sf):
    return pixels.quartiles(labelled(spark, sf))


@_query("dilated_measures", f"""WITH RECURSIVE {_L}, g AS (SELECT DISTINCT l.movie, l.frame, l.label, p.y, p.x, p.value FROM l JOIN p ON l.movie = p.movie AND l.frame = p.frame AND abs(l.y - p.y) <= 2 AND abs(l.x - p.x) <= 2)
SELECT movie, frame, label, round(stddev_pop(value), 6) AS dilated_std, round(avg(value), 6) AS dilated_mean, round(min(value), 6) AS dilated_min, round(max(value), 6) AS dilated_max, count(*) AS dilated_area FROM g GROUP BY 1, 2, 3""")
def _dilated_measures(spark, sf):
    return planes.dilated_measures(labelled(spark, sf), pixel_table(spark, sf))


@_query("coords_json", f"WITH RECURSIVE {_L} SELECT movie, frame, label, '[' || string_agg('[' || y || ',' || x || ']', ',' ORDER BY y, x) || ']' AS coords FROM l GROUP BY 1, 2, 3")
def _coords_json(spark, sf):
    return labelled(spark, sf).groupBy("movie", "frame", "label").agg(F.collect_list(F.struct("y", "x")).alias("c")).select("movie", "frame", "label", fs.coords_json(F.col("c")).alias("coords"))


@_query("tilt_fit", f"WITH {_B} SELECT movie, frame, round(regr_slope(y1, x1), 6) AS slope, round(regr_intercept(y1, x1), 6) AS intercept, round(degrees(atan(regr_slope(y1, x1))), 6) AS tilt FROM b GROUP BY 1, 2")
def _tilt_fit(spark, sf):
    return pixels.line_fit(boxes(spark, sf).select("movie", "frame", F.col("y1").alias("y"), F.col("x1").alias("x")))


@_query("x_calibration", f"""WITH {_B}, s AS (SELECT movie, frame, min(x1) AS lo, max(x1) AS hi, count(*) AS n FROM b GROUP BY 1, 2), w AS (SELECT *, CASE WHEN n >= 2 THEN lo > 40 ELSE lo > 300 END AS l, CASE WHEN n >= 2 THEN hi < 960 ELSE hi < 700 END AS r FROM s)
SELECT movie, frame, CASE WHEN l AND r THEN 'BOTH' WHEN l THEN 'LEFT' WHEN r THEN 'RIGHT' ELSE 'centre' END || CASE WHEN n < 2 AND (l OR r) THEN '_n1' ELSE '' END AS "case",
 CASE WHEN l THEN greatest(0, CAST(round_even(lo + CASE WHEN n >= 2 THEN 0 ELSE -100 END - 20, 0) AS INTEGER)) ELSE 0 END AS x0, CASE WHEN r THEN least(1100, CAST(round_even(hi + CASE WHEN n >= 2 THEN 0 ELSE 100 END + 20, 0) AS INTEGER)) ELSE 1100 END AS x1 FROM w""")
def _x_calibration(spark, sf):
    b = boxes(spark, sf).select("movie", "frame", F.col("x1").alias("x"))
    return pixels.x_band(b, 1100, {"threshold": 40, "offset": -20, "single_threshold": 300, "spacing": 100}, {"threshold": 960, "offset": 20, "single_threshold": 700, "spacing": 100})


@_query("y_calibration", f"WITH {_B} SELECT box, greatest(0, CAST(round_even((y1 + y2) / 2 - 80, 0) AS INTEGER)) AS y0, least(1000, CAST(round_even((y1 + y2) / 2 + 77.5, 0) AS INTEGER)) AS y1 FROM b")
def _y_calibration(spark, sf):
    return boxes(spark, sf).select("box", fs.y_band((F.col("y1") + F.col("y2")) / 2, -80.0, 77.5, 1000).alias("r")).select("box", "r.y0", "r.y1")


@_query("clamp_tilt", f"WITH {_M} SELECT event_id, round(greatest(-1, least(1, centroid_0 / 500 - 1)), 6) AS angle, centroid_0 / 500 - 1 NOT BETWEEN -1 AND 1 AS clamped FROM m")
def _clamp_tilt(spark, sf):
    return measurements(spark, sf).select("event_id", fs.clamp_tilt(F.col("centroid_0") / 500 - 1, 1.0).alias("r")).select("event_id", "r.angle", "r.clamped")


@_query("unit_round_odd", "SELECT p_partkey, round(p_size * 0.65, 6) AS um, round(p_size / 0.65, 6) AS pixel, CAST(CASE WHEN (p_retailprice / 10) % 2 = 1 THEN trunc(p_retailprice / 10) ELSE trunc(p_retailprice / 10) + 1 END AS BIGINT) AS odd FROM part")
def _unit_round_odd(spark, sf):
    return _read(spark, sf, "part").select("p_partkey", fs.convert_unit(F.col("p_size"), 0.65, "um").alias("um"), fs.convert_unit(F.col("p_size"), 0.65, "pixel").alias("pixel"), fs.round_to_odd(F.col("p_retailprice") / 10).alias("odd"))


@_query("strip_extension", r"SELECT o_orderkey, regexp_replace('img' || o_orderkey || ['.nd2', '.ome.p.tiff', '.p.tiff', '.ome.tiff', '.tiff', '.tif', '.csv'][CAST(o_orderkey % 7 AS INTEGER) + 1], '\.(nd2|ome\.p\.tiff|p\.tiff|ome\.tiff|tiff)$', '') AS stem FROM orders")
def _strip_extension(spark, sf):
    ending = F.element_at(F.array(*(F.lit(e) for e in (".nd2", ".ome.p.tiff", ".p.tiff", ".ome.tiff", ".tiff", ".tif", ".csv"))), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return _read(spark, sf, "orders").select("o_orderkey", fs.strip_extension(F.concat(F.lit("img"), F.col("o_orderkey").cast("string"), ending)).alias("stem"))


@_query("one_hot", "SELECT p_partkey, array_to_string([CASE WHEN p_size % 4 = i THEN 1 ELSE 0 END FOR i IN range(4)], '') AS code FROM part")
def _one_hot(spark, sf):
    return _read(spark, sf, "part").select("p_partkey", F.array_join(fs.one_hot(F.col("p_size") % 4, 4).cast("array<string>"), "").alias("code"))


@_query("relative_difference", f"WITH {_M} SELECT event_id, round(abs(area - centroid_0) / greatest(least(area, centroid_0), 1.0), 6) AS d FROM m")
def _relative_difference(spark, sf):
    return measurements(spark, sf).select("event_id", fs.relative_difference(F.col("area"), F.col("centroid_0"), 1.0).alias("d"))


def _track_input(spark, sf):
    return measurements(spark, sf).select("movie", "frame", "label", "centroid_0", "centroid_1", "area")


@_query("hungarian_v2")
def _hungarian_v2(spark, sf):
    return tracks.track_objects(_track_input(spark, sf), tracks.GapTracker(60.0, 2)).drop("parent_track_id")


@_query("hungarian_v5")
def _hungarian_v5(spark, sf):
    return tracks.track_objects(_track_input(spark, sf), tracks.DivisionTracker(max_distance=60.0))


def _nms_sql(rival: str) -> str:
    """Greedy suppression, box by box in falling rank: the state is the list of boxes kept so far."""
    return f"""WITH RECURSIVE {_B}, r AS (
  SELECT *, row_number() OVER (PARTITION BY movie, frame ORDER BY rank DESC, x1, y1, x2, y2, class_id, score) AS n FROM (
    SELECT *, score + 1e-7 * ((x2 - x1) * (y2 - y1)) / greatest(max((x2 - x1) * (y2 - y1)) OVER (PARTITION BY movie, frame), 1e-12) AS rank FROM b)),
s AS (
  SELECT movie, frame, CAST(0 AS BIGINT) AS n, CAST([] AS STRUCT(x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE, class_id INTEGER, score DOUBLE)[]) AS kept FROM b GROUP BY 1, 2
  UNION ALL
  SELECT s.movie, s.frame, r.n, CASE WHEN len(list_filter(s.kept, lambda k: {rival}
      greatest(least(k.x2, r.x2) - greatest(k.x1, r.x1), 0) * greatest(least(k.y2, r.y2) - greatest(k.y1, r.y1), 0)
      > 0.4 * ((k.x2 - k.x1) * (k.y2 - k.y1) + (r.x2 - r.x1) * (r.y2 - r.y1) - greatest(least(k.x2, r.x2) - greatest(k.x1, r.x1), 0) * greatest(least(k.y2, r.y2) - greatest(k.y1, r.y1), 0)))) = 0
    THEN list_append(s.kept, struct_pack(x1 := r.x1, y1 := r.y1, x2 := r.x2, y2 := r.y2, class_id := r.class_id, score := r.score)) ELSE s.kept END
  FROM s JOIN r ON r.movie = s.movie AND r.frame = s.frame AND r.n = s.n + 1
)
SELECT movie, frame, k.x1 AS x1, k.y1 AS y1, k.x2 AS x2, k.y2 AS y2, k.class_id AS class_id, round(k.score, 6) AS score
FROM (SELECT movie, frame, unnest(kept) AS k FROM (SELECT movie, frame, arg_max(kept, n) AS kept FROM s GROUP BY 1, 2))"""


@_query("nms", _nms_sql(""))
def _nms(spark, sf):
    return detect.suppress(boxes(spark, sf).drop("box"), 0.4)


@_query("nms_per_class", _nms_sql("k.class_id = r.class_id AND"))
def _nms_per_class(spark, sf):
    return detect.suppress(boxes(spark, sf).drop("box"), 0.4, per_class=True)


@_query("shape_measures")
def _shape_measures(spark, sf):
    return planes.shape_measures(planes.label_planes(plane_table(spark, sf), 0.05, 1))


def plane_table(spark: SparkSession, sf: str) -> DataFrame:
    """``embeddings`` as encoded planes."""
    from ..schema import PLANE

    e = _read(spark, sf, "embeddings").selectExpr("concat('m', vec_id % 4) AS movie", "cast(vec_id div 4 AS int) AS frame", "embedding")

    def run(batches):
        import numpy as np
        import pandas as pd

        for df in batches:
            rows = [(m, f, 0, 0, 8, 8, "float32", np.asarray(v, np.float32).tobytes()) for m, f, v in zip(df["movie"], df["frame"], df["embedding"])]
            yield pd.DataFrame(rows, columns=[x.name for x in PLANE])

    return e.mapInPandas(run, PLANE)


def _blur_sql(source: str, size: int) -> str:
    """CTE ``g``: ``source`` (movie, frame, y, x, value) blurred by ``size`` taps, borders mirrored."""
    from ..operators.kernels import gaussian_kernel

    taps = ", ".join(f"({i - size // 2}, {w!r}::DOUBLE)" for i, w in enumerate(gaussian_kernel(size).tolist()))
    mirror = lambda c: f"CASE WHEN abs({c}) % 14 >= 8 THEN 14 - abs({c}) % 14 ELSE abs({c}) % 14 END"
    return f"""taps AS (SELECT * FROM (VALUES {taps}) t(d, w)),
down AS (SELECT a.movie, a.frame, a.y, a.x, sum(w * b.value) AS value FROM {source} a, taps, {source} b WHERE a.movie = b.movie AND a.frame = b.frame AND a.x = b.x AND b.y = {mirror('(a.y + d)')} GROUP BY ALL),
g AS (SELECT a.movie, a.frame, a.y, a.x, sum(w * b.value) AS value FROM down a, taps, down b WHERE a.movie = b.movie AND a.frame = b.frame AND a.y = b.y AND b.x = {mirror('(a.x + d)')} GROUP BY ALL)"""


@_query("plane_background", f"WITH {_P}, {_blur_sql('p', 5)} SELECT movie, frame, 0 AS slice, 0 AS channel, y, x, round(CAST(CAST(greatest(p.value - g.value, 0) AS FLOAT) AS DOUBLE), 6) AS value FROM p JOIN g USING (movie, frame, y, x)")
def _plane_background(spark, sf):
    return planes.to_pixels(planes.clear_background(plane_table(spark, sf), 5.0, "pixel", "subtract"))


@_query("plane_tiles", f"WITH {_P}, o AS (SELECT unnest([0, 2, 4]) AS o) SELECT movie, frame, CAST(a.o AS INTEGER) AS off_y, CAST(c.o AS INTEGER) AS off_x, 4 AS valid_h, 4 AS valid_w FROM (SELECT DISTINCT movie, frame FROM p), o a, o c")
def _plane_tiles(spark, sf):
    t = planes.tiles(plane_table(spark, sf), 4, 0.33)
    return t.select("movie", "frame", "off_y", "off_x", "valid_h", "valid_w")


@_query("plane_labels", f"WITH RECURSIVE {_L}, k AS (SELECT movie, frame, label, dense_rank() OVER (PARTITION BY movie, frame ORDER BY label) AS n FROM (SELECT movie, frame, label FROM l GROUP BY ALL HAVING count(*) >= 3)) SELECT movie, frame, 0 AS slice, 0 AS channel, y, x, CAST(n AS DOUBLE) AS value FROM l JOIN k USING (movie, frame, label)")
def _plane_labels(spark, sf):
    return planes.to_pixels(planes.label_planes(plane_table(spark, sf), 0.05, 3)).where("value > 0")


#: Phase correlation by the sums of the discrete transform: the peak is the shift to the first frame.
_PHASE = f"""WITH {_P}, z AS (SELECT movie, frame, y, x, value - avg(value) OVER (PARTITION BY movie, frame) AS value FROM p), e AS (SELECT unnest(range(8)) AS i),
w AS (SELECT movie, frame, u.i AS u, v.i AS v, sum(value * cos(2 * pi() * (u.i * y + v.i * x) / 8)) AS re, -sum(value * sin(2 * pi() * (u.i * y + v.i * x) / 8)) AS im FROM z, e u, e v GROUP BY 1, 2, 3, 4),
r AS (SELECT b.movie, b.frame, u, v, a.re * b.re + a.im * b.im AS re, a.im * b.re - a.re * b.im AS im FROM w b JOIN (SELECT * FROM w QUALIFY frame = min(frame) OVER (PARTITION BY movie)) a USING (movie, u, v)),
c AS (SELECT movie, frame, y.i AS y, x.i AS x, sum((re * cos(2 * pi() * (u * y.i + v * x.i) / 8) - im * sin(2 * pi() * (u * y.i + v * x.i) / 8)) / greatest(sqrt(re * re + im * im), 1e-12)) AS c FROM r, e y, e x GROUP BY 1, 2, 3, 4),
k AS (SELECT movie, frame, y, x, frame = min(frame) OVER (PARTITION BY movie) AS first FROM c QUALIFY row_number() OVER (PARTITION BY movie, frame ORDER BY c DESC, y, x) = 1)
SELECT movie, frame, CAST(CASE WHEN first THEN 0 WHEN y > 4 THEN y - 8 ELSE y END AS INTEGER) AS dy, CAST(CASE WHEN first THEN 0 WHEN x > 4 THEN x - 8 ELSE x END AS INTEGER) AS dx FROM k"""


@_query("plane_alignment", _PHASE)
def _plane_alignment(spark, sf):
    return planes.align_shifts(plane_table(spark, sf))


@_query("roi_crops", f"WITH RECURSIVE {_L}, k AS (SELECT movie, frame, label, dense_rank() OVER (PARTITION BY movie, frame ORDER BY label) AS n FROM (SELECT movie, frame, label FROM l GROUP BY ALL HAVING count(*) >= 3)), g AS (SELECT movie, frame, CAST(n AS INTEGER) AS label, sum(CAST(value AS FLOAT)) AS total, greatest(max(y) - min(y), max(x) - min(x)) + 1 AS side FROM l JOIN k USING (movie, frame, label) GROUP BY 1, 2, 3) SELECT movie, frame, label, 144 AS bytes, CASE WHEN side <= 6 THEN round(total, 4) END AS total FROM g")
def _roi_crops(spark, sf):
    p = plane_table(spark, sf)
    parts = planes.label_planes(p, 0.05, 3)
    crops = planes.roi_crops(p, parts, 6)

    def sums(batches):  # a crop that was not shrunk holds its object's pixels
        import numpy as np

        for df in batches:
            yield df.assign(bytes=[len(v) for v in df["pixels"]], total=[float(np.frombuffer(v, np.float32).sum(dtype=float)) for v in df["pixels"]])[["movie", "frame", "label", "bytes", "total"]]

    box = planes.measure_components(p, 0.05, 3).select("movie", "frame", "label", F.greatest(F.col("bbox_y1") - F.col("bbox_y0"), F.col("bbox_x1") - F.col("bbox_x0")).alias("side"))
    found = crops.mapInPandas(sums, "movie string, frame int, label int, bytes int, total double").join(box, ["movie", "frame", "label"])
    return found.select("movie", "frame", "label", "bytes", F.when(F.col("side") <= 6, F.round("total", 4)).alias("total"))


@_query("flat_field", f"""WITH {_P}, a AS (SELECT movie, 0 AS frame, y, x, avg(value) AS value FROM p GROUP BY 1, 3, 4), {_blur_sql('a', 5)},
f AS (SELECT movie, y, x, greatest(CAST(value / avg(value) OVER (PARTITION BY movie) AS FLOAT), CAST(1e-6 AS FLOAT)) AS field FROM g)
SELECT movie, frame, round(avg(CAST(CAST(value AS FLOAT) / field AS DOUBLE)), 3) AS mean FROM p JOIN f USING (movie, y, x) GROUP BY 1, 2""")
def _flat_field(spark, sf):
    return planes.to_pixels(planes.flat_field(plane_table(spark, sf), 5)).groupBy("movie", "frame").agg(F.round(F.avg("value"), 3).alias("mean"))


def _filled(v: str) -> str:
    """SQL of a series without gaps, over the windows ``back`` and ``ahead``."""
    a, z = f"last_value({v} IGNORE NULLS) OVER back", f"first_value({v} IGNORE NULLS) OVER ahead"
    at = f"CASE WHEN {v} IS NOT NULL THEN frame END IGNORE NULLS"
    return f"coalesce({v}, {a} + ({z} - {a}) * ((frame - last_value({at}) OVER back) / nullif(first_value({at}) OVER ahead - last_value({at}) OVER back, 0)), {a}, {z}, 0) AS {v}"


@_query("target_line", f"""WITH {_B}, k AS (SELECT movie, frame, floor(x1 / 250) AS g, min(x1) AS x, quantile_cont(y1, 0.5) AS y FROM b GROUP BY 1, 2, 3),
r AS (SELECT k.* FROM k JOIN (SELECT movie, min(frame) AS frame FROM k GROUP BY 1) f USING (movie, frame)),
t AS (SELECT movie, quantile_cont(tilt, 0.5) AS tilt FROM (SELECT movie, frame, coalesce(degrees(atan(regr_slope(y, x))), 0) AS tilt FROM k GROUP BY 1, 2 HAVING count(*) >= 2) GROUP BY 1),
c AS (SELECT movie, cy, greatest(0, CAST(round_even(cy - 800, 0) AS INTEGER)) AS top, least(2000, CAST(round_even(cy + 775, 0) AS INTEGER)) AS low FROM (SELECT movie, quantile_cont(y, 0.5) AS cy FROM r GROUP BY 1)),
n AS (SELECT k.movie, k.frame, k.x, k.y, arg_min(r.x, (abs(k.x - r.x), r.x)) AS rx, arg_min(r.y, (abs(k.x - r.x), r.x)) AS ry FROM k JOIN r ON k.movie = r.movie GROUP BY 1, 2, 3, 4),
d AS (SELECT movie, frame, quantile_cont(x - rx, 0.5) AS dx, quantile_cont(y - ry, 0.5) AS dy FROM n WHERE abs(x - rx) <= 300 AND abs(y - ry) <= 300 GROUP BY 1, 2),
p AS (SELECT u.movie, u.frame, dx, dy, dx IS NOT NULL AS found FROM (SELECT DISTINCT movie, frame FROM b) u LEFT JOIN d USING (movie, frame)),
i AS (SELECT movie, frame, found, {_filled('dx')}, {_filled('dy')} FROM p
  WINDOW back AS (PARTITION BY movie ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), ahead AS (PARTITION BY movie ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
m AS (SELECT movie, frame, found, quantile_cont(dx, 0.5) OVER w AS dx, quantile_cont(dy, 0.5) OVER w AS dy FROM i WINDOW w AS (PARTITION BY movie ORDER BY frame ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
o AS (SELECT m.*, cy, coalesce(tilt, 0) AS tilt, low - top AS high, greatest(0, least(2000 - (low - top), top + CAST(round_even(dy, 0) AS INTEGER))) AS y0 FROM m JOIN c USING (movie) LEFT JOIN t USING (movie))
SELECT movie, frame, round(greatest(-1, least(1, tilt)), 6) AS tilt, found, round(cy, 6) AS cy, round(dy, 6) AS dy, round(dx, 6) AS dx, y0, y0 + high AS y1, 0 AS x0, 1100 AS x1 FROM o""")
def _target_line(spark, sf):
    b = boxes(spark, sf)
    blocks = b.groupBy("movie", "frame", F.floor(F.col("x1") / 250).alias("k")).agg(F.min("x1").alias("x"), F.percentile("y1", F.lit(0.5)).alias("y")).drop("k")
    frames = b.select("movie", "frame").distinct()
    return crop.frame_transforms(frames, blocks, 2000, 1100)


@_query("object_clusters")
def _object_clusters(spark, sf):
    m = measurements(spark, sf).select("event_id", "area", "centroid_0", "centroid_1")
    return models.clusters(m, ("area", "centroid_0", "centroid_1"), 4)


def _registered() -> dict:
    from . import operator_queries  # noqa: F401  adds its queries to those above

    return _ALL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in _registered().items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for k, (_, s) in _registered().items() if s}
