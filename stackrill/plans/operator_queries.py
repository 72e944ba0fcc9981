"""Further registered queries: one for each operator that no query of :mod:`queries` reaches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as fs
from ..operators import pixels, planes, relational
from ..sources import files, tiff
from .queries import _B, _L, _M, _P, _SERIES, _query, _r, _read, _series, boxes, labelled, measurements, pixel_table, plane_table


@_query("leading_columns", f"WITH {_M} SELECT label, frame, 0 AS slice, frame % 2 AS channel, movie, round(centroid_0, 6) AS y, round(centroid_1, 6) AS x FROM m WHERE frame % 2 = 1")
def _leading_columns(spark, sf):
    m = measurements(spark, sf).select("movie", "centroid_0", "centroid_1", "frame", "label", F.lit(0).alias("slice"), (F.col("frame") % 2).alias("channel"))
    return relational.lead_columns(m.where("channel = 1")).withColumnsRenamed({"centroid_0": "y", "centroid_1": "x"})


@_query("time_join", f"""WITH {_M}, t AS (SELECT movie, frame, CAST(min(event_id) * 250 AS BIGINT) AS lag FROM m GROUP BY 1, 2),
w AS (SELECT movie, frame, round((lag - max(CASE WHEN frame = 0 THEN lag END) OVER (PARTITION BY movie)) / 3600000, 6) AS timestep, round(lag / 1000, 6) AS abslag_in_s FROM t)
SELECT event_id, m.movie, m.frame, timestep, abslag_in_s FROM m LEFT JOIN (SELECT * FROM w WHERE frame % 4 > 0) w USING (movie, frame)""")
def _time_join(spark, sf):
    m = measurements(spark, sf).select("event_id", "movie", "frame")
    lags = m.groupBy("movie", "frame").agg((F.min("event_id") * 250).alias("lag_ms"))
    times = relational.time_table(lags, F.lit("2024-01-01 00:00:00").cast("timestamp")).drop("date_time")
    return relational.join_per_frame(m, times.where("frame % 4 > 0"))


@_query("label_class_join", f"""WITH {_M}, f AS (SELECT movie, label, area, object_class, event_id FROM m WHERE frame = 5), d AS (SELECT movie, label, object_class, area / 500 AS detection_score FROM f WHERE event_id % 3 > 0)
SELECT f.movie, f.label, round(f.area, 6) AS area, coalesce(d.object_class, 'unknown') AS object_class, round(coalesce(detection_score, 0), 6) AS detection_score FROM f LEFT JOIN d USING (movie, label)""")
def _label_class_join(spark, sf):
    f = measurements(spark, sf).where("frame = 5")
    d = f.where("event_id % 3 > 0").select("movie", "label", "object_class", (F.col("area") / 500).alias("detection_score"))
    return relational.join_classes(f.select("movie", "label", "area"), d, ("movie", "label"))


@_query("object_totals", f"WITH {_M} SELECT movie, count(*) AS objects, CAST(max(label) AS INTEGER) AS top_label, count(DISTINCT frame) AS frames FROM m WHERE label > 0 GROUP BY 1")
def _object_totals(spark, sf):
    return relational.object_totals(measurements(spark, sf))


@_query("label_boxes", f"WITH RECURSIVE {_L} SELECT movie, frame, label, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1, count(*) AS area FROM l GROUP BY 1, 2, 3 HAVING count(*) >= 3")
def _label_boxes(spark, sf):
    return pixels.label_boxes(labelled(spark, sf), 3)


@_query("label_overlaps", f"WITH RECURSIVE {_L}, b AS (SELECT movie, frame, y, x, y // 4 * 2 + x // 4 + 1 AS quarter FROM p) SELECT movie, frame, label, CAST(quarter AS INTEGER) AS other, count(*) AS n FROM l JOIN b USING (movie, frame, y, x) GROUP BY 1, 2, 3, 4")
def _label_overlaps(spark, sf):
    quarters = pixel_table(spark, sf).select("movie", "frame", "y", "x", F.expr("cast(y div 4 * 2 + x div 4 + 1 AS int)").alias("label"))
    return pixels.label_overlaps(labelled(spark, sf), quarters)


@_query("pixel_stats_rounded", f"WITH {_P} SELECT movie, frame, round_even(avg(value), 2) + 0.0 AS mean FROM p GROUP BY 1, 2")
def _pixel_stats_rounded(spark, sf):
    return pixels.plane_means(pixel_table(spark, sf), digits=2).withColumn("mean", F.col("mean") + 0.0)


@_query("coords_centroid", f"WITH RECURSIVE {_L} SELECT movie, frame, label, {_r('y', 'x')} FROM (SELECT movie, frame, label, avg(y) AS y, avg(x) AS x FROM l GROUP BY 1, 2, 3)")
def _coords_centroid(spark, sf):
    objects = labelled(spark, sf).groupBy("movie", "frame", "label").agg(F.collect_list(F.struct("y", "x")).alias("c"))
    return objects.select("movie", "frame", "label", fs.coords_centroid(F.col("c")).alias("c")).select("movie", "frame", "label", "c.y", "c.x")


@_query("bit_depths", "SELECT * FROM (VALUES " + ", ".join(f"('{k}', {v})" for k, v in fs.BIT_DEPTH.items()) + ") t(dtype, bits)")
def _bit_depths(spark, sf):
    return spark.createDataFrame([(k, fs.bit_depth(k)) for k in fs.BIT_DEPTH], "dtype string, bits int")


@_query("convert_scale_channel_frame", f"WITH {_P}, c AS (SELECT *, x % 2 AS channel FROM p), e AS (SELECT *, min(value) OVER w AS lo, max(value) OVER w AS hi FROM c WINDOW w AS (PARTITION BY movie, channel, frame)) SELECT movie, channel, frame, y, x, round(coalesce((value - lo) / nullif(hi - lo, 0), 0), 6) AS scaled FROM e")
def _convert_scale_channel_frame(spark, sf):
    return pixels.convert_scale(pixel_table(spark, sf).withColumn("channel", F.col("x") % 2), "float32", "channel_frame").drop("value")


_U8 = "u AS (SELECT movie, frame, y, x, CAST(floor((value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w) * 255) AS INTEGER) AS scaled FROM p WINDOW w AS (PARTITION BY movie, frame))"


@_query("to_uint8", f"WITH {_P}, {_U8} SELECT * FROM u")
def _to_uint8(spark, sf):
    return pixels.to_uint8(pixel_table(spark, sf)).drop("value")


@_query("equalise", f"""WITH {_P}, {_U8}, h AS (SELECT movie, frame, scaled, count(*) AS n FROM u GROUP BY 1, 2, 3),
c AS (SELECT *, sum(n) OVER (PARTITION BY movie, frame ORDER BY scaled) AS cdf, sum(n) OVER (PARTITION BY movie, frame) AS total, first_value(n) OVER (PARTITION BY movie, frame ORDER BY scaled) AS first FROM h),
e AS (SELECT u.movie, u.frame, y, x, scaled, coalesce(round_even((cdf - first) * 255.0 / nullif(total - first, 0), 0), 0)::DOUBLE AS value FROM u JOIN c USING (movie, frame, scaled))
SELECT movie, frame, y, x, scaled, round(value, 6) AS value, round(coalesce((value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0), 0), 6) AS z FROM e WINDOW w AS (PARTITION BY movie, frame)""")
def _equalise(spark, sf):
    return pixels.equalise(pixels.to_uint8(pixel_table(spark, sf)))


@_query("deepest_dip", f"""WITH {_SERIES}, d AS (SELECT movie, frame, v, lag(v) OVER w AS b, lead(v) OVER w AS a, max(v) OVER (PARTITION BY movie ORDER BY frame ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS l, max(v) OVER (PARTITION BY movie ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS r FROM s WINDOW w AS (PARTITION BY movie ORDER BY frame)),
f AS (SELECT movie, frame, least(l, r) - v AS depth FROM d WHERE v <= b AND v < a AND least(l, r) - v >= 0) SELECT movie, arg_max(frame, depth) AS deepest, min(frame) AS first, round(max(depth), 6) AS depth FROM f GROUP BY 1""")
def _deepest_dip(spark, sf):
    dips = pixels.local_dips(_series(spark, sf), "v", 10, 0.0, ("movie",), "frame")
    return dips.groupBy("movie").agg(F.max_by("frame", "depth").alias("deepest"), F.min("frame").alias("first"), F.max("depth").alias("depth"))


@_query("extrapolated_positions", f"""WITH {_B}, k AS (SELECT movie, floor(x1 / 250) AS g, min(x1) AS x, quantile_cont(y1, 0.5) AS y FROM b WHERE frame = 3 AND floor(x1 / 250) <> 1 GROUP BY 1, 2),
d AS (SELECT *, x - lag(x) OVER (PARTITION BY movie ORDER BY x) AS gap FROM k), s AS (SELECT movie, quantile_cont(gap, 0.5) AS step, quantile_cont(y, 0.5) AS y, min(x) AS x0 FROM d GROUP BY 1 HAVING quantile_cont(gap, 0.5) >= 50),
n AS (SELECT movie, step, y, x0 + unnest(generate_series(CAST(ceil((-500 - x0) / step) AS BIGINT), CAST(floor((2000 - x0) / step) AS BIGINT))) * step AS x FROM s)
SELECT movie, round(x, 6) AS x, round(y, 6) AS y, true AS found FROM k UNION ALL SELECT movie, round(x, 6), round(y, 6), false FROM n WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.movie = n.movie AND abs(n.x - k.x) < n.step / 2)""")
def _extrapolated_positions(spark, sf):
    b = boxes(spark, sf).where("frame = 3 AND floor(x1 / 250) != 1")
    blocks = b.groupBy("movie", F.floor(F.col("x1") / 250).alias("g")).agg(F.min("x1").alias("x"), F.percentile("y1", F.lit(0.5)).alias("y")).drop("g")
    return pixels.extrapolated_positions(blocks, -500.0, 2000.0, 50.0, ("movie",))


@_query("worklist_semijoin", "SELECT o_orderkey, stem FROM (SELECT o_orderkey, 'img' || o_orderkey || '.nd2' AS name, 'img' || o_orderkey AS stem FROM orders) WHERE stem LIKE 'img1%' AND name IN (SELECT 'img' || l_orderkey || '.nd2' FROM lineitem WHERE l_linenumber = 2)")
def _worklist_semijoin(spark, sf):
    listed = _read(spark, sf, "orders").selectExpr("o_orderkey", "concat('/data/img', o_orderkey, '.nd2') AS path")
    wanted = _read(spark, sf, "lineitem").where("l_linenumber = 2").selectExpr("concat('old/img', l_orderkey, '.nd2') AS name")
    return files.select_files(listed, "img1", wanted).select("o_orderkey", "stem")


@_query("csv_tables", "SELECT file, count(*) AS n, round(sum(p_retailprice), 6) AS total, coalesce(CAST(sum(CASE WHEN file = 'b_fl.csv' THEN p_size END) AS BIGINT), 0) AS size FROM (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'a_fl.csv' ELSE 'b_fl.csv' END AS file, * FROM part) GROUP BY 1")
def _csv_tables(spark, sf):
    """Two CSV files whose headers differ, written, and read together with the file of each row."""
    part = _read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    folder = files.work_folder(spark, "csv")
    files.write_csv(part.where("p_partkey % 2 = 0").drop("p_size"), f"{folder}/a_fl.csv")
    files.write_csv(part.where("p_partkey % 2 = 1"), f"{folder}/b_fl.csv")
    rows = files.read_csvs(spark, folder, "file", "_fl")
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.sum("p_retailprice").alias("total"), F.coalesce(F.sum("p_size"), F.lit(0)).cast("long").alias("size"))


@_query("table_sinks", f"WITH {_M} SELECT movie, (SELECT count(*) FROM m x WHERE x.movie = m.movie) AS n, round(sum(area), 6) AS area, CAST(sum(CASE WHEN pi_class = 'piPOS' THEN 1 ELSE 0 END) AS BIGINT) AS pos FROM m GROUP BY 1")
def _table_sinks(spark, sf):
    """Measurements and summary written, one partition for each file, and read back."""
    m = measurements(spark, sf).withColumn("file", F.col("movie"))
    folder = files.work_folder(spark, "tables")
    files.write_tables(m, relational.pi_summary(m, ("file", "object_class")), folder)
    measured, summary = (spark.read.parquet(f"{folder}/{t}") for t in ("fl", "summary"))
    counts = summary.groupBy("file").agg(F.sum("total_count").alias("n"), F.sum("pi_class_pos").cast("long").alias("pos"))
    return measured.groupBy("file").agg(F.sum("area").alias("area")).join(counts, "file").withColumnRenamed("file", "movie")


@_query("file_listing", "SELECT 'img' || n_nationkey || ['.nd2', '.tiff', '.csv', '.ome.tiff'][CAST(n_nationkey % 4 AS INTEGER) + 1] AS name, 'img' || n_nationkey AS stem FROM nation WHERE n_nationkey % 4 <> 2 AND 'img' || n_nationkey LIKE 'img1%'")
def _file_listing(spark, sf):
    folder = files.work_folder(spark, "listing")
    hadoop = spark._jvm.org.apache.hadoop.fs
    for r in _read(spark, sf, "nation").collect():  # 25 rows at every scale
        path = hadoop.Path(f"{folder}/img{r.n_nationkey}{('.nd2', '.tiff', '.csv', '.ome.tiff')[r.n_nationkey % 4]}")
        out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
        out.write(0)
        out.close()
    return files.find_files(spark, folder, "img1").select("name", "stem")


@_query("tiff_round_trip", f"WITH {_P} SELECT movie || '_labels' AS movie, frame, y, x, round(value, 6) AS value FROM p WHERE movie = 'm1'")
def _tiff_round_trip(spark, sf):
    """A movie's planes as one TIFF file, and read from it."""
    folder = files.work_folder(spark, "tiff").removeprefix("file:")
    tiff.save_tiffs(plane_table(spark, sf).where("movie = 'm1'"), folder, "_labels.tiff").collect()
    stack = tiff.read_planes(spark, f"file:{folder}").where("error IS NULL").drop("pixel_size", "error")
    return planes.to_pixels(stack).drop("slice", "channel")


@_query("plane_scale", f"""WITH {_P}, c AS (SELECT movie, frame, x, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.998) AS hi FROM p GROUP BY 1, 2, 3),
e AS (SELECT movie, frame, quantile_cont(lo, 0.01) AS lo, quantile_cont(hi, 0.998) AS hi FROM c GROUP BY 1, 2) SELECT movie, frame, y, x, round(CAST(CAST((value - lo) / (hi - lo) AS FLOAT) AS DOUBLE), 5) AS value FROM p JOIN e USING (movie, frame)""")
def _plane_scale(spark, sf):
    return planes.to_pixels(planes.scale(plane_table(spark, sf))).drop("slice", "channel").withColumn("value", F.round("value", 5))


@_query("plane_zscore", f"WITH {_P} SELECT movie, frame, y, x, round(CAST(CAST((value - avg(value) OVER w) / (stddev_samp(value) OVER w + 1e-6) AS FLOAT) AS DOUBLE), 5) AS value FROM p WINDOW w AS (PARTITION BY movie, frame)")
def _plane_zscore(spark, sf):
    return planes.to_pixels(planes.scale(plane_table(spark, sf), "zscore")).drop("slice", "channel").withColumn("value", F.round("value", 5))
