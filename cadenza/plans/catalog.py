"""Registered queries: each operator once, as SQL that Catalyst plans and that also runs on DuckDB.

{table} stands for a driver table. clip = event_type, frame = order in time, metric = value;
pixels = the embedding scaled to 0..255; boxes in a frame = rows of lineitem by order.
"""
import re
from functools import partial

from pyspark.sql import functions as F

from cadenza.functions import scalars
from cadenza.operators import frames, geometry, kernels, tracking, vision
from cadenza.plans import partials, rules, scoring, selection, sizing
from cadenza.session import stored, table
from cadenza.sources import logs
from cadenza.streaming import ordered, sequence

EV = """ev AS (SELECT event_type AS clip_id, CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS BIGINT) AS frame_idx,
 event_id, user_id, ts, value AS x FROM {events})"""
LAG = f"""{EV}, l AS (SELECT *, lag(x, 1) OVER w AS x1, lag(x, 2) OVER w AS x2, lag(x, 3) OVER w AS x3, lead(x, 1) OVER w AS xn
 FROM ev WINDOW w AS (PARTITION BY clip_id ORDER BY frame_idx))"""
ACC = f"""{LAG}, v AS (SELECT *, abs(x - x1) AS m, abs(x1 - x2) AS m1, abs((x - x1) - (x1 - x2)) AS acc FROM l),
f AS (SELECT *, CASE WHEN acc > 2.5 * greatest(1.0, (m + m1) / 2) AND acc > 3 THEN 1 ELSE 0 END AS disc FROM v)"""
BOX = """b0 AS (SELECT l_orderkey AS frame_idx, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_tax, l_discount, l_returnflag, l_linestatus) AS BIGINT) AS i,
 l_quantity * 10 AS bx, l_discount * 1000 AS y, l_tax * 100 + 25 AS bw, l_tax * 200 + 30 AS bh, l_extendedprice / 100000 AS circ FROM {lineitem})"""
CLIP = f"""{ACC}, a AS (SELECT clip_id, coalesce(avg(abs(x1 - (x2 + x) / 2)), 0.0) AS resid, coalesce(avg(m / (x + x1 + 1)), 0.0) AS var_flicker, coalesce(avg(acc), 0.0) AS mean_acc,
 coalesce(avg(m), 0.0) AS warp, coalesce(percentile(m, 0.95), 0.0) AS p95, sum(disc) / greatest(1, count(acc)) AS rate, CAST(count(*) AS BIGINT) AS n FROM f GROUP BY clip_id),
d AS (SELECT *, greatest(0.0, 1 - least(0.6, rate / 0.02 * 0.6) - least(0.4, mean_acc / 10)) AS smooth, 0.15 * resid + 3.5 * var_flicker AS flicker FROM a)"""
CHUNK = "c AS (SELECT CAST(max(vec_id) + 1 AS BIGINT) AS n FROM {embeddings}), k AS (SELECT n, k FROM c CROSS JOIN (SELECT CAST(vec_id AS BIGINT) AS k FROM {embeddings}) s WHERE k * 50 <= n - 2), chunks AS (SELECT k AS chunk_id, k * 50 AS start_frame, least(k * 50 + 50, n - 1) AS end_frame FROM k)"
#: How Spark numbers and windows a clip: by stretches of time, then of frames, so that one long clip is many tasks.
#: Each time stretch starts at the count of the rows before it; a stretch of frames repeats what its edges look back and ahead to.
EV_SPLIT = """e0 AS (SELECT event_type AS clip_id, ts, event_id, user_id, value AS x, coalesce(CAST(floor(unix_micros(CAST(ts AS TIMESTAMP)) / 3600000000) AS BIGINT), -1) AS tb FROM {events}),
e1 AS (SELECT clip_id, tb, count(*) AS n FROM e0 GROUP BY clip_id, tb),
e2 AS (SELECT clip_id, tb, sum(n) OVER (PARTITION BY clip_id ORDER BY tb ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS before FROM e1),
ev AS (SELECT e0.clip_id, CAST(row_number() OVER (PARTITION BY e0.clip_id, e0.tb ORDER BY ts, event_id) - 1 + before AS BIGINT) AS frame_idx, event_id, user_id, ts, x
 FROM e0 JOIN e2 ON e0.clip_id <=> e2.clip_id AND e0.tb = e2.tb)"""
LAG_SPLIT = f"""{EV_SPLIT}, lh AS (SELECT *, frame_idx div 4096 AS own FROM ev),
lu AS (SELECT *, explode(CASE WHEN frame_idx % 4096 >= 4093 THEN array(own, own + 1) WHEN frame_idx % 4096 = 0 AND own > 0 THEN array(own, own - 1) ELSE array(own) END) AS part FROM lh),
lw AS (SELECT *, lag(x, 1) OVER w AS x1, lag(x, 2) OVER w AS x2, lag(x, 3) OVER w AS x3, lead(x, 1) OVER w AS xn FROM lu WINDOW w AS (PARTITION BY clip_id, part ORDER BY frame_idx)),
l AS (SELECT clip_id, frame_idx, event_id, user_id, ts, x, x1, x2, x3, xn FROM lw WHERE own = part)"""
CHUNK_SPLIT = "c AS (SELECT CAST(max(vec_id) + 1 AS BIGINT) AS n FROM {embeddings}), k AS (SELECT n, explode(sequence(0L, greatest(0L, n - 2) div 50)) AS k FROM c WHERE n > 0), chunks AS (SELECT k AS chunk_id, k * 50 AS start_frame, least(k * 50 + 50, n - 1) AS end_frame FROM k)"

SQL = {
    "lag1_diff": f"WITH {LAG} SELECT clip_id, frame_idx, round(abs(x - x1), 6) AS d FROM l WHERE x1 IS NOT NULL",
    "lag2_diff": f"WITH {LAG} SELECT clip_id, frame_idx, round(abs(x - x2), 6) AS d FROM l WHERE x2 IS NOT NULL",
    "second_order_residual": f"WITH {LAG} SELECT clip_id, frame_idx, round(abs(x1 - (x2 + x) / 2), 6) AS resid FROM l WHERE x2 IS NOT NULL",
    "triplet_odd": f"WITH {LAG} SELECT clip_id, frame_idx, x1 AS a, x AS mid, xn AS b FROM l WHERE frame_idx % 2 = 1 AND x1 IS NOT NULL AND xn IS NOT NULL",
    "acceleration_discontinuity": f"WITH {ACC} SELECT clip_id, frame_idx, round(acc, 6) AS acc, CAST(disc AS BIGINT) AS disc FROM f WHERE acc IS NOT NULL",
    "oscillation_index": f"WITH {LAG} SELECT clip_id, round(coalesce(avg(abs(x - x1) / (abs(x - x2) + 1)), 0.0), 6) AS osc FROM l WHERE x2 IS NOT NULL GROUP BY clip_id",
    "camera_jitter": f"WITH {LAG}, s AS (SELECT clip_id, frame_idx, x - x1 AS sh, (x - x1) - (x1 - x2) AS dsh FROM l WHERE x1 IS NOT NULL), m AS (SELECT clip_id, avg(abs(sh)) AS pan FROM s GROUP BY clip_id) SELECT s.clip_id, CAST(count(*) AS BIGINT) AS n_shifts, CAST(sum(CASE WHEN abs(dsh) > greatest(2.5, 1.5 * pan) THEN 1 ELSE 0 END) AS BIGINT) AS n_jitter FROM s JOIN m ON s.clip_id = m.clip_id GROUP BY s.clip_id",
    "pts_gaps": f"WITH {EV}, p AS (SELECT clip_id, frame_idx, ts, lead(ts) OVER (PARTITION BY clip_id ORDER BY ts, event_id) AS nx FROM ev), g AS (SELECT clip_id, micros(nx) - micros(ts) AS gap FROM p WHERE nx IS NOT NULL) SELECT clip_id, CAST(count_if(gap = 0) AS BIGINT) AS n_dup, CAST(count_if(gap > 80000) AS BIGINT) AS n_gap, CAST(max(gap) AS BIGINT) AS max_gap FROM g GROUP BY clip_id",
    "zscore_anomalies": f"WITH {EV}, s AS (SELECT clip_id, avg(x) AS mu, stddev_pop(x) AS sd FROM ev GROUP BY clip_id), z AS (SELECT ev.clip_id, frame_idx, round((x - mu) / CASE WHEN sd < 1e-4 THEN 1.0 ELSE sd END, 2) AS z FROM ev JOIN s ON ev.clip_id = s.clip_id) SELECT clip_id, frame_idx, z, CAST(CASE WHEN z >= 4 THEN 4 ELSE 3 END AS BIGINT) AS severity FROM z WHERE z >= 2.5 ORDER BY z DESC, clip_id, frame_idx LIMIT 25",
    "duplicate_runs": f"WITH {LAG}, d AS (SELECT clip_id, frame_idx, CASE WHEN abs(x - x1) < 0.8 THEN 1 ELSE 0 END AS dup FROM l), g AS (SELECT *, sum(1 - dup) OVER (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM d) SELECT clip_id, frame_idx, CAST(sum(dup) OVER (PARTITION BY clip_id, grp ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS run FROM g",
    "count_jump": "WITH n AS (SELECT l_orderkey AS frame_idx, count(*) AS n FROM {lineitem} GROUP BY l_orderkey), b AS (SELECT CAST(floor(frame_idx / 1000) AS BIGINT) AS clip_id, frame_idx, n, lag(n) OVER (PARTITION BY CAST(floor(frame_idx / 1000) AS BIGINT) ORDER BY frame_idx) AS p FROM n) SELECT clip_id, CAST(count(*) AS BIGINT) AS jumps FROM b WHERE abs(n - p) >= 3 GROUP BY clip_id",
    "temporal_qc": f"WITH {CLIP} SELECT clip_id, n, round(smooth, 5) AS smoothness, round(flicker, 5) AS flicker, round(p95, 5) AS p95, CASE WHEN smooth >= 0.85 AND warp < 15 THEN 'EXCELLENT' WHEN smooth < 0.65 OR warp > 28 THEN 'POOR' WHEN smooth < 0.75 THEN 'FAIR' ELSE 'GOOD' END AS status FROM d",
    "flicker_score": f"WITH {CLIP} SELECT clip_id, round(flicker, 5) AS flicker, round(greatest(1.0, 1 + 4 * smooth - least(2.0, 0.5 * flicker)), 5) AS stability FROM d",
    "ground_truth_odd": "SELECT o_orderkey AS frame_idx, round(avg(abs(l_extendedprice - o_totalprice)), 7) AS mae, round(max(abs(l_extendedprice - o_totalprice)), 4) AS max_diff FROM {orders} o JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey WHERE o_orderkey % 2 = 1 GROUP BY o_orderkey",
    "even_source_join": "SELECT s.o_orderkey AS k, o.o_orderkey AS out_idx, round(abs(s.o_totalprice - o.o_totalprice), 4) AS d FROM {orders} s JOIN {orders} o ON s.o_orderkey = CAST(floor(o.o_orderkey / 2) AS BIGINT) WHERE o.o_orderkey % 2 = 0",
    "cut_hybrid": f"WITH {LAG}, d AS (SELECT clip_id, frame_idx, abs(x - x1) / 100 AS da, abs(x - xn) / 100 AS db, abs(x - (x1 + xn) / 2) / 100 AS dm, abs(x1 - xn) / 100 AS cut FROM l WHERE frame_idx % 2 = 1 AND xn IS NOT NULL) SELECT clip_id, CAST(count_if(cut >= 0.35) AS BIGINT) AS cuts, CAST(count_if(cut >= 0.35 AND ((da > 0.2 AND db > 0.2) OR dm < 0.12)) AS BIGINT) AS hybrids FROM d GROUP BY clip_id",
    "cut_intermediate": f"WITH {EV}, c AS (SELECT a.clip_id, CAST(floor(a.frame_idx / 2) AS BIGINT) AS k, a.x AS xa, b.x AS xb FROM ev a JOIN ev b ON a.clip_id = b.clip_id AND b.frame_idx = a.frame_idx + 2 WHERE a.frame_idx % 2 = 0 AND abs(a.x - b.x) / 100 >= 0.35) SELECT c.clip_id, c.k, m.frame_idx, CASE WHEN (abs(m.x - xa) / 100 > 0.2 AND abs(m.x - xb) / 100 > 0.2) OR abs(m.x - (xa + xb) / 2) / 100 < 0.12 THEN 1 ELSE 0 END AS hybrid FROM c JOIN ev m ON m.clip_id = c.clip_id AND m.frame_idx = 2 * c.k + 1",
    "pair_route": f"WITH {LAG} SELECT clip_id, frame_idx, CASE WHEN abs(x - x1) / 100 >= 0.35 THEN 'repeat_cut' WHEN abs(x - x1) / 100 >= 0.12 THEN 'blend' WHEN abs(x - x1) < 0.8 THEN 'repeat_dup' ELSE 'model' END AS route FROM l WHERE x1 IS NOT NULL",
    "box_overlap_pairs": f"WITH {BOX} SELECT a.frame_idx, CAST(count(*) AS BIGINT) AS pairs FROM b0 a JOIN b0 b ON a.frame_idx = b.frame_idx AND a.i < b.i AND least(a.bx + a.bw, b.bx + b.bw) - greatest(a.bx, b.bx) > 8 AND least(a.y + a.bh, b.y + b.bh) - greatest(a.y, b.y) > 15 GROUP BY a.frame_idx",
    "best_pair_argmax": f"WITH {BOX}, c AS (SELECT a.frame_idx, a.i AS ia, b.i AS ib, a.circ * b.circ AS s, row_number() OVER (PARTITION BY a.frame_idx ORDER BY a.circ * b.circ DESC, a.i, b.i) AS rn FROM b0 a JOIN b0 b ON a.frame_idx = b.frame_idx AND a.i % 2 = 1 AND b.i % 2 = 0 AND sqrt((a.bx - b.bx) * (a.bx - b.bx) + (a.y - b.y) * (a.y - b.y)) BETWEEN 25 AND 160) SELECT frame_idx, ia, ib, round(s, 6) AS score FROM c WHERE rn = 1",
    "static_anti_join": f"WITH {BOX} SELECT a.frame_idx, a.i FROM b0 a WHERE a.i % 2 = 1 AND NOT EXISTS (SELECT 1 FROM b0 b WHERE b.frame_idx = a.frame_idx AND b.i % 2 = 0 AND sqrt((a.bx - b.bx) * (a.bx - b.bx) + (a.y - b.y) * (a.y - b.y)) < 20)",
    "nearest_midpoint": f"WITH {BOX}, m AS (SELECT frame_idx, avg(bx) AS mx, avg(y) AS my FROM b0 GROUP BY frame_idx), c AS (SELECT b0.frame_idx, i, sqrt((bx - mx) * (bx - mx) + (y - my) * (y - my)) AS dist FROM b0 JOIN m ON b0.frame_idx = m.frame_idx), r AS (SELECT *, row_number() OVER (PARTITION BY frame_idx ORDER BY round(dist, 6), i) AS rn FROM c WHERE dist <= 60) SELECT frame_idx, i, round(dist, 4) AS dist FROM r WHERE rn = 1",
    "occluder_semi": f"WITH {BOX} SELECT a.frame_idx, a.i FROM b0 a WHERE a.i = 1 AND EXISTS (SELECT 1 FROM b0 b WHERE b.frame_idx = a.frame_idx AND b.i > 1 AND a.bx BETWEEN b.bx - 10 AND b.bx + b.bw + 10 AND a.y BETWEEN b.y - 10 AND b.y + b.bh + 10)",
    "ghost_semi": f"WITH {BOX}, e AS (SELECT a.frame_idx, a.bx AS ax, a.y AS ay, b.bx - a.bx AS dx, b.y - a.y AS dy FROM b0 a JOIN b0 b ON a.frame_idx = b.frame_idx AND a.i = 1 AND b.i = 2) SELECT frame_idx FROM e WHERE EXISTS (SELECT 1 FROM b0 c WHERE c.frame_idx = e.frame_idx AND c.i > 2 AND abs((c.bx - ax) * dy - (c.y - ay) * dx) <= 6 * sqrt(dx * dx + dy * dy + 1) AND (c.bx - ax) * dx + (c.y - ay) * dy BETWEEN 0 AND dx * dx + dy * dy)",
    "chunk_partition": f"WITH {CHUNK} SELECT chunk_id, start_frame, end_frame FROM chunks",
    "pending_chunks": f"WITH {CHUNK} SELECT chunk_id, start_frame, end_frame FROM chunks c WHERE NOT EXISTS (SELECT 1 FROM chunks d WHERE d.chunk_id = c.chunk_id AND d.chunk_id % 2 = 0)",
    "overlap_merge_dedup": f"WITH {CHUNK}, e AS (SELECT vec_id AS frame_idx, chunk_id, start_frame FROM {{embeddings}} JOIN chunks ON chunk_id BETWEEN CAST(floor(vec_id / 50) AS BIGINT) - 1 AND CAST(floor(vec_id / 50) AS BIGINT) AND vec_id BETWEEN start_frame AND end_frame) SELECT frame_idx, chunk_id FROM e WHERE NOT (chunk_id > 0 AND frame_idx = start_frame)",
    "interleave": f"WITH {LAG} SELECT clip_id, 2 * frame_idx AS out_idx, x AS v FROM l UNION ALL SELECT clip_id, 2 * frame_idx - 1, (x + x1) / 2 FROM l WHERE x1 IS NOT NULL",
    "motion_regimes": f"WITH {LAG}, m AS (SELECT abs(x - x1) AS m FROM l WHERE x1 IS NOT NULL), g AS (SELECT CASE WHEN m < 3 THEN 0 WHEN m < 10 THEN 1 WHEN m < 25 THEN 2 ELSE 3 END AS r, avg(m) AS a FROM m GROUP BY 1), o AS (SELECT avg(m) AS a FROM m), k AS (SELECT 0 AS r, 'static' AS name UNION ALL SELECT 1, 'slow' UNION ALL SELECT 2, 'fast' UNION ALL SELECT 3, 'extreme') SELECT name, round(coalesce(g.a, o.a), 5) AS level FROM k LEFT JOIN g ON k.r = g.r CROSS JOIN o",
    "artifact_added": f"WITH {EV} SELECT clip_id, round(greatest(0.0, avg(CASE WHEN frame_idx % 2 = 1 THEN x END) - avg(CASE WHEN frame_idx % 2 = 0 THEN x END)), 5) AS added FROM ev GROUP BY clip_id",
    "even_odd_mean": f"WITH {EV} SELECT clip_id, round(avg(CASE WHEN frame_idx % 2 = 0 THEN x END), 5) AS even_mean, round(avg(CASE WHEN frame_idx % 2 = 1 THEN x END), 5) AS odd_mean FROM ev GROUP BY clip_id",
    "roi_carry_forward": f"WITH {EV} SELECT clip_id, frame_idx, last_ignore(CASE WHEN frame_idx % 25 = 0 THEN x END) OVER (PARTITION BY clip_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS roi FROM ev",
    "roi_union": f"WITH {BOX} SELECT frame_idx, round(greatest(0.0, min(bx) - 40), 4) AS x0, round(greatest(0.0, min(y) - 20), 4) AS y0, round(max(bx + bw) + 40, 4) AS x1, round(max(y + bh) + 20, 4) AS y1 FROM b0 GROUP BY frame_idx",
    "p95_std": f"WITH {EV} SELECT clip_id, round(percentile(x, 0.95), 5) AS p95, round(stddev_pop(x), 5) AS sd, round(var_pop(x), 4) AS var, round(max(x), 5) AS mx FROM ev GROUP BY clip_id",
    "histogram_intersection": "WITH h AS (SELECT event_type AS e, CAST(floor(least(31.0, value / 8)) AS BIGINT) AS bin, count(*) AS n FROM {events} GROUP BY 1, 2), t AS (SELECT e, sum(n) AS n FROM h GROUP BY e), s AS (SELECT h.e, bin, h.n / t.n AS p FROM h JOIN t ON h.e = t.e) SELECT a.e AS a, b.e AS b, round(sum(least(a.p, b.p)), 6) AS inter FROM s a JOIN s b ON a.bin = b.bin AND a.e < b.e GROUP BY a.e, b.e",
    "envelope_clamp": f"WITH {LAG} SELECT clip_id, frame_idx, round(CASE WHEN x > greatest(x1, xn) + 10 THEN greatest(x1, xn) + 10 WHEN x < least(x1, xn) - 10 THEN least(x1, xn) - 10 ELSE x END, 6) AS v, CASE WHEN x > greatest(x1, xn) + 20 OR x < least(x1, xn) - 20 THEN 1 ELSE 0 END AS firefly FROM l WHERE frame_idx % 2 = 1 AND x1 IS NOT NULL AND xn IS NOT NULL",
    "technical_status": f"WITH {EV}, a AS (SELECT clip_id, count(*) AS n, max(x) AS mx, avg(x) AS mae FROM ev GROUP BY clip_id) SELECT clip_id, CASE WHEN mae > 200 OR mx > 1e6 THEN 'FAIL' WHEN abs(n - 2000) > 5 THEN 'WARN' ELSE 'PASS' END AS status, abs(n - 2000) <= 5 AS frame_ok FROM a",
    "perf_score": "SELECT o_orderkey, CASE WHEN r <= 1 THEN CAST(10 AS DOUBLE) WHEN r <= 1.3 THEN 10 - (r - 1) / 0.3 * 1.5 WHEN r <= 1.6 THEN 8.5 - (r - 1.3) / 0.3 * 2.5 ELSE greatest(1.0, 6 - 2 * (r - 1.6)) END AS score, CASE WHEN r <= 1.3 THEN 'PASS' WHEN r <= 1.6 THEN 'WARN' ELSE 'FAIL' END AS status FROM (SELECT o_orderkey, o_totalprice / 100000 AS r FROM {orders}) t",
    "realtime_factor": "SELECT o_orderkey, round(greatest(o_totalprice, 0.001) / greatest(1000.0, 0.001), 5) AS rtf, round(1000 / greatest(o_totalprice, 0.001), 5) AS fps, round(499 / greatest(o_totalprice, 0.001), 5) AS generated_fps FROM {orders}",
    "timestamp_format": "SELECT event_id, lpad(CAST(CAST(floor(value / 3600) AS BIGINT) AS VARCHAR(20)), 2, '0') || ':' || lpad(CAST(CAST(floor(value / 60) AS BIGINT) % 60 AS VARCHAR(20)), 2, '0') || ':' || lpad(CAST(CAST(floor(value) AS BIGINT) % 60 AS VARCHAR(20)), 2, '0') AS stamp FROM {events}",
    "bitrate_target": "SELECT o_orderkey, round(least(12e6 * greatest(0.4, r), greatest(3.5e6 * greatest(0.4, r), 1.45 * s)), 2) AS rate FROM (SELECT o_orderkey, o_totalprice * 20 AS s, o_totalprice / 200000 AS r FROM {orders}) t",
    "reconcile_frames": "SELECT o_orderkey, CAST(CASE WHEN abs(o_totalprice - o_orderkey * 25) > greatest(3, 5) THEN o_orderkey * 25 ELSE floor(o_totalprice) END AS BIGINT) AS n_frames FROM {orders}",
    "severity_bucket": "SELECT CAST(CASE WHEN l_tax < 0.01 THEN 1 WHEN l_tax < 0.03 THEN 2 WHEN l_tax < 0.07 THEN 3 WHEN l_tax < 0.15 THEN 4 ELSE 5 END AS BIGINT) AS severity, CAST(count(*) AS BIGINT) AS n FROM {lineitem} GROUP BY 1",
    "metrics_long": f"WITH {CLIP} SELECT clip_id, 'smoothness' AS metric, round(smooth, 5) AS value FROM d UNION ALL SELECT clip_id, 'flicker', round(flicker, 5) FROM d UNION ALL SELECT clip_id, 'p95', round(p95, 5) FROM d",
    "output_pts": f"WITH {EV} SELECT clip_id, frame_idx, frame_idx / 50 AS sec, frame_idx % 2 = 1 AS generated FROM ev",
    "chunk_sum": "SELECT user_id AS clip_id, CAST(count(*) AS BIGINT) AS frames, round(sum(value), 4) AS total FROM {events} GROUP BY user_id",
}
#: The halo form: overlapping buckets of frames, so one long clip uses many tasks.
SQL["halo_window"] = f"WITH {EV}, h AS (SELECT *, CAST(floor(frame_idx / 100) AS BIGINT) AS b FROM ev), u AS (SELECT *, b AS g FROM h UNION ALL SELECT *, b + 1 FROM h WHERE frame_idx % 100 >= 98 UNION ALL SELECT *, b - 1 FROM h WHERE frame_idx % 100 = 0 AND b > 0), w AS (SELECT *, lag(x, 1) OVER q AS x1, lag(x, 2) OVER q AS x2, lead(x, 1) OVER q AS xn FROM u WINDOW q AS (PARTITION BY clip_id, g ORDER BY frame_idx)) SELECT clip_id, frame_idx, x1, x2, xn FROM w WHERE b = g"
SQL |= rules.SQL
#: Where Spark needs another form than the plain one above, which stays the comparison.
SPLIT = {
    # the next time stamp: a stretch also holds the first frame of the one behind it
    "pts_gaps": f"""WITH {EV_SPLIT}, h AS (SELECT clip_id, frame_idx, ts, explode(CASE WHEN frame_idx % 4096 = 0 AND frame_idx > 0 THEN array(frame_idx div 4096, frame_idx div 4096 - 1) ELSE array(frame_idx div 4096) END) AS part FROM ev),
p AS (SELECT clip_id, ts, lead(ts) OVER (PARTITION BY clip_id, part ORDER BY frame_idx) AS nx FROM h), g AS (SELECT clip_id, micros(nx) - micros(ts) AS gap FROM p WHERE nx IS NOT NULL)
SELECT clip_id, count_if(gap = 0) AS n_dup, count_if(gap > 80000) AS n_gap, max(gap) AS max_gap FROM g GROUP BY clip_id""",
    # a run is as long as the way back to the last frame that is no duplicate, here or in a stretch before
    "duplicate_runs": f"""WITH {LAG_SPLIT}, d AS (SELECT clip_id, frame_idx, frame_idx div 4096 AS part, CASE WHEN coalesce(abs(x - x1) < 0.8, false) THEN NULL ELSE frame_idx END AS fresh FROM l),
s AS (SELECT clip_id, part, max(fresh) AS fresh FROM d GROUP BY clip_id, part),
b AS (SELECT clip_id, part, max(fresh) OVER (PARTITION BY clip_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT d.clip_id, frame_idx, frame_idx - coalesce(max(fresh) OVER (PARTITION BY d.clip_id, d.part ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), before) AS run
 FROM d JOIN b ON d.clip_id <=> b.clip_id AND d.part = b.part""",
    "roi_carry_forward": f"""WITH {EV_SPLIT}, r AS (SELECT clip_id, frame_idx, frame_idx div 4096 AS part, CASE WHEN frame_idx % 25 = 0 THEN x END AS v FROM ev),
s AS (SELECT clip_id, part, max_by(v, frame_idx) FILTER (WHERE v IS NOT NULL) AS v FROM r GROUP BY clip_id, part),
b AS (SELECT clip_id, part, last(v, true) OVER (PARTITION BY clip_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
SELECT r.clip_id, frame_idx, coalesce(last(r.v, true) OVER (PARTITION BY r.clip_id, r.part ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), before) AS roi
 FROM r JOIN b ON r.clip_id <=> b.clip_id AND r.part = b.part""",
    # as EXISTS, Spark pairs every line with the distinct ends of all frames; the first two lines of a frame stand before its others.
    # Lines equal up to the discount are equal in bx and y, so the flags need not order them
    "ghost_semi": """WITH f AS (SELECT l_orderkey AS frame_idx, l_quantity, l_discount, row_number() OVER w AS i, first(l_quantity) OVER w AS q1, first(l_discount) OVER w AS d1, nth_value(l_quantity, 2) OVER w AS q2, nth_value(l_discount, 2) OVER w AS d2
 FROM {lineitem} WHERE l_orderkey IS NOT NULL WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST, l_quantity NULLS LAST, l_extendedprice NULLS LAST, l_shipdate NULLS LAST, l_tax NULLS LAST, l_discount NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
c AS (SELECT frame_idx, l_quantity * 10 AS bx, l_discount * 1000 AS y, q1 * 10 AS ax, d1 * 1000 AS ay, q2 * 10 - q1 * 10 AS dx, d2 * 1000 - d1 * 1000 AS dy FROM f WHERE i > 2)
SELECT DISTINCT frame_idx FROM c WHERE abs((bx - ax) * dy - (y - ay) * dx) <= 6 * sqrt(dx * dx + dy * dy + 1) AND (bx - ax) * dx + (y - ay) * dy BETWEEN 0 AND dx * dx + dy * dy""",
    "overlap_merge_dedup": f"""WITH {CHUNK_SPLIT}, e AS (SELECT vec_id AS frame_idx, explode(array(CAST(floor(vec_id / 50) AS BIGINT) - 1, CAST(floor(vec_id / 50) AS BIGINT))) AS chunk_id FROM {{embeddings}})
SELECT frame_idx, e.chunk_id FROM e JOIN chunks ON e.chunk_id = chunks.chunk_id WHERE frame_idx BETWEEN start_frame AND end_frame AND NOT (e.chunk_id > 0 AND frame_idx = start_frame)""",
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings".split()


def _selected(sql, spark, sf_dir):
    """The query with its percentile by selection: rows are windowed and stored once, no task holds a clip's values."""
    head, rows, value = (ACC, "f", "m") if ACC in sql else (EV, "ev", "x")
    x = stored(_spark(f"WITH {head} SELECT * FROM {rows}", spark, sf_dir))
    p = selection.percentile(x, ["clip_id"], value, 0.95).withColumnRenamed("clip_id", "of_clip")
    sql = sql.replace(f"WITH {head}, ", "WITH ").replace(f"WITH {head} ", "").replace(f"percentile({value}, 0.95)", "max(p)")
    return spark.sql(sql.replace(f"FROM {rows} GROUP BY clip_id", "FROM {x} LEFT JOIN {p} ON clip_id <=> of_clip GROUP BY clip_id"), x=x, p=p)


def _spark(sql, spark, sf_dir):
    if "percentile(" in sql:
        return _selected(sql, spark, sf_dir)
    sql = sql.replace(LAG, LAG_SPLIT).replace(EV, EV_SPLIT).replace(CHUNK, CHUNK_SPLIT)
    sql = re.sub(r"micros\((\w+)\)", r"unix_micros(CAST(\1 AS TIMESTAMP))", sql)
    sql = re.sub(r"last_ignore\((CASE.*?END)\)", r"last(\1, true)", sql)
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def _duck(sql):
    sql = re.sub(r"micros\(", "epoch_us(", sql).replace("percentile(", "quantile_cont(")
    sql = re.sub(r"last_ignore\((CASE.*?END)\)", r"last_value(\1 IGNORE NULLS)", sql)
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def model_matrix(spark, sf_dir):
    """J13 whole: every clip of the table against every metric, wide by wide() and read back as rows."""
    x = wide(_spark(SQL["metrics_long"], spark, sf_dir))
    return x.unpivot("metric", [c for c in x.columns if c != "metric"], "clip_id", "value")


def wide(long):
    """long(clip_id, metric, value) -> one row a metric, one column a clip, whatever clips there are."""
    return long.groupBy("metric").pivot("clip_id").agg(F.first("value"))


def scorecard(spark, sf_dir):
    return scoring.scorecard_ladder(spark, sf_dir).select("l_orderkey", "quality", "status")


def recommendation(spark, sf_dir):
    return scoring.scorecard_ladder(spark, sf_dir).select("l_orderkey", "performance", "speed", "advice")


def fraction_parse(spark, sf_dir):
    """Rates as text: whole, as a fraction, with a zero denominator and with none."""
    x = table(spark, sf_dir, "lineitem")
    text = F.concat(F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") == 1, "").otherwise(F.concat(F.lit("/"), (F.col("l_linenumber") % 4).cast("string"))))
    return x.select("l_orderkey", "l_linenumber", text.alias("rate_text"), scalars.fraction(text).alias("rate"))


PARTS = (frames, geometry, kernels, partials, tracking, vision, scalars, ordered, sequence, scoring, sizing, logs)
QUERIES = {name: partial(_spark, SPLIT.get(name, sql)) for name, sql in SQL.items()} | {f.__name__: f for f in (model_matrix, scorecard, recommendation, fraction_parse)}
ORACLES = {name: _duck(sql) for name, sql in SQL.items()} | {
    "model_matrix": f"WITH x AS ({_duck(SQL['metrics_long'])}) SELECT c.clip_id, m.metric, x.value FROM (SELECT DISTINCT clip_id FROM x) c CROSS JOIN (SELECT DISTINCT metric FROM x) m LEFT JOIN x ON x.clip_id = c.clip_id AND x.metric = m.metric",
    "scorecard": f"SELECT l_orderkey, quality, status FROM ({scoring.ORACLES['scorecard_ladder']})",
    "recommendation": f"SELECT l_orderkey, performance, speed, advice FROM ({scoring.ORACLES['scorecard_ladder']})",
    "fraction_parse": """WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS top, CAST(l_linenumber % 4 AS VARCHAR) AS bottom FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN top ELSE top || '/' || bottom END AS rate_text,
 CASE WHEN l_linenumber = 1 THEN CAST(top AS DOUBLE) WHEN bottom = '0' THEN 25.0 ELSE CAST(top AS DOUBLE) / CAST(bottom AS DOUBLE) END AS rate FROM t""",
}
for _part in PARTS:
    QUERIES |= _part.QUERIES
    ORACLES |= _part.ORACLES
