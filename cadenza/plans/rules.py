"""Score rules of the evaluators and sizing formulas, one SQL text each ({table} stands for a driver table).

Rates per clip stand in for the detectors' counts: a clip is an order status or an event type.
"""

R = """r AS (SELECT event_type AS clip_id, CAST(count(*) AS BIGINT) AS n, avg(CAST(CASE WHEN value < 10 THEN 1.0 ELSE 0.0 END AS DOUBLE)) AS miss, avg(CAST(CASE WHEN value > 60 THEN 1.0 ELSE 0.0 END AS DOUBLE)) AS dup,
 avg(CAST(CASE WHEN value BETWEEN 20 AND 25 THEN 1.0 ELSE 0.0 END AS DOUBLE)) AS wobble, avg(CAST(CASE WHEN value BETWEEN 30 AND 32 THEN 1.0 ELSE 0.0 END AS DOUBLE)) AS deform, avg(value) / 1000 AS res, avg(value) / 10 AS jitter FROM {events} GROUP BY event_type)"""
S = f"""{R}, s AS (SELECT clip_id, n, greatest(1.0, least(5.0, 5 - least(2.5, 4 * miss) - least(1.5, dup / 0.15 * 1.5) - least(1.0, wobble / 0.15) - least(0.5, deform / 0.15 * 0.5))) AS ball,
 5 - least(3.5, 25 * wobble) AS player, 5 - least(3.5, 5 * dup) AS occlusion,
 CASE WHEN res > 0.012 THEN greatest(1.0, 5 - least(2.5, (res - 0.012) / 0.035 * 2.5) - least(2.0, deform / 0.05 * 2)) ELSE 5.0 END AS pitch,
 CASE WHEN n >= 4 AND miss > 0.20 THEN greatest(1.0, 5 - least(2.5, 4 * miss)) ELSE 5.0 END AS goal,
 CASE WHEN jitter > 3 THEN greatest(1.0, 5 - least(3.0, (jitter - 3) * 0.4)) ELSE 5.0 END AS graphics, 5 - least(3.0, 8 * deform) AS camera FROM r),
m AS (SELECT *, greatest(1.0, least(5.0, (ball + player + occlusion + pitch + graphics + camera) / 6)) AS mos FROM s)"""

SQL = {
    "evaluator_scores": f"WITH {S} SELECT clip_id, round(ball, 5) AS ball, round(player, 5) AS player, round(occlusion, 5) AS occlusion, round(pitch, 5) AS pitch, round(goal, 5) AS goal, round(graphics, 5) AS graphics, round(camera, 5) AS camera FROM s",
    "mos_proxy": f"WITH {S} SELECT clip_id, round(mos, 5) AS mos FROM m",
    "expected_frames": "SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 * o_custkey - 1 WHEN o_totalprice > 0 THEN round(o_totalprice / 100 * 50) ELSE 0 END AS BIGINT) AS n_frames FROM {orders}",
    "av_drift": "SELECT o_orderkey, abs(o_totalprice - o_custkey) / 100000 AS drift, abs(o_totalprice - o_custkey) / 100000 <= 0.040 AS safe FROM {orders}",
    "chunk_size": "SELECT o_orderkey, CAST(least(1500, greatest(greatest(50, ceil(o_custkey / (2.0 * (1 + o_orderkey % 8)))), least(200, greatest(50, floor(o_custkey / (1.0 * (1 + o_orderkey % 8))))))) AS BIGINT) AS frames FROM {orders}",
    "source_baseline_stride": "SELECT label, CAST(count(*) AS BIGINT) AS n_frames FROM {embeddings} WHERE vec_id % 5 = 0 GROUP BY label",
    "fps_ok": "SELECT o_orderkey, abs(o_totalprice / 3000 - 50) <= 1.0 OR abs(o_custkey / 10.0 - 50) <= 1.0 AS fps_ok FROM {orders}",
    "audio_ok": "SELECT o_orderkey, o_orderstatus <> 'F' AND abs(o_totalprice / 100000 - o_custkey / 1000.0) <= 0.25 AS audio_ok FROM {orders}",
    "cut_tolerance": "WITH c AS (SELECT o_custkey AS clip_id, CAST(count(*) AS BIGINT) AS cuts, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS hybrids FROM {orders} GROUP BY o_custkey) SELECT clip_id, cuts, hybrids, hybrids = 0 OR (hybrids <= 2 AND cuts >= 5) AS ok FROM c",
}
