"""DuckDB SQL twins of the registered queries, written from the table
definitions; hash constants and the protocol list are shared with the library.
The driver runs both at sf0.01 and compares row counts, schemas and value hashes."""

from __future__ import annotations

from flowscope.functions.hashing import HASH_A, HASH_B, unit_hash_sql
from flowscope.sources.synth import ADDRESSES, DRAW_MULTS, PROTOCOLS, cdf_of, normalise_weights

# ---- shared views -------------------------------------------------------------
_IP = ("((10 + (user_id >> 24)) || '.' || ((user_id >> 16) & 255) || '.' || ((user_id >> 8) & 255)"
       " || '.' || (user_id & 255))")
_HOST = (f"CASE WHEN user_id % 10 = 0 THEN 'host' || user_id || '.example.com' "
         f"WHEN user_id % 10 = 5 THEN 'gw' || user_id || '-' || {_IP} ELSE {_IP} END")

# parsed access log: error events have '-' bytes, hosts of user_id % 10 = 0 hold no quad
LOG = f"""lg AS (
  SELECT event_id, {_HOST} AS ip, date_trunc('second', ts) AS datetime,
         CAST(round(value * 100) AS BIGINT) AS bytes
  FROM events WHERE event_type <> 'error' AND user_id % 10 <> 0)"""

LINE = (f"{_HOST} || ' ' || strftime(ts, '[%d:%H:%M:%S]') || ' \"GET /' || event_type || "
        f"' HTTP/1.0\" ' || CASE WHEN event_type = 'error' THEN '302 -' "
        f"ELSE '200 ' || CAST(round(value * 100) AS BIGINT) END")

ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- logs
ORACLE["log_parse"] = f"WITH {LOG} SELECT ip, datetime, bytes FROM lg"
ORACLE["log_valid_lines"] = (f"SELECT {LINE} AS value FROM events "
                             f"WHERE event_type <> 'error' AND user_id % 10 <> 0")
ORACLE["log_parse_rejects"] = (
    "SELECT count(*) AS n_lines, count(*) FILTER (event_type = 'error' OR user_id % 10 = 0) AS n_filtered, "
    "CAST(0 AS BIGINT) AS n_unparsed FROM events")
ORACLE["log_summary"] = (f"WITH {LOG} SELECT count(*) AS n_lines, count(DISTINCT ip) AS n_ips, "
                         f"CAST(sum(bytes) AS BIGINT) AS total_bytes FROM lg")
ORACLE["log_bytes_by_ip"] = f"WITH {LOG} SELECT ip, CAST(sum(bytes) AS BIGINT) AS bytes FROM lg GROUP BY ip"
ORACLE["log_top_ips"] = (f"WITH {LOG} SELECT ip, CAST(sum(bytes) AS BIGINT) AS bytes FROM lg "
                         f"GROUP BY ip ORDER BY bytes DESC, ip LIMIT 10")
ORACLE["log_hourly_bytes"] = (
    f"WITH {LOG} SELECT time_bucket(INTERVAL 1 HOUR, datetime) AS window_start, "
    f"time_bucket(INTERVAL 1 HOUR, datetime) + INTERVAL 1 HOUR AS window_end, ip, "
    f"CAST(sum(bytes) AS BIGINT) AS bytes FROM lg GROUP BY 1, 2, 3")
ORACLE["log_hourly_slice"] = (
    f"WITH {LOG} SELECT ip, CAST(sum(bytes) AS BIGINT) AS bytes FROM lg "
    f"WHERE datetime >= TIMESTAMP '2024-01-30 00:00:00' AND datetime < TIMESTAMP '2024-01-30 01:00:00' "
    f"GROUP BY ip")
ORACLE["log_bytes_by_subnet16"] = (
    f"WITH {LOG} SELECT split_part(ip, '.', 1) || '.' || split_part(ip, '.', 2) || '.*.*' AS subnet, "
    f"CAST(sum(bytes) AS BIGINT) AS bytes FROM lg GROUP BY 1")
ORACLE["log_bytes_by_subnet24"] = (
    f"WITH {LOG} SELECT split_part(ip, '.', 1) || '.' || split_part(ip, '.', 2) || '.' || "
    f"split_part(ip, '.', 3) || '.*' AS subnet, CAST(sum(bytes) AS BIGINT) AS bytes FROM lg GROUP BY 1")

# ---------------------------------------------------------------- flows
FL = f"""fl AS (
  SELECT event_id, ts AS datetime, event_type AS protocol, {_IP} AS source_ip,
         '10.1.0.' || (event_id % 200) AS destination_ip,
         CAST(round(value * 100) AS INTEGER) AS packet_size
  FROM events)"""
# every row in the four 1-hour windows (slide 15 minutes) that contain it
SW = """sw AS (
  SELECT unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, datetime) - INTERVAL 45 MINUTE,
                                time_bucket(INTERVAL 15 MINUTE, datetime), INTERVAL 15 MINUTE)) AS window_start, *
  FROM fl)"""
TW = """tw AS (SELECT time_bucket(INTERVAL 1 HOUR, datetime) AS window_start, * FROM fl)"""


def _agg(key, src="sw", name=None):
    k = f"{key}, " if key else ""
    return (f"{name or 'ag'} AS (SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, {k}"
            f"CAST(sum(packet_size) AS BIGINT) AS bytes, count(*) AS n FROM {src} GROUP BY ALL)")


def _heavy(key, h=0.2):
    return (f"SELECT a.window_start, a.window_end, a.{key}, a.bytes, t.total_bytes, "
            f"a.bytes / t.total_bytes AS share FROM ag a JOIN (SELECT window_start, window_end, "
            f"CAST(sum(bytes) AS BIGINT) AS total_bytes FROM ag GROUP BY ALL) t "
            f"ON a.window_start = t.window_start AND a.window_end = t.window_end "
            f"WHERE a.bytes > CAST({h} AS DOUBLE) * t.total_bytes")


def _topk(key, k=3):
    return (f"SELECT window_start, window_end, rank, {key}, bytes FROM (SELECT window_start, window_end, {key}, bytes, "
            f"CAST(row_number() OVER (PARTITION BY window_start, window_end ORDER BY bytes DESC, {key}) AS INTEGER) AS rank "
            f"FROM ag) WHERE rank <= {k}")


def _deviant(key, x=2.0):
    return (f"SELECT m.window_start, m.window_end, m.{key}, m.avg_size FROM "
            f"(SELECT window_start, window_end, {key}, bytes / n AS avg_size FROM ag) m JOIN "
            f"(SELECT window_start, window_end, stddev_pop(bytes / n) AS sd FROM ag GROUP BY ALL) s "
            f"ON m.window_start = s.window_start AND m.window_end = s.window_end "
            f"WHERE m.avg_size > CAST({x} AS DOUBLE) * s.sd")


def _latest(key, k=3):
    return (f"SELECT window_start, window_end, {key}, bytes FROM ag "
            f"ORDER BY window_start DESC, bytes DESC, {key} LIMIT {k}")


ORACLE["flow_parse"] = (f"WITH {FL} SELECT date_trunc('millisecond', datetime) AS datetime, protocol, "
                        f"source_ip, destination_ip, packet_size FROM fl")
# the events lie in January, five hours behind UTC in New York
ORACLE["flow_parse_zoned"] = (f"WITH {FL} SELECT date_trunc('millisecond', datetime) + INTERVAL 5 HOUR AS datetime, protocol, "
                              f"source_ip, destination_ip, packet_size FROM fl")
ORACLE["flow_parse_rejects"] = (f"WITH {FL} SELECT count(*) AS n_lines, CAST(0 AS BIGINT) AS n_bad_time, "
                                f"count(*) FILTER (packet_size IS NULL) AS n_bad_size FROM fl")
ORACLE["format_flow_line"] = (f"WITH {FL} SELECT strftime(datetime, '%Y-%m-%d_%H:%M:%S.%g') || ' ' || protocol "
                              f"|| ' ' || source_ip || ' ' || destination_ip || ' ' || packet_size AS value FROM fl")
ORACLE["flow_grand_total"] = f"WITH {FL} SELECT CAST(sum(packet_size) AS BIGINT) AS bytes, count(*) AS n FROM fl"
ORACLE["running_total_by_protocol"] = (f"WITH {FL} SELECT protocol, CAST(sum(packet_size) AS BIGINT) AS bytes, "
                                       f"count(*) AS n FROM fl GROUP BY protocol")
ORACLE["protocol_bytes_tumbling"] = (f"WITH {FL}, {TW}, {_agg('protocol', 'tw')} "
                                     f"SELECT window_start, window_end, protocol, bytes FROM ag")
ORACLE["topk_protocols_tumbling"] = f"WITH {FL}, {TW}, {_agg('protocol', 'tw')} {_topk('protocol')}"
ORACLE["protocol_bytes_sliding"] = (f"WITH {FL}, {SW}, {_agg('protocol')} "
                                    f"SELECT window_start, window_end, protocol, bytes FROM ag")
ORACLE["ip_bytes_sliding"] = (f"WITH {FL}, {SW}, {_agg('source_ip')} "
                              f"SELECT window_start, window_end, source_ip, bytes FROM ag")
ORACLE["total_bytes_sliding"] = f"WITH {FL}, {SW}, {_agg(None)} SELECT window_start, window_end, bytes FROM ag"
ORACLE["protocol_avg_sliding"] = (f"WITH {FL}, {SW}, {_agg('protocol')} "
                                  f"SELECT window_start, window_end, protocol, bytes / n AS avg_size FROM ag")
ORACLE["ip_avg_sliding"] = (f"WITH {FL}, {SW}, {_agg('source_ip')} "
                            f"SELECT window_start, window_end, source_ip, bytes / n AS avg_size FROM ag")

# ---------------------------------------------------------------- flagship
ORACLE["heavy_protocols"] = f"WITH {FL}, {SW}, {_agg('protocol')} {_heavy('protocol')}"
ORACLE["topk_protocols"] = f"WITH {FL}, {SW}, {_agg('protocol')} {_topk('protocol')}"
ORACLE["deviant_protocols"] = f"WITH {FL}, {SW}, {_agg('protocol')} {_deviant('protocol')}"
ORACLE["heavy_ips"] = f"WITH {FL}, {SW}, {_agg('source_ip')} {_heavy('source_ip')}"
ORACLE["topk_ips"] = f"WITH {FL}, {SW}, {_agg('source_ip')} {_topk('source_ip')}"
ORACLE["deviant_ips"] = f"WITH {FL}, {SW}, {_agg('source_ip')} {_deviant('source_ip')}"
ORACLE["latest_topk_protocols"] = f"WITH {FL}, {SW}, {_agg('protocol')} {_latest('protocol')}"
ORACLE["latest_topk_ips"] = f"WITH {FL}, {SW}, {_agg('source_ip')} {_latest('source_ip')}"


def _snap_part(key, func, body, value):
    return (f"SELECT window_start, window_end, '{func}' AS func, {key} AS key, CAST({value} AS DOUBLE) AS value "
            f"FROM ({body})")


def _snapshot():
    p_ag, i_ag = _agg("protocol"), _agg("source_ip")
    parts = []
    for key, ag, funcs in (("protocol", p_ag, ("func1", "func2", "func3")),
                           ("source_ip", i_ag, ("func4", "func5", "func6"))):
        for func, body, value in zip(funcs, (_heavy(key), _topk(key), _deviant(key)), ("share", "bytes", "avg_size")):
            parts.append(f"(WITH {ag} {_snap_part(key, func, body, value)})")
    return f"WITH {FL}, {SW} " + " UNION ALL ".join(parts)


ORACLE["monitor_snapshot"] = _snapshot()

# ---------------------------------------------------------------- shedding
UA = unit_hash_sql("event_id", HASH_A)
UB = unit_hash_sql("event_id", HASH_B)
SI = f"""si AS (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS bytes, {UA} AS u
  FROM events WHERE event_type <> 'error')"""
_THR = "CAST(0.3 AS DOUBLE) * 65536"


def _wdist(h, by=""):
    """Distance from rows (by.., bucket, nu, nv) in CTE ``h``."""
    part = f"PARTITION BY {by} " if by else ""
    sel = f"{by}, " if by else ""
    return f"""c AS (SELECT {sel}bucket,
      sum(nu) OVER ({part}ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cu,
      sum(nv) OVER ({part}ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cv,
      sum(nu) OVER ({part.strip()}) AS tu, sum(nv) OVER ({part.strip()}) AS tv,
      lead(bucket) OVER ({part}ORDER BY bucket) - bucket AS gap FROM {h}),
    d AS (SELECT {sel}sum(abs(CAST(cu AS HUGEINT) * tv - CAST(cv AS HUGEINT) * tu) * coalesce(gap, 0)) AS num,
      max(tu) AS tu, max(tv) AS tv FROM c {"GROUP BY " + by if by else ""})"""


ORACLE["shed_hash"] = f"WITH {SI} SELECT event_id, bytes FROM si WHERE u < {_THR}"
ORACLE["bytes_histogram"] = f"WITH {SI} SELECT bytes // 10000 AS bucket, count(*) AS n FROM si GROUP BY 1"
ORACLE["histogram_aligned"] = (
    f"WITH {SI} SELECT bytes // 10000 AS bucket, count(*) AS nu, count(*) FILTER (WHERE u < {_THR}) AS nv "
    f"FROM si GROUP BY 1")
ORACLE["histogram_wasserstein"] = (
    f"WITH {SI}, h AS (SELECT bytes // 10000 AS bucket, count(*) AS nu, "
    f"count(*) FILTER (WHERE u < {_THR}) AS nv FROM si GROUP BY 1), {_wdist('h')} "
    f"SELECT CAST(tu AS BIGINT) AS n_u, CAST(tv AS BIGINT) AS n_v, CASE WHEN tu * tv > 0 THEN "
    f"CAST(num AS DOUBLE) / (CAST(tu AS DOUBLE) * CAST(tv AS DOUBLE)) END AS distance FROM d")
ORACLE["shed_sweep"] = (f"WITH {SI} SELECT r.i / 100 AS rate, bytes // 10000 AS bucket, count(*) AS n "
                        f"FROM si, range(1, 99) r(i) WHERE u * 100 < r.i * 65536 GROUP BY 1, 2")
_ACC = (f"WITH {SI}, h AS (SELECT r.i / 100 AS rate, bytes // 10000 AS bucket, count(*) AS nu, "
        f"count(*) FILTER (WHERE u * 100 < r.i * 65536) AS nv FROM si, range(1, 99) r(i) GROUP BY 1, 2), "
        f"{_wdist('h', 'rate')}, acc AS (SELECT rate, CAST(tv AS BIGINT) AS n_kept, CASE WHEN tu * tv > 0 THEN "
        f"CAST(num AS DOUBLE) / (CAST(tu AS DOUBLE) * CAST(tv AS DOUBLE)) END AS distance FROM d)")
ORACLE["shed_accuracy"] = f"{_ACC} SELECT rate, n_kept, distance, 1 - distance AS accuracy FROM acc"
ORACLE["minmax_scale"] = (
    f"{_ACC} SELECT rate, n_kept, distance, 1 - distance AS accuracy, CASE WHEN max(n_kept) OVER () <> "
    f"min(n_kept) OVER () THEN (n_kept - min(n_kept) OVER ()) / (max(n_kept) OVER () - min(n_kept) OVER ()) "
    f"END AS load FROM acc")

# ---------------------------------------------------------------- profiling
_AB = f"{UA} < CAST(0.5 AS DOUBLE) * 65536 AND {UB} < CAST(0.3 AS DOUBLE) * 65536"
ORACLE["filter_chain_ab"] = f"SELECT event_id, {LINE} AS value FROM events WHERE {_AB}"
ORACLE["filter_chain_ba"] = ORACLE["filter_chain_ab"]
ORACLE["filter_chain_profile"] = f"""WITH p AS (SELECT count(*) AS n_in,
    count(*) FILTER (WHERE {UA} < CAST(0.5 AS DOUBLE) * 65536) AS n_a,
    count(*) FILTER (WHERE {UB} < CAST(0.3 AS DOUBLE) * 65536) AS n_b,
    count(*) FILTER (WHERE {_AB}) AS n_ab FROM events),
  q AS (SELECT *, n_a / n_in AS sel_a, n_b / n_in AS sel_b FROM p),
  r AS (SELECT *, CAST(1.0 AS DOUBLE) + sel_a * CAST(1.0 AS DOUBLE) AS cost_ab,
               CAST(1.0 AS DOUBLE) + sel_b * CAST(1.0 AS DOUBLE) AS cost_ba FROM q)
  SELECT *, CASE WHEN cost_ab <= cost_ba THEN 'A,B' ELSE 'B,A' END AS best_order FROM r"""


def _sel(runs):
    skey = f"(event_id * {runs} + run)"
    ua, ub = unit_hash_sql(skey, HASH_A), unit_hash_sql(skey, HASH_B)
    return f"""s0 AS (SELECT r.run, {ua} AS ua, {ub} AS ub FROM events, range(0, {runs}) r(run)),
  pr AS (SELECT run, count(*) AS n_in, count(*) FILTER (WHERE ua < CAST(0.5 AS DOUBLE) * 65536) AS n_a
         FROM s0 GROUP BY run),
  pb AS (SELECT run, g.i, count(*) FILTER (WHERE ub * 100 < g.i * 65536) AS n_b
         FROM s0, range(1, 100) g(i) GROUP BY run, g.i),
  sel AS (SELECT pb.run, pb.i, pb.i / 100 AS rate_b, pr.n_a / pr.n_in AS sel_a, pb.n_b / pr.n_in AS sel_b
          FROM pb JOIN pr ON pb.run = pr.run)"""


def _series(runs):
    one = "CAST(1.0 AS DOUBLE)"
    return f"""{_sel(runs)},
  fz AS (SELECT run, sel_a, sel_b, j.j / 10 AS c FROM sel, range(1, 50) j(j) WHERE i = 50),
  series AS (
    SELECT run, 'reorder' AS experiment, 'A_B' AS variant, rate_b AS param, {one} / ({one} + sel_a * {one}) AS value FROM sel
    UNION ALL SELECT run, 'reorder', 'B_A', rate_b, {one} / ({one} + sel_b * {one}) FROM sel
    UNION ALL SELECT run, 'fusion', 'A_B', c, {one} / ({one} + sel_a * {one}) FROM fz
    UNION ALL SELECT run, 'fusion', 'AB', c, {one} / (({one} + {one}) * c / (c + {one})) FROM fz)"""


_MEANS = f"""WITH {_series(5)}, m AS (SELECT experiment, variant, param, round(avg(value), 9) AS value
  FROM series GROUP BY ALL)"""
ORACLE["chain_cost_model"] = f"""WITH {_sel(1)}, t AS (SELECT rate_b, CAST(1.0 AS DOUBLE) AS cost_a,
    CAST(1.0 AS DOUBLE) AS cost_b, sel_a, sel_b, CAST(1.0 AS DOUBLE) AS cost_ratio FROM sel)
  SELECT *, cost_a + sel_a * cost_b AS cost_ab, cost_b + sel_b * cost_a AS cost_ba,
         (cost_a + cost_b) * cost_ratio / (cost_ratio + CAST(1.0 AS DOUBLE)) AS cost_fused FROM t"""
ORACLE["chain_throughput"] = f"WITH {_series(1)} SELECT CAST(run AS INTEGER) AS run, experiment, variant, param, value FROM series"
ORACLE["mean_over_runs"] = f"{_MEANS} SELECT * FROM m"
ORACLE["ratio_to_max"] = (f"{_MEANS}, mx AS (SELECT experiment, max(value) AS mx FROM m WHERE variant = 'A_B' "
                          f"GROUP BY experiment) SELECT m.experiment, variant, param, value / mx AS ratio "
                          f"FROM m JOIN mx ON m.experiment = mx.experiment")
ORACLE["weights_to_cdf"] = f"""WITH {FL}, c AS (SELECT protocol, count(*) AS n FROM fl GROUP BY protocol)
  SELECT CAST(row_number() OVER (ORDER BY protocol) - 1 AS INTEGER) AS idx, protocol,
         n / sum(n) OVER () AS pdf,
         sum(n) OVER (ORDER BY protocol ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(n) OVER () AS cdf
  FROM c"""


def _pick_sql(u, values, cdf):
    below = " + ".join(f"CASE WHEN CAST('{c!r}' AS DOUBLE) <= ({u}) / 65536 THEN 1 ELSE 0 END" for c in cdf)
    vals = "[" + ", ".join(f"'{v}'" for v in values) + "]"
    return f"{vals}[least({below}, {len(values) - 1}) + 1]"


def _synth():
    p_cdf = cdf_of(normalise_weights(None, 8))
    i_cdf = cdf_of(normalise_weights(None, 5))
    h = {k: unit_hash_sql("event_id", m) for k, m in DRAW_MULTS.items()}
    return (f"SELECT ts AS datetime, {_pick_sql(h['protocol'], PROTOCOLS[:8], p_cdf)} AS protocol, "
            f"{_pick_sql(h['source'], ADDRESSES[:5], i_cdf)} AS source_ip, "
            f"{_pick_sql(h['destination'], ADDRESSES[:5], i_cdf)} AS destination_ip, "
            f"CAST(16 + ({h['size']}) * 12273 // 65536 AS INTEGER) AS packet_size FROM events")


ORACLE["synth_flows"] = _synth()

# ---------------------------------------------------------------- result store
_RES = (f"WITH r AS ({ORACLE['monitor_snapshot']}) ")
ORACLE["results_all"] = _RES + "SELECT window_end AS time, func, key, value FROM r"
ORACLE["results_latest"] = (_RES + "SELECT window_end AS time, func, key, value FROM r "
                            "WHERE window_end = (SELECT max(window_end) FROM r)")
ORACLE["results_json_roundtrip"] = ORACLE["results_all"]

# ---------------------------------------------------------------- streaming twins
# the end of the feed is announced, so every twin is the batch answer
for _name, _batch in (("stream_heavy_protocols", "heavy_protocols"), ("stream_topk_protocols", "topk_protocols"),
                      ("stream_deviant_protocols", "deviant_protocols"), ("stream_heavy_ips", "heavy_ips"),
                      ("stream_topk_ips", "topk_ips"), ("stream_deviant_ips", "deviant_ips"),
                      ("stream_hourly_bytes", "log_hourly_bytes"), ("stream_joined_heavy_protocols", "heavy_protocols"),
                      ("stream_append_topk_ips", "topk_ips"), ("frequent_heavy_ips", "heavy_ips")):
    ORACLE[_name] = ORACLE[_batch]
# rows of a drop are late for windows that ended at or before the largest time of the
# drops before, less the delay (whole milliseconds)
ORACLE["stream_late_rows"] = f"""WITH a AS (
    SELECT *, epoch_us(ts) + CASE WHEN event_id % 10 = 3 THEN (event_id * 37) % 100 + 1 ELSE 0 END * 3600000000 AS arrival
    FROM events),
  b AS (SELECT min(arrival) AS lo, max(arrival) AS hi FROM a),
  d AS (SELECT ts, event_type AS protocol, CAST(round(value * 100) AS INTEGER) AS packet_size,
               (arrival - lo) * 4 // (hi - lo + 1) AS drop_no, time_bucket(INTERVAL 1 HOUR, ts) AS window_start FROM a, b),
  m AS (SELECT drop_no, date_trunc('millisecond', max(ts)) AS top FROM d GROUP BY drop_no),
  c AS (SELECT r.i, max(m.top) - INTERVAL 1 MINUTE AS cut FROM range(4) r(i) LEFT JOIN m ON m.drop_no < r.i GROUP BY r.i),
  f AS (SELECT d.*, coalesce(window_start + INTERVAL 1 HOUR <= cut, false) AS late FROM d JOIN c ON c.i = d.drop_no)
  SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, protocol, CAST(sum(packet_size) AS BIGINT) AS bytes,
         count(*) AS n, (SELECT count(*) FROM f WHERE late) AS late_rows
  FROM f WHERE NOT late GROUP BY ALL"""


def _changed():
    """Panes up to the last one logged before the change under the first settings, the others under the second."""
    def windows(width, slide, cond):
        return (f"SELECT unnest(generate_series(time_bucket(INTERVAL {slide} MINUTE, pane) - INTERVAL {width - slide} MINUTE, "
                f"time_bucket(INTERVAL {slide} MINUTE, pane), INTERVAL {slide} MINUTE)) AS window_start, "
                f"INTERVAL {width} MINUTE AS width, since, source_ip, packet_size FROM p WHERE {cond}")
    limits = ((0.2, 3, 2.0), (0.3, 2, 1.5))
    pick = lambda i: f"CASE WHEN first THEN {limits[0][i]} ELSE {limits[1][i]} END"
    return f"""WITH {FL},
  b AS (SELECT min(datetime) AS lo, max(datetime) AS hi FROM fl),
  d AS (SELECT *, (epoch_us(datetime) - epoch_us(lo)) * 4 // (epoch_us(hi) - epoch_us(lo) + 1) AS drop_no,
               time_bucket(INTERVAL 15 MINUTE, datetime) AS pane FROM fl, b),
  m AS (SELECT date_trunc('millisecond', max(datetime)) - INTERVAL 1 MINUTE AS top FROM d WHERE drop_no < 2),
  c AS (SELECT max(pane) + INTERVAL 15 MINUTE AS cut FROM d, m WHERE drop_no < 2 AND pane + INTERVAL 15 MINUTE <= top),
  p AS (SELECT *, CASE WHEN pane < cut THEN TIMESTAMP '1900-01-01' ELSE cut END AS since FROM d, c),
  w AS ({windows(60, 15, "pane < cut")} UNION ALL {windows(120, 30, "pane >= cut")}),
  a AS (SELECT since, since < TIMESTAMP '1901-01-01' AS first, window_start, window_start + width AS window_end, source_ip,
               CAST(sum(packet_size) AS BIGINT) AS bytes, sum(packet_size) / count(packet_size) AS mean FROM w GROUP BY ALL),
  s AS (SELECT *, sum(bytes) OVER q AS total, stddev_pop(mean) OVER q AS sd,
               row_number() OVER (PARTITION BY since, window_start ORDER BY bytes DESC, source_ip) AS rank
        FROM a WINDOW q AS (PARTITION BY since, window_start))
  SELECT since, window_start, window_end, 'func1' AS func, source_ip AS key, CAST(bytes / total AS DOUBLE) AS value
  FROM s WHERE bytes > CAST({pick(0)} AS DOUBLE) * total
  UNION ALL SELECT since, window_start, window_end, 'func2', source_ip, CAST(bytes AS DOUBLE) FROM s WHERE rank <= {pick(1)}
  UNION ALL SELECT since, window_start, window_end, 'func3', source_ip, mean FROM s WHERE mean > CAST({pick(2)} AS DOUBLE) * sd"""


ORACLE["stream_changed_parameters"] = _changed()
ORACLE["stream_shed_backlog"] = f"""WITH a AS (
    SELECT *, epoch_us(ts) + CASE WHEN event_id % 10 = 3 THEN (event_id * 37) % 100 + 1 ELSE 0 END * 3600000000 AS arrival
    FROM events),
  b AS (SELECT min(arrival) AS lo, max(arrival) AS hi FROM a),
  d AS (SELECT {unit_hash_sql("event_id", HASH_A)} AS u, CAST(round(value * 100) AS INTEGER) AS packet_size,
               (arrival - lo) * 4 // (hi - lo + 1) AS batch_id FROM a, b),
  r AS (SELECT batch_id, count(*) AS n_in, least(1.0, CAST(1500 AS DOUBLE) / count(*)) AS rate FROM d GROUP BY batch_id),
  k AS (SELECT d.*, r.n_in, r.rate, u < r.rate * 65536 AS kept FROM d JOIN r ON d.batch_id = r.batch_id)
  SELECT CAST(batch_id AS BIGINT) AS batch_id, n_in, count(*) FILTER (kept) AS n_kept, CAST(rate AS DOUBLE) AS rate,
         (SELECT CAST(sum(packet_size) AS BIGINT) FROM k WHERE kept) AS kept_bytes FROM k GROUP BY batch_id, n_in, rate"""
ORACLE["distinct_ips_sliding"] = (
    f"WITH {FL}, {SW} SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, "
    f"count(DISTINCT source_ip) AS n_ips, true AS within_bound FROM sw GROUP BY window_start")
ORACLE["shed_bernoulli_report"] = (f"WITH {SI} SELECT count(*) AS n_in, true AS is_subset, true AS no_repeats, "
                                   f"true AS share_in_bounds FROM si")


def _keys(body, key, order, k=None):
    return (f"SELECT window_start, string_agg({key}, ',' ORDER BY {order} DESC, {key}) AS keys, count(*) AS n "
            f"FROM ({body}) {f'WHERE rank <= {k}' if k else ''} GROUP BY window_start")


def _documents():
    parts, names = [], []
    for key, funcs in (("protocol", (1, 2, 3)), ("source_ip", (4, 5, 6))):
        ranked = (f"SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY avg_size DESC, {key}) AS rank "
                  f"FROM ({_deviant(key)})")
        for f, body in zip(funcs, (_keys(_heavy(key), key, "bytes"), _keys(_topk(key), key, "bytes"),
                                   _keys(ranked, key, "avg_size", 3))):
            parts.append(f"f{f} AS (WITH {_agg(key)} {body})")
            names.append(f"coalesce(f{f}.keys, '') AS func{f}")
        parts.append(f"n{funcs[2]} AS (WITH {_agg(key)} SELECT window_start, count(*) AS n FROM ({_deviant(key)}) GROUP BY 1)")
    joins = " ".join(f"LEFT JOIN {t} ON {t}.window_start = w.window_start" for t in ("f1", "f2", "f3", "f4", "f5", "f6", "n3", "n6"))
    return (f"WITH {FL}, {SW}, {', '.join(parts)}, w AS (SELECT DISTINCT window_start FROM sw) "
            f"SELECT w.window_start + INTERVAL 1 HOUR AS time, {', '.join(names)}, coalesce(n3.n, 0) AS n_func3, "
            f"coalesce(n6.n, 0) AS n_func6 FROM w {joins}")


ORACLE["results_documents"] = _documents()
ORACLE["stream_running_total_by_protocol"] = ORACLE["running_total_by_protocol"]
ORACLE["stream_latest_topk_protocols"] = ORACLE["latest_topk_protocols"]
ORACLE["stream_latest_topk_ips"] = ORACLE["latest_topk_ips"]

# ---------------------------------------------------------------- store operations, text scans
ORACLE["results_replaced_after_delete"] = (_RES + "SELECT window_end AS time, func, key, value FROM r "
                                           "WHERE func IN ('func2', 'func5')")
ORACLE["log_text_bytes_by_ip"] = ORACLE["log_bytes_by_ip"]
ORACLE["flow_text_parse"] = ORACLE["flow_parse"]
