"""Named parts of the DuckDB queries that results are held against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

PARTS: dict[str, str] = {
    "obs": """SELECT event_id, ts AS captured_at, floor(epoch(ts))::BIGINT AS cap, event_type, value, user_id,
      strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d') AS service_date, user_id::VARCHAR AS trip_id, 'R' || (user_id % 6) AS route_id, (user_id % 2)::INT AS direction_id,
      CAST(json_extract(props, '$.k') AS INT) % 10 AS stop_sequence, 'PF_A0' || (CAST(json_extract(props, '$.k') AS INT) % 10) || '_C' AS stop_id FROM events""",
    "vp": "SELECT * FROM obs WHERE event_type IN ('view', 'click', 'purchase')",
    "tu": "SELECT *, cap + (floor(value)::INT - 40) * 600 AS arr FROM obs WHERE event_type IN ('signup', 'error')",
    "vpl": "SELECT *, lag(stop_sequence) OVER w AS ps, lag(cap) OVER w AS pcap FROM vp WINDOW w AS (PARTITION BY trip_id ORDER BY captured_at, event_id)",
    "vpa": """SELECT trip_id, service_date, route_id, direction_id, stop_id, stop_sequence, (pcap + cap) // 2 AS arr, (cap - pcap)::INT AS bracket, (stop_sequence - ps)::INT AS jump,
      'vehicle_position' AS src, captured_at, cap, cap - pcap <= 43200 AS confident FROM vpl WHERE stop_sequence > ps""",
    "tuh": "SELECT *, arr - cap AS horizon FROM tu WHERE arr IS NOT NULL AND stop_sequence IS NOT NULL",
    "tux": "SELECT trip_id, stop_sequence, count(*) AS observation_count FROM tuh GROUP BY ALL HAVING max(horizon) > 0 AND min(horizon) < 0",
    "tua": """SELECT h.trip_id, service_date, route_id, direction_id, stop_id, h.stop_sequence, arr, horizon::INT AS bracket, 1::INT AS jump, 'trip_update' AS src, captured_at, cap,
      horizon <= 43200 AS confident, observation_count FROM tuh h JOIN tux USING (trip_id, stop_sequence) WHERE horizon > 0
      QUALIFY row_number() OVER (PARTITION BY h.trip_id, h.stop_sequence ORDER BY captured_at DESC, event_id DESC) = 1""",
    "arrs": "SELECT * FROM vpa UNION ALL SELECT * EXCLUDE (observation_count) FROM tua WHERE NOT EXISTS (SELECT 1 FROM vpa v WHERE v.trip_id = tua.trip_id AND v.stop_sequence = tua.stop_sequence)",
    "anew": "SELECT *, CASE WHEN stop_sequence <= lag(stop_sequence) OVER (PARTITION BY trip_id ORDER BY arr, stop_sequence, captured_at, bracket) THEN 1 ELSE 0 END AS anew FROM arrs",
    "runs": "SELECT * EXCLUDE (anew), (sum(anew) OVER (PARTITION BY trip_id ORDER BY arr, stop_sequence, captured_at, bracket ROWS UNBOUNDED PRECEDING))::INT AS trip_run FROM anew",
    "pairs": """SELECT *, lag(stop_id) OVER w AS from_stop_id, lag(stop_sequence) OVER w AS from_seq, lag(arr) OVER w AS dep, lag(bracket) OVER w AS pb, lag(confident) OVER w AS pc
      FROM runs WINDOW w AS (PARTITION BY trip_id, trip_run ORDER BY stop_sequence)""",
    "sched": "SELECT c_custkey::VARCHAR AS trip_id, q::INT AS seq, ((c_custkey % 24) * 3600 + q * 2400)::INT AS off, 'PF_A0' || q || '_C' AS stop_id, 'R' || (c_custkey % 6) AS route_id, (c_custkey % 2)::INT AS direction_id FROM customer, range(0, 10) t(q)",
    "segs0": """SELECT p.trip_id, trip_run, p.route_id, p.direction_id, service_date, from_stop_id, p.stop_id AS to_stop_id, from_seq::INT AS from_stop_sequence, stop_sequence::INT AS stop_sequence,
      (stop_sequence - from_seq)::INT AS stop_span, dep, arr, (arr - dep)::INT AS dur, greatest(bracket, pb)::INT AS bracket, confident AND pc AS confident, src, cap,
      epoch(strptime(service_date, '%Y-%m-%d'))::BIGINT + 18000 + a.off AS sched_dep, epoch(strptime(service_date, '%Y-%m-%d'))::BIGINT + 18000 + b.off AS sched_arr, (b.off - a.off)::INT AS sdur
      FROM pairs p LEFT JOIN sched a ON a.trip_id = p.trip_id AND a.seq = from_seq LEFT JOIN sched b ON b.trip_id = p.trip_id AND b.seq = stop_sequence WHERE from_seq IS NOT NULL""",
    "segs": "SELECT *, (dur - sdur)::INT AS delay, dur >= -bracket AND dur <= 2592000 AND (sdur IS NULL OR sdur <= 0 OR dur <= sdur * 400) AS plausible FROM segs0",
    "fseg": "SELECT * FROM segs WHERE plausible AND confident AND sdur IS NOT NULL",
    "cal": """SELECT *, make_timestamp((dep - 18000) * 1000000) AS loc FROM fseg""",
    "feat": """SELECT *, hour(loc)::INT AS local_hour, hour(loc) + minute(loc) / 60.0::DOUBLE AS hf, (isodow(loc) - 1)::INT AS dow FROM cal""",
    "comp": """SELECT *, dur - quantile_cont(dur, 0.5) OVER (PARTITION BY from_stop_id, to_stop_id ORDER BY arr, service_date, trip_id, trip_run, stop_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS deviation FROM fseg""",
    "roll": """SELECT *, quantile_cont(dur, 0.5) OVER l AS roll_median, avg(dur) OVER l AS roll_mean, avg(delay) OVER l AS roll_delay_mean, least(row_number() OVER o, 5) AS roll_n, avg(deviation) OVER l AS roll_deviation, row_number() OVER o AS place
      FROM comp WINDOW o AS (PARTITION BY from_stop_id, to_stop_id ORDER BY arr, service_date, trip_id, trip_run, stop_sequence), l AS (PARTITION BY from_stop_id, to_stop_id ORDER BY arr, service_date, trip_id, trip_run, stop_sequence ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "lastroll": "SELECT * FROM roll QUALIFY row_number() OVER (PARTITION BY from_stop_id, to_stop_id, arr ORDER BY place DESC) = 1",
    "recent": """SELECT f.*, r.arr AS completed, f.dep - r.arr AS age, r.roll_median, r.roll_mean, r.roll_delay_mean, r.roll_n, r.roll_deviation
      FROM feat f ASOF LEFT JOIN lastroll r ON f.from_stop_id = r.from_stop_id AND f.to_stop_id = r.to_stop_id AND f.dep > r.arr""",
    "look": "SELECT * FROM roll QUALIFY row_number() OVER (PARTITION BY from_stop_id, to_stop_id ORDER BY place DESC) = 1",
    "brk": """SELECT *, CASE WHEN lag(stop_sequence) OVER w IS NOT NULL AND NOT (abs(dep - (lag(dep) OVER w + lag(dur) OVER w)) <= 1 AND from_stop_sequence = lag(stop_sequence) OVER w) THEN 1 ELSE 0 END AS brk
      FROM feat WINDOW w AS (PARTITION BY service_date, trip_id, trip_run ORDER BY from_stop_sequence, stop_sequence)""",
    "blocks": "SELECT * EXCLUDE (brk), (sum(brk) OVER (PARTITION BY service_date, trip_id, trip_run ORDER BY from_stop_sequence, stop_sequence ROWS UNBOUNDED PRECEDING))::INT AS block_no FROM brk",
    "numbered": "SELECT *, row_number() OVER (PARTITION BY service_date, trip_id, trip_run, block_no ORDER BY from_stop_sequence, stop_sequence) AS place FROM blocks",
    "journ": """SELECT a.service_date, a.trip_id, a.trip_run, a.block_no, n::INT AS n_segments, any_value(a.route_id) AS route_id, any_value(a.direction_id) AS direction_id, any_value(a.from_stop_id) AS origin_stop_id,
      any_value(a.from_stop_sequence) AS origin_sequence, arg_max(b.to_stop_id, b.place) AS dest_stop_id, arg_max(b.stop_sequence, b.place) AS dest_sequence, any_value(a.dep) AS dep, sum(b.dur)::BIGINT AS dur, sum(b.sdur)::BIGINT AS sdur, sum(b.stop_span)::BIGINT AS stop_span
      FROM numbered a, (SELECT unnest([1, 2, 3, 4]) AS n) l JOIN numbered b ON b.service_date = a.service_date AND b.trip_id = a.trip_id AND b.trip_run = a.trip_run AND b.block_no = a.block_no AND b.place >= a.place AND b.place < a.place + n
      GROUP BY a.service_date, a.trip_id, a.trip_run, a.block_no, a.place, n HAVING count(*) = n""",
    "edge": "SELECT quantile_cont(dep * 1000000.0, 0.8) AS edge FROM feat",
    "split": "SELECT f.*, CASE WHEN dep * 1000000.0 >= edge THEN 'validation' WHEN dep * 1000000.0 < edge - 86400 * 1000000.0 THEN 'train' ELSE 'embargo' END AS split FROM feat f, edge",
    "jedge": "SELECT quantile_cont(s, 0.8) AS edge FROM (SELECT min(dep) * 1000000.0 AS s FROM journ GROUP BY service_date, trip_id, trip_run, block_no)",
    "jsplit0": "SELECT *, min(dep) OVER (PARTITION BY service_date, trip_id, trip_run, block_no) * 1000000.0 AS bs FROM journ",
    "jsplit": "SELECT j.*, CASE WHEN bs >= edge THEN 'validation' WHEN bs < edge - 86400 * 1000000.0 THEN 'train' ELSE 'embargo' END AS split FROM jsplit0 j, jedge",
    "medh": "SELECT from_stop_id, to_stop_id, local_hour, quantile_cont(dur, 0.5) AS m FROM split WHERE split = 'train' GROUP BY ALL",
    "meds": "SELECT from_stop_id, to_stop_id, quantile_cont(dur, 0.5) AS m FROM split WHERE split = 'train' GROUP BY ALL",
    "meda": "SELECT quantile_cont(dur, 0.5) AS m FROM split WHERE split = 'train'",
    "scored": """SELECT v.*, coalesce(medh.m, meds.m, meda.m) AS pred FROM split v LEFT JOIN medh ON v.from_stop_id = medh.from_stop_id AND v.to_stop_id = medh.to_stop_id AND v.local_hour = medh.local_hour
      LEFT JOIN meds ON v.from_stop_id = meds.from_stop_id AND v.to_stop_id = meds.to_stop_id, meda WHERE split = 'validation'""",
    "sbrk": """SELECT *, CASE WHEN lag(stop_sequence) OVER w IS NOT NULL AND NOT (abs(dep - (lag(dep) OVER w + lag(dur) OVER w)) <= 1 AND from_stop_sequence = lag(stop_sequence) OVER w) THEN 1 ELSE 0 END AS brk
      FROM scored WINDOW w AS (PARTITION BY service_date, trip_id, trip_run ORDER BY from_stop_sequence, stop_sequence)""",
    "sblocks": "SELECT * EXCLUDE (brk), (sum(brk) OVER (PARTITION BY service_date, trip_id, trip_run ORDER BY from_stop_sequence, stop_sequence ROWS UNBOUNDED PRECEDING))::INT AS block_no FROM sbrk",
    "snum": "SELECT *, row_number() OVER (PARTITION BY service_date, trip_id, trip_run, block_no ORDER BY from_stop_sequence, stop_sequence) AS place FROM sblocks",
    "ssum": """SELECT a.service_date, a.trip_id, a.trip_run, any_value(a.from_stop_id) AS origin, n::INT AS n_segments, sum(b.dur)::BIGINT AS dur, sum(b.sdur)::BIGINT AS sdur, sum(b.pred) AS pred
      FROM snum a, (SELECT unnest([1, 2, 3, 4]) AS n) l JOIN snum b ON b.service_date = a.service_date AND b.trip_id = a.trip_id AND b.trip_run = a.trip_run AND b.block_no = a.block_no AND b.place >= a.place AND b.place < a.place + n
      GROUP BY a.service_date, a.trip_id, a.trip_run, a.block_no, a.place, n HAVING count(*) = n""",
    "vblk": "SELECT DISTINCT service_date, trip_id, trip_run, block_no FROM jsplit WHERE split = 'validation'",
    "tside": "SELECT * FROM blocks ANTI JOIN vblk USING (service_date, trip_id, trip_run, block_no)",
    "hmh": "SELECT from_stop_id, to_stop_id, local_hour, quantile_cont(dur, 0.5) AS m FROM tside GROUP BY ALL",
    "hms": "SELECT from_stop_id, to_stop_id, quantile_cont(dur, 0.5) AS m FROM tside GROUP BY ALL",
    "hma": "SELECT quantile_cont(dur, 0.5) AS m FROM tside",
    "hscored": """SELECT v.*, coalesce(hmh.m, hms.m, hma.m) AS pred FROM (SELECT * FROM numbered SEMI JOIN vblk USING (service_date, trip_id, trip_run, block_no)) v
      LEFT JOIN hmh ON v.from_stop_id = hmh.from_stop_id AND v.to_stop_id = hmh.to_stop_id AND v.local_hour = hmh.local_hour LEFT JOIN hms ON v.from_stop_id = hms.from_stop_id AND v.to_stop_id = hms.to_stop_id, hma""",
    "hsum": """SELECT a.service_date, a.trip_id, a.trip_run, any_value(a.from_stop_id) AS origin, n::INT AS n_segments, sum(b.dur)::BIGINT AS dur, sum(b.sdur)::BIGINT AS sdur, sum(b.pred) AS pred
      FROM hscored a, (SELECT unnest([1, 2, 3, 4]) AS n) l JOIN hscored b ON b.service_date = a.service_date AND b.trip_id = a.trip_id AND b.trip_run = a.trip_run AND b.block_no = a.block_no AND b.place >= a.place AND b.place < a.place + n
      GROUP BY a.service_date, a.trip_id, a.trip_run, a.block_no, a.place, n HAVING count(*) = n""",
    "stops": """SELECT DISTINCT 'STN_' || code AS stop_id, name AS stop_name, '' AS parent_station FROM plat0 UNION ALL SELECT 'PF_' || code || '_' || s_suppkey, 'Platform', 'STN_' || code FROM plat0""",
    "plat0": """SELECT chr((65 + n_nationkey % 8)::INT) || lpad(n_nationkey::VARCHAR, 2, '0') AS code, s_suppkey, CASE WHEN n_nationkey % 5 = 0 THEN r_name ELSE n_name END AS name
      FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "stcodes": "SELECT code, any_value(name) AS name, list_sort(list('PF_' || code || '_' || s_suppkey)) AS platforms FROM plat0 GROUP BY code",
    "rt": "SELECT captured_at, trip_id || '_20660' AS trip_id, trip_id AS base, CASE WHEN user_id % 17 = 0 THEN 'NR' ELSE route_id END AS route_id, stop_id FROM tu",
    "bund": """SELECT strftime(s, '%Y-%m-%d') AS feed_start, CASE WHEN quarter(s) % 4 = 1 THEN 'unknown' ELSE strftime(s + INTERVAL 100 DAY, '%Y-%m-%d') END AS feed_end, (datediff('day', DATE '1970-01-01', s::DATE) % 1000)::VARCHAR AS version
      FROM (SELECT DISTINCT date_trunc('quarter', o_orderdate) AS s FROM orders)""",
    "odp": """SELECT a.stop_id AS origin, b.stop_id AS destination, ((a.off // 3600) % 24)::INT AS hour, b.off - a.off AS sec, (b.seq - a.seq)::INT AS legs, a.route_id, a.direction_id, 'PF_A0' || (a.seq + 1) || '_C' AS leg
      FROM sched a JOIN sched b ON a.trip_id = b.trip_id AND a.seq < b.seq""",
}
_NEEDS = {name: [other for other in PARTS if other != name and re.search(rf"\b{other}\b", body)] for name, body in PARTS.items()}


def sql(select: str, *parts: str) -> str:
    """select with the parts it needs before it, each after those it needs itself."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS[name]:
            if other not in order:
                add(other)
        if name not in order:
            order.append(name)

    for name in parts:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in order) + "\n" + select if order else select
