"""DuckDB SQL for the queries, written from the operators' definitions and independent of
the Spark plans: row-level windows, plain range joins and recursion instead of distinct
seconds, buckets and folds."""

from __future__ import annotations

from footfall.plans.queries import APPEND, DAY, FIRST, FLAG, GAP, LAST, MAX_SCANS, RUN

BASE = 1704067200


def _devid(n: str) -> str:
    return f"lpad((({n}) % 7)::VARCHAR, 4, '0') || lpad(({n})::VARCHAR, 8, '0')"


def _day(t: str) -> str:
    return f"(DATE '2024-01-01' + ((({t}) - {BASE}) // 86400)::INTEGER)"


MAC = ("CASE WHEN user_id % 2 = 0 THEN 'ab' ELSE 'AB' END "
       "|| lpad((user_id % 16)::VARCHAR, 4, '0') || lpad(user_id::VARCHAR, 6, '0')")

# --- the adapters as SQL: name -> (names it needs, body) ------------------------------------

VIEWS: dict[str, tuple[list[str], str]] = {}

VIEWS["moments"] = ([], f"""
SELECT event_id, user_id, event_type, value,
       {BASE} + (epoch_us(ts) // 1000000 - {BASE}) // 5 AS t,
       (user_id * 2) // 3 + event_id % 3 AS n
FROM events""")

VIEWS["visits"] = (["moments"], f"""
SELECT m.*, m.t + j * 50 AS scan_time,
       ((m.t + j * 50) // 43200) % 2 AS half, ((m.t + j * 50) // 60) % 6 AS slot
FROM moments m, unnest(range(0, m.event_id % 4 + 1)) AS u(j)""")

VIEWS["view_info"] = (["visits"], f"""
SELECT {_day('scan_time')} AS time, {_devid('n')} AS devid, 'ic' || n AS iccid,
       'sn' || n || '_' || CASE WHEN event_id % 5 = 0 THEN 'b' ELSE 'a' END AS inner_sn,
       {MAC} AS mac,
       'pl' || ((n // 3) * 60 + n % 5 + half * 5 + slot * 10) % 97 AS plninfo,
       (CASE WHEN event_id % 50 = 1 THEN 0 ELSE 100 + n // 3 END)::INTEGER AS sch_version,
       (CASE WHEN event_id % 10 = 0 THEN 0 ELSE 1 + half END)::INTEGER AS uploadcount,
       (1 + slot % 3)::INTEGER AS pls_index, (1 + slot // 3)::INTEGER AS play_index,
       scan_time, floor(value)::INTEGER AS signal,
       CASE WHEN event_type = 'error' THEN '1' ELSE '0' END AS is_ap,
       'c' || (n % 5) AS citycode,
       CASE WHEN n % 10 <> 9 THEN r_name END AS city_name,
       CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'view' THEN 'NULL'
            ELSE 'a' || ((n // 3) * 60 + n % 5 + half * 5 + slot * 10) % 97 END AS ad_content_id
FROM visits LEFT JOIN region ON r_regionkey = n % 5""")

VIEWS["location"] = ([], f"""
SELECT DATE '2024-01-01' + (snap - 1)::INTEGER AS time, {_devid('s_suppkey')} AS devid,
       'b' || (s_suppkey % 37) AS building_no,
       n_name || '-' || (s_suppkey % 4 + k) AS building_name,
       CASE WHEN s_suppkey % 10 = 3 THEN '北京索迪' WHEN r_name = 'ASIA' THEN '北京' ELSE r_name END AS city_name,
       'd' || (s_suppkey % 3) AS district_name,
       CASE WHEN s_suppkey % 6 = 5 THEN '' ELSE 'kit' || (s_suppkey % 6) END AS suit_kind,
       n_name AS install_name,
       CASE WHEN s_suppkey % 10 = 9 OR (s_suppkey % 7 = 2 AND k = 2) THEN '已拆除' ELSE '已安装' END AS install_status,
       CASE WHEN s_suppkey % 4 = 0 THEN '[智能]' WHEN s_suppkey % 2 = 0 THEN '[智能互动]22' ELSE '[互动]19' END AS device_style,
       CASE WHEN s_suppkey % 8 = 7 THEN '海报' ELSE '液晶' END AS devicekind,
       {BASE} - 86400 * (30 - k) AS update_time
FROM supplier JOIN region ON r_regionkey = s_suppkey % 5 JOIN nation ON n_nationkey = s_nationkey,
     unnest(range(0, s_suppkey % 3 + 1)) AS u(k), unnest([5, 6]) AS v(snap)""")

VIEWS["newest"] = (["location"], "SELECT * FROM location WHERE time = (SELECT max(time) FROM location)")

VIEWS["mac_factory"] = ([], """
SELECT 'ab' || lpad((s_suppkey % 16)::VARCHAR, 4, '0') AS mac_index_factory,
       CASE WHEN s_suppkey % 16 < 10 AND (s_suppkey // 16) % 3 <> 1 THEN s_name END AS factory_name
FROM supplier""")

VIEWS["known"] = (["mac_factory"],
    "SELECT DISTINCT mac_index_factory AS prefix FROM mac_factory WHERE factory_name IS NOT NULL")

VIEWS["genuine"] = (["view_info", "known"],
    "SELECT * FROM view_info WHERE lower(substr(mac, 1, 6)) IN (SELECT prefix FROM known)")

VIEWS["schedule_raw"] = ([], """
SELECT DATE '2024-01-01' + d::INTEGER AS buildinglistdate, (100 + p_partkey // 60)::INTEGER AS buildinglist,
       'c' || (p_partkey % 60 % 5) AS citycode,
       (1 + (p_partkey % 60 // 5) % 2)::INTEGER AS uploadcount,
       (1 + (p_partkey % 60 // 10) % 3)::INTEGER AS nplseqno,
       (1 + p_partkey % 60 // 30)::INTEGER AS nplinnerseqno,
       'pl' || (p_partkey % 97) AS plnid, 'ad' || (p_partkey % 97) || '.avi' AS adcontent,
       'cust' || (p_partkey % 97 % 20) AS adcustomer, 'prod' || (p_partkey % 97 % 33) AS adproduct,
       (30 * (1 + p_size % 3))::VARCHAR AS adlength
FROM part, unnest(range(0, 7 - p_partkey % 4)) AS u(d), unnest(range(0, p_size % 2 + 1)) AS v(k)""")

VIEWS["schedule"] = (["schedule_raw"], """
SELECT DISTINCT buildinglist, buildinglistdate, citycode, plnid, adcontent, nplseqno, nplinnerseqno,
       uploadcount, adlength FROM schedule_raw""")

VIEWS["day_schedule"] = (["schedule"],
    f"SELECT * FROM schedule WHERE buildinglistdate = DATE '{DAY}'")

VIEWS["building_list"] = ([], """
SELECT (100 + l_partkey // 60)::INTEGER AS buildinglist,
       'c' || (CASE WHEN l_partkey % 60 % 5 = 4 THEN 9 ELSE l_partkey % 60 % 5 END) AS citycode,
       l_returnflag AS packagecode, (1 + (l_partkey % 60 // 5) % 2)::INTEGER AS uploadcount,
       CASE WHEN l_linenumber <> 7 THEN floor(l_quantity)::INTEGER END AS sumadlength,
       (l_linenumber * 10)::INTEGER AS basefrequency
FROM lineitem""")

VIEWS["frequency"] = (["building_list"], """
SELECT DISTINCT citycode, buildinglist, uploadcount, basefrequency FROM building_list b
WHERE sumadlength = (SELECT max(sumadlength) FROM building_list m WHERE m.citycode = b.citycode
                     AND m.buildinglist = b.buildinglist AND m.uploadcount = b.uploadcount)""")

VIEWS["package_frequency"] = (["building_list"], """
SELECT citycode, buildinglist, uploadcount, basefrequency FROM (
SELECT DISTINCT citycode, buildinglist, uploadcount, packagecode, basefrequency FROM building_list b
WHERE sumadlength = (SELECT max(sumadlength) FROM building_list m WHERE m.citycode = b.citycode
                     AND m.buildinglist = b.buildinglist AND m.uploadcount = b.uploadcount
                     AND m.packagecode = b.packagecode))""")

VIEWS["ad_info"] = ([], """
SELECT DISTINCT 'a' || (p_partkey % 97) AS adcontent_id,
       CASE WHEN p_partkey % 97 <= 90 THEN 'ad' || (p_partkey % 97) || '.avi' ELSE '' END AS adcontent
FROM part""")

VIEWS["ad_ids"] = ([], """
SELECT DISTINCT CASE WHEN p_partkey % 97 <= 90 THEN 'ad' ELSE 'old' END || (p_partkey % 97) || '.wmv' AS adcontent,
       'a' || (p_partkey % 97) AS adid
FROM part""")

VIEWS["play_log"] = ([], f"""
SELECT {_day(f'{BASE} + spot')} AS time, {_devid('n')} AS devid, 'ic' || n AS iccid,
       'sn' || n || '_a' AS inner_sn, CASE WHEN ln % 2 = 0 THEN 'm' ELSE 's' END AS master,
       'pl' || (part % 97) AS pid, ({BASE} + spot) * 1000 + o % 1000 AS start_ms,
       ({BASE} + spot) * 1000 + o % 1000 + ln * 60000 + 60000 AS end_ms,
       CASE WHEN ln = 7 THEN '0' ELSE (100000 + n // 3)::VARCHAR || lpad((1 + half)::VARCHAR, 2, '0') END AS sv,
       (1 + slot % 3)::INTEGER AS pi, (1 + slot // 3)::INTEGER AS idx,
       'ad' || (part % 97) || '.mp4' AS vfn, (100 + n // 3)::INTEGER AS sch_version,
       (1 + half)::INTEGER AS uploadcount, (1 + slot % 3)::INTEGER AS pls_index,
       (1 + slot // 3)::INTEGER AS play_index, 'pl' || (part % 97) AS plninfo, 'c' || (n % 5) AS citycode
FROM (SELECT *, (n // 3) * 60 + n % 5 + half * 5 + slot * 10 AS part
      FROM (SELECT *, (spot // 43200) % 2 AS half, p % 6 AS slot
            FROM (SELECT l_suppkey AS n, l_orderkey AS o, l_partkey AS p, l_linenumber::BIGINT AS ln,
                         (l_orderkey * 7919 + l_partkey * 104729 + l_linenumber::BIGINT * 15485863) % 518400 AS spot
                  FROM lineitem)))""")

VIEWS["slot_schedule"] = ([], """
SELECT (100000 + p_partkey // 60)::VARCHAR AS building_list, (1 + (p_partkey % 60 // 10) % 3)::INTEGER AS npl_seqno,
       (1 + p_partkey % 60 // 30)::INTEGER AS npl_playindex, 'pl' || (p_partkey % 97) AS pln_id,
       CASE WHEN p_partkey % 13 <> 0 THEN 'a' || (p_partkey % 97) END AS ad_content_id,
       (30 * (1 + p_size % 3))::INTEGER AS ad_length,
       DATE '2024-01-01' + (p_partkey % 5 - 2)::INTEGER AS start_time,
       DATE '2024-01-01' + (2 + p_partkey % 6)::INTEGER AS end_time,
       CASE WHEN p_partkey % 9 = 0 THEN '1' ELSE '0' END AS daybefore,
       CASE WHEN p_partkey % 4 = 0 THEN '1' ELSE '2' END AS screen, 'c' || (p_partkey % 60 % 5) AS city
FROM part""")

VIEWS["valid"] = (["slot_schedule"], f"""
SELECT * FROM slot_schedule WHERE start_time <= DATE '{DAY}' AND end_time >= DATE '{DAY}'""")

VIEWS["slot_ads"] = (["valid"], """
SELECT * FROM (
SELECT city, building_list AS sch_version, npl_seqno AS pls_index, npl_playindex AS play_index,
       pln_id AS plninfo, max(ad_content_id) AS ad_content_id, max(ad_length) AS ad_length
FROM valid WHERE daybefore = '0' AND screen = '2' GROUP BY ALL) WHERE ad_content_id IS NOT NULL""")

VIEWS["videos"] = ([], """
SELECT DISTINCT 'a' || (p_partkey % 97) AS ad_content_id, 'ad' || (p_partkey % 97) || '.avi' AS adcontent,
       p_brand AS adcustomer, p_type AS adproduct FROM part""")

VIEWS["face_log"] = (["moments"], f"""
SELECT {_day('t')} AS time, event_id AS logid, {_devid('n')} AS devid, t AS starttime
FROM moments WHERE event_type = 'purchase'""")

VIEWS["probes"] = (["moments"], f"""
SELECT event_id AS probe_id, {_devid('n')} AS devid, t + 7 AS at FROM moments WHERE event_type = 'signup'""")

VIEWS["control"] = (["newest"], """
SELECT DISTINCT building_name, devid, time - b::INTEGER AS time
FROM (SELECT building_name, devid, time FROM location WHERE install_status = '已安装'),
     unnest(range(0, 3)) AS u(b)""")

VIEWS["panel"] = (["moments"], f"""
SELECT DISTINCT lower({MAC}) AS mac, user_id::VARCHAR AS id, substr({_devid('n')}, 1, 4) AS city
FROM moments WHERE event_type = 'view'""")

VIEWS["pairs"] = (["moments"], f"""
SELECT DISTINCT {_devid('n')} AS devid, lower({MAC}) AS mac
FROM moments WHERE event_type IN ('click', 'view')""")

VIEWS["building_type"] = ([], """
SELECT CASE WHEN r_name = 'ASIA' THEN '北京' ELSE r_name END AS city,
       CASE n_nationkey % 3 WHEN 0 THEN '办公楼' WHEN 1 THEN '公寓楼' ELSE '商场' END AS big_category,
       n_name AS installed
FROM nation JOIN region ON n_regionkey = r_regionkey""")

VIEWS["device_city"] = (["newest"], """
SELECT devid, CASE WHEN max(city_name) = '北京索迪' THEN '北京' ELSE max(city_name) END AS city_name,
       max(building_name) AS building_name
FROM newest WHERE install_status <> '已拆除' GROUP BY devid""")

VIEWS["touch_city"] = (["newest"], """
SELECT devid, CASE WHEN max(city_name) = '北京索迪' THEN '北京' ELSE max(city_name) END AS city_name,
       max(building_name) AS building_name
FROM newest WHERE install_status <> '已拆除' AND substr(device_style, 1, 6) = '[智能互动]' GROUP BY devid""")

VIEWS["latest"] = (["newest"], """
SELECT DISTINCT l.* FROM newest l
JOIN (SELECT devid, max(update_time) AS update_time FROM newest GROUP BY devid) m
  ON l.devid = m.devid AND l.update_time = m.update_time
WHERE l.install_status = '已安装'""")

VIEWS["building_scans"] = (["view_info", "latest"], """
SELECT v.time, v.devid, v.mac, v.scan_time, l.city_name, l.building_name
FROM view_info v JOIN (SELECT DISTINCT devid, building_name, city_name FROM latest) l ON v.devid = l.devid""")

VIEWS["kept_building_scans"] = (["building_scans"], """
SELECT * FROM building_scans b WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT time, city_name, building_name, mac FROM building_scans GROUP BY ALL HAVING count(*) > 20) h
  WHERE h.time = b.time AND h.city_name = b.city_name AND h.building_name = b.building_name AND h.mac = b.mac)""")

VIEWS["roaming"] = (["view_info"], """
SELECT DISTINCT mac FROM (
  SELECT time, mac FROM (
    SELECT time, devid, mac, count(scan_time) AS ct, count(DISTINCT (scan_time % 86400) // 3600) AS hours
    FROM view_info GROUP BY ALL) GROUP BY time, mac HAVING sum(ct) > 45 OR max(hours) > 6)""")

VIEWS["clipped"] = (["view_info"], f"""
SELECT * FROM view_info WHERE {_day('scan_time')} = time AND sch_version <> 0 AND is_ap = '0'""")


def _main_sn(source: str) -> str:
    return f"""
SELECT s.* FROM {source} s JOIN (
  SELECT time, devid, inner_sn, row_number() OVER (PARTITION BY time, devid ORDER BY count(*) DESC, inner_sn) AS rn
  FROM {source} GROUP BY time, devid, inner_sn) w
ON s.time = w.time AND s.devid = w.devid AND s.inner_sn = w.inner_sn AND rn = 1"""


VIEWS["main_sn"] = (["genuine"], _main_sn("genuine"))
VIEWS["all_main_sn"] = (["view_info"], _main_sn("view_info"))


def _light(source: str, limit: int = MAX_SCANS) -> str:
    return f"""
SELECT * FROM {source} s WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT time, devid, mac FROM {source} GROUP BY ALL HAVING count(*) > {limit}) h
  WHERE h.time = s.time AND h.devid = s.devid AND h.mac = s.mac)"""


VIEWS["light_scans"] = (["view_info"], _light("view_info"))
VIEWS["visitors"] = (["main_sn"], _light("main_sn"))

VIEWS["panel_scans"] = (["clipped", "panel", "pairs", "play_log"], """
SELECT c.*, p.id FROM clipped c JOIN panel p ON lower(c.mac) = p.mac AND substr(c.devid, 1, 4) = p.city
JOIN pairs q ON q.devid = c.devid AND q.mac = lower(c.mac)
WHERE c.devid IN (SELECT devid FROM play_log)""")

VIEWS["lengths"] = (["schedule_raw"], """
SELECT adcontent, adcustomer, adproduct, max(adlength::INTEGER) AS ad_length FROM schedule_raw GROUP BY ALL""")

VIEWS["lcd_latest"] = (["newest"], """
SELECT DISTINCT l.devid, suit_kind, city_name, building_no, building_name
FROM (SELECT * FROM newest WHERE install_status = '已安装' AND devicekind = '液晶' AND suit_kind <> '') l
JOIN (SELECT devid, max(update_time) AS update_time FROM newest
      WHERE install_status = '已安装' AND devicekind = '液晶' AND suit_kind <> '' GROUP BY devid) m
  ON l.devid = m.devid AND l.update_time = m.update_time""")

VIEWS["enriched"] = (["play_log", "lcd_latest", "lengths", "ad_ids"], """
SELECT DISTINCT p.time, p.devid, p.start_ms, p.end_ms, p.sch_version, p.uploadcount, p.pls_index, p.play_index,
       p.plninfo, p.iccid, p.inner_sn, p.vfn AS adcontent, i.adid AS ad_content_id,
       d.suit_kind, l.ad_length, l.adproduct, l.adcustomer, d.city_name, d.building_no, d.building_name
FROM play_log p JOIN lcd_latest d ON p.devid = d.devid
JOIN lengths l ON left(p.vfn, length(p.vfn) - 4) = left(l.adcontent, length(l.adcontent) - 4)
JOIN ad_ids i ON left(p.vfn, length(p.vfn) - 4) = left(i.adcontent, length(i.adcontent) - 4)
WHERE p.vfn <> ''""")

VIEWS["busy"] = (["panel_scans", "enriched"], """
SELECT * FROM panel_scans s WHERE (
  SELECT count(*) FROM enriched e WHERE e.devid = s.devid AND e.time BETWEEN s.time AND s.time + 1) > 100""")

VIEWS["panel_visitors"] = (["busy"], _light("busy"))


def _windows(source: str) -> str:
    return f"""
SELECT *, nxt IS NULL OR nxt - scan_time > {FLAG} AS closed,
       CASE WHEN nxt IS NULL THEN scan_time + {APPEND}
            WHEN nxt - scan_time > {FLAG} THEN least(scan_time + {APPEND}, nxt) ELSE nxt END AS until
FROM (SELECT *, lead(scan_time) OVER (PARTITION BY time, devid, mac
        ORDER BY scan_time, sch_version, uploadcount, pls_index, play_index, plninfo) AS nxt FROM {source})"""


VIEWS["windows"] = (["visitors"], _windows("visitors"))
VIEWS["panel_windows"] = (["panel_visitors"], _windows("panel_visitors"))

def _filled(windows: str, plays: str) -> str:
    return f"""
SELECT time, devid, mac, sch_version, uploadcount, pls_index, play_index, plninfo, scan_time,
       0::BIGINT AS time_diff, 0 AS inserted, scan_time AS anchor, NULL::BIGINT AS p_start, NULL::BIGINT AS p_end
FROM {windows}
UNION ALL
SELECT w.time, w.devid, w.mac, p.sch_version, p.uploadcount, p.pls_index, p.play_index,
       p.plninfo, p.start_ms // 1000, CASE WHEN closed THEN p.start_ms - w.scan_time * 1000 ELSE 0 END,
       1, w.scan_time, p.start_ms, p.end_ms
FROM {windows} w JOIN {plays} p ON p.time = w.time AND p.devid = w.devid
 AND p.start_ms >= w.scan_time * 1000 AND p.start_ms < w.until * 1000
WHERE closed OR p.end_ms <= w.until * 1000"""


VIEWS["filled"] = (["windows", "play_log"], _filled("windows", "play_log"))

ROW_ORDER = "anchor, inserted, p_start, p_end, sch_version, uploadcount, pls_index, play_index, plninfo"
SLOT4 = "sch_version, uploadcount, pls_index, play_index"


def _attributed(source: str, next_day: bool = True) -> str:
    days = "p.time BETWEEN m.time AND m.time + 1" if next_day else "p.time = m.time"
    return f"""
SELECT s.* EXCLUDE (ad_content_id), b.adcontent, b.ad_content_id, b.suit_kind, b.ad_length, b.adproduct, b.adcustomer,
       b.city_name AS ad_city, b.building_no, b.building_name
FROM {source} s LEFT JOIN (
  SELECT m.time AS m_time, m.devid AS m_devid, m.scan_time AS m_t, p.*,
         row_number() OVER (PARTITION BY m.time, m.devid, m.scan_time
           ORDER BY p.start_ms DESC, p.end_ms, p.sch_version, p.uploadcount, p.pls_index, p.play_index,
                    p.plninfo, p.adcontent, p.ad_content_id) AS rn
  FROM (SELECT DISTINCT time, devid, scan_time FROM {source}) m
  JOIN enriched p ON p.devid = m.devid AND m.scan_time * 1000 BETWEEN p.start_ms AND p.end_ms AND {days}) b
ON b.m_time = s.time AND b.m_devid = s.devid AND b.m_t = s.scan_time AND rn = 1"""


VIEWS["attributed"] = (["view_info", "enriched"], _attributed("view_info"))
VIEWS["attributed_day"] = (["view_info", "enriched"], _attributed("view_info", False))
VIEWS["panel_attributed"] = (["panel_windows", "enriched"], _attributed("panel_windows"))

VIEWS["log_filled"] = (["panel_attributed", "enriched"], """
SELECT id, time, devid, mac, sch_version, uploadcount, pls_index, play_index, plninfo, scan_time,
       0::BIGINT AS time_diff, 0 AS inserted, adcontent, ad_content_id, ad_length,
       scan_time AS anchor, NULL::BIGINT AS p_start, NULL::BIGINT AS p_end
FROM panel_attributed
UNION ALL
SELECT w.id, w.time, w.devid, w.mac, p.sch_version, p.uploadcount, p.pls_index, p.play_index, p.plninfo,
       (p.start_ms + 1000) // 1000, CASE WHEN closed THEN p.start_ms - w.scan_time * 1000 ELSE 0 END, 1,
       p.adcontent, p.ad_content_id, p.ad_length, w.scan_time, p.start_ms, p.end_ms
FROM panel_attributed w JOIN enriched p ON p.devid = w.devid AND p.time BETWEEN w.time AND w.time + 1
 AND p.start_ms > w.scan_time * 1000 AND p.start_ms < w.until * 1000""")

VIEWS["cycle"] = (["schedule_raw"], """
SELECT *, row_number() OVER w - 1 AS slot_pos, count(*) OVER l AS n_slots,
       coalesce(sum(ad_ms) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lap_from,
       (sum(ad_ms) OVER l)::BIGINT AS lap_ms,
       coalesce(lead(pls_index) OVER w, first(pls_index) OVER w) AS next_pls_index,
       coalesce(lead(play_index) OVER w, first(play_index) OVER w) AS next_play_index,
       coalesce(lead(plninfo) OVER w, first(plninfo) OVER w) AS next_plninfo,
       coalesce(lag(pls_index) OVER w, first(pls_index) OVER d) AS prev_pls_index,
       coalesce(lag(play_index) OVER w, first(play_index) OVER d) AS prev_play_index,
       coalesce(lag(plninfo) OVER w, first(plninfo) OVER d) AS prev_plninfo
FROM (SELECT buildinglistdate AS time, citycode, buildinglist AS sch_version, uploadcount,
             nplseqno AS pls_index, nplinnerseqno AS play_index, plnid AS plninfo,
             max(adlength::BIGINT) * 1000 AS ad_ms
      FROM schedule_raw GROUP BY ALL)
WINDOW w AS (PARTITION BY time, citycode, sch_version, uploadcount ORDER BY pls_index, play_index, plninfo),
       d AS (PARTITION BY time, citycode, sch_version, uploadcount ORDER BY pls_index DESC, play_index DESC, plninfo DESC),
       l AS (PARTITION BY time, citycode, sch_version, uploadcount)""")

VIEWS["sessions"] = (["main_sn", "cycle"], """
SELECT time, devid, citycode, sch_version, uploadcount, pls_index, play_index, plninfo, ad_ms, lap_ms, lap_from,
       slot_pos, n_slots, ord, min(scan_time) * 1000 AS start_ms,
       CASE WHEN count(*) = 1 THEN min(scan_time) * 1000 + 1 ELSE max(scan_time) * 1000 END AS end_ms,
       CASE WHEN count(*) = 1 THEN 1 ELSE (max(scan_time) - min(scan_time)) * 1000 END >= ad_ms AS is_seed
FROM (SELECT *, sum(CASE WHEN pt IS NULL OR ps <> slot OR (scan_time - pt) * 1000 > ad_ms THEN 1 ELSE 0 END)
                OVER (PARTITION BY time, devid ORDER BY scan_time, slot ROWS UNBOUNDED PRECEDING) AS ord
      FROM (SELECT *, lag(scan_time) OVER w AS pt, lag(slot) OVER w AS ps
            FROM (SELECT s.time, s.devid, s.city AS citycode, s.sch_version, s.uploadcount, s.pls_index,
                         s.play_index, s.plninfo, s.scan_time, c.ad_ms, c.lap_ms, c.lap_from,
                         c.slot_pos, c.n_slots,
                         (s.sch_version, s.uploadcount, s.pls_index, s.play_index, s.plninfo) AS slot
                  FROM (SELECT *, first(citycode) OVER (PARTITION BY time, devid ORDER BY scan_time, sch_version,
                                 uploadcount, pls_index, play_index, plninfo) AS city FROM main_sn) s
                  JOIN cycle c ON c.time = s.time AND c.citycode = s.city AND c.sch_version = s.sch_version
                   AND c.uploadcount = s.uploadcount AND c.pls_index = s.pls_index
                   AND c.play_index = s.play_index AND c.plninfo = s.plninfo)
            WINDOW w AS (PARTITION BY time, devid ORDER BY scan_time, slot)))
GROUP BY time, devid, citycode, sch_version, uploadcount, pls_index, play_index, plninfo, ad_ms, lap_ms, lap_from,
         slot_pos, n_slots, ord""")

# Step by step, one inserted play at a time.
def _gaps(sessions: str) -> str:
    return f"""
SELECT *, CASE
    WHEN nxt IS NULL THEN least(end_ms + 36000000, midnight)
    WHEN NOT is_seed THEN NULL
    WHEN nv <> sch_version OR nb <> uploadcount THEN least(end_ms + 36000000, nxt)
    WHEN nxt - end_ms < 36000000 THEN (nxt // 1000) * 1000 + 999 END AS fill_to
FROM (SELECT *, lead(start_ms) OVER w AS nxt, lead(sch_version) OVER w AS nv, lead(uploadcount) OVER w AS nb,
             ord = min(ord) OVER (PARTITION BY time, devid) AS is_first,
             (epoch(time)::BIGINT + 86400) * 1000 AS midnight, (epoch(time)::BIGINT + 21600) * 1000 AS six
      FROM {sessions} WINDOW w AS (PARTITION BY time, devid ORDER BY ord))"""


VIEWS["gaps"] = (["sessions"], _gaps("sessions"))


def _step(forward: bool, name: str = "stepped", gaps: str = "gaps") -> str:
    ends, link, ok = (
        ("s.e AS s, s.e + c.ad_ms AS e", "next", "s.e + c.ad_ms <= s.edge") if forward else
        ("s.s - c.ad_ms AS s, s.s AS e", "prev", "s.s - c.ad_ms >= s.edge"))
    first = (f"end_ms AS s, end_ms AS e, fill_to AS edge FROM {gaps} WHERE fill_to IS NOT NULL" if forward else
             f"start_ms AS s, start_ms AS e, six AS edge FROM {gaps} WHERE is_first")
    return f"""
SELECT time, devid, citycode, sch_version, uploadcount, pls_index, play_index, plninfo, false AS new, {first}
UNION ALL
SELECT s.time, s.devid, s.citycode, s.sch_version, s.uploadcount, c.pls_index, c.play_index, c.plninfo, true,
       {ends}, s.edge
FROM {name} s
JOIN cycle f ON f.time = s.time AND f.citycode = s.citycode AND f.sch_version = s.sch_version
 AND f.uploadcount = s.uploadcount AND f.pls_index = s.pls_index AND f.play_index = s.play_index
 AND f.plninfo = s.plninfo
JOIN cycle c ON c.time = s.time AND c.citycode = s.citycode AND c.sch_version = s.sch_version
 AND c.uploadcount = s.uploadcount AND c.pls_index = f.{link}_pls_index
 AND c.play_index = f.{link}_play_index AND c.plninfo = f.{link}_plninfo
WHERE {ok}"""


def _with(names: list[str], body: str, *more: tuple[str, str]) -> str:
    """The query preceded by the views it needs, each once, dependencies first, and by ``more``
    of its own, which may be recursive."""
    done: list[str] = []

    def add(name: str) -> None:
        if name in done:
            return
        for need in VIEWS[name][0]:
            add(need)
        done.append(name)

    for name in names:
        add(name)
    parts = [f"{name} AS ({VIEWS[name][1]})" for name in done]
    parts += [f"{name} AS ({body_of})" for name, body_of in more]
    head = "WITH RECURSIVE " if more else "WITH "
    return (head + ",\n".join(parts) + "\n" if parts else "") + body


def _exposures(source: str, keys: str, gap: int = GAP, strict: bool = False,
               multi: bool = True, single: bool = True) -> str:
    wide = ">" if strict else ">="
    parts = []
    if multi:
        parts += [f"SELECT {keys}, t AS scan_time FROM b",
                  f"SELECT {keys}, p AS scan_time FROM b WHERE lb IS NULL OR p - lb > {gap}"]
    if single:
        parts += [f"SELECT {keys}, max(t) AS scan_time FROM g GROUP BY {keys} "
                  f"HAVING max(coalesce(t - p, 0)) < {gap}"]
    return f"""(
WITH g AS (SELECT {keys}, scan_time AS t, lag(scan_time) OVER (PARTITION BY {keys} ORDER BY scan_time) AS p
           FROM {source}),
     b AS (SELECT *, lag(t) OVER (PARTITION BY {keys} ORDER BY t) AS lb FROM g WHERE t - p {wide} {gap})
{' UNION ALL '.join(parts)})"""


PAIR = "time, devid, mac"
CITY = "time, city_name, devid, mac"
DATE_TEXT = "CAST(time AS VARCHAR) AS time"

ORACLES: dict[str, str] = {}
O = ORACLES

# --- scans, sources, sinks ----------------------------------------------------------------

O["scan_partition"] = _with(["view_info"], f"""
SELECT {DATE_TEXT}, devid, mac, scan_time, sch_version FROM view_info v WHERE v.time = DATE '{DAY}'""")
O["scan_range"] = _with(["view_info"], f"""
SELECT CAST(time AS VARCHAR) AS time, count(*) AS scans, count(DISTINCT mac) AS macs FROM view_info v
WHERE v.time BETWEEN DATE '{FIRST}' AND DATE '{LAST}' GROUP BY v.time""")
O["scan_day_and_next"] = _with(["clipped", "play_log"], f"""
SELECT devid, plays, scans FROM
 (SELECT devid, count(*) AS plays FROM play_log WHERE time IN (DATE '{DAY}', DATE '{LAST}') GROUP BY devid)
 JOIN (SELECT devid, count(*) AS scans FROM clipped GROUP BY devid) USING (devid)""")
O["latest_snapshot"] = _with(["newest"], f"""
SELECT {DATE_TEXT}, devid, city_name, building_name, install_status, update_time FROM newest""")
O["write_partition_roundtrip"] = _with(["view_info"], f"""
SELECT {DATE_TEXT}, devid, mac, scan_time FROM {_exposures('view_info', PAIR)}""")

O["raw_scans"] = _with(["view_info"], f"""
SELECT {DATE_TEXT}, devid, mac, scan_time, sch_version FROM view_info WHERE is_ap = '0'""")
O["raw_scans_checked"] = _with(["view_info"], f"""
SELECT {DATE_TEXT}, count(*) AS read, count(*) FILTER (is_ap <> '1') AS accepted,
       count(*) FILTER (is_ap = '1') AS unreadable FROM view_info GROUP BY view_info.time""")
O["exposures_bucketed"] = _with(["genuine"], f"""
SELECT {DATE_TEXT}, devid, mac, scan_time FROM {_exposures("genuine", PAIR)}""")
O["raw_plays"] = _with(["play_log"], """
SELECT devid, start_ms, end_ms, TRY_CAST(substr(sv, 1, greatest(length(sv) - 2, 0)) AS INTEGER) AS sch_version,
       TRY_CAST(CASE WHEN length(sv) >= 2 THEN substr(sv, length(sv) - 1, 2) ELSE sv END AS INTEGER) AS uploadcount,
       pi AS pls_index, idx AS play_index, pid AS plninfo FROM play_log""")

# --- cleaning -----------------------------------------------------------------------------

O["spoof_filter"] = _with(["view_info", "known"], """
SELECT devid, mac, scan_time FROM view_info WHERE substr(mac, 1, 6) IN (SELECT prefix FROM known)""")
O["spoof_filter_ci"] = _with(["genuine"], "SELECT devid, mac, scan_time FROM genuine")
O["active_devices"] = _with(["location"], f"""
SELECT {DATE_TEXT}, devid, city_name, update_time FROM location
WHERE install_status = '已安装' AND devicekind = '液晶' AND substr(device_style, 1, 6) = '[智能互动]'
  AND length(devid) = 12 AND city_name IN ('北京', 'AFRICA', 'AMERICA', 'EUROPE', '北京索迪')""")
O["split_version"] = _with(["play_log"], """
SELECT sv, substr(sv, 1, greatest(length(sv) - 2, 0)) AS version,
       TRY_CAST(CASE WHEN length(sv) >= 2 THEN substr(sv, length(sv) - 1, 2) ELSE sv END AS INTEGER) AS batch,
       CASE WHEN length(sv) + 2 >= 7 THEN substr(sv || '00', 1, 6) ELSE sv || '00' END AS short, count(*) AS plays
FROM play_log GROUP BY ALL""")
_BACKFILL = """
SELECT v.*, CASE WHEN sch_version <> 0 AND uploadcount = 0 THEN coalesce(top, uploadcount)
                 ELSE uploadcount END AS batch FROM {src} v
LEFT JOIN (SELECT citycode, buildinglist, {day} max(uploadcount) AS top FROM {sched} GROUP BY ALL) s
ON s.citycode = v.citycode AND s.buildinglist = v.sch_version {on}"""
BACKFILL = _BACKFILL.format(src="{src}", day="", sched="day_schedule", on="")
BACKFILL_DAY = _BACKFILL.format(
    src="{src}", day="buildinglistdate,", sched="schedule", on="AND s.buildinglistdate = v.time")
O["batch_backfill"] = _with(["view_info", "day_schedule"], f"""
SELECT citycode, sch_version, batch AS uploadcount, count(*) AS scans
FROM ({BACKFILL.format(src='view_info')}) GROUP BY ALL""")
O["batch_backfill_by_day"] = _with(["view_info", "schedule"], f"""
SELECT CAST(time AS VARCHAR) AS time, citycode, sch_version, batch AS uploadcount, count(*) AS scans
FROM ({BACKFILL_DAY.format(src='(SELECT time, citycode, sch_version, uploadcount FROM view_info)')}) GROUP BY ALL""")
_RESOLVE = """
SELECT v.*, CASE WHEN v.ad_content_id IS NULL OR v.ad_content_id = 'NULL' THEN by_plan ELSE by_id END AS adcontent
FROM {src} v
LEFT JOIN (SELECT adcontent_id, max(adcontent) AS by_id FROM ad_info WHERE adcontent <> '' GROUP BY ALL) i
  ON i.adcontent_id = v.ad_content_id
LEFT JOIN (SELECT citycode, plnid, {day} max(adcontent) AS by_plan FROM {sched} GROUP BY ALL) s
  ON s.citycode = v.citycode AND s.plnid = v.plninfo {on}"""
RESOLVE = _RESOLVE.format(src="{src}", day="", sched="day_schedule", on="")
RESOLVE_DAY = _RESOLVE.format(
    src="{src}", day="buildinglistdate,", sched="schedule", on="AND s.buildinglistdate = v.time")
O["resolve_ad"] = _with(["view_info", "day_schedule", "ad_info"], f"""
SELECT devid, mac, scan_time, plninfo, ad_content_id, adcontent FROM ({RESOLVE.format(src='view_info')})""")
O["schedule_dedupe"] = _with(["schedule"], """
SELECT buildinglist, CAST(buildinglistdate AS VARCHAR) AS buildinglistdate, citycode, plnid, adcontent,
       nplseqno, nplinnerseqno, uploadcount, adlength FROM schedule""")
O["heavy_dev_mac"] = _with(["light_scans"], f"SELECT {DATE_TEXT}, devid, mac, scan_time FROM light_scans")
O["heavy_building_mac"] = _with(["kept_building_scans"],
    f"SELECT {DATE_TEXT}, city_name, building_name, mac, scan_time FROM kept_building_scans")
O["weekly_mac_filter"] = _with(["roaming"], "SELECT mac FROM roaming")
O["dominant_sn"] = _with(["all_main_sn"], f"SELECT {DATE_TEXT}, devid, inner_sn, mac, scan_time FROM all_main_sn")
O["panel_filter"] = _with(["clipped", "panel", "pairs", "location"], """
SELECT p.id, c.devid, c.mac, c.scan_time FROM clipped c
JOIN panel p ON lower(c.mac) = p.mac AND substr(c.devid, 1, 4) = p.city
JOIN pairs q ON q.devid = c.devid AND q.mac = lower(c.mac)
WHERE c.devid IN (SELECT devid FROM location WHERE install_status = '已安装' AND devicekind = '液晶')""")

# --- joins --------------------------------------------------------------------------------

O["left_join_city"] = _with(["view_info", "device_city"], """
SELECT v.devid, v.mac, v.scan_time, d.city_name, d.building_name
FROM view_info v LEFT JOIN device_city d ON v.devid = d.devid""")
O["latest_location"] = _with(["latest"], "SELECT devid, building_name, city_name, update_time FROM latest")
O["argmax_frequency"] = _with(["frequency"], "SELECT * FROM frequency")
O["argmax_frequency_package"] = _with(["package_frequency"], "SELECT * FROM package_frequency")
O["probe_window"] = _with(["probes", "view_info"], """
SELECT v.devid, v.mac, v.scan_time, p.probe_id, p.at FROM probes p
JOIN view_info v ON v.devid = p.devid AND v.scan_time BETWEEN p.at - 60 AND p.at + 60""")
O["schedule_valid_join"] = _with(["play_log", "slot_ads"], f"""
SELECT p.devid, p.start_ms, a.sch_version, a.pls_index, a.play_index, a.plninfo, a.ad_content_id, a.ad_length
FROM play_log p JOIN slot_ads a ON substr(p.sv, 1, greatest(length(p.sv) - 2, 0)) = a.sch_version
 AND p.pi = a.pls_index AND p.idx = a.play_index AND p.pid = a.plninfo
WHERE p.time = DATE '{DAY}'""")

# --- city, device and building figures ----------------------------------------------------

O["city_play_totals"] = _with(["play_log", "device_city"], """
SELECT city_name, count(*) AS playtimes, count(DISTINCT p.devid) AS devnums,
       sum(end_ms // 1000 - start_ms // 1000)::BIGINT AS allplay_length_real
FROM play_log p JOIN device_city d ON p.devid = d.devid WHERE city_name IS NOT NULL GROUP BY city_name""")
O["city_play_report"] = O["city_play_totals"]
O["realtime_play_totals"] = _with(["play_log", "device_city"], f"""
SELECT city_name, count(*) AS playtimes, count(DISTINCT p.devid) AS devnums,
       sum(end_ms // 1000 - start_ms // 1000)::BIGINT AS allplay_length_real
FROM play_log p JOIN device_city d ON p.devid = d.devid
WHERE city_name IS NOT NULL AND p.start_ms >= epoch(DATE '{DAY}')::BIGINT * 1000
  AND p.start_ms < (epoch(DATE '{DAY}')::BIGINT + 15 * 3600) * 1000
GROUP BY city_name""")
O["city_scan_totals"] = _with(["view_info", "device_city"], """
SELECT d.city_name, count(*) AS maccount, count(DISTINCT mac) AS single_maccount
FROM view_info v LEFT JOIN device_city d ON v.devid = d.devid GROUP BY d.city_name""")
CITY_DISTINCT = """
SELECT s.city_name, count(DISTINCT s.mac) AS personnums, count(DISTINCT s.building_name) AS buildnums,
       count(DISTINCT s.devid) AS devnums, count(DISTINCT n.adcustomer) AS customernums,
       count(DISTINCT n.adproduct) AS brandnums, count(DISTINCT n.adcontent) AS createnums
FROM (SELECT DISTINCT d.city_name, d.building_name, v.devid, v.mac, v.plninfo FROM view_info v
      JOIN device_city d ON v.devid = d.devid WHERE d.city_name IS NOT NULL) s
LEFT JOIN (SELECT DISTINCT pln_id, ad_content_id FROM valid) a ON s.plninfo = a.pln_id
LEFT JOIN videos n ON a.ad_content_id = n.ad_content_id
GROUP BY s.city_name"""
O["city_multi_distinct"] = _with(["view_info", "device_city", "valid", "videos"], CITY_DISTINCT)
VIEWS["city_played"] = (["play_log", "touch_city"], """
SELECT DISTINCT d.city_name, d.building_name, p.devid, p.inner_sn, p.master, p.pid, p.start_ms, p.end_ms,
       CASE WHEN length(p.sv) >= 7 THEN substr(p.sv, 1, 6) ELSE p.sv END AS sv, p.pi, p.idx
FROM play_log p JOIN touch_city d ON p.devid = d.devid
WHERE p.sv <> '0' AND d.city_name IS NOT NULL""")
VIEWS["city_shown"] = (["city_played", "slot_ads"], """
SELECT p.*, a.ad_content_id, a.ad_length FROM city_played p
JOIN slot_ads a ON p.sv = a.sch_version AND p.pi = a.pls_index AND p.idx = a.play_index AND p.pid = a.plninfo""")
VIEWS["exposed_pairs"] = (["view_info"], f"SELECT * FROM {_exposures('view_info', 'time, devid, mac')}")


def _city_exposures(places: str) -> str:
    return f"""
SELECT city_name, count(DISTINCT mac) AS nofake_maccount, count(mac) AS nofake_mactime,
       nullif(count(DISTINCT mac) FILTER (prefix IS NOT NULL), 0)::DOUBLE AS fake_maccount,
       nullif(count(mac) FILTER (prefix IS NOT NULL), 0)::DOUBLE AS fake_mactime
FROM exposed_pairs e JOIN {places} d ON e.devid = d.devid
LEFT JOIN known k ON k.prefix = lower(substr(e.mac, 1, 6))
WHERE city_name IS NOT NULL GROUP BY city_name"""


O["city_report"] = _with(["city_played", "city_shown", "videos", "exposed_pairs", "touch_city", "known"], f"""
SELECT a.*, b.ad_totallen, c.city_adcustomer_nums::DOUBLE AS city_adcustomer_nums,
       c.city_adproduct_nums::DOUBLE AS city_adproduct_nums, c.city_adcontent_nums::DOUBLE AS city_adcontent_nums,
       e.nofake_maccount::DOUBLE AS nofake_maccount, e.nofake_mactime::DOUBLE AS nofake_mactime,
       e.fake_maccount, e.fake_mactime
FROM (SELECT city_name, count(DISTINCT devid) AS devcount, count(DISTINCT building_name) AS buildcount
      FROM city_played GROUP BY city_name) a
LEFT JOIN (SELECT city_name, sum(ad_length::DOUBLE) AS ad_totallen FROM city_shown GROUP BY city_name) b USING (city_name)
LEFT JOIN (SELECT city_name, count(DISTINCT adcustomer) AS city_adcustomer_nums,
                  count(DISTINCT adproduct) AS city_adproduct_nums, count(DISTINCT adcontent) AS city_adcontent_nums
           FROM city_shown s JOIN videos v ON s.ad_content_id = v.ad_content_id GROUP BY city_name) c USING (city_name)
LEFT JOIN ({_city_exposures('touch_city')}) e USING (city_name)""")
AD_LENGTH = """
SELECT city_name, sum(len)::DOUBLE AS total_len FROM (
  SELECT d.city_name, a.ad_content_id, max(a.ad_length) AS len FROM view_info v
  JOIN device_city d ON v.devid = d.devid
  LEFT JOIN (SELECT DISTINCT pln_id, ad_content_id, ad_length FROM valid) a ON a.pln_id = v.plninfo
  WHERE d.city_name IS NOT NULL GROUP BY ALL) GROUP BY city_name"""
O["city_ad_length"] = _with(["view_info", "device_city", "valid"], AD_LENGTH)


def _city_arrivals(source: str, gap: int, name: str) -> str:
    return f"""
SELECT city_name, (sum(n) FILTER (n > 1) + count(*) FILTER (n = 1))::DOUBLE AS {name}
FROM (SELECT time, city_name, devid, mac, 1 + count(*) FILTER (scan_time - p > {gap}) AS n
      FROM (SELECT *, lag(scan_time) OVER (PARTITION BY time, city_name, devid, mac ORDER BY scan_time) AS p
            FROM {source}) GROUP BY ALL)
GROUP BY city_name HAVING count(*) FILTER (n > 1) > 0 AND count(*) FILTER (n = 1) > 0"""


VIEWS["placed_scans"] = (["view_info", "device_city"], """
SELECT d.city_name, v.time, v.devid, v.mac, v.scan_time FROM view_info v JOIN device_city d ON v.devid = d.devid
WHERE d.city_name IS NOT NULL""")
VIEWS["known_scans"] = (["placed_scans", "known"],
    "SELECT * FROM placed_scans WHERE lower(substr(mac, 1, 6)) IN (SELECT prefix FROM known)")
O["city_screen_report"] = _with(["placed_scans", "known_scans", "valid", "videos"], f"""
SELECT a.*, b.nofake_expose_times, c.fake_maccount, d.fake_exposetimes, e.total_len
FROM ({CITY_DISTINCT}) a
LEFT JOIN ({_city_arrivals('placed_scans', 7200, 'nofake_expose_times')}) b USING (city_name)
LEFT JOIN (SELECT city_name, count(DISTINCT mac)::DOUBLE AS fake_maccount FROM known_scans GROUP BY city_name) c
  USING (city_name)
LEFT JOIN ({_city_arrivals('known_scans', 7200, 'fake_exposetimes')}) d USING (city_name)
LEFT JOIN ({AD_LENGTH}) e USING (city_name)""")
O["city_ad_length_raw"] = _with(["city_shown"],
    "SELECT city_name, sum(ad_length::DOUBLE) AS ad_totallen FROM city_shown GROUP BY city_name")
_PLANNED = """
SELECT g.citycode, g.buildinglistdate, g.buildinglist, g.uploadcount, g.adcontent,
       g.slots * coalesce(f.basefrequency, 60) AS play_nums
FROM (SELECT citycode, buildinglistdate, buildinglist, uploadcount, adcontent, count(*) AS slots
      FROM {sched} GROUP BY ALL) g
LEFT JOIN frequency f ON f.citycode = g.citycode AND f.buildinglist = g.buildinglist AND f.uploadcount = g.uploadcount"""
O["planned_plays"] = _with(["schedule", "frequency"], f"""
SELECT citycode, CAST(buildinglistdate AS VARCHAR) AS buildinglistdate, buildinglist, uploadcount, adcontent, play_nums
FROM ({_PLANNED.format(sched='schedule')})""")
O["planned_plays_flat"] = _with(["schedule"], """
SELECT citycode, CAST(buildinglistdate AS VARCHAR) AS buildinglistdate, buildinglist, uploadcount, adcontent,
       count(*) * 60 AS play_nums FROM schedule GROUP BY ALL""")


def _flow(views: str, by_day: bool) -> str:
    resolve, backfill = (RESOLVE_DAY, BACKFILL_DAY) if by_day else (RESOLVE, BACKFILL)
    sched = "schedule" if by_day else "day_schedule"
    on = "AND m.time = p.buildinglistdate" if by_day else ""
    resolved = resolve.format(src=views)
    filled = backfill.format(src=f"({resolved})")
    return f"""
SELECT city_name, play_nums, count(DISTINCT mac) AS nofake_nums, count(mac) AS nofake_times,
       nullif(count(DISTINCT mac) FILTER (prefix IS NOT NULL AND city_name IS NOT NULL), 0)::DOUBLE AS fake_nums,
       nullif(count(mac) FILTER (prefix IS NOT NULL AND city_name IS NOT NULL), 0)::DOUBLE AS fake_times
FROM ({filled}) m JOIN ({_PLANNED.format(sched=sched)}) p
  ON m.citycode = p.citycode AND m.sch_version = p.buildinglist AND m.batch = p.uploadcount
 AND m.adcontent = p.adcontent {on}
LEFT JOIN known k ON k.prefix = lower(substr(m.mac, 1, 6))
GROUP BY city_name, play_nums"""


O["full_flow_day"] = _with(["view_info", "day_schedule", "ad_info", "frequency", "known"], f"""
SELECT '{DAY}' AS day, * FROM ({_flow(f"(SELECT * FROM view_info WHERE time = DATE '{DAY}')", False)})""")
O["full_flow_range"] = _with(["view_info", "schedule", "ad_info", "frequency", "known"], f"""
SELECT '{FIRST}' AS start_day, '{LAST}' AS end_date, * FROM (
{_flow(f"(SELECT * FROM view_info WHERE time BETWEEN DATE '{FIRST}' AND DATE '{LAST}')", True)})""")
for _name, _first, _last in (
    ("week", "2024-01-01", "2024-01-07"), ("month", "2024-01-01", "2024-01-31")
):
    O[f"full_flow_previous_{_name}"] = _with(
        ["view_info", "schedule", "ad_info", "frequency", "known"], f"""
SELECT '{_first}' AS start_day, '{_last}' AS end_date, * FROM (
{_flow(f"(SELECT * FROM view_info WHERE time BETWEEN DATE '{_first}' AND DATE '{_last}')", True)})""")
O["full_flow_day_by_case"] = O["full_flow_day"].replace(
    "k.prefix = lower(substr(m.mac, 1, 6))", "k.prefix = substr(m.mac, 1, 6)")
O["city_arrivals"] = _with(["view_info"], """
SELECT CAST(time AS VARCHAR) AS time, city_name, sum(n) FILTER (n > 1)::BIGINT AS twoexpose,
       count(*) FILTER (n = 1) AS oneexpose,
       (sum(n) FILTER (n > 1) + count(*) FILTER (n = 1))::BIGINT AS expose_times
FROM (SELECT time, city_name, devid, mac, 1 + count(*) FILTER (scan_time - p > 300) AS n
      FROM (SELECT *, lag(scan_time) OVER (PARTITION BY time, city_name, devid, mac ORDER BY scan_time) AS p
            FROM view_info WHERE city_name IS NOT NULL) GROUP BY ALL)
GROUP BY time, city_name HAVING count(*) FILTER (n > 1) > 0 AND count(*) FILTER (n = 1) > 0""")
O["actual_plays"] = _with(["play_log", "day_schedule", "package_frequency"], f"""
SELECT a.city_name, sum(s.slots * f.basefrequency)::DOUBLE AS playtimes
FROM (SELECT p.citycode, p.devid, p.inner_sn, r_name AS city_name, p.sch_version, max(p.uploadcount) AS uploadcount
      FROM play_log p JOIN region ON p.citycode = 'c' || r_regionkey
      WHERE p.time = DATE '{DAY}' AND p.devid NOT LIKE '%9' GROUP BY ALL) a
LEFT JOIN (SELECT citycode, buildinglist, uploadcount, count(*) AS slots
           FROM (SELECT DISTINCT citycode, buildinglist, uploadcount, nplseqno, nplinnerseqno FROM day_schedule)
           GROUP BY ALL) s
  ON s.citycode = a.citycode AND s.buildinglist = a.sch_version AND s.uploadcount = a.uploadcount
LEFT JOIN package_frequency f
  ON f.citycode = a.citycode AND f.buildinglist = a.sch_version AND f.uploadcount = a.uploadcount
GROUP BY a.city_name""")
O["building_type_avg"] = _with(["genuine", "latest", "building_type"], f"""
SELECT city_name, big_category, sum(exposetime) / count(DISTINCT e.devid) AS avg_exposetime,
       sum(macnums) / count(DISTINCT e.devid) AS avg_macnums
FROM (SELECT devid, count(*)::DOUBLE AS exposetime, count(DISTINCT mac)::DOUBLE AS macnums
      FROM {_exposures('genuine', 'time, devid, mac')} GROUP BY devid) e
LEFT JOIN (SELECT DISTINCT l.devid, l.city_name, l.install_name FROM latest l
           WHERE device_style LIKE '%互动%' AND length(devid) = 12) l ON e.devid = l.devid
LEFT JOIN building_type b ON b.city = l.city_name AND b.installed = l.install_name
GROUP BY city_name, big_category""")
O["device_exposures"] = _with(["exposed_pairs"], """
SELECT devid, count(*) AS exposetime, count(DISTINCT mac) AS macnums FROM exposed_pairs GROUP BY devid""")

# --- exposures and reach ------------------------------------------------------------------

O["scan_gaps"] = _with(["view_info"], f"""
SELECT {DATE_TEXT}, devid, mac, scan_time, n_scans, prev_time, scan_time - prev_time AS gap FROM (
  SELECT *, coalesce(lag(scan_time) OVER (PARTITION BY time, devid, mac ORDER BY scan_time), scan_time) AS prev_time
  FROM (SELECT time, devid, mac, scan_time, count(*) AS n_scans FROM view_info GROUP BY ALL))""")
O["exposures_multi"] = _with(["view_info"],
    f"SELECT {DATE_TEXT}, devid, mac, scan_time FROM {_exposures('view_info', PAIR, single=False)}")
O["exposures_single"] = _with(["view_info"],
    f"SELECT {DATE_TEXT}, devid, mac, scan_time FROM {_exposures('view_info', PAIR, multi=False)}")
O["exposures"] = _with(["exposed_pairs"], f"SELECT {DATE_TEXT}, devid, mac, scan_time FROM exposed_pairs")
O["exposures_strict"] = _with(["view_info"],
    f"SELECT {DATE_TEXT}, devid, mac, scan_time FROM {_exposures('view_info', PAIR, 50, True)}")
VIEWS["placed"] = (["genuine"], "SELECT * FROM genuine WHERE city_name IS NOT NULL")
O["exposures_city"] = _with(["placed"],
    f"SELECT {DATE_TEXT}, city_name, devid, mac, scan_time FROM {_exposures('placed', CITY)}")
O["exposures_building"] = _with(["kept_building_scans"],
    f"SELECT {DATE_TEXT}, city_name, building_name, mac, scan_time FROM "
    f"{_exposures('kept_building_scans', 'time, city_name, building_name, mac')}")
VIEWS["settled"] = (["view_info", "roaming"], f"""
SELECT * FROM view_info WHERE {_day('scan_time')} = time AND sch_version <> 0
  AND mac NOT IN (SELECT mac FROM roaming)""")
O["exposures_filtered"] = _with(["settled"],
    f"SELECT {DATE_TEXT}, devid, mac, scan_time FROM {_exposures('settled', PAIR)}")
VIEWS["trailing_roaming"] = (["view_info"], f"""
SELECT DISTINCT mac FROM (
  SELECT time, mac FROM (
    SELECT time, devid, mac, count(scan_time) AS ct, count(DISTINCT (scan_time % 86400) // 3600) AS hours
    FROM view_info v WHERE v.time BETWEEN DATE '{RUN}' - 6 AND DATE '{RUN}' GROUP BY ALL)
  GROUP BY time, mac HAVING sum(ct) > 45 OR max(hours) > 6)""")
VIEWS["trailing_scans"] = (["view_info", "trailing_roaming"], f"""
SELECT * FROM view_info v WHERE {_day('scan_time')} = time AND sch_version <> 0
  AND v.time BETWEEN DATE '{RUN}' - 6 AND DATE '{RUN}'
  AND mac NOT IN (SELECT mac FROM trailing_roaming)""")
_TRAILING = f"SELECT {DATE_TEXT}, devid, mac, scan_time FROM {_exposures('trailing_scans', PAIR)} e"
O["exposures_trailing_week"] = _with(["trailing_scans"], _TRAILING + f" WHERE e.time = DATE '{RUN}'")
O["exposures_trailing_week_daily"] = O["exposures_trailing_week"]
O["exposures_trailing_week_flow"] = _with(["trailing_scans"], _TRAILING)
O["city_exposures"] = _with(["exposed_pairs", "device_city", "known"], _city_exposures("device_city"))


def _freq(source: str, keys: str, grain: str) -> str:
    return f"""
SELECT {grain}, expose_time, count(*) AS mac_nums FROM (
  SELECT {keys}, count(*) AS expose_time FROM {_exposures(source, keys)} GROUP BY {keys})
GROUP BY {grain}, expose_time"""


VIEWS["freq"] = (["genuine"], _freq("genuine", PAIR, "time"))
VIEWS["freq_city"] = (["placed"], _freq("placed", CITY, "time, city_name"))
O["freq_dist"] = _with(["freq"], f"SELECT {DATE_TEXT}, expose_time, mac_nums FROM freq")
O["freq_dist_city"] = _with(["freq_city"], f"SELECT {DATE_TEXT}, city_name, expose_time, mac_nums FROM freq_city")
O["reach_curve"] = _with(["freq"], """
SELECT CAST(time AS VARCHAR) AS time, n::INTEGER AS expose_time,
       coalesce(sum(mac_nums) FILTER (f.expose_time >= n), 0)::BIGINT AS mactimes
FROM freq f, range(1, 51) AS r(n) GROUP BY time, n""")
O["reach_curve_city"] = _with(["freq_city"], """
SELECT CAST(time AS VARCHAR) AS time, city_name, n::INTEGER AS expose_time,
       coalesce(sum(mac_nums) FILTER (f.expose_time >= n), 0)::BIGINT AS mactimes
FROM freq_city f, range(1, 51) AS r(n) GROUP BY time, city_name, n""")
O["reach_curve_city_sparse"] = _with(["freq_city"], """
SELECT CAST(time AS VARCHAR) AS time, city_name, n::INTEGER AS expose_time,
       coalesce(sum(mac_nums) FILTER (f.expose_time >= n), 0)::BIGINT AS mactimes
FROM freq_city f, range(1, 51) AS r(n) GROUP BY time, city_name, n
HAVING min(f.expose_time) = 1 AND (max(f.expose_time) > 1 OR n = 1)""")
O["reach_curve_city_ad"] = _with(["genuine", "ad_info"], """
SELECT city_name, ad_content, n::INTEGER AS expose_time, count(*) FILTER (cnt >= n) AS mactimes
FROM (SELECT city_name, devid, mac, adcontent AS ad_content, count(*) AS cnt
      FROM genuine g JOIN ad_info i ON g.ad_content_id = i.adcontent_id AND adcontent <> ''
      WHERE city_name IS NOT NULL GROUP BY ALL), range(1, 51) AS r(n)
GROUP BY city_name, ad_content, n""")
O["date_windows"] = _with(["view_info"], """
SELECT time::VARCHAR AS time, (time - 6)::VARCHAR AS trail_start, 7 AS trail_days,
       (monday - 7)::VARCHAR AS week_start, (monday - 1)::VARCHAR AS week_end,
       first_day::VARCHAR AS month_start, last_day(first_day)::VARCHAR AS month_end,
       day(last_day(first_day))::INTEGER AS month_days
FROM (SELECT time, date_trunc('week', time)::DATE AS monday,
             (date_trunc('month', time) - INTERVAL 1 MONTH)::DATE AS first_day
      FROM (SELECT DISTINCT time FROM view_info))""")


def _probe_counts(same_device: str) -> str:
    same_device += f" v.time = {_day('p.at')} AND"
    face_device = same_device.replace("v.", "f.")
    parts = []
    for s in (10, 15):
        parts.append(f"""
  (SELECT count(*) FROM light_scans v WHERE {same_device} v.scan_time BETWEEN p.at - {s} AND p.at + {s}) AS scans_{s},
  (SELECT count(DISTINCT mac) FROM light_scans v WHERE {same_device} v.scan_time BETWEEN p.at - {s} AND p.at + {s}) AS macs_{s},
  (SELECT count(*) FROM face_log f WHERE {face_device} f.starttime BETWEEN p.at - {s} AND p.at + {s}) AS faces_{s}""")
    return f"SELECT probe_id, devid, p.at AS at, {', '.join(parts)} FROM probes p"


O["probe_counts"] = _with(["probes", "light_scans", "face_log"], _probe_counts("v.devid = p.devid AND"))
O["probe_counts_all_devices"] = _with(["probes", "light_scans", "face_log"], _probe_counts(""))
O["building_day_counts"] = _with(["control", "light_scans", "face_log", "known"], """
SELECT b.building_name, CAST(b.time AS VARCHAR) AS time, coalesce(allnums, 0) AS allnums,
       coalesce(distinctnums, 0) AS distinctnums, coalesce(facenums, 0) AS facenums
FROM (SELECT DISTINCT building_name, time FROM control) b
LEFT JOIN (SELECT building_name, c.time, count(*) AS allnums, count(DISTINCT mac) AS distinctnums
           FROM control c JOIN light_scans s ON s.devid = c.devid AND s.time = c.time
           WHERE lower(substr(mac, 1, 6)) IN (SELECT prefix FROM known) GROUP BY ALL) s
  ON s.building_name = b.building_name AND s.time = b.time
LEFT JOIN (SELECT building_name, c.time, count(*) AS facenums
           FROM control c JOIN face_log f ON f.devid = c.devid AND f.time = c.time GROUP BY ALL) f
  ON f.building_name = b.building_name AND f.time = b.time""")

O["probe_counts_by_control"] = O["probe_counts"]
O["probe_counts_pruned"] = f"""SELECT * FROM ({O["probe_counts"]})
WHERE "at" < epoch(DATE '{FIRST}' + 1)"""
O["building_day_counts_by_control"] = O["building_day_counts"]

# --- rebuilt play log ---------------------------------------------------------------------

O["schedule_cycle"] = _with(["cycle"], """
SELECT CAST(time AS VARCHAR) AS time, citycode, sch_version, uploadcount, pls_index, play_index, plninfo, ad_ms,
       slot_pos::INTEGER AS slot_pos, n_slots, lap_from, lap_ms, next_pls_index, next_play_index, next_plninfo,
       prev_pls_index, prev_play_index, prev_plninfo FROM cycle""")
O["play_sessions"] = _with(["sessions"], f"""
SELECT {DATE_TEXT}, devid, citycode, sch_version, uploadcount, pls_index, play_index, plninfo,
       start_ms, end_ms, is_seed FROM sessions""")
def _per_slot(rows: str) -> str:
    return f"""
SELECT CAST(time AS VARCHAR) AS time, devid, sch_version, uploadcount, pls_index, play_index, count(*) AS plays,
       sum(s - {BASE}000)::BIGINT AS starts, sum(e - {BASE}000)::BIGINT AS ends, min(s) AS first_ms
FROM {rows} GROUP BY ALL"""


_PER_SLOT = _per_slot("stepped WHERE new")
O["play_fill_forward"] = _with(["gaps", "cycle"], _PER_SLOT, ("stepped", _step(True)))
O["play_table_written"] = O["play_fill_forward"]
O["play_fill_backward"] = _with(["gaps", "cycle"], _PER_SLOT, ("stepped", _step(False)))

# Settling: a device-day is one list of plays. A pass goes over it from left to right, carrying the
# plays done so far; passes are repeated until nothing changes, first for seeds, then for growth.
VIEWS["listed"] = (["sessions"], """
SELECT time, devid, list({'ord': ord::BIGINT, 's': start_ms::BIGINT, 'e': end_ms::BIGINT, 'sd': is_seed,
                          'ln': ad_ms::BIGINT, 'lap': lap_ms::BIGINT, 'fw': fw} ORDER BY ord) AS l
FROM (SELECT *, coalesce(lag(sch_version) OVER w = sch_version AND lag(uploadcount) OVER w = uploadcount
                         AND (lag(slot_pos) OVER w + 1) % n_slots = slot_pos, false) AS fw
      FROM sessions WINDOW w AS (PARTITION BY time, devid ORDER BY ord))
GROUP BY time, devid""")


def _play(of: str, s: str, e: str, sd: str, following: bool = True) -> str:
    ahead = f", 'ns': {of}.ns, 'nsd': {of}.nsd, 'nfw': {of}.nfw" if following else ""
    return (f"{{'ord': {of}.ord, 's': {s}, 'e': {e}, 'sd': {sd}, 'ln': {of}.ln, 'lap': {of}.lap, "
            f"'fw': {of}.fw{ahead}}}")


def _pass(step: str) -> str:
    """One pass: ``step`` gives the plays done so far (acc) and one more (x) from the play before
    (acc[-1]), the play (x[1]) and what the next one was like (ns, nsd, nfw)."""
    ahead = ("list_transform(l, lambda y, k: [{'ord': y.ord, 's': y.s, 'e': y.e, 'sd': y.sd, 'ln': y.ln, "
             "'lap': y.lap, 'fw': y.fw, 'ns': l[k + 1].s, 'nsd': l[k + 1].sd, 'nfw': l[k + 1].fw}])")
    nobody = ("[[{'ord': -1::BIGINT, 's': 0::BIGINT, 'e': 0::BIGINT, 'sd': false, 'ln': 0::BIGINT, 'lap': 0::BIGINT, "
              "'fw': false, 'ns': NULL::BIGINT, 'nsd': false, 'nfw': false}]]")
    done = f"list_reduce({nobody} || {ahead}, lambda acc, x: {step})"
    return f"list_transform(({done})[2:], lambda z: {_play('z', 'z.s', 'z.e', 'z.sd', False)})"


def _seed_pass() -> str:
    p, c = "acc[-1]", "x[1]"
    gap, later = f"({c}.s - {p}.e)", f"({c}.ns - {c}.e)"
    before = f"acc[: len(acc) - 1] || [{{}}] || x"
    behind = f"{p}.ord >= 0"  # there is a play before
    return _pass(f"""CASE
      WHEN {c}.sd AND {behind} AND {c}.fw AND NOT {p}.sd AND {gap} = 0
      THEN {before.format(_play(p, f"{p}.e - {p}.ln", f"{p}.e", "true"))}
      WHEN {c}.sd AND {behind} AND {c}.fw AND NOT {p}.sd AND {gap} > 0 AND {gap} < {p}.lap
      THEN {before.format(_play(p, f"{p}.s", f"{c}.s", f"{c}.s - {p}.s >= {p}.ln"))}
      WHEN {c}.sd OR NOT {behind} THEN acc || x
      WHEN {c}.fw AND {p}.sd AND {gap} = 0
      THEN acc || [{_play(c, f"{c}.s", f"{c}.s + {c}.ln", "true")}]
      WHEN {c}.fw AND {p}.sd AND {gap} > 0 AND {gap} < {c}.lap
      THEN acc || [{_play(c, f"{p}.e", f"{c}.e", f"{c}.e - {p}.e >= {c}.ln")}]
      WHEN {c}.fw AND {p}.sd THEN acc || x
      WHEN {c}.nfw AND {c}.nsd AND {later} > 0 AND {later} < {c}.lap
      THEN acc || [{_play(c, f"{c}.ns - {c}.ln", f"{c}.ns", "true")}]
      ELSE acc || x END""")


def _growth_pass() -> str:
    p, c = "acc[-1]", "x[1]"
    left = f"greatest(0, CASE WHEN {p}.ord < 0 THEN 200 ELSE least(200, {c}.s - {p}.e) END)"
    grown = f"({left} > 0 AND {c}.e - {c}.s + {left} >= {c}.ln)"
    free = f"CASE WHEN {c}.ns IS NOT NULL THEN least(200, {c}.ns - {c}.e) WHEN {p}.ord < 0 THEN 200 ELSE 0 END"
    right = f"CASE WHEN {grown} THEN 0 ELSE greatest(0, {free}) END"
    long = f"({left} + {right} > 0 AND {c}.e - {c}.s + {left} + {right} >= {c}.ln)"
    return _pass(f"""CASE WHEN {c}.sd THEN acc || x
      ELSE acc || [{_play(c, f"{c}.s - {left}", f"{c}.e + {right}", long)}] END""")


_SETTLING = ("settling", f"""
SELECT time, devid, 1 AS phase, l FROM listed
UNION ALL
SELECT time, devid, CASE WHEN after = l THEN phase + 1 ELSE phase END, after
FROM (SELECT *, CASE WHEN phase = 1 THEN {_seed_pass()} ELSE {_growth_pass()} END AS after
      FROM settling WHERE phase < 3)""")
_SETTLED = ("settled_plays", """
SELECT s.* REPLACE (x.s AS start_ms, x.e AS end_ms, x.sd AS is_seed)
FROM sessions s JOIN (SELECT time, devid, unnest(l) AS x FROM settling WHERE phase = 3) u
  ON u.time = s.time AND u.devid = s.devid AND x.ord = s.ord""")
_REBUILT = [
    _SETTLING, _SETTLED, ("settled_gaps", _gaps("settled_plays")),
    ("fore", _step(True, "fore", "settled_gaps")), ("back", _step(False, "back", "settled_gaps")),
    ("rebuilt", """
SELECT time, devid, sch_version, uploadcount, pls_index, play_index, plninfo, s, e FROM fore WHERE new
UNION ALL SELECT time, devid, sch_version, uploadcount, pls_index, play_index, plninfo, s, e FROM back WHERE new
UNION ALL SELECT time, devid, sch_version, uploadcount, pls_index, play_index, plninfo, start_ms, end_ms
FROM settled_plays"""),
]
O["seed_plays"] = _with(["sessions", "listed"], f"""
SELECT {DATE_TEXT}, devid, citycode, sch_version, uploadcount, pls_index, play_index, plninfo,
       start_ms, end_ms, is_seed FROM settled_plays""", _SETTLING, _SETTLED)
O["play_log_rebuilt"] = _with(["sessions", "listed", "cycle"], _per_slot("rebuilt"), *_REBUILT)

# --- gap-fill and views -------------------------------------------------------------------

O["exposure_gapfill"] = _with(["filled"], f"""
SELECT {DATE_TEXT}, devid, mac, sch_version, uploadcount, pls_index, play_index, plninfo, scan_time, time_diff,
       inserted FROM filled""")
def _views(filled: str) -> str:
    return f"""
SELECT CAST(time AS VARCHAR) AS time, devid, mac, {SLOT4}, min(scan_time) * 1000 AS start_ms,
       CASE WHEN count(*) = 1 THEN min(scan_time) * 1000 + 1 ELSE max(scan_time) * 1000 END AS end_ms,
       max(time_diff) FILTER (fresh) AS time_diff
FROM (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER
        (PARTITION BY time, devid, mac ORDER BY {ROW_ORDER} ROWS UNBOUNDED PRECEDING) AS run
      FROM (SELECT *, pt IS NULL OR scan_time - pt > {FLAG} OR ps <> ({SLOT4}) AS fresh
            FROM (SELECT *, lag(scan_time) OVER w AS pt, lag(({SLOT4})) OVER w AS ps
                  FROM {filled} WINDOW w AS (PARTITION BY time, devid, mac ORDER BY {ROW_ORDER}))))
GROUP BY time, devid, mac, {SLOT4}, run"""


O["view_merge"] = _with(["filled"], _views("filled"))
O["view_merge_rebuilt"] = _with(["sessions", "listed", "cycle", "main_sn"], f"""
SELECT time, devid, {SLOT4}, count(*) AS views, sum(end_ms - start_ms)::BIGINT AS viewed_ms
FROM rebuilt_views GROUP BY ALL""", *_REBUILT,
    ("rebuilt_plays", "SELECT * RENAME (s AS start_ms, e AS end_ms) FROM rebuilt"),
    ("few_scans", _light("main_sn", 1000)), ("few_windows", _windows("few_scans")),
    ("rebuilt_filled", _filled("few_windows", "rebuilt_plays")), ("rebuilt_views", _views("rebuilt_filled")))
O["max_ad_length"] = _with(["lengths"], "SELECT * FROM lengths")
O["enrich_plays"] = _with(["enriched"], """
SELECT devid, start_ms, end_ms, plninfo, adcontent, ad_content_id, suit_kind, ad_length, adproduct, adcustomer,
       city_name, building_no, building_name FROM enriched""")
O["enrich_plays_unversioned"] = _with(["play_log", "latest", "lengths", "ad_ids"], """
SELECT devid, adcontent, ad_content_id, ad_length, sch_version, count(*) AS plays FROM (
SELECT DISTINCT p.time, p.devid, p.start_ms, p.end_ms, p.pls_index, p.play_index, p.plninfo,
       p.iccid, p.inner_sn, p.vfn AS adcontent, i.adid AS ad_content_id, l.ad_length,
       l.adproduct, l.adcustomer, d.suit_kind, d.city_name, d.building_no, d.building_name, 0::INTEGER AS sch_version
FROM play_log p JOIN (SELECT DISTINCT devid, suit_kind, city_name, building_no, building_name
                      FROM latest WHERE suit_kind <> '') d ON p.devid = d.devid
JOIN lengths l ON left(p.vfn, length(p.vfn) - 4) = left(l.adcontent, length(l.adcontent) - 4)
JOIN ad_ids i ON left(p.vfn, length(p.vfn) - 4) = left(i.adcontent, length(i.adcontent) - 4))
GROUP BY ALL""")
O["enrich_described_plays"] = _with(["enriched", "newest", "schedule_raw"], """
SELECT p.devid, p.start_ms, p.end_ms, p.plninfo, replace(p.adcontent, '.mp4', '.avi') AS adcontent,
       d.suit_kind, l.ad_length
FROM (SELECT DISTINCT time, devid, inner_sn, sch_version, uploadcount, pls_index, play_index, plninfo, start_ms,
             end_ms, adcontent, ad_content_id, adproduct, adcustomer, city_name, building_no, building_name
      FROM enriched) p
JOIN (SELECT DISTINCT devid, suit_kind FROM newest WHERE install_status = '已安装' AND suit_kind <> '') d
  ON d.devid = p.devid
JOIN (SELECT adcontent, max(adlength::INTEGER) AS ad_length FROM schedule_raw GROUP BY adcontent) l
  ON l.adcontent = replace(p.adcontent, '.mp4', '.avi')""")
O["ad_attribution"] = _with(["attributed"], f"""
SELECT {DATE_TEXT}, devid, mac, scan_time, adcontent, adcustomer, ad_city AS city_name, building_name
FROM attributed""")
O["ad_attribution_same_day"] = _with(["attributed_day"], """
SELECT CAST(time AS VARCHAR) AS time, devid, adcontent, count(*) AS scans FROM attributed_day
GROUP BY attributed_day.time, devid, adcontent""")
O["exposure_gapfill_playlog"] = _with(["log_filled"], f"""
SELECT id, {DATE_TEXT}, devid, mac, sch_version, uploadcount, pls_index, play_index, plninfo, scan_time,
       time_diff, inserted, adcontent, ad_content_id FROM log_filled""")


def _adlen(by_content: bool) -> tuple[str, str]:
    """Walk each visitor's rows one by one, carrying the second the current view began."""
    same = SLOT4 + (", adcontent" if by_content else "")
    cut = " OR r.adcontent IS NULL" if by_content else ""
    fresh = (f"r.scan_time - w.scan_time > {FLAG} OR r.ad_length IS NULL OR r.same <> w.same{cut} "
             "OR r.scan_time - w.began > r.ad_length")
    return same, f"""
SELECT time, devid, mac, rn, scan_time, same, {SLOT4}, adcontent, time_diff, scan_time AS began, 1 AS view
FROM numbered WHERE rn = 1
UNION ALL
SELECT r.time, r.devid, r.mac, r.rn, r.scan_time, r.same, r.sch_version, r.uploadcount, r.pls_index, r.play_index,
       r.adcontent, r.time_diff, CASE WHEN {fresh} THEN r.scan_time ELSE w.began END,
       CASE WHEN {fresh} THEN w.view + 1 ELSE w.view END
FROM walked w JOIN numbered r ON r.time = w.time AND r.devid = w.devid AND r.mac = w.mac AND r.rn = w.rn + 1"""


for _name, _content in (("view_merge_adlen", False), ("view_merge_adlen_content", True)):
    _same, _walk = _adlen(_content)
    VIEWS["numbered"] = (["log_filled"], f"""
SELECT *, ({_same}) AS same, row_number() OVER (PARTITION BY time, devid, mac ORDER BY {ROW_ORDER}) AS rn
FROM log_filled""")
    O[_name] = _with(["numbered"], f"""
SELECT CAST(time AS VARCHAR) AS time, devid, mac, {SLOT4}, min(scan_time) * 1000 AS start_ms,
       CASE WHEN count(*) = 1 THEN min(scan_time) * 1000 + 1 ELSE max(scan_time) * 1000 END AS end_ms,
       arg_min(time_diff, rn) AS time_diff, first(adcontent ORDER BY rn) AS adcontent
FROM walked GROUP BY time, devid, mac, {SLOT4}, view""", ("walked", _walk))

O["panel_week_views"] = O["view_merge_adlen"]
O["panel_week_views_daily"] = O["view_merge_adlen"]

# --- row functions ------------------------------------------------------------------------

O["scalar_kit"] = _with(["view_info"], """
SELECT devid, mac, scan_time, lower(substr(mac, 1, 6)) AS prefix, plninfo AS stem, plninfo AS cut_stem,
       CASE WHEN is_ap <> '1' THEN mac END AS kept_mac, CASE WHEN is_ap = '1' THEN '北京' ELSE '上海' END AS city,
       scan_time AS stamp, scan_time % 86400 AS second_of_day, ((scan_time % 86400) // 3600)::INTEGER AS hour,
       21600::BIGINT AS to_six, true AS no_number, mac AS second_part FROM view_info""")
