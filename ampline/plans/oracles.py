"""Reference SQL for each named query, written apart from the Spark code, for an in-process database.

Shared steps are common table expressions; each query gets those it needs.
"""

from __future__ import annotations

import re

STEPS: dict[str, str] = {
    "ev": """
        SELECT event_id AS e, user_id AS u, event_type AS kind, value,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
               1704067200000000 + (epoch_us(ts) - 1704067200000000) // 240 AS us
        FROM events""",
    "tlm_raw": """
        SELECT e * 2 + d AS row_ord, CAST(e AS VARCHAR) AS ID, 'V' || u AS VEHICLE_ID,
               CASE WHEN e % 97 <> 0 THEN make_timestamp(us) END AS "TIMESTAMP",
               CASE WHEN kind = 'view' THEN value - 10 END AS SPEED,
               CASE WHEN kind = 'click' THEN ' On ' WHEN kind = 'view' THEN 'OFF'
                    WHEN e % 2 = 0 THEN 'Unknown' END AS IGNITION_STATUS,
               CASE WHEN kind <> 'view' THEN value - 5 END AS EV_BATTERY_LEVEL,
               CASE WHEN e % 4 = 0 THEN value * 100 END AS ODOMETER
        FROM ev, (VALUES (0), (1)) AS c(d)
        WHERE kind IN ('click', 'view', 'purchase') AND (d = 0 OR e % 50 = 0)""",
    "trg_raw": """
        SELECT e * 2 + d AS row_ord, CASE WHEN e % 89 <> 0 THEN make_timestamp(us) END AS CTS,
               u * 2 + e % 2 AS PNID,
               CASE WHEN kind = 'signup' THEN 'CHARGE_STATE' WHEN k < 60 THEN 'IGN_CYL'
                    WHEN k < 90 THEN 'EV_CHARGE_STATE' ELSE 'DOOR' END AS NAME,
               CASE WHEN kind = 'signup' THEN CASE k WHEN 13 THEN 'n/a' WHEN 17 THEN '120.5' WHEN 19 THEN '-3' ELSE CAST(k AS VARCHAR) END
                    WHEN k = 31 THEN 'CRANK'
                    WHEN k < 60 THEN CASE WHEN k % 2 = 0 THEN 'ON' ELSE 'OFF' END
                    WHEN k < 90 THEN CASE k % 5 WHEN 0 THEN 'Active' WHEN 1 THEN 'Aborted'
                         WHEN 2 THEN 'Complete' WHEN 3 THEN 'Completed' ELSE 'Abort' END
                    ELSE 'x' END AS VAL
        FROM ev, (VALUES (0), (1)) AS c(d)
        WHERE kind IN ('signup', 'error') AND (d = 0 OR e % 40 = 0)""",
    "map_raw": """
        SELECT u * 2 + 1 AS row_ord, 'V' || u AS ID,
               CASE WHEN u % 15 = 14 THEN NULL WHEN u % 15 = 13 THEN 'broken['
                    WHEN u % 15 = 4 THEN '[' || (2*u) || ',' || (2*u+1) || ',' || (2*u+2) || ']'
                    ELSE '[' || (2*u) || ',' || (2*u+1) || ']' END AS IDS
        FROM (SELECT DISTINCT u FROM ev)
        UNION ALL
        SELECT u * 2, 'V' || u, '[]' FROM (SELECT DISTINCT u FROM ev) WHERE u % 15 = 3""",
    "syn_raw": """
        SELECT e * 2 AS row_ord, CASE WHEN e % 30 = 0 THEN 'X' ELSE 'V' END || u AS vehicle_id,
               CASE WHEN e * 2 % 74 <> 0 THEN make_timestamp(us + 3000000) END AS event_ts
        FROM ev WHERE kind = 'view' AND e % 3 = 0
        UNION ALL
        SELECT e * 2 + 1, 'V' || u, make_timestamp(us + (e % 20) * 1000000)
        FROM ev WHERE kind = 'view' AND e % 5 = 0""",
    "syn": "SELECT * FROM syn_raw WHERE event_ts IS NOT NULL",
    "tlm": """
        SELECT row_ord, ID, VEHICLE_ID, "TIMESTAMP", CASE WHEN SPEED < 0 THEN 0.0 ELSE SPEED END AS SPEED,
               CASE lower(trim(IGNITION_STATUS)) WHEN 'on' THEN 'on' WHEN 'off' THEN 'off' END AS IGNITION_STATUS,
               CASE WHEN EV_BATTERY_LEVEL < 0 THEN NULL WHEN EV_BATTERY_LEVEL > 100 THEN 100.0
                    ELSE EV_BATTERY_LEVEL END AS EV_BATTERY_LEVEL,
               ODOMETER
        FROM tlm_raw WHERE "TIMESTAMP" IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY ID ORDER BY row_ord) = 1""",
    "trg_valid": """
        SELECT * FROM trg_raw
        WHERE CTS IS NOT NULL AND CASE NAME
              WHEN 'IGN_CYL' THEN VAL IN ('ON', 'OFF')
              WHEN 'CHARGE_STATE' THEN TRY_CAST(VAL AS DOUBLE) IS NOT NULL
              WHEN 'EV_CHARGE_STATE' THEN VAL IN ('Active', 'Aborted', 'Complete', 'Completed')
              ELSE FALSE END""",
    "trg": "SELECT CTS, PNID, NAME, VAL, min(row_ord) AS row_ord FROM trg_valid GROUP BY ALL",
    "map_last": "SELECT * FROM map_raw QUALIFY row_number() OVER (PARTITION BY ID ORDER BY row_ord DESC) = 1",
    "map_parsed": """
        SELECT row_ord, ID AS vehicle_id, IDS,
               CASE WHEN regexp_full_match(IDS, '\\[([0-9]+(,[0-9]+)*)?\\]')
                    THEN IDS[2:length(IDS) - 1] END AS pnids
        FROM map_last""",
    "map_claims": """
        SELECT row_ord, vehicle_id, pos, CAST(part AS BIGINT) AS pnid
        FROM (SELECT row_ord, vehicle_id, unnest(string_split(pnids, ',')) AS part,
                     generate_subscripts(string_split(pnids, ','), 1) - 1 AS pos
              FROM map_parsed WHERE pnids <> '')""",
    "pnid_map": """
        SELECT pnid, vehicle_id FROM map_claims
        QUALIFY row_number() OVER (PARTITION BY pnid ORDER BY row_ord DESC, pos DESC) = 1""",
    "mapped": "SELECT trg.*, vehicle_id FROM trg LEFT JOIN pnid_map ON trg.PNID = pnid_map.pnid",
    "tlm_ign": """
        SELECT VEHICLE_ID AS vehicle_id, CASE IGNITION_STATUS WHEN 'on' THEN 'ignitionOn' ELSE 'ignitionOff' END AS event,
               "TIMESTAMP" AS event_ts, 'TLM' AS source, CAST(0 AS BIGINT) AS ord1, row_ord AS ord2
        FROM tlm WHERE IGNITION_STATUS IS NOT NULL
        QUALIFY IGNITION_STATUS IS DISTINCT FROM
                lag(IGNITION_STATUS) OVER (PARTITION BY VEHICLE_ID ORDER BY "TIMESTAMP", row_ord)""",
    "trg_ign": """
        SELECT vehicle_id, CASE VAL WHEN 'ON' THEN 'ignitionOn' ELSE 'ignitionOff' END AS event,
               CTS AS event_ts, 'TRG' AS source, PNID AS ord1, row_ord AS ord2
        FROM mapped WHERE NAME = 'IGN_CYL' AND vehicle_id IS NOT NULL
        QUALIFY VAL IS DISTINCT FROM lag(VAL) OVER (PARTITION BY vehicle_id ORDER BY CTS, PNID, row_ord)""",
    "syn_ign": """
        SELECT vehicle_id, 'ignitionOff' AS event, event_ts, 'SYN' AS source,
               CAST(0 AS BIGINT) AS ord1, row_ord AS ord2
        FROM syn""",
    "all_ign": "SELECT * FROM tlm_ign UNION ALL SELECT * FROM trg_ign UNION ALL SELECT * FROM syn_ign",
    "line": """
        SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_ts, prio, ord1, ord2) AS nth
        FROM (SELECT *, CASE source WHEN 'TLM' THEN 0 WHEN 'TRG' THEN 1 ELSE 2 END AS prio FROM all_ign)""",
    "steps": """
        SELECT vehicle_id, nth, TRUE AS kept, event AS last_event, event_ts AS last_ts FROM line WHERE nth = 1
        UNION ALL
        SELECT vehicle_id, nth, NOT near, CASE WHEN near THEN last_event ELSE event END,
               CASE WHEN near THEN last_ts ELSE event_ts END
        FROM (SELECT l.vehicle_id, l.nth, l.event, l.event_ts, s.last_event, s.last_ts,
                     l.event = s.last_event AND epoch_us(l.event_ts) - epoch_us(s.last_ts) < 10000000 AS near
              FROM steps AS s JOIN line AS l ON l.vehicle_id = s.vehicle_id AND l.nth = s.nth + 1)""",
    "fused": """
        SELECT vehicle_id, event, event_ts, source, prio, ord1, ord2
        FROM line JOIN steps USING (vehicle_id, nth) WHERE kept""",
    "status": """
        SELECT vehicle_id, CASE VAL WHEN 'Aborted' THEN 'Abort' WHEN 'Completed' THEN 'Complete' ELSE VAL END AS event,
               CTS AS event_ts, PNID AS ord1, row_ord AS ord2
        FROM mapped WHERE NAME = 'EV_CHARGE_STATE' AND vehicle_id IS NOT NULL""",
    "timeline": """
        SELECT VEHICLE_ID AS vehicle_id, "TIMESTAMP" AS ts, EV_BATTERY_LEVEL AS battery_pct, 'TLM' AS source,
               CAST(0 AS BIGINT) AS ord1, row_ord AS ord2
        FROM tlm WHERE EV_BATTERY_LEVEL IS NOT NULL
        UNION ALL
        SELECT vehicle_id, CTS, CASE WHEN CAST(VAL AS DOUBLE) > 100 THEN 100 ELSE CAST(VAL AS DOUBLE) END, 'TRG', PNID, row_ord
        FROM mapped WHERE NAME = 'CHARGE_STATE' AND vehicle_id IS NOT NULL""",
    "seq": """
        SELECT vehicle_id, event, event_ts, 0 AS kind, prio, ord1, ord2 FROM fused
        UNION ALL
        SELECT vehicle_id, event, event_ts, 1, 0, ord1, ord2 FROM status""",
    "hits": """
        SELECT s.vehicle_id, s.event_ts, r.battery_pct, r.ts AS battery_ts,
               floor((epoch_us(r.ts) - epoch_us(s.event_ts)) / 1000000.0) AS d, r.source, r.ord1, r.ord2
        FROM (SELECT DISTINCT vehicle_id, event_ts FROM seq) AS s
        JOIN timeline AS r ON r.vehicle_id = s.vehicle_id
        WHERE floor((epoch_us(r.ts) - epoch_us(s.event_ts)) / 1000000.0) BETWEEN -300 AND 300""",
    "nearest": """
        SELECT vehicle_id, event_ts, battery_pct, battery_ts FROM hits
        QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_ts
                ORDER BY abs(d), -sign(d), battery_ts, source, ord1, ord2) = 1""",
    "seq_battery": "SELECT seq.*, battery_pct FROM seq LEFT JOIN nearest USING (vehicle_id, event_ts)",
    "pairs": """
        SELECT vehicle_id, event_ts AS start_ts, to_ts AS end_ts, battery_pct AS start_pct, to_pct AS end_pct,
               to_pct - battery_pct AS delta_pct, (epoch_us(to_ts) - epoch_us(event_ts)) / 1e6 AS duration_sec,
               coalesce(state, 'unknown') AS ignition_state
        FROM (SELECT *, lead(event_ts) OVER w AS to_ts, lead(battery_pct) OVER w AS to_pct,
                     last_value(CASE WHEN kind = 0 THEN event END IGNORE NULLS) OVER
                       (PARTITION BY vehicle_id ORDER BY event_ts, kind, prio, ord1, ord2
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state
              FROM seq_battery
              WINDOW w AS (PARTITION BY vehicle_id ORDER BY event_ts, kind, prio, ord1, ord2))
        WHERE battery_pct IS NOT NULL AND to_pct IS NOT NULL AND to_ts > event_ts""",
    "raw_sessions": """
        SELECT vehicle_id, start_ts, end_ts, round_even(delta_pct * 100, 0) / 100 AS delta_battery_pct,
               round_even(start_pct * 100, 0) / 100 AS start_battery_pct,
               round_even(end_pct * 100, 0) / 100 AS end_battery_pct, duration_sec, ignition_state
        FROM pairs WHERE delta_pct >= CASE ignition_state WHEN 'ignitionOn' THEN 5.0 ELSE 2.0 END""",
    "islands": """
        SELECT *, count(*) FILTER (WHERE gap_us > 300000000) OVER
                    (PARTITION BY vehicle_id ORDER BY start_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
        FROM (SELECT *, epoch_us(start_ts) - epoch_us(lag(end_ts) OVER (PARTITION BY vehicle_id ORDER BY start_ts)) AS gap_us
              FROM raw_sessions)""",
    "merged": """
        SELECT vehicle_id, min(start_ts) AS start_ts, max(end_ts) AS end_ts,
               CASE WHEN count(*) = 1 THEN any_value(delta_battery_pct)
                    ELSE round_even((arg_max(end_battery_pct, start_ts) - arg_min(start_battery_pct, start_ts)) * 100, 0) / 100
               END AS delta_battery_pct,
               arg_min(start_battery_pct, start_ts) AS start_battery_pct,
               arg_max(end_battery_pct, start_ts) AS end_battery_pct,
               (epoch_us(max(end_ts)) - epoch_us(min(start_ts))) / 1e6 AS duration_sec,
               arg_min(ignition_state, start_ts) AS ignition_state
        FROM islands GROUP BY vehicle_id, island""",
    "sessions": "SELECT * FROM merged WHERE duration_sec >= 60",
    "null_ratio": """
        SELECT column_name, count(*) FILTER (WHERE missing) AS n_null, count(*) AS n_rows,
               100 * count(*) FILTER (WHERE missing) / count(*) AS pct_null
        FROM (SELECT 'SPEED' AS column_name, SPEED IS NULL AS missing FROM tlm
              UNION ALL SELECT 'IGNITION_STATUS', IGNITION_STATUS IS NULL FROM tlm
              UNION ALL SELECT 'EV_BATTERY_LEVEL', EV_BATTERY_LEVEL IS NULL FROM tlm
              UNION ALL SELECT 'ODOMETER', ODOMETER IS NULL FROM tlm)
        GROUP BY column_name""",
    "timed": """
        SELECT *, lower(trim(IGNITION_STATUS)) AS s FROM tlm_raw WHERE "TIMESTAMP" IS NOT NULL""",
    "dq_tlm": """
        SELECT 1 AS stage, 'DQ-1' AS rule, '' AS item, count(*) AS n_rows,
               'TLM: ' || count(*) || ' rows with unparseable timestamps — dropped.' AS detail
        FROM tlm_raw WHERE "TIMESTAMP" IS NULL HAVING count(*) > 0
        UNION ALL
        SELECT 2, 'DQ-2', '', count(*), 'TLM: ' || count(*) || ' rows have IGNITION_STATUS=''unknown'' — treated as missing.'
        FROM timed WHERE s = 'unknown' HAVING count(*) > 0
        UNION ALL
        SELECT 3, 'DQ-3', '', count(*), 'TLM: ' || count(*) || ' battery readings > 100 % — capped at 100.'
        FROM timed WHERE EV_BATTERY_LEVEL > 100 HAVING count(*) > 0
        UNION ALL
        SELECT 4, 'DQ-4', '', count(*), 'TLM: ' || count(*) || ' negative battery readings — set to NaN.'
        FROM timed WHERE EV_BATTERY_LEVEL < 0 HAVING count(*) > 0
        UNION ALL
        SELECT 5, 'DQ-5', '', count(*), 'TLM: ' || count(*) || ' negative speed readings — set to 0.'
        FROM timed WHERE SPEED < 0 HAVING count(*) > 0
        UNION ALL
        SELECT 6, 'DQ-6', '', sum(n - 1), 'TLM: ' || sum(n - 1) || ' duplicate row IDs — deduplicated.'
        FROM (SELECT ID, count(*) AS n FROM timed GROUP BY ID) HAVING sum(n - 1) > 0
        UNION ALL
        SELECT 7, 'DQ-7', column_name, n_null,
               printf('TLM: Column ''%s'' is %.1f%% null (', column_name, pct_null)
               || format('{:,}', n_null) || '/' || format('{:,}', n_rows) || ') — sparse but usable.'
        FROM null_ratio WHERE pct_null > 50""",
    "bad_trg": """
        SELECT CASE WHEN NAME NOT IN ('IGN_CYL', 'CHARGE_STATE', 'EV_CHARGE_STATE') THEN 'DQ-9'
                    WHEN NAME = 'IGN_CYL' THEN 'DQ-10' WHEN NAME = 'CHARGE_STATE' THEN 'DQ-11' ELSE 'DQ-12' END AS rule,
               CASE WHEN NAME IN ('IGN_CYL', 'CHARGE_STATE', 'EV_CHARGE_STATE') THEN VAL ELSE NAME END AS value,
               count(*) AS n_rows
        FROM trg_raw WHERE CTS IS NOT NULL AND row_ord NOT IN (SELECT row_ord FROM trg_valid)
        GROUP BY ALL""",
    "bad_trg_rules": """
        SELECT rule, sum(n_rows) AS n_rows, count(*) AS n_values FROM bad_trg GROUP BY rule""",
    "dq_trg": """
        SELECT 8 AS stage, 'DQ-8' AS rule, '' AS item, count(*) AS n_rows,
               'TRG: ' || count(*) || ' rows with unparseable timestamps — dropped.' AS detail
        FROM trg_raw WHERE CTS IS NULL HAVING count(*) > 0
        UNION ALL
        SELECT CAST(rule[4:] AS INTEGER), rule, '', n_rows, 'TRG: ' || n_rows || CASE rule
               WHEN 'DQ-9' THEN ' rows with unexpected NAME values (' || n_values || ' different)'
               WHEN 'DQ-10' THEN ' IGN_CYL rows with unexpected VAL (' || n_values || ' different)'
               WHEN 'DQ-11' THEN ' CHARGE_STATE rows with non-numeric VAL'
               ELSE ' EV_CHARGE_STATE rows with unexpected VAL (' || n_values || ' different)' END || ' — dropped.'
        FROM bad_trg_rules
        UNION ALL
        SELECT 13, 'DQ-13', '', a - b, 'TRG: ' || (a - b) || ' exact duplicate rows — deduplicated.'
        FROM (SELECT (SELECT count(*) FROM trg_valid) AS a, (SELECT count(*) FROM trg) AS b) WHERE a > b""",
    "dq_map": """
        SELECT 14 AS stage, row_ord AS k1, 0 AS k2, 'DQ-14' AS rule, vehicle_id AS item, 1 AS n_rows,
               'MAP: Vehicle ' || vehicle_id || ' has no PNIDs — will get events only from TLM/SYN.' AS detail
        FROM map_parsed WHERE IDS IS NULL
        UNION ALL
        SELECT 14, row_ord, 0, 'DQ-15', vehicle_id, 1,
               'MAP: Could not parse PNIDs for vehicle ' || vehicle_id || ': ''' || IDS || ''''
        FROM map_parsed WHERE IDS IS NOT NULL AND pnids IS NULL
        UNION ALL
        SELECT 16, row_ord, pos, 'DQ-16', CAST(pnid AS VARCHAR), 1,
               'MAP: PNID ' || pnid || ' maps to multiple vehicles: ' || previous || ' and ' || vehicle_id || '. Using latest.'
        FROM (SELECT *, lag(vehicle_id) OVER (PARTITION BY pnid ORDER BY row_ord, pos) AS previous FROM map_claims)
        WHERE previous IS NOT NULL""",
    "unmapped": """
        SELECT NAME AS rule, PNID AS value, count(*) AS n FROM mapped
        WHERE vehicle_id IS NULL AND NAME IN ('IGN_CYL', 'EV_CHARGE_STATE') GROUP BY ALL""",
    "dq_unmapped": """
        SELECT CASE rule WHEN 'IGN_CYL' THEN 18 ELSE 20 END AS stage,
               CASE rule WHEN 'IGN_CYL' THEN 'DQ-18' ELSE 'DQ-20' END AS rule, '' AS item, sum(n) AS n_rows,
               CASE rule WHEN 'IGN_CYL' THEN 'TRG→IGN: ' ELSE 'TRG→ChargeStatus: ' END || sum(n) || ' ' || rule
               || ' rows with unmapped PNIDs (' || count(*) || ' different) — dropped.' AS detail
        FROM unmapped AS m GROUP BY m.rule""",
    "dq_fusion": """
        SELECT 19 AS stage, 'DQ-19' AS rule, '' AS item, a - b AS n_rows,
               'Ignition fusion: ' || (a - b) || ' near-duplicate events removed (same vehicle + event within 10 s).' AS detail
        FROM (SELECT (SELECT count(*) FROM all_ign) AS a, (SELECT count(*) FROM fused) AS b) WHERE a > b""",
    "findings": """
        SELECT stage, 0 AS k1, 0 AS k2, rule, item, CAST(n_rows AS BIGINT) AS n_rows, detail FROM (
            SELECT * FROM dq_tlm WHERE stage < 7 UNION ALL SELECT * FROM dq_trg
            UNION ALL SELECT * FROM dq_unmapped UNION ALL SELECT * FROM dq_fusion)
        UNION ALL
        SELECT stage, list_position(['SPEED', 'IGNITION_STATUS', 'EV_BATTERY_LEVEL', 'ODOMETER'], item), 0,
               rule, item, n_rows, detail FROM dq_tlm WHERE stage = 7
        UNION ALL SELECT * FROM dq_map
        UNION ALL
        SELECT 17, 0, 0, 'DQ-17', '', count(*), 'SYN: ' || count(*) || ' rows with unparseable timestamps — dropped.'
        FROM syn_raw WHERE event_ts IS NULL HAVING count(*) > 0""",
    "numbered": "SELECT *, row_number() OVER (ORDER BY stage, k1, k2, rule, item) AS nth FROM findings",
    "shown_values": """
        SELECT rule, '''' || value || '''' AS shown, n_rows FROM bad_trg WHERE rule <> 'DQ-11'
        UNION ALL
        SELECT CASE rule WHEN 'IGN_CYL' THEN 'DQ-18' ELSE 'DQ-20' END, CAST(value AS VARCHAR), n FROM unmapped""",
    "minutes": "SELECT duration_sec / 60 AS x FROM sessions",
    "fences": """
        SELECT q1, med, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
        FROM (SELECT quantile_cont(delta_battery_pct, 0.25) AS q1, quantile_cont(delta_battery_pct, 0.5) AS med,
                     quantile_cont(delta_battery_pct, 0.75) AS q3 FROM sessions)""",
    "duration_fences": """
        SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
        FROM (SELECT quantile_cont(duration_sec, 0.25) AS q1, quantile_cont(duration_sec, 0.75) AS q3 FROM sessions)""",
    "report_lines": """
        SELECT nth, '' AS shown, nth || '. ' || detail || chr(10) AS value FROM numbered
        UNION ALL
        SELECT nth, shown, '    ' || shown || ' (' || v.n_rows || ' rows)' FROM shown_values AS v JOIN numbered USING (rule)""",
    "text_rejects": """
        SELECT 'TLM' AS feed, 'number' AS kind, 'SPEED' AS item, CAST(SPEED AS VARCHAR) || ' km/h' AS value
        FROM tlm_raw WHERE row_ord % 31 = 0 AND SPEED IS NOT NULL
        UNION ALL
        SELECT 'TLM', 'number', 'ODOMETER', '12,5' FROM tlm_raw
        WHERE row_ord % 46 = 0 AND ODOMETER IS NOT NULL AND (row_ord % 59 <> 0 OR row_ord % 53 = 0)
        UNION ALL
        SELECT 'TLM', 'malformed', '', CAST(CASE WHEN row_ord % 53 = 0 THEN 8 ELSE 6 END
               + CASE WHEN row_ord % 46 = 0 AND row_ord % 53 = 0 AND ODOMETER IS NOT NULL THEN 1 ELSE 0 END AS VARCHAR)
        FROM tlm_raw WHERE row_ord % 53 = 0 OR row_ord % 59 = 0
        UNION ALL
        SELECT 'TRG', 'number', 'PNID', 'P' || PNID FROM trg_raw WHERE row_ord % 83 = 0
        UNION ALL
        SELECT 'TRG', 'malformed', '', CASE WHEN row_ord % 53 = 0 THEN '4' ELSE '2' END
        FROM trg_raw WHERE row_ord % 53 = 0 OR row_ord % 59 = 0""",
    "points": """
        SELECT vehicle_id, start_ts AS ts, start_battery_pct AS battery FROM sessions
        UNION ALL SELECT vehicle_id, end_ts, end_battery_pct FROM sessions""",
}

_FINDING = "SELECT rule, item, CAST(n_rows AS BIGINT) AS n_rows, detail FROM "
_COUNT = "SELECT '{0}' AS step, count(*) AS n_rows, count(DISTINCT {2}) AS n_entities FROM {1}"

FINALS: dict[str, str] = {
    "tlm_clean": "SELECT * FROM tlm",
    "trg_clean": "SELECT * FROM trg",
    "syn_clean": "SELECT * FROM syn_raw WHERE event_ts IS NOT NULL",
    "map_parsed": "SELECT * FROM map_parsed",
    "pnid_map": "SELECT * FROM pnid_map",
    "trg_mapped": "SELECT * FROM mapped",
    "unmapped_pnids": "SELECT * FROM unmapped",
    "tlm_transitions": "SELECT * FROM tlm_ign",
    "trg_transitions": "SELECT * FROM trg_ign",
    "syn_events": "SELECT * FROM syn_ign",
    "ignition_union": "SELECT * FROM all_ign",
    "fused_ignition": "SELECT * FROM fused",
    "charging_status_events": "SELECT * FROM status",
    "battery_timeline": "SELECT * FROM timeline",
    "ignition_with_battery": "SELECT * FROM fused LEFT JOIN nearest USING (vehicle_id, event_ts)",
    "status_with_battery": "SELECT * FROM status LEFT JOIN nearest USING (vehicle_id, event_ts)",
    "battery_association_rate": """
        SELECT count(battery_pct) AS associated, count(*) AS total, 100 * count(battery_pct) / count(*) AS pct
        FROM fused LEFT JOIN nearest USING (vehicle_id, event_ts)""",
    "charge_pairs": "SELECT * FROM pairs",
    "charging_sessions_raw": "SELECT * FROM raw_sessions",
    "charging_sessions_merged": "SELECT * FROM merged",
    "charging_events": "SELECT * FROM sessions",
    "dq_tlm": _FINDING + "dq_tlm",
    "tlm_null_ratio": "SELECT * FROM null_ratio",
    "dq_trg": _FINDING + "dq_trg",
    "dq_map": _FINDING + "dq_map",
    "dq_syn": """
        SELECT 'DQ-17' AS rule, '' AS item, count(*) AS n_rows,
               'SYN: ' || count(*) || ' rows with unparseable timestamps — dropped.' AS detail
        FROM syn_raw WHERE event_ts IS NULL HAVING count(*) > 0""",
    "dq_unmapped": _FINDING + "dq_unmapped",
    "dq_fusion": _FINDING + "dq_fusion",
    "dq_offending_values": """
        SELECT * FROM bad_trg
        UNION ALL
        SELECT CASE rule WHEN 'IGN_CYL' THEN 'DQ-18' ELSE 'DQ-20' END, CAST(value AS VARCHAR), n FROM unmapped""",
    "dq_report": """
        SELECT row_number() OVER (ORDER BY nth, shown) - 1 AS line_no, value FROM (
            SELECT nth, '' AS shown, nth || '. ' || detail || chr(10) AS value FROM numbered
            UNION ALL
            SELECT nth, shown, '    ' || shown || ' (' || v.n_rows || ' rows)' FROM shown_values AS v JOIN numbered USING (rule))""",
    "pipeline_counts": "\nUNION ALL\n".join(
        _COUNT.format(*x)
        for x in [
            ("tlm", "tlm", "VEHICLE_ID"), ("trg", "trg", "PNID"), ("map", "pnid_map", "vehicle_id"),
            ("syn", "syn", "vehicle_id"), ("tlm_ignition", "tlm_ign", "vehicle_id"),
            ("trg_ignition", "trg_ign", "vehicle_id"), ("syn_ignition", "syn_ign", "vehicle_id"),
            ("fused_ignition", "fused", "vehicle_id"), ("charging_status", "status", "vehicle_id"),
            ("battery_timeline", "timeline", "vehicle_id"), ("charging_events", "sessions", "vehicle_id"),
        ]
    ),
    "run_summary": """
        SELECT 'Ignition Events' AS metric, count(*) AS value FROM fused
        UNION ALL SELECT 'Charging Status Events', count(*) FROM status
        UNION ALL SELECT 'Charging Events', count(*) FROM sessions
        UNION ALL SELECT 'Data Quality Findings', count(*) FROM findings""",
    "tlm_text_clean": "SELECT * EXCLUDE (row_ord) FROM tlm",
    "trg_text_clean": "SELECT * EXCLUDE (row_ord) FROM trg",
    "syn_text_clean": "SELECT vehicle_id, event_ts FROM syn_raw WHERE event_ts IS NOT NULL",
    "syn_lines_clean": "SELECT vehicle_id, event_ts FROM syn_raw WHERE event_ts IS NOT NULL",
    "map_text_parsed": "SELECT vehicle_id, pnids FROM map_parsed",
    "results_round_trip_csv": "SELECT vehicle_id, event, event_ts FROM fused",
    "results_round_trip_parquet": "SELECT * FROM sessions",
    "status_round_trip_csv": "SELECT vehicle_id, event, event_ts FROM status",
    "report_file": """
        SELECT unnest(string_split(value, chr(10))) AS value FROM (
            SELECT value FROM report_lines
            UNION ALL SELECT 'DATA QUALITY REPORT' UNION ALL SELECT repeat('=', 60) || chr(10))""",
    "empty_sessions_file": """
        SELECT 'vehicle_id,start_ts,end_ts,delta_battery_pct,start_battery_pct,end_battery_pct,duration_sec,ignition_state' AS value
        FROM ev LIMIT 1""",
    "status_battery_default": "SELECT *, CAST(NULL AS DOUBLE) AS battery_pct FROM status",
    "tlm_lines_clean": "SELECT * EXCLUDE (row_ord) FROM tlm",
    "tlm_inferred_clean": "SELECT * EXCLUDE (row_ord) FROM tlm",
    "trg_inferred_clean": "SELECT * EXCLUDE (row_ord) FROM trg",
    "dq_text_faults": """
        SELECT CASE kind WHEN 'number' THEN 'NUMBER' ELSE 'MALFORMED' END AS rule, item, count(*) AS n_rows,
               CASE kind WHEN 'number' THEN feed || ': Column ''' || item || ''' has ' || count(*) || ' unreadable numbers — treated as missing.'
               ELSE feed || ': ' || count(*) || ' malformed records — extra cells dropped, missing ones empty.' END AS detail
        FROM text_rejects GROUP BY feed, kind, item""",
    "dq_formats": """
        SELECT 'FORMAT' AS rule, item, n AS n_rows, feed || ': Day and month of column ''' || item || ''' could be swapped in all '
               || n || ' values — read as M/d/yyyy[ H:mm[:ss[.SSSSSS]]].' AS detail
        FROM (SELECT 'TLM' AS feed, 'TIMESTAMP' AS item, count("TIMESTAMP") AS n FROM tlm_raw
              UNION ALL SELECT 'TRG', 'CTS', count(CTS) FROM trg_raw
              UNION ALL SELECT 'SYN', 'timestamp', count(event_ts) FROM syn_raw)""",
    "rejected_cells": "SELECT * FROM text_rejects",
    "charts_from_results": "SELECT vehicle_id, ts, round(avg(battery), 6) AS battery FROM points GROUP BY ALL",
    "viz_ignition_timeline": """
        SELECT event_ts, vehicle_id, dense_rank() OVER (ORDER BY vehicle_id) - 1 AS vehicle_index, event FROM fused""",
    "viz_duration_hist": """
        SELECT CAST(b AS INTEGER) AS bin, round(lo + b * w, 6) AS bin_start, round(lo + (b + 1) * w, 6) AS bin_end,
               count(x) AS n
        FROM (SELECT min(x) AS lo, (max(x) - min(x)) / 30 AS w FROM minutes) AS r
        CROSS JOIN range(30) AS bins(b)
        LEFT JOIN minutes ON least(CAST(floor((x - lo) / w) AS BIGINT), 29) = b
        GROUP BY b, lo, w""",
    "viz_duration_kde": """
        SELECT CAST(i AS INTEGER) AS i, round(lo + i * ((hi - lo) / 199), 6) AS x,
               round(sum(exp(-0.5 * pow((lo + i * ((hi - lo) / 199) - m.x) / bw, 2)))
                     / (bw * sqrt(2 * pi())) * ((hi - lo) / 30), 6) AS density
        FROM (SELECT min(x) AS lo, max(x) AS hi, stddev_samp(x) * pow(count(*), -0.2) AS bw FROM minutes) AS r
        CROSS JOIN range(200) AS g(i) CROSS JOIN minutes AS m
        GROUP BY i, lo, hi, bw""",
    "viz_gain_box": """
        SELECT round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
               round(min(delta_battery_pct) FILTER (WHERE delta_battery_pct BETWEEN low AND high), 6) AS whisker_low,
               round(max(delta_battery_pct) FILTER (WHERE delta_battery_pct BETWEEN low AND high), 6) AS whisker_high,
               count(*) AS n
        FROM sessions CROSS JOIN fences GROUP BY ALL""",
    "viz_gain_outliers": """
        SELECT vehicle_id, start_ts, delta_battery_pct FROM sessions CROSS JOIN fences
        WHERE delta_battery_pct < low OR delta_battery_pct > high""",
    "viz_gain_outliers_narrow": """
        SELECT vehicle_id, start_ts, delta_battery_pct FROM sessions CROSS JOIN fences
        WHERE delta_battery_pct < q1 - 0.25 * (q3 - q1) OR delta_battery_pct > q3 + 0.25 * (q3 - q1)""",
    "viz_duration_outliers": """
        SELECT vehicle_id, start_ts, duration_sec FROM sessions CROSS JOIN duration_fences
        WHERE duration_sec < low OR duration_sec > high""",
    "viz_sessions_per_vehicle": "SELECT vehicle_id, count(*) AS n_sessions FROM sessions GROUP BY vehicle_id",
    "viz_duration_vs_gain": """
        SELECT vehicle_id, round(duration_sec / 60, 6) AS duration_min, delta_battery_pct FROM sessions""",
    "viz_hour_heatmap": "SELECT vehicle_id, " + ", ".join(
        f"count(*) FILTER (WHERE hour(start_ts) = {h}) AS h{h:02d}" for h in range(24)
    ) + " FROM sessions GROUP BY vehicle_id",
    "viz_battery_points": "SELECT * FROM points",
    "viz_battery_line": "SELECT vehicle_id, ts, round(avg(battery), 6) AS battery FROM points GROUP BY ALL",
}


def _needed(sql: str, seen: set[str]) -> set[str]:
    for name in STEPS:
        if name not in seen and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            seen.add(name)
            _needed(STEPS[name], seen)
    return seen


def _complete(sql: str) -> str:
    needed = _needed(sql, set())
    steps = ",\n".join(f"{name} AS ({body})" for name, body in STEPS.items() if name in needed)
    return f"WITH RECURSIVE {steps}\n{sql}"


ORACLES: dict[str, str] = {name: _complete(sql) for name, sql in FINALS.items()}
