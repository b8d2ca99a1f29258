"""DuckDB text for every query that SQL can express.

All statements start from the same prefix: the event adapter (``raw``), typing
(``typed``), validity (``valid``) and de-duplication (``flows``).
"""

from __future__ import annotations

_PREFIX = """
WITH b AS (SELECT event_id, user_id, event_type, value, ts,
                  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events),
f AS (SELECT event_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
  CASE WHEN event_id % 97 = 0 THEN ''
       WHEN user_id % 15 = 0 THEN concat('172.16.1.', CAST(k % 10 AS VARCHAR))
       ELSE concat('10.', CAST(user_id // 256 AS VARCHAR), '.', CAST(user_id % 256 AS VARCHAR), '.', CAST(day(ts) AS VARCHAR)) END AS source_ip,
  concat('172.16.1.', CAST((event_id * 7 + k) % 20 AS VARCHAR)) AS destination_ip,
  CASE event_id % 3 WHEN 0 THEN ' tcp' WHEN 1 THEN 'UDP' ELSE 'Icmp ' END AS protocol,
  CASE WHEN event_id % 89 = 0 THEN '-1' WHEN event_id % 83 = 0 THEN 'n/a'
       ELSE CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR) END AS flow_duration,
  CAST(40 + k * 14 AS VARCHAR) AS packet_length,
  CAST((40 + k * 14) * (1 + event_id % 500) AS VARCHAR) AS total_bytes,
  CAST(1 + event_id % 500 AS VARCHAR) AS packet_count,
  CASE event_type WHEN 'view' THEN 'BENIGN' WHEN 'error' THEN 'DDoS' WHEN 'click' THEN ' PortScan'
       WHEN 'signup' THEN 'Botnet' ELSE 'BruteForce' END AS attack_type,
  CASE event_type WHEN 'view' THEN 'Low'
       WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'Low' ELSE 'Medium' END
       WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'Medium' ELSE 'High' END
       ELSE CASE WHEN event_id % 2 = 0 THEN 'High' ELSE 'Critical' END END AS severity
  FROM b),
raw AS (SELECT * EXCLUDE (event_id) FROM f UNION ALL SELECT * EXCLUDE (event_id) FROM f WHERE event_id % 50 = 0),
typed AS (SELECT try_strptime(timestamp, '%Y-%m-%d %H:%M:%S') AS ts,
  trim(source_ip) AS source_ip, trim(destination_ip) AS destination_ip, upper(trim(protocol)) AS protocol,
  coalesce(try_cast(flow_duration AS BIGINT), try_cast(trunc(try_cast(flow_duration AS DOUBLE)) AS BIGINT)) AS flow_duration, coalesce(try_cast(packet_length AS BIGINT), try_cast(trunc(try_cast(packet_length AS DOUBLE)) AS BIGINT)) AS packet_length,
  coalesce(try_cast(total_bytes AS BIGINT), try_cast(trunc(try_cast(total_bytes AS DOUBLE)) AS BIGINT)) AS total_bytes, coalesce(try_cast(packet_count AS BIGINT), try_cast(trunc(try_cast(packet_count AS DOUBLE)) AS BIGINT)) AS packet_count,
  trim(attack_type) AS attack_type, trim(severity) AS severity FROM raw),
valid AS (SELECT * FROM typed WHERE source_ip <> '' AND destination_ip <> '' AND attack_type <> ''
  AND flow_duration >= 0 AND packet_length >= 0 AND total_bytes >= 0 AND packet_count >= 0),
ranked AS (SELECT *, row_number() OVER (
  PARTITION BY ts, source_ip, destination_ip, protocol, flow_duration, total_bytes
  ORDER BY attack_type, severity, packet_length, packet_count) AS rn FROM valid),
flows AS (SELECT source_ip, destination_ip, protocol, flow_duration, packet_length, total_bytes, packet_count,
  attack_type, severity, ts AS timestamp, CAST(hour(ts) AS INT) AS hour, CAST(dayofweek(ts) + 1 AS INT) AS day_of_week
  FROM ranked WHERE rn = 1)
"""

# Named building blocks appended to the prefix where a statement needs them.
_PARTS = {
    "attacks": "attacks AS (SELECT * FROM flows WHERE attack_type <> 'BENIGN')",
    "dist": """dist AS (SELECT attack_type, count(*) AS total_flows,
  round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct_share,
  round(avg(CASE severity WHEN 'Critical' THEN 4 WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END), 2) AS avg_severity_score,
  round(sum(flow_duration) / count(*), 2) AS avg_flow_duration_ms,
  round(sum(packet_length) / count(*), 2) AS avg_packet_length,
  round(sum(total_bytes) / 1073741824, 6) AS total_bytes_gb
  FROM flows GROUP BY attack_type)""",
    "sev": """sev AS (SELECT severity, count(*) AS total_flows,
  round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct_share FROM flows GROUP BY severity)""",
    "hourly": """hourly AS (SELECT hour, count(*) AS total_flows,
  count(*) FILTER (attack_type <> 'BENIGN') AS attack_flows, count(*) FILTER (attack_type = 'BENIGN') AS benign_flows,
  round(sum(flow_duration) / count(*), 2) AS avg_flow_duration_ms,
  round(count(*) FILTER (attack_type <> 'BENIGN') / count(*) * 100, 2) AS attack_rate_pct
  FROM flows GROUP BY hour)""",
    "modal": """modal AS (SELECT source_ip, attack_type AS top_attack_type, n AS flows FROM (
  SELECT source_ip, attack_type, count(*) AS n,
    row_number() OVER (PARTITION BY source_ip ORDER BY count(*) DESC, attack_type) AS rn
  FROM attacks GROUP BY source_ip, attack_type) WHERE rn = 1)""",
    "attackers": """attackers AS (SELECT source_ip, count(*) AS attack_flow_count,
  round(sum(total_bytes) / 1048576, 4) AS total_bytes_sent_mb, count(DISTINCT attack_type) AS unique_attack_types,
  round(sum(packet_length) / count(*), 2) AS avg_packet_length FROM attacks GROUP BY source_ip)""",
    "crosstab": """crosstab AS (SELECT source_ip, attack_type, count(*) AS flows FROM attacks
  WHERE source_ip IN (SELECT source_ip FROM attackers ORDER BY attack_flow_count DESC, source_ip LIMIT 20) GROUP BY 1, 2)""",
    "top50": """top50 AS (SELECT a.*, m.top_attack_type FROM attackers a LEFT JOIN modal m USING (source_ip)
  ORDER BY attack_flow_count DESC, source_ip LIMIT 50)""",
    "targets50": """targets50 AS (SELECT destination_ip, count(*) AS attack_flow_count,
  count(DISTINCT source_ip) AS unique_attackers, count(DISTINCT attack_type) AS unique_attack_types,
  round(sum(total_bytes) / 1048576, 4) AS total_bytes_received_mb
  FROM attacks GROUP BY destination_ip ORDER BY attack_flow_count DESC, destination_ip LIMIT 50)""",
    "signals": """signals AS (SELECT source_ip, count(*) AS total_flows,
  count(*) FILTER (attack_type <> 'BENIGN') AS attack_count, count(DISTINCT destination_ip) AS unique_destinations,
  count(DISTINCT attack_type) AS unique_attack_types,
  max(CASE attack_type WHEN 'DDoS' THEN 40 WHEN 'Botnet' THEN 30 WHEN 'BruteForce' THEN 25 WHEN 'PortScan' THEN 15 ELSE 0 END) AS max_severity_weight,
  round(sum(total_bytes) / count(*), 2) AS avg_bytes_per_flow FROM flows GROUP BY source_ip)""",
    "risk": """scored AS (SELECT *, CAST(CASE WHEN attack_count = 0 THEN 10 ELSE least(100,
    CASE WHEN attack_count >= 10 THEN 40 ELSE attack_count * 4 END + max_severity_weight +
    CASE WHEN unique_destinations >= 5 THEN 20 ELSE unique_destinations * 4 END) END AS BIGINT) AS risk_score FROM signals),
risk AS (SELECT source_ip, total_flows, attack_count, unique_destinations, risk_score,
  CASE WHEN risk_score >= 76 THEN 'Critical' WHEN risk_score >= 51 THEN 'High' WHEN risk_score >= 26 THEN 'Medium' ELSE 'Low' END AS risk_level,
  CASE WHEN risk_score >= 76 THEN 'Auto-Block & Quarantine' WHEN risk_score >= 51 THEN 'Active Firewall Throttle'
       WHEN risk_score >= 26 THEN 'Rate-limit & Deep Inspection' ELSE 'Standard Network Monitoring' END AS recommended_action
  FROM scored)""",
    "links": "links AS (SELECT source_ip, destination_ip, count(*) AS flows FROM attacks GROUP BY 1, 2)",
    "edges": """edges AS (SELECT source_ip, destination_ip, attack_type, count(*) AS flows,
  round(sum(total_bytes) / 1073741824, 6) AS bytes_gb FROM attacks GROUP BY 1, 2, 3)""",
    "degree": """degree AS (SELECT host, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree,
  CASE WHEN sum(i) = 0 THEN 'Adversary' WHEN sum(o) = 0 THEN 'Target' ELSE 'Pivot' END AS role
  FROM (SELECT source_ip AS host, 0 AS i, 1 AS o FROM links UNION ALL SELECT destination_ip, 1, 0 FROM links) GROUP BY host),
pivots AS (SELECT host FROM degree WHERE role = 'Pivot')""",
    "entropy": """symbols AS (SELECT time_bucket(INTERVAL '1 hour', timestamp) AS window_start, packet_length, count(*) AS n
  FROM flows GROUP BY 1, 2),
shares AS (SELECT *, n / sum(n) OVER (PARTITION BY window_start) AS p FROM symbols),
h AS (SELECT window_start, CAST(sum(n) AS BIGINT) AS flows, count(*) AS distinct_lengths, -sum(p * log2(p)) AS h
  FROM shares GROUP BY window_start),
entropy AS (SELECT window_start, flows, distinct_lengths, round(h, 4) + 0.0::DOUBLE AS entropy FROM h)""",
    "index": """protocol_rank AS (SELECT protocol, row_number() OVER (ORDER BY count(*) DESC, protocol) - 1 AS protocol_index FROM flows GROUP BY protocol),
severity_rank AS (SELECT severity, row_number() OVER (ORDER BY count(*) DESC, severity) - 1 AS severity_index FROM flows GROUP BY severity),
label_rank AS (SELECT attack_type, row_number() OVER (ORDER BY count(*) DESC, attack_type) - 1 AS label FROM flows GROUP BY attack_type),
indexed AS (SELECT flows.*, CAST(protocol_index AS DOUBLE) AS protocol_index, CAST(severity_index AS DOUBLE) AS severity_index,
  CAST(label AS DOUBLE) AS label FROM flows JOIN protocol_rank USING (protocol) JOIN severity_rank USING (severity)
  JOIN label_rank USING (attack_type))""",
    "split": """bucketed AS (SELECT *, concat_ws('|', strftime(timestamp, '%Y-%m-%d %H:%M:%S'), source_ip, destination_ip, protocol,
  CAST(flow_duration AS VARCHAR), CAST(total_bytes AS VARCHAR), '42') AS split_key FROM flows),
splits AS (SELECT * EXCLUDE (split_key), CAST({MOD:split_key:100} AS INT) AS split_bucket FROM bucketed)""",
    "technique": """technique(attack_key, tactic, technique_id, technique_name, tactical_description, detection_signature,
  recommended_containment) AS (VALUES
  ('PortScan', 'Reconnaissance / Discovery', 'T1046', 'Network Service Discovery',
   'Adversary actively probes network ports to establish reachable listening services prior to targeted exploitation.',
   'Threshold surge of TCP SYN packets with sequential dest_port cycling within < 15ms windows.',
   'TCP SYN Cookie Enforcement & IP Rate-Limiting'),
  ('DDoS', 'Impact', 'T1498', 'Network Denial of Service',
   'Volumetric amplification targeting bandwidth and router state tables to degrade infrastructure availability.',
   'Abnormal UDP/ICMP byte surges (> 2.5 MB/flow) coupled with high packet density.',
   'BGP Flowspec Null-Route & Anycast Edge Blackhole'),
  ('BruteForce', 'Credential Access', 'T1110', 'Brute Force / Password Spraying',
   'Repetitive authentication attempts targeting administrative remote services (SSH, RDP, HTTPS portal).',
   'Long session flow duration with high packet count and small asymmetric response frames.',
   'Host Credential Quarantine & Stateful Session Reset'),
  ('Botnet', 'Command and Control / Execution', 'T1584', 'Compromise Infrastructure / C2 Channel',
   'Coordinated zombie node establishing encrypted or DNS-covert beacons to command and control infrastructure.',
   'Intermittent periodic beaconing cycles and known malicious ASN autonomous cluster signatures.',
   'DNS Sinkholing, C2 Quarantine & BGP Edge Blacklist'),
  ('BENIGN', 'Legitimate Traffic', 'T0000', 'Standard Enterprise Protocol',
   'Verified regular operational telemetry complying with standard baseline network profile.',
   'Balanced packet length, verified handshake completion, and nominal duration.',
   'Standard Routing - Whitelisted in SOC Gateway'))""",
    "place": """place(bucket, country, country_code, city, lat, lon, asn) AS (VALUES
  (0, 'United States', 'USA', 'Ashburn, VA', 39.0438::DOUBLE, -77.4874::DOUBLE, 'AS16509 Amazon AWS'),
  (1, 'China', 'CHN', 'Shenzhen', 22.5431, 114.0579, 'AS4134 Chinanet'),
  (2, 'Russia', 'RUS', 'Moscow', 55.7558, 37.6173, 'AS12389 Rostelecom'),
  (3, 'Germany', 'DEU', 'Frankfurt', 50.1109, 8.6821, 'AS24940 Hetzner Online'),
  (4, 'Netherlands', 'NLD', 'Amsterdam', 52.3676, 4.9041, 'AS60781 LeaseWeb'),
  (5, 'Brazil', 'BRA', 'Sao Paulo', -23.5505, -46.6333, 'AS28573 Claro Brasil'),
  (6, 'India', 'IND', 'Mumbai', 19.0760, 72.8777, 'AS45609 Bharti Airtel'),
  (7, 'United Kingdom', 'GBR', 'London', 51.5074, -0.1278, 'AS5413 British Telecom'),
  (8, 'Japan', 'JPN', 'Tokyo', 35.6762, 139.6503, 'AS2516 KDDI Corp'),
  (9, 'South Korea', 'KOR', 'Seoul', 37.5665, 126.9780, 'AS9318 SK Broadband'))""",
    "geo": """actors AS (SELECT *, {MOD:source_ip:70000} AS h FROM risk),
geo AS (SELECT source_ip, country, country_code, city, asn,
  round(lat + (h % 100 - 50) * 0.03::DOUBLE, 4) AS latitude, round(lon + (h // 100 % 100 - 50) * 0.03::DOUBLE, 4) AS longitude,
  CASE h // 10 % 4 WHEN 0 THEN 'DDoS' WHEN 1 THEN 'PortScan' WHEN 2 THEN 'BruteForce' ELSE 'Botnet' END AS attack_type,
  CAST(total_flows * 14 + h % 35 + 5 AS BIGINT) AS flows_detected, risk_score, risk_level,
  '10.0.0.0/8 (Core Enterprise DMZ)' AS target_subnet FROM actors JOIN place ON bucket = h % 10)""",
    "rules": """verdicts AS (SELECT *, CASE WHEN total_bytes > 1200000 OR packet_count > 600 THEN 'DDoS'
  WHEN flow_duration < 15000 AND packet_count > 100 THEN 'PortScan'
  WHEN total_bytes > 500000 AND protocol = 'TCP' THEN 'BruteForce'
  WHEN packet_count < 50 AND total_bytes < 50000 THEN 'BENIGN' ELSE 'Botnet' END AS predicted_attack FROM flows),
facts(predicted_attack, confidence, tier, action) AS (VALUES
  ('DDoS', 98.6::DOUBLE, 'Critical', 'BGP Flowspec Rate-Limit and Drop'),
  ('PortScan', 96.8, 'Medium', 'TCP SYN Cookie Challenge & Firewall Drop'),
  ('BruteForce', 95.2, 'High', 'Endpoint Account Lockdown & Source Throttling'),
  ('BENIGN', 99.4, 'Low', 'Normal Business Routing'),
  ('Botnet', 93.1, 'High', 'C2 Domain Isolation & Host Quarantine'))""",
}

# What each block builds on.
_NEEDS = {
    "located": ["risk"], "all_levels": ["links"], "hourly_levels": ["attacks"], "damaged_valid": ["damaged"],
    "modal": ["attacks"], "attackers": ["attacks"], "top50": ["attackers", "modal"], "crosstab": ["attackers"],
    "targets50": ["attacks"], "risk": ["signals"], "links": ["attacks"], "edges": ["attacks"],
    "degree": ["links"], "geo": ["risk", "place"],
}


def md5_chunk(text: str, index: int) -> str:
    return f"CAST('0x' || substr(md5({text}), {1 + 8 * index}, 8) AS BIGINT)"


def md5_mod(text: str, modulus: int) -> str:
    residue = f"({md5_chunk(text, 0)} % {modulus})"
    for index in (1, 2, 3):
        residue = f"(({residue} * {2**32 % modulus} + {md5_chunk(text, index)}) % {modulus})"
    return residue


def _expand(text: str) -> str:
    """Fill ``{MOD:column:modulus}`` marks."""
    while "{MOD:" in text:
        before, rest = text.split("{MOD:", 1)
        mark, after = rest.split("}", 1)
        column, modulus = mark.split(":")
        text = before + md5_mod(column, int(modulus)) + after
    return text


def statement(select: str, *parts: str) -> str:
    """A full statement: prefix, the named blocks with all they build on, the final SELECT."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in parts:
        add(name)
    prefix = _PREFIX.strip()
    if any(name.endswith("_levels") for name in ordered):
        prefix = prefix.replace("WITH", "WITH RECURSIVE", 1)
    blocks = [prefix] + [_expand(_PARTS[name]) for name in ordered]
    return ",\n".join(blocks) + "\n" + _expand(select.strip())


def _add_parts() -> None:
    """Blocks that are made of the texts above."""
    readable = "coalesce(try_cast({0} AS BIGINT), try_cast(trunc(try_cast({0} AS DOUBLE)) AS BIGINT))"
    metrics = [readable.format(c) + " >= 0" for c in ("flow_duration", "packet_length", "total_bytes", "packet_count")]
    _PARTS.update({
        "located": _NETWORKS,
        "all_levels": _LEVELS.format(links=_ALL_LINKS),
        "hourly_levels": _LEVELS.format(links=_HOURLY_LINKS),
        "damaged": _DAMAGED,
        "damaged_valid": f"damaged_valid AS (SELECT * FROM damaged WHERE NOT short AND NOT long AND source_ip <> '' AND {' AND '.join(metrics)})",
        "timed": _TIMED,
    })


def _counts(named: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS {{key}}, count(*) AS {{n}} FROM {table}" for name, table in named.items())


_RULE_TEXT = """
SELECT source_ip, attack_type, concat(name, ' firewall rule for ', source_ip) AS firewall_rule,
  concat(name, ' detection rule for ', source_ip) AS ids_rule,
  concat(name, ' route ', substr(md5(source_ip), 1, 6), ' for ', source_ip) AS bgp_rule
FROM (SELECT DISTINCT source_ip, attack_type,
  CASE WHEN attack_type IN ('PortScan', 'DDoS', 'BruteForce', 'Botnet', 'BENIGN') THEN attack_type ELSE 'DDoS' END AS name FROM flows)
"""

# Outcomes of the threshold classifier, and its rates per class.
_RULE_RATES = """oc AS (SELECT attack_type AS actual, predicted_attack AS predicted, count(*) AS n FROM verdicts GROUP BY 1, 2),
sums AS (SELECT attack_type, coalesce((SELECT sum(n) FROM oc WHERE actual = attack_type), 0) AS support,
  coalesce((SELECT sum(n) FROM oc WHERE predicted = attack_type), 0) AS predicted,
  coalesce((SELECT sum(n) FROM oc WHERE predicted = attack_type AND actual = attack_type), 0) AS hits FROM label_rank),
rates AS (SELECT *, coalesce(hits / nullif(predicted, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r FROM sums),
rated AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM rates)"""


_EIGHT = {
    "attack_stats": "dist", "protocol_stats": "(SELECT DISTINCT protocol FROM flows)", "hourly_stats": "hourly",
    "severity_stats": "sev", "ip_threat_frequency": "top50", "top_targeted_ips": "targets50",
    "timeline_stats": "hourly", "ip_reputation": "risk",
}
_EIGHT_PARTS = ("dist", "hourly", "sev", "top50", "crosstab", "targets50", "risk")
_PREVIEW = "(SELECT * FROM flows ORDER BY timestamp, source_ip, destination_ip, protocol, flow_duration, total_bytes LIMIT 500)"
_DAYS = "['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][day_of_week]"
_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
           "benchmark labels conversations").split()
_RAW_NULLS = ("SELECT timestamp, nullif(source_ip, '') AS source_ip, destination_ip, protocol, flow_duration, packet_length, "
              "total_bytes, packet_count, attack_type, severity FROM raw")
# Networks of the query, read from their text; a row whose text is no network is left out.
_NETWORKS = """given AS (
  SELECT CASE r_regionkey WHEN 0 THEN '10.0.0.0/8' WHEN 1 THEN '172.16.0.0/12' WHEN 2 THEN '172.16.1.4/30'
    WHEN 3 THEN '172.16.1.9/32' ELSE 'none' END AS cidr, r_name AS label, r_regionkey AS key FROM region
  UNION ALL SELECT concat('10.', n_nationkey % 4, '.', n_nationkey * 8, '.77/21'), n_name, 100 + n_nationkey FROM nation
  UNION ALL SELECT concat('10.', s_suppkey % 8, '.', s_suppkey * 37 % 256, '.0/24'), s_name, 1000 + s_suppkey FROM supplier
  UNION ALL SELECT concat('10.', c_custkey % 8, '.', c_custkey % 256, '.', c_custkey % 8 * 32, '/27'), c_name, 100000 + c_custkey FROM customer),
octets AS (SELECT *, string_split(split_part(cidr, '/', 1), '.') AS o, try_cast(split_part(cidr, '/', 2) AS INT) AS length FROM given),
read AS (SELECT *, ((o[1]::BIGINT * 256 + o[2]::BIGINT) * 256 + o[3]::BIGINT) * 256 + o[4]::BIGINT AS number FROM octets WHERE length IS NOT NULL),
nets AS (SELECT *, number - number % (1::BIGINT << (32 - length)) AS first, number - number % (1::BIGINT << (32 - length)) + (1::BIGINT << (32 - length)) - 1 AS last FROM read),
numbers AS (SELECT source_ip, ((split_part(source_ip, '.', 1)::BIGINT * 256 + split_part(source_ip, '.', 2)::BIGINT) * 256
  + split_part(source_ip, '.', 3)::BIGINT) * 256 + split_part(source_ip, '.', 4)::BIGINT AS n FROM risk),
placed AS (SELECT source_ip, concat(first >> 24, '.', (first >> 16) & 255, '.', (first >> 8) & 255, '.', first & 255, '/', length) AS network,
  label AS country, substr(label, 1, 3) AS country_code, concat('City of ', label) AS city,
  CAST(key AS DOUBLE) / 4 AS latitude, CAST(key AS DOUBLE) / 8 AS longitude, concat('AS', key) AS asn,
  row_number() OVER (PARTITION BY source_ip ORDER BY length DESC, label, key) AS rn
  FROM numbers JOIN nets ON n BETWEEN first AND last),
located AS (SELECT r.source_ip, network, country, country_code, city, latitude, longitude, asn, total_flows AS flows_detected, risk_score, risk_level
  FROM risk r LEFT JOIN (SELECT * FROM placed WHERE rn = 1) p USING (source_ip))"""
# Levels of hosts in graphs told apart by w: hops from the hosts that nobody attacks, then from the smallest hosts of cycles.
_LEVELS = """hops AS (SELECT DISTINCT w, a, b FROM {links} WHERE a <> b),
verts AS (SELECT w, a AS host FROM hops UNION SELECT w, b FROM hops),
mids AS (SELECT w, count(*) AS n FROM verts WHERE (w, host) IN (SELECT (w, a) FROM hops) GROUP BY w),
walk(w, host, level) AS (SELECT w, host, 0 FROM verts WHERE (w, host) NOT IN (SELECT (w, b) FROM hops)
  UNION SELECT h.w, h.b, level + 1 FROM walk k JOIN hops h ON h.w = k.w AND h.a = k.host WHERE level <= (SELECT n FROM mids m WHERE m.w = k.w)),
reached AS (SELECT w, host, min(level) AS level FROM walk GROUP BY 1, 2),
rest AS (SELECT * FROM verts WHERE (w, host) NOT IN (SELECT (w, host) FROM reached)),
among AS (SELECT * FROM hops WHERE (w, a) IN (SELECT (w, host) FROM rest) AND (w, b) IN (SELECT (w, host) FROM rest)),
reach(w, root, host) AS (SELECT w, host, host FROM rest UNION SELECT r.w, root, b FROM reach r JOIN among g ON g.w = r.w AND g.a = r.host),
labels AS (SELECT w, host, min(root) AS label FROM reach GROUP BY 1, 2),
round2(w, host, level) AS (SELECT w, host, 0 FROM labels WHERE label = host
  UNION SELECT g.w, g.b, level + 1 FROM round2 k JOIN among g ON g.w = k.w AND g.a = k.host WHERE level <= (SELECT n FROM mids m WHERE m.w = k.w)),
levels AS (SELECT * FROM reached UNION ALL SELECT w, host, min(level) FROM round2 GROUP BY 1, 2)"""
_ALL_LINKS = "(SELECT 0 AS w, source_ip AS a, destination_ip AS b FROM links)"
_HOURLY_LINKS = "(SELECT time_bucket(INTERVAL '1 hour', timestamp) AS w, source_ip AS a, destination_ip AS b FROM attacks WHERE timestamp IS NOT NULL)"
# The lines of the damaged logs: every record is repeated as often as in raw.
_DAMAGED = """damaged AS (SELECT f.*, event_id % 61 = 0 AS short, event_id % 61 <> 0 AND event_id % 67 = 0 AS long
  FROM f JOIN range(2) c(i) ON i = 0 OR event_id % 50 = 0)"""
# Valid flows of the stream of windows: what comes in the second run, for a window that the first one closed, is late.
_TIMED = """tenths AS (SELECT f.*, event_id % 10 = 0 AS tenth FROM f JOIN range(2) c(i) ON i = 0 OR event_id % 50 = 0),
arrived AS (SELECT tenth, try_strptime(timestamp, '%Y-%m-%d %H:%M:%S') AS ts, CAST(packet_length AS BIGINT) AS packet_length FROM tenths
  WHERE source_ip <> '' AND coalesce(try_cast(flow_duration AS BIGINT), try_cast(trunc(try_cast(flow_duration AS DOUBLE)) AS BIGINT)) >= 0),
timed AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, packet_length,
  tenth AND time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' <= (SELECT max(ts) - INTERVAL '1 hour' FROM arrived WHERE NOT tenth) AS late FROM arrived)"""
_CRITICAL = "(SELECT source_ip FROM risk WHERE risk_level = 'Critical')"


def _table_counts() -> str:
    each = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS records, "
        f"CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INT) AS fields" for t in _TABLES)
    derived = " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, count(*) AS records, CAST({fields} AS INT) AS fields FROM {source}"
        for label, source, fields in (("raw_flows", "raw", 10), ("flows", "flows", 12)))
    return statement(f"{derived} UNION ALL {each}")


def _quality() -> str:
    flow_checks = {f"{c}_missing": f"{c} IS NULL OR {c} = ''" for c in ("source_ip", "destination_ip", "attack_type")}
    flow_checks |= {f"{c}_negative": f"{c} < 0" for c in ("flow_duration", "packet_length", "total_bytes", "packet_count")}
    flow_checks |= {
        "protocol_not_upper": "protocol <> upper(protocol)", "hour_out_of_range": "hour NOT BETWEEN 0 AND 23",
        "day_of_week_out_of_range": "day_of_week NOT BETWEEN 1 AND 7"}
    risk_checks = {
        "risk_score_out_of_range": "risk_score NOT BETWEEN 0 AND 100",
        "risk_level_disagrees": "risk_level <> CASE WHEN risk_score >= 76 THEN 'Critical' WHEN risk_score >= 51 THEN 'High' WHEN risk_score >= 26 THEN 'Medium' ELSE 'Low' END",
        "action_disagrees": "recommended_action <> CASE risk_level WHEN 'Critical' THEN 'Auto-Block & Quarantine' WHEN 'High' THEN 'Active Firewall Throttle' WHEN 'Medium' THEN 'Rate-limit & Deep Inspection' ELSE 'Standard Network Monitoring' END"}
    rate_checks = {"attack_rate_out_of_range": "attack_rate_pct NOT BETWEEN 0 AND 100",
                   "flows_do_not_add_up": "attack_flows + benign_flows <> total_flows"}
    rows = []
    for label, source, checks in (("flows", "flows", flow_checks), ("ip_risk_scores", "risk", risk_checks),
                                  ("hourly_timeline", "hourly", rate_checks)):
        rows += [f"SELECT '{label}' AS table_name, '{name}' AS check_name, count(*) AS checked_rows, "
                 f"count(*) FILTER ({bad}) AS violations, count(*) FILTER ({bad}) = 0 AS passed FROM {source}"
                 for name, bad in checks.items()]
    return "\nUNION ALL ".join(rows)


def oracle_sql() -> dict[str, str]:
    _add_parts()
    s = statement
    distribution = ("SELECT * FROM dist", "dist")
    hourly_columns = "hour, total_flows, attack_flows, benign_flows, attack_rate_pct"
    features = ("CAST(flow_duration AS DOUBLE) AS flow_duration, CAST(packet_length AS DOUBLE) AS packet_length, "
                "CAST(total_bytes AS DOUBLE) AS total_bytes, CAST(packet_count AS DOUBLE) AS packet_count, "
                "CAST(hour AS DOUBLE) AS hour, CAST(day_of_week AS DOUBLE) AS day_of_week, protocol_index, severity_index")
    scaled = ", ".join(
        f"round(coalesce({c} / nullif(stddev_samp({c}) OVER (), 0), 0), 6) AS {c}"
        for c in ("flow_duration", "packet_length", "total_bytes", "packet_count", "hour", "day_of_week",
                  "protocol_index", "severity_index"))
    collection_counts = _counts(_EIGHT)
    manifest_counts = _counts(_EIGHT | {"predictions": "flows", "model_metrics": "(SELECT 1)"}).format(key="collection", n="documents")
    outputs = {
        "attack_distribution.parquet": "dist", "protocol_distribution.parquet": "(SELECT DISTINCT protocol FROM flows)",
        "hourly_attack_intensity.parquet": "hourly", "severity_distribution.parquet": "sev",
        "network_timeline_hourly.parquet": "hourly", "network_timeline_daily.parquet": "(SELECT DISTINCT day_of_week FROM flows)",
        "attack_surge_windows.parquet": "(SELECT DISTINCT coalesce(hour, 23) // 6 FROM flows)",
        "top_attacking_ips.parquet": "top50", "top_targeted_ips.parquet": "targets50",
        "ip_attack_crosstab.parquet": "crosstab",
        "ip_risk_scores.parquet": "risk", "total_records_analysed": "flows",
    }
    stream_incidents = f"""SELECT source_ip, coalesce(t.technique_id, 'T1498') AS technique_id, 'Hard Drop & BGP Null-Route' AS action_taken,
  ts AS timestamp, 'ENFORCED' AS status FROM valid LEFT JOIN technique t ON attack_key = attack_type WHERE source_ip IN {_CRITICAL}"""
    return {
        # sources
        "raw_flow_scan": s(_RAW_NULLS),
        "document_load": s("""SELECT timestamp, nullif(source_ip, '') AS source_ip, destination_ip, protocol,
  coalesce(try_cast(flow_duration AS BIGINT), try_cast(trunc(try_cast(flow_duration AS DOUBLE)) AS BIGINT)) AS flow_duration, coalesce(try_cast(packet_length AS BIGINT), try_cast(trunc(try_cast(packet_length AS DOUBLE)) AS BIGINT)) AS packet_length,
  coalesce(try_cast(total_bytes AS BIGINT), try_cast(trunc(try_cast(total_bytes AS DOUBLE)) AS BIGINT)) AS total_bytes, coalesce(try_cast(packet_count AS BIGINT), try_cast(trunc(try_cast(packet_count AS DOUBLE)) AS BIGINT)) AS packet_count, attack_type, severity FROM raw"""),
        "inline_rows": s("""SELECT i.event_id, i.protocol, i.attack_type, count(f.source_ip) AS flows
FROM (VALUES (1::BIGINT, 'TCP', 'BENIGN'), (2, 'UDP', 'DDoS'), (3, 'ICMP', 'PortScan')) i(event_id, protocol, attack_type)
LEFT JOIN flows f ON f.protocol = i.protocol AND f.attack_type = i.attack_type GROUP BY 1, 2, 3"""),
        "document_reload": s("""SELECT timestamp, destination_ip, coalesce(try_cast(flow_duration AS BIGINT), try_cast(trunc(try_cast(flow_duration AS DOUBLE)) AS BIGINT)) AS flow_duration,
  CAST(total_bytes AS BIGINT) AS total_bytes, 2 * count(*) AS copies FROM raw GROUP BY 1, 2, 3, 4"""),
        "rejected_rows": s("""SELECT CASE WHEN short THEN 'too few fields' ELSE 'too many fields' END AS reason,
  concat_ws(',', timestamp, source_ip, destination_ip, protocol, flow_duration, packet_length, total_bytes)
  || CASE WHEN short THEN '' ELSE concat(',', packet_count, ',', attack_type, ',', severity, ',x,y') END AS line, count(*) AS records
FROM damaged WHERE short OR long GROUP BY 1, 2""", "damaged"),
        "serving_read": s(*distribution),
        "table_counts": _table_counts(),
        "distributed_sum": "SELECT count(*) AS items, CAST(sum(event_id) AS BIGINT) AS total FROM events",
        # cleaning
        "typed_flows": s("SELECT * EXCLUDE (ts), ts AS timestamp FROM typed"),
        "valid_flows": s("SELECT * EXCLUDE (ts), ts AS timestamp FROM valid"),
        "temporal_features": s("""SELECT * EXCLUDE (ts), ts AS timestamp, CAST(hour(ts) AS INT) AS hour,
  CAST(dayofweek(ts) + 1 AS INT) AS day_of_week FROM valid"""),
        "clean_flows": s("SELECT * FROM flows"),
        "clean_funnel": s("""SELECT r AS raw_records, v AS valid_records, c AS clean_records, r - v AS invalid_dropped,
  v - c AS duplicates_dropped, r - c AS total_dropped FROM (SELECT (SELECT count(*) FROM raw) AS r,
  (SELECT count(*) FROM valid) AS v, (SELECT count(*) FROM flows) AS c)"""),
        "etl_funnel": s("""SELECT r AS raw_records, j AS rejected_records, v AS valid_records, c AS clean_records, r - v AS invalid_dropped,
  v - c AS duplicates_dropped, r - c AS total_dropped FROM (SELECT (SELECT count(*) FROM raw) AS r, (SELECT count(*) FROM damaged WHERE short OR long) AS j,
  (SELECT count(*) FROM damaged_valid) AS v, (SELECT count(DISTINCT (timestamp, source_ip, destination_ip, upper(trim(protocol)), flow_duration, total_bytes)) FROM damaged_valid) AS c)""",
            "damaged", "damaged_valid"),
        # distributions
        "attack_distribution": s(*distribution),
        "protocol_distribution": s("""SELECT protocol, count(*) AS total_flows, round(count(*) / sum(count(*)) OVER () * 100, 2) AS pct_share,
  count(*) FILTER (attack_type <> 'BENIGN') AS attack_count, count(*) FILTER (attack_type = 'BENIGN') AS benign_count
FROM flows GROUP BY protocol"""),
        "severity_distribution": s("SELECT * FROM sev", "sev"),
        "severity_ranked": s("""SELECT *, CAST(CASE severity WHEN 'Critical' THEN 0 WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 3 END AS INT)
  AS severity_rank FROM sev""", "sev"),
        "attack_overview_table": s("""SELECT attack_type AS "Attack Vector", total_flows AS "Telemetry Flows", pct_share AS "Traffic Share (%)",
  avg_severity_score AS "Severity Score (1-4)", total_bytes_gb AS "Bandwidth Consumed (GB)" FROM dist""", "dist"),
        "bandwidth_rank": s("SELECT attack_type, total_bytes_gb FROM dist", "dist"),
        "kpi_overview": s("""SELECT count(*) AS total_flows, count(*) FILTER (attack_type <> 'BENIGN') AS attack_flows,
  count(*) FILTER (attack_type = 'BENIGN') AS clean_flows,
  round(count(*) FILTER (attack_type <> 'BENIGN') / count(*) * 100, 1) AS attack_rate,
  count(DISTINCT source_ip) AS scored_actors FROM flows"""),
        "distinct_vectors": s("SELECT DISTINCT attack_type FROM flows WHERE attack_type IS NOT NULL"),
        # timelines
        "hourly_attack_intensity": s(f"SELECT {hourly_columns} FROM hourly", "hourly"),
        "hourly_timeline": s("SELECT * FROM hourly", "hourly"),
        "daily_cadence": s(f"""SELECT day_of_week, count(*) AS total_flows, count(*) FILTER (attack_type <> 'BENIGN') AS attack_flows,
  count(DISTINCT attack_type) AS unique_attack_types, {_DAYS} AS day_name,
  round(count(*) FILTER (attack_type <> 'BENIGN') / count(*) * 100, 2) AS attack_rate_pct FROM flows GROUP BY day_of_week"""),
        "surge_windows": s("""SELECT CASE WHEN hour < 6 THEN '00-05' WHEN hour < 12 THEN '06-11' WHEN hour < 18 THEN '12-17' ELSE '18-23' END AS surge_window,
  count(*) AS total_flows, count(*) FILTER (attack_type <> 'BENIGN') AS attack_flows,
  round(count(*) FILTER (attack_type <> 'BENIGN') / count(*) * 100, 2) AS attack_rate_pct FROM flows GROUP BY 1"""),
        # hosts
        "attack_flows": s("SELECT * FROM attacks", "attacks"),
        "top_attacking_ips": s("SELECT * FROM top50", "top50"),
        "top_attack_type": s("SELECT * FROM modal", "modal"),
        "attackers_with_modal_type": s("""SELECT source_ip, attack_count, m.top_attack_type FROM signals LEFT JOIN modal m USING (source_ip)""",
                                       "signals", "attacks", "modal"),
        "top_targeted_ips": s("SELECT * FROM targets50", "targets50"),
        "crosstab": s("SELECT * FROM crosstab", "crosstab"),
        "crosstab_columns": s("""SELECT source_ip, CAST(sum(flows) FILTER (attack_type = 'Botnet') AS BIGINT) AS "Botnet",
  CAST(sum(flows) FILTER (attack_type = 'BruteForce') AS BIGINT) AS "BruteForce", CAST(sum(flows) FILTER (attack_type = 'DDoS') AS BIGINT) AS "DDoS",
  CAST(sum(flows) FILTER (attack_type = 'PortScan') AS BIGINT) AS "PortScan",
  CAST(sum(flows) FILTER (attack_type NOT IN ('Botnet', 'BruteForce', 'DDoS', 'PortScan')) AS BIGINT) AS "Other"
FROM crosstab GROUP BY source_ip""".replace("CAST(sum(", "CAST(coalesce(sum(").replace(") AS BIGINT) AS", "), 0) AS BIGINT) AS"), "crosstab"),
        "blacklist_filter": s(f"SELECT * FROM flows WHERE source_ip NOT IN {_CRITICAL}", "risk"),
        # risk
        "ip_risk_scores": s("SELECT * FROM risk", "risk"),
        "ip_risk_signals": s("SELECT * FROM signals", "signals"),
        "ip_lookup": s("SELECT * FROM risk WHERE source_ip = '172.16.1.5'", "risk"),
        "top_risk_actors": s("SELECT * FROM risk ORDER BY risk_score DESC, attack_count DESC, source_ip LIMIT 100", "risk"),
        "risk_bounds": s("""SELECT min(risk_score) AS min_score, max(risk_score) AS max_score, count(DISTINCT risk_level) AS tiers,
  count(*) AS sources FROM risk""", "risk"),
        "reputation_export": s("SELECT * FROM risk", "risk"),
        # enrichment
        "mitre_enriched": s("""SELECT source_ip, attack_type, flows, tactic, technique_id, technique_name, tactical_description,
  detection_signature, recommended_containment
FROM (SELECT source_ip, attack_type, count(*) AS flows FROM flows GROUP BY 1, 2)
JOIN technique ON attack_key = CASE WHEN attack_type IN (SELECT attack_key FROM technique) THEN attack_type ELSE 'DDoS' END""", "technique"),
        "geo_by_network": s("SELECT * FROM located", "located"),
        "network_country_top": s("""SELECT country, CAST(sum(flows_detected) AS BIGINT) AS flows_detected FROM located GROUP BY country
  ORDER BY flows_detected DESC, country NULLS FIRST LIMIT 8""", "located"),
        "geo_enriched": s("SELECT * FROM geo", "geo"),
        "geo_filtered": s("SELECT * FROM geo WHERE attack_type = 'DDoS' AND risk_level = 'Critical'", "geo"),
        "geo_overview_table": s("""SELECT source_ip AS "Source IP", country AS "Country", city AS "Origin City", asn AS "Autonomous System (ASN)",
  attack_type AS "Vector", risk_score AS "Risk Score", risk_level AS "Risk Tier", flows_detected AS "Flow Volume",
  target_subnet AS "Target Destination" FROM geo""", "geo"),
        "country_top": s("SELECT country, CAST(sum(flows_detected) AS BIGINT) AS flows_detected FROM geo GROUP BY country ORDER BY 2 DESC, 1 LIMIT 8", "geo"),
        "asn_top": s("SELECT asn, CAST(sum(flows_detected) AS BIGINT) AS flows_detected FROM geo GROUP BY asn ORDER BY 2 DESC, 1 LIMIT 8", "geo"),
        "mitigation_rules": s(_RULE_TEXT),
        # verdicts
        "rule_classifier": s("""SELECT timestamp, source_ip, destination_ip, attack_type AS actual_attack, predicted_attack, confidence, tier, action
FROM verdicts JOIN facts USING (predicted_attack)""", "rules"),
        "severity_rule": s("""SELECT *, CASE WHEN top_attack_type = 'PortScan' THEN CASE WHEN confidence > 75 THEN 'Medium' ELSE 'Low' END
  WHEN top_attack_type IN ('Botnet', 'BruteForce') THEN CASE WHEN confidence > 70 THEN 'High' ELSE 'Medium' END
  ELSE CASE WHEN confidence > 80 THEN 'Critical' ELSE 'High' END END AS severity
FROM (SELECT source_ip, top_attack_type, round(m.flows / a.attack_flow_count * 100, 2) AS confidence
  FROM modal m JOIN attackers a USING (source_ip))""", "modal", "attackers"),
        # graph
        "graph_edges": s("SELECT * FROM edges", "edges"),
        "graph_degree": s("SELECT * FROM degree", "degree"),
        "graph_pivots": s("SELECT host, in_degree, out_degree, CAST(in_degree * out_degree AS DOUBLE) AS two_hop_walks FROM degree WHERE role = 'Pivot'", "degree"),
        "graph_summary": s("""SELECT (SELECT count(*) FROM degree) AS vertices, (SELECT count(*) FROM links) AS edges,
  (SELECT count(*) FROM pivots) AS pivots,
  (SELECT CAST(count(*) AS DOUBLE) FROM links a JOIN links b ON a.destination_ip = b.source_ip) AS two_hop_walks,
  (SELECT coalesce(max(level), 0) FROM levels) AS max_depth""", "degree", "all_levels"),
        "graph_levels": s("SELECT host, level FROM levels", "all_levels"),
        "graph_depth": s("""SELECT w AS window_start, count(*) AS hosts, count(*) FILTER (level = 0) AS entry_points, max(level) AS max_depth
FROM levels GROUP BY w""", "hourly_levels"),
        "graph_edges_labeled": s("""SELECT e.*, a.role AS source_role, b.role AS destination_role FROM edges e
  JOIN degree a ON a.host = e.source_ip JOIN degree b ON b.host = e.destination_ip""", "edges", "degree"),
        "lateral_hops": s("""SELECT destination_ip AS pivot, 'ingress' AS hop, source_ip AS peer, flows FROM links WHERE destination_ip IN (SELECT host FROM pivots)
UNION ALL SELECT source_ip, 'egress', destination_ip, flows FROM links WHERE source_ip IN (SELECT host FROM pivots)""", "degree"),
        "lateral_paths": s("""SELECT a.source_ip, a.destination_ip AS pivot, b.destination_ip AS asset, a.flows AS ingress_flows, b.flows AS egress_flows
FROM links a JOIN links b ON a.destination_ip = b.source_ip
WHERE a.source_ip = '172.16.1.5'
  AND a.source_ip <> a.destination_ip AND b.source_ip <> b.destination_ip AND a.source_ip <> b.destination_ip""", "links"),
        # entropy
        "packet_entropy": s("SELECT * FROM entropy", "entropy"),
        "entropy_flags": s("""SELECT window_start, entropy, round(abs(entropy - 4.20::DOUBLE) / 0.65::DOUBLE, 2) AS z_score,
  CASE WHEN entropy < 1.8 THEN 'CRITICAL ANOMALY: Entropy Collapse' WHEN entropy > 7.3 THEN 'CRITICAL ANOMALY: Pseudo-Random Spike'
    WHEN entropy BETWEEN 3.5 AND 4.8 THEN 'NORMAL BASELINE: Verified Stable' ELSE 'WARNING: Moderate Entropy Drift' END AS anomaly_flag
FROM entropy""", "entropy"),
        "entropy_drift": s("""SELECT window_start, round(h, 4) + 0.0::DOUBLE AS entropy,
  round(avg(h) OVER (ORDER BY window_start ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 4) + 0.0::DOUBLE AS moving_avg FROM h""", "entropy"),
        # quality and storage
        "quality_report": s(_quality(), "risk", "hourly"),
        "partition_balance": s("""SELECT shard, count(*) AS documents, round(count(*) / sum(count(*)) OVER () * 100, 1) AS pct
FROM (SELECT CAST({MOD:source_ip:2} AS INT) AS shard FROM flows) GROUP BY shard"""),
        "sharded_write": s("""SELECT CAST({MOD:source_ip:4} AS INT) AS shard, count(*) AS documents, count(DISTINCT source_ip) AS sources
FROM flows GROUP BY 1"""),
        "bucketed_sources": s("SELECT source_ip, count(*) AS flows, CAST(sum(packet_count) AS BIGINT) AS packets FROM flows GROUP BY 1"),
        "parquet_roundtrip": s("SELECT * FROM flows"),
        "publish_refresh": s(*distribution),
        "publish_versions": s("""SELECT CASE attack_type WHEN 'BENIGN' THEN 'benign' ELSE 'attacks' END AS name, 2::BIGINT AS version,
  attack_type, count(*) AS flows FROM flows GROUP BY ALL"""),
        "salted_join": s("""SELECT risk_level, attack_type, count(*) AS flows, CAST(sum(packet_count) AS BIGINT) AS packets,
  CAST(sum(risk_score) AS BIGINT) AS scores FROM flows JOIN risk USING (source_ip) GROUP BY 1, 2""", "risk"),
        "json_mirror": s(collection_counts.format(key="output", n="records"), *_EIGHT_PARTS),
        "json_mirror_rows": s("""SELECT * REPLACE (nullif(protocol, 'UDP') AS protocol, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp)
FROM flows"""),
        "run_summary": s(_counts(outputs).format(key="output", n="records"), *_EIGHT_PARTS),
        "integration_manifest": s(f"""SELECT *, 'phase10' AS pipeline_version FROM (
WITH c AS ({manifest_counts}) SELECT * FROM c UNION ALL SELECT 'TOTAL', CAST(sum(documents) AS BIGINT) FROM c)""", *_EIGHT_PARTS),
        # features
        "indexed_flows": s("""SELECT timestamp, source_ip, destination_ip, protocol, severity, attack_type, protocol_index, severity_index, label
FROM indexed""", "index"),
        "feature_vectors": s(f"""SELECT * FROM (SELECT source_ip, destination_ip, attack_type, timestamp, label, {features},
  CAST(8 AS INT) AS vector_size FROM indexed)""", "index"),
        "scaled_features": s(f"SELECT source_ip, destination_ip, attack_type, timestamp, label, {scaled} FROM indexed", "index"),
        "label_map": s("SELECT CAST(label AS INT) AS label, attack_type FROM label_rank", "index"),
        "split_counts": s("""SELECT CASE WHEN split_bucket < 80 THEN 'train' ELSE 'test' END AS part, attack_type, count(*) AS flows
FROM splits GROUP BY 1, 2""", "split"),
        "class_support": s("SELECT attack_type, count(*) AS support FROM splits WHERE split_bucket >= 80 GROUP BY 1", "split"),
        "model_roundtrip": s("SELECT count(*) AS compared, CAST(0 AS BIGINT) AS differing FROM splits WHERE split_bucket >= 80", "split"),
        "prediction_sample_flows": s(f"""SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, source_ip, destination_ip,
  attack_type AS actual_attack FROM {_PREVIEW}"""),
        "predictions_append": s("""SELECT strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS timestamp, source_ip, destination_ip,
  attack_type AS actual_attack, 2 * count(*) AS records, 2 * count(*) AS stamped FROM flows GROUP BY 1, 2, 3, 4"""),
        "prediction_checks": s("""SELECT attack_type AS actual_attack, count(*) AS predictions, 0::BIGINT AS odd_confidence,
  0::BIGINT AS odd_severity, 0::BIGINT AS unknown_names FROM flows GROUP BY 1"""),
        "forest_checks": s("""SELECT model, attack_type, count(*) AS scored, 0::BIGINT AS other_class, 0::BIGINT AS other_probability
FROM flows, (VALUES ('decision_tree'), ('random_forest')) m(model) GROUP BY 1, 2"""),
        "rule_metrics": s(f"""SELECT * FROM (WITH {_RULE_RATES}
SELECT round(sum(hits) / sum(support), 4) AS accuracy, round(sum(f * support) / sum(support), 4) AS f1_score,
  round(sum(p * support) / sum(support), 4) AS precision, round(sum(r * support) / sum(support), 4) AS recall,
  CAST(sum(support) AS BIGINT) AS test_rows FROM rated)""", "rules", "index"),
        "rule_confusion_matrix": s(f"""SELECT * FROM (WITH {_RULE_RATES}
SELECT a.attack_type AS actual, b.attack_type AS predicted, coalesce(n, 0)::BIGINT AS n
FROM label_rank a CROSS JOIN label_rank b LEFT JOIN oc ON actual = a.attack_type AND predicted = b.attack_type)""", "rules", "index"),
        "rule_metrics_doc": s(f"""SELECT * FROM (WITH {_RULE_RATES}
SELECT 'models' AS section, NULL::VARCHAR AS actual, NULL::VARCHAR AS predicted, CAST(sum(support) AS BIGINT) AS n,
  round(sum(hits) / sum(support), 4) AS rate FROM rated
UNION ALL SELECT 'confusion_matrix', a.attack_type, b.attack_type, coalesce(n, 0)::BIGINT, NULL
FROM label_rank a CROSS JOIN label_rank b LEFT JOIN oc ON actual = a.attack_type AND predicted = b.attack_type
UNION ALL SELECT 'per_class_metrics', attack_type, NULL, CAST(support AS BIGINT), round(f, 4) FROM rated)""", "rules", "index"),
        "rule_comparison": s(f"""SELECT * FROM (WITH {_RULE_RATES},
compared AS (SELECT 'threshold rules' AS model, round(sum(hits) / sum(support), 4) AS accuracy, round(sum(f * support) / sum(support), 4) AS f1_score,
  round(sum(p * support) / sum(support), 4) AS precision, round(sum(r * support) / sum(support), 4) AS recall,
  CAST(sum(support) AS BIGINT) AS test_rows FROM rated
UNION ALL SELECT 'all benign', round(share, 4), round(share * 2 * share / (1 + share), 4), round(share * share, 4), round(share, 4), rows
  FROM (SELECT count(*) FILTER (attack_type = 'BENIGN') / count(*) AS share, count(*) AS rows FROM flows))
SELECT *, 0.0::DOUBLE AS training_time_s, f1_score = max(f1_score) OVER () AS best FROM compared)""", "rules", "index"),
        "rule_class_report": s(f"""SELECT * FROM (WITH {_RULE_RATES}
SELECT attack_type, CAST(support AS BIGINT) AS support, round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1_score
FROM rated)""", "rules", "index"),
        # streams
        "stream_blacklist": s(f"""SELECT * EXCLUDE (ts), ts AS timestamp, CAST(hour(ts) AS INT) AS hour, CAST(dayofweek(ts) + 1 AS INT) AS day_of_week
FROM valid WHERE source_ip NOT IN {_CRITICAL}""", "risk"),
        "incident_audit": s(stream_incidents, "risk", "technique"),
        "stream_entropy": s("""SELECT window_start, flows, distinct_lengths, round(h, 4) + 0.0::DOUBLE AS entropy FROM (
SELECT window_start, CAST(sum(n) AS BIGINT) AS flows, count(*) AS distinct_lengths, -sum(p * log2(p)) AS h FROM (
  SELECT *, n / sum(n) OVER (PARTITION BY window_start) AS p FROM (
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, packet_length, count(*) AS n FROM valid GROUP BY 1, 2))
GROUP BY window_start)"""),
        "stream_windows": s("""SELECT window_start, CAST(sum(n) AS BIGINT) AS flows, count(*) AS distinct_lengths,
  round(-sum(n / total * log2(n / total)), 4) + 0.0::DOUBLE AS entropy, CAST(sum(early) AS BIGINT) AS published_flows,
  round(-sum(CASE WHEN early > 0 THEN early / early_total * log2(early / early_total) END), 4) + 0.0::DOUBLE AS published_entropy FROM (
  SELECT *, sum(n) OVER (PARTITION BY window_start) AS total, sum(early) OVER (PARTITION BY window_start) AS early_total FROM (
    SELECT window_start, packet_length, count(*) AS n, count(*) FILTER (NOT late) AS early FROM timed GROUP BY 1, 2))
GROUP BY window_start""", "timed"),
        "stream_prediction_checks": s("""SELECT attack_type AS actual_attack, count(*) AS predictions, 0::BIGINT AS odd_confidence,
  0::BIGINT AS odd_severity, 0::BIGINT AS unknown_names FROM valid GROUP BY 1"""),
    }
