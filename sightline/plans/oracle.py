"""DuckDB SQL for the registered queries, written independently of the Spark code."""

from __future__ import annotations

from sightline.plans.registry import (
    BROAD_CONFIDENCE,
    BROAD_SUPPORT,
    COOCCUR,
    PAIR_SUPPORT,
    SECTOR_THRESHOLD,
    YEARS,
)

ORACLES: dict[str, str] = {}

SIGHTINGS = """sightings AS MATERIALIZED (
  SELECT concat(l_orderkey, '-', l_linenumber) AS record_id,
         '2001-12-31' AS report_date,
         concat('cust_', lpad(CAST(l_suppkey % 86 AS VARCHAR), 2, '0')) AS anonymous_id,
         CASE (l_suppkey % 86) % 7 WHEN 0 THEN 'IT & Svcs' WHEN 1 THEN 'healthcare'
              WHEN 2 THEN 'govt services' WHEN 3 THEN 'government' WHEN 4 THEN 'IT'
              WHEN 5 THEN 'cybersecurity' ELSE 'retail' END AS sector,
         CASE (l_suppkey % 86) % 3 WHEN 0 THEN 'small' WHEN 1 THEN 'medium'
              ELSE 'large' END AS size,
         CASE WHEN l_partkey % 4 = 0
              THEN concat('h', l_partkey, '.n', l_partkey % 50, '.site', l_partkey % 21, '.com')
              ELSE concat(l_partkey % 223 + 1, '.', l_partkey % 251, '.', l_partkey % 241, '.',
                          l_partkey % 239) END AS data,
         l_quantity * l_linenumber AS count_seen,
         CAST(epoch(least(l_shipdate, o_orderdate)) AS BIGINT) AS first_seen,
         CAST(epoch(greatest(l_shipdate, o_orderdate)) AS BIGINT) AS last_seen,
         least(round(l_discount * 100), 9.0) AS threat_score,
         o_orderpriority AS estimate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

IP = r"regexp_matches({0}, '^\d{{1,3}}\.\d{{1,3}}\.\d{{1,3}}\.\d{{1,3}}$')"


def is_ip(column: str) -> str:
    return IP.format(column)


def to_long(column: str) -> str:
    octets = [f"CAST(split_part({column}, '.', {i}) AS BIGINT)" for i in range(1, 5)]
    value = f"(({octets[0]} * 256 + {octets[1]}) * 256 + {octets[2]}) * 256 + {octets[3]}"
    return f"CASE WHEN {is_ip(column)} THEN {value} END"


def trimmed(column: str) -> str:
    labels = f"string_split({column}, '.')"
    return f"CASE WHEN {is_ip(column)} THEN {column} ELSE array_to_string({labels}[-2:], '.') END"


def on_sightings(name: str, select: str, *ctes: str) -> None:
    ORACLES[name] = "WITH " + ", ".join([SIGHTINGS, *ctes]) + "\n" + select


# -- scans, projections, filters ---------------------------------------------

on_sightings("scan_sightings", "SELECT * FROM sightings")
on_sightings(
    "project_columns",
    "SELECT anonymous_id, data, count_seen, first_seen, last_seen, threat_score FROM sightings",
)
on_sightings(
    "project_except",
    "SELECT anonymous_id, data, count_seen, first_seen, last_seen, threat_score FROM sightings",
)
ORACLES["scan_parquet"] = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount FROM lineitem"
)
TARGETED = "threat_score > 0 AND threat_score < 9 AND threat_score <> 5"
on_sightings("targeted", f"SELECT * FROM sightings WHERE {TARGETED}")
COHORTS = {
    "all": "true",
    "targeted": TARGETED,
    "no5s": "threat_score <> 5",
    "only5s": "threat_score = 5",
    "no1s9s5s": "threat_score NOT IN (1, 9, 5)",
}
on_sightings(
    "cohort_counts",
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS cohort, count(*) AS n FROM sightings WHERE {c}" for n, c in COHORTS.items()
    ),
)
for _n, _customers in COOCCUR.items():
    _having = " AND ".join(
        f"count(*) FILTER (WHERE anonymous_id = '{c}') > 0" for c in _customers
    )
    on_sightings(
        f"cooccur_{_n}",
        f"SELECT count(*) AS n_ips FROM (SELECT data FROM sightings GROUP BY data HAVING {_having})",
    )
on_sightings(
    "time_slice",
    f"""SELECT first_seen, count(*) AS count,
       strftime(make_timestamp(first_seen * 1000000), '%Y-%m-%d') AS day
FROM sightings
WHERE year(make_timestamp(first_seen * 1000000)) BETWEEN {YEARS[0]} AND {YEARS[1]}
GROUP BY first_seen""",
)
on_sightings(
    "dropna_rows",
    "SELECT record_id, data, estimate FROM sightings WHERE estimate <> '5-LOW'",
)
on_sightings("is_ip", f"SELECT DISTINCT data, {is_ip('data')} AS is_ip FROM sightings")
on_sightings("ip_to_long", f"SELECT DISTINCT data, {to_long('data')} AS number FROM sightings")
on_sightings("trim_hosts", f"SELECT DISTINCT data, {trimmed('data')} AS host FROM sightings")
on_sightings(
    "elapsed",
    "SELECT record_id, data, anonymous_id, last_seen - first_seen AS dt FROM sightings",
)
SCORE_LABEL = (
    "CASE WHEN threat_score > 5 THEN 'High' WHEN threat_score < 5 THEN 'Low' ELSE 'Neutral' END"
)
on_sightings("rescore", f"SELECT record_id, count_seen, {SCORE_LABEL} AS score_label FROM sightings")

COUNT_BIN = """CASE WHEN count_seen <= 50 THEN 'seen<=50' WHEN count_seen <= 100 THEN 'seen<=100'
  WHEN count_seen <= 150 THEN 'seen<= 150' WHEN count_seen <= 200 THEN 'seen<= 200'
  WHEN count_seen <= 250 THEN 'seen<= 250' WHEN count_seen <= 300 THEN 'seen<= 300'
  ELSE 'seen>300' END"""
_SCORE = "CAST(CAST(threat_score AS INTEGER) AS VARCHAR)"
THREAT_V1 = f"""CASE WHEN threat_score <= 3 THEN 'low_threat_' WHEN threat_score <= 6
  THEN 'mid_threat_' ELSE 'high_threat_' END || {_SCORE}"""
THREAT_V2 = f"""CASE WHEN threat_score < 5 THEN 'low_threat_' WHEN threat_score = 6
  THEN 'medium_threat' ELSE 'high_threat' END || {_SCORE}"""


def items(threat: str) -> str:
    return f"""SELECT sector, 'size_' || size AS size, {COUNT_BIN} AS count, {threat} AS score
FROM sightings"""


on_sightings("mba_transform_v1", items(THREAT_V1))
on_sightings("mba_transform_v2", items(THREAT_V2))

# -- profiles ----------------------------------------------------------------

FIRST_LAST = """fl AS MATERIALIZED (
  SELECT f.data AS ip, f.threat_score AS firstScore, l.threat_score AS lastScore
  FROM (SELECT data, threat_score, row_number() OVER
          (PARTITION BY data ORDER BY first_seen, threat_score) AS r FROM sightings) f
  JOIN (SELECT data, threat_score, row_number() OVER
          (PARTITION BY data ORDER BY last_seen DESC, threat_score DESC) AS r FROM sightings) l
    ON f.data = l.data AND f.r = 1 AND l.r = 1)"""
COUNTER = """counter AS MATERIALIZED (
  SELECT data AS ip, anonymous_id, count(*) AS n FROM sightings GROUP BY ALL)"""
FAVOURITE = """favourite AS (
  SELECT ip, anonymous_id, n FROM (
    SELECT *, row_number() OVER (PARTITION BY ip ORDER BY n DESC, anonymous_id) AS r
    FROM counter) WHERE r = 1)"""
PROFILE = """prof AS MATERIALIZED (
  SELECT s.ip, "maxScore", "minScore", "avgScore", "lastScore",
         CASE WHEN "firstScore" < "lastScore" THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "trendUp",
         CASE WHEN "firstScore" > "lastScore" THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "trendDown",
         "trueCount", "dataSetCount", v.anonymous_id AS "mostCommonCustomerHit",
         "totalCustomersHit"
  FROM (SELECT data AS ip, max(threat_score) AS "maxScore", min(threat_score) AS "minScore",
               avg(threat_score) AS "avgScore", max(count_seen) AS "trueCount",
               count(*) AS "dataSetCount", count(DISTINCT anonymous_id) AS "totalCustomersHit"
        FROM sightings GROUP BY data) s
  JOIN fl ON s.ip = fl.ip JOIN favourite v ON s.ip = v.ip)"""
CUSTOMERS = [f"cust_{i:02d}" for i in range(86)]
WIDE = (
    "wide AS (SELECT ip, "
    + ", ".join(
        f"CAST(coalesce(sum(n) FILTER (WHERE anonymous_id = '{c}'), 0) AS BIGINT) AS {c}"
        for c in CUSTOMERS
    )
    + " FROM counter GROUP BY ip)"
)
PROFILE_CTES = (FIRST_LAST, COUNTER, FAVOURITE, PROFILE)
_COLUMNS = ", ".join(CUSTOMERS)

on_sightings(
    "customer_list",
    "SELECT anonymous_id, count(*) AS n FROM sightings GROUP BY 1 ORDER BY 1",
)
on_sightings("ip_profile", "SELECT * FROM prof", *PROFILE_CTES)
on_sightings(
    "ip_features_wide", f"SELECT prof.*, {_COLUMNS} FROM prof JOIN wide USING (ip)", *PROFILE_CTES, WIDE
)
on_sightings(
    "ip_features_flag",
    f"""SELECT ip, CASE WHEN "avgScore" > 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "avgScore > 5",
       "trendUp", "trendDown", "trueCount", "mostCommonCustomerHit", "totalCustomersHit", {_COLUMNS}
FROM prof JOIN wide USING (ip)""",
    *PROFILE_CTES,
    WIDE,
)
on_sightings(
    "ip_profile_full",
    f"""SELECT ip, "maxScore", "minScore", "avgScore", "trendUp", "trendDown",
       "trueCount" AS "maxCount", "dataSetCount", "mostCommonCustomerHit", "totalCustomersHit",
       {_COLUMNS}
FROM prof JOIN wide USING (ip)""",
    *PROFILE_CTES,
    WIDE,
)
on_sightings("ip_counts", "SELECT data AS ip, count(*) AS n FROM sightings GROUP BY 1")
on_sightings("ip_first_last_score", 'SELECT ip, firstScore, lastScore FROM fl', FIRST_LAST)
on_sightings("ip_trend", 'SELECT ip, "trendUp", "trendDown" FROM prof', *PROFILE_CTES)
on_sightings(
    "most_common_customer",
    'SELECT ip, anonymous_id AS "mostCommonCustomerHit", n FROM favourite',
    COUNTER,
    FAVOURITE,
)
on_sightings("customer_counter", "SELECT * FROM counter", COUNTER)
LABEL = "CASE WHEN lastScore > 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
on_sightings("binary_label", f"SELECT ip, {LABEL} AS label FROM fl", FIRST_LAST)
on_sightings(
    "ternary_label", f"SELECT ip, {LABEL} AS label FROM fl WHERE lastScore <> 5", FIRST_LAST
)
on_sightings(
    "confusion",
    """SELECT count(*) FILTER (WHERE y AND p) AS true_positive,
       count(*) FILTER (WHERE NOT y AND NOT p) AS true_negative,
       count(*) FILTER (WHERE y AND NOT p) AS false_positive,
       count(*) FILTER (WHERE NOT y AND p) AS false_negative,
       count(*) FILTER (WHERE y <> p) / count(*) AS error_rate
FROM (SELECT "lastScore" > 5 AS y, "avgScore" > 4.5 AS p FROM prof)""",
    *PROFILE_CTES,
)

# -- totals and stat tables --------------------------------------------------

on_sightings("host_totals", "SELECT data, sum(count_seen) AS count_seen FROM sightings GROUP BY 1")
on_sightings(
    "sensor_totals",
    "SELECT anonymous_id, sector, size, sum(count_seen) AS count_seen FROM sightings GROUP BY 1, 2, 3",
)
on_sightings(
    "connection_totals",
    "SELECT anonymous_id, data, sum(count_seen) AS count_seen FROM sightings GROUP BY 1, 2",
)
on_sightings("total_events", "SELECT sum(count_seen) AS total_events FROM sightings")
on_sightings(
    "stat_customers",
    "SELECT anonymous_id, sector, count(anonymous_id) AS count FROM sightings GROUP BY 1, 2",
)
on_sightings("stat_time", "SELECT first_seen, count(first_seen) AS count FROM sightings GROUP BY 1")
on_sightings(
    "stat_scores", "SELECT threat_score, count(threat_score) AS count FROM sightings GROUP BY 1"
)
on_sightings("stat_sectors", "SELECT sector, count(sector) AS count FROM sightings GROUP BY 1")
on_sightings(
    "stat_elapsed",
    """SELECT last_seen - first_seen AS dt, count(*) AS count,
       (last_seen - first_seen) / 1000 AS seconds FROM sightings GROUP BY 1""",
)
on_sightings(
    "scores_ranked",
    """SELECT threat_score, count(*) AS count FROM sightings WHERE threat_score IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1""",
)
on_sightings(
    "sector_rollup",
    f"""SELECT CASE WHEN n <= {SECTOR_THRESHOLD} THEN 'Other'
       WHEN sector IN ('IT & Svcs', 'IT Sector', 'IT') THEN 'Information Technology & Services'
       WHEN sector = 'healthcare' THEN 'Health Care'
       WHEN sector IN ('govt services', 'government') THEN 'Government'
       WHEN sector = 'cybersecurity' THEN 'Cybersecurity' WHEN sector = 'home' THEN 'Home'
       WHEN sector = 'infrastructure' THEN 'Infrastructure' ELSE sector END AS sector,
       CAST(sum(n) AS BIGINT) AS count
FROM (SELECT sector, count(*) AS n FROM sightings GROUP BY 1) GROUP BY 1""",
)
on_sightings(
    "first_n",
    """SELECT record_id, anonymous_id, data, count_seen, first_seen FROM sightings
ORDER BY 1, 2, 3, 4, 5 LIMIT 20""",
)

# -- trajectory labels -------------------------------------------------------

on_sightings(
    "score_sets",
    """SELECT data, string_agg(CAST(CAST(threat_score AS INTEGER) AS VARCHAR), ',' ORDER BY threat_score)
       AS scores
FROM (SELECT DISTINCT data, threat_score FROM sightings) GROUP BY data""",
)
DIRECTION = """direction AS MATERIALIZED (
  SELECT data, CASE WHEN five AND hi > 0 THEN 'Trends_High' WHEN five AND lo > 0 THEN 'Trends_Low'
              WHEN five THEN 'Neutral' WHEN hi > 0 AND lo = 0 THEN 'Started_High'
              WHEN hi > 0 THEN 'Started_Low_Went_High' WHEN lo > 0 THEN 'Stayed_Low'
              ELSE 'Unknown_State' END AS score_direction
  FROM (SELECT data, count(*) FILTER (WHERE threat_score IN (6, 7, 8, 9)) AS hi,
               count(*) FILTER (WHERE threat_score IN (0, 1, 2, 3, 4)) AS lo,
               count(*) FILTER (WHERE threat_score = 5) > 0 AS five
        FROM sightings GROUP BY data))"""
on_sightings(
    "label_rescore",
    "SELECT data, score_direction, CAST(1 AS BIGINT) AS count FROM direction",
    DIRECTION,
)
on_sightings(
    "stat_score_direction",
    "SELECT score_direction, count(*) AS count FROM direction GROUP BY 1",
    DIRECTION,
)

# -- geo ---------------------------------------------------------------------

BLOCKS = """blocks AS (
  SELECT (1 + 9 * n_nationkey + k) * 16777216 * 64 + 8 AS block_id,
         (1 + 9 * n_nationkey + k) * 16777216 AS start,
         (2 + 9 * n_nationkey + k) * 16777216 - 1 AS stop,
         n_nationkey AS geoname_id, n_nationkey AS registered_country_geoname_id
  FROM (SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, k
        FROM nation, (SELECT unnest(range(8)) AS k)))"""
LOCATIONS = """locations AS (
  SELECT n_nationkey AS geoname_id, 'en' AS locale_code,
         CAST(r_regionkey AS VARCHAR) AS continent_code, r_name AS continent_name,
         CAST(n_nationkey AS VARCHAR) AS country_iso_code, n_name AS country_name
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
HOSTS = f"""hosts AS MATERIALIZED (
  SELECT data, {to_long('data')} AS ip FROM (SELECT DISTINCT data FROM sightings))"""
GEO = """geo AS MATERIALIZED (
  SELECT h.data, coalesce(l.continent_name, 'Unknown') AS continent,
         coalesce(l.country_name, 'Unknown') AS country
  FROM hosts h LEFT JOIN blocks b ON h.ip BETWEEN b.start AND b.stop
  LEFT JOIN locations l ON b.geoname_id = l.geoname_id)"""
GEO_CTES = (BLOCKS, LOCATIONS, HOSTS, GEO)
LOCATED = "located AS MATERIALIZED (SELECT s.*, continent, country FROM sightings s JOIN geo USING (data))"
ENRICHED = """enriched AS MATERIALIZED (
  SELECT s.*, continent, country, score_direction, last_seen - first_seen AS elapsed
  FROM sightings s JOIN geo USING (data) JOIN direction USING (data))"""

ORACLES["geo_locations"] = f"WITH {LOCATIONS} SELECT * FROM locations"
ORACLES["geo_blocks"] = f"WITH {BLOCKS} SELECT * FROM blocks"
ORACLES["geo_export"] = f"""WITH {BLOCKS}, {LOCATIONS}
SELECT start, stop, continent_code, continent_name, country_iso_code, country_name
FROM blocks JOIN locations USING (geoname_id)"""
on_sightings("geolocation_enrich", "SELECT * FROM geo", *GEO_CTES)
on_sightings(
    "ip_block_lookup",
    "SELECT data AS ip_addr, block_id FROM hosts JOIN blocks ON ip BETWEEN start AND stop",
    BLOCKS,
    HOSTS,
)
on_sightings("combine_geolocation", "SELECT * FROM located", *GEO_CTES, LOCATED)
on_sightings("feature_enrich", "SELECT * FROM enriched", *GEO_CTES, DIRECTION, ENRICHED)
on_sightings(
    "stat_location_rescored",
    f"SELECT country, {SCORE_LABEL} AS score_label, count(country) AS count FROM located GROUP BY 1, 2",
    *GEO_CTES,
    LOCATED,
)
on_sightings(
    "stat_country_score",
    "SELECT country, threat_score, count(country) AS count FROM located GROUP BY 1, 2",
    *GEO_CTES,
    LOCATED,
)
on_sightings(
    "country_pivot_top10",
    """SELECT country, "High", "Neutral", "Low" FROM (
  SELECT country, nullif(count(*) FILTER (WHERE threat_score > 5), 0) AS "High",
         nullif(count(*) FILTER (WHERE threat_score = 5), 0) AS "Neutral",
         nullif(count(*) FILTER (WHERE threat_score < 5), 0) AS "Low"
  FROM located GROUP BY 1)
ORDER BY "High" DESC NULLS LAST, "Neutral" DESC NULLS LAST, "Low" DESC NULLS LAST, country LIMIT 10""",
    *GEO_CTES,
    LOCATED,
)
on_sightings(
    "upsert_enriched",
    f"""SELECT ip_addr, block_id FROM changes
UNION ALL
SELECT data, b.block_id FROM hosts JOIN blocks b ON ip BETWEEN start AND stop
WHERE data NOT IN (SELECT ip_addr FROM changes)""",
    BLOCKS,
    HOSTS,
    FIRST_LAST,
    f"""changes AS MATERIALIZED (SELECT ip AS ip_addr, -({to_long('ip')}) AS block_id FROM fl
    WHERE {is_ip('ip')} AND lastScore > 5)""",
)

# -- series ------------------------------------------------------------------

SERIES = """series AS (
  SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS ts, count(*) AS n FROM events GROUP BY 1)"""
ORACLES["series_describe"] = f"""WITH {SERIES}
SELECT count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
       CAST(min(n) AS DOUBLE) AS min, round(quantile_cont(n, 0.25), 6) AS p25,
       round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.75), 6) AS p75,
       CAST(max(n) AS DOUBLE) AS max
FROM series"""
ORACLES["time_ewm"] = f"""WITH {SERIES},
placed AS MATERIALIZED (SELECT ts, n, row_number() OVER (ORDER BY ts) AS i FROM series)
SELECT a.ts, any_value(a.n) AS count_seen,
       round(sum(b.n * power(0.8, a.i - b.i)) / sum(power(0.8, a.i - b.i)), 6) AS moving_average
FROM placed a JOIN placed b ON b.i <= a.i GROUP BY a.ts"""
ORACLES["time_quantile_75"] = f"""WITH {SERIES}
SELECT ts, n, cumulative FROM (
  SELECT ts, n, CAST(sum(n) OVER (ORDER BY ts) AS BIGINT) AS cumulative, sum(n) OVER () AS total
  FROM series)
WHERE cumulative >= 0.75 * total ORDER BY ts LIMIT 1"""

# -- samples -----------------------------------------------------------------


def unit(*keys: str) -> str:
    joined = f"concat_ws('|', {', '.join(keys)})"
    return f"CAST('0x' || substr(md5({joined}), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"


_KEYS = ("record_id", "anonymous_id", "data")
on_sightings(
    "nested_samples",
    "\nUNION ALL ".join(
        f"SELECT '{f}' AS fraction, count(*) FILTER (WHERE u < {f}) AS n FROM units"
        for f in ("0.005", "0.01", "0.02", "0.03", "0.05", "0.1", "0.25", "0.5")
    ),
    f"units AS MATERIALIZED (SELECT {unit(*_KEYS)} AS u FROM sightings)",
)
on_sightings(
    "hash_split",
    f"""SELECT record_id, anonymous_id, data,
       CASE WHEN {unit(*_KEYS)} < 0.65 THEN 'train' ELSE 'test' END AS part FROM sightings""",
)
on_sightings(
    "balanced_split",
    f"""SELECT ip, label FROM labelled, ratio
WHERE {unit("'balance'", "ip")} < CASE WHEN label = 1 THEN least(1.0, 1.0 / r) ELSE least(1.0, r) END""",
    FIRST_LAST,
    f"labelled AS MATERIALIZED (SELECT ip, {LABEL} AS label FROM fl)",
    """ratio AS (SELECT count(*) FILTER (WHERE label = 1)::DOUBLE
                      / count(*) FILTER (WHERE label = 0)::DOUBLE AS r FROM labelled)""",
)

# -- baskets and rules -------------------------------------------------------

LAST_ITEM = """CASE WHEN lastScore < 5 THEN 'lastScore_greater_5_false'
  ELSE 'lastScore_greater_5_true' END"""
BASKETS = f"""cells AS MATERIALIZED (
  SELECT ip, anonymous_id AS item FROM counter
  UNION ALL SELECT ip, {LAST_ITEM} FROM fl)"""
BASKET_CTES = (FIRST_LAST, COUNTER, BASKETS)
N_BASKETS = "(SELECT count(DISTINCT ip) FROM cells)"
on_sightings(
    "baskets",
    "SELECT ip, string_agg(item, ',' ORDER BY item) AS items FROM cells GROUP BY ip",
    *BASKET_CTES,
)
on_sightings(
    "item_frequency",
    f"""SELECT item, count(*) AS n, count(*) / {N_BASKETS} AS support FROM cells
GROUP BY item HAVING count(*) / {N_BASKETS} >= 0.01""",
    *BASKET_CTES,
)
on_sightings(
    "basket_summary",
    """SELECT count(*) AS n_baskets, any_value(k) AS n_items,
       CAST(sum(size) AS BIGINT) / (count(*) * any_value(k)) AS density,
       min(size) AS min_size, quantile_cont(size, 0.5) AS median_size,
       avg(size) AS mean_size, max(size) AS max_size
FROM (SELECT ip, count(*) AS size FROM cells GROUP BY ip),
     (SELECT count(DISTINCT item) AS k FROM cells)""",
    *BASKET_CTES,
)
on_sightings(
    "itemsets_pairs",
    f"""SELECT item AS items, count(*) AS n FROM cells GROUP BY item
HAVING count(*) >= ceil({PAIR_SUPPORT} * {N_BASKETS})
UNION ALL
SELECT a.item || '|' || b.item, count(*) FROM cells a JOIN cells b ON a.ip = b.ip AND a.item < b.item
GROUP BY ALL HAVING count(*) >= ceil({PAIR_SUPPORT} * {N_BASKETS})""",
    *BASKET_CTES,
)
on_sightings(
    "rules_rhs",
    f"""SELECT a.item AS antecedent, b.item AS consequent,
       round(count(*) / {N_BASKETS}, 6) AS support,
       round(count(*) / any_value(l.n), 6) AS confidence,
       round((count(*) / any_value(l.n)) / (any_value(r.n) / {N_BASKETS}), 6) AS lift
FROM cells a JOIN cells b ON a.ip = b.ip AND a.item <> b.item AND b.item LIKE 'lastScore%'
JOIN singles l ON l.item = a.item JOIN singles r ON r.item = b.item
GROUP BY a.item, b.item""",
    *BASKET_CTES,
    "singles AS MATERIALIZED (SELECT item, count(*) AS n FROM cells GROUP BY item)",
)

ITEMS = f"items AS MATERIALIZED ({items(THREAT_V1)})"
# An itemset of a four-column basket is a cell of the cube over its columns.
SETS = """sets AS MATERIALIZED (
  SELECT list_sort(list_filter([sector, size, count, score], lambda x: x IS NOT NULL)) AS items, n
  FROM (SELECT sector, size, count, score, count(*) AS n FROM items
        GROUP BY CUBE (sector, size, count, score))
  WHERE coalesce(sector, size, count, score) IS NOT NULL)"""
on_sightings(
    "item_frequency_top",
    """SELECT items[1] AS item, n, n / (SELECT count(*) FROM items) AS support FROM sets
WHERE len(items) = 1 ORDER BY n DESC, item LIMIT 17""",
    ITEMS,
    SETS,
)
on_sightings("itemsets_sightings", "SELECT array_to_string(items, '|') AS items, n FROM sets", ITEMS, SETS)


def rules_cte(support: float, confidence: float) -> str:
    return f"""rules AS MATERIALIZED (
  SELECT array_to_string(list_filter(s.items, lambda x: x <> c), '|') AS antecedent, c AS consequent,
         s.n / t AS support, s.n / a.n AS confidence, (s.n / a.n) / (r.n / t) AS lift,
         len(s.items) AS length
  FROM (SELECT *, unnest(items) AS c FROM sets) s
  JOIN (SELECT count(*) AS t FROM items) ON s.n >= ceil({support!r} * t)
  JOIN sets a ON array_to_string(a.items, '|') = array_to_string(list_filter(s.items, lambda x: x <> c), '|')
  JOIN sets r ON len(r.items) = 1 AND r.items[1] = c
  WHERE len(s.items) >= 2 AND s.n / a.n >= {confidence})"""


def single_rules(support: float, confidence: float) -> str:
    """Rules from the empty antecedent."""
    return f"""SELECT '' AS antecedent, items[1] AS consequent, round(n / t, 6) AS support,
  round(n / t, 6) AS confidence, 1.0::DOUBLE AS lift
FROM sets JOIN (SELECT count(*) AS t FROM items) ON n >= ceil({support!r} * t) AND n / t >= {confidence}
WHERE len(items) = 1"""


MEASURES = """round(support, 6) AS support, round(confidence, 6) AS confidence,
       round(lift, 6) AS lift"""
BROAD = (ITEMS, SETS, rules_cte(BROAD_SUPPORT, BROAD_CONFIDENCE))
on_sightings(
    "rules_threat",
    f"""SELECT antecedent, consequent, {MEASURES} FROM rules
WHERE consequent IN ('low_threat_1', 'low_threat_2', 'low_threat_3', 'mid_threat_4', 'mid_threat_6',
                     'high_threat_7', 'high_threat_8')""",
    ITEMS,
    SETS,
    rules_cte(0.000005, 0.6),
)
on_sightings(
    "rules_confident",
    f"SELECT antecedent, consequent, {MEASURES} FROM rules WHERE confidence > 0.8",
    *BROAD,
)
on_sightings(
    "rules_top",
    f"""SELECT antecedent, consequent, {MEASURES} FROM rules
ORDER BY round(lift, 6) DESC, antecedent, consequent LIMIT 10""",
    *BROAD,
)
on_sightings(
    "rules_summary",
    """SELECT measure, count(*) AS rules, round(min(v), 6) AS min,
       round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50,
       round(quantile_cont(v, 0.75), 6) AS p75, round(max(v), 6) AS max
FROM (SELECT 'support' AS measure, support AS v FROM rules
      UNION ALL SELECT 'confidence', confidence FROM rules
      UNION ALL SELECT 'lift', lift FROM rules)
GROUP BY measure""",
    *BROAD,
)
on_sightings(
    "rules_lengths",
    "SELECT CAST(length AS INTEGER) AS length, count(*) AS n FROM rules GROUP BY 1",
    *BROAD,
)
for _name, _support, _confidence, _least in (
    ("rules_defaults", 0.1, 0.8, 1),
    ("rules_broad", 0.1, 0.8, 2),
    ("rules_any_length", BROAD_SUPPORT, BROAD_CONFIDENCE, 1),
):
    _single = f"\nUNION ALL {single_rules(_support, _confidence)}" if _least == 1 else ""
    on_sightings(
        _name,
        f"SELECT antecedent, consequent, {MEASURES} FROM rules{_single}",
        ITEMS,
        SETS,
        rules_cte(_support, _confidence),
    )

# -- graph -------------------------------------------------------------------

V1 = f"""v1 AS MATERIALIZED (
  SELECT DISTINCT anonymous_id AS id, 'CUSTOMER' AS label, anonymous_id AS data FROM sightings
  UNION ALL
  SELECT DISTINCT {trimmed('data')} AS id, 'HOST' AS label, {trimmed('data')} AS data FROM sightings)"""
E1 = f"""e1 AS MATERIALIZED (
  WITH c AS (SELECT anonymous_id AS a, {trimmed('data')} AS h,
                    sum(count_seen) / (SELECT sum(count_seen) FROM sightings) AS weight
             FROM sightings GROUP BY 1, 2)
  SELECT a AS src, h AS dst, weight FROM c UNION ALL SELECT h, a, weight FROM c)"""
E2 = """e2 AS MATERIALIZED (
  SELECT DISTINCT l_suppkey AS src, l_partkey AS dst FROM lineitem WHERE l_suppkey <> l_partkey)"""
V2 = "v2 AS MATERIALIZED (SELECT src AS id FROM e2 UNION SELECT dst FROM e2)"


def chain(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + select


on_sightings("graph_vertices", "SELECT * FROM v1", V1)
on_sightings("graph_edges", "SELECT * FROM e1", E1)
on_sightings(
    "graph_out_degrees",
    'SELECT src AS id, CAST(count(*) AS INTEGER) AS "outDegree" FROM e1 GROUP BY 1',
    E1,
)
ORACLES["graph_in_degrees"] = chain(
    E2, select='SELECT dst AS id, CAST(count(*) AS INTEGER) AS "inDegree" FROM e2 GROUP BY 1'
)
ORACLES["graph_degrees"] = chain(
    E2,
    select="""SELECT id, CAST(count(*) AS INTEGER) AS degree
FROM (SELECT src AS id FROM e2 UNION ALL SELECT dst FROM e2) GROUP BY 1""",
)
on_sightings(
    "graph_triplets",
    """SELECT s.id AS src_id, s.label AS src_label, weight, d.id AS dst_id, d.label AS dst_label
FROM e1 JOIN v1 s ON e1.src = s.id JOIN v1 d ON e1.dst = d.id""",
    V1,
    E1,
)
ORACLES["motif_2hop"] = chain(
    E2, select="SELECT x.src AS a, count(*) AS paths FROM e2 x JOIN e2 y ON x.dst = y.src GROUP BY 1"
)
ORACLES["motif_triangle"] = chain(
    E2,
    select="""SELECT x.src AS a, y.src AS b, z.src AS c
FROM e2 x JOIN e2 y ON x.dst = y.src JOIN e2 z ON y.dst = z.src AND z.dst = x.src""",
)
ORACLES["motif_no_backedge"] = chain(
    E2,
    select="""SELECT src AS a, dst AS b FROM e2 x
WHERE NOT EXISTS (SELECT 1 FROM e2 y WHERE y.src = x.dst AND y.dst = x.src)""",
)
on_sightings(
    "graph_bfs",
    """SELECT x.src AS from_id, x.dst AS v1_id, y.dst AS to_id FROM e1 x JOIN e1 y ON x.dst = y.src
WHERE x.src = 'cust_01' AND y.dst = 'cust_02'""",
    E1,
)


def rounds(first: str, step: str, n: int) -> list[str]:
    """``first`` as r0, then ``step`` with {p} as the round before."""
    ctes = [f"r0 AS MATERIALIZED ({first})"]
    ctes += [f"r{i} AS MATERIALIZED ({step.format(p=f'r{i - 1}')})" for i in range(1, n + 1)]
    return ctes


_HOOK = """SELECT id, min(component) AS component FROM (
  SELECT id, component FROM {p}
  UNION ALL SELECT e1.dst, {p}.component FROM e1 JOIN {p} ON e1.src = {p}.id) GROUP BY id"""
on_sightings(
    "graph_components",
    "SELECT id, component FROM r8",
    V1,
    E1,
    *rounds("SELECT id, id AS component FROM v1", _HOOK, 8),
)
ORACLES["graph_scc"] = chain(
    E2,
    V2,
    """core AS MATERIALIZED (SELECT src, dst FROM e2 WHERE dst IN (SELECT src FROM e2)
          AND src IN (SELECT dst FROM e2))""",
    """reach(a, b) AS (SELECT src, dst FROM core
          UNION SELECT reach.a, core.dst FROM reach JOIN core ON reach.b = core.src)""",
    """scc AS (SELECT x.a AS id, min(least(x.a, x.b)) AS component FROM reach x JOIN reach y
          ON x.a = y.b AND x.b = y.a GROUP BY 1)""",
    select="SELECT v2.id, coalesce(component, v2.id) AS component FROM v2 LEFT JOIN scc USING (id)",
    recursive=True,
)
_SPREAD = """SELECT id, label FROM (
  SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) AS r FROM (
    SELECT b.dst AS id, s.label, count(*) AS n FROM both_ways b JOIN {p} s ON b.src = s.id GROUP BY ALL
    UNION ALL SELECT id, label, 0 FROM {p})) WHERE r = 1"""
ORACLES["graph_lpa"] = chain(
    E2,
    V2,
    "both_ways AS MATERIALIZED (SELECT src, dst FROM e2 UNION ALL SELECT dst, src FROM e2)",
    *rounds("SELECT id, id AS label FROM v2", _SPREAD, 3),
    select="SELECT id, label FROM r3",
)
DEGREE = "deg AS MATERIALIZED (SELECT src, count(*) AS d FROM e1 GROUP BY 1)"


def rank_step(base: str) -> str:
    return (
        f"SELECT v1.id, 0.15 * {base} + 0.85 * coalesce(g, 0) AS rank FROM v1 LEFT JOIN ("
        "SELECT e1.dst AS id, sum(p.rank / deg.d) AS g FROM e1 JOIN deg ON e1.src = deg.src "
        "JOIN {p} p ON p.id = e1.src GROUP BY 1) m ON m.id = v1.id"
    )


on_sightings(
    "graph_pagerank",
    "SELECT id, round(rank, 6) AS pagerank FROM r20",
    V1,
    E1,
    DEGREE,
    *rounds("SELECT id, 1.0::DOUBLE AS rank FROM v1", rank_step("1.0::DOUBLE"), 20),
)
_SOURCE = "(CASE WHEN v1.id = 'cust_01' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
on_sightings(
    "graph_pagerank_personal",
    "SELECT id, round(rank, 6) AS pagerank FROM r20",
    V1,
    E1,
    DEGREE,
    *rounds(f"SELECT id, {_SOURCE} AS rank FROM v1", rank_step(_SOURCE), 20),
)
ORACLES["graph_shortest_paths"] = chain(
    E2,
    """hops(id, landmark, distance) AS (SELECT k, k, 0 FROM (SELECT unnest([1, 2]::BIGINT[]) AS k)
      UNION SELECT e2.src, landmark, distance + 1 FROM hops JOIN e2 ON e2.dst = hops.id
            WHERE distance < 12)""",
    select="SELECT id, landmark, min(distance) AS distance FROM hops GROUP BY 1, 2",
    recursive=True,
)
ORACLES["graph_triangles"] = chain(
    E2,
    V2,
    "pairs AS MATERIALIZED (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e2)",
    """corners AS MATERIALIZED (SELECT x.a, x.b, y.b AS c FROM pairs x JOIN pairs y ON x.b = y.a
          JOIN pairs z ON z.a = x.a AND z.b = y.b)""",
    """counted AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM corners
          UNION ALL SELECT b FROM corners UNION ALL SELECT c FROM corners) GROUP BY 1)""",
    select="SELECT v2.id, coalesce(n, 0) AS count FROM v2 LEFT JOIN counted USING (id)",
)

# -- learning ----------------------------------------------------------------

DISTINCT = """rows9 AS MATERIALIZED (SELECT DISTINCT data, continent, country, count_seen,
  score_direction, elapsed, sector, size, estimate FROM enriched)"""
LEARN = (*GEO_CTES, DIRECTION, ENRICHED, DISTINCT)
on_sightings("ml_distinct", "SELECT * FROM rows9", *LEARN)
_INDEXED = {
    "sector": "sectorIndex",
    "size": "sizeIndex",
    "estimate": "estimateIndex",
    "score_direction": "rescoreIndex",
    "continent": "continentIndex",
}
on_sightings(
    "ml_indexing",
    "SELECT "
    + ", ".join(f'i_{c}.i AS "{o}"' for c, o in _INDEXED.items())
    + ", elapsed, count_seen FROM rows9 "
    + " ".join(f"JOIN i_{c} ON rows9.{c} = i_{c}.v" for c in _INDEXED),
    *LEARN,
    *[
        f"""i_{c} AS MATERIALIZED (SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS i
  FROM (SELECT {c} AS v, count(*) AS n FROM rows9 GROUP BY 1))"""
        for c in _INDEXED
    ],
)
