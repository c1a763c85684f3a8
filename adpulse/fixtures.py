"""Fixture views: the driver's generic tables mapped onto the ad-mediation
schemas the operators read (see FIXTURES.md).

Each view is ONE SQL text valid in Spark SQL and DuckDB. Two tokens differ:
``${MS}`` (epoch milliseconds of ``ts``) and ``${table}`` references, which
become ``parquet.`<dir>/<table>.parquet``` in Spark (no temp views, so no
session state) and the pre-registered view name in DuckDB. The oracle SQL of
every registered query inlines the views it needs as CTEs.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_MS = {
    # zone-free on a zone-less timestamp (no cast through the session zone, so
    # no DST shift): days * 86400000 + time of day in milliseconds
    "spark": ("(CAST(unix_date(CAST(ts AS DATE)) AS BIGINT) * 86400000 + hour(ts) * 3600000 + minute(ts) * 60000"
              " + CAST(floor(extract(SECOND FROM ts) * 1000) AS BIGINT))"),
    "duckdb": "(epoch_us(ts) // 1000)",
}

_UID = "concat('u', CAST(user_id AS STRING), '_', CAST(event_id % 7 AS STRING))"
_PUB = "CAST(1 + user_id % 3 AS INT)"
_APP = "CAST(10 * (1 + user_id % 3) + user_id % 2 AS INT)"
_CTRY = ("CASE WHEN user_id % 4 = 0 THEN 'US' WHEN user_id % 4 = 1 THEN 'CN' "
         "WHEN user_id % 4 = 2 THEN 'DE' ELSE 'BR' END")

# one row in 41 arrives late: its partition slot is an hour after its event hour
_SLOT = "(CASE WHEN event_id % 41 = 0 THEN ts + INTERVAL '1' HOUR ELSE ts END)"


def _counter(name: str, k: int) -> str:
    """A pre-aggregated counter that one untyped row in 3 carries, 0 included."""
    return f"CAST(CASE WHEN event_type = 'error' AND event_id % 3 = 2 THEN (event_id + {k}) % 5 END AS INT) AS {name}"


_COUNTERS = ", ".join(_counter(n, k) for k, n in enumerate(
    "wfFil insReq insFil vdStart vdEnd calledShow readyTrue readyFalse bidReq bidRes bidWin".split(), 1))



def _columns(key: str, ints: str = "", texts: str = "", lists: str = "", lines: str = "") -> str:
    """Further configuration columns, by a rule of the key: NULL in some rows
    of each, empty texts, list pieces that are blank or need trimming."""
    out = [f"CAST(CASE WHEN {key} % 7 = {k % 7} THEN NULL ELSE {key} % {5 + k} END AS INT) AS {n}"
           for k, n in enumerate(ints.split())]
    out += [f"CASE {key} % 5 WHEN {k % 5} THEN NULL WHEN {(k + 1) % 5} THEN '' ELSE concat('{n} ', CAST({key} % 9 AS STRING)) END AS {n}"
            for k, n in enumerate(texts.split())]
    out += [f"CASE WHEN {key} % 4 = {k % 4} THEN NULL ELSE concat('A{k}, b', CAST({key} % 3 AS STRING), ',,') END AS {n}"
            for k, n in enumerate(lists.split())]
    out += [f"CASE WHEN {key} % 4 = {k % 4} THEN NULL ELSE concat('M{k}, x', chr(10), ' n', CAST({key} % 3 AS STRING), chr(10)) END AS {n}"
            for k, n in enumerate(lines.split())]
    return ", ".join(out)


VIEWS: dict[str, str] = {}

VIEWS["f_lr"] = f"""
SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE ${{MS}} END AS serverTs,
       CAST({_SLOT} AS DATE) AS dt, CAST(hour({_SLOT}) AS INT) AS h,
       CASE WHEN event_id % 53 = 0 THEN NULL ELSE {_UID} END AS uid,
       concat('d', CAST(event_id % 997 AS STRING)) AS did,
       concat('10.0.0.', CAST(event_id % 211 AS STRING)) AS ip,
       {_PUB} AS publisherId,
       {_APP} AS pubAppId,
       CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(user_id % 2 AS INT) END AS plat,
       CASE WHEN event_id % 71 = 0 THEN NULL WHEN user_id % 4 = 0 THEN 'US' WHEN user_id % 4 = 1 THEN 'CN'
            WHEN user_id % 4 = 2 THEN 'DE' ELSE 'BR' END AS country,
       CAST(1 + event_id % 6 AS INT) AS pid,
       CASE WHEN event_id % 83 = 0 THEN NULL ELSE CAST(1 + event_id % 12 AS INT) END AS iid,
       CAST(1 + (event_id % 12) % 4 AS INT) AS mid,
       CAST(event_id % 3 AS INT) AS scene, CAST(user_id % 3 AS INT) AS abt, CAST(event_id % 2 AS INT) AS abtId,
       CAST(event_id % 5 AS INT) AS ruleId, CAST(event_id % 2 AS INT) AS bid,
       concat('1.', CAST(user_id % 2 AS STRING)) AS appv, '3.0' AS sdkv, concat('1', CAST(user_id % 4 AS STRING)) AS osv,
       CAST(CASE WHEN event_type = 'view' THEN 6
                 WHEN event_type = 'click' THEN 7
                 WHEN event_type = 'signup' THEN CASE event_id % 8 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 5
                                                 WHEN 4 THEN 8 WHEN 5 THEN 9 WHEN 6 THEN 501 ELSE 502 END
                 WHEN event_type = 'purchase' THEN CASE event_id % 4 WHEN 0 THEN 270 WHEN 1 THEN 271 WHEN 2 THEN 273 ELSE 503 END
                 WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 1 ELSE 0 END AS INT) AS type,
       CAST(CASE WHEN event_type = 'error' AND event_id % 3 <> 1 THEN event_id % 7 END AS INT) AS impr,
       CAST(CASE WHEN event_type = 'error' AND event_id % 3 <> 1 THEN event_id % 2 END AS INT) AS click,
       CAST(CASE WHEN event_type = 'error' AND event_id % 3 = 2 THEN event_id % 5 END AS INT) AS wfReq,
       {_COUNTERS},
       CAST(CASE WHEN event_type = 'purchase' AND event_id % 8 = 1 THEN value END AS DECIMAL(20,8)) AS bidResPrice,
       CAST(CASE WHEN event_type = 'purchase' AND event_id % 8 IN (2, 3) THEN value / 2 END AS DECIMAL(20,8)) AS bidWinPrice,
       CAST(value AS DECIMAL(20,8)) AS price,
       CAST(CASE WHEN event_type = 'view' THEN value END AS DECIMAL(20,8)) AS revenue
FROM ${{events}}
"""

VIEWS["f_iap"] = f"""
SELECT CAST(ts AS DATE) AS dt, {_UID} AS uid, {_PUB} AS publisherId, {_APP} AS pubAppId,
       {_CTRY} AS country, CAST(value AS DECIMAL(20,8)) AS iapUsd
FROM ${{events}} WHERE event_type = 'purchase'
"""

VIEWS["f_cptk"] = f"""
SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE ${{MS}} END AS ts_ms,
       CAST({_SLOT} AS DATE) AS dt, CAST(hour({_SLOT}) AS INT) AS h,
       {_PUB} AS publisherId, {_APP} AS pubAppId,
       CAST(1 + event_id % 6 AS INT) AS pid, CASE WHEN event_id % 71 = 0 THEN NULL ELSE 'US' END AS cy,
       CASE WHEN event_id % 67 = 0 THEN NULL ELSE concat('app', CAST(event_id % 9 AS STRING)) END AS appId,
       event_id % 20 AS cid, event_id % 40 AS crid,
       CASE WHEN event_type = 'view' THEN 1 END AS impr, CASE WHEN event_type = 'click' THEN 1 END AS click,
       CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(20,8)) END AS cost
FROM ${{events}} WHERE event_type IN ('view', 'click')
"""

VIEWS["f_cost"] = f"""
SELECT CAST(ts AS DATE) AS dt, {_PUB} AS publisher_id, {_APP} AS pub_app_id,
       CAST(user_id % 2 AS INT) AS platform, CAST(1 + (event_id % 12) % 4 AS INT) AS adn_id,
       CAST(1 + event_id % 12 AS INT) AS instance_id, {_CTRY} AS country,
       CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(value AS DECIMAL(20,8)) END AS cost
FROM ${{events}} WHERE event_type IN ('signup', 'purchase', 'view')
"""

VIEWS["f_stat"] = """
SELECT CAST(l_shipdate AS DATE) AS day, CAST(1 + l_suppkey % 3 AS INT) AS publisher_id, CAST(l_suppkey % 100 AS INT) AS pub_app_id,
       CAST(l_suppkey AS INT) AS instance_id, CAST(l_suppkey % 24 AS INT) AS adn_id, CAST(l_partkey % 50 AS INT) AS placement_id,
       CAST(l_linenumber % 5 AS INT) AS ad_type,
       CASE WHEN l_orderkey % 61 = 0 THEN NULL ELSE n_name END AS country,
       CAST(l_quantity * 100 AS BIGINT) AS api_impr, CAST(l_quantity AS BIGINT) AS api_click,
       CAST(l_quantity * 300 AS BIGINT) AS api_request, CAST(l_quantity * 200 AS BIGINT) AS api_filled,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue,
       CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS cost
FROM ${lineitem} JOIN ${supplier} ON l_suppkey = s_suppkey JOIN ${nation} ON s_nationkey = n_nationkey
"""

VIEWS["f_adn"] = """
SELECT CAST(s_suppkey AS INT) AS id, s_name AS name, concat('Adn', CAST(s_suppkey AS STRING)) AS class_name,
       CASE WHEN s_suppkey % 11 = 0 THEN 0 ELSE 1 END AS status,
       CASE WHEN s_suppkey IN (0, 10, 16, 22) THEN NULL ELSE CAST(1 + (s_suppkey * 7) % 47 AS INT) END AS delay_hours,
       """ + _columns("s_suppkey", "type bid_type expired_time", "sdk_version bid_endpoint descn") + """
FROM ${supplier}
"""

VIEWS["f_publisher"] = """
SELECT CAST(n_nationkey AS INT) AS id, CASE WHEN n_nationkey % 5 = 3 THEN 0 ELSE 1 END AS status,
       CAST(CASE WHEN n_nationkey % 4 = 1 THEN NULL ELSE n_nationkey % 2 END AS INT) AS impr_callback_switch
FROM ${nation}
"""

VIEWS["f_app"] = """
SELECT CAST(s_suppkey AS INT) AS id, CAST(1 + s_nationkey % 5 AS INT) AS publisher_id, CAST(s_suppkey % 2 AS INT) AS plat,
       s_name AS app_name, CASE WHEN s_suppkey % 13 = 0 THEN 0 ELSE 1 END AS status,
       CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '100,101,205' ELSE '5,,x,6,,' END AS sdk_event_ids,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL WHEN s_suppkey % 4 = 1 THEN '' ELSE 'US,DE' END AS uar_regions,
       CASE WHEN s_suppkey % 3 = 0 THEN '{"US":[1.5,2],"FR":[3],"DE":[0.25]}' WHEN s_suppkey % 3 = 1 THEN ' ' ELSE NULL END AS uar_manual,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST(s_suppkey % 1000 AS INT) AS create_time,
       """ + _columns("s_suppkey", "", "app_key bundle_id app_id") + """
FROM ${supplier}
"""

VIEWS["f_placement"] = """
SELECT CAST(p_partkey AS INT) AS id, CAST(p_partkey % 100 AS INT) AS pub_app_id, p_name AS name, CAST(p_size % 7 AS INT) AS ad_type,
       CASE WHEN p_partkey % 17 = 0 THEN 0 ELSE 1 END AS status, CAST(CASE WHEN p_partkey % 10 = 3 THEN NULL ELSE p_partkey % 2 END AS INT) AS floor_price_switch,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(8,3)) END AS floor_price,
       CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE concat(p_brand, ', ', p_type, ',,') END AS make_blacklist,
       CASE p_partkey % 5 WHEN 0 THEN '(,5.0); 6.1; [7.0, 8.0)' WHEN 1 THEN '[9,]; (10,11]' WHEN 2 THEN ' 4.4 ;; 5 '
                          WHEN 3 THEN '(,)' ELSE NULL END AS osv_exp,
       CASE p_partkey % 4 WHEN 0 THEN '5:30' WHEN 1 THEN '' WHEN 2 THEN concat('5:30', chr(10), '9:90', chr(10), 'x', chr(10), '5:40')
                          ELSE '8:300' END AS inventory_interval_step,
       """ + _columns("p_partkey", "main_placement hb_status batch_size preload_timeout fan_out inventory_count inventory_interval"
                      " reload_interval frequency_cap frequency_unit frequency_interval", "ic_url osv_max osv_min",
                      "osv_blacklist osv_whitelist make_whitelist did_blacklist sdkv_blacklist",
                      "brand_blacklist brand_whitelist model_blacklist model_whitelist") + """
FROM ${part}
"""

VIEWS["f_instance"] = """
SELECT CAST(p_partkey AS INT) AS id, CAST(p_partkey % 24 AS INT) AS adn_id, CAST(p_partkey % 100 AS INT) AS pub_app_id,
       CAST(p_partkey % 500 AS INT) AS placement_id, p_name AS name, CASE WHEN p_partkey % 19 = 0 THEN 0 ELSE 1 END AS status,
       CAST(p_partkey % 2 AS INT) AS hb_status, CAST(p_size AS INT) AS hour0, CAST(p_partkey % 4 AS INT) AS hour1,
       0 AS hour2, 0 AS hour3, 0 AS hour4, 0 AS hour5, 0 AS hour6,
       """ + _columns("p_partkey", "frequency_cap frequency_unit frequency_interval", "placement_key osv_max osv_min",
                      "make_whitelist make_blacklist", "brand_whitelist brand_blacklist model_whitelist model_blacklist") + """
FROM ${part}
"""

VIEWS["f_campaign"] = """
SELECT c_custkey AS id, CAST(1 + c_nationkey % 5 AS INT) AS publisher_id, c_name AS name,
       CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END AS status, CAST(floor(c_acctbal / 100) AS INT) AS daily_cap,
       concat('app', CAST(c_custkey % 60 AS STRING)) AS app_id,
       CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 40 * 0.125 AS DECIMAL(10,3)) END AS price,
       CASE WHEN c_custkey % 9 = 1 THEN NULL ELSE CAST(c_custkey % 300 AS DECIMAL(10,3)) END AS daily_budget,
       CASE WHEN c_custkey % 9 = 2 THEN NULL ELSE CAST(c_custkey % 8 * 0.5 AS DECIMAL(10,3)) END AS max_bidprice,
       CASE WHEN c_custkey % 9 = 3 THEN NULL ELSE CAST(c_custkey % 8 * 0.25 AS DECIMAL(10,3)) END AS bidprice,
       TIMESTAMP '1998-01-01 00:00:00' AS start_time, TIMESTAMP '1999-01-01 00:00:00' AS end_time,
       """ + _columns("c_custkey", "ska_campaign_id type platform billing_type impr_cap impr_freq open_type",
                      "app_name preview_url ad_domain click_url", "click_tk_urls impr_tk_urls") + """
FROM ${customer}
"""

# one campaign in 5 has no hour masks at all
VIEWS["f_campaign_period"] = """
SELECT c_custkey AS campaign_id, hour_mask AS hour0, hour_mask AS hour1, hour_mask AS hour2, hour_mask AS hour3,
       hour_mask AS hour4, hour_mask AS hour5, hour_mask AS hour6
FROM (SELECT *, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 8 ELSE 16777207 END AS hour_mask
      FROM ${customer} WHERE c_custkey % 5 <> 2) c
"""

# every campaign has a price in two or three countries; 'US' repeats
VIEWS["f_bidprice"] = """
SELECT CAST(c_custkey * 10 AS BIGINT) AS id, c_custkey AS campaign_id, 'US' AS country, CAST(1.25 AS DECIMAL(10,3)) AS bidprice FROM ${customer}
UNION ALL
SELECT CAST(c_custkey * 10 + 1 AS BIGINT) AS id, c_custkey AS campaign_id, 'DE' AS country,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 9 * 0.5 AS DECIMAL(10,3)) END AS bidprice FROM ${customer}
UNION ALL
SELECT CAST(c_custkey * 10 + 2 AS BIGINT) AS id, c_custkey AS campaign_id, 'US' AS country, CAST(2.5 AS DECIMAL(10,3)) AS bidprice
FROM ${customer} WHERE c_custkey % 2 = 0
"""

VIEWS["f_campaign_prev"] = """
SELECT c_custkey AS id, CAST(floor(c_acctbal / 100) AS INT) + CASE WHEN c_custkey % 3 = 0 THEN 5 ELSE 0 END AS daily_cap
FROM ${customer} WHERE c_custkey % 5 <> 0
"""

VIEWS["f_targeting"] = """
SELECT o_custkey AS campaign_id, CAST(o_orderkey % 20 AS INT) AS type,
       CASE WHEN o_orderkey % 20 IN (15, 16) THEN '[7.0, 8.0); 6.1' WHEN o_orderkey % 20 < 4 THEN CAST(o_orderkey % 300 AS STRING)
            ELSE o_orderpriority END AS content
FROM ${orders}
"""

VIEWS["f_creative"] = """
SELECT o_orderkey AS id, o_custkey AS campaign_id, CAST(o_orderkey % 4 AS INT) AS weight,
       CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS status,
       """ + _columns("o_orderkey", "type template endcard_template", "name title descn play_url") + """
FROM ${orders}
"""

VIEWS["f_creative_material"] = """
SELECT l_orderkey AS creative_id, l_partkey AS material_id FROM ${lineitem}
"""

VIEWS["f_dict"] = """
SELECT CAST(r_regionkey + 1 AS INT) AS id, 0 AS pid, r_name AS name, CAST(r_regionkey AS STRING) AS value FROM ${region}
UNION ALL
SELECT CAST(n_nationkey + 100 AS INT), CAST(n_regionkey + 1 AS INT), n_name, concat('v', CAST(n_nationkey AS STRING)) FROM ${nation}
"""

VIEWS["f_quotes"] = """
SELECT CASE WHEN n_nationkey = 0 THEN 'USD' ELSE concat('C', CAST(n_nationkey AS STRING)) END AS cur,
       CAST(1 + n_nationkey * 0.37 AS DECIMAL(18,6)) AS rate
FROM ${nation}
"""

VIEWS["f_scene"] = """
SELECT CAST(p_partkey AS INT) AS id, CAST(p_partkey % 500 AS INT) AS placement_id, p_name AS name, CAST(p_size AS INT) AS frequency_cap,
       CASE WHEN p_partkey % 7 = 0 THEN 0 ELSE 1 END AS status, """ + _columns("p_partkey", "frequency_unit is_default") + """
FROM ${part}
"""

# placement (instance) x country pairs that carry traffic: the distinct
# (part, supplier nation) pairs of lineitem
_PC_BASE = """
SELECT DISTINCT CAST(l_partkey * 100 + n_nationkey AS INT) AS id, CAST(l_partkey AS INT) AS {key}, n_name AS country,
       CAST(CASE WHEN n_nationkey % 7 = 2 THEN NULL ELSE (l_partkey + n_nationkey) % 2 END AS INT) AS floor_price_switch,
       CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE CAST(n_nationkey * 0.25 AS DECIMAL(8,3)) END AS floor_price,
       CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(n_nationkey * 0.5 AS DECIMAL(8,3)) END AS max_price,
       CAST(n_nationkey % 3 AS INT) AS hour0, CAST(l_partkey % 4 AS INT) AS hour1,
       CASE WHEN n_nationkey % 6 = 1 THEN NULL ELSE CAST(n_nationkey % 3 * 0.5 AS DECIMAL(8,3)) END AS manual_ecpm
FROM ${{lineitem}} JOIN ${{supplier}} ON l_suppkey = s_suppkey JOIN ${{nation}} ON s_nationkey = n_nationkey
"""
# one pair in 11 has a second, later row with other values
_PC = f"""
SELECT * FROM ({_PC_BASE}) a
UNION ALL
SELECT id + 1000000000 AS id, {{key}}, country, 1 AS floor_price_switch, CAST(7.125 AS DECIMAL(8,3)) AS floor_price,
       CAST(9.5 AS DECIMAL(8,3)) AS max_price, 5 AS hour0, 0 AS hour1, CAST(4.5 AS DECIMAL(8,3)) AS manual_ecpm
FROM ({_PC_BASE}) b WHERE id % 11 = 0
"""
VIEWS["f_placement_country"] = _PC.format(key="placement_id")
VIEWS["f_instance_country"] = _PC.format(key="instance_id")

VIEWS["f_block_rule"] = """
SELECT CAST(s_suppkey AS INT) AS id, CAST(s_suppkey % 40 AS INT) AS pub_app_id, CAST(s_suppkey % 24 AS INT) AS adn_id,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE ' SamSung, HTC,,' END AS make_device_blacklist,
       CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE 1 END AS status,
       """ + _columns("s_suppkey", "", "sdk_version app_version osv_max osv_min", "", "brand_model_blacklist") + """
FROM ${supplier}
"""

VIEWS["f_rule"] = """
SELECT CAST(c_custkey AS INT) AS id, CAST(c_custkey % 500 AS INT) AS placement_id, CAST(c_custkey % 2 AS INT) AS sort_type,
       CAST(c_custkey % 3 AS INT) AS ab_test, CASE WHEN c_custkey % 8 = 0 THEN 0 ELSE 1 END AS status,
       CAST(1 + c_custkey % 5 AS INT) AS publisher_id, CAST(c_custkey % 9 AS INT) AS pub_app_id,
       CAST(c_custkey + 50 AS INT) AS segment_id,
       """ + _columns("c_custkey", "auto_opt priority algorithm_id", "name") + """
FROM ${customer}
"""

# the last rules' segment ids do not exist
VIEWS["f_segment"] = """
SELECT CAST(c_custkey AS INT) AS id,
       CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'US,DE,,' ELSE 'US,DE,CN' END AS countries,
       CASE c_custkey % 3 WHEN 0 THEN '(,5.0); 6.1; [7.0, 8.0)' WHEN 1 THEN '[9,]' ELSE NULL END AS osv_exp,
       CASE c_custkey % 5 WHEN 0 THEN '[3.1,3.2]; 4.0' WHEN 1 THEN ' ; 2.9' ELSE NULL END AS sdkv_exp,
       CASE c_custkey % 4 WHEN 0 THEN '(1.0,)' WHEN 1 THEN '1.5;1.6' ELSE NULL END AS appv_exp,
       CASE c_custkey % 4 WHEN 0 THEN '{"vip":{"type":0,"conditions":[{"operator":"in","value":"a, b,,"},{"operator":"=","value":""}]}}'
                          WHEN 1 THEN '{"lvl":{"type":1,"conditions":[{"operator":">=","value":"3"}]}}'
                          WHEN 2 THEN '{"none":{"type":0}}' ELSE NULL END AS custom_tags,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 10 * 0.25 AS DECIMAL(8,3)) END AS iap_min,
       CASE WHEN c_custkey % 3 = 1 THEN NULL ELSE CAST(c_custkey % 20 * 0.5 AS DECIMAL(8,3)) END AS iap_max,
       """ + _columns("c_custkey", "frequency con_type gender age_min age_max model_type channel_bow require_did", "", "",
                      "brand_whitelist brand_blacklist model_whitelist model_blacklist interest channel") + """
FROM ${customer}
"""

VIEWS["f_rule_instance"] = """
SELECT CAST(o_custkey AS INT) AS rule_id, CAST(o_orderkey % 2000 AS INT) AS instance_id, CAST(o_orderkey % 3 AS INT) AS group_id,
       CAST(o_custkey % 2 AS INT) AS sort_type, CAST(o_orderkey AS INT) AS priority, CAST(o_orderkey % 5 AS INT) AS weight,
       CAST(o_orderkey % 3 AS INT) AS ab_test, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS status FROM ${orders}
"""

VIEWS["f_rule_group"] = """
SELECT CAST(c_custkey AS INT) AS rule_id, 1 AS id, 1 AS group_level, 1 AS auto_switch,
       CAST(c_custkey % 3 AS INT) AS ab_test FROM ${customer}
UNION ALL
SELECT CAST(c_custkey AS INT) AS rule_id, 2 AS id, 2 AS group_level, 1 AS auto_switch,
       CAST(c_custkey % 3 AS INT) AS ab_test FROM ${customer}
"""

VIEWS["f_abtest"] = """
SELECT CAST(c_custkey % 500 AS INT) AS placement_id, CAST(c_custkey AS INT) AS a_rule_id, CAST(c_custkey + 1 AS INT) AS b_rule_id,
       CAST(c_custkey % 100 AS INT) AS a_per, CAST(100 - c_custkey % 100 AS INT) AS b_per,
       CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS status FROM ${customer}
"""

VIEWS["f_dev_app"] = """
SELECT CAST(o_custkey % 5 AS INT) AS publisher_id, CAST(o_orderkey AS INT) AS pub_app_id, CAST(o_orderkey % 24 AS INT) AS adn_id,
       o_orderdate AS active_time, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS status FROM ${orders}
"""

VIEWS["f_material"] = """
SELECT p_partkey AS id, CAST(p_size % 3 AS INT) AS type, concat('https://cdn.example/', CAST(p_partkey AS STRING)) AS url,
       CASE WHEN p_partkey % 10 = 0 THEN 0 ELSE 1 END AS status,
       """ + _columns("p_partkey", "width height size video_duration need_carousel", "mime_type") + """
FROM ${part}
"""

VIEWS["f_store_app"] = """
SELECT CAST(s_suppkey AS INT) AS id, concat('app', CAST(s_suppkey % 60 AS STRING)) AS app_id, CAST(s_suppkey % 2 AS INT) AS plat,
       CASE s_suppkey % 5 WHEN 0 THEN 'Varies with device' WHEN 1 THEN '4.4 and up' WHEN 2 THEN '5.0 - 9.0' WHEN 3 THEN '11.0'
            ELSE NULL END AS os_require,
       CASE WHEN s_suppkey % 4 = 1 THEN NULL ELSE CAST(s_suppkey % 50 * 0.125 AS DECIMAL(8,3)) END AS rating_value,
       """ + _columns("s_suppkey", "rating_count category_id sub_category_id1 sub_category_id2", "name icon category") + """
FROM ${supplier}
"""

VIEWS["f_country"] = """
SELECT n_name AS a2, upper(n_name) AS a3, CAST(n_nationkey - 12 AS INT) AS tz, CAST(n_regionkey AS INT) AS dcenter FROM ${nation}
"""

# Daily per-app x country UAR price series (stat_pub_app_country_uar), derived
# from f_stat; ad types 0/1 are relabelled US/DE so the region whitelist of
# f_app ('US,DE') selects some of them. All values are exact at 8 decimals.
VIEWS["f_uar"] = """
SELECT pub_app_id, CASE WHEN ad_type = 0 THEN 'US' WHEN ad_type = 1 THEN 'DE' ELSE country END AS country, day,
       CAST(CAST(SUM(revenue) AS DECIMAL(20,2)) / CAST(100000 AS DECIMAL(10,0)) AS DECIMAL(10,8)) AS uar1,
       CAST(CAST(SUM(api_click) AS DECIMAL(20,0)) / CAST(10000 AS DECIMAL(10,0)) AS DECIMAL(10,8)) AS uar2,
       CAST(CAST(SUM(api_impr) AS DECIMAL(20,0)) / CAST(10000000 AS DECIMAL(10,0)) AS DECIMAL(10,8)) AS uar3,
       CAST(CAST(SUM(revenue) AS DECIMAL(20,2)) / CAST(1000000 AS DECIMAL(10,0)) AS DECIMAL(10,8)) AS uar4,
       CAST(CAST(COUNT(*) AS DECIMAL(20,0)) / CAST(1000 AS DECIMAL(10,0)) AS DECIMAL(10,8)) AS uar5
FROM ${f_stat} s WHERE country IS NOT NULL
GROUP BY pub_app_id, CASE WHEN ad_type = 0 THEN 'US' WHEN ad_type = 1 THEN 'DE' ELSE country END, day
"""

_TOKEN = re.compile(r"\$\{(\w+)\}")


def render(view_sql: str, dialect: str, sf_dir: str | None = None) -> str:
    def sub(m):
        name = m.group(1)
        if name == "MS":
            return _MS[dialect]
        if name in VIEWS:  # a view built on another view
            return f"({render(VIEWS[name], dialect, sf_dir)})" if dialect == "spark" else name
        if dialect == "spark":
            return f"parquet.`{sf_dir.rstrip('/')}/{name}.parquet`"
        return name
    return _TOKEN.sub(sub, view_sql)


_VIEW_CACHE: dict[tuple, DataFrame] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame of fixture view ``name`` over the tables in ``sf_dir``
    (analysed once per session and reused: DataFrames are immutable)."""
    key = (spark._jsparkSession.sessionUUID(), sf_dir.rstrip("/"), name)
    df = _VIEW_CACHE.get(key)
    if df is None:
        df = _VIEW_CACHE[key] = spark.sql(render(VIEWS[name], "spark", sf_dir))
    return df


class Views:
    """Lazy accessor: ``Views(spark, sf_dir).f_lr``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        return view(self._spark, self._dir, name)


def with_views(names: list[str], body: str) -> str:
    """DuckDB oracle text: ``WITH <views> <body>``."""
    ctes = ",\n".join(f"{n} AS ({render(VIEWS[n], 'duckdb')})" for n in names)
    return f"WITH {ctes}\n{body}"
