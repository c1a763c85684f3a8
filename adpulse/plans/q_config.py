"""Registered configuration snapshots (G1-G33), nested columns flattened to
text so the DuckDB oracle can compare them: lists joined with ``|`` (in the
operator's order), structs with ``:``, maps as sorted ``k=v`` entries,
floats through ``decimal(18,3)``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixtures import Views, with_views
from ..functions.text import range_exp, render_ranges, text_list
from ..operators import forecast
from ..snapshots import common, inventory, promotion, rules
from .registry import register

CP_NOW = _dt.datetime(1998, 6, 15, 3, 0, 0)       # fixture clock: bit 8 set in the hour masks


# ---------------------------------------------------------------- flatten helpers (Spark)

def j(arr: Column) -> Column:
    return F.array_join(arr, "|")


def f3(x: Column) -> Column:
    return x.cast("decimal(18,3)").cast("string")


def map_text(m: Column, value_fn=lambda v: v.cast("string"), sep: str = "|") -> Column:
    """Sorted ``key=value`` entries (keys sorted; values may be any type)."""
    return F.array_join(F.transform(F.array_sort(F.map_keys(m)), lambda k: F.concat(
        k.cast("string"), F.lit("="), value_fn(F.element_at(m, k)))), sep)


# ---------------------------------------------------------------- DuckDB text helpers

def d_list(x: str, split: str = "[,\\r\\n]", lower: bool = False) -> str:
    item = "lower(trim(s))" if lower else "trim(s)"
    return (f"list_filter(list_transform(regexp_split_to_array(coalesce({x}, ''), '{split}'), lambda s: {item}), "
            f"lambda s: s <> '')")


def d_parts(x: str) -> str:
    return (f"list_filter(list_transform(string_split(coalesce({x}, ''), ';'), lambda s: trim(s)), "
            f"lambda s: s <> '')")


def d_ranges(x: str) -> str:
    inner = "substr(r, 2, length(r) - 2)"
    body = (f"(CASE WHEN left(r, 1) = '(' THEN '(' ELSE '[' END) || trim(split_part({inner}, ',', 1)) || ',' || "
            f"trim(split_part({inner}, ',', 2)) || (CASE WHEN right(r, 1) = ')' THEN ')' ELSE ']' END)")
    return (f"array_to_string(list_transform(list_filter({d_parts(x)}, lambda r: left(r, 1) IN ('[', '(')), "
            f"lambda r: {body}), '|')")


def d_items(x: str) -> str:
    return f"array_to_string(list_filter({d_parts(x)}, lambda r: left(r, 1) NOT IN ('[', '(')), '|')"


def d_ints(names: str, of: str = "") -> str:
    return ", ".join(f"coalesce({of}{n}, 0) AS {n}" for n in names.split())


def d_text(x: str) -> str:
    return f"CASE WHEN trim(coalesce({x}, '')) <> '' THEN {x} ELSE '' END"


def d_texts(names: str, of: str = "") -> str:
    return ", ".join(f"{d_text(of + n)} AS {n}" for n in names.split())


def d_lists(names: str, of: str = "", split: str = "[,\\r\\n]") -> str:
    return ", ".join(f"array_to_string({d_list(of + n, split)}, '|') AS {n}" for n in names.split())


def joined(names: str) -> list[Column]:
    return [j(F.col(n)).alias(n) for n in names.split()]


# the block rules of an app (or of an app's network) as one text, by id
_VERSIONS = " || ':' || ".join(d_text(n) for n in "sdk_version app_version osv_max osv_min".split())


def _block_rules_sql(split: str) -> str:
    return (f"array_to_string(list(CAST(id AS VARCHAR) || ':' || {_VERSIONS} || ':' || array_to_string("
            f"{d_list('make_device_blacklist', split=split, lower=True)}, '|') || ':' || array_to_string("
            f"{d_list('brand_model_blacklist', split=chr(92) + 'n', lower=True)}, '|') ORDER BY id), '|') AS block_rules")


def _block_rules_text() -> Column:
    return j(F.transform("block_rules", lambda r: F.concat_ws(
        ":", r["id"].cast("string"), r["sdk_version"], r["app_version"], r["osv_max"], r["osv_min"],
        j(r["make_device_blacklist"]), j(r["brand_model_blacklist"])))).alias("block_rules")


# ---------------------------------------------------------------- G20 / G21

@register("range_exprs", with_views(["f_placement", "f_segment"], f"""
SELECT 'placement' AS src, id, {d_ranges('osv_exp')} AS ranges, {d_items('osv_exp')} AS items FROM f_placement
UNION ALL
SELECT 'rule' AS src, id, {d_ranges('osv_exp')} AS ranges, {d_items('osv_exp')} AS items FROM f_segment
"""))
def q_range_exprs(spark, sf_dir):
    v = Views(spark, sf_dir)

    def parse(df, src):
        r = range_exp("osv_exp")
        return df.select(F.lit(src).alias("src"), "id", render_ranges(r["ranges"]).alias("ranges"),
                         j(r["items"]).alias("items"))
    return parse(v.f_placement, "placement").unionByName(parse(v.f_segment, "rule"))


@register("text_lists", with_views(["f_placement", "f_block_rule"], f"""
SELECT 'placement' AS src, id, array_to_string({d_list('make_blacklist')}, '|') AS items FROM f_placement
UNION ALL
SELECT 'block_rule' AS src, id, array_to_string({d_list('make_device_blacklist', lower=True)}, '|') AS items
FROM f_block_rule
"""))
def q_text_lists(spark, sf_dir):
    v = Views(spark, sf_dir)
    a = v.f_placement.select(F.lit("placement").alias("src"), "id", j(text_list("make_blacklist")).alias("items"))
    b = v.f_block_rule.select(F.lit("block_rule").alias("src"), "id",
                              j(text_list("make_device_blacklist", lower=True)).alias("items"))
    return a.unionByName(b)


# ---------------------------------------------------------------- G22 / G23

@register("dict_paths", "WITH RECURSIVE " + with_views(["f_dict"], """
, p(id, path) AS (SELECT id, '/' || name FROM f_dict WHERE pid = 0
                  UNION ALL SELECT c.id, p.path || '/' || c.name FROM f_dict c JOIN p ON c.pid = p.id)
, kids AS (SELECT pid AS id, array_to_string(list(value ORDER BY id), '|') AS children FROM f_dict GROUP BY pid)
SELECT p.path, t.value, coalesce(TRY_CAST(t.value AS INTEGER), 0) AS int_value, coalesce(k.children, '') AS children
FROM p JOIN f_dict t ON p.id = t.id LEFT JOIN kids k ON k.id = p.id
""")[len("WITH "):])
def q_dict_paths(spark, sf_dir):
    """Dictionary rows with resolved paths, typed lookups with a
    default and child values."""
    d = common.dict_table(Views(spark, sf_dir).f_dict)
    paths = common.dict_paths(d)
    ints = common.dict_lookup(paths, "int", 0).withColumnRenamed("value", "int_value")
    kids = common.dict_children(d, paths).select("path", j(F.col("children")).alias("children"))
    return paths.select("path", "value").join(ints, "path").join(kids, "path")


# ---------------------------------------------------------------- G24 / G25

@register("snap_country", with_views(["f_country"], "SELECT a2, a3, tz, dcenter FROM f_country"))
def q_snap_country(spark, sf_dir):
    return common.country(Views(spark, sf_dir).f_country)


@register("snap_currency", with_views(["f_quotes"], """
, q AS (SELECT * FROM f_quotes)
SELECT cur AS cur_from, 'USD' AS cur_to, CAST(rate AS DOUBLE) AS exchange_rate FROM q
"""))
def q_snap_currency(spark, sf_dir):
    q = Views(spark, sf_dir).f_quotes.select(F.col("cur").alias("cur_from"), F.lit("USD").alias("cur_to"),
                                              F.col("rate").alias("exchange_rate"))
    return common.currency(q).withColumn("exchange_rate", F.col("exchange_rate").cast("double"))


# ---------------------------------------------------------------- G1-G3

def _uar_auto(v):
    """Automatic UAR JSON per app: the E4 region map of the app's latest run day."""
    fc = forecast.forecast_uar(v.f_app, v.f_uar)
    m = forecast.uar_region_map(fc, v.f_app)
    return m.groupBy(F.col("pub_app_id").alias("id")).agg(F.max_by("region_uar_json", "run_day").alias("uar_auto"))


_EVENT_IDS_SQL = """CASE WHEN trim(coalesce(sdk_event_ids, '')) <> '' THEN array_to_string(list_transform(
            string_split(regexp_replace(sdk_event_ids, ',+$', ''), ','), lambda x: CAST(coalesce(TRY_CAST(x AS INTEGER), 0) AS VARCHAR)), '|')
            ELSE '' END AS event_ids"""
_APP_SQL = f"""a.id, a.publisher_id, a.plat, a.app_name, {d_texts("app_key bundle_id", "a.")},
       CAST(epoch(a.create_time) AS INTEGER) AS create_time, coalesce(pu.impr_callback_switch, 0) AS impr_callback_switch,
       {_EVENT_IDS_SQL}"""
_APP_RULES_SQL = f"""
, br AS (SELECT pub_app_id, {_block_rules_sql('[,' + chr(92) + 'n]')} FROM f_block_rule WHERE status = 1 GROUP BY pub_app_id)"""


def _snap_app_oracle() -> str:
    from .q_forecast import forecast_cte
    vals = " || '|' || ".join(
        f"CAST(CAST(CAST(f.uar{k} * 1000 AS FLOAT) AS DECIMAL(18,3)) AS VARCHAR)" for k in range(1, 6))
    return with_views(["f_stat", "f_uar", "f_app", "f_block_rule", "f_publisher"], forecast_cte(1) + f"""
, latest AS (SELECT pub_app_id, max(run_day) AS rd FROM fc GROUP BY pub_app_id)
, cu AS (SELECT f.pub_app_id, string_agg(f.country || ':' || {vals}, '|' ORDER BY f.country) AS country_uars
         FROM fc f JOIN latest l ON f.pub_app_id = l.pub_app_id AND f.run_day = l.rd
              JOIN f_app a ON a.id = f.pub_app_id
         WHERE trim(coalesce(a.uar_regions, '')) <> '' AND list_contains(string_split(a.uar_regions, ','), f.country)
         GROUP BY f.pub_app_id)
{_APP_RULES_SQL}
SELECT {_APP_SQL},
       CASE WHEN trim(coalesce(uar_manual, '')) = '' THEN coalesce(cu.country_uars, '')
            WHEN trim(coalesce(uar_regions, '')) = '' THEN '' ELSE 'DE:0.250|US:1.500|2.000' END AS country_uars,
       coalesce(br.block_rules, '') AS block_rules
FROM f_app a JOIN f_publisher pu ON pu.id = a.publisher_id LEFT JOIN cu ON cu.pub_app_id = a.id
LEFT JOIN br ON br.pub_app_id = a.id WHERE a.status = 1 AND pu.status = 1
""")


_APP_COLUMNS = ["id", "publisher_id", "plat", "app_name", "app_key", "bundle_id", "create_time", "impr_callback_switch"]


@register("snap_app", _snap_app_oracle())
def q_snap_app(spark, sf_dir):
    """A third of the apps has a manual UAR JSON; the automatic one of
    an app is the E4 region map of its latest forecast day."""
    v = Views(spark, sf_dir)
    out = inventory.publisher_app(v.f_app.join(_uar_auto(v), "id", "left"), v.f_block_rule, v.f_publisher)
    return out.select(*_APP_COLUMNS, j(F.col("event_ids").cast("array<string>")).alias("event_ids"),
                      j(F.transform("country_uars", lambda c: F.concat(c["country"], F.lit(":"), j(
                          F.transform(c["uarx"], lambda x: f3(x)))))).alias("country_uars"), _block_rules_text())


@register("snap_app_rules", with_views(["f_app", "f_block_rule", "f_publisher"], f"""
{_APP_RULES_SQL}
SELECT {_APP_SQL}, coalesce(br.block_rules, '') AS block_rules
FROM f_app a JOIN f_publisher pu ON pu.id = a.publisher_id LEFT JOIN br ON br.pub_app_id = a.id
WHERE a.status = 1 AND pu.status = 1
"""))
def q_snap_app_rules(spark, sf_dir):
    """Active apps with event ids and block rules (no UAR part)."""
    v = Views(spark, sf_dir)
    out = inventory.publisher_app(v.f_app, v.f_block_rule, v.f_publisher)
    return out.select(*_APP_COLUMNS, j(F.col("event_ids").cast("array<string>")).alias("event_ids"), _block_rules_text())


# ---------------------------------------------------------------- G4-G7

def _period_text(p: Column) -> Column:
    return map_text(p)


_PRICE = ("CAST(CAST(CASE WHEN coalesce({0}floor_price_switch, 0) = 0 OR {0}{1} IS NULL THEN -1 ELSE {0}{1} END"
          " AS DECIMAL(18,3)) AS VARCHAR)")
_HOURS = "concat_ws('|', CASE WHEN hour0 > 0 THEN '0=' || hour0 END, CASE WHEN hour1 > 0 THEN '1=' || hour1 END)"
_PL_INTS = ("batch_size preload_timeout frequency_cap frequency_unit frequency_interval inventory_count inventory_interval"
            " reload_interval")
_PL_LISTS = "osv_blacklist osv_whitelist make_blacklist make_whitelist did_blacklist sdkv_blacklist"
_LINES = "brand_blacklist brand_whitelist model_blacklist model_whitelist"


@register("snap_placement", with_views(["f_placement", "f_app", "f_scene", "f_placement_country", "f_publisher"], f"""
, pl AS (SELECT p.*, a.plat, a.publisher_id, a.app_id FROM f_placement p JOIN f_app a ON p.pub_app_id = a.id
         JOIN f_publisher u ON u.id = a.publisher_id WHERE p.status = 1 AND a.status = 1 AND u.status = 1)
, sc AS (SELECT placement_id, array_to_string(list(CAST(id AS VARCHAR) || ':' || coalesce(frequency_cap, 0) || ':' ||
                coalesce(frequency_unit, 0) || ':' || coalesce(is_default, 0) ORDER BY id), '|') AS scenes
         FROM f_scene WHERE status = 1 AND placement_id IN (SELECT id FROM f_placement WHERE status = 1)
         GROUP BY placement_id)
, pc AS (SELECT placement_id, array_to_string(list(country || '=' || {_PRICE.format('', 'floor_price')} || ':' ||
                {_PRICE.format('', 'max_price')} || ':' || {_HOURS} ORDER BY country), ';') AS country_settings
         FROM (SELECT *, row_number() OVER (PARTITION BY placement_id, country ORDER BY id DESC) AS rn FROM f_placement_country) x
         WHERE rn = 1 AND placement_id IN (SELECT id FROM pl)
         GROUP BY placement_id)
, ln AS (SELECT id, unnest(regexp_split_to_array(coalesce(inventory_interval_step, ''), '[\\r\\n]')) AS line,
                generate_subscripts(regexp_split_to_array(coalesce(inventory_interval_step, ''), '[\\r\\n]'), 1) AS n FROM f_placement)
, kv AS (SELECT id, CAST(regexp_extract(line, '(\\d+):(\\d+)', 1) AS INTEGER) AS k,
                arg_max(CAST(regexp_extract(line, '(\\d+):(\\d+)', 2) AS INTEGER), n) AS v
         FROM ln WHERE regexp_matches(line, '(\\d+):(\\d+)') GROUP BY ALL)
, st AS (SELECT id, array_to_string(list(CAST(k AS VARCHAR) || '=' || CAST(v AS VARCHAR) ORDER BY k), '|') AS steps
         FROM kv GROUP BY id)
SELECT pl.id, pl.publisher_id, pl.pub_app_id, pl.plat, pl.ad_type, pl.name, {d_text('pl.app_id')} AS app_id,
       coalesce(main_placement, 0) > 0 AS main_placement, coalesce(hb_status, 0) > 0 AS allow_hb, coalesce(fan_out, 0) = 1 AS fan_out,
       {d_ints(_PL_INTS, 'pl.')}, {d_texts('ic_url osv_max osv_min', 'pl.')}, {d_lists(_PL_LISTS, 'pl.')},
       {d_lists(_LINES, 'pl.', chr(92) + 'n')}, {_PRICE.format('pl.', 'floor_price')} AS floor_price,
       CASE WHEN trim(coalesce(pl.inventory_interval_step, '')) = '' THEN '5=30|8=300|10=3600' ELSE coalesce(st.steps, '') END
            AS inventory_interval_step,
       coalesce(sc.scenes, '') AS scenes, coalesce(pc.country_settings, '') AS country_settings
FROM pl LEFT JOIN sc ON sc.placement_id = pl.id LEFT JOIN pc ON pc.placement_id = pl.id LEFT JOIN st ON st.id = pl.id
"""))
def q_snap_placement(spark, sf_dir):
    v = Views(spark, sf_dir)
    out = inventory.placement(v.f_placement, v.f_app, v.f_scene, v.f_placement_country, v.f_publisher)
    cs = map_text(F.col("country_settings"), lambda v: F.concat_ws(":", f3(v["floor_price"]), f3(v["max_price"]),
                                                                   map_text(v["period"])), ";")
    scene = F.transform("scenes", lambda s: F.concat_ws(":", *[s[c].cast("string") for c in (
        "id", "frequency_cap", "frequency_unit", "is_default")]))
    return out.select("id", "publisher_id", "pub_app_id", "plat", "ad_type", "name", "app_id", "main_placement", "allow_hb",
                      "fan_out", *_PL_INTS.split(), "ic_url", "osv_max", "osv_min", *joined(_PL_LISTS), *joined(_LINES),
                      f3(F.col("floor_price")).alias("floor_price"),
                      map_text(F.col("inventory_interval_step")).alias("inventory_interval_step"),
                      j(scene).alias("scenes"), cs.alias("country_settings"))


# ---------------------------------------------------------------- G8-G13

@register("snap_network", with_views(["f_adn"], f"""
SELECT id, {d_texts("name class_name sdk_version bid_endpoint descn")}, {d_ints("type bid_type expired_time")}
FROM f_adn WHERE status = 1
"""))
def q_snap_network(spark, sf_dir):
    return inventory.adnetwork(Views(spark, sf_dir).f_adn)


def _adn_apps(v):
    """Network apps derived from the instances: one per (app, network)."""
    return (v.f_instance.select("pub_app_id", "adn_id").distinct()
            .select((F.col("pub_app_id") * 100 + F.col("adn_id")).alias("id"), "pub_app_id", "adn_id",
                    F.when(F.col("adn_id") % 7 == 0, 0).otherwise(1).alias("status")))


_ADN_APPS_SQL = """
, aa AS (SELECT DISTINCT pub_app_id * 100 + adn_id AS id, pub_app_id, adn_id,
                CASE WHEN adn_id % 7 = 0 THEN 0 ELSE 1 END AS status FROM f_instance)"""


@register("snap_network_app", with_views(["f_instance", "f_block_rule"], _ADN_APPS_SQL + f"""
, br AS (SELECT pub_app_id, adn_id, {_block_rules_sql('[,' + chr(92) + 'r' + chr(92) + 'n]')}
         FROM f_block_rule WHERE status = 1 GROUP BY pub_app_id, adn_id)
SELECT aa.id, aa.adn_id, aa.pub_app_id, coalesce(br.block_rules, '') AS block_rules
FROM aa LEFT JOIN br ON br.pub_app_id = aa.pub_app_id AND br.adn_id = aa.adn_id WHERE aa.status = 1
"""))
def q_snap_network_app(spark, sf_dir):
    v = Views(spark, sf_dir)
    out = inventory.adnetwork_app(_adn_apps(v), v.f_block_rule)
    return out.select("id", "adn_id", "pub_app_id", _block_rules_text())


_IN_INTS, _IN_TEXTS, _IN_LISTS = "frequency_cap frequency_unit frequency_interval", "placement_key osv_max osv_min", \
    "make_blacklist make_whitelist"


@register("snap_instance", with_views(["f_instance", "f_instance_country"], _ADN_APPS_SQL + f"""
, ins AS (SELECT DISTINCT i.id, i.adn_id, i.pub_app_id, i.placement_id, coalesce(i.hb_status, 0) = 1 AS hb_status,
                 coalesce(i.name, '') AS name, {d_texts(_IN_TEXTS, 'i.')}, {d_ints(_IN_INTS, 'i.')}, {d_lists(_IN_LISTS, 'i.')},
                 {d_lists(_LINES, 'i.', chr(92) + 'n')}
          FROM f_instance i JOIN aa ON aa.pub_app_id = i.pub_app_id AND aa.adn_id = i.adn_id
          WHERE i.status = 1 AND aa.status = 1)
, ic AS (SELECT instance_id, array_to_string(list(country || '=' || {_HOURS} ORDER BY country), ';') AS country_settings,
                array_to_string(list(country || '=' || CAST(CAST(CAST(coalesce(manual_ecpm, 0) AS FLOAT) AS DECIMAL(18,3)) AS VARCHAR)
                                ORDER BY country), '|') AS country_manual_ecpm
         FROM (SELECT *, row_number() OVER (PARTITION BY instance_id, country ORDER BY id DESC) AS rn FROM f_instance_country) x
         WHERE rn = 1 AND instance_id IN (SELECT id FROM f_instance WHERE status = 1)
         GROUP BY instance_id)
SELECT ins.*, coalesce(ic.country_settings, '') AS country_settings,
       coalesce(ic.country_manual_ecpm, '') AS country_manual_ecpm
FROM ins LEFT JOIN ic ON ic.instance_id = ins.id
"""))
def q_snap_instance(spark, sf_dir):
    v = Views(spark, sf_dir)
    out = inventory.instance(v.f_instance, _adn_apps(v), v.f_instance_country)
    cs = map_text(F.col("country_settings"), lambda v: map_text(v), ";")
    return out.select("id", "adn_id", "pub_app_id", "placement_id", "hb_status", "name", *_IN_TEXTS.split(), *_IN_INTS.split(),
                      *joined(_IN_LISTS), *joined(_LINES), cs.alias("country_settings"),
                      map_text(F.col("country_manual_ecpm"), lambda x: f3(x)).alias("country_manual_ecpm"))


@register("snap_dev", with_views(["f_dev_app"], """
SELECT 'app' AS kind, publisher_id, CAST(pub_app_id AS VARCHAR) AS item, adn_id AS value FROM f_dev_app WHERE status = 1
UNION ALL
SELECT 'device', publisher_id, 'dev' || CAST(pub_app_id AS VARCHAR), adn_id % 3 FROM f_dev_app WHERE status = 1
"""))
def q_snap_dev(spark, sf_dir):
    """G12 over the dev apps; G13 over a device table derived from them."""
    d = Views(spark, sf_dir).f_dev_app
    apps = inventory.dev_app(d).select(F.lit("app").alias("kind"), "publisher_id",
                                       F.col("pub_app_id").cast("string").alias("item"), F.col("adn_id").alias("value"))
    devices = d.select("publisher_id", F.concat(F.lit("dev"), F.col("pub_app_id").cast("string")).alias("device_id"),
                       (F.col("adn_id") % 3).alias("ab_test_mode"), "status")
    devs = inventory.dev_device(devices).select(F.lit("device").alias("kind"), "publisher_id",
                                                F.col("device_id").alias("item"), F.col("abt_value").alias("value"))
    return apps.unionByName(devs)


# ---------------------------------------------------------------- G14-G19

_LIVE_SQL = """
, live AS (SELECT ri.*, CASE WHEN ri.sort_type = 1 THEN ri.priority ELSE ri.weight END AS value
           FROM f_rule_instance ri
           WHERE ri.status = 1 AND (ri.sort_type = 1 OR ri.weight > 0)
             AND ri.rule_id IN (SELECT r.id FROM f_rule r JOIN f_placement p ON r.placement_id = p.id
                                WHERE r.status = 1 AND p.status = 1)
             AND ri.instance_id IN (SELECT id FROM f_instance WHERE status = 1))"""


@register("snap_rule_weights", with_views(["f_rule_instance", "f_rule", "f_placement", "f_instance"], _LIVE_SQL + """
, last AS (SELECT rule_id, instance_id, arg_max(value, group_id * 10000000000 + priority) AS value
           FROM live GROUP BY rule_id, instance_id)
SELECT rule_id, array_to_string(list(CAST(instance_id AS VARCHAR) || '=' || CAST(value AS VARCHAR) ORDER BY instance_id), '|')
       AS instance_weight
FROM last GROUP BY rule_id
"""))
def q_snap_rule_weights(spark, sf_dir):
    """Per rule, instance -> priority/weight, last by (group, priority)."""
    v = Views(spark, sf_dir)
    live = rules.live_rule_instances(v.f_rule_instance, v.f_rule, v.f_placement, v.f_instance)
    return rules.rule_instance_weights(live).select("rule_id", map_text(F.col("instance_weight"))
                                                    .alias("instance_weight"))


_SEG_INTS = "frequency con_type gender age_min age_max model_type require_did"
_SEG_LINES = "brand_whitelist brand_blacklist model_whitelist model_blacklist interest channel"


@register("snap_rule", with_views(["f_rule_instance", "f_rule", "f_placement", "f_instance", "f_rule_group", "f_abtest",
                                   "f_app", "f_publisher", "f_segment"], _LIVE_SQL + f"""
, weights AS (SELECT rule_id, array_to_string(list(CAST(instance_id AS VARCHAR) || '=' || CAST(value AS VARCHAR)
                     ORDER BY instance_id), '|') AS instance_weight
              FROM (SELECT rule_id, instance_id, arg_max(value, group_id * 10000000000 + priority) AS value
                    FROM live GROUP BY rule_id, instance_id) x GROUP BY rule_id)
, lists AS (SELECT rule_id, group_id, ab_test, array_to_string(list(CAST(instance_id AS VARCHAR) || ':' ||
                   CAST(value AS VARCHAR) ORDER BY instance_id, value), ',') AS inst
            FROM live GROUP BY rule_id, group_id, ab_test)
, grp AS (SELECT g.rule_id, g.id AS group_id, g.ab_test, CAST(g.id AS VARCHAR) || ':' || CAST(g.ab_test AS VARCHAR)
                 || ':' || coalesce(l.inst, '') AS txt
          FROM f_rule_group g LEFT JOIN lists l ON l.rule_id = g.rule_id AND l.group_id = g.id AND l.ab_test = g.ab_test
          WHERE g.rule_id IN (SELECT id FROM f_rule WHERE status = 1)
          UNION ALL
          SELECT rule_id, 0, ab_test, '0:' || CAST(ab_test AS VARCHAR) || ':' || inst FROM lists WHERE group_id = 0)
, groups AS (SELECT rule_id, array_to_string(list(txt ORDER BY group_id, ab_test), '|') AS groups FROM grp GROUP BY rule_id)
, abt AS (SELECT a_rule_id AS rule_id, max(CAST(1000 + a_rule_id AS VARCHAR) || ':split:' || CAST(a_per AS VARCHAR) || '/' ||
                 CAST(b_per AS VARCHAR)) AS rule_abt
          FROM f_abtest WHERE status = 1 AND a_rule_id IN (SELECT id FROM f_rule WHERE status = 1) GROUP BY a_rule_id)
SELECT r.id, r.publisher_id, r.pub_app_id, r.placement_id, r.segment_id, r.sort_type, r.ab_test, r.ab_test AS abt_value,
       coalesce(r.auto_opt, 0) AS auto_switch, {d_ints('priority algorithm_id', 'r.')}, {d_texts('name', 'r.')},
       array_to_string({d_list('s.countries', split=',')}, '|') AS country, {d_ints(_SEG_INTS, 's.')},
       coalesce(s.channel_bow, 0) = 1 AS channel_bow, {d_lists(_SEG_LINES, 's.', chr(92) + 'n')},
       CAST(CAST(CAST(coalesce(s.iap_min, 0) AS FLOAT) AS DECIMAL(18,3)) AS VARCHAR) AS iap_min,
       CAST(CAST(CAST(coalesce(s.iap_max, 0) AS FLOAT) AS DECIMAL(18,3)) AS VARCHAR) AS iap_max,
       {d_ranges('s.osv_exp')} AS osv_range, {d_items('s.osv_exp')} AS osv_white,
       {d_ranges('s.sdkv_exp')} AS sdkv_range, {d_items('s.sdkv_exp')} AS sdkv_white,
       {d_ranges('s.appv_exp')} AS appv_range, {d_items('s.appv_exp')} AS appv_white,
       coalesce(w.instance_weight, '') AS instance_weight,
       coalesce(g.groups, '') AS groups, coalesce(a.rule_abt, '') AS rule_abt,
       CASE s.id % 4 WHEN 0 THEN 'vip=0:in:a, b' WHEN 1 THEN 'lvl=1:>=:3' ELSE '' END AS custom_tags
FROM f_rule r JOIN f_placement p ON r.placement_id = p.id JOIN f_app ap ON r.pub_app_id = ap.id
JOIN f_publisher pu ON r.publisher_id = pu.id JOIN f_segment s ON r.segment_id = s.id
LEFT JOIN weights w ON w.rule_id = r.id LEFT JOIN groups g ON g.rule_id = r.id LEFT JOIN abt a ON a.rule_id = r.id
WHERE r.status = 1 AND p.status = 1 AND ap.status = 1 AND pu.status = 1 AND trim(coalesce(s.countries, '')) <> ''
"""))
def q_snap_rule(spark, sf_dir):
    """Rules of live placements, apps and publishers with their
    segment, weights, groups (incl. the synthetic bidding group 0), A/B
    split, version ranges and custom tags (rule A/B rows come from f_abtest)."""
    v = Views(spark, sf_dir)
    abt = v.f_abtest.select((F.col("a_rule_id") + 1000).alias("id"), F.lit("split").alias("name"),
                            F.col("a_rule_id").alias("rule_id"), "a_per", "b_per", "status")
    out = rules.instance_rule(v.f_rule, v.f_rule_instance, v.f_rule_group, abt, v.f_placement, v.f_instance, v.f_app,
                              v.f_publisher, v.f_segment)
    grp = j(F.transform("groups", lambda g: F.concat_ws(":", g["group_id"].cast("string"), g["ab_test"].cast("string"),
                                                         F.array_join(F.transform(g["instances"], lambda i: F.concat(
                                                             i["instance_id"].cast("string"), F.lit(":"),
                                                             i["priority"].cast("string"))), ","))))
    tags = j(F.transform(F.array_sort(F.map_entries("custom_tags")), lambda e: F.concat(
        e["key"], F.lit("="), e["value"]["type"].cast("string"), F.lit(":"),
        F.array_join(F.transform(e["value"]["conditions"], lambda c: F.concat_ws(
            ":", c["operator"], F.coalesce(c["value"], F.array_join(c["values"], ",")))), ";"))))
    split = F.concat(F.concat_ws(":", F.col("rule_abt.id").cast("string"), F.col("rule_abt.name"),
                                 F.col("rule_abt.a_per").cast("string")), F.lit("/"), F.col("rule_abt.b_per").cast("string"))
    return out.select("id", "publisher_id", "pub_app_id", "placement_id", "segment_id", "sort_type", "ab_test", "abt_value",
                      "auto_switch", "priority", "algorithm_id", "name", j(F.col("country")).alias("country"),
                      *_SEG_INTS.split(), "channel_bow", *joined(_SEG_LINES),
                      f3(F.col("iap_min")).alias("iap_min"), f3(F.col("iap_max")).alias("iap_max"),
                      *[render_ranges(F.col(f"{x}_range")).alias(f"{x}_range") for x in ("osv", "sdkv", "appv")],
                      *joined("osv_white sdkv_white appv_white"), map_text(F.col("instance_weight")).alias("instance_weight"),
                      grp.alias("groups"), F.coalesce(split, F.lit("")).alias("rule_abt"),
                      F.coalesce(tags, F.lit("")).alias("custom_tags"))


@register("snap_abtest", with_views(["f_abtest", "f_rule", "f_segment"], """
SELECT a.placement_id, a.a_per, a.b_per, a.a_rule_id, a.b_rule_id, r.segment_id, unnest(string_split(regexp_replace(s.countries, ',+$', ''), ',')) AS country
FROM f_abtest a JOIN f_rule r ON a.a_rule_id = r.id JOIN f_segment s ON r.segment_id = s.id
WHERE a.status = 1 AND r.status = 1 AND trim(coalesce(s.countries, '')) <> ''
"""))
def q_snap_abtest(spark, sf_dir):
    v = Views(spark, sf_dir)
    return rules.placement_abtest(v.f_abtest, v.f_rule, v.f_segment)


# ---------------------------------------------------------------- G26-G33

_NOW_SQL = f"TIMESTAMP '{CP_NOW:%Y-%m-%d %H:%M:%S}'"
_DOW = CP_NOW.isoweekday() % 7
_BIT = 1 << CP_NOW.hour
_ELIG_SQL = f"""
, elig AS (SELECT c.* FROM f_campaign c LEFT JOIN f_campaign_period p ON p.campaign_id = c.id
           WHERE c.status = 1 AND start_time <= {_NOW_SQL} AND end_time >= {_NOW_SQL}
           AND (hour{_DOW} IS NULL OR hour{_DOW} = 0 OR (hour{_DOW} & {_BIT}) = {_BIT}))
, crs AS (SELECT * FROM f_creative WHERE status = 1 AND weight > 0 AND campaign_id IN (SELECT id FROM elig))"""
_F3 = "CAST(CAST(CAST(coalesce({0}, 0) AS FLOAT) AS DECIMAL(18,3)) AS VARCHAR)"


def cp_views(*names: str) -> list[str]:
    """The views every promotion oracle needs, and its own."""
    return ["f_campaign", "f_campaign_period", "f_creative", *[n for n in names if n != "f_creative"]]


def _eligible(v):
    return promotion.eligible_campaigns(v.f_campaign, v.f_campaign_period, CP_NOW)


@register("cp_eligible_campaigns", with_views(cp_views(), _ELIG_SQL + """
SELECT id, publisher_id, name, daily_cap FROM elig
"""))
def q_cp_eligible(spark, sf_dir):
    return _eligible(Views(spark, sf_dir)).select("id", "publisher_id", "name", "daily_cap")


_CR_TEXTS, _CR_INTS = "name title descn play_url", "type weight template endcard_template"


@register("cp_creative", with_views(cp_views("f_creative_material"), _ELIG_SQL + f"""
, mats AS (SELECT creative_id, array_to_string(list(CAST(material_id AS VARCHAR) ORDER BY material_id), '|') AS m
           FROM f_creative_material WHERE creative_id IN (SELECT id FROM crs) GROUP BY creative_id)
SELECT crs.id, crs.campaign_id, {d_ints(_CR_INTS, 'crs.')}, {d_texts(_CR_TEXTS, 'crs.')}, coalesce(mats.m, '') AS material_ids
FROM crs LEFT JOIN mats ON mats.creative_id = crs.id
"""))
def q_cp_creative(spark, sf_dir):
    """Eligible creatives with their material ids."""
    v = Views(spark, sf_dir)
    out = promotion.creative(v.f_creative, _eligible(v).select("id"), v.f_creative_material)
    return out.select("id", "campaign_id", *_CR_INTS.split(), *_CR_TEXTS.split(),
                      j(F.col("material_ids").cast("array<string>")).alias("material_ids"))


@register("cp_material", with_views(cp_views("f_creative_material", "f_material"), _ELIG_SQL + f"""
SELECT DISTINCT id, url, {d_texts('mime_type')}, {d_ints('type width height size video_duration')} FROM f_material
WHERE status = 1 AND id IN (SELECT material_id FROM f_creative_material WHERE creative_id IN (SELECT id FROM crs))
"""))
def q_cp_material(spark, sf_dir):
    v = Views(spark, sf_dir)
    crs = promotion.eligible_creatives(v.f_creative, _eligible(v).select("id")).select("id")
    return promotion.material(v.f_material, crs, v.f_creative_material)


# written out here, not taken from the operator: list, type code, kind
_TARGETS = """
pubapp_white 0 int, pubapp_black 1 int, placement_white 2 int, placement_black 3 int, make_white 4 str, make_black 5 str,
brand_white 6 str, brand_black 7 str, model_white 8 str, model_black 9 str, devicetype_white 10 int, devicetype_black 11 int,
contype 12 set, mccmnc_white 13 str, mccmnc_black 14 str, osv_white 15 osv, osv_black 16 osv, country_white 17 str,
country_black 18 str"""
_TARGETS = [x.split() for x in _TARGETS.split(",")]


def _target_sql() -> str:
    cols = []
    for name, code, kind in _TARGETS:
        hit = f"FILTER (WHERE type = {code})"
        if kind == "int":
            cols.append(f"coalesce(array_to_string(list_transform(list_sort(list(coalesce(TRY_CAST(content AS INTEGER), 0)) "
                        f"{hit}), lambda x: CAST(x AS VARCHAR)), '|'), '') AS {name}")
        elif kind == "str":
            cols.append(f"coalesce(array_to_string(list_sort(list(content) {hit}), '|'), '') AS {name}")
        elif kind == "set":
            cols.append(f"coalesce(CAST(max(coalesce(TRY_CAST(content AS INTEGER), 0)) {hit} AS VARCHAR), '') AS {name}")
        else:
            cols.append(f"coalesce(array_to_string(list_sort(flatten(list(list_filter({d_parts('content')}, lambda r: "
                        f"left(r, 1) NOT IN ('[', '('))) {hit})), '|'), '') AS {name}")
            cols.append(f"coalesce(array_to_string(list_sort(list_filter(list({d_ranges('content')}) {hit}, lambda r: r <> '')), '|'), '') "
                        f"AS {name}_range")
    return ",\n       ".join(cols)


@register("cp_targeting", with_views(cp_views("f_targeting"), _ELIG_SQL + f"""
SELECT campaign_id, {_target_sql()}
FROM f_targeting WHERE campaign_id IN (SELECT id FROM elig) AND campaign_id >= 1
GROUP BY campaign_id
"""))
def q_cp_targeting(spark, sf_dir):
    """Targeting pivot, version ranges included."""
    v = Views(spark, sf_dir)
    t = promotion.campaign_targeting(v.f_targeting, _eligible(v).select("id"))
    cols = []
    for name, _, kind in _TARGETS:
        if kind == "set":
            cols.append(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name))
        else:
            cols.append(j(F.col(name).cast("array<string>")).alias(name))
        if kind == "osv":
            cols.append(render_ranges(F.col(f"{name}_range")).alias(f"{name}_range"))
    return t.select("campaign_id", *cols)


_CA_INTS = "ska_campaign_id type platform billing_type daily_cap impr_cap impr_freq open_type"
_CA_NUMBERS = "price daily_budget max_bidprice bidprice"
_CA_TEXTS = "name app_id app_name preview_url ad_domain click_url"


@register("cp_campaign", with_views(cp_views("f_bidprice"), _ELIG_SQL + f"""
, bp AS (SELECT campaign_id, array_to_string(list(country || '=' || {_F3.format('bidprice')} ORDER BY country), '|') AS prices
         FROM (SELECT *, row_number() OVER (PARTITION BY campaign_id, country ORDER BY id DESC) AS rn FROM f_bidprice) x
         WHERE rn = 1 GROUP BY campaign_id)
SELECT elig.id, publisher_id, {d_ints(_CA_INTS)}, {', '.join(f"{_F3.format(n)} AS {n}" for n in _CA_NUMBERS.split())},
       {d_texts(_CA_TEXTS)}, {d_lists('click_tk_urls impr_tk_urls')}, coalesce(bp.prices, '') AS country_bidprice
FROM elig LEFT JOIN bp ON bp.campaign_id = elig.id
"""))
def q_cp_campaign(spark, sf_dir):
    """Eligible campaigns with bid prices by country and tracking lists."""
    v = Views(spark, sf_dir)
    out = promotion.campaign(_eligible(v), v.f_bidprice)
    return out.select("id", "publisher_id", *_CA_INTS.split(), *[f3(F.col(n)).alias(n) for n in _CA_NUMBERS.split()],
                      *_CA_TEXTS.split(), *joined("click_tk_urls impr_tk_urls"),
                      map_text(F.col("country_bidprice"), lambda x: f3(x)).alias("country_bidprice"))


@register("cp_template", with_views(["f_material"], f"""
SELECT id, url, {d_ints('type width height')}, coalesce(need_carousel, 0) = 1 AS need_carousel FROM f_material WHERE status = 1
"""))
def q_cp_template(spark, sf_dir):
    """G32 over H5 templates derived from the material table."""
    return promotion.template(Views(spark, sf_dir).f_material)


@register("cp_app", with_views(cp_views("f_store_app"), _ELIG_SQL + f"""
, a AS (SELECT * FROM f_store_app WHERE app_id IN (SELECT app_id FROM elig))
SELECT id, app_id, plat,
       CASE WHEN trim(coalesce(os_require, '')) = '' THEN ''
            WHEN plat = 1 THEN CASE WHEN contains(os_require, 'Varies with device') THEN ''
                                    WHEN contains(os_require, ' and up') THEN replace(os_require, ' and up', '')
                                    WHEN contains(os_require, ' - ') THEN split_part(os_require, ' - ', 1) ELSE '' END
            WHEN plat = 0 THEN os_require ELSE '' END AS osv_min,
       CASE WHEN trim(coalesce(os_require, '')) = '' THEN ''
            WHEN plat = 1 THEN CASE WHEN contains(os_require, 'Varies with device') THEN ''
                                    WHEN contains(os_require, ' and up') THEN ''
                                    WHEN contains(os_require, ' - ') THEN split_part(os_require, ' - ', 2) ELSE '' END
            ELSE '' END AS osv_max,
       {d_texts('name icon category')}, {d_ints('rating_count category_id sub_category_id1 sub_category_id2')},
       {_F3.format('rating_value')} AS rating_value
FROM a
"""))
def q_cp_app(spark, sf_dir):
    """Store apps of eligible campaigns."""
    v = Views(spark, sf_dir)
    out = promotion.store_app(v.f_store_app, _eligible(v))
    return out.withColumn("rating_value", f3(F.col("rating_value")))
