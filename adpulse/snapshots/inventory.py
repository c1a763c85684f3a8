"""Configuration snapshots of apps, placements, networks and instances
(G1-G13): flat config tables -> one nested row per entity.

Children are attached with ``groupBy(parent).agg(collect_list(struct))`` and
a left join to the parent; lists are ``array_sort``-ed so a snapshot is
deterministic. Config tables are small dimensions; Spark broadcasts them by
its own size statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MODEL_SPLIT, split_items, text_list, with_default

# Inventory interval steps used when a placement sets none.
DEFAULT_INVENTORY_INTERVAL_STEP = {5: 30, 8: 300, 10: 3600}
DAYS_OF_WEEK = 7

# Columns of the snapshots that are carried over as they are (fixed values).
BLOCK_RULE_TEXTS = "sdk_version app_version osv_max osv_min"
PLACEMENT_INTS = ("batch_size preload_timeout frequency_cap frequency_unit frequency_interval inventory_count"
                  " inventory_interval reload_interval")
PLACEMENT_LISTS = "osv_blacklist osv_whitelist make_blacklist make_whitelist did_blacklist sdkv_blacklist"
DEVICE_LINES = "brand_blacklist brand_whitelist model_blacklist model_whitelist"
INSTANCE_INTS = "frequency_cap frequency_unit frequency_interval"


def ints(df: DataFrame, names: str) -> list[Column]:
    """The named integer columns, NULL (or a column the source lacks) as 0."""
    return [(F.coalesce(F.col(n).cast("int"), F.lit(0)) if n in df.columns else F.lit(0)).alias(n) for n in names.split()]


def texts(df: DataFrame, names: str) -> list[Column]:
    """The named text columns, NULL, blank or missing as ''."""
    return [(F.when(F.coalesce(F.trim(F.col(n)), F.lit("")) != "", F.col(n)).otherwise("") if n in df.columns
             else F.lit("")).alias(n) for n in names.split()]


def lists(df: DataFrame, names: str, split: str | None = None) -> list[Column]:
    """The named list columns (G21), by default split on commas and line breaks."""
    args = {} if split is None else {"split": split}
    return [text_list(F.col(n) if n in df.columns else F.lit(None).cast("string"), **args).alias(n) for n in names.split()]


def active(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == 1)


def _attach(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, name: str) -> DataFrame:
    """Left-join a per-parent sorted list of child structs (all child columns
    but ``child_key``); parents without children get an empty list."""
    cols = [c for c in child.columns if c != child_key]
    g = child.groupBy(child_key).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    out = parent.join(g, parent[parent_key] == g[child_key], "left").drop(child_key)
    return out.withColumn(name, F.coalesce(F.col(name), F.array().cast(g.schema[name].dataType)))


def float_or(price: Column, switch: Column | None = None) -> Column:
    """Price as float, -1 when the switch is off (or NULL) or the price is NULL."""
    p = F.coalesce(price.cast("float"), F.lit(-1.0).cast("float"))
    return p if switch is None else F.when(F.coalesce(switch, F.lit(0)) == 0, F.lit(-1.0).cast("float")).otherwise(p)


def last_by_id(df: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """``keys`` and ``v`` (a struct): of several rows of a key the one with the
    largest id (rows are read in id order, a later one replaces an earlier
    one), among equal ids the one whose JSON text is largest."""
    order = F.struct(F.col("id") if "id" in df.columns else F.lit(0), F.to_json(value))
    return df.groupBy(*keys).agg(F.max_by(value, order).alias("v"))


def hour_period_map(df: DataFrame) -> Column:
    """Map day-of-week index -> hour bitmask, only entries > 0."""
    m = F.map_from_arrays(F.array(*[F.lit(i) for i in range(DAYS_OF_WEEK)]),
                          F.array(*[F.coalesce(F.col(f"hour{i}"), F.lit(0)).cast("int")
                                    if f"hour{i}" in df.columns else F.lit(0) for i in range(DAYS_OF_WEEK)]))
    return F.map_filter(m, lambda k, v: v > 0)


# ---------------------------------------------------------------- G1-G3

def app_block_rules(rules: DataFrame) -> DataFrame:
    """Active app block rules with lower-cased device lists, by app."""
    r = active(rules)
    r = with_default(r, "brand_model_blacklist", None, "string")
    return r.select(F.col("pub_app_id").alias("_pub_app_id"), F.col("id"), F.col("pub_app_id"), *texts(r, BLOCK_RULE_TEXTS),
                    text_list("make_device_blacklist", "[,\n]", lower=True).alias("make_device_blacklist"),
                    text_list("brand_model_blacklist", MODEL_SPLIT, lower=True).alias("brand_model_blacklist"))


def country_uars(apps: DataFrame) -> Column:
    """Per-country UAR floats from the manual JSON, else the automatic
    one, limited to the app's region list; none when the region list is blank."""
    regions = F.split(F.coalesce(F.col("uar_regions"), F.lit("")), ",")
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    src = F.when(~blank("uar_manual"), F.col("uar_manual")).otherwise(F.col("uar_auto"))
    parsed = F.from_json(src, "map<string,array<float>>")
    kept = F.map_filter(parsed, lambda k, v: F.array_contains(regions, k))
    entries = F.transform(F.map_entries(kept), lambda e: F.struct(e["key"].alias("country"), e["value"].alias("uarx")))
    return F.when(blank("uar_regions"), F.array()).otherwise(F.coalesce(F.array_sort(entries), F.array()))


def _epoch_seconds(ts: Column) -> Column:
    """UTC epoch seconds of a timestamp or a zone-free timestamp."""
    days = F.unix_date(ts.cast("date")).cast("long")
    return (days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("int")


def publisher_app(apps: DataFrame, block_rules: DataFrame, publishers: DataFrame) -> DataFrame:
    """G1: active apps of active publishers with keys, creation time (epoch
    seconds), event ids, block rules and country UAR lists."""
    a = active(apps)
    for c in ("uar_manual", "uar_auto"):
        a = with_default(a, c, None, "string")
    live = active(publishers)
    a = a.join(live.select(F.col("id").alias("publisher_id"), *ints(live, "impr_callback_switch")), "publisher_id")
    a = with_default(a, "create_time", None, "timestamp")
    events = F.when(F.coalesce(F.trim("sdk_event_ids"), F.lit("")) != "",
                    F.transform(split_items("sdk_event_ids"), lambda x: F.coalesce(x.try_cast("int"), F.lit(0))))
    base = a.select("id", "publisher_id", "plat", "app_name", *texts(a, "app_key bundle_id"),
                    _epoch_seconds(F.col("create_time")).alias("create_time"), "impr_callback_switch",
                    F.coalesce(events, F.array().cast("array<int>")).alias("event_ids"),
                    country_uars(a).alias("country_uars"))
    return _attach(base, app_block_rules(block_rules), "id", "_pub_app_id", "block_rules")


# ---------------------------------------------------------------- G4-G7

def placement_scenes(scenes: DataFrame, placements: DataFrame) -> DataFrame:
    """Active scenes of active placements, keyed by placement."""
    p = active(placements).select(F.col("id").alias("_pid"))
    s = active(scenes).join(p, F.col("placement_id") == F.col("_pid"), "left_semi")
    return s.select(F.col("placement_id").alias("_id"), "id", "name", "placement_id",
                    *ints(s, "frequency_cap frequency_unit is_default"))


def _live_apps(apps: DataFrame, publishers: DataFrame) -> DataFrame:
    """Active apps of active publishers."""
    return active(apps).join(active(publishers).select(F.col("id").alias("publisher_id")), "publisher_id", "left_semi")


def placement_country_settings(pc: DataFrame, placements: DataFrame, apps: DataFrame, publishers: DataFrame) -> DataFrame:
    """Per placement, country -> (floor price, max price, day->hours)."""
    pc = with_default(pc, "max_price", None, "decimal(8,3)")
    live = _live_apps(apps, publishers).select(F.col("id").alias("pub_app_id"))
    ok = active(placements).join(live, "pub_app_id", "left_semi").select(F.col("id").alias("_pid"))
    s = pc.join(ok, F.col("placement_id") == F.col("_pid"), "left_semi")
    settings = F.struct(float_or(F.col("floor_price"), F.col("floor_price_switch")).alias("floor_price"),
                        float_or(F.col("max_price"), F.col("floor_price_switch")).alias("max_price"),
                        hour_period_map(pc).alias("period"))
    per = last_by_id(s, ["placement_id", "country"], settings).withColumnRenamed("v", "s")
    return per.groupBy(F.col("placement_id").alias("_id")).agg(
        F.map_from_entries(F.collect_list(F.struct("country", "s"))).alias("country_settings"))


def inventory_interval_step(c) -> Column:
    """``a:b`` per line -> map a -> b, a later line replaces an earlier
    one; blank text -> the default map."""
    text = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    lines = F.filter(F.transform(F.split(text, "[\r\n]"), lambda x: F.trim(x)),
                     lambda x: F.regexp_extract(x, r"(\d+):(\d+)", 0) != "")
    pairs = F.transform(lines, lambda x: F.struct(F.regexp_extract(x, r"(\d+):(\d+)", 1).cast("int").alias("k"),
                                                  F.regexp_extract(x, r"(\d+):(\d+)", 2).cast("int").alias("v")))
    default = F.create_map(*[F.lit(x) for kv in sorted(DEFAULT_INVENTORY_INTERVAL_STEP.items()) for x in kv])
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["k"] == x["k"]))
    parsed = F.map_from_entries(last)
    return F.when(F.trim(text) == "", default).otherwise(parsed)


def placement(placements: DataFrame, apps: DataFrame, scenes: DataFrame, pc: DataFrame,
              publishers: DataFrame) -> DataFrame:
    """Active placements of active apps/publishers with lists, floor
    price, scenes, country settings and inventory steps."""
    live = _live_apps(apps, publishers)
    a = live.select(F.col("id").alias("_app"), F.col("plat"), F.col("publisher_id"), *texts(live, "app_id"))
    p = active(placements)
    p = p.drop(*[c for c in ("publisher_id", "plat", "app_id") if c in p.columns])
    p = p.join(a, F.col("pub_app_id") == F.col("_app"), "inner").drop("_app")
    positive = lambda n, k: (ints(p, n)[0] > 0 if k is None else ints(p, n)[0] == k)
    base = p.select("id", "publisher_id", "pub_app_id", "app_id", "plat", "ad_type", "name",
                    positive("main_placement", None).alias("main_placement"), positive("hb_status", None).alias("allow_hb"),
                    positive("fan_out", 1).alias("fan_out"), *ints(p, PLACEMENT_INTS), *texts(p, "ic_url osv_max osv_min"),
                    *lists(p, PLACEMENT_LISTS), *lists(p, DEVICE_LINES, MODEL_SPLIT),
                    float_or(F.col("floor_price"), F.col("floor_price_switch")).alias("floor_price"),
                    inventory_interval_step("inventory_interval_step").alias("inventory_interval_step"))
    out = _attach(base, placement_scenes(scenes, placements), "id", "_id", "scenes")
    cs = placement_country_settings(pc, placements, apps, publishers)
    out = out.join(cs, out.id == cs._id, "left").drop("_id")
    return out.withColumn("country_settings", F.coalesce("country_settings",
                                                         F.create_map().cast(cs.schema["country_settings"].dataType)))


# ---------------------------------------------------------------- G8-G13

def adnetwork(adn: DataFrame) -> DataFrame:
    """Active networks, NULL text -> '', NULL number -> 0."""
    a = active(adn)
    return a.select("id", *texts(a, "name class_name sdk_version bid_endpoint descn"), *ints(a, "type bid_type expired_time"))


def adnetwork_app(adn_apps: DataFrame, block_rules: DataFrame) -> DataFrame:
    """Active network apps with their block rules matched on (app, network)."""
    r = active(block_rules)
    r = with_default(r, "brand_model_blacklist", None, "string")
    rules = r.select("pub_app_id", "adn_id", F.struct(
        "id", *texts(r, BLOCK_RULE_TEXTS), text_list("make_device_blacklist", lower=True).alias("make_device_blacklist"),
        text_list("brand_model_blacklist", MODEL_SPLIT, lower=True).alias("brand_model_blacklist")).alias("r"))
    g = rules.groupBy("pub_app_id", "adn_id").agg(F.array_sort(F.collect_list("r")).alias("block_rules"))
    a = active(adn_apps)
    a = with_default(a, "adn_app_key", None, "string")
    out = a.select("id", "adn_id", "pub_app_id", F.coalesce("adn_app_key", F.lit("")).alias("app_key")) \
           .join(g, ["pub_app_id", "adn_id"], "left")
    return out.withColumn("block_rules", F.coalesce("block_rules", F.array().cast(g.schema["block_rules"].dataType)))


def instance(instances: DataFrame, adn_apps: DataFrame, ic: DataFrame) -> DataFrame:
    """DISTINCT active instances whose (app, network) app is active,
    with country -> day/hour map and country -> manual eCPM map."""
    ok = active(adn_apps).select("pub_app_id", "adn_id").distinct()
    i = active(instances).join(ok, ["pub_app_id", "adn_id"], "left_semi")
    base = i.select("id", "adn_id", "pub_app_id", "placement_id", (ints(i, "hb_status")[0] == 1).alias("hb_status"),
                    F.coalesce("name", F.lit("")).alias("name"), *texts(i, "placement_key osv_max osv_min"),
                    *ints(i, INSTANCE_INTS), *lists(i, "make_blacklist make_whitelist"),
                    *lists(i, DEVICE_LINES, MODEL_SPLIT)).distinct()
    live = active(instances).select(F.col("id").alias("_iid"))
    c = ic.join(live, F.col("instance_id") == F.col("_iid"), "left_semi")
    ecpm = F.coalesce(F.col("manual_ecpm").cast("float"), F.lit(0.0).cast("float"))
    c = last_by_id(c, ["instance_id", "country"], F.struct(hour_period_map(ic).alias("p"), ecpm.alias("e")))
    per = c.groupBy(F.col("instance_id").alias("_id")).agg(
        F.map_from_entries(F.collect_list(F.struct("country", "v.p"))).alias("country_settings"),
        F.map_from_entries(F.collect_list(F.struct("country", "v.e"))).alias("country_manual_ecpm"))
    out = base.join(per, base.id == per._id, "left").drop("_id")
    return out.withColumn("country_settings", F.coalesce("country_settings", F.create_map().cast(
        per.schema["country_settings"].dataType))).withColumn("country_manual_ecpm", F.coalesce(
            "country_manual_ecpm", F.create_map().cast(per.schema["country_manual_ecpm"].dataType)))


def dev_app(dev_apps: DataFrame) -> DataFrame:
    """Active SDK development apps."""
    return active(dev_apps).select("publisher_id", "pub_app_id", "adn_id")


def dev_device(dev_devices: DataFrame) -> DataFrame:
    """Active SDK development devices."""
    return active(dev_devices).select("publisher_id", "device_id", F.col("ab_test_mode").alias("abt_value"))
