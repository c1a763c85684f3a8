"""Mediation rule snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MODEL_SPLIT, range_exp, split_items, text_list, with_default
from .inventory import active, ints, last_by_id, lists, texts

SORT_ABSOLUTE = 1  # sort_type whose instance value is its priority (else its weight)
BIDDING_GROUP = 0  # group id of header-bidding instances

# Columns carried over as they are (fixed values).
RULE_INTS = "auto_opt priority algorithm_id"
SEGMENT_INTS = "frequency con_type gender age_min age_max model_type require_did"
SEGMENT_LINES = "brand_whitelist brand_blacklist model_whitelist model_blacklist interest channel"


def live_rule_instances(rule_instances: DataFrame, rules: DataFrame, placements: DataFrame,
                        instances: DataFrame) -> DataFrame:
    """Active rule-instance rows whose rule, placement and instance are active,
    with the value a rule gives the instance (G14): priority for absolute
    ordering, else the weight, rows with weight <= 0 dropped."""
    r = active(rules).select(F.col("id").alias("rule_id"), F.col("placement_id").alias("_pl"))
    r = r.join(active(placements).select(F.col("id").alias("_pl")), "_pl", "left_semi").drop("_pl")
    ri = active(rule_instances).join(r, "rule_id", "left_semi")
    ri = ri.join(active(instances).select(F.col("id").alias("instance_id")), "instance_id", "left_semi")
    value = F.when(F.col("sort_type") == SORT_ABSOLUTE, F.col("priority")).otherwise(F.col("weight"))
    keep = (F.col("sort_type") == SORT_ABSOLUTE) | (F.col("weight") > 0)
    return ri.filter(keep).withColumn("value", value)


def rule_instance_weights(live: DataFrame) -> DataFrame:
    """Per rule, instance -> value. The reference fills a map in
    (rule, group, priority) order so the last row wins (W16): ``max_by``."""
    last = live.groupBy("rule_id", "instance_id").agg(
        F.max_by("value", F.struct("group_id", "priority")).alias("value"))
    return last.groupBy("rule_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("instance_id", "value")))).alias("instance_weight"))


def rule_groups(live: DataFrame, groups: DataFrame, rules: DataFrame) -> DataFrame:
    """Rule groups (of active rules) with their instance list for the
    group's A/B arm, plus one synthetic bidding group 0 per arm of
    group-0 instances. Returns (rule_id, groups array)."""
    members = live.select("rule_id", "group_id", "ab_test", F.struct(
        "instance_id", F.col("value").alias("priority"), "ab_test").alias("m"))
    lists = members.groupBy("rule_id", "group_id", "ab_test").agg(F.array_sort(F.collect_list("m")).alias("inst"))
    g = groups.join(active(rules).select(F.col("id").alias("rule_id")), "rule_id", "left_semi")
    g = g.alias("g").join(lists.alias("l"), (F.col("g.rule_id") == F.col("l.rule_id"))
                          & (F.col("g.id") == F.col("l.group_id")) & (F.col("g.ab_test") == F.col("l.ab_test")),
                          "left")
    empty = F.array().cast(lists.schema["inst"].dataType)
    real = g.select(F.col("g.rule_id").alias("rule_id"), F.struct(
        F.col("g.id").alias("group_id"), F.col("g.group_level").alias("group_level"),
        F.col("g.auto_switch").alias("auto_switch"), F.col("g.ab_test").alias("ab_test"),
        F.coalesce(F.col("l.inst"), empty).alias("instances")).alias("grp"))
    bidding = lists.filter(F.col("group_id") == BIDDING_GROUP).select("rule_id", F.struct(
        F.lit(BIDDING_GROUP).alias("group_id"), F.lit(0).alias("group_level"), F.lit(1).alias("auto_switch"),
        F.col("ab_test"), F.col("inst").alias("instances")).alias("grp"))
    return real.unionByName(bidding).groupBy("rule_id").agg(F.array_sort(F.collect_list("grp")).alias("groups"))


def rule_abt(abt: DataFrame, rules: DataFrame) -> DataFrame:
    """A rule's A/B split with its id and name (active abt rows of active
    rules, the last by id)."""
    a = active(abt).join(active(rules).select(F.col("id").alias("rule_id")), "rule_id", "left_semi")
    a = a if "id" in a.columns else a.withColumn("id", F.lit(0))
    split = F.struct("id", *texts(a, "name"), "a_per", "b_per")
    return last_by_id(a, ["rule_id"], split).withColumnRenamed("v", "rule_abt")


def custom_tags(c) -> Column:
    """JSON tag -> (type, conditions). Blank condition values are
    skipped; ``in``/``notin`` values are split on commas; a tag without a
    conditions list is dropped (a list whose items were all skipped stays)."""
    schema = "map<string,struct<type:int,conditions:array<struct<operator:string,value:string>>>>"
    parsed = F.from_json(F.col(c) if isinstance(c, str) else c, schema)
    with_conds = F.map_filter(parsed, lambda k, v: F.size(F.coalesce(v["conditions"], F.array())) > 0)

    def cond(x):
        multi = x["operator"].isin("in", "notin")
        return F.struct(x["operator"].alias("operator"),
                        F.when(~multi, x["value"]).alias("value"),
                        F.when(multi, split_items(x["value"])).otherwise(F.array().cast("array<string>"))
                        .alias("values"))

    return F.transform_values(with_conds, lambda k, v: F.struct(
        v["type"].alias("type"),
        F.transform(F.filter(v["conditions"], lambda x: F.coalesce(F.trim(x["value"]), F.lit("")) != ""), cond)
        .alias("conditions")))


def instance_rule(rules: DataFrame, rule_instances: DataFrame, groups: DataFrame, abt: DataFrame,
                  placements: DataFrame, instances: DataFrame, apps: DataFrame, publishers: DataFrame,
                  segments: DataFrame) -> DataFrame:
    """Active rules of active placements, apps and publishers whose
    segment has countries (others are skipped), with the segment's
    conditions, instance weights, groups, A/B split and custom tags."""
    for c, d in (("osv_exp", "string"), ("sdkv_exp", "string"), ("appv_exp", "string"), ("custom_tags", "string"),
                 ("iap_min", "float"), ("iap_max", "float")):
        segments = with_default(segments, c, None, d)
    r = active(rules)
    for table, key in ((placements, "placement_id"), (apps, "pub_app_id"), (publishers, "publisher_id")):
        r = r.join(active(table).select(F.col("id").alias(key)), key, "left_semi")
    osv, sdkv, appv = range_exp("osv_exp"), range_exp("sdkv_exp"), range_exp("appv_exp")
    number = lambda c: F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")).alias(c)
    seg = segments.filter(F.coalesce(F.trim("countries"), F.lit("")) != "").select(
        F.col("id").alias("segment_id"), text_list("countries", ",").alias("country"), *ints(segments, SEGMENT_INTS),
        (ints(segments, "channel_bow")[0] == 1).alias("channel_bow"), *lists(segments, SEGMENT_LINES, MODEL_SPLIT),
        number("iap_min"), number("iap_max"),
        osv["ranges"].alias("osv_range"), osv["items"].alias("osv_white"),
        sdkv["ranges"].alias("sdkv_range"), sdkv["items"].alias("sdkv_white"),
        appv["ranges"].alias("appv_range"), appv["items"].alias("appv_white"),
        custom_tags("custom_tags").alias("custom_tags"))
    base = r.select("id", "publisher_id", "pub_app_id", "placement_id", "segment_id", *ints(r, "sort_type"),
                    *ints(r, "ab_test"), ints(r, "ab_test")[0].alias("abt_value"), *ints(r, RULE_INTS), *texts(r, "name")) \
        .withColumnRenamed("auto_opt", "auto_switch").join(seg, "segment_id")
    live = live_rule_instances(rule_instances, rules, placements, instances)
    w = rule_instance_weights(live).withColumnRenamed("rule_id", "id")
    g = rule_groups(live, groups, rules).withColumnRenamed("rule_id", "id")
    a = rule_abt(abt, rules).withColumnRenamed("rule_id", "id")
    out = base.join(w, "id", "left").join(g, "id", "left").join(a, "id", "left")
    return out.withColumn("instance_weight", F.coalesce("instance_weight", F.create_map().cast(
        w.schema["instance_weight"].dataType))).withColumn("groups", F.coalesce("groups", F.array().cast(
            g.schema["groups"].dataType)))


def placement_abtest(abtests: DataFrame, rules: DataFrame, segments: DataFrame) -> DataFrame:
    """Active placement A/B tests whose A rule is active, one row per
    country of the A rule's segment."""
    a = active(abtests).join(active(rules).select(F.col("id").alias("a_rule_id"), "segment_id"), "a_rule_id")
    s = segments.filter(F.coalesce(F.trim("countries"), F.lit("")) != "").select(F.col("id").alias("segment_id"), "countries")
    return a.join(s, "segment_id").select("placement_id", "a_per", "b_per", "a_rule_id", "b_rule_id", "segment_id",
                                          F.explode(split_items("countries")).alias("country"))
