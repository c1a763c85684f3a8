"""Cross-promotion snapshots.

Eligibility is computed once as id frames (campaigns, creatives) and every
dataset is reduced with ``left_semi`` joins against them, as the reference
does with temporary id tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import range_exp, text_list
from .inventory import active, ints, last_by_id, texts

# Campaign targeting type codes -> (output list, kind).
# kind: int = integer list, str = text list, set = single value, osv = version expression.
TARGET_TYPES = [
    (0, "pubapp_white", "int"), (1, "pubapp_black", "int"), (2, "placement_white", "int"),
    (3, "placement_black", "int"), (4, "make_white", "str"), (5, "make_black", "str"),
    (6, "brand_white", "str"), (7, "brand_black", "str"), (8, "model_white", "str"), (9, "model_black", "str"),
    (10, "devicetype_white", "int"), (11, "devicetype_black", "int"), (12, "contype", "set"),
    (13, "mccmnc_white", "str"), (14, "mccmnc_black", "str"), (15, "osv_white", "osv"), (16, "osv_black", "osv"),
    (17, "country_white", "str"), (18, "country_black", "str"),
]


def numbers(df: DataFrame, names: str) -> list[Column]:
    """The named decimal columns as floats, NULL as 0."""
    return [F.coalesce(F.col(n).cast("float"), F.lit(0.0).cast("float")).alias(n) for n in names.split()]


def eligible_campaigns(campaigns: DataFrame, periods: DataFrame, now: _dt.datetime) -> DataFrame:
    """Active campaigns running at ``now`` (UTC) whose period row, if
    there is one, leaves today's hour mask (0 = Sunday) unset, 0 or with the
    current hour's bit. A campaign with several period rows needs one that fits."""
    dow = (now.isoweekday()) % 7
    bit = 1 << now.hour
    mask = F.col(f"hour{dow}")
    ts = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    running = campaigns.filter((F.col("status") == 1) & (F.col("start_time") <= ts) & (F.col("end_time") >= ts))
    fits = mask.isNull() | (mask == 0) | (mask.bitwiseAND(F.lit(bit)) == F.lit(bit))
    per = periods.groupBy(F.col("campaign_id").alias("id")).agg(F.max(fits.cast("int")).alias("_fits"))
    return running.join(per, "id", "left").filter(F.coalesce("_fits", F.lit(1)) == 1).drop("_fits")


def eligible_creatives(creatives: DataFrame, campaign_ids: DataFrame) -> DataFrame:
    """Active creatives with weight > 0 of eligible campaigns."""
    return active(creatives).filter(F.col("weight") > 0).join(
        campaign_ids.select(F.col("id").alias("campaign_id")), "campaign_id", "left_semi")


# Columns carried over as they are (fixed values).
CAMPAIGN_INTS = "ska_campaign_id type platform billing_type daily_cap impr_cap impr_freq open_type"
CAMPAIGN_NUMBERS = "price daily_budget max_bidprice bidprice"
CAMPAIGN_TEXTS = "name app_id app_name preview_url ad_domain click_url"
CREATIVE_TEXTS, CREATIVE_INTS = "name title descn play_url", "type weight template endcard_template"
MATERIAL_INTS = "type width height size video_duration"
APP_TEXTS, APP_INTS = "name icon category", "rating_count category_id sub_category_id1 sub_category_id2"


def campaign(eligible: DataFrame, bidprices: DataFrame) -> DataFrame:
    """Eligible campaigns (G26) with country -> bid price (the last row
    of a country by id) and tracking lists."""
    out = eligible.select("id", "publisher_id", *ints(eligible, CAMPAIGN_INTS), *numbers(eligible, CAMPAIGN_NUMBERS),
                          *texts(eligible, CAMPAIGN_TEXTS), *[text_list(x).alias(x) for x in ("click_tk_urls", "impr_tk_urls")])
    bp = bidprices.join(eligible.select(F.col("id").alias("campaign_id")), "campaign_id", "left_semi")
    per = last_by_id(bp, ["campaign_id", "country"], F.struct(*numbers(bp, "bidprice")))
    m = per.groupBy("campaign_id").agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("country", F.col("v.bidprice"))))).alias("country_bidprice"))
    out = out.join(m, out.id == m.campaign_id, "left").drop("campaign_id")
    return out.withColumn("country_bidprice", F.coalesce("country_bidprice", F.create_map().cast("map<string,float>")))


def campaign_targeting(targeting: DataFrame, campaign_ids: DataFrame) -> DataFrame:
    """(campaign, type, content) rows pivoted into one row per eligible
    campaign with 19 typed lists; unknown type codes are ignored. Lists are
    sorted (the reference's order within a campaign is unspecified); the
    single-valued connection type takes the largest value."""
    t = targeting.join(campaign_ids.select(F.col("id").alias("campaign_id")), "campaign_id", "left_semi") \
                 .filter(F.col("campaign_id") >= 1)
    aggs = []
    for code, name, kind in TARGET_TYPES:
        hit = F.col("type") == code
        if kind == "int":
            aggs.append(F.array_sort(F.collect_list(F.when(hit, F.coalesce(F.col("content").try_cast("int"),
                                                                           F.lit(0))))).alias(name))
        elif kind == "str":
            aggs.append(F.array_sort(F.collect_list(F.when(hit, F.col("content")))).alias(name))
        elif kind == "set":
            aggs.append(F.max(F.when(hit, F.coalesce(F.col("content").try_cast("int"), F.lit(0)))).alias(name))
        else:
            parsed = range_exp(F.col("content"))
            aggs.append(F.array_sort(F.flatten(F.collect_list(F.when(hit, parsed["items"]))))
                        .alias(name))
            aggs.append(F.array_sort(F.flatten(F.collect_list(F.when(hit, parsed["ranges"]))))
                        .alias(f"{name}_range"))
    return t.groupBy("campaign_id").agg(*aggs)


def creative(creatives: DataFrame, campaign_ids: DataFrame, creative_material: DataFrame) -> DataFrame:
    """Eligible creatives with their material id list."""
    cr = eligible_creatives(creatives, campaign_ids)
    mats = creative_material.join(cr.select(F.col("id").alias("creative_id")), "creative_id", "left_semi")
    m = mats.groupBy("creative_id").agg(F.array_sort(F.collect_list("material_id")).alias("material_ids"))
    out = cr.select("id", "campaign_id", *ints(cr, CREATIVE_INTS), *texts(cr, CREATIVE_TEXTS)).join(m, F.col("id") == F.col("creative_id"), "left") \
            .drop("creative_id")
    return out.withColumn("material_ids", F.coalesce("material_ids", F.array().cast("array<bigint>")))


def material(materials: DataFrame, creative_ids: DataFrame, creative_material: DataFrame) -> DataFrame:
    """DISTINCT active materials used by eligible creatives."""
    used = creative_material.join(creative_ids.select(F.col("id").alias("creative_id")), "creative_id",
                                  "left_semi").select(F.col("material_id").alias("id"))
    m = active(materials).join(used, "id", "left_semi")
    return m.select("id", "url", *texts(m, "mime_type"), *ints(m, MATERIAL_INTS)).distinct()


def template(templates: DataFrame) -> DataFrame:
    """Active H5 templates."""
    t = active(templates)
    return t.select("id", "url", *ints(t, "type width height"), (ints(t, "need_carousel")[0] == 1).alias("need_carousel"))


def os_requirement(text: Column, plat: Column) -> tuple[Column, Column]:
    """Store OS requirement text -> (osv_min, osv_max): Android 'Varies with
    device' -> none, 'X and up' -> X, 'X - Y' -> X, Y; iOS -> the text."""
    t = F.coalesce(text, F.lit(""))
    blank = F.trim(t) == ""
    android_min = (F.when(t.contains("Varies with device"), F.lit(""))
                   .when(t.contains(" and up"), F.replace(t, F.lit(" and up"), F.lit("")))
                   .when(t.contains(" - "), F.element_at(F.split(t, " - "), 1)).otherwise(F.lit("")))
    android_max = (F.when(t.contains("Varies with device"), F.lit("")).when(t.contains(" and up"), F.lit(""))
                   .when(t.contains(" - "), F.element_at(F.split(t, " - "), 2)).otherwise(F.lit("")))
    osv_min = F.when(blank, "").when(plat == 1, android_min).when(plat == 0, t).otherwise("")
    osv_max = F.when(blank, "").when(plat == 1, android_max).otherwise("")
    return osv_min, osv_max


def store_app(apps: DataFrame, eligible: DataFrame) -> DataFrame:
    """Store apps promoted by eligible campaigns, one row per app id."""
    used = eligible.select("app_id").distinct()
    a = apps.join(used, "app_id", "left_semi").dropDuplicates(["id"])
    lo, hi = os_requirement(F.col("os_require"), F.col("plat"))
    return a.select("id", "app_id", "plat", lo.alias("osv_min"), hi.alias("osv_max"), *texts(a, APP_TEXTS),
                    *ints(a, APP_INTS), *numbers(a, "rating_value"))
