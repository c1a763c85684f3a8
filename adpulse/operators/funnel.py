"""Hourly mediation funnel (C1) and cross-promotion report.

Both are one filtered scan -> ``groupBy`` -> conditional sums. Spark plans
them as partial (map-side) HashAggregate -> shuffle on the group keys ->
final HashAggregate, so a hot key only ever contributes one partial row per
map task to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import epoch_ms_to_day, epoch_ms_to_hour, slot_filter

# Fixed values that must equal the reference: funnel metric -> (event type
# code, counter field). A row counts for a metric when its type matches or
# the pre-aggregated counter is positive; the counter value (default 1) is
# added.
FUNNEL_COUNTERS = [
    ("waterfall_request", 2, "wfReq"),
    ("waterfall_filled", 3, "wfFil"),
    ("instance_request", 4, "insReq"),
    ("instance_filled", 5, "insFil"),
    ("video_start", 8, "vdStart"),
    ("video_complete", 9, "vdEnd"),
    ("called_show", 501, "calledShow"),
    ("is_ready_true", 502, "readyTrue"),
    ("is_ready_false", 503, "readyFalse"),
    ("click", 7, "click"),
    ("impr", 6, "impr"),
    ("bid_req", 270, "bidReq"),
    ("bid_resp", 271, "bidRes"),
    ("bid_win", 273, "bidWin"),
]
# Price metrics: (output, type code, price field); fall back to ``price``.
FUNNEL_PRICES = [
    ("bid_resp_price", 271, "bidResPrice"),
    ("bid_win_price", 273, "bidWinPrice"),
]
# Output order of the 16 metrics (as the report table lists them).
FUNNEL_METRIC_ORDER = [
    "waterfall_request", "waterfall_filled", "instance_request", "instance_filled",
    "video_start", "video_complete", "called_show", "is_ready_true", "is_ready_false",
    "click", "impr", "bid_req", "bid_resp", "bid_resp_price", "bid_win", "bid_win_price",
]


def counter_sql(type_code: int, field: str) -> str:
    """``if(type = code OR field > 0, coalesce(field, 1), 0)`` as SQL text;
    a NULL condition takes the else branch, as SQL ``IF`` does."""
    return f"CASE WHEN type = {type_code} OR `{field}` > 0 THEN coalesce(`{field}`, 1) ELSE 0 END"


def price_sql(type_code: int, field: str) -> str:
    return f"CASE WHEN type = {type_code} OR `{field}` > 0 THEN coalesce(`{field}`, price, 0) ELSE 0 END"


def counter_value(type_code: int, field: str) -> Column:
    return F.expr(counter_sql(type_code, field))


def price_value(type_code: int, field: str) -> Column:
    return F.expr(price_sql(type_code, field))


def funnel_dims() -> list[Column]:
    """The 17 report dimensions of the funnel, derived from a log row."""
    return [
        epoch_ms_to_day("serverTs").alias("day"),
        epoch_ms_to_hour("serverTs").alias("hour"),
        *[F.expr(e) for e in (
            "country", "coalesce(plat, -1) AS platform", "coalesce(publisherId, 0) AS publisher_id",
            "coalesce(pubAppId, 0) AS pub_app_id", "coalesce(pid, 0) AS placement_id",
            "coalesce(iid, 0) AS instance_id", "coalesce(scene, 0) AS scene_id", "coalesce(mid, 0) AS adn_id",
            "coalesce(abt, 0) AS abt", "coalesce(abtId, 0) AS abt_id", "coalesce(bid, 0) AS bid",
            "coalesce(ruleId, 0) AS rule_id", "appv AS app_version", "sdkv AS sdk_version", "osv AS os_version")],
    ]


FUNNEL_DIM_NAMES = ["day", "hour", "country", "platform", "publisher_id", "pub_app_id", "placement_id",
                    "instance_id", "scene_id", "adn_id", "abt", "abt_id", "bid", "rule_id",
                    "app_version", "sdk_version", "os_version"]


SLOT_NAMES = ["slot_day", "slot_hour"]


def slot_columns() -> list[Column]:
    """The partition slot a row was read from. A job that runs slot by slot
    stores its result under these columns: the event hour of a late row lies
    in a slot that an earlier run has written."""
    return [F.date_format("dt", "yyyy-MM-dd").alias("slot_day"), F.col("h").cast("int").alias("slot_hour")]


def common_report(lr: DataFrame, begin=None, end=None, by_slot: bool = False) -> DataFrame:
    """Hourly mediation funnel over the partition slots ``[begin, end)``.

    Rows are bucketed by their event hour (``serverTs``), sliced by partition
    hour, exactly as the reference (a late row lands in its event hour).
    ``begin``/``end`` None = every slot (set-oriented backfill). ``by_slot``
    keeps rows of different slots apart and adds ``SLOT_NAMES``, by which the
    result is to be stored (``write_slot(..., SLOT_NAMES)``).
    Excludes rows without ``serverTs`` and ``type = 1`` (NULL type is also
    excluded: ``type != 1`` is NULL there).
    """
    src = lr.filter(slot_filter("dt", "h", begin, end)
                    & F.col("serverTs").isNotNull() & (F.col("type") != 1))
    return src.groupBy(*(slot_columns() if by_slot else []), *funnel_dims()).agg(*funnel_metrics())


def funnel_metrics() -> list[Column]:
    """The 16 funnel sums in report order (one SQL expression each)."""
    sql = {name: counter_sql(code, field) for name, code, field in FUNNEL_COUNTERS}
    sql.update({name: price_sql(code, field) for name, code, field in FUNNEL_PRICES})
    return [F.expr(f"sum({sql[m]}) AS {m}") for m in FUNNEL_METRIC_ORDER]


CP_DIM_NAMES = ["day", "hour", "publisher_id", "pub_app_id", "placement_id", "country", "app_id",
                "campaign_id", "creative_id"]


def cp_report(cptk: DataFrame, begin=None, end=None, ts_col: str = "ts_ms", by_slot: bool = False) -> DataFrame:
    """Hourly cross-promotion report: Σimpr, Σclick, Σcost by 9 dims
    (``by_slot`` as in C1)."""
    src = cptk.filter(slot_filter("dt", "h", begin, end) & F.col(ts_col).isNotNull())
    dims = [
        epoch_ms_to_day(ts_col).alias("day"),
        epoch_ms_to_hour(ts_col).alias("hour"),
        F.coalesce("publisherId", F.lit(0)).alias("publisher_id"),
        F.coalesce("pubAppId", F.lit(0)).alias("pub_app_id"),
        F.coalesce("pid", F.lit(0)).alias("placement_id"),
        F.coalesce("cy", F.lit("")).alias("country"),
        F.coalesce("appId", F.lit("")).alias("app_id"),
        F.coalesce("cid", F.lit(0)).alias("campaign_id"),
        F.coalesce("crid", F.lit(0)).alias("creative_id"),
    ]
    return src.groupBy(*(slot_columns() if by_slot else []), *dims).agg(
        F.sum(F.coalesce("impr", F.lit(0))).alias("impr"),
        F.sum(F.coalesce("click", F.lit(0))).alias("click"),
        F.sum(F.coalesce("cost", F.lit(0))).alias("win_price"),
    )
