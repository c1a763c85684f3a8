"""Configurable custom reports.

A report spec names dimensions, metrics, a schedule window and IN-list
filters. Three aggregated sides (network statistics, mediation funnel, user
activity) are unioned by name and merged per dimension key with a grouped
``max_by`` - an aggregation, not a join, so no side is broadcast or
replicated. Derived ratios use exact HALF_UP division. The output is the
rendered report: display titles as column names, every value as text.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_div

SCHEDULE_DAILY, SCHEDULE_WEEKLY, SCHEDULE_MONTHLY = 1, 2, 3
DS_NONE, DS_PERFORMANCE, DS_USER_ACTIVITY = 0, 1, 2

SUPPORTED_DIMS = ["day", "country", "adn_id", "pub_app_id", "placement_id", "instance_id"]
DAU_DIMS = {"pub_app_id", "country", "day"}
FILL_RATE_CAP = 100

# Display titles of dimensions and metrics.
TITLES = {
    "day": "Date", "country": "Region", "adn_id": "AdNetwork", "pub_app_id": "App",
    "placement_id": "Placement", "instance_id": "Instance",
    "request": "Requests", "filled": "Fills", "fill_rate": "Fill Rate", "is_ready": "Ad-Availability Check",
    "is_ready_true": "Ad-Availability Response", "is_ready_rate": "Availability Rate", "impr": "Impressions",
    "click": "Clicks", "ctr": "CTR", "cost": "Revenue", "ecpm": "eCPM", "dau": "DAU",
    "impr_dau": "Impressions per DAU", "arp_dau": "ARPDAU", "deu": "DEU", "impr_deu": "Impressions per DEU",
    "arp_deu": "ARPDEU", "engagement_rate": "Engagement Rate",
}

# Side sums: (output name, source column).
ADN_SUMS = [("api_request", "api_request"), ("api_filled", "api_filled"), ("click", "api_click"),
            ("impr", "api_impr"), ("api_video_start", "api_video_start"),
            ("api_video_complete", "api_video_complete"), ("revenue", "revenue"), ("cost", "cost")]
LR_SUMS = ["waterfall_request", "waterfall_filled", "instance_request", "instance_filled", "video_start",
           "video_complete", "called_show", "is_ready_true", "is_ready_false"]
DAU_SUMS = ["ip_count", "dau", "deu"]


def snake_case(name: str) -> str:
    """camelCase -> snake_case (each upper-case letter becomes ``_`` + lower)."""
    return re.sub(r"(?<=.)([A-Z])", lambda m: "_" + m.group(1).lower(), name[:1].lower() + name[1:])


def snake_case_columns(df: DataFrame) -> DataFrame:
    """F11 applied to a frame: rename every column to snake_case."""
    return df.toDF(*[snake_case(c) for c in df.columns])


@dataclass
class ReportSpec:
    publisher_id: int
    dimensions: str                   # comma list, camelCase accepted
    metrics: str
    schedule: int = SCHEDULE_DAILY
    cond_day_period: int = 0
    data_source: int = DS_PERFORMANCE
    cond_adn_list: str = ""
    cond_pub_app_list: str = ""
    cond_placement_list: str = ""
    cond_instance_list: str = ""
    cond_country_list: str = ""

    @property
    def dims(self) -> list[str]:
        return list(dict.fromkeys(snake_case(self.dimensions).split(",")))

    @property
    def metric_list(self) -> list[str]:
        return list(dict.fromkeys(snake_case(self.metrics).split(",")))


def report_window(spec: ReportSpec, task_day: _dt.date, now: _dt.date):
    """inclusive day range of a run (monthly uses ``now``, W15)."""
    if spec.schedule in (SCHEDULE_DAILY, SCHEDULE_WEEKLY):
        return task_day - _dt.timedelta(days=spec.cond_day_period + 1), task_day - _dt.timedelta(days=1)
    if spec.schedule == SCHEDULE_MONTHLY:
        first_this = now.replace(day=1)
        last_prev = first_this - _dt.timedelta(days=1)
        return last_prev.replace(day=1), last_prev
    return now, now


def _ints(text: str) -> list[int]:
    return [int(x) for x in text.split(",") if x.strip()]


def apply_filters(df: DataFrame, spec: ReportSpec, begin, end, sides: str = "all") -> DataFrame:
    """F4 (+F5): publisher equality, day window and the non-blank IN lists.
    The user side only honours the app and country lists."""
    cond = (F.col("publisher_id") == spec.publisher_id) & (F.col("day") >= F.lit(begin)) & \
           (F.col("day") <= F.lit(end))
    lists = [("adn_id", spec.cond_adn_list), ("pub_app_id", spec.cond_pub_app_list),
             ("placement_id", spec.cond_placement_list), ("instance_id", spec.cond_instance_list)]
    if sides == "dau":
        lists = [lists[1]]
    for col, text in lists:
        if text.strip():
            cond = cond & F.col(col).isin(_ints(text))
    if spec.cond_country_list.strip():
        cond = cond & F.col("country").isin(spec.cond_country_list.split(","))
    return df.filter(cond)


def _sum_or_null(df: DataFrame, col: str) -> Column:
    return F.sum(col) if col in df.columns else F.lit(None).cast("bigint")


def adn_side(stat: DataFrame, spec: ReportSpec, begin, end) -> DataFrame:
    """network-side sums by the report dimensions."""
    src = apply_filters(stat, spec, begin, end)
    return src.groupBy(*spec.dims).agg(*[_sum_or_null(src, c).alias(n) for n, c in ADN_SUMS])


def lr_side(stat_lr: DataFrame, spec: ReportSpec, begin, end) -> DataFrame:
    """mediation-side sums by the report dimensions."""
    src = apply_filters(stat_lr, spec, begin, end)
    return src.groupBy(*spec.dims).agg(*[F.sum(c).alias(c) for c in LR_SUMS])


def dau_side(stat_dau: DataFrame, spec: ReportSpec, begin, end) -> DataFrame | None:
    """user-side sums, only for USER_ACTIVITY reports, dims restricted."""
    if spec.data_source != DS_USER_ACTIVITY:
        return None
    dims = [d for d in spec.dims if d in DAU_DIMS]
    src = apply_filters(stat_dau, spec, begin, end, sides="dau")
    return src.groupBy(*dims).agg(*[F.sum(c).alias(c) for c in DAU_SUMS])


def merge_sides(sides: list[DataFrame | None], dims: list[str]) -> DataFrame:
    """merge the sides per text key of the dimension values (NULL and ''
    collide, W14). A later side overrides the dimension values it carries;
    each metric comes from the one side that computes it."""
    tagged = []
    for i, s in enumerate(sides):
        if s is None:
            continue
        present = {f"_has_{d}": F.lit(d in s.columns) for d in dims}
        tagged.append(s.withColumn("_side", F.lit(i)).withColumns(present))
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    key = F.concat_ws(",", *[F.coalesce(F.col(d).cast("string"), F.lit("")) for d in dims])
    u = u.withColumn("_key", key)
    metrics = [c for c in u.columns if c not in dims and not c.startswith("_")]
    aggs = [F.max_by(F.col(d), F.when(F.col(f"_has_{d}"), F.col("_side"))).alias(d) for d in dims]
    aggs += [F.max_by(F.col(m), F.when(F.col(m).isNotNull(), F.col("_side"))).alias(m) for m in metrics]
    return u.groupBy("_key").agg(*aggs).drop("_key")


def label_dims(df: DataFrame, dims: list[str], labels: dict[str, DataFrame]) -> DataFrame:
    """replace id dimensions by their labels (id kept when unknown).
    ``labels`` maps a dim to a frame (id, label). Dimension tables are
    joined left; Spark broadcasts them when their statistics say small."""
    out = df
    for d in dims:
        if d.endswith("_id") and d in labels:
            lab = labels[d].select(F.col("id").alias(f"_id_{d}"), F.col("label").alias(f"_lab_{d}"))
            out = (out.join(lab, out[d] == lab[f"_id_{d}"], "left")
                   .withColumn(d, F.coalesce(F.col(f"_lab_{d}"), F.col(d).cast("string")))
                   .drop(f"_id_{d}", f"_lab_{d}"))
    return out


def pick_request_cols(spec: ReportSpec) -> tuple[str, str]:
    """F8: instance-level request/fill when the report is network/instance scoped."""
    d = spec.dims
    if "adn_id" in d or spec.cond_adn_list.strip() or "instance_id" in d or spec.cond_instance_list.strip():
        return "instance_request", "instance_filled"
    return "waterfall_request", "waterfall_filled"


def _long(c: str, df: DataFrame) -> Column:
    return F.coalesce(F.col(c).cast("bigint"), F.lit(0)) if c in df.columns else F.lit(0).cast("bigint")


def _txt6(x: Column) -> Column:
    return x.cast("decimal(38,6)").cast("string")


def derived_columns(df: DataFrame, request: Column, filled: Column) -> tuple[DataFrame, dict[str, Column]]:
    """F9a-h: ratio metrics as report text ("0" when undefined), by name, over
    the returned frame.

    The integer inputs are first named (``_request``, ``_impr``...), so each
    exact ratio compiles to one SQL expression over column names."""
    count = lambda c: F.coalesce(c.cast("bigint"), F.lit(0))
    base = {
        "_request": count(request), "_filled": count(filled), "_impr": _long("impr", df),
        "_click": _long("click", df), "_dau": _long("dau", df), "_deu": _long("deu", df),
        "_rt": _long("is_ready_true", df), "_rf": _long("is_ready_false", df),
        "_cost": F.col("cost") if "cost" in df.columns else F.lit(None).cast("decimal(38,8)"),
    }
    df = df.withColumns(base).withColumns({"_is_ready": F.col("_rt") + F.col("_rf"),
                                           "_cost1000": F.col("_cost") * F.lit(1000)})

    def ratio(a: str, b: str) -> Column:
        return _txt6(round_div(a, b, 6, "half_up"))

    def div_txt(a: str, b: str) -> Column:
        return F.when(F.col(b) != 0, ratio(a, b)).otherwise(F.lit("0"))

    zero = F.lit("0")
    cost = F.col("_cost")
    cap = F.lit(str(FILL_RATE_CAP))
    fill = round_div("_filled", "_request", 6, "half_up")
    fill_rate = (F.when(F.col("_request") != 0, F.when(fill > FILL_RATE_CAP, cap).otherwise(_txt6(fill)))
                 .when(F.col("_filled") > 0, cap).otherwise(zero))
    ctr = F.when(F.col("_impr") > 0, ratio("_click", "_impr")).when(F.col("_click") > 0, F.lit("1"))
    ecpm = F.when(cost.isNotNull() & (F.col("_impr") != 0), ratio("_cost1000", "_impr")).when(cost.isNotNull(), zero)
    derived = {
        "request": F.col("_request").cast("string"), "filled": F.col("_filled").cast("string"),
        "fill_rate": fill_rate, "is_ready": F.col("_is_ready").cast("string"),
        "is_ready_rate": div_txt("_rt", "_is_ready"), "ctr": ctr, "ecpm": ecpm,
        "impr_dau": div_txt("_impr", "_dau"), "impr_deu": div_txt("_impr", "_deu"),
        "arp_dau": F.when(cost.isNotNull() & (F.col("_dau") != 0), ratio("_cost", "_dau")).otherwise(zero),
        "arp_deu": F.when(cost.isNotNull() & (F.col("_deu") != 0), ratio("_cost", "_deu")).otherwise(zero),
        "engagement_rate": div_txt("_deu", "_dau"),
    }
    return df, derived


def derived_metrics(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """The metrics of a report (F9a-h and plain sums) as text columns ``_m_<metric>``."""
    req_col, fil_col = pick_request_cols(spec)
    df, derived = derived_columns(df, F.col(req_col), F.col(fil_col))
    cols = {}
    for m in spec.metric_list:
        if m in derived:
            cols[m] = derived[m]
        elif m in df.columns:
            cols[m] = F.col(m).cast("string")
        else:
            cols[m] = F.lit(None).cast("string")
    return df.withColumns({f"_m_{m}": v for m, v in cols.items()})


def render(df: DataFrame, spec: ReportSpec) -> DataFrame:
    """dims then metrics under their titles; dim NULL -> '', metric
    NULL -> '0'; ordered by day when day is a dimension."""
    dims, metrics = spec.dims, spec.metric_list
    out = df
    if "day" in dims:
        out = out.orderBy("day")
    return out.select(*[F.coalesce(F.col(d).cast("string"), F.lit("")).alias(TITLES.get(d, d)) for d in dims],
                      *[F.coalesce(F.col(f"_m_{m}"), F.lit("0")).alias(TITLES.get(m, m)) for m in metrics])


def custom_report(spec: ReportSpec, stat_adn: DataFrame, stat_lr: DataFrame, stat_dau: DataFrame | None,
                  labels: dict[str, DataFrame], task_day: _dt.date, now: _dt.date | None = None) -> DataFrame:
    """the whole custom report for one run."""
    begin, end = report_window(spec, task_day, now or task_day)
    sides = [adn_side(stat_adn, spec, begin, end), lr_side(stat_lr, spec, begin, end),
             dau_side(stat_dau, spec, begin, end) if stat_dau is not None else None]
    merged = merge_sides(sides, spec.dims)
    computed = derived_metrics(merged, spec)
    labelled = label_dims(computed, spec.dims, labels)
    return render(labelled, spec)
