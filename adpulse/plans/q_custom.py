"""Registered custom reports (F1-F12) and their generated DuckDB oracles.

The oracles take nothing from the operator: titles, windows, sides and the
choice of request columns are written out here."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import functions as F

from ..fixtures import Views, with_views
from ..functions.numeric import duck_round_div
from ..operators import funnel, report, report_table, users
from ..operators.report import ReportSpec
from ..sinks import writers
from .oracle_sql import counter, duck_day
from .q_io import scratch
from .q_reports import _C1_COUNTERS
from .registry import register

TASK_DAY = _dt.date(2024, 2, 1)
# a daily schedule whose look-back covers every fixture day (1995 .. 2024)
PERIOD = (TASK_DAY - _dt.date(1995, 1, 1)).days

SPECS = {
    "custom_report_performance": ReportSpec(
        publisher_id=1, dimensions="day,adnId",
        metrics="request,filled,fillRate,isReady,isReadyTrue,isReadyRate,impr,click,ctr,cost,ecpm",
        cond_day_period=PERIOD),
    "custom_report_user_activity": ReportSpec(
        publisher_id=2, dimensions="day,pubAppId,country", data_source=report.DS_USER_ACTIVITY,
        metrics="impr,click,dau,deu,imprDau,imprDeu,arpDau,arpDeu,engagementRate,cost,fillRate",
        cond_day_period=PERIOD, cond_country_list="US,DE,NATION_3,NATION_7"),
    "custom_report_labels": ReportSpec(
        publisher_id=1, dimensions="pubAppId,placementId,instanceId,adnId",
        metrics="impr,click,ctr,ecpm,cost,request,filled,fillRate", cond_day_period=PERIOD,
        cond_adn_list="1,2,3,4,13,22"),
    # the week before the task day, and the month before the run's own month
    "custom_report_weekly": ReportSpec(
        publisher_id=2, dimensions="day,country", data_source=report.DS_USER_ACTIVITY, schedule=report.SCHEDULE_WEEKLY,
        metrics="request,filled,impr,click,dau,deu,engagementRate,isReadyRate", cond_day_period=6),
    "custom_report_monthly": ReportSpec(
        publisher_id=3, dimensions="pubAppId,country", schedule=report.SCHEDULE_MONTHLY, cond_day_period=3,
        metrics="impr,click,ctr,cost,ecpm,request"),
}
RUN_DAYS = {"custom_report_weekly": (_dt.date(2024, 1, 20), None),
            "custom_report_monthly": (_dt.date(1998, 7, 9), _dt.date(1998, 7, 3))}  # task day, day of the run


@dataclass(frozen=True)
class Expected:
    """What the oracle of a report is written with."""
    begin: str
    end: str
    request: str = "waterfall_request"
    filled: str = "waterfall_filled"


EXPECTED = {
    "custom_report_performance": Expected("1994-12-31", "2024-01-31", "instance_request", "instance_filled"),
    "custom_report_user_activity": Expected("1994-12-31", "2024-01-31"),
    "custom_report_labels": Expected("1994-12-31", "2024-01-31", "instance_request", "instance_filled"),
    "custom_report_weekly": Expected("2024-01-13", "2024-01-19"),
    "custom_report_monthly": Expected("1998-06-01", "1998-06-30"),
}
# Titles of the columns these reports have.
_TITLES = {
    "day": "Date", "country": "Region", "adn_id": "AdNetwork", "pub_app_id": "App", "placement_id": "Placement",
    "instance_id": "Instance", "request": "Requests", "filled": "Fills", "fill_rate": "Fill Rate",
    "is_ready": "Ad-Availability Check", "is_ready_true": "Ad-Availability Response", "is_ready_rate": "Availability Rate",
    "impr": "Impressions", "click": "Clicks", "ctr": "CTR", "cost": "Revenue", "ecpm": "eCPM", "dau": "DAU", "deu": "DEU",
    "impr_dau": "Impressions per DAU", "impr_deu": "Impressions per DEU", "arp_dau": "ARPDAU", "arp_deu": "ARPDEU",
    "engagement_rate": "Engagement Rate",
}
_ADN_METRICS = ["api_request", "api_filled", "click", "impr", "api_video_start", "api_video_complete", "revenue", "cost"]
_LR_METRICS = ["waterfall_request", "waterfall_filled", "instance_request", "instance_filled", "video_start",
               "video_complete", "called_show", "is_ready_true", "is_ready_false"]
_DAU_METRICS = ["ip_count", "dau", "deu"]
_CAP = 100  # a fill rate above it is shown as it


def inputs(spark, sf_dir):
    """Stat tables for the builder: network stats (f_stat), the funnel
    report (C1) and the user report (C3) over f_lr, and label tables."""
    v = Views(spark, sf_dir)
    stat = v.f_stat.withColumns({"api_video_start": F.lit(None).cast("bigint"),
                                 "api_video_complete": F.lit(None).cast("bigint")})
    lr = v.f_lr
    stat_lr = funnel.common_report(lr).withColumn("day", F.to_date("day"))
    stat_dau = users.user_report(lr).withColumn("day", F.to_date("day"))
    labels = {
        "adn_id": v.f_adn.select("id", F.col("class_name").alias("label")),
        "pub_app_id": v.f_app.select("id", F.col("app_id").alias("label")),
        "placement_id": v.f_placement.select("id", F.col("name").alias("label")),
        "instance_id": v.f_instance.select("id", F.col("name").alias("label")),
    }
    return stat, stat_lr, stat_dau, labels


def _builder(name):
    def build(spark, sf_dir):
        stat, stat_lr, stat_dau, labels = inputs(spark, sf_dir)
        task_day, now = RUN_DAYS.get(name, (TASK_DAY, None))
        return report.custom_report(SPECS[name], stat, stat_lr, stat_dau, labels, task_day, now)
    return build


# ---------------------------------------------------------------- oracle text

_SLR = f"""
, slr AS (SELECT CAST({duck_day('serverTs')} AS DATE) AS day, country, coalesce(publisherId, 0) AS publisher_id,
                 coalesce(pubAppId, 0) AS pub_app_id, coalesce(pid, 0) AS placement_id, coalesce(iid, 0) AS instance_id,
                 coalesce(mid, 0) AS adn_id,
                 {", ".join(f"SUM({counter(int(c), f)}) AS {n}" for n, c, f in (x.split() for x in _C1_COUNTERS.split(",")))}
          FROM f_lr WHERE serverTs IS NOT NULL AND type <> 1 GROUP BY ALL)
, sdau AS (SELECT dt AS day, coalesce(publisherId, 0) AS publisher_id, coalesce(pubAppId, 0) AS pub_app_id, country,
                  count(DISTINCT ip) AS ip_count, count(DISTINCT uid) AS dau,
                  count(DISTINCT CASE WHEN type = 6 THEN uid ELSE '' END) - 1 AS deu
           FROM f_lr WHERE serverTs IS NOT NULL
           GROUP BY dt, coalesce(publisherId, 0), coalesce(pubAppId, 0), coalesce(plat, -1), country, appv, sdkv, osv)"""


def _where(spec: ReportSpec, begin, end, dau: bool = False) -> str:
    w = [f"publisher_id = {spec.publisher_id}", f"day >= DATE '{begin}'", f"day <= DATE '{end}'"]
    lists = [("adn_id", spec.cond_adn_list), ("pub_app_id", spec.cond_pub_app_list),
             ("placement_id", spec.cond_placement_list), ("instance_id", spec.cond_instance_list)]
    if dau:
        lists = [lists[1]]
    for col, text in lists:
        if text.strip():
            w.append(f"{col} IN ({text})")
    if spec.cond_country_list.strip():
        w.append("country IN (" + ", ".join(f"'{c}'" for c in spec.cond_country_list.split(",")) + ")")
    return " AND ".join(w)


def _oracle(name: str) -> str:
    spec, known = SPECS[name], EXPECTED[name]
    begin, end = known.begin, known.end
    dims = spec.dims
    has = lambda present: ", ".join(f"{'TRUE' if d in present else 'FALSE'} AS _has_{d}" for d in dims)
    gd = ", ".join(dims)
    adn = (f"SELECT {gd}, SUM(api_request) AS api_request, SUM(api_filled) AS api_filled, SUM(api_click) AS click, "
           f"SUM(api_impr) AS impr, CAST(NULL AS HUGEINT) AS api_video_start, CAST(NULL AS HUGEINT) AS api_video_complete, "
           f"SUM(revenue) AS revenue, SUM(cost) AS cost, 0 AS _side, {has(dims)} "
           f"FROM f_stat WHERE {_where(spec, begin, end)} GROUP BY {gd}")
    lr = (f"SELECT {gd}, {', '.join(f'SUM({m}) AS {m}' for m in _LR_METRICS)}, 1 AS _side, {has(dims)} "
          f"FROM slr WHERE {_where(spec, begin, end)} GROUP BY {gd}")
    parts = [adn, lr]
    if spec.data_source == report.DS_USER_ACTIVITY:
        dd = [d for d in dims if d in ("pub_app_id", "country", "day")]
        parts.append(f"SELECT {', '.join(dd)}, SUM(ip_count) AS ip_count, SUM(dau) AS dau, SUM(deu) AS deu, "
                     f"2 AS _side, {has(dd)} FROM sdau WHERE {_where(spec, begin, end, dau=True)} "
                     f"GROUP BY {', '.join(dd)}")
    union = " UNION ALL BY NAME ".join(f"({p})" for p in parts)
    metric_cols = _ADN_METRICS + _LR_METRICS + (_DAU_METRICS if spec.data_source == report.DS_USER_ACTIVITY else [])
    key = "concat_ws(',', " + ", ".join(f"coalesce(CAST({d} AS VARCHAR), '')" for d in dims) + ")"
    merged = ("SELECT " + ", ".join(
        [f"arg_max_null({d}, CASE WHEN _has_{d} THEN _side END) AS {d}" for d in dims]
        + [f"arg_max_null({m}, CASE WHEN {m} IS NOT NULL THEN _side END) AS {m}" for m in metric_cols])
        + f" FROM u GROUP BY {key}")
    req, fil = known.request, known.filled

    def lng(c):
        return f"coalesce(CAST({c} AS BIGINT), 0)" if c in metric_cols else "CAST(0 AS BIGINT)"

    def txt6(expr):
        return f"CAST(CAST({expr} AS DECIMAL(38,6)) AS VARCHAR)"

    def div_txt(a, b):
        return f"CASE WHEN {b} <> 0 THEN {txt6(duck_round_div(a, b))} ELSE '0' END"

    has_dau = spec.data_source == report.DS_USER_ACTIVITY
    dau, deu = (lng("dau"), lng("deu")) if has_dau else ("CAST(0 AS BIGINT)", "CAST(0 AS BIGINT)")
    impr, click, request, filled = lng("impr"), lng("click"), lng(req), lng(fil)
    rt, rf = lng("is_ready_true"), lng("is_ready_false")
    ratio = duck_round_div(filled, request)
    derived = {
        "request": f"CAST({request} AS VARCHAR)", "filled": f"CAST({filled} AS VARCHAR)",
        "fill_rate": (f"CASE WHEN {request} <> 0 THEN CASE WHEN {ratio} > {_CAP} THEN '{_CAP}' ELSE {txt6(ratio)} END "
                      f"WHEN {filled} > 0 THEN '{_CAP}' ELSE '0' END"),
        "is_ready": f"CAST({rt} + {rf} AS VARCHAR)", "is_ready_rate": div_txt(rt, f"({rt} + {rf})"),
        "ctr": f"CASE WHEN {impr} > 0 THEN {txt6(duck_round_div(click, impr))} WHEN {click} > 0 THEN '1' END",
        "ecpm": (f"CASE WHEN cost IS NOT NULL AND {impr} <> 0 THEN {txt6(duck_round_div('cost * 1000', impr))} "
                 f"WHEN cost IS NOT NULL THEN '0' END"),
        "impr_dau": div_txt(impr, dau), "impr_deu": div_txt(impr, deu),
        "arp_dau": f"CASE WHEN cost IS NOT NULL AND {dau} <> 0 THEN {txt6(duck_round_div('cost', dau))} ELSE '0' END",
        "arp_deu": f"CASE WHEN cost IS NOT NULL AND {deu} <> 0 THEN {txt6(duck_round_div('cost', deu))} ELSE '0' END",
        "engagement_rate": div_txt(deu, dau),
    }
    label_src = {"adn_id": ("f_adn", "class_name"), "pub_app_id": ("f_app", "app_id"),
                 "placement_id": ("f_placement", "name"), "instance_id": ("f_instance", "name")}
    joins, dim_sel = [], []
    for i, d in enumerate(dims):
        title = _TITLES[d]
        if d in label_src:
            t, lab = label_src[d]
            joins.append(f"LEFT JOIN {t} l{i} ON m.{d} = l{i}.id")
            dim_sel.append(f"coalesce(l{i}.{lab}, CAST(m.{d} AS VARCHAR), '') AS \"{title}\"")
        else:
            dim_sel.append(f"coalesce(CAST(m.{d} AS VARCHAR), '') AS \"{title}\"")
    met_sel = []
    for mname in spec.metric_list:
        title = _TITLES[mname]
        expr = derived.get(mname) or (f"CAST(m.{mname} AS VARCHAR)" if mname in metric_cols else "NULL")
        met_sel.append(f"coalesce({expr}, '0') AS \"{title}\"")
    body = (f"{_SLR}\n, u AS ({union})\n, m AS ({merged})\n"
            f"SELECT {', '.join(dim_sel + met_sel)} FROM m {' '.join(joins)}")
    # metric expressions refer to bare metric names of m
    return with_views(["f_lr", "f_stat", "f_adn", "f_app", "f_placement", "f_instance"], body)


for _name in SPECS:
    register(_name, _oracle(_name), headline=_name == "custom_report_performance")(_builder(_name))


def _table_oracle() -> str:
    """Every report's own oracle, its titles turned back into column names."""
    parts = []
    for name, spec in SPECS.items():
        columns = ", ".join(f'"{_TITLES[c]}" AS {c}' for c in spec.dims + spec.metric_list)
        parts.append(f"(SELECT '{name}' AS report, {columns} FROM ({_oracle(name)}) r_{name})")
    return "SELECT * FROM (" + "\nUNION ALL BY NAME\n".join(parts) + ") t"


@register("custom_reports_table", _table_oracle())
def q_custom_reports_table(spark, sf_dir):
    """F12 for all the specs above in one job; the columns that any of them shows."""
    stat, stat_lr, stat_dau, labels = inputs(spark, sf_dir)
    specs = report_table.specs_frame(spark, {n: (s, *RUN_DAYS.get(n, (TASK_DAY, None))) for n, s in SPECS.items()})
    shown = list(dict.fromkeys(c for s in SPECS.values() for c in s.dims + s.metric_list))
    return report_table.custom_reports(specs, stat, stat_lr, stat_dau, labels).select("report", *shown)


@register("report_csv_roundtrip", f"SELECT CAST(row_number() OVER (ORDER BY \"Date\") AS BIGINT) AS line, count(*) OVER () AS lines, "
          f"\"Date\" AS day FROM ({_oracle('custom_report_weekly')}) r")
def q_report_csv_roundtrip(spark, sf_dir):
    """The weekly report as CSV with its title row, read back file after
    file: the days of its lines, in the order they stand in."""
    path = f"{scratch(spark)}/report"
    writers.write_report_csv(_builder("custom_report_weekly")(spark, sf_dir), path)
    back = spark.read.option("header", True).csv(path)
    place = F.struct(F.col("_metadata.file_name"), F.monotonically_increasing_id())
    lines = back.select(F.col("Date").alias("day"), place.alias("_place"))
    ranked = lines.groupBy().agg(F.array_sort(F.collect_list(F.struct("_place", "day"))).alias("_l"))  # one report
    return ranked.select(F.posexplode("_l").alias("line", "_r"), F.size("_l").cast("long").alias("lines")) \
        .select((F.col("line") + 1).cast("long").alias("line"), "lines", "_r.day")


@register("snake_case_columns", with_views(["f_lr"], """
SELECT serverTs AS server_ts, strftime(dt, '%Y-%m-%d') AS dt, h, uid, did, ip, publisherId AS publisher_id, pubAppId AS pub_app_id, plat,
       country, pid, iid, mid, scene, abt, abtId AS abt_id, ruleId AS rule_id, bid, appv, sdkv, osv, type, impr, click,
       wfReq AS wf_req, wfFil AS wf_fil, insReq AS ins_req, insFil AS ins_fil, vdStart AS vd_start, vdEnd AS vd_end,
       calledShow AS called_show, readyTrue AS ready_true, readyFalse AS ready_false, bidReq AS bid_req, bidRes AS bid_res,
       bidWin AS bid_win, CAST(bidResPrice AS DOUBLE) AS bid_res_price, CAST(bidWinPrice AS DOUBLE) AS bid_win_price,
       CAST(price AS DOUBLE) AS price, CAST(revenue AS DOUBLE) AS revenue
FROM f_lr
"""))
def q_snake_case_columns(spark, sf_dir):
    """every camelCase log column renamed to its report (snake_case) name."""
    out = report.snake_case_columns(Views(spark, sf_dir).f_lr)
    money = {c: F.col(c).cast("double") for c in ("bid_res_price", "bid_win_price", "price", "revenue")}
    return out.withColumns(money | {"dt": F.date_format("dt", "yyyy-MM-dd")})
