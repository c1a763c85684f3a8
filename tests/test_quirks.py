"""Hand-computed micro-fixtures for the reference's behaviours (SURVEY W-rows)
and invariants of the operators."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adpulse import schemas
from adpulse.operators import ecpm, forecast, funnel, report, revenue, state, users
from adpulse.functions.text import range_exp, text_list
from adpulse.snapshots import rules

D1 = dt.date(2024, 1, 1)
D2 = dt.date(2024, 1, 2)
MS1 = 1704067200000  # 2024-01-01 00:00 UTC


def lr_frame(spark, rows):
    """Log rows from dicts; missing fields are NULL; adds dt/h."""
    names = [f.name for f in schemas.LR.fields]
    data = []
    for r in rows:
        data.append(tuple(r.get(n) for n in names) + (r.get("dt", D1), r.get("h", 0)))
    schema = T.StructType(list(schemas.LR.fields) + [T.StructField("dt", T.DateType()),
                                                     T.StructField("h", T.IntegerType())])
    return spark.createDataFrame(data, schema)


def test_deu_off_by_one_when_every_row_is_an_impression(spark):
    rows = [dict(serverTs=MS1, uid=u, type=6, publisherId=1, pubAppId=1, country="US") for u in ("a", "b")]
    lr = lr_frame(spark, rows)
    r = users.user_report(lr).first()
    assert (r.dau, r.deu) == (2, 1)          # W1: faithful, one too low
    assert users.user_report(lr, exact_deu=True).first().deu == 2


def test_null_type_rows_dropped_by_funnel_kept_by_users(spark):
    rows = [dict(serverTs=MS1, uid="a", type=None, impr=3, country="US"),
            dict(serverTs=MS1, uid="b", type=1, country="US"),
            dict(serverTs=MS1 + 3_600_000, uid="c", type=6, country="US", price=Decimal("2.5"))]
    lr = lr_frame(spark, rows)
    f = funnel.common_report(lr).collect()
    assert len(f) == 1 and f[0].hour == "01" and f[0].impr == 1          # W3
    assert users.user_report(lr).first().dau == 3


def test_funnel_counter_and_price_rules(spark):
    rows = [dict(serverTs=MS1, type=0, impr=4, click=0),                 # counter row: impr 4
            dict(serverTs=MS1, type=6),                                  # impression event: 1
            dict(serverTs=MS1, type=271, price=Decimal("1.5")),          # bid response, price fallback
            dict(serverTs=MS1, type=0, bidResPrice=Decimal("2"), bidRes=2)]
    r = funnel.common_report(lr_frame(spark, rows)).first()
    assert (r.impr, r.bid_resp, r.bid_resp_price, r.click) == (5, 3, Decimal("3.5"), 0)


def test_time_bucketing_ignores_session_zone(spark):
    rows = [dict(serverTs=MS1 + 23 * 3_600_000 + 59 * 60_000, type=6)]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        r = funnel.common_report(lr_frame(spark, rows)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (r.day, r.hour) == ("2024-01-01", "23")


def test_new_user_marking_range_equals_incremental_and_respects_history(spark):
    rows = [dict(serverTs=MS1, uid="a", publisherId=1, pubAppId=1, country="US", dt=D1),
            dict(serverTs=MS1, uid="a", publisherId=1, pubAppId=1, country="US", dt=D2),
            dict(serverTs=MS1, uid="b", publisherId=1, pubAppId=1, country="US", dt=D2)]
    lr = lr_frame(spark, rows)
    got = {(r.uid, r.ymd, r.is_new) for r in users.mark_publisher_users(lr).collect()}
    assert got == {("a", "20240101", 1), ("a", "20240102", 0), ("b", "20240102", 1)}
    hist = spark.createDataFrame([(1, 1, "US", "b", 1, "20231231")], schemas.PUBLISHER_USER)
    again = {(r.uid, r.is_new) for r in users.mark_publisher_users(lr, hist, begin_day=D2, end_day=D2).collect()}
    assert again == {("a", 1), ("b", 0)}


def test_rank_prices_single_rank_and_min_group(spark):
    rows = [dict(serverTs=MS1, type=6, did=f"d{i}", pubAppId=1, country="US", revenue=Decimal(i)) for i in
            range(1, 21)]
    rows += [dict(serverTs=MS1, type=6, did=f"x{i}", pubAppId=2, country="US", revenue=Decimal(i)) for i in
             range(1, 11)]
    out = revenue.revenue_rank_prices(lr_frame(spark, rows), grain="range").collect()
    assert len(out) == 1                                   # app 2 has n = 10, not > 10
    r = out[0]
    # n = 20, descending: rank 2 -> 19, rank 4 -> 17, ... divided by 1000
    assert [r.top10_price, r.top20_price, r.top30_price, r.top40_price, r.top50_price] == \
        [Decimal("0.019"), Decimal("0.017"), Decimal("0.015"), Decimal("0.013"), Decimal("0.011")]


def test_user_ad_revenue_conservation_and_null_country(spark):
    rows = [dict(serverTs=MS1, type=6, did="d1", pubAppId=1, plat=0, mid=2, iid=7, country="US"),
            dict(serverTs=MS1, type=7, did="d2", pubAppId=1, plat=0, mid=2, iid=7, country="US"),
            dict(serverTs=MS1, type=6, did="d3", pubAppId=1, plat=1, mid=2, iid=7, country=None)]
    cost = spark.createDataFrame([(D1, 1, 0, 2, "US", 7, Decimal("10")), (D1, 1, 1, 2, None, 7, Decimal("5"))],
                                 "dt date, pub_app_id int, platform int, adn_id int, country string, "
                                 "instance_id int, cost decimal(20,8)")
    adn = spark.createDataFrame([(2, "AdnTwo")], "id int, class_name string")
    out = {r.device_id: r for r in revenue.user_ad_revenue(lr_frame(spark, rows), cost, adn).collect()}
    assert out["d1"].revenue == Decimal("2.000000000000")       # weight 1 of 5
    assert out["d2"].revenue == Decimal("8.000000000000")       # weight 4 of 5
    assert out["d3"].revenue == 0                                # W9: NULL country never matches a cost
    assert out["d1"].device_type == "IDFA" and out["d3"].device_type == "GAID"   # W12
    assert out["d1"].adn_name == "AdnTwo"


def test_ecpm_latest_day_wins_and_missing_delay_drops(spark):
    stat = spark.createDataFrame(
        [(D1, 1, 0, "US", 100, Decimal("1")), (D2, 1, 0, "US", 100, Decimal("3")),
         (D2, 2, 0, "US", 100, Decimal("5"))],
        "day date, adn_id int, ad_type int, country string, api_impr bigint, revenue decimal(18,2)")
    delays = spark.createDataFrame([(1, 1)], "adn_id int, delay_hours int")
    out = ecpm.ecpm_rollup(stat, "adn_adtype_country_ecpm_3d", dt.datetime(2024, 1, 3, 12), delays).collect()
    assert len(out) == 1 and out[0].ecpm == Decimal("30.000000")   # W7 latest day; network 2 has no delay


def test_smoothing_constant_series_and_seed(spark):
    df = spark.createDataFrame([([Decimal("1.5")] * 5,), ([Decimal("1"), Decimal("2"), Decimal("3"), Decimal("4")],)],
                               "xs array<decimal(10,8)>")
    out = df.select(forecast.exp_smoothing(F.col("xs")).alias("s1"),
                    forecast.exp_smoothing(F.col("xs"), seed=3).alias("s3")).collect()
    assert out[0].s1 == Decimal("1.5") and out[0].s3 == Decimal("1.5")
    # s = 1; then 1, 2, 3, 4: 1 -> 1.6 -> 2.44 -> 3.376
    assert out[1].s1 == Decimal("3.376")
    # seed = mean(1,2,3) = 2: 1.4 -> 1.76 -> 2.504 -> 3.4016
    assert out[1].s3 == Decimal("3.4016")


def test_report_fill_rate_cap_ctr_and_null_key_merge(spark):
    spec = report.ReportSpec(publisher_id=1, dimensions="country", metrics="fillRate,ctr,impr",
                             cond_day_period=1)
    adn = spark.createDataFrame([(D1, 1, None, 0, 5, Decimal("1"))],
                                "day date, publisher_id int, country string, api_impr bigint, api_click bigint, "
                                "cost decimal(18,4)")
    lr = spark.createDataFrame([(D1, 1, "", 0, 3, 0, 0)],
                               "day date, publisher_id int, country string, waterfall_request bigint, "
                               "waterfall_filled bigint, instance_request bigint, instance_filled bigint")
    for c in report.LR_SUMS:
        if c not in lr.columns:
            lr = lr.withColumn(c, F.lit(0).cast("bigint"))
    out = report.custom_report(spec, adn, lr, None, {}, D2).collect()
    assert len(out) == 1                                   # W14: NULL and '' share one line
    r = out[0]
    assert (r["Fill Rate"], r["CTR"], r["Impressions"]) == ("100", "1", "0")   # W13 and ctr rule


def test_snake_case():
    assert report.snake_case("pubAppId") == "pub_app_id"
    assert report.snake_case("day,adnId") == "day,adn_id"


def test_range_expression_edge_cases(spark):
    df = spark.createDataFrame([("(,)",), (" 4.4 ;; [5, ] ",), (None,)], "e string")
    out = df.select(range_exp("e").alias("r")).collect()
    assert out[0].r.ranges[0].asDict() == {"min": None, "max": None, "min_open": True, "max_open": True}  # W17
    assert out[1].r.items == ["4.4"] and out[1].r.ranges[0]["min"] == "5" and out[1].r.ranges[0]["max"] is None
    assert out[2].r.items == [] and out[2].r.ranges == []
    lst = spark.createDataFrame([(" A, b,,\nC ",)], "t string").select(text_list("t", lower=True)).first()[0]
    assert lst == ["a", "b", "c"]


def test_rule_weight_last_row_wins(spark):
    live = spark.createDataFrame([(1, 9, 0, 5, 1, 10), (1, 9, 2, 1, 1, 20), (1, 9, 1, 99, 1, 30)],
                                 "rule_id int, instance_id int, group_id int, priority int, sort_type int, "
                                 "value int")
    m = rules.rule_instance_weights(live).first().instance_weight
    assert m == {9: 20}                                    # W16: largest (group, priority) wins


def test_cap_delta_and_cross_rates(spark):
    cur = spark.createDataFrame([(1, 1, 1, 10), (2, 1, 1, 5), (3, 1, 1, 7), (4, 1, 0, 9)],
                                "id bigint, publisher_id int, status int, daily_cap int")
    prev = spark.createDataFrame([(1, 10), (2, 8)], "id bigint, daily_cap int")
    got = {r.id: r.change_cap for r in state.cap_delta(cur, prev).collect()}
    assert got == {2: -3, 3: 7}
    q = spark.createDataFrame([("USD", Decimal("1.2")), ("GBP", Decimal("0.9"))], "cur string, rate decimal(18,6)")
    rates = {r.cur_from: r.exchange_rate for r in state.cross_rates(q).collect()}
    assert rates == {"USD": Decimal("1.000000"), "GBP": Decimal("1.333333")}


def test_report_windows():
    daily = report.ReportSpec(publisher_id=1, dimensions="day", metrics="impr", cond_day_period=2)
    assert report.report_window(daily, D2, D2) == (dt.date(2023, 12, 30), D1)
    monthly = report.ReportSpec(publisher_id=1, dimensions="day", metrics="impr", schedule=report.SCHEDULE_MONTHLY)
    # The monthly window follows "now", not the task day
    assert report.report_window(monthly, D2, dt.date(2024, 3, 5)) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    other = report.ReportSpec(publisher_id=1, dimensions="day", metrics="impr", schedule=9)
    assert report.report_window(other, D2, dt.date(2024, 3, 5)) == (dt.date(2024, 3, 5), dt.date(2024, 3, 5))


def test_custom_tags_parsing(spark):
    j = ('{"vip":{"type":0,"conditions":[{"operator":"in","value":"a,b"},{"operator":"=","value":" "}]},'
         '"lvl":{"type":1,"conditions":[{"operator":">=","value":"3"}]},"none":{"type":0},'
         '"blank":{"type":2,"conditions":[{"operator":"=","value":""}]}}')
    tags = spark.createDataFrame([(j,)], "t string").select(rules.custom_tags("t").alias("m")).first().m
    assert set(tags) == {"vip", "lvl", "blank"}                    # a tag without a conditions list is dropped
    assert [c.asDict() for c in tags["vip"].conditions] == [{"operator": "in", "value": None, "values": ["a", "b"]}]
    assert tags["lvl"].conditions[0].value == "3" and tags["blank"].conditions == []   # blank values skipped


def test_user_report_approximate_variant(spark):
    rows = [dict(serverTs=MS1, uid=f"u{i}", ip=f"ip{i % 5}", did=f"d{i}", type=6 if i % 2 else 0, country="US")
            for i in range(200)]
    lr = lr_frame(spark, rows)
    exact = users.user_report(lr, exact_deu=True).first()
    approx = users.user_report(lr, exact_deu=True, approx_rsd=0.02).first()
    assert exact.dau == 200 and exact.ip_count == 5 and exact.deu == 100
    assert abs(approx.dau - 200) <= 12 and approx.ip_count == 5 and abs(approx.deu - 100) <= 6


def test_region_map_keeps_whitelisted_countries_only(spark):
    apps = spark.createDataFrame([(1, 1, "US,DE"), (2, 1, "")], "id int, status int, uar_regions string")
    fc = spark.createDataFrame(
        [(1, "US", D2, *[Decimal("0.001")] * 5), (1, "CN", D2, *[Decimal("0.002")] * 5),
         (2, "US", D2, *[Decimal("0.003")] * 5)],
        "pub_app_id int, country string, run_day date, uar1 decimal(38,18), uar2 decimal(38,18), "
        "uar3 decimal(38,18), uar4 decimal(38,18), uar5 decimal(38,18)")
    out = {r.pub_app_id: r for r in forecast.uar_region_map(fc, apps).collect()}
    assert list(out[1].region_uar) == ["US"] and out[1].region_uar["US"][0] == Decimal("1")
    assert out[2].region_uar_json == "{}"                      # no whitelisted region: empty map


def test_dictionary_of_any_depth_and_circles(spark):
    import pytest
    from adpulse.snapshots import common
    chain = [(i + 1, i, f"n{i}", str(i)) for i in range(120)]
    d = spark.createDataFrame(chain + [(500, 501, "a", "x"), (501, 500, "b", "y")], "id int, pid int, name string, value string")
    got = {r.id: r.path for r in common.dict_paths(d).collect()}
    assert got[3] == "/n0/n1/n2" and got[120].count("/") == 120 and 500 not in got  # a circle no root leads to
    ring = spark.createDataFrame([(1, 0, "a", "x"), (2, 1, "b", "y"), (1, 2, "a", "z")], "id int, pid int, name string, value string")
    with pytest.raises(ValueError):
        common.dict_paths(ring)


def test_repeated_keys_and_null_switches_in_snapshots(spark):
    from adpulse.snapshots import inventory
    steps = spark.createDataFrame([("5:30\n7:70\r\nx\n5:40",), ("",)], "s string").select(
        inventory.inventory_interval_step("s").alias("m")).collect()
    assert steps[0].m == {5: 40, 7: 70} and steps[1].m == {5: 30, 8: 300, 10: 3600}
    pc = spark.createDataFrame([(1, 10, "US", 1, 2.5, 9.0, 3), (2, 10, "US", 1, 4.5, None, 0), (3, 10, "DE", None, 1.0, 1.0, 1)],
                               "id int, placement_id int, country string, floor_price_switch int, floor_price double, max_price double, hour0 int")
    placements = spark.createDataFrame([(10, 7, 1)], "id int, pub_app_id int, status int")
    apps = spark.createDataFrame([(7, 1, 1)], "id int, publisher_id int, status int")
    live, gone = (spark.createDataFrame([(1, s)], "id int, status int") for s in (1, 0))
    m = inventory.placement_country_settings(pc, placements, apps, live).first().country_settings
    assert (m["US"].floor_price, m["US"].max_price, m["US"].period) == (4.5, -1.0, {})
    assert (m["DE"].floor_price, m["DE"].max_price, m["DE"].period) == (-1.0, -1.0, {0: 1})
    assert inventory.placement_country_settings(pc, placements, apps, gone).count() == 0


def test_mean_seed_is_exact_beyond_eight_decimals(spark):
    from decimal import Decimal
    from adpulse.operators import forecast
    rows = [("g", i, Decimal(x)) for i, x in enumerate(("0.000001499999999999", "0.0000015", "0.000001500000000001", "1"))]
    df = spark.createDataFrame(rows, "k string, o int, v decimal(38,18)")
    for seed, want in ((3, "0.000002"), (2, "0.000001")):
        n = F.lit(seed)
        total = df.filter(F.col("o") < seed).agg(F.sum("v").cast("decimal(38,18)").alias("t"))
        assert total.select(forecast.mean_seed(F.col("t"), n, seed).alias("m")).first().m == Decimal(want)
