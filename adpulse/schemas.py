"""Explicit schemas of the raw inputs (never inferred).

JSON keys are matched case-sensitively by Spark, so the camelCase names of
the logs are kept here and renamed only by the reports.
"""

from __future__ import annotations

from pyspark.sql import types as T

_I, _L, _S = T.IntegerType(), T.LongType(), T.StringType()
MONEY = T.DecimalType(20, 8)


def _fields(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


# Request log (lr): the columns the jobs read.
LR = _fields(
    [("serverTs", _L), ("uid", _S), ("did", _S), ("ip", _S), ("country", _S), ("appv", _S), ("sdkv", _S),
     ("osv", _S)]
    + [(c, _I) for c in ("plat", "publisherId", "pubAppId", "pid", "iid", "mid", "scene", "type", "bid", "ruleId",
                         "abt", "abtId", "wfReq", "wfFil", "insReq", "insFil", "vdStart", "vdEnd", "calledShow",
                         "readyTrue", "readyFalse", "click", "impr", "bidReq", "bidRes", "bidWin")]
    + [(c, MONEY) for c in ("price", "bidResPrice", "bidWinPrice", "revenue")])

IAP = _fields([("ts", _L), ("serverTs", _L), ("uid", _S), ("did", _S), ("country", _S), ("cur", _S), ("msg", _S),
               ("publisherId", _I), ("pubAppId", _I), ("plat", _I), ("status", _I),
               ("iap", MONEY), ("iapt", MONEY), ("iapUsd", MONEY)])

CPTK = _fields([("ts", _L), ("cts", _L), ("sts", _L), ("cy", _S), ("appId", _S), ("did", _S), ("uid", _S),
                ("bidid", _S), ("tkid", _S), ("pid", _I), ("publisherId", _I), ("pubAppId", _I), ("adType", _I),
                ("billingType", _I), ("impr", _I), ("click", _I), ("cid", _L), ("crid", _L), ("cost", MONEY)])

EVENT = _fields([("serverTs", _L), ("did", _S), ("uid", _S), ("country", _S), ("publisherId", _I),
                 ("pubAppId", _I), ("plat", _I),
                 ("events", T.ArrayType(T.MapType(_S, _S)))])

LOG_SCHEMAS = {"lr": LR, "iap": IAP, "cptk": CPTK, "event": EVENT}

# Daily network cost dump (ods_stat_adnetwork), in column order of the file.
STAT_ADNETWORK = _fields([("id", _I), ("publisher_id", _I), ("pub_app_id", _I), ("platform", _I),
                          ("country", _S), ("adn_id", _I), ("instance_id", _I), ("cost", MONEY)])

# Network dimension (ods_om_adnetwork).
OM_ADNETWORK = _fields([("id", _I), ("name", _S), ("class_name", _S), ("descn", _S)])

# Publisher-user history (dws_publisher_user), partitioned by ymd.
PUBLISHER_USER = _fields([("publisher_id", _I), ("pub_app_id", _I), ("country", _S), ("uid", _S),
                          ("is_new", _I), ("ymd", _S)])
