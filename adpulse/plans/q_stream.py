"""Registered streaming runs (S1-S3): the stream is fed files derived from
the fixture tables, several files per run and one file per micro-batch, out of
order and with late rows, run to completion (``availableNow``) and its sink
read back; the result equals the batch operator, so the batch oracle applies."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..fixtures import Views
from ..operators import users
from ..streaming import jobs
from .q_io import scratch, write_lr_json
from .q_state import DCENTERS
from .registry import QUERIES, doubles, register
from .. import schemas

FILES_PER_BATCH = 8


@register("stream_common_report", QUERIES["common_report"].oracle)
def q_stream_common_report(spark, sf_dir):
    """Hourly funnel as partial sums of micro-batches of day files: a late
    row comes with a later file than its hour's other rows. The first days' batches
    are compacted before the others come, so the report adds base and parts up."""
    root = scratch(spark)
    lr = Views(spark, sf_dir).f_lr
    middle = lr.agg(F.date_add(F.min("dt"), F.lit(15)).alias("d")).first()["d"]

    def run(days):
        write_lr_json(spark, lr.filter(days), root, hourly=False, mode="append")
        stream = spark.readStream.schema(schemas.LR).option("maxFilesPerTrigger", FILES_PER_BATCH).json(f"{root}/lr/*/*/*")
        jobs.start_funnel_stream(stream, f"{root}/stat_lr", f"{root}/_ckpt").awaitTermination()

    run(F.col("dt") < F.lit(middle))
    jobs.compact_funnel(spark, f"{root}/stat_lr")
    run(F.col("dt") >= F.lit(middle))
    cols = QUERIES["common_report"].build(spark, sf_dir).columns
    return doubles(jobs.read_funnel(spark, f"{root}/stat_lr").select(*cols), "bid_resp_price", "bid_win_price")


@register("stream_publisher_users", QUERIES["publisher_users"].oracle)
def q_stream_publisher_users(spark, sf_dir):
    """First-seen user marking per micro-batch with the first days in a
    state store. The state begins with the history of the last ten days; the
    files come newest day first, so every first day is corrected again. Read after a compaction."""
    root = scratch(spark)
    lr = Views(spark, sf_dir).f_lr
    write_lr_json(spark, lr, root, hourly=False)
    stream = spark.readStream.schema(schemas.LR).option("maxFilesPerTrigger", FILES_PER_BATCH) \
        .option("latestFirst", "true").json(f"{root}/lr/*/*/*") \
        .withColumn("_p", F.col("_metadata.file_path")) \
        .withColumn("dt", F.to_date(F.regexp_extract("_p", r"/y=(\d{4})/m=(\d{2})/d=(\d{2})/", 0), "/'y='yyyy/'m='MM/'d='dd/"))
    begin = lr.agg(F.date_sub(F.max("dt"), F.lit(9)).alias("d")).first()["d"]
    history = users.mark_publisher_users(lr, begin_day=begin)
    q = jobs.start_user_marking_stream(stream.drop("_p"), f"{root}/dws_publisher_user", f"{root}/_ckpt", history=history)
    q.awaitTermination()
    jobs.compact_user_history(spark, f"{root}/dws_publisher_user")
    return jobs.read_user_history(spark, f"{root}/dws_publisher_user") \
        .select("publisher_id", "pub_app_id", "country", "uid", "is_new", "ymd")


@register("stream_cap_delta", QUERIES["cap_messages"].oracle)
def q_stream_cap_delta(spark, sf_dir):
    """S3: cap change messages of several micro-batches of campaigns against
    the day's snapshot (seeded from the previous cap table). Every campaign
    comes twice; its second arrival changes nothing and sends nothing."""
    v = Views(spark, sf_dir)
    root = scratch(spark)
    day = _dt.date(1998, 6, 15)
    v.f_campaign_prev.write.mode("overwrite").parquet(f"{root}/snapshot/day={day:%Y-%m-%d}/v=")
    for _ in range(2):
        v.f_campaign.select("id", "publisher_id", "status", "daily_cap").repartition(3, "id") \
            .write.mode("append").parquet(f"{root}/campaign_in")
    stream = spark.readStream.schema("id bigint, publisher_id int, status int, daily_cap int") \
        .option("maxFilesPerTrigger", 1).parquet(f"{root}/campaign_in")
    q = jobs.start_cap_stream(stream, f"{root}/snapshot", f"{root}/messages", f"{root}/_ckpt", DCENTERS, day)
    q.awaitTermination()
    return spark.read.parquet(f"{root}/messages").select("topic", "value")
