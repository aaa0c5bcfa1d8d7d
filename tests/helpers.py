"""Test table folders and inline-row builders for micro-fixtures."""

import datetime as dt

from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("browser_name", T.StringType()),
    T.StructField("browser_version", T.StringType()),
    T.StructField("os_name", T.StringType()),
    T.StructField("os_version", T.StringType()),
    T.StructField("revision", T.StringType()),
    T.StructField("full_revision_hash", T.StringType()),
    T.StructField("raw_results_url", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("time_start", T.TimestampNTZType()),
    T.StructField("time_end", T.TimestampNTZType()),
    T.StructField("labels", T.ArrayType(T.StringType())),
])

T0 = dt.datetime(2018, 1, 1, 12, 0, 0)


def run(run_id, **kw):
    base = dict(run_id=run_id, browser_name="chrome", browser_version="62.0", os_name="linux",
                os_version="3.16", revision="abcdef0123", full_revision_hash="", raw_results_url="",
                created_at=T0, time_start=T0, time_end=T0 + dt.timedelta(minutes=20), labels=None)
    base.update(kw)
    return tuple(base[f.name] for f in RUNS_SCHEMA.fields)


def runs_df(spark, rows):
    return spark.createDataFrame(rows, RUNS_SCHEMA)


CELLS_SCHEMA = "run_id BIGINT, test STRING, subtest STRING, status STRING, sub_status STRING, pos BIGINT"
