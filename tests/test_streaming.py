"""Hash-delta load as a stream: only unseen rows are appended, reruns add nothing."""

import uuid

from pyspark.sql import functions as F

from starloom.session import scratch_path
from starloom.streaming.delta_stream import start_delta_stream
from tests.conftest import SMALL

PARTS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def test_stream_appends_only_new_rows(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").select(*PARTS)
    src, target = scratch_path(spark, "stream_src"), scratch_path(spark, "stream_target")
    first = orders.filter(F.col("o_orderkey") % 2 == 0)
    # the same rows arrive twice inside one batch: stored once
    first.unionByName(first).write.parquet(src)
    name = f"delta_{uuid.uuid4().hex[:8]}"
    q = start_delta_stream(spark, src, orders.schema, target, PARTS, name=name)
    q.awaitTermination()
    assert spark.read.parquet(target).count() == first.count()
    # a later file overlapping the stored rows: only the unseen half is appended
    orders.write.mode("append").parquet(src)
    q = start_delta_stream(spark, src, orders.schema, target, PARTS, name=name)
    q.awaitTermination()
    out = spark.read.parquet(target)
    assert out.count() == orders.count()
    assert out.select("row_hash").distinct().count() == orders.count()
