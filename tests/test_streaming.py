import os
import tempfile

from pyspark.sql import functions as F

from claimsmith.streaming import latest_version, upsert_stream


def test_upsert_stream_merges_batches(spark):
    root = tempfile.mkdtemp(prefix="stream-")
    src, tgt, ck, audit = (os.path.join(root, x) for x in ("src", "tgt", "ck", "audit"))
    schema = "ID long, STATUS string"
    spark.createDataFrame([(1, "Waiting"), (2, "Complete")], schema).write.mode("append").json(src)
    stream = spark.readStream.schema(schema).json(src)
    q = upsert_stream(spark, stream, tgt, "ID", ck, audit, trigger_once=True)
    q.awaitTermination(120)
    spark.createDataFrame([(2, "Completed"), (3, "Not Started")], schema).write.mode("append").json(src)
    q = upsert_stream(spark, spark.readStream.schema(schema).json(src), tgt, "ID", ck, audit, trigger_once=True)
    q.awaitTermination(120)
    final = spark.read.parquet(latest_version(spark, tgt))
    assert sorted(tuple(r) for r in final.select("ID", "STATUS").collect()) == [
        (1, "Waiting"), (2, "Completed"), (3, "Not Started")]
    a = spark.read.parquet(audit).orderBy("RUN_ID").select("ROWS_INSERTED", "ROWS_UPDATED").collect()
    assert [tuple(r) for r in a] == [(2, 0), (1, 1)]
