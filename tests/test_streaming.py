from pyspark.sql import functions as F

from recunify.functions.blank import is_blank_trim
from recunify.session import scratch_path
from recunify.sources import standins as si
from recunify.streaming.ingest import ingest_files

from conftest import SF001


def test_available_now_ingest_is_incremental(spark):
    src, dst, ck = (scratch_path(spark, n) for n in ("st_src", "st_dst", "st_ck"))
    c = si.contacts(spark, SF001)
    # both runs carry rows of the same days: the second must not replace the first
    first = c.where(F.col("update_time") < "12_00_00")
    first.write.mode("append").parquet(src)
    keep_filled = lambda df: df.where(~is_blank_trim("attr_a"))
    q = ingest_files(spark, src, c.schema, dst, ["update_day"], ck, keep_filled)
    q.awaitTermination(120)
    assert spark.read.parquet(dst).count() == keep_filled(first).count()
    c.where(F.col("update_time") >= "12_00_00").write.mode("append").parquet(src)
    q = ingest_files(spark, src, c.schema, dst, ["update_day"], ck, keep_filled)
    q.awaitTermination(120)
    back = spark.read.parquet(dst)
    assert back.count() == keep_filled(c).count()
    assert back.select("ingest_batch").distinct().count() == 2
    assert back.drop("ingest_batch").exceptAll(keep_filled(c).select(*back.drop("ingest_batch").columns)).count() == 0
