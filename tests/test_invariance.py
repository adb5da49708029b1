"""Same results at 1, 4 and 32 shuffle partitions; streaming equals batch."""
import pytest

from seqintel.plans import queries as Q

SF = "/root/testdata/sf0.001"
NAMES = ["D1_dedup_first", "E1_chronological_position", "K14_enrich_posts", "D8_phase_sequences",
         "K10_author_report_chunked", "D13_confusion_matrix"]


def _rows(spark, name):
    return sorted(map(tuple, Q.QUERIES[name](spark, SF).collect()), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_partition_invariance(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in (1, 4, 32):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            results.append(_rows(spark, name))
        assert results[0] == results[1] == results[2]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_streaming_exact_dedup_equals_batch(spark):
    # S1 runs the landing folder in several micro-batches and restarts once
    assert _rows(spark, "S1_resumable_ingest") == _rows(spark, "D1_dedup_first")


def test_streaming_page_report_equals_batch(spark):
    from pyspark.sql import functions as F
    batch = sorted(map(tuple, Q._posts(spark, SF).groupBy("url").agg(F.count(F.lit(1)).cast("long")).collect()))
    assert sorted(map(tuple, Q.QUERIES["S3_incremental_page_report"](spark, SF).collect())) == batch
