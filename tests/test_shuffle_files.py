import re
import time

import pytest

from tallyspark.session import SHUFFLES_GO, shuffles_go
from tallyspark.sources import files


def shuffles(spark):
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(re.findall(r"shuffle_(\d+)_", held.mkString(" ")))


def left(spark, before):
    """Shuffles that still have files some seconds later."""
    for _ in range(20):
        if not shuffles(spark) - before:
            return set()
        time.sleep(0.5)
    return shuffles(spark) - before


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    df = spark.range(5000).selectExpr("id % 97 as k", "id as v").repartition(3, "k").groupBy("v").count()
    before = shuffles(spark)
    assert files.sink_parquet(df, str(tmp_path / "a")) == 5000
    assert left(spark, before) == set()
    assert files.sink_jsonl(df, str(tmp_path / "b"), ["v"]) == 5000
    assert left(spark, before) == set()
    assert files.stored(df).count() == 5000 and df.count() == 5000  # the frame can be read again


def test_the_setting_is_put_back(spark):
    before = spark.conf.get(SHUFFLES_GO, None)
    with pytest.raises(ValueError), shuffles_go(spark):
        assert spark.conf.get(SHUFFLES_GO) == "true"
        raise ValueError
    assert spark.conf.get(SHUFFLES_GO, None) == before
