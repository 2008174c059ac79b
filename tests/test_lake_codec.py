from pathlib import Path

import pyarrow.parquet as pq

from tallyspark.sources import files


def test_stored_tables_are_zstd_and_read_back_whole(spark, tmp_path):
    rows = [(i, f"text {i % 7}", None if i % 5 else 1.5) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, value double")
    path = str(tmp_path / "table")
    assert files.sink_parquet(df, path) == 200
    parts = sorted(Path(path).glob("*.parquet"))
    assert parts
    for part in parts:
        meta = pq.ParquetFile(part).metadata
        codecs = {meta.row_group(g).column(c).compression for g in range(meta.num_row_groups) for c in range(meta.num_columns)}
        assert codecs == {"ZSTD"}
    assert sorted(files.scan_parquet(spark, path).collect()) == sorted(df.collect())
