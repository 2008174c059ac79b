from pathlib import Path

from tallyspark import schemas
from workbench.lake import lake_for
from workbench.views import RAW_TABLES

FOLDER = "/root/testdata/sf0.001"


def test_raw_files_are_gzipped_and_read_back_whole(spark):
    lake = lake_for(spark, FOLDER).ensure("raw")
    for name in RAW_TABLES:
        folder = Path(lake.path(schemas.TABLES[name].raw))
        parts = [p for p in folder.iterdir() if not p.name.startswith(("_", "."))]
        assert parts and all(p.name.endswith(".gz") for p in parts), name
    prices = lake.path(schemas.TABLES["prices"].raw)
    assert spark.read.json(prices).count() == lake.raw.table("prices").count()
