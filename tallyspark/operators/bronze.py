"""Bronze: the raw record as it came, plus where and when it came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.schemas import CORRUPT_RECORD

NOT_JSON = "NOT_JSON"
NOT_A_RECORD = "NOT_A_RECORD"
OTHER_TYPE = "VALUE_OF_ANOTHER_TYPE"

# Names of the metadata columns.
BRONZE_METADATA = ("_ingested_at", "_source_file", "_bronze_load_id", "_raw_record_hash")


def raw_record_hash(df: DataFrame) -> DataFrame:
    """Digest of the record's own columns as JSON; a null equals an absent field."""
    own = [name for name in df.columns if name not in BRONZE_METADATA]
    return df.withColumn("_raw_record_hash", F.sha2(F.to_json(F.struct(*own)), 256))


def broken_reason() -> Column:
    """Why a line does not fit its schema; null for a line that does.

    Text that is no JSON, JSON that is no record, or a record with a value of
    another type. The last keeps its row, that value being null.
    """
    line = F.col(CORRUPT_RECORD)
    parsed = F.try_parse_json(line)
    kind = F.when(parsed.isNull(), F.lit(NOT_JSON)).when(
        F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(OTHER_TYPE)
    )
    return F.when(line.isNotNull(), kind.otherwise(F.lit(NOT_A_RECORD)))


def is_no_record() -> Column:
    """Lines that leave the dataset for the quarantine."""
    return F.coalesce(broken_reason().isin(NOT_JSON, NOT_A_RECORD), F.lit(False))


def quarantine(dataset: str, stamped: DataFrame) -> DataFrame:
    """The lines that do not fit the dataset's schema: where they stand, the text and why.

    ``stamped`` are all rows with their load metadata, broken ones included.
    """
    return stamped.filter(F.col(CORRUPT_RECORD).isNotNull()).select(
        F.lit(dataset).alias("dataset"),
        F.col(CORRUPT_RECORD).alias("line"),
        broken_reason().alias("reason"),
        # Also because Spark refuses to read broken lines from a scan of nothing else.
        "_raw_record_hash",
        "_source_file",
        "_bronze_load_id",
    )


def bronze_metadata(raw: DataFrame, load_id: str, source_file: F.Column | None = None) -> DataFrame:
    """Append load metadata. ``source_file`` defaults to the scanned file's path."""
    path = F.col("_metadata.file_path") if source_file is None else source_file
    stamped = raw.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_file": path,
            "_bronze_load_id": F.lit(load_id),
        }
    )
    return raw_record_hash(stamped)
