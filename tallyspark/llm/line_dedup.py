"""Line dedup: lines whose key stands in many documents go, except in one document.

1. Every text is split at ``\\n`` and its lines are exploded with their place. A line's key is the line
   without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased; keys shorter than ``min_length`` code points
   are never dropped and leave here. Of a key only two 64-bit hashes of different seeds go on.
2. Distinct documents are counted per hash in two levels: first one row per hash and document, then one per hash.
   Both merge inside the tasks first, so a hash of a third of all lines is a few rows by the time it is shuffled.
3. Hashes of at least ``min_documents`` documents meet their lines again. Hashes that stand in more than one of
   ``HOT`` lines are at most ``HOT`` many, whatever the data, and are broadcast; the others are joined by a
   shuffle in which no hash has more than that share.
4. The places to drop are gathered per text, and the lines at the other places are joined in their order.

Keys are told apart by 128 bits, so two different keys are taken for equal with a probability of some 2^-128.

Defined cases: a null text is empty; an empty text is one empty line; a line of blanks only has an empty key; a
null id counts as no document and never keeps a dropped key (its lines go where the key goes); rows that repeat
an id are one document for the counts and each is returned with its own text; an empty table gives an empty
result; other columns are not read, so their names cannot clash; bytes that are no UTF-8 stay as Spark's string
functions leave them.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.store import settle

MIN_LENGTH = 20
MIN_DOCUMENTS = 3
# A hash with more than one in HOT of all lines counts as hot; there are fewer than HOT of those.
HOT = 10_000
BLANKS = " \t\n\x0b\x0c\r"
HASH = ["_hash", "_hash2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _rows(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    """Id, whole text, and a hash of the text that tells rows of one id apart."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_column).alias("doc_id"), body.alias("_body"), F.xxhash64(body).alias("_row"))


def line_hashes(rows: DataFrame, min_length: int) -> DataFrame:
    """One row per line whose key is long enough: ``doc_id, _row, _place`` and the hashes of the key."""
    lines = rows.select("doc_id", "_row", F.posexplode(F.split("_body", "\n")).alias("_place", "_line"))
    keys = lines.select("doc_id", "_row", "_place", line_key(F.col("_line")).alias("_key"))
    return keys.filter(F.char_length("_key") >= min_length).select(
        "doc_id", "_row", "_place", F.xxhash64("_key").alias("_hash"), F.xxhash64(F.lit(1), "_key").alias("_hash2")
    )


def common_lines(lines: DataFrame, min_documents: int) -> DataFrame:
    """Hashes that stand in enough documents: how many, how many lines, and the document that keeps them."""
    each = lines.filter("doc_id is not null").groupBy(*HASH, "doc_id").agg(F.count(F.lit(1)).alias("_lines"))
    return (
        each.groupBy(*HASH)
        .agg(
            F.count(F.lit(1)).alias("_documents"),
            F.sum("_lines").alias("_lines"),
            F.max("doc_id").alias("_keeper"),
        )
        .filter(F.col("_documents") >= min_documents)
    )


def dropped_places(lines: DataFrame, common: DataFrame) -> DataFrame:
    """The places to drop of every text that loses a line. Both tables are stored ones."""
    bound = lines.count() / HOT
    goes = ~F.col("doc_id").eqNullSafe(F.col("_keeper"))
    hot = F.broadcast(common.filter(F.col("_lines") > bound).select(*HASH, "_keeper"))
    cold = common.filter(F.col("_lines") <= bound).select(*HASH, "_keeper")
    found = lines.join(hot, HASH).unionByName(lines.join(hot, HASH, "left_anti").join(cold, HASH))
    # A set, as rows that repeat id and text have the same places.
    return found.filter(goes).groupBy("doc_id", "_row").agg(F.collect_set("_place").alias("_dropped"))


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    min_length: int = MIN_LENGTH,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Every row with the lines it keeps: ``doc_id, text, n_lines, n_dropped``."""
    rows = _rows(docs, text, id_column)
    lines = settle(line_hashes(rows, min_length))
    common = settle(common_lines(lines, min_documents))
    dropped = dropped_places(lines, common).select(F.col("doc_id").alias("_id"), F.col("_row").alias("_text"), "_dropped")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_text"))
    split = rows.join(dropped, same, "left").select("doc_id", "_body", "_dropped", F.split("_body", "\n").alias("_lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_dropped"))
    kept = F.array_join(F.transform(places, lambda place: F.get("_lines", place)), "\n")
    return split.select(
        "doc_id",
        F.when(F.col("_dropped").isNull(), F.col("_body")).otherwise(kept).alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
