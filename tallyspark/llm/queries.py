"""The operators over the whole test tables, as queries, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import (
    bpe,
    ctw,
    dedup,
    filter_audit,
    line_dedup,
    ngram_join,
    packing,
    pii,
    quality,
    secret_scan,
    source_divergence,
    tokenfile,
    topk,
)
from tallyspark.llm.store import settle
from tallyspark.llm.text import remainder
from tallyspark.session import shared_folder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _told(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in the given order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _digested(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in kinds],
        F.sha2(_told(base), 256).alias("base_sha256"),
        _told(F.col("spans")).alias("spans"),
    )


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digested(pii.personal_data(documents(spark, sf_dir)), pii.KINDS)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(documents(spark, sf_dir))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digested(secret_scan.scan(documents(spark, sf_dir)), secret_scan.KINDS[:3])


QUALITY_THRESHOLD = 0.3


def quality_model(spark: SparkSession, sf_dir: str, table: DataFrame) -> quality.Additive:
    """Learned from the labelled rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = labels.filter(remainder("doc_id") != 0).select("doc_id", F.col("quality").alias("label"))
    return quality.train(table, known)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = settle(quality.feature_table(documents(spark, sf_dir)))
    scored = quality.score(table, quality_model(spark, sf_dir, table))
    return scored.select(
        "doc_id",
        (remainder("doc_id") == 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    decoded = bpe.decode(coded, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(documents(spark, sf_dir), remainder("doc_id") == 1)


def op7_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    tokenfile.write_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), path)
    tokens = tokenfile.read_tokens(spark, path)
    return tokens.select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantize(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return topk.top_k(vectors.filter("vec_id % 20 = 0"), vectors, 20)


def op9_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.exact_dedup(documents(spark, sf_dir))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(documents(spark, sf_dir))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = r"""
with v as (
  select cast(vec_id as bigint) as vec_id, list_transform(embedding, lambda x: floor(64 * cast(x as double))) as terms
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0
), scored as (
  select q.vec_id as query_id, d.vec_id as vec_id,
    cast(list_sum(list_transform(list_zip(q.terms, d.terms), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v d on q.vec_id % 20 = 0 and q.vec_id <> d.vec_id
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored
)
select query_id, cast(place as integer) as rank, vec_id, score from ranked where place <= 20
"""

OP9_SQL = r"""
with rows as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents
), groups as (
  select body, min(doc_id) as keep_id, count(*) as group_size from rows group by body
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
from rows join groups using (body)
"""

OP11_SQL = r"""
with recursive docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents
), failing as (
  select part,
    concat(
      case when len(words) < 100 then 'A' else '' end,
      case when 100 * len(list_distinct(words)) < 80 * len(words) then 'B' else '' end,
      case when 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) then 'C' else '' end,
      case when regexp_matches(body, '[#$%&*|]') then 'D' else '' end,
      case when doc_id > min(doc_id) over (partition by body) then 'E' else '' end) as letters,
    coalesce(doc_id in (select doc_id from labels where quality = 1 and doc_id is not null), false) as good,
    coalesce(doc_id in (select doc_id from labels where toxic = 1 and doc_id is not null), false) as toxic
  from docs
), sets as (
  select part, letters, good, toxic, count(*) as n from failing group by all
), orders as (
  select '' as filter_order
  union all
  select filter_order || letter from orders, (select unnest(['A', 'B', 'C', 'D', 'E']) as letter) as l
  where not contains(filter_order, letter)
), steps as (
  select filter_order, step, substring(filter_order, step, 1) as letter, substring(filter_order, 1, step - 1) as before
  from orders, (select unnest([1, 2, 3, 4, 5]) as step) as s where length(filter_order) = 5
), met as (
  select *, contains(letters, letter) as fails, translate(letters, before, '') <> letters as earlier from sets, steps
), audited as (
  select part, filter_order, step, letter,
    sum(case when not earlier and not fails then n else 0 end) as kept,
    sum(case when not earlier and fails then n else 0 end) as removed,
    sum(case when earlier and fails then n else 0 end) as redundant,
    sum(case when letters = letter then n else 0 end) as unique_fails,
    sum(case when not earlier and fails and good then n else 0 end) as good_lost,
    sum(case when not earlier and fails and toxic then n else 0 end) as toxic_lost
  from met group by all
)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept,
  cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
  cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
  cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from audited
"""

OP12_SQL = r"""
with docs as (
  select coalesce(lang, '') as lang, coalesce(source, '') as source,
    list_transform(
      regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
      lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as terms
  from documents
), kept as (
  select lang, term from (select lang, unnest(list_distinct(terms)) as term from docs) group by all having count(*) >= 10
), counts as (
  select lang, source, term, count(*) as n
  from (select lang, source, unnest(terms) as term from docs) join kept using (lang, term) group by all
), sizes as (
  select lang, count(*) as v from kept group by lang
), groups as (
  select lang, source, coalesce(v, 0)::hugeint as v,
    coalesce((select sum(n) from counts c where c.lang = g.lang and c.source = g.source), 0)::hugeint as total
  from (select distinct lang, source from docs) g left join sizes using (lang)
), shares as (
  select lang, source, term, coalesce(n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(n, 0) + 2)) // (total + 2 * v) as p
  from groups join kept using (lang) left join counts using (lang, source, term)
), lang_shares as (
  select lang, term, 1 + (1000000000::hugeint * (n + 2)) // (total + 2 * v) as q
  from (select lang, term, sum(n)::hugeint as n from counts group by all)
  join (select lang, sum(total) as total from groups group by lang) using (lang) join sizes using (lang)
), pairs as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), terms as (
  select lang, source, term as item, ((p - q) * (p - q)) // (p + q) as value
  from shares join lang_shares using (lang, term) where n > 0 and p > q
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
  union all
  select lang, source, 'term', item, value from terms
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as place from found
)
select lang, source, part, item, cast(value as bigint) as value, cast(place as integer) as rank
from ranked where part = 'pair' or place <= 10
"""

OP13_SQL = r"""
with docs as (
  select row_number() over () as row, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
), lines as (
  select row, doc_id, unnest(lines) as line, unnest(range(len(lines))) as place from docs
), keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), common as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3
), marked as (
  select k.*, c.keeper is not null and c.keeper is distinct from k.doc_id as goes
  from keyed k left join common c on c.key = k.key
)
select doc_id, count(*) as n_lines, count(*) filter (goes) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not goes), '')) as kept_sha256
from marked group by row, doc_id
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_ngram_join": op2_ngram_join,
    "op3_secrets": op3_secrets,
    "op4_quality": op4_quality,
    "op5_bpe": op5_bpe,
    "op6_ctw": op6_ctw,
    "op7_tokenfile": op7_tokenfile,
    "op8_topk": op8_topk,
    "op9_dedup": op9_dedup,
    "op10_packing": op10_packing,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_divergence": op12_source_divergence,
    "op13_line_dedup": op13_line_dedup,
}

ORACLES: dict[str, str] = {
    "op8_topk": OP8_SQL,
    "op9_dedup": OP9_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_line_dedup": OP13_SQL,
}
