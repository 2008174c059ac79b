"""Source divergence audit: how far the sources of a language differ, and by which terms.

1. Texts become arrays of terms (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased). A term carries its
   language behind a zero byte, so one ``CountVectorizer`` counts documents per language.
2. ``CountVectorizer`` with ``minDF`` and the greatest integer as ``vocabSize`` turns every document into exact
   sparse vectors, one for the terms that occur once in it, one for those that occur twice and so on, so that no term
   is read more than once a document and its rows are its documents. Its vocabulary goes through the driver, so where the corpus keeps more than ``SLICE_TERMS`` terms
   they are dealt by hash into slices of about that many, one model each; models are stored, and their
   vocabularies read back as tables.
3. The vectors are summed by group: each task adds up its documents' entries by source and place in the vocabulary,
   and Spark merges the tasks' sums.
4. Pairs: with a group's share of a term it doesn't hold as ``p0``, a pair's sum over all kept terms is

       sum over g's terms of f(p, p0 of h) + the same for h + (V - terms of g - terms of h) * f(p0 of g, p0 of h)
       + sum over shared terms of f(p, p') - f(p, p0 of h) - f(p0 of g, p') + f(p0 of g, p0 of h)

   so only terms that both hold are looked at by pair, and of the others only how often each share occurs. The
   sums are gathered inside the tasks; what leaves them is a row per pair of sources, which is the result's size.

All arithmetic is on integers: shares as decimals where longs don't do, sums of f as longs. The terms of one text
are told apart by 64-bit hashes, so two of its different terms count as one with a probability of some 2^-64 a pair.

Defined cases: null text, lang and source are empty strings; a lang whose terms are all too rare has pairs of value
0 and no terms; a source with no kept terms has the share of a count of 0 everywhere; a lang with one source has no
pairs; each row counts as a document, also where rows repeat an id (ids are not read); an empty table gives an empty
result; columns other than text, lang and source are not read, so their names cannot clash; bytes that are no UTF-8
stay in the terms as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.functions.frames import top_rows
from tallyspark.llm.store import settle
from tallyspark.llm.text import Block, as_bytes, in_blocks, mix, small_batches, span_hashes
from tallyspark.session import drop_folder, shared_folder

MIN_DOCUMENTS = 10
TOP_TERMS = 10
VOCABULARY = 2**31 - 1
# Kept terms that one model's vocabulary should hold; how many there are is estimated from one term in SAMPLED,
# of which all documents are counted.
SLICE_TERMS = 1 << 19
SAMPLED = 256
# Tasks that the documents' terms of one slice are dealt to before they are stored, where there are several slices.
SLICE_PARTS = 32
SCALE = 1_000_000_000
# Pairs of shares that numpy looks at in one step, and rows that a task gathers before it passes them on.
STEP = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' letters without what lies between, A-Z lower-cased; term begins and ends in them; first term of each row."""
    block = Block(texts)
    letter = _LETTER[block.data]
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    if letter[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[0::2], edge[1::2]
    ends = np.cumsum(end - begin)
    return _LOWER[block.data[letter]], ends - (end - begin), ends, np.searchsorted(begin, block.starts)


def _counted(texts: list[bytes], langs: pa.Array) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray, np.ndarray]:
    """The different terms of each text, by row and then by how often they occur.

    Each with a zero byte and its language behind it; a hash of both; its row; how often.
    """
    letters, begin, end, first = _spans(texts)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    lang = np.array([xxhash.xxh3_64_intdigest(t) for t in as_bytes(langs)], dtype=np.uint64)
    hashes = mix(span_hashes(letters, begin, end) + lang[row])
    key = mix(hashes + row.astype(np.uint64))
    order = np.argsort(key)
    edge = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
    times = np.diff(np.append(edge, len(order)))
    one = order[edge]  # an occurrence of each
    by_times = np.lexsort((times, row[one]))
    one, times = one[by_times], times[by_times]
    offsets = pa.py_buffer(np.concatenate([[0], end]).astype(np.int32))
    terms = pa.BinaryArray.from_buffers(pa.binary(), len(end), [None, offsets, pa.py_buffer(letters)])
    keyed = pc.binary_join_element_wise(
        terms.take(pa.array(one)), langs.cast(pa.binary()).take(pa.array(row[one])), b"\0"
    )
    return keyed, hashes[one], row[one], times


def _lists_of(values: pa.Array, row: np.ndarray, rows: int) -> pa.ListArray:
    """The values of each row as a list."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), values)


def _rows(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    return small_batches(docs).select(
        filled(lang).alias("lang"), filled(source).alias("source"), F.col(text).alias("text")
    )


def document_terms(rows: DataFrame) -> DataFrame:
    """``no, times, terms, sampled``: the terms of every whole text (lang, no, text) and the hashes of some of them.

    A text has a row for each number of ``times`` that some of its terms occur, so each of its terms stands once.
    A term is in ``sampled`` wherever it stands, or nowhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            terms, hashes, row, times = _counted(as_bytes(batch.column("text")), batch.column("lang"))
            new = (np.diff(row, prepend=-1) != 0) | (np.diff(times, prepend=0) != 0)
            first, part = np.flatnonzero(new), np.cumsum(new) - 1
            some = hashes % np.uint64(SAMPLED) == 0
            columns = [
                batch.column("no").take(pa.array(row[first])),
                pa.array(times[first].astype(np.int64)),
                _lists_of(terms.view(pa.string()), part, len(first)),
                _lists_of(pa.array(hashes[some].view(np.int64)), part[some], len(first)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["no", "times", "terms", "sampled"])

    found = "no int, times long, terms array<string>, sampled array<long>"
    return rows.select("lang", "no", "text").mapInArrow(run, found)


def slices_of(terms: DataFrame, min_documents: int, slice_terms: int) -> int:
    """How many slices the vocabulary takes, from the sampled terms that are kept."""
    documents = terms.select(F.explode("sampled").alias("hash")).groupBy("hash").count()
    kept = documents.filter(F.col("count") >= min_documents).count() * SAMPLED
    return max(1, -(-kept // slice_terms))


def deal_terms(terms: DataFrame, slices: int) -> DataFrame:
    """The terms of each text by slice, those of one slice as one text with blanks between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("terms")
            row = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy(zero_copy_only=False))
            words = column.flatten()
            found = words.dictionary_encode()
            number = np.array([xxhash.xxh3_64_intdigest(t) % slices for t in found.dictionary.to_pylist()], dtype=np.int64)
            at = number[found.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, dtype=np.int64)
            order = np.lexsort((at, row))
            row, at = row[order], at[order]
            first = np.flatnonzero(np.diff(row * slices + at, prepend=-1))
            lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)), words.take(pa.array(order)))
            columns = [batch.column(name).take(pa.array(row[first])) for name in ("no", "times")]
            columns = [pa.array(at[first].astype(np.int32)), *columns, pc.binary_join(lists, " ")]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "no", "times", "terms"])

    return terms.select("no", "times", "terms").mapInArrow(run, "slice int, no int, times long, terms string")


def sliced(terms: DataFrame, slices: int) -> Iterator[DataFrame]:
    """``no, times, terms`` of one slice after the other. Terms hold no blank, so they can be joined by blanks."""
    if slices == 1:
        yield terms.select("no", "times", "terms")
        return
    spark = terms.sparkSession
    path = shared_folder(spark)
    salt = F.spark_partition_id() % SLICE_PARTS
    dealt = deal_terms(terms, slices).withColumn("_salt", salt)
    dealt = dealt.repartition(slices * SLICE_PARTS, "slice", "_salt").drop("_salt")
    dealt.write.option("compression", "zstd").partitionBy("slice").parquet(path)
    stored = spark.read.schema("no int, times long, terms string, slice int").parquet(path)
    for at in range(slices):
        yield stored.filter(F.col("slice") == at).select("no", "times", F.split("terms", " ").alias("terms"))
    drop_folder(spark, path)


class _Sums:
    """Sums by key, merged whenever more than ``STEP`` have come together since the last time."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.keys, self.values, self.size = [], [], 0

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys.append(keys)
        self.values.append(values)
        self.size += len(keys)
        if self.size > STEP + 2 * len(self.keys[0]):
            self.merge()

    def merge(self) -> None:
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        values = np.zeros(len(keys), dtype=np.int64)
        np.add.at(values, place, np.concatenate(self.values))
        self.keys, self.values, self.size = [keys], [values], len(keys)


def vector_sums(vectors: DataFrame) -> DataFrame:
    """``place, no, n``: what the sparse vectors (no, times, indices, values) of each task add up to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums()

        def passed_on() -> Iterator[pa.RecordBatch]:
            if sums.keys:
                sums.merge()
                columns = [(sums.keys[0] >> 32).astype(np.int32), (sums.keys[0] & 0xFFFFFFFF).astype(np.int32), sums.values[0]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["place", "no", "n"])
            sums.clear()

        for batch in batches:
            indices = batch.column("indices")
            size = indices.value_lengths().to_numpy(zero_copy_only=False)
            no, times = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64), size) for c in ("no", "times"))
            place = indices.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sums.add(place << 32 | no, times * batch.column("values").flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            if sums.size > 4 * STEP:
                yield from passed_on()
        yield from passed_on()

    return vectors.mapInArrow(run, "place int, no int, n long")


def slice_sums(terms: DataFrame, min_documents: int) -> DataFrame:
    """``lang, term, held, n`` of one slice: how often its kept terms occur, by source and in all."""
    spark = terms.sparkSession
    # A term of no text stands in enough rows of its own: a vocabulary must not be empty.
    blank = spark.range(min_documents).select(F.array(F.lit("")).alias("terms"))
    counter = CountVectorizer(inputCol="terms", outputCol="vector", minDF=min_documents, vocabSize=VOCABULARY)
    model = counter.fit(terms.select("terms").unionAll(blank))
    path = shared_folder(spark)
    model.write().save(path)
    words = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("place", "word")).filter("word <> ''")
    entries = F.unwrap_udt("vector")
    vectors = model.transform(terms).select("no", "times", entries["indices"].alias("indices"), entries["values"].alias("values"))
    held = (
        vector_sums(vectors)
        .repartition("place")  # a term's rows are at most one per source and task
        .groupBy("place", "no")
        .agg(F.sum("n").alias("n"))
        .groupBy("place")
        .agg(F.sort_array(F.collect_list(F.struct("no", "n"))).alias("held"), F.sum("n").alias("n"))
    )
    word = F.split("word", "\0", 2)
    return held.join(words, "place").select(word[1].alias("lang"), word[0].alias("term"), "held", "n")


def group_sums(terms: DataFrame, min_documents: int, slice_terms: int) -> DataFrame:
    """``lang, term, held, n`` of all kept terms, a stored table."""
    spark = terms.sparkSession
    path = shared_folder(spark)
    for part in sliced(terms, slices_of(terms, min_documents, slice_terms)):
        slice_sums(part, min_documents).write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema("lang string, term string, held array<struct<no:int,n:bigint>>, n long").parquet(path)


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)); decimals where longs could overflow."""
    below = total + 2 * terms
    exact = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)"), below.cast("decimal(20,0)"))
    return 1 + F.when(n < 9_000_000_000, F.call_function("div", SCALE * (n + 2), below)).otherwise(exact)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))"""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


PAIR = "lang string, a int, b int, value long"
PAIR_ARROW = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])


def _both_ways(lang: str, a: np.ndarray, b: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([lang] * (2 * len(a)), pa.string())]
    columns += [pa.array(np.concatenate(ends).astype(np.int32)) for ends in ((a, b), (b, a))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate([value, value]))], schema=PAIR_ARROW)


def _shared(sums: _Sums, offsets: np.ndarray, no: np.ndarray, p: np.ndarray, rest: np.ndarray) -> None:
    """Add what the terms' shared parts differ from, for each pair of their sources."""
    sizes = np.diff(offsets)
    for size in np.unique(sizes[sizes > 1]).tolist():
        rows = offsets[:-1][sizes == size]
        for at in range(0, len(rows), max(1, STEP // size)):
            block = rows[at : at + max(1, STEP // size), None] + np.arange(size)
            source, own, none = no[block].astype(np.int64), p[block], rest[block]
            for step in range(1, size):
                a, b = slice(None, -step), slice(step, None)
                more = _gap(own[:, a], own[:, b]) - _gap(own[:, a], none[:, b])
                more += _gap(none[:, a], none[:, b]) - _gap(none[:, a], own[:, b])
                sums.add((source[:, a] << 32 | source[:, b]).ravel(), more.ravel())


def _lists(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and fields of a column of struct lists."""
    flat = column.flatten()
    offsets = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    return offsets, {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}


def shared_parts(terms: DataFrame) -> DataFrame:
    """Sums over the terms that two sources share, gathered in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: dict[str, _Sums] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for lang, sums in gathered.items():
                if sums.keys:
                    sums.merge()
                    yield _both_ways(lang, sums.keys[0] >> 32, sums.keys[0] & 0xFFFFFFFF, sums.values[0])
            gathered.clear()

        for batch in batches:
            lang = batch.column("lang").dictionary_encode()
            code = lang.indices.to_numpy(zero_copy_only=False)
            for at, name in enumerate(lang.dictionary.to_pylist()):
                offsets, field = _lists(batch.column("shares").take(pa.array(np.flatnonzero(code == at))))
                _shared(gathered.setdefault(name, _Sums()), offsets, field["no"], field["p"], field["rest"])
            if sum(sums.size for sums in gathered.values()) > 2 * STEP:
                yield from passed_on()
        yield from passed_on()

    return terms.select("lang", "shares").mapInArrow(run, PAIR)


def own_parts(groups: DataFrame) -> DataFrame:
    """For each group and other source: its own terms against their absence there, and the terms of neither."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            often, own = _lists(batch.column("often"))
            ends, all_ = _lists(batch.column("sources"))
            for i, (lang, no, terms) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("lang", "no", "terms")))):
                rest, held = (all_[name][ends[i] : ends[i + 1]] for name in ("rest", "held"))
                p, times = (own[name][often[i] : often[i + 1]] for name in ("p", "times"))
                found = np.zeros(len(rest), dtype=np.int64)
                for at in range(0, len(p), max(1, STEP // len(rest))):
                    some = slice(at, at + max(1, STEP // len(rest)))
                    found += (_gap(p[some, None], rest[None, :]) * times[some, None]).sum(axis=0)
                others = np.flatnonzero(np.arange(len(rest)) != no)
                me = np.full(len(others), no)
                yield _both_ways(lang, me, others, found[others])
                if terms:
                    neither = (terms - held[no] - held[others]) * _gap(rest[no], rest[others])
                    columns = [pa.array([lang] * len(others), pa.string()), pa.array(me.astype(np.int32))]
                    columns += [pa.array(others.astype(np.int32)), pa.array(neither)]
                    yield pa.RecordBatch.from_arrays(columns, schema=PAIR_ARROW)

    return groups.select("lang", "no", "terms", "often", "sources").mapInArrow(run, PAIR)


def divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    slice_terms: int = SLICE_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources by distance, and the terms a source is rich in."""
    rows = _rows(docs, text, lang, source)
    in_lang = Window.partitionBy("lang").orderBy("source")
    named = settle(
        rows.select("lang", "source").distinct().withColumn("no", F.row_number().over(in_lang) - 1)
    )
    texts = rows.join(named, ["lang", "source"])
    terms = group_sums(settle(document_terms(texts)), min_documents, slice_terms)
    # One row per lang: how many terms and occurrences, and those of its sources in order.
    each = (
        terms.select("lang", F.explode("held").alias("of"))
        .groupBy("lang", "of.no")
        .agg(F.sum("of.n").alias("total"), F.count(F.lit(1)).alias("held"))
    )
    sizes = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("total"))
    count = {name: F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("terms", "total", "held")}
    sources = (
        named.join(each, ["lang", "no"], "left")
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("no", count["total"], count["held"]))).alias("_sources"))
    )
    rest = F.transform(
        "_sources",
        lambda s: F.struct(
            s["total"].alias("total"),
            s["held"].alias("held"),
            F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), s["total"], F.col("terms"))).otherwise(1).alias("rest"),
        ),
    )
    langs = settle(
        sources.join(sizes, "lang", "left")
        .select("lang", "_sources", count["terms"], count["total"])
        .select("lang", "terms", "total", rest.alias("sources"))
    )
    of = F.transform(
        "held",
        lambda h: F.struct(
            h["no"].alias("no"),
            share(h["n"], F.get("sources", h["no"])["total"], F.col("terms")).alias("p"),
            F.get("sources", h["no"])["rest"].alias("rest"),
        ),
    )
    shares = terms.join(langs, "lang").select(
        "lang", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("q"), of.alias("shares")
    )
    held = shares.select("lang", "term", "q", F.explode("shares").alias("of")).select("lang", "term", "q", "of.no", "of.p")
    rich = held.filter("p > q").select("lang", "no", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    best = top_rows(rich, ["lang", "no"], [F.col("value").desc(), F.col("item")], top_terms, "rank")
    often = (
        held.groupBy("lang", "no", "p")
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("lang", "no")
        .agg(F.collect_list(F.struct("p", "times")).alias("often"))
    )
    none = F.array().cast("array<struct<p:bigint,times:bigint>>")
    groups = (
        named.join(often, ["lang", "no"], "left")
        .join(langs, "lang")
        .select("lang", "no", "terms", "sources", F.coalesce("often", none).alias("often"))
    )
    pairs = own_parts(groups).unionAll(shared_parts(shares)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    other = named.select("lang", F.col("no").alias("b"), F.col("source").alias("item"))
    far = Window.partitionBy("lang", "no").orderBy(F.col("value").desc(), "item")
    ranked = (
        pairs.join(other, ["lang", "b"])
        .select("lang", F.col("a").alias("no"), "item", "value")
        .withColumn("rank", F.row_number().over(far))
    )
    result = ["lang", "no", "item", "value", "rank"]
    found = ranked.select(F.lit("pair").alias("part"), *result).unionByName(best.select(F.lit("term").alias("part"), *result))
    return found.join(named, ["lang", "no"]).select("lang", "source", "part", "item", "value", "rank")
