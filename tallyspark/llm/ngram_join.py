"""Exact self-join of documents by the Jaccard similarity of their word shingles.

Sets are cut by size into bands. In a band two similar sets differ in at most H tokens, so when
tokens are hashed into enough segments of the universe, some segment of theirs is equal (or differs
in one token). Each set publishes signatures of its segments in its own band and in the band below,
where smaller partners stand. How many segments, and whether a signature is that of the segment
alone or also of its one-deletion neighbours, is chosen for each band by expected cost.

Segments that tell nothing (empty ones) are not published. A set that has too many of them for the
pigeonhole goes to a further level, hashed anew; a pair can be missed on a level only when both of
its sets go on, so nothing is lost. Equal sets are one class and are published once for each task.

Within a bucket of equal signatures the members are first compared with the least one and with the
one before; whatever is then connected needs no further comparison. Members of large buckets that
stay apart leave those buckets if their remaining segments suffice, and the rest are compared with
some members at a time, twice as many in each round, until every bucket is connected or compared. Comparison is exact on the
whole sets (of 64-bit shingle hashes).

Defined cases: null and empty texts, and texts without words, have no shingles and are linked with
nothing; texts shorter than a shingle are one shingle; rows with a null id are linked with nothing
and have no component; rows that share an id are one node; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.graph import components
from tallyspark.llm.store import settle
from tallyspark.llm.text import Block, as_bytes, in_blocks, mix, shingle_hashes, texts

# Similarity in per cent; the bands below follow from it.
SIMILARITY = 80
# Re-hashings of sets whose segments do not suffice; who needs still more meets in one bucket a band.
LEVELS = 16
# Members of a bucket that meet at once; larger buckets are cut into such blocks.
MEET = 1024
# Bits of a sketch, about one for each token.
SKETCH_BITS = (64, 1024)
# Buckets of more members are left by whoever can do without them.
LARGE = 64
# Bits of the id filter in front of the second scan (8 MB whatever the data).
FILTER_BITS = 26

DESCRIBED = "doc_id long, n long, d1 long, d2 long, band int, spare long, spare_below long, sketch binary"


@lru_cache(maxsize=None)
def bands(top: int = 1 << 40) -> tuple[np.ndarray, ...]:
    """Least size of each band; a partner stands in the same band or the next."""
    starts = [1]
    while starts[-1] < top:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 100 // SIMILARITY)))
    return (np.array(starts, dtype=np.int64),)


def differences(highest: int) -> int:
    """Tokens in which a set of at most ``highest`` and a similar, not smaller one can differ."""
    both = highest + highest * 100 // SIMILARITY
    return both * (100 - SIMILARITY) // (100 + SIMILARITY)


@lru_cache(maxsize=None)
def allocation(band: int) -> tuple[int, int, int]:
    """(segments, spare segments, deletions 0 or 1) of the least expected cost; no segments where only equal sets match."""
    starts = bands()[0]
    low, high = int(starts[band]), int(starts[band + 1]) - 1
    most = differences(high)
    if not most:
        return 0, 0, 0
    best = (math.inf, 0, 0, 0)
    for deletions in (0, 1):
        need = most + 1 if not deletions else most // 2 + 1
        for spare in sorted({*range(9), *(need * k // 16 for k in range(1, 9))}):
            m = need + spare
            empty = (1 - 1 / m) ** low if m > 1 else 0.0
            useless = empty if not deletions else empty + low / m * ((1 - 1 / m) ** (low - 1) if m > 1 else 0.0)
            useless = min(useless, 1.0)
            spread = math.sqrt(max(m * useless * (1 - useless), 1e-9))
            over = 0.5 * math.erfc((spare + 0.5 - m * useless) / spread / math.sqrt(2))
            if over > 0.5:
                continue
            rows = m * (1 - empty) + deletions * high
            cost = rows * (1 + 4 * math.exp(-low / m)) / (1 - over)
            best = min(best, (cost, m, spare, deletions))
    _, m, spare, deletions = best
    return (m, spare, deletions) if m else (most // 2 + 1, 0, 1)


@lru_cache(maxsize=256)
def _edges(segments: int) -> np.ndarray:
    """First hash of each segment but the first."""
    return np.array([-(-(j << 64) // segments) for j in range(1, segments)], dtype=np.uint64)


@lru_cache(maxsize=256)
def _salts(segments: int, band: int, level: int) -> np.ndarray:
    return mix(np.arange(segments, dtype=np.uint64) + np.uint64((band << 40) + (level << 32)))


def _segments(tokens: np.ndarray, band: int, level: int) -> tuple[np.ndarray, int]:
    """Signatures of sorted distinct tokens in a band on a level, and the spare segments left (below 0: go on)."""
    m, spare, deletions = allocation(band)
    if level:
        tokens = np.sort(mix(tokens + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
    cut = np.concatenate([[0], np.searchsorted(tokens, _edges(m)), [len(tokens)]])
    total = np.zeros(len(tokens) + 1, dtype=np.uint64)
    np.cumsum(tokens, out=total[1:])  # tokens are hashes, so a sum tells a set
    sums, size = total[cut[1:]] - total[cut[:-1]], np.diff(cut)
    salt = _salts(m, band, level)
    used = size > 0
    signatures = mix(sums[used] ^ salt[used])
    if deletions:
        segment = np.repeat(np.arange(m), size)
        many = size[segment] > 1
        signatures = np.append(signatures, mix((sums[segment[many]] - tokens[many]) ^ salt[segment[many]]))
    useless = np.count_nonzero(size <= deletions)
    return signatures, spare - int(useless)


def _published(tokens: np.ndarray, band: int) -> tuple[np.ndarray, int]:
    """All signatures in a band over the levels, their low bit that of the band, and what level 0 spares."""
    if not allocation(band)[0]:
        return tokens[:0], 0
    parts, spare = [], []
    for level in range(LEVELS):
        found, left = _segments(tokens, band, level)
        parts.append(found)
        spare.append(left)
        if left >= 0:
            break
    else:
        parts.append(mix(np.array([(band << 40) + (LEVELS << 32)], dtype=np.uint64)))
    signatures = np.concatenate(parts)
    signatures = (signatures & np.uint64((1 << 64) - 2)) | np.uint64(band & 1)
    return signatures, spare[0]


def _own_band(size: int) -> int:
    return int(np.searchsorted(bands()[0], size, side="right")) - 1


def _has_below(size: int, band: int) -> bool:
    """Can a partner of a set of that size stand in the band below?"""
    return band > 0 and -(-size * SIMILARITY // 100) < int(bands()[0][band])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _digest(tokens: np.ndarray) -> tuple[int, int]:
    pair = np.array([tokens.sum(dtype=np.uint64), np.bitwise_xor.reduce(tokens, initial=np.uint64(0))])
    a, b = _signed(pair).tolist()
    return a, b


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens that fall on each bit; halves folded together give the sketch of half the bits."""
    bits = min(max(1 << max(0, len(tokens) - 1).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    place = (tokens & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=bits) & 1, bitorder="little").tobytes()


def _sketches(raw: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the shortest."""
    width = min(map(len, raw))
    out = np.zeros((len(raw), width), dtype=np.uint8)
    for i, one in enumerate(raw):
        while len(one) > width:
            half = len(one) // 2
            one = (np.frombuffer(one, dtype=np.uint8)[:half] ^ np.frombuffer(one, dtype=np.uint8)[half:]).tobytes()
        out[i] = np.frombuffer(one, dtype=np.uint8)
    return out.view(np.uint64)


def _within(differ: np.ndarray, size: np.ndarray) -> np.ndarray:
    """May sets of that size together be similar when they differ in so many tokens at least?"""
    return differ * (100 + SIMILARITY) <= size * (100 - SIMILARITY)


def describe(docs: DataFrame) -> DataFrame:
    """Per row: size and digest of its set, its band, and the segments it can spare there and below."""

    def run(batches):
        for batch in in_blocks(batches):
            rows = []
            for tokens in shingle_hashes(Block(as_bytes(batch.column("text")))):
                n = len(tokens)
                band = _own_band(n) if n else -1
                rows.append((n, *_digest(tokens), band, *((0, 0) if not n else _spares(tokens, band)), sketch(tokens)))
            columns = [batch.column("doc_id")]
            kinds = (*[pa.int64()] * 3, pa.int32(), *[pa.int64()] * 2, pa.binary())
            columns += [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in DESCRIBED.split(", ")])

    def _spares(tokens, band):
        out = []
        for b, wanted in ((band, True), (band - 1, _has_below(len(tokens), band))):
            known = wanted and allocation(b)[0]
            out.append(_spare(tokens, b) if known else 0)
        return out

    return texts(docs).mapInArrow(run, DESCRIBED)


def _spare(tokens: np.ndarray, band: int) -> int:
    m, spare, deletions = allocation(band)
    cut = np.concatenate([[0], np.searchsorted(tokens, _edges(m)), [len(tokens)]])
    return spare - int(np.count_nonzero(np.diff(cut) <= deletions))


def publish(docs: DataFrame) -> DataFrame:
    """``sig, doc_id``: the signatures of every set; a task publishes equal sets once."""

    def run(batches):
        seen = set()
        for batch in in_blocks(batches):
            parts, owners = [np.zeros(0, dtype=np.uint64)], []
            ids = batch.column("doc_id").to_pylist()
            for doc_id, tokens in zip(ids, shingle_hashes(Block(as_bytes(batch.column("text"))))):
                n = len(tokens)
                if not n or doc_id is None:
                    continue
                digest = _digest(tokens)
                if digest in seen:
                    continue
                seen.add(digest)
                band = _own_band(n)
                for b in (band, band - 1) if _has_below(n, band) else (band,):
                    parts.append(_published(tokens, b)[0])
                    owners.append((doc_id, len(parts[-1])))
            owner = np.repeat(np.array([o for o, _ in owners], dtype=np.int64), [c for _, c in owners])
            columns = [pa.array(_signed(np.concatenate(parts))), pa.array(owner)]
            yield pa.RecordBatch.from_arrays(columns, names=["sig", "doc_id"])

    return texts(docs).mapInArrow(run, "sig long, doc_id long")


def _shared(rows: DataFrame, member: str) -> DataFrame:
    """Rows whose signature has another row."""
    bucket = Window.partitionBy("sig").orderBy(member)
    beside = rows.withColumn("_before", F.lag(member).over(bucket)).withColumn("_after", F.lead(member).over(bucket))
    return beside.filter("_before is not null or _after is not null").drop("_before", "_after")


def _id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A bit for the hash of every id, of fixed size: whatever the number of ids, none is missed."""
    place = F.xxhash64(F.col(column)).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bits = (
        ids.select(place.alias("place"))
        .groupBy(F.shiftright("place", 15).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(32767))).alias("bits"))
    )
    out = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for row in bits.toLocalIterator():
        out[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``class_id, body`` (compressed text) of the wanted ids, and of few others, which no pair names."""
    shared = docs.sparkSession.sparkContext.broadcast(_id_filter(ids, "class_id"))

    def run(batches):
        bits = shared.value
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            place = batch.column("place").to_numpy(zero_copy_only=False)
            wanted = batch.filter(pa.array((bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)))
            for part in in_blocks(iter([wanted])):
                bodies = [pack(t) for t in as_bytes(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(bodies, pa.binary())], names=["class_id", "body"]
                )

    place = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    return texts(docs).filter("doc_id is not null").withColumn("place", place).mapInArrow(run, "class_id long, body binary")


def _plausible(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sketches do not tell apart."""

    def side(name: str) -> DataFrame:
        return own.select(F.col("class_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}"))

    def run(batches):
        for batch in batches:
            left, right = batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist()
            size = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
            width = np.array([min(len(x), len(y)) for x, y in zip(left, right)], dtype=np.int64)
            good = np.zeros(len(left), dtype=bool)
            for w in np.unique(width):
                rows = np.flatnonzero(width == w).tolist()
                both = _sketches([left[i] for i in rows] + [right[i] for i in rows])
                differ = np.bitwise_count(both[: len(rows)] ^ both[len(rows) :]).sum(axis=1, dtype=np.int64)
                good[rows] = _within(differ, size[rows])
            chosen = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], names=["a", "b"])

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")
    return joined.mapInArrow(run, "a long, b long")


def _across(apart: DataFrame) -> DataFrame:
    """Pairs of a bucket's members in different components that their sketches do not tell apart.

    A bucket meets in blocks of at most ``MEET`` members, any two of them in a group of their own.
    """
    bucket = Window.partitionBy("sig")
    rows = (
        apart.withColumn("block", F.floor((F.row_number().over(bucket.orderBy("class_id")) - 1) / MEET).cast("int"))
        .withColumn("blocks", F.max("block").over(bucket))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks"))))
        .select("sig", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "class_id", "component", "n", "sketch")
    )

    def meet(group: list[tuple]) -> tuple[list[int], list[int]]:
        block, ids, component, n = (np.array(column) for column in list(zip(*group))[:4])
        words = _sketches([row[4] for row in group])
        found_a, found_b = [], []
        split = int(np.searchsorted(block, block[-1])) if block[0] != block[-1] else 0
        for i in range(split or len(ids)):
            first = split or i + 1
            differ = np.bitwise_count(words[first:] ^ words[i]).sum(axis=1, dtype=np.int64)
            good = _within(differ, n[first:] + n[i]) & (component[first:] != component[i]) & (ids[first:] != ids[i])
            others = ids[first:][good].tolist()
            found_a += [int(ids[i])] * len(others)
            found_b += others
        return found_a, found_b

    def run(batches):
        key, group = None, []

        def done():
            a, b = meet(group)
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            return pa.RecordBatch.from_arrays([pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row in zip(*columns):
                if row[:3] != key:
                    if len(group) > 1:
                        yield done()
                    key, group = row[:3], []
                group.append(row[3:])
        if len(group) > 1:
            yield done()

    dealt = rows.repartition("sig", "lo", "hi").sortWithinPartitions("sig", "lo", "hi", "block", "class_id")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _compared(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The similar ones of the pairs, by their whole texts."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("class_id"))
    return settle(_linked(pairs, settle(_texts_of(docs, ids))))


def _linked(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    b_side = pairs.join(bodies.select(F.col("class_id").alias("b"), F.col("body").alias("body_b")), "b")
    both = b_side.join(bodies.select(F.col("class_id").alias("a"), F.col("body").alias("body_a")), "a")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        kept: tuple = (None, None)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                left, right = part.column("body_a").to_pylist(), part.column("body_b").to_pylist()
                fresh = [i for i in range(len(left)) if i == 0 or left[i] != left[i - 1]]
                sets = shingle_hashes(Block([unpack(t) for t in [left[i] for i in fresh] + right]))
                which = np.cumsum([i == 0 or left[i] != left[i - 1] for i in range(len(left))]) - 1
                good = []
                for i in range(len(left)):
                    x, y = sets[which[i]], sets[len(fresh) + i]
                    good.append(similar(x, y))
                mask = pa.array(good, pa.bool_())
                chosen = part.filter(mask)
                yield pa.RecordBatch.from_arrays([chosen.column("a"), chosen.column("b")], names=["a", "b"])

    return both.select("a", "b", "body_a", "body_b").sortWithinPartitions("a").mapInArrow(run, "a long, b long")


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Exact test on sorted distinct tokens."""
    if not len(x) or not len(y) or min(len(x), len(y)) * 100 < max(len(x), len(y)) * SIMILARITY:
        return False
    both = np.sort(np.concatenate([x, y]))
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= SIMILARITY * (len(x) + len(y) - common)


def _classes(described: DataFrame) -> DataFrame:
    """Described rows with words, with the least id of their class of equal sets."""
    known = described.filter("n > 0 and doc_id is not null")
    keys = ["n", "d1", "d2"]
    least = known.groupBy(*keys).agg(F.min("doc_id").alias("class_id"))
    return known.join(least, keys)


def _apart(members: DataFrame, component: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with what tells them apart.

    Buckets of up to three members have been compared whole. Members leave large buckets when they
    have a segment outside them for every partner.
    """
    own = classes.filter("doc_id = class_id").select("class_id", "n", "sketch", "band", "spare", "spare_below")
    known = component.withColumnRenamed("node", "class_id")
    bucket, held = Window.partitionBy("sig"), Window.partitionBy("class_id", "_own")
    in_own = F.col("sig").bitwiseAND(F.lit(1)) == F.col("band").bitwiseAND(F.lit(1)).cast("long")
    told = (
        members.join(known, "class_id", "left")
        .join(own, "class_id")
        .withColumn("component", F.coalesce("component", "class_id"))
        .withColumns(
            {
                "_size": F.count(F.lit(1)).over(bucket),
                "_lo": F.min("component").over(bucket),
                "_hi": F.max("component").over(bucket),
            }
        )
        .filter("_size > 3 and _lo < _hi")
        .withColumn("_own", in_own)
        .withColumn("_spare", F.when(F.col("_own"), F.col("spare")).otherwise(F.col("spare_below")))
        .withColumn("_large", (F.col("_size") > LARGE).cast("int"))
    )
    stays = told.withColumn("_held", F.sum("_large").over(held)).filter("_large = 0 or _held > _spare")
    return stays.select("sig", "class_id", "component", "n", "sketch")


def linked_classes(docs: DataFrame, described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of equal sets, and the component of every class that is linked with another."""
    classes = settle(_classes(described))
    held = settle(_shared(publish(docs), "doc_id"))
    mapped = held.join(classes.select("doc_id", "class_id"), "doc_id").select("sig", "class_id").repartition("sig").distinct()
    members = settle(_shared(mapped, "class_id"))
    bucket = Window.partitionBy("sig").orderBy("class_id").rowsBetween(Window.unboundedPreceding, 0)
    near = members.withColumn("first", F.first("class_id").over(bucket)).withColumn(
        "before", F.lag("class_id").over(Window.partitionBy("sig").orderBy("class_id"))
    )
    pairs = near.filter("before is not null").select(
        F.explode(F.array_distinct(F.array("first", "before"))).alias("a"), F.col("class_id").alias("b")
    )
    own = classes.filter("doc_id = class_id").select("class_id", "n", "sketch")
    tested = settle(_plausible(pairs.filter("a < b").repartition("a").distinct(), own))
    # Rows that share an id are one node.
    one_id = classes.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("_hi")).filter("a < _hi")
    same = classes.join(one_id.select("doc_id", "a"), "doc_id").select("a", F.col("class_id").alias("b")).filter("a < b")
    component = components(_compared(docs, tested).unionByName(same))
    more = settle(_across(_apart(members, component, classes)))
    if not more.isEmpty():
        stars = component.select(F.col("component").alias("a"), F.col("node").alias("b"))
        component = components(stars.unionByName(_compared(docs, more)))
    return classes, component


def similar_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; the component's least id names it."""
    described = settle(describe(docs))
    classes, component = linked_classes(docs, described)
    grouped = classes.join(component.withColumnRenamed("node", "class_id"), "class_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "class_id").alias("component_id")
    )
    alone = described.filter("n = 0 or doc_id is null")
    return grouped.unionByName(alone.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
