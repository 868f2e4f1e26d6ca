"""Phrase collocations by dynamic itemset counting.

The corpus is dealt into ``SHARDS`` shards that are scanned in a cycle.  All single
words are counted from the first shard on.  As soon as both (n - 1)-word parts
of a phrase have reached the threshold, the phrase is active from the next shard
on, whatever its length: lengths are counted side by side, each phrase for exactly
one full cycle from where it started.  The scans end when no phrase is active.

While scanning, a phrase is its 64-bit hash.  Tasks send sorted arrays of hashes and
counts by hash bucket; Spark deals the buckets, and each is merged with what it
has of the steps before.  What tasks must know of the phrases that reached the threshold is, for
each length, an array of ``SLOTS`` bytes with the earliest step at which a phrase
of a slot reached it; a phrase has two slots and counts from the later one.
Phrases that share slots can only be activated too early, never be missed, and a
start once known never changes.  The arrays' size is fixed, whatever the corpus;
they are brought to the driver as bitmaps of the same bound.  With a vocabulary far
beyond ``SLOTS`` the arrays prune less, and nothing else changes.

A hash may belong to two phrases.  So a last scan counts, by their text, all
phrases whose slots say that they reached the threshold: those counts are exact.

Every word ``[^\\x20\\x09]+`` of every text counts; long texts are read in parts that
end between pieces.  Null and empty texts have no words; a null language is
``und``; repeated rows count each time; an empty table gives an empty result; other
columns are not read.  Equal scores go by count, then by the phrase's bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.llm.common import blocks, prepare, texts
from forecourt.session import drop_scratch, scratch_path, write_scratch

SHARDS = 4
SLOTS = 1 << 23
#: No phrase of a slot has reached the threshold.
NEVER = 255
CHUNK_BYTES = 4 << 20
#: Counts that a task holds before it sends them.
HELD = 2 << 20
SEPARATOR = re.compile(rb"[.,;:!?\n-\r]")
#: Classes of bytes: 0 part of a word, 1 between words, 2 between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# ------------------------------------------------------------------- words
def chunks(data: bytes, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes that end between pieces."""
    a = 0
    while len(data) - a > size:
        found = SEPARATOR.search(data, a + size)
        if not found:
            break
        yield data[a:found.start()]
        a = found.start()
    yield data[a:]


def words(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of ``data``, each word's number in order, and whether the next word is in the same piece."""
    raw = np.frombuffer(data, np.uint8)
    kind = KIND[raw]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(LOWER[raw[inside]]))
    coded = flat.dictionary_encode()
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts]
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), piece[1:] == piece[:-1]


def language_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for block in blocks(iter([batch]), "text", CHUNK_BYTES):
            own, by_lang = block.column("lang").to_pylist(), {}
            for lang, text in zip(own, texts(block)):
                by_lang.setdefault(lang, []).append(text)
            for lang, parts in by_lang.items():
                for chunk in chunks(b"\n".join(parts)):
                    yield lang, chunk


# ------------------------------------------------------------ hashes, slots
def word_hashes(lang: str, distinct: pa.Array) -> np.ndarray:
    head = lang.encode() + b"\0"
    return np.fromiter((xxhash.xxh64_intdigest(head + w) for w in distinct.cast(pa.binary()).to_pylist()), np.uint64, len(distinct))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a phrase with hash ``a`` followed by a word with hash ``b``."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def reached(array: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The step at which the phrases of both slots of ``h`` had reached the threshold."""
    mask = np.uint64(len(array) - 1)
    return np.maximum(array[(h & mask).astype(np.int64)], array[((h >> np.uint64(32)) & mask).astype(np.int64)])


def phrases(codes: np.ndarray, joined: np.ndarray, own: np.ndarray, arrays: list[np.ndarray]) -> Iterator[tuple]:
    """(n, places, hashes, first steps) of the phrases whose parts have reached the threshold, n from 2."""
    word, hashes = own[codes], own[codes]
    when = reached(arrays[0], own)[codes]
    for n in range(2, len(arrays) + 1):
        both = (when[:-1] != NEVER) & (when[1:] != NEVER)
        if n == 2:
            both &= joined
        at = np.flatnonzero(both)
        h = mixed(hashes[at], word[at + n - 1])
        first = 1 + np.maximum(when[at], when[at + 1])
        yield n, at, h, first
        if n < len(arrays):
            own_step = reached(arrays[n - 1], h)
            hashes, when = np.zeros_like(hashes), np.full(len(codes), NEVER, np.uint8)
            # slots may have been set by others before this phrase started
            hashes[at], when[at] = h, np.where(own_step == NEVER, NEVER, np.maximum(own_step, first))


# ------------------------------------------------------------------- scans
COUNTED = "bucket int, n int, start int, h binary, f binary, hits binary"
_COUNTED = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("start", pa.int32()), ("h", pa.binary()), ("f", pa.binary()),
                      ("hits", pa.binary())])


def summed(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order and the sums of their counts."""
    h, f = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h, kind="stable")
    h, f = h[order], f[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[first], np.add.reduceat(f, first) if len(h) else f


def by_bucket(held: dict[tuple[int, int], list], buckets: int) -> pa.RecordBatch:
    """Rows of ``COUNTED``: a bucket is a range of hashes."""
    rows = []
    edges = ((np.arange(1, buckets, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets)) << np.uint64(32)
    for (n, start), parts in held.items():
        h, f = summed([x for x, _ in parts], [y for _, y in parts])
        cuts = [0, *np.searchsorted(h, edges).tolist(), len(h)]
        rows += [{"bucket": k, "n": n, "start": start, "h": h[a:b].tobytes(), "f": f[a:b].tobytes()}
                 for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
    return pa.RecordBatch.from_pylist(rows, schema=_COUNTED)


def scan(shard: DataFrame, step: int, shards: int, buckets: int, sent) -> DataFrame:
    """Counts of the phrases that are active at ``step``, by bucket, length and start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays, held, size = sent.value, {}, 0
        for lang, data in language_chunks(batches):
            distinct, codes, joined = words(data)
            if not len(codes):
                continue
            own = word_hashes(lang, distinct)
            if step < shards:
                held.setdefault((1, 0), []).append((own, np.bincount(codes, minlength=len(own))))
                size += len(own)
            for n, _, h, start in phrases(codes, joined, own, arrays):
                for first in range(max(1, step - shards + 1), step + 1):
                    found, f = np.unique(h[start == first], return_counts=True)
                    if len(found):
                        held.setdefault((n, first), []).append((found, f))
                        size += len(found)
            if size >= HELD:
                yield by_bucket(held, buckets)
                held, size = {}, 0
        if held:
            yield by_bucket(held, buckets)

    return shard.mapInArrow(run, COUNTED)


def merged(counts: DataFrame, step: int, shards: int, least: int) -> DataFrame:
    """One row per bucket, length and start: the sums of what isn't at the end of its cycle,
    and (``hits``) the hashes that have ``least``."""
    def merge(held: dict[tuple[int, int], list], bucket: int) -> pa.RecordBatch:
        rows = []
        for (n, start), parts in held.items():
            h, f = summed([np.frombuffer(x, np.uint64) for x, _ in parts], [np.frombuffer(y, np.int64) for _, y in parts])
            goes_on = start + shards - 1 > step
            hits = h[f >= least].tobytes()
            if goes_on or hits:
                rows.append({"bucket": bucket, "n": n, "start": start, "h": h.tobytes() if goes_on else b"",
                             "f": f.tobytes() if goes_on else b"", "hits": hits})
        return pa.RecordBatch.from_pylist(rows, schema=_COUNTED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = {}, None
        for batch in batches:
            for bucket, n, start, h, f in zip(*(batch.column(c).to_pylist() for c in ("bucket", "n", "start", "h", "f"))):
                if bucket != current and held:
                    yield merge(held, current)
                    held = {}
                current = bucket
                held.setdefault((n, start), []).append((h, f))
        if held:
            yield merge(held, current)

    return counts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, COUNTED)


def mark(state: DataFrame, step: int, arrays: list[np.ndarray]) -> set[int]:
    """Put the slots of the phrases that have reached the threshold into ``arrays``; the lengths with new ones."""
    slots = len(arrays[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64(slots - 1)
        for batch in batches:
            for n, hits in zip(batch.column("n").to_pylist(), batch.column("hits").to_pylist()):
                h = np.frombuffer(hits, np.uint64)
                found = np.unique(np.concatenate((h & mask, (h >> np.uint64(32)) & mask))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), n, np.int32)), pa.array(found)], names=["n", "slot"])

    hit = state.where(F.length("hits") > 0).select("n", "hits").mapInArrow(run, "n int, slot long")
    maps = hit.groupBy("n", F.expr("bitmap_bucket_number(slot + 1)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(slot + 1))").alias("bits"))
    new = set()
    for n, bucket, bits in maps.collect():  # at most one bit a slot, in one job (an iterator takes one a partition)
        places = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")) + (bucket - 1) * 32768
        fresh = places[arrays[n - 1][places] == NEVER]
        if len(fresh):
            arrays[n - 1][fresh] = step
            new.add(n)
    return new


def cycle(spark: SparkSession, path: str, longest: int, least: int, shards: int, slots: int) -> list[np.ndarray]:
    """The arrays after all phrases have had their cycle over the shards below ``path``."""
    arrays, context = [np.full(slots, NEVER, np.uint8) for _ in range(longest)], spark.sparkContext
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # as many as the session deals a shuffle to
    step, last, state = 0, shards - 1, None
    while step <= last:
        sent = context.broadcast(arrays)
        shard = spark.read.schema("lang string, text string").parquet(f"{path}/shard={step % shards}")
        counts = scan(shard, step, shards, buckets, sent)
        if state:  # those that are not at the end of their cycle
            counts = counts.unionByName(spark.read.parquet(state).where(F.col("start") + shards > step))
        written = write_scratch(merged(counts, step, shards, least), f"collocations-{step}")
        for n in mark(spark.read.parquet(written), step, arrays):
            if n < longest:
                last = max(last, step + shards)
        if state:
            drop_scratch(spark, state)
        sent.destroy()
        step, state = step + 1, written
    drop_scratch(spark, state)
    return arrays


def exact(docs: DataFrame, arrays: list[np.ndarray]) -> DataFrame:
    """(lang, n, phrase, f) of the phrases whose slots are set, counted by text; n = 0 has all words of a language."""
    sent = docs.sparkSession.sparkContext.broadcast([np.packbits(a != NEVER) for a in arrays])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [np.where(np.unpackbits(bits), np.uint8(0), np.uint8(NEVER)) for bits in sent.value]
        for lang, data in language_chunks(batches):
            distinct, codes, joined = words(data)
            if not len(codes):
                continue
            own = word_hashes(lang, distinct)
            known = np.flatnonzero(reached(arrays[0], own) != NEVER)
            found = [(0, pa.array([""]), [len(codes)]),
                     (1, distinct.take(pa.array(known)), np.bincount(codes, minlength=len(distinct))[known])]
            for n, at, h, _ in phrases(codes, joined, own, arrays):
                at = at[reached(arrays[n - 1], h) != NEVER]
                key = codes[at]
                for j in range(1, n):
                    key = (key if j == 1 else np.unique(key, return_inverse=True)[1]) * len(distinct) + codes[at + j]
                _, first, f = np.unique(key, return_index=True, return_counts=True)
                parts = [distinct.take(pa.array(codes[at[first] + j])) for j in range(n)]
                found.append((n, pc.binary_join_element_wise(*parts, " "), f))
            for n, phrase, f in found:
                size = len(phrase)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array([n] * size, pa.int32()), phrase.cast(pa.string()),
                     pa.array(f, pa.int64())], names=["lang", "n", "phrase", "f"])

    found = docs.mapInArrow(run, "lang string, n int, phrase string, f long")
    return found.groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))


def frequent(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 3, least: int = 10,
             shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(lang, n, phrase, f) of all phrases of up to ``longest`` words with f >= ``least``,
    and the number of all words of each language as n = 0."""
    spark = docs.sparkSession
    prepare(spark)
    path = scratch_path(spark, f"tables/collocations-{xxhash.xxh64_hexdigest(np.random.bytes(16))}")
    dealt = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text}`").cast("string").alias("text"))
    dealt = dealt.where(F.length("text") > 0).withColumn("shard", F.monotonically_increasing_id() % shards)
    dealt.write.partitionBy("shard").parquet(path)
    for k in range(shards):  # a shard without rows has no folder
        spark.createDataFrame([], "lang string, text string").write.mode("append").parquet(f"{path}/shard={k}")
    arrays = cycle(spark, path, longest, least, shards, slots)
    everything = spark.read.schema("lang string, text string").parquet(*[f"{path}/shard={k}" for k in range(shards)])
    found = write_scratch(exact(everything, arrays).where((F.col("f") >= least) | (F.col("n") == 0)), "collocations-counts")
    drop_scratch(spark, path)
    return spark.read.parquet(found)


# ------------------------------------------------------------------ scores
def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", longest: int = 3, least: int = 10,
                 inside_percent: int = 50, first: int = 2000, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases by their weakest cut.

    ``a`` is a phrase's count, ``l`` and ``r`` those of the two parts of the cut with
    the least score floor(10^6 a^2 / (l r)), ``n`` the words of the language.  A phrase
    inside a longer one that has at least ``inside_percent`` of its count is dropped.
    """
    counts = frequent(docs, lang, text, longest, least, shards, slots)
    parts = counts.where("n > 0").select("lang", "phrase", "f")
    candidates = counts.where("n > 1").select("lang", "n", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.expr("slice(w, 1, k)")).alias("x"),
        F.concat_ws(" ", F.expr("slice(w, k + 1, n - k)")).alias("y"))
    for part, side in (("x", "l"), ("y", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(part), F.col("f").alias(side)), ["lang", part])
    exactly = lambda c: F.col(c).cast("decimal(14,0)")  # noqa: E731 - products stay within 38 digits
    millions = exactly("a") * exactly("a") * F.lit(1_000_000).cast("decimal(7,0)")
    scored = cuts.withColumn("top", millions).withColumn("bottom", exactly("l") * exactly("r"))
    scored = scored.withColumn("score", F.expr("top div bottom"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut")).select(
        "lang", "phrase", "cut.score", "cut.a", "cut.l", "cut.r")
    # the parts of n - 1, n - 2, ... words of every candidate
    spans = F.expr("flatten(transform(sequence(2, n - 1), m -> transform(sequence(1, n - m + 1), i -> concat_ws(' ', slice(w, i, m)))))")
    longer = candidates.where("n > 2").select("lang", F.col("a").alias("f"), F.explode(F.array_distinct(spans)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent))
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    head = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= first)
    head = head.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    total = counts.where("n = 0").select("lang", F.col("f").alias("n"))
    return head.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
