"""SimHash near-duplicates by a segment-popcount embedding.

Fingerprint: bit ``b`` is set if it is set in over half of the XXH64 values
(UTF-8, seed 42) of a text's word shingles, repeats included.

A 64-bit fingerprint is cut into 32 segments of two bits and embedded as the
popcounts of its segments.  Written in unary (0: 00, 1: 01, 2: 11) the embedding
is again a 64-bit number, and the Manhattan distance of two embeddings is the
popcount of their difference.  A flipped bit changes one popcount by one, so the
Manhattan distance is a lower bound of the Hamming distance.

Range join on a grid: the segments are split into ``d // 2 + 1`` parts.  If two
embeddings are at most ``d`` apart, in one part they are at most 1 apart.  So in
each part every fingerprint is indexed by its cell and looks into its own cell
and those one step up; of two neighbouring cells one is a step up of the other.
Candidates are kept if the Manhattan distance of the whole embeddings, then the
Hamming distance of the fingerprints, is at most ``d``.

Only distinct fingerprints are linked (copies share theirs), in Spark's own
operators; nothing is gathered for a cell, and skewed cells are split by
adaptive execution.  Components come from star steps over the links.

* null or empty text: no shingles, fingerprint zero, linked like any other.
* null id: such a row gets the smallest id of its component, or null.
* repeated rows, ids and ties: every row gets a row; ``one_of_each`` keeps one of
  a component, whatever the ids are.
* texts of any length are read whole; an empty table gives no rows; ``components``
  reads no other columns, ``one_of_each`` returns them as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import id_text, map_blocks, texts
from forecourt.operators.components import star_forest
from forecourt.session import write_scratch

SHINGLE, MAX_BITS, SEED = 3, 2, 42
LOW = 0x5555555555555555
CHUNK = 1 << 17


def shingle_hashes(words: list[bytes], k: int = SHINGLE) -> list[int]:
    """XXH64 of all k-word shingles (fewer words: of the whole sequence)."""
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    digest, text = xxhash.xxh64_intdigest, b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    start = np.concatenate(([0], end[:-1]))[:len(words) - k + 1]
    return [digest(text[a:b], SEED) for a, b in zip(start.tolist(), (end[k - 1:] - 1).tolist())]


def fingerprint(hashes: list[int]) -> int:
    """The majority of each bit, as a signed 64-bit number."""
    if not hashes:
        return 0
    h, count = np.array(hashes, np.uint64), np.zeros(64, np.int64)
    for a in range(0, len(h), CHUNK):
        bits = np.unpackbits(h[a:a + CHUNK].view(np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h)).view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                 row: Column | None = None) -> DataFrame:
    """(doc_id, fp): the fingerprint as a long; and the binary ``row``, if given."""
    more = [] if row is None else [row.alias("row")]
    names = ["doc_id", *(["row"] if more else [])]

    def run(block: pa.RecordBatch) -> dict:
        return {**{c: block.column(c) for c in names},
                "fp": [fingerprint(shingle_hashes(t.lower().split(), shingle)) for t in texts(block)]}

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, fp long" + (", row binary" if more else "")
    return map_blocks(id_text(docs, doc_id, text, *more), "text", schema, run)


def embedding(fp: Column) -> Column:
    """Segment popcounts in unary: low bit for one or more, high bit for two."""
    high = F.shiftrightunsigned(fp, 1)
    low = fp.bitwiseOR(high).bitwiseAND(F.lit(LOW))
    both = fp.bitwiseAND(high).bitwiseAND(F.lit(LOW))
    return low.bitwiseOR(F.shiftleft(both, 1))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (src, dst) of distinct fingerprints ``fp`` at most ``max_bits`` apart;
    a pair may come more than once."""
    parts = max_bits // 2 + 1
    cuts = [32 * p // parts for p in range(parts + 1)]
    masks = [((1 << 2 * b) - 1) ^ ((1 << 2 * a) - 1) for a, b in zip(cuts, cuts[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    base = fps.select("fp", embedding(F.col("fp")).alias("e"))
    cell = lambda p: F.col("e").bitwiseAND(F.lit(signed(masks[p])).cast("long"))
    index = base.select("fp", "e", F.explode(F.array(*[
        F.struct(F.lit(p).alias("part"), cell(p).alias("cell")) for p in range(parts)])).alias("at"))
    index = index.select(F.col("fp").alias("dst"), F.col("e").alias("dst_e"), "at.part", "at.cell")

    def up(p: int, s: int) -> Column:
        """The cell with one more in segment ``s``; null where it is full."""
        at = F.shiftrightunsigned("e", 2 * s).bitwiseAND(F.lit(3))
        step = F.when(at == 0, F.lit(signed(1 << 2 * s))).when(at == 1, F.lit(signed(2 << 2 * s)))
        return F.when(at < 3, F.struct(F.lit(p).alias("part"), cell(p).bitwiseOR(step.cast("long")).alias("cell"),
                                       F.lit(False).alias("own")))

    probes = [F.struct(F.lit(p).alias("part"), cell(p).alias("cell"), F.lit(True).alias("own")) for p in range(parts)]
    probes += [up(p, s) for p in range(parts) for s in range(cuts[p], cuts[p + 1])]
    probe = base.select(F.col("fp").alias("src"), F.col("e").alias("src_e"), F.explode(F.array(*probes)).alias("at"))
    probe = probe.where("at is not null").select("src", "src_e", "at.part", "at.cell", "at.own")
    apart = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    return (probe.join(index, ["part", "cell"])
            .where((F.col("src") < F.col("dst")) | (~F.col("own") & (F.col("src") != F.col("dst"))))
            .where(apart("src_e", "dst_e") <= max_bits).where(apart("src", "dst") <= max_bits)
            .select("src", "dst"))


def component_of(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, least, component) for every distinct fingerprint of (doc_id, fp);
    ``least`` is its smallest id."""
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    forest = star_forest(links(rows.select("fp").distinct(), max_bits), "simhash_links")
    return least.join(forest, least.fp == forest.id, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row."""
    spark = docs.sparkSession
    rows = spark.read.parquet(write_scratch(fingerprints(docs, doc_id, text, shingle), "simhash"))
    joined = component_of(rows, max_bits)
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = joined.join(smallest, "component").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, all columns as they were: the one with the
    smallest id (null ids last); of repeated ids the smallest digest of its columns.

    A row is known by the digest of all its columns, so ids may be null or repeated.
    Rows that are equal in every column are one component's and one of them stays."""
    spark = docs.sparkSession
    names = [F.to_json(F.struct(F.col(f"`{c}`").alias("c")), {"ignoreNullFields": "false"}) for c in docs.columns]
    digest = F.unhex(F.sha2(F.concat_ws("\n", *names), 256))
    rows = spark.read.parquet(write_scratch(fingerprints(docs, doc_id, text, shingle, digest), "simhash"))
    of_fp = component_of(rows, max_bits).select("fp", "component")
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    best = first.join(of_fp, "fp").groupBy("component").agg(F.min("first").alias("first"))
    mark = "row" + "_" * max(map(len, docs.columns))  # a name that no column has
    kept = docs.withColumn(mark, digest).join(best.select(F.col("first.row").alias(mark)), mark, "left_semi")
    # as many rows have a digest as there are copies of the row that stays
    return kept.dropDuplicates([mark]).select(*[F.col(f"`{c}`") for c in docs.columns])
