"""Language-model scores from a probabilistic suffix tree over bytes.

A text is the bytes of its lower-cased words, joined by single spaces, and one
end symbol.  The tree's nodes are contexts of up to ``DEPTH`` preceding bytes of
the same text.  A context is retained if at least ``LEAST`` symbols follow it,
whatever the size of the corpus, and the divergence of its next-symbol
distribution from its longest proper suffix, times its count, is
``GAIN`` bits for each next symbol at least; suffixes of retained contexts stay
too.  Distributions are smoothed towards the suffix's (Witten-Bell), the root's
towards all 256 bytes, so every text has a probability.  A symbol is scored in
the state of the longest suffix that the tree has.

Counts come from all training texts: tasks count their byte windows and deal them,
packed as sorted arrays, by the last ``HEAD`` bytes of their contexts.  Shorter
contexts are sums of longer ones.  The tree grows with the corpus and lies nowhere
as a whole: contexts shorter than ``HEAD`` bytes (their number is the alphabet's, not
the corpus's) are one small tree; the windows whose contexts end with the same
``HEAD`` bytes are in the same part, which grows that part of the tree, and give a
table of every window's probability.

Tasks that score texts have the frequent windows' probabilities, at most ``HELD``.
All other windows, and the words of the base score (it needs each word's count in
the training texts), are too many for a broadcast.  Blocks of texts emit a row for
each part that they have other windows of, and the part sums their log probabilities
by text; they emit a row for each distinct word with the texts it occurs in, and
these meet the totals in a join (a frequent word has one row a block and its rows
can be split).  Of both only the sums that a task has of a text come back to its block.

* null or empty text: the end symbol only; null id: never held out.
* repeated rows: each is learned from and scored.
* no training text: V = N = 0, every symbol has the probability 1/256.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import blocks, id_text, prepare, texts, words_of
from forecourt.session import drop_scratch, write_scratch

DEPTH = 6
LEAST = 2
GAIN = 2.0
#: Bytes of the contexts by whose ends the tree is dealt to tasks.
HEAD = 3
BLOCK = 8 << 20
#: Distinct windows that a task holds at a time, and that are broadcast.
HELD = 2 << 20
#: Symbols that are looked at together, and that are sorted at a time to be counted.
CHUNK = 1 << 19
SORTED = 1 << 22
#: Windows by which a part of the tree is grown at least, if there are so many.
GROWN = 1 << 20
#: Texts whose number in a chunk is one byte of a sorted number.
NUMBERED = 256
#: Odd, so that it gives each ``HEAD`` bytes another number.
MIX = 0x9E3779
END, BEFORE = 10, 0


def streams(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The windows of all symbols, at most ``CHUNK`` at a time, and the number
    of the text of each.  A text's bytes follow ``DEPTH`` bytes of start context."""
    before = bytes([BEFORE] * (DEPTH - 1) + [END])
    parts = [before + b" ".join(t.lower().split()) + bytes([END]) for t in raw]
    data = np.frombuffer(b"".join([*parts, bytes(8)]), np.uint8)
    begin = np.concatenate(([0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))))
    for a in range(DEPTH, int(begin[-1]), CHUNK):
        b = min(a + CHUNK, int(begin[-1]))
        first, last = np.searchsorted(begin, [a, b - 1], side="right") - 1
        size = np.diff(np.clip(begin[first:last + 2], a, b))
        symbol = np.ones(b - a, bool)
        for k in range(DEPTH):
            at = begin[first:last + 1] + k - a
            symbol[at[(at >= 0) & (at < b - a)]] = False
        yield windows(data, a - DEPTH, b - a)[symbol], np.repeat(np.arange(first, last + 1), size)[symbol]


def windows(data: np.ndarray, start: int, n: int) -> np.ndarray:
    """``n`` runs of ``DEPTH + 1`` bytes as numbers, one from each byte on; a run's
    last byte is the lowest.  ``data`` goes on for 8 bytes after the last start."""
    eight = np.ndarray(n, ">u8", data, start, (1,)).astype(np.uint64)
    eight >>= np.uint64(8 * (7 - DEPTH))
    return eight.view(np.int64)


def dealt(keys: np.ndarray) -> np.ndarray:
    """Windows with the mixed last ``HEAD`` bytes of their contexts first: in order,
    those of an end are together and the ends of a part, too."""
    end = (keys >> 8) & low_bytes(HEAD)
    end *= MIX
    end &= low_bytes(HEAD)
    end <<= 8 * (DEPTH - HEAD + 1)
    front = keys >> 8 * (HEAD + 1)
    front <<= 8
    end |= front
    end |= keys & 255
    return end


def undealt(codes: np.ndarray) -> np.ndarray:
    end = (codes >> 8 * (DEPTH - HEAD + 1)) * pow(MIX, -1, 1 << 8 * HEAD) & low_bytes(HEAD)
    front = (codes >> 8) & low_bytes(DEPTH - HEAD)
    return front << 8 * (HEAD + 1) | end << 8 | codes & 255


def part_bits(spark) -> int:
    """Parts are a power of two, and four at least for each shuffle partition."""
    return min(max(6, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()), 16)


def by_part(codes: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """Each part of some codes in order: number, start and end."""
    part = codes >> (8 * (DEPTH + 1) - bits)
    cut = np.flatnonzero(np.append(True, part[1:] != part[:-1])[:len(part)])
    return zip(part[cut].tolist(), cut.tolist(), [*cut[1:].tolist(), len(part)])


def pack(codes: np.ndarray) -> bytes:
    """Byte by byte, the lowest of all codes first: sorted codes share the high ones."""
    return codes.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :DEPTH + 1].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    n = len(data) // (DEPTH + 1)
    out = np.zeros((n, 8), np.uint8)
    out[:, :DEPTH + 1] = np.frombuffer(data, np.uint8).reshape(DEPTH + 1, n).T
    return out.view("<i8").reshape(-1).astype(np.int64, copy=False)


def pack_counts(n: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest takes; the first byte says how many."""
    most = int(n.max()) if len(n) else 0
    size = next(k for k in (1, 2, 4, 8) if most < 1 << 8 * k - (k == 8))
    return bytes([size]) + n.astype(f"<u{size}").tobytes()


def unpack_counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def counted(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if n is None:
        keys = np.sort(keys)
        cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[cut], np.diff(np.append(cut, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[cut], np.add.reduceat(n, cut)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value of a sorted array starts, and how often it is there."""
    cut = np.flatnonzero(np.append(True, values[1:] != values[:-1])[:len(values)])
    return cut, np.diff(np.append(cut, len(values)))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and their counts of sorted parts, which are emptied."""
    codes, n = map(np.concatenate, zip(*parts))
    parts.clear()
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    del order
    cut, _ = runs(codes)
    return codes[cut], np.add.reduceat(n, cut) if len(cut) else n


#: All windows of some task that are in a part, and their counts.
PACKED = "part int, codes binary, n binary"


def packed(bits: int, codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = [(k, pack(codes[a:b]), pack_counts(n[a:b])) for k, a, b in by_part(codes, bits)]
    for a in range(0, len(rows), 64):
        k, c, m = zip(*rows[a:a + 64])
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(c, pa.binary()), pa.array(m, pa.binary())], names=["part", "codes", "n"])


def window_rows(rows: DataFrame, bits: int) -> DataFrame:
    """The windows of ``rows`` by part, counted in the texts that are not ``held_out``
    (if there is that column), which give those of the others with a count of 0.  A
    task sums its texts first."""
    def run(batches):
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        buffer, used = np.empty(SORTED, np.int64), 0

        def count():
            # the lowest bit says that the symbol is in a text that is held out
            marked = buffer[:used]
            marked.sort()
            cut, n = runs(marked)
            codes = marked[cut]
            n[codes & 1 == 1] = 0
            codes >>= 1
            cut, _ = runs(codes)
            parts.append((codes[cut], np.add.reduceat(n, cut) if len(cut) else n))

        for block in blocks(batches, "text", BLOCK):
            out = np.array(block.column("held_out").to_pylist(), np.int64)
            for keys, text in streams(texts(block)):
                codes = dealt(keys)
                codes <<= 1
                codes |= out[text]
                for a in range(0, len(codes), SORTED):
                    piece = codes[a:a + SORTED]
                    if used + len(piece) > SORTED:
                        count()
                        used = 0
                        if sum(len(c) for c, _ in parts) > HELD + HELD // 2:
                            parts = [merged(parts)]
                            if len(parts[0][0]) > HELD:
                                yield from packed(bits, *parts.pop())
                    buffer[used:used + len(piece)] = piece
                    used += len(piece)
        if used:
            count()
        if parts:
            yield from packed(bits, *merged(parts))

    held = F.col("held_out") if "held_out" in rows.columns else F.lit(False).alias("held_out")
    return rows.select("text", held).mapInArrow(run, PACKED)


def summed(rows: DataFrame, bits: int) -> DataFrame:
    """One row for each part, with the sums of the counts of its rows."""
    def run(batches):
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        last, held, most = None, 0, 2 * GROWN
        for batch in batches:
            for k, codes, n in zip(*(batch.column(c).to_pylist() for c in ("part", "codes", "n"))):
                if k != last and held > GROWN:  # the last part may go on
                    yield from packed(bits, *merged(parts))
                    held, most = 0, 2 * GROWN
                elif held > most:
                    parts = [merged(parts)]
                    held = len(parts[0][0])
                    most = max(most, 2 * held)  # so that a large part is not sorted for each of its rows
                last = k
                parts.append((unpack(codes), unpack_counts(n)))
                held += len(parts[-1][0])
        if parts:
            yield from packed(bits, *merged(parts))

    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(run, PACKED)


def window_counts(rows: DataFrame) -> DataFrame:
    """(key, n) of all windows of ``rows``, counted in the texts that are not
    ``held_out`` (if there is that column)."""
    def run(batches):
        for batch in batches:
            for codes, n in zip(batch.column("codes").to_pylist(), batch.column("n").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(undealt(unpack(codes))), pa.array(unpack_counts(n))], names=["key", "n"])

    prepare(rows.sparkSession)
    bits = part_bits(rows.sparkSession)
    return summed(window_rows(rows, bits), bits).mapInArrow(run, "key long, n long")


@dataclass
class Tree:
    """Retained contexts by length, from ``first`` bytes on: sorted keys, their
    counts, and the sorted (context, symbol) keys with their counts."""

    first: int
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    kinds: list[np.ndarray]
    pairs: list[np.ndarray]
    counts: list[np.ndarray]

    def probability(self, keys: np.ndarray, below: np.ndarray | float = 1 / 256) -> np.ndarray:
        """Of the last byte of each window in the state of its longest suffix;
        ``below`` is that by the contexts shorter than ``first``."""
        p = np.broadcast_to(below, len(keys))
        for k in range(len(self.contexts)):
            if not len(self.contexts[k]):
                continue
            low = keys & low_bytes(self.first + k + 1)
            at, here = find(self.contexts[k], low >> 8)
            pair, seen = find(self.pairs[k], low)
            n, kinds = self.totals[k][at], self.kinds[k][at]
            p = np.where(here, (np.where(seen, self.counts[k][pair], 0) + kinds * p) / (n + kinds), p)
        return p


def low_bytes(k: int) -> int:
    return (1 << 8 * k) - 1


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def build(keys: np.ndarray, n: np.ndarray, first: int, last: int, least: float, gain: float,
          below: Tree | None = None, stay: np.ndarray | None = None, cut_back: bool = True) -> Tree:
    """The contexts of ``first`` to ``last`` bytes, of windows and their counts.
    ``below`` has the shorter contexts, ``stay`` those of ``last`` bytes that longer
    ones need.  Without ``cut_back`` all with ``least`` symbols stay."""
    tree = Tree(first, [], [], [], [], [])
    retained: list[np.ndarray] = []
    keys, n = keys[n > 0], n[n > 0]
    state = np.zeros(0)
    for k in range(first, last + 1):
        pair, count = counted(keys & low_bytes(k + 1), n)
        context = pair >> 8
        start = np.append(True, context[1:] != context[:-1])[:len(pair)]
        cut, of = np.flatnonzero(start), np.cumsum(start) - 1
        total = np.add.reduceat(count, cut) if len(cut) else np.zeros(0, np.int64)
        enough = (total >= least)[of]
        pair, count, context, of = pair[enough], count[enough], context[enough], total[of[enough]]
        cut = np.flatnonzero(np.append(True, context[1:] != context[:-1])[:len(pair)])
        kinds = np.diff(np.append(cut, len(pair)))
        # the suffix has as many symbols or more, so the level before has its pairs
        if k > first:
            suffix = state[find(tree.pairs[-1], pair & low_bytes(k))[0]] if len(pair) else np.zeros(0)
        else:
            suffix = below.probability(pair & low_bytes(k)) if below else np.full(len(pair), 1 / 256)
        wide = np.repeat(kinds, kinds)
        state = (count + wide * suffix) / (of + wide)
        bits = np.add.reduceat(count * np.log2(count / of / suffix), cut) if len(cut) else np.zeros(0)
        retained.append(context[cut][bits >= gain * kinds] if k and cut_back else context[cut])
        for name, v in (("contexts", context[cut]), ("totals", of[cut]), ("kinds", kinds), ("pairs", pair), ("counts", count)):
            getattr(tree, name).append(v)
    if stay is not None:
        retained[-1] = np.union1d(retained[-1], stay)
    # the last level first: a context stays if it passed or one that it is a suffix of stays
    for k in range(last - first, -1, -1):
        held = np.unique(retained[k])
        if k:
            retained[k - 1] = np.union1d(retained[k - 1], held & low_bytes(first + k - 1))
        ok, pair_ok = find(held, tree.contexts[k])[1], find(held, tree.pairs[k] >> 8)[1]
        for name, keep in (("contexts", ok), ("totals", ok), ("kinds", ok), ("pairs", pair_ok), ("counts", pair_ok)):
            getattr(tree, name)[k] = getattr(tree, name)[k][keep]
    return tree


def grow(counts: DataFrame, min_share: float = 0.0, gain: float = GAIN) -> Tree:
    """The whole tree of the window counts (key, n) on the driver: for corpora
    that fit there."""
    got = counts.toArrow()
    n = got["n"].to_numpy()
    return build(got["key"].to_numpy(), n, 0, DEPTH, max(LEAST, min_share * n.sum()), gain)


def probabilities(counts: DataFrame, least: int = LEAST, gain: float = GAIN) -> DataFrame:
    """(key, n, p): the log10 probability of every window of ``counts`` by the
    same tree as ``grow``'s, which is grown in parts."""
    def run(batches):
        for batch in batches:
            yield from packed(bits, *counted(dealt(batch.column("key").to_numpy()), batch.column("n").to_numpy()))

    def flat(batches):
        for batch in batches:
            for codes, n, p in zip(*(batch.column(c).to_pylist() for c in ("codes", "n", "p"))):
                codes, n = unpack(codes), unpack_counts(n)
                yield pa.RecordBatch.from_arrays([pa.array(undealt(codes)), pa.array(n), pa.array(resolved(codes, p, head.value))], names=["key", "n", "p"])

    spark = counts.sparkSession
    prepare(spark)
    bits = part_bits(spark)
    path = write_scratch(summed(counts.select("key", "n").mapInArrow(run, PACKED), bits), "windows", free=True)
    scored, short = scored_parts(spark.read.parquet(path), bits, least, gain)
    drop_scratch(spark, path)
    head = spark.sparkContext.broadcast(short)
    return spark.read.parquet(scored).select("codes", "n", "p").mapInArrow(flat, "key long, n long, p double")


def scored_parts(parts: DataFrame, bits: int, least: int = LEAST, gain: float = GAIN) -> tuple[str, Tree]:
    """The table of ``parts`` with the log10 probability of each window, NaN if no
    context of ``HEAD`` bytes or more decides it; and the tree that gives the others."""
    spark = parts.sparkSession

    def shorter(batches):
        for batch in batches:
            for codes, n in zip(batch.column("codes").to_pylist(), batch.column("n").to_pylist()):
                keys, n = counted(undealt(unpack(codes)) & low_bytes(HEAD), unpack_counts(n))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    short = parts.select("codes", "n").mapInArrow(shorter, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    short_key, short_n = short["key"].to_numpy(), short["n"].to_numpy()
    shared = spark.sparkContext.broadcast(build(short_key, short_n, 0, HEAD - 1, least, gain, cut_back=False))

    def scored(rows: list[tuple[int, bytes, bytes]]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        codes, n = (np.concatenate([f(r[k]) for r in rows]) for k, f in ((1, unpack), (2, unpack_counts)))
        key = undealt(codes)
        tree = build(key, n, HEAD, DEPTH, least, gain, below=head)
        p = np.log10(tree.probability(key, head.probability(key & low_bytes(HEAD))))
        p[~find(tree.contexts[0], (key >> 8) & low_bytes(HEAD))[1]] = np.nan
        needed = np.unique(tree.contexts[0] & low_bytes(HEAD - 1)).astype("<i8").tobytes()
        cut = np.cumsum([0, *(len(r[1]) // (DEPTH + 1) for r in rows)]).tolist()
        for i in range(0, len(rows), 64):
            some = range(i, min(i + 64, len(rows)))
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[k][0] for k in some], pa.int32()), pa.array([rows[k][1] for k in some], pa.binary()),
                pa.array([rows[k][2] for k in some], pa.binary()),
                pa.array([p[cut[k]:cut[k + 1]].astype("<f8").tobytes() for k in some], pa.binary()),
                pa.array([b"" if k else needed for k in some], pa.binary())], names=["part", "codes", "n", "p", "needed"])

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("part", "codes", "n"))):
                rows.append(row)
                held += len(row[1]) // (DEPTH + 1)
                if held > GROWN:
                    yield from scored(rows)
                    rows, held = [], 0
        if rows:
            yield from scored(rows)

    def contexts(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.frombuffer(b"".join(batch.column("needed").to_pylist()), "<i8")))], names=["context"])

    path = write_scratch(parts.mapInArrow(run, PACKED + ", p binary, needed binary"), "probabilities", free=True)
    # a short context that did not pass stays if a longer one needs it
    needed = spark.read.parquet(path).select("needed").mapInArrow(contexts, "context long").distinct().toArrow()
    return path, build(short_key, short_n, 0, HEAD - 1, least, gain, stay=needed["context"].to_numpy())


def resolved(codes: np.ndarray, p: bytes, head: Tree) -> np.ndarray:
    """The log10 probabilities of a row's windows, with those that the short contexts give."""
    p = np.frombuffer(p, "<f8").astype(np.float64)
    none = np.flatnonzero(np.isnan(p))
    p[none] = np.log10(head.probability(undealt(codes[none]) & low_bytes(HEAD)))
    return p


class Scores:
    """log10 probabilities of windows by a tree."""

    def __init__(self, tree: Tree):
        self.tree = tree

    def of(self, keys: np.ndarray) -> np.ndarray:
        distinct, at = np.unique(keys, return_inverse=True)
        return np.log10(self.tree.probability(distinct))[at]


def text_scores(raw: list[bytes], scores: Scores) -> np.ndarray:
    """log10 probability of each text."""
    out = np.zeros(len(raw))
    for keys, text in streams(raw):
        out += np.bincount(text, weights=scores.of(keys), minlength=len(raw))
    return out


def frequent(windows: DataFrame, most: int, head) -> tuple[np.ndarray, np.ndarray]:
    """The codes, sorted, and the log10 probabilities of the windows with some count
    or more: at most ``most``.  ``head`` is the broadcast tree of the short contexts."""
    def sizes(batches):
        for batch in batches:
            n = np.concatenate([np.zeros(0, np.int64), *map(unpack_counts, batch.column("n").to_pylist())])
            size, times = np.unique(np.frexp(n[n > 0].astype(np.float64))[1].astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(times.astype(np.int64))], names=["size", "n"])

    def often(batches):
        for batch in batches:
            for codes, n, p in zip(*(batch.column(c).to_pylist() for c in ("codes", "n", "p"))):
                n = unpack_counts(n)
                if len(n) and n.max() >= least:
                    codes = unpack(codes)
                    here = n >= least
                    yield pa.RecordBatch.from_arrays([
                        pa.array(codes[here]), pa.array(resolved(codes[here], np.frombuffer(p, "<f8")[here].tobytes(), head.value))], names=["code", "p"])

    by_size = {r.size: r.n for r in windows.select("n").mapInArrow(sizes, "size long, n long").groupBy("size").agg(F.sum("n").alias("n")).collect()}
    size = 65
    while size > 1 and sum(n for s, n in by_size.items() if s >= size - 1) <= most:
        size -= 1
    least = 1 << min(size - 1, 62)
    got = windows.select("codes", "n", "p").mapInArrow(often, "code long, p double").toArrow().sort_by("code")
    return got["code"].to_numpy(), got["p"].to_numpy()


# ----------------------------------------------------------- texts and words
#: ``texts`` has a block's texts as an Arrow stream: a nested column costs the
#: conversion of every row, also where it is null.  ``part`` and what follows are a
#: block's windows of a part, the number of the text of each, and how often it is there.
WORD_ROWS = ("block long, word binary, n long, wide boolean, places binary, texts binary, "
             "part int, codes binary, at binary, times binary")


def places_of(item: np.ndarray, text: np.ndarray, n: np.ndarray, size: int) -> tuple[bool, pa.Array]:
    """For each of ``size`` items, numbers in order, its texts and counts as bytes;
    and whether they take four bytes instead of two."""
    wide = bool(len(n) and max(text.max(), n.max()) >= 1 << 16)
    place = np.stack((text, n), axis=1).astype(np.uint32 if wide else np.uint16)
    cut = np.searchsorted(item, np.arange(size + 1)) * 2 * place.itemsize
    return wide, pa.BinaryArray.from_buffers(pa.binary(), size, [
        None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(place.tobytes())])


def chunk_pairs(raw: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct (code, text) of chunks of texts, sorted, and how often each is there."""
    for a in range(0, len(raw), NUMBERED):
        for keys, text in streams(raw[a:a + NUMBERED]):
            both = dealt(keys)
            both <<= 8
            both |= text
            both = both.view(np.uint64)  # all 64 bits are in use
            both.sort()
            cut, n = runs(both)
            both = both[cut]
            yield (both >> np.uint64(8)).view(np.int64), (both & np.uint64(255)).view(np.int64) + a, n


def word_rows(rows: DataFrame, broadcast, id_type: str, bits: int) -> DataFrame:
    """Rows (block, word, training count, places), rows (block, part) with the windows
    that are not among the frequent ones, and one row a block with its texts and their
    scores by the frequent windows.  A block's number is its task's and its place
    in the task, the same whenever the task runs."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(WORD_ROWS))
    id_arrow = to_arrow_schema(_parse_datatype_string(f"doc_id {id_type}")).field(0).type

    def words(block: pa.RecordBatch, number: int, held: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
        n_texts = block.num_rows
        flat, counts = words_of(block, lower=True)
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        size = len(coded.dictionary)
        # every text also has one end, the word after the last
        pair, n = counted(np.concatenate((codes * n_texts + np.repeat(np.arange(n_texts), counts),
                                          size * n_texts + np.arange(n_texts))))
        word, text = np.divmod(pair, n_texts)
        wide, places = places_of(word, text, n, size + 1)
        learned = np.bincount(word, weights=n * ~held[text], minlength=size + 1).astype(np.int64)
        names = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([b"\n"], pa.binary())])
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(size + 1, number)), names, pa.array(learned), pa.array(np.full(size + 1, wide)), places,
            *(pa.nulls(size + 1, f.type) for f in list(schema)[5:])], schema=schema), counts

    def windows(block: pa.RecordBatch, number: int) -> tuple[list[pa.RecordBatch], np.ndarray]:
        known, values = broadcast.value
        score = np.zeros(block.num_rows)
        rare = [(np.zeros(0, np.int64),) * 3]
        for codes, text, n in chunk_pairs(texts(block)):
            cut, times = runs(codes)
            at, found = find(known, codes[cut])
            value = np.where(found, values[at], 0.0) if len(known) else np.zeros(len(cut))
            score += np.bincount(text, weights=n * np.repeat(value, times), minlength=len(score))
            left = np.repeat(~found, times)
            rare.append((codes[left], text[left], n[left]))
        codes, text, n = map(np.concatenate, zip(*rare))
        order = np.argsort(codes, kind="stable")
        codes, text, n = codes[order], text[order], n[order]
        parts = [(k, pack(codes[a:b]), pack_counts(text[a:b]), pack_counts(n[a:b])) for k, a, b in by_part(codes, bits)]
        return [pa.RecordBatch.from_arrays([
            pa.array([number] * len(some), pa.int64()), *(pa.nulls(len(some), f.type) for f in list(schema)[1:6]),
            *(pa.array(c, f.type) for c, f in zip(zip(*some), list(schema)[6:]))], schema=schema)
            for some in (parts[a:a + 64] for a in range(0, len(parts), 64))], score

    def run(batches):
        for k, block in enumerate(blocks(batches, "text", BLOCK)):
            number = (TaskContext.get().partitionId() << 32) | k
            held = np.array(block.column("held_out").to_pylist(), bool)
            batch, counts = words(block, number, held)
            yield batch
            del batch
            rows, score = windows(block, number)
            yield from rows
            own = pa.record_batch({"doc_id": block.column("doc_id").cast(id_arrow), "held_out": pa.array(held),
                                   "n_tokens": pa.array(counts + 1), "score": pa.array(score)})
            stream = pa.BufferOutputStream()
            with pa.ipc.new_stream(stream, own.schema) as out:
                out.write_batch(own)
            yield pa.RecordBatch.from_arrays([
                pa.array([number]), pa.nulls(1, pa.binary()), pa.array([0]), pa.array([False]), pa.nulls(1, pa.binary()),
                pa.array([stream.getvalue().to_pybytes()], pa.binary()),
                *(pa.nulls(1, f.type) for f in list(schema)[6:])], schema=schema)

    return rows.mapInArrow(run, WORD_ROWS)


#: Sums that a task has of a block's texts: their numbers, the sums of log10 values,
#: and for words how many are known.
SUMS = "block long, places binary, sums binary, known binary"


def add(held: dict[int, np.ndarray], block: int, sums: np.ndarray) -> None:
    """Add to a block's sums, a column for each of its first texts."""
    old = held.get(block)
    if old is not None:
        long, short = (sums, old) if sums.shape[1] > old.shape[1] else (old, sums)
        long[:, :short.shape[1]] += short
        sums = long
    held[block] = sums


def sum_rows(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows of the sums that are not zero; ``held`` is emptied."""
    rows = [(k, at, x[:, at]) for k, x in held.items() for at in [np.flatnonzero(x.any(axis=0))]]
    held.clear()
    for a in range(0, len(rows), 64):
        k, at, x = zip(*rows[a:a + 64])
        yield pa.RecordBatch.from_arrays([
            pa.array(k, pa.int64()), pa.array([v.astype("<u4").tobytes() for v in at], pa.binary()),
            pa.array([v[0].astype("<f8").tobytes() for v in x], pa.binary()),
            pa.array([pack_counts(v[1].astype(np.int64)) if len(v) > 1 else None for v in x], pa.binary())],
            names=["block", "places", "sums", "known"])


def part_sums(words: DataFrame, windows: DataFrame, head) -> DataFrame:
    """Sums of the log10 probabilities of the windows that blocks have emitted.  A
    part's windows come first, then its blocks, one by one."""
    def run(batches):
        held: dict[int, np.ndarray] = {}
        part, known, value = None, np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            for k, block, codes, at, times, p in zip(*(batch.column(c) for c in ("part", "block", "codes", "at", "times", "p"))):
                codes = unpack(codes.as_py())
                if p.is_valid:
                    part, known, value = k.as_py(), codes, resolved(codes, p.as_py(), head.value)
                    continue
                place, found = find(known, codes)
                if k.as_py() != part or not found.all():
                    raise ValueError("a text has windows that were not counted: the documents have changed between two reads")
                add(held, block.as_py(), np.bincount(unpack_counts(at.as_py()), weights=unpack_counts(times.as_py()) * value[place])[None])
            if sum(x.size for x in held.values()) > HELD:
                yield from sum_rows(held)
        yield from sum_rows(held)

    rows = words.where("part is not null").select("part", "block", "codes", "at", "times", F.lit(None).cast("binary").alias("p"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("block", "long"), ("at", "binary"), ("times", "binary"))]
    return (rows.unionByName(windows.select("part", "codes", "p", *none)).repartition("part").sortWithinPartitions("part", "block")
            .mapInArrow(run, SUMS))


def word_sums(rows: DataFrame) -> DataFrame:
    """Sums of the log10 counts of words, of ``rows`` with their totals ``c``."""
    def sums(t: pa.Table, held: dict[int, np.ndarray]) -> None:
        for wide in (False, True):
            part = t.filter(pc.equal(t.column("wide"), wide)).sort_by("block").combine_chunks()
            if not part.num_rows:
                continue
            size = pc.binary_length(part.column("places")).to_numpy()
            place = np.frombuffer(b"".join(part.column("places").to_pylist()), np.uint32 if wide else np.uint16).reshape(-1, 2)
            size = size // (2 * place.itemsize)
            c = np.repeat(pc.fill_null(part.column("c"), 0).to_numpy(), size)
            text, n = place[:, 0].astype(np.int64), place[:, 1]
            both = n * np.log10(c + 1), n * (c > 0)
            block = part.column("block").to_numpy()
            cut, _ = runs(block)
            ends = np.concatenate(([0], np.cumsum(size)))[np.append(cut, len(block))].tolist()
            for k, a, b in zip(block[cut].tolist(), ends, ends[1:]):
                if b > a:
                    add(held, k, np.stack([np.bincount(text[a:b], weights=x[a:b]) for x in both]))

    def run(batches):
        held: dict[int, np.ndarray] = {}
        parts: list[pa.RecordBatch] = []
        for batch in batches:
            parts.append(batch)
            if sum(x.nbytes for x in parts) > BLOCK:
                sums(pa.Table.from_batches(parts), held)
                parts = []
                if sum(x.size for x in held.values()) > HELD:
                    yield from sum_rows(held)
        if parts:
            sums(pa.Table.from_batches(parts), held)
        yield from sum_rows(held)

    return rows.select("block", "wide", "places", "c").mapInArrow(run, SUMS)


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, learned from those that are not ``held_out`` (a
    condition on doc_id)."""
    spark = docs.sparkSession
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    rows = id_text(docs, doc_id, text).select("doc_id", "text", held)
    bits = part_bits(spark)
    counted_path = write_scratch(summed(window_rows(rows, bits), bits), "windows", free=True)
    scored_path, short = scored_parts(spark.read.parquet(counted_path), bits)
    drop_scratch(spark, counted_path)  # read for the last time
    windows, head = spark.read.parquet(scored_path), spark.sparkContext.broadcast(short)
    known = spark.sparkContext.broadcast(frequent(windows, HELD, head))
    id_type = docs.schema[doc_id].dataType.simpleString()
    words = spark.read.parquet(write_scratch(word_rows(rows, known, id_type, bits), "words", free=True))
    totals = spark.read.parquet(write_scratch(
        words.where("n > 0").groupBy("word").agg(F.sum("n").alias("c")), "totals", free=True))
    size = totals.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_all, v_all = int(size[0]), int(size[1])
    out = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def meet(t: pa.Table) -> pa.Table:
        own = pa.ipc.open_stream(pc.drop_null(t.column("texts"))[0].as_buffer()).read_all()
        base, known, score = np.zeros(own.num_rows), np.zeros(own.num_rows), own.column("score").to_numpy().copy()
        for at, x, n in zip(*(t.column(c).to_pylist() for c in ("places", "sums", "known"))):
            if at is None:
                continue
            at, x = np.frombuffer(at, "<u4"), np.frombuffer(x, "<f8")
            if n is None:
                score[at] += x
            else:
                base[at] += x
                known[at] += unpack_counts(n)
        tokens = own.column("n_tokens").to_numpy()
        return pa.table({
            "doc_id": own.column("doc_id"), "held_out": own.column("held_out"), "n_tokens": tokens, "n_known": known.astype(np.int64),
            "train_tokens": np.full(own.num_rows, n_all), "base_score": base - tokens * np.log10(n_all + v_all + 1),
            "score": score})

    # totals have one row a word, so the parts of them that are built into tables are even
    found = words.where("part is null and texts is null").select("block", "word", "wide", "places").join(totals.hint("shuffle_hash"), "word", "left")
    sums = word_sums(found).unionByName(part_sums(words, windows, head)).withColumn("texts", F.lit(None).cast("binary"))
    own = words.where("texts is not null").select("block", *(F.lit(None).cast("binary").alias(c) for c in ("places", "sums", "known")), "texts")
    return own.unionByName(sums).groupBy("block").applyInArrow(meet, out)
