"""BPE with word ends: a frequent-word transducer in front of exact merging.

The words of all documents (``[^\\x20\\x09-\\x0D]+``) are counted in Spark; those
that are at least ``min_share`` of all words, and their ids, are compiled into a
minimal acyclic automaton with shared suffixes.  Every arc carries a number, and the
numbers along a word's path add up to the word's index, under which its ids
are stored: the automaton is a transducer from words to id sequences.  Its
arrays form one file that a worker maps into memory.  The distinct words of a
block walk the automaton together, one byte a step; words that it does not
accept are normalised, pre-tokenised and merged exactly (lowest rank first,
leftmost first), all words of a block at once.  The lexicon is a cache: it
never changes an id.

* null or empty text: no ids; decoded to the empty string.
* strings of special tokens in a text become their ids, as the library does it.
* a word of any length is merged: beyond ``LONG`` symbols one by one, by a heap.
* an empty table, repeated rows and extra columns need no special case.

The lexicon has ``1 / min_share`` words at most, so its broadcast is bounded; the vocabulary comes from a file named by the caller.
"""

from __future__ import annotations

import functools
import heapq
import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import id_text, map_blocks, mapped_file, new_key, words_of
from forecourt.session import drop_scratch, write_scratch

MIN_SHARE = 4e-6
LONG = 64
BLOCK = 5 << 20
COUNT_BLOCK = 12 << 20
NO_PAIR = np.iinfo(np.int32).max
#: White space of the tokenizer's normaliser.
SPACES = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Up to here all Unicode versions agree on what is a letter.
SETTLED = "\u02ff"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(extra)) for b in range(256)]


class Merges:
    """A vocabulary file's contents and exact merging by it."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        self.data, self.library = data, None
        model = spec["model"]
        self.vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.marks = tuple(k.encode() for k in self.special)
        size = 1 + max([*self.vocab.values(), *self.special.values()])
        self.strings = [""] * size
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.strings[i] = token
        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], np.int64)
        self.last = np.array([self.vocab[c + end] for c in letters], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = size
        keys = np.array([self.vocab[a] * size + self.vocab[b] for a, b in pairs], np.int64)
        self.into = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)

    # ------------------------------------------------------------ pieces
    def pieces(self, word: bytes) -> list[bytes | int]:
        """A word's pieces: bytes to be merged, or the id of a special token."""
        if word.isalpha():  # ASCII letters only
            return [word.lower()]
        text = word.decode("utf-8", "replace")
        if not any(m in word for m in self.marks):
            return self._split(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [*self._split(text[at:m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self._split(text[at:])

    def _split(self, text: str) -> list[bytes]:
        if text and max(text) > SETTLED and any(unicodedata.category(c) == "Cn" for c in text):
            return self._split_by_library(text)
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return [p.encode() for p in PIECES.findall(text)]

    def _split_by_library(self, text: str) -> list[bytes]:
        """Words with a character that Python's Unicode does not know: what it is,
        the library that wrote the vocabulary decides."""
        from tokenizers import Tokenizer

        if self.library is None:
            self.library = Tokenizer.from_str(self.data.decode())
            self.byte = {c: b for b, c in enumerate(byte_letters())}
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.byte[c] for c in p) for p, _ in pieces]

    # ----------------------------------------------------------- merging
    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_PAIR)

    def one(self, symbols: list[int]) -> list[int]:
        """A long piece: a heap of (rank, position) over a linked list."""
        n = len(symbols)
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        sym, table = list(symbols), self._table()
        heap = [(table[p], i, p) for i, p in enumerate(zip(sym, sym[1:])) if p in table]
        heapq.heapify(heap)
        while heap:
            r, i, pair = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if j >= n or (sym[i], sym[j]) != pair:
                continue
            sym[i], alive[j], nxt[i] = int(self.into[r]), False, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for a, b in ((prv[i], i), (i, nxt[i])):
                if a >= 0 and b < n and (p := (sym[a], sym[b])) in table:
                    heapq.heappush(heap, (table[p], a, p))
        return [s for s, ok in zip(sym, alive) if ok]

    @functools.lru_cache(maxsize=1)  # noqa: B019  one instance for each process
    def _table(self) -> dict[tuple[int, int], int]:
        return {(int(k) // self.size, int(k) % self.size): int(r) for k, r in zip(self.keys, self.ranks)}

    def merge(self, pieces: list[bytes | int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and their number for each."""
        raw = [b"\0" if isinstance(p, int) else p for p in pieces]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        if not len(raw):
            return np.zeros(0, np.int64), length
        flat = np.frombuffer(b"".join(raw), np.uint8)
        end = np.cumsum(length)
        sym = self.inner[flat]
        sym[end - 1] = self.last[flat[end - 1]]
        for k, p in enumerate(pieces):
            if isinstance(p, int):
                sym[end[k] - 1] = p
        owner = np.repeat(np.arange(len(raw)), length)
        done_owner, done_sym = [], []
        if (long := np.flatnonzero(length > LONG)).size:
            for k in long:
                got = self.one(sym[end[k] - length[k]:end[k]].tolist())
                done_owner.append(np.full(len(got), k))
                done_sym.append(np.array(got, np.int64))
            short = length[owner] <= LONG
            sym, owner = sym[short], owner[short]
        if sym.size:
            inside = np.append(owner[1:] == owner[:-1], False)
            rank = np.full(sym.size, NO_PAIR, np.int32)
            at = np.flatnonzero(inside)
            rank[at] = self.rank(sym[at], sym[at + 1])
        while sym.size:
            start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            size = np.diff(np.append(start, sym.size))
            best = np.minimum.reduceat(rank, start)
            live = np.repeat(best < NO_PAIR, size)
            if not live.all():  # words in which nothing is left to merge
                done_owner.append(owner[~live])
                done_sym.append(sym[~live])
                sym, owner, rank = sym[live], owner[live], rank[live]
                best, size = best[best < NO_PAIR], size[best < NO_PAIR]
                if not sym.size:
                    break
            at = np.flatnonzero(rank == np.repeat(best, size))
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])]  # the leftmost of each word
            sym[at] = self.into[rank[at]]
            kept = np.ones(sym.size, bool)
            kept[at + 1] = False
            new = np.cumsum(kept) - 1
            at, sym, owner, rank = new[at], sym[kept], owner[kept], rank[kept]
            for p in (at, at[at > 0] - 1):  # the new symbol's pairs
                right = np.minimum(p + 1, sym.size - 1)
                pair = (right > p) & (owner[right] == owner[p])
                rank[p] = np.where(pair, self.rank(sym[p], sym[right]), NO_PAIR)
        owner, sym = np.concatenate(done_owner), np.concatenate(done_sym)
        order = np.argsort(owner, kind="stable")
        return sym[order], np.bincount(owner, minlength=len(raw))

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and their number for each."""
        pieces, owner = [], []
        for k, w in enumerate(words):
            if w.isalpha():
                pieces.append(w.lower())
                owner.append(k)
            else:
                got = self.pieces(w)
                pieces += got
                owner += [k] * len(got)
        ids, size = self.merge(pieces)
        return ids, np.bincount(np.array(owner, np.int64), weights=size, minlength=len(words)).astype(np.int64)


# ------------------------------------------------------------ the lexicon
def compile_lexicon(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """A minimal acyclic transducer as the bytes of one file: seven lengths,
    then arc keys (state * 256 + byte, sorted), arc targets, arc numbers, final
    marks, offsets of outputs, outputs."""
    entries = sorted(entries)
    register: dict = {}
    states: list[dict[int, int]] = [{}]  # arcs by byte
    final = [False]

    def frozen(s: int) -> int:
        """The registered state that accepts the same suffixes."""
        key = (final[s], tuple(states[s].items()))
        return register.setdefault(key, s)

    path, last = [0], b""
    for word, _ in entries:
        common = len(os.path.commonprefix([word, last]))
        for depth in range(len(last), common, -1):
            states[path[depth - 1]][last[depth - 1]] = frozen(path[depth])
        del path[common + 1:]
        for c in word[common:]:
            states.append({})
            final.append(False)
            states[path[-1]][c] = len(states) - 1
            path.append(len(states) - 1)
        final[path[-1]] = True
        last = word
    for depth in range(len(last), 0, -1):
        states[path[depth - 1]][last[depth - 1]] = frozen(path[depth])

    keep, number = {0: 0}, {}
    stack, order = [0], []
    while stack:  # number the reachable states
        s = stack.pop()
        order.append(s)
        for t in states[s].values():
            if t not in keep:
                keep[t] = len(keep)
                stack.append(t)
    paths: dict[int, int] = {}
    todo = [(0, False)]
    while todo:  # words accepted from each state, children first
        s, ready = todo.pop()
        if ready:
            n = int(final[s])
            for c, t in sorted(states[s].items()):
                number[s, c] = n
                n += paths[t]
            paths[s] = n
        elif s not in paths:
            todo.append((s, True))
            todo += [(t, False) for t in states[s].values() if t not in paths]
    arcs = sorted((keep[s] * 256 + c, keep[t], number[s, c]) for s in order for c, t in states[s].items())
    marks = np.zeros(len(keep), np.int64)
    for s, k in keep.items():
        marks[k] = final[s]
    a = np.array(arcs, np.int64).reshape(-1, 3)
    offsets = np.cumsum([0, *(len(ids) for _, ids in entries)]).astype(np.int64)
    outputs = np.array([i for _, ids in entries for i in ids], np.int64)
    parts = [a[:, 0], a[:, 1], a[:, 2], marks, offsets, outputs]
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


class Lexicon:
    """The transducer, read from a memory-mapped file."""

    def __init__(self, path: str):
        data = np.memmap(path, np.int64, "r")
        bounds = 6 + np.cumsum([0, *data[:6].tolist()])
        self.keys, self.target, self.number, self.final, self.offset, self.output = (
            data[a:b] for a, b in zip(bounds, bounds[1:]))

    def index(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The number of each word of a byte array, or -1; all words take a step at once."""
        state = np.zeros(len(start), np.int64)
        number = np.zeros(len(start), np.int64)
        if not len(self.keys):
            return np.full(len(start), -1)
        live, step = np.flatnonzero(length > 0), 0
        state[length <= 0] = -1
        while live.size:
            key = state[live] * 256 + flat[start[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            state[live[~ok]] = -1
            live, at = live[ok], at[ok]
            state[live], number[live] = self.target[at], number[live] + self.number[at]
            step += 1
            live = live[length[live] > step]
        return np.where((state >= 0) & (self.final[np.maximum(state, 0)] > 0), number, -1)


def _load(broadcast) -> tuple[Merges, Lexicon]:
    key, vocabulary, lexicon = broadcast.value
    return mapped_file(key, lexicon, lambda path: (Merges(vocabulary), Lexicon(path)))


def frequent_words(docs: DataFrame, text: str = "text", min_share: float = MIN_SHARE) -> list[bytes]:
    """The words that are at least ``min_share`` of all words (of which there can
    be ``1 / min_share`` at most)."""
    def count(block: pa.RecordBatch) -> dict:
        flat, counts = words_of(block)
        n = flat.value_counts()
        # the empty word, which no text has, counts all
        return {"word": pa.concat_arrays([n.field("values").cast(pa.binary()), pa.array([b""], pa.binary())]),
                "n": pa.concat_arrays([n.field("counts"), pa.array([int(counts.sum())], pa.int64())])}

    spark = docs.sparkSession
    rows = map_blocks(id_text(docs, text, text).drop("doc_id"), "text", "word binary, n long", count, COUNT_BLOCK)
    path = write_scratch(rows.groupBy("word").agg(F.sum("n").alias("n")), "word_counts")
    counts = spark.read.parquet(path)
    total = counts.where(F.octet_length("word") == 0).agg(F.sum("n")).first()[0] or 0
    found = counts.where((F.octet_length("word") > 0) & (F.col("n") >= min_share * total)).select("word").toArrow()
    drop_scratch(spark, path)
    return found["word"].to_pylist()


def encode_decode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                  min_share: float = MIN_SHARE) -> DataFrame:
    """(doc_id, ids, decoded): ids as the tokenizer file gives them, and their
    decoding (token strings joined by a space, special tokens included)."""
    with open(path, "rb") as f:
        vocabulary = f.read()
    merges = Merges(vocabulary)
    words = frequent_words(docs, text, min_share)
    ids, size = merges.encode_words(words)
    cut = np.split(ids, np.cumsum(size)[:-1]) if words else []
    broadcast = docs.sparkSession.sparkContext.broadcast(
        (new_key(), vocabulary, compile_lexicon([(w, c.tolist()) for w, c in zip(words, cut)])))

    def run(block: pa.RecordBatch) -> dict:
        merges, lexicon = _load(broadcast)
        flat, counts = words_of(block)
        coded = flat.dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        length = np.fromiter(map(len, distinct), np.int64, len(distinct))
        data = np.frombuffer(b"".join(distinct), np.uint8)
        found = lexicon.index(data, np.cumsum(length) - length, length)
        unseen = np.flatnonzero(found < 0)
        new, new_size = merges.encode_words([distinct[k] for k in unseen])
        # where each distinct word's ids are: in the lexicon's outputs or behind them
        begin, size = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        known = found[found >= 0]
        begin[found >= 0], size[found >= 0] = lexicon.offset[known], lexicon.offset[known + 1] - lexicon.offset[known]
        size[unseen], begin[unseen] = new_size, len(lexicon.output) + np.cumsum(new_size) - new_size
        pool = np.concatenate((lexicon.output, new)).astype(np.int32)
        n = size[codes]
        total = np.cumsum(n)
        ids = pool[np.repeat(begin[codes] - (total - n), n) + np.arange(total[-1] if len(total) else 0)]
        cut = np.concatenate(([0], np.cumsum(counts)))
        bounds = np.concatenate(([0], total))[cut]
        of_text = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
        return {"doc_id": block.column("doc_id"), "ids": of_text, "decoded": decode(of_text, merges.strings)}

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, ids array<int>, decoded string"
    return map_blocks(id_text(docs, doc_id, text), "text", schema, run, BLOCK)


def decode(ids: pa.ListArray, strings: list[str]) -> pa.Array:
    """Each text's token strings joined by a space."""
    tokens = pa.array(strings).take(ids.flatten())
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens), " ")
