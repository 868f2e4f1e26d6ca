"""Benchmark decontamination with one Aho-Corasick automaton.

All windows of ``window`` consecutive words of the test items (an item with
fewer words, but not none, is one window) form one automaton.  A document is
normalised bytewise (A-Z lower-cased, every other ASCII non-word byte a space),
its words joined by single spaces and scanned once.  As the mapping keeps the
length of the text, a hit word's offset in the original is its offset in the
mapped text, found for documents with hits only.

* null text: no words, not contaminated; items of null text or id never match.
* empty benchmark: every document is clean.
* texts of any length are scanned whole; repeated rows are judged each; an empty table
  gives no rows; other columns are not read, and stay in ``drop_contaminated``.
* repeated items: each id counts once; equal windows of several items hit all.
* the benchmark is a stated query set: the driver reads its windows in parts of
  at most ``PART_BYTES`` of text, each one automaton and one broadcast, so the
  size of a broadcast is bounded whatever the benchmark; a task holds one
  automaton at a time and the results of the parts are merged for each document.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import id_text, keep_rows, map_blocks, new_key, texts

WINDOW = 10
PART_BYTES = 32 << 20
#: Word bytes stay (A-Z lower-cased), all others become a space.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCHEMA = ("doc_id {id}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "items array<string>, spans array<struct<start:long,end:long>>")

_AUTOMATA: dict = {}  # one automaton per worker process


def words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def windows(text: bytes, window: int) -> set[bytes]:
    w = words(text)
    return {b" ".join(w[i:i + window]) for i in range(max(1, len(w) - window + 1))} if w else set()


def window_parts(benchmark: DataFrame, item_id: str, text: str, window: int) -> list[dict[bytes, list[str]]]:
    """The windows with the items that have them, in parts of bounded size."""
    parts, size = [defaultdict(list)], 0
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"),
                            F.col(f"`{text}`").cast("string").alias("text"))
    for row in rows.where("item is not null and text is not null").toLocalIterator():
        found = windows(row.text.encode(), window)
        grown = sum(map(len, found))
        if size and size + grown > PART_BYTES:
            parts.append(defaultdict(list))
            size = 0
        size += grown
        for w in found:
            parts[-1][w].append(row.item)
    return [dict(p) for p in parts if p]


def automaton(key: str, part: dict[bytes, list[str]]):
    """The automaton of a part; a worker keeps the last one."""
    import ahocorasick

    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        a = ahocorasick.Automaton()
        for w, items in part.items():
            # latin-1: one character for each byte, so offsets count bytes
            a.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, items))
        a.make_automaton()
        _AUTOMATA[key] = a
    return _AUTOMATA[key]


def hits(a, joined: bytes) -> tuple[list[tuple[int, int]], set[str]]:
    """Hit word ranges [first, end) and items of a text of single-spaced words."""
    ranges, items = [], set()
    space = None
    for at, (n, ids) in a.iter(f" {joined.decode('latin-1')} "):
        if space is None:
            space = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        end = int(np.searchsorted(space, at - 1)) + 1  # words that end at or before the match's last space
        ranges.append((end - n, end))
        items.update(ids)
    return ranges, items


def scan(block: pa.RecordBatch, parts: list) -> list[tuple[list[bytes], np.ndarray, set[str]]]:
    """For each text: its words, the hit mask (None: no hit) and the items."""
    all_words = [words(t) for t in texts(block)]
    masks: list = [None] * len(all_words)
    items: list[set[str]] = [set() for _ in all_words]
    for broadcast in parts:
        a = automaton(*broadcast.value)
        for k, w in enumerate(all_words):
            ranges, found = hits(a, b" ".join(w))
            if ranges:
                if masks[k] is None:
                    masks[k] = np.zeros(len(w), bool)
                for x, y in ranges:
                    masks[k][x:y] = True
                items[k] |= found
    return list(zip(all_words, masks, items))


def spans(text: bytes, mask: np.ndarray) -> list[dict]:
    """Byte spans in the original text of maximal runs of hit words."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(NORMAL))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in zip(edges[::2], edges[1::2])]


def _broadcast(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, window: int) -> list:
    sc = docs.sparkSession.sparkContext
    return [sc.broadcast((new_key(), p)) for p in window_parts(benchmark, item_id, item_text, window)]


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: counts, items and byte spans of what was hit."""
    parts = _broadcast(docs, benchmark, item_id, item_text, window)
    rows = id_text(docs, doc_id, text)

    def judge(block: pa.RecordBatch) -> dict:
        found = scan(block, parts)
        raw = texts(block)
        names = [sorted(i) for _, _, i in found]
        n_hit = [0 if m is None else int(m.sum()) for _, m, _ in found]
        return {"doc_id": block.column("doc_id"), "n_words": [len(w) for w, _, _ in found], "n_hit": n_hit,
                "n_items": [len(i) for i in names],
                "items_sha256": [hashlib.sha256(",".join(i).encode()).hexdigest() for i in names],
                "contaminated": [n > 0 for n in n_hit], "items": names,
                "spans": [[] if m is None else spans(raw[k], m) for k, (_, m, _) in enumerate(found)]}

    return map_blocks(rows, "text", SCHEMA.format(id=docs.schema[doc_id].dataType.simpleString()), judge)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Documents without a hit word, all columns kept (null text stays)."""
    parts = _broadcast(docs, benchmark, item_id, item_text, window)
    return keep_rows(docs, text, lambda block: np.array(
        [m is None for _, m, _ in scan(block.select([text]).rename_columns(["text"]), parts)], bool))
