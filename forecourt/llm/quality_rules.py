"""Quality rules: counts of a text and its repeated passages by a suffix array.

The words of a block get dense codes for each (text, word), so that two
suffixes tie only within a text, and are sorted by prefix doubling: after the
round of length k all suffixes are ranked by their first 2k words and only
tied ones are sorted again.  The ranks of all rounds give the longest common
prefix of neighbours in the suffix array by descending lengths.  A suffix's
longest repeat is the longer of its two neighbouring prefixes; where it has at
least ``min_words`` words, its span is part of a maximal repeated substring.
The union of the spans is the covered part of the text.  A text is rejected if
the covered fraction of its words is over ``max_covered`` or the longest repeat
has more than ``max_longest`` words.

Base counts (words ``[^\\x20\\x09-\\x0D]+``): code points in words, symbols, lines
that repeat an earlier one, words in three-word windows found more than once.
A text fails the base rules with under 50 words, or over half of its words in
repeated windows.

* null or empty text: no words, all counts 0, base_failed, not kept.
* a text of any length is sorted whole; blocks are cut between texts only.
* repeated rows, extra columns and empty tables need no special case.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from forecourt.llm.common import WHITE, id_text, keep_rows, map_blocks, texts, words_of

MIN_WORDS = 50
MAX_REPEATED_SHARE = 0.5
WINDOW = 3
SYMBOLS = b"#*$%&|<>"
MIN_REPEAT, MAX_COVERED, MAX_LONGEST = 6, 0.3, 60
SCHEMA = ("doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered_words long, n_repeats long, longest_repeat long, repeat_start long, base_failed boolean, kept boolean")


def suffix_array(codes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of word codes that differ between texts, and the longest
    common prefix of each suffix with its predecessor."""
    n = len(codes)
    end = np.searchsorted(text, text, side="right")  # text ids ascend
    order = np.argsort(codes, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1

    def spread(sorted_pos: np.ndarray, new: np.ndarray, base: np.ndarray) -> None:
        """Rank of a tie: where it begins."""
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        rank[sorted_pos] = base[first]

    new = np.append(True, codes[order[1:]] != codes[order[:-1]]) if n else np.zeros(0, bool)
    spread(order, new, np.arange(n))
    levels, k = [], 1
    while True:
        levels.append(rank.astype(np.int32))
        sorted_rank = rank[order]
        same = sorted_rank[1:] == sorted_rank[:-1]
        at = np.flatnonzero(np.append(False, same) | np.append(same, False))  # tied places
        if not at.size:
            break
        pos = order[at]
        second = np.where(pos + k < end[pos], rank[np.minimum(pos + k, n)] + 1, 0)
        key = rank[pos] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[at] = pos[by]
        key = key[by]
        spread(order[at], np.append(True, key[1:] != key[:-1]), at)
        k *= 2
    a, b = order[:-1], order[1:]
    lcp = np.zeros(n, np.int64)
    near = np.flatnonzero(codes[a] == codes[b]) if n else np.zeros(0, np.int64)
    a, b, common = a[near], b[near], np.zeros(len(near), np.int64)
    for level in reversed(range(len(levels))):
        r = levels[level]
        common += np.where(r[a + common] == r[b + common], 1 << level, 0)
    lcp[near + 1] = common
    return order, lcp


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Words inside a span [i, i + longest[i]) of at least ``least`` words."""
    at = np.flatnonzero(longest >= least)
    mark = np.zeros(len(longest) + 1, np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + longest[at], -1)
    return np.cumsum(mark[:-1]) > 0


def measure(block: pa.RecordBatch, name: str = "text", min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """Counts of every text of a block."""
    flat, n_words = words_of(block, name)
    n, m = len(n_words), len(flat)
    text = np.repeat(np.arange(n), n_words)
    word = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.unique(text * (m + 1) + word, return_inverse=True)[1].astype(np.int64)
    order, lcp = suffix_array(codes, text)
    longest = np.zeros(m, np.int64)  # the longest repeat that begins at a word
    longest[order] = np.maximum(lcp, np.append(lcp[1:], 0)) if m else 0
    in_text = lambda mask: np.bincount(text[mask], minlength=n)
    # lcp intervals at the least length: runs of neighbours that share it
    opens = (lcp >= min_repeat) & (np.append(0, lcp)[:m] < min_repeat)
    first = np.append(0, np.cumsum(n_words))[:-1]
    top, where = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if m:
        filled = n_words > 0
        top[filled] = np.maximum.reduceat(longest, first[filled])
        at = np.flatnonzero(longest == top[text])
        t, i = np.unique(text[at], return_index=True)
        where[t] = at[i] - first[t]
    chars, symbols, lines = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k, raw in enumerate(texts(block, name)):
        solid = raw.translate(None, WHITE)
        symbols[k] = len(solid) - len(solid.translate(None, SYMBOLS))
        chars[k] = len(solid.decode("utf-8", "replace")) if not solid.isascii() else len(solid)
        if b"\n" in raw:
            filled = [x for x in raw.split(b"\n") if x.strip(WHITE)]
            lines[k] = len(filled) - len(set(filled))
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines,
            "n_repeat_words": in_text(covered(np.minimum(longest, WINDOW), WINDOW)) if m else np.zeros(n, np.int64),
            "covered_words": in_text(covered(longest, min_repeat)) if m else np.zeros(n, np.int64),
            "n_repeats": in_text(order[opens]) if m else np.zeros(n, np.int64),
            "longest_repeat": top, "repeat_start": where}


def verdict(c: dict[str, np.ndarray], max_covered: float, max_longest: int) -> tuple[np.ndarray, np.ndarray]:
    n = c["n_words"]
    failed = (n < MIN_WORDS) | (c["n_repeat_words"] > MAX_REPEATED_SHARE * n)
    return failed, ~failed & (c["covered_words"] <= max_covered * n) & (c["longest_repeat"] <= max_longest)


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_repeat: int = MIN_REPEAT,
            max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row per document: base counts, repeats and the verdict.  The longest
    repeat's first occurrence begins at word ``repeat_start``."""
    def run(block: pa.RecordBatch) -> dict:
        c = measure(block, min_repeat=min_repeat)
        failed, kept = verdict(c, max_covered, max_longest)
        return {"doc_id": block.column("doc_id"), "base_failed": pa.array(failed), "kept": pa.array(kept),
                **{k: pa.array(v) for k, v in c.items()}}

    return map_blocks(id_text(docs, doc_id, text), "text",
                      SCHEMA.format(id=docs.schema[doc_id].dataType.simpleString()), run)


def keep_good(docs: DataFrame, text: str = "text", min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
              max_longest: int = MAX_LONGEST) -> DataFrame:
    """The documents that pass, all columns as they were."""
    return keep_rows(docs, text, lambda b: verdict(measure(b, text, min_repeat), max_covered, max_longest)[1])
