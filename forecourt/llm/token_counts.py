"""Token counts of whole texts by a public tokenizer.

Texts are encoded in batches inside Arrow functions that return lengths only: no
id leaves a task.  All texts are split at safe boundaries, where the tokenizer starts
a new word whatever stands around, so the counts of the pieces add up to that of
the text.  ``boundaries`` finds those of a block in its bytes; each distinct piece
of a block is encoded once.  A piece that is still long is split by ``pieces``;
``batches`` groups what is to be encoded into batches of about ``BATCH_BYTES``.  There
is no shuffle: a hot source or a group of copies is dealt as the files are, and a
lost task is simply run again.

Safe boundaries are known for byte-level vocabularies with the usual word
pattern (letters, digits, other symbols, white space, contractions), no
normaliser and no prefix space: before a blank that follows another character
than white space, and, in long pieces, between the end mark of a sentence in Chinese
or Japanese and a letter or digit.  A run without a boundary stays whole, as do all
texts of other vocabularies.

Nulls and empty texts have 0 bytes and 0 tokens; null ids, ties and repeated rows
give one row each; an empty table gives an empty result; extra columns are not
read.  The tokenizer's file is read on the driver and broadcast: its size is that
of the vocabulary, whatever the data.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from forecourt.llm.common import id_text, map_blocks, new_key, texts

#: Texts over this many characters are split, and a batch holds about so many bytes.
PIECE_CHARS = 64 << 10
BATCH_BYTES = 512 << 10
#: Where a word surely ends; neither place lies inside a special string without blanks.
SAFE = re.compile(r"(?<=\S)(?=[ \n\t\r])|(?<=[。！？])(?=[^\W_])")

_LOADED: dict = {}


def pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """``text`` in parts of ``size`` characters or somewhat more, cut at safe boundaries."""
    out, a = [], 0
    while len(text) - a > size:
        found = SAFE.search(text, a + max(size, 1))
        if not found:
            break
        out.append(text[a:found.start()])
        a = found.start()
    out.append(text[a:])
    return out


def batches(parts: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """``parts`` in order, in groups of nearly equal bytes (about ``limit``)."""
    sizes = np.cumsum([len(p.encode()) for p in parts], dtype=np.int64)
    if not len(sizes):
        return
    n = max(1, round(int(sizes[-1]) / limit))
    cuts = np.searchsorted(sizes, sizes[-1] * np.arange(1, n) / n)
    for chunk in np.split(np.arange(len(parts)), np.unique(cuts)):
        if len(chunk):
            yield parts[chunk[0]:chunk[-1] + 1]


def boundaries(raw: np.ndarray) -> np.ndarray:
    """Places of the blanks in UTF-8 bytes that follow another character than white space.

    Of characters beyond ASCII, those with the last bytes of a Unicode space count as one."""
    at = np.flatnonzero(raw == 0x20)
    at = at[at > 0]
    last, second, third = (raw[np.maximum(at - k, 0)] for k in (1, 2, 3))
    space = (second == 0xC2) & ((last == 0x85) | (last == 0xA0))  # next line, no-break space
    space |= (third == 0xE1) & (second == 0x9A) & (last == 0x80)  # ogham space
    space |= (third == 0xE2) & ((second == 0x80) | (second == 0x81))  # the general punctuation spaces
    space |= (third == 0xE3) & (second == 0x80) & (last == 0x80)  # ideographic space
    return at[(last > 0x20) & (last != 0x7F) & ~space]


def splits_safely(vocabulary: bytes) -> bool:
    """Whether ``SAFE`` holds for a ``.json`` vocabulary."""
    parts = json.loads(vocabulary)
    before = parts.get("pre_tokenizer") or {}
    return (not parts.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
            and not any(t["lstrip"] or t["rstrip"] or SAFE.search(t["content"]) for t in parts.get("added_tokens", [])))


def loaded(key: str, kind: str, data: bytes) -> tuple[Callable[[list[str]], list[int]], bool]:
    """The function from texts to lengths, made once in a worker, and whether texts may be split."""
    if key not in _LOADED:
        _LOADED.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        if kind == ".model":
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_proto=data)
            _LOADED[key] = (lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]), False
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_str(data.decode())
            model.no_truncation()
            model.no_padding()
            _LOADED[key] = ((lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]),
                            splits_safely(data))
    return _LOADED[key]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; ``vocabulary`` is a ``.json`` or ``.model`` file."""
    with open(vocabulary, "rb") as f:
        data = f.read()
    key, kind, sent = new_key(), os.path.splitext(vocabulary)[1], docs.sparkSession.sparkContext.broadcast(data)

    def counted(lengths: Callable, split: bool, texts: list[str]) -> np.ndarray:
        parts, owner = [], []
        for i, t in enumerate(texts):
            cut = pieces(t) if split else [t]
            parts += cut
            owner += [i] * len(cut)
        found = [n for batch in batches(parts) for n in lengths(batch)]
        return np.bincount(np.asarray(owner, np.int64), weights=found, minlength=len(texts)).astype(np.int64)

    def count(block: pa.RecordBatch) -> dict:
        lengths, split = loaded(key, kind, sent.value)
        column = pc.fill_null(block.column("text"), "").cast(pa.large_string())
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
        if split:
            offsets = np.concatenate(([0], np.cumsum(sizes)))
            raw = np.frombuffer(b"".join(texts(block)), np.uint8)
            cuts = np.unique(np.concatenate((offsets, boundaries(raw))))
            coded = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(raw)).dictionary_encode()
            each = counted(lengths, True, coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
            sums = np.concatenate(([0], np.cumsum(each)))
            totals = np.diff(sums[np.searchsorted(cuts, offsets)])
        else:
            totals = counted(lengths, False, column.to_pylist())
        return {"doc_id": block.column("doc_id"), "n_bytes": sizes.astype(np.int64), "n_tokens": totals}

    source = id_text(docs, id_col, text)
    return map_blocks(source, "text", f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long", count)
