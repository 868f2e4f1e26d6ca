"""URL rules in a sorted digest array.

A rule is a host and a path, ``host/path``.  It fits its host and all
subdomains if the url's path starts with the rule's; the longest rule wins.
The XXH64 values of all rules are kept sorted in one file beside the full
strings; a worker maps the file into memory.  For every url the possible rules
(each suffix of the host at a label's border, with each of the path lengths
that occur in rules) are hashed, a whole batch is probed by one binary search,
and every hit is confirmed by the stored string, so a collision cannot match.

Urls that no rule fits get the method's own verdict by the same array: a
block term as one of the words of the host blocks, anything else is allowed.

* host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
  lower-cased; path: from there up to ``?``, ``#`` or the end.  Null or no
  ``://``: both empty, so no rule fits.
* of several verdicts for one rule string the last one given holds.
* empty rules, empty tables, repeated rows and extra columns need no care.

The rules are a stated list; their bytes are checked against ``MAX_BYTES``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import map_blocks, mapped_file, new_key

MAX_BYTES = 512 << 20
#: Words of a host that the method blocks without a rule.
BLOCK_TERMS = ("casino", "poker", "porn", "viagra", "xxx")
SCHEMA = "page_id {id}, host string, path string, rule string, verdict string"


def compile_digests(strings: Iterable[str]) -> bytes:
    """The strings as one file: their number, sorted 64-bit digests, ends and
    order of the strings, and the strings themselves."""
    raw = sorted(set(s.encode() for s in strings))
    digest = np.array([xxhash.xxh64_intdigest(s) for s in raw], np.uint64)
    order = np.argsort(digest, kind="stable")
    ends = np.cumsum([len(raw[k]) for k in order], dtype=np.int64) if raw else np.zeros(0, np.int64)
    return b"".join([np.array([len(raw)], np.int64).tobytes(), digest[order].tobytes(), ends.tobytes(),
                     b"".join(raw[k] for k in order)])


class Digests:
    """A compiled file, mapped into memory."""

    def __init__(self, path: str):
        n = int(np.fromfile(path, np.int64, 1)[0])
        data = np.memmap(path, np.uint8, "r")
        self.keys = data[8:8 + 8 * n].view(np.uint64)
        self.ends = data[8 + 8 * n:8 + 16 * n].view(np.int64)
        self.text = data[8 + 16 * n:]

    def contains(self, strings: list[bytes]) -> np.ndarray:
        """Which of the strings are stored: binary search, then the full string."""
        found = np.zeros(len(strings), bool)
        if not len(self.keys) or not strings:
            return found
        probe = np.fromiter(map(xxhash.xxh64_intdigest, strings), np.uint64, len(strings))
        at = np.searchsorted(self.keys, probe)
        hit = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == probe))
        for k in hit:
            i = at[k]
            while i < len(self.keys) and self.keys[i] == probe[k]:  # equal digests lie together
                if self.text[self.ends[i - 1] if i else 0:self.ends[i]].tobytes() == strings[k]:
                    found[k] = True
                    break
                i += 1
        return found


def split_url(url: str | None) -> tuple[str, str]:
    m = re.search(r"://([^/?#]*)([^?#]*)", url) if url else None
    return (m[1].translate(_LOWER), m[2]) if m else ("", "")


_LOWER = {c: c + 32 for c in range(65, 91)}


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]], page_id: str = "page_id", url: str = "url",
          block_terms: Iterable[str] = BLOCK_TERMS) -> DataFrame:
    """One row per page; ``rules`` are (verdict, ``host/path``)."""
    verdicts = {rule: verdict for verdict, rule in rules}
    lengths = sorted({len(r) - r.index("/") for r in verdicts})
    # a rule has a slash, a term has none: one array holds both
    data = compile_digests([*verdicts, *block_terms])
    if len(data) > MAX_BYTES:
        raise ValueError(f"{len(data)} bytes of url rules; the bound of a broadcast is {MAX_BYTES}")
    broadcast = pages.sparkSession.sparkContext.broadcast((new_key(), data, verdicts, lengths))

    def run(block: pa.RecordBatch) -> dict:
        key, data, verdicts, lengths = broadcast.value
        digests = mapped_file(key, data, Digests)
        parts = [split_url(u) for u in block.column("text").to_pylist()]
        owner, probes = [], []
        for k, (host, path) in enumerate(parts):
            at, suffixes = -1, []
            while host:
                suffixes.append(host[at + 1:])
                if (at := host.find(".", at + 1)) < 0:
                    break
            new = [s + path[:n] for s in suffixes for n in lengths if n <= len(path)]
            new += re.split(r"[.\-_:]", host)
            probes += new
            owner += [k] * len(new)
        rule, term = [None] * len(parts), [False] * len(parts)
        for i in np.flatnonzero(digests.contains([p.encode() for p in probes])):
            k, p = owner[i], probes[i]
            if p not in verdicts:
                term[k] = True
            elif rule[k] is None or len(p) > len(rule[k]):
                rule[k] = p
        return {"page_id": block.column("page_id"), "host": [h for h, _ in parts], "path": [p for _, p in parts],
                "rule": rule, "verdict": [verdicts[r] if r is not None else "block" if t else "allow" for r, t in zip(rule, term)]}

    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("text"))
    return map_blocks(rows, "text", SCHEMA.format(id=pages.schema[page_id].dataType.simpleString()), run)
