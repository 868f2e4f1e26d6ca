"""Merkle manifest, phrase collocations and token counts against plain Python, on odd inputs."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forecourt.llm import collocations, merkle_manifest, token_counts

NAMES = ["grp", "leaf", "place", "key", "n", "phrase", "f", "h", "start", "size", "root"]
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = "a <|endoftext|> b<|endoftext|>c <| endoftext|>"
LONG = " ".join(f"w{i % 97}, é{i % 13}。中文{i}" for i in range(6000))
TEXTS = [None, "", " \n\t ", "one two", "one two", "I'll  don't  x\r\n\r\n y ", SPECIAL, LONG, "x" * 50_000, "a\x85 b 　 c\x1c d"]


def frame(spark, rows):
    """(doc_id, lang, text) with extra columns whose names operators use inside."""
    return spark.createDataFrame([(*r, *(["extra"] * len(NAMES))) for r in rows],
                                 "doc_id long, lang string, text string, " + ", ".join(f"{n} string" for n in NAMES))


def listed(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ------------------------------------------------------------------- op11
def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves, run):
    """Root and, for each leaf, its siblings."""
    proofs, level, below = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        runs = [list(range(a, min(a + run, len(level)))) for a in range(0, len(level), run)]
        for r in runs:
            for k in r:
                for leaf in below[k]:
                    proofs[leaf] += [level[j] for j in r if j != k]
        level, below = [sha(*(level[k] for k in r)) for r in runs], [sum((below[k] for k in r), []) for r in runs]
    return level[0], proofs


@pytest.mark.parametrize("run", [2, 3])
def test_tree_and_fold(run):
    for size in [*range(1, 40), 81, 128]:
        leaves = [sha(str(i)) for i in range(size)]
        tree = merkle_manifest.Tree(run)
        for x in leaves:
            tree.append(x)
        root, proofs = brute_tree(leaves, run)
        assert tree.close(None) == root
        assert [merkle_manifest.siblings_of(bytes(w)) for w in tree.witness] == proofs
        for i, x in enumerate(leaves):
            assert merkle_manifest.fold(x, i, size, proofs[i], run) == (root, len(proofs[i]))


@pytest.mark.parametrize("run,levels", [(2, 3), (3, 2)])
def test_manifest(spark, run, levels):
    rng = random.Random(run)
    rows = [(i, "hot", f"text {i}") for i in range(70)] + [(100 + i, lang, t) for i, t in enumerate(TEXTS) for lang in (None, "", "é")]
    rows += [(200, "one", "alone"), (None, "hot", "no id"), (None, "hot", "no id"), (3, "hot", "tie"), (3, "hot", "tie"), (4, "hot", None)]
    rng.shuffle(rows)
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, g, t: sha(field(i), field(g), field(t))
    groups = collections.defaultdict(list)
    for i, g, t in rows:
        groups[g].append((i is not None, i or 0, leaf(i, g, t), i))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: brute_tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], run) for g in order}
    root, above = brute_tree([trees[g][0] for g in order], run)
    expected = [(x[3], x[2], trees[g][0], root, sha(*(proof + above[k]))) for k, g in enumerate(order)
                for x, proof in zip(sorted(groups[g], key=lambda x: x[:3]), trees[g][1])]
    wrong = F.when(F.col("doc_id") % 2 == 0, F.lit(sha("wrong")))
    docs = frame(spark, rows)
    found = merkle_manifest.verify(merkle_manifest.manifest(docs, "lang", "doc_id", ["doc_id", "lang", "text"], wrong, run, levels), run)
    assert listed(found, "key", "leaf", "subroot", "root", "proof_sha256") == sorted(expected, key=repr)
    assert {(r.key is not None and r.key % 2 == 0, r.folded_root == root) for r in found.collect()} == {(True, False), (False, True)}
    assert merkle_manifest.manifest(docs.where("false"), "lang", "doc_id", ["doc_id"]).count() == 0


# ------------------------------------------------------------------- op12
def brute_phrases(rows, least, percent, first):
    counts, words = collections.Counter(), collections.Counter()
    for _, lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall("[^\x20\x09]+", piece)
            words["und" if lang is None else lang] += len(w)
            for n in (1, 2, 3):
                counts.update(("und" if lang is None else lang, tuple(w[k:k + n])) for k in range(len(w) - n + 1))
    out = collections.defaultdict(list)
    frequent = {p: f for p, f in counts.items() if len(p[1]) > 1 and f >= least}
    for (lang, w), a in frequent.items():
        cuts = [(10 ** 6 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        dropped = any(m == lang and len(v) > len(w) and 100 * f >= percent * a and any(v[i:i + len(w)] == w for i in range(len(v)))
                      for (m, v), f in frequent.items())
        if not dropped:
            out[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted(((lang, i, p.decode(), -a, l, r, words[lang], -s) for lang, found in out.items()
                   for i, (s, a, p, l, r) in enumerate(sorted(found)[:first], 1)), key=repr)


@pytest.mark.parametrize("shards,slots", [(2, 1 << 16), (4, 64)])
def test_collocations(spark, shards, slots, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 500)  # texts are cut between pieces
    rng = random.Random(7)
    vocabulary = ["The", "the", "deep", "blue", "sea", "é", "x y", "a|b", "ÄB"]
    rows = [(i, rng.choice(["en", "en", None, "und", ""]), " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", "\n", "\t", " "])
                                                                     for _ in range(rng.randrange(60)))) for i in range(120)]
    rows += [(None, None, None), (1, "en", ""), (2, "en", " ,. "), (3, "en", "rare words once"), (4, "de", "deep blue sea " * 12)]
    rows += [(5, "en", "deep blue sea, the deep blue sea")] * 15
    docs = frame(spark, rows)
    found = collocations.collocations(docs, first=25, shards=shards, slots=slots)
    assert listed(found, "lang", "rank", "phrase", "a", "l", "r", "n", "score") == brute_phrases(rows, 10, 50, 25)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(frame(spark, [(1, "en", None), (2, None, "")]), slots=64, shards=1).count() == 0


def test_marks_take_few_jobs(spark):
    h = np.arange(1, 2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = [(k, 1, 0, b"", b"", part.tobytes()) for k, part in enumerate(np.array_split(h, 20))]
    state, arrays = spark.createDataFrame(rows, collocations.COUNTED), [np.full(1 << 21, collocations.NEVER, np.uint8)]
    conf, context = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}, spark.sparkContext
    before = {k: spark.conf.get(k) for k in conf}
    context.setJobGroup("marks", "")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert collocations.mark(state, 3, arrays) == {1}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        context.setLocalProperty("spark.jobGroup.id", None)
    mask = np.uint64((1 << 21) - 1)
    assert set(np.flatnonzero(arrays[0] == 3)) == {int(x) for x in [*(h & mask), *((h >> np.uint64(32)) & mask)]}
    assert len(context.statusTracker().getJobIdsForGroup("marks")) < 10


def test_phrases_of_four_words(spark):
    docs = frame(spark, [(i, "en", "a b c d e" if i % 2 else "a b c d") for i in range(12)])
    found = {r.phrase: r.f for r in collocations.frequent(docs, longest=4, shards=2, slots=1 << 10).where("n > 0").collect()}
    w = "abcd"
    assert found == {" ".join(w[i:j]): 12 for i in range(4) for j in range(i + 1, 5)}


# ------------------------------------------------------------------- op13
def test_token_counts(spark, monkeypatch):
    library = Tokenizer.from_file(BYTES)
    rows = [(i, "en", t) for i, t in enumerate(TEXTS)] + [(None, None, "null id"), (3, "en", "one two")]
    expected = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, _, t in rows), key=repr)
    docs = frame(spark, rows)
    assert listed(token_counts.count_tokens(docs, BYTES), "doc_id", "n_bytes", "n_tokens") == expected
    monkeypatch.setattr(token_counts, "PIECE_CHARS", 50)
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 300)
    assert listed(token_counts.count_tokens(docs, BYTES), "doc_id", "n_bytes", "n_tokens") == expected
    assert token_counts.count_tokens(docs.where("false"), BYTES).count() == 0


def test_token_counts_other_vocabularies(spark):
    from sentencepiece import SentencePieceProcessor

    docs = frame(spark, [(i, "en", t) for i, t in enumerate(TEXTS)])
    words, path = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), public_tokenizers.path("piece_bpe_32k.model")
    assert not token_counts.splits_safely(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())
    got = listed(token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")), "doc_id", "n_tokens")
    assert got == sorted((i, len(words.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(TEXTS))
    model = SentencePieceProcessor(model_file=path)
    got = listed(token_counts.count_tokens(docs, path), "doc_id", "n_tokens")
    assert got == sorted((i, len(model.encode(t or ""))) for i, t in enumerate(TEXTS))


LIBRARY = Tokenizer.from_file(BYTES)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "'s", "'", "12", "½", "。", "中", " ", "  ", "\n", "\r\n", "\t", " ", "　", "\x1c",
                                 "<|endoftext|>", "|>", "!", "！", "é", "é", "_", "😀"]), max_size=40), st.integers(0, 5))
def test_safe_boundaries(parts, size):
    text = "".join(parts)
    cut = token_counts.pieces(text, size)
    assert "".join(cut) == text
    count = lambda t: len(LIBRARY.encode(t, add_special_tokens=False).ids)
    assert sum(map(count, cut)) == count(text)
    assert [x for b in token_counts.batches(cut, 7) for x in b] == cut or not text
