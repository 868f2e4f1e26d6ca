"""Operators with exact results against plain Python, on odd inputs."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from forecourt.llm import bpe_lexicon, decontamination, html_wrappers, quality_rules, simhash, suffix_lm, url_filter, warc
from forecourt.llm.queries import digests

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
COPY = "the quick brown fox jumps over the lazy dog and runs far away from here today"
TEXTS = [None, "", "  \n\t ", COPY, COPY, COPY.upper(), COPY + " then stops", "a a a a a a a a", "one", "one two",
         "line one is here\nline one is here\n\n  \nother\nline one is here", LONG, "x" * 20_000, "né né né É ß İ Σ",
         "#$% && || <b> *bold* <|endoftext|> 's I'll 12½", "a\x85b\xa0c d"]


def frame(spark, texts, **more):
    """Documents with extra columns whose names operators use inside."""
    names = ["doc_id", "text", "fp", "score", "n", "word", "place", "key", "kept", "host", "best", "x", "y", "block"]
    rows = [(i, t, *([f"extra{i}"] * 12)) for i, t in enumerate(texts)]
    rows += [(3, TEXTS[3], *(["extra3"] * 12)), (None, "null id here", *([None] * 12))]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[2:]))


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, TEXTS).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def as_list(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ------------------------------------------------------------------- op2
def test_decontamination(spark, docs, rows):
    items = [(1, "quick brown fox jumps over the lazy dog and runs far"), (2, "one two"), (3, None), (4, ""), (10, "NÉ né"),
             (None, "one"), (1, "one two")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    got = decontamination.contamination(docs, bench)
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    grams = collections.defaultdict(set)
    for i, t in items:
        w = words.findall(lower(t or "")) if i is not None else []
        for k in range(max(1, len(w) - 9) if w else 0):
            grams[tuple(w[k:k + 10])].add(str(i))
    expected = []
    for i, t in rows:
        w, hit, found = words.findall(lower(t or "")), set(), set()
        for g, ids in grams.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found |= ids
        expected.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert as_list(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(expected, key=repr)
    span = {r.doc_id: r for r in got.collect()}[3]
    assert [COPY.encode()[s.start:s.end] for s in span.spans] == [b"quick brown fox jumps over the lazy dog and runs far"]
    left = decontamination.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert as_list(left, "doc_id") == sorted([(e[0],) for e in expected if not e[5]], key=repr)


def test_decontamination_in_parts(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(["one two", "brown fox", "lazy dog", "far away from"])], "item_id int, text string")
    whole = as_list(decontamination.contamination(docs, bench), "doc_id", "n_hit", "items")
    monkeypatch.setattr(decontamination, "PART_BYTES", 5)
    assert len(decontamination.window_parts(bench, "item_id", "text", 10)) == 4
    assert as_list(decontamination.contamination(docs, bench), "doc_id", "n_hit", "items") == whole
    none = decontamination.contamination(docs, bench.where("false"))
    assert none.where("contaminated").count() == 0 and none.count() == docs.count()


# ------------------------------------------------------------------- op4
def hashed(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """Smallest id reachable, by union-find over all pairs."""
    parent = list(range(len(fps)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                parent[root(a)] = root(b)
    return [root(k) for k in range(len(fps))]


def test_simhash(docs, rows):
    got = simhash.components(docs)
    fps = [hashed(t) for _, t in rows]
    comp = brute_components(fps)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    assert as_list(got, "doc_id", "fingerprint", "component_id") == sorted(
        [(i, f"{fp:016x}", least.get(c)) for (i, _), fp, c in zip(rows, fps, comp)], key=repr)
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in one.collect()))) == sorted(map(repr, {least.get(c) for c in comp}))
    assert simhash.components(docs.where("false")).count() == 0


def test_simhash_one_of_each_component(spark):
    """One row of each component, also where ids are null or stand for unlike texts."""
    unlike = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcdef"]
    rows = [(None, unlike[0], "x"), (None, unlike[1], "x"), (None, unlike[2], "x"),  # no ids
            (7, unlike[3], "x"), (7, unlike[4], "x"), (9, unlike[4], "x"),  # an id of two texts
            (5, unlike[5], "x"), (None, unlike[5], "x"), (5, unlike[5], "x"), (5, unlike[5], "y")]  # copies
    df = spark.createDataFrame(rows, "doc_id long, text string, best string")
    one = simhash.one_of_each(df)
    assert one.columns == df.columns
    got = [(r.text, r.doc_id) for r in one.collect()]
    assert sorted(got, key=repr) == sorted(zip(unlike, [None, None, None, 7, 7, 5]), key=repr)


def test_simhash_links(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    fps = {0, (1 << 64) - 1, *map(int, base)}
    for x in base:  # chains of one to four flipped bits
        y = int(x)
        for b in rng.integers(0, 64, 4):
            y ^= 1 << int(b)
            fps.add(y)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for bits in (0, 1, 2, 3, 4):
        got = {tuple(sorted((r.src, r.dst))) for r in simhash.links(df, bits).collect()}
        every = sorted(map(signed, fps))
        mask = (1 << 64) - 1
        assert got == {(a, b) for k, b in enumerate(every) for a in every[:k] if bin((a ^ b) & mask).count("1") <= bits}


# ------------------------------------------------------------------- op5
def test_bpe(docs, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        expected.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    for share in (0.01, 0.0):  # most words unseen, all words seen
        got = digests(bpe_lexicon.encode_decode(docs, path, min_share=share))
        assert as_list(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)
    assert bpe_lexicon.encode_decode(docs.where("false"), path).count() == 0


MERGES = bpe_lexicon.Merges(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())
LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aetoins'dlvrm <|>012éΣ"))))
def test_bpe_any_text(text):
    ids, _ = MERGES.encode_words(text.encode().split())
    assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6), max_size=40), st.lists(st.binary(min_size=1, max_size=6), max_size=20))
def test_lexicon(words, others):
    import tempfile

    entries = sorted((w, [k, k + 1][:1 + k % 2]) for k, w in enumerate(sorted(words)))
    with tempfile.NamedTemporaryFile() as f:
        f.write(bpe_lexicon.compile_lexicon(entries))
        f.flush()
        lexicon = bpe_lexicon.Lexicon(f.name)
        probes = [*sorted(words), *others]
        size = np.array([len(p) for p in probes], np.int64)
        at = lexicon.index(np.frombuffer(b"".join(probes), np.uint8), np.cumsum(size) - size, size)
        known = dict(entries)
        for p, k in zip(probes, at):
            got = lexicon.output[lexicon.offset[k]:lexicon.offset[k + 1]].tolist() if k >= 0 else None
            assert got == known.get(p)


# ------------------------------------------------------------------- op6
def counts(text, least=quality_rules.MIN_REPEAT):
    w = WORDS.findall(text or "")
    n = len(w)

    def cover(k):
        c = collections.Counter(tuple(w[i:i + k]) for i in range(n - k + 1))
        return len({p for i in range(n - k + 1) if c[tuple(w[i:i + k])] > 1 for p in range(i, i + k)})

    lo, hi = 0, n  # repeats of a length have repeats of all smaller ones
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if len({tuple(w[i:i + mid]) for i in range(n - mid + 1)}) < n - mid + 1:
            lo = mid
        else:
            hi = mid - 1
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            lines += line in seen
            seen.add(line)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, cover(3), cover(least), lo)


def test_quality_rules(docs, rows):
    got = quality_rules.quality(docs)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]
    short = [(i, *counts(t)) for i, t in rows if t != LONG]
    assert as_list(got.where("n_words < 30000"), "doc_id", *cols) == sorted(short, key=repr)
    long = got.where("n_words = 30000").first()
    assert (long.longest_repeat, long.covered_words, long.n_repeat_words) == (30_000 - 997, 30_000, 30_000)
    for r in got.collect():
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and (not failed or not r.kept)
    left = quality_rules.keep_good(docs)
    assert left.columns == docs.columns and left.count() == got.where("kept").count()
    assert quality_rules.quality(docs.where("false")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab c".split()), max_size=30), max_size=6))
def test_suffix_array(texts):
    import pyarrow as pa

    block = pa.RecordBatch.from_arrays([pa.array([" ".join(t) for t in texts], pa.string())], names=["text"])
    c = quality_rules.measure(block, min_repeat=4)
    for k, t in enumerate(texts):
        e = counts(" ".join(t), 4)
        assert (c["n_repeat_words"][k], c["covered_words"][k], c["longest_repeat"][k]) == e[4:]


def test_quality_rules_reject_repetition(spark):
    clean = " ".join(f"word{i}" for i in range(400))
    passage = " ".join(f"again{i}" for i in range(70))
    df = spark.createDataFrame([(0, clean), (1, f"{passage} {clean} {passage}")], "doc_id int, text string")
    assert [r.doc_id for r in quality_rules.keep_good(df).collect()] == [0]


# ------------------------------------------------------------------- op9
def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://ORG", "http://org/", "http://A.Example.org/es/x?y#z", "https://example.org/en/1",
            "https://example.org/en/12/3", "https://example.org/en/2", "https://notexample.org/es/", "http://x.com/fr/", "http://com/de",
            "http://com/de/", "http://x.com?/fr/", "http://x.com#/fr/", "ftp://a.b.com/fr/q://z", "http://m.casino-win.example.com/xx",
            "http://.com/fr/", "http://a..com/fr/"]
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
    df = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)] + [(0, None, "x", "y")], "page_id int, url string, rule string, host string")
    got = {r.page_id: r for r in url_filter.judge(df, rules).collect()}
    for k, u in enumerate(urls):
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
        host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), m[1]), m[2]) if m else ("", "")
        fit = [(len(r), r, v) for v, r in rules for rh, rp in [(r[:r.index("/")], r[r.index("/"):])]
               if (host == rh or host.endswith("." + rh)) and path.startswith(rp)]
        rule, verdict = max(fit)[1:] if fit else (None, "block" if "casino" in host else "allow")
        assert (got[k].host, got[k].path, got[k].rule, got[k].verdict) == (host, path, rule, verdict), u
    assert url_filter.judge(df, []).where("rule is not null").count() == 0
    assert url_filter.judge(df, rules).count() == len(urls) + 1
    assert url_filter.judge(df.where("false"), rules).count() == 0
    many, path = ".".join(f"l{i}" for i in range(2000)), "/es/" + "p" * 200_000
    long = spark.createDataFrame([(1, f"http://{many}.example.org{path}"), (2, "x" * 300_000), (3, f"http://{many}{path}")], "page_id int, url string")
    got = {r.page_id: r for r in url_filter.judge(long, rules).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == (f"{many}.example.org", path, "example.org/es/", "block")
    assert (got[2].host, got[2].path, got[2].rule) == ("", "", None) and (got[3].path, got[3].rule, got[3].verdict) == (path, None, "allow")


def test_digest_collision(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda s: len(s))
    (tmp_path / "d").write_bytes(url_filter.compile_digests(["ab", "cd", "efg"]))
    d = url_filter.Digests(str(tmp_path / "d"))
    assert d.contains([b"cd", b"ab", b"xy", b"efg", b"efh", b""]).tolist() == [True, True, False, True, False, False]


# ------------------------------------------------------------------- op1
def test_warc_round_trip(spark, tmpdir_path):
    big = "".join(chr(0x4E00 + (i * i * 31 + i * 7) % 20000) for i in range(400_000))
    rows = [(0, "http://a/", "<p>x</p>"), (1, None, "<p>x</p>"), (2, "http://b/\r\nX: y", None), (3, "http://c/", ""), (4, "u%0A", big),
            (5, "u", big), (None, "u", "null id"), (0, "http://a/", "<p>x</p>"), (7, "http://z/", "\x1f\x8b\x08 WARC/1.1\r\n\r\n" * 9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("first", F.lit(1)).withColumn("key", F.lit(2))
    for least, split in ((0, 1 << 25), (0, 1000), (100, 333)):
        path = f"{tmpdir_path}/{least}-{split}"
        warc.write_archives(df.repartition(3), path, least_bytes=least)
        got = warc.read_archives(spark, path, split=split).collect()
        assert len(got) == len(rows)
        first = {}
        for i, _, h in rows:
            if i is not None:
                first[h or ""] = min(i, first.get(h or "", i))
        expected = []
        for i, u, h in rows:
            payload = (h or "").encode()
            again = i != first.get(h or "") and len(payload) >= least
            expected.append((f"urn:page:{'' if i is None else i}", u, "revisit" if again else "response", len(payload), warc.digest(payload),
                             None if again else payload, f"urn:page:{first[h or '']}" if again else None))
        assert sorted([(r.record_id, r.target_uri, r.type, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload),
                        r.refers_to) for r in got], key=repr) == sorted(expected, key=repr)
    warc.write_archives(df.where("false"), f"{tmpdir_path}/none")
    assert warc.read_archives(spark, f"{tmpdir_path}/none").count() == 0


def test_warc_damaged_member():
    import io

    good = [warc.member(warc.record("response", f"urn:{k}", None, b"p" * k, "x", None)) for k in range(5)]
    data = b"junk" + good[0] + good[1][:30] + good[2] + b"\x1f\x8b\x08" + good[3] + good[4]
    starts = [at for at, _ in warc.members(io.BytesIO(data), 0, len(data))]
    assert len(starts) == 4
    for cut in range(1, len(data), 7):  # two ranges own every record once
        both = [at for a, b in ((0, cut), (cut, len(data))) for at, _ in warc.members(io.BytesIO(data), a, b)]
        assert both == starts


def test_large_member_ends_with_zero():
    assert warc.member(b"x" * (17 << 20)).endswith(b"\0")


# ------------------------------------------------------------------- op7
PAGE = ("<!DOCTYPE html><html><head><title>{0}</title><script>var a='<p>no</p>'</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
        "<!-- note --><div class='ad-box'>Buy</div><article><h1>{0}</h1><p>One  &amp;\n<b>tw</b>o<p>{1}<div id=comments><p>bad</div></article>"
        "<aside>side</aside><form>go<input></form><footer>&copy; x</footer></body></html>")


def test_html_article(spark):
    rows = [(k, f"http://h{k % 3}/", PAGE.format(f"T{k}", f"body {k}")) for k in range(9)]
    rows += [(20, None, None), (21, "http://h0/", ""), (22, "http://h0/", PAGE.format("cut", "end of page").split("<div id=comments")[0] + "<di"), (0, *rows[0][1:])]
    df = spark.createDataFrame(rows, "page_id int, url string, html string").withColumn("host", F.lit("x")).withColumn("wrapper", F.lit("y"))
    got = {r.page_id: r.text for r in html_wrappers.extract(df).collect()}
    for k in range(9):
        assert got[k] == f"T{k} One & two body {k}"
    assert got[20] == got[21] == "" and got[22] == "cut One & two end of page"
    assert html_wrappers.extract(df).count() == len(rows)
    assert html_wrappers.extract(df.where("false")).count() == 0


def test_html_template_text():
    """Without an article element, text that all pages share is the template's."""
    page = "<body><div class=top>Site name</div><div class=page><h2>{0}</h2><p>{1}</p></div><div class=low>Imprint</div>"
    pages = [page.format(f"Title {k}", f"Text number {k}") for k in range(4)]
    w = html_wrappers.wrapper(html_wrappers.parse(pages[0]))
    for p in pages[1:]:
        w = html_wrappers.align(w, html_wrappers.wrapper(html_wrappers.parse(p)))
    assert html_wrappers.main_text(pages[2], w) == "Title 2 Text number 2"
    assert html_wrappers.expression(w).count("Site") == 0 and "=" in html_wrappers.expression(w)


def test_html_text_of_one_page():
    """Text that one page of a host has, or copies of it, is not the template's."""
    def texts(*pages):
        w = None
        for p in pages:
            new = html_wrappers.wrapper(html_wrappers.parse(p))
            w = new if w is None else html_wrappers.align(w, new)
        return [html_wrappers.main_text(p, w) for p in pages]

    quote = "<div><h1>T2</h1><p>y</p><blockquote>Q</blockquote></div>"
    assert texts("<div><h1>T1</h1><p>x</p></div>", quote, quote) == ["T1 x", "T2 y Q", "T2 y Q"]
    page = "<title>{0}</title><body><h3>Site</h3><div class={1}><p>{2}</p></div></body>"
    assert texts(page.format("a", "post", "one"), page.format("b", "post", "two"), page.format("c", "content", "three"))[2] == "c three"


def test_html_template_text_in_article():
    """The wrapper decides inside an article too, and on articles with a name of the list."""
    def texts(pages):
        w = None
        for p in pages:
            new = html_wrappers.wrapper(html_wrappers.parse(p))
            w = new if w is None else html_wrappers.align(w, new)
        return [html_wrappers.main_text(p, w) for p in pages]

    page = "<body><article><h4>Our paper</h4><h1>T{0}</h1><p>a{0}<p>b{0}</article><footer>f"
    once = page.format(3).replace("</article>", "<blockquote>Q</blockquote></article>")
    assert texts([page.format(1), page.format(2), once]) == ["T1 a1 b1", "T2 a2 b2", "T3 a3 b3 Q"]
    assert texts([page.format(1)] * 3)[0] == "Our paper T1 a1 b1"
    legal = "<body><div class=top>Site</div><article class='post legal' id=search-{0}><h1>T{0}</h1><p>a{0}</article>"
    assert texts([legal.format(k) for k in range(3)]) == [f"T{k} a{k}" for k in range(3)]
    many = "<body><h1>T{0}</h1><p>a{0}<article class=comment><p>c{0}</article><article class=comment><p>d{0}</article>"
    assert texts([many.format(k) for k in range(3)]) == [f"T{k} a{k}" for k in range(3)]


@pytest.mark.parametrize("name", ["article", "div"])
def test_html_shared_headings(name):
    """Headings and quotations that pages of a host share are text; what stands before, behind or links is not."""
    page = f"<body><h3>Site</h3><{name}><h1>T{{0}}</h1><p>a{{0}}{{1}}<p>y{{0}}<p>z{{0}}</{name}><h3>Imprint</h3>"

    def texts(*middle):
        pages, w = [page.format(k, m) for k, m in enumerate(middle)], None
        for p in pages:
            new = html_wrappers.wrapper(html_wrappers.parse(p))
            w = new if w is None else html_wrappers.align(w, new)
        return [html_wrappers.main_text(p, w) for p in pages]

    heading, quote, link = "<h2>Summary</h2>", "<blockquote>Q</blockquote>", "<h4><a href=/>Shop</a></h4>"
    assert texts(heading, "", heading, "") == [f"T{k} a{k}{' Summary' * (k % 2 == 0)} y{k} z{k}" for k in range(4)]
    assert texts(*[heading] * 4) == [f"T{k} a{k} Summary y{k} z{k}" for k in range(4)]
    assert texts(quote, quote, "") == ["T0 a0 Q y0 z0", "T1 a1 Q y1 z1", "T2 a2 y2 z2"]
    assert texts(*[link] * 3) == [f"T{k} a{k} y{k} z{k}" for k in range(3)]


def test_html_layouts():
    text = html_wrappers.main_text
    assert text("<body class=has-sidebar><div class='page with-sidebar'><header><h1>Site</h1></header><article class='post'>"
                "<header><h1>Head</h1><p>by me</header><p>Body</p><div class='share'>tweet</div></article>"
                "<div class=sidebar>s</div></div><div id=comments><article>c</article></div>", None) == "Head Body"
    assert text("<main><p>a<article class='comment'>no</article><section class='related'>no</section><p>b</main><footer>f", None) == "a b"
    assert text("<div class='cookie-notice'>c</div><div role=navigation>n</div><div class=content><p>text</div>"
                "<div style='display:none'>h</div><noscript>x</noscript>", None) == "text"
    assert text("<body><nav><a href=/>x</a></nav><p>a &lt; b &amp;amp; c &#233; &nbsp; d</body>", None) == "a < b &amp; c é d"


def test_html_groups():
    w = None
    for body in ("<ul><li>a<li>b</ul><p>x", "<ul><li>a</ul><h2>t</h2><p>y"):
        new = html_wrappers.wrapper(html_wrappers.parse(body))
        w = new if w is None else html_wrappers.align(w, new)
    assert html_wrappers.expression(w).startswith("<><ul>(li#)+</> (h2#=") and html_wrappers.expression(w).endswith(")? p#</>")


def test_html_deep():
    assert html_wrappers.main_text("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>flat", None) == "deep flat"


# ------------------------------------------------------------------ op10
def test_suffix_lm_base(docs, rows):
    import math
    import zlib

    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    got = suffix_lm.score(docs, held)
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    words = [WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"] for _, t in rows]
    c = collections.Counter(x for (i, _), w in zip(rows, words) if not is_held(i) for x in w)
    n, v = sum(c.values()), len(c)
    expected = [(i, is_held(i), len(w), sum(x in c for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6))
                for (i, _), w in zip(rows, words)]
    out = got.collect()
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out], key=repr) == sorted(expected, key=repr)
    assert all(r.score < 0 for r in out)
    assert suffix_lm.score(docs.where("false"), held).count() == 0
    assert suffix_lm.score(docs.where("doc_id < 3"), F.lit(True)).count() == 3


@pytest.mark.parametrize("held", [3 << 20, 40])
def test_suffix_tree(spark, monkeypatch, held):
    """Window counts, retained contexts and probabilities against a plain tree,
    also if few windows are held and looked at together."""
    if held < 100:
        monkeypatch.setattr(suffix_lm, "HELD", held)
        monkeypatch.setattr(suffix_lm, "CHUNK", 7)
    texts = ["abab abab abab", "abc abd", "", "b a b"] * 30
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id int, text string")
    tree = suffix_lm.grow(suffix_lm.window_counts(rows), min_share=0.005, gain=1.0)
    pad = bytes(suffix_lm.DEPTH - 1) + b"\n"
    n = collections.Counter()
    for t in texts:
        s = pad + t.encode() + b"\n"
        for k in range(suffix_lm.DEPTH, len(s)):
            for d in range(suffix_lm.DEPTH + 1):
                n[s[k - d:k], s[k]] += 1
    total, kinds = collections.Counter(), collections.Counter()
    for (c, _), m in n.items():
        total[c] += m
        kinds[c] += 1

    def p(context, symbol, kept):
        q = 1 / 256
        for d in range(len(context) + 1):
            c = context[len(context) - d:]
            if c in kept:
                q = (n[c, symbol] + kinds[c] * q) / (total[c] + kinds[c])
        return q

    every = {c for c in total if total[c] >= 0.005 * total[b""]}
    passed = {b""}
    for c in every - {b""}:
        bits = sum(m * np.log2(m / total[c] / p(c[1:], s, every)) for (x, s), m in n.items() if x == c)
        if bits >= 1.0 * kinds[c]:
            passed |= {c[k:] for k in range(len(c) + 1)}
    for d in range(suffix_lm.DEPTH + 1):
        got = {int(x).to_bytes(d, "big") for x in tree.contexts[d]}
        assert got == {c for c in passed if len(c) == d}
    raw = [b"abab abd", b"", b"zz a\xc3\xa9"]
    for t, score in zip(raw, suffix_lm.text_scores(raw, suffix_lm.Scores(tree))):
        s = pad + t + b"\n"
        assert score == pytest.approx(sum(np.log10(p(s[k - suffix_lm.DEPTH:k], s[k], passed)) for k in range(suffix_lm.DEPTH, len(s))))


@pytest.mark.parametrize("held", [2 << 20, 3])
def test_suffix_lm_rare_contexts(spark, monkeypatch, held):
    """Contexts stay whatever share of the corpus they have, and all texts score
    as by the whole tree, also if few windows are broadcast."""
    monkeypatch.setattr(suffix_lm, "HELD", held)
    texts = ["qjx qjz"] * 40 + ["the cat sat on the mat"] * 3 + ["", None, "unseen \u00e9"]
    few = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    out = F.col("doc_id") >= 42
    rows = few.select("doc_id", "text", out.alias("held_out"))
    counts = suffix_lm.window_counts(rows)
    tree = suffix_lm.grow(counts)
    want = suffix_lm.text_scores([(t or "").encode() for t in texts], suffix_lm.Scores(tree))
    got = {r.doc_id: r.score for r in suffix_lm.score(few, out).collect()}
    assert [got[k] for k in range(len(texts))] == pytest.approx(list(want))
    # a corpus that grows by other texts, to which the context is under a millionth
    more = counts.where("n > 0").unionByName(spark.range(1).selectExpr("cast(7 as long) key", "1000000000 n"))
    rare = int.from_bytes(b"qj", "big")
    assert rare in suffix_lm.grow(more).contexts[2] and rare in tree.contexts[2]
    p = {r.key: r.p for r in suffix_lm.probabilities(more).collect()}
    keys = np.array(sorted(p))
    assert [p[k] for k in keys.tolist()] == pytest.approx(list(suffix_lm.Scores(suffix_lm.grow(more)).of(keys)))


def test_suffix_lm_parts():
    """Windows keep their bytes through a part's packed rows, whatever their first and last bytes."""
    rng = np.random.default_rng(3)
    keys = np.unique(np.append(rng.integers(0, 1 << 56, 5000), [0, 1, (1 << 56) - 1]))
    codes = np.sort(suffix_lm.dealt(keys))
    assert codes.min() >= 0 and len(np.unique(codes)) == len(keys)
    assert np.array_equal(np.sort(suffix_lm.undealt(suffix_lm.unpack(suffix_lm.pack(codes)))), keys)
    end = lambda c: (suffix_lm.undealt(c) >> 8) & suffix_lm.low_bytes(suffix_lm.HEAD)
    parts = list(suffix_lm.by_part(codes, 6))
    assert sum(b - a for _, a, b in parts) == len(codes) and len({k for k, _, _ in parts}) == len(parts) <= 64
    ends = [set(end(codes[a:b]).tolist()) for _, a, b in parts]
    assert sum(map(len, ends)) == len(set().union(*ends))
    for n in ([], [0], [255, 256], [1 << 16, 3], [1 << 40, (1 << 62)]):
        assert suffix_lm.unpack_counts(suffix_lm.pack_counts(np.array(n, np.int64))).tolist() == n


@pytest.mark.parametrize("held", [2 << 20, 3])
def test_suffix_lm_one_row_a_part(spark, monkeypatch, held):
    """Blocks emit windows by part, not one by one; with more texts than a chunk numbers
    and a text longer than a chunk, texts score as by the whole tree."""
    from forecourt import session

    monkeypatch.setattr(suffix_lm, "HELD", held)
    if held < 100:
        monkeypatch.setattr(suffix_lm, "GROWN", 50)
    rng = np.random.default_rng(5)
    names = ["".join(map(chr, rng.integers(97, 123, 5))) for _ in range(400)]
    texts = [" ".join(rng.choice(names, 12)) for _ in range(700)] + [" ".join(rng.choice(names, 100_000)), "\xff\u00ff \U0010ffff"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    rows = docs.select("doc_id", "text", (F.col("doc_id") % 7 == 2).alias("held_out"))
    want = suffix_lm.text_scores([t.encode() for t in texts], suffix_lm.Scores(suffix_lm.grow(suffix_lm.window_counts(rows))))
    folder = session.scratch_path(spark, "tables")
    before = set(session.list_names(spark, folder))
    got = {r.doc_id: r.score for r in suffix_lm.score(docs, F.col("doc_id") % 7 == 2).collect()}
    assert [got[k] for k in range(len(texts))] == pytest.approx(list(want))
    new, = (x for x in session.list_names(spark, folder) if x not in before and x.startswith("words-"))
    words = spark.read.parquet(f"{folder}/{new}")
    # a row for each distinct word, the end and the block's texts; windows: one for each part
    assert words.where("part is null").count() <= len(names) + 4
    assert words.where("part is not null").count() <= 1 << suffix_lm.part_bits(spark)


def test_suffix_lm_word_sums(spark):
    """A task gives one row for each block, whatever the number of its words."""
    rng = np.random.default_rng(9)
    rows, base, known = [], collections.Counter(), collections.Counter()
    for block, wide, n_texts in ((7, False, 40), (1 << 40, True, 70_000)):
        for _ in range(3000):
            texts, c = np.unique(rng.integers(0, n_texts, 3)), int(rng.integers(0, 5))
            n = rng.integers(1, 9, len(texts))
            rows.append((block, wide, bytearray(np.stack((texts, n), axis=1).astype(np.uint32 if wide else np.uint16).tobytes()), c or None))
            for t, m in zip(texts.tolist(), n.tolist()):
                base[block, t] += m * np.log10(c + 1)
                known[block, t] += m * (c > 0)
    got = suffix_lm.word_sums(spark.createDataFrame(rows, "block long, wide boolean, places binary, c long").coalesce(1)).collect()
    assert sorted(r.block for r in got) == [7, 1 << 40]
    for r in got:
        at = np.frombuffer(r.places, "<u4").tolist()
        assert set(at) == {t for (b, t), x in base.items() if b == r.block and x}
        assert np.frombuffer(r.sums, "<f8").tolist() == pytest.approx([base[r.block, t] for t in at])
        assert suffix_lm.unpack_counts(bytes(r.known)).tolist() == [known[r.block, t] for t in at]


def test_suffix_lm_six_bytes(spark):
    """The sixth byte before a symbol decides where five are the same."""
    few = spark.createDataFrame([(k, t) for k, t in enumerate(["xabcdep", "yabcdeq"] * 30)], "doc_id long, text string")
    tree = suffix_lm.grow(suffix_lm.window_counts(few))
    scores = suffix_lm.text_scores([b"xabcdep", b"xabcdeq"], suffix_lm.Scores(tree))
    assert scores[0] > scores[1] + 1
