"""The registered queries of the operators, over the driver's tables.

Each query reads its whole table through its operator and derives the columns
that its contract names.  ``ORACLE`` has DuckDB statements where SQL can express
the result; the others are held against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import (bpe_lexicon, collocations, decontamination, html_wrappers, merkle_manifest, quality_qda,
                           quality_rules, simhash, suffix_lm, token_counts, toxicity, url_filter, warc)
from forecourt.llm.common import crc_mod, new_key, table
from forecourt.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]


def register(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return put


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(n: int, r: int) -> Column:
    """Whether crc32 of the id's text leaves ``r`` (null id: no)."""
    return F.coalesce(crc_mod("doc_id", n) == r, F.lit(False))


@register("op1_warc", """
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
    d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS h FROM p),
    bits AS (SELECT h, list_aggregate([
        (['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'])
            [strpos('0123456789abcdef', x)] FOR x IN string_split(h, '')], 'string_agg', '') AS s FROM (SELECT DISTINCT h FROM d)),
    codes AS (SELECT h, list_aggregate([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([
            (substr(s, 5 * i + j, 1)::INT) << (5 - j) FOR j IN [1, 2, 3, 4, 5]])::INT, 1) FOR i IN range(32)], 'string_agg', '') AS digest FROM bits),
    f AS (SELECT h, min(page_id) AS first FROM d GROUP BY h)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, digest AS payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS NOT DISTINCT FROM first THEN NULL ELSE first END AS refers_to
    FROM d JOIN codes USING (h) JOIN f USING (h)""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page into WARC archives and back."""
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, f"warc/{new_key()}")
    warc.write_archives(pages, path, least_bytes=0)
    records = warc.read_archives(spark, path, payloads=False)
    kind = pages.schema["page_id"].dataType
    number = lambda c: F.expr(f"nullif(substring({c}, {len('urn:page:') + 1}), '')").cast(kind)
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                          F.col("type").alias("record_type"), number("refers_to").alias("refers_to"))


@register("op2_decontamination", """
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
    g AS (SELECT DISTINCT item, least(10, len(w)) AS n, w[k:k + least(10, len(w)) - 1] AS gram
          FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS k FROM i WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM g),
    -- of documents only the places where a window's first word stands are expanded
    heads AS (SELECT DISTINCT n, gram[1] AS head FROM g),
    spots AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d),
    m AS (SELECT DISTINCT a.doc_id, a.k, g.n, g.item FROM spots a JOIN heads h ON a.w[a.k] = h.head
          JOIN g ON g.n = h.n AND g.gram[1] = h.head AND a.w[a.k:a.k + g.n - 1] = g.gram),
    hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM m) GROUP BY doc_id),
    it AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@register("op3_quality_qda")
def op3_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    held = held_out(3, 1)
    scored = quality_qda.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", ~held)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their components."""
    return simhash.components(table(spark, sf_dir, "documents"))


@register("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    coded = bpe_lexicon.encode_decode(table(spark, sf_dir, "documents"), vocabulary())
    return digests(coded)


def digests(coded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules on all documents."""
    return quality_rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_words", "longest_repeat")


@register("op7_html")
def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_wrappers.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs, held = table(spark, sf_dir, "documents"), held_out(5, 0)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), "toxic", ~held)
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_clauses")


@register("op9_url_filter", """
    WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
    p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
    r(verdict, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
    t(term) AS (VALUES ('casino'), ('poker'), ('porn'), ('viagra'), ('xxx'))
    SELECT page_id, host, path,
           (SELECT rh || rp FROM r WHERE (host = rh OR suffix(host, '.' || rh)) AND prefix(path, rp) ORDER BY length(rh || rp) DESC LIMIT 1) AS rule,
           coalesce((SELECT verdict FROM r WHERE (host = rh OR suffix(host, '.' || rh)) AND prefix(path, rp) ORDER BY length(rh || rp) DESC LIMIT 1),
                    CASE WHEN len(list_intersect(regexp_split_to_array(host, '[.:_-]'), (SELECT list(term) FROM t))) > 0 THEN 'block' ELSE 'allow' END) AS verdict
    FROM p""")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules on the urls of all pages."""
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


@register("op10_suffix_lm")
def op10_suffix_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a tree and by word counts of the training part."""
    return suffix_lm.score(table(spark, sf_dir, "documents"), held_out(7, 2))


@register("op11_merkle", """
    WITH RECURSIVE
    t8(i, c, k) AS (SELECT i, i, 0 FROM range(256) r(i) UNION ALL
        SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM t8 WHERE k < 8),
    t AS (SELECT list(c ORDER BY i) AS t FROM t8 WHERE k = 8),
    crc AS (SELECT doc_id, xor(4294967295, list_reduce([ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')],
                lambda a, b: xor(a >> 8, t[1 + xor(a & 255, b)]), 4294967295::BIGINT)) AS c
            FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), t),
    f AS (SELECT d.doc_id, lang, coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                 || coalesce(strlen(lang) || ':' || lang, '-') AS head, coalesce(strlen(text) || ':' || text, '-') AS tail, n_chars,
                 CASE WHEN c % 7 = 0 THEN 1 ELSE 0 END AS extra
          FROM documents d LEFT JOIN crc ON crc.doc_id = d.doc_id),
    l AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                 sha256(head || coalesce(strlen((n_chars + extra)::VARCHAR) || ':' || (n_chars + extra), '-') || tail) AS claimed FROM f),
    p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS size FROM l),
    nodes(lang, lvl, place, size, h) AS (SELECT lang, 0, place, size, leaf FROM p UNION ALL
        SELECT lang, lvl + 1, place // 2, (any_value(size) + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM nodes
        WHERE size > 1 GROUP BY lang, lvl, place // 2),
    sub AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS size FROM nodes WHERE size = 1),
    above(lvl, place, size, h) AS (SELECT 0, place, size, subroot FROM sub UNION ALL
        SELECT lvl + 1, place // 2, (any_value(size) + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM above
        WHERE size > 1 GROUP BY lvl, place // 2),
    root AS (SELECT h AS root FROM above WHERE size = 1),
    -- the nodes beside the path of each leaf, numbered from the leaf up
    q AS (SELECT p.*, sub.subroot, sub.place AS splace, sub.size AS ssize FROM p JOIN sub ON p.lang IS NOT DISTINCT FROM sub.lang),
    beside AS (
        SELECT q.doc_id, q.leaf, q.lang, q.place, n.lvl, n.h, n.place % 2 = 0 AS is_left FROM q
        JOIN nodes n ON n.lang IS NOT DISTINCT FROM q.lang AND n.place = xor(q.place >> n.lvl::BIGINT, 1) WHERE n.size > 1
        UNION ALL SELECT q.doc_id, q.leaf, q.lang, q.place, 100 + a.lvl, a.h, a.place % 2 = 0 FROM q
        JOIN above a ON a.place = xor(q.splace >> a.lvl::BIGINT, 1) WHERE a.size > 1),
    proofs AS (SELECT lang, place, sha256(string_agg(h, '' ORDER BY lvl)) AS proof FROM beside GROUP BY lang, place),
    -- every level of every path, a level without sibling too
    steps AS (SELECT DISTINCT lang, lvl, size FROM nodes WHERE size > 1),
    upper AS (SELECT DISTINCT lvl, size FROM above WHERE size > 1),
    path AS (
        SELECT q.lang, q.place, s.lvl FROM q JOIN steps s ON s.lang IS NOT DISTINCT FROM q.lang
        UNION ALL SELECT q.lang, q.place, 100 + u.lvl FROM q, upper u),
    ways AS (SELECT a.lang, a.place, list({'h': b.h, 'l': b.is_left} ORDER BY a.lvl) AS way FROM path a
             LEFT JOIN beside b ON a.lang IS NOT DISTINCT FROM b.lang AND a.place = b.place AND a.lvl = b.lvl GROUP BY a.lang, a.place),
    folded AS (SELECT q.doc_id, leaf, subroot, q.lang, q.place,
                      list_reduce(list_prepend({'h': claimed, 'l': false}, coalesce(way, [])), lambda x, y: {'h': sha256(CASE
                          WHEN y.h IS NULL THEN x.h WHEN y.l THEN y.h || x.h ELSE x.h || y.h END), 'l': false}).h AS folded
               FROM q LEFT JOIN ways w ON q.lang IS NOT DISTINCT FROM w.lang AND q.place = w.place)
    SELECT f.doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM folded f LEFT JOIN proofs p ON f.lang IS NOT DISTINCT FROM p.lang AND f.place = p.place, root""")
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and each leaf, a seventh of them tampered with, verified."""
    docs = table(spark, sf_dir, "documents")
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    claimed = F.when(crc_mod("doc_id", 7) == 0, merkle_manifest.leaf("doc_id", "source", "lang", more, "text"))
    found = merkle_manifest.manifest(docs, "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], claimed)
    return merkle_manifest.verify(found).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


@register("op12_collocations", """
    WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    pieces AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d)),
    u AS (SELECT lang, piece, unnest(w) AS w1, unnest(range(len(w))) AS k FROM (SELECT *, row_number() OVER () AS piece FROM pieces)),
    v AS (SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM u WINDOW o AS (PARTITION BY piece ORDER BY k)),
    f AS MATERIALIZED (SELECT lang, 1 AS n, w1 AS phrase, count(*) AS f FROM v GROUP BY ALL
          UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM v WHERE w2 IS NOT NULL GROUP BY ALL
          UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM v WHERE w3 IS NOT NULL GROUP BY ALL),
    total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE n = 1 GROUP BY lang),
    c AS (SELECT lang, n, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE n > 1 AND f >= 10),
    cuts AS (SELECT *, lang || '|' || array_to_string(w[:k], ' ') AS x, lang || '|' || array_to_string(w[k + 1:], ' ') AS y
             FROM (SELECT *, unnest(range(1, n)) AS k FROM c)),
    part AS MATERIALIZED (SELECT lang || '|' || phrase AS part, f FROM f WHERE f >= 10),
    s AS (SELECT c.*, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score FROM cuts c
          JOIN part x ON x.part = c.x JOIN part y ON y.part = c.y),
    best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (SELECT lang, part, max(a) AS longest FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM c WHERE n = 3) GROUP BY ALL),
    left_over AS (SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.part = b.phrase
                  WHERE longest IS NULL OR 100 * longest < 50 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n AS n, score
    FROM left_over JOIN total t USING (lang) QUALIFY rank <= 2000""")
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of two and three words of all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"), least=10, inside_percent=50, first=2000)


@register("op13_token_counts")
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents."""
    found = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
