"""Learned operators by held-out accuracy and by the rules of their parts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import quality_qda, toxicity
from forecourt.llm.queries import QUERIES, held_out

SF = "/root/testdata/sf0.1"


def auc(y, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(y))
    rank[order] = np.arange(len(y))
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("query,label,least", [("op3_quality_qda", "quality", 0.99), ("op8_toxicity", "toxic", 0.9)])
def test_held_out(spark, query, label, least):
    got = QUERIES[query](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    r = got.join(labels, "doc_id").where("held_out").select("score", "predicted", label).toPandas()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert auc(r[label].to_numpy(), r.score.to_numpy()) > least
    assert (r.predicted == r[label]).mean() > 0.97
    assert ((r.score >= 0) & (r.score <= 1)).all() and (r.predicted == (r.score >= 0.5)).all()


def odd(spark):
    texts = [None, "", "\n\n", "word", "x" * 50_000, "you idiot. " * 2000, "you idiot"]
    docs = spark.createDataFrame([(k, t, "a", 1.0) for k, t in enumerate(texts)] + [(6, "you idiot", "b", 2.0), (None, "null id", "c", 3.0)],
                                 "doc_id long, text string, y string, score double")
    labels = spark.createDataFrame([(3, 1, 0), (5, 0, 1), (6, None, 1), (6, 0, None), (None, 1, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    return docs, labels


def test_qda_odd_inputs(spark):
    docs, labels = odd(spark)
    got = quality_qda.score(docs, labels, "quality", F.lit(True))
    assert got.count() == docs.count() and got.where("score is null or isnan(score)").count() == 0
    none = quality_qda.score(docs, labels.where("false"), "quality", F.lit(True))
    assert {r.score for r in none.collect()} == {0.5}
    assert quality_qda.score(docs.where("false"), labels, "quality", F.lit(True)).count() == 0


def test_qda_against_densities():
    rng = np.random.default_rng(1)
    x = [rng.normal(size=(400, 3)) @ np.diag([1, 2, 3]), rng.normal(size=(300, 3)) + 1]
    n = np.array([len(v) for v in x], float)
    m = quality_qda.fit(n, np.array([v.sum(axis=0) for v in x]), np.array([v.T @ v for v in x]), pool=0.0, ridge=0.0)
    probe = rng.normal(size=(20, 3))
    density = []
    for c in range(2):
        s, d = np.cov(x[c].T), probe - x[c].mean(axis=0)
        density.append(np.log(n[c] / n.sum()) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ni,ij,nj->n", d, np.linalg.inv(s), d))
    assert np.allclose(m.score(probe), 1 / (1 + np.exp((density[0] - density[1]) / 3)))


def test_toxicity_odd_inputs(spark):
    docs, labels = odd(spark)
    model = toxicity.learn(docs, labels, "toxic", F.lit(True))
    got = toxicity.score(docs, model)
    assert got.count() == docs.count() and got.where("score is null").count() == 0
    empty = toxicity.learn(docs, labels.where("false"), "toxic", ~held_out(5, 0))
    left = toxicity.keep_clean(docs, empty)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_grammar():
    other, insult, threat, target, negation, report = range(6)
    run = lambda *c: toxicity.MACHINE.clause(list(c), [2.0] * len(c))
    plain = run(other, insult, other)
    assert plain == 2.0 and run(other, other) == 0
    assert run(target, other, insult) > plain  # aimed at someone
    assert run(negation, other, insult) < plain  # denied
    assert run(negation, other, other, other, insult) == plain  # too far away
    assert run(report, insult) < plain  # quoted
    assert run(threat, other, target) > 0 and run(threat) == 0  # a threat needs a target
    assert run(threat, other, other, other, target) == 0


def test_patterns():
    rows = [("idi", 30, 0), ("idio", 30, 0), ("idiot$", 30, 0), ("the", 100, 100), ("thex", 20, 0)]
    chosen = toxicity.choose(rows, (200, 100))
    assert set(chosen) == {"idi", "thex"}
    insults = toxicity.Insults(chosen)
    assert insults.weight("idiotic") > 0 and insults.weight("there") == 0 and insults.weight("id") == 0


def test_rare_and_quoted_insults(spark):
    """An insult in under 1 % of the toxic texts, and one that other texts quote, are learned."""
    n = 2300
    toxic = [f"see {k} here. you {'zorgle' if k < 20 else 'klutzen' if k < 600 else 'idiot'}." for k in range(n)]
    clean = [f"see {k} here. you {'never said klutzen' if k < 60 else 'win'}." for k in range(n)]
    docs = spark.createDataFrame([(k, t, int(k < n)) for k, t in enumerate(toxic + clean)], "doc_id long, text string, toxic int")
    model = toxicity.learn(docs, docs.select("doc_id", "toxic"), "toxic", F.lit(True))
    assert min(model.insults.weight(w) for w in ("zorgle", "klutzen", "idiot")) > 0
    assert model.insults.weight("you") == model.insults.weight("here") == 0
    got = toxicity.score(docs, model).join(docs.select("doc_id", "toxic"), "doc_id").collect()
    assert all(r.n_clauses > 0 for r in got if r.toxic)
    assert all(r.score >= 0.5 for r in got if r.toxic)
    assert all(r.score < 0.5 for r in got if r.doc_id >= n + 60)


def test_suffix_lm_deletes_tables_it_has_read(spark):
    from forecourt import session
    from forecourt.llm import suffix_lm

    def tables() -> set[str]:
        return set(session.list_names(spark, session.scratch_path(spark, "tables")))

    before = tables()
    docs = spark.createDataFrame([(k, "a word or two " * (k + 1)) for k in range(6)], "doc_id long, text string")
    out = suffix_lm.score(docs, F.col("doc_id") == 2)
    assert {x.split("-")[0] for x in tables() - before} == {"probabilities", "words", "totals"}
    assert out.count() == 6 and out.count() == 6
    assert spark.conf.get(session.SHUFFLES_GO, "false") == "false"
