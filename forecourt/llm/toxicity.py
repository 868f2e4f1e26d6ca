"""Toxicity by a weighted finite-state pattern grammar.

A text is read as clauses of token classes: insult, threat, target, negation,
reported speech, other.  Five small transducers work on a clause: insults and
threats give weights, a target in the clause raises them, a negation shortly
before or reported speech lowers them.  ``compose`` builds their product once;
a clause's score is the sum of the weights on its path.  Isolated words have
no score of their own, and clauses without insult or threat are never walked.

The insult transducer is learned: words and word beginnings whose document
frequency differs between toxic and other training texts by a log-likelihood
ratio of ``MIN_EVIDENCE`` at least, however rare they are, weighted by their log
odds.  Beginnings must be pure, since they stand for words not seen; of a beginning
and its extensions the shortest is kept.  Words that other texts have too, quoted or
negated, count as they are.  Training reads at most
``SAMPLE`` texts of each class, those with the smallest hashes of their ids
(equal texts once).  The score of a text is a logistic function of its clause
scores, fitted on the same texts.

* null or empty text: no clause, the score of a text without matches.
* labels that are null or of unknown documents are not learned from; of several
  labels for an id the larger holds.  A null id is never held out.
* without texts of both classes only the fixed words count.
* words under ``SHORTEST`` characters give no pattern, nor do beginnings of words over
  ``LONGEST``; texts without blanks between words are read as the long words they are.
* texts of any length are read whole; repeated rows are scored each; an empty table
  gives no rows; other columns are not read, and stay in ``keep_clean``.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import id_text, keep_rows, map_blocks, words_of

SAMPLE = 10_000
MIN_EVIDENCE = 24.0
SHORTEST, LONGEST = 3, 8
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Fixed words of the grammar: English, German, French, Spanish.
WORDS = {
    THREAT: "kill hurt destroy beat burn töten verletzen zerstören tuer frapper détruire matar golpear destruir",
    TARGET: "you your yours he she they them him her du dein ihr euch tu toi vous votre ils elles tú te usted ustedes ellos",
    NEGATION: "not no never neither without nicht kein keine nie niemals ne pas jamais sans ni nunca jamás sin",
    REPORT: "said says wrote called quoted alleged reported sagte schrieb nannte dit écrit appelé dijo escribió llamó",
}
CLASS = {w: c for c, text in WORDS.items() for w in text.split()}
THREAT_WEIGHT = 1.0


# ------------------------------------------------------------- the grammar
@dataclass
class Transducer:
    """States with moves by token class; ``gain`` multiplies what is matched in
    a state, ``gives`` is the weight a class has there, ``after`` multiplies the
    clause if it ends in a state."""

    moves: dict = field(default_factory=dict)
    gain: dict = field(default_factory=dict)
    gives: dict = field(default_factory=dict)
    after: dict = field(default_factory=dict)

    def to(self, state, cls):
        return self.moves.get((state, cls), self.moves.get((state, None), state))


def grammar() -> list[Transducer]:
    insult = Transducer(gives={(0, INSULT): 1.0})
    # a threat counts if a target follows within three tokens
    threat = Transducer(moves={(0, THREAT): 3, (1, None): 0, (2, None): 1, (3, None): 2,
                               **{(s, THREAT): 3 for s in (1, 2, 3)}, **{(s, TARGET): 0 for s in (1, 2, 3)}},
                        gives={(s, TARGET): THREAT_WEIGHT for s in (1, 2, 3)})
    target = Transducer(moves={(0, TARGET): 1}, after={1: 1.25})
    negation = Transducer(moves={(0, NEGATION): 3, (1, None): 0, (2, None): 1, (3, None): 2,
                                 **{(s, NEGATION): 3 for s in (1, 2, 3)}},
                          gain={s: 0.6 for s in (1, 2, 3)})
    report = Transducer(moves={(0, REPORT): 1}, gain={1: 0.8})
    return [insult, threat, target, negation, report]


class Composed:
    """The product of transducers, as tables over numbered states."""

    def __init__(self, parts: list[Transducer]):
        start = (0,) * len(parts)
        self.number, todo = {start: 0}, [start]
        self.next, self.weight, self.after = [], [], []
        for state in todo:
            moves, weights = [], []
            gain = math.prod(p.gain.get(s, 1.0) for p, s in zip(parts, state))
            for cls in range(6):
                to = tuple(p.to(s, cls) for p, s in zip(parts, state))
                if to not in self.number:
                    self.number[to] = len(self.number)
                    todo.append(to)
                moves.append(self.number[to])
                weights.append(gain * sum(p.gives.get((s, cls), 0.0) for p, s in zip(parts, state)))
            self.next.append(moves)
            self.weight.append(weights)
            self.after.append(math.prod(p.after.get(s, 1.0) for p, s in zip(parts, state)))

    def clause(self, classes: list[int], weights: list[float]) -> float:
        """The score of a clause; ``weights`` are those of its insults."""
        state, total = 0, 0.0
        for c, w in zip(classes, weights):
            total += self.weight[state][c] * (w if c == INSULT else 1.0)
            state = self.next[state][c]
        return total * self.after[state]


MACHINE = Composed(grammar())


# ------------------------------------------------------------ the patterns
def letters(word: str) -> str:
    """A token as the patterns see it: lower case, without marks at its ends."""
    return re.sub(r"^[\W\d_]+|[\W\d_]+$", "", word.lower())


def patterns(word: str) -> list[str]:
    """A word's patterns: the word itself (with a final ``$``) and its beginnings."""
    return [word[:k] for k in range(SHORTEST, min(LONGEST, len(word)) + 1)] + [word + "$"] if len(word) >= SHORTEST else []


class Insults:
    """The learned patterns; the longest one that begins a word counts."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.longest = max(map(len, weights), default=0)

    def weight(self, word: str) -> float:
        word += "$"
        for k in range(min(len(word), self.longest), SHORTEST - 1, -1):
            if (w := self.weights.get(word[:k])) is not None:
                return w
        return 0.0


def choose(rows: list, n: tuple[int, int]) -> dict[str, float]:
    """Patterns (pattern, in toxic, in other texts) that speak for toxicity."""
    good = {}
    for p, a, b in rows:
        good[p] = math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1)), a, b
    chosen: dict[str, float] = {}
    for p in sorted(good, key=lambda p: (len(p), p)):
        w, a, b = good[p]
        # a whole word stands for itself only; the grammar's own words are no insults
        speaks = b <= 0.02 * a or p.endswith("$") and w > 0 and p[:-1] not in CLASS
        # an extension is needed only if it is purer than the beginning it has
        if speaks and not any(p[:k] in chosen for k in range(SHORTEST, len(p))):
            chosen[p] = w
    return chosen


def evidence(a: Column, b: Column, n1: int, n0: int) -> Column:
    """Log-likelihood ratio of a pattern in a of n1 toxic and b of n0 other texts."""
    def part(x, e):
        return F.when(x > 0, x * F.log(x / e)).otherwise(0.0)

    share = (a + b) / F.lit(float(n1 + n0))
    return 2 * (part(a, share * n1) + part(b, share * n0) + part(n1 - a, (1 - share) * n1) + part(n0 - b, (1 - share) * n0))


# ---------------------------------------------------------------- scoring
def tokens_of(block: pa.RecordBatch, name: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct tokens, each token's number, tokens of each text; a line's end ends a clause."""
    col = pc.replace_substring(pc.fill_null(block.column(name), ""), "\n", " . ")
    flat, counts = words_of(pa.RecordBatch.from_arrays([col], names=["text"]))
    coded = flat.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


def clauses(block: pa.RecordBatch, insults: Insults, name: str = "text") -> list[list[tuple[float, str]]]:
    """For each text its matched clauses: (score, the matched words)."""
    distinct, codes, counts = tokens_of(block, name)
    bare = [letters(t) for t in distinct]
    weight = np.array([insults.weight(w) for w in bare] or [0.0])
    cls = np.array([INSULT if x > 0 else CLASS.get(w, OTHER) for w, x in zip(bare, weight)] or [OTHER])
    end = np.array([t[-1:] in ".!?;:|" for t in distinct] or [False])
    if not len(codes):
        return [[] for _ in counts]
    token_cls, text = cls[codes], np.repeat(np.arange(len(counts)), counts)
    stop = end[codes] | np.append(text[1:] != text[:-1], True)
    clause = np.cumsum(stop) - stop
    bounds = np.concatenate(([0], np.flatnonzero(stop) + 1))
    out: list[list[tuple[float, str]]] = [[] for _ in counts]
    for c in np.unique(clause[(token_cls == INSULT) | (token_cls == THREAT)]):
        a, b = bounds[c], bounds[c + 1]
        path, w = token_cls[a:b].tolist(), weight[codes[a:b]].tolist()
        if (s := MACHINE.clause(path, w)) > 0:
            hit = [bare[k] for k, p in zip(codes[a:b], path) if p in (INSULT, THREAT)]
            out[text[a]].append((s, " ".join(hit)))
    return out


def features(found: list[tuple[float, str]]) -> list[float]:
    scores = [s for s, _ in found]
    return [1.0, math.log1p(sum(scores)), math.log1p(max(scores, default=0.0))]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton steps; classes weigh alike, the ridge bounds what a separable sample gives."""
    beta = np.zeros(x.shape[1])
    balance = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = np.maximum(balance * p * (1 - p), 1e-9)
        step = np.linalg.solve((x * w[:, None]).T @ x + ridge * len(y) / 100 * np.eye(x.shape[1]),
                               x.T @ (balance * (y - p)) - ridge * len(y) / 100 * beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


@dataclass
class Model:
    insults: Insults
    beta: np.ndarray

    def score(self, found: list[tuple[float, str]]) -> float:
        return float(1 / (1 + math.exp(-max(-500.0, min(500.0, float(np.dot(features(found), self.beta)))))))


def learn(docs: DataFrame, labels: DataFrame, label: str, training: Column, doc_id: str = "doc_id", text: str = "text",
          sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` texts of each class; ``training`` is a condition on doc_id."""
    marked = (labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
              .where(F.col("y").isin(0, 1)).where(training).groupBy("doc_id").agg(F.max("y").alias("y")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = marked.where("y = 1").orderBy(*order).limit(sample).unionByName(
        marked.where("y = 0").orderBy(*order).limit(sample))
    # at most 2 * sample ids: a broadcast of known size
    texts = (id_text(docs, doc_id, text).join(F.broadcast(chosen), "doc_id").where("text is not null")
             .dropDuplicates(["text"]).select("text", "y"))

    def count(block: pa.RecordBatch) -> dict:
        distinct, codes, counts = tokens_of(block, "text")
        bare = [letters(t) for t in distinct]
        of = [patterns(w) for w in bare]
        seen, at = defaultdict(Counter), 0
        for y, n in zip(block.column("y").to_pylist(), counts):
            found = set()
            for k in set(codes[at:at + n].tolist()):
                found.update(of[k])
            at += n
            seen[y].update(found)
            seen[y][""] += 1  # the number of texts
        rows = [(p, y, n) for y, c in seen.items() for p, n in c.items()]
        return {"p": [r[0] for r in rows], "y": [r[1] for r in rows], "n": [r[2] for r in rows]}

    rows = (map_blocks(texts, "text", "p string, y int, n long", count).groupBy("p")
            .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"),
                 F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b")).persist())
    size = rows.where("p = ''").select("b", "a").first()
    n = (size.b, size.a) if size else (0, 0)
    if not all(n):
        rows.unpersist()
        return Model(Insults({}), np.array([-2.0, 1.0, 1.0]))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    found = rows.where("p <> ''").where(a * n[0] > b * n[1]).where(
        evidence(a, b, n[1], n[0]) >= MIN_EVIDENCE)
    insults = Insults(choose([(r.p, r.a, r.b) for r in found.collect()], n))
    rows.unpersist()

    def measure(block: pa.RecordBatch) -> dict:
        return {"x": [features(f) for f in clauses(block, insults)], "y": block.column("y")}

    got = map_blocks(texts, "text", "x array<double>, y int", measure).collect()  # bounded by the sample
    return Model(insults, logistic(np.array([r.x for r in got]), np.array([r.y for r in got], float)))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, n_clauses, worst): ``worst`` has the words of the clause with the highest score."""
    def run(block: pa.RecordBatch) -> dict:
        found = clauses(block, model.insults)
        return {"doc_id": block.column("doc_id"), "score": [model.score(f) for f in found],
                "n_clauses": [len(f) for f in found], "worst": [max(f)[1] if f else None for f in found]}

    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score double, n_clauses long, worst string"
    return map_blocks(id_text(docs, doc_id, text), "text", schema, run)


def keep_clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, all columns as they were."""
    return keep_rows(docs, text, lambda b: np.array([model.score(f) < threshold for f in clauses(b, model.insults, text)], bool))
