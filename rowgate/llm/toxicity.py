"""Toxicity by multiple-instance learning.

Only documents are labelled; what offends is a sentence.  A sentence's score is
a logistic function of the weights of its features (lower-case words, and their
first and last four and five letters), and a document's score is the noisy-or
of its sentences, ``1 - prod(1 - p)``.  The weights are learned from document
labels through that noisy-or, so that they settle on the sentences that tell
toxic documents from clean ones, and the same sentence scores locate them.

In a long text many sentences that are each unlikely to offend would add up to a high
score.  Sentences of a score below ``FAINT`` therefore count together as one sentence of at
most ``FAINT_SUM``, so a text is rejected for sentences that stand out, never for its
length; a document that is predicted toxic has at least one located sentence.

Fitting uses a bounded sample: at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled
documents of at most ``MAX_CHARS`` characters, the first in the order of a hash
of their id.  Scoring reads every text whole, in one pass without a shuffle.
The model that is broadcast has at most ``MAX_FEATURES`` weights.

Defined cases: a null or empty text has no sentence and scores 0; a very long text is
scored whole; of rows that share an id, each is scored by its own text, and the
smallest text by hash stands for the id in fitting; extra columns, whatever their names,
are carried by :func:`clean_documents` and play no part; a document
with several label rows is toxic if one says so; null labels and labels of
unknown documents are ignored; without labels of both kinds every score is 0;
every input row gives one result row; a null id is never held out.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import map_batches, map_rows, quoted, table

MAX_TOXIC = 2000
MAX_CLEAN = 3000
MAX_CHARS = 20_000
MAX_FEATURES = 20_000
#: Documents of the sample that must hold a feature.
MIN_DOCS = 3
THRESHOLD = 0.7
#: Score of a sentence below which it counts together with others, and what all these count at most.
FAINT = 0.05
FAINT_SUM = 0.2
_SENTENCE = re.compile(r"[^.!?\n]+")
_TRIM = " \t\r\x0b\x0c,;:'\"()[]{}<>|*_-"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(word: str) -> list[str]:
    w = word.strip(_TRIM).lower()
    if not w:
        return []
    out = [w]
    for n in (4, 5):
        if len(w) > n:
            out += [w[:n] + "_", "_" + w[-n:]]
    return out


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Spans of the sentences of a text."""
    return [m.span() for m in _SENTENCE.finditer(text)] if text else []


class Model:
    """Weights of features and the bias of a sentence."""

    def __init__(self, weights: dict[str, float], bias: float) -> None:
        self.weights, self.bias = weights, bias

    def scorer(self, cache: int = 200_000):
        """``text -> (score, offending spans)``, with a bounded cache of words."""
        weights, bias = self.weights, self.bias

        class Words(dict):
            def __missing__(self, word: str) -> tuple[str, ...]:
                if len(self) >= cache:
                    self.clear()
                own = self[word] = tuple(f for f in features(word) if f in weights)
                return own

        words = Words()

        def score(text: str | None) -> tuple[float, list[tuple[int, int]]]:
            spans = sentences(text)
            if not spans or not weights:
                return 0.0, []
            # a feature counts once in a sentence, as in fitting
            z = np.array([sum(map(weights.__getitem__, set().union(*map(words.__getitem__, text[a:b].split()))))
                          for a, b in spans]) + bias
            clean = -np.logaddexp(0.0, z)  # log(1 - p) of each sentence
            faint = clean > np.log1p(-FAINT)
            total = float(-np.expm1(clean[~faint].sum() + max(clean[faint].sum(), np.log1p(-FAINT_SUM))))
            located = np.flatnonzero(z >= 0)
            if total >= THRESHOLD and not len(located):
                located = np.flatnonzero(z == z.max())
            return total, [spans[i] for i in located]

        return score


def fit(texts: list[str], toxic: list[int], rounds: int = 150, rate: float = 0.15, l1: float = 2e-4) -> Model:
    """Gradient descent on the document loss, weights shrunk towards 0 each step."""
    y = np.array(toxic, float)
    if not len(y) or y.min() == y.max():
        return Model({}, -20.0)
    ids: dict[str, int] = {}
    cached: dict[str, list[int]] = {}
    seen: tuple[Counter, Counter] = Counter(), Counter()
    flat, starts, owner = [], [0], []
    for d, text in enumerate(texts):
        own = set()
        for a, b in sentences(text):
            got = set()
            for w in text[a:b].split():
                if w not in cached:
                    cached[w] = [ids.setdefault(f, len(ids)) for f in features(w)]
                got.update(cached[w])
            flat.append(np.fromiter(got, np.int32, len(got)))
            own |= got
            owner.append(d)
            starts.append(starts[-1] + len(got))
        seen[int(y[d])].update(own)
    in_clean, in_toxic = (np.array([c.get(f, 0) for f in range(len(ids))], float) for c in seen)
    # features whose document rates differ most between the classes, in standard errors
    rate_all = (in_clean + in_toxic) / len(y)
    apart = np.abs(in_toxic / y.sum() - in_clean / (1 - y).sum()) / np.sqrt(rate_all * (1 - rate_all) + 1e-9)
    apart[in_clean + in_toxic < MIN_DOCS] = 0
    used = np.zeros(len(ids), bool)
    used[np.argsort(-apart, kind="stable")[:MAX_FEATURES]] = True
    used &= apart > 0
    idx = np.concatenate([*flat, np.empty(0, np.int32)])
    row = np.repeat(np.arange(len(owner), dtype=np.int32), np.diff(starts))
    keep = used[idx]
    number = np.cumsum(used) - 1
    idx, row = number[idx[keep]].astype(np.int32), row[keep]
    del flat
    owner = np.array(owner)
    n_w, n_s, n_d = int(used.sum()), len(owner), len(y)
    w, b = np.zeros(n_w), -7.0
    m, v = np.zeros(n_w + 1), np.zeros(n_w + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(row, w[idx], n_s) + b
        p = 1 / (1 + np.exp(-z))
        log_clean = np.bincount(owner, -np.logaddexp(0, z), n_d)
        is_toxic = np.clip(-np.expm1(log_clean), 1e-12, 1.0)
        # d loss / d z of a sentence: p in a clean document, -p (1 - P) / P in a toxic one
        by_doc = np.where(y > 0, -np.exp(log_clean) / is_toxic, 1.0)
        g = p * by_doc[owner] / n_d
        grad = np.append(np.bincount(idx, g[row], n_w), g.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w = w - move[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - rate * l1 / (np.sqrt(v[:-1] / (1 - 0.99**step)) + 1e-4), 0)
        b -= move[-1]
    names = np.array(list(ids))[used]
    return Model({str(n): float(x) for n, x in zip(names, w) if x}, float(b))


def training_sample(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> DataFrame:
    """``text, toxic`` of the bounded sample that the model is fitted on."""
    own = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
           .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    # the ids are chosen before any text moves
    ids = docs.where(F.col("doc_id").isNotNull() & (F.length("text") <= MAX_CHARS)).select(F.col("doc_id").alias("doc_id")).distinct()
    known = own.join(ids, "doc_id")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (known.where("toxic = 1").orderBy(*order).limit(max_toxic)
              .unionByName(known.where("toxic = 0").orderBy(*order).limit(max_clean)))
    texts = docs.where(F.length("text") <= MAX_CHARS).select("doc_id", "text")
    # at most max_toxic + max_clean ids are broadcast; one text of an id, the same on every run
    one = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return one.orderBy(*order).select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    rows = training_sample(docs, labels).collect()
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of ``docs`` (``doc_id, text``): score, decision, offending spans."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def make():
        f = Model(*shared.value).scorer()

        def run(rows: dict[str, list]) -> dict[str, list]:
            found = [f(t) for t in rows["text"]]
            return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": [x[0] for x in found],
                    "predicted": [int(x[0] >= THRESHOLD) for x in found],
                    "spans": [[{"start": a, "end": b} for a, b in x[1]] for x in found]}

        return run

    return map_rows(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), make,
                    "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start: int, end: int>>")


def clean_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    # one column holds the row, so that names of any kind pass through
    rows = docs.select(F.struct(*quoted(docs)).alias("row"), F.col("text").alias("text"))

    def keep(batches):
        import pyarrow as pa

        f = Model(*shared.value).scorer()
        for batch in batches:
            mask = [f(t)[0] < THRESHOLD for t in batch.column(1).to_pylist()]
            yield batch.select(["row"]).filter(pa.array(mask, pa.bool_()))

    return map_batches(rows, keep, rows.select("row").schema).select("row.*")


def op4_toxicity_mil(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
