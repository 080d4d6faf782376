"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and the first four to eight letters of longer words, so that inflected forms meet. The vocabulary is what separates the labels of
the examples by a likelihood-ratio test; how many documents hold a term is counted over the whole corpus. Examples
lie in blocks; the index keeps the largest weight of every term in every block, which bounds the cosine of the whole
block, so blocks that cannot hold one of the nearest are skipped without changing the result. The nearest vote by
their cosine, weighted back to the shares of the labels, and a logistic curve fitted on votes that leave the voter
out makes the vote a probability. The examples that decided are returned as evidence.

Bounds, as parameters: ``EXAMPLES`` of each label (by a hash of the id) and ``VOCABULARY`` terms. Only they are
broadcast; all else is counted over all documents, and all documents are scored.

Defined cases. NULL text counts as empty; a text without any term of the vocabulary has no neighbours and gets the
share of toxic examples among such texts. Labels that are NULL are ignored; an id with several labels is toxic if one
is. Without labels of both kinds all scores are the share of toxic labels (0 without labels). Repeated rows are each
scored. Labels, language, source and id are never inputs of a score. Further columns are not looked at.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import stored, strings

EXAMPLES = 3000
VOCABULARY = 4096
LEAST_RATIO = 20.0  # of the likelihood-ratio test
NEIGHBOURS = 15
BLOCK = 32
BEGIN = (4, 8)
THRESHOLD = 0.7
FOLDS, HELD = 3, 1
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))


def terms(text: str | None) -> Counter:
    """Words, lower-cased A-Z, and the beginnings of longer words (marked by a star)."""
    words = Counter(words_of(text))
    out = Counter(words)
    for w, n in words.items():
        for k in range(BEGIN[0], min(BEGIN[1], len(w) - 1) + 1):
            out[w[:k] + "*"] += n
    return out


def held_out(doc_id: str | None) -> bool:
    return zlib.crc32((doc_id or "").encode()) % FOLDS == HELD


def likelihood_ratio(a, b, n1, n0):
    """G-squared of a term in a of n1 and b of n0 documents."""
    total = n1 + n0

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    have, lack = a + b, total - a - b
    return 2 * (
        part(a, have * n1 / total) + part(b, have * n0 / total) + part(n1 - a, lack * n1 / total) + part(n0 - b, lack * n0 / total)
    )


def sharpest(ratios: dict[str, float]) -> list[str]:
    """The terms without those beginnings that a longer one of the vocabulary separates as well or better."""
    better = {}
    for t, ratio in ratios.items():
        if t.endswith("*"):
            for k in range(BEGIN[0], len(t) - 1):
                short = t[:k] + "*"
                better[short] = max(better.get(short, 0.0), ratio)
    return sorted(t for t, ratio in ratios.items() if ratio > better.get(t, 0.0))


@dataclass
class Index:
    """Block-max inverted index of unit vectors: postings by term, ordered by example, and block maxima."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    ids: list[int]
    labels: np.ndarray
    weight: np.ndarray  # of each example's vote
    begins: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    rows: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    block_max: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    share: float = 0.0  # of toxic labels
    alone: float = 0.0  # of toxic labels among texts without a term
    curve: tuple[float, float] = (1.0, 0.0)

    def __post_init__(self):
        """Beginnings by themselves, and their first letters: most words are dismissed by one look."""
        self.stems = {t[:-1]: i for t, i in self.vocabulary.items() if t.endswith("*")}
        self.firsts = {t[: BEGIN[0]] for t in self.stems}

    def found(self, text: str | None) -> tuple[dict[int, int], int]:
        """(how often each term of the vocabulary occurs, number of other words); as ``terms`` counts them."""
        out, others = {}, 0
        for w, n in Counter(words_of(text)).items():
            at = self.vocabulary.get(w)
            if at is None:
                others += n
            else:
                out[at] = out.get(at, 0) + n
            if w[: BEGIN[0]] in self.firsts:
                for k in range(BEGIN[0], min(BEGIN[1], len(w) - 1) + 1):
                    at = self.stems.get(w[:k])
                    if at is not None:
                        out[at] = out.get(at, 0) + n
        return out, others

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and unit weights (1 + log tf) * idf; the last number stands for all other words.

        That last term keeps a text with one telling word among many apart from a text full of them.
        """
        found, others = self.found(text)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.array([*found, len(self.vocabulary)])
        w = (1 + np.log([*found.values(), max(others, 1)])) * self.idf[at]
        return at, w / np.linalg.norm(w)

    def share_out(self) -> dict:
        """What a worker needs to make this index again."""
        return {k: v for k, v in vars(self).items() if k not in ("stems", "firsts")}

    def fill(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        rows = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        at = np.concatenate([np.zeros(0, np.int64), *[t for t, _ in vectors]])
        w = np.concatenate([np.zeros(0), *[v for _, v in vectors]])
        order = np.lexsort((rows, at))
        at, self.rows, self.values = at[order], rows[order], w[order]
        self.begins = np.searchsorted(at, np.arange(len(self.vocabulary) + 2))
        blocks = max(1, -(-len(vectors) // BLOCK))
        self.block_max = np.zeros((len(self.vocabulary) + 1, blocks))
        np.maximum.at(self.block_max, (at, self.rows // BLOCK), self.values)

    def _cosines(self, at: np.ndarray, w: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Cosines with the examples of the wanted blocks; 0 elsewhere."""
        out = np.zeros(len(self.ids))
        for t, q in zip(at, w):
            low, high = self.begins[t], self.begins[t + 1]
            rows = self.rows[low:high]
            out[rows] += q * self.values[low:high] * wanted[rows // BLOCK]
        return out

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest with a cosine above 0, nearest first, ties by example; exact."""
        bound = w @ self.block_max[at]
        best = np.argsort(-bound, kind="stable")
        wanted = np.zeros(len(bound), bool)
        wanted[best[: max(1, -(-4 * k // BLOCK))]] = True
        cosine = self._cosines(at, w, wanted)
        if without >= 0:
            cosine[without] = 0
        reached = np.partition(cosine, -k)[-k] if len(cosine) > k else 0.0
        if ((bound >= reached - 1e-12) & ~wanted & (bound > 0)).any():  # some other block may hold one of the nearest
            cosine = self._cosines(at, w, wanted | (bound >= reached - 1e-12))
            if without >= 0:
                cosine[without] = 0
        order = np.argsort(-np.round(cosine, 12), kind="stable")[:k]
        order = order[cosine[order] > 0]
        return order, cosine[order]

    def vote(self, order: np.ndarray, cosine: np.ndarray) -> float:
        """Share of the toxic weight, with a little of the overall share mixed in."""
        w = cosine * self.weight[order]
        return float((w @ self.labels[order] + 0.05 * self.share) / (w.sum() + 0.05))

    def score(self, text: str | None) -> tuple[float, np.ndarray, np.ndarray]:
        at, w = self.vector(text)
        order, cosine = self.nearest(at, w, NEIGHBOURS) if len(at) and len(self.ids) else (np.zeros(0, int), np.zeros(0))
        if not len(order):
            return self.alone, order, cosine
        return self._curve(self.vote(order, cosine)), order, cosine

    def _curve(self, p: float) -> float:
        p = min(max(p, 1e-6), 1 - 1e-6)
        return 1 / (1 + math.exp(-(self.curve[0] * math.log(p / (1 - p)) + self.curve[1])))


def fit_curve(raw: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from votes to labels, pulled towards (1, 0)."""
    raw = np.clip(raw, 1e-6, 1 - 1e-6)
    x = np.stack([np.log(raw / (1 - raw)), np.ones(len(raw))], axis=1)
    beta, pull = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - labels)) + (beta - pull)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.eye(2), grad)
        beta = beta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return (max(float(beta[0]), 0.05), float(beta[1]))


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fit(
    docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, vocabulary: int = VOCABULARY,
    id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic",
) -> Index:
    rows = _narrow(docs, id_col, text_col)
    fold = F.pmod(F.crc32(F.col("l_id").cast("binary")), F.lit(FOLDS))
    known = labels.select(F.col(label_id).cast("string").alias("l_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isNotNull() & F.col("l_id").isNotNull() & (fold != HELD))
    known = stored(known.groupBy("l_id").agg(F.max("label").alias("label")), "labels")
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not total.get(0) or not total.get(1):
        share = float(bool(total.get(1)))
        return Index({}, np.zeros(0), [], np.zeros(0), np.zeros(0), share=share, alone=share)
    order = [F.xxhash64("l_id"), F.col("l_id")]
    chosen = known.where("label = 0").orderBy(*order).limit(examples).unionByName(known.where("label = 1").orderBy(*order).limit(examples))
    picked = stored(rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id")).select("doc_id", "text", "label"), "toxicity-examples")
    sizes = {r["label"]: r["count"] for r in picked.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        share = total[1] / (total[0] + total[1])
        return Index({}, np.zeros(0), [], np.zeros(0), np.zeros(0), share=share, alone=share)

    def held_by(batches):
        counts = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, y in zip(strings(batch["text"]), batch["label"]):
                counts[y].update(terms(text).keys())
        for y in (0, 1):
            if counts[y]:
                yield pd.DataFrame({"term": list(counts[y].keys()), "toxic": y, "n": list(counts[y].values())})

    per = picked.mapInPandas(held_by, "term string, toxic int, n long").groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"),
    )
    a, b = F.col("a").cast("double"), F.col("b").cast("double")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    n, have = float(n1 + n0), a + b
    ratio = 2 * (
        part(a, have * n1 / n) + part(b, have * n0 / n) + part(n1 - a, (n - have) * n1 / n) + part(n0 - b, (n - have) * n0 / n)
    )
    best = per.withColumn("ratio", ratio).where(F.col("ratio") >= LEAST_RATIO).orderBy(F.desc("ratio"), "term").limit(vocabulary)
    numbers = {t: i for i, t in enumerate(sharpest({r["term"]: r["ratio"] for r in best.collect()}))}
    shared = docs.sparkSession.sparkContext.broadcast(numbers)  # VOCABULARY at most

    def frequency(batches):
        counts, texts = np.zeros(len(shared.value), np.int64), 0
        own = Index(shared.value, np.zeros(0), [], np.zeros(0), np.zeros(0))
        for batch in batches:
            for text in strings(batch["text"]):
                texts += 1
                counts[list(own.found(text)[0])] += 1
        yield pd.DataFrame({"at": [-1, *np.flatnonzero(counts)], "n": [texts, *counts[counts > 0]]})

    seen = {r["at"]: r["n"] for r in rows.mapInPandas(frequency, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    held = np.array([*[seen.get(i, 0) for i in range(len(numbers))], seen.get(-1, 0)], float)
    idf = np.log((1 + seen.get(-1, 0)) / (1 + held)) + 1
    model = Index(numbers, idf, [], np.zeros(0), np.zeros(0), share=total[1] / (total[0] + total[1]))

    parts = model.share_out()

    def vectors(batches):
        own = Index(**parts)
        for batch in batches:
            made = [own.vector(t) for t in strings(batch["text"])]
            yield pd.DataFrame({
                "doc_id": strings(batch["doc_id"]), "label": batch["label"], "at": [list(map(int, x)) for x, _ in made],
                "w": [list(map(float, y)) for _, y in made],
            })

    own = picked.mapInPandas(vectors, "doc_id string, label int, at array<int>, w array<double>").toPandas()  # bounded
    own = own.sort_values(["label", "doc_id"], kind="stable").reset_index(drop=True)
    model.ids, model.labels = [int(x) for x in own["doc_id"]], own["label"].to_numpy(float)
    model.weight = np.where(model.labels == 1, total[1] / n1, total[0] / n0)
    model.weight /= model.weight.mean()
    made = [(np.array(x, np.int64), np.array(y, float)) for x, y in zip(own["at"], own["w"])]
    # Examples of like terms side by side, so that the bounds of blocks are tight.
    lead = [(int(x[np.argmax(y)]) if len(x) else -1) for x, y in made]
    order = np.lexsort((np.arange(len(lead)), lead))
    model.ids, model.labels, model.weight = [model.ids[i] for i in order], model.labels[order], model.weight[order]
    made = [made[i] for i in order]
    model.fill(made)
    raw = np.full(len(made), np.nan)
    for i, (x, y) in enumerate(made):
        if len(x):
            near = model.nearest(x, y, NEIGHBOURS, without=i)
            if len(near[0]):
                raw[i] = model.vote(*near)
    some = ~np.isnan(raw)
    model.alone = float((model.weight[~some] @ model.labels[~some] + model.share) / (model.weight[~some].sum() + 1))
    if some.any():
        model.curve = fit_curve(raw[some], model.labels[some], model.weight[some])
    return model


def score(docs: DataFrame, model: Index, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, held_out, score, predicted, neighbours (example ids), cosines."""
    shared = docs.sparkSession.sparkContext.broadcast(model.share_out())

    def run(batches):
        own = Index(**shared.value)
        for batch in batches:
            made = [own.score(t) for t in strings(batch["text"])]
            yield pd.DataFrame({
                "doc_id": strings(batch["doc_id"]), "held_out": [held_out(x) for x in strings(batch["doc_id"])],
                "score": [float(p) for p, _, _ in made], "predicted": [int(p >= threshold) for p, _, _ in made],
                "neighbours": [[own.ids[i] for i in near] for _, near, _ in made],
                "cosines": [list(map(float, c)) for _, _, c in made],
            })

    rows = _narrow(docs, id_col, text_col).mapInPandas(
        run, "doc_id string, held_out boolean, score double, predicted int, neighbours array<long>, cosines array<double>"
    )
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def drop_toxic(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model.share_out())

    @F.pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        own = Index(**shared.value)
        return pd.Series([own.score(t)[0] >= threshold for t in strings(texts)], dtype=bool)

    return docs.where(~toxic(F.col(text_col).cast("string")))
