"""Toxicity by a counterfactual-regularised logistic model.

Features are the words of a text and their beginnings of four to six letters, present or not. In labelled texts that
name a group, identity terms are swapped for others; a labelled text that names none is paired with itself naming one,
chosen by a hash of its words. The squared change of the score's logit within a pair is penalised in training, so that
a term's mere mention doesn't move the score.

Edge cases: null and empty texts score by the bias alone; null labels are not learned, a document labelled twice is
toxic if either says so; without labels every score is 0; repeated doc_ids each get a row, null ones too; texts of any
length are read whole; features equally telling are ordered by name; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_split, hashed_share, map_rows, stored, table

LETTERS = re.compile(r"[^\W\d_]+")
#: Terms that name groups of people, by kind; each is swapped for the next of its kind.
IDENTITY = (
    ("women", "men", "girls", "boys"), ("woman", "man"), ("female", "male"), ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"), ("immigrant", "refugee", "native"), ("immigrants", "refugees", "natives"),
    ("disabled", "deaf", "blind", "autistic"), ("old", "young", "elderly"), ("femmes", "hommes"), ("frauen", "männer"), ("mujeres", "hombres"),
)
SWAP = {t: kind[(i + 1) % len(kind)] for kind in IDENTITY for i, t in enumerate(kind)}
TERMS = sorted(SWAP)


def features(words: set[str]) -> set[str]:
    return words | {f"{w[:k]}~" for w in words for k in (4, 5, 6) if len(w) > k}


def words_of(text: str | None) -> set[str]:
    return set(LETTERS.findall((text or "").lower()))


def fit(x: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], size: int, l2: float = 1e-4, fair: float = 1.0, steps: int = 300, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on log loss + l2 |w|^2 + fair * mean squared logit change of the pairs."""
    col = np.concatenate(x) if x else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(x)), [len(v) for v in x])
    pcol = np.concatenate([np.concatenate(p) for p in pairs]) if pairs else np.zeros(0, np.int64)
    prow = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    sign = np.concatenate([np.concatenate([np.ones(len(a)), -np.ones(len(b))]) for a, b in pairs]) if pairs else np.zeros(0)
    rate_of = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w, b, m, v = np.zeros(size), float(np.log(rate_of / (1 - rate_of))), np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(np.bincount(row, w[col], len(x)) + b)))
        err = (p - y) / len(y)
        g = np.bincount(col, err[row], size) + 2 * l2 * w
        if pairs:
            change = np.bincount(prow, sign * w[pcol], len(pairs))
            g += np.bincount(pcol, 2 * fair * sign * change[prow] / len(pairs), size)
        g = np.append(g, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        d = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - d[:-1], b - d[-1]
    return w, b


def counterfactual(words: set[str]) -> set[str]:
    """A text's words with its identity terms swapped, or with one added."""
    if words.isdisjoint(SWAP):
        return words | {TERMS[zlib.crc32(" ".join(sorted(words)).encode()) % len(TERMS)]}
    return {SWAP.get(w, w) for w in words}


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 20_000, max_chars: int = 60_000_000, least_docs: int = 5, least_z: float = 3.0, fair: float = 1.0) -> dict:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic). It reads about ``max_docs`` labelled rows of
    about ``max_chars`` characters at most, chosen by a hash of id and text (whole texts: a longer text takes the place of
    several), and keeps every feature of at least ``least_docs`` of them whose rate of toxic documents departs from the
    average by a z-score of ``least_z``; so what is sent to the driver is bounded by the sample. Equal rows, of one id and
    text, say nothing more together than one of them and are learned once; rows that share an id alone are learned one by
    one, each by its own text."""
    marked = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    few = hashed_share(marked, marked.count(), max_docs, "doc_id")  # about max_docs ids; their rows may be more
    labelled = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").withColumns({"h1": F.xxhash64("doc_id", "text"), "h2": F.xxhash64("text", "doc_id"), "chars": F.coalesce(F.length("text"), F.lit(0))})
    known = stored(labelled.groupBy("h1", "h2").agg(F.first("chars").alias("chars")), "labelled-rows")
    n, chars = known.agg(F.count("*"), F.coalesce(F.sum("chars"), F.lit(0))).first()
    chosen = hashed_share(known, n, min(max_docs, max(1, n * max_chars // chars)) if chars > max_chars else max_docs, "h1", "h2")

    def make():
        def step(texts, ys):
            out: list[list] = [[], [], [], ys]
            for x in texts:
                words = words_of(x)
                own, other = features(words), features(counterfactual(words))
                for column, found in zip(out, (own, own - other, other - own)):
                    column.append(sorted(found))
            return out

        return step

    sample = labelled.join(F.broadcast(chosen.select("h1", "h2")), ["h1", "h2"]).dropDuplicates(["h1", "h2"]).select("text", F.col("toxic").cast("long").alias("y"))  # about max_docs rows
    rows = stored(map_rows(sample, make, "own array<string>, lost array<string>, gained array<string>, y long", ["text", "y"], most=128), "labelled-features")  # what a swap takes and adds
    n, positive = rows.agg(F.count("*"), F.sum("y")).first()
    if not n:
        return {"index": {}, "w": np.zeros(0), "b": -np.inf}
    rate = positive / n
    seen = rows.select(F.explode("own").alias("f"), "y").groupBy("f").agg(F.count("*").alias("d"), F.sum("y").alias("p")).filter(F.col("d") >= least_docs)
    z = F.abs(F.col("p") - F.col("d") * rate) / F.sqrt(F.col("d") * max(rate * (1 - rate), 1e-9))
    index = {r.f: i for i, r in enumerate(seen.filter(z >= least_z).orderBy(z.desc(), "f").collect())}
    for t in TERMS:  # identity terms always take part in the penalty
        index.setdefault(t, len(index))
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def pick():
        known = sent.value

        def step(*columns):
            return [*[[[known[f] for f in x if f in known] for x in column] for column in columns[:3]], columns[3]]

        return step

    got = map_rows(rows, pick, "own array<int>, lost array<int>, gained array<int>, y long", ["own", "lost", "gained", "y"], most=128).collect()
    x = [np.array(r.own, dtype=np.int64) for r in got]
    pairs = [(np.array(r.lost, dtype=np.int64), np.array(r.gained, dtype=np.int64)) for r in got]
    w, b = fit(x, np.array([r.y for r in got], dtype=float), pairs, len(index), fair=fair)
    return {"index": index, "w": w, "b": b}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score (0 to 1) of whole texts. A word's weight, with its beginnings, is kept for the next text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        index, w, b = sent.value["index"], sent.value["w"], sent.value["b"]
        parts: dict[str, tuple[int, ...]] = {}

        def step(ids, texts):
            out = []
            for x in texts:
                found: set[int] = set()
                for word in words_of(x):
                    own = parts.get(word)
                    if own is None:
                        if len(parts) > 200_000:
                            parts.clear()
                        own = parts[word] = tuple(index[f] for f in features({word}) if f in index)
                    if own:
                        found.update(own)
                out.append(float(1 / (1 + np.exp(-(w[list(found)].sum() + b)))))
            return [ids, out]

        return step

    return map_rows(docs, make, "doc_id long, score double", ["doc_id", "text"])


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_split(F.col("doc_id"), 4, 2)
    model = train(docs, labels.filter(~held_out))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
