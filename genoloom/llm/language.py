"""Language identification by word-first backoff.

A word (a run of letters) seen in training scores by its log frequency in each language; an unseen word by the mean over
its character n-grams, the longest order of which any gram is known (4, then 3, 2, 1), over the whole run, however long.
A text's score is the sum over its words. Texts are split at white space; each distinct piece of a batch is scored
once, unseen words together by array operations over a tree of n-grams, and kept for later batches.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; a text whose words and grams are all unknown
gets the same score, 1 / languages, for every language (the first by name wins, as in any tie); labels and texts that
are null are not learned; without any labelled text everything is ``und``. Repeated doc_ids each get a row, null ones too.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, batch_of, crc_split, hashed_share, kept_rows, map_rows, rows_in_batches, ship, stored, table

ORDERS = (4, 3, 2, 1)
LETTERS = re.compile(r"[^\W\d_]+")
EDGE = "_"  # stands before and after a word in its n-grams; alone it is none


def unit_counts(texts: DataFrame, most: int = 200_000) -> DataFrame:
    """lang, k, unit, n of ``texts`` (lang, text): words (k = 0) and padded n-grams of each order. A task counts first, in
    a table of at most ``most`` words at a time."""
    schema = arrow_schema("lang string, k int, unit string, n long")

    def units(seen: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, words in seen.items():
            grams = [Counter() for _ in range(max(ORDERS) + 1)]
            for word, n in words.items():
                grams[0][word] += n
                padded = f"{EDGE}{word}{EDGE}"
                for k in ORDERS:
                    for j in range(len(padded) - k + 1):
                        grams[k][padded[j : j + k]] += n
            del grams[1][EDGE]
            for k, found in enumerate(grams):
                yield batch_of(schema, [[lang] * len(found), [k] * len(found), list(found), list(found.values())])
        seen.clear()

    def run(batches):
        seen: dict[str, Counter] = {}
        for langs, rows in rows_in_batches(batches, ["lang", "text"], 64):
            for lang, text in zip(langs, rows):
                seen.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
            if sum(map(len, seen.values())) > most:
                yield from units(seen)
        yield from units(seen)

    ship(texts.sparkSession)
    return texts.select("lang", "text").mapInArrow(run, "lang string, k int, unit string, n long").groupBy("lang", "k", "unit").agg(F.sum("n").alias("n"))


def fit_language_model(labelled: DataFrame, max_docs: int = 6000, max_chars: int = 30_000_000, least: int = 3, smooth: float = 0.5) -> dict:
    """Log frequencies by language of the words and padded character n-grams seen at least ``least`` times in
    ``labelled`` (doc_id, text, lang). About ``max_docs`` labelled documents, or fewer if those would hold more than about
    ``max_chars`` characters, are read, chosen by a hash of id and text; every such word and gram of them is kept."""
    known = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    n, chars = known.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    texts = hashed_share(known, n, min(max_docs, n * max_chars // max(chars, 1) + 1), "doc_id", "text")
    counts = unit_counts(texts).groupBy("k", "unit").agg(F.collect_list(F.struct("lang", "n")).alias("by"), F.sum("n").alias("all")).filter(F.col("all") >= least)
    rows = [(r.k, r.unit, [(x.lang, x.n) for x in r.by]) for r in stored(counts, "language-units").orderBy("k", "unit").collect()]
    langs = sorted({lang for *_, by in rows for lang, _ in by})
    n_of = np.zeros((len(rows), len(langs)))
    at = {lang: i for i, lang in enumerate(langs)}
    for i, (*_, by) in enumerate(rows):
        for lang, c in by:
            n_of[i, at[lang]] = c
    order = np.array([k for k, *_ in rows], dtype=np.int64)
    logs = np.zeros(n_of.shape, np.float32)
    for k in set(order.tolist()):
        own = order == k
        logs[own] = np.log((n_of[own] + smooth) / (n_of[own].sum(0) + smooth * own.sum()))
    return {"langs": langs, "words": {u: i for i, (k, u, _) in enumerate(rows) if not k}, "grams": {u: i for i, (k, u, _) in enumerate(rows) if k}, "logs": logs}


class GramTree:
    """The known n-grams as a tree: a node's child is found by (node, character) among the sorted keys of its level."""

    def __init__(self, grams: dict[str, int]):
        nodes = {u[:k]: 0 for u in grams for k in range(1, len(u) + 1)}
        levels: list[list[str]] = [[] for _ in range(max(ORDERS) + 1)]
        for u in nodes:
            levels[len(u)].append(u)
        self.row = np.full(len(nodes) + 1, -1, np.int64)  # node 0: not in the tree
        self.first, self.keys, self.to, at = np.zeros(0x110000, np.int64), [], [], 1
        for k, level in enumerate(levels):
            for u in level:
                nodes[u] = at
                self.row[at] = grams.get(u, -1)
                at += 1
            if k == 1:
                self.first[[ord(u) for u in level]] = [nodes[u] for u in level]
            elif k:
                key = np.array([nodes[u[:-1]] << 21 | ord(u[-1]) for u in level], dtype=np.int64)
                order = np.argsort(key)
                self.keys.append(key[order])
                self.to.append(np.array([nodes[u] for u in level], dtype=np.int64)[order])

    def rows(self, codes: np.ndarray, of: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each order, the words (``of``) and table rows of the known grams that start in the first ``n`` places."""
        node = self.first[codes]
        for k in range(1, max(ORDERS) + 1):
            if k > 1:
                key, keys = node[:-1] << 21 | codes[k - 1 :], self.keys[k - 2]
                place = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
                node = np.where((keys[place] == key) & (of[k - 1 :] == of[: len(key)]), self.to[k - 2][place], 0) if len(keys) else np.zeros(len(key), np.int64)
            row = self.row[node[:n]]
            at = np.flatnonzero(row >= 0)
            yield k, of[at], row[at]


class LanguageScorer:
    """Scores texts. Pieces of text met before keep their row of a table: summed log frequencies of their words, the
    number of words, of known words or grams, and of letters (``spare`` pieces at a time, in slices of half as many)."""

    def __init__(self, model: dict, spare: int = 100_000, certain: int = 30):
        self.langs, self.certain, self.spare, self.words = model["langs"], certain, spare, model["words"]
        self.logs, self.tree = model["logs"], GramTree(model["grams"])
        self.table = np.zeros((spare, len(self.langs) + 3), np.float32)
        self.seen: dict[str, int] = {}

    def unseen(self, words: list[str], step: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
        """Log frequencies of words by their n-grams, and whether any is known. Long runs go in steps of ``step`` letters."""
        n, size = len(words), len(self.langs)
        codes = np.frombuffer("".join(f"{EDGE}{w}{EDGE}" for w in words).encode("utf-32-le"), np.uint32).astype(np.int64)
        of = np.repeat(np.arange(n), [len(w) + 2 for w in words])
        sums, found = np.zeros((max(ORDERS) + 1, n, size)), np.zeros((max(ORDERS) + 1, n))
        for at in range(0, len(codes), step):
            for k, word, row in self.tree.rows(codes[at : at + step + max(ORDERS) - 1], of[at : at + step + max(ORDERS) - 1], min(step, len(codes) - at)):
                if len(word):
                    low, high = int(word[0]), int(word[-1]) + 1
                    found[k, low:high] += np.bincount(word - low, minlength=high - low)
                    for j in range(size):
                        sums[k, low:high, j] += np.bincount(word - low, self.logs[row, j], high - low)
        best = (np.arange(max(ORDERS) + 1)[:, None] * (found > 0)).max(0)  # the longest order with a known gram; 0: none
        return sums[best, np.arange(n)] / np.maximum(found[best, np.arange(n)], 1)[:, None], best > 0

    def _learn(self, pieces: list[str]) -> None:
        """Give ``pieces``, none of them seen, their rows."""
        if len(self.seen) + len(pieces) > self.spare:
            self.seen.clear()
        size, first = len(self.langs), len(self.seen)
        words, of = [], []
        for i, piece in enumerate(pieces):
            self.seen[piece] = first + i
            found = [piece] if piece.isalpha() else LETTERS.findall(piece)
            words += found
            of += [i] * len(found)
        rows = np.zeros((len(pieces), size + 3))
        if words:
            distinct = list(dict.fromkeys(words))
            place = {w: i for i, w in enumerate(distinct)}
            logs, known = np.zeros((len(distinct), size)), np.ones(len(distinct), bool)
            new = [w for w in distinct if w not in self.words]
            old = [w for w in distinct if w in self.words]
            logs[[place[w] for w in old]] = self.logs[[self.words[w] for w in old]]
            if new:
                at = [place[w] for w in new]
                logs[at], known[at] = self.unseen(new)
            at = np.array([place[w] for w in words])
            letters = np.array([any(map(str.isalpha, w)) for w in distinct])
            np.add.at(rows, np.array(of), np.hstack([logs[at], np.ones((len(at), 1)), known[at, None], letters[at, None]]))
        self.table[first : first + len(pieces)] = rows

    def judge(self, texts: list[str | None], slice_: int | None = None) -> list[tuple[str, float, bool]]:
        """For each text: language, score, and whether any word or gram of it is known."""
        if not self.langs:
            return [("und", 0.0, False)] * len(texts)
        slice_ = slice_ or self.spare // 2
        totals = np.zeros((len(texts), self.table.shape[1]))
        pieces: list[str] = []
        ends: list[int] = []

        def add(first: int) -> None:
            """Sum up the pieces at hand, of the texts from number ``first`` on."""
            for at in range(0, len(pieces), slice_):
                part = pieces[at : at + slice_]
                if new := list(dict.fromkeys(w for w in part if w not in self.seen)):
                    self._learn(new)
                    if any(w not in self.seen for w in part):  # the table was emptied for the new ones
                        self._learn(list(dict.fromkeys(w for w in part if w not in self.seen)))
                rows = np.fromiter(map(self.seen.__getitem__, part), np.int64, len(part))
                of = np.searchsorted(ends, np.arange(at, at + len(part)), side="right")
                starts = np.flatnonzero(np.diff(of, prepend=-1))
                totals[first + of[starts]] += np.add.reduceat(self.table[rows], starts, axis=0, dtype=np.float64)

        first = 0
        for i, text in enumerate(texts):
            if text:
                pieces += text.lower().split()
            ends.append(len(pieces))
            if len(pieces) >= slice_ or i == len(texts) - 1:
                add(first)
                pieces, ends, first = [], [], i + 1
        out = []
        for *logs, n, known, letters in totals.tolist():
            if not letters:
                out.append(("und", 0.0, False))
                continue
            z = np.array(logs) * min(1.0, self.certain / n)  # words of a text aren't independent
            p = np.exp(z - z.max())
            best = int(p.argmax())
            out.append((self.langs[best], float(p[best] / p.sum()), known > 0))
        return out

    def __call__(self, text: str | None) -> tuple[str, float]:
        return self.judge([text])[0][:2]


def _scorer(model: dict) -> LanguageScorer:
    """One scorer for all tasks of a Python worker that read the same broadcast model."""
    if "scorer" not in model:
        model["scorer"] = LanguageScorer(model)
    return model["scorer"]


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) of whole texts."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = _scorer(sent.value)

        def step(ids, texts):
            found = scorer.judge(texts)
            return [ids, [f[0] for f in found], [f[1] for f in found]]

        return step

    return map_rows(docs, make, "doc_id long, lang_pred string, score double", ["doc_id", "text"])


def keep_known(docs: DataFrame, model: dict, least: float = 0.35) -> DataFrame:
    """``docs`` without those that are ``und``, hold no known word or gram (whatever the number of languages), or whose
    language scores under ``least`` (short clean texts may score under a half, and stay). All other columns stay as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = _scorer(sent.value)
        return lambda texts: [lang != "und" and known and s >= least for lang, s, known in scorer.judge(texts)]

    return kept_rows(docs, make)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_split(F.col("doc_id"), 4, 2)
    model = fit_language_model(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
