"""A log-bilinear language model, trained by noise-contrastive estimation, over corpus-wide word counts.

The model's score of a word, or of a class of words, after two others is ``R[w] . (R[w1] C1 + R[w2] C2) + b[w]``. It
covers all words of the ``head`` up to ``vocabulary``, one end of text and one class of all other words. A word costs its
class among all classes, then itself among all words of its class; both normalisers are whole sums, so token
probabilities are normalised. A word of the open class costs the class's probability times its smoothed share of the
counts that the class stands for, an unseen word one slot.

Training passes over every training text, in rounds. A text's round and shard follow from a hash of
its id and text, the number of shards from the number of tokens, so neither depends on how the table is laid out. In a
round each shard runs stochastic gradient steps on its texts from the last round's model; then a word's parameters are
averaged over the shards that met it, by how often they did. More input means more shards, and beyond a number of them
more rounds; a shard and a step are of one size.

Word counts come from all training texts. The most frequent words (``head``, a fixed number) travel to the tasks;
all other words meet their counts in a join, whose keys are rare by construction.

Edge cases: null and empty texts are one end token; repeated doc_ids each get a row, null ones too; texts of any length
are read whole; of words equally frequent those of smaller hash, then bytes, come first; other columns are ignored; with
nothing to learn from every token costs log10(1 / (V + 1 + N)) = 0 by the base.
"""

from __future__ import annotations

import uuid
from collections import Counter
from itertools import pairwise

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, batch_of, crc_split, map_rows, rows_in_batches, shared_dir, ship, stored, table

END = b" "  # no word holds a space
OPEN, STOP = 0, 1  # ids of the open class and the end; the end also stands before a text's first word


def words_of(raw: bytes | None) -> list[bytes]:
    """Of bytes: A-Z lowered, cut at ASCII white space only."""
    return (raw or b"").lower().split()


def _raw(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("binary").alias("raw"))


def word_counts(docs: DataFrame, most: int = 300_000) -> DataFrame:
    """word, c over all texts, ends included. A task counts first, in a table of at most ``most`` words at a time."""
    schema = arrow_schema("word binary, c long")

    def run(batches):
        seen: Counter[bytes] = Counter()
        for (texts,) in rows_in_batches(batches, ["raw"], 256):
            for x in texts:
                seen.update(words_of(x))
            seen[END] += len(texts)
            if len(seen) > most:
                yield batch_of(schema, [list(seen), list(seen.values())])
                seen.clear()
        yield batch_of(schema, [list(seen), list(seen.values())])

    ship(docs.sparkSession)
    return stored(_raw(docs).select("raw").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


def class_starts(unigram: np.ndarray) -> np.ndarray:
    """First word of each class and, at last, the number of words. The open class and the end stand alone; the others,
    most frequent first, are cut at equal sums of the roots of their shares into as many classes as the root of their
    number, so frequent words share a class with few others."""
    roots = np.cumsum(np.sqrt(unigram[2:]))
    part = np.floor(roots / roots[-1] * np.ceil(np.sqrt(len(roots))) - 1e-9) if len(roots) else roots
    return np.concatenate([[0, 1], np.flatnonzero(np.diff(part, prepend=-2)) + 2, [len(unigram)]]).astype(np.int64)


def _against(own: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """1 - P(data) of data and P(data) of noise, from logits."""
    return 1 / (1 + np.exp(np.clip(own, -30, 30))), 1 / (1 + np.exp(-np.clip(others, -30, 30)))


class LogBilinear:
    """Parameters R (words x size), b of words, S (classes x size), a of classes, C1, C2 (size x size): all are views of
    one matrix ``rows``, a word or class with its bias in each of the first rows. ``starts`` are the classes' first
    words and the number of words; without it all words are one class."""

    def __init__(self, words: int, size: int, unigram: np.ndarray, starts: np.ndarray | None = None, seed: int = 1):
        r = np.random.default_rng(seed)
        self.starts = np.array([0, words]) if starts is None else starts
        self.sizes = np.diff(self.starts)
        self.of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.mass = np.add.reduceat(unigram, self.starts[:-1])
        n = words + len(self.sizes)
        self.load(np.zeros((n + 2 * size, size + 1), np.float32), words)
        self.rows[:n, :size] = r.normal(0, 0.1, (n, size))
        for c in self.C:
            c[:] = np.eye(size) * 0.5
        self.b[:], self.a[:] = np.log(unigram / self.mass[self.of]), np.log(self.mass)
        self.squares = np.full_like(self.rows, 1e-4)

    def load(self, rows: np.ndarray, words: int | None = None) -> LogBilinear:
        n, d = len(self.of) if words is None else words, rows.shape[1] - 1
        m = n + len(self.sizes)
        self.rows, self.R, self.b, self.S, self.a = rows, rows[:n, :d], rows[:n, d], rows[n:m, :d], rows[n:m, d]
        self.C = [rows[m : m + d, :d], rows[m + d :, :d]]
        return self

    def _climb(self, at: np.ndarray, grad: np.ndarray, rate: float) -> None:
        """Steps are scaled by the root of each parameter's summed squared gradients (Adagrad)."""
        seen = np.take(self.squares, at, axis=0) + grad * grad
        self.squares[at] = seen
        self.rows[at] += rate * grad / np.sqrt(seen)

    def nce_step(self, w: np.ndarray, w1: np.ndarray, w2: np.ndarray, random: np.random.Generator, class_noise: int, word_noise: int, rate: float) -> None:
        """One step on targets w after w1 (nearest) and w2: their classes against noise classes drawn by their shares,
        and the targets against noise words drawn evenly from each class; a batch shares both. A pair's logit is the
        model's score less the log of the expected noise count; data should win, noise lose."""
        words, d = self.R.shape
        n = words + len(self.sizes)
        order = np.argsort(w, kind="stable")  # so by class, too
        w, w1, w2 = w[order], w1[order], w2[order]
        rows, c, wide = self.rows, self.of[w], word_noise * (d + 1)
        r1, r2 = np.take(rows, w1, axis=0)[:, :d], np.take(rows, w2, axis=0)[:, :d]
        q = np.ones((len(w), d + 1), np.float32)  # the last column meets the biases
        q[:, :d] = r1 @ self.C[0] + r2 @ self.C[1]
        classes = rows[words:n]
        noise = np.minimum(np.searchsorted(np.cumsum(self.mass), random.random(class_noise)), len(self.mass) - 1)
        less = np.log(self.mass * class_noise).astype(np.float32)
        own, others = np.take(classes, c, axis=0), classes[noise]
        up, down = _against(np.einsum("nd,nd->n", q, own) - less[c], q @ others.T - less[noise])
        gq = up[:, None] * own - down @ others
        ids, parts = [w1, w2, words + c, words + noise], [None, None, up[:, None] * q, -(down.T @ q)]
        if len(i := np.flatnonzero(self.sizes[c] > 1)):
            t, k = q[i], c[i]
            at = np.flatnonzero(np.diff(k, prepend=-1))
            of = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(k))))
            drawn = self.starts[k[at], None] + (random.random((len(at), word_noise)) * self.sizes[k[at], None]).astype(np.int64)
            own, others = np.take(rows, w[i], axis=0), np.take(rows[drawn.ravel()].reshape(-1, wide), of, axis=0).reshape(-1, word_noise, d + 1)
            less = np.log(word_noise / self.sizes[k]).astype(np.float32)
            up, down = _against(np.einsum("nd,nd->n", t, own) - less, np.einsum("nd,nkd->nk", t, others) - less[:, None])
            gq[i] += up[:, None] * own - np.einsum("nk,nkd->nd", down, others)
            ids += [w[i], drawn.ravel()]
            pull = np.empty((len(at), word_noise, d + 1), np.float32)
            for j, (x, y) in enumerate(pairwise([*at.tolist(), len(k)])):
                np.dot(down[x:y].T, t[x:y], out=pull[j])
            parts += [up[:, None] * t, -pull.reshape(-1, d + 1)]
        for k, c in enumerate(self.C):
            parts[k] = np.zeros_like(gq)
            parts[k][:, :d] = gq[:, :d] @ c.T
        flat = np.concatenate(ids)
        order = np.argsort(flat.astype(np.uint16 if n <= 1 << 16 else np.int32), kind="stable")
        flat = flat[order]
        at = np.flatnonzero(np.diff(flat, prepend=-1))
        grad = np.zeros((2 * d, d + 1), np.float32)
        grad[:d, :d], grad[d:, :d] = r1.T @ gq[:, :d], r2.T @ gq[:, :d]
        self._climb(flat[at], np.add.reduceat(np.take(np.concatenate(parts), order, axis=0), at, axis=0), rate)
        self._climb(np.arange(n, n + 2 * d), grad, rate)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a model of one class: score by nearest word, by the one before (with b), and the log normaliser of each
        pair of them."""
        near, far = (self.R @ self.C[0] @ self.R.T).astype(np.float32), (self.R @ self.C[1] @ self.R.T + self.b).astype(np.float32)
        top = near.max(1)[:, None] + far.max(1)[None, :]
        e1, e2 = np.exp(near - near.max(1)[:, None], dtype=np.float64), np.exp(far - far.max(1)[:, None], dtype=np.float64)
        return near, far, (top + np.log(e1 @ e2.T)).astype(np.float32)  # sum over words of exp(near + far), as one product

    def scorer(self):
        """A function from targets and the two words before them to natural log probabilities: of the target's class
        among all classes, and of the target among all words of its class. Both normalisers are whole sums, over blocks
        of contexts; that of the classes is a sum of products of two factors, one of each word before, all found here once
        (8 bytes for each word and class)."""
        words, d = self.R.shape
        a1, a2 = np.zeros((words, d + 1), np.float32), np.ones((words, d + 1), np.float32)  # the last column meets the biases
        a1[:, :d], a2[:, :d] = self.R @ self.C[0], self.R @ self.C[1]
        rows, classes = self.rows, np.ascontiguousarray(self.rows[words : words + len(self.sizes)])

        def log_sum(q, rows):
            z = q @ rows.T
            with np.errstate(over="ignore"):
                total = np.exp(z, out=z) @ np.ones(len(rows), np.float32)
            fine = (total > 1e-30) & (total < 1e30)
            if fine.all():
                return np.log(total)
            z = (q @ rows.T).astype(np.float64)
            top = z.max(1)
            return top + np.log(np.exp(z - top[:, None]).sum(1))

        def factors(table):
            """Of each word as a context: exp(score by class less the largest), and the largest."""
            z = table @ classes.T
            top = z.max(1)
            z -= top[:, None]
            return np.exp(z, out=z), top

        (f1, top1), (f2, top2) = factors(a1), factors(a2)

        def score(w, w1, w2, contexts=1 << 17, cells=1 << 17):
            out = np.zeros(len(w))
            for lo in range(0, len(w), contexts):
                order = lo + np.argsort(w[lo : lo + contexts], kind="stable")  # so by class, too
                own, b1, b2 = w[order], w1[order], w2[order]
                q, c = np.take(a1, b1, axis=0) + np.take(a2, b2, axis=0), self.of[own]
                part = np.einsum("nd,nd->n", q, np.take(classes, c, axis=0)).astype(np.float64)
                step = max(1, cells // len(classes))
                for at in range(0, len(own), step):
                    i, j = b1[at : at + step], b2[at : at + step]
                    total = np.einsum("nk,nk->n", np.take(f1, i, axis=0), np.take(f2, j, axis=0))
                    norm = np.log(np.maximum(total, 1e-30)) + top1[i] + top2[j]
                    if len(far := np.flatnonzero(total < 1e-30)):
                        norm[far] = log_sum(q[at + far], classes)
                    part[at : at + step] -= norm
                ends = np.append(np.flatnonzero(np.diff(c, prepend=-1)), len(c)).tolist()
                for x, y in zip(ends, ends[1:]):
                    first, last = self.starts[c[x]], self.starts[c[x] + 1]
                    if last - first > 1:
                        part[x:y] += np.einsum("nd,nd->n", q[x:y], np.take(rows, own[x:y], axis=0))
                        step = max(1, cells // int(last - first))
                        for at in range(x, y, step):
                            part[at : min(at + step, y)] -= log_sum(q[at : min(at + step, y)], rows[first:last])
                out[order] = part
            return out

        return score


def _contexts(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, w2 = np.roll(ids, 1), np.roll(ids, 2)
    w1[starts] = STOP
    w2[starts] = STOP
    later = starts + 1
    w2[later[later < len(ids)]] = STOP
    return w1, w2


def _coded(rows: DataFrame, known: tuple, rounds: int, shards: int) -> DataFrame:
    """All that is read from the texts of ``rows`` (doc_id, text, learn, wanted), in one pass, stored by round: row, doc_id,
    learn, wanted, n_tokens, known (tokens with a count), base and opened (sums of logs of counts, of all tokens and of the
    open class's share), rare and times (words whose counts aren't in ``known``), ids (two bytes a token), and round, shard
    and u, a hash that orders a shard's texts. Copies of a text differ in their ids, rows without one in their number, so
    no group of copies meets in one shard. ``known``: words of the model, places of words, logs of counts, whether the end
    has a count, the log of the open class's counts."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(known)

    def make():
        closed, place, logs, end_known, log_rest = sent.value
        miss = len(place)  # of words that have no place; the end comes after it

        def step(numbers, doc_ids, learn, wanted, us, texts):
            get, at, starts, words = place.get, [], [], []
            for x in texts:
                found = words_of(x)
                starts.append(len(at))
                at += [get(w, miss) for w in found]
                at.append(miss + 1)
                words += found
                words.append(END)
            at, starts = np.array(at, dtype=np.int32), np.array(starts)
            end, opened = at > miss, (at >= closed) & (at <= miss)
            ids = np.where(end, STOP, np.where(opened, OPEN, at + 2)).astype("<u2")
            value = logs[at]
            total = lambda x: np.add.reduceat(x, starts, dtype=np.float64)
            rare: list[Counter] = [Counter() for _ in texts]
            for i, d in zip((far := np.flatnonzero(at == miss)).tolist(), (np.searchsorted(starts, far, side="right") - 1).tolist()):
                rare[d][words[i]] += 1
            ends = np.append(starts[1:], len(at))
            return [numbers, doc_ids, learn, wanted, us, ends - starts, total((at < miss) + end * end_known).astype(np.int64), total(value), total(np.where(opened, value - log_rest, 0)),
                    [list(r) for r in rare], [list(r.values()) for r in rare], [ids[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist())]]

        return step

    ddl = "row long, doc_id long, learn boolean, wanted boolean, u long, n_tokens long, known long, base double, opened double, rare array<binary>, times array<long>, ids binary"
    row = F.monotonically_increasing_id()
    u = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row "), row)), "text")
    coded = map_rows(rows.select(row.alias("row"), "doc_id", "learn", "wanted", u.alias("u"), F.col("text").cast("binary").alias("raw")), make, ddl, ["row", "doc_id", "learn", "wanted", "u", "raw"], most=512)
    coded = coded.withColumns({"shard": F.pmod(F.shiftright("u", 24), F.lit(shards)).cast("int"), "round": F.pmod("u", F.lit(rounds)).cast("int")})
    path = f"{shared_dir(spark)}/coded-{uuid.uuid4().hex}"
    coded.write.partitionBy("round").parquet(path)
    return spark.read.schema(coded.schema).parquet(path)


def rounds_and_shards(tokens: int, rounds: int = 8, shard_tokens: int = 2_000_000, most_shards: int = 4096) -> tuple[int, int]:
    """``rounds`` rounds of shards of about ``shard_tokens`` tokens. Where that would make over ``most_shards`` shards a
    round there are more rounds instead, so a shard is never more than one task's work, whatever the size of the input."""
    rounds = max(rounds, -(-tokens // (shard_tokens * most_shards)))
    return rounds, max(1, round(tokens / (rounds * shard_tokens)))


def train(coded: DataFrame, unigram: np.ndarray, rounds: int, shards: int, size: int = 16, class_noise: int = 32, word_noise: int = 5, batch: int = 4096, rate: float = 0.07) -> LogBilinear:
    """One pass over all texts of ``coded`` (round, shard, u, ids) in ``rounds`` rounds of ``shards`` shards. A step takes
    ``batch`` tokens, whatever the size of the input. Every shard ends with the rows of the words and classes that it met,
    weighed by how often, in blocks; a task of each block takes the means, and the driver sees one model, whatever the
    number of shards. Of the gradients' squared sums a mean for each row travels."""
    spark = coded.sparkSession
    starts = class_starts(unigram)
    model = LogBilinear(len(unigram), size, unigram, starts)
    n, width, wide = len(model.rows), size + 3, 1024  # a row, its mean squared gradients, its weight; rows of a block
    schema = arrow_schema("block int, k binary, v binary")

    def shard_of(sent, seed):
        def run(batches):
            rows, squares, unigram, starts = sent.value
            model, random, met = LogBilinear(len(unigram), size, unigram, starts), np.random.default_rng(seed + TaskContext.get().partitionId()), np.zeros(len(unigram), np.int64)
            model.load(rows.copy())
            model.squares[:] = squares[:, None]
            held, many = [], 0

            def learn():
                ids = np.concatenate(held).astype(np.int32)
                first = np.cumsum([0, *map(len, held[:-1])])
                w1, w2 = _contexts(ids, first)
                met[:] += np.bincount(ids, minlength=len(met))
                order = random.permutation(len(ids))
                for at in range(0, len(ids), batch):
                    i = order[at : at + batch]
                    model.nce_step(ids[i], w1[i], w2[i], random, class_noise, word_noise, rate)

            for part in batches:
                for x in part.column(0).to_pylist():
                    held.append(np.frombuffer(x, "<u2"))
                    many += len(held[-1])
                    if many > 1 << 17:
                        learn()
                        held, many = [], 0
            if held:
                learn()
            weight = np.concatenate([met, np.add.reduceat(met, starts[:-1]), np.full(2 * size, met.sum())])
            at = np.flatnonzero(weight)
            out = np.hstack([np.hstack([model.rows[at], model.squares[at].mean(1, keepdims=True)]) * weight[at, None], weight[at, None]]).astype("<f4")
            ends = np.append(np.flatnonzero(np.diff(at // wide, prepend=-1)), len(at)).tolist()
            for x, y in zip(ends, ends[1:]):
                yield batch_of(schema, [[int(at[x]) // wide], [at[x:y].astype("<i4").tobytes()], [out[x:y].tobytes()]])

        return run

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for part in batches:
            for block, k, v in zip(*(part.column(i).to_pylist() for i in range(3))):
                own = sums.setdefault(block, np.zeros((wide, width)))
                own[np.frombuffer(k, "<i4") - block * wide] += np.frombuffer(v, "<f4").reshape(-1, width)
        for block, own in sums.items():
            at = np.flatnonzero(own[:, -1])
            yield batch_of(schema, [[block], [(at + block * wide).astype("<i4").tobytes()], [(own[at, :-1] / own[at, -1:]).astype("<f4").tobytes()]])

    ship(spark)
    squares = model.squares[:, 0].copy()
    for r in range(rounds):
        sent = spark.sparkContext.broadcast((model.rows, squares, unigram, starts))
        texts = coded.filter(F.col("round") == r).repartitionById(shards, F.col("shard")).sortWithinPartitions("u").select("ids")
        rows, squares = model.rows.copy(), squares.copy()
        for x in texts.mapInArrow(shard_of(sent, 7 + r * shards), "block int, k binary, v binary").repartition("block").mapInArrow(merge, "block int, k binary, v binary").collect():
            at, found = np.frombuffer(x.k, "<i4"), np.frombuffer(x.v, "<f4").reshape(-1, width - 1)
            rows[at], squares[at] = found[:, :-1], found[:, -1]
        model.load(rows)
        sent.unpersist()
    return model


def frequent_words(words: DataFrame, head: int) -> list[tuple[bytes, int]]:
    """About the ``head`` most frequent words of ``words`` (word, c), most frequent first: all words from a count on, by a
    histogram of counts, and of the counts at which ``head`` is passed a share by the words' hash. So about ``head`` rows
    reach the driver, nothing is sorted, and there are words to learn however even the counts are."""
    step = F.floor(F.log2("c") * 8)  # counts in steps of an eighth of a doubling: a few hundred at most
    left, chosen = head, F.lit(True)
    for s, n in sorted(((r.s, r.n) for r in words.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()), reverse=True):
        if n > left:
            chosen = (step > s) | ((step == s) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < (left << 30) // n))
            break
        left -= n
    return sorted(((bytes(r.word), r.c) for r in words.filter(chosen).collect()), key=lambda x: (-x[1], x[0]))


def score(docs: DataFrame, training: DataFrame | Column, vocabulary: int = 65_536 - 512, head: int = 100_000) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every text of ``docs`` after learning from
    ``training``, other texts or a condition that tells which rows of ``docs`` to learn from. Texts are cut into words
    twice: for the counts, and for all else. ``vocabulary`` bounds the model's words (so its memory: words and classes
    number in 16 bits), ``head`` the counts that travel to the tasks."""
    spark = docs.sparkSession
    if isinstance(training, DataFrame):
        rows = docs.select("doc_id", "text", F.lit(False).alias("learn"), F.lit(True).alias("wanted")).unionByName(training.select("doc_id", "text", F.lit(True).alias("learn"), F.lit(False).alias("wanted")))
    else:
        rows = docs.select("doc_id", "text", training.alias("learn"), F.lit(True).alias("wanted"))
    counts = word_counts(rows.filter("learn"))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    words = counts.filter(F.col("word") != F.lit(END))
    top = frequent_words(words, head)
    ends = counts.filter(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    closed = np.array([ends] + [c for _, c in top[: vocabulary - 2]], dtype=np.float64)
    rest = total + distinct + 1 - (closed + 1).sum() if total else 1.0  # what the open class stands for: counts, a slot each, one unseen
    unigram = np.concatenate([[max(rest, 1.0)], closed + 1])
    unigram /= unigram.sum()
    logs = np.log10(np.array([c + 1 for _, c in top] + [1, ends + 1], dtype=np.float64))  # of the head, of other words until their count is known, of the end
    rounds, shards = rounds_and_shards(total)
    coded = _coded(rows, (len(closed) - 1, {w: i for i, (w, _) in enumerate(top)}, logs, int(ends > 0), float(np.log10(max(rest, 1.0)))), rounds, shards)
    model = train(coded.filter("learn"), unigram, rounds, shards) if total else LogBilinear(len(unigram), 4, unigram)
    sent = spark.sparkContext.broadcast(model)

    def make():
        model = sent.value
        if "score" not in vars(model):
            model.score = model.scorer()  # once for all tasks of a Python worker

        def step(numbers, texts):
            held = [np.frombuffer(x, "<u2") for x in texts]
            starts = np.cumsum([0, *map(len, held[:-1])])
            ids = np.concatenate(held).astype(np.int32)
            return [numbers, np.add.reduceat(model.score(ids, *_contexts(ids, starts)) / np.log(10), starts, dtype=np.float64)]

        return step

    wanted = coded.filter("wanted")
    scored = stored(map_rows(wanted, make, "row long, lm double", ["row", "ids"], most=512), "scored")
    rare = wanted.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("n"))
    tail = rare.join(counts, "word").groupBy("row").agg(F.sum("n").alias("tail_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("tail"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    base = float(np.log10(total + distinct + 1))
    return wanted.select("row", "doc_id", "n_tokens", "known", "base", "opened").join(scored, "row").join(tail, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + zero("tail_known")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("tail") - F.col("n_tokens") * base).alias("base_score"), (F.col("lm") + F.col("opened") + zero("tail")).alias("score"),
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_split(F.col("doc_id"), 7, 2)
    return score(docs, ~held_out).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


