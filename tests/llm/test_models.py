"""op5, op6, op7 and op9: brute force, normalisation, held-out quality and odd tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from genoloom.llm import ann, language, lm, toxicity

from ..conftest import SMALL
from .helpers import no_documents, odd_documents, prose


def held(doc_id, modulus):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % modulus == 2


def brute_neighbours(rows, k=20, every=20):
    fine = [(i, np.array(v)) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) and i is not None]
    size = Counter(len(v) for _, v in fine).most_common(1)[0][0] if fine else 0
    fine = list({(i, tuple(v)): (i, v) for i, v in fine if len(v) == size}.values())
    out = {}
    for q, v in fine:
        if q % every == 0:
            out[q] = sorted(((-float(v @ x), i) for i, x in fine if i != q))[:k]
    return out


def test_neighbours_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    want = brute_neighbours(rows)
    got = {}
    for r in ann.op5_nearest_neighbours(spark, SMALL).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    x = dict(rows)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, len(found) + 1))
        assert all(abs(s - float(np.dot(x[q], x[i]))) < 1e-12 for _, i, s in found)
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)


def test_neighbours_recall_at_size(spark):
    """At least 0.9 of the true neighbours of 10,000 vectors."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").filter("embedding IS NOT NULL").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    got = {}
    for r in ann.op5_nearest_neighbours(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0).tolist():
        s = x @ x[q]
        s[q] = -np.inf
        want = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits, total = hits + len(want & got[int(ids[q])]), total + len(want)
    print("recall", hits / total)
    assert hits >= 0.9 * total


def test_neighbours_of_odd_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=8).tolist()) for i in range(60)] + [(100 + i, [1.0] * 8) for i in range(40)]  # forty equal vectors
    rows += [(200, None), (220, [0.0] * 8), (240, [1.0, None] + [0.0] * 6), (260, [float("nan")] * 8), (280, [float("inf")] * 8), (300, [1.0]), (320, []), (0, rows[0][1]), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<double>, uid int")
    want = brute_neighbours(rows)
    for blocks in (4096, 7):
        got = {}
        for x in ann.nearest(df, "vec_id % 20 = 0", lists=1, block_rows=blocks).orderBy("query_id", "rank").collect():
            got.setdefault(x.query_id, []).append(x.vec_id)
        assert set(got) == set(want)
        found = sum(len(set(got[q]) & {i for _, i in want[q]}) for q in want)
        assert found >= 0.97 * sum(map(len, want.values()))
        assert got[100] == [i for _, i in want[100]]  # ties go to the smaller ids
    for two in (1024, 4):  # the second by two levels of lists
        got = {}
        for x in ann.nearest(df, "vec_id % 20 = 0", lists=12, block_rows=16, two_levels=two).collect():
            got.setdefault(x.query_id, []).append(x.vec_id)
        assert sum(len(set(got[q]) & {i for _, i in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))
    shared = spark.createDataFrame([(20 * i, [1.0, 2.0]) for i in range(300)] + [(7, [2.0, 1.0]), (9, [3.0, 3.0])], "vec_id long, embedding array<double>")
    got = ann.nearest(shared, "vec_id % 20 = 0").collect()  # a vector that all queries share
    assert len(got) == 6000 and all(sorted((x.rank, x.vec_id) for x in got if x.query_id == q)[:2] == [(1, 9), (2, 0 if q else 20)] for q in (0, 20, 5980))
    few = ann.nearest(df.filter("vec_id in (0, 1, 2)"), "vec_id % 20 = 0").collect()
    assert len(few) == 2
    assert ann.nearest(df.filter("vec_id = 7"), "vec_id % 20 = 0").count() == 0 and ann.nearest(df.filter("vec_id = -1"), "vec_id % 20 = 0").count() == 0


def lm_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base_scores(rows):
    counts = Counter()
    for d, t in rows:
        if not held(d, 7):
            counts.update([*lm_words(t), " "])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        tokens = [*lm_words(t), " "]
        out.append((d, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), 4)))
    return sorted(out, key=str)


def test_lm_base_and_gain(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = lm.op6_lm_scoring(spark, SMALL).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=str) == base_scores(rows)
    out = [r for r in got if r.held_out]
    assert out and sum(r.score for r in out) > sum(r.base_score for r in out) and all(math.isfinite(r.score) and r.score <= 0 for r in got)


def test_lm_probabilities_are_normalised():
    u = np.array([0.5, 0.1, 0.2, 0.2])
    m = lm.LogBilinear(4, 3, u)
    m.R += 1
    near, far, norm = m.tables()
    p = np.exp(near[:, None, :] + far[None, :, :] - norm[:, :, None])
    assert np.allclose(p.sum(2), 1, atol=1e-4)


def test_lm_classes_are_normalised():
    u = np.random.default_rng(0).pareto(1, 300) + 0.01
    u[2:] = -np.sort(-u[2:])
    u /= u.sum()
    starts = lm.class_starts(u)
    assert starts[:3].tolist() == [0, 1, 2] and starts[-1] == 300 and (np.diff(starts) > 0).all() and len(starts) > 10 and np.diff(starts).max() < 100
    assert lm.class_starts(u[:2]).tolist() == [0, 1, 2]
    for spread in (1, 6):  # the second by the shifted sums, too
        m = lm.LogBilinear(300, 4, u, starts)
        m.rows[:] *= spread
        w, at = np.tile(np.arange(300), 20), np.repeat(np.random.default_rng(1).integers(0, 300, (20, 2)), 300, axis=0)
        p = np.exp(m.scorer()(w, at[:, 0], at[:, 1], contexts=1000, cells=500))
        assert np.allclose(p.reshape(20, 300).sum(1), 1, atol=1e-3)


def test_lm_learns_words_beyond_the_most_frequent(spark):
    r = np.random.default_rng(3)
    rows = [(i, " ".join(f"{'xy'[i % 2]}{j}" for j in r.integers(0, 1000, 100))) for i in range(1500)]  # two languages of 1000 even words
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gain = lambda **kw: lm.score(docs, docs, **kw).agg(F.sum(F.col("score") - F.col("base_score")) / F.sum("n_tokens")).first()[0]
    assert gain() > gain(vocabulary=512) + 0.05


def test_lm_gain_does_not_depend_on_the_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    gain = {}
    for n in (2, 200):
        laid = docs.repartition(n)
        got = lm.score(laid.filter(held_out), laid.filter(~held_out))
        gain[n] = got.agg(F.sum(F.col("score") - F.col("base_score")) / F.sum("n_tokens")).first()[0]
    print("held-out gain at 2 and 200 partitions", gain)
    assert gain[2] > 0.05 and abs(gain[2] - gain[200]) < 0.1 * gain[2]


def test_lm_score_equals_a_plain_restatement(spark, monkeypatch):
    """A given small model, its scores computed word by word in plain Python."""
    texts = [(i, " ".join(f"w{(i * i + 3 * j) % (5 + i % 17)}" for j in range(i % 23))) for i in range(120)] + [(500, None), (501, "unseen w1 WORDS w2"), (502, "w3")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    training = docs.filter("doc_id < 100")
    made = {}

    def given(coded, unigram, rounds, shards):
        made["model"] = lm.LogBilinear(len(unigram), 4, unigram, lm.class_starts(unigram), seed=3)
        made["model"].rows[: len(unigram)] += np.random.default_rng(9).normal(0, 0.3, (len(unigram), 5)).astype(np.float32)
        return made["model"]

    frequent = lm.frequent_words
    monkeypatch.setattr(lm, "train", given)
    monkeypatch.setattr(lm, "frequent_words", lambda *x: made.setdefault("top", frequent(*x)))
    got = {r.doc_id: r.score for r in lm.score(docs, training, vocabulary=12, head=20).collect()}
    counts = Counter(w for i, t in texts if i < 100 for w in (t or "").lower().split())
    total, distinct = sum(counts.values()) + 100, len(counts) + 1
    m, index = made["model"], {w.decode(): i + 2 for i, (w, _) in enumerate(made["top"][:10])}
    assert len(index) == 10 and set(index) < set(counts)
    rest = total + distinct + 1 - sum(counts[w] + 1 for w in index) - (100 + 1)
    for i, t in texts:
        tokens = [*(t or "").lower().split(), None]
        ids, want, before = [lm.STOP if w is None else index.get(w, lm.OPEN) for w in tokens], 0.0, [lm.STOP, lm.STOP]
        for w, k in zip(tokens, ids):
            q = m.R[before[-1]].astype(float) @ m.C[0] + m.R[before[-2]].astype(float) @ m.C[1]
            c = m.of[k]
            classes = [q @ m.S[j] + m.a[j] for j in range(len(m.sizes))]
            own = [q @ m.R[j] + m.b[j] for j in range(m.starts[c], m.starts[c + 1])]
            p = math.exp(classes[c]) / sum(map(math.exp, classes)) * (math.exp(own[k - m.starts[c]]) / sum(map(math.exp, own)) if len(own) > 1 else 1)
            want += math.log10(p * ((counts[w] + 1) / rest if k == lm.OPEN else 1))
            before.append(k)
        assert abs(got[i] - want) < 1e-3 * max(1, abs(want)), (i, got[i], want)


def test_lm_shards_are_of_one_size():
    """More input means more shards, then more rounds; a shard never grows."""
    assert lm.rounds_and_shards(0) == (8, 1) and lm.rounds_and_shards(160_000_000) == (8, 10)
    for tokens in (10**8, 10**10, 10**12, 2 * 10**13):
        rounds, shards = lm.rounds_and_shards(tokens)
        assert rounds >= 8 and shards <= 4096 and tokens / rounds / shards < 2_300_000


def test_lm_even_counts(spark):
    words = spark.createDataFrame([(f"w{i}".encode(), 5) for i in range(4000)] + [(b"often", 90)], "word binary, c long")
    top = lm.frequent_words(words, 500)
    assert top[0] == (b"often", 90) and 400 < len(top) < 600 and len(lm.frequent_words(words, 10_000)) == 4001 and lm.frequent_words(words.limit(0), 5) == []


def test_lm_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    got = lm.score(docs, docs.filter(~held_out), head=5).collect()  # nearly every count comes by the join
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got), key=str) == base_scores(rows)
    assert lm.score(no_documents(spark), no_documents(spark)).count() == 0
    assert all(r.base_score == 0 and r.n_known == 0 for r in lm.score(docs, no_documents(spark)).collect())


def test_language(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = [r for r in language.op7_language_id(spark, SMALL).collect()]
    out = [r for r in got if r.held_out]
    assert len(got) == len(langs) and all(r.held_out == held(r.doc_id, 4) and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == langs[r.doc_id] for r in out) >= 0.95 * len(out)


def plain_language(model, text, certain=30):
    """The backoff in plain Python."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not any(c.isalpha() for w in words for c in w):
        return "und", 0.0
    total = np.zeros(len(model["langs"]))
    for w in words:
        if w in model["words"]:
            total += model["logs"][model["words"][w]]
            continue
        for k in (4, 3, 2, 1):
            padded = f"_{w}_"
            known = [model["grams"][g] for j in range(len(padded) - k + 1) if (g := padded[j : j + k]) in model["grams"]]
            if known:
                total += model["logs"][known].mean(0, dtype=float)
                break
    z = total * min(1, certain / len(words))
    p = np.exp(z - z.max())
    return model["langs"][int(p.argmax())], float(p.max() / p.sum())


def test_language_equals_a_plain_restatement(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit_language_model(docs.select("doc_id", "text", "lang"))
    texts = [r.text for r in docs.limit(60).collect()]
    texts += ["".join(t.split())[:5000] for t in texts[:20]]  # long runs
    texts += [None, "", "x", "a-b_c1d don't \u00b2 \u00b23", "\u65e5\u672c\u8a9e the", "q" * 300_000, "word " * 5 + "zzzqj"]
    want = [plain_language(model, t) for t in texts]
    for spare in (200_000, 60):  # the second empties its table again and again
        got = language.LanguageScorer(model, spare=spare).judge(texts)
        assert [g[0] for g in got] == [w[0] for w in want] and np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-4)
    scorer = language.LanguageScorer(model)
    a, b = (scorer.unseen(["mot" * 1000 + "inconnu"], step=s)[0] for s in (50, 1 << 18))
    assert np.allclose(a, b)


def test_all_of_a_long_run_counts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("lang IN ('en', 'fr')")
    model = language.fit_language_model(docs.select("doc_id", "text", "lang"))
    run = {x: "".join(c for t in docs.filter(F.col("lang") == x).limit(20).collect() for c in t.text.lower() if c.isalpha()) for x in ("en", "fr")}
    scorer = language.LanguageScorer(model)
    assert scorer(run["fr"][:40])[0] == "fr" and scorer(run["en"][:4000])[0] == "en" and scorer(run["fr"][:40] + run["en"][:4000])[0] == "en"


def test_language_sample_of_equal_ids(spark):
    docs = spark.createDataFrame([(None if i % 2 else 7, f"unique{i} some words here", "en") for i in range(1000)], "doc_id long, text string, lang string")
    from genoloom.llm.common import hashed_share

    assert 50 < hashed_share(docs, 1000, 100, "doc_id", "text").count() < 160
    assert language.fit_language_model(docs, max_docs=100)["langs"] == ["en"] and 0 < len(language.fit_language_model(docs, max_chars=100)["words"]) < 10


def test_language_odd_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.fit_language_model(docs.select("doc_id", "text", "lang"))
    got = {r.doc_id: r for r in language.identify(odd_documents(spark), model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1, 2, 3, 4)) and got[7].lang_pred in model["langs"]
    kept = language.keep_known(odd_documents(spark), model)
    assert kept.columns == odd_documents(spark).columns and not {1, 2, 3, 4} & {r.doc_id for r in kept.collect()}
    none = language.fit_language_model(docs.filter("lang = 'xx'").select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in language.identify(odd_documents(spark), none).collect()} == {"und"}
    scorer = language.LanguageScorer(model)
    assert scorer("Whenthereing") == scorer("whenthereing") and scorer("日本語")[1] == 1 / len(model["langs"])


def test_unknown_texts_go_with_few_languages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("lang IS NOT NULL").select("doc_id", "text", "lang")
    langs = sorted(r.lang for r in docs.select("lang").distinct().collect())
    some = spark.createDataFrame([(1, "\u65e5\u672c\u8a9e"), (2, docs.filter(F.col("lang") == langs[0]).first().text), (3, None)], "doc_id long, text string")
    for n in (1, 2):
        model = language.fit_language_model(docs.filter(F.col("lang").isin(langs[:n])))
        assert len(model["langs"]) == n and [r.doc_id for r in language.keep_known(some, model).collect()] == [2]


def test_toxicity(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = toxicity.op9_toxicity(spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == held(r.doc_id, 4) for r in got)
    out = [r for r in got if r.held_out]
    yes, no = [r.score for r in out if r.toxic], [r.score for r in out if not r.toxic]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in yes for b in no])
    assert auc > 0.85 and np.mean([s >= 0.3 for s in no]) < 0.05
    assert docs.count() == toxicity.op9_toxicity(spark, "/root/testdata/sf0.01").count()


def test_toxicity_equals_a_plain_restatement(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = {r.doc_id: r.text for r in docs.collect()}
    for r in toxicity.score(docs, model).collect():
        words = set(re.findall(r"[^\W\d_]+", (rows[r.doc_id] or "").lower()))
        own = words | {w[:k] + "~" for w in words for k in (4, 5, 6) if len(w) > k}
        z = model["b"] + sum(model["w"][model["index"][f]] for f in own if f in model["index"])
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9


def test_penalty_on_the_given_texts(spark):
    """Identity terms put into labelled texts, more often into toxic ones: the penalty takes away what swapping them does
    to held-out texts, and leaves the ranking of toxic ones."""
    at = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{at}/labels.parquet").filter("toxic IS NOT NULL").select("doc_id", "toxic")
    docs = spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").join(labels, "doc_id")
    rows = [(r.doc_id, f"{r.text} {'muslim' if (r.doc_id % 10 < 8) == bool(r.toxic) else 'christian'} neighbours", r.toxic) for r in docs.collect()]
    marked = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    held_out = [r for r in rows if held(r[0], 4)]
    swapped = {d: t.replace("muslim", "\0").replace("christian", "muslim").replace("\0", "christian") for d, t, _ in held_out}
    change, auc = {}, {}
    for fair in (0.0, 1.0):
        train_on = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
        model = toxicity.train(marked.filter(train_on).select("doc_id", "text"), marked.filter(train_on).select("doc_id", "toxic"), fair=fair)
        of = lambda pairs: {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(pairs, "doc_id long, text string"), model).collect()}  # noqa: B023, E731
        a, b = of([r[:2] for r in held_out]), of(list(swapped.items()))
        change[fair] = np.mean([abs(a[d] - b[d]) for d in a])
        yes, no = [a[d] for d, _, y in held_out if y], [a[d] for d, _, y in held_out if not y]
        auc[fair] = np.mean([(x > y) + 0.5 * (x == y) for x in yes for y in no])
    print("mean score change by swapping:", change, "AUC:", auc)
    assert change[1.0] < 0.5 * change[0.0] and auc[1.0] > auc[0.0] - 0.05


def test_identity_terms_lose_their_weight(spark):
    rows = [(i, f"{prose(i, 20)} {'muslim idiot' if i % 4 == 0 else 'christian person' if i % 4 == 1 else 'idiot' if i % 4 == 2 else 'person'}", int(i % 2 == 0)) for i in range(200)]
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    gap = {}
    for fair in (0.0, 5.0):
        model = toxicity.train(docs, labels, fair=fair)
        s = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame([(1, "muslim people"), (2, "christian people"), (3, None), (4, "")], "doc_id long, text string"), model).collect()}
        gap[fair] = abs(math.log(s[1] / (1 - s[1])) - math.log(s[2] / (1 - s[2])))
        assert s[3] == s[4]
    assert gap[5.0] < 0.5 * gap[0.0]


def test_toxicity_sample_is_bounded_in_rows_and_characters(spark, monkeypatch):
    """Few ids with thousands of rows: rows count, not ids; and few long texts in place of many."""
    fitted, fit = [], toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda x, y, *more, **named: (fitted.append(len(x)), fit(x, y, *more, **named))[1])
    docs = spark.createDataFrame([(i % 6, f"{prose(i, 12)} {'idiot' if i % 6 % 2 else 'person'}") for i in range(6000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, max_docs=400)
    assert 250 <= fitted[-1] <= 550 and model["w"][model["index"]["idiot"]] > 0
    chars = docs.selectExpr("sum(length(text))").first()[0]
    toxicity.train(docs, labels, max_chars=chars // 20)
    assert 200 <= fitted[-1] <= 420
    toxicity.train(docs.unionByName(docs), labels)
    assert fitted[-1] == docs.distinct().count()  # equal rows are learned once


def test_toxicity_odd_documents(spark):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (6, None, 1), (10, 0, 1), (None, 1, 1)], "doc_id long, toxic int, row int")
    docs = odd_documents(spark)
    model = toxicity.train(docs, labels)
    assert toxicity.score(docs, model).count() == docs.count()
    assert all(r.score == 0 for r in toxicity.score(docs, toxicity.train(docs, labels.filter("doc_id = 99"))).collect())
    assert toxicity.score(no_documents(spark), model).count() == 0
