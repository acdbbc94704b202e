"""op11, op12 and op13: brute force, SQL, hot groups and odd tables."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from genoloom.llm import codebooks, quantised, whitening
from genoloom.llm.registry import ORACLE_SQL, QUERIES

from ..conftest import SMALL
from ..oracle import spark_rows, sql_rows

ODD = [(900, None), (901, []), (902, [0.0] * 64), (903, [1.0] * 63 + [None]), (904, [1.0] * 63 + [math.nan]), (905, [math.inf] * 64), (906, [1.0] * 5), (None, None), (None, [0.5] * 64), (None, [0.5] * 64),
       (907, [0.5] * 64), (908, [0.25] * 64), (908, [0.25] * 64), (909, [1e-300] * 64), (910, [3e38] + [0.0] * 63)]


def vectors(spark, rows):
    """The columns vec_id, embedding, label, and others whose names the operators use inside."""
    return spark.createDataFrame([(i, v, None if i is None or i % 3 == 0 else str(i % 3), 1, "x", None) for i, v in rows], "vec_id long, embedding array<float>, label string, row long, raw string, list long")


def planted(seed=1, n=700, d=64):
    """Lone vectors, pairs around the threshold, chains, copies, and a tight group of a third of all rows."""
    r = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    lone = unit(r.normal(size=(n, d)))
    other = unit(r.normal(size=(n, d)) - (r.normal(size=(n, d)) * lone).sum(1)[:, None] * lone)
    cos = r.uniform(0.86, 0.94, size=(n, 1))
    near = unit(cos * lone + np.sqrt(1 - cos * cos) * unit(other - (other * lone).sum(1)[:, None] * lone))
    tight = unit(lone[:1] + r.normal(size=(n, d)) * 0.012)
    loose = unit(lone[1:2] + r.normal(size=(200, d)) * 0.045)
    x = np.vstack([lone, near, tight, loose, lone[:50] * 2, near[:50]])
    order = r.permutation(len(x))
    return [(int(i), [float(c) for c in x[j].astype(np.float32)]) for i, j in enumerate(order)]


def brute_links(rows, least=0.9):
    """For each row: its links and the least id of its component."""
    rows = [(i, v and [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    fine = [k for k, (_, v) in enumerate(rows) if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    size = Counter(len(rows[k][1]) for k in fine).most_common(1)[0][0] if fine else 0
    fine = [k for k in fine if len(rows[k][1]) == size]
    out = {k: (0, i) for k, (i, _) in enumerate(rows)}
    if fine:
        x = np.array([rows[k][1] for k in fine], np.float64)
        x /= np.abs(x).max(1)[:, None]
        x /= np.linalg.norm(x, axis=1)[:, None]
        linked = x @ x.T >= least
        reach = np.arange(len(x))
        while True:
            low = np.where(linked, reach[None, :], len(x)).min(1)
            if (low == reach).all():
                break
            reach = low
        for j, k in enumerate(fine):
            ids = [rows[fine[m]][0] for m in np.flatnonzero(reach == reach[j]) if rows[fine[m]][0] is not None]
            out[k] = (int(linked[j].sum()) - 1, min(ids, default=None))
    return Counter((rows[k][0], n, c, rows[k][0] == c) for k, (n, c) in out.items())


def found_links(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("name", ["op11_embedding_near_dedup", "op13_vector_codes"])
def test_matches_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(ORACLE_SQL[name], SMALL)


@pytest.mark.parametrize("index", [{}, {"block_rows": 64, "lists": 40, "hot": 8}, {"lists": 1, "hot": 10_000}, {"subspaces": 7, "entries": 4, "sample": 300}])
def test_no_link_is_lost(spark, index):
    """Pairs on both sides of the threshold, chains over cells, copies, and a hot group with and without its ball."""
    rows = planted()
    assert found_links(quantised.near_duplicate_vectors(vectors(spark, rows), **index)) == brute_links(rows)


def test_vectors_do_not_travel_to_the_lists_they_ask(spark):
    """Without clusters every vector asks most blocks: what is shuffled doesn't follow their number."""
    x = np.random.default_rng(8).normal(size=(1200, 64))
    df = vectors(spark, [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)])

    def shuffled():
        none, it = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), []
        stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, none, None).iterator()
        while stages.hasNext():
            it.append(stages.next().shuffleWriteBytes())
        return sum(it)

    sizes = [shuffled()]
    for rows in (4096, 48):
        assert quantised.near_duplicate_vectors(df, block_rows=rows, lists=60).filter("kept").count() == 1200
        sizes.append(shuffled())
    assert sizes[2] - sizes[1] < 1.5 * (sizes[1] - sizes[0])


def test_a_hot_group_is_a_ball(spark):
    rows = planted()
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    reach = math.sqrt(0.2) / 2
    balls = quantised.find_balls(x, np.zeros(len(x), int), reach, 100)
    assert 1 <= len(balls) <= 2
    inside = x[x @ balls[0] >= 1 - reach * reach / 2]
    assert len(inside) >= 700 and (inside @ inside.T).min() >= 0.9


def test_codes_bound_the_distance():
    """What the codes let pass holds every vector within reach, for any query."""
    r = np.random.default_rng(4)
    x = r.normal(size=(500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    books = quantised.quantisers(x, 16, 16)
    back = quantised.decode(quantised.encode(x, books), books)
    left = np.linalg.norm(x - back, axis=1)
    true = np.linalg.norm(x[:, None] - x[None], axis=2)
    assert (np.linalg.norm(x[:, None] - back[None], axis=2) <= true + left[None] + 1e-12).all()


def test_near_duplicates_of_odd_vectors(spark):
    rows = [*planted(n=30), *[(i if i is None else i + 5000, v) for i, v in ODD]]
    assert found_links(quantised.near_duplicate_vectors(vectors(spark, rows))) == brute_links(rows)
    only_bad = [(1, None), (2, [0.0, 0.0])]
    assert found_links(quantised.near_duplicate_vectors(vectors(spark, only_bad))) == brute_links(only_bad)
    assert quantised.near_duplicate_vectors(vectors(spark, rows).filter("vec_id = -1")).count() == 0


def usable(rows):
    fine = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(np.float32(c)) for c in v)]
    size = Counter(len(v) for _, v in fine).most_common(1)[0][0]
    return [(i, [float(np.float32(c)) for c in v]) for i, v in fine if len(v) == size]


def brute_whitened(rows, most=32):
    ids, x = [i for i, _ in rows], np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(0)
    deviation = [min((1 << 63) - 1, int(((n * row - sums) ** 2).sum())) for row in x]
    c = np.array([[float(int(n * a - s)) / n for a, s in zip(row, sums)] for row in x])
    e, u = np.linalg.eigh(c.T @ c / n)
    return ids, deviation, (c @ u[:, ::-1])[:, :most], e[::-1]


def check_whitened(df, rows):
    got = df.collect()
    ids, deviation, projected, e = brute_whitened(rows)
    k = min(32, projected.shape[1])
    assert len(got) == len(rows) * k and Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == Counter(zip(ids, deviation))
    assert {r.component for r in got} == set(range(1, k + 1)) and {r.n for r in got} == {len(rows)}
    (error,) = {r.identity_error for r in got}
    assert error < 1e-9
    shares = dict((r.component, r.explained) for r in got)
    for j in range(k):
        assert abs(shares[j + 1] - e[j] / e.sum()) <= 1e-6 * e[j] / e.sum() + 1e-12
    mine: dict = {}
    for r in got:
        if r.component == 1:
            mine.setdefault(r.vec_id, []).append(abs(r.whitened))
    for i, w in zip(ids, np.abs(projected[:, 0]) / math.sqrt(e[0])):
        assert min(abs(w - x) for x in mine[i]) < 1e-6


def test_whitening(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check_whitened(whitening.op12_embedding_whitening(spark, SMALL), usable(rows))


@pytest.mark.parametrize("blocks", [{"block_rows": 7, "each": 3}, {"block_rows": 1}])
def test_whitening_in_many_blocks(spark, blocks):
    r = np.random.default_rng(2)
    rows = [(i // 2, [float(c) for c in v.astype(np.float32)]) for i, v in enumerate(r.normal(size=(160, 6)) @ np.diag([3.0, 2, 1, 0.5, 0.4, 0.3]))]
    check_whitened(whitening.whitened(vectors(spark, rows), **blocks), usable(rows))


def test_whitening_of_odd_vectors(spark):
    r = np.random.default_rng(3)
    rows = [*((i, [float(c) for c in v]) for i, v in enumerate(r.normal(size=(50, 64)))), *((i, v) for i, v in ODD if i != 910)]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert Counter(r.vec_id for r in got) == Counter({i: 32 * n for i, n in Counter(i for i, _ in usable(rows)).items()})
    assert all(math.isfinite(r.whitened) for r in got) and got[0].identity_error < 1e-6
    huge = whitening.whitened(vectors(spark, [(1, [3e38, 1.0]), (2, [0.0, 2.0]), (3, [1.0, 0.0])])).collect()
    assert len(huge) == 6 and max(r.deviation for r in huge) == (1 << 63) - 1
    one = whitening.whitened(vectors(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0])])).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(0, 0.0, 0.0, 0.0)] * 4
    assert whitening.whitened(vectors(spark, rows).filter("vec_id = -1")).count() == 0


def test_exact_deviations():
    r = np.random.default_rng(5)
    x = r.integers(-(10**9), 10**9, size=(20, 8))
    for n, sums in ((20, x.sum(0).tolist()), (10**12, [s * 10**11 for s in x.sum(0).tolist()])):
        want = [min((1 << 63) - 1, sum((n * int(a) - s) ** 2 for a, s in zip(row, sums))) for row in x]
        assert whitening.deviations(x, n, sums) == want


def brute_codes(rows, parts=16, entries=64):
    whole = [(i, label, [math.floor(256 * c) for c in v]) for i, label, v in rows]
    width = -(-len(whole[0][2]) // parts)
    whole = [(i, label, v + [0] * (parts * width - len(v))) for i, label, v in whole]
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, np.array(r[2], "<i4").tobytes()))[:entries]
    books = [[cut(v)[p] for _, _, v in first] for p in range(parts)]

    def near(v):
        return [min((sum((a - b) ** 2 for a, b in zip(piece, e)), k) for k, e in enumerate(books[p])) for p, piece in enumerate(cut(v))]

    for _ in range(2):
        of: dict = {}
        for _, _, v in whole:
            for p, (_, k) in enumerate(near(v)):
                of.setdefault((p, k), []).append(cut(v)[p])
        for (p, k), own in of.items():
            books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    final = [(i, label, near(v)) for i, label, v in whole]
    total: Counter = Counter()
    for _, label, found in final:
        total[label] += sum(e for e, _ in found)
    digest = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return Counter((i, "".join(f"{k:02x}" for _, k in found), sum(e for e, _ in found), total[label], digest) for i, label, found in final)


@pytest.mark.parametrize("d", [64, 37])
def test_codes_of_odd_vectors(spark, d):
    r = np.random.default_rng(d)
    rows = [*((i, [float(np.float32(c)) for c in v]) for i, v in enumerate(r.normal(size=(90, d)))), *((i, v if v is None or len(v) != 64 else v[:d]) for i, v in ODD if i != 910)]
    rows += [(3, rows[3][1]), (4, rows[5][1])]
    df = vectors(spark, rows)
    labels = {None: None} | {i: None if i % 3 == 0 else str(i % 3) for i, _ in rows if i is not None}
    got = Counter(map(tuple, codebooks.coded(df).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()))
    assert got == brute_codes([(i, labels[i], v) for i, v in usable(rows)])


def test_codes_of_few_and_no_vectors(spark):
    df = vectors(spark, [(5, [1.0] * 16), (2, [0.0] * 16), (1, [3e38] * 16)])
    assert sorted((r.vec_id, r.code, r.error) for r in codebooks.coded(df).collect()) == [(1, "00" * 16, 0), (2, "01" * 16, 0), (5, "02" * 16, 0)]
    assert codebooks.coded(df.filter("vec_id = -1")).count() == 0
