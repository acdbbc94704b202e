"""Operators against plain restatements, and the shape of their plans."""

import math
import random
import re
import time
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoloom import fixtures, queries
from genoloom.functions.forests import FlatForest
from genoloom.operators import annotate, filters, genes, inheritance, meta, ontology, ranking, scoring
from genoloom.plans import pipelines
from genoloom.shared import written
from genoloom.sources import store

from .conftest import SMALL


def test_overlap_equals_nested_loop_and_is_an_equi_join(spark):
    r = random.Random(1)
    v = [(i, f"chr{r.randint(1, 2)}", r.randint(1, 3000), "A" * r.randint(1, 40)) for i in range(300)]
    g = [(f"chr{r.randint(1, 2)}", s := r.randint(0, 3000), s + r.randint(0, 700), f"n{i % 60}") for i in range(200)]
    variants, regions = spark.createDataFrame(v, "variant_id long, chrom string, pos long, ref string"), spark.createDataFrame(g, "chrom string, start0 long, end0 long, name string")
    want = {(i, n) for i, c, p, ref in v for rc, s, e, n in g if c == rc and s < p - 1 + len(ref) and e > p - 1 and e > s}
    for width in (16, 256, 100_000):
        got = [tuple(x) for x in annotate.overlaps(variants, regions, width=width).collect()]
        assert set(got) == want
        assert len(got) == sum(1 for i, c, p, ref in v for rc, s, e, n in g if c == rc and s < p - 1 + len(ref) and e > p - 1 and e > s)  # no pair comes twice
    plan = annotate.overlaps(variants, regions)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_region_is_one_row_however_long(spark):
    """Regions at borders of bins and longer than all of them, variants at the ends of a region."""
    g = [("chr1", 0, 10**11, "all"), ("chr1", 4095, 4097, "border"), ("chr1", 32_767, 32_769, "next border"), ("chr1", 100, 101, "base"), ("chr1", 50, 50, "empty"), ("chr2", 7, 9, "other")]
    v = [(i, "chr1", p, "A" * n) for i, (p, n) in enumerate([(1, 1), (101, 1), (100, 1), (100, 2), (102, 1), (4096, 1), (4095, 1), (4097, 1), (4098, 1), (32_000, 1000), (10**10, 3), (5, 0)])]
    variants, regions = spark.createDataFrame(v, "variant_id long, chrom string, pos long, ref string"), spark.createDataFrame(g, "chrom string, start0 long, end0 long, name string")
    want = sorted((i, n) for i, c, p, ref in v for rc, s, e, n in g if c == rc and max(s, p - 1) < min(e, p - 1 + len(ref)))
    assert sorted(map(tuple, annotate.overlaps(variants, regions).collect())) == want
    plan = annotate.overlaps(variants, regions)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and annotate.overlaps(variants, regions.filter("chrom = 'chr9'")).count() == 0


@pytest.mark.parametrize("rows", [5, 16_384])
def test_regions_are_named_without_a_row_a_pair(spark, rows):
    """Long and short regions, equal names, a crowded place, rows without a place; no shuffle or join carries pairs."""
    r = random.Random(rows)
    v = [(i, f"chr{r.randint(1, 3)}", r.choice([500, r.randint(1, 3000)]), "A" * r.randint(1, 40)) for i in range(400)] + [(900, None, 5, "A"), (901, "chr1", None, "A"), (902, "chr1", 5, ""), (903, "chr1", 5, None)]
    g = [(f"chr{r.randint(1, 2)}", s := r.randint(0, 3000), s + r.choice([0, 30, 700, 10**11]), f"n{i % 60}") for i in range(200)] + [("chr1", 0, 9, None)]
    variants, regions = spark.createDataFrame(v, "variant_id long, chrom string, pos long, ref string"), spark.createDataFrame(g, "chrom string, start0 long, end0 long, name string")
    got = annotate.with_regions(variants, regions, "names", width=16, stretch_rows=rows)
    assert got.columns == ["variant_id", "chrom", "pos", "ref", "names"]
    touch = lambda c, p, ref, rc, s, e: c == rc and p and ref and e > s and s < p - 1 + len(ref) and e > p - 1
    want = {x[0]: "&".join(sorted({n for rc, s, e, n in g if n and touch(*x[1:], rc, s, e)})) or None for x in v}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("hashpartitioning") == 1
    found = got.collect()
    assert len(found) == len(v) and {x.variant_id: x.names for x in found} == want


@pytest.mark.parametrize("width", [7, 64, 10_000])
def test_track_by_sweep(spark, width):
    """Intervals of a base up to many tiles, gaps, tiles without an interval or without a variant, missing contigs."""
    r, at, track = random.Random(width), 0, []
    while at < 3000:
        n = r.choice([1, 1, 1, 2, 5, 40, 300])
        if r.random() < 0.7:
            track.append(("chr1", at, at + n, round(r.random(), 3)))
        at += n
    v = [(i, r.choice(["chr1", "chr1", "chr1", "chr3"]), r.randint(1, 3300), "x") for i in range(500)] + [(900, None, 5, None), (901, "chr1", None, "y"), (902, "chr1", 1, "z")]
    variants, tracks = spark.createDataFrame(v, "variant_id long, chrom string, pos long, value string"), spark.createDataFrame(track, "chrom string, start0 long, end0 long, value double")
    got = annotate.with_track(variants, tracks, "score", width=width)
    assert got.columns == ["variant_id", "chrom", "pos", "value", "score"]
    want = {i: next((x for tc, s, e, x in track if c == tc and p and s < p <= e), None) for i, c, p, _ in v}
    assert {x.variant_id: x.score for x in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_store_is_joined_without_a_shuffle_of_it(spark, tmp_path):
    """Any number of resources in one join, several hits joined, long alleles, a transcript in the key, opened anew."""
    long = "ACGT" * 50
    v = spark.createDataFrame([(1, "chr1", 5, "A", "G", "T1"), (2, "chr1", 6, "A", "G", "T1"), (3, "chr1", 5, "A", long, "T2"), (4, "chr1", 5, "A", long + "A", "T2"), (5, None, 5, "A", "G", "T1")], "variant_id long, chrom string, pos long, ref string, alt string, feature string")
    a = spark.createDataFrame([("chr1", 5, "A", "G", 0.2, "T1"), ("chr1", 5, "A", "G", 0.1, "T2"), ("chr1", 5, "A", "T", 0.9, "T1"), ("chr1", 5, "A", long, 0.7, "T2"), ("chr1", 6, "A", "G", None, "T1")], "chrom string, pos long, ref string, alt string, s double, feature string")
    b = spark.createDataFrame([("chr1", 6, "A", "G", 3), ("chr1", 5, "A", long, 4)], "chrom string, pos long, ref string, alt string, n long")
    at = str(tmp_path / "store")
    written = store.write_store(store.merged([(a, ["s"])], [(b, ["n"])]), at, 4)
    for opened in (written, store.open_store(spark, at)):
        got = store.with_store(v, opened)
        assert sorted((x.variant_id, x.s, x.n) for x in got.collect()) == [(1, "0.1&0.2", None), (2, None, 3), (3, "0.7", 4), (4, None, None), (5, None, None)]
    by_transcript = store.write_store(store.merged([(a, ["s"])], keys=("feature",)), str(tmp_path / "transcripts"), 4, keys=("feature",))
    assert sorted((x.variant_id, x.s) for x in store.with_store(v, by_transcript, keys=("feature",)).collect()) == [(1, "0.2"), (2, None), (3, "0.7"), (4, None), (5, None)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = store.with_store(v, opened, ["n"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan and "ReadSchema: struct<chrom:string,pos:bigint,allele:string,n:bigint>" in plan, plan


def test_a_bloom_filter_of_the_variants_meets_the_scan_of_the_store(spark, tmp_path):
    """Spark puts it there for large stores; the limits of size are lowered here."""
    resource = spark.range(20_000).select(F.lit("chr1").alias("chrom"), (F.col("id") + 1).alias("pos"), F.lit("A").alias("ref"), F.lit("G").alias("alt"), F.col("id").alias("n"))
    opened = store.write_store(store.merged([], [(resource, ["n"])]), str(tmp_path / "s"), 4)
    resource.select("chrom", "pos", "ref", "alt").withColumn("sample", F.col("pos") % 500).write.parquet(str(tmp_path / "v"))
    names = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, x in names.items():
            spark.conf.set(k, x)
        got = store.with_store(spark.read.parquet(str(tmp_path / "v")).filter("sample = 7"), opened)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        rows = sorted((r.pos, r.n) for r in got.collect())
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)
    assert "might_contain" in plan and rows == [(p, p - 1) for p in range(7, 20_001, 500)]


def test_allele_join_collapses_hits(spark):
    v = spark.createDataFrame([(1, "chr1", 5, "A", "G"), (2, "chr1", 6, "A", "G")], "variant_id long, chrom string, pos long, ref string, alt string")
    res = spark.createDataFrame([("chr1", 5, "A", "G", 0.2), ("chr1", 5, "A", "G", 0.1), ("chr1", 5, "A", "T", 0.9)], "chrom string, pos long, ref string, alt string, s double")
    assert {r.variant_id: r.s for r in annotate.by_allele(v, res, ["s"]).collect()} == {1: "0.1&0.2", 2: None}


def test_context_and_expansion(spark):
    genome = "".join(random.Random(2).choice("ACGT") for _ in range(50)) + "nN" + "acgt" * 5
    tiles = spark.createDataFrame([("chr1", i, genome[16 * i : 16 * i + 16]) for i in range(5)], "chrom string, tile long, seq string")
    v = spark.createDataFrame([(1, "chr1", 3, "A"), (2, "chr1", 30, "A"), (3, "chr9", 3, "A")], "variant_id long, chrom string, pos long, ref string")
    assert {r.variant_id: r.context for r in annotate.with_context(v, tiles, 16).collect()} == {1: genome[0:8], 2: genome[24:35], 3: "."}
    indels = spark.createDataFrame([("i1", "chr1", 50, "AC")], "indel_id string, chrom string, pos long, ref string")
    got = sorted((r.pos, r.ref, r.alt) for r in annotate.expand_indels(indels, tiles, 16).collect())
    assert [(p, b) for p, b, _ in got] == [(i + 1, genome[i].upper()) for i in range(47, 54) if genome[i].upper() in "ACGT"]
    assert all((b in "AT") != (a in "AT") for _, b, a in got)
    again = sorted((r.pos, r.ref, r.alt) for r in annotate.expand_indels(indels.repartition(3), tiles.repartition(2), 16).collect())
    assert again == got


def dag(r, n=40):
    return [(i, r.randrange(i)) for i in range(1, n)] + [(i, r.randrange(i)) for i in range(2, n, 3)]


@pytest.mark.parametrize("measure", ["lin", "resnik", "jiang_conrath", "information_coefficient"])
def test_similarity_rewrite_equals_plain_pairs(spark, measure):
    r = random.Random(3)
    raw = dag(r)
    n = {i: r.randint(1, 20) for i in range(0, 40, 2)}
    edges = spark.createDataFrame(raw, "term long, parent long")
    terms = edges.select("term").union(edges.select("parent")).distinct()
    up = ontology.closure(edges)
    ic = ontology.information_content(ontology.inclusive_counts(terms, up, spark.createDataFrame(list(n.items()), "term long, n long")), sum(n.values()))
    q = {(s, r.randrange(1, 40)) for s in range(3) for _ in range(5)}
    g = {(f"G{i}", r.randrange(1, 40)) for i in range(6) for _ in range(3)}
    query, genes = spark.createDataFrame(list(q), "sample_id long, term long"), spark.createDataFrame(list(g), "gene string, term long")
    got = {(x.sample_id, x.gene): round(x.similarity, 9) for x in ontology.similarity(query, genes, up, ic, measure).collect()}
    best = lambda most: {(x.term, x.gene): round(x.best, 9) for x in ontology.best_match(query, genes, up, ic, measure, most).collect()}
    assert best(4_000_000) == best(30) == best(0)  # all ancestors heavy, some, none

    above = {t: set() for t in range(40)}
    for t in range(40):
        for a, p in raw:
            if a == t:
                above[t] |= {p} | above[p]
    info = {t: -math.log(max(1, sum(c for x, c in n.items() if x == t or t in above[x])) / sum(n.values())) for t in range(40)}

    def sim(a, b):
        m = max((info[c] for c in above[a] & above[b]), default=0.0)
        lin = 2 * m / (info[a] + info[b]) if info[a] + info[b] else 0.0
        return {"lin": lin, "resnik": m, "jiang_conrath": 1 - (info[a] + info[b] - 2 * m), "information_coefficient": lin * (1 - 1 / (1 + m))}[measure]

    want = {(s, gene): round(median(max(sim(a, b) for x, b in g if x == gene) for y, a in q if y == s), 9) for s, _ in q for gene, _ in g}
    assert all(abs(got.get(k, 0.0) - v) < 1e-8 for k, v in want.items()) and got


def test_both_closures_agree(spark):
    """By walks and by joins; names as terms, loops of a term to itself, cycles, no edges at all."""
    raw = [(f"t{a}", f"t{b}") for a, b in dag(random.Random(6))] + [("t3", "t3")]
    edges = spark.createDataFrame(raw, "term string, parent string")
    pairs = lambda df: sorted(map(tuple, df.select("term", "ancestor").collect()))
    walked = pairs(ontology.closure(edges))
    assert walked == pairs(ontology.joined_closure(edges)) == pairs(ontology.closure(edges, most_edges=3)) and len(walked) > 100
    assert pairs(ontology.closure(edges.filter("term = 'none'"))) == []
    ring = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "term string, parent string")
    with pytest.raises(Exception, match="cycle"):
        ontology.closure(ring)
    with pytest.raises(Exception, match="cycle"):
        ontology.joined_closure(ring, most_rounds=3)


def test_resolved_terms(spark):
    terms = spark.createDataFrame([("a",), ("b",)], "term string")
    repl = spark.createDataFrame([("old", "b")], "term string, replaced_by string")
    q = spark.createDataFrame([(1, "a"), (1, "old"), (1, "gone"), (1, "b")], "sample_id long, term string")
    assert sorted(r.term for r in ontology.resolved(q, terms, repl).collect()) == ["a", "b"]


GTS = ("0/0", "0/1", "1/1", "./.")


@pytest.mark.parametrize("family", ["TRIO", "MULTI"])
def test_verdicts_for_every_trio(spark, family):
    rows, want = [], {}
    cases = [(c, p, m) for c in GTS for p in GTS for m in GTS]
    for i, case in enumerate(cases):
        rows += [(i, k, int(k == 0), g) for k, g in enumerate(case)]
        c, un = case[0], case[1:]
        denovo = c == "0/1" and not ({"0/1", "1/1"} & set(un)) or c == "./." and "0/0" in un and not ({"0/1", "1/1"} & set(un))
        dominant = c != "0/0" and not ({"0/1", "1/1"} & set(un)) and (c in ("0/1", "1/1") or "0/0" in un)
        bad_un = {"1/1"} | ({"0/0"} if family == "TRIO" else set())
        good_un = {"0/1"} | ({"0/0"} if family == "MULTI" else set())
        recessive = c not in ("0/0", "0/1") and not (bad_un & set(un)) and (c == "1/1" or bool(good_un & set(un)))
        x = c not in ("0/0", "0/1") and set(un) == {"0/0", "0/1"}
        want[i] = tuple(map(int, (denovo, dominant, recessive, x)))
    df = spark.createDataFrame(rows, "variant_id long, member long, affected int, gt string")
    got = {r.variant_id: (r.denovo, r.dominant, r.recessive, r.xlinked) for r in inheritance.family_verdicts(df, family).collect()}
    assert got == want


def test_compound_pairs(spark):
    r = random.Random(4)
    rows = [(i, 1, r.choice(["A", "B", "C", None]), *(r.choice(("0/0", "0|1", "1/1")) for _ in range(3))) for i in range(200)]
    df = spark.createDataFrame(rows, "variant_id long, sample_id long, symbol string, gt_child string, gt_first string, gt_second string")
    n = lambda g: g.replace("|", "/")
    first = [x for x in rows if (n(x[3]), n(x[4]), n(x[5])) == ("0/1", "0/1", "0/0")]
    second = [x for x in rows if (n(x[3]), n(x[4]), n(x[5])) == ("0/1", "0/0", "0/1")]
    want = {i for a in first for b in second if a[2] and a[2] == b[2] for i in (a[0], b[0])}
    assert {x.variant_id for x in inheritance.compound_trio(df).filter("compound = 1").collect()} == want
    assert {x.variant_id for x in inheritance.compound_trio(df.repartition(7)).filter("compound = 1").collect()} == want


def test_per_gene_takes_the_most_severe_entry(spark):
    df = spark.createDataFrame([(1, "A/B", "missense_variant", 2, 0.5, "v1"), (1, "A", "stop_gained", 7, 0.3, "v2"), (1, "A", "stop_gained", 5, 0.4, "v3")], "sample_id long, gene string, consequence string, rank int, score double, variant string")
    assert sorted(tuple(r) for r in meta.per_gene(df).collect()) == [(1, "A", 5, 0.4, "v3"), (1, "B", 2, 0.5, "v1")]


def test_trees_as_expressions_equal_the_model(spark):
    r = random.Random(5)
    df = spark.createDataFrame([(i, r.random(), r.random(), float(r.random() < 0.4)) for i in range(300)], "id long, a double, b double, label double")
    model = scoring.train_forest(df, ["a", "b"], trees=5, depth=3)
    trees = scoring.trees_of(model.stages[-1], ["a", "b"])
    both = scoring.predict(df, model).withColumn("expression", scoring.forest(trees))
    assert both.filter("abs(pathogenicity - expression) > 1e-9").count() == 0


def random_tree(r, features, depth):
    """A lopsided tree with repeated thresholds."""
    nodes = {}

    def grow(depth):
        at, nodes[at] = len(nodes), ()
        nodes[at] = (r.random(),) if depth == 0 or (depth < 8 and r.random() < 0.15) else (r.choice(features), round(r.random(), 2), grow(depth - 1), grow(depth - 1))
        return at

    grow(depth)
    return nodes


def leaf_of(tree, row):
    at = 0
    while len(tree[at]) > 1:
        f, threshold, left, right = tree[at]
        at = left if row[f] is not None and row[f] <= threshold else right
    return tree[at][0]


def test_flat_forests_equal_walks_down_the_trees():
    r = random.Random(8)
    trees = [random_tree(r, ["a", "b", "c"], d) for d in (0, 1, 3, 6, 7, 9, 10, 10)]
    assert max(sum(len(n) == 1 for n in t.values()) for t in trees) > 500
    rows = [{f: r.choice([None, float("nan"), round(r.random(), 2), r.random(), -1.0, 2.0]) for f in "abc"} for _ in range(400)]
    want = [sum(leaf_of(t, row) for t in trees) / len(trees) for row in rows]
    x = np.array([[np.nan if row[f] is None else row[f] for f in "abc"] for row in rows])
    for table_bytes in (1 << 25, 1 << 12):
        flat = FlatForest(trees, ["a", "b", "c"], table_bytes)
        assert (len(flat.groups) > 1) == (table_bytes < 1 << 20)
        assert np.allclose(flat(x), want, atol=1e-12)


def test_folds_keep_patients_together_and_calibration_helps(spark):
    """A feature that names the patient gives label away within a patient, and nothing to forests that haven't seen him."""
    r = random.Random(12)
    ill = {s: r.random() < 0.5 for s in range(60)}
    rows = [(i, s := i % 60, float(s), (x := r.random()), float(r.random() < (0.9 if x > 0.6 else 0.1)) if i % 3 else float(ill[s])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, sample_id long, patient double, x double, label double")
    scored = written(scoring.out_of_fold(df, ["patient", "x"], folds=4, trees=12, depth=6), "scored")
    folds = {(a.sample_id, a.fold) for a in scored.collect()}
    assert len(folds) == 60 and {f for _, f in folds} == {0, 1, 2, 3} and scored.count() == 3000
    inside = scoring.predict(df, scoring.train_forest(df, ["patient", "x"], trees=12, depth=6))
    raw = scored.agg(scoring.log_loss("pathogenicity", "label")).first()[0]
    assert inside.agg(scoring.log_loss("pathogenicity", "label")).first()[0] < raw - 0.02  # what the folds take away
    skewed = scored.withColumn("pathogenicity", F.col("pathogenicity") ** 3)
    fitted = scoring.calibrated(skewed, scoring.fit_calibration(skewed))
    got = fitted.agg(scoring.log_loss("pathogenicity", "label").alias("before"), scoring.log_loss("calibrated", "label").alias("after")).first()
    assert got.after < got.before - 0.05
    pairs = sorted((a.pathogenicity, a.calibrated) for a in fitted.collect())
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(pairs, pairs[1:])) and all(0 <= c <= 1 for _, c in pairs)
    assert scoring.calibrated(spark.createDataFrame([(None,)], "pathogenicity double"), scoring.fit_calibration(skewed)).first().calibrated is None
    ranks = {a.sample_id: a.causal_rank for a in ranking.causal_ranks(scored).collect()}
    first = {s: max(a.pathogenicity for a in scored.filter(f"sample_id = {s}").collect()) for s in (0, 7)}
    assert all((ranks[s] == 1) == any(a.pathogenicity == top for a in scored.filter(f"sample_id = {s} AND label = 1").collect()) for s, top in first.items())


def test_a_panel_opens_few_files_of_the_genome(spark, tmp_path):
    tiles = spark.range(4000).select(F.concat(F.lit("chr"), F.col("id") % 4).alias("chrom"), F.floor(F.col("id") / 4).alias("tile"), F.lpad(F.conv("id", 10, 4), 16, "0").alias("seq"))
    tiles = tiles.withColumn("seq", F.translate("seq", "0123", "ACGT"))
    at = str(tmp_path / "tiles")
    store.write_tiles(tiles, at, block_tiles=50)  # 4 chromosomes of 20 files
    v = spark.createDataFrame([(1, "chr1", 30, "A"), (2, "chr1", 800, "A" * 4), (3, "chr3", 9000, "A"), (4, "chr9", 5, "A")], "variant_id long, chrom string, pos long, ref string")
    near = store.tiles_around(v, at, 16)
    assert len(near.collect()) == 150
    scan = near._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 3  # of 80; two of them for the variant at a border
    assert sorted(map(tuple, annotate.with_context(v, near, 16).collect())) == sorted(map(tuple, annotate.with_context(v, tiles, 16).collect()))
    assert store.tiles_around(v.filter("variant_id = 4"), at, 16).count() == 0


def test_a_large_forest_is_planned_in_no_time(spark):
    """200 trees of depth 10, equal to the walk; null features go right."""
    r = random.Random(3)
    trees = [random_tree(r, ["a", "b"], 10) for _ in range(200)]
    rows = [(i, None if i % 7 == 0 else r.random(), r.random()) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    began = time.time()
    scored = scoring.scored_by(df, trees, "p")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert time.time() - began < 10 and "CASE WHEN" not in plan and plan.count("ArrowEvalPython") == 1
    got = {x.id: x.p for x in scored.collect()}
    assert all(abs(got[i] - sum(leaf_of(t, {"a": a, "b": b}) for t in trees) / 200) < 1e-12 for i, a, b in rows)


def test_ranking_by_a_fitted_model(spark):
    """The same ranks from the model as from its node tables."""
    v = queries.as_features(fixtures.fixture(spark, SMALL, "fx_variants"))
    names = [f"x_{f}" for f in queries.USED]
    model = scoring.train_forest(scoring.with_imputed(v, tuple(queries.USED)).withColumn("label", (F.col("impact") == "HIGH").cast("double")), names, trees=20, depth=7)
    trees = scoring.trees_of(model.stages[-1], names)
    ranks = [sorted(map(tuple, pipelines.rf_ranking(v, t, queries.USED, top=10, model=m).select("sample_id", "variant_id", "rank").collect())) for t, m in ((trees, None), (None, model))]
    assert ranks[0] == ranks[1] and len(ranks[0]) > 20


def test_ranks_prune_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("sample_id"), F.rand(1).alias("final_score"))
    assert "WindowGroupLimit" in ranking.top_ranked(df, 5)._jdf.queryExecution().toString()


@pytest.mark.parametrize("piece_rows", [10, 400, 10**6])
def test_ranks_in_pieces_equal_the_window(spark, piece_rows):
    """Ties, nulls, NaN, a sample without an id, and samples on both sides of the limit."""
    r = random.Random(11)
    rows = [(i, r.choice([1, 1, 1, 1, 2, 3, None]), r.choice([None, 0.5, 0.5, float("nan"), r.random(), r.random(), round(r.random(), 1)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, sample_id long, final_score double")
    want = {x.id: x["rank"] for x in ranking.ranked(df).collect()}
    got = ranking.ranked_in_pieces(df, piece_rows=piece_rows, pieces=32)
    assert got.columns == [*df.columns, "rank"] and {x.id: x["rank"] for x in got.collect()} == want
    assert ranking.ranked_in_pieces(df.filter("id < 0")).count() == 0


def test_ranks_in_pieces_fill_tasks_evenly(spark):
    """One sample with half of all rows, of which a third tie and a tenth have no score."""
    score = F.when(F.col("id") % 3 == 0, 0.5).when(F.col("id") % 10 == 1, None).otherwise(F.rand(3))
    df = spark.range(120_000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 40).alias("sample_id"), score.alias("final_score"))
    names = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        done = ranking.ranked_in_pieces(df, piece_rows=5000, pieces=128).select("rank", F.spark_partition_id().alias("p"))
        sizes = [r.n for r in done.groupBy("p").agg(F.count("*").alias("n"), F.sum("rank")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 120_000 and len(sizes) == 12 and max(sizes) <= 2 * median(sizes), sizes


def test_exclusion_and_fill(spark):
    df = spark.createDataFrame([(1, "a;b"), (2, "C"), (3, None)], "id long, symbol string")
    ex = spark.createDataFrame([("B",)], "gene string")
    assert {r.id: r.gene_excluded for r in filters.excluded_gene(df, ex).collect()} == {1: True, 2: False, 3: False}
    two = spark.createDataFrame([(1, None, 5)], "id long, x int, y int")
    assert filters.first_filled(two, ["x", "y"], "z").collect()[0].asDict() == {"id": 1, "z": 5}


def test_partners_and_aliases(spark):
    alias = spark.createDataFrame([("P1", "gb", "Ensembl_HGNC_symbol"), ("P1", "ga", "Ensembl_HGNC_symbol"), ("P2", "x", "other"), ("P2", "gc", "Ensembl_HGNC_symbol")], "protein string, alias string, source string")
    links = spark.createDataFrame([("P1", "P2", 950, 0), ("P2", "P1", 1, 899)], "protein1 string, protein2 string, conf_exp int, conf_db int")
    assert [tuple(r) for r in genes.interactions(links, genes.first_aliases(alias)).collect()] == [("GA", "GC", 950, 0)]


def test_names_shuffles_and_picks(spark):
    terms, names = spark.createDataFrame([("a",), ("z",)], "term string"), spark.createDataFrame([("a", "x")], "term string, name string")
    assert [tuple(r) for r in ontology.term_names(terms, names).collect()] == [("a", "x")]
    df = spark.createDataFrame([(s, f"G{i}") for s in (1, 2) for i in range(9)], "sample_id long, gene string")
    order = lambda d: sorted(tuple(r) for r in ranking.shuffled(d, 7, "sample_id", "gene").collect())
    assert order(df) == order(df.repartition(5)) and sorted(r[2] for r in order(df)) == sorted([*range(1, 10)] * 2)
    answers = spark.createDataFrame([(1, '{"1st ranked Gene": "a", "2nd ranked Gene": "", "3rd ranked Gene": "c"}'), (2, "none")], "sample_id long, answer string")
    assert sorted(tuple(r) for r in meta.picks_of(answers).collect()) == [(1, "A", 1), (1, "C", 3)]


def test_an_affected_parent_is_no_parent(spark):
    """Two variants of a gene in trans: compound with healthy parents whatever the names, not with an ill mother, not
    without a father, not with three healthy members."""
    v = spark.createDataFrame([(i, s, "chr1", "A") for s in range(5) for i in (1, 2)], "variant_id long, sample_id long, chrom string, symbol string")
    families = {0: {"kid": (1, "0/1", "0/1"), "mom": (0, "0/1", "0/0"), "dad": (0, "0/0", "0/1")}, 1: {"zoe": (1, "0/1", "0/1"), "amy": (0, "0/1", "0/0"), "bob": (0, "0/0", "0/1")},
                2: {"kid": (1, "0/1", "0/1"), "ann": (1, "0/1", "0/0"), "dad": (0, "0/0", "0/1")}, 3: {"kid": (1, "0/1", "0/1"), "mom": (0, "0/1", "0/0")},
                4: {"kid": (1, "0/1", "0/1"), "mom": (0, "0/1", "0/0"), "dad": (0, "0/0", "0/1"), "sis": (0, "0/0", "0/0")}}
    g = spark.createDataFrame([(s, i, name, ill, gts[i - 1]) for s, f in families.items() for name, (ill, *gts) in f.items() for i in (1, 2)], "sample_id long, variant_id long, member string, affected int, gt string")
    got = inheritance.inheritance(v, g, "TRIO", keys=("sample_id",))
    assert {(r.sample_id, r.variant_id): r.compound for r in got.collect()} == {(s, i): int(s < 2) for s in range(5) for i in (1, 2)}


def test_inheritance_shuffles_variants_for_one_join_and_one_window(spark):
    v = fixtures.fixture(spark, SMALL, "fx_variants")
    plan = inheritance.inheritance(v, fixtures.fixture(spark, SMALL, "fx_genotypes").hint("merge"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("Exchange hashpartitioning") == 3, plan  # variants twice, genotypes once


def test_inheritance_aggregates_after_the_shuffle_and_by_hash(spark):
    """Nothing is aggregated before the shuffle, where a task would hold all families of its piece of the input."""
    plan = inheritance.inheritance(fixtures.fixture(spark, SMALL, "fx_variants"), fixtures.fixture(spark, SMALL, "fx_genotypes")).select("variant_id", "inheritance")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.index("HashAggregate") < plan.index("REPARTITION_BY_COL") and "HashAggregate" not in plan[plan.index("REPARTITION_BY_COL") :], plan
    dealt = plan[plan.index("Window [") :]
    assert "_bits" in dealt[: dealt.index("SortMergeJoin") if "SortMergeJoin" in dealt else dealt.index("Join")], plan


def test_single_patients_without_a_members_name(spark):
    v = spark.createDataFrame([(i, 1, "chr1", "A") for i in (1, 2, 3)], "variant_id long, sample_id long, chrom string, symbol string")
    g = spark.createDataFrame([(1, None, 1, "0/1"), (2, "b", 0, "0/1"), (2, "c", 1, "0/1"), (3, "a", 0, "0/1"), (3, "b", 1, "1/1")], "variant_id long, member string, affected int, gt string")
    assert {r.variant_id: r.inheritance for r in inheritance.inheritance(v, g, "SINGLE").collect()} == {1: "COMPOUND", 2: "COMPOUND", 3: "RECESSIVE"}


def test_single_sample_inheritance(spark):
    v = spark.createDataFrame([(1, 1, "chr1", "A"), (2, 1, "chr1", "A"), (3, 1, "chr1", "B"), (4, 1, "chr1", None)], "variant_id long, sample_id long, chrom string, symbol string")
    g = spark.createDataFrame([(1, 0, 1, "0/1"), (2, 0, 1, "0|1"), (3, 0, 1, "1/1"), (4, 0, 1, "0/1")], "variant_id long, member long, affected int, gt string")
    got = {r.variant_id: r.inheritance for r in inheritance.inheritance(v, g, "SINGLE").collect()}
    assert got == {1: "COMPOUND", 2: "COMPOUND", 3: "RECESSIVE", 4: ""}
    assert [r.x for r in g.select(inheritance.dominant_single().alias("x")).collect()] == [1, 1, 0, 1]


@pytest.mark.parametrize("measure", ["lin", "jiang_conrath"])
def test_walks_give_what_the_pairs_give(spark, measure):
    """Counts, best matches, shared information and medians by walks, against those of the closure's pairs."""
    r = random.Random(8)
    edges = spark.createDataFrame(list({(f"t{i:03}", f"t{r.randint(0, i - 1) if r.random() < 0.7 else i // 2:03}") for i in range(1, 150) for _ in range(2)}), "term string, parent string")
    terms = edges.select("term").union(edges.select("parent")).distinct()
    counts = spark.createDataFrame([(f"t{i:03}", r.randint(0, 9)) for i in range(150) if i % 4], "term string, n long")
    genes = spark.createDataFrame(list({(f"G{r.randint(0, 9)}", f"t{r.randint(0, 149):03}") for _ in range(200)}), "gene string, term string")
    query = spark.createDataFrame(list({(r.randint(0, 4), f"t{r.randint(0, 160):03}") for _ in range(90)}), "sample_id int, term string")
    graph, pairs = ontology.above(edges), ontology.closure(edges)
    assert isinstance(graph, ontology.Graph) and not isinstance(ontology.above(edges, most_edges=3), ontology.Graph)
    got = ontology.inclusive_counts(terms, graph, counts)
    rows = lambda df: sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in df.collect())
    assert rows(got) == rows(ontology.inclusive_counts(terms, pairs, counts))
    ic = written(ontology.information_content(got, 700), "ic")
    ab = edges.select(F.col("term").alias("a"), F.lit("t099").alias("b"))
    assert rows(ontology.node_similarity(ab, graph, ic, measure)) == rows(ontology.node_similarity(ab, pairs, ic, measure))
    for up, every in ((graph, pairs), (ontology.with_self(graph, terms), ontology.with_self(pairs, terms))):
        best = ontology.best_match(query, genes, up, ic, measure)
        assert rows(best) == rows(ontology.best_match(query, genes, every, ic, measure)) and best.count() > 100
    known = {(x.term, x.gene): x.best for x in ontology.best_match(query, genes, graph, ic, measure).collect()}
    of = {k: sorted({x.term for x in query.collect() if x.sample_id == k and x.term < "t150"}) for k in range(5)}
    want = {(k, g): round(median(known.get((t, g), 0.0) for t in of[k]), 9) for k in of for g in {g for t, g in known if t in of[k]}}
    for bins in (1, 4096):
        assert {(x.sample_id, x.gene): round(x.similarity, 9) for x in ontology.similarity(query, genes, graph, ic, measure, bins=bins).collect()} == want


def test_regions_shuffle_no_columns_that_nobody_reads(spark):
    plan = queries.QUERIES["j02_region_overlap"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "variant_id" in plan and not {"clinvar", "hgmd", "consequence", "o_totalprice"} & set(re.findall(r"\w+", plan))


def test_bits_carried_up_are_the_ancestors():
    r = np.random.default_rng(3)
    edges = np.unique([(i, r.integers(0, i)) for i in range(1, 400) for _ in range(2)], axis=0)
    first, parents = np.searchsorted(edges[:, 0], np.arange(401)), edges[:, 1].astype(np.int32)
    up = [set() for _ in range(400)]
    for i in range(400):
        up[i] = {x for p in parents[first[i] : first[i + 1]].tolist() for x in (p, *up[p])}
    starts = np.concatenate([r.integers(0, 400, 300), [0, 5, 5]])
    for bits in (1, 1 << 20):
        got = [x.tolist() for x in ontology._above(first, parents, starts, bits)]
        assert list(zip(*got)) == [(i, x) for i, t in enumerate(starts.tolist()) for x in sorted(up[t])]
    with pytest.raises(ValueError, match="cycle"):
        ontology._above(np.array([0, 1, 2]), np.array([1, 0]), np.array([1]))


@pytest.mark.parametrize("measure", ["lin", "resnik", "jiang_conrath"])
@pytest.mark.parametrize("many", [8, 150])
def test_medians_are_counted_without_a_row_a_match(spark, monkeypatch, measure, many):
    """Few genes, most of which lie below most nodes, and many; blocks of a few rows, so ancestors come in several."""
    r = random.Random(many)
    edges = spark.createDataFrame(list({(f"t{i:03}", f"t{r.randint(0, i - 1) if r.random() < 0.3 else i // 2:03}") for i in range(1, 150) for _ in range(2)}), "term string, parent string")
    terms = edges.select("term").union(edges.select("parent")).distinct()
    counts = spark.createDataFrame([(f"t{i:03}", r.randint(0, 9)) for i in range(150)], "term string, n long")
    genes = spark.createDataFrame(list({(f"G{r.randint(0, many - 1)}", f"t{r.randint(0, 149):03}") for _ in range(250)}), "gene string, term string")
    query = spark.createDataFrame(list({(r.choice([None, "a", "b", "c"]), f"t{r.randint(0, 160):03}") for _ in range(160)}), "sample_id string, term string")
    sizes, write = {}, ontology.written

    def counted(df, name):
        out = write(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        graph, pairs = ontology.above(edges), ontology.closure(edges)
        ic = written(ontology.information_content(ontology.inclusive_counts(terms, graph, counts), 700), "ic")
        rows = lambda up, **more: sorted((x.sample_id, x.gene, round(x.similarity, 9)) for x in ontology.similarity(query, genes, up, ic, measure, **more).collect())
        want = rows(pairs)
        with monkeypatch.context() as m:
            m.setattr(ontology, "written", counted)
            assert rows(graph, bins=2) == want and want
        assert max(sizes.get("best", 0), sizes.get("matches", 0)) <= query.select("term").distinct().count()
        assert rows(graph, most_cells=0) == rows(graph) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_rows_are_numbered_by_parts(spark):
    """Numbers of ordered rows without a task that sees all of them: what is windowed are parts, not rows."""
    df = written(spark.range(1000).withColumn("k", F.pmod(F.hash("id"), F.lit(37))).orderBy("k", "id").repartitionByRange(6, "k", "id").sortWithinPartitions("k", "id").select("*", F.monotonically_increasing_id().alias("_id")), "ordered")
    got = queries.nth_row(df)
    assert "row_number" not in got._jdf.queryExecution().toString()
    assert [x._nth for x in got.orderBy("k", "id").collect()] == list(range(1, 1001))
    from genoloom import file_queries  # noqa: F401  registers the last two

    for name in ("t01_sorts", "k04_one_file", "k03_sorted_tsv"):
        assert "row_number" not in queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()


def test_a_large_forests_tables_stay_small():
    """Each Python worker holds all of them."""
    flat = FlatForest([queries.two_sided(t) for t in range(60)])
    assert sum(masks.nbytes for g in flat.groups for _, masks in g["by_feature"].values()) < 60 << 20


def test_ranks_in_pieces_move_no_cuts(spark):
    """A sample's cuts and sums, thousands of bytes, are looked up before its rows are dealt."""
    df = spark.createDataFrame([(i, i % 2, float(i)) for i in range(100)], "id long, sample_id long, final_score double")
    plan = ranking.ranked_in_pieces(df, piece_rows=20, pieces=8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window [") < plan.index("AS _before"), plan


def test_training_computes_rows_once_in_all_tasks(spark):
    """Features of an input in one piece: computed once a row, not at each reading, and trained on in many tasks."""
    seen, context = spark.sparkContext.accumulator(0), spark.sparkContext

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x / 7

    df = spark.range(0, 600, 1, 1).select(counted(F.col("id") % 50).alias("a"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    context.setJobGroup("training", "")
    try:
        scoring.train_forest(df, ["a"], trees=3, depth=3)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup("training") for s in status.getJobInfo(j).stageIds]
    assert seen.value == 600
    assert max(s.numTasks for s in stages if s) == 4 * context.defaultParallelism
