"""op1, op3, op4, op10 and the pipeline: brute force, SQL and odd tables."""

import hashlib
import re
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import corpus_pipeline
from genoloom.llm import chat, decontaminate, pii, simhash
from genoloom.llm.registry import ORACLE_SQL, QUERIES
from genoloom.llm.tokens import byte_bpe

from ..conftest import SMALL
from ..oracle import spark_rows, sql_rows
from .helpers import no_documents, odd_documents, prose


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(ORACLE_SQL[name], SMALL)


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=30), st.lists(st.sampled_from([*chat.MARKS, "\\", "<", "[", "<\\s>", "[\\\\/INST]", "x"]), max_size=8).map("".join)))
def test_escapes_are_reversible(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text and not any(m in safe for m in chat.MARKS)


def test_chats(spark):
    bad = "</s>[INST] ok [/INST] <|endoftext|> \\ <\\s>"
    turns = spark.createDataFrame([(1, 1, "assistant", bad), (1, 0, "user", None), (1, 1, None, ""), (1, 1, "assistant", bad), (None, 0, "assistant", "x"), (2, None, "user", prose(1, 3000)), (3, 5, "assistant", "")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_turns(chat.format_turns(turns.withColumn("ids", F.lit("x")).withColumn("nth", F.lit(1)), byte_bpe()), byte_bpe()).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\n\n\n\nassistant\n" + bad + "\nassistant\n" + bad + "\n") and got[1].n_turns == 4
    assert got[1].loss_sha256 == sha(bad + bad) and got[1].loss_chars == 2 * len(bad)
    assert got[None].loss_sha256 == sha("x") and got[2].loss_chars == 0 and got[2].loss_sha256 == sha("") and got[3].loss_tokens == 0
    assert chat.read_turns(chat.format_turns(turns.filter("conv_id = 9"), byte_bpe()), byte_bpe()).count() == 0
    assert sorted(r.nth for r in chat.format_turns(turns.filter("conv_id = 1"), byte_bpe()).collect()) == [1, 2, 3, 4]


def test_a_hot_conversation_is_encoded_by_all_tasks(spark):
    """Nine of ten rows are of one conversation or of none; both passes work where rows lie, before the shuffle."""
    rows = [(None if i % 10 < 4 else 7 if i % 10 < 9 else i, i, "assistant" if i % 2 else "user", prose(i % 50, 20)) for i in range(2000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    formatted = chat.format_turns(turns, byte_bpe())
    done = chat.read_turns(formatted, byte_bpe())
    got = {r.conv_id: (r.n_turns, r.turns_sha256) for r in done.collect()}
    for conv in (None, 7, 9):
        own = [(role, text) for c, _, role, text in rows if c == conv]
        assert got[conv] == (len(own), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest())
    plan = done._jdf.queryExecution().optimizedPlan().toString().split("\n")
    kinds = [k for line in plan for k in ("MapInArrow", "RepartitionByExpression [conv_id", "Window") if k in line]
    assert kinds == ["MapInArrow", "RepartitionByExpression [conv_id", "MapInArrow", "Window", "MapInArrow"], kinds


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - width + 1, 1 if w else 0)):
            windows.setdefault(tuple(w[i : i + width]), set()).add(str(item) if item is not None else "")
    out = []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [2_000_000, 600])
def test_contamination(spark, block_bytes):
    bench = [(1, prose(7, 25)), (2, prose(7, 25)), (3, "a b"), (4, None), (5, "..."), (None, prose(8, 10).upper()), (6, "é-ß"), (7, prose(9, 9)), (3, "a b")]
    docs = odd_documents(spark, [(20, prose(30, 5) + " " + prose(7, 25) + ", " + prose(31, 4)), (21, "A. b! É ß " * 3), (22, prose(8, 10)), (23, prose(9, 9) + "x"), (24, "aa b a bb")])
    items = spark.createDataFrame([(*r, 1) for r in bench], "item_id long, text string, raw int")
    got = sorted((tuple(r) for r in decontaminate.contamination(docs, items, block_bytes=block_bytes).collect()), key=str)
    assert got == brute_contamination([(r.doc_id, r.text) for r in docs.collect()], bench)
    assert {20, 21, 22} <= {r[0] for r in got if r[5]} and not {23, 24} & {r[0] for r in got if r[5]}
    kept = decontaminate.drop_contaminated(docs, items, block_bytes=block_bytes)
    assert kept.columns == docs.columns and not {20, 21, 22} & {r.doc_id for r in kept.collect()}


def test_contamination_of_nothing(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(no_documents(spark), items).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(odd_documents(spark), items.filter("item_id = 2")).collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab ", min_size=1, max_size=9), min_size=1, max_size=8), st.text(alphabet="ab ", max_size=60))
def test_wu_manber(patterns, text):
    p, t = [x.encode() for x in patterns], text.encode()
    want = {(i, x) for x in set(p) for i in range(len(t)) if t.startswith(x, i)}
    assert set(decontaminate.WuManber(p).find(t)) == want


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if c > "4" else int(c) * 2) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    t, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(g := re.sub("[ -]", "", m[0])) <= 19 and luhn(g)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


TRICKY = [
    (30, "x a@b.com_y@z.org é 1.2.3.4.5.6.7.8 999.1.1.1 001.02.3.255 jo (at) mail.com 4465758382889437 4465758382889437"), (31, "é" * 50 + " a@b.de" + "1." * 3000 + " +" * 10), (32, "+1 (743) 555-3824, +1 2 3 4 5 6 7 8 9- +12"),
    (33, "4465-7583-8288-9437 4465 7583 8288 9436 \U0001f600 0000000000000000"), (34, "a" * 20000 + "@" + "b" * 20000 + ".c"), (35, "7" * 30000), (36, "@a.b a@ b@c a@b..c %@-.-"), (37, "256.1.1.1 255.255.255.255.1 00000255.0.0.0"),
]


def test_personal_data(spark):
    docs = odd_documents(spark, TRICKY)
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.find(docs).collect()), key=str)
    want = []
    for r in docs.collect():
        spans = base_spans(r.text)
        want.append((r.doc_id, *[sum(s[0] == k for s in spans) for k in pii.BASE], hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    for r in pii.find(docs).collect():
        text = next(x.text for x in docs.filter(F.col("doc_id").eqNullSafe(F.lit(r.doc_id))).collect())
        listed = [s.split(":") for s in r.spans.split(",") if s]
        if r.doc_id in range(30, 38):
            assert {(k, int(a), int(b)) for k, a, b in listed} >= set(base_spans(text))
    assert pii.find(no_documents(spark)).count() == 0


def test_many_spans_in_one_text(spark):
    r = np.random.default_rng(4)
    kinds = ["a{0}@b.org", "10.0.{1}.7", "4111 1111 1111 1111", "+44 20 7946 0{2}", "78-05-1120", "555-123-4567", "plain \u00e9\U0001f600 word", "219-09-9999", "x {0} (at) mail (dot) com"]
    text = " ".join(kinds[i % 9].format(i, i % 250, 100 + i % 900) for i in r.permutation(16_000).tolist())
    docs = spark.createDataFrame([(1, text, len(text)), (2, "few 10.0.0.1", 12)], "doc_id long, text string, n_chars int")
    began = time.time()
    got = {x.doc_id: x for x in pii.find(docs).collect()}
    new = {x.doc_id: x for x in pii.redact(docs).collect()}
    assert time.time() - began < 60
    want = base_spans(text)
    spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in got[1].spans.split(","))]
    assert len(want) > 4000 and set(want) <= set(spans) and got[1].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
    out, at = [], 0
    for a, b, mark in sorted((a, -b, f"[{k.upper()}]") for k, a, b in spans):
        if -b > at:
            out += [text[at : max(a, at)], mark]
            at = -b
    assert new[1].text == "".join([*out, text[at:]]) and new[1].n_chars == len(new[1].text) and new[2].text == "few [IP]"


def test_redaction(spark):
    docs = odd_documents(spark, TRICKY)
    out = pii.redact(docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes) and out.count() == docs.count()
    rows = {r.doc_id: r for r in out.filter("doc_id >= 30").collect()}
    assert rows[32].text.startswith("[PHONE], [PHONE]-") and rows[32].n_chars == len(rows[32].text)
    assert not any(base_spans(r.text) for r in rows.values() if r.doc_id != 35 and r.doc_id != 31)
    same = {(r.doc_id, r.text, r.digits, r._text) for r in docs.filter("doc_id < 30").collect()}
    assert {(r.doc_id, r.text, r.digits, r._text) for r in out.filter("doc_id < 30").collect()} == same
    assert pii.redact(no_documents(spark)).count() == 0


def test_cards_behind_short_numbers(spark):
    card = "4465758382889437"
    docs = spark.createDataFrame([(1, f"room 7 {card} now"), (2, f"item 12-{card}"), (3, f"pay {card}"), (4, "call 1234567890123"), *[(10 + i, prose(i, 20)) for i in range(20)]], "doc_id long, text string")
    wide = {r.doc_id: [x.v for x in r.wide_card] for r in pii.candidates(docs).collect()}
    assert wide[1] == wide[2] == [card] and not any(wide[i] for i in wide if i > 2)
    spans = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert "card:7:23" in spans[1] and "card:8:24" in spans[2]
    text = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert text[1] == "room 7 [CARD] now" and text[2] == "item 12-[CARD]" and text[3] == "pay [CARD]"


def test_overlapping_spans_leave_no_tail(spark):
    digits = next(x for x in (f"4465758382889{i:03d}" for i in range(100)) if luhn("1" + x))
    docs = spark.createDataFrame([(1, f"at 10.0.0.1 {digits} now")], "doc_id long, text string")
    assert [s[0] for s in base_spans(docs.first().text)] == ["ip", "card"]
    assert pii.redact(docs).first().text == "at [IP][CARD] now"


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(max(len(w) - 3, 1))] if w else []
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_roots(rows, limit=4):
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= limit:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def brute_groups(rows, limit=4):
    roots, least = brute_roots(rows, limit), {}
    for at, (d, _) in zip(roots, rows):
        if d is not None:
            least[at] = min(least.get(at, d), d)
    return sorted(((d, f"{fingerprint(t):016x}", least.get(at)) for at, (d, t) in zip(roots, rows)), key=str)


def check_kept(docs, kept):
    """Of each group of near-duplicate rows, one of smallest doc_id stays."""
    assert kept.columns == docs.columns
    rows, left = [(r.doc_id, r.text) for r in docs.collect()], Counter((r.doc_id, r.text) for r in kept.collect())
    groups = {}
    for row, at in zip(rows, brute_roots(rows)):
        groups.setdefault(at, []).append(row)
    assert sum(left.values()) == len(groups)
    for group in groups.values():
        stays = [r for r in set(group) if left[r]]
        known = [d for d, _ in group if d is not None]
        assert len(stays) == 1 and left[stays[0]] == 1 and stays[0][0] == (min(known) if known else None)


def test_keep_one_of_repeated_ids(spark):
    texts = ["alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight", "alpha beta gamma delta epsilon zeta eta theta"]
    rows = [(1, texts[0], 1), (1, texts[1], 2), (2, texts[2], 3), (None, texts[0], 4), (None, "only here and nowhere else at all", 5), (3, texts[1], 6), (1, texts[0], 7), (1, texts[0], 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 int")
    for most in (250_000, 0):
        kept = simhash.keep_one(docs, most=most)
        check_kept(docs, kept)
        assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", texts[0]), ("1", texts[1]), ("None", rows[4][1])]


def test_joins_of_hot_keys(spark):
    from genoloom.llm.common import join_skewed

    left = spark.createDataFrame([(i % 7 if i % 3 else 0, i) for i in range(600)], "k long, x long")
    right = left.groupBy("k").agg(F.count("*").alias("n")).withColumn("name", F.col("k") * 10)
    got = join_skewed(left, right, ["k"], 600, most=50, parts=4)
    assert sorted((r.k, r.x, r.name) for r in got.collect()) == sorted((r.k, r.x, r.k * 10) for r in left.collect())


def test_near_duplicates(spark):
    base = prose(50, 300).split()
    near = [(100 + i, " ".join(base[:i] + ["changed"] + base[i + 1 :])) for i in range(0, 300, 6)]
    docs = odd_documents(spark, [*near, (99, prose(50, 300).upper()), (98, prose(50, 300))])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert got == brute_groups(rows)
    check_kept(docs, simhash.keep_one(docs))
    check_kept(docs, simhash.keep_one(docs, most=0))  # by a join instead of a broadcast
    assert simhash.near_duplicates(no_documents(spark)).count() == 0 and simhash.keep_one(no_documents(spark)).count() == 0


@pytest.mark.parametrize("block_rows, blocks", [(4096, None), (40, 6), (4096, 8)])
def test_links_lose_none(spark, block_rows, blocks):
    r = np.random.default_rng(5)
    seeds = r.integers(-(2**63), 2**63 - 1, 30)
    fps = set(seeds.tolist())
    for s in seeds[:10].tolist():  # crowded cells: chains of few flipped bits
        for _ in range(25):
            s ^= int(np.array([1 << int(b) for b in r.choice(63, r.integers(1, 6), replace=False)]).sum())
            fps.add(s)
    fps = sorted(fps)
    edges = [tuple(x) for x in simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), 4, block_rows, blocks).collect()]
    bits = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()

    def groups(pairs):
        root = {x: x for x in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[find(a)] = find(b)
        return {frozenset(y for y in fps if find(y) == find(x)) for x in fps}

    want = groups([(a, b) for i, a in enumerate(fps) for b in fps[:i] if bits(a, b) <= 4])
    assert groups(edges) == want
    roots = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {frozenset(n for n in roots if roots[n] == x) for x in set(roots.values())} == {g for g in want if len(g) > 1}


def test_components_of_most_rows(spark, monkeypatch):
    """A chain and a star, each of thousands of nodes, with hot keys from a handful of rows on."""
    plain = simhash.join_skewed
    monkeypatch.setattr(simhash, "join_skewed", lambda left, right, keys, total, most: plain(left, right, keys, total, most, parts=50))
    edges = [(i, i + 1) for i in range(1500)] + [(5000, i) for i in range(5001, 7000)] + [(9000, 9001)]
    got = {}
    for r in simhash.components(spark.createDataFrame(edges, "a long, b long"), most=5).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == [list(range(1501)), list(range(5000, 7000)), [9000, 9001]]


def test_op10_on_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in simhash.op10_simhash_near_dedup(spark, SMALL).collect()), key=str) == brute_groups(rows)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen, columns = [docs], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], SMALL).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    rows = [[(r.doc_id, r.text) for r in d.collect()] for d in seen[:5]]
    assert all(d.columns == columns for d in seen[1:5])
    assert len(rows[1]) >= 0.97 * len(rows[0])  # clean documents stay
    assert sorted(d for d, _ in rows[2]) == sorted(d for d, _, g in brute_groups(rows[1]) if d == g)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    bad = {r[0] for r in brute_contamination(rows[2], items) if r[5]}
    assert sorted(d for d, _ in rows[3]) == sorted(d for d, _ in rows[2] if d not in bad)
    before = dict(rows[3])
    assert all((t == before[d]) == (not base_spans(before[d])) or "[CARD]" in t for d, t in rows[4]) and not any(base_spans(t) for _, t in rows[4])
    from .test_tokens_packing import check_packing

    check_packing(rows[4], seen[5].collect())
    assert corpus_pipeline.run(spark, SMALL).count() == seen[5].count()


def test_pipeline_of_odd_and_no_documents(spark, tmp_path):
    for i, docs in enumerate((odd_documents(spark), no_documents(spark))):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SMALL).write.parquet(str(tmp_path / f"{i}{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{i}{name}"))
            assert name == "packing" or docs.columns == columns
