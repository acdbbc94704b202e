"""Personal data by weak supervision, in DataFrame functions alone.

Candidate spans come from the base patterns and from wider ones (addresses spelt with (at), card numbers inside longer
runs, phone numbers without a country code, national ids). Five labelers vote on each candidate, for, against or not at
all: its pattern and checksum, a gazetteer of prefixes and endings, cue words before it, its neighbours, its shape.
Expectation-maximisation over the counted vote patterns estimates how often each labeler votes how on real and false
spans; the posteriors then train a logistic classifier of spans, applied as a column expression. Base spans stay,
whatever it says; others are added where it says yes and no span kept before them overlaps.

What reaches the driver is a table of vote patterns with their counts, of a size fixed by the labelers.

Positions count code points, ends exclusive. They follow from the texts between matches, so a pattern runs at most twice
over a text, and once where nothing matches. Patterns neither backtrack nor recurse over long runs. Running sums and
maxima over a text's spans are taken in blocks and overlaps are looked for among sorted spans, so texts of many thousand
spans cost little more than in proportion.

Edge cases: a null text is an empty one; repeated doc_ids each get a row, null ones too; texts of any length are searched
whole; spans of one kind never overlap, of kinds that do (an address in a phone number) all base spans stay; an empty
table gives an empty result; other columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

KINDS = ("email", "ip", "card", "phone", "id")
#: Possessive forms of the base patterns; none can match otherwise by giving characters back.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDER = {
    "email": r"[A-Za-z0-9](?<![A-Za-z0-9]{2})[A-Za-z0-9._%+-]*+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "card": r"(?<![0-9])[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9+.(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    "id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
GUARD = {"email": "instr(text, '@') > 0", "ip": "digits", "card": "digits", "phone": "instr(text, '+') > 0"}
WIDER_GUARD = {"email": "instr(text, '(at)') > 0 OR instr(text, '[at]') > 0", "card": "exists(m_card, x -> length(x) > 13 AND NOT ({valid}))", "phone": "digits", "id": "digits"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
VALID = {
    "email": "true",
    "ip": rf"rlike(x.v, r'^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$')",
    "card": "length(translate(x.v, ' -', '')) BETWEEN 13 AND 19 AND {luhn}",
    "phone": "length(regexp_replace(x.v, '[^0-9]', '')) BETWEEN 9 AND 15",
}
LUHN = """aggregate(sequence(1, length(translate(x.v, ' -', ''))), 0, (a, i) -> a + CASE WHEN i % 2 = 1 THEN CAST(substr(reverse(translate(x.v, ' -', '')), i, 1) AS INT)
 WHEN substr(reverse(translate(x.v, ' -', '')), i, 1) >= '5' THEN CAST(substr(reverse(translate(x.v, ' -', '')), i, 1) AS INT) * 2 - 9 ELSE CAST(substr(reverse(translate(x.v, ' -', '')), i, 1) AS INT) * 2 END) % 10 = 0"""
WIDER_GUARD["card"] = WIDER_GUARD["card"].format(valid=VALID["card"].format(luhn=LUHN).replace("x.v", "x"))  # a base match may hold a card without being one
#: Fixed gazetteers: endings of addresses, country codes, first digits of card issuers, area and id prefixes, cue words.
GAZETTEER = {
    "email": r"rlike(lower(x.v), '(\\.|\\(dot\\)|\\[dot\\]) ?(com|org|net|edu|gov|io|info|eu|uk|de|fr|es|it|nl|ch|at|us|ca|au|jp|cn|in|br|ru)$')",
    "ip": r"rlike(x.v, '^0*([1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])\\.') AND NOT rlike(x.v, '^0*127\\.')",
    "card": "rlike(x.v, '^[3-6]')",
    "phone": r"rlike(x.v, '^(\\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})|\\(?[2-9])')",
    "id": "NOT rlike(x.v, '^(000|666|9)')",
}
CUES = {
    "email": "(e-?mail|contact|kontakt|courriel|correo|write|reply)",
    "ip": "(ip|host|server|address|login|from|client)",
    "card": "(card|visa|master|amex|karte|carte|tarjeta|payment)",
    "phone": "(phone|tel|call|mobile|fax|anruf|appel|llam|number)",
    "id": "(ssn|social|security|id|tax|passport)",
}
VOTES = {  # for, against or no vote; own: the span passes its base pattern
    "pattern": "CASE WHEN x.own THEN 1 WHEN x.kind = 'card' THEN CASE WHEN {luhn} THEN 1 ELSE -1 END ELSE 0 END",
    "gazetteer": "CASE WHEN {gazetteer} THEN 1 ELSE -1 END",
    "cues": "CASE WHEN {cues} THEN 1 ELSE 0 END",
    "neighbours": "CASE WHEN rlike(x.l, '[A-Za-z0-9-]$') OR rlike(x.r, '^[A-Za-z0-9]') OR rlike(lower(x.l), '(version|isbn|section|order|invoice|page) *$') THEN -1 ELSE 1 END",
    "shape": "CASE WHEN x.kind = 'email' THEN CASE WHEN length(x.v) BETWEEN 6 AND 254 THEN 1 ELSE -1 END WHEN size(array_distinct(split(regexp_replace(x.v, '[^0-9]', ''), ''))) > 2 THEN 1 ELSE -1 END",
}
CONTEXT = 30
CHUNK = 4096
_SPAN = "array<struct<v:string,s:bigint,e:bigint,l:string,r:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once and not for each element that a function in ``body`` visits."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _before(values: Column, start: Column, merge: Callable[[Column, Column], Column], block: int = 64) -> Column:
    """For each element of an array of longs, what ``merge`` makes of ``start`` and all elements before it (their sum, their
    maximum): by blocks, so the work stays near to linear in the array's length."""
    of = lambda i: F.floor(i / block).cast("int")

    def running(v):
        whole = F.transform(F.sequence(F.lit(0), of(F.size(v) - 1)), lambda b: F.aggregate(F.slice(v, b * block + 1, F.lit(block)), start, merge))
        heads = F.aggregate(whole, F.array(start), lambda a, x: F.concat(a, F.array(merge(F.element_at(a, -1), x))))
        return _let(heads, lambda h: F.transform(v, lambda x, i: F.aggregate(F.slice(v, of(i) * block + 1, i % block), F.get(h, of(i)), merge)))

    return _let(values, lambda v: F.when(F.size(v) > 0, running(v)).otherwise(F.array().cast("array<bigint>")))


_zero = lambda: F.lit(0).cast("long")
_add = lambda a, x: a + x


def _spans(matches: str, pieces: str) -> Column:
    """Spans of matches with their neighbourhood, from the matches and the texts between them."""
    size = lambda c: F.length(c).cast("long")

    def spans(m, p):
        def span(x, i, before):
            start = F.get(before, i) + size(F.get(p, i))
            return F.struct(x.alias("v"), start.alias("s"), (start + size(x)).alias("e"), F.right(F.get(p, i), F.lit(CONTEXT)).alias("l"), F.left(F.get(p, i + 1), F.lit(CONTEXT)).alias("r"))

        return _let(_before(F.transform(m, lambda x, i: size(x) + size(F.get(p, i))), _zero(), _add), lambda before: F.transform(m, lambda x, i: span(x, i, before)))

    return _let(F.col(matches), lambda m: _let(F.col(pieces), lambda p: spans(m, p))).cast(_SPAN)


def _apart(spans: Column, others: Column) -> Column:
    """``spans`` (with s and e) that overlap none of ``others``: all are sorted, a span by its end, another by its start,
    and a span is free if the farthest end of the others before it isn't past its start."""

    def free(x, y):
        ends = F.transform(x, lambda v, i: F.struct(v.e.alias("at"), F.lit(0).alias("other"), v.s.alias("reach"), i.alias("i")))
        starts = F.transform(y, lambda v: F.struct(v.s.alias("at"), F.lit(1).alias("other"), v.e.alias("reach"), F.lit(-1).alias("i")))

        def chosen(event):
            far = _before(F.transform(event, lambda v: F.when(v.other == 1, v.reach).otherwise(_zero())), _zero(), lambda a, v: F.greatest(a, v))
            return _let(far, lambda f: F.transform(F.filter(event, lambda v, i: (v.other == 0) & (F.get(f, i) <= v.reach)), lambda v: F.get(x, v.i)))

        return _let(F.array_sort(F.concat(ends, starts)), chosen)

    return _let(spans, lambda x: _let(others, lambda y: F.when((F.size(x) == 0) | (F.size(y) == 0), x).otherwise(free(x, y))))


def _by_kind(texts: dict[str, str]) -> str:
    return "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {t}" for k, t in texts.items()) + " END"


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with one array column for each base kind and each wider one: base_<kind>, wide_<kind>; elements have
    kind, v (text), s, e (place), own (base pattern), votes (array of -1, 0, 1)."""
    every = [("base", k, BASE[k], GUARD[k]) for k in BASE] + [("wide", k, WIDER[k], WIDER_GUARD[k]) for k in WIDER]
    kept = docs.columns
    df = docs.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("digits", F.col("text").rlike("[0-9]"))
    none = F.array().cast("array<string>")
    for tier in ("base", "wide"):  # a wider guard looks at the base matches
        df = df.withColumns({f"m_{k}" if t == "base" else f"mw_{k}": F.when(F.expr(guard), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none) for t, k, p, guard in every if t == tier})
    name = lambda t, k: k if t == "base" else f"w_{k}"
    match = lambda t, k: f"m_{k}" if t == "base" else f"mw_{k}"
    df = df.withColumns({f"p_{name(t, k)}": F.when(F.size(match(t, k)) > 0, F.split("text", p, -1)).otherwise(none) for t, k, p, _ in every})
    df = df.withColumns({f"s_{name(t, k)}": F.when(F.size(match(t, k)) > 0, _spans(match(t, k), f"p_{name(t, k)}")).otherwise(F.array().cast(_SPAN)) for t, k, _, _ in every})
    luhn = LUHN
    valid = {k: v.format(luhn=luhn) if k == "card" else v for k, v in VALID.items()}
    votes = ", ".join(v.replace("{luhn}", luhn).replace("{gazetteer}", _by_kind(GAZETTEER)).replace("{cues}", _by_kind({k: f"rlike(lower(x.l), '{c}')" for k, c in CUES.items()})) for v in VOTES.values())
    out = {}
    for t, k, _, _ in every:
        spans = f"filter(s_{name(t, k)}, x -> {valid[k]})" if t == "base" else f"s_{name(t, k)}"
        marked = f"transform({spans}, x -> named_struct('kind', '{k}', 'v', x.v, 's', x.s, 'e', x.e, 'l', x.l, 'r', x.r, 'own', {str(t == 'base').lower()}))"
        out[f"{t}_{k}"] = F.expr(f"transform({marked}, x -> named_struct('kind', x.kind, 'v', x.v, 's', x.s, 'e', x.e, 'own', x.own, 'votes', array({votes})))")
    return df.select(*[F.col(c) for c in kept], *[c.alias(n) for n, c in out.items()])


def _columns() -> list[str]:
    return [f"base_{k}" for k in BASE] + [f"wide_{k}" for k in WIDER]


def fit(found: DataFrame, rounds: int = 50) -> dict:
    """A span classifier from counted vote patterns. Expectation-maximisation with a rate of each vote given real or
    false, from a start that trusts the majority; a vote for never counts against; then logistic regression on kind and votes, by the posteriors."""
    patterns = found.select(F.explode(F.concat(*_columns())).alias("x")).groupBy("x.kind", "x.votes").count().collect()
    data = [(r.kind, tuple(r.votes), r["count"]) for r in patterns]
    post = [1 / (1 + math.exp(-sum(v))) for _, v, _ in data]
    width = len(VOTES)
    for _ in range(rounds if data else 0):
        real = sum(p * n for p, (*_, n) in zip(post, data))
        false = sum((1 - p) * n for p, (*_, n) in zip(post, data))
        rate = [[{v: 1.0 for v in (-1, 1)} | {0: 0.0} for _ in range(width)] for _ in range(2)]
        for p, (_, votes, n) in zip(post, data):
            for j, v in enumerate(votes):
                rate[1][j][v] += p * n * abs(v)  # no vote is no evidence
                rate[0][j][v] += (1 - p) * n * abs(v)
        logs = [[{v: math.log(c / sum(r.values())) if v else 0.0 for v, c in r.items()} for r in side] for side in rate]
        weight = [{v: v * max(0.0, v * (logs[1][j][v] - logs[0][j][v])) for v in (-1, 0, 1)} for j in range(width)]  # no labeler is worse than chance
        prior = math.log((real + 1) / (false + 1))
        post = [1 / (1 + math.exp(-max(-30, min(30, prior + sum(weight[j][v] for j, v in enumerate(votes)))))) for _, votes, _ in data]
    w: dict[str, float] = {}
    names = [[f"kind {k}", *(f"vote {j} {v}" for j, v in enumerate(votes) if v)] for k, votes, _ in data]
    total = sum(n for *_, n in data)
    squares: dict[str, float] = {}
    for _ in range(200):
        grad: dict[str, float] = {}
        for p, own, (*_, n) in zip(post, names, data):
            err = (p - 1 / (1 + math.exp(-max(-30, min(30, sum(w.get(x, 0.0) for x in own)))))) * n / total
            for x in own:
                grad[x] = grad.get(x, 0.0) + err
        for x, g in grad.items():
            g -= 1e-4 * w.get(x, 0.0)
            squares[x] = squares.get(x, 1e-12) + g * g
            w[x] = w.get(x, 0.0) + 0.3 * g / math.sqrt(squares[x])
    return w


def classify(found: DataFrame, model: dict) -> DataFrame:
    """``found`` with kept_<kind>: the base spans and the wider ones that the classifier takes, by start."""
    of = lambda name: f"coalesce({' + '.join([name])}, 0D)"
    table_of = lambda prefix: "map(" + (", ".join(f"'{x[len(prefix):]}', {v!r}D" for x, v in model.items() if x.startswith(prefix)) or "'', 0D") + ")"
    parts = [of(f"try_element_at({table_of('kind ')}, x.kind)")]
    parts += [of(f"try_element_at({table_of(f'vote {j} ')}, CAST(x.votes[{j}] AS STRING))") for j in range(len(VOTES))]
    df, before = found, [f"transform(base_{k}, x -> struct(x.s, x.e))" for k in BASE]
    for k in WIDER:
        df = df.withColumn(f"added_{k}", _apart(F.expr(f"transform(filter(wide_{k}, x -> {' + '.join(parts)} > 0), x -> struct(x.s, x.e))"), F.expr(f"concat({', '.join(before)})")))
        before = [*before, f"added_{k}"]
    sides = {k: [f"transform(base_{k}, x -> struct(x.s, x.e))"] * (k in BASE) + [f"added_{k}"] * (k in WIDER) for k in KINDS}
    return df.withColumns({f"kept_{k}": F.expr(f"array_sort(concat({', '.join(sides[k])}))") for k in KINDS})


def _listed(columns: dict[str, str]) -> Column:
    return F.concat_ws(",", F.concat(*[F.expr(f"transform({c}, x -> concat('{k}:', x.s, ':', x.e))") for k, c in columns.items()]))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_<kind> and base_sha256 of the base spans, spans (all of them)."""
    found = stored(candidates(docs.select("doc_id", "text")).select("doc_id", *_columns()), "pii-candidates")
    kept = classify(found, fit(found))
    return kept.select("doc_id", *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in BASE],
                       F.sha2(_listed({k: f"base_{k}" for k in BASE}), 256).alias("base_sha256"), _listed({k: f"kept_{k}" for k in KINDS}).alias("spans"))


def _part(chunks: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end`` of a text cut into chunks of CHUNK characters."""
    of, in_ = (lambda c: F.floor(c / CHUNK).cast("int")), (lambda c: (c % CHUNK).cast("int"))
    first, last = F.get(chunks, of(start)), F.coalesce(F.get(chunks, of(end)), F.lit(""))
    inner = F.array_join(F.slice(chunks, of(start) + 2, F.greatest(of(end) - of(start) - 1, F.lit(0))), "")
    far = F.concat(F.substr(first, in_(start) + 1), inner, F.substr(last, F.lit(1), in_(end)))
    return F.when(start >= end, F.lit("")).when(of(start) == of(end), F.substr(first, in_(start) + 1, (end - start).cast("int"))).otherwise(far)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with each span's text replaced by [EMAIL], [IP], [CARD], [PHONE] or [ID] and n_chars made to fit.
    Where spans overlap, the one that starts first (at one start, the longest) is replaced whole, of others what is left
    after its end. Candidates are found once and stored with their rows; the work is linear in a text's length and spans.
    A null text stays null."""
    packed = docs.select("text", F.struct("*").alias("doc"))  # so that no column of docs can clash with ours
    found = stored(candidates(packed).drop("text"), "pii-candidates")
    kept = classify(found, fit(found))
    marked = lambda k: lambda x: F.struct(x.s.alias("s"), (-x.e).alias("less"), F.lit(f"[{k.upper()}]").alias("mark"))
    spans = F.array_sort(F.concat(*[F.transform(f"kept_{k}", marked(k)) for k in KINDS]))

    def rebuilt(x, chunks):
        ends = F.transform(x, lambda v: -v.less)
        done = _before(ends, _zero(), lambda a, v: F.greatest(a, v))
        parts = _let(done, lambda d: F.transform(x, lambda v, i: F.when(-v.less <= F.get(d, i), F.lit("")).otherwise(F.concat(_part(chunks, F.get(d, i), F.greatest(v.s, F.get(d, i))), v.mark))))
        return F.concat(F.array_join(parts, ""), _part(chunks, F.array_max(ends), F.length("doc.text").cast("long")))

    chunks = F.regexp_extract_all("doc.text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    new = F.when(F.col("doc.text").isNull() | (F.size("spans") == 0), F.col("doc.text")).otherwise(_let(F.col("spans"), lambda x: _let(chunks, lambda c: rebuilt(x, c))))
    out = kept.select("doc", spans.alias("spans")).withColumn("new", new)
    changed = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return out.select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
