"""Small tables with nulls, ties, repeats and clashing columns."""

import random
import string

WORDS = ["".join(random.Random(i).choices(string.ascii_lowercase, k=2 + i % 7)) for i in range(400)]
#: Columns that documents may also have; the operators use these names inside.
CLASHING = "row long, raw string, words string, digits string, _text string, nth long, id long, doc string, fp long, uid long, spans string, base_email string, m_card string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def odd_documents(spark, more=(), clash=True):
    """Documents of every odd kind, and ``more`` as (doc_id, text)."""
    long = prose(1, 40_000)
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "!!! 123 ..."), (5, prose(2, 30)), (5, prose(2, 30)), (5, prose(3, 8)), (None, prose(4, 12)), (None, None), (6, long), (7, "é ß ñ   日本語 \U0001f600"),
            (8, "a\r\nb\x0bc\x0c d  e\t\tf"), (9, "<|endoftext|> x <|endoftext|>y"), (10, "word"), *more]
    extra = len(CLASHING.split(", ")) if clash else 0
    schema = "doc_id long, text string, lang string, source string, n_chars int" + (", " + CLASHING if clash else "")
    kinds = [x.split()[1] for x in CLASHING.split(", ")][:extra]
    fill = [None if k == "string" and i % 2 else "x" if k == "string" else 7 for i, k in enumerate(kinds)]
    return spark.createDataFrame([(d, t, [None, "en", "de"][i % 3], None if i % 4 else "s", None if t is None else len(t), *fill) for i, (d, t) in enumerate(rows)], schema)


def no_documents(spark):
    return odd_documents(spark).filter("doc_id = -1")
