"""Chat formatting at the level of tokens.

A turn is ``<s>role[INST]text[/INST]</s>``. Role and text are encoded apart from the marks, and the marks are ids past
the vocabulary's end, so no text can produce one. Control strings inside a role or text are escaped by a backslash
after their first character (one more if some are there already), which is undone on reading; that makes the template
reversible as a string too. The loss mask of a token array is a prefix sum: one up after an assistant's ``[INST]``, one
down at its ``[/INST]``, over all tokens of a batch of turns at once. Everything that is reported about a conversation,
its length as a string included, is read from the token arrays.

Edge cases: rows of a conversation go by turn, ties by role, then text; null roles and texts are empty; a null conv_id
is a conversation of its own; repeated rows are turns of their own; an empty table gives an empty result. Formatted
conversations are kept as one row a turn, so a conversation of any length fits; reading streams through them.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_schema, batch_of, map_rows, rows_in_batches, ship, stored, table
from .tokens import byte_bpe, encoder

MARKS = ("<s>", "[INST]", "[/INST]", "</s>")  # ids from the vocabulary's size on, in this order
_CONTROL = re.compile(r"(<|\[)(\\*)(/?s>|/?INST\])")
_ESCAPED = re.compile(r"(<|\[)\\(\\*)(/?s>|/?INST\])")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_turns(turns: DataFrame, tokenizer: str) -> DataFrame:
    """conv_id, nth (place in its conversation, from 1) and ids of ``turns`` (conv_id, turn, role, text). Turns are encoded
    where their rows lie, so a conversation that holds most of a table is many tasks' work; only its numbering, by one
    shuffle, is one task's."""

    def make():
        enc = encoder(tokenizer, special=True)
        mark = [enc.size + i for i in range(len(MARKS))]

        def step(convs, order, roles, texts):
            coded = [np.frombuffer(x, enc.dtype).astype(np.int32).tolist() for x in enc.encode([escape(x or "") for x in roles + texts])]
            n = len(convs)
            return [convs, order, roles, texts, [[mark[0], *role, mark[1], *text, mark[2], mark[3]] for role, text in zip(coded[:n], coded[n:])]]

        return step

    encoded = map_rows(turns.withColumn("turn", F.col("turn").cast("long")), make, "conv_id long, turn long, role string, text string, ids array<int>", ["conv_id", "turn", "role", "text"], most=512)
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return encoded.select("conv_id", nth.cast("long").alias("nth"), "ids")


def loss_mask(ids: np.ndarray, marks: list[int], assistant: np.ndarray) -> np.ndarray:
    """True for the content tokens of an assistant's turns, as a prefix sum over the marks. ``assistant``: for each
    token, whether its turn's role is the assistant's."""
    up = np.where((ids == marks[1]) & assistant, 1, 0)
    down = np.where((ids == marks[2]) & assistant, 1, 0)
    return np.cumsum(np.concatenate([[0], up[:-1]]) - down) > 0


def read_turns(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """What formatted turns say: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens,
    loss_tokens. Turns are decoded and masked where their rows lie; then one pass over a conversation's sorted rows rolls
    the hashes, which by their nature are one task's work."""

    def decoded():
        enc = encoder(tokenizer, special=True)
        marks = [enc.size + i for i in range(len(MARKS))]
        fixed = sum(map(len, MARKS))

        def step(convs, places, rows):
            rows = [np.array(x, dtype=np.int64) for x in rows]
            cuts = [(int(np.flatnonzero(x == marks[1])[0]), int(np.flatnonzero(x == marks[2])[0])) for x in rows]
            roles = [enc.decode(x[1:opened]) for x, (opened, _) in zip(rows, cuts)]
            mask = loss_mask(np.concatenate(rows), marks, np.repeat([unescape(r) == "assistant" for r in roles], [len(x) for x in rows]))
            out, at = [[], [], [], [], []], 0
            for ids, role, (opened, ended) in zip(rows, roles, cuts):
                own = mask[at : at + len(ids)]
                at += len(ids)
                text = enc.decode(ids[opened + 1 : ended])
                for column, value in zip(out, (f"{unescape(role)}\n{unescape(text)}\n", unescape(enc.decode(ids[own])), fixed + len(role) + len(text), len(ids), int(own.sum()))):
                    column.append(value)
            return [convs, places, *out]

        return step

    said = map_rows(formatted, decoded, "conv_id long, nth long, said string, learnt string, formatted long, tokens long, masked long", ["conv_id", "nth", "ids"], most=256)
    ddl = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long, loss_tokens long"
    schema = arrow_schema(ddl)

    def run(batches):
        conv, state, done = None, None, []

        def closed():
            turns, loss, n, chars, formatted, tokens, masked = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted, tokens, masked

        for columns in rows_in_batches(batches, ["conv_id", "said", "learnt", "formatted", "tokens", "masked"], 256):
            for c, text, learnt, formatted, tokens, masked in zip(*columns):
                if state is None or c != conv:
                    if state is not None:
                        done.append(closed())
                    conv, state = c, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0, 0]
                state[0].update(text.encode())
                state[1].update(learnt.encode())
                state[2:] = [state[2] + 1, state[3] + len(learnt), state[4] + formatted, state[5] + tokens, state[6] + masked]
            if len(done) > 1000:
                yield batch_of(schema, [list(x) for x in zip(*done)])
                done = []
        if state is not None:
            done.append(closed())
        if done:
            yield batch_of(schema, [list(x) for x in zip(*done)])

    ship(formatted.sparkSession)
    return said.repartition("conv_id").sortWithinPartitions("conv_id", "nth").drop("nth").mapInArrow(run, ddl)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionByName(planted)
    formatted = stored(format_turns(turns, byte_bpe()), "chats")
    return read_turns(formatted, byte_bpe()).drop("n_tokens", "loss_tokens")


OP1_SQL = r"""
WITH t AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(role, '(<|\[)(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + length(regexp_replace(text, '(<|\[)(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + 20 AS chars FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
