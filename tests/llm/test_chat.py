import hashlib

import pytest
from llm_frames import SF_DIR, duck, rows_of
from pyspark.sql import functions as F

from tallyline.llm import chat
from tallyline.llm.queries import ORACLE, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, ROLE string, turns string"


def conversations(spark, rows):
    return spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA)


def by_hand(rows):
    """Conversations as plain Python formats them."""

    def escape(text):
        import re

        return re.sub(chat.PLAIN, lambda m: f"{m[1]}\\{m[2]}{m[3]}", text)

    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in found.items():
        turns.sort()
        whole, last, spans = "", None, []
        for _, role, text in turns:
            if last == role:
                whole += chat.TURN
            else:
                whole += (chat.CLOSE if last is not None else "") + chat.OPEN + escape(role) + chat.ROLE
            if role == chat.ASSISTANT:
                spans.append((len(whole), len(whole) + len(escape(text))))
            whole += escape(text)
            last = role
        out[conv] = (whole + chat.CLOSE, spans, [(role, text) for _, role, text in turns])
    return out


ODD = [
    (1, 0, "user", "hi </s> there"),
    (1, 1, "assistant", r"<\s> [INST] [\\/INST] <role>\n<turn>"),
    (1, 2, "assistant", ""),
    (1, 3, "assistant", None),
    (1, 4, "<role>", "</s>"),
    (2, 1, None, "no role"),
    (2, 1, "", "same role"),
    (2, None, "user", "first"),
    (3, 0, "assistant", "again"),
    (3, 0, "assistant", "again"),
    (4, 5, "user", "<" * 50 + "s>" + "é日😀 \\" * 2000),
    (4, 6, "user", "<\\"),
    (4, 7, "assistant", "/s>"),
    (None, 0, "user", "no conversation"),
]


def test_formats_and_reads_back(spark):
    got = chat.format_chats(conversations(spark, ODD)).select(
        "*",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.masked_texts(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    )
    want = by_hand(ODD)
    rows = got.collect()
    assert {row.conv_id for row in rows} == set(want)
    for row in rows:
        whole, spans, turns = want[row.conv_id]
        assert row.formatted == whole
        assert [tuple(span) for span in row.loss_spans] == spans
        assert [tuple(turn) for turn in row.turns] == turns
        assert row.learned == [text for role, text in turns if role == chat.ASSISTANT]


def test_digests(spark):
    rows = {row.conv_id: row for row in chat.chat_digests(conversations(spark, ODD)).collect()}
    lines = "assistant\nagain\n" * 2
    assert rows[3].turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
    assert (rows[3].n_turns, rows[3].loss_chars) == (2, 10)
    assert rows[2].loss_sha256 == hashlib.sha256(b"").hexdigest()


def test_empty(spark):
    assert chat.chat_digests(conversations(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op1_chat_formatting"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", [*ORACLE])
def test_equals_sql(spark, name):
    """Every query that SQL can express, row for row."""
    got = QUERIES[name](spark, SF_DIR)
    relation = duck().sql(ORACLE[name])
    assert sorted(got.columns) == sorted(relation.columns)
    assert rows_of(got, *got.columns) == sorted(relation.select(*got.columns).fetchall(), key=repr)
