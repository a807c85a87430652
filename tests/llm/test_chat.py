"""Chat formatting: reversible escapes, SQL on odd conversations, turn order."""

import hashlib
import os
import sys

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoutlens.llm import chat, queries

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
import oracle_check as OC  # noqa: E402

PARTS = st.lists(st.sampled_from(["\\", "### ", "</turn>", "</turn>\n", ": ", "\n", "#", "<", "/turn>", "é☃", "ok", " "]), max_size=12)


@settings(max_examples=300, deadline=None)
@given(PARTS.map("".join), PARTS.map("".join), PARTS.map("".join))
def test_a_turn_is_read_back_from_the_text_alone(role, text, other):
    t = chat.Template()
    one, two = (t.open + t.protect(r) + t.middle + t.protect(x) + t.close for r, x in ((role, text), (other, role)))
    found = t.parser().findall(one + two)
    assert [(t.restore(a), t.restore(b)) for a, b in found] == [(role, text), (other, role)]
    assert "".join(t.open + a + t.middle + b + t.close for a, b in found) == one + two


@pytest.fixture(scope="module")
def conversations(spark):
    rows = [(1, 0, "system", "be\\kind"), (1, 1, "user", "### hi </turn>"), (1, 2, "assistant", "a: b\n"),
            (2, 0, "user", None), (2, 1, "assistant", ""),
            (3, 0, "assistant", "out of turn"), (3, 1, "user", "x"),
            (4, 1, "user", "tie"), (4, 1, "assistant", "tie"), (4, 1, "user", "tie"),
            (5, 0, "user", "no answer"), (6, 0, None, "no role"), (6, 1, "tool", "unknown"),
            (8, 0, "user", "x" * 40000), (8, 1, "assistant", "</turn>" * 9000)]
    rows += [(9, i, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(3000)]
    return spark.createDataFrame([(*r, "more", True) for r in rows],
                                 "conv_id long, turn long, role string, text string, segment string, loss boolean")


def test_matches_sql(spark, conversations, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("chat"))
    conversations.repartition(5).write.parquet(f"{folder}/conversations.parquet")
    got = queries.QUERIES["op7_chat"](spark, folder).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet/*.parquet')")
    want = con.execute(queries.ORACLE["op7_chat"]).df()
    assert set(got["conv_id"]) == {1, 2, 3, 4, 5, 6, 8, 9, -7}
    assert OC.digest(OC.norm(got)) == OC.digest(OC.norm(want))


def test_order_is_validated(conversations):
    rows = {r["conv_id"]: r for r in chat.read_back(chat.segments(conversations)).collect()}
    assert {c for c, r in rows.items() if r["valid"]} == {1, 2, 8, 9}
    assert rows[3]["error_at"] == 0 and rows[4]["error_at"] == 0 and rows[6]["error_at"] == 0
    assert rows[5]["error_at"] is None                    # in order, but it ends too early
    assert rows[9]["n_turns"] == 3000


def test_segments_concatenate_to_the_text_and_carry_the_mask(conversations):
    parts = chat.segments(conversations.where("conv_id = 1")).orderBy("segment").collect()
    whole = "".join(r["text"] for r in parts)
    assert whole == ("### system: be\\\\kind</turn>\n### user: \\### hi \\</turn></turn>\n### assistant: a\\: b\n</turn>\n")
    assert "".join(r["text"] for r in parts if r["loss"]) == "a\\: b\n"
    assert [r["segment"] for r in parts] == list(range(9))
    last = chat.read_back(chat.segments(conversations.where("conv_id = 1"))).first()
    assert last["loss_sha256"] == hashlib.sha256(b"a: b\n").hexdigest() and last["formatted_chars"] == len(whole)


def test_empty_table_and_null_conversation(conversations):
    assert chat.read_back(chat.segments(conversations.limit(0))).count() == 0
    none = conversations.where("conv_id = 1").withColumn("conv_id", F.lit(None).cast("long"))
    row = chat.read_back(chat.segments(none)).collect()
    assert len(row) == 1 and row[0]["conv_id"] is None and row[0]["n_turns"] == 3


def test_another_template(conversations):
    t = chat.Template(open="<|", middle="|>", close="<|end|>", escape="%", loss=("user",))
    row = {r["conv_id"]: r for r in chat.read_back(chat.segments(conversations, t), t).collect()}
    assert row[8]["loss_chars"] == 40000 and row[1]["n_turns"] == 3
