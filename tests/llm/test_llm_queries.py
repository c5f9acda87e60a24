"""Registered queries over the smallest given tables, against SQL or plain versions."""

import hashlib
import os
import sys

import duckdb
import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.join(ROOT, "tools")]

import __spark_entry__ as registered  # noqa: E402
import brute  # noqa: E402
from check_queries import TABLES, compare  # noqa: E402

from waybill.llm.oracles import SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return con.sql("select doc_id, text from documents").fetchall()


def rows_of(spark, name):
    return registered.queries()[name](spark, FOLDER).collect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    _, problems = compare(registered.queries()[name](spark, FOLDER), con, registered.oracle_sql()[name])
    assert not problems


def test_substring_dedup(spark, texts):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows_of(spark, "op1_substring_dedup")}
    assert got == brute.substring(texts)
    assert sum(x[1] for x in got.values())


def test_quality_classifier(spark, con):
    got = {r.doc_id: r for r in rows_of(spark, "op2_quality_classifier")}
    assert len(got) == con.sql("select count(*) from documents").fetchall()[0][0]
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got.values())
    labels = [(got[d], q) for d, q in con.sql("select doc_id, quality from labels").fetchall() if got[d].held_out]
    assert np.mean([r.predicted == q for r, q in labels]) > 0.9


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    from waybill.llm.queries import tokenizer_path

    tokenizer, want = Tokenizer.from_file(tokenizer_path()), {}
    for doc_id, text in texts:
        want |= brute.piece_rows(tokenizer, doc_id, text)
    rows = rows_of(spark, "op3_best_fit_packing")
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096
    assert len(ends) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_embeddings(spark, con):
    got = {r.vec_id: (r.n_links, r.component_id) for r in rows_of(spark, "op5_embedding_dedup")}
    assert got == brute.embeddings(con.sql("select vec_id, embedding from embeddings").fetchall())


def test_simhash(spark, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in rows_of(spark, "op9_simhash_near_dedup")}
    assert got == brute.simhash(texts)
    assert len({x[1] for x in got.values()}) < len(got)


def test_secret_spans_by_pattern(spark, texts):
    got = {r.doc_id: (r.n_assign, r.base_sha256) for r in rows_of(spark, "op7_secret_scan")}
    for doc_id, text in texts:
        spans = brute.base_spans(text)
        assert got[doc_id] == (sum(s.startswith("assign") for s in spans), hashlib.sha256(",".join(spans).encode()).hexdigest())


def test_chat_keeps_maximal_conversations(spark, con):
    got = {r.conv_id: r.n_turns for r in rows_of(spark, "op10_chat_format")}
    assert got == brute.chats(con.sql("select conv_id, turn, role, text from conversations").fetchall())
