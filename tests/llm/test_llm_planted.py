"""The SQL of native operators over planted tables, where every branch of their methods is taken."""

import os
import random
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.join(ROOT, "tools")]

import __spark_entry__ as registered  # noqa: E402
from check_queries import compare  # noqa: E402


def drawn(rng, n=24):
    value = "".join(rng.choice("ABCDEFGHJKabcdefghjk23456789") for _ in range(n))
    return f"{value}Qz7x{n % 10}Ab1"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng, folder = random.Random(11), str(tmp_path_factory.mktemp("planted"))
    wide, round_, live = drawn(rng), drawn(rng), [drawn(rng) for _ in range(20)]
    docs, good = [], " ".join(f"word{k}" for k in range(60))
    for k in range(300):
        source = f"host{k % 7}"
        value = wide if k % 3 == 0 else round_ if k % 7 < 2 else live[k % 20] if k % 11 == 0 else ""
        bad = k % 7 == 3 and k % 10
        text = "spam spam spam " * 5 if bad else f"{good} {k} # {value}\nline\nline\n{'#&$' * (k % 5)} token={'x' * (k % 9)}{k}"
        docs.append((k, text, "en", source, len(text)))
    docs += [(900, None, "en", None, None), (901, "", "fr", "host1", 0), (902, " \n ", None, "host2", 3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    turns = []
    for c in range(60):
        n = 1 + c % 6
        turns += [(c, t, "user" if t % 2 == 0 else "assistant", f"{'a' if c % 3 else 'b'}{t}") for t in range(n)]
    turns += [(None, 0, "user", "a0"), (None, 1, "user", "other"), (None, None, None, None), (70, 0, None, "x"), (70, 0, None, "x")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    hosts = ["a.example.com", "b.a.example.com", "EXAMPLE.com.", "x.org", "user@y.net"]
    pages = [(k, f"http://{hosts[k % 5]}/{'p' * (k % 3 * 4000)}{k}", "") for k in range(900)] + [(2000, None, None), (2001, "no url", "x")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([(1, "word1 word2 line"), (2, "nothing of it"), (3, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "benchmark"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    return folder, con


@pytest.mark.parametrize("name", ["op4_url_lists", "op7_secret_scan", "op8_host_rules", "op10_chat_format", "op11_lexical_search", "op12_collocations"])
def test_equals_sql_on_planted_tables(spark, planted, name):
    folder, con = planted
    _, problems = compare(registered.queries()[name](spark, folder), con, registered.oracle_sql()[name])
    assert not problems


def test_branches_are_taken(spark, planted):
    folder, _ = planted
    run = lambda name: registered.queries()[name](spark, folder).collect()
    assert sum("loose" in r.spans for r in run("op7_secret_scan")) > 0
    assert {r.host_failed for r in run("op8_host_rules")} == {True, False}
    chats = run("op10_chat_format")
    assert len(chats) < 60 and max(r.n_copies for r in chats) > 1
    assert {r.action for r in run("op4_url_lists")} >= {"block", None}
