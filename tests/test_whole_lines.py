"""Queries over documents' lines on whole lines, however long, against figures worked out by hand."""

import hashlib

import pytest

from stratadoc.plans import record_queries as rq

SENTENCES = [f"s{i:02} " + "w" * 95 + "." for i in range(30)]  # 100 characters each
LONG = " ".join(SENTENCES)
#: Fragments close at 1200 characters: twelve, twelve and six sentences.
PARTS = [" ".join(SENTENCES[a:b]) for a, b in ((0, 12), (12, 24), (24, 30))]
LINES = ["a b", LONG, "x", "t" * 150, " "]  # the line at place 3 is a table


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("lines"))
    spark.createDataFrame([(1, "\n".join(LINES)), (2, "short")], "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    return d


def test_index_filter_has_the_fragments_of_long_lines(spark, lines):
    got = sorted(tuple(r) for r in rq.index_filter(spark, lines).collect())
    assert got == [(1, "child", 3, 3 + len(LONG) + 1), (1, "fragment", 3, sum(map(len, PARTS))), (1, "table", 1, 150), (2, "child", 1, 5)]


def test_json_nodes_hold_whole_texts(spark, tmp_path):
    texts = ["  lead " + "é\"\\/\t" * 30 + "\nsecond line\r\n" + "z" * 5000 + " \n", " " * 60 + "late", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in rq.json_node_walk(spark, str(tmp_path)).collect())
    want = []
    for i, t in enumerate(texts):
        kept = [("p", 2, t.strip())] if t and t.strip() else []
        want += [(str(i), n, *node) for n, node in enumerate([*kept, ("q", 3, "tail")], 1)]
    assert got == sorted(want)


def test_sibling_links_run_through_fragments(spark, lines):
    key = lambda kind, basis: hashlib.sha256(f"rag:1:{kind}:{basis}".encode()).hexdigest()
    chunk = [hashlib.sha256(f"1:{i + 1}".encode()).hexdigest() for i in range(len(LINES))]
    child = [key("child", c) for c in chunk]
    fragments = [key("fragment", f"{child[1]}:{n}:{p[:80]}") for n, p in enumerate(PARTS, 1)]
    order = [key("section_context", key("parent", "S0")), child[0], child[1], *fragments, child[2], key("table", f"{chunk[3]}:1:{'t' * 80}"), child[4]]
    want = [(i, a, b, len(order) - 1) for i, a, b in zip(order, ["", *order], [*order[1:], ""])]
    got = rq.sibling_links(spark, lines).where("document_id = 1").select("chunk_id", "previous", "next", "siblings").collect()
    assert sorted(map(tuple, got)) == sorted(want)
