"""Behaviour of single operators on small cases."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratadoc.functions import headings as hd
from stratadoc.functions import text as tx
from stratadoc.operators import answers as an
from stratadoc.operators import assets as at
from stratadoc.operators import blocks as bl
from stratadoc.operators import chunks as ch
from stratadoc.operators import evaluation as ev
from stratadoc.operators import hierarchy as hi
from stratadoc.operators import parsing
from stratadoc.operators import report as rp
from stratadoc.operators import retrieval as rt
from stratadoc.sources import readers as rd
from stratadoc.sources import writers as wr


def one(spark, column, **values):
    names = list(values)
    schema = ", ".join(f"{n} {'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'string'}" for n, v in values.items())
    return spark.createDataFrame([tuple(values[n] for n in names)], schema).select(column.alias("x")).head()[0]


# ---- text

def test_tokens_keep_accents(spark):
    assert one(spark, tx.tokens(F.col("t")), t="PRAZO, Contratação nº 007/2026.") == ["prazo", "contratação", "nº", "007", "2026"]


def test_plain_text(spark):
    assert one(spark, tx.plain(F.col("t")), t="A  proposta\n sera enviada") == "A proposta sera enviada"
    assert one(spark, tx.plain(F.col("t")), t=" a \n\n \n b\tc\r\nd ") == "a\n\nb c d"


def test_assets_in_text(spark):
    t = "![Image](data:image/png;base64,aGVsbG8=)"
    assert one(spark, tx.without_assets(F.col("t")), t=t) == "" and one(spark, tx.asset_markers(F.col("t")), t=t) == 1


def test_pages(spark):
    df = spark.createDataFrame([(1, 3), (5, 2), (None, 4), (7, None), (None, None)], "a int, b int")
    assert [r[0] for r in df.select(tx.pages(F.col("a"), F.col("b"))).collect()] == [[1, 2, 3], [5], [4], [7], []]


@pytest.mark.parametrize(("text", "number", "kind"), [("1 DO OBJETO", "1", "section"), ("5.2.1 Em recuperacao judicial;", "5.2.1", "subsection"), ("1.2.3.4 Texto", "1.2.3.4", None), ("10/12/2024 publicado", None, None), ("10h30 reuniao", None, None), ("12 % do total", None, None), ("ANEXO I Termo", None, "section"), ("CAPÍTULO II", None, "section"), ("2)Texto", None, None), ("3. 44", None, None)])
def test_clauses(spark, text, number, kind):
    assert one(spark, hd.clause_number(F.col("t")), t=text) == number
    assert one(spark, hd.heading_kind(F.col("t")), t=text) == kind


def test_clause_path_and_scores(spark):
    df = spark.createDataFrame([("ANEXO I", ""), ("1 DO OBJETO", "title"), ("texto comum.", ""), ("1.2.3 itens;", "")], "t string, l string")
    assert [r[0] for r in df.select(hd.heading_score(F.col("l"), F.col("t"))).collect()] == [5, 8, -2, -4]


# ---- blocks and sections

BLOCKS = "document_id string, sequence_no int, page_no int, page_total int, label string, text string"


def test_repeated_header(spark):
    rows = [("d", i, i + 1, 4, "text", "Repeated banner") for i in range(3)] + [("d", 9, 4, 4, "text", "Body"), ("e", 1, 1, 2, "text", "x"), ("e", 2, 2, 2, "text", "x")]
    out = bl.normalized(spark.createDataFrame(rows, BLOCKS))
    assert {(r["text"], r["repeated"]) for r in out.collect()} == {("Repeated banner", True), ("Body", False), ("x", False)}
    assert out.where("repeated").head()["repetition_ratio"] == 0.75
    assert [r["warning"] for r in bl.repeated_warnings(out).collect()] == ["Repeated header/footer candidate: Repeated banner"]


def test_cover_then_body(spark):
    lines = ["PODER EXECUTIVO", "SECRETARIA DE ESTADO", "EDITAL 123/2026", "1 DO OBJETO", "Texto", "1.1 Escopo do documento", "Mais", "2 DO PRAZO", "Fim"]
    out = bl.with_sections(bl.normalized(spark.createDataFrame([("d", i, 1, 1, "text", t) for i, t in enumerate(lines)], BLOCKS))).orderBy("sequence_no").collect()
    assert [r["section_title"] for r in out] == ["front_matter"] * 3 + ["1 DO OBJETO"] * 4 + ["2 DO PRAZO"] * 2
    assert [r["subsection_title"] for r in out] == [None] * 5 + ["1.1 Escopo do documento"] * 2 + [None] * 2
    assert out[6]["clause_path"] == ["1", "1.1"] and out[0]["is_front_matter"] and not out[3]["is_front_matter"]


def test_table_stats(spark):
    row = one(spark, bl.table_stats(F.col("t")), t="| a | b |\n|---|---|\n| 1 |")
    assert (row["rows"], row["columns"], row["quality"], row["reasons"]) == (3, 2, "medium", ["inconsistent_column_count"])
    assert one(spark, bl.table_stats(F.col("t")), t="no table")["quality"] == "medium"


# ---- chunks

def chunked(spark, texts, config=ch.ChunkConfig(), kinds=None):
    rows = [("d", i, 1, 1, (kinds or {}).get(i, "text"), t) for i, t in enumerate(texts)]
    blocks = bl.with_sections(bl.normalized(spark.createDataFrame(rows, BLOCKS)))
    return blocks, ch.built(blocks, config).orderBy("chunk_no")


def test_hard_split(spark):
    _, out = chunked(spark, ["x" * 95], ch.ChunkConfig(max_chunk_chars=30))
    out = out.collect()
    assert [len(r["text"]) for r in out] == [30, 30, 30, 5] and [r["split_index"] for r in out] == [1, 2, 3, 4]
    assert [(s["block_start_char"], s["block_end_char"]) for r in out for s in r["source_spans"]] == [(0, 30), (30, 60), (60, 90), (90, 95)]
    assert [r["starts_mid_sentence"] for r in out] == [True] * 4 and out[1]["hard_split"]


def test_merge_and_sentences(spark):
    _, out = chunked(spark, ["Small A.", "Small B."])
    row = out.collect()[0]
    assert row["text"] == "Small A.\n\nSmall B." and [(s["chunk_start_char"], s["chunk_end_char"], s["separator_before"]) for s in row["source_spans"]] == [(0, 8, None), (10, 18, "\n\n")]
    _, out = chunked(spark, ["Primeira sentenca completa. Segunda sentenca completa aq."], ch.ChunkConfig(max_chunk_chars=30))
    assert [(r["text"], r["split_strategy"], r["hard_split"]) for r in out.collect()] == [("Primeira sentenca completa.", "original", False), ("Segunda sentenca completa aq.", "sentence", False)]
    assert ch.split_pieces("ABCDEFGHIJ , continuation", 11)[0][2] == "ABCDEFGHIJ ,"
    assert [p[2] for p in ch.split_pieces("abcdefghijklmnopqrstuvwxyz", 10)] == ["abcdefghij", "klmnopqrst", "uvwxyz"]


def test_groups_against_a_plain_fold(spark):
    rng = random.Random(4)
    texts = [("%d " % i if i % 13 == 5 else "") + "w" * rng.randrange(1, 300) for i in range(120)]
    config = ch.ChunkConfig(max_chunk_chars=500, min_chunk_chars=150, merge_small=False)
    blocks, out = chunked(spark, texts, config, {7: "table", 40: "table"})
    kinds = {r["sequence_no"]: (r["content_type"], r["section_path"]) for r in blocks.collect()}
    want, now = [], []
    for i, t in enumerate(texts):
        numbered = bool(re.match(r"\d+ \w", t))
        if kinds[i][0] in ("table", "title"):
            want += [now] * bool(now) + [[i]]
            now = []
            continue
        if now and (kinds[now[-1]][1] != kinds[i][1] or numbered or len("\n\n".join(texts[j] for j in [*now, i])) > 500):
            want.append(now)
            now = []
        now.append(i)
    want += [now] * bool(now)
    assert [r["text"] for r in out.collect()] == ["\n\n".join(texts[i] for i in g) for g in want]


def test_rebuild_is_lossless(spark):
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9))) + rng.choice(["", ".", ","]) for _ in range(rng.randrange(1, 120))) for _ in range(40)]
    blocks, out = chunked(spark, texts, ch.ChunkConfig(max_chunk_chars=200, min_chunk_chars=80))
    assert out.count() > 40 and not ch.rebuilt(out, blocks).where("NOT rebuildable").count()
    report = rp.report(blocks, out, ch.rebuilt(out, blocks)).head()
    assert report["chunks_not_rebuildable_from_spans"] == 0 and report["chunks_split"] > 0 and any("split operation" in w for w in report["warnings"])


# ---- hierarchy

def test_semantic_ranges_cover_the_text():
    rng = random.Random(6)
    for _ in range(60):
        text = "".join(rng.choice(["word ", "longer-word ", "end. ", "\n\n", "\n- item ", "x" * 40 + " "]) for _ in range(rng.randrange(1, 80))).strip()
        got = hi.semantic_ranges(text, 60, 100)
        assert all(a < b for a, b in got) and all(x[1] <= y[0] for x, y in zip(got, got[1:]))
        assert re.sub(r"\s", "", "".join(text[a:b] for a, b in got)) == re.sub(r"\s", "", text)
        assert all(b - a <= 100 or " " not in text[a:b] for a, b in got)


def test_table_rows_keep_their_header():
    table = "| a | b |\n|---|---|\n" + "\n".join(f"| {i} | {'v' * 20} |" for i in range(12))
    parts = [hi.group_text(table, g) for g in hi.table_groups(table, 120)]
    assert len(parts) > 2 and all(p.startswith("| a | b |\n|---|---|\n|") and len(p) <= 120 for p in parts)
    assert [x for p in parts for x in p.split("\n")[2:]] == table.split("\n")[2:]
    assert hi.table_groups("short", 120) == [[(0, 5)]] and hi.table_groups("no pipes\n" * 30, 50) == [[(0, 270)]]


def test_index_filter(spark):
    rows = [("child", "x", None, []), ("parent", "x", None, []), (None, "x", None, []), (None, "x", "s", []), (None, "x", None, ["b"]), ("child", " ", "s", [])]
    out = hi.indexable(spark.createDataFrame(rows, "chunk_type string, content string, source_chunk_id string, source_block_ids array<string>"))
    assert sorted((r["chunk_type"] or "", r["source_chunk_id"] or "") for r in out.collect()) == [("", ""), ("", "s"), ("child", "")]


# ---- retrieval

def results(spark, rows):
    return spark.createDataFrame([("q", *r) for r in rows], "query_id string, chunk_id string, score double, rank int")


def test_rrf(spark):
    d, s = results(spark, [("c1", 0.9, 1), ("c2", 0.8, 2)]), results(spark, [("c2", 7.0, 1), ("c3", 6.0, 2)])
    out = rt.fused(d, s).orderBy("rank").collect()
    assert [r["chunk_id"] for r in out] == ["c2", "c1", "c3"] and out[0]["score"] == 1 / 62 + 1 / 61 and out[0]["representative"] == "sparse"
    w = rt.fused(results(spark, [("c", 1.0, 1)]), results(spark, [("c", 10.0, 1)]), "weighted", dense_weight=0.2, sparse_weight=0.1).head()
    assert w["score"] == 1.2
    with pytest.raises(ValueError):
        rt.fused(d, s, "other")
    assert rt.fused(d, s, k=0).count() == 0


def test_dense_ties_threshold_and_guards(spark):
    v = spark.createDataFrame([(str(i), i, e) for i, e in enumerate([[1.0, 0.0], [2.0, 0.0], [0.0, 1.0], [0.0, 0.0], [1.0], [-1.0, 0.0]])], "chunk_id string, ord long, embedding array<double>")
    q = spark.createDataFrame([("a", [3.0, 0.0]), ("z", [0.0, 0.0])], "query_id string, embedding array<double>")
    got = [(r["query_id"], r["chunk_id"], r["score"]) for r in rt.dense(q, v, 3).orderBy("query_id", "rank").collect()]
    assert got == [("a", "0", 1.0), ("a", "1", 1.0), ("a", "2", 0.0), ("z", "0", 0.0), ("z", "1", 0.0), ("z", "2", 0.0)]
    assert rt.dense(q, v, None, 0.5).count() == 2 and rt.dense(q, v, 0).count() == 0 and rt.dense(q, v, None, None).count() == 12
    assert rt.dense(q.limit(0), v).count() == 0 and rt.dense(q, v.limit(0)).count() == 0


def test_case_folding_and_accents_of_every_character(spark):
    import unicodedata

    known = [c for c in map(chr, (*range(0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x110000))) if unicodedata.category(c) != "Cn" and not c.isspace()]
    texts = ["x" + "y".join(known[i : i + 500]) + "x" for i in range(0, len(known), 500)]
    df = spark.createDataFrame([(t,) for t in [*texts, "STRASSE Straße ΟΔΥΣΣΕΥΣ ﬃ", "Não é ﬁm Å", None]], "t string").select("t", tx.folded(F.col("t")).alias("f"), an.bare(F.col("t")).alias("b"))
    for r in df.collect():
        t = r["t"] or ""
        assert r["f"] == t.casefold()
        assert r["b"] == "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower()


def test_scores_are_ranked_by_their_full_value(spark):
    near = [(str(i), i, [1.0, (40 - i) * 1e-6]) for i in range(40)] + [("same", 40, [2.0, 2e-6])]  # cosines differ by less than 1e-9
    v = spark.createDataFrame(near, "chunk_id string, ord long, embedding array<double>").repartition(4)
    q = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    got = [r["chunk_id"] for r in rt.dense(q, v, 5).orderBy("rank").collect()]
    assert got == ["39", "same", "38", "37", "36"]
    rng = np.random.default_rng(3)
    vectors = [list(map(float, x)) for x in rng.normal(size=(60, 33))]
    vectors += vectors[:20]
    v = spark.createDataFrame([(str(i), i, x) for i, x in enumerate(vectors)], "chunk_id string, ord long, embedding array<double>").repartition(7)
    q = spark.createDataFrame([(str(i), x) for i, x in enumerate(vectors[:9])], "query_id string, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["chunk_id"], r["score"]) for r in rt.dense(q, v, 12, None).collect()}

    def cosine(a, b):  # in order, without a compensated sum
        dot = na = nb = 0.0
        for x, y in zip(a, b, strict=True):
            dot, na, nb = dot + x * y, na + x * x, nb + y * y
        return dot / (math.sqrt(na) * math.sqrt(nb))

    for i, x in enumerate(vectors[:9]):
        want = sorted(((-cosine(x, y), j) for j, y in enumerate(vectors)))[:12]
        assert [got[str(i), r + 1] for r in range(12)] == [(str(j), -s) for s, j in want]


def test_bm25_guards(spark):
    c = spark.createDataFrame([("a", "prazo do contrato"), ("b", ""), ("c", None), ("d", "outra coisa")], "chunk_id string, content string")
    q = spark.createDataFrame([("q", "Prazo prazo PRAZO"), ("n", "")], "query_id string, question string")
    assert [(r["query_id"], r["chunk_id"]) for r in rt.bm25(q, c).collect()] == [("q", "a")]
    with pytest.raises(ValueError):
        rt.bm25(q, c, k1=0)
    with pytest.raises(ValueError):
        rt.bm25(q, c, b=2)


def test_ranking_plan_limits_groups_before_the_shuffle(spark):
    q = spark.createDataFrame([("q", "a b")], "query_id string, question string")
    plan = rt.bm25(q, spark.createDataFrame([("c", "a")], "chunk_id string, content string"))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan


def test_rerank(spark):
    r = results(spark, [("c1", 0.9, 1), ("c2", 0.8, 2), ("c3", 0.7, 3)])
    q = spark.createDataFrame([("q", "a b")], "query_id string, question string")
    c = spark.createDataFrame([("c1", "x"), ("c2", "a a b"), ("c3", "b")], "chunk_id string, content string")
    out = rt.rerank_overlap(r, q, c).orderBy("rank").collect()
    assert [(x["chunk_id"], x["rerank_score"], x["score"]) for x in out] == [("c2", 3.0, 0.8), ("c3", 1.0, 0.7), ("c1", 0.0, 0.9)]
    given = spark.createDataFrame([("c3", 9.0)], "chunk_id string, score double")
    assert [x["chunk_id"] for x in rt.rerank_overlap(r, q, c, 2, given).orderBy("rank").collect()] == ["c3", "c2"]
    assert [x["chunk_id"] for x in rt.rerank_model(r, q, c, lambda: lambda a, b: [len(t) for t in b], "len").orderBy("rank").collect()] == ["c2", "c1", "c3"]
    assert [x["rank"] for x in rt.rerank_identity(r, 2).collect()] == [1, 2]


def test_evaluation_numbers(spark):
    cases = spark.createDataFrame([(n, "?", [n], None) for n in "abc"], "case_id string, question string, expected_source_ids array<string>, expected_chunk_ids array<string>")
    found = [(n, str(i), n if i == hit else "x", i) for n, hit in zip("abc", (1, 3, 5)) for i in range(1, 6)]
    r = spark.createDataFrame(found, "query_id string, chunk_id string, source_chunk_id string, rank int")
    m = ev.cases_metrics(ev.validate_cases(cases), r, ev.validate_top_k(5))
    s = ev.summary(m).head()
    assert (round(s["top1_hit"], 6), round(s["top3_hit"], 6), s["top5_hit"], round(s["mrr"], 4)) == (0.333333, 0.666667, 1.0, 0.5111)
    assert ev.diagnostics(m).head().asDict() == {"questions": 3, "with_hit": 3, "without_hit": 0, "by_source": 3, "only_via_chunk_id": 0, "late_hit": 2}
    keys = spark.createDataFrame([("a", 10), ("b", 2), ("b", 2)], "query_id string, key int")
    assert [(x["key"], x["hits"]) for x in ev.buckets(m, keys).collect()] == [("10", 1), ("2", 1)]
    assert ev.summary(m.limit(0)).head()["mrr"] == 0.0
    with pytest.raises(ValueError):
        ev.validate_top_k(4)
    with pytest.raises(ValueError):
        ev.validate_cases(cases.withColumn("expected_source_ids", F.lit(None).cast("array<string>")))


# ---- answers

def test_answers_and_groundedness(spark):
    q = spark.createDataFrame([("q", "Qual o prazo?"), ("w", "Fraco?"), ("n", "Nada?")], "query_id string, question string")
    r = spark.createDataFrame([("q", 1, 0.9, "c1", "p1", 1, 2, ["S"], "t" * 3000), ("w", 1, 0.1, "c2", "p2", 1, 1, ["S"], "x")], "query_id string, rank int, score double, chunk_id string, source_chunk_id string, page_start int, page_end int, section_path array<string>, content string")
    calls = spark.sparkContext.accumulator(0)

    def generate(ps):
        calls.add(len(ps))
        return ["Veja [c1] e [c9]." for _ in ps]

    out = {x["query_id"]: x for x in an.answered(q, r, generate, threshold=0.5).collect()}
    assert calls.value == 1 and out["q"]["answer"] == "Veja [c1] e ." and "[trecho truncado]" in out["q"]["prompt"]
    assert out["w"]["insufficient_evidence"] and out["n"]["answer"] == an.REFUSAL
    rows = [("a", "Resposta [c1].", False, out["q"]["prompt"], ["c1"], ["c1"]), ("b", "Veja [c999] e chunk_999.", False, None, ["c1"], ["c1"]), ("c", "", False, None, [], []), ("d", an.REFUSAL.upper(), True, None, [], []), ("e", "Sim [c1]", False, None, ["c1"], ["c2"])]
    got = {x["query_id"]: x for x in an.validated(spark.createDataFrame(rows, "query_id string, answer string, insufficient_evidence boolean, prompt string, context_ids array<string>, citation_ids array<string>")).collect()}
    assert got["a"]["valid"] and all(got["a"]["checks"])
    assert got["b"]["unknown_citations"] == ["c999", "chunk_999"] and got["b"]["errors"] == ["answer_mentions_unknown_chunk"]
    assert got["c"]["errors"] == ["answer_empty", "used_context_empty_without_insufficient_evidence"]
    assert got["d"]["valid"] and got["e"]["citations_outside_context"] == ["c2"]


# ---- assets

def test_figures(spark):
    rows = [("f1", 1, 1, "figure", "", None), ("t1", 2, 1, "paragraph", "", 1), ("f2", 3, 1, "figure", "", None), ("c2", 4, 1, "caption", "", 2), ("f3", 5, 1, "figure", "", None), ("t3", 6, 2, "paragraph", "", 3), ("f4", 7, 2, "figure", "", None)]
    b = spark.createDataFrame([("d", *r) for r in rows], "document_id string, block_id string, sequence_no int, page_no int, content_type string, label string, group_no int")
    b = b.withColumns({"section_path": F.array(F.lit("S")), "bbox": F.expr("CAST(NULL AS struct<x0:double,y0:double,x1:double,y1:double>)"), "asset_id": F.col("block_id"), "asset_uri": F.col("block_id"), "asset_type": F.lit("image")})
    got = {r["block_id"]: (r["reason_code"], r["link_score"], r["target_block_id"]) for r in at.linked(b, at.decorative(b)).collect()}
    assert got == {"f1": ("same_page_nearest_text", 0.75, "t1"), "f2": ("caption_detected", 1.0, "c2"), "f3": ("different_page", None, None), "f4": ("no_posterior_text_candidate", None, None)}
    box = lambda *v: F.struct(*(F.lit(float(x)).alias(n) for x, n in zip(v, ("x0", "y0", "x1", "y1"))))
    logo = b.withColumn("bbox", F.when(F.col("block_id").isin("f1", "f4"), box(474, 824, 558, 806)))
    assert {r["block_id"]: r["reason"] for r in at.decorative(logo).collect() if r["reason"]} == {"f1": "decorative_repeated_header", "f4": "decorative_repeated_header"}
    alone = b.withColumn("bbox", F.when(F.col("block_id") == "f1", box(474, 824, 558, 806)))
    assert {r["block_id"]: r["reason"] for r in at.decorative(alone).collect() if r["reason"]} == {"f1": "decorative_small_logo"}


def test_assets_of_blocks_and_chunks(spark):
    link = "struct<sequence_no:int,asset_id:string,asset_uri:string,asset_type:string,link_strategy:string,decision:string,target_block_id:string>"
    rows = [[(1, "a", "u", "image", "x", "linked", "b1"), (2, "a", "u", "image", "x", "linked", "b2"), (3, "c", "v", "image", "x", "linked", "b2"), (4, "d", "w", "image", "not_linked", "not_linked", None), (5, "e", "w", "image", "x", "linked", None)]]
    table = spark.createDataFrame([(r,) for r in rows], f"assets array<{link}>")
    names = lambda ids, need: table.select(at.for_blocks(F.col("assets"), F.array(*map(F.lit, ids)).cast("array<string>"), need).alias("x")).select(F.transform("x.assets", lambda a: a["asset_id"]), "x.skipped").head()
    assert tuple(names(["b1"], True)) == (["a"], True) and tuple(names(["b2"], True)) == (["c"], True)
    assert tuple(names([], False)) == (["a", "c", "e"], False) and tuple(names([], True)) == ([], True)
    rows = [(1, "section_header", "1 Objeto", None), (2, "picture", "", "f1"), (3, "text", "O texto que segue a figura.", None), (4, "picture", "", "f2")]
    b = spark.createDataFrame([("d", i, 1, 1, label, t, a, a and f"images/{a}", a and "image") for i, label, t, a in rows], "document_id string, sequence_no int, page_no int, page_total int, label string, text string, asset_id string, asset_uri string, asset_type string")
    out = parsing.process(b, ch.ChunkConfig(merge_small=False), source_name=F.lit("s.pdf"))
    assert [[a["asset_id"] for a in r["related_assets"]] for r in out.chunks.orderBy("chunk_no").collect()] == [[], ["f1"]]
    report = out.report.head()
    assert set(rp.FIELDS) <= set(report.asDict()) and report["source_name"] == "s.pdf"
    assert (report["assets_saved_total"], report["assets_linked_total"], report["assets_unlinked_total"], report["figures_unlinked"], report["assets_by_type"]) == (2, 1, 1, 1, {"image": 2})
    assert "1 figure asset(s) could not be safely linked." in report["warnings"]


def test_looks_of_headings(spark):
    look = lambda **v: one(spark, hd.visual_evidence({c: F.lit(v.get(c)) for c in ("label", "content_type", *hd.VISUAL)}, F.col("t")), t="Some heading")
    assert look(strong=True, font_weight=700.0, spacing_before=2.0) and look(role="heading", font_size_rank="large", bold=True)
    assert not look(strong=True, bold=True, is_bold=True) and not look(font_weight=500.0, spacing_before=0.0, role="body", font_size_rank="small")


# ---- sources and sinks

def test_foreign_results(spark, tmp_path):
    import dataclasses
    import pathlib

    @dataclasses.dataclass
    class Box:
        x: int
        where: pathlib.Path

    assert rd.plain_value({1: Box(2, pathlib.Path("a/b")), "s": {3}, "n": None, "t": (1.5, "x")}) == {"1": {"x": 2, "where": "a/b"}, "s": [3], "n": None, "t": [1.5, "x"]}

    class Result:
        def broken(self):
            raise RuntimeError("no")

        def works(self):
            return {"a": 1}

    assert rd.first_export(Result(), ["absent", "broken", "works"]) == ({"a": 1}, "works", ["broken failed: no"])
    assert rd.first_export(Result(), ["absent"]) == (None, None, [])
    assert rd.default_input_path(spark, str(tmp_path)).endswith("parsed_sections.jsonl")
    (tmp_path / "rag_chunks.jsonl").write_text("{}")
    assert rd.default_input_path(spark, str(tmp_path)).endswith("rag_chunks.jsonl")


def test_dataset_validation():
    good = {"schema_version": "1", "name": "n", "cases": [{"id": "a", "question": "q", "expected": {"chunk_ids": ["c"]}}]}
    assert ev.validate_dataset(good) is good
    for bad in ({}, {**good, "cases": {}}, {**good, "cases": ["x"]}, {**good, "cases": [{"id": "a", "question": "q"}]}, {**good, "cases": [{"id": "a", "question": "q", "expected": []}]}, {**good, "cases": [{"id": "a", "question": "q", "expected": {"pages": [1]}}]}):
        with pytest.raises(ValueError):
            ev.validate_dataset(bad)


def test_sources(spark, tmp_path):
    page = "<html><script>x</script><h1>Title</h1><p>One  two</p><ul><li>item</li></ul><table><tr><td>a</td><td>b</td></tr></table><img src=u alt=z></html>"
    got = rd.html_blocks(spark.createDataFrame([(1, page), (2, None)], "page_id long, html string")).orderBy("sequence_no").collect()
    assert [(r["label"], r["text"]) for r in got] == [("section_header", "Title"), ("text", "One two"), ("list_item", "item"), ("table", "a | b"), ("picture", "")]
    reg = rd.default_registry()
    assert reg.list() == ["html", "json", "markdown"]
    with pytest.raises(KeyError):
        reg.get("pdf")
    with pytest.raises(ValueError):
        reg.register(" ", None)
    with pytest.raises(ValueError):
        rd.engine("tpu")
    md = reg.get("markdown")(spark.createDataFrame([("d", "# 1 DO OBJETO\n\nTexto do objeto.")], "document_id string, markdown string")).collect()
    assert [(r["label"], r["text"]) for r in md] == [("section_header", "1 DO OBJETO"), ("text", "Texto do objeto.")]
    (tmp_path / "x.jsonl").write_text('{"chunk_type": "child", "content": "a"}\n\n{"chunk_type": null, "content": "b"}\n')
    records = rd.json_lines(spark, str(tmp_path / "x.jsonl"))
    assert records.count() == 2 and rd.is_hierarchical(records)
    (tmp_path / "i.json").write_text('{"embedding_model": "m", "items": [{"chunk_id": "c", "embedding": [1, 2]}]}')
    item = rd.vector_index(spark, str(tmp_path / "i.json")).head()
    assert (item["schema_version"], item["content"], item["embedding"]) == ("1.0", "", [1.0, 2.0])
    blocks, name = rd.first_of(("a", F.expr(f"CAST(array() AS {rd.BLOCK_FIELDS})")), ("b", rd.markdown_blocks(F.lit("x"))))
    assert spark.range(1).select(name.alias("n"), F.size(blocks).alias("s")).head() == ("b", 1)
    assert bytes(spark.range(1).select(rd.data_uri_bytes(F.lit("data:image/png;base64,aGVsbG8=")).alias("b")).head()[0]) == b"hello"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("d", 1, 2, "b", ["S"], "texto")], "document_id string, sequence_no int, page_no int, block_id string, section_path array<string>, text string")
    wr.markdown(df, str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m")).head()[0] == "<!-- page_no=2 block_id=b section_path=S -->"
    wr.json_lines(df.withColumn("n", F.lit(None).cast("string")), str(tmp_path / "j"))
    assert '"n":null' in spark.read.text(str(tmp_path / "j")).head()[0]
    assert spark.range(1).select(wr.preview(F.lit("a " * 600)).alias("p")).head()[0].endswith("a...")
