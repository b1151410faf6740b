"""The command line from chunks to an index, a search and an evaluation."""

import json

import pytest

from stratadoc import cli


def test_flow(spark, tmp_path, capsys, monkeypatch):
    span = lambda n: [{"block_id": "b", "block_start_char": 0, "block_end_char": n, "chunk_start_char": 0, "chunk_end_char": n}]
    texts = {"objeto": "O objeto do contrato", "prazo": "O prazo da entrega", "valor": "O valor total"}
    rows = [{"document_id": "d", "chunk_id": k, "chunk_no": i, "text": t, "content_type": "paragraph", "section_path": [k], "section_title": k, "subsection_title": None, "clause_number": str(i), "page_start": i, "page_end": i, "source_block_ids": ["b"], "source_spans": span(len(t))} for i, (k, t) in enumerate(texts.items(), 1)]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, rows)))
    # subsection_title is null in every row, so JSON inference needs one row that has it
    rows[0]["subsection_title"] = "s"
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, rows)))
    cli.main(["index", "--input", str(tmp_path / "in.jsonl"), "--index", str(tmp_path / "index")])
    cli.main(["query", "--index", str(tmp_path / "index"), "--question", "Qual o prazo?", "--top-k", "1"])
    assert "section=prazo" in capsys.readouterr().out
    cases = [{"id": k, "question": t, "expected": {"source_chunk_ids": [k]}} for k, t in texts.items()]
    (tmp_path / "cases.json").write_text(json.dumps({"name": "n", "cases": cases}))
    cli.main(["evaluate", "--index", str(tmp_path / "index"), "--dataset", str(tmp_path / "cases.json"), "--top-k", "5"])
    assert json.loads(capsys.readouterr().out)["top1_hit"] == 1.0
    cli.main(["evaluate", "--index", str(tmp_path / "index"), "--dataset", str(tmp_path / "cases.json"), "--top-k", "5", "--retriever", "hybrid", "--reranker", "overlap"])
    assert json.loads(capsys.readouterr().out)["mrr"] == 1.0
    with pytest.raises(ValueError):
        cli.main(["evaluate", "--index", "missing", "--dataset", "missing", "--top-k", "3"])
    monkeypatch.setenv("TOP_K", "7")
    assert cli.Settings.from_env().top_k == 7 and cli.Settings.from_env().similarity_threshold == 0.0
    monkeypatch.setenv("RAG_INCLUDE_SECTION_CONTEXT", "off")
    assert not cli.config_from_env().section_context


def test_parse_and_chunk(spark, tmp_path):
    page = "<h1>1 Objeto</h1><p>" + "Texto do contrato. " * 30 + "</p><h1>2 Prazo</h1><p>O prazo termina.</p>"
    (tmp_path / "pages.jsonl").write_text(json.dumps({"page_id": "p", "html": page}))
    cli.main(["parse", "--input", str(tmp_path / "pages.jsonl"), "--output", str(tmp_path / "out"), "--parser", "html"])
    report = spark.read.json(f"{tmp_path}/out/report").head()
    assert report["total_blocks"] == 4 and report["parser_name"] == "html" and report["chunks_not_rebuildable_from_spans"] == 0
    chunks = spark.read.json(f"{tmp_path}/out/chunks")
    assert chunks.where("text LIKE '%prazo termina%'").head()["section_path"] == ["2 Prazo"]
