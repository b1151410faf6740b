"""Citations, grounded answers and their validation, for all questions at once.

Results are (query_id, rank, score, chunk_id, source_chunk_id, page_start, page_end, section_path, content).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx

#: Fixed texts of answers and prompts.
REFUSAL = "Não encontrei evidência suficiente nos trechos recuperados."
PROMPT_HEAD = (
    "Você é um gerador de respostas RAG auditável.\nResponda somente usando os trechos fornecidos.\nNão use conhecimento externo.\n"
    'Se os trechos não contiverem evidência suficiente, responda: "{}"\nSempre cite os chunk_ids usados.\nCite apenas fontes fornecidas no contexto recuperado.\n\n'
)
GROUNDING_WORDS = ("somente usando", "apenas usando", "nao use conhecimento externo", "cite apenas fontes", "fontes fornecidas", "contexto recuperado")
REFUSAL_WORDS = ("evidencia suficiente", "nao encontrei evidencia suficiente", "recuse", "nao responda")
REFERENCE = r"(?i)(?<![\w-])(chunk[_-]?[A-Za-z0-9_-]+|c\d+[A-Za-z0-9_-]*)(?![\w-])"


def bare(text: Column) -> Column:
    """Lower case without accents or combining marks."""
    return tx.bare(F.coalesce(text, F.lit("")))


def citations(results: DataFrame) -> DataFrame:
    return results.select("query_id", "rank", "chunk_id", "source_chunk_id", tx.pages(F.col("page_start"), F.col("page_end")).alias("pages"), "page_start", "page_end", "section_path", "score")


def context_block(rank: Column, score: Column, chunk_id: Column, source: Column, start: Column, end: Column, path: Column, content: Column) -> Column:
    text = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    return F.concat(
        F.lit("[rank "), rank, F.lit("]\nscore: "), text(score), F.lit("\nchunk_id: "), chunk_id, F.lit("\nsource_chunk_id: "), text(source),
        F.lit("\npages: "), text(start), F.lit("-"), text(end), F.lit("\nsection_path: "), F.to_json(F.coalesce(path, F.array().cast("array<string>"))), F.lit("\ncontent:\n"), content,
    )


def prompts(questions: DataFrame, results: DataFrame, limit: int = tx.CONTEXT_CHARS, refusal: str = REFUSAL) -> DataFrame:
    """(query_id, question, prompt, context_ids, context_count) of questions that have results; results are a top k."""
    c = F.col
    block = context_block(c("rank"), c("score"), c("chunk_id").cast("string"), c("source_chunk_id"), c("page_start"), c("page_end"), c("section_path"), tx.truncated(F.coalesce("content", F.lit("")), limit))
    own = results.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", block.alias("b"), c("chunk_id").cast("string").alias("id")))).alias("x"))
    prompt = F.concat(F.lit(PROMPT_HEAD.format(refusal) + "Pergunta do usuário:\n"), "question", F.lit("\n\nContexto recuperado:\n"), F.array_join(F.transform("x", lambda v: v["b"]), "\n\n"), F.lit("\n\nResposta final:"))
    return questions.join(own, "query_id").select("query_id", "question", prompt.alias("prompt"), F.transform("x", lambda v: v["id"]).alias("context_ids"), F.size("x").alias("context_count"))


def without_unknown(text: Column, valid: Column) -> Column:
    """Drops bracketed references (and ``(chunk_id: x)``) to anything but valid ids; double spaces close up."""
    named = lambda r: F.regexp_replace(F.trim(r), r"(?i)^chunk_id:\s*|^chunk:\s*", "")
    brackets = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(\[[^\[\]]+\])"), F.lit(1))), lambda r: ~F.array_contains(valid, F.trim(named(F.substring(r, F.lit(2), F.length(r) - 2)))))
    rounds = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?i)(\(chunk_id:\s*[^)]+\))"), F.lit(1))), lambda r: ~F.array_contains(valid, F.trim(F.regexp_extract(r, r"(?i)\(chunk_id:\s*([^)]+)\)", 1))))
    clean = F.aggregate(F.concat(brackets, rounds), text, lambda t, r: F.replace(t, r, F.lit("")))
    return F.when(F.size(valid) > 0, F.trim(F.regexp_replace(clean, " {2,}", " "))).otherwise(text)


def first_reference(prompt: Column) -> Column:
    return F.regexp_extract(prompt, r"(?m)^chunk_id:\s*(\S+)", 1)


def fixed_answer(prompt: Column) -> Column:
    """The deterministic provider: cites the first chunk of the prompt, refuses without one."""
    first = first_reference(prompt)
    return F.when(first == "", REFUSAL).otherwise(F.concat(F.lit("Resposta baseada nos trechos recuperados. ["), first, F.lit("]")))


def answered(questions: DataFrame, results: DataFrame, generate=None, model: str = "fake", threshold: float | None = None, refusal: str = REFUSAL, limit: int = tx.CONTEXT_CHARS) -> DataFrame:
    """One answer a question.  Questions without results, or with all scores below the threshold, are refused without
    the model: they are split off before it runs.  ``generate`` takes a list of prompts (once for each Arrow batch)."""
    best = results.groupBy("query_id").agg(F.max(F.coalesce("score", F.lit(0.0))).alias("best"))
    known = questions.join(best, "query_id", "left")
    enough = F.col("best").isNotNull() & (F.lit(threshold is None) | (F.col("best") >= F.lit(threshold or 0.0)))
    ask = prompts(known.where(enough).select("query_id", "question"), results, limit, refusal)
    if generate is None:
        raw = ask.withColumn("raw", fixed_answer(F.col("prompt")))
    else:

        def run(batches):
            for batch in batches:
                yield batch.append_column("raw", pa.array(generate(batch.column("prompt").to_pylist()), pa.string()))

        raw = ask.mapInArrow(run, T.StructType([*ask.schema.fields, T.StructField("raw", T.StringType())]))
    done = raw.withColumn("answer", without_unknown(F.col("raw"), F.col("context_ids"))).select("query_id", "question", "answer", (F.trim("answer") == refusal).alias("insufficient_evidence"), "context_ids", "context_count", "prompt", F.lit(model).alias("model"))
    refused = known.where(~enough).select("query_id", "question", F.lit(refusal).alias("answer"), F.lit(True).alias("insufficient_evidence"), F.array().cast("array<string>").alias("context_ids"), F.lit(0).alias("context_count"), F.lit(None).cast("string").alias("prompt"), F.lit(model).alias("model"))
    return done.unionByName(refused)


def unknown_references(answer: Column, valid: Column) -> Column:
    found = F.regexp_extract_all(answer, F.lit(REFERENCE), F.lit(1))
    return F.array_sort(F.array_except(F.array_distinct(found), valid))


def validated(answers: DataFrame, refusal: str = REFUSAL) -> DataFrame:
    """Checks, errors and warnings of answers (query_id, answer, insufficient_evidence, prompt, context_ids, citation_ids)."""
    none = F.array().cast("array<string>")
    answers = answers.withColumns({"__answer": bare(F.col("answer")), "__prompt": bare(F.col("prompt"))})  # once, as many checks read them
    context, cited = F.filter(F.coalesce("context_ids", none), lambda x: F.coalesce(x, F.lit("")) != ""), F.filter(F.coalesce("citation_ids", none), lambda x: F.coalesce(x, F.lit("")) != "")
    answer, refuses = F.coalesce("answer", F.lit("")), F.col("__answer").contains(bare(F.lit(refusal)))
    weak = F.coalesce("insufficient_evidence", F.lit(False))
    outside = F.array_sort(F.array_except(cited, context))
    unknown = unknown_references(answer, F.array_union(context, cited))
    has_prompt = F.trim(F.coalesce("prompt", F.lit(""))) != ""
    b = F.col("__prompt")
    says = lambda words: F.lit(False) if not words else b.contains(words[0]) | says(words[1:])
    page = F.col("prompt").rlike(r"(?iU)\bpages?\s*:\s*\d+") | F.col("prompt").rlike(r"(?i)\bpage_(?:start|end)\b") | b.contains("pagina")
    prompt_checks = {
        "prompt_contains_grounding": says(GROUNDING_WORDS) & says(REFUSAL_WORDS),
        "prompt_contains_context": b.contains("contexto") & b.contains("pergunta"),
        "prompt_contains_chunk_ids": F.col("prompt").rlike(r"(?iU)\bchunk_id\s*:\s*\S+"),
        "prompt_contains_pages": page,
        "prompt_contains_sections": F.col("prompt").rlike(r"(?iU)\bsection_path\s*:") | b.contains("secao") | b.contains("secoes"),
    }
    lost = F.size(F.coalesce("context_ids", none)) > F.size(context)
    uncited = F.size(F.coalesce("citation_ids", none)) > F.size(cited)
    required = ~weak & (F.size(context) > 0) & (F.size(F.coalesce("citation_ids", none)) == 0)
    empty = ~weak & (F.size(context) == 0)
    consistent = F.when(weak, (F.size(cited) == 0) & refuses).otherwise(~refuses)
    checks = {"has_answer": F.trim(answer) != "", "citations_exist": ~uncited & ~required, "citations_in_used_context": F.size(outside) == 0, "used_context_consistent": ~lost & ~empty, "insufficient_evidence_consistent": consistent}
    checks |= {k: has_prompt & F.coalesce(v, F.lit(False)) for k, v in prompt_checks.items()}
    errors = [
        (~checks["has_answer"], "answer_empty"), (uncited, "citations_missing_chunk_id"), (F.size(outside) > 0, "citations_outside_used_context"), (lost, "used_context_missing_chunk_id"),
        (empty, "used_context_empty_without_insufficient_evidence"), (required, "citations_required_when_context_is_used"), (F.size(unknown) > 0, "answer_mentions_unknown_chunk"),
        (weak & (F.size(cited) > 0), "insufficient_evidence_has_citations"), (weak & ~refuses, "insufficient_evidence_missing_refusal_message"), (~weak & refuses, "answer_refuses_without_insufficient_evidence_flag"),
        *((has_prompt & ~checks[k], f"{k}_missing") for k in prompt_checks),
    ]
    told = F.filter(F.array(*(F.when(cond, name) for cond, name in errors)), lambda x: x.isNotNull())
    return answers.select("query_id", (F.size(told) == 0).alias("valid"), F.struct(*(v.alias(k) for k, v in checks.items())).alias("checks"), unknown.alias("unknown_citations"), outside.alias("citations_outside_context"), told.alias("errors"), F.when(has_prompt, none).otherwise(F.array(F.lit("prompt_not_available_for_validation"))).alias("warnings"))
