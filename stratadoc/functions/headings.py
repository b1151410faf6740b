"""Clause numbers and headings of Portuguese legal documents, as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as tx

# Fixed patterns of the domain: what counts as a clause, a heading, an administrative line.
CLAUSE = r"(?Us)^\s*(\d{1,3}(?:\.\d{1,3})*)[.)]?\s+(\S[^\n]+?)\s*$"
NOT_A_CLAUSE = (r"(?U)^\s*\d{1,2}/\d{1,2}/\d{2,4}\b", r"(?iU)^\s*\d{1,2}h\d{0,2}\b", r"(?U)^\s*\d+(?:[\s-]\d+){2,}\b", r"(?U)^\s*\d+\s*%", r"(?iU)^\s*https?://", r"(?U)^\s*\S+@\S+")
LEGAL = r"(?iU)^\s*(Art\.?|Artigo|CL[ÁA]USULA|CAP[ÍI]TULO|SE[ÇC][ÃA]O|T[ÍI]TULO|LIVRO|PARTE|ANEXO|AP[ÊE]NDICE)\b"
ANNEX = r"(?iU)^\s*(ANEXO|ANNEX)\s+[IVXLCDM\d]+(?:[-\s][A-Z0-9]+)?\b"
ADMIN = (
    r"(?iU)\b(AVISO|C[ÓO]DIGO|CONCORR[ÊE]NCIA|CONTRATO|CPF|CNPJ|DATA|DI[ÁA]RIO\s+OFICIAL|DISPENSA|DOU|EDITAL|ENDERE[ÇC]O|E-?MAIL|HOMOLOGA[ÇC][ÃA]O|"
    r"INEXIGIBILIDADE|LICITA[ÇC][ÃA]O|LOCAL|MODALIDADE|PROCESSO|PROTOCOLO|PUBLICA[ÇC][ÃA]O|PREG[ÃA]O|SUM[ÁA]RIO|[ÍI]NDICE)\b"
)
INSTITUTION = (
    r"(?iU)\b(ADMINISTRA[ÇC][ÃA]O|ASSESSORIA|AUTARQUIA|COORDENA[ÇC][ÃA]O|CONSELHO|DEPARTAMENTO|DIRETORIA|ESTADO|FUNDA[ÇC][ÃA]O|GER[ÊE]NCIA|GOVERNO|"
    r"INSTITUTO|MINIST[ÉE]RIO|MUNIC[ÍI]PIO|PODER\s+(EXECUTIVO|JUDICI[ÁA]RIO|LEGISLATIVO)|PREFEITURA|PROCURADORIA|SECRETARIA|SUPERINTEND[ÊE]NCIA|TRIBUNAL|UNIDADE|UNIVERSIDADE)\b"
)
CONTACT = (
    r"(?iU)(https?://|\b\S+@\S+\b|\b\d{2}\.?\d{3}\.?\d{3}/?\d{4}-?\d{2}\b|\b\d{3}\.?\d{3}\.?\d{3}-?\d{2}\b|\bCEP\s*\d{5}-?\d{3}\b|\b(?:\(?\d{2}\)?\s*)?\d{4,5}-?\d{4}\b)"
)
DATE_OR_TIME = r"(?iU)^\s*(\d{1,2}/\d{1,2}/\d{2,4}|\d{1,2}\s+de\s+[a-zç]+\s+de\s+\d{4}|\d{1,2}h\d{0,2}(?:min)?)(?:\W|$)"
SUMMARY_ENTRY = r"(?U)\.{2,}\s*\d+\s*$|^\s*\d+(?:\.\d+)*\s+.+\s+\d+\s*$"
HEADING_LABELS, VISUAL_LABELS = ("title", "section_header"), ("picture", "image", "figure", "graphic")
EDGE_LABELS = ("header", "footer", "page_header", "page_footer")
FRONT = "front_matter"
#: Columns that tell of a line's looks.
VISUAL = ("bold", "is_bold", "strong", "font_weight", "font_size", "body_font_size", "font_size_rank", "visual_role", "role", "spacing_before")


def _clause(text: Column, group: int) -> Column:
    number, body = F.regexp_extract(text, CLAUSE, 1), F.regexp_extract(text, CLAUSE, 2)
    ok = (number != "") & (F.size(F.split(number, r"\.")) <= 8) & (F.length(number) <= 24) & body.rlike(r"\p{L}")
    for pattern in NOT_A_CLAUSE:
        ok &= ~text.rlike(pattern)
    return F.when(ok, number if group == 1 else body)


def clause_number(text: Column) -> Column:
    """The number that a clause begins with; null if the text is none."""
    return _clause(text, 1)


def clause_body(text: Column) -> Column:
    return F.coalesce(_clause(text, 2), F.lit(""))


def clause_level(number: Column) -> Column:
    return F.size(F.split(number, r"\.")) - 1


def clause_path(number: Column) -> Column:
    """1.2.3 as [1, 1.2, 1.2.3]."""
    parts = F.split(number, r"\.")
    return F.when(number.isNotNull(), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), ".")))


def named(text: Column) -> Column:
    """A legal division or an annex."""
    return text.rlike(LEGAL) | text.rlike(ANNEX)


def body_marker(text: Column, number: Column | None = None) -> Column:
    """``number``, here and below: the text's clause number where it is a column already."""
    level = clause_level(clause_number(text) if number is None else number)
    return F.coalesce(level <= 2, F.lit(False)) | named(text)


def heading_kind(text: Column, number: Column | None = None) -> Column:
    """section, subsection or null."""
    level = clause_level(clause_number(text) if number is None else number)
    return F.when(named(text) | (level == 0), "section").when(level <= 2, "subsection")


def heading_score(label: Column, text: Column, number: Column | None = None, body: Column | None = None) -> Column:
    level = clause_level(clause_number(text) if number is None else number)
    body = clause_body(text) if body is None else body
    points = lambda cond, n: F.when(cond, n).otherwise(0)
    colon = text.endswith(":")
    score = (
        points(label.isin(*HEADING_LABELS), 2)
        + points(level == 0, 2)
        + points((level <= 1) & (F.length(text) <= 120), 1)
        + points(tx.upper_heading(text), 2)
        + points((body != "") & tx.upper_heading(body), 1)
        + points(colon, 1)
        - points(text.rlike(r"[.;,]$") & ~colon, 2)
        - points(level >= 2, 2)
    )
    return F.when(named(text), 5).otherwise(score)


def content_type(label: Column, text: Column, number: Column | None = None) -> Column:
    number = clause_number(text) if number is None else number
    return (
        F.when(label.isin(*VISUAL_LABELS), "figure")
        .when(label.isin("table", "caption", "footnote"), label)
        .when(body_marker(text, number) | tx.upper_heading(text), "title")
        .when((label == "list_item") | number.isNotNull(), "list_item")
        .otherwise("paragraph")
    )


def admin_signals(text: Column) -> Column:
    one = lambda p: text.rlike(p).cast("int")
    return F.regexp_count(text, F.lit(ADMIN)) + F.regexp_count(text, F.lit(INSTITUTION)) + one(CONTACT) + one(DATE_OR_TIME) + one(SUMMARY_ENTRY)


def visual_evidence(b: dict[str, Column], text: Column) -> Column:
    """Three signals or more: heading label or type, capitals, bold, a heavy or a larger font, a high rank of it, heading
    role, space before.

    b: columns label, content_type and those of ``VISUAL``.
    """
    flag = lambda *names: F.coalesce(*(F.when(b[n].cast("boolean"), True) for n in names), F.lit(False))
    heading = F.coalesce(b["visual_role"] == "heading", F.lit(False)) | F.coalesce(b["role"] == "heading", F.lit(False))
    signals = [b["label"].isin(*HEADING_LABELS) | b["content_type"].isin("title", "heading"), tx.upper_heading(text), flag("bold", "is_bold", "strong"), b["font_weight"] >= 600, b["font_size"] > b["body_font_size"], b["font_size_rank"].isin("largest", "large", "heading"), heading, b["spacing_before"] > 0]
    return sum((F.coalesce(s, F.lit(False)).cast("int") for s in signals), F.lit(0)) >= 3


def front_matter_like(text: Column, label: Column, repeated: Column, evidence: Column, number: Column | None = None) -> Column:
    """Lines of covers, contents and contacts rather than of the body."""
    marker, admin = body_marker(text, number), admin_signals(text)
    return (
        (text == "")
        | F.coalesce(label.isin(*EDGE_LABELS), F.lit(False))
        | F.coalesce(repeated, F.lit(False))
        | ((tx.word_count(text) <= 2) & ~marker & ~evidence)
        | text.rlike(CONTACT) | text.rlike(DATE_OR_TIME) | text.rlike(SUMMARY_ENTRY)
        | (admin >= 2) | (((admin == 1) | text.rlike(INSTITUTION)) & ~marker)
    )


def section_title_like(text: Column) -> Column:
    return (text != "") & (F.length(text) <= 220) & (tx.word_count(text) <= 28) & text.rlike(r"\p{L}")


def body_start(text: Column, label: Column, repeated: Column, evidence: Column, number: Column | None = None) -> Column:
    return section_title_like(text) & body_marker(text, number) & ~front_matter_like(text, label, repeated, evidence, number)
