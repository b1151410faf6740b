"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that every match must contain.  An index
segment (about a megabyte of text, or one longer text) holds, for each trigram that some rule asks for, the postings:
which of its texts have it, as a bitmap.  A rule's query intersects and unites postings; only its candidates are searched
with the rule itself.  A rule without mandatory trigrams searches every text in full.  Rules name their letters of either
case one by one, and all their letters are ASCII; the index folds ASCII letters alone, which can only add candidates, so
the result is that of searching everything.

Matches are leftmost and do not overlap within a kind; kinds may overlap each other.  Null and empty texts have no
spans; a text's length is no limit; each row is scanned by itself, so repeated rows repeat their result; an empty table
gives no rows; extra columns are not read by ``secret_spans`` and pass through ``redacted``, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, textscan


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, and how long one of its groups must be for a match to stay."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def either_case(words: str) -> str:
    """A pattern for the words with every ASCII letter in either case, and no other letter."""
    return "".join(f"[{c}{c.upper()}]" if "a" <= c <= "z" else c for c in words)


BASE = (
    Rule("assign", "(" + either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Fixed public formats of credentials.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("stripe", r"sk_live_[0-9A-Za-z]+", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+"),
    Rule("url_login", r"[a-z]+://[A-Za-z0-9_.%+-]+:[^\x00-\x20/@]+@"),
)
RULES = BASE + MORE
_MOST = 64  # strings that an exact part of a pattern may stand for


def _all_of(strings: set[str]) -> tuple | None:
    """The query for texts with one of the strings; None: any text."""
    if any(len(s) < 3 for s in strings):
        return None
    return ("or", tuple(("and", tuple(sorted({s[i : i + 3] for i in range(len(s) - 2)}))) for s in sorted(strings)))


def _both(queries: list) -> tuple | None:
    kept = tuple(q for q in queries if q is not None)
    return ("and", kept) if kept else None


def _read(items) -> tuple[set[str] | None, tuple | None]:
    """Of a parsed pattern: the strings it stands for, if few, else None; and the query that its matches meet."""
    run: set[str] = {""}
    queries, exact = [], True
    for op, arg in items:
        name = str(op)
        own, query = None, None
        if name == "LITERAL":
            own = {chr(arg).lower()}
        elif name == "IN":
            chars = {chr(x).lower() for k, v in arg for x in ([v] if str(k) == "LITERAL" else range(v[0], v[1] + 1) if str(k) == "RANGE" and v[1] - v[0] < 8 else [])}
            whole = all(str(k) == "LITERAL" or str(k) == "RANGE" and v[1] - v[0] < 8 for k, v in arg)
            own = chars if whole and len(chars) <= 8 else None
        elif name == "SUBPATTERN":
            own, query = _read(arg[3])
        elif name == "BRANCH":
            parts = [_read(x) for x in arg[1]]
            if all(s is not None for s, _ in parts):
                own = set().union(*(s for s, _ in parts))
            elif all(q is not None or s is not None for s, q in parts):
                found = [q if s is None else _all_of(s) for s, q in parts]
                query = ("or", tuple(found)) if None not in found else None
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, sub = arg
            strings, inner = _read(sub)
            if low == 0 and high == 1 and strings is not None:
                own = strings | {""}
            elif low == high == 1:
                own, query = strings, inner
            elif low > 0:
                query = inner if strings is None else _all_of(strings)
                if strings is not None and low <= 8 and len(strings) == 1:
                    run = {r + next(iter(strings)) * low for r in run}
                    queries.append(_all_of(run))
                    run, exact = {""}, False
                    continue
        if own is not None and len(run) * len(own) <= _MOST:
            run = {r + s for r in run for s in own}
            continue
        queries.append(_all_of(run))
        queries.append(query if own is None else _all_of(own))
        run, exact = {""}, False
    if exact:
        return run, _all_of(run)
    queries.append(_all_of(run))
    return None, _both(queries)


def trigram_query(pattern: str) -> tuple | None:
    """A query of ("and" | "or", parts) over lower-cased trigrams that each match must meet; None if there is none."""
    return _read(re._parser.parse(pattern))[1]


def _trigrams(query) -> set[str]:
    return {query} if isinstance(query, str) else set().union(*map(_trigrams, query[1])) if query else set()


def _at_least(rule: Rule) -> str:
    """The rule's pattern; of a run of one class, which is as long as it can be, the runs that are long enough."""
    run = not rule.group and re.fullmatch(r"(\[[^\]\\]+\])\+", rule.pattern)
    return f"{run[1]}{{{max(1, rule.least)},}}" if run else rule.pattern


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.compiled = [re.compile(_at_least(r)) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.ids = {g: i + 1 for i, g in enumerate(sorted(set().union(*map(_trigrams, self.queries))))}
        self.table = np.zeros(1 << 21, np.uint16)
        for g, i in self.ids.items():
            a, b, c = g.encode("ascii")
            self.table[a << 14 | b << 7 | c] = i
        self.fold = np.where(np.arange(256) < 128, textscan.LOWER, 0).astype(np.uint32)

    def postings(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A row of bits for each trigram: which texts have it.  A trigram across two texts counts for the first."""
        bits = np.zeros((len(self.ids) + 1, len(offsets) - 1), bool)
        if len(raw) > 2:
            low = self.fold[raw]
            found = self.table[low[:-2] << 14 | low[1:-1] << 7 | low[2:]]
            at = np.flatnonzero(found)
            bits[found[at], np.searchsorted(offsets, at, side="right") - 1] = True
        return bits

    def _meets(self, query, bits: np.ndarray) -> np.ndarray:
        if query is None:
            return np.ones(bits.shape[1], bool)
        if isinstance(query, str):
            return bits[self.ids[query]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce([self._meets(q, bits) for q in query[1]])

    def __call__(self, column: pa.Array) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, rule, end), code points, sorted."""
        raw, offsets = shared.utf8(column)
        bits = self.postings(raw, offsets)
        out: list[list] = [[] for _ in range(len(column))]
        for i, rule in enumerate(self.rules):
            candidates = self._meets(self.queries[i], bits)
            for t in np.flatnonzero(candidates).tolist():
                for m in self.compiled[i].finditer(column[t].as_py() or ""):
                    if len(m[rule.group]) >= rule.least:
                        out[t].append((m.start(), i, m.end()))
        return [sorted(x) for x in out]


_SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and the spans by start, then in the order of the rules; code points, end exclusive; a row per document."""

    def run(batches):
        scan = Scanner(rules)
        for batch in batches:
            for part in shared.pieces(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array([[{"kind": rules[i].kind, "start": s, "end": e} for s, i, e in x] for x in scan(part.column("text"))], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], ["doc_id", "spans"])

    return shared.id_and_text(docs).mapInArrow(run, _SPANS)


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every (merged) span replaced by ``mark``; n_chars, if there, is counted anew."""
    shared.small_batches(docs.sparkSession)
    schema = docs.schema

    def run(batches):
        scan = Scanner(rules)
        for batch in batches:
            for part in shared.pieces(batch):
                texts, found = part.column("text"), scan(part.column("text"))
                if any(found):
                    new = texts.to_pylist()
                    for t, spans in enumerate(found):
                        out, at = [], 0
                        for s, _, e in spans:
                            if s >= at:
                                out += [new[t][at:s], mark]
                            at = max(at, e)
                        if spans:
                            new[t] = "".join([*out, new[t][at:]])
                    part = part.set_column(part.schema.get_field_index("text"), part.schema.field("text"), pa.array(new, part.schema.field("text").type))
                yield part

    out = docs.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
