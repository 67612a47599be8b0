"""Secret scans through a trigram index.

From each rule's regular expression a Boolean query over the trigrams that any
match must contain is derived.  A batch of texts gets one posting (a bitmap of
its rows) for each trigram the rules ask for; a rule's postings are intersected
and united as its query says, and only the texts that remain are verified with
the expression.  A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as K, _parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tidemart.llm.common import bound_batches


@dataclass(frozen=True)
class Rule:
    """``least`` characters at least in ``group`` of a match, else it is dropped."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    fold: bool = False

    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.fold else 0))


#: Fixed patterns and lengths: the base kinds, in their order.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
#: Kinds added by this library (public formats of keys).
ADDED = (
    Rule("private", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)

# A trigram query: a set of alternatives, each a set of trigrams that must all occur.
Query = frozenset[frozenset[str]]


def trigram_query(rule: Rule) -> Query:
    """Alternatives of mandatory trigrams (in lower case if the rule folds
    letters); an empty alternative means that nothing is mandatory."""

    def strings(items) -> list[list[str]]:
        """Alternatives, each a list of literal runs that any match contains."""
        done = [[""]]
        for op, value in items:
            if op is K.LITERAL:
                done = [[*runs[:-1], runs[-1] + chr(value)] for runs in done]
                continue
            if op is K.BRANCH:
                parts = [p for branch in value[1] for p in strings(branch)]
            elif op is K.IN and len(value) <= 8 and all(kind is K.LITERAL for kind, _ in value):
                parts = [[chr(c)] for _, c in value]
            elif op is K.SUBPATTERN:
                parts = strings(value[3])
            elif op is K.MAX_REPEAT and value[0] >= 1:
                parts = [[*p, ""] for p in strings(value[2])]
                done = [[*runs, ""] for runs in done]
            else:
                parts = [["", ""]]
            done = [[*runs[:-1], runs[-1] + p[0], *p[1:]] for runs in done for p in parts]
        return done

    tree = _parser.parse(rule.pattern)
    queries = set()
    for runs in strings(tree):
        runs = [r.lower() if rule.fold else r for r in runs]
        queries.add(frozenset(r[i : i + 3] for r in runs for i in range(len(r) - 2)))
    return frozenset(queries) if all(queries) else frozenset([frozenset()])


def candidates(texts: pa.Array, folded: pa.Array, rules) -> list[np.ndarray]:
    """For each rule the rows of the batch that its trigram query leaves."""
    postings: dict[tuple[str, bool], np.ndarray] = {}

    def posting(gram: str, fold: bool) -> np.ndarray:
        if (gram, fold) not in postings:
            found = pc.match_substring(folded if fold else texts, gram)
            postings[gram, fold] = found.to_numpy(zero_copy_only=False)
        return postings[gram, fold]

    out = []
    for rule in rules:
        rows = np.zeros(len(texts), bool)
        for needed in trigram_query(rule):
            both = np.ones(len(texts), bool)
            for gram in sorted(needed):
                both &= posting(gram, rule.fold)
            rows |= both
        out.append(np.flatnonzero(rows))
    return out


def _finder(rule: Rule):
    """Spans of a rule's matches that pass its length.  A rule that is one
    greedy class run is searched with its length in the expression, which
    finds the same runs without stopping at short ones."""
    run = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    if run and not rule.group and not rule.fold:
        find = re.compile(f"{run[1]}{{{rule.least},}}", re.ASCII).finditer
        return lambda text: [m.span() for m in find(text)]
    find = rule.regex().finditer
    return lambda text: [m.span() for m in find(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED) -> DataFrame:
    """All columns of ``docs`` and ``secret_spans``: array of (start, kind, end),
    code points, end exclusive, by start, then the rules' order.

    Each rule's leftmost non-overlapping matches in ``text`` count; spans of
    different rules may overlap.  A null or empty text has none.  A column of
    ``docs`` named secret_spans is replaced; repeated rows stay; an empty table
    gives an empty result.
    """
    finders = [_finder(rule) for rule in rules]
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    rest = [c for c in docs.columns if c.lower() != "secret_spans"]
    at, docs = rest.index("text"), docs.select(*(F.col(f"`{c}`") for c in rest))
    names = [f"c{i}" for i in range(len(rest))]

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(at), "")
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for k, rows in enumerate(candidates(texts, pc.ascii_lower(texts), rules)):
                for r in rows.tolist():
                    found[r] += [(start, k, end) for start, end in finders[k](texts[r].as_py())]
            spans = [[{"start": s, "kind": k, "end": e} for s, k, e in sorted(f)] for f in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, spans_type)], [*names, "secret_spans"])

    bound_batches(docs.sparkSession)
    plain = docs.toDF(*names)  # mapInArrow takes no dots in names
    added = T.StructType.fromDDL("secret_spans array<struct<start:bigint,kind:int,end:bigint>>")
    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, *added.fields])).toDF(*rest, "secret_spans")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of each row."""
    names = F.array(*(F.lit(r.kind) for r in BASE + ADDED))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("secret_spans", lambda s: s["kind"] == k)).cast("bigint")
    base = F.filter("secret_spans", lambda s: s["kind"] < len(BASE))
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secret_spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping spans
    once); n_chars, if there, is the new length where a text changed."""
    found = scan(docs)
    merged = F.aggregate("secret_spans", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] >= a["at"], F.concat(a["out"], F.col("text").substr(
            (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mark))).otherwise(a["out"]).alias("out")))
    found = found.withColumn("_r", merged)
    text = F.when(F.size("secret_spans") > 0, F.concat("_r.out", F.col("text").substr(
        (F.col("_r.at") + 1).cast("int"), F.length("text")))).otherwise(F.col("text"))
    out = found.withColumn("_t", text)
    chars = {"n_chars": F.when(F.size("secret_spans") > 0, F.length("_t").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars"))
             } if "n_chars" in docs.columns else {}
    return out.withColumns(chars | {"text": F.col("_t")}).select(*(F.col(f"`{c}`") for c in docs.columns))
