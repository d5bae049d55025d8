"""Secret scan through a trigram inverted index (DataFrame functions only).

Each rule's regex is turned into a Boolean trigram query: an OR of clauses, each clause the trigrams that a
match must contain. The index holds postings (trigram, document) for the trigrams the rules ask for, taken
from the case-folded whole text. Postings are intersected per document; only documents that satisfy a
rule's query are verified with its regex. A rule without mandatory trigrams scans every document.

Spans count code points, the end is exclusive; per rule they are leftmost and do not overlap. Defined cases:
null text is empty; an empty text has no spans; repeated ids share their candidates and each row is verified
on its own text; a null id joins null-safely; other columns are kept by ``scan`` and ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import re._constants as K
import re._parser as regex_tree
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import body, cut, number_of, numbered, small
from visitlens.plans.physical import MAX_BROADCAST_ROWS
from visitlens.sources.tables import read_table


@dataclass(frozen=True)
class Rule:
    """``group``/``least``: a match counts when that group has at least ``least`` characters. ``tail``: the span is
    that group, which ends the match; what stands before it is only looked at."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1
    tail: bool = False


BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Whole runs of hex digits; with the length in the pattern the short runs never become strings.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    # Only at the start of a run: otherwise every eyJ inside a long run would read the rest of the run again.
    Rule("jwt", r"(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+)", 1, 1, True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE
BREAK = "\0"  # anything: no trigram spans it
MAX_FORMS = 512
GRAMS_PER_MASK = 62


def _forms(nodes) -> set[str]:
    """Strings that stand for all matches: literal runs, with BREAK where anything may stand."""
    out = {""}
    for op, arg in nodes:
        if op is K.LITERAL:
            part = {chr(arg).lower()}
        elif op is K.IN and len(arg) <= 6 and all(o is K.LITERAL for o, _ in arg):
            part = {chr(c).lower() for _, c in arg}
        elif op is K.BRANCH:
            part = set().union(*(_forms(b) for b in arg[1]))
        elif op is K.SUBPATTERN:
            part = _forms(arg[3])
        elif op is K.MAX_REPEAT and arg[:2] == (0, 1):
            part = {""} | _forms(arg[2])
        elif op is K.MAX_REPEAT and arg[0] >= 1:
            part = {f + BREAK for f in _forms(arg[2])}
        else:
            part = {BREAK}
        if len(out) * len(part) > MAX_FORMS:
            part = {BREAK}
        out = {a + b for a in out for b in part}
    return out


def trigram_query(regex: str) -> tuple[frozenset[str], ...]:
    """OR of AND-clauses of lower-case trigrams; () when some match may hold no trigram at all."""
    clauses = {
        frozenset(run[i : i + 3] for run in form.split(BREAK) for i in range(len(run) - 2))
        for form in _forms(regex_tree.parse(regex))
    }
    if frozenset() in clauses:
        return ()
    least = [c for c in clauses if not any(o < c for o in clauses)]
    return tuple(sorted(least, key=sorted))


def postings(docs: DataFrame, grams: list[str], doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index over ``grams``: one row (gram ordinal, doc) for each trigram a text contains."""
    low = docs.select(F.col(doc).alias("doc"), F.lower(body(text)).alias("low"))
    present = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))
    return low.select("doc", F.explode(present).alias("gram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...], grams: list[str]) -> DataFrame:
    """Intersect postings: (doc, hit) with a bit of ``hit`` for each rule whose query the document satisfies."""
    masks = range(0, len(grams), GRAMS_PER_MASK)
    bit = lambda lo: F.when(F.col("gram").between(lo, lo + GRAMS_PER_MASK - 1),
                            F.expr(f"shiftleft(1L, gram - {lo})")).otherwise(F.lit(0).cast("long"))
    seen = index.groupBy("doc").agg(*[F.bit_or(bit(lo)).alias(f"m{lo}") for lo in masks])

    def holds(clause: frozenset[str]) -> Column:
        terms = []
        for lo in masks:
            need = sum(1 << (grams.index(g) - lo) for g in clause if lo <= grams.index(g) < lo + GRAMS_PER_MASK)
            if need:
                terms.append(F.col(f"m{lo}").bitwiseAND(F.lit(need)) == F.lit(need))
        return reduce(Column.__and__, terms)

    hit = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        if query := trigram_query(rule.regex):
            hit = hit.bitwiseOR(F.when(reduce(Column.__or__, [holds(c) for c in query]), F.lit(1 << k)).otherwise(F.lit(0)))
    return seen.select("doc", hit.alias("hit")).where("hit <> 0")


def _spans(k: int, rule: Rule) -> Column:
    """array<struct<start, kind, end>> from the matches and the text between them."""
    gap = F.transform(f"gap{k}", F.length)
    walked = F.aggregate(
        F.arrays_zip(F.col(f"hit{k}").alias("m"), F.col(f"val{k}").alias("v"), gap.alias("g")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("found")),
        lambda s, x: F.struct(
            (s["at"] + x["g"] + F.coalesce(F.length(x["m"]), F.lit(0))).alias("at"),
            F.when(F.length(x["v"]) >= rule.least, F.array_append(s["found"], F.struct(
                (s["at"] + x["g"] + (F.length(x["m"]) - F.length(x["v"]) if rule.tail else F.lit(0))).alias("start"), F.lit(k).alias("kind"),
                (s["at"] + x["g"] + F.length(x["m"])).alias("end")))).otherwise(s["found"]).alias("found")),
        lambda s: s["found"],
    )
    return F.when(F.size(f"hit{k}") > 0, walked).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc: str = "doc_id", text: str = "text",
         max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``docs`` with ``spans``: array<struct<start, kind (ordinal in rules), end>> sorted by start, then kind."""
    grams = sorted({g for r in rules for c in trigram_query(r.regex) for g in c})
    docs = docs.drop("spans")
    found = cut(candidates(postings(docs, grams, doc, text), rules, grams))
    found = small(found.select(F.col("doc").alias("_doc"), F.col("hit").alias("_hit")), found.count(), max_broadcast_rows)
    row = F.struct("*").alias("_row")
    work = docs.select(row).join(found, F.col(f"_row.`{doc}`").eqNullSafe(F.col("_doc")), "left")
    work = work.select("_row", "_hit", body(f"_row.`{text}`").alias("_text"))
    none = F.array().cast("array<string>")
    parts = []
    for k, rule in enumerate(rules):
        on = F.lit(True) if not trigram_query(rule.regex) else F.coalesce(F.col("_hit"), F.lit(0)).bitwiseAND(F.lit(1 << k)) != 0
        pattern = F.lit(rule.regex)
        parts.append(F.when(on, F.regexp_extract_all("_text", pattern, F.lit(0))).otherwise(none).alias(f"hit{k}"))
    work = work.select("_row", "_text", *parts)
    more = []
    for k, rule in enumerate(rules):
        some, pattern = F.size(f"hit{k}") > 0, F.lit(rule.regex)
        value = F.col(f"hit{k}") if not rule.group else F.regexp_extract_all("_text", pattern, F.lit(rule.group))
        more += [F.when(some, value).otherwise(none).alias(f"val{k}"),
                 F.when(some, F.split("_text", rule.regex, -1)).otherwise(none).alias(f"gap{k}")]
    work = work.select("_row", *[f"hit{k}" for k in range(len(rules))], *more)
    spans = F.array_sort(F.concat(*[_spans(k, r) for k, r in enumerate(rules)]))
    return work.select("_row.*", spans.alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every span of ``scan`` replaced by ``mark`` (overlapping spans share one mark)."""
    columns, doc = docs.columns, options.pop("doc", "doc_id")
    doc, clean_text = (number_of(docs, c) for c in (doc, text))
    names, text = numbered(docs).columns, clean_text
    found = scan(numbered(docs), doc=doc, text=text, **options)
    pieces = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(
                s["out"], F.substr(F.col(text), s["at"] + 1, x["start"] - s["at"]), F.lit(mark)))
            .otherwise(s["out"]).alias("out")),
        lambda s: F.concat(s["out"], F.substr(F.col(text), s["at"] + 1)),
    )
    clean = F.when(F.size("spans") > 0, pieces).otherwise(F.col(text))
    return found.select(*[clean.alias(c) if c == text else F.col(c) for c in names]).toDF(*columns)


def _written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its spans: the base kinds counted and digested, all kinds listed."""
    found = scan(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)],
        F.sha2(_written(base, RULES), 256).alias("base_sha256"), _written(F.col("spans"), RULES).alias("spans"))


def _sql_rule(k: int, regex: str, group: int, least: int, tail: bool = False) -> str:
    """Spans of one rule in DuckDB SQL: match i starts behind the gaps up to i and the matches before it."""
    quoted = regex.replace("'", "''")
    return f"""
  SELECT doc_id, text, {k} AS k, unnest(list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
      's': list_sum(list_transform(g[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0){" + length(m[i]) - length(v[i])" if tail else ""},
      'n': length({"v" if tail else "m"}[i]), 'v': length(v[i])}}), lambda x: x.v >= {least})) AS x
  FROM (SELECT doc_id, text, regexp_extract_all(text, '{quoted}') AS m,
               regexp_extract_all(text, '{quoted}', {group}) AS v, regexp_split_to_array(text, '{quoted}') AS g FROM d)"""


_SQL_RULES = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("google", r"AIza[A-Za-z0-9_-]{35,}", 0, 1),
    ("jwt", r"(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+)", 1, 1, True),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_sql_rule(k, *r[1:]) for k, r in enumerate(_SQL_RULES))}),
w AS (SELECT doc_id, k, x.s AS s, [{", ".join(f"'{r[0]}'" for r in _SQL_RULES)}][k + 1] || ':' || x.s || ':' || (x.s + x.n) AS t FROM s)
SELECT d.doc_id, count(*) FILTER (k = 0)::BIGINT AS n_assign, count(*) FILTER (k = 1)::BIGINT AS n_access,
  count(*) FILTER (k = 2)::BIGINT AS n_hex,
  sha256(coalesce(string_agg(t, ',' ORDER BY s, k) FILTER (k < 3), '')) AS base_sha256,
  coalesce(string_agg(t, ',' ORDER BY s, k), '') AS spans
FROM d LEFT JOIN w USING (doc_id) GROUP BY d.doc_id
"""
