"""Secret scans over a trigram inverted index.

All of it runs as DataFrame expressions. From each rule's regular expression a Boolean query
over trigrams of lower-cased text is derived: any match must hold all trigrams of at least one
clause. Postings (trigram, document) are made for the trigrams that occur in a query, intersected
per clause, and only the candidates are searched with the expression itself. A rule without a
mandatory trigram is searched for in every document.

A NULL or empty text has no spans. Repeated rows are judged alike, each by itself. Only the id
and text columns are read. Spans count code points; the end is exclusive. Matches are leftmost
and do not overlap within a rule.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import sized_join
from ..sources.scratch import materialize
from .common import ROW, keyed


@dataclass(frozen=True)
class Rule:
    """``least`` characters of ``group`` make a match count; a match failing that is dropped, but used up."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# Base rules first. A length bound that a greedy run of one class has to meet stands in the pattern itself.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]{12,}", base=True),
    Rule("hex", r"[0-9a-f]{32,}", base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("repo_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

RUN = 128  # matches whose lengths are summed together
MOST_STRINGS = 64  # more alternatives than this are given up and cost only selectivity


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of which every matching lower-cased text fulfils one by holding all its trigrams; an empty clause: any text."""

    def grams(s: str) -> frozenset[str]:
        return frozenset(s[i : i + 3] for i in range(len(s) - 2))

    def smallest(clauses: set[frozenset[str]]) -> set[frozenset[str]]:
        return {c for c in clauses if not any(o < c for o in clauses)}

    def both(a: set[frozenset[str]], b: set[frozenset[str]]) -> set[frozenset[str]]:
        found = smallest({x | y for x, y in product(a, b)})
        return found if len(found) <= MOST_STRINGS else a

    def exact(items) -> set[str] | None:
        """All lower-cased strings that the items match, or None if they are many."""
        strings = {""}
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                more = {chr(arg).lower()}
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
                more = {chr(a).lower() for _, a in arg}
            elif name == "SUBPATTERN":
                more = exact(arg[-1])
            elif name == "BRANCH":
                parts = [exact(branch) for branch in arg[1]]
                more = None if None in parts else set().union(*parts)
            elif name == "MAX_REPEAT" and arg[:2] == (0, 1):
                more = exact(arg[2])
                more = None if more is None else more | {""}
            else:
                more = None
            if more is None or len(strings) * len(more) > MOST_STRINGS:
                return None
            strings = {s + m for s in strings for m in more}
        return strings

    def needed(items) -> set[frozenset[str]]:
        clauses, strings = {frozenset()}, {""}
        for item in items:
            more = exact([item])
            if more is not None and len(strings) * len(more) <= MOST_STRINGS:
                strings = {s + m for s in strings for m in more}
                continue
            clauses, strings = both(clauses, smallest({grams(s) for s in strings})), {""}
            name, arg = str(item[0]), item[1]
            if name == "SUBPATTERN":
                clauses = both(clauses, needed(arg[-1]))
            elif name == "BRANCH":
                clauses = both(clauses, smallest(set().union(*[needed(b) for b in arg[1]])))
            elif name == "MAX_REPEAT" and arg[0] > 0:
                clauses = both(clauses, needed(arg[2]))
        return both(clauses, smallest({grams(s) for s in strings}))

    return sorted(needed(list(re._parser.parse(pattern))), key=sorted)


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(trigram, k1, k2): the inverted index of ``keyed`` documents for the given trigrams."""
    low = docs.select(*ROW, F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    # The outer form keeps Spark from testing the array's size first, which would compute all of it again.
    return low.select(*ROW, F.explode_outer(held).alias("trigram")).filter("trigram IS NOT NULL")


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """(k1, k2, kinds): the intersected postings of each clause, and per document the rules with any fulfilled clause."""
    clauses = [(kind, i, g) for kind, query in queries.items() for i, c in enumerate(query) for g in sorted(c)]
    sizes = [(kind, i, len(c)) for kind, query in queries.items() for i, c in enumerate(query)]
    spark = index.sparkSession
    # As many rows as the rules have trigrams, whatever the data.
    asked = F.broadcast(spark.createDataFrame(clauses, "kind string, clause int, trigram string"))
    wanted = F.broadcast(spark.createDataFrame(sizes, "kind string, clause int, wanted long"))
    met = index.join(asked, "trigram").groupBy(*ROW, "kind", "clause").agg(F.count("*").alias("held"))
    met = met.join(wanted, ["kind", "clause"]).filter("held = wanted")
    return met.groupBy(*ROW).agg(F.collect_set("kind").alias("kinds"))


def _held(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once: a lambda would work out an outer expression anew for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda n, x: n + x)


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, stop, kind): offsets from the lengths of the matches and of the pieces between them.

    Running sums in two steps, over runs of ``RUN`` matches and within each, so the work hardly grows faster than the matches.
    """
    pattern = F.lit(rule.pattern)
    sizes = F.struct(
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length).alias("found"),
        F.transform(F.split(text, rule.pattern, -1), F.char_length).alias("gaps"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda m: F.char_length(m) >= rule.least).alias("counts"),
    )

    def stepped(z: Column) -> Column:
        steps = F.zip_with(F.slice(z.gaps, F.lit(1), F.size(z.found)), z.found, lambda g, m: g + m)
        return _held(F.struct(z.found, z.gaps, z.counts, steps.alias("steps")), summed)

    def summed(z: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(z.steps) - 1) / RUN).cast("int"))
        totals = F.transform(runs, lambda r: _sum(F.slice(z.steps, r * RUN + 1, F.lit(RUN))))
        return _held(F.struct(z.found, z.gaps, z.counts, z.steps, totals.alias("totals")), begun)

    def begun(z: Column) -> Column:
        before = F.transform(z.totals, lambda t, r: _sum(F.slice(z.totals, F.lit(1), r)))
        return _held(F.struct(z.found, z.gaps, z.counts, z.steps, before.alias("before")), spans)

    def spans(z: Column) -> Column:
        def span(size: Column, i: Column) -> Column:
            run = F.floor(i / RUN).cast("int")
            start = F.get(z.before, run) + _sum(F.slice(z.steps, run * RUN + 1, i - run * RUN)) + F.get(z.gaps, i)
            return _held(start, lambda at: F.struct(
                at.alias("start"), F.lit(order).alias("order"), (at + size).alias("stop"), F.lit(rule.kind).alias("kind"), F.get(z.counts, i).alias("counts")
            ))

        return F.filter(F.transform(z.found, span), lambda s: s.counts)

    return _held(sizes, stepped)


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: doc_id and found, the array of (start, order, stop, kind) sorted by start, then order of the rules."""
    rows = keyed(docs)
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {kind: q for kind, q in queries.items() if frozenset() not in q}
    grams = sorted({g for q in indexed.values() for c in q for g in c})
    likely = candidates(postings(rows, grams), indexed).withColumnsRenamed({k: f"c{k}" for k in ROW})
    likely = materialize(likely, "secret_candidates")
    joined = sized_join(rows, likely, [(F.col(k), F.col(f"c{k}")) for k in ROW], "left")
    none = F.array().cast("array<struct<start:int,order:int,stop:int,kind:string,counts:boolean>>")

    def spans(order: int, rule: Rule) -> Column:
        text = F.col("text")
        asked = F.array_contains("kinds", rule.kind) if rule.kind in indexed else F.lit(True)
        return F.when(asked & text.rlike(rule.pattern), _spans(text, rule, order)).otherwise(none)

    every = reduce(lambda a, b: F.concat(a, b), [spans(i, r) for i, r in enumerate(rules)])
    return joined.select("doc_id", F.array_sort(every).alias("found"))


def secret_digest(spans: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the base rules, the digest of their spans, and all spans as text."""
    found = F.col("found")
    base = F.filter(found, lambda s: s.order < sum(r.base for r in rules))
    text = lambda xs: F.array_join(F.transform(xs, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")
    number = lambda kind: F.size(F.filter(found, lambda s: s.kind == kind)).cast("bigint")
    counts = [number(r.kind).alias(f"n_{r.kind}") for r in rules if r.base]
    return spans.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(found).alias("spans"))


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return secret_digest(secret_spans(read(spark, sf_dir, "documents")))


def _rule_sql(order: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {order} AS o, '{rule.kind}' AS kind,
    list_sum(list_transform(gaps[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda s: length(s))), 0) AS a,
    length(found[i]) AS n, length(sized[i]) >= {rule.least} AS counts
  FROM (SELECT doc_id, found, sized, gaps, unnest(range(1, len(found) + 1)) AS i FROM (
    SELECT doc_id, regexp_extract_all(t, '{pattern}') AS found, regexp_extract_all(t, '{pattern}', {rule.group}) AS sized,
      regexp_split_to_array(t, '{pattern}') AS gaps FROM d))"""


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_rule_sql(i, r) for i, r in enumerate(RULES))}),
f AS (SELECT doc_id, o, kind, (a)::BIGINT AS a, concat(kind, ':', a::BIGINT, ':', (a + n)::BIGINT) AS x FROM s WHERE counts)
SELECT d.doc_id, count(*) FILTER (kind = 'assign')::BIGINT AS n_assign, count(*) FILTER (kind = 'access')::BIGINT AS n_access,
  count(*) FILTER (kind = 'hex')::BIGINT AS n_hex,
  sha256(coalesce(string_agg(x, ',' ORDER BY a, o) FILTER (o < 3), '')) AS base_sha256,
  coalesce(string_agg(x, ',' ORDER BY a, o), '') AS spans
FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id
"""
