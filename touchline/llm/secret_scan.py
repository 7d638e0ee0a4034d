"""Secret scan through a trigram inverted index, with built-in functions alone.

From each rule's regular expression a Boolean query over trigrams is derived: the letters
that every match must contain, as alternatives of sets of trigrams. Postings of those
trigrams (which texts hold them, letter case aside) are written as a table; a text is
a candidate of a rule where the postings of all trigrams of one alternative meet. Only then
the expression runs on it. A rule from which no trigram follows looks at all texts.

Nulls and edges: a null text is empty and has no secrets; a row without ``doc_id`` is scanned
like any other; repeated rows share their postings and give repeated results; spans of
different rules may overlap; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re._constants as code
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.native import places
from touchline.llm.shared import stored, text_key


@dataclass(frozen=True)
class Rule:
    """A match counts if its ``group`` has at least ``least`` characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
# Published forms of keys.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)

#: A query is a list of alternatives; each is a set of trigrams that must all be there.
Query = list[frozenset[str]]


def trigram_query(regex: str) -> Query:
    """What every match of ``regex`` contains; one empty alternative if nothing is certain."""

    def joined(a: Query, b: Query) -> Query:
        return [x | y for x in a for y in b]

    def of(items) -> Query:
        query: Query = [frozenset()]
        runs = [""]  # the literal texts that may stand here

        def close() -> None:
            nonlocal query, runs
            query = joined(query, [frozenset(run[i : i + 3] for i in range(len(run) - 2)) for run in runs])
            runs = [""]

        for op, arg in items:
            if op is code.LITERAL and arg < 128:
                runs = [run + chr(arg).lower() for run in runs]
                continue
            if op is code.IN and len(arg) <= 8 and all(o is code.LITERAL and a < 128 for o, a in arg):
                runs = sorted({run + chr(a).lower() for run in runs for _, a in arg})
                if len(runs) > 16:
                    close()
                continue
            close()
            if op is code.SUBPATTERN:
                query = joined(query, of(arg[3]))
            elif op is code.BRANCH:
                query = joined(query, [x for part in arg[1] for x in of(part)])
            elif op in (code.MAX_REPEAT, code.MIN_REPEAT, code.POSSESSIVE_REPEAT) and arg[0] > 0:
                query = joined(query, of(arg[2]))
        close()
        return query

    found = of(parser.parse(regex))
    return [frozenset()] if frozenset() in found else sorted(set(found), key=sorted)


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(gram, doc_id, text_key): the texts that hold each trigram of the rules' queries, letter case aside."""
    grams = sorted({g for rule in rules for x in trigram_query(rule.regex) for g in x})
    low = F.lower(F.col("text"))
    present = F.array_compact(F.array(*(F.when(F.contains(low, F.lit(g)), F.lit(g)) for g in grams)))
    return (
        docs.where("text IS NOT NULL")
        .select("doc_id", text_key().alias("text_key"), F.explode(present).alias("gram"))
        .distinct()
    )


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, text_key, kinds): the rules of which all trigrams of one alternative meet in a text."""
    terms = [
        F.struct(F.lit(g).alias("gram"), F.lit(rule.kind).alias("kind"), F.lit(i).alias("way"), F.lit(len(x)).alias("all"))
        for rule in rules
        for i, x in enumerate(trigram_query(rule.regex))
        for g in sorted(x)
    ]
    wanted = index.sparkSession.range(1).select(F.inline(F.array(*terms)))
    return (
        index.join(F.broadcast(wanted), "gram")  # a row per trigram of the rules, whatever the data
        .groupBy("doc_id", "text_key", "kind", "way", "all")
        .agg(F.count("*").alias("n"))
        .where("n = `all`")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """(doc_id, spans) for every row: an array of (start, rank, kind, end) by start and order of the rules.

    Places are code points, end exclusive.
    """
    full = [r for r in rules if trigram_query(r.regex) == [frozenset()]]
    index = stored(postings(docs, rules), "trigrams")
    kinds = stored(candidates(index, rules), "candidates").select(
        F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), "kinds"
    )
    texts = docs.select("doc_id", text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = texts.join(kinds, texts["doc_id"].eqNullSafe(kinds["c_id"]) & (F.col("text_key") == F.col("c_key")), "left")
    none = F.slice(F.array(_span(F.lit(0), F.lit(0), 0, "", F.lit(True))), 1, 0)

    def spans(rank: int, rule: Rule) -> Column:
        found = places(
            F.col("text"),
            rule.regex,
            lambda m: _span(m.start, m.end, rank, rule.kind, F.length(m.group) >= rule.least),
            rule.group,
        )
        looks = F.rlike("text", F.lit(rule.regex)) if rule in full else F.array_contains("kinds", rule.kind)
        return F.when(looks, F.filter(found, lambda x: x["holds"])).otherwise(none)

    every = F.flatten(F.array(*(spans(i, rule) for i, rule in enumerate(rules))))
    return chosen.select("doc_id", F.array_sort(every).alias("spans"))


def _span(start: Column, end: Column, rank: int, kind: str, holds: Column) -> Column:
    return F.struct(
        start.alias("start"),
        F.lit(rank).alias("rank"),
        F.lit(kind).alias("kind"),
        end.alias("end"),
        holds.alias("holds"),
    )
