"""Secret scan over a trigram index.

From each rule's regex a Boolean query over trigrams is derived: an OR of ANDs that every match
must satisfy. The index holds, for the trigrams that occur in any query, the documents that
contain them in lower case. Postings are intersected by counting, per document and AND, how many
of its trigrams were found; only documents that satisfy a rule's query are searched with its
regex. Rules without a mandatory trigram search every document.

Positions come from splitting a text at its matches: the pieces between matches and the matches
themselves add up to the text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, semi_join_listed, whole_text

try:
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # Python before 3.11
    import sre_constants as sre
    import sre_parse


@dataclass(frozen=True)
class Rule:
    """What to look for: ``regex`` is matched leftmost and without overlaps; matches whose group
    ``group`` is shorter than ``least`` characters are dropped afterwards."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


# Fixed values of the base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    # runs of these characters are matched to their end, so the least length can be asked for here
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)

# Well-known public key formats.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)

# The most strings one part of a regex may stand for before it counts as unknown.
MOST_STRINGS = 64

# Matches of a text that are folded one after another.
BLOCK = 128


def _simplest(ors: set[frozenset[str]]) -> set[frozenset[str]] | None:
    """An OR of ANDs without terms that another one implies; None if some term demands nothing."""
    if frozenset() in ors:
        return None
    return {a for a in ors if not any(b < a for b in ors)}


def _all_of(a: set | None, b: set | None) -> set | None:
    if a is None or b is None:
        return b if a is None else a
    return _simplest({x | y for x, y in product(a, b)})


def _of_strings(strings: set[str]) -> set | None:
    """What the presence of one of ``strings`` demands."""
    return _simplest(
        {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings} or {frozenset()}
    )


def _sequence(parsed) -> tuple[set[str] | None, set | None]:
    """The strings a parsed regex stands for, if they are few; else what it demands."""
    strings, demand, exact = {""}, None, True
    for op, arg in parsed:
        part, more = _part(op, arg)
        if part is not None and len(strings) * len(part) <= MOST_STRINGS:
            strings = {a + b for a, b in product(strings, part)}
            continue
        exact = False
        demand = _all_of(_all_of(demand, _of_strings(strings)), more)
        strings = {""} if part is None else part
    if exact:
        return strings, None
    return None, _all_of(demand, _of_strings(strings))


def _part(op, arg) -> tuple[set[str] | None, set | None]:
    """The same for one element of a regex. (None, None) is anything at all."""
    if op is sre.LITERAL:
        return {chr(arg).lower()}, None
    if op is sre.IN and all(kind is sre.LITERAL for kind, _ in arg):
        return {chr(c).lower() for _, c in arg}, None
    if op is sre.AT:
        return {""}, None
    if op is sre.SUBPATTERN:
        return _sequence(arg[3])
    if op is sre.BRANCH:
        found = [_sequence(x) for x in arg[1]]
        if all(strings is not None for strings, _ in found):
            return set().union(*[strings for strings, _ in found]), None
        demands = [d if strings is None else _of_strings(strings) for strings, d in found]
        return None, None if None in demands else _simplest(set().union(*demands))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, what = arg
        strings, demand = _sequence(what)
        if most == 1 and strings is not None:
            return strings | ({""} if least == 0 else set()), None
        if least == 0:
            return None, None
        return None, demand if strings is None else _of_strings(strings)
    return None, None


def trigram_query(regex: str) -> set[frozenset[str]] | None:
    """Trigrams in lower case that every match holds, as an OR of ANDs. None: no demand."""
    strings, demand = _sequence(sre_parse.parse(regex))
    return demand if strings is None else _of_strings(strings)


def _spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end, kind) of a rule's matches, in code points."""
    hits = F.regexp_extract_all(text, F.lit(f"({rule.regex})"), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(f"({rule.regex})"), F.lit(rule.group + 1))
    between = F.split(text, rule.regex, -1)
    sizes = F.zip_with(
        between,
        F.arrays_zip(hits.alias("hit"), tested.alias("tested")),
        lambda gap, hit: F.struct(
            F.length(gap).cast("long").alias("gap"),
            F.length(hit["hit"]).cast("long").alias("hit"),
            F.length(hit["tested"]).alias("tested"),
        ),
    )
    nothing = F.expr("cast(array() as array<struct<start:bigint,end:bigint,kind:string>>)")
    start = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("found"))

    def add(seen: Column, x: Column) -> Column:
        begin = seen["at"] + x["gap"]
        end = begin + F.coalesce(x["hit"], F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        found = F.when(
            x["tested"] >= rule.least, F.concat(seen["found"], F.array(span))
        ).otherwise(seen["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    found = _bound(sizes, lambda all_sizes: _bound(_folded(all_sizes, start, add), _put_together))
    return F.when(text.rlike(rule.regex), found).otherwise(nothing)


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it."""
    return F.transform(F.array(value), then)[0]


def _folded(sizes: Column, start: Column, add: Callable) -> Column:
    """Blocks of matches, each folded from an offset of its own: an array grows by copying, so
    none of a text's whole length is grown."""
    last = F.call_function("div", F.size(sizes) - 1, F.lit(BLOCK)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda b: F.aggregate(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK)), start, add),
    )


def _put_together(blocks: Column) -> Column:
    """The spans of all blocks, moved by the lengths of the blocks before."""
    none = F.struct(
        F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<bigint>)").alias("all")
    )
    offsets = F.aggregate(
        blocks,
        none,
        lambda seen, x: F.struct(
            (seen["at"] + x["at"]).alias("at"), F.concat(seen["all"], F.array(seen["at"])).alias("all")
        ),
        lambda seen: seen["all"],
    )

    def moved(block: Column, by: Column) -> Column:
        return F.transform(
            block["found"],
            lambda s: F.struct(
                (s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["kind"].alias("kind")
            ),
        )

    return F.flatten(F.zip_with(blocks, offsets, moved))


def postings(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The index: (trigram, key) for the trigrams in any rule's query. ``docs``: key, text."""
    queries = [trigram_query(r.regex) for r in rules]
    grams = sorted(set().union(*[term for q in queries if q for term in q]))
    if not grams:
        return docs.select(F.lit("").alias("trigram"), "key").where(F.lit(False))
    # the lower-case text and the flags are columns of their own, so each is computed once
    low = docs.select("key", F.lower("text").alias("low"))
    flags = low.select("key", F.array(*[F.col("low").contains(g) for g in grams]).alias("has"))
    listed = F.array(*[F.lit(g) for g in grams])
    found = F.zip_with("has", listed, lambda has, gram: F.when(has, gram))
    return flags.select("key", F.explode(found).alias("trigram")).where("trigram is not null")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, kind): documents whose postings satisfy a rule's query."""
    terms = [
        (rule.kind, n, gram, len(term))
        for rule in rules
        for n, term in enumerate(sorted(map(sorted, trigram_query(rule.regex) or ())))
        for gram in term
    ]
    spark = index.sparkSession
    listed = spark.createDataFrame(terms, "kind string, term int, trigram string, need int")
    return (
        index.join(F.broadcast(listed), "trigram")  # as long as the rules, not as the documents
        .groupBy("key", "kind", "term")
        .agg(F.count_distinct("trigram").alias("have"), F.first("need").alias("need"))
        .where("have = need")
        .select("key", "kind")
        .distinct()
    )


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES,
) -> DataFrame:
    """One row per row of ``docs``: id and ``found``, an array of (start, end, kind) sorted by
    start and then by the order of ``rules``.

    Offsets are code points of the whole text, the end is exclusive. A null text is empty and has
    no spans; an empty table gives an empty result. Rows with equal identifier and text share
    one entry of the index, and each gets its row of the result.
    """
    scratch = Scratch(docs.sparkSession)
    text = whole_text(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).withColumn(
        "key", F.xxhash64("id", "text")
    )
    indexed = tuple(r for r in rules if trigram_query(r.regex) is not None)
    scanned = tuple(r for r in rules if r not in indexed)
    index = scratch.write(postings(rows, indexed))
    satisfied = scratch.write(candidates(index, indexed))
    keys = scratch.write(satisfied.select("key").distinct())
    verified = semi_join_listed(rows, keys, "key").select(
        "key", F.concat(*[_spans(F.col("text"), r) for r in indexed]).alias("by_index")
    )
    verified = scratch.write(verified.where(F.size("by_index") > 0).dropDuplicates(["key"]))
    scratch.drop(index, keys)
    full = F.concat(*[_spans(F.col("text"), r) for r in scanned]) if scanned else F.array()
    order = F.create_map(*[F.lit(x) for n, r in enumerate(rules) for x in (r.kind, n)])
    both = F.concat("by_scan", F.coalesce("by_index", F.array()))
    ranked = F.transform(
        both, lambda s: F.struct(s["start"], order[s["kind"]].alias("n"), s["end"], s["kind"])
    )
    return (
        rows.select("id", "key", full.alias("by_scan"))
        .join(verified, "key", "left")
        .select(
            F.col("id").alias(id_col),
            F.transform(
                F.array_sort(ranked), lambda s: F.struct(s["start"], s["end"], s["kind"])
            ).alias("found"),
        )
    )


def _listed(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans, per document."""
    kinds = [r.kind for r in BASE_RULES]
    found = find_secrets(docs)

    def of(*names: str) -> Column:
        return F.filter("found", lambda s: s["kind"].isin(*names))

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(_listed(of(*kinds)), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )
