"""Benchmark decontamination by template windows.

Texts become templates: numbers, capitalised names inside a sentence and units after a number
turn into typed placeholders, the rest into lower-case words. Every run of ``WINDOW`` template
tokens of every document is hashed and joined with the windows of the benchmark items, so that
a question whose numbers and names were changed still meets its original. For documents that
share enough windows with an item, the placeholders' values are then compared along the best
alignment: the leak is ``exact`` if all are the same, ``reparameterised`` if each value of the
item always stands for the same other value and no two share one, and ``conflicting`` otherwise.

All this is done twice, with names as placeholders and with names as plain words. The second
reading does not depend on letter case or on where sentences start, so it finds copies in upper
or title case and copies without punctuation.

Items without a window (too short, or little but placeholders) are looked up whole, with the
values of their numbers and units: all their tokens in a row make an ``exact`` leak.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, semi_join_listed, whole_text, without_keys

WINDOW = 8

# Items with fewer template tokens would match by chance and are looked up with their values only.
LEAST_ITEM = 4

# Share of an item's windows that makes a document a suspect, and the share from which it counts
# as contaminated even where placeholder values conflict.
COVERAGE = 0.3
CLEAR = 0.8

# Windows of benchmark items up to this many rows (24 bytes each) are broadcast.
BROADCAST_WINDOWS = 500_000

# Marks of the placeholders (private-use characters) and the end of their values.
NUMBER, NAME, UNIT, END = "\ue000", "\ue001", "\ue002", "\ue003"

# Units that may follow a number.
UNITS = (
    "km mi cm mm ft in yd kg mg lb oz g m l ml t s h min ms kb mb gb tb hz khz mhz ghz w kw v a "
    "°c °f % € $ £ meters metres miles feet inches grams kilograms pounds liters litres seconds "
    "minutes hours days weeks months years dollars euros percent degrees"
).split()


def _marked(text: Column, names: bool) -> Column:
    """The text with placeholders around the values they stand for; names only if asked for."""
    clean = F.translate(text, NUMBER + NAME + UNIT + END, "    ")
    numbers = F.regexp_replace(clean, r"\p{Nd}+(?:[.,:/]\p{Nd}+)*", f"{NUMBER}$0{END}")
    listed = "|".join(u.replace("$", r"\$") for u in sorted(UNITS, key=len, reverse=True))
    units = F.regexp_replace(
        numbers, rf"{END}(\s?)((?i:{listed}))(?![\p{{L}}\p{{N}}])", f"{END}$1{UNIT}$2{END}"
    )
    if names:
        units = F.regexp_replace(units, r"\p{Lu}(?<=[^.!?\s]\s.)\p{L}*", f"{NAME}$0{END}")
    return F.lower(units)


def tokens(text: Column, names: bool = True) -> Column:
    """Template tokens; placeholders still carry their values. Without ``names`` these are plain
    words, and letter case changes nothing."""
    pattern = rf"[{NUMBER}-{UNIT}][^{END}]*{END}|[\p{{L}}\p{{N}}]+"
    return F.regexp_extract_all(_marked(text, names), F.lit(pattern), F.lit(0))


def is_slot(token: Column) -> Column:
    return token.between(NUMBER, END)


def _both(text: Column) -> Column:
    """The readings of a text, with and without names as placeholders, as (names, words)."""
    return F.array(
        *[F.struct(F.lit(n).alias("names"), tokens(text, n).alias("words")) for n in (True, False)]
    )


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pairs(hashes: Column, apart: int) -> Column:
    """For each place the hash of what is there and what is ``apart`` places on."""
    return F.zip_with(
        hashes, F.slice(hashes, apart + 1, F.size(hashes)), lambda a, b: F.xxhash64(a, b)
    )


def window_hashes(words: Column, size: int, values: bool = False) -> Column:
    """Hashes of all windows of ``size`` template tokens, in order. Empty if there are fewer.
    With ``values`` placeholders are told apart by what they stand for."""

    def cut(found: Column, of: Column) -> Column:
        return F.slice(found, 1, F.greatest(F.size(of) - (size - 1), F.lit(0)))

    def hashed(token: Column) -> Column:
        if values:
            return F.xxhash64(token)
        return F.xxhash64(F.when(is_slot(token), F.substring(token, 1, 1)).otherwise(token))

    def doubled(h1: Column) -> Column:
        return cut(
            _with(_pairs(h1, 1), lambda h2: _with(_pairs(h2, 2), lambda h4: _pairs(h4, 4))), h1
        )

    def plain(h1: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(h1), F.lit(1)))
        return cut(F.transform(at, lambda i: F.xxhash64(F.slice(h1, i, size))), h1)

    return _with(F.transform(words, hashed), doubled if size == 8 else plain)


def _items(benchmark: DataFrame, id_col: str, text_col: str, scratch: Scratch):
    """Items with their tokens in both readings, the (names, size) of their windows, the distinct
    windows with the first place of each, and the starts of items without any window."""
    text = whole_text(f"`{text_col}`")
    items = (
        benchmark.select(F.col(f"`{id_col}`").alias("item_id"), text.alias("text"))
        .distinct()
        .select("item_id", F.xxhash64("item_id", "text").alias("item"), F.inline(_both(F.col("text"))))
        .where(F.size("words") > 0)
        .withColumn("size", F.least(F.size("words"), F.lit(WINDOW)))
    )
    items = scratch.write(items)
    long = items.where(F.size("words") >= LEAST_ITEM)
    sizes = sorted(tuple(r) for r in long.select("names", "size").distinct().collect())
    found = None
    for names, size in sizes:  # 1 to WINDOW, in both readings
        literal = F.size(
            F.filter(F.slice("words", F.col("at") + 1, size), lambda t: ~is_slot(t))
        )
        one = (
            long.where((F.col("names") == names) & (F.col("size") == size))
            .select("item", "names", "words", "size", F.posexplode(window_hashes(F.col("words"), size)).alias("at", "hash"))
            .where(literal * 2 >= size)  # windows of little but placeholders say nothing
            .groupBy("item", "names", "size", "hash")
            .agg(F.min("at").alias("item_at"))
        )
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = items.selectExpr("item", "names", "size", "0L AS hash", "0 AS item_at").limit(0)
    windows = scratch.write(found)
    left = items.where(~F.col("names")).join(windows.select("item").distinct(), "item", "left_anti")
    starts = None
    for size in range(1, WINDOW + 1):
        first = F.element_at(window_hashes(F.slice("words", 1, size), size, True), 1)
        one = left.where(F.col("size") == size).select("item", "size", first.alias("hash"))
        starts = one if starts is None else starts.unionByName(one)
    return items, sizes, windows, scratch.write(starts)


def _whole(rows: DataFrame, items: DataFrame, starts: DataFrame, scratch: Scratch) -> DataFrame:
    """Documents with all tokens of an item without windows in a row, values included. Documents
    that hold an item's start (``WINDOW`` tokens or all) are compared with all of it."""
    small = starts.count() <= BROADCAST_WINDOWS
    met = None
    for size in sorted(r[0] for r in starts.select("size").distinct().collect()):
        found = window_hashes(tokens(F.col("text"), False), size, True)
        one = rows.select("key", F.posexplode(found).alias("at", "hash"))
        listed = starts.where(F.col("size") == size).select("item", "hash")
        one = one.join(F.broadcast(listed) if small else listed, "hash").select("key", "item", "at")
        met = one if met is None else met.unionByName(one)
    met = scratch.write(met.groupBy("key", "item").agg(F.collect_set("at").alias("places")))
    keys = scratch.write(met.select("key").distinct())
    texts = semi_join_listed(rows, keys, "key").dropDuplicates(["key"])
    texts = texts.select("doc_id", "key", tokens(F.col("text"), False).alias("doc_words"))
    same = F.exists(
        "places", lambda at: F.slice("doc_words", at + 1, F.size("words")) == F.col("words")
    )
    slots = F.size(F.filter("words", is_slot))
    one = F.lit(1).cast("long")
    return (
        met.join(texts, "key")
        .join(items.where(~F.col("names")).select("item", "item_id", "words"), "item")
        .where(same)
        .select(
            "doc_id",
            "item_id",
            "key",
            one.alias("windows"),
            one.alias("found"),
            F.lit(1.0).alias("coverage"),
            slots.alias("slots"),
            F.lit(0).alias("changed_slots"),
            F.lit("exact").alias("kind"),
            F.lit(True).alias("contaminated"),
        )
    )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that share enough windows: doc_id, item_id, key
    (of the document row, see ``common.row_key``), windows (of the item), found, coverage, slots,
    changed_slots, kind and contaminated.

    Null texts are empty; documents and items without words give no rows, and so do empty
    tables. Items without a window count as one window, which is the whole item with its values. Rows that repeat a document's identifier and text count once, and so do repeated
    items. All windows of all documents are looked up, in both readings. The row tells of the
    reading in which the document is contaminated; if it is in both or in none, of the one with
    names as placeholders, where that makes it a suspect.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    items, sizes, windows, starts = _items(benchmark, item_id, item_text, scratch)
    text = whole_text(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).withColumn(
        "key", F.xxhash64("doc_id", "text")
    )
    schema = (
        "doc_id {0}, item_id {1}, key long, windows long, found long, coverage double, "
        "slots int, changed_slots int, kind string, contaminated boolean"
    ).format(docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString())
    whole = spark.createDataFrame([], schema)
    if not starts.isEmpty():
        whole = _whole(rows, items, starts, scratch)
    if not sizes:
        return whole
    small = windows.count() <= BROADCAST_WINDOWS
    matched = None
    for names, size in sizes:
        found = window_hashes(tokens(F.col("text"), names), size)
        one = rows.select("key", F.posexplode(found).alias("at", "hash"))
        listed = windows.where((F.col("names") == names) & (F.col("size") == size))
        listed = listed.select("item", "names", "hash", "item_at")
        one = one.join(F.broadcast(listed) if small else listed, "hash")
        matched = one if matched is None else matched.unionByName(one)
    matched = scratch.write(matched.select("key", "item", "names", "hash", (F.col("at") - F.col("item_at")).alias("shift"), (F.col("item_at") == 0).alias("first")))

    each = ["key", "item", "names"]
    totals = windows.groupBy("item", "names").agg(F.count(F.lit(1)).alias("windows"))
    shifts = matched.groupBy(*each, "shift").agg(F.count(F.lit(1)).alias("n"))
    best = shifts.groupBy(*each).agg(
        F.max(F.struct("n", -F.abs("shift"), "shift")).getField("shift").alias("shift")
    )
    found = matched.groupBy(*each).agg(F.count_distinct("hash").alias("found"), F.max("first").alias("first"))
    # an item's first word is a name inside a sentence: where both readings meet the item, this
    # alone makes no suspect (at most two rows per window)
    cased = F.max(F.when(F.col("names"), F.col("found"))).over(Window.partitionBy("key", "item"))
    more = F.when(~F.col("names") & F.col("first") & (cased > 0), 1).otherwise(0)
    suspects = scratch.write(
        found.join(totals, ["item", "names"])
        .withColumn("coverage", F.col("found") / F.col("windows"))
        .withColumn("without", (F.col("found") - more) / F.col("windows"))
        .where(F.col("without") >= COVERAGE)
        .drop("first", "without")
        .join(best, each)
    )
    keys = scratch.write(suspects.select("key").distinct())
    texts = semi_join_listed(rows, keys, "key").dropDuplicates(["key"])
    texts = texts.select("doc_id", "key", F.inline(_both(F.col("text"))).alias("names", "doc_words"))
    scratch.drop(matched)

    ahead, behind = F.greatest("shift", F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    common = F.greatest(
        F.least(F.size("words") - behind, F.size("doc_words") - ahead), F.lit(0)
    )
    pairs = F.filter(
        F.zip_with(
            F.slice("words", behind + 1, common),
            F.slice("doc_words", ahead + 1, common),
            lambda a, b: F.struct(a.alias("a"), b.alias("b")),
        ),
        lambda p: is_slot(p["a"]) & (F.substring(p["a"], 1, 1) == F.substring(p["b"], 1, 1)),
    )
    links = F.size(F.array_distinct("pairs"))
    one_to_one = (links == F.size(F.array_distinct("pairs.a"))) & (
        links == F.size(F.array_distinct("pairs.b"))
    )
    changed = F.size(F.filter("pairs", lambda p: p["a"] != p["b"]))
    kind = F.when(changed == 0, "exact").when(one_to_one, "reparameterised").otherwise("conflicting")
    judged = (
        suspects.join(texts, ["key", "names"])
        .join(items.select("item", "names", "item_id", "words"), ["item", "names"])
        .withColumn("pairs", pairs)
        .withColumn("kind", kind)
        .select(
            "doc_id",
            "item_id",
            "key",
            "windows",
            "found",
            "coverage",
            F.size("pairs").alias("slots"),
            changed.alias("changed_slots"),
            "kind",
            ((F.col("kind") != "conflicting") | (F.col("coverage") >= CLEAR)).alias("contaminated"),
            "item",
            "names",
        )
    )
    names = [c for c in judged.columns if c not in ("item", "names")]
    best = F.max_by(F.struct(*names), F.struct("contaminated", "names"))
    found = judged.groupBy("key", "item").agg(best.alias("best")).select("best.*")
    return found.unionByName(whole)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a leak; all columns, rows and repeats of clean documents stay."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.write(leaks(docs, benchmark).where("contaminated").select("key").distinct())
    return without_keys(docs, found)
