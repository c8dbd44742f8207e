"""Spelling variants: words one edit apart, and the frequent word each of them stands for.

Occurrences are counted per word, on the map side first. Two words one edit apart, the shorter one
of ``m`` code points, agree on all before the edit and all after it; so they agree on the first
half of the shorter one or on the rest of it. Words are dealt by such agreed parts: for each of
the two lengths ``m`` a word can have a partner by, a row for the window before the middle and one
for the window after it. A pair is counted in exactly one window, the one in which its first
difference lies. Where many words agree, the window is halved again, down to single places: two
letters at most are then free, so no group outgrows the alphabet's pairs.

Within a group the words are a sorted list. Each word in turn is compared with the list by rows of
an edit matrix with a band of three cells; the rows of the prefix that a word shares with the one
before it are kept, and as soon as a row exceeds one edit, all words with that prefix are skipped.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.spread import spread_join

from .common import Scratch

LEAST_LENGTH = 6
LEAST_COUNT = 5

# A form has at least so many times the occurrences of its variant.
TIMES = 5

# One in so many (document, run) hashes has a code point deleted.
DELETE_ONE_IN = 199

# Words of a group that are compared in one task; larger groups are split.
MOST_IN_GROUP = 2_000

# Distinct words that a counting task holds before it passes them on.
HELD = 200_000


def _count(least_length: int, one_in: int | None):
    """The pandas function that counts the words of documents."""
    # runs of fewer letters cannot become words, and a match of so many letters is a maximal run
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def rows(held: Counter) -> pd.DataFrame:
        return pd.DataFrame({"word": list(held.keys()), "n": list(held.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch["id"], batch["text"], strict=True):
                found = Counter(runs.findall(text.encode().lower().decode()))
                if one_in is None:
                    held.update(found)
                else:
                    start = zlib.crc32(f"{doc}:".encode())
                    for word, n in found.items():
                        h = zlib.crc32(word.encode(), start)
                        if not h % one_in:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                        held[word] += n
                if len(held) > HELD:
                    yield rows(held)
                    held.clear()
        if held:
            yield rows(held)

    return count


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    delete_one_in: int | None = None,
) -> DataFrame:
    """(word, n): words of at least ``least_length`` letters, A-Z lower-cased, with at least
    ``least_count`` occurrences. With ``delete_one_in`` the runs whose hash it divides lose a
    letter first, by their document's identifier (an empty string if null)."""
    rows = docs.where(F.col(f"`{text_col}`").isNotNull()).select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        F.col(f"`{text_col}`").alias("text"),
    )
    parts = rows.mapInPandas(_count(least_length, delete_one_in), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _windows(words: DataFrame) -> DataFrame:
    """Rows (word, n, m, lo, hi): for the length of the word and the one below, the windows
    before and after the middle of the shorter word."""
    return (
        words.withColumn("m", F.explode(F.array(F.length("word") - 1, F.length("word"))))
        .withColumns({"lo": F.lit(0), "hi": F.col("m")})
        .transform(_halved)
    )


def _halved(rows: DataFrame) -> DataFrame:
    """The two halves of each row's window."""
    lo, hi = F.col("lo"), F.col("hi")
    middle = F.floor((lo + hi) / 2).cast("int")
    half = F.explode(
        F.array(
            F.struct(lo.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), hi.alias("hi"))
        )
    )
    return rows.withColumn("half", half).select("word", "n", "m", "half.lo", "half.hi")


def _key() -> Column:
    """What the words of a group agree on: all before the window and all after it."""
    word, m, lo, hi = (F.col(c) for c in ("word", "m", "lo", "hi"))
    head = F.substring(word, F.lit(1), lo)
    tail = F.substring(word, F.length(word) - (m - hi) + 1, m - hi)
    return F.concat_ws(" ", m, lo, hi, head, tail)


def _common(a: str, b: str) -> int:
    """How many code points two words begin with alike."""
    n = min(len(a), len(b))
    for k in range(n):
        if a[k] != b[k]:
            return k
    return n


def one_edit_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """Places (i, j), i < j, of words exactly one edit apart in a sorted list of distinct words.

    Row d of a word's edit matrix holds the edits from its first d code points to the first
    d - 1, d and d + 1 of the query. A row depends on the prefix only, so rows are kept as far
    as the next word begins alike; and no longer prefix can do with fewer edits than the least
    of its row, so a prefix beyond one edit skips all words that begin with it.
    """
    shared = [0, *(_common(a, b) for a, b in zip(words, words[1:], strict=False))]
    far = 2
    for i, query in enumerate(words):
        m = len(query)
        rows = [(far, 0, 1)]  # of the empty prefix
        j = i + 1
        keep = 0  # code points that word j shares with the rows' word
        while j < len(words):
            word = words[j]
            del rows[keep + 1 :]
            depth = len(rows)
            size = len(word)
            beyond = 0
            while depth <= size:
                a, b, c = rows[-1]
                letter = word[depth - 1]
                # query prefixes of depth - 1, depth and depth + 1 code points
                x = min(a + (letter != query[depth - 2]), b + 1) if 2 <= depth <= m + 1 else b + 1
                if depth > m + 1:
                    x = far
                y = min(b + (letter != query[depth - 1]), c + 1, x + 1) if depth <= m else far
                z = min(c + (letter != query[depth]), y + 1) if depth + 1 <= m else far
                rows.append((x, y, z))
                if x > 1 and y > 1 and z > 1:
                    beyond = depth
                    break
                depth += 1
            if beyond:
                j_next = bisect_left(words, word[:beyond] + "\U0010ffff", j + 1)
            else:
                at = m - size  # the cell of the whole query in the last row
                if -1 <= at <= 1 and rows[size][at + 1] == 1:
                    yield i, j
                j_next = j + 1
            if j_next < len(words):
                # what the next word shares with this one: the least of the steps between
                keep = min(shared[j_next], beyond - 1) if beyond else shared[j_next]
                keep = min(keep, len(rows) - 1)
            j = j_next


def _compare(words: list[str], counts: list[int], m: int, lo: int, hi: int) -> list[tuple]:
    """For the words of one group, in order, that are near another one: the word, how many are
    near it, and the most frequent of these."""
    near: dict[int, int] = {}
    best: dict[int, tuple[int, int]] = {}
    for i, j in one_edit_pairs(words):
        if min(len(words[i]), len(words[j])) != m:
            continue  # the pair is one of the next length's
        first = _common(words[i], words[j])
        if not (lo <= first < hi or first == hi == m):
            continue  # the pair counts in another window
        for p, q in ((i, j), (j, i)):
            near[p] = near.get(p, 0) + 1
            best[p] = min(best.get(p, (0, 0)), (-counts[q], q))  # places ascend as words do
    return [(words[p], near[p], -best[p][0], words[best[p][1]]) for p in near]


def _compare_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Groups that follow one another in a sorted partition; the one being read is held back."""
    key, window, words, counts, out = None, (0, 0, 0), [], [], []
    columns = ["word", "n_near", "best_n", "best"]
    for batch in batches:
        for k, word, n, *place in batch.itertuples(index=False, name=None):
            if k != key:
                if len(words) > 1:
                    out += _compare(words, counts, *window)
                key, window, words, counts = k, place, [], []
            words.append(word)
            counts.append(n)
        if out:
            yield pd.DataFrame(out, columns=columns)
            out = []
    if len(words) > 1 and (out := _compare(words, counts, *window)):
        yield pd.DataFrame(out, columns=columns)


def near_words(
    words: DataFrame, scratch: Scratch, most_in_group: int = MOST_IN_GROUP
) -> DataFrame:
    """For words (word, n; distinct, a written table) with words one edit away: word, n_near,
    and the one of them with the largest n (of equal ones the first in code-point order)."""
    rows, found = _windows(words).withColumn("key", _key()), None
    while True:
        sizes = rows.groupBy("key", "lo", "hi").agg(F.count(F.lit(1)).alias("size"))
        wide = (F.col("size") > most_in_group) & (F.col("hi") - F.col("lo") > 1)
        large = scratch.write(sizes.where(wide).select("key"))
        none = large.isEmpty()
        here = rows if none else spread_join(rows, large, ["key"], "left_anti")
        part = (
            here.select("key", "word", "n", "m", "lo", "hi")
            .repartition("key")
            .sortWithinPartitions("key", "word")
            .mapInPandas(_compare_groups, "word string, n_near long, best_n long, best string")
        )
        found = scratch.write(part) if found is None else found.unionByName(scratch.write(part))
        if none:
            break
        again = spread_join(rows, large, ["key"], "left_semi").drop("key")
        rows = scratch.write(again.transform(_halved).withColumn("key", _key()))
    best = F.min_by(F.struct("best", "best_n"), F.struct(-F.col("best_n"), F.col("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.best").alias("best"), F.col("best.best_n").alias("best_n")
    )


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) for words (word, form): forms followed to the last. A form has several
    times its variant's count, so there are no circles; each round doubles the steps taken."""
    way = scratch.write(forms.select("word", F.col("form").alias("root")))
    while True:
        further = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = scratch.write(spread_join(way, further, ["root"], "left"))
        done = after.where(F.col("next").isNotNull()).isEmpty()
        scratch.drop(way)
        if done:
            return after.select("word", "root")
        way = scratch.write(after.select("word", F.coalesce("next", "root").alias("root")))
        scratch.drop(after)


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    delete_one_in: int | None = None,
    most_in_group: int = MOST_IN_GROUP,
) -> DataFrame:
    """One row per word of ``docs``: word, form, root, n, n_near, form_n.

    Words are runs of the letters A-Z and U+00C0 to U+00FF, of at least ``least_length`` and with
    at least ``least_count`` occurrences. ``form`` is the most frequent word one edit away, if it
    occurs at least ``times`` times as often, else null; ``root`` is the end of the way from form
    to form (the word itself if it has none). Null and empty texts have no words, whole texts of
    any length count, and repeated rows count each. An empty table gives an empty result.
    """
    if times < 2:
        raise ValueError("times must be 2 or more, else forms could go in circles")
    scratch = Scratch(docs.sparkSession)
    words = scratch.write(
        word_counts(docs, id_col, text_col, least_length, least_count, delete_one_in)
    )
    near = near_words(words, scratch, most_in_group)
    clear = F.col("best_n") >= F.col("n") * times
    formed = scratch.write(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(clear, F.col("best")).alias("form"),
            F.when(clear, F.col("best_n")).alias("form_n"),
        )
    )
    ends = roots(formed.where(F.col("form").isNotNull()), scratch)
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
