"""Packing of tokenised documents into sequences by a grouping genetic algorithm.

Documents are tokenised and cut into pieces; full pieces are sequences of their own. The rest is
dealt evenly over islands of bounded size. Pieces of the same length are interchangeable, so an
island's individual is a multiset of bins, each bin a pattern of lengths, within the island's
supply of each length. Crossover takes whole well-filled bins of one parent into the other,
removes the bins whose documents are thereby doubled, and best-fits the displaced ones. Between
epochs each island sends the well-filled bins of its best individual to the next one, which uses
them in crossover as far as its own supply allows. The last epoch's best bins are given to the
pieces; what lies in poorly filled bins is pooled and packed once more on fewer islands.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_right
from collections import ChainMap, Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import Scratch, whole_text

CAPACITY = 1024
END_ID = 2

# Pieces per island, individuals per island, generations per epoch, epochs.
ISLAND_PIECES = 16_384
POPULATION = 6
GENERATIONS = 12
EPOCHS = 2

# Tasks of an epoch at most.
MOST_TASKS = 10_000

# Bins at least this full are passed on by crossover and migration; of the last epoch's bins,
# those less full than OPEN are packed again.
WELL_FILLED = 0.995
OPEN = 0.95

# Words whose ids a worker remembers, and how long they may be; about 200 bytes each.
REMEMBERED = 700_000
LONGEST_WORD = 64

# Files of one vocabulary: for tokenizers, and as ranks.
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

PIECES = "doc_id long, item long, piece int, start long, length long, ids_crc32 long"


class _Ids:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    Byte-level BPE never joins a word with what precedes its space, nor a line break with the
    word after it, so texts with single spaces and line breaks are put together from their
    words' ids, which are remembered. Other texts are tokenised whole, and so are those that
    hold the string of an added token such as ``<|endoftext|>``, which the tokenizer reads as it.

    New words are encoded by tiktoken from the same vocabulary, several times faster than by
    tokenizers and with the same ids (tested); a line break between them, which is a token of
    its own, tells them apart again.
    """

    def __init__(self, path: str, ranks: str) -> None:
        import base64
        import os

        import public_tokenizers
        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.words = tiktoken.Encoding(
            "words",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
            special_tokens={},
        )
        (self.line_break,) = self.words.encode_ordinary("\n")
        self.known: dict[str, bytes] = {}

    def each(self, words: list[str]) -> list[bytes]:
        """Ids of words without line breaks."""
        ids = np.asarray(self.words.encode_ordinary("\n".join(words)), dtype="<u4")
        data, breaks = ids.tobytes(), np.flatnonzero(ids == self.line_break) * 4
        starts = [0, *(breaks + 4).tolist()]
        return [data[a:b] for a, b in zip(starts, [*breaks.tolist(), len(data)], strict=True)]

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.asarray(x.ids, dtype="<u4").tobytes() for x in found]

    def split(self, text: str) -> list[str] | None:
        """The parts of a text: words with the space before them, words without one marked with
        a null character, and line breaks. None if its white space is of another kind."""
        if not text or "\0" in text or any(t in text for t in self.added):
            return None
        parts = ("\0" + text.replace("\n", " \n \0")).split(" ")
        white = len(text) - sum(map(len, text.split()))
        plain = white == text.count(" ") + text.count("\n")
        return parts if plain and "" not in parts and "\0" not in parts else None

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        if not known:
            known["\n"] = np.asarray([self.line_break], dtype="<u4").tobytes()
        new = list(set().union(*[p for p in split if p is not None]) - known.keys())
        found: dict[str, bytes] = {}
        if new:
            plain = [p[1:] if p[0] == "\0" else " " + p for p in new]
            found = dict(zip(new, self.each(plain), strict=True))
            known.update((p, ids) for p, ids in found.items() if len(p) <= LONGEST_WORD)
        own = ChainMap(known, found) if any(len(p) > LONGEST_WORD for p in new) else known
        rest = iter(self.whole([t for t, p in zip(texts, split, strict=True) if p is None]))
        return [next(rest) if p is None else b"".join(map(own.__getitem__, p)) for p in split]


_ids: dict[str, _Ids] = {}  # one per worker process


def cut_pieces(
    docs: DataFrame, tokenizer: str, ranks: str, id_col: str, text_col: str
) -> DataFrame:
    """Pieces of all documents. A cut document's first piece takes the remainder."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = _ids.get(tokenizer) or _ids.setdefault(tokenizer, _Ids(tokenizer, ranks))
        item = TaskContext.get().partitionId() << 33
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                rows = []
                for doc, data in zip(part["doc_id"], ids(part["text"].tolist()), strict=True):
                    data += end
                    n = len(data) // 4
                    cuts = [0, *range(n % CAPACITY or min(n, CAPACITY), n + 1, CAPACITY)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        rows.append((doc, item, k, a, b - a, zlib.crc32(data[4 * a : 4 * b])))
                        item += 1
                out = pd.DataFrame(rows, columns=["doc_id", "item", "piece", "start", "length", "ids_crc32"])
                if whole_numbers:  # with a null among them pandas would make them floats
                    out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    id_type = docs.schema[id_col].dataType
    whole_numbers = isinstance(id_type, IntegralType)
    schema = PIECES.replace("doc_id long", f"doc_id {id_type.simpleString()}")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("text")
    )
    return rows.mapInPandas(pieces, schema)


# An individual: pattern (lengths, longest first) -> how many bins have it.
Bins = Counter


def fill(
    supply: dict[int, int], chance: random.Random | None = None, exact: bool = True
) -> Bins:
    """Pack a supply of lengths: each bin starts with the longest piece left and takes a piece
    or, with ``exact``, a pair that fills it where there is one, else the longest that fits.
    ``chance`` varies the choice of pair. Without ``exact`` this is first fit decreasing."""
    left = {n: k for n, k in supply.items() if k > 0}
    lengths = sorted(left)
    bins: Bins = Counter()
    have = np.zeros(CAPACITY + 1, dtype=bool)
    have[lengths] = True

    def take(n: int) -> None:
        left[n] -= 1
        if not left[n]:
            del left[n]
            lengths.pop(bisect_right(lengths, n) - 1)
            have[n] = False

    while lengths:
        pattern, room = [lengths[-1]], CAPACITY - lengths[-1]
        use = Counter(pattern)

        def free(n: int) -> bool:
            return left.get(n, 0) > use[n]

        while room > 0:
            if free(room):
                choice = [room]
            else:
                choice = None
                pairs = ()
                if exact:
                    pairs = np.flatnonzero(have[1:room] & have[room - 1 : 0 : -1]) + 1
                    pairs = pairs[pairs * 2 >= room]
                if len(pairs):
                    order = pairs[::-1] if chance is None else chance.sample(list(pairs), min(4, len(pairs)))
                    for a in order[:4]:
                        a = int(a)
                        b = room - a
                        if free(a) and left.get(b, 0) > use[b] + (a == b):
                            choice = [a, b]
                            break
                if choice is None:
                    at = bisect_right(lengths, room)
                    while at and not free(lengths[at - 1]):
                        at -= 1
                    if not at:
                        break
                    choice = [lengths[at - 1]]
            for n in choice:
                use[n] += 1
                pattern.append(n)
                room -= n
        times = min(left[n] // k for n, k in use.items())
        for n, k in use.items():
            left[n] -= k * times - 1
            take(n)
        bins[tuple(sorted(pattern, reverse=True))] += times
    return bins


def used(bins: Bins) -> Counter:
    """How many pieces of each length the bins hold."""
    out: Counter = Counter()
    for pattern, times in bins.items():
        for n in pattern:
            out[n] += times
    return out


def fitness(bins: Bins) -> tuple[int, float]:
    """Fewer bins first; then bins of unequal fill, as a bin that is almost empty can go."""
    return -sum(bins.values()), sum(k * (sum(p) / CAPACITY) ** 2 for p, k in bins.items())


def crossover(supply: Counter, base: Bins, guest: Bins, chance: random.Random) -> Bins:
    """``base`` with well-filled bins of ``guest`` injected. Bins of ``base`` that share a
    document with them go, worst-filled first, and what they held is packed again together with
    the content of a few badly filled bins."""
    left = Counter(supply)
    child: Bins = Counter()

    def place(pattern: tuple[int, ...], times: int) -> None:
        need = Counter(pattern)
        times = min([times, *(left[n] // k for n, k in need.items())])
        if times > 0:
            child[pattern] += times
            for n, k in need.items():
                left[n] -= k * times

    for pattern, times in guest.items():
        if sum(pattern) >= WELL_FILLED * CAPACITY and chance.random() < 0.5:
            place(pattern, times)
    stay = sorted(base.items(), key=lambda x: (-sum(x[0]), x[0]))
    for pattern, times in stay:
        if sum(pattern) >= WELL_FILLED * CAPACITY and chance.random() < 0.97:
            place(pattern, times)
    return child + fill(left, chance, exact=chance.random() < 0.7)


def least_bins(supply: Counter) -> int:
    """A lower bound: for each length q, pieces too long to share a bin with one of length q or
    more, pieces of over half a bin, and what of the others does not fit beside these."""
    count = np.zeros(CAPACITY + 2, dtype=np.int64)
    for n, k in supply.items():
        count[n] = k
    upto = np.concatenate(([0], np.cumsum(count)))  # pieces shorter than the index
    sums = np.concatenate(([0], np.cumsum(count * np.arange(len(count)))))
    half, best = CAPACITY // 2, 0
    for q in range(half + 1):
        alone = upto[-1] - upto[CAPACITY - q + 1]
        large = upto[CAPACITY - q + 1] - upto[half + 1]
        room = large * CAPACITY - (sums[CAPACITY - q + 1] - sums[half + 1])
        rest = sums[half + 1] - sums[q]
        best = max(best, alone + large + max(0, -((room - rest) // CAPACITY)))
    return int(best)


def evolve(supply: Counter, population: list[Bins], guests: list[Bins], seed: int) -> list[Bins]:
    """Some generations of an island; the best individual comes first."""
    chance = random.Random(seed)
    bound = least_bins(supply)
    people = population or [
        fill(supply, exact=False),
        fill(supply),
        *(fill(supply, chance) for _ in range(POPULATION - 2)),
    ]
    people.sort(key=fitness, reverse=True)
    for step in range(GENERATIONS):
        if sum(people[0].values()) <= bound:
            break
        base = people[chance.randrange(max(1, len(people) // 2))]
        guest = guests[step % len(guests)] if guests and step % 2 == 0 else chance.choice(people)
        people.append(crossover(supply, base, guest, chance))
        people.sort(key=fitness, reverse=True)
        del people[POPULATION:]
    return people


STATE = "island long, person int, pattern array<int>, times long"


def _epoch(last: bool):
    """Evolve one island. Rows: person -1 is the supply, -2 what migrated, others people."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        people: dict[int, Bins] = {}
        for person, pattern, times in zip(rows["person"], rows["pattern"], rows["times"], strict=True):
            people.setdefault(int(person), Counter())[tuple(int(n) for n in pattern)] += int(times)
        supply = Counter({p[0]: k for p, k in people.pop(-1, Counter()).items()})
        guests = [people.pop(-2)] if -2 in people else []
        best = evolve(supply, [people[k] for k in sorted(people)], guests, int(key[0]))
        out = [(k, p, t) for k, one in enumerate(best[: 1 if last else None]) for p, t in one.items()]
        if not last:
            out += [(-1, (n,), k) for n, k in supply.items()]
        return pd.DataFrame(
            {
                "island": int(key[0]),
                "person": [x[0] for x in out],
                "pattern": [list(x[1]) for x in out],
                "times": [x[2] for x in out],
            }
        )

    return run


def _assign(key: tuple, items: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
    """Give an island's bins to its pieces."""
    stacks: dict[int, list[int]] = {}
    for item, n in zip(items["item"], items["length"], strict=True):
        stacks.setdefault(int(n), []).append(int(item))
    out, number = [], 0
    bins = sorted((tuple(int(n) for n in p), int(t)) for p, t in zip(plan["pattern"], plan["times"], strict=True))
    for pattern, times in bins:
        open_bin = sum(pattern) < OPEN * CAPACITY
        for _ in range(times):
            offset = 0
            for n in pattern:
                out.append((stacks[n].pop(), number, offset, open_bin))
                offset += n
            number += 1
    found = pd.DataFrame(out, columns=["item", "bin", "offset", "open"])
    found["island"] = int(key[0])
    return found


def _pack(items: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(item, island, bin, offset, open) for rows of (item, length)."""
    count = items.count()  # of a written table
    islands = max(1, -(-count // ISLAND_PIECES))
    dealt = items.select("item", "length", F.pmod(F.xxhash64("item"), F.lit(islands)).alias("island"))
    supply = dealt.groupBy("island", "length").agg(F.count(F.lit(1)).alias("times"))
    state = supply.select(
        "island",
        F.lit(-1).alias("person"),
        F.array(F.col("length").cast("int")).alias("pattern"),
        "times",
    )
    # islands are small in bytes and long in time, so their number decides on the tasks
    tasks = min(islands, MOST_TASKS)
    for epoch in range(EPOCHS):
        evolved = state.repartition(tasks, "island").groupBy("island")
        state = scratch.write(evolved.applyInPandas(_epoch(epoch == EPOCHS - 1), STATE))
        if epoch < EPOCHS - 1:
            filled = F.aggregate("pattern", F.lit(0), lambda a, n: a + n)
            elite = state.where((F.col("person") == 0) & (filled >= WELL_FILLED * CAPACITY))
            moved = elite.withColumn("island", F.pmod(F.col("island") + 1, F.lit(islands)))
            state = state.unionByName(moved.withColumn("person", F.lit(-2))) if islands > 1 else state
    pieces, bins = (df.repartition(tasks, "island").groupBy("island") for df in (dealt, state))
    placed = pieces.cogroup(bins).applyInPandas(
        _assign, "item long, bin long, offset long, open boolean, island long"
    )
    return scratch.write(placed), islands


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    ranks: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id and offset.

    A document is its ids and the end id 2; only documents of more than 1024 are cut, and their
    first piece is the shorter one. A null text is empty and becomes one piece of length 1.
    Sequences have no gaps and at most 1024 ids. Repeated rows and equal identifiers are packed
    row by row; an empty table gives an empty result.
    """
    if tokenizer is None or ranks is None:
        import public_tokenizers

        tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
        ranks = ranks or public_tokenizers.path(RANKS)
    scratch = Scratch(docs.sparkSession)
    pieces = scratch.write(cut_pieces(docs, tokenizer, ranks, id_col, text_col))
    rest = pieces.where(F.col("length") < CAPACITY)
    first, islands = _pack(rest, scratch)
    done = first.where(~F.col("open") if islands > 1 else F.lit(True)).withColumn("level", F.lit(1))
    if islands > 1:
        again = scratch.write(rest.join(first.where("open"), "item", "left_semi").select("item", "length"))
        second, _ = _pack(again, scratch)
        done = done.unionByName(second.withColumn("level", F.lit(2)))
    number = -(1 + F.col("bin") + F.shiftleft(F.col("island") * 2 + (F.col("level") - 1), 20))
    done = done.select("item", number.alias("sequence_id"), "offset")
    full = pieces.where(F.col("length") == CAPACITY)
    columns = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    placed = rest.join(done, "item").unionByName(
        full.withColumns({"sequence_id": F.col("item"), "offset": F.lit(0).cast("long")})
    )
    return placed.select(F.col("doc_id").alias(id_col), *columns)
