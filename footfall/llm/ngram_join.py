"""Self-join of documents on the Jaccard similarity of their word shingles.

Copies (equal shingle sets) fall together first. The signatures of the rest are the label
sequences of a MinHash LSH forest: ``TREES`` prefix tries of ``LABELS`` labels each. A trie is
kept as its sorted sequences: texts of one branch lie next to each other, and the labels that
neighbours have in common are the depth at which they part. Branches are walked from the full
sequences upwards: texts with all labels in common are candidates first, then the matched prefix
is shortened label by label, and each time texts that did not meet before are compared. A branch
stops being widened as soon as all its texts are of one family, for families are verified pair by
pair; the others are widened up to the prefix at which a pair at the threshold is found with the
target recall. Candidates whose whole signatures are too far apart are dropped; the rest link
texts to families.

The forest is dealt by its branches at the shortest prefix. A branch of many texts is cut into
blocks by a hash that differs from tree to tree, so that the families of its blocks meet in the
other trees; only if they did not, its blocks are compared with each other. Within families all
pairs are verified on their exact shingle sets, large families as blocks of bounded size, and
only counts and spanning links leave a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, semi_join_listed, whole_text, without_keys
from .components import components, split_join
from .shingles import minima, mixed, numbers, shingle_sets

THRESHOLD = 0.8
RECALL = 0.999
TREES, LABELS = 16, 8

# How many standard deviations below the mean a pair's agreeing labels may lie: a pair at the
# threshold has fewer once in some millions of pairs.
DEVIATIONS = 5

# Texts, and shingles, of one block of a family or trie node.
BLOCK_TEXTS = 1024
BLOCK_SHINGLES = 1_500_000

_SEEDS = numbers(TREES * LABELS, 3)


def prefix_length(threshold: float, recall: float, trees: int = TREES, most: int = LABELS) -> int:
    """Labels of the longest prefix that finds a pair at the threshold with the target recall."""
    length = most
    while length > 1 and 1 - (1 - threshold**length) ** trees < recall:
        length -= 1
    return length


def least_agreeing(threshold: float, labels: int = TREES * LABELS) -> float:
    """Labels in which a pair at the threshold agrees at least, but for very few."""
    spread = (threshold * (1 - threshold) * labels) ** 0.5
    return max(1.0, threshold * labels - DEVIATIONS * spread)


def _signatures(rows: DataFrame, length: int) -> DataFrame:
    """Per row: set_id (digest of its shingle set), n, its branch of each tree at the prefix, and
    the label sequences of all trees, two bytes a label."""
    places = numbers(length, 4)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                sets = shingle_sets(part["text"].tolist())
                full = [k for k, s in enumerate(sets) if len(s)]
                nodes: list = [[]] * len(sets)
                paths: list = [b""] * len(sets)
                if full:
                    labels = minima([sets[k] for k in full], _SEEDS)
                    trees = labels.reshape(len(full), TREES, LABELS)[:, :, :length]
                    tree = np.arange(TREES, dtype=np.uint64)
                    keys = mixed((trees * places).sum(axis=2, dtype=np.uint64) + tree).view(np.int64)
                    low = (mixed(labels) & np.uint64(65535)).astype(">u2")
                    for n, k in enumerate(full):
                        nodes[k], paths[k] = keys[n], low[n].tobytes()
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].to_numpy(),
                        "key": part["key"].to_numpy(),
                        "set_id": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                        "n": [len(s) for s in sets],
                        "nodes": nodes,
                        "paths": paths,
                    }
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(
        sign, f"doc_id {kind}, key long, set_id binary, n int, nodes array<long>, paths binary"
    )


def _groups(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a partition sorted by ``key``, one after the other."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch[k].to_numpy() for k in key]
        change = np.zeros(len(batch), dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change), len(batch)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            name = tuple(c[a] for c in columns)
            if held and name != last:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
                held = []
            held.append(batch.iloc[a:b])
            last = name
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


class _Forest:
    """Union of what is linked; gives the links that hold each set together."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def links(self) -> list[tuple[int, int]]:
        return [(a, r) for a in range(len(self.up)) if (r := self.root(a)) != a]


def _blocks(rows: DataFrame, key: str) -> DataFrame:
    """Rows of each key's blocks: with ``parts`` parts, one block for each pair of parts (and
    part with itself). Adds x, y (the block) and side (the row's part)."""
    return (
        rows.withColumn("side", _side("set_id"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("x", F.least("side", "other"))
        .withColumn("y", F.greatest("side", "other"))
        .drop("other", "parts")
        .repartition(key, "x", "y")
        .sortWithinPartitions(key, "x", "y")
    )


def _side(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.col("parts")).cast("int")


def _branch_blocks(rows: DataFrame, across: bool) -> DataFrame:
    """Blocks of branches, each in the order of its tree's sequences: every part of a branch by
    itself, or (``across``) every pair of different parts."""
    sided = rows.withColumn("side", _side("set_id", "node"))
    if across:
        sided = (
            sided.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .where("other <> side")
            .withColumn("x", F.least("side", "other"))
            .withColumn("y", F.greatest("side", "other"))
        )
    else:
        sided = sided.withColumn("x", F.col("side")).withColumn("y", F.col("side"))
    sequence = F.expr(f"substring(paths, tree * {2 * LABELS} + 1, {2 * LABELS})")
    return (
        sided.select("node", "x", "y", "side", "tree", "set_id", "family", "paths", sequence.alias("sequence"))
        .repartition("node", "x", "y")
        .sortWithinPartitions("node", "x", "y", "sequence")
        .drop("sequence")
    )


class _Branch:
    """The texts of one branch of a trie in the order of their label sequences, and the family
    each belongs to so far."""

    def __init__(self, group: pd.DataFrame, need: float) -> None:
        self.need = need
        self.ids = group["set_id"].to_numpy()
        self.marks = np.frombuffer(b"".join(group["paths"]), dtype=np.uint16).reshape(len(self.ids), -1)
        at = int(group["tree"].iloc[0]) * LABELS
        same = self.marks[1:, at : at + LABELS] == self.marks[:-1, at : at + LABELS]
        self.common = np.cumprod(same, axis=1).sum(axis=1)  # labels shared with the text before
        self.family = np.unique(group["family"].to_numpy(), return_inverse=True)[1]
        self.side = group["side"].to_numpy()
        self.across = group["x"].iloc[0] != group["y"].iloc[0]
        self.links: list[tuple[bytes, bytes]] = []

    def match(self, shortest: int) -> list[tuple[bytes, bytes]]:
        """Links between families, from the full sequences up to prefixes of ``shortest``."""
        n = len(self.ids)
        met = np.arange(n)  # the longer prefix's branch of each text
        for length in range(LABELS, shortest - 1, -1):
            begins = np.flatnonzero(np.concatenate(([True], self.common < length)))
            ends = np.append(begins[1:], n)
            for a, b in zip(begins[ends - begins > 1], ends[ends - begins > 1], strict=True):
                self._widen(a, b, met)
            met = np.repeat(np.arange(len(begins)), ends - begins)
        return self.links

    def _widen(self, a: int, b: int, met: np.ndarray) -> None:
        """Compare the texts of [a, b) that did not meet under a longer prefix, as long as they
        are of different families."""
        family, mine = self.family, self.family[a:b]
        for k in range(a, b - 1):
            if (mine == mine[0]).all():
                return
            new = (family[k + 1 : b] != family[k]) & (met[k + 1 : b] != met[k])
            if self.across:
                new &= self.side[k + 1 : b] != self.side[k]
            others = np.flatnonzero(new) + k + 1
            if not len(others):
                continue
            agree = (self.marks[others] == self.marks[k]).sum(axis=1) >= self.need
            for other in others[agree]:
                if family[other] != family[k]:
                    self.links.append((self.ids[other], self.ids[k]))
                    family[family == family[other]] = family[k]


def _near_signatures(need: float, shortest: int):
    """The pandas function that links the texts of branches whose signatures agree in ``need``
    labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple[bytes, bytes]] = []
        for group in _groups(batches, ["node", "x", "y"]):
            if len(group) > 1:
                out += _Branch(group, need).match(shortest)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=["a", "b"])
                out = []
        yield pd.DataFrame(out, columns=["a", "b"])

    return run


def _families(texts: DataFrame, shortest: int, need: float, scratch: Scratch) -> DataFrame:
    """(set_id, root): the texts that the forest links to others, by families."""
    placed = texts.select("set_id", F.posexplode("nodes").alias("tree", "node"))
    shared = scratch.write(
        placed.groupBy("node").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    )
    most = shared.agg(F.max("_rows")).first()[0] or 0
    parts = shared.select("node", F.ceil(F.col("_rows") / BLOCK_TEXTS).cast("int").alias("parts"))

    def linked(met: DataFrame, across: bool) -> DataFrame:
        # signatures join only after the texts that share no branch are gone; a sort-merge join at
        # any size, so that the volume moved grows with the texts and not with the plan
        blocks = _branch_blocks(met.join(texts.select("set_id", "paths").hint("merge"), "set_id"), across)
        return scratch.write(
            blocks.mapInPandas(_near_signatures(need, shortest), "a binary, b binary")
        )

    met = split_join(placed, parts, "node", most, shared)
    links = linked(met.withColumn("family", F.xxhash64("set_id")), False)
    families = scratch.write(components(links, scratch).withColumnRenamed("node", "set_id"))
    if most > BLOCK_TEXTS:
        cut = shared.where(F.col("_rows") > BLOCK_TEXTS)
        # all texts of the cut branches, with the families that their blocks gave them
        now = split_join(placed, cut.select("node"), "node", most, cut).join(
            families.hint("merge"), "set_id", "left"
        )
        family = F.xxhash64(F.coalesce("root", "set_id"))
        now = scratch.write(now.select("set_id", "tree", "node", family.alias("family")))
        open_ = scratch.write(
            now.groupBy("node")
            .agg(F.count(F.lit(1)).alias("_rows"), F.min("family").alias("low"), F.max("family").alias("high"))
            .where("low <> high")
            .select("node", "_rows")
        )
        before = [now, open_]
        if not open_.isEmpty():
            parts = open_.select("node", F.ceil(F.col("_rows") / BLOCK_TEXTS).cast("int").alias("parts"))
            more = linked(split_join(now, parts, "node", most, open_), True)
            stars = families.select(F.col("set_id").alias("a"), F.col("root").alias("b"))
            before += [families, more]
            families = components(stars.unionByName(more), scratch)
            families = scratch.write(families.withColumnRenamed("node", "set_id"))
        scratch.drop(*before)
    scratch.drop(shared, links)
    return families


def _linked(sets: list[np.ndarray], threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each set the later ones whose Jaccard similarity is at least the threshold."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) <= 8:
        for a in range(len(sets) - 1):
            found = [
                b
                for b in range(a + 1, len(sets))
                if (both := len(np.intersect1d(sets[a], sets[b], assume_unique=True)))
                / (sizes[a] + sizes[b] - both)
                >= threshold
            ]
            yield a, np.array(found, dtype=int)
        return
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(codes, kind="stable")
    posted = owner[order]
    begin = np.searchsorted(codes[order], np.arange(len(values) + 1))
    ends = np.cumsum(sizes)
    for a in range(len(sets) - 1):
        mine = codes[ends[a] - sizes[a] : ends[a]]
        n = begin[mine + 1] - begin[mine]
        shift = np.repeat(begin[mine] - (np.cumsum(n) - n), n)
        both = np.bincount(posted[shift + np.arange(len(shift))], minlength=len(sets))[a + 1 :]
        near = both / (sizes[a] + sizes[a + 1 :] - both) >= threshold
        yield a, np.flatnonzero(near) + a + 1


def _verify(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["a", "b", "texts", "docs"]
        out: list[tuple] = []
        for group in _groups(batches, ["root", "x", "y"]):
            ids = group["set_id"].to_numpy()
            sets = [np.frombuffer(s, dtype=np.uint64) for s in group["shingles"]]
            side, docs = group["side"].to_numpy(), group["n_docs"].to_numpy()
            across = group["x"].iloc[0] != group["y"].iloc[0]
            forest = _Forest(len(ids))
            texts, linked = np.zeros(len(ids), dtype=int), np.zeros(len(ids), dtype=int)
            for a, near in _linked(sets, threshold):
                if across:
                    near = near[side[near] != side[a]]
                texts[a] += len(near)
                linked[a] += docs[near].sum()
                texts[near] += 1
                linked[near] += docs[a]
                for b in near:
                    forest.join(a, int(b))
            out += [(ids[a], None, int(texts[a]), int(linked[a])) for a in np.flatnonzero(texts)]
            out += [(ids[a], ids[b], 0, 0) for a, b in forest.links()]
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    return run


def _shingles(rows: DataFrame) -> DataFrame:
    """The exact shingle sets of texts, as bytes."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                found = [s.tobytes() for s in shingle_sets(part["text"].tolist())]
                yield pd.DataFrame({"key": part["key"].to_numpy(), "shingles": found})

    return rows.select("key", "text").mapInPandas(cut, "key long, shingles binary")


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``docs``: id, class_id, n_links, n_texts, class_docs, key and keep.

    A class holds all documents that a chain of links connects, links being pairs of documents
    whose sets of five-word shingles have a Jaccard similarity of at least the threshold; class_id
    is its smallest identifier. n_links counts the linked documents, copies included, and
    n_texts the linked texts that differ. ``keep`` marks the document of each class with the
    smallest identifier (null last). Texts without words, null ones too, are linked to nothing.
    Rows that repeat identifier and text are counted each and marked alike. An empty table gives
    an empty result. A recall that the forest cannot reach at the threshold is an error.
    """
    length, need = prefix_length(threshold, recall), least_agreeing(threshold)
    if 1 - (1 - threshold**length) ** TREES < recall:
        raise ValueError(f"{TREES} trees cannot find pairs at {threshold} with a recall of {recall}")
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("text")
    ).withColumn("key", F.xxhash64("doc_id", "text"))
    signed = scratch.write(_signatures(rows, length))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")
    texts = scratch.write(
        signed.where("n > 0")
        .groupBy("set_id")
        .agg(
            first,
            F.count(F.lit(1)).alias("n_docs"),
            F.first("n").alias("n"),
            F.first("nodes").alias("nodes"),
            F.first("paths").alias("paths"),
        )
    )

    families = _families(texts, length, need, scratch)
    members = scratch.write(
        texts.select("set_id", "first.key", "n", "n_docs").join(families.hint("merge"), "set_id")
    )
    weight = F.greatest(F.count(F.lit(1)) / BLOCK_TEXTS, F.sum("n") / BLOCK_SHINGLES)
    parts = scratch.write(
        members.groupBy("root").agg(F.ceil(weight).cast("int").alias("parts"), F.count(F.lit(1)).alias("_rows"))
    )
    most = parts.agg(F.max("_rows")).first()[0] or 0
    keys = scratch.write(members.select("key").distinct())
    exact = _shingles(semi_join_listed(rows, keys, "key").dropDuplicates(["key"]))
    dealt = split_join(members, parts.select("root", "parts"), "root", most, parts)
    blocks = _blocks(dealt.join(exact, "key"), "root").select(
        "root", "x", "y", "side", "set_id", "n_docs", "shingles"
    )
    verified = scratch.write(
        blocks.mapInPandas(_verify(threshold), "a binary, b binary, texts long, docs long")
    )
    scratch.drop(families, members, parts, keys)

    classes = components(verified.where("b is not null").select("a", "b"), scratch)
    counts = verified.where("b is null").groupBy(F.col("a").alias("set_id")).agg(
        F.sum("texts").alias("texts"), F.sum("docs").alias("linked")
    )
    named = scratch.write(
        texts.select("set_id", "first", "n_docs")
        .join(classes.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
        .join(counts, "set_id", "left")
    )
    heads = scratch.write(
        named.groupBy("root").agg(
            F.min("first").alias("head"), F.sum("n_docs").alias("class_docs"), F.count(F.lit(1)).alias("_rows")
        )
    )
    most = heads.agg(F.max("_rows")).first()[0] or 0
    named = split_join(named, heads.drop("_rows"), "root", most, heads).drop("first", "root")
    return signed.select("doc_id", "key", "set_id", "n").join(named, "set_id", "left").select(
        F.col("doc_id").alias(id_col),
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce(F.col("linked") + F.col("n_docs") - 1, F.col("n_docs") - 1, F.lit(0)).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_texts"),
        F.coalesce("class_docs", F.lit(1)).alias("class_docs"),
        "key",
        (F.col("head").isNull() | (F.col("head.key") == F.col("key"))).alias("keep"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each class stays, the one with the smallest identifier; all columns stay."""
    scratch = Scratch(docs.sparkSession)
    gone = scratch.write(near_copies(docs).where(~F.col("keep")).select("key").distinct())
    return without_keys(docs, gone)
