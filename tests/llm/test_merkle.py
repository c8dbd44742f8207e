import hashlib
import string
import zlib

import pytest
from pyspark.sql import functions as F

from footfall.llm import merkle
from footfall.llm.exact_dedup import ascii_lower
from tests.llm.helpers import CLASHING, SCHEMA, empty, odd_documents, prose

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_of(nodes):
    """Levels of a tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[k : k + 8])) for k in range(0, len(below), 8)])
    return levels


def way_of(levels, at):
    out = []
    for level in levels[:-1]:
        run = at // 8 * 8
        out.append(("".join(level[run:at]), "".join(level[at + 1 : run + 8])))
        at //= 8
    return out


def by_brute_force(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    members = {
        x: sorted(
            (r for r in rows if r["lang"] == x),
            key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)),
        )
        for x in langs
    }
    trees = {x: tree_of([leaf_of(r) for r in members[x]]) for x in langs}
    top = tree_of([trees[x][-1][0] for x in langs])
    root, out = top[-1][0], []
    for k, x in enumerate(langs):
        for at, r in enumerate(members[x]):
            way = way_of(trees[x], at) + way_of(top, k)
            seen, doc = dict(r), r["doc_id"]
            if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 and r["text"] is not None:
                seen["text"] = r["text"].translate(LOWER)
            node = leaf_of(seen)
            for left, right in way:
                node = h(left + node + right)
            proof = h("".join(a + z for a, z in way))
            out.append((doc, leaf_of(r), trees[x][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def check(df, **options):
    rows = [r.asDict() for r in df.collect()]
    got = merkle.verify(df, {"text": ascii_lower(F.col("text"))}, merkle.every_third(), **options)
    assert got.columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    ]
    want = by_brute_force(rows)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    return want


def rows_of(spark, sizes, clashing=False):
    rows, doc = [], 0
    for lang, n in sizes:
        for _ in range(n):
            doc += 7
            text = None if doc % 5 == 0 else prose(doc, 6)
            rows.append((doc, text, lang, None if doc % 3 else "sé", None if doc % 4 else doc))
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({k: F.lit(v) for k, v in CLASHING.items()}) if clashing else df


def test_many_groups_and_sizes(spark):
    sizes = [(None, 9), ("en", 700), ("", 1), ("-", 8), ("é", 64), ("z", 65), ("fr", 2), ("a", 1)]
    want = check(rows_of(spark, sizes, clashing=True))
    assert {w[-1] for w in want} == {True, False}


def test_blocks_of_several_rounds(spark):
    sizes = [("en", 600), ("de", 8), ("fr", 9), *((f"l{k}", 1) for k in range(70))]
    check(rows_of(spark, sizes), block_levels=1)


def test_odd_documents(spark):
    check(odd_documents(spark))
    check(odd_documents(spark).unionByName(rows_of(spark, [("en", 30)], True)))
    single = rows_of(spark, [("en", 1)])
    check(single)
    assert merkle.manifest(single).columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256"]


def test_string_identifiers(spark):
    df = rows_of(spark, [("en", 20)]).withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    got = merkle.verify(df).collect()
    assert len(got) == 20 and all(r.verified and r.doc_id.startswith("d") for r in got)


def test_empty_table(spark):
    assert merkle.verify(empty(spark)).collect() == []


@pytest.mark.parametrize("count", [1, 8, 9, 64, 100, 512])
def test_versions_share_what_they_do_not_change(count):
    leaves = [h(str(k)) for k in range(count)]
    tree = merkle.PersistentTree(leaves, len(tree_of(leaves)) - 1)
    first, size = tree.root, len(tree.digests)
    assert tree.replaced(first, 0, leaves[0]) == first and len(tree.digests) == size
    for at in {0, count // 2, count - 1}:
        before = len(tree.digests)
        version = tree.replaced(first, at, h("new"))
        assert len(tree.digests) - before == tree.levels + 1
        other = tree_of([h("new") if k == at else x for k, x in enumerate(leaves)])
        assert tree.digests[version] == other[-1][0]
        assert tree.digests[first] == tree_of(leaves)[-1][0]
