import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from footfall.llm import spelling
from tests.llm.helpers import documents, empty, odd_documents, prose


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def by_brute_force(rows, least_count=5, one_in=199):
    counts = Counter()
    for doc, text in rows:
        lower = (text or "").encode().lower().decode()
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least_count}
    form, out = {}, []
    for w, n in words.items():
        beside = [x for x in words if near(w, x)]
        best = min(beside, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        out.append((w, n, len(beside)))
    full = []
    for w, n, k in out:
        root = w
        while form[root] is not None:
            root = form[root]
        full.append((w, form[w], root, n, k, words.get(form[w])))
    return sorted(full, key=repr)


def check(df, **options):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = spelling.variants(df, delete_one_in=199, **options)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = by_brute_force(rows, options.get("least_count", 5))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    return want


def misspelt(seed, words=400, letters="abcéÿ×"):
    """Texts of a few words and many forms of them one or more edits apart."""
    draw = random.Random(seed)
    base = ["".join(draw.choice(letters) for _ in range(draw.randint(5, 9))) for _ in range(12)]
    out = []
    for _ in range(words):
        word = base[min(draw.randrange(12), draw.randrange(12), draw.randrange(12))]
        for _ in range(draw.choice([0, 0, 0, 1, 1, 2])):
            at = draw.randrange(len(word) + 1)
            new = draw.choice(["", *letters])
            word = word[:at] + new + word[at + draw.randrange(2) :]
        out.append(draw.choice([word, word.title(), word.upper()]))
    return " ".join(out) + "1a-b"


def test_variants(spark):
    chain = " ".join(["lantern"] * 150 + ["Lanternx"] * 27 + ["lanternxy"] * 5)
    want = check(documents(spark, [chain, *(misspelt(k) for k in range(20))], clashing=True))
    assert ("lanternxy", "lanternx", "lantern", 5, 1, 27) in want
    assert any(w[4] > 1 for w in want)


def test_large_groups_are_split(spark):
    texts = [misspelt(k, letters="abc") for k in range(6)]
    check(documents(spark, texts), most_in_group=3, least_count=2)


def test_odd_documents(spark):
    check(odd_documents(spark))
    check(odd_documents(spark).union(odd_documents(spark)), least_count=1)


def test_long_text_and_long_words(spark):
    long = misspelt(3, 40_000)
    strange = " ".join(["x" * 3000, "x" * 2999 + "y", "x" * 2999] * 5)
    check(documents(spark, [long, strange, "Éé " * 9, "ÉCOLES écoles " * 5]))


def test_empty_table_and_no_words(spark):
    assert spelling.variants(empty(spark)).collect() == []
    assert spelling.variants(documents(spark, ["short 12", None])).collect() == []


def test_no_circles(spark):
    with pytest.raises(ValueError):
        spelling.variants(documents(spark, [prose(1)]), times=1)


def test_windows_count_every_pair_once(spark):
    draw = random.Random(5)
    words = sorted({"".join(draw.choice("ab") for _ in range(draw.randint(2, 7))) for _ in range(200)})
    rows = spelling._windows(spark.createDataFrame([(w, 1) for w in words], "word string, n long"))
    for _ in range(2):
        groups = {}
        for r in rows.withColumn("key", spelling._key()).orderBy("word").collect():
            groups.setdefault(r["key"], []).append(r)
        found = Counter()
        for group in groups.values():
            r = group[0]
            for word, n, _, _ in spelling._compare([g.word for g in group], [1] * len(group), r.m, r.lo, r.hi):
                found[word] += n
        assert found == Counter({w: k for w in words if (k := sum(near(w, x) for x in words))})
        rows = rows.where(F.col("hi") - F.col("lo") > 1).transform(spelling._halved).unionByName(
            rows.where(F.col("hi") - F.col("lo") <= 1)
        )
