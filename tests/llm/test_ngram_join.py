import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from footfall.llm import ngram_join
from footfall.llm.common import Scratch
from footfall.llm.components import components
from footfall.llm.shingles import shingle_sets
from tests.llm.helpers import documents, empty, odd_documents, prose


def varied(text, edits, seed):
    draw = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = "x" + str(draw.randrange(10**6))
    return " ".join(words)


def by_brute_force(rows):
    """(class_id, n_links, n_texts) of each row, from sets of word tuples."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        sets.append(frozenset(grams or ({tuple(words)} if words else ())))
    linked = defaultdict(set)
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
                linked[a].add(b)
                linked[b].add(a)
    seen, out = set(), [None] * len(rows)
    for start in range(len(rows)):
        if start in seen:
            continue
        group, queue = {start}, [start]
        while queue:
            new = linked[queue.pop()] - group
            group |= new
            queue += new
        seen |= group
        known = [rows[k][0] for k in group if rows[k][0] is not None]
        for k in group:
            texts = len({sets[j] for j in linked[k]} - {sets[k]})
            out[k] = (rows[k][0], min(known) if known else None, len(linked[k]), texts)
    return sorted(out, key=repr)


def check(df):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = ngram_join.near_copies(df).collect()
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=repr) == by_brute_force(rows)
    return got


@pytest.fixture(scope="module")
def families():
    texts = [prose(k, 120) for k in range(40)]
    texts += [varied(texts[k % 6], 1 + k % 5, k) for k in range(90)]
    return texts + [texts[0], texts[0].upper(), texts[3]] + ["one two", "One, two!", "one two three"]


@pytest.mark.parametrize("block", [1024, 7])
def test_against_brute_force(spark, monkeypatch, families, block):
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", block)
    got = check(documents(spark, families))
    classes = {r.class_id for r in got}
    assert sum(r.keep for r in got) == len(classes)
    assert all(r.doc_id == r.class_id for r in got if r.keep)


def test_odd_documents_and_empty_table(spark):
    check(odd_documents(spark))
    assert ngram_join.near_copies(empty(spark)).collect() == []
    assert ngram_join.drop_near_copies(empty(spark)).collect() == []


def test_one_document_of_each_class_stays(spark, families):
    df = documents(spark, families, clashing=True)
    left = ngram_join.drop_near_copies(df)
    assert left.columns == df.columns
    got = ngram_join.near_copies(df).collect()
    assert sorted(r.doc_id for r in left.collect()) == sorted({r.class_id for r in got})


def test_prefixes_shorten_until_the_recall_is_met():
    at = [ngram_join.prefix_length(0.8, r) for r in (0.5, 0.9, 0.999, 0.999999)]
    assert at == sorted(at, reverse=True) and at[-1] >= 1
    n = ngram_join.prefix_length(0.8, 0.999)
    assert 1 - (1 - 0.8**n) ** ngram_join.TREES >= 0.999
    assert ngram_join.prefix_length(0.1, 1.0) == 1


def branch(sequences, sides=None):
    """A branch of tree 0 whose texts have these label sequences there and label 0 elsewhere."""
    sequences = sorted(sequences)
    rest = np.zeros(ngram_join.TREES * ngram_join.LABELS - ngram_join.LABELS, dtype=">u2").tobytes()
    rows = [
        {"set_id": bytes([k]), "paths": np.array(q, dtype=">u2").tobytes() + rest, "family": k, "tree": 0,
         "side": sides[k] if sides else 0, "x": 0, "y": 1 if sides else 0}
        for k, q in enumerate(sequences)
    ]
    return ngram_join._Branch(pd.DataFrame(rows), 1)


def test_prefixes_are_shortened_while_families_are_apart():
    """Each text is compared under the longest prefix it shares; one family is not widened."""
    walked = []

    class Noted(ngram_join._Branch):
        def _widen(self, a, b, met):
            walked.append((int(a), int(b), len(np.unique(self.family[a:b]))))
            super()._widen(a, b, met)

    full, six, four = (1,) * 8, (1,) * 6 + (2, 2), (1,) * 4 + (3, 3, 3, 3)
    found = branch([full, full, six, four])
    found.__class__ = Noted
    assert len(found.match(4)) == 3
    assert walked[0] == (0, 2, 2) and (0, 3, 2) in walked and walked[-1] == (0, 4, 2)
    assert len(branch([full, six, four]).match(5)) == 1  # the third lies below another prefix
    apart = branch([full, six, four])
    apart.need = 10**6
    assert apart.match(4) == []
    sided = branch([full, full, full], sides=[0, 0, 1]).match(4)  # the first two met in their block
    assert {frozenset(link) for link in sided} == {frozenset((b"\x02", b"\x00")), frozenset((b"\x02", b"\x01"))}


def test_hubs_and_branches_are_split(spark, monkeypatch, families):
    monkeypatch.setattr("footfall.llm.components.MOST_LINKS", 3)
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", 5)
    check(documents(spark, families))


@pytest.mark.parametrize("threshold, recall", [(0.8, 0.999), (0.6, 0.999), (0.5, 0.999), (0.35, 0.99)])
def test_recall_at_other_thresholds(spark, threshold, recall):
    """Pairs on all sides of the threshold, counted against brute force."""
    base = [prose(k, 150) for k in range(12)]
    texts = base + [varied(base[k % 12], 1 + k % 23, k) for k in range(220)]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.lower().replace(".", "").split() for t in texts)]
    want = Counter()
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both / (len(sets[a]) + len(sets[b]) - both) >= threshold:
                want[a] += 1
                want[b] += 1
    got = ngram_join.near_copies(documents(spark, texts), threshold=threshold, recall=recall)
    found = {r.doc_id: r.n_links for r in got.collect()}
    assert all(found[k] <= want[k] for k in found)
    assert sum(found.values()) >= 0.99 * sum(want.values()) > 0


def test_a_recall_out_of_reach_is_an_error(spark):
    assert ngram_join.least_agreeing(0.8) > 79 and ngram_join.least_agreeing(0.5) < 40
    with pytest.raises(ValueError):
        ngram_join.near_copies(documents(spark, [prose(1)]), threshold=0.3, recall=0.999)


def test_shingles_of_any_text():
    texts = ["", "a", "a b c d", "A, b c D!", "a b c d e", "e d c b a", " \n", "é ß 漢字 x y z", "\ud800 a"]
    sets = shingle_sets([*texts, prose(1, 3000)])
    assert [len(s) for s in sets[:8]] == [0, 1, 1, 1, 1, 1, 0, 2]
    assert np.array_equal(sets[2], sets[3]) and not np.array_equal(sets[4], sets[5])
    alone = shingle_sets([prose(1, 3000)])[0]
    assert np.array_equal(sets[-1], alone)
    words = re.findall(r"[^\W_]+", prose(1, 3000).lower())
    assert len(alone) == len({tuple(words[k : k + 5]) for k in range(2996)})


@pytest.mark.parametrize("most", [100_000, 0])
def test_components_of_chains_and_stars(spark, monkeypatch, most):
    monkeypatch.setattr("footfall.llm.components.MOST_LINKS", most)
    draw = random.Random(1)
    edges = [(f"c{k:03}", f"c{k + 1:03}") for k in range(60)] + [("s0", f"s{k}") for k in range(30)]
    edges += [("a", "a"), ("b", "c"), ("c", "b"), ("c", "d")]
    draw.shuffle(edges)
    df = spark.createDataFrame([e if draw.random() < 0.5 else e[::-1] for e in edges], "a string, b string")
    got = {r.node: r.root for r in components(df, Scratch(spark)).collect()}
    assert Counter(got.values()) == {"c000": 61, "s0": 30, "b": 3}
    none = spark.createDataFrame([], "a string, b string")
    assert components(none, Scratch(spark)).collect() == []
