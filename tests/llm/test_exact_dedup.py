import hashlib
import string

import pytest

from footfall.llm import exact_dedup
from tests.llm.helpers import documents, empty, odd_documents, prose

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def by_brute_force(rows, best):
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc)
    out = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = best(known) if known else None
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=repr)


def check(df, best):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = exact_dedup.exact_copies(df, keep=best.__name__).collect()
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=repr) == by_brute_force(rows, best)
    assert sum(r.kept for r in got) == len({(t or "").translate(LOWER) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = exact_dedup.drop_copies(df, keep=best.__name__)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(
        (r.doc_id for r in got if r.kept), key=repr
    )


@pytest.mark.parametrize("best", [min, max])
def test_odd_documents(spark, best):
    check(odd_documents(spark), best)


def test_hot_text_is_split_and_put_together(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_HOT", 3)
    texts = ["Same TEXT here"] * 40 + ["same text HERE"] * 25 + ["same text here é"] * 9
    check(documents(spark, [*texts, *(prose(k, 12) for k in range(30)), "É", "é"]), max)
    check(documents(spark, [*texts, *[(None, "same text here")] * 5, *[(3, "same text here")] * 4]), min)


def test_empty_table(spark):
    assert exact_dedup.exact_copies(empty(spark)).collect() == []
    assert exact_dedup.drop_copies(empty(spark)).collect() == []
