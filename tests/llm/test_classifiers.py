import random

import numpy as np

from footfall.llm import quality, toxicity
from footfall.llm.statistics import NAMES, statistics
from tests.llm.helpers import documents, empty, odd_documents, prose
from zlib import crc32

NO_LABELS = "doc_id long, quality int, toxic int"


def labelled(spark, rows):
    return spark.createDataFrame(rows, NO_LABELS)


def corpus(n):
    """Good prose and four kinds of junk."""
    out = []
    for k in range(n):
        text = prose(k, 40 + k % 50)
        if k % 3 == 0:
            kind = (k // 3) % 4
            words = text.split()
            text = (
                " ".join(w.upper() + "!!" for w in words),
                " | ".join(words),
                " ".join(w + "***" for w in words),
                " ".join(" ".join([w] * 9) for w in words[:9]),
            )[kind]
        out.append((k, text, int(k % 3 != 0)))
    return out


def test_quality_on_held_out_documents(spark):
    rows = corpus(600)
    df = documents(spark, [(k, t) for k, t, _ in rows], clashing=True)
    got = quality.quality_scores(df, labelled(spark, [(k, y, 0) for k, _, y in rows])).collect()
    truth = {k: y for k, _, y in rows}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {k for k in truth if crc32(str(k).encode()) % 4 == 2}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    left = quality.drop_rejected(df, labelled(spark, [(k, y, 0) for k, _, y in rows]))
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in got if r.predicted)


def test_held_out_labels_are_never_used(spark):
    rows = corpus(200)
    df = documents(spark, [(k, t) for k, t, _ in rows])
    wrong = [(k, 1 - y if crc32(str(k).encode()) % 4 == 2 else y, 0) for k, _, y in rows]
    right = [(k, y, 0) for k, _, y in rows]
    scores = [
        sorted(quality.quality_scores(df, labelled(spark, x)).collect()) for x in (wrong, right)
    ]
    assert scores[0] == scores[1]


def test_odd_documents_without_labels(spark):
    odd, none = odd_documents(spark), labelled(spark, [])
    for scored in (quality.quality_scores, toxicity.toxicity_scores):
        got = scored(odd, none).collect()
        assert len(got) == odd.count() and len({r.score for r in got}) == 1
        assert scored(empty(spark), none).collect() == []
        nulls = labelled(spark, [(None, None, None), (1, 1, 1), (1, 1, 1), (999, 0, 0)])
        assert scored(odd, nulls).count() == odd.count()


def test_trees_walk_like_nested_ifs():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95

    def walk(row, tree):
        node = 0
        while node < 2**quality.DEPTH - 1:
            right = row[model.feature[tree, node]] > model.cut[tree, node]
            node = 2 * node + 1 + int(right)
        return model.leaf[tree, node - 2**quality.DEPTH + 1]

    slow = [model.base + sum(walk(r, t) for t in range(len(model.leaf))) for r in x[:40]]
    assert np.allclose(model.margin(x[:40]), slow)


def test_statistics_do_not_depend_on_the_batch():
    texts = ["", "a", prose(1), prose(2, 4000), "A!! B!!", "x\nx\nx", "\n", "漢字 é", "\ud800"]
    together, alone = statistics(texts), np.vstack([statistics([t]) for t in texts])
    assert np.allclose(together, alone) and np.isfinite(together).all()
    at = {n: k for k, n in enumerate(NAMES)}
    assert not together[0].any()
    assert together[5, at["distinct_lines"]] == 1 / 3 and together[5, at["repeated_next"]] == 1


BAD = ["vilest", "crudely", "rotten", "sneering"]


def group_corpus(n):
    """Toxic texts hold a bad word. Group names come with most of them, and with a few others."""
    draw, out = random.Random(7), []
    for k in range(n):
        words, toxic = prose(k, 25).split(), k % 3 == 0
        if toxic:
            words.insert(draw.randrange(len(words)), draw.choice(BAD))
        if draw.random() < (0.9 if toxic else 0.03):
            words.insert(draw.randrange(len(words)), draw.choice(["muslims", "muslims", "jews"]))
        out.append((k, " ".join(words), int(toxic)))
    return out


def test_toxicity_on_held_out_documents(spark):
    rows = group_corpus(900)
    df = documents(spark, [(k, t) for k, t, _ in rows], clashing=True)
    got = toxicity.toxicity_scores(df, labelled(spark, [(k, 1, y) for k, _, y in rows])).collect()
    truth = {k: y for k, _, y in rows}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {k for k in truth if crc32(str(k).encode()) % 3 == 1}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.95


def test_penalty_lowers_scores_of_neutral_mentions(spark, monkeypatch):
    rows = group_corpus(900)
    train = spark.createDataFrame([(t, float(y)) for _, t, y in rows], "text string, y double")
    neutral = [f"{prose(5000 + k, 20)} muslims" for k in range(40)]
    fair = toxicity.train(train)
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    unfair = toxicity.train(train)
    assert fair.score(neutral).mean() < unfair.score(neutral).mean()
    swapped = [toxicity.swapped(t) for t in neutral]
    change = [abs(m.score(neutral) - m.score(swapped)).mean() for m in (fair, unfair)]
    assert change[0] < change[1] / 10
    toxic = [f"{t} {BAD[k % 4]}" for k, t in enumerate(neutral)]
    assert fair.score(toxic).min() > fair.score(neutral).max()


def test_swapping_replaces_whole_names_only():
    assert toxicity.swapped("A Muslim and manners, men") == "A jewish and manners, women"
