import re

from footfall.llm import decontaminate
from tests.llm.helpers import documents, empty, odd_documents, prose

ITEM = (
    "Yesterday the farmer Anna bought 12 kg of apples and 3 bags of pears for her sister "
    "and then paid 40 euros in total at the market near the river"
)
CHANGED = (
    "Yesterday the farmer Clara bought 75 lb of apples and 9 bags of pears for her sister "
    "and then paid 63 dollars in total at the market near the river"
)


def items(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def found(spark, texts, benchmark):
    rows = decontaminate.leaks(documents(spark, texts, clashing=True), items(spark, benchmark)).collect()
    return {(r.doc_id, r.item_id): r for r in rows}


def test_exact_changed_and_clean(spark):
    texts = [prose(1) + " " + ITEM + " " + prose(2), CHANGED, prose(3), None, "", ITEM.upper()]
    got = found(spark, texts, [ITEM, prose(9, 30), None, "of the", "one two three four"])
    assert {k for k, r in got.items() if r.contaminated} >= {(0, 0), (1, 0)}
    assert got[0, 0].kind == "exact" and got[0, 0].changed_slots == 0
    assert got[1, 0].kind == "reparameterised" and got[1, 0].changed_slots == 6
    assert not any(doc in (2, 3, 4) for doc, _ in got)


def test_copies_in_another_case_or_without_punctuation(spark):
    two = ITEM + ". Then Clara and Otto went to Vienna. Nobody saw them again until late in May"
    texts = [f"{prose(1)} {t} {prose(2)}" for t in (two.upper(), two.title(), two.replace(".", ""))]
    got = found(spark, [*texts, two.lower(), prose(3).upper()], [two])
    assert set(got) == {(k, 0) for k in range(4)}
    assert all(r.contaminated for r in got.values())
    for k in (0, 1):
        assert got[k, 0].kind == "exact" and got[k, 0].coverage == 1


def test_slots_must_map_one_to_one(spark):
    item = "take 7 of the red balls and 7 of the blue ones then add 5 green balls to the bag"
    same = item.replace("7", "4").replace("5", "8")
    split = "take 4 of the red balls and 6 of the blue ones then add 8 green balls to the bag"
    got = found(spark, [same, split], [item])
    assert got[0, 0].kind == "reparameterised" and got[0, 0].slots == 3
    assert got[1, 0].kind == "conflicting"


def test_short_items_are_found_whole(spark):
    got = found(spark, ["x y the quick brown fox z", "the quick brown cat"], ["the quick brown fox"])
    assert set(got) == {(0, 0)} and got[0, 0].windows == 1


def test_items_without_windows_are_found_literally(spark):
    many = "Sum 1 2 3 4 5 6 7 8 9 and 10 11 12 13 14 15 16 17"
    bench = ["What is 3 + 4 * 5 - 2?", "70 * 8", "Why?", many, "", None]
    texts = [
        f"{prose(1)} WHAT IS 3 + 4 * 5 - 2? {prose(2)}",
        f"{prose(3)} What is 3 + 4 * 5 - 1? 8 * 70.",
        "So 70 * 70, then 70 * 8 and 70 * 8",
        f"{prose(4)} {many}",
        f"{prose(5)} {many[:-2]}18",
        "why",
    ]
    got = found(spark, texts, bench)
    assert set(got) == {(0, 0), (2, 1), (3, 3), (5, 2)}
    assert all(r.kind == "exact" and r.contaminated and r.coverage == 1 for r in got.values())
    assert got[0, 0].slots == 4 and set(found(spark, texts, ["70 * 8"])) == {(2, 0)}


def test_against_brute_force(spark):
    bench = [prose(100 + k, 20 + k) for k in range(12)]
    texts = []
    for k in range(60):
        cut = bench[k % 12].split()
        part = cut[: 4 + (k * 7) % len(cut)] if k % 3 else []
        texts.append(" ".join([prose(k, 30), *part, prose(k + 500, 30)]))
    got = found(spark, texts, bench)

    def windows(text):
        text = re.sub(r"(?<=[^.!?\s]\s)[A-Z][a-z]*", "\0", text)
        words = re.findall(r"\0|[a-z]+", text.lower())
        return [tuple(words[k : k + 8]) for k in range(len(words) - 7)]

    expected = {}
    for i, b in enumerate(bench):
        kept = {w for w in windows(b) if w.count("\0") * 2 <= 8}
        for d, t in enumerate(texts):
            n = len(kept & set(windows(t)))
            if kept and n / len(kept) >= decontaminate.COVERAGE:
                expected[d, i] = n
    assert {k: r.found for k, r in got.items()} == expected and expected


def test_joined_by_shuffle_all_the_same(spark, monkeypatch):
    before = found(spark, [ITEM, CHANGED], [ITEM])
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert found(spark, [ITEM, CHANGED], [ITEM]) == before


def test_dropping_keeps_clean_rows(spark):
    texts = [(1, ITEM), (1, prose(1)), (2, prose(2)), (2, prose(2)), (None, CHANGED), (None, None)]
    df = documents(spark, texts, clashing=True)
    left = decontaminate.drop_contaminated(df, items(spark, [ITEM]))
    assert left.columns == df.columns
    assert sorted(left.select("doc_id", "text").collect(), key=repr) == sorted(
        [(1, prose(1)), (2, prose(2)), (2, prose(2)), (None, None)], key=repr
    )


def test_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    assert decontaminate.leaks(odd, items(spark, [ITEM])).collect() == []
    assert decontaminate.leaks(empty(spark), items(spark, [ITEM])).collect() == []
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(odd, nothing).collect() == []
    assert decontaminate.drop_contaminated(odd, nothing).count() == odd.count()
