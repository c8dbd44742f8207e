import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from footfall.llm import packing
from tests.llm.helpers import documents, empty, odd_documents, prose


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(df):
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    got = packing.pack(df).collect()
    ids = [[*x.ids, 2] for x in tokenizer().encode_batch([t for _, t in rows], add_special_tokens=False)]
    expected = Counter()
    for (doc, _), own in zip(rows, ids, strict=True):
        first = len(own) % 1024 or 1024
        cuts = [0, *range(first, len(own) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            crc = zlib.crc32(np.asarray(own[a:b], dtype="<u4").tobytes())
            expected[doc, k, a, b - a, crc] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert places[0][0] == 0 and sum(n for _, n in places) <= 1024
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))
    return len(sequences), packing.least_bins(Counter(r.length for r in got))


@pytest.mark.parametrize("pieces", [16_384, 40])
def test_round_trip_on_one_and_many_islands(spark, monkeypatch, pieces):
    monkeypatch.setattr(packing, "ISLAND_PIECES", pieces)
    draw = random.Random(3)
    df = documents(spark, [prose(k, draw.choice([3, 60, 200, 700, 1500])) for k in range(120)])
    sequences, bound = check(df)
    assert sequences <= bound * 1.02 + 1


def test_odd_documents_and_empty_table(spark):
    check(odd_documents(spark))
    assert packing.pack(empty(spark)).collect() == []


def test_added_tokens_long_words_and_string_identifiers(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|endoftext|", "w" * 150_000, "z " + "q" * 90]
    check(documents(spark, texts * 2))
    named = documents(spark, texts).selectExpr("concat('d', doc_id) AS doc_id", "text")
    check(named.unionByName(named.selectExpr("cast(null AS string) AS doc_id", "text")))


def ids_of(texts):
    paths = [public_tokenizers.path(n) for n in (packing.TOKENIZER, packing.RANKS)]
    return [np.frombuffer(x, dtype="<u4").tolist() for x in packing._Ids(*paths)(texts)]


def test_ids_put_together_from_words():
    odd = ["a  b", " a", "a ", "a\n\nb", "a \n b", "\n", "a\tb c", "x\u00a0y", "<|endoftext|> z", "it's don't",
           "\u00e9 b c", "\0 a", "", " ", "\u2028x", "\u6f22\u5b57 \U0001f600\u200d \u0301e", "a\x1cb", "I'LL 've s's 12a3\u00b2"]
    texts = [x for t in odd for x in (t, f"{t} and more\nof it {t}", f"begin {t}")]
    draw = random.Random(4)
    pool = [chr(c) for c in [*range(32, 127), *range(0xA0, 0x250), *range(0x370, 0x450), 0x4E2D, 0x1F600, 0x300]]
    texts += [" ".join("".join(draw.choices(pool, k=draw.randint(1, 9))) for _ in range(20)) for _ in range(300)]
    expected = [x.ids for x in tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert ids_of(texts) == expected


def test_individuals_stay_within_the_supply():
    draw = random.Random(5)
    supply = Counter(draw.randint(1, 1023) for _ in range(3000))
    people = packing.evolve(supply, [], [], 1)
    other = packing.evolve(Counter(draw.randint(1, 1023) for _ in range(3000)), [], [], 2)
    people = packing.evolve(supply, people, [other[0]], 3)
    for bins in people:
        assert packing.used(bins) == supply
        assert all(sum(p) <= packing.CAPACITY for p in bins)
    best = sum(people[0].values())
    assert packing.least_bins(supply) <= best <= packing.least_bins(supply) + 5
    assert best <= sum(packing.fill(supply, exact=False).values())


def test_crossover_takes_whole_bins_and_drops_doubled_ones():
    supply = Counter({512: 2, 700: 1, 324: 1, 300: 1})
    base, guest = Counter({(700, 324): 1, (512, 300): 1, (512,): 1}), Counter({(512, 512): 1})
    found = [packing.crossover(supply, base, guest, random.Random(k)) for k in range(20)]
    assert all(packing.used(f) == supply for f in found)
    assert any(f[(512, 512)] == 1 and f[(700, 324)] == 1 and sum(f.values()) == 3 for f in found)
