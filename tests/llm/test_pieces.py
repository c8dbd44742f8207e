import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from footfall.llm import pieces
from tests.llm.helpers import documents, empty, odd_documents, prose

MODEL = public_tokenizers.path(pieces.MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def check(df, library, **options):
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        want.append((r.doc_id, np.asarray(ids, "<u4").tobytes(), library.decode(ids)))
    got = pieces.encode(df, **options)
    assert got.columns == ["doc_id", "ids", "decoded"]
    got = [(r.doc_id, bytes(r.ids), r.decoded) for r in got.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def noise(seed, size=60):
    """Text of letters, markers, white space, signs and characters that no piece has."""
    draw = random.Random(seed)
    letters = ["a", "the", "tion", " ", " ", "  ", "\n", "\t", "\u2581", "\u00e9", "e\u0301", "\ufb01",
               "\u00a0", "\u3000", "<s>", "</s>", "<unk>", "<0x0A>", "\0", "\u4f60", "\U0001f600",
               "\u200b", ".", "1", "\ufeff", "\r"]
    return "".join(draw.choice(letters) for _ in range(draw.randrange(size)))


def test_pieces_of_words_are_those_of_the_text(library):
    own = pieces.Pieces(MODEL)
    assert own.splits()
    for seed in range(3000):
        text = noise(seed)
        parts = own.segment(own.words(text))
        ids = [k for part in parts for k in part]
        assert ids == library.encode(text)
        assert own.decoded(parts) == library.decode(ids)


def test_odd_and_noisy_documents(spark, library):
    check(odd_documents(spark), library)
    check(documents(spark, [noise(k, 400) for k in range(200)], clashing=True).repartition(3), library)


def test_long_texts_and_words(spark, library):
    texts = ["x" * 200_000, prose(1, 60_000), " " * 5000, "a b " * 50_000, "▁" * 300, "你好" * 9000]
    check(documents(spark, texts), library)


def test_blocks_split_and_ids_repeat(spark, library):
    texts = [(k % 7, prose(k % 11, 40) + "\n" + noise(k)) for k in range(300)]
    one = documents(spark, [*texts, (None, "x y"), (None, None)]).coalesce(1)
    check(one, library)
    again = one.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    check(again, library)


def test_block_limits():
    block = pieces._Block()
    for k in range(50):
        text = prose(k, 30)
        block.add(k, text, pieces.Pieces.cut("▁" + text.replace(" ", "▁")))
    row = block.row(4)
    lists, words = row["lists"], {}
    for x in lists:
        at = np.cumsum(pieces.unpacked(x["at"]))
        words.update(zip(at.tolist(), pieces._unpacked_words(x["words"], x["sizes"]), strict=True))
    assert sorted(words) == list(range(len(block.numbers)))
    assert {x["part"] for x in lists} <= set(range(4))
    text = "".join(words[n] for n in pieces.unpacked(row["numbers"]).tolist())
    assert text == "".join("▁" + prose(k, 30).replace(" ", "▁") for k in range(50))


def test_models_whose_pieces_cross_markers_take_the_whole_text(spark, library, monkeypatch):
    monkeypatch.setattr(pieces.Pieces, "splits", lambda self: False)
    check(odd_documents(spark), library)


def test_empty_table(spark):
    assert pieces.encode(empty(spark)).collect() == []
