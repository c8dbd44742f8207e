"""SentencePiece ids of whole texts, from a table of distinct marked words.

SentencePiece writes a space as a marker. Where no piece of a model has a marker after another
letter, a text's ids are those of its words, each with the markers before it, one after another.
So the texts are cut into marked words, every distinct word is segmented once, and the ids are put
back in place of the words.

Texts are read in blocks of a bounded size. A block becomes one row: its documents as numbers of
words, the most frequent word first, and the list of its distinct words, dealt over parts by their
hash. All blocks' lists of a part meet in one task, which segments each of its words once and
answers every block. The rows of blocks are written in buckets, so that the answers come to them
and they need not be shuffled themselves.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, shuffle_parts, whole_text

MODEL = "piece_bpe_32k.model"
MARK = "▁"

# A block ends when its texts have this many characters or this many distinct words, or with its
# partition; a document is never cut.
BLOCK_CHARACTERS = 24_000_000
BLOCK_WORDS = 500_000

# Characters of the documents that one output batch holds.
BATCH_CHARACTERS = 4_000_000

# Strings in which models that change more than spaces, or join words, show themselves.
PROBES = (
    "", " ", "  ", "a", " a", "a ", " a  b   c ", "a\tb\n c\r\n", "\u2581x \u2581", "\ufb01 \u2460",
    "\u00e9 e\u0301", "\u3000a\u00a0b", "\u200b \u00ad\ufeff", "\0 \1", "\uff21\uff22", "<s> </s> <unk>",
    "Ab, CD. ef! 12 345", "naïve Straße 你好 \U0001f600 x",
)


class Pieces:
    """A model with what is needed to segment marked words one by one."""

    cut = re.compile(f"{MARK}+[^{MARK}]*").findall

    def __init__(self, model: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = self.model.encode(f"a{MARK}")
        self.lone = ids[len(self.model.encode("a")) :]
        model, size = self.model, len(self.model)
        self.letters = [model.id_to_piece(k).replace(MARK, " ") for k in range(size)]
        kinds = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
        self.odd = np.asarray([any(f(k) for f in kinds) for k in range(size)])

    def words(self, text: str) -> list[str]:
        """The marked words of a text; one marker is put before it, as the model does."""
        return self.cut(MARK + text.replace(" ", MARK)) if text else []

    def segment(self, words: list[str]) -> list[list[int]]:
        """Ids of marked words; the model sets the first marker of each itself."""
        ids = self.model.encode([w[1:] for w in words])
        return [found if len(w) > 1 else self.lone for w, found in zip(words, ids, strict=True)]

    def texts(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Marked words' texts from their ids, of which word k has ``counts[k]``. Ids that are no
        letters (bytes and the like) are decoded by the model, which drops the first marker."""
        ends = np.cumsum(counts, dtype=np.int64)
        odd = np.concatenate(([0], np.cumsum(self.odd[ids])))
        plain = (odd[ends] == odd[ends - counts]).tolist()
        ids, ends, letters = ids.tolist(), ends.tolist(), self.letters.__getitem__
        spans = list(zip([0, *ends], ends, strict=False))
        out = [
            "".join(map(letters, ids[a:b])) if easy else None
            for easy, (a, b) in zip(plain, spans, strict=True)
        ]
        hard = [k for k, easy in enumerate(plain) if not easy]
        if hard:
            found = self.model.decode([ids[a:b] for a, b in (spans[k] for k in hard)])
            for k, text in zip(hard, found, strict=True):
                out[k] = " " + text
        return out

    def decoded(self, parts: list[list[int]]) -> str:
        """The text of a document from the ids of its marked words."""
        ids = np.fromiter(chain.from_iterable(parts), dtype="<u4")
        return "".join(self.texts(ids, np.asarray([len(p) for p in parts], dtype=np.int64)))[1:]

    def splits(self) -> bool:
        """Whether ids and texts can be put together from marked words: no piece has a marker
        after another letter, and no probe says otherwise."""
        across = re.compile(f"[^{MARK}]{MARK}")
        if any(across.search(self.model.id_to_piece(k)) for k in range(len(self.model))):
            return False
        for probe in PROBES:
            parts = self.segment(self.words(probe))
            ids = [i for part in parts for i in part]
            if ids != self.model.encode(probe) or self.decoded(parts) != self.model.decode(ids):
                return False
        return True


_loaded: dict[str, Pieces] = {}  # one per worker process


def _pieces(model: str) -> Pieces:
    return _loaded.get(model) or _loaded.setdefault(model, Pieces(model))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 as compressed byte planes, which lie closer than whole numbers."""
    import zstandard

    planes = np.ascontiguousarray(numbers, dtype="<u4").view("u1").reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype="u1")
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(-1)


def _packed_words(words: list[str]) -> tuple[bytes, bytes]:
    """Words and their lengths in bytes, compressed."""
    import zstandard

    data = [w.encode() for w in words]
    sizes = np.fromiter(map(len, data), dtype="<u4", count=len(data))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(data)), packed(sizes)


def _unpacked_words(data: bytes, sizes: bytes) -> list[str]:
    import zstandard

    text = zstandard.ZstdDecompressor().decompress(data)
    ends = np.cumsum(unpacked(sizes), dtype=np.int64).tolist()
    return [text[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]


class _Block:
    """Documents being gathered into one row."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids: list = []
        self.documents: list[np.ndarray] = []
        self.characters = 0

    def add(self, ident, text: str, words: list[str]) -> None:
        numbers = self.numbers
        found = [numbers.setdefault(w, len(numbers)) for w in words]
        self.ids.append(ident)
        self.documents.append(np.asarray(found, dtype="<u4"))
        self.characters += len(text)

    def full(self) -> bool:
        return self.characters >= BLOCK_CHARACTERS or len(self.numbers) >= BLOCK_WORDS

    def row(self, parts: int) -> dict:
        """The block with its words numbered anew: frequent ones first, equally frequent ones in
        alphabetical order, which makes both lists compress well."""
        words = list(self.numbers)
        every = np.concatenate(self.documents) if self.documents else np.zeros(0, "<u4")
        counts = np.bincount(every, minlength=len(words))
        by_name = np.asarray(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)
        order = by_name[np.argsort(-counts[by_name], kind="stable")]
        anew = np.zeros(len(words), dtype="<u4")
        anew[order] = np.arange(len(words), dtype="<u4")
        dealt: dict[int, tuple[list[int], list[str]]] = {}
        for number, k in enumerate(order.tolist()):
            at, own = dealt.setdefault(zlib.crc32(words[k].encode()) % parts, ([], []))
            at.append(number)
            own.append(words[k])
        lists = []
        for part, (at, own) in dealt.items():
            data, sizes = _packed_words(own)
            steps = np.diff(np.asarray(at, dtype="<u4"), prepend=np.zeros(1, "<u4"))
            lists.append({"part": part, "at": packed(steps), "words": data, "sizes": sizes})
        lengths = np.asarray([len(d) for d in self.documents], dtype="<u4")
        return {
            "ids": self.ids,
            "lengths": packed(lengths),
            "numbers": packed(anew[every]),
            "lists": lists,
        }


def _cut_blocks(model: str, parts: int, id_type: str):
    """The Arrow function that gathers documents into blocks, and its schema."""
    schema = f"""block long, ids array<{id_type}>, lengths binary, numbers binary,
                 lists array<struct<part: int, at: binary, words: binary, sizes: binary>>"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, block, number = _pieces(model), _Block(), TaskContext.get().partitionId() << 32
        inner = pa.struct(
            [("part", pa.int32()), ("at", pa.binary()), ("words", pa.binary()), ("sizes", pa.binary())]
        )
        ident = None

        def row() -> pa.RecordBatch:
            fields = [
                ("block", pa.int64()), ("ids", pa.list_(ident)), ("lengths", pa.binary()),
                ("numbers", pa.binary()), ("lists", pa.list_(inner)),
            ]
            return pa.RecordBatch.from_pylist(
                [{"block": number, **block.row(parts)}], schema=pa.schema(fields)
            )

        for batch in batches:
            ident = batch.schema.field("id").type
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                block.add(doc, text, pieces.words(text))
                if block.full():
                    yield row()
                    block, number = _Block(), number + 1
        if block.ids:
            yield row()

    return run, schema


def _segment_parts(model: str):
    """The Arrow function that answers blocks' lists of words with their ids. A task reads its
    parts one after another and segments a word when it first meets it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, part, known = _pieces(model), None, {}
        fields = [("block", pa.int64()), ("part", pa.int32()), ("found", pa.binary()), ("counts", pa.binary())]
        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] != part:
                    part, known = r["part"], {}
                words = _unpacked_words(r["words"], r["sizes"])
                new = [w for w in words if w not in known]
                known.update(zip(new, pieces.segment(new), strict=True))
                ids = [known[w] for w in words]
                counts = np.fromiter(map(len, ids), dtype="<u4", count=len(ids))
                found = np.fromiter(chain.from_iterable(ids), dtype="<u4")
                answer = {
                    "block": r["block"], "part": part, "found": packed(found), "counts": packed(counts)
                }
                yield pa.RecordBatch.from_pylist([answer], schema=pa.schema(fields))

    return run, "block long, part int, found binary, counts binary"


def _put_back(model: str, id_type: str):
    """The Arrow function that turns blocks with their answers into documents again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model)
        begin, end = (
            np.asarray([k], dtype="<u4").tobytes()
            for k in (pieces.model.bos_id(), pieces.model.eos_id())
        )
        for batch in batches:
            ident = batch.schema.field("ids").type.value_type
            fields = [("id", ident), ("ids", pa.binary()), ("decoded", pa.string())]
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                data, texts = _tables(pieces, r["lists"], r["answers"] or [])
                numbers = unpacked(r["numbers"])
                ends = np.cumsum(unpacked(r["lengths"]), dtype=np.int64).tolist()
                out, size = [], 0
                for doc, a, b in zip(r["ids"], [0, *ends], ends, strict=False):
                    own = numbers[a:b].tolist()
                    decoded = "".join(map(texts.__getitem__, own))[1:]
                    ids = b"".join((begin, *map(data.__getitem__, own), end))
                    out.append({"id": doc, "ids": ids, "decoded": decoded})
                    size += len(decoded)
                    if size >= BATCH_CHARACTERS:
                        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(fields))
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=pa.schema(fields))

    return run, f"id {id_type}, ids binary, decoded string"


def _tables(pieces: Pieces, lists: list[dict], answers: list[dict]) -> tuple[list, list]:
    """A block's words as bytes of their ids and as text, by their numbers."""
    places = {x["part"]: np.cumsum(unpacked(x["at"]), dtype=np.int64) for x in lists}
    total = sum(map(len, places.values()))
    data: list = [None] * total
    texts: list = [None] * total
    for x in answers:
        found, counts = unpacked(x["found"]), unpacked(x["counts"]).astype(np.int64)
        raw, ends = found.tobytes(), np.cumsum(counts * 4).tolist()
        own = pieces.texts(found, counts)
        for n, a, b, text in zip(places[x["part"]].tolist(), [0, *ends], ends, own, strict=False):
            data[n], texts[n] = raw[a:b], text
    return data, texts


def _whole_texts(model: str, id_type: str):
    """The Arrow function for models whose pieces may cross markers: texts as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model).model
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [pieces.encode(t, add_bos=True, add_eos=True) for t in texts]
            data = [np.asarray(i, dtype="<u4").tobytes() for i in ids]
            columns = [batch.column("id"), pa.array(data, pa.binary()), pa.array([pieces.decode(i) for i in ids])]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"])

    return run, f"id {id_type}, ids binary, decoded string"


def encode(
    docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ids and decoded.

    ``ids`` are the text's ids with begin and end, as little-endian unsigned 32-bit integers, the
    same as the sentencepiece library gives; ``decoded`` is what the library makes of them again.
    A null text is an empty one (begin and end only). Repeated rows and null identifiers give a
    row each; very long texts and words are never cut; an empty table gives an empty result.
    Models whose pieces may cross a marker encode text by text. ``model`` is a file that all
    executors can open.
    """
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path(MODEL)
    scratch, parts = Scratch(docs.sparkSession), shuffle_parts(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(f"`{text_col}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    if not _pieces(model).splits():
        run, schema = _whole_texts(model, id_type)
        return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
    run, schema = _cut_blocks(model, parts, id_type)
    blocks = scratch.write_buckets(rows.mapInArrow(run, schema), parts, "block")
    run, schema = _segment_parts(model)
    answers = (
        blocks.select("block", F.explode("lists").alias("x"))
        .select("block", "x.part", "x.words", "x.sizes")
        .repartition(parts, "part")
        .sortWithinPartitions("part")
        .mapInArrow(run, schema)
        .groupBy("block")
        .agg(F.collect_list(F.struct("part", "found", "counts")).alias("answers"))
    )
    places = F.transform("lists", lambda x: F.struct(x["part"].alias("part"), x["at"].alias("at")))
    run, schema = _put_back(model, id_type)
    return (
        blocks.select("block", "ids", "lengths", "numbers", places.alias("lists"))
        .join(answers.hint("merge"), "block", "left")  # the buckets stay where they are
        .drop("block")
        .mapInArrow(run, schema)
        .withColumnRenamed("id", id_col)
    )
