"""Documents that every operator must survive."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Columns with names that operators use inside.
CLASHING = {"key": "x", "row": "y", "id": "z", "h": "1", "n": "2", "salt": "3", "_salt": "4"}


def prose(seed, words=80):
    """Invented text; the same seed gives the same text."""
    draw = random.Random(seed)
    parts = "an be der en hea in ly nt on re sh th ti wa ou er".split()
    out = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(words)]
    for k in range(0, words, 9):
        out[k] = out[k].capitalize()
        if k:
            out[k - 1] += "."
    return " ".join(out)


def documents(spark, texts, clashing=False):
    """Rows of (doc_id, text), or of texts that are numbered."""
    rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({k: F.lit(v) for k, v in CLASHING.items()})
    return df


def odd_documents(spark):
    """Null, empty, blank and very long texts, null and repeated identifiers, repeated rows."""
    long = prose(1, 9000)
    texts = [(1, None), (2, ""), (3, "  \n\t "), (4, long), (5, long), (None, prose(2)), (6, prose(3))]
    return documents(spark, [*texts, (6, prose(3)), (6, prose(4)), (7, "A"), (8, "ß\0é")], True)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
