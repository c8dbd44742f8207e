"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    exact_dedup,
    html_main,
    licenses,
    merkle,
    ngram_join,
    packing,
    pieces,
    quality,
    secrets,
    spelling,
    surrogates,
    toxicity,
)
from .common import table
from .exact_dedup import ascii_lower


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with surrogates in place of personal data."""
    return surrogates.replace_personal_data(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents, re-parameterised ones included."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.leaks(docs, items).drop("key")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences in all documents."""
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among all documents; of equal texts the row with the largest doc_id stays."""
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"), keep="max")


def op8_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_main.main_text(table(spark, sf_dir, "pages"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and links of near copies among all documents."""
    return ngram_join.near_copies(table(spark, sf_dir, "documents")).drop("key")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents' ids and of what they decode to."""
    return pieces.encode(table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    docs = table(spark, sf_dir, "documents")
    return spelling.variants(docs, delete_one_in=spelling.DELETE_ONE_IN)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, verified with every third text lower-cased."""
    docs = table(spark, sf_dir, "documents")
    return merkle.verify(docs, {"text": ascii_lower(docs["text"])}, merkle.every_third())


QUERIES = {
    "op1_surrogates": op1_surrogates,
    "op2_decontaminate": op2_decontaminate,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_toxicity": op5_toxicity,
    "op6_licenses": op6_licenses,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_html_main": op8_html_main,
    "op9_ngram_join": op9_ngram_join,
    "op10_secrets": op10_secrets,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_spelling": op12_spelling,
    "op13_merkle": op13_merkle,
}

# CRC-32 of a text in SQL: a table of 256 steps, and a fold over the UTF-8 bytes of the text, whose
# characters lie below U+0800.
CRC_TABLE = """
        crc_steps(i, k, c) AS (
            SELECT i, 0, i FROM range(256) r(i)
            UNION ALL
            SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
            FROM crc_steps WHERE k < 8
        ),
        crc_table AS (SELECT list(c ORDER BY i) AS steps FROM crc_steps WHERE k = 8)
"""


def crc_sql(text: str) -> str:
    """SQL for the unsigned crc32 of a text expression, beside ``crc_table``."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split({text}, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT]
        ELSE [192 + (ord(x) >> 6)::BIGINT, 128 + (ord(x) & 63)::BIGINT] END))),
        lambda c, b: xor(c >> 8, steps[1 + (xor(c, b) & 255)])))"""


def spelling_sql() -> str:
    """The spelling variants' SQL: pairs by the pattern they share around a replaced letter, or
    by a word without one letter."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH RECURSIVE {CRC_TABLE},
        runs AS (
            SELECT doc_id, unnest(regexp_extract_all({lower}, '[a-z\u00C0-\u00FF]{{6,}}')) AS run
            FROM documents WHERE text IS NOT NULL
        ),
        seen AS (SELECT doc_id, run, count(*) AS times FROM runs GROUP BY ALL),
        hashed AS (
            SELECT run, times, {crc_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
            FROM seen CROSS JOIN crc_table
        ),
        cut AS (
            SELECT CASE WHEN h % 199 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :]
                   ELSE run END AS word, times
            FROM hashed
        ),
        words AS (
            SELECT word, sum(times)::BIGINT AS n FROM cut WHERE length(word) >= 6
            GROUP BY word HAVING sum(times) >= 5
        ),
        places AS (SELECT word, n, unnest(range(length(word))) AS k FROM words),
        patterns AS (SELECT word, n, k, word[: k] || '*' || word[k + 2 :] AS pattern FROM places),
        shorter AS (SELECT DISTINCT word, n, word[: k] || word[k + 2 :] AS less FROM places),
        pairs AS (
            SELECT a.word, b.word AS other, b.n AS other_n
            FROM patterns a JOIN patterns b ON a.pattern = b.pattern AND a.word <> b.word
            UNION ALL
            SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.less = w.word
            UNION ALL
            SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.less = w.word
        ),
        ranked AS (
            SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
                   row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS nth
            FROM pairs
        ),
        formed AS (
            SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
                   CASE WHEN r.other_n >= 5 * w.n THEN r.other END AS form,
                   CASE WHEN r.other_n >= 5 * w.n THEN r.other_n END AS form_n
            FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.nth = 1
        ),
        ways AS (
            SELECT word, word AS root, form AS further FROM formed
            UNION ALL
            SELECT w.word, f.word, f.form FROM ways w JOIN formed f ON f.word = w.further
        )
        SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n
        FROM formed f JOIN ways w ON w.word = f.word AND w.further IS NULL
    """


def merkle_sql(leaf_levels: int = 7, group_levels: int = 2) -> str:
    """The manifest's SQL for up to 8 ** leaf_levels rows a language and 8 ** group_levels
    languages; each level is spelt out."""
    columns = ["doc_id", "source", "lang", "n_chars"]

    def encoded(text: str) -> str:
        parts = [
            f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
            for c in (*columns, text)
        ]
        return f"sha256({' || '.join(parts)})"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = crc_sql("doc_id::VARCHAR")
    steps = [
        f"""WITH RECURSIVE {CRC_TABLE}""",
        f"""leaves AS (
            SELECT doc_id, lang, {encoded('text')} AS leaf,
                   CASE WHEN {crc} % 3 = 0 THEN {encoded(lower)} ELSE {encoded('text')} END AS claimed
            FROM documents CROSS JOIN crc_table
        )""",
        """placed AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
            FROM leaves
        )""",
        """a0 AS (
            SELECT lang AS tree, pos, leaf AS node, count(*) OVER (PARTITION BY lang) AS total FROM placed
        )""",
    ]

    def level(name: str, k: int) -> None:
        run = "PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
        steps.append(f"""{name}{k}s AS (
            SELECT tree, pos, total,
                   coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM {name}{k}
        )""")
        steps.append(f"""{name}{k + 1} AS (
            SELECT tree, pos // 8 AS pos,
                   CASE WHEN total = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END
                       AS node,
                   (total + 7) // 8 AS total
            FROM {name}{k} GROUP BY tree, pos // 8, total
        )""")

    def fold(before: str, after: str, name: str, k: int, tree: str, pos: str) -> None:
        steps.append(f"""{after} AS (
            SELECT f.* REPLACE (
                       CASE WHEN s.total = 1 THEN f.folded ELSE sha256(s.l || f.folded || s.r) END AS folded,
                       CASE WHEN s.total = 1 THEN f.proof ELSE f.proof || s.l || s.r END AS proof)
            FROM {before} f JOIN {name}{k}s s
            ON s.tree IS NOT DISTINCT FROM {tree} AND s.pos = {pos} // {8**k}
        )""")

    for k in range(leaf_levels):
        level("a", k)
    steps.append(f"""b0 AS (
        SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, node,
               count(*) OVER () AS total, tree AS lang
        FROM a{leaf_levels}
    )""")
    for k in range(group_levels):
        level("b", k)
    steps.append(f"""f0 AS (
        SELECT p.doc_id, p.lang, p.pos, p.leaf, b0.pos AS top, b0.node AS subroot,
               (SELECT node FROM b{group_levels}) AS root, '' AS proof, p.claimed AS folded
        FROM placed p JOIN b0 ON b0.lang IS NOT DISTINCT FROM p.lang
    )""")
    for k in range(leaf_levels):
        fold(f"f{k}", f"f{k + 1}", "a", k, "f.lang", "f.pos")
    for k in range(group_levels):
        at = leaf_levels + k
        fold(f"f{at}", f"f{at + 1}", "b", k, "0", "f.top")
    return ",\n".join(steps) + f"""
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root,
               folded = root AS verified
        FROM f{leaf_levels + group_levels}"""


ORACLES = {
    "op7_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                     'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents
        )
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC) = 1 AS kept,
               sha256(norm) AS text_sha256
        FROM t
    """,
    "op12_spelling": spelling_sql(),
    "op13_merkle": merkle_sql(),
}
