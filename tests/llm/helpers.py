"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHES = ("size", "fp", "key", "label", "line", "score", "rank", "bucket", "copies", "predicted",
           "n_lines", "n_dropped", "place", "row", "tile", "term", "words", "__nr_")


def prose(n: int, seed: int = 0) -> str:
    return " ".join(WORDS[(i * i * 7 + i * 3 + seed * 13) % len(WORDS)] + str((i * seed) % 5) for i in range(n))


def edge_rows() -> list[tuple]:
    long_text = "\n".join(prose(400, s) for s in range(30))
    rows = [(1, prose(80, 1), "en", "a"), (2, prose(80, 1), "en", "a"), (3, prose(80, 1) + " x", "de", "b"),
            (4, "", "en", "b"), (5, None, None, None), (6, " \t\n ", "fr", None), (7, long_text, "en", "a"),
            (8, "Ünïcode ☃ 漢字 text, no. 1\n\nUnicode", "de", "c"), (9, "one", "en", "c"),
            (10, "one two", "en", "c"), (None, prose(60, 2), "en", "a"), (None, None, None, None),
            (12, prose(60, 3), "en", "a"), (12, prose(60, 3), "en", "a"), (13, prose(60, 4), None, "a")]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def edge_docs(spark, clashing: bool = True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    return df.withColumns({c: F.lit("?") for c in CLASHES}) if clashing else df


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
