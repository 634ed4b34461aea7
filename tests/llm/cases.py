"""Small documents that the tests of all operators share."""

import random

from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = ["gone", "rejected", "doc", "tag", "spans", "ranked", "digest", "rep", "key", "node", "part", "fold", "row", "keep", "sig", "__ranked", "__digest", "digest_", "plain", "locator", "place", "copy", "group_size", "stays", "a`b", "a.b"]


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def docs(spark, rows):
    """A documents table of (doc_id, text) or (doc_id, text, lang) rows, with columns whose names clash."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, COLUMNS).withColumns({c: F.lit(c) for c in CLASHING})


def odd_rows():
    """Null ids and texts, empty and very long texts, repeated rows, and one id with two texts."""
    long = " ".join(words(1, 30_000))
    return [
        (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (4, "one"), (5, long), (6, long), (None, "null id text of five words"),
        (None, None), (7, "a b c d"), (8, "A b c D"), (9, "x" * 5000), (10, "é\u2028ß 日本語 \U0001f600 \x00"), (11, "two"), (11, "texts"),
        (-5, " ".join(words(2, 80))), (12, " ".join(words(2, 80))), (2**62, "{}|<>\\ \"quoted\" 'it's'"),
    ]


def pairs(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
