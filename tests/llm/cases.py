"""Small tables with every awkward case, and plain versions of the operators' contracts."""

import random
import re

from pyspark.sql import types as T

WORDS = ["the", "of", "thing", "water", "der", "und", "haus", "que", "el", "casa", "le", "mais", "x1", "a", "stone", "Ünder", "ÇA", "naïve"]

#: The columns of documents and some whose names the operators use themselves.
SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "n_chars", "length", "bucket", "w")]
    + [T.StructField(n, T.StringType()) for n in ("text", "lang", "source", "score", "kept", "t", "k", "m", "cls", "block", "ids", "row")]
)


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", "\n"]) for _ in range(n))


def edge_texts() -> list[tuple]:
    """(doc_id, text, lang, source): nulls, empties, very long texts, copies, ties, repeated rows."""
    rng = random.Random(7)
    base = prose(rng, 120)
    near = base.replace("stone", "rock", 1)
    long = prose(rng, 30_000)
    rows = [
        (1, base, "en", "s0"), (2, near, "en", "s0"), (3, base, "en", "s1"), (4, None, "en", "s0"), (5, "", None, None), (6, " \n\t ", "de", "s0"),
        (7, "one", "en", None), (8, "one two three four", "fr", "s1"), (9, long, "en", "s0"), (10, long + " end", None, "s2"),
        (11, "word " * 300, "en", "s0"), (12, "中文" * 40, "zh", "s3"), (13, "123 456 !!! ###", "en", "s0"), (14, "z" * 50_000, "en", "s0"), (15, "a\x00b \U0001f600 \x1c \xa0 é", "en", "s0"),
        (None, base, "en", "s0"), (None, None, None, None), (16, base.upper(), "en", "s0"), (16, base.upper(), "en", "s0"), (17, near, None, "s0"),
        (18, "A\nA\nA\nB\n\n" * 30, "en", "s0"), (19, "<|endoftext|> and <|endoftext|>", "en", "s0"), (20, prose(rng, 60), "de", "s0"), (21, prose(rng, 400), "es", "s0"),
    ]
    return rows


def frame(spark, rows):
    full = [(d, len(t or ""), 5, 6, 7, t, lang, source, *["x"] * 9) for d, t, lang, source in rows]
    return spark.createDataFrame([tuple(r) for r in full], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
