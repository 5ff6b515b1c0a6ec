"""Fill-in-the-middle: the skip list against plain prefix sums, the turned texts against a plain version and back."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import fill_middle
from tests.llm.cases import edge_texts, frame, prose


@pytest.mark.parametrize("n", [0, 1, 2, 7, 63, 64, 65, 700, 5_000, 70_000])
def test_skip_list_reaches_every_rank(n):
    rng = random.Random(n)
    widths = np.array([rng.randint(1, 9) for _ in range(n)], np.int64)
    ends = np.concatenate(([0], np.cumsum(widths)))
    lists = fill_middle.SkipList(n, widths), fill_middle.SkipList(n)
    for rank in {0, n, n // 2, max(0, n - 1), *[rng.randint(0, n) for _ in range(200)]}:
        assert lists[0].seek(rank) == ends[rank] and lists[1].seek(rank) == rank
    assert n < 5_000 or len(lists[0].lanes) >= 3


def plain_units(text, unit):
    if unit is None:
        return list(text)
    import re

    return [x for x in re.split(f"({unit})", text) if x]


def expected(key, text, unit=None):
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    u = plain_units(text, unit)
    n = len(u)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", [None, "[a-z0-9]+"])
def test_turned_as_the_plain_version_and_back(spark, unit):
    rng = random.Random(5)
    rows = edge_texts() + [(100 + i, prose(rng, rng.randint(0, 90)) + rng.choice(["", "é\U0001f600 ", "<", "<S", "<P>", ">"]), "en", "s0") for i in range(150)]
    docs = frame(spark, rows)
    found = fill_middle.transform(docs, keep=("doc_id", "text", "score"), unit=unit)
    found = found.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == len(rows)
    for r in found:
        text = r.text or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, text, unit)
        assert r.back == text
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_no_rows_and_all_plain(spark):
    docs = frame(spark, edge_texts())
    assert fill_middle.transform(docs.where("false")).count() == 0
    assert {r.form for r in fill_middle.transform(docs, plain=100).collect()} == {"plain"}
