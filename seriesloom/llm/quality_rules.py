"""Quality rules as a short-circuit cascade, ordered by what a sample says about cost and rejection.

A rule is a condition that rejects a document. Each one is timed and counted on a sample; the cascade asks the rules with the
most rejections per second first, as one CASE expression that stops at the first rule that rejects. The order changes
which rule is named and what is spent, never which documents stay.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import WORD, let, words, written

# Signs that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Rows of the sample that orders the rules, about; and times that each rule is asked there.
SAMPLE_ROWS, REPEATS = 2_000, 4


@dataclass(frozen=True)
class Rule:
    """A document is rejected where ``rejects`` holds; it may use the text (``t``) and the measures (``m``)."""

    name: str
    rejects: Column


def repeat_words(found: Column) -> Column:
    """Words that stand in a 3-word window which the text has twice or more, the first one included.

    Windows are compared by 64-bit hashes. Most texts repeat nothing and stop after one distinct.
    """

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def repeated(h: Column) -> Column:
        sorted_ = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = lambda s, p, i: (F.get(s, i - 1)["h"] == p["h"]) | (F.get(s, i + 1)["h"] == p["h"])
        at = let(sorted_, lambda s: F.sort_array(F.transform(F.filter(s, lambda p, i: F.coalesce(same(s, p, i), F.lit(False))), lambda p: p["i"])))
        steps = let(at, lambda a: F.transform(a, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(a, i + 1) - p, F.lit(3)))))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    return let(found, lambda w: let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(repeated(h))))


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns as a struct ``k``, the text ``t`` and its measures ``m``; null counts as empty.

    Measures: n_words, word_chars, n_symbols, n_lines and n_dup_lines (lines with a word), n_repeat_words, all long.
    """
    t, f = F.col("t"), docs.select(F.struct(*[docs[c] for c in keep]).alias("k"), F.coalesce(docs[text], F.lit("")).alias("t"))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    length = F.char_length(t)
    f = f.select("k", "t", words(t).alias("w"), let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("one"))).alias("n"))
    long = {
        "n_words": F.size("w"),
        "word_chars": F.char_length(F.translate(t, " \t\n\x0b\f\r", "")),
        "n_symbols": length - F.char_length(F.translate(t, SYMBOLS, "")),
        "n_lines": F.col("n.all"),
        "n_dup_lines": F.col("n.all") - F.col("n.one"),
        "n_repeat_words": repeat_words(F.col("w")),
    }
    return f.select("k", "t", F.struct(*[v.cast("bigint").alias(c) for c, v in long.items()]).alias("m"))


def base_failed() -> Column:
    return (F.col("m.n_words") < 50) | (100 * F.col("m.n_repeat_words") > 50 * F.col("m.n_words"))


def rules() -> list[Rule]:
    """The production rules: the base, then signs of junk. A clean text of any script passes all."""
    t, m = F.col("t"), lambda c: F.col(f"m.{c}")
    capitals = F.char_length(t) - F.char_length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    other = F.char_length(F.regexp_replace(t, r"[\p{L}\p{M}\x20\x09-\x0D]+", ""))
    return [
        Rule("base", base_failed()),
        Rule("symbols", 100 * m("n_symbols") > 30 * m("n_words")),
        Rule("repeated_lines", (m("n_dup_lines") >= 3) & (100 * m("n_dup_lines") > 30 * m("n_lines"))),
        Rule("capitals", 100 * capitals > 40 * m("word_chars")),
        Rule("few_letters", 100 * other > 40 * m("word_chars")),
        Rule("unbroken", t.rlike(r"[\x21-\x7E]{300,}")),
    ]


def sampled(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` rows from all over the table, each taken by a throw of its own; all of a smaller table.

    No row is moved for it: each task keeps its own share, so neither a task nor the driver gets more with more partitions.
    """
    n = docs.count()
    return docs.sample(rows / n, seed=7) if n > rows else docs


def ordered(sample: DataFrame, found: list[Rule]) -> list[tuple[Rule, float, float]]:
    """Rules by rejections per second on measured rows of a sample, with their seconds per pass and rejected share.

    A rule is asked REPEATS times for each row within one job, after a job that asks nothing, so what a job costs by itself is taken
    off and weighs little. An empty table keeps the given order.
    """
    rows = written(sample.select("t", "m")).coalesce(1).withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def timed(condition: Column) -> tuple[float, int, int]:
        asked = rows.select(F.count("*").alias("n"), F.sum(condition.cast("int")).alias("bad"))
        start = time.perf_counter()
        row = asked.first()
        return time.perf_counter() - start, row.n, row.bad or 0

    nothing = min(timed(F.lit(False))[0] for _ in range(2))
    out = []
    for r in found:
        seconds, n, bad = timed(r.rejects)
        out.append((r, max(seconds - nothing, 1e-4) / REPEATS, bad / n if n else 0.0))
    return sorted(out, key=lambda x: -x[2] / x[1])


def cascade(frame: DataFrame, found: list[Rule]) -> DataFrame:
    """``frame`` with ``failed_rule``, the first rule of ``found`` that rejects the row, null where none does."""
    chain = F
    for r in found:
        chain = chain.when(r.rejects, F.lit(r.name))
    return frame.withColumn("failed_rule", chain if found else F.lit(None).cast("string"))


def judge(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), found: list[Rule] | None = None,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row of ``docs``: struct ``k`` of the ``keep`` columns, text ``t``, measures ``m``, base_failed, failed_rule, kept.

    A null or empty text has no words and fails the base. Rows are independent: equal rows get equal verdicts and an empty table gives
    none. Columns that are not in ``keep`` are not read, so their names may be anything.
    """
    sample = measured(sampled(docs.select(*[docs[c] for c in dict.fromkeys((*keep, text))]), sample_rows), text, keep)
    asked = [r for r, _, _ in ordered(sample, rules() if found is None else found)]
    return cascade(measured(docs, text, keep), asked).select("k", "t", "m", base_failed().alias("base_failed"), "failed_rule", F.col("failed_rule").isNull().alias("kept"))
