"""Fill-in-the-middle: a text is cut at two ranks of its units and put together in another order.

The units of a text (code points, or the matches of a pattern and what stands between them) are the bottom lane of an indexable skip list. Every
link carries two widths: the units and the code points it passes. A rank in units is reached from the top lane down by adding up the widths of
the links that do not pass it; the code points added on the way are the exact place of the cut in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import slices

#: Marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
#: Of 100 texts, how many stay plain; of 100 others, how many start with the suffix.
PLAIN, SUFFIX_FIRST = 10, 20
#: One node of this many goes up to the next lane.
FAN = 8


def _heights(n: int) -> np.ndarray:
    """The lane up to which each of the first ``n`` nodes reaches: a fixed sequence of coins, so every worker builds the same lists."""
    x = np.arange(1, n + 1, dtype=np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    # Of FAN equal coins one goes up a lane; a lane more for each further base-FAN digit that is 0.
    out, coin = np.zeros(n, np.int8), x >> np.uint64(4)
    up = np.ones(n, bool)
    for _ in range(20):
        up &= coin % np.uint64(FAN) == 0
        if not up.any():
            break
        out += up
        coin //= np.uint64(FAN)
    return out


@lru_cache(32)
def _lanes(n: int) -> list[np.ndarray]:
    """For each express lane the bottom places of its nodes among the first ``n``; the head, place 0, is in all."""
    heights, out = _heights(n), []
    for lane in range(1, int(heights.max(initial=0)) + 1):
        out.append(np.union1d([0], np.flatnonzero(heights >= lane)))
    return out


def _room(n: int) -> int:
    """A power of two of at least ``n``, so that few sequences are made."""
    return 1 << max(12, (n - 1).bit_length())


class SkipList:
    """The units of one text; ``widths`` are their code points, None where each unit is one."""

    def __init__(self, n: int, widths: np.ndarray | None = None):
        self.n = n
        ends = None if widths is None else np.concatenate(([0], np.cumsum(widths, dtype=np.int64)))
        self.bottom = widths
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # bottom places, unit widths, code-point widths
        for at in _lanes(_room(n)) if n else []:
            at = at[: np.searchsorted(at, n)]
            if len(at) < 2:
                break
            units = np.diff(at, append=n)
            self.lanes.append((at, units, units if ends is None else np.diff(ends[at], append=ends[n])))

    def seek(self, rank: int) -> int:
        """The code points before unit ``rank``, from 0 to n."""
        place = points = 0  # of the node reached: its bottom place, which is also the units passed
        node = 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            at, units, widths = self.lanes[lane]
            while node < len(at) and place + units[node] <= rank:
                place += int(units[node])
                points += int(widths[node])
                node += 1
            if node == len(at):  # the end of the list
                return points
            # The same node one lane down.
            node = int(np.searchsorted(self.lanes[lane - 1][0], place)) if lane else place
        while place < rank:
            points += 1 if self.bottom is None else int(self.bottom[place])
            place += 1
        return points


def numbers(key: str, seed: int) -> tuple[int, int, int, int]:
    """The first four 8-digit groups of the hex sha256 of seed, colon and key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def turned(text: str, key: str, seed: int = 1, unit=None, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of the prefix and of the middle, and the text in that form."""
    if unit is None:
        n, widths = len(text), None
    else:
        widths, last = [], 0
        for m in unit.finditer(text):
            if m.start() > last:
                widths.append(m.start() - last)
            if m.end() > m.start():
                widths.append(m.end() - m.start())
            last = max(last, m.end())
        if last < len(text):
            widths.append(len(text) - last)
        n, widths = len(widths), np.array(widths, np.int64)
    h1, h2, h3, h4 = numbers(key, seed)
    if not text or any(m in text for m in MARKS) or h3 % 100 >= 100 - plain:
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    found = SkipList(n, widths)
    a, b = found.seek(first), found.seek(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), seed: int = 1, unit: str | None = None,
              plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, rows: int = 256) -> DataFrame:
    """Per row: the ``keep`` columns, n (units), form, prefix_chars, middle_chars (code points) and output, of whole texts of any length.

    ``unit`` is a pattern; its matches, left to right, and the stretches between them are the units, so nothing is lost; None makes every code point a
    unit. Null is an empty text; empty texts and texts that hold a mark are plain, with null prefix_chars and middle_chars. The cuts come from a
    hash of ``seed`` and the key (a null key: of the empty string), so a repeated row is cut alike, and a row has the same result however
    often and wherever it is computed. An empty table gives no rows. Other columns are not read.
    """
    frame = docs.select(*[docs[c] for c in keep], docs[key].cast("string").alias("_key"), docs[text].alias("_text"))
    kept, pos = list(keep), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = None if unit is None else regex.compile(unit)
        for b in slices(batches, rows):
            found = [turned(t or "", k or "", seed, pattern, plain, suffix_first) for k, t in zip(b.column(pos).to_pylist(), b.column(pos + 1).to_pylist())]
            n, form, prefix, middle, output = zip(*found) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(pos)] + [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                [*kept, "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema[: len(keep)])
    return frame.mapInArrow(run, f"{ddl}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. No text that is turned holds a mark, so the marks of an output are exactly three."""
    part = F.split(output, "|".join(re.escape(m) for m in MARKS), -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)
