"""License notices in texts: exact phrases, and short notices found with spelling errors.

A phrase with at most k edits keeps at least one of any k + 1 disjoint pieces unchanged (pigeonhole).
So each phrase is cut into k + 1 seeds; an exact search for the seeds finds candidate places, and the
regex library's bounded-error matching then decides on a small window around each candidate.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Phrases that count where they stand word for word, with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Short notices searched with errors, label and most edits. "cc by" is too short for an edit.
NOTICES = (
    ("gnu general public license", "gpl", 3),
    ("apache license", "apache", 2),
    ("mit license", "mit", 1),
    ("gnu lesser general public license", "lgpl", 3),
    ("mozilla public license", "mpl", 2),
    ("creative commons attribution", "cc-by", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 8),
    ("redistribution and use in source and binary forms", "bsd", 5),
)

SCHEMA = "n_words bigint, base array<struct<label:string,first:bigint,last:bigint>>, spans array<struct<label:string,start:bigint,stop:bigint,edits:int,likeness:double>>"

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class _Notice:
    size: int
    edits: int
    label: str
    seeds: tuple[tuple[str, int], ...]
    pattern: object
    first: object


def _notice(phrase: str, label: str, edits: int) -> _Notice:
    cuts = [round(i * len(phrase) / (edits + 1)) for i in range(edits + 2)]
    seeds = tuple((phrase[a:b], a) for a, b in zip(cuts, cuts[1:]))
    fuzzy = "(?<![^ ])(?:" + regex.escape(phrase, literal_spaces=True) + "){e<=%d}(?![^ ])" % edits
    return _Notice(len(phrase), edits, label, seeds, regex.compile("(?b)" + fuzzy), regex.compile(fuzzy))


def _matches(pattern, text: str, a: int, b: int) -> list:
    """The best match between two places, then the best ones before and after it, and so on; in text order.

    Between two places there is one notice, or a few that overlap, so what is searched again is short.
    """
    out, todo = [], [(a, b)]
    while todo:
        a, b = todo.pop()
        m = pattern.search(text, a, b) if a < b else None
        if m and m.end() > m.start():
            out.append(m)
            todo += [(m.end(), b), (a, m.start())]
    return sorted(out, key=lambda m: m.start())


def normal(text: str | None) -> bytes:
    """Lower-cased words of letters, digits and non-ASCII signs, with one space around each."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    return b" " + b" ".join(found) + b" " if found else b" "


def exact_places(norm: bytes, phrases: list[tuple[bytes, str, int]]) -> list[tuple[str, int, int]]:
    out = []
    for phrase, label, n in phrases:
        at, word, counted = norm.find(phrase), 0, 0
        while at >= 0:
            word, counted = word + norm.count(b" ", counted, at), at
            out.append((label, word, word + n - 1))
            at = norm.find(phrase, at + 1)
    return out


def _stretches(x: _Notice, norm: str, spaces: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches of whole words that hold all matches of a notice, none across two of them.

    A match starts at a word, within the edits of where one of its seeds says. Each such word is tried alone; words whose matches could
    reach the next start, if they took all edits, share a stretch. So a stretch is short whatever the number of notices in a text.
    """
    starts = set()
    for seed, offset in x.seeds:
        at = norm.find(seed)
        while at >= 0:
            lo, hi = bisect.bisect_left(spaces, at - offset - x.edits - 1), bisect.bisect_right(spaces, at - offset + x.edits)
            starts.update(spaces[lo:hi])
            at = norm.find(seed, at + 1)
    a = b = None
    for s in sorted(starts):
        s, far = s + 1, s + 1 + x.size + x.edits
        if s >= len(norm) or not x.first.match(norm, s, min(len(norm), far + 1)):
            continue
        end = spaces[bisect.bisect_right(spaces, far) - 1]  # of the last word in reach
        if b is not None and s < b:
            b = max(b, end)
            continue
        if b is not None:
            yield a, b
        a, b = s - 1, end  # from the space on: a search allows no insertion where it begins
    if b is not None:
        yield a, b


def fuzzy_places(norm: bytes, notices: list[_Notice]) -> list[tuple[str, int, int, int, float]]:
    """Spans (label, first word, last word, edits, likeness) of notices, the exact ones included. Edits are of signs, not of bytes."""
    norm, out, spaces = norm.decode("utf-8", "surrogatepass"), [], None
    for x in notices:
        if not any(seed in norm for seed, _ in x.seeds):
            continue
        if spaces is None:
            spaces = np.flatnonzero(np.frombuffer(norm.encode("utf-32-le", "surrogatepass"), np.uint32) == 32).tolist()
        for a, b in _stretches(x, norm, spaces):
            for m in _matches(x.pattern, norm, a, b):
                edits = sum(m.fuzzy_counts)
                raw = m.group()
                lead, tail = len(raw) - len(raw.lstrip(" ")), len(raw) - len(raw.rstrip(" "))
                lo, hi = m.start() + lead, m.end() - tail
                if lo < hi:
                    first, last = bisect.bisect_left(spaces, lo) - 1, bisect.bisect_left(spaces, hi) - 1
                    out.append((x.label, first, last, edits, 1 - edits / x.size))
    return out


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), base: dict[str, str] | None = None,
         notices: tuple[tuple[str, str, int], ...] = NOTICES) -> DataFrame:
    """Per row of ``docs``: the ``keep`` columns, n_words, exact places and fuzzy spans, in word positions from 0.

    Null and empty texts have no words and no spans. Texts are scanned whole; rows are independent, so equal rows
    give equal results and an empty table gives none. Other columns of ``docs``, also of clashing names, are not read.
    A span's ends are words, so an edit at its edge that makes a word longer counts against the bound. Overlapping
    matches of one notice are reported once, the best of them; matches beside it stay.
    """
    base = BASE if base is None else base
    frame = docs.select(*[docs[c] for c in keep], docs[text])
    kept, pos = list(keep), len(keep)
    fields = frame.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = [((" " + p + " ").encode(), label, len(p.split())) for p, label in base.items()]
        fuzzy = [_notice(*n) for n in notices]
        for b in batches:
            n_words, places, spans = [], [], []
            for t in b.column(pos).to_pylist():
                norm = normal(t)
                n_words.append(norm.count(b" ") - 1)
                places.append([dict(zip(("label", "first", "last"), x)) for x in exact_places(norm, exact)])
                spans.append([dict(zip(("label", "start", "stop", "edits", "likeness"), x)) for x in fuzzy_places(norm, fuzzy)])
            base_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))
            span_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("edits", pa.int32()), ("likeness", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(pos)] + [pa.array(n_words, pa.int64()), pa.array(places, base_type), pa.array(spans, span_type)],
                kept + ["n_words", "base", "spans"],
            )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields[: len(keep)])
    return frame.mapInArrow(run, f"{ddl}, {SCHEMA}")
