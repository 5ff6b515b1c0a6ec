"""Exact token counts of a public tokenizer, huge documents in overlapping chunks.

A place where a sign that is not white space meets a space, tab or line end is *stable*: the tokenizer's split
pattern has no alternative that goes on from a solid sign into white space, none looks back, and merges stay
inside a piece. So every encoding has a token boundary there, whatever stands before or after. Two uses:

* A huge document is encoded in chunks that overlap. The encodings of neighbours are compared in the overlap; they
  are spliced at a stable place up to which, from the stable place before it, both have the same tokens. Where there is
  none, the overlap doubles, up to the whole rest.
* Other documents are cut at all stable places, on the bytes of a whole batch at once, and every unit is encoded once per worker: Arrow names the
  different units of a batch, only these are looked up, and each text sums the counts of its units. Where the split pattern is known to part a letter
  from a mark after it, texts are cut there too. A unit of plain letters (most are) goes straight to the model, which is asked once per word.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Signs of a chunk and of its first overlap.
CHUNK = 32_768
OVERLAP = 512
#: Units a worker remembers; then it starts anew.
REMEMBERED = 1_000_000

_WHITE = np.isin(np.arange(256), list(b" \t\n\r"))
# White space of other kinds: a place beside it is not taken as stable.
_ODD_SIGNS = "".join(map(chr, (0x180E, 0x200B, 0xFEFF)))
_ODD = re.compile(rf"[^\S \t\n\r]|[{_ODD_SIGNS}]")
_STABLE = re.compile(rf"(?<=[^\s{_ODD_SIGNS}])(?=[ \t\n\r])")

# Letters and marks for which the split pattern of byte-level vocabularies is sure: a word with the space before it ends at a mark, where a new piece begins.
_LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
_PLAIN = rf"\A ?[{_LETTERS}]+\z"
_MARKS = re.compile(r"[.,;:!?]+")
_MARK = np.isin(np.arange(256), list(b".,;:!?"))
_LETTER = np.array([chr(b).isalpha() for b in range(128)] + [False] * 128)
_BY_LETTER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
# No count: the text of such a unit is encoded whole.
_WHOLE = -1


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself where it is printable, else the next free one from 256."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {**{b: chr(b) for b in seen}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_SIGNS = _byte_signs()


def _byte_level(unit: str) -> str:
    """A unit in the signs of the vocabulary."""
    return unit.replace(" ", _SIGNS[0x20]) if unit.isascii() else unit.encode().decode("latin-1").translate(_SIGNS)


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class Counter:
    """Token counts of whole texts, as ``tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, tokenizer, chunk: int = CHUNK, overlap: int = OVERLAP, remembered: int = REMEMBERED):
        self.tokenizer, self.chunk, self.overlap, self.remembered = tokenizer, chunk, overlap, remembered
        self.known: dict[str, int] = {}
        self.plain = self._parts_plainly(tokenizer)
        self.widened = 0

    @staticmethod
    def _parts_plainly(tokenizer) -> bool:
        """Does this tokenizer take a ``_PLAIN`` unit as one piece and part letters from marks, with nothing before or after the model?"""
        if tokenizer.normalizer is not None or tokenizer.post_processor is not None or tokenizer.pre_tokenizer is None:
            return False
        split = json.loads(tokenizer.pre_tokenizer.__getstate__())
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        return {k: split.get(k) for k in _BY_LETTER} == _BY_LETTER and not any(re.fullmatch(rf"[ {_LETTERS}.,;:!?]*[{_LETTERS}][ {_LETTERS}.,;:!?]*", t) or re.search(r"\w[.,;:!?]", t) for t in added)

    def count(self, texts: list[str]) -> list[int]:
        return self.counts(pa.array(texts, pa.large_string())).tolist()

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of a string array; null is empty."""
        texts = texts.fill_null("").cast(pa.large_string())
        huge = pc.greater(pc.utf8_length(texts), self.chunk).to_numpy(zero_copy_only=False)
        found = np.full(len(texts), _WHOLE, np.int64)
        found[~huge] = self._by_units(texts.filter(pa.array(~huge)) if huge.any() else texts)
        for i in np.flatnonzero(found < 0):
            found[i] = self._huge(texts[i].as_py())
        return found

    def _by_units(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text, the sum of its units; ``_WHOLE`` where a unit has no count of its own."""
        if not len(texts) or not pc.sum(pc.binary_length(texts)).as_py():
            return np.zeros(len(texts), np.int64)
        _, offsets, signs = texts.buffers()
        ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        first, ends = ends[0], ends - ends[0]
        data = np.frombuffer(signs, np.uint8)[first : first + ends[-1]]
        white = _WHITE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = white[1:] > white[:-1]
        if self.plain:
            cut[self._after_letters(data)] = True
        cut[ends] = True
        places = np.flatnonzero(cut)
        units = pa.Array.from_buffers(pa.large_string(), len(places) - 1, [None, pa.py_buffer(places + first), signs]).dictionary_encode()
        counts = self._known(units.dictionary.to_numpy(zero_copy_only=False).tolist())[units.indices.to_numpy()]
        upto = np.searchsorted(places, ends)  # units before each text, and all
        whole, sums = (np.concatenate(([0], np.cumsum(x)))[upto] for x in (counts < 0, counts))
        return np.where(np.diff(whole) > 0, _WHOLE, np.diff(sums))

    @staticmethod
    def _after_letters(data: np.ndarray) -> np.ndarray:
        """Places of the marks that stand behind a letter of ``_LETTERS`` or the rest of its block: one byte, or two from C3 80 but for the signs of times and division."""
        marks = np.flatnonzero(_MARK[data[1:]]) + 1
        last, lead = data[marks - 1], data[np.maximum(marks - 2, 0)]
        two = (last >= 0x80) & (lead >= 0xC3) & (lead <= 0xC9) & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
        return marks[_LETTER[last] | two]

    def _known(self, units: list[str]) -> np.ndarray:
        """The count of each unit; those not remembered are learned. The units differ."""
        found = list(map(self.known.get, units))
        gaps = [i for i, n in enumerate(found) if n is None]
        if gaps:
            if len(self.known) + len(gaps) > self.remembered:
                self.known = {}
            new = [units[i] for i in gaps]
            learned = self._learn(new)
            self.known.update(zip(new, learned))
            for i, n in zip(gaps, learned):
                found[i] = n
        return np.array(found, np.int64)

    def _learn(self, units: list[str]) -> list[int]:
        found, tokens = np.full(len(units), _WHOLE, np.int64), self.tokenizer.model.tokenize
        plain = pc.match_substring_regex(pa.array(units, pa.large_string()), _PLAIN).to_numpy(zero_copy_only=False) & self.plain
        found[plain] = [len(tokens(_byte_level(u))) for u in compress(units, plain)]
        rest = []
        for i in np.flatnonzero(~plain):
            if _MARKS.fullmatch(units[i]):
                found[i] = len(self.tokenizer.encode(units[i], add_special_tokens=False))
            elif not _ODD.search(units[i]):
                rest.append(i)
        for at in range(0, len(rest), 10_000):
            part = rest[at : at + 10_000]
            found[part] = list(map(len, self.tokenizer.encode_batch_fast([units[i] for i in part], add_special_tokens=False)))
        return found.tolist()

    def _encode(self, text: str, start: int, stop: int):
        return self.tokenizer.encode(text[start:stop], add_special_tokens=False)

    def _huge(self, text: str) -> int:
        return sum(j - i for _, _, i, j in self._spliced(text))

    def pieces(self, text: str) -> Iterator[tuple[list[int], list[tuple[int, int]]]]:
        """Token ids and offsets of a text, chunk by chunk, spliced."""
        for found, base, i, j in self._spliced(text):
            yield found.ids[i:j], [(a + base, b + base) for a, b in found.offsets[i:j]]

    def _spliced(self, text: str) -> Iterator[tuple]:
        """The encoding of each chunk, the chunk's first sign, and the first of its tokens that count and the end of them."""
        start, n = 0, len(text)  # all before start is done; start is a stable place
        base, done = 0, 0  # of the encoding on the left: its first sign, and its first token from start on
        left = self._encode(text, 0, min(n, self.chunk))
        stop = min(n, self.chunk)
        while stop < n:
            back, splice = self.overlap, None
            while splice is None:
                begin = max(start, stop - back)
                if begin == start:  # no stable place in the whole chunk: it grows
                    stop = min(n, stop + max(self.chunk, stop - start))
                    left, base, done = self._encode(text, start, stop), start, 0
                    self.widened += 1
                    back = self.overlap
                    if stop == n:
                        break
                    continue
                ahead = min(n, begin + self.chunk + back)
                right = self._encode(text, begin, ahead)
                splice = self._splice(text, left, base, right, begin, stop)
                if splice is None:
                    back *= 2
                    self.widened += 1
            if splice is None:
                break
            place, i, j = splice
            yield left, base, done, i
            start, stop, left, base, done = place, ahead, right, begin, j
        yield left, base, done, len(left)

    @staticmethod
    def _splice(text: str, left, base: int, right, begin: int, stop: int) -> tuple[int, int, int] | None:
        """The last stable place of the overlap whose tokens since the stable place before are the same in both: the place, and its token in each."""
        places = [m.start() for m in _STABLE.finditer(text, begin, stop) if m.start() > begin]
        if len(places) < 2:
            return None
        ids = left.ids, right.ids
        for p, q in zip(places[-2::-1], places[:0:-1]):
            at = [_token_from(found, y - first) for found, first in ((left, base), (right, begin)) for y in (p, q)]
            if None not in at and ids[0][at[0] : at[1]] == ids[1][at[2] : at[3]]:
                return q, at[1], at[3]
        return None


def _token_from(found, sign: int) -> int | None:
    """The first token of an encoding that begins at a sign of its text."""
    i = found.char_to_token(sign)
    return i if i is not None and found.token_to_chars(i)[0] == sign else None


@lru_cache(1)
def _counter(path: str, chunk: int, overlap: int) -> Counter:
    """The worker's counter: tasks that run in one worker, one after the other, share what it remembers (at most REMEMBERED units)."""
    return Counter(load(path), chunk, overlap)


def count(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), chunk: int = CHUNK,
          overlap: int = OVERLAP, limit: int = 512, rows: int = 256) -> DataFrame:
    """Per row: the ``keep`` columns, n_bytes (UTF-8), n_tokens and over_limit, of whole texts.

    ``path`` is a byte-level tokenizers file that every executor has; stability is proven for its split pattern. Null is
    empty; an empty text has no tokens. No truncation, padding or added tokens; special strings inside a text are taken as
    the library does by default. Rows are independent, equal rows give equal results, an empty table none. Other columns are not read.
    """
    frame = docs.select(*[docs[c] for c in keep], docs[text])
    kept, pos = list(keep), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, chunk, overlap)
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                b = whole.slice(at, rows)
                texts = b.column(pos).fill_null("")
                n = counter.counts(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(i) for i in range(pos)] + [pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                    kept + ["n_bytes", "n_tokens", "over_limit"],
                )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema[: len(keep)])
    return frame.mapInArrow(run, f"{ddl}, n_bytes bigint, n_tokens bigint, over_limit boolean")
