"""Language identification with spans: scripts narrow the candidates, Viterbi labels the words.

Training counts the parts of words (2 to 4 signs, word ends marked, and whole words) per language with grouped aggregation on a bounded
sample. A word's score for a language is its parts' mean log probability per order. A text is then labelled by the best path over
its words, where each change of language costs a penalty: a stretch in another language is a span when its gain exceeds two
penalties. The predicted language is the one with the most letters.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the training sample, in different documents of each language, and of the model, in word parts.
SAMPLE_DOCS, PARTS = 2_000, 60_000
ORDERS = 4
#: Cost of a change of language, in log probability.
PENALTY = 16.0
#: Words that a worker remembers; then it starts anew.
REMEMBERED = 250_000
UNKNOWN = "und"

# First and last code points of scripts.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF)),
}
OTHER = "other"
#: Signs below this are taken as Latin.
LATIN_END = 0x250

_WORD = re.compile(r"[^\W\d_]+")


def script(word: str) -> str:
    at = ord(word[0])
    if at < LATIN_END:
        return "latin"
    return next((s for s, ranges in SCRIPTS.items() if any(a <= at <= b for a, b in ranges)), OTHER)


def script_column(word: Column) -> Column:
    at, out = F.ascii(word), F
    for name, ranges in SCRIPTS.items():
        for a, b in ranges:
            out = out.when(at.between(a, b), F.lit(name))
    return out.otherwise(F.lit(OTHER))


def lowered(text: str) -> str:
    """Lower case with the same number of signs."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def parts(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + n] for n in range(2, ORDERS + 1) for i in range(len(w) - n + 1)] + [f"={word}"]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prior: np.ndarray  # log share of each language
    rows: dict[str, int]  # word part -> row of scores
    scores: np.ndarray  # (parts, languages)
    scripts: dict[str, np.ndarray]  # script -> which languages use it


def train(docs: DataFrame, text: str = "text", lang: str = "lang", where: Column | None = None, sample_docs: int = SAMPLE_DOCS, most_parts: int = PARTS) -> Model:
    """Learn from at most about ``sample_docs`` texts of each language, chosen by a hash of the text, all where there are fewer; a repeated text counts once.

    The model keeps the ``most_parts`` word parts with the largest share of any one language's, so a language with few texts keeps its own. Null texts and languages are left out. One row per language and one per
    part come to the driver; languages are taken to be few (hundreds).
    """
    d = docs if where is None else docs.where(where)
    d = d.select(docs[text].alias("t"), docs[lang].alias("l")).where("t IS NOT NULL AND l IS NOT NULL")
    counted = {r.l: r.n for r in d.groupBy("l").agg(F.count("*").alias("n")).collect()}
    langs = tuple(sorted(counted))
    if not langs:
        return Model((), np.zeros(0), {}, np.zeros((0, 0)), {})
    rate = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, sample_docs / counted[k])))])
    sample = d.where(F.pmod(F.xxhash64("t"), F.lit(1_000_000)) < F.element_at(rate, F.col("l")) * 1_000_000).groupBy("l", "t").agg(F.count("*").alias("copies"))
    word = F.explode(F.regexp_extract_all(F.lower("t"), F.lit(r"\p{L}+"), F.lit(0)))
    words = sample.select("l", word.alias("w")).groupBy("l", "w").agg(F.count("*").alias("n")).persist()
    marked = F.concat(F.lit("^"), F.col("w"), F.lit("$"))
    of_order = lambda n: F.when(F.length(marked) >= n, F.transform(F.sequence(F.lit(1), F.length(marked) - n + 1), lambda i: F.substring(marked, i, F.lit(n))))
    every = F.concat(*[F.coalesce(of_order(n), F.array().cast("array<string>")) for n in range(2, ORDERS + 1)], F.array(F.concat(F.lit("="), "w")))
    by_lang = [F.sum(F.when(F.col("l") == k, F.col("n")).otherwise(0)).alias(f"c{i}") for i, k in enumerate(langs)]
    used = words.groupBy("l", script_column(F.col("w")).alias("s")).agg(F.sum("n").alias("n")).collect()
    words_of = {k: max(1, sum(r.n for r in used if r.l == k)) for k in langs}
    grams = words.select("l", "n", F.explode(every).alias("g")).groupBy("g").agg(*by_lang)
    share_of = F.greatest(*[F.col(f"c{i}") / F.lit(float(words_of[k])) for i, k in enumerate(langs)], F.lit(0.0))
    found = grams.orderBy(share_of.desc(), "g").limit(most_parts).toPandas()
    words.unpersist()
    counts = found.drop(columns="g").to_numpy(np.float64)
    order = np.array([0 if g[0] == "=" and len(g) > 1 else len(g) for g in found["g"]])
    scores = np.empty_like(counts)
    for n in set(order.tolist()):
        own = counts[order == n] + 0.5
        scores[order == n] = np.log(own / own.sum(axis=0)) / ORDERS
    scores -= scores.mean(axis=1, keepdims=True)  # only differences count
    total = {k: sum(r.n for r in used if r.l == k) for k in langs}
    scripts = {s: np.array([any(r.l == k and r.s == s and r.n >= 0.01 * total[k] for r in used) for k in langs]) for s in {r.s for r in used}}
    share = np.array([counted[k] for k in langs], np.float64)
    return Model(langs, np.log(share / share.sum()), {g: i for i, g in enumerate(found["g"])}, scores, {s: m for s, m in scripts.items() if m.any()})


class Labeller:
    """Labels texts with a model; remembers word scores."""

    def __init__(self, model: Model, penalty: float = PENALTY, remembered: int = REMEMBERED):
        self.model, self.penalty, self.remembered = model, penalty, remembered
        self.padded = np.vstack((model.scores, np.zeros((1, len(model.languages)))))
        pieces = [(g, i) for g, i in model.rows.items() if not (g[0] == "=" and len(g) > 1)]
        self.alphabet = np.array(sorted({ord(c) for g, _ in pieces for c in g}) or [0], np.uint32)
        if len(self.alphabet) > 0xFFFE:
            raise ValueError("the word parts have more than 65,534 different signs")
        number = {int(c): i + 1 for i, c in enumerate(self.alphabet)}
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(2, ORDERS + 1):
            own = sorted((sum(number[ord(c)] << 16 * (n - 1 - j) for j, c in enumerate(g)), i) for g, i in pieces if len(g) == n)
            self.by_length[n] = np.array([k for k, _ in own], np.uint64), np.array([i for _, i in own], np.int64)
        self.masks = {name: True if used.all() else used for name, used in model.scripts.items()}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.model.languages)))
        self.heard = np.zeros(self.table.shape, bool)  # which languages a word is evidence for or against

    def _learn(self, words: set[str]) -> None:
        if len(self.known) + len(words) > self.remembered:
            self._forget()
        new = [w for w in words if w not in self.known]
        first = len(self.known)
        self.known.update(zip(new, range(first, first + len(new))))
        while first + len(new) > len(self.table):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            self.heard = np.concatenate((self.heard, np.zeros_like(self.heard)))
        if new:
            scores, known, first_signs = self._scored(new)
            heard = np.repeat(known[:, None], scores.shape[1], axis=1)
            latin = self.candidates("latin")
            # a script that all languages use needs no mask
            for i in (range(len(new)) if latin is not True else np.flatnonzero(first_signs >= LATIN_END).tolist()):
                candidates = self.candidates(script(new[i]))
                if candidates is not True:  # a script that no language uses says nothing
                    scores[i] = 0.0 if candidates is None else np.where(candidates, scores[i], -50.0)
                    heard[i] &= False if candidates is None else candidates
            self.table[first : first + len(new)] = scores
            self.heard[first : first + len(new)] = heard

    def _scored(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word the sum of its parts' scores, whether any part is known, and its first sign.

        All words are one array of signs, numbered by the model's alphabet (0: not in it); the parts of each length are numbers of four 16-bit
        signs, found by bisection.
        """
        signs = np.frombuffer("".join([f"^{w}$" for w in new]).encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, new), np.int64, len(new)) + 2
        ends = np.cumsum(lengths)
        word = np.repeat(np.arange(len(new)), lengths)
        left = np.repeat(ends, lengths) - np.arange(len(signs))  # signs to the end of the word, this one included
        at = np.searchsorted(self.alphabet, signs)
        code = np.where(self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == signs, at + 1, 0).astype(np.uint64)
        scores, known = np.zeros((len(new), self.padded.shape[1])), np.zeros(len(new), bool)

        def add(owner: np.ndarray, rows: np.ndarray) -> None:
            if len(owner):
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                scores[owner[starts]] += np.add.reduceat(self.padded[rows], starts, axis=0)
                known[owner[starts]] = True

        for n, (keys, rows) in self.by_length.items():
            m = len(signs) - n + 1
            if m <= 0 or not len(keys):
                continue
            key, whole = np.zeros(m, np.uint64), left[:m] >= n
            for i in range(n):
                part = code[i : i + m]
                key = (key << np.uint64(16)) | part
                whole &= part > 0
            found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = np.flatnonzero(whole & (keys[found] == key))
            add(word[hit], rows[found[hit]])
        row = self.model.rows.get
        entire = [(i, r) for i, w in enumerate(new) if (r := row(f"={w}")) is not None]
        if entire:
            owner, rows = np.array(entire).T
            add(owner, rows)
        return scores, known, signs[ends - lengths + 1]

    def candidates(self, script_: str) -> np.ndarray | bool | None:
        """Which languages use a script: an array, True for all, None for none."""
        found = self.model.scripts.get(script_)
        return None if found is None else self.masks[script_]

    def path(self, score: np.ndarray) -> np.ndarray:
        """The best language of each word."""
        total = score.sum(axis=0) + self.model.prior
        best = int(total.argmax())
        # A stretch in another language gains its lead over the best one; of two stretches one may lead from the start, with its prior. Where neither
        # two such leads and the gap of the priors reach the penalty of the change between them, no path with changes is better.
        ahead = np.cumsum(score - score[:, best : best + 1], axis=0)
        low = np.minimum.accumulate(np.vstack((np.zeros((1, score.shape[1])), ahead[:-1])), axis=0)
        if 2 * max((ahead - low).max(), 0.0) + self.model.prior.max() - self.model.prior[best] <= self.penalty:
            return np.full(len(score), best)
        rows = score.tolist()
        value = [a + b for a, b in zip(self.model.prior.tolist(), rows[0])]
        came = []
        for row in rows[1:]:
            top = max(range(len(value)), key=value.__getitem__)
            least = value[top] - self.penalty
            came.append([k if v >= least else top for k, v in enumerate(value)])
            value = [(v if v >= least else least) + s for v, s in zip(value, row)]
        at = max(range(len(value)), key=value.__getitem__)
        out = [at]
        for c in reversed(came):
            at = c[at]
            out.append(at)
        return np.array(out[::-1])

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        low = [lowered(t or "") for t in texts]
        words = [_WORD.findall(t) for t in low] if self.model.languages else [[] for _ in texts]
        self._learn({w for ws in words for w in ws})
        return [self._one(t, w) for t, w in zip(low, words)]

    def _one(self, text: str, words: list[str]) -> tuple[str, float, list[tuple[int, int, str]]]:
        if not words:
            return UNKNOWN, 0.0, []
        langs = self.model.languages
        rows = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        score = self.table[rows]
        path = self.path(score)
        sizes = np.fromiter(map(len, words), np.float64, len(words))
        letters = np.bincount(path, sizes, len(langs))
        best = int(letters.argmax())
        # The prior chooses where words do not, but is no evidence: neither it nor words that say nothing make a verdict sure.
        heard = sizes[(path == best) & self.heard[rows, best]].sum()
        own = score[path == best].sum(axis=0)
        gap = own[best] - np.delete(own, best).max() if len(langs) > 1 else math.inf
        sure = 1 / (1 + math.exp(-max(min(gap, 50), -50)))
        change = np.flatnonzero(np.diff(path)) + 1
        if len(change):
            at = [m.span() for m in _WORD.finditer(text)]
            first = [0, *change.tolist()]
            spans = [(at[a][0], at[b - 1][1], langs[path[a]]) for a, b in zip(first, [*first[1:], len(path)])]
        else:
            spans = [(0, len(text), langs[best])]
        return langs[best], float(heard / letters.sum() * sure), spans


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), penalty: float = PENALTY, rows: int = 512) -> DataFrame:
    """Per row: the ``keep`` columns, lang_pred, score and spans (start, stop in signs, lang) of the whole text.

    Null, empty and letterless texts are ``und`` with score 0 and no spans, as is everything under a model without languages. A text in a script
    that no language uses gets the most frequent language with score 0. Ties go to the language that sorts first. The score is the share of letters in
    spans of that language, in words that it can be told by (of a script it uses, with a known part), times the probability of it by these words against
    the next best there. An unlearned language in a learned script shares word parts with the learned ones and can score high. Rows are independent, so repeated rows agree and an
    empty table gives none; other columns are not read.
    """
    kept = list(keep)
    read = kept if text in kept else [*kept, text]
    frame, pos, n_kept = docs.select(*[docs[c] for c in read]), read.index(text), len(kept)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value, penalty)
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                b = whole.slice(at, rows)
                found = labeller.label(b.column(pos).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column(i) for i in range(n_kept)]
                    + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([[dict(zip(("start", "stop", "lang"), s)) for s in f[2]] for f in found], span)],
                    kept + ["lang_pred", "score", "spans"],
                )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema[: len(keep)])
    return frame.mapInArrow(run, f"{ddl}, lang_pred string, score double, spans array<struct<start:bigint,stop:bigint,lang:string>>")
