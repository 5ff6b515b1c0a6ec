"""Byte-level BPE: ranked merges as a fold of Spark's higher-order functions, over distinct words.

A text is split by the vocabulary's pattern and each piece ("word") is encoded for itself. The fold starts from the ids of a word's bytes (up to four of them joined already where
that join is sure to come before all that could touch them) and joins, step by step, the neighbours whose joint rank is lowest, the leftmost first. The ranks
are a literal map in the plan from pairs of ids to the id of their join, as flat arrays so that one lookup reads two entries. The state of a short word is one
array of numbers, whose least is the next join; in long words one step joins all disjoint places of the lowest pair, where that gives the same. Words that are tokens themselves are their own id. Frequent words are folded once for the
corpus, the others where they stand; the frequent ones, at most FREQUENT, are a lookup table with a proven bound, found on a sample of texts: which
words are in it changes the time and not the result. Decoding looks up each id's bytes and concatenates them.
"""

from __future__ import annotations

import base64
import json
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import let, written

#: Most words in the lookup table, some 50 bytes each and as many again in a worker's dictionary of them, and the documents (about) that it is chosen from.
FREQUENT, SAMPLE_DOCS = 400_000, 25_000
#: A pair of ids as one number: ids are below this.
IDS = 1 << 20
#: A piece of a word as one number: the id of its join with the next piece, its place in the word (0 to 127, in short words), its own id.
JOIN, PLACES = 27, 127 << 20
#: More than any rank.
_NONE = IDS
#: Pieces of a word above which a step joins all places of a pair, and bytes of a word above which it is cut first and not put into the table.
BULK, LONG = 96, 192


@lru_cache(4)
def ranks(path: str) -> dict[bytes, int]:
    """Bytes -> rank of a rank file; every executor has it, or only the driver: the plan carries it."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def within(value: Column, body) -> Column:
    """``body(value)`` as ``let`` has it, without an array around it: cheaper where Spark evaluates it many times in a lambda."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, body)


def literal(value, ddl: str) -> Column:
    """A nested value as one constant of the plan; the optimizer folds it."""
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), ddl)


@lru_cache(4)
def _pairs(path: str) -> dict[tuple[int, int], int]:
    """Ids of two neighbours -> the id of their join, for every way to part a token into two tokens."""
    known = ranks(path)
    return {(known[t[:i]], known[t[i:]]): r for t, r in known.items() for i in range(1, len(t)) if t[:i] in known and t[i:] in known}


@lru_cache(4)
def _dealt(path: str) -> tuple[list[int], list[int]]:
    """The map of pairs as two flat arrays: a shift for each left id, and at shift + right id the id of the join, shifted by JOIN, plus the left id (-1 where free).

    The longest rows are placed first, each where its pairs stand on free places; a shift may be negative.
    """
    rows: dict[int, list[tuple[int, int]]] = {}
    for (a, b), r in _pairs(path).items():
        rows.setdefault(a, []).append((b, r))
    end = max(ranks(path).values()) + 1
    shifts, slots = np.zeros(end, np.int64), np.full(len(_pairs(path)) + end, -1, np.int64)
    size, place, tries = 0, 0, 1_024
    for a, row in sorted(rows.items(), key=lambda m: -len(m[1])):
        right, join = np.array(sorted(row)).T
        if len(row) != size:
            size, place = len(row), 0
        while True:
            # Rows of as many pairs are tried on from where the last one stands.
            if place + end + tries > len(slots):
                slots = np.append(slots, np.full(end + tries, -1, np.int64))
            free = place + np.flatnonzero(slots[place : place + tries] < 0)
            for r in right[1:] - right[0]:
                if not len(free):
                    break
                free = free[slots[free + r] < 0]
            if len(free):
                break
            place += tries
        place = int(free[0])
        shifts[a] = place - right[0]
        slots[shifts[a] + right] = (join << JOIN) + a
    return shifts.tolist(), slots[: np.flatnonzero(slots >= 0).max(initial=0) + 1].tolist()


@lru_cache(4)
def _eager(path: str) -> list[bool]:
    """By id: does the token join with a neighbour before other places of its own pair are joined? Only there does the order of places matter."""
    out = [False] * (max(ranks(path).values()) + 1)
    for (a, b), r in _pairs(path).items():
        out[a] |= r < a
        out[b] |= r < b
    return out


def folded(start: Column, path: str) -> Column:
    """array<int>: the ids of a word, or of a cut part of one, given by its ``starts``. A word that is a token itself is not told apart here."""
    return with_ranks(path, lambda table: _folded(start, table))


def with_ranks(path: str, body) -> Column:
    """``body`` of the map of pairs, as columns that are made once for all that it does."""
    shifts, slots = _dealt(path)
    shifts, slots, eager = literal(shifts, "array<bigint>"), literal(slots, "array<bigint>"), literal(_eager(path), "array<boolean>")
    return within(shifts, lambda a: within(slots, lambda b: within(eager, lambda c: body({"shifts": a, "slots": b, "eager": c}))))


def _folded(start: Column, table: dict[str, Column]) -> Column:
    ids = lambda pieces: F.transform(pieces, lambda x: x.bitwiseAND(IDS - 1).cast("int"))
    inner = lambda pieces: F.slice(pieces, F.lit(2), F.size(pieces) - 2)
    return within(start, lambda pieces: F.when(F.size(pieces) <= BULK + 2, ids(inner(_folded_short(pieces, table)))).otherwise(_folded_long(ids(inner(pieces)), table)))


def _joined(a: Column, b: Column, table: dict[str, Column]) -> Column:
    """The id of the join of two ids, shifted by JOIN; null where the neighbours join with nothing or one is missing."""
    slot = F.get(table["slots"], F.get(table["shifts"], a) + b)
    return F.when(slot.bitwiseAND(IDS - 1) == a, slot - a)


def _folded_short(start: Column, table: dict[str, Column]) -> Column:
    """The pieces of a word of at most BULK bytes, joined one by one: the least number is the lowest rank, and of those the leftmost place."""
    none = F.lit(_NONE << JOIN)

    def join(pieces: Column, least: Column, at: Column) -> Column:
        new, left, after = F.shiftright(least, JOIN), F.get(pieces, at - 1), F.get(pieces, at + 2)
        return F.flatten(F.array(
            F.slice(pieces, F.lit(1), at - 1),
            F.array(
                left.bitwiseAND((1 << JOIN) - 1) + F.coalesce(_joined(left.bitwiseAND(IDS - 1), new, table), none),
                least.bitwiseAND(PLACES) + new + F.coalesce(_joined(new, after.bitwiseAND(IDS - 1), table), none),
            ),
            F.slice(pieces, at + 3, F.lit(BULK + 2)),
        ))

    def step(pieces: Column) -> Column:
        before = lambda least: within(least.bitwiseAND(PLACES), lambda place: F.size(F.filter(pieces, lambda x: x.bitwiseAND(PLACES) < place)))
        return within(F.array_min(pieces), lambda least: F.when(least >= none, pieces).otherwise(within(before(least), lambda at: join(pieces, least, at))))

    # Rounds of four steps: a round in which nothing is left to join is passed over whole.
    steps = F.array(*[F.lit(i) for i in range(4)])
    rounds = F.sequence(F.lit(0), F.shiftright(F.size(start), 2))
    return F.aggregate(rounds, start, lambda s, _: F.when(F.array_min(s) >= none, s).otherwise(F.aggregate(steps, s, lambda x, _: step(x))))


def _folded_long(start: Column, table: dict[str, Column]) -> Column:
    none, big = F.lit(_NONE), F.lit(1).cast("bigint")

    def rank(a: Column, b: Column) -> Column:
        # A null neighbour, as the last piece's, joins with nothing.
        return F.coalesce(F.shiftright(_joined(a * big, b * big, table), JOIN).cast("int"), none)

    def state(ids: Column, joins: Column, done: Column) -> Column:
        return F.struct(ids.alias("ids"), joins.alias("joins"), done.alias("done"))

    def one(ids: Column, joins: Column, least: Column) -> Column:
        """The leftmost place of the lowest rank."""
        def at(j: Column) -> Column:
            left = F.when(j > 1, F.array(rank(F.get(ids, j - 2), least))).otherwise(F.array().cast("array<int>"))
            return state(
                F.concat(F.slice(ids, F.lit(1), j - 1), F.array(least), F.slice(ids, j + 2, F.size(ids))),
                F.concat(F.slice(joins, F.lit(1), F.greatest(j - 2, F.lit(0))), left, F.array(rank(least, F.get(ids, j + 1))), F.slice(joins, j + 2, F.size(ids))),
                F.lit(False),
            )

        return let(F.array_position(joins, least).cast("int"), at)

    def all_places(ids: Column, joins: Column, least: Column) -> Column:
        """Every place of the lowest rank, from the left, none of which share a piece: J where two are joined, D for the second of them.

        A place whose join has a lower rank yet with a neighbour is the last one, as that join comes before the places after it.
        """
        flags = F.array_join(F.transform(joins, lambda r: F.when(r == least, F.lit("1")).otherwise(F.lit("0"))), "")

        def replaced(marks: Column) -> Column:
            mark = lambda i: F.get(marks, i)
            piece = lambda i: F.when(mark(i) == "J", least).otherwise(F.get(ids, i))
            new_ids = F.transform(ids, lambda x, i: F.when(mark(i) == "J", least).when(mark(i) != "D", x))
            new_joins = F.transform(joins, lambda r, i: F.when(mark(i) == "J", rank(least, piece(i + 2))).when(mark(i) == "D", F.lit(None)).when(mark(i + 1) == "J", rank(F.get(ids, i), least)).otherwise(r))
            return state(F.array_compact(new_ids), F.array_compact(new_joins), F.lit(False))

        def marked(marks: Column) -> Column:
            left = lambda i: F.when(F.get(marks, i - 1) == "D", least).otherwise(F.get(ids, i - 1))
            lower = lambda i: (rank(left(i), least) < least) | (rank(least, F.get(ids, i + 2)) < least)
            ends = F.array_position(F.transform(marks, lambda x, i: F.when(x == "J", lower(i)).otherwise(F.lit(False))), True)
            upto = lambda e: F.when(e == 0, marks).otherwise(F.transform(marks, lambda x, i: F.when(i <= e, x).otherwise(F.lit("0"))))
            return let(F.when(F.get(table["eager"], least), let(ends, upto)).otherwise(marks), replaced)

        return let(F.split(F.regexp_replace(flags, "1.", "JD"), ""), marked)

    def step(s: Column) -> Column:
        def join(least: Column) -> Column:
            few = F.size(s["ids"]) <= BULK
            return F.when(least == none, state(s["ids"], s["joins"], F.lit(True))).when(few, one(s["ids"], s["joins"], least)).otherwise(all_places(s["ids"], s["joins"], least))

        return F.when(s["done"], s).otherwise(let(F.array_min(s["joins"]), join))

    def fold(b: Column) -> Column:
        first = state(b, F.transform(b, lambda x, i: rank(x, F.get(b, i + 1))), F.lit(False))
        # Rounds of steps, about as many as a round has steps: a round in which nothing is left to join is passed over whole.
        root = F.ceil(F.sqrt(F.size(b).cast("double"))).cast("int")
        count = F.sequence(F.lit(1), F.greatest(root, F.lit(1)))
        turn = lambda s: F.aggregate(count, s, lambda x, _: step(x))
        return F.aggregate(count, first, lambda s, _: F.when(s["done"], s).otherwise(turn(s)))["ids"]

    return let(start, fold)


@lru_cache(2)
def _tokens(path: str):
    """All tokens of two bytes or more, for finding them in a word."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for t in ranks(path):
        if len(t) > 1:
            found.add_word(t.decode("latin-1"), len(t))
    found.make_automaton()
    return found


def parts(word: bytes, path: str) -> list[bytes]:
    """A long word cut at every place that no token in it reaches across: no merge does either, so the parts are encoded each for itself."""
    reach = np.zeros(len(word) + 2, np.int64)
    for end, n in _tokens(path).iter(word.decode("latin-1")):
        reach[end + 2 - n] += 1
        reach[end + 1] -= 1
    cuts = np.flatnonzero(np.cumsum(reach)[1 : len(word)] == 0) + 1
    at = [0, *cuts.tolist(), len(word)]
    return [word[a:b] for a, b in zip(at, at[1:])]


def first_joins(path: str) -> tuple:
    """What ``starts`` needs: the ids of the 256 bytes, the map of pairs as ``_dealt`` has it, which ids are eager, and two sorted maps from a byte and an id
    to the lowest rank at which a token that ends in the byte joins with the id, and at which the id joins with a token that begins with the byte. The
    entries of these maps whose id is that of a byte come as arrays by two bytes too.
    """
    known = ranks(path)
    token = {r: t for t, r in known.items()}
    before, after = {}, {}
    for (a, b), r in _pairs(path).items():
        i, j = token[a][-1] * IDS + b, token[b][0] * IDS + a
        before[i], after[j] = min(r, before.get(i, r)), min(r, after.get(j, r))
    near = [np.full((256, 256), _NONE, np.int64) for _ in range(2)]
    for out, lowest in zip(near, (before, after)):
        for k, r in lowest.items():
            if len(token[k % IDS]) == 1:
                out[k // IDS, token[k % IDS][0]] = r
    by_key = lambda m: (np.array(sorted(m), np.int64), np.array([m[k] for k in sorted(m)], np.int64))
    shifts, slots = _dealt(path)
    return np.array([known[bytes([i])] for i in range(256)], np.int64), np.array(shifts), np.array(slots, np.int64), np.array(_eager(path)), *near, by_key(before), by_key(after)


def _lowest(lowest: tuple[np.ndarray, np.ndarray], byte: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The rank for a byte and an id, _NONE where there is none."""
    keys, values = lowest
    if not len(keys):
        return np.full(len(ids), _NONE, np.int64)
    wanted = byte * IDS + ids
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], _NONE)


def starts(words: list[bytes], tables: tuple, rounds: int = 2) -> pa.Array:
    """list<int64>: the pieces that the fold of each word starts from, with an end on both sides that joins with nothing.

    They are the word's bytes, and where this is sure two or up to four of them joined already: their join comes before any other that could touch one of
    the two pieces, whatever the pieces beside may grow to, and no join with the new piece comes before those of a lower rank elsewhere (it is not eager).
    So the order of all the other joins stays as it is.
    """
    single, shifts, slots, eager, near_before, near_after, before, after = tables
    raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    ids, first, last = single[raw], raw, raw

    def joins() -> np.ndarray:
        """By piece: the id of its join with the next one."""
        out = np.full(len(ids), _NONE, np.int64)
        at = shifts[ids[:-1]] + ids[1:]
        slot = slots[np.clip(at, 0, len(slots) - 1)] if len(slots) else np.full(len(at), -1, np.int64)
        found = (word[:-1] == word[1:]) & (at >= 0) & (at < len(slots)) & (slot & IDS - 1 == ids[:-1])
        out[:-1][found] = slot[found] >> JOIN
        return out

    for turn in range(rounds):
        rank = joins()
        at = np.flatnonzero(rank < _NONE)
        at = at[~eager[rank[at]]]
        rank = rank[at]
        # The piece before the two, the second of the two, the piece after; out of reach they are looked up too and not taken.
        above, second, below = at - 1, at + 1, np.minimum(at + 2, len(ids) - 1)
        if turn == 0:
            left, right = near_before[last[above], first[at]], near_after[first[below], first[second]]
        else:
            left, right = _lowest(before, last[above], ids[at]), _lowest(after, first[below], ids[second])
        left = np.where((at > 0) & (word[above] == word[at]), left, _NONE)
        right = np.where((below > second) & (word[below] == word[at]), right, _NONE)
        sure = (rank < left) & (rank < right)
        at, rank = at[sure], rank[sure]
        stay = np.ones(len(ids), bool)
        stay[at + 1] = False
        ids, last = ids.copy(), last.copy()
        ids[at], last[at] = rank, last[at + 1]
        ids, first, last, word = ids[stay], first[stay], last[stay], word[stay]
    lengths = np.bincount(word, minlength=len(words)).astype(np.int64)
    ends = np.cumsum(lengths + 2)
    place = np.arange(len(ids)) - (np.cumsum(lengths) - lengths)[word] + 1
    pieces = np.full(len(ids) + 2 * len(words), (_NONE << JOIN) + IDS - 1, np.int64)
    pieces[ends - 1] += PLACES
    pieces[np.arange(len(ids)) + 2 * word + 1] = (joins() << JOIN) + (np.where((lengths <= BULK)[word], place, 0) << 20) + ids
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(pieces))


def _splitter(pattern: str):
    return regex.compile(pattern).findall


def _counted(docs: DataFrame, pattern: str) -> DataFrame:
    """text -> word (its bytes), n, summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, counts = _splitter(pattern), Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.encode("utf-8", "surrogatepass") for w in counts], pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    counts.update(split(t))
                if len(counts) > 500_000:
                    yield flush()
        yield flush()

    return docs.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Table:
    """The ids of many words in a few flat arrays."""

    def __init__(self, words: pa.BinaryArray, ids: pa.ListArray):
        words, ids = words.take(pa.array(np.arange(len(words)))), ids.take(pa.array(np.arange(len(ids))))
        # take() makes a fresh array, so its value buffer is the words one after the other.
        self.words = words.buffers()[2].to_pybytes() if len(words) else b""
        self.word_at = np.concatenate(([0], np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64))))
        lengths = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
        # The last entry stands for words that are not here: one id, -1.
        self.ids = np.append(ids.flatten().to_numpy(zero_copy_only=False).astype(np.int32), np.int32(-1))
        self.lengths = np.append(lengths, 1)
        self.starts = np.concatenate(([0], np.cumsum(lengths)))

    @cached_property
    def entries(self) -> dict[str, int]:
        """The entry of every word that is text; made once by a worker, when it is first asked for."""
        out, at = {}, self.word_at.tolist()
        for i, (a, b) in enumerate(zip(at, at[1:])):
            try:
                out[self.words[a:b].decode("utf-8", "surrogatepass")] = i
            except UnicodeDecodeError:
                continue
        return out

    def gather(self, entries: np.ndarray) -> np.ndarray:
        """The ids of entries, one after the other."""
        lengths = self.lengths[entries]
        ends = np.cumsum(lengths)
        return self.ids[np.repeat(self.starts[entries] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


def frequent_words(texts: DataFrame, path: str, pattern: str, most: int = FREQUENT, sample: int = SAMPLE_DOCS) -> Table:
    """The ids of the vocabulary's own tokens, and of the words that occur at least c times in about ``sample`` texts, c the least count (2 or more) that not more than ``most`` words reach.

    Long words are left out; they are seldom met again.
    """
    n = texts.count()
    some = texts if n <= sample else texts.where(F.pmod(F.xxhash64(texts.columns[0], F.lit(3)), F.lit(IDS)) < max(1, round(IDS * sample / n)))
    counts = written(_counted(some, pattern).where((F.col("n") > 1) & (F.octet_length("word") <= LONG)))
    by_count = sorted(counts.groupBy(F.least("n", F.lit(1_000)).alias("n")).agg(F.count("*").alias("words")).collect(), reverse=True)
    total, least = 0, None
    for r in by_count:
        total += r.words
        if total > most:
            break
        least = r.n
    own = ranks(path)
    words, ids = [pa.array(own, pa.binary())], [pa.array([[r] for r in own.values()], pa.list_(pa.int32()))]
    if least is not None:
        tables = texts.sparkSession.sparkContext.broadcast(first_joins(path))

        def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                new = [w for w in b.column(0).to_pylist() if w not in own]
                yield pa.RecordBatch.from_arrays([pa.array(new, pa.binary()), starts(new, tables.value)], ["word", "start"])

        chosen = counts.where(F.col("n") >= least).select("word").repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        found = chosen.mapInArrow(start, "word binary, start array<bigint>").select("word", folded(F.col("start"), path).alias("ids")).toArrow()
        words += found.column("word").chunks
        ids += found.column("ids").chunks
    return Table(pa.concat_arrays(words), pa.concat_arrays([x.cast(pa.list_(pa.int32())) for x in ids]))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), most: int = FREQUENT) -> DataFrame:
    """The ``keep`` columns and ids array<int> of every whole text, without special tokens.

    Null and empty texts have no ids. Words of any length are encoded whole: a long one is first cut where no token reaches across, and what is long still is
    joined at all places of a pair at once. Rows are independent: repeated rows get equal ids and an empty table gives none. Other columns are not
    read. The ranks must hold all 256 single bytes, as byte-level vocabularies do.
    """
    missing = [i for i in range(256) if bytes([i]) not in ranks(path)]
    if missing:
        raise ValueError(f"{path} lacks {len(missing)} single bytes")
    frame = docs.select(*[docs[c] for c in keep], docs[text])
    kept, pos = list(keep), len(keep)
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent_words(frame.select(text), path, pattern, most))
    tables = spark.sparkContext.broadcast(first_joins(path))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema[: len(keep)])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, table = _splitter(pattern), shared.value
        entry, none = table.entries.get, len(table.starts) - 1
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                found, rare, counts = [], [], []
                for t in b.column(pos).to_pylist():
                    words = split(t) if t else []
                    entries = np.fromiter(map(entry, words, repeat(none)), np.int64, len(words))
                    unknown = [words[i].encode("utf-8", "surrogatepass") for i in np.flatnonzero(entries == none).tolist()]
                    if any(len(w) > LONG for w in unknown):
                        # one place for each part
                        cut = [parts(w, path) if len(w) > LONG else [w] for w in unknown]
                        each = np.ones(len(entries), np.int64)
                        each[entries == none] = [len(c) for c in cut]
                        entries, unknown = np.repeat(entries, each), [x for c in cut for x in c]
                    found.append(table.gather(entries).tobytes())
                    rare += unknown
                    counts.append(len(unknown))
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                first = pa.ListArray.from_arrays(offsets, starts(rare, tables.value))
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(pos)] + [pa.array(found, pa.binary()), first], [*kept, "_known", "_rare"])

    def put_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                known, words = b.column(pos), b.column(pos + 1).flatten()
                ids = np.frombuffer(b"".join(known.to_pylist()), np.int32)
                rows = np.concatenate(([0], np.cumsum(pc.binary_length(known).to_numpy(zero_copy_only=False) // 4)))
                # A place of -1 is that of a word of the second column, in order.
                each = np.ones(len(ids) + 1, np.int32)
                each[np.flatnonzero(ids < 0)] = pc.list_value_length(words).to_numpy(zero_copy_only=False)
                ends = np.concatenate(([0], np.cumsum(each[:-1])))
                ids = np.repeat(ids, each[:-1])
                ids[ids < 0] = words.flatten().to_numpy(zero_copy_only=False)
                values = pa.ListArray.from_arrays(pa.array(ends[rows].astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(pos)] + [values], [*kept, "ids"])

    found = frame.mapInArrow(look_up, f"{ddl}, _known binary, _rare array<array<bigint>>")
    found = found.select(*[found[c] for c in kept], "_known", with_ranks(path, lambda table: F.transform("_rare", lambda w: _folded(w, table))).alias("_rare"))
    return found.mapInArrow(put_in, f"{ddl}, ids array<int>")


def decoded(ids: Column, path: str) -> Column:
    """The bytes that ids stand for, concatenated; null for null, an error for an id that the vocabulary lacks."""
    by_rank = {r: p.hex() for p, r in ranks(path).items()}
    table = literal([by_rank.get(i) for i in range(max(by_rank) + 1)], "array<string>")
    unknown = lambda i: F.raise_error(F.concat(F.lit("no token has id "), i.cast("string"))).cast("string")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.coalesce(F.get(table, i), unknown(i))), ""))
