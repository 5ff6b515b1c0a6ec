"""Near-duplicate groups by MinHash bands with sequential Bayesian verification.

1. Every text becomes its set of 5-word shingles, 64-bit hashes. Texts with equal sets form a class; all later work is on classes.
2. A signature of 128 minima per class; 32 bands of 4 rows propose candidates. At the threshold 0.75 a pair shares no band with
   probability (1 - 0.75^4)^32 = 6e-6, and less the more alike it is.
3. Candidates: all pairs of a band's bucket where it has few classes; in larger buckets each class with a few leaders, the classes that
   share most buckets with most others. What that leaves apart is compared exhaustively in blocks (5), so no link between
   classes of a bucket is lost.
4. Candidates are compared signature batch by signature batch. With m of n equal, the posterior of the similarity (uniform prior)
   is a beta law; a pair whose probability of reaching the threshold falls below MISS is dropped. Survivors are verified on full sets.
5. Buckets whose classes then lie in more than one component are compared in blocks, each pair in the first band it shares: signatures
   first, then full sets, unless the two are connected by then. Only links leave a block.
6. Components by alternating large and small stars.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import binomial_upto, written

WORDS = 5
#: Similarity in hundredths from which two texts are linked.
LEAST = 75
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Signature places per batch, and the miss probability at which a pair is dropped.
BATCH, MISS = 16, 1e-6
#: A bucket up to this size proposes all its pairs; a larger one has so many leaders.
SMALL, LEADERS = 8, 2
#: Classes in a block of the exhaustive comparison; members verified in one group with their leader.
BLOCK, GROUP = 2_048, 64
#: Size of the filter that texts pass before they are shuffled, and its hashes per id.
FILTER_BITS, FILTER_HASHES = 1 << 26, 3

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_A = _rng.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2**64, HASHES, dtype=np.uint64)
# An odd base of the rolling hash and its inverse modulo 2^64; multipliers of the mixing function.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers_upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_BASE, _INVERSE)):
            step = np.full(size, base, np.uint64)
            step[0] = 1
            _powers[k] = np.multiply.accumulate(step)
    return _powers[0][:n], _powers[1][:n]


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text: A-Z lowered, words apart by ASCII white space, fewer than 5 words as one shingle.

    A shingle is a slice of the words joined by spaces, hashed by a rolling hash over its bytes and mixed with its length.
    """
    raw = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not raw:
        return np.zeros(0, np.uint64)
    byte = np.frombuffer(raw, np.uint8)
    power, inverse = _powers_upto(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[byte] * power, out=total[1:])
    space = np.flatnonzero(byte == 32)
    start, end = np.concatenate(([0], space + 1)), np.concatenate((space, [len(raw)]))
    n = max(1, len(start) - WORDS + 1)
    start, end = start[:n], end[min(WORDS, len(end)) - 1 :]
    return np.unique(mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64)))


def set_class(found: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "big", signed=True)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, HASHES) minima; no set is empty."""
    out = np.empty((len(sets), HASHES), np.uint64)
    at = 0
    while at < len(sets):  # few enough values at once to stay in the cache
        stop, size = at + 1, len(sets[at])
        while stop < len(sets) and size + len(sets[stop]) <= 32_768:
            size += len(sets[stop])
            stop += 1
        x = np.concatenate(sets[at:stop])
        starts = np.cumsum([0] + [len(s) for s in sets[at : stop - 1]])
        v = np.empty_like(x)
        for j in range(HASHES):
            np.multiply(x, _A[j], out=v)
            v += _B[j]
            out[at:stop, j] = np.minimum.reduceat(v, starts)
        at = stop
    return out


def posterior_limits(miss: float = MISS, least: int = LEAST) -> dict[int, int]:
    """For each number of compared places, the most matches with which a pair is dropped.

    Places hold 8 bits, so unlike minima agree by chance once in 256. Under a uniform prior P(p >= t | m of n) = P(Bin(n + 1, t) <= m).
    """
    t = least / 100 + (1 - least / 100) / 256
    out = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        out[n] = max((m for m in range(-1, n) if m < 0 or binomial_upto(n + 1, m, t) < miss), default=-1)
    return out


def surviving(a: np.ndarray, b: np.ndarray, limits: dict[int, int]) -> np.ndarray:
    """Rows of two signature matrices that no batch drops."""
    alive, same = np.arange(len(a)), np.zeros(len(a), np.int32)
    for n in range(BATCH, HASHES + 1, BATCH):
        same = same + (a[alive, n - BATCH : n] == b[alive, n - BATCH : n]).sum(axis=1, dtype=np.int32)
        stay = same > limits[n]
        alive, same = alive[stay], same[stay]
    return alive


# -- stages ----------------------------------------------------------------------------------


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, text -> doc_id, n_shingles, cls (null: no words), sig, bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                sets = [shingles(t.as_py()) for t in b.column(1)]
                full = [i for i, s in enumerate(sets) if len(s)]
                cls, sig, bands = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    low = minima([sets[i] for i in full])
                    places = (mix(low) & np.uint64(255)).astype(np.uint8)
                    keys = np.zeros((len(full), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
                    for r in range(ROWS):
                        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) ^ low[:, r::ROWS])
                    for k, i in enumerate(full):
                        cls[i], sig[i], bands[i] = set_class(sets[i]), places[k].tobytes(), keys[k].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.int64()), pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "cls", "sig", "bands"],
                )

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, cls bigint, sig binary, bands array<bigint>")


def proposed(members: DataFrame) -> DataFrame:
    """(bucket, cls) with the bucket's size and leaders -> distinct candidate pairs a < b."""
    small = members.where(F.col("size") <= SMALL).groupBy("bucket").agg(F.sort_array(F.collect_list("cls")).alias("c"))
    pairs = F.flatten(F.transform("c", lambda x, i: F.transform(F.slice("c", i + 2, F.lit(SMALL)), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    few = small.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    stars = members.where(F.col("size") > SMALL).select("cls", F.explode("leaders").alias("lead")).where("cls <> lead")
    many = stars.select(F.least("cls", "lead").alias("a"), F.greatest("cls", "lead").alias("b"))
    return few.union(many).distinct()


def compared(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Candidate pairs that the signatures do not rule out, with the documents (a_doc, b_doc) that stand for them."""
    one = lambda p: classes.select(F.col("cls").alias(p), F.col("doc").alias(f"{p}_doc"), F.col("sig").alias(f"{p}_sig"))
    both = pairs.hint("merge").join(one("a"), "a").hint("merge").join(one("b"), "b").select("a", "b", "a_doc", "b_doc", "a_sig", "b_sig")
    limits = posterior_limits()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a_sig, b_sig = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(-1, HASHES) for i in (4, 5))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(4)], ["a", "b", "a_doc", "b_doc"]).take(pa.array(surviving(a_sig, b_sig, limits)))

    return both.mapInArrow(run, "a bigint, b bigint, a_doc bigint, b_doc bigint")


def among(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is probably in ``wanted`` (doc); no wanted one is lost.

    A Bloom filter of fixed size, FILTER_BITS, is all that is shared, however many ids there are; it only saves shuffling texts that the
    join after it would drop.
    """
    spots = wanted.select("doc", F.explode(F.sequence(F.lit(1), F.lit(FILTER_HASHES))).alias("k")).select(F.pmod(F.xxhash64("doc", "k"), F.lit(FILTER_BITS)).alias("at"))
    found = spots.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def maybe(at: pa.Array) -> pa.Array:
        own = at.flatten().to_numpy().reshape(-1, FILTER_HASHES)
        return pa.array(((shared.value[own >> 6] >> (own & 63)) & 1).all(axis=1))

    maybe = maybe.asNondeterministic()  # stays on this side of the join
    at = F.transform(F.sequence(F.lit(1), F.lit(FILTER_HASHES)), lambda k: F.pmod(F.xxhash64("doc_id", k), F.lit(FILTER_BITS)))
    return docs.where(maybe(at))


def verified(pairs: DataFrame, docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= least * union.

    The pairs of a class are checked in groups of at most about GROUP members, each with a copy of the class's text, so a class
    with many partners is spread over many groups.
    """
    counts = pairs.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).withColumnRenamed("a", "of")
    salted = pairs.join(counts, F.col("a") == F.col("of"), "left").withColumn(
        "salt", F.pmod(F.xxhash64("b"), F.ceil(F.coalesce("n", F.lit(1)) / GROUP)).cast("int")
    )
    ends = F.array(
        F.struct(F.lit(False).alias("member"), F.col("a").alias("cls"), F.col("a_doc").alias("doc")),
        F.struct(F.lit(True).alias("member"), F.col("b").alias("cls"), F.col("b_doc").alias("doc")),
    )
    rows = salted.select("a", "salt", F.explode(ends).alias("e")).select("a", "salt", "e.member", "e.cls", "e.doc").distinct()
    docs = among(docs, rows.select("doc"))
    texts = rows.hint("merge").join(docs, rows["doc"] == docs["doc_id"]).select("a", "salt", "member", "cls", "text")

    def check(table: pa.Table) -> pa.Table:
        a, member, cls, text = (table.column(c) for c in ("a", "member", "cls", "text"))
        lead, found = None, []
        for i in range(table.num_rows):
            if not member[i].as_py():
                own = shingles(text[i].as_py())
                if set_class(own) == cls[i].as_py():
                    lead = own
        for i in range(table.num_rows):
            if member[i].as_py() and lead is not None:
                own = shingles(text[i].as_py())
                both = len(np.intersect1d(lead, own, assume_unique=True))
                if set_class(own) == cls[i].as_py() and 100 * both >= least * (len(lead) + len(own) - both):
                    found.append((a[i].as_py(), cls[i].as_py()))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return texts.groupBy("a", "salt").applyInArrow(check, "a bigint, b bigint").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, component (its least node) for every node of ``edges`` (a, b), by alternating large and small stars.

    The rounds grow with the logarithm of the longest chain; it raises if they do not suffice.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct())
    before = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("of"), F.least("v", "m").alias("m"))
        large = both.join(low, F.col("v") == F.col("of")).where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("of"), "m")
        small = large.join(low, F.col("v") == F.col("of"))
        moved = small.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        now = written(moved.union(small.select("v", F.col("m").alias("u"))).distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(now.select("u", "u").distinct())


def leftovers(members: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Links between classes of large buckets that are still in different components, found in blocks.

    The classes of a bucket's largest component are its core, the others stand apart. Apart classes meet each other and the core, in groups
    of one block of each; the core does not meet itself. A core of c and s others give c * ceil(s / BLOCK) + s * ceil((c + s) / BLOCK)
    rows, about c + s where few stand apart. Only survivors leave a group.
    """
    own = members.where(F.col("size") > SMALL).select("bucket", "cls", "size")
    own = own.join(labels, F.col("cls") == F.col("node"), "left").select("bucket", "cls", "size", F.coalesce("component", "cls").alias("comp"))
    parts = own.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.first("size").alias("size"))
    largest = parts.groupBy("bucket", "size").agg(F.max(F.struct("n", "comp")).alias("core")).where("core.n < size")
    largest = largest.select(F.col("bucket").alias("open"), F.col("core.comp").alias("core"), *[F.ceil(n / BLOCK).cast("int").alias(c) for n, c in ((F.col("core.n"), "nc"), (F.col("size") - F.col("core.n"), "ns"))])
    own = own.join(largest.hint("merge"), F.col("bucket") == F.col("open")).withColumn("apart", F.col("comp") != F.col("core"))
    own = own.withColumn("i", F.pmod(F.xxhash64("cls", "bucket"), F.when(F.col("apart"), F.col("ns")).otherwise(F.col("nc"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))
    with_core = F.transform(upto("ns"), lambda j: cell(True, F.col("i"), j))
    to_core = F.transform(upto("nc"), lambda j: cell(True, j, F.col("i")))
    to_others = F.transform(upto("ns"), lambda j: cell(False, F.least("i", j), F.greatest("i", j)))
    cells = F.explode(F.when(F.col("apart"), F.concat(to_core, to_others)).otherwise(with_core)).alias("at")
    known = classes.select("cls", "doc", "sig", "bands").hint("merge")
    found = own.join(known, "cls").select("bucket", "cls", "comp", "apart", "doc", "sig", "bands", cells).select("bucket", "at.*", "cls", "comp", "apart", "doc", "sig", "bands")
    found = written(found)
    docs = among(docs, found.select("doc"))
    texts = found.hint("merge").join(docs, found["doc"] == docs["doc_id"]).select("bucket", "kind", "x", "y", "cls", "comp", "apart", "sig", "bands", "text")
    limits = posterior_limits()

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cls, comp, apart = (table.column(c).to_numpy(zero_copy_only=False) for c in ("cls", "comp", "apart"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
        bands = np.array(table.column("bands").to_pylist(), np.int64).reshape(-1, BANDS)
        bucket, with_core = table.column("bucket")[0].as_py(), table.column("kind")[0].as_py()
        core, root, sets, links = np.flatnonzero(~apart), {}, {}, []

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = x = root.get(up, up)
            return x

        def set_of(i: int) -> np.ndarray:
            if i not in sets:
                own = shingles(table.column("text")[i].as_py())
                sets[i] = own if set_class(own) == cls[i] else None
            return sets[i]

        for k in np.flatnonzero(apart).tolist():
            rest = core if with_core else k + 1 + np.flatnonzero(comp[k + 1 :] != comp[k])
            # Each pair once: in the first band that both share.
            rest = rest[bands[rest, (bands[rest] == bands[k]).argmax(axis=1)] == bucket]
            for h in rest[surviving(np.broadcast_to(sig[k], (len(rest), HASHES)), sig[rest], limits)].tolist():
                if find(comp[k]) != find(comp[h]) and (a := set_of(k)) is not None and (b := set_of(h)) is not None:
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * both >= least * (len(a) + len(b) - both):
                        links.append((cls[k], cls[h]))
                        root[find(comp[k])] = find(comp[h])
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return texts.groupBy("bucket", "kind", "x", "y").applyInArrow(run, "a bigint, b bigint")


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    component_id is the smallest doc_id reachable over links, kept is doc_id = component_id. A text without words, empty or null has
    no shingles, is linked with nothing and is its own component. Rows that repeat a doc_id share its component when their texts
    do; otherwise each text has its own, and both may be kept. A null doc_id cannot be named: such rows are compared
    with nothing, their component_id is null and kept is true. An empty table gives no rows. Other columns are not read. Shingles are
    compared as 64-bit hashes. doc_id must be a whole number.
    """
    d = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    named = d.where("doc_id IS NOT NULL")
    rows = written(sketched(d))
    classes = written(rows.where("cls IS NOT NULL AND doc_id IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("doc"), F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    bucketed = classes.select(F.explode("bands").alias("bucket"), "cls")
    buckets = bucketed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").withColumnRenamed("bucket", "of")
    sized = written(bucketed.join(buckets.hint("merge"), F.col("bucket") == F.col("of")).select("bucket", "cls", "size"))
    # Leaders are the classes with most company over all their buckets: the text that others are edits of, if it is there.
    company = sized.where(F.col("size") > SMALL).groupBy("cls").agg(F.sum("size").alias("company"))
    ranked = sized.where(F.col("size") > SMALL).join(company.withColumnRenamed("cls", "who").hint("merge"), F.col("cls") == F.col("who"))
    half = F.pmod(F.xxhash64("cls"), F.lit(LEADERS))
    top = ranked.groupBy("bucket").agg(*[F.max_by("cls", F.when((half == k) if k else F.lit(True), F.struct("company", "cls"))).alias(f"l{k}") for k in range(LEADERS)])
    top = top.select(F.col("bucket").alias("of"), F.array_distinct(F.array_compact(F.array(*[f"l{k}" for k in range(LEADERS)]))).alias("leaders"))
    members = written(sized.join(top.hint("merge"), F.col("bucket") == F.col("of"), "left").select("bucket", "cls", "size", "leaders"))
    links = written(verified(written(compared(proposed(members), classes)), named))
    labels = components(links)
    more = written(leftovers(members, labels, classes, named))
    if not more.isEmpty():
        labels = components(links.union(more))
    labelled = rows.where("doc_id IS NOT NULL").select("doc_id", "n_shingles", "cls").join(labels, F.col("cls") == F.col("node"), "left")
    labelled = labelled.withColumn("comp", F.coalesce("component", "cls"))
    least = labelled.where("cls IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").select(F.col("comp").alias("of"), "least")
    out = labelled.join(least, F.col("comp") == F.col("of"), "left").select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))
    out = out.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    unnamed = rows.where("doc_id IS NULL").select("doc_id", "n_shingles", F.lit(None).cast("bigint").alias("component_id"), F.lit(True).alias("kept"))
    return out.union(unnamed)
