"""Order MinHash fingerprints: near in edit distance, not only in content. Built-in functions only.

The k-mers of a text are its runs of K words; each is numbered by its occurrence, so repeats count as different elements. Elements
are hashed once and dealt into BINS by their hash. Each bin orders all elements of the text: its own first, by their hash, then the others by a
hash of the bin's own. The TUPLE least are kept, put back into text order, and hashed as a tuple. So a bin is one order over all possible elements,
and short texts, which leave bins with too few elements of their own, fill them from the whole text. Two texts agree in a bin when they share its
minimal elements *and* their order. The fingerprint lists the bins; likeness is the share of agreeing bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesloom.llm.common import let, words

#: Words of a k-mer, bins, elements of a tuple.
K, BINS, TUPLE = 3, 64, 2
#: Bits of an element's word position; later positions count as the last.
PLACE = 24
_BIN_BITS = BINS.bit_length() - 1


def _element(hash_: Column, place: Column) -> Column:
    """Hash and place in one number."""
    cut = F.shiftleft(F.shiftright(hash_, PLACE), PLACE)
    return cut.bitwiseOR(F.least(place, F.lit(2**PLACE - 1)).cast("bigint"))


def elements(found: Column) -> Column:
    """Occurrence-numbered k-mers of a word array as numbers, in no order; the last k-mers are cut off by the end of the text."""

    def numbered(h: Column) -> Column:
        # Equal hashes side by side in text order; each run is numbered from its start. The first occurrence keeps the plain hash.
        runs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def by_run(s: Column) -> Column:
            starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.coalesce(F.get(s, j)["h"] != F.get(s, j - 1)["h"], F.lit(True)))
            one = lambda st, j: _element(F.when(j == st, F.get(s, j)["h"]).otherwise(F.xxhash64(F.get(s, j)["h"], j - st)), F.get(s, j)["i"])
            return let(starts, lambda a: F.flatten(F.transform(a, lambda st, r: F.transform(F.sequence(st, F.coalesce(F.get(a, r + 1), F.size(s)) - 1), lambda j: one(st, j)))))

        return let(runs, by_run)

    kmers = lambda w: F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + n) for n in range(1, K)]))
    plain = lambda h: F.transform(h, lambda x, i: _element(x, i))
    return let(found, lambda w: let(kmers(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), plain(h)).otherwise(numbered(h))))


def fingerprint(text: Column) -> Column:
    """array<bigint>, one number per bin: the bin above 32 bits of the hash of its ordered tuple. Null and wordless texts: empty."""
    top, low = 64 - _BIN_BITS, F.lit(2**PLACE - 1).cast("bigint")

    def bin_first(x: Column) -> Column:
        # An element's lowest hash bits are its bin; they move to the front, so that a sort goes by bin, hash, place.
        own = F.shiftright(x, PLACE).bitwiseAND(F.lit(BINS - 1).cast("bigint"))
        rest = F.shiftleft(F.shiftrightunsigned(x, PLACE + _BIN_BITS), PLACE)
        return F.shiftleft(own, top).bitwiseOR(rest).bitwiseOR(x.bitwiseAND(low))

    bin_of = lambda y: F.shiftrightunsigned(y, top)
    entry = lambda b, y: F.struct(b.alias("b"), y.bitwiseAND(low).alias("p"), F.shiftrightunsigned(y, PLACE).bitwiseAND(F.lit(2 ** (63 - PLACE) - 1)).alias("h"))

    def filled(a: Column, least: Column) -> Column:
        """What bins with fewer than TUPLE elements of their own take from the others: own ones, made negative, come first and are not taken twice."""
        whole = F.transform(F.filter(least, lambda y, i: F.coalesce(bin_of(F.get(least, i - (TUPLE - 1))) == bin_of(y), F.lit(False))), bin_of)
        sparse = F.array_except(F.sequence(F.lit(0).cast("bigint"), F.lit(BINS - 1).cast("bigint")), whole)
        hashed = lambda y, b: F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.shiftrightunsigned(y, PLACE), b), PLACE + 1), PLACE).bitwiseOR(y.bitwiseAND(low))
        order = lambda b: F.transform(a, lambda y: F.when(bin_of(y) == b, y.bitwiseOR(F.lit(-(2**63)).cast("bigint"))).otherwise(hashed(y, b)))
        return F.flatten(F.transform(sparse, lambda b: F.transform(F.filter(F.slice(F.sort_array(order(b)), 1, TUPLE), lambda y: y >= 0), lambda y: entry(b, y))))

    by_bin = F.sort_array(F.transform(elements(words(text)), bin_first))
    least_of = lambda a: F.filter(a, lambda y, i: F.coalesce(bin_of(F.get(a, i - TUPLE)) != bin_of(y), F.lit(True)))
    in_text = let(by_bin, lambda a: let(least_of(a), lambda m: F.sort_array(F.concat(F.transform(m, lambda y: entry(bin_of(y), y)), filled(a, m)))))

    def tuples(s: Column) -> Column:
        def one(e: Column, i: Column) -> Column:
            own = [F.when(F.get(s, i + n)["b"] == e["b"], F.get(s, i + n)["h"]) for n in range(TUPLE)]
            code = F.shiftleft(e["b"], 32).bitwiseOR(F.xxhash64(*own).bitwiseAND(F.lit(2**32 - 1)))
            return F.when(F.coalesce(F.get(s, i - 1)["b"] != e["b"], F.lit(True)), code)

        return F.filter(F.transform(s, one), lambda v: v.isNotNull())

    return let(in_text, tuples)


def likeness(a: Column, b: Column) -> Column:
    """Share of bins, of those that either uses, whose tuples agree; two empty fingerprints are alike."""
    used = lambda x: F.transform(x, lambda v: F.shiftright(v, 32))
    every = F.size(F.array_union(used(a), used(b)))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / every)


def as_text(a: Column) -> Column:
    """A fingerprint as lower-case hex numbers joined by colons."""
    return F.array_join(F.transform(a, lambda v: F.lower(F.hex(v))), ":")


def with_next(docs: DataFrame, made, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, Window]:
    """Rows with the text of the next document by ascending doc_id, the first after the last.

    Documents are cut into as many blocks of equal size as there are shuffle partitions, by quantiles of doc_id, one per shuffle partition;
    each block also gets the first row of the block after it. ``made`` turns (text, next_text) frames into what is carried on; a
    window over the returned specification then needs no further shuffle. Rows with ``tail`` are the copies.
    """
    spark = docs.sparkSession
    d = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = d.select(F.percentile_approx("doc_id", [(i + 1) / n for i in range(n - 1)] or [1.0], 10_000)).first()[0] or []
    cuts = F.array(*[F.lit(c).cast("bigint") for c in sorted(set(cuts))]) if cuts else F.array().cast("array<bigint>")
    # A null id sorts first.
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)).cast("bigint"))
    d = d.withColumn("block", F.size(F.filter(cuts, lambda c: c < key)))
    first = {r.block: r for r in d.groupBy("block").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("null")).collect()}
    order = sorted(first)
    after = {b: order[k - 1] for k, b in enumerate(order)}  # whose rows go on with the first row of b
    d = d.withColumn("tie", F.xxhash64("text")).withColumn("tail", F.lit(False))
    if order:
        wanted = [r.least for r in first.values() if r.least is not None]
        heads = d.where(F.col("doc_id").isin(wanted) | F.col("doc_id").isNull())
        heads = heads.groupBy("block").agg(F.min_by(F.struct("doc_id", "text", "tie"), F.struct(key, "tie")).alias("h"))
        to = F.create_map(*[x for b, a in after.items() for x in (F.lit(b), F.lit(a))])
        d = d.union(heads.select("h.doc_id", "h.text", F.element_at(to, F.col("block")).alias("block"), "h.tie", F.lit(True)))
    by = Window.partitionBy("block").orderBy("tail", F.asc_nulls_first("doc_id"), "tie")
    return made(d.withColumn("next_text", F.lead("text").over(by))), by


def fingerprinted(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next for every row of ``docs``.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many, or all, of the next document. Null texts count as
    empty; an empty text has an empty fingerprint, like that of any other wordless text and unlike all else. Equal texts have equal
    fingerprints. Repeated doc_ids follow one another by a hash of their text, null ids come first; a table of one row is its own next;
    an empty table gives none. Other columns are not read. doc_id must be a whole number.
    """

    def made(d: DataFrame) -> DataFrame:
        half = F.floor(F.char_length("text") / 2).cast("int")
        d = d.withColumns({"text": F.coalesce("text", F.lit("")), "next_text": F.coalesce("next_text", F.lit(""))})
        edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
        d = d.withColumn("edited", edited)
        return d.select("block", "tail", "doc_id", "tie", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                        fingerprint(F.col("text")).alias("own"), F.when(F.col("tail"), F.array().cast("array<bigint>")).otherwise(fingerprint(F.col("edited"))).alias("other"))

    d, by = with_next(docs, made, text, doc_id)
    d = d.withColumn("next", F.lead("own").over(by)).where(~F.col("tail"))
    return d.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))
