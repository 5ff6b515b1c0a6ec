"""Each operator against a plain version of its contract, on a table with every awkward case and on an empty one."""

import base64
import hashlib
import io
import itertools
import os
import random
import time
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F

from seriesloom.llm import byte_bpe, common, language_id, licenses, near_dedup, order_minhash, packing, quality_rules, site_quality, token_counts, warc
from tests.llm.cases import edge_texts, frame, lower, prose, words


@pytest.fixture(scope="module")
def rows():
    return edge_texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).persist()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def by_text(df, *columns):
    """text -> set of results, one when equal texts agree."""
    out = {}
    for r in df.collect():
        out.setdefault(r["text"], set()).add(tuple(r[c] for c in columns))
    return out


# -- 1 language ------------------------------------------------------------------------------


def test_language_edges(docs, nothing):
    model = language_id.train(docs)
    found = language_id.identify(docs, model, keep=("doc_id", "text")).collect()
    assert len(found) == docs.count()
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert all(0 <= s["start"] < s["stop"] <= len(r["text"]) for s in r["spans"])
    assert {r["lang_pred"] for r in found if r["doc_id"] == 12} == {"zh"}
    assert language_id.identify(nothing, model).count() == 0
    empty = language_id.train(nothing)
    assert {r["lang_pred"] for r in language_id.identify(docs, empty).collect()} == {"und"}


def test_language_held_out_accuracy_and_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language_id.train(docs, where=~out)
    found = language_id.identify(docs.where(out), model, keep=("doc_id", "lang")).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.98
    one = {r["lang"]: r["text"] for r in docs.where("n_chars > 2000").collect()}
    mixed = one["en"][:1500] + "\n" + one["fr"][:1200] + "\n" + one["de"][:1500]
    spans = language_id.Labeller(model).label([mixed])[0][2]
    assert [s[2] for s in spans] == ["en", "fr", "de"]
    assert abs(spans[1][0] - 1500) < 40 and abs(spans[2][0] - 2702) < 40


@pytest.mark.parametrize("prior", [[0.5, 0.3, 0.2], [0.99998, 0.00001, 0.00001], [0.00001, 0.5, 0.49999]])
def test_viterbi_is_the_best_path(prior):
    rng = np.random.default_rng(1)
    model = language_id.Model(("a", "b", "c"), np.log(prior), {}, np.zeros((0, 3)), {})
    who = language_id.Labeller(model, penalty=2.0)
    for _ in range(150):
        score = rng.normal(0, 1.5, (7, 3))
        value = lambda p: model.prior[p[0]] + sum(score[i, k] for i, k in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(value(p) for p in itertools.product(range(3), repeat=7))
        assert value(who.path(score)) == pytest.approx(best)


def test_word_scores_and_a_rare_language(spark):
    """Scores recomputed plainly; a language with a few texts keeps parts of its own; a repeated text counts once."""
    rows = [(f"the water stone {i}", "en") for i in range(400)] + [("wyr kyll mocht", "xx"), ("kyll doun wyr", "xx")] + [("the water stone 1", "en")] * 500
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"), most_parts=60)
    assert language_id.Labeller(model).label(["kyll wyr"])[0][0] == "xx"
    counts = {}
    for text, lang in set(rows):
        for w in language_id._WORD.findall(text):
            for part in language_id.parts(w):
                counts.setdefault(part, {"en": 0, "xx": 0})[lang] += 1
    order = {g: 0 if g[0] == "=" and len(g) > 1 else len(g) for g in model.rows}
    for g, row in model.rows.items():
        plain = [np.log((counts[g][k] + 0.5) / sum(counts[h][k] + 0.5 for h in model.rows if order[h] == order[g])) / language_id.ORDERS for k in model.languages]
        assert model.scores[row] == pytest.approx(np.array(plain) - np.mean(plain))
    who = language_id.Labeller(model)
    words_ = ["stone", "kyll", "w", "ünd", "中文", "wyrstone", "=stone", "a" * 40]
    scores, known, _ = who._scored(words_)
    for w, score, heard in zip(words_, scores, known):
        rows_ = [model.rows[p] for p in language_id.parts(w) if p in model.rows]
        assert heard == bool(rows_) and score == pytest.approx(model.scores[rows_].sum(axis=0))


# -- 2 fingerprints --------------------------------------------------------------------------


def test_fingerprints(docs, nothing, rows):
    got = order_minhash.fingerprinted(docs).collect()
    assert len(got) == len(rows)
    assert order_minhash.fingerprinted(nothing).count() == 0
    named = sorted((r for r in rows if r[0] is not None and r[0] != 16), key=lambda r: r[0])
    by_id = {r["doc_id"]: r for r in got}
    for (d, t, *_), (_, u, *_) in zip(named, named[1:]):
        t, u, r = t or "", u or "", by_id[d]
        if d in (15, 17) or u is None:
            continue
        half = len(t) // 2
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256((t[: len(t) - half] + u[:half]).encode()).hexdigest()
    assert by_id[1]["fingerprint"] == by_id[3]["fingerprint"] and by_id[2]["fingerprint"] == by_id[17]["fingerprint"]
    assert by_id[4]["fingerprint"] == by_id[5]["fingerprint"] == by_id[6]["fingerprint"] == ""
    assert by_id[1]["near_next"] > 0.7 and by_id[4]["near_next"] == 1.0 and by_id[8]["near_next"] == 0.0
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def plain_bins(text):
    """Bins of the elements with their occurrence numbers, order and hashes left to the operator."""
    w = words(text)
    seen, out = Counter(), []
    for i in range(len(w)):
        g = tuple(w[i : i + order_minhash.K])
        out.append((g, seen[g]))
        seen[g] += 1
    return out


def test_elements_are_occurrence_numbered(spark):
    text = "a b c a b c a b c d a b c"
    df = spark.createDataFrame([(text,)], "text string")
    e = df.select(order_minhash.elements(common.words(F.col("text"))).alias("e")).first().e
    places = sorted(x & (2**24 - 1) for x in e)
    assert places == list(range(13)) and len({x >> 24 for x in e}) == 13 == len(set(plain_bins(text)))
    # One repeat more or less changes only elements of its own.
    f = df.select(order_minhash.elements(common.words(F.concat("text", F.lit(" a b c")))).alias("e")).first().e
    shared = {x >> 24 for x in e} & {x >> 24 for x in f}
    assert len(shared) >= 10


def test_order_matters(spark):
    rng = random.Random(3)
    parts = [prose(rng, 40) for _ in range(8)]
    same, turned = " ".join(parts), " ".join(parts[4:] + parts[:4])
    df = spark.createDataFrame([(same, turned)], "a string, b string")
    r = df.select(order_minhash.likeness(order_minhash.fingerprint(F.col("a")), order_minhash.fingerprint(F.col("b"))).alias("x")).first()
    assert 0.2 < r.x < 0.8  # nearly the same k-mers, in another order


def mean_likeness(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    return df.select(F.avg(order_minhash.likeness(order_minhash.fingerprint(F.col("a")), order_minhash.fingerprint(F.col("b")))).alias("x")).first().x


@pytest.mark.parametrize("n", [300, 600, 900, 1_000, 2_000])
def test_longer_copies_stay_alike(spark, n):
    rng = random.Random(n)
    texts = [[f"w{rng.randrange(10**9)}" for _ in range(n + n // 10)] for _ in range(8)]
    # Of n + n / 10 elements, all but the last few of the copy are shared, so both minima are with probability 0.83.
    assert 0.75 < mean_likeness(spark, [(" ".join(t[:n]), " ".join(t)) for t in texts]) < 0.9


@pytest.mark.parametrize("n", [40, 100, 200])
def test_order_matters_in_short_texts(spark, n):
    rng = random.Random(n)
    texts = [[f"w{rng.randrange(10**9)}" for _ in range(n)] for _ in range(40)]
    turned = [(" ".join(t), " ".join(t[n // 2 :] + t[: n // 2])) for t in texts]
    # A pair of shared elements keeps its order in about half of the bins: when both come from the same half.
    same = ((n - 4) / (n + 4)) ** 2
    assert mean_likeness(spark, turned) == pytest.approx(same / 2, abs=0.05)


def test_every_bin_has_its_order(spark):
    df = spark.createDataFrame([("a",), ("a b",), ("a b c d e f g",)], "t string").select(order_minhash.fingerprint(F.col("t")).alias("f"))
    assert all([v >> 32 for v in r.f] == list(range(order_minhash.BINS)) for r in df.collect())


# -- 3 quality with sites --------------------------------------------------------------------


def test_site_quality(spark, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (3, 1), (18, 0), (11, 0), (13, 0), (21, 1), (21, 1), (None, 1), (9, None)], "doc_id bigint, quality int")
    got = site_quality.classify(docs, labels, docs["source"], docs["lang"]).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["kept"] == (r["score"] >= 0.5) for r in got)
    assert site_quality.classify(nothing, labels, nothing["source"], nothing["lang"]).count() == 0
    none = site_quality.classify(docs, labels.where("false"), docs["source"], docs["lang"]).collect()
    assert all(r["classifier"] == 0.5 for r in none)


def test_posteriors_shrink_and_leave_own_evidence_out(spark):
    rng = np.random.default_rng(5)
    rows = []
    for h, (rate, n) in enumerate([(0.9, 400), (0.5, 400), (0.1, 400), (0.7, 3)]):
        rows += [(f"h{h}", f"p{i % 4}", float(rng.random() < rate), 1.0) for i in range(n)]
    sites, mean, k_host, k_path = site_quality.posteriors(spark.createDataFrame(rows, "host string, path string, y double, w double"))
    assert mean == pytest.approx(np.mean([r[2] for r in rows]))
    rates = {h: np.mean([r[2] for r in rows if r[0] == h]) for h in ("h0", "h1", "h2", "h3")}
    counts = Counter(r[0] for r in rows)
    n, q = sum(counts.values()), sum(c * c for c in counts.values())
    spread = sum(counts[h] * (rates[h] - mean) ** 2 for h in rates)
    between = (spread - 3 * mean * (1 - mean)) / (n - q / n)
    assert k_host == pytest.approx(max(1.0, mean * (1 - mean) / between - 1))
    assert sites.count() == 15 and k_path > k_host  # paths of a host do not differ
    assert site_quality.fit(np.array([[0.0], [1.0]] * 50), np.array([0.0, 1.0] * 50))[0] > 3


def test_url_parts(spark):
    df = spark.createDataFrame([("https://u@A.example.org:80/en/12?x=/q", ), ("http://b.org", ), ("nonsense", ), (None, )], "url string")
    got = df.select(site_quality.url_host(F.col("url")), site_quality.url_path(F.col("url"))).collect()
    assert [tuple(r) for r in got] == [("a.example.org", "en"), ("b.org", ""), (None, ""), (None, None)]


# -- 4 packing -------------------------------------------------------------------------------


def test_packing(docs, nothing):
    got = packing.pack(docs, docs["length"] * 0 + F.length(docs["text"]), keep=("doc_id",), buckets=4, budget=2_000, slices=4).collect()
    assert len(got) == docs.count() and packing.pack(nothing, nothing["length"]).count() == 0
    seen = {(r["bucket"], r["batch"], r["slot"]) for r in got}
    assert len(seen) == len(got)
    batches = Counter((r["bucket"], r["batch"]) for r in got)
    size = {r["bucket"]: r["bucket_length"] for r in got}
    assert all(n * size[b] <= 2_000 or n == 1 for (b, _), n in batches.items())
    assert all(r["length"] <= r["bucket_length"] for r in got)
    for b in size:
        own = sorted(k for (x, k) in batches if x == b)
        assert own == list(range(len(own))) and all(batches[b, k] == max(1, 2_000 // size[b]) for k in own[:-1])


def test_boundaries_are_optimal():
    rng = np.random.default_rng(0)
    for _ in range(200):
        h = int(rng.integers(1, 9))
        lengths, counts, b = np.sort(rng.choice(60, h, replace=False) + 1), rng.integers(1, 20, h), int(rng.integers(1, 6))

        def cost(bounds, lengths=lengths, counts=counts):
            return sum(c * (min(x for x in bounds if x >= n) - n) for n, c in zip(lengths, counts))

        best = min(cost([*x, lengths[-1]]) for k in range(min(b, h)) for x in itertools.combinations(lengths[:-1], k))
        got = packing.boundaries(lengths, counts, b)
        assert len(got) <= b and cost(got) == best


def test_length_grid(spark):
    df = spark.range(0, 70_000).select("id", packing.rounded_up(F.col("id")).alias("g")).toPandas()
    n = df["id"].clip(lower=1)
    assert (df.g >= n).all() and (df.g[n <= 256] == n[n <= 256]).all() and ((df.g - n) / n < 1 / 64).all() and df.g.is_monotonic_increasing


# -- 5 BPE -----------------------------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def plain_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("most", [0, 40, byte_bpe.FREQUENT])
def test_bpe(docs, nothing, most):
    plain = plain_encoding()
    got = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, keep=("doc_id", "text"), most=most)
    got = got.select("text", "ids", byte_bpe.decoded(F.col("ids"), RANKS).alias("back")).collect()
    assert len(got) == docs.count()
    for r in got:
        assert list(r["ids"]) == plain.encode_ordinary(r["text"] or "")
        assert bytes(r["back"]).decode() == (r["text"] or "")
    assert byte_bpe.encode(nothing, RANKS, public_tokenizers.PATTERN, most=most).count() == 0


def test_bpe_of_long_words(spark):
    """Words on both sides of every limit: runs, periods, few letters (places that wait for a lower join), unspaced script, and one of 1 MB."""
    rng = random.Random(2)
    some = lambda signs, low, high: "".join(rng.choice(signs) for _ in range(rng.randint(low, high)))
    han = [chr(c) for c in range(0x4E00, 0x4F00)]
    texts = [some("ab", 1, 900) for _ in range(60)] + [some("etaoinshrdlu", 1, 900) for _ in range(60)] + [some(["é", "ж", "a", "中", "\U0001f600"], 1, 400) for _ in range(60)]
    texts += [some("-=", 80, 900) for _ in range(20)] + ["-" * 20_000 + " " * 9_000, "ab" * 25_000, some("acgt", 20_000, 20_000), some(han, 30_000, 30_000), "z" * 1_000_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    plain = plain_encoding()
    for r in byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN, most=0).collect():
        assert list(r["ids"]) == plain.encode_ordinary(texts[r["doc_id"]])


def plain_fold(ids, pairs):
    ids = list(ids)
    while True:
        found = [(pairs[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
        if not found:
            return ids
        r, i = min(found)
        ids[i : i + 2] = [r]


@pytest.mark.parametrize("seed", range(4))
def test_bpe_starts_and_fold(spark, tmp_path, seed):
    """Joins made before the fold change nothing, also under ranks in any order (joins that rank below their parts); the fold starts from fewer pieces."""
    rng = random.Random(seed)
    if seed:
        tokens = {b"a", b"b", b"c"}
        while len(tokens) < 40:
            tokens.add(rng.choice(sorted(tokens)) + rng.choice(sorted(tokens)))
        longer = sorted((t for t in sorted(tokens) if len(t) > 1), key=lambda t: len(t) + 3 * (seed - 1) * rng.random())
        path = str(tmp_path / "ranks")
        with open(path, "wb") as f:
            f.writelines(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate([bytes([i]) for i in range(256)] + longer))
        words = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 140))) for _ in range(300)]
    else:
        path, tokens = RANKS, sorted(byte_bpe.ranks(RANKS))
        words = [b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 30))) for _ in range(300)]
    words += [b"a" * n for n in (1, 2, 3, 95, 96, 97, 98, 200)] + [b"ab" * 60, b"\xff"]
    pairs, single = byte_bpe._pairs(path), [byte_bpe.ranks(path)[bytes([i])] for i in range(256)]
    start = byte_bpe.starts(words, byte_bpe.first_joins(path)).to_pylist()
    want = [plain_fold([single[c] for c in w], pairs) for w in words]
    ids = [[x % byte_bpe.IDS for x in pieces[1:-1]] for pieces in start]
    assert [plain_fold(i, pairs) for i in ids] == want
    assert sum(map(len, ids)) < sum(map(len, words)) or seed > 1
    df = spark.createDataFrame(list(enumerate(start)), "n int, start array<bigint>").repartition(2)
    got = df.select("n", byte_bpe.folded(F.col("start"), path).alias("ids")).collect()
    assert [list(r["ids"]) for r in sorted(got)] == want


# -- 6 token counts --------------------------------------------------------------------------

FILE = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts(docs, nothing):
    plain = token_counts.load(FILE)
    got = token_counts.count(docs, FILE, keep=("doc_id", "text"), chunk=2_000, overlap=50).collect()
    assert len(got) == docs.count() and token_counts.count(nothing, FILE).count() == 0
    for r in got:
        n = len(plain.encode(r["text"] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((r["text"] or "").encode()), n > 512)


def test_chunks_splice_and_widen():
    plain, rng = token_counts.load(FILE), random.Random(1)
    signs = ["a", "B", "\xe9", "  ", "\n", " ", "\xa0", "\x1c", "1", "<|endoftext|>", "'s", "!", "中", "\t", "\U0001f600", "​", "x" * 30]
    widened = 0
    for _ in range(400):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 300)))
        whole = plain.encode(text, add_special_tokens=False)
        for chunk, overlap in ((40, 5), (100, 30)):
            c = token_counts.Counter(plain, chunk, overlap)
            pieces = list(c.pieces(text))
            assert [i for ids, _ in pieces for i in ids] == whole.ids
            assert [tuple(o) for _, at in pieces for o in at] == whole.offsets
            widened += c.widened
    assert widened > 100


# -- 7 quality rules -------------------------------------------------------------------------


def plain_measures(text):
    t, w = text or "", words(text)
    lines = [x for x in t.split("\n") if words(x)]
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in quality_rules.SYMBOLS for c in t), len(lines), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(docs, nothing):
    got = quality_rules.judge(docs, keep=("doc_id", "text")).collect()
    assert len(got) == docs.count() and quality_rules.judge(nothing).count() == 0
    for r in got:
        n, *_, repeated = plain = plain_measures(r["k"]["text"])
        assert tuple(r["m"]) == plain
        assert r["base_failed"] == (n < 50 or 100 * repeated > 50 * n)
        assert r["kept"] == (r["failed_rule"] is None) and not (r["kept"] and r["base_failed"])
    by_id = {r["k"]["doc_id"]: r["failed_rule"] for r in got}
    assert by_id[1] is None and by_id[9] == "base" and by_id[20] is None and by_id[18] is not None and by_id[16] is not None


def test_cascade_order_changes_only_the_named_rule(docs):
    frame_ = quality_rules.measured(docs)
    rules = quality_rules.rules()
    one = quality_rules.cascade(frame_, rules).where("failed_rule IS NULL").count()
    two = quality_rules.cascade(frame_, rules[::-1]).where("failed_rule IS NULL").count()
    assert one == two
    found = quality_rules.ordered(quality_rules.measured(quality_rules.sampled(docs, 10)), rules)
    assert sorted(r.name for r, _, _ in found) == sorted(r.name for r in rules)
    worth = [share / cost for _, cost, share in found]
    assert worth == sorted(worth, reverse=True)


def test_cascade_sample_is_from_the_whole_table(spark):
    """Neither the first rows nor more with more partitions; a row that repeats is thrown for each time."""
    many = spark.range(0, 40_000, 1, 16).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    for parts in (4, 64):
        ids = [r["doc_id"] for r in quality_rules.sampled(many.repartition(parts), 2_000).select("doc_id").collect()]
        assert 1_700 < len(ids) < 2_300 and 500 < sum(i % 3 == 0 for i in ids) < 840 and 800 < sum(i < 20_000 for i in ids) < 1_200
    assert quality_rules.sampled(many.limit(50), 2_000).count() == 50
    # What a rule rejects in the sample is counted once, however often it is asked.
    text = F.when(F.col("id") < 25, F.lit("x")).otherwise(F.lit("word " * 60))
    (found,) = quality_rules.ordered(quality_rules.measured(spark.range(100).select(F.col("id").alias("doc_id"), text.alias("text"))), [quality_rules.Rule("short", F.col("m.n_words") < 50)])
    assert found[2] == 0.25


# -- 8 near duplicates -----------------------------------------------------------------------


def plain_groups(rows):
    sets = []
    for d, t in rows:
        w = words(lower(t))
        sets.append((d, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    least = list(range(len(sets)))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, (d, a) in enumerate(sets):
        for j in range(i):
            e, b = sets[j]
            both = len(a & b)
            if a and d is not None and e is not None and 100 * both >= 75 * (len(a) + len(b) - both):
                least[max(find(i), find(j))] = min(find(i), find(j))
    ids = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted((str(d), len(s), str(ids[find(i)] if d is not None else None)) for i, (d, s) in enumerate(sets))


def test_near_duplicates_edges(docs, nothing, rows):
    got = near_dedup.groups(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == plain_groups([(r[0], r[1]) for r in rows])
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert near_dedup.groups(nothing).count() == 0


def test_near_duplicates_in_large_buckets(spark, monkeypatch):
    """Chains of edits and passages that many share, with buckets that all go through leaders and blocks."""
    monkeypatch.setattr(near_dedup, "SMALL", 1)
    monkeypatch.setattr(near_dedup, "LEADERS", 1)
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    monkeypatch.setattr(near_dedup, "GROUP", 3)
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(4_000)]
    new = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, shared = [], new(120)
    for _ in range(3):
        w = new(150)
        for _ in range(12):  # each a little further from the first
            rows.append(" ".join(w))
            at = rng.randrange(len(w))
            w = w[:at] + new(3) + w[at + 3 :]
    rows += [" ".join(shared + new(60)) for _ in range(25)] + [" ".join(new(90)) for _ in range(10)]
    rows = [(i, t) for i, t in enumerate(rows)] + [(200, rows[5]), (201, rows[5])]
    rng.shuffle(rows)
    got = near_dedup.groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == plain_groups(rows)


def test_bayes_limits():
    limits = near_dedup.posterior_limits()
    assert list(limits) == list(range(16, 129, 16)) and all(limits[n] < 0.75 * n for n in limits) and limits[128] > 64
    # The dropped share of pairs exactly at the threshold stays below the batches' miss probability by far.
    rng = np.random.default_rng(2)
    a = rng.integers(0, 256, (20_000, 128), dtype=np.uint8)
    b = np.where(rng.random(a.shape) < 0.75, a, rng.integers(0, 256, a.shape, dtype=np.uint8))
    assert len(near_dedup.surviving(a, b, limits)) >= len(a) - 2
    c = np.where(rng.random(a.shape) < 0.3, a, rng.integers(0, 256, a.shape, dtype=np.uint8))
    assert len(near_dedup.surviving(a, c, limits)) == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (200, 300), (300, 150)] + [(500, i) for i in range(501, 560)]
    got = {r["node"]: r["component"] for r in near_dedup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[102] == 100 and got[200] == got[300] == 150 and got[559] == 500


# -- 9 WARC ----------------------------------------------------------------------------------


def pages(spark):
    html = "<p>" + "same " * 50
    rows = [(i, f"http://a.org/{i}", "<html>" + f"page {i} " * (i % 40)) for i in range(60)]
    rows += [(70, None, html), (65, "http://x y/\r\nX: 1", html), (71, "u", html), (71, "u", html), (72, "u", None), (73, "u", ""), (None, "u", html), (74, "u", "short"), (75, "u", "short"), (76, "u", "中" * 400_000)]
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, digest string, payload string"), rows


def test_warc_round_trip(spark):
    df, rows = pages(spark)
    folder = warc.write(df.repartition(3), common.shared_folder(spark))
    got = warc.resolved(warc.read(spark, folder)).collect()
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    expected = []
    for p, _, h in rows:
        raw = (h or "").encode()
        again = len(raw) >= 100 and first[h or ""] != p
        expected.append((str(p), len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", str(first[h or ""] if again else None)))
    assert sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in got) == sorted(expected)
    kept = {r["page_id"]: r["payload"] for r in warc.read(spark, folder).where("record_type = 'response'").collect()}
    assert bytes(kept[76]).decode() == "中" * 400_000
    empty = warc.write(df.where("false"), common.shared_folder(spark))
    assert warc.resolved(warc.read(spark, empty)).count() == 0


def test_warc_files_roll_over_and_lost_attempts_are_not_read(spark):
    df, rows = pages(spark)
    folder = warc.write(df.repartition(2), common.shared_folder(spark), file_bytes=2_000)
    listed = spark.read.parquet(f"{folder}/_files").collect()
    assert len(listed) > 4 and sum(r["n"] for r in listed) == len(rows)
    place = warc._filesystem(folder)[1]
    first = next(r["file"] for r in listed if r["n"])
    with open(f"{place}/{first}", "rb") as f, open(f"{place}/part-000000-999-0000.warc.zst", "wb") as g:
        g.write(f.read())  # what a lost attempt left
    assert warc.read(spark, folder).count() == len(rows)


def test_warc_folders_of_others(spark):
    """Without a list of files every archive below the folder is read; faults are rows where asked."""
    folder = common.shared_folder(spark)
    place = warc._filesystem(folder)[1]
    os.makedirs(place)
    one = [warc.record(i, f"http://a/{i}", b"x" * i, hashlib.sha256(b"x" * i).hexdigest(), None, "2020-01-01T00:00:00Z") for i in range(1, 200)]
    packer = zstandard.ZstdCompressor()
    for k in range(3):
        with open(f"{place}/{k}.warc.zst", "wb") as f:
            f.write(b"".join(packer.compress(x) for x in one[k::3]) + (b"junk" if k == 2 else b""))
    got = warc.read(spark, folder, errors="flag").collect()
    assert sorted(r["page_id"] for r in got if r["error"] is None) == list(range(1, 200)) and sum(r["error"] is not None for r in got) == 1
    with pytest.raises(Exception, match="no frame"):
        warc.read(spark, folder).count()


def test_warc_paths():
    for path, wanted in (("s3a://bucket/a", "s3://bucket/a"), ("s3n://b/a:/c", "s3://b/a:/c"), ("s3://b/a", "s3://b/a"), ("hdfs://n:1/a", "hdfs://n:1/a"), ("/a/b", "file:///a/b")):
        assert warc._uri(path) == wanted
    assert [warc._filesystem(p)[1] for p in ("/a/b", "file:/a/b", "file:///a/b")] == ["/a/b"] * 3


def test_warc_frames_and_faults():
    one = warc.record(1, "http://a/", b"x" * 10, hashlib.sha256(b"x" * 10).hexdigest(), None, "2020-01-01T00:00:00Z")
    assert warc.parse(one)[0] == 1 and warc.parse(one)[5] == b"x" * 10
    for bad in (one[:-1], one[8:], one.replace(b"Content-Length: ", b"Content-Length: 1"), one.replace(b"x" * 10, b"y" * 10), one.replace(b"WARC-Date", b"Date"), one.replace(b"response\r\nWARC", b"other\r\nWARC")):
        with pytest.raises(warc.Malformed):
            warc.parse(bad)
    samples = [(f"<html>{i} " + "abc def " * (i % 30)).encode() for i in range(300)]
    dictionary = zstandard.train_dictionary(4_096, samples).as_bytes()
    for raw in (dictionary, b""):
        packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw)) if raw else zstandard.ZstdCompressor()
        data = warc.header(raw) + b"".join(packer.compress(s) for s in samples)
        assert list(warc.frames(data)) == samples == list(warc.frames(io.BytesIO(data)))
        with pytest.raises(warc.Malformed):
            list(warc.frames(data[:-3]))
        with pytest.raises(warc.Malformed):
            list(warc.frames(data + b"junk"))


# -- 10 licenses -----------------------------------------------------------------------------


def test_licenses_base(spark, docs, nothing):
    rng = random.Random(4)
    extra = ["GNU General Public License", "mit-license mit license", "Apache  License", "cc by cc by", "CC-BY-NC 4.0", "mitx license", "under the MIT\nLicense.", "é mit licenseé"]
    rows = [(i, " ".join([prose(rng, 5), e, prose(rng, 5)])) for i, e in enumerate(extra)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").union(docs.select("doc_id", "text"))
    got = licenses.scan(df, keep=("doc_id", "text")).collect()
    assert len(got) == df.count() and licenses.scan(nothing).count() == 0
    for r in got:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r["text"]))
        places = sorted((label, i, i + len(p.split()) - 1) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        assert r["n_words"] == len(w) and sorted(tuple(b) for b in r["base"]) == places


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_licenses_with_errors():
    rng = random.Random(9)
    notices = [licenses._notice(*n) for n in licenses.NOTICES]
    for phrase, label, most in licenses.NOTICES:
        for n in range(most + 1):
            for _ in range(12):
                s = list(phrase)
                for _ in range(n):
                    at = rng.randrange(1, len(s) - 1)
                    s[at : at + 1] = rng.choice([[], [s[at], "q"], ["z"]])
                text = "the thing of " + "".join(s) + " and the rest"
                norm = licenses.normal(text)
                found = [x for x in licenses.fuzzy_places(norm, notices) if x[0] == label]
                w = norm.decode().split()
                assert found, (phrase, text)
                for _, first, last, e, likeness in found:
                    assert e <= 8 and 0 < likeness <= 1
                    assert any(edits(p, " ".join(w[first : last + 1])) <= k for p, lab, k in licenses.NOTICES if lab == label)
    for clean in ("the limit of licence fees was met", "apache helicopters have no such thing", "a public road and general notes", "submit licenses here today"):
        assert licenses.fuzzy_places(licenses.normal(clean), notices) == []


def test_licenses_beside_a_better_match_stay():
    notices = [licenses._notice(*n) for n in licenses.NOTICES]
    for text in ("mit licanse mit lisense mit licence mit license", "mit license mit lisense mit licanse", "mit licanse and mit license and mit lisense", "mit licanse mit lisense"):
        w = text.split()
        starts = [i for i, x in enumerate(w) if x == "mit"]
        found = licenses.fuzzy_places(licenses.normal(text), notices)
        assert [(a, b) for _, a, b, _, _ in found] == [(i, i + 1) for i in starts], text
        assert [e for *_, e, _ in found] == [int(w[i + 1] != "license") for i in starts]


def test_license_edits_are_of_signs():
    notices = [licenses._notice(*n) for n in licenses.NOTICES]
    for text in ("mit licénse x", "é中 mit lic中nse 中", "mit lic\U0001f600nse"):
        (found,) = licenses.fuzzy_places(licenses.normal(text), notices)
        first = text.split().index("mit")
        assert found == ("mit", first, first + 1, 1, 1 - 1 / len("mit license"))


def test_notices_in_long_rows():
    """A megabyte of notices goes through in one sweep, each found where it stands."""
    notices = [licenses._notice(*n) for n in licenses.NOTICES]
    exact = [(b" mit license ", "mit", 2)]
    start = time.perf_counter()
    assert licenses.exact_places(licenses.normal("mit license " * 80_000), exact) == [("mit", 2 * i, 2 * i + 1) for i in range(80_000)]
    found = licenses.fuzzy_places(licenses.normal("mit licanse " * 20_000), notices)
    assert [x[:4] for x in found if x[0] == "mit"] == [("mit", 2 * i, 2 * i + 1, 1) for i in range(20_000)]
    assert time.perf_counter() - start < 30
    # A sign too many at the start counts as an edit, a first word left out is four edits at the start of a text as anywhere else.
    for text, wanted in (("a nmit license", [("mit", 1, 2, 1)]), ("nmit license", [("mit", 0, 1, 1)]), ("general public license", []), ("another general public license", [])):
        assert [x[:4] for x in licenses.fuzzy_places(licenses.normal(text), notices)] == wanted
