"""Named queries of the corpus operators over the check tables, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import byte_bpe, common, fill_middle, language_id, licenses, merkle, near_dedup, neighbours, order_minhash, packing, quality_rules, site_quality, token_counts, warc

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document: exact phrases and notices with bounded errors."""
    found = licenses.scan(common.documents(spark, sf_dir))
    base = F.transform("base", lambda x: x["label"])
    starts = F.transform("base", lambda x: x["first"])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.transform("spans", lambda x: x["label"]))).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda x: x["likeness"])), F.lit(0.0))).alias("score"),
        F.to_json("spans").alias("spans"),
    )


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 50k byte-level vocabulary."""
    return token_counts.count(common.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


ORACLES["op9_warc_round_trip"] = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM f"""


@query
def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as Zstandard WARC archives and read back."""
    folder = warc.write(common.documents(spark, sf_dir, "pages"), common.shared_folder(spark))
    return warc.resolved(warc.read(spark, folder)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op7_quality_rules"] = r"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
    g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w),
    twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
    covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
    m AS (SELECT w.doc_id, w.t, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(w.t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, len(w.l) AS n_lines,
                 CAST(len(w.l) - len(list_distinct(w.l)) AS BIGINT) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
                 length(regexp_replace(w.t, '[^A-Z]+', '', 'g')) AS capitals,
                 length(regexp_replace(w.t, '[\p{L}\p{M}\x20\x09-\x0D]+', '', 'g')) AS other
          FROM w LEFT JOIN covered c USING (rid)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 100 * n_symbols > 30 * n_words OR n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines OR 100 * capitals > 40 * word_chars
                OR 100 * other > 40 * word_chars OR regexp_matches(t, '[\x21-\x7E]{300}')) AS kept
    FROM b"""


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    judged = quality_rules.judge(common.documents(spark, sf_dir))
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("k.doc_id", *[f"m.{c}" for c in measures], "base_failed", "kept")


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_dedup.groups(common.documents(spark, sf_dir))


def held_out() -> Column:
    """The rows that a language model never learns from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned on the rows that are not held out."""
    docs = common.documents(spark, sf_dir)
    found = language_id.identify(docs, language_id.train(docs, where=~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


@query
def op3_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; its source is the host, its language the part of it."""
    docs, labels = common.documents(spark, sf_dir), common.documents(spark, sf_dir, "labels")
    return site_quality.classify(docs, labels, docs["source"], docs["lang"])


def packed(docs: DataFrame) -> DataFrame:
    """Length buckets and token-budget batches by exact counts under the 50k byte-level vocabulary; texts are counted once."""
    counted = common.written(token_counts.count(docs, public_tokenizers.path("byte_bpe_50k.json")))
    return packing.pack(counted, counted["n_tokens"])


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length buckets and token-budget batches of all documents."""
    return packed(common.documents(spark, sf_dir))


@query
def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return order_minhash.fingerprinted(common.documents(spark, sf_dir))


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document under the multilingual 50k ranks, and back."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = byte_bpe.encode(common.documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decoded(F.col("ids"), path), 256).alias("decoded_sha256"),
    )


ORACLES["op11_fill_middle"] = """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    n AS (SELECT *, length(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
                 CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
    p AS (SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1, n - b) AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                            WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p"""


@query
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document turned for filling in its middle, and turned back."""
    turned = fill_middle.transform(common.documents(spark, sf_dir))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return turned.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(fill_middle.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


# In SQL a tree is (tier, position) rows made by recursion; tier 0 of the trees are leaves, of the last tree their roots.
_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR) END".format
_LEAF = " || ".join(_FIELD(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# The table of the polynomial, then one step per byte of the decimal id (its digits and sign are single bytes).
_CRC_TABLE = "list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))))"
_CRC = "xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))), lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])))"
ORACLES["op12_merkle"] = f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, text, coalesce('1' || source, '0') AS tree,
               sha256({_LEAF} || {_FIELD("text")}) AS leaf, sha256({_LEAF} || {_FIELD(_LOWER)}) AS lower_leaf,
               coalesce({_CRC} % 5 = 0, false) AS tampered
        FROM documents, (SELECT {_CRC_TABLE} AS crc)),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY tree) AS n FROM d),
    up(tier, tree, p, h, n) AS (
        SELECT 0, tree, p, leaf, n FROM leaves
        UNION ALL
        SELECT tier + 1, tree, p // 16, sha256(string_agg(h, '' ORDER BY p)), (n + 15) // 16 FROM up WHERE n > 1 GROUP BY tier, tree, p // 16, n),
    subs AS (SELECT tree, h, tier, row_number() OVER (ORDER BY tree) - 1 AS p, count(*) OVER () AS n FROM up WHERE n = 1),
    top(tier, p, h, n) AS (
        SELECT 0, p, h, n FROM subs
        UNION ALL
        SELECT tier + 1, p // 16, sha256(string_agg(h, '' ORDER BY p)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY tier, p // 16, n),
    root AS (SELECT h FROM top WHERE n = 1),
    marked AS (SELECT l.*, row_number() OVER (ORDER BY l.tree, l.p) AS id, s.h AS subroot, s.p AS sp, s.tier AS tiers FROM leaves l JOIN subs s USING (tree)),
    steps AS (
        SELECT m.id, u.tier, coalesce(string_agg(u.h, '' ORDER BY u.p) FILTER (u.p < m.p // CAST(16 ** u.tier AS BIGINT)), '') AS a,
               coalesce(string_agg(u.h, '' ORDER BY u.p) FILTER (u.p > m.p // CAST(16 ** u.tier AS BIGINT)), '') AS b
        FROM marked m JOIN up u ON u.tree = m.tree AND u.n > 1 AND u.p // 16 = m.p // CAST(16 ** (u.tier + 1) AS BIGINT) GROUP BY m.id, u.tier
        UNION ALL
        SELECT m.id, m.tiers + u.tier, coalesce(string_agg(u.h, '' ORDER BY u.p) FILTER (u.p < m.sp // CAST(16 ** u.tier AS BIGINT)), ''),
               coalesce(string_agg(u.h, '' ORDER BY u.p) FILTER (u.p > m.sp // CAST(16 ** u.tier AS BIGINT)), '')
        FROM marked m JOIN top u ON u.n > 1 AND u.p // 16 = m.sp // CAST(16 ** (u.tier + 1) AS BIGINT) GROUP BY m.id, m.tiers, u.tier),
    proofs AS (SELECT id, sha256(string_agg(a || b, '' ORDER BY tier)) AS proof, max(tier) AS last FROM steps GROUP BY id),
    fold(id, tier, h) AS (
        SELECT id, 0, CASE WHEN tampered THEN lower_leaf ELSE leaf END FROM marked
        UNION ALL
        SELECT fold.id, fold.tier + 1, sha256(s.a || fold.h || s.b) FROM fold JOIN steps s ON s.id = fold.id AND s.tier = fold.tier)
    SELECT m.doc_id, m.leaf, m.subroot, r.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256, fold.h AS folded_root, fold.h = r.h AS verified
    FROM marked m JOIN fold ON fold.id = m.id LEFT JOIN proofs p ON p.id = m.id, root r WHERE fold.tier = coalesce(p.last + 1, 0)"""


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of every document under one root, checked against documents of which a fifth were tampered with."""
    docs = common.documents(spark, sf_dir)
    columns = ("doc_id", "source", "lang", "n_chars")
    leaf = merkle.leaf(*[F.col(c) for c in columns], F.col("text"))
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = docs.select("doc_id", "source", leaf.alias("leaf"), F.when(chosen, merkle.leaf(*[F.col(c) for c in columns], lower)).otherwise(leaf).alias("seen"))
    found = merkle.manifest(leaves, leaves["leaf"], leaves["source"], leaves["doc_id"], keep=("doc_id", "seen"))
    found = found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), merkle.folded(F.col("seen"), F.col("path")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every 20th vector."""
    vectors = common.documents(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors["vec_id"] % 20 == 0, 20)
