"""The manifest against trees built plainly, with few and with many tiers, and proofs that tell tampered rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from seriesloom.llm import merkle, queries
from tests.llm.cases import edge_texts, frame, lower


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes, ways):
    """The root, and of each node its siblings left and right level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            own = at[i]
            first = own - own % ways
            p.append(("".join(nodes[first:own]), "".join(nodes[own + 1 : first + ways])))
            at[i] = own // ways
        nodes = [sha("".join(nodes[i : i + ways])) for i in range(0, len(nodes), ways)]
    return nodes[0], paths


def plain_manifest(rows, ways):
    """(tree, order, leaf) -> per row in that order: leaf, subroot, root, path."""
    trees = {}
    for t, o, d in sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])):
        trees.setdefault(t, []).append(d)
    built = [plain_tree(list(ds), ways) for ds in trees.values()]
    root, above = plain_tree([b[0] for b in built], ways)
    return sorted((d, b[0], root, str(p + up)) for ds, b, up in zip(trees.values(), built, above) for d, p in zip(ds, b[1]))


def found_manifest(df):
    paths = lambda r: str([(s.left.decode(), s.right.decode()) for s in r.path])
    return sorted((r.leaf, r.subroot, r.root, paths(r)) for r in df.collect())


@pytest.mark.parametrize("ways", [16, 2])
@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 600, 2, 256, 257], [3] * 40])
def test_manifest_is_the_plain_tree(spark, monkeypatch, ways, sizes):
    monkeypatch.setattr(merkle, "WAYS", ways)
    monkeypatch.setattr(merkle, "BLOCK", ways * ways)
    if ways == 2:
        sizes = [min(s, 40) for s in sizes]
    rng = random.Random(sum(sizes))
    rows = [(None if i == 0 else f"s{i}é" if i % 2 else f"S{i}", None if rng.random() < 0.02 else rng.randint(0, 3 * n), sha(str(rng.randint(0, 400)))) for i, n in enumerate(sizes) for _ in range(n)]
    df = spark.createDataFrame(rows, "k0 string, pos bigint, digest string").repartition(3)
    found = merkle.manifest(df, df["digest"], df["k0"], df["pos"], keep=("k0", "pos"))
    assert found_manifest(found) == plain_manifest(rows, ways)


def test_query_against_the_plain_manifest(spark, tmp_path):
    rng = random.Random(9)
    rows = edge_texts() + [(i, rng.choice(["Some Text", "plain words", ""]) + str(i), rng.choice(["en", None]), rng.choice(["hot", "hot", "s1", None])) for i in range(30, 700)]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_merkle(spark, str(tmp_path)).collect()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf_of = lambda d, t, lang, source, text: sha("".join(map(field, (d, source, lang, len(t or ""), text))))
    leaves = [(r[3], r[0], leaf_of(*r[:2], r[2], r[3], r[1])) for r in rows]
    plain = plain_manifest(leaves, 16)
    proofs = {p[0]: (p[1], p[2], p[3]) for p in plain}
    assert sorted(r.leaf for r in found) == sorted(x[2] for x in leaves)
    lowered = {x[2]: leaf_of(*r[:2], r[2], r[3], r[1] if r[1] is None else lower(r[1])) for r, x in zip(rows, leaves)}
    paths = {}
    for p in plain:
        paths.setdefault(p[0], set()).add(sha("".join(a + b for a, b in eval(p[3]))))
    changed = 0
    for r in found:
        assert (r.subroot, r.root) == proofs[r.leaf][:2] and r.proof_sha256 in paths[r.leaf]
        tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and lowered[r.leaf] != r.leaf
        assert r.verified == (not tampered) == (r.folded_root == r.root)
        changed += tampered
    assert 20 < changed < 200


def test_no_rows(spark):
    df = spark.createDataFrame([], "k0 string, pos bigint, digest string")
    assert merkle.manifest(df, df["digest"], df["k0"], df["pos"]).count() == 0


def test_one_row_is_its_own_root(spark):
    df = spark.createDataFrame([("a", 1, "ab")], "k0 string, pos bigint, digest string")
    r = merkle.manifest(df, df["digest"], df["k0"], df["pos"]).withColumn("p", merkle.proof(F.col("path"))).first()
    assert (r.leaf, r.subroot, r.root, r.p) == ("ab", "ab", "ab", sha(""))
