"""The corpus pipeline against plain versions of its stages, on awkward rows."""

from collections import Counter

import corpus_pipeline
import public_tokenizers

from seriesloom.llm import common, packing, queries, token_counts
from tests.llm.cases import edge_texts, frame
from tests.llm.test_methods import plain_groups, plain_measures


def test_stages(spark, tmp_path):
    docs = frame(spark, edge_texts())
    now, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        out = common.written(stage(spark, now, "/root/testdata/sf0.001"))
        if name != "packing":
            assert out.columns == docs.columns and out.count() <= now.count()
        seen.append((name, now, out))
        now = out
    (_, before, after) = seen[0]
    assert {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in after.collect()} >= {4, 5, 6}
    (_, before, after) = seen[1]
    for r in after.collect():
        n, *_, repeated = plain_measures(r["text"])
        assert n >= 50 and 100 * repeated <= 50 * n
    (_, before, after) = seen[2]
    groups = plain_groups([(r["doc_id"], r["text"]) for r in before.collect()])
    wanted = {d for d, _, c in groups if d == c}
    got = [str(r["doc_id"]) for r in after.collect()]
    assert {d for d in got if d != "None"} == wanted - {"None"} and len(got) == len({(r["doc_id"], r["text"]) for r in after.collect()})
    assert seen[3][2].count() == after.count()


def test_empty_table(spark):
    now = frame(spark, edge_texts()).where("false")
    for _, stage in corpus_pipeline.STAGES:
        now = common.written(stage(spark, now, "/root/testdata/sf0.001"))
    assert now.count() == 0


def test_batches_hold_the_budget_in_tokens(spark):
    docs = common.documents(spark, "/root/testdata/sf0.001")
    tokenizer = token_counts.load(public_tokenizers.path("byte_bpe_50k.json"))
    real = {r["doc_id"]: len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.select("doc_id", "text").collect()}
    for out in (queries.op4_packing(spark, "/root/testdata/sf0.001"), corpus_pipeline.pack(spark, docs, "/root/testdata/sf0.001")):
        rows, tokens, members = out.collect(), Counter(), Counter()
        assert {r["doc_id"]: r["length"] for r in rows} == real
        for r in rows:
            tokens[r["bucket"], r["batch"]] += real[r["doc_id"]]
            members[r["bucket"], r["batch"]] += 1
        assert all(n <= packing.BUDGET or members[k] == 1 for k, n in tokens.items())


def test_language_stage_rejects_foreign_scripts(spark):
    learned = [(d, f"the water of the house is cold and the stone lies there {d}", "en", "s0") for d in range(60)]
    learned += [(d, f"das wasser der stadt ist kalt und der stein liegt dort {d}", "de", "s0") for d in range(60, 80)]
    foreign = [(100, "вода в доме холодная и камень лежит там " * 20, None, "s0"), (101, "水很冷石头在那里 " * 20, None, "s0"), (102, "המים קרים " * 20, None, "s0"),
               (103, "вода в доме холодная и камень лежит там " * 20 + "the water of the house", None, "s0"), (104, "the water of the house is cold вода", None, "s0")]
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, frame(spark, learned + foreign), "/root/testdata/sf0.001").collect()}
    assert kept == {*range(80), 104}
