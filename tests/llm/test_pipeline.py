"""The pipeline on small tables: every stage's decisions, one after the other."""

import random

import corpus_pipeline
import public_tokenizers

from orderloom.llm import byte_bpe, common

from .cases import WORDS


def test_stages_take_effect_in_order(spark, tmp_path):
    pick = random.Random(2)
    fresh = lambda n: " ".join(pick.choice(WORDS) + str(pick.randint(0, 9999)) for _ in range(n))
    item = fresh(14)
    rows, toxic = [], []
    for i in range(200):
        bad = i % 4 == 0
        rows.append((i, f"{fresh(20)} {'snarlwort ' * bad}{fresh(5)}"))
        toxic.append((i, 1, int(bad)))
    line = fresh(12)
    rows += [(300, f"{fresh(15)}\n{line}"), (301, f"{line}\n{fresh(15)}"), (302, rows[1][1]), (303, f"{fresh(9)} {item}")]
    rows += [(304, None), (305, ""), (None, fresh(8))]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    wide = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(wide, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(toxic, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "byte_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            left[name] = {r.doc_id: r.text for r in docs.collect()}
    clean = {i for i in range(200) if i % 4}
    assert set(left["toxicity"]) == clean | {300, 301, 302, 303, 304, 305, None}
    texts = left["line_dedup"]
    assert set(texts) == set(left["toxicity"])
    assert texts[300] == dict(rows)[300] and texts[301] == dict(rows)[301].split("\n")[1]
    assert texts[302] == "" and texts[1] == dict(rows)[1]
    assert clean <= set(left["near_dedup"]) and {300, 301, 303} <= set(left["near_dedup"])
    assert set(left["near_dedup"]) - set(left["decontamination"]) == {303}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == set(left["decontamination"])
    assert all(len(r.token_ids) == 4 * r.n_tokens for r in out.values())


def test_a_worker_lets_go_of_what_an_earlier_stage_kept(monkeypatch):
    freed = []
    monkeypatch.setattr(common, "_KEPT", {"earlier": object()})
    monkeypatch.setattr(common.gc, "collect", lambda: freed.append("objects"))
    pool = type("Pool", (), {"release_unused": lambda self: freed.append("memory")})()
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: pool)
    monkeypatch.setattr(common.pa, "system_memory_pool", lambda: pool)
    assert common.kept("later", lambda: 1) == 1 and common.kept("later", lambda: 2) == 1
    assert freed == ["objects", "memory", "memory"] and list(common._KEPT) == ["later"]
    coder = byte_bpe.ByteBPE(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert coder.of_piece.bound <= 100_000 and coder.of_unit.bound <= 100_000


def test_tasks_hold_few_texts_at_a_time(spark):
    from orderloom.llm.common import filter_texts, map_texts

    rows = spark.range(0, 3500, 1, 1).selectExpr("string(id) as text")
    got = map_texts(rows, {"n": "bigint"}, lambda: lambda texts: [[len(texts)] * len(texts)]).collect()
    assert sorted(int(r.text) for r in got) == list(range(3500)) and max(r.n for r in got) <= 1000
    few = filter_texts(rows, lambda: lambda texts: [len(texts) <= 1000 and t != "7" for t in texts])
    assert few.count() == 3499
