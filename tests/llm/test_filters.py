"""Decontamination against brute force; classifiers by held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from orderloom.llm import decontaminate, quality, toxicity

from .cases import EDGES, WORDS, documents, sentence

ITEMS = [
    (1, sentence(5, 25)),
    (2, "Short Item"),
    (2, "short, item!"),
    (3, None),
    (4, " .. "),
    (5, "größe 12 " + sentence(8, 12)),
    (None, sentence(6, 14)),
]


def benchmark(spark, rows=None):
    wide = [("x", t, i, "y") for i, t in (ITEMS if rows is None else rows)]
    return spark.createDataFrame(wide, "Text string, text string, item_id bigint, other string")


def near_documents():
    rows = list(EDGES)
    rows += [(30, f"before {sentence(5, 25).upper()} after"), (31, "a SHORT item here"), (32, sentence(5, 9))]
    rows += [(33, sentence(6, 14) + " short item"), (34, "Größe 12\n" + sentence(8, 12)), (34, "short short item")]
    return rows


def brute(text, window=10):
    own = decontaminate.words(text)
    hit, items = set(), set()
    for i, t in ITEMS:
        item = decontaminate.words(t)
        size = min(window, len(item))
        for a in range(len(item) - size + 1 if size else 0):
            for b in range(len(own) - size + 1):
                if own[b : b + size] == item[a : a + size]:
                    hit |= set(range(b, b + size))
                    if i is not None:
                        items.add(str(i))
    return len(own), hit, sorted(items)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_hits_equal_brute_force(spark, block_bytes):
    rows = near_documents()
    marked = decontaminate.mark(documents(spark, rows), benchmark(spark), block_bytes=block_bytes)
    found = marked.collect()
    assert len(found) == len(rows)
    for r in found:
        n, hit, items = brute(r[3])
        runs = r[decontaminate.RUNS]
        covered = {p for a, b in zip(runs[::2], runs[1::2], strict=True) for p in range(a, b)}
        assert (r[decontaminate.COUNT], covered, r[decontaminate.ITEMS]) == (n, hit, items)
    found = decontaminate.hits(documents(spark, rows), benchmark(spark), block_bytes=block_bytes).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.contaminated) for r in found) == sorted(
        (str(i), n, len(h), bool(h)) for i, (n, h, _) in ((i, brute(t)) for i, t in rows)
    )


def test_documents_or_spans_are_removed(spark):
    rows = near_documents()
    docs = documents(spark, rows)
    left = decontaminate.decontaminate(docs, benchmark(spark))
    assert left.columns == docs.columns
    assert sorted(str(r[3]) for r in left.collect()) == sorted(str(t) for _, t in rows if not brute(t)[1])
    cut = decontaminate.decontaminate(docs, benchmark(spark), remove="spans").collect()
    assert len(cut) == len(rows)
    by_text = {t: r[3] for (_, t), r in zip(rows, cut, strict=True)}
    assert by_text["a SHORT item here"] == "a  here"
    assert by_text[f"before {sentence(5, 25).upper()} after"] == "before  after"
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, benchmark(spark), remove="all")
    assert decontaminate.hits(docs, benchmark(spark, [])).where("contaminated").count() == 0
    assert decontaminate.hits(docs.limit(0), benchmark(spark)).count() == 0


BAD = ("grumble", "snarlwort", "blightet")
DISGUISES = (
    lambda w: w,
    lambda w: w.replace("l", "1").replace("e", "3"),
    lambda w: w[:3] + w[3] * 4 + w[4:],
    lambda w: " ".join(w),
)


def corpus(n: int, disguise=None):
    pick = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        words = [pick.choice(WORDS) for _ in range(pick.randint(5, 40))]
        toxic = i % 4 == 0
        if toxic:
            hide = disguise if disguise and i % 8 == 0 else DISGUISES[0]
            words.insert(pick.randrange(len(words)), hide(pick.choice(BAD)))
        good = i % 3 > 0
        text = " ".join(words) if good else "!!! ".join(w.upper() for w in words)
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


def label_table(spark, labels):
    wide = [(a, "x", b, c) for a, b, c in labels]
    return spark.createDataFrame(wide, "doc_id bigint, text string, quality int, toxic int")


def accuracy(rows, labels, column):
    truth = {r[0]: r[column] for r in labels}
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    return sum(r.predicted == truth[r.doc_id] for r in held) / len(held)


def test_toxicity_on_held_out_rows(spark):
    rows, labels = corpus(600)
    docs = documents(spark, rows)
    model = toxicity.train(docs, label_table(spark, labels))
    found = toxicity.score(docs, model).collect()
    assert accuracy(found, labels, 2) > 0.97
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert {r[1] for r in kept.collect()} == {r.doc_id for r in found if not r.predicted}


@pytest.mark.parametrize("hide", DISGUISES[1:])
def test_disguised_words_are_restored(spark, hide):
    rows, labels = corpus(600)
    docs = documents(spark, rows)
    model = toxicity.train(docs, label_table(spark, labels))
    hidden = documents(spark, [(k, f"amber birch {hide(w)} cedar delta") for k, w in enumerate(BAD)])
    assert [r.predicted for r in toxicity.score(hidden, model).collect()] == [1] * 3
    assert toxicity.Restorer(model.costs).restore("amber birch") == "amber birch"


def test_quality_on_held_out_rows(spark):
    rows, labels = corpus(600)
    docs = documents(spark, rows)
    found = quality.score(docs, quality.train(docs, label_table(spark, labels))).collect()
    assert accuracy(found, labels, 1) > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows, labels = corpus(300)
    docs = documents(spark, rows)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    turned = [(i, 1 - q, 1 - t) if held(i) else (i, q, t) for i, q, t in labels]
    for module in (quality, toxicity):
        one, two = (
            [r.score for r in module.score(docs, module.train(docs, label_table(spark, x))).collect()]
            for x in (labels, turned)
        )
        assert one == two


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_stand_edge_cases(spark, module):
    rows, labels = corpus(200)
    docs = documents(spark, rows)
    labels += [(None, 1, 1), (3, None, None), (999, 0, 1), (4, 1, 1), (4, 0, 0)]
    model = module.train(docs, label_table(spark, labels))
    edges = module.score(documents(spark, EDGES), model).collect()
    assert [r.doc_id for r in edges] == [i for i, _ in EDGES]
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in edges)
    assert module.score(docs.limit(0), model).count() == 0
    for some in ([], [(1, 1, 0), (2, 1, 0)], [(i, i % 2, i % 2) for i in range(5)]):
        for table in (docs, docs.limit(0)):
            one = module.train(table, label_table(spark, some))
            assert module.score(docs, one).count() == len(rows)


def test_trigrams_do_not_depend_on_the_slices(monkeypatch):
    texts = ["Ab c!", "", "x" * 50, "größe 日本 0"] * 60
    plain = toxicity.symbols("  " + "  ".join(texts) + "  ").astype(int)
    want = np.bincount((plain[:-2] * 64 + plain[1:-1]) * 64 + plain[2:], minlength=64**3)
    for size in (7, 1 << 19):
        monkeypatch.setattr(toxicity, "CHARACTERS", size)
        counts = np.zeros(64**3, np.int64)
        toxicity.count_trigrams(texts, counts)
        # texts that meet at a batch of 200 have one more pair of gaps between them
        extra = np.zeros_like(want)
        extra[0] = counts[0] - want[0]
        assert (counts == want + extra).all() and 0 <= extra[0] <= 4
