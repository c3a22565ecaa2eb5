"""Repeated passages against brute force over all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from orderloom.llm import substring_dedup
from orderloom.llm.common import pick

from .cases import EDGES, documents

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window=50):
    """Removed words (by position) of each row, from the definition."""
    order = lambda i: substring_dedup.LAST if i is None else i
    texts = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, texts, strict=True):
        for k in range(len(w) - window + 1):
            part = tuple(w[k : k + window])
            least[part] = min(order(i), least.get(part, order(i)))
    out = []
    for (i, _), w in zip(rows, texts, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < order(i):
                gone |= set(range(k, k + window))
        out.append((i, w, gone))
    return out


def results(rows):
    out = []
    for i, w, gone in brute(rows):
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=60):
    """Texts that share passages of many lengths, from a small and a large vocabulary."""
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.expovariate(0.01))}"
    passages = [[word() for _ in range(rng.choice([16, 49, 50, 51, 80, 120, 300]))] for _ in range(12)]
    passages += [["ab", "cd"] * 40, ["same"] * 70]
    rows = []
    for i in rng.sample(range(10 * n), n):
        own = []
        for _ in range(rng.randint(1, 5)):
            own += [word() for _ in range(rng.choice([0, 1, 5, 60]))]
            p = rng.choice(passages)
            own += p if rng.random() < 0.6 else p[rng.randrange(len(p)) :] + p[: rng.randrange(len(p))]
        rows.append((rng.choice([i, i, i, i, None, 7]), rng.choice([" ", "\n", " \t "]).join(own)))
    return rows + rows[:5] + [(3 * n, rows[1][1]), (None, rows[2][1])]


def check(spark, rows, group):
    docs = documents(spark, rows).repartition(3)
    found = substring_dedup.digests(docs, group)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == results(rows)


@pytest.mark.parametrize(("seed", "group"), [(1, 1000), (2, 1000), (3, 2), (4, 0)])
def test_against_brute_force(spark, seed, group):
    check(spark, made(seed), group)


def test_edges(spark):
    rows = [*EDGES, (10, "word " * 400), (-3, "word " * 49), (12, "x y " * 200), (11, "x y " * 200)]
    check(spark, rows, 1000)
    empty = documents(spark, [(1, "a")]).limit(0)
    assert substring_dedup.digests(empty).count() == 0
    assert substring_dedup.deduplicate(empty).count() == 0


def test_spans_and_texts(spark):
    rows = made(7, 25)
    docs = documents(spark, rows)
    found = substring_dedup.spans(docs).collect()
    covered = [
        (str(r.doc_id), r.n_words, [k for s, e in zip(r.spans[::2], r.spans[1::2], strict=True) for k in range(s, e)])
        for r in found
    ]
    assert sorted(covered) == sorted((str(i), len(w), sorted(gone)) for i, w, gone in brute(rows))
    cut = substring_dedup.deduplicate(docs)
    assert cut.columns == docs.columns
    want = []
    for (i, t), (_, w, gone) in zip(rows, brute(rows), strict=True):
        want.append((str(i), " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t))
    assert sorted((str(r.doc_id), r.text) for r in pick(cut, "doc_id", "text").collect()) == sorted(want)


def test_every_window_lies_in_one_region():
    rng = np.random.default_rng(5)
    sizes = [10, 50, 400, 49, 0, 51, 3000]
    ends = np.cumsum(sizes)
    h = rng.integers(0, 40, sum(sizes)).astype(np.uint64)
    _, _, start, count = substring_dedup.regions(h, ends)
    windows = [k for s, n in zip(start, count, strict=True) for k in range(s, s + n)]
    want = [k for e, n in zip(ends, sizes, strict=True) for k in range(e - n, e - 49)]
    assert windows == want and max(count) <= 35


def test_equal_windows_have_equal_prefixes():
    rng = np.random.default_rng(6)
    shared = rng.integers(0, 1 << 60, 90).astype(np.uint64)
    found = []
    for before, after in ((0, 30), (17, 0), (60, 5)):
        parts = [rng.integers(0, 1 << 60, n).astype(np.uint64) for n in (before, after)]
        h = np.concatenate([parts[0], shared, parts[1]])
        a, _, start, count = substring_dedup.regions(h, np.array([len(h)]))
        by_window = {s + k - before: v for v, s, n in zip(a, start, count, strict=True) for k in range(n)}
        found.append([by_window[k] for k in range(41)])
    assert found[0] == found[1] == found[2]
