"""Fingerprints: order of documents, equal texts, and agreement with generalised Jaccard."""

import hashlib
from collections import Counter

import numpy as np

from orderloom.llm import fingerprints

from .cases import EDGES, documents, sentence


def generalised_jaccard(a: str, b: str) -> float:
    x, y = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((x & y).values()) / sum((x | y).values())


def test_likeness_follows_generalised_jaccard():
    sampler = fingerprints.sampler()
    base = [f"w{k}" for k in range(300)] + ["often"] * 40 + ["twice", "twice"]
    for shared in (0, 100, 200, 300):
        other = base[:shared] + [f"v{k}" for k in range(300 - shared)] + ["often"] * 25 + ["twice"] * 5
        a, b = " ".join(base), " ".join(other)
        found = fingerprints.likeness(sampler.fingerprint(a), sampler.fingerprint(b))
        assert abs(found - generalised_jaccard(a, b)) < 0.15


def test_long_texts_without_a_common_word_are_not_alike():
    sampler = fingerprints.sampler()
    a, b = (" ".join(f"{c}{k}" for k in range(50_000)) for c in "vw")
    half = " ".join(f"v{k}" for k in range(25_000, 75_000))
    of = sampler.fingerprint(a)
    assert fingerprints.likeness(of, sampler.fingerprint(b)) < 0.03
    assert abs(fingerprints.likeness(of, sampler.fingerprint(half)) - 1 / 3) < 0.15


def test_fingerprints_do_not_depend_on_what_is_remembered():
    texts = [sentence(k, 30 * k) + f" own{k} own{k} own{k + 1}" for k in range(1, 12)]
    texts.append(" ".join(f"w{k}" for k in range(9000)) + " w3 w8000 w8000")
    small, large = fingerprints.Sampler(cached=40), fingerprints.Sampler()
    for t in texts + texts[::-1]:
        assert np.array_equal(small.fingerprint(t), large.fingerprint(t))


def test_edits_take_the_next_document(spark):
    rows = [*EDGES, *((100 + k, sentence(k, 20 + k)) for k in range(40))]
    found = fingerprints.compare_edits(documents(spark, rows).repartition(3)).collect()
    ordered = sorted((i is not None, i or 0, t or "") for i, t in rows)
    want = []
    for k, (known, i, t) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][2]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        want.append((str(i if known else None), len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in found) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    plain = {}
    for r in fingerprints.fingerprints(documents(spark, rows)).collect():
        plain.setdefault(r.doc_id, set()).add(r.fingerprint)
    for r in found:
        assert r.fingerprint in plain[r.doc_id]
    same = {r.fingerprint for r in found if r.doc_id == 1}
    assert len(same) == 1


def test_one_row_follows_itself(spark):
    r = fingerprints.compare_edits(documents(spark, [(5, "abcd efgh")])).first()
    assert (r.n_chars, r.near_next) == (9, 1.0)
    assert r.edited_sha256 == hashlib.sha256(b"abcd abcd").hexdigest()
    assert fingerprints.compare_edits(documents(spark, [(5, "x")]).limit(0)).count() == 0


def test_empty_texts_are_like_each_other_only():
    of = fingerprints.sampler().fingerprint
    assert np.array_equal(of(""), of(" \n")) and fingerprints.likeness(of(""), of("some words")) == 0


def test_edited_texts_are_sampled_like_any_other():
    draws, plain = fingerprints.Sampler(), fingerprints.Sampler(cached=64)
    texts = [sentence(k, 5 * k) + " twice twice" for k in range(12)]
    texts += ["", "x", " ", "a b", "ab", "  lead", "end  ", "x" * 99, "Größe " * 30, "one two three four", "\n1 2 3 4 5\n"]
    for a in texts:
        for b in texts:
            half = len(a) // 2
            edited = a[: len(a) - half] + b[:half]
            bags = draws.bag(a), draws.bag(b)
            for bag in bags:
                draws.sample(bag)
            bag = draws.edited(edited, len(a) - half, (a, bags[0]), (b, bags[1]))
            assert np.array_equal(bag.words, plain.bag(edited).words), (a, b)
            assert np.array_equal(draws.sample(bag, *bags), plain.fingerprint(edited)), (a, b)
