"""Prefix tries against brute force over all prefixes, in one and in many partitions."""

import hashlib
import random
import zlib

import pytest

from orderloom.llm import prefix_trie

SCHEMA = "depth string, role string, conv_id bigint, Turn string, turn bigint, text string, part string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def table(spark, rows):
    wide = [("x", role, conv, "y", turn, text, "z") for conv, turn, role, text in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(5)


def ordered(rows):
    """Turns (role, text) by conversation."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))

    def key(t):
        whole = f"{len(t[2])}:{t[2]}{t[3]}".encode()
        return (t[0], t[1], hashlib.sha256(whole).digest()[:16])

    return {c: [(t[2], t[3]) for t in sorted(ts, key=key)] for c, ts in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, ids in members.items():
        own = (len(ids) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += own
    out = []
    for p, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(p))
        up = min(members[p[:-1]]) if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ids), len(p), up, len(ids), kids[p], leaves[p], saved[p], sha))
    return sorted(out, key=str)


def random_rows(seed, n, words=3, most=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(4 * n), n):
        for t in range(rng.randint(1, most)):
            rows.append((c, t, rng.choice(["user", "bot"]), "wort " * rng.randrange(words)))
    return rows


@pytest.mark.parametrize("parts", [None, 1, 2, 7])
def test_against_brute_force(spark, parts):
    rows = random_rows(parts or 9, 120)
    rows += [(c, t, "user", "same") for c in range(5000, 5300) for t in range(12)]
    rows += [(c, t, "user", f"same {t if t < 30 else c}") for c in range(600, 606) for t in range(40)]
    found = prefix_trie.rebuilt_trie(table(spark, rows), parts)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == brute(rebuilt(ordered(rows)))


def test_as_they_are_over_many_ranges(spark):
    rows = random_rows(4, 200, words=2, most=6)
    found = prefix_trie.prefix_trie(table(spark, rows), 16).collect()
    assert sorted(map(tuple, found), key=str) == brute(ordered(rows))


def test_edges(spark):
    rows = [
        (None, 1, "user", "no conversation"),
        (1, None, None, None), (1, 2, "user", ""), (1, 2, "user", ""), (1, 3, "", "a"),
        (3, None, "", ""), (3, 1, "user", None),
        (-7, 5, "ü", "größe 😀"), (-5, 0, "ü", "größe 😀"), (-3, 0, "u" * 30_000, "t" * 50_000),
        *((8, t, "user", "long") for t in range(90)),
        *((13, t, "user", "long") for t in range(90)),
        *((c, t, "ab", "c") for c in (20, 25, 30) for t in range(2)),
        *((c, t, "a", "bc") for c in (21, 26) for t in range(2)),
    ]
    for parts in (1, 6):
        found = prefix_trie.rebuilt_trie(table(spark, rows), parts).collect()
        assert sorted(map(tuple, found), key=str) == brute(rebuilt(ordered(rows)))
    # a conversation whose own turns all give way to a missing one has none left
    alone = [(c, 0, "user", "x") for c in (2, 4) if zlib.crc32(str(c).encode()) % 9]
    found = prefix_trie.rebuilt_trie(table(spark, alone)).collect()
    assert [(r.depth, r.n_convs, r.n_leaves) for r in found] == [(0, len(alone), 1)]


def test_nothing(spark):
    assert prefix_trie.rebuilt_trie(table(spark, [(1, 1, "a", "b")]).limit(0)).count() == 0
    assert prefix_trie.rebuilt_trie(table(spark, [(None, 1, "a", "b")])).count() == 0


def test_ids_of_a_large_class_are_hashed_in_order(spark):
    rng = random.Random(2)
    ids = [rng.randrange(-(10**15), 10**15) for _ in range(3000)] + list(range(9000))
    rows = [(c, 0, "user", "hi") for c in ids]
    found = prefix_trie.prefix_trie(table(spark, rows), 3).collect()
    assert sorted(map(tuple, found), key=str) == brute(ordered(rows))


def test_common_prefixes():
    a, b = bytes(range(200))[:160], bytes(range(160))
    assert prefix_trie.shared_turns(a, b) == 10
    for n in range(10):
        other = b[: n * 16] + b"\xff" * (160 - n * 16)
        assert prefix_trie.shared_turns(b, other) == n == prefix_trie.shared_turns(other, b[: n * 16 + 16])
    assert prefix_trie.shared_turns(b"", b) == 0
