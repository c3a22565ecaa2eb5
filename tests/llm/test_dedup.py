"""Line and near-duplicate removal against brute force."""

import random
import re

import pytest

from orderloom.llm import line_dedup, near_dedup

from .cases import EDGES, WORDS, documents, sentence


def line_sets(rows):
    """((doc order, line), token set) in order; rows of one id and text share places."""
    seen = {}
    for i, t in rows:
        for k, line in enumerate((t or "").split("\n")):
            tokens = frozenset(x for x in re.split(r"[ \t\r\f\x0b]+", line.lower()) if x)
            if t and tokens:
                seen[(i is not None, i or 0, t, k)] = tokens
    return seen


def varied(seed: int, n: int) -> list[tuple]:
    pick = random.Random(seed)
    base = [pick.choices(WORDS, k=pick.randint(1, 16)) for _ in range(12)]
    base = [[w + str(pick.randint(0, 30)) for w in b] for b in base]
    out = []
    for i in range(n):
        lines = []
        for _ in range(pick.randint(0, 5)):
            line = list(pick.choice(base))
            for _ in range(pick.choice((0, 0, 1, 1, 2, 4))):
                line[pick.randrange(len(line))] = pick.choice(WORDS) + str(pick.randint(0, 30))
            lines.append(" ".join(line))
        out.append((i * 7 % n, "\n".join(lines)))
    return out


def test_lines_equal_brute_force(spark):
    rows = varied(3, 60)
    found = {
        (r.doc_id, r.line_no): r for r in line_dedup.line_matches(documents(spark, rows).repartition(3)).collect()
    }
    ordered = sorted(line_sets(rows).items())
    firsts = {}
    removed = 0
    for n, ((_, i, _, k), own) in enumerate(ordered):
        want = any(5 * len(own & o) >= 4 * len(own | o) for _, o in ordered[:n])
        first = firsts.setdefault(own, (i, k))
        r = found[i, k]
        assert (r.removed, r.class_doc, r.class_line) == (want, *first)
        removed += want
    assert len(found) == len(ordered) and 20 < removed < len(ordered)


def test_links_of_classes_equal_brute_force(spark):
    # a group of like lines, in which one earlier match settles a line, among others
    base = [f"w{k}" for k in range(20)]
    near = [(1000 + i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]])) for i in range(20)]
    rows = varied(3, 60) + near + [(2000, near[4][1].upper())]
    found = line_dedup.line_matches(documents(spark, rows).repartition(3)).collect()
    sets = {(i, k): own for (_, i, _, k), own in line_sets(rows).items()}
    distinct = set(sets.values())
    links = {own: sum(own != o and 5 * len(own & o) >= 4 * len(own | o) for o in distinct) for own in distinct}
    assert {(r.doc_id, r.line_no): r.n_links for r in found} == {place: links[own] for place, own in sets.items()}
    assert max(links.values()) == 19
    assert len({(r.class_id, sets[r.doc_id, r.line_no]) for r in found}) == len({r.class_id for r in found}) == len(distinct)


def test_texts_keep_first_lines_and_blank_ones(spark):
    rows = varied(9, 40) + [(100, "\nfirst line here\n\nfirst  LINE here\n"), (100, None), (101, ""), (None, "alone once")]
    out = line_dedup.deduplicate_lines(documents(spark, rows))
    assert out.columns == documents(spark, rows).columns
    got = sorted((r[1] is not None, r[1] or 0, r[3] or "") for r in out.collect())
    ordered = sorted(line_sets(rows).items())
    gone = {
        place for n, (place, own) in enumerate(ordered) if any(5 * len(own & o) >= 4 * len(own | o) for _, o in ordered[:n])
    }
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for k, x in enumerate(lines) if (i is not None, i or 0, t, k) not in gone]
        want.append((i is not None, i or 0, "\n".join(kept)))
    assert got == sorted(want)


def test_texts_without_id_keep_lines_of_their_own(spark):
    # so many that some share 16 bits of a hash
    alone = [f"only{i} text{i} alone{i}" for i in range(1500)]
    common = [f"the line of many\nend{i} of{i} it{i}" for i in range(1500)]
    out = line_dedup.deduplicate_lines(documents(spark, [(None, t) for t in alone + common]))
    got = [r[3] for r in out.collect()]
    assert sum(t.startswith("the line of many\n") for t in got) == 1
    assert sorted(t.removeprefix("the line of many\n") for t in got) == sorted(alone + [t.split("\n")[1] for t in common])


def test_lines_stand_edge_cases(spark):
    docs = documents(spark, EDGES)
    assert line_dedup.deduplicate_lines(docs).count() == len(EDGES)
    assert line_dedup.line_matches(docs).where("doc_id = 6").count() == 1
    assert line_dedup.deduplicate_lines(docs.limit(0)).count() == 0
    assert line_dedup.line_matches(docs.limit(0)).count() == 0


def test_plan_has_no_python_and_no_cross_join(spark):
    df = line_dedup.line_matches(documents(spark, varied(3, 10)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def shingle_sets(rows, size):
    out = {}
    for n, (i, t) in enumerate(rows):
        words = (t or "").encode().lower().split()
        sets = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        out[n] = (i, sets)
    return out


def near_rows(seed: int, n: int) -> list[tuple]:
    pick = random.Random(seed)
    base = [[pick.choice(WORDS) + str(pick.randint(0, 99)) for _ in range(pick.choice((3, 20, 60)))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(pick.choice(base))
        for _ in range(pick.choice((0, 0, 1, 1, 2, 3))):
            words[pick.randrange(len(words))] = "new" + str(pick.randint(0, 9999))
        rows.append((i * 7 % n, " ".join(words)))
    return rows


def components_of(rows, size=4):
    sets, parent = shingle_sets(rows, size), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            (ia, sa), (ib, sb) = sets[a], sets[b]
            alike = sa and sb and 100 * len(sa & sb) >= 80 * len(sa | sb)
            if alike or (ia is not None and ia == ib and sa and sb):
                parent[find(a)] = find(b)
    groups = {}
    for n in sets:
        groups.setdefault(find(n), []).append(n)
    return sets, {n: g for g in groups.values() for n in g}


@pytest.mark.parametrize(("seed", "large"), [(1, 32), (2, 1)])
def test_near_duplicates_equal_brute_force(spark, seed, large, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    rows = near_rows(seed, 120)
    sets, group = components_of(rows)
    found = {r.doc_id: r for r in near_dedup.near_duplicates(documents(spark, rows).repartition(3), large=large).collect()}
    for n, (i, own) in sets.items():
        component = min(rows[m][0] for m in group[n])
        r = found[i]
        assert (r.n_shingles, r.component_id, r.kept) == (len(own), component, i == component)


def test_near_duplicates_stand_edge_cases(spark):
    rows = [*EDGES, (20, "alpha beta gamma"), (21, "Alpha  beta\tGAMMA"), (22, "alpha beta"), (9, "alpha beta")]
    docs = documents(spark, rows)
    found = {}
    for r in near_dedup.near_duplicates(docs).collect():
        found.setdefault(r.doc_id, []).append((r.component_id, r.kept, r.n_shingles))
    assert found[1] == [(1, True, found[1][0][2])] * 2
    assert found[2] == [(2, True, 0)] and found[3] == [(3, True, 0)] and found[4] == [(4, True, 0)]
    assert found[20] == [(20, True, 1)] and found[21] == [(20, False, 1)]
    # three texts of one id are one document, which "alpha beta" belongs to
    assert {c for c, _, _ in found[9]} == {9} and found[22] == [(9, False, 1)]
    nulls = sorted(map(str, found[None]))
    assert nulls == sorted(map(str, [(1, False, found[1][0][2]), (None, True, 2), (None, True, 0)]))
    kept = near_dedup.deduplicate(docs, shingle=4)
    assert kept.columns == docs.columns
    ids = [r[1] for r in kept.collect()]
    # unlike texts of one id all stay
    assert sorted(i for i in ids if i is not None) == [-8, 1, 2, 3, 4, 5, 6, 7, 9, 9, 9, 20]
    assert ids.count(None) == 2
    assert near_dedup.deduplicate(docs.limit(0)).count() == 0
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("large", [32, 1])
def test_one_row_of_each_component_stays(spark, large, monkeypatch):
    """Rows of few ids and without ids, unlike texts of one id among them, against brute force."""
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    pick = random.Random(5)
    rows = [(pick.choice((None, i % 9, i)), t) for i, t in near_rows(7, 110)]
    rows += [rows[3], rows[3], (None, ""), (4, None), (4, " "), (4, " ")]
    sets = {n: own for n, (_, own) in shingle_sets(rows, 5).items()}
    group = {n: n for n in sets}
    for a in sets:
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = {n: new if g == old else g for n, g in group.items()}
    kept = [(r[1], r[3]) for r in near_dedup.deduplicate(documents(spark, rows).repartition(3), large=large).collect()]
    of_text = {t: g for (_, t), g in zip(rows, group.values(), strict=True)}
    found = sorted(of_text[t] for _, t in kept if (t or "").strip())
    wanted = sorted({g for n, g in group.items() if sets[n]})
    assert found == wanted and len(wanted) > 12
    for i, t in kept:
        if (t or "").strip():
            ids = [j for n, (j, _) in enumerate(rows) if group[n] == of_text[t] and j is not None]
            assert (i, t) in rows and i == (min(ids) if ids else None)
    assert sum(not (t or "").strip() for _, t in kept) == 4


def test_near_copies_without_ids_are_found(spark):
    words = [f"w{k}" for k in range(200)]
    rows = [(None, " ".join(words)), (None, " ".join([*words[:90], "other", *words[91:]])), (None, "unlike")]
    kept = near_dedup.deduplicate(documents(spark, rows)).collect()
    assert len(kept) == 2 and "unlike" in [r[3] for r in kept]


def test_every_coordinate_of_a_sketch_fills():
    shingler = near_dedup.Shingler(4)
    sets = [shingler.of(sentence(k, n)) for k, n in ((1, 1), (2, 5), (3, 60), (4, 2000))]
    rows = near_dedup.sketches(sets)
    assert rows.shape == (4, near_dedup.COORDINATES) and not (rows == near_dedup.EMPTY).any()


def test_sketches_estimate_similarity():
    shingler = near_dedup.Shingler(1)
    a = shingler.of(" ".join(f"w{k}" for k in range(2000)))
    b = shingler.of(" ".join(f"w{k}" for k in range(500, 2500)))
    x, y = near_dedup.sketches([a, b])
    assert abs((x == y).mean() - 0.6) < 0.15


def test_removal_lists_no_more_links_than_lines(spark, monkeypatch):
    # groups so small that each line has a salt of its own, as a rule
    rows = []
    for g in range(12):
        base = [f"g{g}w{k}" for k in range(30)]
        for i in range(12):
            rows.append((g * 100 + i, " ".join([*base[:i], f"g{g}new{i}", *base[i + 1 :]])))
    made, verified = [], line_dedup._verified

    def counted(*args):
        found = verified(*args).cache()
        made.append(found.count())
        return found

    monkeypatch.setattr(line_dedup, "_verified", counted)
    out = line_dedup.deduplicate_lines(documents(spark, rows))
    assert sorted(r[1] for r in out.collect() if r[3]) == [g * 100 for g in range(12)]
    assert sum(made) <= len(rows)


def long_group(seed: int, n: int, size: int, most: int) -> list[str]:
    """Near copies of one line of `size` tokens, each with at most `most` of its own."""
    pick = random.Random(seed)
    base = [f"g{seed}w{k}" for k in range(size)]
    lines = []
    for i in range(n):
        line = list(base)
        for k in pick.sample(range(size), pick.randint(0, most)):
            line[k] = f"g{seed}own{pick.randint(0, 5 * size)}"
        lines.append(" ".join(line))
    return lines


def test_long_lines_equal_brute_force(spark):
    # sizes with 64, 128 and 256 parity bits, and some in between
    texts = [t for size in (60, 66, 72, 120, 132, 150, 260) for t in long_group(size, 7, size, size // 7)]
    texts += [" ".join(t.split()[:k]) for t in texts[::9] for k in (55, 62, 64, 65, 110, 128, 129)]
    rows = list(enumerate(texts))
    sets = [set(t.split()) for t in texts]
    match = [[5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets]
    found = {r.doc_id: r for r in line_dedup.line_matches(documents(spark, rows)).collect()}
    for i, own in enumerate(sets):
        assert found[i].removed == any(match[i][:i])
        assert found[i].n_links == len({frozenset(o) for o, m in zip(sets, match[i], strict=True) if m and o != own})
    left = {r[1] for r in line_dedup.deduplicate_lines(documents(spark, rows)).collect() if r[3]}
    assert left == {i for i in range(len(rows)) if not any(match[i][:i])}
    assert 10 < len(left) < len(rows) - 30


def test_large_group_is_settled_without_its_pairs(spark, monkeypatch):
    texts = [t for seed in (1, 2) for t in long_group(seed, 200, 60, 4)]
    seen, likeliest = [], line_dedup._likeliest

    def counted(pairs):
        seen.append(pairs.count())
        return likeliest(pairs)

    monkeypatch.setattr(line_dedup, "_likeliest", counted)
    out = line_dedup.deduplicate_lines(documents(spark, list(enumerate(texts))))
    sets = [set(t.split()) for t in texts]
    alone = [i for i, a in enumerate(sets) if not any(5 * len(a & b) >= 4 * len(a | b) for b in sets[:i])]
    assert sorted(r[1] for r in out.collect() if r[3]) == alone
    # of 40,000 pairs
    assert sum(seen) < 12 * len(texts)
