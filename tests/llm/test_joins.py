"""Operator 5 and the connected components, against brute force."""

import random
import re

import numpy as np
import pytest

from netvigil.llm import signature_join as join
from netvigil.llm.common import read_table
from netvigil.llm.components import components


def groups_of(vertices, links):
    parent = {v: v for v in vertices}

    def root(v):
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {v: root(v) for v in vertices}


def plain_set(text, words=5):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(parts) < words:
        return {tuple(parts)}
    return {tuple(parts[i:i + words]) for i in range(len(parts) - words + 1)}


def brute_force(rows, percent=75):
    sets = {i: plain_set(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b])
             >= percent * len(sets[a] | sets[b])]
    groups = groups_of(ids, links)
    return sorted((i, len(sets[i]), groups[i]) for i in ids)


def edited(words, pick, share):
    return [w if pick.random() > share else pick.choice("new other third fourth".split()) + str(pick.random()) for w in words]


@pytest.mark.parametrize("kind", ["path", "star", "pairs", "cycle", "none"])
def test_components(spark, kind):
    pick = random.Random(kind)
    names = pick.sample(range(1000), 300)
    links = {"path": list(zip(names, names[1:])), "star": [(names[0], n) for n in names[1:]],
             "pairs": list(zip(names[::2], names[1::2])), "cycle": list(zip(names, names[1:] + names[:1])),
             "none": []}[kind]
    links += links[:5] + [(b, a) for a, b in links[:7]] + [(n, n) for n in names[:3] if kind != "none"]
    got = components(spark.createDataFrame(links, "a long, b long"))
    used = {v for a, b in links for v in (a, b)}
    assert sorted(map(tuple, got.collect())) == sorted(groups_of(used, links).items())


def test_links_by_brute_force(spark):
    pick = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "one two"), (7, "é É x y z"),
            (8, "a\x0bb\x0cc\rd e"), (9, "a b c d e"), (10, "a\xa0b c d e f"), (11, "rep " * 3000), (12, "rep " * 9)]
    passage = pick.choices(vocabulary, k=50)
    for group in range(25):
        base = pick.choices(vocabulary, k=pick.randint(6, 160))
        for _ in range(pick.randint(1, 7)):
            text = edited(base, pick, pick.choice([0, 0, .01, .02, .03, .05]))
            if pick.random() < .5:
                at = pick.randint(0, len(text))
                text = text[:at] + passage + text[at:]
            rows.append((len(rows), " ".join(text[:max(1, round(len(text) * pick.uniform(.8, 1)))])))
    crowd = pick.choices(vocabulary, k=80)  # one large group of near copies, and copies of copies
    rows += [(len(rows) + i, " ".join(edited(crowd, pick, .01))) for i in range(60)]
    rows += [(len(rows) + i, rows[pick.randrange(len(rows))][1]) for i in range(40)]
    docs = spark.createDataFrame([(i, t, i, t) for i, t in rows], "doc_id long, text string, size long, token string")
    want = brute_force(rows)
    assert len({c for _, _, c in want}) < len(want)
    got = join.link_documents(docs.repartition(5)).collect()
    assert sorted(map(tuple, got)) == want
    left = join.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [i for i, _, c in want if i == c]


def test_frequent_shingles_change_nothing(spark, monkeypatch):
    pick = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(pick.choices([f"w{k}" for k in range(50)], k=pick.randint(0, 60)))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, join.link_documents(docs).collect())) == brute_force(rows)
    monkeypatch.setattr(join, "FREQUENT", 3)
    assert sorted(map(tuple, join.link_documents(docs).collect())) == brute_force(rows)


def test_rows_without_an_id_and_repeated_ids(spark):
    long = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(None, long), (7, long), (None, "alone but not linked to any row"), (9, long + " end"),
                                  (9, "x y z"), (9, "x y z"), (12, "x y z"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in join.link_documents(docs).collect()), key=str)
    assert got == sorted([(None, 26, 7), (7, 26, 7), (None, 3, None), (9, 27, 7), (9, 1, 7), (9, 1, 7), (12, 1, 7),
                          (None, 0, None)], key=str)
    assert join.link_documents(docs.limit(0)).count() == 0
    assert join.one_of_each(docs.limit(0)).count() == 0


def test_on_the_small_table(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, join.link_documents(docs).collect())) == brute_force(rows)


def test_tree_loses_no_pair():
    pick = np.random.default_rng(2)
    for _ in range(20):
        base = pick.integers(0, 2**63, 400).astype(np.uint64)
        sets = [np.unique(pick.choice(base, pick.integers(5, 390), replace=False)) for _ in range(pick.integers(2, 70))]
        groups = pick.integers(0, 12, len(sets))
        tree = join.SignatureTree(join.folded([join.bitmap_of(s) for s in sets]), np.array([len(s) for s in sets]), groups)
        found = [tuple(sorted(p)) for a, b in tree.pairs(75, block=7) for p in zip(a.tolist(), b.tolist())]
        assert len(found) == len(set(found))
        single = join.leaf_pairs(list(range(len(sets))), groups.tolist(), [len(s) for s in sets],
                                 [join.bitmap_of(s).tobytes() for s in sets], 75)
        assert set(single) == set(found)
        for i in range(len(sets)):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if groups[i] != groups[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    assert (j, i) in found


def test_ids_beyond_the_exact_range_of_doubles(spark):
    pick = random.Random(17)
    rows = []
    for group in range(20):
        base = [f"g{group}w{i}" for i in range(60)]
        rows += [(2**62 + 7 * len(rows) + k, " ".join(base + [f"end{k}"])) for k in (1, 2, 3)]
    pick.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_force(rows)
    assert len({c for _, _, c in want}) == 20
    assert sorted(map(tuple, join.link_documents(docs).collect())) == want


def test_rounds_lose_no_link(spark, monkeypatch):
    """Many texts near the limit that share a passage: some link, most do not, and their cells are large."""
    monkeypatch.setattr(join, "GROWTH", 6)
    monkeypatch.setattr(join, "NEIGHBOURS", 2)
    pick = random.Random(23)
    passage = [f"p{i}" for i in range(70)]
    rows = [(i, " ".join(passage[: pick.randint(60, 70)] + pick.choices([f"w{k}" for k in range(9)], k=pick.randint(4, 22)))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_force(rows)
    assert 10 < len({c for _, _, c in want}) < 80
    assert sorted(map(tuple, join.link_documents(docs).collect())) == want


def test_candidates_of_near_copies_grow_with_their_number(spark, monkeypatch):
    """Texts near the limit of one another, in one component: all pairs would be 180,000."""
    counted = []
    verify = join.verified
    monkeypatch.setattr(join, "verified", lambda pairs, *rest: (counted.append(pairs.count()), verify(pairs, *rest))[1])
    pick, n = random.Random(600), 600
    rows = []
    for i in range(n):
        text = [f"w{k}" for k in range(120)]
        for at in pick.sample(range(120), 2):
            text[at] = f"x{i}y{at}"
        rows.append((i, " ".join(text)))
    found = join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r.component_id for r in found}) == 1
    assert sum(counted) < 40 * n, counted


def test_candidates_of_texts_below_the_limit(spark, monkeypatch):
    """A group of edited copies, of which most share half of their shingles or somewhat more, and few link."""
    counted = []
    candidates = join.candidate_pairs
    monkeypatch.setattr(join, "candidate_pairs", lambda *given: (lambda found: (counted.append(found.count()), found)[1])(candidates(*given)))
    pick, n = random.Random(5), 300
    rows = []
    for i in range(n):
        text = [f"w{k}" for k in range(146)]
        for at in pick.sample(range(146), 5 if i % 10 else 3):
            text[at] = f"x{i}y{at}"
        rows.append((i, " ".join(text)))
    want = brute_force(rows)
    assert len({c for _, _, c in want}) > 20
    assert sorted(map(tuple, join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == want
    assert sum(counted) < 4 * n, counted


def test_spare_cells_leave_each_pair_one(spark):
    """Whatever two documents share enough of, the large cells that stay have one of them or the small cells do."""
    pick = random.Random(31)
    cells = {t: pick.sample(range(60), pick.choice([3, 9, 20, 30, 40])) for t in range(40)}
    rows = [(t, 0, d, d, 200 + 50 * (d % 2), 0, len(docs), 1 + t % 2) for t, docs in cells.items() for d in docs]
    schema = "token long, zone int, doc_id long, component long, size long, visitor int, documents long, weight long"
    left = {(r.token, r.doc_id) for r in join.without_spare_cells(spark.createDataFrame(rows, schema), 75).collect()}
    large = {(t, d) for t, docs in cells.items() for d in docs if len(docs) > join.LEAF}
    assert left < large
    for a in range(60):
        for b in range(a):
            common = [t for t, docs in cells.items() if a in docs and b in docs]
            needed = join.common_least(200 + 50 * min(a % 2, b % 2))
            small = sum(1 + t % 2 for t in common if len(cells[t]) <= join.LEAF)
            if small < needed <= sum(1 + t % 2 for t in common):
                assert any((t, a) in left and (t, b) in left for t in common)
