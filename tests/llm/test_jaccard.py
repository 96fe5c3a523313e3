import random

import numpy as np
from helpers import documents, odd_texts, prose, smallest_reachable, table_rows, word_sets

from slotviews.llm import jaccard
from slotviews.llm.common import components


def expected(ids, texts, percent=75):
    sets = word_sets(texts)
    links = []
    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared) > 0:
                links.append((ids[i], ids[j]))
    groups = smallest_reachable(set(ids), links)
    return {i: (len(s), groups[i]) for i, s in zip(ids, sets, strict=True)}


def found(df):
    rows = df.collect()
    assert df.columns == ["doc_id", "n_shingles", "component_id", "text_hash", "first"]
    firsts = [(r.doc_id, r.n_shingles) for r in rows if r["first"]]
    assert sorted(firsts) == sorted((r.doc_id, r.n_shingles) for r in rows if r.doc_id == r.component_id)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_given_table(spark):
    rows = table_rows("documents", "doc_id, text")
    ids, texts = zip(*rows, strict=True)
    assert found(jaccard.linked_components(documents(spark, texts, ids))) == expected(ids, texts)


def test_odd_texts(spark):
    texts = odd_texts()
    assert found(jaccard.linked_components(documents(spark, texts))) == expected(range(len(texts)), texts)


def variants(count, words, edits, seed):
    """Copies of one text, each with its own edits: some link, some do only through others."""
    draw = random.Random(seed)
    base = prose(seed, words).split()
    out = [" ".join(base)]
    for i in range(count):
        copy = list(base)
        for _ in range(draw.randint(1, edits)):
            copy[draw.randrange(len(copy))] = f"edit{i}x{draw.randrange(1000)}"
        out.append(" ".join(copy))
    return out


def test_near_copies_with_a_shared_passage(spark):
    passage = prose(99, 40)
    texts = variants(60, 120, 9, 5) + variants(25, 60, 4, 6) + [passage + " " + prose(1000 + i, 50 + i) for i in range(60)]
    random.Random(3).shuffle(texts)
    assert found(jaccard.linked_components(documents(spark, texts))) == expected(range(len(texts)), texts)


def test_blocks_of_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 8)
    texts = variants(70, 90, 9, 7) + [" ".join(t.split()[: 60 + i]) for i, t in enumerate(variants(40, 100, 3, 7))]
    assert found(jaccard.linked_components(documents(spark, texts))) == expected(range(len(texts)), texts)


def test_boundary_is_included(spark):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[:32]), " ".join(words[:25]), " ".join(words[:24])]  # 28, 21 and 20 runs
    got = found(jaccard.linked_components(documents(spark, texts)))
    assert got == {0: (28, 0), 1: (21, 0), 2: (20, 0)}  # 21 of 28 is 0.75; 20 links through 21


def test_equal_and_missing_ids(spark):
    texts = [prose(1, 30), prose(1, 30), prose(2, 30), prose(1, 30)]
    rows = jaccard.linked_components(documents(spark, texts, [7, 7, None, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in rows) == [(-1, -1), (-1, 7), (7, 7), (7, 7)]


def test_empty_table(spark):
    assert jaccard.linked_components(documents(spark, [])).count() == 0


def test_bands_cover_every_pair_of_sizes():
    bounds = jaccard.bands(75)
    for n in range(1, 400):
        for m in range(n, 400 * 4 // 3):
            if 100 * n >= 75 * m:
                a, b = np.searchsorted(bounds, [n, m], "right")
                assert b - a <= 1


def test_components_of_a_chain(spark):
    order = list(range(64))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(62)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == dict.fromkeys(order[:63], min(order[:63]))
    assert components(edges.limit(0)).count() == 0


def test_first_of_a_group_with_equal_and_missing_ids(spark):
    base, other = prose(61, 60), prose(62, 60)
    texts = [base, base + " more", other, base + " most", other + " x", "", None, base]
    rows = jaccard.linked_components(documents(spark, texts, [5, 5, 5, None, None, 7, None, 5])).collect()
    firsts = [(r.doc_id, r.text_hash) for r in rows if r["first"] and r.n_shingles]
    hashes = {t: h for t, h in documents(spark, texts).selectExpr("text", "xxhash64(text)").collect()}
    assert sorted(firsts) == sorted([(5, h) for t in (min(base, base + " more", key=hashes.get), other) for h in [hashes[t]] * texts[:3].count(t)] + ([(5, hashes[base])] if hashes[base] < hashes[base + " more"] else []))
    assert sum(r["first"] for r in rows if not r.n_shingles) == 2


def test_every_link_between_different_texts(spark):
    passage = prose(98, 40)
    texts = variants(40, 90, 6, 11) + [passage + " " + prose(2000 + i, 40 + i) for i in range(10)] + [prose(2000, 9), prose(2000, 9), None, "", "a b"]
    members, links = jaccard.linked_pairs(documents(spark, texts))
    classes = {r.doc_id: r["class"] for r in members.collect()}
    sets = word_sets(texts)
    assert set(classes) == set(range(len(texts))) and all((classes[i] is None) == (not s) for i, s in enumerate(sets))
    want = {}
    for i in range(len(sets)):
        for j in range(i):
            shared, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if sets[i] and sets[i] != sets[j] and 100 * shared >= 75 * union > 0:
                want[tuple(sorted((classes[i], classes[j])))] = (shared, round(shared / union, 9))
    rows = links.collect()
    assert {(r.a, r.b): (r.shared, round(r.similarity, 9)) for r in rows} == want and len(rows) == len(want) > 40
    assert all((classes[i] == classes[j]) == (sets[i] == sets[j]) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j])


def test_links_do_not_depend_on_the_number_of_partitions(spark):
    texts, found = variants(30, 80, 5, 12), []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in (3, 50):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            found.append(sorted(tuple(r) for r in jaccard.linked_pairs(documents(spark, texts))[1].collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and found[0]


def test_intersections_of_sorted_arrays():
    draw = np.random.default_rng(4)
    own = np.unique(draw.integers(0, 60, 30))
    others = [np.unique(draw.integers(0, 90, k)) for k in (1, 5, 40, 80)]
    assert jaccard.shared_counts(own, others).tolist() == [len(np.intersect1d(own, o)) for o in others]
