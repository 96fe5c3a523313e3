import re
from collections import Counter

import numpy as np
from helpers import documents, odd_texts, prose, table_rows

from slotviews.llm import decontam


def bag(words):
    if not words:
        return Counter()
    return Counter([tuple(words)] if len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def words_of(text):
    return re.findall(rb"[a-z0-9\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))


def share(a, b):
    weight = lambda s: sum(map(len, s))
    either = sum(weight(s) * n for s, n in (a | b).items())
    return sum(weight(s) * n for s, n in (a & b).items()) / either if either else 0


def expected(texts, items):
    out = {}
    for doc, text in enumerate(texts):
        words = words_of(text)
        whole = set(bag(words)) | {tuple(words)}
        for item, content in items:
            own = words_of(content)
            mine = bag(own)
            if not own or not (set(mine) & whole):
                continue
            size = min(len(own), len(words))
            best = max(share(mine, bag(words[i : i + size])) for i in range(len(words) - size + 1))
            if best >= 0.75:
                out[doc, item] = best
    return out


def found(spark, texts, items):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    return {(r.doc_id, r.item_id): r for r in decontam.benchmark_hits(documents(spark, texts), bench).collect()}


def planted():
    items = [(i, prose(500 + i, 12 + 3 * i)) for i in range(15)] + [(50, "three short words"), (51, None), (52, ""), (53, prose(500, 12))]
    texts = odd_texts()
    for i, (_, text) in enumerate(items[:15]):
        words = text.split()
        texts += [prose(i, 40) + " " + text.upper() + " " + prose(i + 1, 40), text]
        swapped = list(words)
        swapped[len(words) // 2] = "changed"
        texts.append(prose(i, 9) + " " + " ".join(swapped) + " " + prose(i + 5, 30))
        texts.append(prose(i, 9) + " " + " ".join(words[: len(words) // 2]) + " " + prose(i + 5, 30))
    return [*texts, "Three, short words!", "has three short words inside"], items


def test_planted_passages(spark):
    texts, items = planted()
    got, want = found(spark, texts, items), expected(texts, items)
    assert {k: round(v, 9) for k, v in want.items()} == {k: round(r.similarity, 9) for k, r in got.items()}
    for (doc, item), r in got.items():
        window = words_of(texts[doc][r.start : r.end])
        assert abs(share(bag(window), bag(words_of(dict(items)[item]))) - r.similarity) < 1e-9 and r.distance <= decontam.RADIUS


def test_given_tables(spark):
    docs, items = table_rows("documents", "doc_id, text"), table_rows("benchmark", "item_id, text")
    texts = [t for _, t in docs]
    got = found(spark, texts, items)
    assert set(got) == set(expected(texts, items)) and got


def test_several_passes(spark, monkeypatch):
    texts, items = planted()
    whole = set(found(spark, texts, items))
    monkeypatch.setattr(decontam, "ITEM_BYTES", 700)
    assert set(found(spark, texts, items)) == whole


def test_one_long_token_swapped(spark):
    items, texts = [], []
    for n in range(40):
        own = prose(700 + n, 304).split()
        for size in range(245, 150, -2):  # the longest token that keeps 0.75
            own[150] = "".join(chr(97 + (n + i * i) % 26) for i in range(size)) + "end"
            other = own[:150] + [own[150][::-1]] + own[151:]
            if share(bag(words_of(" ".join(own))), bag(words_of(" ".join(other)))) >= 0.75:
                break
        items.append((n, " ".join(own)))
        texts.append(prose(n, 15) + " " + " ".join(other) + " " + prose(n + 3, 15))
    want = expected(texts, items)
    assert len(want) == 40
    assert set(found(spark, texts, items)) == set(want)


def test_a_repeated_shingle_swapped(spark):
    items, texts = [], []
    for n in range(20):
        own = prose(900 + n, 400).split()
        items.append((n, " ".join(own[:200] + ["over"] * 55 + own[200:])))
        texts.append(" ".join(own[:200] + ["again"] * 55 + own[200:]) + " " + prose(n, 9))
    want = expected(texts, items)
    assert len(want) == 20
    assert set(found(spark, texts, items)) == set(want)


def test_windows_are_sums_over_bags():
    random = np.random.default_rng(3)
    for size in (1, 4, 20, 60):
        grams = random.integers(0, 9, 60).astype(np.uint64)
        weights = (grams * 7 + 3).astype(np.int64)
        sums = decontam.windows(grams, weights, size)
        assert len(sums) == 60 - size + 1
        for i, own in enumerate(sums):
            part = slice(i, i + size)
            assert (own == decontam.windows(grams[part], weights[part], size)[0]).all()
            mixed = random.permutation(size)
            assert (own == decontam.windows(grams[part][mixed], weights[part][mixed], size)[0]).all()


def test_short_items_in_longer_texts(spark):
    items = [(1, "three short words"), (2, "one"), (3, prose(1, 20)), (4, "Three SHORT, words!")]
    texts = ["has three short words inside, three short words", "three short words", "One of three", "three short", None, "x " + prose(1, 20) + " one"]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontam.benchmark_hits(documents(spark, texts), bench, short_items=True).collect()
    got = {(r.doc_id, r.item_id): (r.similarity, texts[r.doc_id][r.start : r.end].lower()) for r in rows}
    assert len(got) == len(rows)
    assert set(got) == {(0, 1), (0, 4), (1, 1), (1, 4), (2, 2), (5, 2), (5, 3)}
    assert got[0, 1] == (1.0, "three short words") and got[2, 2] == (1.0, "one")


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")]) == {} and found(spark, ["a b"], []) == {}


def test_blocks_find_everything_within_the_radius():
    random = np.random.default_rng(1)
    items = decontam.Items(list(range(40)), [prose(i, 20) for i in range(40)], 5)
    for length, table in items.tables.items():
        own = np.flatnonzero(items.length == length)
        assert len(table) == decontam.BLOCKS
        flipped = []
        for i in own:
            bits = np.unpackbits(items.hashes[i])
            bits[random.choice(64, decontam.RADIUS, replace=False)] ^= 1
            flipped.append(np.packbits(bits))
        near = {window: set(found.tolist()) for window, found, _ in items.near(length, np.array(flipped))}
        assert all(i in near[n] for n, i in enumerate(own))
