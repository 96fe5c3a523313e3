import numpy as np
import pytest
from helpers import documents, odd_texts, prose, table_rows

from slotviews.llm import suffixes


def expected(rows, length):
    """Removed ranges by brute force over every window."""
    seen, out = {}, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        gone, own = bytearray(len(data)), set()
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in own or seen.get(window, doc) != doc:
                gone[p : p + length] = b"\x01" * length
            own.add(window)
            seen.setdefault(window, doc)
        edges = np.flatnonzero(np.diff(np.frombuffer(b"\0" + bytes(gone) + b"\0", np.int8)))
        ranges = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        kept = bytes(c for c, x in zip(data, gone, strict=True) if not x)
        out.append((doc, tuple(ranges), kept))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, tuple(tuple(x) for x in r.removed), bytes(r.kept)) for r in suffixes.kept_bytes(df).collect()), key=str)


@pytest.mark.parametrize("length", [100, 40, 300])
def test_odd_texts(spark, length):
    texts = [t if t is None or len(t) < 9000 else t[:9000] for t in odd_texts()]
    assert found(suffixes.earlier_strings(documents(spark, texts), length)) == expected(list(enumerate(texts)), length)


def test_given_table(spark):
    rows = [(i, t) for i, t in table_rows("documents", "doc_id, text")]
    ids, texts = zip(*rows, strict=True)
    assert found(suffixes.earlier_strings(documents(spark, texts, ids).repartition(5))) == expected(rows, 100)


def test_passages_at_every_offset(spark):
    passage = prose(5, 60)
    texts = [prose(i, 20) + passage[i % 7 : len(passage) - i % 11] + prose(100 + i, 20) for i in range(40)]
    texts += [passage[:99], passage[:100], passage[:101], "ab" * 300, "é" * 120 + passage]
    assert found(suffixes.earlier_strings(documents(spark, texts))) == expected(list(enumerate(texts)), 100)


def test_equal_and_missing_ids(spark):
    text = prose(1, 60)
    rows = [(3, text), (3, text), (3, "x " + text), (None, text), (9, text)]
    got = found(suffixes.earlier_strings(documents(spark, [t for _, t in rows], [i for i, _ in rows])))
    assert [(i, bool(r)) for i, r, _ in got] == [(3, True), (3, True), (3, True), (9, True), (None, False)]


@pytest.mark.parametrize("copies", [2, 3])
def test_equal_rows_keep_what_one_would(spark, copies):
    passage, own = prose(5, 60), [prose(20 + i, 40) for i in range(4)]
    twice = own[0] + passage + own[1]
    rows = [(1, own[2] + passage + own[3])] + [(3, twice)] * copies + [(3, own[2] + passage + own[1]), (4, own[0])]
    ids, texts = zip(*rows, strict=True)
    got = found(suffixes.earlier_strings(documents(spark, texts, ids)))
    assert got == expected(rows, 100)
    kept = [k for i, _, k in got if i == 3 and own[0].encode() in k]
    assert len(kept) == copies and all(own[1].encode()[100:] in k for k in kept)


def test_empty_table(spark):
    assert suffixes.earlier_strings(documents(spark, [])).count() == 0


def test_family_agrees_with_a_dictionary():
    random = np.random.default_rng(4)
    family, least = suffixes.Family(), {}
    for _ in range(30):
        keys, docs = random.integers(0, 300, 40).astype(np.uint64), random.integers(0, 1000, 40)
        for k, d in zip(keys.tolist(), docs.tolist(), strict=True):
            least[k] = min(least.get(k, d), d)
        assert family.add(keys, docs).tolist() == [least[k] for k in keys.tolist()]
    sizes = [len(k) for k, _ in family.levels]
    assert sizes == sorted(sizes, reverse=True)
