import numpy as np
import pytest
from helpers import documents, odd_texts, prose

from slotviews.llm import packing
from slotviews.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    own.encode_special_tokens = True
    return own


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


TRICKY = ["", " ", "  a", "a  b", "a \n b", "\n", "a\n b", "a b\n", "<|endoftext|> x <|endoftext|>", "it's 'tis  I'll", "é b　c d", "a b ", " a", "\x1c b", "日本 語1２ ½", "\ta \t b", "a  b \u0085 c"]


def test_encoder_agrees_with_the_tokenizer(tokenizer):
    encoder = packing.Encoder(tokenizer_path())
    for text in TRICKY + [t for t in odd_texts() if t]:
        assert encoder.encode(text) == np.array(ids_of(tokenizer, text), "<u4").tobytes(), text[:50]


MARKED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", "a<|endoftext|>b  c\n", "<|endoftext", "a <|ENDOFTEXT|> b", prose(4, 40) + " <|endoftext|> " + prose(5, 40)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_as_in_the_tokenizers_own_call(spark, name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path(name))
    own = Tokenizer.from_file(path)  # untouched
    texts = MARKED + TRICKY + [t for t in odd_texts() if t]
    want = [own.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = packing.Encoder(path, added=True)
    assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in texts] == want
    rows = packing.pack(documents(spark, texts), path, 128).collect()
    for doc, ids in enumerate(want):
        pieces = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        assert [x for r in pieces for x in np.frombuffer(r.ids, "<u4").tolist()] == [*ids, 1]
    if name == "byte_bpe_50k.json":
        assert want[0] == [64, 220, 50256, 275]


def test_encoder_forgets(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder = packing.Encoder(tokenizer_path())
    text = prose(3, 200)
    assert encoder.encode(text) == np.array(ids_of(tokenizer, text), "<u4").tobytes()


@pytest.mark.parametrize("other", ["word_bpe_49k.json"])
def test_other_kinds_of_tokenizers(other):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path(other))
    text = "It's a  test, of the\nEncoder."
    assert packing.Encoder(path).encode(text) == np.array(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_round_trip(spark, tokenizer):
    texts = odd_texts() + [prose(100 + i, 10 + 7 * i) for i in range(60)]
    window = 128
    rows = packing.pack(documents(spark, texts).repartition(3), tokenizer_path(), window).collect()
    for doc, text in enumerate(texts):
        pieces = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.start)
        ids = [x for r in pieces for x in np.frombuffer(r.ids, "<u4").tolist()]
        assert ids == ids_of(tokenizer, text) + [1]
        assert {r.doc_tokens for r in pieces} == {len(ids)}
        assert [r.start for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    fills = []
    for own in windows.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist()
        fills.append(sum(n for _, n in own))
    assert max(fills) <= window
    assert sum(f < window for f in fills) <= 3  # one for each task


def test_equal_ids_and_empty_table(spark):
    rows = packing.pack(documents(spark, ["a b", "a b", None], [4, 4, None]), tokenizer_path(), 16).collect()
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in rows) == [(-1, 1), (4, 3), (4, 3)]
    assert packing.pack(documents(spark, []), tokenizer_path()).count() == 0


def test_rule_minimises_the_sum_of_squares():
    window, draw = 12, np.random.default_rng(2)
    levels, plain = packing.Levels(window, 0), np.zeros(window + 1, int)
    for size in draw.integers(1, window, 400).tolist():
        options = []
        for level in range(window - size + 1):
            if level and not plain[level]:
                continue
            after = plain.copy()
            after[level] -= level > 0
            after[level + size] += level + size < window
            options.append((int((after[1:window] ** 2).sum()), -level, after))
        full = levels.place((0, 0, bytes(4 * size), size))
        best = min(options, key=lambda o: o[:2])
        plain = best[2]
        assert levels.count[1:window].tolist() == plain[1:window].tolist()
        assert (full is not None) == (-best[1] + size == window)
        assert levels.size == plain[1:window].sum()
