from helpers import prose

from slotviews.llm import chat

TURNS = "pair_id bigint, turn bigint, role string, text string, pos string, part string, side string"


def rendered(turn):
    return f"<|{turn[1] or ''}|>\n{turn[2] or ''}<|end|>\n"


def expected(chosen, rejected):
    out = []
    for pair in {r[0] for r in chosen + rejected}:
        key = lambda r: [(v is not None, v) for v in r]
        a, b = ([r[1:] for r in sorted((r for r in side if r[0] == pair), key=key)] for side in (chosen, rejected))
        shared = 0
        while shared < min(len(a), len(b)) and a[shared][1:] == b[shared][1:]:
            shared += 1
        masks = []
        for side in (a, b):
            at, spans = 0, []
            for turn in side[shared:]:
                head = len(f"<|{turn[1] or ''}|>\n")
                if turn[1] == "assistant":
                    spans.append(f"{at + head}:{at + len(rendered(turn)) - 1}")
                at += len(rendered(turn))
            masks.append(",".join(spans))
        texts = ["".join(map(rendered, part)) for part in (a[:shared], a[shared:], b[shared:])]
        out.append((pair, *texts, *masks, shared, len(a) - shared, len(b) - shared))
    return sorted(out, key=str)


def run(spark, chosen, rejected):
    frames = [spark.createDataFrame([(*r, "x", "y", "z") for r in side], TURNS) for side in (chosen, rejected)]
    return sorted((tuple(r) for r in chat.preference_pairs(*frames).collect()), key=str)


CHOSEN = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "é🙂"), (1, 3, "assistant", "yes"), (1, 4, "assistant", ""),
    (2, 0, "user", "same"), (2, 1, "assistant", "same"),
    (3, 0, "system", None), (3, 5, None, "x"), (3, None, "user", "first"),
    (4, 0, "user", "tie"), (4, 0, "user", "tie"), (4, 0, "assistant", "tie"),
    (5, 0, "user", "only chosen"), (None, 0, "user", "no id"), (7, 0, "user", prose(1, 5000)),
]
REJECTED = [
    (1, 0, "user", "hi"), (1, 7, "assistant", "hello"), (1, 8, "user", "é🙂"), (1, 9, "assistant", "no"),
    (2, 0, "user", "same"), (2, 1, "assistant", "same"),
    (3, 0, "system", None), (3, 5, None, "y"), (3, None, "user", "first"),
    (4, 0, "user", "tie"), (4, 0, "assistant", "tie"), (4, 1, "user", "tie"),
    (6, 0, "assistant", "only rejected"), (None, 0, "user", "no id"), (7, 0, "user", prose(1, 5000)), (7, 1, "assistant", "more"),
]


def test_pairs(spark):
    assert run(spark, CHOSEN, REJECTED) == expected(CHOSEN, REJECTED)


def test_null_and_empty_text_differ(spark):
    a, b = [(1, 0, "user", None), (1, 1, "user", "x")], [(1, 0, "user", ""), (1, 1, "user", "x")]
    assert run(spark, a, b)[0][6] == 0


def test_empty(spark):
    assert run(spark, [], []) == []
