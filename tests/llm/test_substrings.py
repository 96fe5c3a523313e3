import re

import pytest
from helpers import documents, odd_texts, prose

from slotviews.llm import substrings


def normal(unit):
    return re.sub(r"[\W_]+", " ", unit.lower()).strip()


def cut(text, separator):
    """(start, end) of the units, as positions where a unit ends are met one by one."""
    if separator == substrings.SENTENCE:
        ends = [i + 1 for i in range(len(text)) if text[i] == "\n" or text[i] == " " and i and text[i - 1] in ".!?"]
        return [p for p in zip([0, *ends], [*ends, len(text)], strict=True) if p[0] < p[1]]
    pattern = r"\n" if separator == substrings.LINE else r"\n(?:[ \t\r]*\n)+"
    at, units = 0, []
    for m in [*re.finditer(pattern, text), None]:
        units.append((at, m.start() if m else len(text)))
        at = m.end() if m else None
    return units


def expected(rows, separator, least=1, words=1):
    glue = {substrings.LINE: "\n", substrings.PARAGRAPH: "\n\n", substrings.SENTENCE: ""}[separator]
    seen, out = {}, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        units = cut(text or "", separator)
        kept, gone = [], []
        for start, end in units if text is not None else []:
            name = normal(text[start:end])
            if len(name) >= least and len(name.split(" ")) >= words and name in seen:
                gone.append((start, end, seen[name]))
            else:
                seen.setdefault(name, doc)
                kept.append(text[start:end])
        out.append((doc, glue.join(kept) if gone else text, len(units), len(gone), tuple(gone)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.text, r.n_units, r.n_removed, tuple(tuple(x) for x in r.removed)) for r in df.collect()), key=str)


TEXTS = ["One line.\nTwo\n\nThree!", "two\none LINE", "\n\n", "x\n\n\n \n\ny\n\nx", "Three\nZwei é 漢字\nzwei É 漢字", "\n".join(prose(i % 9, 3).replace("\n", " ") for i in range(700))]


@pytest.mark.parametrize("separator", [substrings.LINE, substrings.PARAGRAPH, substrings.SENTENCE])
@pytest.mark.parametrize("least, words", [(1, 1), (6, 1), (1, 3)])
def test_odd_texts(spark, separator, least, words):
    texts = [t for t in odd_texts() if t != "x" * 50_000] + TEXTS + ["One. Two! Three?  \n. . A b c. d", "x one. A b c. d. two! e", ". ", "Two! one.", "e.\nA b c."]
    rows = list(enumerate(texts))
    assert found(substrings.dedup_units(documents(spark, texts), separator, least, words)) == expected(rows, separator, least, words)


def test_a_passage_inside_other_lines_goes(spark):
    passage = " ".join(prose(i, 20).translate({10: None, 44: None, 46: None}) + "." for i in range(4))
    texts = [f"{prose(7, 9)} {passage} {prose(8, 9)}", f"{prose(9, 30)} {passage} {prose(10, 30)}", prose(11, 60)]
    rows = found(substrings.dedup_units(documents(spark, texts), substrings.SENTENCE, min_words=15))
    assert [r[3] for r in rows] == [0, 3, 0]
    assert all(texts[1][s:e] in texts[0] for s, e, _ in rows[1][4])


def test_repeated_rows_and_missing_ids(spark):
    rows = [(4, "a b\nc d"), (4, "a b\nc d"), (None, "c d\ne f"), (9, "a b")]
    got = found(substrings.dedup_units(documents(spark, [t for _, t in rows], [i for i, _ in rows])))
    assert got == [(4, "a b", 2, 1, ((4, 7, None),)), (4, "a b", 2, 1, ((4, 7, None),)), (9, "", 1, 1, ((0, 3, 4),)), (None, "c d\ne f", 2, 0, ())]


def test_empty_table_and_wrong_separator(spark):
    assert substrings.dedup_units(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        substrings.dedup_units(documents(spark, ["a"]), "x")
