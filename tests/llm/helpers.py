"""Small documents with every odd case, and plain versions of what operators share."""

import random
import re

import duckdb

SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, block bigint, _block bigint, class string, n string"


def prose(seed: int, words: int) -> str:
    """Random words; a comma, a full stop or a line end now and then."""
    draw = random.Random(seed)
    out = []
    for _ in range(words):
        word = "".join(draw.choice("aeioubdgklmnrst") for _ in range(draw.randint(2, 8)))
        out.append(word + draw.choice(["", "", "", "", ",", ".", ".\n"]))
    return " ".join(out).replace("\n ", "\n")


def documents(spark, texts, ids=None):
    """A documents table with extra columns whose names operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), 1, 2, "x", "y") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    """Nulls, empty and blank texts, ties, repeats, a very long text, other scripts."""
    base = prose(1, 300)
    return [None, "", "  \n\t ", base, base, base + " more words here", prose(2, 3), "été ça à 漢字 仮名 🙂 ñ", prose(3, 20_000), prose(2, 3), "x" * 50_000, "a a a a a a a a a a " * 40, base[:900] + prose(4, 5) + base[900:]]


def word_sets(texts, n=5):
    out = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        if not words:
            out.append(set())
        elif len(words) < n:
            out.append({tuple(words)})
        else:
            out.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)})
    return out


def smallest_reachable(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def table_rows(name, columns="*"):
    return duckdb.sql(f"SELECT {columns} FROM '{SMALL}/{name}.parquet' ORDER BY 1").fetchall()
