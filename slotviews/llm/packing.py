"""Sum-of-squares packing of tokenised documents into fixed windows."""

from __future__ import annotations

import json
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: open windows a task keeps at most before it closes them all, cutting pieces to fit
#: a task that holds more open windows closes them all, as its memory is bounded
OPEN_WINDOWS = 4096
#: words a worker remembers the ids of
REMEMBERED = 1_000_000

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


#: how byte-level vocabularies write bytes: printable ones as they are, the rest from 256 on
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _SHOWN} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder(dict):
    """Ids of a text as little-endian 32-bit integers, the same as the tokenizer's.

    With ``added`` they are those of the tokenizer as its file has it: a text that holds
    the string of an added token goes whole through the untouched tokenizer. Without, as
    with the tokenizer's ``encode_special_tokens``, strings of special tokens are text.
    A byte-level tokenizer starts a new piece at every single space between two other
    characters, so a text can be cut there and the ids of its parts be remembered. Texts
    with white space beside a space are encoded whole. Where the vocabulary's ids follow
    its merges, the parts go through the faster of the two libraries for such files. For
    any other kind of file, whole texts go through the tokenizer itself.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = not added
        self.ids = self.untouched = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # other added tokens than special ones are never text
        self.added = [t["content"] for t in spec.get("added_tokens") or () if t["content"] and (added or not t.get("special"))]
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        self.cuts = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec.get("normalizer") and model["type"] == "BPE" and plain
        if self.cuts:
            pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
            merged = [model["vocab"][a + b] for a, b in pairs]
            special = {t["content"] for t in spec.get("added_tokens") or ()}
            words = {w: i for w, i in model["vocab"].items() if w not in special}
            if merged == sorted(merged) and len(words) == len(merged) + 256 and max(words.values()) == len(words) - 1:
                import tiktoken

                ranks = {bytes(_BYTE_OF[c] for c in w): i for w, i in words.items()}
                self.ids = tiktoken.Encoding("own", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def whole(self, text: str) -> bytes:
        return array("I", self.ids(text)).tobytes()

    def __missing__(self, word: str) -> bytes | None:
        if len(self) > REMEMBERED:
            self.clear()
        fits = word and not word[0].isspace() and not word[-1].isspace()
        self[word] = ids = self.whole(" " + word) if fits else None
        return ids

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return array("I", self.untouched(text)).tobytes()
        first, *rest = text.split(" ") if self.cuts else [text]
        if not rest or first and first[-1].isspace() or not rest[-1] or rest[-1][0].isspace():
            return self.whole(text)
        last = rest.pop()
        try:
            middle = b"".join(map(self.__getitem__, rest))
        except TypeError:  # a part that white space borders
            return self.whole(text)
        end = self[last]
        return self.whole(first) + middle + (self.whole(" " + last) if end is None else end)


class Levels:
    """Open windows by fill level, and the rule that picks one."""

    def __init__(self, window: int, first_id: int):
        self.window, self.next_id = window, first_id
        self.count = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.size = 0

    def place(self, piece: tuple) -> list | None:
        """Puts the piece where the sum of squared level counts grows least.

        Level 0 is a new window. A full window leaves the count. Ties go to the fullest
        level. Returns a window that became full.
        """
        n = len(piece[2]) // 4
        top = self.window - n
        after = 2 * self.count[n : self.window + 1] + 1
        after[-1] = 0
        change = after - 2 * self.count[: top + 1] + 1
        change[0] = after[0]
        change[1:][self.count[1 : top + 1] == 0] = np.iinfo(np.int64).max
        level = int(top - np.argmin(change[::-1]))
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
            self.size -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + n == self.window:
            return pieces
        self.open.setdefault(level + n, []).append(pieces)
        self.count[level + n] += 1
        self.size += 1
        return None

    def close(self) -> list[list]:
        """Empties the open windows: their pieces in a row, cut where a window ends."""
        row = [piece for level in sorted(self.open, reverse=True) for pieces in self.open[level] for piece in pieces]
        self.open, self.size = {}, 0
        self.count[:] = 0
        windows, now, room = [], [], self.window
        for doc, start, ids, total in row:
            while ids:
                part, ids = ids[: 4 * room], ids[4 * room :]
                now.append((doc, start, part, total))
                start += len(part) // 4
                room -= len(part) // 4
                if not room:
                    windows.append(now)
                    now, room = [], self.window
        return windows + ([now] if now else [])


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece of a document, with its ids, window and offset.

    Every task packs the documents it reads in their order, so nothing is shuffled and
    a lost task gives the same rows again. A document is its ids and ``end_id``. Whole
    windows are cut off a document longer than a window; the rest goes to a fill level by
    the sum-of-squares rule. What is open when a task ends, or when more than OPEN_WINDOWS
    windows are open, is cut to fill windows, so a task leaves one window that needs padding
    each time.

    Ids are those of the tokenizer file's own ``encode`` without special tokens around the
    text; the string of an added token inside a text is that token.

    Nulls and empty texts are documents of ``end_id`` alone. Equal ids and repeated rows
    are packed row by row. Columns other than the two named are not read.
    """

    def task(batches):
        encoder = Encoder(tokenizer, added=True)
        levels = Levels(window, 0)
        next_id = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        end, out, held = np.array([end_id], "<u4").tobytes(), [], 0
        full = 4 * window

        def emit(pieces):
            nonlocal next_id, held
            offset = 0
            for doc, start, ids, total in pieces:
                out.append((doc, start, len(ids) // 4, ids, total, next_id, offset))
                offset += len(ids) // 4
            held += 4 * offset
            next_id += 1

        def batch():
            nonlocal out, held
            columns = list(zip(*out, strict=True))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            out, held = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for rows in batches:
            ids_of, texts = rows.column(0), rows.column(1)
            for i in range(rows.num_rows):
                doc, ids, start = ids_of[i].as_py(), encoder.encode(texts[i].as_py() or "") + end, 0
                total = len(ids) // 4
                while len(ids) - 4 * start >= full:
                    emit([(doc, start, ids[4 * start : 4 * start + full], total)])
                    start += window
                if 4 * start < len(ids) and (done := levels.place((doc, start, ids[4 * start :], total))):
                    emit(done)
                if levels.size > OPEN_WINDOWS:
                    for pieces in levels.close():
                        emit(pieces)
                if held > 4_000_000:
                    yield batch()
        for pieces in levels.close():
            emit(pieces)
        if out:
            yield batch()

    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(task, PIECES)
