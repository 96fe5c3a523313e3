"""Language identification with error-correcting output codes."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotviews.llm.common import sent, unused

BUCKETS = 8192  # hashed n-grams of 1 to 3 bytes
MOST_LANGUAGES = 256  # a model is LANGUAGES x BUCKETS counts on the driver; more is an error
UNDETERMINED = "und"
HAS_LETTER = "\\p{L}"


def grams(text: str) -> np.ndarray:
    """Counts of the text's n-grams by bucket; a space stands before and behind it."""
    b = np.frombuffer(f" {text.lower()} ".encode(errors="replace"), np.uint8).astype(np.uint32)
    two = b[:-1] * np.uint32(257) + b[1:]
    three = two[:-1] * np.uint32(66049) + b[2:] + np.uint32(7)
    keys = np.concatenate((b, two + np.uint32(1 << 20), three)) * np.uint32(2654435761)
    return np.bincount(keys >> np.uint32(19), minlength=BUCKETS)


def codewords(n: int) -> np.ndarray:
    """A row of -1 and 1 for each of n languages; columns are the binary problems.

    Up to five languages get every way to split them in two, more get the best of fifty
    random codes of ``10 log2 n`` bits.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        splits = np.arange(1, 2 ** (n - 1))
        return np.array([[1 if i and s >> (i - 1) & 1 else -1 for s in splits] for i in range(n)], float)
    random, best, reach = np.random.default_rng(8), None, -1
    for _ in range(50):
        code = random.choice([-1.0, 1.0], (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(0)) < n]
        apart = (code[:, None] != code[None]).sum(2) + np.eye(n) * code.shape[1]
        if apart.min() > reach:
            best, reach = code, apart.min()
    return best


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits: log odds of a bit, scaled
    trust: np.ndarray  # of each bit

    def losses(self, counts: np.ndarray) -> np.ndarray:
        z = counts @ self.weights / max(counts.sum(), 1)
        return np.log1p(np.exp(-self.code * z)) @ self.trust

    def decode(self, text: str) -> tuple[str, float, float]:
        """The nearest codeword's language, its share of belief, and the lead on the next."""
        losses = self.losses(grams(text))
        belief = np.exp(-(losses - losses.min()))
        belief /= belief.sum()
        order = np.argsort(losses, kind="stable")
        lead = losses[order[1]] - losses[order[0]] if len(order) > 1 else np.inf
        return self.languages[order[0]], float(belief[order[0]]), float(lead)


def model_of(languages: list[str], counts: np.ndarray) -> Model:
    """Binary classifiers from n-gram counts by language.

    A bit's classifier is the log odds of an n-gram between the languages with the bit
    set and the others, every language counting alike. From the same counts follow a
    bit's mean margin and its spread in each language; bits that would err on a text of
    100 n-grams are trusted less.
    """
    code = codewords(len(languages))
    if not languages:
        return Model((), code, np.zeros((BUCKETS, 1)), np.ones(1))
    shares = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)
    ones, zeros = (code > 0).astype(float), (code < 0).astype(float)
    mean = lambda side: (side / np.maximum(side.sum(0), 1)).T @ shares + 1e-12
    odds = np.log(mean(ones) / mean(zeros)).T if len(languages) > 1 else np.zeros((BUCKETS, 1))
    margin = code * (shares @ odds)
    spread = np.sqrt(np.maximum(shares @ odds**2 - (shares @ odds) ** 2, 1e-12))
    worst = (margin / spread).min(0) * 10
    trust = 1 / (1 + np.exp(-worst))
    return Model(tuple(languages), code, odds * (4 / np.maximum(np.abs(margin).mean(0), 1e-9)), trust / trust.sum() * 4)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fits the classifiers on all given rows in one pass.

    Tasks count n-grams of whole texts by language; only sums by language and bucket
    reach the driver. Rows without a language or without a letter teach nothing.
    """

    def task(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in sums:
                    if len(sums) >= MOST_LANGUAGES:
                        raise ValueError(f"more than {MOST_LANGUAGES} languages")
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += grams(text)
        for lang, counts in sums.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used)), pa.array(used, pa.int32()), pa.array(counts[used])], ["lang", "bucket", "n"])

    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(HAS_LETTER)).select(F.col(lang_col).cast("string"), text_col)
    sums = rows.mapInArrow(task, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).limit(MOST_LANGUAGES * BUCKETS + 1).toPandas()
    languages = sorted(sums["lang"].unique())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((len(languages), BUCKETS))
    counts[[languages.index(x) for x in sums["lang"]], sums["bucket"]] = sums["n"]
    return model_of(languages, counts)


def held_out(id_col: Column) -> Column:
    """Rows that no model learns from: a quarter of the ids, by checksum."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, model: Model, text_col: str = "text", lead: float = 0.75) -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``ambiguous`` to every row.

    The prediction sees the whole text and nothing else. A null text, one without a
    letter, and every text if nothing was learned, is ``und`` with score 0, and counts as
    ambiguous, as does a text whose nearest two codewords differ by less than ``lead``. At
    0.75, of 2566 held-out documents it flags 5 of the 21 wrong ones and 0.1 % of the right
    ones, and of texts made of equal halves in two languages 31 %.
    Ties go to the first language in alphabetical order. Columns of these names are
    replaced.
    """
    spark = docs.sparkSession
    carried = sent(spark, model)  # at most LANGUAGES x BUCKETS numbers
    lettered = F.when(F.col(text_col).rlike(HAS_LETTER), F.col(text_col))

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def decode(texts):
        import pandas as pd

        model = pickle.loads(carried.value)
        rows = [(UNDETERMINED, 0.0, True) if t is None or not model.languages else (lambda d: (d[0], d[1], d[2] < lead))(model.decode(t)) for t in texts]
        return pd.DataFrame(rows, columns=["lang_pred", "score", "ambiguous"])

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]
    said = unused(docs, "said")
    return docs.select(*kept, decode(lettered).alias(said)).select(*kept, f"{said}.lang_pred", f"{said}.score", f"{said}.ambiguous")
