"""Language identification by error-correcting output codes.

Each language has a codeword of bits; a binary logistic classifier on hashed byte n-grams predicts each bit. Decoding
takes the codeword with the least weighted logistic loss, the weights being the bits' training accuracies, and flags a
text as ambiguous if a second codeword comes close, and as outside if it is clearly farther from all codewords than any
training text from its own.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.text import Words, sliced

UNKNOWN = "und"
BUCKETS = 1 << 12
GRAMS = (1, 2, 3)
_LETTER = np.arange(256, dtype=np.uint64)
_LETTER[65:91] += 32
_LETTER[:65] = _LETTER[91:97] = _LETTER[123:128] = 32
_ASCII_LETTERS = np.zeros(256, bool)
_ASCII_LETTERS[65:91] = _ASCII_LETTERS[97:123] = True


def features(words: Words) -> np.ndarray:
    """A row for each document: square roots of n-gram counts by bucket, scaled to length 1. ASCII case is ignored."""
    raw = words.bytes
    codes = _LETTER[raw]
    rows = np.zeros((words.docs, BUCKETS), np.float32)
    hashed, gram = [], np.zeros(len(codes), np.uint64)
    for n in GRAMS:
        gram = (gram[: len(codes) - n + 1] << np.uint64(8) | codes[n - 1 :]) if len(codes) >= n else codes[:0]
        hashed.append(((gram + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 12)).astype(np.int32))
    for d in range(words.docs):
        lo, hi = words.offsets[d], words.offsets[d + 1]
        for n, buckets in zip(GRAMS, hashed, strict=True):
            if hi - lo >= n:
                rows[d] += np.bincount(buckets[lo : hi - n + 1], minlength=BUCKETS)
    np.sqrt(rows, out=rows)
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.maximum(norms, 1e-9)[:, None]


def _few(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices of few enough texts that their features take some 8 MB, however short the texts are."""
    for batch in batches:
        for part in sliced(batch, column):
            for lo in range(0, part.num_rows, 512):
                yield part.slice(lo, 512)


def has_letter(words: Words) -> np.ndarray:
    """Whether each document has a letter of any script."""
    seen = np.concatenate([[0], np.cumsum(_ASCII_LETTERS[words.bytes])])
    found = seen[words.offsets[1:]] > seen[words.offsets[:-1]]
    for d in np.flatnonzero(~found):
        found[d] = any(c.isalpha() for c in words.bytes[words.offsets[d] : words.offsets[d + 1]].tobytes().decode("utf-8", "replace"))
    return found


def codewords(languages: int, seed: int = 5) -> np.ndarray:
    """A matrix of +1 and -1, a row per language: of many random codes, the one with the largest least distance."""
    if languages == 1:
        return np.ones((1, 1))
    bits = int(max(7, np.ceil(10 * np.log2(languages)) - 5))
    rng, best, most = np.random.default_rng(seed), None, -1
    for _ in range(400):
        code = np.where(rng.random((languages, bits)) < 0.5, -1.0, 1.0)
        if (np.abs(code.sum(0)) == languages).any():  # a constant bit tells nothing
            continue
        apart = (bits - code @ code.T) / 2 + bits * np.eye(languages)
        if apart.min() > most:
            best, most = code, apart.min()
    if best is None:
        best = np.where(np.arange(languages)[:, None] >> np.arange(bits) % max(1, (languages - 1).bit_length()) & 1, 1.0, -1.0)
    return best


@dataclasses.dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    farthest: float = np.inf  # the largest loss of a training text's own codeword

    def losses(self, rows: np.ndarray) -> np.ndarray:
        margins = rows @ self.weights + self.bias
        return np.einsum("b,nkb->nk", self.trust, np.logaddexp(0, -margins[:, None, :] * self.code[None]))


def fit(rows: np.ndarray, labels: list[str], *, steps: int = 150, rate: float = 20.0, penalty: float = 1e-5) -> Model:
    languages = sorted(set(labels))
    code = codewords(len(languages))
    place = {x: k for k, x in enumerate(languages)}
    which = np.array([place[x] for x in labels])
    target = code[which].astype(np.float32)
    balance = (len(which) / (len(languages) * np.bincount(which)))[which].astype(np.float32)[:, None] / len(which)
    weights, bias = np.zeros((rows.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    ahead, ahead_bias = weights, bias
    for step in range(steps):  # accelerated gradient descent on the balanced logistic loss
        margins = rows @ ahead + ahead_bias
        slope = -target * balance * np.exp(-np.logaddexp(np.float32(0), target * margins))
        new, new_bias = ahead - rate * (rows.T @ slope + penalty * ahead), ahead_bias - rate / 4 * slope.sum(0)
        speed = np.float32(step / (step + 3))
        ahead, ahead_bias = new + speed * (new - weights), new_bias + speed * (new_bias - bias)
        weights, bias = new, new_bias
    right = ((rows @ weights + bias) * target > 0).mean(0)
    trust = np.clip(2 * right - 1, 0.01, None)
    model = Model(languages, code, weights, bias, trust / trust.sum())
    return dataclasses.replace(model, farthest=float(model.losses(rows)[np.arange(len(which)), which].max()))


def train(docs: DataFrame, *, per_language: int = 300, most_languages: int = 1000, most_rows: int = 30_000) -> Model | None:
    """Fit on ``docs`` (doc_id, text, lang): about ``per_language`` labelled rows of each language, chosen by a hash.

    Rows with a null text or lang are not used, and of equal rows one. None if no row is left. All languages that occur
    are learned; more than ``most_languages`` are an error, as the driver holds the sample, ``most_rows`` or so at most
    (8 KB each).
    """
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(most_languages + 1).collect()}
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    if not sizes:
        return None
    per_language = max(1, min(per_language, most_rows // len(sizes)))
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, per_language / n))))
    chance = F.pmod(F.xxhash64(F.lit("language"), "doc_id", F.crc32(F.col("text").cast("binary"))), F.lit(1_000_003)) / 1_000_003.0
    drawn = labelled.where(chance < F.element_at(share, F.col("lang")))
    once = drawn.groupBy("doc_id", "lang", F.md5(F.col("text").cast("binary"))).agg(F.first("text").alias("text")).select("lang", "text")
    sample = once.mapInArrow(_featured, "lang string, row binary").toArrow()
    labels = sample.column("lang").to_pylist()
    missing = set(sizes) - set(labels)
    if missing:  # a language of few rows may have lost the draw
        rest = labelled.where(F.col("lang").isin(sorted(missing))).mapInArrow(_featured, "lang string, row binary").limit(per_language * len(missing)).toArrow()
        sample = pa.concat_tables([sample, rest])
        labels = sample.column("lang").to_pylist()
    rows = np.frombuffer(b"".join(sample.column("row").to_pylist()), np.float16).reshape(len(labels), BUCKETS).astype(np.float32)
    order = np.lexsort([rows[:, :8].sum(1), np.array(labels)])
    return fit(rows[order], [labels[k] for k in order])


def _featured(batches):
    for part in _few(batches, "text"):
        rows = features(Words(part.column("text"))).astype(np.float16)
        yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["lang", "row"])


def identify(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text", close: float = 0.1, beyond: float = 1.25, keep: list[str] | None = None) -> DataFrame:
    """One row per document: its id, the columns ``keep``, ``lang_pred``, ``score`` (0 to 1), ``ambiguous`` (a second
    language within ``close``) and ``outside`` (of all languages: a loss over ``beyond`` times the largest in training).

    ``und`` with score 0 if the text is null, has no letter, or nothing was learned. Whole texts are read, however long,
    one at a time; only the text is an input of the prediction. Ties go to the language first in order and are ambiguous. Repeated rows are answered each; an empty
    table gives no rows; other columns are not read, and ``keep`` may not name the new ones.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    carried = docs.select(F.col(id_col), *(keep or []))
    names = [*carried.columns, "lang_pred", "score", "ambiguous", "outside"]
    if len(set(names)) < len(names):
        raise ValueError("keep names a column twice")
    places = [f"_{n}" for n in range(len(names) - 3)]  # the text is the last of them: other columns may have any name
    text = places[-1]
    schema = carried.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "ambiguous": F.lit(False), "outside": F.lit(False)}).schema

    def predict(batches):
        for part in _few(batches, text):
            words = Words(part.column(text))
            langs = np.full(words.docs, UNKNOWN, object)
            score, unsure, outside = np.zeros(words.docs), np.zeros(words.docs, bool), np.zeros(words.docs, bool)
            known = np.flatnonzero(has_letter(words))
            if shared.value is not None and len(known):
                losses = shared.value.losses(features(words)[known])
                odds = np.exp(-8 * (losses - losses.min(1, keepdims=True)))
                odds /= odds.sum(1, keepdims=True)
                best = losses.argmin(1)
                langs[known] = np.array(shared.value.languages, object)[best]
                score[known] = odds.max(1)
                outside[known] = losses.min(1) > beyond * shared.value.farthest
                if losses.shape[1] > 1:
                    two = np.sort(odds, axis=1)
                    unsure[known] = two[:, -1] - two[:, -2] < close
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(langs, pa.string()), pa.array(score), pa.array(unsure), pa.array(outside)], names=names)

    return docs.select(F.col(id_col), *(keep or []), F.col(text_col)).toDF(*places).mapInArrow(predict, schema)


def held_out_third(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
