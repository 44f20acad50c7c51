"""Language identification with error-correcting output codes.

Every language gets a codeword of bits. One binary classifier per bit, a logistic regression on hashed
byte n-grams of the whole lower-cased text, says on which side of the bit's split a text lies. A text
gets the language whose codeword has the least loss over all bits, each bit weighted by how reliably it
recognised that language's training texts; a small gap to the runner-up marks the text as ambiguous.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and not ambiguous. Without
any training row every text is ``und``; with a single learned language every text with a letter gets it.
Repeated rows are judged alike, equal losses go to the language that sorts first, a row without doc_id
counts as held out, and columns besides those named in a call are ignored or handed on untouched.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm import texts

BUCKETS = 4096
LONGEST_GRAM = 3
#: Bound of the training sample: expected rows over all languages, shared evenly; languages beyond as many
#: are not learned.
TRAINING_ROWS = 4800
#: Loss gap to the runner-up, as a share of the runner-up's loss, under which a text is ambiguous.
AMBIGUOUS_GAP = 0.1
UNDETERMINED = "und"
_BLOCK = 1 << 20
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """``n`` rows of +1 and -1: all splits for up to five languages, else a random code with wide gaps."""
    if n <= 5:
        splits = [s for s in itertools.product((1, -1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(splits, dtype=np.int8).reshape(-1, n).T
    rng = np.random.default_rng(seed)
    bits, best, widest = 10 * math.ceil(math.log2(n)), None, -1
    for _ in range(200):
        code = rng.choice(np.array([1, -1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(0, dtype=np.int64)) < n]
        gap = min(int((code[i] != code[i + 1 :]).sum(1).min()) for i in range(n - 1))
        if gap > widest:
            best, widest = code, gap
    return best


def gram_shares(text: bytes) -> np.ndarray:
    """Square roots of the shares of hashed n-grams of a lower-cased text; read block by block."""
    text = b" " + b" ".join(text.translate(_LETTERS).split()) + b" "
    data, counts = np.frombuffer(text, np.uint8), np.zeros(BUCKETS, np.int64)
    for start in range(0, len(data), _BLOCK):
        block = data[start : start + _BLOCK + LONGEST_GRAM - 1].astype(np.uint32)
        own = min(_BLOCK, len(data) - start)
        gram = np.zeros(len(block), np.uint32)
        for n in range(LONGEST_GRAM):
            places = len(block) - n
            gram = gram[:places] * np.uint32(257) + block[n:] + np.uint32(1)
            hashed = (gram[:own] * np.uint32(2654435761)) >> np.uint32(32 - 12)
            counts += np.bincount(hashed, minlength=BUCKETS)
    return np.sqrt(counts / max(counts.sum(), 1)).astype(np.float32)


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits
    offsets: np.ndarray  # bits
    reliability: np.ndarray  # languages x bits, rows sum to 1

    def losses(self, shares: np.ndarray) -> np.ndarray:
        outputs = shares @ self.weights + self.offsets
        margins = outputs[:, None, :] * self.code[None].astype(np.float32)
        return (np.logaddexp(0, -margins) * self.reliability[None]).sum(2)

    def judge(self, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, its probability under the losses, and whether the choice is ambiguous."""
        if len(self.languages) == 1:
            return np.zeros(len(shares), int), np.ones(len(shares)), np.zeros(len(shares), bool)
        loss = self.losses(shares).astype(np.float64)
        best = loss.argmin(1)
        odds = np.exp(-(loss - loss.min(1, keepdims=True)) * max(1, self.code.shape[1]))
        two = np.partition(loss, 1, axis=1)[:, :2]
        return best, 1 / odds.sum(1), two[:, 1] - two[:, 0] < AMBIGUOUS_GAP * two[:, 1]


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(0)) == 0


def training_sample(documents: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """About ``rows`` learnable rows, evenly over the languages, drawn by a hash of doc_id."""
    learnable = texts.with_id(documents, doc_id="doc_id", text="text", lang="lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id"))
    )
    sizes = learnable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(rows).collect()
    shares = [(r["lang"], rows / len(sizes) / r["count"]) for r in sizes]
    share = documents.sparkSession.createDataFrame(shares, "lang string, share double")
    draw = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1_000_003)) / 1_000_003
    return learnable.join(F.broadcast(share), "lang").where(draw < F.col("share")).select("lang", "text")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in texts.slices(batches, "text"):
        lowered = texts.as_bytes(pc.utf8_lower(part.column("text")))
        shares = [gram_shares(t).astype(np.float16).tobytes() for t in lowered]
        yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(shares, pa.binary())], ["lang", "shares"])


def train(documents: DataFrame, rows: int = TRAINING_ROWS) -> LanguageModel:
    """Fit the bit classifiers on a bounded sample of labelled rows that are not held out."""
    sample = training_sample(documents, rows).mapInArrow(_measure, "lang string, shares binary").toArrow()
    labels = np.array(sample.column("lang").to_pylist(), dtype=object)
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], *[np.zeros((0, 0), np.float32)] * 4)
    order = sorted(range(len(labels)), key=lambda i: (labels[i], sample.column("shares")[i].as_py()))
    shares = np.stack([np.frombuffer(sample.column("shares")[i].as_py(), np.float16) for i in order])
    x = shares.astype(np.float32)
    y = np.searchsorted(languages, labels[order].astype(str))
    code = codewords(len(languages))
    weights, offsets = _logistic(x, code[y].astype(np.float32), _balance(y, len(languages)))
    right = np.stack([
        ((x[y == k] @ weights + offsets) * code[k] > 0).mean(0) for k in range(len(languages))
    ]) if code.shape[1] else np.zeros((len(languages), 0))
    reliability = (right + 1e-3) / (right + 1e-3).sum(1, keepdims=True) if code.shape[1] else right
    return LanguageModel(languages, code, weights, offsets, reliability.astype(np.float32))


def _balance(y: np.ndarray, n: int) -> np.ndarray:
    counts = np.bincount(y, minlength=n)
    return (len(y) / n / counts[y]).astype(np.float32)[:, None]


def _logistic(x: np.ndarray, sides: np.ndarray, weight: np.ndarray, steps: int = 300, decay: float = 1e-6):
    """All bit classifiers at once by accelerated gradient steps of a size that cannot overshoot."""
    n, bits = sides.shape
    centre = x.mean(0)
    direction = np.ones(x.shape[1], np.float32)
    for _ in range(20):
        direction = x.T @ (x @ direction - centre @ direction) / n
        size = float(np.linalg.norm(direction)) or 1.0
        direction /= size
    rate = 1 / (0.25 * float(weight.max()) * (size * 1.2) + decay)
    w = np.zeros((x.shape[1], bits), np.float32)
    b = np.zeros(bits, np.float32)
    ahead, last = w.copy(), w
    for t in range(steps):
        margins = sides * ((x @ ahead) - centre @ ahead + b)
        pull = -weight * sides / (1 + np.exp(np.clip(margins, -30, 30))) / n
        slope = x.T @ pull - np.outer(centre, pull.sum(0)) + decay * ahead
        w = ahead - rate * slope
        b = b - 2 * pull.sum(0)
        ahead = w + t / (t + 3) * (w - last)
        last = w
    return w, (b - centre @ w).astype(np.float32)


def _judged(model: LanguageModel, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    lowered = texts.as_bytes(pc.utf8_lower(column))
    known = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    known = known & bool(model.languages)
    names, score, unsure = [UNDETERMINED] * len(lowered), np.zeros(len(lowered)), np.zeros(len(lowered), bool)
    places = np.flatnonzero(known)
    for start in range(0, len(places), 64):
        some = places[start : start + 64]
        best, score[some], unsure[some] = model.judge(np.stack([gram_shares(lowered[i]) for i in some]))
        for i, k in zip(some, best, strict=True):
            names[i] = model.languages[k]
    return names, score, unsure


def identify(df: DataFrame, model: LanguageModel, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with lang_pred, score and ambiguous for every row."""
    source = texts.with_id(df, **{c: c for c in keep}, _text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, "_text"):
            names, score, unsure = _judged(model, part.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(names), pa.array(score), pa.array(unsure)],
                [*part.schema.names[:-1], "lang_pred", "score", "ambiguous"],
            )

    fields = [*source.schema.fields[:-1], T.StructField("lang_pred", T.StringType()),
              T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    return source.mapInArrow(texts.tidy(run), T.StructType(fields))


def keep_known(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Whole rows of ``df`` without those that are ``und``, or ambiguous with less than even odds."""
    place = df.columns.index(text)
    numbered = df.toDF(*[f"c{k}" for k in range(len(df.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in texts.slices(batches, f"c{place}"):
            names, score, unsure = _judged(model, part.column(place))
            known = np.fromiter((name != UNDETERMINED for name in names), bool, len(names))
            yield part.filter(pa.array(known & ~(unsure & (score < 0.5))))

    return numbered.mapInArrow(texts.tidy(run), numbered.schema).toDF(*df.columns)
