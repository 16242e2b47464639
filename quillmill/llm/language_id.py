"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its byte n-grams, hashed into BUCKETS rows; a
linear layer and a softmax give the languages' probabilities. Both are trained in
numpy by stochastic gradient descent, on the driver, on a bounded sample of labelled
rows. As the model is linear after the mean, prediction looks up one row of logits
for each n-gram. A temperature calibrates the probabilities on the part of the sample
that is not trained on: texts of a known language should get high ones, the same texts
with their bytes shuffled even ones. A text is rejected if its probability is
below what all but REJECTED of the rightly predicted texts of that part reach, or if it
has no letter.

Defined cases: null texts and texts without a letter are `und`, score 0, rejected;
without labelled rows every text is `und`, score 0, and only those without a letter
are rejected; repeated rows give repeated results; a text may be of any length; an
empty table gives an empty table; other columns pass through. Of a text longer than
TRAIN_CHARS the middle is learned from; predictions read whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.ragged import chunks_by_size, offsets_of, worker

#: The labelled sample: at most so many rows to train on, so many to calibrate on, and of
#: each at most so many characters.
TRAIN_ROWS, HELD_ROWS, TRAIN_CHARS = 4_000, 2_000, 4_000
BUCKETS, DIM, ORDERS = 1 << 16, 16, (2, 3, 4)
EPOCHS, RATE = 4, 10.0
#: Share of rightly predicted texts that calibrated rejection may lose.
REJECTED = 0.0005
#: What the shuffled texts count against the others when the temperature is chosen.
SHUFFLED_WEIGHT = 0.1
UNKNOWN = "und"
CHUNK = 400_000
_GAP = b" " * (max(ORDERS) - 1)

#: Bytes: letters lowered, ASCII that is no letter a space, others as they are.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(128)]
_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text)


def ngram_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams that begin at each byte (bytes x orders), and where each text's begin and end.

    A text's first n-gram begins with a space before it, its last ones end in spaces
    behind it: none reaches into another text.
    """
    data = _FOLD[np.frombuffer(_GAP + b"".join(t + _GAP for t in texts) + b" ", np.uint8)].astype(np.uint32)
    n = len(data) - max(ORDERS) + 1
    out = np.empty((n, len(ORDERS)), np.int64)
    acc = np.zeros(n, np.uint32)
    for k in range(max(ORDERS)):
        acc = (acc + data[k : k + n] + np.uint32(1)) * np.uint32(0x9E3779B1)
        acc ^= acc >> np.uint32(15)
        if k + 1 in ORDERS:
            out[:, ORDERS.index(k + 1)] = (acc + np.uint32(k)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - 16)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = offsets_of(lengths + len(_GAP))[:-1] + len(_GAP) - 1
    return out, starts, starts + lengths + 1


@dataclass
class LanguageModel:
    languages: list[str]
    logits: np.ndarray  # BUCKETS x languages
    temperature: float
    threshold: float

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        buckets, starts, ends = ngram_buckets(texts)
        total = np.zeros((len(texts), len(self.languages)), np.float64)
        edges = np.column_stack((starts, ends)).reshape(-1)  # every other stretch is a text
        for order in range(len(ORDERS)):
            total += np.add.reduceat(self.logits[buckets[:, order]], edges, axis=0)[::2]
        return softmax(total / (ends - starts)[:, None] / len(ORDERS) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text's n-grams and their shares."""
    buckets, starts, ends = ngram_buckets([text])
    ids, counts = np.unique(buckets[starts[0] : ends[0]], return_counts=True)
    return ids, (counts / counts.sum()).astype(np.float32)


def sgd_step(embed: np.ndarray, linear: np.ndarray, ids: np.ndarray, weights: np.ndarray, y: int, rate: float) -> None:
    """One step down the gradient of the cross entropy of one text, in place; the linear layer moves a twentieth as fast."""
    rows = embed[ids]
    mean = weights @ rows
    error = softmax((mean @ linear)[None])[0]
    error[y] -= 1
    back = linear @ error
    linear -= np.float32(rate * 0.05) * np.outer(mean, error)
    embed[ids] = rows - np.float32(rate) * weights[:, None] * back


def calibrate(z: np.ndarray, y: np.ndarray, shuffled: np.ndarray) -> tuple[float, float]:
    """Temperature and rejection threshold: z are logits of texts of classes y, shuffled those of texts of none.

    Fewer than 1 / REJECTED rightly predicted texts do not show the quantile: the
    threshold then lies nearer to an even probability, in proportion.
    """
    grid = np.geomspace(0.002, 5, 100)
    right = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    even = [-np.log(softmax(shuffled / t) + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(np.array(right) + SHUFFLED_WEIGHT * np.array(even)))])
    p = softmax(z / temperature)
    reached = p.max(axis=1)[p.argmax(axis=1) == y]
    if not len(reached):
        return temperature, 0.0
    even_share = 1 / z.shape[1]
    return temperature, float(even_share + (np.quantile(reached, REJECTED) - even_share) * min(1.0, len(reached) * REJECTED))


def fit(rows: list[tuple[str, str]], seed: int = 7) -> LanguageModel | None:
    """rows: (text, language). A fifth, and what is beyond TRAIN_ROWS, calibrates (at most HELD_ROWS)."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    train = [i for i in range(len(rows)) if i % 5 != 4][:TRAIN_ROWS]
    chosen = set(train)
    held = [i for i in range(len(rows)) if i not in chosen][:HELD_ROWS]
    bags = {i: _bag(rows[i][0].encode()) for i in train}
    embed = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    linear = np.zeros((DIM, len(languages)), np.float32)
    steps, step = EPOCHS * max(1, len(train)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(train):
            sgd_step(embed, linear, *bags[i], languages.index(rows[i][1]), RATE * (1 - step / steps))
            step += 1
    model = LanguageModel(languages, embed @ linear, 1.0, 0.0)
    if held:
        logits = lambda bag: bag[1] @ model.logits[bag[0]]
        z = np.array([logits(_bag(rows[i][0].encode())) for i in held])
        shuffled = np.array([logits(_bag(bytes(rng.permutation(np.frombuffer(rows[i][0].encode(), np.uint8))))) for i in held])
        model.temperature, model.threshold = calibrate(z, np.array([languages.index(rows[i][1]) for i in held]), shuffled)
    return model


def training_rows(docs: DataFrame, usable: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> list[tuple[str, str]]:
    """At most TRAIN_ROWS + HELD_ROWS labelled rows, those of the least hash; the hashes are read first, then their texts.

    Rows equal in id, text and label count once; of a long text the middle is taken.
    """
    length = F.length(text_col)
    middle = F.when(length > TRAIN_CHARS, F.substring(F.col(text_col), F.floor((length - TRAIN_CHARS) / 2).cast("int") + 1, F.lit(TRAIN_CHARS))).otherwise(F.col(text_col))
    rows = docs.filter(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.xxhash64(id_col, text_col).alias("h"), middle.alias("text"), F.col(lang_col).alias("lang")
    )
    cut = rows.select("h").orderBy("h").limit(TRAIN_ROWS + HELD_ROWS).agg(F.max("h")).first()[0]
    if cut is None:
        return []
    found = rows.filter(F.col("h") <= cut).dropDuplicates(["h", "lang"]).collect()  # a row for each of the hashes and labels
    return [(r["text"], r["lang"]) for r in sorted(found, key=lambda r: (r["h"], r["lang"]))[: TRAIN_ROWS + HELD_ROWS] if has_letter(r["text"])]


_RESULT = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


def predict(text: Column, model: LanguageModel | None) -> Column:
    """struct(lang, score, rejected)."""

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    @worker("language_id")
    def language(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for i, j in chunks_by_size(pa.compute.binary_length(texts).fill_null(0).to_pylist(), CHUNK):
                some = [t or "" for t in texts[i:j].to_pylist()]
                known = np.array([has_letter(t) for t in some], bool)
                langs, scores, rejected = np.full(j - i, UNKNOWN, object), np.zeros(j - i), ~known
                if model is not None and known.any():
                    p = model.probabilities([t.encode() for t, ok in zip(some, known, strict=True) if ok])
                    langs[known] = np.array(model.languages, object)[p.argmax(axis=1)]
                    scores[known] = p.max(axis=1)
                    rejected = rejected | (scores < model.threshold)
                yield pa.StructArray.from_arrays(
                    [pa.array(langs, pa.string()), pa.array(scores), pa.array(rejected)], fields=list(_RESULT)
                )

    # not deterministic: else the plan may predict once for each use of the column
    return language.asNondeterministic()(text)


def not_held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0, F.lit(True))
