"""Toxicity by a subsequence string kernel SVM with Nystroem landmarks.

The kernel compares two words by the letter triples they share in order, gaps allowed: a triple that
spans k further letters weighs ``DECAY ** k``, up to ``SPAN``. An insult with an inserted or a missing
letter, another ending, or signs between its letters stays close to the plain one. Words are read
after folding: case, digits that stand for letters, signs inside a word, letters spelled one by one.

Training labels are of documents. A sentence of a clean document is clean. A sentence of a toxic one
is toxic if it holds a word, or a beginning of words, that toxic documents use in several contexts
and clean ones do not; copies of one document share their contexts and so count once. The margin of a
sentence is that of its highest word, so training works on these words: the ones that make sentences
toxic against clean words, frequent ones and then those the first fit gets wrong. Landmarks come
from both; features are kernel values times the inverse root of the landmark kernel; the SVM has a
squared hinge and is solved by Newton steps. The margin of a document is its highest sentence's, and
a logistic curve fitted on the sampled documents turns it into a score.

As a kernel expansion is linear in the triples, a fitted model is one weight per triple, and texts
are scored in numpy without comparing them to landmarks one by one.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.words import LOWER, ship, shipped, text_slices, word_bounds

DECAY, SPAN = 0.7, 5
SAMPLE_DOCS = 6000  # expected labelled rows of each class that training reads
NEGATIVES = 3000  # clean words a fit takes: half the most frequent, half those it gets most wrong
LANDMARKS = 150  # of each kind
PREFIXES = (4, 5)
CHANCE = 1e-8  # a telling word's contexts all fall into toxic texts by chance with at most this
VARIANTS = 3  # forms of a telling word with a letter put in, which a fit also sees
EXACT_FROM = -0.6  # below this margin a bound stands for the margin
LOWEST = -3.0
THRESHOLD = 0.7

# Letters 1 to 26; 27 to 31 stand for letters outside ASCII; 0 is dropped; digits as look-alikes.
CODE = np.zeros(256, np.uint8)
CODE[97:123] = np.arange(1, 27)
CODE[0x80:0xC0] = 27 + (np.arange(0x80, 0xC0) | 0x20) % 5
for _digit, _letter in (("0", "o"), ("1", "i"), ("3", "e"), ("4", "a"), ("5", "s"), ("7", "t"), ("@", "a")):
    CODE[ord(_digit)] = CODE[ord(_letter)]
PAIRS = [(j, k) for k in range(2, SPAN + 1) for j in range(1, k)]
SIZE = 1 << 15


def folded_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter codes without what is dropped, the word of each letter, and the text of each word.

    Words of one letter that follow each other are one word.
    """
    starts, ends, ranges = word_bounds(data, offsets)
    codes = CODE[LOWER[data]]
    kept = np.flatnonzero(codes)
    first, last = np.searchsorted(kept, starts), np.searchsorted(kept, ends)
    size = last - first
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(ranges))
    some = np.flatnonzero(size)
    size, text = size[some], text[some]
    joined = np.zeros(len(some), bool)
    joined[1:] = (size[1:] == 1) & (size[:-1] == 1) & (text[1:] == text[:-1])
    word = np.cumsum(~joined) - 1
    return codes[kept], np.repeat(word, size), text[~joined]


def spelled(codes: np.ndarray, word: np.ndarray) -> list[bytes]:
    raw = codes.tobytes()
    bounds = np.append(np.flatnonzero(np.diff(word, prepend=-1)), len(word)).tolist()
    return [raw[a:b] for a, b in zip(bounds, bounds[1:])]


def triples(word: bytes) -> dict[int, float]:
    out: dict[int, float] = {}
    for i in range(len(word)):
        for j, k in PAIRS:
            if i + k < len(word):
                key = word[i] << 10 | word[i + j] << 5 | word[i + k]
                out[key] = out.get(key, 0.0) + DECAY ** k
    return out


def unit(words: list[bytes]) -> np.ndarray:
    """Rows of normalised triple weights; the kernel is their product."""
    out = np.zeros((len(words), SIZE), np.float32)
    for row, word in zip(out, words):
        found = triples(word)
        row[list(found)] = list(found.values())
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, word: bytes) -> float:
        found = triples(word)
        norm = np.sqrt(sum(v * v for v in found.values()))
        return self.bias + sum(float(self.weights[k]) * v for k, v in found.items()) / norm if norm else LOWEST

    def word_margins(self, codes: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Exact margins from ``EXACT_FROM`` up; below it, an upper bound."""
        count = int(word[-1]) + 1 if len(word) else 0
        total, square = np.zeros((2, len(codes)), np.float32)
        wide = codes.astype(np.int32)
        for k in range(2, SPAN + 1):
            if len(codes) <= k:
                break
            inside = (word[k:] == word[:-k]).astype(np.float32)
            square[:-k] += inside * np.float32((k - 1) * DECAY ** (2 * k))
            ends = wide[:-k] << 10 | wide[k:]
            found = sum(self.weights[ends | wide[j:j - k] << 5] for j in range(1, k))
            total[:-k] += found * inside * np.float32(DECAY ** k)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        if not count:
            return np.empty(0)
        top, norm = np.add.reduceat(total, first), np.add.reduceat(square, first)
        # Repeated triples only add to the norm, so this is the greatest the margin can be.
        bound = np.where(norm > 0, self.bias + np.where(top > 0, top / np.sqrt(np.maximum(norm, 1e-9)), 0), LOWEST)
        near = np.flatnonzero(bound > EXACT_FROM - 1e-4)
        last = np.append(first[1:], len(codes))
        raw, known = codes.tobytes(), {}
        for i in near.tolist():
            own = raw[first[i]:last[i]]
            if own not in known:
                known[own] = max(self.margin(own), EXACT_FROM)
            bound[i] = known[own]
        return bound

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


def text_margins(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    codes, word, text = folded_words(data, offsets)
    out = np.full(len(offsets) - 1, LOWEST)
    if len(text):
        np.maximum.at(out, text, model.word_margins(codes, word))
    return out


def telling_words(sample: DataFrame) -> DataFrame:
    """(word, contexts, clean, begins): folded words of the sampled (text, toxic) rows and, as rows
    with ``begins``, their beginnings. ``contexts``: distinct words before it in toxic texts;
    ``clean``: times in clean texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for low, high, data, offsets in text_slices(batch.column(0)):
                codes, word, text = folded_words(data, offsets)
                words = spelled(codes, word)
                bad = toxic[low:high][text] if len(text) else np.empty(0, bool)
                before = [hash_of(w) if same else 0 for w, same in
                          zip([b"", *words[:-1]], np.diff(text, prepend=-1) == 0)]
                rows: dict[tuple, int] = {}
                for w, b, c in zip(words, bad.tolist(), before):
                    if len(w) < 3:
                        continue
                    for own, begins in ((w, False), *((w[:n], True) for n in PREFIXES if len(w) > n)):
                        key = (own, begins, c if b else -1)
                        rows[key] = rows.get(key, 0) + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([k[0] for k in rows], pa.binary()), pa.array([k[1] for k in rows], pa.bool_()),
                    pa.array([k[2] for k in rows], pa.int32()), pa.array(list(rows.values()), pa.int64()),
                ], names=["word", "begins", "context", "n"])

    return sample.select("text", "toxic") \
        .mapInArrow(run, "word binary, begins boolean, context int, n bigint") \
        .groupBy("word", "begins", "context").agg(F.sum("n").alias("n")) \
        .groupBy("word", "begins").agg(
            F.count(F.when(F.col("context") >= 0, 1)).alias("contexts"),
            F.coalesce(F.sum(F.when(F.col("context") < 0, F.col("n"))), F.lit(0)).alias("clean"))


def hash_of(word: bytes) -> int:
    value = 7
    for b in word:
        value = (value * 31 + b) & 0x3FFFFFFF
    return value


def newton_svm(z: np.ndarray, y: np.ndarray, c: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the bias) of the squared-hinge SVM, by Newton steps on its active rows."""
    z = np.hstack([z, np.ones((len(z), 1))])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(z.shape[1])
    active = np.ones(len(y), bool)
    for _ in range(rounds):
        a = z[active] * c[active, None]
        w = np.linalg.solve(ridge + z[active].T @ a, a.T @ y[active])
        now = y * (z @ w) < 1
        if (now == active).all():
            break
        active = now
    return w


def with_letter(word: bytes, rnd: random.Random) -> bytes:
    at = rnd.randint(1, len(word) - 1)
    return word[:at] + bytes([rnd.randint(1, 26)]) + word[at:]


def fit_words(positive: list[bytes], negative: list[bytes]) -> Model:
    rnd = random.Random(len(positive))
    varied = [with_letter(w, rnd) for w in positive if len(w) > 3 for _ in range(VARIANTS)]
    known = set(negative)
    plain, positive = positive, positive + [w for w in varied if w not in known]
    words = positive + negative
    y = np.append(np.ones(len(positive)), -np.ones(len(negative)))
    landmarks = unit(plain[:LANDMARKS] + negative[:LANDMARKS])
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    kernel = np.vstack([unit(words[i:i + 500]) @ landmarks.T for i in range(0, len(words), 500)])
    c = 10.0 * np.where(y > 0, len(y) / (2 * len(positive)), len(y) / (2 * len(negative)))
    w = newton_svm(kernel @ root, y, c)
    return Model((landmarks.T @ (root @ w[:-1])).astype(np.float32), float(w[-1]))


def logistic(margin: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Platt's curve with his softened targets, by Newton steps."""
    up, down = toxic.sum(), (~toxic).sum()
    target = np.where(toxic, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + 1e-3 * np.eye(2),
                               x.T @ (weight * (target - p)) - 1e-3 * w)
        w = w + np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Fit on rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) names.

    Of each class the rows whose hash lies below ``sample_docs`` / its number are read, about
    ``sample_docs`` rows. A doc_id labelled twice is toxic if any label says so; null labels are
    ignored. None if either class, or any telling word, is missing.
    """
    named = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL") \
        .groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in named.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    share = {k: min(1.0, sample_docs / n) for k, n in sizes.items()}
    place = F.pmod(F.xxhash64("doc_id", F.lit("svm")), F.lit(1 << 30)) / float(1 << 30)
    chosen = named.filter(place < F.when(F.col("toxic"), share[True]).otherwise(share[False]))
    # About 2 * sample_docs ids, whatever the corpus holds: fit to be broadcast.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    stats = telling_words(sample)
    read = {k: share[k] * n for k, n in sizes.items()}
    least = max(3.0, np.log(CHANCE) / np.log(read[True] / (read[True] + read[False])))
    odd = stats.filter((F.col("contexts") >= least) & (F.col("contexts") > 20 * F.col("clean"))) \
        .orderBy(F.desc("contexts"), "word").toPandas()
    if odd.empty:
        return None
    whole = [bytes(w) for w in odd["word"][~odd["begins"]]]
    begins = {bytes(w) for w in odd["word"][odd["begins"]]}
    words = stats.filter("NOT begins")
    starts = [F.substring("word", 1, n) for n in PREFIXES]
    # Every telling word and every word with a telling beginning: the sample of rows bounds them.
    like = []
    if begins:
        heads = docs.sparkSession.createDataFrame([(b,) for b in sorted(begins)], "head binary")
        found = words.filter("contexts > 0 AND clean = 0") \
            .withColumn("head", F.explode(F.array_distinct(F.array(*starts)))) \
            .join(F.broadcast(heads), "head", "left_semi").select("word", "contexts").distinct()
        like = [bytes(r["word"]) for r in found.orderBy(F.desc("contexts"), "word").collect()]
    positive = list(dict.fromkeys(whole + like))
    clean = words.filter("clean > 0")
    frequent = [bytes(r["word"]) for r in clean.orderBy(F.desc("clean"), "word").limit(NEGATIVES // 2).collect()]
    if not frequent:
        return None
    model = fit_words(positive, frequent)
    shared = ship(docs.sparkSession, model)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped(shared)
        for batch in batches:
            own = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([model.margin(bytes(w)) for w in own], pa.float64())],
                names=["word", "margin"])

    hard = [bytes(r["word"]) for r in clean.select("word").mapInArrow(margins, "word binary, margin double")
            .orderBy(F.desc("margin"), "word").limit(NEGATIVES // 2).collect()]
    # The hardest clean words are the better landmarks.
    model = fit_words(positive, list(dict.fromkeys([*hard, *frequent])))
    judged = with_margins(sample.select("doc_id", "text", "toxic"), model).select("toxic", "margin").toPandas()
    toxic = judged["toxic"].to_numpy(bool)
    # Both classes weigh the same, so the curve turns halfway between them and not at the rarer one:
    # room for insults that are further from the plain ones than any in the sample.
    weight = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1)) * len(toxic)
    slope, shift = logistic(judged["margin"].to_numpy(), toxic, weight)
    return model._replace(slope=slope, shift=shift)


def with_margins(docs: DataFrame, model: Model) -> DataFrame:
    shared = ship(docs.sparkSession, model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped(shared)
        for batch in batches:
            found = [text_margins(model, data, offsets)
                     for _, _, data, offsets in text_slices(batch.column(place))]
            margin = np.concatenate(found) if found else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(margin, pa.float64())],
                                             names=[*batch.schema.names, "margin"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{head}, margin double")


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, margin of every row of ``docs`` (doc_id, text).

    Null and empty texts, and texts without a word of three letters, have the lowest margin. Without
    a model every score is 0. Repeated rows give repeated results. Map only, whole texts.
    """
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(LOWEST).alias("margin"))
    p = 1 / (1 + F.exp(-(F.col("margin") * model.slope + model.shift)))
    return with_margins(docs.select("doc_id", "text"), model).select("doc_id", p.alias("score"), "margin") \
        .select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "margin")
