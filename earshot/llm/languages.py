"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.text import buffers, chunks, hash_sample, held_out
from earshot.sources.store import materialize

FIT_ROWS = 20_000
BITS_PER_GRAM = 16
GRAMS = (3, 4)
SMOOTH = 0.5
UNKNOWN = "und"
AMBIGUOUS = 0.6
PIECE = 1 << 18
PARTS = 3
LEAST_SLOPE = 0.01

_ORD = np.arange(256, dtype=np.uint8)
_UPPER = (_ORD >= 65) & (_ORD <= 90)
_LETTER = _UPPER | ((_ORD >= 97) & (_ORD <= 122)) | (_ORD >= 128)
_FOLD = np.where(_UPPER, _ORD + 32, np.where(_LETTER, _ORD, 0)).astype(np.uint8)
_NONE = len(GRAMS) << BITS_PER_GRAM


def fold(data: np.ndarray) -> np.ndarray:
    """Letters in lower case (A-Z and the accented Latin capitals), every other byte 0."""
    out = _FOLD[data]
    latin = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[latin] += 0x20
    return out


def gram_bins(texts: pa.Array):
    """Yields (bins, text numbers, their first positions) for pieces of some 256 kB; grams do not cross texts.

    ``bins`` has a row per gram length; grams around a byte that is no letter get the empty bin.
    """
    data, offsets = buffers(texts)
    longest = max(GRAMS)
    for lo, hi in chunks(data, offsets, size=PIECE):
        # grams that begin here may end in the next piece, so where pieces end does not matter
        low = fold(data[lo : min(hi + longest - 1, int(offsets[-1]))]).astype(np.uint64)
        low = np.append(low, np.zeros(hi - lo + longest - 1 - len(low), np.uint64))
        first = int(np.searchsorted(offsets, lo, side="right")) - 1
        last = int(np.searchsorted(offsets, hi, side="left"))
        at = np.clip(offsets[first : last + 1], lo, hi) - lo
        filled = np.flatnonzero(np.diff(at) > 0)
        numbers, starts = filled + first, at[filled]
        ends = np.repeat(offsets[numbers + 1] - lo, np.diff(np.append(starts, hi - lo)))
        left = ends - np.arange(hi - lo)
        bins = np.full((len(GRAMS), hi - lo), _NONE, np.int32)
        for g, n in enumerate(GRAMS):
            code = np.zeros(hi - lo, np.uint64)
            for k in range(n):
                code = (code << np.uint64(8)) | low[k : k + hi - lo]
            hashed = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS_PER_GRAM)
            good = (left >= n) & (low[1 : 1 + hi - lo] != 0)
            bins[g] = np.where(good, hashed.astype(np.int32) + (g << BITS_PER_GRAM), _NONE)
        yield bins, numbers, starts


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # bits x bins, log-odds of the bit for a gram
    slope: np.ndarray
    shift: np.ndarray
    trust: np.ndarray  # languages x bits, mean 1 per language

    def margins(self, texts: pa.Array) -> np.ndarray:
        """texts x bits: summed log-odds over the root of the number of grams, so long texts do not swamp."""
        sums = np.zeros((len(self.weights), len(texts)))
        counts = np.zeros(len(texts))
        for bins, numbers, starts in gram_bins(texts):
            for row in bins:
                counts[numbers] += np.add.reduceat((row != _NONE).astype(np.int32), starts)
                for b, weight in enumerate(self.weights):
                    sums[b, numbers] += np.add.reduceat(weight[row], starts, dtype=np.float64)
        return (sums / np.sqrt(counts + 1)).T

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the language with the smallest weighted loss, its share of the likelihood)."""
        if len(self.languages) == 1:
            return np.zeros(len(margins), int), np.ones(len(margins))
        odds = margins * self.slope + self.shift
        loss = np.logaddexp(0, -odds[:, None, :] * self.code[None]) * self.trust[None]
        total = loss.sum(axis=2)
        best = total.argmin(axis=1)  # of equal ones the first by code point
        share = np.exp(total.min(axis=1)[:, None] - total)
        return best, 1 / share.sum(axis=1)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """One row of +1 and -1 per class. Up to six classes: every split in two, so rows differ in more than half
    of the bits. Beyond: about ten bits per doubling, the best of 64 random codes by smallest distance."""
    if n <= 6:
        splits = [s for s in itertools.product((1, -1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(splits, float).T.reshape(n, len(splits))
    rng, width, best, far = np.random.default_rng(seed), math.ceil(10 * math.log2(n)), None, -1
    for _ in range(64):
        code = rng.choice([1.0, -1.0], (n, width))
        code[0, np.abs(code.sum(axis=0)) == n] *= -1  # no bit without both sides
        near = ((width - code @ code.T) / 2 + np.eye(n) * width).min()
        if near > far:
            best, far = code, near
    return best


def _logistic(z: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope and shift of P(y | z), slightly drawn to 1 and 0 so that separable sides and few rows stay finite."""
    x, prior = np.stack([z, np.ones_like(z)]), np.array([1.0, 0.0])
    w = prior
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        slope = x @ (y - p) - ridge * (w - prior)
        w = w + np.linalg.solve((x * (p * (1 - p) + 1e-9)) @ x.T + ridge * np.eye(2), slope)
    return max(round(float(w[0]), 6), LEAST_SLOPE), round(float(w[1]), 6)


def _from_counts(languages: list[str], counts: np.ndarray) -> Model:
    """The classifiers of gram counts (languages x bins); slopes, shifts and trust neutral."""
    shares = counts + SMOOTH
    shares /= shares.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    bits = code.shape[1]
    weights = np.zeros((bits, _NONE + 1), np.float32)
    for b in range(bits):
        one, other = shares[code[:, b] > 0].mean(axis=0), shares[code[:, b] < 0].mean(axis=0)
        weights[b, :_NONE] = np.log(one) - np.log(other)
    return Model(languages, code, weights, np.ones(bits), np.zeros(bits), np.ones((len(languages), bits)))


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", fit_rows: int = FIT_ROWS, key: str = "doc_id") -> Model | None:
    """A model from about ``fit_rows`` labelled rows, chosen by a hash of ``key``; None where there is none.

    The sample is written once. Gram counts by language and part (by a hash of the text) come from one pass over it. A
    second pass judges each part by the counts of the others, and these margins, of rows the counts have not seen, give
    each bit's slope and each language's trust in the bits. The classifiers are those of all counts. A language
    whose rows are all in one part has equal trust in all bits. What reaches the driver is bounded by parts times
    languages times bins and by ``fit_rows``.
    """
    usable = rows.select(key, text, lang).filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    sample = hash_sample(usable, key, fit_rows).select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.pmod(F.xxhash64(F.lit(9), F.col(text)), F.lit(PARTS)).cast("int").alias("part")
    )
    sample = materialize(sample, "language_sample")

    def count(batches):
        for batch in batches:
            names, of = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            of = of * PARTS + batch.column("part").to_numpy()
            counts = np.zeros((len(names) * PARTS, _NONE + 1), np.int32)
            for bins, numbers, starts in gram_bins(batch.column("text")):
                lengths = np.diff(np.append(starts, bins.shape[1]))
                owner = np.repeat(of[numbers], lengths).astype(np.int64)
                for row in bins:
                    np.add(counts, np.bincount(owner * (_NONE + 1) + row, minlength=counts.size).reshape(counts.shape), out=counts, casting="same_kind")
            # the empty bin goes along, so that a language is known by its rows
            counts[:, _NONE] = np.bincount(of, minlength=len(counts))
            for at, own in enumerate(counts):
                full = np.flatnonzero(own).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[at // PARTS]] * len(full), pa.string()), pa.array(np.full(len(full), at % PARTS, np.int32)), pa.array(full), pa.array(own[full].astype(np.int64))],
                    ["lang", "part", "bin", "n"],
                )

    found = sample.mapInArrow(count, "lang string, part int, bin int, n bigint").groupBy("lang", "part", "bin").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(found.column("lang").unique().to_pylist()), key=lambda s: s.encode())
    if not languages:
        return None
    place = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((PARTS, len(languages), _NONE + 1))
    of = np.array([place[x] for x in found.column("lang").to_pylist()])
    counts[found.column("part").to_numpy(), of, found.column("bin").to_numpy()] = found.column("n").to_numpy()
    n_rows, counts = counts[:, :, _NONE], counts[:, :, :_NONE]
    model = _from_counts(languages, counts.sum(axis=0))
    bits = len(model.slope)
    if bits == 0:
        return model
    others = sample.sparkSession.sparkContext.broadcast([_from_counts(languages, counts.sum(axis=0) - counts[p]) for p in range(PARTS)])

    def measure(batches):
        for batch in batches:
            parts = batch.column("part").to_numpy()
            for p in np.unique(parts):
                own = batch.filter(pa.array(parts == p))
                margins = others.value[p].margins(own.column("text"))
                yield pa.RecordBatch.from_arrays([own.column("lang"), own.column("part"), pa.array(list(margins), pa.list_(pa.float64()))], ["lang", "part", "z"])

    seen = sample.mapInArrow(measure, "lang string, part int, z array<double>").toArrow()
    z = np.round(np.array(seen.column("z").to_pylist()), 9)
    of = np.array([place[x] for x in seen.column("lang").to_pylist()])
    strange = n_rows.sum(axis=0)[of] == n_rows[seen.column("part").to_numpy(), of]
    z, of = z[~strange], of[~strange]
    order = np.lexsort((*z.T, of))  # sums do not depend on the order of tasks
    z, of = z[order], of[order]
    for b in range(bits):
        model.slope[b], model.shift[b] = _logistic(z[:, b], (model.code[of, b] > 0).astype(float))
    right = (z * model.slope + model.shift) * model.code[of] > 0
    trust = np.stack([right[of == i].mean(axis=0) if (of == i).any() else np.ones(bits) for i in range(len(languages))])
    trust = np.maximum(trust, 1e-3)
    model.trust = trust / trust.mean(axis=1, keepdims=True)
    others.unpersist()
    return model


def identify(docs: DataFrame, model: Model | None, text: str = "text", ambiguous: float = AMBIGUOUS) -> DataFrame:
    """The rows of ``docs`` with ``lang_pred``, ``score`` and ``ambiguous``; columns of these names are replaced.

    ``und`` with score 0, not ambiguous: texts that are null, empty or without a letter, and every text where there
    is no model. Of languages with equal loss the first by code point. ``ambiguous``: a score below the bound.
    Texts are read whole, in pieces.
    """
    made = ("lang_pred", "score", "ambiguous")
    rows = docs.drop(*made)
    if model is None:
        return rows.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(False).alias("ambiguous"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def classify(texts: pa.Array) -> pa.Array:
        best, share = shared.value.decode(shared.value.margins(texts))
        return pa.StructArray.from_arrays([pa.array(shared.value.languages).take(pa.array(best)), pa.array(share)], ["lang", "score"])

    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    out = rows.withColumn("_lettered", lettered).withColumn("_said", classify(F.col(text)))
    score = F.when(F.col("_lettered"), F.col("_said.score")).otherwise(0.0)
    return out.select(
        *rows.columns,
        F.when(F.col("_lettered"), F.col("_said.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        score.alias("score"),
        (F.col("_lettered") & (score < ambiguous)).alias("ambiguous"),
    )


def learn(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model | None:
    """The model of the registered query: from rows that are not held out."""
    return fit(docs.filter(~held_out(F.col("doc_id"))), fit_rows=fit_rows)


def op6_language(spark, sf_dir: str) -> DataFrame:
    """Every document's predicted language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(rows, learn(docs)).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
