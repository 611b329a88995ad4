"""Toxic passages by maximum-scoring segments over token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.languages import fold
from earshot.llm.text import buffers, chunks, hash_sample, held_out, mix, slices, span_hashes, spans
from earshot.sources.store import materialize

FIT_ROWS = 30_000
FEATURES = 200_000
STEMS = (4, 6)  # bytes of a token that its stems keep
PRIOR = 2.0
ERRORS = 2.0
STRONG = 0.7
LOW, HIGH = -1.0, 6.0
DRIFT = 0.1
E_VALUE = 1e-2
PREDICT_AT = 0.3
FLOOR = -5.0

_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def tokens(texts: pa.Array):
    """(stem and word hashes, levels x tokens; position of each text's first token, with the end as last).

    Tokens are runs of letters in lower case. A stem is their first bytes; shorter tokens are their own stems.
    """
    data, offsets = buffers(texts)
    found, at = [np.zeros((len(STEMS) + 1, 0), np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in chunks(data, offsets, _NOT_LETTER):
        starts, ends = spans(data, offsets, lo, hi, _NOT_LETTER)
        low = fold(data[lo:hi])
        levels = [span_hashes(low, starts, np.minimum(ends, starts + n)) for n in STEMS] + [span_hashes(low, starts, ends)]
        found.append(np.stack([mix(h + np.uint64(i + 1)) for i, h in enumerate(levels)]))
        at.append(starts + lo)
    return np.concatenate(found, axis=1), np.searchsorted(np.concatenate(at), offsets)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence, (start, end, score), left to right.

    One scan: each positive run joins the segments before it as long as that raises the total. ``back`` links every
    open segment to the nearest earlier one that starts lower, so no segment is looked at twice in vain.
    """
    positive = scores > 0
    if not positive.any():
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], positive.view(np.int8), [0]])))
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, back
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        before, after = float(total[start]), float(total[end])
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= after:
                stack.append((start, end, before, after, j))
                break
            start, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, a - b) for s, e, b, a, _ in stack]


@dataclass
class Model:
    keys: np.ndarray  # sorted hashes of stems and words that carry a score
    scores: np.ndarray
    rate: float  # scale of the extreme-value law
    size: float  # its constant
    slope: float = 1.0
    shift: float = 0.0

    def token_scores(self, levels: np.ndarray) -> np.ndarray:
        """The score of the longest known form of each token, less the drift that makes clean text lose."""
        out = np.zeros(levels.shape[1])
        for row in levels:  # stems first, so that longer forms overwrite
            if len(self.keys):
                at = np.minimum(np.searchsorted(self.keys, row), len(self.keys) - 1)
                hit = self.keys[at] == row
                out[hit] = self.scores[at[hit]]
        return np.clip(out, LOW, HIGH) - DRIFT

    def passages(self, texts: pa.Array):
        """Per text the segments with an E-value of at most ``E_VALUE``, and the evidence of all of them.

        E = size * tokens * exp(-rate * score), the number of such segments to expect in clean text of that length.
        The evidence is -log E of the best segment, however weak, plus that of every further significant one.
        """
        for part in slices(texts):
            yield from self._passages(part)

    def _passages(self, texts: pa.Array):
        levels, at = tokens(texts)
        scores = self.token_scores(levels)
        for lo, hi in zip(at[:-1], at[1:]):
            found = segments(scores[lo:hi])
            if not found:
                yield [], FLOOR
                continue
            limit = np.log(max(self.size * (hi - lo), 1e-9))
            evidence = [(self.rate * s - limit, a, b, s) for a, b, s in found]
            strong = [e for e in evidence if e[0] >= -np.log(E_VALUE)]
            total = sum(e[0] for e in strong) if strong else max(e[0] for e in evidence)
            yield [(a, b, s, float(np.exp(-min(e, 700)))) for e, a, b, s in strong], max(FLOOR, total)


def _parts(batches):
    """(texts, whether each is toxic) in runs of a few MB."""
    for batch in batches:
        toxic, at = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool), 0
        for part in slices(batch.column("text")):
            yield part, toxic[at : at + len(part)]
            at += len(part)


def _doc_words(batches):
    """Per word its stems and the numbers of toxic and other texts that hold it; a repeat within a text counts no more."""
    for texts, toxic in _parts(batches):
        levels, at = tokens(texts)
        if not levels.shape[1]:
            continue
        texts = np.repeat(np.arange(len(toxic)), np.diff(at))
        order = np.lexsort((texts, levels[-1]))
        words, texts = levels[-1][order], texts[order]
        new = np.concatenate([[True], (words[1:] != words[:-1]) | (texts[1:] != texts[:-1])])
        order, words, of = order[new], words[new], toxic[texts[new]]
        keys, first, back = np.unique(words, return_index=True, return_inverse=True)
        stems = [levels[i][order[first]].view(np.int64) for i in range(len(STEMS))]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys.view(np.int64)), pa.array(stems[1]), pa.array(stems[0]),
                pa.array(np.bincount(back, of, len(keys)).astype(np.int64)),
                pa.array(np.bincount(back, ~of, len(keys)).astype(np.int64)),
            ],
            ["key", "long_stem", "stem", "a", "b"],
        )


def fit(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, features: int = FEATURES, key: str = "doc_id",
    text: str = "text", toxic: str = "toxic",
) -> Model | None:
    """A model from about ``fit_rows`` labelled documents; None where one class has none.

    Log-odds: the share of toxic documents among those with a word, with a Dirichlet prior of ``PRIOR`` documents at
    the share of its stem, for which the words with that stem are counted alike. So inflections that were never seen
    are judged by their stem. Of the log-odds counts what is above ``ERRORS`` standard errors. Copies count once. At most ``features`` forms are
    kept, those with the most evidence; that bounds the model, as ``fit_rows`` bounds the sample. Documents with
    several labels count as toxic if one says so; labels that are null, or of no document, are left out.
    """
    known = labels.filter(F.col(toxic).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(toxic).alias("_toxic"))
    # a bounded sample of ids and labels, so the texts are not shuffled to meet them
    chosen = hash_sample(known, key, fit_rows)
    rows = docs.select(key, F.col(text).alias("text")).join(F.broadcast(chosen), key).select(
        F.coalesce("text", F.lit("")).alias("text"), (F.col("_toxic") > 0).alias("toxic")
    )
    sample = rows.groupBy(F.xxhash64("text").alias("_h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    sample = materialize(sample, "toxic-sample")  # read several times
    # scores come from three quarters of the sample and what they mean from the rest, which they have not seen
    apart = F.pmod(F.col("_h"), F.lit(4)) == 0
    learnt, unseen = sample.filter(~apart).drop("_h"), sample.filter(apart).drop("_h")
    sizes = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    words = learnt.mapInArrow(_doc_words, "key bigint, long_stem bigint, stem bigint, a bigint, b bigint").groupBy("key").agg(
        F.min("long_stem").alias("long_stem"), F.min("stem").alias("stem"), F.sum("a").alias("a"), F.sum("b").alias("b")
    )
    words = materialize(words, "toxic-words")
    base = sizes[True] / sum(sizes.values())
    share = (F.col("a") + PRIOR * F.col("up")) / (F.col("a") + F.col("b") + PRIOR)
    # stems count words, not texts: one frequent word says nothing about others that begin alike
    part = lambda c: F.sum(F.col(c) / (F.col("a") + F.col("b")))
    types = words.groupBy("stem", "long_stem").agg(part("a").alias("a"), part("b").alias("b"))
    stems = types.groupBy(F.col("stem").alias("key")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")).withColumn("up", F.lit(base))
    stems = stems.withColumn("share", share)
    above = lambda rows, name: rows.select(F.col("key").alias(name), F.col("share").alias("up"))
    long_stems = types.withColumnRenamed("long_stem", "key").join(above(stems, "stem"), "stem").withColumn("share", share)
    words = words.join(above(long_stems, "long_stem"), "long_stem").withColumn("share", share)
    columns = ("key", "a", "b", "up", "share")
    every = stems.select(*columns).unionByName(long_stems.select(*columns)).unionByName(words.select(*columns))
    odds = lambda c: F.log(F.col(c) / (1 - F.col(c))) - float(np.log(base / (1 - base)))
    # what is left of the log-odds after two standard errors, so that chance in rare forms does not add up
    error = F.sqrt(1 / (F.col("a") + 1) + 1 / (F.col("b") + 1))
    sure = lambda c: F.signum(odds(c)) * F.greatest(F.abs(odds(c)) - ERRORS * error, F.lit(0.0))
    # a neutral word under a strong stem is kept too: it has to overrule the stem
    # rounded, as the last digits of sums depend on the order in which tasks end
    near = lambda c, name: F.round(c, 9).alias(name)
    every = every.select("key", near(sure("share"), "s"), near(odds("up"), "u"), near(F.col("a") + F.col("b"), "n"))
    every = every.filter((F.abs("s") >= STRONG) | (F.abs("u") >= STRONG))
    table = every.orderBy(F.desc(F.greatest(F.abs("s"), F.abs("u")) * F.log1p("n")), "key").limit(features).toArrow()
    keys = table.column("key").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    model = Model(keys[order], table.column("s").to_numpy()[order], 1.0, 1.0)
    spark = docs.sparkSession
    shared_model = spark.sparkContext.broadcast(model)

    def profile(batches):
        """Histogram of token scores of clean texts, in hundredths."""
        for texts, toxic_ in _parts(batches):
            levels, at = tokens(texts)
            clean = ~toxic_
            scores = np.round(shared_model.value.token_scores(levels) * 100).astype(np.int32)
            values, n = np.unique(scores[np.repeat(clean, np.diff(at))], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n.astype(np.int64))], ["x", "n"])

    seen = unseen.mapInArrow(profile, "x int, n bigint").groupBy("x").agg(F.sum("n").alias("n")).toArrow().sort_by("x")
    model.rate = _rate(seen.column("x").to_numpy() / 100, seen.column("n").to_numpy())
    model.size = 1.0
    scaled = spark.sparkContext.broadcast(model)

    def measure(batches):
        for texts, toxic_ in _parts(batches):
            levels, at = tokens(texts)
            scores = scaled.value.token_scores(levels)
            best = [
                max((s for *_, s in segments(scores[lo:hi])), default=0.0)
                for lo, hi in zip(at[:-1], at[1:])
            ]
            yield pa.RecordBatch.from_arrays([pa.array(toxic_), pa.array(np.diff(at)), pa.array(best, pa.float64())], ["toxic", "n", "s"])

    best = unseen.mapInArrow(measure, "toxic boolean, n bigint, s double").toArrow().sort_by([("s", "ascending"), ("n", "ascending")])
    n, s = best.column("n").to_numpy().astype(float), best.column("s").to_numpy()
    clean = ~best.column("toxic").to_numpy().astype(bool) & (n > 0)
    # the most likely constant of the extreme-value law, given its scale, from the best segments of clean texts
    model.size = float(max(1, clean.sum()) / max(1e-9, (n[clean] * np.exp(-model.rate * s[clean])).sum() or 1.0))
    final = spark.sparkContext.broadcast(model)

    def judge(batches):
        for batch in batches:
            z = [e for _, e in final.value.passages(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(z, pa.float64())], ["toxic", "z"])

    said = unseen.mapInArrow(judge, "toxic boolean, z double").toArrow().sort_by([("z", "ascending"), ("toxic", "ascending")])
    model.slope, model.shift = _calibrate(said.column("z").to_numpy(), said.column("toxic").to_numpy().astype(float))
    for b in (shared_model, scaled, final):
        b.unpersist()
    return model


def _rate(x: np.ndarray, n: np.ndarray) -> float:
    """The positive root of mean(exp(rate * score)) = 1 over clean tokens. One token of the highest score is added,
    so that there is a root where clean text has no positive token."""
    x, p = np.append(x, HIGH - DRIFT), np.append(n, 1.0)
    p = p / p.sum()
    low, high = 1e-6, 50.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(np.minimum(middle * x, 700))).sum() < 1 else (low, middle)
    return (low + high) / 2


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the chance of toxicity given the evidence, capped so that huge evidence does not count extra."""
    x, w = np.stack([np.minimum(z, 30.0), np.ones_like(z)]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p) + 1e-9)) @ x.T + 1e-2 * np.eye(2), x @ (y - p) - 1e-2 * w)
    return float(w[0]), float(w[1])


def detect(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``score`` (0 to 1), ``passages`` and ``evidence``; columns of these names are replaced.

    ``passages`` are (first token, token after the last, score, e_value), the significant segments in order. Null and
    empty texts, and texts without letters, have none and get the score of no evidence. Without a model the score is 0.
    """
    made = ("score", "passages", "evidence")
    rows = docs.drop(*made)
    kind = "array<struct<start: int, end: int, score: double, e_value: double>>"
    if model is None:
        return rows.select("*", F.lit(0.0).alias("score"), F.array().cast(kind).alias("passages"), F.lit(FLOOR).alias("evidence"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inner = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])

    @F.arrow_udf(f"struct<score: double, passages: {kind}, evidence: double>")
    def scan(texts: pa.Array) -> pa.Array:
        m = shared.value
        found = list(m.passages(texts))
        z = np.array([e for _, e in found], float)
        score = 1 / (1 + np.exp(-np.clip(m.slope * np.minimum(z, 30.0) + m.shift, -30, 30)))
        parts = [[dict(zip(("start", "end", "score", "e_value"), x)) for x in p] for p, _ in found]
        return pa.StructArray.from_arrays([pa.array(score), pa.array(parts, pa.list_(inner)), pa.array(z)], list(made))

    return rows.withColumn("_said", scan(F.col(text))).select(*rows.columns, *[F.col(f"_said.{c}").alias(c) for c in made])


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out(F.col("doc_id")))
    return detect(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"), "evidence",
    )
