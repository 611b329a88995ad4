"""Quality rules, and an isolation forest over their statistics for documents that the rules let pass.

Repeats are left to the rules. Trees are of few rows: junk comes in clusters, and in small samples a cluster is
still a few rows that random splits cut off early.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.text import _BLANK, buffers, hash_sample, slices, word_hashes
from earshot.sources.store import materialize

TREES = 200
TREE_ROWS = 64
FIT_ROWS = 20_000
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent
KEEP_GOOD = 0.995
UNSURE = 0.62  # verdict where no labels are given
BINS = 1 << 16

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = (
    "word_length", "long_words", "symbols", "symbol_words", "bare_words", "marked_words", "upper_words",
)

_ORD = np.arange(256)


def _bytes(of: str | range) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[[ord(c) for c in of] if isinstance(of, str) else list(of)] = True
    return mask


_SYMBOL = _bytes("#*$%&|<>")
_UPPER = _bytes(range(65, 91))
_LETTER = _UPPER | _bytes(range(97, 123)) | _bytes(range(128, 256))
_MARK = _bytes("!?")
_START = (_ORD & 0xC0) != 0x80  # a byte that begins a code point


def repeated_words(words: np.ndarray, window: int = WINDOW) -> int:
    """Number of words inside windows of ``window`` words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    # equal windows get equal numbers by doubling: numbers of pairs, then of pairs of pairs
    _, ids = np.unique(words, return_inverse=True)
    width = 1
    while width < window:
        step = min(width, window - width)
        pairs = ids[: len(ids) - step].astype(np.int64) * (ids.max() + 1) + ids[step:]
        _, ids = np.unique(pairs, return_inverse=True)
        width += step
    twice = np.bincount(ids)[ids] > 1
    delta = np.zeros(len(words) + 1, np.int64)
    where = np.flatnonzero(twice)
    np.add.at(delta, where, 1)
    np.add.at(delta, where + window, -1)
    return int((np.cumsum(delta[:-1]) > 0).sum())


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(counts of the rules, texts x COUNTS; ratios for the forest, texts x STATISTICS)."""
    parts = [_statistics(part) for part in slices(texts)]
    if not parts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(STATISTICS)))
    counts, ratios = zip(*parts)
    return np.concatenate(counts), np.concatenate(ratios)


def _statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = buffers(texts)
    words, at = word_hashes(texts)
    n_words = np.diff(at)
    counts, ratios = np.zeros((len(texts), len(COUNTS)), np.int64), np.zeros((len(texts), len(STATISTICS)))
    for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:])):
        n, own = int(n_words[i]), data[lo:hi]
        if not n:
            continue
        inside = ~_BLANK[own]
        chars = int((inside & _START[own]).sum())
        symbols = int(_SYMBOL[own].sum())
        lines = own.tobytes().split(b"\n")
        filled = [x for x in lines if x.strip(b" \t\n\x0b\x0c\r")]
        dup = len(filled) - len(set(filled))
        repeat = repeated_words(words[at[i] : at[i + 1]])
        counts[i] = n, chars, symbols, dup, repeat
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        per_word = lambda mask: np.add.reduceat(mask.astype(np.int32), starts)
        lengths = per_word(inside & _START[own])
        latin = np.concatenate([[False], (own[:-1] == 0xC3) & (own[1:] >= 0x80) & (own[1:] <= 0x9E)])
        letters, upper = per_word(_LETTER[own] & _START[own]), per_word(_UPPER[own] | latin)
        ratios[i] = (
            chars / n, (lengths > 6).mean(), symbols / chars, (per_word(_SYMBOL[own]) > 0).mean(), (letters == 0).mean(),
            (per_word(_MARK[own]) > 0).mean(), ((upper == letters) & (letters > 1)).mean(),
        )
    return counts, ratios


def path_constant(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n rows: the depth that a leaf still hides."""
    n = np.asarray(n, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        long = 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as flat arrays, one row per tree; a leaf points to itself."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    rows: int
    threshold: float = UNSURE

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / its mean for random rows): near 1 for rows that random splits isolate at once."""
        total = np.zeros(len(x))
        each = np.arange(len(x))
        for feature, split, left, right, depth in zip(self.feature, self.split, self.left, self.right, self.depth):
            node = np.zeros(len(x), np.int64)
            while True:
                following = np.where(x[each, feature[node]] < split[node], left[node], right[node])
                if (following == node).all():
                    break
                node = following
            total += depth[node]
        return 2.0 ** (-total / len(self.feature) / max(float(path_constant(self.rows)), 1e-9))


def grow(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 3) -> Forest:
    """Trees of ``tree_rows`` rows each, cut at random values of random statistics down to single rows or the mean depth."""
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(rows))
    limit = max(1, int(np.ceil(np.log2(max(size, 2)))))
    parts = []
    for _ in range(trees):
        nodes: list[list[float]] = []

        def build(own: np.ndarray, depth: int) -> int:
            me = len(nodes)
            low, high = own.min(axis=0), own.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if depth >= limit or len(own) < 2 or not len(open_):
                nodes.append([0, -np.inf, me, me, depth + float(path_constant(len(own)))])
                return me
            f = int(rng.choice(open_))
            cut = rng.uniform(low[f], high[f])
            cut = cut if cut > low[f] else high[f]
            nodes.append([f, cut, 0, 0, 0])
            below = own[:, f] < cut
            nodes[me][2] = build(own[below], depth + 1)
            nodes[me][3] = build(own[~below], depth + 1)
            return me

        build(rows[rng.choice(len(rows), size, replace=False)], 0)
        parts.append(np.array(nodes, float))
    widest = max(map(len, parts))
    full = np.stack([np.pad(p, ((0, widest - len(p)), (0, 0))) for p in parts])
    return Forest(
        full[:, :, 0].astype(np.int64), full[:, :, 1], full[:, :, 2].astype(np.int64), full[:, :, 3].astype(np.int64), full[:, :, 4], size
    )


def base_failed(n_words, n_repeat_words):
    """Too few words, or too many of them in repeated windows; columns or arrays."""
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEATED)


def _measured(rows: DataFrame) -> DataFrame:
    def measure(batches):
        for batch in batches:
            counts, ratios = statistics(batch.column("text"))
            keep = ~base_failed(counts[:, 0], counts[:, 4])
            yield pa.RecordBatch.from_arrays(
                [batch.column("quality").filter(pa.array(keep)), pa.array(list(ratios[keep]), pa.list_(pa.float64()))], ["quality", "x"]
            )

    return rows.mapInArrow(measure, "quality int, x array<double>")


def fit(
    docs: DataFrame, labels: DataFrame | None, fit_rows: int = FIT_ROWS, trees: int = TREES, tree_rows: int = TREE_ROWS,
    key: str = "doc_id", text: str = "text", quality: str = "quality",
) -> Forest | None:
    """A forest from about ``fit_rows`` documents that pass the base rules, its threshold from all labelled ones, see
    ``calibrate``; ``UNSURE`` without labels. None without rows."""
    pick = lambda rows: np.array(rows.column("x").to_pylist(), float).reshape(-1, len(STATISTICS))
    sample = hash_sample(docs.select(key, text), key, fit_rows, seed=17)
    drawn = _measured(sample.select(F.col(text).alias("text"), F.lit(None).cast("int").alias("quality"))).toArrow()
    rows = pick(drawn)
    if not len(rows):
        return None
    rows = rows[np.lexsort(rows.T)]  # tasks end in any order
    forest = grow(rows, trees, tree_rows)
    if labels is not None:
        wanted = docs.select(key, text).join(labels.select(key).distinct(), key, "left_semi")
        forest.threshold = calibrate(score(wanted, forest, text), labels, key, quality)
    return forest


def calibrate(scored: DataFrame, labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> float:
    """The threshold from all labelled rows of ``scored`` (key, anomaly): the score that splits good from bad labels best
    (true rate less false rate), but not below the one that leaves ``KEEP_GOOD`` of the good rows in.

    Without labels of both kinds it is ``UNSURE``. Labels that are null are left out; a document with several is good
    only if all say so. What comes to the driver are counts in ``BINS`` parts of the scores' range.
    """
    known = labels.filter(F.col(quality).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg((F.min(quality) > 0).alias("good"))
    place = F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS - 1))
    found = scored.select(key, "anomaly").filter(F.col("anomaly").isNotNull()).join(known, key)
    bins = found.groupBy(place.alias("bin")).agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).orderBy("bin").collect()
    good, bad = (np.array([row[kind] for row in bins], float) for kind in ("good", "bad"))
    if not good.sum() or not bad.sum():
        return UNSURE
    cuts = (np.array([row["bin"] for row in bins]) + 1) / BINS
    return threshold(cuts, good, bad)


def threshold(cuts: np.ndarray, good: np.ndarray, bad: np.ndarray, keep_good: float = KEEP_GOOD) -> float:
    """The best of ``cuts``, in ascending order, of which each has so many good and bad rows at or below it and above the one
    before. Rows that score above the threshold are anomalous; ties fall on the kept side."""
    kept_good, kept_bad = np.cumsum(good) / good.sum(), np.cumsum(bad) / bad.sum()
    gain = np.where(kept_good >= keep_good, kept_good - kept_bad, -np.inf)
    return float(cuts[int(gain.argmax())])


def score(docs: DataFrame, forest: Forest | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the counts, ``base_failed`` and ``anomaly``; columns of these names are replaced.

    Null, empty and blank texts have zero counts and fail the base rules. ``anomaly`` is null where the base rules
    fail or there is no forest.
    """
    rows = docs.drop(*COUNTS, "base_failed", "anomaly")
    shared = docs.sparkSession.sparkContext.broadcast(forest)
    kind = ", ".join(f"{c}: bigint" for c in COUNTS)

    @F.arrow_udf(f"struct<{kind}, anomaly: double>")
    def judge(texts: pa.Array) -> pa.Array:
        counts, ratios = statistics(texts)
        scored = ~base_failed(counts[:, 0], counts[:, 4]) if shared.value is not None else np.zeros(len(texts), bool)
        score = np.zeros(len(texts))
        if scored.any():
            score[scored] = shared.value.score(ratios[scored])
        return pa.StructArray.from_arrays([pa.array(c) for c in counts.T.copy()] + [pa.array(score, mask=~scored)], [*COUNTS, "anomaly"])

    out = rows.withColumn("_said", judge(F.col(text))).select(*rows.columns, "_said.*")
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return out.select(*rows.columns, *COUNTS, failed.alias("base_failed"), "anomaly")


def judged(scored: DataFrame, threshold: float) -> DataFrame:
    """Scored rows with ``kept``: the base rules hold and the anomaly, if there is one, is not above the threshold."""
    kept = ~F.col("base_failed") & F.coalesce(F.col("anomaly") <= F.lit(float(threshold)), F.lit(True))
    return scored.drop("kept").withColumn("kept", kept)


def check(docs: DataFrame, forest: Forest | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the counts, ``base_failed``, ``anomaly`` and ``kept``, see ``score`` and ``judged``; columns
    of these names are replaced. Without a forest the base rules alone decide."""
    return judged(score(docs, forest, text), forest.threshold if forest is not None else 1.0)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """Every document's rule statistics and verdict. Texts are scored once; the threshold comes from the scores."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    forest = fit(docs, None)
    scored = materialize(score(docs, forest).drop("text"), "scored")
    limit = calibrate(scored, labels) if forest is not None else 1.0
    return judged(scored, limit).select("doc_id", *COUNTS, "base_failed", "anomaly", "kept")
