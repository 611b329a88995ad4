"""Words of a text: Spark expressions for native plans, numpy over Arrow buffers for tasks in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the white space that separates words; everything else belongs to one.
BLANK = r"[\x20\x09-\x0D]+"
CHUNK = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_AS_IS = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_AS_IS >= 65) & (_AS_IS <= 90), _AS_IS + 32, _AS_IS).astype(np.uint8)
_RATIO = np.uint64(0x9E3779B97F4A7C15 | 1)


def word_array(text: Column) -> Column:
    """The words of a text in order; none for null and for texts of blanks."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, without keeping them: blanks at the ends give the split empty pieces."""
    pieces = F.split(F.coalesce(text, F.lit("")), BLANK)
    edges = (F.element_at(pieces, 1) == "").cast("int") + (
        (F.size(pieces) > 1) & (F.element_at(pieces, -1) == "")
    ).cast("int")
    return (F.size(pieces) - edges).cast("long")


def train_part(doc_id: Column) -> Column:
    """Rows to learn from; the rest, about a quarter, is held out. A null id counts as learnt from."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def hash_sample(rows: DataFrame, key: str, bound: int, seed: int = 7) -> DataFrame:
    """About ``bound`` rows, or all where there are fewer, chosen by a hash of ``key``: a rerun chooses the same.

    The number is binomial with mean ``bound``. Rows that share a key share its fate.
    """
    total = rows.count()
    if total <= bound:
        return rows
    share = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30))
    return rows.filter(share < int((1 << 30) * bound / total))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values so that near values get unrelated ones."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _RATIO)
_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    """``_RATIO ** i`` for i below n, modulo 2**64."""
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n * 2, _RATIO)]))
    return _POWERS[:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, UTF-8, without copying where there are no nulls."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), offsets


def slices(texts: pa.Array, size: int = 4 * CHUNK) -> Iterator[pa.Array]:
    """The texts in runs of about ``size`` bytes, a larger text on its own: what a task holds per word stays bounded
    by that, whatever Spark puts into a batch."""
    _, offsets = buffers(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield texts.slice(at, to - at)
        at = to


def chunks(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _BLANK, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``size`` that cut no word: a range ends at a blank or where a text ends."""
    at, end = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    while at < end:
        to = min(at + size, end)
        if to < end:
            bound = int(offsets[np.searchsorted(offsets, to)])
            while to < bound and not blank[data[to]]:
                step = data[to : min(to + 4096, bound)]
                hits = np.flatnonzero(blank[step])
                to = to + int(hits[0]) if len(hits) else to + len(step)
        yield at, to
        at = to


def spans(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes from ``lo``, of the words in a range; a text's end also ends a word."""
    inside = ~blank[data[lo:hi]]
    cut = np.zeros(hi - lo + 1, bool)
    cut[offsets[(offsets >= lo) & (offsets <= hi)] - lo] = True
    before = np.empty(hi - lo, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(hi - lo, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends


def span_hashes(folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial from prefix sums, divided by the power at its start."""
    n = len(folded)
    powers = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[folded] * powers[:n], out=sums[1:])
    inverse = np.uint64(pow(int(_RATIO), -1, 1 << 64))
    back = _inverse_powers(n + 1, inverse)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


_BACK = np.ones(1, np.uint64)


def _inverse_powers(n: int, inverse: np.uint64) -> np.ndarray:
    global _BACK
    if len(_BACK) < n:
        _BACK = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n * 2, inverse)]))
    return _BACK[:n]


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, position of each text's first word, with the end as last entry).

    ``lower`` folds A-Z only. Works through about 1 MB at a time, so memory beside the result is bounded by the
    longest word.
    """
    data, offsets = buffers(texts)
    found, starts_at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in chunks(data, offsets):
        starts, ends = spans(data, offsets, lo, hi)
        found.append(span_hashes((_LOWER if lower else _AS_IS)[data[lo:hi]], starts, ends))
        starts_at.append(starts + lo)
    return np.concatenate(found), np.searchsorted(np.concatenate(starts_at), offsets)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its word ``size``-grams, A-Z folded; with fewer words the whole
    sequence counts as one, without words there is none."""
    for part in slices(texts):
        yield from _shingle_sets(part, size)


def _shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    words, at = word_hashes(texts, lower=True)
    for lo, hi in zip(at[:-1], at[1:]):
        own = words[lo:hi]
        if len(own) > size:
            grams = np.zeros(len(own) - size + 1, np.uint64)
            for k in range(size):
                grams = mix(grams * _RATIO + own[k : len(own) - size + 1 + k])
            yield np.unique(grams)
        elif len(own):
            total = np.zeros(1, np.uint64)
            for word in own:
                total = mix(total * _RATIO + word)
            yield total
        else:
            yield own


def text_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two columns that tell rows apart as far as it matters: rows alike in id and text are one."""
    return [F.col(doc_id).alias("_id"), F.xxhash64(F.lit(3), F.col(text)).alias("_text")]


def apart(docs: DataFrame, *known: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """(``docs`` with all columns but ``known`` under names that no operator makes, a function that gives results their
    names back, in their order, and ``more`` columns after them). Names are compared without regard to case, as Spark does."""
    keep = {name.lower() for name in known}
    names = {c: c if c.lower() in keep else f"own_column_{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.toDF(*names.values())
    return renamed, lambda out, *more: out.select(*[F.col(f"`{inside}`").alias(c) for c, inside in names.items()], *more)


def without(docs: DataFrame, marked: DataFrame, doc_id: str = "doc_id", text: str = "text", broadcast_rows: int = 500_000) -> DataFrame:
    """The rows of ``docs`` whose key (see ``text_key``) is not in ``marked`` (_id, _text), a written table.

    Up to ``broadcast_rows`` marks go to every task, which spares the texts a shuffle; more are joined by key.
    """
    if marked.count() <= broadcast_rows:
        marked = F.broadcast(marked)
    keyed = docs.select("*", *[c.alias(f"_own{i}") for i, c in enumerate(text_key(doc_id, text))])
    same = keyed["_own0"].eqNullSafe(marked["_id"]) & (keyed["_own1"] == marked["_text"])
    return keyed.join(marked, same, "left_anti").select(*docs.columns)
