"""Token counts by linear longest match: a trie with failure links that knows how many pieces each link pops."""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.text import buffers, chunks, spans

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MARK = b" "
CACHE = 200_000
_WORD_ROOT, _REST_ROOT, _NOWHERE = 0, 1, -1


class Automaton:
    """Greedy longest-match segmentation of a word, counted in one pass over its bytes.

    ``first`` are the pieces a word may begin with, ``rest`` those that may follow. Each trie node has a failure
    link to the node where matching goes on once a byte does not fit, and the number of pieces that are thereby
    complete. Both are set breadth first from the parent's, so building is linear in the vocabulary's bytes.
    """

    def __init__(self, first: Iterable[bytes], rest: Iterable[bytes]):
        self.next: list[dict[int, int]] = [{}, {}]
        self.fail = [_NOWHERE, _NOWHERE]
        self.pops = [0, 0]
        whole = {_WORD_ROOT: False, _REST_ROOT: False}
        for root, pieces in ((_WORD_ROOT, first), (_REST_ROOT, rest)):
            for piece in pieces:
                node = root
                for byte in piece:
                    if byte not in self.next[node]:
                        self.next[node][byte] = len(self.next)
                        whole[len(self.next)] = False
                        self.next.append({})
                        self.fail.append(_NOWHERE)
                        self.pops.append(0)
                    node = self.next[node][byte]
                if node > _REST_ROOT:
                    whole[node] = True
        queue = deque([_WORD_ROOT, _REST_ROOT])
        while queue:
            parent = queue.popleft()
            for byte, node in self.next[parent].items():
                queue.append(node)
                if whole[node]:
                    self.fail[node], self.pops[node] = _REST_ROOT, 1
                    continue
                at, popped = self.fail[parent], self.pops[parent]
                while at != _NOWHERE and byte not in self.next[at]:
                    popped += self.pops[at]
                    at = self.fail[at]
                if at != _NOWHERE:
                    self.fail[node], self.pops[node] = self.next[at][byte], popped

    def count(self, word: bytes) -> int:
        """Number of pieces, or 0 where the vocabulary cannot cover the word."""
        node, pieces = _WORD_ROOT, 0
        following, fail, pops = self.next, self.fail, self.pops
        for byte in word:
            while byte not in following[node]:
                if fail[node] == _NOWHERE:
                    return 0
                pieces += pops[node]
                node = fail[node]
            node = following[node][byte]
        while node != _REST_ROOT:
            if fail[node] == _NOWHERE:
                return 0
            pieces += pops[node]
            node = fail[node]
        return pieces


def read_vocabulary(path: str) -> list[bytes]:
    """Pieces of a file of lines ``base64 rank``. The file is on the driver; its automaton goes to the tasks."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(the different byte strings among spans that do not overlap, for each span the number of its own)."""
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    body = data[np.cumsum(edge[:-1], dtype=np.int8) > 0]
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(body)]).dictionary_encode()
    return words.dictionary, words.indices.to_numpy()


def count_tokens(docs: DataFrame, vocabulary: list[bytes], mark: bytes = MARK, text: str = "text", cache: int = CACHE) -> DataFrame:
    """The rows of ``docs`` with ``n_words``, ``n_tokens`` and ``n_unknown``; columns of these names are replaced.

    Words are runs without blanks. Each is matched with ``mark`` before it; pieces without the mark may follow. A
    word that the vocabulary cannot cover counts as one token and is counted in ``n_unknown``. Null, empty and blank
    texts have zeros. A text goes by in pieces of some 1 MB that cut no word, and each distinct word of a piece is
    matched once. A task remembers up to ``cache`` words and then starts anew; that bounds its memory only.
    """
    made = ("n_words", "n_tokens", "n_unknown")
    automaton = Automaton([p for p in vocabulary if p.startswith(mark)], [p for p in vocabulary if not p.startswith(mark)])
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    known: dict[bytes, int] = {}

    def lengths(words: pa.Array) -> np.ndarray:
        out = np.empty(len(words), np.int64)
        for i, word in enumerate(words.to_pylist()):
            pieces = known.get(word)
            if pieces is None:
                if len(known) >= cache:
                    known.clear()
                pieces = known[word] = shared.value.count(mark + word)
            out[i] = pieces
        return out

    @F.arrow_udf("struct<n_words: bigint, n_tokens: bigint, n_unknown: bigint>")
    def count(texts: pa.Array) -> pa.Array:
        data, offsets = buffers(texts)
        totals = np.zeros((len(made), len(texts)), np.int64)
        for lo, hi in chunks(data, offsets):
            starts, ends = spans(data, offsets, lo, hi)
            distinct, of = distinct_words(data[lo:hi], starts, ends)
            pieces = lengths(distinct)[of]
            # texts of a piece in order; empty ones have no word here
            text = np.searchsorted(offsets, starts + lo, side="right") - 1
            first = np.flatnonzero(np.diff(text, prepend=-1))
            for row, values in enumerate((np.ones_like(pieces), np.maximum(pieces, 1), pieces == 0)):
                if len(first):
                    totals[row, text[first]] += np.add.reduceat(values.astype(np.int64), first)
        return pa.StructArray.from_arrays([pa.array(row) for row in totals], list(made))

    rows = docs.drop(*made)
    return rows.withColumn("_counts", count(F.col(text))).select(*rows.columns, *[F.col(f"_counts.{c}").alias(c) for c in made])


def op8_token_count(spark, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every document's word and token numbers."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, read_vocabulary(vocabulary)).select("doc_id", "n_words", "n_tokens", "n_unknown")
