"""Token ids of texts in files of bit-packed blocks, in the order of the documents, and their readers.

A packed table is a parquet folder with one row per block. A block holds the ids of whole documents, each id in the
least number of bits that the vocabulary needs, with the place of every document and of the block itself: numpy unpacks
any stretch of it without reading what lies before. Any store that Spark writes to can hold it.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.text import buffers, slices
from earshot.session import shared_dir
from earshot.sources.store import materialize

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
BLOCK_IDS = 1 << 16
SLICE = 8 << 20  # bytes of texts encoded at once
KNOWN = 100_000  # pieces a process remembers
MAX_BITS = 32
_STEP = 1 << 13  # ids packed at once: a multiple of 8, so that every step ends with a whole byte

# No piece of the usual pre-tokenizer goes on between a character that is no blank and an ASCII blank,
# between a letter and an ASCII mark, or after a line end that stands alone; a text may be cut there without a change of
# its ids, but for marks within special tokens. Characters of two bytes from U+00C0 on are no blanks, those up to
# U+027F letters, but for two signs.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_SHOWN = np.zeros(256, bool)
_SHOWN[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARKS = _SHOWN & ~_LETTER
_MARKS[0x30:0x3A] = False
_PAIR = np.zeros(256, bool)
_PAIR[0xC3:0xE0] = True
_LETTER_PAIR = np.zeros(256, bool)
_LETTER_PAIR[0xC3:0xCA] = True
_SIGNS = np.zeros(256, bool)
_SIGNS[[0x97, 0xB7]] = True
# Pieces with one space at most, at their begin, and no other blank: a line end beside them stays a token of its own.
_SIMPLE = r"^ ?[^\x00-\x20\x{85}\pZ]+$"
_JOINED, _CALL = 200, 50  # pieces in a text, texts in a call


def id_bits(size: int) -> int:
    """Bits of each id below ``size``: 1 at least."""
    bits = max(1, (size - 1).bit_length())
    if bits > MAX_BITS:
        raise ValueError(f"ids of {bits} bits are not offered, {MAX_BITS} is the most")
    return bits


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Id i in the bits from ``i * bits`` on, the least significant one first; the last byte is filled with zeros."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {int(ids.max())} needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    places = np.arange(bits, dtype=np.uint32)
    out = []
    for at in range(0, len(ids), _STEP):
        part = ids[at : at + _STEP].astype(np.uint32)
        out.append(np.packbits(((part[:, None] >> places) & np.uint32(1)).astype(np.uint8), bitorder="little").tobytes())
    return b"".join(out)


def unpack(data: bytes, bits: int, first: int, n: int) -> np.ndarray:
    """The ``n`` ids from place ``first`` on; reads their bytes only."""
    if n <= 0:
        return np.zeros(0, np.uint32)
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n, first * bits // 8).astype(np.uint32)
    lo, hi = first * bits // 8, -(-(first + n) * bits // 8)
    held = np.zeros(hi - lo + 8, np.uint8)
    held[: hi - lo] = np.frombuffer(data, np.uint8, hi - lo, lo)
    at = np.arange(first, first + n, dtype=np.int64) * bits - lo * 8
    byte, shift = at >> 3, (at & 7).astype(np.uint64)
    # an id of up to 32 bits lies within five bytes
    word = np.zeros(n, np.uint64)
    for k in range(5):
        word |= held[byte + k].astype(np.uint64) << np.uint64(8 * k)
    return ((word >> shift) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def units(texts: pa.Array, marks: np.ndarray = _MARKS) -> tuple[pa.Array, np.ndarray]:
    """(pieces of the texts, the number of the first piece of each text and, as last entry, of all).

    Pieces begin at blanks, at ``marks`` after a letter, and after single line ends; in order they are the texts. There is
    no cut beside a character that could be a blank itself.
    """
    data, offsets = buffers(texts)
    lo, hi = int(offsets[0]), int(offsets[-1])
    own = data[lo:hi]
    cut = np.zeros(hi - lo + 1, bool)
    shown, letter = _SHOWN[own], _LETTER[own]
    shown[1:] |= _PAIR[own[:-1]]
    letter[1:] |= _LETTER_PAIR[own[:-1]] & ~((own[:-1] == 0xC3) & _SIGNS[own[1:]])
    cut[1:-1] = _BLANK[own[1:]] & shown[:-1] | marks[own[1:]] & letter[:-1]
    cut[2:-1] |= cut[1:-2] & (own[1:-1] == 0x0A) & (_SHOWN[own[2:]] | _PAIR[own[2:]])
    cut[offsets - lo] = True
    bounds = np.flatnonzero(cut)
    found = pa.LargeStringArray.from_buffers(max(0, len(bounds) - 1), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(own))
    return found, np.searchsorted(bounds, offsets - lo)


class Encoder:
    """Ids of whole texts by a tokenizer of the library ``tokenizers``, without special tokens.

    A byte-level tokenizer with the usual pre-tokenizer treats each piece of ``units`` alone, so it is given every distinct
    piece of a slice once, many in a call with line ends between them. Other tokenizers get whole texts.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        read = json.loads(definition)
        kind = read.get("pre_tokenizer") or {}
        self.by_piece = (
            read.get("normalizer") is None and kind.get("type") == "ByteLevel" and kind.get("use_regex", True)
            and not kind.get("add_prefix_space") and not any(t["lstrip"] or t["rstrip"] for t in read.get("added_tokens", []))
        )
        line_end = self._encode(["\n"])[0]
        self.by_piece = self.by_piece and len(line_end) == 1
        self.line_end = line_end[0] if self.by_piece else None
        self.known: dict[str, bytes] = {}
        self.marks = _MARKS.copy()
        for token in read.get("added_tokens", []):
            self.marks[[byte for byte in token["content"].encode()[1:]]] = False

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [encoding.ids for encoding in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, where each text's begin and, as last entry, their number)."""
        if not self.by_piece:
            lists = self._encode(["" if t is None else t for t in texts.to_pylist()])
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])
        pieces, firsts = units(texts, self.marks)
        coded = pieces.dictionary_encode()
        order = coded.indices.to_numpy()
        flat, starts, sizes = self._pieces(coded.dictionary, np.bincount(order, minlength=len(coded.dictionary)))
        lengths = sizes[order]
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        at = np.arange(ends[-1], dtype=np.int32)
        at += np.repeat((starts[order] - ends[:-1]).astype(np.int32), lengths)
        return flat[at], ends[firsts]

    def _pieces(self, pieces: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each piece begin, how many they are). Pieces that occur ``counts`` times, twice or more,
        are remembered while there is room."""
        names = pieces.to_pylist()
        lists = list(map(self.known.get, names))
        joined = pc.match_substring_regex(pieces, _SIMPLE).to_numpy(zero_copy_only=False)
        joined &= np.fromiter((own is None for own in lists), bool, len(lists))
        starts, sizes, found = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), []
        simple = [names[k] for k in np.flatnonzero(joined)]
        ended = [self.line_end]
        for at in range(0, len(simple), _CALL * _JOINED):
            part = simple[at : at + _CALL * _JOINED]
            for ids in self._encode(["\n".join(part[k : k + _JOINED]) for k in range(0, len(part), _JOINED)]):
                found.append(np.array(ids + ended, np.uint32))
        flat = np.concatenate(found) if found else np.zeros(0, np.uint32)
        marks = np.flatnonzero(flat == self.line_end) if found else np.zeros(0, np.int64)
        if len(marks) != len(simple):
            raise RuntimeError("a line end is not a token of its own")
        starts[joined] = np.concatenate([[0], marks[:-1] + 1]) if len(marks) else marks
        sizes[joined] = marks - starts[joined]
        alone = [k for k, own in enumerate(lists) if own is None and not joined[k]]
        for k, own in zip(alone, self._encode([names[k] for k in alone])):
            lists[k] = np.array(own, np.uint32).tobytes()
        rest = [own for own in lists if own is not None]
        n = np.fromiter(map(len, rest), np.int64, len(rest)) // 4
        starts[~joined] = len(flat) + np.cumsum(n) - n
        sizes[~joined] = n
        flat = np.concatenate([flat, np.frombuffer(b"".join(rest), np.uint32)])
        for k in np.flatnonzero(joined & (counts > 1))[: max(0, KNOWN - len(self.known))].tolist():
            self.known[names[k]] = flat[starts[k] : starts[k] + sizes[k]].tobytes()
        return flat, starts, sizes


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(definition: str) -> Encoder:
    """This process's encoder; one at a time is held."""
    if definition not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[definition] = Encoder(definition)
    return _ENCODERS[definition]


def encode(docs: DataFrame, definition: str, bits: int, end_id: int | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, tie, n, ids) per row of ``docs``: the number of ids of its text, with ``end_id`` at their end, and the ids packed
    to ``bits``. ``tie`` orders rows that share an id, by their text."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # the vocabulary, which does not grow with the texts
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            at = 0
            for texts in slices(batch["text"], SLICE):
                ids, firsts = encoder(texts)
                own = [np.concatenate([ids[a:b], tail]) for a, b in zip(firsts[:-1], firsts[1:])]
                keys = batch.slice(at, len(texts))
                at += len(texts)
                packed = pa.array([pack(x, bits) for x in own], pa.binary())
                n = pa.array([len(x) for x in own], pa.int64())
                yield pa.RecordBatch.from_arrays([keys["id"], keys["tie"], n, packed], ["id", "tie", "n", "ids"])

    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("tie"), F.coalesce(text, F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, tie bigint, n bigint, ids binary")


def _block(part: int, block: int, first: int, bits: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row: the documents of the record batches ``held``."""
    table = pa.Table.from_batches(held).combine_chunks()
    n = table["n"].to_numpy()
    ends = np.concatenate([[0], np.cumsum(n)])
    data = table["ids"].to_pylist()
    if bits % 8:
        data = [pack(np.concatenate([unpack(own, bits, 0, size) for own, size in zip(data, n.tolist())]), bits)]
    rows = pa.array([0, table.num_rows], pa.int32())
    keys = pa.ListArray.from_arrays(rows, table["id"].combine_chunks())
    at = pa.array([ends], pa.list_(pa.int64()))
    columns = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()), pa.array(ends[-1:])]
    columns += [pa.array([bits], pa.int32()), pa.array([b"".join(data)], pa.binary()), keys, at]
    return pa.RecordBatch.from_arrays(columns, ["part", "block", "first", "n_ids", "bits", "data", "doc_ids", "doc_at"])


def _blocks(bits: int, block_ids: int) -> Callable:
    """Sorted documents of a partition to blocks; a block is full once it holds ``block_ids`` ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        part = block = first = count = 0
        for batch in batches:
            ends = np.cumsum(batch["n"].to_numpy())
            at = 0
            while at < batch.num_rows:
                part = batch["part"][0].as_py()
                before = int(ends[at - 1]) if at else 0
                to = min(int(np.searchsorted(ends, before + block_ids - count)) + 1, batch.num_rows)
                held.append(batch.slice(at, to - at))
                count += int(ends[to - 1]) - before
                at = to
                if count >= block_ids:
                    yield _block(part, block, first, bits, held)
                    held, block, first, count = [], block + 1, first + count, 0
        if held:
            yield _block(part, block, first, bits, held)

    return run


@dataclass
class PackedTokens:
    """A packed table: written once, loaded by its path, read as a whole or at any place."""

    blocks: DataFrame
    id_type: str

    @staticmethod
    def schema(id_type: str) -> str:
        """``first`` is the block's place among the ids of its ``part``, ``doc_at`` where each document begins in the block
        and, as last entry, where the last one ends."""
        return (
            "part int, block int, first bigint, n_ids bigint, bits int, data binary, "
            f"doc_ids array<{id_type}>, doc_at array<bigint>"
        )

    @classmethod
    def write(
        cls, docs: DataFrame, path: str, definition: str, end_id: int | None = END_ID, doc_id: str = "doc_id", text: str = "text",
        block_ids: int = BLOCK_IDS,
    ) -> PackedTokens:
        """Encodes whole texts with the tokenizer that ``definition`` (its JSON) defines, without special tokens, ends each
        with ``end_id``, and writes them below ``path``, ordered by id, null first.

        Rows that share an id are ordered by a hash of their text and then by their place, each with its own ids. Null
        texts are encoded like empty ones, whose only id is the last. A document is never cut, so one with more than
        ``block_ids`` ids is a block of its own. An empty table gives a table without blocks. Other columns are not read.

        Texts are encoded once and written; the order is made of the written ids. Its partitions are ranges of (id, text
        hash, place), so that a third of all rows under one id is still dealt out.
        """
        from tokenizers import Tokenizer

        size = max([Tokenizer.from_str(definition).get_vocab_size(), (end_id or 0) + 1])
        bits = id_bits(size)
        coded = materialize(encode(docs, definition, bits, end_id, doc_id, text).withColumn("place", F.monotonically_increasing_id()), "token-ids", "zstd")
        order = [F.asc_nulls_first("id"), "tie", "place"]
        placed = coded.repartitionByRange(*order).sortWithinPartitions(*order)
        id_type = coded.schema["id"].dataType.simpleString()
        rows = placed.select(F.spark_partition_id().alias("part"), "id", "n", "ids")
        rows.mapInArrow(_blocks(bits, block_ids), cls.schema(id_type)).write.mode("overwrite").parquet(path)
        return cls.load(docs.sparkSession, path, id_type)

    @classmethod
    def load(cls, spark: SparkSession, path: str, id_type: str = "bigint") -> PackedTokens:
        return cls(spark.read.schema(cls.schema(id_type)).parquet(path), id_type)

    def starts(self) -> list[tuple[int, int, int]]:
        """(part, its first place among all ids, its ids): one per range partition of the writing job."""
        sizes, out, before = self.blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect(), [], 0
        for row in sorted(sizes):
            out.append((row["part"], before, row["n"]))
            before += row["n"]
        return out

    def _placed(self) -> DataFrame:
        """The blocks with ``start``, their first place among all ids."""
        starts = self.blocks.sparkSession.createDataFrame([s[:2] for s in self.starts()], "part int, _before bigint")
        return self.blocks.join(F.broadcast(starts), "part").withColumn("start", F.col("_before") + F.col("first")).drop("_before")

    def documents(self) -> DataFrame:
        """(doc_id, start, n_tokens) from the blocks' offsets; no id is read."""
        each = F.posexplode("doc_ids").alias("_k", "doc_id")
        rows = self._placed().select("start", "doc_at", each)
        at = F.get("doc_at", F.col("_k"))
        return rows.select("doc_id", (F.col("start") + at).alias("start"), (F.get("doc_at", F.col("_k") + 1) - at).alias("n_tokens"))

    def per_document(self, kind: str, value: Callable[[np.ndarray], object]) -> DataFrame:
        """(doc_id, start, n_tokens, value): ``value`` of each document's ids, a column of the SQL type ``kind``."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    at = np.asarray(batch["doc_at"][row].values)
                    ids = unpack(batch["data"][row].as_buffer(), batch["bits"][row].as_py(), 0, int(at[-1]))
                    made = [value(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
                    columns = [batch["doc_ids"][row].values, pa.array(batch["start"][row].as_py() + at[:-1]), pa.array(np.diff(at)), pa.array(made)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "value"])

        return self._placed().select("start", "bits", "data", "doc_ids", "doc_at").mapInArrow(
            run, f"doc_id {self.id_type}, start bigint, n_tokens bigint, value {kind}"
        )

    def ids(self) -> DataFrame:
        """(doc_id, start, n_tokens, value): the ids of each document as an array."""
        return self.per_document("array<bigint>", lambda own: own.astype(np.int64))

    def window(self, first: int, n: int) -> DataFrame:
        """(start, ids): the ``n`` ids from place ``first`` on, in pieces of a block. Only blocks that hold some are read:
        parts and places within them are conditions that reach the scan. Places past the end hold nothing."""
        spark, last, found = self.blocks.sparkSession, first + n, None
        for part, before, size in self.starts():
            if before < last and before + size > first and n > 0:
                here = self.blocks.filter((F.col("part") == part) & (F.col("first") < last - before) & (F.col("first") + F.col("n_ids") > first - before))
                here = here.select((F.col("first") + before).alias("start"), "n_ids", "bits", "data")
                found = here if found is None else found.unionByName(here)
        if found is None:
            return spark.createDataFrame([], "start bigint, ids array<bigint>")

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, size, bits, data in zip(*(batch[c].to_pylist() for c in ("start", "n_ids", "bits", "data"))):
                    lo, hi = max(first, start), min(last, start + size)
                    own = unpack(data, bits, lo - start, hi - lo).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lo]), pa.array([own], pa.list_(pa.int64()))], ["start", "ids"])

        return found.mapInArrow(run, "start bigint, ids array<bigint>")


def ids_crc32(ids: np.ndarray) -> int:
    """Of the ids as unsigned little-endian 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def op11_token_files(spark, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Every document's place, length and digest, read back from the files. ``vocabulary`` is a file on the driver."""
    import public_tokenizers

    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as lines:
        definition = lines.read()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    packed = PackedTokens.write(docs, f"{shared_dir(spark)}/packed-{uuid.uuid4().hex}", definition)
    return packed.per_document("bigint", ids_crc32).withColumnRenamed("value", "ids_crc32")
