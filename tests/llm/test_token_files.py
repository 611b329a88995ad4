"""Packed token files: the codec, the encoding of whole texts, the order, and reading at any place."""

import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from earshot.llm import packing

PATH = public_tokenizers.path(packing.VOCABULARY)
DEFINITION = open(PATH, encoding="utf-8").read()
PLAIN = Tokenizer.from_file(PATH)
ALPHABET = "aAé '.,0<|>\t\n\r\x0b\x0c  　 \x1c\x85中😀́s"


def plain_ids(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 32), st.integers(0, 40), st.integers(0, 200), st.integers(0, 2**32))
def test_any_stretch_of_packed_ids(bits, first, n, seed):
    ids = np.random.default_rng(seed).integers(0, 1 << bits, first + n + 7, dtype=np.uint64).astype(np.uint32)
    data = packing.pack(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert packing.unpack(data, bits, first, n).tolist() == ids[first : first + n].tolist()


def test_bits_of_a_vocabulary():
    assert [packing.id_bits(n) for n in (1, 2, 3, 256, 257, 50_257, 65_537, 2**32)] == [1, 1, 2, 8, 9, 16, 17, 32]
    with pytest.raises(ValueError):
        packing.id_bits(2**32 + 1)
    with pytest.raises(ValueError):
        packing.pack(np.array([8], np.uint32), 3)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=ALPHABET, max_size=60), st.text(alphabet="a'.s,(<|>endotx \n÷×éßñΩж", max_size=40), st.just("<|endoftext|> a <|endoftext|>b")), max_size=6))
def test_pieces_give_the_ids_of_the_whole(texts):
    ids, firsts = ENCODER(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:])] == [plain_ids(t)[:-1] for t in texts]


ENCODER = packing.Encoder(DEFINITION)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, encoder = Tokenizer.from_file(path), packing.Encoder(open(path, encoding="utf-8").read())
    assert not encoder.by_piece and ENCODER.by_piece
    texts = ["Some  Words,\nand more", None, "", "x"]
    ids, firsts = encoder(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:])] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def check(found, texts):
    """Against one text after the other, in ascending order of ids, null first."""
    rows = sorted(found.collect(), key=lambda r: r.start)
    wanted = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in rows] == [i for i, _ in wanted]
    own = [plain_ids(t) for _, t in wanted]
    if len({i for i, _ in texts}) == len(texts):
        assert [r.n_tokens for r in rows] == [len(x) for x in own]
        assert [r.ids_crc32 for r in rows] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in own]
    assert [r.start for r in rows] == [0, *accumulate(r.n_tokens for r in rows)][: len(rows)]
    assert sum(r.n_tokens for r in rows) == sum(map(len, own))


def test_query_against_the_plain_encoder(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    check(packing.op11_token_files(spark, sf_dir), docs)


ROWS = [
    (5, None), (3, ""), (9, " \n\t "), (None, "no id"), (None, "no id"), (None, "another without id"), (7, "the same"), (7, "the same"), (7, "another"),
    (8, "word " * 30_000), (6, "x" * 40_000), (2, "a\u0000b ퟿ 😀 é"), (1, "<|endoftext|>"), (-4, "less than none"),
]


@pytest.fixture(scope="module")
def packed(spark, tmp_path_factory):
    docs = spark.createDataFrame(ROWS, "doc_id bigint, text string").selectExpr(
        "*", "1 AS id", "2 AS n", "'c' AS ids", "3 AS tie", "4 AS part", "5 AS start", "'s' AS value"
    )
    path = str(tmp_path_factory.mktemp("packed") / "out")
    packing.PackedTokens.write(docs.repartition(3), path, DEFINITION, block_ids=7)
    return packing.PackedTokens.load(spark, path)


def test_edges(packed):
    found = packed.per_document("bigint", packing.ids_crc32).withColumnRenamed("value", "ids_crc32")
    check(found, ROWS)
    per_text = {}
    for r in found.collect():
        per_text.setdefault(r.doc_id, []).append(r.ids_crc32)
    for i, own in per_text.items():
        assert sorted(own) == sorted(zlib.crc32(np.array(plain_ids(t), "<u4").tobytes()) for j, t in ROWS if j == i)
    assert packed.blocks.filter("size(doc_ids) > 7").isEmpty() and packed.blocks.count() > 5
    same = ["doc_id", "start", "n_tokens"]
    assert sorted(map(str, packed.documents().select(same).collect())) == sorted(map(str, found.select(same).collect()))


def test_windows_at_any_place(packed):
    rows = sorted(packed.ids().collect(), key=lambda r: r.start)
    every = [x for r in rows for x in r.value]
    for first, n in ((0, 1), (0, len(every)), (3, 40), (len(every) - 2, 50), (len(every), 5), (17, 0), (20_000, 3_000)):
        pieces = sorted(packed.window(first, n).collect())
        assert [x for p in pieces for x in p.ids] == every[first : first + n]
        assert all(p.start == first + sum(len(q.ids) for q in pieces[:k]) for k, p in enumerate(pieces))


def test_only_blocks_of_the_window_are_read(packed):
    plan = packed.window(3, 40)._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "LessThan(first" in plan


def test_order_does_not_depend_on_partitions(spark, tmp_path):
    docs = spark.createDataFrame([(i * 37 % 500, f"text number {i * i}") for i in range(500)], "doc_id bigint, text string")
    read = lambda p: sorted(map(tuple, p.per_document("bigint", packing.ids_crc32).collect()))
    one, two = (read(packing.PackedTokens.write(docs.repartition(n), f"{tmp_path}/{n}", DEFINITION)) for n in (2, 7))
    assert one == two and len(one) == 500


def test_ids_of_an_odd_number_of_bits(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id bigint, text string")
    out = packing.PackedTokens.write(docs, f"{tmp_path}/odd", DEFINITION, end_id=100_000, block_ids=40)
    assert {r.bits for r in out.blocks.select("bits").collect()} == {17}
    assert {r.doc_id: r.value for r in out.ids().collect()} == {i: [*plain_ids(f"text {i}")[:-1], 100_000] for i in range(50)}


def test_no_rows_and_other_ids(spark, tmp_path):
    none = packing.PackedTokens.write(spark.createDataFrame([], "doc_id bigint, text string"), f"{tmp_path}/none", DEFINITION)
    assert none.ids().count() == none.documents().count() == none.window(0, 10).count() == 0
    named = spark.createDataFrame([("b", "x y"), ("a", None)], "doc_id string, text string")
    rows = packing.PackedTokens.write(named, f"{tmp_path}/named", DEFINITION, end_id=None).ids().orderBy("start").collect()
    assert [(r.doc_id, r.start, r.value) for r in rows] == [("a", 0, []), ("b", 0, plain_ids("x y")[:-1])]
