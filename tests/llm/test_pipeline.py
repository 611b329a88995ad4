"""The pipeline, stage by stage, against plain versions of the stages."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm import mixing
from earshot.session import shared_dir
from earshot.sources.store import materialize
from test_joins import filled, linked, overlap, tokens_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_copies", "decontaminate", "mix", "shard"]
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        kept.append(docs.collect())
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    language, near, clean, mixed, shards = kept
    columns = list(source[0].asDict())
    assert all(list(rows[0].asDict()) == columns for rows in kept[:-1]) and list(shards[0].asDict())[: len(columns)] == columns
    # all of these texts have letters and a language that is plain
    assert sorted(language) == sorted(source)
    roots = linked({r.doc_id: r.text for r in language}, 5, 80)
    assert sorted(r.doc_id for r in near) == sorted(i for i in roots if roots[i] == i)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    items = [tokens_of(r.text) for r in bench]
    leaks = {r.doc_id for r in near if any(overlap(r.text, x) for x in items)}
    assert leaks and sorted(r.doc_id for r in clean) == sorted({r.doc_id for r in near} - leaks)
    sizes = Counter()
    for r in clean:
        sizes[r.source] += len(WORD.findall(r.text))
    taken = Counter()
    for r in mixed:
        taken[r.source] += len(WORD.findall(r.text))
    assert taken == {s: round(t) for s, t in filled(sizes, mixing.REPEATS).items()}
    assert sorted(tuple(r)[: len(columns)] for r in shards) == sorted(map(tuple, mixed))


def test_run_keeps_no_input_of_a_stage(spark, sf_dir):
    import glob

    before = set(glob.glob(f"{shared_dir(spark)}/*"))
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    left = {path.rsplit("/", 1)[1] for path in set(glob.glob(f"{shared_dir(spark)}/*")) - before}
    # the last stage's input and what it looks into
    assert {name.split("-")[1] for name in left if name.startswith("pipeline-")} == {"mix"} and not [n for n in left if n.startswith("scratch")]


LONG = " ".join(f"word{i % 977}" for i in range(30_000))
EDGES = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, "?! 12 ...", "en", None), (None, "no id here at all", "en", "b"),
    (None, None, None, None), (5, "the same row twice in the table", "en", "b"), (5, "the same row twice in the table", "en", "b"),
    (6, LONG, "en", ""), (7, "x" * 200_000, "en", "c"), (8, "Das ist ein Satz.\n\nDas ist ein Satz.", "de", "c"), (8, "same id, other text", "en", "c"),
]
CLASHES = ["lang_pred", "score", "ambiguous", "size", "source_size", "target", "taken", "_id", "_text", "_own0", "token", "sig", "n", "_tokens", "_copy",
           "_place", "_key", "Size", "cell"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_edges_of_each_stage(spark, sf_dir, tmp_path, name):
    """Nulls, empty and very long texts, ties and repeated rows, columns with the operators' names, no rows."""
    stage = dict(corpus_pipeline.STAGES)[name]
    names = CLASHES if name != "shard" else [*CLASHES, "_found"]
    names = [n for n in names if n != "Size"]
    docs = spark.createDataFrame(EDGES, "doc_id bigint, text string, lang string, source string")
    docs = docs.select(F.lit("first").alias("SCORE_"), "*", *[F.concat(F.lit("mine "), F.coalesce("source", F.lit("-"))).alias(c) for c in names])
    spark.createDataFrame([(1, "nothing of the kind stands in any of these texts at all"), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage(spark, docs, str(tmp_path))
    rows = out.collect()
    if name != "shard":
        assert out.columns == docs.columns
    assert all(r[n] == f"mine {'-' if r.source is None else r.source}" for r in rows for n in names)
    texts = Counter((r.doc_id, r.text) for r in rows)
    every = Counter((i, t) for i, t, _, _ in EDGES)
    letters = Counter({key: n for key, n in every.items() if re.search("[a-zA-Z]", key[1] or "")})
    wanted = {
        "language": letters, "near_copies": Counter({key: 1 for key in every}), "decontaminate": every, "shard": every,
    }
    if name in wanted:
        assert not texts - wanted[name] and (name == "language" or texts == wanted[name])
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_stage_language_drops_what_has_none(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame([(10**6, "12 34 !"), (10**6 + 1, None), (10**6 + 2, "")], "doc_id bigint, text string")
    mixed = docs.unionByName(more, allowMissingColumns=True)
    assert sorted(r.doc_id for r in corpus_pipeline.identify(spark, mixed, sf_dir).collect()) == sorted(r.doc_id for r in docs.collect())


def test_mix_without_a_number_of_characters(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = corpus_pipeline.mix(spark, docs, sf_dir)
    assert rows.drop("n_chars").exceptAll(corpus_pipeline.mix(spark, docs.drop("n_chars"), sf_dir)).isEmpty()
    assert rows.filter("n_chars <> length(text)").isEmpty()


def test_one_row_of_copies_alike_in_id_and_text(spark):
    copy, near = " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(39))
    rows = [(None, copy, f"s{i % 3}") for i in range(30)] + [(7, near, "s0"), (8, "one row that is here twice", "s1"), (8, "one row that is here twice", "s1")]
    rows += [(9, "same id and text but another source", "s1"), (9, "same id and text but another source", "s2"), (10, "alone among all of these", "s0")]
    rows += [(None, "?!", "s0"), (None, "a text without an id", "s0"), (None, None, "s0"), (None, None, "s0")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    docs = docs.withColumn("more", F.create_map(F.lit("source"), "source"))
    kept = corpus_pipeline.one_of_each(spark, docs, "").collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(
        [(None, copy), (8, rows[31][1]), (9, rows[33][1]), (10, rows[35][1]), (None, "?!"), (None, "a text without an id"), (None, None), (None, None)]
    )
    assert all(r.more == {"source": r.source} for r in kept)
    again = corpus_pipeline.one_of_each(spark, docs.repartition(5), "").collect()
    assert sorted(map(str, again)) == sorted(map(str, kept))
