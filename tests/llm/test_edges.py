"""Every operator over nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from earshot.llm import decontamination, languages, lines, mixing, pieces, quality, sharding, similarity, toxicity, urls

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4), (4, "?! 12 ...", "en", None, 9), (None, "no id here at all", "en", "b", 17),
    (None, None, None, None, None), (5, "the same row twice in the table", "en", "b", 31), (5, "the same row twice in the table", "en", "b", 31),
    (6, LONG, "en", "", len(LONG)), (7, "x" * 300_000, "en", "c", 300_000), (8, "Das ist ein Satz.\n\nDas ist ein Satz.", "de", "c", 36),
    (8, "same id, other text", "en", "c", 19), (9, "a\u0000b \ud7ff \U0001f600 \u00a0 é", "fr", "c", 11),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators make or use inside.
CLASHES = ["score", "lang_pred", "kept", "n_words", "shard", "size", "taken", "token", "_id", "_text", "verdict", "host", "start", "lines", "n", "sig", "a", "b"]


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(ROWS, SCHEMA)
    return plain.select("*", *[F.lit("clash").alias(c) for c in CLASHES if c not in ("_id", "_text")])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, column):
    return spark.createDataFrame([(1, 1), (5, 1), (5, 0), (6, 0), (8, 0), (99, 1), (None, 1), (7, None)], f"doc_id bigint, {column} int")


def by_text(rows, column):
    return {(r.doc_id, (r.text or "")[:20] if r.text is not None else None): r[column] for r in rows}


def test_toxicity(spark, docs, none):
    model = toxicity.fit(docs, labels(spark, "toxic"))
    rows = toxicity.detect(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    empty = [r for r in rows if not (r.text or "").strip() or r.text.startswith("?!")]
    assert len({r.score for r in empty}) == 1 and all(r.passages == [] for r in empty)
    assert toxicity.fit(docs, labels(spark, "toxic").limit(0)) is None and toxicity.fit(none, labels(spark, "toxic")) is None
    assert {r.score for r in toxicity.detect(docs, None).collect()} == {0.0}
    assert toxicity.detect(none, model).count() == 0


def test_quality(spark, docs, none):
    forest = quality.fit(docs, labels(spark, "quality"))
    rows = quality.check(docs, forest).collect()
    assert len(rows) == len(ROWS)
    assert all(r.base_failed and not r.kept and r.n_words == 0 for r in rows if not (r.text or "").strip())
    assert quality.fit(none, None) is None and quality.check(none, None).count() == 0
    assert all(r.kept != r.base_failed and r.anomaly is None for r in quality.check(docs, None).collect())


def test_languages(docs, none):
    model = languages.fit(docs)
    rows = languages.identify(docs, model).collect()
    said = by_text(rows, "lang_pred")
    assert len(rows) == len(ROWS) and said[(1, None)] == said[(2, "")] == said[(4, "?! 12 ...")] == "und"
    assert all(0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0) for r in rows)
    assert languages.fit(none) is None and languages.identify(none, model).count() == 0
    assert {r.lang_pred for r in languages.identify(docs, None).collect()} == {"und"}
    one = languages.fit(docs.filter("lang = 'de'"))
    assert {r.lang_pred for r in languages.identify(docs, one).collect()} == {"und", "de"}


def test_pieces(docs, none):
    rows = pieces.count_tokens(docs, [b" the", b" a", b"b", b"x"]).collect()
    assert len(rows) == len(ROWS) and all(r.n_tokens == 0 for r in rows if not (r.text or "").strip(" \n\t"))
    assert by_text(rows, "n_tokens")[(7, "x" * 20)] == 1  # no piece begins with its first byte
    assert pieces.count_tokens(none, []).count() == 0


def test_lines(docs, none):
    rows = lines.dedup_lines(docs, 3).collect()
    assert len(rows) == len(ROWS)
    # every row is a place: the second of two equal rows repeats the first
    assert sorted(r.text for r in rows if r.doc_id == 5) == ["", "the same row twice in the table"]
    assert [r.text for r in rows if r.doc_id == 8 and r.n_lines == 3] == ["Das ist ein Satz.\n"]
    assert lines.dedup_lines(none).count() == 0


def test_sharding(docs, none):
    rows = sharding.shard(docs, 10_000).collect()
    assert len(rows) == len(ROWS) and all(r.shard_bytes <= 10_000 or r.oversize and r.shard_rows == 1 for r in rows)
    assert {r.doc_id for r in rows if r.oversize} == {6, 7}
    assert sharding.shard(none).count() == 0


def test_similarity(docs, none):
    rows = similarity.similar_components(docs.withColumn("root", F.lit(1))).collect()
    assert len(rows) == len(ROWS)
    assert all(r.n_shingles == 0 and r.root is None and r.component_id == r._id for r in rows if r._id in (1, 2, 3))
    assert {r.component_id for r in rows if r._id == 5} == {5}
    kept = similarity.drop_near_copies(docs).collect()
    assert len(kept) == len(ROWS) and list(kept[0].asDict()) == docs.columns
    assert similarity.similar_components(none).count() == 0 and similarity.drop_near_copies(none).count() == 0


def test_decontamination(spark, docs, none):
    items = [(1, "THE same, row twice in the   table"), (2, None), (3, ""), (4, " ".join(f"word{i}" for i in range(100, 140))), (5, "at all")]
    bench = spark.createDataFrame(items + items[:1], "item_id bigint, text string")
    found = decontamination.overlaps(docs, bench, window=7).collect()
    # items of fewer than eight tokens have to stand as a whole
    assert {(r._id, r.item_id) for r in found} == {(5, 1), (6, 4), (None, 5)}
    left = decontamination.decontaminate(docs, bench).collect()
    assert sorted(str(r.doc_id) for r in left) == sorted(str(r[0]) for r in ROWS if r[0] not in (5, 6) and r[1] != "no id here at all")
    assert decontamination.decontaminate(none, bench).count() == 0
    assert decontamination.decontaminate(docs, bench.limit(0)).count() == len(ROWS)


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.taken <= 3 * r.size for r in rows)
    assert all(r.size == 0 for r in rows if not (r.text or "").strip())
    assert mixing.mixed_rows(mixing.mix(docs)).columns == [c for c in docs.columns if c not in ("size", "taken")]
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(mixing.mix(none)).count() == 0


def test_urls(spark):
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([], "page_id bigint, url string, rule int")
    assert urls.judge(pages, rules).count() == 0
    some = spark.createDataFrame([(1, "http://a.com/x", 5), (1, "http://a.com/x", 5), (None, None, None)], "page_id bigint, url string, rule int")
    rows = urls.judge(some, rules).collect()
    assert sorted(str(r.rule) for r in rows) == ["None", "com/", "com/"]
    assert {r.verdict for r in urls.judge(some, rules.limit(0)).collect()} == {"allow"}
