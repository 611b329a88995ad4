"""Classifiers: accuracy on rows they have not seen, and their parts against plain versions."""

import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.llm import languages, pieces, quality, toxicity
from earshot.llm.text import held_out, hash_sample, shingle_sets, word_hashes
from zlib import crc32

BIG = "/root/testdata/sf0.1"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbé ñ\t\n\r\x0b\x0c.|#\u00a0\u2003😀", max_size=60)), max_size=6)


def test_held_out_is_a_quarter_by_checksum(spark):
    rows = spark.range(300).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    assert spark.sql("SELECT cast(null AS bigint) AS id").select(held_out(F.col("id"))).first()[0] is False


def test_sample_is_a_hash_share_and_repeats(spark):
    rows = spark.range(10_000)
    one, two = (sorted(r.id for r in hash_sample(rows, "id", 1_000).collect()) for _ in range(2))
    assert one == two and 850 < len(one) < 1_150
    assert hash_sample(rows, "id", 10_000).count() == 10_000


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from([1, 7, 1 << 20]))
def test_word_hashes_follow_the_words(texts, size):
    import earshot.llm.text as T

    old, T.chunks.__defaults__ = T.chunks.__defaults__, (T._BLANK, size)
    try:
        hashes, at = word_hashes(pa.array(texts, pa.string()))
    finally:
        T.chunks.__defaults__ = old
    words = [WORD.findall(t or "") for t in texts]
    assert np.diff(at).tolist() == [len(w) for w in words]
    seen = {}
    for word, h in zip(itertools.chain.from_iterable(words), hashes.tolist()):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_shingle_sets_by_hand():
    full, short, copy, none, blank = shingle_sets(pa.array(["a b c d e", "A b", "a B", None, " \n"]), 4)
    assert (len(full), len(short), len(none), len(blank)) == (2, 1, 0, 0) and short.tolist() == copy.tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-4, 4), max_size=14))
def test_segments_are_the_maximal_ones(scores):
    x = np.array(scores, float)
    found = toxicity.segments(x)
    # by definition: repeatedly the best segment of what is left, shortest and first of equal ones
    wanted = []

    def take(lo, hi):
        best = max(
            (
                (x[i:j].sum(), -(j - i), -i)
                for i in range(lo, hi) for j in range(i + 1, hi + 1)
            ),
            default=(0, 0, 0),
        )
        if best[0] > 0:
            i, j = -best[2], -best[2] - best[1]
            wanted.append((i, j, best[0]))
            take(lo, i)
            take(j, hi)

    take(0, len(x))
    assert sum(s for *_, s in found) == pytest.approx(sum(s for *_, s in wanted))
    assert sorted(round(s, 6) for *_, s in found) == sorted(round(s, 6) for *_, s in wanted)
    assert all(x[a:b].sum() == pytest.approx(s) and s > 0 for a, b, s in found)
    assert all(b <= c for (_, b, _), (c, _, _) in zip(found, found[1:]))


def test_rate_solves_its_equation():
    x, n = np.array([-0.1, 1.5]), np.array([970.0, 30.0])
    rate = toxicity._rate(x, n)
    p = np.append(n, 1) / (n.sum() + 1)
    assert (p * np.exp(rate * np.append(x, toxicity.HIGH - toxicity.DRIFT))).sum() == pytest.approx(1, abs=1e-6)


def test_toxicity_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    found = toxicity.op1_toxicity(spark, BIG).join(labels, "doc_id").filter("held_out").toPandas()
    hits = ((found.predicted == 1) & (found.toxic == 1)).sum()
    assert hits / (found.predicted == 1).sum() > 0.95 and hits / (found.toxic == 1).sum() > 0.75
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.3)).all()


def test_passages_stand_where_the_words_are(spark):
    clean = [(i, f"one two three four number{i} five six", 0) for i in range(3000)]
    toxic = [(10_000 + i, f"one two rotten vile number{i} five six", 1) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in clean + toxic], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in clean + toxic], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    row = toxicity.detect(spark.createDataFrame([("one two three four five six ROTTEN, vile! one two",)], "text string"), model).first()
    assert [(p.start, p.end) for p in row.passages] == [(6, 8)] and row.passages[0].e_value < 0.01 and row.score > 0.5


def test_passages_are_found_again_and_after_their_words(spark):
    plain = " ".join(["one two three four five six"] * 30)
    clean = [(i, f"one two three four number{i} five six", 0) for i in range(3000)]
    toxic = [(10_000 + i, f"one two rotten vile number{i} five six", 1) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in clean + toxic], "doc_id bigint, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in clean + toxic], "doc_id bigint, toxic int"))
    n = len(plain.split())
    twice = f"rotten vile {plain} rotten vile"
    scattered = f"rotten {plain} vile {plain} rotten vile rotten vile"
    repeated = f"{plain} " + " ".join(["rotten"] * 39)
    rows = [(0, twice), (1, scattered), (2, repeated)]
    found = {r.i: r for r in toxicity.detect(spark.createDataFrame(rows, "i int, text string"), model).collect()}
    assert [(p.start, p.end) for p in found[0].passages] == [(0, 2), (n + 2, n + 4)]
    assert (2 * n + 2, 2 * n + 6) in [(p.start, p.end) for p in found[1].passages]
    assert [(p.start, p.end) for p in found[2].passages] == [(n, n + 39)] and found[2].score > 0.5


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 9, 40])
def test_codewords_tell_classes_apart(n):
    code = languages.codewords(n)
    assert set(np.unique(code)) == {-1.0, 1.0} and (np.abs(code.sum(axis=0)) < n).all()
    distance = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
    assert distance >= (1 if n == 2 else code.shape[1] / (2 if n <= 6 else 5))


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang")
    found = languages.op6_language(spark, BIG).join(docs, "doc_id").filter("held_out").toPandas()
    assert len(found) > 2000 and (found.lang == found.lang_pred).mean() > 0.99 and found.score.between(0, 1).all()
    assert found.ambiguous.mean() < 0.01


def test_one_wrong_bit_is_corrected():
    code = languages.codewords(4)
    bits = code.shape[1]
    model = languages.Model(list("abcd"), code, np.zeros((bits, 1)), np.ones(bits), np.zeros(bits), np.ones((4, bits)))
    for i, b in itertools.product(range(4), range(bits)):
        said = 3 * code[i].copy()
        said[b] *= -1
        best, share = model.decode(said[None])
        assert best[0] == i and 0 < share[0] < 1
    assert model.decode(np.zeros((1, bits)))[0][0] == 0  # all alike: the first by code point


def repeated(words, window=8):
    at = {}
    for i in range(len(words) - window + 1):
        at.setdefault(tuple(words[i : i + window]), []).append(i)
    return len({i + k for places in at.values() if len(places) > 1 for i in places for k in range(window)})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.integers(1, 9))
def test_repeated_words(words, window):
    hashes = np.array([ord(w) for w in words], np.uint64)
    assert quality.repeated_words(hashes, window) == repeated(words, window)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_rule_counts(texts):
    counts, ratios = quality.statistics(pa.array(texts, pa.string()))
    for text, got in zip(texts, counts.tolist()):
        words = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        wanted = [
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or "") if words else 0,
            len(lines) - len(set(lines)), repeated(words),
        ]
        assert got == wanted
    assert np.isfinite(ratios).all()


def test_rules_and_counts_over_the_table(spark, sf_dir):
    found = {r.doc_id: r for r in quality.op2_quality(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for doc_id, text in docs:
        words, r = WORD.findall(text or ""), found[doc_id]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), repeated(words))
        assert r.base_failed == (len(words) < 20 or 100 * r.n_repeat_words > 30 * len(words))
        assert not (r.base_failed and r.kept) and (r.anomaly is None) == r.base_failed


def test_forest_finds_labelled_junk(spark):
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    found = quality.op2_quality(spark, BIG).join(labels, "doc_id").filter("NOT base_failed").toPandas()
    assert found[found.quality == 1].kept.mean() > 0.99 and found[found.quality == 0].kept.mean() < 0.15


def test_path_lengths_are_those_of_the_trees():
    rows = np.random.default_rng(0).normal(size=(300, 3))
    forest = quality.grow(rows, trees=5, tree_rows=32)
    x = np.concatenate([rows[:20], [[9.0, 9.0, 9.0]]])

    def depth(tree, row):
        node = 0
        while forest.left[tree, node] != node:
            node = forest.left[tree, node] if row[forest.feature[tree, node]] < forest.split[tree, node] else forest.right[tree, node]
        return forest.depth[tree, node]

    wanted = [2 ** (-np.mean([depth(t, row) for t in range(5)]) / quality.path_constant(32)) for row in x]
    assert forest.score(x) == pytest.approx(wanted)
    assert forest.score(x)[-1] > np.median(forest.score(rows))
    constant = quality.grow(np.ones((10, 3)), trees=3)
    assert np.isfinite(constant.score(np.ones((2, 3)))).all()


def test_threshold_is_that_of_all_labelled_rows(spark):
    rng = np.random.default_rng(4)
    good = rng.random(3000) < 0.8
    score = np.clip(np.where(good, rng.normal(0.4, 0.05, 3000), rng.normal(0.6, 0.08, 3000)), 0, 1)
    scored = spark.createDataFrame([(i, float(s)) for i, s in enumerate(score)] + [(5000, None), (None, 0.9)], "doc_id bigint, anomaly double")
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)] + [(5000, 0), (9999, 0), (None, 0), (0, None)], "doc_id bigint, quality int")
    cuts = np.unique(score)
    kept = [((score <= c) & good).sum() / good.sum() for c in cuts]
    gain = [k - ((score <= c) & ~good).sum() / (~good).sum() if k >= quality.KEEP_GOOD else -1 for c, k in zip(cuts, kept)]
    assert abs(quality.calibrate(scored, labels) - cuts[int(np.argmax(gain))]) <= 2 / quality.BINS
    assert quality.calibrate(scored, labels.filter("quality = 1")) == quality.calibrate(scored.limit(0), labels) == quality.UNSURE


def test_threshold_keeps_the_good():
    score = np.concatenate([np.linspace(0.3, 0.5, 200), np.linspace(0.45, 0.8, 50)])
    good = np.arange(250) < 200
    order = np.argsort(score)
    cut = quality.threshold(score[order], good[order], ~good[order], 0.995)
    assert (score[good] <= cut).mean() >= 0.995 and (score[~good] > cut).mean() > 0.7


def greedy(word, first, rest):
    n, at = 0, 0
    while at < len(word):
        own = first if at == 0 else rest
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in own), 0)
        if not size:
            return 0
        n, at = n + 1, at + size
    return n


@settings(max_examples=400, deadline=None)
@given(
    st.sets(st.text("abc", min_size=1, max_size=4), max_size=8), st.sets(st.text("abc", min_size=1, max_size=4), max_size=8),
    st.text("abcd", min_size=1, max_size=14),
)
def test_automaton_counts_like_greedy_matching(first, rest, word):
    first, rest = ({p.encode() for p in side} for side in (first, rest))
    assert pieces.Automaton(first, rest).count(word.encode()) == greedy(word.encode(), first, rest)


def test_token_counts_over_the_table(spark, sf_dir):
    vocabulary = pieces.read_vocabulary(pieces.VOCABULARY)
    first = {p for p in vocabulary if p.startswith(b" ")}
    rest = {p for p in vocabulary if not p.startswith(b" ")}
    found = {r.doc_id: r for r in pieces.op8_token_count(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(40).collect()
    for doc_id, text in docs:
        words = WORD.findall(text or "")
        numbers = [greedy(b" " + w.encode(), first, rest) for w in words]
        assert (found[doc_id].n_words, found[doc_id].n_tokens) == (len(words), sum(max(1, n) for n in numbers))
        assert found[doc_id].n_unknown == sum(n == 0 for n in numbers)


def test_a_full_cache_changes_nothing(spark):
    docs = spark.createDataFrame([(1, "ab ab abc zz a"), (2, "abc ab")], "doc_id bigint, text string")
    vocabulary = [b" a", b"b", b" abc"]
    for cache in (1, 100):
        rows = pieces.count_tokens(docs, vocabulary, cache=cache).orderBy("doc_id").collect()
        assert [(r.n_words, r.n_tokens, r.n_unknown) for r in rows] == [(5, 7, 1), (2, 3, 0)]


def test_path_constant():
    assert quality.path_constant(np.array([1, 2])).tolist() == [0, 1] and math.isclose(float(quality.path_constant(64)), 7.4727, rel_tol=0.01)


def test_toxicity_does_not_depend_on_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (3, 8):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            model = toxicity.fit(docs.repartition(n), labels)
            found.append(sorted((r.doc_id, r.score, r.evidence) for r in toxicity.detect(docs, model).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def plain_bins(text):
    """Bins of all grams of a text whose second byte is a letter, one by one."""
    data = (text or "").encode()
    low, before = [], 0
    for x in data:
        letter = 65 <= x <= 90 or 97 <= x <= 122 or x >= 128
        capital = 65 <= x <= 90 or (before == 0xC3 and 0x80 <= x <= 0x9E and x != 0x97)
        low.append((x + 32 if capital else x) if letter else 0)
        before = x
    out = []
    for g, n in enumerate(languages.GRAMS):
        for i in range(len(low) - n + 1):
            if low[i + 1]:
                code = int.from_bytes(bytes(low[i:i + n]), "big")
                out.append((code * 0x9E3779B97F4A7C15 % (1 << 64) >> (64 - languages.BITS_PER_GRAM)) + (g << languages.BITS_PER_GRAM))
    return out


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="aAbzé ÉÖß×.\n语😀", max_size=50)), max_size=6), piece=st.sampled_from([1, 7, 1 << 18]))
def test_gram_bins_and_margins(texts, piece):
    """Grams and sums do not depend on where pieces end."""
    found, rng = [[] for _ in texts], np.random.default_rng(3)
    weights = rng.normal(size=(2, languages._NONE + 1)).astype(np.float32)
    weights[:, -1] = 0
    model = languages.Model(["a", "b"], np.ones((2, 2)), weights, np.ones(2), np.zeros(2), np.ones((2, 2)))
    before, languages.PIECE = languages.PIECE, piece
    try:
        for bins, numbers, starts in languages.gram_bins(pa.array(texts, pa.string())):
            for lo, hi, text in zip(starts, [*starts[1:], bins.shape[1]], numbers):
                found[text] += [b for row in bins[:, lo:hi] for b in row if b != languages._NONE]
        margins = model.margins(pa.array(texts, pa.string()))
    finally:
        languages.PIECE = before
    wanted = [plain_bins(t) for t in texts]
    assert [sorted(x) for x in found] == [sorted(x) for x in wanted]
    for own, z in zip(wanted, margins):
        assert np.allclose(z, weights[:, own].sum(axis=1) / np.sqrt(len(own) + 1), atol=1e-4)


def test_language_counts_and_slopes_by_hand(spark):
    """Log-odds from counts of all rows; slopes and trust from margins of rows that the counts have not seen."""
    rng = np.random.default_rng(8)
    stock = {"de": ["das", "und", "nicht", "schön"], "en": ["the", "and", "not", "nice"], "fr": ["les", "des", "pas", "été"]}
    rows = [(i, " ".join(rng.choice(stock[lang], 6)), lang) for i, lang in enumerate(sorted(stock) * 40)] + [(900, "uno", "it"), (901, None, "de"), (902, "the", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = languages.fit(docs.repartition(5))
    assert model.languages == ["de", "en", "fr", "it"]
    parts = {r.doc_id: r.p for r in docs.select("doc_id", F.expr(f"pmod(xxhash64(9, text), {languages.PARTS})").alias("p")).collect()}

    def weights(rows):
        counts = np.zeros((4, languages._NONE))
        for _, text, lang in rows:
            np.add.at(counts[model.languages.index(lang)], plain_bins(text), 1)
        shares = (counts + languages.SMOOTH) / (counts + languages.SMOOTH).sum(axis=1, keepdims=True)
        return np.stack([np.log(shares[c > 0].mean(axis=0)) - np.log(shares[c < 0].mean(axis=0)) for c in model.code.T])

    used = [r for r in rows if r[1] and r[2]]
    assert np.allclose(model.weights[:, :-1], weights(used), atol=1e-5) and not model.weights[:, -1].any()
    z, of = [], []
    for part in range(languages.PARTS):
        others = weights([r for r in used if parts[r[0]] != part])
        for _, text, lang in [r for r in used if parts[r[0]] == part and r[2] != "it"]:
            own = plain_bins(text)
            z.append(others[:, own].sum(axis=1) / np.sqrt(len(own) + 1))
            of.append(model.languages.index(lang))
    z, sides = np.array(z), model.code[of] > 0
    for b, (slope, shift) in enumerate(zip(model.slope, model.shift)):
        # the best slope and shift have no gradient, but for the pull to 1 and 0
        left = sides[:, b] - 1 / (1 + np.exp(-(slope * z[:, b] + shift)))
        assert abs(left @ z[:, b] - (slope - 1)) < 1e-2 and abs(left.sum() - shift) < 1e-2
    again = languages.fit(docs.repartition(2))
    assert np.array_equal(model.slope, again.slope) and np.array_equal(model.shift, again.shift) and np.array_equal(model.trust, again.trust)
    assert np.allclose(model.trust[3], 1)


def test_pieces_of_long_texts_and_odd_blanks(spark):
    """Texts longer than a piece, empty ones between them and other white space, against one word at a time."""
    first, rest = [b" a", b" ab", b" \xc3\xa9"], [b"b", b"c", b"bc", b"\xc2\xa0"]
    rng = np.random.default_rng(5)
    long = "".join(rng.choice(["a", "b", "c", "é", "\u00a0", " ", "\t", "\n", "\x0b", "\r"], 900_000))
    texts = ["", long, None, " \t", "abc", "", "x" * 2_000_000, long[::-1], "é\u2003a"]
    rows = pieces.count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(2), first + rest).collect()
    automaton = pieces.Automaton(first, rest)
    for r in rows:
        counts = [automaton.count(b" " + w.encode()) for w in WORD.findall(texts[r.doc_id] or "")]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(counts), sum(max(c, 1) for c in counts), counts.count(0))
