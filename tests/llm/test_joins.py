"""Similarity join, decontamination, lines, mixing and filters against plain versions."""

import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from earshot.llm import decontamination, lines, mixing, sharding, similarity, urls
from earshot.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def linked(texts, size, percent):
    """id -> smallest id reachable, by comparing all pairs."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def near_texts(seed, n=90):
    """Families of copies with changes, a common line in most texts, exact and short copies."""
    rng, words = random.Random(seed), [f"w{i}" for i in range(300)]
    common = " ".join(words[:12])
    texts, bases = {}, [[rng.choice(words) for _ in range(rng.choice([6, 30, 60]))] for _ in range(6)]
    for i in range(n):
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts[i] = (common + " \n" if rng.random() < 0.7 else "") + " ".join(own)
    return texts | {n: "a b", n + 1: "A  b", n + 2: "", n + 3: None, n + 4: "a"}


@pytest.mark.parametrize("words,percent,cost,long_cost", [(4, 85, 200, 9), (5, 80, 4, 50), (4, 85, 3, 3), (2, 50, 10, 2), (5, 80, 0, 0), (1, 60, 1, 12)])
def test_components_are_those_of_all_pairs(spark, monkeypatch, words, percent, cost, long_cost):
    # small lists and groups, so that long prefixes, pivots and rounds take part
    monkeypatch.setattr(similarity, "LIST", 5)
    monkeypatch.setattr(similarity, "PIVOTS", 2)
    monkeypatch.setattr(similarity, "GROUP", 3)
    texts = near_texts(words + cost)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = similarity.similar_components(docs, words, percent, cost=cost, long_cost=long_cost).collect()
    assert {r._id: r.component_id for r in found} == linked(texts, words, percent)
    assert {r._id: r.n_shingles for r in found} == {i: len(shingles(t, words)) for i, t in texts.items()}


def test_a_passage_that_all_documents_share_makes_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(similarity, "LIST", 5)
    made, plain = [], similarity._pairs
    monkeypatch.setattr(similarity, "_pairs", lambda *a, **b: (made.append(plain(*a, **b)), made[-1])[1])
    footer = " ".join(f"licence{k}" for k in range(60))
    numbers = {}
    for n in (100, 200, 400):
        rng = random.Random(n)
        texts = {i: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) + " " + footer for i in range(n)}
        texts |= {n + i: texts[i] + " more" for i in range(0, n, 10)}  # a tenth has a near copy
        docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
        made.clear()
        found = similarity.similar_components(docs, cost=20, long_cost=40)
        assert {r._id: r.component_id for r in found.collect()} == {i: i - n if i >= n else i for i in texts}
        numbers[n] = sum(pairs.count() for pairs in made)
    assert numbers[400] <= 5 * numbers[100] and numbers[400] < 400 * 20


def test_one_of_each_component_stays(spark):
    texts = near_texts(3, 40)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    kept = sorted(r.doc_id for r in similarity.drop_near_copies(docs).collect())
    roots = linked(texts, 5, 80)
    assert kept == sorted(i for i in texts if roots[i] == i)


def test_query_over_the_table(spark, sf_dir):
    docs = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    found = {r.doc_id: r.component_id for r in similarity.op9_jaccard_join(spark, sf_dir).collect()}
    assert found == linked(docs, 4, 85)


def test_filters_refuse_no_similar_pair():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 80)
        own = rng.sample(range(10_000), n)
        other = own[: rng.randint(max(1, int(0.8 * n)), n)] + rng.sample(range(10_000, 20_000), rng.randint(0, n // 5))
        both, union = len(set(own) & set(other)), len(set(own) | set(other))
        if 100 * both < 85 * union:
            continue
        order = {x: i for i, x in enumerate(rng.sample(range(20_000), 20_000))}
        sets = [sorted(s, key=order.get) for s in (own, other)]
        short = [s[: similarity._prefix_length(len(s), 85)] for s in sets]
        long = [s[: similarity._longer(len(s), 85)] for s in sets]
        least = min(map(len, sets))
        assert set(short[0]) & set(short[1])
        assert len(set(long[0]) & set(long[1])) >= min(least // 20 + 5, (least * 85 + 99) // 100)


@pytest.mark.parametrize("seed", range(4))
def test_components_of_links(spark, seed):
    rng = random.Random(seed)
    n = 60
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    root = {i: i for e in links for i in e}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(links, "u bigint, v bigint"))
    assert {r.u: r.v for r in found.collect()} == {i: find(i) for i in root if find(i) != i}


def test_masks_meet_every_alignment_that_counts():
    for length in range(decontamination.MIN_TOKENS, decontamination.WINDOW + 1):
        for changed in itertools.combinations(range(length), length // 5):
            assert any(
                not {at + k for k in mask} & set(changed)
                for mask in decontamination.MASKS for at in range(length - mask[-1])
            )


#: Scripts without blanks, of which each character is a token.
APART = r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]"


def tokens_of(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub(APART, r" \g<0> ", text or "").lower())


def overlap(text, item):
    """Best alignment by trying all of them; all of the tokens, where there are fewer than 8."""
    t, best = tokens_of(text), None
    if len(item) < 8:
        return next(((k, len(item), len(item)) for k in range(len(t) - len(item) + 1) if item and t[k : k + len(item)] == item), None)
    width = min(15, len(item))
    for shift in range(-len(item) + 1, len(t)):
        equal = [0 <= shift + k < len(t) and t[shift + k] == x for k, x in enumerate(item)]
        if any(100 * sum(equal[s : s + width]) >= 80 * width for s in range(len(item) - width + 1)):
            row = (sum(equal), -max(shift, 0), min(shift + len(item), len(t)) - max(shift, 0))
            best = max(best, row) if best else row
    return best and (-best[1], best[2], best[0])


@pytest.mark.parametrize("broadcast_seeds", [1_000_000, 0])
def test_overlaps_with_substitutions(spark, broadcast_seeds):
    rng, words = random.Random(5), [f"w{i}" for i in range(400)]
    items = {i: [rng.choice(words) for _ in range(rng.choice([1, 2, 5, 7, 8, 9, 12, 15, 30, 50]))] for i in range(30)}
    texts = {}
    for d in range(120):
        own = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        part = list(items[rng.randrange(30)])
        for _ in range(rng.randint(0, len(part) // 4)):
            part[rng.randrange(len(part))] = "other"
        at = rng.randint(0, len(own))
        text = own[:at] + (part[: rng.randint(len(part) // 2, len(part))] if rng.random() < 0.8 else []) + own[at:]
        texts[d] = ", ".join(w.upper() if rng.random() < 0.2 else w for w in text)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, "(" + " ".join(t) + ")") for i, t in items.items()], "item_id bigint, text string")
    rows = decontamination.overlaps(docs, bench, broadcast_seeds=broadcast_seeds).collect()
    found = {(r._id, r.item_id): (r.start, r.n_aligned, r.n_equal) for r in rows}
    wanted = {(d, i): o for d, t in texts.items() for i, x in items.items() if (o := overlap(t, x))}
    assert found == wanted and len(wanted) > 30
    clean = {r.doc_id for r in decontamination.decontaminate(docs, bench).collect()}
    assert clean == set(texts) - {d for d, _ in wanted}


@pytest.mark.parametrize("limits", [{}, {"broadcast_seeds": 0}, {"broadcast_tokens": 0}])
def test_items_long_short_equal_and_without_blanks(spark, limits):
    rng = random.Random(6)
    long = " ".join(f"t{rng.randrange(5000)}" for _ in range(100_000))
    han = "春眠不觉晓处处闻啼鸟夜来风雨声花落知多少"
    items = [(1, long), (2, "four short words here"), (3, "Four short, words HERE!"), (4, "one"), (5, han), (6, "ก่อนที่จะสาย"), (7, "春眠不"), (8, "?!"), (9, ""), (10, None), (None, "one"), (11, han + " and then some more")]
    texts = {
        0: "before it " + long[3000:400_000] + " after", 1: "there are four short words here", 2: "four short words there", 3: "x" + han[:15] + "y",
        4: "春眠 不", 5: "ที่ก่อนที่จะสาย", 6: "春不眠", 7: "someone", 8: "One of one", 9: None, 10: "", 11: " ".join(long.split()[::2]),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.overlaps(docs, bench, **limits).collect()
    found = {(r._id, r.item_id): (r.start, r.n_aligned, r.n_equal) for r in rows}
    # the long item by hand: its own tokens, from the first whole one in the text on
    inside = tokens_of(texts[0])
    assert len(inside) - 4 <= found.pop((0, 1))[2] <= len(inside)
    wanted = {(d, i): o for d, t in texts.items() for i, x in items if i != 1 and (o := overlap(t, tokens_of(x)))}
    assert found == wanted and {(1, 2), (1, 3), (3, 5), (3, 11), (4, 7), (5, 6), (8, 4), (8, None)} <= set(wanted) and len(rows) == len(wanted) + 1


def repeats(texts, run_words):
    """Lines of each text that belong to a run that also stands earlier, by trying all runs."""
    seen, gone = {}, defaultdict(set)
    split = {i: [(k, x.strip(" \t\n\x0b\x0c\r")) for k, x in enumerate((t or "").split("\n"))] for i, t in texts.items()}
    for i in sorted(texts):
        rows = [(k, x) for k, x in split[i] if x]
        for a, b in itertools.combinations(range(len(rows) + 1), 2):
            if sum(len(WORD.findall(x)) for _, x in rows[a:b]) >= run_words:
                seen.setdefault(tuple(x for _, x in rows[a:b]), []).append((i, rows[a][0], [k for k, _ in rows[a:b]]))
    for places in seen.values():
        for i, _, own in sorted(places)[1:]:
            gone[i] |= set(own)
    return {i: sorted(x) for i, x in gone.items()}


@pytest.mark.parametrize("broadcast_rows", [0, lines.BROADCAST_ROWS])
@pytest.mark.parametrize("seed,run_words", [(0, 4), (1, 7), (2, 3), (3, 1)])
def test_repeated_runs(spark, seed, run_words, broadcast_rows):
    rng = random.Random(seed)
    stock = [" ".join(rng.choice("abcdef") for _ in range(rng.choice([0, 1, 1, 2, 3, 5]))) for _ in range(14)]
    texts = {i: "\n".join(rng.choice(["", " "]) + rng.choice(stock) for _ in range(rng.randint(0, 9))) for i in range(25)}
    texts |= {25: None, 26: "", 27: "\n \n"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    wanted = repeats(texts, run_words)
    assert {r._id: r.lines for r in lines.repeated_lines(docs, run_words).collect()} == wanted
    for r in lines.dedup_lines(docs, run_words, broadcast_rows=broadcast_rows).collect():
        rows = (texts[r.doc_id] or "").split("\n")
        left = "\n".join(x for k, x in enumerate(rows) if k not in wanted.get(r.doc_id, ()))
        assert r.text == (None if texts[r.doc_id] is None else left) and r.n_removed == len(wanted.get(r.doc_id, ()))
    # each match stands line for line in the text it names, and is as long as it says
    words = {i: [x.strip() for x in (t or "").split("\n")] for i, t in texts.items()}
    found = lines.matches(docs, run_words, broadcast_rows=broadcast_rows).collect()
    for r in found:
        own = [x for x in words[r._id][r.first:r.last + 1] if x]
        there = [x for x in words[r.from_id] if x]
        assert len(own) == r.n_lines and sum(len(x.split()) for x in own) >= run_words and r.from_id <= r._id
        assert own in [there[k:k + len(own)] for k in range(len(there))]
    covered = defaultdict(set)
    for r in found:
        covered[r._id] |= {k for k in range(r.first, r.last + 1) if words[r._id][k]}
    assert {i: sorted(x) for i, x in covered.items()} == wanted


def test_matches_grow_both_ways(spark):
    """A passage of 40 lines is one match, whatever its windows; its parts that stand earlier elsewhere have their own."""
    passage = [f"line {k} of the passage" for k in range(40)]
    texts = {1: passage, 2: ["before"] + passage + ["after"], 3: passage[5:20] + ["other"] + passage[30:], 4: ["new text " * 30] * 2}
    docs = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts.items()], "doc_id bigint, text string")
    found = {(r._id, r.first, r.last, r.n_lines, r.from_id) for r in lines.matches(docs, 50).collect()}
    assert found == {(2, 1, 40, 40, 1), (3, 0, 14, 15, 1), (3, 16, 25, 10, 1), (4, 1, 1, 1, 4)}


@pytest.mark.parametrize("broadcast_rows", [0, lines.BROADCAST_ROWS])
def test_rows_alike_in_id_and_text_are_places(spark, broadcast_rows):
    body = "\n".join(f"line {k} of a copied text" for k in range(20)) + "\n\n"
    rows = [(None, body, n) for n in range(4)] + [(7, body, 4), (7, body, 5), (None, "few words", 6), (None, "few words", 6), (None, None, 7), (None, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _runs int").withColumn("n_lines", F.lit("mine")).withColumn("_Number", F.lit(1))
    out = lines.dedup_lines(docs.repartition(3), 50, broadcast_rows=broadcast_rows)
    assert out.columns == ["doc_id", "text", "_runs", "_Number", "n_lines", "n_removed"]
    out = out.collect()
    assert len(out) == len(rows) and sorted(r.n_removed for r in out) == [0] * 5 + [20] * 5
    kept = [r for r in out if r.text == body]
    assert len(kept) == 1 and kept[0].doc_id is None
    assert all(r.text == "\n" and r.n_lines == 22 for r in out if r.n_removed) and sum(r.text == "few words" for r in out) == 2


def filled(sizes, repeats=3):
    """Targets by rounds: share, cap, share the rest again."""
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    total, full = sum(sizes.values()), {}
    while True:
        rest, open_ = total - sum(full.values()), [s for s in sizes if s not in full]
        part = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s: repeats * sizes[s] for s in open_ if part[s] > repeats * sizes[s]}
        if not over:
            return full | part
        full |= over


@pytest.mark.parametrize("seed", range(5))
def test_targets_by_rounds(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 1, 3, 10, 100, 5000]) for i in range(rng.randint(1, 12))} | {None: 7}
    rows = spark.createDataFrame([("" if s is None else f"={s}", n) for s, n in sizes.items()], "source_key string, source_size bigint")
    found = {r.source_key: r.target for r in mixing.source_targets(rows).collect()}
    assert found == pytest.approx({"" if s is None else f"={s}": t for s, t in filled(sizes).items()})


def test_mix_is_exact_and_repeats(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(docs).collect()
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert all(taken[s] == round(t) for s, t in target.items())
    key = lambda rows: sorted((r.doc_id, r.taken) for r in rows)
    assert key(rows) == key(mixing.mix(docs.repartition(7)).collect())
    words = Counter()
    for r in mixing.mixed_rows(mixing.mix(docs)).select("source", "text").collect():
        words[r.source] += len(WORD.findall(r.text))
    assert words == taken


def test_rare_parts_of_a_cut_text_keep_their_blanks(spark):
    mixed = spark.createDataFrame([(1, " a\t b  c d", 4, 4, 2.0, 6), (2, "x y", 2, 2, 1.0, 0), (3, "x y", 2, 2, 1.0, 4)],
                                  "doc_id int, text string, size int, source_size int, target double, taken int")
    rows = [tuple(r) for r in mixing.mixed_rows(mixed).orderBy("doc_id", F.length("text")).collect()]
    assert rows == [(1, " a\t b  "), (1, " a\t b  c d"), (3, "x y"), (3, "x y")]


def test_rows_alike_in_everything_share_the_cut(spark):
    docs = spark.createDataFrame([(1, "a b c", "x")] * 9 + [(2, "a b c d e f g h", "y")] * 4, "doc_id bigint, text string, source string")
    rows = mixing.mix(docs).collect()
    for source in "xy":
        own = [r for r in rows if r.source == source]
        assert len({r.taken for r in own}) == 1 and 0 <= own[0].target - sum(r.taken for r in own) < len(own) + 1


def test_a_shard_above_the_limit_is_one_row(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(400)] + [(1000, "y" * 5000)], "doc_id bigint, text string")
    rows = sharding.shard(docs, 300).collect()
    assert len(rows) == 401
    for shard, own in itertools.groupby(sorted(rows, key=lambda r: r.shard), key=lambda r: r.shard):
        own = list(own)
        total = sum(r.n_bytes for r in own)
        assert all(r.shard_bytes == total and r.shard_rows == len(own) and r.depth == len(shard) for r in own)
        assert total <= 300 or len(own) == 1 and own[0].oversize
    leaves = {r.shard for r in rows}
    assert not any(a != b and b.startswith(a) for a in leaves for b in leaves)


@pytest.mark.parametrize("few", [50_000, 0])
def test_copies_of_a_row_are_split(spark, few):
    docs = spark.createDataFrame([(7, "z" * 100)] * 300 + [(None, "n" * 40)] * 50 + [(i, "y" * 70) for i in range(20, 60)], "doc_id bigint, text string")
    docs = docs.repartition(3).selectExpr("*", "map('a', doc_id) AS _key", "1 AS cell", "2 AS _found", "3 AS shard", "4 AS N_Bytes", "5 AS prefix")
    rows = sharding.shard(docs, 1_000, few=few).collect()
    assert len(rows) == 390 and all(r.shard_bytes <= 1_000 for r in rows) and all(r._key == {"a": r.doc_id} and r.prefix == 5 for r in rows)
    for _, own in itertools.groupby(sorted(rows, key=lambda r: r["shard"]), key=lambda r: r["shard"]):
        own = list(own)
        assert {(r.shard_bytes, r.shard_rows) for r in own} == {(sum(r["n_bytes"] for r in own), len(own))}


def test_tables_beyond_few_rows_are_never_sent_to_all_tasks(spark, monkeypatch):
    """Spark's own check sends a written table to all tasks by the size of its files, which is small for numbers in order."""
    docs = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(400)], "doc_id bigint, text string")
    plans, write = [], sharding.materialize

    def noted(df, label):
        plans.append((label, df._jdf.queryExecution().sparkPlan().toString()))
        return write(df, label)

    monkeypatch.setattr(sharding, "materialize", noted)
    found = sharding.shard(docs, 300, few=-1)  # not even empty ones
    plans.append(("found", found._jdf.queryExecution().sparkPlan().toString()))
    joined = {label for label, plan in plans if "Join" in plan}
    assert {"shard-lookup", "found"} <= joined and not [label for label, plan in plans if "Broadcast" in plan]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, sharding.shard(docs, 300).collect()))


def test_shards_as_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 30) for i in range(100)], "doc_id bigint, text string")
    sharding.write_shards(sharding.shard(docs, 500), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.groupBy("shard").agg(F.sum("n_bytes").alias("n")).filter("n > 500").isEmpty()


def judged(url, rules):
    """By definition, rule for rule."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), r[2] == "block", r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.mark.parametrize("broadcast_rules", [100, 0])
def test_rules_by_definition(spark, broadcast_rules):
    rules = urls.RULES + [("a.net", "/p", "block"), ("a.net", "/pq/", "allow"), ("net", "", "allow"), ("b.net", "/x/", "block"), ("b.net", "/x/", "allow")]
    urls_ = [
        None, "", "no scheme", "http://", "http://COM", "http://x.com", "http://x.com/", "HTTP://WWW.Example.COM/en/1?a#b", "ftp://example.com/en",
        "http://example.com/en/", "http://my.www.example.com/en/2", "http://notexample.com/en/x", "https://a.net/pq/1", "https://z.a.net/pqr",
        "http://net/es/", "http://a..net/fr/1", "http://x.net#/es/", "http://x.net?/es/", "http://b.net/x/y", "x://y://net/es/", "http://q.net/es/\n/a",
    ]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls_ + urls_[-3:])], "page_id bigint, url string")
    table = spark.createDataFrame(rules + [(None, "/", "block"), ("q", None, "block")], "host string, path string, verdict string")
    rows = urls.judge(pages, table, broadcast_rules=broadcast_rules).collect()
    assert len(rows) == len(urls_) + 3
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == judged(r.url, rules), r.url


def test_a_site_of_most_pages_is_joined_in_parts(spark, monkeypatch):
    from earshot.operators import joins

    monkeypatch.setattr(joins.join_unique, "__defaults__", ("inner", None, 4, 10))
    table = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    some = [None] * 300 + ["http://example.com/en/1"] * 200 + [f"http://x{i}.net/es/" for i in range(100)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(some)], "page_id bigint, url string").selectExpr("*", "'mine' AS _site", "map('a', url) AS _best")
    found = urls.judge(pages, table)
    assert found.columns == ["page_id", "url", "_site", "_best", "host", "path", "rule", "verdict"]
    for r in found.collect():
        assert (r.host, r.path, r.rule, r.verdict) == judged(r.url, urls.RULES) and r._site == "mine" and r._best == {"a": r.url}
