"""Near-duplicate components by Jaccard similarity of word shingles, with adaptive multi-match prefixes.

A set starts with a short prefix and goes on to a longer one, at last to the whole set, as long as the lists its members
stand in promise too many candidates. The longer the prefixes of a similar pair, the more members they share, so the
more of its most frequent members a set may leave out: passages that many documents share drop out before pairs are made.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from earshot.llm.components import components
from earshot.llm.text import mix, shingle_sets, text_key, without
from earshot.operators.joins import join_unique
from earshot.sources.store import materialize

WORDS = 5
PERCENT = 80
COST = 200
LONG_COST = 2000
LIST = 64
PIVOTS = 8
ROUNDS = 3
OUTSIDERS = 1000
SKETCH = 8  # 64-bit words
BROADCAST_TEXTS = 500_000
GROUP = 256
ENOUGH = 2  # members that lengthened prefixes share, less what is left out


def _least(n, percent: int):
    """So many members a set of n shares with any similar one, at least; no similar set is smaller."""
    return (percent * n + 99) // 100


def _prefix_length(n, percent: int):
    """Of the n members of a set, so many in a common order that any similar set shares one of its own first such."""
    return n - _least(n, percent) + 1


def _longer(n, percent: int):
    """The lengthened prefix: a similar set then shares 5 or more, one more per 20 members."""
    return _prefix_length(n, percent) + n // 20 + 4


def describe(docs: DataFrame, words: int, percent: int, doc_id: str, text: str, whole: bool = False) -> DataFrame:
    """(_id, _text, n, sig, sketch, prefix) per row: set size, a hash of the whole set, the parity of its members in 512
    cells, and the members of its lengthened prefix, or all with ``whole``, in order of their hashes."""
    kind = "n: bigint, sig: bigint, sketch: array<bigint>, prefix: array<bigint>"

    @F.arrow_udf(f"struct<{kind}>")
    def sets(texts: pa.Array) -> pa.Array:
        n, sig, sketches, prefixes = [], [], [], []
        for own in shingle_sets(texts, words):
            n.append(len(own))
            sig.append(int(mix(mix(own).sum(keepdims=True)).view(np.int64)[0]) if len(own) else 0)
            odd = np.bincount((own & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
            sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            prefixes.append((own if whole else own[: _longer(len(own), percent) if len(own) else 0]).view(np.int64))
        many = pa.list_(pa.int64())
        at = pa.array(np.cumsum([0] + [len(p) for p in prefixes]), pa.int32())
        prefix = pa.ListArray.from_arrays(at, pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)))
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(sig, pa.int64()), pa.array(sketches, many), prefix], ["n", "sig", "sketch", "prefix"]
        )

    return docs.select(*text_key(doc_id, text), sets(F.col(text)).alias("_s")).select("_id", "_text", "_s.*")


def _near(a: str, b: str, percent: int) -> Column:
    """What sizes and sketches allow: members that only one set has, of which differing parities prove at least as
    many, may be so many at most. Never refuses a similar pair."""
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    sizes = F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent
    odd = F.lit(0)
    for k in range(SKETCH):
        odd = odd + F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}")))
    return sizes & (odd * (100 + percent) <= n * (100 - percent))


def _pairs(left: DataFrame, right: DataFrame, percent: int, more: Callable[[str, str], Column] | None = None, often: bool = False) -> DataFrame:
    """(a, b, w), a below b: sets that meet at a token and may be similar, once for each token they meet at. Pairs whose
    weights add up to ``ENOUGH`` are candidates: at the first meeting or, with ``often``, where they meet so often, unless
    the sets are so small that similar ones need not."""
    a, b = left.alias("a"), right.alias("b")
    fits = (F.col("a.token") == F.col("b.token")) & (F.col("a.sig") != F.col("b.sig")) & _near("a", "b", percent)
    if more is not None:
        fits = fits & more("a", "b")
    weight = F.lit(ENOUGH)
    if often:
        weight = F.when(F.least("a.n", "b.n") * percent <= 100 * (ENOUGH - 1), ENOUGH).otherwise(1)
    return a.join(b, fits).select(F.least("a.sig", "b.sig").alias("a"), F.greatest("a.sig", "b.sig").alias("b"), weight.alias("w"))


def _prefixes_meet(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets' lengthened prefixes share as many members as a similar pair of their sizes has to."""
    least = min(len(a), len(b))
    need = min(least // 20 + 5, (percent * least + 99) // 100)
    shared = np.intersect1d(a[: _longer(len(a), percent)], b[: _longer(len(b), percent)], assume_unique=True)
    return len(shared) >= need


class _Verifier:
    """Exact similarity of candidate pairs, from whole texts."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int, percent: int, doc_id: str, text: str):
        self.docs, self.classes, self.words, self.percent = docs, classes, words, percent
        self.doc_id, self.text = doc_id, text

    def _texts(self, wanted: DataFrame) -> DataFrame:
        """(sig, text) of the sets in ``wanted`` (sig); one text of each."""
        wanted = wanted.distinct()
        wanted = self.classes.select("sig", F.col("_row._id").alias("_id"), F.col("_row._text").alias("_text")).join(wanted, "sig", "left_semi")
        wanted = materialize(wanted, "wanted")
        if wanted.count() <= BROADCAST_TEXTS:
            wanted = F.broadcast(wanted)
        keys = text_key(self.doc_id, self.text)
        rows = self.docs.select(keys[0].alias("_own_id"), keys[1].alias("_own_text"), F.col(self.text).alias("text"))
        same = rows["_own_id"].eqNullSafe(wanted["_id"]) & (rows["_own_text"] == wanted["_text"])
        # rows alike in id and text give one
        return materialize(rows.join(wanted, same).groupBy("sig").agg(F.first("text").alias("text")), "texts")

    def whole(self, wanted: DataFrame) -> DataFrame:
        """(sig, n, sketch, prefix) with all members, of the sets in ``wanted`` (sig)."""
        texts = self._texts(wanted)
        return materialize(describe(texts, self.words, self.percent, "sig", "text", whole=True).drop("_id", "_text"), "whole-sets")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """(u, v): the candidates of ``pairs`` (a, b, w) that are similar.

        One of a pair is the hub, and a hub's partners are dealt out in groups, so that one with very many is more
        than one task's work; a task holds one hub's set at a time. The lengthened prefixes are compared first: they
        share one more member for each that they are lengthened by, or the pair is not similar.
        """
        pairs = pairs.groupBy("a", "b").agg(F.sum("w").alias("w")).filter(F.col("w") >= ENOUGH).select("a", "b")
        pairs = materialize(pairs, "pairs")
        texts = self._texts(pairs.select(F.explode(F.array("a", "b")).alias("sig")))
        groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups"))
        dealt = pairs.join(groups, "a").withColumn("g", F.pmod(F.xxhash64("b"), F.col("groups"))).select("a", "g", "b")
        rows = dealt.join(texts, dealt["b"] == texts["sig"]).select("a", "g", F.lit(1).alias("side"), "sig", "text")
        each = groups.join(texts, F.col("a") == F.col("sig")).withColumn("g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)))
        hubs = each.select("a", "g", F.lit(0).alias("side"), "sig", "text")
        ordered = rows.unionByName(hubs).repartition("a", "g").sortWithinPartitions("a", "g", "side")
        words, percent = self.words, self.percent

        def compare(batches):
            hub, place = None, None
            for batch in batches:
                u, v = [], []
                columns = [batch.column(c).to_pylist() for c in ("a", "g", "side", "sig")]
                for a, g, side, sig, own in zip(*columns, shingle_sets(batch.column("text"), words)):
                    if (a, g) != place:
                        place, hub = (a, g), None
                    if side == 0:
                        hub = own
                    elif hub is not None and _prefixes_meet(hub, own, percent):
                        both = len(np.intersect1d(hub, own, assume_unique=True))
                        if 100 * both >= percent * (len(hub) + len(own) - both):
                            u.append(a)
                            v.append(sig)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        return materialize(ordered.mapInArrow(compare, "u bigint, v bigint"), "similar")


def _without_frequent(tokens: DataFrame, total: Column, spare: Column) -> DataFrame:
    """(sig, n, token): of members (sig, n, token) that more than one set has, those that are left once each set leaves out
    its ``spare`` most frequent ones. ``total`` is the number of members it looks at, shared or not."""
    met = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") > 1)
    shared = tokens.join(met, "token")
    own = W.partitionBy("sig")
    # members that no other set has come first in the order by rarity
    place = F.row_number().over(own.orderBy("f", "token")) + total - F.count(F.lit(1)).over(own)
    return shared.withColumn("_place", place).filter(F.col("_place") <= total - spare).select("sig", "n", "token")


def _costed(entries: DataFrame, cost: int) -> DataFrame:
    """``entries`` with ``f``, the length of the list, where it is above 1, and ``few``: whether all lists of the set add up to
    ``cost`` candidates at most."""
    lengths = entries.groupBy("token").agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") > 1)
    listed = materialize(entries.join(lengths, "token"), "listed")
    costs = listed.groupBy("sig").agg((F.sum(F.col("f") - 1) <= cost).alias("few"))
    return materialize(listed.join(costs, "sig"), "costed")


def similar_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text", cost: int = COST,
    long_cost: int = LONG_COST,
) -> DataFrame:
    """(_id, _text, n_shingles, root, component_id) per row of ``docs``; ``root`` tells components apart, null for rows
    without words.

    A row's set are the distinct ``words``-word shingles of its lower-cased (A-Z) text; with fewer words the whole
    sequence, without words nothing. Two rows link when 100 * intersection >= ``percent`` * union; ``component_id``
    is the smallest id reachable by links, the row's own where there are none. Rows with equal sets are one class
    and are not paired. Null, empty and blank texts link with nothing. Null ids take part, but are never smallest
    unless all are null.

    Members are ordered by hash. A similar pair shares a member within the first ``_prefix_length`` of each; if both
    prefixes are longer by l - 1, it shares l, so each set may leave out its l - 2 most frequent members and the
    pair still meets at the two rarest ones it shares. Each set starts with the short prefix. Where the lists its members
    stand in add up to more than ``cost`` candidates, the set uses the lengthened one, and where these are more than
    ``long_cost``, the whole set: it then leaves out as many of its members as it shares with any similar set, less two.
    Sets look through all that use as long a prefix as they do or a longer one, so no pair is left to neither.

    Members of lists that stay long even so, as a large group of near copies makes them, are compared with a few pivots
    first. Only sets that are still outside of the list's main component are then compared with all others in it.
    """
    sets = materialize(describe(docs, words, percent, doc_id, text), "sets")
    classes = sets.filter(F.col("n") > 0).groupBy("sig").agg(
        F.min(F.struct("_id", "_text")).alias("_row"), F.min("_id").alias("_id"), F.count(F.lit(1)).alias("copies"),
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix")
    )
    classes = materialize(classes, "classes")
    n = F.col("n")
    least = lambda size: F.floor((size * percent + 99) / 100)
    p = n - least(n) + 1
    total = F.least("n", p + F.floor(n / 20) + 4)
    placed = F.posexplode("prefix").alias("pos", "token")
    tokens = classes.select("sig", "n", placed).select("token", "sig", "n", (F.col("pos") < p).alias("early"))
    met = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") > 1)
    shared = materialize(tokens.join(met, "token").select("sig", "n", "token", "early", "f"), "shared")
    costs = shared.groupBy("sig").agg(
        F.sum(F.when(F.col("early"), F.col("f") - 1).otherwise(0)).alias("cost"), F.count(F.lit(1)).alias("n_shared")
    )
    sketches = classes.select("sig", *[F.get("sketch", F.lit(k)).alias(f"s{k}") for k in range(SKETCH)])
    # all three meet by set, so this is one pass; members that no other set has come first in the order by rarity
    by_rarity = W.partitionBy("sig").orderBy("f", "token")
    entries = shared.join(costs, "sig").join(sketches, "sig").withColumn(
        "place", F.row_number().over(by_rarity) + total - F.col("n_shared")
    )
    # as many may go as the smallest set that can be similar guarantees to share, less two
    spare = F.greatest(F.lit(0), F.least(F.floor(least(n) / 20) + 5, least(least(n))) - ENOUGH)
    entries = entries.select(
        "token", "sig", "n", *[f"s{k}" for k in range(SKETCH)], (F.col("cost") <= cost).alias("probes"),
        (F.col("early") & (F.col("f") <= cost + 1)).alias("short"), ((F.col("cost") > cost) & (F.col("place") <= total - spare)).alias("long"),
    )
    entries = materialize(entries.filter(F.col("short") | F.col("long")), "entries")
    short = entries.filter("short").drop("short", "long")
    verifier = _Verifier(docs, classes, words, percent, doc_id, text)
    found = _pairs(short.filter("probes"), short, percent)

    low = lambda a, b: F.col(f"{a}.sig") < F.col(f"{b}.sig")
    among = lambda a, b: ~F.col(f"{b}.few") | (F.col(f"{a}.sig") < F.col(f"{b}.sig"))
    long = _costed(entries.filter("long").drop("short", "long", "probes"), long_cost)
    found = found.unionByName(_pairs(long.filter("few"), long, percent, among, often=True))
    many = long.filter(~F.col("few")).select("sig").distinct()
    crowded = None
    if not many.isEmpty():
        sets_whole = verifier.whole(many)
        members = sets_whole.select("sig", "n", F.explode("prefix").alias("token"))
        kept = _without_frequent(members, n, F.greatest(F.lit(0), least(n) - ENOUGH))
        own = sets_whole.select("sig", *[F.get("sketch", F.lit(k)).alias(f"s{k}") for k in range(SKETCH)])
        whole = _costed(kept.join(own, "sig"), long_cost)
        found = found.unionByName(_pairs(whole.filter("few"), whole, percent, among, often=True))
        rest = whole.filter(~F.col("few")).drop("few", "f")
        lengths = rest.groupBy("token").agg(F.count(F.lit(1)).alias("f")).filter(F.col("f") > 1)
        rest = materialize(rest.join(lengths, "token"), "rest")
        crowded = rest.filter(F.col("f") > LIST)
        listed = rest.filter(F.col("f") <= LIST)
        found = found.unionByName(_pairs(listed, listed, percent, low)).unionByName(_pairs(_pivots(crowded, 0), crowded, percent))
    links = components(verifier.verify(found))
    if crowded is not None and not crowded.isEmpty():
        links = _crowded(crowded, links, verifier, percent)
    root = links.select(F.col("u").alias("sig"), F.col("v").alias("root"))
    rooted = classes.select("sig", "_id").join(root, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    smallest = rooted.groupBy("root").agg(F.min("_id").alias("component_id"))
    owner = materialize(rooted.select("sig", "root").join(smallest, "root"), "owners")
    # rows without words are not dealt out by the signature that they share, copies of one text in parts
    worded = join_unique(sets.filter(n > 0).select("sig", "_id", "_text", "n"), owner, "sig", counts=classes.select("sig", F.col("copies").alias("n")))
    none = sets.filter(n == 0).select("_id", "_text", F.col("n").alias("n_shingles"), F.lit(None).cast("bigint").alias("root"), F.col("_id").alias("component_id"))
    return worded.select("_id", "_text", F.col("n").alias("n_shingles"), "root", "component_id").unionByName(none)


def _pivots(entries: DataFrame, turn: int) -> DataFrame:
    """A few entries of each list: the least of each cell by a hash that does not depend on the list, so lists alike
    choose alike. Another turn has other cells."""
    cell = F.pmod(F.xxhash64(F.lit(turn), "sig"), F.lit(PIVOTS)).alias("_cell")
    keep = [c for c in entries.columns if c != "token"]
    chosen = entries.groupBy("token", cell).agg(F.min(F.struct(F.xxhash64("sig").alias("_h"), *keep)).alias("_x"))
    return materialize(chosen.select("token", *[F.col(f"_x.{c}").alias(c) for c in keep]), "pivots")


def _crowded(entries: DataFrame, links: DataFrame, verifier: _Verifier, percent: int) -> DataFrame:
    """Components after all pairs of long lists: ``links``, which the first pivots have joined, and what is missing.

    Two members of a list need no comparison where they are in one component. So those outside of its largest one
    are compared with all others: with pivots among them while they are many, at last each.
    """
    apart = lambda a, b: F.col(f"{a}.label") != F.col(f"{b}.label")
    for turn in range(1, ROUNDS + 1):
        labels = links.select(F.col("u").alias("sig"), F.col("v").alias("label"))
        labelled = entries.join(labels, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
        labelled = materialize(labelled, "labelled")
        sizes = labelled.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k"))
        main = sizes.groupBy("token").agg(F.max_by("label", F.struct("k", "label")).alias("main"))
        outside = labelled.join(main, (labelled["token"] == main["token"]) & (F.col("label") != F.col("main")))
        outside = materialize(outside.select(labelled["*"]), "outside")
        row = outside.groupBy("token").agg(F.count(F.lit(1)).alias("r"), F.first("f").alias("g")).agg(
            F.sum(F.col("r") * F.col("g")).alias("work"), F.sum("g").alias("rows")
        ).first()
        if not row["work"]:
            return links
        last = turn == ROUNDS or row["work"] <= OUTSIDERS * row["rows"]
        found = _pairs(outside if last else _pivots(outside, turn), labelled, percent, apart)
        links = components(links.unionByName(verifier.verify(found)))
        if last:
            return links
    return links


def drop_near_copies(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text", alike: bool = True,
) -> DataFrame:
    """One row of each component, that with the smallest id (of equal ids that with the smallest text hash); all columns
    stay. Rows without words are in no component, and all stay. Rows alike in id and text are one and all stay, unless
    ``alike`` is False: then one of them stays, that with the smallest hash of its columns."""
    found = materialize(similar_components(docs, words, percent, doc_id, text), "components")
    grouped = found.filter(F.col("root").isNotNull()).groupBy("root", "_id", "_text").agg(F.count(F.lit(1)).alias("rows"))
    row = F.struct("_id", "_text")
    kept = grouped.groupBy("root").agg(F.min(row).alias("_kept"))
    stays = materialize(grouped.join(kept, "root").select("_id", "_text", "rows", (row == F.col("_kept")).alias("stays")), "stays")
    left = without(docs, materialize(stays.filter(~F.col("stays")).select("_id", "_text"), "near-copies"), doc_id, text)
    if alike:
        return left
    again = materialize(stays.filter(F.col("stays") & (F.col("rows") > 1)).select("_id", "_text"), "alike")
    return left if again.isEmpty() else _first_alike(left, again, doc_id, text)


def _first_alike(docs: DataFrame, again: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs``, but of those with one key in ``again`` (_id, _text) only that with the smallest hash of its
    columns. Only these rows are grouped, and each task sends one row per key on."""
    hashed = F.xxhash64(*[F.col(f.name) if not _has_map(f.dataType) else F.to_json(F.struct(f.name)) for f in docs.schema])
    keys = text_key(doc_id, text)
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), keys[0].alias("_own_id"), keys[1].alias("_own_text"), hashed.alias("_h"))
    if again.count() <= BROADCAST_TEXTS:
        again = F.broadcast(again)
    same = keyed["_own_id"].eqNullSafe(again["_id"]) & (keyed["_own_text"] == again["_text"])
    one = keyed.join(again, same, "left_semi").groupBy("_own_id", "_own_text").agg(F.min_by("_row", "_h").alias("_row"))
    return without(docs, again, doc_id, text).unionByName(one.select("_row.*"))


def _has_map(kind: DataType) -> bool:
    return '"map"' in kind.json()


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Every document's component of 4-word shingles that are 85 per cent alike."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = similar_components(docs, words=4, percent=85)
    return found.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM w),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.t = b.t AND a.doc_id < b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
l AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT doc_id, len(g)::BIGINT AS n_shingles, least(doc_id, (SELECT min(y) FROM r WHERE x = doc_id)) AS component_id FROM s
"""
