"""Repeated runs of lines, found by winnowing over line hashes and cut from all but their first place.

[native] No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from earshot.llm.text import BLANK, apart, text_key, word_count
from earshot.operators.joins import join_unique
from earshot.sources.store import materialize

RUN_WORDS = 50
BROADCAST_ROWS = 500_000
BROADCAST_RUNS = 2_000_000
# The white space that separates words, as characters, and anything else.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]"


def _small(table: DataFrame, rows: int) -> DataFrame:
    """A written table, marked to be sent to every task while it has at most ``rows`` rows."""
    return F.broadcast(table) if table.count() <= rows else table


def _places(keyed: DataFrame, text: str, broadcast_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows that each have an id and text of their own, the other rows of the same ids and texts or None).

    Rows alike in both are numbered in a written table, and the least number is the first place: a number never
    changes, whichever task reads it. Only such rows are written, and no group of them meets in one task.
    """
    alike = keyed.filter(F.col(text).isNotNull()).groupBy("_id", "_text").agg(F.count(F.lit(1)).alias("n"))
    alike = materialize(alike.filter("n > 1").select(F.col("_id").alias("_same_id"), F.col("_text").alias("_same_text")), "alike")
    if alike.isEmpty():
        return keyed, None
    alike = _small(alike, broadcast_rows)
    same = F.col("_id").eqNullSafe(F.col("_same_id")) & (F.col("_text") == F.col("_same_text"))
    copies = materialize(keyed.join(alike, same, "left_semi").withColumn("_number", F.monotonically_increasing_id()), "copies")
    first = materialize(copies.groupBy("_id", "_text").agg(F.min("_number").alias("_number")).select("_number"), "first")
    single = keyed.join(alike, same, "left_anti")
    return (
        single.unionByName(copies.join(first, "_number", "left_semi").drop("_number")),
        copies.join(first, "_number", "left_anti").drop("_number"),
    )


def _lines(keyed: DataFrame, text: str) -> DataFrame:
    """(_id, _text, line, hash, check, words, start): lines with words, numbered as they stand in the text.

    A line is compared without the blanks around it, by two hashes. ``start`` counts the words before it.
    """
    rows = keyed.select("_id", "_text", F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line", "_raw"))
    # the filter looks for one letter only, so words are counted once; trimmed lines have no blanks at their ends
    rows = rows.filter(F.col("_raw").rlike(WORD)).withColumn("_raw", F.btrim("_raw", F.lit(BLANKS)))
    rows = rows.select(
        "_id", "_text", "line", F.xxhash64("_raw").alias("hash"), F.xxhash64(F.lit(1), "_raw").alias("check"),
        F.size(F.split("_raw", BLANK)).cast("long").alias("words"),
    )
    before = W.partitionBy("_id", "_text").orderBy("line").rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))


def _windows(lines: DataFrame, run_words: int) -> DataFrame:
    """(_id, _text, from, to, first, last, print, at, hash, check): for each line the shortest run of at least
    ``run_words`` words that begins, and the one that ends, with it; runs that are both once.

    ``from`` and ``to`` count lines with words, ``first`` and ``last`` all lines. ``print`` is the least line hash of the
    run that begins where this one does, and ``at`` the last line there that has it. ``hash`` and ``check`` tell
    runs apart. A run is decided by its own lines alone, so equal passages give equal runs anywhere.
    """
    text = W.partitionBy("_id", "_text")
    on = text.orderBy("start").rangeBetween(0, run_words - 1)
    back = text.orderBy("end").rangeBetween(-(run_words - 1), 0)
    body = F.struct("hash", "check")
    rows = lines.withColumn("end", F.col("start") + F.col("words"))
    rows = rows.withColumns({
        "n": F.row_number().over(text.orderBy("start")),
        "_long": F.sum("words").over(on) >= run_words,
        "_to": F.count(F.lit(1)).over(on),
        "_last": F.max("line").over(on),
        "_least": F.min(F.struct("hash", (-F.col("line")).alias("back"))).over(on),
        "_body": F.collect_list(body).over(on),
    })
    rows = rows.withColumns({
        "_to": (F.col("n") + F.col("_to") - 1).cast("int"), "_print": F.col("_least.hash"), "_at": -F.col("_least.back"),
        "_hash": F.xxhash64("_body"), "_check": F.xxhash64(F.lit(2), "_body"),
    }).drop("_least", "_body")
    rows = rows.withColumns({
        "_blong": F.sum("words").over(back) >= run_words,
        "_bto": F.first("_to").over(back),
        "_bfrom": F.first("n").over(back),
        "_bfirst": F.first("line").over(back),
        "_bprint": F.first("_print").over(back),
        "_bat": F.first("_at").over(back),
        "_bbody": F.collect_list(body).over(back),
    })
    names = ("from", "to", "first", "last", "print", "at", "hash", "check")
    ahead = ("n", "_to", "line", "_last", "_print", "_at", "_hash", "_check")
    behind = ("_bfrom", "n", "_bfirst", "line", "_bprint", "_bat", F.xxhash64("_bbody"), F.xxhash64(F.lit(2), "_bbody"))

    def run(values):
        return F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(name) for name, v in zip(names, values)])

    both = F.array(F.when(F.col("_long"), run(ahead)), F.when(F.col("_blong") & (F.col("_bto") < F.col("n")), run(behind)))
    return rows.select("_id", "_text", F.explode(both).alias("run")).filter(F.col("run").isNotNull()).select("_id", "_text", "run.*")


def _lookup(rows: DataFrame, table: DataFrame, key: str, how: str, broadcast_rows: int) -> DataFrame:
    """Joins a written table with one row per key: sent to every task while it is small, else dealt out by key."""
    if table.count() <= broadcast_rows:
        return rows.join(F.broadcast(table), key, how)
    return join_unique(rows, table, key, how)


def _matches(keyed: DataFrame, text: str, run_words: int, broadcast_rows: int) -> DataFrame:
    runs = materialize(_windows(_lines(keyed, text), run_words), "runs")
    # positions of a fingerprint: only those met at two places or more go on
    place = F.struct("_id", "_text", "at")
    seen = runs.groupBy("print").agg(F.min(place).alias("a"), F.max(place).alias("b"))
    shared = seen.filter(F.col("a") < F.col("b")).select("print")
    found = _lookup(runs, materialize(shared, "prints"), "print", "left_semi", broadcast_rows).drop("print", "at")
    # each run around such a position meets the first place that has all of its lines
    spot = F.struct("_id", "_text", "from")
    firsts = found.groupBy("hash", "check").agg(F.min(spot).alias("_origin"), F.max(spot).alias("_latest"))
    firsts = firsts.filter(F.col("_origin") < F.col("_latest")).select("hash", F.col("check").alias("_check"), "_origin")
    met = _lookup(found, materialize(firsts, "origins"), "hash", "inner", broadcast_rows)
    met = met.filter((F.col("check") == F.col("_check")) & (F.col("_origin") < spot)).select(
        "_id", "_text", "from", "to", "first", "last", F.col("_origin._id").alias("from_id"), F.col("_origin._text").alias("from_text"),
        (F.col("from") - F.col("_origin.from")).alias("step"),
    )
    # matches grow both ways over neighbours at the same distance; one text's lines are at most as many as it has bytes
    side = ["_id", "_text", "from_id", "from_text", "step"]
    return _islands(met.repartition("_id", "_text"), side).select(
        "_id", "_text", "first", "last", (F.col("to") - F.col("from") + 1).alias("n_lines"), "from_id", "from_text"
    )


def _islands(rows: DataFrame, by: list[str]) -> DataFrame:
    """Stretches (from, to, first, last) of one ``by`` that overlap or touch, as one."""
    order = W.partitionBy(*by).orderBy("from", "to")
    reach = F.max("to").over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_new", F.coalesce(F.col("from") > reach + 1, F.lit(True)).cast("int"))
    rows = rows.withColumn("_part", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(*by, "_part").agg(
        F.min("from").alias("from"), F.max("to").alias("to"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def matches(
    docs: DataFrame, run_words: int = RUN_WORDS, doc_id: str = "doc_id", text: str = "text", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """(_id, _text, first, last, n_lines, from_id, from_text): runs of lines of at least ``run_words`` words that stand
    at an earlier place as well, from line ``first`` to line ``last``, ``n_lines`` with words, and the text that has them.

    Earlier is a text with a smaller id (null first; text hash for equal ids), or an earlier line of the same text. Lines
    without words do not count and do not break a run. Rows alike in id and text count once here.

    Winnowing: the least line hash of every window of at least ``run_words`` words is its fingerprint, so any two
    equal passages of that many words share one. Runs around a position whose fingerprint stands elsewhere too are joined
    with the first place of the same lines, compared by 128 bits, and matches at the same distance grow together
    both ways: runs that begin with a line reach a passage's start, runs that end with one its end. A passage whose
    parts have different first places gives a match with each. No pairs are made: places of equal lines meet in
    a minimum, and come back to it by a lookup.
    """
    keyed = docs.select(F.col(text).alias("_body"), *text_key(doc_id, text))
    return _matches(_places(keyed, "_body", broadcast_rows)[0], "_body", run_words, broadcast_rows)


def _runs(found: DataFrame) -> DataFrame:
    """(_id, _text, runs): per text its matches as stretches (after, first, last) that do not overlap, in order;
    ``after`` is the last line of the stretch before, -1 for none."""
    rows = found.select("_id", "_text", F.col("first").alias("from"), F.col("last").alias("to"), "first", "last")
    runs = _islands(rows.repartition("_id", "_text"), ["_id", "_text"])
    before = F.lag("last", 1, -1).over(W.partitionBy("_id", "_text").orderBy("first"))
    runs = runs.select("_id", "_text", F.struct("first", "last", before.alias("after")).alias("run"))
    return runs.groupBy("_id", "_text").agg(F.array_sort(F.collect_list("run")).alias("runs"))


def repeated_lines(docs: DataFrame, run_words: int = RUN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, _text, lines): the numbers of the lines that repeat an earlier run (see ``matches``), for texts that have
    some. Lines without words never do."""
    runs = materialize(_runs(matches(docs, run_words, doc_id, text)), "repeats").withColumnsRenamed({"_id": "_own", "_text": "_body"})
    keyed = docs.select(F.col(text).alias("_raw"), *text_key(doc_id, text)).dropDuplicates(["_id", "_text"])
    both = keyed.join(runs, F.col("_id").eqNullSafe(F.col("_own")) & (F.col("_text") == F.col("_body")))
    lines = both.select("_id", "_text", F.split("_raw", "\n").alias("_pieces"), F.explode("runs").alias("run")).select(
        "_id", "_text", F.explode(F.filter(
            F.sequence("run.first", "run.last"), lambda i: F.get("_pieces", i).rlike(WORD))).alias("line"))
    return lines.groupBy("_id", "_text").agg(F.array_sort(F.collect_list("line")).alias("lines"))


def dedup_lines(
    docs: DataFrame, run_words: int = RUN_WORDS, doc_id: str = "doc_id", text: str = "text", broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The rows of ``docs`` with ``text`` less its repeated runs, and ``n_lines`` and ``n_removed``; columns of these two
    names are replaced, others keep names and values.

    See ``matches``. Null and empty texts stay as they are; a text that is a repeat as a whole becomes empty, or
    keeps its blank lines. Every row is a place: of rows alike in id and text, null ids included, one is the first, and the
    others lose all their lines with words if they have ``run_words`` words. Lookups of up to ``broadcast_rows`` rows
    go to every task, larger ones are joined by key; the rows are the same.
    """
    inside, named = apart(docs.drop("n_lines", "n_removed"), doc_id, text)
    keyed = inside.select("*", *text_key(doc_id, text))
    first, later = _places(keyed, text, broadcast_rows)
    marked = materialize(_runs(_matches(first, text, run_words, broadcast_rows)), "repeats")
    size = marked.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("runs")), F.lit(0)).alias("runs")).first()
    marked = marked.select(F.col("_id").alias("_of_id"), F.col("_text").alias("_of_text"), F.col("runs").alias("_runs"))
    if size["rows"] <= broadcast_rows and size["runs"] <= BROADCAST_RUNS:
        marked = F.broadcast(marked)  # spares the texts a shuffle
    rows = first.join(marked, F.col("_id").eqNullSafe(F.col("_of_id")) & (F.col("_text") == F.col("_of_text")), "left")
    pieces = F.col("_pieces")

    def wordless(lines):
        return F.filter(lines, lambda x: ~x.rlike(WORD))

    around = F.transform("_runs", lambda r: F.concat(
        F.slice(pieces, r["after"] + 2, r["first"] - r["after"] - 1),
        wordless(F.slice(pieces, r["first"] + 1, r["last"] - r["first"] + 1)),
    ))
    kept = F.concat(F.flatten(around), F.slice(pieces, F.element_at("_runs", -1)["last"] + 2, F.size(pieces)))
    split = F.split(F.col(text), "\n")
    rows = rows.withColumn("_pieces", split).withColumn("_kept", F.when(F.col("_runs").isNotNull(), kept))
    parts = [rows.drop("_of_id", "_of_text", "_runs")]
    if later is not None:
        again = later.withColumn("_pieces", split)
        parts.append(again.withColumn("_kept", F.when(word_count(F.col(text)) >= run_words, wordless(pieces))))
    out = parts[0] if later is None else parts[0].unionByName(parts[1])
    cut = F.col("_kept").isNotNull()
    n_lines = F.coalesce(F.size(pieces), F.lit(0))
    out = out.withColumns({
        text: F.when(cut, F.array_join("_kept", "\n")).otherwise(F.col(text)),
        "n_lines": n_lines, "n_removed": F.when(cut, n_lines - F.size("_kept")).otherwise(0),
    })
    return named(out, "n_lines", "n_removed")


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's number of lines, of lines cut, and a digest of the text that is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def sql(run_words: int = RUN_WORDS) -> str:
    """The same rows, for ids that occur once."""
    return f"""
WITH raw AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line,
         unnest(string_split(coalesce(text, ''), chr(10))) AS raw FROM documents),
l AS (
  SELECT doc_id, line, regexp_replace(raw, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g') AS body,
         len(list_filter(regexp_split_to_array(raw, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::INTEGER AS words FROM raw),
s AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY line)::INTEGER AS upto FROM l WHERE words > 0),
w AS (
  SELECT doc_id, 'on' AS kind, min(line) OVER x AS first, list(line) OVER x AS own, sum(words) OVER x AS n, string_agg(body, chr(10)) OVER x AS run
  FROM (SELECT *, upto - words AS start FROM s)
  WINDOW x AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND {run_words - 1} FOLLOWING)
  UNION ALL
  SELECT doc_id, 'back', min(line) OVER x, list(line) OVER x, sum(words) OVER x, string_agg(body, chr(10)) OVER x
  FROM s WINDOW x AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN {run_words - 1} PRECEDING AND CURRENT ROW)),
f AS (
  SELECT doc_id, first, own, min((doc_id, first)) OVER (PARTITION BY kind, run) AS origin FROM w WHERE n >= {run_words}),
g AS (SELECT DISTINCT doc_id, unnest(own) AS line FROM f WHERE origin < (doc_id, first)),
k AS (
  SELECT raw.doc_id, count(*) AS n_lines, count(g.line) AS n_removed,
         string_agg(raw.raw, chr(10) ORDER BY raw.line) FILTER (g.line IS NULL) AS body
  FROM raw LEFT JOIN g USING (doc_id, line) GROUP BY raw.doc_id)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE n_lines END::INTEGER AS n_lines, n_removed::INTEGER AS n_removed,
       CASE WHEN text IS NOT NULL THEN md5(coalesce(body, '')) END AS text_md5
FROM documents JOIN k USING (doc_id)
"""


SQL = sql()
