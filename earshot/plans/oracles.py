"""SQL over the given tables that states what the registered queries have to return."""

from __future__ import annotations

from earshot.operators.lsh import BAND, grades, planes

PURCHASES = """
purchases AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS track_id,
         CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' AND o_custkey % 10 = 0 THEN 'val'
              WHEN o_orderdate >= TIMESTAMP '2000-01-01' AND o_custkey % 10 = 1 THEN 'test'
              ELSE 'train' END AS split,
         CAST(sum(l_quantity) AS BIGINT) AS count
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)"""

PLAYS = """
plays AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS track_id,
         CASE WHEN ts >= TIMESTAMP '2024-01-24' AND user_id % 10 = 0 THEN 'val'
              WHEN ts >= TIMESTAMP '2024-01-24' AND user_id % 10 = 1 THEN 'test'
              ELSE 'train' END AS split,
         count(*) AS count
  FROM events GROUP BY 1, 2, 3)"""

# training rows of the users that are judged, and the id maps fitted on them
JUDGED = """
judged AS (SELECT user_id, track_id, count FROM purchases WHERE split = 'train' AND user_id IN
           (SELECT user_id FROM purchases WHERE split IN ('val', 'test')))"""
MAPS = """
users AS (SELECT user_id, CAST(row_number() OVER (ORDER BY count(*) DESC, user_id) - 1 AS INTEGER) AS ix,
                 count(*) AS n FROM judged GROUP BY user_id),
items AS (SELECT track_id, CAST(row_number() OVER (ORDER BY count(*) DESC, track_id) - 1 AS INTEGER) AS ix,
                 count(*) AS n FROM judged GROUP BY track_id)"""
INDEXED = """
indexed AS (SELECT p.user_id, p.track_id, p.split, p.count, u.ix AS user_ix, i.ix AS item_ix
            FROM purchases p JOIN users u USING (user_id) JOIN items i USING (track_id))"""

NUMBERED = """
numbered AS (SELECT CAST(user_id AS INTEGER) AS user_ix, CAST(track_id AS INTEGER) AS item_ix, split, count
             FROM plays)"""
TRUTH = """
truth AS (SELECT user_ix, item_ix FROM numbered WHERE split = 'test')"""

VECTORS = """
queries AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
items AS (SELECT vec_id AS id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * (1 + vec_id % 5)) AS vec
          FROM embeddings)"""
NORMED = """
normed AS (SELECT id, list_transform(vec, lambda x: x / sqrt(list_inner_product(vec, vec))) AS vec FROM queries)"""
PADDED = """
longest AS (SELECT max(sqrt(list_inner_product(vec, vec))) AS m FROM items),
hashed_queries AS (SELECT id, list_append(vec, CAST(0 AS DOUBLE)) AS vec FROM queries),
hashed_items AS (SELECT id, list_append(vec, sqrt(greatest(m * m - list_inner_product(vec, vec), 0))) AS vec
                 FROM items, longest)"""


def banded(bands: int) -> str:
    """As ``PADDED``, with items padded to the upper end of their band of norms, and ``bands`` (id, band)."""
    return f"""
longest AS (SELECT max(sqrt(list_inner_product(vec, vec))) AS m FROM items),
bands AS (SELECT id, CAST(least(greatest(floor(ln(sqrt(list_inner_product(vec, vec)) / m) / ln({BAND})), 0), {bands - 1}) AS BIGINT) AS band
          FROM items, longest),
hashed_queries AS (SELECT id, list_append(vec, CAST(0 AS DOUBLE)) AS vec FROM queries),
hashed_items AS (SELECT id, list_append(vec, sqrt(greatest(pow(m * pow({BAND}, band), 2) - list_inner_product(vec, vec), 0))) AS vec
                 FROM items JOIN bands USING (id), longest)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def history(k: int) -> str:
    return f"""
lists AS (SELECT * FROM (
    SELECT user_ix, item_ix, count, CAST(row_number() OVER (PARTITION BY user_ix ORDER BY count DESC, item_ix) AS INTEGER) AS rank
    FROM numbered WHERE split = 'train') WHERE rank <= {k})"""


def metrics(k: int) -> str:
    """Per user: distinct true items, hits within ``k`` and average precision over the whole list."""
    return f"""
sizes AS (SELECT user_ix, count(DISTINCT item_ix) AS n_truth FROM truth GROUP BY user_ix),
hits AS (SELECT l.user_ix, l.rank, row_number() OVER (PARTITION BY l.user_ix ORDER BY l.rank) AS so_far
         FROM lists l JOIN (SELECT DISTINCT * FROM truth) t USING (user_ix, item_ix)),
per_user AS (
  SELECT s.user_ix, any_value(s.n_truth) AS n_truth, count(CASE WHEN rank <= {k} THEN 1 END) AS hits_at_k,
         coalesce(sum(so_far / rank), 0) / any_value(s.n_truth) AS average_precision
  FROM sizes s SEMI JOIN lists USING (user_ix) LEFT JOIN hits h USING (user_ix) GROUP BY s.user_ix)"""


def topk(queries: str, items: str, k: int, cosine: bool = False, pairs: str = "") -> str:
    """Exact lists, or with ``pairs`` (query, item) the lists among these candidates."""
    score = "list_inner_product(q.vec, i.vec)"
    if cosine:
        score = f"{score} / sqrt(list_inner_product(q.vec, q.vec)) / sqrt(list_inner_product(i.vec, i.vec))"
    source = f"{queries} q, {items} i"
    if pairs:
        source = f"{pairs} p JOIN {queries} q ON q.id = p.query JOIN {items} i ON i.id = p.item"
    return f"""
scored AS (SELECT q.id AS query, i.id AS item, {score} AS score FROM {source}),
best AS (SELECT * FROM (
    SELECT query, item, score, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS INTEGER) AS rank
    FROM scored) WHERE rank <= {k})"""


def plane_table(tables: int, bits: int, dim: int, seed: int) -> str:
    rows = ",".join(
        f"({table},{bit},[{','.join(map(str, plane))}]::DOUBLE[])"
        for table, side in enumerate(planes(tables, bits, dim, seed).tolist())
        for bit, plane in enumerate(side)
    )
    return f"\nplanes(tbl, bit, plane) AS (VALUES {rows})"


def codes(name: str, source: str) -> str:
    """Bucket of every vector and table."""
    return f"""
{name}_sides AS (SELECT id, tbl, bit, list_inner_product(vec, plane) AS side FROM {source}, planes),
{name} AS (SELECT id, CAST(tbl AS INTEGER) AS tbl,
                  CAST(sum(CASE WHEN side > 0 THEN CAST(1 AS BIGINT) << bit ELSE 0 END) AS BIGINT) AS code
           FROM {name}_sides GROUP BY id, tbl)"""


def looks(name: str, bits: int, probes: int) -> str:
    """The buckets a query looks into: all flips of its bits, cheapest first."""
    return f"""
flips AS (SELECT CAST(range AS BIGINT) AS mask FROM range({2**bits})),
costs AS (SELECT id, tbl, mask, sum(CASE WHEN (mask >> bit) & 1 = 1 THEN abs(side) ELSE 0 END) AS cost
          FROM {name}_sides, flips GROUP BY id, tbl, mask),
looks AS (SELECT * FROM (
    SELECT c.id, c.tbl, xor(k.code, c.mask) AS code,
           CAST(row_number() OVER (PARTITION BY c.id, c.tbl ORDER BY c.cost, c.mask) - 1 AS INTEGER) AS probe
    FROM costs c JOIN {name} k ON c.id = k.id AND c.tbl = k.tbl) WHERE probe <= {probes})"""


def looks_over_bands(name: str, bits: int, bands: int, probes: int) -> str:
    """The buckets of all bands that a query looks into: by the products to be expected, then by the cost of the flips."""
    rows = ",".join(f"({b},{h},{grade})" for b, row in enumerate(grades(bits, bands).tolist()) for h, grade in enumerate(row))
    flips = min(probes, 2**bits - 1)
    return f"""
flips AS (SELECT CAST(range AS BIGINT) AS mask FROM range({2**bits})),
costs AS (SELECT id, tbl, mask, sum(CASE WHEN (mask >> bit) & 1 = 1 THEN abs(side) ELSE 0 END) AS cost
          FROM {name}_sides, flips GROUP BY id, tbl, mask),
cheap AS (SELECT * FROM (
    SELECT id, tbl, mask, row_number() OVER (PARTITION BY id, tbl ORDER BY cost, mask) - 1 AS place FROM costs) WHERE place <= {flips}),
grades(band, differing, grade) AS (VALUES {rows}),
looks AS (SELECT * FROM (
    SELECT c.id, c.tbl, (CAST(g.band AS BIGINT) << {bits}) | xor(k.code, c.mask) AS code,
           CAST(row_number() OVER (PARTITION BY c.id, c.tbl ORDER BY g.grade, c.place) - 1 AS INTEGER) AS probe
    FROM cheap c JOIN {name} k ON c.id = k.id AND c.tbl = k.tbl JOIN grades g ON g.differing = bit_count(c.mask)) WHERE probe <= {probes})"""
