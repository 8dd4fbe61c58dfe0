"""Exact top-k by inner product: best-first search in paged M-trees.

Vectors become integers, floor(1024 x).  With M the greatest norm, adding the
coordinate sqrt(M^2 - |v|^2) to every vector and 0 to a query turns inner
products into distances, d^2 = |q|^2 + M^2 - 2 q.v, so the greatest products
are the nearest neighbours in a metric space.

Rows are dealt to shards of about SHARD vectors by nearest pivot (a bounded
sample) and distance to it; equal vectors, however many, spread over shards by
id.  Each shard is an M-tree stored as a table of pages: entries hold an
object, its covering radius, its distance to the parent object and a child
page.  A ball around each tree (its centre and covering radius) rules out the
queries whose first bound it cannot reach, before anything is shipped.  The
rest of the queries stream through the tree, which is held once for GROUP
queries, so copies of the index stay below the queries that visit it.  A query
takes pages in the order of their least possible distance; the stored parent
distances rule entries out by the triangle inequality before any distance to
them is computed.  Every bound has a margin for rounding, and
candidates are ranked by their exact integer products.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part; a query is compared with vectors of its own length;
a null vec_id is a candidate, ranks last among equals and is no query; of
repeated rows each is a row of its own; fewer than k candidates give fewer
rows; an empty table gives an empty result; products must fit 53 bits.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import python_workers, scratch, table, written
from .graph import tasks_of

SCALE = 1024
SHARD = 4096        # vectors of a tree, at least
MOST_SHARD = 65_536 # and at most: trees grow with the table once there are TREES of them
TREES = 1024
PAGE = 48           # entries of a page
PIVOTS = 64         # sample for dealing rows to shards
PRIMER = 1024       # sample that gives each query a first bound
QUERY_BLOCK = 64    # queries that travel together to a shard
GROUP = 16_384      # queries that visit one copy of a tree
BALLS = 1024        # balls that queries are held against at once
NO_ID = (1 << 63) - 1
PAGE_SCHEMA = ("shard int, dim int, page int, leaf boolean, rids binary, ids binary, objects binary, "
               "radii binary, to_parent binary, children binary")
ARROW = {"int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
PAGE_TYPES = pa.schema([(c.split()[0], ARROW[c.split()[1]]) for c in PAGE_SCHEMA.split(", ")])
BALL = -1           # the page that holds a tree's ball


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """rid (the row), id, dim and v (the integer components)."""
    v = F.col(vec_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return written(df.filter(v.isNotNull() & (F.size(v) > 0) & F.coalesce(good, F.lit(False)))
                   .select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("id"),
                           F.size(v).alias("dim"),
                           F.transform(v, lambda x: F.floor(F.lit(SCALE) * x.cast("double"))).alias("v")),
                   "vectors")


def sample(rows: DataFrame, n: int) -> dict[int, np.ndarray]:
    """At most ``n`` rows, those with the smallest hashes: by length, a matrix
    of rid and components."""
    out: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("rid", F.lit(7)), "rid").limit(n).collect():
        out.setdefault(r.dim, []).append([r.rid, *r.v])
    return {d: np.array(x, np.int64) for d, x in out.items()}


def chained(pivots: np.ndarray) -> np.ndarray:
    """Pivots in an order in which neighbours are near: from the one of
    greatest norm always on to the nearest left.  A shard is a range of this
    order, so the pivots that share one lie together and its ball is small."""
    x = pivots[:, 1:].astype(float)
    left, order = list(range(len(x))), []
    at = int((x ** 2).sum(1).argmax())
    while left:
        left.remove(at)
        order.append(at)
        if left:
            at = left[int(((x[left] - x[at]) ** 2).sum(1).argmin())]
    return pivots[order]


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as an integer matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def nearest(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds each row's nearest pivot and the squared distance to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pivot, near = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = matrix(b.column("v").take(pa.array(at))).astype(float)
                p = pivots.get(int(d), np.zeros((1, d + 1)))[:, 1:].astype(float)
                apart = (x * x).sum(1)[:, None] - 2 * x @ p.T + (p * p).sum(1)
                pivot[at] = apart.argmin(1)
                near[at] = apart.min(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pivot), pa.array(near)],
                                             [*b.schema.names, "pivot", "near"])
    return rows.mapInArrow(run, "rid long, id long, dim int, v array<long>, pivot long, near double")


class Builder:
    """Bulk-loads one M-tree; ``pages`` gets its pages, the root is page 0.
    ``centre`` and ``radius`` are the ball around all: the object nearest to
    the mean, which is the root's parent object."""

    def __init__(self, rids, ids, v, most: float):
        self.rids, self.ids, self.v = rids, ids, v
        extra = np.sqrt(np.maximum(most - (v.astype(float) ** 2).sum(1), 0))
        self.x = np.hstack([v.astype(float), extra[:, None]])
        self.pages: list[dict] = []
        everyone = np.arange(len(v))
        self.centre = int(((self.x - self.x.mean(0)) ** 2).sum(1).argmin())
        self.radius = float(self.apart(everyone, self.centre).max())
        self.build(everyone, self.centre)

    def apart(self, rows: np.ndarray, o: int) -> np.ndarray:
        return np.sqrt(((self.x[rows] - self.x[o]) ** 2).sum(1))

    def build(self, rows: np.ndarray, parent: int) -> int:
        number = len(self.pages)
        page: dict = {"page": number}
        self.pages.append(page)
        if len(rows) <= PAGE:
            objects, radii, children = rows, np.zeros(len(rows)), np.full(len(rows), -1)
        else:
            groups = self.split(rows)
            objects = np.array([o for o, _ in groups])
            radii = np.array([self.apart(g, o).max() for o, g in groups])
            children = np.array([self.build(g, o) for o, g in groups])
        page |= {"leaf": bool(children[0] < 0), "objects": objects, "radii": radii, "children": children,
                 "to_parent": self.apart(objects, parent)}
        return number

    def split(self, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Groups around far-apart objects, at most PAGE of them, each small
        enough that the tree stays shallow; what one object would gather
        beyond that (equal vectors) is cut into even parts."""
        size = max(PAGE, -(-len(rows) // PAGE) * 2)
        seeds, far = [int(rows[0])], self.apart(rows, int(rows[0]))
        wanted = min(PAGE // 2, -(-len(rows) // PAGE))
        while len(seeds) < wanted and far.max() > 0:
            seeds.append(int(rows[far.argmax()]))
            far = np.minimum(far, self.apart(rows, seeds[-1]))
        owner = np.stack([self.apart(rows, s) for s in seeds]).argmin(0)
        out = []
        for k, s in enumerate(seeds):
            own = rows[owner == k]
            own = own[np.argsort(self.apart(own, s), kind="stable")]
            parts = 1 if len(seeds) > 1 and len(own) < len(rows) * 3 // 4 else -(-len(own) // size)
            for g in np.array_split(own, parts):
                if len(g):
                    out.append((s if len(g) == len(own) else int(g[0]), g))
        return out


def build(rows: DataFrame, most: float, shards: int, pivots: dict[int, np.ndarray]) -> DataFrame:
    """The page table of all shards."""
    dealt = (nearest(rows, pivots).repartitionByRange(shards, "dim", "pivot", "near", "rid")
             .sortWithinPartitions("dim", "pivot", "near", "rid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, held, last = TaskContext.get().partitionId(), [], None

        def trees(t: pa.Table, dim: int) -> Iterator[pa.RecordBatch]:
            b = Builder(t["rid"].to_numpy(), t["id"].to_numpy(), matrix(t["v"].combine_chunks()), most)
            raw = lambda x, kind: np.ascontiguousarray(x, kind).tobytes()
            ball = {"page": BALL, "leaf": False, "objects": np.array([b.centre]), "radii": np.array([b.radius]),
                    "to_parent": np.zeros(1), "children": np.zeros(1)}
            out = [{"shard": shard, "dim": dim, "page": p["page"], "leaf": p["leaf"],
                    "rids": raw(b.rids[p["objects"]], np.int64), "ids": raw(b.ids[p["objects"]], np.int64),
                    "objects": raw(b.v[p["objects"]], np.int64), "radii": raw(p["radii"], float),
                    "to_parent": raw(p["to_parent"], float), "children": raw(p["children"], np.int64)}
                   for p in [ball, *b.pages]]
            yield pa.RecordBatch.from_pylist(out, PAGE_TYPES)

        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                if last is not None and d != last:
                    yield from trees(pa.Table.from_batches(held), int(last))
                    held = []
                at = np.flatnonzero(dims == d)
                held.append(b.slice(int(at[0]), len(at)))
                last = d
        if held:
            yield from trees(pa.Table.from_batches(held), int(last))

    cast = dealt.withColumn("id", F.coalesce("id", F.lit(NO_ID)))
    return written(cast.mapInArrow(run, PAGE_SCHEMA), "pages")


def query_blocks(queries: DataFrame, primer: dict[int, np.ndarray], k: int) -> DataFrame:
    """Queries packed by QUERY_BLOCK, in the columns of a page: rids, ids,
    objects (the queries), and in ``radii`` a first bound: the k-th best
    product among the primer rows other than its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                for lo in range(0, len(at), QUERY_BLOCK):
                    part = b.take(pa.array(at[lo:lo + QUERY_BLOCK]))
                    rid, q = part.column("rid").to_numpy(), matrix(part.column("v"))
                    p = primer.get(int(d), np.zeros((0, d + 1), np.int64))
                    s = np.where(rid[:, None] == p[:, 0], -np.inf, (q @ p[:, 1:].T).astype(float))
                    first = np.sort(s, 1)[:, -k] if s.shape[1] >= k else np.full(len(q), -np.inf)
                    yield pa.RecordBatch.from_pydict({
                        "dim": pa.array([d], pa.int32()), "rids": [rid.tobytes()],
                        "ids": [part.column("id").to_numpy().tobytes()], "objects": [q.tobytes()],
                        "radii": [first.tobytes()]})

    return written(queries.mapInArrow(run, "dim int, rids binary, ids binary, objects binary, radii binary"), "queries")


def streamed(held: DataFrame, rows: DataFrame, keys: list[str], ask: Callable, schema: str) -> DataFrame:
    """``ask(held rows, row)`` for each of ``rows``, next to the rows of
    ``held`` with the same keys: these come first in a sorted partition and
    are all that a task keeps; the others stream past.  Both sides have
    columns of a page; ``rows`` have no page number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine, ready = None, [], None
        for b in batches:
            for row in (r for lo in range(0, b.num_rows, 16) for r in b.slice(lo, 16).to_pylist()):
                key = tuple(row[c] for c in keys)
                if key != last:
                    last, mine, ready = key, [], None
                if row["page"] is not None:
                    mine.append(row)
                elif mine:
                    ready = ready or Tree(mine)
                    yield from ask(ready, row)

    both = held.unionByName(rows, allowMissingColumns=True)
    return (both.repartition(tasks_of(held), *keys).sortWithinPartitions(*keys, F.col("page").asc_nulls_last())
            .mapInArrow(run, schema))


class Tree:
    """Pages as :func:`search_tree` reads them, and the balls among them."""

    def __init__(self, rows: list[dict]):
        d = rows[0]["dim"]
        self.pages = {r["page"]: (r["leaf"], *[np.frombuffer(r[c], np.int64) for c in ("rids", "ids")],
                                  np.frombuffer(r["objects"], np.int64).reshape(-1, d),
                                  *[np.frombuffer(r[c], float) for c in ("radii", "to_parent")],
                                  np.frombuffer(r["children"], np.int64)) for r in rows if r["page"] >= 0}
        balls = [r for r in rows if r["page"] == BALL]
        self.shards = [r["shard"] for r in balls]
        self.centres = np.frombuffer(b"".join(r["objects"] for r in balls), np.int64).reshape(-1, d)
        self.radii = np.frombuffer(b"".join(r["radii"] for r in balls), float)


def block_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (*[np.frombuffer(row[c], np.int64) for c in ("rids", "ids")],
            np.frombuffer(row["objects"], np.int64).reshape(-1, row["dim"]), np.frombuffer(row["radii"], float))


def reaches(square: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The distance within which products of at least ``score`` lie, with a
    margin for rounding; ``square`` is the query's part of the distances."""
    margin = 1e-6 * (1 + np.sqrt(square))
    return np.where(score == -np.inf, np.inf, np.sqrt(np.maximum(square - 2 * score, 0)) + margin)


def visits(pages: DataFrame, blocks: DataFrame, most: float) -> DataFrame:
    """Blocks of the queries that may find something in a shard, for every
    shard; ``to_parent`` is their distance to its centre.  Balls are dealt in
    chunks of BALLS, each held by as many tasks as there are, so that neither
    a length nor a chunk has a task of its own."""
    salts = tasks_of(blocks)
    balls = (pages.filter(F.col("page") == BALL).withColumn("chunk", F.expr(f"shard div {BALLS}").cast("int"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    chunks = pages.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0] // BALLS + 1
    asked = blocks.withColumn("salt", F.pmod(F.xxhash64("rids"), F.lit(salts)).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def ask(tree: Tree, row: dict) -> Iterator[pa.RecordBatch]:
        rids, ids, q, bounds = block_of(row)
        square = (q.astype(float) ** 2).sum(1) + most
        apart = np.sqrt(np.maximum(square[:, None] - 2 * (q @ tree.centres.T).astype(float), 0))
        near = apart - tree.radii <= reaches(square, bounds)[:, None]
        raw = {"rids": rids, "ids": ids, "objects": q, "radii": bounds}
        out = [{"shard": tree.shards[j], "dim": row["dim"], "to_parent": apart[near[:, j], j].tobytes()}
               | {c: x[near[:, j]].tobytes() for c, x in raw.items()} for j in np.flatnonzero(near.any(0))]
        for lo in range(0, len(out), 64):
            yield pa.RecordBatch.from_pylist(out[lo:lo + 64], pa.schema([PAGE_TYPES.field(c) for c in VISIT]))

    return streamed(balls, asked, ["dim", "chunk", "salt"], ask,
                    ", ".join(c for c in PAGE_SCHEMA.split(", ") if c.split()[0] in VISIT))


VISIT = [c for c in PAGE_TYPES.names if c not in ("page", "leaf", "children")]


def search_tree(pages: dict[int, tuple], q: np.ndarray, own: int, bound: float, most: float, k: int,
                computed: list[int] | None = None, to_centre: float = -1.0) -> list[tuple[int, int, int]]:
    """The k best (score, id, rid) of one tree, scores below ``bound`` left
    out.  ``pages`` maps a number to (leaf, rids, ids, objects, radii,
    to_parent, children); ``computed[0]`` counts the distances computed,
    ``to_centre`` is the known distance to the tree's centre, if not negative."""
    square = float((q.astype(float) ** 2).sum()) + most

    def radius(score: float) -> float:
        return float(reaches(square, score))

    best: list[tuple[int, int, int]] = []  # heap: the worst of the k best first, as (score, -id, -rid)
    reach = radius(bound)
    todo = [(0.0, 0, to_centre)]  # least possible distance, page, distance of the query to the page's parent object
    while todo:
        least, number, to_query = heapq.heappop(todo)
        if least > reach:
            break
        leaf, rids, ids, objects, radii, to_parent, children = pages[number]
        at = np.arange(len(rids))
        if to_query >= 0:
            at = at[np.abs(to_query - to_parent) - radii <= reach]
        if not len(at):
            continue
        scores = objects[at] @ q
        if computed is not None:
            computed[0] += len(at)
        if leaf:
            for s, i, r in zip(scores.tolist(), ids[at].tolist(), rids[at].tolist()):
                if r != own and s >= bound:
                    entry = (s, -i, -r)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            if len(best) == k:
                reach = min(reach, radius(best[0][0]))
        else:
            apart = np.sqrt(np.maximum(square - 2 * scores.astype(float), 0))
            floor = np.maximum(apart - radii[at], 0)
            for f, c, d in zip(floor.tolist(), children[at].tolist(), apart.tolist()):
                if f <= reach:
                    heapq.heappush(todo, (max(f, least), c, d))
    return [(s, -i, -r) for s, i, r in best]


def searcher(most: float, k: int) -> Callable:
    """What :func:`streamed` asks of a tree: the finds of a block's queries."""
    def ask(tree: Tree, row: dict) -> Iterator[pa.RecordBatch]:
        rids, ids, q, bounds = block_of(row)
        out = [(rid, qid, i, r, s)
               for rid, qid, v, bound, apart in zip(rids.tolist(), ids.tolist(), q, bounds.tolist(),
                                                    np.frombuffer(row["to_parent"], float).tolist())
               for s, i, r in search_tree(tree.pages, v, rid, bound, most, k, to_centre=apart)]
        if out:
            cols = np.array(out, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["qrid", "query_id", "vec_id", "rid", "score"])
    return ask


def top_k(df: DataFrame, k: int = 10, *, is_query: Column | None = None, id_col: str = "vec_id",
          vec_col: str = "embedding", shard: int = SHARD) -> DataFrame:
    """For each query row its k candidates of greatest integer inner product:
    query_id, rank, vec_id, score; ties to the smaller vec_id."""
    python_workers(df.sparkSession, rows=1024)
    with scratch(df.sparkSession) as keep:
        rows = vectors(df, id_col, vec_col)
        n, norm = rows.agg(F.count("*"), F.max(F.aggregate(
            "v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x))).first()
        most = float(norm or 0)
        shards = max(1, -(-n // max(shard, min(MOST_SHARD, n // TREES))))
        pivots = {d: chained(p) for d, p in sample(rows, PIVOTS).items()}
        pages = build(rows, most, shards, pivots)
        queries = rows.filter(F.pmod("id", F.lit(100)) == 0 if is_query is None else is_query)
        blocks = query_blocks(queries, sample(rows, PRIMER), k)
        groups = -(-max(1, blocks.count()) * QUERY_BLOCK // GROUP)
        jobs = written(visits(pages, blocks, most).withColumn(
            "group", F.pmod(F.xxhash64("rids"), F.lit(groups)).cast("int")), "visits")
        trees = pages.filter(F.col("page") != BALL).join(
            jobs.select("shard", "dim", "group").distinct(), ["shard", "dim"])
        found = keep(streamed(trees, jobs, ["shard", "dim", "group"], searcher(most, k),
                              "qrid long, query_id long, vec_id long, rid long, score long"), "llm-found")
    from pyspark.sql import Window
    order = Window.partitionBy("qrid").orderBy(F.col("score").desc(), "vec_id", "rid")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score"))


def op10_topk_search(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), 10)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, k::INT AS rank, vec_id, score FROM r WHERE k <= 10
"""
