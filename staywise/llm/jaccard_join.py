"""N-gram Jaccard self-join by chosen paths.

Each text is its set of five-word shingles.  A run splits the sets
recursively: at each level one random order of all tokens is drawn, and every
set goes to the child named by its first token in that order, a sampled token
that two sets share with a probability of their similarity.  Every run and
level has an order of its own, so runs fail independently.  Buckets of up to LEAF sets are compared pair by pair; larger
ones are split again, to a depth of DEPTH.  Two sets of similarity s meet in
a leaf of one run with a probability of at least s ** DEPTH; runs are
repeated until that leaves less than 1 - RECALL of the pairs unmet.

Sets met in several runs are compared, or at least counted, in the first run
in which they share a leaf.  A bucket still large at the last level (a group
of thousands of near copies) is compared exactly, in blocks, and yields counts
of links and a spanning forest instead of pairs.

Defined cases: null, empty and blank texts have no shingles, link to nothing
and are classes of their own; texts of one to four words are one shingle;
equal sets (copies) are compared once and counted by their number; null ids
sort last; an empty table gives an empty result; other columns are carried
untouched.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import content_key, discard, keep_rows, lookup, python_workers, scratch, table, written
from .graph import block_pairs, by_task, components, forest, tasks_of
from .shingles import minhash, shingles

SIMILARITY = 0.8
RECALL = 0.999
DEPTH = 4
LEAF = 128
COLUMNS = 8192   # vocabulary compared at once: bounds a task's memory


def runs_for(recall: float = RECALL, similarity: float = SIMILARITY, depth: int = DEPTH) -> int:
    """Least number of runs that leaves less than 1 - recall of the pairs at
    the threshold unmet, even if all their buckets are split to the end."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity ** depth))


def signatures(docs: DataFrame, id_col: str, text_col: str, runs: int | None = None) -> DataFrame:
    """doc_id, rid (the row), hash (of the text), skey (of its set, null
    without shingles) and sig (its minima under one token order for each run
    and level, the runs of level one first)."""
    orders = (runs or runs_for()) * DEPTH
    python_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
                       content_key(F.col(text_col)).alias("hash"), F.col(text_col).alias("text"))
    sig = pa.list_(pa.int32())

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sigs = [], []
            for t in b.column("text"):
                h = shingles(t.as_py())
                keys.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                sigs.append(minhash(h, orders) if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("rid"), b.column("hash"), pa.array(keys, pa.binary()),
                 pa.array(sigs, sig)], ["doc_id", "rid", "hash", "skey", "sig"])

    return written(rows.mapInArrow(signed, "doc_id long, rid long, hash binary, skey binary, sig array<int>"),
                   "signatures")


def leaves(sets: DataFrame, runs: int) -> DataFrame:
    """(cid, run, leaf, size): the leaf of at least two sets that each run
    puts a set into, if any."""
    with scratch(sets.sparkSession) as keep:
        first = F.posexplode(F.slice("sig", 1, runs)).alias("run", "token")
        active = written(sets.select("cid", first).select("cid", "run", F.xxhash64("run", "token").alias("node")), "paths")
        found = []
        for depth in range(1, DEPTH + 1):
            sizes = written(active.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
            met = written(lookup(active, sizes, ["node"], "size", F.xxhash64("cid")), "met")
            leaf = F.col("size") <= (LEAF if depth < DEPTH else F.lit((1 << 62)))
            found.append(met.filter(leaf).select("cid", "run", F.col("node").alias("leaf"), "size"))
            large = met.filter(~leaf)
            if depth == DEPTH or large.isEmpty():
                break
            token = F.element_at("sig", F.col("run") + depth * runs + 1)
            active = written(large.join(sets.select("cid", "sig"), "cid")
                             .select("cid", "run", F.xxhash64("node", token).alias("node")), "paths")
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return keep(out, "llm-leaves")


def compared(leaf_rows: DataFrame, runs: int) -> DataFrame:
    """Adds ``path`` (a set's leaf in every run, 0 for none) and leaves out
    leaves whose members all share a leaf of an earlier run: all their pairs
    are compared there."""
    by_run = F.map_from_entries(F.collect_list(F.struct("run", "leaf")))
    paths = (leaf_rows.groupBy("cid").agg(by_run.alias("m"))
             .select("cid", F.transform(F.sequence(F.lit(0), F.lit(runs - 1)),
                                        lambda r: F.coalesce(F.element_at("m", r), F.lit(0).cast("long"))).alias("path")))
    rows = written(leaf_rows.join(paths, "cid"), "paths")
    if runs == 1:
        return rows
    spans = rows.groupBy("leaf", "run").agg(*[f(F.col("path")[r]).alias(f"{n}{r}") for r in range(runs - 1)
                                              for n, f in (("lo", F.min), ("hi", F.max))])
    shared = F.lit(False)
    for r in range(runs - 1):
        shared = shared | ((F.col("run") > r) & (F.col(f"lo{r}") == F.col(f"hi{r}")) & (F.col(f"lo{r}") != 0))
    open_leaves = written(spans.filter(~shared).select("leaf").join(
        rows.groupBy("leaf").agg(F.count("*").alias("weight")), "leaf"), "open")
    return lookup(rows, open_leaves, ["leaf"], "weight", F.xxhash64("cid")).drop("weight")


def packed(hashes: np.ndarray) -> bytes:
    """Sorted hashes as the bytes of their differences, the lowest bytes
    first: the highest ones are almost all zero, which shuffles compress."""
    steps = np.diff(hashes, prepend=np.uint64(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(steps).view(np.uint64).ravel(), dtype=np.uint64)


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[left] with sets[right]: products of
    0/1 matrices over the tokens that occur in more than one set."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > 1
    column = np.cumsum(common) - 1
    kept = common[token]
    owner, token = owner[kept], column[token[kept]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, int(common.sum()), COLUMNS):
        i, j = np.searchsorted(token, [lo, lo + COLUMNS])
        x = np.zeros((len(sets), min(COLUMNS, int(common.sum()) - lo)), np.float32)
        x[owner[i:j], token[i:j] - lo] = 1
        out += x[left] @ x[right].T
    return out


def compare(t: pa.Table, similarity: float) -> Iterator[pa.RecordBatch]:
    """One task: pairs within a block or between two blocks.  Yields per set
    that has a pair: cid, root (least set linked to it here) and the links
    that no earlier run has counted."""
    part, n = t["part"].to_numpy(), t["n"].to_numpy()
    cid, run, bi, bj = t["cid"].to_numpy(), t["run"][0].as_py(), t["bi"][0].as_py(), t["bj"][0].as_py()
    order = np.argsort(cid)  # the least index is the least cid
    part, n, cid = part[order], n[order], cid[order]
    raw = t["tokens"].to_pylist()
    sets = [unpacked(raw[i]) for i in order]
    left, right = np.flatnonzero(part == bi), np.flatnonzero(part == bj)
    if len(cid) < 2 or not len(left) or not len(right):
        return
    size = np.array([len(s) for s in sets], float)
    both = overlaps(sets, left, right)
    near = both * (1 + similarity) >= similarity * (size[left][:, None] + size[right]) - 1e-6
    if bi == bj:
        near = np.triu(near, 1)
    a, b = np.nonzero(near)
    if not len(a):
        return
    a, b = left[a], right[b]
    path = np.array(t["path"].to_pylist())[order][:, :run]
    new = ~((path[a] == path[b]) & (path[a] != 0)).any(axis=1)
    links = np.bincount(a, n[b] * new, len(cid)) + np.bincount(b, n[a] * new, len(cid))
    root = forest(len(cid), np.stack([a, b], 1))
    used = np.unique(np.concatenate([a, b]))
    yield pa.RecordBatch.from_arrays([pa.array(cid[used]), pa.array(cid[root[used]]),
                                      pa.array(links[used].astype(np.int64))], ["cid", "root", "links"])


def join(docs: DataFrame, *, similarity: float = SIMILARITY, recall: float = RECALL, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its connected
    group), copy_id (least doc_id with the same set), links (number of other
    documents whose similarity reaches the threshold), kept (the first
    document of its group), hash (of its text)."""
    with scratch(docs.sparkSession) as keep:
        runs = runs_for(recall, similarity)
        rows = signatures(docs, id_col, text_col, runs)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
        sets = written(rows.filter("skey IS NOT NULL").groupBy("skey").agg(
            first.alias("first"), F.count("*").alias("n"), F.any_value("sig").alias("sig"),
            F.min_by("hash", F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("hash"))
            .withColumn("cid", F.col("first.rid")), "sets")
        with scratch(docs.sparkSession) as keep_met:
            met = keep_met(compared(leaves(sets, runs), runs), "llm-met")

        # Tokens again, only of the sets that share a leaf.  Repeated rows collapse
        # before the shuffle, and the join finds the texts already in place.
        def row_key(doc_id, text_hash):
            return F.unhex(F.md5(F.concat(text_hash, F.coalesce(doc_id.cast("string"), F.lit("-")).cast("binary"))))

        want = (met.select("cid").distinct().join(sets, "cid")
                .select("cid", "n", row_key(F.col("first.doc_id"), F.col("hash")).alias("key")))
        texts = (docs.select(row_key(F.col(id_col).cast("long"), content_key(F.col(text_col))).alias("key"),
                             F.col(text_col).alias("text"))
                 .groupBy("key").agg(F.any_value("text").alias("text")))

        def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                raw = pa.array([packed(shingles(t.as_py())) for t in b.column("text")], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column("cid"), b.column("n"), raw], ["cid", "n", "tokens"])

        contents = texts.join(want, "key").select("cid", "n", "text").mapInArrow(tokens, "cid long, n long, tokens binary")
        dealt = block_pairs(met.join(contents, "cid"), "leaf", "size", "cid", LEAF)
        near = written(by_task(dealt, ["leaf", "bi", "bj"], lambda t: compare(t, similarity),
                               "cid long, root long, links long", tasks_of(docs)), "near")
        discard(met)

        groups = components(near.select(F.col("cid").alias("a"), F.col("root").alias("b")))
        linked = near.groupBy("cid").agg(F.sum("links").alias("links"))
        sets = (sets.select("skey", "cid", "n", "first").join(groups.withColumnRenamed("node", "cid"), "cid", "left")
                .withColumn("root", F.coalesce("root", "cid")).join(linked, "cid", "left"))
        sets = written(sets, "linked")
        heads = sets.groupBy("root").agg(F.min("first").alias("head"))
        final = written(sets.join(heads, "root").select(
            "skey", "n", "first", "head", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "classes")
        classed = lookup(rows.filter("skey IS NOT NULL").select("doc_id", "rid", "hash", "skey"), final, ["skey"], "n",
                         F.xxhash64("rid")).select(
            "doc_id", F.col("head.doc_id").alias("class_id"), F.col("first.doc_id").alias("copy_id"), "links",
            (F.col("rid") == F.col("head.rid")).alias("kept"), "hash")
        alone = rows.filter("skey IS NULL").select(
            "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"),
            F.lit(0).cast("long").alias("links"), F.lit(True).alias("kept"), "hash")
        return keep(classed.unionByName(alone), "llm-links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` of which one per group stays."""
    return keep_rows(docs, join(docs, id_col=id_col, text_col=text_col, **options).filter("kept"), id_col, text_col)


def op3_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("hash", "kept")
