"""Fuzzy line deduplication.

Lines are normalised (lower case, everything but letters, their marks and
digits one space); equal ones collapse first.  Each distinct line gets a 64-bit SimHash
of its words, weighted by their length.  Two hashes within RADIUS bits agree
on at least BLOCKS - RADIUS of BLOCKS blocks (pigeonhole), so lines meet under
a key for every such choice of blocks; pairs within the radius are verified by
edit similarity, and of every connected group the first occurrence stays.

Texts are read and normalised once; equal lines meet by the hash of their text,
and only lines with a near hash have their texts moved.

Lines are first grouped by near hashes alone, then verified inside these groups.
Crowded keys and large groups are compared in blocks of lines by many tasks,
each yielding a spanning forest rather than pairs.

Defined cases: null and empty texts have one blank line; lines without letters
or digits (blank ones) are never dropped; null ids sort last; repeated rows
hold repeated lines, of which one stays; an empty table gives an empty result;
other columns do not enter.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, lookup, python_workers, scratch, table, whole_row, written
from .graph import block_pairs, by_task, components, tasks_of
from .shingles import hashed_words

SIMILARITY = 0.8
RADIUS, BLOCKS = 3, 5
SMALL = 32             # lines of a key that are paired by a join
LONG_WORD = 12         # letters from which a word weighs no more
BLOCK = 256            # lines of a larger key, or of a group, compared at once
BROADCAST_LINES = 200_000   # of lines with a near hash; more are joined by a shuffle
# Edges of the blocks of 64 bits.
EDGES = [64 * i // BLOCKS for i in range(BLOCKS + 1)]


# Code points that both Java and Python lower one by one and class alike, so
# that a batch of lines is normalised by a table; lines with any other go by
# normalised().
PLAIN = 0x250
OTHER = r"[^\x00-\u012F\u0131-\u024F]"
CHUNK = 128            # texts whose bits are summed at once: their matrix fits a cache


def normalised(line: Column) -> Column:
    """Lower case, words of letters, digits and the marks upon them (the vowel
    signs of Indic scripts, decomposed accents), one space between; a mark
    without a letter below it is none of a word."""
    worn = F.regexp_replace(F.lower(line), r"\p{M}(?<![\p{L}\p{M}\p{N}]\p{M})\p{M}*", " ")
    return F.trim(F.regexp_replace(worn, r"[^\p{L}\p{M}\p{N}]+", " "))


def plain_table() -> np.ndarray:
    """Of each code point below PLAIN what becomes of it: lower case, or a
    blank; line feeds stay."""
    lower = [chr(c).lower() if unicodedata.category(chr(c))[0] in "LMN" else " " for c in range(PLAIN)]
    lower[ord("\n")] = "\n"
    return np.array([ord(c[0]) for c in lower], np.uint32)


TABLE = plain_table()


def normalise(lines: list[str]) -> list[str]:
    """normalised() for lines without OTHER code points; lines that are
    normalised stay as they are.  All lines of a batch go at once."""
    points = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le"), np.uint32)
    points = np.where(points < PLAIN, TABLE[np.minimum(points, PLAIN - 1)], points)
    feed = points == 10
    word = (points != 32) & ~feed
    # a blank stays between two words: after a word, and if a word follows before the line ends
    keep = word | feed
    at = np.flatnonzero(keep)
    gap = np.flatnonzero((np.diff(at) > 1) & word[at[:-1]] & word[at[1:]])
    keep[at[gap] + 1] = True
    return points[keep].tobytes().decode("utf-32-le").split("\n")[:-1]


def simhashes(texts: list[str]) -> np.ndarray:
    """For each text 64 bits: bit i is set when the words whose hashes have it
    weigh more than half.  A word weighs the square of its length, up to
    LONG_WORD: short words are frequent, and with equal weights they alone
    would make unlike lines alike; no single long token decides either.  All
    words of a batch are hashed together."""
    raw = [t.encode() for t in texts]
    h, begins, ends = hashed_words(b"\n".join(raw))
    weight = np.minimum(ends - begins, LONG_WORD).astype(np.float32) ** 2
    # the words up to the end of each text
    bounds = np.searchsorted(begins, np.cumsum([len(r) + 1 for r in raw]))
    words = np.diff(bounds, prepend=0)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(words)
    starts = bounds[some] - words[some]
    for lo in range(0, len(some), CHUNK):  # bounds the matrix of bits
        part = some[lo:lo + CHUNK]
        begin, end = starts[lo], bounds[part[-1]]
        bits = np.unpackbits(h[begin:end].view(np.uint8).reshape(-1, 8), axis=1)
        w, at = weight[begin:end], starts[lo:lo + CHUNK] - begin
        ones = np.add.reduceat(bits * w[:, None], at, axis=0)
        half = np.add.reduceat(w, at)[:, None] / 2
        out[part] = np.packbits(ones > half, axis=1).view(np.uint64).ravel()
    return out.view(np.int64)


def simhash(text: str) -> int:
    return int(simhashes([text])[0])


def keys(sim: Column) -> Column:
    """One key per choice of BLOCKS - RADIUS blocks: the choice and the bits
    of those blocks."""
    masks = []
    for chosen in combinations(range(BLOCKS), BLOCKS - RADIUS):
        mask = sum(((1 << (EDGES[i + 1] - EDGES[i])) - 1) << EDGES[i] for i in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*[F.xxhash64(F.lit(i), sim.bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(masks)])


def unshared(a: str, b: str) -> tuple[str, str]:
    """Both texts without their common start and end, which do not change the
    edit distance."""
    def common(x: str, y: str) -> int:
        lo, hi = 0, min(len(x), len(y))
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if x[lo:mid] == y[lo:mid]:
                lo = mid
            else:
                hi = mid - 1
        return lo

    k = common(a, b)
    a, b = a[k:], b[k:]
    k = common(a[::-1], b[::-1])
    return a[:len(a) - k], b[:len(b) - k]


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, bit-parallel over the shorter text."""
    a, b = unshared(a, b)
    if len(a) > len(b):
        a, b = b, a
    m = len(a)
    if not m:
        return len(b)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    up, down, score = full, 0, m
    for c in b:
        same = where.get(c, 0)
        diagonal = (((same & up) + up) ^ up) | same
        right, left = down | (full & ~(diagonal | up)), up & diagonal
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = (right << 1 | 1) & full, left << 1 & full
        vertical = same | down
        up, down = left | (full & ~(vertical | right)), right & vertical
    return score


def close_pairs(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one task, in a block or between two, whose hashes differ
    in at most RADIUS bits, the nearest first."""
    part, sim = t["part"].to_numpy(), t["sim"].to_numpy().view(np.uint64)
    left, right = (np.flatnonzero(part == t[c][0].as_py()) for c in ("bi", "bj"))
    apart = np.bitwise_count(sim[left][:, None] ^ sim[right])
    close = apart <= RADIUS
    if t["bi"][0].as_py() == t["bj"][0].as_py():
        close = np.triu(close, 1)
    a, b = np.nonzero(close)
    order = np.argsort(apart[a, b], kind="stable")
    return left[a[order]], right[b[order]]


def linked(t: pa.Table, alike) -> Iterator[pa.RecordBatch]:
    """One task: a spanning forest of the pairs (i, j) of near hashes for
    which ``alike(i, j)``.  Pairs already connected here are not asked, so a
    group of m like lines costs about m questions and yields under m links."""
    root = list(range(t.num_rows))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for i, j in zip(*(x.tolist() for x in close_pairs(t))):
        u, v = find(i), find(j)
        if u != v and alike(i, j):
            root[u] = v
            links.append((i, j))
    if links:
        i, j = np.array(links).T
        lid = t["lid"].to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(lid[i]), pa.array(lid[j])], ["a", "b"])


def near_hashes(t: pa.Table) -> Iterator[pa.RecordBatch]:
    return linked(t, lambda i, j: True)


def verified(t: pa.Table, similarity: float) -> Iterator[pa.RecordBatch]:
    norm = t["norm"].to_pylist()

    def alike(i: int, j: int) -> bool:
        x, y = norm[i], norm[j]
        most = (1 - similarity + 1e-9) * max(len(x), len(y))
        return abs(len(x) - len(y)) <= most and edit_distance(x, y) <= most

    return linked(t, alike)


def grouped(members: DataFrame, bucket: str, fn) -> DataFrame:
    """Links (a, b) found among the members of each bucket, in blocks."""
    return by_task(block_pairs(members, bucket, "size", "lid", BLOCK), [bucket, "bi", "bj"], fn,
                   "a long, b long", tasks_of(members))


def similar_lines(groups: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(node, root): groups among distinct lines (lid, sim, and in ``first``
    the rid and line by which ``texts`` has the norm).

    First the lines connected by near hashes alone; within each such group,
    however large, links are verified by the texts, which only these lines
    need.
    """
    spark = groups.sparkSession
    keyed = groups.select("lid", "sim", F.explode(keys(F.col("sim"))).alias("key"))
    # rows of a key are counted where they meet: three numbers a row, and one shuffle
    met = written(keyed.withColumn("size", F.count("*").over(Window.partitionBy("key"))).filter("size > 1"), "met")
    small = met.filter(F.col("size") <= SMALL)
    a, b = small.alias("a"), small.alias("b")
    pairs = (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.lid") < F.col("b.lid")) & (
        F.bit_count(F.col("a.sim").bitwiseXOR(F.col("b.sim"))) <= RADIUS))
        .select(F.col("a.lid").alias("a"), F.col("b.lid").alias("b")))
    with scratch(spark) as keep:
        near = keep(components(pairs.unionByName(grouped(met.filter(F.col("size") > SMALL), "key", near_hashes))),
                    "llm-near")
    discard(met)

    sizes = written(near.groupBy("root").agg(F.count("*").alias("size")), "sizes")
    wanted = written(lookup(near, sizes, ["root"], "size", F.xxhash64("node")).withColumnRenamed("node", "lid"),
                     "wanted")
    few = wanted.count() <= BROADCAST_LINES
    some = (lambda df: F.broadcast(df)) if few else (lambda df: df)
    spots = groups.select("lid", "sim", F.col("first.rid").alias("rid"), F.col("first.line").alias("line")).join(
        some(wanted), "lid")
    members = texts.select("rid", "line", "norm").join(some(spots), ["rid", "line"]).drop("rid", "line")
    python_workers(spark)
    return components(grouped(members, "root", lambda t: verified(t, similarity)))


def decide(docs: DataFrame, *, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
           row_col: str | None = None) -> DataFrame:
    """One row per line: doc_id, rid (the row), line (from 0), keep_doc and
    keep_line (the occurrence that stays of its group), group_size, kept."""
    python_workers(docs.sparkSession, rows=5000)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rid = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    split = docs.select(F.col(id_col).alias("doc_id"), rid.alias("rid"), F.split(text, "\n", -1).alias("lines"))
    each = split.select("doc_id", "rid", F.posexplode("lines").alias("line", "s")).withColumn(
        "s", F.when(F.col("s").rlike(OTHER), normalised(F.col("s"))).otherwise(F.col("s")))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            norms = normalise(b.column("s").to_pylist())
            # blank lines have neither hash nor text
            digests = [hashlib.md5(n.encode()).digest() if n else None for n in norms]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("doc_id", "rid", "line")], pa.array(digests, pa.binary()),
                 pa.array(simhashes(norms), pa.int64()), pa.array([n or None for n in norms], pa.string())],
                ["doc_id", "rid", "line", "hash", "sim", "norm"])

    fields = T.StructType([*each.drop("s").schema.fields, T.StructField("hash", T.BinaryType()),
                           T.StructField("sim", T.LongType()), T.StructField("norm", T.StringType())])
    with scratch(docs.sparkSession) as keep:
        lines = keep(each.mapInArrow(hashed, fields), "llm-lines")
        places = lines.select("doc_id", "rid", "line", "hash")

        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid", "line"))
        groups = written(lines.filter("hash IS NOT NULL").groupBy("hash").agg(
            first.alias("first"), F.count("*").alias("n"), F.min("sim").alias("sim")).select(
                F.monotonically_increasing_id().alias("lid"), "hash", "first", "n", "sim"), "groups")
        roots = similar_lines(groups, lines, similarity)

        tied = written(groups.select("lid", "first", "n").join(roots.withColumnRenamed("node", "lid"), "lid"), "tied")
        heads = written(tied.groupBy("root").agg(F.min("first").alias("head"), F.sum("n").alias("group_size"),
                                                 F.count("*").alias("members")), "heads")
        headed = lookup(tied, heads, ["root"], "members", F.xxhash64("lid")).select("lid", "head", "group_size")
        final = keep(groups.join(headed, "lid", "left").select(
            "hash", "n", F.coalesce("head", "first").alias("head"), F.coalesce("group_size", "n").alias("group_size")),
            "llm-final")
        out = lookup(places.filter("hash IS NOT NULL"), final, ["hash"], "n", F.xxhash64("rid", "line")).select(
            "doc_id", "rid", "line", F.col("head.doc_id").alias("keep_doc"), F.col("head.line").alias("keep_line"),
            "group_size", ((F.col("rid") == F.col("head.rid")) & (F.col("line") == F.col("head.line"))).alias("kept"))
        return out.unionByName(places.filter("hash IS NULL").select(
            "doc_id", "rid", "line", F.col("doc_id").alias("keep_doc"), F.col("line").alias("keep_line"),
            F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")))


def clean(docs: DataFrame, *, similarity: float = SIMILARITY, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """The documents without their dropped lines; other columns as they were
    and every row kept, if empty."""
    rows = written(docs.select(whole_row(docs), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                               F.monotonically_increasing_id().alias("rid")), "rows")
    gone = (decide(rows, similarity=similarity, row_col="rid").filter("NOT kept")
            .groupBy("rid").agg(F.collect_set("line").alias("gone")))
    left = F.array_join(F.filter(F.split("text", "\n", -1), lambda s, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(left)
    return rows.join(gone, "rid", "left").select(F.col("row").withField(text_col, text).alias("row")).select("row.*")


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    return decide(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("rid")
