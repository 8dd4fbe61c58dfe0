import itertools
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from staywise.llm import graph, jaccard_join, line_dedup, shingles, topk

from .conftest import COLUMNS, SF, edge_rows, story


def sets_of(docs):
    out = []
    for i, t in docs:
        w = (t or "").lower().split()
        out.append((i, frozenset(zip(*[w[k:] for k in range(5)])) or (frozenset([tuple(w)]) if w else frozenset())))
    return out


def brute_links(docs, similarity=0.8):
    """Per row: links and the least id of its component."""
    s = sets_of(docs)
    n, root = [0] * len(s), list(range(len(s)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = defaultdict(list)
    for k, (_, x) in enumerate(s):
        for token in x:
            inverted[token].append(k)
    common = defaultdict(int)
    for members in inverted.values():
        for a, b in itertools.combinations(members, 2):
            common[a, b] += 1
    for (a, b), c in common.items():
        if c >= similarity * (len(s[a][1]) + len(s[b][1]) - c) - 1e-9:
            n[a] += 1
            n[b] += 1
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(s):
        r = find(k)
        least[r] = min(least.get(r, (True, 0)), (i is None, i or 0))
    return [(i, n[k], least[find(k)][1] if not least[find(k)][0] else None) for k, (i, _) in enumerate(s)]


def joined(df, **options):
    return sorted(((r.doc_id, r.links, r.class_id) for r in jaccard_join.join(df, **options).collect()), key=str)


def test_shingles_and_word_hashes():
    for t in ("", " \n", "one", "a b c d e f g", "A  b\tC d e f g", "é ü 😀 a b c d"):
        assert len(shingles.shingles(t)) == len(sets_of([(0, t)])[0][1])
    assert (shingles.shingles("A b c d e") == shingles.shingles("a  B\nc d e")).all()
    assert len(shingles.word_hashes(b"x y " * 1000)) == 2000


def test_word_hashes_of_long_texts_in_chunks(monkeypatch):
    raw = story(500, 4).encode()
    want = shingles.word_hashes(raw)
    monkeypatch.setattr(shingles, "CHUNK", 50)
    assert (shingles.word_hashes(raw) == want).all()


def test_overlaps_against_sets(monkeypatch):
    rng = np.random.default_rng(1)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 7)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(30)]
    got = jaccard_join.overlaps(sets, np.arange(10), np.arange(5, 30))
    want = [[len(np.intersect1d(sets[i], sets[j])) for j in range(5, 30)] for i in range(10)]
    assert (got == want).all()


def test_join_edge(edge):
    assert joined(edge) == sorted(brute_links([(r[0], r[1]) for r in edge_rows()]), key=str)
    kept = jaccard_join.keep_one(edge)
    assert kept.columns == COLUMNS
    groups = {c if c is not None else ("none", i) for i, _, c in brute_links([(r[0], r[1]) for r in edge_rows()])}
    assert kept.count() >= len(groups) - 1


def test_join_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert joined(docs) == sorted(brute_links([(r.doc_id, r.text) for r in docs.collect()]), key=str)


def test_join_crowded_buckets(spark, monkeypatch):
    """A group of near copies far larger than a leaf: split to the last level
    and compared in blocks; counts, not pairs, come out, each link once."""
    monkeypatch.setattr(jaccard_join, "LEAF", 4)
    rng = random.Random(2)
    docs = []
    for i in range(70):
        w = story(120, 5).split()
        for _ in range(rng.choice([0, 1, 2, 3])):
            w[rng.randrange(len(w))] = f"edit{rng.random()}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, story(90, 20 + i)) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert joined(df, recall=0.99999) == sorted(brute_links(docs), key=str)


def test_runs_reach_the_recall():
    for depth in range(1, 7):
        r = jaccard_join.runs_for(0.999, 0.8, depth)
        assert (1 - 0.8 ** depth) ** r <= 0.001 < (1 - 0.8 ** depth) ** (r - 1)


def test_runs_reach_the_recall_in_crowded_buckets(spark, monkeypatch):
    """All buckets are split to the last level, as those of large groups are:
    of 10,000 pairs at the threshold (40 of 50 shingles in common) at most
    one in a thousand shares no leaf."""
    monkeypatch.setattr(jaccard_join, "LEAF", 1)
    pairs, docs = 10_000, []
    for i in range(pairs):
        w = [f"{i}w{k}" for k in range(44)]
        docs += [(2 * i + side, " ".join(w + [f"{i}{tail}{k}" for k in range(5)])) for side, tail in enumerate("xy")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    sets = jaccard_join.signatures(df, "doc_id", "text").withColumnRenamed("doc_id", "cid")
    met = (jaccard_join.leaves(sets, jaccard_join.runs_for()).groupBy("leaf", (F.col("cid") / 2).cast("long").alias("pair"))
           .agg(F.count("*").alias("n")).filter("n > 1").select("pair").distinct().count())
    assert met >= 0.999 * pairs


def test_join_compares_whole_token_hashes():
    """Tokens whose hashes differ only in the lower half stay apart."""
    a, b = (np.array([*range(70), *range(100 * n, 100 * n + 30)], np.uint64) + np.uint64(1 << 40) for n in (1, 2))
    wide = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 500, dtype=np.uint64))
    for x in (a, wide, wide[:1], wide[:0]):
        assert (jaccard_join.unpacked(jaccard_join.packed(x)) == x).all()
    t = pa.table({"cid": [1, 2], "n": [1, 1], "run": [0, 0], "part": [0, 0], "bi": [0, 0], "bj": [0, 0],
                  "path": [[0], [0]], "tokens": [jaccard_join.packed(x) for x in (a, b)]})
    assert not list(jaccard_join.compare(t, 0.8))


def test_join_empty(nothing):
    assert jaccard_join.join(nothing).count() == 0 and jaccard_join.keep_one(nothing).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    edges += [(1000, 1000 + i) for i in range(1, 200)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 20))) for _ in range(2))
        p = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            q = [i]
            for j, y in enumerate(b, 1):
                q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
            p = q
        assert line_dedup.edit_distance(a, b) == p[-1]


def brute_lines(docs):
    """Places of kept lines: groups by SimHash radius and edit similarity."""
    places, blank = defaultdict(list), set()
    for i, t in docs:
        for k, s in enumerate((t or "").split("\n")):
            n = regex.sub(r"(?<![\p{L}\p{M}\p{N}])\p{M}+", " ", s.lower())
            n = regex.sub(r"[^\p{L}\p{M}\p{N}]+", " ", n).strip(" ")
            places[n].append((i is None, i or 0, k))
    for p in places.pop("", []):
        blank.add(p)
    names = list(places)
    sim = np.array([line_dedup.simhash(n) for n in names], np.int64).view(np.uint64)
    root = list(range(len(names)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(names)):
        for b in (np.flatnonzero(np.bitwise_count(sim[a] ^ sim[a + 1:]) <= line_dedup.RADIUS) + a + 1).tolist():
            x, y = names[a], names[b]
            if line_dedup.edit_distance(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9:
                root[find(a)] = find(b)
    heads = {}
    for k, n in enumerate(names):
        heads[find(k)] = min(heads.get(find(k), min(places[n])), min(places[n]))
    return set(heads.values()) | blank


def kept_places(df):
    return {(r.doc_id is None, r.doc_id or 0, r.line) for r in df.collect() if r.kept}


def test_line_dedup_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert kept_places(line_dedup.decide(docs)) == brute_lines([(r.doc_id, r.text) for r in docs.collect()])


def test_line_dedup_crowded_keys(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    monkeypatch.setattr(line_dedup, "SMALL", 4)
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    docs = [(i, story(200, 6) + f" tail{i}\nunlike {story(30, i + 30)}") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert kept_places(line_dedup.decide(df)) == brute_lines(docs)


def test_line_dedup_keeps_marks(spark):
    """Vowel signs and decomposed accents tell lines apart; lone marks are no
    words, and lines of them are never dropped."""
    lines = ["\u0915\u093f", "\u0915\u0940", "\u0915\u0941", "resume\u0301", "resume", "\u2764\ufe0f " * 3, "\u2764\ufe0f"]
    docs = [(i, t) for i, t in enumerate([*lines, *lines[:5]])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = kept_places(line_dedup.decide(df))
    assert kept == brute_lines(docs) == {(False, i, 0) for i in range(7)}


def test_lines_normalised_by_table(spark):
    rnd = random.Random(5)
    points = [*range(1, 0x260), 0x130, 0x301, 0x3A3, 0x20AC, *[32] * 300, *[97] * 300]
    lines = ["", " ", "\tÀ-b  ", "x\r", *["".join(chr(rnd.choice(points)) for _ in range(rnd.randrange(30))).replace("\n", "")
                                        for _ in range(2000)]]
    df = spark.createDataFrame(list(enumerate(lines)), "i long, s string")
    rows = df.select("i", line_dedup.normalised(F.col("s")).alias("norm"), F.when(
        F.col("s").rlike(line_dedup.OTHER), line_dedup.normalised(F.col("s"))).otherwise(F.col("s")).alias("raw")
        ).orderBy("i").collect()
    assert any(r.raw == line for r, line in zip(rows, lines))
    assert line_dedup.normalise([r.raw for r in rows]) == [r.norm for r in rows]


def test_line_dedup_reads_texts_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    df = spark.createDataFrame([(i, f"one line of words {i}\nanother line {i // 2}") for i in range(40)],
                               "doc_id long, text string")
    text = F.udf(seen, "string").asNondeterministic()
    assert line_dedup.decide(df.select("doc_id", text("text").alias("text"))).count() == 80
    assert read.value == 40


def test_line_dedup_edge(edge, nothing):
    rows = line_dedup.decide(edge).collect()
    assert len(rows) == sum((r[1] or "").count("\n") + 1 for r in edge_rows())
    assert sum(r.kept for r in rows if r.doc_id == 8) == 1
    cleaned = line_dedup.clean(edge)
    assert cleaned.columns == COLUMNS
    texts = {(r.doc_id, r.text) for r in cleaned.collect()}
    assert (1, edge_rows()[0][1]) in texts and (5, None) in texts and cleaned.count() == len(edge_rows())
    assert line_dedup.decide(nothing).count() == 0 and line_dedup.clean(nothing).count() == 0


def brute_top(rows, k):
    out = []
    good = [(j, i, v) for j, (i, v) in enumerate(rows)
            if v and all(x is not None and np.isfinite(x) for x in v)]
    ints = {j: np.floor(1024 * np.array(v, float)).astype(np.int64) for j, _, v in good}
    for j, i, v in good:
        if i is not None and i % 100 == 0:
            s = sorted((-int(ints[j] @ ints[c]), x is None, x or 0) for c, x, u in good
                       if c != j and len(u) == len(v))[:k]
            out += [(i, r + 1, None if none else x, -score) for r, (score, none, x) in enumerate(s)]
    return sorted(out, key=str)


def top_rows(df, **options):
    return sorted((tuple(r) for r in topk.top_k(df, 10, **options).collect()), key=str)


@pytest.mark.parametrize("shard", [4096, 64])
def test_topk_edge(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "PAGE", 6)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(400)]
    rows += [(1000 + i, [0.5] * 8) for i in range(100)]                      # equal vectors: ties by id
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 6), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8),
             (2004, []), (None, [0.5] * 8), (2100, [1.0, 2.0]), (2101, [3.0, 1.0]), (3000, [0.0] * 8),
             (100, rows[100][1])]                                             # a repeated row
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert top_rows(df, shard=shard) == brute_top(rows, 10)


def test_topk_avoids_distances():
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(c, 0.05, (300, 6)) for c in rng.normal(0, 3, (10, 6))])
    v = np.floor(v * 1024).astype(np.int64)
    most = float((v.astype(float) ** 2).sum(1).max())
    b = topk.Builder(np.arange(len(v)), np.arange(len(v)), v, most)
    pages = {p["page"]: (p["leaf"], b.rids[p["objects"]], b.ids[p["objects"]], b.v[p["objects"]], p["radii"],
                         p["to_parent"], p["children"]) for p in b.pages}
    assert max(len(p["objects"]) for p in b.pages) <= topk.PAGE * 3
    for q in range(0, len(v), 97):
        count = [0]
        got = topk.search_tree(pages, v[q], q, -np.inf, most, 10, count)
        want = sorted(((int(v[i] @ v[q]), -i) for i in range(len(v)) if i != q), reverse=True)[:10]
        assert sorted(((s, -i) for s, i, _ in got), reverse=True) == want
        assert count[0] < len(v)


def test_topk_empty(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_topk_rules_out_shards(spark, monkeypatch):
    """Queries go only to the shards that their first bound reaches, trees are
    copied for groups of queries, and nothing but the result stays."""
    import os
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 3, (12, 6))
    v = np.concatenate([rng.normal(c, 0.05, (200, 6)) for c in centres]).round(3)
    rows = [(i * 25, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen = []
    inside = topk.visits
    monkeypatch.setattr(topk, "visits", lambda pages, blocks, most: seen.append(
        (pages.select("shard").distinct().count(), inside(pages, blocks, most).select(
            F.sum(F.length("rids") / 8)).first()[0])) or inside(pages, blocks, most))
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk, "GROUP", 64)
    monkeypatch.setattr(topk, "BALLS", 5)
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    assert top_rows(df, shard=100) == brute_top(rows, 10)
    shards, pairs = seen[0]
    assert shards > 12 and pairs < shards * 600 / 3
    assert len(set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - before) == 1


@pytest.mark.parametrize("operator, left", [(jaccard_join.join, 1), (line_dedup.decide, 2)])
def test_operators_leave_their_result(spark, edge, operator, left):
    """Working tables go; those that the result reads go with the caller's block."""
    import os

    from staywise.sources.tables import scratch
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    with scratch(spark):
        rows = operator(edge)
        assert len(set(os.listdir(folder)) - before) == left
        assert rows.count() > 0
    assert set(os.listdir(folder)) == before
