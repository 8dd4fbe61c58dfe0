"""Removal of repeated byte strings against brute force in plain Python."""

import hashlib
import random
import tracemalloc

import numpy as np
import pytest

from staywise.llm import repeats

from .conftest import edge_rows, story


def brute(docs):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in docs]
    for i, t in texts:
        for p in range(len(t) - 49):
            s = t[p:p + 50]
            first[s] = min(first.get(s, 1 << 63), (1 << 63) - 1 if i is None else i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - 49):
            if first[t[p:p + 50]] < ((1 << 63) - 1 if i is None else i):
                gone[p:p + 50] = b"\x01" * 50
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for p in range(len(t)) if gone[p] and (not p or not gone[p - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def passages(seed, n):
    """Documents of own words, with shared passages, copies, and near copies."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdé ", k=rnd.randint(1, 7)))
    shared = [" ".join(word() for _ in range(rnd.randint(8, 60))) for _ in range(6)]
    docs = []
    for i in range(n):
        t = " ".join(rnd.choice(shared) if rnd.random() < .15 else word() for _ in range(rnd.randint(0, 60)))
        docs.append((rnd.randint(0, n), t))
    docs += [(n + k, docs[k][1]) for k in range(n // 4)]
    docs += [(2 * n + k, docs[k][1][:40] + "X" + docs[k][1][41:]) for k in range(n // 4)]
    docs += [(5 * n, "ab" * 400), (5 * n + 1, "ba" * 300 + "c"), (5 * n + 2, "a" * 500)]
    return docs


def test_collection_is_a_sorted_suffix_list():
    rnd = random.Random(2)
    strings = list({"".join(rnd.choices("ab", k=rnd.randint(1, 9))).encode() for _ in range(60)}) + [b"\xff\x00\xff", b"\x00"]
    c = repeats.Collection(strings)
    suffixes = sorted((strings[i][len(strings[i]) - n:], i) for i in range(len(strings)) for n in range(len(strings[i]) + 1))
    assert [(strings[i][len(strings[i]) - n:], i) for i, n in zip(c.owner.tolist(), c.size.tolist())] == suffixes
    common = [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                    for (a, _), (b, _) in zip(suffixes, suffixes[1:])]
    assert c.common.tolist() == common
    before = [strings[i][len(strings[i]) - n - 1] + 1 if n < len(strings[i]) else 0
              for i, n in zip(c.owner.tolist(), c.size.tolist())]
    assert c.symbol.tolist() == before


def test_collection_of_long_strings_takes_few_rounds(monkeypatch):
    """Columns come several a round, so that arrays are rewritten seldom."""
    rnd = random.Random(4)
    strings = list({"".join(rnd.choices("ab", k=rnd.randint(1, 76))).encode() for _ in range(80)})
    strings += [b"ab" * 38, b"ba" * 38, b"b" + b"ab" * 37, b"\xff" * 70]
    spread, calls = repeats.Collection.spread, []
    monkeypatch.setattr(repeats.Collection, "spread", staticmethod(lambda *x: calls.append(1) or spread(*x)))
    c = repeats.Collection(strings)
    assert len(calls) <= 2 * 11
    suffixes = sorted((strings[i][len(strings[i]) - n:], i) for i in range(len(strings)) for n in range(len(strings[i]) + 1))
    assert [(strings[i][len(strings[i]) - n:], i) for i, n in zip(c.owner.tolist(), c.size.tolist())] == suffixes
    common = [0] + [next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                    for (a, _), (b, _) in zip(suffixes, suffixes[1:])]
    assert c.common.tolist() == common
    rows, cuts = c.equal_windows(50)
    assert rows.tolist() == [i for i, (s, _) in enumerate(suffixes) if len(s) >= 50]
    assert cuts.tolist() == [k for k, i in enumerate(rows.tolist()) if common[i] < 50]


def test_repeated_anchors_come_back_as_bits(spark):
    """What a block learns of its anchors is far smaller than the anchors."""
    text = story(20_000, 7)
    docs = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    rows = repeats.blocks(docs, "doc_id", "text", 1 << 30)
    n = sum(len(repeats.segments(raw, sizes)[2]) for raw, sizes in
            [(np.frombuffer(text.encode(), np.uint8), np.array([len(text.encode())]))] * 2)
    found = repeats.repeated(rows, 4, 4096).collect()
    assert sum(r.n for r in found) >= n - 2
    assert sum(len(a.shared) + len(a.hot) for r in found for a in r.anchors) < n / 2


def test_dealt_segments_travel_compressed():
    strings = [(story(40, k)[:60] * 2)[:60].encode() for k in range(50)]
    ids, numbers = np.arange(50) * 1000, np.append(np.arange(0, 60, 2), np.arange(1, 41, 2))
    packed = repeats.pack_dealt(np.array([0, 30, 50]), numbers, np.full(50, 60), np.arange(50), ids, ids + 5, strings)
    for (size, raw), x, y in zip(packed, (0, 30), (30, 50)):
        assert len(raw) < size
        got = repeats.unpack_dealt(y - x, size, raw)
        assert [g.tolist() for g in got[:5]] == [numbers[x:y].tolist(), [60] * (y - x), list(range(x, y)),
                                                 ids[x:y].tolist(), (ids[x:y] + 5).tolist()]
        assert got[5] == b"".join(strings[x:y])


def test_segments_need_little_memory():
    """Hashes of a block stay small enough for a processor's cache."""
    raw = np.random.default_rng(1).integers(97, 123, 1 << 19).astype(np.uint8)
    sizes = np.full(1 << 9, 1 << 10)
    repeats.segments(raw, sizes)
    tracemalloc.start()
    try:
        first, count, _ = repeats.segments(raw, sizes)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert count.sum() == (1 << 9) * ((1 << 10) - repeats.LEAST + 1) and (np.diff(first) >= count[:-1]).all()
    assert peak < 16 << 20


def test_segments_cover_all_windows(monkeypatch):
    rnd = np.random.default_rng(1)
    sizes = np.array([0, 49, 50, 1000, 3, 700, 51])
    raw = rnd.integers(97, 100, sizes.sum()).astype(np.uint8)
    want = [p for e, n in zip(np.cumsum(sizes), sizes) for p in range(e - n, e - 49)]
    anchors = {}
    for chunk in (1 << 19, 64):
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        first, count, a = repeats.segments(raw, sizes)
        assert [p for f, n in zip(first, count) for p in range(f, f + n)] == want
        for f, n, h in zip(first, count, a):
            for p in range(f, f + n):
                assert anchors.setdefault(raw[p:p + 50].tobytes(), h) == h


@pytest.mark.parametrize("block,hot,bucket", [(1 << 19, 4096, 4 << 20), (3000, 4096, 2000), (700, 3, 500), (5000, 2, 1 << 20)])
def test_against_brute_force(spark, monkeypatch, block, hot, bucket):
    monkeypatch.setattr(repeats, "COLLECTION", 1500 if block == 3000 else 1 << 19)
    docs = passages(block + hot, 120)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert result(repeats.remove_repeats(df, block=block, hot=hot, bucket=bucket)) == brute(docs)


def test_edge_rows(spark, edge):
    df = repeats.remove_repeats(edge, keep_bytes=True)
    assert result(df) == brute([r[:2] for r in edge_rows()])
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in df.collect())
    long = [(2, story(150_000, 3)), (1, story(4000, 3)), (3, "x" + story(150_000, 3))]
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(long, "doc_id long, text string")).collect()}
    assert got[1].n_removed == 0 and got[3].n_removed >= got[3].n_bytes - 50 and got[2].n_removed > 4000


def test_empty(nothing):
    assert repeats.remove_repeats(nothing).count() == 0
