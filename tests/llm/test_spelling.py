"""Spelling variants against brute force in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from staywise.llm import spelling

from .conftest import SF, edge_rows, story

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def vocabulary(docs, least=5, seen=3):
    c = Counter()
    for i, t in docs:
        for run in RUN.findall(t or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            c[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in c.items() if len(w) >= least and n >= seen}


def brute(words):
    form, rows = {}, []
    for w, n in words.items():
        around = [x for x in words if near(w, x)]
        best = min(around, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
        rows.append((w, n, len(around)))
    out = []
    for w, n, k in rows:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, k, words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def invented(n, letters="abé", lo=3, hi=7, seed=1):
    rnd = random.Random(seed)
    return {"".join(rnd.choices(letters, k=rnd.randint(lo, hi))): rnd.randint(1, 40) for _ in range(n)}


def test_vocabulary_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.word: r.n for r in spelling.vocabulary(docs).collect()}
    assert got == vocabulary([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("depth", [40, 5])
def test_pairs_and_forms(spark, depth):
    """Both ways: by the trie alone, and with halves for the longer words."""
    words = invented(200)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = [tuple(r) for r in spelling.near_pairs(df, depth).collect()]
    want = {(a, b) for a in words for b in words if near(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    assert result(spelling.forms(df, spelling.near_pairs(df, depth))) == brute(words)


def test_levels_broadcast_or_not(spark, monkeypatch):
    words = {w: 3 + i % 5 for i, w in enumerate(invented(150, seed=4))}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    for limit in (0, 2000, 1 << 20):
        monkeypatch.setattr(spelling, "BROADCAST", limit)
        assert {(r.a, r.b) for r in spelling.trie_pairs(df).collect()} | {
            (r.b, r.a) for r in spelling.trie_pairs(df).collect()} == {(a, b) for a in words for b in words if near(a, b)}


def test_short_runs_are_left_out_before_the_hash(spark):
    docs = [(i, "Ab ABCDE çDEFG abcd ÀBCDEF x×y÷zw ABCDEÉ K " * 40 + "abcdé") for i in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for least in (1, 5):
        assert {r.word: r.n for r in spelling.vocabulary(df, least=least).collect()} == {
            w: n for w, n in vocabulary(docs, least=least).items() if w}
    plan = spelling.vocabulary(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "{5,}" in plan


def test_very_long_words(spark):
    rnd = random.Random(3)
    base = "".join(rnd.choices("abcdefgh", k=3000))
    words = {base: 9, base[:1500] + "x" + base[1501:]: 4, base[:2999]: 3, base[1:]: 3, "z" + base: 3, base + "zz": 3,
             base[:40]: 5, base[:39]: 3, base[:41]: 3, base[:38] + "y" + base[39:40]: 3, "short": 7, "shurt": 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert result(spelling.forms(df, spelling.near_pairs(df))) == brute(words)


def test_edge_rows(spark, edge):
    docs = [r[:2] for r in edge_rows()]
    assert result(spelling.variants(edge)) == brute(vocabulary(docs))
    few = [(1, " ".join(["colour"] * 9 + ["color"] * 3 + ["Colours"] * 3)), (None, "colour Éclat Éclat Éclat eclat " * 2),
           (1, "colour " * 20 + story(50))]
    df = spark.createDataFrame(few, "doc_id long, text string")
    assert result(spelling.variants(df)) == brute(vocabulary(few))


def test_empty(nothing):
    assert spelling.variants(nothing).count() == 0
