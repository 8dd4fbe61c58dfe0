import hashlib
import re
from collections import defaultdict

import pytest

from staywise.llm import exact_dedup, mixing

from .conftest import COLUMNS, edge_rows


def squeezed(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup_edge(edge):
    got = exact_dedup.assign(edge).collect()
    groups = defaultdict(list)
    for r in edge_rows():
        groups[squeezed(r[1])].append(r[0])
    assert len(got) == len(edge_rows())
    by_hash = defaultdict(list)
    for r in got:
        by_hash[r.text_sha256].append(r)
    for t, ids in groups.items():
        rows = by_hash[hashlib.sha256(t.encode()).hexdigest()]
        first = min(ids, key=lambda x: (x is None, x or 0))
        assert {(r.keep_id, r.group_size) for r in rows} == {(first, len(ids))}
        assert [r.doc_id for r in rows if r.kept] == [first]
    kept = exact_dedup.keep_first(edge)
    assert kept.columns == COLUMNS
    assert sorted(squeezed(r.text) for r in kept.collect()) == sorted(groups)


def test_exact_dedup_collisions_are_found(edge, monkeypatch):
    assert exact_dedup._collisions(edge, "text").isEmpty()


def test_exact_dedup_empty(nothing):
    assert exact_dedup.assign(nothing).count() == 0 and exact_dedup.keep_first(nothing).count() == 0


def targets(sizes, weights=(5, 2, 1), most=3):
    """Resharing until no source is above its cap, in exact fractions."""
    from fractions import Fraction
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: Fraction(left * w[s], sum(w[x] for x in rest)) for s in rest}
        over = {s for s in rest if share[s] > most * sizes[s]}
        if not over:
            return {s: float(share.get(s, most * sizes[s])) for s in names}
        capped |= over


def test_mixing_edge(edge):
    rows = mixing.decide(edge).collect()
    sizes = defaultdict(int)
    for r in edge_rows():
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = targets(sizes)
    assert len(rows) == len(edge_rows())
    for r in rows:
        assert r.source_size == sizes[r.row.source] and r.target == pytest.approx(want[r.row.source])
        assert r.taken == r.size * r.copies and r.copies <= 3
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies in (int(rate), int(rate) + 1)
    again = {(r.doc_id, r.row.text): r.copies for r in mixing.decide(edge).collect()}
    assert again == {(r.doc_id, r.row.text): r.copies for r in rows}
    mixed = mixing.mix(edge)
    assert mixed.columns == COLUMNS and mixed.count() == sum(r.copies for r in rows)


def test_mixing_shuffled_rates_agree(edge, monkeypatch):
    want = sorted((str(r.doc_id), r.size, r.target, r.copies) for r in mixing.decide(edge).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert want == sorted((str(r.doc_id), r.size, r.target, r.copies) for r in mixing.decide(edge).collect())


def test_mixing_comes_near_targets(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 50 as int)) AS text",
                                          "concat('s', id % 7) AS source")
    for r in mixing.decide(docs).groupBy("row.source").agg({"taken": "sum", "target": "max"}).collect():
        assert r["sum(taken)"] == pytest.approx(r["max(target)"], rel=0.05)


def test_mixing_empty(nothing):
    assert mixing.decide(nothing).count() == 0 and mixing.mix(nothing).count() == 0
