import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from staywise.llm import packing, token_counts
from staywise.llm.encoder import encoder

from .conftest import SF, edge_rows

PATH = packing.tokenizer_path()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(), st.sampled_from("ab A's1²½_\n\t\x1c\x85 éß中😀.-")), max_size=60))
def test_encoder_equals_tokenizers(text):
    text = text.encode("utf-8", "replace").decode()
    e = encoder(PATH)
    assert e.ids(text).tolist() == e.reference.encode(text, add_special_tokens=False).ids


def test_encoder_special_and_long(monkeypatch):
    from staywise.llm import encoder as module
    e = encoder(PATH)
    for t in ("a <|endoftext|> b", "it's a  long\n\ntext 123 " * 300):
        assert e.ids(t).tolist() == e.reference.encode(t, add_special_tokens=False).ids
    monkeypatch.setattr(module, "LONG", 10)
    monkeypatch.setattr(module, "SLICE", 7)
    monkeypatch.setattr(module, "KEPT", 20)
    t = "it's a  long\n\ntext 123 äöü " * 50
    assert e.ids(t).tolist() == e.reference.encode(t, add_special_tokens=False).ids


def cost_of(pos, pen, cuts, window, tail):
    total = 0
    for i, j in zip(cuts, cuts[1:]):
        size = pos[j] - pos[i]
        assert 0 < size <= window
        free = tail is not None and pos[j] >= tail and size & (size - 1) == 0
        total += pen[j] + (0 if free else window - size)
    return total


def test_best_cuts_against_all_pairs():
    rng = random.Random(3)
    for _ in range(300):
        window = 16
        pos = [0]
        while len(pos) < 40:
            pos.append(pos[-1] + rng.randint(1, 8))
        pen = [rng.choice([0, 2, 8]) for _ in pos]
        tail = rng.choice([None, pos[-10], 0])
        best = [0] + [10 ** 9] * (len(pos) - 1)
        for j in range(1, len(pos)):
            for i in range(j):
                size = pos[j] - pos[i]
                if size <= window:
                    free = tail is not None and pos[j] >= tail and size & (size - 1) == 0
                    best[j] = min(best[j], best[i] + pen[j] + (0 if free else window - size))
        cuts = packing.best_cuts(pos, pen, window, tail)
        assert cuts[0] == 0 and cuts[-1] == len(pos) - 1
        assert cost_of(pos, pen, cuts, window, tail) == best[-1]
        cuts = packing.best_cuts(pos, pen, window, tail, goes_on=True)
        assert cost_of(pos, pen, cuts, window, tail) == best[cuts[-1]] == min(
            b for b, p in zip(best[1:], pos[1:]) if p > pos[-1] - window)


def check_pieces(rows, docs, window=1024):
    e = encoder(PATH)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        assert 0 < r.length <= window
    pads = ids = 0
    for parts in sequences.values():
        parts.sort(key=lambda r: r.offset)
        at = 0
        for r in parts:
            assert r.offset == at
            at += r.length
        assert at <= window and {r.sequence_length for r in parts} == {at}
        pads += packing.padding(at, window)
        ids += at
    want = defaultdict(int)
    for doc_id, text in docs:
        want[(doc_id, tuple(np.append(e.ids(text or ""), 0).tolist()))] += 1
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for (doc_id, tokens), copies in want.items():
        tokens = np.array(tokens, "<u4")
        own = [r for r in by_doc[doc_id] if r.doc_tokens == len(tokens) and zlib.crc32(
            tokens[r.start:r.start + r.length].tobytes()) == r.ids_crc32]
        covered = np.zeros(len(tokens), int)
        for r in own:
            covered[r.start:r.start + r.length] += 1
        assert (covered >= copies).all()
    assert ids == sum(len(t) * c for (_, t), c in want.items())
    return pads / max(1, ids)


def test_packing_edge(edge):
    check_pieces(packing.pack(edge, PATH).collect(), [(r[0], r[1]) for r in edge_rows()])


def test_packing_little_padding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    share = check_pieces(packing.pack(docs, PATH).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert share < 0.01


def test_packing_segments(spark, monkeypatch):
    """Small segments: documents and sequences run on across them."""
    e = encoder(PATH)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    monkeypatch.setattr(packing, "SEGMENT", 3000)
    p, out = packing.Packer(e, 1024, 0), []
    for i, t in docs:
        out.extend(p.add(i, t))
    out.extend(p.solve(last=True))
    from collections import namedtuple
    Row = namedtuple("Row", "doc_id start length ids_crc32 doc_tokens sequence_id offset sequence_length cut")
    assert check_pieces([Row(*x) for x in out], docs) < 0.01


def test_packing_empty(nothing):
    assert packing.pack(nothing, PATH).count() == 0


def brute(offsets, starts, ends, rule):
    n = [0] * len(starts)
    for a, b in offsets:
        share = [min(b, z) - max(a, s) for s, z in zip(starts, ends)]
        point = {"first": a, "last": b - 1}.get(rule)
        if rule == "most":
            best = share.index(max(share)) if max(share) > 0 else None
        else:
            best = next((k for k, (s, z) in enumerate(zip(starts, ends)) if s <= point < z), None)
        if best is not None:
            n[best] += 1
    return n


def test_attribution_against_brute_force():
    e, rng = encoder(PATH), random.Random(0)
    lengths = e.byte_lengths()
    for _ in range(500):
        t = "".join(rng.choice("ab é\n\n ü😀.") for _ in range(rng.randint(0, 40)))
        raw = t.encode()
        at = np.concatenate([[0], np.cumsum(lengths[e.ids(t)])])
        assert at[-1] == len(raw)
        cuts = sorted(rng.sample(range(len(raw) + 1), min(len(raw) + 1, 6)))
        odd = (np.array(cuts[0::2][:len(cuts) // 2], int), np.array(cuts[1::2], int))
        for starts, ends in (token_counts.line_sections(raw), odd):
            for rule in token_counts.RULES if len(starts) else ():
                got = token_counts.attributed(at, starts, ends, rule)[0].tolist()
                assert got == brute(list(zip(at[:-1].tolist(), at[1:].tolist())), starts.tolist(), ends.tolist(), rule)


def test_token_counts_edge(edge):
    e = encoder(PATH)
    for rule in token_counts.RULES:
        rows = token_counts.attribute(edge, PATH, rule=rule).collect()
        total = defaultdict(int)
        for r in rows:
            total[r.doc_id] += r.tokens
        want = defaultdict(int)
        for r in edge_rows():
            want[r[0]] += len(e.ids(r[1] or ""))
        assert total == want
    lines = [(r.section, r.start, r.end) for r in rows if r.doc_id == 7]
    assert sorted(lines) == [(0, 0, 3), (1, 3, 3)]


def test_token_counts_given_sections(spark, edge):
    sections = spark.createDataFrame([(10, 7, 0, 3000), (10, 8, 3001, 9999), (99, 0, 0, 5)],
                                     "doc_id long, section long, start long, end long")
    rows = {r.section: r for r in token_counts.attribute(edge, PATH, sections=sections, rule="last").collect()}
    assert set(rows) == {7, 8} and rows[8].end == 3003
    assert rows[7].tokens + rows[8].tokens <= len(encoder(PATH).ids("é" * 3000 + " ü😀"))


def test_token_counts_rejects_unknown_rule(edge):
    with pytest.raises(ValueError):
        token_counts.attribute(edge, PATH, rule="half")


def test_token_counts_empty(nothing):
    assert token_counts.attribute(nothing, PATH).count() == 0
