"""Removal of repeated byte strings by collection suffix arrays, built WIDTH
columns a round.

Every byte covered by a string of LEAST bytes that also starts in a document
of smaller doc_id goes.  Windows are all such strings of a document.

Dealing.  The window's least hash of K bytes (leftmost of equals) is its
anchor, so equal windows have equal anchors; neighbouring windows with the
same anchor form a segment.  A first pass counts anchors, packed by block of
documents and by hash range, and answers with a bit for each; segments whose
anchor occurs once hold no repeat and go no further.  The others go to buckets
by anchor, each different segment once from a block, with the least doc_id that
has it there.  An anchor of HOT occurrences and more may have as many different
segments; its windows go to buckets one by one, by their own hash, so that no
bucket gathers them.

Construction.  In a bucket, different segments form a collection, whose
Burrows-Wheeler transform grows by WIDTH columns each round: round t inserts
every segment's suffixes of up to t * WIDTH symbols that are not there yet.
Where one goes follows from the pile of its first WIDTH symbols and, in it,
from the place of its tail, the suffix without them; with one column a round
the passes over the arrays would be WIDTH times as many.  Common prefixes of
neighbours come from the same WIDTH symbols, word by word.  All of it are
passes over sorted arrays; the arrays of a bucket are bounded by BUCKET bytes
of segments, cut to collections by anchor, and what lies between the passes are
tables in the shared folder.  Suffixes of LEAST bytes and more with a common
prefix of LEAST are equal windows; the least doc_id of each run goes back to
the blocks, where bytes are struck out.

Defined cases: a null text is empty; a null doc_id comes after all others and
stays null; documents of the same id never strike out each other; repeated
rows each give a row; texts shorter than LEAST are kept; texts are read whole,
a very long one as a block of its own; an empty table gives an empty result;
other columns do not enter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_workers, table, written
from .graph import by_task, tasks_of
from .shingles import mix, powers

LEAST = 50
K = 24
W = LEAST - K + 1         # hashes of a window
CHUNK = 1 << 17           # windows handled at once: their hashes fit a cache, positions 20 bits
BLOCK = 1 << 19           # bytes of texts of a block
HOT = 4096                # occurrences of an anchor from which its windows go one by one
PART = 1 << 20            # anchors of a hash range
BUCKET = 4 << 20          # bytes of segments of a bucket
COLLECTION = 1 << 18      # bytes of segments of a collection
WIDTH = 7                 # columns of a round: symbols of 9 bits that a 64-bit word holds
DIFFERS = np.uint64(1) << np.arange(0, 9 * WIDTH, 9, dtype=np.uint64)   # words that differ from a symbol on
NO_ID = (1 << 63) - 1
BLOCK_SCHEMA = "block long, size long, ids binary, sizes binary, texts binary"


def blocks(docs: DataFrame, id_col: str, text_col: str, block: int) -> DataFrame:
    """Documents gathered to about ``block`` bytes, compressed."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 33
        ids, texts = [], []

        def out():
            nonlocal number
            raw, sizes = b"".join(texts), np.array([len(t) for t in texts], np.int64)
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([len(raw)], pa.int64()),
                 pa.array([np.array(ids, np.int64).tobytes()]), pa.array([sizes.tobytes()]),
                 pa.array([pa.compress(raw, "zstd", asbytes=True)], pa.binary())],
                ["block", "size", "ids", "sizes", "texts"])

        held = 0
        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                raw = t.as_py() or b""
                if texts and held + len(raw) > block:
                    yield out()
                    ids, texts, held = [], [], 0
                ids.append(NO_ID if i is None else i)
                texts.append(raw)
                held += len(raw)
        if texts:
            yield out()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return written(rows.mapInArrow(pack, BLOCK_SCHEMA), "blocks")


def unpack(b: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, sizes and bytes of a block."""
    raw = pa.decompress(b.column("texts")[i].as_py(), b.column("size")[i].as_py(), "zstd", asbytes=True)
    return (np.frombuffer(b.column("ids")[i].as_py(), np.int64), np.frombuffer(b.column("sizes")[i].as_py(), np.int64),
            np.frombuffer(raw, np.uint8))


def hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` bytes from each position, good in its upper bits."""
    p, inverse = powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * p[:len(raw)], out=sums[1:])
    n = len(raw) - k + 1
    return (sums[k:] - sums[:n]) * inverse[:n] * np.uint64(0x9E3779B97F4A7C15)


def segments(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor of every segment."""
    ends = np.cumsum(sizes)
    step = np.zeros(len(raw) + 1, np.int64)   # the last LEAST - 1 starts of a text begin no window
    np.add.at(step, np.maximum(ends - sizes, ends - LEAST + 1), 1)
    np.add.at(step, ends, -1)
    window = np.cumsum(step)[:-1] == 0
    firsts, counts, anchors = [], [], []
    for lo in range(0, len(raw) - LEAST + 1, CHUNK):
        part = raw[lo:lo + CHUNK + LEAST - 1]
        h = hashes(part, K)
        low = (h >> np.uint64(20) << np.uint64(20)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span * 2 <= W:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[:len(low) - (W - span)], low[W - span:])
        at = (low & np.uint64((1 << 20) - 1)).astype(np.int64)
        ok = window[lo:lo + len(at)]
        cut = np.ones(len(at), bool)
        cut[1:] = (at[1:] != at[:-1]) | (ok[1:] != ok[:-1])
        first = np.flatnonzero(cut)
        count = np.diff(np.append(first, len(at)))
        first, count = first[ok[first]], count[ok[first]]
        firsts.append(first + lo)
        counts.append(count)
        anchors.append(mix(h[at[first]]))
    if not firsts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(anchors)


def ranges_of(anchors: np.ndarray, parts: int) -> np.ndarray:
    return ((anchors & np.uint64(0xFFFFFF)) % np.uint64(parts)).astype(np.int64)


def short(values: np.ndarray) -> bytes:
    """The upper 40 bits of hashes, 5 bytes each."""
    return np.ascontiguousarray((values >> np.uint64(24)).view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def full(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def by_range(anchors: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of a block's anchors by hash range, the ranges, and where each
    begins and the last ends."""
    part = ranges_of(anchors, parts).astype(np.uint16 if parts <= 1 << 16 else np.int32)
    order = np.argsort(part, kind="stable")
    keys, at = np.unique(part[order], return_index=True)
    return order, keys, np.append(at, len(order))


def repeated(rows: DataFrame, parts: int, hot: int) -> DataFrame:
    """(block, anchors, n): which of a block's anchors occur more than once
    anywhere, as a bit for each in the order of its hash range ``part``
    (``shared``), those of ``hot`` occurrences apart."""
    def list_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, block in enumerate(b.column("block").to_pylist()):
                _, sizes, raw = unpack(b, i)
                a = segments(raw, sizes)[2]
                order, keys, at = by_range(a, parts)
                a = a[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int32()), pa.array([block] * len(keys), pa.int64()),
                     pa.array([short(a[x:y]) for x, y in zip(at, at[1:])], pa.binary())], ["part", "block", "anchors"])

    def count(t: pa.Table) -> Iterator[pa.RecordBatch]:
        lists = [full(x.as_py()) for x in t["anchors"]]
        bounds = np.cumsum([0, *[len(x) for x in lists]])
        values = np.concatenate(lists)
        order = np.argsort(values)
        cut = np.flatnonzero(np.append(True, values[order][1:] != values[order][:-1]))
        n = np.empty(len(values), np.int64)
        n[order] = np.repeat(np.diff(np.append(cut, len(values))), np.diff(np.append(cut, len(values))))
        out: list[list] = [[], [], [], [], []]
        for block, part, x, y in zip(t["block"].to_pylist(), t["part"].to_pylist(), bounds, bounds[1:]):
            c = n[x:y]
            if (c > 1).any():
                cold, warm = (c > 1) & (c < hot), (c > 1) & (c >= hot)
                for column, value in zip(out, (block, part, np.packbits(cold).tobytes(),
                                               np.packbits(warm).tobytes() if warm.any() else b"", int((c > 1).sum()))):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                                          *[pa.array(x, pa.binary()) for x in out[2:4]], pa.array(out[4], pa.int64())],
                                         ["block", "part", "shared", "hot", "n"])

    listed = rows.mapInArrow(list_anchors, "part int, block long, anchors binary")
    found = by_task(listed, ["part"], count, "block long, part int, shared binary, hot binary, n long", tasks_of(rows))
    return written(found.groupBy("block").agg(F.collect_list(F.struct("part", "shared", "hot")).alias("anchors"),
                                              F.sum("n").alias("n")), "repeated")


class Candidates:
    """The segments of a block that may hold a repeat: ``first`` window,
    ``count``, ``number`` of the different segment; and of each different one
    its bytes, bucket hash, least and greatest doc_id."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, raw: np.ndarray, anchors: list[dict], parts: int):
        first, count, a = segments(raw, sizes)
        order, keys, at = by_range(a, parts)
        cold, warm = np.zeros(len(a), bool), np.zeros(len(a), bool)
        for x, k in zip(anchors, np.searchsorted(keys, [x["part"] for x in anchors]).tolist()):
            own = order[at[k]:at[k + 1]]
            for flags, bits in ((cold, x["shared"]), (warm, x["hot"])):
                if bits:
                    flags[own] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own))
        if warm.any():   # window by window
            one = np.repeat(first[warm], count[warm])
            one += np.arange(len(one)) - np.repeat(np.cumsum(count[warm]) - count[warm], count[warm])
            own = np.empty(len(one), np.uint64)
            for lo in range(0, len(raw) - LEAST + 1, CHUNK):
                here = (one >= lo) & (one < lo + CHUNK)
                own[here] = mix(hashes(raw[lo:lo + CHUNK + LEAST - 1], LEAST)[one[here] - lo])
        else:
            one, own = np.empty(0, np.int64), np.empty(0, np.uint64)
        self.first = np.concatenate([first[cold], one])
        self.count = np.concatenate([count[cold], np.ones(len(one), np.int64)])
        doc = np.searchsorted(np.cumsum(sizes), self.first, "right")
        self.doc = ids[doc]
        whole, numbers = raw.tobytes(), {}
        self.number = np.array([numbers.setdefault(whole[f:f + c + LEAST - 1], len(numbers))
                                for f, c in zip(self.first.tolist(), self.count.tolist())], np.int64)
        self.strings = list(numbers)
        key = np.concatenate([a[cold], own])
        self.key = np.zeros(len(numbers), np.uint64)
        self.key[self.number] = key
        self.least, self.most = np.full(len(numbers), NO_ID), np.full(len(numbers), -NO_ID)
        np.minimum.at(self.least, self.number, self.doc)
        np.maximum.at(self.most, self.number, self.doc)


class Collection:
    """Burrows-Wheeler transform and common prefixes of strings, WIDTH columns
    a round.  Rows are suffixes in order, the empty ones first; ``owner`` and
    ``size`` name them."""

    def __init__(self, strings: list[bytes]):
        n = len(strings)
        sizes = np.array([len(s) for s in strings], np.int64)
        gap = bytes(WIDTH)
        # symbols are bytes plus one; before the first string and after each one there are only ends, 0
        text = np.frombuffer(gap[:1] + b"".join([s + gap for s in strings]), np.uint8).astype(np.uint64) + np.uint64(1)
        ends = 1 + np.cumsum(sizes + WIDTH) - WIDTH
        gaps = (ends[:, None] + np.arange(WIDTH)).ravel()
        text[0] = text[gaps] = 0
        two = text[:-1] << np.uint64(9) | text[1:]
        four = two[:-2] << np.uint64(18) | two[2:]
        self.words = (four[:-2] << np.uint64(18) | two[4:])[:-1] << np.uint64(9) | text[6:]
        self.text = text.astype(np.uint16)
        # the number of the pile of a word, in the upper half of a key
        real = np.flatnonzero(text[:len(self.words)])
        order = real[np.argsort(self.words[real])]
        new_pile = np.ones(len(real), np.uint64)
        new_pile[1:] = self.words[order[1:]] != self.words[order[:-1]]
        pile = np.empty(len(text), np.uint64)
        pile[order] = np.cumsum(new_pile, dtype=np.uint64) << np.uint64(32)
        row = np.zeros(len(text), np.uint32)         # of suffixes of the last round
        row[gaps] = np.repeat(np.arange(n), WIDTH)
        # of each row but the empty ones its pile and its tail's row, and where the suffix starts
        keys, starts = np.empty(0, np.uint64), np.empty(0, np.int32)
        who = np.arange(n)
        for done in range(0, int(sizes.max(initial=0)), WIDTH):
            who = who[sizes[who] > done]
            new = ends[who, None] - np.arange(done + 1, done + WIDTH + 1)
            new = new[new >= (ends - sizes)[who, None]]
            key = pile[new] | row[new + WIDTH]
            order = np.argsort(key)
            key, new = key[order], new[order]
            place = np.searchsorted(keys, key) + np.arange(len(key))
            old = np.ones(len(keys) + len(key), bool)
            old[place] = False
            moved = np.arange(n + len(keys), dtype=np.uint32)
            moved[n:] = np.flatnonzero(old)
            moved[n:] += np.uint32(n)
            for x in (keys, key):
                tail = x.view(np.uint32)[::2]        # the lower halves
                tail[:] = moved[tail]
            keys, starts = self.spread(keys, old, place, key), self.spread(starts, old, place, new)
            row[new] = place + n
        self.starts = np.append(ends, starts).astype(np.int32)
        owner = np.repeat(np.arange(n, dtype=np.int32), sizes + WIDTH)
        self.owner = np.append(np.arange(n, dtype=np.int32), owner[starts - 1])
        self.size = ends[self.owner] - self.starts

    @staticmethod
    def spread(rows: np.ndarray, old: np.ndarray, place: np.ndarray, new: np.ndarray) -> np.ndarray:
        out = np.empty(len(old), rows.dtype)
        out[old] = rows
        out[place] = new
        return out

    @property
    def symbol(self) -> np.ndarray:
        """What stands before the suffix of each row."""
        return self.text[self.starts - 1]

    @property
    def common(self) -> np.ndarray:
        """Of each row the common prefix with the row before."""
        return self.prefixes(np.arange(len(self.starts)), int(self.size.max(initial=0)))

    def prefixes(self, rows: np.ndarray, most: int) -> np.ndarray:
        """The common prefix of ``rows`` with the rows before them, read to
        ``most`` symbols, a word at a time."""
        out = np.zeros(len(rows), np.int64)
        live = np.flatnonzero(rows)
        x, y = self.starts[rows[live] - 1], self.starts[rows[live]]
        for done in range(0, most, WIDTH):
            a, b = self.words[x], self.words[y]
            out[live] = done + WIDTH - np.searchsorted(DIFFERS, a ^ b, "right")
            go = np.flatnonzero((a == b) & (a & np.uint64(511) > 0))   # not at an end
            live, x, y = live[go], x[go] + WIDTH, y[go] + WIDTH
        return np.minimum(out, np.minimum(self.size[rows], self.size[rows - 1]))

    def equal_windows(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of suffixes of ``least`` symbols and more, and where runs with
        equal first ``least`` symbols begin among them."""
        rows = np.flatnonzero(self.size >= least)
        return rows, np.flatnonzero(self.prefixes(rows, least) < least)


def first_holders(strings: list[bytes], least: np.ndarray, deal: np.ndarray) -> np.ndarray:
    """For every window of the strings, string by string, the least doc_id
    that holds it; ``least`` has that of each string.  Strings with the same
    anchor have the same ``deal``, a byte, and by it the bucket is cut to
    collections of about COLLECTION bytes, small enough for a processor's
    cache."""
    sizes = np.array([len(s) for s in strings], np.int64)
    starts = np.cumsum(sizes - LEAST + 1) - (sizes - LEAST + 1)
    out = np.empty(int((sizes - LEAST + 1).sum()), np.int64)
    piece = deal.astype(np.int64) * min(256, 1 + int(sizes.sum()) // COLLECTION) // 256
    for k in np.unique(piece):
        own = np.flatnonzero(piece == k)
        c = Collection([strings[i] for i in own.tolist()])
        rows, cuts = c.equal_windows(LEAST)
        owner = own[c.owner[rows]]
        lowest = np.minimum.reduceat(least[owner], cuts)
        out[starts[owner] + sizes[owner] - c.size[rows]] = np.repeat(lowest, np.diff(np.append(cuts, len(rows))))
    return out


def pack_dealt(at: np.ndarray, numbers: np.ndarray, sizes: np.ndarray, deal: np.ndarray, least: np.ndarray,
               most: np.ndarray, strings: list[bytes]) -> list[tuple[int, bytes]]:
    """A block's segments, compressed, and their bytes before, for every bucket:
    those between two of ``at``."""
    steps = np.diff(numbers, prepend=0)
    steps[at[:-1]] = numbers[at[:-1]]
    columns = [steps.astype(np.int32), sizes.astype(np.uint8), deal.astype(np.uint8), least, most - least]
    bounds = at.tolist()
    out = []
    for x, y in zip(bounds, bounds[1:]):
        raw = b"".join([*[c[x:y].tobytes() for c in columns], *strings[x:y]])
        out.append((len(raw), pa.compress(raw, "zstd", asbytes=True)))
    return out


def unpack_dealt(n: int, size: int, packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """numbers, sizes, deal, least, most and joined strings of one bucket of ``pack_dealt``."""
    raw = pa.decompress(packed, size, "zstd", asbytes=True)
    steps, sizes, deal, least, span = (np.frombuffer(raw, kind, n, at * n) for kind, at in
                                       ((np.int32, 0), (np.uint8, 4), (np.uint8, 5), (np.int64, 6), (np.int64, 14)))
    return np.cumsum(steps), sizes, deal, least, least + span, raw[22 * n:]


def verdicts(rows: DataFrame, found: DataFrame, parts: int, buckets: int) -> DataFrame:
    """(block, verdicts): packed (number, from window, to window, least doc_id)
    of segments with a window that an earlier document holds."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, block in enumerate(b.column("block").to_pylist()):
                c = Candidates(*unpack(b, i), b.column("anchors")[i].as_py(), parts)
                to = (c.key % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                keys, at = np.unique(to[order], return_index=True)
                at = np.append(at, len(order))
                strings = [c.strings[k] for k in order.tolist()]
                deal = (c.key[order] // np.uint64(buckets)) % np.uint64(256)
                packed = pack_dealt(at, order, np.array([len(s) for s in strings], np.int64), deal,
                                    c.least[order], c.most[order], strings)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int32()), pa.array([block] * len(keys), pa.int64()),
                     pa.array(np.diff(at), pa.int32()), pa.array([n for n, _ in packed], pa.int64()),
                     pa.array([x for _, x in packed], pa.binary())], ["bucket", "block", "n", "size", "packed"])

    def judge(t: pa.Table) -> Iterator[pa.RecordBatch]:
        different: dict[bytes, int] = {}
        links, columns = [], []
        for n, size, packed in zip(t["n"].to_pylist(), t["size"].to_pylist(), t["packed"]):
            *own, whole = unpack_dealt(n, size, packed.as_py())
            ends = np.cumsum(own[1], dtype=np.int64).tolist()
            links += [different.setdefault(whole[x:y], len(different)) for x, y in zip([0, *ends], ends)]
            columns.append(own)
        link = np.array(links, np.int64)
        numbers, _, own_deal, own_least, most = (np.concatenate(x) for x in zip(*columns))
        deal = np.empty(len(different), np.uint8)
        deal[link] = own_deal
        lowest = np.full(len(different), NO_ID)
        np.minimum.at(lowest, link, own_least)
        strings = list(different)
        windows = np.array([len(s) - LEAST + 1 for s in strings], np.int64)
        starts = np.cumsum(windows) - windows
        holder = first_holders(strings, lowest, deal)
        # runs of windows of a string with the same holder
        cut = np.zeros(len(holder), bool)
        cut[starts] = True
        cut[1:] |= holder[1:] != holder[:-1]
        run = np.flatnonzero(cut)
        run_end = np.append(run[1:], len(holder)) - 1
        holder = holder[run]
        of = np.searchsorted(starts, run, "right") - 1
        bounds = np.searchsorted(of, np.arange(len(strings) + 1))
        # the runs of every block's segments, those that an earlier document holds
        k = bounds[link + 1] - bounds[link]
        pick = np.repeat(bounds[link] - np.cumsum(k) + k, k) + np.arange(k.sum())
        who = np.repeat(np.arange(len(link)), k)
        gone = holder[pick] < most[who]
        pick, who = pick[gone], who[gone]
        rows = np.stack([numbers[who], run[pick] - starts[of[pick]], run_end[pick] - starts[of[pick]], holder[pick]])
        ends = np.searchsorted(who, np.cumsum(t["n"].to_numpy())).tolist()
        out = [(block, rows[:, x:y].tobytes()) for block, x, y in zip(t["block"].to_pylist(), [0, *ends], ends) if y > x]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())],
                                         ["block", "verdicts"])

    dealt = rows.join(found, "block").mapInArrow(
        deal, "bucket int, block long, n int, size long, packed binary")
    judged = by_task(dealt, ["bucket"], judge, "block long, verdicts binary", tasks_of(rows))
    return written(judged.groupBy("block").agg(F.collect_list("verdicts").alias("verdicts")), "verdicts")


def struck(c: Candidates, lists: list[bytes], size: int) -> np.ndarray:
    """Which bytes of a block go."""
    rows = np.concatenate([np.frombuffer(x, np.int64).reshape(4, -1) for x in lists], 1)
    order = np.argsort(c.number, kind="stable")
    bounds = np.searchsorted(c.number[order], np.arange(len(c.strings) + 1))
    k = bounds[rows[0] + 1] - bounds[rows[0]]
    pick = order[np.repeat(bounds[rows[0]], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)]
    lo, hi, holder = (np.repeat(x, k) for x in rows[1:])
    later = holder < c.doc[pick]
    first = c.first[pick][later]
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, first + lo[later], 1)
    np.add.at(step, first + hi[later] + LEAST, -1)
    return np.cumsum(step)[:-1] > 0


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                   hot: int = HOT, bucket: int = BUCKET, keep_bytes: bool = True) -> DataFrame:
    """One row per document (RESULT): what was removed, and the bytes kept."""
    python_workers(docs.sparkSession, rows=64)
    rows = blocks(docs, id_col, text_col, block)
    tasks = tasks_of(docs)
    size = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = min(1 << 24, max(4 * tasks, size // (PART * (W + 1) // 2)))
    found = repeated(rows, parts, hot)
    n = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(4 * tasks, n * (LEAST + W) // bucket)
    told = verdicts(rows, found, parts, buckets)

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, sizes, raw = unpack(b, i)
                lists = b.column("verdicts")[i].as_py()
                gone = np.zeros(len(raw), bool)
                if lists:
                    gone = struck(Candidates(ids, sizes, raw, b.column("anchors")[i].as_py(), parts), lists, len(raw))
                out: list[list] = [[] for _ in range(6)]
                end = 0
                for doc_id, n in zip(ids.tolist(), sizes.tolist()):
                    part, end = gone[end:end + n], end + n
                    kept = raw[end - n:end][~part].tobytes()
                    spans = int((part[1:] & ~part[:-1]).sum() + part[0]) if n else 0
                    for column, v in zip(out, (None if doc_id == NO_ID else doc_id, n, n - len(kept), spans,
                                               hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None)):
                        column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in out[:4]], pa.array(out[4], pa.string()),
                     pa.array(out[5], pa.binary())], [c.split()[0] for c in RESULT.split(", ")])

    return rows.join(found.drop("n"), "block", "left").join(told, "block", "left").mapInArrow(strike, RESULT)


def op12_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False).drop("kept")


SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, 9223372036854775807) AS o,
                  hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT rid, o, j, substr(x, 2000 * j + 1, 2098) AS y
      FROM (SELECT rid, o, x, unnest(range(length(x) // 2000 + 1)) AS j FROM d)),
w AS (SELECT rid, o, 1000 * j + i AS i, substr(y, 2 * i + 1, 100) AS s
      FROM (SELECT *, unnest(range(0, least(1000, length(y) // 2 - 49))) AS i FROM p)),
f AS (SELECT s, min(o) AS m FROM w GROUP BY s),
h AS (SELECT rid, i, i > lag(i) OVER (PARTITION BY rid ORDER BY i) + 50 AS cut FROM w JOIN f USING (s) WHERE m < o),
g AS (SELECT rid, i, count(*) FILTER (cut) OVER (PARTITION BY rid ORDER BY i) AS k FROM h),
spans AS (SELECT rid, k, min(i) AS lo, max(i) + 50 AS hi FROM g GROUP BY rid, k),
cuts AS (SELECT rid, lo, hi, coalesce(lag(hi) OVER (PARTITION BY rid ORDER BY lo), 0) AS from_byte FROM spans),
kept AS (SELECT rid, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans,
    string_agg(substr(x, 2 * from_byte + 1, 2 * (lo - from_byte)), '' ORDER BY lo)
      || any_value(substr(x, 2 * e.hi_all + 1)) AS y
  FROM cuts JOIN d USING (rid) JOIN (SELECT rid, max(hi) AS hi_all FROM spans GROUP BY rid) e USING (rid) GROUP BY rid)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(y, x))) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""
