"""Order-preserving packing of documents into training sequences.

Documents, each closed by an end id, form one stream in id order per
partition.  A dynamic program chooses the cuts of the stream: a window is at
most ``window`` ids long and costs its padding plus the penalty of the cut
that ends it.  Cuts are free at document ends, cheap at sentence ends and
dearer elsewhere, where only every ``GRID``-th position is offered (a chain of
full windows can go on there without padding).  As the cost of a window
depends on its two ends separately, the best start for each end is the least
of a sliding window of states, kept in a monotone queue: every state enters
and leaves it once.

A sequence is padded to ``window`` except at a power of two; such lengths are
used for the last stretch of a stream, where every position is offered.

Defined cases: a null text is empty and packs as its end id alone; a null id
stays null; documents with one id (repeated rows, copies of a mix) are packed
one after the other; a very long text is cut like any other and memory holds
its ids and one segment of the stream; an empty table gives an empty result;
other columns do not enter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_workers, table
from .encoder import encoder

WINDOW = 1024
END_ID = 0
SENTENCE, HARD = 2, 8
GRID = 64
# Ids solved at once; what the last window of a segment holds goes on into the
# next one.
SEGMENT = 256 * WINDOW
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, sequence_length long, cut string")


def best_cuts(pos: list[int], pen: list[int], window: int, tail: int | None = None,
              goes_on: bool = False) -> list[int]:
    """Indices of the cheapest chain of cuts from the first to the last
    position or, if the stream ``goes_on``, to the cheapest one less than a
    window before it (the later among equals).  ``pos`` ascends by steps of at
    most ``window``; ``pen[j]`` is the penalty of cutting at ``pos[j]``.  From
    position ``tail`` on, windows of a power of two are also taken, free of
    padding.

    With g = cost so far + position, a window from i to j costs
    g[j] = g[i] + window + pen[j], so the queue only needs g.
    """
    n = len(pos)
    g, prev = [0] * n, [0] * n
    queue, head = [0], 0
    at = {p: j for j, p in enumerate(pos)} if tail is not None else {}
    powers = [1 << k for k in range(window.bit_length()) if 1 << k < window]
    for j in range(1, n):
        p = pos[j]
        low = p - window
        while pos[queue[head]] < low:
            head += 1
        i = queue[head]
        v = g[i] + window
        if tail is not None and p >= tail:
            for k in powers:
                o = at.get(p - k)
                if o is not None and g[o] + k < v:
                    v, i = g[o] + k, o
        v += pen[j]
        g[j], prev[j] = v, i
        while g[queue[-1]] >= v and len(queue) > head:  # below head lie states that have left
            queue.pop()
        queue.append(j)
    j = n - 1
    if goes_on:
        late = [i for i in range(n) if pos[i] > pos[-1] - window and i]
        j = min(late, key=lambda i: (g[i] - pos[i], -i))
    out = [j]
    while j:
        j = prev[j]
        out.append(j)
    return out[::-1]


def padding(length: int, window: int = WINDOW) -> int:
    return 0 if length & (length - 1) == 0 else window - length


def sentence_ends(enc) -> np.ndarray:
    """Which ids close a sentence: their text ends in a full stop, exclamation
    or question mark, or holds a line feed."""
    return np.array([(t := enc.bytes_of.get(i, b"")).endswith((b".", b"!", b"?")) or b"\n" in t
                     for i in range(enc.size)])


class Packer:
    """Takes documents in order and yields the pieces of closed sequences."""

    def __init__(self, enc, window: int, first_sequence: int):
        self.enc, self.window, self.sequence = enc, window, first_sequence
        self.ends = sentence_ends(enc)
        self.runs: list[tuple[object, int, np.ndarray, int]] = []  # doc id, start, ids, ids of the document
        self.held = 0

    def add(self, doc_id, text: str | None) -> Iterator[tuple]:
        ids = np.append(self.enc.ids(text or ""), self.enc.dtype.type(END_ID))
        for start in range(0, len(ids), SEGMENT):
            part = ids[start:start + SEGMENT]
            self.runs.append((doc_id, start, part, len(ids)))
            self.held += len(part)
            if self.held >= SEGMENT:
                yield from self.solve(last=False)

    def solve(self, last: bool) -> Iterator[tuple]:
        if not self.runs:
            return
        ids = np.concatenate([r[2] for r in self.runs])
        n, none = len(ids), HARD + 1
        pen = np.full(n + 1, none, np.int64)
        pen[::GRID] = HARD
        tail = None
        if last:
            tail = max(0, n - 2 * self.window)
            pen[tail:] = HARD
        pen[1:][self.ends[ids]] = SENTENCE
        run_ends = np.cumsum([len(r[2]) for r in self.runs])
        whole = np.array([r[1] + len(r[2]) == r[3] for r in self.runs])
        pen[run_ends[whole]] = 0
        pen[0], pen[n] = 0, min(pen[n], HARD)
        at = np.flatnonzero(pen < none)
        chosen = at[best_cuts(at.tolist(), pen[at].tolist(), self.window, tail, goes_on=not last)]
        yield from self.emit(chosen.tolist(), pen)
        done, left = int(chosen[-1]), []
        for (doc, start, part, total), end in zip(self.runs, run_ends.tolist(), strict=True):
            if end > done:
                skip = max(0, done - (end - len(part)))
                left.append((doc, start + skip, part[skip:], total))
        self.runs, self.held = left, n - done

    def emit(self, cuts: list[int], pen: np.ndarray) -> Iterator[tuple]:
        run, base = 0, 0  # base: stream position where the run starts
        for lo, hi in zip(cuts, cuts[1:]):
            kind = {0: "document", SENTENCE: "sentence"}.get(int(pen[hi]), "hard")
            p = lo
            while p < hi:
                doc, start, ids, total = self.runs[run]
                stop = min(hi, base + len(ids))
                part = ids[p - base:stop - base]
                yield (doc, start + p - base, stop - p, zlib.crc32(part.astype("<u4").tobytes()), total,
                       self.sequence, p - lo, hi - lo, kind)
                p = stop
                if p == base + len(ids):
                    run, base = run + 1, p
            self.sequence += 1


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece of a document (see SCHEMA): where the piece lies in
    its document and in its sequence, the sequence's length, and the kind of
    cut that ends the sequence.

    Each partition is a stream of its own, so nothing is shuffled; the local
    sort makes a task's result the same when it is run again.
    """
    if window % GRID:
        raise ValueError(f"window must be a multiple of {GRID}")
    python_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def packed(batches):
        from pyspark import TaskContext
        packer = Packer(encoder(tokenizer), window, TaskContext.get().partitionId() << 33)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        types = [pa.string() if c.endswith("string") else pa.int64() for c in SCHEMA.split(", ")]

        def batch(pieces):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pieces), types)], names)

        pieces: list[tuple] = []
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                pieces.extend(packer.add(doc_id, text.as_py()))
                if len(pieces) >= 10_000:
                    yield batch(pieces)
                    pieces = []
        pieces.extend(packer.solve(last=True))
        if pieces:
            yield batch(pieces)

    return rows.sortWithinPartitions("doc_id", "text").mapInArrow(packed, SCHEMA)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
