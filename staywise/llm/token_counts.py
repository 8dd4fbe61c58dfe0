"""Token counts per section by offset-mapped attribution.

A document is encoded once, as a whole.  Byte-level tokens tile its bytes, so
running sums of their lengths are their spans; sections are spans of code
points, mapped to bytes.  Both lists are sorted, and an interval join counts
the tokens of each section.  A token that crosses a section's end goes by an
explicit rule: to the section of its ``first`` byte, of its ``last`` byte, or
to the one that holds ``most`` of it (ties to the earlier).

Defined cases: a null text is empty; an empty text has one empty section; a
line keeps its line feed; bytes outside all given sections count nowhere; a
null id stays null; repeated rows are counted each; an empty table gives an
empty result; a document without given sections gives no row; other columns
do not enter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_workers, table
from .encoder import encoder
from .packing import tokenizer_path

RULES = ("first", "last", "most")
SCHEMA = "doc_id long, section long, start long, end long, tokens long, crossing long"


def line_sections(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of a text's lines, line feeds included."""
    ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    return np.concatenate([[0], ends]), np.concatenate([ends, [len(raw)]])


def code_points(raw: bytes) -> np.ndarray:
    """Byte offset of every code point, and the end."""
    b = np.frombuffer(raw, np.uint8)
    return np.append(np.flatnonzero((b & 0xC0) != 0x80), len(b))


def attributed(tokens: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section and how many of a section's tokens reach beyond
    it.  ``tokens`` are the byte offsets of token starts and of the end;
    sections are disjoint and ascending."""
    lo, hi = tokens[:-1], tokens[1:]
    solid = hi > lo
    lo, hi = lo[solid], hi[solid]
    first = np.searchsorted(starts, lo, "right") - 1   # last section that starts at or before the token
    last = np.searchsorted(starts, hi - 1, "right") - 1
    owner = last if rule == "last" else first
    if rule == "most":
        owner = owner.copy()
        for i in np.flatnonzero(first != last).tolist():
            s = np.arange(max(first[i], 0), last[i] + 1)
            share = np.minimum(hi[i], ends[s]) - np.maximum(lo[i], starts[s])
            owner[i] = s[share.argmax()] if share.max() > 0 else -1
    point = {"first": lo, "last": hi - 1, "most": lo}[rule]
    inside = (owner >= 0) & (point < ends[owner])
    crossing = inside & ((lo < starts[owner]) | (hi > ends[owner]))
    return np.bincount(owner[inside], minlength=len(starts)), np.bincount(owner[crossing], minlength=len(starts))


def attribute(docs: DataFrame, tokenizer: str, *, rule: str = "first", sections: DataFrame | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and section (SCHEMA; start and end in code
    points).  Sections are the text's lines, or the disjoint spans given by
    ``sections`` (doc_id, section, start, end), gathered per document."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    python_workers(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if sections is not None:
        spans = sections.groupBy("doc_id").agg(
            F.sort_array(F.collect_list(F.struct(*[F.col(c).cast("long").alias(c) for c in ("start", "end", "section")])))
            .alias("spans"))
        rows = rows.join(spans, "doc_id")
    given = sections is not None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        lengths = enc.byte_lengths()
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for i, (doc_id, text) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("text"))):
                text = text.as_py() or ""
                raw = text.encode("utf-8", "replace")
                tokens = np.concatenate([[0], np.cumsum(lengths[enc.ids(text)])])
                points = code_points(raw)
                if given:
                    spans = b.column("spans")[i].as_py()
                    number = np.array([s["section"] for s in spans])
                    at = [np.clip([s[k] for s in spans], 0, len(points) - 1) for k in ("start", "end")]
                    starts, ends = points[at[0]], points[at[1]]
                else:
                    starts, ends = line_sections(raw)
                    number, at = np.arange(len(starts)), [np.searchsorted(points, x) for x in (starts, ends)]
                n, crossing = attributed(tokens, starts, ends, rule)
                for column, values in zip(out, ([doc_id] * len(n), number.tolist(), at[0].tolist(), at[1].tolist(),
                                                n.tolist(), crossing.tolist())):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             [c.split()[0] for c in SCHEMA.split(", ")])

    return rows.mapInArrow(count, SCHEMA)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return attribute(table(spark, sf_dir, "documents"), tokenizer_path())
