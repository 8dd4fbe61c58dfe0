"""Language identification of words in code-switched text by a linear-chain
conditional random field.

A word's features are hashed character bigrams and trigrams (word ends
included), affixes, and membership in the lexicon of each language (its
frequent words in the sample).  Transitions between the labels of neighbouring
words are learnt with them, on sequences joined from pieces of labelled
documents of different languages.  Forward-backward gives each word's
posterior; a document's language is the label with the greatest expected share
of its words, its score that share.

Learning uses about SAMPLE documents per language, chosen by a hash of the
id, and PIECES pieces of PIECE words from anywhere in each; scoring reads all
texts whole.

Defined cases: texts that are null or hold no letter are ``und`` with score 0;
null languages are no labels; without labels every text is ``und``; ties go to
the first language by code point; a null id is neither held out nor learnt
from; repeated rows are scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_workers, table

FOLDS, HELD_OUT = 4, 2
SAMPLE = 400         # documents per language
PIECES, PIECE = 4, 24
LEXICON = 300        # words per language
BUCKETS = 1 << 15    # hashed features
SEGMENT = 64         # words between kept forward and backward messages
CHARS = 4_000_000    # characters times labels handled at once, by 4
SEED = 5

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def hashed(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.uint32)
    for p in parts:
        h = (h ^ p.astype(np.uint32)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
    return h


@dataclass
class Words:
    """Words of a batch of texts with their features."""
    text: np.ndarray      # of each word, the number of its text
    starts: np.ndarray
    ends: np.ndarray
    grams: list[np.ndarray]    # bucket at each position, by n-gram length
    affixes: list[np.ndarray]  # bucket of each word
    name: np.ndarray           # hash of each word


def words_of(texts: list[str]) -> Words:
    raw = np.frombuffer((" " + "  ".join(texts).lower() + "    ").encode("utf-32-le", "replace"), np.uint32)
    known = letters()
    c = np.where(known[np.minimum(raw, len(known) - 1)], raw, 0)
    edges = np.flatnonzero((c[1:] != 0) != (c[:-1] != 0)) + 1
    starts, ends = edges[0::2], edges[1::2]
    lengths = np.cumsum([len(t.lower()) + 2 for t in texts])
    mask = np.uint32(BUCKETS - 1)
    pad = np.concatenate([c, np.zeros(4, np.uint32)])
    at = lambda k: pad[k:k + len(c)]
    grams = [hashed(at(0), at(1), np.full(1, 2)) & mask, hashed(at(0), at(1), at(2), np.full(1, 3)) & mask]
    size = np.minimum(ends - starts, 5)
    first, last = starts, ends - 1
    affixes = [hashed(c[first], pad[first + 1], pad[first + 2], pad[first + 3], np.full(1, 11)) & mask,
               hashed(c[last], c[last - 1], c[np.maximum(last - 2, 0)], np.full(1, 12)) & mask,
               hashed(c[last], c[last - 1], size, np.full(1, 13)) & mask]
    x = (c.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    order = (np.arange(len(c)) - np.repeat(np.concatenate([[0], starts]),
                                           np.diff(np.concatenate([[0], starts, [len(c)]])))).astype(np.uint64)
    x = (x ^ (x >> np.uint64(29))) * (order * np.uint64(2) + np.uint64(0xBF58476D1CE4E5B9))
    name = sums(x, starts, ends)
    return Words(np.searchsorted(lengths, starts - 1, "right"), starts, ends, grams, affixes, name)


def sums(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of x over each [start, end)."""
    if not len(starts):
        return np.zeros((0, *x.shape[1:]), x.dtype)
    return np.add.reduceat(x, np.stack([starts, ends], 1).ravel())[::2]


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray    # BUCKETS + labels (lexicons), labels
    moves: np.ndarray      # label to label
    names: np.ndarray      # lexicon: sorted word hashes
    member: np.ndarray     # and their languages, 0/1

    def lexicon(self, w: Words) -> np.ndarray:
        """0/1 by word and language."""
        if not len(self.names):
            return np.zeros((len(w.name), len(self.labels)), np.float32)
        at = np.minimum(np.searchsorted(self.names, w.name), len(self.names) - 1)
        return self.member[at] * (self.names[at] == w.name)[:, None]

    def emissions(self, w: Words) -> np.ndarray:
        out = self.lexicon(w) @ self.weights[BUCKETS:]
        two, three = (self.weights[g] for g in w.grams)
        # word ends count: a bigram may start one before the word, a trigram too
        out += sums(two, w.starts - 1, w.ends) + sums(three, w.starts - 1, w.ends - 1 + (w.ends - w.starts == 1))
        for a in w.affixes:
            out += self.weights[a]
        return out


def posteriors(emissions: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over sequences laid end to end (``lengths`` words
    each, none empty): the labels' probabilities of each word, and the
    expected number of each pair of neighbouring labels.  A uniform label
    stands before each first word.

    Segments of SEGMENT words run side by side: first their transfer
    matrices, then the messages between segments of a sequence, then all words
    from those messages.  Exact, with a loop over segments instead of words.
    """
    n, k = emissions.shape
    a = np.exp(moves - moves.max())
    e = np.exp(emissions - emissions.max(1, keepdims=True)) + 1e-30
    parts = -(-lengths // SEGMENT)
    seg_of = np.repeat(np.arange(len(lengths)), parts)
    first_seg = np.cumsum(parts) - parts
    place = np.arange(len(seg_of)) - first_seg[seg_of]
    begin = (np.cumsum(lengths) - lengths)[seg_of] + place * SEGMENT
    size = np.minimum(SEGMENT, lengths[seg_of] - place * SEGMENT)
    steps = int(size.max())
    index = begin[:, None] + np.arange(steps)
    valid = np.arange(steps) < size[:, None]
    ep = e[np.where(valid, index, 0)]
    m = np.broadcast_to(np.eye(k), (len(seg_of), k, k))
    for t in range(steps) if parts.max() > 1 else ():
        new = (m.reshape(-1, k) @ a).reshape(-1, k, k) * ep[:, t, None, :]
        new /= new.max((1, 2), keepdims=True)
        m = np.where(valid[:, t, None, None], new, m)
    into, out = np.full((len(seg_of), k), 1 / k), np.ones((len(seg_of), k))
    for p in range(1, int(parts.max())):
        s = first_seg[parts > p] + p
        v = np.einsum("si,sij->sj", into[s - 1], m[s - 1])
        into[s] = v / v.sum(1, keepdims=True)
    for p in range(int(parts.max()) - 2, -1, -1):
        s = first_seg[parts > p + 1] + p
        v = np.einsum("sij,sj->si", m[s + 1], out[s + 1])
        out[s] = v / v.max(1, keepdims=True)
    forward, before = np.empty_like(ep), np.empty_like(ep)
    x = into
    for t in range(steps):
        before[:, t] = x
        new = (x @ a) * ep[:, t]
        x = np.where(valid[:, t, None], new / new.sum(1, keepdims=True), x)
        forward[:, t] = x
    result, pairs = np.empty((n, k)), np.zeros((k, k))
    y = out
    for t in range(steps - 1, -1, -1):
        v = valid[:, t]
        both = forward[:, t] * y
        result[index[v, t]] = (both / both.sum(1, keepdims=True))[v]
        after = ep[:, t] * y
        inner = v if t else v & (place > 0)  # words that have one before them
        total = ((before[inner, t] @ a) * after[inner]).sum(1, keepdims=True)
        pairs += a * ((before[inner, t] / total).T @ after[inner])
        new = after @ a.T
        y = np.where(v[:, None], new / new.max(1, keepdims=True), y)
    return result, pairs


def learn(pieces: pd.DataFrame, epochs: int = 4, batch: int = 48, rate: float = 0.3, decay: float = 1e-6) -> Model:
    """Fit by stochastic gradient ascent (AdaGrad) on the conditional
    likelihood.  ``pieces``: lang and words (joined by spaces); bounded by the
    sample, so it is fitted on the driver."""
    pieces = pieces.sort_values(["lang", "words"])  # the same order in every run
    labels = sorted(pieces["lang"].unique())
    k = len(labels)
    rng = np.random.default_rng(SEED)
    label = pieces["lang"].map({x: i for i, x in enumerate(labels)}).to_numpy()
    texts = pieces["words"].tolist()

    member: dict[int, np.ndarray] = {}
    for i in range(k):
        names = words_of([t for t, y in zip(texts, label) if y == i]).name
        found, count = np.unique(names, return_counts=True)
        for j in np.argsort(-count, kind="stable")[:LEXICON]:
            if count[j] > 2:
                member.setdefault(int(found[j]), np.zeros(k, np.float32))[i] = 1
    names = np.array(sorted(member), np.uint64)
    model = Model(labels, np.zeros((BUCKETS + k, k), np.float32), np.zeros((k, k)), names,
                  np.array([member[int(x)] for x in names], np.float32).reshape(len(names), k))
    if k < 2:
        return model

    own = [np.flatnonzero(label == i) for i in range(k)]
    square, square_moves = np.full(model.weights.shape, 1e-6, np.float32), np.full((k, k), 1e-6)
    for _ in range(epochs):
        # sequences of four pieces; the next one is of another language three times in ten
        chains, y = [], rng.integers(k)
        for _ in range(len(texts)):
            if rng.random() < 0.3:
                y = rng.integers(k)
            chains.append(rng.choice(own[y]))
        chains = [chains[i:i + 4] for i in range(0, len(chains), 4)]
        for lo in range(0, len(chains), batch):
            some = chains[lo:lo + batch]
            w = words_of([" ".join(texts[i] for i in c) for c in some])
            per_piece = [len(texts[i].split(" ")) for c in some for i in c]
            truth = np.repeat([label[i] for c in some for i in c], per_piece)
            lengths = np.bincount(w.text, minlength=len(some))
            post, expected = posteriors(model.emissions(w), model.moves, lengths)
            g = -post
            g[np.arange(len(truth)), truth] += 1
            grad = np.zeros(model.weights.shape)
            grad[BUCKETS:] = model.lexicon(w).T @ g
            spans = ((w.grams[0], w.starts - 1, w.ends),
                     (w.grams[1], w.starts - 1, w.ends - 1 + (w.ends - w.starts == 1)))
            for gram, s, e in spans:
                size = e - s
                word = np.repeat(np.arange(len(s)), size)
                where = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size) + s[word]
                for j in range(k):
                    grad[:BUCKETS, j] += np.bincount(gram[where], g[word, j], BUCKETS)
            for a in w.affixes:
                for j in range(k):
                    grad[:BUCKETS, j] += np.bincount(a, g[:, j], BUCKETS)
            grad -= decay * len(truth) * model.weights
            inside = w.text[1:] == w.text[:-1]
            hot = np.eye(k)[truth]
            moves = hot[:-1][inside].T @ hot[1:][inside] - expected
            square += grad ** 2
            model.weights += (rate * grad / np.sqrt(square)).astype(np.float32)
            square_moves += moves ** 2
            model.moves += rate * moves / np.sqrt(square_moves)
    return model


def pieces_of(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> pd.DataFrame:
    """The learning sample: at most PIECES pieces of PIECE words from each of
    about SAMPLE documents of every language."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
        & (F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS != HELD_OUT))
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))  # a row per language, as many as the model has labels
    draw = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 40)) / float(1 << 40)
    chosen = known.join(F.broadcast(sizes), "lang").filter(draw < F.lit(SAMPLE) / F.col("n")).select("id", "text", "lang")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, text, lang in zip(b["id"], b["text"], b["lang"]):
                w = words_of([text])
                low = (" " + text.lower())
                n = len(w.starts)
                rng = np.random.default_rng(int(i) & 0xFFFFFFFF)
                for s in sorted(rng.integers(0, max(1, n - PIECE), PIECES).tolist())[:max(1, n // PIECE)] if n else ():
                    out.append((lang, " ".join(low[a:z] for a, z in zip(w.starts[s:s + PIECE], w.ends[s:s + PIECE]))))
            yield pd.DataFrame(out, columns=["lang", "words"])

    return chosen.mapInPandas(cut, "lang string, words string").toPandas()


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, switches (neighbouring words whose likeliest
    labels differ)."""
    python_workers(docs.sparkSession)
    room = max(10_000, CHARS * 4 // max(4, len(model.labels)))

    def label(texts: list[str]) -> tuple[list[str], list[float], list[int]]:
        langs, scores, switches = ["und"] * len(texts), [0.0] * len(texts), [0] * len(texts)
        w = words_of(texts)
        if not model.labels or not len(w.starts):
            return langs, scores, switches
        lengths = np.bincount(w.text, minlength=len(texts))
        full = np.flatnonzero(lengths)
        post, _ = posteriors(model.emissions(w).astype(float), model.moves, lengths[full])
        firsts = np.cumsum(lengths[full]) - lengths[full]
        total = np.add.reduceat(post, firsts)
        top = post.argmax(1)
        moved = np.add.reduceat(np.append(0, (top[1:] != top[:-1]) & (w.text[1:] == w.text[:-1])), firsts)
        best = total.argmax(1)
        value = np.clip(total[np.arange(len(best)), best] / lengths[full], 0, 1)
        for i, j, v, m in zip(full.tolist(), best.tolist(), value.tolist(), moved.tolist()):
            langs[i], scores[i], switches[i] = model.labels[j], v, m
        return langs, scores, switches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            out: tuple[list, list, list] = ([], [], [])
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= room):
                    size += len(texts[hi])
                    hi += 1
                for all_, part in zip(out, label(texts[lo:hi])):
                    all_.extend(part)
                lo = hi
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(out[0], pa.string()), pa.array(out[1], pa.float64()),
                 pa.array(out[2], pa.int64())], ["doc_id", "lang_pred", "score", "switches"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, switches long")


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    python_workers(spark)
    model = learn(pieces_of(docs, "doc_id", "text", "lang"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "switches")
