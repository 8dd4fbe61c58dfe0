"""Secret scan, DataFrame functions only: fixed rules, and character Markov
models of random strings and of ordinary identifiers compared by their
log-likelihood ratio.

Spans are code point ranges, end exclusive.  Rule spans are the leftmost
non-overlapping matches of each kind that are long enough.  The models are
first-order chains over the token alphabet, counted over the whole table.
Random strings to learn from are digests (hexadecimal and base 64) of all
texts and the values the rules caught, which together weigh CAUGHT of the
digests however many they are; ordinary identifiers are the letter tokens
outside the rules.  Smoothing is a fixed share of the evidence beyond EVIDENCE
pairs, so the same mixture of texts gives the same model at any size.  A token of LEAST or more characters whose
ratio reaches THRESHOLD adds a span of kind ``markov`` unless it overlaps a
rule span.

Defined cases: a null text is empty; a text without spans gives zero counts
and empty lists; a null id stays null and every input row gives one row,
repeated rows too; without any text to learn from the models are uniform and
add nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written

# The rules of the contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"

# The tokens that the models judge, and their alphabet.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST = 8             # fewer characters seldom hold the evidence that THRESHOLD asks for
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_]{6,}(?![A-Za-z0-9+/_=-])"
THRESHOLD = 12.0      # natural log of the ratio of likelihoods
CAUGHT = 0.25         # weight of all caught strings, where there are any, to that of all digests
SMOOTHING = 0.5       # of each pair, up to EVIDENCE pairs; beyond them it grows in proportion
EVIDENCE = 500_000
KINDS = ("assign", "access", "hex", "markov")


def matches(text: Column, pattern: str, kind: int) -> Column:
    """(kind, i, gap, m): the i-th match and the characters between it and
    the one before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    rows = F.transform(F.arrays_zip(found.alias("m"), F.transform(pieces, F.length).alias("gap")),
                       lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), x["gap"].alias("gap"),
                                             x["m"].alias("m")))
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,m:string>>")
    return F.when(text.rlike(pattern), F.filter(rows, lambda x: x["m"].isNotNull())).otherwise(none)


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: rid, doc_id and ``found``, all rule and token
    matches.  Written, as three steps read it and texts are read once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    patterns = (ASSIGN, ACCESS, HEX, TOKEN % LEAST)
    return written(docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                               F.concat(*[matches(text, p, k) for k, p in enumerate(patterns)]).alias("found")),
                   "found")


def valid(kind: Column, m: Column) -> Column:
    """Which rule matches are long enough."""
    return F.when(kind == 0, F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_LEAST).otherwise(kind < 3)


def pairs(strings: DataFrame) -> DataFrame:
    """Counts of neighbouring characters in column ``s``; at most one row per
    pair of the alphabet."""
    each = F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda i: F.substring("s", i, 2)))
    return (strings.filter(F.length("s") > 1).select(each.alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
            .filter(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$")))


def mixed(digests: dict[str, float], caught: dict[str, float]) -> dict[str, float]:
    """Counts of random strings: those of the digests, and those of the caught
    strings at CAUGHT of the digests' sum."""
    scale = CAUGHT * sum(digests.values()) / max(1, sum(caught.values()))
    return {pair: digests.get(pair, 0) + scale * caught.get(pair, 0) for pair in digests.keys() | caught.keys()}


def chain(counts: dict[str, float]) -> dict[str, float]:
    """Log of P(b | a) by pair ab."""
    total: dict[str, float] = {}
    for pair, c in counts.items():
        total[pair[0]] = total.get(pair[0], 0) + c
    each = SMOOTHING * max(1, sum(counts.values()) / EVIDENCE)
    return {a + b: math.log((counts.get(a + b, 0) + each) / (total.get(a, 0) + each * len(ALPHABET)))
            for a in ALPHABET for b in ALPHABET}


def train(docs: DataFrame, found: DataFrame, text_col: str) -> dict[str, float]:
    """Log of P(b | a) among random strings over P(b | a) among ordinary
    identifiers, by pair ab, from all texts.  Each kind of string has at most
    one count per pair, so what reaches the driver is bounded by the alphabet."""
    part = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    caught = (found.select(F.explode("found").alias("x")).filter(valid(F.col("x.kind"), F.col("x.m")))
              .select(F.when(F.col("x.kind") == 0, F.regexp_extract("x.m", ASSIGN, 2)).otherwise(F.col("x.m"))
                      .alias("s")))
    digests = part.select(F.explode(F.array(F.sha2("text", 256), F.base64(F.unhex(F.sha2("text", 384))))).alias("s"))
    plain = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " ")
    words = part.select(F.explode(F.regexp_extract_all(plain, F.lit(IDENTIFIER), F.lit(0))).alias("s"))
    digests, caught, words = ({r.pair: r.n for r in pairs(s).collect()} for s in (digests, caught, words))
    random, plain = chain(mixed(digests, caught)), chain(words)
    return {pair: random[pair] - plain[pair] for pair in random}


def log_ratio(model: dict[str, float], s: Column) -> Column:
    """Sum of the pairs' log ratios along a string, in one pass over it."""
    flat = [0.0] * (128 * 128)
    for pair, v in model.items():
        flat[ord(pair[0]) * 128 + ord(pair[1])] = round(v, 6)
    values = F.from_json(F.lit(json.dumps(flat)), "array<double>")  # folded to one literal
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.split(s, ""), start, lambda acc, c: F.struct(
        F.ascii(c).alias("last"), (acc["sum"] + F.element_at(values, acc["last"] * 128 + F.ascii(c) + 1)).alias("sum")),
        lambda acc: acc["sum"])


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
         model: dict[str, float] | None = None) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_markov,
    ``base`` and ``all``, the rule spans and all spans as sorted arrays of
    (start, kind, end)."""
    found = scan(docs, id_col, text_col)
    if model is None:
        model = train(docs, found, text_col)
    one = found.select("rid", "doc_id", F.explode_outer("found").alias("x")).select("rid", "doc_id", "x.*")
    before = Window.partitionBy("rid", "kind").orderBy("i")
    start = (F.sum("gap").over(before) + F.sum(F.length("m")).over(before) - F.length("m")).cast("long")
    good = F.when(F.col("kind") == 3, log_ratio(model, F.col("m")) >= threshold).otherwise(
        valid(F.col("kind"), F.col("m")))
    spans = one.withColumn("start", start).select(
        "rid", "doc_id", "kind", good.alias("good"),
        F.struct("start", "kind", (F.col("start") + F.length("m")).alias("end")).alias("span"))
    rule, own = F.col("good") & (F.col("kind") < 3), F.col("good") & (F.col("kind") == 3)
    lists = spans.groupBy("rid", "doc_id").agg(
        *[F.count_if(F.col("good") & (F.col("kind") == k)).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sort_array(F.collect_list(F.when(rule, F.col("span")))).alias("base"),
        F.collect_list(F.when(own, F.col("span"))).alias("own"))
    apart = F.filter("own", lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    return lists.withColumn("own", apart).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.size("own").cast("long").alias("n_markov"), "base",
        F.sort_array(F.concat("base", "own")).alias("all"))


def joined(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find(docs).select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined("base"), 256).alias("base_sha256"),
                             joined("all").alias("spans"), "n_markov")
