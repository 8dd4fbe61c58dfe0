"""Spelling variants: words that differ by one edit, by a trie frontier.

Vocabulary.  Runs of letters of whole texts, A-Z lower-cased; where 97 divides
the crc32 of ``<doc_id>:<run>``, the code point crc32 % length is deleted.
Words are the results of LEAST code points and more that occur SEEN times.

Trie.  A node is a prefix of a word; its row holds the edges to its children,
for each child the pairs of code points that lead on from it and the lengths
of the words below it, and whether the node itself ends a word.

Frontier.  States (word, position, node, edits) are joined with the nodes of
one level after the other.  A state without an edit goes on along its own
word, replaces its code point by another edge, or leaves it out; a state with
an edit follows the rest of its word; a state that used its word up at the end
of a word is a neighbour.  Only replacements by a later code point and
omissions are walked, as each pair needs to be found from one side, and an
edge is taken only if a word of the length sought lies below it and the next
two code points lead on.  Every level is written, so lineage stays short.

Words beyond DEPTH code points would need a level each: pairs with such a
word are found by their halves.  One edit leaves the first or the last half
of the shorter word as it was, so equal halves bring the pair together, and
dropping one code point, or comparing them, decides.

A word's form is its near word of largest count, if that is at least twice its
own; forms are followed by pointer doubling, at most log2 of the log2 of the
largest count rounds, as counts double along the way.

Nodes near the root hold very many states, but are few: levels of few bytes
are broadcast, of the others the heaviest nodes are salted (``common.lookup``).

Defined cases: null and empty texts have no words; a null doc_id reads as
empty text in the hash; repeated rows count each; equal counts go to the
smaller word in code-point order; texts and words of any length are read
whole; an empty table gives an empty result; other columns do not enter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, scratch, table, written

LETTER = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST, SEEN = 5, 3
DROP = 97           # one run in so many loses a code point
DEPTH = 40          # code points of the trie's words: lengths fit the bits of a long
END = "."           # no code point of a word
BROADCAST = 8 << 20   # bytes of the nodes of a level up to which they go to all tasks


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
               seen: int = SEEN) -> DataFrame:
    """word, n: counted over all runs of all texts."""
    text = F.col(text_col)
    # lower() changes more than A-Z, but not in a text of ASCII alone
    plain = F.octet_length(text) == F.length(text)
    # a run shorter than ``least`` gives no word, as runs lose code points only
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), plain.alias("plain"),
        F.explode(F.regexp_extract_all(F.when(plain, F.lower(text)).otherwise(text),
                                       F.lit(f"{LETTER}{{{max(least, 1)},}}+"), F.lit(0))).alias("run"))
    # most runs have no capital, and lower() is the faster one to tell
    low = F.when(F.col("plain") | (F.lower("run") == F.col("run")), F.col("run")).otherwise(
        F.translate("run", UPPER, LOWER))
    rows = runs.select("id", low.alias("run")).select(
        "run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (rows.select(F.when(F.pmod("h", F.lit(DROP)) == 0, less).otherwise(F.col("run")).alias("word"))
            .filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= seen))


def bit(length: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), length)


def trie(words: DataFrame) -> DataFrame:
    """depth, node, below (words), ends, edges (array of ch, next, lens,
    ends): one row a node, as wide as the square of the alphabet at most.
    ``next`` holds what follows a node, two code points or the last one of a
    word and END, each piece between blanks: a text of two that are no blanks
    is found in it only as a piece."""
    prefixes = words.select(F.length("word").alias("size"), "word",
                            F.explode(F.sequence(F.lit(0), F.length("word"))).alias("depth"))
    step = (prefixes.select("depth", F.expr("left(word, depth)").alias("node"),
                            F.expr(f"substring(concat(word, '{END}'), depth + 1, 2)").alias("piece"), "size")
            .groupBy("depth", "node", "piece")
            .agg(F.count("*").alias("below"), F.bit_or(bit(F.col("size"))).alias("lens")))
    nodes = written(step.groupBy("depth", "node").agg(
        F.sum("below").alias("below"), F.bit_or("lens").alias("lens"), F.max(F.col("piece") == END).alias("ends"),
        F.concat(F.lit(" "), F.array_join(F.sort_array(F.collect_list("piece")), " "), F.lit(" ")).alias("next")),
        "trie-nodes")
    child = nodes.filter("depth > 0").select(
        (F.col("depth") - 1).alias("depth"), F.expr("left(node, depth - 1)").alias("node"),
        F.struct(F.expr("right(node, 1)").alias("ch"), F.col("next"), F.col("lens"), F.col("ends")).alias("edge"))
    edges = child.groupBy("depth", "node").agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    return written(nodes.drop("lens", "next").join(edges, ["depth", "node"], "left"), "trie")


# What the edges of a state's node are compared with: the next code point of
# its word and the one after, what follows each of them, and whether it is the last.
SOUGHT = ["word", "node", "edits", "pos", "edges", "ends", "length(word) AS size",
          "substring(word, pos + 1, 1) AS first", "substring(word, pos + 2, 1) AS second",
          f"substring(concat(word, '{END}'), pos + 2, 2) AS after_first",
          f"substring(concat(word, '{END}'), pos + 3, 2) AS after_second",
          "pos + 1 = length(word) AS first_ends", "pos + 2 = length(word) AS second_ends"]


def leads_on(at: str) -> str:
    """Whether the word's code points after the ``at`` one go on below an edge."""
    return f"IF({at}_ends, e.ends, contains(e.next, after_{at}))"


def move(at: str) -> str:
    by = {"first": 1, "second": 2}[at]
    return f"e -> struct(pos + {by} AS pos, concat(node, e.ch) AS node, IF({at}_ends, 2, 1) AS edits)"


# The states that follow one at a node; pos counts the code points used up, and
# edits = 2 marks a neighbour, the word at the node.
STEP = f"""
CASE WHEN edits = 1 THEN
  transform(filter(edges, e -> e.ch = first AND {leads_on('first')}), {move('first')})
ELSE concat(
  IF(pos + 1 < size, array(struct(pos + 1 AS pos, concat(node, first) AS node, 0 AS edits)),
     IF(ends, array(struct(pos + 1 AS pos, node, 2 AS edits)), array())),
  IF(first = second, array(), transform(filter(edges, e -> e.ch = second AND getbit(e.lens, size - 1) = 1
                                                            AND {leads_on('second')}), {move('second')})),
  transform(filter(edges, e -> e.ch > first AND getbit(e.lens, size) = 1 AND {leads_on('first')}), {move('first')}))
END"""


def trie_pairs(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(a, b) once for each pair of near words of up to ``depth`` code points."""
    words = words.filter(F.length("word") <= depth).select("word")
    nodes = trie(words)
    # what the nodes of a level hold, mostly the pairs that follow their edges
    held = dict(nodes.groupBy("depth").agg(F.sum(F.expr(
        "64 + octet_length(node) + coalesce(aggregate(edges, 0L, (x, e) -> x + 64 + octet_length(e.next)), 0L)"))).collect())
    found = []
    states = written(words.select("word", F.lit(0).alias("pos"), F.lit("").alias("node"), F.lit(0).alias("edits")),
                     "frontier")
    for level in range(depth + 1):
        if states.isEmpty():
            break
        here = nodes.filter(F.col("depth") == level).drop("depth").withColumn("edges", F.expr("coalesce(edges, array())"))
        if held.get(level, 0) <= BROADCAST:
            step = states.join(F.broadcast(here), "node")
        else:
            step = lookup(states, here, ["node"], "below", F.xxhash64("word", "pos"))
        states = written(step.selectExpr(*SOUGHT).select("word", F.expr(f"inline({STEP})")), "frontier")
        found.append(states.filter("edits = 2").select(F.col("word").alias("a"), F.col("node").alias("b")))
        states = states.filter("edits < 2")
    out = words.select(F.col("word").alias("a"), F.col("word").alias("b")).limit(0)
    for f in found:
        out = out.unionByName(f)
    return out


def halves_pairs(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(a, b) once for each pair of near words with one beyond ``depth``; a is
    the longer one, or of equal length the smaller in code-point order.

    With h half of the shorter word's length, an edit at or after h leaves the
    first h code points, one before it the last (length - h).  Words with an
    equal half are compared only if they agree in length as well, so a
    group is as large as a half is common among very long words."""
    long = words.filter(F.length("word") >= depth).select("word")
    of = lambda less: F.expr(f"(length(word) - {less}) div 2")  # noqa: E731 - half of the shorter word
    keys = []
    for less in (0, 1):   # as the shorter word (or of equal length), and as the longer one
        size = F.length("word") - less
        keys += [F.struct(size.alias("size"), F.lit(0).alias("side"),
                          F.xxhash64(F.substring("word", F.lit(1), of(less).cast("int"))).alias("half"),
                          F.lit(less).alias("less")),
                 F.struct(size.alias("size"), F.lit(1).alias("side"),
                          F.xxhash64(F.expr(f"right(word, length(word) - {less} - ((length(word) - {less}) div 2))"))
                          .alias("half"), F.lit(less).alias("less"))]
    rows = long.select("word", F.inline(F.array(*keys)))
    a, b = rows.alias("a"), rows.filter("less = 0").alias("b")
    pairs = a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("size", "side", "half")]).filter(
        f"length(a.word) > {depth} OR length(b.word) > {depth}").filter(
        "a.less = 1 OR a.word < b.word").select(F.col("a.word").alias("a"), F.col("b.word").alias("b"))
    # equal up to the first difference, and after it
    pairs = pairs.withColumn("_i", F.expr(
        "array_position(zip_with(split(a, ''), split(b, ''), (x, y) -> x <=> y), false)").cast("int"))
    tail = "IF(length(a) > length(b), substring(b, _i), substring(b, _i + 1))"
    return pairs.filter(F.expr(f"substring(a, _i + 1) = {tail}")).select("a", "b").distinct()


def near_pairs(words: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(word, near) both ways, each once."""
    once = trie_pairs(words, depth).unionByName(halves_pairs(words, depth))
    return once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("word", "near")


def forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = near.join(counts, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.max("near_n").alias("form_n"),
        F.min_by("near", F.struct(-F.col("near_n"), F.col("near"))).alias("form"))
    own = F.col("form_n") >= 2 * F.col("n")
    rows = written(words.join(best, "word", "left").select(
        "word", F.when(own, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(own, F.col("form_n")).alias("form_n")), "forms")
    links = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("to"))
    while True:   # each round halves what is left of the way
        ahead = links.select(F.col("word").alias("to"), F.col("to").alias("further"))
        step = written(links.join(ahead, "to", "left"), "roots")
        links = step.select("word", F.coalesce("further", "to").alias("to"))
        if step.filter("further IS NOT NULL").isEmpty():
            break
    return rows.join(links, "word", "left").select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near",
                                                   "form_n")


def variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
             seen: int = SEEN, depth: int = DEPTH) -> DataFrame:
    with scratch(docs.sparkSession) as keep:
        words = written(vocabulary(docs, id_col, text_col, least, seen), "words")
        return keep(forms(words, near_pairs(words, depth)), "llm-variants")


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE
tab AS (SELECT list(c ORDER BY i) AS tab FROM (
  SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
runs AS (SELECT doc_id, run, count(*) AS k FROM (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) GROUP BY doc_id, run),
hx AS (SELECT run, k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs),
crc AS (SELECT run, k, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(1, length(h) // 2 + 1), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS h FROM hx, tab),
words AS (SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM crc)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
pos AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
dels AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS d FROM pos),
less AS (SELECT DISTINCT d.word AS a, w.word AS b FROM dels d JOIN words w ON d.d = w.word),
near AS (SELECT a AS word, b AS near FROM less UNION SELECT b, a FROM less
  UNION SELECT x.word, y.word FROM dels x JOIN dels y ON x.i = y.i AND x.d = y.d AND x.word <> y.word),
best AS (SELECT near.word, near.near, w.n AS near_n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY w.n DESC, near.near) AS r
  FROM near JOIN words w ON w.word = near.near),
forms AS (SELECT w.word, CASE WHEN near_n >= 2 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND b.r = 1),
walk AS (SELECT word, word AS at FROM forms
  UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON f.word = walk.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk USING (word) JOIN forms e ON e.word = walk.at WHERE e.form IS NULL
"""
