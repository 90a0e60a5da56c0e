"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the common form of each rare one.

A word of ``L`` code points gives two disjoint chunks, its first ``L // 2`` and the rest. A word of ``L`` or ``L + 1`` code points
gives the positional grams that such chunks can be: one edit leaves a chunk whole, and the chunk behind the edit
moves by one place at most. Words that share a chunk in that place meet. Common chunks would bring too many words together, so the
half that the edit lies in is divided again in the same way, ``LEVELS`` times or until two code points are left: each key is
then a word without a short window, known by what lies before and after it. Pairs that meet are verified by their edit distance.
No pair is lost at any level, and no key is capped; Spark's skew join divides what is still large.

Words are maximal runs of Latin letters of whole texts with only A-Z in lower case; of some runs, chosen by a checksum, a letter is left out
beforehand (``MISSPELL``). Equal words are counted before anything is joined, so repeated rows only raise counts. A null text has no
words; a null doc_id is written as nothing in the checksum. Of two equally common near words the one first in code-point order
is the form. Very long texts and words are taken whole. Extra columns of any name are not read. Without words there are no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import stage
from farelake.plans.crc import CRC_TABLE_SQL, crc32_sql

LETTERS = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: How many times more common a form must be than its variant.
RATIO = 5
#: One run in this many loses a letter.
MISSPELL = 199
LEVELS = 4
#: Counts grow RATIO-fold along a chain of forms and fit in 63 bits, so 2**5 steps reach every root.
DOUBLINGS = 5


def word_counts(docs: DataFrame, misspell: int | None = MISSPELL) -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough."""
    lowered = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("run"),
    ).filter(F.length("run") >= LEAST_LENGTH)
    if misspell:
        hashed = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")))
        at = F.pmod("h", F.length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = hashed.select(F.when(F.col("h") % misspell == 0, cut).otherwise(F.col("run")).alias("run"))
    counts = runs.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT))


def windows(length: Column) -> Column:
    """The windows (a, b) that a word of ``length`` is divided into: disjoint, and together the whole word."""
    parts = F.array(F.struct(F.lit(0).alias("a"), length.alias("b")))

    def halves(w: Column) -> Column:
        middle = w["a"] + F.floor((w["b"] - w["a"]) / 2).cast("int")
        left = F.struct(w["a"].alias("a"), middle.alias("b"))
        right = F.struct(middle.alias("a"), w["b"].alias("b"))
        return F.when(w["b"] - w["a"] <= 2, F.array(w)).otherwise(F.array(left, right))

    for _ in range(LEVELS):
        parts = F.flatten(F.transform(parts, halves))
    return parts


def keyed(words: DataFrame, longer: int, name: str) -> DataFrame:
    """(key, name) per window: words in the place of the chunk side (``longer`` 0) or with one code point more in the window."""
    length = F.length(name) - longer
    rows = words.select(name, length.alias("_l"), F.explode(windows(length)).alias("_w"))
    before = F.substring(name, F.lit(1), F.col("_w.a"))
    after = F.substring(name, F.col("_w.b") + 1 + longer, F.col("_l"))
    return rows.select(F.xxhash64("_l", "_w.a", before, after).alias("key"), name)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b) once per pair of words that differ by one inserted, deleted or replaced code point."""
    chunks = keyed(words.select(F.col("word").alias("a")), 0, "a")
    grams = keyed(words.select(F.col("word").alias("b")), 0, "b").union(keyed(words.select(F.col("word").alias("b")), 1, "b"))
    met = chunks.join(grams, "key").filter((F.length("a") < F.length("b")) | (F.col("a") < F.col("b")))
    return met.filter(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of each (word, form): the end of its chain of forms."""
    known = forms.select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        further = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        known = stage(known.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return known


def variants(docs: DataFrame, misspell: int | None = MISSPELL) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word."""
    words = stage(word_counts(docs, misspell), "spelling-words")
    pairs = stage(near_pairs(words), "spelling-pairs")
    both = pairs.union(pairs.select("b", "a")).toDF("word", "near")
    sized = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # The smallest of the negated count and the word: most common first, ties in code-point order.
    best = sized.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    common = -F.col("best.less") >= RATIO * F.col("n")
    told = stage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(common, F.col("best.near")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n"),
    ), "spelling-forms")
    roots = follow(told.filter("form IS NOT NULL"))
    return told.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants_sql() -> str:
    """The rows of ``variants`` in DuckDB: near words are those that agree but for one place."""
    return f"""
    WITH RECURSIVE {CRC_TABLE_SQL},
    runs AS (
        SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(run, '{UPPER}', '{LOWER}') AS run
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    ),
    per_doc AS (SELECT doc, run, count(*) AS n FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY doc, run),
    hashed AS (SELECT run, n, {crc32_sql("doc || ':' || run")} AS h FROM per_doc, crc_table),
    spelled AS (
        SELECT n, CASE WHEN h % {MISSPELL} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
    ),
    words AS (
        SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
    ),
    places AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
    cut AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
    near AS (
        SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT word, rest FROM cut JOIN (SELECT word AS rest FROM words) USING (rest)
        UNION SELECT rest, word FROM cut JOIN (SELECT word AS rest FROM words) USING (rest)
    ),
    best AS (
        SELECT near.word, count(*) AS n_near, max(w.n) AS most, min(near.near) FILTER (w.n = m.most) AS form
        FROM near JOIN words w ON w.word = near.near
        JOIN (SELECT near.word, max(n) AS most FROM near JOIN words ON words.word = near.near GROUP BY near.word) m ON m.word = near.word
        GROUP BY near.word
    ),
    told AS (
        SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= {RATIO} * n THEN form END AS form,
            CASE WHEN most >= {RATIO} * n THEN most END AS form_n
        FROM words LEFT JOIN best ON best.word = words.word
    ),
    chain AS (
        SELECT word, word AS root, 0 AS step FROM told
        UNION ALL SELECT chain.word, told.form, step + 1 FROM chain JOIN told ON told.word = chain.root WHERE told.form IS NOT NULL
    )
    SELECT told.*, root FROM told JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) ends ON ends.word = told.word"""
