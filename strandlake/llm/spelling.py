"""Spelling variants by permuterm rotations.

A word with a terminator behind it is turned round to start at each of its places. Two words that differ in one
replaced letter share the rotation that starts behind that letter, up to its last sign; a word with one letter more has
the whole rotation of the shorter one in front of that letter. So every rotation is listed twice, whole and without its
last sign; rows are sorted by what is left, and a scan over each run of equal keys gives every word the number of its
mates there and the best of them. No pair is written.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table

#: A run of letters, as the contract has it.
LETTERS = r"[A-Za-zÀ-ÿ]+"
END = "$"  # no letter


def _low(c: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def noisy_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 199) -> DataFrame:
    """(word): each letter run of each text, lower-cased; where `every` divides the crc32 of `<doc_id>:<run>`, the run
    lacks the letter that the crc32 points to. A null doc_id counts as an empty text."""
    runs = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(LETTERS), F.lit(0))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run")).select("id", _low(F.col("run")).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.select(F.when(F.col("h") % every == 0, less).otherwise(F.col("run")).alias("word"))


def count_words(words: DataFrame, least_length: int = 6, least_n: int = 5) -> DataFrame:
    """(word, n) of the words of at least that length and number of occurrences."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def near_words(counts: DataFrame) -> DataFrame:
    """(word, n_near, near: struct<n, word>) of the words (word, n, each once) that have words at one edit's distance: how
    many these are, and the one of largest n (ties: smallest word). Words must not hold the terminator `$`.

    A key's run holds at most one whole word and one word for each letter of the alphabet.
    """
    marked = F.concat("word", F.lit(END))
    turned = counts.select("n", F.length("word").alias("size"), marked.alias("w")).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("size"))))
    rotation = F.concat(F.substring("w", F.col("at") + 1, F.col("size") + 1), F.substring("w", F.lit(1), F.col("at")))
    turned = turned.select("n", "at", "size", rotation.alias("r"), (F.substring("w", F.col("at"), F.lit(1)) != F.substring("w", F.col("at") - 1, F.lit(1))).alias("other"))
    whole = F.struct(F.col("r").alias("key"), F.lit("").alias("skipped"), F.lit(False).alias("first"))
    # of equal letters in a row, any may be the added one: the first stands for all
    cut = F.struct(F.substring("r", F.lit(1), F.col("size")).alias("key"), F.substring("r", F.col("size") + 1, F.lit(1)).alias("skipped"), ((F.col("at") == 1) | F.col("other")).alias("first"))
    rows = turned.select("n", F.explode(F.when(F.col("at") == 0, F.array(whole)).otherwise(F.array(whole, cut))).alias("x")).select("n", "x.*")
    behind, front = F.substring_index("key", END, 1), F.substring_index("key", END, -1)
    rows = rows.withColumn("me", F.struct((-F.col("n")).alias("minus"), F.concat(front, F.col("skipped"), behind).alias("word")))
    key = W.partitionBy("key")
    ranked = key.orderBy(F.col("skipped") == "", "me")  # the cut ones first, the best ahead
    every = ranked.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    is_cut = F.col("skipped") != ""
    rows = rows.withColumn("place", F.row_number().over(ranked)).withColumn("cuts", F.count_if(is_cut).over(every)).withColumn("longer", F.count_if("first").over(every))
    rows = rows.withColumn("best", F.first("me").over(every)).withColumn("second", F.nth_value("me", 2).over(every)).withColumn("shorter", F.last(F.when(~is_cut, F.col("me"))).over(every)).withColumn("best_longer", F.min(F.when(F.col("first"), F.col("me"))).over(every))
    extra = F.col("first") & F.col("shorter").isNotNull()
    mates = F.when(is_cut, F.col("cuts") - 1 + extra.cast("int")).otherwise(F.col("longer"))
    replaced = F.when(F.col("cuts") > 1, F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("best")))
    mate = F.when(is_cut, F.least(replaced, F.when(extra, F.col("shorter")))).otherwise(F.col("best_longer"))
    found = rows.select(F.col("me.word").alias("word"), mates.alias("mates"), mate.alias("mate")).where("mates > 0")
    summed = found.groupBy("word").agg(F.sum("mates").alias("n_near"), F.min("mate").alias("near"))
    return summed.select("word", "n_near", F.struct((-F.col("near.minus")).alias("n"), F.col("near.word").alias("word")).alias("near"))


def group_variants(counts: DataFrame, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words (word, n).

    A word's form is its best near word if that is at least `times` as frequent; its root is the last of the forms of
    forms. Each step multiplies n, so chains are short; their length halves in each round. Words without near words have
    n_near 0; words without form are their own root; no words give no rows.
    """
    counts = table(counts.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    near = near_words(counts)
    is_form = F.col("near.n") >= times * F.col("n")
    known = table(counts.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near.word")).alias("form"), F.when(is_form, F.col("near.n")).alias("form_n")), "spelling-forms")
    roots = table(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = table(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return group_variants(count_words(noisy_words(docs)))


_CRC_BYTE = "list_reduce(list_prepend(v, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
# crc32 of the UTF-8 text s, a byte at a time, by the table that the first line makes
CRC_TABLE = f"crc AS (SELECT list({_CRC_BYTE} ORDER BY v) AS t FROM range(256) r(v))"


def crc_sql(s: str) -> str:
    """DuckDB's crc32 of the text `s`, with crc.t of CRC_TABLE at hand."""
    codes = f"list_transform(range(CAST(octet_length(encode({s})) AS BIGINT)), lambda i: CAST('0x' || hex(encode({s}))[2 * i + 1:2 * i + 2] AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1])), 4294967295)"


SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run FROM documents),
hashed AS MATERIALIZED (SELECT run, {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc WHERE length(run) >= 6),
words AS (SELECT CASE WHEN h % 199 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
counts AS MATERIALIZED (SELECT word, count(*) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
dropped AS MATERIALIZED (SELECT DISTINCT word, p, word[1:p] || word[p + 2:] AS less FROM (SELECT word, unnest(range(length(word))) AS p FROM counts)),
pairs AS (SELECT a.word, b.word AS near FROM dropped a JOIN dropped b ON a.less = b.less AND a.p = b.p WHERE a.word <> b.word
    UNION SELECT d.word, c.word FROM dropped d JOIN counts c ON d.less = c.word UNION SELECT c.word, d.word FROM dropped d JOIN counts c ON d.less = c.word),
best AS (SELECT p.word, count(*) OVER (PARTITION BY p.word) AS n_near, near, c.n AS near_n FROM pairs p JOIN counts c ON c.word = near QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY c.n DESC, near) = 1),
known AS MATERIALIZED (SELECT c.word, c.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * c.n THEN near END AS form, CASE WHEN near_n >= 5 * c.n THEN near_n END AS form_n FROM counts c LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, 0 AS step FROM known UNION ALL SELECT chain.word, k.form, step + 1 FROM chain JOIN known k ON k.word = chain.root WHERE k.form IS NOT NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM known JOIN (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word) USING (word)
"""
