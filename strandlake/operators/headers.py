"""Many headers at once: search for many patterns, and names that stand for one another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.session import drop

from .scan import kept


def _grams(text: str, size: int) -> Column:
    """The distinct substrings of `size` letters."""
    last = F.length(text) - (size - 1)
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(F.col(text), i, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def find_by_headers(rows: DataFrame, wanted: DataFrame, gram: int = 6) -> DataFrame:
    """(pattern, contig, ord, header): of each contig of rows (contig, ord, header) and each pattern of wanted (pattern), the
    first row by ord, then header, whose header holds the pattern's text.

    Each pattern is looked up by the rarest of its substrings of `gram` letters (of its own length, if it is shorter), so
    headers meet only patterns they may hold; then the whole pattern is compared. Null and empty patterns find nothing,
    repeated ones count once. Patterns may be as many as the headers, and planners take a table of substrings for smaller than it
    is, so both sides of each join are shuffled.
    """
    patterns = kept(wanted.select("pattern").where("pattern <> ''").distinct(), "patterns")
    sizes = [r.n for r in patterns.select(F.least(F.length("pattern"), F.lit(gram)).alias("n")).distinct().collect()]  # at most `gram` numbers
    headers = rows.where("header IS NOT NULL").select("contig", "ord", "header").repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "contig", "ord", "header")
    found = None
    for n in sorted(sizes):
        of = patterns.where(F.length("pattern") >= gram if n == gram else F.length("pattern") == n)
        parts = of.select("pattern", F.explode(_grams("pattern", n)).alias("gram"))
        grams = headers.select("contig", "ord", "header", F.explode(_grams("header", n)).alias("gram"))
        seen = kept(grams.join(parts.select("gram").distinct().hint("merge"), "gram", "left_semi"), "seen-grams")
        counts = seen.groupBy("gram").agg(F.count("*").alias("n"))
        complete = parts.join(counts.hint("merge"), "gram", "left").groupBy("pattern").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.count_if(F.col("n").isNull()).alias("absent")).where("absent = 0")
        held = seen.join(complete.select("pattern", "gram").hint("merge"), "gram").where(F.contains("header", "pattern")).select("pattern", "contig", "ord", "header")
        first = kept(held.groupBy("pattern", "contig").agg(F.min(F.struct("ord", "header")).alias("first")), "found-headers")
        drop(seen)
        found = first if found is None else found.unionByName(first)  # a pattern has one length
    if found is None:
        return rows.select(F.lit("").alias("pattern"), "contig", "ord", "header").limit(0)
    return found.select("pattern", "contig", "first.ord", "first.header")


def header_ids(header: Column) -> Column:
    """All ids of a header: its pieces between bars, white space, commas and semicolons, without `>`, each with and without
    a version (`.` and digits at its end)."""
    pieces = F.filter(F.split(F.regexp_replace(header, "^>+", ""), r"[|\s,;]+"), lambda x: x != "")
    return F.array_distinct(F.flatten(F.transform(pieces, lambda x: F.array(x, F.regexp_replace(x, r"\.\d+$", "")))))


def name_classes(equal: DataFrame) -> DataFrame:
    """(name, class) of pairs (a, b) of names for one thing: the smallest name that pairs lead to.

    Each round a name takes the smallest class of its neighbours and then that name's class, so that ways halve; rounds
    are tables in the shared folder. Pairs with a null count for nothing; names without a pair have no row.
    """
    pairs = equal.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = kept(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "names")
    classes = kept(both.groupBy(F.col("a").alias("name")).agg(F.least(F.min("b"), F.min("a")).alias("class")), "name-classes")
    while True:
        near = both.join(classes.select(F.col("name").alias("b"), "class"), "b").groupBy(F.col("a").alias("name")).agg(F.min("class").alias("near"))
        lower = classes.join(near, "name").select("name", F.col("class").alias("old"), F.least("class", "near").alias("to"))
        moved = kept(lower.join(classes.select(F.col("name").alias("to"), F.col("class").alias("up")), "to").select("name", "old", F.least("to", "up").alias("class")), "name-classes")
        done = moved.where("old <> class").isEmpty()
        drop(classes)
        classes = moved.select("name", "class")
        if done:
            return classes


def tag_by_any_name(sequences: DataFrame, members: DataFrame, aliases: DataFrame) -> DataFrame:
    """(header, seq, tag): sequences (header, seq) with the family ids, sorted and joined by bars, of all names in the header;
    the tag is null where no name is a member's.

    members (family_id, accession); aliases (a, b) are pairs of names of one protein, such as an old and a new accession.
    Names count with and without their version. Rows that repeat a header and sequence are kept.
    """
    bare = lambda c: F.regexp_replace(c, r"\.\d+$", "")
    pairs = aliases.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("a"), bare("a").alias("b")), F.struct(F.col("b").alias("a"), bare("b").alias("b")))).alias("p")).select("p.a", "p.b").where("a <> b")
    classes = kept(name_classes(pairs), "alias-classes")

    def resolved(rows: DataFrame) -> DataFrame:
        return rows.join(classes, "name", "left").withColumn("name", F.coalesce("class", "name")).drop("class")

    versions = members.where("accession IS NOT NULL").select("family_id", F.explode(F.array_distinct(F.array(F.col("accession"), bare("accession")))).alias("name"))
    families = resolved(versions).distinct()
    rows = kept(sequences.select("header", "seq", F.monotonically_increasing_id().alias("_row")), "tag-rows")
    named = resolved(rows.select("_row", F.explode(header_ids(F.col("header"))).alias("name")))
    tags = named.join(families, "name").groupBy("_row").agg(F.array_join(F.sort_array(F.collect_set("family_id")), "|").alias("tag"))
    return rows.join(tags, "_row", "left").select("header", "seq", "tag")


def tagging_share(tagged: DataFrame) -> DataFrame:
    """(n, n_tagged, unmapped): how many sequences there are and have a tag, and the share of the others, to four places."""
    counts = tagged.agg(F.count("*").alias("n"), F.count("tag").alias("n_tagged"))
    return counts.withColumn("unmapped", F.round(F.when(F.col("n") > 0, 1 - F.col("n_tagged") / F.col("n")), 4))
