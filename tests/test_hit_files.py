"""Disk that text files of hits and profiles take on the way."""

import glob
import os

from strandlake import fixtures as X
from strandlake import session as S
from strandlake.plans.files import QUERIES as FILES
from strandlake.sinks import text as P
from strandlake.sources import text as T

SF = "/root/testdata/sf0.001"


def shared(spark):
    return {f for f in glob.glob(f"{S.scratch(spark).removeprefix('file:')}/**", recursive=True)}


def sorted_rows(df):
    return sorted(map(str, df.collect()))


def test_pairs_turned_at_the_end_are_the_hits(spark):
    """Lines of several orders with the same genes, of no supplier, part or order, and of one gene in two genomes."""
    rows = [(o, n, (o * 7 + n * 3) % 9, (o + n) % 5, n / 100, o * 10.5 + n) for o in range(1, 9) for n in range(1, 6)] + [(1, 9, None, 2, 0.1, 5.0), (1, 10, None, 2, 0.2, 5.0), (1, 11, 3, None, 0.1, 5.0), (None, 1, 1, 1, 0.1, 5.0), (2, 9, -3, 4, 0.1, 7.0)]
    folder = S.fresh(spark, "lines")
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_discount double, l_extendedprice double").write.parquet(f"{folder}/lineitem.parquet")
    for d in (folder, SF):
        got, want = X.both_ways(spark, d), X.hits(spark, d)
        assert got.schema.simpleString() == want.schema.simpleString() and sorted_rows(got) == sorted_rows(want) and got.count() > 50


def test_blast_tables_are_compressed(spark):
    """Before, the text of all hits was written plain, and both directions of a hit were shuffled."""
    for name in ("ingest_blast_tab", "ingest_blast_list"):
        before = shared(spark)
        found = FILES[name](spark, SF)
        files = [f for f in shared(spark) - before if "/blast-" in f and "/part-" in f]
        assert files and all(f.endswith(".snappy") for f in files) and found.count() > 0


def test_heads_that_are_few_are_looked_up(spark):
    """Before, all lines of a report were shuffled for their heads. Files of one folder are one text; lines above the first head have none."""
    folder = S.fresh(spark, "sections")
    texts = {"a": ["1 above", "#GENE HITS x", *(f"1 {i}" for i in range(40))], "b": ["2 in a's section", "#PROTEIN HITS", "2 x", "#", "2 none"], "c": []}
    for pair in ("p", "q"):
        for name, lines in texts.items():
            spark.createDataFrame([(x,) for x in lines if pair == "p" or not x.startswith("#GENE")], "value string").coalesce(1).write.text(f"{folder}/pair={pair}{name}")
    for joined in (False, True):
        few, many = (T.sections(spark, f"{folder}/*", "#", joined, few=n) for n in (16, 0))
        assert sorted_rows(few.drop("at")) == sorted_rows(many.drop("at")) and few.schema == many.schema and few.where("head IS NULL").count() > 0
        assert "Window" in many._jdf.queryExecution().optimizedPlan().toString() and "Window" not in few._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in T.sections(spark, f"{folder}/*", "#", few=1)._jdf.queryExecution().optimizedPlan().toString()  # two heads in a file


def test_packing_leaves_nothing_behind(spark):
    """Before, the rows and their ranges stayed beside the packed files, and what was shuffled stayed until garbage was collected."""
    local = spark.sparkContext.getConf().get("spark.local.dir")
    shuffled = lambda: {f for f in glob.glob(f"{local}/blockmgr-*/*/shuffle_*")}
    rows = spark.range(5_000).selectExpr("id % 3 AS key", "id AS o", "concat('line ', id) AS value").repartition(3)
    before, seen = shared(spark), shuffled()
    index = P.write_packed(rows, S.fresh(spark, "packed"), ["key"], ["o"], 20_000)
    assert not [f for f in shared(spark) - before if "packed-rows" in f or "packed-ranges" in f] and index.count() > 3
    left = sum(os.path.getsize(f) for f in shuffled() - seen if f.endswith(".data"))  # of sums, which aren't written
    assert left < 2_000 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
