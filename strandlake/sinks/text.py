"""Writers: tables as the text files of the domain. `*_lines` give the lines, `write_lines` writes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.session import drop, freed, kept


def write_lines(rows: DataFrame, path: str, *partition_by: str, line_sep: str = "\n", per_file: int = 0, compression: str = "none") -> str:
    """Write the one string column of `rows`, in folders by the partition columns, at most `per_file` rows a file unless
    that is 0; returns the path. Compressed files aren't cut into splits when read."""
    writer = rows.write.option("lineSep", line_sep).option("maxRecordsPerFile", per_file).option("compression", compression)
    with freed(rows.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).text(path)
    return path


def tabbed(*columns: Column | str) -> Column:
    """Columns joined by tabs, null as empty."""
    return F.concat_ws("\t", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns])


def cgc_lines(calls: DataFrame) -> DataFrame:
    """Calls (contig, strand, left_end, right_end, callers) numbered within the contig, as lines of the CGC table."""
    no = F.row_number().over(W.partitionBy("contig").orderBy("left_end", "right_end", "strand"))
    return calls.withColumn("no", no).select(tabbed("no", "strand", "left_end", "right_end", F.col("right_end") - F.col("left_end") + 1, "contig", "callers").alias("value"))


def calls_gff_lines(calls: DataFrame, source: str = "consensus") -> DataFrame:
    """GFF lines; calls on `-` begin at their right end."""
    minus = F.col("strand") == "-"
    start, end = F.when(minus, F.col("right_end")).otherwise(F.col("left_end")), F.when(minus, F.col("left_end")).otherwise(F.col("right_end"))
    return calls.select(tabbed("contig", F.lit(source), F.lit("CDS"), start, end, F.lit("."), "strand", F.lit("."), F.concat(F.lit("callers="), "callers")).alias("value"))


def flat_calls_lines(calls: DataFrame) -> DataFrame:
    """ID, START, STOP, STRAND, SCORE, METHOD, CONTIG of every caller's calls."""
    no = F.row_number().over(W.partitionBy("contig", "caller").orderBy("left_end", "right_end", "strand"))
    return calls.withColumn("no", no).select(tabbed("no", "left_end", "right_end", "strand", F.lit("."), "caller", "contig").alias("value"))


def caller_count_lines(calls: DataFrame) -> DataFrame:
    """A line a caller: its name and its number of calls."""
    return calls.groupBy("caller").agg(F.count("*").alias("n")).select(tabbed("caller", "n").alias("value"))


def annotation_gff_lines(genes: DataFrame, annotations: DataFrame, trnas: DataFrame) -> DataFrame:
    """A gene row and a CDS row for each gene of (contig, gene, start, end, strand), then a row for each of trnas (contig,
    label, start, end, strand, score); annotations (gene, rank, text) become annot1, annot2, … of the CDS; a contig's rows
    stand together, its genes by place."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("rank", "text"))), lambda x, i: F.concat(F.lit("annot"), (i + 1).cast("string"), F.lit("="), x["text"]))
    notes = annotations.groupBy("gene").agg(F.array_join(ordered, "; ").alias("notes"))
    both = genes.join(notes, "gene", "left").withColumn("feature", F.explode(F.array(F.lit("gene"), F.lit("CDS"))))
    attr = F.concat_ws("; ", F.concat(F.lit("ID="), "gene", F.lit("_"), F.lower("feature")), F.when(F.col("feature") == "CDS", F.col("notes")))
    rows = both.select("contig", F.lit(0).alias("late"), "start", "gene", "feature", "end", F.lit(".").alias("score"), "strand", attr.alias("attr"))
    rows = rows.unionByName(trnas.select("contig", F.lit(1).alias("late"), "start", F.col("label").alias("gene"), F.lit("trna").alias("feature"), "end", F.col("score").cast("string").alias("score"), "strand", F.concat(F.lit("ID="), "label").alias("attr")))
    lines = rows.repartition("contig").sortWithinPartitions("contig", "late", "start", "gene", F.desc("feature"))
    return lines.select(tabbed("contig", F.lit("strandlake"), "feature", "start", "end", "score", "strand", F.lit("."), "attr").alias("value"))


def genome_header_lines(genomes: DataFrame, genes: DataFrame, annotations: DataFrame) -> DataFrame:
    """Two lines a genome of (genome, name, kind): what it is, and its numbers of contigs, genes, proteins and annotations.

    genes (genome, contig, gene), each with a protein; annotations (gene, ...).
    """
    noted = genes.join(annotations.select("gene"), "gene").groupBy("genome").agg(F.count("*").alias("n_annotations"))
    counts = genes.groupBy("genome").agg(F.countDistinct("contig").alias("n_contigs"), F.count("*").alias("n_genes")).join(noted, "genome", "left")
    rows = genomes.join(counts, "genome", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    first = F.concat(F.lit("Genome:"), "genome", F.lit("\tName:"), "name", F.lit("\tType:"), "kind")
    second = F.concat(F.lit("Contigs:"), n("n_contigs"), F.lit("\tGenes:"), n("n_genes"), F.lit("\tProteins:"), n("n_genes"), F.lit("\tAnnotations:"), n("n_annotations"))
    return rows.select(F.concat(first, F.lit("\n"), second).alias("value"))


def annotation_tsv_lines(genes: DataFrame, annotations: DataFrame) -> DataFrame:
    """A line a gene: contig, gene, ends, strand, number of annotations, texts joined by ` | `."""
    notes = annotations.groupBy("gene").agg(F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]), " | ").alias("texts"))
    return genes.join(notes, "gene", "left").select(tabbed("contig", "gene", "start", "end", "strand", F.coalesce("n", F.lit(0)), "texts").alias("value"))


def fasta_lines(rows: DataFrame, header: Column, upper: bool = False) -> DataFrame:
    """A record a row: `>header`, line feed, sequence; rows without header or sequence are skipped."""
    seq = F.upper("seq") if upper else F.col("seq")
    return rows.select(header.alias("h"), seq.alias("s")).where("h <> '' AND s <> ''").select(F.concat(F.lit(">"), "h", F.lit("\n"), "s").alias("value"))


def sorted_files(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """(key, value) of rows (key, value, *order), each key's rows in order in one task: the lines of its file. Keys of many
    rows are for write_packed."""
    return rows.repartition(key).sortWithinPartitions(key, *order).select(key, "value")


def ranged_files(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """sorted_files for keys of many rows: a key's rows are dealt to many tasks as ranges of its order. Written in folders by key, the
    files of a folder stand in the order of their names, which begin with the task's number and end with the file's."""
    return rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).select(key, "value")


PROFILE_ORDER, PARALOG_ORDER = ("section", "ord"), ("place", "value")


def profile_rows(profile: DataFrame, *mol_types: str) -> DataFrame:
    """(pair, value, section, ord): the lines of the report of profiles, to be written by pair. With several molecule types, `profile`
    has them in mol_type; their sections stand in the order given."""
    role = lambda i: F.when(F.col(f"gene{i}").isNull(), F.lit(None)).when(F.col("row_type").startswith(f"genome{i}"), "query").otherwise("subject")
    g = lambda i: [f"g{i}_{c}" for c in ("header", "contig", "annotation", "start", "end", "strand")]
    line = tabbed("ord", "row_type", "q_start", "q_end", "s_start", "s_end", "identity", F.lit(None), role(1), *g(1), role(2), *g(2), "g1_coverage", "g2_coverage", "aln_len", "gap_opens", "g1_span", "g1_length", "g2_span", "g2_length")
    typed = profile if len(mol_types) > 1 else profile.withColumn("mol_type", F.lit(mol_types[0]))
    rows = typed.select(F.concat_ws("-", "genome1", "genome2").alias("pair"), F.array_position(F.array(*map(F.lit, mol_types)), F.col("mol_type")).alias("section"), F.col("ord").cast("long").alias("ord"), "mol_type", line.alias("value"))
    heads = rows.select("pair", "section", F.lit(-1).cast("long").alias("ord"), F.concat(F.lit("#"), F.upper("mol_type"), F.lit(" HITS")).alias("value")).distinct()
    return rows.drop("mol_type").unionByName(heads)


def profile_lines(profile: DataFrame, *mol_types: str) -> DataFrame:
    """(pair, value) of profile_rows, some files a pair (ranged_files)."""
    return ranged_files(profile_rows(profile, *mol_types), "pair", *PROFILE_ORDER)


def paralog_rows(paralogs: DataFrame, mol_type: str = "Gene") -> DataFrame:
    """(genome, value, place): the lines of the paralog listing, to be written by genome; paralogs (genome, gene, paralog, identity,
    coverage)."""
    stanza = F.concat(F.concat_ws("\t", F.concat(F.lit("query:"), "gene"), F.concat(F.lit("subject:"), "paralog"), F.lit(f"{mol_type.lower()}_paralog"), F.col("identity").cast("string")), F.lit("\ncoverage:"), F.col("coverage").cast("string"))
    heads = paralogs.select("genome").distinct().select("genome", F.lit(0).alias("place"), F.concat(F.lit("PARALOGS for genome /data/"), "genome", F.lit(f".fasta\n{mol_type} Paralogs")).alias("value"))
    return paralogs.select("genome", F.lit(1).alias("place"), stanza.alias("value")).unionByName(heads)


def paralog_lines(paralogs: DataFrame, mol_type: str = "Gene") -> DataFrame:
    """(genome, value) of paralog_rows, a file a genome."""
    return sorted_files(paralog_rows(paralogs, mol_type), "genome", *PARALOG_ORDER)


def group_annotation_lines(groups: DataFrame) -> DataFrame:
    """(group_no, value): a line for each member (member, annotation) of each group."""
    return groups.select("group_no", tabbed("member", "annotation").alias("value"))


def group_fasta_lines(groups: DataFrame) -> DataFrame:
    """(group_no, value): FASTA records of the members (member, seq) of each group."""
    return groups.select("group_no", F.concat(F.lit(">"), "member", F.lit("\n"), "seq").alias("value"))


def write_packed(rows: DataFrame, path: str, keys: list[str], order: list[str], file_bytes: int = 64 << 20) -> DataFrame:
    """Write the texts of many keys to few files and return their index (*keys, part, file, start, length, n_lines).

    rows (*keys, value, *order): a key's lines stand together, in the order given. Files are ranges of keys and order of
    about `file_bytes` each, so their number follows the bytes and not the keys, and a key of many lines goes on in the
    next file: its parts are numbered from 1. `start` and `length` count bytes, with the line feeds. The index is written
    beside the files, in `path`/index.
    """
    n_lines = F.length("value") - F.length(F.replace("value", F.lit("\n"), F.lit(""))) + 1
    table = kept(rows.withColumn("_bytes", F.octet_length("value").cast("long") + 1).withColumn("_lines", n_lines.cast("long")), "packed-rows")
    total = table.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    ranges = table.repartitionByRange(max(1, -(-total // file_bytes)), *keys, *order).sortWithinPartitions(*keys, *order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = kept(ranges.withColumn("file", F.spark_partition_id()).withColumn("_at", at), "packed-ranges")
    drop(table)
    with freed(rows.sparkSession):
        placed.select("file", "_at", "value").repartition("file").sortWithinPartitions("file", "_at").select("file", "value").write.partitionBy("file").text(f"{path}/text")
    spans = placed.withColumn("_end", F.sum("_bytes").over(W.partitionBy("file").orderBy("_at")))
    index = spans.groupBy(*keys, "file").agg(F.min(F.col("_end") - F.col("_bytes")).alias("start"), F.sum("_bytes").alias("length"), F.sum("_lines").alias("n_lines"))
    index = index.withColumn("part", F.row_number().over(W.partitionBy(*keys).orderBy("file")))
    with freed(rows.sparkSession):
        index.select(*keys, "part", "file", "start", "length", "n_lines").write.parquet(f"{path}/index")
    drop(placed)
    return rows.sparkSession.read.parquet(f"{path}/index")


def packed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(*keys, part, at, line) of what write_packed has written: the lines of the files with the keys that the index has for them;
    `at` counts the lines of a file. A file is one row while it is cut, and each of its bytes is looked at once, however
    many keys it holds."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/text")
    files = files.select(F.regexp_extract("path", r"/file=(\d+)/", 1).cast("int").alias("file"), F.split(F.col("content").cast("string"), "\n").alias("lines"))
    index = spark.read.parquet(f"{path}/index")
    names = [c for c in index.columns if c not in ("file", "start", "length", "n_lines")]
    spans = index.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("start", "n_lines", F.struct(*names).alias("of")))).alias("spans"))
    owners = F.flatten(F.transform("spans", lambda x: F.array_repeat(x["of"], x["n_lines"].cast("int"))))
    whole = files.join(spans, "file").select(F.posexplode(F.arrays_zip(owners.alias("of"), F.slice("lines", F.lit(1), F.size("lines") - 1).alias("line"))).alias("at", "x"))
    return whole.select("x.of.*", "at", "x.line")


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """(*keys, part, text) of what write_packed has written."""
    rows = packed_lines(spark, path)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("at", "line"))), lambda x: x["line"])
    return rows.groupBy(*[c for c in rows.columns if c not in ("at", "line")]).agg(F.concat(F.array_join(ordered, "\n"), F.lit("\n")).alias("text"))


def text_digests(rows: DataFrame, key: str) -> DataFrame:
    """(key, n_lines, digest) of rows (key, part, at, line): the number of a key's lines and the SHA-256 of all of them, each
    with its line feed. The digest needs a key's bytes one after the other, so one task takes them, but as a stream: they are
    sorted on disk and pass in batches, so that a key's text may be larger than memory."""
    def stream(batches):
        import hashlib
        from itertools import groupby

        import pyarrow as pa

        now, digest, n = None, None, 0
        for batch in batches:
            done = []
            for k, lines in groupby(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), key=lambda x: x[0]):
                if digest is None or k != now:
                    if digest is not None:
                        done.append((now, n, digest.hexdigest()))
                    now, digest, n = k, hashlib.sha256(), 0
                texts = [line for _, line in lines]
                n += len(texts)
                digest.update(("\n".join(texts) + "\n").encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.string()))], ["key", "n_lines", "digest"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.string()), pa.array([n], pa.int64()), pa.array([digest.hexdigest()], pa.string())], ["key", "n_lines", "digest"])

    dealt = rows.withColumn("key", F.col(key).cast("string")).repartition("key").sortWithinPartitions("key", "part", "at")
    return dealt.select("key", "line").mapInArrow(stream, "key string, n_lines long, digest string")


def packed_digests(spark: SparkSession, path: str, piece: int = 1 << 16) -> DataFrame:
    """(key, n_lines, digest) of what write_packed has written by one key: the number of a key's lines and the SHA-256 of its
    whole text. Files are in order, so that only pieces of at most `piece` bytes are dealt by key and sorted, not lines; one
    task takes a key's pieces as a stream."""
    def stream(batches):
        import hashlib

        import pyarrow as pa

        def put(found):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.string()))], ["key", "n_lines", "digest"])

        now, digest, n = None, None, 0
        for batch in batches:
            done = []
            for key, n_lines, content in zip(*(batch.column(i) for i in range(3)), strict=True):
                key = key.as_py()
                if digest is None or key != now:
                    if digest is not None:
                        done.append((now, n, digest.hexdigest()))
                    now, digest, n = key, hashlib.sha256(), 0
                n += n_lines.as_py()
                digest.update(content.as_buffer())
            if done:
                yield put(done)
        if digest is not None:
            yield put([(now, n, digest.hexdigest())])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/text")
    files = files.select(F.regexp_extract("path", r"/file=(\d+)/", 1).cast("int").alias("file"), "content")
    index = spark.read.parquet(f"{path}/index")
    key = next(c for c in index.columns if c not in ("part", "file", "start", "length", "n_lines"))
    spans = index.groupBy("file").agg(F.collect_list(F.struct(F.col(key).cast("string").alias("key"), "part", "n_lines", F.col("start").cast("int").alias("start"), F.col("length").cast("int").alias("length"))).alias("spans"))

    def cut(x, content):
        return F.transform(F.sequence(F.lit(0), x["length"] - 1, F.lit(piece)), lambda i: F.struct(
            x["key"].alias("key"), x["part"].alias("part"), i.alias("at"), F.when(i == 0, x["n_lines"]).otherwise(0).alias("n_lines"), F.substring(content, x["start"] + i + 1, F.least(x["length"] - i, F.lit(piece))).alias("content")))

    # the content as a variable of its own: as a column it would be copied whole for each piece
    all_of = F.transform(F.array("content"), lambda content: F.flatten(F.transform("spans", lambda x: cut(x, content))))
    pieces = files.join(spans, "file").select(F.explode(F.flatten(all_of)).alias("p")).select("p.*")
    return pieces.repartition("key").sortWithinPartitions("key", "part", "at").select("key", "n_lines", "content").mapInArrow(stream, "key string, n_lines long, digest string")


def write_reports(path: str, **tables: DataFrame) -> dict[str, str]:
    """Write each table as Parquet below the path; returns where each lies."""
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")
    return {name: f"{path}/{name}" for name in tables}
