"""Functional annotation: search hits joined to lookup tables.

Hits have (gene, accession, header, identity, aln_len, evalue, start, end); families have (family_id, category, description).
Lookups are exact joins on whole keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# What the category codes of family annotations mean, in their order; where a taxon is shown; the names
# of a domain's fields in a line of evidence.
CATEGORIES = {
    "Xr": "Virus replication",
    "Xs": "Virus structure",
    "Xh": "Virus protein w/benefit for host",
    "Xp": "Virus protein w/benefit for virus",
    "Xu": "Function unknown",
}
TAXON_LINK = "https://www.ncbi.nlm.nih.gov/Taxonomy/Browser/wwwtax.cgi?id="
DOMAIN_FIELDS = {
    "number": "domainNo",
    "score": "score",
    "c_evalue": "c-E",
    "i_evalue": "i-E",
    "hmm_from": "hmmFrom",
    "hmm_to": "hmmTo",
    "ali_from": "alignFrom",
    "ali_to": "alignTo",
    "env_from": "envFrom",
    "env_to": "envTo",
    "acc": "acc",
}


def family_ids(header: Column, pattern: str = r"(VOG\d+)") -> Column:
    """All family ids of a header, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(header, F.lit(pattern), F.lit(1)))


def dedupe_list(values: Column) -> Column:
    return F.array_distinct(values)


def annotate_blast(hits: DataFrame, identity: float, source: str = "blast") -> DataFrame:
    """One annotation a hit of enough identity: (gene, source, method, name, start, end, evidence, vog_ids)."""
    evidence = F.concat_ws("; ", F.concat(F.lit("identity="), F.format_string("%.2f", F.col("identity").cast("double"))), F.concat(F.lit("alignlen="), "aln_len"), F.concat(F.lit("evalue="), "evalue"))
    return hits.where(F.col("identity") >= identity).select("gene", F.lit(source).alias("source"), F.lit("blast").alias("method"), F.col("header").alias("name"), "start", "end", evidence.alias("evidence"), F.array_join(family_ids(F.col("header")), ",").alias("vog_ids"))


def attach_domains(hits: DataFrame, domains: DataFrame) -> DataFrame:
    """Hits (gene, target, ...) with `domains`: an ordered array of the structs of DOMAIN_FIELDS of their target."""
    nested = domains.groupBy("gene", "target").agg(F.sort_array(F.collect_list(F.struct(*DOMAIN_FIELDS))).alias("domains"))
    return hits.join(nested, ["gene", "target"], "left").withColumn("domains", F.coalesce("domains", F.array().cast(nested.schema["domains"].dataType)))


def annotate_hmm(hits: DataFrame, domains: DataFrame, method: str = "hmmscan", kind: str = "hmm search", category: str = "sequence") -> DataFrame:
    """One annotation a hit (gene, target, description): (gene, method, type, category, name, description, start, end,
    vog_ids, n_domains, evidence). Start and end are always `1` and `N`; evidence has a packed line a domain."""
    line = lambda d: F.concat(*[x for field, name in DOMAIN_FIELDS.items() for x in (F.lit(f"{name}:"), d[field].cast("string"), F.lit("|"))])
    joined = attach_domains(hits, domains)
    return joined.select("gene", F.lit(method).alias("method"), F.lit(kind).alias("type"), F.lit(category).alias("category"), F.col("target").alias("name"), "description", F.lit("1").alias("start"), F.lit("N").alias("end"),
                         F.array_join(family_ids(F.col("target")), ",").alias("vog_ids"), F.size("domains").alias("n_domains"), F.array_join(F.transform("domains", line), "; ").alias("evidence"))


def annotate_profile(hits: DataFrame, domains: DataFrame, families: DataFrame) -> DataFrame:
    """As annotate_hmm, for a profile search; a hit without a description takes that of its family."""
    described = families.select(F.col("family_id").alias("name"), F.col("description").alias("family_text"))
    found = annotate_hmm(hits, domains, kind="profile search", category="hmm").join(described, "name", "left")
    return found.withColumn("description", F.coalesce(F.nullif("description", F.lit("")), "family_text")).drop("family_text")


def extract_family_ids(hits: DataFrame) -> DataFrame:
    """(gene, family_id): the distinct families of each gene."""
    return hits.select("gene", F.explode(family_ids(F.col("header"))).alias("family_id")).distinct()


def family_groups(hits: DataFrame, members: DataFrame, genes: DataFrame, sequences: DataFrame) -> DataFrame:
    """(gene, gene_no, family_id, group_no, place, header, seq): for each family of a gene the gene itself (place 0), then
    all the family's sequences (place 1); group_no counts a gene's families, gene_no is the gene's number.

    genes (gene, gene_no, header, seq); sequences (accession, header, seq).
    """
    numbered = extract_family_ids(hits).withColumn("group_no", F.dense_rank().over(W.partitionBy("gene").orderBy("family_id")))
    headed = numbered.join(genes.select("gene", "gene_no"), "gene")
    own = numbered.join(genes, "gene").select("gene", "gene_no", "family_id", "group_no", F.lit(0).alias("place"), "header", "seq")
    rest = headed.join(members, "family_id").join(sequences, "accession").select("gene", "gene_no", "family_id", "group_no", F.lit(1).alias("place"), "header", "seq")
    return own.unionByName(rest)


def dbxref_lookup(hits: DataFrame, lookups: DataFrame) -> DataFrame:
    """(accession, n_refs, refs): all kinds of references of an accession; lookups (kind, key, value)."""
    wanted = hits.select(F.substring_index("accession", " ", 1).alias("key")).distinct()
    found = wanted.join(lookups, "key")
    return found.groupBy(F.col("key").alias("accession")).agg(F.count("*").alias("n_refs"), F.array_join(F.sort_array(F.collect_set(F.concat_ws("=", "kind", "value"))), " | ").alias("refs"))


def taxonomy_lookup(hits: DataFrame, taxa: DataFrame, strip_version: bool = True) -> DataFrame:
    """(header, taxonomy, link): the accession in the fourth field of the header -> its taxon, the least one of several,
    and where that is shown."""
    key = F.split_part("header", F.lit("|"), F.lit(4))
    key = F.substring_index(F.substring_index(key, " ", 1), ".", 1) if strip_version else F.substring_index(key, " ", 1)
    one = taxa.groupBy(F.col("accession").alias("key")).agg(F.min("taxid").alias("taxid"))
    return hits.select("header").distinct().withColumn("key", key).join(one, "key").select("header", F.concat(F.lit("NCBItaxID="), "taxid").alias("taxonomy"), F.concat(F.lit(TAXON_LINK), "taxid").alias("link"))


def header_info_lookup(hits: DataFrame, headers: DataFrame) -> DataFrame:
    """(accession, info): the texts in square brackets of the header whose first word is the accession."""
    info = F.array_join(F.regexp_extract_all("header", F.lit(r"\[([^\]]*)\]"), F.lit(1)), " | ")
    known = headers.select(F.substring_index("header", " ", 1).alias("accession"), info.alias("info"))
    return hits.select("accession").distinct().join(known, "accession")


def header_description(hits: DataFrame) -> DataFrame:
    """(gene, family_id, description): for headers that carry the description behind their ids and accession."""
    text = F.regexp_extract("header", r"^\S+\s+(.*)$", 1)
    return hits.select("gene", F.explode(family_ids(F.col("header"))).alias("family_id"), text.alias("description")).distinct()


def family_description(hits: DataFrame, families: DataFrame) -> DataFrame:
    """(gene, family_id, description)."""
    return extract_family_ids(hits).join(families.select("family_id", "description"), "family_id")


def family_category(families: DataFrame, line: str = "line") -> DataFrame:
    """(family_id, label): the meanings of the codes found anywhere in the line, each with a colon behind it, before the
    family's description; a family without either is `unknown`."""
    found = F.concat(*[F.when(F.col(line).contains(code), F.lit(f"{text}:")).otherwise("") for code, text in CATEGORIES.items()])
    return families.select("family_id", F.coalesce(F.nullif(F.concat(found, F.coalesce("description", F.lit(""))), F.lit("")), F.lit("unknown")).alias("label"))


def enzyme_codes(headers: DataFrame, activities: DataFrame) -> DataFrame:
    """(header, position, code, activity): the codes between bars in a header that are known."""
    codes = headers.select("header", F.posexplode(F.split("header", r"\|")).alias("position", "code"))
    one = activities.groupBy("code").agg(F.min("activity").alias("activity"))
    return codes.join(one, "code").select("header", "position", "code", "activity")


def describe_annotations(*texts: DataFrame) -> DataFrame:
    """(gene, description): the texts (gene, rank, text) of all lookups, in order of rank and text, joined by ` | `."""
    rows = texts[0]
    for more in texts[1:]:
        rows = rows.unionByName(more)
    ordered = F.sort_array(F.collect_set(F.struct("rank", "text")))
    return rows.groupBy("gene").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " | ").alias("description"))


def annotation_gff_attr(rows: DataFrame) -> DataFrame:
    """(…, attr): the text of an annotation (type, method, name, description, start, end, strand) in a GFF attribute."""
    # The texts of the attribute by type.
    described, named = F.translate("description", ";", "|"), F.translate("name", ";", "")
    kind = F.lower("type")
    head = lambda word: F.concat(F.lit(f"({word} - "), "method", F.lit(") "))
    attr = (F.when(kind == "gene", F.concat(F.lit("(gene) "), F.concat_ws("/", "start", "end", "strand"), F.lit(" "), "method"))
            .when(kind == "functional", F.concat(head("function"), described)).when(kind == "homology", F.concat(head("homology"), named, F.lit(" "), described))
            .when(kind == "hmm search", F.concat(head("hmm search"), F.col("name"), F.lit(" "), described)).when(kind == "profile search", F.concat(head("profile search"), F.col("name"), F.lit(" "), described))
            .when(kind == "cds", F.concat(head("cds"), described)).when(kind == "mrna", F.concat(head("mrna"), described)).when(kind == "trna", described)
            .when(kind == "polypeptide", F.concat(head("polypeptide"), described)).otherwise(F.concat(head("unk type"), F.col("description"))))
    return rows.withColumn("attr", attr)


def parse_gff_annotation(rows: DataFrame) -> DataFrame:
    """(id, position, key, value): the attributes of a GFF row, cut at `;` and the first `=`."""
    parts = rows.select("id", F.posexplode(F.split("attributes", r";\s*")).alias("position", "part")).where("part <> ''")
    return parts.select("id", "position", F.substring_index("part", "=", 1).alias("key"), F.regexp_extract("part", "^[^=]*=(.*)$", 1).alias("value"))


def count_annotations(rows: DataFrame) -> DataFrame:
    """(genome, mol_type, n): annotations by genome and molecule, with totals where a key is null."""
    return rows.rollup("genome", "mol_type").agg(F.count("*").alias("n"))
