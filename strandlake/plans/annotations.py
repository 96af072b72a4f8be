"""Queries over annotations and reference data."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake import fixtures as X
from strandlake.operators import annotate as A
from strandlake.operators import headers as N
from strandlake.operators import prep as R


def _hits(s, d):
    return X.annotation_hits(s, d)


def _targets(s, d):
    """HMM hits: the first family of each hit's header; their domains are the hits themselves. A third has no description."""
    return _hits(s, d).selectExpr("gene", "substring_index(header, '|', 1) AS target").distinct().withColumn("description", F.expr("CASE WHEN gene % 3 = 0 THEN '' ELSE concat('domain of ', gene) END"))


def _domains(s, d):
    return _hits(s, d).selectExpr("gene", "substring_index(header, '|', 1) AS target", "identity AS score", "concat('1e-', start) AS c_evalue", "concat('1e-', `end`) AS i_evalue", "start AS hmm_from", "`end` AS hmm_to",
                                  "start + 1 AS ali_from", "`end` + 1 AS ali_to", "start AS env_from", "`end` + 2 AS env_to", "'0.9' AS acc", "aln_len AS number")


def _lookups(s, d):
    one = X.read(s, d, "supplier").selectExpr("'enzyme' AS kind", "concat('ACC', s_suppkey) AS key", "s_name AS value")
    return one.unionByName(X.read(s, d, "nation").selectExpr("'pfam' AS kind", "concat('ACC', n_nationkey) AS key", "n_name AS value")).unionByName(
        X.read(s, d, "supplier").selectExpr("'tax' AS kind", "concat('ACC', s_suppkey % 50) AS key", "s_name AS value"))


def _headers(s, d):
    return X.read(s, d, "part").selectExpr("concat('ACC', p_partkey, ' ', p_name, ' [', p_brand, '] size [', p_type, ']') AS header")


def _rows(s, d):
    kinds = "array('gene', 'functional', 'homology', 'hmm search', 'profile search', 'CDS', 'mrna', 'trna', 'polypeptide', 'other')"
    return X.read(s, d, "part").selectExpr("p_partkey AS id", f"element_at({kinds}, cast(p_partkey % 10 as int) + 1) AS type", "p_brand AS method", "concat(p_name, ';', p_size) AS name", "concat(p_type, '; ', p_name) AS description",
                                           "p_partkey * 90 + 1 AS start", "p_partkey * 90 + 90 AS `end`", "CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand")


ROWS = """r AS (SELECT p_partkey AS id, ['gene', 'functional', 'homology', 'hmm search', 'profile search', 'CDS', 'mrna', 'trna', 'polypeptide', 'other'][p_partkey % 10 + 1] AS type, p_brand AS method, p_name || ';' || p_size AS name,
 p_type || '; ' || p_name AS description, p_partkey * 90 + 1 AS start, p_partkey * 90 + 90 AS "end", CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part)"""


def _suppliers(s, d):
    """The genes of the hits, with sequences."""
    return X.read(s, d, "supplier").selectExpr("s_suppkey AS gene", "s_suppkey AS gene_no", "concat('>', s_name) AS header", "lower(s_name) AS seq")


def _described(s, d):
    families = A.family_description(_hits(s, d), X.families(s, d)).select("gene", F.lit(1).alias("rank"), F.col("description").alias("text"))
    refs = _hits(s, d).join(A.dbxref_lookup(_hits(s, d), _lookups(s, d)), "accession").select("gene", F.lit(2).alias("rank"), F.col("refs").alias("text"))
    return A.describe_annotations(families, refs)


def _raw(s, d):
    return X.read(s, d, "part").selectExpr("concat('>ACC', p_partkey, ' ', p_name) AS header", "p_type AS seq")


RAW = "raw AS (SELECT '>ACC' || p_partkey || ' ' || p_name AS header, p_type AS seq FROM part)"
PATTERNS = {"digits": r"ACC\d+ ", "ring": "ring", "small": "small"}


def _reported(s, d):
    return X.read(s, d, "part").selectExpr("concat('VOG', lpad(p_partkey, 9, '0')) AS family_id", "cast(p_size as bigint) AS n_reported")


def _counted(s, d):
    rows = X.read(s, d, "lineitem").selectExpr("concat('genome', l_suppkey % 4) AS genome", "element_at(array('gene', 'protein', 'trna'), cast(l_partkey % 3 as int) + 1) AS mol_type")
    return A.count_annotations(rows)


def _listed(s, d):
    return X.read(s, d, "part").selectExpr("concat('VOG', lpad(p_partkey div 3, 9, '0')) AS family_id", "concat('ACC', p_partkey div 2) AS accession", "p_partkey * 7919 % 1000003 AS line_no")


def _any_name(s, d):
    """Headers with an old, a new or a versioned name; new names of even numbers lead nowhere."""
    part = X.read(s, d, "part")
    raw = part.selectExpr("concat('>sp|', CASE p_partkey % 3 WHEN 0 THEN concat('ACC', p_partkey, '.', p_partkey % 4) WHEN 1 THEN concat('OLD', p_partkey) ELSE concat('NEW', p_partkey, '.1') END, '| ', p_name) AS header", "p_type AS seq")
    aliases = part.selectExpr("explode(array(struct(concat('OLD', p_partkey) AS a, concat('MID', p_partkey, '.3') AS b), struct(concat('MID', p_partkey) AS a, concat('ACC', p_partkey) AS b), struct(CASE WHEN p_partkey % 2 = 1 THEN concat('NEW', p_partkey) END AS a, concat('OLD', p_partkey + 1) AS b))) AS p").select("p.*")
    return N.tag_by_any_name(raw, X.family_members(s, d), aliases)


QUERIES = {
    "annotate_blast": lambda s, d: A.annotate_blast(_hits(s, d), 80),
    "annotate_hmm": lambda s, d: A.annotate_hmm(_targets(s, d), _domains(s, d)),
    "attach_domains": lambda s, d: A.attach_domains(_targets(s, d), _domains(s, d)).select("gene", "target", F.size("domains").alias("n_domains"), F.expr("aggregate(domains, 0L, (a, x) -> a + x.score)").alias("total_score"), F.expr("domains[0].number").alias("first_number")),
    "annotate_profile": lambda s, d: A.annotate_profile(_targets(s, d), _domains(s, d), X.families(s, d)),
    "extract_family_ids": lambda s, d: A.extract_family_ids(_hits(s, d)),
    "family_groups": lambda s, d: A.family_groups(_hits(s, d), X.family_members(s, d), _suppliers(s, d), _raw(s, d).select(R.accession_of(F.col("header")).alias("accession"), "header", "seq")),
    "dbxref_lookup": lambda s, d: A.dbxref_lookup(_hits(s, d), _lookups(s, d)),
    "taxonomy_lookup": lambda s, d: A.taxonomy_lookup(_hits(s, d), X.read(s, d, "supplier").selectExpr("concat('ACC', s_suppkey) AS accession", "s_nationkey AS taxid")),
    "header_info_lookup": lambda s, d: A.header_info_lookup(_hits(s, d), _headers(s, d)),
    "family_description": lambda s, d: A.family_description(_hits(s, d), X.families(s, d)),
    "family_description_header": lambda s, d: A.header_description(_hits(s, d)),
    "family_category": lambda s, d: A.family_category(X.families(s, d).withColumn("line", F.concat_ws(" ", F.when(F.col("category") != "Xu", F.col("category")), "description"))),
    "enzyme_codes": lambda s, d: A.enzyme_codes(_hits(s, d).select("header").distinct(), X.families(s, d).select(F.col("family_id").alias("code"), F.col("description").alias("activity"))),
    "describe_annotations": _described,
    "dedupe_list": lambda s, d: _hits(s, d).select("gene", "accession", "header", F.array_join(A.dedupe_list(F.split(F.substring_index("header", " ", 1), r"\|")), ",").alias("ids")),
    "annotation_gff_attr": lambda s, d: A.annotation_gff_attr(_rows(s, d)).select("id", "type", "attr"),
    "parse_gff_annotation": lambda s, d: A.parse_gff_annotation(_rows(s, d).selectExpr("id", "concat('ID=', id, '; name=', translate(name, ';', ','), ';type=', type, '=x; flag;') AS attributes")),
    "count_annotations": _counted,
    "tag_families": lambda s, d: R.tag_families(_raw(s, d), X.family_members(s, d)),
    "tag_families_from_tables": lambda s, d: R.tag_families_from_tables(_raw(s, d).where("seq <> 'ECONOMY'"), X.family_members(s, d)),
    "distinct_accessions": lambda s, d: R.distinct_accessions(X.family_members(s, d)),
    "accessions_in_order": lambda s, d: R.accessions_in_order(_listed(s, d), "line_no"),
    "tag_by_any_name": _any_name,
    "tagging_share": lambda s, d: N.tagging_share(_any_name(s, d)),
    "family_counts": lambda s, d: R.family_counts(X.family_members(s, d), _reported(s, d)),
    "check_tagging": lambda s, d: R.check_tagging(_raw(s, d), R.tag_families(_raw(s, d), X.family_members(s, d))),
    "header_pattern_profile": lambda s, d: R.header_pattern_profile(_raw(s, d), PATTERNS),
}

_LOOKUPS = """lookups AS (SELECT 'enzyme' AS kind, 'ACC' || s_suppkey AS key, s_name AS value FROM supplier UNION ALL SELECT 'pfam', 'ACC' || n_nationkey, n_name FROM nation UNION ALL SELECT 'tax', 'ACC' || (s_suppkey % 50), s_name FROM supplier),
refs AS (SELECT key AS accession, count(*) AS n_refs, string_agg(DISTINCT kind || '=' || value, ' | ' ORDER BY kind || '=' || value) AS refs FROM lookups WHERE key IN (SELECT accession FROM annotation_hits) GROUP BY key)"""
_IDS = "ids AS (SELECT DISTINCT gene, unnest(regexp_extract_all(header, 'VOG[0-9]+')) AS family_id FROM annotation_hits)"
_DOMAINS = "dom AS (SELECT gene, split_part(header, '|', 1) AS target, identity AS score, start AS f, \"end\" AS t, aln_len AS number, CASE WHEN gene % 3 = 0 THEN '' ELSE 'domain of ' || gene END AS descr FROM annotation_hits)"
_HMM = """SELECT gene, 'hmmscan' AS method, '{}' AS type, '{}' AS category, target AS name, {} AS description, '1' AS start, 'N' AS "end", target AS vog_ids, CAST(count(*) AS INTEGER) AS n_domains, string_agg('domainNo:' || number || '|score:' || score || '|c-E:1e-' || f || '|i-E:1e-' || t
 || '|hmmFrom:' || f || '|hmmTo:' || t || '|alignFrom:' || (f + 1) || '|alignTo:' || (t + 1) || '|envFrom:' || f || '|envTo:' || (t + 2) || '|acc:0.9|', '; ' ORDER BY number, score, '1e-' || f, '1e-' || t, f, t) AS evidence FROM dom {} GROUP BY gene, target"""
_TAGGED = "tagged AS (SELECT '>' || tag || '|' || ltrim(header, '>') AS header, seq FROM raw JOIN (SELECT accession, string_agg(DISTINCT family_id, '|' ORDER BY family_id) AS tag FROM family_members GROUP BY accession) ON accession = regexp_extract(header, '^>*([^ ]+)', 1))"
_ANY_NAME = """any_name AS (SELECT '>sp|' || CASE k % 3 WHEN 0 THEN 'ACC' || k || '.' || (k % 4) WHEN 1 THEN 'OLD' || k ELSE 'NEW' || k || '.1' END || '| ' || p_name AS header, seq, tag FROM (
  SELECT p.p_partkey AS k, p.p_name, p.p_type AS seq, CASE p.p_partkey % 3 WHEN 2 THEN CASE WHEN p.p_partkey % 2 = 1 THEN o.p_partkey END ELSE p.p_partkey END AS stands FROM part p LEFT JOIN part o ON o.p_partkey = p.p_partkey + 1)
  LEFT JOIN (SELECT accession, string_agg(DISTINCT family_id, '|' ORDER BY family_id) AS tag FROM family_members GROUP BY accession) ON accession = 'ACC' || stands)"""
_DEDUPE = "list_filter(s, lambda x, i: list_position(s, x) = i)"
SQL = {
    "annotate_blast": X.sql(X.ANNOTATION_HITS, select="SELECT gene, 'blast' AS source, 'blast' AS method, header AS name, start, \"end\", printf('identity=%.2f; alignlen=%d; evalue=%s', CAST(identity AS DOUBLE), aln_len, evalue) AS evidence, array_to_string(" + _DEDUPE + ", ',') AS vog_ids FROM (SELECT *, regexp_extract_all(header, 'VOG[0-9]+') AS s FROM annotation_hits WHERE identity >= 80)"),
    "annotate_hmm": X.sql(X.ANNOTATION_HITS, _DOMAINS, select=_HMM.format("hmm search", "sequence", "min(descr)", "")),
    "attach_domains": X.sql(X.ANNOTATION_HITS, _DOMAINS, select="SELECT gene, target, CAST(count(*) AS INTEGER) AS n_domains, CAST(sum(score) AS BIGINT) AS total_score, min(number) AS first_number FROM dom GROUP BY gene, target"),
    "annotate_profile": X.sql(X.ANNOTATION_HITS, X.FAMILIES, _DOMAINS, select=_HMM.format("profile search", "hmm", "coalesce(nullif(min(descr), ''), min(families.description))", "LEFT JOIN families ON family_id = target")),
    "extract_family_ids": X.sql(X.ANNOTATION_HITS, _IDS, select="SELECT * FROM ids"),
    "family_groups": X.sql(X.ANNOTATION_HITS, X.FAMILIES, RAW, _IDS, "gr AS (SELECT gene, s_suppkey AS gene_no, family_id, CAST(dense_rank() OVER (PARTITION BY gene ORDER BY family_id) AS INTEGER) AS group_no, s_name FROM ids JOIN supplier ON s_suppkey = gene)",
        select="SELECT gene, gene_no, family_id, group_no, 0 AS place, '>' || s_name AS header, lower(s_name) AS seq FROM gr UNION ALL SELECT gene, gene_no, family_id, group_no, 1, header, seq FROM gr JOIN family_members USING (family_id) JOIN raw ON accession = regexp_extract(header, '^>*([^ ]+)', 1)"),
    "dbxref_lookup": X.sql(X.ANNOTATION_HITS, _LOOKUPS, select="SELECT * FROM refs"),
    "taxonomy_lookup": X.sql(X.ANNOTATION_HITS, select="SELECT DISTINCT header, 'NCBItaxID=' || s_nationkey AS taxonomy, 'https://www.ncbi.nlm.nih.gov/Taxonomy/Browser/wwwtax.cgi?id=' || s_nationkey AS link FROM annotation_hits JOIN supplier ON 'ACC' || s_suppkey = split_part(split_part(header, '|', 4), ' ', 1)"),
    "header_info_lookup": X.sql(X.ANNOTATION_HITS, select="SELECT DISTINCT accession, p_brand || ' | ' || p_type AS info FROM annotation_hits JOIN part ON accession = 'ACC' || p_partkey"),
    "family_description": X.sql(X.ANNOTATION_HITS, X.FAMILIES, _IDS, select="SELECT gene, family_id, description FROM ids JOIN families USING (family_id)"),
    "family_description_header": X.sql(X.ANNOTATION_HITS, _IDS, select="SELECT DISTINCT gene, unnest(regexp_extract_all(header, 'VOG[0-9]+')) AS family_id, 'protein ' || split_part(header, ' protein ', 2) AS description FROM annotation_hits"),
    "family_category": X.sql(X.FAMILIES, select="SELECT family_id, CASE category WHEN 'Xr' THEN 'Virus replication:' WHEN 'Xs' THEN 'Virus structure:' WHEN 'Xh' THEN 'Virus protein w/benefit for host:' WHEN 'Xp' THEN 'Virus protein w/benefit for virus:' ELSE '' END || description AS label FROM families"),
    "enzyme_codes": X.sql(X.ANNOTATION_HITS, X.FAMILIES, select="SELECT header, CAST(i - 1 AS INTEGER) AS position, s[i] AS code, description AS activity FROM (SELECT header, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT DISTINCT header, string_split(header, '|') AS s FROM annotation_hits)) JOIN families ON family_id = s[i]"),
    "describe_annotations": X.sql(X.ANNOTATION_HITS, X.FAMILIES, _IDS, _LOOKUPS, select="SELECT gene, string_agg(t, ' | ' ORDER BY rank, t) AS description FROM (SELECT gene, 1 AS rank, description AS t FROM ids JOIN families USING (family_id) UNION SELECT gene, 2, refs FROM annotation_hits JOIN refs USING (accession)) GROUP BY gene"),
    "dedupe_list": X.sql(X.ANNOTATION_HITS, select=f"SELECT gene, accession, header, array_to_string({_DEDUPE}, ',') AS ids FROM (SELECT *, string_split(split_part(header, ' ', 1), '|') AS s FROM annotation_hits)"),
    "annotation_gff_attr": X.sql(ROWS, select="""SELECT id, type, CASE id % 10 WHEN 0 THEN '(gene) ' || start || '/' || "end" || '/' || strand || ' ' || method WHEN 1 THEN '(function - ' || method || ') ' || replace(description, ';', '|')
        WHEN 2 THEN '(homology - ' || method || ') ' || replace(name, ';', '') || ' ' || replace(description, ';', '|') WHEN 3 THEN '(hmm search - ' || method || ') ' || name || ' ' || replace(description, ';', '|')
        WHEN 4 THEN '(profile search - ' || method || ') ' || name || ' ' || replace(description, ';', '|') WHEN 5 THEN '(cds - ' || method || ') ' || replace(description, ';', '|') WHEN 6 THEN '(mrna - ' || method || ') ' || replace(description, ';', '|')
        WHEN 7 THEN replace(description, ';', '|') WHEN 8 THEN '(polypeptide - ' || method || ') ' || replace(description, ';', '|') ELSE '(unk type - ' || method || ') ' || description END AS attr FROM r"""),
    "parse_gff_annotation": X.sql(ROWS, select="""SELECT id, 0 AS position, 'ID' AS key, CAST(id AS VARCHAR) AS value FROM r UNION ALL SELECT id, 1, 'name', replace(name, ';', ',') FROM r UNION ALL SELECT id, 2, 'type', type || '=x' FROM r UNION ALL SELECT id, 3, 'flag', '' FROM r"""),
    "count_annotations": "SELECT genome, mol_type, count(*) AS n FROM (SELECT 'genome' || (l_suppkey % 4) AS genome, ['gene', 'protein', 'trna'][l_partkey % 3 + 1] AS mol_type FROM lineitem) GROUP BY ROLLUP (genome, mol_type)",
    "tag_families": X.sql(X.FAMILIES, RAW, _TAGGED, select="SELECT * FROM tagged"),
    "tag_families_from_tables": X.sql(X.FAMILIES, RAW, _TAGGED, select="SELECT 'tagged' AS kind, header, seq FROM tagged WHERE seq <> 'ECONOMY' UNION ALL SELECT DISTINCT 'missing', accession, NULL FROM family_members WHERE accession NOT IN (SELECT regexp_extract(header, '^>*([^ ]+)', 1) FROM raw WHERE seq <> 'ECONOMY')"),
    "accessions_in_order": "SELECT accession, first_family, row_number() OVER (ORDER BY first_at, accession) AS place FROM (SELECT 'ACC' || (p_partkey // 2) AS accession, arg_min('VOG' || lpad(CAST(p_partkey // 3 AS VARCHAR), 9, '0'), (p_partkey * 7919 % 1000003, 'VOG' || lpad(CAST(p_partkey // 3 AS VARCHAR), 9, '0'))) AS first_family, min(p_partkey * 7919 % 1000003) AS first_at FROM part GROUP BY 1)",
    "tag_by_any_name": X.sql(X.FAMILIES, _ANY_NAME, select="SELECT header, seq, tag FROM any_name"),
    "tagging_share": X.sql(X.FAMILIES, _ANY_NAME, select="SELECT count(*) AS n, count(tag) AS n_tagged, round(1 - count(tag) / count(*), 4) AS unmapped FROM any_name"),
    "distinct_accessions": X.sql(X.FAMILIES, select="SELECT accession, min(family_id) AS first_family FROM family_members GROUP BY accession"),
    "family_counts": X.sql(X.FAMILIES, select="SELECT family_id, coalesce(n_found, 0) AS n_found, coalesce(n_reported, 0) AS n_reported, coalesce(n_found, 0) <> coalesce(n_reported, 0) AS mismatch FROM (SELECT family_id, count(*) AS n_found FROM family_members GROUP BY family_id) FULL JOIN (SELECT 'VOG' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS family_id, CAST(p_size AS BIGINT) AS n_reported FROM part) USING (family_id)"),
    "check_tagging": X.sql(X.FAMILIES, RAW, _TAGGED, "h AS (SELECT header, count(*) AS n FROM raw GROUP BY header)", "g AS (SELECT header, count(*) AS n FROM tagged GROUP BY header)", "st AS (SELECT '>' || regexp_replace(header, '^>(VOG[0-9]+[|])+', '') AS header FROM tagged)",
        select="SELECT 'raw unique' AS \"check\", count_if(n = 1) AS n FROM h UNION ALL SELECT 'raw repeated', count_if(n > 1) FROM h UNION ALL SELECT 'tagged unique', count_if(n = 1) FROM g UNION ALL SELECT 'tagged repeated', count_if(n > 1) FROM g UNION ALL SELECT 'matched', count(*) FROM h WHERE header IN (FROM st) UNION ALL SELECT 'missing', count(*) FROM h WHERE header NOT IN (FROM st)"),
    "header_pattern_profile": X.sql(RAW, "f AS (SELECT CAST(regexp_matches(header, 'ACC[0-9]+ ') AS INTEGER) AS a, CAST(contains(header, 'ring') AS INTEGER) AS b, CAST(contains(header, 'small') AS INTEGER) AS c FROM raw)",
        select="SELECT pattern, n, round(n / CAST((SELECT count(*) FROM f) AS DOUBLE), 6) AS share FROM (SELECT 'digits' AS pattern, count_if(a = 1) AS n FROM f UNION ALL SELECT 'ring', count_if(b = 1) FROM f UNION ALL SELECT 'small', count_if(c = 1) FROM f UNION ALL SELECT 'several', count_if(a + b + c > 1) FROM f UNION ALL SELECT 'none', count_if(a + b + c = 0) FROM f)"),
}
