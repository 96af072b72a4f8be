"""Queries over gene calls."""

from __future__ import annotations

from strandlake import fixtures as X
from strandlake.operators import calls as C

CALLERS = ["genemark", "glimmer", "phanotate", "prodigal"]

QUERIES = {
    "merge_calls": lambda s, d: C.merge_calls(*[X.gene_calls(s, d).where(f"caller = '{c}'") for c in CALLERS]),
    "identify_callers": lambda s, d: C.identify_callers(X.gene_calls(s, d)),
    "compare_calls": lambda s, d: C.compare_calls(X.gene_calls(s, d)),
    "compare_calls_adjacent": lambda s, d: C.compare_calls(X.gene_calls(s, d), "adjacent"),
    "superset_calls": lambda s, d: C.superset_calls(X.gene_calls(s, d)),
    "superset_calls_adjacent": lambda s, d: C.superset_calls(X.gene_calls(s, d), "adjacent"),
    "common_core_calls": lambda s, d: C.common_core_calls(X.gene_calls(s, d)),
    "score_calls": lambda s, d: C.score_calls(X.gene_calls(s, d)),
    "average_scores": lambda s, d: C.average_scores(X.gene_calls(s, d)),
    "consensus_calls": lambda s, d: C.consensus_calls(X.gene_calls(s, d)),
    "consensus_calls_adjacent": lambda s, d: C.consensus_calls(X.gene_calls(s, d), "adjacent"),
    "consensus_scores_listing": lambda s, d: C.consensus_scores_listing(X.gene_calls(s, d)),
    "call_grid": lambda s, d: C.call_grid(X.gene_calls(s, d), CALLERS),
    "call_stats": lambda s, d: C.call_stats(X.gene_calls(s, d)),
    "call_totals": lambda s, d: C.call_totals(X.gene_calls(s, d)),
    "same_save_start": lambda s, d: C.same_save_start(X.gene_calls(s, d)),
    "primary_calls": lambda s, d: C.primary_calls(X.gene_calls(s, d), "consensus"),
    "primary_calls_superset": lambda s, d: C.primary_calls(X.gene_calls(s, d), "superset"),
    "primary_calls_common_core": lambda s, d: C.primary_calls(X.gene_calls(s, d), "common_core"),
    "primary_calls_of_one": lambda s, d: C.primary_calls(X.gene_calls(s, d), "prodigal"),
}

_N = "(SELECT count(DISTINCT caller) FROM gene_calls)"
_ORDER = "PARTITION BY contig ORDER BY left_end, right_end, caller, strand"
_ADJACENT = f"""runs AS (SELECT *, sum(fresh) OVER ({_ORDER} ROWS UNBOUNDED PRECEDING) AS group_no FROM (
  SELECT *, CASE WHEN (strand, left_end, right_end) = lag((strand, left_end, right_end)) OVER ({_ORDER}) THEN 0 ELSE 1 END AS fresh FROM gene_calls))"""
_STOPS = "stops AS (SELECT *, CASE WHEN strand = '+' THEN right_end ELSE left_end END AS stop FROM gene_calls)"
_NAMES = "string_agg(DISTINCT caller, '_' ORDER BY caller)"
_LABEL = f"CASE WHEN count(DISTINCT caller) = {_N} THEN 'unanimous' WHEN count(DISTINCT caller) = 1 THEN 'unique' ELSE 'multiple' END"
_SCORED = f"""tallied AS (SELECT *, count(*) OVER (PARTITION BY contig, strand, left_end, right_end) AS identicals, count(*) OVER (PARTITION BY contig, strand, stop) AS similars FROM stops),
scored AS (SELECT *, identicals / CAST({_N} AS DOUBLE) + CASE WHEN (identicals < {_N} OR similars > identicals) AND similars > 1 THEN 0.5 / {_N} ELSE 0 END AS score1 FROM tallied)"""
_CONSENSUS = f"""SELECT contig, strand, min(left_end) AS left_end, max(right_end) AS right_end, call_no, count(DISTINCT caller) AS n_callers, {_NAMES} AS callers, max(right_end) - min(left_end) + 1 AS length
  FROM ranked GROUP BY contig, strand, stop, call_no HAVING count(DISTINCT caller) >= 2"""
_KEYED_STOPS = "ranked AS (SELECT *, dense_rank() OVER (PARTITION BY contig ORDER BY stop, strand) AS call_no FROM stops)"


def _q(select: str, *parts: str) -> str:
    return X.sql(X.GENE_CALLS, *parts, select=select)


SQL = {
    "merge_calls": _q(f"SELECT *, row_number() OVER ({_ORDER}) AS ord FROM gene_calls"),
    "identify_callers": _q(f"SELECT count(DISTINCT caller) AS n_callers, {_NAMES} AS callers FROM gene_calls"),
    "compare_calls": _q("SELECT *, dense_rank() OVER (PARTITION BY contig ORDER BY left_end, right_end, strand) AS group_no FROM gene_calls"),
    "compare_calls_adjacent": _q("SELECT contig, strand, left_end, right_end, length, caller, CAST(group_no AS BIGINT) AS group_no FROM runs", _ADJACENT),
    "superset_calls": _q(f"SELECT contig, strand, left_end, right_end, right_end - left_end + 1 AS length, count(DISTINCT caller) AS n_callers, {_NAMES} AS callers, {_LABEL} AS agreement FROM gene_calls GROUP BY contig, strand, left_end, right_end"),
    "superset_calls_adjacent": _q(f"SELECT contig, strand, left_end, right_end, right_end - left_end + 1 AS length, count(DISTINCT caller) AS n_callers, {_NAMES} AS callers, {_LABEL} AS agreement FROM runs GROUP BY contig, strand, left_end, right_end, group_no", _ADJACENT),
    "common_core_calls": _q(f"SELECT *, row_number() OVER (PARTITION BY contig ORDER BY left_end, right_end, strand) AS call_no FROM (SELECT contig, strand, left_end, right_end, count(DISTINCT caller) AS n_callers, {_NAMES} AS callers FROM gene_calls GROUP BY contig, strand, left_end, right_end HAVING count(DISTINCT caller) = {_N})"),
    "score_calls": _q("SELECT contig, strand, left_end, right_end, length, caller, identicals, similars, score1 FROM scored", _STOPS, _SCORED),
    "average_scores": _q("SELECT caller, round(avg(score1), 6) AS avg_score, count(*) AS n_calls FROM scored GROUP BY caller", _STOPS, _SCORED),
    "consensus_calls": _q(_CONSENSUS, _STOPS, _KEYED_STOPS),
    "consensus_calls_adjacent": _q(_CONSENSUS, _STOPS, f"""ranked AS (SELECT *, CAST(sum(fresh) OVER ({_ORDER} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS call_no FROM (
  SELECT *, CASE WHEN (strand, stop) = lag((strand, stop)) OVER ({_ORDER}) THEN 0 ELSE 1 END AS fresh FROM stops))"""),
    "consensus_scores_listing": _q("SELECT concat_ws(chr(9), caller, contig, row_number() OVER (PARTITION BY contig, caller ORDER BY left_end, right_end, strand), left_end, right_end, strand, printf('%.2f', score1)) AS line FROM scored", _STOPS, _SCORED),
    "call_grid": _q("SELECT contig AS key_contig, strand AS key_strand, left_end AS key_left, right_end AS key_right, " + ", ".join(
        f"min(CASE WHEN caller = '{c}' THEN {e} END) AS {c}_{e}" for c in CALLERS for e in ("gene_no", "strand", "left_end", "right_end", "length", "contig")) + " FROM numbered GROUP BY contig, strand, left_end, right_end",
        "numbered AS (SELECT *, row_number() OVER (PARTITION BY contig, caller ORDER BY left_end, right_end, strand) AS gene_no FROM gene_calls)"),
    "call_stats": _q("SELECT caller, count(*) AS n_calls, min(length) AS min_length, max(length) AS max_length, round(sum(length) / CAST(count(*) AS DOUBLE), 4) AS avg_length FROM gene_calls GROUP BY caller"),
    "call_totals": _q(f"SELECT count(*) AS n_distinct, count_if(n = {_N}) AS n_common, count_if(n = 1) AS n_unique FROM (SELECT count(DISTINCT caller) AS n FROM gene_calls GROUP BY contig, strand, left_end, right_end)"),
    "same_save_start": _q("SELECT a.contig, a.strand, a.stop, a.start AS start1, b.start AS start2, a.caller AS caller1, b.caller AS caller2 FROM s a JOIN s b USING (contig, strand, stop) WHERE abs(a.stop - a.start) > abs(b.stop - b.start)",
                          _STOPS, "s AS (SELECT contig, strand, stop, left_end + right_end - stop AS start, caller FROM stops)"),
    "primary_calls": _q(f"SELECT contig, strand, left_end, right_end, callers FROM ({_CONSENSUS})", _STOPS, _KEYED_STOPS),
    "primary_calls_of_one": _q("SELECT contig, strand, left_end, right_end, caller AS callers FROM gene_calls WHERE caller = 'prodigal'"),
}
SQL |= {f"primary_calls_{c}": f"SELECT contig, strand, left_end, right_end, callers FROM ({SQL[f'{c}_calls']})" for c in ("superset", "common_core")}
