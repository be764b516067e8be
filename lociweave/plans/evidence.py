"""Evidence records of parts (loci) and supplier groups (genomes), and their check with planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contracts import evidence as ce
from ..operators import evidence as ev
from ..session import materialize
from . import bridges as b
from .registry import query

MARGIN = 0.02
DECISIONS = """
li AS (SELECT l_partkey AS locus_id, 'G' || l_suppkey % 10 AS genome, l_returnflag AS source, CAST(l_quantity AS DOUBLE) AS q FROM lineitem),
de AS (SELECT locus_id, genome, source, coalesce(max(q) FILTER (q > 10), 0) AS best, CASE WHEN count(*) FILTER (q > 10) > 1 THEN min(q) FILTER (q > 10) ELSE 0 END AS runner,
              count(*) FILTER (q > 10) AS n FROM li GROUP BY ALL),
ac AS (SELECT *, n > 0 AND best > runner AND (best - runner) / best >= 0.02 AS ok FROM de),
ce AS (SELECT locus_id, genome, bool_or(q = 50) AS observed FROM li GROUP BY ALL)
"""


def _inputs(spark, d):
    c = F.col
    li = b.table(spark, d, "lineitem").select(
        c("l_partkey").alias("locus_id"), F.concat(F.lit("G"), (c("l_suppkey") % 10).cast("string")).alias("genome"), c("l_returnflag").alias("source"),
        c("l_quantity").cast("double").alias("q"),
    )
    big = F.when(c("q") > 10, c("q"))
    decisions = li.groupBy("locus_id", "genome", "source").agg(F.coalesce(F.max(big), F.lit(0.0)).alias("best_score"), F.min(big).alias("least"), F.count(big).alias("placements"))
    place = F.struct("genome", F.lit(1).alias("direction"), c("least").alias("start0"), c("best_score").alias("end0"))
    decisions = decisions.select(
        "locus_id", "genome", "source", "best_score", F.when(c("placements") > 1, c("least")).otherwise(0.0).alias("runner_score"), "placements",
        F.when(c("placements") > 0, place).alias("placement"),
    )
    return li.groupBy("locus_id", "genome").agg(F.bool_or(c("q") == 50).alias("observed")), decisions, li.select("locus_id", "source").distinct()


@query("p59_evidence_records", f"""
WITH {DECISIONS}
SELECT locus_id, genome, CASE WHEN observed THEN '1' WHEN bool_or(ok) THEN '0' ELSE 'NA' END AS genotype,
       CASE WHEN observed THEN 'not_evaluated_observed' WHEN bool_or(ok) THEN 'callable' ELSE 'unresolved' END AS callability,
       CASE WHEN observed THEN 'observed_member' WHEN bool_or(ok) THEN 'at_least_one_certified_source' ELSE 'no_certified_source' END AS reason,
       CASE WHEN NOT observed THEN count(*) END AS source_model_n, CASE WHEN NOT observed THEN count(*) FILTER (ok) END AS certified_source_n,
       CASE WHEN NOT observed THEN coalesce(string_agg(source, ',' ORDER BY source) FILTER (ok), '') END AS supporting,
       CASE WHEN NOT observed THEN string_agg(source || ':' || CASE WHEN ok THEN 'dominant_ordered_placement' WHEN n > 0 THEN 'competing_placements' ELSE 'no_supported_placement' END
            || ':' || CAST(n AS VARCHAR), ',' ORDER BY source) END AS decisions
FROM ac JOIN ce USING (locus_id, genome) GROUP BY locus_id, genome, observed""")
def evidence_records(spark, d):
    cells, decisions, _ = _inputs(spark, d)
    e = F.col("evidence")
    shown = F.transform(e["source_decisions"], lambda x: F.concat_ws(":", x["source"], x["reason"], x["placements"].cast("string")))
    return ev.evidence_records(cells, decisions, MARGIN).select(
        "locus_id", "genome", "genotype", *[e[n].alias(n) for n in ("callability", "reason", "source_model_n", "certified_source_n")],
        F.array_join(e["supporting_sources"], ",").alias("supporting"), F.array_join(shown, ",").alias("decisions"),
    )


#: Faults by remainder of the locus; what each must raise is stated in the SQL.
@query("v04_evidence_faults", f"""
WITH {DECISIONS},
rc AS (SELECT locus_id, genome, observed, count(*) AS n, count(*) FILTER (ok) AS k, min(source) AS head FROM ac JOIN ce USING (locus_id, genome) GROUP BY ALL),
fl AS (SELECT *, locus_id || '|' || genome AS cell FROM rc),
hd AS (SELECT a.*, fl.cell FROM fl JOIN ac a ON a.locus_id = fl.locus_id AND a.genome = fl.genome AND a.source = fl.head WHERE NOT fl.observed),
al AS (
  SELECT 'source_count_mismatch' AS rule, cell AS subject FROM fl WHERE NOT observed AND locus_id % 11 = 1
  UNION ALL SELECT 'genotype_mismatch', cell FROM fl WHERE NOT observed AND locus_id % 11 = 2
  UNION ALL SELECT 'observed_record_has_evidence', cell FROM fl WHERE observed AND locus_id % 11 = 3
  UNION ALL SELECT 'reason_mismatch', cell FROM fl WHERE NOT observed AND locus_id % 11 = 3
  UNION ALL SELECT 'supporting_sources_mismatch', cell FROM fl WHERE NOT observed AND k > 0 AND locus_id % 11 = 4
  UNION ALL SELECT 'decision_reason_mismatch', cell || '|' || source FROM hd WHERE locus_id % 11 = 5
  UNION ALL SELECT unnest(['bad_scores', 'unsupported_decision_has_placement']), cell || '|' || source FROM hd WHERE n = 0 AND locus_id % 11 = 6
  UNION ALL SELECT 'missing_placement', cell || '|' || source FROM hd WHERE n > 0 AND locus_id % 11 = 7
  UNION ALL SELECT 'placement_in_other_genome', cell || '|' || source FROM hd WHERE n > 0 AND locus_id % 11 = 8
  UNION ALL SELECT 'duplicate_record', cell FROM fl WHERE locus_id % 11 = 9
  UNION ALL SELECT 'source_set_mismatch', fl.cell || '|' || s.source FROM fl JOIN (SELECT DISTINCT locus_id, source FROM li) s USING (locus_id)
            LEFT JOIN ac a ON a.locus_id = fl.locus_id AND a.genome = fl.genome AND a.source = s.source WHERE NOT fl.observed AND a.source IS NULL)
SELECT rule, subject FROM al""")
def evidence_faults(spark, d):
    cells, decisions, sources = _inputs(spark, d)
    records = materialize(ev.evidence_records(cells, decisions, MARGIN), "records")
    c, e, kind = F.col, F.col("evidence"), F.col("locus_id") % 11

    place = records.schema["evidence"].dataType["source_decisions"].dataType.elementType["placement"].dataType

    def head(change):  # the first decision, changed
        return F.transform(e["source_decisions"], lambda x, i: F.when(i == 0, change(x)).otherwise(x))

    changed = (
        F.when((kind == 1) & (c("genotype") != "1"), e.withField("source_model_n", e["source_model_n"] + 1))
        .when(kind == 3, e.withField("reason", F.lit("other")))
        .when(kind == 4, e.withField("supporting_sources", F.when(e["supporting_sources"].isNotNull(), F.array().cast("array<string>"))))
        .when(kind == 5, e.withField("source_decisions", head(lambda x: x.withField("reason", F.lit("other")))))
        .when(kind == 6, e.withField("source_decisions", head(lambda x: x.withField("runner_score", F.when(x["placements"] == 0, 5.0).otherwise(x["runner_score"])))))
        .when(kind == 7, e.withField("source_decisions", head(lambda x: x.withField("placement", F.lit(None).cast(place)))))
        .when(kind == 8, e.withField("source_decisions", head(lambda x: x.withField("placement", F.when(x["placement"].isNotNull(), x["placement"].withField("genome", F.lit("elsewhere")))))))
        .otherwise(e)
    )
    flipped = F.when((kind == 2) & (c("genotype") != "1"), F.when(c("genotype") == "0", "NA").otherwise("0")).otherwise(c("genotype"))
    faulty = records.select("locus_id", "genome", flipped.alias("genotype"), changed.alias("evidence"))
    faulty = faulty.unionByName(records.filter(kind == 9))
    return ce.evidence_violations(faulty, cells, sources, MARGIN).select("rule", "subject")
