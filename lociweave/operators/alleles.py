"""Alleles: sequence clusters inside each locus, their representatives and statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import AlleleRules
from ..functions import scalars as sc
from ..session import materialize
from .align import identity_udf
from .scan import ordered_scan

_OUT = "locus_id {t}, band long, cluster long, fid string, seq_key string"


class _Clusters:
    """Clusters of one locus band while its members stream by; it holds sequence keys and the pairs that belong together."""

    def __init__(self, rules: AlleleRules) -> None:
        self.rules = rules
        self.together: dict[tuple[str, str], tuple[float, float]] = {}  # similarity and length ratio
        self.seeds: list[str] = []
        self.clusters: list[dict[str, int]] = []
        self.by_seed: dict[int, list[int]] = {}

    def pair(self, p: str, q: str) -> tuple[float, float] | None:
        return (1.0, 1.0) if p == q else self.together.get((p, q) if p < q else (q, p))

    def _seed(self, key: str) -> int:
        """The seed a sequence belongs with: the most similar one, then the latest; without any it becomes a seed."""
        tests = [(found[0], i) for i, seed in enumerate(self.seeds) if (found := self.pair(key, seed))]
        if not tests:
            self.seeds.append(key)
            return len(self.seeds) - 1
        return max(tests)[1]

    def _clique(self, key: str, among: list[int]) -> int | None:
        best = None
        for nth, c in enumerate(among):
            total, weight, least = 0.0, 0, 1.0
            for other, n in self.clusters[c].items():
                found = self.pair(key, other)
                if found is None:
                    break
                total, weight, least = total + found[0] * n, weight + n, min(least, found[1])
            else:
                score = (round(total / weight, 12), least, -nth)
                if best is None or score > best[0]:
                    best = (score, c)
        return None if best is None else best[1]

    def place(self, key: str) -> int:
        if self.rules.mode == "greedy":
            c = self._seed(key)
            if c == len(self.clusters):
                self.clusters.append({})
        else:
            group = 0 if self.rules.mode == "allpairs_clique" else self._seed(key)
            among = self.by_seed.setdefault(group, [])
            c = self._clique(key, among)
            if c is None:
                c = len(self.clusters)
                self.clusters.append({})
                among.append(c)
        self.clusters[c][key] = self.clusters[c].get(key, 0) + 1
        return c


def length_bands(lengths: DataFrame, min_ratio: float) -> DataFrame:
    """Split the lengths of a locus where neighbours differ too much; no cluster can cross such a gap.

    lengths: locus_id, length (distinct).  Adds `band`.
    """
    seen = ordered_scan(lengths, ["locus_id"], ["length"], {"__prev": ("lag", "length")}, keep_slices=True)
    gap = F.coalesce(F.col("__prev") / F.greatest(F.lit(1), F.col("length")) < min_ratio, F.lit(False))
    return ordered_scan(
        seen.withColumn("__gap", gap.cast("long")), ["locus_id"], ["length"], {"band": ("sum", "__gap")}
    ).select("locus_id", "length", "band")


def cluster_alleles(members: DataFrame, rules: AlleleRules = AlleleRules()) -> DataFrame:
    """Members with their allele.

    members: locus_id, fid, label, kind, placed, is_medoid, seq (already oriented to the medoid).
    Bands with one distinct sequence, so also large groups of exact copies, are settled by plain aggregation.
    For the others all close pairs of distinct sequences are aligned as a table of their own, spread over tasks.  Placing
    is ordered: members of a band stream by in the order the rule prescribes, and the task looks pairs up in that table.
    Representatives are aggregates of the same table.
    """
    c = F.col
    keyed = members.withColumns({"seq_key": F.sha2("seq", 256), "length": F.length("seq").cast("long")})
    bands = length_bands(keyed.select("locus_id", "length").distinct(), rules.min_len_ratio)
    sequences = keyed.groupBy("locus_id", "length", "seq_key").agg(F.any_value("seq").alias("seq"))
    sequences = materialize(sequences.join(bands, ["locus_id", "length"]), "sequences")
    sizes = sequences.groupBy("locus_id", "band").agg(F.count(F.lit(1)).alias("distinct_n"))
    placed = bands.join(sizes, ["locus_id", "band"])
    assembly, reference = ~sc.is_reference_kind(c("kind")), sc.is_reference_kind(c("kind"))
    slim = materialize(
        keyed.join(placed, ["locus_id", "length"]).select(
            "locus_id", "band", "distinct_n", "fid", "label", "kind", "seq_key", "length",
            F.when(c("is_medoid"), 0).otherwise(1).alias("o1"), F.when(assembly, 0).otherwise(1).alias("o2"),
            (-c("length")).alias("o3"), assembly.alias("is_asm"), reference.alias("is_ref"),
            sc.kind_priority(c("kind")).alias("priority"), c("placed").cast("int").alias("placed"),
        ),
        "members",
    )
    single, mixed = slim.filter("distinct_n = 1"), slim.filter("distinct_n > 1")
    return _copies(single, rules).unionByName(_mixed(mixed, sequences, sizes, rules))


_RESULT = ["locus_id", "fid", "label", "kind", "length", "seq_key", "allele_id", "similarity", "is_rep"]


def _copies(single: DataFrame, rules: AlleleRules) -> DataFrame:
    c = F.col
    tie = F.struct("priority", "placed", "length", "fid")
    first = F.min_by("fid", F.struct("o1", "o2", "o3", "fid"))
    anyone = F.max_by("fid", tie)
    rule = rules.representative
    if rule == "first":
        rep = first
    elif rule in ("longest", "asm_longest"):
        by_len = F.struct("length", "fid")
        rep = F.max_by("fid", by_len)
        if rule == "asm_longest":
            rep = F.coalesce(F.max_by(F.when(c("is_asm"), c("fid")), F.when(c("is_asm"), by_len)), rep)
    elif rule == "seq_medoid":
        rep = anyone
    else:
        flag = c("is_asm") if rule == "asm_seq_medoid" else c("is_ref")
        rep = F.coalesce(F.max_by(F.when(flag, c("fid")), F.when(flag, tie)), anyone)
    reps = single.groupBy("locus_id", "band").agg(rep.alias("allele_id"))
    return single.join(reps, ["locus_id", "band"]).select(
        *[n for n in _RESULT if n not in ("allele_id", "similarity", "is_rep")], "allele_id",
        F.lit(1.0).alias("similarity"), (c("fid") == c("allele_id")).alias("is_rep"),
    )


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows by key in as many tasks as shuffles have: few bytes are much work here, so tasks are not joined up by their bytes."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def similar_pairs(sequences: DataFrame, rules: AlleleRules = AlleleRules()) -> DataFrame:
    """p, q (p < q), similarity, ratio: all pairs of distinct sequences of a band whose lengths are close enough.

    sequences: locus_id, band, seq_key, seq, length.  Sequences of close lengths share one of two steps of a length scale,
    so only those meet; a pair that shares both is kept where it meets first.  Alignments are spread over tasks by pair.
    """
    c, key = F.col, ["locus_id", "band"]
    step = F.floor(F.log(c("length").cast("double")) / F.lit(-math.log(rules.min_len_ratio) * (1 + 1e-9))).cast("long") if rules.min_len_ratio < 1 else c("length")
    rows = sequences.select(*key, "seq_key", "length", step.alias("own")).withColumn("step", F.explode(F.array(c("own"), c("own") + 1)))
    left = rows.select(*key, "step", c("seq_key").alias("p"), c("length").alias("n"), c("own").alias("x"))
    right = rows.select(*key, "step", c("seq_key").alias("q"), c("length").alias("m"), c("own").alias("y"))
    ratio = F.least("n", "m") / F.greatest(F.lit(1), F.greatest("n", "m"))
    close = left.join(right, [*key, "step"]).filter((c("p") < c("q")) & (ratio >= rules.min_len_ratio) & (c("step") == F.greatest("x", "y")))
    return _aligned(close.select(*key, "p", "q", ratio.alias("ratio")), sequences, rules)


def _aligned(pairs: DataFrame, sequences: DataFrame, rules: AlleleRules) -> DataFrame:
    """`pairs` (locus_id, band, p, q, ...) with their similarity."""
    key, texts = ["locus_id", "band"], sequences.select("locus_id", "band", "seq_key", "seq")
    both = pairs.join(texts.withColumnsRenamed({"seq_key": "p", "seq": "__a"}), [*key, "p"]).join(texts.withColumnsRenamed({"seq_key": "q", "seq": "__b"}), [*key, "q"])
    spread = _spread(both, *key, "p", "q")
    return spread.withColumn("similarity", identity_udf(rules)("__a", "__b")).select(*pairs.columns, "similarity")


def _mixed(mixed: DataFrame, sequences: DataFrame, sizes: DataFrame, rules: AlleleRules) -> DataFrame:
    """Members of bands with several sequences.  Pairs are aligned first; the ordered step looks them up only."""
    c = F.col
    key = ["locus_id", "band"]
    texts = sequences.join(sizes.filter("distinct_n > 1").select(*key), key)
    pairs = materialize(similar_pairs(texts, rules), "pairs")
    order = ["o0", "o1", "o2", "o3", "fid"]
    head = pairs.filter(c("similarity") >= rules.identity).select(
        *key, c("p").alias("seq_key"), "q", "similarity", "ratio", F.lit(0).alias("o0"), F.lit(0).alias("o1"), F.lit(0).alias("o2"),
        F.lit(0).cast("bigint").alias("o3"), F.lit(None).cast("string").alias("fid"),
    )
    body = mixed.select(
        *key, "seq_key", F.lit(None).cast("string").alias("q"), F.lit(None).cast("double").alias("similarity"),
        F.lit(None).cast("double").alias("ratio"), F.lit(1).alias("o0"), "o1", "o2", "o3", "fid",
    )
    rows = _spread(head.unionByName(body), *key).sortWithinPartitions(*key, *order)

    def run(group: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = _Clusters(rules)
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                if r.o0 == 0:
                    state.together[r.seq_key, r.q] = r.similarity, r.ratio
                else:
                    out.append((*group, state.place(r.seq_key), r.fid, r.seq_key))
            yield pd.DataFrame(out, columns=names)

    schema = _OUT.format(t=mixed.schema["locus_id"].dataType.simpleString())
    names = [part.split()[0] for part in schema.split(", ")]
    placed = materialize(rows.groupBy(*key).applyInPandas(run, schema), "alleles")
    full = materialize(mixed.join(placed.drop("seq_key"), [*key, "fid"]), "placed")
    known = _with_cluster_pairs(full, pairs, texts, rules)
    reps = _representatives(full, known, rules)
    same = (c("seq_key") == c("rep_key"))
    joined = full.join(reps, [*key, "cluster"]).withColumns({"p": F.least("seq_key", "rep_key"), "q": F.greatest("seq_key", "rep_key")})
    out = joined.join(known, [*key, "cluster", "p", "q"], "left").withColumns({
        "similarity": F.when(same, 1.0).otherwise(c("similarity")), "is_rep": c("fid") == c("allele_id"),
    })
    return out.select(*_RESULT)


def _with_cluster_pairs(full: DataFrame, pairs: DataFrame, texts: DataFrame, rules: AlleleRules) -> DataFrame:
    """cluster, p, q, similarity of all pairs of sequences in a cluster; lengths too far apart to be placed together are aligned here."""
    key = ["locus_id", "band"]
    keys = full.select(*key, "cluster", "seq_key").distinct()
    inside = keys.withColumnRenamed("seq_key", "p").join(keys.withColumnRenamed("seq_key", "q"), [*key, "cluster"]).filter("p < q")
    found = materialize(inside.join(pairs.drop("ratio"), [*key, "p", "q"], "left"), "cluster_pairs")
    late = _aligned(found.filter("similarity is null").drop("similarity"), texts, rules)
    return materialize(found.filter("similarity is not null").unionByName(late), "known_pairs")


def _representatives(full: DataFrame, known: DataFrame, rules: AlleleRules) -> DataFrame:
    """allele_id and rep_key per cluster."""
    c, key = F.col, ["locus_id", "band", "cluster"]
    rule = rules.representative
    if rule == "first":
        first = F.min_by(F.struct("fid", "seq_key"), F.struct("o1", "o2", "o3", "fid"))
        return full.groupBy(*key).agg(first.alias("r")).select(*key, c("r.fid").alias("allele_id"), c("r.seq_key").alias("rep_key"))
    flag = c("is_asm") if rule in ("asm_seq_medoid", "asm_longest") else c("is_ref") if rule == "ref_first" else F.lit(True)
    any_flag = full.groupBy(*key).agg(F.max(flag).alias("any_flag"))
    live = full.join(any_flag, key).filter(flag | ~c("any_flag"))
    tie = F.struct("priority", "placed", "length", "fid")
    keys = live.groupBy(*key, "seq_key").agg(F.count(F.lit(1)).alias("n"), F.max(tie).alias("tie"))
    if rule in ("longest", "asm_longest"):
        score = F.struct("tie.length", "tie.fid")
    else:
        both = known.select(*key, c("p").alias("seq_key"), c("q").alias("other"), "similarity").unionByName(known.select(*key, c("q").alias("seq_key"), c("p").alias("other"), "similarity"))
        others = keys.select(*key, c("seq_key").alias("other"), c("n").alias("other_n"))
        sums = both.join(others, [*key, "other"]).groupBy(*key, "seq_key").agg(F.sum(c("other_n") * c("similarity")).alias("sum"))
        keys = keys.join(sums, [*key, "seq_key"], "left").withColumn("total", F.round(10.0 + (c("n") - 1) + F.coalesce("sum", F.lit(0.0)), 12))
        score = F.struct("total", "tie")
    return keys.groupBy(*key).agg(F.max_by(F.struct("tie.fid", "seq_key"), score).alias("r")).select(*key, c("r.fid").alias("allele_id"), c("r.seq_key").alias("rep_key"))


def allele_catalogue(clustered: DataFrame, total_assemblies: int) -> DataFrame:
    """Counts per allele, the major allele of each locus and the frequency class."""
    c = F.col
    ref = sc.is_reference_kind(c("kind"))
    per_label = clustered.groupBy("locus_id", "allele_id", "label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~ref).alias("asm_n"),
        F.count_if(c("kind") == "reference_primary").alias("p"), F.count_if(c("kind") == "reference_comparison").alias("q"),
        F.max(F.when(c("is_rep"), c("length"))).alias("rep_len"),
    )
    alleles = per_label.groupBy("locus_id", "allele_id").agg(
        F.sum("n").alias("member_n"), F.count(F.lit(1)).alias("hap_n"), F.count_if(c("asm_n") > 0).alias("asm_hap_n"),
        F.count_if(c("n") > c("asm_n")).alias("ref_hap_n"), F.sum("asm_n").alias("asm_member_n"),
        F.sum(c("n") - c("asm_n")).alias("ref_member_n"), F.max((c("p") > 0).cast("long")).alias("has_primary_ref"),
        F.max((c("q") > 0).cast("long")).alias("has_comparison_ref"), F.max("rep_len").alias("rep_len"),
    )
    alleles = materialize(alleles, "catalogue")
    major = alleles.groupBy("locus_id").agg(
        F.max_by(
            "allele_id", F.struct("asm_hap_n", "asm_member_n", "hap_n", "member_n", "rep_len", "allele_id")
        ).alias("major_id")
    )
    flagged = alleles.join(major, "locus_id").withColumn("major_allele", (c("allele_id") == c("major_id")).cast("long"))
    has_ref = (c("ref_member_n") > 0).cast("long")
    return flagged.drop("major_id").withColumn(
        "freq_class", sc.frequency_class(c("asm_hap_n"), F.lit(total_assemblies), c("major_allele"), has_ref)
    )
