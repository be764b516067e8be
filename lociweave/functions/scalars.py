"""Sequence, token, label and formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import _reject


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTNacgtn", "TGCANtgcan"))


def flip_token(token: Column) -> Column:
    first = F.substring(token, 1, 1)
    flipped = F.concat(F.translate(first, "<>", "><"), F.substring(token, 2, 2**31 - 1))
    return _reject(first.isin("<", ">"), flipped, "token must start with < or >")


def reverse_tokens(tokens: Column) -> Column:
    return F.transform(F.reverse(tokens), flip_token)


def relative_strand(strand: Column) -> Column:
    return (
        F.when(strand.isin("", "+", "-"), strand)
        .when(strand.isin("++", "--"), F.lit("+"))
        .when(strand.isin("+-", "-+"), F.lit("-"))
        .otherwise(F.raise_error(F.lit("invalid strand")))
    )


def kind_priority(kind: Column) -> Column:
    return F.when(kind == "reference_primary", 3).when(kind == "reference_comparison", 2).otherwise(1).cast("long")


def is_reference_kind(kind: Column) -> Column:
    return F.startswith(kind, F.lit("reference_"))


def score_text(value: Column) -> Column:
    """Six decimals; blank for null."""
    return F.coalesce(F.format_string("%.6f", value.cast("double")), F.lit(""))


def hit_usable_for_reference(label: Column, chrom: Column, start1: Column, end1: Column) -> Column:
    return F.coalesce(
        label.isin("unique", "self_primary") & (F.length(chrom) > 0) & start1.isNotNull() & end1.isNotNull(),
        F.lit(False),
    )


def hit_usable_for_novel(label: Column, chrom: Column, start1: Column, end1: Column, coverage: Column, least: float) -> Column:
    """The threshold applies to the coverage rounded to six decimals."""
    return F.coalesce(
        (label == "unique")
        & hit_usable_for_reference(label, chrom, start1, end1)
        & (F.round(coverage, 6) >= F.lit(least)),
        F.lit(False),
    )


def admission(label: Column, has_ins: Column) -> Column:
    """Struct (admit, rule, reason): an insertion admits under every hit label, otherwise only a unique hit does."""
    with_ins = (
        F.when(label == "unique", F.lit("hal_unique_cov_ge_0.5_with_ins"))
        .when(label == "multi_clear_primary", F.lit("sv_ins_primary_hal_multimap"))
        .when(label == "ambiguous_tie", F.lit("sv_ins_primary_hal_ambiguous"))
        .when(label == "low_quality", F.lit("sv_ins_primary_hal_cov_lt_0.5"))
        .when(label == "no_hal", F.lit("sv_ins_primary_no_hal"))
        .otherwise(
            F.concat(F.lit("sv_ins_primary_hal_"), F.when(F.length(label) > 0, label).otherwise(F.lit("unknown")))
        )
    )
    reason = (
        F.when(label == "multi_clear_primary", F.lit("hal_multimap_no_ins"))
        .when(label == "ambiguous_tie", F.lit("hal_ambiguous_no_ins"))
        .when(label == "low_quality", F.lit("hal_cov_lt_0.5_no_ins"))
        .when(label == "no_hal", F.lit("no_hal_no_ins"))
        .otherwise(F.lit("no_usable_hal_or_ins_evidence"))
    )
    unique = label == "unique"
    return F.struct(
        (has_ins | unique).alias("admit"),
        F.when(has_ins, with_ins).when(unique, F.lit("hal_unique_cov_ge_0.5")).otherwise(F.lit("")).alias("rule"),
        F.when(has_ins | unique, F.lit("")).otherwise(reason).alias("reason"),
    )


def frequency_class(asm_hap_n: Column, total: Column, major: Column, has_ref: Column) -> Column:
    return (
        F.when((asm_hap_n <= 0) & (has_ref == 1), F.lit("ref_only"))
        .when(asm_hap_n <= 0, F.lit("absent"))
        .when(asm_hap_n == 1, F.lit("singleton"))
        .when((total > 0) & (asm_hap_n >= total), F.lit("shared"))
        .when(major == 1, F.lit("major"))
        .otherwise(F.lit("polymorphic"))
    )


def locus_id_order(locus_id: Column) -> list[Column]:
    """Sort columns: numeric ids by value, then the others as text."""
    digits = locus_id.rlike("^[0-9]+$")
    return [F.when(digits, 0).otherwise(1), F.when(digits, locus_id.try_cast("decimal(38,0)")), locus_id]


def walk_tokens(walk: Column) -> Column:
    """Tokens of a W walk; anything left over is an error."""
    tokens = F.regexp_extract_all(walk, F.lit(r"([<>])([^<>,\s]+)"), F.lit(0))
    rest = F.regexp_replace(walk, r"[<>][^<>,\s]+", "")
    return _reject(rest.rlike(r"^[ ,\t\r\n]*$") & (F.size(tokens) > 0), tokens, "malformed W walk")


def path_tokens(path: Column) -> Column:
    """Tokens of a P path as >name / <name; a jump separator or leftover text is an error."""
    found = F.regexp_extract_all(path, F.lit(r"([^,;\s]+)([+-])"), F.lit(0))
    rest = F.regexp_replace(path, r"[^,;\s]+[+-]", "")
    tokens = F.transform(
        found,
        lambda t: F.concat(
            F.when(F.endswith(t, F.lit("+")), F.lit(">")).otherwise(F.lit("<")),
            F.substr(t, F.lit(1), F.length(t) - 1),
        ),
    )
    return _reject(rest.rlike(r"^[ ,\t\r\n]*$") & (F.size(tokens) > 0), tokens, "malformed P path")


def link_key(a: Column, a_sign: Column, b: Column, b_sign: Column) -> Column:
    """Undirected link: the smaller of the link and its reverse complement."""

    def flip(sign: Column) -> Column:
        return F.translate(sign, "+-", "-+")

    def make(w: Column, x: Column, y: Column, z: Column) -> Column:
        return F.struct(w.alias("from_name"), x.alias("from_sign"), y.alias("to_name"), z.alias("to_sign"))

    return F.least(make(a, a_sign, b, b_sign), make(b, flip(b_sign), a, flip(a_sign)))


def overlap_status(overlaps: Column, segment_n: Column) -> Column:
    entries = F.when(F.length(overlaps) > 0, F.split(overlaps, ",")).otherwise(F.array().cast("array<string>"))
    return (
        F.when((overlaps == "*") & (segment_n == 1), F.lit("zero_single_segment"))
        .when(overlaps == "*", F.lit("requires_link_verification"))
        .when(F.size(entries) != F.greatest(F.lit(0), segment_n - 1), F.lit("invalid_count"))
        .when(F.forall(entries, lambda e: e == "0M"), F.lit("zero"))
        .otherwise(F.lit("nonzero_unsupported"))
    )


def compact_ranges(ranges: Column) -> Column:
    """`node:start-end` of an array of structs (node, s, e), joined by commas."""
    return F.array_join(F.transform(ranges, lambda r: F.format_string("%d:%d-%d", r["node"], r["s"], r["e"])), ",")


def compact_list(values: Column) -> Column:
    """Values joined by semicolons, in their order."""
    return F.array_join(values.cast("array<string>"), ";")


def kmers(seq: Column, k: int) -> Column:
    """Distinct k-mers; a shorter non-empty text is its own only k-mer."""
    n = F.length(seq)
    return (
        F.when(seq.isNull() | (n == 0), F.array().cast("array<string>"))
        .when(n < k, F.array(seq))
        .otherwise(F.array_distinct(F.regexp_extract_all(seq, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))))
    )


def bind(value: Column, fn) -> Column:
    """`fn` of a value that is computed once, also when `fn` uses it inside further lambdas."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def spaced_shingles(tokens: Column, k: int, limit: int | None = None) -> Column:
    """Windows of k tokens joined by `|`; with a limit, more of them are thinned to evenly spaced positions (half-even)."""

    def build(t: Column) -> Column:
        n = F.size(t)
        width = F.least(F.lit(k), n)
        picks = F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))
        if limit is not None:
            last = (n - width).cast("double")
            spaced = F.array_distinct(
                F.transform(
                    F.sequence(F.lit(0), F.lit(limit - 1)), lambda i: F.bround(i * last / F.lit(limit - 1)).cast("int")
                )
            )
            picks = F.when(n - width + 1 > limit, spaced).otherwise(picks)
        shingles = F.transform(picks, lambda i: F.array_join(F.slice(t, i + 1, width), "|"))
        return F.when(n == 0, F.array().cast("array<string>")).otherwise(shingles)

    return bind(tokens, build)


def end_anchors(tokens: Column, k: int) -> tuple[Column, Column]:
    n = F.size(tokens)
    width = F.least(F.lit(k), n)
    left = F.when(n == 0, F.lit("")).otherwise(F.array_join(F.slice(tokens, F.lit(1), width), "|"))
    right = F.when(n == 0, F.lit("")).otherwise(F.array_join(F.slice(tokens, n - width + 1, width), "|"))
    return left, right


def genotype_of_allele(observed: Column, locus_call: Column) -> Column:
    return F.when(observed, F.lit("1")).when(locus_call == "NA", F.lit("NA")).otherwise(F.lit("0"))
