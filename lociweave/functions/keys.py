"""Identifier and coordinate-key expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The composite key is sample#haplotype#contig:start-end, the contig part being greedy.
FEATURE_KEY = r"^([^#]+)#([^#]+)#(.+):([0-9]+)-([0-9]+)$"


def _reject(test: Column, value: Column, message: str) -> Column:
    return F.when(test, value).otherwise(F.raise_error(F.lit(message)))


def feature_key(contig_key: Column, start0: Column, end0: Column) -> Column:
    return F.concat(contig_key, F.lit(":"), start0.cast("string"), F.lit("-"), end0.cast("string"))


def is_feature_key(key: Column) -> Column:
    return key.rlike(FEATURE_KEY)


def parse_feature_key(key: Column) -> Column:
    """Struct of sample, hap, contig, start0, end0; an unparsable key is an error."""

    def part(i: int) -> Column:
        return F.regexp_extract(key, FEATURE_KEY, i)

    parsed = F.struct(
        part(1).alias("sample"),
        part(2).alias("hap"),
        part(3).alias("contig"),
        part(4).try_cast("long").alias("start0"),
        part(5).try_cast("long").alias("end0"),
    )
    return _reject(is_feature_key(key), parsed, "cannot parse feature key")


def key_order(key: Column) -> Column:
    """What feature keys are ordered by: sample, haplotype, contig, start, end, then the key itself."""
    p = parse_feature_key(key)
    names = [F.coalesce(p[n], F.lit("")).alias(n) for n in ("sample", "hap", "contig")]
    ends = [F.coalesce(p[n], F.lit(0)).cast("long").alias(n) for n in ("start0", "end0")]
    return F.struct(*names, *ends, key.alias("key"))


def key_length(key: Column) -> Column:
    parsed = parse_feature_key(key)
    return F.greatest(F.lit(0), parsed["end0"] - parsed["start0"])


def midpoint(start: Column, end: Column) -> Column:
    """Midpoint rounded half to even."""
    return F.bround((start + end) / F.lit(2.0)).cast("long")


def split_contig_key(key: Column) -> Column:
    """Exactly three non-empty parts: sample, haplotype, contig."""
    parts = F.split(key, "#", 3)
    good = (F.size(parts) == 3) & F.forall(parts, lambda p: F.length(p) > 0)
    return _reject(
        good,
        F.struct(
            F.get(parts, F.lit(0)).alias("sample"),
            F.get(parts, F.lit(1)).alias("hap"),
            F.get(parts, F.lit(2)).alias("contig"),
        ),
        "contig key must have three parts",
    )


def _json_ascii(text: Column) -> Column:
    """JSON string body with every non-ASCII code point escaped."""

    def hex4(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(code), 4, "0")))

    def escape(ch: Column) -> Column:
        code = F.ascii(ch).cast("long")
        high = F.lit(0xD800) + F.floor((code - 0x10000) / 1024).cast("long")
        low = F.lit(0xDC00) + (code - 0x10000) % 1024
        return (
            F.when(ch == '"', F.lit('\\"'))
            .when(ch == "\\", F.lit("\\\\"))
            .when(ch == "\n", F.lit("\\n"))
            .when(ch == "\r", F.lit("\\r"))
            .when(ch == "\t", F.lit("\\t"))
            .when(ch == "\b", F.lit("\\b"))
            .when(ch == "\f", F.lit("\\f"))
            .when(code < 32, hex4(code))
            .when(code < 127, ch)
            .when(code < 0x10000, hex4(code))
            .otherwise(F.concat(hex4(high), hex4(low)))
        )

    plain = text.rlike(r'^[ !#-\[\]-~]*$')
    return F.when(plain, text).otherwise(F.array_join(F.transform(F.split(text, ""), escape), ""))


def storage_id(prefix: str, *names: Column) -> Column:
    """Prefix plus SHA-256 of the compact ASCII JSON array of the names."""
    quoted = [F.concat(F.lit('"'), _json_ascii(n), F.lit('"')) for n in names]
    body = F.concat(F.lit("["), F.concat_ws(",", *quoted), F.lit("]"))
    return F.concat(F.lit(prefix), F.sha2(body, 256))


def path_id(record_type: Column, names: Sequence[Column]) -> Column:
    """`GP_` plus the first 24 hex digits of SHA-256 over the NUL-joined record type and names."""
    return F.concat(F.lit("GP_"), F.substring(F.sha2(F.concat_ws("\0", record_type, *names), 256), 1, 24))


def percent_encode(text: Column) -> Column:
    """RFC 3986 encoding that keeps letters, digits and `-._~`."""
    encoded = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def public_allele_id(genome: Column, sequence: Column, start0: Column, end0: Column) -> Column:
    def clean(name: Column) -> Column:
        good = (F.length(name) > 0) & (F.trim(name) == name) & ~F.contains(name, F.lit("\0"))
        return _reject(good, name, "invalid representative name")

    built = F.concat(
        percent_encode(clean(genome)),
        F.lit("_"),
        percent_encode(clean(sequence)),
        F.lit(":"),
        start0.cast("string"),
        F.lit(":"),
        end0.cast("string"),
    )
    return _reject(end0 > start0, built, "representative interval must have positive length")


def is_canonical_number(text: Column) -> Column:
    return text.rlike("^(0|[1-9][0-9]*)$")


def is_whole_number(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def whole_number(text: Column) -> Column:
    return _reject(is_whole_number(text), text.try_cast("long"), "expected a non-negative decimal integer")


def is_signed_length(text: Column, sv_type: Column) -> Column:
    value = text.try_cast("long")
    return F.coalesce(
        text.rlike("^[+-]?[0-9]+$")
        & (((sv_type == "INS") & (value > 0)) | ((sv_type == "DEL") & (value < 0))),
        F.lit(False),
    )


def signed_length(text: Column, sv_type: Column) -> Column:
    return _reject(is_signed_length(text, sv_type), text.try_cast("long"), "event length contradicts its type")


def lenient_int(text: Column, default: Column | None = None) -> Column:
    """Integer, or a float cut towards zero, or the default for blanks and anything else."""
    trimmed = F.when(~text.isin("", ".", "nan", "None"), F.trim(text))
    whole = F.when(trimmed.rlike("^[+-]?[0-9]+$"), trimmed.try_cast("long"))
    real = trimmed.try_cast("double")
    cut = F.when(~F.isnan(real) & (F.abs(real) < F.lit(9.0e18)), real.try_cast("long"))
    parsed = F.coalesce(whole, cut)
    return F.coalesce(parsed, default) if default is not None else parsed
