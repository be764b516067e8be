"""Quality rules as a learned decision list, on DataFrame functions only.

Statistics of a text are column expressions. A decision list is learned from labelled documents by sequential covering: a rule is a
conjunction of thresholds that is grown one condition at a time by information gain on two thirds of the labelled rows, pruned back
to the prefix that does best on the other third, and taken if it is precise enough there; the rows it covers are set aside and the next rule is
grown on the rest. The ordered rules become one CASE expression that keeps a document unless a rule rejects it.

Every growing step is one aggregation of (statistic, bin) counts over all labelled rows: a bounded table of a few hundred rows comes
to the driver, whatever their number. Nothing is sampled.

Defined results: a null text has no words; statistics per word or character are 0 where there are none; without labels of both kinds
there are no rules and the base rules decide alone; several labels of one document: the lowest holds; null labels are ignored;
repeated rows are judged alike; texts of any length are judged whole; an empty table gives an empty result, empty labels no rules;
other columns are not read (`keep` returns them as they are). Rules are learned until none reaches `precision` on `min_support` rows, and
there are at most `max_rules` of at most `max_conditions` conditions, which keeps them readable: parameters of the method. Words are runs of characters other than the six ASCII white-space characters.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

SPACES = " \t\n\x0b\f\r"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_distinct", "n_upper", "n_marks"]
MIN_WORDS, MAX_REPEATED = 50, 50


def bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once: a lambda variable stands for it."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words inside windows of `size` words that occur at least twice in the text."""

    def covered(marks: Column) -> Column:
        # windows in order of their hash; those beside an equal one; their places in order
        def places(ordered: Column) -> Column:
            same = lambda e, j: ((j > 0) & (F.get(ordered, j - 1)["h"] == e["h"])) | (F.get(ordered, j + 1)["h"] == e["h"])
            return F.array_sort(F.transform(F.filter(ordered, lambda e, j: F.coalesce(same(e, j), F.lit(False))), lambda e: e["i"]))

        ordered = F.array_sort(F.transform(marks, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        start = F.struct(F.lit(-size).alias("last"), F.lit(0).alias("n"))
        step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(size), i - acc["last"])).alias("n"))
        return F.aggregate(bound(ordered, places), start, step, lambda acc: acc["n"])

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))
    count = bound(hashes, lambda marks: F.when(F.size(F.array_distinct(marks)) == F.size(marks), 0).otherwise(covered(marks)))
    return F.when(F.size(words) > size, count).otherwise(0)


def statistics(text: Column) -> Column:
    """Struct of BASE and EXTRA, all long."""
    body = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(body, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+", -1))
    of_words = bound(
        words,
        lambda w: F.struct(
            F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"), repeated_words(w).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).alias("n_distinct"),
        ),
    )
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    of_lines = bound(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    without = lambda pattern: F.length(body) - F.length(F.regexp_replace(body, pattern, ""))
    found = {
        "n_symbols": without("[#*$%&|<>]+"),
        "n_upper": without(r"\p{Lu}+"),
        "n_marks": F.length(F.regexp_replace(body, r"[\p{L}\p{N}\p{M}\s]+", "")),
    }
    whole = F.struct(of_words.alias("w"), of_lines.alias("l"), *[v.alias(k) for k, v in found.items()])
    return bound(
        whole,
        lambda s: F.struct(
            *[
                (s["w"][c] if c in ("n_words", "word_chars", "n_repeat_words", "n_distinct") else s["l"][c] if c.endswith("lines") else s[c]).cast("long").alias(c)
                for c in BASE + EXTRA
            ]
        ),
    )


def features(stats: Column) -> dict[str, Column]:
    """What conditions may test: counts and shares, 0 where there is nothing to share."""
    share = lambda a, b: F.coalesce(F.try_divide(stats[a].cast("double"), stats[b].cast("double")), F.lit(0.0))
    return {
        "words": stats["n_words"].cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "mark_share": share("n_marks", "word_chars"),
        "upper_share": share("n_upper", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
    }


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEATED * stats["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float
    cut: int

    def on(self, values: dict[str, Column]) -> Column:
        return values[self.feature] > self.threshold if self.above else values[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = list[Condition]


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _below(name: str):
    return lambda cut: cut < F.col(name)


def learn(
    stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", max_rules: int = 8, max_conditions: int = 4,
    bins: int = 32, precision: float = 0.9, min_support: int = 5,
) -> list[Rule]:
    """Rules that reject documents labelled 0. `stats` has `doc_id` and the struct `stats`."""
    named = labels.select(labels[key].alias("doc_id"), labels[label].alias("label")).filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    values = features(F.col("stats"))
    names = list(values)
    rows = stats.join(named, "doc_id").select((F.col("label") == 0).alias("bad"), F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("fold"), *[v.alias(n) for n, v in values.items()])
    rows = stored(rows, "quality-labelled")
    shares = [i / bins for i in range(1, bins)]
    # Cut points from either kind, as a rare kind has few of the quantiles of all rows.
    found = rows.groupBy("bad").agg(*[F.percentile_approx(n, shares, 10_000).alias(n) for n in names]).collect()
    if len(found) < 2:
        return []
    cuts = {n: sorted({c for row in found for c in row[n]}) for n in names}
    place = [F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts[n]]), _below(n))) for n in names]
    binned = stored(rows.select("bad", "fold", F.array(*place).alias("bins")), "quality-binned")

    def inside(conditions: Rule) -> Column:
        at = lambda c: F.get("bins", F.lit(names.index(c.feature)))
        return _all([at(c) > c.cut if c.above else at(c) <= c.cut for c in conditions])

    def counts(where: Column) -> dict[tuple[int, int], tuple[int, int]]:
        seen = binned.filter(where).select("bad", F.posexplode("bins").alias("f", "b")).groupBy("f", "b")
        return {(r["f"], r["b"]): (r["p"], r["n"]) for r in seen.agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()}

    rules: list[Rule] = []
    grow, prune = F.col("fold") != 0, F.col("fold") == 0
    while len(rules) < max_rules:
        left = _all([~inside(r) for r in rules])
        rule: Rule = []
        while len(rule) < max_conditions:
            best = _best(counts(grow & left & inside(rule)), names, cuts, min_support)
            if best is None:
                break
            rule.append(best)
        if not rule:
            break
        sums = [s for i in range(len(rule)) for s in (F.count_if(inside(rule[: i + 1]) & F.col("bad")), F.count_if(inside(rule[: i + 1]) & ~F.col("bad")))]
        got = binned.filter(prune & left).agg(*[s.alias(f"c{i}") for i, s in enumerate(sums)]).first()
        scores = [((p - n) / (p + n) if p + n else -1.0, p) for p, n in zip(got[::2], got[1::2])]
        length = max(range(len(rule)), key=lambda i: (scores[i][0], -i))
        if scores[length][0] < 2 * precision - 1 or scores[length][1] < min_support:
            break
        rules.append(rule[: length + 1])
    return rules


def _best(seen: dict[tuple[int, int], tuple[int, int]], names: list[str], cuts: dict[str, list[float]], min_support: int) -> Condition | None:
    """The condition with the highest information gain over the rows counted, if there is any gain."""
    best, gain = None, 1e-9
    for f, name in enumerate(names):
        table = [seen.get((f, b), (0, 0)) for b in range(len(cuts[name]) + 1)]
        p0, n0 = sum(p for p, _ in table), sum(n for _, n in table)
        if not p0 or not n0:
            return None
        p = n = 0
        for cut, threshold in enumerate(cuts[name]):
            p, n = p + table[cut][0], n + table[cut][1]
            for above, (x, y) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                if x >= min_support:
                    g = x * (math.log2(x / (x + y)) - math.log2(p0 / (p0 + n0)))
                    if g > gain:
                        best, gain = Condition(name, above, threshold, cut), g
    return best


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The ordered conditional expression: false under the first rule that holds, else true."""
    values, out = features(stats), None
    for rule in rules:
        test = _all([c.on(values) for c in rule])
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(docs[key].alias("doc_id"), statistics(docs[text].cast("string")).alias("stats"))


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept."""
    stats = stored(with_statistics(docs, key, text), "quality-statistics")
    rules, s = learn(stats, labels, key, **options), F.col("stats")
    return stats.select("doc_id", *[s[c].alias(c) for c in BASE], base_failed(s).alias("base_failed"), (~base_failed(s) & verdict(rules, s)).alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs`, with all their columns, that pass the base rules and the learned list. No shuffle of the texts."""
    stats = stored(with_statistics(docs, key, text), "quality-statistics")
    rules = learn(stats, labels, key, **options)
    passes = bound(statistics(docs[text].cast("string")), lambda s: ~base_failed(s) & verdict(rules, s))
    return docs.filter(passes)
