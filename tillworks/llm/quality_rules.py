"""Quality rules: word and line statistics, and decision lists learned from labelled documents.

Sequential covering: grow a conjunction of threshold conditions that singles out rejected documents on one part of the labelled
rows, cut it back to the prefix that does best on the other part, remove what it covers, and go on until no rule is precise enough.
The list becomes one ordered conditional expression. DataFrame functions only; the driver sees counts per (statistic, threshold).

Cases: a null text has no words; every statistic of a text without words is 0; without labels, or with labels of one class, the list
is empty and keeps all; repeated labels of a document count once each way; repeated rows are judged alike; a null id has no label.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.llm.names import free_prefix
from tillworks.session import cut_lineage

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
RUN = 8
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Statistics that rules may test, all per word or per line so that they do not depend on the length of a text.
RATIOS = {
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def with_statistics(docs: DataFrame, text: str, name: str) -> DataFrame:
    """Add struct ``name``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_distinct (long).

    All within the row. An array that several expressions use is a column first, so that it is worked out once. Windows are only
    sorted in texts that have fewer distinct windows than windows.
    """
    p = free_prefix(docs)
    keep = [F.col(f"`{c}`") for c in docs.columns]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    trimmed = F.btrim(whole, F.lit(SPACE))
    one = docs.select(*keep, trimmed.alias(f"{p}t"))
    empty = F.array().cast("array<string>")
    two = one.select(
        *keep, f"{p}t",
        F.when(F.col(f"{p}t") == "", empty).otherwise(F.split(F.col(f"{p}t"), SPACES)).alias(f"{p}w"),
        F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias(f"{p}l"))
    windows = F.when(F.size(f"{p}w") >= RUN, F.transform(
        F.sequence(F.lit(1), F.size(f"{p}w") - (RUN - 1)), lambda i: F.xxhash64(F.slice(F.col(f"{p}w"), i, RUN))))
    three = two.select(
        *keep, F.size(f"{p}w").cast("long").alias(f"{p}n"), F.length(F.array_join(f"{p}w", "")).cast("long").alias(f"{p}c"),
        (F.length(f"{p}t") - F.length(F.regexp_replace(f"{p}t", SYMBOLS, ""))).cast("long").alias(f"{p}y"),
        F.size(f"{p}l").cast("long").alias(f"{p}ln"), F.size(F.array_distinct(f"{p}l")).cast("long").alias(f"{p}ld"),
        F.size(F.array_distinct(f"{p}w")).cast("long").alias(f"{p}d"), windows.alias(f"{p}h"))
    four = three.select(
        "*", F.when(F.size(F.array_distinct(f"{p}h")) < F.size(f"{p}h"), F.sort_array(F.transform(
            f"{p}h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias(f"{p}s"))

    def twice(x: Column, i: Column) -> Column:
        return x["h"].eqNullSafe(F.get(F.col(f"{p}s"), i - 1)["h"]) | x["h"].eqNullSafe(F.get(F.col(f"{p}s"), i + 1)["h"])

    again = F.array_sort(F.transform(F.filter(f"{p}s", twice), lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    repeated = F.aggregate(again, start, lambda a, i: F.struct(
        (a["n"] + RUN - F.greatest(F.lit(0), a["end"] - i)).alias("n"), (i + RUN).alias("end")))["n"]
    return four.select(*keep, F.struct(
        F.col(f"{p}n").alias("n_words"), F.col(f"{p}c").alias("word_chars"), F.col(f"{p}y").alias("n_symbols"),
        (F.col(f"{p}ln") - F.col(f"{p}ld")).alias("n_dup_lines"), F.coalesce(repeated, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.col(f"{p}ln").alias("n_lines"), F.col(f"{p}d").alias("n_distinct")).alias(name))


def base_failed(stats: str) -> Column:
    """Fewer than 20 words, or over 30 % of them in repeated windows."""
    s = F.col(stats)
    return (s["n_words"] < 20) | (s["n_repeat_words"] * 100 > s["n_words"] * 30)


def ratios(stats: str) -> dict[str, Column]:
    """Each statistic as a column over the struct ``stats``."""
    out = {}
    for name, formula in RATIOS.items():
        top, bottom = formula.split(" / greatest(")
        out[name] = F.col(stats)[top] / F.greatest(F.col(stats)[bottom.split(",")[0]], F.lit(1))
    return out


@dataclass(frozen=True)
class Condition:
    statistic: str
    at_least: bool
    threshold: float

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<'} {self.threshold:g}"

    def column(self, values: dict[str, Column]) -> Column:
        value = values[self.statistic]
        return value >= self.threshold if self.at_least else value < self.threshold


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a row that no rule covers is kept."""

    rules: tuple[tuple[Condition, ...], ...]

    def verdict(self, values: dict[str, Column]) -> Column:
        """True: kept. ``CASE WHEN rule 1 THEN false WHEN rule 2 THEN false ... ELSE true END``."""
        out = None
        for rule in self.rules:
            test = F.lit(True)
            for condition in rule:
                test = test & condition.column(values)
            out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, rule))}" for rule in self.rules) or "keep all"


def _thresholds(labelled: DataFrame, names: Sequence[str], label: str, bins: int) -> dict[str, list[float]]:
    """Quantiles of each class, so that a rare class has thresholds of its own."""
    marks = [i / bins for i in range(1, bins)]
    rows = labelled.groupBy(label).agg(*[F.percentile_approx(n, marks, 1000).alias(n) for n in names]).collect()
    return {n: sorted({v for r in rows for v in (r[n] or []) if v is not None and math.isfinite(v)}) for n in names}


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    """How much more certain the p1 rejected rows still covered are than before."""
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else -1.0


def learn_decision_list(labelled: DataFrame, names: Sequence[str], label: str = "label", split: str = "prune", bins: int = 32,
                        max_rules: int = 12, max_conditions: int = 3, min_precision: float = 0.9, min_rows: int = 5) -> DecisionList:
    """Learn rules for label 0 from double columns ``names``; boolean ``split`` marks the rows that prune.

    Values become the number of thresholds they reach, and equal rows are folded into counts once. A condition is found by one sum per
    (statistic, bin) over these counts, which is all that leaves Spark, whatever the number of rows.
    """
    edges = _thresholds(labelled, names, label, bins)
    names = [n for n in names if edges[n]]
    if not names:
        return DecisionList(())

    def reached(name: str) -> Column:
        return F.size(F.filter(F.array(*[F.lit(t) for t in edges[name]]), lambda t: t <= F.col(name))).alias(name)

    cells = cut_lineage(labelled.select(split, label, *[reached(n) for n in names]).groupBy(split, *names)
                        .agg(F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("_p"), F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_n")))

    def test(condition: tuple[str, bool, int]) -> Column:
        name, at_least, i = condition
        return F.col(name) > i if at_least else F.col(name) <= i

    def counts(df: DataFrame) -> dict[tuple[bool, str, int], tuple[int, int]]:
        each = F.explode(F.array(*[F.struct(F.lit(n).alias("s"), F.col(n).alias("b")) for n in names])).alias("x")
        rows = df.select(split, "_p", "_n", each).groupBy(split, "x").agg(F.sum("_p").alias("p"), F.sum("_n").alias("n")).collect()
        return {(r[split], r["x"]["s"], r["x"]["b"]): (r["p"], r["n"]) for r in rows}

    def total(found, part: bool, name: str, low: int, high: int) -> tuple[int, int]:
        got = [found.get((part, name, b), (0, 0)) for b in range(low, high + 1)]
        return sum(x[0] for x in got), sum(x[1] for x in got)

    rules, left = [], cells
    while len(rules) < max_rules:
        rule, tried, rest = [], [], left
        found = counts(rest)
        while len(rule) < max_conditions:
            top = len(edges[names[0]])
            p0, n0 = total(found, False, names[0], 0, top)
            if not p0 or rule and not n0:
                break
            best = None
            for name in names:
                top = len(edges[name])
                for i in range(top):
                    for at_least in (True, False):
                        low, high = (i + 1, top) if at_least else (0, i)
                        p1, n1 = total(found, False, name, low, high)
                        gain = _gain(p0, n0, p1, n1)
                        if p1 >= min_rows and gain > 1e-9 and (best is None or gain > best[0]):
                            best = (gain, (name, at_least, i), total(found, True, name, low, high))
            if best is None:
                break
            rule.append(best[1])
            tried.append(best[2])
            rest = rest.where(test(best[1]))
            if len(rule) < max_conditions:
                found = counts(rest)
        if not rule:
            break
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in tried]
        keep = max(range(len(rule)), key=lambda i: (worth[i], -i)) + 1
        p, n = tried[keep - 1]
        if not p or p / (p + n) < min_precision:
            break
        rule = rule[:keep]
        rules.append(tuple(Condition(name, at_least, edges[name][i]) for name, at_least, i in rule))
        covered = test(rule[0])
        for condition in rule[1:]:
            covered = covered & test(condition)
        left = left.where(~covered)
    return DecisionList(tuple(rules))


def learn_quality_rules(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", struct: str = "stats", quality: str = "quality",
                        **options) -> DecisionList:
    """Learn from (id, statistics) rows and their labels. Rows that the base rules reject anyway teach nothing."""
    marks = labels.where(F.col(quality).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(quality).alias("label")).distinct()
    values = ratios(struct)
    rows = (stats.where(~base_failed(struct))
            .select(F.col(doc_id).alias("_id"), *[v.alias(n) for n, v in values.items()]).join(marks, "_id")
            .withColumn("prune", F.crc32(F.concat(F.lit("prune"), F.col("_id").cast("string")).cast("binary")) % 3 == 0))
    return learn_decision_list(rows, list(values), **options)


def judged(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", struct: str = "stats",
           columns: Sequence[str] | None = None) -> tuple[DataFrame, DecisionList]:
    """(``columns`` with the statistics, base_failed and kept; the learned list). The statistics are worked out once and written to the
    shared folder, where learning and judging read them."""
    name = free_prefix(docs) + struct
    rows = cut_lineage(with_statistics(docs, text, name).select(*[F.col(f"`{c}`") for c in columns or [doc_id]], name))
    learned = learn_quality_rules(rows, labels, doc_id, name)
    failed = base_failed(name)
    kept = ~failed & learned.verdict(ratios(name))
    out = rows.select(*[F.col(f"`{c}`") for c in columns or [doc_id]], F.struct(F.col(f"{name}.*"), failed.alias("base_failed"), kept.alias("kept")).alias(name))
    return out, learned


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the base rules and the learned list keep, all columns as they are."""
    rows, _ = judged(docs, labels, doc_id, text, columns=docs.columns)
    return rows.where(F.col(rows.columns[-1])["kept"]).select(*[F.col(f"`{c}`") for c in docs.columns])
