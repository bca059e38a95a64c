"""Learned decision lists: ordered threshold rules that reject low-quality texts.

Rules are learned by sequential covering. On two thirds of the labelled rows a rule grows: of all thresholds of all
statistics, the condition that gains most (in the sense of first-order rule learners) is added, until the rule
covers no good row or gains no more. On the last third it is pruned: its trailing conditions go while that does
not lower its worth. It is kept if it is precise on both parts; rows that it covers are set aside, and the next rule grows on the rest.
The list is a ``CASE`` expression: the number of the first rule that holds, null if none does.

Each step is one aggregation over the labelled rows: per statistic and bin the numbers of good and bad rows. The
driver sees these counts (statistics x bins, a fixed number) and never a row. All labelled rows count. Only
DataFrame and SQL functions run on the executors.

Rows without label, or with a null one, teach nothing; of several labels of one id the lowest counts. Without bad or
without good labelled rows the list is empty and rejects nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.text_stats import COUNTS, RATIOS, with_stats
from affinis.session import cut_lineage

FEATURES = (*COUNTS, *RATIOS)
#: Candidate thresholds per statistic: quantiles of the labelled rows.
BINS = 64


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, stats: str = "stats") -> Column:
        value = F.col(stats)[self.feature].cast("double")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self, stats: str = "stats") -> Column:
        return reduce(lambda a, b: a & b, [c.column(stats) for c in self.conditions])

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def rule_number(rules: list[Rule], stats: str = "stats") -> Column:
    """Number of the first rule that holds, from 1; null if none does."""
    if not rules:
        return F.lit(None).cast("int")
    case = F.when(rules[0].column(stats), F.lit(1))
    for number, rule in enumerate(rules[1:], 2):
        case = case.when(rule.column(stats), F.lit(number))
    return case


def learn_rules(
    labelled: DataFrame, label: str = "quality", key: str = "doc_id", stats: str = "stats", max_rules: int = 12,
    max_conditions: int = 4, min_precision: float = 0.95, min_covered: float = 0.005,
) -> list[Rule]:
    """Rules for label 0 from rows with a label, a key and a ``stats`` struct.

    ``min_covered`` is the share of all bad rows that a rule must newly cover on the growing part.
    """
    rows = labelled.where(F.col(label).isin(0, 1)).select(
        F.col(stats).alias("stats"), (F.col(label) == 0).alias("bad"),
        (F.pmod(F.xxhash64(key), F.lit(3)) < 2).alias("grow"),
    )
    rows = cut_lineage(rows)
    edges = _edges(rows)
    value = lambda f: F.col("stats")[f].cast("double")
    places = [
        F.struct(F.lit(f).alias("feature"), _bin(value(f), edges[f]).alias("bin")) for f in FEATURES if edges[f]
    ]
    if not places:
        return []
    rules: list[Rule] = []
    n_bad = rows.where("grow and bad").count()
    while n_bad and len(rules) < max_rules:
        left = rows.where(~reduce(lambda a, b: a | b, [r.column() for r in rules], F.lit(False)))
        rule = _grown(left.where("grow"), places, edges, max_conditions)
        if rule is None:
            break
        rule = _pruned(rule, left.where("not grow"))
        sides = {
            r["grow"]: (r["bad"] or 0, r["n"])
            for r in left.where(rule.column()).groupBy("grow").agg(
                F.count_if("bad").alias("bad"), F.count("*").alias("n")
            ).collect()
        }
        bad, n = sides.get(True, (0, 0))
        # smoothed, so that a few rows prove little; the pruning part may be empty on small tables
        checked, checked_n = sides.get(False, (0, 0))
        if bad < max(2, min_covered * n_bad) or bad < min_precision * n or checked + bad < min_precision * (checked_n + n):
            break
        rules.append(rule)
    return rules


def _edges(rows: DataFrame) -> dict[str, list[float]]:
    """Ordered candidate thresholds of each statistic, the same number for all sizes."""
    shares = [i / BINS for i in range(1, BINS)]
    wanted = [F.percentile_approx(F.col("stats")[f].cast("double"), shares, 10_000).alias(f) for f in FEATURES]
    bad = [
        F.percentile_approx(F.when(F.col("bad"), F.col("stats")[f].cast("double")), shares, 10_000).alias(f"bad_{f}")
        for f in FEATURES
    ]
    found = rows.agg(*wanted, *bad).first()
    return {f: sorted({*(found[f] or ()), *(found[f"bad_{f}"] or ())}) for f in FEATURES}


def _bin(value: Column, edges: list[float]) -> Column:
    """Number of edges below the value."""
    table = F.array(*[F.lit(float(e)) for e in edges])
    return F.size(F.filter(table, lambda e: e < value))


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    if not bad:
        return 0.0
    return bad * (log2(bad / (bad + good)) - log2(bad_before / (bad_before + good_before)))


def _grown(rows: DataFrame, places: list[Column], edges: dict[str, list[float]], most: int) -> Rule | None:
    conditions: list[Condition] = []
    for _ in range(most):
        inside = rows.where(Rule(tuple(conditions)).column()) if conditions else rows
        counts = inside.select("bad", F.inline(F.array(*places))).groupBy("feature", "bin").agg(
            F.count_if("bad").alias("bad"), F.count("*").alias("n")
        ).collect()
        first = [r for r in counts if r["feature"] == counts[0]["feature"]]
        bad_all, n_all = sum(r["bad"] for r in first), sum(r["n"] for r in first)
        good_all = n_all - bad_all
        if not bad_all or not good_all:
            break
        best, best_gain = None, 1e-9
        for feature, cuts in edges.items():
            own = {r["bin"]: (r["bad"], r["n"] - r["bad"]) for r in counts if r["feature"] == feature}
            bad = good = 0
            for number, cut in enumerate(cuts):
                more_bad, more_good = own.get(number, (0, 0))
                bad, good = bad + more_bad, good + more_good
                for above, b, g in ((False, bad, good), (True, bad_all - bad, good_all - good)):
                    gain = _gain(b, g, bad_all, good_all)
                    if gain > best_gain:
                        best, best_gain = Condition(feature, above, cut), gain
        if best is None:
            break
        # a sharper threshold takes the place of the one before it
        conditions = [c for c in conditions if (c.feature, c.above) != (best.feature, best.above)] + [best]
    return Rule(tuple(conditions)) if conditions else None


def _pruned(rule: Rule, rows: DataFrame) -> Rule:
    """The shortest beginning of the rule of highest worth, (bad - good) / (bad + good), on rows it did not grow on."""
    heads = [Rule(rule.conditions[:k]) for k in range(1, len(rule.conditions) + 1)]
    counts = rows.agg(*[
        c for k, head in enumerate(heads)
        for c in (F.count_if(head.column() & F.col("bad")).alias(f"bad{k}"), F.count_if(head.column()).alias(f"n{k}"))
    ]).first()
    worth = [(2 * counts[f"bad{k}"] - counts[f"n{k}"]) / (counts[f"n{k}"] + 2) for k in range(len(heads))]
    return heads[max(range(len(heads)), key=lambda k: (worth[k], -k))]


def label_stats(labels: DataFrame, with_text_stats: DataFrame, label: str = "quality", key: str = "doc_id") -> DataFrame:
    """Rows of ``with_text_stats`` (key, stats) that have a label."""
    known = labels.where(F.col(label).isNotNull()).groupBy(key).agg(F.min(label).alias(label))
    return with_text_stats.select(key, "stats").join(known, key)


def base_failed(stats: str = "stats") -> Column:
    """Too few words, or too many in repeated windows."""
    s = F.col(stats)
    return (s["n_words"] < 20) | (100 * s["n_repeat_words"] > 30 * s["n_words"])


def kept(rules: list[Rule], stats: str = "stats") -> Column:
    return ~base_failed(stats) & rule_number(rules, stats).isNull()


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without those that fail the base or a rule learned from ``labels``."""
    out = "stats"
    while out in docs.columns:
        out += "_"
    # statistics are computed once: rules are learned from the narrow columns of this table, then it is filtered
    staged = cut_lineage(with_stats(docs, text, out))
    rules = learn_rules(label_stats(labels, staged.select(key, F.col(out).alias("stats")), key=key), key=key, **options)
    return staged.where(kept(rules, out)).drop(out)
