"""Learned decision lists over statistics of texts, by sequential covering.

Rules that recognise documents to reject are learned one after another. A rule is grown by adding the threshold
condition of the largest information gain on two thirds of the labelled rows, then pruned to the prefix that separates
best on the last third. Each step is one Spark aggregation over all labelled rows: counts of both labels by statistic
and bin. The list is emitted as an ordered conditional expression; everything runs as DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.llm.shared import materialize
from buzzmill.llm.textstats import BASE, RATIOS, labelled, with_stats

BINS = 32


@dataclass(frozen=True)
class Condition:
    """statistic > cut, or <= cut; place is the cut's number among the statistic's cuts."""

    statistic: str
    above: bool
    cut: float
    place: int

    def holds(self) -> Column:
        return F.col(self.statistic) > self.cut if self.above else F.col(self.statistic) <= self.cut

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass
class DecisionList:
    """Ordered conjunctions; a document that one holds for is rejected."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rejects(self) -> Column:
        verdict = F
        for rule in self.rules:
            verdict = verdict.when(all_of(rule), F.lit(True))
        return F.lit(False) if verdict is F else verdict.otherwise(F.lit(False))

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, r))}" for r in self.rules) + "\nelse keep"


def all_of(rule: Sequence[Condition]) -> Column:
    return reduce(lambda a, b: a & b, (c.holds() for c in rule), F.lit(True))


def _bin(statistic: str, cuts: Sequence[float]) -> Column:
    """Number of cuts below the statistic."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(statistic)))


def _counts(rows: DataFrame, statistics: Sequence[str]) -> dict[str, dict[int, tuple[int, int]]]:
    """For each statistic and bin: rows to reject and rows to keep. A bounded result: statistics times bins."""
    pairs = rows.select("label", F.posexplode(F.array(*[f"bin_{s}" for s in statistics])).alias("s", "bin"))
    out: dict[str, dict[int, tuple[int, int]]] = {s: {} for s in statistics}
    for r in pairs.groupBy("s", "bin").agg(F.count_if(F.col("label") == 0).alias("bad"), F.count_if(F.col("label") == 1).alias("good")).collect():
        out[statistics[r["s"]]][r["bin"]] = (r["bad"], r["good"])
    return out


def _best(counts: dict, cuts: dict[str, list[float]], bad: int, good: int, least: int) -> tuple[Condition, int, int] | None:
    best, most = None, 1e-9
    start = log2(bad / (bad + good))
    for s, bins in counts.items():
        low_bad = low_good = 0
        for place, cut in enumerate(cuts[s]):
            b, g = bins.get(place, (0, 0))
            low_bad, low_good = low_bad + b, low_good + g
            for above, p, n in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                if p >= least and (gain := p * (log2(p / (p + n)) - start)) > most:
                    best, most = (Condition(s, above, cut, place), p, n), gain
    return best


def learn(rows: DataFrame, statistics: Sequence[str] = RATIOS, max_rules: int = 10, max_conditions: int = 4, least_rows: int = 5, least_precision: float = 0.9) -> DecisionList:
    """A list learned from rows with doc_id, label (0: reject, 1: keep) and the statistics; no rows give an empty list.

    Rows are dealt to growing and pruning by a hash of doc_id. A rule needs least_rows rows to reject, and
    least_precision on the rows that prune; otherwise learning stops.
    """
    wanted = [i / BINS for i in range(1, BINS)]
    quantiles = rows.agg(*[F.percentile_approx(s, F.array(*map(F.lit, wanted)), F.lit(10_000)).alias(s) for s in statistics]).first()
    if quantiles[0] is None:
        return DecisionList()
    cuts = {s: sorted(set(quantiles[s])) for s in statistics}
    binned = rows.select("doc_id", "label", *statistics, *[_bin(s, cuts[s]).alias(f"bin_{s}") for s in statistics])
    binned = materialize(binned.withColumn("prunes", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(3)) == 0), "rule-rows")
    learned = DecisionList()
    while len(learned.rules) < max_rules:
        left = binned.where(~learned.rejects())
        growing, rule = left.where(~F.col("prunes")), []
        while len(rule) < max_conditions:
            counts = _counts(growing.where(all_of(rule)), statistics)
            bad, good = (sum(c[k] for c in counts[statistics[0]].values()) for k in (0, 1))
            if not bad or (rule and not good) or (found := _best(counts, cuts, bad, good, least_rows)) is None:
                break
            rule.append(found[0])
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        sums = [f(all_of(p) & (F.col("label") == v)) for p in prefixes for f, v in ((F.count_if, 0), (F.count_if, 1))]
        tested = left.where("prunes").agg(*[c.alias(f"c{k}") for k, c in enumerate(sums)]).first()
        scores = [((tested[2 * k] - tested[2 * k + 1]) / max(1, tested[2 * k] + tested[2 * k + 1]), -k) for k in range(len(prefixes))]
        k = -max(scores)[1]
        if tested[2 * k] < least_precision * (tested[2 * k] + tested[2 * k + 1]) or not tested[2 * k]:
            break
        learned.rules.append(prefixes[k])
    return learned


def judge(docs: DataFrame, labels: DataFrame, **how) -> tuple[DataFrame, DecisionList]:
    """One row for each row of docs: doc_id, BASE, base_failed, kept and RATIOS; and the list that was learned.

    base_failed: fewer than 20 words, or more than 30 of 100 words repeated; such rows are never kept and the list is
    learned without them. Null texts count as empty, so they fail. Labels come from `labels` (quality); documents
    without a label, id or with labels that disagree teach nothing; without labels all that pass the base are kept.
    Repeated ids are judged row by row. Extra columns of either table are ignored.
    """
    stats = materialize(with_stats(docs.selectExpr("cast(doc_id as long) as doc_id", "text")), "text-stats")
    stats = stats.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    learned = learn(stats.where(~F.col("base_failed")).join(labelled(labels), "doc_id"), **how)
    return stats.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & ~learned.rejects()).alias("kept"), *RATIOS), learned
