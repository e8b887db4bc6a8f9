"""Quality rules: decision lists learned from labelled text statistics.

Statistics come from DataFrame expressions on whole texts. Rules that reject are learned one after
the other: each grows by the threshold that gains most, is pruned on rows set aside, and takes the
rows it covers out. A learned list is an ordered conditional expression. Rows are counted by Spark,
one small table of counts by feature and bin for each growing step.

Cases: null and empty texts have statistics of 0 (and fail the base rule); labels that are null are
ignored, of several labels of a document the lowest counts; without labels of both kinds the list
is empty and rejects nothing.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import WORD, let, words
from tablestream.session import cut_lineage

WINDOW = 5
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
UPPER = string.ascii_uppercase + "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7)
#: Labelled rows that a list is learned from at most, the first by a hash of their id.
SAMPLE = 50_000
QUANTILES = [k / 16 for k in range(1, 16)]
MOST_RULES, MOST_CONDITIONS = 10, 3
#: Share of rejected rows, among those a rule covers, on the rows set aside.
LEAST_PRECISION = 0.93
LEAST_COVER = 5


def _removed(text: Column, characters: str) -> Column:
    """How many of the characters the text has."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def repeat_words(w: Column) -> Column:
    """Words that lie in runs of five words found at least twice.

    Where all runs of a text differ, as in most, that is all. Else the hashes of its runs are sorted
    with their places; equal neighbours repeat, and each repeated run adds the words up to the next
    one, five at most. All steps are n log n.
    """

    def runs(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
        )

    def repeated(s: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))

        twice = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            none,
            lambda total, x: total + x,
        )

    def counted(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(
            let(placed, lambda s: let(repeated(s), covered))
        )

    none = F.lit(0).cast("long")
    hashed = F.transform(w, lambda x: F.xxhash64(x))
    return F.when(F.size(w) >= WINDOW, let(let(hashed, runs), counted)).otherwise(none)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Whole-text statistics of each row, next to its id."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(WORD))
    parts = F.struct(
        let(
            words(body),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                repeat_words(w).alias("n_repeat_words"),
            ),
        ).alias("w"),
        let(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("l"),
    )
    return docs.select(
        "doc_id",
        parts.alias("p"),
        F.length(F.translate(body, BLANKS, "")).cast("long").alias("word_chars"),
        _removed(body, SYMBOLS).alias("n_symbols"),
        _removed(body, UPPER).alias("n_upper"),
        _removed(body, "!").alias("n_bangs"),
    ).select("doc_id", "p.w.*", "p.l.*", "word_chars", "n_symbols", "n_upper", "n_bangs")


def features() -> dict[str, Column]:
    """What rules compare: statistics and their shares."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / n,
        "symbols": F.col("n_symbols") / n,
        "upper": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "bangs": F.col("n_bangs") / n,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / n,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # value >= threshold, or else value < threshold
    threshold: float

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.above else value < self.threshold


Rule = tuple[Condition, ...]


def applies(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in rule])


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional expression: the first rule that applies, from 1, else 0."""
    if not rules:
        return F.lit(0)
    out = F.when(applies(rules[0]), 1)
    for k, rule in enumerate(rules[1:], 2):
        out = out.when(applies(rule), k)
    return out.otherwise(0)


def _gain(before: tuple[int, int], after: tuple[int, int]) -> float:
    """Information gained on the rejected rows that stay covered."""
    (p0, n0), (p1, n1) = before, after
    if not p1 or not p0:
        return 0.0
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))


def learn(stats: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> list[Rule]:
    """Rules for rows whose label is 0, in the order in which they apply."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg((F.min(label) <= 0).cast("int").alias("bad"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    names = list(features())
    rows = stats.join(chosen, "doc_id").select(
        "*", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0).alias("aside")
    )
    rows = cut_lineage(rows)
    cuts = rows.filter("NOT aside").groupBy("bad").agg(
        *[F.percentile_approx(value, QUANTILES, 10_000).alias(name) for name, value in features().items()]
    )
    found = cuts.collect()
    if len(found) < 2:
        return []
    thresholds = {name: sorted({float(v) for row in found for v in row[name] or ()}) for name in names}

    def place(name: str, value: Column) -> Column:
        """How many thresholds the value reaches."""
        limits = F.array(*[F.lit(t) for t in thresholds[name]])
        return F.size(F.filter(limits, lambda t: t <= value))

    binned = cut_lineage(
        rows.select("*", F.array(*[place(name, value) for name, value in features().items()]).alias("bins"))
    )

    def counts(part: DataFrame) -> dict[str, list[tuple[int, int]]]:
        found = (
            part.select("bad", F.posexplode("bins").alias("f", "bin"))
            .groupBy("f", "bin")
            .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
            .collect()
        )
        out = {name: [(0, 0)] * (len(thresholds[name]) + 1) for name in names}
        for row in found:
            out[names[row["f"]]][row["bin"]] = (row["p"], row["n"])
        return out

    rules: list[Rule] = []
    left = binned
    while len(rules) < MOST_RULES:
        rule: Rule = ()
        part = left.filter("NOT aside")
        for _ in range(MOST_CONDITIONS):
            table = counts(part)
            total = tuple(map(sum, zip(*table[names[0]], strict=True)))
            if not total[0] or not total[1]:
                break
            options = []
            for name, bins in table.items():
                low = (0, 0)
                for k, t in enumerate(thresholds[name]):
                    low = (low[0] + bins[k][0], low[1] + bins[k][1])
                    high = (total[0] - low[0], total[1] - low[1])
                    options.append((_gain(total, high), Condition(name, True, t)))
                    options.append((_gain(total, low), Condition(name, False, t)))
            best, condition = max(options, key=lambda o: o[0])
            if best <= 1e-9 or condition in rule:
                break
            rule += (condition,)
            part = part.filter(condition.column())
        if not rule:
            break
        # Prune: the beginning of the rule that is best on the rows set aside.
        aside = left.filter("aside")
        beginnings = [rule[: k + 1] for k in range(len(rule))]
        sums = [
            F.sum(F.when(applies(r), F.col("bad") if of else 1 - F.col("bad")).otherwise(0))
            for r in beginnings for of in (True, False)
        ]
        values = [v or 0 for v in aside.agg(*sums).first()]
        scored = [
            ((p - n) / (p + n) if p + n else -1.0, p, r)
            for r, p, n in zip(beginnings, values[::2], values[1::2], strict=True)
        ]
        worth, p, rule = max(scored, key=lambda s: (round(s[0], 3), s[1]))
        if (worth + 1) / 2 < LEAST_PRECISION or p < LEAST_COVER:
            break
        rules.append(rule)
        left = left.filter(~applies(rule))
    return rules
