"""Quality rules: a learned decision list, all in DataFrame functions.

The features of a text are built-in expressions over its words and lines. The
learner sees only statistics: each feature is cut into bins at quantiles of
the labelled rows, and each step of sequential covering is one aggregate that
counts good and bad rows by feature and bin among the rows a rule still
covers. A rule grows on two thirds of the labelled rows by the condition of
the largest gain, is pruned from its end on the other third, and is kept if it
is right there often enough; what it covers is set aside for the next rule.
The list becomes one ordered conditional expression. The driver sees only bin
counts, whose number is fixed.

Edge cases: null and empty texts have no words and fail the base rules; a
document labelled several times counts with its lowest label, null labels are
ignored; repeated rows are judged alike; without labels the list is empty and
keeps all that passes the base rules; an empty table gives an empty result. A very
long text is one row like others. Of conditions of equal gain the first in the order of
features and cuts is taken; every rule says the same verdict, so rules that overlap never
contradict each other. Only doc_id and text (and labels' doc_id, quality) are read, so
extra columns never clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD, materialize, prepare

SYMBOLS = "#*$%&|<>"
BINS = 16
MAX_RULES = 8
MAX_CONDITIONS = 3
MIN_PRECISION = 0.7
MIN_COVERED = 5
FEATURES = ["symbols", "marks", "upper", "digits", "dup_lines", "repeats", "word_length", "words",
            "line_words", "distinct"]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > cut, or feature <= cut
    cut: float

    def column(self) -> Column:
        f = F.col(f"f_{self.feature}")
        return f > F.lit(self.cut) if self.above else f <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def features(docs: DataFrame) -> DataFrame:
    """Rows doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and f_* features."""
    t = F.coalesce("text", F.lit(""))
    d = docs.select("doc_id", t.alias("t")).select(
        "doc_id", "t", F.regexp_extract_all("t", F.lit(f"({WORD})"), F.lit(0)).alias("w"),
        F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD)).alias("lines"))
    # three-word windows by a hash of their words; sorted with their places only if one repeats
    d = d.withColumn("g", F.when(F.size("w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("w") - 3),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))))
    n, chars = F.size("w").cast("long"), F.length("t").cast("long")
    d = d.select(
        "doc_id", n.alias("n_words"),
        _without(F.col("t"), " \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
        (chars - _without(F.col("t"), SYMBOLS)).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").alias("n_lines"), F.size(F.array_distinct("w")).alias("n_distinct"),
        (chars - _without(F.col("t"), "!?")).alias("n_marks"),
        (chars - _without(F.col("t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("n_upper"),
        (chars - _without(F.col("t"), "0123456789")).alias("n_digits"),
        F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array(F.transform(
            "g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("s"))

    def same(i: Column) -> Column:
        return F.get("s", i)["h"] == F.get("s", i + 1)["h"]

    places = F.filter(F.transform("s", lambda x, i: F.when(
        F.coalesce(same(i), F.lit(False)) | ((i > 0) & F.coalesce(same(i - 1), F.lit(False))),
        x["i"])), lambda p: p.isNotNull())
    d = d.withColumn("p", places)
    covered = F.array_union(F.array_union("p", F.transform("p", lambda i: i + 1)),
                            F.transform("p", lambda i: i + 2))
    d = d.withColumn("n_repeat_words", F.coalesce(F.size(covered), F.lit(0)).cast("long")) \
        .withColumn("n_repeat_words", F.greatest(F.lit(0), "n_repeat_words")).drop("s", "p")
    per_word = {"symbols": "n_symbols", "marks": "n_marks", "repeats": "n_repeat_words",
                "word_length": "word_chars", "distinct": "n_distinct"}
    one = F.greatest(F.lit(1), "n_words")
    letters = F.greatest(F.lit(1), "word_chars")
    f = {k: F.col(v) / one for k, v in per_word.items()}
    f |= {"upper": F.col("n_upper") / letters, "digits": F.col("n_digits") / letters,
          "dup_lines": F.col("n_dup_lines") / F.greatest(F.lit(1), "n_lines"),
          "words": F.col("n_words"), "line_words": F.col("n_words") / F.greatest(F.lit(1), "n_lines")}
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", *[f[k].cast("double").alias(f"f_{k}") for k in FEATURES])


def _foil(p: float, n: float, p0: float, n0: float) -> float:
    """Gain in bits of narrowing (p0, n0) to (p, n)."""
    if p <= 0 or p0 <= 0:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn(labelled: DataFrame, max_rules: int = MAX_RULES, bins: int = BINS,
          min_precision: float = MIN_PRECISION) -> list[list[Condition]]:
    """Rules for bad rows from ``labelled`` (f_* features, bad 0/1, grow boolean), in order."""
    shares = [i / bins for i in range(1, bins)]
    cols = [f"f_{k}" for k in FEATURES]
    cuts_row = labelled.agg(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in cols]).first()
    if cuts_row is None or cuts_row[0] is None:
        return []
    cuts = {k: sorted(set(cuts_row[f"f_{k}"])) for k in FEATURES}

    def counts(rows: DataFrame) -> dict[str, list[tuple[int, int]]]:
        """Bad and good rows per feature and bin; bin b lies above b of the cuts."""
        above = F.array(*[F.struct(
            F.lit(j).alias("f"),
            sum((F.col(f"f_{k}") > F.lit(c)).cast("int") for c in cuts[k]).alias("b"))
            for j, k in enumerate(FEATURES)])
        got = rows.select("bad", F.explode(above).alias("x")).groupBy("x.f", "x.b") \
            .agg(F.sum("bad"), F.sum(1 - F.col("bad"))).collect()
        out = {k: [(0, 0)] * (len(cuts[k]) + 1) for k in FEATURES}
        for f, b, p, n in got:
            out[FEATURES[f]][b] = (p, n)
        return out

    def total(rows: DataFrame, conditions: list[Column]) -> list[tuple[int, int]]:
        got = rows.agg(*[x for c in conditions for x in (
            F.sum(F.when(c, F.col("bad")).otherwise(0)),
            F.sum(F.when(c, 1 - F.col("bad")).otherwise(0)))]).first()
        return [(got[2 * i] or 0, got[2 * i + 1] or 0) for i in range(len(conditions))]

    rules: list[list[Condition]] = []
    free = labelled
    for _ in range(max_rules):
        grow, rule, part = free.where("grow"), [], free.where("grow")
        p0 = n0 = None
        for _ in range(MAX_CONDITIONS):
            by_bin = counts(part)
            if p0 is None:
                first = by_bin[FEATURES[0]]
                p0, n0 = (sum(x[0] for x in first), sum(x[1] for x in first))
            if p0 < MIN_COVERED or n0 == 0:
                break
            best = (0.0, None, 0, 0)
            for k in FEATURES:
                low_p = low_n = 0
                for b, cut in enumerate(cuts[k]):
                    low_p, low_n = low_p + by_bin[k][b][0], low_n + by_bin[k][b][1]
                    for above, p, n in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
                        if p >= MIN_COVERED and (g := _foil(p, n, p0, n0)) > best[0] + 1e-9:
                            best = (g, Condition(k, above, float(cut)), p, n)
            if best[1] is None:
                break
            rule.append(best[1])
            part, p0, n0 = part.where(best[1].column()), best[2], best[3]
        if not rule:
            break
        prefixes = []
        for i in range(len(rule)):
            c = rule[0].column()
            for x in rule[1:i + 1]:
                c = c & x.column()
            prefixes.append(c)
        held = total(free.where(~F.col("grow")), prefixes)
        worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in held]
        i = max(range(len(rule)), key=lambda k: (worth[k], -k))
        p, n = held[i]
        if p + n == 0 or p / (p + n) < min_precision:
            break
        rules.append(rule[:i + 1])
        free = free.where(~prefixes[i])
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The decision list as one ordered conditional: false at the first rule that holds."""
    out = None
    for rule in rules:
        c = rule[0].column()
        for x in rule[1:]:
            c = c & x.column()
        out = F.when(c, F.lit(False)) if out is None else out.when(c, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[list[Condition]]]:
    """The base columns with base_failed and kept per document, and the rules."""
    prepare(docs.sparkSession)
    f = materialize(features(docs), "quality-features")
    y = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy(F.col("doc_id").alias("id")).agg((1 - F.min("quality")).alias("bad"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    labelled = materialize(
        f.where(~base_failed).join(y, F.col("doc_id") == F.col("id")).select(
            "bad", *[f"f_{k}" for k in FEATURES],
            (F.pmod(F.xxhash64("doc_id"), F.lit(3)) > 0).alias("grow")), "quality-labelled")
    rules = learn(labelled)
    out = f.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                   base_failed.alias("base_failed"), (~base_failed & verdict(rules)).alias("kept"))
    return out, rules
