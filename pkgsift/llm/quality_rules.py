"""Quality rules as a learned decision list (operator 2), native expressions only.

``statistics`` turns a text into numbers with built-in functions.  ``learn``
covers the low-quality rows of a labelled sample one rule after another: a rule
grows by the threshold condition of greatest information gain on two thirds of
the rows, is pruned back on the rest, and its rows are taken out.  Every step is
one Spark aggregate that counts good and bad rows per statistic and bin.  The
list becomes one ordered CASE expression, so applying it is a projection of the
scan: no join, no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pkgsift.llm.common import let, table

#: Labelled rows that learning reads at most.
MAX_SAMPLE = 20_000
#: Thresholds tried per statistic, conditions per rule, rules per list.
BINS, MAX_CONDITIONS, MAX_RULES = 32, 3, 12
#: A rule must reject this share of bad rows among all it rejects, and cover so many bad rows.
MIN_PRECISION, MIN_COVER = 0.97, 5

_SPACE = r"[\x20\x09-\x0D]+"


def _repeated(words: Column) -> Column:
    """Words that stand in a window of three words found twice or more in the text.

    Windows are compared by 64-bit hashes: two different ones of a text of n words
    are taken for equal with a probability of about n^2 / 2^65."""
    windows = F.when(F.size(words) >= 3, F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                                                    lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))

    def count(w: Column) -> Column:
        ordered = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.transform(s, lambda e, k: F.when(
                F.coalesce(e["h"] == F.get(s, k - 1)["h"], F.lit(False)) | F.coalesce(e["h"] == F.get(s, k + 1)["h"], F.lit(False)), e["i"]))
            return F.filter(twice, lambda i: i.isNotNull())

        places = let(ordered, starts)
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))))

    none = F.lit(0)
    return let(windows, lambda w: F.when(w.isNull(), none).when(F.size(F.array_distinct(w)) == F.size(w), none).otherwise(count(w)))


#: Statistics that rules may test, from the counts below.
RATIOS = {
    "n_words": lambda c: c("n_words").cast("double"),
    "word_length": lambda c: c("word_chars") / F.greatest(c("n_words"), F.lit(1)),
    "symbols_per_word": lambda c: c("n_symbols") / F.greatest(c("n_words"), F.lit(1)),
    "dup_line_share": lambda c: c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)),
    "repeated_share": lambda c: c("n_repeat_words") / F.greatest(c("n_words"), F.lit(1)),
    "distinct_share": lambda c: c("n_distinct") / F.greatest(c("n_words"), F.lit(1)),
    "adjacent_share": lambda c: c("n_adjacent") / F.greatest(c("n_words"), F.lit(1)),
    "upper_per_char": lambda c: c("n_upper") / F.greatest(c("word_chars"), F.lit(1)),
    "digits_per_char": lambda c: c("n_digits") / F.greatest(c("word_chars"), F.lit(1)),
    "marks_per_word": lambda c: c("n_marks") / F.greatest(c("n_words"), F.lit(1)),
    "words_per_line": lambda c: c("n_words") / F.greatest(c("n_lines"), F.lit(1)),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(text: Column) -> Column:
    """A struct of counts (long) of a text; a null or empty text has zeros.

    One expression in which every part is bound once, wherever it ends up in a
    plan.  Texts of any length are read whole.
    """
    def counts(t: Column) -> Column:
        words = F.array_remove(F.split(t, _SPACE), "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

        def of(w: Column) -> Column:
            return let(lines, lambda ls: F.struct(
                F.size(w).cast("long").alias("n_words"),
                (F.length(t) - F.length(F.regexp_replace(t, r"[^\x20\x09-\x0D]+", ""))).cast("long").alias("word_chars"),
                F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                _repeated(w).cast("long").alias("n_repeat_words"),
                F.size(ls).cast("long").alias("n_lines"),
                F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
                F.regexp_count(t, F.lit(r"[A-Z]")).cast("long").alias("n_upper"),
                F.regexp_count(t, F.lit(r"[0-9]")).cast("long").alias("n_digits"),
                F.regexp_count(t, F.lit(r"[!?]")).cast("long").alias("n_marks"),
                F.size(F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False)))).cast("long").alias("n_adjacent")))

        return let(words, of)

    return let(F.coalesce(text, F.lit("")), counts)


def base_failed(stats: Column) -> Column:
    n, r = stats["n_words"], stats["n_repeat_words"]
    return (n < 50) | (100 * r > 50 * n)


def _ratio(name: str, stats: Column) -> Column:
    return RATIOS[name](lambda c: stats[c])


@dataclass(frozen=True)
class Condition:
    """statistic >= threshold, or below it."""

    name: str
    above: bool
    threshold: float

    def column(self, stats: Column) -> Column:
        value = _ratio(self.name, stats)
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects, with what it met when it was learned."""

    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column(stats)
        return out

    def __str__(self) -> str:
        return f"reject if {' and '.join(map(str, self.conditions))}  [{self.bad} bad, {self.good} good]"


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The ordered CASE expression: false at the first rule that holds, else true."""
    out = None
    for r in rules:
        out = F.when(r.column(stats), False) if out is None else out.when(r.column(stats), False)
    return F.lit(True) if out is None else out.otherwise(True)


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    """Information gain of narrowing (p0 bad, n0 good) to (p, n), times the bad kept."""
    if not p:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _counts(rows: DataFrame, names: list[str]) -> dict[str, list[tuple[int, int, int]]]:
    """Per statistic: (bin, bad rows, good rows), bins ascending; one aggregate."""
    out: dict[str, list] = {n: [] for n in names}
    got = (rows.select("bad", F.posexplode("bins").alias("k", "b")).groupBy("k", "b")
           .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect())  # at most len(names) * (BINS + 1) rows
    for r in sorted(got, key=lambda r: (r["k"], r["b"])):
        out[names[r["k"]]].append((r["b"], int(r["p"]), int(r["n"])))
    return out


def _best(counts: dict[str, list[tuple[int, int, int]]], limits: dict[str, list[float]]) -> tuple[float, Condition, int, int] | None:
    best = None
    for name in sorted(counts):
        rows = counts[name]
        p0, n0 = sum(r[1] for r in rows), sum(r[2] for r in rows)
        p = n = 0
        for b, dp, dn in rows:
            if b > 0 and (p or n):  # threshold limits[b - 1] parts the bins below b from the others
                for above, pp, nn in ((True, p0 - p, n0 - n), (False, p, n)):
                    if pp >= MIN_COVER:
                        found = (_gain(p0, n0, pp, nn), Condition(name, above, limits[name][b - 1]), pp, nn)
                        if best is None or found[0] > best[0] + 1e-9:
                            best = found
            p, n = p + dp, n + dn
    return best


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_sample: int = MAX_SAMPLE) -> list[Rule]:
    """A decision list that rejects what looks like the rows labelled 0.

    Learns from at most ``max_sample`` labelled rows, those of least id hash; the
    base filter's rejects are left out.  Labels other than 0 and 1, and ids
    without a text, are not learned from.  Without rows of both labels the list
    is empty and keeps everything.
    """
    known = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
             .groupBy("_id").agg(F.min("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(max_sample))
    # the sample's narrow rows are bounded, so they can be broadcast to the scan
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id")
    names = sorted(RATIOS)
    # written before any filter: a filter on the statistics would move below the
    # join and compute them for every document
    stats = table(texts.select("_id", "_y", statistics(F.col("_text")).alias("_stats")), "sample")
    sample = (stats.where(~base_failed(F.col("_stats")))
              .select((1 - F.col("_y")).cast("long").alias("bad"), F.pmod(F.xxhash64("_id"), F.lit(3)).alias("fold"),
                      *(_ratio(n, F.col("_stats")).alias(n) for n in names)))
    cuts = [k / BINS for k in range(1, BINS)]
    found = sample.agg(*(F.percentile(n, cuts).alias(n) for n in names), *(F.percentile(F.when(F.col("bad") == 1, F.col(n)), cuts).alias(f"bad_{n}") for n in names)).first()
    if found[names[0]] is None:
        return []
    limits = {n: sorted({float(x) for x in found[n] + (found[f"bad_{n}"] or [])}) for n in names}

    def binned(n: str) -> Column:  # how many limits are at or below the value
        return F.size(F.filter(F.array([F.lit(x) for x in limits[n]]), lambda x: x <= F.col(n)))

    binned_rows = table(sample.select("bad", "fold", F.array([binned(n) for n in names]).alias("bins")), "bins")

    def test(c: Condition) -> Column:
        at = F.element_at("bins", names.index(c.name) + 1)
        place = limits[c.name].index(c.threshold) + 1
        return at >= place if c.above else at < place

    def keep(rows: DataFrame, conditions) -> DataFrame:
        for c in conditions:
            rows = rows.where(test(c))
        return rows

    rules: list[Rule] = []
    left = binned_rows
    while len(rules) < MAX_RULES:
        grow, conditions = left.where("fold > 0"), []
        while len(conditions) < MAX_CONDITIONS:
            best = _best(_counts(keep(grow, conditions), names), limits)
            if best is None or best[0] <= 0:
                break
            conditions.append(best[1])
            if best[3] == 0:
                break
        if not conditions:
            break
        # prune: the prefix of conditions of best (bad - good) / (bad + good) on the other rows, shorter first
        def met(rows: DataFrame, upto: int) -> list[Column]:
            hold = F.lit(True)
            for c in conditions[:upto]:
                hold = hold & test(c)
            return [F.sum(F.when(hold, F.col("bad"))).alias(f"p{upto}"), F.sum(F.when(hold, 1 - F.col("bad"))).alias(f"n{upto}")]

        pruned = left.where("fold = 0").agg(*(c for k in range(1, len(conditions) + 1) for c in met(left, k))).first()
        worth = []
        for k in range(1, len(conditions) + 1):
            p, n = pruned[f"p{k}"] or 0, pruned[f"n{k}"] or 0
            worth.append(((p - n) / (p + n) if p + n else -1.0, -k))
        upto = -max(worth)[1]
        whole = left.agg(*met(left, upto)).first()
        bad, good = whole[f"p{upto}"] or 0, whole[f"n{upto}"] or 0
        if bad < MIN_COVER or bad / (bad + good) < MIN_PRECISION:
            break
        rules.append(Rule(tuple(conditions[:upto]), bad, good))
        hold = F.lit(True)
        for c in conditions[:upto]:
            hold = hold & test(c)
        left = left.where(~hold)
    return rules


def apply_rules(docs: DataFrame, rules: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept: one row per input row, repeated rows included.

    A null or empty text has zero counts and fails the base filter.  Other
    columns are ignored; an empty table gives no rows.
    """
    def report(c: Column) -> Column:
        return F.struct(*(c[n].alias(n) for n in COUNTS), base_failed(c).alias("base_failed"), (~base_failed(c) & verdict(rules, c)).alias("kept"))

    rows = docs.select(F.col(id_col).alias("doc_id"), let(statistics(F.col(text_col)), report).alias("_r"))
    return rows.select("doc_id", *(F.col(f"_r.{c}").alias(c) for c in (*COUNTS, "base_failed", "kept")))


def keep_good(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the base filter and the list keep."""
    return docs.where(let(statistics(F.col(text_col)), lambda c: ~base_failed(c) & verdict(rules, c)))
