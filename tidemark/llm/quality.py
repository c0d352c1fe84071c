"""Quality rules as a cascade, in SQL functions only.

A rule rejects a text. The cascade tries rules one after the other and stops at the first
that rejects, so cheap rules that reject much should come first. Cost (seconds a row) and
selectivity (share rejected) of each rule are estimated on a sample; rules are then ordered by
rejection per cost. The order changes the work and the rule that is named, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.workspace import Workspace

BLANKS = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
SAMPLE_ROWS = 2000


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Runs of characters that are no blanks; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def lines_of(text: Column) -> Column:
    """Lines with a word."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(lines, lambda line: line.rlike(HAS_WORD))


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words in windows of ``width`` words found twice or more, the first one included.

    Windows are compared by a 64-bit hash. Only texts in which one repeats are sorted.
    """
    starts = F.sequence(F.lit(0), F.size(words) - width)
    windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))

    def placed(hashes: Column) -> Column:
        return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def found(rows: Column) -> Column:
        def again(row: Column, k: Column) -> Column:
            before = F.coalesce(F.get(rows, k - 1)["h"] == row["h"], F.lit(False))
            return before | F.coalesce(F.get(rows, k + 1)["h"] == row["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(rows, again), lambda row: row["i"]))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last"))
        total = F.aggregate(
            at,
            start,
            lambda a, i: F.struct((a["n"] + F.least(F.lit(width), i - a["last"])).alias("n"), i.alias("last")),
        )
        return total["n"]

    def counted(hashes: Column) -> Column:
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, covered(bound(placed(hashes), found))).otherwise(0)

    return F.when(F.size(words) >= width, bound(windows, counted)).otherwise(0).cast("bigint")


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the words and counts that the rules look at. Null texts have none.

    Long columns ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and
    ``n_lines`` (with a word); arrays ``__words`` and ``__lines`` for further rules.
    """
    text = quoted(text_col)
    split = docs.withColumns({"__words": words_of(text), "__lines": lines_of(text)})
    words, lines = F.col("__words"), F.col("__lines")
    long = "bigint"
    return split.withColumns(
        {
            "n_words": F.size(words).cast(long),
            "word_chars": F.length(F.array_join(words, "")).cast(long),
            "n_symbols": F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast(long),
            "n_lines": F.size(lines).cast(long),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast(long),
            "n_repeat_words": repeated_words(words),
        }
    )


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition on a row; null rejects nothing."""

    name: str
    rejects: Column


def standard_rules() -> list[Rule]:
    """Rules on the columns that ``measures`` adds."""
    n_words, n_lines = F.col("n_words"), F.col("n_lines")
    with_letter = F.size(F.filter("__words", lambda w: w.rlike(r"\p{L}")))
    bullets = F.size(F.filter("__lines", lambda line: line.rlike(r"^[\x20\x09-\x0D]*[-*\u2022]")))
    cut_off = F.size(F.filter("__lines", lambda line: line.rlike(r"(\.\.\.|\u2026)[\x20\x09-\x0D]*$")))
    return [
        Rule("short_words", F.col("word_chars") < 2 * n_words),
        Rule("long_words", F.col("word_chars") > 15 * n_words),
        Rule("symbols", F.col("n_symbols") > n_words),
        Rule("duplicate_lines", 100 * F.col("n_dup_lines") > 50 * n_lines),
        Rule("few_letters", 100 * with_letter < 70 * n_words),
        Rule("bullets", 100 * bullets > 90 * n_lines),
        Rule("cut_off_lines", 100 * cut_off > 30 * n_lines),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Estimate:
    """Of one rule on the sample: seconds a row and share of rows rejected."""

    rule: Rule
    cost: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.cost, 1e-9)


def estimate(rows: DataFrame, rules: list[Rule], workspace: Workspace, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Estimate]:
    """Time and count every rule on a stored sample of about ``sample_rows`` rows."""
    total = rows.count()
    share = min(1.0, sample_rows / max(1, total))
    sample = workspace.store(rows.sample(share, seed) if share < 1 else rows, "sample")
    size = max(1, sample.count())

    def timed(condition: Column) -> tuple[float, int]:
        hits = F.coalesce(F.sum(F.coalesce(condition, F.lit(False)).cast("int")), F.lit(0))
        start = time.perf_counter()
        found = sample.agg(hits).first()[0]
        return time.perf_counter() - start, found

    idle = min(timed(F.length(quoted(c)) < 0)[0] for c in sample.columns[:1] * 2)
    out = []
    for rule in rules:
        seconds, found = min(timed(rule.rejects) for _ in range(2))
        out.append(Estimate(rule, max(seconds - idle, 1e-6) / size, found / size))
    return out


def ordered(estimates: list[Estimate]) -> list[Rule]:
    """By rejection per cost, best first; rules that reject nothing by cost."""
    return [e.rule for e in sorted(estimates, key=lambda e: (-e.worth, e.cost, e.rule.name))]


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, or null; rules behind it are not evaluated."""
    if not rules:
        return F.lit(None).cast("string")
    first, *rest = rules
    start = F.when(first.rejects, first.name)
    return reduce(lambda chain, rule: chain.when(rule.rejects, rule.name), rest, start)


def judge(docs: DataFrame, workspace: Workspace, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with measures, ``base_failed``, ``rejected_by`` and ``kept``.

    Texts that fail the base rule are not kept; the others pass the cascade. Null, empty and
    blank texts have no words and fail. Which rule is named depends on the order chosen; the
    verdict does not.
    """
    measured = measures(docs, text_col)
    text_only = docs.select(quoted(text_col).alias("text"))
    total = text_only.count()
    share = min(1.0, sample_rows / max(1, total))
    sample = measures(text_only.sample(share, 7) if share < 1 else text_only)
    rules = ordered(estimate(sample, standard_rules(), workspace, sample_rows))
    failed = measured.withColumn("base_failed", base_failed())
    named = failed.withColumn("rejected_by", F.when(~F.col("base_failed"), cascade(rules)))
    return named.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull()).drop("__words", "__lines")
