"""Quality rules with risk-controlled cutoffs.

Base measures are counted on whole texts. Each rule rejects a document whose
measure lies beyond a cutoff. Cutoffs are chosen per stratum on labelled rows:
a cutoff is safe when the exact binomial test says that it rejects at most
``risk / rules`` of good documents, at a level of ``level`` split over strata
and rules (Bonferroni). Along a rule's grid the tests go from the loosest
cutoff to the strictest and stop at the first that fails (fixed sequence), so
no further correction is needed there. Together the rules reject at most
``risk`` of a stratum's good documents, with probability 1 - ``level`` for all
strata at once. A stratum with too few labels to prove any cutoff keeps
everything that passes the base rules.

Defined results: null and empty texts have no words and fail the base rule; a
null stratum is a stratum of its own; labels of the same doc_id count as good
where all of them are; labels without an id or quality are not used; repeated
rows are judged each; without labels only the base rules reject; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import SPACE, materialise

WINDOW = 8
# Fixed value: the characters counted as symbols.
SYMBOLS = "[#*$%&|<>]"

# Rule, its measure over the base counts, and its grid from loose to strict.
# All measures are per thousand and reject above the cutoff.
RULES: list[tuple[str, str, list[int]]] = [
    ("symbols", "1000 * n_symbols / greatest(word_chars, 1)",
     [400, 300, 200, 150, 120, 100, 80, 60, 50, 40, 30, 20, 15, 10, 5]),
    ("duplicate_lines", "1000 * n_dup_lines / greatest(n_lines, 1)",
     [800, 600, 500, 400, 300, 250, 200, 150, 100, 50]),
    ("repeated_words", "1000 * n_repeat_words / greatest(n_words, 1)",
     [290, 250, 200, 160, 130, 100, 80, 60, 40, 20]),
    ("long_words", "1000 * word_chars / greatest(n_words, 1)",
     [40000, 30000, 20000, 15000, 12000, 11000, 10000, 9000, 8000, 7000]),
    ("short_words", "-1000 * word_chars / greatest(n_words, 1)",
     [-1000, -1500, -2000, -2500, -3000, -3500, -4000, -4500]),
]


def _stretches(values: str, length: int, apart: int = 1) -> Column:
    """Digest of the ``length`` values that begin at each place, ``apart`` places from each other."""
    reach = (length - 1) * apart
    return F.transform(
        F.slice(values, F.lit(1), F.greatest(F.size(values) - reach, F.lit(0))),
        lambda value, i: F.xxhash64(
            value, *(F.get(values, i + apart * step) for step in range(1, length))))


def _covered(marked: Column) -> Column:
    """Words covered by windows that begin at the sorted places ``marked``."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        marked, zero,
        lambda s, at: F.struct(
            (s["n"] + at + WINDOW - F.greatest(at, s["upto"])).alias("n"),
            (at + WINDOW).alias("upto")),
        lambda s: s["n"])


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``stratum`` (if there) and the base counts, one row per row of ``docs``."""
    keep = ["doc_id", *(["stratum"] if "stratum" in docs.columns else [])]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counted = docs.select(*keep, text.alias("text")).select(
        *keep, "text", F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda l: l.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    n = F.size("words")
    hashed = counted.select(
        *keep, n.cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n > WINDOW, F.transform("words", lambda w: F.xxhash64(w))).alias("hashes"))
    fours = hashed.withColumn("fours", _stretches("hashes", 4))
    # A window found twice repeats all its five stretches of four words. Most texts repeat
    # fewer; only the others get their windows digested, and sorted if some are equal.
    some = F.size("fours") - F.size(F.array_distinct("fours")) >= WINDOW - 3
    windows = fours.withColumn("hashes", F.when(some, _stretches("fours", 2, 4)))
    twice = F.size(F.array_distinct("hashes")) < F.size("hashes")
    sorted_ = windows.withColumn("ordered", F.when(twice, F.sort_array(F.transform(
        "hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    places = F.filter(F.transform("ordered", lambda x, i: F.when(
        (x["h"] == F.get("ordered", i - 1)["h"]) | (x["h"] == F.get("ordered", i + 1)["h"]), x["i"])),
        lambda p: p.isNotNull())
    marked = sorted_.withColumn("places", F.sort_array(places))
    return marked.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(_covered(F.col("places")), F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed in the order of the terms from their logarithms."""
    odds, rest = math.log(p) - math.log1p(-p), math.log1p(-p)
    first = F.struct((n * F.lit(rest)).alias("log"), F.exp(n * F.lit(rest)).alias("sum"))

    def step(s: Column, i: Column) -> Column:
        log = s["log"] + F.log((n - i + 1) / i.cast("double")) + F.lit(odds)
        return F.struct(log.alias("log"), (s["sum"] + F.exp(log)).alias("sum"))

    terms = F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(terms, first, step, lambda s: F.least(s["sum"], F.lit(1.0)))


def cutoffs(measures: DataFrame, labels: DataFrame, risk: float = 0.05,
            level: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff): the strictest safe cutoff of each rule, where there is one."""
    marks = (labels.where("doc_id is not null and quality is not null")
             .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("good")))
    # Documents that fail the base rules are gone before any cutoff applies.
    held = (measures.where(~base_failed()).join(marks.where("good = 1"), "doc_id")
            .groupBy("stratum").agg(
                F.count("*").alias("n"),
                *(F.sum(F.expr(f"cast({m} > {c} as int)")).alias(f"{rule}_{at}")
                  for rule, m, grid in RULES for at, c in enumerate(grid))))
    cases = F.array(*(F.struct(F.lit(rule).alias("rule"), F.lit(at).alias("at"),
                               F.lit(c).alias("cutoff"), F.col(f"{rule}_{at}").alias("k"))
                      for rule, _, grid in RULES for at, c in enumerate(grid)))
    allowed = risk / len(RULES)
    strata = measures.select("stratum").distinct().agg(F.count("*")).scalar()
    tests = held.select("stratum", "n", F.explode(cases).alias("case")).select(
        "stratum", "n", "case.*")
    # Beyond the allowed share the test fails anyhow; its sum need not be formed.
    value = F.when(F.col("k") <= allowed * F.col("n"),
                   binomial_tail(F.col("k"), F.col("n"), allowed)).otherwise(1.0)
    tested = tests.withColumn("safe", value <= level / (strata * len(RULES)))
    fails = F.min(F.when(~F.col("safe"), F.col("at")))
    steps = F.collect_list(F.struct("at", "cutoff"))
    chosen = tested.groupBy("stratum", "rule").agg(fails.alias("stop"), steps.alias("steps"))
    passed = F.filter("steps", lambda s: s["at"] < F.coalesce("stop", F.lit(1 << 30)))
    return (chosen.select("stratum", "rule", F.array_max(passed).alias("best"))
            .where("best is not null").select("stratum", "rule", "best.cutoff"))


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.05,
           level: float = 0.05) -> DataFrame:
    """Base counts, ``base_failed``, the rules that reject, and ``kept``."""
    by = F.col(stratum).cast("string") if stratum in docs.columns else F.lit(None).cast("string")
    measures = materialise(measured(docs.select("doc_id", "text", by.alias("stratum"))))
    chosen = cutoffs(measures, labels, risk, level)
    # One row per stratum at most, each with a handful of cutoffs.
    limits = chosen.groupBy(F.col("stratum").alias("of")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))
    broken = F.filter(F.array(*(F.when(
        F.expr(m) > F.element_at("limits", F.lit(rule)), F.lit(rule)) for rule, m, _ in RULES)),
        lambda r: r.isNotNull())
    out = measures.join(materialise(limits), F.col("stratum").eqNullSafe(F.col("of")), "left")
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        F.coalesce(broken, F.array().cast("array<string>")).alias("rejected_by")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
