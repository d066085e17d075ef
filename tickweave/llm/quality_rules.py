"""Quality rules whose thresholds come from mergeable quantile sketches of each language and source.

Every text is measured: characters in words, symbols, repeated lines, words in repeated three-word
windows. The shares of these are sketched by group as counts of fixed-width bins: such sketches merge by
addition, give the same quantiles in any order, and their quantiles are off by one bin at most. A group's
threshold is an outer quantile of its own sketch plus a multiple of how far that lies from the group's
median, one bin at least; a group with few texts uses the sketch of its language, merged from its
sources, or that of all languages. The thresholds are then joined to the measures.

Null texts have no words and no lines, and fail; so do empty ones. Very long texts are measured whole,
within their row. A null lang or source is a group of its own. Repeated rows are measured and counted
like any other; texts on a threshold stay. An empty table gives no rows. Only doc_id, lang, source and
text are read, so other columns clash with nothing. Native: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WIDTH = 3
#: Bins of a share from 0 to 1, or of 1/20 character of a mean word length.
BINS = 1000


def _repeated(words: Column) -> Column:
    """Sorted (window hash, place) of the windows, to find equal ones side by side."""
    return F.array_sort(F.transform(words, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def measures(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The kept columns, n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, common.ASCII_SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(
        *keep,
        words.alias("__w"),
        F.length(F.regexp_replace(text, common.ASCII_SPACE + "+", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("__l"),
    )
    n = F.size("__w")
    grams = F.when(n < WIDTH, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice("__w", F.lit(1), F.greatest(n - (WIDTH - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *(F.get(F.col("__w"), i + k) for k in range(1, WIDTH))))
    )
    out = out.select(*keep, n.cast("long").alias("n_words"), "word_chars", "n_symbols", F.size("__l").cast("long").alias("n_lines"), (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"), grams.alias("__g"))
    some = F.size(F.array_distinct("__g")) < F.size("__g")
    out = out.select(*(c for c in out.columns if c != "__g"), F.when(some, _repeated(F.col("__g"))).alias("__s"))
    same = lambda x, at: F.coalesce(F.get(F.col("__s"), at)["h"] == x["h"], F.lit(False))
    places = F.array_sort(F.transform(F.filter("__s", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))
    out = out.select(*(c for c in out.columns if c != "__s"), places.alias("__p"))
    covered = F.aggregate(
        F.transform("__p", lambda p, k: F.least(F.lit(WIDTH), F.coalesce(F.get(F.col("__p"), k + 1) - p, F.lit(WIDTH)))), F.lit(0), lambda a, b: a + b
    )
    return out.select(*(c for c in out.columns if c != "__p"), F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


#: Name, share as integer bins of the measures, the lower and the upper quantile in percent (0: no lower
#: threshold), and how many times the distance from the median to the quantile is added to it. A quantile is
#: as far out as a rule's measure is rarely above zero: no clean text of most sources holds a symbol, while
#: many hold a repeated line or phrase.
RULES = (
    ("symbols", "least({b}, ({b} * n_symbols) div greatest(word_chars, 1))", 0, 90, 3),
    ("dup_lines", "({b} * n_dup_lines) div greatest(n_lines, 1)", 0, 99, 1),
    ("repeats", "({b} * n_repeat_words) div greatest(n_words, 1)", 0, 99, 1),
    ("word_length", "least({b}, (20 * word_chars) div greatest(n_words, 1))", 5, 90, 3),
)
NAMES = tuple(rule[0] for rule in RULES)
#: Most groups whose thresholds are broadcast.
FEW_GROUPS = 50_000
#: Parts of each group that are joined apart if there are more groups.
SALTS = 32


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _bins() -> list[Column]:
    return [F.expr(e.format(b=BINS)).cast("int").alias(name) for name, e, *_ in RULES]


def thresholds(measured: DataFrame, least_rows: int = 100) -> DataFrame:
    """For each (lang, source) the smallest and largest bin allowed of each rule. measured, read several times, should be a written table.

    Sketches: counts by (lang, source, rule, bin), at most BINS + 1 rows for a group and rule, added up
    for the language and for all. The sketch used is the first of group, language and all with
    least_rows texts; with fewer in all, all.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.col(name).alias("bin")) for name in NAMES)))
    usable = measured.where(~base_failed()).select("lang", "source", *_bins())
    sketch = usable.select("lang", "source", pairs.alias("x")).groupBy("lang", "source", "x.rule", "x.bin").agg(F.count("*").alias("c")).select("lang", "source", "rule", "bin", "c")

    def of(values: dict) -> Column:
        return F.create_map(*(F.lit(x) for item in values.items() for x in item))[F.col("rule")]

    low, high, times = (of({rule[0]: rule[k] for rule in RULES}) for k in (2, 3, 4))

    def fences(counts: DataFrame, keys: list[str], suffix: str) -> DataFrame:
        """Thresholds from merged counts; quantiles are where the running count first reaches the share."""
        w = Window.partitionBy(*keys, "rule")
        run = counts.groupBy(*keys, "rule", "bin").agg(F.sum("c").alias("c")).withColumn("total", F.sum("c").over(w)).withColumn("upto", F.sum("c").over(w.orderBy("bin")))
        at = lambda percent: F.min(F.when(100 * F.col("upto") >= percent * F.col("total"), F.col("bin")))
        q = run.groupBy(*keys, "rule").agg(F.max("total").alias("rows"), at(low).alias("lower"), at(F.lit(50)).alias("middle"), at(high).alias("upper"))
        bounds = {
            "low": F.when(low > 0, F.col("lower") - times * F.greatest(F.col("middle") - F.col("lower"), F.lit(1))).otherwise(-1),
            "high": F.col("upper") + times * F.greatest(F.col("upper") - F.col("middle"), F.lit(1)),
        }
        return q.select(*keys, "rule", F.col("rows").alias(f"rows{suffix}"), *(c.alias(f"{side}{suffix}") for side, c in bounds.items()))

    groups = measured.select("lang", "source").distinct().select("lang", "source", F.explode(F.array(*map(F.lit, NAMES))).alias("rule"))
    by_group, by_lang, by_all = fences(sketch, ["lang", "source"], "1"), fences(sketch, ["lang"], "2"), fences(sketch, [], "3")
    g, two, three = groups.alias("g"), by_group.alias("a"), by_lang.alias("b")
    joined = g.join(two, F.expr("g.lang <=> a.lang AND g.source <=> a.source AND g.rule = a.rule"), "left")
    joined = joined.join(three, F.expr("g.lang <=> b.lang AND g.rule = b.rule"), "left").join(F.broadcast(by_all.alias("d")), F.expr("g.rule = d.rule"), "left")
    pick = lambda c: F.when(F.col("rows1") >= least_rows, F.col(c + "1")).when(F.col("rows2") >= least_rows, F.col(c + "2")).otherwise(F.col(c + "3"))
    rows = joined.select("g.lang", "g.source", "g.rule", pick("low").alias("low"), pick("high").alias("high"))
    return rows.groupBy("lang", "source").agg(*(F.max(F.when(F.col("rule") == name, F.col(side))).alias(f"{name}_{side}") for name in NAMES for side in ("low", "high")))


def _with_limits(measured: DataFrame, limits: DataFrame, few: int) -> DataFrame:
    """Every measured row (m) with its group's limits (t).

    The limits are broadcast if a count of the groups allows it, so no row of a large group moves; more
    groups than that are joined by group and salt, which splits each into parts.
    """
    same = "m.lang <=> t.lang AND m.source <=> t.source"
    if measured.select("lang", "source").distinct().count() <= few:
        return measured.alias("m").join(F.broadcast(limits.alias("t")), F.expr(same), "left")
    m = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)))
    t = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return m.alias("m").join(t.alias("t"), F.expr(f"{same} AND m.salt = t.salt"), "left")


def judge(docs: DataFrame, least_rows: int = 100, few_groups: int = FEW_GROUPS) -> DataFrame:
    """doc_id, lang, source, the measures, base_failed, kept and failed, the names of the rules that a text fails."""
    measured = common.materialize(measures(docs))
    joined = _with_limits(measured.select("*", base_failed().alias("base_failed"), *_bins()), thresholds(measured, least_rows), few_groups)
    broken = F.array_compact(F.array(*(F.when((F.col(f"m.{name}") > F.col(f"{name}_high")) | (F.col(f"m.{name}") < F.col(f"{name}_low")), F.lit(name)) for name in NAMES)))
    kept = ~F.col("base_failed") & (F.size(broken) == 0)
    return joined.select("m.doc_id", "m.lang", "m.source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.array_join(broken, ",").alias("failed"))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents")).drop("lang", "source")
