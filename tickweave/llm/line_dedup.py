"""Near-duplicate lines by a deletion-neighbourhood join; the earliest line of each kind stays.

A line's words are its lower-cased runs of anything but ASCII white space. Two lines are alike if their
words are equal, or one word apart (one replaced, added or left out) where both have edit_words words or
more. A line goes if a line before it, in the order of (doc_id, place in the text), is alike. Lines of
fewer than min_words words are always kept; by default those without a word.

Equal lines are one entry with its earliest place; places that share an entry with over a thousandth of
all are joined to it by broadcast, as there are fewer than a thousand such entries. Of lines one word apart, the first or the last half of
the words is equal, so only entries that share a half with another are worked on. These emit, for each
word, a hashed key of the line without it: lines with one word replaced share a key at the same word, and
a longer line shares a key with the shorter line itself. The smallest place of a key comes from an
aggregate, never from pairing its members; then the texts of the two lines are compared.

Null and empty texts have no lines to lose, and an empty table has none. Very long texts are cut into
lines within their row. Only doc_id and text are read, so other columns clash with nothing. Rows that repeat a doc_id with another text are ordered by a
hash of the text; rows repeated as a whole have the same places and the same lines go. A null doc_id is
after all others. No document is dropped: a text left without lines is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

_LAST = 2**63 - 1
_PLACE = ("doc", "row", "n")


def _with_places(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("row"), F.coalesce("text", F.lit("")).alias("text"))


def _once(rows: DataFrame, keep: list, **made: Column) -> DataFrame:
    """With the made columns, each computed once: filters on them are not pushed below a generator."""
    return rows.select(*keep, F.inline(F.array(F.struct(*(c.alias(name) for name, c in made.items())))))


def _entries_of(lines: DataFrame, min_words: int) -> DataFrame:
    """With norm, the words joined by spaces, their number and two hashes that name it; too short lines go."""
    # only white space that isn't a single space is replaced, so most texts are scanned and not rebuilt
    norm = F.trim(F.regexp_replace(F.lower("line"), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " "))
    lines = _once(lines, [*_PLACE], norm=norm)
    lines = _once(lines.where("norm != ''"), [*_PLACE, "norm"], words=F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1)
    return lines.where(F.col("words") >= min_words).select("*", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit("second"), "norm").alias("h2"))


def _half_keys() -> Column:
    """Keys of the first and last halves; halves of the length and of one less, so that lengths one apart meet."""
    keys = [
        f"if({take} > 0, xxhash64('{side}', {take}, substring_index(norm, ' ', {sign}({take}))), null)"
        for side, sign in (("first", ""), ("last", "-"))
        for take in ("words div 2", "if(words % 2 = 0, words div 2 - 1, 0)")
    ]
    return F.array_compact(F.expr(f"array({', '.join(keys)})"))


def _without(norm: Column, words: Column, i: Column) -> Column:
    """The line without word i, from 0; the line itself for -1."""
    before, after = F.call_function("substring_index", norm, F.lit(" "), i), F.call_function("substring_index", norm, F.lit(" "), i + 1 - words)
    return F.when(i < 0, norm).otherwise(F.trim(F.concat(before, F.lit(" "), after)))


def _near(docs: DataFrame, entries: DataFrame, min_words: int) -> DataFrame:
    """h1, h2 and of, the earliest place before it of an entry one word apart, for entries that have one."""
    halves = entries.where("halves IS NOT NULL").select("h1", "h2", F.explode("halves").alias("key"))
    shared = halves.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select("key")
    candidates = halves.join(shared, "key", "left_semi").select("h1", "h2").distinct()
    where = entries.join(candidates, ["h1", "h2"], "left_semi").select("first.*").groupBy("doc", "row").agg(F.collect_set("n").alias("ns"))
    texts = _with_places(docs).join(where, ["doc", "row"]).dropDuplicates(["doc", "row"])
    split = texts.select("doc", "row", F.split("text", "\n", -1).alias("lines"), "ns")
    picked = F.transform("ns", lambda n: F.struct(n.alias("n"), F.element_at(F.col("lines"), n + 1).alias("line")))
    chosen = _entries_of(split.select("doc", "row", F.inline(picked)), min_words)
    chosen = common.materialize(chosen.select(F.struct(*_PLACE).alias("place"), "norm", "words", "h1", "h2"))

    each = chosen.select("place", "norm", "words", F.explode(F.sequence(F.lit(-1), F.col("words") - 1)).alias("i"))
    keys = common.materialize(each.select("place", "i", F.xxhash64(_without(F.col("norm"), F.col("words"), F.col("i"))).alias("key")))
    # nearly all keys are met once; only the others have places that need sorting
    met_again = keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    keys = common.materialize(keys.join(met_again, "key", "left_semi"))
    replaced = keys.where("i >= 0").groupBy("key", "i").agg(F.min("place").alias("of"), F.count("*").alias("c")).where("c > 1").drop("c")
    by_replacing = keys.where("i >= 0").join(replaced, ["key", "i"]).where("of < place").select("place", "i", "of", F.col("i").alias("of_i"))
    ends = keys.groupBy("key").agg(F.min(F.when(F.col("i") < 0, F.col("place"))).alias("short"), F.min(F.when(F.col("i") >= 0, F.struct("place", "i"))).alias("long"))
    ends = ends.where("short IS NOT NULL AND long IS NOT NULL")
    met = keys.join(ends, "key")
    by_adding = met.where("i >= 0 AND short < place").select("place", "i", F.col("short").alias("of"), F.lit(-1).alias("of_i"))
    by_leaving = met.where("i < 0 AND long.place < place").select("place", "i", F.col("long.place").alias("of"), F.col("long.i").alias("of_i"))
    found = by_replacing.unionByName(by_adding).unionByName(by_leaving)
    found = found.groupBy("place").agg(F.min(F.struct("of", "of_i", "i")).alias("x")).select("place", "x.*")
    other = chosen.select(F.col("place").alias("of"), F.col("norm").alias("of_norm"), F.col("words").alias("of_words"))
    same = _without(F.col("norm"), F.col("words"), F.col("i")) == _without(F.col("of_norm"), F.col("of_words"), F.col("of_i"))
    verified = found.join(chosen, "place").join(other, "of").where(same)
    return verified.select("h1", "h2", "of")


def duplicate_lines(docs: DataFrame, min_words: int = 1, edit_words: int = 8) -> DataFrame:
    """doc, row and n of every line that goes, with of, the place of the earliest line that is alike.

    doc is the doc_id, row a hash of the text and n the line's number in it, from 0.
    """
    if edit_words < max(min_words, 3):
        raise ValueError("edit_words must be 3 or more and no less than min_words")
    lines = _entries_of(_with_places(docs).select("doc", "row", F.posexplode(F.split("text", "\n", -1)).alias("n", "line")), min_words)
    halves = F.when(F.col("words") >= edit_words, _half_keys())
    places = common.materialize(lines.select(F.struct(*_PLACE).alias("place"), "h1", "h2", halves.alias("halves")))
    entries = common.materialize(places.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.first("halves").alias("halves"), F.count("*").alias("copies")))
    near = _near(docs, entries, min_words)
    marked = entries.join(near, ["h1", "h2"], "left").where("copies > 1 OR of IS NOT NULL").select("h1", "h2", "first", "of", "copies")
    marked = common.materialize(marked)
    found = common.join_to_groups(places.drop("halves"), marked, ["h1", "h2"], "copies")
    return found.where("first < place OR of IS NOT NULL").select("place.*", F.least("first", F.coalesce("of", "first")).alias("of"))


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    """The lines that go: doc_id, line_no, and the earliest line alike, kept_doc_id and kept_line_no."""
    gone = duplicate_lines(common.table(spark, sf_dir, "documents"))
    named = lambda c: F.nullif(c, F.lit(_LAST))
    return gone.select(named(F.col("doc")).alias("doc_id"), F.col("n").alias("line_no"), named(F.col("of.doc")).alias("kept_doc_id"), F.col("of.n").alias("kept_line_no"))


def drop_duplicate_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the lines that go; n_chars, if there, counts what is left."""
    gone = duplicate_lines(docs).groupBy(F.col("doc").alias("__doc"), F.col("row").alias("__row")).agg(F.collect_set("n").alias("__ns"))
    keyed = docs.withColumn("__doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))).withColumn("__row", F.xxhash64("text"))
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__ns"))
    text = F.when(F.col("__ns").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.element_at(F.col("__lines"), i + 1)), "\n"))
    joined = keyed.join(gone, ["__doc", "__row"], "left").withColumn("__lines", lines).withColumn("text", text)
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col("__ns").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return joined.select(*docs.columns)
