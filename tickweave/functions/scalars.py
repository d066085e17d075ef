"""Names, digests, rates and other scalar expressions of capture data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import FRAMES_PER_SECOND


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """The file name without its last suffix."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def sanitized(name: Column) -> Column:
    """At most 60 characters, all but letters, digits, - and _ replaced."""
    return F.substring(F.regexp_replace(name, r"[^\p{L}\p{N}_-]", "_"), 1, 60)


def capture_id(name: Column, content: Column) -> Column:
    """The sanitized name and the first 8 digits of the content's SHA-256."""
    return F.concat(sanitized(name), F.lit("-"), F.substring(F.sha2(content, 256), 1, 8))


def stem_of_capture(capture: Column) -> Column:
    return F.regexp_replace(capture, "-[^-]*$", "")


def first_number(name: Column) -> Column:
    """The first run of digits in a name, -1 if there is none."""
    return F.coalesce(F.regexp_extract(name, r"(\d+)", 1).try_cast("long"), F.lit(-1).cast("long"))


def name_of(code: Column, names: tuple[str, ...]) -> Column:
    """The code's name, Unknown(code) without one."""
    table = F.create_map(*(x for i, n in enumerate(names) for x in (F.lit(i), F.lit(n))))
    return F.coalesce(F.try_element_at(table, code.cast("int")), F.concat(F.lit("Unknown("), code.cast("string"), F.lit(")")))


def deck_text(cards: Column) -> Column:
    return F.array_join(F.transform(cards, lambda c: F.concat(F.lit("0x"), F.lpad(F.hex(c), 4, "0"))), ",")


def error_text(errors: Column) -> Column:
    """Errors in one text, null without any."""
    return F.nullif(F.array_join(errors, "; "), F.lit(""))


def number_or_zero(text: Column) -> Column:
    """0 for null and empty; null for what isn't a number."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0).cast("long")).otherwise(text.try_cast("long"))


def hours(frames: Column) -> Column:
    return frames / FRAMES_PER_SECOND / 3600


def rate(amount: Column, per: Column) -> Column:
    """amount / per, 0 where per is 0, less or null."""
    return F.when(per > 0, amount / per).otherwise(F.lit(0.0))


def shard_name(host: Column, index: Column) -> Column:
    return F.format_string("%s-%04d.tar", host, index.cast("int"))


def shard_index(name: Column) -> Column:
    return F.regexp_extract(name, r"-(\d+)(?:\.tar)?$", 1).try_cast("int")


def path_under(root: Column, path: Column) -> Column:
    """path if it is absolute, else below root."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.regexp_replace(root, "/+$", ""), F.lit("/"), path))


def replay_mode(mode: Column) -> Column:
    return F.when(mode == 0, 0).when(mode == 7, 7).otherwise(3)


def snake_case(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "(?<=[a-z0-9])(?=[A-Z])", "_"))
