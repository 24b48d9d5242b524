"""Fuzzy matching as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from juriscope.functions.text import BLANKS, apart, begins, contains_early, delimiter_pattern, let, normalize_colons, normalize_delimiters, on_prefix, starts_with, trimmed, trimmed_column
from juriscope.rules import FRENCH_LAW, Rules


def gram_hits(zone: Column, pattern: Column, n: int) -> Column:
    """How many n-grams of the pattern, repeats counted, stand in the zone."""
    m = F.length(pattern)
    at = F.when(m >= n, F.sequence(F.lit(1), m - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(at, lambda i: F.contains(zone, F.substr(pattern, i, F.lit(n)))))


def fuzzy_match(text: Column, pattern: Column, first: Column | int, n: int, hits: int) -> Column:
    """Whether the beginning of a text holds the pattern, or enough of its n-grams."""
    zone = F.left(F.lower(trimmed(text)), F.lit(first) if isinstance(first, int) else first)
    low = F.lower(pattern)
    return F.contains(zone, low) | (gram_hits(zone, low, n) >= hits)


def pieces(pattern: str, most: int) -> list[str]:
    """The pattern in ``most`` + 1 pieces: what is within that edit distance holds one of them as it is; none if the pattern is too short."""
    n, m = most + 1, len(pattern)
    return [pattern[i * m // n : (i + 1) * m // n] for i in range(n)] if m >= n else []


def holds_any(text: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(text, F.lit(p))
    return out


def within_distance(text: Column, pattern: str, first: int, most: int) -> Column:
    """Whether a window of the pattern's length among the first characters is within an edit distance.

    Distances are computed only where a piece of the pattern stands.
    """
    m = len(pattern)
    zone = F.left(text, F.lit(first))
    windows = [(F.length(zone) >= m + i) & (F.levenshtein(F.substring(zone, i + 1, m), F.lit(pattern), most) >= 0) for i in range(max(0, first - m) + 1)]
    out = windows[0]
    for w in windows[1:]:
        out = out | w
    parts = pieces(pattern, most)
    return F.coalesce(F.when(holds_any(zone, parts), out) if parts else out, F.lit(False))


def contains_target(line: Column, target: str, most: int) -> Column:
    """Whether a word holds the target, is held by it (over two characters), or is within an edit distance.

    Words are looked at only where a piece of the target stands, or three of its letters in a row.
    """
    return holds_target(F.lower(line), target, most)


def holds_target(low: Column, target: str, most: int) -> Column:
    """``contains_target`` of a line in lower case."""
    goal = target.lower()
    parts = pieces(goal, most)
    close = lambda w: ((F.contains(w, F.lit(goal)) | F.contains(F.lit(goal), w)) & (F.length(w) > 2)) | (F.levenshtein(w, F.lit(goal), most) >= 0)
    told = F.exists(F.split(low, r"[\s,.;/!]+"), close)
    if not parts:
        return F.coalesce(told, F.lit(False))
    # a three-letter run that holds a piece adds nothing to it
    runs = [r for r in dict.fromkeys(goal[i : i + 3] for i in range(len(goal) - 2)) if not any(p in r for p in parts)]
    any_part = "|".join(map(re.escape, [*parts, *runs]))
    return F.coalesce(F.when(low.rlike(any_part), told), F.lit(False))


def is_closing(line: Column, rules: Rules = FRENCH_LAW) -> Column:
    """Whether a line begins like the closing formula of an act."""
    out = F.lit(False)
    for c in rules.closings:
        out = out | within_distance(line, c, 20, 3)
    return F.when(may_close(line, rules), out).otherwise(False)


def may_close(line: Column, rules: Rules = FRENCH_LAW) -> Column:
    """False only for lines that no closing formula is near to, as they hold no piece of one: a cheap test before the distances; null for null."""
    parts = [pieces(c, 3) for c in rules.closings]
    if not all(parts):
        return F.lit(True)
    every = {p for x in parts for p in x}
    return holds_any(line, sorted(p for p in every if not any(o != p and o in p for o in every)))


def is_garbage(line: Column) -> Column:
    """Footer lines that name no one: the distribution list, long numbers, the closing formula."""
    return (F.lower(line) == "ampliations") | (line.rlike("[0-9]{5,}") & ~F.contains(line, F.lit(" "))) | starts_with(line, "fait")


def looks_like_article(line: Column, rules: Rules = FRENCH_LAW) -> Column:
    """Whether a line opens an article: a label, whole or misread, and a number right after it."""
    clean = trimmed_column(line)
    begun = F.when(line >= "!", line).otherwise(F.ltrim(line, F.lit(BLANKS)))
    zone = F.lower(F.left(begun, F.lit(7)))
    grams = ("ar", "rt", "ti", "ic", "cl", "le")
    hits = sum((F.contains(zone, F.lit(g)).cast("int") for g in grams), F.lit(0))
    delimited = F.lit(False)
    for d in rules.delimiters:
        delimited = delimited | contains_early(line, d, rules.label_zone)
    word = F.startswith(zone, F.lit("article")) | (hits >= 3)
    numbered = F.left(F.lower(clean), F.lit(15)).rlike(r"^art.*(\d+|1er|premier|unique).*$")
    told = F.coalesce(F.when(clean == "", False).when(F.startswith(line, F.lit("ARTICLES")) & delimited, True).when(starts_with(line, "articles"), False).otherwise(word & numbered), F.lit(False))
    # no other line can pass, and most lines end here
    return F.when(begins(line, "a") & (F.lower(F.left(begun, F.lit(3))) == "art"), told).otherwise(False)


def number_at_start(line: Column, n: int, rules: Rules = FRENCH_LAW) -> Column:
    """The first article number among the first n characters; "premier" and "un" are 1; empty if there is none."""
    found = F.lower(F.regexp_extract(F.left(line, F.lit(n)), rf"(?i)(\d+[a-z0-9-]*|premier|un)(?:\s|[.:,-]|{delimiter_pattern(rules)}|$)", 1))
    return F.when(found.isin("premier", "un"), "1").otherwise(found)


def standard_number(article: Column) -> Column:
    """The number in a line like "Article 10 : ..."; UNKNOWN if it does not begin so."""
    head = trimmed(F.regexp_replace(F.substring_index(article, ":", 1), "(?i)article", ""))
    return F.when(starts_with(article, "article"), head).otherwise("UNKNOWN")


def number_value(number: Column) -> Column:
    """1 for ordinals, the integer, or 999999."""
    return F.when(F.contains(number, F.lit("pre")) | F.contains(number, F.lit("er")), 1).otherwise(F.coalesce(number.try_cast("int"), F.lit(999999)))


def normal_steps(rules: Rules = FRENCH_LAW) -> list[tuple[str, Callable[[Callable[[str], Column]], Column]]]:
    """The normal form of an article's line, step by step: each step's name, and its value by those of the steps before it (``line`` at first); the last is ``normal``."""
    word, zone = rules.article, rules.label_zone
    early = lambda c, part: contains_early(c, part, zone)
    in_zone = lambda c, old, new: on_prefix(c, zone, lambda p: F.replace(p, F.lit(old), F.lit(new)))

    def undelimited(c: Column) -> Column:
        out = c
        for d in reversed(rules.delimiters):
            out = F.when(early(c, d), F.replace(c, F.lit(d), F.lit(":")) if rules.compat else in_zone(c, d, ":")).otherwise(out)
        return out

    def delimited(c: Column) -> Column:
        out = F.lit(False)
        for d in rules.delimiters:
            out = out | early(c, d)
        return out

    def spread(c: Column, number: Column, at: Column, rest: Column, was_delimited: Column) -> Column:
        if rules.compat:
            rest = F.when(F.position(number, rest) > 0, F.substr(rest, F.lit(1), F.position(number, rest) - 1)).otherwise(rest)
        return F.when(~was_delimited & (number != "") & (at > 0), F.concat(F.substr(c, F.lit(1), at - 1), number, F.lit(" : "), rest)).otherwise(c)

    return [
        ("labelled", lambda x: F.when(within_distance(x("line"), word, 10, 3), F.concat(F.lit(word), F.substring(x("line"), len(word) + 1, 1 << 30))).otherwise(x("line"))),
        ("delimited", lambda x: delimited(x("labelled"))),
        ("undelimited", lambda x: F.when(x("delimited"), undelimited(x("labelled"))).otherwise(x("labelled"))),
        ("cleaned", lambda x: F.when(early(x("undelimited"), "::"), in_zone(x("undelimited"), "::", ":")).when(early(x("undelimited"), ","), in_zone(x("undelimited"), ",", "")).otherwise(x("undelimited"))),
        ("number", lambda x: number_at_start(x("cleaned"), rules.number_zone, rules)),
        ("at", lambda x: F.position(x("number"), x("cleaned"))),
        ("rest", lambda x: F.substr(x("cleaned"), x("at") + F.length(x("number")))),
        ("spread", lambda x: spread(x("cleaned"), x("number"), x("at"), x("rest"), x("delimited"))),
        ("colon", lambda x: F.instr(x("spread"), ":")),
        ("after", lambda x: F.when(x("colon") > 0, trimmed(F.substr(x("spread"), x("colon") + 1))).otherwise(x("spread"))),
        ("tidy", lambda x: normalize_delimiters(x("after"), 25, rules)),
        ("spaced", lambda x: normalize_colons(x("tidy"), 25)),
        ("normal", lambda x: F.concat(F.lit(word), F.lit(" "), x("number"), F.lit(" : "), trimmed(F.regexp_replace(x("spaced"), "^:+", "")))),
    ]


def normalized_article(line: Column, rules: Rules = FRENCH_LAW) -> Column:
    """``Article number : content`` of a line that opens an article; other lines as they are.

    With ``rules.compat`` the delimiter found is replaced along the whole line,
    and of a line cut by its number only the first two parts stay.  For whole
    tables ``with_normal_form`` is the faster form.
    """

    def nested(steps, known: dict[str, Column]) -> Column:
        (name, step), *later = steps
        value = step(known.__getitem__)
        return let(value, lambda v: nested(later, known | {name: v})) if later else value

    return F.when(looks_like_article(line, rules), let(line, lambda x: nested(normal_steps(rules), {"line": x}))).otherwise(line)


def with_normal_form(lines: DataFrame, opens: str, rules: Rules = FRENCH_LAW) -> DataFrame:
    """Lines with ``normal``: the normal form where the column ``opens`` is true, null elsewhere; each step is a column, so Spark compiles it, in stretches that the JVM compiles."""
    kept = lines.columns
    name = lambda n: n if n == "line" else f"__{n}"
    for n, step in normal_steps(rules):
        lines = lines.withColumn(name(n), F.when(F.col(opens), step(lambda k: F.col(name(k)))))
        if n in ("labelled", "cleaned", "spread"):
            lines = lines.withColumn(opens, apart(F.col(opens)))
    return lines.select(*kept, F.col("__normal").alias("normal"))
