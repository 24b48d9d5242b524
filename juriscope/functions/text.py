"""Text and date functions as Column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from juriscope.rules import FRENCH_LAW, Rules


#: What ends of texts are trimmed of.
BLANKS = "".join(map(chr, range(0x21)))


def trimmed(c: Column) -> Column:
    """Without control characters and blanks (all up to U+0020) at both ends."""
    return F.btrim(c, F.lit(BLANKS))


def trimmed_column(c: Column) -> Column:
    """``trimmed`` of a plain column: a text that neither begins nor ends with a blank is told by its first and last character."""
    return F.when((c >= "!") & (F.right(c, F.lit(1)) >= "!"), c).otherwise(trimmed(c))


def is_blank(c: Column) -> Column:
    """Null, empty, or Unicode white space only."""
    return F.coalesce(~c.rlike(r"[^\p{IsWhite_Space}]"), F.lit(True))


def is_numeric(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\p{Nd}+$"), F.lit(False))


def starts_with(c: Column, prefix: str) -> Column:
    """Ignoring case; null does not.  Only as many characters as the prefix has are put in lower case."""
    return F.coalesce(F.startswith(F.lower(F.left(c, F.lit(len(prefix)))), F.lit(prefix.lower())), F.lit(False))


def begins(c: Column, letter: str) -> Column:
    """Whether a text's first character is a letter from a to z in either case, or may be a blank that trimming takes; bytes are compared, so this is a cheap test before a dear one."""
    at = lambda x: (c >= x) & (c < chr(ord(x) + 1))
    return at(letter.lower()) | at(letter.upper()) | (c < "!")


def contains(c: Column, part: str) -> Column:
    """Ignoring case, minding accents; null does not."""
    return holds(F.lower(c), part)


def holds(low: Column, part: str) -> Column:
    """``contains`` of a text in lower case."""
    return F.coalesce(F.contains(low, F.lit(part.lower())), F.lit(False))


def contains_early(c: Column, part: str, n: int) -> Column:
    return F.coalesce(F.contains(F.left(c, F.lit(n)), F.lit(part)), F.lit(False))


def is_title(c: Column) -> Column:
    may = reduce(lambda a, x: a | begins(c, x), "cslt", c >= "\x7f")  # other letters than these have capitals among them too
    return F.when(may, F.upper(trimmed(c)).rlike(r"^(TITRE|CHAPITRE|SECTION|LIVRE|SOUS-SECTION)\s+[0-9IVXerPREMIER]+.*$")).otherwise(may)


@cache
def _accents() -> tuple[str, str]:
    found = [(chr(i), unicodedata.normalize("NFD", chr(i))) for i in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))]
    plain = [(c, "".join(x for x in d if not unicodedata.combining(x))) for c, d in found if c != d]
    plain = [(c, d) for c, d in plain if len(d) == 1]
    return "".join(c for c, _ in plain), "".join(d for _, d in plain)


def strip_accents(c: Column) -> Column:
    """Canonical decomposition without its marks, for Latin letters; ligatures stay."""
    return F.regexp_replace(F.translate(c, *_accents()), r"\p{M}", "")


def strip_accents_column(c: Column) -> Column:
    """``strip_accents`` of a plain column: a text with as many bytes as characters has none."""
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(strip_accents(c))


def let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def apart(value: Column) -> Column:
    """A plain column itself, in a form at which Spark ends the method that it makes of a chain of steps.

    The JVM does not compile a method of over 8000 bytes, so a longer chain is many times slower.
    """
    return let(value, lambda x: x)


def letters_only(c: Column) -> Column:
    """Accent-free lower-case letters a to z; the rest is dropped."""
    return F.regexp_replace(F.lower(strip_accents(c)), "[^a-z]", "")


def from_first_digit(c: Column) -> Column:
    return trimmed(F.regexp_extract(c, r"(?s)\p{Nd}.*", 0))


def after_first(c: Column, pattern: str) -> Column:
    return trimmed(F.regexp_extract(c, rf"(?is)^.*?(?:{pattern})(.*)$", 1))


def before_first(c: Column, pattern: str) -> Column:
    return trimmed(F.regexp_extract(c, rf"(?is)^(.*?)(?:{pattern})", 1))


def single_line(c: Column) -> Column:
    """Broken words joined, list items kept on lines of their own, other lines joined by blanks."""
    c = F.replace(c, F.lit("\r"), F.lit(""))
    c = F.regexp_replace(c, r"(?<=\w)-\s*\n\s*(?=\w)", "")
    c = F.regexp_replace(c, r"\n\s*-\s*", "\u0001")
    c = F.regexp_replace(c, r"\s*\n\s*", " ")
    c = F.regexp_replace(c, r"[ \t]{2,}", " ")
    return trimmed(F.replace(c, F.lit("\u0001"), F.lit("\n- ")))


def single_line_column(c: Column) -> Column:
    """``single_line`` of a plain column: most texts have nothing to join."""
    return F.when(c.rlike(r"[\r\n\x01]|[ \t]{2}"), single_line(c)).otherwise(trimmed_column(c))


def delimiter_pattern(rules: Rules = FRENCH_LAW) -> str:
    return "|".join(re.escape(d) for d in rules.delimiters)


def on_prefix(c: Column, n: int, change) -> Column:
    """``change`` applied to the first n characters alone."""
    return F.concat(change(F.left(c, F.lit(n))), F.substring(c, n + 1, 1 << 30))


def normalize_delimiters(c: Column, n: int, rules: Rules = FRENCH_LAW) -> Column:
    return on_prefix(c, n, lambda p: F.regexp_replace(F.regexp_replace(p, rf"(?:(?:{delimiter_pattern(rules)})\s*)+", ": "), r"\s{2,}", " "))


def normalize_colons(c: Column, n: int) -> Column:
    return on_prefix(c, n, lambda p: trimmed(F.regexp_replace(F.regexp_replace(p, r"\s*:\s*", " : "), r"\s{2,}", " ")))


def replace_early(c: Column, old: Column, new: Column, n: int) -> Column:
    return on_prefix(c, n, lambda p: F.replace(p, old, new))


def ocr_digits(c: Column) -> Column:
    """I and L read as 1, O as 0; other characters than digits go."""
    return F.regexp_replace(F.translate(F.upper(c), "ILO", "110"), "[^0-9]", "")


def nearest(c: Column, words: tuple[str, ...], most: int) -> Column:
    """The first word of least edit distance, if that is at most ``most``; else the text itself."""

    def of(c: Column) -> Column:
        scored = F.array(*[F.struct(F.levenshtein(c, F.lit(w)).alias("d"), F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in enumerate(words)])
        return F.when(c.isin(*words), c).otherwise(let(F.array_min(scored), lambda best: F.when(best["d"] <= most, best["w"]).otherwise(c)))

    return let(c, of)


def repair_date(c: Column, year: Column, rules: Rules = FRENCH_LAW) -> Column:
    """``day month year`` from an OCR date; the file's year if fewer than four digits are read."""

    def of(parts: Column) -> Column:
        day = ocr_digits(F.regexp_replace(F.lower(F.get(parts, F.lit(0))), "er", ""))
        month = nearest(F.lower(F.get(parts, F.lit(1))), rules.months, 2)
        read = let(ocr_digits(F.get(parts, F.lit(2))), lambda r: F.when(F.length(r) < 4, year).otherwise(r))
        return F.when(F.size(parts) < 3, c).otherwise(F.concat_ws(" ", day, month, read))

    return let(F.split(trimmed(c), r"[\s/\-,]+"), of)


def french_date(c: Column, rules: Rules = FRENCH_LAW) -> Column:
    """The date written ``d month yyyy``; days beyond the month's end count as its end, others are null."""
    pattern = r"^\s*(\d{1,2}) +(\S+) +(\d{4})\s*$"

    def parts(low: Column) -> Column:
        # no array_position, which throws an exception for what it finds where a lambda is evaluated
        month = let(F.regexp_extract(low, pattern, 2), lambda m: F.coalesce(*[F.when(m == x, i + 1) for i, x in enumerate(rules.months)]))
        return F.struct(F.regexp_extract(low, pattern, 1).try_cast("int").alias("day"), month.alias("month"), F.regexp_extract(low, pattern, 3).try_cast("int").alias("year"))

    return let(let(F.lower(c), parts), lambda x: date_of(x["day"], x["month"], x["year"]))


def date_of(day: Column, month: Column, year: Column) -> Column:
    """The date of three numbers; days beyond the month's end count as its end, others are null."""
    good = day.between(1, 31) & (month >= 1) & (year >= 1)
    first = F.make_date(F.when(good, year), F.when(good, month), F.lit(1))
    return F.when(good, F.date_add(first, F.least(day, F.day(F.last_day(first))) - 1))


#: A date without a slip, to which ``repair_date`` does nothing: day, month and year with one blank between.
WRITTEN = r"^(\d{1,2}) ([^\s/\-,]+) (\d{4})\z"


def written_month(c: Column) -> Column:
    """The month's name in a date that is written without a slip, in lower case; empty for other texts."""
    return F.lower(F.regexp_extract(c, WRITTEN, 2))


def written_date(c: Column, month: Column, rules: Rules = FRENCH_LAW) -> Column:
    """``french_date`` of a text whose ``written_month`` is the name of one, without a step that Spark does not compile."""
    number = F.coalesce(*[F.when(month == x, i + 1) for i, x in enumerate(rules.months)])
    return date_of(F.substring_index(c, " ", 1).try_cast("int"), number, F.right(c, F.lit(4)).try_cast("int"))


@cache
def by_shared_part(words: tuple[str, ...]) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """Words with a part of two or three characters that three of them share at least; a word that shares none is its own part."""
    left, out = list(words), []
    while left:
        count = Counter(s for w in left for s in {w[i : i + n] for n in (2, 3) for i in range(len(w) - n + 1)})
        part, n = max(count.items(), key=lambda x: (x[1], len(x[0]), x[0]))
        if n < 3:
            break
        out.append((part, tuple(w for w in left if part in w)))
        left = [w for w in left if part not in w]
    return tuple(out) + tuple((w, (w,)) for w in left)


def holds_one(c: Column, words: tuple[str, ...]) -> Column:
    """Whether a text holds one of the words, looked for only where it holds the part that they share; null does not."""
    has = lambda w: F.contains(c, F.lit(w))
    groups = [has(part) if ws == (part,) else has(part) & reduce(lambda a, w: a | has(w), ws, F.lit(False)) for part, ws in by_shared_part(words)]
    return F.coalesce(reduce(lambda a, g: a | g, groups, F.lit(False)), F.lit(False))


def corrected(c: Column, rules: Rules = FRENCH_LAW) -> Column:
    """All corrections, one after the other, as one expression; each sees what those before it made.

    Without ``rules.compat`` a correction of a label does not fire within a word.
    """
    if rules.compat:
        made = reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), rules.corrections, c)
        return F.when(holds_one(c, tuple(k for k, _ in rules.corrections)), made).otherwise(c)
    return reduce(lambda x, kv: F.regexp_replace(x, r"(?<![\p{L}\p{N}])" + re.escape(kv[0]), kv[1].replace("$", r"\$")), rules.corrections, c)


def file_parts(name: Column) -> tuple[Column, Column]:
    """Type and year of a file named type-year-number.ext."""
    parts = F.split(name, r"[-|.]")
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def source_url(kind: Column, law_number: Column, base: str = "https://sgg.gouv.bj/doc") -> Column:
    """Address of the official text; null without a number."""
    number = F.regexp_replace(F.get(F.split(law_number, r"(?i)DU", 2), F.lit(0)), r"\s+", "")
    return F.when(law_number != "", F.concat(F.lit(f"{base}/"), kind, F.lit("-"), number, F.lit("/")))


def valid_url(c: Column) -> Column:
    """Whether a text parses as an address with a known scheme; null does not."""
    return F.coalesce(F.try_parse_url(c, F.lit("PROTOCOL")).isin("http", "https", "ftp", "file", "jar"), F.lit(False))


def with_suffix(name: Column, old: str, new: str) -> Column:
    """A file name with one suffix, wherever it stands, put for another."""
    return F.replace(name, F.lit(old), F.lit(new))


def split_kept(c: Column, pattern: str) -> Column:
    """Parts of a text as Java's split gives them: empty ones at the end go, but for a text without a match."""
    parts = F.split(c, pattern)
    last = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
    return F.when(~c.rlike(pattern), F.array(c)).otherwise(F.slice(parts, 1, F.coalesce(last, F.lit(0))))


def leading_number(c: Column, n: int, rules: Rules = FRENCH_LAW) -> Column:
    """From the first digit within n characters to the first delimiter after it, else the first blank, else n; of a shorter line the rest; null without a digit.

    The older way to read a number; ``number_at_start`` of the fuzzy functions is the one in use.
    """
    at = F.regexp_instr(F.left(c, F.lit(n)), F.lit(r"\d"))
    rest = F.substr(c, at)
    ends = F.array_min(F.filter(F.array(*[F.locate(d, rest) for d in rules.delimiters]), lambda x: x > 0))
    end = F.coalesce(ends, F.when(F.locate(" ", rest) > 0, F.locate(" ", rest)))
    whole = F.when(F.length(c) <= n, rest).when(end.isNotNull(), F.substr(rest, F.lit(1), end - 1)).otherwise(F.substr(rest, F.lit(1), F.lit(n) - at + 1))
    return F.when(at > 0, trimmed(whole))


def tokens(c: Column) -> Column:
    """Distinct lower-case tokens of two characters or more."""
    return F.array_distinct(F.filter(F.split(F.lower(c), r"""[\s,.:;!"'()-]+"""), lambda x: F.length(x) > 1))


def partial_jaccard(part: Column, whole: Column) -> Column:
    """Share of the part's tokens that the whole holds; 0 without tokens."""
    p = tokens(part)
    return F.when(F.size(p) > 0, F.size(F.array_intersect(p, tokens(whole))) / F.size(p)).otherwise(F.lit(0.0))


def split_word(word: Column, known: Column, short: tuple[str, ...]) -> Column:
    """The best cut of a glued word into two known ones (long first part first); null if there is none."""
    n = F.length(word)
    cuts = F.when(n >= 4, F.sequence(F.lit(2), n - 2)).otherwise(F.array().cast("array<int>"))
    fine = lambda p: F.array_contains(known, p) & ((F.length(p) >= 3) | p.isin(*short))
    scored = F.transform(cuts, lambda i: F.struct((i * 10 + n - i).alias("score"), (-i).alias("less"), F.left(word, i).alias("a"), F.substr(word, i + 1).alias("b")))
    best = F.array_max(F.filter(scored, lambda x: fine(x["a"]) & fine(x["b"])))
    return F.when(best.isNotNull(), F.concat_ws(" ", best["a"], best["b"]))


def chunks(text: Column, most: int = 512) -> Column:
    """Sentences packed greedily while the length with one more blank stays within ``most``; a longer sentence stays whole."""
    sentences = F.split(text, r"(?<=[.!?])\s+")
    empty = F.struct(F.lit("").alias("now"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fits = F.length(acc["now"]) + F.length(s) + 1 <= most
        now = F.when(acc["now"] == "", s).when(fits, F.concat_ws(" ", acc["now"], s)).otherwise(s)
        full = (acc["now"] != "") & ~fits
        return F.struct(now.alias("now"), F.when(full, F.array_append(acc["out"], acc["now"])).otherwise(acc["out"]).alias("out"))

    return F.aggregate(sentences, empty, step, lambda a: F.when(a["now"] != "", F.array_append(a["out"], a["now"])).otherwise(a["out"]))


def with_edits(text: Column, edits: Column) -> Column:
    """A text with edits (array of struct<start, stop, replacement>, positions from 0, stop exclusive) put in, last first.

    Edits of a word with an initial capital, of at most two characters, or without a replacement are left out.
    """

    def put(acc: Column, e: Column) -> Column:
        old = F.substr(text, e["start"] + 1, e["stop"] - e["start"])
        fits = e["replacement"].isNotNull() & (e["stop"] - e["start"] > 2) & ~old.rlike(r"^\p{Lu}")
        return F.when(fits, F.concat(F.substr(acc, F.lit(1), e["start"]), e["replacement"], F.substr(acc, e["stop"] + 1))).otherwise(acc)

    last_first = F.reverse(F.array_sort(F.transform(edits, lambda e: F.struct(e["start"].alias("start"), e["stop"].alias("stop"), e["replacement"].alias("replacement")))))
    return F.coalesce(F.aggregate(last_first, text, put), text)
