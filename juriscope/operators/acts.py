"""An act's sections, cleaned and read, as Column expressions over whole texts.

A document's header, body and footer are strings, so nothing here shuffles.
States that run along lines are found by marking the lines that open one,
joining all lines and cutting at the marks, which is one pass over the text.
"""

from __future__ import annotations

import re
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from juriscope.functions.fuzzy import contains_target, holds_target, let, looks_like_article, number_value, standard_number
from juriscope.functions.text import after_first, before_first, contains, french_date, from_first_digit, holds, repair_date, single_line, starts_with, trimmed
from juriscope.rules import FRENCH_LAW, Rules

MARK = "\u0001"


def any_of(tests) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def starts_object(line: Column, rules: Rules = FRENCH_LAW) -> Column:
    most = max(map(len, rules.object_starts), default=0)
    return F.coalesce(F.lower(F.left(line, F.lit(most))).rlike("^(?:" + "|".join(re.escape(s.lower()) for s in rules.object_starts) + ")"), F.lit(False))


def lines_of(text: Column, least: int = 0) -> Column:
    """Trimmed lines of more than ``least`` characters."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0B\f\x{85}\x{2028}\x{2029}]"), trimmed), lambda x: F.length(x) > least)


def lead(event: Column, sep: str) -> Column:
    """What stands before a line: MARK and the letter that ``event`` names for it, else ``sep``."""
    return F.coalesce(F.concat(F.lit(MARK), event), F.lit(sep))


def marked(lines: Column, text, event, sep: str) -> Column:
    """All lines as one text, each with its lead."""
    return F.array_join(F.transform(lines, lambda x: F.concat(lead(event(x), sep), text(x))), "")


def pieces_of(marked: Column, letters: str = "[a-z]") -> Column:
    """Marked lines cut before each mark; what comes before the first is dropped."""
    return F.regexp_extract_all(marked, F.lit(f"{MARK}{letters}([^{MARK}]*)"), F.lit(1))


def of_kind(marked: Column, letter: str, sep: str = " ") -> Column:
    return F.array_join(pieces_of(marked, letter), sep)


def second_title_dropped(header: Column) -> Column:
    """The first LOI stands on a line of its own; the text from a second one on goes."""
    parts = F.split(F.regexp_replace(header, "(LOI)+$", ""), "LOI")
    whole = F.when(F.size(parts) > 1, F.concat(F.get(parts, F.lit(0)), F.lit("\nLOI"), F.get(parts, F.lit(1)))).otherwise(header)
    return F.replace(whole, F.lit(" , "), F.lit(""))


def header_event(line: Column, rules: Rules = FRENCH_LAW, low: Column | None = None) -> Column:
    """The field that a header's line opens: number, object, deliberation or president; null for none.  ``low`` is the line in lower case, where a column has it."""
    low = F.lower(line) if low is None else low
    target = any_of(holds_target(low, t, 3) for t in rules.assembly)
    return F.when(starts_with(line, "LOI"), "n").when(starts_object(line, rules), "o").when(target, "d").when(holds(low, rules.promulgation), "p")


def header_marks(header: Column, rules: Rules = FRENCH_LAW) -> Column:
    return marked(lines_of(second_title_dropped(header), 2), lambda x: x, lambda x: header_event(x, rules), " ")


def header_kinds(marks: Column) -> dict[str, Column]:
    """The lines of each field of a header's marked lines: number (n), object (o), deliberation (d) and president (p)."""
    return {x: of_kind(marks, x) for x in "nodp"}


def header_parts(header: Column, kinds: dict[str, Column], one=single_line) -> dict[str, Column]:
    """Republic, number, object, assembly and president, of a header and its ``header_kinds``, put on one line by ``one``."""
    return {
        "republic": F.when(contains(header, "DAHOMEY"), "DAHOMEY").otherwise("BENIN"),
        "number": from_first_digit(kinds["n"]),
        "object": one(kinds["o"]),
        "assembly": after_first(one(kinds["d"]), "nationale"),
        "president": before_first(one(kinds["p"]), "promulgue"),
    }


def as_struct(parts: dict[str, Column]) -> Column:
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def cleaned_header(header: Column, rules: Rules = FRENCH_LAW) -> Column:
    """Struct of republic, number, object, assembly and president, read from the lines that each trigger opens."""
    header = F.coalesce(header, F.lit(""))
    return let(header_marks(header, rules), lambda x: as_struct(header_parts(header, header_kinds(x))))


# Other names of the slots, as template files write them.
SLOTS = {
    "BENIN/DAHOMEY": "republic",
    "TO_FILL_LAW_NUMBER": "number",
    "TO_FILL_OBJECT": "object",
    "TO_FILL_ASSEMBLY": "assembly",
    "TO_FILL_PRESIDENT": "president",
    "Cotonou/PORTO-NOVO": "city",
    "TO_FILL_DATE": "signed",
    "TO_FILL_SIGNATORIES": "signatories",
}


def filled(template: str, **slots: Column) -> Column:
    """A template with each ``[slot]`` replaced, by either of its names."""
    for other, name in SLOTS.items():
        template = template.replace(f"[{other}]", f"[{name}]")
    return reduce(lambda c, x: F.replace(c, F.lit(f"[{x[0]}]"), x[1]), slots.items(), F.lit(template))


#: The shape of cleaned sections; a template file can take their place.
HEADER = "RÉPUBLIQUE DU [republic]\n\nLOI N° [number]\n\n[object]\n\nL'Assemblée nationale [assembly]\n\n[president] promulgue la loi dont la teneur suit"
FOOTER = "Fait à [city], le [signed]\n\n[signatories]\n\nAMPLIATIONS"


def header_text(fields: Column | dict[str, Column], template: str = HEADER) -> Column:
    return filled(template, **{n: fields[n] for n in ("republic", "number", "object", "assembly", "president")})


def ends_footer(line: Column, low: Column | None = None) -> Column:
    low = F.lower(line) if low is None else low
    return holds(low, "AMPLIATIONS") | holds(low, "JOURNAL OFFICIEL")


def footer_event(line: Column, elsewhere: Column) -> Column:
    """Whether a footer's line is the closing formula (s) or ends what was signed (x); null for others."""
    here = F.when(elsewhere, contains_target(line, "Porto-Novo", 2)).otherwise(contains_target(line, "Cotonou", 2))
    off = ends_footer(line)
    return F.when(contains(line, "Fait à"), F.when(here, "s").when(off, "x")).when(off, "x")


def city_event(line: Column, low: Column) -> Column:
    """``footer_event`` for lines (and those in lower case) tested before their footer's city is known: the closing formula at Porto-Novo (p), Cotonou (c) or both (b)."""
    p, c = holds_target(low, "Porto-Novo", 2), holds_target(low, "Cotonou", 2)
    return F.when(holds(low, "Fait à"), F.when(p, F.when(c, "b").otherwise("p")).when(c, "c")).when(ends_footer(line, low), "x")


def in_city(marks: Column, elsewhere: Column) -> Column:
    """Lines marked by ``city_event`` as ``footer_event`` marks them."""
    of = lambda here, there: F.replace(F.regexp_replace(marks, f"{MARK}[b{here}]", f"{MARK}s"), F.lit(f"{MARK}{there}"), F.lit("\n"))
    return F.when(elsewhere, of("p", "c")).otherwise(of("c", "p"))


def footer_marks(footer: Column, elsewhere: Column) -> Column:
    return marked(lines_of(footer), lambda x: x, lambda x: footer_event(x, elsewhere), "\n")


def in_porto_novo(footer: Column) -> Column:
    return contains(footer, "PORTO-NOVO")


def footer_parts(marks: Column, elsewhere: Column) -> dict[str, Column]:
    """City, signed and signatories, of a footer's marked lines."""
    last = F.try_element_at(pieces_of(marks, "s"), F.lit(-1))
    after = F.regexp_extract_all(marks, F.lit(rf"{MARK}s[^{MARK}\n]*\n([^{MARK}]+)"), F.lit(1))
    return {
        "city": F.when(elsewhere, "Porto-Novo").otherwise("Cotonou"),
        "signed": F.coalesce(from_first_digit(F.regexp_extract(last, r"^[^\n]*", 0)), F.lit("")),
        "signatories": trimmed(F.array_join(after, "\n")),
    }


def cleaned_footer(footer: Column) -> Column:
    """Struct of city, signed (the date as read) and signatories (their lines): from the closing formula to the distribution list, as often as they come."""
    footer = F.coalesce(footer, F.lit(""))
    return let(in_porto_novo(footer), lambda x: let(footer_marks(footer, x), lambda y: as_struct(footer_parts(y, x))))


def footer_text(fields: Column | dict[str, Column], template: str = FOOTER) -> Column:
    return filled(template, **{n: fields[n] for n in ("city", "signed", "signatories")})


def first_place(lines: Column, test) -> Column:
    """The place, from 1, of the first line that passes; null for none.  Spark's ``array_position`` throws an exception for what it finds where a lambda is evaluated, which costs more than the tests."""
    return F.array_min(F.transform(lines, lambda x, i: F.when(test(x), i + 1)))


def from_to(lines: Column, start, stop) -> Column:
    """Lines from the first that starts, joined by line ends, to the line before the first stop at or after it."""

    def rest(lines: Column) -> Column:
        return F.array_join(let(first_place(lines, stop), lambda end: F.when(end > 0, F.slice(lines, 1, end - 1)).otherwise(lines)), "\n")

    return let(lines, lambda x: let(first_place(x, start), lambda at: F.when(at > 0, let(F.slice(x, at, F.size(x)), rest)).otherwise("")))


def number_lines(lines: Column, rules: Rules = FRENCH_LAW) -> Column:
    """Of a header's lines, those of its number."""
    return from_to(lines, lambda y: starts_with(y, "LOI"), lambda y: starts_object(y, rules))


def object_lines(lines: Column, rules: Rules = FRENCH_LAW) -> Column:
    """Of a header's lines, those of its object."""
    return from_to(lines, lambda y: starts_object(y, rules), lambda y: any_of(contains(y, t) for t in rules.assembly))


@cache
def _capitals() -> dict[str, str]:
    """Each letter with all that it is the lower case of."""
    out: dict[str, str] = {}
    for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))):
        if c.lower() != c and len(c.lower()) == 1:
            out[c.lower()] = out.get(c.lower(), "") + c
    return out


@cache
def in_any_case(words: tuple[str, ...]) -> str:
    """A pattern of what has one of the words as its lower case.  Only of a capital I with a dot the lower case is two characters."""
    letter = lambda c, last: f"[{re.escape(c + _capitals().get(c, '') + ('İ' if c == 'i' and last else ''))}]"
    return "(?:" + "|".join("".join(letter(c, i == len(w) - 1) for i, c in enumerate(w)) for w in map(str.lower, words)) + ")"


def lines_in(text: Column, start: str, stop: str) -> Column:
    """``from_to`` of a text whose lines are not cut apart, as one search: ``start`` and ``stop`` are patterns of a line's beginning."""
    return F.coalesce(F.regexp_extract(text, rf"(?s)(?:\A|\n)(?={start})(?:(?={stop})|(.*?)(?=\n{stop}|\z))", 1), F.lit(""))


def number_in(header: Column, rules: Rules = FRENCH_LAW) -> Column:
    """``number_lines`` of a header as text."""
    return lines_in(header, in_any_case(("LOI",)), in_any_case(rules.object_starts))


def object_in(header: Column, rules: Rules = FRENCH_LAW) -> Column:
    """``object_lines`` of a header as text."""
    return lines_in(header, in_any_case(rules.object_starts), rf"(?:[^\n]*{in_any_case(rules.assembly)})" if rules.assembly else "(?!)")


def law_number(header: Column, rules: Rules = FRENCH_LAW) -> Column:
    return let(F.split(header, "\n"), lambda x: from_first_digit(single_line(number_lines(x, rules))))


def law_object(header: Column, rules: Rules = FRENCH_LAW) -> Column:
    return let(F.split(header, "\n"), lambda x: single_line(object_lines(x, rules)))


def closing_date(footer: Column, year: Column, rules: Rules = FRENCH_LAW) -> Column:
    """The date after "le" or "du" in the closing formula."""
    closing = F.try_element_at(F.filter(F.split(footer, "\n"), lambda x: any_of(starts_with(x, c) for c in rules.closings)), F.lit(1))
    return french_date(let(after_first(closing, "le|du"), lambda x: repair_date(x, year, rules)), rules)


def law_date(number: Column, footer: Column, year: Column, rules: Rules = FRENCH_LAW) -> Column:
    """The date after DU in the number, else after "le" or "du" in the closing formula, misread parts repaired; null if neither is one."""
    return F.coalesce(french_date(let(after_first(number, "DU"), lambda x: repair_date(x, year, rules)), rules), closing_date(footer, year, rules))


def body_marks(body: Column, rules: Rules = FRENCH_LAW) -> Column:
    return marked(lines_of(body), lambda x: x, lambda x: F.when(looks_like_article(x, rules), "a"), " ")


def articles_of(body: Column, rules: Rules = FRENCH_LAW) -> Column:
    """Array of (place, index, content): a line that opens an article begins one, the others follow it."""
    return as_articles(pieces_of(body_marks(body, rules)))


def articles_in(lines: Column) -> Column:
    """Array of (place, content) of lines (line, opens) that were tested before."""
    kept = F.filter(F.transform(lines, lambda x: F.struct(trimmed(x["line"]).alias("line"), x["opens"].alias("opens"))), lambda x: F.length(x["line"]) > 0)
    return F.transform(pieces_of(marked(kept, lambda x: x["line"], lambda x: F.when(x["opens"], "a"), " ")), lambda x, i: F.struct((i + 1).alias("place"), x.alias("content")))


def as_articles(pieces: Column) -> Column:
    """Pieces with their places and the numbers of their labels."""
    return F.transform(pieces, lambda c, i: F.struct((i + 1).alias("place"), standard_number(c).alias("index"), c.alias("content")))


def due_only(articles: Column) -> Column:
    """Articles of an amending act: one counts only if it bears the number that is due, and keeps it as written; others are part of the one before."""
    kind = "array<struct<place:int,index:string,content:string>>"
    empty = F.struct(F.lit(1).alias("due"), F.lit("").alias("index"), F.lit("").alias("now"), F.array().cast(kind).alias("out"))

    def made(acc: Column) -> Column:
        return F.array_append(acc["out"], F.struct((acc["due"] - 1).alias("place"), acc["index"].alias("index"), acc["now"].alias("content")))

    def step(acc: Column, x: Column) -> Column:
        is_due = number_value(x["index"]) == acc["due"]
        begun = acc["due"] > 1
        return F.struct(
            F.when(is_due, acc["due"] + 1).otherwise(acc["due"]).alias("due"),
            F.when(is_due, x["index"]).otherwise(acc["index"]).alias("index"),
            F.when(is_due, x["content"]).when(begun, F.concat(acc["now"], F.lit("\n"), x["content"])).otherwise("").alias("now"),
            F.when(is_due & begun, made(acc)).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(articles, empty, step, lambda acc: F.when(acc["due"] > 1, made(acc)).otherwise(acc["out"]))
