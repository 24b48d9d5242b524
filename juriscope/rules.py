"""Word lists, markers and limits of the legal domain, as one set of rules that operators take."""

from __future__ import annotations

from dataclasses import dataclass

# Markers of French-language acts.
MONTHS = ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre")
OBJECT_STARTS = ("approuvent", "fixant", "Définissant", "relative", "abrogeant", "portant", "sur", "modifiant")
DELIMITERS = (".-", "- ", " -", ". ", ", ", ":")
ASSEMBLY = ("assemblee", "nationale")
CLOSINGS = ("Fait à Cotonou", "Fait à Porto-Novo")
SHORT_WORDS = ("si", "le", "la", "de", "un", "il", "en", "au", "et", "ce", "ne", "me", "se", "par", "du")
FREQUENT_WORDS = (
    "sont", "est", "été", "être", "sera", "seront", "était", "étaient", "soit", "soient",
    "ont", "a", "avait", "avaient", "aura", "auront",
    "doit", "doivent", "peut", "peuvent", "dispose", "disposent", "prévoit", "prévoient", "fixe", "fixent", "stipule", "stipulent",
    "dit", "dits", "notamment", "conformément", "date",
)
DESCENDERS, ASCENDERS = "gqpyj", "dfhkltb"

# Literal corrections of OCR slips, applied in this order.
CORRECTIONS = (
    ("Article B6", "Article 86"),
    ("Arficle", "Article"),
    ("Arfticle", "Article"),
    ("Articie", "Article"),
    ("ar1ic1e", "Article"),
    ("Articéle", "Article"),
    ("Artticle", "Article"),
    ("Artiole", "Article"),
    ("Artière", "Article"),
    ("Artièle", "Article"),
    ("Artfcle", "Article"),
    ("Articke", "Article"),
    ("Arttcle", "Article"),
    ("Articile", "Article"),
    ("Articic", "Article"),
    ("Articl ", "Article"),
    ("ArtIcle", "Article"),
    ("rticle 167", "Article 167"),
    ("Article 1e ", "Article 1er"),
    ("Article 1e'", "Article 1er"),
    ("Article Ter", "Article 1er"),
    ("Article ter", "Article 1er"),
    ("Article jer", "Article 1er"),
    ("Article 1°'", "Article 1er"),
    ("Article 1°°", "Article 1er"),
    ("Article 81  La licence", "Article 61  La licence"),
    ("Article 1°", "Article 1er"),
    ("Article ler", "Article 1er"),
    ("Article îer", "Article 1er"),
    ("1FF", "1er"),
    ("1e'", "1er"),
    ("1ë", "1er"),
    ("1er FEVRIER", "1 février"),
    ("fevrier", "février"),
    ("Fait à CCTONOU", "Fait à Cotonou"),
    ("Pait à COIONOU", "Fait à Cotonou"),
    ("'oi", "loi"),
    ("lfa", "Ifa"),
    ("pertant", "portant"),
    (".) î", ""),
    ("îï", ""),
    ("Colonou", "Cotonou"),
    ("celvi", "celui"),
    ("K/àç(j ds sT", ""),
    ("tt SOUS-SECTION 2", ""),
    ("Etat", "État"),
    ("L'SSEMBLEE", "L'ASSEMBLEE"),
    ("L'ASSELT UU V'PICHALE", "L'ASSEMBLÉE NATIONALE"),
    ("notitication", "notification"),
    ("#atieinte", "atteinte"),
    ("cubliques", "civiques"),
    ("parlequelle", "par lequel le"),
    ("dument", "dûment"),
    ("cP", ""),
    ("' RP", ""),
    ("lÉtat", "l'État"),
    ("l'tat", "l'État"),
    ("saisirla", "saisir la"),
)


@dataclass(frozen=True)
class Rules:
    """What the operators look for.  ``compat`` keeps known quirks; without it they are mended."""

    months: tuple[str, ...] = MONTHS
    object_starts: tuple[str, ...] = OBJECT_STARTS
    delimiters: tuple[str, ...] = DELIMITERS
    assembly: tuple[str, ...] = ASSEMBLY
    closings: tuple[str, ...] = CLOSINGS
    corrections: tuple[tuple[str, str], ...] = CORRECTIONS
    short_words: tuple[str, ...] = SHORT_WORDS
    frequent_words: tuple[str, ...] = FREQUENT_WORDS
    descenders: str = DESCENDERS
    ascenders: str = ASCENDERS
    promulgation: str = "promulgue"
    article: str = "Article"
    label_zone: int = 25
    number_zone: int = 24
    chunk_chars: int = 512
    compat: bool = True


FRENCH_LAW = Rules()
