"""Text expressions: trimming, normalising, folding, phrases and pipe-joined lists.

Each expression has a plain Python twin where configuration has to be normalised on the driver.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters folded to an apostrophe and to a hyphen, words that lose their dot, and abbreviations that are written out.
APOSTROPHES = "‘’‛′´`"
DASHES = "‐‑‒–—−"
SHORT_WORD = "[A-Z]{1,4}"
ABBREVIATIONS = (("RD", "ROAD"), ("ST", "STREET"), ("AVE", "AVENUE"), ("AV", "AVENUE"), ("CO", "COUNTY"))
_WITHOUT_MARKS = dict.fromkeys(code for code in range(0x20000) if unicodedata.combining(chr(code)))


def trim_ws(c: Column) -> Column:
    """Without white space of any kind at both ends (Spark's trim knows the space alone)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    """Null for text of white space only; other text as it is, not trimmed."""
    return F.when(trim_ws(c) != "", c)


def _word(word: Column) -> Column:
    """A word with runs of dots as one, and without the dot that ends a short Latin word."""
    word = F.regexp_replace(word, r"\.+", ".")
    bare = F.substring(word, F.lit(1), F.length(word) - 1)
    last = F.element_at(F.split(bare, r"(?U)\W"), -1)
    return F.when(F.endswith(word, F.lit(".")) & last.rlike(f"^{SHORT_WORD}$"), bare).otherwise(word)


def normalise(c: Column, compose: bool = False) -> Column:
    """Upper-case text with uniform spacing, punctuation and written-out abbreviations.

    The parts between commas are tidied word by word, and empty ones go.  ``compose`` brings text that may hold combining marks
    into composed form first, through a Python function; ``unicode.composed_latin`` does so natively for Latin letters.
    """
    if compose:
        from .unicode import composed

        c = composed(c)
    out = F.upper(F.translate(c, APOSTROPHES + DASHES, "'" * len(APOSTROPHES) + "-" * len(DASHES)))
    words = lambda part: F.filter(F.split(part, r"(?U)\s+"), lambda w: w != "")
    spaced = lambda part: F.array_join(F.transform(words(part), lambda w: F.replace(_word(w), F.lit("-"), F.lit(" - "))), " ")
    parts = F.transform(F.split(out, ","), lambda part: F.array_join(words(spaced(part)), " "))
    out = F.btrim(F.array_join(F.filter(parts, lambda part: part != ""), ", "), F.lit(" ,."))
    whole = F.create_map(*(F.lit(x) for pair in ABBREVIATIONS for x in pair))
    runs = F.transform(F.regexp_extract_all(out, F.lit(r"(?U)\w+|\W+"), 0), lambda run: F.coalesce(F.element_at(whole, run), run))
    return F.array_join(runs, "")


def normalise_text(value: str) -> str:
    """Python twin of ``normalise``, for every script."""

    def tidy(word: str) -> str:
        word = re.sub(r"\.+", ".", word)
        ends_short = word.endswith(".") and re.fullmatch(SHORT_WORD, re.split(r"\W", word[:-1])[-1])
        return (word[:-1] if ends_short else word).replace("-", " - ")

    folded = {**dict.fromkeys(map(ord, APOSTROPHES), "'"), **dict.fromkeys(map(ord, DASHES), "-")}
    parts = unicodedata.normalize("NFC", value).translate(folded).upper().split(",")
    parts = [" ".join(" ".join(tidy(word) for word in part.split()).split()) for part in parts]
    whole = dict(ABBREVIATIONS)
    return "".join(whole.get(run, run) for run in re.findall(r"\w+|\W+", ", ".join(filter(None, parts)).strip(" ,.")))


def fold_text(value: str) -> str:
    return unicodedata.normalize("NFKD", value).translate(_WITHOUT_MARKS)


def _folding() -> tuple[str, str, str, list[tuple[str, str]]]:
    """Of the Latin letters and the Windows-1252 signs: those folded to one character, to what, marks dropped, and the rest."""
    signs = "".join(bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0x100))
    latin = "".join(map(chr, [*range(0x100, 0x250), *range(0x1E00, 0x1F00)]))
    one, to, rest = [], [], []
    for ch in dict.fromkeys(signs + latin):
        folded = fold_text(ch)
        if folded == ch:
            continue
        if len(folded) == 1:
            one.append(ch)
            to.append(folded)
        elif ch in signs:
            rest.append((ch, folded))
    return "".join(one), "".join(to), "".join(map(chr, range(0x300, 0x370))), rest


_ONE, _TO, _MARKS, _REST = _folding()


def fold(c: Column) -> Column:
    """Without accents, for Latin text; compatibility signs are written out."""
    out = F.translate(c, _ONE + _MARKS, _TO)
    for ch, folded in _REST:
        out = F.replace(out, F.lit(ch), F.lit(folded))
    return out


def match_text(value: str | None) -> str:
    return "" if value is None else fold_text(normalise_text(value))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("([A-Z0-9]+)"), 1)


def phrase_pattern(phrase: str) -> str:
    """Java pattern of a phrase that stands between token boundaries."""
    spaced = r"\s+".join(rf"\Q{part}\E" for part in phrase.split(" "))
    return rf"(?<![A-Z0-9]){spaced}(?![A-Z0-9])"


def has_phrase(c: Column, phrase: str) -> Column:
    """Whether the phrase occurs; a plain search for its first token comes before the costly pattern."""
    return F.contains(c, F.lit(phrase.split(" ")[0])) & c.rlike(phrase_pattern(phrase))


def has_component(c: Column, phrase: str) -> Column:
    """Whether one of the comma-separated parts, or the whole, is the phrase."""
    parts = F.transform(F.split(c, ","), trim_ws)
    return F.array_contains(parts, F.lit(phrase)) | (c == phrase)


def pipe(items: Column) -> Column:
    """Array to pipe-joined text."""
    return F.concat_ws("|", items)


def sorted_pipe(items: Column) -> Column:
    """Distinct non-empty items in byte order."""
    return pipe(F.array_sort(F.array_distinct(F.filter(items, lambda x: x != ""))))


def unpipe(c: Column) -> Column:
    """Pipe-joined text to an array without empty items."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"\|"), lambda x: x != "")


def pipe_has(c: Column, token: str) -> Column:
    """Whether a pipe-joined text has the token as a whole item."""
    return F.array_contains(unpipe(c), F.lit(token))


def which(pairs: Iterable[tuple[Column, object]]) -> Column:
    """The labels of all conditions that hold, in order; a null condition does not hold."""
    return F.array_compact(F.array(*(F.when(F.coalesce(cond, F.lit(False)), F.lit(label)) for cond, label in pairs)))


def is_true(c: Column) -> Column:
    """Three-valued to two-valued: null is false."""
    return F.coalesce(c, F.lit(False))
