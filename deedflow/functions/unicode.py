"""Unicode normal forms for text that is not composed already.

Spark has no built-in for them.  Latin letters with marks are composed by a table; for other scripts there are
Arrow-batched functions.  Text decoded from Windows-1252 needs neither.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _form(name: str, strip_marks: bool = False):
    def run(texts: pd.Series) -> pd.Series:
        import unicodedata

        def one(t):
            if t is None:
                return None
            out = unicodedata.normalize(name, t)
            return "".join(ch for ch in out if not unicodedata.combining(ch)) if strip_marks else out

        return texts.map(one)

    return F.pandas_udf(run, "string")


#: The combining marks of European scripts.
MARKS = range(0x300, 0x370)


def _latin() -> tuple[dict[str, str], dict[str, str]]:
    """Latin letters to what they are made of, and pairs of a letter and a mark to one letter."""
    whole, pairs = {}, {}
    for ch in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]):
        parts = unicodedata.normalize("NFD", ch)
        if len(parts) > 1:
            whole[ch] = parts
            pairs[unicodedata.normalize("NFC", parts[:-1]) + parts[-1]] = ch
    return whole, {pair: ch for pair, ch in pairs.items() if len(pair) == 2 and unicodedata.normalize("NFC", pair) == ch}


def _table(values: dict) -> Column:
    """A map of texts, read from one literal so that plans stay small; no key or value holds the marks between them."""
    return F.str_to_map(F.lit("|".join(f"{k}={v}" for k, v in values.items())), F.lit(r"\|"), F.lit("="))


def composed_latin(c: Column) -> Column:
    """Latin letters with marks in composed form; only texts that hold a combining mark are taken apart.

    A letter's marks are ordered by their class and joined with it one by one, unless one of the same class stands between.
    """
    whole, pairs = (_table(t) for t in _latin())
    classes = _table({chr(m): unicodedata.combining(chr(m)) for m in MARKS})

    def one(x: Column) -> Column:
        letter = F.substring(x, 1, 1)
        apart = F.concat(F.coalesce(F.element_at(whole, letter), letter), F.substring(x, 2, 1 << 20))
        marks = F.filter(F.split(F.substring(apart, 2, 1 << 20), ""), lambda m: m != "")
        ordered = F.array_sort(F.transform(marks, lambda m, i: F.struct(F.element_at(classes, m).cast("int").alias("of"), i.alias("at"), m.alias("mark"))))

        def join(done: Column, m: Column) -> Column:
            new = F.element_at(pairs, F.concat(done["base"], m["mark"]))
            fits = new.isNotNull() & (done["last"] < m["of"])
            return F.struct(
                F.when(fits, new).otherwise(done["base"]).alias("base"),
                F.when(fits, done["rest"]).otherwise(F.concat(done["rest"], m["mark"])).alias("rest"),
                F.when(fits, done["last"]).otherwise(m["of"]).alias("last"),
            )

        start = F.struct(F.substring(apart, 1, 1).alias("base"), F.lit("").alias("rest"), F.lit(0).alias("last"))
        return F.aggregate(ordered, start, join, lambda done: F.concat(done["base"], done["rest"]))

    # a cluster with a mark that is not of these keeps its form
    known = rf"(?s)^.[\x{{{MARKS[0]:x}}}-\x{{{MARKS[-1]:x}}}]+$"
    letters = F.regexp_extract_all(c, F.lit(r"(?s).\p{M}*"), 0)
    joined = F.array_join(F.transform(letters, lambda x: F.when(x.rlike(known), one(x)).otherwise(x)), "")
    return F.when(c.rlike(r"\p{M}"), joined).otherwise(c)


def composed(c: Column) -> Column:
    return _form("NFC")(c)


def folded(c: Column) -> Column:
    """Without combining marks, for any script."""
    return _form("NFKD", strip_marks=True)(c)
