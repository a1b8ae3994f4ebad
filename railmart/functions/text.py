"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python treats as white space; Spark's own trim removes blanks only.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Portal abbreviations after title-casing.
BOROUGH_NAMES = {
    "M": "Manhattan",
    "Mn": "Manhattan",
    "Bk": "Brooklyn",
    "Q": "Queens",
    "Qn": "Queens",
    "Bx": "Bronx",
    "Si": "Staten Island",
}


def strip(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def title_case(c: Column) -> Column:
    """Capital after every non-letter, so ``o'neil 42nd`` gives ``O'Neil 42Nd`` (``initcap`` only looks at blanks)."""
    words = F.split(F.lower(c), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))),
        "",
    )


def clean_name(c: Column) -> Column:
    return title_case(strip(c))


def clean_code(c: Column) -> Column:
    return F.upper(strip(c))


def borough_name(c: Column) -> Column:
    """Full borough name from a spelled-out or abbreviated one."""
    name = clean_name(c)
    known = F.create_map(*[F.lit(v) for pair in BOROUGH_NAMES.items() for v in pair])
    return F.coalesce(F.try_element_at(known, name), name)


def route_list(c: Column) -> Column:
    """``A C E`` to ``A,C,E``."""
    return F.regexp_replace(c, " ", ",")


def text_key(c: Column) -> Column:
    """Stable eight-digit key of a name."""
    return F.upper(F.substring(F.md5(c), 1, 8))
