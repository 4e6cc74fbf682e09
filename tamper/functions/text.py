"""String functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: word delimiters of the warehouse's INITCAP (whitespace and
# ! ? @ " ^ # $ & ~ _ , . : ; + - * % / | \ [ ] ( ) { } < >).
INITCAP_DELIMITERS = " \t\n\x0b\f\r!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def delimiter_class(delims: str = INITCAP_DELIMITERS) -> str:
    """A regex character class matching any of ``delims`` (Java and RE2 safe)."""
    out = []
    for ch in delims:
        if ch == "\t":
            out.append(r"\t")
        elif ch == "\n":
            out.append(r"\n")
        elif ch == "\r":
            out.append(r"\r")
        elif ch == "\f":
            out.append(r"\f")
        elif ch == "\x0b":
            out.append(r"\x0B")
        elif ch in "\\[]^-":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "[" + "".join(out) + "]"


# An ASCII control character that never occurs in catalogue text; it marks
# where a word starts so that Spark's own (space-only) ``initcap`` can do the
# case work.
_MARK = "\x01"


def _initcap_tokens(c: Column, delims: str) -> Column:
    """Reference form: cut the text into ``<delimiters><word>`` tokens and
    upper-case each word's first character (regex + higher-order function)."""
    d = delimiter_class(delims)
    nd = "[^" + d[1:]
    tokens = F.regexp_extract_all(F.lower(c), F.lit(f"{d}*{nd}*"), 0)

    def cap(tok):
        lead = F.regexp_extract(tok, f"^{d}*", 0)
        word = F.substring(tok, F.length(lead) + 1, 1 << 30)
        return F.concat(lead, F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 1 << 30))

    return F.array_join(F.transform(tokens, cap), "")


def initcap_words(c, delims: str = INITCAP_DELIMITERS) -> Column:
    """Proper-case: lower everything, then upper the first character after any
    delimiter. Spark's ``initcap`` splits on spaces only
    (``Single-Origin`` would become ``Single-origin``).

    Fast path (all codegen'd, ASCII-only temporaries): put ``<mark><space>``
    after every delimiter, let ``initcap`` capitalise the letter after each
    space, then drop the inserted pairs. Text that already contains the mark
    character takes the slower token form, so no input can be corrupted.
    NULL stays NULL, an empty string stays empty."""
    c = F.col(c) if isinstance(c, str) else c
    d = delimiter_class(delims)
    pair = _MARK + " "
    fast = F.replace(F.initcap(F.regexp_replace(F.lower(c), f"({d})", "$1" + pair)),
                     F.lit(pair), F.lit(""))
    return F.when(F.instr(c, _MARK) == 0, fast).otherwise(_initcap_tokens(c, delims))


def ellipsize(c, width: int = 30) -> Column:
    """Labels longer than ``width`` become their first ``width - 3`` characters
    followed by ``...``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.length(c) <= width, c).otherwise(
        F.concat(F.substring(c, 1, width - 3), F.lit("...")))


def percent_text(c, places: int = 1) -> Column:
    """``12.3%`` text of a percentage, rounded half-up on the decimal value."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat(F.round(c.cast("decimal(38,10)"), places).cast(f"decimal(38,{places})")
                    .cast("string"), F.lit("%"))
