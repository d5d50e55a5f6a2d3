"""Messages and the term expressions in them: ``@bot king - man + woman``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that parts words, and the characters that may
# not stand in a handle (anything but letters, numbers, "_" and "@").
WHITE_SPACE = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
NOT_HANDLE = r"[^@\p{L}\p{N}_]"


def expression_text(text: Column) -> Column:
    """The message without its handle words, words parted by one space."""
    words = F.split(text, WHITE_SPACE)
    kept = F.filter(words, lambda w: (w != "") & ~F.contains(w, F.lit("@")))
    return F.array_join(kept, " ")


def expression_key(text: Column) -> Column:
    """What decides the answer: lower case, no spaces, every minus as ``+-``."""
    signed = F.replace(F.lower(expression_text(text)), F.lit("-"), F.lit("+-"))
    return F.replace(signed, F.lit(" "), F.lit(""))


def terms_of_key(key: Column, strict: bool = False) -> Column:
    """array<struct<pos, term, sign>> of an expression key; ``strict`` leaves out empty terms."""
    terms = F.transform(
        F.split(key, r"\+"),
        lambda piece, pos: F.struct(
            pos.cast("int").alias("pos"),
            F.replace(piece, F.lit("-"), F.lit("")).alias("term"),
            F.when(F.contains(piece, F.lit("-")), -1).otherwise(1).alias("sign"),
        ),
    )
    return F.filter(terms, lambda t: t["term"] != "") if strict else terms


def parse_expression(text: Column, strict: bool = False) -> Column:
    """array<struct<pos, term, sign>> of a message."""
    return terms_of_key(expression_key(text), strict)


def is_direct(text: Column, name: str) -> Column:
    """Whether the message begins with the handle itself."""
    return text.rlike(f"^{re.escape('@' + name)}($|{NOT_HANDLE})")


def mention_prefix(author: Column, text: Column, name: str, distinct: bool = False) -> Column:
    """The author's handle and every other handle named in the message."""
    others = F.filter(
        F.split(text, NOT_HANDLE),
        lambda h: (F.length(h) > 2) & F.startswith(h, F.lit("@")) & (F.substr(h, F.lit(2)) != name),
    )
    handles = F.concat(F.array(F.concat(F.lit("@"), author)), others)
    return F.array_join(F.array_distinct(handles) if distinct else handles, " ")


def permalink(author: Column, mention_id: Column, base: str) -> Column:
    """Address of a message: base, author, ``/status/``, id."""
    return F.concat(F.lit(base), author, F.lit("/status/"), mention_id.cast("string"))


# Reply texts.


def apology(prefix: Column, unknown: Column) -> Column:
    return F.concat(prefix, F.lit(" Sorry, "), F.array_join(unknown, ", "), F.lit(" not in my vocabulary."))


def related_reply(prefix: Column, term: Column, words: Column) -> Column:
    return F.concat(prefix, F.lit(" Related terms to "), term, F.lit(": "), F.array_join(words, ", "))


def equation_reply(prefix: Column, text: Column, words: Column) -> Column:
    return F.concat(prefix, F.lit(" "), text, F.lit(" = "), F.array_join(words, ", "))
