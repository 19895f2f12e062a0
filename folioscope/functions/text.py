"""Text expressions. Everything here is a built-in Catalyst expression."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that separate words (Unicode white space plus the
# four information separators).
SPACES = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a regular expression. Most characters are outside of the two parts
# tested first, the single characters below 256 and the range of the others, which makes
# splitting more than twice as fast as with a flat list.
SEPARATOR = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0[\x{1680}-\x{3000}&&"
    r"[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]]+"
)

# HTML markup dropped with its content, then entities; "&amp;" is last.
HTML_DROPPED = (
    r"(?is)<script\b.*?</script\s*>",
    r"(?is)<style\b.*?</style\s*>",
    r"(?s)<!--.*?-->",
    r"(?s)<[^>]*>",
)
HTML_ENTITIES = (
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def or_empty(text: Column | str) -> Column:
    return F.coalesce(_column(text), F.lit(""))


def words(text: Column | str) -> Column:
    """The runs of non-separators, in order."""
    return F.array_remove(F.split(or_empty(text), SEPARATOR), "")


def word_count(text: Column | str) -> Column:
    return F.size(words(text))


def char_count(text: Column | str) -> Column:
    """Number of code points."""
    return F.char_length(or_empty(text))


def strip(text: Column | str) -> Column:
    return F.btrim(_column(text), F.lit(SPACES))


def is_blank(text: Column | str) -> Column:
    return strip(or_empty(text)) == ""


def cut(text: Column | str, limit: int) -> Column:
    """The first ``limit`` code points."""
    return F.substring(_column(text), 1, limit)


def snippet(text: Column | str, limit: int = 200, flat: bool = False) -> Column:
    """The head of a text with an ellipsis, which is added to short texts too.

    ``flat`` strips the text and puts it on one line first.
    """
    value = _column(text)
    if flat:
        value = F.replace(strip(value), F.lit("\n"), F.lit(" "))
    return F.concat(cut(value, limit), F.lit("..."))


def html_text(html: Column | str) -> Column:
    """Visible text of an HTML page on one line."""
    text = or_empty(html)
    for pattern in HTML_DROPPED:
        text = F.regexp_replace(text, pattern, " ")
    for entity, character in HTML_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.array_join(words(text), " ")


def like_pattern(keyword: str, literal: bool = False) -> str:
    """``%keyword%``. ``%`` and ``_`` act as wildcards unless ``literal``.

    A backslash escapes the next character; where that character needs no escape
    the backslash is dropped, since LIKE would refuse it.
    """
    if literal:
        return "%" + re.sub(r"([\\%_])", r"\\\1", keyword) + "%"
    return re.sub(
        r"\\(.)",
        lambda found: found[0] if found[1] in "\\%_" else found[1],
        f"%{keyword}%",
        flags=re.DOTALL,
    )


def iso_timestamp(value: Column | str) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]``; no fraction when it is zero."""
    rendered = _column(value).cast("string")
    fraction = F.substring(rendered, 21, 6)
    return F.concat(
        F.substring(rendered, 1, 10),
        F.lit("T"),
        F.substring(rendered, 12, 8),
        F.when(fraction == "", "").otherwise(F.concat(F.lit("."), F.rpad(fraction, 6, "0"))),
    )
