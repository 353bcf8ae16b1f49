"""A scanner for irregular markup as column expressions: tokens in one pass, then text.

Expressions that remove scripts, comments and tags one after the other go wrong on crooked
pages: an attribute that holds ``>``, a comment that holds a script, a script that holds
a comment's start. Here one pattern reads a page from left to right, so that every sign
belongs to the token that begins first: a comment, a script or style with its content,
a tag with its quoted attributes, a declaration, or text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.pages import unescape
from pricewright.functions.products import strip

_BREAK = "\x01"
# what follows a tag's name: quotes count only after an equals sign, and only where they are closed
_REST = r"""(?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>=]++|=(?!\s*+["']))*+"""
_COMMENT = "<!--.*?-->"
# a script or style runs to its own end tag, or to the end of the page; <script/> has no content
_RAW = rf"<(script|style)(?=[\s/>]){_REST}(?<!/)>.*?(?:</\1(?=[\s/>])[^>]*+>|\z)"
_TAG = rf"<[A-Za-z]{_REST}>"
_END = "</[^>]*+>"
_DECLARATION = r"<!(?!--)[^>]*+>|<\?[^>]*+>"
_TEXT = "[^<]++|<"
TOKEN = f"(?is)(?:{_COMMENT}|{_RAW}|{_TAG}|{_END}|{_DECLARATION}|{_TEXT})"


def page_tokens(html: Column) -> Column:
    """The tokens of a page in order; put together they are the page."""
    return F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))


def is_text(token: Column) -> Column:
    """Whether a token is text: a lone ``<`` is, all longer tokens that begin with one are not."""
    return ~token.startswith("<") | (token == "<")


def _first(tokens: Column, pattern: str) -> Column:
    """Place from 1 of the first token that matches, 0 if none does."""
    marks = F.transform(tokens, lambda token: token.rlike(pattern))
    return F.coalesce(F.array_position(marks, True), F.lit(0)).cast("int")


def _inside(tokens: Column, name: str, last_end: bool) -> Column:
    """Tokens after the first tag of a name and before its end tag, or all the rest; none without the tag."""
    opened = _first(tokens, rf"(?i)^<{name}[\s/>]")
    rest = F.slice(tokens, opened + 1, F.greatest(F.size(tokens) - opened, F.lit(0)))
    end = rf"(?i)^</{name}[\s/>]"
    closed = _first(F.reverse(rest) if last_end else rest, end)
    length = F.when(closed == 0, F.size(rest)).when(F.lit(last_end), F.size(rest) - closed).otherwise(closed - 1)
    return F.when(opened > 0, F.slice(rest, 1, length)).otherwise(F.expr("cast(array() as array<string>)"))


def _pieces(tokens: Column) -> Column:
    """Stretches of text between other tokens, references decoded and blanks trimmed; empty ones left out."""
    joined = F.array_join(F.transform(tokens, lambda token: F.when(is_text(token), token).otherwise(_BREAK)), "")
    return F.filter(F.transform(F.split(unescape(joined), _BREAK), strip), lambda piece: piece != "")


def scanned_text(tokens: Column) -> Column:
    """Text of the body, a line per stretch between tags."""
    return F.array_join(_pieces(_inside(tokens, "body", True)), "\n")


def scanned_title(tokens: Column) -> Column:
    """Text of the title as it stands, or the words for a page without one."""
    inside = _inside(tokens, "title", False)
    text = F.array_join(F.filter(inside, is_text), "")
    return F.when(_first(tokens, r"(?i)^<title[\s/>]") > 0, unescape(text)).otherwise(fixed.NO_TITLE)


def scanned_page(tokens: Column) -> Column:
    """Title, blank line and text, cut to the page limit."""
    return F.substring(F.concat(scanned_title(tokens), F.lit("\n\n"), scanned_text(tokens)), 1, fixed.PAGE_CHARS)
