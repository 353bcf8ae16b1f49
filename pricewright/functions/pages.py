"""Web pages as column expressions: title, visible text, links."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.products import strip

_BREAK = "\x01"
_ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def unescape(text: Column) -> Column:
    """Named (HTML 4) and numeric character references decoded in one pass, unknown ones kept."""
    named = F.from_json(
        F.lit(json.dumps({name: chr(code) for name, code in name2codepoint.items()})), "map<string,string>")

    def sign(name: Column) -> Column:
        hexadecimal = F.conv(F.substring(name, 3, 6), 16, 10)
        code = F.when(name.rlike("^#[xX]"), hexadecimal).otherwise(F.substring(name, 2, 7)).cast("int")
        numeric = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        known = F.when(name.startswith("#"), numeric).otherwise(F.try_element_at(named, name))
        return F.coalesce(known, F.concat(F.lit("&"), name, F.lit(";")))

    names = F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(1)), sign)
    # one more gap than names: the last gap meets a missing name
    pieces = F.zip_with(F.split(text, _ENTITY), names, lambda gap, s: F.concat(gap, F.coalesce(s, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def page_title(html: Column) -> Column:
    title = F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1)
    return F.when(html.rlike("(?i)<title"), unescape(title)).otherwise(fixed.NO_TITLE)


def visible_text(html: Column) -> Column:
    """Text of the body, one line per piece between tags; scripts, styles and comments removed."""
    # up to the last end tag, or all when there is none; unclosed scripts hide the rest
    body = F.regexp_extract(html, "(?is)<body[^>]*>(.*</body>|.*)", 1)
    for unseen in (r"(?is)<script.*?(</script>|\z)", r"(?is)<style.*?(</style>|\z)", "(?s)<!--.*?-->", "(?s)<[^>]*>"):
        body = F.regexp_replace(body, unseen, _BREAK)
    pieces = F.transform(F.split(unescape(body), _BREAK), strip)
    return F.array_join(F.filter(pieces, lambda piece: piece != ""), "\n")


def page_text(html: Column) -> Column:
    """Title, blank line and visible text, cut to the page limit."""
    return F.substring(
        F.concat(page_title(html), F.lit("\n\n"), visible_text(html)), 1, fixed.PAGE_CHARS)


def all_links(html: Column) -> Column:
    """Targets of all anchors in order, empty ones included."""
    return F.regexp_extract_all(html, F.lit("(?i)<a\\s[^>]*?href\\s*=\\s*[\"']([^\"']*)[\"']"), F.lit(1))


def nonempty(links: Column) -> Column:
    return F.filter(links, lambda link: link.isNotNull() & (link != ""))


def page_links(html: Column) -> Column:
    return nonempty(all_links(html))


def absolute(url: Column, link: Column) -> Column:
    """A link as seen from a page: absolute ones stay, others hang on the page's host."""
    host = F.regexp_extract(url, "^(https?://[^/]+)", 1)
    path = F.when(link.startswith("/"), link).otherwise(F.concat(F.lit("/"), link))
    return F.when(link.rlike("^https?://"), link).otherwise(F.concat(host, path))


def snippet_text(html: Column, css_class: str = fixed.SNIPPET_CLASS) -> Column:
    """Text of the first division of a class, else the input; always on one line."""
    inner = F.regexp_extract(html, '(?is)<div class="%s">(.*?)</div>' % css_class, 1)
    pieces = F.transform(F.split(F.regexp_replace(inner, "(?s)<[^>]*>", _BREAK), _BREAK), strip)
    text = F.regexp_replace(unescape(F.array_join(pieces, "")), fixed.TAG, "")
    found = html.contains(f'<div class="{css_class}">')
    return F.replace(F.when(found, strip(text)).otherwise(html), F.lit("\n"), F.lit(" "))
