"""Cleaning product records into one text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed

BLANKS = " \n\r\t\f\x0b\xa0"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def simplify(parts: Column) -> Column:
    """Texts joined by spaces on one line, one pass over double spaces, cut to its limit."""
    line = F.array_join(parts, " ")
    for old, new in (("\n", " "), ("\r", ""), ("\t", ""), ("  ", " ")):
        line = F.replace(line, F.lit(old), F.lit(new))
    return F.substring(strip(line), 1, fixed.MAX_PART_CHARS)


def details_map(details: Column) -> Column:
    return F.from_json(details, "map<string,string>")


def spaced_json(pairs: Column) -> Column:
    """A string map as JSON with a space after each comma and colon."""

    def quoted(text: Column) -> Column:
        for old, new in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            text = F.replace(text, F.lit(old), F.lit(new))
        return F.concat(F.lit('"'), text, F.lit('"'))

    entries = F.transform(
        F.map_entries(pairs), lambda e: F.concat(quoted(e["key"]), F.lit(": "), quoted(e["value"])))
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


def without_codes_in_line(text: Column) -> Column:
    """Drop long capital tokens whenever a capital and a digit follow on their line."""
    return F.regexp_replace(text, fixed.CODE_IN_LINE, "")


def without_code_tokens(text: Column) -> Column:
    """Drop space-separated tokens that themselves mix capitals and digits at length."""

    token = r"(?<![^ ])(?=[0-9]*+[A-Z])(?=[A-Z]*+[0-9])[A-Z0-9]{%d,}+(?![^ ])" % fixed.CODE_TOKEN_CHARS
    return F.regexp_replace(text, token, "")


def scrub(title: Column, description: Column, features: Column, details: Column,
          drop_codes=without_codes_in_line) -> Column:
    """One text of all product fields: unwanted details and part numbers removed."""
    kept = F.map_filter(
        details, lambda key, _: ~key.isin(*fixed.REMOVED_DETAILS))
    end = F.lit("\n")

    def block(present: Column, text: Column) -> Column:
        return F.when(F.coalesce(present, F.lit(False)), F.concat(text, end)).otherwise(F.lit(""))

    whole = F.concat(
        title, end,
        block(F.size(description) > 0, simplify(description)),
        block(F.size(features) > 0, simplify(features)),
        block(F.size(kept) > 0, spaced_json(kept)),
    )
    return F.substring(strip(drop_codes(whole)), 1, fixed.MAX_TEXT_CHARS)


def pounds(weight: Column) -> Column:
    """"12 ounces" and the like in pounds; 0 when missing or in an unknown unit."""
    parts = F.split(weight, " ")
    amount = F.get(parts, 0).try_cast("double")
    unit = F.lower(F.get(parts, 1))
    result = F.when(
        (unit == "hundredths") & (F.lower(F.get(parts, 2)) == "pounds"), amount / fixed.HUNDREDTHS)
    for name, (operation, factor) in fixed.POUNDS.items():
        result = result.when(unit == name, amount * factor if operation == "*" else amount / factor)
    return F.coalesce(result, F.lit(0.0))


def description_of(title: Column, summary: Column, full: Column, category: Column) -> Column:
    """Title, longest available text and category as one description."""

    def filled(text: Column) -> Column:
        return F.nullif(F.trim(text), F.lit(""))

    title, category = filled(title), filled(category)
    base = F.coalesce(filled(full), filled(summary), title)
    head = F.coalesce(title, F.lit(""))
    return (
        F.when(category.isNotNull() & base.isNotNull(),
               F.format_string(fixed.DESCRIPTION_WITH_CATEGORY, head, base, category))
        .when(title.isNotNull() & (title != base), F.format_string(fixed.DESCRIPTION, title, base))
        .otherwise(F.coalesce(base, F.lit(fixed.NO_DESCRIPTION)))
    )


def shortened(text: Column, limit: int) -> Column:
    """Cut to ``limit`` characters and marked with dots when longer."""
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(fixed.DOTS))).otherwise(text)
