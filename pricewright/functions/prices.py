"""Prices in text: reading them from replies and writing them into prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.products import shortened


def plain_number(text: Column, symbols: str = "$,") -> Column:
    """The first number once currency signs and commas are gone, else 0.

    A sign counts only in front of a number with a decimal point: "-5" gives 5.
    """
    bare = F.translate(text, symbols, "")
    number = F.regexp_extract(bare, "(" + fixed.PLAIN_NUMBER + ")", 1)
    return F.coalesce(number.try_cast("double"), F.lit(0.0))


def signed_number(text: Column, symbols: str = "$,") -> Column:
    """As ``plain_number`` but a sign also counts in front of a whole number."""
    bare = F.translate(text, symbols, "")
    number = F.regexp_extract(bare, r"([-+]?(?:\d*\.\d+|\d+))", 1)
    return F.coalesce(number.try_cast("double"), F.lit(0.0))


def first_pattern(text: Column, patterns: list[str]) -> Column:
    """The number caught by the first pattern that matches anywhere, else null."""
    stripped = F.trim(text)
    caught = [F.nullif(F.regexp_extract(stripped, p, 1), F.lit("")) for p in patterns]
    return F.replace(F.coalesce(*caught), F.lit(","), F.lit("")).try_cast("double")


def reply_price(text: Column) -> Column:
    """Price in a reply, never below 0. Without a comma "1234.56" reads as 123."""
    return F.greatest(F.lit(0.0), F.coalesce(first_pattern(text, fixed.REPLY_PRICE_PATTERNS), F.lit(0.0)))


def freight_reply_price(text: Column) -> Column:
    """Freight price in a reply as text with two decimals, "0" when there is none."""
    price = first_pattern(text, fixed.FREIGHT_REPLY_PATTERNS)
    return F.when(price.isNull(), "0").otherwise(F.format_string("%.2f", price))


def whole(price: Column) -> Column:
    """Whole amount, halves to even, as digits."""
    return F.bround(price, 0).cast("long").cast("string")


def priced_prompt(text: Column, price: Column) -> Column:
    """Question, text and whole price: one training text."""
    return F.concat(unpriced_prompt(text), whole(price), F.lit(".00"))


def unpriced_prompt(text: Column) -> Column:
    return F.concat(
        F.lit(fixed.PRICE_QUESTION + "\n\n"), text, F.lit("\n\n" + fixed.PRICE_PREFIX))


def cut_at_price(prompt: Column) -> Column:
    """The prompt up to and including the price prefix."""
    return F.concat(F.substring_index(prompt, fixed.PRICE_PREFIX, 1), F.lit(fixed.PRICE_PREFIX))


def freight_text() -> Column:
    """The shipment description built from the booking columns."""
    return F.format_string(
        fixed.FREIGHT_TEXT, "pol", "pod", "commodity_desc", "commodity_code", "teu", "booking_type", "year", "month",
        "channel",
    )


def freight_completion(rounded: Column) -> Column:
    price = F.when(rounded, whole(F.col("price"))).otherwise(F.format_string("%.2f", "price"))
    return F.concat(F.lit(" "), price, F.lit(" "), "currency")


def money(amount: Column) -> Column:
    return F.format_string(fixed.MONEY, amount)


def lookup_text(name: Column, price: Column) -> Column:
    """Sentence for a looked-up price; whole numbers carry no decimals."""
    number = F.when(price == F.floor(price), price.cast("long").cast("string")).otherwise(
        F.format_string("%.2f", price))
    return (
        F.when(F.coalesce(F.trim(name), F.lit("")) == "", fixed.LOOKUP_EMPTY)
        .when(price.isNull(), F.format_string(fixed.LOOKUP_MISSING, name))
        .otherwise(F.format_string(fixed.LOOKUP_FOUND, name, number))
    )


def prompt_title(prompt: Column) -> Column:
    """The line after the first title mark, or the whole prompt when it has none; cut."""
    after = F.split_part(prompt, F.lit(fixed.TITLE_MARK), F.lit(2))
    title = F.when(prompt.contains(fixed.TITLE_MARK), F.substring_index(after, "\n", 1)).otherwise(prompt)
    return shortened(title, fixed.TITLE_CHARS)


def prompt_route(prompt: Column, number: Column) -> Column:
    """The route a prompt names, or the number of its row; cut."""
    ends = [F.regexp_extract(prompt, fixed.ROUTE_PATTERN, i) for i in (1, 2)]
    named = F.concat(ends[0], F.lit(fixed.SHORT_ROUTE), ends[1])
    route = F.when(ends[0] != "", named).otherwise(F.format_string(fixed.UNKNOWN_ROUTE, number))
    return shortened(route, fixed.TITLE_CHARS)
