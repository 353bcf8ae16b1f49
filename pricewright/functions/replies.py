"""Reading model replies: JSON in prose, glued JSON, fences, criteria, message parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.products import strip


def json_part(text: Column) -> Column:
    """The text itself when it is JSON, else its widest object, else its widest array, else null."""
    bare = strip(text)
    inner = F.coalesce(
        F.nullif(F.regexp_extract(bare, r"(?s)(\{.*\})", 1), F.lit("")),
        F.nullif(F.regexp_extract(bare, r"(?s)(\[.*\])", 1), F.lit("")),
    )
    return F.when(bare.rlike(r"^[\{\[]"), bare).otherwise(inner)


def without_control(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x00-\\x1f]", "")


def json_lines(text: Column) -> Column:
    """The lines of a reply, objects glued together set apart, blank lines dropped."""
    apart = F.replace(text, F.lit("}{"), F.lit("}\n{"))
    return F.filter(F.split(apart, "\r\n|\r|\n"), lambda line: strip(line) != "")


def question_error(row: Column) -> Column:
    """Why a question row is not valid, or null; required keys and a keyword list."""
    parsed = F.try_parse_json(row)
    reason = F.when(parsed.isNull(), "not JSON")
    for key in ("question", "keywords", "reference_answer"):
        reason = reason.when(
            F.coalesce(~F.array_contains(F.json_object_keys(row), key), F.lit(True)), "missing " + key)
    return reason.when(
        ~F.schema_of_variant(F.try_variant_get(parsed, "$.keywords", "variant")).startswith("ARRAY"),
        "keywords is not a list")


def leaves_root(path: Column) -> Column:
    """Whether a relative path climbs above its root at any step."""
    def step(state, name):
        move = F.when(name == "..", -1).when(name.isin("", "."), 0).otherwise(1)
        depth = state["depth"] + move
        return F.struct(depth.alias("depth"), F.least(state["lowest"], depth).alias("lowest"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("lowest"))
    walked = F.aggregate(F.split(path, "/"), start, step)
    return path.startswith("/") | (walked["lowest"] < 0)


def issue_error(severity: Column, path: Column) -> Column:
    """Why an audit issue cannot be used, or null."""
    return (
        F.when(severity.isNull(), "missing severity")
        .when(severity != "major", "severity is not major")
        .when(F.coalesce(strip(path), F.lit("")) == "", "missing path")
        .when(leaves_root(strip(path)), "path leaves the root")
    )


def criteria_list(text: Column) -> Column:
    """Criteria given by line and comma, or the default three."""
    names = F.filter(F.transform(F.split(text, "[\n,]"), strip), lambda name: name != "")
    default = F.array(*[F.lit(name) for name in fixed.DEFAULT_CRITERIA])
    return F.when(F.size(names) > 0, names).otherwise(default)


def message_text(content: Column) -> Column:
    """Message content as one string: plain text, or a JSON list of strings and text parts."""
    parts = F.from_json(content, "array<string>")

    def piece(part: Column) -> Column:
        inner = F.coalesce(F.get_json_object(part, "$.text"), F.get_json_object(part, "$.content"))
        return F.when(part.startswith("{"), F.coalesce(inner, part)).otherwise(part)

    joined = F.array_join(F.filter(F.transform(parts, piece), lambda p: p != ""), " ")
    return F.when(content.startswith("[") & parts.isNotNull(), joined).otherwise(content)


def render(template: str, values: dict[str, Column]) -> tuple[Column, Column]:
    """A template with its ``{name}`` slots filled in one pass, and the missing names."""
    slot = r"\{(\w+)\}"
    given = F.map_from_arrays(
        F.array(*[F.lit(name) for name in values]), F.array(*[v.cast("string") for v in values.values()]))
    names = F.regexp_extract_all(F.lit(template), F.lit(slot), F.lit(1))
    gaps = F.split(F.lit(template), slot)
    filled = F.zip_with(
        gaps, names, lambda gap, name: F.concat(gap, F.coalesce(F.try_element_at(given, name), F.lit(""))))
    missing = F.filter(names, lambda name: F.try_element_at(given, name).isNull())
    return F.when(F.size(missing) == 0, F.array_join(filled, "")), F.array_join(missing, ",")


def without_fences(reply: Column) -> Column:
    """Code without its fences and without a leading line that only names the language."""
    for fence in ("```cpp", "```rust", "```"):
        reply = F.replace(reply, F.lit(fence), F.lit(""))
    named = r"^\s*(?i:rust)[ \t]*(?:\r?\n|$)"
    rest = F.regexp_replace(F.regexp_replace(reply, named, ""), r"\n$", "")
    return F.when(reply.rlike(named), rest).otherwise(reply)
