"""Event validation over raw JSON text: the first broken rule names the error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.once import with_columns_once
from ..schemas import ACCESS_EVENT

# The required fields, in the order in which they are checked.
INTEGER, TEXT, NUMBER = "integer", "text", "number"
REQUIRED = (
    ("timestamp", INTEGER), ("dataset_id", TEXT), ("reads_1h", INTEGER), ("writes_1h", INTEGER),
    ("bytes_read_1h", INTEGER), ("hour_of_day", INTEGER), ("day_of_week", INTEGER), ("current_backend", TEXT),
    ("size_gb", NUMBER),
)


def _has_kind(kind: Column, wanted: str) -> Column:
    # A boolean counts as the number 0 or 1.
    if wanted == TEXT:
        return kind == "STRING"
    whole = kind.isin("BIGINT", "BOOLEAN")
    return whole if wanted == INTEGER else whole | kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


#: The quick reader is to accept nothing that JSON does not allow.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _is_text(text: Column, name: str) -> Column:
    """Whether a flat object without escapes has a text under a name, in the two usual spellings."""
    return text.contains(f'"{name}":"') | text.contains(f'"{name}": "')


def _quick(text: Column, read: Column) -> Column:
    """Whether ``read``, the event as the quick reader sees it, is what the careful reading would give.

    The quick reader overlooks repeated and unknown names and takes other values for texts. In a flat object without
    escapes every quote belongs to a name or a text; if there are just as many as the known names and texts need, there
    are no others.
    """
    named, texted = text.contains('"initial_backend"'), _is_text(text, "initial_backend")
    quotes = F.length(text) - F.length(F.replace(text, F.lit('"')))
    needed = 2 * len(REQUIRED) + 2 * sum(kind == TEXT for _, kind in REQUIRED) + F.when(texted, 4).when(named, 2).otherwise(0)
    complete = read.isNotNull()
    for name, _ in REQUIRED:
        complete = complete & read[name].isNotNull()
    flat = ~text.contains("\\") & ~text.contains("]") & ~text.contains("[") & (F.locate("{", F.ltrim(text, F.lit(" \t\r\n")), 2) == 0)
    texts = _is_text(text, "dataset_id") & _is_text(text, "current_backend") & (texted == read["initial_backend"].isNotNull())
    return F.coalesce(complete & flat & texts & (quotes == needed) & (F.abs(read["size_gb"]) != float("inf")), F.lit(False))


def _careful(doc: Column, text: Column) -> Column:
    """The event of a parsed ``[event]`` and the first rule about its form that it breaks."""

    def at(path: str, kind: str = "variant") -> Column:
        return F.try_variant_get(doc, f"$[{path}", kind)

    rules = [(doc.isNull() | at("0]").isNull() | at("1]").isNotNull(), "invalid json")]
    # Valid JSON is an object exactly when it opens with a brace.
    rules.append((~F.ltrim(text, F.lit(" \t\r\n")).startswith("{"), "event must be object"))
    for name, wanted in REQUIRED:
        kind = F.schema_of_variant(at(f"0].{name}"))
        rules += [(kind.isNull(), f"missing field: {name}"), (~_has_kind(kind, wanted), f"invalid type for {name}")]
    values = {f.name: at(f"0].{f.name}", f.dataType.simpleString()) for f in ACCESS_EVENT}
    # A missing initial tier falls back to the current one; an explicit null stays null.
    values["initial_backend"] = F.when(at("0].initial_backend").isNull(), values["current_backend"]).otherwise(values["initial_backend"])
    form = F.coalesce(*[F.when(broken, F.lit(message)) for broken, message in rules])
    return F.struct(form.alias("form"), *[v.alias(n) for n, v in values.items()])


def validate_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Keeps the columns of ``raw`` and adds ``valid``, ``error`` and the ten typed event fields.

    Every text goes through the quick reader, which gives typed fields at once; only a text that it can't vouch for is
    parsed in full, to name the first broken rule. In both the text is the only element of a JSON array: then anything after
    the event is a syntax error or a second element, and both are found. A text with a closing bracket could end the
    array itself, so it must also parse as the only member of an object; nothing closes both.
    """
    text = F.col(value)
    wrapped = F.concat(F.lit("["), text, F.lit("]"))
    doc = F.try_parse_json(wrapped)
    member = F.try_parse_json(F.concat(F.lit('{"e":'), text, F.lit("}")))
    doc = F.when(~text.contains("]") | member.isNotNull(), doc)
    read = F.from_json(wrapped, f"array<{ACCESS_EVENT.simpleString()}>", STRICT)
    # One step per parse: a step's result is computed once per row, however often it is used.
    parsed = with_columns_once(raw, {"read": F.when(F.size(read) == 1, F.get(read, F.lit(0)))})
    initial = F.when(text.contains('"initial_backend"'), F.col("read.initial_backend")).otherwise(F.col("read.current_backend"))
    quick = F.struct(
        F.lit(None).cast("string").alias("form"),
        *[(initial if f.name == "initial_backend" else F.col(f"read.{f.name}")).alias(f.name) for f in ACCESS_EVENT],
    )
    careful = F.get(F.transform(F.array(doc), lambda d: _careful(d, text)), F.lit(0))
    seen = with_columns_once(parsed, {"event": F.when(_quick(text, F.col("read")), quick).otherwise(careful)})
    e = lambda name: F.col(f"event.{name}")
    error = (
        F.when(e("form").isNotNull(), e("form"))
        .when((e("reads_1h") < 0) | (e("writes_1h") < 0) | (e("size_gb") < 0), "negative metrics not allowed")
        .when(~e("hour_of_day").between(0, 23), "hour_of_day out of range")
        .when(~e("day_of_week").between(0, 6), "day_of_week out of range")
    )
    return with_columns_once(seen, {"error": error}).select(
        *raw.columns, F.col("error").isNull().alias("valid"), "error", *[e(n).alias(n) for n in ACCESS_EVENT.names]
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter("valid").drop("valid", "error", "value")


def dead_letters(validated: DataFrame, now: float, value: str = "value") -> DataFrame:
    """Rejected events with their text as it came."""
    return validated.filter("not valid").select("error", F.col(value).alias("payload"), F.lit(float(now)).alias("ts"))
