"""Optional-field (tag) expressions.

Tags live in ``tags MAP<STRING, STRUCT<type STRING, value STRING>>``: the text
form is kept and typed getters parse on demand, so an unused tag costs
nothing and a malformed one yields NULL plus an error reason instead of
failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG_TYPE = "struct<type:string,value:string>"
TAGS_TYPE = f"map<string,{TAG_TYPE}>"

# B-array element types and their inclusive ranges.
ARRAY_RANGES = {
    "c": (-128, 127), "C": (0, 255),
    "s": (-32768, 32767), "S": (0, 65535),
    "i": (-2147483648, 2147483647), "I": (0, 4294967295),
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_tag(text) -> Column:
    """``TG:T:VALUE`` -> struct(tag, type, value); excess ``:`` stay in value."""
    parts = F.split(_c(text), ":", 3)
    return F.struct(F.get(parts, F.lit(0)).alias("tag"), F.get(parts, F.lit(1)).alias("type"), F.get(parts, F.lit(2)).alias("value"),
                    (F.size(parts) == 3).alias("three_fields"))


#: Texts that hold a number and nothing else (a cast alone lets blanks pass).
INTEGER_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?(NaN|Infinity|([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)$"


def whole_number(text, type_: str = "int") -> Column:
    """The integer that ``text`` is, NULL if it is anything else or does not fit."""
    v = _c(text)
    return F.when(v.rlike(INTEGER_TEXT), v.try_cast(type_))


def tag_error(type_, value) -> Column:
    """Reason a (type, value) pair is malformed, or NULL."""
    t, v = _c(type_), _c(value)
    return (F.when(t == "A", F.when(F.length(v) != 1, F.lit("A needs one character")))
            .when(t == "i", F.when(whole_number(v).isNull(), F.lit("i needs a signed 32-bit integer")))
            .when(t == "f", F.when(~v.rlike(FLOAT_TEXT), F.lit("f needs a float")))
            .when(t == "Z", F.lit(None).cast("string"))
            .when(t == "H", F.when(~v.rlike("^([0-9A-Fa-f]{2})*$"), F.lit("H needs an even hex string")))
            .when(t == "B", array_error(v))
            .otherwise(F.lit("unrecognized tag type")))


def _elements(value: Column) -> Column:
    return F.split(F.regexp_replace(F.get(F.split(value, ",", 2), F.lit(1)), ",+$", ""), ",")


def array_error(value) -> Column:
    """Reason a ``B`` value (element type, comma, elements) is malformed, or NULL. Commas
    at its end add no element."""
    v = _c(value)
    parts = F.split(v, ",", 2)
    kind = F.get(parts, F.lit(0))
    elems = _elements(v)
    bad_shape = (F.size(parts) != 2) | (F.length(kind) != 1)
    floats_bad = F.exists(elems, lambda x: ~x.rlike(FLOAT_TEXT))
    checks = F.when(bad_shape, F.lit("B needs element type and comma"))
    checks = checks.when(kind == "f", F.when(floats_bad, F.lit("B:f needs floats")))
    for k, (lo, hi) in ARRAY_RANGES.items():
        out = F.exists(elems, _out_of_range(lo, hi))
        checks = checks.when(kind == F.lit(k),
                             F.when(out, F.lit("B element out of range")))
    return checks.otherwise(F.lit("unrecognized array element type"))


def _out_of_range(lo: int, hi: int):
    def pred(x):
        v = whole_number(x, "long")
        return v.isNull() | (v < lo) | (v > hi)
    return pred


def tags_from_fields(fields) -> Column:
    """Array of ``TG:T:VALUE`` strings -> tag map; a repeated tag keeps the last value."""
    # three steps, so that a field is split once
    parts = F.transform(_c(fields), lambda t: F.split(t, ":", 3))
    entries = F.transform(parts, lambda p: F.struct(F.get(p, F.lit(0)).alias("tag"), F.struct(
        F.get(p, F.lit(1)).alias("type"), F.get(p, F.lit(2)).alias("value")).alias("entry")))
    empty = F.create_map().cast(TAGS_TYPE)

    def add(m, e):
        kept = F.map_filter(m, lambda k, _v: k != e["tag"])
        return F.map_concat(kept, F.create_map(e["tag"], e["entry"]))

    names = F.transform(parts, lambda p: F.get(p, F.lit(0)))
    repeated = F.size(F.array_distinct(names)) < F.size(names)
    return F.when(repeated, F.aggregate(entries, empty, add)).otherwise(F.map_from_entries(entries))


def tag_type(tags, name: str) -> Column:
    return F.element_at(_c(tags), F.lit(name))["type"]


def tag_text(tags, name: str) -> Column:
    return F.element_at(_c(tags), F.lit(name))["value"]


def tag_int(tags, name: str) -> Column:
    """Integer value of an ``i`` tag (NULL when absent, other type, or bad)."""
    e = F.element_at(_c(tags), F.lit(name))
    return F.when(e["type"] == "i", e["value"].try_cast("int"))


def tag_in_range(tags, name: str, lo: int, hi: int) -> Column:
    """Integer tag checked against a narrower type's range (short, byte ...)."""
    v = tag_int(tags, name)
    return F.when((v >= lo) & (v <= hi), v)


def tag_float(tags, name: str) -> Column:
    e = F.element_at(_c(tags), F.lit(name))
    return F.when(e["type"] == "f", e["value"].try_cast("float"))


def tag_string(tags, name: str) -> Column:
    e = F.element_at(_c(tags), F.lit(name))
    return F.when(e["type"] == "Z", e["value"])


def tag_char(tags, name: str) -> Column:
    e = F.element_at(_c(tags), F.lit(name))
    return F.when((e["type"] == "A") & (F.length(e["value"]) == 1), e["value"])


def tag_bytes(tags, name: str) -> Column:
    e = F.element_at(_c(tags), F.lit(name))
    even_hex = e["value"].rlike("^([0-9A-Fa-f]{2})*$")
    return F.when((e["type"] == "H") & even_hex, F.try_to_binary(e["value"], F.lit("hex")))


def tag_int_array(tags, name: str) -> Column:
    """``B`` integer array -> ``ARRAY<BIGINT>`` (NULL if any element is out of range)."""
    e = F.element_at(_c(tags), F.lit(name))
    ok = (e["type"] == "B") & array_error(e["value"]).isNull() & ~F.split(e["value"], ",", 2)[0].isin("f")
    return F.when(ok, F.transform(_elements(e["value"]), lambda x: x.cast("long")))


def tag_float_array(tags, name: str) -> Column:
    e = F.element_at(_c(tags), F.lit(name))
    ok = (e["type"] == "B") & (F.split(e["value"], ",", 2)[0] == "f") & array_error(e["value"]).isNull()
    return F.when(ok, F.transform(_elements(e["value"]), lambda x: x.try_cast("float")))


def set_tag(tags, name: str, type_: str, value) -> Column:
    """Add or replace a tag; a NULL value removes it."""
    v = _c(value) if not isinstance(value, (str, int, float)) else F.lit(str(value))
    kept = F.map_filter(_c(tags), lambda k, _v: k != F.lit(name))
    added = F.map_concat(kept, F.create_map(F.lit(name), F.struct(F.lit(type_).alias("type"),
                                                                  v.cast("string").alias("value"))))
    return F.when(v.isNull(), kept).otherwise(added)


def clear_tags(tags, names: list[str] | None = None) -> Column:
    """Remove the named tags, or all tags when ``names`` is None."""
    if names is None:
        return F.create_map().cast(TAGS_TYPE)
    return F.map_filter(_c(tags), lambda k, _v: ~k.isin(*names))


#: Integer types of the binary form; text has one type for all of them.
INTEGER_TYPES = ("c", "C", "s", "S", "i", "I")


def tags_to_text(tags) -> Column:
    """Tag map -> tab-joined ``TG:T:VALUE`` fields in insertion order.

    Integers of any width are written with type ``i``; one that 32 bits cannot hold fails
    the write and is named."""
    def field(e):
        type_, value = e["value"]["type"], e["value"]["value"]
        integer = type_.isin(*INTEGER_TYPES)
        too_big = integer & value.rlike(INTEGER_TEXT) & value.try_cast("int").isNull()
        plain = F.concat_ws(":", e["key"], F.when(integer, F.lit("i")).otherwise(type_), value)
        said = F.concat(F.lit("tag "), e["key"], F.lit(" does not fit a 32-bit integer: "), value)
        return F.when(too_big, F.raise_error(said).cast("string")).otherwise(plain)

    return F.array_join(F.transform(F.map_entries(_c(tags)), field), "\t")
