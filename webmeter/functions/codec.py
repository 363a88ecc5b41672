"""JSON decoding as strict as the wire format needs, and encoding."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import RAW_FIELDS, TIME_FIELDS

_STRING = r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
RFC3339 = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d+)?(Z|[+-]([01]\d|2[0-3]):[0-5]\d)$"
#: One JSON object, or null, from the first to the last character; nested values are checked by the parser.
_ROOT = r"(?s)^[ \t\r\n]*(\{.*\}|null)[ \t\r\n]*$"
#: Containers that the parser nests at most.
_NESTED = 1000
#: Type of a variant that is an object of strings and nulls, or null.
_FLAT = r"^(?:VOID|OBJECT<(?:(?:\w+|`(?:[^`]|``)*+`): (?:STRING|VOID)(?:, (?!>)|(?=>)))*>)$"
#: A flat object of strings and nulls, or null, at the start of a text; what follows is left alone.
_PAIR = rf"{_STRING}[ \t\r\n]*+:[ \t\r\n]*+(?:{_STRING}|null)[ \t\r\n]*+"
_FIRST = rf"(?s)^[ \t\r\n]*+(?:null|\{{[ \t\r\n]*+(?:{_PAIR}(?:,[ \t\r\n]*+{_PAIR})*+)?\}})"


def _folded(name: Column) -> Column:
    """Field names are the same in any case."""
    return F.lower(name)


def _struct(**columns: Column) -> Column:
    return F.struct(*(x.alias(n) for n, x in columns.items()))


def _alone(raw: Column) -> Column:
    """Whether nothing but white space follows the first value of a text (null: it is not JSON).

    What closes an array early cannot close an object early, so only a text
    without a tail can be an element of the one and a value of the other.
    """
    return F.json_array_length(F.concat(F.lit("["), raw, F.lit("]"))).isNotNull() & F.json_object_keys(F.concat(F.lit('{"":'), raw, F.lit("}"))).isNotNull()


def _closed(raw: Column) -> Column:
    """The same by counting, for texts of so many brackets that one container more may pass the parser's limit."""
    counted = F.transform(F.array(F.regexp_replace(raw, _STRING, "")), lambda b: (F.length(F.regexp_replace(b, r"[^{\[]", "")) == F.length(F.regexp_replace(b, r"[^}\]]", ""))) & ~b.rlike(r"(?s)\}[^,}\]]*\{"))[0]
    return F.when(F.length(F.regexp_replace(raw, r"[^{\[]", "")) >= _NESTED, raw.rlike(_ROOT) & counted).otherwise(F.lit(False))


def _read(raw: Column, strict: bool = False) -> Column:
    """An array of one struct: ``ok``, ``fields`` and the fields of a raw message.

    Each step is a lambda over the struct of the step before, so that every
    value is computed once a row, however often the next step refers to it.
    """
    first = lambda s: F.nullif(F.regexp_extract(s["raw"], _FIRST, 0), F.lit(""))
    steps = F.transform(F.array(raw), lambda r: _struct(raw=r, alone=_alone(r)))
    if strict:
        steps = F.transform(steps, lambda s: _struct(raw=F.when(s["alone"], s["raw"]).otherwise(first(s)), alone=F.lit(True)))
    steps = F.transform(steps, lambda s: _struct(raw=s["raw"], alone=s["alone"], v=F.try_parse_json(s["raw"])))
    whole = lambda s: s["alone"] if strict else F.when(s["alone"], True).when(s["v"].isNotNull(), _closed(s["raw"]))
    steps = F.transform(steps, lambda s: _struct(raw=s["raw"], alone=whole(s), v=s["v"], root=F.schema_of_variant(s["v"])))

    def opened(s: Column) -> Column:
        flat = s["root"].rlike(_FLAT)
        is_object = s["root"].startswith("OBJECT") & (flat if strict else F.lit(True))
        some = lambda x: F.when(is_object, x)
        return _struct(
            shaped=s["alone"] & (is_object | (s["root"] == "VOID")),
            flat=flat,
            names=some(F.json_object_keys(s["raw"])),
            texts=some(s["v"].try_cast("map<string,string>")),
            values=F.when(~flat, some(s["v"].try_cast("map<string,variant>"))),
        )

    def picked(s: Column) -> Column:
        known = F.filter(F.transform(s["names"], lambda k: _struct(field=_folded(k), name=k)), lambda k: k["field"].isin(RAW_FIELDS))
        plain = lambda k: F.coalesce(F.schema_of_variant(F.element_at(s["values"], k["name"])).isin("STRING", "VOID"), F.lit(True))
        texts = F.filter(F.transform(known, lambda k: _struct(field=k["field"], text=F.element_at(s["texts"], k["name"]))), lambda x: x["text"].isNotNull())
        return _struct(good=s["shaped"] & (s["flat"] | s["names"].isNull() | F.forall(known, plain)), names=s["names"], texts=texts)

    last = lambda s, f: F.try_element_at(F.filter(s["texts"], lambda x: x["field"] == f), F.lit(-1))["text"]
    time = lambda text: F.when(text.rlike(RFC3339), F.try_to_timestamp(text))
    timed = lambda s: reduce(and_, [s[f].isNull() | s[f"_{f}"].isNotNull() for f in sorted(TIME_FIELDS)])
    good = lambda s: s["good"] & ~F.coalesce(unknown_fields(s["names"]), F.lit(False)) if strict else s["good"]
    steps = F.transform(F.transform(steps, opened), picked)
    steps = F.transform(steps, lambda s: _struct(good=good(s), names=s["names"], **{f: last(s, f) for f in RAW_FIELDS}))
    steps = F.transform(steps, lambda s: _struct(good=s["good"], names=s["names"], **{f: s[f] for f in RAW_FIELDS}, **{f"_{f}": time(s[f]) for f in sorted(TIME_FIELDS)}))
    return F.transform(steps, lambda s: _struct(ok=F.coalesce(s["good"] & timed(s), F.lit(False)), fields=s["names"], **{f: s[f"_{f}" if f in TIME_FIELDS else f] for f in RAW_FIELDS}))


def _columns(got: Column) -> dict[str, Column]:
    return {n: got[n] for n in ("ok", "fields", *RAW_FIELDS)}


def decode(raw: Column) -> dict[str, Column]:
    """Columns ``ok``, ``fields`` and one column a field (times as timestamps) of a raw message.

    Not ``ok``: not JSON, another root than an object or null, a known field of
    another type than string or null, or a time that is not RFC 3339.  Trailing
    text after the value fails too.  Names of fields match in any case; of
    several the last one that is not null counts.  An object that repeats a
    name letter by letter is not ``ok``.

    Each column holds the whole decoding; where several are used, ``decoded``
    does it once a row.
    """
    return _columns(_read(raw)[0])


def decode_strict(raw: Column) -> dict[str, Column]:
    """Like ``decode``, of the first value of a text alone; not ``ok`` too if a field is unknown.

    All known fields are strings, so a first value that can be accepted is a
    flat object of strings and nulls, or null.
    """
    return _columns(_read(raw, strict=True)[0])


def decoded(rows: DataFrame, raw: str, name: str, strict: bool = False) -> DataFrame:
    """Adds a struct of what ``decode`` or ``decode_strict`` gives; no later filter or column repeats the work."""
    return rows.select("*", F.explode(_read(F.col(raw), strict)).alias(name))


def unknown_fields(fields: Column) -> Column:
    """Fields that the strict decoder refuses."""
    return F.size(F.array_except(F.transform(fields, _folded), F.array(*(F.lit(f) for f in RAW_FIELDS)))) > 0


def encode(columns: list[Column]) -> Column:
    """Flat JSON of a row without empty strings and nulls."""
    return F.to_json(F.struct(*columns))


def rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def decode_enriched(raw: Column) -> Column:
    """Struct of an enriched message, null (skipped) if id, site_id or timestamp is missing or it is not JSON."""
    from ..schema import ENRICHED

    s = F.from_json(raw, ENRICHED)
    whole = F.try_parse_json(raw).isNotNull() & raw.rlike(_ROOT)
    filled = (F.coalesce(s["id"], F.lit("")) != "") & (F.coalesce(s["site_id"], F.lit("")) != "") & s["timestamp"].isNotNull() & (F.year(s["timestamp"]) > 1)
    return F.when(whole & filled, s)
