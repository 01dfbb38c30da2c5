"""Header bytes to typed message fields, and back to user properties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schema import (
    CONTENT_TYPE_HEADER,
    DEFAULT_HEADER_PREFIX,
    PARTITION_KEY_PROPERTY,
    SYSTEM_HEADERS,
    Header,
)

_SQL_TYPES = {"long": "bigint", "int": "int", "boolean": "boolean", "string": "string",
              "binary": "binary"}
_WHOLE_NUMBER = "^[+-]?[0-9]+$"


def _bytes(name: str, headers: str) -> Column:
    return F.element_at(headers, F.lit(name))


def _text(name: str, headers: str) -> Column:
    """A header's bytes as text; numbers and flags are read from it as it is."""
    return _bytes(name, headers).cast("string")


def _number(text: Column, kind: str) -> Column:
    return F.when(text.rlike(_WHOLE_NUMBER), text.try_cast(_SQL_TYPES[kind]))


def _parse(header: Header, prefix: str, headers: str) -> Column:
    name = prefix + header.name
    text = _text(name, headers)
    if header.type in ("long", "int"):
        return _number(text, header.type)
    if header.type == "boolean":
        # Anything but "true" is false; an absent header stays null.
        value = F.lower(text) == "true"
        return value if header.default is None else F.coalesce(value, F.lit(header.default))
    if header.type == "string":
        return F.make_valid_utf8(text)
    return _bytes(name, headers)


def header_problem(prefix: str = DEFAULT_HEADER_PREFIX, headers: str = "Headers") -> Column:
    """Name of the first header, by name, that cannot be set from its bytes; null when all can.

    One pass over the entries. The map appears once in the expression, so that a filter pushed below
    the projection that builds it does not build it once per header.
    """
    writable = [h for h in SYSTEM_HEADERS if h.writable]

    def named(kind: str) -> list[str]:
        return [prefix + h.name for h in writable if h.type == kind]

    def bad(entry: Column) -> Column:
        text = entry["value"].cast("string")
        return (
            (entry["key"].isin(named("long")) & _number(text, "long").isNull())
            | (entry["key"].isin(named("int")) & _number(text, "int").isNull())
            | entry["key"].isin(named("destination"))
        )

    tested = named("long") + named("int") + named("destination")
    few = F.map_entries(F.map_filter(headers, lambda k, _: k.isin(tested)))
    names = F.transform(F.filter(few, bad), lambda entry: entry["key"])
    return F.substring(F.array_min(names), F.lit(len(prefix) + 1), F.lit(2**31 - 1))


def typed_headers(
    prefix: str = DEFAULT_HEADER_PREFIX, headers: str = "Headers", strict: bool = False
) -> dict[str, Column]:
    """Every writable header as a typed column, keyed by header name.

    A value that does not parse is null, or fails the query with ``strict``. Headers that only the
    broker may set are ignored.
    """
    fields = {}
    for header in SYSTEM_HEADERS:
        if not header.writable or header.type == "destination":
            continue
        value = _parse(header, prefix, headers)
        if strict and header.type in ("long", "int"):
            present = _bytes(prefix + header.name, headers).isNotNull()
            problem = F.raise_error(F.lit(f"header {prefix}{header.name} is not a whole number"))
            value = F.when(
                present & value.isNull(), problem.cast(_SQL_TYPES[header.type])
            ).otherwise(value)
        fields[header.name] = value
    fields["contentType"] = F.make_valid_utf8(_text(CONTENT_TYPE_HEADER, headers))
    if strict:
        reply = _bytes(prefix + "replyTo", headers)
        fields["contentType"] = F.when(
            reply.isNotNull(), F.raise_error(F.lit(f"header {prefix}replyTo has no byte form"))
            .cast("string"),
        ).otherwise(fields["contentType"])
    return fields


def user_properties(
    prefix: str = DEFAULT_HEADER_PREFIX,
    headers: str = "Headers",
    partition_key: str | None = "PartitionKey",
) -> Column:
    """Headers that travel as user properties: all but system ones, plus the partition key."""
    none = F.create_map().cast("map<string,binary>")
    kept = F.coalesce(
        F.map_filter(headers, lambda k, _: ~k.startswith(prefix)), none
    )
    if partition_key is None:
        return kept
    key = F.col(partition_key)
    keyed = F.when(
        key.isNotNull() & (key != ""),
        F.map_concat(
            F.map_filter(kept, lambda k, _: k != PARTITION_KEY_PROPERTY),
            F.create_map(F.lit(PARTITION_KEY_PROPERTY), key.cast("binary")),
        ),
    )
    return F.coalesce(keyed, kept)
