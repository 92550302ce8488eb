"""Typed access to JSON documents held as VARIANT."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# A parsed document sits in element 0 of an envelope array, see strict_envelope.
DOCUMENT = "$[0]"

_NONFINITE = "~nonfinite:"

# Finds a bare NaN / Infinity outside string literals: everything from the end of
# the last match is consumed possessively, strings as a whole, so no backtracking.
_BARE_NONFINITE = (
    r'\G((?:[^"NI-]++|"(?:[^"\\]++|\\.)*+"|-(?!Infinity)|N(?!aN)|I(?!nfinity))*+)'
    r"(NaN|-?Infinity)(?!\s*+:)"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strict_envelope(text: Column) -> Column:
    """Parse ``text`` inside ``[text, length, 0]``.

    The JSON parser stops after the first complete value, so trailing garbage or a
    second document would pass unnoticed. In the envelope either one breaks the
    array or moves the length away from position 1; see envelope_is_strict.
    """
    return F.try_parse_json(
        F.concat(F.lit("["), text, F.lit(","), F.octet_length(text).cast("string"), F.lit(",0]"))
    )


def envelope_is_strict(envelope: Column, text: Column) -> Column:
    return F.coalesce(
        (F.try_variant_get(envelope, "$[1]", "bigint") == F.octet_length(text))
        & (F.try_variant_get(envelope, "$[2]", "bigint") == 0),
        F.lit(False),
    )


def quote_nonfinite(text: Column) -> Column:
    """Turn bare NaN / Infinity tokens into marked strings; NULL if there are none."""
    return F.when(
        text.contains("NaN") | text.contains("Infinity"),
        F.regexp_replace(text, _BARE_NONFINITE, f'$1"{_NONFINITE}$2"'),
    )


# Limits of the parser: characters of one string, and bytes of a document.
MAX_STRING = 20_000_000
MAX_DOCUMENT = 128 * 1024 * 1024


def has_long_string(text: Column) -> Column:
    """Whether a string literal is longer than the parser takes; only to be asked of texts that it refused."""
    unescaped = F.regexp_replace(text, r"\\.", "")
    longest = F.array_max(F.transform(F.split(unescaped, '"'), F.length))
    return F.when(F.octet_length(text) > MAX_STRING, longest > MAX_STRING).otherwise(False)


@dataclass(frozen=True)
class Document:
    """A parsed document: its envelope, and the members that are asked for in a struct.

    Each walk along a path copies the whole document first, so the members are taken out in one.
    """

    envelope: Column
    members: Column
    kinds: Mapping[str, str]

    @staticmethod
    def members_of(envelope: Column, kinds: Mapping[str, str]) -> Column:
        """Members of the document by name, each as the type in ``kinds``; NULL where it is missing or of another type."""
        fields = ", ".join(f"`{key.replace('`', '``')}`: {kind}" for key, kind in kinds.items())
        return F.try_variant_get(envelope, DOCUMENT, f"struct<{fields}>")

    def field(self, *keys: str) -> Column:
        """Member of the document: NULL if missing, a variant null if it is a JSON null."""
        first = self._first(keys)
        if first is None:
            return F.try_variant_get(self.envelope, DOCUMENT + _path(keys), "variant")
        return first if len(keys) == 1 else F.try_variant_get(first, "$" + _path(keys[1:]), "variant")

    def field_map(self, *keys: str) -> Column:
        """Members of an object in the document; NULL if it is missing or not an object."""
        if len(keys) == 1 and self.kinds.get(keys[0], "").startswith("map<"):
            return self.members[keys[0]]
        first = self._first(keys)
        if first is None:
            return F.try_variant_get(self.envelope, DOCUMENT + _path(keys), "map<string,variant>")
        return F.try_variant_get(first, "$" + _path(keys[1:]), "map<string,variant>")

    def has(self, key: str) -> Column:
        """Whether there is such a member of any type."""
        kind = self.kinds.get(key)
        if kind is None or kind == "variant":
            return self.field(key).isNotNull()
        return self.members[key].isNotNull() | F.try_variant_get(self.envelope, DOCUMENT + _path((key,)), "variant").isNotNull()

    def _first(self, keys: tuple[str, ...]) -> Column | None:
        return self.members[keys[0]] if self.kinds.get(keys[0]) == "variant" else None


def _path(keys: tuple[str, ...]) -> str:
    return "".join(f"[{_quote(key)}]" for key in keys)


def _quote(key: str) -> str:
    mark = '"' if "'" in key else "'"
    return f"{mark}{key}{mark}"


def as_map(value: Column) -> Column:
    """Members of an object; NULL for anything that is not an object."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def is_present(value: Column) -> Column:
    """Present and not a JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def not_object(value: Column) -> Column:
    """True for a present value of any other type, JSON null included."""
    return value.isNotNull() & as_map(value).isNull()


def type_tag(value: Column) -> Column:
    """First three letters of the variant type; NULL for a missing value."""
    return F.substring(F.schema_of_variant(value), 1, 3)


def _numeric_tag(value: Column) -> Column:
    """BIGINT, DECIMAL, DOUBLE or BOOLEAN.

    One search in a constant: inside lambdas an IN list is far slower.
    """
    return F.instr(F.lit("BIG DEC DOU BOO"), type_tag(value)) > 0


def number(value: Column, quoted: Column) -> Column:
    """Double for numbers and booleans, NULL for every other type.

    A plain cast would also accept numeric strings. In repaired documents the marked
    non-finite numbers count too.
    """
    return F.when(_numeric_tag(value), F.try_variant_get(value, "$", "double")).when(
        quoted & text_of(value).startswith(_NONFINITE),
        F.substring(text_of(value), len(_NONFINITE) + 1, 9).try_cast("double"),
    )


def text_of(value: Column) -> Column:
    """String of a JSON string, NULL for every other type."""
    return F.when(type_tag(value) == "STR", F.try_variant_get(value, "$", "string"))
