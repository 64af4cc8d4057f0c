"""Scalar expressions.  Every function takes and returns Spark columns; none uses a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a browser strips in trim() and matches with \s, and where its ``.`` stops.
WHITESPACE = (
    "\t\n\x0b\x0c\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
LINE_ENDS = "\n\r\u2028\u2029"

# Fixed values of labels, entries and directories.
SEPARATOR = "·"
DEFAULT_LABEL = "Slide"
HEADING_CHARS = 40
MODULE_ROOT = "apps."
MODULE_APP = ".main:app"
STATIC_DIR = "dist"

_SPACE_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"
_NOT_LINE_END = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in LINE_ENDS) + "]"
_JSON_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_JSON_END = "end of text"


# Fixed format of a diagnostic line: file, line, column, message.
_DIAGNOSTIC = r"\A([^:\n]+):([0-9]+):([0-9]+): ([^\n]*)\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_space(c) -> Column:
    """Trim every Unicode space a browser trims, not only U+0020."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def slug_to_module(c) -> Column:
    """Directory and module name of a slug: hyphens become underscores."""
    return F.translate(_col(c), "-", "_")


def canonical_path(group, slug) -> Column:
    """``/group/slug``; null when either part is null."""
    return F.concat(F.lit("/"), _col(group), F.lit("/"), _col(slug))


def entry_module(entry) -> Column:
    """Module of ``module:attr``; null unless there is exactly one colon."""
    parts = F.split(_col(entry), ":")
    return F.when(F.size(parts) == 2, F.try_element_at(parts, F.lit(1)))


def entry_attr(entry) -> Column:
    """Attribute of ``module:attr``; null unless there is exactly one colon."""
    parts = F.split(_col(entry), ":")
    return F.when(F.size(parts) == 2, F.try_element_at(parts, F.lit(2)))


def default_if_absent(value, present, field: str, default) -> Column:
    """The default only when the field is absent; an explicit null stays null."""
    return F.when(~F.array_contains(_col(present), field), F.lit(default)).otherwise(_col(value))


def default_entry(kind, group, slug) -> Column:
    """Entry point a new backend or fullstack record gets."""
    module = F.concat(
        F.lit(MODULE_ROOT), slug_to_module(group), F.lit("."), slug_to_module(slug), F.lit(MODULE_APP)
    )
    return F.when(_col(kind).isin("backend", "fullstack"), module)


def default_static_dir(kind) -> Column:
    """Static directory a new frontend or fullstack record gets."""
    return F.when(_col(kind).isin("frontend", "fullstack"), F.lit(STATIC_DIR))


def zero_pad(c, width: int = 2) -> Column:
    """Left pad with zeros; longer text is kept whole."""
    text = _col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def strip_suffix(c, mark: str = SEPARATOR) -> Column:
    """Drop the first ``mark`` and the rest of its line, then trim.

    Only the first mark of the whole text counts; the lines after it stay.
    """
    first = rf"(?s)\A(.*?)\Q{mark}\E{_NOT_LINE_END}*"
    return strip_space(F.regexp_replace(_col(c), first, "$1"))


def label_fallback(explicit, existing, heading) -> Column:
    """Explicit label, else the existing one without its number, else the heading, else a constant."""
    existing = _col(existing)
    bare = strip_space(
        F.regexp_replace(existing, rf"\A{_SPACE_CLASS}*[0-9]+{_SPACE_CLASS}*", "")
    )
    return F.coalesce(
        F.nullif(_col(explicit), F.lit("")),
        F.nullif(bare, F.lit("")),
        F.nullif(existing, F.lit("")),
        F.nullif(F.substring(strip_space(heading), 1, HEADING_CHARS), F.lit("")),
        F.lit(DEFAULT_LABEL),
    )


def clamp(i, n) -> Column:
    """Index limited to ``[0, n-1]``; null stays null (greatest/least alone would skip it)."""
    i, n = _col(i), F.lit(n) if isinstance(n, int) else _col(n)
    return F.when(i.isNotNull(), F.greatest(F.lit(0), F.least(n - 1, i)))


def bounded_index(fragment, n, default=0) -> Column:
    """``#<int>`` as a 0-based index when it lies in ``[0, n)``, else the default."""
    n = F.lit(n) if isinstance(n, int) else _col(n)
    digits = F.regexp_extract(_col(fragment), r"\A#([0-9]+)\z", 1)
    index = digits.try_cast("bigint") - 1
    return F.when(index.between(0, n - 1), index).otherwise(F.lit(default).cast("bigint"))


def json_array(c) -> Column:
    """JSON array text as ``array<string>``; malformed or non-array text gives an empty array.

    Spark's parser stops after the first value, so the text is also parsed as the first item of a
    two-item array, whose second item is lost if anything follows the text.
    """
    c = _col(c)
    empty = F.array().cast("array<string>")
    wrapped = F.from_json(
        F.concat(F.lit("["), c, F.lit(f',"{_JSON_END}"]')), "array<string>", _JSON_STRICT
    )
    whole = (F.size(wrapped) == 2) & (F.try_element_at(wrapped, F.lit(2)) == _JSON_END)
    return F.when(
        whole, F.coalesce(F.from_json(c, "array<string>", _JSON_STRICT), empty)
    ).otherwise(empty)


def join_members(c) -> Column:
    """List as text, items separated by ``", "``."""
    return F.array_join(_col(c), ", ")


def direction(index, previous) -> Column:
    """-1 when moving back, else 1; no movement or an unknown position counts as forward."""
    return F.when(_col(index) < _col(previous), F.lit(-1)).otherwise(F.lit(1))


def link(status, mount_path) -> Column:
    """The path to open, only for records that are online."""
    return F.when(_col(status) == "online", _col(mount_path))


def badge(status) -> Column:
    """The status text, only for records that are not online."""
    return F.when(_col(status) != "online", _col(status))


def diagnostic(c) -> Column:
    """``file:line:col: message`` as a struct; all four fields are null when it does not parse."""
    c = _col(c)
    number = [F.regexp_extract(c, _DIAGNOSTIC, g).try_cast("int") for g in (2, 3)]
    ok = c.rlike(_DIAGNOSTIC) & number[0].isNotNull() & number[1].isNotNull()
    return F.struct(
        F.when(ok, F.regexp_extract(c, _DIAGNOSTIC, 1)).alias("file"),
        F.when(ok, number[0]).alias("line"),
        F.when(ok, number[1]).alias("col"),
        F.when(ok, F.regexp_extract(c, _DIAGNOSTIC, 4)).alias("message"),
    )


def path_parts(path) -> Column:
    """Path components.  Arrays compare item by item, so this is the catalogue's sort key."""
    return F.split(_col(path), "/")
