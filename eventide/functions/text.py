"""Column expressions for record payloads.

All of these are native Catalyst expressions (no Python UDF), so they run
inside whole-stage codegen and work unchanged on streaming DataFrames.

The reference parses text with ``java.lang.String`` methods; the helpers below
reproduce those semantics where Spark's built-ins differ:

* ``String.split(regex)`` drops trailing empty strings and returns
  ``[input]`` when the pattern never matches; Spark's ``split`` keeps trailing
  empties.
* ``String.substring(a, b)`` throws on short input; Spark truncates.
* ``Integer.parseInt`` rejects surrounding blanks; Spark's cast trims them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
TOKEN_SEPARATOR = " "            # word tokenizer splits on one space
LOG_FIELD_SEPARATOR = r"\|~\|"   # log line fields: <time>|~|<any>|~|<uri>
URI_PIECE_SEPARATOR = "[=|&]"    # uri split; piece 1 = user, piece 3 = site
THREE_FIELD_SEPARATOR = r"\|\|"  # f0||f1||f2
HOUR_PREFIX_LEN = 13             # yyyy-MM-ddTHH
USER_PIECE, SITE_PIECE = 1, 3    # positions in the uri pieces
DAY_PREFIX_LEN = 10              # yyyy-MM-dd
DATE_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
COMPACT_FORMAT = "yyyyMMddHHmmss"
INT_TEXT_PATTERN = r"^[+-]?[0-9]+\z"  # \z: `$` would also match before a final newline


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c: Column | str, pattern: str) -> Column:
    """``String.split(pattern)`` (limit 0) as an array expression.

    Spark's split keeps trailing empty strings; Java drops them, except that
    an input with no match at all comes back whole (``"" -> [""]``).
    """
    parts = F.split(_c(c), pattern, -1)
    last_non_empty = F.array_max(
        F.transform(parts, lambda x, i: F.when(x != "", i).otherwise(F.lit(-1))))
    return F.when(F.size(parts) == 1, parts).otherwise(
        F.slice(parts, 1, last_non_empty + 1))


def space_tokens(c: Column | str) -> Column:
    """``value.split(" ")``: the word tokenizer of the word-count jobs.

    Java drops the trailing empty strings, i.e. the trailing run of spaces:
    ``rtrim`` (which strips ASCII spaces only, not tabs or newlines) followed
    by a plain split gives the same tokens without a regex pass. ``"" -> [""]``
    and ``"  " -> []`` as in Java; inner double spaces give empty tokens;
    newlines stay inside tokens.
    """
    v = _c(c)
    trimmed = F.rtrim(v)
    return (F.when(v == "", F.array(F.lit("")))
             .when(trimmed == "", F.array().cast("array<string>"))
             .otherwise(F.split(trimmed, TOKEN_SEPARATOR, -1)))


def text_chunks(c: Column | str, min_chars: int) -> Column:
    """Cut a text into pieces for :func:`chunk_tokens`, token-preserving.

    The text is right-trimmed of spaces (Java's trailing-empty rule), then cut
    into pieces of at least ``min_chars`` characters that end at a space (the
    cut space stays at the piece's end); the last piece takes the rest.
    ``""`` gives ``[""]`` and an all-space text ``[]``, as :func:`space_tokens`.
    """
    v = _c(c)
    trimmed = F.rtrim(v)
    pattern = f"(?s).{{{int(min_chars)},}}? |.+"
    return (F.when(v == "", F.array(F.lit("")))
             .when(trimmed == "", F.array().cast("array<string>"))
             .otherwise(F.regexp_extract_all(trimmed, F.lit(pattern), 0)))


def chunk_tokens(chunk: Column | str) -> Column:
    """Tokens of one piece of :func:`text_chunks`: drop the cut space, then
    split keeping every empty token (the text goes on after the cut)."""
    v = _c(chunk)
    body = F.when(v.endswith(" "), F.substring(v, F.lit(1), F.length(v) - 1)).otherwise(v)
    return F.split(body, TOKEN_SEPARATOR, -1)


def guarded_prefix(c: Column | str, n: int) -> Column:
    """``s.substring(0, n)``, null where Java would throw (shorter input)."""
    v = _c(c)
    return F.when(F.length(v) >= n, F.substring(v, 1, n))


def day_key(c: Column | str) -> Column:
    """Day of a record key: its first 10 characters (``yyyy-MM-dd``)."""
    return guarded_prefix(c, DAY_PREFIX_LEN)


def log_field_array(value: Column | str) -> Column:
    """Every field of a log line, empty ones included.

    A log line is ``<time>|~|<any>|~|<uri>``. The record is hour = first 13
    characters of field 0 with every ``T`` replaced by ``-`` (see
    :func:`log_hour`); the uri (field 2) is split on any of ``=``, ``|``,
    ``&`` and piece 1 is the user, piece 3 the site, whatever the parameter
    names are. A line with a short time, fewer than three fields or fewer
    than four uri pieces is dropped; empty pieces are kept.
    """
    return F.split(_c(value), LOG_FIELD_SEPARATOR, -1)


def uri_piece_array(uri: Column | str) -> Column:
    """The pieces of a uri between its separators, empty ones included."""
    return F.split(_c(uri), URI_PIECE_SEPARATOR, -1)


def log_hour(time_field: Column | str) -> Column:
    """The time up to the hour, date and hour joined by ``-``; null when too short."""
    return F.replace(guarded_prefix(time_field, HOUR_PREFIX_LEN), F.lit("T"), F.lit("-"))


def three_fields(value: Column | str) -> list[Column]:
    """The first three fields of a delimited value.

    Plain indexing: with ANSI mode on, a record with fewer than three fields
    raises ``INVALID_ARRAY_INDEX`` and fails the batch, as in the reference.
    Extra fields are ignored.
    """
    parts = java_split(value, THREE_FIELD_SEPARATOR)
    return [parts[0], parts[1], parts[2]]


def strict_int(c: Column | str, strict: bool = True) -> Column:
    """``String.toInt``: optional sign and digits only.

    strict=True raises on anything else (the reference fails the batch);
    strict=False yields null so the caller can drop the row.
    """
    v = _c(c)
    ok = v.rlike(INT_TEXT_PATTERN)
    if strict:
        return F.when(ok, v.cast("int")).otherwise(
            F.raise_error(F.concat(F.lit("not an integer reading: "), v)).cast("int"))
    return F.when(ok, v.try_cast("int"))


def fixed_position(value: Column | str) -> tuple[Column, Column]:
    """``(s.substring(0, 8), s.substring(9))``; character 8 is dropped.

    Null where Java would throw (input shorter than 8, resp. 9, characters).
    """
    v = _c(value)
    head = guarded_prefix(v, 8)
    tail = F.when(F.length(v) >= 9, F.substring(v, 10, 1 << 30))
    return head, tail


def text_to_epoch_millis(c: Column | str, fmt: str = DATE_TEXT_FORMAT,
                         zone: str = "UTC") -> Column:
    """Date text in ``fmt`` read in ``zone`` -> epoch milliseconds.

    The zone is appended to the text so the result does not depend on the
    session or executor time zone.
    """
    return F.unix_millis(F.to_timestamp(F.concat(_c(c), F.lit(" " + zone)), fmt + " VV"))


def text_to_compact(c: Column | str, fmt: str = DATE_TEXT_FORMAT,
                    target: str = COMPACT_FORMAT) -> Column:
    """Reformat date text, ``yyyy-MM-dd HH:mm:ss`` -> ``yyyyMMddHHmmss``.

    Goes through ``timestamp_ntz``, so no time zone is involved.
    """
    return F.date_format(F.to_timestamp_ntz(_c(c), F.lit(fmt)), target)
