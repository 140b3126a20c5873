"""Text helpers: the reference's string forms as Spark expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_space_split(line) -> Column:
    """Tokens of ``line.split(" ")`` with Java semantics, as an array.

    Java keeps leading and inner empty tokens, drops trailing ones, and an
    empty input yields one empty token.  Spark's ``split`` keeps trailing
    empties, so the trailing blanks are trimmed first.
    """
    v = _col(line)
    rt = F.rtrim(v, F.lit(" "))
    return (F.when(v == F.lit(""), F.array(F.lit("")))
             .when(rt == F.lit(""), F.array().cast("array<string>"))
             .otherwise(F.split(rt, " ")))


def split_lines(text) -> Column:
    """Lines of a text column split on newline (every piece kept)."""
    return F.split(_col(text), "\n")


# Fixed value: the click event's text form, {user='u', action='a', times=123}.
EVENT_FORMAT = "{user='%s', action='%s', times=%d}"


def event_string(user, action, times) -> Column:
    """The click event's text form."""
    return F.format_string(EVENT_FORMAT, _col(user), _col(action), _col(times))


def pair_string(a, b) -> Column:
    """A two-field tuple's text form: (a,b)."""
    return F.concat(F.lit("("), _col(a).cast("string"), F.lit(","), _col(b).cast("string"), F.lit(")"))
