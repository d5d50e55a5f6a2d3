"""A list of element texts seen as a scalar or a list, whole number or text.

One value stands for itself, any other number of values for a list; whole
numbers are used only where every value is one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE_NUMBER = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"


def as_whole_number(text: Column) -> Column:
    """Long value of the text, null when it is no whole number or beyond 64 bits."""
    digits = F.trim(F.regexp_replace(text, r"[_\s]", ""))
    return F.when(text.rlike(_WHOLE_NUMBER), digits.try_cast("long"))


def scalarize(values: Column | str) -> Column:
    """struct(as_long, as_string, as_longs, as_strings), at most one of them set."""
    values = F.col(values) if isinstance(values, str) else values
    single = F.size(values) == 1
    first = F.get(values, F.lit(0))
    numbers = F.transform(values, as_whole_number)
    all_numbers = F.forall(numbers, lambda n: n.isNotNull())
    return F.struct(
        F.when(single, as_whole_number(first)).alias("as_long"),
        F.when(single & as_whole_number(first).isNull(), first).alias("as_string"),
        F.when(~single & all_numbers, numbers).alias("as_longs"),
        F.when(~single & ~all_numbers, values).alias("as_strings"),
    )


def json_value(values: Column | str) -> Column:
    """JSON text of the scalar-or-list view; a null list gives ``null``."""
    view = scalarize(values)

    def quoted(text: Column) -> Column:
        # to_json of a one-element list, without its brackets, is the JSON string.
        listed = F.to_json(F.array(text))
        return F.coalesce(F.substr(listed, F.lit(2), F.length(listed) - 2), F.lit("null"))

    return F.coalesce(
        view["as_long"].cast("string"),
        F.when(view["as_longs"].isNotNull(), F.to_json(view["as_longs"])),
        F.when(view["as_strings"].isNotNull(), F.to_json(view["as_strings"])),
        F.when(view["as_string"].isNotNull(), quoted(view["as_string"])),
        F.lit("null"),
    )
