"""Projections, labels, coercions and keys."""

from __future__ import annotations

import hashlib
import logging
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqspark.plans.joins import quoted

log = logging.getLogger(__name__)

# Labels, prefixes and names of output columns.
EMPTY_LABEL = "<empty>"
PARTITION_PREFIX = "partition."
OBJECT_PREFIX = "object."
INDICATOR_PREFIX = "_indicator_"
WHITESPACE = " \t\n\r\x0b\x0c"
RANGE_COLUMNS = (
    "_result_min_ts",
    "_result_max_ts",
    "_lookback_range_end_ts",
    "_lookback_range_start_ts",
)


# -- selection -----------------------------------------------------------------------------------


def existing(available: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """The wanted names that exist, in the wanted order; a warning for each of the others."""
    known = set(available)
    for name in wanted:
        if name not in known:
            log.warning("column %s is not in the dataset", name)
    return [name for name in wanted if name in known]


def tolerant_select(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(quoted(c)) for c in existing(df.columns, wanted)])


def aliased(field: str | Mapping[str, str]) -> Column:
    """``"col"`` or ``{"col": "alias"}`` as a named column; the column part may be any expression."""
    if isinstance(field, str):
        name = field.strip()
        return F.expr(name).alias(name)
    if len(field) != 1:
        raise ValueError("an aliased field names exactly one column")
    ((expression, alias),) = field.items()
    return F.expr(expression.strip()).alias(alias.strip())


def group_name(field: str | Mapping[str, str]) -> str:
    return field.strip() if isinstance(field, str) else next(iter(field.values())).strip()


def common_names(left: Sequence[str], right: Sequence[str]) -> list[str]:
    """Names in both lists, in the order of the first."""
    other = set(right)
    return [name for name in left if name in other]


def common_fields(record: Column, names: Sequence[str]) -> Column:
    """Of the given names, those that are keys of a JSON object text; empty for any other text."""
    keys = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    return F.array_intersect(F.array(*[F.lit(n) for n in names]).cast("array<string>"), keys)


def add_path_fields(df: DataFrame, fields: Mapping[str, str | Column]) -> DataFrame:
    """Add fields of the object path as columns.

    Where a file column has the same name, the file's becomes ``object.<name>`` and the path's
    ``partition.<name>``; other path fields keep their bare name.
    """
    clashes = set(common_names(df.columns, list(fields)))
    renamed = [F.col(quoted(c)).alias(OBJECT_PREFIX + c if c in clashes else c) for c in df.columns]
    added = [
        (value if isinstance(value, Column) else F.lit(value)).alias(
            PARTITION_PREFIX + name if name in clashes else name
        )
        for name, value in fields.items()
    ]
    return df.select(*renamed, *added)


def resolve_name(name: str, file_columns: Sequence[str], path_fields: Sequence[str]) -> str:
    """Column that a configured name means after :func:`add_path_fields`."""
    clashes = set(common_names(file_columns, path_fields))
    for prefix, owner in ((OBJECT_PREFIX, file_columns), (PARTITION_PREFIX, path_fields)):
        bare = name.removeprefix(prefix)
        if name.startswith(prefix) and bare in owner:
            return name if bare in clashes else bare
    return PARTITION_PREFIX + name if name in clashes else name


# -- dimensions ----------------------------------------------------------------------------------


def object_dimension(df: DataFrame, path: str) -> Column:
    """Field ``parent.child`` of a struct, map or JSON text column, ``""`` where it is missing."""
    parent, child = path.split(".", 1)
    kind = df.schema[parent].dataType
    if isinstance(kind, T.StructType):
        found = F.col(quoted(parent)).getField(child) if child in kind.names else F.lit(None)
    elif isinstance(kind, T.MapType):
        found = F.try_element_at(F.col(quoted(parent)), F.lit(child))
    elif isinstance(kind, T.StringType):
        found = F.get_json_object(F.col(quoted(parent)), f"$['{child}']")
    else:
        found = F.lit(None)
    return F.coalesce(found.cast("string"), F.lit("")).alias(path)


def list_dimension(df: DataFrame, column: str, index: int, field: str) -> Column:
    """Field of one element of a list of structs or maps, ``""`` where it is missing."""
    element = df.schema[column].dataType.elementType
    if index < 0:
        item = F.try_element_at(F.col(quoted(column)), F.lit(index))
    else:
        item = F.get(F.col(quoted(column)), F.lit(index))
    if isinstance(element, T.StructType) and field in element.names:
        found = item.getField(field)
    elif isinstance(element, T.MapType):
        found = F.try_element_at(item, F.lit(field))
    else:
        found = F.lit(None)
    return F.coalesce(found.cast("string"), F.lit(""))


def strip(c: Column) -> Column:
    """The text without leading and trailing white space of any kind."""
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def label(column: Column | str) -> Column:
    """Trimmed text; NULL and blank become ``<empty>``."""
    c = F.col(quoted(column)) if isinstance(column, str) else column
    return F.coalesce(F.nullif(strip(c), F.lit("")), F.lit(EMPTY_LABEL))


# -- numbers -------------------------------------------------------------------------------------


def to_number(df: DataFrame, column: str) -> Column:
    """The column as double; text that is no number and NaN become NULL."""
    c = F.col(quoted(column))
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return _text_to_number(c)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c.cast("double"))
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def _text_to_number(c: Column) -> Column:
    # A cast also takes Java's type suffixes ("1.5d"), which are no numbers here.
    suffixed = strip(c).rlike("[0-9.][dDfF]$")
    number = F.nullif(strip(c).try_cast("double"), F.lit(float("nan")))
    return F.when(~suffixed, number)


def present(df: DataFrame, column: str) -> Column:
    """The column with NaN as NULL, for null counting."""
    c = F.col(quoted(column))
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def inferred_type(c: Column) -> Column:
    """``integer``, ``number`` or ``string``: what the text of a path field holds."""
    number = _text_to_number(c)
    whole = (number == F.floor(number)) & (F.abs(number) < F.lit(9.2e18))
    nan = F.lower(strip(c)).isin("nan", "+nan", "-nan")
    return (
        F.when(F.coalesce(whole, F.lit(False)), F.lit("integer"))
        .when(number.isNotNull() | nan, F.lit("number"))
        .when(c.isNotNull(), F.lit("string"))
    )


def inferred_value(c: Column) -> Column:
    """Struct with the value under the inferred type: ``as_integer``, ``as_number``, ``as_string``."""
    kind, number = inferred_type(c), _text_to_number(c)
    return F.struct(
        F.when(kind == "integer", number.try_cast("bigint")).alias("as_integer"),
        F.when(kind == "number", number).alias("as_number"),
        F.when(kind == "string", c).alias("as_string"),
    )


# -- text keys -----------------------------------------------------------------------------------


def list_fingerprint(c: Column, delimiter: str = ",") -> Column:
    """sha1 of the sorted, trimmed items of a delimited list; empty for an empty list."""
    items = F.transform(F.split(c, re.escape(delimiter)), strip)
    digest = F.sha1(F.array_join(F.array_sort(items), delimiter).cast("binary"))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).otherwise(digest)


def text_fingerprint(text: str, delimiter: str = ",") -> str:
    """Driver-side form of :func:`list_fingerprint`, for column names."""
    if not text:
        return ""
    items = sorted(item.strip() for item in text.split(delimiter))
    return hashlib.sha1(delimiter.join(items).encode()).hexdigest()


def metric_key(aggregate: str, column: str, dimensions: Sequence[str], source_id: str, dataset: str) -> str:
    """``<aggregate>|<column>|<hash>``, the hash being that of dimensions, source and dataset."""
    tail = f"{'|'.join(dimensions)}|{source_id}|{dataset}"
    return f"{aggregate}|{column}|{text_fingerprint(tail, '|')}"


TEMPLATE_FIELD = re.compile(r"\{([^{}]+)\}")


def template_fields(template: str) -> list[str]:
    return TEMPLATE_FIELD.findall(template)


def fill_template(template: str) -> Column:
    """Text of a ``{a}-{b}`` template with the row's values; NULL when one of them is NULL."""
    parts: list[Column] = []
    for position, piece in enumerate(TEMPLATE_FIELD.split(template)):
        if position % 2:
            parts.append(F.col(quoted(piece)).cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


# -- output names --------------------------------------------------------------------------------


def with_role_names(
    metrics: DataFrame, dimensions: Sequence[str], time_columns: Sequence[str], primary: str | None
) -> DataFrame:
    """Prefix dimensions with ``dim|`` and times with ``time|`` or ``primary_time|``."""
    names = {c: f"dim|{c}" for c in dimensions if c in metrics.columns}
    names |= {
        c: f"primary_time|{c}" if c == primary else f"time|{c}" for c in time_columns if c in metrics.columns
    }
    return metrics.withColumnsRenamed(names)


def lower_reserved(result: DataFrame) -> DataFrame:
    """Lower-case the time-range and indicator columns, whatever case the engine gave them."""
    names = {
        c: c.lower()
        for c in result.columns
        if c.lower() in RANGE_COLUMNS or c.lower().startswith(INDICATOR_PREFIX)
    }
    return result.withColumnsRenamed(names)


# -- exports -------------------------------------------------------------------------------------


def to_base64_text(c: Column, kind: T.DataType) -> Column:
    """base64 of a sketch, or of the text of a count, on one line."""
    text = F.base64(c if isinstance(kind, T.BinaryType) else c.cast("string").cast("binary"))
    return F.translate(text, "\r\n", "")


def safe_stddev(c: Column) -> Column:
    """Sample deviation of anything that reads as a number."""
    return F.stddev_samp(c.try_cast("double"))


def date_epoch(c: Column) -> Column:
    """Epoch seconds at the midnight of a date-like text; NULL when it is no date."""
    return F.unix_date(c.try_cast("date")).cast("bigint") * 86400
