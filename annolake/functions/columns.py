"""Column expressions: names, spans, paths, durations, nulls, flags, keys.

All are built-in Spark expressions (JVM side, inside whole-stage codegen); none
is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source tool's for equal results)
# ---------------------------------------------------------------------------
# Words read as missing in hand-made CSV tables (the pandas default list).
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Values that mark a discarded child or recording.
DISCARD_TRUE = ("1", "1.0", "true")
# Days per month used for ages.
DAYS_PER_MONTH = 365.25 / 12


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- F1 / F5 ---------------------------------------------------------------

def is_discarded(c) -> Column:
    """One predicate for '1', 1, 1.0, true (null is kept)."""
    v = F.lower(F.trim(_c(c).cast("string")))
    return F.coalesce(v.isin(*DISCARD_TRUE), F.lit(False))


def drop_discarded(df: DataFrame, col: str = "discard") -> DataFrame:
    """keep rows not marked discarded; a table without the column is kept whole."""
    if col not in df.columns:
        return df
    return df.filter(~is_discarded(col))


def nullify(c, vocab: Iterable[str] = NULL_WORDS) -> Column:
    """strings from the null vocabulary become null."""
    col = _c(c)
    return F.when(F.trim(col.cast("string")).isin(*list(vocab)), F.lit(None)).otherwise(col)


# --- P2 span from a file name ------------------------------------------------

_SPAN_RE = r"_(-?\d+)_(-?\d+)(\.[^_/]*)?$"


def span_from_name(c) -> tuple[Column, Column]:
    """``a_b_<start>_<end>.csv`` -> (start, end) as longs; null when absent."""
    col = _c(c)
    ok = col.rlike(_SPAN_RE)
    start = F.when(ok, F.regexp_extract(col, _SPAN_RE, 1).try_cast("long"))
    end = F.when(ok, F.regexp_extract(col, _SPAN_RE, 2).try_cast("long"))
    return start, end


def span_duration_from_name(c) -> Column:
    s, e = span_from_name(c)
    return e - s


# --- P3 / P4 / P5 paths ----------------------------------------------------

def lit_path(*parts) -> Column:
    """Join path parts with '/': strings are literals, Columns are columns
    (a null column part is skipped)."""
    return F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def path_for(*parts) -> Column:
    """Like :func:`lit_path` but null when any part is null (an unknown
    corpus or file gives no path)."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("/"))
        cols.append(F.lit(p) if isinstance(p, str) else p)
    return F.concat(*cols)


def after_marker(c, marker: str) -> Column:
    """Part of a path after the first ``marker`` directory ('' when absent)."""
    return F.regexp_extract(_c(c), rf"^(?:.*?/)?{marker}/(.*)$", 1)


def dest_path(c, marker: str, root: str, corpus, middle: Sequence[str] = ()) -> Column:
    """``root/<middle..>/<corpus>/<rest after marker>``."""
    return lit_path(root, *middle, _c(corpus), after_marker(c, marker))


def with_suffix(c, suffix: str) -> Column:
    """P5: replace (or add) the suffix of the last path part."""
    col = _c(c)
    return F.concat(F.regexp_replace(col, r"(?<=[^/.])\.[^./]*$", ""), F.lit(suffix))


# --- P6 / P7 clip names ------------------------------------------------------

_NAME_RE = r"^(.*/)?([^/]+?)(\.[^./]*)?$"


def path_parts(c) -> tuple[Column, Column, Column]:
    """(parent with trailing '/', stem, suffix) of a path, like pathlib."""
    col = _c(c)
    return (F.regexp_extract(col, _NAME_RE, 1), F.regexp_extract(col, _NAME_RE, 2),
            F.regexp_extract(col, _NAME_RE, 3))


def clip_name(c, start, end) -> Column:
    """``dir/stem-{start}to{end}.suffix``."""
    parent, stem, suffix = path_parts(c)
    return F.concat(parent, stem, F.lit("-"), _c(start).cast("long").cast("string"), F.lit("to"),
                    _c(end).cast("long").cast("string"), suffix)


def with_stem(c, new_stem) -> Column:
    parent, _, suffix = path_parts(c)
    return F.concat(parent, _c(new_stem), suffix)


def stem_of(c) -> Column:
    return path_parts(c)[1]


# --- P10 durations -------------------------------------------------------------

def duration(onset="onset", offset="offset") -> Column:
    return _c(offset) - _c(onset)


def to_minutes(ms, digits: int = 3) -> Column:
    """ms -> minutes rounded half-up to ``digits``; null stays null.

    Integer arithmetic first (exact half-up on the true decimal value), then one
    division, so every engine returns the same double.
    """
    scale = 10 ** digits
    whole = F.floor((_c(ms).cast("long") * F.lit(scale) + F.lit(30000)) / F.lit(60000)).cast("long")
    return whole.cast("double") / F.lit(float(scale))


def to_hours(ms) -> Column:
    return _c(ms).cast("double") / 3600000.0


# --- P11 / P12 -----------------------------------------------------------------

def dataset_of_set(c) -> Column:
    """Corpus part of a namespaced set ``corpus/set``."""
    return F.substring_index(_c(c), "/", 1)


def with_stamp(df: DataFrame, name: str = "experiment", value: str = "benchmarking") -> DataFrame:
    """Stamp a constant column."""
    return df.withColumn(name, F.lit(value))


# --- P13 age -----------------------------------------------------------------

def age_months(date_col, dob_col, digits: int | None = 2) -> Column:
    a = F.datediff(_c(date_col).try_cast("date"), _c(dob_col).try_cast("date")).cast("double") / F.lit(DAYS_PER_MONTH)
    return F.round(a, digits) if digits is not None else a


# --- T1 seeded shuffle key ---------------------------------------------------------

def shuffle_key(seed: int, *keys) -> Column:
    """md5 of 'seed:key..' - a total, partition-independent shuffled order."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[_c(k).cast("string") for k in keys]))


# --- P8 / P9 schema shaping ------------------------------------------------------

def align(df: DataFrame, schema: Sequence[tuple[str, str]] | T.StructType) -> DataFrame:
    """Select a fixed column list; missing columns become typed nulls."""
    if isinstance(schema, T.StructType):
        fields = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    else:
        fields = list(schema)
    have = set(df.columns)
    return df.select(*[(F.col(n).cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in fields])


def drop_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns that are null in every row (one aggregate pass; only
    the per-column counts reach the driver). Columns in ``keep`` stay in any case."""
    asked = [c for c in df.columns if c not in keep]
    if not asked:
        return df
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(asked)]).first()
    gone = {c for i, c in enumerate(asked) if counts[f"c{i}"] == 0}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone])


def store_without_null_columns(df: DataFrame, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """P9 on a table that is stored anyway: the values of each column are counted while it is written, and the
    columns without any are left out when it is read. Columns in ``keep`` stay in any case."""
    from annolake.session import cut_lineage

    asked = [c for c in df.columns if c not in keep]
    if not asked:
        return cut_lineage(df, name)
    seen = Observation()
    stored = cut_lineage(df.observe(seen, *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(asked)]), name)
    gone = {c for i, c in enumerate(asked) if not seen.get[f"c{i}"]}
    return stored.select(*[F.col(f"`{c}`") for c in df.columns if c not in gone])
