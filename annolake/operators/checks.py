"""Validation: every check returns a table of violations
(dataset, set_name, check, detail); empty means good.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolake.operators.curate import CATEGORY_LISTS
from annolake.sources.sidecars import CATEGORY_FLAG, SIDECAR_FIELDS

KEYS = ["dataset", "set_name"]
# Lists a category index entry must have (``ignore`` is optional).
INDEX_LISTS = ("addressee_cols", "vcm_cols", "vtc_cols", "transcription_cols", "other")


def _violation(df: DataFrame, check: str, detail: Column) -> DataFrame:
    return df.select(*KEYS, F.lit(check).alias("check"), detail.alias("detail"))


def check_sidecar_values(sidecars_raw: DataFrame, map_col: str = "raw") -> DataFrame:
    """V1: enum, integer, date and Y/N fields of the raw sidecar map.

    One expression per field over the map of each row (no join, no rule table
    shipped around): the bad fields of a row are collected and exploded.
    """
    return sidecars_raw.select(*KEYS, F.explode(bad_fields(F.col(map_col))).alias("detail")).select(
        *KEYS, F.lit("sidecar_value").alias("check"), "detail")


def bad_fields(m: Column) -> Column:
    """``field=value`` of each field of a raw sidecar map that is not what SIDECAR_FIELDS says."""
    bad = []
    for name, kind, allowed in SIDECAR_FIELDS:
        v = m[name]
        if kind == "int":
            cond = v.isNotNull() & v.try_cast("long").isNull()
        elif kind == "date":
            cond = v.isNotNull() & v.try_cast("date").isNull()
        elif kind in ("enum", "yn"):
            cond = v.isNotNull() & ~v.isin(*allowed)
        else:
            continue
        bad.append(F.when(cond, F.concat(F.lit(name + "="), v)))
    return F.filter(F.array(*bad), lambda x: x.isNotNull())


def _sets(df: DataFrame) -> DataFrame:
    return df.select(*KEYS).distinct()


def check_index_columns(index_long: DataFrame, profile: DataFrame) -> DataFrame:
    """V2: the columns of an indexed set (all lists incl. other/ignore) equal the profile's."""
    idx = index_long.filter(F.col("column").isNotNull()).select(*KEYS, "column").distinct() \
                    .withColumn("_i", F.lit(True))
    prof = profile.select(*KEYS, "column").distinct().withColumn("_p", F.lit(True))
    j = idx.join(prof, KEYS + ["column"], "full_outer").join(_sets(index_long), KEYS, "left_semi")
    one_sided = j.filter(F.col("_i").isNull() | F.col("_p").isNull())
    return _violation(one_sided, "index_columns", F.concat(
        F.when(F.col("_i").isNull(), F.lit("not in index: ")).otherwise(F.lit("not in profile: ")), F.col("column")))


def check_index_sets(index_long: DataFrame, profile: DataFrame) -> DataFrame:
    """V3: the sets of an indexed corpus equal the profile's; unknown corpora."""
    idx = _sets(index_long).withColumn("_i", F.lit(True))
    prof = _sets(profile).withColumn("_p", F.lit(True))
    corpora_prof = profile.select("dataset").distinct().withColumn("_c", F.lit(True))
    unknown = idx.select("dataset").distinct().join(corpora_prof, "dataset", "left_anti") \
                 .select("dataset", F.lit(None).cast("string").alias("set_name"),
                         F.lit("unknown_corpus").alias("check"), F.lit("corpus not in profile").alias("detail"))
    j = idx.join(prof, KEYS, "full_outer").filter(F.col("_i").isNull() | F.col("_p").isNull()) \
           .join(idx.select("dataset").distinct(), "dataset", "left_semi") \
           .join(corpora_prof, "dataset", "left_semi")
    sets = _violation(j, "index_sets", F.when(F.col("_i").isNull(), F.lit("set not in index"))
                      .otherwise(F.lit("set not in profile")))
    return sets.unionByName(unknown)


def _flag_grid(index_long: DataFrame, profile: DataFrame, sidecars_raw: DataFrame,
               map_col: str = "raw") -> DataFrame:
    """(dataset, set, category, annotated ms of its columns, sidecar flag) for every
    indexed set and each of the four categories."""
    cats = list(CATEGORY_LISTS.items())
    grid = _sets(index_long).select(*KEYS, F.explode(F.array(*[
        F.struct(F.lit(c).alias("category"), F.lit(lst).alias("list"), F.lit(CATEGORY_FLAG[c]).alias("flag"))
        for c, lst in cats])).alias("g")).select(*KEYS, "g.category", "g.list", "g.flag")
    ann = (index_long.join(profile.select(*KEYS, "column", "annotated_duration_ms"), KEYS + ["column"], "inner")
           .groupBy(*KEYS, F.col("category").alias("list")).agg(F.sum("annotated_duration_ms").alias("_ann")))
    sc = sidecars_raw.select(*KEYS, F.col(map_col).alias("_raw"))
    j = grid.join(ann, KEYS + ["list"], "left").join(sc, KEYS, "inner")
    return j.select(*KEYS, "category", "flag", F.coalesce(F.col("_ann"), F.lit(0)).alias("annotated_ms"),
                    F.coalesce(F.element_at(F.col("_raw"), F.col("flag")), F.lit("N")).alias("flag_value"))


def check_missing_flag(index_long: DataFrame, profile: DataFrame, sidecars_raw: DataFrame) -> DataFrame:
    """V4: a category has annotated time but the sidecar flag is not Y/y."""
    g = _flag_grid(index_long, profile, sidecars_raw)
    bad = g.filter((F.col("annotated_ms") > 0) & (F.upper(F.col("flag_value")) != "Y"))
    return _violation(bad, "missing_flag", F.concat(F.col("flag"), F.lit(" missing ("), F.col("annotated_ms")
                                                    .cast("string"), F.lit(" ms)")))


def check_false_flag(index_long: DataFrame, profile: DataFrame, sidecars_raw: DataFrame) -> DataFrame:
    """V5: the sidecar flag is Y/y but the category has no annotated time."""
    g = _flag_grid(index_long, profile, sidecars_raw)
    bad = g.filter((F.col("annotated_ms") == 0) & (F.upper(F.col("flag_value")) == "Y"))
    return _violation(bad, "false_flag", F.concat(F.col("flag"), F.lit(" set but 0 ms")))


def check_sidecar_missing(index_long: DataFrame, sidecars: DataFrame) -> DataFrame:
    """V6: an indexed set has no sidecar."""
    miss = _sets(index_long).join(_sets(sidecars), KEYS, "left_anti")
    return _violation(miss, "sidecar_missing", F.lit("no sidecar"))


def nest_index(index_long: DataFrame) -> DataFrame:
    """Long index -> one row per set with the category lists (null when empty)."""
    aggs = [F.array_sort(F.collect_list(F.when(F.col("category") == lst, F.col("column")))).alias(lst)
            for lst in INDEX_LISTS + ("ignore",)]
    nested = index_long.groupBy(*KEYS).agg(*aggs)
    return nested.select(*KEYS, *[F.when(F.size(lst) > 0, F.col(lst)).alias(lst) for lst in INDEX_LISTS + ("ignore",)])


def check_index_fields(index_nested: DataFrame) -> DataFrame:
    """V7: required fields of a set entry (name and the five lists) are present."""
    return index_nested.select(*KEYS, F.explode(_missing_fields()).alias("f")).select(
        *KEYS, F.lit("index_field").alias("check"), F.concat(F.lit("missing "), F.col("f")).alias("detail"))


def _missing_fields() -> Column:
    return F.filter(F.array(F.when(F.col("set_name").isNull(), F.lit("name")),
                            *[F.when(F.col(lst).isNull(), F.lit(lst)) for lst in INDEX_LISTS]), lambda x: x.isNotNull())


# --- all rules in one pass ---------------------------------------------------------------

def set_facts(index_long: DataFrame, index_nested: DataFrame, profile: DataFrame, sidecars_raw: DataFrame,
              map_col: str = "raw") -> DataFrame:
    """One row for each (corpus, set) that any input knows, with all that the rules ask of it: the index entries, the profiled
    columns, the raw sidecars and the fields its entry lacks. Each input is read once, by one aggregate over their
    union; a set's lists are as long as its label columns are many. Two flags say whether the corpus is indexed and profiled at all.
    """
    kinds = {"i": (index_long, F.struct("category", "column")), "p": (profile, F.struct("column", F.col("annotated_duration_ms").alias("ms"))),
             "s": (sidecars_raw, F.col(map_col)), "m": (index_nested, _missing_fields())}
    every = None
    for name, (df, what) in kinds.items():
        part = df.select(*KEYS, what.alias(name))
        every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    facts = every.groupBy(*KEYS).agg(*[F.collect_list(n).alias(n) for n in kinds])
    corpus = Window.partitionBy("dataset")
    return (facts.withColumn("indexed", F.max(F.size("i") > 0).over(corpus)).withColumn("profiled", F.max(F.size("p") > 0).over(corpus))
            .withColumn("first", F.row_number().over(corpus.orderBy(F.size("i") == 0, F.col("set_name"))) == 1))


def _when(cond: Column, details: Column) -> Column:
    return F.when(cond, details).otherwise(F.array().cast("array<string>"))


def _one(cond: Column, detail: Column | str) -> Column:
    return _when(cond, F.array(F.lit(detail) if isinstance(detail, str) else detail))


def _flag_details(missing: bool) -> Column:
    """V4 or V5 for each sidecar of a set and each category."""
    def of(raw: Column) -> Column:
        out = []
        for category, lst in CATEGORY_LISTS.items():
            flag = CATEGORY_FLAG[category]
            mine = F.transform(F.filter("i", lambda e: e["category"] == lst), lambda e: F.aggregate(
                F.filter("p", lambda p: p["column"] == e["column"]), F.lit(0).cast("long"), lambda x, p: x + F.coalesce(p["ms"], F.lit(0).cast("long"))))
            ms = F.aggregate(mine, F.lit(0).cast("long"), lambda x, y: x + y)
            yes = F.upper(F.coalesce(F.element_at(raw, F.lit(flag)), F.lit("N"))) == "Y"
            out.append(F.when((ms > 0) & ~yes, F.concat(F.lit(flag + " missing ("), ms.cast("string"), F.lit(" ms)"))) if missing
                       else F.when((ms == 0) & yes, F.lit(flag + " set but 0 ms")))
        return F.filter(F.array(*out), lambda x: x.isNotNull())
    return F.flatten(F.transform("s", of))


def rules() -> list[tuple[str, Column]]:
    """(check, details found) over ``set_facts``: V1 to V7 as data, to be shortened or added to."""
    in_index, in_profile = F.size("i") > 0, F.size("p") > 0
    named = F.array_distinct(F.filter(F.transform("i", lambda e: e["column"]), lambda c: c.isNotNull()))
    profiled = F.array_distinct(F.transform("p", lambda p: p["column"]))

    def but(a, b, text):
        return F.transform(F.array_except(a, b), lambda c: F.concat(F.lit(text), c))

    return [
        ("sidecar_value", F.flatten(F.transform("s", bad_fields))),
        ("index_columns", _when(in_index, F.concat(but(profiled, named, "not in index: "), but(named, profiled, "not in profile: ")))),
        ("index_sets", _when(F.col("indexed") & F.col("profiled"), F.concat(
            _one(in_profile & ~in_index, "set not in index"), _one(in_index & ~in_profile, "set not in profile")))),
        ("unknown_corpus", _one(F.col("first") & F.col("indexed") & ~F.col("profiled"), "corpus not in profile")),
        ("missing_flag", _when(in_index, _flag_details(True))),
        ("false_flag", _when(in_index, _flag_details(False))),
        ("sidecar_missing", _one(in_index & (F.size("s") == 0), "no sidecar")),
        ("index_field", F.transform(F.flatten("m"), lambda f: F.concat(F.lit("missing "), f))),
    ]


def apply_rules(facts: DataFrame, checks: list[tuple[str, Column]] | None = None) -> DataFrame:
    """(dataset, set_name, check, detail) of all rules; a corpus that is unknown has no set."""
    def named(name: str, details: Column) -> Column:
        return F.transform(details, lambda d: F.struct(F.lit(name).alias("check"), d.alias("detail")))

    found = [named(name, details) for name, details in checks or rules()]
    out = facts.select(*KEYS, F.explode(F.concat(*found)).alias("v")).select(*KEYS, "v.check", "v.detail")
    return out.withColumn("set_name", F.when(F.col("check") != "unknown_corpus", F.col("set_name")))
