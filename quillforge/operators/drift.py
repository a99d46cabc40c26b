"""Schemas that drift between the files of a feed.

Rows arrive as path-value maps (column number to raw text).  The header of
each sheet is found by the fields its cells name, type statistics of every
field are aggregated by file, each file is compared with the preceding one of
its feed, and all rows are projected into one typed table that reports the
values which failed their cast.

Defined cases
  * null or blank cells count as absent; null ``cells`` is an empty row;
  * a sheet in which no cell names a field has no header: its file has none of
    the fields, and its rows come out with null fields;
  * of several columns naming one field the exact alias wins over a contained
    one, then the lower ``alias_rank``, then the leftmost column;
  * ties between header rows go to the upper row, between files with the same
    ``file_seq`` to the smaller ``file_id``;
  * a field without any value in one of the two files is not ``retyped``;
  * repeated input rows are kept; an empty table gives an empty result;
  * further columns of the input, whatever their names, are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillforge.functions.chars import BLANK, fold_width, letters_digits, spellings, trim_blank

FIELDS = ("stem", "answer", "category", "difficulty")
ALL_FIELDS = ("type", *FIELDS)
NUMBER = r"^[+-]?[0-9]+(\.[0-9]+)?$"
#: The alias list is a reference list; a larger one is refused, not broadcast.
MAX_ALIASES = 5_000


def _aliases(aliases: DataFrame) -> list[tuple[str, int, str]]:
    """(field, rank, text) of the bounded alias list, longest text first."""
    rows = (
        aliases.select("field_name", F.coalesce("alias_rank", F.lit(2**31 - 1)).alias("alias_rank"), letters_digits(F.col("alias_text")).alias("text"))
        .filter(F.col("field_name").isin(*ALL_FIELDS) & (F.col("text") != ""))
        .limit(MAX_ALIASES + 1)
        .collect()
    )
    if len(rows) > MAX_ALIASES:
        raise ValueError(f"more than {MAX_ALIASES} header aliases")
    return sorted({(r.field_name, r.alias_rank, r.text) for r in rows}, key=lambda r: (-len(r[2]), r[1], r[0]))


def _names(field: str):
    return lambda hit: hit["field"] == field


def _wording(c: Column) -> Column:
    """Header text regardless of case, width, blanks and punctuation."""
    return F.regexp_replace(F.lower(fold_width(c)), rf"{BLANK}|\p{{P}}", "")


def headers(sheet_rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row per (file_id, sheet_name): header row and the column of each field."""
    known = _aliases(aliases)
    text = F.col("text")
    hit = F.lit(None).cast("int")
    for i, (_, _, alias) in reversed(list(enumerate(known))):
        hit = F.when(F.contains(text, F.lit(alias)), i).otherwise(hit)
    pick = lambda part: F.get(F.array(*(F.lit(k[part]) for k in known)), F.col("hit")) if known else F.lit(None)
    cells = sheet_rows.select("file_id", "sheet_name", "row_num", F.explode("cells").alias("col", "wording"))
    if known:
        cells = cells.filter(F.col("wording").rlike(spellings([k[2] for k in known])))
    named = (
        cells.withColumn("text", letters_digits(F.col("wording")))
        .filter(text != "")
        .withColumn("hit", hit)
        .filter(F.col("hit").isNotNull())
        .select(
            "file_id",
            "sheet_name",
            "row_num",
            F.struct(
                pick(0).cast("string").alias("field"),
                F.when(pick(2) == text, 0).otherwise(1).alias("loose"),
                pick(1).cast("int").alias("rank"),
                "col",
                "wording",
            ).alias("hit"),
        )
    )
    # Data cells name a field by chance only, so few rows reach this point; a row has a bounded number of cells.
    rows = named.groupBy("file_id", "sheet_name", "row_num").agg(F.array_sort(F.collect_list("hit")).alias("found"))
    score = F.size(F.array_distinct(F.transform("found", lambda h: h["field"])))
    best = rows.groupBy("file_id", "sheet_name").agg(F.max(F.struct(score.alias("score"), (-F.col("row_num")).alias("up"), F.col("found"))).alias("h"))
    # ``found`` is sorted by field, loose, rank, column: the first of a field is its column.
    first = {f: F.get(F.filter("h.found", _names(f)), F.lit(0)) for f in ALL_FIELDS}
    return best.select(
        "file_id",
        "sheet_name",
        (-F.col("h.up")).alias("header_row"),
        *(F.when(first[f].isNotNull(), F.struct(first[f]["col"].alias("col"), first[f]["wording"].alias("wording"))).alias(f"h_{f}") for f in ALL_FIELDS),
    )


def body_rows(sheet_rows: DataFrame, aliases: DataFrame, salts: int = 16) -> DataFrame:
    """All rows below the headers with the raw text of each field.

    One file may hold a third of all rows, so the join to the one header row
    of a sheet is salted: ``salts`` copies of each header, never more rows.
    """
    base = sheet_rows.select("feed", "file_seq", "file_id", "sheet_name", "row_num", "cells")
    heads = headers(base, aliases)
    rows = base.withColumn("salt", F.pmod(F.hash("row_num"), F.lit(salts)))
    heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keys = (rows["file_id"].eqNullSafe(heads["file_id"])) & (rows["sheet_name"].eqNullSafe(heads["sheet_name"])) & (rows["salt"] == heads["salt"])
    joined = rows.join(heads, keys, "left").select(rows["*"], "header_row", *(F.col(f"h_{f}") for f in ALL_FIELDS)).drop("salt")
    raw = {f: trim_blank(F.coalesce(F.try_element_at("cells", F.col(f"h_{f}.col")), F.lit(""))) for f in ALL_FIELDS}
    joined = joined.withColumns({f"v_{f}": raw[f] for f in ALL_FIELDS})
    filled = sum((F.when(F.col(f"v_{f}") != "", 1).otherwise(0) for f in ALL_FIELDS), F.lit(0))
    same = sum((F.when((F.col(f"v_{f}") != "") & (_wording(F.col(f"v_{f}")) == _wording(F.col(f"h_{f}.wording"))), 1).otherwise(0) for f in ALL_FIELDS), F.lit(0))
    repeated = (same >= 2) | ((same >= 1) & (same == filled))
    is_body = F.coalesce((F.col("row_num") > F.col("header_row")) & ~repeated, F.col("header_row").isNull())
    return joined.withColumn("is_body", is_body)


def file_profiles(body: DataFrame) -> DataFrame:
    """Path-type statistics: per file and field whether it is there, its wording and kinds of values."""
    # Strings are grouping keys and counts are the only buffers, so rows are hashed, not sorted; a file has few
    # different keys, and the second aggregation brings its sheets together.
    words = [F.col(f"h_{f}.wording").alias(f"w_{f}") for f in FIELDS]
    counts = []
    for f in FIELDS:
        value = F.col(f"v_{f}")
        counts += [F.count_if(F.col("is_body") & (value != "")).alias(f"n_{f}"), F.count_if(F.col("is_body") & value.rlike(NUMBER)).alias(f"d_{f}")]
    sheets = body.groupBy("feed", "file_seq", "file_id", *words).agg(*counts)
    grouped = sheets.groupBy("file_id").agg(
        F.min("feed").alias("feed"),
        F.min("file_seq").alias("file_seq"),
        *(F.min(f"w_{f}").alias(f"w_{f}") for f in FIELDS),
        *(F.sum(f"{k}_{f}").alias(f"{k}_{f}") for f in FIELDS for k in ("n", "d")),
    )
    return grouped.select(
        "feed",
        "file_seq",
        "file_id",
        *(F.struct(F.col(f"w_{f}").alias("wording"), F.col(f"n_{f}").alias("filled"), F.col(f"d_{f}").alias("numeric")).alias(f) for f in FIELDS),
    )


def schema_changes(sheet_rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """``file_id, field_name, change_kind`` against the preceding file of the feed."""
    profiles = file_profiles(body_rows(sheet_rows, aliases))
    w = Window.partitionBy("feed").orderBy("file_seq", "file_id")
    pairs = profiles.select("file_id", *FIELDS, F.lag(F.struct("file_id", *FIELDS)).over(w).alias("before")).filter(F.col("before").isNotNull())
    kinds = []
    for f in FIELDS:
        now, old = F.col(f), F.col(f"before.{f}")
        here, there = now["wording"].isNotNull(), old["wording"].isNotNull()
        both = here & there
        numeric = [(x["filled"] == x["numeric"]) for x in (now, old)]
        for kind, when in (
            ("added", here & ~there),
            ("removed", ~here & there),
            ("renamed", both & (_wording(now["wording"]) != _wording(old["wording"]))),
            ("retyped", both & (now["filled"] > 0) & (old["filled"] > 0) & (numeric[0] != numeric[1])),
        ):
            kinds.append(F.when(when, F.struct(F.lit(f).alias("field_name"), F.lit(kind).alias("change_kind"))))
    return pairs.select("file_id", F.explode(F.filter(F.array(*kinds), lambda k: k.isNotNull())).alias("k")).select("file_id", "k.field_name", "k.change_kind")


def consistent_table(sheet_rows: DataFrame, aliases: DataFrame) -> DataFrame:
    """Every body row in one schema.

    A field's values change between words and numbers, so each of ``FIELDS``
    has a text and a number column.  In a file where most values of a field
    are numbers, a value that isn't one is listed in ``failed_casts``; its
    text is kept.
    """
    body = body_rows(sheet_rows, aliases)
    profiles = file_profiles(body).select("file_id", *(((F.col(f"{f}.numeric") * 2) > F.col(f"{f}.filled")).alias(f"num_{f}") for f in FIELDS))
    salts = 16
    rows = body.filter("is_body").withColumn("salt", F.pmod(F.hash("row_num"), F.lit(salts)))
    profiles = profiles.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumnRenamed("file_id", "profile_id")
    joined = rows.join(profiles, (F.col("file_id").eqNullSafe(F.col("profile_id"))) & (rows["salt"] == profiles["salt"]), "left")
    text = {f: F.nullif(F.col(f"v_{f}"), F.lit("")) for f in ALL_FIELDS}
    number = {f: F.when(F.col(f"num_{f}") & text[f].rlike(NUMBER), text[f].cast("double")) for f in FIELDS}
    failed = F.filter(
        F.array(*(F.when(F.col(f"num_{f}") & text[f].isNotNull() & ~text[f].rlike(NUMBER), F.lit(f)) for f in number)),
        lambda x: x.isNotNull(),
    )
    return joined.select(
        "feed",
        "file_seq",
        "file_id",
        "sheet_name",
        "row_num",
        *(text[f].alias(f) for f in ALL_FIELDS),
        *(number[f].alias(f"{f}_number") for f in number),
        F.array_join(failed, ",").alias("failed_casts"),
    )
