"""Duplicates hidden by formatting: multiset fingerprints of normalized fields.

Two questions are the same record if their stems are equal and their answers
have equal parts in any order, both regardless of letter case, blanks and
punctuation; a mark directly between two digits counts, as does any other
character.  Parts are the elements of ``answers`` split at commas, enumeration
commas and semicolons of either width.

Every normalized (field name, value) pair is hashed twice; the
hashes are added up modulo a prime, which is commutative and counts repeated parts, so equal
multisets have equal fingerprints without sorting.  Rows are grouped by
fingerprint by hash aggregation of numbers with map-side pre-aggregation; only
rows of groups of several go on with their texts, and each is verified field by
field against one row of its group.  Rows that only share the fingerprint, if
ever there are any, are grouped by their exact fields.

Defined cases: a null stem is an empty stem, null answers have no parts, parts
without any counted character are left out; a repeated id with equal content is
one row; a null id takes no part; an empty table gives an empty result; further
columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.functions.chars import BLANK
from quillforge.session import durable

#: The marks that separate the parts of an answer.
SEPARATORS = "[,，﹐､、;；﹔]"


def counted(c: Column) -> Column:
    """Lower case, without blanks and without marks but those directly between two digits."""
    return F.regexp_replace(F.lower(c), rf"{BLANK}|(?<!\p{{Nd}})\p{{P}}|\p{{P}}(?!\p{{Nd}})", "")


def answer_parts(answers: Column) -> Column:
    split = F.flatten(F.transform(F.filter(answers, lambda a: a.isNotNull()), lambda a: F.split(a, SEPARATORS)))
    return F.filter(F.transform(split, lambda p: counted(p)), lambda p: p != "")


def _sum_hash(name: str, parts: Column, seed: int) -> Column:
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, p: _wrap(acc, F.xxhash64(F.lit(seed), F.lit(name), p)))


def _wrap(a: Column, b: Column) -> Column:
    """a + b modulo 2**61 - 1 for a below the modulus: commutative and free of overflow."""
    m = F.lit(2305843009213693951)
    return F.pmod(a + F.pmod(b, m), m)


def fingerprinted(questions: DataFrame, *more: Column) -> DataFrame:
    """``id, f_stem, f_parts, fp_a, fp_b`` and ``more`` columns: normalized fields and the 122-bit fingerprint."""
    base = questions.filter(F.col("id").isNotNull()).select(
        "id",
        counted(F.coalesce("stem", F.lit(""))).alias("f_stem"),
        answer_parts(F.coalesce("answers", F.array().cast("array<string>"))).alias("f_parts"),
        *more,
    )

    def fp(seed: int) -> Column:
        stem = F.xxhash64(F.lit(seed), F.lit("stem"), "f_stem")
        return _wrap(_sum_hash("answer", F.col("f_parts"), seed), stem)

    return base.withColumns({"fp_a": fp(17), "fp_b": fp(4099)})


def _same_parts(a: Column, b: Column) -> Column:
    """Equality of two multisets, by counting and without sorting."""

    def times(xs: Column, x: Column) -> Column:
        return F.size(F.filter(xs, lambda y: y == x))

    return (F.size(a) == F.size(b)) & F.forall(a, lambda x: times(a, x) == times(b, x))


def copies(questions: DataFrame) -> DataFrame:
    """``keep_id, copy_id``: every row but the kept one of each record."""
    rows = fingerprinted(questions)
    keys = ["fp_a", "fp_b"]
    # Numbers as the only buffers: hashed, not sorted.  The row with the smallest hash of its id stands for its group until the smallest id is known.
    groups = rows.groupBy(*keys).agg(F.min(F.xxhash64("id")).alias("stand_in"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # Texts move for the rows of groups of several only; a hot fingerprint is split by the adaptive skew join.
    several = durable(rows.join(groups, keys), "p2-several")
    first = several.filter(F.xxhash64("id") == F.col("stand_in")).select(*keys, F.col("id").alias("by"), F.col("f_stem").alias("k_stem"), F.col("f_parts").alias("k_parts"))
    same = (F.col("f_stem") == F.col("k_stem")) & _same_parts(F.col("f_parts"), F.col("k_parts"))
    met = several.join(first, keys).select(*keys, "id", same.alias("same"), F.when(~same, F.struct("f_stem", "f_parts")).alias("other"))
    met = durable(met, "p2-met")
    kept = met.filter("same").groupBy(*keys).agg(F.min("id").alias("keep_id"))
    verified = met.filter("same").join(kept, keys).filter(F.col("id") != F.col("keep_id")).select("keep_id", F.col("id").alias("copy_id"))
    # Collisions: exact grouping of the rows that failed the verification.
    other = met.filter("not same").select("id", "other.f_stem", F.array_sort("other.f_parts").alias("f_parts"))
    firsts = other.groupBy("f_stem", "f_parts").agg(F.min("id").alias("keep_id"))
    collided = other.join(firsts, ["f_stem", "f_parts"]).filter(F.col("id") != F.col("keep_id")).select("keep_id", F.col("id").alias("copy_id"))
    return verified.unionByName(collided).distinct()


def collapsed(questions: DataFrame) -> DataFrame:
    """``keep_id, n_copies``: one row per record with the number of rows it had."""
    found = copies(questions)
    singles = questions.select(F.col("id").alias("keep_id")).filter(F.col("keep_id").isNotNull()).distinct()
    kept = singles.join(found.select(F.col("copy_id").alias("keep_id")), "keep_id", "left_anti")
    counts = found.groupBy("keep_id").agg(F.count("*").alias("more"))
    return kept.join(counts, "keep_id", "left").select("keep_id", (F.coalesce("more", F.lit(0)) + 1).alias("n_copies"))
