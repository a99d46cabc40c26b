"""Free-entered values to the closest entry of a reference list, in SQL only.

Distance is the fewest insertions, deletions, replacements or swaps of
neighbouring characters (no character is edited again after a swap) to an
entry's text or one of its aliases, divided by the longer length; letters and
digits only are compared, in one case and width.

For a reference string of length m and a typed value of length n at most
k = max(m, n) / 2 edits are allowed.  The reference string is cut into k + 1
segments.  An edit changes one segment at most, so one stays whole and is found
in the value at most k places away.  Only a swap across the boundary of two
segments changes both, therefore each segment is also indexed with the
neighbouring character in its first, its last, or both places, which is what
such a swap leaves.  Segments are joined by equality on (field, n, segment
text); the pairs are verified with the built-in ``levenshtein``, which swaps
can only make smaller, and by dynamic programming where a swap is possible.
Values without a verified entry are found by an anti-join and get canon id 0.

Only different values go through the join, whatever number of rows has them.

Defined cases: null and empty values are no cases; a value without letters and
digits matches nothing; ties go to the smaller canon id; null aliases are
skipped; an empty reference list matches nothing; rows with one id are one
case per different value's entry; further columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillforge.functions.chars import letters_digits
from quillforge.session import durable

FIELDS = ("type", "difficulty", "category")

REFERENCES = """
SELECT DISTINCT field_name, canon_id, norm AS ref, length(norm) AS m FROM {entries} WHERE norm <> ''
"""

TYPED = """
SELECT t.question_id, t.field_name, t.norm
FROM {typed} t LEFT ANTI JOIN {canon} c ON t.field_name = c.field_name AND t.value = c.canon_text
WHERE t.value IS NOT NULL AND t.value <> ''
"""

SEGMENTS = """
WITH lengths AS (
  SELECT field_name, canon_id, ref, m, n, greatest(m, n) DIV 2 AS k
  FROM {refs} LATERAL VIEW explode(sequence((m + 1) DIV 2, 2 * m)) AS n
), cuts AS (
  SELECT *, least(k + 1, m) AS pieces FROM lengths
), segments AS (
  SELECT field_name, canon_id, ref, m, n, k,
         CAST(i * m DIV pieces AS int) AS start, CAST((i + 1) * m DIV pieces AS int) AS stop
  FROM cuts LATERAL VIEW explode(sequence(0, pieces - 1)) AS i
), around AS (
  SELECT *, substr(ref, start + 1, stop - start) AS seg,
         CASE WHEN start > 0 THEN substr(ref, start, 1) END AS l,
         CASE WHEN stop < m THEN substr(ref, stop + 1, 1) END AS r
  FROM segments
)
SELECT DISTINCT field_name, canon_id, ref, m, n, k, start, gram
FROM around LATERAL VIEW explode(array(
  seg,
  concat(l, substr(seg, 2)),
  concat(substr(seg, 1, length(seg) - 1), r),
  CASE WHEN length(seg) > 1 THEN concat(l, substr(seg, 2, length(seg) - 2), r) END)) AS gram
WHERE gram IS NOT NULL
"""

PROBES = """
SELECT field_name, norm, n, CAST(q - 1 AS int) AS place, substr(norm, q, len) AS gram
FROM (SELECT field_name, norm, length(norm) AS n FROM {vals} WHERE norm <> '')
LATERAL VIEW explode(sequence(1, n)) AS q
LATERAL VIEW explode(array(1, 2)) AS len
WHERE q + len - 1 <= n
"""

CANDIDATES = """
SELECT DISTINCT p.field_name, p.norm, p.n, s.ref, s.m, s.canon_id, s.k
FROM {probes} p JOIN {segments} s
  ON p.field_name = s.field_name AND p.n = s.n AND p.gram = s.gram AND abs(p.place - s.start) <= s.k
"""

MEASURED = """
SELECT *, levenshtein(norm, ref) AS lev,
       n > 1 AND exists(sequence(1, greatest(n - 1, 1)), i ->
         substr(norm, i, 1) <> substr(norm, i + 1, 1)
         AND instr(ref, concat(substr(norm, i + 1, 1), substr(norm, i, 1))) > 0) AS swappable
FROM {candidates}
"""

# Rows of the distance table, the last two of which are kept.
WITH_SWAPS = """
aggregate(
  sequence(1, n),
  named_struct('above', CAST(array() AS array<int>), 'row', sequence(0, m)),
  (s, i) -> named_struct('above', s.row, 'row', aggregate(
    sequence(1, m),
    array(i),
    (c, j) -> concat(c, array(least(
      s.row[j] + 1,
      c[j - 1] + 1,
      s.row[j - 1] + CASE WHEN substr(norm, i, 1) = substr(ref, j, 1) THEN 0 ELSE 1 END,
      CASE WHEN i > 1 AND j > 1 AND substr(norm, i, 1) = substr(ref, j - 1, 1) AND substr(norm, i - 1, 1) = substr(ref, j, 1)
           THEN get(s.above, j - 2) + 1 ELSE n + m END))))),
  s -> s.row[m])
"""

BEST = f"""
SELECT field_name, norm, min(struct(d / greatest(n, m) AS ratio, canon_id)).canon_id AS canon_id
FROM (SELECT *, CASE WHEN swappable AND lev > 1 THEN {WITH_SWAPS} ELSE lev END AS d FROM {{measured}})
WHERE d <= k
GROUP BY field_name, norm
"""

UNMATCHED = """
SELECT v.field_name, v.norm, CAST(0 AS bigint) AS canon_id
FROM {vals} v LEFT ANTI JOIN {best} b ON v.field_name = b.field_name AND v.norm = b.norm
"""

MAPPED = """
SELECT DISTINCT t.question_id, t.field_name, v.canon_id
FROM {cases} t JOIN {values} v ON t.field_name = v.field_name AND t.norm = v.norm
"""


def _norm(c: Column) -> Column:
    return letters_digits(c)


def map_values(questions: DataFrame, canon: DataFrame) -> DataFrame:
    """``question_id, field_name, canon_id`` of each value that is not exactly an entry; 0 where none is near enough."""
    spark = questions.sparkSession
    kinds = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in FIELDS))
    typed = questions.select(F.col("id").alias("question_id"), F.explode(kinds).alias("x")).select("question_id", "x.field_name", "x.value", _norm(F.col("x.value")).alias("norm"))
    texts = F.concat(F.array("canon_text"), F.coalesce("aliases", F.array().cast("array<string>")))
    entries = canon.select("field_name", F.col("canon_id").cast("bigint").alias("canon_id"), F.explode(texts).alias("text")).select("field_name", "canon_id", _norm(F.col("text")).alias("norm"))
    refs = spark.sql(REFERENCES, entries=entries)
    cases = spark.sql(TYPED, typed=typed, canon=canon)
    vals = durable(cases.select("field_name", "norm").distinct(), "p1-values")
    segments = spark.sql(SEGMENTS, refs=refs)
    probes = spark.sql(PROBES, vals=vals)
    candidates = spark.sql(CANDIDATES, probes=probes, segments=segments)
    best = durable(spark.sql(BEST, measured=spark.sql(MEASURED, candidates=candidates)), "p1-best")
    every = best.unionByName(spark.sql(UNMATCHED, vals=vals, best=best))
    return spark.sql(MAPPED, cases=cases, values=every)


def unmatched_report(mapped: DataFrame) -> DataFrame:
    """``field_name, cases, unmatched``."""
    return mapped.groupBy("field_name").agg(F.count("*").alias("cases"), F.count_if(F.col("canon_id") == 0).alias("unmatched"))
