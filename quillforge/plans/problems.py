"""Queries of the data-quality problems that live in the core: 3 and 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.operators import drift, rowparse
from quillforge.session import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_changes(table(spark, sf_dir, "sheet_row"), table(spark, sf_dir, "header_alias"))


def p3_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.consistent_table(table(spark, sf_dir, "sheet_row"), table(spark, sf_dir, "header_alias"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rowparse.rejected(table(spark, sf_dir, "raw_line"))


def p5_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rowparse.accepted(table(spark, sf_dir, "raw_line"))
    options = F.array_join(F.transform("options", lambda o: F.concat(o["key"], F.lit("="), o["text"])), "|")
    return rows.withColumns({"options": options, "answers": F.array_join("answers", "|")})


def p5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its place, the place of its error and the reason."""
    return rowparse.located(table(spark, sf_dir, "raw_line"))


def p5_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_records(spark, sf_dir).filter("reason is not null")


QUERIES = {"p3_found": p3_found, "p3_table": p3_table, "p5_found": p5_found, "p5_valid": p5_valid, "p5_records": p5_records, "p5_errors": p5_errors}

# The wide forms, for the other engine.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_PLAIN = ("".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " ").replace("'", "''")
_BLANK = r"[\p{Z}\t\n\v\f\r\x1C-\x1F\x{85}]"


def _fold(c: str) -> str:
    return f"lower(translate({c}, '{_WIDE}', '{_PLAIN}'))"


def _letters(c: str) -> str:
    return rf"regexp_replace({_fold(c)}, '[^\p{{L}}\p{{N}}]', '', 'g')"


def _wording(c: str) -> str:
    return rf"regexp_replace({_fold(c)}, '{_BLANK}|\p{{P}}', '', 'g')"


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_BLANK}+', ''), '{_BLANK}+$', '')"


_FIELDS = ("stem", "answer", "category", "difficulty")
_CHANGES = " UNION ALL ".join(
    f"SELECT file_id, '{f}' AS field_name, unnest(list_filter(["
    f"CASE WHEN {f} IS NOT NULL AND l_{f} IS NULL THEN 'added' END, CASE WHEN {f} IS NULL AND l_{f} IS NOT NULL THEN 'removed' END, "
    f"CASE WHEN {_wording(f)} <> {_wording(f'l_{f}')} THEN 'renamed' END, "
    f"CASE WHEN {f} IS NOT NULL AND l_{f} IS NOT NULL AND n_{f} > 0 AND ln_{f} > 0 AND (n_{f} = d_{f}) <> (ln_{f} = ld_{f}) THEN 'retyped' END], lambda x: x IS NOT NULL)) AS change_kind "
    "FROM p WHERE l_file IS NOT NULL"
    for f in _FIELDS
)
_P3 = rf"""
WITH a AS (SELECT field_name, alias_rank, {_letters('alias_text')} AS t FROM header_alias),
c AS (SELECT file_id, sheet_name, row_num, k, cells[k] AS w, {_letters('cells[k]')} AS n FROM (SELECT *, unnest(map_keys(cells)) AS k FROM sheet_row) z),
m AS (SELECT * FROM (SELECT c.*, a.field_name, CASE WHEN a.t = c.n THEN 0 ELSE 1 END AS loose, a.alias_rank,
  row_number() OVER (PARTITION BY file_id, sheet_name, row_num, k ORDER BY length(a.t) DESC, a.alias_rank, a.field_name) AS r FROM c JOIN a ON contains(c.n, a.t)) z WHERE r = 1),
h AS (SELECT file_id, sheet_name, row_num FROM (SELECT *, row_number() OVER (PARTITION BY file_id, sheet_name ORDER BY s DESC, row_num) AS r FROM
  (SELECT file_id, sheet_name, row_num, count(DISTINCT field_name) AS s FROM m GROUP BY ALL) y) z WHERE r = 1),
f AS (SELECT * FROM (SELECT m.*, row_number() OVER (PARTITION BY m.file_id, m.sheet_name, m.field_name ORDER BY loose, alias_rank, k) AS q FROM m JOIN h USING (file_id, sheet_name, row_num)) z WHERE q = 1),
v AS (SELECT s.file_id, s.sheet_name, s.row_num, f.field_name, f.w, {_strip("coalesce(c.w, '')")} AS v FROM sheet_row s JOIN h ON s.file_id = h.file_id AND s.sheet_name = h.sheet_name AND s.row_num > h.row_num
  JOIN f ON f.file_id = s.file_id AND f.sheet_name = s.sheet_name LEFT JOIN c ON c.file_id = s.file_id AND c.sheet_name = s.sheet_name AND c.row_num = s.row_num AND c.k = f.k),
b AS (SELECT file_id, sheet_name, row_num, count(*) FILTER (WHERE v <> '') AS filled, count(*) FILTER (WHERE v <> '' AND {_wording('v')} = {_wording('w')}) AS same FROM v GROUP BY ALL),
t AS (SELECT v.file_id, v.field_name, count(*) FILTER (WHERE v <> '') AS n, count(*) FILTER (WHERE regexp_matches(v, '^[+-]?[0-9]+(\.[0-9]+)?$')) AS d
  FROM v JOIN b USING (file_id, sheet_name, row_num) WHERE NOT (b.same >= 2 OR (b.same >= 1 AND b.same = b.filled)) GROUP BY ALL),
g AS (SELECT DISTINCT file_id, feed, file_seq FROM sheet_row),
w AS (SELECT g.*, {', '.join(f"(SELECT min(w) FROM f WHERE f.file_id = g.file_id AND f.field_name = '{x}') AS {x}, coalesce((SELECT n FROM t WHERE t.file_id = g.file_id AND t.field_name = '{x}'), 0) AS n_{x}, coalesce((SELECT d FROM t WHERE t.file_id = g.file_id AND t.field_name = '{x}'), 0) AS d_{x}" for x in _FIELDS)} FROM g),
p AS (SELECT *, lag(file_id) OVER o AS l_file, {', '.join(f"lag({x}) OVER o AS l_{x}, lag(n_{x}) OVER o AS ln_{x}, lag(d_{x}) OVER o AS ld_{x}" for x in _FIELDS)} FROM w WINDOW o AS (PARTITION BY feed ORDER BY file_seq, file_id))
{_CHANGES}
"""

_P5 = r"""
WITH r AS (SELECT line_id, line_text AS x, CASE delim WHEN chr(9) THEN '\t' WHEN '|' THEN '\|' ELSE delim END AS d FROM raw_line),
q AS (SELECT *, '(?s)^(?:"(?:[^"]|"")*"|[^"' || d || ']*)(?:' || d || '(?:"(?:[^"]|"")*"|[^"' || d || ']*))*$' AS whole, '(?s)' || d || '(?:"(?:[^"]|"")*"|[^"' || d || ']*)' AS one FROM r),
s AS (SELECT line_id, regexp_matches(x, whole) AS quoted,
  list_transform(regexp_extract_all(CASE d WHEN '\t' THEN chr(9) WHEN '\|' THEN '|' ELSE d END || x, one), lambda f: trim(CASE WHEN substr(f, 2, 1) = '"' THEN replace(substr(f, 3, length(f) - 3), '""', '"') ELSE substr(f, 2) END, ' ')) AS f FROM q),
k AS (SELECT *, f[2] AS kind, f[15] AS a, f[6:14] AS o, list_filter(list_transform(range(1, 10), lambda i: CASE WHEN f[i + 5] <> '' THEN substr('ABCDEFGHI', i, 1) END), lambda c: c IS NOT NULL) AS keys FROM s),
l AS (SELECT *, len(keys) AS n, list_filter(string_split(a, ''), lambda c: c <> '') AS letters FROM k),
j AS (SELECT line_id, CASE
  WHEN NOT quoted THEN 'quoting'
  WHEN len(f) <> 18 THEN 'column_count'
  WHEN NOT regexp_matches(f[1], '^[1-9][0-9]{0,6}$') OR TRY_CAST(f[1] AS BIGINT) NOT BETWEEN 2 AND 1048576 THEN 'source_row'
  WHEN array_to_string(keys, '') <> substr('ABCDEFGHI', 1, n::INTEGER) OR (kind IN ('单选题', '多选题') AND n < 2) OR (kind NOT IN ('单选题', '多选题') AND n > 0) THEN 'options'
  WHEN kind = '单选题' AND NOT (length(a) = 1 AND list_contains(keys, a)) THEN 'answers'
  WHEN kind = '多选题' AND NOT (length(a) >= 2 AND len(list_distinct(letters)) = length(a) AND len(list_filter(letters, lambda c: NOT list_contains(keys, c))) = 0) THEN 'answers'
  WHEN kind = '判断题' AND a NOT IN ('正确', '错误') THEN 'answers'
  WHEN kind = '填空题' AND a = '' THEN 'answers' END AS reason FROM l)
"""
_TRIMMED = "SELECT line_id, f[1]::INTEGER AS source_row, kind AS type, f[3] AS difficulty, f[4] AS category, f[5] AS stem"
_P5_VALID = _P5.replace("j AS (SELECT line_id, CASE", "j AS (SELECT *, CASE") + f"""
{_TRIMMED}, array_to_string(list_transform(range(1, len(keys) + 1), lambda i: keys[i] || '=' || o[i]), '|') AS options,
  CASE WHEN kind IN ('单选题', '多选题') THEN array_to_string(letters, '|') ELSE a END AS answers, f[16] AS source,
  lower(f[17]) IN ('是', 'true', '1', 'yes') AS lifesaving, f[18] AS note
FROM j WHERE reason IS NULL
"""

# One record in each row of the given table, so its place is 0; the place of a broken quote is not for SQL to find.
ORACLE: dict[str, str] = {
    "p3_found": _P3,
    "p5_found": _P5 + "SELECT line_id, reason FROM j WHERE reason IS NOT NULL",
    "p5_valid": _P5_VALID,
}
