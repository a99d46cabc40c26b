"""Queries of the language-model data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillforge.llm import bpe, canon, lookalike, packing, records, residue, similar
from quillforge.session import durable, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.map_values(table(spark, sf_dir, "question"), table(spark, sf_dir, "canon_value"))


def p1_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canon.unmatched_report(p1_found(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.copies(table(spark, sf_dir, "question"))


def p2_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.collapsed(table(spark, sf_dir, "question"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.Join(table(spark, sf_dir, "question")).question_pairs()


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.Join(table(spark, sf_dir, "question")).groups()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.lookalikes(table(spark, sf_dir, "question"))


def p6_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.consistent_questions(table(spark, sf_dir, "question"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Counting tokens is the costly step; it is done once and kept.
    return packing.containers(durable(bpe.token_counts(table(spark, sf_dir, "documents")), "p8-sizes"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packed(spark, sf_dir)


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(_packed(spark, sf_dir))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.marked(table(spark, sf_dir, "documents"))


def p9_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.content(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "n_chars")


def p9_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents each kind of evidence marks, and how many it alone marks."""
    found = durable(residue.evidence(table(spark, sf_dir, "documents")), "p9-evidence")
    alone = found.groupBy("doc_id").agg(F.count("*").alias("kinds"))
    return found.join(alone, "doc_id").groupBy("kind").agg(F.count("*").alias("documents"), F.count_if(F.col("kinds") == 1).alias("alone"))


QUERIES = {
    "p1_found": p1_found,
    "p1_unmatched": p1_unmatched,
    "p2_found": p2_found,
    "p2_records": p2_records,
    "p4_found": p4_found,
    "p4_groups": p4_groups,
    "p6_found": p6_found,
    "p6_forms": p6_forms,
    "p7_ids": p7_ids,
    "p8_containers": p8_containers,
    "p8_report": p8_report,
    "p9_found": p9_found,
    "p9_content": p9_content,
    "p9_evidence": p9_evidence,
}

_BLANK = r"[\p{Z}\t\n\v\f\r\x1C-\x1F\x{85}]"


def _counted(c: str) -> str:
    """Marks between two digits are protected by a private character (twice, as digits overlap), all others removed."""
    between = r"(\p{Nd})(\p{P})(\p{Nd})"
    for _ in range(2):
        c = f"regexp_replace({c}, '{between}', '\\1' || chr(57344) || '\\2\\3', 'g')"
    return f"replace(regexp_replace({c}, '(' || chr(57344) || '\\p{{P}})|\\p{{P}}|{_BLANK}', '\\1', 'g'), chr(57344), '')"


_RECORDS = f"""
WITH s AS (SELECT id, {_counted("lower(coalesce(stem, ''))")} AS stem, coalesce(answers, []) AS answers FROM question),
p AS (SELECT id, unnest(regexp_split_to_array(lower(a), '[,，﹐､、;；﹔]')) AS part FROM (SELECT id, unnest(answers) AS a FROM s) z),
c AS (SELECT id, {_counted('part')} AS part FROM p),
g AS (SELECT s.id, s.stem, coalesce((SELECT string_agg(part, '|' ORDER BY part) FROM c WHERE c.id = s.id AND part <> ''), '') AS parts FROM s),
k AS (SELECT id, min(id) OVER (PARTITION BY stem, parts) AS keep_id, count(*) OVER (PARTITION BY stem, parts) AS n_copies FROM g)
"""
# The wide forms, for the other engine.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_PLAIN = ("".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " ").replace("'", "''")


def _letters(c: str) -> str:
    return rf"regexp_replace(lower(translate({c}, '{_WIDE}', '{_PLAIN}')), '[^\p{{L}}\p{{N}}]', '', 'g')"


# The whole distance table of every value and entry: two rows are carried, each as long as the entry plus one.
_MAPPED = f"""
WITH v AS (SELECT id AS question_id, u.field_name, u.value FROM question, LATERAL (SELECT unnest(['type', 'difficulty', 'category']) AS field_name, unnest([type, difficulty, category]) AS value) u
  WHERE u.value IS NOT NULL AND u.value <> ''),
t AS (SELECT question_id, v.field_name, {_letters('v.value')} AS a FROM v ANTI JOIN canon_value c ON c.field_name = v.field_name AND c.canon_text = v.value),
e AS (SELECT DISTINCT field_name, canon_id, {_letters('x')} AS b FROM (SELECT field_name, canon_id, unnest(list_append(coalesce(aliases, []), canon_text)) AS x FROM canon_value) z),
p AS (SELECT d.field_name, d.a, e.canon_id, e.b, length(d.a) AS n, length(e.b) AS m FROM (SELECT DISTINCT field_name, a FROM t WHERE a <> '') d JOIN e ON d.field_name = e.field_name AND e.b <> ''
  AND greatest(length(d.a), length(e.b)) <= 2 * least(length(d.a), length(e.b))),
d AS (SELECT *, list_reduce(list_prepend(list_concat(list_transform(range(0, m + 1), lambda j: 9999::BIGINT), range(0, m + 1)), list_transform(range(1, n + 1), lambda i: [i])),
  lambda s, x: list_concat(s[m + 2:], list_reduce(list_prepend([x[1]], list_transform(range(1, m + 1), lambda j: [j])), lambda c, y: list_append(c, least(
    s[m + 2 + y[1]] + 1, c[y[1]] + 1, s[m + 1 + y[1]] + CASE WHEN substr(a, x[1], 1) = substr(b, y[1], 1) THEN 0 ELSE 1 END,
    CASE WHEN x[1] > 1 AND y[1] > 1 AND substr(a, x[1], 1) = substr(b, y[1] - 1, 1) AND substr(a, x[1] - 1, 1) = substr(b, y[1], 1) THEN s[y[1] - 1] + 1 ELSE 9999 END)))))[2 * m + 2] AS dist FROM p),
r AS (SELECT field_name, a, canon_id, row_number() OVER (PARTITION BY field_name, a ORDER BY dist::DOUBLE / greatest(n, m), canon_id) AS r FROM d WHERE 2 * dist <= greatest(n, m)),
f AS (SELECT DISTINCT t.question_id, t.field_name, coalesce(r.canon_id, 0) AS canon_id FROM t LEFT JOIN r ON r.r = 1 AND r.field_name = t.field_name AND r.a = t.a)
"""
ORACLE: dict[str, str] = {
    "p1_found": _MAPPED + "SELECT * FROM f",
    "p1_unmatched": _MAPPED + "SELECT field_name, count(*) AS cases, count(*) FILTER (WHERE canon_id = 0) AS unmatched FROM f GROUP BY field_name",
    "p2_found": _RECORDS + "SELECT keep_id, id AS copy_id FROM k WHERE id <> keep_id",
    "p2_records": _RECORDS + "SELECT keep_id, n_copies FROM k WHERE id = keep_id",
}
