"""Queries of the question-bank operators, each with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillforge.functions import text as T
from quillforge.operators import export, grading, ingest, library, paper, progress, quality
from quillforge.session import durable, shared_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def questions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "question")


def sessions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "practice_session")


def banks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "bank")


def joined(c: Column | str) -> Column:
    return F.array_join(c, ",")


# The wide forms and the white space class, spelled out for the other engine.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_PLAIN = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
_WS = r"[\s\x{000b}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def _q(s: str) -> str:
    return s.replace("'", "''")


def _norm_sql(c: str) -> str:
    return rf"regexp_replace(lower(translate({c}, '{_q(_WIDE)}', '{_q(_PLAIN)}')), '[^\p{{L}}\p{{N}}]', '', 'g')"


def _trim_sql(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"


def _fill_sql(c: str) -> str:
    return f"lower(regexp_replace(translate({_trim_sql(c)}, '，、', ',,'), '{_WS}', '', 'g'))"


def _sorted_sql(c: str) -> str:
    return f"array_to_string(list_sort({c}), ',')"


_ONCE = "(SELECT DISTINCT ON (event_id) event_id, question_id, bank_id, kind, correct, ts, seq FROM progress_events ORDER BY event_id, received_at)"
_FOLD = f"""
WITH e AS (SELECT * FROM {_ONCE} x),
d AS (SELECT question_id, ts, seq, event_id FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY ts DESC, seq DESC, event_id DESC) AS r FROM e WHERE kind = 'drop') z WHERE r = 1),
w AS (SELECT question_id, ts, seq, event_id FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY ts DESC, seq DESC, event_id DESC) AS r FROM e WHERE kind = 'reset_wrong') z WHERE r = 1),
l AS (
  SELECT e.*, w.ts IS NULL OR e.ts > w.ts OR (e.ts = w.ts AND (e.seq > w.seq OR (e.seq = w.seq AND e.event_id > w.event_id))) AS counts
  FROM e LEFT JOIN d ON e.question_id = d.question_id LEFT JOIN w ON e.question_id = w.question_id
  WHERE e.kind <> 'drop' AND (d.ts IS NULL OR e.ts > d.ts OR (e.ts = d.ts AND (e.seq > d.seq OR (e.seq = d.seq AND e.event_id > d.event_id)))))
SELECT question_id,
       count(*) FILTER (WHERE kind = 'answer') AS attempts,
       count(*) FILTER (WHERE kind = 'answer' AND correct) AS correct,
       count(*) FILTER (WHERE kind = 'answer' AND NOT correct AND counts) AS wrong,
       count(*) FILTER (WHERE kind = 'star') % 2 = 1 AS starred,
       max(CASE WHEN kind = 'answer' THEN ts END) AS last_answered_at
FROM l GROUP BY question_id
"""


def folded(spark: SparkSession, d: str) -> DataFrame:
    return progress.fold(table(spark, d, "progress_events"))


# ---- progress -------------------------------------------------------------


@query(f"""
SELECT q.bank_id, count(*) AS wrong_questions, sum(p.wrong)::BIGINT AS wrong_answers
FROM question q JOIN ({_FOLD}) p ON q.id = p.question_id WHERE p.wrong > 0 GROUP BY q.bank_id
""")
def wrong_by_bank(spark, d):
    return progress.wrong_by_bank(questions(spark, d).select("id", "bank_id"), folded(spark, d))


@query(_FOLD)
def progress_fold(spark, d):
    return folded(spark, d)


@query(f"SELECT question_id, count(*) AS toggles, count(*) % 2 = 1 AS starred FROM {_ONCE} x WHERE kind = 'star' GROUP BY question_id")
def star_parity(spark, d):
    return progress.star_parity(table(spark, d, "progress_events"))


@query(f"SELECT question_id, wrong FROM ({_FOLD}) p WHERE wrong > 0")
def wrong_since_reset(spark, d):
    return folded(spark, d).filter("wrong > 0").select("question_id", "wrong")


@query(f"""
SELECT q.id, q.bank_id, coalesce(p.attempts, 0) AS attempts, coalesce(p.wrong, 0) AS wrong, coalesce(p.starred, false) AS starred
FROM question q LEFT JOIN ({_FOLD}) p ON q.id = p.question_id
""")
def question_progress(spark, d):
    return progress.with_progress(questions(spark, d).select("id", "bank_id"), folded(spark, d)).select("id", "bank_id", "attempts", "wrong", "starred")


@query(f"""
SELECT p.question_id, p.wrong, p.last_answered_at FROM ({_FOLD}) p SEMI JOIN question q ON q.id = p.question_id WHERE p.wrong > 0
""")
def wrong_list_recent_first(spark, d):
    wrong = folded(spark, d).filter("wrong > 0").join(questions(spark, d).select(F.col("id").alias("question_id")), "question_id", "left_semi")
    return wrong.select("question_id", "wrong", "last_answered_at").orderBy(F.col("last_answered_at").desc_nulls_last(), "question_id")


@query(f"""
WITH w AS (SELECT q.bank_id, count(*) AS n FROM question q JOIN ({_FOLD}) p ON q.id = p.question_id WHERE p.wrong > 0 GROUP BY q.bank_id)
SELECT b.id, b.name, w.n AS wrong_questions, (SELECT count(*) FROM w) AS groups FROM bank b JOIN w ON b.id = w.bank_id
""")
def banks_with_wrong(spark, d):
    wrong = progress.wrong_by_bank(questions(spark, d).select("id", "bank_id"), folded(spark, d)).select("bank_id", "wrong_questions")
    groups = wrong.agg(F.count("*").alias("groups")).withColumn("one", F.lit(1))
    rows = banks(spark, d).select("id", "name").join(wrong, F.col("id") == F.col("bank_id")).withColumn("one", F.lit(1))
    return rows.join(groups, "one").select("id", "name", "wrong_questions", "groups")


@query(f"""
SELECT question_id, event_id, kind, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY ts DESC, seq DESC, event_id DESC) AS r FROM {_ONCE} x) z WHERE r = 1
""")
def latest_per_key(spark, d):
    rows = progress.once(table(spark, d, "progress_events")).select("question_id", "event_id", "kind", "ts", "seq")
    return progress.latest_per_key(rows, "question_id", "ts", "seq", "event_id").select("question_id", "event_id", "kind", "ts")


def snapshot(spark, d) -> DataFrame:
    """The stored progress, one row per question: the highest of repeated rows."""
    rows = table(spark, d, "progress")
    return progress.latest_per_key(rows, "question_id", "attempts", "correct", "wrong", "last_answered_at")


_SNAPSHOT = """(SELECT question_id, attempts, correct, wrong, last_answered_at, starred FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY attempts DESC, correct DESC, wrong DESC, last_answered_at DESC NULLS LAST) AS r FROM progress) z WHERE r = 1)"""


@query(f"""
SELECT p.question_id, CASE WHEN q.id IS NOT NULL AND p.wrong > 0 THEN 0 ELSE p.wrong END AS wrong
FROM {_SNAPSHOT} p LEFT JOIN (SELECT id FROM question WHERE answer_mode = 'multiple') q ON p.question_id = q.id
""")
def clear_wrong(spark, d):
    ids = questions(spark, d).filter("answer_mode = 'multiple'").select("id")
    return progress.clear_wrong(snapshot(spark, d), ids).select("question_id", "wrong")


@query(f"""
WITH f AS ({_FOLD}), c AS (SELECT question_id, attempts, correct, wrong FROM f)
SELECT question_id, attempts::BIGINT AS attempts, wrong::BIGINT AS wrong FROM {_SNAPSHOT} s ANTI JOIN c USING (question_id)
UNION ALL SELECT question_id, attempts, wrong FROM c
""")
def upsert_progress(spark, d):
    stored = snapshot(spark, d).select("question_id", F.col("attempts").cast("bigint"), F.col("wrong").cast("bigint"))
    return progress.upsert(stored, folded(spark, d).select("question_id", "attempts", "wrong"), "question_id")


@query(f"SELECT p.question_id, p.attempts FROM {_SNAPSHOT} p ANTI JOIN {_ONCE} e ON p.question_id = e.question_id AND e.kind = 'drop'")
def delete_by_key(spark, d):
    gone = table(spark, d, "progress_events").filter("kind = 'drop'").select("question_id").distinct()
    return progress.delete_keys(snapshot(spark, d), gone, "question_id").select("question_id", "attempts")


# ---- papers ---------------------------------------------------------------

_PICK = "type = '单选题' AND difficulty = '中等'"
_CONFIG = paper.PaperConfig(type="单选题", difficulty="中等", count=20, seed="7")


@query(f"SELECT id, bank_id FROM question WHERE {_PICK} AND lifesaving")
def paper_filtered(spark, d):
    return paper.choose(questions(spark, d), paper.PaperConfig(type="单选题", difficulty="中等", lifesaving_only=True)).select("id", "bank_id")


@query(f"SELECT id FROM question WHERE {_PICK} ORDER BY id LIMIT 20")
def paper_sequential(spark, d):
    return paper.practice_paper(questions(spark, d), paper.PaperConfig(type="单选题", difficulty="中等", shuffled=False)).select("id")


@query(f"SELECT id FROM question WHERE {_PICK} ORDER BY md5(concat_ws('|', id, '7')), id LIMIT 20")
def paper_shuffled_topk(spark, d):
    return paper.practice_paper(questions(spark, d), _CONFIG).select("id")


@query("SELECT id FROM question WHERE lifesaving ORDER BY md5(concat_ws('|', id, '7')), id LIMIT 50")
def exam_paper(spark, d):
    return paper.exam_paper(questions(spark, d), paper.PaperConfig(lifesaving_only=True, shuffled=False, count=50, seed="7")).select("id")


@query("SELECT q.id, q.bank_id FROM question q SEMI JOIN (SELECT question_id FROM progress WHERE starred) p ON q.id = p.question_id")
def starred_paper(spark, d):
    return paper.starred_paper(questions(spark, d), table(spark, d, "progress")).select("id", "bank_id")


@query("""
WITH v AS (SELECT bank_id, 'type' AS kind, type AS value, min(id) AS ord FROM question WHERE coalesce(type, '') <> '' GROUP BY ALL
  UNION ALL SELECT bank_id, 'difficulty', difficulty, min(id) FROM question WHERE coalesce(difficulty, '') <> '' GROUP BY ALL)
SELECT bank_id, string_agg(value, ',' ORDER BY ord, value) FILTER (WHERE kind = 'type') AS types,
       string_agg(value, ',' ORDER BY ord, value) FILTER (WHERE kind = 'difficulty') AS difficulties
FROM v GROUP BY bank_id
""")
def bank_facets(spark, d):
    return paper.facets(questions(spark, d)).select("bank_id", joined("types").alias("types"), joined("difficulties").alias("difficulties"))


@query("SELECT bank_id, count(*) AS available, least(count(*), 20) AS paper_size FROM question GROUP BY bank_id")
def paper_availability(spark, d):
    return questions(spark, d).groupBy("bank_id").agg(F.count("*").alias("available")).withColumn("paper_size", F.least("available", F.lit(20).cast("bigint")))


_CONFIG_ROWS = [("c1", "all", "单选题", "中等", 20), ("c2", "missing", "单选题", "no such", 7), ("c3", "all", "no such", "困难", 50), ("c4", "all", "判断题", "全部难度", 0)]


@query(
    "WITH c(config_id, bank_id, type, difficulty, count) AS (VALUES "
    + ", ".join(str(r) for r in _CONFIG_ROWS)
    + """), b AS (SELECT c.config_id, CASE WHEN c.bank_id IN (SELECT bank_id FROM question) THEN c.bank_id ELSE 'all' END AS bank_id, c.type, c.difficulty, c.count FROM c)
SELECT config_id, bank_id,
  CASE WHEN EXISTS (SELECT 1 FROM question q WHERE q.type = b.type AND (b.bank_id = 'all' OR q.bank_id = b.bank_id)) THEN type ELSE '全部题型' END AS type,
  CASE WHEN EXISTS (SELECT 1 FROM question q WHERE q.difficulty = b.difficulty AND (b.bank_id = 'all' OR q.bank_id = b.bank_id)) THEN difficulty ELSE '全部难度' END AS difficulty,
  CASE WHEN count IN (0, 10, 20, 50) THEN count ELSE 20 END AS count FROM b"""
)
def config_fallback(spark, d):
    configs = spark.createDataFrame(_CONFIG_ROWS, "config_id string, bank_id string, type string, difficulty string, count int")
    return paper.repaired(configs, questions(spark, d))


_STORED = [
    ("s1", '{"bankId": "b", "type": "单选题", "count": 50, "order": "sequential", "lifesavingOnly": true}'),
    ("s2", '{"count": 7, "order": "sideways", "lifesavingOnly": false}'),
    ("s3", "not json"),
    ("s4", "{}"),
]


@query("""
SELECT * FROM (VALUES ('s1', 'b', '单选题', '全部难度', 50, 'sequential', true), ('s2', 'all', '全部题型', '全部难度', 20, 'random', false),
  ('s3', 'all', '全部题型', '全部难度', 20, 'random', false), ('s4', 'all', '全部题型', '全部难度', 20, 'random', false))
  t(config_id, bank_id, type, difficulty, count, "order", lifesaving_only)
""")
def config_store(spark, d):
    return paper.stored_configs(spark.createDataFrame(_STORED, "config_id string, json string"))


@query("SELECT bank_id, 1 + count(DISTINCT nullif(type, '')) AS types, 1 + count(DISTINCT nullif(difficulty, '')) AS difficulties, '全部题型' AS first_type FROM question GROUP BY bank_id")
def facet_choices(spark, d):
    c = paper.choices(questions(spark, d))
    return c.select("bank_id", F.size("types").cast("bigint").alias("types"), F.size("difficulties").cast("bigint").alias("difficulties"), F.get("types", F.lit(0)).alias("first_type"))


@query("SELECT id, substr(name, 1, 1) AS initial, format('{:,}', question_count::BIGINT * 1000) AS shown FROM bank")
def bank_labels(spark, d):
    return banks(spark, d).select("id", T.initial(F.col("name")).alias("initial"), T.thousands(F.col("question_count").cast("bigint") * 1000).alias("shown"))


# ---- grading and sessions -------------------------------------------------

_POS = """(SELECT s.id AS session_id, coalesce(s.mode, 'practice') AS mode, u.pos - 1 AS pos, s.question_ids[u.pos] AS question_id,
  s.responses[s.question_ids[u.pos]] AS response, s.judgements[s.question_ids[u.pos]] AS judgement
  FROM practice_session s, LATERAL (SELECT unnest(range(1, len(s.question_ids) + 1)) AS pos) u)"""
_TALLY = f"""
SELECT session_id, mode, count(*) AS total, count(judgement) AS answered, count(*) FILTER (WHERE judgement) AS "right",
       count(judgement) - count(*) FILTER (WHERE judgement) AS wrong, count(*) - count(judgement) AS skipped FROM {_POS} p GROUP BY session_id, mode
"""


def _score_sql(right: str, of: str) -> str:
    return f"CASE WHEN {of} > 0 THEN CAST(floor(({right} * 200.0 + {of}) / ({of} * 2)) AS INTEGER) ELSE 0 END"


@query(_TALLY)
def session_tallies(spark, d):
    return grading.tallies(sessions(spark, d))


@query(f"SELECT session_id, {_score_sql('right', 'total')} AS score FROM ({_TALLY.replace(chr(34) + 'right' + chr(34), 'right_n')}) t WHERE mode = 'exam'".replace("right *", "right_n *"))
def session_score_exam(spark, d):
    return grading.scores(sessions(spark, d)).filter("mode = 'exam'").select("session_id", "score")


@query(f"SELECT session_id, {_score_sql('right', 'answered')} AS score FROM ({_TALLY.replace(chr(34) + 'right' + chr(34), 'right_n')}) t WHERE mode = 'practice'".replace("right *", "right_n *"))
def session_score_practice(spark, d):
    return grading.scores(sessions(spark, d)).filter("mode = 'practice'").select("session_id", "score")


_GRADED = f"""
SELECT session_id, question_id, mode, is_right FROM (
  SELECT p.session_id, p.question_id, p.mode,
    CASE WHEN q.answer_mode = 'fill' THEN {_fill_sql("coalesce(p.response[1], '')")} = {_fill_sql("array_to_string(q.answers, ',')")}
         ELSE {_sorted_sql("p.response")} = {_sorted_sql("q.answers")} END AS is_right,
    row_number() OVER (PARTITION BY p.session_id, p.question_id ORDER BY p.pos) AS r
  FROM {_POS} p JOIN question q ON p.question_id = q.id
  WHERE p.response IS NOT NULL AND len(p.response) > 0 AND NOT (q.answer_mode = 'fill' AND {_trim_sql("coalesce(p.response[1], '')")} = '')) z WHERE r = 1
"""


@query(f"SELECT session_id, question_id, is_right FROM ({_GRADED}) g WHERE mode = 'exam'")
def exam_hand_in(spark, d):
    return grading.graded(sessions(spark, d), questions(spark, d)).filter("mode = 'exam'").select("session_id", "question_id", "is_right")


@query(f"SELECT mode, count(*) AS graded, count(*) FILTER (WHERE is_right) AS n_right FROM ({_GRADED}) g GROUP BY mode")
def practice_grading(spark, d):
    return grading.graded(sessions(spark, d), questions(spark, d)).groupBy("mode").agg(F.count("*").alias("graded"), F.count_if("is_right").alias("n_right"))


@query(f"""
SELECT session_id, min(CASE WHEN judgement IS NULL THEN pos END)::INTEGER AS first_open, count(judgement) AS done, count(*) AS total,
  {_score_sql('count(judgement)', 'count(*)')} AS percent FROM {_POS} p GROUP BY session_id
""")
def completion_ratio(spark, d):
    return grading.first_open(sessions(spark, d))


@query(f"""
WITH p AS (SELECT p.session_id, p.pos, p.question_id FROM {_POS} p SEMI JOIN question q ON p.question_id = q.id),
k AS (SELECT session_id, list(question_id ORDER BY pos) AS kept FROM p GROUP BY session_id)
SELECT s.id, coalesce(s.mode, 'practice') AS mode, array_to_string(k.kept, ',') AS ids, least(s.cursor_pos, len(k.kept) - 1)::INTEGER AS cursor_pos,
  len(list_filter(map_keys(s.responses), lambda x: list_contains(k.kept, x)))::INTEGER AS responses,
  len(list_filter(map_keys(s.judgements), lambda x: list_contains(k.kept, x)))::INTEGER AS judgements FROM practice_session s JOIN k ON s.id = k.session_id
""")
def resume_session(spark, d):
    return grading.resumed(sessions(spark, d), questions(spark, d)).select(
        "id", "mode", joined("question_ids").alias("ids"), "cursor_pos", F.size("responses").alias("responses"), F.size("judgements").alias("judgements")
    )


@query(f"""
SELECT session_id, pos::INTEGER AS pos, question_id, lag(question_id) OVER w AS previous_id, lead(question_id) OVER w AS next_id
FROM {_POS} p WINDOW w AS (PARTITION BY session_id ORDER BY pos)
""")
def session_navigation(spark, d):
    return progress.navigation(sessions(spark, d))


@query(f"""
SELECT p.session_id, p.question_id, o.key, coalesce(list_contains(p.response, o.key), false) AS picked, list_contains(q.answers, o.key) AS "right",
  coalesce(list_contains(p.response, o.key), false) AND NOT list_contains(q.answers, o.key) AS wrong
FROM {_POS} p JOIN question q ON p.question_id = q.id,
  LATERAL (SELECT unnest(CASE WHEN q.answer_mode = 'judge' THEN ['T', 'F'] ELSE list_transform(q.options, lambda x: x.key) END) AS key) o
WHERE p.judgement IS NOT NULL AND q.answer_mode <> 'fill'
""")
def choice_marks(spark, d):
    return grading.choice_marks(sessions(spark, d), questions(spark, d))


@query("""
SELECT q.id, o.key, answer_mode <> 'multiple' OR NOT list_contains(answers, o.key) OR len(list_filter(answers, lambda a: a <> o.key)) = 0 AS settles
FROM question q, LATERAL (SELECT unnest(list_transform(q.options, lambda x: x.key)) AS key) o
""")
def choice_grading(spark, d):
    rows = questions(spark, d).select("id", "answer_mode", "answers", F.explode("options.key").alias("key"))
    return rows.select("id", "key", T.grades_now(F.col("answer_mode"), F.col("key"), F.array("key"), F.col("answers")).alias("settles"))


@query("""
SELECT id, array_to_string(CASE WHEN list_contains(answers, 'A') THEN list_filter(answers, lambda x: x <> 'A') ELSE list_append(answers, 'A') END, ',') AS toggled FROM question
""")
def toggle_membership(spark, d):
    return questions(spark, d).select("id", joined(grading.toggled(F.col("answers"), F.lit("A"))).alias("toggled"))


# ---- scalars --------------------------------------------------------------


def _hash_sql(c: str) -> str:
    """FNV-1a over UTF-16 units, in base 36."""
    units = f"list_transform(string_split({c}, ''), lambda c: CASE WHEN unicode(c) > 65535 THEN [(55296 + (unicode(c) - 65536) // 1024)::BIGINT, (56320 + (unicode(c) - 65536) % 1024)::BIGINT] ELSE [unicode(c)::BIGINT] END)"
    h = f"list_reduce(list_prepend(2166136261::BIGINT, flatten({units})), lambda a, b: (xor(a, b) * 16777619) & 4294967295)"
    digits = "list_transform(range(0, 7), lambda i: CASE WHEN h // (36 ** i)::BIGINT > 0 OR i = 0 THEN substr('0123456789abcdefghijklmnopqrstuvwxyz', ((h // (36 ** i)::BIGINT) % 36)::INTEGER + 1, 1) ELSE '' END)"
    return f"(SELECT list_reduce(list_prepend('', {digits}), lambda a, b: b || a) FROM (SELECT {h} AS h) hh)"


@query(f"SELECT id, {_hash_sql('stem')} AS hash FROM question")
def stable_hash(spark, d):
    return questions(spark, d).select("id", T.stable_hash(F.col("stem")).alias("hash"))


# Cells and their compatibility forms.
_VECTORS = [("①题 干", "1题干"), ("ＡＢ１", "ab1"), ("ﬁle", "file"), ("㎏", "kg"), ("㎡", "m2"), ("Ⅳ", "iv"), ("ｶﾞ", "ガ"), ("e\u0301", "é"), ("㈱", "株"), ("½", "12"), ("²³", "23"), ("\u1112\u1161\u11ab", "한"), ("（答案）", "答案"), ("", "")]
_VECTOR_SQL = "VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in _VECTORS)


@query(f"SELECT DISTINCT type AS raw, {_norm_sql('type')} AS norm FROM question WHERE type IS NOT NULL UNION {_VECTOR_SQL}")
def header_normalise(spark, d):
    """The types given, and cells whose forms are known."""
    fixed = spark.createDataFrame([(a,) for a, _ in _VECTORS], "raw string")
    return questions(spark, d).select(F.col("type").alias("raw")).filter("raw is not null").unionByName(fixed).distinct().withColumn("norm", T.normalize_header(F.col("raw")))


def _clean_sql(key: str, text: str) -> str:
    marker = rf"'(?i)^{_WS}*(?:[（(【\[]{_WS}*)?' || {key} || '(?:{_WS}*[）)】\]])?{_WS}*(?:[、.．:：]|{_WS}+){_WS}*'"
    return _trim_sql(f"regexp_replace({text}, {marker}, '')")


@query(f"""
SELECT q.id, o.o.key AS key, {_clean_sql("o.o.key", "o.o.text")} AS text
FROM question q, LATERAL (SELECT unnest(q.options) AS o) o
""")
def option_prefix_clean(spark, d):
    rows = questions(spark, d).select("id", F.explode("options").alias("o"))
    return rows.select("id", F.col("o.key").alias("key"), T.clean_option(F.col("o.key"), F.col("o.text")).alias("text"))


@query(f"""
SELECT value, CASE WHEN t = '√' OR n IN ('正确', '对', '是', 'true', 't', 'yes', 'y') THEN 'T'
  WHEN t IN ('×', '✕', '✖') OR n IN ('错误', '错', '否', 'false', 'f', 'no', 'n') THEN 'F' ELSE '' END AS judged
FROM (SELECT value, {_trim_sql('value')} AS t, {_norm_sql('value')} AS n FROM (SELECT DISTINCT unnest(answers) AS value FROM question) y WHERE value IS NOT NULL) z
""")
def judge_value(spark, d):
    values = questions(spark, d).select(F.explode("answers").alias("value")).filter("value is not null").distinct()
    return values.withColumn("judged", T.judge_value(F.col("value")))


def _in_order(xs: str) -> str:
    """Each element once, in order of appearance."""
    return f"list_filter({xs}, lambda x, i: list_position({xs}, x) = i)"


_LETTERS = _in_order("regexp_extract_all(upper(array_to_string(answers, '')), '[A-I]')")


@query(f"SELECT id, array_to_string({_LETTERS}, '') AS letters FROM question")
def answer_letters(spark, d):
    return questions(spark, d).select("id", F.array_join(T.answer_letters(F.array_join("answers", "")), "").alias("letters"))


@query(f"SELECT id, {_fill_sql(chr(34) + 'a' + chr(34))} AS filled FROM (SELECT id, array_to_string(answers, ',') AS a FROM question WHERE answer_mode = 'fill') z")
def fill_normalise(spark, d):
    return questions(spark, d).filter("answer_mode = 'fill'").select("id", T.normalize_fill(joined("answers")).alias("filled"))


@query("""
SELECT id, CASE WHEN answer_mode = 'judge' THEN CASE WHEN answers[1] = 'T' THEN '正确' ELSE '错误' END
  WHEN answer_mode = 'fill' THEN array_to_string(answers, '，') ELSE array_to_string(answers, '、') END AS shown FROM question
""")
def display_answer(spark, d):
    return questions(spark, d).select("id", T.display_answer(F.col("answer_mode"), F.col("answers")).alias("shown"))


@query(f"""
SELECT id, CASE WHEN contains(n, '案例分析') THEN '案例分析题' WHEN contains(n, '案例') THEN '案例题' WHEN contains(n, '简答') OR contains(n, '问答') THEN '简答题'
  WHEN contains(n, '计算') THEN '计算题' WHEN contains(n, '论述') THEN '论述题' WHEN answer_mode = 'multiple' THEN '多选题' WHEN answer_mode = 'judge' THEN '判断题'
  WHEN answer_mode = 'fill' THEN '填空题' ELSE '单选题' END AS label FROM (SELECT id, answer_mode, {_norm_sql("coalesce(type, '')")} AS n FROM question) z
""")
def type_label(spark, d):
    return questions(spark, d).select("id", T.type_label(F.coalesce("type", F.lit("")), F.col("answer_mode")).alias("label"))


@query("""
SELECT file_id, row_num, count(*) AS flags FROM (SELECT file_id, row_num, unnest(map_values(cells)) AS v FROM sheet_row) z
WHERE lower(v) IN ('是', 'true', '1', 'yes') GROUP BY file_id, row_num
""")
def lifesaving_flag(spark, d):
    rows = table(spark, d, "sheet_row").select("file_id", "row_num", F.explode(F.map_values("cells")).alias("v"))
    return rows.filter(T.is_lifesaving(F.col("v"))).groupBy("file_id", "row_num").agg(F.count("*").alias("flags"))


@query(rf"SELECT id, coalesce(nullif({_trim_sql(r"regexp_replace(source_file, '(?i)\.xlsx?$', '')")}, ''), '未命名题库') AS bank_name FROM bank")
def bank_name_from_path(spark, d):
    return banks(spark, d).select("id", T.bank_name(F.col("source_file")).alias("bank_name"))


@query(f"""
SELECT id, array_to_string(list_filter(list_transform(string_split(replace(a, '，', ','), ','), lambda x: {_trim_sql('x')}), lambda x: x <> ''), '|') AS parts
FROM (SELECT id, array_to_string(answers, ',') AS a FROM question) z
""")
def fill_parts(spark, d):
    return questions(spark, d).select("id", F.array_join(T.fill_parts(joined("answers")), "|").alias("parts"))


@query("SELECT DISTINCT k AS col, CASE WHEN k > 26 THEN chr(((k - 1) // 26 + 64)::INTEGER) ELSE '' END || chr(((k - 1) % 26 + 65)::INTEGER) AS letters, k AS back FROM (SELECT unnest(map_keys(cells)) AS k FROM sheet_row) z")
def column_number(spark, d):
    cols = table(spark, d, "sheet_row").select(F.explode(F.map_keys("cells")).alias("col")).distinct()
    letter = lambda n: F.char(n + 64)
    high = F.floor((F.col("col") - 1) / 26).cast("int")
    letters = F.concat(F.when(F.col("col") > 26, letter(high)).otherwise(""), letter((F.col("col") - 1) % 26 + 1))
    return cols.select("col", letters.alias("letters"), T.column_number(letters).alias("back"))


@query("SELECT id, substr(sha256(stem), 1, 20) AS digest, substr(sha1(stem), 1, 16) || '.schema1' AS version FROM question")
def hash_digest(spark, d):
    return questions(spark, d).select("id", F.substring(F.sha2("stem", 256), 1, 20).alias("digest"), F.concat(F.substring(F.sha1("stem"), 1, 16), F.lit(".schema1")).alias("version"))


@query(r"SELECT id, replace(regexp_replace('banks/' || source_file, '(?i)\.xlsx$', ''), '/', ' - ') AS name FROM bank")
def bank_name_of_folders(spark, d):
    return banks(spark, d).select("id", T.bank_name_of_path(F.concat(F.lit("banks/"), "source_file")).alias("name"))


_OPTION_SQL = "list_filter(q.options, lambda o: o.key IS NOT NULL)"
_N = _norm_sql("coalesce(q.type, '')")
_KNOWN = f"list_filter({_in_order("regexp_extract_all(upper(a), '[A-I]')")}, lambda k: list_contains(list_transform(options, lambda o: o.key), k))"
_JUDGED = lambda c: f"CASE WHEN {_trim_sql(c)} = '√' OR {_norm_sql(c)} IN ('正确','对','是','true','t','yes','y') THEN 'T' WHEN {_trim_sql(c)} IN ('×','✕','✖') OR {_norm_sql(c)} IN ('错误','错','否','false','f','no','n') THEN 'F' ELSE '' END"


@query(f"""
WITH s AS (SELECT q.id, {_N} AS t, {_trim_sql("array_to_string(q.answers, ',')")} AS a, q.options FROM question q),
k AS (SELECT *, {_KNOWN} AS known, upper(a) AS up, {_JUDGED('a')} AS direct,
  coalesce(list_filter(options, lambda o: o.key = upper(a))[1].text, '') AS keyed,
  list_filter(options, lambda o: {_norm_sql('o.text')} = {_norm_sql('a')}) AS same FROM s),
j AS (SELECT *, {_JUDGED('keyed')} AS kv, CASE WHEN len(known) > 0 THEN known WHEN len(same) > 0 THEN [same[1].key] ELSE [] END AS choice FROM k)
SELECT id,
  CASE WHEN contains(t, '判断') AND (direct <> '' OR kv <> '' OR up IN ('A', 'B') OR len(known) = 0) THEN 'judge'
       WHEN contains(t, '填空') OR regexp_matches(t, '简答|问答|计算|案例分析|论述') OR len(options) = 0 THEN 'fill'
       WHEN contains(t, '多选') OR len(choice) > 1 THEN 'multiple' ELSE 'single' END AS mode,
  CASE WHEN contains(t, '判断') AND direct <> '' THEN direct WHEN contains(t, '判断') AND kv <> '' THEN kv WHEN contains(t, '判断') AND up = 'A' THEN 'T'
       WHEN contains(t, '判断') AND up = 'B' THEN 'F' WHEN contains(t, '判断') AND len(known) = 0 THEN ''
       WHEN contains(t, '填空') THEN array_to_string(list_filter(list_transform(string_split(replace(a, '，', ','), ','), lambda x: {_trim_sql('x')}), lambda x: x <> ''), '|')
       WHEN regexp_matches(t, '简答|问答|计算|案例分析|论述') OR len(options) = 0 THEN a
       ELSE array_to_string(choice, '|') END AS answers
FROM j
""")
def answer_parse(spark, d):
    rows = questions(spark, d).select("id", T.parse_answer(F.coalesce("type", F.lit("")), joined("answers"), F.col("options")).alias("p"))
    return rows.select("id", F.col("p.mode").alias("mode"), F.array_join("p.answers", "|").alias("answers"))


@query(f"""
WITH s AS (SELECT q.id, replace(coalesce(q.type, ''), ' ', '') AS t, array_to_string(q.answers, ',') AS a, q.options FROM question q),
k AS (SELECT *, {_KNOWN} AS known, CASE WHEN lower(a) IN ('正确','对','是','√','true','t','a') THEN 'T' WHEN lower(a) IN ('错误','错','否','×','false','f','b') THEN 'F' END AS truth FROM s)
SELECT id, CASE WHEN contains(t, '填空') THEN 'fill' WHEN contains(t, '判断') AND truth IS NOT NULL THEN 'judge' WHEN contains(t, '多选') OR len(known) > 1 THEN 'multiple' ELSE 'single' END AS mode,
  CASE WHEN contains(t, '填空') THEN array_to_string(list_filter(list_transform(string_split(replace(a, '，', ','), ','), lambda x: {_trim_sql('x')}), lambda x: x <> ''), '|')
       WHEN contains(t, '判断') AND truth IS NOT NULL THEN truth ELSE array_to_string(known, '|') END AS answers FROM k
""")
def strict_answer_parse(spark, d):
    rows = questions(spark, d).select("id", T.strict_parse_answer(F.coalesce("type", F.lit("")), joined("answers"), F.col("options")).alias("p"))
    return rows.select("id", F.col("p.mode").alias("mode"), F.array_join("p.answers", "|").alias("answers"))


# ---- ingest ---------------------------------------------------------------


def sheet_rows(spark, d) -> DataFrame:
    return table(spark, d, "sheet_row").select(F.col("file_id").cast("string").alias("file"), F.col("sheet_name").alias("sheet"), "row_num", "cells")


def _alias_case(field: str, names: tuple[str, ...], ranked: bool = True) -> str:
    rank = "CASE " + " ".join(f"WHEN n = '{ingest.normal(a)}' THEN {i if ranked else 0}" for i, a in enumerate(names)) + " END"
    pos = "-k" if ranked and field in ingest.LAST_COLUMN_FIELDS else "k"
    return f"arg_min(k, {rank} * 1000 + {pos}) FILTER (WHERE {rank} IS NOT NULL) AS c_{field}"


_KEY_SQL = "upper(coalesce(nullif(regexp_extract(n, '^(选项)?([a-i])$', 2), ''), nullif(regexp_extract(n, '^([a-i])选项$', 1), '')))"
_HEAD = f"""
WITH c AS (SELECT file_id, sheet_name, row_num, k, {_norm_sql('cells[k]')} AS n FROM (SELECT *, unnest(map_keys(cells)) AS k FROM sheet_row WHERE row_num <= 30) z),
o AS (SELECT file_id, sheet_name, row_num, list({{'key': key, 'col': col}} ORDER BY first_col) AS opts FROM
  (SELECT file_id, sheet_name, row_num, {_KEY_SQL} AS key, min(k) AS first_col, max(k) AS col FROM c WHERE {_KEY_SQL} IS NOT NULL GROUP BY ALL) z GROUP BY ALL),
h AS (SELECT file_id, sheet_name, row_num, {', '.join(_alias_case(f, names) for f, names in ingest.ALIASES.items())} FROM c GROUP BY ALL),
s AS (SELECT h.*, coalesce(o.opts, []) AS opts, 10 + CASE WHEN c_type IS NULL THEN 0 ELSE 3 END + CASE WHEN c_difficulty IS NULL THEN 0 ELSE 1 END + CASE WHEN c_category IS NULL THEN 0 ELSE 1 END + least(len(coalesce(o.opts, [])), 4) AS score
  FROM h LEFT JOIN o USING (file_id, sheet_name, row_num) WHERE c_stem IS NOT NULL AND c_answer IS NOT NULL),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_id, sheet_name ORDER BY score DESC, row_num) AS r FROM s) z WHERE r = 1)
"""


@query(_HEAD + f"""
SELECT file_id::VARCHAR AS file, sheet_name AS sheet, row_num AS header_row, score::INTEGER AS score, {', '.join(f'c_{f}' for f in ingest.ALIASES)}, len(opts)::INTEGER AS n_options FROM best
""")
def header_detection(spark, d):
    h = ingest.sheet_headers(sheet_rows(spark, d))
    return h.select("file", "sheet", "header_row", "score", *(f"c_{f}" for f in ingest.ALIASES), F.size("c_options").alias("n_options"))


def _listed(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


_GET = lambda f: _trim_sql(f"coalesce(cells[c_{f}], '')")
# Rows below the header as cells of each field, then with options, context and parsed answer.
_IMPORTED = _HEAD + f"""
, r AS (SELECT z.file_id::VARCHAR AS file, z.sheet_name AS sheet, z.row_num, z.cells, b.opts, {', '.join(f"{_GET(f)} AS {f}" for f in ingest.ALIASES)}
  FROM sheet_row z JOIN best b ON z.file_id = b.file_id AND z.sheet_name = b.sheet_name AND z.row_num > b.row_num),
e AS (SELECT *, coalesce(nullif(type, ''), sheet) AS raw_type, list_filter(list_transform(opts, lambda o: {{'key': o.key, 'text': {_clean_sql('o.key', _trim_sql("coalesce(cells[o.col], '')"))}}}), lambda o: o.text <> '') AS options
  FROM r WHERE stem <> '' AND NOT ({_norm_sql('stem')} IN ({_listed(map(ingest.normal, ingest.ALIASES['stem']))}) AND {_norm_sql('answer')} IN ({_listed(map(ingest.normal, ingest.ALIASES['answer']))}))),
g AS (SELECT *, contains(raw_type, '案例') AND answer = '' AND len(options) = 0 AS opens, CASE WHEN contains(raw_type, '案例') AND answer = '' AND len(options) = 0 THEN stem WHEN NOT contains(raw_type, '案例') THEN '' END AS marker FROM e),
x AS (SELECT *, coalesce(last_value(marker IGNORE NULLS) OVER (PARTITION BY file, sheet ORDER BY row_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '') AS ctx FROM g),
y AS (SELECT *, answer AS a, {_norm_sql('raw_type')} AS t FROM x WHERE NOT opens),
k AS (SELECT *, {_KNOWN} AS known, upper(a) AS up, {_JUDGED('a')} AS direct, coalesce(list_filter(options, lambda o: o.key = upper(a))[1].text, '') AS keyed,
  list_filter(options, lambda o: {_norm_sql('o.text')} = {_norm_sql('a')}) AS same FROM y),
j AS (SELECT *, {_JUDGED('keyed')} AS kv, CASE WHEN len(known) > 0 THEN known WHEN len(same) > 0 THEN [same[1].key] ELSE [] END AS choice FROM k),
p AS (SELECT *,
  CASE WHEN contains(t, '判断') AND (direct <> '' OR kv <> '' OR up IN ('A', 'B') OR len(known) = 0) THEN 'judge'
       WHEN contains(t, '填空') OR regexp_matches(t, '简答|问答|计算|案例分析|论述') OR len(options) = 0 THEN 'fill'
       WHEN contains(t, '多选') OR len(choice) > 1 THEN 'multiple' ELSE 'single' END AS answer_mode,
  CASE WHEN contains(t, '判断') AND direct <> '' THEN [direct] WHEN contains(t, '判断') AND kv <> '' THEN [kv] WHEN contains(t, '判断') AND up = 'A' THEN ['T']
       WHEN contains(t, '判断') AND up = 'B' THEN ['F'] WHEN contains(t, '判断') AND len(known) = 0 THEN []
       WHEN contains(t, '填空') THEN list_filter(list_transform(string_split(replace(a, '，', ','), ','), lambda x: {_trim_sql('x')}), lambda x: x <> '')
       WHEN regexp_matches(t, '简答|问答|计算|案例分析|论述') OR len(options) = 0 THEN CASE WHEN a <> '' THEN [a] ELSE [] END
       ELSE choice END AS answers FROM j),
q AS (SELECT file, sheet, 'q-' || {_hash_sql("file || '|' || sheet || '|' || row_num || '|' || stem")} AS id, 'bank-' || {_hash_sql('file')} AS bank_id, row_num::INTEGER AS source_row,
  CASE WHEN contains(t, '案例分析') THEN '案例分析题' WHEN contains(t, '案例') THEN '案例题' WHEN contains(t, '简答') OR contains(t, '问答') THEN '简答题' WHEN contains(t, '计算') THEN '计算题' WHEN contains(t, '论述') THEN '论述题'
    WHEN answer_mode = 'multiple' THEN '多选题' WHEN answer_mode = 'judge' THEN '判断题' WHEN answer_mode = 'fill' THEN '填空题' ELSE '单选题' END AS type,
  answer_mode, coalesce(nullif(difficulty, ''), '未标注') AS difficulty, coalesce(nullif(category, ''), '未分类') AS category, stem,
  array_to_string(list_transform(options, lambda o: o.key || '=' || o.text), '|') AS options, answers, source, lower(lifesaving) IN ('是', 'true', '1', 'yes') AS lifesaving, note,
  CASE WHEN contains(raw_type, '案例') THEN ctx ELSE '' END AS case_context, options AS option_list, answer AS raw_answer FROM p)
"""
_SHAPE = "file, sheet, id, bank_id, source_row, type, answer_mode, difficulty, category, stem, options, array_to_string(answers, '|') AS answers, source, lifesaving, note, case_context"
_WARNED = """SELECT file, sheet, source_row, 'no usable answer' AS warning FROM q WHERE len(answers) = 0
UNION ALL SELECT DISTINCT file_id::VARCHAR, sheet_name, NULL::INTEGER, 'no header' FROM sheet_row z WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.file_id = z.file_id AND b.sheet_name = z.sheet_name)"""


def _flat(df: DataFrame) -> DataFrame:
    """Options and answers as one text each."""
    options = F.array_join(F.transform("options", lambda o: F.concat(o["key"], F.lit("="), o["text"])), "|")
    return df.withColumns({"options": options, "answers": F.array_join("answers", "|")})


@query(_IMPORTED + f"SELECT {_SHAPE} FROM q WHERE len(answers) > 0")
def ingest_questions(spark, d):
    return _flat(ingest.import_rows(sheet_rows(spark, d)).questions)


@query(_IMPORTED + _WARNED)
def ingest_warnings(spark, d):
    return ingest.all_warnings(ingest.import_rows(sheet_rows(spark, d)))


_EXPORT = (
    ["coalesce(type, '')", "coalesce(difficulty, '')", "coalesce(category, '')", "stem"]
    + [f"coalesce(list_filter(options, lambda o: o.key = '{k}')[1].text, '')" for k in T.OPTION_KEYS]
    + [
        "CASE WHEN answer_mode = 'judge' THEN CASE WHEN answers[1] = 'T' THEN '正确' ELSE '错误' END WHEN answer_mode = 'fill' THEN array_to_string(answers, ',') ELSE array_to_string(answers, '') END",
        "coalesce(source, '')",
        "CASE WHEN lifesaving THEN '是' ELSE '否' END",
        "coalesce(note, '')",
    ]
)


# The strict importer: header texts of row 1 as they are.
_STRICT_COL = lambda name: f"list_max(list_filter(map_keys(cells), lambda k: {_trim_sql('cells[k]')} = '{name}'))"
_STRICT = f"""
WITH h AS (SELECT file_id, sheet_name, {', '.join(f"{_STRICT_COL(n)} AS c_{f}" for f, n in ingest.STRICT.items())},
  list_filter(list_transform(['A','B','C','D','E','F','G','H','I'], lambda x: {{'key': x, 'col': list_max(list_filter(map_keys(cells), lambda k: {_trim_sql('cells[k]')} = x))}}), lambda o: o.col IS NOT NULL) AS opts FROM sheet_row WHERE row_num = 1),
r AS (SELECT z.file_id::VARCHAR AS file, z.sheet_name AS sheet, z.row_num, z.cells, h.opts, {', '.join(f"{_GET(f)} AS {f}" for f in ingest.STRICT)}
  FROM sheet_row z JOIN h ON z.file_id = h.file_id AND z.sheet_name = h.sheet_name AND z.row_num > 1 WHERE {' AND '.join(f'c_{f} IS NOT NULL' for f in ingest.STRICT_REQUIRED)}),
e AS (SELECT *, list_filter(list_transform(opts, lambda o: {{'key': o.key, 'text': {_trim_sql("coalesce(cells[o.col], '')")}}}), lambda o: o.text <> '') AS options FROM r WHERE stem <> ''),
y AS (SELECT *, answer AS a, replace(type, ' ', '') AS t FROM e WHERE NOT (contains(type, '案例') AND answer = '' AND len(options) = 0)),
k AS (SELECT *, {_KNOWN} AS known, CASE WHEN lower(a) IN ('正确','对','是','√','true','t','a') THEN 'T' WHEN lower(a) IN ('错误','错','否','×','false','f','b') THEN 'F' END AS truth FROM y),
p AS (SELECT *, CASE WHEN contains(t, '填空') THEN 'fill' WHEN contains(t, '判断') AND truth IS NOT NULL THEN 'judge' WHEN contains(t, '多选') OR len(known) > 1 THEN 'multiple' ELSE 'single' END AS answer_mode,
  CASE WHEN contains(t, '填空') THEN list_filter(list_transform(string_split(replace(a, '，', ','), ','), lambda x: {_trim_sql('x')}), lambda x: x <> '') WHEN contains(t, '判断') AND truth IS NOT NULL THEN [truth] ELSE known END AS answers FROM k)
SELECT file, sheet, 'q-' || {_hash_sql("file || '|' || sheet || '|' || row_num || '|' || stem")} AS id, answer_mode, array_to_string(answers, '|') AS answers, array_to_string(list_transform(options, lambda o: o.key || '=' || o.text), '|') AS options, lifesaving = '是' AS lifesaving,
  CASE WHEN contains(type, '案例') THEN '案例题' WHEN answer_mode = 'multiple' THEN '多选题' WHEN answer_mode = 'judge' THEN '判断题' WHEN answer_mode = 'fill' THEN '填空题' ELSE '单选题' END AS type FROM p
"""


_STANDARD = "map_from_entries(list_filter([" + ", ".join(f"{{'k': {i}, 'v': {e}}}" for i, e in enumerate(_EXPORT, 1)) + "], lambda x: x.v <> ''))"
_STANDARD_HEAD = "MAP {" + ", ".join(f"{i}: '{c}'" for i, c in enumerate(export.COLUMNS, 1)) + "}"


@query(f"""
WITH sheet_row AS (SELECT bank_id AS file_id, '题库题目' AS sheet_name, (row_number() OVER (PARTITION BY bank_id ORDER BY id) + 1)::INTEGER AS row_num, {_STANDARD} AS cells FROM question
  UNION ALL SELECT DISTINCT bank_id, '题库题目', 1, {_STANDARD_HEAD} FROM question),
""" + _STRICT.strip().removeprefix("WITH "))
def ingest_strict(spark, d):
    """The standard sheet of every bank, read by the strict importer."""
    q = questions(spark, d)
    made = export.sheet_rows(q.withColumn("id", F.struct("bank_id", "id"))).select("id.*", F.array(*(F.col(c) for c in export.COLUMNS)).alias("values"))
    number = F.row_number().over(Window.partitionBy("bank_id").orderBy("id")) + 1
    rows = made.select("bank_id", number.alias("row_num"), "values").unionByName(q.select("bank_id").distinct().select("bank_id", F.lit(1).alias("row_num"), F.array(*map(F.lit, export.COLUMNS)).alias("values")))
    rows = rows.select(F.col("bank_id").alias("file"), F.lit(export.SHEET).alias("sheet"), "row_num", export.cells_of(F.col("values")).alias("cells"))
    return _flat(ingest.import_rows(rows, strict=True, keep_unanswered=True).questions).select("file", "sheet", "id", "type", "answer_mode", "answers", "options", "lifesaving")


_S_FIELDS = [f for f in ingest.SOURCE_ALIASES if f != "type"]
_SOURCE_ROWS = _HEAD.rstrip() + f"""
, sh AS (SELECT file_id, sheet_name, row_num, count(DISTINCT {_KEY_SQL}) + max(CASE WHEN n IN ({_listed(map(ingest.normal, ingest.SOURCE_ALIASES['type']))}) THEN 1 ELSE 0 END) AS score,
  {', '.join(_alias_case(f, ingest.SOURCE_ALIASES[f], False) for f in _S_FIELDS)} FROM c GROUP BY ALL),
sb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_id, sheet_name ORDER BY score DESC, row_num) AS r FROM sh WHERE c_stem IS NOT NULL AND c_answer IS NOT NULL) z WHERE r = 1),
sr AS (SELECT * FROM (SELECT z.file_id::VARCHAR AS file, z.sheet_name AS sheet, z.row_num, {', '.join(f"{_GET(f)} AS {f}" for f in _S_FIELDS)} FROM sheet_row z JOIN sb ON z.file_id = sb.file_id AND z.sheet_name = sb.sheet_name AND z.row_num > sb.row_num) w WHERE stem <> '')
"""


@query(_SOURCE_ROWS + "SELECT * FROM sr")
def source_row_locator(spark, d):
    return ingest.source_rows(sheet_rows(spark, d))


_FOUND = _IMPORTED.rstrip() + _SOURCE_ROWS[len(_HEAD.rstrip()) :] + """
, rc AS (SELECT q.*, s.file IS NOT NULL AS found, s.answer AS s_answer, s.category AS s_category, s.source AS s_source, s.lifesaving AS s_lifesaving FROM q LEFT JOIN (SELECT DISTINCT ON (file, sheet, row_num, stem) * FROM sr ORDER BY file, sheet, row_num, stem, answer, category, source, lifesaving) s
  ON s.file = q.file AND s.sheet = q.sheet AND s.row_num = q.source_row AND s.stem = q.stem WHERE len(answers) > 0),
en AS (SELECT * REPLACE (coalesce(nullif(s_category, ''), category) AS category, coalesce(nullif(s_source, ''), source) AS source, CASE WHEN coalesce(s_lifesaving, '') <> '' THEN lower(s_lifesaving) IN ('是', 'true', '1', 'yes') ELSE lifesaving END AS lifesaving),
  CASE WHEN answer_mode IN ('single', 'multiple') THEN array_to_string(list_filter(""" + _in_order("regexp_extract_all(upper(coalesce(s_answer, '')), '[A-I]')") + """, lambda k: NOT list_contains(list_transform(option_list, lambda o: o.key), k)), '、') ELSE '' END AS missing,
  answer_mode = 'multiple' AND len(answers) < 2 AS review FROM rc)
"""


@query(_FOUND + "SELECT file, sheet, count(*) AS imported, count(*) FILTER (WHERE found) AS found FROM rc GROUP BY file, sheet")
def reconciled_imports(spark, d):
    """Imported questions whose source row an independent search finds, by sheet."""
    rows = sheet_rows(spark, d)
    got = export.reconciled(ingest.import_rows(rows).questions, ingest.source_rows(rows))
    return got.groupBy("file", "sheet").agg(F.count("*").alias("imported"), F.count_if("found").alias("found"))


@query(_FOUND + f"SELECT {_SHAPE}, missing, review FROM en")
def converted_questions(spark, d):
    """Questions for the standard sheet, with category, source and lifesaving of their source rows."""
    out = _flat(export.converted(sheet_rows(spark, d)))
    return out.select(*[c.split(" AS ")[-1].strip() for c in _SHAPE.replace("(answers, '|')", "").split(", ")], "missing", "review")


@query(_FOUND + "SELECT file, count(*) AS exported, 0::BIGINT AS differing FROM en WHERE missing = '' GROUP BY file")
def converted_round_trip(spark, d):
    """The written sheet, context rows included, imported again: no field of any question differs."""
    kept = durable(export.converted(sheet_rows(spark, d)).filter("missing = ''"), "converted")
    bad = export.verified(kept).groupBy(F.substring_index("key", "|", 1).alias("file")).agg(F.count_distinct("key").alias("differing"))
    out = kept.groupBy("file").agg(F.count("*").alias("exported"))
    return out.join(bad, "file", "left").select("file", "exported", F.coalesce("differing", F.lit(0).cast("bigint")).alias("differing"))


@query(_IMPORTED + f"SELECT * FROM ({_WARNED}) w ORDER BY file, sheet, source_row NULLS FIRST LIMIT 20")
def first_warnings(spark, d):
    return ingest.first_warnings(ingest.import_rows(sheet_rows(spark, d)))


@query(_IMPORTED + f"""
, w AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY sheet, coalesce(source_row, 0), warning) AS r FROM ({_WARNED}) z),
m AS (SELECT file, concat_ws(' ', sheet, source_row::VARCHAR, warning) AS said, r FROM w)
SELECT f.file, a.said AS first_warning, b.said AS second_warning FROM (SELECT DISTINCT file_id::VARCHAR AS file FROM sheet_row) f LEFT JOIN m a ON a.file = f.file AND a.r = 1 LEFT JOIN m b ON b.file = f.file AND b.r = 2
WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.file = f.file AND len(q.answers) > 0)
""")
def failed_files(spark, d):
    rows = sheet_rows(spark, d)
    return ingest.failed_files(ingest.import_rows(rows), rows)


@query("SELECT id FROM bank WHERE origin = 'upload'")
def deletable_banks(spark, d):
    return library.deletable(banks(spark, d)).select("id")


_CASE_ROWS = """(SELECT id, bank_id, source_row, coalesce(type, '') AS type, stem, array_to_string(answers, ',') AS answer, len(options) AS n_options FROM question)"""


@query(f"""
WITH m AS (SELECT *, contains(type, '案例') AND answer = '' AND n_options = 0 AS opens,
  CASE WHEN contains(type, '案例') AND answer = '' AND n_options = 0 THEN stem WHEN NOT contains(type, '案例') THEN '' END AS marker FROM {_CASE_ROWS} r),
f AS (SELECT *, last_value(marker IGNORE NULLS) OVER (PARTITION BY bank_id ORDER BY source_row NULLS FIRST, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctx FROM m)
SELECT id, coalesce(ctx, '') AS case_context FROM f WHERE NOT opens
""")
def case_context(spark, d):
    rows = questions(spark, d).select("id", "bank_id", "source_row", F.coalesce("type", F.lit("")).alias("type"), "stem", joined("answers").alias("answer"), "options")
    return ingest.with_case_context(rows, "type", ["bank_id"], ["source_row", "id"]).select("id", "case_context")


@query("""
SELECT id AS before_id, bank_id, case_context AS context FROM (
  SELECT id, bank_id, case_context, coalesce(lag(coalesce(case_context, '')) OVER (PARTITION BY bank_id ORDER BY source_row NULLS FIRST, id), '') AS before FROM question) z
WHERE coalesce(case_context, '') <> '' AND case_context <> before
""")
def context_change_rows(spark, d):
    return export.context_rows(questions(spark, d), "bank_id", ["source_row", "id"])


# ---- library --------------------------------------------------------------


def _library(spark, d) -> library.Library:
    return library.Library(banks(spark, d), questions(spark, d), snapshot(spark, d))


@query(f"""
WITH old AS (SELECT DISTINCT question_id, bank_id FROM {_ONCE} e), lost AS (SELECT o.* FROM old o ANTI JOIN question q ON q.id = o.question_id AND q.bank_id = o.bank_id)
SELECT p.question_id, p.attempts FROM {_SNAPSHOT} p SEMI JOIN lost l ON p.question_id = l.question_id
""")
def refresh_orphans(spark, d):
    before = table(spark, d, "progress_events").select(F.col("question_id").alias("id"), "bank_id").distinct()
    return library.orphaned_progress(snapshot(spark, d), before, questions(spark, d)).select("question_id", "attempts")


@query("""
SELECT b.id, b.origin, count(q.id) AS questions FROM bank b LEFT JOIN question q ON q.bank_id = b.id GROUP BY b.id, b.origin
""")
def bank_origins(spark, d):
    q = questions(spark, d).groupBy("bank_id").agg(F.count("*").alias("questions"))
    out = banks(spark, d).select("id", "origin").join(q, F.col("id") == F.col("bank_id"), "left")
    return out.select("id", "origin", F.coalesce("questions", F.lit(0)).alias("questions"))


@query(f"""
WITH new AS (SELECT id, bank_id FROM question WHERE source_row IS NOT NULL), up AS (SELECT id FROM bank WHERE coalesce(origin, '') <> 'upload'),
gone AS (SELECT q.id FROM question q SEMI JOIN up ON q.bank_id = up.id ANTI JOIN new ON q.id = new.id)
SELECT p.question_id FROM {_SNAPSHOT} p ANTI JOIN gone ON p.question_id = gone.id
""")
def replace_orphans(spark, d):
    lib = _library(spark, d)
    new_banks = lib.banks.filter("coalesce(origin, '') <> 'upload'")
    new = lib.questions.filter("source_row is not null").join(new_banks.select(F.col("id").alias("bank_id")), "bank_id", "left_semi")
    return library.replace_banks(lib, new_banks, new).progress.select("question_id")


@query(f"""
WITH gone AS (SELECT id FROM bank WHERE origin IS NULL), q AS (SELECT * FROM question ANTI JOIN gone ON question.bank_id = gone.id),
p AS (SELECT s.* FROM {_SNAPSHOT} s ANTI JOIN (SELECT question.id FROM question SEMI JOIN gone ON question.bank_id = gone.id) d ON s.question_id = d.id)
SELECT 'banks' AS relation, count(*) AS n FROM bank WHERE origin IS NOT NULL UNION ALL SELECT 'questions', count(*) FROM q UNION ALL SELECT 'progress', count(*) FROM p
""")
def delete_cascade(spark, d):
    lib = _library(spark, d)
    left = library.delete_banks(lib, lib.banks.filter("origin is null").select(F.col("id").alias("bank_id")))
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n")
    return count(left.banks, "banks").unionByName(count(left.questions, "questions")).unionByName(count(left.progress, "progress"))


@query(f"""
WITH up AS (SELECT id FROM bank WHERE origin = 'upload'), old AS (SELECT id FROM bank WHERE coalesce(origin, '') <> 'upload'),
new AS (SELECT q.id, q.bank_id FROM question q ANTI JOIN up ON q.bank_id = up.id WHERE q.answer_mode <> 'fill'),
oldq AS (SELECT q.id, q.bank_id FROM question q SEMI JOIN old ON q.bank_id = old.id), lost AS (SELECT o.id FROM oldq o ANTI JOIN new n ON o.id = n.id AND o.bank_id = n.bank_id)
SELECT 'questions' AS relation, (SELECT count(*) FROM question q ANTI JOIN old ON q.bank_id = old.id) + (SELECT count(*) FROM new) AS n
UNION ALL SELECT 'progress', count(*) FROM {_SNAPSHOT} p ANTI JOIN lost ON p.question_id = lost.id
UNION ALL SELECT 'banks', count(*) FROM bank
""")
def refresh_bundled(spark, d):
    lib = _library(spark, d)
    new = library.refresh_bundled(lib, lib.banks, lib.questions.filter("answer_mode <> 'fill'"))
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("relation"), "n")
    return count(new.questions, "questions").unionByName(count(new.progress, "progress")).unionByName(count(new.banks, "banks"))


@query("""
WITH i AS (SELECT id AS import_id, name FROM bank), s AS (SELECT id AS stored_id, name, imported_at FROM bank)
SELECT import_id, name, stored_id FROM (SELECT i.import_id, i.name, s.stored_id, row_number() OVER (PARTITION BY i.import_id, i.name
  ORDER BY (i.import_id = s.stored_id) DESC, s.imported_at DESC NULLS LAST, s.stored_id DESC) AS r FROM i JOIN s USING (name)) z WHERE r = 1
""")
def name_conflict_pick(spark, d):
    b = banks(spark, d)
    return library.conflicting_bank(b, b)


@query("SELECT id || '-k1' AS id, bank_id || '-k1' AS bank_id, stem FROM question")
def copy_import(spark, d):
    return library.copied(banks(spark, d), questions(spark, d), "k1")[1].select("id", "bank_id", "stem")


@query("SELECT id || '-k1' AS id, bank_id || '-k1' AS bank_id FROM question")
def replace_rekey(spark, d):
    return library.rekeyed(questions(spark, d), F.col("bank_id"), F.concat("bank_id", F.lit("-k1"))).select("id", "bank_id")


@query("SELECT name, id, (row_number() OVER (PARTITION BY name ORDER BY id))::INTEGER AS occurrence FROM bank")
def names_in_order(spark, d):
    return library.names_in_order(banks(spark, d).select("name", "id", F.col("id").alias("file_ord"))).select("name", "id", "occurrence")


@query("SELECT bank_id AS id, count(*)::INTEGER AS question_count, count(DISTINCT nullif(type, ''))::INTEGER AS n_types, count(DISTINCT nullif(difficulty, ''))::INTEGER AS n_difficulties FROM question GROUP BY bank_id")
def derived_banks(spark, d):
    return library.derived_banks(questions(spark, d)).select("id", "question_count", F.size("types").alias("n_types"), F.size("difficulties").alias("n_difficulties"))


@query("SELECT id, name, NULL::VARCHAR AS bank_id FROM bank UNION ALL SELECT id, stem, bank_id FROM question")
def union_banks(spark, d):
    b = banks(spark, d).select("id", "name", F.lit(None).cast("string").alias("bank_id"))
    return b.unionByName(questions(spark, d).select("id", F.col("stem").alias("name"), "bank_id"))


@query(f"""
WITH up AS (SELECT id FROM bank WHERE origin = 'upload'), old AS (SELECT id FROM bank WHERE coalesce(origin, '') <> 'upload'),
new AS (SELECT q.* FROM question q ANTI JOIN up ON q.bank_id = up.id WHERE q.answer_mode <> 'fill'), oldq AS (SELECT q.id, q.bank_id FROM question q SEMI JOIN old ON q.bank_id = old.id),
lost AS (SELECT o.id FROM oldq o ANTI JOIN new n ON o.id = n.id AND o.bank_id = n.bank_id), kept AS (SELECT q.* FROM question q ANTI JOIN old ON q.bank_id = old.id ANTI JOIN new ON q.id = new.id)
SELECT 'question' AS relation, id, bank_id AS of, stem AS content FROM (SELECT id, bank_id, stem FROM kept UNION ALL SELECT id, bank_id, stem FROM new) q
UNION ALL SELECT 'bank', id, CASE WHEN origin = 'upload' THEN 'upload' ELSE 'bundled' END, name FROM bank
UNION ALL SELECT 'progress', question_id, NULL, attempts::VARCHAR FROM {_SNAPSHOT} p ANTI JOIN lost ON p.question_id = lost.id
UNION ALL SELECT 'version', 'sourceVersion', NULL, 'v2'
""")
def startup_refresh(spark, d):
    """A published bundle of another version than the stored one, loaded at start-up: the whole state after it."""
    from uuid import uuid4

    from quillforge.sources import datasets

    lib = _library(spark, d)
    folder = f"{shared_dir(spark)}/bundle-{uuid4().hex}"
    datasets.write_bundle(lib.banks, lib.questions.filter("answer_mode <> 'fill'"), folder, "v2")
    new, version = datasets.refreshed(spark, lib, "v1", folder)
    rows = new.questions.select(F.lit("question").alias("relation"), "id", F.col("bank_id").alias("of"), F.col("stem").alias("content"))
    rows = rows.unionByName(new.banks.select(F.lit("bank").alias("relation"), "id", F.col("origin").alias("of"), F.col("name").alias("content")))
    rows = rows.unionByName(new.progress.select(F.lit("progress").alias("relation"), F.col("question_id").alias("id"), F.lit(None).cast("string").alias("of"), F.col("attempts").cast("string").alias("content")))
    meta = spark.createDataFrame([("version", "sourceVersion", None, version)], "relation string, id string, of string, content string")
    return rows.unionByName(meta)


@query("SELECT 'active' AS id, coalesce(mode, '') AS mode, cursor_pos, updated_at FROM practice_session ORDER BY practice_session.updated_at DESC, practice_session.id DESC LIMIT 1")
def session_slot(spark, d):
    """The slot after all sessions were saved to it in order of their stamps."""
    rows = sessions(spark, d).withColumns({"slot": F.lit("all"), "sid": F.col("id")})
    last = progress.latest_per_key(rows, "slot", "updated_at", "sid")
    stored = progress.save_session(rows.limit(0), last.select(*rows.columns))
    return progress.active_session(stored).select("id", F.coalesce("mode", F.lit("")).alias("mode"), "cursor_pos", "updated_at")


@query(f"SELECT q.id, q.bank_id FROM question q SEMI JOIN (SELECT question_id FROM ({_FOLD}) p WHERE wrong > 0) w ON q.id = w.question_id")
def wrong_paper(spark, d):
    wrong = folded(spark, d).filter("wrong > 0").select(F.col("question_id").alias("id"))
    return questions(spark, d).select("id", "bank_id").join(wrong, "id", "left_semi")


# ---- export and quality ---------------------------------------------------


@query("SELECT type, answer_mode, count(*) AS n FROM question GROUP BY type, answer_mode")
def type_histogram(spark, d):
    return quality.histogram(questions(spark, d), "type", "answer_mode")


@query("""
SELECT (SELECT count(*) FROM bank) AS banks, (SELECT count(DISTINCT id) FROM bank) AS bank_ids, (SELECT sum(question_count)::BIGINT FROM bank) AS declared,
       (SELECT count(*) FROM question) AS questions, (SELECT count(DISTINCT id) FROM question) AS question_ids
""")
def integrity_counts(spark, d):
    return quality.integrity(banks(spark, d), questions(spark, d))


@query("""
SELECT b.id, b.question_count, coalesce(q.n, 0) AS counted FROM bank b LEFT JOIN (SELECT bank_id, count(*) AS n FROM question GROUP BY bank_id) q ON b.id = q.bank_id
WHERE b.question_count <> coalesce(q.n, 0)
""")
def count_drift(spark, d):
    return quality.count_drift(banks(spark, d), questions(spark, d))


@query("""
SELECT bank_id, substr(sha256(CAST(sum(('0x' || substr(sha256(concat_ws('|', id, coalesce(stem, ''), array_to_string(answers, ','))), 1, 15))::BIGINT::HUGEINT) AS VARCHAR)), 1, 20) AS version
FROM question GROUP BY bank_id
""")
def content_version(spark, d):
    return quality.content_version(questions(spark, d))


@query("SELECT source_file, count(*) AS n FROM bank GROUP BY source_file HAVING count(*) > 1")
def repeated_names(spark, d):
    return quality.repeated_names(banks(spark, d))


@query(f"""
SELECT id, missing FROM (SELECT id, array_to_string(list_filter({_LETTERS}, lambda k: NOT list_contains(list_transform(options, lambda o: o.key), k)), '') AS missing
  FROM question WHERE answer_mode IN ('single', 'multiple')) z WHERE missing <> ''
""")
def missing_option_keys(spark, d):
    return export.missing_options(questions(spark, d))


@query("SELECT id, " + ", ".join(f'{e} AS "{c}"' for e, c in zip(_EXPORT, export.COLUMNS)) + " FROM question")
def export_rows(spark, d):
    return export.sheet_rows(questions(spark, d))


@query()
def round_trip_diff(spark, d):
    return export.round_trip(questions(spark, d))


@query("""
SELECT e.id AS key, 'wrong' AS "column" FROM (SELECT question_id AS id, sum(CASE WHEN kind = 'answer' AND NOT correct THEN 1 ELSE 0 END) AS w FROM progress_events GROUP BY 1) e
JOIN (SELECT question_id AS id, max(wrong) AS w FROM progress GROUP BY 1) p USING (id) WHERE e.w <> p.w
""")
def snapshot_differences(spark, d):
    events = table(spark, d, "progress_events").groupBy(F.col("question_id").alias("id")).agg(F.sum(F.when((F.col("kind") == "answer") & ~F.col("correct"), 1).otherwise(0)).alias("wrong"))
    stored = table(spark, d, "progress").groupBy(F.col("question_id").alias("id")).agg(F.max("wrong").cast("bigint").alias("wrong"))
    both = events.join(stored.select("id"), "id", "left_semi"), stored.join(events.select("id"), "id", "left_semi")
    return export.differences(*both, "id", ("wrong",))


@query()
def bank_order(spark, d):
    return banks(spark, d).select("id", "name").orderBy(F.expr("name COLLATE zh"), "id")


@query()
def xlsx_round_trip(spark, d):
    """The exported sheet written as workbooks and read back through the data source."""
    from uuid import uuid4

    from quillforge.sources import xlsx

    folder = shared_dir(spark).removeprefix("file://") + f"/xlsx-{uuid4().hex}"
    xlsx.register(spark)
    export.sheet_rows(questions(spark, d)).drop("id").write.format("quill_xlsx").mode("append").save(folder)
    rows = xlsx.read_workbooks(spark, folder)
    return rows.select(F.regexp_extract("file", "([^/]*)$", 1).alias("file"), "sheet", "row_num", F.size("cells").alias("n_cells"))


@query(f"""
SELECT question_id, count(*) FILTER (WHERE kind = 'answer') AS attempts, count(*) FILTER (WHERE kind = 'answer' AND correct) AS correct,
  count(*) FILTER (WHERE kind = 'answer' AND NOT correct) AS wrong, count(*) FILTER (WHERE kind = 'star') % 2 = 1 AS starred FROM {_ONCE} x GROUP BY question_id
""")
def progress_stream(spark, d):
    from uuid import uuid4

    from quillforge.streaming import progress_stream as ps

    counts = ps.running_counts(ps.read_events(spark, d))
    name = f"progress_{uuid4().hex}"
    return ps.run_to_table(counts, name, checkpoint=f"{shared_dir(spark)}/{name}").select("question_id", "attempts", "correct", "wrong", "starred")


@query(f"SELECT question_id, attempts, correct, wrong, starred FROM ({_FOLD}) p")
def progress_stream_fold(spark, d):
    """The fold with drops and resets, kept up to date by the stream."""
    from pathlib import Path
    from uuid import uuid4

    from quillforge.sources.datasets import read_snapshot
    from quillforge.streaming import progress_stream as ps

    base = shared_dir(spark).removeprefix("file://") + f"/progress-{uuid4().hex}"
    # A table is a file or a folder of files, whose names say nothing.
    folder = f"{d}/progress_events.parquet"
    stream = ps.read_events(spark, folder, "*.parquet") if Path(folder).is_dir() else ps.read_events(spark, d)
    ps.merge_into_snapshot(ps.running_state(stream), f"{base}/store", f"{base}/check").awaitTermination()
    return read_snapshot(spark, f"{base}/store").filter("live > 0").select("question_id", "attempts", "correct", "wrong", "starred")
