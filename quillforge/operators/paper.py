"""Choosing and ordering the questions of a paper.

Shuffles take a seed and order by a hash of id and seed, so they are uniform,
repeatable and distributed; with a limit Spark keeps only the top rows of each
partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "all"
ALL_TYPES, ALL_DIFFICULTIES = "全部题型", "全部难度"
SIZES = (0, 10, 20, 50)


@dataclass(frozen=True)
class PaperConfig:
    """What a paper is made of; ``count`` 0 takes all questions."""

    bank_id: str = ALL
    type: str = ALL_TYPES
    difficulty: str = ALL_DIFFICULTIES
    lifesaving_only: bool = False
    shuffled: bool = True
    count: int = 20
    seed: str = "0"


def choose(questions: DataFrame, c: PaperConfig) -> DataFrame:
    """The filters of a paper; those set to "all" do nothing."""
    out = questions
    if c.bank_id != ALL:
        out = out.filter(F.col("bank_id") == c.bank_id)
    if c.type != ALL_TYPES:
        out = out.filter(F.col("type") == c.type)
    if c.difficulty != ALL_DIFFICULTIES:
        out = out.filter(F.col("difficulty") == c.difficulty)
    return out.filter(F.col("lifesaving")) if c.lifesaving_only else out


def shuffle_key(seed: str):
    return F.md5(F.concat_ws("|", F.col("id"), F.lit(seed)))


def shuffled(questions: DataFrame, seed: str) -> DataFrame:
    return questions.orderBy(shuffle_key(seed), "id")


def practice_paper(questions: DataFrame, c: PaperConfig) -> DataFrame:
    out = choose(questions, c)
    out = shuffled(out, c.seed) if c.shuffled else out.orderBy("id")
    return out.limit(c.count) if c.count else out


def exam_paper(questions: DataFrame, c: PaperConfig) -> DataFrame:
    out = shuffled(choose(questions, c), c.seed)
    return out.limit(c.count) if c.count else out


def starred_paper(questions: DataFrame, progress: DataFrame, bank_id: str = ALL, seed: str = "0") -> DataFrame:
    starred = progress.filter("starred").select(F.col("question_id").alias("id"))
    return shuffled(choose(questions, PaperConfig(bank_id=bank_id)).join(starred, "id", "left_semi"), seed)


def facets(questions: DataFrame) -> DataFrame:
    """Types and difficulties of each bank in the order of the ids that have them first.

    Each value is reduced to its smallest id before lists are made, so a list
    is as long as the number of different values, not of questions.
    """
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("type", "difficulty")))
    rows = questions.select("bank_id", "id", F.explode(kinds).alias("x")).select("bank_id", "id", "x.kind", "x.value").filter(F.coalesce("value", F.lit("")) != "")
    first = rows.groupBy("bank_id", "kind", "value").agg(F.min("id").alias("ord"))
    lists = first.groupBy("bank_id", "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "value"))), lambda s: s["value"]).alias("values"))
    pick = lambda kind: F.first(F.when(F.col("kind") == kind, F.col("values")), ignorenulls=True)
    return lists.groupBy("bank_id").agg(pick("type").alias("types"), pick("difficulty").alias("difficulties"))


CONFIG_JSON = "bankId string, type string, difficulty string, count int, order string, lifesavingOnly boolean"


def stored_configs(stored: DataFrame) -> DataFrame:
    """Configurations from JSON text (``config_id, json``), each field checked by itself.

    Text that is no JSON gives the defaults, and so does any single field of a
    wrong type or value.
    """
    c = F.from_json("json", CONFIG_JSON)
    rows = stored.select("config_id", c.alias("c"))
    size = F.when(F.col("c.count").isin(*SIZES), F.col("c.count")).otherwise(20)
    order = F.when(F.col("c.order").isin("random", "sequential"), F.col("c.order")).otherwise("random")
    return rows.select(
        "config_id",
        F.coalesce("c.bankId", F.lit(ALL)).alias("bank_id"),
        F.coalesce("c.type", F.lit(ALL_TYPES)).alias("type"),
        F.coalesce("c.difficulty", F.lit(ALL_DIFFICULTIES)).alias("difficulty"),
        size.alias("count"),
        order.alias("order"),
        F.coalesce("c.lifesavingOnly", F.lit(False)).alias("lifesaving_only"),
    )


def choices(questions: DataFrame) -> DataFrame:
    """The lists offered for each bank: the "all" entry, then the bank's types or difficulties."""
    f = facets(questions)
    none = F.array().cast("array<string>")
    return f.select(
        "bank_id",
        F.array_prepend(F.coalesce("types", none), ALL_TYPES).alias("types"),
        F.array_prepend(F.coalesce("difficulties", none), ALL_DIFFICULTIES).alias("difficulties"),
    )


def repaired(configs: DataFrame, questions: DataFrame) -> DataFrame:
    """Configurations with unknown banks, types and difficulties set back to "all", and odd sizes to 20.

    Types and difficulties are checked within the bank that is left.
    """
    banks = questions.select(F.col("bank_id").alias("known_bank")).distinct()
    out = configs.join(banks, configs["bank_id"] == banks["known_bank"], "left")
    out = out.withColumn("bank_id", F.coalesce("known_bank", F.lit(ALL))).drop("known_bank")
    for field, every in (("type", ALL_TYPES), ("difficulty", ALL_DIFFICULTIES)):
        one = questions.select("bank_id", F.col(field).alias("known"))
        known = one.unionByName(one.withColumn("bank_id", F.lit(ALL))).distinct().withColumnRenamed("bank_id", "in_bank")
        out = out.join(known, (out["bank_id"] == known["in_bank"]) & (out[field] == known["known"]), "left")
        out = out.withColumn(field, F.coalesce("known", F.lit(every))).drop("known", "in_bank")
    return out.withColumn("count", F.when(F.col("count").isin(*SIZES), F.col("count")).otherwise(20))
