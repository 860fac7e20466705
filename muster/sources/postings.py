"""Stored posting lists for the search (O-SEARCH): which agents of a run hold a token, a trigram of a name, or an owner.

A list lies at ``root/run=<id>/kind=<token|trigram|owner>``, sorted by key, so that a question reads the pages of its own keys: run and
kind are folders, and the keys are pushed into the files. A row is one agent, so long lists are split among tasks like any rows. The
similarity of a name follows from counts alone: shared trigrams, those of the name (in each row), and those of the question.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_SIMILAR = 0.3


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the words of a text, each word with two spaces before and one behind."""
    one = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(tokens(c), one)))


@dataclass(frozen=True)
class Question:
    """What is asked for, as values: planned once, not computed for each row."""

    text: str
    tokens: tuple[str, ...]
    trigrams: tuple[str, ...]

    @classmethod
    def of(cls, spark: SparkSession, q: str) -> Question:
        row = spark.range(1).select(F.array_distinct(tokens(F.lit(q))).alias("t"), trigrams(F.lit(q)).alias("g")).first()
        return cls(q, tuple(row["t"]), tuple(row["g"]))

    def near(self, shared: Column, size: Column) -> Column:
        """Shared trigrams by all trigrams; 0 where there are none."""
        return F.coalesce(shared / F.nullif(size + len(self.trigrams) - shared, F.lit(0)), F.lit(0.0))


def texts(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


@dataclass
class Postings:
    spark: SparkSession
    root: str
    run: str = "string"

    def add(self, agents: DataFrame) -> None:
        """Index agents (run, chain, agent_id, owner, name, description) of runs that aren't there yet."""
        words = agents.select("run", "chain", "agent_id", "owner", F.array_union(tokens(F.col("name")), tokens(F.col("description"))).alias("t"), trigrams(F.col("name")).alias("g"))
        size = F.size("g").alias("size")
        each = [("token", F.explode("t")), ("trigram", F.explode("g")), ("owner", F.lower("owner"))]
        rows = reduce(DataFrame.unionByName, (words.select("run", F.lit(kind).alias("kind"), key.alias("key"), "chain", "agent_id", size) for kind, key in each)).filter("key is not null")
        order = ["run", "kind", "key", "agent_id"]
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("run", "kind").mode("append").parquet(self.root)

    def lists(self, kind: str, runs: Sequence) -> DataFrame:
        rows = self.spark.read.schema(f"key string, chain string, agent_id long, size int, run {self.run}, kind string").parquet(self.root)
        return rows.filter((F.col("kind") == kind) & F.col("run").isin(list(runs)))

    def candidates(self, q: Question, runs: Sequence) -> DataFrame:
        """(run, chain, agent_id, near) of the agents that hold all tokens, or have a similar name, or an owner that begins so."""
        agent = ["run", "chain", "agent_id"]
        named = self.lists("trigram", runs).filter(F.col("key").isin(list(q.trigrams))).groupBy(*agent).agg(F.count("*").alias("shared"), F.max("size").alias("size")).select(*agent, q.near(F.col("shared"), F.col("size")).alias("near"))
        owned = self.lists("owner", runs).filter(F.col("key").startswith(q.text.lower())).select(*agent, F.lit(1).alias("sure"), F.lit(None).cast("double").alias("near"))
        held = self.lists("token", runs).filter(F.col("key").isin(list(q.tokens))).groupBy(*agent).agg(F.count("*").alias("n")).filter(F.col("n") == len(q.tokens))
        held = held.select(*agent, F.lit(1).alias("sure"), F.lit(None).cast("double").alias("near"))
        both = named.select(*agent, F.lit(None).cast("int").alias("sure"), "near").unionByName(owned).unionByName(held)
        found = both.groupBy(*agent).agg(F.max("sure").alias("sure"), F.coalesce(F.max("near"), F.lit(0.0)).alias("near"))
        return found.filter((F.col("sure") == 1) | (F.col("near") >= LEAST_SIMILAR)).select(*agent, F.round("near", 9).alias("near"))
