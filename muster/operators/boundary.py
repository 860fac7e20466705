"""The highest dense id of every chain by questions (SRC-3): doubling, bisection, and both sides of the border asked again.

All chains take a step together: a step is one join of a few questions with what can be answered, so that a search costs as many
jobs as the longest one has steps (twice the logarithm of the answer). The state is a row for each chain of the registry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: The largest id. (A fixed value.)
MOST = (1 << 64) - 1


def by_table(existing: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Answers from a table (chain, id): an id is there if it has a row. A null id is an answer that can't be had, for its whole chain."""
    from pyspark.sql import functions as F

    def ask(questions: DataFrame) -> DataFrame:
        there = existing.select("chain", F.col("id").cast("decimal(20,0)").alias("id"), F.lit(True).alias("there")).join(F.broadcast(questions), ["chain", "id"], "left_semi").distinct()
        return questions.join(there, ["chain", "id"], "left").select("chain", "id", F.coalesce("there", F.lit(False)).alias("there"))

    return ask


def highest_ids(spark: SparkSession, chains: list[str], ask: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(chain, highest, steps, error) of each chain: highest is null where id 0 isn't there.

    ``ask`` takes questions (chain, id decimal) and gives (chain, id, there); an answer may be null or left out, which ends the search of
    that chain (error ``unreadable``). A border whose sides answer otherwise when asked again is an error (``boundary_check_failed``), and
    so is a search that would pass the largest id (``overflow``). Holes under the border aren't seen."""
    state = {c: {"phase": "first", "lo": 0, "hi": None, "steps": 0, "error": None, "highest": None} for c in dict.fromkeys(chains)}

    def questions(s: dict) -> list[int]:
        if s["phase"] == "first":
            return [0]
        if s["phase"] == "double":
            return [s["hi"]]
        return [s["lo"] + (s["hi"] - s["lo"]) // 2] if s["phase"] == "bisect" else [s["lo"], s["hi"]]

    while open_ := {c: questions(s) for c, s in state.items() if s["phase"] != "done"}:
        asked = spark.createDataFrame([(c, str(i)) for c, ids in open_.items() for i in ids], "chain string, id string").selectExpr("chain", "cast(id as decimal(20,0)) as id")
        answers = {(r["chain"], int(r["id"])): r["there"] for r in ask(asked).collect()}
        for c, ids in open_.items():
            said = [answers.get((c, i)) for i in ids]
            _step(state[c], ids, said)
    rows = [(c, None if s["highest"] is None else str(s["highest"]), s["steps"], s["error"]) for c, s in state.items()]
    return spark.createDataFrame(rows, "chain string, highest string, steps int, error string").selectExpr("chain", "cast(highest as decimal(20,0)) as highest", "steps", "error")


def _step(s: dict, ids: list[int], said: list[bool | None]) -> None:
    s["steps"] += 1
    if any(x is None for x in said):
        s["phase"], s["error"] = "done", "unreadable"
    elif s["phase"] == "first":
        s["phase"], s["hi"] = ("double", 1) if said[0] else ("done", None)
    elif s["phase"] == "double" and said[0]:
        s["lo"], s["hi"] = s["hi"], s["hi"] * 2
        if s["hi"] > MOST:
            s["phase"], s["error"] = "done", "overflow"
    elif s["phase"] == "check":
        s["phase"], s["highest"], s["error"] = ("done", s["lo"], None) if said == [True, False] else ("done", None, "boundary_check_failed")
    else:
        if s["phase"] == "bisect":
            s["lo"], s["hi"] = (ids[0], s["hi"]) if said[0] else (s["lo"], ids[0])
        s["phase"] = "bisect" if s["hi"] - s["lo"] > 1 else "check"
