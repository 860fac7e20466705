"""Runs on Parquet: versioned partitions, published by the run's own row (SNK-1, SNK-8, SRC-14, SRC-15, LIF-1 to LIF-11, SET-2, UDF-3).

A table lies at ``root/<table>/run=<id>/v=<version>``, and every write makes a new version, which no reader sees. ``root/log`` holds
a row for each change of a run's state: the newest row of a run is its state, and its ``tables`` says which version of each table
counts. A change is one appended file of one row, so all tables of a run change at once or not at all: a publication that stops
halfway leaves the versions that the run had, and an empty replacement is a version without rows. Readers see the tables of finished
runs; partitions of other runs and versions aren't read. ``vacuum`` deletes versions that no run names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from muster.operators.documents import project_document, with_document

RUN = (
    "run string, chain string, chain_id long, status string, started_at timestamp, finished_at timestamp, heartbeat_at timestamp, pinned_block long, agent_count long, unreadable long, unwritable long, "
    "checker string, schema_version int, end_reason string"
)
LOG = f"{RUN}, seq long, stamp string, tables map<string,string>"
STATES = ("running", "finished", "failed", "stalled", "unknown")
#: Errors of a progress table are cut to so many characters. (A fixed value.)
ERROR_CHARS = 2000
#: Seconds without a written agent after which a running run is stalled, and seconds it has for the first one. (Fixed values.)
QUIET, GRACE = 900, 3600
#: Runs up to which their versions are broadcast to the readers of a table.
MOST_BROADCAST = 100_000


def names(schema: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in schema.split(", ")]


def agent_documents(fetched: DataFrame) -> DataFrame:
    """UDF-3, S-DOC: agent_id, name, description and error of fetched bodies (agent_id, body); what can't be read has its error."""
    return project_document(with_document(fetched.select("agent_id", "body"))).select("agent_id", *(F.col(f"doc_{c}").alias(c) for c in ("name", "description", "error")))


@dataclass
class RunStore:
    """``projections``: tables that are derived when another is written, by name: (derived table, function of the written rows). They
    are named by the same row as what they come from, so that no reader sees one without the other."""

    spark: SparkSession
    root: str
    projections: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = field(default_factory=dict)

    def _read(self, name: str, schema: str) -> DataFrame:
        """A folder's rows; a folder that isn't there yet has none."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _states(self) -> DataFrame:
        """LOG with the newest row of each run."""
        columns = names(LOG)
        newest = self._read("log", LOG).groupBy("run").agg(F.max_by(F.struct(*columns), F.struct("seq", "stamp")).alias("x"))
        return newest.select(*(F.col(f"x.{c}").alias(c) for c in columns))

    def runs(self) -> DataFrame:
        """All runs as they are now."""
        return self._states().select(*names(RUN))

    def versions(self, name: str, unfinished: bool = False) -> DataFrame:
        """(run, v): which version of a table counts, of finished runs (or of all)."""
        at = self._states() if unfinished else self._states().filter("status = 'finished'")
        return at.select("run", F.col("tables")[name].alias("v")).filter("v is not null")

    def table(self, name: str, schema: str, unfinished: bool = False, run: str | None = None) -> DataFrame:
        """A table's rows (with ``run``) of finished runs, or of all; only partitions of the versions that count are read."""
        rows, at = self._read(name, f"{schema}, run string, v string"), self.versions(name, unfinished)
        if run is not None:
            rows, at = rows.filter(F.col("run") == run), at.filter(F.col("run") == run)
        few = run is not None or at.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
        return rows.join(F.broadcast(at) if few else at, ["run", "v"], "left_semi").select(*names(schema), "run")

    def _append(self, rows: DataFrame) -> None:
        rows.select(*names(LOG)).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def _change(self, before: DataFrame, values: dict[str, Column], tables: Column | None = None) -> None:
        """Append a next row for each row of ``before`` (LOG) with the given values."""
        kinds = dict(self.spark.createDataFrame([], RUN).dtypes)
        kept = [values[c].cast(kinds[c]).alias(c) if c in values else F.col(c) for c in names(RUN)]
        self._append(before.select(*kept, (F.coalesce("seq", F.lit(0)) + 1).alias("seq"), F.uuid().alias("stamp"), (F.col("tables") if tables is None else tables).alias("tables")))

    def _state(self, run: str, tables: dict[str, str] | None = None, only: bool = False, **values) -> None:
        """LIF-1: a run's next row, the named values changed; ``tables``: new versions (``only``: and no others)."""
        if values.get("status", "running") not in STATES:
            raise ValueError(f"status {values['status']!r} is not one of {', '.join(STATES)}")
        before = self.spark.createDataFrame([(run,)], "run string").join(self._states(), "run", "left")
        new = F.create_map(*(F.lit(x) for pair in (tables or {}).items() for x in pair)).cast("map<string,string>")
        old = F.coalesce("tables", F.create_map().cast("map<string,string>"))
        kept = F.map_filter(old, lambda k, _: ~k.isin([*(tables or {}), ""]))
        self._change(before, {k: F.lit(v) for k, v in values.items()}, new if only else F.map_concat(kept, new))

    def open(self, run: str, chain: str, pinned_block: int | None, **values) -> None:
        """LIF-1, LIF-3: a running run; one that was opened before keeps its pin."""
        before = self.runs().filter(F.col("run") == run).first()
        pin = pinned_block if before is None or before["pinned_block"] is None else before["pinned_block"]
        self._state(run, chain=chain, status="running", pinned_block=pin, **values)

    def pin(self, run: str) -> int:
        """LIF-2: the block that a run looks at; a run without one is a LookupError."""
        row = self.runs().filter(F.col("run") == run).first()
        if row is None or row["pinned_block"] is None:
            raise LookupError(f"run {run} has no pinned block")
        return row["pinned_block"]

    def restamp(self, run: str, checker: str, schema_version: int) -> None:
        """LIF-2: name the rules by which a run was judged again."""
        self._state(run, checker=checker, schema_version=schema_version)

    def beat(self, run: str, at) -> None:
        """LIF-1: a run that still runs has written an agent at this time; one that has ended stays ended."""
        self._change(self._states().filter((F.col("run") == run) & (F.col("status") == "running")), {"heartbeat_at": F.lit(at)})

    def stalled(self, now, quiet: int = QUIET, grace: int = GRACE) -> DataFrame:
        """LIF-1: running runs that wrote nothing for ``quiet`` seconds, or no first agent for ``grace`` seconds."""
        return self._stalled(now, quiet, grace).select(*names(RUN))

    def _stalled(self, now, quiet: int, grace: int) -> DataFrame:
        age = lambda c: F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(c)
        late = F.when(F.col("heartbeat_at").isNotNull(), age("heartbeat_at") > quiet).otherwise(age("started_at") > grace)
        return self._states().filter((F.col("status") == "running") & late)

    def end_stalled(self, now, quiet: int = QUIET, grace: int = GRACE) -> int:
        """LIF-1: give all stalled runs that status, and say how many there were."""
        late = self._stalled(now, quiet, grace)
        reason = F.when(F.col("heartbeat_at").isNotNull(), f"nothing written for {quiet} s").otherwise(f"no first agent after {grace} s")
        found = late.count()
        if found:
            self._change(late, {"status": F.lit("stalled"), "end_reason": reason})
        return found

    def _write(self, run: str, name: str, rows: DataFrame, version: str | None = None) -> str:
        """A version of a table that nothing names yet (or more rows of one that is named)."""
        version = version or uuid.uuid4().hex
        rows.withColumns({"run": F.lit(run), "v": F.lit(version)}).write.partitionBy("run", "v").mode("append").parquet(f"{self.root}/{name}")
        return version

    def _written(self, run: str, tables: dict[str, DataFrame]) -> dict[str, str]:
        """New versions of tables and of what is derived from them (from the rows as they were written)."""
        versions = {}
        for name, rows in tables.items():
            versions[name] = self._write(run, name, rows)
            derived, make = self.projections.get(name, (None, None))
            if derived is not None and derived not in tables:
                schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
                own = self._read(name, f"{schema}, run string, v string").filter((F.col("run") == run) & (F.col("v") == versions[name])).drop("run", "v")
                versions[derived] = self._write(run, derived, make(own))
        return versions

    def put(self, run: str, name: str, rows: DataFrame) -> None:
        """SNK-8, LIF-10: a run's rows of a table, in place of what it had there, which may be more, or none."""
        self._state(run, self._written(run, {name: rows}))

    def add(self, run: str, name: str, rows: DataFrame) -> None:
        """SET-2: more rows of a running run's table, as a job that can be resumed writes them."""
        row = self._states().filter(F.col("run") == run).select("status", F.col("tables")[name].alias("v")).first()
        if row is None or row["status"] != "running":
            raise ValueError(f"run {run} is not running")
        if name in self.projections:
            raise ValueError(f"{name} is projected as a whole; put it")
        version = self._write(run, name, rows, row["v"])
        if row["v"] is None:
            self._state(run, {name: version})

    def publish(self, run: str, tables: dict[str, DataFrame], complete: bool = True, only: bool = False, **values) -> None:
        """SNK-1, LIF-8: write tables of a run, then one row that names them all: finished, or failed if it wasn't read completely.

        A run that was there shows its old tables until then. Tables that aren't named stay (``only``: go)."""
        self._state(run, self._written(run, tables), only, **({"status": "finished" if complete else "failed"} | values))

    def remaining(self, ids: DataFrame, run: str, name: str, schema: str, key: str) -> DataFrame:
        """LIF-3, SET-2: the ids that a run hasn't written yet."""
        return ids.join(self.table(name, schema, unfinished=True, run=run).select(key).distinct(), key, "left_anti")

    def exportable(self, run: str) -> DataFrame:
        """LIF-7: the row of a finished run; another is a LookupError. What wasn't counted stays null."""
        row = self.runs().filter((F.col("run") == run) & (F.col("status") == "finished"))
        if row.limit(1).count() == 0:
            raise LookupError(f"run {run} is not finished")
        return row

    def vacuum(self, name: str) -> int:
        """Delete the versions of a table that no run names, and say how many. For a time without writers and long readers."""
        jvm, path = self.spark.sparkContext._jvm, f"{self.root}/{name}"
        fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        there = [(s.getPath().getName().removeprefix("v="), s.getPath()) for s in (fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/run=*/v=*")) or [])]
        named = {r["v"] for r in self.versions(name, unfinished=True).collect()}
        gone = [p for v, p in there if v not in named]
        for p in gone:
            fs.delete(p, True)
        return len(gone)


MANIFEST = (
    "run_id string, chain string, chain_id long, registry string, started_at timestamp, finished_at timestamp, pinned_block long, swept long, agent_count long, unreadable long, unwritable long, "
    "checker_version string, checker_commit string, spec_commit string, schema_version int"
)
AGENT = (
    "agent_id long, token_id string, owner string, agent_uri string, block_number long, checks array<struct<rung:int,status:string,evidence:string>>, "
    "http_status int, content_type string, body_bytes long, body_sha256 string, final_url string"
)
SNAPSHOTS = "agent_id long, token_id string, owner string, agent_uri string, block_number long"
CHECKS = "agent_id long, rung int, status string, evidence string"
FETCHES = "agent_id long, http_status int, content_type string, body_bytes long, body_sha256 string, final_url string"


def read_archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-14: (manifest, agents ordered by id) of an archive folder with manifest.json and one JSON file for each agent.

    There must be one manifest and an agent at least (ValueError)."""
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "manifest.json").option("multiLine", "true").schema(MANIFEST).json(path)
    if (n := found.count()) != 1:
        raise ValueError(f"{n} manifests in {path}, not one")
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").option("multiLine", "true").schema(AGENT).json(path)
    agents = files.filter(~F.col("_metadata.file_name").eqNullSafe("manifest.json")).orderBy("agent_id")
    if agents.limit(1).count() == 0:
        raise ValueError(f"no agents in {path}")
    return found, agents


def import_archive(store: RunStore, path: str, chains: DataFrame, replace: bool = False) -> DataFrame:
    """LIF-6: bring an archive in, and return the chains, with its own added (disabled) if it was missing.

    A run that is there needs ``replace``, and then loses all its tables for those of the archive, at once; a chain known by another
    id is refused (ValueError). The number of agents is what the manifest swept, else what it counts, else the number of files;
    without an end the run's status is unknown. Of what was fetched an archive has the summary (``http_archive`` without bodies)."""
    manifest, agents = read_archive(store.spark, path)
    m = manifest.first()
    if not replace and store.runs().filter(F.col("run") == m["run_id"]).limit(1).count():
        raise ValueError(f"run {m['run_id']} is there already; replace it by name")
    known = chains.filter(F.col("chain") == m["chain"]).first()
    if known is not None and known["chain_id"] != m["chain_id"]:
        raise ValueError(f"chain {m['chain']} has id {known['chain_id']}, the archive says {m['chain_id']}")
    size = m["swept"] if m["swept"] is not None else m["agent_count"]
    size = agents.count() if size is None else size
    tables = {"snapshots": agents.select(*names(SNAPSHOTS)), "checks": agents.select("agent_id", F.inline("checks")), "http_archive": agents.select(*names(FETCHES)).filter("http_status is not null or body_sha256 is not null or final_url is not null")}
    keep = ("chain", "chain_id", "started_at", "finished_at", "pinned_block", "unreadable", "unwritable", "schema_version")
    store.publish(m["run_id"], tables, only=True, status="finished" if m["finished_at"] else "unknown", agent_count=size, checker=m["checker_version"], **{k: m[k] for k in keep})
    if known is None:
        chains = chains.unionByName(store.spark.createDataFrame([(m["chain"], m["chain_id"], False)], "chain string, chain_id long, enabled boolean"))
    return chains


def replaced_rung(checks: DataFrame, rung: int, rows: DataFrame, key: Iterable[str] = ("run", "agent_id")) -> DataFrame:
    """SNK-7: ``checks`` with all rows of a rung taken out for the agents of ``rows``, and ``rows`` put in (those with a status)."""
    agents = rows.select(*key).distinct().withColumn("rung", F.lit(rung))
    return checks.join(agents, [*key, "rung"], "left_anti").unionByName(rows.filter(F.col("status").isNotNull()).select(*checks.columns))


def recomputed(stored: DataFrame, fresh: DataFrame, key: str = "run", dry: bool = True) -> DataFrame:
    """LIF-4: stored and recomputed deltas side by side where they differ (dry), or the recomputed ones."""
    if not dry:
        return fresh
    values = [c for c in fresh.columns if c != key]
    a, b = stored.select(key, F.struct(*values).alias("stored")), fresh.select(key, F.struct(*values).alias("recomputed"))
    return a.join(b, key, "full").filter(~F.col("stored").eqNullSafe(F.col("recomputed")))


def progress(before: DataFrame, results: DataFrame, error: Column | None = None) -> DataFrame:
    """LIF-11: (id, ok, error) of all ids done so far: new results are added, an id that failed before is asked again."""
    cut = F.substring(F.col("error") if error is None else error, 1, ERROR_CHARS)
    new = results.select("id", cut.isNull().alias("ok"), cut.alias("error"))
    return before.join(new, "id", "left_anti").unionByName(new)


def to_ask(ids: DataFrame, before: DataFrame) -> DataFrame:
    """LIF-11: ids without a good result."""
    return ids.join(before.filter("ok"), "id", "left_anti")
