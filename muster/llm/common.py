"""What several operators share: tables in the shared folder, ordered running totals, joins that survive
hot keys, and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.ship import ship

#: A key with at least this share of all rows is joined by broadcast; at most 1 / HEAVY_SHARE keys can have it.
HEAVY_SHARE = 1 / 1024

#: Bits of the map that tells which hashed keys are asked for; as a table it has 2**20 rows at most.
MAP_BITS = 26

#: Word pattern of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or a new local one where it is unset."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not place:
        place = tempfile.mkdtemp(prefix="muster-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", place)
    return place


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def per_batch(df: DataFrame, columns: list[str], work: Callable[..., dict], schema: T.StructType, rows: int = 2000) -> DataFrame:
    """Apply ``work(*lists) -> {column: list}`` to slices of at most ``rows`` rows of the given columns, on the executors."""
    arrow = pa.schema([(f.name, arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = work(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in kind.fields])
    return {
        T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string(), T.DoubleType(): pa.float64(), T.FloatType(): pa.float32(),
        T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary(),
    }[kind]


def running_totals(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows up to and including this one, in the given total order.

    Rows are dealt by range, summed inside each partition, and stored; the driver sees one number per partition.
    """
    dealt = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    dealt = dealt.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_sum", T.LongType())])
    at = df.columns.index(value)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = 0, TaskContext.get().partitionId()
        for b in batches:
            sums = total + np.cumsum(b.column(at).to_numpy(zero_copy_only=False).astype(np.int64))
            total = int(sums[-1]) if len(sums) else total
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(sums, pa.int64())], names=schema.names)

    local = stored(dealt.mapInArrow(add, schema), "totals")
    return with_offsets(local, local.groupBy("_part").agg(F.max("_sum").alias("n")).collect(), "_sum", out).drop("_part", "_sum")


def with_offsets(local: DataFrame, per_part: list, value: str, out: str, by: str | None = None) -> DataFrame:
    """Add to ``value`` what the partitions before ``_part`` hold (apart for each ``by``). One small row per partition."""
    so_far: dict = {}
    rows = []
    for r in sorted(per_part, key=lambda r: r["_part"]):
        k = r[by] if by else None
        rows.append((r["_part"], k, so_far.get(k, 0)) if by else (r["_part"], so_far.get(k, 0)))
        so_far[k] = so_far.get(k, 0) + r["n"]
    offsets = local.sparkSession.createDataFrame(rows, f"_part int, {f'{by} int, ' if by else ''}_offset long")
    return local.join(F.broadcast(offsets), ["_part", by] if by else ["_part"]).withColumn(out, F.col(value) + F.col("_offset")).drop("_offset")


def join_to_key(rows: DataFrame, keys: DataFrame, key: str | list[str], weight: str, total: int) -> DataFrame:
    """Inner-join stored ``rows`` to ``keys`` (one row per key; ``weight``: how many of the ``total`` rows it has).

    A key with 1/1024 of all rows or more is broadcast (the weights sum to the total, so these are 1024 at most);
    the others are joined by a shuffle, in which no key is hot.
    """
    least = max(1000, int(total * HEAVY_SHARE))
    hot = F.broadcast(keys.filter(F.col(weight) >= least))
    cold = keys.filter(F.col(weight) < least)
    return rows.join(hot, key).unionByName(rows.join(F.broadcast(hot.select(*([key] if isinstance(key, str) else key))), key, "left_anti").join(cold, key))


def narrowed(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` (a long, evenly hashed) isn't among the keys of ``wanted``, before a join.

    The keys asked for are marked in a bit map of fixed size, which is broadcast; rows share a bit by chance, so a join must
    follow. With many more keys than bits nothing is lost, the join just shuffles more."""
    spot = F.pmod(key, F.lit(1 << MAP_BITS))
    word = F.shiftright(spot, 6).cast("int")
    bits = wanted.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int"))).alias("_bits"))
    marked = rows.withColumn("_word", word).join(F.broadcast(bits), "_word")
    return marked.filter(F.getbit("_bits", (spot % 64).cast("int")) == 1).select(*rows.columns)


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph of long ids: one row (node, component) per node with an edge;
    component is the smallest id reachable. Alternates large-star and small-star steps until nothing changes;
    each step only shuffles edges and is stored in the shared folder."""
    spark = edges.sparkSession
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    state = _fingerprint(e)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        e = stored(small.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        new = _fingerprint(e)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    stars = e.groupBy("u").agg(F.min("v").alias("component"))
    return stored(stars.select(F.col("u").alias("node"), "component").unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")


def _fingerprint(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1_000_003)))).first())


def _apart(pairs: DataFrame, group: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows of ``pairs`` whose nodes ``a`` and ``b`` are in different groups."""
    of = lambda x: group.select(F.col("node").alias(x), F.col("component").alias(f"_{x}"))
    return pairs.join(of(a), a, "left").join(of(b), b, "left").filter(F.coalesce(f"_{a}", a) != F.coalesce(f"_{b}", b)).select(*pairs.columns)


def near_groups(dealt: DataFrame, total: int, close: Callable[[str, str], Column], verify: Callable[[DataFrame], DataFrame], label: str, known: DataFrame | None = None) -> DataFrame:
    """(node, component) of nodes that verified links join; ``known``: stored verified links (a, b) that another way has found.

    ``dealt``: (key, id, keys, size), one row for each of a node's ``keys``; nodes with a common key are candidates.
    ``close(a, b)``: of two sizes, whether the nodes can be near at all. ``verify``: of stored pairs (a, b), those that are.

    Large families aren't expanded into pairs: each node is first compared with the smallest node of all its keys, then with the
    smallest of each key that is in another group still, and then pairs of different groups are looked for, each at the first key
    that it shares: of any two groups the pair nearest in size, and the others where the two are different groups still. No candidate
    between groups is lost."""
    plain = dealt.select("key", "id", "size")
    buckets = plain.groupBy("key").agg(F.min(F.struct("id", "size")).alias("hub"), F.count("*").alias("members")).filter("members > 1")
    buckets = stored(buckets.select("key", F.col("hub.id").alias("hub"), F.col("hub.size").alias("hub_size"), "members"), f"{label}-buckets")
    shared = stored(join_to_key(narrowed(plain, "key", buckets), buckets, "key", "members", total), f"{label}-shared")
    stars = shared.filter(close("size", "hub_size") & (F.col("hub") != F.col("id"))).select(F.col("hub").alias("a"), F.col("id").alias("b"))
    stars = stars.distinct()
    if known is not None:
        stars = _apart(stars, components(known))
    stars = stored(stars, f"{label}-stars")
    nearest = stored(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), f"{label}-nearest")
    sure = verify(nearest)
    sure = stored(sure if known is None else sure.unionByName(known), f"{label}-links")
    apart = _apart(stars.join(nearest, ["a", "b"], "left_anti"), components(sure))
    sure = stored(sure.unionByName(verify(stored(apart, f"{label}-apart"))), f"{label}-links")
    first = components(sure).withColumnRenamed("node", "id")
    rows = shared.filter("members > 2").select("key", "id", "size").join(first, "id", "left").withColumn("g", F.coalesce("component", "id")).drop("component")
    rows = stored(rows, f"{label}-rows")
    mixed = rows.groupBy("key").agg(F.min("g").alias("low"), F.max("g").alias("high"), F.count("*").alias("members")).filter("low < high").select("key", "members")
    mixed = stored(join_to_key(rows, stored(mixed, f"{label}-mixed-keys"), "key", "members", total).drop("members"), f"{label}-mixed-rows")
    ids = stored(mixed.select("id").distinct(), f"{label}-ids")
    mixed = stored(mixed.join(dealt.select("id", "keys").join(ids, "id", "left_semi").dropDuplicates(["id"]), "id"), f"{label}-mixed")
    a, b = mixed.alias("a"), mixed.alias("b")
    first_shared = F.array_min(F.array_intersect("a.keys", "b.keys")) == F.col("a.key")
    near = (F.col("a.key") == F.col("b.key")) & (F.col("a.g") < F.col("b.g")) & close("a.size", "b.size") & first_shared
    of = (F.col("a.g").alias("low"), F.col("b.g").alias("high"), F.abs(F.col("a.size") - F.col("b.size")).alias("off"))
    pairs = a.join(b, near).select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b"), *of)
    rest = stored(pairs.join(stars, ["a", "b"], "left_anti"), f"{label}-pairs")
    # one link joins two groups, so the others between them needn't be verified
    one = stored(rest.groupBy("low", "high").agg(F.min(F.struct("off", "a", "b")).alias("p")).select("p.a", "p.b", "low", "high"), f"{label}-first-pairs")

    def joined(pairs: DataFrame) -> DataFrame:
        """Groups that verified ones of stored pairs link."""
        return verify(pairs.select("a", "b")).join(pairs, ["a", "b"]).select(F.col("low").alias("a"), F.col("high").alias("b"))

    links = stored(joined(one), f"{label}-first-links")
    others = stored(_apart(rest.join(one, ["a", "b"], "left_anti"), components(links), "low", "high"), f"{label}-other-pairs")
    of_groups = components(links.unionByName(joined(others))).select(F.col("node").alias("g"), F.col("component").alias("top"))
    grouped = first.join(of_groups, F.col("component") == F.col("g"), "left").select(F.col("id").alias("node"), F.coalesce("top", "component").alias("component"))
    alone = of_groups.join(first, F.col("g") == F.col("id"), "left_anti").select(F.col("g").alias("node"), F.col("top").alias("component"))
    return stored(grouped.unionByName(alone), f"{label}-groups")
