"""A Merkle manifest of a table: digests in runs of sixteen per group, groups in runs of sixteen below one root.

The levels are built by grouping and stored as rows linked to their parents. A recursive query then climbs from every
leaf to the root: each step joins the run above, puts the digest so far in the leaf's slot, hashes, and appends the other
digests of the run. All leaves of one run share what lies above it, so only one leaf of a run carries the siblings; the
others climb with their folded digest alone.

Rows of one group stand by key, then by leaf digest, so ties and repeated rows have a place each, the same in every run.
A null group is a group of its own, the first; a null key stands before all keys. Empty tables give no rows.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from lexitrack.operators.numbering import NTH, PART, offsets, numbered, placed
from lexitrack.session import shared_dir

FAN = 16
_HEX = 64  # characters of a digest
_TOP = -1  # the tree above the groups' trees

_CLIMB = """
WITH RECURSIVE climb(tree0, pos0, tree, level, run, slot, folded, siblings, first) AS (
  SELECT tree0, pos0, tree, level, run, slot, folded, siblings, true FROM {starts}
  UNION ALL
  SELECT c.tree0, c.pos0, r.up_tree, r.up_level, r.up_run, r.up_slot,
    sha2(concat(left(r.digests, c.slot * 64), c.folded, substr(r.digests, c.slot * 64 + 65)), 256),
    CASE WHEN c.first THEN c.siblings
         ELSE concat(c.siblings, left(r.digests, c.slot * 64), substr(r.digests, c.slot * 64 + 65)) END,
    false
  FROM climb c JOIN {runs} r ON c.tree = r.tree AND c.level = r.level AND c.run = r.run
)
SELECT tree0, pos0, folded, siblings FROM climb WHERE tree IS NULL
"""


def field(c: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and its text; ``-`` for null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def without(digests: Column, slot: Column) -> Column:
    """The digests of a run but the one in ``slot``."""
    return F.concat(F.left(digests, slot * _HEX), F.substr(digests, slot * _HEX + 1 + _HEX))


@contextmanager
def _unlimited(spark: SparkSession):
    """A climb has as many rows as leaves times levels; Spark's default stops a recursion at a million."""
    name = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def _up(tree: Column, level: int | Column, pos: Column, size: Column, trees: int) -> list[Column]:
    """The run above a node and its slot in it: in its own tree, from a tree's last node in the tree of the groups."""
    level = F.lit(level) if isinstance(level, int) else level
    inside, above = size > 1, (tree != _TOP) & F.lit(trees > 1)

    def link(own: Column, top: Column, name: str) -> Column:
        return F.when(inside, own).when(above, top).cast("long").alias(name)

    return [
        link(tree, F.lit(_TOP), "up_tree"), link(level + 1, F.lit(1), "up_level"),
        link(F.floor(pos / FAN), F.floor(tree / FAN), "up_run"), link(pos % FAN, tree % FAN, "up_slot").cast("int").alias("up_slot"),
    ]


def _run(nodes: DataFrame, level: int, trees: int) -> DataFrame:
    """The runs of a level's nodes, each linked to the run above it. A run has at most sixteen digests."""
    members = F.array_sort(F.collect_list(F.struct((F.col("pos") % FAN).alias("slot"), "digest")))
    runs = (
        nodes.filter(F.col("size") > 1)
        .groupBy("tree", F.floor(F.col("pos") / FAN).alias("run"))
        .agg(members.alias("members"), F.first("size").alias("below"))
        .withColumn("size", F.ceil(F.col("below") / FAN))
        .withColumn("digests", F.array_join(F.col("members.digest"), ""))
    )
    return runs.select(
        "tree", F.lit(level).cast("long").alias("level"), "run", "size", "digests", F.sha2("digests", 256).alias("digest"),
        *_up(F.col("tree"), level, F.col("run"), F.col("size"), trees),
    )


def _grow(spark: SparkSession, nodes: DataFrame, largest: int, trees: int, folder: str) -> DataFrame | None:
    """All runs above the nodes, level by level, stored; None where no tree has two nodes."""
    paths, level = [], 0
    while largest > 1:
        level, largest = level + 1, -(-largest // FAN)
        paths.append(f"{folder}/level-{level}")
        _run(nodes, level, trees).write.parquet(paths[-1])
        nodes = spark.read.parquet(paths[-1]).select("tree", F.col("run").alias("pos"), "digest", "size")
    return spark.read.parquet(*paths) if paths else None


class Manifest:
    """Stored leaves (tree, pos, size, key, leaf, changed), runs and trees (tree, size, subroot), and the root."""

    def __init__(self, leaves: DataFrame, runs: DataFrame, trees: DataFrame, count: int, root: str | None):
        self.leaves, self.runs, self.trees, self.count, self.root = leaves, runs, trees, count, root


_RUNS = (
    "tree long, level long, run long, size long, digests string, digest string, up_tree long, up_level long, up_run long, up_slot int"
)


def build(leaves: DataFrame, folder: str | None = None) -> Manifest:
    """The manifest of leaves (key, group, leaf, changed): ``changed`` is a digest to climb with instead, or null.

    Leaves are sorted by ranges of (group, key, leaf), so a group with a third of all rows is spread over many tasks,
    and numbered by the partitions' counts.
    """
    spark = leaves.sparkSession
    folder = folder or shared_dir(spark, "merkle")
    order = ["group", "key", "leaf"]
    placed(leaves.repartitionByRange(*order).sortWithinPartitions(*order)).write.parquet(f"{folder}/sorted")
    stored = spark.read.parquet(f"{folder}/sorted")

    counts = offsets(stored, ("group",))
    sizes = counts.groupBy("group").agg(F.sum("of_part").alias("size")).orderBy("group")
    placed(sizes).write.parquet(f"{folder}/groups")
    groups = numbered(spark.read.parquet(f"{folder}/groups"), "tree")
    totals = groups.agg(F.count("*").alias("n"), F.max("size").alias("largest")).first()
    trees, largest = totals["n"], totals["largest"] or 0

    # A row per partition and group, so a hot group is no hot key.
    known = groups.select(F.col("group").alias("__group"), "tree", "size")
    starts = counts.join(known, F.col("group").eqNullSafe(F.col("__group"))).select(
        F.col(PART).alias("__at"), "__group", "tree", "size", (F.col("before") - F.col("first")).alias("shift")
    )
    found = stored.join(starts, (F.col(PART) == F.col("__at")) & F.col("group").eqNullSafe(F.col("__group")))
    found.select(
        "tree", (F.col(NTH) + F.col("shift")).alias("pos"), "size", "key", "leaf", "changed"
    ).write.parquet(f"{folder}/leaves")
    rows = spark.read.parquet(f"{folder}/leaves")

    nodes = rows.select("tree", "pos", F.col("leaf").alias("digest"), "size")
    below = _grow(spark, nodes, largest, trees, f"{folder}/runs")
    single = nodes.filter("size = 1").select("tree", "digest")
    last = single if below is None else single.unionByName(below.filter("size = 1").select("tree", "digest"))
    groups.join(last.withColumnRenamed("tree", "__tree"), F.col("tree") == F.col("__tree")).select(
        "tree", "size", F.col("digest").alias("subroot")
    ).write.parquet(f"{folder}/trees")
    subroots = spark.read.parquet(f"{folder}/trees")
    top = subroots.select(
        F.lit(_TOP).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("subroot").alias("digest"),
        F.lit(trees).cast("long").alias("size"),
    )
    above = _grow(spark, top, trees, trees, f"{folder}/top")
    all_runs = [r for r in (below, above) if r is not None]
    runs = all_runs[0] if all_runs else spark.createDataFrame([], _RUNS)
    runs = runs if len(all_runs) < 2 else runs.unionByName(all_runs[1])
    root = subroots.select("subroot").first() if above is None else above.filter("size = 1").select("digest").first()
    return Manifest(rows, runs, subroots, trees, root[0] if root else None)


def climb(manifest: Manifest, folder: str | None = None) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf, by one recursive query."""
    spark = manifest.leaves.sparkSession
    folder = folder or shared_dir(spark, "merkle-climb")
    start = manifest.leaves.select(
        F.col("tree").alias("tree0"), F.col("pos").alias("pos0"), "key", "leaf", "changed",
        *_up(F.col("tree"), 0, F.col("pos"), F.col("size"), manifest.count),
    ).withColumnsRenamed({"up_tree": "tree", "up_level": "level", "up_run": "run", "up_slot": "slot"})
    # The first leaf of a run carries the siblings above it. A window has at most sixteen rows.
    first = F.row_number().over(Window.partitionBy("tree", "level", "run").orderBy("slot")) == 1
    linked = start.filter("tree IS NOT NULL").withColumn("siblings", F.when(first, F.lit("")))
    linked.write.parquet(f"{folder}/starts")
    starts = spark.read.parquet(f"{folder}/starts")
    with _unlimited(spark):
        spark.sql(
            _CLIMB, starts=starts.withColumn("folded", F.coalesce("changed", "leaf")), runs=manifest.runs
        ).write.parquet(f"{folder}/climbed")
    climbed = spark.read.parquet(f"{folder}/climbed")

    run_key = ["tree", "level", "run"]
    carriers = climbed.filter("siblings IS NOT NULL").select("tree0", "pos0", F.col("siblings").alias("above"))
    above = starts.filter("siblings IS NOT NULL").select("tree0", "pos0", *run_key).join(carriers, ["tree0", "pos0"])
    runs = above.select(*run_key, "above").join(manifest.runs.select(*run_key, "digests"), run_key)
    folded = starts.select("tree0", "pos0", "key", "leaf", *run_key, "slot").join(
        climbed.select("tree0", "pos0", F.col("folded").alias("folded_root")), ["tree0", "pos0"]
    )
    proved = folded.join(runs, run_key).select(
        F.col("tree0").alias("__tree"), "key", "leaf", "folded_root",
        F.sha2(F.concat(without(F.col("digests"), F.col("slot")), "above"), 256).alias("proof_sha256"),
    )
    alone = start.filter("tree IS NULL").select(
        F.col("tree0").alias("__tree"), "key", "leaf", F.coalesce("changed", "leaf").alias("folded_root"),
        F.sha2(F.lit(""), 256).alias("proof_sha256"),
    )
    root = F.lit(manifest.root).cast("string")
    return proved.unionByName(alone).join(
        manifest.trees.select("tree", "subroot"), F.col("__tree") == F.col("tree")
    ).select(
        "key", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")
    )
