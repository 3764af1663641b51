"""A Merkle manifest of a table: one digest for all rows, and a proof for any of them.

Every row is a leaf. The leaves of a group (a source) are ordered by id, and each 16
consecutive nodes become one, until one is left: the group's root. The groups' roots,
ordered by group, become the root in the same way. The tree is stored as a
content-addressed graph: one record for each distinct inner node, from its digest to its
children's. Nothing else is needed to prove a row: a request is a group's rank and a
leaf's rank in it, and the digits of these ranks to the base 16 are the way down. From
the root on, each step looks up the record of a digest, follows the digit's child and
keeps the other children as that step's segment; reversed, the segments are the proof.
Requests that share a way go down together: a step holds one row for each distinct way
that some request takes, so the top is walked once and a record is read once a step.

Ranks come from a range partitioning of the written leaves, whose partitions are numbered
in order; only one row a partition meets in one task. Rows that are equal in all that is
hashed are told apart by a written random number, so they too are dealt over partitions.

Digests are SHA-256 in lower-case hex, and digests are concatenated as that text.

Defined results: a leaf's fields are written as their UTF-8 byte count, a colon and the
value, or ``-`` for null. Rows without an id come first in their group. Rows that share an
id are ordered by leaf digest; equal rows have proofs of their own places. The null group
comes first, then groups in the order of their UTF-8 bytes. A group of one leaf has that
leaf as its root. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.sources.shared import kept

#: Children of a node; a power of two.
FANOUT = 16
_BITS = FANOUT.bit_length() - 1
_HEX = 64
#: Rows of one range of the ranking, and stored bytes that one row of it stands for.
RANGE_ROWS = 1 << 17
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The digest of a row of documents, some of whose fields may be changed."""
    return digest(*(field(changed.get(name, F.col(name))) for name in FIELDS))


def tampered() -> Column:
    """Whether a row's text is tampered with in the self-check: where 5 divides the CRC of its id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def lowered() -> Column:
    return F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranged(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a written table in the order of ``keys`` and ``salt``, written: ``range`` and ``at``, a place in it."""
    keys = [*keys, "salt"]
    dealt = rows.repartitionByRange(max(1, -(-rows.count() // RANGE_ROWS)), *keys).sortWithinPartitions(*keys)
    # such an id is the number of the partition above 33 bits of the row's place in it
    at = kept(dealt.withColumn("at", F.monotonically_increasing_id()).drop("salt"), "ranged")
    return at.withColumn("range", F.shiftright("at", 33))


def shares(at: DataFrame, group: str) -> DataFrame:
    """One row for each range and group in it: where the group begins there, its rows before that range, and its rows in all."""
    share = at.groupBy("range", F.col(group).alias("group")).agg(F.min("at").alias("lowest"), F.count(F.lit(1)).alias("held"))
    own = Window.partitionBy("group")
    before = F.sum("held").over(own.orderBy("range")) - F.col("held")
    return share.select("range", "group", "lowest", before.alias("before"), F.sum("held").over(own).alias("n"))


def ranked(at: DataFrame, share: DataFrame, group: str) -> DataFrame:
    """Ranged rows with ``rank`` in their group and what else ``share`` has."""
    share = share.withColumnRenamed("range", "_range")
    met = at.join(share, (F.col("range") == F.col("_range")) & F.col(group).eqNullSafe(F.col("group")))
    return met.withColumn("rank", F.col("before") + F.col("at") - F.col("lowest")).drop("range", "_range", "at", "group", "before", "lowest")


@dataclass
class Manifest:
    """A stored tree. ``records``: node digest to children. ``groups``: group, its rank, n leaves, subroot. ``root`` of all."""

    records: DataFrame
    groups: DataFrame
    root: str | None
    n_groups: int
    tallest: int


def heights(n: int) -> int:
    """Steps from a root to its leaves."""
    steps = 0
    while n > 1:
        n, steps = -(-n // FANOUT), steps + 1
    return steps


def height(n: Column, most: int) -> Column:
    """As ``heights``, for a column of numbers that need at most ``most`` steps."""
    return sum((F.when(n > FANOUT**k, 1).otherwise(0) for k in range(most)), F.lit(0))


def fold(nodes: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """The root (of, digest) of each tree over (of, rank, digest, n), and the records of its inner nodes.

    ``of`` names the tree; ``n`` is the number of nodes of the tree's present level.
    """
    roots, records = [nodes.where("n = 1").select("of", "digest")], []
    for _ in range(most):
        run = F.array_sort(F.collect_list(F.struct("rank", "digest")))
        above = nodes.where("n > 1").groupBy("of", "n", F.shiftright("rank", _BITS).alias("up")).agg(run.alias("run"))
        children = F.transform("run", lambda x: x["digest"])
        above = above.select("of", F.col("up").alias("rank"), children.alias("children"), F.ceil(F.col("n") / FANOUT).alias("n"))
        level = kept(above.withColumn("digest", F.sha2(F.concat_ws("", "children"), 256)), "level")
        records.append(level.select("digest", "children"))
        nodes = level.select("of", "rank", "digest", "n")
        roots.append(nodes.where("n = 1").select("of", "digest"))
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return out, records


def build(leaves: DataFrame, group: str = "source") -> tuple[DataFrame, Manifest]:
    """Leaves with ``of`` (rank of their group), ``rank`` and ``n``, and the manifest.

    ``leaves`` is a written table with doc_id, the group, leaf and salt, a random number.
    """
    spark = leaves.sparkSession
    at = ranged(leaves, [group, "doc_id", "leaf"])
    share = kept(shares(at, group), "shares")
    found = share.groupBy("group").agg(F.max("n").alias("n_leaves")).select(F.col("group").alias("name"), "n_leaves")
    named = ranged(kept(found.withColumn("salt", F.lit(0)).withColumn("tree", F.lit(0)), "groups"), ["name"])
    groups = kept(ranked(named, shares(named, "tree"), "tree").select("name", F.col("rank").alias("of"), F.col("n_leaves").alias("n")), "groups")
    n_groups, most = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    # a group's number is joined to its ranges, not to its rows
    share = share.join(groups.select("name", "of"), F.col("group").eqNullSafe(F.col("name"))).drop("name")
    placed = kept(ranked(at, share, group), "placed")
    subroots, records = fold(placed.select("of", "rank", F.col("leaf").alias("digest"), "n"), heights(most))
    groups = kept(groups.join(subroots.withColumnRenamed("digest", "subroot"), "of"), "subroots")
    top = groups.select(F.lit(0).cast("long").alias("of"), F.col("of").alias("rank"), F.col("subroot").alias("digest"), F.lit(n_groups).cast("long").alias("n"))
    root, above = fold(top, heights(n_groups))
    root = root.first()
    stored = spark.createDataFrame([], "digest string, children array<string>")
    for level in records + above:
        stored = stored.unionByName(level)
    # equal nodes are one record
    stored = kept(stored.groupBy("digest").agg(F.first("children").alias("children")), "records")
    return placed, Manifest(stored, groups, root["digest"] if root else None, n_groups, heights(most))


def _step(ways: DataFrame, records: DataFrame) -> DataFrame:
    """One step down for each way (way, digest, segments, ..): a row for each child, with the others as a segment."""
    rest = [c for c in ways.columns if c not in {"way", "digest", "segments"}]
    met = ways.join(records, "digest").select(*rest, "way", "segments", "children", F.posexplode("children").alias("digit", "child"))
    return met.select(*rest, (F.col("way") * FANOUT + F.col("digit")).alias("way"), F.col("child").alias("digest"), _walked("digit").alias("segments"))


def _walked(digit: str) -> Column:
    """The segments so far and this step's: the digit and the unselected children end to end."""
    others = F.concat_ws("", F.filter("children", lambda _, i: i != F.col(digit)))
    return F.concat("segments", F.array(F.struct(F.col(digit).cast("int").alias("digit"), others.alias("others"))))


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` with ``subroot`` and ``proof``: segments (digit, others) from the leaf to the root.

    A request has ``of`` (the rank of its group), ``rank`` and ``n`` (leaves of its group).
    """
    spark, top, tallest = requests.sparkSession, heights(manifest.n_groups), manifest.tallest
    # the ways that some request takes, by their height over the leaves; each from the one below it
    groups = {0: kept(requests.select(F.col("of").alias("way")).distinct(), "ways")}
    for up in range(1, top):
        groups[up] = groups[up - 1].select(F.shiftright("way", _BITS).alias("way")).distinct()
    ways = {0: requests.select("of", F.col("rank").alias("way"))}
    for up in range(1, tallest):
        ways[up] = kept(ways[up - 1].select("of", F.shiftright("way", _BITS).alias("way")).distinct(), "ways")

    here = spark.createDataFrame([(0, manifest.root or "")], "way bigint, digest string")
    here = here.withColumn("segments", F.array().cast("array<struct<digit:int,others:string>>"))
    for up in reversed(range(top)):
        here = kept(_step(here, manifest.records).join(groups[up], "way", "left_semi"), "walk")
    sizes = manifest.groups.select("of", height(F.col("n"), tallest).alias("height"))
    reached = here.select(F.col("way").alias("of"), F.lit(0).cast("long").alias("way"), "digest", F.col("digest").alias("subroot"), "segments")
    reached = kept(reached.join(sizes, "of"), "walk")
    alone = requests.where("n = 1").join(reached.where("height = 0").select("of", "subroot", "segments"), "of")
    here = reached.where(F.lit(False))
    for up in reversed(range(1, tallest)):  # groups enter at their own height
        here = here.unionByName(reached.where(F.col("height") == up + 1))
        here = kept(_step(here, manifest.records).join(ways[up], ["of", "way"], "left_semi"), "walk")
    # the last step is taken where the requests are, so that no segments are copied for each leaf
    here = here.unionByName(reached.where("height = 1")).join(manifest.records, "digest").select("of", "way", "subroot", "segments", "children")
    met = requests.withColumn("way", F.shiftright("rank", _BITS)).join(here, ["of", "way"])
    met = met.withColumn("digit", F.col("rank").bitwiseAND(FANOUT - 1)).withColumn("segments", _walked("digit"))
    return alone.unionByName(met.select(*alone.columns)).withColumn("proof", F.reverse("segments")).drop("segments")


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""

    def up(node: Column, step: Column) -> Column:
        left = step["digit"] * _HEX
        return F.sha2(F.concat(F.substring(step["others"], F.lit(1), left), node, F.substring(step["others"], left + 1, F.lit((FANOUT - 1) * _HEX))), 256)

    return F.aggregate(proof, start, up)


def manifest_of(docs: DataFrame) -> tuple[DataFrame, Manifest]:
    """The placed leaves (doc_id, source, leaf, tampered_leaf, of, rank, n) of documents, and their manifest."""
    changed = F.when(tampered(), leaf(text=lowered())).otherwise(F.lit(None))
    rows = docs.select("doc_id", "source", leaf().alias("leaf"), changed.alias("tampered_leaf"), F.rand(7).alias("salt"))
    return build(kept(rows, "digests"))


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof, and whether its (partly tampered) text still folds to the root."""
    leaves, manifest = manifest_of(docs)
    out = prove(manifest, leaves).withColumn("root", F.lit(manifest.root))
    out = out.withColumn("folded_root", folded(F.coalesce("tampered_leaf", "leaf"), F.col("proof")))
    return out.select("doc_id", "source", "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
