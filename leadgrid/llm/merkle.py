"""Merkle manifest of a table: leaf digests, a tree per source, a tree over the sources, and proofs.

A leaf is the SHA-256 of a row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and
its value. Per source, leaves ascend by id; every ``fan_out`` consecutive nodes become the digest of
their digests until one remains, and the sources' roots, in order, likewise.

The rollup is nested. A row's rank in its source is spelled in digits of base ``fan_out``. Blocks
are the rows that agree in all but the last ``depth`` digits: at most ``fan_out ** depth``
rows. Within a block the digits are grouped away one after the other, the last first; each step
turns the rows that differ in that digit into one row, which nests them as an array of structs and
carries their digest. All steps of a block need one shuffle, by (source, block). The blocks of
a source are rows of a tier above and are rolled up in the same way, until one is left.

Proofs come back down: a transform over the nested structs spells for each row its siblings of
every level, and an explode makes rows of them again. A block meets the proof of its own digest
by grouping both under (source, block); there is no join. Every task holds some blocks,
however large a source is.

Ranks come from one range sort of (source, id, leaf) and the places within its partitions. Texts
are hashed where they are read; only digests are shuffled.

Nulls: a null id comes first in its source, the null source first among the sources. Rows
that repeat an id are ordered by their leaves; equal rows are leaves of their own. An empty table
yields an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrid.operators.grouping import PARTITION_BITS
from leadgrid.session import cut_lineage, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEPS = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A field as the leaf hashes it."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def ranked(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``rank``, their place from 0 in their group, and ``n``, the rows of the group.

    Rows are range-sorted by group and order, equal rows spread by their place in the input. The rank
    is the place in a partition plus the group's rows in the partitions before: per group and
    partition one number, so that a group that fills all partitions is no hot key.
    """
    spread = rows.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id()))
    by = [F.asc_nulls_first(c) for c in (group, *order)]
    placed = spread.repartitionByRange(*by, "_spread").sortWithinPartitions(*by, "_spread").drop("_spread")
    placed = cut_lineage(placed.withColumn("_id", F.monotonically_increasing_id())) \
        .withColumn("_part", F.shiftright("_id", PARTITION_BITS))
    runs = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    of_group = Window.partitionBy(group)
    before = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = written(runs.select(F.col(group).alias("_group"), F.col("_part").alias("_at"), "_first",
                               F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                               F.sum("_n").over(of_group).alias("n")), "ranks")
    return placed.join(runs, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_at"))) \
                 .withColumn("rank", F.col("_id") - F.col("_first") + F.col("_before")) \
                 .drop("_id", "_part", "_group", "_at", "_first", "_before")


def power(fan_out: int, n: int) -> int:
    """Levels of a tree over ``n`` leaves."""
    levels, width = 0, 1
    while width < n:
        levels, width = levels + 1, width * fan_out
    return levels


def rolled_up(rows: DataFrame, group: str, fan_out: int, depth: int, base: int) -> DataFrame:
    """Blocks (group, n, rank, digest, kids) of rows (group, n, rank, digest, payload) at level ``base``.

    ``n`` counts the leaves of the group: a level that has one node only passes it on.
    """
    digits = [f"_d{i}" for i in range(depth)]
    nodes = rows.select(group, "n", F.expr(f"rank div {fan_out ** depth}").alias("block"), "digest", "payload",
                        *[F.expr(f"cast(rank div {fan_out ** i} % {fan_out} as int)").alias(d) for i, d in enumerate(digits)])
    # One shuffle: the blocks, whose every grouping below finds its rows together.
    nodes = nodes.repartition(group, "block")
    inner = "payload"
    for i, digit in enumerate(digits):
        kid = F.struct(F.col(digit).alias("at"), F.col("digest"), F.col(inner).alias("inner"))
        kids = nodes.groupBy(group, "n", "block", *digits[i + 1:]).agg(F.array_sort(F.collect_list(kid), _by_place).alias("_kids"))
        joined = F.sha2(F.array_join(F.transform("_kids", lambda k: k["digest"]), "").cast("binary"), 256)
        alone = F.col("_kids")[0]["digest"]
        several = F.col("n") > F.lit(fan_out ** (base + i))
        nodes = kids.select(group, "n", "block", *digits[i + 1:], F.when(several, joined).otherwise(alone).alias("digest"),
                            F.col("_kids").alias("kids"))
        inner = "kids"
    return nodes.withColumnRenamed("block", "rank")


def _by_place(a: Column, b: Column) -> Column:
    return a["at"] - b["at"]


def unrolled(kids: Column, n: Column, above: Column, fan_out: int, depth: int, base: int) -> Column:
    """Array of (rank digits as one number, payload, digest, steps) of every row nested in a block.

    A step holds the digests left and right of a node in its run; steps go from the row upwards.
    """
    none = F.array().cast(_STEPS)

    def side(kids: Column, start: Column, size: Column) -> Column:
        return F.array_join(F.transform(F.slice(kids, start, size), lambda k: k["digest"]), "")

    def spelled(kids: Column, level: int, above: Column, place: Column) -> Column:
        def one(kid: Column, i: Column) -> Column:
            step = F.struct(side(kids, F.lit(1), i).alias("left"),
                            side(kids, i + 2, F.greatest(F.size(kids) - i - 1, F.lit(0))).alias("right"))
            steps = F.concat(F.when(n > F.lit(fan_out ** (base + level)), F.array(step)).otherwise(none), above)
            here = place * fan_out + kid["at"]
            if level:
                return spelled(kid["inner"], level - 1, steps, here)
            return F.struct(here.alias("rank"), kid["inner"].alias("payload"), kid["digest"].alias("digest"), steps.alias("steps"))
        found = F.transform(kids, one)
        return F.flatten(found) if level else found
    return spelled(kids, depth - 1, above, F.lit(0).cast("long"))


def with_proofs(rows: DataFrame, group: str, fan_out: int, depth: int, top) -> DataFrame:
    """Rows (group, payload, digest, steps, crown) from rows (group, n, rank, digest, payload).

    ``top`` takes (group, digest), a row per group with the root of its tree, and returns (group, steps,
    crown): the steps above that root, and what all rows of the group are to carry.
    """
    nodes = written(rows.select(group, "n", "rank", "digest", "payload"), "merkle-leaves")
    tiers, levels = [], max(1, power(fan_out, nodes.agg(F.max("n")).first()[0] or 0))
    for base in range(0, levels, depth):
        height = min(depth, levels - base)
        blocks = written(rolled_up(nodes, group, fan_out, height, base), "merkle-blocks")
        tiers.append((blocks, base, height))
        # A block's digest is a node of the tier above; it brings nothing along.
        nodes = blocks.select(group, "n", "rank", "digest", F.lit(True).alias("payload"))
    proofs = top(nodes.select(group, "digest")).withColumn("rank", F.lit(0).cast("long"))
    for blocks, base, height in reversed(tiers):
        down = proofs.select(group, "rank", "steps", "crown", *[F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in ("n", "kids")])
        up = blocks.select(group, "rank", F.lit(None).cast(_STEPS).alias("steps"),
                           F.lit(None).cast(proofs.schema["crown"].dataType).alias("crown"), "n", "kids")
        met = up.unionByName(down).groupBy(group, "rank").agg(*[F.max_by(c, F.col(c).isNotNull()).alias(c) for c in ("steps", "crown", "n", "kids")])
        found = met.withColumn("found", F.explode(unrolled(F.col("kids"), F.col("n"), F.col("steps"), fan_out, height, base)))
        proofs = found.select(group, "crown", (F.col("rank") * fan_out ** height + F.col("found.rank")).alias("rank"),
                              F.col("found.payload").alias("payload"), F.col("found.digest").alias("digest"),
                              F.col("found.steps").alias("steps"))
        if base:
            proofs = written(proofs.drop("payload", "digest"), "merkle-proofs")
    return proofs.drop("rank")


def proof_text(steps: Column) -> Column:
    """All siblings, from the row upwards, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


def folded(digest: Column, steps: Column) -> Column:
    """The root that a digest leads to along the steps."""
    return F.aggregate(steps, digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]).cast("binary"), 256))


def merkle_manifest(docs: DataFrame, key: str = "doc_id", source: str = "source", fields: Sequence[str] = FIELDS,
                    claimed: Mapping[str, Column] | None = None, fan_out: int = 3, depth: int = 6) -> DataFrame:
    """Per row: key, leaf, subroot, root, steps, proof_sha256, folded_root, verified.

    ``claimed`` replaces fields in the row that is verified: its leaf is folded along the proof of the
    row as it stands. ``fan_out ** depth`` rows make a block, one row of some 200 bytes a leaf.
    """
    claim = leaf_digest([(claimed or {}).get(f, F.col(f)) for f in fields])
    leaf = leaf_digest([F.col(f) for f in fields])
    slim = docs.select(F.col(source).cast("string").alias("_source"), F.col(key).alias("_key"), leaf.alias("digest"), claim.alias("_claim"))
    rows = ranked(slim, "_source", ["_key", "digest"]).select(
        "_source", "n", "rank", "digest", F.struct(F.col("_key").alias("key"), F.col("_claim").alias("claim")).alias("payload"))

    def over_sources(roots: DataFrame) -> DataFrame:
        whole = ranked(roots.select(F.lit(0).alias("_all"), "_source", "digest"), "_all", ["_source"])
        nodes = whole.select("_all", "n", "rank", "digest", F.struct("_source").alias("payload"))

        def root(found: DataFrame) -> DataFrame:
            return found.select("_all", F.array().cast(_STEPS).alias("steps"), F.col("digest").alias("crown"))

        placed = with_proofs(nodes, "_all", fan_out, depth, root)
        return placed.select(F.col("payload._source").alias("_source"), "steps",
                             F.struct(F.col("digest").alias("subroot"), F.col("crown").alias("root")).alias("crown"))

    found = with_proofs(rows, "_source", fan_out, depth, over_sources)
    proven = found.select(F.col("payload.key").alias(key), F.col("digest").alias("leaf"), F.col("crown.subroot").alias("subroot"),
                          F.col("crown.root").alias("root"), "steps", F.sha2(proof_text(F.col("steps")).cast("binary"), 256).alias("proof_sha256"),
                          folded(F.col("payload.claim"), F.col("steps")).alias("folded_root"))
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def without_line_breaks(key: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """The tampering of the registered query: rows whose id has an even CRC-32 lose the line breaks of their text."""
    even = F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(2)) == 0
    return {text: F.when(even, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))}
