"""A manifest of a data set as a Merkle tree, with proofs by descent from its root.

Every row is a leaf, the leaves of each group (language) form a tree by rank, and the roots of these form the
top tree. Each level is written as records from a digest to its children. A request for a leaf begins at
the root; the digits of its rank, in base of the fan-out, say which child to take, and the children not taken are
kept as a segment of its path. Segments reversed are the proof. Requests that share the first digits
of their ranks travel as one, so no record near the root is asked for by every leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.llm.common import staged

FAN_OUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(value: Column) -> Column:
    """SHA-256 of a string in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(value.cast("binary"), 256))


def hexes(digests: Column) -> Column:
    """An array of digests as one string of lower-case hexadecimal digits."""
    return F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), "")


def leaf_text(fields: list[Column]) -> Column:
    """What a leaf is the digest of: each field as its number of bytes, a colon and the value; null is a dash."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.concat(*map(field, fields))


def ranked(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """Adds ``rank``, 0 for the first of ``order`` in each ``group`` (null is a group, and comes first).

    Rows are dealt by ranges of group, order and place in the scan, so a group of any size, and of equal rows too,
    lies over many tasks. A rank is the place in the task and the number of rows before that task.
    """
    keys = ([group] if group else []) + order
    placed = rows.withColumn("_row", F.monotonically_increasing_id())
    dealt = staged(
        placed.repartitionByRange(*keys, "_row").sortWithinPartitions(*keys, "_row").drop("_row").select(
            "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at")
        ),
        "ranked",
    )
    name = F.col(group) if group else F.lit(0)
    parts = dealt.groupBy(name.alias("_g"), F.col("_part").alias("_p")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))  # a row for each task that holds the group
    return dealt.join(starts, (F.col("_part") == F.col("_p")) & name.eqNullSafe(F.col("_g"))).select(
        *rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias("rank")
    )


@dataclass(frozen=True)
class Manifest:
    """The tree of a data set.

    ``leaves``: ``(key, leaf, other, g, rank)``; ``groups``: ``(g, name, n, height, node)``. ``levels[i]`` holds the records
    ``(g, i, node, children)`` of the nodes ``i + 1`` above the leaves, ``top[i]`` those above the roots of the groups.
    """

    leaves: DataFrame
    groups: DataFrame
    levels: tuple[DataFrame, ...]
    top: tuple[DataFrame, ...]
    root: bytes | None
    fan_out: int = FAN_OUT


def _height(n: Column, fan_out: int) -> Column:
    """How often runs of ``fan_out`` have to be joined until one of ``n`` nodes is left."""
    power, height = 1, F.lit(0)
    while power < 1 << 62:
        height = height + (n > power).cast("int")
        power *= fan_out
    return height


def _above(nodes: DataFrame, fan_out: int) -> DataFrame:
    """The records over nodes ``(g, i, node)``: runs of ``fan_out`` by place ``i``."""
    runs = nodes.groupBy("g", F.expr(f"i DIV {fan_out}").alias("i")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("i"), F.col("node")))).alias("run")
    )
    children = runs.select("g", "i", F.col("run.node").alias("children"))
    return children.select("g", "i", digest(hexes(F.col("children"))).alias("node"), "children")


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "lang",
          other: Column | None = None, fan_out: int = FAN_OUT) -> Manifest:
    """The manifest of ``docs``, its rows grouped by ``group`` and ordered by ``key``.

    Null is a group and a key, and the first of each. Rows of equal keys are ordered by their digests, so
    equal rows may change places and nothing else. ``other`` is the text of a leaf to be checked in place of
    the row's own (null: its own). An empty table has no root.
    """
    own = digest(leaf_text([F.col(f"`{f}`") for f in fields]))
    leaves = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{group}`").alias("name"), own.alias("leaf"),
        (F.lit(None).cast("binary") if other is None else digest(other)).alias("other"),
    )
    leaves = staged(ranked(leaves, "name", ["key", "leaf"]), "leaves")
    sizes = leaves.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    names = ranked(sizes, None, ["name"]).select(F.col("rank").alias("g"), "name", "n", _height(F.col("n"), fan_out).alias("height"))
    names = staged(names, "groups")
    leaves = staged(
        leaves.join(names.select("g", F.col("name").alias("_name")), F.col("name").eqNullSafe(F.col("_name"))).drop("name", "_name"),
        "numbered_leaves",
    )
    nodes = leaves.select("g", F.col("rank").alias("i"), F.col("leaf").alias("node"))
    highest, n_groups = names.agg(F.max("height"), F.count(F.lit(1))).first()
    if not n_groups:
        return Manifest(leaves, names.withColumn("node", F.lit(None).cast("binary")), (), (), None, fan_out)
    levels, roots = [], nodes.join(names.filter("height = 0").select("g"), "g", "left_semi")
    for height in range(1, highest + 1):
        # groups that end below this level do not grow any further
        grows = names.filter(F.col("height") >= height).select("g")
        levels.append(staged(_above(nodes.join(grows, "g", "left_semi"), fan_out), f"level_{height}"))
        nodes = levels[-1].select("g", "i", "node")
        roots = roots.unionByName(nodes.join(names.filter(F.col("height") == height).select("g"), "g", "left_semi"))
    groups = staged(names.join(roots.select("g", "node"), "g"), "group_roots")
    top, nodes, width = [], groups.select(F.lit(0).alias("g"), F.col("g").alias("i"), "node"), n_groups
    while width > 1:
        top.append(staged(_above(nodes, fan_out), f"top_{len(top) + 1}"))
        nodes, width = top[-1].select("g", "i", "node"), -(-width // fan_out)
    return Manifest(leaves, groups, tuple(levels), tuple(top), bytes(nodes.first()["node"]), fan_out)


def _descend(requests: DataFrame, records: DataFrame, fan_out: int) -> DataFrame:
    """One step: requests ``(g, i, node, path)`` at nodes whose children are in ``records``, one for each child taken.

    ``path`` grows by a segment: the digit of the child taken and the children not taken.
    """
    store = staged(records.select("node", "children").dropDuplicates(["node"]), "store")
    met = requests.join(store, "node").select("g", "i", "path", "children", F.posexplode("children").alias("digit", "child"))
    left = F.filter("children", lambda c, at: at != F.col("digit"))
    return met.select(
        "g", (F.col("i") * fan_out + F.col("digit")).alias("i"), F.col("child").alias("node"),
        F.concat("path", F.array(F.struct(F.col("digit").alias("digit"), left.alias("others")))).alias("path"),
    )


_PATH = "array<struct<digit:int,others:array<binary>>>"


def proofs(manifest: Manifest) -> DataFrame:
    """``key``, ``leaf``, ``other``, the root ``subroot`` of the group and the ``path`` of every leaf, its segments from leaf to root.

    The segments of a request are found by digests alone: its records are looked up from the root on. The last
    step, from a node to its leaves, is taken in the row of that node, so proofs are never
    shuffled leaf by leaf.
    """
    m, spark = manifest, manifest.leaves.sparkSession
    none = F.array().cast(_PATH).alias("path")
    if m.root is None:
        return m.leaves.select("key", "leaf", "other", F.lit(None).cast("binary").alias("subroot"), none)
    at = spark.range(1).select(F.lit(0).alias("g"), F.lit(0).cast("bigint").alias("i"), F.lit(bytearray(m.root)).alias("node"), none)
    for records in reversed(m.top):
        at = _descend(at, records, m.fan_out)
    # a request that has come down the top tree is at the root of group i
    groups = m.groups.select("g", "height", F.col("node").alias("subroot"))
    entered = staged(
        at.select("i", "node", "path").join(groups, F.col("i") == F.col("g")).select(
            "g", F.lit(0).cast("bigint").alias("i"), "node", "path", "height", "subroot"
        ),
        "entered",
    )
    columns = ["g", "i", "node", "path"]
    at = entered.filter(F.col("height") == len(m.levels)).select(*columns)
    for height in range(len(m.levels), 1, -1):
        at = _descend(at, m.levels[height - 1], m.fan_out)
        at = at.unionByName(entered.filter(F.col("height") == height - 1).select(*columns))
    leaf = F.struct("key", "leaf", "other", F.pmod("rank", F.lit(m.fan_out)).cast("int").alias("digit"))
    runs = m.leaves.groupBy("g", F.expr(f"rank DIV {m.fan_out}").alias("i")).agg(F.collect_list(leaf).alias("run"))
    lone = entered.filter("height = 0").select(*columns)
    roots = m.groups.select("g", "subroot" if "subroot" in m.groups.columns else F.col("node").alias("subroot"))

    def opened(requests: DataFrame, last: Column) -> DataFrame:
        met = requests.join(runs, ["g", "i"]).join(roots, "g").select("subroot", "path", "children", F.explode("run").alias("x"))
        return met.select("x.key", "x.leaf", "x.other", "subroot", F.reverse(F.concat("path", last)).alias("path"))

    found = []
    if m.levels:
        store = staged(m.levels[0].select("node", "children").dropDuplicates(["node"]), "store")
        others = F.filter("children", lambda c, place: place != F.col("x.digit"))
        found.append(opened(at.join(store, "node"), F.array(F.struct(F.col("x.digit").alias("digit"), others.alias("others")))))
    found.append(opened(lone.withColumn("children", F.array().cast("array<binary>")), F.array().cast(_PATH)))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    def up(node: Column, segment: Column) -> Column:
        others, digit = segment["others"], segment["digit"]
        run = F.concat(F.slice(others, F.lit(1), digit), F.array(node), F.slice(others, digit + 1, F.size(others)))
        return digest(hexes(run))

    return F.aggregate(path, leaf, up)


def text_of(node: Column) -> Column:
    return F.lower(F.hex(node))


def verify(manifest: Manifest) -> DataFrame:
    """Per row ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.

    The proof is that of the row as it was; the folded root begins with its other leaf where it has one.
    """
    root = F.lit(None if manifest.root is None else manifest.root.hex()).cast("string")
    others = F.flatten(F.transform("path", lambda s: s["others"]))
    rows = proofs(manifest).select(
        F.col("key").alias("doc_id"), text_of(F.col("leaf")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"),
        root.alias("root"), F.sha2(hexes(others).cast("binary"), 256).alias("proof_sha256"),
        text_of(folded(F.coalesce("other", "leaf"), F.col("path"))).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(text: Column) -> Column:
    """The text with A to Z in lower case, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered_text(fields: tuple[str, ...] = FIELDS, key: str = "doc_id", text: str = "text") -> Column:
    """The leaf of a row whose text was lower-cased, where 3 divides the crc32 of the key; null elsewhere and for null keys."""
    changed = [lowered(F.col(f)) if f == text else F.col(f) for f in fields]
    return F.when(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0, leaf_text(changed))
