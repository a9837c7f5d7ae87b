"""A Merkle manifest of a data set as a content-addressed graph.

Every row is a leaf; per group, runs of ``WIDTH`` consecutive digests become their hash until one is left,
and the groups' roots do the same. What is stored are records from a digest to its children, by height.
Requests for leaves start at the root and go down: the digits of a leaf's rank say which child is next,
the children that are not selected are kept as a path segment, and the segments in reverse are the proof.
Requests that share their first digits go down together, so a level has as many of them as it has nodes
in use, and no task meets all requests at the root.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortflow.llm.common import quoted
from cohortflow.llm.mixing import numbered
from cohortflow.sources.scratch import discard, settle

WIDTH = 8
#: Columns of a leaf, in order; the group is one of them.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 of each value as its size in bytes, a colon and itself, ``-`` for null."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(id_: Column) -> Column:
    """Whether a row is one of those that are changed: 3 divides the CRC-32 of its id."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 0, F.lit(False))


@dataclass
class Manifest:
    """``leaves``: doc_id, claim (the leaf to verify), leaf, tree, rank, n (leaves of the tree). ``heights``:
    of the trees of the groups, from 1 on, the records digest, children; ``top``: of the tree over
    their roots. ``subroots``: tree (its place among the groups), digest, n. ``root``: the digest, none
    for an empty table."""

    leaves: DataFrame
    heights: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame
    root: str | None


def manifest(
    docs: DataFrame, claim: Column | None = None, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS
) -> Manifest:
    """The manifest of ``docs``. ``claim`` is the digest that a row will be verified with, its leaf unless given.

    Groups are ordered by value, null first; leaves of a group by id, null first, rows that repeat an id
    by leaf. Equal rows have equal leaves and take a place each. Null and empty texts differ. Other
    columns are not read, whatever their names. An empty table has no root.

    Ranks come from ranges of (group, id, leaf) and sums over their sizes; equal rows are told apart by
    their place in the input, so that neither a large group nor many equal rows end up in one task.
    """
    column = {c: F.col(quoted(c)) for c in fields}
    leaf = leaf_digest(list(column.values()))
    rows = docs.select(
        column[id_col].alias("doc_id"),
        column[group_col].cast("string").alias("grp"),
        leaf.alias("leaf"),
        (leaf if claim is None else claim).alias("claim"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = settle(rows, "leaves")
    order = [F.col("grp").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("tie")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = settle(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    discard(rows)
    counts = ranged.groupBy("grp", "part").count()
    upto = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "grp", "part", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("before"), F.sum("count").over(Window.partitionBy("grp")).alias("n")
    )
    counts = settle(counts, "spans")
    groups = numbered(counts.select("grp").distinct(), F.col("grp").asc_nulls_first())
    groups = groups.select(F.col("grp").alias("grp_"), F.col("number").alias("tree"))
    spans = counts.join(groups, F.col("grp").eqNullSafe(F.col("grp_"))).select(F.col("part").alias("part_"), "grp_", "before", "n", "tree")
    place = F.row_number().over(Window.partitionBy("part", "grp").orderBy(*order[1:])) - 1
    leaves = ranged.withColumn("place", place).join(spans, (F.col("part") == F.col("part_")) & F.col("grp").eqNullSafe(F.col("grp_")))
    leaves = leaves.select("doc_id", "leaf", "claim", "tree", (F.col("before") + F.col("place")).alias("rank"), "n")
    leaves = settle(leaves, "ranks")
    discard(ranged)
    heights, subroots = _grown(leaves.select("tree", "rank", F.col("leaf").alias("digest"), "n"))
    subroots = settle(subroots, "subroots")
    n = subroots.count()
    top, root = _grown(subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("rank"), "digest", F.lit(n).alias("n")))
    found = root.first()
    return Manifest(leaves, heights, top, subroots, found and found["digest"])


def _grown(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The records of every height over ``nodes`` (tree, rank, digest, n), and tree, digest, n of the roots."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    records: list[DataFrame] = []
    roots = [nodes.where("n = 1")]
    below = 1  # leaves under a node
    while below < most:
        runs = nodes.where(F.col("n") > below).groupBy("tree", "n", F.floor(F.col("rank") / WIDTH).alias("rank"))
        runs = runs.agg(F.sort_array(F.collect_list(F.struct((F.col("rank") % WIDTH).alias("at"), "digest"))).alias("run"))
        runs = runs.select("tree", "rank", "n", F.col("run.digest").alias("children"))
        runs = settle(runs.withColumn("digest", F.sha2(F.array_join("children", ""), 256)), "runs")
        records.append(runs.select("digest", "children"))
        nodes = runs.select("tree", "rank", "digest", "n")
        below *= WIDTH
        roots.append(nodes.where(F.col("n") <= below).where(F.col("n") > below // WIDTH))
    return records, reduce(DataFrame.unionByName, roots).select("tree", "digest", "n")


def _children(at: DataFrame, records: DataFrame) -> DataFrame:
    """``at`` (digest) with the children of each digest; equal digests have one record."""
    once = records.groupBy("digest").agg(F.first("children").alias("children"))
    return at.join(once, "digest")


def _segment(children: Column, at: Column) -> Column:
    """What is not selected, with the place of what is."""
    others = F.concat(F.slice(children, F.lit(1), at), F.slice(children, at + 2, F.lit(WIDTH)))
    return F.struct(at.cast("int").alias("at"), others.alias("others"))


def _descended(at: DataFrame, records: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """Requests one level further down: tree, prefix (the digits so far), digest, path, subroot, n."""
    down = _children(at, records).select("*", F.posexplode("children").alias("place", "child"))
    path = F.concat("path", F.array(_segment(F.col("children"), F.col("place"))))
    down = down.select(
        "tree", (F.col("prefix") * WIDTH + F.col("place")).alias("prefix"), F.col("child").alias("digest"), path.alias("path"), "subroot", "n"
    )
    return settle(down if wanted is None else down.join(wanted, ["tree", "prefix"], "left_semi"), "descent")


def proofs(found: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """A row per leaf, or per leaf whose ``doc_id`` is in ``wanted``: doc_id, leaf, claim, subroot and ``path``,
    the segments (``at``, ``others``) from the leaf up to the root.

    Leaves that have no sibling on a level have an empty segment there; the only leaf of a group has none of its
    group. An empty table gives an empty one.
    """
    asked = found.leaves
    if wanted is not None:
        asked = settle(asked.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi"), "asked")

    def heads(below: int, trees: bool) -> DataFrame | None:
        """What is asked for on the level whose nodes have ``below`` leaves under them."""
        if wanted is None:
            return None
        rank, tree = ("rank", F.col("tree")) if trees else ("tree", F.lit(0).alias("tree"))
        return asked.select(tree, F.floor(F.col(rank) / below).alias("prefix")).distinct()

    segments = "array<struct<at:int,others:array<string>>>"
    start = found.subroots.sparkSession.range(1 if found.root else 0).select(
        F.lit(0).alias("tree"), F.lit(0).cast("long").alias("prefix"), F.lit(found.root).alias("digest"),
        F.expr(f"cast(array() as {segments})").alias("path"), F.lit(None).cast("string").alias("subroot"), F.lit(0).cast("long").alias("n"),
    )
    at = settle(start, "start")
    for height in reversed(range(len(found.top))):
        at = _descended(at, found.top[height], heads(WIDTH**height, False))
    sizes = found.subroots.select(F.col("tree").alias("prefix"), F.col("n").alias("size"))
    roots = at.join(sizes, "prefix").select(
        F.col("prefix").alias("tree"), F.lit(0).cast("long").alias("prefix"), "digest", "path", F.col("digest").alias("subroot"), F.col("size").alias("n")
    )
    roots = settle(roots, "roots")
    at = None
    for height in reversed(range(1, len(found.heights))):  # down to the runs of leaves
        here = roots.where(F.col("n") <= WIDTH ** (height + 1)).where(F.col("n") > WIDTH**height)
        at = _descended(here if at is None else here.unionByName(at), found.heights[height], heads(WIDTH**height, True))
    few = roots.where(F.col("n") <= WIDTH).where("n > 1")
    alone = roots.where("n = 1").select("tree", "path", "subroot")
    leaf = ["doc_id", "leaf", "claim"]
    whole = asked.where("n = 1").join(alone, "tree").select(*leaf, "subroot", F.reverse("path").alias("path"))
    if found.heights:
        runs = _children(few if at is None else few.unionByName(at), found.heights[0])
        runs = runs.select("tree", F.col("prefix").alias("run"), "children", "path", "subroot")
        asked = asked.where("n > 1").withColumn("run", F.floor(F.col("rank") / WIDTH))
        own = _segment(F.col("children"), (F.col("rank") % WIDTH).cast("int"))
        several = asked.join(runs, ["tree", "run"]).select(*leaf, "subroot", F.reverse(F.concat("path", F.array(own))).alias("path"))
        whole = several.unionByName(whole)
    return whole


def proof_digest(path: Column) -> Column:
    """The hash of all siblings from the leaf up, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda s: s["others"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""

    def up(digest: Column, s: Column) -> Column:
        others, at = s["others"], s["at"]
        left = F.array_join(F.slice(others, F.lit(1), at), "")
        return F.sha2(F.concat(left, digest, F.array_join(F.slice(others, at + 1, F.lit(WIDTH)), "")), 256)

    return F.aggregate(path, leaf, up)


def verify(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root (of the row as it is after
    tampering, with the siblings of the manifest), verified. What null, repeated and empty input gives is said
    at ``manifest``; texts of any length are hashed whole."""
    column = {c: F.col(quoted(c)) for c in FIELDS}
    bad = leaf_digest([lower_ascii(c) if name == "text" else c for name, c in column.items()])
    claim = F.when(tampered(column["doc_id"]), bad).otherwise(leaf_digest(list(column.values())))
    found = manifest(docs, claim)
    rows = proofs(found).withColumn("folded_root", folded(F.col("claim"), F.col("path")))
    root = F.lit(found.root).cast("string")
    return rows.select(
        "doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


def sql(levels: int = 9) -> str:
    """The same in DuckDB's SQL over ``documents``, up to 8 ** (levels - 1) rows a group and groups. Every node's
    run is looked up by its place."""
    digest = " || ".join(
        f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in FIELDS
    )
    lowered = digest.replace(
        "CAST(text AS VARCHAR)",
        "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
    )
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""
    text = f"""
WITH hashed AS (
  SELECT doc_id, lang, sha256({digest}) AS leaf,
         CASE WHEN coalesce({crc} % 3 = 0, FALSE) THEN sha256({lowered}) ELSE sha256({digest}) END AS claim
  FROM documents),
ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
  FROM hashed),
l0 AS (SELECT tree, n, place, leaf AS digest FROM ranked)"""
    for i in range(levels):
        text += f""",
r{i} AS (
  SELECT tree, n, place // 8 AS run, list(digest ORDER BY place) AS children FROM l{i} WHERE n > {8**i} GROUP BY tree, n, place // 8),
l{i + 1} AS (SELECT tree, n, run AS place, sha256(array_to_string(children, '')) AS digest FROM r{i})"""
    text += ",\nsubroots AS (" + " UNION ALL ".join(
        f"SELECT tree, digest FROM l{i} WHERE n <= {8**i}" + (f" AND n > {8 ** (i - 1)}" if i else "") for i in range(levels + 1)
    ) + "),\nt0 AS (SELECT tree AS place, digest, count(*) OVER () AS n FROM subroots)"
    for i in range(levels):
        text += f""",
u{i} AS (SELECT n, place // 8 AS run, list(digest ORDER BY place) AS children FROM t{i} WHERE n > {8**i} GROUP BY n, place // 8),
t{i + 1} AS (SELECT run AS place, sha256(array_to_string(children, '')) AS digest, n FROM u{i})"""
    text += ",\ntop AS (" + " UNION ALL ".join(
        f"SELECT digest FROM t{i} WHERE n <= {8**i}" + (f" AND n > {8 ** (i - 1)}" if i else "") for i in range(levels + 1)
    ) + ")"
    others = "coalesce(array_to_string(list_concat({c}[:({p}) % 8], {c}[({p}) % 8 + 2:]), ''), '')"
    fold = "CASE WHEN {c} IS NULL THEN {f} ELSE sha256(array_to_string({c}[:({p}) % 8], '') || {f} || array_to_string({c}[({p}) % 8 + 2:], '')) END"
    text += ",\nf0 AS (SELECT *, claim AS folded, '' AS proof FROM ranked)"
    for i in range(levels):
        place = f"f.place // {8**i}"
        text += f""",
f{i + 1} AS (
  SELECT f.* REPLACE ({fold.format(c="r.children", p=place, f="f.folded")} AS folded,
                      f.proof || {others.format(c="r.children", p=place)} AS proof)
  FROM f{i} f LEFT JOIN r{i} r ON r.tree = f.tree AND r.run = f.place // {8 ** (i + 1)})"""
    text += f",\ng0 AS (SELECT * FROM f{levels})"
    for i in range(levels):
        place = f"g.tree // {8**i}"
        text += f""",
g{i + 1} AS (
  SELECT g.* REPLACE ({fold.format(c="u.children", p=place, f="g.folded")} AS folded,
                      g.proof || {others.format(c="u.children", p=place)} AS proof)
  FROM g{i} g LEFT JOIN u{i} u ON u.run = g.tree // {8 ** (i + 1)})"""
    return text + f"""
SELECT doc_id, leaf, subroots.digest AS subroot, top.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
       folded = top.digest AS verified
FROM g{levels} g JOIN subroots USING (tree), top"""
