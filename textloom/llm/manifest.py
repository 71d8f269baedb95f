"""Merkle manifest of a dataset, with a proof for each row.

Digests are lowercase hexadecimal, and a level of a tree is the string of its digests one after another. Each aligned
block of nodes keeps its levels as such strings: substrings of a fixed width are hashed to the parents, and what flanks
a node within its run are its siblings, again substrings. The top nodes of blocks are the nodes of a smaller tree, so
blocks of any number of rows need a few rounds, and no task holds more than a block of a tree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from textloom.cluster import fits_broadcast, write_and_read

#: Nodes of a run, which become one node; levels within a block; nodes of a block; digits of a digest.
FAN = 8
LEVELS = 4
BLOCK = FAN ** LEVELS
DIGITS = 64
RUN = FAN * DIGITS
#: The places of a partition's rows in monotonically_increasing_id().
ROW_BITS = 33


def leaf_of(fields: Sequence[Column]) -> Column:
    """sha256 of the fields one after another, each `-` if null, else its bytes in UTF-8, `:` and itself as text."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def _group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def _placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds idx, the place of a row in its `tree` by `order` from 0 on, and total, the rows of the tree. `nodes` is a
    written table, and `order` tells all rows apart: so ranges of rows are even, whatever tree or key most rows have."""
    keys = ["tree", *order]
    rows = write_and_read(
        nodes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftrightunsigned("_at", ROW_BITS)
    tree = Window.partitionBy("tree")
    # a row for each range and tree in it, that is ranges + trees at most
    sizes = rows.groupBy("tree", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    sizes = write_and_read(sizes.withColumn("total", F.sum("_n").over(tree)).withColumn(
        "_before", F.sum("_n").over(tree.orderBy("_part")) - F.col("_n")), "sizes")
    return rows.withColumn("_part", part).join(_small(sizes), ["tree", "_part"]).withColumn(
        "idx", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_first", "_n", "_before", "_at")


def _parents(level: Column) -> Column:
    """The level above: each run of digests hashed. Bytes, as a place in a text has to be searched for."""
    runs = F.sequence(F.lit(0), ((F.octet_length(level) - 1) / RUN).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256)), "").cast("binary")


def _blocks(nodes: DataFrame) -> DataFrame:
    """tree, block, total, height, items sorted by idx, level0 to level3, top. `nodes`: tree, idx, total, digest, ..."""
    carried = [c for c in nodes.columns if c not in ("tree", "total", "idx")]
    blocks = nodes.groupBy("tree", F.floor(F.col("idx") / BLOCK).alias("block")).agg(
        F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("idx", *carried))).alias("items"))
    # only a tree's one block may end below its full height, when one node is left
    height = sum((F.when(F.col("total") > FAN ** k, 1).otherwise(0) for k in range(LEVELS)), F.lit(0))
    blocks = blocks.withColumn("height", height.cast("int"))
    level = F.array_join(F.transform("items", lambda x: x["digest"]), "").cast("binary")
    for k in range(LEVELS):
        blocks = blocks.withColumn(f"level{k}", level)
        level = F.when(F.col("height") > k, _parents(F.col(f"level{k}"))).otherwise(F.col(f"level{k}"))
    return blocks.withColumn("top", level.cast("string"))


def _flanks(idx: Column) -> Column:
    """The siblings of a block's node at each level: what stands before and after it within its run."""
    def at(k: int) -> Column:
        node = F.floor(F.pmod(idx, F.lit(BLOCK)) / FAN ** k).cast("int")
        pos = node % FAN
        run, level = (node - pos) * DIGITS, F.col(f"level{k}")
        return F.struct(
            F.substring(level, run + 1, pos * DIGITS).cast("string").alias("left"),
            F.substring(level, run + (pos + 1) * DIGITS + 1, (FAN - 1 - pos) * DIGITS).cast("string").alias("right"))

    return F.slice(F.array(*[at(k) for k in range(LEVELS)]), F.lit(1), F.col("height"))


def _paths(nodes: DataFrame) -> DataFrame:
    """tree, the carried columns, path and top of every node of `nodes` (tree, idx, total, digest, ...). The path has the
    siblings level by level; top is what remains of the tree."""
    carried = [c for c in nodes.columns if c not in ("tree", "total")]
    blocks = write_and_read(_blocks(nodes), "blocks")
    if (blocks.agg(F.max("total")).first()[0] or 0) > BLOCK:
        above = _paths(blocks.select(
            "tree", F.col("block").alias("idx"), F.ceil(F.col("total") / BLOCK).alias("total"), F.col("top").alias("digest")))
        above = write_and_read(above.select("tree", F.col("idx").alias("block"), F.col("path").alias("_above"), F.col("top").alias("_top")), "above")
        blocks = blocks.join(_small(above), ["tree", "block"]).withColumn("top", F.col("_top")).drop("_top")
    else:
        blocks = blocks.withColumn("_above", F.expr("cast(array() as array<struct<left: string, right: string>>)"))
    rows = F.transform("items", lambda x: F.struct(
        *[x[c].alias(c) for c in carried], F.concat(_flanks(x["idx"]), F.col("_above")).alias("path")))
    return blocks.select("tree", "top", F.explode(rows).alias("_row")).select("tree", "_row.*", "top")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf has by its path."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def siblings(path: Column) -> Column:
    """The digests of a path one after another."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def merkle_manifest(
    df: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id",
    group_col: str = "lang", carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """id, leaf, path array<struct<left, right>>, subroot, root of every row, and the columns of `carry`, small ones.

    A row's leaf is `leaf_of` its `fields`. Each group has a tree over its leaves by ascending id: 8 consecutive nodes
    (the last run may be shorter, even one node) become one, until one remains, the subroot; a lone leaf is that itself.
    The subroots by group, null first and then by bytes, have a tree likewise. A path goes from the leaf to the root.

    Null ids come first, rows of the same id by their leaves; rows alike in all fields each have a leaf, and paths of
    their own. A null field differs from an empty one. Texts of any length are hashed whole. An empty table gives an
    empty one. Other columns of `df` are not looked at; the names of `carry` must not be those of the result.
    """
    leaves = write_and_read(df.select(
        _group_key(df[group_col]).alias("tree"), df[id_col].alias("id"), leaf_of([df[f] for f in fields]).alias("digest"),
        F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in (carry or {}).items()]).alias("carried"),
        F.monotonically_increasing_id().alias("_row")), "leaves")
    found = _paths(_placed(leaves, ["id", "digest", "_row"]).drop("_row"))
    found = write_and_read(found.withColumnsRenamed({"top": "subroot", "digest": "leaf"}).drop("idx"), "paths")
    groups = write_and_read(found.groupBy(F.col("tree").alias("group")).agg(F.first("subroot").alias("digest")).withColumn(
        "tree", F.lit("")), "groups")
    roots = write_and_read(_paths(_placed(groups, ["group"])).select(
        F.col("group").alias("tree"), F.col("path").alias("_above"), F.col("top").alias("root")), "roots")
    return found.join(_small(roots), "tree").select(
        F.col("id").alias(id_col), "leaf", F.concat("path", "_above").alias("path"), "subroot", "root",
        *[F.col("carried")[n].alias(n) for n in (carry or {})])


def tampered_leaf(df: DataFrame, fields: Sequence[str], id_col: str, text_col: str) -> Column:
    """The leaf after A-Z of the text became a-z where 3 divides the crc32 of the id as text; else the leaf. A null id
    has no crc32 and isn't changed, nor is a null text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = [F.translate(df[text_col], upper, upper.lower()) if f == text_col else df[f] for f in fields]
    return F.when(F.crc32(df[id_col].cast("string").cast("binary")) % 3 == 0, leaf_of(changed))


def manifest_audit(
    df: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), id_col: str = "doc_id",
    group_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root, verified: the manifest of `df`, against which a copy with
    some tampered texts is checked by the proofs. Rows as in `merkle_manifest`."""
    found = merkle_manifest(df, fields, id_col, group_col, {"tampered": tampered_leaf(df, fields, id_col, text_col)})
    found = found.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select(
        id_col, "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def _levels(name: str, start: str) -> str:
    """DuckDB: every level of the trees whose first level is `start`, and the runs of 8 in which nodes are hashed."""
    return f"""
{name} AS (
  SELECT tree, 0 AS level, idx, digest, total FROM {start}
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(total) + 7) // 8
  FROM {name} WHERE total > 1 GROUP BY tree, level, idx // 8),
{name}_runs AS (
  SELECT tree, level, idx // 8 AS run, list(digest ORDER BY idx) AS nodes FROM {name} WHERE total > 1 GROUP BY ALL)"""


def _walk(name: str, start: str, runs: str) -> str:
    """DuckDB: rows of `start` (tree, idx, node, proof, ...) on their way up, level by level."""
    left, right = "array_to_string(nodes[1:idx % 8], '')", "array_to_string(nodes[idx % 8 + 2:], '')"
    return f"""
{name} AS (
  SELECT n, tree, 0 AS level, idx, node, proof FROM {start}
  UNION ALL
  SELECT w.n, w.tree, w.level + 1, idx // 8, sha256({left} || node || {right}), proof || {left} || {right}
  FROM {name} w JOIN {runs} r ON r.tree = w.tree AND r.level = w.level AND r.run = w.idx // 8),
{name}_end AS (SELECT n, max_by(node, level) AS node, max_by(proof, level) AS proof FROM {name} GROUP BY n)"""


def sql() -> str:
    """DuckDB SQL for `manifest_audit` over `documents`. As it has no crc32, that is summed bit by bit."""
    head = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))
    leaf = lambda text: f"sha256({head} || coalesce(strlen({text}) || ':' || {text}, '-'))"
    crc = """xor(4294967295, list_reduce(
      flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
      lambda acc, x: xor(xor(acc, x) >> 1, 3988292384 * (xor(acc, x) & 1)), 4294967295::BIGINT))"""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH RECURSIVE docs AS (
  SELECT *, {leaf('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} END AS tampered,
    coalesce('=' || lang, '') AS tree, row_number() OVER () AS n FROM documents),
leaves AS (
  SELECT *, leaf AS digest, count(*) OVER (PARTITION BY tree) AS total,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, n) - 1 AS idx FROM docs),
{_levels('low', 'leaves')},
subroots AS (SELECT tree, digest FROM low WHERE total = 1),
places AS (SELECT tree AS grp, '' AS tree, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS total FROM subroots),
{_levels('high', 'places')},
first AS (SELECT n, tree, idx, coalesce(tampered, leaf) AS node, '' AS proof FROM leaves),
{_walk('lower_way', 'first', 'low_runs')},
second AS (SELECT n, p.tree, p.idx, e.node, e.proof FROM lower_way_end e JOIN docs USING (n) JOIN places p ON p.grp = docs.tree),
{_walk('upper_way', 'second', 'high_runs')},
root AS (SELECT digest AS root FROM high WHERE total = 1)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(e.proof) AS proof_sha256, e.node AS folded_root, e.node = root AS verified
FROM upper_way_end e JOIN docs USING (n) JOIN subroots s ON s.tree = docs.tree CROSS JOIN root
"""
