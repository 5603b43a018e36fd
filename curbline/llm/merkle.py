"""A Merkle manifest of a dataset: one tree per group, a tree over their roots, and a proof per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.session import materialise

LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id() counts a partition's rows in these bits
NO_PATH = "array<struct<left:binary,right:binary>>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_hash(*values: Column) -> Column:
    """SHA-256, as bytes, of the values one after another: ``-`` for a null, else UTF-8 byte count, ``:``, value."""
    written = [F.coalesce(F.concat(F.octet_length(v), F.lit(":"), v), F.lit("-")) for v in (x.cast("string") for x in values)]
    return F.unhex(F.sha2(F.encode(F.concat(*written), "UTF-8"), 256))


def _in_order(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """A written table with ``place``, each row's rank from 0 within its group. Equal rows get ranks of their own.

    Rows are dealt by range of (group, order), so a group that holds most rows is spread over many tasks; a row's
    place is that within its task plus the rows of its group in earlier tasks. Only counts per task are added up.
    """
    by = [group, *order, "_nth"]
    dealt = rows.withColumn("_nth", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    numbered = materialise(dealt.drop("_nth").withColumn("_at", F.monotonically_increasing_id()), f"{name}-dealt")
    numbered = (numbered.withColumn("_task", F.shiftright("_at", 33))
                .withColumn("_line", F.col("_at").bitwiseAND(F.lit(LOW_BITS))).drop("_at"))
    counts = numbered.groupBy(group, "_task").agg(F.min("_line").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(counts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))), f"{name}-offsets")
    return (numbered.join(offsets, [group, "_task"])
            .withColumn("place", F.col("_line") - F.col("_first") + F.col("_before"))
            .drop("_task", "_line", "_first", "_before", "_rows"))


def _sibling_places(fan: int) -> Column:
    """Where a node's siblings stand: XOR 1 in a binary tree, else every other slot of its run."""
    if fan == 2:
        return F.array(F.col("place").bitwiseXOR(F.lit(1).cast("long")))
    run = F.col("place") - F.col("place") % fan
    return F.array(*[run + (F.col("place") + shift) % fan for shift in range(1, fan)])


def _with_siblings(nodes: DataFrame, fan: int) -> DataFrame:
    """Nodes (tree, place, size, digest) with the digests of their siblings before and after them, joined."""
    asked = (nodes.select("tree", "place", "size", F.explode(_sibling_places(fan)).alias("sibling"))
             .where("sibling < size").drop("size"))
    found = asked.join(nodes.select("tree", F.col("place").alias("sibling"), "digest"), ["tree", "sibling"])
    listed = found.groupBy("tree", "place").agg(F.array_sort(F.collect_list(F.struct("sibling", "digest"))).alias("others"))
    joined = nodes.join(listed, ["tree", "place"], "left")

    def side(keep) -> Column:
        text = F.array_join(F.transform(F.filter("others", keep), lambda x: F.hex(x["digest"])), "")
        return F.unhex(F.coalesce(text, F.lit("")))

    return joined.select("tree", "place", "size", "digest", side(lambda x: x["sibling"] < F.col("place")).alias("left"),
                         side(lambda x: x["sibling"] > F.col("place")).alias("right"))


def build_trees(leaves: DataFrame, fan: int = 8) -> tuple[DataFrame, DataFrame]:
    """The paths (tree, place, digest, path) of all leaves and the roots (tree, root) of all trees.

    ``leaves`` is a written table (tree, place, size, digest): places count from 0, ``size`` is the tree's leaf
    count. Every level joins its nodes by equality with the places of their siblings; the nodes in slot zero then
    hold their whole run and emit the parent. A tree of one node is its own root and has an empty path.
    """
    if fan < 2:
        raise ValueError("a run has two nodes or more")
    most = leaves.agg(F.max("size")).head()[0] or 0
    nodes, levels, roots = leaves, [], [leaves.where("size = 1")]
    while most > 1:
        level = materialise(_with_siblings(nodes.where("size > 1"), fan), f"merkle-level-{len(levels)}")
        levels.append(level)
        run = F.unhex(F.sha2(F.encode(F.concat(_hex(F.col("digest")), _hex(F.col("right"))), "UTF-8"), 256))
        nodes = materialise(
            level.where(F.col("place") % fan == 0).select(
                "tree", F.floor(F.col("place") / fan).alias("place"), F.ceil(F.col("size") / fan).alias("size"), run.alias("digest")),
            f"merkle-parents-{len(levels)}")
        roots.append(nodes.where("size = 1"))
        most = -(-most // fan)
    none = F.array().cast(NO_PATH)
    above = None
    for level in reversed(levels):
        step = F.array(F.struct("left", "right"))
        if above is None:
            above = level.select("tree", "place", "digest", step.alias("path"))
            continue
        parent = above.select("tree", F.col("place").alias("parent"), F.col("path").alias("rest"))
        above = (level.withColumn("parent", F.floor(F.col("place") / fan)).join(parent, ["tree", "parent"], "left")
                 .select("tree", "place", "digest", F.concat(step, F.coalesce("rest", none)).alias("path")))
    lone = leaves.where("size = 1").select("tree", "place", "digest", none.alias("path"))
    root = roots[0].select("tree", F.col("digest").alias("root"))
    for more in roots[1:]:
        root = root.unionByName(more.select("tree", F.col("digest").alias("root")))
    return (lone if above is None else above.unionByName(lone)), root


def folded(digest: Column, path: Column) -> Column:
    """The root, as bytes, that a leaf's digest and its path lead to."""
    up = F.aggregate(path, _hex(digest), lambda found, step: F.sha2(
        F.encode(F.concat(_hex(step["left"]), found, _hex(step["right"])), "UTF-8"), 256))
    return F.unhex(up)


def proof_hash(path: Column) -> Column:
    """SHA-256, as hex text, of all sibling digests of a path from the leaf up, left to right."""
    siblings = F.array_join(F.transform(path, lambda step: F.concat(_hex(step["left"]), _hex(step["right"]))), "")
    return F.sha2(F.encode(siblings, "UTF-8"), 256)


def manifest(rows: DataFrame, fields: list[str], group: str, order: str, fan: int = 8,
             also: dict[str, Column] | None = None) -> DataFrame:
    """(order, group, leaf, subroot, root, path, also...) for every row: digests as bytes, the path as an array of
    (left, right) sibling digests from the leaf to the root of all.

    A leaf is :func:`leaf_hash` of ``fields``. The leaves of a group stand by ``order``, then by digest; the
    subroots by the group's UTF-8 bytes, null first. ``also`` names further columns to compute from the row
    while it is read, such as another version's :func:`leaf_hash`.

    Cases: a null in a field is hashed as ``-``; a null group is a group; a null order value stands first; rows
    that repeat are a leaf each; further columns are ignored and may have any name; an empty table gives an empty
    table. Texts are read once and only digests are shuffled.
    """
    taken = {f"also_{i}": c for i, c in enumerate((also or {}).values())}
    # A null group comes first, as the empty name.
    tree = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    leaves = materialise(rows.select(
        tree.alias("tree"), F.col(order).alias("ranked"), leaf_hash(*[F.col(f) for f in fields]).alias("digest"),
        *[c.alias(n) for n, c in taken.items()]), "merkle-leaves")
    sizes = materialise(leaves.groupBy("tree").agg(F.count("*").alias("size")), "merkle-sizes")
    placed = materialise(_in_order(leaves, "tree", ["ranked", "digest"], "merkle").join(sizes, "tree"), "merkle-placed")
    paths, roots = build_trees(placed.select("tree", "place", "size", "digest"), fan)

    subroots = materialise(roots, "merkle-subroots")
    trees = sizes.count()
    one = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("named"), F.col("root").alias("digest"))
    top = materialise(_in_order(one, "tree", ["named"], "merkle-top").withColumn("size", F.lit(trees).cast("long")), "merkle-top")
    top_paths, top_root = build_trees(top.select("tree", "place", "size", "digest"), fan)
    whole = top_root.head()
    up = materialise(
        top.select("place", F.col("named").alias("tree"), F.col("digest").alias("subroot"))
        .join(top_paths.select("place", F.col("path").alias("rest")), "place").drop("place"), "merkle-tops")
    found = (placed.select("tree", "place", "ranked", *taken).join(paths, ["tree", "place"]).join(up, "tree"))
    group_type = rows.schema[group].dataType
    return found.select(
        F.col("ranked").alias(order), F.when(F.col("tree") != "", F.substring("tree", 2, 2**31 - 1)).cast(group_type).alias(group),
        F.col("digest").alias("leaf"), "subroot", F.lit(bytes(whole["root"]) if whole else None).cast("binary").alias("root"),
        F.concat("path", "rest").alias("path"), *[F.col(n).alias(a) for n, a in zip(taken, also or {})])


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def query(spark, sf_dir):
    """Every third document or so, by its id's CRC, is tampered with: its text's A-Z in lower case."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = leaf_hash(*[lower if f == "text" else F.col(f) for f in FIELDS])
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = manifest(docs, FIELDS, "lang", "doc_id", also={"forged": F.when(struck, tampered)})
    reached = found.withColumn("folded", folded(F.coalesce("forged", "leaf"), F.col("path")))
    return reached.select(
        "doc_id", *[_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], proof_hash(F.col("path")).alias("proof_sha256"),
        _hex(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def _written(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR))::VARCHAR || ':' || CAST({column} AS VARCHAR), '-')"


def _tree_sql(name: str, leaves: str) -> str:
    """Common table expressions: all nodes of the trees over ``leaves`` and each node's siblings."""
    return f"""
{name}_nodes AS (
  SELECT tree, 0 AS level, place, size, digest FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, place // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM {name}_nodes WHERE size > 1 GROUP BY tree, level, place // 8, size),
{name}_siblings AS (
  SELECT n.tree, n.level, n.place,
         coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place < n.place), '') AS before,
         coalesce(string_agg(o.digest, '' ORDER BY o.place) FILTER (o.place > n.place), '') AS after
  FROM {name}_nodes n LEFT JOIN {name}_nodes o
    ON o.tree = n.tree AND o.level = n.level AND o.place // 8 = n.place // 8 AND o.place <> n.place
  WHERE n.size > 1 GROUP BY ALL)"""


def _walk_sql(name: str, start: str) -> str:
    """Common table expressions: from the rows of ``start`` up to the root of their tree."""
    return f"""
{name}_steps AS (
  SELECT id, tree, 0 AS level, place, size, proof, reached FROM {start}
  UNION ALL
  SELECT s.id, s.tree, s.level + 1, s.place // 8, (s.size + 7) // 8, s.proof || o.before || o.after,
         sha256(o.before || s.reached || o.after)
  FROM {name}_steps s JOIN {name}_siblings o ON o.tree = s.tree AND o.level = s.level AND o.place = s.place
  WHERE s.size > 1),
{name}_ends AS (SELECT id, tree, proof, reached FROM {name}_steps WHERE size = 1)"""


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC = ("xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT), "
        "lambda a, b: list_reduce(range(8), lambda r, k: xor(r >> 1, (r & 1) * 3988292384), xor(a, b)), 4294967295), 4294967295)")
SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('+' || lang, '') AS tree, sha256({" || ".join(_written(f) for f in FIELDS)}) AS digest,
         CASE WHEN {_CRC} % 3 = 0
              THEN sha256({" || ".join(_written(_LOWER if f == "text" else f) for f in FIELDS)}) END AS forged
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS size FROM hashed),
{_tree_sql("low", "leaves")},
tops AS (
  SELECT '' AS tree, tree AS named, digest, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size
  FROM low_nodes WHERE size = 1),
{_tree_sql("high", "tops")},
starts AS (SELECT id, tree, place, size, '' AS proof, coalesce(forged, digest) AS reached FROM leaves),
{_walk_sql("low", "starts")},
middles AS (SELECT e.id, t.tree, t.place, t.size, e.proof, e.reached FROM low_ends e JOIN tops t ON t.named = e.tree),
{_walk_sql("high", "middles")},
whole AS (SELECT digest AS root FROM high_nodes WHERE size = 1)
SELECT l.doc_id, l.digest AS leaf, t.digest AS subroot, w.root, sha256(e.proof) AS proof_sha256, e.reached AS folded_root,
       e.reached = w.root AS verified
FROM leaves l JOIN tops t ON t.named = l.tree JOIN high_ends e ON e.id = l.id, whole w
"""
