"""Merkle manifest of a table by sibling-shift self-joins.

Every row is a leaf.  The leaves of a group, in order, are the lowest nodes of its
tree, the groups' roots those of a last tree.  At each level a node computes the
places of its siblings (its own place, shifted within the run of ``arity`` nodes)
and finds them by an equijoin; the nodes in slot zero emit the parents.  From the
top down, each node then takes over its parent's proof and adds its own siblings,
so a proof costs one join a level and the joins shrink with the levels.
Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, read_table

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*fields: Column) -> Column:
    """sha256 of the fields, each ``-`` if null, else its UTF-8 byte count, a colon
    and the value; lowercase hex."""
    def coded(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(coded, fields)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings lead to."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["before"], digest, step["after"]), 256))


def proof_digest(path: Column) -> Column:
    """sha256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``place`` (from 0) and ``size`` within each ``tree``.

    Sorted blocks number their rows; a block's counts per tree, summed over the
    blocks before it, give the rest.  No window sees more than one row per block of
    a tree.  Rows that agree in all of ``order`` are told apart by a stored number,
    so they too are spread over blocks."""
    stored = materialise(rows.withColumn("row_no", F.monotonically_increasing_id()), "leaves")
    keys = ["tree", *order, "row_no"]
    blocks = stored.repartitionByRange(*keys).sortWithinPartitions(*keys)
    blocks = materialise(blocks.withColumns({"block": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).drop("row_no"), "blocks")
    counts = blocks.groupBy("tree", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("tree").alias("t"), F.col("block").alias("b"), (before - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("size"))
    found = blocks.join(starts, (F.col("tree") == F.col("t")) & (F.col("block") == F.col("b")))
    return found.withColumn("place", F.col("at") + F.col("shift")).drop("block", "at", "t", "b", "shift")


def _with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Adds ``before`` and ``after``, the digests of the siblings to the left and to
    the right, by one equijoin for each shift within the run."""
    slot = F.pmod("place", F.lit(arity))
    found = nodes
    for shift in range(1, arity):
        sibling = F.col("place") - slot + F.pmod(slot + shift, F.lit(arity))
        other = nodes.select(F.col("tree").alias(f"t{shift}"), F.col("place").alias(f"p{shift}"), F.col("digest").alias(f"d{shift}"))
        found = found.join(other, (F.col("tree") == F.col(f"t{shift}")) & (sibling == F.col(f"p{shift}")), "left")
    run = F.array(*[F.struct(F.pmod(slot + s, F.lit(arity)).alias("slot"), F.col(f"d{s}").alias("digest")) for s in range(1, arity)])
    run = F.array_sort(F.filter(run, lambda x: x["digest"].isNotNull()))

    def side(wanted: Column) -> Column:
        return F.array_join(F.transform(wanted, lambda x: x["digest"]), "")

    found = found.withColumns({"before": side(F.filter(run, lambda x: x["slot"] < slot)), "after": side(F.filter(run, lambda x: x["slot"] > slot))})
    return found.drop(*[f"{c}{s}" for c in "tpd" for s in range(1, arity)])


def _levels(leaves: DataFrame, arity: int) -> list[DataFrame]:
    """The stored levels of all trees, from the leaves (tree, place, size, digest,
    ...) up; a tree ends at the level where its size is one."""
    levels = [materialise(_with_siblings(leaves, arity), "level")]
    most = levels[0].agg(F.max("size")).first()[0] or 0
    while most > 1:
        low = levels[-1].filter((F.col("size") > 1) & (F.pmod("place", F.lit(arity)) == 0))
        parents = low.select("tree", F.expr(f"place div {arity}").alias("place"), F.expr(f"(size + {arity - 1}) div {arity}").alias("size"),
                             F.sha2(F.concat("digest", "after"), 256).alias("digest"))
        levels.append(materialise(_with_siblings(parents, arity), "level"))
        most = -(-most // arity)
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    ended = [level.filter("size = 1").select("tree", "digest") for level in levels]
    roots = ended[0]
    for more in ended[1:]:
        roots = roots.union(more)
    return roots


def _with_paths(levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """The lowest level with the columns of ``above`` (tree, path, ...) of its tree,
    and the whole ``path`` up to the last root."""
    carried = [c for c in above.columns if c not in ("tree", "path")]
    held = above.select(F.col("tree").alias("t"), F.col("path").alias("rest"), *carried)
    paths = None
    for n, level in reversed(list(enumerate(levels))):
        own = [F.col(c) for c in level.columns if c not in ("before", "after")]
        ended = level.filter("size = 1").join(held, F.col("tree") == F.col("t")).select(*own, F.col("rest").alias("path"), *carried)
        if paths is not None:
            parent = paths.select(F.col("tree").alias("t"), F.col("place").alias("p"), F.col("path").alias("rest"), *carried)
            step = F.array(F.struct("before", "after"))
            inner = level.filter("size > 1").join(parent, (F.col("tree") == F.col("t")) & (F.expr(f"place div {arity}") == F.col("p")))
            ended = inner.select(*own, F.concat(step, "rest").alias("path"), *carried).union(ended)
        paths = materialise(ended, "paths") if n else ended
    return paths


def merkle_proofs(leaves: DataFrame, group: str = "source", order: str = "doc_id", digest: str = "leaf", arity: int = ARITY) -> DataFrame:
    """``leaves`` with subroot, root and path array<struct<before, after>>.

    Each value of ``group`` (null is one, before all others) has a tree over its
    rows by ``order`` (nulls first, equal ones by digest); groups in UTF-8 byte
    order make the last tree.  While a tree has several nodes, every ``arity``
    consecutive ones (the last run may be shorter, even one) become the sha256 of
    their digests.  A group of any size is cut into blocks and levels, never held by
    one task.  Repeated rows are leaves of their own; an empty table gives no rows.
    Column names tree, place, size, before, after, path, subroot and root are
    reserved; other columns are carried along."""
    if arity < 2:
        raise ValueError("a tree needs runs of two nodes at least")
    # the empty key is the null group's, and sorts before every other one
    keyed = leaves.withColumns({"tree": F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")), "digest": F.col(digest)})
    levels = _levels(_numbered(keyed, [order, "digest"]), arity)
    subroots = _roots(levels).select(F.lit("").alias("tree"), F.col("tree").alias("group_key"), "digest")
    top = _levels(_numbered(subroots, ["group_key"]), arity)
    root = _roots(top).select(F.lit("").alias("tree"), F.array().cast("array<struct<before:string,after:string>>").alias("path"), F.col("digest").alias("root"))
    above = materialise(_with_paths(top, root, arity).select(F.col("group_key").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "subroots")
    return _with_paths(levels, above, arity).select(*leaves.columns, "subroot", "root", "path")


def merkle_manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "source", order: str = "doc_id", arity: int = ARITY,
                    **changed: Column) -> DataFrame:
    """(order, group, leaf, subroot, root, path) per row of ``docs``, the leaf over
    ``fields`` in that order; a path folds its leaf to the root (``fold``).

    With ``changed`` (field = Column) also ``changed_leaf``, the leaf with those
    fields replaced.  Null fields have a code of their own, so null and empty texts
    differ; texts of any length are hashed whole; extra columns are not read."""
    leaf = leaf_digest(*[F.col(f) for f in fields])
    other = {"changed_leaf": leaf_digest(*[changed.get(f, F.col(f)) for f in fields])} if changed else {}
    return merkle_proofs(docs.select(order, group, leaf.alias("leaf"), *[c.alias(n) for n, c in other.items()]), group, order, "leaf", arity)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    found = merkle_manifest(docs, text=F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text")))
    folded = fold(F.col("changed_leaf"), F.col("path"))
    shown = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


_CODED = " || ".join(f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in FIELDS)
_STEP = f"xor(c >> 1, (c & 1) * {0xEDB88320})"
_BYTE = "xor(c, b)"
for _ in range(8):
    _BYTE = f"list_transform([{_BYTE}], lambda c: {_STEP})[1]"

#: The query in DuckDB's SQL: levels of all trees, then one more tree over the
#: subroots, each row's siblings by level, and the fold of the tampered leaf.
OP13_SQL = f"""WITH RECURSIVE docs AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: {_BYTE}), 4294967295) % 2 = 0 AS tampered FROM documents),
leaves AS (
  SELECT doc_id, source, {_CODED} AS coded, {_CODED.replace("text::VARCHAR", "changed::VARCHAR")} AS changed_coded
  FROM (SELECT *, CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END AS changed FROM docs)),
leaf AS MATERIALIZED (
  SELECT doc_id, source, sha256(coded) AS leaf, sha256(changed_coded) AS changed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id, sha256(coded)) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaves),
low AS (
  SELECT source, 0 AS l, i, n, leaf AS d FROM leaf
  UNION ALL
  SELECT source, l + 1, i // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(d, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY source, l, n, i // {ARITY}),
subroot AS MATERIALIZED (
  SELECT source, l, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS l, i, n, d FROM subroot
  UNION ALL
  SELECT l + 1, i // {ARITY}, (n + {ARITY - 1}) // {ARITY}, sha256(string_agg(d, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY l, n, i // {ARITY}),
step AS MATERIALIZED (
  SELECT leaf.doc_id, low.l,
    coalesce(string_agg(low.d, '' ORDER BY low.i) FILTER (low.i < leaf.i // power({ARITY}, low.l)::BIGINT), '') AS before,
    coalesce(string_agg(low.d, '' ORDER BY low.i) FILTER (low.i > leaf.i // power({ARITY}, low.l)::BIGINT), '') AS after
  FROM leaf JOIN low ON leaf.source IS NOT DISTINCT FROM low.source AND low.n > 1 AND low.i // {ARITY} = leaf.i // power({ARITY}, low.l + 1)::BIGINT GROUP BY ALL
  UNION ALL
  SELECT leaf.doc_id, subroot.l + high.l,
    coalesce(string_agg(high.d, '' ORDER BY high.i) FILTER (high.i < subroot.i // power({ARITY}, high.l)::BIGINT), ''),
    coalesce(string_agg(high.d, '' ORDER BY high.i) FILTER (high.i > subroot.i // power({ARITY}, high.l)::BIGINT), '')
  FROM leaf JOIN subroot ON leaf.source IS NOT DISTINCT FROM subroot.source
  JOIN high ON high.n > 1 AND high.i // {ARITY} = subroot.i // power({ARITY}, high.l + 1)::BIGINT GROUP BY ALL),
folded AS (
  SELECT doc_id, 0 AS l, changed AS d FROM leaf
  UNION ALL
  SELECT doc_id, l + 1, sha256(before || d || after) FROM folded JOIN step USING (doc_id, l))
SELECT leaf.doc_id, leaf.leaf, subroot.d AS subroot, root.d AS root, coalesce(proof, sha256('')) AS proof_sha256, last.d AS folded_root, last.d = root.d AS verified
FROM leaf JOIN subroot ON leaf.source IS NOT DISTINCT FROM subroot.source CROSS JOIN (SELECT d FROM high WHERE n = 1) root
LEFT JOIN (SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY l)) AS proof FROM step GROUP BY doc_id) USING (doc_id)
JOIN (SELECT doc_id, max_by(d, l) AS d FROM folded GROUP BY doc_id) last USING (doc_id)"""
