import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from hourgrid.llm.manifest import fold, leaf_digest, merkle_manifest, merkle_proofs, op13_manifest, proof_digest

SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(digests, arity):
    """(root, each leaf's [(before, after)])"""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for n, place in enumerate(at):
            run = place - place % arity
            paths[n].append(("".join(level[run:place]), "".join(level[place + 1 : run + arity])))
            at[n] = place // arity
        level = [sha("".join(level[i : i + arity])) for i in range(0, len(level), arity)]
    return level[0], paths


def proofs(leaves, arity=3):
    """{(group, order, leaf): [(subroot, root, path)]} of (group, order, leaf) rows, by plain lists."""
    groups = sorted({g for g, _, _ in leaves}, key=lambda g: (g is not None, (g or "").encode()))
    subs, found = [], []
    for g in groups:
        own = sorted([x for x in leaves if x[0] == g], key=lambda x: (x[1] is not None, x[1] or 0, x[2]))
        subroot, paths = tree([x[2] for x in own], arity)
        subs.append(subroot)
        found.append((own, paths))
    root, above = tree(subs, arity)
    rows = {}
    for n, (own, paths) in enumerate(found):
        for x, path in zip(own, paths, strict=True):
            rows.setdefault(x, []).append((subs[n], root, path + above[n]))
    return {x: sorted(v) for x, v in rows.items()}


def collected(df, group, order, leaf="leaf"):
    rows = {}
    for r in df.collect():
        rows.setdefault((r[group], r[order], r[leaf]), []).append((r["subroot"], r["root"], [tuple(s) for s in r["path"]]))
    return {x: sorted(v) for x, v in rows.items()}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    fields = lambda r, text: (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)
    want = proofs([(r["source"], r["doc_id"], leaf_of(*fields(r, r["text"]))) for r in docs])
    got = {r["doc_id"]: r for r in op13_manifest(spark, SMALL).collect()}
    assert len(got) == len(docs)
    tampered = 0
    for d in docs:
        r, leaf = got[d["doc_id"]], leaf_of(*fields(d, d["text"]))
        [(subroot, root, path)] = want[d["source"], d["doc_id"], leaf]
        text = d["text"]
        if zlib.crc32(str(d["doc_id"]).encode()) % 2 == 0 and text is not None:
            text = text.replace("\n", "")
        folded = leaf_of(*fields(d, text))
        for before, after in path:
            folded = sha(before + folded + after)
        assert (r["leaf"], r["subroot"], r["root"], r["folded_root"], r["verified"]) == (leaf, subroot, root, folded, text == d["text"])
        assert r["proof_sha256"] == sha("".join(b + a for b, a in path))
        tampered += text != d["text"]
    assert 0 < tampered < len(docs)


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_trees_of_any_size(spark, arity):
    """One leaf, exact powers, lone last nodes, a group with most rows, no group, names in byte order."""
    sizes = {None: 1, "": 2, "a": 3, "Z": 9, "é": 10, "zz": 28, "\U0001f600": 1, "ﬁ": 4, "hot": 300}
    leaves = [(g, i * 3 % n if n % 3 else i, sha(f"{g}{i}")) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(leaves, "source string, doc_id long, leaf string").repartition(7)
    got = merkle_proofs(df, arity=arity)
    assert collected(got, "source", "doc_id") == proofs(leaves, arity)
    checked = got.select((fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"), proof_digest(F.col("path")).alias("p")).collect()
    assert all(r["ok"] for r in checked) and len(checked) == len(leaves)


def test_one_lone_leaf_is_the_root(spark):
    df = spark.createDataFrame([("s", 1, sha("x"))], "source string, doc_id long, leaf string")
    [r] = merkle_proofs(df).select("*", proof_digest(F.col("path")).alias("p")).collect()
    assert r["subroot"] == r["root"] == sha("x") and r["path"] == [] and r["p"] == sha("")


def test_edges(spark, edge_docs, no_docs):
    """Null and empty texts differ, repeated rows are leaves of their own, clashing columns are not read."""
    rows = edge_docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    want = proofs([(r["source"], r["doc_id"], leaf_of(*r)) for r in rows])
    found = merkle_manifest(edge_docs, text=F.lit("forged"))
    assert collected(found, "source", "doc_id") == want and found.count() == len(rows)
    assert found.filter(fold(F.col("changed_leaf"), F.col("path")) == F.col("root")).count() == 0
    assert merkle_manifest(no_docs).collect() == []
    nulls = edge_docs.selectExpr("doc_id", "CAST(NULL AS STRING) AS source", "lang", "n_chars", "text")
    assert {r["source"] for r in merkle_manifest(nulls).collect()} == {None}


def test_many_equal_rows_and_groups(spark):
    """A third of all rows are one row; as many groups as rows."""
    same = spark.range(600).select(F.lit("s").alias("source"), F.lit(1).cast("long").alias("doc_id"), F.lit(sha("same")).alias("leaf"))
    own = spark.range(1200).select(F.concat(F.lit("g"), "id").alias("source"), "id", F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    df = same.union(own)
    leaves = [tuple(r) for r in df.collect()]
    assert collected(merkle_proofs(df), "source", "doc_id") == proofs(leaves)


def test_leaf_fields_cannot_run_together(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "-"), ("-", None), ("", "")], "x string, y string")
    got = [r[0] for r in df.select(leaf_digest(F.col("x"), F.col("y"))).collect()]
    assert got == [leaf_of(*r) for r in df.collect()] and len(set(got)) == 5


def test_plan_has_no_python(spark, edge_docs):
    assert "Python" not in merkle_manifest(edge_docs)._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        merkle_proofs(edge_docs, arity=1)
