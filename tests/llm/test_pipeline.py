import corpus_pipeline as P
from hourgrid.llm.registry import QUERIES
from test_packing import check
from test_simhash import brute_components
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and P.ORACLE_SQL is None
    assert [n for n, _ in P.STAGES] == ["quality classifier", "line dedup", "simhash near-dedup", "benchmark decontamination", "packing"]


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, stage in P.STAGES:
        tables.append(P.materialise(stage(spark, tables[-1], SF), name.replace(" ", "-")))
    start, good, lines, single, clean, packed = tables
    assert all(t.columns == start.columns for t in tables[:-1])
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op9_quality"](spark, SF).collect()}
    assert rows(good) == [r for r in rows(start) if scores[r[0]]]
    before, after = ({r["doc_id"]: r for r in t.collect()} for t in (good, lines))
    assert set(before) == set(after)
    kept = [x for r in after.values() for x in r["text"].split("\n") if x.strip()]
    assert len(kept) == len(set(kept)) and all(r["n_chars"] == len(r["text"]) for r in after.values())
    assert {x for r in before.values() for x in r["text"].split("\n") if x.strip()} >= set(kept)
    firsts = {c for _, _, c in brute_components([(i, r["text"]) for i, r in after.items()])}
    assert rows(single) == rows(lines.where(lines.doc_id.isin(list(firsts))))
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ids = {r["doc_id"] for r in clean.collect()}
    for r in single.collect():
        assert r["doc_id"] not in ids or not any(t in r["text"] for t in items)
    check(packed.collect(), [(r["doc_id"], r["text"]) for r in clean.collect()])
    assert {tuple(sorted((r["doc_id"], r["start"], r["length"]) for r in packed.collect()))} == {
        tuple(sorted((r["doc_id"], r["start"], r["length"]) for r in P.run(spark, SF).collect()))}


def test_stages_on_edge_rows(spark, edge_docs, no_docs):
    for name, stage in P.STAGES:
        assert stage(spark, no_docs, SF).count() == 0, name
        out = stage(spark, edge_docs, SF)
        if name != "packing":
            assert out.columns == edge_docs.columns, name
    kept = P.near_dedup(spark, edge_docs, SF).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 4, 5, 7, 9]
    assert sum(r["doc_id"] is None for r in kept) == 2


def test_near_dedup_of_repeated_ids_is_one_choice(spark):
    """Rows that share a doc_id: other texts are judged in their own groups, near
    copies by one fixed order, repeats stay once; whatever the order of the rows."""
    words = [f"w{i}" for i in range(80)]
    base, other = " ".join(words), " ".join(reversed(words)) + " and more of another kind"
    table = [(1, base), (1, other), (1, base), (2, base + "."), (2, "a text of its own"), (3, other), (4, base), (4, base.upper())]
    rows = [(i, t, "en", f"s{n}", len(t)) for n, (i, t) in enumerate(table)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    results = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(order, schema).repartition(4)
        results.add(tuple(sorted(map(tuple, P.near_dedup(spark, df, SF).collect()))))
    assert len(results) == 1
    [kept] = results
    assert sorted((r[0], r[1]) for r in kept) == sorted([(1, base), (1, other), (2, "a text of its own")])
