import random

import numpy as np
import pytest

from hourgrid.llm.line_dedup import SHINGLE, SIMILARITY, dedup_lines, duplicate_lines, joining_pairs, shingle_codes
from hourgrid.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def grams(line):
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def brute(docs):
    """{(doc_id, text): removed line numbers} by comparing all lines."""
    places = sorted({(d is not None, d or 0, i, line, d, t) for d, t in docs for i, line in enumerate((t or "").split("\n")) if line and not line.isspace()},
                    key=lambda x: x[:3])
    lines = sorted({p[3] for p in places})
    sets = [grams(x) for x in lines]
    parent = list(range(len(lines)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(lines)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= SIMILARITY * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    at, seen, gone = {x: n for n, x in enumerate(lines)}, set(), {}
    for _, _, i, line, d, t in places:
        part = root(at[line])
        if part in seen:
            gone.setdefault((d, t), []).append(i)
        seen.add(part)
    return gone


def found(spark, docs_df):
    keyed = docs_df.selectExpr("doc_id", "text", "xxhash64(text) AS k").distinct().collect()
    texts = {(r["doc_id"], r["k"]): r["text"] for r in keyed}
    return {(r["doc_id"], texts[r["doc_id"], r["text_key"]]): r["removed"] for r in duplicate_lines(docs_df).collect()}


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    gone = brute(docs)
    got = {r["doc_id"]: r["removed"] for r in QUERIES["op2_line_dedup"](spark, SMALL).collect()}
    assert got == {d: gone.get((d, t), []) for d, t in docs}


def test_near_copies_that_are_not_like_their_representative(spark):
    """Chains and clusters of edited lines: every link between different texts counts."""
    rnd = random.Random(4)
    base = [f"{rnd.choice('abcdefgh')}{rnd.randrange(1000)}" for _ in range(60)]
    texts = []
    for n in range(60):
        words = list(base)
        for at in rnd.sample(range(60), rnd.randrange(0, 4)):
            words[at] = f"changed{n}"
        texts.append(" ".join(words))
    chain = list(base)
    for n in range(60):
        chain[n] = f"step{n}"
        texts.append(" ".join(chain))
    docs = [(n, f"own line {n} of this document {n * 7919}\n{t}") for n, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(spark, df) == brute(docs)


def test_edges(spark, edge_docs, no_docs):
    docs = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    assert found(spark, edge_docs) == brute(docs)
    kept = dedup_lines(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == len(docs)
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert texts[1] is None and texts[2] == "" and texts[3] == " \n\t "
    assert texts[5] == "One short line." and texts[6] == "" and texts[7] == "The same line twice."
    assert duplicate_lines(no_docs).collect() == [] and dedup_lines(no_docs).collect() == []


@pytest.mark.parametrize("few", [0, 64])
def test_joining_pairs_connects_what_all_pairs_connect(monkeypatch, few):
    from hourgrid.llm import line_dedup as L

    monkeypatch.setattr(L, "FEW_PAIRS", few)
    monkeypatch.setattr(L, "COLUMNS", 16)
    lines = ["a" * 30 + x for x in ("", "b", "bc")] + ["q" * 9, "other text of some length", "other text of some lengths", "short", "short"]
    pairs = joining_pairs(shingle_codes(lines), list(range(8)), np.arange(8), np.arange(8), 0.8)
    joined = {frozenset(p) for p in pairs}
    assert {4, 5} in joined and {6, 7} in joined and not any(3 in p for p in joined)
    want = {frozenset((i, j)) for i in range(8) for j in range(i) if len(grams(lines[i]) & grams(lines[j])) >= 0.8 * len(grams(lines[i]) | grams(lines[j]))}
    assert joined <= want and [len(x) for x in shingle_codes(lines)] == [len(grams(x)) for x in lines]
