import math
import re
from collections import Counter

import pytest

from hourgrid.llm import lm_score
from hourgrid.llm.lm_score import score_documents
from hourgrid.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute(docs):
    words = [re.findall("[a-z0-9\u0080-\U0010ffff]+", (t or "").lower()) for _, t in docs]
    one, two = Counter(), Counter()
    for w in words:
        one.update(w)
        two.update(zip(w, w[1:]))
    n = sum(one.values())
    out = []
    for (i, _), w in zip(docs, words):
        own, pairs = Counter(w), Counter(zip(w, w[1:]))
        single = lambda x: math.log((one[x] - own[x]) or 0.5) - math.log(max(1, n - len(w)))  # noqa: E731,B023
        total, backoffs = 0.0, 0
        for k, x in enumerate(w):
            seen = two[w[k - 1], x] - pairs[w[k - 1], x] if k else 0
            if seen:
                total += math.log(seen) - math.log(one[w[k - 1]] - own[w[k - 1]])
            else:
                total += single(x) + (math.log(0.4) if k else 0)
                backoffs += k > 0
        out.append((i, len(w), backoffs, round(total, 5)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_backoff"], round(r["log_score"], 5)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block,bucket", [(1_000_000, 2_000_000), (2000, 3000)])
def test_query_equals_brute_force(spark, monkeypatch, block, bucket):
    """Also with many blocks and hash partitions."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    monkeypatch.setattr(lm_score, "BUCKET_KEYS", bucket)
    assert rows(QUERIES["op4_lm_score"](spark, SMALL)) == brute(docs)


def test_edges(spark, edge_docs, no_docs):
    docs = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    assert rows(score_documents(edge_docs)) == brute(docs)
    assert score_documents(no_docs).collect() == []


def brute_order(docs, order, alpha=0.4):
    words = [re.findall("[a-z0-9\u0080-\U0010ffff]+", (t or "").lower()) for _, t in docs]
    grams = lambda w: Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    every, own = Counter(), [grams(w) for w in words]
    for c in own:
        every.update(c)
    n = sum(map(len, words))
    out = []
    for (i, _), w, mine in zip(docs, words, own):
        total, backoffs = 0.0, 0
        for k in range(len(w)):
            longest = min(order, k + 1)
            for m in range(longest, 0, -1):
                g = tuple(w[k - m + 1 : k + 1])
                seen = every[g] - mine[g]
                if m == 1:
                    total += math.log(seen or 0.5) - math.log(max(1, n - len(w)))
                elif seen:
                    total += math.log(seen) - math.log(every[g[:-1]] - mine[g[:-1]])
                if seen or m == 1:
                    total += (longest - m) * math.log(alpha)
                    backoffs += longest - m
                    break
        out.append((i, len(w), backoffs, round(total, 5)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_any_order_equals_brute_force(spark, monkeypatch, order):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()][:60]
    docs += [(9000 + i, t) for i, t in docs[:10]] + [(9100, "one"), (9101, "one two"), (9102, "one two three four"), (9103, ""), (None, None)]
    monkeypatch.setattr(lm_score, "BUCKET_KEYS", 5000)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(score_documents(df, order=order)) == brute_order(docs, order)
    if order == 2:
        assert brute_order(docs, 2) == brute(docs)
