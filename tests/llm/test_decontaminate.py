import random

from hourgrid.llm.decontaminate import decontaminate, mark_contamination
from hourgrid.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.01"
RND = random.Random(9)
WORDS = ["".join(RND.choice("abcdefghijklmnop") for _ in range(RND.randrange(2, 8))) for _ in range(3000)]


def text(n):
    return " ".join(RND.choice(WORDS) for _ in range(n))


def marks(df):
    return {r["doc_id"]: r["contaminated_by"] for r in df.collect()}


def test_query_finds_every_contained_item(spark):
    docs = dict(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))
    items = dict(map(tuple, spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()))
    got = marks(QUERIES["op8_decontamination"](spark, SMALL))
    assert set(got) == set(docs)
    inside = {i: sorted(n for n, t in items.items() if t in docs[i]) for i in docs}
    assert all(set(inside[i]) <= set(got[i]) for i in docs)
    # nothing else, but for documents that hold most of an item's words in order
    extra = [i for i in docs if set(got[i]) - set(inside[i])]
    assert len(extra) <= 0.01 * len(docs)


def test_substitutions_short_items_and_clean_texts(spark):
    items = [(i, text(40)) for i in range(20)] + [(50, text(8)), (51, text(3)), (52, None), (None, text(30)), (53, "")]
    held = dict(items)

    def edited(n, step):
        words = held[n].split()
        words[::step] = ["changed"] * len(words[::step])
        return " ".join(words).upper()

    docs = [(n, f"{text(100)} {edited(n, 8)}, {text(50)}") for n in range(10)] + [(n, f"{text(100)} {edited(n, 2)} {text(50)}") for n in range(10, 15)]
    docs += [(20, f"{text(30)} {held[50]}! {text(9)}"), (21, held[51]), (22, text(20000)), (23, None), (24, ""), (25, " ".join(held[3].split()[:14])),
             (26, text(20000) + "\n" + held[4] + "\n" + text(20000))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for part in (bench, bench.union(bench)):
        got = marks(mark_contamination(df, part))
        assert all(got[n] == [n] for n in range(10))       # one word in eight changed
        assert all(got[n] == [] for n in range(10, 15))    # every other word changed
        assert got[20] == [50] and got[21] == [51] and got[22] == got[23] == got[24] == got[25] == [] and got[26] == [4]


def test_every_allowed_substitution_is_found(spark):
    """All choices of substituted words that the check accepts, at each length."""
    from itertools import combinations

    docs, items, want = [], [], {}
    for n in (*range(1, 19), 24):
        item = [f"{w}{n}" for w in RND.sample(WORDS, n)]
        items.append((n, " ".join(item)))
        size = min(n, 16)
        most = max(k for k in range(size) if size - k >= 0.8 * size)
        for at in range(n - size + 1):
            for k in range(most + 2 if size > 1 else 1):
                for gone in combinations(range(size), k):
                    words = ["q"] * at + item[at : at + size] + ["q"] * (n - size - at)
                    want[len(docs)] = [n] if k <= most else []
                    docs.append((len(docs), " ".join(["lead", *("zz" if i - at in gone else w for i, w in enumerate(words)), "tail"])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(16)
    found = mark_contamination(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r["doc_id"]: r["contaminated_by"] for r in found} == want
    assert all(r["overlap"] == 0 if not r["contaminated_by"] else 0.8 <= r["overlap"] <= 1 for r in found)


def brute(docs, items):
    """By comparing every window of every item with every window of every text."""
    import re

    words = lambda t: re.findall("[a-z0-9]+|[\u4e00-\u9fff]|[\x80-\u4dff\ua000-\U0010ffff]+", (t or "").lower())
    found = {}
    for i, t in docs:
        own, marked = words(t), []
        for n, item in items:
            held = words(item)
            size = min(16, len(held))
            if size and any(sum(x == y for x, y in zip(own[p : p + size], held[a : a + size])) >= 0.8 * size
                            for a in range(len(held) - size + 1) for p in range(len(own) - size + 1)):
                marked.append(n)
        found[i] = sorted(marked)
    return found


def test_equals_brute_force(spark):
    """Texts of few words, so that windows agree by chance at all shares; repeated
    passages, equal items, texts cut at every length."""
    rnd = random.Random(12)
    few = "abc"
    items = [(n, " ".join(rnd.choice(few) for _ in range(rnd.choice([1, 3, 5, 6, 9, 12, 14, 15, 16, 20])))) for n in range(2, 30)]
    items += [(40, items[5][1]), (41, "你好世界"), (42, "学而时习之不亦说乎有朋自远方来不亦乐乎")]
    docs = [(n, " ".join(rnd.choice(few) for _ in range(rnd.randrange(0, 30)))) for n in range(120)]
    docs += [(500, "说你好世界吗"), (501, "你好 世界"), (502, "我们学而时习之不亦说乎,有朋自远方去不亦乐乎!"), (503, "好你世界"), (504, "学而时习之")]
    docs += [(600 + n, " ".join(items[3][1].split()[:n])) for n in range(12)]
    got = marks(mark_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(docs, items) and got[500] == got[501] == [41] and got[502] == [42] and got[503] == got[504] == []


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    """A benchmark far larger than its filter: all windows pass, the join decides."""
    from hourgrid.llm import decontaminate as D

    items = [(i, text(25)) for i in range(60)]
    docs = spark.createDataFrame([(i, f"{text(20)} {t}") for i, t in items[:30]] + [(100 + i, text(45)) for i in range(30)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {**{i: [i] for i in range(30)}, **{100 + i: [] for i in range(30)}}
    assert marks(mark_contamination(docs, bench)) == want
    monkeypatch.setattr(D, "BITS_A_HASH", 1)
    assert D.hash_filter(D.benchmark_seeds(bench).select("hash")).mean() > 0.3
    assert marks(mark_contamination(docs, bench)) == want


def test_the_filter_holds_every_hash(spark):
    from hourgrid.llm import decontaminate as D

    seeds = D.benchmark_seeds(spark.createDataFrame([(i, text(30)) for i in range(20)], "item_id long, text string"))
    allows = D.hash_filter(seeds.select("hash"))
    assert len(allows) & (len(allows) - 1) == 0 and allows.mean() < 0.06
    for r in seeds.select("hash").collect():
        assert all(allows[((r["hash"] % 2**64) >> shift) % len(allows)] for shift in D.probes(len(allows).bit_length() - 1))


def test_hashes_are_joined_in_spark(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    found = mark_contamination(df, spark.createDataFrame([(1, "a b c")], "item_id long, text string"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "hash#" in plan.split("Join Inner")[1].split("\n")[0]


def test_edges(spark, edge_docs, no_docs):
    items = [(i, text(25)) for i in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{text(20)} {t}") for i, t in items], "doc_id long, text string")
    assert decontaminate(docs, bench).count() == 0 and decontaminate(docs, bench.where("false")).count() == 30
    clean = decontaminate(edge_docs, bench)
    assert clean.columns == edge_docs.columns and clean.count() == edge_docs.count()
    assert decontaminate(no_docs, bench).collect() == [] and mark_contamination(no_docs, bench).collect() == []
    wide = edge_docs.selectExpr("*", "1 AS overlap", "2 AS k1", "3 AS m1", "5 AS hash")
    short = spark.createDataFrame([(1, "one SHORT line"), (2, "no id"), (3, "word5"), (4, "?!")], "item_id long, text string")
    rows = mark_contamination(wide, short).collect()
    assert sorted((r["doc_id"] or 0, tuple(r["contaminated_by"])) for r in rows) == [
        (0, (2,)), (0, (2,)), (1, ()), (2, ()), (3, ()), (4, (3,)), (5, (1,)), (6, (1,)), (7, ()), (7, ()), (9, ())]
    assert all(r["k1"] == 2 and r["m1"] == 3 and r["hash"] == 5 for r in rows)
