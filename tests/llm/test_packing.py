import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from hourgrid.llm.packing import default_tokenizer, first_fit_decreasing, pack_documents, word_ids
from hourgrid.llm.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def ids_of(text):
    coder = Tokenizer.from_file(default_tokenizer())
    return np.array(coder.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check(rows, docs, sequence=2048):
    """Every id in exactly one piece, sequences gapless and not too long."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for i, text in docs:
        ids, at = ids_of(text), 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= sequence
        total += at
    return total / (sequence * len(by_sequence))


def test_query_round_trip_and_little_padding(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = QUERIES["op10_packing"](spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == {i for i, _ in docs}
    assert check(rows, docs) > 0.95


def test_edges(spark, edge_docs, no_docs):
    rows = pack_documents(edge_docs).collect()
    docs = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    check(rows, [d for d in docs if d[0] not in (7, None)])   # ids 7 and null are on two rows each
    assert sum(r["doc_id"] == 7 for r in rows) == 2 and sum(r["doc_id"] is None for r in rows) == 2
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    assert [r["ids"] for r in rows if r["doc_id"] == 1] == [[1]]
    assert pack_documents(no_docs).collect() == []


def test_word_by_word_equals_the_tokenizer():
    coder = word_ids(default_tokenizer())
    texts = ["It's we'll I'M don't!! 'sad 12 3,4 a_b", "ÉTÉ naïve Straße ×÷ ªº ²", "tab\tseparated\r\nline space wide \u0085x",
             "İstanbul Σσς é é ﬁ 你好 \U0001f600\U0001f468‍\U0001f469", "<|endoftext|> a<|startoftext|>b <|EndOfText|> <|x", "", " ", "\n\n", "a  b",
             "#hash$$$ %%% &&& !!? ### token = \"abc\" 1.2.3.4 x@y.z", "\x00\x1c\x1d zero\x1fwidth​", "A" * 300]
    for t in texts:
        assert coder.encode(t) + np.array([1], "<u4").tobytes() == ids_of(t).tobytes(), t


def test_first_fit_decreasing_takes_the_first_bin_that_fits():
    rnd = random.Random(1)
    lengths = sorted((rnd.randrange(1, 101) for _ in range(300)), reverse=True)
    free, want = [], []
    for n in lengths:
        at = next((i for i, f in enumerate(free) if f >= n), len(free))
        if at == len(free):
            free.append(100)
        want.append((at, 100 - free[at]))
        free[at] -= n
    bins, offsets = first_fit_decreasing(np.array(lengths), 100)
    assert list(zip(bins.tolist(), offsets.tolist())) == want
    assert first_fit_decreasing(np.zeros(0, np.int64), 100)[0].size == 0
