import pytest

SF_SMALL = "/root/testdata/sf0.001"  # the same in both conftest modules, which share a name
#: Names the operators use inside, as extra columns of the input.
CLASHES = ("fp", "band", "line_id", "text_key", "row", "base", "near", "block", "part", "score", "slot", "host", "term", "items", "__id", "posting", "tree", "place", "size", "path",
           "digest", "leaf", "packer", "piece", "cluster", "item", "word")
LONG = " ".join(f"word{i % 997} tail{i}" for i in range(30000))


@pytest.fixture()
def edge_docs(spark):
    """Null and empty texts, white space, one very long text, ties, repeated rows,
    a null id and extra columns with clashing names."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "One short line."), (6, "One short line."),
            (7, "The same line twice.\nThe same line twice."), (7, "The same line twice.\nThe same line twice."), (None, "No id here at all."),
            (None, "No id here at all."), (9, "Café naïve \U0001f600 你好 42")]
    wide = [(i, t, "en", "s", 0, *["x"] * len(CLASHES)) for i, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame(wide, schema)


@pytest.fixture()
def no_docs(edge_docs):
    return edge_docs.where("false")
