"""Columns of any name survive the removal of lines."""

from rollcall.llm.line_dedup import dedup_lines

CLASHING = ("document", "_document", "_removed", "removed", "n_lines", "own", "row", "band", "root", "Line", "id", "place", "kept")


def test_clashing_names(spark):
    text = "one line that stands in both of the documents\nother words"
    data = [(i, text.replace("other", f"own {i}"), *[f"{c}{i}" for c in CLASHING]) for i in (1, 2)]
    columns = ["doc_id", "Text", *CLASHING]
    frame = spark.createDataFrame(data, ", ".join(f"`{c}` {'long' if c == 'doc_id' else 'string'}" for c in columns))
    rows = {r.doc_id: r.asDict() for r in dedup_lines(frame).collect()}
    assert rows[1]["Text"] == data[0][1] and rows[2]["Text"] == "own 2 words"
    assert (rows[2]["n_lines"], rows[2]["removed"]) == (2, [0])
    for c in set(CLASHING) - {"removed", "n_lines"}:
        assert [rows[i][c] for i in (1, 2)] == [f"{c}1", f"{c}2"]
