"""Rows that the tests of the text operators share."""
SF = "/root/testdata/sf0.001"

#: Rows that every operator must take: nulls, empty, blank, ties, repeated rows, a null id, a very long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (5, "one two"), (6, "ONE two"), (None, "one two three four"),
       (None, None), (7, "word " * 60_000), (8, "x" * 300_000), (9, "é漢字 🙂 ñ"), (10, "word " * 60_000)]


def collect(df, key="doc_id"):
    return sorted(df.collect(), key=lambda r: (r[key] is None, r[key] if r[key] is not None else 0, str(r)))
