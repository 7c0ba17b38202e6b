"""Small tables with the awkward cases every operator must stand."""

from __future__ import annotations

import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, sources=None):
    rows = []
    for i, text in enumerate(texts):
        doc_id = i if ids is None else ids[i]
        source = None if sources is None else sources[i]
        rows.append((doc_id, text, "en", source, None if text is None else len(text)))
    return spark.createDataFrame(rows, SCHEMA)


def awkward(spark):
    """Null id, null text, empty, blank, very long, repeated rows, ties and columns with clashing names."""
    long_text = " ".join(f"word{i % 977}" for i in range(40_000))
    texts = [None, "", " \t\n", long_text, "One line\nTwo line", "One line\nTwo line", "One line\nTwo line", "x", "É ß ﬁ 💡"]
    ids = [0, 1, 2, 3, 4, 4, None, None, 8]
    from pyspark.sql import functions as F

    clashing = "part hash hits rule verdict slot shard score node fps draws size key n_lines kept_text n_dropped".split()
    df = documents(spark, texts, ids, ["a", None, "a", "b", "b", "b", None, "c", "c"])
    return df.withColumns({name: F.lit("kept") for name in clashing})


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
