"""Small tables with every awkward case; extra columns clash with names that the operators use inside."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id long, block long, item long, size int, rep long, `key` string, part int, score double, _row long, spans string")
EXTRA = (7, None, 1, 2, None, "k", 3, 0.5, None, "s")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("aeioulnrst") for _ in range(5)) for _ in range(vocabulary)]
    return " ".join(rng.choice(stems) for _ in range(n))


def awkward_rows():
    long_text = prose(1, 30_000, 5_000)
    shared = prose(2, 60)
    rows = [
        (3, "", "en"), (4, None, "en"), (5, "one two", "en"), (6, "One two", None), (7, "   \n\t ", "de"),
        (8, long_text, "en"), (8, long_text, "en"),
        (9, shared + " end one", "en"), (10, "start two " + shared, "de"), (11, shared, None),
        (12, shared, "en"), (None, shared + " tail", "fr"), (None, None, None),
        (13, "é" * 50 + " ß " + "漢字" * 20, "xx"), (14, "a " * 3_000, "en"), (15, "x" * 20_000, "en"),
        (-5, prose(3, 40), "es"), (2**40, prose(4, 40), "es"),
    ]
    return [(i, t, lang, None if k % 3 else "s", None if t is None else len(t), *EXTRA) for k, (i, t, lang) in enumerate(rows)]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def read(sf_dir, table="documents"):
    import duckdb

    return duckdb.sql(f"select * from '{sf_dir}/{table}.parquet'").df()
