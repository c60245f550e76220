"""Small frames for the operators' tests."""

import duckdb

FOLDER = "/root/testdata/sf0.001"

# Texts that splitting, folding and offsets get wrong most easily.
ODD_TEXTS = [
    "",
    " ",
    "\n\t \r\n",
    "a",
    "  two  spaces  and\ttab\n\nlines ",
    "it's we'll I'd 'tis o'clock 's",
    "café ñandú İstanbul ſecret Kelvin K ß",
    "x y  z　w ​ v",
    "\x00\x1c\x1d \x85 a\x1fb",
    "日本語 テキスト 한국어 \U0001f600 é ² ½ Ⅷ",
    "▁mark ▁ ▁▁ x▁y",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "1234567890 12,345.67 a1b2c3",
    "word " * 3000,
    "no_space_at_all" * 400,
]


def documents(spark, texts, ids=None, **columns):
    """documents with columns whose names operators might use for themselves."""
    ids = range(len(texts)) if ids is None else ids
    rows = [
        (i, t, None, f"src{n % 3}", len(t or ""), "p", 1, "r", "k") for n, (i, t) in enumerate(zip(ids, texts, strict=True))
    ]
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long,"
        " print string, number int, root string, spans string"
    )
    return spark.createDataFrame(rows, schema)


def empty_documents(spark):
    return documents(spark, ["x"]).filter("false")


def table(name, folder=FOLDER):
    """The rows of a test table as tuples, by name of the column."""
    return duckdb.sql(f"SELECT * FROM '{folder}/{name}.parquet'").fetchall()


def texts(folder=FOLDER):
    """All texts of the test documents by id."""
    return dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{folder}/documents.parquet'").fetchall())


def roots(nodes, edges):
    """The smallest node that each node reaches."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}
