"""Small tables for the training-data operators, and plain versions of them."""

from __future__ import annotations

import re
import tempfile

import duckdb

SF = "/root/testdata/sf0.001"
LONG = "lang " * 30_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words string, kept int"


def write(spark, **tables) -> str:
    """A folder of tables; each is (rows, schema)."""
    folder = tempfile.mkdtemp(prefix="tripcast-llm-")
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def docs(*texts, first: int = 0, langs=None) -> tuple[list, str]:
    """Documents with extra columns named like results."""
    rows = [(first + i, t, langs[i] if langs else "en", "s", len(t or ""), "x", "y", 1) for i, t in enumerate(texts)]
    return rows, DOCS


def odd() -> tuple[list, str]:
    """Null and empty texts, a null id, a very long text, repeated rows."""
    rows, schema = docs(None, "", "...", "One two three four five six", LONG, "é😀 ñ")
    return rows + [rows[3], rows[3], (None, "no id at all", None, None, None, None, None, None)], schema


def oracle(sql: str, folder: str, *tables: str):
    con = duckdb.connect()
    for t in tables:
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'' if folder == SF else '/*.parquet'}')")
    return con.execute(sql).fetchall(), [d[0] for d in con.description]


def rows(df, *columns) -> list[tuple]:
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=str)


def matches_oracle(df, sql: str, folder: str, *tables: str) -> None:
    expected, columns = oracle(sql, folder, *tables)
    assert rows(df, *columns) == sorted(map(tuple, expected), key=str)


def plain_words(text: str | None) -> list[bytes]:
    return [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode()
                                .translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))) if w]


def plain_shingles(text: str | None, k: int) -> set:
    w = plain_words(text)
    return ({tuple(w)} if w and len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}) if w else set()
