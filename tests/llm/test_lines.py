"""Line dedup against SQL and by hand."""

import hashlib
from collections import defaultdict

import duckdb
import pytest
from odd import ascii_lower, no_documents, odd_documents, odd_rows

from sortwell.llm import line_dedup as L
from sortwell.llm.queries import ORACLES, QUERIES

SPACE = " \t\n\x0b\x0c\r"


def by_hand(rows, min_chars=40, min_docs=5):
    """(id, kept text, lines, dropped) of every row of (id, text)."""
    holders = defaultdict(set)
    key = lambda line: ascii_lower(line.strip(SPACE))
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    before_all = float("-inf")
    keeper = {k: max(ids, key=lambda i: before_all if i is None else i) for k, ids in holders.items()
              if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def found(docs, **options):
    rows = L.without_shared_lines(docs, **options).collect()
    return sorted(((r["row"].doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in rows), key=str)


SHARED = "  This LINE is long enough to count as Été ÄÖ shared\t"


def planted():
    rows = [(i, f"own {i}\n{SHARED}\n\nshort\nshort\n{SHARED.lower() if i != 3 else SHARED}") for i in range(4)]
    rows += [(9, SHARED.strip().upper().replace("É", "é").replace("Ä", "ä")), (9, "rest\n" + SHARED), (9, "rest\n" + SHARED)]
    rows += [(None, SHARED + "\nx"), (None, SHARED + "\nx"), (None, None), (4, ""), (5, "\n"), (6, "\r" + SHARED + "\r\n" + SHARED)]
    rows += [(20 + i, "this line is found in four documents only, so it stays") for i in range(4)]
    return rows


def test_planted_lines(spark):
    docs = spark.createDataFrame(planted(), "doc_id bigint, text string")
    want = by_hand(planted())
    assert sum(r[3] for r in want) > 5
    assert found(docs) == want
    assert found(docs, min_docs=1, min_chars=1) == by_hand(planted(), 1, 1)


def test_hot_line_and_hot_rows(spark):
    """A line of all documents and a text that a third of all rows repeat take the ways for hot groups."""
    rows = [(i, f"{SHARED}\nown {i}") for i in range(1200)] + [(1, f"{SHARED}\nown 1")] * 600
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert found(docs) == by_hand(rows)


@pytest.mark.parametrize("min_docs", [2, 5])
def test_odd_documents(spark, min_docs):
    docs = odd_documents(spark)
    assert found(docs, min_docs=min_docs, min_chars=5) == by_hand([r[:2] for r in odd_rows()], 5, min_docs)
    assert L.without_shared_lines(docs).select("row.*").columns == docs.columns


def test_empty_table(spark):
    assert found(no_documents(spark)) == []


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({ORACLES['op11_line_dedup']})").fetchall()
    got = [tuple(r) for r in QUERIES["op11_line_dedup"](spark, sf).collect()]
    assert sorted(got) == sorted(want) and sum(r[2] for r in got)
    assert hashlib.sha256(b"").hexdigest() not in {r[3] for r in got if r[2] == 0 and r[1] > 1}
