import duckdb
from pyspark.sql import functions as F

from terrabrook.llm import line_dedup as L

DATA = "/root/testdata/sf0.01"
LONG = "this line has over twenty characters"


def brute(rows):
    keys = {}
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(L.WHITE))
    for i, text in rows:
        for x in (text or "").split("\n"):
            if i is not None:
                keys.setdefault(lower(x), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if i is None or len(lower(x)) < 20 or len(keys[lower(x)]) < 3 or i == max(keys[lower(x)])]
        out.append((i is None, i or 0, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out)


def test_brute_force(spark):
    rows = [(1, f"{LONG}\nown 1"), (2, f"  {LONG.upper()}\t\n\n{LONG}"), (3, f"{LONG}"), (4, "short\nshort"), (5, None), (6, ""), (7, f"a\n{LONG}\r\nb\n"), (7, f"a\n{LONG}\r\nb\n"), (None, LONG), (None, None), (8, "ä" * 19 + "\n" + "ä" * 20), (9, "Ä" * 20), (10, "ä" * 20), (11, "ä" * 20), (12, "short"), (13, "x\n" * 3000 + LONG)]
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in rows], "doc_id long, text string, n_lines int, kept string")
    got = sorted((r.row.doc_id is None, r.row.doc_id or 0, r.n_lines, r.n_dropped, r.kept) for r in L.dedup_lines(df).collect())
    assert got == brute(rows)
    assert L.dedup_lines(df.filter(F.lit(False))).collect() == []
    twice = [(1, LONG), (1, LONG), (2, LONG)]  # two documents only
    again = L.dedup_lines(spark.createDataFrame(twice, "doc_id long, text string")).collect()
    assert {r.n_dropped for r in again} == {0} and len(again) == 3


def test_oracle(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{DATA}/documents.parquet'")
    df = L.op5_line_dedup(spark, DATA)
    want = con.sql(f"select {', '.join(df.columns)} from ({L.OP5_SQL})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)
