import duckdb
from pyspark.sql import functions as F

from terrabrook.llm import chat as C

DATA = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, msg_id long, parent_id long, role string, text string, score double, leaf int"


def brute_paths(rows):
    by = {}
    for c, m, p, *_ in rows:
        by.setdefault(c, {})[m] = p
    out = set()
    for c, nodes in by.items():
        up = {m: p if p is not None and p < m and p in nodes else None for m, p in nodes.items()}
        for leaf in set(nodes) - {p for p in up.values() if p is not None}:
            path, at = [], leaf
            while at is not None:
                path.append(at)
                at = up[at]
            out.add((c, tuple(reversed(path))))
    return out


def test_trees(spark):
    rows = [(1, 1, None, "user", "q", 1.0), (1, 2, 1, "assistant", "a", 5.0), (1, 3, 1, "assistant", "b", 0.0), (1, 4, 3, "user", "more", 9.0), (1, 5, 2, "user", None, None), (1, 6, 99, None, "orphan", 0.0), (1, 8, 8, "x", "self", 0.0), (1, 9, 12, "x", "later", 0.0), (2, 1, None, "user", "<|end|> \\ <\\| <", 0.0)]
    rows += [(3, i, i - 1 if i > 1 else None, "assistant" if i % 2 else "user", f"t{i}\n<", 0.0) for i in range(1, 71)]
    df = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA)
    paths = {}
    for r in C.reply_paths(df).collect():
        paths.setdefault((r.conv_id, r.leaf), []).append((-r.step, r.node))
    assert {(c, tuple(n for _, n in sorted(p))) for (c, _), p in paths.items()} == brute_paths(rows)
    chats = C.format_chats(df).select("*", C.read_turns(F.col("formatted")).alias("turns")).collect()
    texts = {(c, m): (role or "", text or "") for c, m, _, role, text, _ in rows}
    for r in chats:
        path = next(p for c, p in brute_paths(rows) if c == r.conv_id and p[-1] == r.leaf)
        assert [tuple(t) for t in r.turns] == [texts[r.conv_id, m] for m in path] and r.n_turns == len(path)
        unescape = lambda s: __import__("re").sub(r"(?s)\\(.)", r"\1", s)
        assert [unescape(r.formatted[s.start : s.end]) for s in r.loss] == [t for role, t in (texts[r.conv_id, m] for m in path) if role == "assistant"]
    best = {r.leaf: r.branch for r in chats if r.conv_id == 1}
    assert best[4] == 1 and best[5] == 2  # means 10/3 and 2
    assert C.format_chats(df, top=1).filter("conv_id = 1").count() == 1
    assert C.format_chats(df.filter(F.lit(False))).collect() == []


def test_repeated_turns_and_nulls(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, None, None), (1, None, "assistant", "z")]
    got = C.format_chats(C.as_tree(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).select(C.read_turns(F.col("formatted")).alias("t")).collect()
    assert len(got) == 1 and sorted(tuple(x) for x in got[0].t) == [("", ""), ("assistant", "z"), ("user", "a"), ("user", "a")]


def test_null_conversation(spark, tmp_path):
    rows = [(None, 2, "assistant", "c"), (None, 1, "user", "b"), (None, 0, "system", "a"), (0, 0, "user", "z"), (4, 0, "user", "q"), (4, 1, "assistant", "r")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    df = C.op6_chat_formatting(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(f"select {', '.join(df.columns)} from ({C.OP6_SQL})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)
    assert [r[1] for r in want if r[0] is None] == [3]
    tree = [(None, 1, None, "user", "q", 0.0), (None, 2, 1, "assistant", "a", 1.0), (None, 3, 1, "assistant", "b", 2.0)]
    got = C.reply_paths(spark.createDataFrame([(*r, 7) for r in tree], SCHEMA)).collect()
    assert sorted((r.leaf, r.node) for r in got) == [(2, 1), (2, 2), (3, 1), (3, 3)] and {r.conv_id for r in got} == {None}


def test_oracle(spark):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{DATA}/conversations.parquet'")
    df = C.op6_chat_formatting(spark, DATA)
    want = con.sql(f"select {', '.join(df.columns)} from ({C.OP6_SQL})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)
    assert -1 in {r[0] for r in want}
