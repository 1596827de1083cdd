"""Chat snapshots: maximal conversations against the SQL and a brute-force version."""

import duckdb

from tidesync.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, n string, h1 string, block string"


def plain(rows):
    """(conv_id, turns, copies, rendered) of the conversations that are no proper prefix of another."""
    said = {}
    for c, t, role, text in {(c, t, "unknown" if r is None else r, x or "") for c, t, r, x, *_ in rows if c is not None}:
        said.setdefault(c, []).append((-(1 << 62) if t is None else t, role, text))
    whole = {c: tuple((r, x) for _, r, x in sorted(v)) for c, v in said.items()}
    out = []
    for turns in set(whole.values()):
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in whole.values()):
            continue
        same = [c for c, v in whole.items() if v == turns]
        out.append((min(same), len(turns), len(same), "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in turns)))
    return sorted(out)


def snapshots():
    rows = []
    for c in range(40):  # conversation c is logged again after every turn, under an id of its own
        for upto in range(1, 2 + c % 5):
            rows += [(c * 100 + upto, t, "user" if t % 2 == 0 else "assistant", f"{c % 30} says {t}", "a", "b", "c") for t in range(upto)]
    rows += [(9000, 0, "user", "hello", *"abc"), (9001, 0, "user", "hello", *"abc"), (9001, 0, "user", "hello", *"abc")]
    rows += [(9002, None, None, None, *"abc"), (9002, 1, "user", "x", *"abc"), (None, 0, "user", "lost", *"abc"), (9003, 5, "user", "hello", *"abc"), (9003, 9, "user", "long " * 20_000, *"abc")]
    rows += [(9004, 2, "b", "tie", *"abc"), (9004, 2, "a", "tie", *"abc")]
    return rows


def test_maximal_conversations(spark):
    rows = snapshots()
    got = sorted(tuple(r) for r in chat.render(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == plain(rows)


def test_blocks_change_nothing(spark, monkeypatch):
    rows = snapshots() + [(7000, t, "user", f"t{t}", *"abc") for t in range(300)] + [(7001, t, "user", f"t{t}", *"abc") for t in range(200)]
    monkeypatch.setattr(chat, "BLOCK", 16)
    got = sorted(tuple(r) for r in chat.render(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == plain(rows)


def test_sql_on_the_same_rows(spark, tmp_dir):
    path = f"{tmp_dir}/conversations.parquet"
    spark.createDataFrame(snapshots(), SCHEMA).coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    got = sorted(tuple(r) for r in chat.op6_chat(spark, tmp_dir).collect())
    assert got == sorted(con.execute(chat.ORACLE_SQL).fetchall())


def test_no_conversations(spark):
    assert chat.render(spark.createDataFrame([], SCHEMA)).count() == 0
