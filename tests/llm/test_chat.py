import duckdb
from pyspark.sql import functions as F

from keyflow.llm import chat
from keyflow.llm.queries import op6_chat

SCHEMA = "conv_id long, turn long, role string, text string"


def conv(number, *texts, first=0):
    return [(number, first + n, ("user", "assistant")[n % 2], text) for n, text in enumerate(texts)]


def kept(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"part": F.lit(1), "n_turns": F.lit(2), "key": F.lit("x")})
    return chat.render(frame, **options).collect()


def test_prefixes_collapse(spark):
    rows = conv(1, "a") + conv(2, "a", "b") + conv(3, "a", "b", "c") + conv(4, "a", "x") + conv(5, "a", "b", "c") + conv(6, "b")
    found = {r.conv_id: (r.n_turns, r.text) for r in kept(spark, rows)}
    assert sorted(found) == [3, 4, 6]
    assert found[4] == (2, "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n")


def test_parts_join_up(spark):
    rows = conv(1, *"abcdefg") + conv(2, *"abcd") + conv(3, *"abcdefg") + conv(4, *"abcdeX")
    whole = {r.conv_id: r.text for r in kept(spark, rows)}
    parts = sorted(kept(spark, rows, part_turns=2), key=lambda r: (r.conv_id, r.part))
    assert sorted(whole) == [1, 4] and len(parts) == 7
    for number, text in whole.items():
        assert "".join(r.text for r in parts if r.conv_id == number) == text


def test_odd_rows(spark):
    rows = conv(1, "a", "b") + conv(1, "a", "b")  # repeated rows
    rows += [(2, None, None, None), (None, 0, "user", "z"), (None, 1, "user", None)]
    rows += [(7, 0, "user", "t"), (7, 0, "system", "s")]  # two rows with one number
    rows += [(8, 0, None, "m"), (9, 0, "m", None)]
    found = {r.conv_id: (r.n_turns, r.text) for r in kept(spark, rows)}
    assert found[1][0] == 2 and found[2] == (1, "<|im_start|>unknown\n<|im_end|>\n")
    assert found[None][0] == 2 and found[7][1].startswith("<|im_start|>system")
    assert set(found) == {1, 2, None, 7, 8, 9}
    assert kept(spark, rows[:0]) == []


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    want = sorted(con.execute(chat.SQL).fetchall())
    assert sorted(tuple(r) for r in op6_chat(spark, folder).select("conv_id", "part", "n_turns", "text").collect()) == want


def test_query_equals_sql_on_long_conversations(spark):
    rows = conv(1, *map(str, range(11)), first=1020) + conv(2, *map(str, range(2500))) + conv(3, *map(str, range(2400)))
    rows += conv(4, "a", "b") + [(4, None, None, "x")] + conv(5, *map(str, range(2500)))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = sorted((r.conv_id, r.part, r.n_turns, r.text) for r in kept(spark, rows))
    assert found == sorted(con.execute(chat.SQL).fetchall()) and len(found) == 2 + 3 + 2


def test_one_conversation_copied_very_often(spark):
    turns = spark.createDataFrame(conv(0, "a", "b", "c"), SCHEMA).drop("conv_id")
    rows = spark.range(3000).withColumnRenamed("id", "conv_id").join(F.broadcast(turns)).unionByName(spark.createDataFrame(conv(-5, "a", "b") + conv(9000, "a", "x"), SCHEMA))
    assert [(r.conv_id, r.n_turns) for r in chat.render(rows).orderBy("conv_id").collect()] == [(0, 3), (9000, 2)]


def test_no_python(spark):
    frame = spark.createDataFrame(conv(1, "a"), SCHEMA)
    plan = chat.render(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
