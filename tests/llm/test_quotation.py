from pyspark.sql import functions as F

from adlens.llm.quotation import blocks, link_quotations, mails, op9_chat_formatting, parse

SCHEMA = "msg_id long, role string, text string"


def linked(spark, rows):
    out = link_quotations(spark.createDataFrame(rows, SCHEMA).repartition(2))
    return {r["msg_id"]: (r["conversation_id"], r["position"], r["parent_id"], r["depth"], r["text"])
            for r in out.collect()}


def test_levels():
    assert blocks("Hi\nOn Tuesday X wrote:\n> q\nanswer\n>> deep\n> > same\n\n\nend") == [
        (0, ["Hi"]), (1, ["q"]), (0, ["answer"]), (2, ["deep", "same"]), (0, ["end"])]
    own, found = parse("> > a b c\n> d e f\n> g\n\nmine")
    assert own == "mine"
    assert [(p["level"], p["whole"], p["words"]) for p in found] == [
        (2, True, 3), (1, True, 4), (1, False, 3), (0, True, 1)]
    assert parse(None) == parse("") == ("", [])


def test_threads(spark):
    got = linked(spark, [
        (1, "user", "How do I sort a list?\nIt is long."),
        (2, "assistant", "> how do I  sort a LIST?\n> It is long.\n\nUse sorted."),
        (3, "user", "> > How do I sort a list?\n> > It is long.\n> Use sorted.\n\nThanks a lot!"),
        (4, "user", "> It was never said.\n\nHello there"),
        (5, "assistant", "X wrote:\n> How do I sort a list?\n\nOr sort in place."),  # one line only
        (6, "user", "> Hello there\nHi"),
        (7, "user", "> > Hello there\n> lost\n\nback"),  # the parent is missing, its quote is not
    ])
    assert got == {
        1: (1, 0, None, 0, "How do I sort a list?\nIt is long."),
        2: (1, 1, 1, 1, "Use sorted."),
        5: (1, 2, 1, 1, "Or sort in place."),
        3: (1, 3, 2, 2, "Thanks a lot!"),
        4: (4, 0, None, 0, "Hello there"),
        6: (4, 1, 4, 1, "Hi"),
        7: (4, 2, 4, 1, "back"),
    }


def test_conversations_come_back(spark):
    """The mails are linked back as the table had them, but for texts that several conversations share."""
    d = "/root/testdata/sf0.01"
    out = op9_chat_formatting(spark, d)
    turns = spark.read.parquet(f"{d}/conversations.parquet")
    both = out.join(turns.select((F.col("conv_id") * 1_000_000 + F.col("turn")).alias("msg_id"), "conv_id", "turn",
                                 F.col("text").alias("said")), "msg_id")
    assert out.count() == both.count() == turns.count()
    assert both.where("conversation_id <> conv_id * 1000000 or position <> turn or depth <> turn").count() == 0
    assert both.where("regexp_replace(text, '\\\\s+', ' ') <> regexp_replace(said, '\\\\s+', ' ')").count() == 0


def test_edge_rows(spark):
    rows = [(1, "a", None), (None, None, "> x y z\nhello"), (2, "b", ""), (3, "c", "x y z"), (3, "c", "x y z"),
            (4, None, "> x y z"), (5, "d", ">"), (6, "e", "word " * 50_000), (7, "f", "> " + "word " * 50_000 + "\nyes")]
    out = link_quotations(spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("_row", "root", "depth", "own", "passages")})).collect()
    assert len(out) == len(rows)
    at = {r["msg_id"]: r for r in out}
    assert at[4]["parent_id"] == 3 and at[4]["text"] == "" and at[7]["parent_id"] == 6
    assert at[None]["conversation_id"] is None and at[None]["parent_id"] is None


def test_hot_passage(spark):
    """A third of all messages quote one text, which is itself said many times."""
    rows = [(k, "u", "the same words") for k in range(100)] + [(100 + k, "a", "> the same words\nyes %d" % k) for k in range(200)]
    got = linked(spark, rows)
    assert sum(c == 99 for c, *_ in got.values()) == 201  # the nearest of the equal originals
    assert [got[k][1] for k in range(100, 300)] == list(range(1, 201))


def test_shared_texts_link_by_what_they_answer(spark):
    got = linked(spark, [
        (1, "a", "Do you want tea?"),
        (2, "a", "Do you want coffee?"),
        (3, "u", "> Do you want tea?\nyes, please"),
        (4, "u", "> Do you want coffee?\nyes, please"),
        (5, "a", "> > Do you want tea?\n> yes, please\nHere is tea"),
        (6, "a", "> > Do you want coffee?\n> yes, please\nHere is coffee"),
        (7, "u", "yes, please"),
        (8, "a", "> yes, please\nYes what?"),  # quoted nothing, as 7 did
        (9, "u", "yes, please\n\n> Do you want coffee?"),  # the answer on top
        (10, "a", "Good\n\n> yes, please\n> > Do you want coffee?"),
        (11, "u", "> Do you want tea?\nno thanks\n\nKind regards of the whole team"),
        (12, "u", "> Do you want tea?\nwith milk\n\nKind regards of the whole team"),
        (13, "a", "> > Do you want tea?\n> with milk\n>\n> Kind regards of the whole team\nMilk is out"),
    ])
    assert {k: v[2] for k, v in got.items()} == {
        1: None, 2: None, 3: 1, 4: 2, 5: 3, 6: 4, 7: None, 8: 7, 9: 2, 10: 9, 11: 1, 12: 1, 13: 12}  # 4 and 9 are alike to 10: the nearest


def test_deeper_quotes_tell_apart(spark):
    """Two threads share two texts in a row; only the third level differs."""
    rows = []
    for k, first in enumerate(("one of them", "the other one")):
        said = [first, "go on", "and then?", f"the end of {first}"]
        rows += [(10 * k + n, "u", "".join("> " * d + said[n - d] + "\n" for d in range(n, 0, -1)) + said[n])
                 for n in range(4)]
    assert {k: v[2] for k, v in linked(spark, rows).items()} == {
        10 * k + n: 10 * k + n - 1 if n else None for k in (0, 1) for n in range(4)}


def test_hot_turn_keeps_its_conversation(spark):
    """A third of all turns say the same in answer to different turns."""
    talks = [(c, n, "u", "yes, please" if n == 1 else f"turn {n} of talk {c}") for c in range(60) for n in range(3)]
    out = link_quotations(mails(spark.createDataFrame(talks, "conv_id long, turn long, role string, text string")))
    for r in out.collect():
        talk, turn = divmod(r["msg_id"], 1_000_000)
        assert (r["conversation_id"], r["position"], r["depth"]) == (talk * 1_000_000, turn, turn)


def test_empty(spark):
    assert link_quotations(spark.createDataFrame([], SCHEMA)).collect() == []
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert mails(empty).collect() == []


def test_equal_first_turns_stay_apart(spark):
    """A third of all messages say the same at the start; every reply goes to its own conversation."""
    rows = []
    for c in range(1, 41):
        first, second = c * 1000, c * 1000 + 1
        rows.append((first, "user", "Hello there, can you help me?"))
        rows.append((second, "assistant", "> Hello there, can you help me?\n\nYes, with what?"))
        rows.append((c * 1000 + 2, "user", "> > Hello there, can you help me?\n> Yes, with what?\n\nThanks"))
    got = linked(spark, rows)
    assert {m: v[0] for m, v in got.items()} == {m: m // 1000 * 1000 for m in got}
    assert {m: (v[2], v[3]) for m, v in got.items()} == {
        m: ((None, 0) if m % 1000 == 0 else (m - 1, m % 1000)) for m in got}


def test_nearest_original_ahead(spark):
    """Against a loop over all originals, with ties of ids and a key that fills several partitions."""
    import random

    from adlens.llm.quotation import nearest_ahead
    rng = random.Random(3)
    key = lambda: bytes([0 if rng.random() < 0.5 else rng.randrange(1, 6)])
    originals = [(key(), rng.randrange(300), r) for r in range(400)]
    quotes = [(key(), rng.randrange(300), 1000 + r) for r in range(400)]
    got = nearest_ahead(spark.createDataFrame(originals, "key binary, id long, _row long").repartition(3),
                        spark.createDataFrame(quotes, "key binary, id long, _row long")).collect()
    want = {}
    for k, i, r in quotes:
        ahead = [(oi, o) for ok, oi, o in originals if ok == k and oi < i]
        if ahead:
            want[r] = max(ahead)
    assert {r["_row"]: (r["parent_id"], r["parent"]) for r in got} == want and len(got) == len(want)
