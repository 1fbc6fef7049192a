import random

from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfline.llm import quotes as Q
from tests.conftest import SF_SMALL

COLS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """{(conv, turn, role, text)}: expected links by looking through all earlier messages."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] if r[1] is not None else -1, r[2] or "", r[3] or ""))
    out = {}
    for r in rows:
        p = Q.parsed(r[3])
        best, n = None, 0
        for q in p["quotes"]:
            old = [s[1] for s in rows if s[0] == r[0] and (s[1] if s[1] is not None else -1) < (r[1] if r[1] is not None else -1)
                   and q["hash"] in Q.parsed(s[3])["hashes"]]
            if old:
                n += 1
                best = max([best or (-99, -99), (-q["depth"], max(x if x is not None else -1 for x in old))])
        out[r] = (p["own"], len(p["quotes"]), n, max([q["depth"] for q in p["quotes"]], default=0), best[1] if best else None)
    return out


def test_levels_and_blocks():
    text = "Hi,\n\nOn Monday Ann wrote:\n> first line\n> second\n>> deeper\n> > also deeper\nmy answer\n>\n\nbye"
    assert Q.blocks(text) == [(0, "Hi,\n"), (1, "first line\nsecond"), (2, "deeper\nalso deeper"), (0, "my answer"), (0, "\nbye")]
    p = Q.parsed(text)
    assert p["own"] == "Hi,\n\nmy answer\n\nbye" and [q["depth"] for q in p["quotes"]] == [1, 2]
    assert Q.parsed(None) == {"own": "", "quotes": [], "hashes": []}
    assert Q.digest("  A\tb\n c ") == Q.digest("a b c") and Q.digest(" \n") is None


def test_query_on_the_table(spark):
    rows = E.queries()["op3_quote_linking"](spark, SF_SMALL).collect()
    want = brute([tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])
    got = sorted((r.conv_id, r.turn, r.role, r.text, r.n_quotes, r.n_linked, r.max_depth, r.reply_turn) for r in rows)
    assert got == sorted((k[0], k[1], k[2], *v) for k, v in want.items())
    # no message quotes here: the layout is conversation by conversation, turn by turn
    assert [(r.conv_id, r.turn) for r in rows] == sorted((k[0], k[1]) for k in want)
    assert all(r.thread_turn == r.turn for r in rows)


def made(seed, monkey):
    r = random.Random(seed)
    rows = []
    for conv in range(8):
        own = []
        for turn in range(r.randint(1, 14)):
            text = " ".join(r.choices("alpha beta gamma delta eps zeta".split(), k=r.randint(1, 4))) + f" {conv}.{turn}" * r.randint(0, 1)
            parts = [text]
            for _ in range(r.randint(0, 2) if own else 0):
                old = r.choice(own)
                parts.insert(r.randint(0, 1), "\n".join(f"{'> ' * r.randint(1, 1)}{x.upper()}" for x in old.split("\n")))
            rows.append((conv, turn, "user", "\n".join(parts)))
            own.append(text)
    return rows


def test_made_conversations(spark, monkeypatch):
    monkeypatch.setattr(Q, "BUCKET_BITS", 1)           # links cross many windows
    for seed in (1, 2):
        rows = made(seed, monkeypatch)
        rows += rows[:5] + [(None, 1, "user", "lost"), (None, 2, "user", "> lost\nfound"), (7, None, None, "alpha")]
        want = brute(rows)
        got = Q.linked(spark.createDataFrame(rows, COLS)).collect()
        assert len(got) == len(want) and any(v[2] for v in want.values())
        key = lambda t: tuple((x is None, x if x is not None else 0) if not isinstance(x, str) else (False, x) for x in t)
        assert (sorted(((g.conv, g.turn, g.own, g.n_quotes, g.n_linked, g.max_depth, g.reply_turn) for g in got), key=key)
                == sorted(((k[0], k[1], *v) for k, v in want.items()), key=key))
        # threads are the messages joined by answers; each lies together, in turns, and starts where it says
        seen, place = set(), {}
        for i, g in enumerate(got):
            place[g.conv, g.turn] = i
            if g.reply_turn is not None:
                assert place[g.conv, g.reply_turn] < i
        for a, b in zip(got, got[1:]):
            if (a.conv, a.thread) == (b.conv, b.thread):
                assert (a.turn or -1) <= b.turn
            else:
                assert (b.conv, b.thread) not in seen
                seen.add((a.conv, a.thread))


def test_edges_of_the_input(spark):
    df = spark.createDataFrame([(1, 1, "user", None, 5), (1, 2, "user", "", 5), (1, 3, None, "> ", 5), (1, 4, "user", "x" * 300_000, 5),
                                (1, 5, "user", "> " + "x" * 300_000, 5), (1, 5, "user", "> " + "x" * 300_000, 5)], COLS + ", node int")
    got = {r.turn: r for r in Q.linked(df).collect()}
    assert len(got) == 5 and got[5].reply_turn == 4 and got[5].own == "" and got[5].thread_turn == 4 and got[1].own == ""
    assert Q.linked(df.limit(0)).count() == 0


def test_one_conversation_holds_a_third(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("long").alias("conv_id"),
                                  F.col("id").alias("turn"), F.lit("user").alias("role"),
                                  F.when(F.col("id") % 6 == 3, "> same\nanswer").otherwise("same").alias("text"))
    got = Q.linked(df)
    assert got.where("conv = 0 AND n_linked = 1").count() == 1000
    assert got.where("conv = 0 AND n_linked = 1 AND reply_turn = turn - 3").count() == 1000


def test_trimmed_quotes(spark):
    """Two of three paragraphs, or two of three lines of one, link to the latest message that holds them in a row."""
    text = "First line\nsecond line\nthird line\n\nNext paragraph\n\nLast paragraph"
    rows = [(1, 1, "user", text), (1, 2, "user", "x\n" + text + "\ny"), (1, 3, "user", "second line\nother\nthird line"),
            (1, 4, "user", "> second line\n> third line\nyes"), (1, 5, "user", "> Next paragraph\n>\n> Last paragraph\nno"),
            (1, 6, "user", "> First line\n> third line\nnot in a row"), (1, 7, "user", "> > third line\n> >\n> > next  paragraph\nthree"),
            (2, 8, "user", "> second line\n> third line\nelsewhere"), (None, 1, "user", text), (None, 2, "user", "> first line\n> second line\nok")]
    got = {(r.conv, r.turn): (r.reply_turn, r.n_quotes, r.n_linked) for r in Q.linked(spark.createDataFrame(rows, COLS)).collect()}
    assert got[1, 4] == got[1, 5] == got[1, 7] == (2, 1, 1)
    assert got[1, 6] == got[2, 8] == (None, 1, 0) and got[None, 2] == (1, 1, 1)
