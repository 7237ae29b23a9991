"""Fill-in-middle (11) and chat formatting (13): brute force, round trips and defined cases."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tickerloom.llm import chat, fim

from .conftest import ODD

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text):
    """The dealt cut, written plainly."""
    t = text or ""
    units = UNIT.findall(t)
    n = len(units)
    if doc_id is None:
        return n, "plain", t
    h = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if t == "" or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", t
    if h4 % 100 < 80:
        return n, "spm", f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", f"<P>{pre}<S>{suf}<M>{mid}"


def fim_rows(documents, rows):
    cut = fim.transform(documents(rows))
    return cut.select("*", fim.restore(F.col("output"), F.col("form")).alias("restored")).collect()


def test_fim_equals_plain_cut_and_restores(documents):
    rng = random.Random(3)
    pieces = ["a", "bb", " ", "  ", "\n", "\t", "é", "😀", "<", "P>", "x.y"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 60)))) for i in range(300)]
    for r in fim_rows(documents, rows + ODD):
        n, form, output = plain_fim(r["doc_id"], r["text"])
        assert (r["n"], r["form"], r["output"]) == (n, form, output)
        assert r["restored"] == (r["text"] or "")
        if form == "plain":
            assert r["prefix_chars"] is None and r["middle_chars"] is None
        else:
            assert r["prefix"] + r["middle"] + r["suffix"] == r["text"]
            assert r["prefix_chars"] == len(r["prefix"])


def test_fim_defined_cases(documents):
    long_text = "word " * 200_000
    rows = [(None, "text without key"), (10, None), (11, ""), (12, "has <M> inside"), (13, long_text), (13, long_text)]
    got = fim_rows(documents, rows)
    assert [r["form"] for r in got[:4]] == ["plain"] * 4
    assert got[1]["output"] == "" and got[1]["n"] == 0
    assert got[4]["n"] == 200_001 and got[4]["restored"] == long_text
    assert got[4]["output"] == got[5]["output"]
    assert "kept" in got[0].asDict()  # carried clashing columns stay, results replace their names
    assert isinstance(got[0]["n"], int)


def test_fim_empty_table(spark, documents):
    assert fim.transform(documents([(1, "x")]).limit(0)).count() == 0


# 13 chat formatting

ALPHABET = ["<", "[", "\\", "/", "s", ">", "|", "INST", "]", "S", "a", "\n", "<|im_end|>", "</s>", "[/INST]"]


def test_escape_round_trip(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 25))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", chat.escape(F.col("t")).alias("e")).select("t", "e", chat.unescape(F.col("e")).alias("u")).collect()
    for r in got:
        assert r["u"] == r["t"]
        for marker in ("<|", "<s>", "</s>", "[INST]", "[/INST]"):
            assert marker not in r["e"]


CONV = "conv_id long, turn long, role string, text string"


def plain_read(rows):
    """What the read back must give, from the turns themselves."""
    out = {}
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    for c, turns in convs.items():
        turns.sort(key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
        lines = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        out[c] = (len(turns), hashlib.sha256(lines.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_examples_and_read_back(spark):
    rows = [
        (1, 0, "system", "be brief"), (1, 1, "user", "hi <|im_end|> [INST]"), (1, 2, "assistant", "</s>[INST] ok [/INST]"),
        (1, 3, "user", None), (1, 4, "assistant", "second\n\\<|x"),
        (2, 0, "user", "only a question"),  # no reply: one tail example
        (3, 0, "user", "q"), (3, 1, "assistant", "a"), (3, 2, "user", "trailing"),  # tail after the last reply
        (4, 1, "assistant", "x"), (4, 1, "assistant", "x"), (4, None, None, "no turn"),  # ties, repeats, null turn and role
        (None, 0, "user", "u"), (None, 1, "assistant", "v"),  # null conversation id
        (5, 0, "assistant", "é😀" * 50_000),  # very long reply
    ]
    df = spark.createDataFrame(rows, CONV).withColumn("example", F.lit("clash")).withColumn("is_tail", F.lit(1))
    examples = chat.expand(df)
    ex = {(r["conv_id"], r["example"]): r for r in examples.collect()}
    assert sorted(k for k in ex if k[0] == 1) == [(1, 0), (1, 1)]
    first = ex[(1, 0)]
    assert first["text"][first["loss_start"]:first["loss_end"]] == "<\\/s>[\\INST] ok [\\/INST]"
    assert ex[(2, 0)]["is_tail"] and ex[(2, 0)]["loss_start"] == ex[(2, 0)]["loss_end"] == len(ex[(2, 0)]["text"])
    assert ex[(3, 1)]["is_tail"] and not ex[(3, 0)]["is_tail"]
    back = {r["conv_id"]: r for r in chat.read_back(examples).collect()}
    want = plain_read(rows)
    assert set(back) == set(want)
    for c, (n, turns, loss_chars, loss) in want.items():
        r = back[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (n, turns, loss_chars, loss), c


def test_chat_empty(spark):
    empty = spark.createDataFrame([], CONV)
    assert chat.expand(empty).count() == 0
    assert chat.read_back(chat.expand(empty)).count() == 0
