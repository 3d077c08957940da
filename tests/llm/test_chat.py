import hashlib

from pyspark.sql import functions as F

from tallyloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, block string, rows string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "r") for r in rows], SCHEMA).repartition(3)


def plain_valid(roles):
    state = "start"
    steps = {("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
    ok = True
    for r in roles:
        ok = ok and (state, r) in steps
        state = r if r in ("system", "user", "assistant") else "start"
    return ok and state == "assistant"


TRICKY = [
    "</s>[INST] ok [/INST]",
    "\\[INST] [\\INST] [\\\\/INST] <\\/s> <",
    "<<SYS>> x <</SYS>> <<<SYS>>",
    " </s> ",
    "$1 \\ $0",
    "",
    "line\nline ",
    "[TURN] a [TEXT] b [/TURN]",
    "é😀",
]


def test_escape_is_reversible_and_leaves_no_control(spark):
    rows = spark.createDataFrame([(t,) for t in TRICKY], "t string")
    for r in rows.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in chat.INSTRUCT.controls)


def conversations():
    rows = []
    for i, a in enumerate(TRICKY):
        rows += [(i, 0, "user", a), (i, 1, "assistant", TRICKY[-1 - i])]
    rows += [(50, 0, "system", "s"), (50, 1, "user", "u"), (50, 2, "assistant", "a"), (50, 3, "user", "u")]
    rows += [(51, 0, "assistant", "a"), (51, 1, "user", "u"), (51, 2, "assistant", "b")]
    rows += [(52, 5, "tool", "x [TEXT] y"), (52, 6, "[/TURN] role", None), (52, 7, None, "z"), (52, None, "user", "first")]
    rows += [(53, 0, "user", "same"), (53, 0, "user", "same"), (53, 1, "assistant", None)]
    rows += [(54, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(0, 1200)]
    rows += [(55, 300 * t, ("user", "assistant")[t % 2], f"t{t}") for t in range(20)]
    rows += [(None, 0, "user", "n"), (None, 1, "assistant", "m")]
    return rows


def test_turns_come_back_and_the_machine_agrees(spark):
    rows = conversations()
    whole = chat.assemble(chat.format_turns(frame(spark, rows)))
    got = whole.select("conv_id", "valid", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"), "segments").collect()
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    assert {r.conv_id for r in got} == set(by) and len(got) == len(by)
    for r in got:
        turns = [(role, text) for _, role, text in sorted(by[r.conv_id])]
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.valid == plain_valid([role for role, _ in turns])
        assert r.loss == "".join(text for role, text in turns if role == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted and len(r.segments) == 3 * len(turns)


def test_digest_of_known_conversation(spark):
    whole = chat.assemble(chat.format_turns(frame(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "yo")])))
    r = whole.first()
    assert r.formatted == "<s>[INST] hi [/INST] yo </s>" and r.valid
    assert hashlib.sha256(r.formatted.encode()).hexdigest() == whole.select(F.sha2("formatted", 256)).first()[0]


def test_empty_table(spark):
    assert chat.assemble(chat.format_turns(frame(spark, []))).count() == 0
