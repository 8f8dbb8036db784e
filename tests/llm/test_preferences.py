import pytest

from tests.llm.helpers import MIDDLE, oracle, same_rows
from trajspark.llm import preferences, queries

TURNS = "array<struct<role:string,text:string>>"
SCHEMA = f"pair long, chosen {TURNS}, rejected {TURNS}, other string"


def show(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns)


def slow(chosen, rejected):
    a, b = chosen or [], rejected or []
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    out = [n, show(a[:n])]
    for rest in (a[n:], b[n:]):
        out.append(show(rest))
    for rest in (a[n:], b[n:]):
        at, spans = 0, []
        for r, t in rest:
            size, head = len(show([(r, t)])), len(f"<|{r or ''}|>\n")
            if r == "assistant":
                spans.append(f"{at + head}:{at + size}")
            at += size
        out.append(",".join(spans))
    return tuple(out)


U, A, S = (lambda t: ("user", t)), (lambda t: ("assistant", t)), (lambda t: ("system", t))
CASES = [
    ([S("s"), U("q"), A("good")], [S("s"), U("q"), A("bad"), U("é𝒳"), A("x")]),
    ([U("q"), A("a")], [U("other"), A("a")]), ([U("q"), A("a")], [U("q")]),
    ([U("q")], [U("q"), A("a")]), ([U("q"), A("a")], [U("q"), A("a")]), ([], []), (None, [A("x")]),
    ([A("x")], None), (None, None), ([(None, None), A(None)], [(None, None), A("")]),
    ([U("q"), A("")], [A("q"), A("")]),
    ([U(f"{k}") if k % 2 else A(f"{k}") for k in range(3000)],
     [U(f"{k}") if k % 2 else A(f"{k}") for k in range(2999)] + [A("end")]),
    ([U("w " * 100_000), A("1")], [U("w " * 100_000), A("2")])]
NAMES = ("n_prompt", "prompt", "chosen_text", "rejected_text", "chosen_spans", "rejected_spans")


def test_cases(spark):
    frame = spark.createDataFrame([(k, a, b, "x") for k, (a, b) in enumerate(CASES * 2)], SCHEMA)
    got = preferences.preference_rows(frame)
    assert got.columns == ["pair", "other", *NAMES]
    found = {r.pair: tuple(r[n] for n in NAMES) for r in got.collect()}
    assert found == {k: slow(a, b) for k, (a, b) in enumerate(CASES * 2)}


def test_spans_hold_what_is_trained(spark):
    frame = spark.createDataFrame([(0, *CASES[0], "x")], SCHEMA)
    r = preferences.preference_rows(frame).first()
    spans = [tuple(map(int, s.split(":"))) for s in r.rejected_spans.split(",")]
    assert [r.rejected_text[a:b] for a, b in spans] == ["bad<|end|>\n", "x<|end|>\n"]
    assert r.prompt + r.chosen_text == show(CASES[0][0])


def test_clashing_names(spark):
    frame = spark.createDataFrame([], SCHEMA + ", prompt string")
    with pytest.raises(ValueError):
        preferences.preference_rows(frame)
    assert preferences.preference_rows(frame.drop("prompt")).count() == 0


def test_whole_table(spark):
    same_rows(queries.op2_preference_format(spark, MIDDLE).toPandas(),
              oracle(preferences.ORACLE_SQL, MIDDLE))


def test_reply_pairs(spark):
    schema = "conv_id long, turn long, role string, text string, chosen string, last int"
    data = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"),
            (1, 3, "assistant", "b"), (1, 4, "user", "end"), (2, 0, "assistant", "only"),
            (3, 0, "user", "q"), (4, 1, None, None), (4, 0, "user", None), (4, 0, "user", None),
            (None, 0, "user", "x"), (None, 1, "assistant", "y")]
    frame = spark.createDataFrame([(*r, "c", 1) for r in data], schema)
    got = {r.conv_id: [(t.role, t.text) for t in r.rejected]
           for r in preferences.reply_pairs(frame).collect()}
    assert got == {1: [("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "a")],
                   2: [("assistant", "")], 3: [], 4: [("user", None), ("user", None)],
                   None: [("user", "x"), ("assistant", "x")]}
    assert preferences.reply_pairs(frame.filter("false")).count() == 0
