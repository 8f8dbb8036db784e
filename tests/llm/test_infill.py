import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from tests.llm.helpers import MIDDLE, documents, oracle, rows, same_rows
from trajspark.llm import infill, queries

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
           "restored_sha256")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow(doc_id, text):
    text = text or ""
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = TOKEN.findall(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), form, len(p), len(m), sha(out), sha(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 15), max_size=300), st.data())
def test_ranks(symbols, data):
    matrix = infill.WaveletMatrix(np.array(symbols, np.uint8))
    places = np.array(data.draw(st.lists(st.integers(0, len(symbols)), min_size=1, max_size=9)))
    for symbol in range(16):
        wanted = [symbols[:p].count(symbol) for p in places]
        assert matrix.rank(symbol, places).tolist() == wanted


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab é漢😀 \t\n\r\x0b\x1c\x85<P>"),
                                             max_size=40)), max_size=8),
       st.integers(0, 1 << 32), st.integers(0, 1 << 32))
def test_cuts(texts, h1, h2):
    given_cuts = np.full(len(texts), h1), np.full(len(texts), h2)
    got = infill.cuts(pa.array(texts, pa.string()), *given_cuts).T.tolist()
    lines = infill.cuts(pa.array(["x"] + texts, pa.string())[1:], *given_cuts, "line").T.tolist()
    for text, one, two in zip(texts, got, lines):
        for units, (n, a, b) in ((TOKEN.findall(text or ""), one),
                                 (re.findall(r"[^\n]*\n|[^\n]+", text or ""), two)):
            low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
            assert (n, a, b) == (len(units), len("".join(units[:low])),
                                 len("".join(units[:high])))


def test_slices_change_nothing():
    texts = pa.array([f"a{k} b\nc " * (k % 7) for k in range(60)])
    h1, h2 = np.arange(60) * 7919, np.arange(60) * 104729
    ends = np.concatenate(([0], np.cumsum([len(t.as_py()) for t in texts])))
    for limit in (1, 10, 100):
        runs = list(infill._slices(ends, limit))
        assert [k for a, b in runs for k in range(a, b)] == list(range(60))
        parts = [infill.cuts(texts[a:b], h1[a:b], h2[a:b]) for a, b in runs]
        assert np.array_equal(np.concatenate(parts, axis=1), infill.cuts(texts, h1, h2))
    assert list(infill._slices(np.zeros(1, int))) == []


CASES = [(k, f"Kurz é{k} 漢字 😀\n und  mehr {k}\t" * (k % 5)) for k in range(40)] + [
    (100, None), (101, ""), (102, "  \n "), (103, "holds <S> a marker"), (104, "a<"), (105, "<<P"),
    (106, "word " * 60000), (107, "x" * 300000), (3, "Kurz é3"), (3, "Kurz é3"), (None, "no id here"),
    (108, "\x1c \x85  tail "), (-5, "negative id of a row <P")]


def test_cases(spark):
    docs = documents(spark, [(i, t, "s") for i, t in CASES], "_text _hash _at _parts output N")
    assert rows(infill.infill_digests(docs), *COLUMNS) == sorted(
        (slow(i, t) for i, t in CASES), key=repr)


def test_output_and_text(spark):
    docs = documents(spark, [(i, t, "s") for i, t in CASES if i != 3])
    out = infill.infilled(docs, rate=100, spm=0)
    found = {r.doc_id: r for r in infill.restored(out).collect()}
    for i, t in CASES:
        if i != 3:
            assert found[i].text == (t or "")
            assert (found[i].form == "plain") == (not t or "<S>" in t)
    lines = infill.infilled(docs, unit="line", rate=100)
    assert {r.doc_id: r.n for r in lines.collect()}[4] == 5


def test_string_ids_and_empty_table(spark):
    docs = spark.createDataFrame([("a7", "one two three")], "doc_id string, text string")
    assert infill.infill_digests(docs).first().restored_sha256 == sha("one two three")
    assert infill.infill_digests(documents(spark, [])).count() == 0


def test_sql_twin(spark):
    same_rows(queries.op11_fill_in_middle(spark, MIDDLE).toPandas(),
              oracle(infill.ORACLE_SQL, MIDDLE))
