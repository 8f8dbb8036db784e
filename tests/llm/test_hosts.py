import random
import re

from tests.llm.helpers import MIDDLE, documents, oracle, rows, same_rows
from trajspark.llm import hosts, queries

COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed")


def slow(doc_id, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, covered = {}, set()
    for k in range(len(words) - 4):
        seen.setdefault(tuple(words[k:k + 5]), []).append(k)
    for places in seen.values():
        if len(places) > 1:
            covered.update(k + j for k in places for j in range(5))
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), failed)


def corpus():
    draw = random.Random(4)
    docs = [(k, " ".join(draw.choice("ab") for _ in range(draw.randrange(0, 60))), "s")
            for k in range(80)]
    return docs + [
        (100, None, None), (101, "", "s"), (102, "\n\n \t", "s"), (103, "x\nx\n x\nx\n\n\n", "s"),
        (104, "a b c d e " * 3, "s"), (105, "#*$%&|<> 𝒳é \x85 \x1c", "s"), (None, "q", "s"),
        (106, " ".join(map(str, range(40_000))) + " 7 8 9 10 11", "s"),
        (107, "same five words go here " * 8_000, "s"), (101, "", "s")]


def test_whole_table(spark):
    same_rows(queries.op9_host_quality(spark, MIDDLE).toPandas(),
              oracle(hosts.ORACLE_SQL, MIDDLE))


def test_counts(spark):
    docs = documents(spark, corpus(), "n_words w l kept rejected")
    assert rows(hosts.host_quality(docs), *COLUMNS) == sorted(
        (slow(i, t) for i, t, _ in corpus()), key=repr)


def good(k):
    return " ".join(f"plain{k}word{j}" for j in range(30))


def test_hosts_are_judged(spark):
    """A host of bad pages takes its good ones with it; one bad page of a small host does not."""
    docs = [(k, good(k), f"host{k % 9}") for k in range(450)]
    docs += [(1000 + k, "bad page", "farm") for k in range(60)] + [(2000, good(1), "farm")]
    docs += [(3000, "bad page", "tiny"), (3001, good(2), "tiny")]
    docs += [(4000 + k, "bad page", None) for k in range(40)] + [(5000, good(3), None)]
    got = {r.doc_id: r.kept for r in hosts.host_quality(documents(spark, docs)).collect()}
    assert {i for i, kept in got.items() if kept} == {*range(450), 3001}


def uneven():
    """Twenty hosts of 100 pages with one bad page each but for one with 40, and small hosts of which
    most pages are bad."""
    docs = [(1000 * h + k, "bad page" if k < (40 if h == 7 else 1) else good(k), f"host{h}")
            for h in range(20) for k in range(100)]
    return docs + [(90_000 + 10 * h + k, "bad page" if k < 2 else good(k), f"small{h}")
                   for h in range(3) for k in range(3)]


def test_a_host_beyond_the_others_goes(spark):
    docs = documents(spark, uneven())
    got = {r.doc_id: r.kept for r in hosts.host_quality(docs).collect()}
    gone = {i for i, t, h in uneven() if not got[i] and t != "bad page"}
    assert gone == {7000 + k for k in range(40, 100)}


def test_uneven_hosts_by_sql(spark):
    import duckdb
    import pandas as pd
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(uneven(), columns=["doc_id", "text", "source"]))
    same_rows(hosts.host_quality(documents(spark, uneven())).toPandas(),
              con.execute(hosts.ORACLE_SQL).df())


def test_one_host_and_empty_table(spark):
    docs = documents(spark, [(k, good(k), "only") for k in range(5)] + [(9, "bad", "only")])
    got = {r.doc_id: r.kept for r in hosts.host_quality(docs).collect()}
    assert got == {0: True, 1: True, 2: True, 3: True, 4: True, 9: False}
    assert hosts.host_quality(documents(spark, [])).count() == 0


def test_no_python_on_the_main_path(spark):
    docs = documents(spark, corpus())
    plan = hosts.measures(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("Scan ExistingRDD", ""))
