"""What the tests of this folder share."""

import duckdb
import pandas as pd

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=""):
    """(doc_id, text, source) rows as a documents table, with columns whose names may clash."""
    full = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows]
    frame = spark.createDataFrame(full, DOCS)
    for name in extra.split():
        frame = frame.selectExpr("*", f"doc_id AS `{name}`")
    return frame


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def same_rows(got: pd.DataFrame, wanted: pd.DataFrame):
    """Equal as multisets; nullable whole numbers may come as floats."""
    assert sorted(got.columns) == sorted(wanted.columns)

    def plain(frame):
        frame = frame[sorted(frame.columns)].astype(object)
        return sorted((tuple(None if pd.isna(x) else float(x) if isinstance(x, (int, float))
                             and not isinstance(x, bool) else x for x in r)
                       for r in frame.itertuples(index=False, name=None)), key=repr)
    assert plain(got) == plain(wanted)


def oracle(sql, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con.execute(sql).df()


def least_reachable(nodes, links):
    """Smallest node reachable from each, by walking."""
    near = {n: {n} for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n in out:
            continue
        todo = [n]
        while todo:
            m = todo.pop()
            if m not in out:
                out[m] = n
                todo += near[m]
    return out
