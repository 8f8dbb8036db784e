import re

import xxhash
from hypothesis import given, settings, strategies as st

from tests.llm.helpers import SMALL, documents, least_reachable, rows
from trajspark.llm import queries, simhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 3]).encode(), 42)
              for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(docs):
    prints = {(k, i): slow_fingerprint(t) for k, (i, t) in enumerate(docs)}
    keys = list(prints)
    links = [(a, b) for a in keys for b in keys
             if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    roots, out = least_reachable(keys, links), []
    for key, fp in prints.items():
        ids = [k[1] for k in keys if roots[k] == roots[key] and k[1] is not None]
        out.append((key[1], f"{fp:016x}", min(ids, default=None)))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "fingerprint", "component_id")
BASE = " ".join(f"word{k % 37} stays{k}" for k in range(150))
CASES = [(9, BASE), (4, BASE + " more"), (2, BASE.replace("stays70 ", "stayed70 ")),
         (7, "A b\tC"), (8, "a B c"), (1, "a b"), (11, None), (12, ""), (10, " \n\t"), (3, "é É"),
         (5, "\x1c\x85 x"), (6, BASE), (6, BASE), (None, BASE), (None, "alone here now ok"),
         (13, "tok " * 30000)]


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("aAbÉé \t\n\x0b\x1c\x85 "), max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SMALL, "documents").collect()]
    assert rows(queries.op1_simhash_dedup(spark, SMALL), *COLUMNS) == slow_components(docs)


def test_cases_and_small_tiles(spark):
    near = [(100 + k, BASE.replace(f"stays{k} ", f"other{k} ")) for k in range(60)]
    cases = CASES + near
    docs = documents(spark, [(i, t, "s") for i, t in cases], "_fp _row fp component_id")
    wanted = slow_components(cases)
    assert rows(simhash.simhash_components(docs), *COLUMNS) == wanted
    assert rows(simhash.simhash_components(docs, tile=3), *COLUMNS) == wanted
    kept = simhash.simhash_dedup(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted({c for _, _, c in wanted if c is not None} | {None}, key=repr)


def test_tile_links_lose_nothing(spark):
    """Fingerprints at a distance of 2 across all cells, against the definition."""
    import random
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(40)}
    prints |= {p ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) for p in list(prints)}
    prints |= {p ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) for p in list(prints)}
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = [(r.a, r.b) for r in simhash.links(frame, tile=4).collect()]
    assert all((signed[a] ^ signed[b]).bit_count() <= 2 * 3 for a, b in got)
    wanted = [(a, b) for a in signed for b in signed
              if a < b and (signed[a] ^ signed[b]).bit_count() <= 2]
    assert least_reachable(signed, got) == least_reachable(signed, wanted)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert simhash.simhash_components(docs).count() == 0
    assert simhash.simhash_dedup(docs).columns == docs.columns
