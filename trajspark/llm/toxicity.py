"""Toxicity by weak supervision.

Many voters look at a text: fixed lexicons, patterns, and words and word beginnings mined from
labelled rows. A generative label model estimates by expectation-maximisation how often each voter
speaks up on toxic and on clean texts, discounts voters that go together given the class, and
gives every sampled text a posterior label. A linear classifier is trained on the posteriors and
calibrated on the labels; it scores whole texts.

The model is fitted on a bounded sample (`sample` labelled rows, `stems` mined features); every
row is scored. Rows whose crc32(doc_id as text) mod 3 is 1 are held out: their labels are not read.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trajspark.llm.common import stored

SAMPLE = 8000            # labelled rows that the model is fitted on, at most
STEMS = 200              # mined features, at most
LEAST_DOCS = 4           # toxic sampled documents with a mined feature, at least
TIMES = (1, 2)           # occurrences in a text that a mined voter may ask for
TRUST = 0.95             # share of given labels taken to be right before any is seen,
BELIEF = 20              # as if it had been seen in so many rows of each class
THRESHOLD = 0.7
SEED = 42

# Word lists of the lexicon voters and patterns of the pattern voters, by token.
LEXICONS = {
    "insult": frozenset("""idiot idiots moron morons stupid dumb fool clown loser losers scum trash
garbage worthless pathetic disgusting imbecile cretin jerk bastard bitch asshole pervert
idiota idiotas imbecil estupido estupida basura idiote imbécile stupide ordure connard salaud
salope dummkopf trottel abschaum arschloch schwachkopf""".split()),
    "threat": frozenset("""kill murder stab strangle slaughter lynch rape hurt tuer töten matar
""".split()),
    "profane": frozenset("""fuck fucking fucked fucker shit shitty bullshit crap damn piss dick cunt
whore slut wanker merde putain mierda puta joder scheisse scheiße ficken cazzo stronzo""".split()),
    "contempt": frozenset("""hate hates hated despise loathe vermin parasite parasites subhuman filth
savages inferior degenerate degenerates freak freaks deport hasse odio haine""".split()),
}
PATTERNS = {
    "masked": re.compile(r"[^\W\d_][*@$#]+[^\W\d_]"),
    "drawn out": re.compile(r"([^\W\d_])\1{3}"),
}
SHAPES = ("shout", "bang", "no stem", "no insult")
VOTERS = (*LEXICONS, *PATTERNS, *SHAPES)
INSULT = VOTERS.index("insult")
BY_TOKEN = len(LEXICONS) + len(PATTERNS)
LETTERS = re.compile(r"[^\W\d_]+")


def features(token):
    """Words of a blank-separated lower-case token and their beginnings of 3 to 8 letters."""
    out = set()
    for word in LETTERS.findall(token):
        if len(word) > 2:
            out.add(word + "$")
            out.update(word[:n] for n in range(3, min(8, len(word)) + 1))
    return out


class Voters:
    """Which voters speak up on a text. Holds a bounded cache of tokens seen.

    A mined voter is (stem, times): it speaks up if the stem occurs so many times or more.
    """

    def __init__(self, stems):
        self.stems = {}
        for k, (stem, times) in enumerate(stems):
            self.stems.setdefault(stem, []).append((len(VOTERS) + k, times))
        self.size = len(VOTERS) + len(stems)
        self.silent, self.known = set(), {}

    def _token(self, token):
        words = LETTERS.findall(token)
        said = [not known.isdisjoint(words) for known in LEXICONS.values()]
        said += [bool(pattern.search(token)) for pattern in PATTERNS.values()]
        found = ([k for k, yes in enumerate(said) if yes],
                 [f for f in features(token) if f in self.stems])
        if len(self.silent) + len(self.known) > 100_000:
            self.silent, self.known = set(), {}
        if found[0] or found[1]:
            self.known[token] = found
            return found
        self.silent.add(token)
        return None

    def __call__(self, text):
        """Sorted numbers of the voters that vote, how many tokens hit a list or a stem, and the
        same in a thousand words."""
        text = text or ""
        tokens = text.lower().split()
        said, stems, hits = set(), Counter(), 0
        found = {token: self.known.get(token) or self._token(token)
                 for token in set(tokens).difference(self.silent)}
        found = {token: f for token, f in found.items() if f}
        # A few tokens are counted one by one, many in one go.
        counts = Counter(tokens) if len(found) > 8 else {t: tokens.count(t) for t in found}
        for token, (votes, its_stems) in found.items():
            times = counts[token]
            said.update(votes)
            stems.update(dict.fromkeys(its_stems, times))
            hits += times
        ids = {k for stem, n in stems.items() for k, times in self.stems[stem] if n >= times}
        chars = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        upper = np.count_nonzero((chars >= 65) & (chars <= 90))
        lower = np.count_nonzero((chars >= 97) & (chars <= 122))
        shapes = (upper > 20 and upper > lower, text.count("!") * 50 > len(text), not ids,
                  INSULT not in said)
        ids |= said | {BY_TOKEN + k for k, yes in enumerate(shapes) if yes}
        return sorted(ids), hits, 1000 * hits / max(20, len(tokens))


def vector(ids, hits, rate, size):
    """What the classifier sees: one sign per voter, the hits and their rate as logarithms."""
    out = np.zeros(size + 2)
    out[ids], out[size:] = 1.0, np.log1p((hits, rate))
    return out


def label_model(votes, label, prior, rounds=50):
    """Posterior of the toxic class per row of 0/1 `votes`, and how often the given label says
    toxic on toxic and on clean rows, all from expectation-maximisation.

    The given label is one more voter. Its rates start at `TRUST` and are estimated like those of
    the others, with `BELIEF` rows of each class that agree with `TRUST` added. A voter's log-odds
    are divided by the sum of its positive correlations (given the class) with all voters of
    `votes`, itself included. The label stands outside this, being no function of the text.
    """
    post, n, mean = label.astype(float), len(votes), votes.mean(axis=0)
    hit, false = TRUST, 1 - TRUST
    for turn in range(rounds):
        p1 = (post @ votes + mean) / (post.sum() + 1)
        p0 = ((1 - post) @ votes + mean) / (n - post.sum() + 1)
        if turn:                                    # the first posterior is the label itself
            hit = (post @ label + BELIEF * TRUST) / (post.sum() + BELIEF)
            false = ((1 - post) @ label + BELIEF * (1 - TRUST)) / (n - post.sum() + BELIEF)
        rest = votes - (post[:, None] * p1 + (1 - post)[:, None] * p0)
        spread = np.sqrt((rest ** 2).mean(axis=0)) + 1e-6
        together = np.maximum((rest.T @ rest) / n / np.outer(spread, spread), 0)
        np.fill_diagonal(together, 1)
        together[together < 0.1] = 0
        weight = 1 / together.sum(axis=1)
        p1, p0 = np.clip(p1, 1e-4, 1 - 1e-4), np.clip(p0, 1e-4, 1 - 1e-4)
        odds = np.log(prior / (1 - prior)) + votes @ (weight * np.log(p1 / p0)) \
            + (1 - votes) @ (weight * np.log((1 - p1) / (1 - p0)))
        odds += label * np.log(hit / false) + (1 - label) * np.log((1 - hit) / (1 - false))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - post).max() < 1e-4:
            break
        post = new
    return post, (float(hit), float(false))


def logistic(x, y, ridge):
    """Weights and intercept of a ridge logistic regression on soft labels, by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    w, cost = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    cost[-1] = 1e-6
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(cost + 1e-9),
                               x.T @ (p - y) + cost * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], w[-1]


def fit(stems, votes, toxic):
    """The classifier as plain values, from what the voters say on each sampled text. Without
    sampled rows of both classes it is a fixed one that trusts the lexicons."""
    size, toxic = len(VOTERS) + len(stems), np.asarray(toxic, float)
    if not 0 < toxic.sum() < len(toxic):
        weights = np.zeros(size + 2)
        weights[:BY_TOKEN], weights[INSULT], weights[size] = 1.0, 5.0, 1.0
        return {"stems": list(stems), "weights": weights, "base": -4.0}
    x = np.array([vector(*v, size) for v in votes])
    prior = float(np.clip(toxic.mean(), 0.01, 0.5))
    post, label_rates = label_model(x[:, :size], toxic, prior)
    weights, base = logistic(x, post, 1.0)
    slope, shift = logistic((x @ weights + base)[:, None], toxic, 1e-3)
    return {"stems": list(stems), "weights": weights * slope[0],
            "base": float(base * slope[0] + shift), "label_rates": label_rates}


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _count_features(batches):
    counts = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
            found = Counter()
            for token, n in Counter((text.as_py() or "").lower().split()).items():
                found.update(dict.fromkeys(features(token), n))
            counts[toxic].update((f, times) for f, n in found.items() for times in TIMES
                                 if n >= times)
    names = list(counts[0].keys() | counts[1].keys())
    for k in range(0, len(names), 20_000):
        part = names[k:k + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in part]), pa.array([f[1] for f in part], pa.int32()),
             pa.array([counts[1][f] for f in part], pa.int64()),
             pa.array([counts[0][f] for f in part], pa.int64())],
            ["stem", "times", "bad", "good"])


def _cast_votes(stems):
    def run(batches):
        votes = Voters(stems)
        for batch in batches:
            found = [votes(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.float64()),
                 batch.column("toxic").cast(pa.int32())], ["ids", "hits", "rate", "toxic"])
    return run


def mined(rows: DataFrame, limit=STEMS) -> list:
    """The (stem, times) of (text, toxic) that most surely point to toxic rows, best first. Of
    stems that begin with one another, only the best is taken."""
    counts = rows.mapInArrow(_count_features, "stem string, times int, bad long, good long")
    sums = counts.groupBy("stem", "times").agg(F.sum("bad").alias("bad"),
                                               F.sum("good").alias("good"))
    total = rows.agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")).first()
    bad, good = float(total.bad or 0), float(total.good or 0)
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5) * F.lit((good + 1) / (bad + 1)))
    doubt = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = (sums.filter(F.col("bad") >= LEAST_DOCS).withColumn("sure", odds - 1.64 * doubt)
            .filter("sure > 1").orderBy(F.desc("sure"), "stem", "times").limit(40 * limit))
    taken = []
    for row in best.collect():
        if len(taken) < limit and not any(row.stem.startswith(s) or s.startswith(row.stem)
                                          for s, _ in taken):
            taken.append((row.stem, row.times))
    return taken


def train(docs: DataFrame, labels: DataFrame, sample=SAMPLE, stems=STEMS) -> dict:
    """Fits the model on at most `sample` rows of `docs` with a label that is not held out.

    The sampled labels are broadcast: their number is bounded. Of several labels of a doc_id the
    highest counts; null labels do not.
    """
    known = (labels.filter(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic"))
             .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(sample))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = stored(rows.select("text", "toxic").coalesce(8))
    found = mined(rows, stems)
    said = rows.mapInArrow(_cast_votes(found), "ids array<int>, hits long, rate double, toxic int")
    said = said.toPandas()
    return fit(found, list(zip(said["ids"], said["hits"], said["rate"])), said["toxic"])


def score(docs: DataFrame, model, text="text") -> DataFrame:
    """Adds `score` and `predicted` to every row."""
    stems, weights, base = model["stems"], model["weights"], model["base"]
    size = len(VOTERS) + len(stems)

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        votes = Voters(stems)
        for texts in batches:
            out = np.empty(len(texts))
            for k, t in enumerate(texts):
                ids, hits, rate = votes(t.as_py())
                out[k] = base + weights[ids].sum() + weights[size:] @ np.log1p((hits, rate))
            yield pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))
    return docs.withColumn("score", of(F.col(text))).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`.

    Null and empty texts get the score of a text on which no list speaks up. Repeated rows are
    scored each. A null doc_id has no label and is not held out. Empty tables: no labels give
    the fixed lexicon model, no documents an empty result. Other columns are ignored.
    """
    model = train(docs, labels, **options)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")


def clean(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, all columns, that are not predicted toxic."""
    model = train(docs.select("doc_id", "text"), labels, **options)
    kept = score(docs.select(F.struct("*").alias("doc"), "text"), model)
    return kept.filter("predicted = 0").select("doc.*")


def is_held_out(doc_id):
    """The rule in Python, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 3 == 1
