"""Secret scans: fixed patterns, and a character convolutional network for what they miss.

Candidates are runs of eight and more token characters with a digit. The network (numpy) sees a
candidate in windows that cover all of it, each with the text before and after, and the highest score
counts. It is trained on labelled findings: candidates that a pattern covers against plain ones, that
is, numbers and names with numbers. Candidates that are neither are unlabelled: they are scored, but
neither trained on nor counted as false. Scores are calibrated on findings kept out of the training;
the threshold is the lowest one that is precise on those, and never misses more than a share of them.

The network is fitted on at most `sample` windows; calibration and threshold come from a histogram of
the scores of all kept-out labelled ones, each as often as it occurs, and every candidate is scored.
"""

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from trajspark.llm.common import stored

SAMPLE = 6000            # labelled candidates that the network is fitted on, at most
RECALL = 0.98            # share of known findings that the threshold must keep
PRECISION = 0.99         # share of true findings that it should have
LEAST_THRESHOLD = 0.5
LEAST_CHARS = 8          # of a candidate
BEFORE, INSIDE, AFTER = 24, 40, 16      # characters of a window
STRIDE = 20              # between the windows of a longer candidate
FILTERS, WIDTH, ROUNDS, SEED = 24, 5, 12, 42
STEPS = 64               # of the histogram of raw scores, to one unit
KINDS = ("assign", "access", "hex", "model")

# The base patterns.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
DIGITS = re.compile(r"[0-9]+")
# Numbers, versions, hosts, paths and names with a short number, in one case.
PLAIN = re.compile(r"(?:[A-Z]?[a-z]*|[A-Z]+)[0-9]{0,4}(?:[-+.=_/](?:[a-z]*[0-9]{0,4}|[0-9]+))*|[0-9]+"
                   r"(?:[-+.=_/][0-9]+)*[-+.=_/]*")
TOKEN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")

ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789 \n\"'=:;,.-_+/@#"
CODE = {c: k + 1 for k, c in enumerate(ALPHABET)}
CHANNELS = len(ALPHABET) + 4      # padding and other characters, upper case, inside


def base_spans(text):
    """(kind, start, end) of the base patterns, leftmost and non-overlapping per kind."""
    out, lower = [], text.lower()
    if any(k in lower for k in KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
                if len(m[0]) >= 16]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def candidates(text):
    """(start, end) of all runs of token characters that hold a digit and are long enough."""
    out, done, size = [], 0, len(text)
    for m in DIGITS.finditer(text):
        if m.start() < done:
            continue
        start, end = m.span()
        while start > done and text[start - 1] in TOKEN:
            start -= 1
        while end < size and text[end] in TOKEN:
            end += 1
        done = end
        if end - start >= LEAST_CHARS:
            out.append((start, end))
    return out


def window(text, start, end):
    """What the network sees of a stretch: the text before, the stretch and the text after, padded
    with NUL."""
    before = text[max(0, start - BEFORE):start]
    after = text[end:end + AFTER]
    return before.rjust(BEFORE, "\0") + text[start:end].ljust(INSIDE, "\0") + after.ljust(AFTER, "\0")


def windows(text, start, end):
    """The windows of a candidate: one, or overlapping ones that cover it all."""
    starts = [start] if end - start <= INSIDE else [*range(start, end - INSIDE, STRIDE), end - INSIDE]
    return [window(text, a, min(end, a + INSIDE)) for a in starts]


def pixels(windows):
    """Windows -> (count, length, channels) of zeros and ones."""
    out = np.zeros((len(windows), BEFORE + INSIDE + AFTER, CHANNELS), np.float32)
    for k, text in enumerate(windows):
        codes = [0 if c == "\0" else CODE.get(c.lower(), len(ALPHABET) + 1) for c in text]
        out[k, np.arange(len(codes)), codes] = 1
        out[k, :, -2] = [c.isupper() for c in text]
    out[:, BEFORE:BEFORE + INSIDE, -1] = 1
    out[:, :, 0] = 0
    return out


def _patches(x):
    view = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)
    return np.ascontiguousarray(view.transpose(0, 1, 3, 2)).reshape(
        len(x), x.shape[1] - WIDTH + 1, -1)


def _forward(net, x):
    hidden = np.maximum(_patches(x) @ net["filters"] + net["shifts"], 0)
    pooled = np.concatenate((hidden.max(axis=1), hidden.mean(axis=1)), axis=1)
    return hidden, pooled, pooled @ net["weights"] + net["base"]


def logits(net, windows):
    out = [_forward(net, pixels(windows[k:k + 256]))[2] for k in range(0, len(windows), 256)]
    return np.concatenate(out) if out else np.zeros(0, np.float32)


def train_network(windows, labels, rounds=ROUNDS, seed=SEED):
    """A network fitted with Adam on cross-entropy. In every round half of the windows lose
    the text around them, so that the candidate itself must tell."""
    draw = np.random.default_rng(seed)
    shape = {"filters": (WIDTH * CHANNELS, FILTERS), "shifts": (FILTERS,),
             "weights": (2 * FILTERS,), "base": ()}
    net = {k: (draw.normal(0, 0.1, s) if k in ("filters", "weights") else np.zeros(s))
           .astype(np.float32) for k, s in shape.items()}
    moved = {k: [np.zeros(s, np.float32), np.zeros(s, np.float32)] for k, s in shape.items()}
    windows, labels, step = np.array(windows, object), np.asarray(labels, np.float32), 0
    for _ in range(rounds):
        order = draw.permutation(len(windows))
        for k in range(0, len(order), 64):
            some = order[k:k + 64]
            x, y = pixels(windows[some]), labels[some]
            bare = draw.random(len(some)) < 0.5
            x[bare, :BEFORE] = 0
            x[bare, BEFORE + INSIDE:] = 0
            hidden, pooled, out = _forward(net, x)
            error = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y) / len(some)
            back = error[:, None] * net["weights"][None, :]
            places = hidden.shape[1]
            grad = np.repeat(back[:, None, FILTERS:] / places, places, axis=1)
            top = hidden.argmax(axis=1)
            grad[np.arange(len(some))[:, None], top, np.arange(FILTERS)[None, :]] += \
                back[:, :FILTERS]
            grad *= hidden > 0
            flat = _patches(x).reshape(-1, WIDTH * CHANNELS)
            slopes = {"filters": flat.T @ grad.reshape(-1, FILTERS),
                      "shifts": grad.sum(axis=(0, 1)), "weights": pooled.T @ error,
                      "base": error.sum()}
            step += 1
            for name, slope in slopes.items():
                m, v = moved[name]
                m[...] = 0.9 * m + 0.1 * slope
                v[...] = 0.999 * v + 0.001 * slope ** 2
                net[name] = (net[name] - 0.003 * (m / (1 - 0.9 ** step)) / (
                    np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def fit(windows, labels, kept_out):
    """A calibrated network with its threshold, or None without findings of both labels on both
    sides of the split."""
    labels, kept_out = np.asarray(labels, int), np.asarray(kept_out, bool)
    if len(set(labels[~kept_out])) < 2:
        return None
    windows = np.array(windows, object)
    net = train_network(windows[~kept_out], labels[~kept_out])
    raw = logits(net, windows[kept_out]).astype(float)
    return calibrated(net, raw, labels[kept_out], np.ones(len(raw)))


def calibrated(net, raw, y, weight):
    """The network with its calibration and threshold by raw scores of kept-out findings, each
    standing for `weight` of them; None if they lack a label."""
    raw, y, weight = np.asarray(raw, float), np.asarray(y, int), np.asarray(weight, float)
    if len(set(y)) < 2:
        return None
    slope, shift, share = 1.0, 0.0, weight / weight.sum()
    for _ in range(200):         # a logistic curve over the raw scores, with smoothed labels
        p = 1 / (1 + np.exp(-np.clip(slope * raw + shift, -30, 30)))
        off = (p - (y * 0.98 + 0.01)) * share
        slope, shift = slope - 0.1 * (off * raw).sum(), shift - 0.1 * off.sum()
    chance = 1 / (1 + np.exp(-np.clip(slope * raw + shift, -30, 30)))
    # The lowest threshold from LEAST_THRESHOLD on that is precise enough, unless it must be
    # lower still to find the wanted share.
    true = np.flatnonzero(y == 1)
    true = true[np.argsort(chance[true], kind="stable")]
    upto = np.cumsum(weight[true])
    found = chance[true[np.searchsorted(upto, (upto[-1] - 1) * (1 - RECALL) // 1, "right")]]
    order = np.append(np.unique(chance), 0)
    order.sort()                        # thresholds lie halfway between neighbouring scores
    precise = [(t + below) / 2 for below, t in zip(order, order[1:])
               if np.average(y[chance >= t], weights=weight[chance >= t]) >= PRECISION]
    threshold = min(float(found), max(LEAST_THRESHOLD, min(precise, default=1.0)))
    return {"net": net, "slope": slope, "shift": shift, "threshold": threshold}


def _bins(net):
    """(window, known, n) -> known, the raw score in steps of 1 / STEPS, and n."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            raw = np.clip(logits(net, batch.column("window").to_pylist()), -30, 30)
            yield pa.RecordBatch.from_arrays(
                [batch.column("known"), pa.array(np.rint(raw * STEPS).astype(np.int32)),
                 batch.column("n")], ["known", "bin", "n"])
    return run


def sort_of(text, start, end, base):
    """1 for a candidate that a pattern covers, 0 for a plain one, None for an unlabelled one."""
    if any(c < end and start < d for _, c, d in base):
        return 1
    return 0 if PLAIN.fullmatch(text, start, end) else None


def _findings(batches):
    import pyarrow as pa
    place = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    seen = pa.struct([("start", pa.int32()), ("end", pa.int32()),
                      ("windows", pa.list_(pa.string())), ("known", pa.int32())])
    for batch in batches:
        bases, others = [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            base = base_spans(text)
            bases.append([{"kind": KINDS.index(k), "start": a, "end": b} for k, a, b in base])
            others.append([{"start": a, "end": b, "windows": windows(text, a, b),
                            "known": sort_of(text, a, b, base)} for a, b in candidates(text)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(bases, pa.list_(place)),
             pa.array(others, pa.list_(seen))], ["doc_id", "base", "seen"])


def _joined(spans):
    spans = sorted(spans, key=lambda s: (s[1], s[0]))
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _judged(model):
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            bases, seen = batch.column("base").to_pylist(), batch.column("seen").to_pylist()
            open_ = [(k, s) for k, found in enumerate(seen) for s in found if s["known"] != 1]
            added = [[] for _ in bases]
            if model and open_:
                each = logits(model["net"], [w for _, s in open_ for w in s["windows"]])
                first = np.cumsum([0] + [len(s["windows"]) for _, s in open_])[:-1]
                raw = np.maximum.reduceat(each, first)
                chance = 1 / (1 + np.exp(-np.clip(model["slope"] * raw + model["shift"], -30, 30)))
                for (k, s), p in zip(open_, chance):
                    if p >= model["threshold"]:
                        added[k].append((3, s["start"], s["end"]))
            base = [[(s["kind"], s["start"], s["end"]) for s in found] for found in bases]
            count = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64())
                     for k in range(3)]
            digest = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *count, pa.array(digest),
                 pa.array([_joined(b + a) for b, a in zip(base, added)]),
                 pa.array([len(a) for a in added], pa.int64())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"])
    return run


def secret_scan(docs: DataFrame, sample=SAMPLE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and n_model of every row.

    Spans are kind:start:end in code points, by start, then kind. Spans of the network have the
    kind `model` and never touch a base span. Null texts count as empty and have no spans.
    Repeated rows are scanned each. Without candidates of both labels the network is left out.
    Other columns are ignored; an empty table gives an empty result.
    """
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    found = stored(docs.select("doc_id", "text").mapInArrow(
        _findings, f"doc_id {doc_id}, base array<struct<kind:int,start:int,end:int>>, "
                   "seen array<struct<start:int,end:int,windows:array<string>,known:int>>"))
    # Copies of a window lie on one side of the split and count as often as they occur.
    each = stored(found.select(F.inline("seen")).filter("known is not null").select(
        F.explode("windows").alias("window"), "known").groupBy("window", "known").agg(
        F.count("*").alias("n")).withColumn("h", F.xxhash64("window", F.lit(SEED))))
    kept_out = F.pmod("h", F.lit(10)) < 3
    halves = [each.filter(~kept_out & (F.col("known") == k)).orderBy("h", "window")
              .limit(sample // 2) for k in (0, 1)]
    rows = halves[0].union(halves[1]).toPandas().sort_values(["h", "window", "known"])
    model = None
    if rows["known"].nunique() == 2:
        net = train_network(rows["window"].tolist(), rows["known"])
        counts = (each.filter(kept_out).select("window", "known", "n")
                  .mapInArrow(_bins(net), "known int, bin int, n long")
                  .groupBy("bin", "known").agg(F.sum("n").alias("n")).toPandas()
                  .sort_values(["bin", "known"]))
        model = calibrated(net, counts["bin"] / STEPS, counts["known"], counts["n"])
    return found.mapInArrow(_judged(model), f"doc_id {doc_id}, n_assign long, n_access long, "
                            "n_hex long, base_sha256 string, spans string, n_model long")
