"""SentencePiece encoding and decoding with a unigram model.

The pieces of a model file sit in a double-array trie over UTF-8 bytes; a Viterbi search finds the
segmentation with the highest sum of log scores. Characters without a piece fall back to bytes.
A space is the whitespace marker in front of what follows it, and one is put before the text.

No piece of such a model holds a space after another character, so texts are cut before runs of
spaces into units, and each distinct unit is searched once per task; the search runs over all new
units of a batch at a time.
"""

import re
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNIT_LIMIT = 64          # bytes of units that are searched together; longer ones go alone
CACHE = 100_000          # distinct units that a task remembers
CHUNK = 1 << 18          # characters that are encoded at a time


class Vocabulary:
    """Pieces, log scores and byte pieces of a model file.

    The scores of a merge-rank model (whole numbers from 0 down) become log probabilities by
    Zipf's law; those of a unigram model are taken as they are.
    """

    def __init__(self, path=MODEL):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        self.bytes = {model.piece_to_id(f"<0x{b:02X}>"): b for b in range(256)}
        if len(self.bytes) != 256 or model.unk_id() in self.bytes:
            raise ValueError("the model has no byte pieces to fall back to")
        plain = [i for i in range(size) if i not in self.bytes and not model.is_control(i)
                 and not model.is_unknown(i) and not model.is_unused(i)]
        # The marker stands for a space; the character itself goes by bytes.
        self.pieces = {i: model.id_to_piece(i).replace(MARKER, " ") for i in plain}
        score = np.array([model.get_score(i) for i in plain])
        if (score == np.floor(score)).all():
            score = -np.log((2 - score) * np.log(size))
        self.scores = dict(zip(plain, score.tolist()))
        if any(" " in p.lstrip(" ") for p in self.pieces.values()):
            raise ValueError("a piece has a space after another character")
        self.table = [b""] * size
        for i, piece in self.pieces.items():
            self.table[i] = piece.encode()
        for i, b in self.bytes.items():
            self.table[i] = bytes([b])


def double_array(pieces):
    """(bytes, id) pairs -> base, check and value arrays. From node s the byte c leads to
    t = base[s] + c + 1 if check[t] == s; value[t] is the id of the piece that ends there or -1."""
    root, size = {}, 1 << 12
    for piece, i in pieces:
        node = root
        for c in piece:
            node = node.setdefault(c + 1, {})
        node[0] = i
    base, check, value = (np.full(size, x, np.int32) for x in (0, -1, -1))
    free = np.ones(size, bool)
    free[0], queue, low = False, [(0, root)], 1
    while queue:
        later = []
        for at, node in queue:
            value[at] = node.get(0, -1)
            codes = sorted(c for c in node if c)
            if not codes:
                continue
            while not free[low]:
                low += 1
            start, rest, window = low, np.array(codes[1:], np.int64) - codes[0], 64
            while True:
                if start + (1 << 12) > len(free):
                    grow = len(free)
                    base, value = (np.concatenate((x, np.full(grow, f, np.int32)))
                                   for x, f in ((base, 0), (value, -1)))
                    check = np.concatenate((check, np.full(grow, -1, np.int32)))
                    free = np.concatenate((free, np.ones(grow, bool)))
                if not len(rest) and low >= codes[0]:
                    first = low
                    break
                slots = start + np.flatnonzero(free[start:start + window])
                slots = slots[slots >= codes[0]]
                fits = free[slots[:, None] + rest].all(axis=1)
                if fits.any():
                    first = slots[fits.argmax()]
                    break
                start, window = start + window, 2048
            base[at] = first - codes[0]
            for c in codes:
                t = first - codes[0] + c
                free[t], check[t] = False, at
                later.append((t, node[c]))
        queue = later
    end = len(free) - free[::-1].argmin() + 258
    pad = max(0, end - len(base))
    return tuple(np.concatenate((x, np.full(pad, f, np.int32)))[:end]
                 for x, f in ((base, 0), (check, -1), (value, -1)))


class Encoder:
    """Viterbi search over the trie, with the units that were already searched."""

    def __init__(self, vocabulary):
        self.base, self.check, self.value = double_array(
            [(p.encode(), i) for i, p in vocabulary.pieces.items()])
        self.score = np.zeros(len(vocabulary.table))
        for i, s in vocabulary.scores.items():
            self.score[i] = s
        self.unknown = min(vocabulary.scores.values()) - 10
        self.byte_id = np.zeros(256, np.int32)
        for i, b in vocabulary.bytes.items():
            self.byte_id[b] = i
        self.is_byte = np.zeros(len(vocabulary.table), bool)
        self.is_byte[list(vocabulary.bytes)] = True
        self.longest = max(len(p.encode()) for p in vocabulary.pieces.values())
        own = "".join(c for c in "\n\t\r" if not any(c in p for p in vocabulary.pieces.values()))
        self.cut = re.compile(f" +[^ {own}]*|[{own}]|[^ {own}]+" if own else " +[^ ]*|[^ ]+")
        self.table = vocabulary.table
        self.forget()

    def forget(self):
        self.known, self.ids, self.starts = {}, [], []
        self.flat, self.at, self.count = np.zeros(0, np.int32), np.zeros(0, int), np.zeros(0, int)

    def _edges(self, data, ends):
        """(start, length, id, score) of all pieces in `data`; `ends`: where each byte's unit
        ends. Bytes of characters without a piece are chained."""
        first = np.flatnonzero((data & 0xC0) != 0x80)
        wide = np.diff(np.append(first, len(data)))
        at, state, found, lone = first, np.zeros(len(first), np.int64), [], np.ones(len(first),
                                                                                   bool)
        rank = np.arange(len(first))
        for depth in range(self.longest):
            inside = at + depth < ends[at]
            at, state, rank = at[inside], state[inside], rank[inside]
            step = self.base[state] + data[at + depth].astype(np.int64) + 1
            real = self.check[step] == state
            at, state, rank = at[real], step[real], rank[real]
            if not len(at):
                break
            piece = self.value[state]
            hit = piece >= 0
            found.append((at[hit], np.full(hit.sum(), depth + 1), piece[hit],
                          self.score[piece[hit]]))
            lone[rank[hit & (wide[rank] == depth + 1)]] = False
        left = np.repeat(lone, wide)
        where = np.flatnonzero(left)
        found.append((where, np.ones(len(where), int), self.byte_id[data[where]],
                      np.where((data[where] & 0xC0) != 0x80, self.unknown, 0.0)))
        return [np.concatenate(x) for x in zip(*found)]

    def _search(self, units):
        """Ids of all units, one after the other, and how many each has."""
        sizes = np.array([len(u) for u in units])
        data, starts = np.frombuffer(b"".join(units), np.uint8), np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(units)), sizes)
        at, length, piece, score = self._edges(data, (starts + sizes)[owner])
        place = np.arange(len(units))            # one more slot per unit, for its end
        begin, end = at + owner[at], at + owner[at] + length
        offset = end - (starts + place)[owner[at]]
        order = np.lexsort((-length, offset))
        begin, end, piece, score = begin[order], end[order], piece[order], score[order]
        step = (offset * (self.longest + 1) - length)[order]
        best, back = np.full(len(data) + len(units), -np.inf), np.zeros(len(data) + len(units),
                                                                        np.int64)
        best[starts + place] = 0
        bounds = np.append(np.flatnonzero(np.diff(step, prepend=-1)), len(step))
        for a, b in zip(bounds[:-1], bounds[1:]):
            score_now = best[begin[a:b]] + score[a:b]
            better = score_now > best[end[a:b]]
            to = end[a:b][better]
            best[to], back[to] = score_now[better], np.flatnonzero(better) + a
        now, going, trail = starts + place + sizes, place, []
        count = np.zeros(len(units), int)
        while len(going):
            edge = back[now]
            trail.append((going, piece[edge]))
            count[going] += 1
            now = begin[edge]
            more = now > (starts + place)[going]
            now, going = now[more], going[more]
        flat, last = np.zeros(count.sum(), np.int32), np.cumsum(count) - 1
        for k, (which, ids) in enumerate(trail):
            flat[last[which] - k] = ids
        return flat, count

    def _learn(self, new):
        units = [u.encode("utf-8", "replace") for u in new]
        short = [k for k, u in enumerate(units) if len(u) <= UNIT_LIMIT]
        parts, counts = [], np.zeros(len(units), int)
        order = short + [k for k, u in enumerate(units) if len(u) > UNIT_LIMIT]
        for k in range(0, len(short), 5_000):
            some = short[k:k + 5_000]
            flat, counts[some] = self._search([units[i] for i in some])
            parts.append(flat)
        for k in order[len(short):]:
            flat, count = self._search([units[k]])
            counts[k] = count[0]
            parts.append(flat)
        begin = np.zeros(len(units), int)
        begin[order] = len(self.flat) + np.cumsum(counts[order]) - counts[order]
        self.flat = np.concatenate((self.flat, *parts))
        self.at, self.count = np.append(self.at, begin), np.append(self.count, counts)

    def encode(self, texts):
        """Flat ids of all texts and the number of ids of each; an empty text has none."""
        if len(self.known) > CACHE:
            self.forget()
        known, codes, sizes = self.known, [], []
        old = len(known)
        for text in texts:
            units = self.cut.findall(" " + text) if text else []
            codes += [known.setdefault(u, len(known)) for u in units]
            sizes.append(len(units))
        if len(known) > old:
            self._learn(list(islice(known, old, None)))
        codes = np.array(codes, int)
        counts = self.count[codes]
        total = counts.sum()
        ids = self.flat[np.repeat(self.at[codes] - (np.cumsum(counts) - counts), counts)
                        + np.arange(total)]
        ends = np.concatenate(([0], np.cumsum(counts)))[np.cumsum(sizes, dtype=int)]
        return ids, np.diff(ends, prepend=0)

    def decode(self, ids):
        """The text of one sequence of ids."""
        return decode(self.table, ids)


def decode(table, ids):
    """Pieces and bytes joined, without the space put before the text."""
    text = b"".join([table[i] for i in ids])
    return text[text[:1] == b" ":].decode("utf-8", "replace")


def _runs(lengths, limit=CHUNK):
    """Slices that hold lengths of `limit` in sum at most, or one."""
    start = size = 0
    for k, length in enumerate(lengths):
        if k > start and size + length > limit:
            yield start, k
            start, size = k, 0
        size += length
    if start < len(lengths):
        yield start, len(lengths)


def _encoded(coder):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch in batches:
            column = batch.column("text").fill_null("")
            for a, b in _runs(pc.binary_length(column).to_pylist()):
                texts = column.slice(a, b - a).to_pylist()
                ids, counts = coder.encode(texts)
                ends = np.concatenate(([0], np.cumsum(counts)))
                fallback = np.concatenate(([0], np.cumsum(coder.is_byte[ids])))
                same = [coder.decode(ids[ends[k]:ends[k + 1]].tolist()) == text
                        for k, text in enumerate(texts)]
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(counts, pa.int64()),
                     pa.array(fallback[ends[1:]] - fallback[ends[:-1]], pa.int64()),
                     pa.array(same), lists],
                    ["doc_id", "n_tokens", "n_byte_tokens", "round_trip", "ids"])
    return run


def tokenized(docs: DataFrame, model=MODEL) -> DataFrame:
    """doc_id, ids, n_tokens, n_byte_tokens and round_trip (whether the decoded ids are the text)
    of every row.

    Null and empty texts have no ids and come back as the empty text. Repeated rows are encoded
    each. Texts are never cut short. Other columns are ignored; an empty table gives an empty
    result.
    """
    run = _encoded(Encoder(Vocabulary(model)))
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, "
             "n_byte_tokens long, round_trip boolean, ids array<int>")


def detokenized(rows: DataFrame, model=MODEL) -> DataFrame:
    """Adds `text` to rows with `ids`; null ids give a null text."""
    import pandas as pd
    table = Vocabulary(model).table

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return ids.map(lambda x: None if x is None else decode(table, x))
    return rows.withColumn("text", text("ids"))
