"""Prediction by partial matching: how probable a text is under the bytes of a training corpus.

A text is read as its tokens (words between white space, A-Z lower-cased), each followed by one space, the last by the
end byte; so its probability is one of the same events as that of a token model. A byte's probability comes from the
trie of the ``ORDER`` bytes before it, trained on all training documents: escape method C (a context seen T times with
D different bytes escapes with D / (T + D)), and bytes seen in a longer context are excluded from the shorter ones.
Below order 0 the bytes that are left are equally likely.

As the trained model does not change, the code length of a byte depends on it and its context alone. So, with text cut
into blocks of about ``BLOCK`` bytes of whole documents:

1. each block counts its distinct strings of ORDER + 1 bytes and its distinct tokens, in ``shards`` packed rows;
2. each shard adds up the counts of its strings over all blocks: the deepest level of the trie;
3. strings are regrouped by their context's last two bytes, where all contexts of order 2 and more are whole (orders 0
   and 1 are at most 65,536 numbers, added up from the blocks and broadcast), and get their log-probabilities;
4. back in the shards, each block's strings get theirs, and the block's documents are scored.

No document's text moves but once, packed, to where its block is scored. ``adaptive_code_length`` scores one text by a
model that learns from it on the way.

Defined results: a null or empty text is the end token alone; a null doc_id has remainder 0 and so is learned from; a
repeated row is learned from and scored each time; without training documents every byte is equally likely; texts of
any length are read whole (one longer than a block is a block); an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.llm.common import SPACED, keyed_texts, remainder, table, texts_of
from chronoload.session import prepare, stage

ORDER = 5
BLOCK = 16 << 20
HOLD = (7, 2)
END = 0x0A  # never inside a token
START = 0x09
_PART = 1 << 19  # bytes of text looked at together: each takes some 60 bytes of arrays meanwhile
_GRAM_BYTES = ORDER + 1


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as a compressed blob; the first, if whole numbers in ascending order, as differences."""
    out = []
    for k, a in enumerate(arrays):
        if k == 0:
            a = np.diff(a, prepend=a.dtype.type(0))
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T
        out.append(planes.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(raw) // sum(sizes), 0, []
    for k, (kind, size) in enumerate(zip(kinds, sizes, strict=True)):
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        a = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        out.append(np.cumsum(a, dtype=a.dtype) if k == 0 else a)
        at += n * size
    return out


def normal(text: bytes | None) -> bytes:
    """The tokens, each followed by a space, the last by the end byte."""
    words = text.translate(SPACED).split() if text else []
    return b" ".join(words) + bytes((END,))


def grams(data: bytes) -> np.ndarray:
    """For each byte of whole normal texts: its ORDER bytes before and itself as one number; texts do not see others."""
    raw = np.frombuffer(data, np.uint8)
    padded = np.concatenate([np.full(8, START, np.uint8), raw])
    code = np.ndarray(len(raw), ">u8", padded.tobytes(), 1, (1,)).astype(np.uint64) if len(raw) else np.empty(0, np.uint64)
    code &= np.uint64((1 << (8 * _GRAM_BYTES)) - 1)
    ends = np.flatnonzero(raw == END)
    for back in range(1, ORDER + 1):  # places that still see the text before: overwrite what belongs to it
        at = ends + back
        at = at[at < len(raw)]
        keep = back  # bytes of the own text in the number, itself included
        own = code[at] & np.uint64((1 << (8 * keep)) - 1)
        fill = 0
        for k in range(keep, _GRAM_BYTES):
            fill |= START << (8 * k)
        # a text of fewer bytes than `back` ends in between: its followers were set by a later, nearer end
        nearer = np.zeros(len(at), bool)
        for d in range(1, back):
            nearer |= raw[at - d] == END
        code[at[~nearer]] = (own | np.uint64(fill))[~nearer]
    return code


def _stretches(texts: Iterable[bytes]) -> Iterator[tuple[int, list[int], np.ndarray]]:
    """``grams`` of normal texts, ``_PART`` bytes at most at a time: (place of the first text, the texts' lengths, codes).
    A longer text comes alone, in pieces that see the bytes before them."""
    held: list[bytes] = []
    size = first = 0
    for k, t in enumerate(texts):
        if held and size + len(t) > _PART:
            yield first, [len(x) for x in held], grams(b"".join(held))
            held, size = [], 0
        if len(t) > _PART:
            for at in range(0, len(t), _PART):
                back = min(at, ORDER)
                codes = grams(t[at - back : at + _PART])[back:]
                yield k, [len(codes)], codes
            continue
        if not held:
            first = k
        held.append(t)
        size += len(t)
    if held:
        yield first, [len(x) for x in held], grams(b"".join(held))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return _counted(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))


def _counted(codes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is None:
        codes = np.sort(codes)
        head = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
        return codes[head], np.diff(np.append(head, len(codes)))
    order = np.argsort(codes, kind="stable")
    codes, weights = codes[order], weights[order]
    head = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[head], np.add.reduceat(weights, head) if len(head) else weights


def _shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    mixed = codes * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


class _Block:
    """Documents on their way into one block."""

    def __init__(self, name: str) -> None:
        self.name, self.size = name, 0
        self.ids: list = []
        self.held: list = []
        self.texts: list[bytes] = []

    def add(self, doc_id, held: bool, text: bytes) -> None:
        self.ids.append(doc_id)
        self.held.append(held)
        self.texts.append(text)
        self.size += len(text)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """All strings of the block with their counts in training texts (0: only in others)."""
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for train in (True, False):
            for _, _, codes in _stretches(t for t, h in zip(self.texts, self.held, strict=True) if h != train):
                c, n = _counted(codes)
                parts.append((c, n * train))
                waiting += len(c)
                if waiting > 300_000:
                    parts, waiting = [_merged(parts)], 0
        return _merged(parts)

    def tokens(self) -> tuple[list[bytes], list[int]]:
        """Distinct tokens with their counts in training texts; the end token is the empty one."""
        train: Counter = Counter()
        rest: set = set()
        for t, h in zip(self.texts, self.held, strict=True):
            words = t.split()
            if h:
                rest.update(words)
            else:
                train.update(words)
        train[b""] = len(self.held) - sum(self.held)
        for w in rest:
            train.setdefault(w, 0)
        names = sorted(train)
        return names, [train[w] for w in names]

    def rows(self, shards: int):
        """(block, kind, shard, data, more) rows: the texts, the pair counts, and packed counts by shard."""
        press = zstandard.ZstdCompressor(level=3)
        ids = pa.array(self.ids, pa.int64())
        index = pa.RecordBatch.from_arrays(
            [ids, pa.array(self.held, pa.bool_()), pa.array([len(t) for t in self.texts], pa.int64())],
            names=["doc_id", "held_out", "size"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, index.schema) as out:
            out.write_batch(index)
        yield self.name, "text", -1, press.compress(b"".join(self.texts)), sink.getvalue().to_pybytes()
        codes, counts = self.distinct()
        pairs, n = _counted(codes & np.uint64(0xFFFF), counts)
        yield self.name, "pair", -1, _pack(pairs, n), b""
        shard = _shard_of(codes, shards)
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(shards + 1))
        for k in range(shards):
            own = order[edges[k] : edges[k + 1]]
            if len(own):
                yield self.name, "gram", k, _pack(codes[own], counts[own].astype(np.uint32)), b""
        names, number = self.tokens()
        by: list[list[int]] = [[] for _ in range(shards)]
        for i, w in enumerate(names):
            by[zlib.crc32(w) % shards].append(i)
        for k, own in enumerate(by):
            if own:
                yield (self.name, "token", k, press.compress(b"\n".join([names[i] for i in own])),
                       np.array([number[i] for i in own], "<u8").tobytes())


_ROWS = "block string, kind string, shard int, data binary, more binary"


def _blocks(docs: DataFrame, hold: tuple[int, int], shards: int, block: int) -> DataFrame:
    def cut(batches):
        part, number = TaskContext.get().partitionId(), 0
        now = _Block(f"{part}-0")

        def out(done):
            columns: list[list] = [[], [], [], [], []]
            size = 0
            for row in done.rows(shards):
                for c, v in zip(columns, row, strict=True):
                    c.append(v)
                size += len(row[3]) + len(row[4])
                if size > 4 << 20:
                    yield _batch(columns)
                    columns, size = [[], [], [], [], []], 0
            if columns[0]:
                yield _batch(columns)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # few texts are copied at once
                some = batch.slice(at, 256)
                ids, held, texts = some.column(0).to_pylist(), some.column(1).to_pylist(), texts_of(some)
                for i, h, t in zip(ids, held, texts, strict=True):
                    now.add(i, h, normal(t))
                    if now.size >= block:
                        yield from out(now)
                        number += 1
                        now = _Block(f"{part}-{number}")
        if now.ids:
            yield from out(now)

    def _batch(columns):
        kinds = (pa.string(), pa.string(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                          names=["block", "kind", "shard", "data", "more"])

    rows = keyed_texts(docs).select(
        "doc_id", (remainder(F.col("doc_id"), hold[0]) == hold[1]).alias("held_out"), "text")
    return rows.mapInArrow(cut, _ROWS)


def _add_grams(pdf: pd.DataFrame) -> pd.DataFrame:
    """A shard's strings with their counts over all blocks, regrouped by the last two bytes of the context."""
    codes, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    for blob in pdf["data"]:
        c, n = _unpack(blob, "<u8", "<u4")
        codes, counts = np.concatenate([codes, c]), np.concatenate([counts, n.astype(np.int64)])
        if len(codes) > 4_000_000:
            codes, counts = _counted(codes, counts)
    codes, counts = _counted(codes, counts)
    context = ((codes >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int64)
    order = np.argsort(context, kind="stable")
    names, edges = np.unique(context[order], return_index=True)
    edges = np.append(edges, len(order))
    shard = int(pdf["shard"].iloc[0])
    return pd.DataFrame({
        "context": names, "shard": shard,
        "data": [_pack(codes[order[a:b]], counts[order[a:b]]) for a, b in zip(edges[:-1], edges[1:], strict=True)]})


class Low:
    """Orders 0 and 1: counts of bytes and of byte pairs, and the bytes' log-probabilities after exclusion."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.pair = np.zeros((256, 256), np.int64)
        self.pair[(codes >> np.uint64(8)).astype(np.int64), (codes & np.uint64(255)).astype(np.int64)] = counts
        self.one = self.pair.sum(0)


def _level(codes: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the strings' last ``order`` + 1 bytes."""
    return _counted(codes & np.uint64((1 << (8 * (order + 1))) - 1), counts)


def log_probabilities(codes: np.ndarray, counts: np.ndarray, low: Low, order: int = ORDER) -> np.ndarray:
    """log10 of each string's last byte after the bytes before it. ``codes`` ascend and hold all strings of the contexts
    of order 2 that occur in them; ``counts`` are those of training."""
    n = len(codes)
    done = np.zeros(n, bool)
    total = np.zeros(n)
    above_mass = np.zeros(n)  # of the context one order lower: what bytes seen in the longer context count there
    above_kinds = np.zeros(n, np.int64)
    symbol = (codes & np.uint64(255)).astype(np.int64)
    levels = {k: _level(codes, counts, k) for k in range(order, 1, -1)}
    for k in range(order, -2, -1):
        if k == -1:
            left = 256 - above_kinds
            total[~done] -= np.log10(left[~done])
            break
        mask = np.uint64((1 << (8 * (k + 1))) - 1)
        if k >= 2:
            own, number = levels[k]
            seen = number > 0
            keys, kn = own[seen], number[seen]
            context = keys >> np.uint64(8)
            names, first = np.unique(context, return_index=True)
            t = np.add.reduceat(kn, first) if len(first) else np.empty(0, np.int64)
            d = np.diff(np.append(first, len(keys)))
            here = (codes & mask) >> np.uint64(8)
            at = np.minimum(np.searchsorted(names, here), max(len(names) - 1, 0))
            hit = (names[at] == here) if len(names) else np.zeros(n, bool)
            t_all, d_all = (np.where(hit, t[at], 0), np.where(hit, d[at], 0)) if len(names) else (np.zeros(n), np.zeros(n, np.int64))
            place = np.searchsorted(own, codes & mask)
            c = number[place]
            below = _below(keys, levels, low, k)
            b = np.add.reduceat(below, first) if len(first) else np.empty(0, np.int64)
            b_all = np.where(hit, b[at], 0) if len(names) else np.zeros(n)
        elif k == 1:
            prev = ((codes >> np.uint64(8)) & np.uint64(255)).astype(np.int64)
            t1, d1 = low.pair.sum(1), (low.pair > 0).sum(1)
            t_all, d_all, c = t1[prev], d1[prev], low.pair[prev, symbol]
            b_all = ((low.pair > 0) * low.one[None, :]).sum(1)[prev]
        else:
            t_all, d_all, c = np.full(n, low.one.sum()), np.full(n, (low.one > 0).sum()), low.one[symbol]
            b_all = np.zeros(n)
        # what the longer context has excluded here
        t_left, d_left = t_all - above_mass, d_all - above_kinds
        usable = ~done & (d_left > 0)
        norm = (t_left + d_left).astype(np.float64)
        hit_now = usable & (c > 0)
        total[hit_now] += np.log10(c[hit_now] / norm[hit_now])
        escape = usable & ~hit_now
        total[escape] += np.log10(d_left[escape] / norm[escape])
        done |= hit_now
        # a context that was never seen excludes nothing; else all bytes seen in it, which include the longer one's
        above_mass, above_kinds = np.asarray(b_all, np.float64), np.asarray(d_all, np.int64)
    return total


def _below(keys: np.ndarray, levels: dict, low: Low, k: int) -> np.ndarray:
    """Counts, one order lower, of the strings ``keys`` of order ``k`` without their first byte."""
    short = keys & np.uint64((1 << (8 * k)) - 1)
    if k > 2:
        own, number = levels[k - 1]
        return number[np.searchsorted(own, short)]
    return low.pair[(short >> np.uint64(8)).astype(np.int64), (short & np.uint64(255)).astype(np.int64)]


def _finder(codes: np.ndarray):
    """Places of numbers in the ascending array ``codes``, by a hash table with linear steps."""
    bits = max(4, int(np.ceil(np.log2(max(len(codes), 1)))) + 1)
    mask = np.int64((1 << bits) - 1)
    slot = np.full(1 << bits, -1, np.int32)

    def start(c):
        return ((c * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    todo, at = np.arange(len(codes), dtype=np.int32), start(codes)
    while len(todo):
        free = slot[at] < 0
        slot[at[free]] = todo[free]
        lost = slot[at] != todo
        todo, at = todo[lost], (at[lost] + 1) & mask

    def find(c: np.ndarray) -> np.ndarray:
        out = np.empty(len(c), np.int32)
        rest, at = np.arange(len(c)), start(c)
        while len(rest):
            got = slot[at]
            good = codes[got] == c[rest]
            out[rest[good]] = got[good]
            rest, at = rest[~good], (at[~good] + 1) & mask
        return out

    return find


def score(docs: DataFrame, hold: tuple[int, int] = HOLD, block: int = BLOCK) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: a row per document."""
    spark = prepare(docs.sparkSession)
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = stage(_blocks(docs, hold, shards, block), "ppm-blocks")

    def pairs(batches):
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                code, n = _unpack(blob, "<u8", "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int32)), pa.array(n)], names=["code", "n"])

    pair = rows.where("kind = 'pair'").select("data").mapInArrow(pairs, "code int, n long")
    pair = pair.groupBy("code").agg(F.sum("n").alias("n")).toArrow()  # 65,536 rows at most
    low = spark.sparkContext.broadcast(Low(pair["code"].to_numpy().astype(np.uint64), pair["n"].to_numpy()))

    def model(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(b, "<u8", "<i8") for b in pdf["data"]]
        codes = np.concatenate([p[0] for p in parts])
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        value = np.empty(len(codes))
        value[order] = log_probabilities(codes, np.concatenate([p[1] for p in parts])[order], low.value)
        edges = np.cumsum([0] + [len(p[0]) for p in parts])
        return pd.DataFrame({"shard": pdf["shard"].to_numpy(), "data": [
            _pack(p[0], value[a:b].astype("<f8")) for p, a, b in zip(parts, edges[:-1], edges[1:], strict=True)]})

    gram = rows.where("kind = 'gram'").select("block", "shard", "data")
    deep = gram.select("shard", "data").groupBy("shard").applyInPandas(_add_grams, "context int, shard int, data binary")
    known = stage(deep.groupBy("context").applyInPandas(model, "shard int, data binary"), "ppm-model")

    def answer(asked: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        parts = [_unpack(b, "<u8", "<f8") for b in told["data"]]
        if not parts or not len(asked):
            return pd.DataFrame({"block": [], "kind": [], "data": [], "more": []})
        codes = np.concatenate([p[0] for p in parts])
        order = np.argsort(codes, kind="stable")
        codes, value = codes[order], np.concatenate([p[1] for p in parts])[order]
        out = []
        for blob in asked["data"]:
            own = _unpack(blob, "<u8", "<u4")[0]
            out.append(_pack(own, value[np.searchsorted(codes, own)].astype("<f8")))
        return pd.DataFrame({"block": asked["block"], "kind": "gram", "data": out, "more": b""})

    answers = gram.groupBy("shard").cogroup(known.groupBy("shard")).applyInPandas(
        answer, "block string, kind string, data binary, more binary")

    def add_tokens(pdf: pd.DataFrame) -> pd.DataFrame:
        unpress = zstandard.ZstdDecompressor()
        total: dict[bytes, int] = {}
        for names, number in zip(pdf["data"], pdf["more"], strict=True):
            for w, n in zip(unpress.decompress(names).split(b"\n"), np.frombuffer(number, "<u8").tolist(), strict=True):
                total[w] = total.get(w, 0) + n
        answers = [np.array([total[w] for w in unpress.decompress(names).split(b"\n")], "<u8").tobytes()
                   for names in pdf["data"]]
        here = np.fromiter(total.values(), np.int64, len(total))
        scalar = pd.DataFrame({"block": [None], "kind": ["sum"], "data": [None], "more": [None],
                               "n": [int(here.sum())], "v": [int((here > 0).sum())]})
        out = pd.DataFrame({"block": pdf["block"], "kind": "token", "data": pdf["data"], "more": answers,
                            "n": None, "v": None})
        return pd.concat([out.astype(object), scalar.astype(object)], ignore_index=True)

    tokens = stage(rows.where("kind = 'token'").select("block", "shard", "data", "more").groupBy("shard").applyInPandas(
        add_tokens, "block string, kind string, data binary, more binary, n long, v long"), "ppm-tokens")
    n_train, kinds = tokens.where("kind = 'sum'").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    columns = ["block", "kind", "data", "more"]
    every = rows.where("kind = 'text'").select(columns).unionByName(answers).unionByName(
        tokens.where("kind = 'token'").select(columns))

    def judge(rows: pa.Table) -> pa.Table:
        kind = np.array(rows.column("kind").to_pylist())
        unpress = zstandard.ZstdDecompressor()

        def blobs(of: str):
            for i in np.flatnonzero(kind == of).tolist():  # one row's bytes at a time
                yield rows.column("data")[i].as_py(), rows.column("more")[i].as_py()

        ((packed, sizes),) = blobs("text")
        index = pa.ipc.open_stream(sizes).read_all()
        data = unpress.decompress(packed)
        size = index["size"].to_numpy()
        ends = np.cumsum(size)
        del packed, sizes

        def texts():
            for n, end in zip(size.tolist(), ends.tolist(), strict=True):
                yield data[end - n : end]

        codes, value = [], []
        for blob, _ in blobs("gram"):
            own = _unpack(blob, "<u8", "<f8")
            codes.append(own[0])
            value.append(own[1])
        codes, value = np.concatenate(codes), np.concatenate(value)
        find = _finder(codes)
        model_score = np.zeros(len(size))
        for first, lengths, here in _stretches(texts()):
            starts = np.cumsum([0, *lengths[:-1]])
            model_score[first : first + len(lengths)] += np.add.reduceat(value[find(here)], starts)
        del codes, value, find, here
        # one look-up a token; its logarithm and whether training holds it are arrays
        place: dict[bytes, int] = {}
        log, known = [], []
        for names, number in blobs("token"):
            counts = np.frombuffer(number, "<u8")
            place.update(zip(unpress.decompress(names).split(b"\n"), range(len(place), len(place) + len(counts)), strict=True))
            log.append(np.fromiter((math.log10(c + 1) for c in counts.tolist()), np.float64, len(counts)))
            known.append(counts > 0)
        log, known = np.concatenate(log), np.concatenate(known)
        norm = math.log10(n_train + kinds + 1)
        end_known, end_log = int(known[place[b""]]), float(log[place[b""]])
        n_tokens, n_known, base = [], [], []
        for text in texts():
            words = text.split()
            n_tokens.append(len(words) + 1)
            at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            n_known.append(int(known[at].sum()) + end_known)
            base.append(math.fsum(log[at].tolist()) + end_log - (len(words) + 1) * norm)
        return pa.table({
            "doc_id": index["doc_id"], "held_out": index["held_out"], "n_tokens": pa.array(n_tokens, pa.int64()),
            "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array([int(n_train)] * len(size), pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(model_score)})

    return every.groupBy("block").applyInArrow(
        judge, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double,"
               " score double")


def adaptive_code_length(text: bytes | None, order: int = ORDER) -> float:
    """log10 probability of one text under a model that starts empty and learns each byte after coding it."""
    data = bytes((START,)) * order + normal(text)
    trie: dict[bytes, dict[int, int]] = {}
    total = 0.0
    for i in range(order, len(data)):
        byte, out = data[i], set()
        for k in range(order, -1, -1):
            own = {b: n for b, n in trie.get(data[i - k : i] if k else b"", {}).items() if b not in out}
            if not own:
                continue
            t, d = sum(own.values()), len(own)
            if byte in own:
                total += math.log10(own[byte] / (t + d))
                break
            total += math.log10(d / (t + d))
            out |= own.keys()
        else:
            total -= math.log10(256 - len(out))
        for k in range(order + 1):
            own = trie.setdefault(data[i - k : i] if k else b"", {})
            own[byte] = own.get(byte, 0) + 1
    return total


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
