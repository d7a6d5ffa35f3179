"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding by a UTF-8 state machine.

A token sequence is what the merges give if and only if each neighbouring pair of tokens is what the merges give for
the pair's bytes. So for each place of a text one token is the last token of the encoding up to there. The
transducer guesses at every place that a token begins; a state of ``Transducer`` is the set of the tokens that may be
under way, made with its transitions the first time it is needed. A state knows the tokens that may end in it; the
one that fits the token before it is kept in a register of the place. A token is emitted once the registers of all
places where a token under way may have begun lead back to it. Such places lie at most the longest token's length
back. There are never more states than the tokens have prefixes, so memory is bounded by the vocabulary.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated rows are encoded each; texts of any
length are read whole; an empty table gives an empty result; other columns are carried by ``encode_documents`` unless
they bear the name of one of its own columns, which then takes their place.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.llm.common import Cache, keyed_texts, table, uncollected
from chronoload.session import prepare

MEMO = 400_000
#: Pairs of tokens whose fit is remembered.
FITS = 600_000
#: Bytes of a piece between two emissions.
STRIDE = 1024


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    """Bytes in, token ids out: a state and a byte give the next state and the tokens that may end in it.

    A state is the tuple of the trie nodes that a token under way may have reached, longest first. ``next`` maps
    ``state << 8 | byte`` to a state, ``ending`` a state to the ``(length, token)`` that may end in it.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.joined: dict[tuple[int, int], int] = {}  # pair of tokens -> the token they merge into
        self.halves: dict[int, tuple[int, int]] = {}  # token -> the pair its last merge joined
        for token, i in ranks.items():
            if len(token) > 1:
                pair = self._merge(token, stop=2)
                if len(pair) == 2 and ranks.get(token) == i:
                    self.halves[i] = pair
        self.size = {ranks[t]: 1 for t in ranks if len(t) == 1}  # the tokens that merges lead to
        for i, pair in self.halves.items():
            self.joined[pair] = i
        self.size.update((i, len(token)) for token, i in ranks.items() if i in self.halves)
        self.longest = max(self.size.values())
        self.child: list[dict[int, int]] = [{}]  # trie of the tokens' bytes
        self.ends: list[tuple[int, int] | None] = [None]
        for token, i in ranks.items():
            if i not in self.size:
                continue
            node = 0
            for byte in token:
                to = self.child[node].get(byte)
                if to is None:
                    to = self.child[node][byte] = len(self.child)
                    self.child.append({})
                    self.ends.append(None)
                node = to
            self.ends[node] = (len(token), i)
        self.fits: dict[int, bool] = {}
        self.states: list[tuple[int, ...]] = [(0,)]
        self.number = {(0,): 0}
        self.next: dict[int, int] = {}
        self.ending: list[tuple[tuple[int, int], ...]] = [()]

    def _merge(self, piece: bytes, stop: int = 1) -> tuple[int, ...]:
        """The merges applied one by one, lowest rank first, until ``stop`` parts are left or none applies."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > stop:
            best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def _pair(self, left: int, right: int) -> bool:
        """Do the merges of both tokens' bytes leave a cut between them? Undoes the later merge of the two, again and
        again: a merge across the cut that comes before the one undone would have been made first."""
        bound = 1 << 60
        while True:
            across = self.joined.get((left, right))
            if across is not None and across < bound:
                return False
            a, b = self.halves.get(left), self.halves.get(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and left > right:
                bound, left = left, a[1]  # of equal ranks the left one is made first
            else:
                bound, right = right + 1, b[0]

    def _move(self, state: int, byte: int) -> int:
        """Makes a transition: every token under way goes on with the byte or falls out, and a new one may begin."""
        child = self.child
        own = (*[to for n in self.states[state] if (to := child[n].get(byte)) is not None], 0)
        number = self.number.get(own)
        if number is None:
            number = self.number[own] = len(self.states)
            self.states.append(own)
            self.ending.append(tuple([e for n in own if (e := self.ends[n]) is not None]))
        self.next[state << 8 | byte] = number
        return number

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.fits) > FITS:
            self.fits.clear()
        out: list[int] = []
        state, last = 0, [-1]  # last[j]: the last token of the encoding up to place j
        for start in range(0, len(piece), STRIDE):
            state = self._read(state, piece[start : start + STRIDE], last)
            if start + STRIDE < len(piece):
                out += self._emit(last)
        return out + self._back(last, len(last) - 1)

    def _read(self, state: int, part: bytes, last: list[int]) -> int:
        moves, ending, fits = self.next, self.ending, self.fits
        at = len(last)
        for byte in part:
            to = moves.get(state << 8 | byte)
            state = self._move(state, byte) if to is None else to
            for length, token in ending[state]:
                before = last[at - length]
                if before < 0:
                    break
                key = before << 24 | token
                good = fits.get(key)
                if good is None:
                    good = fits[key] = self._pair(before, token)
                if good:
                    break
            last.append(token)
            at += 1
        return state

    def _back(self, last: list[int], at: int) -> list[int]:
        """The tokens up to a place, read off the registers from its end."""
        out, size = [], self.size
        while at > 0:
            token = last[at]
            out.append(token)
            at -= size[token]
        out.reverse()
        return out

    def _emit(self, last: list[int]) -> list[int]:
        """The tokens that all places where a token may begin agree on; their registers are then given up.

        The last place stands for the first token after them: ``last[0]`` is what the next pair is tested against.
        """
        end, size = len(last) - 1, self.size
        ways = set(range(max(0, end - self.longest), end + 1))
        while len(ways) > 1:
            far = max(ways)
            ways.remove(far)
            ways.add(far - size[last[far]])
        sure = ways.pop()
        if sure <= 0:
            return []
        out = self._back(last, sure)
        del last[:sure]
        return out


#: Bytes that can follow a lead byte of UTF-8: classes 00-7F, 80-BF, C2-DF, E0-EF, F0-F4 and the rest.
_WIDTH = [1] * 128 + [0] * 64 + [-1] * 2 + [2] * 30 + [3] * 16 + [4] * 5 + [-1] * 11


class Utf8Stream:
    """Text out of byte chunks that may cut characters: holds back the bytes of a character that is not yet whole."""

    def __init__(self) -> None:
        self.held = b""

    def feed(self, chunk: bytes) -> str:
        data = self.held + chunk
        cut = len(data)
        for back in range(1, min(4, cut) + 1):
            width = _WIDTH[data[-back]]
            if width:
                cut = len(data) - back if width > back else cut
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Codec:
    """The pieces of a text by ``pattern``, each through the transducer. Ids are little-endian unsigned 32-bit."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO) -> None:
        self.machine = Transducer(ranks)
        self.pieces = regex.compile(pattern).findall
        # A space between two characters that are no white space always begins a piece.
        self.gap = regex.compile(r"(?<=\S) (?=\S)")
        self.tight = regex.compile(r"[\s\x1c-\x1f](?:[\s\x1c-\x1f]|\Z)|\A\s")
        self.first = Cache(self._chunk, 10_000)
        self.memo = Cache(lambda chunk: self._chunk(" " + chunk), memo)
        self.token = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.token[i] = t

    def _chunk(self, chunk: str) -> bytes:
        out: list[int] = []
        for piece in self.pieces(chunk):
            out += self.machine.encode(piece.encode())
        return array("I", out).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.tight.search(text):
            first, *rest = self.gap.split(text)
        else:
            first, *rest = text.split(" ")
        if len(text) > 4_000_000:  # one chunk may be the whole text: keep it out of the memo
            return self._chunk(first) + b"".join([self._chunk(" " + c) for c in rest])
        return self.first[first] + b"".join(map(self.memo.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as it becomes certain, token by token."""
        state = Utf8Stream()
        for i in ids:
            yield state.feed(self.token[i])
        yield state.close()


@lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


def shipped(spark: SparkSession, path: str) -> str:
    """Send a vocabulary file to the tasks; its name there."""
    prepare(spark)
    spark.sparkContext.addFile(path)
    return path.replace("\\", "/").rpartition("/")[2]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with ``n_tokens`` (long), ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` (binary)."""
    name = shipped(docs.sparkSession, ranks_path)
    own = ("n_tokens", "ids", "decoded")
    base = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in own])

    def encode(batches):
        codec = _codec(SparkFiles.get(name), pattern)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            for a in range(0, len(batch), 512):
                with uncollected():
                    ids = [codec.encode(t) for t in text[a : a + 512].to_pylist()]
                part = batch.slice(a, 512)
                arrays = [*part.columns, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                          pa.array([codec.decode(x) for x in ids], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, *own])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    return base.mapInArrow(encode, f"{schema}, n_tokens long, ids binary, decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256``; ids and texts stay in the task."""
    name = shipped(docs.sparkSession, ranks_path)
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()),
    ])

    def digest(batches):
        codec = _codec(SparkFiles.get(name), pattern)
        for batch in batches:
            n, ids_hash, text_hash = [], [], []
            texts = batch.column(1)
            for a in range(0, len(batch), 512):
                with uncollected():
                    coded = [codec.encode(t) for t in texts[a : a + 512].to_pylist()]
                    n += [len(ids) // 4 for ids in coded]
                    ids_hash += [hashlib.sha256(ids).hexdigest() for ids in coded]
                    text_hash += [hashlib.sha256(codec.decode(ids)).hexdigest() for ids in coded]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(text_hash)], schema=schema
            )

    return keyed_texts(docs).mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def decoded_text(encoded: DataFrame) -> DataFrame:
    """``encoded`` with ``text`` read back from ``decoded``."""
    return encoded.withColumn("text", F.col("decoded").cast("string"))
