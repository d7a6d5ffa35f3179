"""Alignment of two tokenizers: where both end a token, the id lists are cut into groups; links join overlapping tokens.

Texts are cut into words (a space between two characters that are no white space begins one): neither tokenizer has a token
across such a place, so a document is the chain of its words. A block of documents (``BLOCK`` bytes, or one longer text)
encodes and aligns each distinct word once, all of them in a row: cumulative byte ends of A and of B go into dictionaries from
end to index, the key sets are intersected, and the sorted common ends slice both id lists into groups; within a slice each
stretch between neighbouring ends of either side links one token of A with one of B. A word that does not decode to its own
bytes sends its documents through the same steps as one piece.

How often an id pair is linked is a sum over the corpus. A block writes one row with its documents (which words, in order)
and one row per distinct pair with its count; pairs are added up by key, each block gets the sums of its own pairs back as
one row, and joins its documents again by block number. A pair is one row a block and not one a document, so the most
frequent pair is no hot key; no table of pairs is broadcast or collected, and a group of rows is at most one block.

Defined results: null and empty texts, and texts that either tokenizer does not give back, have no tokens: zeros and ''. Ids
may be null or repeat; each row gives a row. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import defaultdict
from collections.abc import Sequence
from itertools import chain, count, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoload.llm.bpe import shipped
from chronoload.llm.common import keyed_texts, table, uncollected
from chronoload.session import stage

BLOCK = 1 << 20
WORDS_AT_ONCE = 1 << 15
_NONE = np.empty(0, np.int32)
SPACE = "▁"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r" \s|[^\S ] ")  # a space beside other white space, or at an end
_BEYOND = re.compile("[^\x00-\xff]")
#: The byte-level pattern of pre-tokens, a fixed value.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PAIR = 32  # a pair of ids as one number: A above, B below

_BLOCK_SCHEMA = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, size array<int>, words binary, link_sizes binary, links binary, pairs binary, pair_n binary"
)


def _byte_of_letter() -> dict[str, int]:
    """Byte-level letters: printable bytes stand for themselves, the others for the letters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def merges_by_rank(path: str) -> bool:
    """May the lowest id decide which pair of a byte-level BPE merges next?

    So it is if, for each merge, the joined token alone falls into just that pair once all lower ids have merged: where a
    token's ends are still borders of tokens, nothing has merged across them, so it looks inside as it does alone.
    """
    with open(path, encoding="utf-8") as file:
        own = json.load(file)
    letters, model, pre = _byte_of_letter(), own["model"], own["pre_tokenizer"]
    plain = own["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
    if not plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return False
    rank = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if {x for x in rank if len(x) > 1} - {x["content"] for x in own["added_tokens"]} != {a + b for a, b in merges}:
        return False
    last = -1
    for pair in merges:
        token, parts = "".join(pair), list("".join(pair))
        if rank[token] <= last or not set(parts) <= letters.keys():
            return False
        last = rank[token]
        while len(parts) > 2:
            least, at = min((rank.get(x + y, last), k) for k, (x, y) in enumerate(pairwise(parts)))
            if least >= last:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if tuple(parts) != pair:
            return False
    return True


class Codecs:
    """Both tokenizers: ids of words, and the bytes of an id."""

    def __init__(self, a_path: str, b_path: str, by_rank: bool) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_of_letter()
        a_bytes = {k: bytes(letters[c] for c in entry) for entry, k in self.a.get_vocab(with_added_tokens=False).items()}
        b_bytes = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace(SPACE, " ").encode())
        self.bytes = ([a_bytes.get(k, b"") for k in range(max(a_bytes) + 1)], b_bytes)
        ranks = {x: k for k, x in a_bytes.items()}
        self.ranked = tiktoken.Encoding("a", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={}) if by_rank else None
        self.size = [np.array([len(x) for x in side], np.int64) for side in self.bytes]
        # an id as text, behind it what stands between two tokens and what ends the tokens of a group
        self.text = [
            np.array([[f"{k}," for k in range(len(side))], [f"{k}{end}" for k in range(len(side))]], object)
            for side, end in zip(self.bytes, "|;")
        ]

    def stream(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids by A of a space and each word, and by B of each word, which adds the space itself; all in a row.

        A cuts before the space of a word whatever stands before it, so it may read many words as one text.
        """
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for c in range(0, len(words), 4096):
            part = words[c : c + 4096]
            text = " " + " ".join(part)
            if self.ranked and not _BEYOND.search(text):
                ids = self.ranked.encode_ordinary(text)
            else:
                ids = self.a.encode(text, add_special_tokens=False).ids
            a.append(np.array(ids, np.int64))
            b.append(np.fromiter(chain.from_iterable(self.b.encode(part, num_threads=1)), np.int64))
        return np.concatenate(a), np.concatenate(b)

    def gives_back(self, ids: tuple[np.ndarray, np.ndarray], text: bytes) -> bool:
        return all(b"".join([own[i] for i in side.tolist()]) == text for own, side in zip(self.bytes, ids))


class Aligned:
    """Distinct words (or whole texts) of a block, aligned: token counts, groups as text and linked pairs of each."""

    def __init__(self, words: Sequence[str], ids: tuple[np.ndarray, np.ndarray], codecs: Codecs) -> None:
        """``ids``: what both tokenizers give for the words in a row; both must give back the words' bytes."""
        word_end = np.cumsum([len(w.encode()) + 1 for w in words], dtype=np.int64)
        a_end, b_end = (np.cumsum(size[side]) for size, side in zip(codecs.size, ids))
        a_at = dict(zip(a_end.tolist(), range(len(a_end))))
        b_at = dict(zip(b_end.tolist(), range(len(b_end))))
        common = np.array(sorted(a_at.keys() & b_at.keys()), np.int64)
        # slices: group k holds the tokens that end behind common end k - 1 and not behind end k
        a_cut = np.array([a_at[e] for e in common.tolist()], np.int64) + 1
        b_cut = np.array([b_at[e] for e in common.tolist()], np.int64) + 1
        a_group, b_group = (np.repeat(np.arange(len(common)), np.diff(cut, prepend=0)) for cut in (a_cut, b_cut))
        # links: within a slice, each stretch up to the next end of either side lies in one token of A and one of B
        ends = np.union1d(a_end, b_end)
        a_link, b_link = ids[0][np.searchsorted(a_end, ends)], ids[1][np.searchsorted(b_end, ends)]
        self.pairs = a_link << _PAIR | b_link
        word = [np.searchsorted(word_end, x) for x in (a_end, b_end, common, ends)]
        self.counts = np.stack([np.bincount(w, minlength=len(words)) for w in word], 1)
        # text of the groups: tokens by group, those of A first, each with what follows it
        last = [np.zeros(len(x), np.int64) for x in ids]
        last[0][a_cut - 1] = last[1][b_cut - 1] = 1
        shown = np.concatenate([text[end, side] for text, end, side in zip(codecs.text, last, ids)])
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        shown, at = shown[order].tolist(), 0
        self.groups = []
        for n in (self.counts[:, 0] + self.counts[:, 1]).tolist():
            self.groups.append("".join(shown[at : at + n]))
            at += n


def aligned_words(words: Sequence[str], codecs: Codecs) -> tuple[Aligned, set[int]]:
    """The words aligned, and the numbers of those that a tokenizer does not give back (aligned as nothing)."""
    ids = codecs.stream(words)
    if codecs.gives_back(ids, "".join([" " + w for w in words]).encode()):
        return Aligned(words, ids, codecs), set()
    alone = [codecs.stream([w]) for w in words]
    bad = {k for k, w in enumerate(words) if not codecs.gives_back(alone[k], f" {w}".encode())}
    good = [k for k in range(len(words)) if k not in bad]
    empty = [np.empty(0, np.int64)]
    ids = tuple(np.concatenate(empty + [alone[k][side] for k in good]) for side in (0, 1))
    some = Aligned([words[k] for k in good], ids, codecs)
    counts, groups = np.zeros((len(words), 4), np.int64), [""] * len(words)
    counts[good] = some.counts
    for k, own in zip(good, some.groups):
        groups[k] = own
    some.counts, some.groups = counts, groups
    return some, bad


def _cut(text: str) -> list[str]:
    return _CUT.split(text) if _ODD.search(f" {text} ") else text.split(" ")


def _documents(texts: Sequence[str | None], codecs: Codecs) -> tuple[np.ndarray, list[str], np.ndarray, list[np.ndarray]]:
    """Counts, groups and linked pairs of a block's distinct words, and the numbers of each document's words in order."""
    number = defaultdict(count().__next__)
    chains = [np.fromiter(map(number.__getitem__, _cut(t)), np.int32) if t else _NONE for t in texts]
    words = list(number)
    bad, counts, groups, pairs = set(), [np.zeros((0, 4), np.int64)], [], [np.empty(0, np.int64)]
    for c in range(0, len(words), WORDS_AT_ONCE):
        own, lost = aligned_words(words[c : c + WORDS_AT_ONCE], codecs)
        bad |= {c + k for k in lost}
        counts.append(own.counts)
        groups += own.groups
        pairs.append(own.pairs)
    torn = [d for d, own in enumerate(chains) if bad and not bad.isdisjoint(own.tolist())]
    for d in torn:  # the same steps on the whole text
        whole, lost = aligned_words([texts[d]], codecs)
        chains[d] = _NONE if lost else np.array([len(groups)], np.int32)
        if not lost:
            counts.append(whole.counts)
            groups += whole.groups
            pairs.append(whole.pairs)
    return np.concatenate(counts), groups, np.concatenate(pairs), chains


def _block_row(block: int, ids: list, texts: Sequence[str | None], codecs: Codecs) -> dict:
    counts, groups, linked, chains = _documents(texts, codecs)
    size = np.array([len(c) for c in chains], np.int32)
    words = np.concatenate([_NONE, *chains])
    sums = _sums(counts[words], size)
    hashes = [hashlib.sha256("".join([groups[k] for k in c.tolist()])[:-1].encode()).hexdigest() if len(c) else "" for c in chains]
    uses = np.bincount(words, minlength=len(groups))
    link_sizes = counts[:, 3]
    pairs, links = np.unique(linked, return_inverse=True)
    pair_n = np.bincount(links, weights=np.repeat(uses, link_sizes), minlength=len(pairs)).astype(np.int64)
    used = pair_n > 0
    renumber = np.cumsum(used) - 1  # words that no document uses any more take their pairs along
    return {
        "block": block, "doc_id": ids, "n_a": sums[:, 0].tolist(), "n_b": sums[:, 1].tolist(), "n_groups": sums[:, 2].tolist(),
        "n_links": sums[:, 3].tolist(), "groups_sha256": hashes, "size": size.tolist(),
        "words": words.astype(np.uint16 if len(groups) <= 1 << 16 else np.int32).tobytes(),
        "link_sizes": np.where(uses > 0, link_sizes, 0).astype(np.int32).tobytes(),
        "links": renumber[links[np.repeat(uses > 0, link_sizes)]].astype(np.int32).tobytes(),
        "pairs": pairs[used].tobytes(), "pair_n": pair_n[used].tobytes(),
    }


def _sums(rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Column sums of consecutive runs of rows; an empty run is 0."""
    total = np.concatenate([np.zeros((1, rows.shape[1]), np.int64), np.cumsum(rows, 0, dtype=np.int64)])
    ends = np.cumsum(size, dtype=np.int64)
    return total[ends] - total[ends - size]


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per block of documents: their counts, their words, the links of the words and the block's pairs."""
    by_rank = merges_by_rank(a_path)
    a_name, b_name = shipped(docs.sparkSession, a_path), shipped(docs.sparkSession, b_path)
    fields = [part.strip().split(" ", 1) for part in _BLOCK_SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
             "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def align(batches):
        codecs = Codecs(SparkFiles.get(a_name), SparkFiles.get(b_name), by_rank)
        block = TaskContext.get().partitionId() << 40
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            a = 0
            while a < len(batch):
                before = size[a - 1] if a else 0
                b = max(a + 1, int(np.searchsorted(size, before + BLOCK, "right")))
                part = batch.slice(a, b - a)
                with uncollected():
                    row = _block_row(block, part.column(0).to_pylist(), part.column(1).to_pylist(), codecs)
                yield pa.RecordBatch.from_pylist([row], schema=schema)
                block, a = block + 1, b

    return keyed_texts(docs).mapInArrow(align, _BLOCK_SCHEMA)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``block, at, pair, n``: how often a pair is linked in a block; ``at`` is its place in the block's list."""

    def unpack(batches):
        for batch in batches:
            for row in batch.to_pylist():
                pair, n = np.frombuffer(row["pairs"], np.int64), np.frombuffer(row["pair_n"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), row["block"])), pa.array(np.arange(len(pair), dtype=np.int32)), pa.array(pair), pa.array(n)],
                    names=["block", "at", "pair", "n"])

    return blocks.select("block", "pairs", "pair_n").mapInArrow(unpack, "block long, at int, pair long, n long")


def link_table(pairs: DataFrame) -> DataFrame:
    """``pair, count, best``: links of the whole corpus by id pair; is it the most frequent of its B id (ties: all)?"""
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << _PAIR) - 1))
    top = F.max("count").over(Window.partitionBy("_b"))
    return counts.withColumn("_b", b_id).withColumn("best", F.col("count") == top).drop("_b")


def alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    blocks = stage(aligned_blocks(docs, a_path, b_path), "alignment-blocks")
    pairs = pair_counts(blocks)
    told = pairs.select("block", "at", "pair").join(link_table(pairs), "pair")
    answers = told.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "count", "best"))).alias("told"))
    answers = answers.select("block", F.col("told.count").alias("count"), F.col("told.best").alias("best"))
    rows = blocks.drop("pairs", "pair_n").join(answers, "block", "left")
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    names = [part.split(" ")[0] for part in out.split(", ")]

    def finish(batches):
        for batch in batches:
            for k in range(len(batch)):
                r = {f: batch.column(c)[k] for c, f in enumerate(batch.schema.names)}
                count = r["count"].values.to_numpy() if r["count"].is_valid else np.empty(0, np.int64)
                best = r["best"].values.to_numpy(zero_copy_only=False) if r["best"].is_valid else np.empty(0, bool)
                links, link_sizes = (np.frombuffer(r[c].as_py(), np.int32) for c in ("links", "link_sizes"))
                size, words = r["size"].values.to_numpy(), r["words"].as_py()
                words = np.frombuffer(words, np.uint16 if len(words) == 2 * size.sum() else np.int32)
                of_word = _sums(np.stack([best[links].astype(np.int64), count[links]], 1), link_sizes)
                sums = _sums(of_word[words], size)
                columns = {c: r[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
                columns |= {"n_best": pa.array(sums[:, 0]), "count_sum": pa.array(sums[:, 1])}
                yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return rows.mapInArrow(finish, out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
