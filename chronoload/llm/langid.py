"""Language identification with a linear-chain conditional random field over the words of a text.

Every word of a text gets a label distribution by forward-backward; a text's language is the label with the largest mean
marginal, its score that mean. A word's emission is the sum of learned weights of its features (prefixes and suffixes
of 1 to 3 characters, n-grams of 2 and 3, the word itself) hashed into ``FEATURES`` slots, plus a learned weight times
its lexicon log-odds: counts by language of *all* training words, hashed into ``LEXICON`` slots. Transitions are learned
from training sequences spliced from segments of several languages, so that a switch inside a text is possible and dear.

The lexicon covers all training documents. The weights are fitted on the driver on a sample of about ``SAMPLE`` training
documents a language, chosen by the hash of their ids and cut into segments. The model's size does not depend on the
data: (FEATURES + LEXICON) numbers a language.

Defined results: a null text, and one without a letter, is ``und`` with score 0; a word is a run between white space,
stripped of what is no letter and lower-cased; one of over ``LONGEST`` characters (text without spaces, joined words) is
split at what is neither letter nor mark and its longer runs are cut into consecutive pieces of ``LONGEST``, which are all
words of their own; words without letters are passed over; a null doc_id has remainder 0; a
null or empty ``lang`` is not learned from; with no training document every text is ``und``; ties go to the language that
sorts first; repeated rows count each in the lexicon; an empty table gives an empty result; other columns are carried
by ``keep_identified`` and never read for a prediction.
"""

from __future__ import annotations

import unicodedata
import zlib
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoload.llm.common import remainder, table, uncollected
from chronoload.session import prepare, stage

FEATURES = 1 << 17
LEXICON = 1 << 18
SAMPLE = 80
STEPS = 40
HOLD = (4, 2)
MIN_SCORE = 0.3
UNKNOWN = "und"
LONGEST = 64
_MEMO = 200_000
_GROUP = 400_000
_SEGMENT = 40
_SEQUENCE = 240


def stripped(word: str) -> str:
    """The word from its first to its last letter, lower-cased; empty without a letter."""
    if word.isalpha():
        return word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b].lower()


def _inner(c: str) -> bool:
    return c.isalpha() or unicodedata.category(c)[0] == "M"


def pieces(word: str) -> list[str]:
    """The words that a run between white space counts as: none without a letter, one unless it is too long."""
    bare = stripped(word)
    if len(bare) <= LONGEST:
        return [bare] if bare else []
    runs = ["".join(own) for inner, own in groupby(bare, _inner) if inner]
    cut = [run[a : a + LONGEST] for run in runs for a in range(0, len(run), LONGEST)]
    return [w for w in cut if any(map(str.isalpha, w))]


def lexicon_slot(word: str) -> int:
    return zlib.crc32(word.encode()) & (LEXICON - 1)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all words' features, and the word each belongs to: n-grams of 2 and 3 of ``^word$`` (at its ends they
    are the affixes of 1 and 2), affixes of 3, and the word itself."""
    marked = [f"^{w}$" for w in words]
    size = np.array([len(w) for w in marked])
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    begin = np.cumsum(size) - size
    left = np.repeat(begin + size, size) - np.arange(len(code))  # characters from here to the word's end
    prime = np.uint64(0x100000001B3)
    grown, slots, owners = code * prime, [], []
    for n in (2, 3, 4):
        grown = grown[: len(code) - n + 1]
        grown = (grown ^ code[n - 1 :]) * prime
        inside = left[: len(grown)] >= n
        if n == 4:  # only at both ends
            head = np.zeros(len(code), bool)
            head[begin] = True
            inside = inside & (head[: len(grown)] | (left[: len(grown)] == 4))
        slots.append(grown[inside] + np.uint64(n))
        owners.append(owner[: len(grown)][inside])
    spread = code * (np.uint64(0x9E3779B97F4A7C15) * (2 * left.astype(np.uint64) + np.uint64(1)))
    slots.append(np.add.reduceat(spread ^ (spread >> np.uint64(29)), begin))
    owners.append(np.arange(len(words)))
    mixed = np.concatenate(slots) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed ^ (mixed >> np.uint64(32))) & np.uint64(FEATURES - 1)).astype(np.int64), np.concatenate(owners)


def emissions(slot: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(owner, weight[slot, y], n) for y in range(weight.shape[1])], 1)


def marginals(emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Forward-backward over many sequences at once, in scaled probabilities.

    ``emission`` holds the words of all sequences one behind the other, the longest sequence first. All sequences take
    a step together. Gives marginals, and with ``pairs`` the log-likelihood's partition sum and expected transitions.
    """
    n, labels = emission.shape
    shift = emission.max(1, keepdims=True)
    p = np.exp(emission - shift)
    t = np.exp(transition)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    forward, scale = np.empty_like(p), np.empty(n)
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    for i in range(steps):
        k = active[i]
        at = begins[:k] + i
        a = p[at] * (np.exp(start) if i == 0 else forward[at - 1] @ t)
        z = a.sum(1)
        forward[at], scale[at] = a / z[:, None], z
    backward = np.empty_like(p)
    expected = np.zeros((labels, labels))
    after = np.ones((len(lengths), labels))
    for i in range(steps - 1, -1, -1):
        k = active[i]
        at = begins[:k] + i
        b = after[:k]
        backward[at] = b
        q = p[at] * b / scale[at][:, None]
        if pairs and i:
            expected += (forward[at - 1].T @ q) * t
        after[:k] = q @ t.T
    out = forward * backward
    out /= out.sum(1, keepdims=True)
    return (out, float(np.log(scale).sum() + shift.sum()), expected) if pairs else out


def fit(segments: list[tuple[str, int]], odds: np.ndarray, labels: int, seed: int = 5):
    """Weights of features, lexicon, transitions and start from (words, label) segments, by adaptive gradient steps."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(segments))
    vocabulary: dict[str, int] = {}
    words, gold, lengths, size = [], [], [], 0
    for k in order.tolist():
        own, label = segments[k]
        codes = [vocabulary.setdefault(w, len(vocabulary)) for w in own]
        words += codes
        gold += [label] * len(codes)
        size += len(codes)
        if size >= _SEQUENCE:
            lengths.append(size)
            size = 0
    if size:
        lengths.append(size)
    lengths = np.array(lengths)
    begins = np.cumsum(lengths) - lengths
    by = np.argsort(-lengths, kind="stable")
    at = np.concatenate([np.arange(begins[k], begins[k] + lengths[k]) for k in by.tolist()])
    lengths = lengths[by]
    words, gold = np.array(words)[at], np.array(gold)[at]
    names = list(vocabulary)
    flat, owner = features(names)
    used, slot = np.unique(flat, return_inverse=True)
    lex = odds[[lexicon_slot(w) for w in names]]
    weight = np.zeros((len(used), labels))
    share, transition, start = np.full(1, 0.3), np.zeros((labels, labels)), np.zeros(labels)
    memory = [np.full_like(x, 1e-6) for x in (weight, share, transition, start)]
    ends = np.cumsum(lengths) - lengths
    inner = np.ones(len(words), bool)
    inner[ends] = False
    seen_pairs = np.zeros((labels, labels))
    np.add.at(seen_pairs, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
    one_hot = np.eye(labels)[gold]
    seen_start = one_hot[ends].sum(0)
    for _ in range(STEPS):
        emission = emissions(slot, owner, weight, len(names)) + share[0] * lex
        got, _, expected = marginals(emission[words], lengths, transition, start, pairs=True)
        rest = one_hot - got
        by_word = np.stack([np.bincount(words, rest[:, y], len(names)) for y in range(labels)], 1)
        spread = by_word[owner]
        by_slot = np.stack([np.bincount(slot, spread[:, y], len(used)) for y in range(labels)], 1)
        gradients = [
            by_slot - 0.5 * weight, np.array([(by_word * lex).sum()]),
            seen_pairs - expected - 0.1 * transition, seen_start - got[ends].sum(0) - 0.1 * start,
        ]
        for x, g, m in zip((weight, share, transition, start), gradients, memory, strict=True):
            m += g * g
            x += 0.25 * g / np.sqrt(m)
    full = np.zeros((FEATURES, labels), np.float32)
    full[used] = weight
    return full, float(share[0]), transition, start


class Field:
    """A fitted model: predicts many texts at once."""

    def __init__(self, names: list[str], odds, weight, share, transition, start) -> None:
        self.names, self.odds, self.weight = names, odds, weight
        self.share, self.transition, self.start = share, transition, start
        self.forget()

    def forget(self) -> None:
        self.row: dict[str, int] = {}
        self.used = 0
        self.many: list[np.ndarray] = []
        self.emission = np.zeros((1024, len(self.names)), np.float32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("row", "used", "many", "emission")}

    def __setstate__(self, state) -> None:
        self.__dict__.update(state)
        self.forget()

    def _learn(self, fresh: list[str]) -> None:
        """Emission rows of words not met before; -1 for those without a letter, -2 - k for those with rows ``many[k]``."""
        own = [pieces(w) for w in fresh]
        good = [p for ps in own for p in ps]
        first = self.used
        if good:
            rows = emissions(*features(good), self.weight, len(good))
            rows += self.share * self.odds[[lexicon_slot(w) for w in good]]
            self.used += len(good)
            while len(self.emission) < self.used:
                self.emission = np.concatenate([self.emission, np.zeros_like(self.emission)])
            self.emission[first : self.used] = rows
        for w, ps in zip(fresh, own, strict=True):
            if len(ps) > 1:
                self.row[w] = -2 - len(self.many)
                self.many.append(np.arange(first, first + len(ps), dtype=np.int32))
            else:
                self.row[w] = first if ps else -1
            first += len(ps)

    def _spread(self, codes: np.ndarray) -> np.ndarray:
        """The codes with those of long words in place of theirs."""
        long = np.flatnonzero(codes < -1)
        if not len(long):
            return codes
        own = [self.many[-2 - c] for c in codes[long].tolist()]
        times = np.ones(len(codes), np.int64)
        times[long] = [len(o) for o in own]
        out = np.repeat(codes, times)
        out[out < -1] = np.concatenate(own)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if self.names:
            order = sorted((i for i, t in enumerate(texts) if t), key=lambda i: -len(texts[i]))
            group, size = [], 0
            for i in order:
                group.append(i)
                size += len(texts[i]) // 6 + 1
                if size >= _GROUP:
                    self._group(texts, group, names, scores)
                    group, size = [], 0
            self._group(texts, group, names, scores)
        return names, scores

    def _group(self, texts, group, names, scores) -> None:
        if len(self.row) > _MEMO or self.used > _MEMO:
            self.forget()
        get = self.row.get
        texts_words = [texts[i].split() for i in group]
        fresh = {w for words in texts_words for w in words if w not in self.row}
        if fresh:
            self._learn(list(fresh))
        sequences, owner = [], []
        for i, words in zip(group, texts_words, strict=True):
            codes = self._spread(np.array(list(map(get, words)), np.int32))
            codes = codes[codes >= 0]
            if len(codes):
                sequences.append(codes)
                owner.append(i)
        if not owner:
            return
        lengths = np.array([len(s) for s in sequences])
        by = np.argsort(-lengths, kind="stable")
        lengths = lengths[by]
        words = np.concatenate([sequences[k] for k in by.tolist()])
        got = marginals(self.emission[words].astype(np.float64), lengths, self.transition, self.start)
        mean = np.add.reduceat(got, np.cumsum(lengths) - lengths, axis=0) / lengths[:, None]
        best = mean.argmax(1)
        for k, b, s in zip(by.tolist(), best.tolist(), mean.max(1).tolist(), strict=True):
            names[owner[k]], scores[owner[k]] = self.names[b], min(1.0, s)


def _lexicon(train: DataFrame, names: list[str]) -> np.ndarray:
    """Log-odds by language of each lexicon slot, from the counts of all training words."""
    number = {name: i for i, name in enumerate(names)}

    def count(batches):
        total = np.zeros((len(names), LEXICON), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                slots = _slots(text.as_py())
                if len(slots):
                    total[number[lang]] += np.bincount(slots, minlength=LEXICON)
        y, slot = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot, pa.int32()), pa.array(y, pa.int32()), pa.array(total[y, slot])], names=["slot", "y", "n"])

    sums = train.select("text", "lang").mapInArrow(count, "slot int, y int, n long").groupBy("slot", "y").agg(
        F.sum("n").alias("n"))
    counts = np.zeros((LEXICON, len(names)))
    table_ = stage(sums, "language-lexicon").toArrow()  # bounded: LEXICON * languages rows
    counts[table_["slot"].to_numpy(), table_["y"].to_numpy()] = table_["n"].to_numpy()
    share = np.log((counts + 0.5) / (counts.sum(0) + 0.5 * LEXICON))
    return (share - share.mean(1, keepdims=True)).astype(np.float32)


@lru_cache(maxsize=_MEMO)
def _slot_of(word: str) -> int:
    """-1 without a letter, -2 for a word of several pieces."""
    own = pieces(word)
    return -2 if len(own) > 1 else lexicon_slot(own[0]) if own else -1


def _slots(text: str) -> np.ndarray:
    words = text.split()
    slots = np.array(list(map(_slot_of, words)), np.int64)
    long = [lexicon_slot(p) for k in np.flatnonzero(slots == -2).tolist() for p in pieces(words[k])]
    return np.concatenate([slots[slots >= 0], np.array(long, np.int64)])


def train_field(docs: DataFrame, sample: int = SAMPLE, hold: tuple[int, int] = HOLD) -> Field:
    """Learns from ``text`` and non-null ``lang`` of documents whose id's crc32 modulo ``hold[0]`` is not ``hold[1]``."""
    prepare(docs.sparkSession)
    train = docs.where((remainder(F.col("doc_id"), hold[0]) != hold[1]) & F.col("text").isNotNull()
                       & (F.coalesce(F.col("lang"), F.lit("")) != ""))
    sizes = {r.lang: r.n for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return Field([], None, None, 0.0, None, None)
    odds = _lexicon(train, names)
    limit = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(min(1.0, sample / sizes[n])))])
    chance = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), F.lit(1 << 20)) / float(1 << 20)
    picked = train.where(chance < limit[F.col("lang")]).select("text", "lang")
    segments = []
    for r in picked.toLocalIterator():
        own = [p for w in r.text.split() for p in pieces(w)]
        y = names.index(r.lang)
        segments += [(own[a : a + _SEGMENT], y) for a in range(0, len(own), _SEGMENT)]
    if not segments:
        return Field(names, odds, np.zeros((FEATURES, len(names)), np.float32), 1.0,
                     np.eye(len(names)) * 3, np.zeros(len(names)))
    return Field(names, odds, *fit(segments, odds, len(names)))


def predict(docs: DataFrame, field: Field, hold: tuple[int, int] = HOLD) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: one row per document, from its text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches):
        for batch in batches:
            with uncollected():
                names, scores = sent.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (remainder(F.col("doc_id"), hold[0]) == hold[1]).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with all its columns, without texts that have no letter or whose best mean marginal is too low; all of them
    if no document has a language to learn from."""
    field = train_field(docs)
    if not field.names:  # nothing to learn from
        return docs
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def keep(batches):
        for batch in batches:
            with uncollected():
                names, scores = sent.value.predict(batch.column(batch.schema.get_field_index("text")).to_pylist())
            good = [n != UNKNOWN and s >= min_score for n, s in zip(names, scores, strict=True)]
            yield batch.filter(pa.array(good, pa.bool_()))
        sent.value.forget()  # the worker lives on

    return docs.mapInArrow(keep, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train_field(docs))
