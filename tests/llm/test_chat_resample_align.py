"""Reply trees, importance resampling and tokenizer alignment against plain versions of their contracts."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from chronoload.llm import align, chat, numbering, resample  # noqa: E402
from chronoload.llm.common import WORDS  # noqa: E402

CONTROL = ["\\", "\\b", "</turn>", "\\</turn>\n", "### User: ", "#### x", "</turn</turn>", "\\t\\h", "a:b", "", None, "é😀\n\n", "### ### "]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def escape(text, role=False):
    for control, stand_in in (("\\", "\\b"), ("</turn>", "\\t"), ("### ", "\\h")) + (((":", "\\c"),) if role else ()):
        text = text.replace(control, stand_in)
    return text


def digest(turns):
    shown = "".join(f"### {escape(r, True)}: {escape(t)}</turn>\n" for r, t in turns)
    learned = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), len(shown)


def test_conversations(spark):
    rng = np.random.default_rng(5)
    roles = ["user", "assistant", "system", None, "a: b\\", "### x"]
    rows = []
    for conv in (1, 2, 3, None, -5):
        for turn in range(int(rng.integers(1, 12))):
            for _ in range(int(rng.integers(1, 3))):  # ties
                rows.append((conv, turn * 3 if rng.random() < 0.95 else None, roles[rng.integers(0, 6)], CONTROL[rng.integers(0, len(CONTROL))], 1, "x"))
    rows += [(9, k, roles[k % 2], f"turn {k} {CONTROL[k % 9]}", 1, "x") for k in range(333)]  # more than a part
    rows += [(10, 4, "assistant", "again", 1, "x")] * 100 + [(10, 4, "user", "again", 1, "x")] + [(10, 5, "user", "last", 1, "x")] * 2
    rows += [(11, None, None, None, None, None), (12, 0, "assistant", "long </turn> \\ " * 40_000, 1, "x")]
    schema = "conv_id long, turn long, role string, text string, node long, path string"  # the last two clash
    df = spark.createDataFrame(rows, schema).repartition(5)
    by_conv = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", hashlib.md5((text or "").encode()).digest(), text or ""))
    want = {(c, *digest([(r, t) for _, _, r, _, t in sorted(own)])) for c, own in by_conv.items()}
    parts = chat.format_conversations(df)
    got = [(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in chat.digests(parts).collect()]
    assert len(got) == len(want) and set(got) == want
    assert max(r.n for r in parts.selectExpr("size(split(formatted, '</turn>\n')) - 1 AS n").collect()) == chat.PART
    whole = {r.conv_id: r.formatted for r in chat.whole_conversations(parts, ["conv_id"]).collect()}
    assert len(whole[9]) == next(w[-1] for w in want if w[0] == 9)
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_conversations_stay_native(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    parts = chat.digests(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    plan = parts._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("branches", [1, 3])
def test_reply_trees(spark, branches):
    rng = np.random.default_rng(branches)
    rows = [(k, None if k < 5 else int(rng.integers(max(0, k - 40), k)), "user" if k % 2 else "assistant", f"t{k}", float(rng.integers(0, 4))) for k in range(400)]
    rows += [(1000 + k, 999 + k if k else None, "user", f"c{k}", None) for k in range(300)]  # a long chain
    rows += [(2000, 2002, "user", "loop", 1.0), (2001, 2000, "user", "loop", 1.0), (2002, 2001, "user", "loop", 1.0), (2003, 2002, "user", "below", 1.0)]
    rows += [(3000, 77777, "user", "orphan", 2.0), (None, 3000, "user", "no id", 5.0), (3000, 77777, "user", "orphan", 2.0)]
    schema = "message_id long, parent_id long, role string, text string, score double"
    got = defaultdict(dict)
    for r in chat.read_back(chat.format_trees(spark.createDataFrame(rows, schema).repartition(3), branches)).collect():
        got[r.root, r.rank, r.path, r.n_turns][r.part] = [(t.role, t.text) for t in r.turns]
    told = {r[0]: r for r in rows if r[0] is not None}
    replied = {r[1] for r in rows if r[0] is not None}
    by_root = defaultdict(list)
    for leaf in set(told) - replied:
        path, seen = [leaf], {leaf}
        while told[path[-1]][1] in told and told[path[-1]][1] not in seen:
            path.append(told[path[-1]][1])
            seen.add(path[-1])
        if told[path[-1]][1] not in told:
            by_root[path[-1]].append((-sum(told[m][4] or 0.0 for m in path), leaf, path[::-1]))
    want = {}
    for root, own in by_root.items():
        for rank, (_, leaf, path) in enumerate(sorted(own)[:branches], 1):
            want[root, rank, leaf, len(path)] = [(told[m][2], told[m][3]) for m in path]
    assert {k: [t for part in sorted(v) for t in v[part]] for k, v in got.items()} == want
    assert all(len(p) <= chat.PART for v in got.values() for p in v.values())


def test_numbers_are_consecutive(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k),) for k in rng.integers(0, 50, 500)] + [(None,)] * 20
    df = spark.createDataFrame(rows, "k long").repartition(7).selectExpr("k", "monotonically_increasing_id() AS salt")
    out = sorted(numbering.numbered(df, [df.k.asc_nulls_first(), df.salt.asc()], "at", "numbers").collect(), key=lambda r: r["at"])
    assert [r["at"] for r in out] == list(range(520))
    assert [r.k for r in out] == [None] * 20 + sorted(k for k, in rows if k is not None)
    assert numbering.numbered(df.limit(0), [df.k.asc()], "at", "numbers").count() == 0


def plain_resample(docs, target, run, buckets, percent, min_words, seed):
    def features(text):
        words = (text or "").encode().translate(WORDS).split()
        return words, [zlib.crc32(b" ".join(words[i : i + k])) % buckets for k in range(1, run + 1) for i in range(len(words) - k + 1)]

    s = Counter(b for _, t in docs for b in features(t)[1])
    t = Counter(b for x in target for b in features(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (n_s + buckets) / ((s[b] + 1.0) * (n_t + buckets))))
    rows = []
    for i, text in docs:
        words, own = features(text)
        weight = sum(map(gain, own)) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    may = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    out = Counter((*r[:4], None) for r in rows if r[4] < min_words)
    draws = len(may) * percent // 100
    return out + Counter((*r[:4], k + 1 if k < draws else None) for k, r in enumerate(may))


def corpus():
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(60)] + ["Über", "é😀x", "A1", "b-c", "x" * 70, "y" * 300, "Z" * 65]
    docs = [(k, " ".join(rng.choice(words, int(rng.integers(0, 60))).tolist())) for k in range(80)]
    docs += [(100, None), (101, ""), (102, "..."), (None, "one two " * 15), (5, "one two " * 15), (5, "one two " * 15), (103, "q" * 200_000 + " r s")]
    return docs + [(104, "a b c d " * 30_000)], ["w1 w2 w3 w1", None, "", "Über " * 5]


@pytest.mark.parametrize("run, buckets", [(1, 10_000), (2, 997), (3, 100_000)])
def test_importance_resampling(spark, run, buckets):
    docs, target = corpus()
    frame = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, rank int, n_words int, _may int").repartition(4)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.importance_resample(frame, goal, run, buckets, 30, 10, 77)
    assert got.columns == list(resample.RESULT)
    assert Counter(map(tuple, got.collect())) == plain_resample(docs, target, run, buckets, 30, 10, 77)


def test_importance_resampling_on_empty_tables(spark):
    docs, _ = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = resample.importance_resample(frame, frame.limit(0), percent=50)
    assert Counter(map(tuple, got.collect())) == plain_resample(docs, [], 1, 10_000, 50, 20, 2024)
    assert resample.importance_resample(frame.limit(0), frame).count() == 0
    carried = resample.importance_resample(frame, frame, carry=["text"]).collect()
    assert Counter(r.text for r in carried) == Counter(t for _, t in docs)
    with pytest.raises(ValueError, match="rank"):
        resample.importance_resample(frame.withColumn("rank", frame.doc_id), frame, carry=["rank"])


def plain_alignment(docs, a_path, b_path):
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(a_path)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=b_path)
    codecs = align.Codecs(a_path, b_path, False)
    rows, links_of, seen = [], [], Counter()
    for i, text in docs:
        whole = f" {text or ''}".encode()
        ids = (a_side.encode(f" {text}", add_special_tokens=False).ids, b_side.encode(text)) if text else ([], [])
        if any(b"".join(own[x] for x in side) != whole for side, own in zip(ids, codecs.bytes)):
            rows.append((i, 0, 0, 0))
            links_of.append(([], ""))
            continue
        spans = []
        for side, own in zip(ids, codecs.bytes):
            ends = np.cumsum([len(own[x]) for x in side]).tolist()
            spans.append(list(zip([0, *ends], ends, side)))
        links = [(x, y) for a, b, x in spans[0] for c, d, y in spans[1] if max(a, c) < min(b, d)]
        groups, last = [], 0
        for end in sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]}):
            groups.append("|".join(",".join(str(x) for _, b, x in side if last < b <= end) for side in spans))
            last = end
        seen.update(links)
        rows.append((i, len(ids[0]), len(ids[1]), len(groups)))
        links_of.append((links, sha(";".join(groups))))
    top = defaultdict(int)
    for (_, y), n in seen.items():
        top[y] = max(top[y], n)
    return Counter(
        (*row, len(links), sum(seen[x] == top[x[1]] for x in links), sum(seen[x] for x in links), h) for row, (links, h) in zip(rows, links_of))


ODD = [
    None, "", " ", "  ", "a", "\n", "  a  b\n\n c \t d ", "x\u2581y z", "<|endoftext|> a <s> b", "a\u00a0b \u3000c\x1c d\x85e f", "\ufb01\u2460 😀😀 é e\u0301",
    "'s 't it's we'll", "a\x00b", "x" * 900, "1 22 333 4444 55555", "  \n  x", "don't   stop\r\n\r\nnow ", "\ufeffa \ufffd", "<0x41> <unk>",
    "the cat sat on the mat, the end.", "the cat sat on the mat, the end.", "Übergrößen für Straßenbahnen", "\u2581", " \u2581 the cat", "日本語 のテキスト です",
]


def test_tokenizer_alignment(spark, monkeypatch):
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    docs = [(k if k % 7 else None, t) for k, t in enumerate(ODD)] + [(3, "again and again"), (3, "again and again")]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, block long, pair string")
    want = plain_alignment(docs, *paths)
    assert Counter(map(tuple, align.alignment(frame.repartition(3), *paths).collect())) == want
    monkeypatch.setattr(align, "BLOCK", 40)  # many blocks, also of one text
    monkeypatch.setattr(align, "merges_by_rank", lambda _: False)  # A's own merges throughout
    assert Counter(map(tuple, align.alignment(frame.repartition(2), *paths).collect())) == want
    assert align.alignment(frame.limit(0), *paths).count() == 0
    assert sum(n for (*_, h), n in want.items() if not h) == 5  # null, empty and the three texts that hold U+2581


def test_words_are_cut_where_no_token_crosses():
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    assert align.merges_by_rank(paths[0])
    codecs = align.Codecs(*paths, True)
    rng = np.random.default_rng(2)
    letters = list("ab e.,'1\n\t-é中") + ["  ", " the", "ing "]
    for _ in range(300):
        text = "".join(rng.choice(letters, 25))
        a, b = codecs.stream(align._cut(text))
        assert a.tolist() == codecs.a.encode(f" {text}", add_special_tokens=False).ids and b.tolist() == codecs.b.encode(text)
