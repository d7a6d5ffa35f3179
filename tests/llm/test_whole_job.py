"""Cases in which an operator did less than the whole job."""

from __future__ import annotations

import re
import tracemalloc

import numpy as np
import pytest

from chronoload.llm import langid, licenses, pii, ppm, simhash


def test_simhash_parts_of_a_split_tile_meet(spark):
    # Pairs that differ by a swap of two bits inside one segment, so by nothing in their population counts; no text
    # between them. All pairs share one cell, which is split into many parts.
    rng = np.random.default_rng(7)
    pairs = []
    for _ in range(40):
        segments = [sum(1 << int(b) for b in rng.choice(16, 8, replace=False)) for _ in range(4)]
        own = sum(s << 16 * i for i, s in enumerate(segments))
        at = int(rng.integers(0, 4)) * 16
        ones = [at + b for b in range(16) if own >> at + b & 1]
        zeros = [at + b for b in range(16) if not own >> at + b & 1]
        pairs.append((own, own ^ 1 << int(rng.choice(ones)) ^ 1 << int(rng.choice(zeros))))
    x = np.array(pairs, np.uint64).view(np.int64)
    assert len(np.unique(x)) == 80
    prints = spark.createDataFrame([(int(f),) for f in x.ravel()], "fp long")
    for tile in (8192, 4):
        links = {frozenset((r.a, r.b)) for r in simhash.near_links(prints, tile=tile).collect()}
        assert {frozenset(map(int, p)) for p in x} <= links


def test_personal_data_far_from_the_entity(spark):
    filler = " ".join(f"w{k}" for k in range(60))  # no terms: letters with a digit
    told = [(k, f"Zorkmid {filler} order 12, amy@corp.example, 4111 1111 1111 1111 {filler} zorkmid\u00a0x") for k in range(4)]
    told += [(k, f"please write about the item {k}") for k in range(4, 40)]
    told += [(40, "zorkmids corp")]
    docs = spark.createDataFrame(told, "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in pii.personal_data_report(docs).collect()}
    terms = [told[0][1][int(a):int(b)] for kind, a, b in (s.split(":") for s in rows[0].split(",")) if kind == "term"]
    assert terms == ["Zorkmid", "order", "zorkmid"] and rows[40] == "" and rows[9] == ""
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "orkmid" not in clean[0] and "[email], [card]" in clean[0] and clean[9] == told[9][1]
    # against all pairs
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(120):
        who = rng.choice(6, int(rng.integers(0, 3)), replace=False).tolist()
        words = [f"name{'abcdef'[w]}" for w in who if rng.random() < 0.9] + [f"word{'abcdefgh'[int(w)]}" for w in rng.integers(0, 8, 5)]
        texts.append((who, words, " ".join([*words[::-1], *[f"user{w}@site.example" for w in who], filler, *words])))
    want = {}
    for c in range(6):
        own = [set(w) for who, w, _ in texts if c in who]
        for t in set().union(*own):
            both, n_t = sum(t in w for w in own), sum(t in w for _, w, _ in texts)
            share = np.log2(120 * both / (len(own) * n_t)) / np.log2(120 / len(own))
            if both >= 3 and share >= 0.75:
                want[c, t] = share
    docs = spark.createDataFrame([(k, t) for k, (_, _, t) in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in pii.personal_data_report(docs).collect()}
    assert want
    for k, (who, words, text) in enumerate(texts):
        got = sorted(text[int(a):int(b)] for kind, a, b in (s.split(":") for s in rows[k].split(",") if s) if kind == "term")
        assert got == sorted(t for t in words * 2 if any((c, t) in want for c in who))


def _examples(parsed, rng):
    """A text that a parsed pattern matches, of random alternatives."""
    out = b""
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            out += bytes([value])
        elif name == "BRANCH":
            out += _examples(value[1][rng.integers(len(value[1]))], rng)
        elif name == "SUBPATTERN":
            out += _examples(value[-1], rng)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = value
            for _ in range(int(rng.integers(low, min(int(high), low + 2) + 1))):
                out += _examples(inner, rng)
        elif name == "IN":
            kind, choice = value[rng.integers(len(value))]
            if str(kind) == "RANGE":
                out += bytes([int(rng.integers(choice[0], choice[1] + 1))])
            else:
                out += bytes([choice]) if str(kind) == "LITERAL" else _category(str(choice), rng)
        elif name not in ("AT", "ASSERT_NOT"):
            raise AssertionError(name)
    return out


def _category(name, rng):
    """White space comes as line ends and in runs, as in wrapped texts."""
    if name == "CATEGORY_SPACE":
        return [b" ", b"\n", b"  ", b" \n\t", b"\r\n"][rng.integers(5)]
    return {"CATEGORY_DIGIT": b"7", "CATEGORY_WORD": b"w", "CATEGORY_NOT_SPACE": b"x"}[name]


@pytest.mark.parametrize("text", [
    "you may not use this\nfile except in compliance with the license", "under the expat license", "ncsa open source license",
    "png reference  library license", "do what the fuck you want to public license".replace("what the", "what\n the"),
])
def test_license_keywords_hold_on_wrapped_texts(text):
    assert licenses.detections(text.encode())


def test_license_keywords_lose_nothing():
    rng = np.random.default_rng(6)
    every = [(k, p) for rules in licenses._compiled().values() for k, p in rules]
    assert len(every) == len(licenses.RULES)
    matched = set()
    for k, pattern in every:
        for _ in range(25):
            text = b"\n" + _examples(re._parser.parse(pattern.pattern), rng) + b"\n"
            found = [(m.start(), m.end(), j) for j, p in every for m in p.finditer(text)]
            matched |= {j for _, _, j in found}
            assert licenses.detections(text) == licenses.settled(found), text
    assert matched == set(range(len(licenses.RULES)))


def test_language_of_texts_without_spaces(spark):
    alphabets = {"aa": "abcdefgh", "bb": "stuvwxyz"}
    rng = np.random.default_rng(2)

    def some(lang, n, size):
        return ["".join(rng.choice(list(alphabets[lang]), size)) for _ in range(n)]

    rows = [(k, " ".join(some("ab"[k % 2] * 2, 30, 6)), "ab"[k % 2] * 2) for k in range(60)]
    middle = "".join(some("bb", 1, 9000))
    rows += [(100, "ab" * 16 + middle + "gh" * 16, None), (101, "abc," + ",".join(some("bb", 300, 6)) + "/def" * 16, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    field = langid.train_field(table)
    got = {r.doc_id: r for r in langid.predict(table, field).collect()}
    assert got[100].lang_pred == got[101].lang_pred == "bb" and all(got[i].lang_pred == lang for i, _, lang in rows[:60])
    # every character of a long run enters, in training too, and a run counts as its pieces do
    joined = ["x1" + middle + ",," + middle[:70] + "9"]
    assert "".join(langid.pieces(joined[0])) == "x" + middle + middle[:70]
    assert max(map(len, langid.pieces(joined[0]))) == 64
    apart = " ".join(langid.pieces(joined[0]))
    assert field.predict([f"abc 12 {joined[0]} def", f"abc {apart} def"])[1][0] == field.predict([f"abc {apart} def"])[1][0]
    assert sorted(langid._slots(joined[0])) == sorted(langid._slots(apart))


def test_strings_of_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [ppm.normal(bytes(rng.choice(list(b"ab c"), int(n)))) for n in [*rng.integers(0, 40, 60), 500, 0, 0, 3000, 7]]
    whole = ppm.grams(b"".join(texts))
    for part in (1, 5, 17, 100, 1 << 19):
        monkeypatch.setattr(ppm, "_PART", part)
        found = list(ppm._stretches(texts))
        assert all(sum(lengths) == len(codes) <= part for _, lengths, codes in found)
        assert np.array_equal(np.concatenate([codes for _, _, codes in found]), whole)
        sizes = np.zeros(len(texts), int)
        for first, lengths, _ in found:
            sizes[first : first + len(lengths)] += lengths
        assert sizes.tolist() == [len(t) for t in texts]


def test_memory_of_counting_is_not_that_of_the_longest_text():
    words = np.random.default_rng(2).integers(0, 300, 1_200_000)
    block = ppm._Block("0-0")
    block.add(1, False, ppm.normal(" ".join(f"w{w}" for w in words).encode()))
    assert block.size > 8 * ppm._PART
    tracemalloc.start()
    codes, counts = block.distinct()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert int(counts.sum()) == block.size and len(codes) < block.size / 100
    assert peak < 12 * block.size


def test_long_texts_are_scored_whole(spark):
    rng = np.random.default_rng(3)
    long = " ".join(f"w{w}" for w in rng.integers(0, 400, 260_000))
    assert len(long) > 2 * ppm._PART
    texts = [long, "w1 w2 w3", "", "other words", long[: ppm._PART + 3]]
    rows = {r.doc_id: r for r in ppm.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    data = [ppm.normal(t.encode()) for t in texts]
    codes = [ppm.grams(d) for d in data]
    every = np.unique(np.concatenate(codes))
    own, n = np.unique(np.concatenate([c for k, c in enumerate(codes) if not rows[k].held_out]), return_counts=True)
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, own)] = n
    low = ppm.Low(*ppm._counted(every & np.uint64(0xFFFF), counts))
    value = ppm.log_probabilities(every, counts, low)
    for k, c in enumerate(codes):
        assert rows[k].n_tokens == len(texts[k].split()) + 1
        assert rows[k].score == pytest.approx(value[np.searchsorted(every, c)].sum())
