"""Every operator against a plain version of its contract, on small tables with nulls, repeats, ties and odd columns."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

public_tokenizers = pytest.importorskip("public_tokenizers")

from chronoload.llm import (  # noqa: E402
    bpe,
    decontaminate,
    langid,
    licenses,
    linededup,
    pii,
    ppm,
    simhash,
    tokenfile,
    topk,
)

SHARED = "this very line stands in several documents"
PASSAGE = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = [
    None, "", "   \n\t", "a", "Hello World", f"{SHARED}\nown line of the first\n\n{SHARED.upper()}  ", f"  {SHARED}\nb",
    f"{SHARED}\n{SHARED}\nlast", f"start {PASSAGE} end", "short item here and more", "x " * 3000 + PASSAGE,
    "the quick brown fox jumps over the lazy dog again and again until it is tired of the whole story",
    "the quick brown fox jumps over the lazy dog again and again until it is tired of the whole story",
    "Übergrößen für Straßenbahnen sind  schön\x1c, n'est-ce pas? 123 😀", "mail bob@example.com or +49 (30) 1234567-8",
    "card 4111 1111 1111 1111 and 10.0.255.1 not 256.1.1.1", "Licensed under the Apache License, Version 2.0. CC BY cc by",
    "GNU General Public License; all rights reserved",
]
LANGS = ["en", None, "de", "", "fr"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, component_id string, score int, _row int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, LANGS[i % 5], "s", len(t or ""), 1, "x", 2, 3) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PASSAGE), (2, "short item"), (3, None), (4, "..."), (10, PASSAGE + " thirteen"), (5, "the lazy dog again and again until it is tired of")]
    return spark.createDataFrame(rows, "item_id long, text string")


def by_id(df):
    rows = df.collect()
    out = {r.doc_id: r for r in rows}
    assert len(out) == len(rows)
    return out


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def test_partial_matching(spark, docs, none):
    rows = by_id(ppm.score(docs, block=3000))
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(TEXTS))}
    count, trie, order = Counter(), defaultdict(Counter), ppm.ORDER
    data = {i: b"\t" * order + " ".join(tokens(t)).encode() + b"\n" for i, t in enumerate(TEXTS)}
    for i, t in enumerate(TEXTS):
        if not held[i]:
            count.update([*tokens(t), None])
            for j in range(order, len(data[i])):
                for k in range(order + 1):
                    trie[data[i][j - k : j]][data[i][j]] += 1
    n, v = sum(count.values()), len(count)
    for i, t in enumerate(TEXTS):
        own, d, total = [*tokens(t), None], data[i], 0.0
        for j in range(order, len(d)):
            out = set()
            for k in range(order, -1, -1):
                seen = {b: c for b, c in trie.get(d[j - k : j], {}).items() if b not in out}
                if not seen:
                    continue
                norm = sum(seen.values()) + len(seen)
                if d[j] in seen:
                    total += math.log10(seen[d[j]] / norm)
                    break
                total += math.log10(len(seen) / norm)
                out |= seen.keys()
            else:
                total -= math.log10(256 - len(out))
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(own), sum(count[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))
        assert r.score == pytest.approx(total)
    assert ppm.score(none).collect() == []
    assert ppm.adaptive_code_length(b"ab " * 50) > 3 * ppm.adaptive_code_length(b"ab " * 10)


def _contaminated(text, items):
    own, hit, names = words(text), set(), set()
    for name, item in items:
        w = words(item)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            for b in range(len(own) - n + 1):
                if own[b : b + n] == w[a : a + n]:
                    hit.update(range(b, b + n))
                    names.add(str(name))
    return len(own), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination(spark, docs, none, benchmark, block_bytes):
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    rows = by_id(decontaminate.contamination(docs, benchmark, block_bytes=block_bytes))
    for i, t in enumerate(TEXTS):
        assert tuple(rows[i])[1:] == _contaminated(t, items)
    kept = decontaminate.remove_contaminated(docs, benchmark, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in rows.items() if not r.contaminated}
    empty = spark.createDataFrame([], benchmark.schema)
    assert not any(r.contaminated for r in decontaminate.contamination(docs, empty).collect())
    assert decontaminate.contamination(none, benchmark).collect() == []
    best = {(r["item"], r.n_words) for r in decontaminate.longest_matches(docs, benchmark).collect()}
    assert best == {("1", 12), ("10", 12), ("5", 11)}


def test_byte_bpe(spark, docs, none, monkeypatch):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = bpe.read_ranks(path)
    truth = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = by_id(bpe.digests(docs, path, public_tokenizers.PATTERN))
    for i, t in enumerate(TEXTS):
        ids = np.array(truth.encode_ordinary(t or ""), "<u4").tobytes()
        assert tuple(rows[i])[1:] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert bpe.digests(none, path, public_tokenizers.PATTERN).collect() == []
    codec = bpe.Codec(ranks, public_tokenizers.PATTERN, memo=50)
    monkeypatch.setattr(bpe, "FITS", 40)
    monkeypatch.setattr(bpe, "STRIDE", 7)
    rng = np.random.default_rng(3)
    letters = list(" \n\tabcdeTHEing'st.,!0123éü　\x1c​漢😀")
    for _ in range(3000):
        text = "".join(rng.choice(letters, rng.integers(0, 40)))
        ids = truth.encode_ordinary(text)
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == ids
        assert "".join(codec.stream(ids)) == text
    for alphabet in ("the", "aé", "=", "abcdefghijklmnop"):  # one piece, emitted in parts
        text = "".join(rng.choice(list(alphabet), 5000))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == truth.encode_ordinary(text)
    state = bpe.Utf8Stream()
    assert state.feed("é".encode()[:1]) == "" and state.feed("é".encode()[1:]) == "é"
    assert state.feed(b"\xff\xe2\x82") == "�" and state.close() == "�"


def test_simhash(spark, docs, none):
    def naive(text):
        w = tokens(text)
        if not w:
            return 0
        shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = by_id(simhash.near_duplicates(docs))
    assert {i: r.fingerprint for i, r in rows.items()} == {i: f"{naive(t):016x}" for i, t in enumerate(TEXTS)}
    assert {rows[0].component_id, rows[1].component_id, rows[2].component_id} == {0} and rows[12].component_id == 11
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.component_id for r in rows.values()}
    assert simhash.near_duplicates(none).collect() == []
    # links of random and of clustered fingerprints, in one part and in many
    rng = np.random.default_rng(1)
    base = rng.integers(-(2**63), 2**63 - 1, 300)
    flips = np.array([base[i % 40] ^ np.int64(1 << int(rng.integers(0, 62))) for i in range(300)])
    fps = np.unique(np.concatenate([base, flips]))
    x = fps.view(np.uint64)
    parent = np.arange(len(x))
    i, j = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2)
    simhash._hook(parent, i, j)
    want = simhash._roots(parent, np.arange(len(x)))
    for tile in (8192, 4):
        links = simhash.near_links(spark.createDataFrame([(int(f),) for f in fps], "fp long"), tile=tile).collect()
        got = np.arange(len(x))
        place = {int(f): k for k, f in enumerate(fps)}
        simhash._hook(got, np.array([place[r.a] for r in links]), np.array([place[r.b] for r in links]))
        assert (simhash._roots(got, np.arange(len(x))) == want).all()


def test_token_files(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    truth = Tokenizer.from_file(path)
    manifest = tokenfile.write_token_files(docs, path, str(tmp_path)).cache()
    rows = by_id(tokenfile.read_token_files(manifest, str(tmp_path)))
    start = 0
    for i, t in enumerate(TEXTS):
        ids = [*truth.encode(t or "", add_special_tokens=False).ids, 2]
        raw = np.array(ids, "<u4").tobytes()
        assert tuple(rows[i])[1:] == (start, len(ids), zlib.crc32(raw), raw)
        start += len(ids)
    shard = tokenfile.Shard(str(tmp_path), manifest.first().file)
    assert shard.document(4)[0].tolist() == [*truth.encode("Hello World", add_special_tokens=False).ids, 2]
    empty = tokenfile.write_token_files(none, path, str(tmp_path))
    assert tokenfile.read_token_files(empty, str(tmp_path)).collect() == []


def test_personal_data(spark, docs, none):
    rows = by_id(pii.personal_data_report(docs))
    assert rows[14].spans == "email:5:20,phone:24:42" and rows[15].spans == "card:5:24,ip:29:39"
    assert rows[0].spans == "" and rows[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert (rows[15].n_card, rows[15].n_ip, rows[15].n_email) == (1, 1, 0)
    told = [(k, f"write to zorkmid at amy@corp.example about item {k} please") for k in range(4)]
    told += [(k, f"please write about the item {k}") for k in range(4, 40)] + [(50, None), (51, "")]
    few = spark.createDataFrame(told, "doc_id long, text string")
    found = by_id(pii.personal_data_report(few))
    assert found[0].spans == "term:9:16,email:20:36" and found[5].spans == ""
    clean = by_id(pii.sanitise(few))
    assert clean[0].text == "write to  at [email] about item 0 please" and clean[5].text == told[5][1] and clean[50].text is None
    assert pii.personal_data_report(none).collect() == []


def test_line_dedup(spark, docs, none):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, t in enumerate(TEXTS):
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    rows = by_id(linededup.line_report(docs))
    for i, t in enumerate(TEXTS):
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 20 or len(holders[key(x)]) < 3 or max(holders[key(x)]) == i]
        assert tuple(rows[i])[1:] == (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    out = linededup.drop_lines(docs)
    assert out.columns == docs.columns and by_id(out)[5].text == "own line of the first\n" and by_id(out)[0].text is None
    assert linededup.line_report(none).collect() == []


def test_line_index_is_reversible(spark, docs):
    from chronoload.session import stage

    posts = stage(linededup.line_keys(docs), "t")
    low, high = posts.where("doc_id < 7"), posts.where("doc_id >= 7")
    both = linededup.LineIndex.empty(spark).insert(low).insert(high)
    once = linededup.LineIndex.empty(spark).insert(posts)

    def table(index):
        return sorted(tuple(r) for r in index.refs.collect())

    assert table(both) == table(once)
    back = both.delete(high)
    assert table(back) == table(linededup.LineIndex.empty(spark).insert(low))
    keys = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64)
    kept = linededup.CuckooFilter.of(keys[:4000])
    assert kept.contains(keys[:4000]).all() and kept.contains(keys[4000:]).mean() < 0.01
    kept.remove(keys[:2000])
    assert kept.contains(keys[2000:4000]).all() and kept.contains(keys[:2000]).mean() < 0.01


def test_language(spark, none):
    words_ = {"aa": ["banana", "salama", "kavala", "maraba"], "bb": ["rhythm", "crypts", "glyphs", "nymphs"]}
    rng = np.random.default_rng(2)
    rows = [(k, " ".join(rng.choice(words_["ab"[k % 2] * 2], 20)), "ab"[k % 2] * 2) for k in range(60)]
    rows += [(100, None, "aa"), (101, "12 34", "bb"), (102, "", None), (103, "banana salama", None), (None, "glyphs", "bb")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = by_id(langid.predict(table, langid.train_field(table)))
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:60])
    assert [got[i].lang_pred for i in (100, 101, 102, 103)] == ["und", "und", "und", "aa"]
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items() if i is not None)
    assert {r.doc_id for r in langid.keep_identified(table).collect()} == set(got) - {100, 101, 102}
    assert langid.predict(none, langid.train_field(none)).collect() == []
    # forward-backward against the sum over all label sequences
    e, t, s = rng.normal(size=(4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    paths = np.array(np.meshgrid(*[[0, 1]] * 4)).reshape(4, -1).T
    weight = np.array([np.exp(s[p[0]] + sum(e[i, p[i]] for i in range(4)) + sum(t[p[i], p[i + 1]] for i in range(3))) for p in paths])
    want = np.array([[weight[paths[:, i] == y].sum() for y in (0, 1)] for i in range(4)]) / weight.sum()
    assert np.allclose(langid.marginals(e, np.array([4]), t, s), want)


def test_licenses(spark, docs, none):
    rows = by_id(licenses.license_report(docs))
    for i, t in enumerate(TEXTS):
        w = words(t)
        places = sorted((k, lab) for p, lab in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
                        for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        r = rows[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted({x for _, x in places})))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert rows[16].labels == "apache-2.0,cc-by"
    assert licenses.license_report(none).collect() == [] and len(licenses.RULES) > 200
    spans = [(r.label, r.start) for r in licenses.license_spans(docs).where("doc_id = 16").collect()]
    assert ("apache-2.0", 0) in spans and all(label != "apache" for label, _ in spans)


def test_top_k(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(x) for x in rng.normal(size=40)], 0) for k in range(400)]
    rows += [(1000, rows[3][1], 0), (1050, None, 0), (1100, [None] * 40, 0), (1150, [float("nan")] * 40, 0), (1200, [0.5], 0), (None, rows[0][1], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(3)
    vectors = topk.whole_vectors(table)
    got = defaultdict(list)
    for r in topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), query_block=3).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    whole = {k: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for k, v, _ in rows[:401]}
    want = {q: sorted(((k, int(whole[q] @ whole[k])) for k in whole if k != q), key=lambda p: (-p[1], p[0]))[:5] for q in whole if q % 50 == 0}
    assert dict(got) == want
    none = topk.whole_vectors(table.limit(0))
    assert topk.top_k(none, none).collect() == []


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, folder).cache()
        assert out.columns == docs.columns, name
        before, after = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.text for r in out.collect()}
        if name == "line_dedup":
            assert {r.doc_id: r.kept_sha256 for r in linededup.line_report(docs).collect()} == {
                i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in after.items()}
        elif name == "simhash_near_dedup":
            assert set(after) == {r.component_id for r in simhash.near_duplicates(docs).collect()}
        elif name == "decontamination":
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            assert set(after) == {i for i, t in before.items() if not _contaminated(t, bench)[-1]}
        else:
            assert set(after) == {i for i, t in before.items() if re.search(r"[^\W\d_]", t or "")}
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in last} == set(after) and all(r.round_trip for r in last)
