from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronoload.llm import langid, linededup, simhash
from chronoload.llm.common import unused

POSTS = "h1 long, h2 long, doc_id long"


def key(mark: int, middle: int) -> tuple[int, int]:
    """Keys of one mark and one bucket: only bits that a small filter does not look at differ."""
    return (mark << 48) | (middle << 20), 7 * middle + mark


def table(df) -> list:
    return sorted(map(tuple, df.collect()))


def fresh(spark, held):
    posts = spark.createDataFrame([(*k, d) for d, ks in held.items() for k in ks], POSTS)
    return linededup.LineIndex.empty(spark).insert(posts), posts


def lost_of(index, posts) -> dict:
    return {r.doc_id: {(x.h1, x.h2) for x in r.lost} for r in index.losses(posts, 3).collect()}


def test_a_key_that_the_filter_takes_for_another_has_a_mark_of_its_own(spark):
    a, b = key(9, 1), key(9, 2)
    rows = lambda d, *ks: spark.createDataFrame([(*k, d) for k in ks], POSTS)
    first = linededup.LineIndex.empty(spark).insert(rows(1, a))
    own = linededup.CuckooFilter.load(first.filters.first()["table"])
    assert own.contains(np.array([b[0]], np.uint64)).all()  # known by chance
    index = first.insert(rows(2, b)).delete(rows(1, a)).insert(rows(3, b)).insert(rows(4, b))
    posts = rows(2, b).unionByName(rows(3, b)).unionByName(rows(4, b))
    assert table(index.refs) == [(*b, 3, 4)]
    assert lost_of(index, posts) == {2: {b}, 3: {b}}


def test_any_order_of_insertions_and_deletions_equals_a_fresh_load(spark):
    rng = np.random.default_rng(11)
    pool = [key(m, i) for m in (3, 4, 5) for i in range(1, 9)]
    held: dict[int, list] = {}
    index = None
    for step in range(5):
        new = {100 * step + d: [pool[i] for i in rng.choice(len(pool), 12, replace=False)] for d in range(5)}
        posts = spark.createDataFrame([(*k, d) for d, ks in new.items() for k in ks], POSTS)
        index = (index or linededup.LineIndex.empty(spark)).insert(posts)
        held |= new
        gone = [int(d) for d in rng.choice(list(held), 4, replace=False)]
        index = index.delete(spark.createDataFrame([(*k, d) for d in gone for k in held.pop(d)], POSTS))
    again, posts = fresh(spark, held)
    assert table(index.refs.select("h1", "h2", "n", "largest")) == table(again.refs.select("h1", "h2", "n", "largest"))
    assert lost_of(index, posts) == lost_of(again, posts) and lost_of(again, posts)
    marks = sum(int((linededup.CuckooFilter.load(r["table"]).slots > 0).sum()) for r in index.filters.collect())
    assert marks == index.refs.count()


def test_shards_grow_with_the_keys(spark, monkeypatch):
    monkeypatch.setattr(linededup, "KEYS_PER_SHARD", 50)
    posts = spark.range(400).select(F.xxhash64("id").alias("h1"), F.col("id").alias("h2"), F.lit(1).cast("long").alias("doc_id"))
    index = linededup.LineIndex.empty(spark, 50).insert(posts.where("h2 < 40"))
    assert index.shards == 1
    index = index.insert(posts.where("h2 >= 40"))
    assert index.shards == 8 and index.filters.count() == 8 and index.refs.count() == 400
    more = index.insert(posts.withColumn("doc_id", F.lit(2).cast("long")))
    assert {r.n for r in more.refs.collect()} == {2} and more.refs.count() == 400


LINE = "a line that is long enough to be a key"


def clashing(spark):
    rows = [(i, f"{LINE}\nown words of number {i} stand here", "x", 1, "en", "y") for i in (1, 2, 3, 3)] + [(None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, _lost string, lost_id int, lang string, LOST string")


def test_columns_may_have_any_name(spark):
    docs = clashing(spark)
    assert unused(docs, "lost") == "lost_" and unused(docs, "loser") == "loser"
    out = linededup.drop_lines(docs)
    assert out.columns == docs.columns and out.count() == 5
    assert sorted(r.text.count(LINE) for r in out.where("text is not null").collect()) == [0, 0, 1, 1]  # rows of the largest id keep it
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1


@pytest.mark.parametrize("lang", [None, ""])
def test_without_languages_all_documents_stay(spark, lang):
    docs = clashing(spark).withColumn("lang", F.lit(lang).cast("string"))
    assert langid.keep_identified(docs).count() == docs.count()
