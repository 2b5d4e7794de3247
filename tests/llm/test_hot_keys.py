"""Keys that most rows have: their rows are dealt out, whatever Spark would do by itself; media in batches; languages without end."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.llm import common, exact_dedup, graph, jaccard, language, media, quality, suffixes
from test_operators import brute_components


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(common, "HOT", 50)


def test_rows_of_a_hot_key_are_dealt_out(spark):
    """200,000 rows of one key and AQE off: no task of the join gets over a twentieth of them."""
    rows = spark.range(210_000).select("id", F.when(F.col("id") < 200_000, 7).otherwise(F.col("id")).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = common.hot_keys(groups, ["k"], 210_000, "n")
    assert [tuple(r) for r in hot.collect()] == [(7, 10)]
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for c, v in zip(before, ("false", "-1", "400"), strict=True):
            spark.conf.set(c, v)
        met = common.join_groups(rows, groups, ["k"], hot, ["id"])
        assert met.columns == ["k", "id", "n"] and met.where("n <> CASE WHEN k = 7 THEN 200000 ELSE 1 END").isEmpty() and met.count() == 210_000
        sizes = [r["count"] for r in met.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 0.25 * 210_000  # ten pieces, of which a task may get two
        assert max(r["count"] for r in met.withColumn("piece", F.pmod(F.xxhash64("id"), F.lit(10))).where("k = 7").groupBy("piece").count().collect()) < 0.11 * 200_000
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert common.hot_keys(rows, ["k"], 210_000).count() == 1 and common.hot_keys(rows, ["k"], 10_000) is None
    assert common.hot_keys(rows.where("id > 200000"), ["k"], 30_000) is None


def test_operators_with_hot_keys(spark, small_pieces):
    """The same results with keys of over 50 rows dealt out."""
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3
    rows = [(i, text) for i in range(400)] + [(400 + i, text + f"and {i}") for i in range(200)] + [(600 + i, f"some other text {i} " * 30) for i in range(50)] + [(None, text), (700, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_duplicates(docs).collect()}
    assert got == {(i, 0, 401, i == 0) for i in [*range(400), None]} | {(i, i, 1, True) for i in [*range(400, 650), 700]}
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(docs, 3, 90).collect() if r["doc_id"] is not None}
    assert found == brute_components([r for r in rows if r[0] is not None], 3, 90)
    passages = {r["doc_id"]: (r["start_word"], r["end_word"]) for r in suffixes.repeated_passages(docs).collect()}
    assert {i for i in passages if i < 600} == set(range(600)) and passages[0] == (0, 78) and passages[400] == (0, 79)


def test_a_hub_with_many_edges(spark, small_pieces):
    edges = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 10_000).otherwise(F.col("id")).alias("a"), (F.col("id") + 1).alias("b")).select(F.col("a").cast("long"), F.col("b").cast("long"))
    pairs = [tuple(r) for r in edges.collect()]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {x: find(x) for x in list(parent) if find(x) != x}
    assert {r["node"]: r["root"] for r in graph.components(edges).collect()} == want


def test_only_some_rows_of_a_set_are_fresh(spark, monkeypatch):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(i, text if i % 4 else f"{text} {i}") for i in range(4000)], "doc_id long, text string").repartition(4)
    levels = jaccard.bucket_levels(docs, 3)
    table = jaccard.prefixes(docs, 3, 90, levels).cache()
    assert table.where("fresh").select("cls").distinct().count() == table.select("cls").distinct().count() == 1001
    assert table.where("fresh").count() <= 1000 + 4 and table.count() == 4000
    monkeypatch.setattr(jaccard, "SEEN", 10)
    assert jaccard.prefixes(docs, 3, 90, levels).where("fresh").select("cls").distinct().count() == 1001


def test_near_copies_below_the_threshold(spark):
    """1,200 texts, all near to each other and none near enough: no link, and equal answers for the ones that are."""
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(50_000)])
    base = rng.integers(0, 1000, 300)
    rows = []
    for i in range(1200):
        own = base.copy()
        own[rng.choice(300, 8, replace=False)] = rng.integers(1000, 50_000, 8)
        rows.append((i, " ".join(words[own])))
    rows += [(5000, rows[17][1]), (5001, rows[18][1] + " more")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert {i: c for i, c in got.items() if i != c} == {5000: 17, 5001: 18}


def test_media_of_tensors_as_a_table(spark, tmp_path, monkeypatch):
    """Tensors stored as a table, in batches of several rows, give the digests that are made without one."""
    monkeypatch.setattr(media, "TENSOR_BYTES", 2000)
    texts = [None, "", "abc", "é" * 500, "x" * 70_000, "abc"] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    stored = media.stored_texts(docs)
    media.decoded(stored).write.parquet(str(tmp_path / "tensors"))
    table = spark.read.parquet(str(tmp_path / "tensors"))
    assert table.where("octet_length(rgb) <> height * width * 3").isEmpty() and table.count() == 30
    columns = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    plain = sorted(map(tuple, media.media_digests(stored).collect()))
    assert sorted(map(tuple, media.media_features(table).select(*columns).collect())) == plain and media.media_digests(stored).columns == columns
    assert plain[2][3] == hashlib.sha256(b"abc" + bytes(61)).hexdigest()
    nothing = docs.select("doc_id", F.lit(0).cast("long").alias("n_bytes"), F.lit(None).cast("binary").alias("media"))
    assert {tuple(r)[2:] for r in media.media_digests(nothing).collect()} == {(None,) * 6} and media.media_digests(stored.limit(0)).count() == 0


def test_languages_without_end(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some text here", f"l{i}") for i in range(30)], "doc_id long, text string, lang string")
    want = language.profiles(docs)
    monkeypatch.setattr(language, "HELD_GRAMS", 5)  # sums are handed on after nearly every slice
    assert language.profiles(docs.repartition(3)) == want and len(want) == 30
    monkeypatch.setattr(language, "MOST_LANGUAGES", 29)
    with pytest.raises(ValueError, match="29 languages"):
        language.profiles(docs)


def test_ties_among_the_nearest():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (200, 40)).astype(np.float32)
    got = quality._nearest(x, 15)
    for row, places in zip(x, got, strict=True):
        assert set(places) == set(sorted(range(40), key=lambda j: (-row[j], j))[:15])
    assert quality._nearest(x, 40).shape == (200, 40)


def test_score_where_everybody_is_equally_near():
    """Forty equal vectors, half of each label in the order of ids: the first fifteen vote."""
    labels = np.array([1.0] * 10 + [0.0] * 30)
    voters = quality.Voters(np.zeros(4, np.float32), np.eye(4, dtype=np.float32), np.ones((40, 4), np.float32) / 2, labels, np.ones(40))
    assert abs(voters.score(np.ones((3, 4), np.float32)) - 10 / 15).max() < 1e-6


def test_families_in_many_chunks(spark, monkeypatch):
    """Families of texts on both sides of the threshold, in many chunks of eight, against brute force."""
    monkeypatch.setattr(jaccard, "CHUNK", 8)
    rng = np.random.default_rng(7)
    words = np.array([f"w{i}" for i in range(40_000)])
    shared = rng.integers(30_000, 40_000, 60)
    rows = []
    for family in range(4):
        base = rng.integers(0, 3000, 220)
        for _ in range(60):
            own = base.copy()
            own[rng.choice(220, rng.integers(1, 6), replace=False)] = rng.integers(3000, 30_000)
            if family == 3:  # of different lengths, and with a passage of other texts
                own = np.r_[own[: rng.integers(120, 220)], shared]
            rows.append((len(rows), " ".join(words[own])))
    rows += [(len(rows) + i, " ".join(words[np.r_[rng.integers(0, 30_000, 40), shared]])) for i in range(30)]
    seen = []
    staged = jaccard.staged

    def noted(table, label):
        out = staged(table, label)
        if label == "opened":
            seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "staged", noted)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    want = brute_components(rows, 3, 90)
    assert got == want and seen and seen[0] > 0
    assert 20 < len({c for _, c in want.values()}) < 260
