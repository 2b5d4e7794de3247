"""Sharding, quality, mixing and language against plain re-implementations; odd names, empty tables and long texts for all stages."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import unicodedata

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from loomline.llm import exact_dedup, jaccard, language, media, mixing, packing, quality, sharding, suffixes, tokens
from test_operators import IDS, PIECES, brute_components, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def collected(documents):
    return documents.orderBy("doc_id").collect()


def test_sharding_by_the_rule(documents, collected):
    """Items above 1/64 of a share first, the others after them, each largest first to where item and room have the highest product."""
    got = {r["doc_id"]: r for r in sharding.vector_shards(documents, shards=5).collect()}
    groups = collections.defaultdict(list)
    for r in collected:
        groups[r["text"] or ""].append(r["doc_id"])
    vector = {t: np.array([len(ids) * (len(t.encode()) + 16), len(ids) * len(words(t)), len(ids)], float) for t, ids in groups.items()}
    share = np.maximum(1, sum(vector.values()) / 5)
    assert all((v <= share).all() for v in vector.values())  # no group is split here
    room = np.ones((5, 3))

    def put(texts):
        shards = {}
        for t in sorted(texts, key=lambda t: (-(vector[t] / share).max(), hashlib.md5(t.encode()).hexdigest())):
            best = max(range(5), key=lambda s: (float(room[s] @ (vector[t] / share)), -s))
            room[best] -= vector[t] / share
            shards[t] = best
        return shards

    heavy = [t for t, v in vector.items() if (v / share * 64).max() > 1]
    want = put(heavy) | put(set(vector) - set(heavy))
    assert {t: {got[i]["shard"] for i in ids} for t, ids in groups.items()} == {t: {s} for t, s in want.items()}


def test_a_third_in_one_group_is_split(spark):
    rows = [(i, "the same text here") for i in range(400)] + [(1000 + i, f"text {i} " * (1 + i % 9)) for i in range(800)]
    got = sharding.vector_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=8).collect()
    sums, parts = collections.Counter(), collections.Counter()
    for r in got:
        sums[r["shard"]] += r["size"]
        parts[r["shard"]] += r["doc_id"] < 400
    assert max(sums.values()) <= 1.1 * sum(sums.values()) / 8 and max(parts.values()) <= 1200 / 8 * 1.1


def test_votes_of_neighbours(documents, collected, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = quality.labels_by_id(labels).where(quality.crc_bucket(F.col("doc_id"), 3) != 1)
    voters = quality.fit(documents, known)
    got = {r["doc_id"]: r["score"] for r in quality.classify(documents, labels).collect()}
    by_id = {r["doc_id"]: (r["text"] or "").encode() for r in collected}

    def vector(text):
        """Trigram counts by the same bins, one by one, and the share of repeated words."""
        out = np.zeros(quality.WIDTH)
        for a, b, c in zip(text, text[1:], text[2:], strict=False):
            out[(((a << 16 | b << 8 | c) * 2654435761) % 2**32) >> 20] += 1
        out = np.sqrt(out)
        out /= max(np.sqrt((out * out).sum()), 1e-9)
        w = re.findall(b"[^\x20\x09-\x0d]+", text)
        out[-1] = np.sqrt(sum(x == y for x, y in itertools.pairwise(w)) / max(1, len(w))) if len(text) >= 3 else 0
        return out

    latent = {}
    for r in known.collect():
        x = (vector(by_id[r["doc_id"]]) - voters.mean) @ voters.basis
        latent[r["doc_id"]] = (x / max(np.linalg.norm(x), 1e-9), r["label"])
    count = collections.Counter(label >= 0.5 for _, label in latent.values())
    assert len(latent) == len(voters.labels) and count[True] and count[False]
    for i in list(by_id)[:60]:
        x = (vector(by_id[i]) - voters.mean) @ voters.basis
        x /= max(np.linalg.norm(x), 1e-9)
        near = sorted(((float(x @ v), label) for v, label in latent.values()), reverse=True)[: quality.NEIGHBOURS]
        weights = [max(c, 1e-6) ** quality.SHARPNESS for c, _ in near]
        want = sum(w * label for w, (_, label) in zip(weights, near, strict=True)) / sum(weights)
        assert abs(got[i] - want) < 0.02, i  # vectors come to the driver as half precision


def test_words_that_the_mix_takes(documents, collected):
    """Streams are without gaps, every pass takes each block once, and the words taken are those of the slots, word by word."""
    plan = mixing.plan_mix(documents, False, block=64, shards=8)
    rows, slots = plan.rows.collect(), plan.slots.collect()
    texts = {r["doc_id"]: words(r["text"]) for r in collected}
    stream = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["key"], r["start"], r["size"])):
        assert r["start"] == len(stream[r["key"]]) and r["size"] == len(texts[r["doc_id"]])
        stream[r["key"]] += [(r["doc_id"], i) for i in range(r["size"])]
    taken, per_shard = collections.Counter(), collections.Counter()
    blocks = collections.defaultdict(list)
    for s in slots:
        blocks[s["key"], s["pass"]].append(s["block"])
        per_shard[s["shard"]] += 1
        for word in stream[s["key"]][64 * s["block"] :][: s["take"]]:
            taken[word] += 1
    assert all(len(b) == len(set(b)) for b in blocks.values()) and max(per_shard.values()) - min(per_shard.values()) <= 1
    for (key, turn), b in blocks.items():
        if (key, turn + 1) in blocks:
            assert sorted(b) == list(range(-(-len(stream[key]) // 64)))
    per_doc = collections.Counter()
    for (i, _), n in taken.items():
        per_doc[i] += n
    assert {r["doc_id"]: r["taken"] for r in mixing.mix_sources(documents, block=64, shards=8).collect()} == {i: per_doc[i] for i in texts}
    pieces = mixing.taken_pieces(plan).collect()
    ids = {r["row"]: r["doc_id"] for r in rows}
    again = collections.Counter((ids[p["row"]], i) for p in pieces for i in range(p["from_word"], p["to_word"]))
    assert again == taken
    mixed = collections.Counter()
    for r in mixing.mixed_documents(documents, block=64, shards=8).collect():
        mixed.update(words(r["text"]))
    want = collections.Counter()
    for (i, k), n in taken.items():
        want[texts[i][k]] += n
    assert mixed == want


def grams_of(text):
    out = collections.Counter()
    letters = "".join((c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] in "LM" else " " for c in text)
    padded = f" {letters}  "
    for i in range(1, len(padded) - 1):
        a, b, c = padded[i - 1 : i + 2]
        out[b] += b != " "
        out[a + b] += a + b != "  "
        out[a + b + c] += b != " "
    return +out


def number(gram):
    return sum(ord(c) << 21 * i for i, c in enumerate(reversed(gram)))


def test_out_of_place_distances(spark):
    bank = {"el": "και το αυτό Ήταν μια", "ru": "это было в Москве и", "ja": "これは本です。それは", "en": "the And — thing of it"}
    texts = [(4 * i + k, " ".join(random.Random(i).choices(bank[lang].split(), k=20)), lang) for i in range(20) for k, lang in enumerate(bank)]
    texts += [(900, "—。12", "en"), (901, "", "en"), (902, None, "en"), (903, "x y", None)]
    table = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    learned = table.where(language.crc_bucket(F.col("doc_id"), 4) != 2)
    counts = collections.defaultdict(collections.Counter)
    for r in learned.where("lang IS NOT NULL AND text IS NOT NULL").collect():
        counts[r["lang"]] += grams_of(r["text"])
    rank = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], number(x[0])))][:300]
    profiles = {lang: rank(c) for lang, c in sorted(counts.items())}
    assert language.profiles(learned) == {lang: [number(g) for g in p] for lang, p in profiles.items()}
    for r in language.language_id(table).collect():
        own = rank(grams_of(dict((i, t) for i, t, _ in texts)[r["doc_id"]] or ""))
        if not own:
            assert (r["lang_pred"], r["score"]) == ("und", 0)
            continue
        distance = {lang: sum(abs(p.index(g) - i) if g in p else 300 for i, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(profiles, key=lambda lang: distance[lang])
        assert r["lang_pred"] == best and abs(r["score"] - (1 - distance[best] / (300 * len(own)))) < 1e-9
    assert {r["lang_pred"] for r in language.language_id(table).where("doc_id < 80").collect()} == set(bank)


def test_stages_on_empty_tables_and_odd_names(spark, tmp_path):
    """Columns named like any that the stages use stay, with their values; an empty table gives an empty result."""
    names = ["vote", "_vote", "score", "label", "row", "doc", "cls", "check", "n", "key", "size", "start", "rank", "sha", "_sha", "id", "number", "among", "block", "pass", "shard", "length", "piece"]
    rows = [(i, " ".join(f"w{j}" for j in range(i % 7, i % 7 + 20)) if i % 5 else None, "en", ["a", "b"][i % 2], 0) for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select("*", *[F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in names])
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for full, docs in ((True, table), (False, table.limit(0))):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, str(tmp_path)).write.parquet(path := str(tmp_path / f"{i}-{full}"))
            out = spark.read.parquet(path)
            if i < 4:
                assert out.columns == table.columns
                for r in out.collect():
                    assert all(r[c] == f"{c}-{r['doc_id']}" for c in names)
                docs = out
            assert (out.count() > 0) == full


def test_a_long_text(spark):
    """Texts of 1.4 MB that share all but their ends, and one word of 1 MB."""
    r = random.Random(6)
    long = " ".join(f"w{r.randrange(50_000)}" for _ in range(200_000))
    texts = {1: long + " a", 2: long + " b", 3: "z" * 1_000_000, 4: long.replace(" ", "\n") + " a"}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {x["doc_id"]: (x["start_word"], x["end_word"]) for x in suffixes.repeated_passages(table).collect()}
    assert found == {1: (0, 200_001), 2: (0, 200_000), 4: (0, 200_001)}
    assert {x["doc_id"]: x["component_id"] for x in jaccard.similar_components(table).collect()} == {1: 1, 2: 1, 3: 3, 4: 1}
    assert {x["doc_id"]: x["keep_id"] for x in exact_dedup.exact_duplicates(table).collect()} == {1: 1, 2: 2, 3: 3, 4: 1}
    media_rows = media.media_features(media.decoded(media.stored_texts(table.where("doc_id > 2")))).collect()
    assert {x["doc_id"]: x["payload_sha256"] for x in media_rows} == {i: hashlib.sha256((t := texts[i].encode()) + bytes(-len(t) % 64)).hexdigest() for i in (3, 4)}
    assert sum(x["length"] for x in packing.best_fit_pack(table.where("doc_id < 3"), IDS, with_ids=False).collect()) > 400_000
    assert tokens.count_tokens(table.where("doc_id < 3"), PIECES).where("n_tokens > 200000").count() == 2


def test_pipeline_stage_by_stage(spark, documents, tmp_path):
    """Each stage's rows on the smallest table by a plain version of it."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    quality_rows = corpus_pipeline.quality_classifier(spark, documents, SF)
    votes = {r["doc_id"]: r["predicted"] for r in quality.classify(documents, labels).collect()}
    kept = {r["doc_id"]: r["text"] for r in quality_rows.collect()}
    assert set(kept) == {i for i, p in votes.items() if p}
    quality_rows.write.parquet(str(tmp_path / "q"))
    quality_rows = spark.read.parquet(str(tmp_path / "q"))
    first = {}
    for i in sorted(kept):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", kept[i] or ""), i)
    exact_rows = corpus_pipeline.exact_deduplication(spark, quality_rows, SF)
    exact = {r["doc_id"]: r["text"] for r in exact_rows.collect()}
    assert set(exact) == set(first.values())
    near_rows = corpus_pipeline.near_deduplication(spark, exact_rows, SF)
    assert quality_rows.columns == exact_rows.columns == near_rows.columns == documents.columns and len(votes) > len(kept) > len(exact)
    near = {r["doc_id"] for r in near_rows.collect()}
    assert near == {i for i, (_, c) in brute_components(list(exact.items()), 5, 80).items() if i == c}
    rest = quality_rows.where(F.col("doc_id").isin(*near))
    mixed = corpus_pipeline.mix_to_weights(spark, rest, SF)
    mixed.write.parquet(str(tmp_path / "m"))
    mixed = spark.read.parquet(str(tmp_path / "m"))
    sizes = collections.Counter()
    for r in rest.collect():
        sizes[r["source"]] += len(words(r["text"]))
    taken = collections.Counter()
    for r in mixed.collect():
        taken[r["source"]] += len(words(r["text"]))
    assert dict(taken) == {s: round(t) for s, t in mixing.targets(dict(sizes)).items() if round(t)}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = collections.Counter()
    for r in mixed.collect():
        n = len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
        lengths.update([2048] * (n // 2048) + [n % 2048] * (n % 2048 > 0))
    packed = corpus_pipeline.pack_sequences(spark, mixed, SF).collect()
    assert collections.Counter(r["length"] for r in packed) == lengths
    sums = collections.Counter()
    for r in packed:
        sums[r["sequence_id"]] += r["length"]
    assert max(sums.values()) <= 2048 and len(sums) <= 1.05 * sum(lengths.elements()) / 2048 + 1


def test_labelled_ids_that_repeat_are_fitted_once(spark):
    rows = [(i, f"{'good' if i % 2 else 'BAD!'} text {i % 5} {k}") for i in range(12) for k in range(30)]
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(12)], "doc_id long, label double")
    voters = quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert len(voters.labels) == 12 and voters.labels.sum() == 6
