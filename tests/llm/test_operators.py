"""Every corpus operator against a brute-force version, an exact round trip or held-out rows, and on odd tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomline.llm import common, exact_dedup, graph, jaccard, language, media, mixing, packing, quality, sharding, suffixes, tokens

WORDS = "[^\x20\x09-\x0d]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, n string, cls string, shard string, tokens string"
PIECES, IDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def words(text):
    return re.findall(WORDS, text or "")


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(400)]
    texts = [None, "", "  \t ", "one", "é", "Tab\tand  spaces\n", "▁ odd ▁", "<|endoftext|> x", "a b c", "A B C", "x" * 70_000]
    base = " ".join(r.choices(vocabulary, k=150))
    passage = " ".join(r.choices(vocabulary, k=60))
    for i in range(40):
        own = r.choices(vocabulary, k=r.randint(1, 260))
        if i % 5 == 0:
            own = base.split()
            own[r.randrange(len(own))] = f"edit{i}"
        if i % 7 == 0:
            own += passage.split()
        texts.append((" " if i % 3 else "\n").join(own))
    texts += [base, base, base.replace(" ", "  "), " ".join(r.choices(vocabulary, k=9000))]
    out = [(i + 1, t, [None, "en", "fr"][i % 3], [None, "b", "a", "c"][i % 4], 0, *["x"] * 6) for i, t in enumerate(texts)]
    return [*out, out[20], out[20], (None, "no id here", None, None, 0, *["x"] * 6)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ids_and(rows):
    return sorted(((r[0], r[1]) for r in rows), key=str)


def test_media_round_trip(docs, rows, empty):
    got = media.media_features(media.decoded(media.stored_texts(docs))).collect()
    want = collections.Counter()
    for i, text in ids_and(rows):
        raw = (text or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        want[i, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])] += 1
    assert collections.Counter((r["doc_id"], r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == want
    means = {(r["doc_id"], r["media_sha256"]): r["feature"] for r in got}
    for r in media.decoded(media.stored_texts(docs)).collect():
        x = np.frombuffer(r["rgb"], np.uint8).reshape(r["height"], r["width"], 3)
        if r["height"] == 16 and r["doc_id"] in (1, 4):
            assert np.abs(x.astype(int) - direct_pixels(media.read_progressive(bytes(r["media"])))).max() <= 1
        assert means[r["doc_id"], hashlib.sha256(r["media"]).hexdigest()] == f"{r['height']}x{r['width']} rgb " + " ".join(f"{x[:, :, i].mean():.3f}" for i in range(3))
    assert media.media_features(media.decoded(media.stored_texts(empty))).count() == 0
    nothing = media.decoded(docs.limit(2).select("doc_id", F.lit(0).cast("long").alias("n_bytes"), F.lit(None).cast("binary").alias("media")))
    assert [r["feature"] for r in media.media_features(nothing).collect()] == [None, None]


def direct_pixels(image):
    """Height x width x 3, by the double sum that defines the inverse transform, nearest-neighbour upsampling and the YCbCr formula."""
    order, x, y = [], 0, 0
    while len(order) < 64:  # the zigzag walk
        order.append((y, x))
        if (x + y) % 2 == 0:
            x, y = (x, y + 1) if x == 7 else (x + 1, max(0, y - 1))
        else:
            x, y = (x + 1, y) if y == 7 else (max(0, x - 1), y + 1)
    scale = lambda k: math.sqrt(0.5) if k == 0 else 1.0
    planes = []
    for c in image.components.values():
        plane = np.zeros((c.high * 8, c.wide * 8))
        for b, block in enumerate(c.coefficients * image.quantisers[c.table]):
            for py, px in itertools.product(range(8), range(8)):
                total = sum(0.25 * scale(u) * scale(v) * v_ * math.cos((2 * py + 1) * u * math.pi / 16) * math.cos((2 * px + 1) * v * math.pi / 16) for (u, v), v_ in zip(order, block.tolist(), strict=True) if v_)
                plane[b // c.wide * 8 + py, b % c.wide * 8 + px] = min(127, max(-128, total))
        planes.append(plane)
    most_h, most_v = max(c.h for c in image.components.values()), max(c.v for c in image.components.values())
    out = np.zeros((image.height, image.width, 3), np.uint8)
    for py, px in itertools.product(range(image.height), range(image.width)):
        luma, *chroma = (p[py * c.v // most_v, px * c.h // most_h] for c, p in zip(image.components.values(), planes, strict=True))
        blue, red = chroma or (0, 0)
        for i, v in enumerate((luma + 128 + 1.402 * red, luma + 128 - 0.344136 * blue - 0.714136 * red, luma + 128 + 1.772 * blue)):
            out[py, px, i] = min(255, max(0, round(v)))
    return out


def test_pixels_of_subsampled_colour():
    """4:2:0 with coefficients that keep within the range of samples, and sides that are no multiples of a unit."""
    rng = np.random.default_rng(11)
    image = media.read_progressive(media.store_payload(rng.integers(0, 256, 64 * 20).astype(np.uint8)))
    for c in image.components.values():
        c.coefficients[:] = np.where(rng.random(c.coefficients.shape) < 0.2, rng.integers(-60, 61, c.coefficients.shape), 0)
    image.height, image.width = image.height - 5, image.width - 3
    assert np.abs(image.tensor().astype(int) - direct_pixels(image)).max() <= 1  # halves may round either way in single precision


def _general_file(restart: bool) -> tuple[bytes, np.ndarray]:
    """A grey progressive file written symbol by symbol, with runs, zero runs, end-of-band runs and new values in a refinement."""
    rng = np.random.default_rng(3)
    c = np.where(rng.random((6, 64)) < 0.15, rng.integers(-30, 31, (6, 64)), 0)
    c[2, 1:] = 0
    c[3, 60] = 9
    ac = {f"{i:08b}": s for i, s in enumerate([0, 0x10, 0x20, 0xF0, *[r << 4 | s for r in range(16) for s in range(1, 6)]])}
    code = {s: k for k, s in ac.items()}
    table = lambda kind: media._segment(0xC4, bytes([kind, *[0] * 7, len(ac), *[0] * 8, *ac.values()]))
    dc = media._segment(0xC4, bytes([0, 0, 0, 0, 8, *[0] * 12, *range(8)]))
    pack = lambda bits: media._packed(bits) if bits else b""
    mag = lambda v: format(v if v > 0 else v + (1 << abs(v).bit_length()) - 1, f"0{abs(v).bit_length()}b") if v else ""
    first, parts, before = np.sign(c) * (np.abs(c) >> 1), [], 0
    lots = [range(0, 3), range(3, 6)] if restart else [range(6)]
    for lot in lots:
        bits, before = "", 0
        for b in lot:
            v = int(c[b, 0]) >> 1
            d, before = v - before, v
            bits += format(abs(d).bit_length(), "04b") + mag(d)
        parts.append(pack(bits))
    join = lambda xs: b"".join(x + (bytes([0xFF, 0xD0 + i]) if i < len(xs) - 1 else b"") for i, x in enumerate(xs))
    out = [b"\xff\xd8", media._segment(0xDB, bytes([0, *[1] * 64])), media._segment(0xC2, bytes([8, 0, 16, 0, 24, 1, 1, 0x11, 0])), dc, table(0x10)]
    out += [media._segment(0xDD, b"\0\3")] if restart else []
    out += [media._scan_head([1], 0, 0, 0, 0, 1), join(parts)]
    parts = []
    for lot in lots:
        bits = ""
        for b in lot:
            run = 0
            last = max([k for k in range(1, 64) if first[b, k]], default=0)
            for k in range(1, last + 1):
                v = int(first[b, k])
                if not v:
                    run += 1
                    continue
                while run > 15:
                    bits += code[0xF0]
                    run -= 16
                bits += code[run << 4 | abs(v).bit_length()] + mag(v)
                run = 0
            bits += code[0] if last < 63 else ""
        parts.append(pack(bits))
    out += [media._scan_head([1], 0, 1, 63, 0, 1), join(parts)]
    parts = []
    for lot in lots:
        bits = ""
        for b in lot:
            run, held = 0, ""
            new = max([k for k in range(1, 64) if abs(c[b, k]) == 1], default=0)
            for k in range(1, 64):
                v = int(c[b, k])
                if abs(v) > 1:
                    held += str(abs(v) & 1)
                elif abs(v) == 1:
                    bits += code[run << 4 | 1] + ("1" if v > 0 else "0") + held
                    run, held = 0, ""
                elif k <= new:
                    run += 1
                    if run == 16:
                        bits, run, held = bits + code[0xF0] + held, 0, ""
            bits += code[0] + held if new < 63 else held
        parts.append(pack(bits))
    out += [media._scan_head([1], 0, 1, 63, 1, 0), join(parts)]
    dc_bits = [pack("".join(str(int(c[b, 0]) & 1) for b in lot)) for lot in lots]
    out += [media._scan_head([1], 0, 0, 0, 1, 0), join(dc_bits), b"\xff\xd9"]
    return b"".join(out), c


@pytest.mark.parametrize("restart", [False, True])
def test_general_progressive_file(restart):
    data, c = _general_file(restart)
    image = media.read_progressive(data)
    assert (next(iter(image.components.values())).coefficients == c).all()
    assert image.tensor().shape == (16, 24, 3) and np.abs(image.tensor().astype(int) - direct_pixels(image)).max() <= 1
    with pytest.raises(ValueError):
        media.read_progressive(b"\x89PNG")


def test_sharding(docs, rows, empty):
    got = sharding.vector_shards(docs, shards=4).collect()
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ids_and(rows))
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert sharding.vector_shards(empty, shards=4).count() == 0


def test_placement_balances_all_dimensions():
    items = np.random.default_rng(1).lognormal(0, 1, (4000, 3))
    items /= items.sum(axis=0) / 10
    left = np.ones((10, 3))
    sharding.place(items, left)
    assert np.abs(left).max() < 0.02


def test_quality(spark, docs, empty):
    r = random.Random(1)
    good = [(i, " ".join(r.choices(["alpha", "beta", "gamma", "delta"], k=30))) for i in range(60)]
    bad = [(100 + i, " ".join(r.choices(["XX!!", "YY!!", "ZZ!!"], k=30))) for i in range(60)]
    table = spark.createDataFrame([*good, *bad], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in good + bad] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(table, labels).collect()
    assert all(x["predicted"] == int(x["doc_id"] < 100) and x["held_out"] == (zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1) for x in got)
    odd = quality.classify(docs, labels.limit(0)).collect()
    assert len(odd) == docs.count() and {x["score"] for x in odd} == {0.5}
    assert all(0 <= x["score"] <= 1 for x in quality.classify(docs, labels).collect())
    assert quality.classify(empty, labels).count() == 0
    assert sorted(x["doc_id"] for x in quality.accepted(table, labels).collect()) == [i for i, _ in good]


def brute_components(rows, k, percent):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, text in rows:
        w = words((text or "").translate(low))
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components(docs, rows, k, percent):
    got = jaccard.similar_components(docs, k, percent).collect()
    want = brute_components([x for x in ids_and(rows) if x[0] is not None], k, percent)
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want


def test_jaccard_empty_and_filter(docs, empty, rows):
    assert jaccard.similar_components(empty).count() == 0
    kept = jaccard.one_per_component(docs).collect()
    want = {i for i, (_, c) in brute_components([x for x in ids_and(rows) if x[0] is not None], 5, 80).items() if i == c}
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(want)


def test_blocks_agree_with_sets():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, 50).astype(np.uint64)) for _ in range(40)]
    want = {(i, j) for i, j in itertools.product(range(20), range(20)) if 100 * len(np.intersect1d(sets[i], sets[20 + j])) >= 50 * len(np.union1d(sets[i], sets[20 + j]))}
    for part in (want, set()):
        root = list(range(40))
        for _ in range(40):
            for i, j in part:
                root[i] = root[20 + j] = min(root[i], root[20 + j])
        got = jaccard.link_blocks(sets[:20], sets[20:], 50 if part else 99)
        assert dict(got) == {i: r for i, r in enumerate(root) if i != r} and len(dict(got)) == len(got)
    assert want


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (7, 7)], "a long, b long")
    assert {r["node"]: r["root"] for r in graph.components(edges).collect()} == {**{i: 0 for i in range(1, 31)}, 101: 100}


def test_mixing(docs, rows, empty):
    got = mixing.mix_sources(docs, block=16, shards=4).collect()
    sizes = collections.Counter()
    for x in rows:
        sizes[x[3]] += len(words(x[1]))
    want = mixing.targets(dict(sizes))
    assert abs(sum(want.values()) - sum(sizes.values())) < 1e-6 and all(want[s] <= 3 * sizes[s] + 1e-6 for s in sizes)
    taken = collections.Counter()
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == round(want[s]) for s in sizes)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_sources(docs, block=16, shards=4).collect()), key=str)
    mixed = mixing.mixed_documents(docs, block=16, shards=4).collect()
    assert sum(len(words(r["text"])) for r in mixed) == sum(r["taken"] for r in got)
    texts = {(x[0], tuple(words(x[1]))) for x in rows}
    assert all(any(i == r["doc_id"] and set(words(r["text"])) <= set(t) for i, t in texts) for r in mixed)
    assert mixing.mix_sources(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 1000):
        got = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 9))
        assert sorted(got) == list(range(n))


def test_language(spark, docs, empty):
    r = random.Random(4)
    bank = {"en": ["the", "and", "thing", "with"], "de": ["und", "der", "schön", "größe"], "fr": ["le", "été", "où", "ça"]}
    table = spark.createDataFrame([(i, " ".join(r.choices(bank[lang], k=25)), lang) for i, lang in enumerate(list(bank) * 30)] + [(900, None, "en"), (901, "12 34", "en")], "doc_id long, text string, lang string")
    got = {x["doc_id"]: x for x in language.language_id(table).collect()}
    assert all(got[i]["lang_pred"] == lang for i, lang in enumerate(list(bank) * 30))
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and all(0 <= x["score"] <= 1 for x in got.values())
    assert language.language_id(docs).count() == docs.count() and language.language_id(empty).count() == 0


def test_token_counts(docs, rows, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = collections.Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.count_tokens(docs, PIECES).collect())
    want = collections.Counter()
    for i, t in ids_and(rows):
        n = len(model.encode(t or ""))
        want[i, len((t or "").encode()), n, n > 4096] += 1
    assert got == want and tokens.count_tokens(empty, PIECES).count() == 0


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(IDS)
    got = packing.best_fit_pack(docs, IDS, capacity=256).collect()
    want = collections.Counter()
    for i, t in ids_and(rows):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 256)):
            part = ids[at : at + 256]
            want[i, k, at, len(part), zlib.crc32(part.tobytes()), tuple(part.tolist())] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= 1.05 * sum(r["length"] for r in got) / 256 + 1
    assert packing.best_fit_pack(empty, IDS).count() == 0


def test_plan_equals_best_fit_one_by_one():
    r = random.Random(8)
    lengths = sorted((r.randint(1, 50) for _ in range(500)), reverse=True)
    rooms: list[int] = []
    for x in lengths:
        fit = min((i for i, room in enumerate(rooms) if room >= x), key=lambda i: rooms[i], default=None)
        if fit is None:
            rooms.append(50 - x)
        else:
            rooms[fit] -= x
    plan = packing.plan_best_fit(dict(collections.Counter(lengths)), 50)
    assert max(first + n for *_, first, n, _ in plan) == len(rooms)


def test_rank_buckets_hold_every_rank_once():
    rng = np.random.default_rng(4)
    histogram = collections.Counter((rng.lognormal(3, 1, 20_000).astype(int) % 256 + 1).tolist())
    plan = packing.plan_best_fit(histogram, 256)
    entries, width = packing.by_rank_bucket(plan, histogram)
    assert len(entries) < 2 * len(plan)
    found = collections.Counter()
    tried = 0
    held = collections.defaultdict(list)
    for entry in entries:
        held[entry[0], entry[6]].append(entry)
    for length, n in histogram.items():
        for rank in range(n):
            near = held[length, rank // width[length]]
            tried += len(near)
            found[sum(e[1] <= rank < e[2] for e in near)] += 1
    assert set(found) == {1} and tried < 3 * sum(histogram.values())
    assert packing.by_rank_bucket([], {}) == ([], {})


def brute_stretches(texts):
    """(doc_id, start, end) of what runs of 50 words that another document has make up. texts: doc_id to words."""
    where = collections.defaultdict(set)
    for i, w in texts.items():
        for j in range(len(w) - 49):
            where[tuple(w[j : j + 50])].add(i)
    out = set()
    for i, w in texts.items():
        covered = np.zeros(len(w) + 2, bool)
        for j in range(len(w) - 49):
            if len(where[tuple(w[j : j + 50])]) > 1:
                covered[j + 1 : j + 51] = True
        edges = np.flatnonzero(covered[1:] != covered[:-1])
        out |= {(i, int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)}
    return out


def stretches(docs):
    rows = [(r["doc_id"], r["start_word"], r["end_word"]) for r in docs.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_repeated_passages(docs, rows, empty):
    want = brute_stretches({x[0]: words(x[1]) for x in rows if x[0] is not None})
    assert stretches(suffixes.repeated_passages(docs)) == want and want
    assert suffixes.repeated_passages(empty).count() == 0


def test_passages_put_together_from_several_documents(spark):
    """Texts that share 40 words each with two others, on end or overlapping, share no run of 50; of near copies some do."""
    r = random.Random(12)
    texts = {}
    for case in range(60):
        base = [f"m{case}_{i}" for i in range(70)]
        own = lambda n: [f"o{r.random()}" for _ in range(n)]  # noqa: E731, B023
        texts[10 * case] = own(25) + base + own(25)
        texts[10 * case + 1] = own(20) + base[:40] + own(20)
        texts[10 * case + 2] = own(30) + base[30:] + own(5)
        for k in range(3, 3 + case % 5):
            copy = list(texts[10 * case])
            for _ in range(r.randint(1, 4)):
                copy[r.randrange(len(copy))] = f"edit{r.random()}"
            texts[10 * case + k] = copy
    texts |= {1000: ["a"] * 300, 1001: ["b"] + ["a"] * 120, 1002: ["c", "d"] * 90, 1003: ["d", "c"] * 40}
    got = stretches(suffixes.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string").repartition(5)))
    assert got == brute_stretches(texts)


def test_common_passage_over_many_tasks(spark):
    """A passage in all documents, dealt over more tasks than it has documents in some of them; ids of two rows."""
    passage = [f"p{i}" for i in range(64)]
    texts = {i: [f"x{i}_{j}" for j in range(i % 7)] + passage[i % 3 :] + [f"y{i}"] for i in range(200)}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()] * 2, "doc_id long, text string")
        assert stretches(suffixes.repeated_passages(table)) == brute_stretches(texts)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_passage_twice_in_a_text(spark):
    r, rows, want = random.Random(8), [], {}
    for case in range(120):
        passage = [f"p{case}_{i}" for i in range(50 + case % 20)]
        for doc, copies in ((2 * case, 2), (2 * case + 1, 1)):
            text = []
            for _ in range(copies):
                text += [f"w{r.random()}" for _ in range(30)]
                want[doc, len(text)] = len(text) + len(passage)
                text += passage
            rows.append((doc, " ".join([*text, f"end{doc}"])))
    got = suffixes.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(x["doc_id"], x["start_word"]): x["end_word"] for x in got} == want and len(got) == len(want)


def test_near_copies_of_a_passage(spark):
    r, rows, want = random.Random(9), [], set()
    for case in range(60):
        passage = [f"p{case}_{i}" for i in range(50 + case % 16)]
        for copy in range(8):
            doc, own = 10 * case + copy, list(passage)
            if copy > 1:
                own[r.choice([r.randrange(6), len(own) - 1 - r.randrange(6)])] = f"edit{doc}"
            else:
                want |= {(doc, 40 + i) for i in range(len(own))}
            rows.append((doc, " ".join([*(f"a{doc}_{i}" for i in range(40)), *own, *(f"b{doc}_{i}" for i in range(40))])))
    got = suffixes.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {(x["doc_id"], i) for x in got for i in range(x["start_word"], x["end_word"])}
    assert want <= spans and {(x["doc_id"], x["start_word"], x["end_word"]) for x in got} == brute_stretches({i: t.split() for i, t in rows})


def test_neighbours_over_task_edges():
    r = random.Random(3)

    def met(rows):
        columns = list(zip(*rows, strict=True)) or [()] * 3
        at = sorted(r.choices(range(len(rows) + 1), k=2))
        batches = [pa.RecordBatch.from_arrays([pa.array(c[a:b], pa.int64()) for c in columns], ["run", "doc_id", "start"]) for a, b in itertools.pairwise([0, *at, len(rows)])]
        return [tuple(x.values()) for part in suffixes._neighbours(iter(batches), ["run"], "start") for x in part.to_pylist()]

    for _ in range(500):
        rows = sorted({(r.randrange(4), r.randrange(3), r.randrange(5)) for _ in range(r.randint(0, 20))})
        cuts = [0, *sorted(r.choices(range(len(rows) + 1), k=3)), len(rows)]
        found = [x for a, b in itertools.pairwise(cuts) for x in met(rows[a:b])]
        edges = collections.defaultdict(set)
        for run, low, high, kind, _ in found:
            if kind == 2:
                edges[run] |= {low, high}
        got = sorted(x[:3] for x in found if x[3] == 0 or x[3] == 1 and len(edges[x[0]]) > 1)
        assert got == [x for x in rows if len({d for k, d, _ in rows if k == x[0]}) > 1]


def test_exact_dedup(docs, rows, empty):
    got = exact_dedup.exact_duplicates(docs).collect()
    groups = collections.defaultdict(list)
    for i, t in ids_and(rows):
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    want = collections.Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        for n, i in enumerate(sorted(ids, key=lambda i: (i is None, i or 0))):
            want[i, keep, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
    assert collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got) == want
    left = exact_dedup.deduplicated(docs)
    assert left.columns == docs.columns and left.count() == len(groups) and exact_dedup.exact_duplicates(empty).count() == 0


def test_equal_fingerprints_of_different_texts(spark, monkeypatch):
    table = spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "ab"), (4, "cd"), (5, "ef"), (None, "cd"), (None, "gh"), (None, "gh")], "doc_id long, text string")
    real = exact_dedup.fingerprints
    monkeypatch.setattr(exact_dedup, "fingerprints", lambda d: real(d).withColumn("fp1", F.lit(1).cast("long")).withColumn("fp2", F.lit(1).cast("long")))
    chunks = exact_dedup.text_chunks
    monkeypatch.setattr(exact_dedup, "text_chunks", lambda d: chunks(d).withColumn("fp1", F.lit(1).cast("long")).withColumn("fp2", F.lit(1).cast("long")))
    got = collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_duplicates(table).collect())
    assert got == collections.Counter([(1, 1, 2, True), (3, 1, 2, False), (2, 2, 3, True), (4, 2, 3, False), (5, 5, 1, True), (None, 2, 3, False), (None, None, 2, True), (None, None, 2, False)])


def test_fingerprints_of_long_texts_by_parts(docs):
    columns = ["doc_id", "text_sha256", *exact_dedup.KEY]
    whole = collections.Counter(map(tuple, exact_dedup.fingerprints(docs).select(columns).collect()))
    parts = exact_dedup.fingerprints(docs, long=700)
    assert collections.Counter(map(tuple, parts.select(columns).collect())) == whole and parts.select("row").distinct().count() == docs.count()


def test_white_space_over_parts():
    r = random.Random(4)
    for _ in range(300):
        text = "".join(r.choices("ab \n\t", k=r.randint(0, 40))).encode()
        want = re.sub(rb"[\x20\x09-\x0d]+", b" ", text)
        parts = list(exact_dedup.normal_parts(np.frombuffer(text, np.uint8), 7))
        assert b"".join(parts) == want and all(len(x) == 7 for x in parts[:-1]) and parts


def test_dedup_leaves_other_columns_alone(spark):
    table = spark.createDataFrame([(1, "a", "p"), (1, "b", "q"), (2, "a", "r"), (None, "a", "s"), (None, "c", "t"), (None, "c", "u")], "doc_id long, text string, _sha string")
    table = table.select("*", *[F.col("_sha").alias(c) for c in ("_id", "_s", "sha", "id", "doc", "text_sha", "row", "number", "no_id", "within", "first")])
    got = exact_dedup.deduplicated(table)
    assert got.columns == table.columns and sorted((r["text"], r["_sha"]) for r in got.collect())[:2] == [("a", "p"), ("b", "q")] and got.count() == 3
    assert exact_dedup.deduplicated(table.limit(0)).count() == 0


def test_fingerprints_compose():
    text = np.frombuffer(random.Random(1).randbytes(1000), np.uint8)
    assert exact_dedup.fingerprint(text) == exact_dedup.fingerprint(text, chunk=64)
    whole = 0
    for b in text.tolist():
        whole = (whole * exact_dedup.BASES[0] + b) % exact_dedup.PRIMES[0]
    assert exact_dedup.fingerprint(text, chunk=64)[0] == whole


def test_repeated_ids_keep_other_texts(spark):
    r = random.Random(2)
    a, b, c = (" ".join(f"{x}{r.random()}" for _ in range(60)) for x in "abc")
    near = a + " more"
    copied = spark.createDataFrame([(1, a), (5, a), (5, b), (6, b), (7, c)], "doc_id long, text string")
    assert sorted(map(tuple, exact_dedup.deduplicated(copied).collect())) == sorted([(1, a), (5, b), (7, c)])
    unique = spark.createDataFrame([(1, a), (5, a), (5, b)], "doc_id long, text string")
    assert sorted(map(tuple, exact_dedup.deduplicated(unique).collect())) == sorted([(1, a), (5, b)])
    alike = spark.createDataFrame([(1, a), (5, near), (5, b), (5, c), (6, c + " more"), (6, ""), (7, b)], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.one_per_component(alike).collect())) == sorted([(1, a), (5, b), (5, c), (6, "")])
    linked = spark.createDataFrame([(5, a), (5, near), (5, a), (7, b)], "doc_id long, text string")
    assert sorted(x["doc_id"] for x in jaccard.one_per_component(linked).collect()) == [5, 7]


def test_quality_vectors_know_no_neighbours():
    def vectors(texts):
        return quality.trigram_vectors(np.frombuffer("".join(texts).encode(), np.uint8), np.r_[0, np.cumsum([len(x) for x in texts])])

    texts = ["one", "one", "", "one", "one two two", "two", "two two", "   ", "two", ""]
    assert np.array_equal(vectors(texts), np.concatenate([vectors([x]) for x in texts]))


def thue_morse(a, b, n=1024):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_words_that_running_sums_confuse(spark):
    """Thue-Morse words and their complements, whose polynomial hashes modulo 2^64 are equal."""
    import sentencepiece
    from tokenizers import Tokenizer

    texts = [f"{thue_morse(a, b)} {thue_morse(b, a)}" for a, b in ("a7", "ex", "te", "ta", "xa", "za", "ab")] + [thue_morse("a", "b"), thue_morse("b", "a")]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, tokenizer = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(IDS)
    assert {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(table, PIECES).collect()} == {i: len(model.encode(t)) for i, t in enumerate(texts)}
    got = collections.defaultdict(dict)
    for r in packing.best_fit_pack(table, IDS).collect():
        got[r["doc_id"]][r["piece"]] = r["ids"]
    assert {i: [x for k in sorted(p) for x in p[k]] for i, p in got.items()} == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["component_id"] for r in jaccard.similar_components(table, 3, 90).collect()} == {i: i for i in range(len(texts))}


def test_memo_tells_words_of_one_hash_apart(monkeypatch):
    """With a first hash of two bits, words still come out by their own."""
    from loomline.llm import common

    real = common.span_hash_pairs
    monkeypatch.setattr(common, "span_hash_pairs", lambda *a: (real(*a)[0] & np.uint64(3), real(*a)[1]))
    monkeypatch.setattr(tokens, "_ids", {})
    encode = tokens.word_encoder(IDS)
    for text in ("some words here and some words there", "other words where some are new", "some new words"):
        data = np.frombuffer(text.encode(), np.uint8)
        ids, at = tokens.encode_ids(data, np.array([0, len(data)]), IDS)
        assert ids.tolist() == [x for w in text.split() for x in encode(w)] and at.tolist() == [0, len(ids)]


def test_sets_that_share_a_class_name(docs, rows):
    """With six bits for a class's name, most are shared, and told apart by the second hash."""
    got, shared = jaccard.class_components(docs, 5, 80, bits=6)
    assert shared.count() > 3
    want = brute_components([x for x in ids_and(rows) if x[0] is not None], 5, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect() if r["doc_id"] is not None} == want


@pytest.mark.parametrize("edits", [1])
def test_large_group_of_near_copies(spark, edits):
    """1500 copies of a text of 60 words with a word changed: below the threshold for most pairs, above it for some; and links stay few."""
    r = random.Random(edits)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(1500):
        own = list(base)
        for _ in range(edits):
            own[r.randrange(60)] = f"e{r.randrange(40)}"
        rows.append((i, " ".join(own)))
    sets = [{tuple(w[j : j + 5]) for j in range(56)} for w in (t.split() for _, t in rows)]
    known = {x: k for k, x in enumerate(set().union(*sets))}
    matrix = np.zeros((len(sets), len(known)), np.float32)
    for i, s in enumerate(sets):
        matrix[i, [known[x] for x in s]] = 1
    both = matrix @ matrix.T
    size = matrix.sum(axis=1)
    linked = 100 * both >= 80 * (size[:, None] + size[None, :] - both)
    root = np.arange(len(sets))
    while True:
        new = np.where(linked, root[None, :], len(sets)).min(axis=1)
        if (new == root).all():
            break
        root = new
    got = {x["doc_id"]: x["component_id"] for x in jaccard.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), 5, 80).collect()}
    assert got == dict(enumerate(root.tolist()))


def test_small_tables_take_no_python_workers(spark):
    """An RDD of Python rows would have each executor start and keep a second set of workers."""
    kinds = {"a": pa.string(), "b": pa.list_(pa.int64())}
    made = common.small_table(spark, [("x", [1, 2]), ("y", [])], kinds)
    assert sorted(map(tuple, made.collect())) == [("x", [1, 2]), ("y", [])]
    assert common.small_table(spark, [], kinds).collect() == [] and common.small_table(spark, [], kinds).columns == ["a", "b"]
    assert "ExistingRDD" not in made._jdf.queryExecution().executedPlan().toString()
