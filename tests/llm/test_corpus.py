"""The corpus operators against brute force, exact round trips, held-out accuracy, and odd rows."""

import collections
import hashlib
import itertools
import json
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, mismatch
from tillwork.llm import ORACLE, QUERIES, bpe, contamination, embeddings, language, licenses, neardup, quality, repeats
from tillwork.llm import common, sharding, toolcalls
from tillwork.llm.common import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, rid long, shard int"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Writes rows to files and reads them back."""

    def store(rows, schema):
        path = str(tmp_path_factory.mktemp("rows"))
        spark.createDataFrame(rows, schema).repartition(3).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return store


@pytest.fixture(scope="module")
def odd(stored):
    """Null and empty texts, null and repeated ids, ties, a very long text, clashing columns."""
    texts = [None, "", " ", "word", "the same five words here again", "the same five words here again", "long words " * 20000, "ÄÖ $$", "𝒳"]
    rows = [(i, t, "en", "s", 1, "x", 7, 3) for i, t in enumerate(texts)]
    rows += [(None, "no id at all in this row", None, None, None, None, None, None), (4, texts[4], "en", "s", 1, "x", 7, 3)]
    return stored(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(stored):
    return stored([], SCHEMA)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twins(spark, folder, name):
    assert mismatch(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) is None


def test_components(spark):
    links = [(i, i + 1) for i in range(60) if i != 30] + [(80, 81), (81, 80), (90, 90)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(31)}, **{i: 31 for i in range(31, 61)}, 80: 80, 81: 80}


def test_shards(spark, folder, odd, none):
    rows = QUERIES["op8_byte_shards"](spark, folder).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert all(r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    assert len(rows) == len(texts)
    rows.sort(key=lambda r: r.doc_id)
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)
    for _, own in collections.defaultdict(list, {s: [r.slot for r in rows if r.shard == s] for s in range(24)}).items():
        assert own == list(range(len(own)))
    total, most = sum(r.size for r in rows), max(r.size for r in rows)
    for s in range(24):
        assert abs(sum(r.size for r in rows if r.shard == s) - total / 24) <= most
    assert sharding.byte_shards(odd).count() == odd.count()
    assert sharding.byte_shards(none).count() == 0


def test_bpe_agrees_with_the_library(spark, folder, odd, none):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(bpe.default_tokenizer())
    coder, rng = bpe.ChunkCoder(bpe.default_tokenizer(), words=50, chunk_bytes=20_000), random.Random(1)
    parts = ["a", "B", "é", "é", " ", "\n", "\t", "\x1c", "\x85", "\xa0", "<|endoftext|>", "<|start", "'s", "12", "東京", "Σ", "İ", "́", "!?", "x" * 50, "\x00", "😀"]
    for n in range(200):
        text = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 5, 50, 500, 2500])))
        text = re.sub(r"\s", "", text) if n % 3 == 0 else text
        want = plain.encode(text, add_special_tokens=False).ids
        ids = coder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert coder.decode(ids) == plain.decode(want, skip_special_tokens=False)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op6_bpe"](spark, folder).collect():
        want = plain.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(plain.decode(want, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_documents(odd).where("ids is null or decoded is null").count() == 0
    assert bpe.encode_documents(none).count() == 0


def test_language(spark, folder, odd, none):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op3_language_id"](spark, folder).join(docs, "doc_id").where("held_out").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.95
    assert not found.rejected.any()
    model = language.fit(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = language.identify(odd, model).collect()
    assert len(rows) == odd.count()
    assert {r.lang_pred for r in rows if r.doc_id in (0, 1, 2)} == {"und"} and all(r.rejected for r in rows if r.doc_id in (0, 1, 2))
    assert language.identify(none, model).count() == 0
    assert {r.lang_pred for r in language.identify(odd, language.fit(none)).collect()} == {"und"}


def test_quality(spark, folder, odd, none):
    folder = folder.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = QUERIES["op5_quality"](spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    assert (found.quality == found.predicted).mean() > 0.9
    model = quality.fit(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    rows = quality.score_quality(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score_quality(none, model).count() == 0
    assert {r.score for r in quality.score_quality(odd, quality.fit(none, labels)).collect()} == {0.5}


def test_models_of_repeated_and_null_ids(spark, stored):
    """Samples don't depend on the order of rows, and rows that are repeated or have no id are learned from once."""
    texts = [f"word{i} plain words of number {i} again and again" * (1 + i % 3) for i in range(60)]
    rows = [(i % 20 if i % 7 else None, t, "en" if i % 2 else "fr", i % 2) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, quality int"
    one, other = stored(rows * 3, schema), stored((rows * 3)[::-1], schema)
    a, b = (language.fit(x) for x in (one, other))
    assert np.array_equal(a.centroids, b.centroids) and np.array_equal(a.least, b.least) and a.languages == b.languages
    a, b = (quality.fit(x, x.select("doc_id", "quality")) for x in (one, other))
    assert np.array_equal(a.idf, b.idf) and np.array_equal(a.voters, b.voters) and np.array_equal(a.labels, b.labels)
    holding = (quality.counts([t.encode() for t in texts * 3]) > 0).sum(axis=0)
    assert np.allclose(a.idf, np.log(181 / (1 + holding)) + 1)
    assert language.annotate(one.selectExpr("text", "1 as score", "2 as lang_pred"), language.fit(one), "text").columns == ["text", "lang_pred", "score", "rejected"]


def test_contamination(spark, folder, odd, none):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    words = {r.item_id: " ".join(contamination.words_of(r.text)) for r in items.collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = {(r.doc_id, i) for r in docs.collect() for i, w in words.items() if w in " ".join(contamination.words_of(r.text))}
    found = contamination.find_leaks(docs, items).collect()
    assert want and {(r.doc_id, r.item_id) for r in found} == want
    assert contamination.find_leaks(odd, items).count() == 0 and contamination.find_leaks(none, items).count() == 0
    assert contamination.find_leaks(docs, items.where("false")).count() == 0
    long_items = spark.createDataFrame([(1, "alpha beta gamma delta. " * 40), (2, None), (3, "")], "item_id long, text string")
    held = spark.createDataFrame([(5, "before " * 70 + "alpha beta gamma delta. " * 40)], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in contamination.find_leaks(held, long_items).collect()] == [(5, 1)]


def test_contamination_of_edited_items_and_slices(spark, folder, monkeypatch):
    question = [f"ask{i}" for i in range(30)]
    short = spark.createDataFrame([(1, " ".join(question) + "? one two three four.")], "item_id long, text string")
    question[12] = "other"
    held = spark.createDataFrame([(5, " ".join(question) + "? one two other four.")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in contamination.find_leaks(held, short).collect()] == [(5, 1)]
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    docs = spark.createDataFrame([(r.item_id, r.text) for r in items.collect()], "doc_id long, text string")
    found = contamination.find_leaks(docs, items).collect()
    monkeypatch.setattr(contamination, "SLICE_BYTES", 3000)
    known = [k for _, k in contamination.slices(items, "item_id", "text")]
    whole = contamination.statistics_of([t for (t,) in items.select("text").distinct().collect()])
    assert len(known) > 1 and all((k.items, k.words) == (whole.items, whole.words) for k in known)
    assert all(whole.holding[w] == n for k in known for w, n in k.holding.items())
    cut = contamination.find_leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id, r.passages, round(r.score, 9)) for r in found} == {(r.doc_id, r.item_id, r.passages, round(r.score, 9)) for r in cut}


def test_vectors(spark, stored):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((30, 16))
    rows = [(i, (base[i % 30] + 0.03 * rng.standard_normal(16) * (i % 4)).astype("f4").tolist(), i % 2) for i in range(240)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, rows[0][1], None), (304, [], 0), (None, rows[3][1], 1)]
    rows += [(305, [1.0, 2.0], 0), (306, [1.0, 2.0], 0), (306, [1.0, 2.0], 0)]
    found = embeddings.link_vectors(stored(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert len(found) == len(rows)
    ids = [r for r in rows if r[1] and len(r[1]) == 16 and r[2] is not None and np.isfinite(r[1]).all() and any(r[1])]
    values = np.array([r[1] for r in ids], dtype=float)
    values /= np.linalg.norm(values, axis=1, keepdims=True)
    near = (values @ values.T >= 0.98) & (np.array([r[2] for r in ids])[:, None] == np.array([r[2] for r in ids]))
    want = {r[0]: int(n) - 1 for r, n in zip(ids, near.sum(axis=1), strict=True)} | {300: 0, 301: 0, 302: 0, 303: 0, 304: 0, 305: 2, 306: 2}
    got = {r.vec_id: r.n_links for r in found}
    assert got == want
    assert {r.component_id for r in found if r.vec_id in (305, 306)} == {305}
    assert embeddings.link_vectors(stored([], "vec_id long, embedding array<float>, label int")).count() == 0


def _pairs_at(cosine, n, dimensions, seed):
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    left, other = unit(rng.standard_normal((n, dimensions))), rng.standard_normal((n, dimensions))
    other = unit(other - (other * left).sum(axis=1, keepdims=True) * left)
    return left, cosine * left + np.sqrt(1 - cosine**2) * other


@pytest.mark.parametrize("dimensions", [64, 768])
def test_lattice_cells_find_pairs_and_stay_apart(dimensions):
    """The farthest pairs that count are found; unrelated vectors met stay few up to the size that a level serves."""
    for level in embeddings.LEVELS:
        left, right = (embeddings.lattice_cells(x, level) for x in _pairs_at(0.98, 2000, dimensions, 4))
        assert (left[:, :, :, None] == right[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= 0.99
        met = [(left[:, :, :, None] == np.roll(right, by, axis=0)[:, :, None, :]).any(axis=(1, 2, 3)).mean() for by in range(1, 16)]
        assert np.mean(met) * min(level.most, 200_000) < 40


def test_vectors_of_labels_on_several_levels(spark, stored, monkeypatch):
    """Labels of different sizes, hashed with different numbers of tables, against brute force."""
    monkeypatch.setattr(embeddings, "LEVELS", tuple(embeddings.Level(most, x.tables, x.scale) for most, x in zip((30, 90, float("inf")), embeddings.LEVELS)))
    left, right = _pairs_at(0.985, 120, 24, 5)
    labels = ["few"] * 10 + ["some"] * 40 + ["many"] * 70
    rows = [(2 * i + side, x[i].tolist(), labels[i]) for i in range(120) for side, x in enumerate((left, right))]
    found = embeddings.link_vectors(stored(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == {i: (1, i - i % 2) for i in range(240)}


def test_near_duplicates(spark, folder, odd, none, monkeypatch):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sets = {}
    for r in docs.collect():
        w = re.findall(r"\w+", (r.text or "").lower())
        sets[r.doc_id] = collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None
    group = {i: i for i in sets}
    ids = sorted(i for i, s in sets.items() if s)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = sum((sets[a] & sets[b]).values())
            if both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                x, y = group[a], group[b]
                group = {i: min(x, y) if g in (x, y) else g for i, g in group.items()}
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == group
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 2)
    monkeypatch.setattr(neardup, "PIVOTS", 1)
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == group
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert sum(r.kept for r in rows if r.class_id == 4) == 1 and sum(r.class_id == 4 for r in rows) == 3
    assert neardup.near_duplicates(none).count() == 0


def test_near_duplicates_of_long_repetitive_texts(stored):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    texts = []
    for n in range(60):
        line, times, own = [word() for _ in range(10)], (40, 60, 100, 200)[n % 4], (36, 70, 100, 200)[n % 4]
        texts += [" ".join(line * times + [word() for _ in range(own)]) for _ in range(2)]  # the line carries the weight
        texts += [" ".join(line * (times // 2) + [word() for _ in range(5 * times)])]
    bags = []
    for t in texts:
        w = t.split()
        bags.append(collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)))
    want = {i: i for i in range(len(texts))}
    for b in range(1, len(bags), 3):
        both = sum((bags[b] & bags[b - 1]).values())
        assert 0.8 <= both / (bags[b] | bags[b - 1]).total() <= 0.9
        want[b] = b - 1
    assert all((bags[a] & bags[b]).total() < 0.8 * (bags[a] | bags[b]).total() for b in range(len(bags)) for a in range(b) if want[b] != a)
    docs = stored(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == want


def test_near_duplicates_weigh_by_document_frequency(stored, monkeypatch):
    """Boilerplate of a tenth of all texts does not link them; frequencies are those of different texts, in any cut."""
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))
    notice = words(220)
    texts = [f"{notice} {words(20)}" for _ in range(40)] + [words(240) for _ in range(360)]
    near = range(50, 60)  # nine tenths of another text come back
    texts[400:] = [texts[n].rsplit(" ", 12)[0] + " " + words(12) for n in near]
    texts += texts[:40] * 2  # copies count once
    docs = stored([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    want = {n: n for n in range(len(texts))} | {b: a for b, a in zip(range(400, 410), near)} | {410 + n: n % 40 for n in range(80)}
    bags = [collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (t.split() for t in texts[:410])]
    held = collections.Counter(s for bag in bags for s in bag)
    assert (bags[0] & bags[1]).total() >= 0.8 * (bags[0] | bags[1]).total()  # term frequencies alone would link them
    for parts in (1 << 30, 20_000):
        monkeypatch.setattr(neardup, "PART_BYTES", parts)
        assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == want
    rows = stored([(n // 100, n, t) for n, t in enumerate(texts[:410])], "chunk long, rid long, text string")
    for r in neardup.signatures(rows, 7, 410).collect():
        keys = neardup.shingle_hashes([texts[r.rid]], neardup.SHINGLE)[0]
        counts = neardup.unpacked(r.held, np.uint32)[np.searchsorted(np.unique(keys), keys)]
        w = texts[r.rid].split()
        assert counts.tolist() == [held[tuple(w[i : i + 5])] for i in range(len(w) - 4)]
    weights = neardup.frequency_weights(np.array([1, 2, 5, 41, 410]), 410)
    assert weights[0] == neardup.PLAIN and (np.diff(weights) < 0).all()


def test_groups_of_near_copies_keep_their_weight(stored):
    """A hundredth of all texts are near copies of each other, in a corpus in which their number is no small one."""
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(n))
    base = words(120)
    texts = [f"{base} {words(13)}" for _ in range(40)] + [words(20) for _ in range(3960)]
    bags = [collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (t.split() for t in texts[:40])]
    assert 0.8 < (bags[0] & bags[1]).total() / (bags[0] | bags[1]).total() < 0.82
    docs = stored(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == {n: n if n >= 40 else 0 for n in range(4000)}
    for total in (10_000, 1_000_000, 100_000_000):  # the same share weighs the same, a tenth much less than one text
        weights = neardup.frequency_weights(np.array([0.005, 0.01, 0.1, 1.0]) * total, total) / neardup.PLAIN
        assert weights[0] > 0.99 and weights[1] > 0.97 and weights[2] < 0.61 and weights[3] < 0.18


def test_bands_of_uneven_frequencies():
    """Shared shingles that weigh more or less than the others, in texts drawn from bins."""
    rng = np.random.default_rng(6)
    low = float(neardup.inverse_frequency(1.0))
    for shared, other in ((neardup.PLAIN, low), (low, neardup.PLAIN)):
        found = 0
        for n in range(200):
            keys = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
            a = 140 + n
            own = int(0.24 * a * shared / other / 2)
            bands = []
            for extra in (keys[a : a + own], keys[a + own : a + 2 * own]):
                values = np.concatenate((keys[:a], extra))
                order = np.argsort(values)
                frequency = np.concatenate((np.full(a, shared), np.full(own, other)))[order]
                bands.append(set(neardup.bands_of(values[order], np.ones(a + own, dtype=np.int64), frequency)))
            found += bool(bands[0] & bands[1])
        assert found >= 199


def test_document_frequencies_in_bounded_memory():
    """Sums over equal shingles, for which a part's keys and counts are held but no sorted copies of all of them."""
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 20, 2_000_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    held = rng.integers(1, 257, len(keys)).astype(np.uint16)
    tracemalloc.start()
    found = neardup.held_in_all(keys, held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * keys.nbytes  # 5.5 where all are sorted at once
    different, place = np.unique(keys, return_inverse=True)
    assert (found == np.bincount(place, weights=held)[place]).all()
    some = np.array([0, 7, 7, (1 << 64) - 1, 7, 0], dtype=np.uint64)
    assert neardup.held_in_all(some, np.arange(1, 7, dtype=np.uint16)).tolist() == [7, 10, 10, 4, 10, 7]
    assert len(neardup.held_in_all(some[:0], held[:0])) == 0


def removed(texts, length, keep_first):
    counts = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    seen, out = set(), []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            if (w in seen) if keep_first else counts[w] > 1:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        out.append(bytes(b for b, g in zip(t, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("keep_first", [True, False])
def test_repeats(stored, odd, none, keep_first):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcd") for _ in range(300)) for _ in range(5)]
    texts = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            b, s = rng.choice(base), rng.randrange(0, 200)
            parts += [b[s : s + rng.randrange(20, 150)], "".join(rng.choice("abcdé") for _ in range(rng.randrange(0, 30)))]
        texts.append({0: "a" * i * 3, 1: "xyz" * i, 2: texts[-1] if texts else None}.get(i % 17, "".join(parts)))
    docs = stored(list(enumerate(texts)), "doc_id long, text string")
    want = removed([(t or "").encode() for t in texts], 40, keep_first)
    for hot in (repeats.HOT_BYTES, 500):
        rows = sorted(repeats.remove_repeats(docs, 40, keep_first, hot_bytes=hot).collect(), key=lambda r: r.doc_id)
        assert [bytes(r.kept) for r in rows] == want
    assert repeats.remove_repeats(odd, 400, keep_first).count() == odd.count()
    assert repeats.remove_repeats(none, 400, keep_first).count() == 0


def removed_by_words(texts, length, words, keep_first):
    """Strings of ``length`` bytes and passages of ``words`` words, whatever parts the words."""
    places = []
    for i, t in enumerate(texts):
        at = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", t)]
        places += [(i, j, j + length, t[j : j + length]) for j in range(len(t) - length + 1)]
        runs = (at[j : j + words] for j in range(len(at) - words + 1))
        places += [(i, run[0][0], run[-1][1], tuple(t[s:e] for s, e in run)) for run in runs]
    counts, seen = collections.Counter(p[3] for p in places), set()
    gone = [bytearray(len(t)) for t in texts]
    for i, s, e, what in places:
        if what in seen if keep_first else counts[what] > 1:
            gone[i][s:e] = b"\1" * (e - s)
        seen.add(what)
    return [bytes(b for b, g in zip(t, one, strict=True) if not g) for t, one in zip(texts, gone, strict=True)]


@pytest.mark.parametrize("keep_first", [True, False])
def test_repeats_of_passages_by_words(stored, odd, none, keep_first):
    rng = random.Random(5)
    base = [[rng.choice(["a", "bé", "c", "ddd", "e-"]) for _ in range(60)] for _ in range(5)]
    texts = []
    for i in range(60):
        parts = [rng.choice(["", " ", "\n"])]
        for _ in range(rng.randrange(0, 5)):
            b, s = rng.choice(base), rng.randrange(0, 40)
            for word in [*b[s : s + rng.randrange(8, 30)], *(rng.choice("uvwxyz") for _ in range(rng.randrange(0, 9)))]:
                parts += [word, rng.choice([" ", " ", " ", "\t", "\n\n"])]
        texts.append({0: "so " * i, 1: "q" * i * 3, 2: None, 3: "x" * 70 + f" end {i}"}.get(i % 17, "".join(parts)))
    docs = stored(list(enumerate(texts)), "doc_id long, text string")
    data = [(t or "").encode() for t in texts]
    want = removed_by_words(data, 60, 12, keep_first)
    assert want != removed(data, 60, keep_first)
    for hot in (repeats.HOT_BYTES, 500):
        rows = sorted(repeats.remove_repeats(docs, 60, keep_first, hot_bytes=hot, words=12).collect(), key=lambda r: r.doc_id)
        assert [bytes(r.kept) for r in rows] == want
    assert repeats.remove_repeats(odd, 400, keep_first, words=50).count() == odd.count()
    assert repeats.remove_repeats(none, 400, keep_first, words=50).count() == 0


def test_pipeline_removes_passages_of_fewer_bytes(spark, folder, stored):
    import corpus_pipeline

    rng = random.Random(8)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(n))

    passage = prose(55)
    assert len(passage) < 400
    rows = [(i, f"{prose(40)} {passage if i % 2 else prose(55)}\n{prose(30)}", "en", "s", 1) for i in range(10)]
    rows += [(10, passage.replace(" ", "\n") + "\n", "en", "s", 1), (11, " ", "en", "s", 1), (12, None, "en", "s", None)]
    docs = stored(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, docs, folder).collect()}
    before = {i: t for i, t, *_ in rows}
    assert sorted(left) == [*range(10), 11, 12]
    assert [i for i, t in left.items() if passage in (t or "")] == [1]
    assert all(left[i] == (before[i] if i == 1 else before[i].replace(passage, "")) for i in range(10))


def test_longest_previous_factors():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    starts = np.arange(400 - 8 + 1)
    earlier, later = repeats.previous_factors(data, starts, 8)
    words = [data[i : i + 8].tobytes() for i in starts]
    assert all((e >= 0) == (w in words[:i]) and (e < 0 or (e < i and words[e] == w)) for i, (w, e) in enumerate(zip(words, earlier, strict=True)))
    assert all((e >= 0) == (w in words[i + 1 :]) and (e < 0 or (e > i and words[e] == w)) for i, (w, e) in enumerate(zip(words, later, strict=True)))


def test_licenses_of_odd_rows(spark, odd, none):
    rows = licenses.license_summary(licenses.scan_licenses(odd)).collect()
    assert len(rows) == odd.count() and all(r.n_base == 0 for r in rows) and {r.n_words for r in rows if r.doc_id in (0, 1, 2)} == {0}
    assert licenses.scan_licenses(none).count() == 0
    text = "MIT License; licensed under the MIT license. GNU Lesser General Public License v3, cc-by cc by"
    row = licenses.license_summary(licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert (row.n_base, row.first_word, row.last_word, row.base_labels) == (4, 0, 15, "cc-by,mit")
    assert row.labels == "cc-by,lgpl-3,mit"


def test_every_license_rule_fires_on_its_own_words(spark):
    rules = licenses.signature_rules()
    texts = []
    for n, r in enumerate(rules):
        for spelling in "sc":
            plain = r.pattern.replace("[sc]", spelling).replace("[234]", "2")
            while "(?:" in plain:  # optional words left out, else the first choice
                plain = re.sub(r"\(\?:([^()|]*)[^()]*\)(\??)", lambda m: "" if m[2] else m[1], plain)
            texts.append((2 * n + "sc".index(spelling), " ".join(plain.split())))
    rows = licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    found = {r.doc_id: {(d.rank, d.label, d.base) for d in r.detections} for r in rows}
    assert [(rules[i // 2].pattern, t) for i, t in texts if (rules[i // 2].rank, rules[i // 2].label, rules[i // 2].base) not in found[i]] == []
    row = licenses.license_summary(licenses.scan_licenses(spark.createDataFrame([(1, "Released under the Unlicense.")], "doc_id long, text string"))).first()
    assert (row.labels, row.score) == ("unlicense", 0.8)


def test_license_phrases_by_words(spark, folder):
    """The base columns against a plain search in lists of words."""
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    texts += [(-1, "MIT Licensed, CC-BY cc by\tCC BY; mit-license Mit  License"), (-2, "the GNU General\nPublic License cc by-sa"), (-3, "é mit license"), (-4, "mitélicense")]
    got = {r.doc_id: r for r in licenses.license_summary(licenses.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string"))).collect()}
    phrases = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}
    some = 0
    for doc_id, text in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        at = [(i, label) for label, p in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        starts = [i for i, _ in at]
        row = got[doc_id]
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (len(words), len(at), min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in at})) and set(row.base_labels.split(",")) <= {*row.labels.split(","), ""}
        some += bool(at)
    assert some >= 5


def test_licenses_by_their_bodies(spark):
    """Texts that never name their license."""
    mit = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
    to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."""
    bsd = """Redistributions of source code must retain the above copyright notice, this list of conditions. Neither the name
    of the holder nor the names of its contributors may be used to endorse or promote products derived from this software
    without specific prior written permission."""
    apache = "You may not use this file except in compliance with the License. You may obtain a copy at"
    gpl = """You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the
    Free Software Foundation; either version 3 of the License, or (at your option) any later version."""
    plain = "We hereby invite you to redistribute chairs; merge traffic is advertising, and nobody is misrepresented."
    rows = spark.createDataFrame(list(enumerate([mit, bsd, apache, gpl, plain])), "doc_id long, text string")
    found = {r.doc_id: (r.labels, r.score) for r in licenses.license_summary(licenses.scan_licenses(rows)).collect()}
    assert found == {0: ("mit", 0.8), 1: ("bsd,bsd-3-clause", 0.8), 2: ("apache-2.0", 0.8), 3: ("gpl,gpl-3-or-later", 1.0), 4: ("", 0.0)}


def test_tool_calls(spark):
    calls = [("a", 1, 1, "search", '{"words": 2, "text": "x"}', None), ("b", 1, 2, "search", '{"words": "2"}', "a"), ("b", 1, 2, "search", '{"words": "2"}', "a"),
             ("c", 1, 3, "other", "{", "b"), ("d", 1, 4, "count", '{"words": 1, "z": {"b": 1, "a": 2}}', "e"), ("e", 1, 5, "count", None, "d"), (None, 1, 6, "count", "{}", None)]
    frame = spark.createDataFrame(calls, "call_id string, conv_id long, turn long, name string, arguments string, after string")
    results = spark.createDataFrame([("a", "r"), ("a", "r"), ("x", "y"), (None, "n")], "call_id string, content string")
    rows = {r.call_id: r for r in toolcalls.link_tool_calls(frame, results, toolcalls.SCHEMAS).collect()}
    assert {k: (r.level, r.answered, r.errors) for k, r in rows.items()} == {
        "a": (0, True, ""), "b": (1, False, "text: missing; words: not integer"), "c": (2, False, "not an object"),
        "d": (None, False, "unknown argument"), "e": (None, False, "not an object"),
    }
    assert rows["a"].canonical == '{"arguments":{"text":"x","words":2},"id":"a","name":"search","result":"r"}'
    assert '"z":{"a":2,"b":1}' in rows["d"].canonical
    assert toolcalls.link_tool_calls(frame.where("false"), results, toolcalls.SCHEMAS).count() == 0


def test_tool_call_json_has_one_spelling(spark):
    """Against Python's json and decimal: equal values are spelled alike, different ones are not."""
    from decimal import Context, Decimal

    def plain(value):
        if isinstance(value, dict):
            return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{plain(v)}" for k, v in sorted(value.items())) + "}"
        if isinstance(value, list):
            return "[" + ",".join(map(plain, value)) + "]"
        if isinstance(value, Decimal):
            return f"{Context(prec=60).normalize(value):f}" if value else "0"
        return json.dumps(value, ensure_ascii=False)

    numbers = ["100", "1e2", "100.0", "100.00", "1E+2", "0.1e1", "1", "1.0", "-0", "-0.0", "0e5", "0.00001234", "1.234e-5", "1234e-8", "-2.50", "-25e-1",
               "12345678.5", "1.23456785e7", "9007199254740993", "1e10", "10000000000", "1e30", "123456789012345678901234567890", "0.1", "7e-1"]
    texts = [f'{{"z": {n}, "a": ["1.0", {{"b\\"1.0": {n}, "A": null, "t": true}}, "x\\\\", {n}, [], {{}}]}}' for n in numbers]
    texts += ['{"t": "say \\"1.50\\", 2e5 \\\\ é\\n"}', '{"t": "' + "\\\\ 1.0 \\n" * 50_000 + '"}']
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", toolcalls.canonical_json(F.try_parse_json("t")).alias("c"))
    got = {r.i: r.c for r in frame.collect()}
    assert [got[i] for i in range(len(texts))] == [plain(json.loads(t, parse_float=Decimal, parse_int=Decimal)) for t in texts]


def test_tool_calls_nested_schemas(spark):
    field = toolcalls.Field
    point = {"x": field("number", required=True, least=0), "unit": field("string", choices=('"m"', '"km"'))}
    schemas = {"go": {"to": field("object", required=True, fields=point), "via": field("array", items=field("object", fields=point)), "n": field("integer", choices=("1", "2"))}}
    cases = {
        '{"to": {"x": 1}}': "",
        '{"to": {"x": 1.5, "unit": "km"}, "via": [], "n": 2}': "",
        '{"to": {"x": -1, "unit": "mile"}}': 'to.unit: not one of "m", "km"; to.x: below 0',
        '{"to": {}, "n": 3}': "n: not one of 1, 2; to.x: missing",
        '{"to": [1]}': "to: not object",
        '{"to": {"x": 1, "y": 2}, "via": [{"x": 1}, {"x": "1"}, {}]}': "to: unknown argument; via[].x: missing; via[].x: not number",
        '{"to": {"x": 1}, "via": {"x": 1}}': "via: not array",
        '{"to": {"x": 1}, "via": [3]}': "via[]: not object",
    }
    calls = spark.createDataFrame([(str(i), 1, i, "go", t, None) for i, t in enumerate(cases)], "call_id string, conv_id long, turn long, name string, arguments string, after string")
    none = spark.createDataFrame([], "call_id string, content string")
    rows = toolcalls.link_tool_calls(calls, none, schemas).collect()
    assert {int(r.call_id): r.errors for r in rows} == dict(enumerate(cases.values()))


def test_tool_calls_with_several_predecessors(spark):
    """Against longest ways by recursion; calls of cycles and behind them have no level."""
    rng = random.Random(3)
    before: dict[str, list[str]] = {}
    for i in range(150):  # chains, joins of chains, names that are unknown, null or repeated
        near = [str(j) for j in range(max(0, i - 6), i)]
        before[str(i)] = rng.sample(near, min(len(near), rng.choice([0, 1, 1, 1, 2, 3])))
    before |= {"c1": ["c3"], "c2": ["c1"], "c3": ["c2", "0"], "c4": ["c2", "1"], "c5": ["c4"], "self": ["self"], "long0": []}
    before |= {f"long{i}": [f"long{i - 1}"] for i in range(1, 40)}

    def level(call, on_way=()):
        if call in on_way:
            return None
        ways = [level(b, (*on_way, call)) for b in before[call]] if call not in known else [known[call] - 1]
        known_level = None if None in ways else max(ways, default=-1) + 1
        if known_level is not None:
            known[call] = known_level
        return known_level

    known: dict[str, int] = {}
    want = {call: level(call) for call in before}
    rows = [(call, [*after, None, "nobody", *after]) for call, after in before.items()]
    calls = spark.createDataFrame(rows, "call_id string, after array<string>")
    got = {r.call_id: r.level for r in toolcalls.topological_levels(calls).collect()}
    assert got == want and got["long39"] == 39 and got["c5"] is None and max(v or 0 for v in list(got.values())[:150]) > 5
    assert toolcalls.topological_levels(calls.where("false")).count() == 0


def test_pipeline(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, folder), f"test-{name}")
        seen[name] = docs
    for name in list(seen)[:-1]:
        assert seen[name].columns == list(corpus_pipeline.COLUMNS)
    texts = [r.text.encode() for r in seen["suffix_dedup"].orderBy("doc_id").collect()]
    before = [r.text.encode() for r in seen["near_dedup"].orderBy("doc_id").collect()]
    assert sum(map(len, texts)) <= sum(map(len, before))
    assert contamination.find_leaks(seen["decontamination"], spark.read.parquet(f"{folder}/benchmark.parquet")).count() == 0
    assert seen["bpe_ids"].count() == seen["decontamination"].count() == corpus_pipeline.run(spark, folder).count()
    assert seen["near_dedup"].select(F.countDistinct("text")).first()[0] == seen["near_dedup"].count()


def test_row_keys_depend_on_files_alone(spark, folder, tmp_path, monkeypatch):
    """Keys, near copies and repeats are the same while splits change from job to job, as they do with the cores."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    path = str(tmp_path / "many")
    docs.repartition(7).write.parquet(path)
    docs = spark.read.parquet(path)
    setting, before = "spark.sql.leafNodeDefaultParallelism", spark.conf.get("spark.sql.leafNodeDefaultParallelism", None)
    want = {
        near.__name__: sorted(map(tuple, near(docs).drop("rid").collect()))
        for near in (neardup.near_duplicates, repeats.remove_repeats)
    }
    cores = itertools.cycle((3, 16, 5))

    def settle_elsewhere(df, purpose):
        done = common.settle(df, purpose)
        spark.conf.set(setting, next(cores))
        return done

    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "4k")
        keys = []
        for n in (4, 12):
            spark.conf.set(setting, n)
            keys.append({r.rid: r.doc_id for r in common.with_row_key(docs).select("rid", "doc_id").collect()})
        assert keys[0] == keys[1] and sorted(keys[0]) == list(range(docs.count()))
        for module, near in ((neardup, neardup.near_duplicates), (repeats, repeats.remove_repeats)):
            monkeypatch.setattr(module, "settle", settle_elsewhere)
            assert sorted(map(tuple, near(docs).drop("rid").collect())) == want[near.__name__]
        import corpus_pipeline

        rows = corpus_pipeline.near_dedup(spark, docs, folder)
        kept = {r[0] for r in neardup.near_duplicates(docs).where("kept").select("doc_id").collect()}
        assert {r.doc_id for r in rows.collect()} == kept
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def test_row_keys_of_frames_without_files(spark):
    keyed = common.with_row_key(spark.range(1000).repartition(5))
    assert sorted(r.rid for r in keyed.collect()) == list(range(1000))
