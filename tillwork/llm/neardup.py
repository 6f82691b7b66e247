"""Near-duplicate texts: improved consistent weighted sampling over TF-IDF shingles, banded, verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import components, grouped, settle, small_batches, starts_of, table, tidy, with_row_key
from tillwork.llm.features import pieces
from tillwork.llm.words import mixed, shingle_hashes

SHINGLE = 5  # words
SIMILARITY = 0.8  # weighted Jaccard
BANDS, BAND = 16, 4  # samples of a band; a pair of similarity 0.8 agrees in one of the bands with chance 0.9998
SAMPLES = BANDS * BAND
COMMON = 0.02  # share of all texts below which a shingle weighs almost as one that a single text holds, so that groups of near copies don't lose weight by their own size, however many texts there are
SMOOTH = 10  # texts that take the place of that share where it is fewer
SHORT = 128  # texts up to the weight of so many shingles draw each sample from all of them; longer ones from a bin of their occurrences
CHUNK = 256  # texts, by consecutive keys, whose shingles are counted together
PART_BYTES = 32_000_000  # of the texts whose shingles one task counts
RANGE_KEYS = 1 << 17  # shingles of a part that are sorted at a time
PIECES = 100  # whose counts leave a task at a time
BLOCK_ROWS, BLOCK_BYTES = 1000, 8_000_000  # of the texts that are verified together
PIVOTS = 32  # texts of a large group that meet all its blocks


def inverse_frequency(share: np.ndarray | float, prior: float = 0.0) -> np.ndarray | float:
    """Shares far below ``prior`` hardly differ, shares far above it are as they are."""
    return np.log1p(1 / np.hypot(share, prior))


PLAIN = float(inverse_frequency(0.2))  # the unit of weights: that of a shingle which one text holds


def frequency_weights(held: np.ndarray, total: int) -> np.ndarray:
    """Weights of shingles that ``held`` of ``total`` different texts hold: inverse document frequencies. Beyond some
    hundreds of texts a weight follows from the share alone: a group that grows with its corpus keeps its weights."""
    prior = max(SMOOTH / total, COMMON)
    return PLAIN * inverse_frequency(held / total, prior) / inverse_frequency(1 / total, prior)


def packed(values: np.ndarray) -> bytes:
    """The bytes of numbers, first bytes first, as those of sorted or small numbers compress well."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpacked(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(size, len(data) // size).T).view(kind).ravel()


def different_shingles(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Different shingles of each text, sorted, with their occurrences."""
    found = []
    for some in pieces([t or "" for t in texts], 1000):
        found += [np.unique(s, return_counts=True) for s in shingle_hashes(texts[some], SHINGLE)]
    return found


def held_by(own: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """All different shingles of some texts, sorted, and how many of the texts hold each."""
    return np.unique(np.concatenate([values for values, _ in own]), return_counts=True)


PIECE_ROW = "part int, chunk long, piece long, rids binary, keys binary, held binary"


def shingle_parts(texts: DataFrame, parts: int) -> DataFrame:
    """Shingles of the rows (chunk, rid, text), cut into ``parts`` by their hashes. What a task meets of a chunk at a time
    is a piece, named by its smallest rid; its rids stand beside its first part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece(chunk: int, members: dict[int, str]) -> pa.RecordBatch:
            rids = sorted(members)
            keys, held = held_by(different_shingles([members[r] for r in rids]))
            part = part_of(keys, parts)
            at = np.searchsorted(part, np.arange(parts + 1)).tolist()
            rows = [p for p in range(parts) if not p or at[p] < at[p + 1]]
            return pa.RecordBatch.from_pydict({
                "part": pa.array(rows, pa.int32()), "chunk": pa.array([chunk] * len(rows), pa.int64()),
                "piece": pa.array([rids[0]] * len(rows), pa.int64()),
                "rids": pa.array([None if p else np.array(rids, dtype=np.int64).tobytes() for p in rows], pa.binary()),
                "keys": pa.array([packed(keys[at[p] : at[p + 1]]) for p in rows], pa.binary()),
                "held": pa.array([packed(held[at[p] : at[p + 1]].astype(np.uint16)) for p in rows], pa.binary()),
            })

        now, members = None, {}
        for batch in batches:
            for chunk, rid, text in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if chunk != now and members:
                    yield piece(now, members)
                    members = {}
                now, members[rid] = chunk, text
        if members:
            yield piece(now, members)

    return texts.mapInArrow(tidy(run), PIECE_ROW)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each hash by its upper half; sorted hashes have sorted parts."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def held_in_all(keys: np.ndarray, held: np.ndarray) -> np.ndarray:
    """For each of ``keys`` the sum of ``held`` over all equal ones. Equal keys lie in one range of hashes, so ranges of
    some RANGE_KEYS keys are sorted one after the other, and nothing but keys and counts is as long as the part."""
    found = np.empty(len(keys), dtype=np.uint32)
    if not len(keys):
        return found
    low, high = int(keys.min()), int(keys.max())
    ranges = -(-len(keys) // RANGE_KEYS)
    wide = (high - low) // ranges + 1
    for begin in range(low, high + 1, wide):
        at = np.flatnonzero((keys >= np.uint64(begin)) & (keys <= np.uint64(min(begin + wide - 1, high))))
        different, place = np.unique(keys[at], return_inverse=True)
        found[at] = np.bincount(place, weights=held[at], minlength=len(different))[place]
    return found


def document_frequencies(pieces_of: DataFrame, parts: int) -> DataFrame:
    """(chunk, piece, part, rids, held): the same rows with the number of all texts that hold each shingle. A task counts
    one part at a time, and lets go of its rows as soon as keys and counts are unpacked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for several in grouped(batches, ["part"]):
            starts = starts_of(several.column("part").to_numpy()).tolist()
            waiting = [several.slice(a, b - a) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            del several
            while waiting:
                own = waiting.pop(0)
                sizes = np.array([len(k.as_buffer()) // 8 for k in own.column("keys")])
                ends = np.cumsum(sizes).tolist()
                keys, held = np.empty(ends[-1], dtype=np.uint64), np.empty(ends[-1], dtype=np.uint16)
                for k, h, n, end in zip(own.column("keys"), own.column("held"), sizes.tolist(), ends, strict=True):
                    keys[end - n : end], held[end - n : end] = unpacked(k.as_buffer(), np.uint64), unpacked(h.as_buffer(), np.uint16)
                own = own.select(["chunk", "piece", "part", "rids"]).combine_chunks()
                all_held = held_in_all(keys, held)
                del keys, held
                for at in range(0, len(ends), PIECES):
                    some = own.slice(at, PIECES)
                    found = [packed(all_held[end - n : end]) for n, end in zip(sizes[at : at + PIECES].tolist(), ends[at : at + PIECES], strict=True)]
                    columns = [some.column(c).combine_chunks() for c in ("chunk", "piece", "part", "rids")]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], ["chunk", "piece", "part", "rids", "held"])

    dealt = pieces_of.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(tidy(run), "chunk long, piece long, part int, rids binary, held binary")


def occurrences(values: np.ndarray, counts: np.ndarray, frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key, sorted, and a weight for the first, second, ... occurrence of each shingle. An occurrence weighs the same in
    every text that has it, so the shared weight of two texts is that of the keys they share: their weighted Jaccard
    similarity stays the same, and no key outweighs the others by its repeats."""
    if not len(counts) or counts.max() == 1:
        return values, frequency
    at = np.repeat(np.arange(len(values)), counts)
    nth = (np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
    keys = np.where(nth == 0, values[at], mixed(values[at] ^ mixed(nth)))
    order = np.argsort(keys)
    return keys[order], frequency[at[order]]


def uniforms(keys: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    bits = mixed(keys + np.uint64(salt * 0x632BE59BD9B4E019 % (1 << 64)))
    low = (bits & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return (low + 0.5) / 2**32, ((bits >> np.uint64(32)).astype(np.float64) + 0.5) / 2**32


def draws(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Improved consistent weighted sampling: for each key the logarithm of its rank, the smallest of which is drawn, and
    the number of the weight's interval, which belongs to the sample."""
    a, b = uniforms(keys, 1)
    c, d = uniforms(keys, 2)
    beta, _ = uniforms(keys, 3)
    r = -np.log(a * b)
    t = np.floor(np.log(weights) / r + beta)
    return np.log(-np.log(c * d)) - r * (t - beta) - r, t.astype(np.int64).view(np.uint64)


def samples(values: np.ndarray, weights: np.ndarray, binned: bool) -> np.ndarray:
    """SAMPLES draws. Binned, the keys are dealt to as many bins by their first bits, and each bin draws once; that needs
    many keys of similar weight, as ``occurrences`` gives."""
    found = np.zeros(SAMPLES, dtype=np.uint64)
    if binned:
        rank, interval = draws(values, weights)
        bins = (values >> np.uint64(64 - (SAMPLES - 1).bit_length())).astype(np.int64)
        starts = starts_of(bins)
        least = np.repeat(np.minimum.reduceat(rank, starts[:-1]), np.diff(starts))
        chosen = np.flatnonzero(rank == least)
        found[bins[chosen]] = mixed(values[chosen] ^ mixed(interval[chosen] + np.uint64(1)))
        return found
    for begin in range(0, SAMPLES, 16):
        salts = mixed(np.arange(begin + 1, begin + 17, dtype=np.uint64))
        keys = mixed(values[:, None] ^ salts)
        rank, interval = draws(keys, weights[:, None])
        chosen = rank.argmin(axis=0)
        found[begin : begin + 16] = mixed(values[chosen] ^ mixed(interval[chosen, np.arange(16)] + np.uint64(1)))
    return found


def bands_of(values: np.ndarray, counts: np.ndarray, frequency: np.ndarray) -> list[int]:
    """Band hashes. Similar texts have similar total weights, so those near the limit between the two ways of drawing
    are drawn both ways, and similar texts always share one way."""
    weights = counts * frequency
    total, limit = weights.sum(), SHORT * PLAIN
    found: list[np.ndarray] = []
    for binned in (False, True):
        if len(values) and (total >= SIMILARITY * limit if binned else total < limit):
            drawn = samples(*(occurrences(values, counts, frequency) if binned else (values, weights)), binned).reshape(BANDS, BAND)
            scale = np.arange(1, 2 * BAND, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            place = np.arange(BANDS, dtype=np.uint64) + np.uint64(BANDS * binned + 1)
            found.append(mixed((drawn * scale).sum(axis=1, dtype=np.uint64) + mixed(place)))
    return np.concatenate(found).view(np.int64).tolist() if found else []


def signatures(texts: DataFrame, parts: int, total: int) -> DataFrame:
    """(rid, bands, held) of the ``total`` different texts (chunk, rid, text). ``held`` has for each different shingle,
    sorted, the number of texts that hold it."""
    found = document_frequencies(shingle_parts(texts, parts), parts)
    none = {"piece": "long", "part": "int", "rids": "binary", "held": "binary"}
    both = texts.select("chunk", "rid", "text", *[F.lit(None).cast(kind).alias(c) for c, kind in none.items()]).unionByName(
        found.withColumns({"rid": F.lit(None).cast("long"), "text": F.lit(None).cast("string")})
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for several in grouped(batches, ["chunk"]):
            starts = starts_of(several.column("chunk").to_numpy()).tolist()
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                own = several.slice(a, b - a).select(["rid", "text", "piece", "part", "rids", "held"]).to_pylist()
                text = {r["rid"]: r["text"] for r in own if r["rid"] is not None}
                counts: dict[int, list[tuple[int, bytes]]] = {}
                members: dict[int, list[int]] = {}
                for r in own:
                    if r["rid"] is None:
                        counts.setdefault(r["piece"], []).append((r["part"], r["held"]))
                        if r["rids"] is not None:
                            members[r["piece"]] = np.frombuffer(r["rids"], dtype=np.int64).tolist()
                for piece, rids in members.items():
                    shingles = different_shingles([text[r] for r in rids])
                    keys, _ = held_by(shingles)
                    held = np.concatenate([unpacked(h, np.uint32) for _, h in sorted(counts[piece])])
                    bands, packs = [], []
                    for values, n in shingles:
                        here = held[np.searchsorted(keys, values)]
                        bands.append(bands_of(values, n, frequency_weights(here, total)))
                        packs.append(packed(here))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rids, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(packs, pa.binary())],
                        names=["rid", "bands", "held"],
                    )

    tasks = max(parts, texts.sparkSession.sparkContext.defaultParallelism)
    dealt = both.repartition(tasks, "chunk").sortWithinPartitions("chunk")
    return dealt.mapInArrow(tidy(run), "rid long, bands array<long>, held binary")


class Group:
    """Texts that are verified together; knows which of them already hang together.

    Where texts meet by one ``band``, they may meet elsewhere as well: a pair is compared for the smallest band that it
    shares, and where two parts of a band meet (``side``), only across these."""

    def __init__(self, rids: list[int], texts: list[str], held: list[bytes], bands: list[list[int]], known: list[int], side: list[int], total: int, band: int | None = None):
        self.rids, self.bands, self.held, self.total = rids, bands, held, total
        self.band, self.side = band, side if len(set(side)) > 1 else None
        self.band_sets = [set(b) for b in bands] if band is not None else []
        self.sets: list = [None] * len(rids)
        self.texts = texts
        self.parent = list(range(len(rids)))
        self.failed: set[tuple[int, int]] = set()
        first: dict[int, int] = {}
        for i, c in enumerate(known):
            self.parent[i] = first.setdefault(c, i)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def weights_of(self, i: int):
        if self.sets[i] is None:
            [(values, counts)] = different_shingles([self.texts[i]])
            weights = counts * frequency_weights(unpacked(self.held[i], np.uint32), self.total)
            self.sets[i] = (values, weights, weights.sum())
        return self.sets[i]

    def similar(self, i: int, j: int) -> bool:
        (v, w, s), (x, y, z) = self.weights_of(i), self.weights_of(j)
        if min(s, z) < SIMILARITY * max(s, z) * (1 - 1e-12):
            return False
        if len(v) < len(x):
            v, w, x, y = x, y, v, w
        at = np.minimum(np.searchsorted(v, x), len(v) - 1)
        hit = v[at] == x
        both = np.minimum(w[at[hit]], y[hit]).sum()
        return both >= SIMILARITY * (s + z - both) * (1 - 1e-12)

    def compared_here(self, i: int, j: int) -> bool:
        if self.band is None:
            return True
        if self.side and self.side[i] == self.side[j]:
            return False
        return min(self.band_sets[i] & self.band_sets[j]) == self.band

    def join(self, i: int, j: int) -> bool:
        """Whether i and j hang together now."""
        if self.root(i) == self.root(j):
            return True
        if not self.compared_here(i, j):
            return False
        pair = (min(i, j), max(i, j))
        if pair in self.failed:
            return False
        if not self.similar(i, j):
            self.failed.add(pair)
            return False
        self.parent[self.root(j)] = self.root(i)
        return True

    def run(self) -> list[tuple[int, int]]:
        """Links that connect what similar texts with a band in common connect, each to the smallest rid of its part: no
        chains are left for ``components``. Pairs that hang together by others are not compared any more, so a group of
        copies costs a comparison a text, not one a pair."""
        buckets: dict[int, list[int]] = {}
        for i, bands in enumerate(self.bands):
            for band in bands if self.band is None else [self.band]:
                buckets.setdefault(band, []).append(i)
        for members in buckets.values():
            parts: list[list[int]] = []
            for i in members:
                mine = [i]
                rest = []
                for part in parts:
                    if any(self.join(i, j) for j in part):
                        mine += part
                    else:
                        rest.append(part)
                parts = [*rest, mine]
        least: dict[int, int] = {}
        for i, rid in enumerate(self.rids):
            root = self.root(i)
            least[root] = min(least.get(root, rid), rid)
        return [(least[self.root(i)], rid) for i, rid in enumerate(self.rids) if rid != least[self.root(i)]]


def verify(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    """(a, b): verified links among the rows (keys, rid, text, held, bands, known, side) of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches, keys):
            starts = starts_of(*[part.column(k).to_numpy() for k in keys]).tolist()
            links: list[tuple[int, int]] = []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if b - a > 1:
                    own = part.slice(a, b - a).to_pydict()
                    band = own["band"][0] if "band" in keys else None
                    links += Group(own["rid"], own["text"], own["held"], own["bands"], own["known"], own["side"], total, band).run()
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"]
            )

    columns = rows.select(*keys, "rid", "text", "held", "bands", "known", "side")
    return columns.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidy(run), "a long, b long")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", row_key: str | None = None
) -> DataFrame:
    """(rid, doc_id, class_id, class_size, kept) of every row; ``rid`` is the column ``row_key`` of ``docs``, or a key
    made here.

    Equal texts are one text with copies. Shingles weigh by their occurrences and their inverse document frequency; all
    document frequencies are counted, over different texts: shingles are dealt by their hashes to tasks that count them,
    and the counts come back to the texts, beside which they stay. Different texts are candidates when they agree in a band of samples. What
    candidates connect is shipped once, together, and verified by the weighted Jaccard similarity of whole texts. A
    connected set beyond BLOCK_ROWS texts or BLOCK_BYTES is cut into blocks that a few pivots all meet; where after that
    a band still holds texts that don't hang together, its blocks meet two by two. So no link between different texts
    is lost, and no task sees an unbounded group.

    A class is what links connect; ``class_id`` is its smallest id and the row with it is kept (the first one where ids
    repeat). Null texts count as empty. Texts without words are only copies of equal texts; texts of under five words
    have one shingle. Null ids come last; a class of null ids has a null class_id. An empty table gives no rows; other
    columns are not read."""
    small_batches(docs.sparkSession)
    named = [F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")]
    rows = docs.select(F.col(row_key).alias("rid"), *named) if row_key else with_row_key(docs.select(*named))
    rows = rows.select("rid", "doc_id", "text")
    whole = F.coalesce("text", F.lit("")).alias("text")
    hashed = rows.select("rid", "doc_id", whole).select(
        "rid", "doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes")
    )
    hashed = settle(hashed, "text-hashes")
    different = settle(hashed.groupBy("sha").agg(F.min("rid").alias("rid"), F.min("n_bytes").alias("n_bytes")), "different-texts")
    total, n_bytes = different.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    copies = hashed.select("rid").join(different.select("rid"), "rid", "left_anti")
    chunk = F.expr(f"rid div {CHUNK}")
    copied = copies.groupBy(chunk.alias("chunk")).agg(F.collect_list("rid").alias("copies"))  # at most CHUNK each
    copied = settle(copied, "copies-by-chunk")
    own = rows.select(chunk.alias("chunk"), "rid", whole).join(copied, "chunk", "left")
    own = own.where("copies is null or not array_contains(copies, rid)").select("chunk", "rid", "text")
    signed = settle(signatures(own, max(1, -(-n_bytes // PART_BYTES)), total), "signatures")
    texts = different.join(signed.select("rid", "bands"), "rid")
    banded = texts.select("rid", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("rid").alias("least")).where("n > 1").drop("n")
    member = settle(banded.join(shared, "band").select("band", "rid", "least"), "band-members")
    candidate = settle(components(member.selectExpr("rid as a", "least as b"), "candidates"), "candidate-sets")
    sized = candidate.join(texts.select(F.col("rid").alias("node"), "n_bytes", "bands"), "node")
    size = sized.groupBy("component").agg(
        F.expr(f"int(greatest(ceil(count(*) / {BLOCK_ROWS}D), ceil(sum(n_bytes) / {BLOCK_BYTES}D)))").alias("blocks")
    )
    nth = "int(pmod(xxhash64(node), blocks))"
    placed = sized.join(size, "component").withColumn("block", F.expr(nth))
    pivot = F.expr(f"blocks > 1 and pmod(xxhash64(node, 1), cast(blocks as bigint) * {BLOCK_ROWS}) < {PIVOTS}")
    blocks = F.when(pivot, F.expr("sequence(0, blocks - 1)")).otherwise(F.array("block"))
    placed = placed.select(F.col("node").alias("rid"), "component", "bands", F.explode(blocks).alias("block"), "blocks")
    own_texts = settle(
        own.select("rid", "text").join(signed.select("rid", "held").join(candidate.select(F.col("node").alias("rid")), "rid"), "rid"), "candidate-texts"
    )
    grouped_texts = placed.join(own_texts, "rid").withColumn("known", F.col("rid")).withColumn("side", F.lit(0))
    links = settle(verify(grouped_texts, ["component", "block"], total), "verified-links")
    split = size.where("blocks > 1")
    linked = components(links, "near-copies")
    if split.limit(1).count():
        known = settle(linked, "known-copies")
        across = settle(_across_blocks(placed, member, own_texts, known, total), "verified-across")
        linked = components(known.selectExpr("node as a", "component as b").union(across), "near-copies")
    final = hashed.join(different.select("sha", F.col("rid").alias("text_rid")), "sha").join(linked, F.col("text_rid") == F.col("node"), "left")
    final = final.select("rid", "doc_id", F.coalesce("component", "text_rid").alias("group"))
    first = final.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"), F.count("*").alias("class_size")
    )
    return final.join(first, "group").select(
        "rid", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("rid") == F.col("first.rid")).alias("kept")
    )


def _across_blocks(placed: DataFrame, member: DataFrame, texts: DataFrame, known: DataFrame, total: int) -> DataFrame:
    """Links between texts of split sets that share a band but don't hang together yet by ``known`` (node, component)."""
    of_split = placed.where("blocks > 1").select("rid", "bands").dropDuplicates(["rid"]).join(known, F.col("rid") == F.col("node"), "left")
    of_split = of_split.select("rid", "bands", F.coalesce("component", "rid").alias("known"))
    inside = member.select("band", "rid").join(of_split, "rid")
    open_bands = inside.groupBy("band").agg(
        F.min("known").alias("k0"), F.max("known").alias("k1"), F.count("*").alias("n")
    ).where("k0 <> k1")
    half = BLOCK_ROWS // 2
    parts = inside.join(open_bands.select("band", F.expr(f"int(ceil(n / {half}D))").alias("parts")), "band")
    parts = parts.withColumn("part", F.expr("int(pmod(xxhash64(rid), parts))")).withColumn("with", F.explode(F.expr("sequence(0, parts - 1)")))
    met = parts.select(
        "band", F.least("part", "with").alias("left_part"), F.greatest("part", "with").alias("right_part"), "rid", "bands", "known",
        F.col("part").alias("side"),
    )
    return verify(met.join(texts, "rid"), ["band", "left_part", "right_part"], total)


def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "class_size", "kept")
