"""Repeated byte strings across a corpus: suffix order and longest-previous-factor arrays over what may repeat at all."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import grouped, settle, small_batches, starts_of, table, tidy, with_row_key
from tillwork.llm.features import pieces
from tillwork.llm.words import INVERSE, NOT_BLANK, PRIME, hashed_runs, mixed, powers

LENGTH = 400  # bytes of a repeated string
WORDS = 50  # words of a repeated passage, where words are asked for
CODE = 8  # bytes of a word's hash
BLOCK = 1 << 20  # bytes whose suffixes are ordered at a time, unless one group alone is larger
HOT_BYTES = 8_000_000  # a larger group of stretches is dealt out again by what they share
FINE = 4  # window starts of a stretch that is dealt out again
SPANS = "array<struct<s:int,e:int>>"


# --- suffix order and longest previous factors ---------------------------------------------------------------------


def prefix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """The rank of each position by the ``depth`` bytes (or codes of words) that follow, equal strings alike; bytes past
    the end are zero. Ranks of twice the length come from pairs of ranks, sorted together with their positions in one
    64-bit word."""
    n = len(data)
    bits = max(1, int(n).bit_length())
    wide = 3 * bits <= 64

    def ranked(key: np.ndarray) -> np.ndarray:
        if wide:
            both = np.sort((key << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
            at, key = (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> np.uint64(bits)
        else:
            at = np.argsort(key, kind="stable")
            key = key[at]
        rank = np.empty(n, dtype=np.uint64)
        rank[at] = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(key[1:] != key[:-1], dtype=np.uint64)))
        return rank

    if data.itemsize == CODE:
        rank, have = np.unique(data, return_inverse=True)[1].astype(np.uint64), 1
    else:
        padded = np.concatenate((data, np.zeros(2, dtype=np.uint8))).astype(np.uint64)
        rank, have = ranked((padded[:n] << np.uint64(8)) | padded[1 : n + 1]), 2
    while have < depth:
        step = min(have, depth - have)
        later = np.zeros(n, dtype=np.uint64)
        later[: n - step] = rank[step:] + np.uint64(1)
        shift = np.uint64(bits if wide else 32)
        rank, have = ranked((rank << shift) | later), have + step
    return rank.astype(np.int64)


def nearest_smaller(position: np.ndarray, run: np.ndarray) -> np.ndarray:
    """For each entry the nearest earlier one of its run with a smaller position, or -1: each looks at its left
    neighbour and jumps on along what that one has found, all entries at once."""
    n = len(position)
    at = np.arange(n) - 1
    open_ = np.arange(n)
    while len(open_):
        c = at[open_]
        ended = (c < 0) | (run[np.maximum(c, 0)] != run[open_])
        at[open_[ended]] = -1
        open_, c = open_[~ended], c[~ended]
        larger = position[c] >= position[open_]
        open_, c = open_[larger], c[larger]
        at[open_] = np.where(at[c] < c, at[c], c - 1)
    return at


def previous_factors(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``starts`` (rising) the nearest position, in suffix order, of an earlier and of a later string of
    ``length`` equal bytes, or -1. Neighbours in suffix order whose common prefix reaches ``length`` form runs; inside a
    run the previous and next smaller positions are the earlier matches, the previous and next larger ones the later."""
    rank = prefix_ranks(data, length)[starts]
    order = np.argsort(rank, kind="stable")
    position, run = starts[order], rank[order]
    result = []
    for sign in (1, -1):
        before = nearest_smaller(sign * position, run)
        after = nearest_smaller((sign * position)[::-1], run[::-1])[::-1]
        after = np.where(after >= 0, len(starts) - 1 - after, -1)
        best = np.where(before >= 0, before, after)
        found = np.full(len(starts), -1, dtype=np.int64)
        found[order] = np.where(best >= 0, position[np.maximum(best, 0)], -1)
        result.append(found)
    return result[0], result[1]


def spans_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The merged spans that strings of ``length`` bytes cover from rising starts on."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > length)
    first = starts[np.concatenate(([0], breaks + 1))]
    last = starts[np.concatenate((breaks, [len(starts) - 1]))] + length
    return list(zip(first.tolist(), last.tolist(), strict=True))


# --- where a string may repeat -----------------------------------------------------------------------------------


def gram_size(length: int) -> int:
    return max(1, length // 6)


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes of a text's words, and where each begins and ends."""
    return hashed_runs([text], NOT_BLANK)[:3]


def bytes_of(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of a text's bytes."""
    places = np.arange(len(text) + 1)
    return np.frombuffer(text, dtype=np.uint8), places[:-1], places[1:]


def group_keys(hashes: np.ndarray, by_word: bool) -> np.ndarray:
    """Keys of groups: of words they are negative, of bytes not, so that the two don't meet and are sorted apart."""
    half = (hashes.view(np.uint64) >> np.uint64(1)).view(np.int64)
    return ~half if by_word else half


def window_minima(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each string of ``length`` bytes (or codes of words) the smallest hash of its k-grams and where it stands first;
    and running sums for further hashes. Equal strings have equal minima at equal places."""
    k = gram_size(length)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((data + np.uint64(1)) * powers(PRIME, len(data)), dtype=np.uint64)))
    n = len(data) - k + 1
    grams = mixed((sums[k:] - sums[:n]) * powers(INVERSE, n))
    low = np.uint64((1 << 30) - 1)
    key = (grams & ~low) | np.arange(n, dtype=np.uint64)  # the first one of equal hashes
    w = length - k + 1
    padded = np.full(-(-n // w) * w, ~np.uint64(0))
    padded[:n] = key
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[: n - w + 1], ahead[w - 1 : n])
    place = (least & low).astype(np.int64)
    return grams[place].view(np.int64), place, sums


def runs_of(data: np.ndarray, lengths: np.ndarray, length: int) -> Iterator[tuple[list, list, list, list]]:
    """For each text in ``data`` the stretches of string starts with one minimum: key, first and last start, and
    whether the minimum stands at several places, without which a stretch can't repeat in itself."""
    enough = len(data) >= length
    hashes, place = window_minima(data, length)[:2] if enough else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    begin = 0
    for size in lengths.tolist():
        n = size - length + 1
        if n <= 0:
            yield [], [], [], []
        else:
            own, where = hashes[begin : begin + n], place[begin : begin + n]
            edges = starts_of(own)
            first, last = edges[:-1], edges[1:] - 1
            keys = group_keys(own[first], data.itemsize == CODE)
            yield keys.tolist(), first.tolist(), last.tolist(), (where[first] != where[last]).tolist()
        begin += size


def sign(batches: Iterator[pa.RecordBatch], length: int, words: int | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [(t or "").encode("utf-8") for t in batch.column(2).to_pylist()]
        runs: list[list[dict]] = []
        n_words: list[int | None] = []
        for some in pieces(texts, 500):
            data = np.frombuffer(b"".join(texts[some]), dtype=np.uint8)
            found = runs_of(data, np.array([len(t) for t in texts[some]]), length)
            runs += [[{"h": w, "a": x, "b": y, "m": z} for w, x, y, z in zip(*one, strict=True)] for one in found]
            if words:
                codes, _, _, first = hashed_runs(texts[some], NOT_BLANK)
                for own, one in zip(runs[len(n_words) :], runs_of(codes, np.diff(first), words), strict=True):
                    own += [{"h": w, "a": x, "b": y, "m": z} for w, x, y, z in zip(*one, strict=True)]
                n_words += np.diff(first).tolist()
        kind = pa.list_(pa.struct([("h", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("m", pa.bool_())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
             pa.array([len(t) for t in texts], pa.int64()), pa.array(n_words or [None] * len(texts), pa.int64()), pa.array(runs, kind)],
            names=["rid", "doc_id", "sha", "n_bytes", "n_words", "runs"],
        )


def cut(batches: Iterator[pa.RecordBatch], length: int, words: int | None) -> Iterator[pa.RecordBatch]:
    """The bytes of each stretch of (rid, text, runs), of words with one blank between them, with a digest."""
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            rows: list[tuple] = []
            for rid, text, runs in zip(*(c.to_pylist() for c in part.columns), strict=True):
                data = (text or "").encode("utf-8")
                if any(run["h"] < 0 for run in runs):
                    flat = b" ".join(data.split())
                    _, begins, ends = words_of(flat)
                for run in runs:
                    if run["h"] < 0:
                        piece = flat[begins[run["a"]] : ends[run["b"] + words - 1]]
                    else:
                        piece = data[run["a"] : run["b"] + length]
                    rows.append((run["h"], hashlib.blake2b(piece, digest_size=16).digest(), rid, run["a"], piece))
            if rows:
                h, sk, r, a, piece = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(sk, pa.binary()), pa.array(r, pa.int64()), pa.array(a, pa.int32()), pa.array(piece, pa.binary())],
                    names=["h", "sk", "owner", "at", "seg"],
                )


def cut_finer(batches: Iterator[pa.RecordBatch], length: int, words: int | None) -> Iterator[pa.RecordBatch]:
    """Stretches (owner, seg, order, h) of hot groups in pieces of FINE starts whose strings hold the minimum at nearly the
    same place; the key of a piece is a hash of the bytes that all its strings share, so only near-equal ones meet."""
    for batch in batches:
        for owner, seg, order, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = words if h < 0 else length
            data, begins, ends = words_of(seg) if h < 0 else bytes_of(seg)
            hashes, place, sums = window_minima(data, own)
            offset = place - np.arange(len(place))
            edges = starts_of(place, offset // FINE)
            first, last = edges[:-1], edges[1:] - 1
            anchor, zone = place[first], offset[first] // FINE * FINE
            s, e = anchor - zone, np.minimum(anchor - zone - FINE + 1 + own, len(data))
            s = np.maximum(s, 0)
            core = (sums[e] - sums[s]) * powers(INVERSE, len(data) + 1)[s]
            key = group_keys(mixed(core ^ mixed(hashes[first].view(np.uint64) + zone.astype(np.uint64))), h < 0)
            piece = [seg[x:y] for x, y in zip(begins[first].tolist(), ends[last + own - 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in piece], pa.binary()),
                 pa.array([owner] * len(piece), pa.binary()), pa.array(first, pa.int32()), pa.array(piece, pa.binary()),
                 pa.array([{**order, "a": order["a"] + x} for x in first.tolist()], batch.schema.field("ord").type)],
                names=["h", "sk", "owner", "at", "seg", "ord"],
            )


def judge(batches: Iterator[pa.RecordBatch], length: int, words: int | None, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Of each different stretch (h, sk, ord, seg), sorted by h and order, the spans of it that repeat elsewhere; with
    ``keep_first`` only those that occurred before."""
    for part in grouped(batches, ["h"]):
        key = part.column("h").to_numpy()
        segs = part.column("seg").to_pylist()
        sizes = np.array([len(s) for s in segs])
        groups = starts_of(key)
        begin = 0
        while begin < len(groups) - 1:
            end = begin + 1
            by_word = key[groups[begin]] < 0
            while end < len(groups) - 1 and (key[groups[end]] < 0) == by_word and sizes[groups[begin] : groups[end + 1]].sum() <= BLOCK:
                end += 1
            a, b = int(groups[begin]), int(groups[end])
            begin = end
            if by_word:
                data, _, _, first = hashed_runs(segs[a:b], NOT_BLANK)
                whole, own = words, np.diff(first)
            else:
                data = np.frombuffer(b"".join(segs[a:b]), dtype=np.uint8)
                whole, own = length, sizes[a:b]
            offsets = np.cumsum(own) - own
            owner = np.repeat(np.arange(b - a), own - whole + 1)
            starts = np.arange(len(owner)) - np.repeat(np.cumsum(own - whole + 1) - (own - whole + 1), own - whole + 1) + offsets[owner]
            earlier, later = previous_factors(data, starts, whole)
            again = earlier >= 0 if keep_first else (earlier >= 0) | (later >= 0)
            hit = np.searchsorted(owner[again], np.arange(b - a + 1))
            relative = (starts - offsets[owner])[again]
            spans = [[{"s": s, "e": e} for s, e in spans_of(relative[x:y], whole)] for x, y in zip(hit[:-1], hit[1:], strict=True)]
            kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("h").slice(a, b - a).combine_chunks(), part.column("sk").slice(a, b - a).combine_chunks(), pa.array(spans, kind)],
                names=["h", "sk", "spans"],
            )


def different(occurrences: DataFrame) -> DataFrame:
    """Different stretches with the number of their places and the first of them."""
    return occurrences.groupBy("h", "sk").agg(F.count("*").alias("n"), F.min("ord").alias("ord"), F.first("seg").alias("seg"))


def place_spans(occurrences: DataFrame, judged: DataFrame, keep_first: bool) -> DataFrame:
    """(owner, spans, word_spans): the spans of each occurrence in its owner's positions, of bytes and of words."""
    whole = "array(named_struct('s', 0, 'e', length))"
    units = "octet_length(seg) - if(h < 0, octet_length(replace(string(seg), ' ', '')) - 1, 0)"  # one blank parts words
    repeated = "n > 1 and not first" if keep_first else "n > 1"
    joined = occurrences.select("h", "sk", "owner", "at", "ord", F.expr(units).alias("length")).join(
        judged.select("h", "sk", "n", F.col("ord").alias("first_ord"), "spans"), ["h", "sk"]
    )
    spans = joined.withColumn("first", F.expr("ord <=> first_ord")).selectExpr(
        "h", "owner", "at", f"if({repeated}, {whole}, spans) as spans"
    )
    shifted = spans.where("size(spans) > 0").selectExpr(
        "h", "owner", "transform(spans, x -> named_struct('s', x.s + at, 'e', x.e + at)) as spans"
    )
    of_words = F.col("h") < 0
    return shifted.groupBy("owner").agg(  # bounded by the owner's length
        F.flatten(F.collect_list(F.when(~of_words, F.col("spans")))).alias("spans"),
        F.flatten(F.collect_list(F.when(of_words, F.col("spans")))).alias("word_spans"),
    )


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, keep_first: bool = True, hot_bytes: int = HOT_BYTES, words: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """For rows (rid, doc_id, text) the digests of all rows (rid, doc_id, sha, n_bytes) and (rid, spans, word_spans) where
    a byte is covered by a string of ``length`` bytes that starts elsewhere as well, or did so before; and a word by a
    passage of ``words``."""
    signed = docs.select("rid", "doc_id", "text").mapInArrow(
        tidy(lambda batches: sign(batches, length, words)),
        f"rid long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, sha binary, n_bytes long, n_words long, runs array<struct<h:long,a:int,b:int,m:boolean>>",
    )
    signed = settle(signed, "repeat-signatures")
    order = F.struct("doc_id", "rid")
    texts = settle(
        signed.groupBy("sha").agg(
            F.count("*").alias("n"), F.min(order).alias("first"), F.min_by("runs", order).alias("runs"), F.min("n_bytes").alias("n_bytes")
        ),
        "repeat-texts",
    )
    runs = texts.select(F.col("first.rid").alias("rid"), F.explode("runs").alias("run")).select("rid", "run.*")
    often = runs.groupBy("h").agg(F.sum(F.expr("1 + int(m)")).alias("n")).where("n > 1").select("h")
    chosen = runs.join(often, "h").groupBy("rid").agg(F.collect_list(F.struct("h", "a", "b")).alias("runs"))
    pieces_of = docs.select("rid", "text").join(chosen, "rid").select("rid", "text", "runs")
    places = texts.select(F.col("first.rid").alias("owner"), F.col("first.doc_id").alias("d"))
    found = pieces_of.mapInArrow(tidy(lambda batches: cut(batches, length, words)), "h long, sk binary, owner long, at int, seg binary")
    found = settle(found, "repeat-stretches")
    found = found.join(places, "owner").withColumn("ord", F.struct("d", F.col("owner").alias("r"), F.col("at").alias("a"))).drop("d")
    unlike = settle(different(found), "different-stretches")
    sizes = unlike.groupBy("h").agg(F.sum(F.octet_length("seg")).alias("bytes"))
    hot = settle(sizes.where(F.col("bytes") > hot_bytes).select("h"), "hot-groups")
    is_hot = hot.limit(1).count() > 0
    cold = unlike.join(hot, "h", "left_anti") if is_hot else unlike
    judged = _judge(cold, length, words, keep_first)
    if is_hot:
        kind = unlike.schema["ord"].dataType.simpleString()
        finer = unlike.join(hot, "h").select(F.col("sk").alias("owner"), "seg", "ord", "h").mapInArrow(
            tidy(lambda batches: cut_finer(batches, length, words)), f"h long, sk binary, owner binary, at int, seg binary, ord {kind}"
        )
        finer = settle(finer, "finer-stretches")
        inner = place_spans(finer, _judge(different(finer), length, words, keep_first), keep_first)
        inner = inner.select("owner", F.concat("spans", "word_spans").alias("spans"))  # a stretch has one kind
        judged = judged.unionByName(
            unlike.join(hot, "h").drop("seg").join(inner, F.col("sk") == F.col("owner"), "left").select(
                "h", "sk", "n", "ord", F.coalesce("spans", F.expr(f"cast(array() as {SPANS})")).alias("spans")
            )
        )
    inside = place_spans(found, judged, keep_first).withColumnRenamed("owner", "text_rid")
    every = signed.select("rid", "sha", "n_bytes", "n_words").join(texts.select("sha", "n", F.col("first.rid").alias("text_rid")), "sha")
    every = every.join(inside, "text_rid", "left")
    enough = f"n_bytes >= {length}" + (f" or n_words >= {words}" if words else "")
    copy = f"n > 1 and ({enough})" + (" and rid <> text_rid" if keep_first else "")
    spans = every.select(
        "rid", F.expr(f"if({copy}, array(named_struct('s', 0, 'e', int(n_bytes))), spans)").alias("spans"), "word_spans"
    )
    return signed, spans.where("size(spans) > 0 or size(word_spans) > 0")


def _judge(unlike: DataFrame, length: int, words: int | None, keep_first: bool) -> DataFrame:
    """Spans inside different stretches (h, sk, n, ord, seg)."""
    sent = unlike.select("h", "sk", "ord", "seg").repartition("h").sortWithinPartitions("h", "ord")
    spans = sent.mapInArrow(tidy(lambda batches: judge(batches, length, words, keep_first)), f"h long, sk binary, spans {SPANS}")
    return settle(spans.join(unlike.select("h", "sk", "n", "ord"), ["h", "sk"]), "judged-stretches")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for s, e in sorted((x["s"], x["e"]) for x in spans or ()):
        if found and s <= found[-1][1]:
            found[-1] = (found[-1][0], max(e, found[-1][1]))
        else:
            found.append((s, e))
    return found


def whole_characters(data: bytes, start: int, end: int) -> tuple[int, int]:
    """A span without the parts of characters at its ends."""
    while start < end and data[start] & 0xC0 == 0x80:
        start += 1
    while start < end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, keep_first: bool = True, characters: bool = False,
    id_column: str = "doc_id", text_column: str = "text", hot_bytes: int = HOT_BYTES, keep: list[str] | None = None,
    words: int | None = None,
) -> DataFrame:
    """(rid, doc_id, n_bytes, spans, kept) of every row: ``spans`` (start, end in UTF-8 bytes) are removed, ``kept`` are
    the remaining bytes. With ``keep_first`` the first place of a repeated string stays, in the order of doc_id and then
    of rows; without it every place goes. With ``characters`` a span ends where characters do, so ``kept`` is text.
    With ``words`` passages of so many words count as well as strings of ``length`` bytes, whatever white space parts
    the words; a passage goes from its first word to its last. Words are equal if their 64-bit hashes are.

    A string can repeat only where the smallest hash of its k-grams occurs again. So texts are cut, in one pass, into
    stretches of strings with one minimum, and only stretches whose minimum occurs twice go on; those with one minimum
    meet in a task. There suffixes are ordered by their first ``length`` bytes, and the longest-previous-factor rule
    tells which strings occurred before (or occur later). Equal texts and equal stretches are one each with a number of
    places, and groups of stretches beyond ``hot_bytes`` are dealt out again by the bytes that their strings share, so
    no task grows with a passage that very many texts hold. Matches never cross texts; strings are judged on the input.

    Null and empty texts have no bytes and no spans. Null ids come first. Repeated rows are copies: all but the first
    go (all go without ``keep_first``) if they have ``length`` bytes or ``words`` words. An empty table gives no rows;
    other columns are not read, but those named in ``keep`` are handed on."""
    small_batches(docs.sparkSession)
    extra = keep or []
    rows = with_row_key(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), *extra))
    _, spans = repeated_spans(rows, length, keep_first, hot_bytes, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, kept, gone = [], [], []
                for text, found, passages in zip(*(part.column(c).to_pylist() for c in (2, 3, 4)), strict=True):
                    data, out, last = (text or "").encode("utf-8"), [], 0
                    if passages:
                        _, begins, ends = words_of(data)
                        found = [*(found or ()), *({"s": int(begins[x["s"]]), "e": int(ends[x["e"] - 1])} for x in passages)]
                    cuts = merged(found)
                    if characters:
                        cuts = [(s, e) for s, e in (whole_characters(data, *c) for c in cuts) if s < e]
                    for s, e in cuts:
                        out.append(data[last:s])
                        last = e
                    sizes.append(len(data))
                    kept.append(b"".join([*out, data[last:]]))
                    gone.append([{"s": s, "e": e} for s, e in cuts])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(gone, kind), pa.array(kept, pa.binary()), *part.columns[5:]],
                    names=["rid", "doc_id", "n_bytes", "spans", "kept", *extra],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    joined = rows.join(spans, "rid", "left").select("rid", "doc_id", "text", "spans", "word_spans", *extra)
    shape = f"rid long, doc_id {kind}, n_bytes long, spans {SPANS}, kept binary"
    return joined.mapInArrow(tidy(run), ", ".join([shape, *[f"{c} {rows.schema[c].dataType.simpleString()}" for c in extra]]))


def op4_repeats(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, folder, "documents"), LENGTH, keep_first=False)
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
