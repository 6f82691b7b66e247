"""BPE by chunks: content-defined chunks are encoded once and shared, and their joins are encoded again."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm.common import small_batches, table, tidy

CHUNK = 1024  # mean bytes between cuts
LEAST, MOST = 256, 8192  # bytes of a chunk
CHUNK_BYTES = 6_000_000  # of one generation of remembered chunks in a worker
WORDS = 120_000  # of one generation of remembered words
LONG_WORD = 100  # longer words are not remembered
SIMPLE_WORD = re.compile(rb"([A-Za-z]+)([!-&(-/:;=?@\[-`{}~]*)").fullmatch  # letters, then marks without ' < | >
GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def rolling_cuts(data: np.ndarray) -> np.ndarray:
    """Positions after which a chunk may end: a hash of the last eight bytes has its ten low bits zero."""
    h = GEAR[data]
    for step in (1, 2, 4):
        moved = h.copy()
        moved[step:] += h[:-step] << np.uint32(step)
        h = moved
    low = (h >> np.uint32(9)) % np.uint32(CHUNK) == 0
    if len(data):
        low[:-1] &= (data[1:] & 0xC0) != 0x80  # characters stay whole
    return np.flatnonzero(low) + 1


def chunks_of(data: bytes) -> list[bytes]:
    """The chunks of a text; together they are the text. Ends depend on the bytes before them only, so a passage that
    texts share falls into the same chunks soon after its start."""
    if len(data) <= LEAST:
        return [data] if data else []
    values = np.frombuffer(data, dtype=np.uint8)
    found, start = [], 0
    for cut in [*rolling_cuts(values).tolist(), len(data)]:
        while cut - start > MOST:
            end = start + MOST
            while data[end] & 0xC0 == 0x80:
                end -= 1
            found.append(data[start:end])
            start = end
        if cut - start >= LEAST or cut == len(data):
            found.append(data[start:cut])
            start = cut
    return [c for c in found if c]


class Remembered:
    """A mapping of two generations: when the young one is full it becomes the old one, so memory stays bounded."""

    def __init__(self, most: int):
        self.young: dict = {}
        self.old: dict = {}
        self.most, self.used = most, 0

    def __getitem__(self, key):
        value = self.young.get(key)
        if value is None and self.old:
            value = self.old.get(key)
            if value is not None:
                self.keep(key, value)
        return value

    def keep(self, key, value, cost: int = 1) -> None:
        self.young[key] = value
        self.used += cost
        if self.used > self.most:
            self.old, self.young, self.used = self.young, {}, 0


class ChunkCoder:
    """Encodes texts with a tokenizer that drops white space between words, and decodes ids.

    ASCII white space ends every word of such a tokenizer, so the encoding of a text is the encodings of its words in
    a row. A chunk's words between its first and its last white space are encoded once for all texts that hold the
    chunk. What lies around a cut, from the last white space before it to the first one after it, is encoded anew;
    where a chunk has no white space at all the stretch goes on to the next chunk. So both sides of every join agree
    with what encoding the whole text gives."""

    def __init__(self, path: str, words: int = WORDS, chunk_bytes: int = CHUNK_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and words come in small batches
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.decoder is not None or self.plain("a b") != self.plain("a") + self.plain("b"):
            raise ValueError("chunks need a tokenizer that drops white space and joins tokens with blanks")
        self.words, self.chunks = Remembered(words), Remembered(chunk_bytes)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.shown = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.encoded_chunks = self.reused_chunks = 0
        self.model = self.tokenizer.model
        # Whether a run of letters is one piece in lower case and punctuation after it another, as the model sees them.
        self.simple = self.plain("Az,!") == [t.id for p in ("az", ",!") for t in self.model.tokenize(p)]

    def plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode_new(self, words: list[bytes]) -> dict[bytes, bytes]:
        found, rest = {}, []
        for word in words:
            match = SIMPLE_WORD(word) if self.simple else None
            if match is None:
                rest.append(word)
                continue
            letters, marks = match.groups()
            ids = [t.id for t in self.model.tokenize(letters.decode().lower())]
            if marks:
                ids += [t.id for t in self.model.tokenize(marks.decode())]
            found[word] = struct.pack(f"<{len(ids)}I", *ids)
        texts = [w.decode() for w in rest]
        for word, enc in zip(rest, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            found[word] = struct.pack(f"<{len(enc.ids)}I", *enc.ids)
        return found

    def encode_words(self, words: list[bytes]) -> bytes:
        young = self.words.young
        missing = {w for w in words if w not in young}
        if not missing:
            return b"".join([young[w] for w in words])
        ids = {w: i for w in missing if (i := self.words[w]) is not None}
        if len(ids) < len(missing):
            new = self.encode_new([w for w in missing if w not in ids])
            for word, value in new.items():
                if len(word) <= LONG_WORD:
                    self.words.keep(word, value)
            ids |= new
        return b"".join([ids[w] if w in ids else young[w] for w in words])

    def encode_chunk(self, chunk: bytes) -> tuple[bytes, bytes, bytes] | None:
        """Ids of the words between the outermost white space, and what stands before and after; None without any."""
        value = self.chunks[chunk]
        if value is None:
            words = (b"x" + chunk + b"x").split()
            if len(words) == 1:
                return None
            self.encoded_chunks += 1
            value = (self.encode_words(words[1:-1]), words[0][1:], words[-1][:-1])
            self.chunks.keep(chunk, value, len(chunk) + len(value[0]) + 400)
        else:
            self.reused_chunks += 1
        return value

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian 32-bit integers."""
        ids, open_end = [], b""
        for chunk in chunks_of((text or "").encode("utf-8")):
            value = self.encode_chunk(chunk)
            if value is None:
                open_end += chunk
                continue
            if joined := open_end + value[1]:  # the join, from white space to white space
                ids.append(self.encode_words([joined]))
            ids.append(value[0])
            open_end = value[2]
        if open_end:
            ids.append(self.encode_words([open_end]))
        return b"".join(ids)

    def decode(self, ids: bytes) -> str:
        shown = self.shown
        return " ".join([shown[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


def encode_documents(
    docs: DataFrame, tokenizer: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, ids, decoded) of every row: ``ids`` are little-endian unsigned 32-bit integers in one binary value,
    ``decoded`` is the text that the ids stand for.

    One pass without a shuffle. Each Python worker remembers chunks and words, two bounded generations of each, so a
    chunk that documents of a task share is encoded once. Sharing chunks among all tasks would move every text through
    a shuffle, which costs more than encoding them.

    Null texts count as empty and give no ids and an empty text. Repeated rows and null ids are kept; an empty table
    gives no rows; other columns are not read."""
    path = tokenizer or default_tokenizer()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ChunkCoder(path)
        schema = pa.schema([("doc_id", kind), ("ids", pa.binary()), ("decoded", pa.string())])
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # ids and decoded text are several times the text
                part = batch.slice(at, 64)
                ids = [coder.encode(t.as_py()) for t in part.column(1)]
                decoded = pa.array([coder.decode(i) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), decoded], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_type

    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = to_arrow_type(source.schema["doc_id"].dataType)
    return source.mapInArrow(tidy(run), f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode_documents(table(spark, folder, "documents"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
